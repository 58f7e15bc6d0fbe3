"""Substring dedup: content-defined chunks from a gear rolling hash, deduplicated by digest."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemark.llm.common import BATCH, ROW, apart, per_text, small_batches, texts_of, with_rows
from sievemark.session import materialize

#: A random 32-bit number per byte value.
GEAR = np.random.default_rng(20).integers(0, 1 << 32, 256, dtype=np.uint32)
MEMORY = 16  # bytes a hash remembers: a gear hash shifts one bit a byte, kept to the last 16
RADIUS = 32  # a cut is the lowest hash within so many bytes on either side; chunks are about twice as long
LONGEST = 1024
_CHUNKS = f"{ROW} long, doc_id long, k1 long, k2 long"


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """h[i] = sum of GEAR[data[i - j]] << j for j < MEMORY, by doubling the span of the sum."""
    h, span = GEAR[data], 1
    while span < MEMORY:
        longer = h.copy()
        longer[span:] += h[:-span] << np.uint32(span)
        h, span = longer, span * 2
    return h


def cuts(text: bytes) -> list[int]:
    """Starts of the chunks, and the end of the text.

    A cut follows each byte whose hash is the lowest around it, so it depends on the nearby
    bytes only: after an insertion the same cuts appear again. Cuts stand between characters; where
    none is found for ``LONGEST`` bytes, one is set.
    """
    n = len(text)
    if n <= RADIUS:
        return [0, n] if n else [0]
    data = np.frombuffer(text, np.uint8)
    h = gear_hashes(data)
    wide = np.full(n + 2 * RADIUS, 0xFFFFFFFF, np.uint32)
    wide[RADIUS : RADIUS + n] = h
    low, span = wide, 1
    while span < RADIUS:  # lowest of RADIUS hashes from each place on; RADIUS is a power of two
        low, span = np.minimum(low[:-span], low[span:]), span * 2
    found = np.flatnonzero((h < low[:n]) & (h <= low[RADIUS + 1 : RADIUS + 1 + n])) + 1
    found = found[found < n]
    for _ in range(3):
        inside = (data[np.minimum(found, n - 1)] & 0xC0) == 0x80
        found = found + inside
    places = [0]
    for c in [*found[found < n].tolist(), n]:
        while c - places[-1] > LONGEST:
            at = places[-1] + LONGEST
            while text[at] & 0xC0 == 0x80 and at > places[-1] + LONGEST - 4:
                at -= 1
            places.append(at)
        if c > places[-1]:
            places.append(c)
    return places


def digests(text: bytes, places: list[int]) -> list[bytes]:
    return [xxhash.xxh3_128_digest(text[a:b]) for a, b in zip(places, places[1:])]


def chunk_table(rows: DataFrame, text: str, doc_id: str) -> DataFrame:
    """A row per distinct chunk of a document with its 128-bit digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, BATCH):
                batch = whole.slice(start, BATCH)
                found, counts = [], []
                for t in texts_of(batch, "__text"):
                    own = set(digests(t, cuts(t))) if t else ()
                    found.extend(own)
                    counts.append(len(own))
                of = pa.array(np.repeat(np.arange(batch.num_rows), counts))
                pair = np.frombuffer(b"".join(found), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(of), batch.column(1).take(of), pa.array(pair[:, 0]), pa.array(pair[:, 1])],
                    names=[ROW, "doc_id", "k1", "k2"],
                )

    needed = rows.select(ROW, F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("__text"))
    return small_batches(needed).mapInArrow(run, _CHUNKS)


def taken_chunks(chunks: DataFrame) -> DataFrame:
    """(row, __taken): the digests of each document that an earlier one has, with its id.

    Counts by 64 bits of the digest come first; only chunks that may repeat go on to whole digests.
    """
    often = chunks.groupBy("k1").agg(F.count("*").alias("__n")).filter("__n > 1").select("k1")
    maybe = materialize(chunks.join(often, "k1"), "chunk-repeats")
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col(ROW).alias("row"))
    first = maybe.groupBy("k1", "k2").agg(F.min(order).alias("first"), F.count("*").alias("__n")).filter("__n > 1")
    first = apart(first, "chunk-first")
    later = maybe.join(first, ["k1", "k2"]).filter(F.col("first.row") != F.col(ROW))
    taken = F.collect_list(F.struct("k1", "k2", F.col("first.id").alias("id")))
    return materialize(later.groupBy(ROW).agg(taken.alias("__taken")), "chunk-taken")


RESULT = "__cut binary, n_chunks long, n_deleted long, deleted_bytes long, spans array<struct<start:int,bytes:int>>, copied_from array<long>"


def without_chunks(min_run: int) -> Callable[..., tuple]:
    """A function of a text and its taken chunks that gives the fields of ``RESULT``."""

    def cut(text: bytes | None, taken: list[dict] | None) -> tuple:
        if not text:
            return text, 0, 0, 0, [], []
        places = cuts(text)
        keys = digests(text, places)
        source = {(t["k1"], t["k2"]): t["id"] for t in taken or ()}
        if not source and len(set(keys)) == len(keys):
            return text, len(keys), 0, 0, [], []
        seen, kept, spans, sources, deleted = set(), [], [], set(), 0
        i = 0
        while i < len(keys):
            j, ids = i, set()
            while j < len(keys):
                pair = tuple(np.frombuffer(keys[j], np.int64).tolist())
                if pair in source:
                    ids.add(source[pair])
                elif keys[j] not in seen:
                    break
                seen.add(keys[j])
                j += 1
            size = places[j] - places[i]
            if j > i and size >= min_run:
                spans.append({"start": places[i], "bytes": size})
                sources |= ids
                deleted += j - i
            else:
                kept.append(text[places[i] : places[j]])
            if j < len(keys):
                seen.add(keys[j])
                kept.append(text[places[j] : places[j + 1]])
                j += 1
            i = j
        gone = sum(s["bytes"] for s in spans)
        return b"".join(kept), len(keys), deleted, gone, spans, sorted(x for x in sources if x is not None)

    return cut


def dedup_substrings(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_run: int = 64) -> DataFrame:
    """``docs`` with repeated chunks cut out of the text, and what was cut.

    A chunk is a repeat if an earlier document has its digest or it stands earlier in the same one. Runs of
    repeats of at least ``min_run`` bytes are deleted; shorter ones are common by chance. The order
    is by id, null ids last; of repeated rows the first read is the earlier. ``spans`` are in bytes of
    UTF-8, ``copied_from`` lists the documents with the first copies. Null and empty texts
    stay as they are. Input columns named like a result are replaced.
    """
    added = ("n_chunks", "n_deleted", "deleted_bytes", "spans", "copied_from")
    names = [c for c in docs.columns if c not in added]
    rows = with_rows(docs.select(*names), "chunk-input")
    taken = taken_chunks(chunk_table(rows, text, doc_id))
    cut = per_text(rows.join(taken.hint("merge"), ROW, "left"), text, lambda: without_chunks(min_run), RESULT, also="__taken")
    return cut.select(*[F.col("__cut").cast("string").alias(c) if c == text else F.col(c) for c in names], *added)
