"""Lexical retrieval packing: windows of tokens filled with the documents most like the one that opens them.

Documents are cut into full windows as far as they go; what is left of each, shorter than a window, is a unit to be
packed. Units are sorted by their strongest terms and dealt out by ranges, so that units alike lie together and no
term, however common, fills a task. Each task reads its units in shards of a fixed number and keeps an inverted
index of one shard. A window is opened by what the last one left over, or else by the first unused unit. BM25 ranks
the unused units of the shard for it, and they fill it in that order; the last one is cut at the edge. A window
that outlasts its shard goes on with the next one. The last window of a task is cut into powers of two.

Terms are token ids, so that the statistics of all documents are one number per id of the vocabulary.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sievemark.llm.common import BATCH, small_batches, texts_of
from sievemark.session import scratch_path

#: Units in one inverted index; a unit is shorter than a window.
SHARD_UNITS = 1024
K1, B = 1.2, 0.75
#: Characters encoded at once.
_PIECE = 1 << 16


class Vocabulary(NamedTuple):
    """A byte-level byte-pair vocabulary: ids of byte strings in the order of the merges, ids of special strings."""

    ranks: dict[bytes, int]
    special: dict[str, int]
    pattern: str

    @property
    def size(self) -> int:
        return max([*self.ranks.values(), *self.special.values()], default=0) + 1

    @property
    def dtype(self) -> np.dtype:
        """The narrowest type that holds every id."""
        return np.dtype("<u2" if self.size <= 1 << 16 else "<u4")


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in such files: itself if printable, else the next one from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def read_vocabulary(path: str, pattern: str) -> Vocabulary:
    """The vocabulary of a ``tokenizers`` file of the byte-level kind, read on the driver.

    Its ids are found by merge ranks, which gives what ``tokenizers`` gives as long as ids follow the
    order of the merges; other files are refused.
    """
    with open(path, encoding="utf-8") as file:
        told = json.load(file)
    letters, model = _byte_letters(), told["model"]
    special = {t["content"]: t["id"] for t in told["added_tokens"]}
    words = {w: i for w, i in model["vocab"].items() if w not in special}
    merged = [words["".join(m) if isinstance(m, list) else m.replace(" ", "")] for m in model["merges"]]
    if model["type"] != "BPE" or told["pre_tokenizer"]["type"] != "ByteLevel" or told["pre_tokenizer"]["add_prefix_space"]:
        raise ValueError("only byte-level BPE files without a prefix space are read")
    if told["normalizer"] is not None or merged != sorted(merged):
        raise ValueError("ids have to follow the order of the merges")
    return Vocabulary({bytes(letters[c] for c in w): i for w, i in words.items()}, special, pattern)


@functools.lru_cache(maxsize=1)
def _encoding(size: int, held):
    import tiktoken

    v = held.value
    return tiktoken.Encoding("own", pat_str=v.pattern, mergeable_ranks=v.ranks, special_tokens=v.special)


def parts_of(text: str, size: int = _PIECE) -> list[str]:
    """Cuts where white space follows another character: words of the pattern never go over that."""
    out, start = [], 0
    while len(text) - start > size:
        at = start + size
        while at < len(text) and not (text[at].isspace() and not text[at - 1].isspace()):
            at += 1
        out.append(text[start:at])
        start = at
    return [*out, text[start:]]


def token_pieces(docs: DataFrame, vocabulary: Vocabulary, text: str, doc_id: str, window: int, end_id: int) -> DataFrame:
    """(doc_id, start, length, doc_tokens, ids, piece): full windows of each document and its rest.

    Ids are packed little-endian in the narrowest type. The table is written: texts are encoded once.
    """
    held = docs.sparkSession.sparkContext.broadcast(vocabulary)
    dtype, size = vocabulary.dtype, vocabulary.size
    needed = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("__text"))
    fields = T.StructType([needed.schema["doc_id"], *T.StructType.fromDDL("start long, length long, doc_tokens long, ids binary")])
    schema = to_arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoding(size, held).encode_to_numpy

        def made(ids: pa.Array, rows: list[tuple]) -> pa.RecordBatch:
            of, start, length, total, data = zip(*rows)
            columns = [ids.take(pa.array(of)), *(pa.array(c, t) for c, t in ((start, pa.int64()), (length, pa.int64()), (total, pa.int64()), (data, pa.binary())))]
            return pa.RecordBatch.from_arrays(columns, schema=schema)

        for whole in batches:
            for first in range(0, whole.num_rows, BATCH):
                batch, rows = whole.slice(first, BATCH), []
                for i, t in enumerate(texts_of(batch, "__text")):
                    own = [encode(p, allowed_special="all") for p in parts_of((t or b"").decode("utf-8", "replace"))]
                    ids = np.concatenate([*own, [end_id]]).astype(dtype)
                    for start in range(0, len(ids), window):
                        cut = ids[start : start + window]
                        rows.append((i, start, len(cut), len(ids), cut.tobytes()))
                    if len(rows) >= 4 * BATCH:
                        yield made(batch.column(0), rows)
                        rows = []
                if rows:
                    yield made(batch.column(0), rows)

    path = scratch_path(docs.sparkSession, "token-pieces")
    cut = small_batches(needed).mapInArrow(run, fields).withColumn("piece", F.monotonically_increasing_id())
    cut.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(cut.schema).parquet(path)


class Statistics(NamedTuple):
    """Of all pieces: the weight of each term and the mean length."""

    idf: np.ndarray
    mean: float


def statistics(pieces: DataFrame, size: int, dtype: np.dtype, window: int) -> Statistics:
    """Document frequencies over all pieces; at most one row for each id and task is shuffled, one for
    each id comes back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, mark, places = np.zeros(size, np.int64), np.zeros(size, np.int32), np.arange(window, dtype=np.int32)
        for batch in batches:
            for data in batch.column(0).to_pylist():
                ids = np.frombuffer(data, dtype)
                at = places[: len(ids)]
                mark[ids] = at  # the last place of each term is where its mark stays
                found[ids[mark[ids] == at]] += 1
        there = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(there, pa.int64()), pa.array(found[there], pa.int64())], names=["term", "n"])

    counted = pieces.select("ids").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    df = np.zeros(size)
    for r in counted.collect():
        df[r["term"]] = r["n"]
    n, mean = pieces.agg(F.count("*"), F.avg("length")).first()
    return Statistics(np.log1p((n - df + 0.5) / (df + 0.5)).astype(np.float32), mean or 1.0)


def weights(tf: np.ndarray, length: np.ndarray | int, idf: np.ndarray, mean: float) -> np.ndarray:
    """BM25 weights of terms in units of the given lengths."""
    return idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / mean))


def term_counts(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values and how often each occurs."""
    ordered = np.sort(ids)
    new = np.ones(len(ids) + 1, bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:-1])
    edges = np.flatnonzero(new)
    return ordered[edges[:-1]], np.diff(edges)


class Index:
    """An inverted index of one shard of units.

    Postings of terms that one unit in ``_DENSE`` has are rows over all units, which add up faster; as each unit has
    fewer terms than a window has tokens, there are at most ``_DENSE`` times as many rows as that.
    """

    _DENSE = 16

    def __init__(self, units: list[np.ndarray], stats: Statistics):
        n = len(units)
        lengths = np.array([len(u) for u in units])
        kind = np.uint32 if len(stats.idf) * n < 1 << 32 else np.int64
        keys, tf = term_counts(np.concatenate(units).astype(kind) * kind(n) + np.repeat(np.arange(n, dtype=kind), lengths))
        terms, of, self.n = keys // kind(n), (keys % kind(n)).astype(np.int64), n
        weight = weights(tf, lengths[of], stats.idf[terms], stats.mean).astype(np.float32)
        self.terms, first, sizes = np.unique(terms, return_index=True, return_counts=True)
        dense = sizes * self._DENSE >= n
        self.row = np.where(dense, np.cumsum(dense) - 1, -1)
        self.first, self.sizes, self.units, self.weights = first, sizes, of, weight
        at = np.repeat(dense, sizes)
        self.rows = np.zeros((int(dense.sum()), n), np.float32)
        self.rows[np.repeat(self.row, sizes)[at], of[at]] = weight[at]

    def scores(self, query: np.ndarray) -> np.ndarray:
        """The score of every unit for the distinct terms of a query."""
        wanted = term_counts(query)[0]
        found = np.searchsorted(self.terms, wanted)
        found = found[self.terms[np.minimum(found, len(self.terms) - 1)] == wanted]
        rows = self.row[found]
        rare = found[rows < 0]
        sizes = self.sizes[rare]
        at = np.repeat(self.first[rare] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        return np.bincount(self.units[at], self.weights[at], self.n) + self.rows[rows[rows >= 0]].sum(axis=0)

    def ranked(self, query: np.ndarray, free: np.ndarray) -> Iterator[int]:
        """The unused units, best first; of equal ones the first."""
        scores = np.where(free, self.scores(query), -1.0)
        few = 16
        if self.n > 4 * few:  # a window seldom takes more
            edge = np.partition(scores, self.n - few)[self.n - few]
            top = np.flatnonzero(scores > max(edge, 0.0))
            yield from top[np.argsort(-scores[top], kind="stable")].tolist()
            scores[top] = -1.0
        rest = np.argsort(-scores, kind="stable")
        yield from rest[scores[rest] >= 0].tolist()


class Placed(NamedTuple):
    """A part of a unit at a place in a sequence."""

    unit: int
    start: int
    length: int
    sequence: int
    offset: int


def pack_units(shards: Iterator[list[tuple[int, np.ndarray]]], stats: Statistics, window: int) -> Iterator[Placed]:
    """Places for all units of one task; shards hold (number, ids) with fewer ids than a window."""
    sequence, room, parts, seed, left = 0, window, [], None, None

    def put(unit: int, start: int, length: int) -> tuple[int, int, int] | None:
        """Fill up the window; what does not fit."""
        nonlocal room
        take = min(length, room)
        parts.append((unit, start, take))
        room -= take
        return (unit, start + take, length - take) if take < length else None

    for shard in shards:
        index, free = Index([ids for _, ids in shard], stats), np.ones(len(shard), bool)
        opener = 0
        while True:
            if not parts and left is None:
                while opener < len(shard) and not free[opener]:
                    opener += 1
                if opener == len(shard):
                    break
                unit, seed = shard[opener]
                free[opener] = False
                put(unit, 0, len(seed))
            elif not parts:
                left = put(*left)
            for i in index.ranked(seed, free) if room else ():
                unit, ids = shard[i]
                free[i] = False
                left = put(unit, 0, len(ids))
                if not room:
                    break
            if room:
                break  # the shard is used up
            if left is not None:
                seed = ids
            at = 0
            for unit, start, length in parts:
                yield Placed(unit, start, length, sequence, at)
                at += length
            sequence, room, parts = sequence + 1, window, []
    end = window - room
    sizes = [1 << b for b in range(end.bit_length() - 1, -1, -1) if end >> b & 1]
    used = 0
    for unit, start, length in parts:
        while length:
            take = min(length, sizes[0] - used)
            yield Placed(unit, start, take, sequence, used)
            start, length, used = start + take, length - take, used + take
            if used == sizes[0]:
                sizes, used, sequence = sizes[1:], 0, sequence + 1


def _signed(units: DataFrame, held, dtype: np.dtype) -> DataFrame:
    """Append ``k1`` and ``k2``, the two terms of each unit with the greatest weights."""
    fields = T.StructType([*units.schema, *T.StructType.fromDDL("k1 int, k2 int")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stats = held.value
        for batch in batches:
            keys = np.zeros((batch.num_rows, 2), np.int32)
            for i, data in enumerate(batch.column("ids").to_pylist()):
                terms, tf = term_counts(np.frombuffer(data, dtype))
                own = weights(tf, len(data) // dtype.itemsize, stats.idf[terms], stats.mean)
                for k in range(min(2, len(terms))):
                    keys[i, k] = terms[best := int(own.argmax())]
                    own[best] = -1.0
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys[:, 0]), pa.array(keys[:, 1])], names=fields.names)

    return small_batches(units).mapInArrow(run, fields)


def _wide(ids: pa.Array, dtype: np.dtype) -> list[bytes]:
    return [np.frombuffer(x, dtype).astype("<u4").tobytes() for x in ids.to_pylist()]


_OUT = "start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def pack(
    docs: DataFrame, vocabulary: Vocabulary, text: str = "text", doc_id: str = "doc_id", window: int = 1024, end_id: int = 0,
    shard_units: int = SHARD_UNITS,
) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, sequence_id, offset): all tokens in sequences of ``window``.

    A row is a piece of a document: the tokens before it, its own, its ids as little-endian unsigned 32-bit numbers,
    the tokens of its document with the closing ``end_id``, and its place. Each id lies in one piece. Sequences are
    full, but for the last of each task, which is cut into sequences whose lengths are powers of two: nothing is padded.

    Null texts are empty; an empty document is its ``end_id`` alone. Repeated rows are packed each; null ids stay
    null. Extra columns are ignored; an empty table gives no rows. A document fits in a task's memory, as its text does.
    """
    spark, dtype = docs.sparkSession, vocabulary.dtype
    pieces = token_pieces(docs, vocabulary, text, doc_id, window, end_id)
    held = spark.sparkContext.broadcast(statistics(pieces, vocabulary.size, dtype, window))
    id_field = T.StructField(doc_id, pieces.schema["doc_id"].dataType)
    fields = T.StructType([id_field, *T.StructType.fromDDL(_OUT)])
    schema = to_arrow_schema(fields)

    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = pa.array(np.zeros(b.num_rows, np.int64))
            ids = pa.array(_wide(b.column("ids"), dtype), pa.binary())
            sequence = pa.array(b.column("piece").to_numpy() * 2)
            columns = [b.column("doc_id"), b.column("start"), b.column("length"), ids, b.column("doc_tokens"), sequence, at]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 33
        known: dict[int, dict] = {}  # units that are not placed whole yet

        def shards() -> Iterator[list[tuple[int, np.ndarray]]]:
            waiting = []
            for batch in batches:
                for row in batch.to_pylist():
                    known[row["piece"]] = row
                    waiting.append((row["piece"], np.frombuffer(row["ids"], dtype)))
                    if len(waiting) == shard_units:
                        yield waiting
                        waiting = []
            if waiting:
                yield waiting

        rows = []
        for p in pack_units(shards(), held.value, window):
            of = known[p.unit]
            ids = np.frombuffer(of["ids"], dtype)[p.start : p.start + p.length].astype("<u4").tobytes()
            rows.append({doc_id: of["doc_id"], "start": of["start"] + p.start, "length": p.length, "ids": ids, "doc_tokens": of["doc_tokens"], "sequence_id": (base + p.sequence) * 2 + 1, "offset": p.offset})
            if p.start + p.length == of["length"]:
                del known[p.unit]
            if len(rows) == BATCH:
                yield pa.RecordBatch.from_pylist(rows, schema)
                rows = []
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)

    windows = small_batches(pieces.filter(F.col("length") == window)).mapInArrow(full, fields)
    signed = _signed(pieces.filter(F.col("length") < window), held, dtype)
    keys = ["k1", "k2", "piece"]
    dealt = signed.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("k1", "k2")
    return windows.unionAll(dealt.mapInArrow(packed, fields))
