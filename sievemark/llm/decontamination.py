"""Benchmark decontamination with Wu-Manber multi-pattern search."""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemark.llm.common import per_text
from sievemark.session import materialize

WINDOW = 10
#: A-Z to a-z; every other ASCII character outside 0-9 and a-z becomes a space.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)
#: Shortest pattern length, block size of each class. Short patterns get tables of their own,
#: so that one short item does not shrink the shifts of all others.
_CLASSES = ((32, 8), (12, 4), (0, 2))
_TABLE_BITS = 20


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_FOLD).split()


def windows_of(words: list[bytes], width: int = WINDOW) -> Iterable[bytes]:
    """Windows of ``width`` words, or all words if there are fewer, between single spaces."""
    for i in range(max(1, len(words) - width + 1) if words else 0):
        yield b" " + b" ".join(words[i : i + width]) + b" "


@dataclass
class ShiftTable:
    """Tables for patterns of at least ``least`` bytes, compared by blocks of ``block`` bytes.

    ``shift`` tells from the hash of the block that ends at a place how far the search may move
    on: no pattern start can be missed. At shift 0, ``suffixes`` gives the patterns whose
    first ``least`` bytes end with that block, by their first bytes.
    """

    block: int
    least: int
    shift: bytearray
    suffixes: dict[bytes, dict[bytes, list[bytes]]] = field(default_factory=dict)

    @classmethod
    def build(cls, patterns: list[bytes], block: int) -> ShiftTable:
        least = min(map(len, patterns))
        block = min(block, least)
        jump = min(least - block + 1, 255)
        table = cls(block, least, bytearray([jump]) * (1 << _TABLE_BITS))
        mask, shift = (1 << _TABLE_BITS) - 1, table.shift
        for p in patterns:
            for end in range(max(block, least - jump + 1), least + 1):
                h = zlib.crc32(p[end - block : end]) & mask
                if shift[h] > least - end:
                    shift[h] = least - end
            table.suffixes.setdefault(p[least - block : least], defaultdict(list))[p[:block]].append(p)
        return table

    def search(self, text: bytes) -> Iterable[tuple[int, bytes]]:
        """(start, pattern) of every occurrence."""
        block, least, shift, suffixes = self.block, self.least, self.shift, self.suffixes
        mask, crc, end, n = (1 << _TABLE_BITS) - 1, zlib.crc32, self.least, len(text)
        while end <= n:
            tail = text[end - block : end]
            step = shift[crc(tail) & mask]
            if step:
                end += step
                continue
            start = end - least
            heads = suffixes.get(tail)
            if heads:
                for p in heads.get(text[start : start + block], ()):
                    if text.startswith(p, start):
                        yield start, p
            end += 1


@dataclass
class Patterns:
    """The windows of a block of benchmark items and the items that have each."""

    tables: list[ShiftTable]
    owners: dict[bytes, list[str]]

    @classmethod
    def build(cls, items: list[tuple[str, bytes | None]], width: int) -> Patterns:
        owners: dict[bytes, set[str]] = defaultdict(set)
        for item, text in items:
            for w in windows_of(words_of(text), width):
                owners[w].add(item)
        classes: dict[int, list[bytes]] = defaultdict(list)
        for w in owners:
            classes[next(b for least, b in _CLASSES if len(w) >= least)].append(w)
        tables = [ShiftTable.build(ps, block) for block, ps in classes.items()]
        return cls(tables, {w: sorted(o) for w, o in owners.items()})

    def hits(self, text: bytes | None) -> tuple[int, list[int], list[int], list[str]]:
        """Number of words; first and last word of each merged run of hit words; items found."""
        words = words_of(text)
        line = b" " + b" ".join(words) + b" "
        spans, items = [], set()
        for table in self.tables:
            for start, p in table.search(line):
                spans.append((start, start + len(p) - 1))
                items.update(self.owners[p])
        if not spans:
            return len(words), [], [], []
        blanks = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
        at = np.searchsorted(blanks, np.array(sorted(spans)))  # the k-th word stands between blanks k and k + 1
        firsts, lasts = [], []
        for a, b in at.tolist():
            if firsts and a <= lasts[-1] + 1:
                lasts[-1] = max(lasts[-1], b - 1)
            else:
                firsts.append(a)
                lasts.append(b - 1)
        return len(words), firsts, lasts, sorted(items)


def _join_run(done: Column, run: Column) -> Column:
    """Add a run to runs in order, into the last of them if it touches that."""
    last = F.try_element_at(done, F.lit(-1))
    wider = F.array(F.struct(last["a"].alias("a"), F.greatest(last["b"], run["b"]).alias("b")))
    before = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
    return F.when(run["a"] <= last["b"] + 1, F.concat(before, wider)).otherwise(F.concat(done, F.array(run)))


HITS = "n_words long, hit_first array<int>, hit_last array<int>, items array<string>"


def benchmark_blocks(benchmark: DataFrame, text: str, item_id: str, block_bytes: int) -> list[DataFrame]:
    """The benchmark in parts of about ``block_bytes`` of text, by a hash of the text."""
    size = benchmark.agg(F.sum(F.octet_length(text))).first()[0] or 0
    n = max(1, -(-size // block_bytes))
    items = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("item"), F.col(text).cast("binary").alias("text"))
    return [items.filter(F.pmod(F.xxhash64("text"), F.lit(n)) == k) for k in range(n)]


def with_hits(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    width: int = WINDOW, block_bytes: int = 2 << 20,
) -> DataFrame:
    """Append the word count, the runs of hit words and the items found to every document.

    The benchmark is the query set. It is searched in blocks of ``block_bytes`` of text (a bound on
    what the driver and a task hold); from the second block on, the documents with their
    hits so far are written down and read again. A null id of an item counts as ``null``; null
    and empty items have no windows; a document without words has no hits. Columns of the
    input that have a result's name are replaced.
    """
    result = None
    for part in benchmark_blocks(benchmark, item_text, item_id, block_bytes):
        patterns = Patterns.build([(r["item"], bytes(r["text"]) if r["text"] is not None else None) for r in part.collect()], width)
        sent = docs.sparkSession.sparkContext.broadcast(patterns)

        def make(sent=sent) -> Callable[[bytes | None], tuple]:
            return sent.value.hits

        if result is None:
            result = per_text(docs, text, make, HITS)
            continue
        old = {"hit_first": "__f", "hit_last": "__l", "items": "__i"}
        earlier = materialize(result.withColumnsRenamed(old), "benchmark-hits")
        found = per_text(earlier, text, make, HITS)
        runs = lambda a, b: F.transform(F.arrays_zip(a, b), lambda x: F.struct(x[a].alias("a"), x[b].alias("b")))
        every = F.array_sort(F.concat(runs("__f", "__l"), runs("hit_first", "hit_last")))
        joined = F.aggregate(every, F.array().cast("array<struct<a:int,b:int>>"), _join_run)
        both = found.withColumn("__m", joined).withColumn("items", F.array_sort(F.array_union("__i", "items")))
        both = both.withColumn("hit_first", F.col("__m.a")).withColumn("hit_last", F.col("__m.b"))
        result = both.drop("__m", *old.values())
    return result


def contamination(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", **names) -> DataFrame:
    """One row per document: word and hit counts, number and digest of the items found."""
    text = names.get("text", "text")
    found = with_hits(docs.select(doc_id, text), benchmark, **names)
    lengths = F.transform(F.arrays_zip("hit_first", "hit_last"), lambda x: x["hit_last"] - x["hit_first"] + 1)
    n_hit = F.aggregate(lengths, F.lit(0).cast("long"), lambda total, x: total + x)
    return found.select(
        doc_id,
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("hit_first") > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", **names) -> DataFrame:
    """The documents without any hit, unchanged."""
    own = docs.select(*[F.col(c).alias(f"__c{i}") for i, c in enumerate(docs.columns)])
    at = {c: f"__c{i}" for i, c in enumerate(docs.columns)}
    clean = with_hits(own, benchmark, text=at[text], **names).filter(F.size("hit_first") == 0)
    return clean.select(*[F.col(a).alias(c) for c, a in at.items()])
