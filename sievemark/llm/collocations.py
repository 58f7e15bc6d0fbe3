"""Phrase collocation mining by partitioning: local mining in shards, union, exact global counts.

Documents are dealt into a fixed number of shards by a hash of their text. A shard with a share of a language's words
is mined completely at that share of the support: a phrase frequent in all documents reaches it in at least one
shard. Mining goes by length. A phrase is only counted where all its words, then all its pairs of words, are
frequent in the shard. These sets cross to the tasks as bit tables of a fixed size over phrase hashes, whose false
hits cost counts and lose nothing. The union of what is frequent in any shard is a bit table too, and one more pass
counts its phrases over all documents, by their words.

Tasks add up equal phrases before a shuffle, so a very frequent word sends few rows. They do so for each buffer of
text and again over many buffers, so that what a Python worker holds is bounded by ``_BYTES`` and ``_FLUSH``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievemark.llm.common import BATCH, apart, small_batches, texts_of
from sievemark.session import materialize

#: Few shards keep the local support well over one occurrence, however many tasks mine a shard.
SHARDS = 4
#: Bits of a table of frequent phrases, as a power of two: 16 MB.
TABLE_BITS = 27
_BYTES = 1 << 19  # of text at once
_FLUSH = 1 << 20  # phrases, each once a buffer, between two additions over buffers; they go on if over three quarters are left
_HELD = 40  # buffers whose text is held at most

_GAP, _BREAK = b" \t", b".,;:!?\n\v\f\r"
_KIND = np.zeros(256, np.uint8)
_KIND[list(_GAP)] = 1
_KIND[list(_BREAK)] = 2
_NEXT = re.compile(rb"[ \t.,;:!?\n-\r]")
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

_RANDOM = np.random.default_rng(20240229)
_OF_BYTE = _RANDOM.integers(0, 1 << 63, (2, 256), np.uint64) * np.uint64(2) + np.uint64(1)
_OF_PLACE = _RANDOM.integers(0, 1 << 63, (2, 1 << 16), np.uint64) * np.uint64(2) + np.uint64(1)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _FACTOR
    return h ^ (h >> np.uint64(29))


def blocks_of(text: bytes, size: int, words: int) -> Iterator[tuple[bytes, int]]:
    """(bytes, where the next block begins): blocks end between words and run on for ``words`` more."""
    on = re.compile(rb"(?:[ \t]+[^ \t.,;:!?\n-\r]+){0,%d}" % words)
    start = 0
    while len(text) - start > size:
        found = _NEXT.search(text, start + size)
        if found is None:
            break
        end = found.start()
        yield text[start : on.match(text, end).end()], end - start
        start = end
    yield text[start:], len(text) - start


class Words(NamedTuple):
    """Words of a buffer: their places, the piece and the block each is in."""

    data: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    piece: np.ndarray
    block: np.ndarray
    counted: np.ndarray  # False for words that only continue a block


def words_in(blocks: list[tuple[bytes, int]]) -> Words:
    data = np.frombuffer(b"\n".join(b for b, _ in blocks).translate(_LOWER), np.uint8)
    kind = _KIND[data]
    inside = np.concatenate([[False], kind == 0, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    begin, end = edges[::2], edges[1::2]
    piece = np.cumsum(kind == 2, dtype=np.int32)[begin]
    starts = np.cumsum([0, *(len(b) + 1 for b, _ in blocks[:-1])])
    block = np.searchsorted(starts, begin, "right") - 1
    counted = begin < (starts + np.array([n for _, n in blocks]))[block]
    return Words(data, begin, end, piece, block, counted)


def word_hashes(words: Words, lane: int = 0) -> np.ndarray:
    """A 64-bit hash of each word: a sum of random multiples of its bytes."""
    if not len(words.begin):
        return np.zeros(0, np.uint64)
    sizes = words.end - words.begin
    first = np.cumsum(sizes) - sizes
    place = np.arange(sizes.sum()) - np.repeat(first, sizes)
    at = place + np.repeat(words.begin, sizes)
    factor = _OF_PLACE[lane][place & 0xFFFF]
    if sizes.max() > 1 << 16:
        factor = factor + (place >> 16).astype(np.uint64) * _FACTOR
    return _mixed(np.add.reduceat(_OF_BYTE[lane][words.data[at]] * factor, first))


def phrase_hashes(hashes: np.ndarray, seed: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the ``n`` words from each place on; they are of use where a phrase starts."""
    m = max(0, len(hashes) - n + 1)
    out = _mixed(seed[:m] + hashes[:m])
    for i in range(1, n):
        out = _mixed(out * _FACTOR + hashes[i : i + m])
    return out


def _starts(words: Words, n: int) -> np.ndarray:
    """Where a phrase of ``n`` words starts that stays in its piece and is counted here."""
    m = max(0, len(words.begin) - n + 1)
    return words.counted[:m] & (words.piece[:m] == words.piece[n - 1 : n - 1 + m])


def _has(table: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = h & np.uint64(8 * len(table) - 1)
    return table[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1 == 1


def _buffers(batches: Iterator[pa.RecordBatch], longest: int) -> Iterator[tuple[Words, list, np.ndarray, np.ndarray]]:
    """(words, languages, keys, salts of its blocks): about ``_BYTES`` of text at a time."""
    held, names, keys, salts, size = [], [], [], [], 0
    for whole in batches:
        for start in range(0, whole.num_rows, BATCH):
            batch = whole.slice(start, BATCH)
            rows = zip(texts_of(batch, "text"), batch.column("lang").to_pylist(), batch.column("key").to_pylist(), batch.column("salt").to_pylist())
            for text, lang, key, salt in rows:
                for block in blocks_of(text or b"", _BYTES, longest - 1):
                    held.append(block)
                    names.append(lang)
                    keys.append(key)
                    salts.append(salt)
                    size += len(block[0])
                    if size >= _BYTES:
                        yield words_in(held), names, np.array(keys, np.int64).view(np.uint64), np.array(salts, np.int64).view(np.uint64)
                        held, names, keys, salts, size = [], [], [], [], 0
    if held:
        yield words_in(held), names, np.array(keys, np.int64).view(np.uint64), np.array(salts, np.int64).view(np.uint64)


def _equal(*hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, where in it each run of equal hashes begins). Sorted by the first hash alone: where others differ under
    the same first hash, a phrase may make several runs."""
    order = np.argsort(hashes[0])
    new = np.ones(len(order), bool)
    for i, h in enumerate(hashes):
        h = h[order]
        new[1:] = (h[1:] != h[:-1]) | (new[1:] if i else False)
    return order, np.flatnonzero(new)


def _local_counts(docs: DataFrame, sizes: range, longest: int, pairs_from: int, held) -> DataFrame:
    """(key, salt, h, n): occurrences of phrases of the given sizes in each shard, keyed by hash.

    Phrases are counted where all parts of ``pairs_from`` words are in the shard's table.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = None if held is None else np.frombuffer(held.value, np.uint8)
        found: list[tuple] = []
        places: dict[tuple[int, int], int] = {}  # of the pairs of key and salt

        def added_up(h: np.ndarray, place: np.ndarray, n: np.ndarray | None = None) -> tuple:
            order, first = _equal(h)
            n = np.diff(first, append=len(order)) if n is None else np.add.reduceat(n[order], first) if len(n) else n
            order = order[first]
            return h[order], place[order], n

        def over_buffers() -> tuple:
            whole = [np.concatenate([f[i] for f in found]) for i in range(3)]
            found.clear()
            return added_up(*whole)

        def sent(h: np.ndarray, place: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            pairs = np.array(list(places), np.uint64).reshape(-1, 2)[place].view(np.int64)
            columns = [pairs[:, 0], pairs[:, 1], h.view(np.int64), n.astype(np.int64)]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "salt", "h", "n"])

        for words, _, keys, salts in _buffers(batches, longest):
            hashes, key, salt = word_hashes(words), keys[words.block], salts[words.block]
            dealt = [places.setdefault(p, len(places)) for p in zip(keys.tolist(), salts.tolist())]
            place = np.array(dealt, np.int32)[words.block]
            if table is not None:
                parts = phrase_hashes(hashes, key, pairs_from)
                known = _has(table, parts ^ salt[: len(parts)])
            for n in sizes:
                good = _starts(words, n)
                if table is not None:
                    for i in range(n - pairs_from + 1):
                        good = good & known[i : i + len(good)]
                at = np.flatnonzero(good)
                found.append(added_up(phrase_hashes(hashes, key, n)[at] ^ salt[at], place[at]))
            if sum(len(f[0]) for f in found) >= _FLUSH:
                found.append(over_buffers())
                if len(found[0][0]) > _FLUSH * 3 // 4:
                    yield sent(*found.pop())
        if found:
            yield sent(*over_buffers())

    counted = small_batches(docs).mapInArrow(run, "key long, salt long, h long, n long")
    return counted.groupBy("key", "salt", "h").agg(F.sum("n").alias("n"))


def _table(frequent: DataFrame, h: Column, bits: int) -> bytes:
    """The bit table of hashes: put together in groups of 32,768 bits, of which the driver gets 2^bits / 32,768 at most."""
    x = h.bitwiseAND(F.lit((1 << bits) - 1)) + 1
    parts = frequent.groupBy(F.bitmap_bucket_number(x).alias("at")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(x)).alias("bits"))
    out = bytearray(1 << bits - 3)
    for r in parts.collect():
        size = len(r["bits"])
        out[(r["at"] - 1) * size : r["at"] * size] = r["bits"]
    return bytes(out)


def _prepared(docs: DataFrame, text: str, lang: str, shards: int) -> DataFrame:
    name = F.coalesce(F.col(lang).cast("string"), F.lit("und"))
    shard = F.pmod(F.xxhash64(F.col(text)), F.lit(shards))
    return docs.select(F.col(text).alias("text"), name.alias("lang"), F.xxhash64(name).alias("key"), F.xxhash64(shard).alias("salt"))


def locally_frequent(docs: DataFrame, longest: int, min_count: int, bits: int = TABLE_BITS) -> DataFrame:
    """(key, salt, h): hashes of all phrases that reach their share of ``min_count`` in a shard.

    ``docs`` come from ``_prepared``. The share is that of the language's words, in whole numbers.
    """
    spark = docs.sparkSession
    words = materialize(_local_counts(docs, range(1, 2), longest, 1, None), "phrase-words")
    own = words.groupBy("key", "salt").agg(F.sum("n").alias("__own"))
    totals = materialize(own.withColumn("__all", F.sum("__own").over(Window.partitionBy("key"))), "phrase-shares")
    big = lambda c: F.col(c).cast("decimal(19,0)")
    reached = big("n") * big("__all") >= big("__own") * F.lit(min_count).cast("decimal(19,0)")

    def enough(counted: DataFrame, label: str) -> DataFrame:
        return materialize(counted.join(totals, ["key", "salt"]).filter(reached).select("key", "salt", "h"), label)

    levels = [enough(words, "phrase-level")]
    for pairs_from, sizes in ((1, range(2, 3)), (2, range(3, longest + 1))):
        if longest < sizes.start:
            break
        held = spark.sparkContext.broadcast(_table(levels[-1], F.col("h"), bits))
        levels.append(enough(_local_counts(docs, sizes, longest, pairs_from, held), "phrase-level"))
    out = levels[0]
    for level in levels[1:]:
        out = out.unionAll(level)
    return out


class _Found(NamedTuple):
    """Phrases of one buffer, each once: two hashes, occurrences, first words, sizes; then the bytes, the words' places
    and languages."""

    h1: np.ndarray
    h2: np.ndarray
    n: np.ndarray
    at: np.ndarray
    size: np.ndarray
    data: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    block: np.ndarray
    langs: list[str]


def _added_up(found: list[_Found]) -> list[_Found]:
    """Equal phrases of some buffers, by two hashes of their words, counted where they stand first."""
    if not sum(len(f.h1) for f in found):
        return []
    order, first = _equal(np.concatenate([f.h1 for f in found]), np.concatenate([f.h2 for f in found]))
    counts = np.zeros(len(order), np.int64)
    counts[np.minimum.reduceat(order, first)] = np.add.reduceat(np.concatenate([f.n for f in found])[order], first)
    out, low = [], 0
    for f in found:
        n = counts[low : low + len(f.h1)]
        low += len(f.h1)
        here = np.flatnonzero(n)
        if len(here):
            out.append(f._replace(h1=f.h1[here], h2=f.h2[here], n=n[here], at=f.at[here], size=f.size[here]))
    return out


def _strings(found: list[_Found]) -> Iterator[pa.RecordBatch]:
    """(lang, phrase, words, f) of the phrases of some buffers."""
    for f in found:
        at, size = f.at, f.size.astype(np.int32)
        plain = (f.begin[1:] - f.end[:-1] == 1) & (f.data[f.end[:-1]] == 32)
        odd = np.concatenate([[0], np.cumsum(~plain)])
        plain = odd[at + size - 1] == odd[at]
        text = f.data.tobytes()
        cut = zip(f.begin[at].tolist(), f.end[at + size - 1].tolist(), plain.tolist())
        phrases = [text[b:e] if one else b" ".join(text[b:e].split()) for b, e, one in cut]
        columns = [
            pa.array(f.langs, pa.string()).take(pa.array(f.block[at])), pa.array(phrases, pa.binary()).cast(pa.string()),
            pa.array(size, pa.int32()), pa.array(f.n, pa.int64()),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["lang", "phrase", "words", "f"])


def phrase_counts(docs: DataFrame, longest: int, held) -> DataFrame:
    """(lang, phrase, words, f): exact occurrences of the phrases in a bit table over all documents; the
    row with an empty phrase has the words of its language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(held.value, np.uint8)
        found: list[_Found] = []
        totals: dict[str, int] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            yield from _strings(found)
            rows = {"lang": list(totals), "phrase": [""] * len(totals), "words": [0] * len(totals), "f": list(totals.values())}
            yield pa.RecordBatch.from_pydict(rows, pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("words", pa.int32()), ("f", pa.int64())]))
            found.clear()
            totals.clear()

        for words, langs, keys, _ in _buffers(batches, longest):
            key, one, two = keys[words.block], word_hashes(words), word_hashes(words, 1)
            for b, n in enumerate(np.bincount(words.block, words.counted, len(langs)).tolist()):
                totals[langs[b]] = totals.get(langs[b], 0) + int(n)
            got = []
            for n in range(1, longest + 1):
                h = phrase_hashes(one, key, n)
                at = np.flatnonzero(_starts(words, n) & _has(table, h))
                h1, h2 = h[at], phrase_hashes(two, key, n)[at]
                order, first = _equal(h1, h2)
                times, order = np.diff(first, append=len(order)), order[first]
                got.append((h1[order], h2[order], times, at[order].astype(np.int32), np.full(len(order), n, np.uint16)))
            spots = [a.astype(np.int32) for a in (words.begin, words.end, words.block)]
            found.append(_Found(*(np.concatenate(x) for x in zip(*got)), words.data, *spots, langs))
            if len(found) >= _HELD or sum(len(f.h1) for f in found) >= _FLUSH:
                found[:] = _added_up(found)
                if len(found) > _HELD // 2 or sum(len(f.h1) for f in found) > _FLUSH * 3 // 4:
                    yield from flush()
        if totals:
            found[:] = _added_up(found)
            yield from flush()

    counted = small_batches(docs).mapInArrow(run, "lang string, phrase string, words int, f long")
    return counted.groupBy("lang", "phrase", "words").agg(F.sum("f").alias("f"))


def _exact(c: str) -> Column:
    return F.col(c).cast("decimal(20,0)")


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = 4, min_count: int = 30, per_lang: int = 2000,
    inside: int = 80, shards: int = SHARDS, bits: int = TABLE_BITS,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``per_lang`` best phrases of two to ``longest`` words per language.

    A-Z are lower-cased. Pieces end at ``.,;:!?`` and line ends, words at spaces and tabs. ``a`` counts the occurrences of
    the phrase within pieces, overlaps included, at least ``min_count``; ``l`` and ``r`` those of its two parts at the cut
    with the lowest ``score``, 2,000,000 a / (l + r) rounded down, and of these the first; ``n`` the language's words.
    Phrases inside a longer one with at least ``inside`` percent of their occurrences are left out. Ties of the
    score go to the greater ``a``, then to the phrase that is least in bytes.

    Null texts have no words; null languages are ``und``. Repeated rows count each. Extra columns are ignored; an empty
    table gives no rows. One piece of text of any length is read in blocks that share words.
    """
    spark, given = docs.sparkSession, _prepared(docs, text, lang, shards)
    frequent = locally_frequent(given, longest, min_count, bits)
    union = _table(frequent, F.col("h").bitwiseXOR(F.col("salt")), bits)
    counted = phrase_counts(given, longest, spark.sparkContext.broadcast(union))
    counted = materialize(counted.filter((F.col("f") >= min_count) | (F.col("words") == 0)), "phrase-counts")
    phrases = counted.filter("words > 0")
    totals = counted.filter("words = 0").select("lang", F.col("f").alias("n"))
    candidates = phrases.filter("words > 1").withColumnRenamed("f", "a").withColumn("w", F.split("phrase", " "))

    part = lambda start, size: F.array_join(F.slice("w", start, size), " ")
    k = F.col("k")
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1))).select(
        "lang", "phrase", "a", "k", part(1, k).alias("left"), part(k + 1, F.col("words") - k).alias("right")
    )
    halves = [phrases.select("lang", F.col("phrase").alias(side), F.col("f").alias(side[0])) for side in ("left", "right")]
    cuts = apart(cuts, "phrase-cuts").join(halves[0], ["lang", "left"])
    cuts = apart(cuts, "phrase-cuts").join(halves[1], ["lang", "right"])
    twice = F.lit(2_000_000).cast("decimal(7,0)") * _exact("a")
    scored = cuts.withColumn("score", F.call_function("div", twice, _exact("l") + _exact("r")))
    lowest = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("cut"))
    lowest = lowest.select("lang", "phrase", "cut.score", "cut.a", "cut.l", "cut.r")

    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("words") - 1), lambda m: F.transform(
        F.sequence(F.lit(1), F.col("words") - m + 1), lambda i: F.array_join(F.slice("w", i, m), " "))))
    longer = candidates.filter("words > 2").select("lang", F.explode(inner).alias("phrase"), F.col("a").alias("__longer"))
    longer = apart(longer.groupBy("lang", "phrase").agg(F.max("__longer").alias("__longer")), "phrase-longer")
    covered = F.lit(100).cast("decimal(3,0)") * _exact("__longer") >= F.lit(inside).cast("decimal(3,0)") * _exact("a")
    kept = lowest.join(longer, ["lang", "phrase"], "left").filter(F.col("__longer").isNull() | ~covered)

    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = kept.withColumn("__salt", F.pmod(F.hash("phrase"), F.lit(64)))
    few = salted.withColumn("__nth", F.row_number().over(Window.partitionBy("lang", "__salt").orderBy(*best))).filter(F.col("__nth") <= per_lang)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")).filter(F.col("rank") <= per_lang)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
