"""Phrase mining against counting every phrase; blocks, shards, ties and odd rows."""

import collections
import re

import numpy as np
import pytest

from sievemark.llm import collocations as C

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slow_collocations(rows, longest, min_count, per_lang, inside=80):
    counts, totals = collections.defaultdict(collections.Counter), collections.Counter()
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang or "und"] += len(words)
            for n in range(1, longest + 1):
                counts[lang or "und"].update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    out = set()
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        kept = []
        for p, a in found.items():
            covered = any(
                100 * b >= inside * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in found.items() if len(q) > len(p)
            )
            if not covered:
                score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
                kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:per_lang], 1):
            out.add((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return out


def sample(seed, docs=120):
    """Few words in runs, all kinds of separators, copies, a hot language and rare ones."""
    random = np.random.default_rng(seed)
    vocabulary = [*"abcdefgh", "The", "ÉTÉ", "été", "漢字", "x y", "w" * 40]
    between = [" ", "  ", "\t", " ", " ", ". ", ",", "\n", "\r\n", "\v", ";x "]
    rows = []
    for i in range(docs):
        n = int(random.integers(0, 60))
        text = "".join(vocabulary[min(int(random.geometric(0.2)), 14) - 1] + between[int(random.choice(11, p=[0.4, 0.1, 0.1, 0.1, 0.1] + [0.2 / 6] * 6))] for _ in range(n))
        rows.append((text, ["en", "en", "en", "fr", None, "und", "de"][i % 7]))
    rows += [("one two three four five. one two three four", "en")] * 20 + [(None, "en"), ("", None), (" \t\n", "fr"), ("...", "es")]
    return rows


@pytest.mark.parametrize("shards, size", [(1, 1 << 20), (4, 1 << 20), (3, 50)])
def test_phrases_against_counting_all(spark, monkeypatch, shards, size):
    monkeypatch.setattr(C, "_BYTES", size)
    rows = sample(shards)
    frame = spark.createDataFrame(rows, "text string, lang string").repartition(5)
    for longest, min_count, per_lang in ((4, 6, 2000), (2, 3, 7), (5, 10, 2000)):
        got = C.collocations(frame, longest=longest, min_count=min_count, per_lang=per_lang, shards=shards, bits=18).collect()
        want = slow_collocations(rows, longest, min_count, per_lang)
        assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_full_bit_tables_lose_nothing(spark):
    rows = sample(9, docs=40)
    got = C.collocations(spark.createDataFrame(rows, "text string, lang string"), min_count=5, bits=15, shards=2).collect()
    assert {tuple(r) for r in got} == slow_collocations(rows, 4, 5, 2000)


def test_small_flushes_add_up(spark, monkeypatch):
    monkeypatch.setattr(C, "_FLUSH", 40)
    monkeypatch.setattr(C, "_BYTES", 100)
    rows = sample(5, docs=50)
    got = C.collocations(spark.createDataFrame(rows, "text string, lang string"), min_count=4, bits=18).collect()
    assert {tuple(r) for r in got} == slow_collocations(rows, 4, 4, 2000)


def test_blocks_share_words():
    text = b"one two three, four five  six seven. eight nine ten eleven twelve"
    for size in range(1, 40):
        blocks = list(C.blocks_of(text, size, 3))
        assert b"".join(b[:n] for b, n in blocks) == text
        words = C.words_in(blocks)
        own = [bytes(words.data[a:e]) for a, e, c in zip(words.begin, words.end, words.counted) if c]
        assert own == re.findall(rb"[^ \t.,]+", text)


def test_equal_words_have_equal_hashes_wherever_they_stand():
    words = C.words_in([(b"ab cd ab, ab", 12), (b"cd x" + b"y" * 70000, 70004)])
    names = [bytes(words.data[a:e]) for a, e in zip(words.begin, words.end)]
    for lane in (0, 1):
        h = C.word_hashes(words, lane)
        assert len(set(zip(names, h.tolist()))) == len(set(names)) == len(set(h.tolist()))


def test_shares_are_compared_in_whole_numbers(spark):
    """A phrase that is frequent only by all shards together is in the union."""
    rows = [(f"left right {i}.", "en") for i in range(30)] + [(f"filler{i} more{i}.", "en") for i in range(300)]
    got = C.collocations(spark.createDataFrame(rows, "text string, lang string"), min_count=30, shards=4, bits=20).collect()
    assert [(r.phrase, r.a, r.l, r.r, r.n, r.score) for r in got] == [("left right", 30, 30, 30, 690, 1_000_000)]


def test_collocations_odd_rows(odd, none):
    rows = [(r.text, r.lang) for r in odd.collect()]
    got = C.collocations(odd, min_count=4, bits=22).collect()
    assert {tuple(r) for r in got} == slow_collocations(rows, 4, 4, 2000)
    assert got and C.collocations(none, bits=16).count() == 0


@pytest.mark.parametrize("passed", ["pairs", "strings"])
def test_a_pass_holds_little_of_the_text_it_reads(monkeypatch, passed):
    """Peak of one task over 6 MB of text in which every phrase is counted, beside the bit table and the batch at hand."""
    import tracemalloc
    import types

    import pyarrow as pa

    runs, held = [], types.SimpleNamespace(value=b"\xff" * 1024)
    monkeypatch.setattr(C, "small_batches", lambda docs: docs)
    docs = types.SimpleNamespace(mapInArrow=lambda run, schema: runs.append(run) or docs, groupBy=lambda *c: docs, agg=lambda *c: docs)
    monkeypatch.setattr(C, "F", types.SimpleNamespace(sum=lambda c: types.SimpleNamespace(alias=str)))
    C._local_counts(docs, range(1, 5), 4, 1, held) if passed == "pairs" else C.phrase_counts(docs, 4, held)
    random = np.random.default_rng(3)
    names = np.array([f"word{i}" for i in range(3000)])

    def batches():
        for i in range(24):
            text = " ".join(names[np.minimum(random.geometric(0.002, 30_000), 3000) - 1])
            yield pa.RecordBatch.from_pydict({"text": [text], "lang": ["en"], "key": [5 + i % 2], "salt": [7 + i % 3]})

    tracemalloc.start()
    try:
        words = 0
        for batch in runs[0](batches()):
            if passed == "strings":
                words += sum(n for n, size in zip(batch.column("f").to_pylist(), batch.column("words").to_pylist()) if size == 1)
        peak = tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()
    assert words == (24 * 30_000 if passed == "strings" else 0)
    assert peak < 150, peak
