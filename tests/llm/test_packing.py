"""Packing: every id once, ids as tokenizers gives them, BM25 by its formula, neighbours by rank."""

import collections
import math
import zlib

import numpy as np
import public_tokenizers as P
import pytest

from sievemark.llm import packing, queries

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def vocabulary():
    return packing.read_vocabulary(P.path("byte_bpe_50k.json"), P.PATTERN)


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(P.path("byte_bpe_50k.json"))


def check_places(rows, ids_of, window):
    """Every id in one piece, sequences without gaps, padding only where a length is no power of two."""
    pieces, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == set(ids_of)
    for d, own in pieces.items():
        at = 0
        for r in sorted(own, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids_of[d])
            at += r.length
        assert at == len(ids_of[d])
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at == window or at < window and at & at - 1 == 0


def test_query_places_every_id_of_tokenizers(spark, docs, tokenizer):
    rows = queries.op13_packing(spark, FOLDER).collect()
    ids = {r.doc_id: tokenizer.encode(r.text, add_special_tokens=False).ids + [0] for r in docs.collect()}
    check_places(rows, ids, 1024)
    for r in rows:
        own = np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4")
        assert r.ids_crc32 == zlib.crc32(own.tobytes())
    assert len({r.sequence_id for r in rows}) <= sum(map(len, ids.values())) / 1024 + 8 * 11


def test_ids_equal_those_of_tokenizers(vocabulary, tokenizer):
    import tiktoken

    own = tiktoken.Encoding("own", pat_str=vocabulary.pattern, mergeable_ranks=vocabulary.ranks, special_tokens=vocabulary.special)
    odd = ["<|endoftext|>a <|endoftext|>", "<|endo<|endoftext|>", "\x00\x01", "don't 'S 'll  x\r\n\n y ", "     x", "ẞİ ½Ⅷ①"]
    odd += [f"a{chr(c)}b {chr(c)}{chr(c)} 1{chr(c)}2  {chr(c)} ." for c in range(1, 0x3000, 7) if not 0xD800 <= c < 0xE000]
    for text in odd:
        assert own.encode(text, allowed_special="all") == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_long_texts_in_parts(tokenizer, vocabulary):
    import tiktoken

    own = tiktoken.Encoding("own", pat_str=vocabulary.pattern, mergeable_ranks=vocabulary.ranks, special_tokens=vocabulary.special)
    random = np.random.default_rng(1)
    text = "".join(random.choice(list("abé1.  \n\t' "), 3000).tolist())
    parts = packing.parts_of(text, 40)
    assert "".join(parts) == text and len(parts) > 30
    assert [i for p in parts for i in own.encode(p)] == tokenizer.encode(text).ids


def slow_scores(units, query, df, n, mean):
    out = []
    for u in units:
        tf, score = collections.Counter(u), 0.0
        for t in set(query):
            if t in tf:
                idf = math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5))
                score += idf * tf[t] * 2.2 / (tf[t] + 1.2 * (0.25 + 0.75 * len(u) / mean))
        out.append(score)
    return out


def shard_of(seed, n=90, words=40):
    random = np.random.default_rng(seed)
    return [random.integers(1, words, int(random.integers(1, 30))).astype("<u2") for _ in range(n)]


def stats_of(units, size=64):
    df = np.zeros(size)
    for u in units:
        df[np.unique(u)] += 1
    mean = float(np.mean([len(u) for u in units]))
    return packing.Statistics(np.log1p((len(units) - df + 0.5) / (df + 0.5)), mean), df


def test_scores_follow_bm25():
    units = shard_of(3)
    stats, df = stats_of(units)
    index = packing.Index(units, stats)
    for q in units[:10]:
        want = slow_scores([u.tolist() for u in units], q.tolist(), df, len(units), stats.mean)
        assert index.scores(q) == pytest.approx(want)
        free = np.random.default_rng(len(q)).random(len(units)) < 0.6
        order = list(index.ranked(q, free))
        assert sorted(order) == np.flatnonzero(free).tolist()
        found = index.scores(q)[order]
        assert all(a > b or a == b and i < j for a, b, i, j in zip(found, found[1:], order, order[1:]))


def slow_pack(units, stats, window):
    """Unit numbers in the order in which the windows take them, by ranking everything anew."""
    free, order, room, left, seed = list(range(len(units))), [], 0, 0, None
    index = packing.Index(units, stats)
    while free:
        if not room:
            room = window - left
            if not left:
                seed = free.pop(0)
                order.append(seed)
                room -= len(units[seed])
            left = 0
        scores = index.scores(units[seed])
        best = min(free, key=lambda i: (-scores[i], i))
        free.remove(best)
        order.append(best)
        left = max(0, len(units[best]) - room)
        room = max(0, room - len(units[best]))
        if left:
            seed = best
    return order


def test_neighbours_fill_windows_by_rank():
    units = shard_of(7, n=150)
    stats, _ = stats_of(units)
    placed = list(packing.pack_units(iter([list(enumerate(units))]), stats, 64))
    assert list(dict.fromkeys(p.unit for p in placed)) == slow_pack(units, stats, 64)


@pytest.mark.parametrize("shard", [1, 7, 1000])
def test_shards_go_on_with_open_windows(shard):
    units = shard_of(11, n=120)
    stats, _ = stats_of(units)
    numbered = list(enumerate(units))
    placed = list(packing.pack_units((numbered[i : i + shard] for i in range(0, 120, shard)), stats, 32))
    filled, done = collections.defaultdict(int), collections.defaultdict(int)
    for p in sorted(placed, key=lambda p: (p.sequence, p.offset)):
        assert p.offset == filled[p.sequence]
        filled[p.sequence] += p.length
    for p in sorted(placed, key=lambda p: (p.unit, p.start)):
        assert p.start == done[p.unit]
        done[p.unit] += p.length
    assert done == {i: len(u) for i, u in numbered}
    total = sum(done.values())
    assert sum(n == 32 for n in filled.values()) >= total // 32 and all(n & n - 1 == 0 for n in filled.values())


def test_alike_documents_share_windows(spark, vocabulary):
    """Four subjects with words of their own, dealt in turn: most neighbours in a window have one subject."""
    random = np.random.default_rng(5)
    rows = [(i, " ".join(f"{'alpha beta gamma delta'.split()[i % 4]}{random.integers(30)}" for _ in range(40))) for i in range(200)]
    packed = packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), vocabulary).collect()
    by = collections.defaultdict(set)
    for r in packed:
        by[r.sequence_id].add(r.doc_id % 4)
    assert np.mean([len(s) for s in by.values()]) < 2


def test_packing_odd_rows(spark, odd, none, vocabulary, tokenizer):
    rows = packing.pack(odd, vocabulary, window=256).collect()
    want = sum(len(tokenizer.encode(r.text or "").ids) + 1 for r in odd.collect())
    assert sum(r.length for r in rows) == want
    assert {r.doc_tokens for r in rows if r.doc_id in (2, 3)} == {1}
    single = odd.filter("doc_id > 1")
    ids = {r.doc_id: tokenizer.encode(r.text or "").ids + [0] for r in single.collect()}
    got = packing.pack(single, vocabulary, window=256).collect()
    check_places(got, ids, 256)
    for r in got:
        assert np.frombuffer(r.ids, "<u4").tolist() == ids[r.doc_id][r.start : r.start + r.length]
    assert packing.pack(none, vocabulary).count() == 0
