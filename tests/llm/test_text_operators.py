"""Queries of the operators against SQL, brute force and held-out labels; edge cases."""

import collections
import hashlib
import math
import re

import numpy as np
import oracle
import pytest
import xxhash
from pyspark.sql import functions as F

from sievemark.llm import decontamination, language_id, line_dedup, mixing, pii, quality_rules, queries, simhash
from sievemark.llm import substring_dedup, token_counts, url_filters

FOLDER = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_same_rows_as_sql(spark, name):
    got = oracle.spark_rows(queries.QUERIES[name](spark, FOLDER))
    assert oracle.difference(got, oracle.duck_rows(oracle.connect(FOLDER), queries.ORACLES[name])) is None


# --- SimHash ---------------------------------------------------------------------------------


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    grams = [words] if 0 < len(words) < 3 else [words[i : i + 3] for i in range(len(words) - 2)]
    hashes = [xxhash.xxh64_intdigest(" ".join(g).encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def slow_components(values):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    distinct = sorted(set(values))
    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= 2:
                parent[find(a)] = find(b)
    return {v: find(v) for v in distinct}


def test_simhash_against_brute_force(spark, docs):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op10_simhash(spark, FOLDER).collect()}
    values = {r.doc_id: slow_fingerprint(r.text) for r in docs.collect()}
    roots = slow_components(values.values())
    least = collections.defaultdict(list)
    for d, v in values.items():
        least[roots[v]].append(d)
    assert got == {d: (f"{v:016x}", min(least[roots[v]])) for d, v in values.items()}


@pytest.mark.parametrize("dense", [2, 64])
def test_links_of_dense_clusters(spark, dense):
    random = np.random.default_rng(3)
    centres = [int(x) for x in random.integers(0, 1 << 63, 6)]
    values = set(centres)
    for c in centres:
        for _ in range(60):
            v = c
            for b in random.integers(0, 64, int(random.integers(1, 5))):
                v ^= 1 << int(b)
            values.add(v)
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    links = simhash.near_links(spark.createDataFrame(signed, "fp long"), dense=dense)
    assert links.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) > 2).count() == 0
    got = {r.a: r.b for r in simhash.components(links).collect()}
    roots = slow_components(values)
    groups = collections.defaultdict(set)
    for v in values:
        groups[roots[v]].add(v - (1 << 64) if v >> 63 else v)
    want = {v: min(g) for g in groups.values() for v in g if v != min(g)}
    assert got == want


def test_components_of_a_long_path(spark):
    edges = spark.range(60).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {(r.a, r.b) for r in simhash.components(edges).collect()} == {(i, 0) for i in range(1, 61)}


def test_simhash_odd_rows(odd, none):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    zero = [r for r in rows if r.fingerprint == "0" * 16]
    assert sorted(r.doc_id for r in zero) == [2, 3, 4] and {r.component_id for r in zero} == {2}
    assert {r.component_id for r in rows if r.doc_id is None} == {None}
    kept = simhash.drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    assert sorted(-1 if r.doc_id is None else r.doc_id for r in kept.collect()) == [-1, 1, 2, 5, 6, 7]
    assert simhash.near_duplicates(none).count() == 0 and simhash.drop_near_duplicates(none).count() == 0


# --- Quality rules ---------------------------------------------------------------------------


def test_quality_odd_rows(odd, none):
    rows = quality_rules.quality_rules(odd).collect()
    assert len(rows) == odd.count()
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert by[2].n_words == 0 and by[2].base_failed and not by[2].kept
    assert by[1].n_dup_lines == 2 and by[1].n_repeat_words == 45
    assert by[7].n_words == 3  # only ASCII white space parts words
    kept = quality_rules.keep_quality(odd)
    assert kept.columns == odd.columns
    assert quality_rules.quality_rules(none).count() == 0 and quality_rules.keep_quality(none).count() == 0


def test_quality_keeps_prose_and_drops_junk(docs):
    rows = quality_rules.quality_rules(docs).join(docs.select("doc_id", "text"), "doc_id").collect()
    junk = [r for r in rows if len(re.findall(r"[#$%&*]{3}", r.text)) > r.n_words / 2]
    prose = [r for r in rows if r.n_words >= 30 and r.n_symbols == 0 and r.n_repeat_words == 0]
    assert junk and not any(r.kept for r in junk)
    assert prose and sum(r.kept for r in prose) >= 0.99 * len(prose)


@pytest.mark.parametrize("min_docs", [3, 20])
def test_quality_limits_of_each_source_against_sql(spark, monkeypatch, min_docs):
    """The same SQL where sources are large enough to have limits of their own."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "lang", "source")
    own = quality_rules.adaptive_limits
    monkeypatch.setattr(quality_rules, "adaptive_limits", lambda c, lang, source: own(c, lang, source, min_docs, 1.0, 1.2))
    got = oracle.spark_rows(quality_rules.quality_rules(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"))
    want = oracle.duck_rows(oracle.connect(FOLDER), queries._quality_sql(min_docs, 1.0, 1.2))
    assert oracle.difference(got, want) is None


def test_quality_of_a_hot_source_with_much_junk(spark):
    """A third of all rows come from one source, of which 40 % are symbols, copied lines or repeats: they go, its clean ones stay."""
    random = np.random.default_rng(21)
    word = lambda: "".join(chr(c) for c in random.integers(97, 123, int(random.integers(3, 9))))
    prose = lambda n: " ".join(word() for _ in range(n))
    junk = [
        lambda: " ".join(w + "#$" for w in prose(40).split()),
        lambda: "\n".join([prose(6)] * 2 + [prose(5)] + [prose(7)] * 2 + [prose(8)]) + "\n" + "\n".join([prose(3)] * 9),
    ]
    rows = []
    for i in range(900):
        hot = i % 3 == 0
        bad = hot and i % 15 < 6
        rows.append((i, junk[i % 2]() if bad else prose(60) + ".\n" + prose(30), "en" if i % 2 else "fr", "hot" if hot else f"s{i % 7}", bad))
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, bad boolean")
    kept = {r.doc_id for r in quality_rules.keep_quality(frame).collect()}
    bad = {r[0] for r in rows if r[4]}
    assert len(bad) > 100 and not kept & bad and len(kept) >= 0.98 * (len(rows) - len(bad))


# --- Decontamination -------------------------------------------------------------------------


def slow_hits(text, items):
    words = re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER))
    hit, found = set(), set()
    for item, other in items:
        theirs = re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (other or "").translate(LOWER))
        width = min(10, len(theirs))
        for i in range(len(theirs) - width + 1 if width else 0):
            for j in range(len(words) - width + 1):
                if words[j : j + width] == theirs[i : i + width]:
                    hit.update(range(j, j + width))
                    found.add(item)
    return len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_contamination_against_brute_force(spark, block_bytes):
    long = " ".join(f"w{i}" for i in range(30))
    items = [("1", "Is it?"), ("2", long), ("3", None), ("4", ""), ("5", "is IT, so"), ("6", "é x " * 12), ("null", "lone")]
    texts = [None, "", long.upper() + " is it so", "w5 " + long[3:60], "it is, is\nit", "É x é x é x é x é x é x é x", "lone", "w1 w2"]
    bench = spark.createDataFrame([(None if i == "null" else int(i), t) for i, t in items], "item_id long, text string")
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: tuple(r)[1:] for r in decontamination.contamination(frame, bench, block_bytes=block_bytes).collect()}
    want = {i: slow_hits(t, items) for i, t in enumerate(texts)}
    assert got == {i: (*w, w[1] > 0) for i, w in want.items()}


def test_shift_tables_find_every_place():
    random = np.random.default_rng(5)
    text = bytes(random.choice(list(b"ab "), 3000).tolist())
    patterns = sorted({text[i : i + n] for i, n in zip(random.integers(0, 2900, 40).tolist(), random.integers(3, 60, 40).tolist())})
    table = decontamination.ShiftTable.build(patterns, 4)
    want = sorted((i, p) for p in patterns for i in range(len(text)) if text.startswith(p, i))
    assert sorted(table.search(text)) == want


def test_decontamination_odd_rows(spark, odd, none):
    bench = spark.createDataFrame([(1, "lazy dog near the old")], "item_id long, text string")
    assert sorted(str(r.doc_id) for r in decontamination.contamination(odd, bench).filter("contaminated").collect()) == ["1", "1", "None", "None"]
    kept = decontamination.drop_contaminated(odd, bench)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 4
    assert decontamination.contamination(none, bench).count() == 0
    assert decontamination.contamination(odd, bench.limit(0)).filter("contaminated").count() == 0


# --- Language ID -----------------------------------------------------------------------------


def test_language_of_held_out_documents(spark):
    rows = queries.op1_language_id(spark, "/root/testdata/sf0.01").filter("held_out")
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    both = rows.join(truth, "doc_id").collect()
    assert len(both) > 200 and np.mean([r.lang == r.lang_pred for r in both]) > 0.97
    assert all(0 <= r.score <= 1 for r in both)


@pytest.mark.parametrize("text, letter", [("½ ² 10 ①", False), ("Ⅷ", False), ("١٢ _ 一", True), ("ª", True), ("\u0301 .", False), ("é", True)])
def test_letters_by_category(text, letter):
    assert language_id.has_letter(text) is letter
    model = language_id.train([(b"the of and to", "en"), (b"le la des", "fr")], steps=5)
    assert (model.predict(text.encode())[0] == "und") is not letter


def test_whole_prediction_against_the_definition(docs):
    """Windows, filters one place at a time, maxima, softmax, means by bytes."""
    samples = [(r.text.encode()[:300], r.lang) for r in docs.limit(60).collect()]
    model = language_id.train(samples, steps=40)
    for text in ["Some words of this and that.", "la vie est belle et longue " * 12, "é"]:
        data, step, total = text.lower().encode(), language_id.WINDOW - language_id.OVERLAP, np.zeros(len(model.languages))
        for start in range(0, max(1, len(data) - language_id.OVERLAP), step):
            own = data[start : start + language_id.WINDOW]
            window = own + bytes(language_id.WINDOW - len(own))
            best = np.full(len(language_id.WIDTHS) * language_id.FILTERS, -np.inf)
            for place in range(step):
                column, sums = 0, np.zeros_like(best)
                for k, (first, n) in enumerate(language_id._layout()):
                    sums[first:] += model.table[window[place + k], column : column + n]
                    column += n
                best = np.maximum(best, sums)
            scores = np.maximum(best + model.bias, 0) @ model.weights + model.offset
            total += sum(b != 0 for b in own) * np.exp(scores - scores.max()) / np.exp(scores - scores.max()).sum()
        lang, score = model.predict(text.encode())
        assert lang == model.languages[int(total.argmax())] and score == pytest.approx(total.max() / total.sum(), abs=1e-5)


def test_responses_are_a_convolution():
    random = np.random.default_rng(1)
    columns = sum(n for _, n in language_id._layout())
    table = random.normal(size=(256, columns)).astype(np.float32)
    windows = random.integers(0, 256, (2, language_id.WINDOW), dtype=np.uint8)
    got, i = language_id.responses(table, windows), 17
    for f, width in enumerate(language_id.WIDTHS):
        want, column = 0, 0
        for k, (first, n) in enumerate(language_id._layout()):
            if k < width:
                want = want + table[windows[1, i + k], column + f * language_id.FILTERS - first]
            column += n
        assert abs(got[1, i, f * language_id.FILTERS] - want) < 1e-5


def test_windows_cover_the_text():
    for n in (0, 1, language_id.WINDOW, language_id.WINDOW + 1, 1000):
        data = bytes(random % 255 + 1 for random in range(n))
        windows = language_id.cut(data)
        step = language_id.WINDOW - language_id.OVERLAP
        joined = b"".join(w[:step].tobytes() for w in windows[:-1]) + windows[-1].tobytes()
        assert joined.rstrip(b"\0") == data


def test_language_odd_rows(odd, none):
    samples = [(b"the of and to in that", "en"), ("le la des été où".encode(), "fr")] * 20
    model = language_id.train(samples, steps=60)
    got = {r.doc_id: (r.lang_pred, r.score) for r in language_id.with_language(odd, model).collect()}
    assert got[2] == got[3] == got[4] == ("und", 0.0) and got[6][0] in ("en", "fr")
    assert language_id.with_language(none, model).count() == 0
    assert language_id.training_sample(none, "text", "lang", "doc_id") == []
    empty = language_id.train([])
    assert {r.lang_pred for r in language_id.with_language(odd, empty).collect()} == {"und"}


# --- Token counts ----------------------------------------------------------------------------


def test_token_lengths_against_direct_sums(spark, docs):
    import public_tokenizers as P

    path = str(P.path("byte_bpe_multi_50k.tiktoken"))
    encode = token_counts.tiktoken_encoding(path, P.PATTERN).encode_ordinary
    lengths = collections.defaultdict(list)
    for r in docs.collect():
        lengths[r.lang].append(len(encode(r.text)))
    for r in queries.op2_token_counts(spark, FOLDER).collect():
        own, limit = lengths[r.lang], r.length
        assert r.n_docs == own.count(limit)
        assert (r.docs_over, r.tokens_over) == (sum(n > limit for n in own), sum(n for n in own if n > limit))
        assert r.tokens_truncated == sum(min(n, limit) for n in own) and r.tokens_total == sum(own)
        assert r.rank_share == pytest.approx(sum(n <= limit for n in own) / len(own))


def test_suffix_sums_cross_spans(spark):
    random = np.random.default_rng(2)
    lengths = random.integers(0, 5 * token_counts.SPAN, 400).tolist()
    frame = spark.createDataFrame([(None, n) for n in lengths], "g string, n_tokens long")
    rows = token_counts.context_table(token_counts.length_histogram(frame, ["g"]), ["g"]).collect()
    assert len(rows) == len(set(lengths))
    for r in rows:
        assert (r.docs_over, r.tokens_truncated) == (sum(n > r.length for n in lengths), sum(min(n, r.length) for n in lengths))


def test_tokens_in_pieces_and_odd_rows(odd, none):
    import public_tokenizers as P

    path = str(P.path("byte_bpe_multi_50k.tiktoken"))
    encode = token_counts.tiktoken_encoding(path, P.PATTERN).encode_ordinary
    got = {r.doc_id: r.n_tokens for r in token_counts.with_tokens(odd, path, P.PATTERN).collect()}
    whole = odd.filter("doc_id = 6").first().text
    assert got[6] == len(encode(whole)) and got[2] == got[3] == 0
    assert token_counts.token_lengths(none, path, P.PATTERN, ["lang"]).count() == 0
    assert sum(r.n_docs for r in token_counts.token_lengths(odd, path, P.PATTERN, ["lang"]).collect()) == odd.count()


# --- Line dedup ------------------------------------------------------------------------------


def defined_runs(documents, min_words):
    """Deleted line numbers: all lines of every run with enough words that starts at an earlier line too."""
    seen, gone = set(), collections.defaultdict(set)
    for d, t in enumerate(documents):
        own = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
        for i in range(len(own)):
            runs = [(e, tuple(own[i:e])) for e in range(i + 1, len(own) + 1)]
            for e, run in runs:
                if run in seen and sum(len(x.split()) for x in run) >= min_words:
                    gone[d].update(range(i, e))
            seen.update(run for _, run in runs)
    return gone


def window_runs(documents, min_words):
    """The same by another way: of each line the shortest windows with enough words from it and to it; those seen go."""
    seen, gone = set(), collections.defaultdict(set)
    for d, t in enumerate(documents):
        own = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
        upto = np.cumsum([0, *(len(x.split()) for x in own)])
        enough = [(i, e) for i in range(len(own)) for e in range(i + 1, len(own) + 1) if upto[e] - upto[i] >= min_words]
        shortest = {min(w for w in enough if w[0] == i) for i in {w[0] for w in enough}}
        shortest |= {max(w for w in enough if w[1] == e) for e in {w[1] for w in enough}}
        for i, e in sorted(shortest):
            run = tuple(own[i:e])
            if run in seen:
                gone[d].update(range(i, e))
            seen.add(run)
    return gone


def test_line_runs_against_brute_force(spark):
    random = np.random.default_rng(8)
    pool = [f"line {i} has words" if i % 3 else f"s{i}" for i in range(14)]
    texts = []
    for _ in range(40):
        own = [pool[i] for i in random.integers(0, 14, int(random.integers(0, 9)))]
        if texts and random.random() < 0.5 and texts[-1]:
            own += texts[int(random.integers(len(texts)))].split("\n")
        texts.append("\n".join(own))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.text, r.n_deleted) for r in line_dedup.dedup_lines(frame, min_words=5).collect()}
    gone = defined_runs(texts, 5)
    for d, t in enumerate(texts):
        kept, n = [], 0
        last = False
        for x in t.split("\n"):
            if x.strip():
                last = n in gone[d]
                n += 1
            if not last:
                kept.append(x)
        assert got[d] == ("\n".join(kept), len(gone[d]))


def test_line_runs_with_several_sources(spark):
    random = np.random.default_rng(18)
    pool = [" ".join([f"l{i}"] * (1 + i % 4)) for i in range(7)]
    texts = ["a b c\nd e f\nx", "a b c\nd e f\ng h i", "a b c\nd e f\ng h i"]
    texts += ["\n".join(pool[i] for i in random.integers(0, 7, int(random.integers(0, 12)))) for _ in range(60)]
    for words in (1, 8):
        want = defined_runs(texts, words)
        assert words == 1 or want[2] == {0, 1, 2}
        assert {d: g for d, g in want.items() if g} == {d: g for d, g in window_runs(texts, words).items() if g}
        got = line_dedup.dedup_lines(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), min_words=words)
        for r in got.collect():
            own = texts[r.doc_id].split("\n") if texts[r.doc_id] else []
            assert r.text == "\n".join(x for n, x in enumerate(own) if n not in want[r.doc_id])
            assert r.n_deleted == len(want[r.doc_id])


def test_longest_runs_with_any_earlier_place(spark):
    """Lengths and first places of every suffix, runs of all lengths nested in each other."""
    random = np.random.default_rng(28)
    flat, docs = [], []
    for d in range(30):
        own = random.integers(0, 3, int(random.integers(0, 30))).tolist()
        if docs and random.random() < 0.6:
            other = docs[int(random.integers(len(docs)))]
            own = own[: int(random.integers(0, 4))] + other[int(random.integers(0, len(other) + 1)) :]
        docs.append(own)
        flat += [(d, x) for x in own] + [(d, None)]
    rows = [(p, d, 0, None if x is None else x, None if x is None else 7) for p, (d, x) in enumerate(flat)]
    seq = spark.createDataFrame(rows, "pos long, __row long, ln int, h1 long, h2 long")
    got = {r.pos: (r.len, r.first) for r in line_dedup.repeated_runs(seq).collect()}
    values, want = [x for _, x in flat], {}
    for p in range(len(values)):
        best = (0, 0)
        for q in range(p):
            n = 0
            while p + n < len(values) and values[p + n] is not None and values[p + n] == values[q + n]:
                n += 1
            best = max(best, (n, -q))
        if best[0]:
            want[p] = (best[0], -best[1])
    assert max(n for n, _ in want.values()) >= 9 and got == want


def test_line_dedup_odd_rows(odd, none):
    rows = line_dedup.dedup_lines(odd).collect()
    assert len(rows) == odd.count()
    first = [r for r in rows if r.doc_id == 1]
    assert sorted(r.n_deleted for r in first) == [2, 3]  # the first row keeps one line, its copy none
    assert {r.text for r in rows if r.doc_id == 2} == {None}
    kept = line_dedup.drop_repeated_lines(odd)
    assert kept.columns == odd.columns and kept.filter("doc_id = 1").count() == 1
    assert line_dedup.dedup_lines(none).count() == 0 and line_dedup.drop_repeated_lines(none).count() == 0


# --- Substring dedup -------------------------------------------------------------------------


def test_gear_hash_and_cuts_against_the_definition():
    random = np.random.default_rng(4)
    data = bytes(random.integers(0, 256, 700).tolist())
    h = substring_dedup.gear_hashes(np.frombuffer(data, np.uint8)).tolist()
    slow = []
    for i in range(len(data)):
        slow.append(sum(int(substring_dedup.GEAR[data[i - j]]) << j for j in range(substring_dedup.MEMORY) if i >= j) % (1 << 32))
    assert h == slow
    text = "".join(chr(random.integers(97, 123)) if x % 9 else "é" for x in range(900)).encode()
    h, r = substring_dedup.gear_hashes(np.frombuffer(text, np.uint8)).tolist(), substring_dedup.RADIUS
    want = []
    for i in range(len(h) - 1):
        if all(h[i] < x for x in h[max(0, i - r) : i]) and all(h[i] <= x for x in h[i + 1 : i + 1 + r]):
            c = i + 1
            while c < len(text) and text[c] & 0xC0 == 0x80:
                c += 1
            want.append(c)
    places = substring_dedup.cuts(text)
    assert places == [0, *want, len(text)]
    assert all(text[a:b].decode() is not None for a, b in zip(places, places[1:]))


def test_long_stretches_without_a_cut():
    text = ("é" * 5000).encode()
    places = substring_dedup.cuts(text)
    assert max(b - a for a, b in zip(places, places[1:])) <= substring_dedup.LONGEST
    assert b"".join(text[a:b] for a, b in zip(places, places[1:])) == text


def test_passages_repeat_across_documents(spark):
    random = np.random.default_rng(6)
    word = lambda: "".join(chr(c) for c in random.integers(97, 123, int(random.integers(2, 9))))
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(60) for _ in range(30)]
    rows, with_copy = [], {}
    for i, p in enumerate(passages):
        rows.append((10 * i, prose(80) + " " + p + " " + prose(40)))
        rows.append((10 * i + 1, prose(31) + ". " + p + "! " + prose(90)))
        rows.append((10 * i + 2, prose(150)))
        with_copy[10 * i + 1] = 10 * i
    got = {r.doc_id: r for r in substring_dedup.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    texts = dict(rows)
    for d, r in got.items():
        if d in with_copy:
            assert r.deleted_bytes >= 120 and r.copied_from == [with_copy[d]]
            pieces, at = [], 0
            for s in r.spans:
                pieces.append(texts[d][at : s.start])
                at = s.start + s.bytes
                assert texts[d][s.start : at] in texts[with_copy[d]]
            assert "".join(pieces) + texts[d][at:] == r.text
        else:
            assert r.text == texts[d] and r.n_deleted == 0


def test_substring_odd_rows(odd, none):
    rows = substring_dedup.dedup_substrings(odd).collect()
    assert len(rows) == odd.count()
    copies = [r for r in rows if r.doc_id == 1]
    assert "" in {r.text for r in copies} and any(r.text for r in copies)
    assert {r.text for r in rows if r.doc_id == 2} == {None}
    assert substring_dedup.dedup_substrings(none).count() == 0


# --- Mixing ----------------------------------------------------------------------------------


def test_rates_meet_targets(spark):
    random = np.random.default_rng(9)
    rows = [(int(random.integers(1, 500)), random.dirichlet([0.3, 0.3, 0.3]).tolist()) for _ in range(800)]
    frame = spark.createDataFrame(rows, "n_tokens long, posterior array<double>")
    targets = [0.6, 0.3, 0.1]
    mu = mixing.fit_rates(frame, targets, ridge=1e-4)
    rate = np.maximum(0, 1 - np.array([p for _, p in rows]) @ mu)
    n = np.array([t for t, _ in rows])
    got = (n * rate) @ np.array([p for _, p in rows]) / n.sum()
    assert np.allclose(got, targets, atol=5e-3) and (rate >= 0).all()


def test_rates_are_the_constrained_optimum(spark):
    random = np.random.default_rng(10)
    rows = [(int(random.integers(1, 50)), random.dirichlet([0.5, 0.5]).tolist()) for _ in range(60)]
    p, a = np.array([x for _, x in rows]), np.array([n for n, _ in rows], float)
    a /= a.sum()
    targets, ridge = np.array([0.95, 0.0]), 1e-3
    mu = mixing.fit_rates(spark.createDataFrame(rows, "n_tokens long, posterior array<double>"), targets.tolist(), ridge)
    value = lambda w: 0.5 * ((((a * w) @ p - targets) ** 2).sum() + ridge * (a * (w - 1) ** 2).sum())
    w = np.ones(60)
    for _ in range(60000):  # plain projected gradient
        w = np.maximum(0, w - 0.5 * (p @ ((a * w) @ p - targets) + ridge * (w - 1)))
    assert value(np.maximum(0, 1 - p @ mu)) <= value(w) + 1e-7


def test_domains_of_labelled_documents(spark):
    folder = "/root/testdata/sf0.01"
    rows = queries.op7_mixing(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").collect()
    toxic, clean = [r for r in rows if r.toxic == 1], [r for r in rows if r.toxic == 0 and r.quality == 1]
    assert np.mean([r.copies > 0 for r in clean]) > 0.95
    assert np.mean([r.rate for r in toxic]) < 0.3


def test_precision_follows_the_labels():
    """Labels that words decide get sharp posteriors, labels by chance hardly move them."""
    random = np.random.default_rng(17)
    common, rare = [f"w{i}" for i in range(400)], [f"bad{i}" for i in range(3)]
    clear, chance = [], []
    for i in range(400):
        words = [common[int(k)] for k in random.integers(0, 400, 40)]
        toxic = i % 4 == 0
        chance.append((mixing.features_of(" ".join(words).encode())[0], "toxic" if toxic else "good"))
        clear.append((mixing.features_of(" ".join([*words, *(rare if toxic else [])]).encode())[0], "toxic" if toxic else "good"))
    sharp, blurred = mixing.train_domains(clear[:300]), mixing.train_domains(chance[:300])
    assert mixing.log_loss(sharp, clear[300:]) < 0.1
    weak = mixing.train_domains(chance[:300], decays=(0.002,))
    assert mixing.log_loss(blurred, chance[300:]) < 0.6 * mixing.log_loss(weak, chance[300:])


def test_classifier_against_a_plain_fit():
    """The posterior mode of a small problem, found by plain gradient descent."""
    random = np.random.default_rng(19)
    rows = [(sorted({int(b) for b in random.integers(0, 6, 3)}), "ab"[int(random.random() < 0.3 + 0.1 * (i % 3))]) for i in range(80)]
    model = mixing.train_domains(rows, rounds=3000, rate=0.01, decays=(1.0,), seen=1)
    x = np.zeros((80, 6))
    for i, (b, _) in enumerate(rows):
        x[i, b] = 1
    y, w = np.array([[d == "a", d == "b"] for _, d in rows], float), np.zeros((6, 2))
    offset = np.log((y.sum(axis=0) + 0.5) / 81)
    for _ in range(20_000):
        e = np.exp(x @ w + offset)
        w -= 0.5 * (x.T @ (e / e.sum(axis=1, keepdims=True) - y) + w) / 80
    assert np.allclose(model.weights[:6], w, atol=0.02)


def test_mixing_odd_rows(odd, none):
    model = mixing.train_domains([(mixing.features_of(t)[0], d) for t, d in [(b"fine words here", "good"), (b"vile idiot", "toxic")] * 10])
    out = mixing.mix(odd, model, {"good": 1.0})
    rows = out.collect()
    assert len(rows) == odd.count() and all(r.rate >= 0 and abs(r.copies - r.rate) < 1 for r in rows)
    assert mixing.mix(none, model, {"good": 1.0}).count() == 0
    assert {r.rate for r in mixing.mix(odd, mixing.train_domains([]), {"good": 1.0}).collect()} == {1.0}


# --- PII -------------------------------------------------------------------------------------


def test_surrogates_keep_form_and_identity(spark):
    rows = [
        (1, "Call +1 (743) 555-3824 or 743-555-3824, mail Ann.Lee7@Mail.example.com; Mr. John Smith, MRS SMITH."),
        (2, "ann.lee7@mail.example.com 4539 1488 0343 6467 4539148803436467 10.0.0.7 123-45-6789"),
        (3, "Г-жа Анна Иванова, Господин Иванов; token = 24be64439e3e49cf46b2d7c90f3602a3d0b907ff"),
        (4, "Version 2.0 of 2024, chapter 12."), (5, None), (6, ""),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in pii.replace_pii(frame, "k").collect()}
    assert [got[i].text for i in (4, 5, 6)] == [rows[3][1], None, ""]
    one = re.fullmatch(r"Call \+1 \((\d{3})\) (\d{3})-(\d{4}) or (\d{3})-(\d{3})-(\d{4}), mail (\S+@\S+); Mr\. (\w+) (\w+), MRS (\w+)\.", got[1].text)
    assert one[1] + one[2] + one[3] == one[4] + one[5] + one[6] != "7435553824"
    assert one[9].upper() == one[10] and "SMITH" not in got[1].text.upper()
    mail, spaced, plain, ip, ssn = re.fullmatch(r"(\S+) (\d{4} \d{4} \d{4} \d{4}) (\d{16}) ([\d.]+) (\d{3}-\d{2}-\d{4})", got[2].text).groups()
    assert mail == one[7].lower() and re.fullmatch(r"[a-z]{3}\.[a-z]{3}\d@\w+\.com", mail)
    assert spaced.replace(" ", "") == plain and plain[0] == "4" and ssn != "123-45-6789" and ip != "10.0.0.7"
    assert sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(plain))) % 10 == 0
    assert re.fullmatch(r"Г-жа [А-Я][а-я]+я [А-Я][а-я]+нова, Господин [А-Я][а-я]+нов; token = [0-9a-f]{40}", got[3].text)
    again = {r.doc_id: r.text for r in pii.replace_pii(frame, "k").collect()}
    other = {r.doc_id: r.text for r in pii.replace_pii(frame, "l").collect()}
    assert again == {d: r.text for d, r in got.items()} and other[1] != again[1]


def test_colliding_surrogates_are_told_apart(spark):
    """Short local parts have few surrogates, so that many would meet."""
    mails = [f"a{i}@x.org" for i in range(10)] + [f"{c}{d}@x.org" for c in "bcdefghij" for d in range(10)]
    frame = spark.createDataFrame([(i, f"{m} {m}") for i, m in enumerate(mails)], "doc_id long, text string")
    new = [r.text.split() for r in pii.replace_pii(frame, "k").collect()]
    assert all(a == b for a, b in new) and len({a for a, _ in new}) == len(mails)
    assert not {a for a, _ in new} & set(mails)


def test_pii_on_documents_and_odd_rows(docs, odd, none):
    clean = re.compile(r"\d{16}|@|\d{1,3}(\.\d{1,3}){3}|555-\d{4}|[0-9a-f]{40}")
    before = {r.doc_id: r.text for r in docs.collect()}
    for r in pii.replace_pii(docs, "k").collect():
        marks = [m.group() for m in clean.finditer(before[r.doc_id])]
        if not marks:
            assert r.text == before[r.doc_id] and r.n_entities == 0
        for m in marks:
            assert m == "@" or m not in r.text
    assert pii.replace_pii(odd, "k").count() == odd.count()
    assert pii.replace_pii(none, "k").count() == 0


# --- URL filters -----------------------------------------------------------------------------


def test_beta_functions():
    assert url_filters.beta_cdf(0.5, 2.0, 2.0) == pytest.approx(0.5)
    assert url_filters.beta_cdf(0.3, 1.0, 3.0) == pytest.approx(1 - 0.7**3)
    draws = np.random.default_rng(1).beta(3.5, 12, 400_000)
    for p in (0.05, 0.5, 0.9):
        assert url_filters.beta_quantile(p, np.array([3.5]), np.array([12.0]))[0] == pytest.approx(np.quantile(draws, p), abs=2e-3)


def slow_rule(url):
    m = re.match(r"(?s)(.*?)://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[2].translate(LOWER), m[3]) if m else ("", "")
    best = None
    for r in queries.URL_RULES:
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path) and (not best or len(r.text) > len(best.text)):
            best = r
    return host, path, best


def test_url_rules(spark):
    urls = [
        None, "", "no-scheme.com/x", "http://com/a", "http://A.Example.COM/en/1?x#y", "http://www.example.com/en/", "x://www.example.com/enx",
        "https://b.net/es/q", "https://b.net/ES/q", "http://net/fr/", "http://a.com", "http://a.com?x/en/", "a://b://c.com/", "http://xcom/",
    ]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    labels = spark.createDataFrame([(0, 0, None), (1, None, None)], "doc_id long, quality int, toxic int")
    for r in url_filters.url_filter(pages, labels, queries.URL_RULES).collect():
        host, path, rule = slow_rule(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule and rule.text)
        assert r.verdict == (rule.verdict if rule else "allow")


def test_reputation_blocks_bad_hosts(spark):
    rows = [(f"good{i % 40}.example.org", int(i % 25 == 0)) for i in range(4000)] + [("bad.example.org", int(i % 10 > 0)) for i in range(200)]
    rows += [("few.example.org", 1)] * 2 + [("none.example.org", None)]
    got = {r.host: r for r in url_filters.host_reputation(spark.createDataFrame(rows, "host string, bad int")).collect()}
    assert got["bad.example.org"].low > 0.5 > got["few.example.org"].low
    assert all(got[f"good{i}.example.org"].low < 0.2 for i in range(40))
    assert got["none.example.org"].n == 0 and 0 < got["none.example.org"].rate < 1
    levels = {r.host: (r.domain, r.suffix) for r in url_filters.with_levels(spark.createDataFrame([("a.b.co.uk",), ("co.uk",), ("x",), ("",), ("m.a.org",)], "host string")).collect()}
    assert levels == {"a.b.co.uk": ("b.co.uk", "co.uk"), "co.uk": ("co.uk", "uk"), "x": ("x", "x"), "": ("", ""), "m.a.org": ("a.org", "org")}


def slow_reputation(outcomes, bound=0.05, prior=(1.0, 9.0)):
    """Rates and lower bounds by plain loops; the bound by adding up the posterior density on a fine grid."""
    hosts = collections.defaultdict(lambda: [0, 0])
    for host, bad in outcomes:
        hosts[host][0] += bad is not None
        hosts[host][1] += bad or 0

    def levels(host):
        parts = host.split(".")
        two = ".".join(parts[-2:])
        long = len(parts) > 2 and (len(parts[-1]) == 2 and parts[-2] in url_filters.SECOND_LABELS or two in url_filters.SHARED_HOSTS)
        return (".".join(parts[-3:]) if long else two), (two if long else parts[-1])

    def summed(key):
        out = collections.defaultdict(lambda: [0, 0])
        for host, (n, bad) in hosts.items():
            out[key(host)][0] += n
            out[key(host)][1] += bad
        return out

    def strength(groups):
        values = []
        for s, leaning in zip(url_filters.STRENGTHS, url_filters._LEANING):
            total = leaning
            for n, bad, mean in groups:
                if n:
                    mean = min(max(mean, 1e-9), 1 - 1e-9)
                    a, b = mean * s, s - mean * s
                    total += math.lgamma(a + bad) - math.lgamma(a) + math.lgamma(b + n - bad) - math.lgamma(b) - math.lgamma(s + n) + math.lgamma(s)
            values.append(total)
        return float(url_filters.STRENGTHS[int(np.argmax(values))])

    every = [sum(x) for x in zip(*hosts.values())]
    suffixes, domains = summed(lambda h: levels(h)[1]), summed(lambda h: levels(h)[0])
    mean_s = {s: (every[1] + prior[0] - bad) / (every[0] + sum(prior) - n) for s, (n, bad) in suffixes.items()}
    top = strength([(*c, mean_s[s]) for s, c in suffixes.items()])
    of = {d: s for d, s in (levels(h) for h in hosts)}
    mean_d = {d: (mean_s[of[d]] * top + suffixes[of[d]][1] - bad) / (suffixes[of[d]][0] - n + top) for d, (n, bad) in domains.items()}
    mid = strength([(*c, mean_d[d]) for d, c in domains.items()])
    mean_h = {}
    for h, (n, bad) in hosts.items():
        d = levels(h)[0]
        mean_h[h] = (mean_d[d] * mid + domains[d][1] - bad) / (domains[d][0] - n + mid)
    own = strength([(*c, mean_h[h]) for h, c in hosts.items()])
    out = {}
    for h, (n, bad) in hosts.items():
        a, b = mean_h[h] * own + bad, (1 - mean_h[h]) * own + n - bad
        # the variable is raised to a power, so that the density has no pole
        grid = (np.arange(200_000) + 0.5) / 200_000
        x = grid ** max(1.0, 1 / a)
        density = np.exp((a - 1) * np.log(x) + (b - 1) * np.log1p(-x)) * max(1.0, 1 / a) * grid ** (max(1.0, 1 / a) - 1)
        share = np.cumsum(density) / density.sum()
        out[h] = ((mean_h[h] * own + bad) / (n + own), float(x[np.searchsorted(share, bound)]))
    return out


def test_reputation_against_plain_loops(spark):
    random = np.random.default_rng(31)
    names = [f"{a}{b}" for a in ("", "www.", "m.") for b in ("x.com.mx", "y.com.mx", "z.co.za", "a.github.io", "b.github.io", "q.org", "r.org", "solo", "")]
    share = {n: random.random() * 0.6 for n in names}
    rows = [(n, None if random.random() < 0.2 else int(random.random() < share[n])) for n in names for _ in range(int(random.integers(1, 30)))]
    got = {r.host: (r.rate, r.low) for r in url_filters.host_reputation(spark.createDataFrame(rows, "host string, bad int")).collect()}
    want = slow_reputation(rows)
    assert set(got) == set(want)
    for h in want:
        assert got[h] == pytest.approx(want[h], abs=2e-3), h


@pytest.mark.parametrize("host, domain, suffix", [
    ("shop.acme.com.mx", "acme.com.mx", "com.mx"), ("acme.co.za", "acme.co.za", "co.za"), ("me.github.io", "me.github.io", "github.io"),
    ("github.io", "github.io", "io"), ("www.co.de", "www.co.de", "co.de"), ("a.b.com", "b.com", "com"), ("x.y.de", "y.de", "de"),
])
def test_suffixes_of_unrelated_sites(spark, host, domain, suffix):
    row = url_filters.with_levels(spark.createDataFrame([(host,)], "host string")).first()
    assert (row.domain, row.suffix) == (domain, suffix)


@pytest.mark.parametrize("hot", [0, 12000])
@pytest.mark.parametrize("single", [False, True])
def test_reputation_under_skew(spark, hot, single):
    """A bad host is blocked and unknown ones pass, also beside a very large host or one host to a domain."""
    name = (lambda i: f"www.site{i}.org") if single else (lambda i: f"h{i}.example.org")
    counts = [(name(i), 40, int(i % 10 == 0)) for i in range(500)] + [(name(900), 60, 60), (name(901), 1, 1), (name(902), 0, 0)]
    counts += [(name(903), hot, 0)] * (hot > 0)
    rows = [(h, int(j < bad)) for h, n, bad in counts for j in range(n)] + [(name(902), None)]
    got = {r.host: r for r in url_filters.host_reputation(spark.createDataFrame(rows, "host string, bad int")).collect()}
    assert got[name(900)].low > 0.5
    assert all(r.low < 0.5 for h, r in got.items() if h != name(900))
    assert got[name(902)].rate < 0.05


def test_url_filter_odd_tables(spark):
    pages = spark.createDataFrame([(1, "http://a.org/"), (1, "http://a.org/"), (None, None)], "page_id long, url string")
    labels = spark.createDataFrame([(1, 0, 1), (1, 1, 0), (None, 0, 0)], "doc_id long, quality int, toxic int")
    assert url_filters.url_filter(pages, labels, ()).count() == 3
    assert url_filters.url_filter(pages.limit(0), labels, ()).count() == 0
    assert {r.verdict for r in url_filters.url_filter(pages, labels.limit(0), ()).collect()} == {"allow"}
