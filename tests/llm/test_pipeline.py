"""The pipeline on a small fixture whose outcome is known, and on the supplied tables."""

import numpy as np
import pytest

import corpus_pipeline
from sievemark.llm import simhash


def two_bits_away(text):
    """The text with another last word, at two differing bits."""
    own = simhash.fingerprint(text.encode())
    words = text.split(" ")
    for i in range(10_000):
        other = " ".join([*words[:-1], f"other{i}"])
        if ((own ^ simhash.fingerprint(other.encode())) & (1 << 64) - 1).bit_count() == 2:
            return other
    raise AssertionError("no such word")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    random = np.random.default_rng(12)
    vocabulary = ["".join(chr(c) for c in random.integers(97, 123, int(random.integers(3, 9)))) for _ in range(900)]
    prose = lambda n: " ".join(vocabulary[i] for i in random.integers(0, 900, n))
    item = prose(30)
    rows = {}
    for i in range(120):
        rows[i] = prose(50) + ".\n" + prose(60) + "."
    shared = "all rights reserved by the makers of this very long shared line"
    for i in range(20, 30):
        rows[i] += "\n" + shared
    rows[200] = rows[3]  # a copy
    rows[201] = rows[4].replace("\n", " ").title()  # the same words on one line
    rows[205] = two_bits_away(rows[5].replace("\n", " "))
    rows[202] = prose(30) + " " + item[10:] + " " + prose(30)
    rows[203] = " ".join(w + "###" for w in prose(60).split())
    rows[204] = "too short"
    for i in range(300, 340):
        rows[i] = prose(40) + " vileword nastyword " + prose(40)
    docs = [(d, t, "en", f"s{d % 3}", len(t)) for d, t in rows.items()]
    out = tmp_path_factory.mktemp("pipeline")
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{out}/benchmark.parquet")
    labels = [(d, 1, 1 if d >= 300 else 0) for d in rows if d < 110 or d >= 300]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{out}/labels.parquet")
    return str(out), rows, shared


def test_stages_do_their_work(spark, folder):
    path, rows, shared = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns, left = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        out = f"{path}/out-{len(left)}"
        stage(spark, docs, path).write.parquet(out)
        docs = spark.read.parquet(out)
        left.append({r.doc_id: r.text for r in docs.collect()})
        if len(left) < len(corpus_pipeline.STAGES):
            assert docs.columns == columns
    every = set(rows)
    assert set(left[0]) == every - {203, 204}
    assert set(left[1]) == set(left[0]) - {200}
    assert [shared in left[1][d] for d in range(20, 30)] == [True] + [False] * 9
    assert all(left[1][d] == rows[d] for d in left[1] if not 20 < d < 30)
    gone = set(left[1]) - set(left[2])
    assert gone == {201, 205}
    assert set(left[3]) == set(left[2]) - {202}
    toxic = {d for d in left[3] if d >= 300}
    assert len(toxic & set(left[4])) <= len(toxic) / 10
    assert set(left[3]) - toxic - set(left[4]) == set()


def test_run_on_the_supplied_tables(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert {"doc_id", "text", "rate", "copies"} <= set(out.columns)
    kept = out.count()
    assert 50 < kept < 200


def test_near_dedup_takes_the_planted_near_copies(spark, folder):
    path, rows, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet").filter("doc_id IN (3, 4, 5, 6, 201, 205)")
    left = {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, path).collect()}
    assert left == {3, 4, 5, 6}


def test_run_on_empty_tables(spark, folder, tmp_path):
    path, _, _ = folder
    for name in ("documents", "benchmark", "labels"):
        spark.read.parquet(f"{path}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert {"doc_id", "text", "rate", "copies"} <= set(out.columns) and out.count() == 0


def test_run_keeps_odd_rows_apart(spark, odd, folder, tmp_path):
    path, _, _ = folder
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    odd.select(*columns).unionByName(spark.read.parquet(f"{path}/documents.parquet").filter("doc_id >= 20")).write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("benchmark", "labels"):
        spark.read.parquet(f"{path}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    kept = [r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()]
    assert len(kept) == len(set(kept)) and None not in kept and {6, 40, 50} <= set(kept)
