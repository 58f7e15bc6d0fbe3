import csv
import gzip
import hashlib
import json
from contextlib import contextmanager

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievemark import session
from sievemark.functions import file_chain, text
from sievemark.functions.hashing import file_hashes
from sievemark.operators.impute import fill_plan
from sievemark.sources import csv_records, readers, sinks
from sievemark.streaming import streams


def test_csv(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("Name,Price,When,Maybe\na,1.5,2020-01-02,1\nb,NA,2020-01-03,\nc,2,2020-01-04,3\nd,4,2020-01-05,4\n")
    df = readers.read_csv(spark, str(path))
    assert dict(df.dtypes) == {"Name": "string", "Price": "double", "When": "timestamp", "Maybe": "double"}
    assert df.filter("Price IS NULL").count() == 1


@pytest.mark.parametrize("content,columns,rows", [
    ([{"a": 1, "b": {"c": 2}}, {"a": 3, "b": {"c": 4}}], ["a", "b.c"], 2),
    ({"meta": "m", "records": [{"x": 1}, {"x": 2}, {"x": 3}]}, ["x"], 3),
    ({"name": "n", "numbers": [1, 2], "deep": {"er": {"k": 1}}}, ["numbers"], 2),
    ({"a": 1, "b": {"c": 2}}, ["a", "b.c"], 1),
])
def test_json_shapes(spark, tmp_path, content, columns, rows):
    path = tmp_path / "t.json"
    path.write_text(json.dumps(content))
    df = readers.read_json(spark, str(path))
    assert df.columns == columns and df.count() == rows


def test_json_wrapper_order(spark, tmp_path):
    path = tmp_path / "t.json"
    path.write_text(json.dumps({"items": [{"i": 1}], "data": [{"d": 1}, {"d": 2}]}))
    assert readers.read_json_wrapped(spark, str(path)).columns == ["d"]


def test_ragged_lines(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("a,b\n1,2\n3,4,5\n6\n")
    df = readers.read_csv_ragged(spark, str(path), "a int, b int")
    assert [(r["a"], r["b"]) for r in df.orderBy("a").collect()] == [(1, 2), (3, 4), (6, None)]
    assert readers.quarantine(df, "t.csv").count() == 2
    assert readers.read_csv_tolerant(spark, str(path), "a int, b int").collect()[0]["a"] == 1


def test_shape_gate(spark):
    assert not readers.gate_min_shape(spark.range(5)).first()["accepted"]
    assert readers.gate_min_shape(spark.range(3).withColumn("x", F.lit(1))).first()["accepted"]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "train"), (2, "test")], "x int, split string")
    sinks.sink_splits(df, str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s/split=train")).count() == 1
    sinks.csv_export(df, str(tmp_path / "e"))
    assert spark.read.csv(str(tmp_path / "e"), header=True).count() == 2


def test_quoted_cells_survive_a_round_trip(spark, tmp_path):
    rows = [(1, 'a "b"\nc'), (2, " x,y "), (3, "\\"), (4, None)]
    sinks.sink_csv(spark.createDataFrame(rows, "k int, t string"), str(tmp_path / "q"))
    assert sorted((r["k"], r["t"]) for r in readers.read_csv(spark, str(tmp_path / "q")).collect()) == rows


@pytest.fixture()
def small_blocks(spark):
    """Files are cut into blocks of a few bytes."""
    settings = {"spark.sql.files.maxPartitionBytes": "120", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def quoted_rows(seed, n=40):
    random = np.random.default_rng(seed)
    words = ["plain", 'a "b"', "x,y", "two\nlines", "\n", "\r\n end", "", "é漢", '"', "many\n\n\nlines\n" * 6, " pad "]
    return [(i, words[int(random.integers(len(words)))], words[int(random.integers(len(words)))]) for i in range(n)]


@pytest.mark.parametrize("ends", ["\n", "\r\n"])
def test_records_over_many_blocks(spark, tmp_path, small_blocks, ends):
    """Quoted line breaks, records over several blocks, several files, against Python's reader."""
    want = []
    for i in range(3):
        rows = [(k + 1000 * i, a, b) for k, a, b in quoted_rows(i)]
        with open(tmp_path / f"{i}.csv", "w", newline="", encoding="utf-8") as file:
            out = csv.writer(file, lineterminator=ends, quoting=csv.QUOTE_ALL)
            out.writerow(["key", "first\nname", "second"])
            out.writerows(rows)
        want += rows
    lines = csv_records.lines_of(spark, str(tmp_path))
    blocks = csv_records.survey(lines)
    assert len(blocks.inside) > 8 and lines.select("file", "block").distinct().count() > 25
    records = csv_records.csv_records(lines, blocks)
    assert records.filter("first").count() == 3
    assert set(csv_records.headers_of(records, blocks).values()) == {'"key","first\nname","second"'}
    assert csv_records.names_of('"key","first\nname",,key') == ["key0", "first\nname", "_c2", "key3"]
    got = readers.read_csv(spark, str(tmp_path), "key long, a string, b string")
    plain = lambda t: t.replace("\r\n", "\n")  # noqa: E731  the parser writes line breaks in values as one character
    assert sorted((r.key, plain(r.a or ""), plain(r.b or "")) for r in got.collect()) == sorted((k, plain(a), plain(b)) for k, a, b in want)
    folder = readers.read_folder(spark, str(tmp_path), "key long, a string, b string")
    assert folder.groupBy("_file").count().count() == 3 and folder.count() == len(want)


def test_tolerant_and_ragged_take_line_breaks(spark, tmp_path, small_blocks):
    path = tmp_path / "t.csv"
    path.write_bytes(b'a,b\n1,"x\ny"\n2,"p\nq",3\n\n4\n"5","bad \xff byte\nhere"\n6,"never closed\n7,z\n')
    got = readers.read_csv_tolerant(spark, str(path), "a int, b string").collect()
    assert [(r.a, r.b) for r in sorted(got)][:2] == [(1, "x\ny"), (5, "bad \ufffd byte\nhere")]
    ragged = readers.read_csv_ragged(spark, str(path))
    assert ragged.columns == ["a", "b", csv_records.CORRUPT]
    bad = {r.reason for r in readers.quarantine(ragged, "t").collect()}
    assert {'malformed line: 2,"p\nq",3', "malformed line: 4"} <= bad


def files_of_bytes(folder):
    """Files whose lines end in every way, below, at and above 1,000 bytes; the md5 of each."""
    random = np.random.default_rng(5)
    noise = lambda n: random.integers(0, 256, n, dtype=np.uint8).tobytes()
    mark = b"\xef\xbb\xbf"
    contents = {
        "small": noise(300), "at": noise(1000), "over": noise(1001), "double": noise(2000), "large": noise(12_000),
        "ended": noise(4999) + b"\n", "open": noise(4999) + b"x", "ends": b"\n" * 3000, "crlf": b"a\r\n\r\r\nb\x00" * 500,
        "mark": mark + noise(3000) + b"x", "mark ended": mark + noise(3000) + b"\n", "marks": mark * 700, "mark, end": mark + b"\n" * 1500,
        "one line": b"z" * 7000, "late end": b"z" * 5000 + b"\n" + b"y" * 40, "50%20 [a] {b}": noise(2500), "sub/large": noise(3333),
        "sub/same": b"same\n" * 999, "same": b"same\n" * 999,
    }
    for name, content in contents.items():
        (folder / name).parent.mkdir(exist_ok=True)
        (folder / name).write_bytes(content)
    return {name: (len(content), hashlib.md5(content).hexdigest()) for name, content in contents.items()}


def hashes_below(folder, df):
    rows = df.collect()
    found = {r.path.removeprefix(f"file:{folder}/"): (r.length, r.md5) for r in rows}
    assert len(found) == len(rows)
    return found


@contextmanager
def settings(spark, **values):
    names = {f"spark.sql.{k.replace('__', '.')}": str(v) for k, v in values.items()}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k in names:
            spark.conf.unset(k)


def test_large_files_are_hashed_by_turns(spark, tmp_path):
    """The binary reader refuses whole files over its limit, of 2 GB by default."""
    want = files_of_bytes(tmp_path)
    with settings(spark, sources__binaryFile__maxLength=1000, files__maxPartitionBytes=4000, files__openCostInBytes=1):
        assert hashes_below(tmp_path, file_hashes(spark, str(tmp_path), 1000)) == want
    assert hashes_below(tmp_path, file_hashes(spark, str(tmp_path))) == want


def test_a_turn_is_no_larger_than_asked(spark, tmp_path, monkeypatch):
    """Also where the reader's blocks are larger."""
    (tmp_path / "lines").write_bytes(b"123456789\n" * 100_000)
    taken, advanced = [], file_chain._advanced

    def spied(pieces, *rest):
        taken.append(pieces.agg(F.sum("size")).first()[0])
        return advanced(pieces, *rest)

    monkeypatch.setattr(file_chain, "_advanced", spied)
    with settings(spark, execution__arrow__maxRecordsPerBatch=500):
        rows = file_hashes(spark, str(tmp_path), 100_000).collect()
    assert rows[0].md5 == hashlib.md5(b"123456789\n" * 100_000).hexdigest()
    assert len(taken) == 10 and max(taken) <= 105_000


def test_a_line_longer_than_a_piece(spark, tmp_path):
    content = b"ab\n" * 9 + np.random.default_rng(2).bytes(4_500_000).replace(b"\n", b"") + b"\n" + b"c\n" * 300_000
    (tmp_path / "long").write_bytes(content)
    want = {"long": (len(content), hashlib.md5(content).hexdigest())}
    with settings(spark, files__maxPartitionBytes=700_000):
        assert hashes_below(tmp_path, file_hashes(spark, str(tmp_path), 1_000_000)) == want


def test_packed_files_are_hashed_as_they_lie(spark, tmp_path):
    (tmp_path / "a.gz").write_bytes(gzip.compress(np.random.default_rng(1).bytes(9000)))
    (tmp_path / "b").write_bytes(b"x\n" * 2000)
    want = {p.name: (p.stat().st_size, hashlib.md5(p.read_bytes()).hexdigest()) for p in tmp_path.iterdir()}
    assert hashes_below(tmp_path, file_hashes(spark, str(tmp_path), 500)) == want


def test_a_hash_goes_on_from_its_state():
    first = file_chain.Chain()
    first.update(b"abc" * 50)
    second = file_chain.Chain(first.state())
    second.update(b"def")
    assert second.hexdigest() == second.hexdigest() == hashlib.md5(b"abc" * 50 + b"def").hexdigest()


def test_csv_of_nothing(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "head.csv").write_text("a,b\n")
    assert readers.read_csv(spark, str(tmp_path / "empty.csv"), "a int").count() == 0
    found = readers.read_csv(spark, str(tmp_path / "head.csv"))
    assert found.columns == ["a", "b"] and found.count() == 0


def test_first_list_key_of_a_record(spark, tmp_path):
    path = tmp_path / "r.json"
    path.write_text('{"name": "x", "quarters": [5, 7], "more": {"z": 1}, "markets": ["a", "b", "c"]}')
    assert [r["quarters"] for r in readers.read_json(spark, str(path)).collect()] == [5, 7]
    (tmp_path / "one.json").write_text('[{"k": 1, "list": [{"x": 1}, {"x": 2}]}]')  # a list of one record stays one row
    assert readers.read_json(spark, str(tmp_path / "one.json")).count() == 1


def test_all_files_are_stacked(spark, tmp_path):
    for i in range(12):
        (tmp_path / f"{i}.csv").write_text(("b,a\n1,%d\n" if i % 2 else "a,b\n%d,1\n") % i)
    df = readers.union_files(spark, [str(tmp_path / f"{i}.csv") for i in range(12)])
    assert sorted(r["a"] for r in df.collect()) == list(range(12))
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 4  # whole records and sewn ones of two headers


@pytest.mark.parametrize("function,raw,clean", [
    (text.strip_tags, " <b>x</b> <br/>y ", "x y"), (text.strip_tags, "<i>nan</i>", None),
    (text.safe_detail, " ['a'|b\\c] ", "(a•b/c)"), (text.safe_markdown, "# a|b", " # a•b"),
    (text.strip_control, "a\r\nb\x00\t‮c​", "a\nb\tc"),
])
def test_text(spark, function, raw, clean):
    assert spark.createDataFrame([(raw,)], "t string").select(function(F.col("t"))).first()[0] == clean


def test_scratch_comes_from_the_session(spark):
    assert session.scratch_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_scope_deletes_what_was_written_in_it(spark, tmp_path):
    from pathlib import Path

    root = Path(session.scratch_root(spark).removeprefix("file:"))
    kept = session.materialize(spark.range(5), "kept")
    before = set(root.iterdir())
    with session.scratch_scope(spark):
        inner = session.materialize(spark.range(7), "gone")
        with session.scratch_scope(spark):
            assert session.materialize(inner, "deeper").count() == 7
        assert len(set(root.iterdir()) - before) == 1
        inner.write.parquet(str(tmp_path / "out"))
    assert set(root.iterdir()) == before and kept.count() == 5 and spark.read.parquet(str(tmp_path / "out")).count() == 7


def test_stream_equals_batch(spark, tmp_path):
    df = spark.range(300).select(
        "id", F.when(F.col("id") % 3 != 0, F.col("id") * 1.0).alias("x"), F.timestamp_seconds(F.col("id") * 60).cast("timestamp_ntz").alias("ts"))
    folder = tmp_path / "in"
    for i, part in enumerate(df.randomSplit([1.0, 1.0, 1.0], 3)):
        part.coalesce(1).write.parquet(str(folder / f"p{i}"))
    files = spark.readStream.schema(df.schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(str(folder))
    plan = fill_plan(df, "median")
    got = streams.drain(streams.stream_clean(files, plan), "t-clean")
    assert got.filter("x IS NULL").count() == 0 and got.count() == 300
    once = streams.drain(streams.stream_dedup(files.withColumn("k", F.col("id") % 10), ["k"], "ts", "30 days"), "t-dedup")
    assert once.count() == 10
    hours = streams.drain(streams.stream_profile(files, "ts", "x", "1 hour", lateness="10 days"), "t-hours")
    assert hours.columns[:2] == ["window_start", "window_end"]
