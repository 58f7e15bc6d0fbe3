"""Line dedup: repeated runs of lines from the suffixes of the line sequence, by distributed prefix doubling.

The lines of all documents form one sequence, documents in the order of their ids, with a mark behind each. A suffix
starts at each line. Doubling round k groups the suffixes that share their first 2^k lines: an interval of the
suffix array whose longest common prefix is 2^k lines or more, named by its first place. Suffixes alone in
their group are settled and leave the work. The rounds in reverse then split these into the intervals for the lengths between, so that each suffix
comes to the deepest interval that has an earlier place: the longest prefix it shares with any of them. Order
among intervals is never needed, only which suffixes lie in one.

The earliest place of a prefix shares less than that with places before it, so at each step it stands in the same
interval as those that look for it, or is the first of it. These two kinds of rows are all that a step compares.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemark.llm.common import BATCH, ROW, apart, per_text, small_batches, texts_of, with_rows
from sievemark.session import materialize

_LINES = f"{ROW} long, doc_id long, ln int, h1 long, h2 long"


def split_lines(rows: DataFrame, text: str, doc_id: str) -> DataFrame:
    """A row per line with a word: its number among these and a 128-bit digest. One more row per
    document, with null digests, ends its lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, BATCH):
                batch = whole.slice(start, BATCH)
                counts, digests = [], bytearray()
                for t in texts_of(batch, "__text"):
                    own = [xxhash.xxh3_128_digest(line) for line in (t or b"").split(b"\n") if line.strip()]
                    digests += b"".join(own) + bytes(16)
                    counts.append(len(own) + 1)
                ends = np.cumsum(counts)
                numbers = np.arange(ends[-1]) - np.repeat(ends - counts, counts)
                none = np.zeros(ends[-1], bool)
                none[ends - 1] = True
                of = pa.array(np.repeat(np.arange(batch.num_rows), counts))
                pair = np.frombuffer(bytes(digests), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(of), batch.column(1).take(of), pa.array(numbers, pa.int32()),
                        pa.array(pair[:, 0], pa.int64(), mask=none), pa.array(pair[:, 1], pa.int64(), mask=none),
                    ],
                    names=[ROW, "doc_id", "ln", "h1", "h2"],
                )

    needed = rows.select(ROW, F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("__text"))
    return small_batches(needed).mapInArrow(run, _LINES)


def sequence(lines: DataFrame) -> DataFrame:
    """Append ``pos``: consecutive within a document, growing with (doc_id, row); null ids come last."""
    order = [F.col("doc_id").asc_nulls_last(), F.col(ROW)]
    dealt = materialize(lines, "lines").repartitionByRange(*order).sortWithinPartitions(*order, "ln")
    return materialize(dealt.withColumn("pos", F.monotonically_increasing_id()).drop("doc_id"), "line-sequence")


def _intervals(suffixes: DataFrame, keys: list[str]) -> DataFrame:
    """(pos, name): suffixes that share their keys with another, named by the first of them."""
    shared = suffixes.groupBy(*keys).agg(F.min("pos").alias("__first"), F.count("*").alias("__n")).filter("__n > 1")
    shared = apart(shared.drop("__n"), "line-firsts")
    return materialize(suffixes.join(shared, keys).select("pos", F.col("__first").alias("name")), "line-intervals")


def doubling_rounds(seq: DataFrame) -> list[DataFrame]:
    """Interval names for prefixes of 1, 2, 4, ... lines, as long as any has two suffixes.

    A prefix of 2^(k+1) lines can only repeat where both its halves do, so each round works on what the last has
    left. A mark is in no interval, so no prefix reaches over the end of its document.
    """
    rounds = [_intervals(seq.filter("h1 IS NOT NULL").select("pos", "h1", "h2"), ["h1", "h2"])]
    while True:
        here = rounds[-1]
        ahead = here.select((F.col("pos") - (1 << len(rounds) - 1)).alias("pos"), F.col("name").alias("next"))
        longer = _intervals(materialize(here.join(ahead, "pos"), "line-pairs"), ["name", "next"])
        if longer.isEmpty():
            return rounds
        rounds.append(longer)


def repeated_runs(seq: DataFrame) -> DataFrame:
    """(pos, first, len): the longest run of lines at ``pos`` that stands at any earlier place, and the first such place."""
    rounds = doubling_rounds(seq)
    earlier = None
    for k, names in enumerate(rounds):
        mine = names.filter("name < pos").withColumn("k", F.lit(k))
        earlier = mine if earlier is None else earlier.unionAll(mine)
    runs = earlier.groupBy("pos").agg(F.max("k").alias("k"), F.max_by("name", "k").alias("first"))
    runs = materialize(runs.withColumn("len", F.expr("shiftleft(1L, k)")), "line-runs")
    for step in range(len(rounds) - 2, -1, -1):
        trying = runs.filter(F.col("k") > step)
        sought = trying.select("pos", "first", "len").unionAll(trying.select(F.col("first").alias("pos"), "first", "len").distinct())
        names = rounds[step].select(F.col("pos").alias("__at"), F.col("name").alias("next"))
        met = materialize(sought.join(names, F.col("pos") + F.col("len") == F.col("__at")).drop("__at"), "line-met")
        least = apart(met.groupBy("first", "len", "next").agg(F.min("pos").alias("least")), "line-firsts")
        deeper = met.join(least, ["first", "len", "next"]).filter("least < pos").select("pos", "least")
        longer = F.when(F.col("least").isNotNull(), F.col("len") + (1 << step)).otherwise(F.col("len"))
        now = runs.join(deeper, "pos", "left").select("pos", "k", F.coalesce("least", "first").alias("first"), longer.alias("len"))
        runs = materialize(now, "line-runs")
    return runs.select("pos", "first", "len")


def later_copies(seq: DataFrame) -> DataFrame:
    """(row, __spans): the runs that stand earlier, as [first line, lines] of each document."""
    runs = repeated_runs(seq).join(seq.select("pos", ROW, "ln"), "pos")
    spans = F.collect_list(F.struct("ln", F.col("len").cast("int").alias("len")))
    return materialize(runs.groupBy(ROW).agg(spans.alias("__spans")), "line-spans")


def without_lines(text: bytes | None, spans: list[dict] | None, min_words: int) -> tuple[bytes | None, int, int]:
    """Text without the lines of the spans with enough words and the blank lines that follow them; lines with a word
    before, lines deleted."""
    lines = (text or b"").split(b"\n")
    words = np.array([len(line.split()) for line in lines])
    filled = words > 0
    upto = np.concatenate([[0], np.cumsum(words[filled])])
    change = np.zeros(len(upto), np.int64)
    for s in spans or ():
        end = s["ln"] + s["len"]
        if upto[end] - upto[s["ln"]] >= min_words:
            change[s["ln"]] += 1
            change[end] -= 1
    gone = np.cumsum(change) > 0
    kept, n, last = [], 0, False
    for line, full in zip(lines, filled):
        if full:
            last = bool(gone[n])
            n += 1
        if not last:
            kept.append(line)
    return (None if text is None else b"\n".join(kept)), n, int(gone.sum())


def dedup_lines(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_words: int = 8) -> DataFrame:
    """``docs`` with later copies of line runs cut out of the text, and ``n_lines``, ``n_deleted``.

    A run of one or more lines is deleted where the same lines stand in an earlier document or
    earlier in the same one, if it has at least ``min_words`` words; shorter repeats are common by
    chance. Lines without a word are not compared and go with the line before them. Documents are
    ordered by id, null ids last; of repeated rows the first read is the earlier. Null texts stay null, empty ones
    empty. Input columns named like the counts are replaced.
    """
    fields = "__cut binary, n_lines long, n_deleted long"
    rows = with_rows(docs.drop("n_lines", "n_deleted"), "line-input")
    spans = later_copies(sequence(split_lines(rows, text, doc_id)))

    def make() -> Callable[..., tuple]:
        return lambda t, spans: without_lines(t, spans, min_words)

    cut = per_text(rows.join(spans.hint("merge"), ROW, "left"), text, make, fields, also="__spans")
    names = [c for c in docs.columns if c not in ("n_lines", "n_deleted")]
    out = [F.col("__cut").cast("string").alias(c) if c == text else F.col(c) for c in names]
    return cut.select(*out, "n_lines", "n_deleted")


def drop_repeated_lines(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", n_chars: str = "n_chars", min_words: int = 8) -> DataFrame:
    """The documents with their shortened texts; those that lose their last line are left out."""
    done = dedup_lines(docs, text, doc_id, min_words).filter("n_deleted = 0 OR n_deleted < n_lines")
    if n_chars in docs.columns:
        done = done.withColumn(n_chars, F.when(F.col("n_deleted") > 0, F.length(text).cast(docs.schema[n_chars].dataType)).otherwise(F.col(n_chars)))
    return done.select(*docs.columns)
