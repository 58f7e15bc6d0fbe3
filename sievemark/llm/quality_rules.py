"""Quality rules: base counts, and limits that adapt to the language and source of a document."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sievemark.llm.common import per_text
from sievemark.session import materialize

SYMBOLS = b"#*$%&|<>"
_SPACE = b" \t\n\x0b\x0c\r"
_NOT_A_WORD_CHAR = _SPACE + bytes(range(0x80, 0xC0))  # white space and UTF-8 continuation bytes
COUNTS = "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long"


def repeated_words(words: Sequence[bytes], width: int = 5) -> int:
    """Words inside windows of ``width`` words that occur at least twice in the text.

    64-bit window hashes find the candidates; the words themselves decide.
    """
    n = len(words) - width + 1
    if n < 2:
        return 0
    codes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    mixed = np.zeros(n, np.uint64)
    for i in range(width):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + codes[i : i + n]
    order = np.argsort(mixed, kind="stable")
    same = mixed[order][1:] == mixed[order][:-1]
    if not same.any():
        return 0
    maybe = order[np.r_[same, False] | np.r_[False, same]].tolist()
    found = Counter(tuple(words[i : i + width]) for i in maybe)
    hit = np.zeros(len(words) + 1, np.int64)
    for i in maybe:
        if found[tuple(words[i : i + width])] > 1:
            hit[i] += 1
            hit[i + width] -= 1
    return int((np.cumsum(hit) > 0).sum())


def base_counts(text: bytes | None) -> tuple:
    """The counts named in ``COUNTS``; zeros for a null text."""
    t = text or b""
    words = t.split()
    lines = [line for line in t.split(b"\n") if line.strip()]
    return (
        len(words),
        len(t.translate(None, _NOT_A_WORD_CHAR)),
        len(t) - len(t.translate(None, SYMBOLS)),
        len(lines),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def with_base_counts(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Append the counts and ``base_failed``."""

    def make() -> Callable[[bytes | None], tuple]:
        return base_counts

    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return per_text(docs, text, make, COUNTS, keep).withColumn("base_failed", failed)


@dataclass(frozen=True)
class Metric:
    """``value`` must lie between the fences ``q1 - reach * (q3 - q1) - slack`` and
    ``q3 + reach * (q3 - q1) + slack``; ``slack`` is the width left where a group hardly varies."""

    name: str
    value: str
    slack: float
    both_sides: bool = False


METRICS = (
    Metric("symbols", "n_symbols / n_words", 0.25),
    Metric("copied_lines", "n_dup_lines / n_lines", 0.3),
    Metric("repeats", "n_repeat_words / n_words", 0.18),
    Metric("word_length", "word_chars / n_words", 3.0, both_sides=True),
)
ACCURACY = 0.01
GAMMA = (1 + ACCURACY) / (1 - ACCURACY)
ZERO_BUCKET = -1_000_000


def bucket_of(value: Column) -> Column:
    """Bucket of a logarithmic quantile sketch: its values differ by at most ``ACCURACY`` of themselves."""
    return F.when(value > 0, F.ceil(F.ln(value) / F.lit(math.log(GAMMA)))).otherwise(F.lit(ZERO_BUCKET)).cast("long")


def bucket_value(bucket: Column) -> Column:
    return F.when(bucket == ZERO_BUCKET, F.lit(0.0)).otherwise(
        F.lit(2.0) * F.pow(F.lit(GAMMA), bucket.cast("double")) / F.lit(GAMMA + 1)
    )


def sketches(counted: DataFrame, groups: Sequence[str]) -> DataFrame:
    """(groups, metric, bucket, n): one mergeable sketch per group and metric.

    A sketch is its bucket counts, so merging is adding: tasks merge before the shuffle and
    any coarser group's sketch is the sum of finer ones, in any order, with the same result.
    """
    each = F.array(*[F.struct(F.lit(m.name).alias("metric"), bucket_of(F.expr(m.value)).alias("bucket")) for m in METRICS])
    return (
        counted.filter("NOT base_failed AND n_words > 0 AND n_lines > 0")
        .select(*groups, F.explode(each).alias("m"))
        .groupBy(*groups, "m.metric", "m.bucket")
        .agg(F.count("*").alias("n"))
    )


def _quartiles(sketch: DataFrame, groups: Sequence[str]) -> DataFrame:
    """(groups, metric, size, q1, q3); a window holds the buckets of one sketch only."""
    whole = W.partitionBy(*groups, "metric")
    run = whole.orderBy("bucket").rowsBetween(W.unboundedPreceding, 0)
    summed = sketch.withColumn("upto", F.sum("n").over(run)).withColumn("size", F.sum("n").over(whole))
    first = lambda share: F.min(F.when(F.col("upto") * 4 >= F.col("size") * share, F.col("bucket")))
    return summed.groupBy(*groups, "metric").agg(
        F.max("size").alias("size"), bucket_value(first(1)).alias("q1"), bucket_value(first(3)).alias("q3")
    )


def adaptive_limits(
    counted: DataFrame, lang: str, source: str, min_docs: int = 100, reach: float = 3.0, ceiling: float = 2.0
) -> DataFrame:
    """(lang, source, one low and high per metric) for every language and source of ``counted``.

    Quartiles of a language are drawn towards those of all documents, and quartiles of a source towards its language's, as
    if ``min_docs`` documents had the latter. No source's high limit is more than ``ceiling`` times
    the greater of its language's and that of all documents, however much of the source is junk.
    """
    names = {lang: "g_lang", source: "g_source"}
    fine = materialize(sketches(counted.withColumnsRenamed(names), ["g_lang", "g_source"]), "quality-sketch")
    coarse = fine.groupBy("g_lang", "metric", "bucket").agg(F.sum("n").alias("n"))
    total = fine.groupBy("metric", "bucket").agg(F.sum("n").alias("n"))

    def table(quartiles: DataFrame, groups: list[str], prefix: str) -> DataFrame:
        own = [F.max(F.when(F.col("metric") == m.name, F.col(q))).alias(f"{prefix}{m.name}_{q}") for m in METRICS for q in ("q1", "q3")]
        return quartiles.groupBy(*groups).agg(F.max("size").alias(f"{prefix}size"), *own)

    by_both = table(_quartiles(fine, ["g_lang", "g_source"]), ["g_lang", "g_source"], "f_")
    by_lang = table(_quartiles(coarse, ["g_lang"]), ["g_lang"], "c_").withColumnRenamed("g_lang", "l_lang")
    of_all = table(_quartiles(total, []), [], "").first()  # one row
    merged = by_both.join(by_lang, F.col("g_lang").eqNullSafe(F.col("l_lang")))

    def drawn(prefix: str, column: str, towards: Column) -> Column:
        size = F.col(f"{prefix}size")
        return (size * F.col(f"{prefix}{column}") + F.lit(float(min_docs)) * towards) / (size + F.lit(float(min_docs)))

    picked = []
    for m in METRICS:
        all1, all3 = (F.lit(of_all[f"{m.name}_{q}"]).cast("double") for q in ("q1", "q3"))
        lang1, lang3 = drawn("c_", f"{m.name}_q1", all1), drawn("c_", f"{m.name}_q3", all3)
        own1, own3 = drawn("f_", f"{m.name}_q1", lang1), drawn("f_", f"{m.name}_q3", lang3)
        high = lambda q1, q3: q3 + reach * (q3 - q1) + F.lit(m.slack)  # noqa: E731, B023
        low = own1 - reach * (own3 - own1) - F.lit(m.slack) if m.both_sides else F.lit(float("-inf"))
        most = F.lit(ceiling) * F.greatest(high(lang1, lang3), high(all1, all3))
        picked += [low.alias(f"{m.name}_low"), F.least(high(own1, own3), most).alias(f"{m.name}_high")]
    return materialize(merged.select("g_lang", "g_source", *picked), "quality-limits")


def judge(counted: DataFrame, limits: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """Append ``kept`` to a table with base counts.

    A document stays if it passes the base rules and each metric lies within the limits of its
    language and source. The limits are a written table with one row per group: its size is known
    when the join is planned, so Spark sends it to all tasks if it is small, and else splits the
    partitions of large sources.
    """
    same = counted[lang].eqNullSafe(limits["g_lang"]) & counted[source].eqNullSafe(limits["g_source"])
    inside = F.lit(True)
    for m in METRICS:
        value = F.expr(f"try_divide({m.value.split(' / ')[0]}, {m.value.split(' / ')[1]})")
        inside = inside & value.between(F.col(f"{m.name}_low"), F.col(f"{m.name}_high"))
    kept = ~F.col("base_failed") & F.coalesce(inside, F.lit(False))
    return counted.join(limits, same, "left").withColumn("kept", kept).select(*counted.columns, "kept")


def quality_rules(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """Every column of ``docs`` except the text, the counts, ``base_failed`` and ``kept``.

    Null and empty texts have no words and fail the base rules. Null languages and sources
    are groups like any other. Repeated rows are judged one by one. Input columns with the
    name of a count are replaced.
    """
    rest = [c for c in docs.columns if c != text]
    counted = materialize(with_base_counts(docs, text, keep=rest), "quality-counts")
    return judge(counted, adaptive_limits(counted, lang, source), lang, source)


def keep_quality(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The documents that the rules keep, unchanged.

    The counts are written without the texts to find the limits, and made again where the
    texts are filtered: counting costs less than another copy of the corpus.
    """
    own = docs.select(*[F.col(c).alias(f"__c{i}") for i, c in enumerate(docs.columns)])
    at = {c: f"__c{i}" for i, c in enumerate(docs.columns)}
    counted = materialize(with_base_counts(own, at[text], keep=[at[lang], at[source]]), "quality-counts")
    limits = adaptive_limits(counted, at[lang], at[source])
    kept = judge(with_base_counts(own, at[text]), limits, at[lang], at[source]).filter("kept")
    return kept.select(*[F.col(a).alias(c) for c, a in at.items()])
