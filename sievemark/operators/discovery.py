"""Ranking and de-duplicating dataset candidates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievemark.operators.dedup import keep_first

# Points a candidate earns.
FORMAT_POINTS = {"csv": 40, "zip": 20, "json": 20, "html_table": 10}
ROW_POINTS = ((100_000, 30), (10_000, 20), (1_000, 10), (0, 5))
DIRECT_ENDINGS, DIRECT_POINTS = (".csv", ".csv.gz", ".zip"), 15
LONG_DESCRIPTION, DESCRIPTION_POINTS = 100, 5
REJECTED_ENDINGS = (".txt",)
BYTES_PER_ROW = 200
URL_PATTERN = r"^[a-z][a-z0-9+.-]*://([^/?#]*)([^?#]*)"


def normal_url(url: Column) -> Column:
    """Host and path in lower case, without trailing slashes, query or fragment."""
    u = F.rtrim(F.lower(url), F.lit("/"))
    return F.concat(F.regexp_extract(u, URL_PATTERN, 1), F.regexp_extract(u, URL_PATTERN, 2))


def url_slug(url: Column, title: Column) -> Column:
    """Words of the title and eight digits of the md5 of the normal URL."""
    words = F.substring(F.regexp_replace(F.lower(title), r"[^\p{L}\p{N}_]", "_"), 1, 40)
    return F.concat_ws("_", F.trim(words, F.lit("_")), F.substring(F.md5(normal_url(url)), 1, 8))


def _ends(c: Column, endings: Sequence[str]) -> Column:
    out = F.lit(False)
    for e in endings:
        out = out | c.endswith(e)
    return out


def candidate_score(url: Column, file_format: Column, rows: Column, description: Column) -> Column:
    by_format = F.lit(0)
    for name, points in FORMAT_POINTS.items():
        by_format = F.when(F.lower(file_format) == name, points).otherwise(by_format)
    by_rows = F.lit(0)
    for over, points in reversed(ROW_POINTS):
        by_rows = F.when(rows > over, points).otherwise(by_rows)
    direct = F.when(_ends(F.lower(url), DIRECT_ENDINGS), DIRECT_POINTS).otherwise(0)
    told = F.when(F.char_length(description) > LONG_DESCRIPTION, DESCRIPTION_POINTS).otherwise(0)
    return (by_format + by_rows + direct + told).cast("double")


def est_rows(size_bytes: Column) -> Column:
    return F.floor(size_bytes / BYTES_PER_ROW)


def reject_ext(df: DataFrame, url: str = "url") -> DataFrame:
    """Candidates whose path does not end in a rejected extension."""
    return df.filter(~_ends(normal_url(F.col(url)), REJECTED_ENDINGS))


def scored(candidates: DataFrame) -> DataFrame:
    return candidates.withColumn("score", candidate_score(
        F.col("url"), F.col("file_format"), F.col("estimated_rows"), F.col("description")
    ))


def candidate_rank(parts: Sequence[DataFrame], per_domain: int, seq: str = "seq") -> DataFrame:
    """All adapters' candidates: first per URL, scored, best N per domain.

    Both ranks are limits, so a task forwards one row per URL and N per domain.
    """
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p, allowMissingColumns=True)
    unique = scored(keep_first(every, ["domain", "url"], [seq]))
    best = Window.partitionBy("domain").orderBy(F.desc("score"), seq)
    return unique.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= per_domain)


def not_in_manifest(candidates: DataFrame, manifest: DataFrame) -> DataFrame:
    return candidates.join(manifest.select("slug"), "slug", "left_anti")


def manifest_upsert(old: DataFrame, new: DataFrame) -> DataFrame:
    """New entries replace old ones with the same slug."""
    return old.join(new.select("slug"), "slug", "left_anti").unionByName(new, allowMissingColumns=True)


def session_totals(acquired: DataFrame, most: int | None = None, seq: str = "seq") -> DataFrame:
    """Saved datasets, rows and errors of all attempts, or of the first ``most``."""
    seen = acquired.orderBy(seq).limit(most) if most else acquired
    ok = F.col("status") == "ok"
    return seen.agg(
        F.count_if(ok).alias("saved"),
        F.coalesce(F.sum(F.when(ok, F.col("rows"))), F.lit(0)).alias("rows"),
        F.count_if(~ok).alias("errors"),
    )
