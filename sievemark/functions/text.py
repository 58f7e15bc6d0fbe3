"""Text clean-up as column expressions over whole texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievemark.functions.columns import col

# The characters each clean-up removes or replaces.
TAG_PATTERN = r"<[^>]+>"
CONTROL_PATTERN = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]"
DIRECTION_PATTERN = "[\u202D\u202E\u200B\u200C\u200D]"


def strip_tags(c: Column) -> Column:
    """Text without markup, trimmed; the literal ``nan`` counts as missing."""
    t = F.trim(F.regexp_replace(c.cast("string"), TAG_PATTERN, ""))
    return F.when(t != "nan", t)


def strip_html(df: DataFrame) -> DataFrame:
    texts = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return df.select(*[
        strip_tags(col(c)).alias(c) if c in texts else col(c) for c in df.columns
    ])


def safe_detail(c: Column) -> Column:
    """Text that cannot break a table cell or a link."""
    return F.trim(F.replace(F.translate(c, "\\|[]", "/•()"), F.lit("'"), F.lit("")))


def safe_markdown(c: Column) -> Column:
    """Bars become bullets; a leading block marker is pushed off column one."""
    t = F.replace(c, F.lit("|"), F.lit("•"))
    return F.when(t.rlike(r"^[#\-*>]"), F.concat(F.lit(" "), t)).otherwise(t)


def strip_control(c: Column) -> Column:
    """Unix line ends, no control characters but tab and newline, no direction marks."""
    t = F.replace(c, F.lit("\r\n"), F.lit("\n"))
    return F.regexp_replace(F.regexp_replace(t, CONTROL_PATTERN, ""), DIRECTION_PATTERN, "")


def add_provenance(
    df: DataFrame, source: str, domain: str, adapter: str, origin_url: str
) -> DataFrame:
    """Where the rows came from and when; fully empty rows are dropped."""
    return df.na.drop(how="all").withColumns({
        "_source": F.lit(source),
        "_domain": F.lit(domain),
        "_adapter": F.lit(adapter),
        "_origin_url": F.lit(origin_url),
        "_fetched_at": F.current_timestamp(),
    })
