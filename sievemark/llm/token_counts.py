"""Token counts: an exact histogram of document lengths that answers every context limit."""

from __future__ import annotations

import base64
import functools
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sievemark.llm.common import per_text
from sievemark.session import materialize

Encode = Callable[[list[str]], list[int]]
#: Lengths that one window task holds.
SPAN = 4096
#: Characters encoded at once: longer texts go in pieces, cut where the splitting pattern cuts too.
PIECE = 1 << 16


@functools.lru_cache(maxsize=2)
def tiktoken_encoding(path: str, pattern: str):
    """A byte-pair encoding from a file of ranks."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines)}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def _pieces(text: str) -> list[str]:
    """Cut before a space that follows a letter and precedes one, where every word pattern cuts as well."""
    out, start = [], 0
    while len(text) - start > PIECE:
        at = start + PIECE
        while at < len(text) and not (text[at] == " " and text[at - 1].isalpha() and text[at + 1 : at + 2].isalpha()):
            at += 1
        out.append(text[start:at])
        start = at
    return [*out, text[start:]]


def with_tokens(docs: DataFrame, path: str, pattern: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Append ``n_tokens``, 0 for null and empty texts. ``path`` is a file that every executor has."""

    def make() -> Callable[[bytes | None], tuple]:
        encode = tiktoken_encoding(path, pattern).encode_ordinary
        return lambda t: (sum(len(encode(p)) for p in _pieces(t.decode("utf-8", "replace"))) if t else 0,)

    return per_text(docs, text, make, "n_tokens long", keep)


def length_histogram(counted: DataFrame, groups: list[str]) -> DataFrame:
    """(groups, length, n_docs): rows as many as there are lengths, whatever the number of documents."""
    return counted.groupBy(*groups, F.col("n_tokens").alias("length")).agg(F.count("*").alias("n_docs"))


def context_table(histogram: DataFrame, groups: list[str]) -> DataFrame:
    """The histogram with suffix sums, for every occurring length taken as a context limit L.

    ``docs_over`` and ``tokens_over``: documents longer than L and their tokens. ``tokens_truncated``:
    tokens that stay if each document is cut to L. ``rank_share``: share of documents with at most L
    tokens, so the q-quantile is the smallest length whose share reaches q. Any other limit
    follows from the row of the next smaller length. Sums run within spans of ``SPAN`` lengths and
    then over spans, of which a text of two gigabytes has at most half a million.
    """
    h = histogram.withColumn("__span", F.floor(F.col("length") / SPAN))
    spans = h.groupBy(*groups, "__span").agg(
        F.sum("n_docs").alias("d"), F.sum(F.col("n_docs") * F.col("length")).alias("t")
    )
    over = W.partitionBy(*groups).orderBy(F.desc("__span")).rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(*groups)
    spans = spans.select(
        *[F.col(g).alias(f"__g{i}") for i, g in enumerate(groups)], F.col("__span").alias("__s"),
        F.coalesce(F.sum("d").over(over), F.lit(0)).alias("__d"), F.coalesce(F.sum("t").over(over), F.lit(0)).alias("__t"),
        F.sum("d").over(whole).alias("__docs"), F.sum("t").over(whole).alias("__tokens"),
    )
    inner = W.partitionBy(*groups, "__span").orderBy(F.desc("length")).rowsBetween(W.unboundedPreceding, -1)
    same = F.col("__span") == F.col("__s")
    for i, g in enumerate(groups):
        same = same & F.col(g).eqNullSafe(F.col(f"__g{i}"))
    joined = h.join(spans, same)
    docs_over = F.coalesce(F.sum("n_docs").over(inner), F.lit(0)) + F.col("__d")
    tokens_over = F.coalesce(F.sum(F.col("n_docs") * F.col("length")).over(inner), F.lit(0)) + F.col("__t")
    return joined.withColumn("docs_over", docs_over).withColumn("tokens_over", tokens_over).select(
        *groups, "length", "n_docs", "docs_over", "tokens_over",
        (F.col("__tokens") - F.col("tokens_over") + F.col("length") * F.col("docs_over")).alias("tokens_truncated"),
        F.col("__tokens").alias("tokens_total"),
        ((F.col("__docs") - F.col("docs_over")) / F.col("__docs")).alias("rank_share"),
    )


def token_lengths(docs: DataFrame, path: str, pattern: str, groups: list[str], text: str = "text") -> DataFrame:
    """``context_table`` of documents by ``groups``; a null group value is a group of its own.

    Repeated rows count each time, null and empty texts as length 0; an empty table gives no row.
    """
    counted = with_tokens(docs.select(*groups, text), path, pattern, text, keep=groups)
    return context_table(materialize(length_histogram(counted, groups), "token-lengths"), groups)
