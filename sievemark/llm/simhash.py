"""SimHash near-duplicates: fingerprints, pigeonhole blocks, links, components."""

from __future__ import annotations

from collections.abc import Callable
from itertools import combinations, islice

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemark.llm.common import ROW, apart, components, per_text, with_rows
from sievemark.session import materialize

_AT_ONCE = 1 << 15  # shingles hashed between two bit counts


def fingerprint(text: bytes | None, width: int = 3, seed: int = 42) -> int:
    """Signed 64-bit SimHash of the word shingles; 0 without words."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    parts = zip(*(words[i:] for i in range(width))) if len(words) >= width else iter([words])
    digest, counts, total = xxhash.xxh64_intdigest, np.zeros(64, np.int64), 0
    while True:
        hashes = np.fromiter((digest(b" ".join(p), seed) for p in islice(parts, _AT_ONCE)), np.uint64)
        if not hashes.size:
            break
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
        total += hashes.size
    return int(np.packbits(counts * 2 > total, bitorder="little").view(np.int64)[0])


def with_fingerprints(docs: DataFrame, text: str = "text", width: int = 3, keep: list[str] | None = None) -> DataFrame:
    """Append ``fingerprint`` (long). A null text has no words and gets 0."""

    def make() -> Callable[[bytes | None], tuple]:
        return lambda t: (fingerprint(t, width),)

    return per_text(docs, text, make, "fingerprint long", keep)


def _masks(radius: int, blocks: int) -> list[int]:
    """A mask for each choice of ``blocks - radius`` blocks, as signed 64-bit numbers."""
    edges = [round(i * 64 / blocks) for i in range(blocks + 1)]
    of = [(1 << edges[i + 1]) - (1 << edges[i]) for i in range(blocks)]
    found = (sum(of[i] for i in chosen) for chosen in combinations(range(blocks), blocks - radius))
    return [m - (1 << 64) if m >= 1 << 63 else m for m in found]


def _signed_bit(k: int) -> int:
    return 1 << k if k < 63 else -(1 << 63)


def near_links(values: DataFrame, blocks: int = 4, dense: int = 64) -> DataFrame:
    """(a, b): links between distinct fingerprints ``fp`` that differ in at most two bits.

    Two differing bits touch at most two of the ``blocks`` blocks, so a close pair agrees on all
    the others: each choice of the others is a bucket key, and pairs are sought within buckets
    and verified by Hamming distance. Buckets of over ``dense`` members are not paired off.
    There each member meets the values one flipped bit away; two members are within two bits
    exactly if they have such a value (or a member) in common, which at most 65 members share.
    Linking these to the smallest of them makes the same components from linearly many rows.
    """
    masks = _masks(2, blocks)
    fp = F.col("fp")
    keys = F.array(*[F.struct(F.lit(i).alias("k"), fp.bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(masks)])
    buckets = values.select("fp", F.explode(keys).alias("at")).select("fp", "at.k", "at.key")
    sizes = buckets.groupBy("k", "key").agg(F.count("*").alias("size")).filter("size > 1")
    sizes = apart(sizes, "simhash-sizes")
    members = materialize(buckets.join(sizes, ["k", "key"]), "simhash-buckets")

    sparse = members.filter(F.col("size") <= dense)
    left = sparse.select("k", "key", fp.alias("a"))
    right = sparse.select("k", "key", fp.alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 2
    paired = left.join(right, ["k", "key"]).filter((F.col("b") < F.col("a")) & near).select("a", "b")

    def flips(mask: int) -> Column:
        free = [_signed_bit(k) for k in range(64) if not mask >> k & 1]
        return F.array(fp, *[fp.bitwiseXOR(F.lit(b)) for b in free])

    around = F.when(F.lit(False), flips(0))
    for i, m in enumerate(masks):
        around = around.when(F.col("k") == i, flips(m))
    met = (
        members.filter(F.col("size") > dense)
        .select("fp", "k", "key", F.explode(around).alias("mid"))
        .groupBy("k", "key", "mid")
        .agg(F.collect_set("fp").alias("near"))
        .filter(F.size("near") > 1)
    )
    stars = met.select(F.explode("near").alias("a"), F.array_min("near").alias("b")).filter("a <> b")
    return paired.unionAll(stars).distinct()


def component_heads(marked: DataFrame, head: Column) -> DataFrame:
    """(fingerprint, head): the smallest ``head`` in the component of each fingerprint.

    Copies count once: rows are reduced to distinct fingerprints first. ``head`` is any
    orderable column; nulls are passed over.
    """
    own = materialize(marked.groupBy("fingerprint").agg(F.min(head).alias("own")), "simhash-values")
    links = near_links(own.select(F.col("fingerprint").alias("fp")))
    roots = components(links, "simhash-links").select(F.col("a").alias("fingerprint"), F.col("b").alias("root"))
    rooted = own.join(roots, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    rooted = materialize(rooted, "simhash-roots")
    heads = apart(rooted.groupBy("root").agg(F.min("own").alias("head")), "simhash-heads")
    return rooted.join(heads, "root").select("fingerprint", "head")


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, fingerprint, component_id): one row per document.

    ``fingerprint`` is the SimHash in 16 hexadecimal digits, ``component_id`` the smallest id
    that links of at most two differing bits reach. Null and empty texts share fingerprint zero.
    Repeated rows are copies of one another. A null id is passed over as a component's id, so
    it is null only if all ids there are. Extra columns are ignored.
    """
    marked = materialize(with_fingerprints(docs.select(doc_id, text), text, keep=[doc_id]), "simhash")
    heads = component_heads(marked, F.col(doc_id)).withColumnRenamed("head", "component_id")
    return marked.join(heads, "fingerprint").select(
        doc_id, F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One document of each component: the one with the smallest id (null ids last).

    Of repeated rows one stays. All columns are kept as they are.
    """
    names = docs.columns
    rows = with_rows(docs, "near-input")
    marked = materialize(with_fingerprints(rows.select(doc_id, text, ROW), text, keep=[doc_id, ROW]), "near-marks")
    order = F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("id"), F.col(ROW).alias("row"))
    kept = component_heads(marked, order).select(F.col("head.row").alias(ROW)).distinct()
    return rows.join(kept.hint("merge"), ROW, "left_semi").select(*names)
