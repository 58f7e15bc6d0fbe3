"""The operators as named queries over the supplied tables, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievemark.llm.collocations import collocations
from sievemark.llm.conversations import damaged, repair_conversations, repaired_digests
from sievemark.llm.decontamination import contamination
from sievemark.llm.language_id import train, training_sample, with_language
from sievemark.llm.line_dedup import dedup_lines
from sievemark.llm.mixing import labelled_sample, mix, train_domains
from sievemark.llm.packing import pack, read_vocabulary
from sievemark.llm.pii import replace_pii
from sievemark.llm.quality_rules import ACCURACY, METRICS, quality_rules
from sievemark.llm.simhash import near_duplicates
from sievemark.llm.substring_dedup import dedup_substrings
from sievemark.llm.token_counts import token_lengths
from sievemark.llm.url_filters import Rule, url_filter

Run = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))
    docs = _table(spark, folder, "documents").select("doc_id", "text", "lang", held_out.alias("held_out"))
    model = train(training_sample(docs.filter("NOT held_out"), "text", "lang", "doc_id"))
    return with_language(docs, model, keep=["doc_id", "held_out"])


def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return token_lengths(_table(spark, folder, "documents"), str(path), public_tokenizers.PATTERN, ["lang"])


URL_RULES = (
    Rule("allow", "com/"), Rule("block", "example.com/en/"), Rule("allow", "www.example.com/en/"),
    Rule("block", "net/es/"), Rule("block", "net/fr/"),
)


def op3_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter(_table(spark, folder, "pages"), _table(spark, folder, "labels"), URL_RULES)


def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contamination(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    return quality_rules(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return dedup_lines(_table(spark, folder, "documents").select("doc_id", "text"))


MIX_TARGETS = {"good": 0.95, "poor": 0.05, "toxic": 0.0}


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    model = train_domains(labelled_sample(docs, _table(spark, folder, "labels"), "text", "doc_id", "doc_id", 3000))
    return mix(docs, model, MIX_TARGETS).drop("text")


def op8_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return dedup_substrings(_table(spark, folder, "documents").select("doc_id", "text"))


def op9_pii(spark: SparkSession, folder: str) -> DataFrame:
    return replace_pii(_table(spark, folder, "documents").select("doc_id", "text"), key="change-me")


def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(_table(spark, folder, "documents"))


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    rows = _table(spark, folder, "conversations")
    repair = repair_conversations(damaged(rows))
    digests = repaired_digests(repair.turns).withColumnRenamed("conv", "__conv")
    found = repair.conversations.withColumnRenamed("conv_id", "__id")
    every = rows.select("conv_id").distinct()
    both = every.join(found, F.col("conv_id").eqNullSafe(F.col("__id")), "left").join(
        digests, F.col("conv_id").eqNullSafe(F.col("__conv")), "left"
    )
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return both.select(
        "conv_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(_table(spark, folder, "documents"))


def op13_packing(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    vocabulary = read_vocabulary(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    packed = pack(_table(spark, folder, "documents"), vocabulary)
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


QUERIES: dict[str, Run] = {
    "op1_language_id": op1_language_id,
    "op2_token_counts": op2_token_counts,
    "op3_url_filters": op3_url_filters,
    "op4_decontamination": op4_decontamination,
    "op5_quality_rules": op5_quality_rules,
    "op6_line_dedup": op6_line_dedup,
    "op7_mixing": op7_mixing,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_pii": op9_pii,
    "op10_simhash": op10_simhash,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_collocations": op12_collocations,
    "op13_packing": op13_packing,
}

_BENCH_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_FOLDED = "translate({t}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP4_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_FOLDED.format(t="coalesce(text, '')")}, '{_BENCH_WORD}') AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item, regexp_extract_all({_FOLDED.format(t="coalesce(text, '')")}, '{_BENCH_WORD}') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item, least(10, len(w)) AS k, list_slice(w, i, i + least(10, len(w)) - 1) AS g
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT k FROM windows),
grams AS (
  SELECT r, k, i, list_slice(w, i, i + k - 1) AS g
  FROM (SELECT r, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM d, sizes WHERE len(w) >= k)),
found AS (SELECT r, grams.k, i, item FROM grams JOIN windows ON grams.k = windows.k AND grams.g = windows.g),
hit AS (SELECT r, count(DISTINCT x) AS n FROM (SELECT r, unnest(range(i, i + k)) AS x FROM found) GROUP BY r),
items AS (SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT r, item FROM found) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(hit.n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(items.n, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN items USING (r)
"""

_GAMMA = f"((1 + CAST({ACCURACY} AS DOUBLE)) / (1 - CAST({ACCURACY} AS DOUBLE)))"


def _quality_sql(min_docs: int = 100, reach: float = 3.0, ceiling: float = 2.0) -> str:
    values = " UNION ALL ".join(
        f"SELECT r, lang, source, '{m.name}' AS metric, "
        + "CAST({} AS DOUBLE) / {} AS v FROM counted WHERE NOT base_failed AND n_words > 0 AND n_lines > 0".format(*m.value.split(" / "))
        for m in METRICS
    )
    slack = "CASE f.metric " + " ".join(f"WHEN '{m.name}' THEN {m.slack}" for m in METRICS) + " END"
    low = "CASE WHEN metric IN (" + ", ".join(f"'{m.name}'" for m in METRICS if m.both_sides) + f") THEN o1 - {reach} * (o3 - o1) - slack ELSE -1e300 END"

    def level(groups: str) -> str:
        by = f"{groups}, metric" if groups else "metric"
        return f"""SELECT {by}, max(size) AS size,
            min(CASE WHEN upto * 4 >= size THEN val END) AS q1, min(CASE WHEN upto * 4 >= size * 3 THEN val END) AS q3
          FROM (SELECT *, sum(n) OVER (PARTITION BY {by} ORDER BY b) AS upto, sum(n) OVER (PARTITION BY {by}) AS size,
                CASE WHEN b IS NULL THEN 0 WHEN b = -1000000 THEN 0 ELSE 2 * pow({_GAMMA}, b) / ({_GAMMA} + 1) END AS val
                FROM (SELECT {by}, b, count(*) AS n FROM bucketed GROUP BY {by}, b)) GROUP BY {by}"""

    return rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
words AS (SELECT r, doc_id, lang, source, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM docs),
grams AS (SELECT r, i, list_slice(w, i, i + 4) AS g FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM words WHERE len(w) >= 5)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS k FROM grams) WHERE k > 1),
repeated AS (SELECT r, count(DISTINCT x) AS n FROM (SELECT r, unnest(range(i, i + 5)) AS x FROM twice) GROUP BY r),
lines AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup
  FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM docs) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
counted AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM (
    SELECT words.r, doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words,
      CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
      CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
      CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_dup, 0) AS BIGINT) AS n_dup_lines,
      CAST(coalesce(repeated.n, 0) AS BIGINT) AS n_repeat_words
    FROM words LEFT JOIN lines USING (r) LEFT JOIN repeated USING (r))),
measured AS ({values}),
bucketed AS (SELECT *, CASE WHEN v > 0 THEN CAST(ceil(ln(v) / ln({_GAMMA})) AS BIGINT) ELSE -1000000 END AS b FROM measured),
fine AS ({level("lang, source")}), coarse AS ({level("lang")}), total AS ({level("")}),
drawn AS (
  SELECT f.lang, f.source, f.metric, f.size, f.q1, f.q3, t.q1 AS t1, t.q3 AS t3,
    (c.size * c.q1 + CAST({min_docs} AS DOUBLE) * t.q1) / (c.size + CAST({min_docs} AS DOUBLE)) AS l1,
    (c.size * c.q3 + CAST({min_docs} AS DOUBLE) * t.q3) / (c.size + CAST({min_docs} AS DOUBLE)) AS l3, {slack} AS slack
  FROM (SELECT * FROM fine) f JOIN coarse c ON f.lang IS NOT DISTINCT FROM c.lang AND f.metric = c.metric JOIN total t ON f.metric = t.metric),
own AS (
  SELECT *, (size * q1 + CAST({min_docs} AS DOUBLE) * l1) / (size + CAST({min_docs} AS DOUBLE)) AS o1,
    (size * q3 + CAST({min_docs} AS DOUBLE) * l3) / (size + CAST({min_docs} AS DOUBLE)) AS o3 FROM drawn),
picked AS (
  SELECT lang, source, metric, {low} AS low,
    least(o3 + {reach} * (o3 - o1) + slack, {ceiling} * greatest(l3 + {reach} * (l3 - l1) + slack, t3 + {reach} * (t3 - t1) + slack)) AS high FROM own),
outside AS (
  SELECT DISTINCT r FROM measured m JOIN picked p
    ON m.metric = p.metric AND m.lang IS NOT DISTINCT FROM p.lang AND m.source IS NOT DISTINCT FROM p.source
  WHERE v < low OR v > high)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND outside.r IS NULL AS kept
FROM counted LEFT JOIN outside ON counted.r = outside.r
"""


def _collocations_sql(longest: int = 4, min_count: int = 30, per_lang: int = 2000, inside: int = 80) -> str:
    grams = " UNION ALL ".join(
        f"SELECT lang, {m} AS m, array_to_string(list_slice(w, i, i + {m} - 1), ' ') AS phrase FROM (SELECT lang, w, unnest(range(1, len(w) - {m} + 2)) AS i FROM pieces WHERE len(w) >= {m})"
        for m in range(1, longest + 1)
    )
    return rf"""
WITH pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_FOLDED.format(t="coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
grams AS ({grams}),
f AS (SELECT lang, m, phrase, count(*) AS f FROM grams GROUP BY lang, m, phrase HAVING count(*) >= {min_count}),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM pieces GROUP BY lang),
c AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE m > 1),
cuts AS (SELECT lang, m, phrase, a, w, unnest(range(1, m)) AS k FROM c),
scored AS (
  SELECT cuts.lang, cuts.phrase, a, k, l.f AS l, r.f AS r,
    CAST(CAST(2000000 AS HUGEINT) * a // (CAST(l.f AS HUGEINT) + r.f) AS BIGINT) AS score
  FROM cuts JOIN f l ON l.lang = cuts.lang AND l.phrase = array_to_string(list_slice(w, 1, k), ' ')
    JOIN f r ON r.lang = cuts.lang AND r.phrase = array_to_string(list_slice(w, k + 1, cuts.m), ' ')),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_ AS (
  SELECT lang, a, array_to_string(list_slice(w, i, i + s - 1), ' ') AS phrase
  FROM (SELECT lang, m, a, w, s, unnest(range(1, m - s + 2)) AS i FROM (SELECT *, unnest(range(2, m)) AS s FROM c))),
covers AS (SELECT lang, phrase, max(a) AS longer FROM inner_ GROUP BY lang, phrase),
kept AS (SELECT o.* FROM lowest o LEFT JOIN covers v ON v.lang = o.lang AND v.phrase = o.phrase
  WHERE longer IS NULL OR CAST(100 AS HUGEINT) * longer < CAST({inside} AS HUGEINT) * a)
SELECT kept.lang, rank, phrase, a, l, r, n, score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept) kept
  JOIN total ON total.lang = kept.lang WHERE rank <= {per_lang}
"""


def _cell(state: str, cost: str, edit: str, line: str = "") -> str:
    added = f"list_append({state}.rep, {line})" if line else f"{state}.rep"
    return f"struct_pack(cost := {state}.cost + {cost}, audit := {state}.audit || '{edit}', rep := {added})"


def _least(*cells: str) -> str:
    return f"list_min([{', '.join(cells)}])"


def _repair_sql() -> str:
    """The same minimum over prefixes of the turns, a state for each column and a turn for each round."""
    user, assistant = "'user:'", "'assistant:'"
    line, none = "role || ':' || text", "struct_pack(cost := 1000000000, audit := '', rep := CAST([] AS VARCHAR[]))"

    def turn(state: str, initial: str) -> str:
        given = "user:" if initial == "u" else "assistant:"
        kept = f"WHEN initial = '{initial}' THEN {_cell(state, 'late', 'K', line)}"
        other = f"ELSE {_cell(state, '3 + late', 'R', f"'{given}' || text")}" if initial != "s" else f"ELSE {none}"
        return f"CASE WHEN gone THEN {none} {kept} {other} END"

    insert = lambda s, x: _cell(s, "3", "I", x)
    t2 = _least(_cell("p.s2", "4", "D"), turn("p.s0", "u"), turn("p.s1", "u"), turn("p.s3", "u"))
    t3 = _least(_cell("p.s3", "4", "D"), turn("p.s2", "a"))
    bits = "list_reduce([CAST(b AS BIGINT)] || range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)"
    return rf"""
WITH RECURSIVE crc AS (SELECT list({bits} ORDER BY b) AS t FROM (SELECT unnest(range(256)) AS b)),
given AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
hashed AS (SELECT *, xor(list_reduce([4294967295] || list_transform(string_split(k, ''), lambda x: CAST(unicode(x) AS BIGINT)),
  lambda c, x: xor(c >> 8, t[CAST(xor(c & 255, x) AS BIGINT) + 1])), 4294967295) % 20 AS fault FROM given, crc),
spoilt AS (SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
  CASE fault WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
  unnest(range(CASE WHEN fault = 3 THEN 2 ELSE 1 END)) AS copy FROM hashed WHERE fault <> 0),
placed AS (SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
  substr(role, 1, 1) AS initial FROM spoilt),
told AS (SELECT *, NOT regexp_matches(text, '[^ 	-
]') AS blank,
  row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
  NOT regexp_matches(text, '[.!?][ 	-
]*$') AS late,
  lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair FROM placed),
rows_ AS (SELECT conv_id, i, role, text, initial, pair, turn, blank, NOT blank AND again AS dup, NOT blank AND NOT again AND late AS cut FROM told),
coded AS (SELECT conv_id, i, role, text, initial, blank OR dup AS gone, CASE WHEN cut THEN 3 ELSE 0 END AS late FROM rows_),
sums AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
  count(*) FILTER (dup) AS duplicate, count(*) FILTER (cut) AS truncated,
  count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM rows_ GROUP BY conv_id),
parsed AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, struct_pack(cost := 0, audit := '', rep := CAST([] AS VARCHAR[])) AS s0, {none} AS s1,
    struct_pack(cost := 3, audit := 'I', rep := [{user}]) AS s2, struct_pack(cost := 6, audit := 'II', rep := [{user}, {assistant}]) AS s3
  FROM sums
  UNION ALL
  SELECT conv_id, i, s0, s1, s2, {_least("s3", insert("s2", assistant))} FROM (
    SELECT conv_id, i, s0, s1, {_least("t2", insert("s0", user), insert("s1", user), insert("t3", user))} AS s2, t3 AS s3 FROM (
      SELECT p.conv_id, r.i, {_cell("p.s0", "4", "D")} AS s0, {_least(_cell("p.s1", "4", "D"), turn("p.s0", "s"))} AS s1,
        {t2} AS t2, {t3} AS t3
      FROM parsed p JOIN coded r ON p.conv_id IS NOT DISTINCT FROM r.conv_id AND r.i = p.i + 1))),
done AS (SELECT p.conv_id, list_min([s0, s3]) AS best FROM parsed p JOIN sums s ON p.conv_id IS NOT DISTINCT FROM s.conv_id AND p.i = s.n)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, CAST(coalesce(best.cost, 0) AS BIGINT) AS cost, coalesce(best.audit, '') AS audit,
  sha256(coalesce(array_to_string(best.rep, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN sums s ON o.conv_id IS NOT DISTINCT FROM s.conv_id
  LEFT JOIN done d ON o.conv_id IS NOT DISTINCT FROM d.conv_id
"""


ORACLES: dict[str, str] = {
    "op11_conversation_repair": _repair_sql(),
    "op12_collocations": _collocations_sql(),
    "op4_decontamination": OP4_SQL,
    "op5_quality_rules": _quality_sql(),
}
