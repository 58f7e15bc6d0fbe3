"""Dataset features, splits, metrics and the classifier."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievemark.catalog.base import GAPPY, GAPPY_NUMBERS, GAPPY_TEXT, View, each, query, stacked, table, with_t
from sievemark.operators import corrupt, features, metrics, model, splits
from sievemark.operators.order import with_row_id
from sievemark.plans import etl
from sievemark.session import materialize

_ALL = GAPPY_NUMBERS + GAPPY_TEXT
_KEYED = View("lineitem", (*GAPPY.exprs[1:], "l_shipdate", "CAST(1 AS INT) AS same", "l_returnflag || '-' || l_linestatus AS dataset"),
              twice="l_returnflag = 'R' AND l_quantity > 40")
_K_NUM = ["l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "same"]
_K_ALL = [*_K_NUM, "l_returnflag", "l_linestatus", "l_shipdate"]



def _per(source: str) -> str:
    return f"""WITH t AS ({source}), c AS ({each(_K_ALL, '''SELECT dataset, '{c}' AS col, count(*) AS n, count({c}) AS present, count(DISTINCT {c}) AS uniq FROM t GROUP BY 1''')}),
m AS ({each(_K_NUM, '''SELECT dataset, '{c}' AS col, CASE WHEN min({c}) = max({c}) THEN 0 ELSE skewness({c}) END AS sk, CASE WHEN min({c}) = max({c}) THEN 0 ELSE kurtosis({c}) END AS ku,
  var_samp({c}) AS va, CASE WHEN abs(avg({c})) > 1e-10 THEN least(abs(stddev_samp({c}) / avg({c})), 100) END AS cv FROM t GROUP BY 1''')}),
p AS ({each(_K_NUM, '''SELECT dataset, '{c}' AS col, CASE WHEN avg(d * d) > 0 THEN avg(d * d * d) / power(avg(d * d), 1.5) END AS sp, CASE WHEN avg(d * d) > 0 THEN avg(d * d * d * d) / power(avg(d * d), 2) - 3 END AS kp
  FROM (SELECT dataset, {c} - avg({c}) OVER (PARTITION BY dataset) AS d FROM t) AS z GROUP BY 1''')}),
e AS (SELECT dataset, count(*) AS k FROM (SELECT DISTINCT * FROM t) AS u GROUP BY 1),
cc AS (SELECT dataset, max(n) AS n, 1 - sum(present) / CAST(sum(n) AS DOUBLE) AS missing_ratio, CAST(count(*) FILTER (WHERE uniq <= 1) AS DOUBLE) AS constant_cols, avg(uniq) AS mean_uniq FROM c GROUP BY 1),
mm AS (SELECT dataset, avg(cv) AS norm_variance, avg(va) AS mean_va, avg(va) FILTER (WHERE va > 0) AS pos_va, avg(abs(sk)) AS skewness, var_pop(abs(sk)) AS skew_var, avg(abs(ku)) AS kurt FROM m GROUP BY 1),
pp AS (SELECT dataset, avg(abs(coalesce(sp, 0))) AS skew_pop FROM p GROUP BY 1),
f AS (SELECT dataset, missing_ratio, 1 - k / CAST(n AS DOUBLE) AS duplicate_ratio, 6 / 9.0 AS numeric_ratio, constant_cols, norm_variance, mean_va, pos_va, skewness, skew_pop, skew_var, kurt,
  mean_uniq / n AS card FROM cc JOIN mm USING (dataset) JOIN pp USING (dataset) JOIN e USING (dataset))"""


def _r(names, places=6):
    return {n: F.round(n, places).alias(n) for n in names}


def _sql(cols: dict[str, str], source: str = _KEYED.sql()) -> str:
    return _per(source) + " SELECT dataset, " + ", ".join(f"round({e}, 5) AS {n}" for n, e in cols.items()) + " FROM f"


def _round(df):
    return df.select("dataset", *[F.round(c, 5).alias(c) for c in df.columns if c != "dataset"])


_EIGHT = {"missing_ratio": "missing_ratio", "duplicate_ratio": "duplicate_ratio", "numeric_ratio": "numeric_ratio", "constant_cols": "constant_cols",
          "norm_variance": "norm_variance", "skewness": "skewness", "cardinality_ratio": "least(card, 1)", "mean_kurtosis": "least(kurt / 10, 1)"}


@query("features8", _sql(_EIGHT))
def features8(spark, d):
    return _round(features.features8(_KEYED.df(spark, d), ["dataset"]))


@query("features6", _sql({"missing_ratio": "missing_ratio", "duplicate_ratio": "duplicate_ratio", "numeric_ratio": "numeric_ratio", "constant_columns": "constant_cols",
    "avg_variance": "mean_va / 1000", "avg_skewness": "skew_pop"}))
def features6(spark, d):
    """The variance is shown in thousands: its size leaves no room for five decimals."""
    return _round(features.features6(_KEYED.df(spark, d), ["dataset"]).withColumn("avg_variance", F.col("avg_variance") / 1000))


@query("features6n", _sql({"missing_ratio": "missing_ratio", "duplicate_ratio": "duplicate_ratio", "numeric_ratio": "numeric_ratio", "constant_cols": "constant_cols",
    "norm_variance": "norm_variance", "skewness": "skewness"}))
def features6n(spark, d):
    return _round(features.features6n(_KEYED.df(spark, d), ["dataset"]))


@query("features6v", _sql({"missing_ratio": "missing_ratio", "duplicate_ratio": "duplicate_ratio", "numeric_ratio": "numeric_ratio", "constant_cols": "constant_cols",
    "variance": "pos_va / 1000", "skewness": "skewness"}))
def features6v(spark, d):
    return _round(features.features6v(_KEYED.df(spark, d), ["dataset"]).withColumn("variance", F.col("variance") / 1000))


@query("features10", _sql({"missing_ratio": "missing_ratio", "duplicate_ratio": "duplicate_ratio", "numeric_ratio": "numeric_ratio", "constant_cols": "constant_cols",
    "norm_variance": "norm_variance", "skewness": "skewness", "type_consistency": "numeric_ratio", "cardinality_ratio": "least(card * 100, 100)",
    "skewness_variance": "skew_var", "mean_kurtosis": "kurt"}))
def features10(spark, d):
    return _round(features.features10(_KEYED.df(spark, d), ["dataset"]))


_OFF = View("events", ("event_id", "ts", "user_id", "CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value",
                       "CASE WHEN value > 100 THEN 'high' WHEN value > 90 THEN NULL ELSE CAST(user_id AS STRING) END AS level", "props",
                       "CAST(NULL AS STRING) AS nothing", "event_type AS dataset"))
_O_NUM, _O_TEXT = ["event_id", "user_id", "value"], ["level", "props", "nothing"]
_O_ALL = ["event_id", "ts", "user_id", "value", "level", "props", "nothing"]
_NUMBER = "[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?"


def features17_sql(source: str, key: str = "dataset") -> str:
    return f"""WITH t AS ({source}), c AS ({each(_O_ALL, f'''SELECT {key}, '{{c}}' AS col, count(*) AS n, (count(*) - count({{c}})) / CAST(count(*) AS DOUBLE) AS nr,
  count(DISTINCT {{c}}) + CASE WHEN count({{c}}) < count(*) THEN 1 ELSE 0 END AS uniq FROM t GROUP BY 1''')}),
p AS ({each(_O_NUM, f'''SELECT {key}, CASE WHEN avg(d * d) > 0 THEN avg(d * d * d) / power(avg(d * d), 1.5) END AS sp, CASE WHEN avg(d * d) > 0 THEN avg(d * d * d * d) / power(avg(d * d), 2) - 3 END AS kp
  FROM (SELECT {key}, {{c}} - avg({{c}}) OVER (PARTITION BY {key}) AS d FROM t) AS z GROUP BY 1''')}),
l AS ({each(_O_TEXT, f'''SELECT {key}, coalesce(var_samp(length({{c}})), 0) AS lv FROM t GROUP BY 1''')}),
x AS ({each(_O_TEXT, f'''SELECT {key}, count(*) AS present, count(*) FILTER (WHERE regexp_full_match(trim({{c}}), '{_NUMBER}')) AS parsed FROM t WHERE {{c}} IS NOT NULL GROUP BY 1''')}),
cc AS (SELECT {key}, CAST(max(n) AS DOUBLE) AS num_rows, avg(nr) AS null_ratio_mean, max(nr) AS null_ratio_max, stddev_pop(nr) AS null_ratio_std, CAST(count(*) FILTER (WHERE nr > 0.5) AS DOUBLE) AS num_high_null_columns,
  avg(uniq / CAST(n AS DOUBLE)) AS avg_unique_ratio, min(uniq / CAST(n AS DOUBLE)) AS min_unique_ratio, CAST(count(*) FILTER (WHERE uniq <= 1) AS DOUBLE) AS num_constant_columns FROM c GROUP BY 1),
pp AS (SELECT {key}, coalesce(avg(sp), 0) AS avg_skewness, coalesce(avg(kp), 0) AS avg_kurtosis FROM p GROUP BY 1),
ll AS (SELECT {key}, avg(lv) AS avg_string_length_variance, max(lv) AS max_string_length_variance FROM l GROUP BY 1),
xx AS (SELECT {key}, CAST(count(*) FILTER (WHERE parsed > 0 AND parsed < present) AS DOUBLE) AS num_mixed_type_columns FROM x GROUP BY 1)
SELECT {key}, num_rows, 7.0 AS num_columns, 3.0 AS num_numeric_columns, 3.0 AS num_string_columns, {', '.join(f'round({n}, 5) AS {n}' for n in features.FEATURES17[4:11])},
  num_mixed_type_columns, {', '.join(f'round({n}, 5) AS {n}' for n in features.FEATURES17[12:16])}, 0.0 AS empty_row_ratio
FROM cc JOIN pp USING ({key}) JOIN ll USING ({key}) JOIN xx USING ({key})"""


@query("features17", features17_sql(_OFF.sql()))
def features17(spark, d):
    return _round(features.features17(_OFF.df(spark, d), ["dataset"]))


_BATCHED = """SELECT batch_no, count(*) AS rows, min(l_orderkey) AS first_order, max(l_orderkey) AS last_order FROM (
  SELECT l_orderkey, (row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_extendedprice, l_discount, l_tax, l_partkey) - 1) // 10000 + 1 AS batch_no FROM lineitem) AS z
GROUP BY 1"""


@query("src_batches", _BATCHED)
def src_batches(spark, d):
    order = ["l_orderkey", "l_linenumber", "l_extendedprice", "l_discount", "l_tax", "l_partkey"]
    batches = features.with_batches(table(spark, d, "lineitem").select(*order), order, size=10_000)
    return batches.groupBy("batch_no").agg(
        F.count(F.lit(1)).alias("rows"), F.min("l_orderkey").alias("first_order"), F.max("l_orderkey").alias("last_order"))


@query("src_batches_by_file", """SELECT event_type, batch_no, count(*) AS rows, min(event_id) AS first_event FROM (SELECT event_type, event_id,
  (row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1) // 700 + 1 AS batch_no FROM events) AS z GROUP BY 1, 2""")
def src_batches_by_file(spark, d):
    events = table(spark, d, "events").select("event_type", "event_id", "ts")
    return features.with_batches(events, ["ts", "event_id"], "event_type", 700).groupBy("event_type", "batch_no").agg(
        F.count(F.lit(1)).alias("rows"), F.min("event_id").alias("first_event"))


def _etl(spark, d):
    """Batches of 300 events per type; the twin loses three tenths of its cells."""
    return etl.build_samples(_OFF.df(spark, d), "dataset", ["event_id"], ["ts", "event_id"], 300, 250, algorithm="md5",
                             damage=lambda df, dice: corrupt.inject_nulls(df, dice, 0.3))


_RUNS = f"SELECT *, (row_number() OVER (PARTITION BY dataset ORDER BY ts, event_id) - 1) // 300 + 1 AS batch_no FROM ({_OFF.sql()}) AS o"
_USED = f"SELECT *, dataset || '#' || batch_no AS k FROM (SELECT *, count(*) OVER (PARTITION BY dataset, batch_no) AS held FROM ({_RUNS}) AS r) AS h WHERE held >= 250"


def _hurt(c: str) -> str:
    u = f"(CAST('0x' || substr(md5(concat_ws('|', '42', 'null:{c}', CAST(event_id AS VARCHAR), dataset, CAST(batch_no AS VARCHAR))), 1, 13) AS BIGINT) / 4503599627370496.0)"
    return f"CASE WHEN {u} >= 0.3 THEN {c} END AS {c}"


_HURT = f"SELECT event_id, {', '.join(_hurt(c) for c in _O_ALL if c != 'event_id')}, k FROM ({_USED}) AS u"


def _etl_sql(source: str, label: int) -> str:
    body = features17_sql(source, "k")
    return f"SELECT split_part(k, '#', 1) AS source, CAST(split_part(k, '#', 2) AS BIGINT) AS batch_no, {label} AS label, * EXCLUDE (k) FROM ({body}) AS f{label}"


@query("etl_samples", f"{_etl_sql(_USED, 1)} UNION ALL {_etl_sql(_HURT, 0)}")
def etl_samples(spark, d):
    return _etl(spark, d).samples.select("source", "batch_no", "label", *[F.round(c, 5).alias(c) for c in features.FEATURES17])


@query("etl_errors", f"SELECT dataset AS source, 'batch ' || batch_no || ': rows<250' AS reason FROM ({_RUNS}) AS r GROUP BY dataset, batch_no HAVING count(*) < 250")
def etl_errors(spark, d):
    return _etl(spark, d).errors


@query("etl_splits", f"""SELECT source, label, CASE WHEN u < 0.7 THEN 'train' WHEN u < 0.85 THEN 'val' ELSE 'test' END AS split, count(*) AS n FROM (
  SELECT dataset AS source, label, CAST('0x' || substr(md5(concat_ws('|', '42', 'split', dataset)), 1, 13) AS BIGINT) / 4503599627370496.0 AS u
  FROM (SELECT DISTINCT dataset, batch_no FROM ({_USED}) AS u) AS b, (VALUES (0), (1)) AS l(label)) AS z GROUP BY 1, 2, 3""")
def etl_splits(spark, d):
    return etl.split_samples(materialize(_etl(spark, d).samples, "samples"), algorithm="md5").groupBy("source", "label", "split").agg(
        F.count(F.lit(1)).alias("n"))


_DOC = ["n_chars", "words", "lines"]


def _documents(spark, d):
    """Labelled documents with three plain features."""
    docs = table(spark, d, "documents").select(
        "doc_id", "source", F.col("n_chars").cast("double").alias("n_chars"),
        F.size(F.split("text", " ")).cast("double").alias("words"),
        (F.char_length("text") - F.char_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1).cast("double").alias("lines"))
    return docs.join(table(spark, d, "labels").withColumnRenamed("quality", "label"), "doc_id")


_DOC_SQL = """SELECT d.doc_id, source, CAST(n_chars AS DOUBLE) AS n_chars, CAST(len(string_split(text, ' ')) AS DOUBLE) AS words,
  CAST(length(text) - length(replace(text, chr(10), '')) + 1 AS DOUBLE) AS lines, quality AS label FROM documents d JOIN labels l USING (doc_id)"""


@query("feature_corr", with_t(_DOC_SQL, " UNION ALL ".join(f"SELECT '{a}' AS row, '{b}' AS col, round(corr({a}, {b}), 5) AS r FROM t" for a in _DOC for b in _DOC)))
def feature_corr(spark, d):
    return features.feature_correlation(_documents(spark, d), _DOC).withColumn("r", F.round("r", 5))


@query("class_separation", with_t(_DOC_SQL, each(_DOC, """SELECT '{c}' AS feature, round(avg({c}) FILTER (WHERE label = 1), 5) AS mean_good, round(avg({c}) FILTER (WHERE label = 0), 5) AS mean_bad,
  round(abs(avg({c}) FILTER (WHERE label = 1) - avg({c}) FILTER (WHERE label = 0)), 5) AS separation FROM t""")))
def class_separation(spark, d):
    return features.class_separation(_documents(spark, d), _DOC, "label").select(
        "feature", *[F.round(c, 5).alias(c) for c in ("mean_good", "mean_bad", "separation")])


def sql_u(tag: str, *keys: str, seed: int = 42) -> str:
    """The md5 form of the seeded uniform number."""
    parts = ", ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    return f"(CAST('0x' || substr(md5(concat_ws('|', '{seed}', '{tag}', {parts})), 1, 13) AS BIGINT) / 4503599627370496.0)"


_PAIR_KEY = ("l_shipdate", "l_linenumber", "dataset")
_TORN = "SELECT " + ", ".join(
    c if c in _PAIR_KEY else f"CASE WHEN {sql_u('null:' + c, *_PAIR_KEY)} >= 0.3 THEN {c} END AS {c}" for c in [*_K_ALL, "dataset"]
) + f" FROM ({_KEYED.sql()}) AS k"


@query("labelled_pairs", f"SELECT 1 AS label, * FROM ({_sql(_EIGHT)}) AS a UNION ALL SELECT 0, * FROM ({_sql(_EIGHT, _TORN)}) AS b")
def labelled_pairs(spark, d):
    """Six datasets and their twins with three tenths of the cells gone."""
    dice = corrupt.Dice(_PAIR_KEY, algorithm="md5")
    pairs = corrupt.labelled_pairs(_KEYED.df(spark, d), dice, features.features8, lambda df, dice: corrupt.inject_nulls(df, dice, 0.3), key=["dataset"])
    return pairs.select("label", "dataset", *[F.round(c, 5).alias(c) for c in features.FEATURES8])


def _labels(spark, d):
    return table(spark, d, "labels")


@query("balance_classes", f"""SELECT doc_id, quality FROM (SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY {sql_u('balance', 'doc_id')}, doc_id) AS k,
  least((SELECT count(*) FROM labels WHERE quality = 0), (SELECT count(*) FROM labels WHERE quality = 1)) AS m FROM labels) AS z WHERE k <= m""")
def balance_classes(spark, d):
    return splits.balance_classes(_labels(spark, d), "quality", ["doc_id"], algorithm="md5").select("doc_id", "quality")


@query("balance_ratio", f"""SELECT doc_id, toxic FROM (SELECT doc_id, toxic, row_number() OVER (PARTITION BY toxic ORDER BY {sql_u('balance', 'doc_id')}, doc_id) AS k,
  (SELECT count(*) FROM labels WHERE toxic = 1) AS m FROM labels) AS z WHERE toxic = 1 OR k <= CAST(floor(1.5 * m) AS BIGINT)""")
def balance_ratio(spark, d):
    return splits.balance_classes(_labels(spark, d), "toxic", ["doc_id"], ratio=1.5, algorithm="md5").select("doc_id", "toxic")


@query("filter_class", """SELECT doc_id, quality FROM labels WHERE toxic = 0 UNION ALL SELECT doc_id, quality FROM labels WHERE toxic = 1 AND quality = 1""")
def filter_class(spark, d):
    labels = _labels(spark, d).select("doc_id", "quality", "toxic")
    return splits.filter_class(labels.filter("toxic = 0"), labels.filter("toxic = 1"), "quality").select("doc_id", "quality")


_PLACE = f"row_number() OVER (ORDER BY {sql_u('split', 'o_orderkey')}, o_orderkey) - 1"


@query("split_ratio", f"""SELECT o_orderkey, CASE WHEN p < floor(n * 0.7) THEN 'train' WHEN p < floor(n * 0.85) THEN 'val' ELSE 'test' END AS split
FROM (SELECT o_orderkey, {_PLACE} AS p, count(*) OVER () AS n FROM orders) AS z""")
def split_ratio(spark, d):
    return splits.split_ratio(table(spark, d, "orders"), ["o_orderkey"], algorithm="md5").select("o_orderkey", "split")


@query("split_by_source", f"""SELECT doc_id, CASE WHEN u < 0.7 THEN 'train' WHEN u < 0.85 THEN 'val' ELSE 'test' END AS split FROM (SELECT doc_id, {sql_u('split', 'source')} AS u FROM documents) AS z""")
def split_by_source(spark, d):
    return splits.split_ratio(table(spark, d, "documents"), ["doc_id"], by=["source"], algorithm="md5").select("doc_id", "split")


@query("split_stratified", f"""SELECT doc_id, CASE WHEN k <= round_even(n * 0.25, 0) THEN 'test' ELSE 'train' END AS split FROM (SELECT doc_id,
  row_number() OVER (PARTITION BY quality ORDER BY {sql_u('strata', 'doc_id')}, doc_id) AS k, count(*) OVER (PARTITION BY quality) AS n FROM labels) AS z""")
def split_stratified(spark, d):
    return splits.split_stratified(_labels(spark, d), "quality", ["doc_id"], algorithm="md5").select("doc_id", "split")


_FOLD = " + ".join(f"CASE WHEN p >= n * {j} // 5 THEN 1 ELSE 0 END" for j in range(1, 5))
_GAPS = View("labels", ("doc_id", "CASE WHEN doc_id % 4 = 0 THEN NULL ELSE quality END AS quality"))


@query("split_stratified_nulls", with_t(_GAPS, f"""SELECT doc_id, CASE WHEN k <= round_even(n * 0.25, 0) THEN 'test' ELSE 'train' END AS split FROM (SELECT doc_id,
  row_number() OVER (PARTITION BY quality ORDER BY {sql_u('strata', 'doc_id')}, doc_id) AS k, count(*) OVER (PARTITION BY quality) AS n FROM t) AS z"""))
def split_stratified_nulls(spark, d):
    return splits.split_stratified(_GAPS.df(spark, d), "quality", ["doc_id"], algorithm="md5").select("doc_id", "split")


@query("kfold_nulls", with_t(_GAPS, f"""SELECT doc_id, CAST({_FOLD} AS INT) AS fold FROM (
  SELECT doc_id, row_number() OVER (PARTITION BY quality ORDER BY {sql_u('folds', 'doc_id')}, doc_id) - 1 AS p, count(*) OVER (PARTITION BY quality) AS n FROM t) AS z"""))
def kfold_nulls(spark, d):
    return splits.kfold_stratified(_GAPS.df(spark, d), "quality", ["doc_id"], algorithm="md5").select("doc_id", "fold")


@query("class_weight_nulls", with_t(_GAPS, "SELECT quality, round((SELECT count(*) FROM t) / (2.0 * count(*)), 6) AS weight, count(*) AS n FROM t GROUP BY 1"))
def class_weight_nulls(spark, d):
    return model.with_class_weight(_GAPS.df(spark, d), "quality").groupBy("quality").agg(F.round(F.max("weight"), 6).alias("weight"), F.count(F.lit(1)).alias("n"))


_FILES = View("events", ("CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS file", "event_id", "ts"))


@query("src_batches_null_file", with_t(_FILES, """SELECT file, batch_no, count(*) AS rows, min(event_id) AS first_event FROM (SELECT file, event_id,
  (row_number() OVER (PARTITION BY file ORDER BY ts, event_id) - 1) // 700 + 1 AS batch_no FROM t) AS z GROUP BY 1, 2"""))
def src_batches_null_file(spark, d):
    return features.with_batches(_FILES.df(spark, d), ["ts", "event_id"], "file", 700).groupBy("file", "batch_no").agg(
        F.count(F.lit(1)).alias("rows"), F.min("event_id").alias("first_event"))


@query("kfold_stratified", f"""SELECT doc_id, CAST({_FOLD} AS INT) AS fold FROM (
  SELECT doc_id, row_number() OVER (PARTITION BY quality ORDER BY {sql_u('folds', 'doc_id')}, doc_id) - 1 AS p, count(*) OVER (PARTITION BY quality) AS n FROM labels) AS z""")
def kfold_stratified(spark, d):
    return splits.kfold_stratified(_labels(spark, d), "quality", ["doc_id"], algorithm="md5").select("doc_id", "fold")


@query("kfold_group", f"SELECT doc_id, CAST(floor({sql_u('group', 'source')} * 5) AS INT) AS fold FROM documents")
def kfold_group(spark, d):
    return splits.kfold_group(table(spark, d, "documents"), "source", algorithm="md5").select("doc_id", "fold")


@query("shuffle", f"SELECT row_number() OVER (ORDER BY {sql_u('shuffle', 'o_orderkey')}, o_orderkey) AS place, o_orderkey FROM orders")
def shuffle(spark, d):
    from sievemark.functions.hashing import uniform

    u = uniform([F.col("o_orderkey")], 42, "shuffle", "md5")
    return with_row_id(table(spark, d, "orders").select("o_orderkey", u.alias("u")), ["u", "o_orderkey"], "place").select("place", "o_orderkey")


@query("sample_frac", f"SELECT o_orderkey, o_totalprice FROM orders WHERE {sql_u('sample', 'o_orderkey')} < 0.1")
def sample_frac(spark, d):
    return splits.sample_frac(table(spark, d, "orders"), 0.1, ["o_orderkey"], algorithm="md5").select("o_orderkey", "o_totalprice")


@query("class_weight", """SELECT quality, round((SELECT count(*) FROM labels) / (2.0 * count(*)), 6) AS weight, count(*) AS n FROM labels GROUP BY 1""")
def class_weight(spark, d):
    return model.with_class_weight(_labels(spark, d), "quality").groupBy("quality").agg(F.round(F.max("weight"), 6).alias("weight"), F.count(F.lit(1)).alias("n"))


@query("positive_ratio", "SELECT round(count(*) FILTER (WHERE quality = 0) / CAST(count(*) FILTER (WHERE quality = 1) AS DOUBLE), 6) AS scale_pos_weight FROM labels")
def positive_ratio(spark, d):
    return model.positive_ratio(_labels(spark, d), "quality").select(F.round("scale_pos_weight", 6).alias("scale_pos_weight"))


def _predicted(spark, d):
    """A fixed rule as the prediction: discount against tax decides, the price is the score."""
    return table(spark, d, "lineitem").select(
        (F.col("l_linestatus") == "O").cast("int").alias("y"), (F.col("l_extendedprice") > 50000).cast("int").alias("p"),
        "l_extendedprice", "l_returnflag")


_PRED = "SELECT CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS y, CASE WHEN l_extendedprice > 50000 THEN 1 ELSE 0 END AS p, l_extendedprice, l_returnflag FROM lineitem"
_CONF = """count(*) FILTER (WHERE y = 0 AND p = 0) AS tn, count(*) FILTER (WHERE y = 0 AND p = 1) AS fp,
  count(*) FILTER (WHERE y = 1 AND p = 0) AS fn, count(*) FILTER (WHERE y = 1 AND p = 1) AS tp"""


@query("confusion", with_t(_PRED, f"SELECT l_returnflag, {_CONF} FROM t GROUP BY 1"))
def confusion(spark, d):
    return metrics.confusion(_predicted(spark, d), "y", "p", ["l_returnflag"])


@query("class_report", with_t(_PRED, f""", c AS (SELECT {_CONF} FROM t) SELECT 0 AS class, round(tn / CAST(tn + fn AS DOUBLE), 6) AS precision,
  round(tn / CAST(tn + fp AS DOUBLE), 6) AS recall, tn + fp AS support FROM c UNION ALL SELECT 1, round(tp / CAST(tp + fp AS DOUBLE), 6), round(tp / CAST(tp + fn AS DOUBLE), 6), tp + fn FROM c""").replace(") ,", "),"))
def class_report(spark, d):
    return metrics.class_report(_predicted(spark, d), "y", "p").withColumns({"precision": F.round("precision", 6), "recall": F.round("recall", 6)})


_RATES = """round((tp + tn) / CAST(tn + fp + fn + tp AS DOUBLE), 6) AS accuracy, round((tp / CAST(tp + fn AS DOUBLE) + tn / CAST(tn + fp AS DOUBLE)) / 2, 6) AS balanced_accuracy,
  round(tp / CAST(tp + fp AS DOUBLE), 6) AS precision, round(tp / CAST(tp + fn AS DOUBLE), 6) AS recall, round(2.0 * tp / (2 * tp + fp + fn), 6) AS f1"""


@query("eval_metrics", with_t(_PRED, f"SELECT l_returnflag, {_RATES} FROM (SELECT l_returnflag, {_CONF} FROM t GROUP BY 1) AS c"))
def eval_metrics(spark, d):
    found = metrics.eval_metrics(_predicted(spark, d), "y", "p", ["l_returnflag"])
    return found.select("l_returnflag", *[F.round(c, 6).alias(c) for c in found.columns[1:]])


_ROC = """SELECT score, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, pos, neg, sum(pos) OVER () AS np, sum(neg) OVER () AS nn FROM (
  SELECT value AS score, count(*) FILTER (WHERE event_type IN ('error', 'click')) AS pos, count(*) FILTER (WHERE event_type NOT IN ('error', 'click')) AS neg FROM events GROUP BY 1) AS g
WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING)"""


def _scored_events(spark, d):
    return table(spark, d, "events").select(F.col("event_type").isin("error", "click").cast("int").alias("y"), F.col("value").alias("s"))


@query("roc_curve", f"SELECT score, round(fp / CAST(nn AS DOUBLE), 6) AS fpr, round(tp / CAST(np AS DOUBLE), 6) AS tpr FROM ({_ROC}) AS r")
def roc_curve(spark, d):
    return metrics.roc_points(_scored_events(spark, d), "y", "s").select("score", F.round("fpr", 6).alias("fpr"), F.round("tpr", 6).alias("tpr"))


@query("auc", f"SELECT round(sum(neg / CAST(nn AS DOUBLE) * (tp - pos / 2.0) / np), 6) AS auc_roc FROM ({_ROC}) AS r")
def auc(spark, d):
    return metrics.auc(_scored_events(spark, d), "y", "s").select(F.round("auc_roc", 6).alias("auc_roc"))


def _compared(prefix: str, test: str) -> str:
    return (f"SELECT event_type, count(*) FILTER (WHERE {test}) / CAST(count(*) AS DOUBLE) AS {prefix}_f1, avg(value) FILTER (WHERE {test}) / 500 AS {prefix}_balanced_accuracy, "
            f"max(value) FILTER (WHERE {test}) / 500 AS {prefix}_auc_roc FROM events GROUP BY 1")


@query("promote_model", f"""SELECT event_type, round(a, 6) AS f1_delta, round(b, 6) AS balanced_accuracy_delta, round(c, 6) AS auc_roc_delta, up AS metrics_improved, down AS metrics_degraded,
  up >= 2 AND down = 0 AS promoted, CASE WHEN up >= 2 AND down = 0 THEN 'improved' WHEN down > 0 THEN 'degraded' ELSE 'insufficient' END AS reason FROM (
SELECT *, CAST(a > 0.02 AS INT) + CAST(b > 0.02 AS INT) + CAST(c > 0.02 AS INT) AS up, CAST(a < -0.01 AS INT) + CAST(b < -0.01 AS INT) + CAST(c < -0.01 AS INT) AS down FROM (
SELECT event_type, candidate_f1 - current_f1 AS a, candidate_balanced_accuracy - current_balanced_accuracy AS b, candidate_auc_roc - current_auc_roc AS c
FROM ({_compared('current', 'value < 60')}) AS x JOIN ({_compared('candidate', 'value > 5')}) AS y USING (event_type)) AS z) AS w""")
def promote_model(spark, d):
    def side(prefix, test):
        hit = F.when(F.expr(test), F.col("value"))
        return table(spark, d, "events").groupBy("event_type").agg(
            (F.count(hit) / F.count(F.lit(1))).alias(f"{prefix}_f1"), (F.avg(hit) / 500).alias(f"{prefix}_balanced_accuracy"), (F.max(hit) / 500).alias(f"{prefix}_auc_roc"))

    both = side("current", "value < 60").join(side("candidate", "value > 5"), "event_type")
    return metrics.promote_frame(both).withColumns({f"{k}_delta": F.round(f"{k}_delta", 6) for k in metrics.COMPARED})


def _samples(spark, d):
    """Samples of short batches; their twins lose six tenths of their cells, so that any classifier can tell them apart."""
    built = etl.build_samples(_OFF.df(spark, d), "dataset", ["event_id"], ["ts", "event_id"], 60, 50, algorithm="md5",
                              damage=lambda df, dice: corrupt.inject_nulls(df, dice, 0.6))
    return materialize(built.samples, "samples")


def _halves(spark, d):
    """Odd batches to learn from, even ones to be judged; twins stay together."""
    samples = _samples(spark, d)
    return samples.filter("batch_no % 2 = 1"), samples.filter("batch_no % 2 = 0")


_SHORT = f"""SELECT dataset, batch_no FROM (SELECT dataset, (row_number() OVER (PARTITION BY dataset ORDER BY ts, event_id) - 1) // 60 + 1 AS batch_no FROM ({_OFF.sql()}) AS o) AS r
GROUP BY 1, 2 HAVING count(*) >= 50"""
_JUDGED = f"""SELECT dataset AS source, CAST(batch_no AS BIGINT) AS batch_no, label, CASE label WHEN 1 THEN 'GOOD' ELSE 'BAD' END AS quality, true AS sure
FROM ({_SHORT}) AS s, (VALUES (0), (1)) AS l(label) WHERE batch_no % 2 = 0"""


def _trained(kind, **settings):
    def run(spark, d):
        """Every held-out sample with its verdict, and whether the model is surer of it than of the other."""
        train, test = _halves(spark, d)
        scored = model.score(model.train(train, features.FEATURES17, kind, **settings), test, ["source", "batch_no", "label"])
        return scored.select("source", "batch_no", "label", "quality", (F.col("score") > 50).alias("sure"))

    return run


query("train_rf", _JUDGED)(_trained("forest", numTrees=20, maxDepth=8))
query("train_gbt", _JUDGED)(_trained("boosted", maxIter=10))
query("train_logreg", _JUDGED)(_trained("logistic"))
query("train_single", _JUDGED)(_trained("single"))


@query("score_model", "SELECT count(*) AS datasets, true AS sums_to_one, true AS confidence_is_top FROM labels")
def score_model(spark, d):
    docs = _documents(spark, d)
    scored = model.score(model.train(docs, _DOC, "logistic"), docs, ["doc_id"])
    good, bad = F.col("probability_good"), F.col("probability_bad")
    return scored.agg(F.count(F.lit(1)).alias("datasets"), F.bool_and(F.abs(good + bad - 1) < 1e-3).alias("sums_to_one"),
                      F.bool_and(F.abs(F.col("score") - F.greatest(good, bad) * 100) < 0.1).alias("confidence_is_top"))


@query("score_pct", """SELECT CAST(floor(l_quantity / 50.0 * 100) AS INT) AS quality_score, CASE WHEN floor(l_quantity / 50.0 * 100) >= 85 THEN 'EXCELLENT'
  WHEN floor(l_quantity / 50.0 * 100) >= 60 THEN 'GOOD' WHEN floor(l_quantity / 50.0 * 100) >= 30 THEN 'FAIR' ELSE 'POOR' END AS rating, count(*) AS n FROM lineitem GROUP BY 1, 2""")
def score_pct(spark, d):
    p = F.col("l_quantity") / 50.0
    rows = table(spark, d, "lineitem").select(p.alias("probability_good"), (1 - p).alias("probability_bad"))
    return model.quality_report(rows).groupBy("quality_score", "rating").agg(F.count(F.lit(1)).alias("n"))


_METRICS = ("accuracy", "balanced_accuracy", "precision", "recall", "f1", "auc_roc")


@query("kfold_metrics", " UNION ALL ".join(f"SELECT '{m}' AS metric, 1.0 AS mean, 0.0 AS std FROM (SELECT count(*) FROM ({_SHORT}) AS s HAVING count(*) > 0) AS c" for m in _METRICS))
def kfold_metrics(spark, d):
    """Folds by source and batch, so that twins stay together; the classes can be told apart in each."""
    folded = materialize(splits.kfold_group(_samples(spark, d).withColumn("pair", F.concat_ws("#", "source", "batch_no")), "pair", 3), "folds")
    found = model.cross_validation_summary(model.cross_validate(folded, features.FEATURES17, "single"))
    return found.select("metric", F.round("mean", 9).alias("mean"), F.round("std", 9).alias("std"))


@query("learning_curve", f"SELECT unnest([0.5, 0.75, 1.0]) AS fraction, 1.0 AS train_accuracy, 1.0 AS test_accuracy FROM (SELECT count(*) FROM ({_SHORT}) AS s HAVING count(*) > 0) AS c")
def learning_curve(spark, d):
    train, test = _halves(spark, d)
    return model.learning_curve(train, test, features.FEATURES17, ["sample_id"], (0.5, 0.75, 1.0), "single")


@query("logreg_sweep", f"SELECT unnest(['regParam=0.01', 'regParam=0.1']) AS setting, 1.0 AS accuracy, 1.0 AS f1, 1.0 AS auc_roc FROM (SELECT count(*) FROM ({_SHORT}) AS s HAVING count(*) > 0) AS c")
def logreg_sweep(spark, d):
    train, test = _halves(spark, d)
    return model.sweep(train, test, features.FEATURES17, "logistic", [{"regParam": r} for r in (0.01, 0.1)]).select(
        "setting", *[F.round(m, 9).alias(m) for m in ("accuracy", "f1", "auc_roc")])


@query("feature_importance", f"SELECT 17 AS features, true AS ranked, true AS sums_to_one, true AS a_share_of_gaps_leads FROM (SELECT count(*) FROM ({_SHORT}) AS s HAVING count(*) > 0) AS c")
def feature_importance(spark, d):
    """What tells the twins apart is their gaps: a feature that counts them comes first."""
    found = model.feature_importance(model.train(_samples(spark, d), features.FEATURES17, "forest", numTrees=20, maxDepth=5), features.FEATURES17)
    first = F.max(F.when(F.col("rank") == 1, F.col("feature")))
    ranked = F.max_by("importance", "rank") == F.min("importance")
    return found.agg(F.count(F.lit(1)).cast("int").alias("features"), ranked.alias("ranked"), (F.abs(F.sum("importance") - 1) < 1e-9).alias("sums_to_one"),
                     (first.contains("null") | first.contains("unique") | first.contains("string_length")).alias("a_share_of_gaps_leads"))


@query("scale_features", with_t(_DOC_SQL, "SELECT doc_id, " + ", ".join(
    f"round(({c} - (SELECT avg({c}) FROM t)) / (SELECT stddev_samp({c}) FROM t), 5) AS {c}" for c in _DOC) + " FROM t"))
def scale_features(spark, d):
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    docs = _documents(spark, d)
    scaled = Pipeline(stages=model.preparation(_DOC, scale=True)).fit(docs).transform(docs)
    v = vector_to_array("features")
    return scaled.select("doc_id", *[F.round(v[i], 5).alias(c) for i, c in enumerate(_DOC)])


@query("batch_score", f"SELECT 2 * count(*) AS datasets, 0.5 AS good_share, true AS confident FROM ({_SHORT}) AS s WHERE batch_no % 2 = 0")
def batch_score(spark, d):
    """Held-out batches and their twins, scored in one pass: half of them are good."""
    train, test = _halves(spark, d)
    fitted = model.train(train, features.FEATURES17, "forest", numTrees=20, maxDepth=5)
    return model.batch_summary(model.score(fitted, test, ["source"])).select("datasets", "good_share", (F.col("mean_confidence") > 80).alias("confident"))


def _loop(spark, d, current):
    """Feedback on held-out samples joins the base rows, the candidate faces the holdout; what the log says."""
    from sievemark.plans.retrain import current_model, retrain, score_stored
    from sievemark.session import scratch_path
    from sievemark.sources.readers import read_log

    train, test = _halves(spark, d)
    feedback = test.filter("batch_no % 4 = 0").select(F.xxhash64("sample_id").alias("id"), F.array(*features.FEATURES17).alias("feature_values"), "label")
    log, root = scratch_path(spark, "retrain-log"), scratch_path(spark, "model")
    known = model.train(train, features.FEATURES17, "single") if current else None
    retrain(train, feedback, test, features.FEATURES17, known, root, log, folds=3, min_samples=5, kind="single")
    entry = read_log(spark, log).select("cv_score", "feedback_samples", "total_training_samples", "action", "promoted", "validation_reason")
    stored = current_model(spark, root) is not None
    right = score_stored(test, root, ["label"]).agg(F.avg(((F.col("quality") == "GOOD") == (F.col("label") == 1)).cast("int"))).first()[0] if stored else None
    return entry.withColumns({"stored": F.lit(stored), "stored_right": F.lit(right).cast("double")})


_LOOP = f"""SELECT 1.0 AS cv_score, CAST(2 * count(*) FILTER (WHERE batch_no % 4 = 0) AS BIGINT) AS feedback_samples,
  CAST(2 * count(*) FILTER (WHERE batch_no % 2 = 1 OR batch_no % 4 = 0) AS BIGINT) AS total_training_samples, """


@query("retrain", _LOOP + f"'promoted' AS action, true AS promoted, 'improved' AS validation_reason, true AS stored, 1.0 AS stored_right FROM ({_SHORT}) AS s")
def retrain_q(spark, d):
    """Without a model yet the candidate is promoted, stored, and judges the holdout right."""
    return _loop(spark, d, False)


@query("retrain_no_gain", _LOOP + f"'archived' AS action, false AS promoted, 'insufficient' AS validation_reason, false AS stored, CAST(NULL AS DOUBLE) AS stored_right FROM ({_SHORT}) AS s")
def retrain_no_gain(spark, d):
    """A candidate that is no better than the model in use is only logged."""
    return _loop(spark, d, True)
