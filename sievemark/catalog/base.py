"""Registry of named queries and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Run] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    """Register a query; ``sql`` is its equivalent over views named like the tables."""

    def register(run: Run) -> Run:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


@dataclass(frozen=True)
class View:
    """A projection of one table written in expressions both engines read alike.

    The supplied tables have no gaps, copies or dirty text; views derive such data from
    the values of whole tables.
    """

    source: str
    exprs: tuple[str, ...]
    where: str | None = None
    twice: str | None = None  # rows under this condition appear once more

    def df(self, spark: SparkSession, folder: str) -> DataFrame:
        base = table(spark, folder, self.source)
        rows = base.filter(self.where) if self.where else base
        if self.twice:
            rows = rows.unionAll(base.filter(self.twice))
        return rows.selectExpr(*self.exprs)

    def sql(self) -> str:
        rows = f"SELECT * FROM {self.source}" + (f" WHERE {self.where}" if self.where else "")
        if self.twice:
            rows += f" UNION ALL SELECT * FROM {self.source} WHERE {self.twice}"
        return f"SELECT {', '.join(self.exprs)} FROM ({rows}) AS base"

    def names(self) -> list[str]:
        return [e.rsplit(" AS ", 1)[-1].strip() if " AS " in e else e for e in self.exprs]


def with_t(view: View | str, body: str) -> str:
    """``body`` over the view, which it calls t."""
    inner = view.sql() if isinstance(view, View) else view
    return f"WITH t AS ({inner}) {body}"


def each(columns: Sequence[str], template: str, glue: str = " UNION ALL ") -> str:
    """The template once per column; ``{c}`` is the column, ``{i}`` its position."""
    return glue.join(template.replace("{c}", c).replace("{i}", str(i)) for i, c in enumerate(columns))


def stacked(columns: Sequence[str], template: str) -> str:
    """A parenthesised union usable in FROM."""
    return f"({each(columns, template)}) AS stacked"


# Numeric columns of the line items, all free of gaps.
LINE_NUMBERS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax",
]

# Line items with gaps that follow from other values of the row.
GAPPY = View("lineitem", (
    "l_orderkey", "l_linenumber",
    "CASE WHEN l_discount = 0.0 THEN NULL ELSE l_quantity END AS l_quantity",
    "CASE WHEN l_tax > 0.06 THEN NULL ELSE l_extendedprice END AS l_extendedprice",
    "l_discount",
    "CASE WHEN l_quantity > 45 THEN NULL ELSE l_tax END AS l_tax",
    "CASE WHEN l_linestatus = 'O' AND l_tax = 0.0 THEN NULL ELSE l_returnflag END AS l_returnflag",
    "l_linestatus",
))
GAPPY_NUMBERS = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
GAPPY_TEXT = ["l_returnflag", "l_linestatus"]

# Gappy line items with returned lines twice.
COPIED = View("lineitem", GAPPY.exprs, twice="l_returnflag = 'R'")

# Narrow line items in which many whole rows repeat, some fully empty.
NARROW = View("lineitem", (
    "CASE WHEN l_discount < 0.005 THEN NULL ELSE l_returnflag END AS flag",
    "CASE WHEN l_discount < 0.005 THEN NULL ELSE l_linestatus END AS status",
    "CASE WHEN l_discount < 0.015 THEN NULL ELSE l_quantity END AS quantity",
    "CAST(NULL AS DOUBLE) AS nothing",
))

# Line items as text, as a file without types would hold them.
TEXTY = View("lineitem", (
    "CAST(CAST(l_quantity AS BIGINT) AS STRING) AS qty_text",
    "CASE WHEN l_returnflag = 'A' THEN 'n/a' ELSE CAST(CAST(l_quantity AS BIGINT) AS STRING) END AS two_thirds",
    "CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'none' ELSE CAST(l_linenumber AS STRING) END AS most",
    "CASE WHEN l_returnflag = 'A' THEN NULL ELSE CAST(l_linenumber AS STRING) END AS with_gaps",
    "CASE WHEN l_discount > 0.09 THEN CAST(l_linenumber AS STRING) ELSE 'unknown' END AS price_note",
    "CASE WHEN l_discount > 0.09 THEN CAST(l_linenumber AS STRING) ELSE 'unknown' END AS remark",
    "CAST(CAST(l_shipdate AS DATE) AS STRING) AS shipped",
    "CASE WHEN l_linestatus = 'O' THEN 'True' WHEN l_returnflag = 'N' THEN 'yes' ELSE 'false' END AS open_text",
    "l_returnflag",
))
NUMBER_RE = r"[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?"


def sql_number(c: str) -> str:
    return f"CASE WHEN regexp_full_match(trim({c}), '{NUMBER_RE}') THEN TRY_CAST(trim({c}) AS DOUBLE) END"
