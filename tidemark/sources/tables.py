"""Driver tables and the derived research tables (fixture recipes).

Each recipe is plain SQL over the driver tables with ``{table}`` placeholders. On Spark
the placeholders are bound to DataFrames through ``spark.sql(text, **frames)``, so
Catalyst sees one plan from the Parquet scan up (pruning and pushdown included); the
oracle binds the same text to DuckDB views. The recipe text is the input contract
documented in FIXTURES.md, so both engines start from identical rows.
"""

from __future__ import annotations

import os
import re

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# Recipe text shared with the oracle (see FIXTURES.md).
RECIPES: dict[str, str] = {
    "raw_dsf": """
SELECT l_suppkey AS permno, CAST(l_shipdate AS DATE) AS date,
  l_orderkey * 100000000 + l_linenumber * 10000000 + l_partkey AS row_id,
  CASE WHEN l_orderkey % 7 = 0 THEN -1 ELSE 1 END * (50 + l_extendedprice / 10000) * CASE WHEN l_orderkey % 79 = 0 THEN 2 ELSE 1 END AS prc,
  CASE WHEN l_orderkey % 97 = 0 THEN 0 WHEN l_orderkey % 83 = 0 THEN 20
       ELSE 50 + l_extendedprice / 10000 * (0.95 + l_discount) END AS openprc,
  (51 + l_extendedprice / 10000) * (1 + l_tax) AS askhi,
  (49 + l_extendedprice / 11000) * (1 - l_tax) AS bidlo,
  CAST(l_quantity * CASE WHEN l_orderkey % 89 = 0 THEN -100 ELSE 100 END AS BIGINT) AS vol,
  CASE WHEN l_orderkey % 61 = 0 THEN NULL WHEN l_orderkey % 211 = 0 THEN 0.9 ELSE l_discount - 0.05 + l_tax / 10 END AS ret,
  CASE WHEN l_orderkey % 61 = 0 THEN NULL ELSE l_discount - 0.05 END AS retx,
  1000 + l_partkey % 500 AS shrout,
  CASE WHEN l_shipdate < TIMESTAMP '1999-01-01 00:00:00' THEN CAST(2 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END AS cfacpr,
  CASE WHEN l_shipdate < TIMESTAMP '1999-01-01 00:00:00' THEN CAST(2 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END AS cfacshr
FROM {lineitem}""",
    "bars": """
WITH x AS (SELECT l_suppkey, CAST(l_shipdate AS DATE) AS date, 50 + l_extendedprice / 10000 AS px, l_quantity,
  row_number() OVER (PARTITION BY l_suppkey, l_shipdate ORDER BY l_orderkey, l_linenumber, l_partkey) AS rn FROM {lineitem})
SELECT l_suppkey AS permno, date, min_by(px, rn) AS open, max(px) * 1.01 AS high, min(px) * 0.99 AS low, max_by(px, rn) AS close,
  CAST(sum(l_quantity) * 100 AS BIGINT) AS volume, 1000000 + l_suppkey * 1000 AS shares_outstanding
FROM x GROUP BY l_suppkey, date""",
    "raw_dsenames": """
SELECT s_suppkey AS permno, concat('T', CAST(s_suppkey AS VARCHAR(20))) AS ticker, s_name AS company_name,
  CASE WHEN s_suppkey % 5 = 4 THEN 31 ELSE 10 + s_suppkey % 2 END AS shrcd, 1 + s_suppkey % 3 AS exchange_code,
  DATE '1995-01-01' AS namedt, DATE '1998-06-30' AS nameendt FROM {supplier}
UNION ALL
SELECT s_suppkey, concat('U', CAST(s_suppkey AS VARCHAR(20))), s_name,
  CASE WHEN s_suppkey % 5 = 4 THEN 31 ELSE 10 + s_suppkey % 2 END, 1 + s_suppkey % 3,
  DATE '1998-07-01', CASE WHEN s_suppkey % 2 = 0 THEN CAST(NULL AS DATE) ELSE DATE '2001-06-30' END FROM {supplier}""",
    "raw_dsfhdr": """
SELECT s_suppkey AS permno, 10 + s_suppkey % 2 AS hshrcd, 1 + s_suppkey % 3 AS hexcd FROM {supplier}""",
    "raw_dsi": """
SELECT CAST(l_shipdate AS DATE) AS date, sum(l_quantity * (l_discount - 0.05)) / sum(l_quantity) AS vwretd, avg(l_discount - 0.05) AS ewretd
FROM {lineitem} GROUP BY CAST(l_shipdate AS DATE)""",
    "delistings": """
SELECT l_suppkey AS permno, CAST(max(l_shipdate) AS DATE) AS date,
  CASE WHEN l_suppkey % 4 = 0 THEN CAST(NULL AS DOUBLE) ELSE -0.1 END AS dlret, CASE WHEN l_suppkey % 4 = 0 THEN 520 ELSE 231 END AS dlstcd
FROM {lineitem} WHERE l_suppkey % 2 = 0 GROUP BY l_suppkey""",
    "fundq": """
WITH o AS (SELECT 10000 + o_custkey % (SELECT count(*) FROM {supplier}) AS gvkey, CAST(date_trunc('quarter', o_orderdate) AS DATE) AS q0, o_totalprice AS p FROM {orders}),
g AS (SELECT gvkey, q0, CAST(last_day(CAST(q0 + INTERVAL '2' MONTH AS DATE)) AS DATE) AS datadate, round(sum(p), 2) / 1000 AS rev, count(*) AS n FROM o GROUP BY gvkey, q0)
SELECT gvkey, datadate, CASE WHEN gvkey % 11 = 0 THEN CAST(NULL AS DATE) ELSE CAST(datadate + CAST(30 + gvkey % 40 AS INT) AS DATE) END AS rdq,
  CAST(year(q0) AS INT) AS fyearq, CAST(quarter(q0) AS INT) AS fqtr, rev AS revtq, rev * (50 + gvkey % 10) / 100 AS cogsq, rev * 0.1 - 50 AS niq,
  rev * 0.2 - 40 AS oibdpq, (rev * 0.1 - 50) / 100 AS epspxq, rev * 8 AS atq, rev * 3 - 400 AS ceqq, rev * 2 AS dlttq, rev * 0.5 AS dlcq, rev * 0.7 AS cheq,
  rev * 0.15 * quarter(q0) AS oancfy, rev * 0.05 * quarter(q0) AS capxy, rev * -0.04 * quarter(q0) AS ivncfy, CAST(1 + gvkey % 100 AS DOUBLE) AS cshoq
FROM g""",
    "ccm_link": """
SELECT 10000 + s_suppkey AS gvkey, s_suppkey AS lpermno, DATE '1995-01-01' AS linkdt, CASE WHEN s_suppkey % 3 = 0 THEN DATE '2000-06-30' ELSE CAST(NULL AS DATE) END AS linkenddt FROM {supplier}""",
    "ibes_detail": """
SELECT o_custkey % (SELECT count(*) FROM {supplier}) AS permno, o_custkey AS analyst, CAST(o_orderdate AS DATE) AS estdate,
  CAST(last_day(CAST(CAST(date_trunc('quarter', o_orderdate) AS DATE) + INTERVAL '2' MONTH AS DATE)) AS DATE) AS fpedats, o_totalprice / 100000 - 1 AS est FROM {orders}""",
    "form4": """
SELECT l_suppkey AS permno, l_orderkey AS filer, CAST(l_shipdate AS DATE) AS trade_date, CASE l_returnflag WHEN 'A' THEN 'P' WHEN 'R' THEN 'S' ELSE 'M' END AS transaction_type, l_quantity AS shares FROM {lineitem}""",
    "sector": """
SELECT s_suppkey AS permno, r_name AS sector FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey""",
    "ticks": """
SELECT event_id, user_id % 20 AS symbol, ts, value AS price, 1 + event_id % 100 AS size, event_type FROM {events}""",
}

_PLACEHOLDER = re.compile(r"\{(\w+)\}")


# Fixed value: tasks that a month's lines are dealt to where bars are built for a table by month.
MONTH_PARTS = 8


def build_bars(lineitem: DataFrame, by_month: bool = False) -> DataFrame:
    """``bars`` as one partial aggregate: open/close are the prices of the first/last line
    in (orderkey, linenumber, partkey) order, taken with min_by/max_by on a struct key, so
    a hot (supplier, day) combines map-side instead of being numbered in one window group.
    Same rows as the recipe text (checked against it by the oracle tests). ``by_month``: the lines are dealt by month
    and ``MONTH_PARTS`` shares of the suppliers instead, once for the bars and for a table by month."""
    from pyspark.sql import functions as F

    key = F.struct("l_orderkey", "l_linenumber", "l_partkey")
    px = 50 + F.col("l_extendedprice") / 10000
    g = lineitem.select("l_suppkey", F.col("l_shipdate").cast("date").alias("date"), px.alias("px"),
                        "l_quantity", key.alias("k"))
    keys = ["l_suppkey", "date"]
    if by_month:
        dealt = {"_month": F.trunc("date", "month"), "_part": F.pmod(F.hash("l_suppkey"), F.lit(MONTH_PARTS))}
        g = g.withColumns(dealt).repartition(*dealt)
        keys += dealt
    return g.groupBy(*keys).agg(
        F.min_by("px", "k").alias("open"), (F.max("px") * 1.01).alias("high"), (F.min("px") * 0.99).alias("low"),
        F.max_by("px", "k").alias("close"), (F.sum("l_quantity") * 100).cast("bigint").alias("volume"),
    ).select(F.col("l_suppkey").alias("permno"), "date", "open", "high", "low", "close", "volume",
             (1000000 + F.col("l_suppkey") * 1000).alias("shares_outstanding"))


# DataFrame builders used on the Spark side instead of the recipe text (same rows).
BUILDERS = {"bars": lambda t: build_bars(t.base("lineitem"))}


def recipe_inputs(name: str) -> list[str]:
    return sorted(set(_PLACEHOLDER.findall(RECIPES[name])))


def recipe_sql(name: str) -> str:
    """The recipe text with plain table names (oracle side)."""
    return _PLACEHOLDER.sub(lambda m: m.group(1), RECIPES[name]).strip()


def read_base(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{table}.parquet"))


class Tables:
    """Lazily built research tables for one data directory.

    Every attribute is a lazy DataFrame; nothing is computed until an action runs.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._cache: dict[str, DataFrame] = {}

    def base(self, table: str) -> DataFrame:
        key = "base:" + table
        if key not in self._cache:
            self._cache[key] = read_base(self.spark, self.sf_dir, table)
        return self._cache[key]

    def __getitem__(self, name: str) -> DataFrame:
        if name in BASE_TABLES:
            return self.base(name)
        if name not in self._cache:
            if name in BUILDERS:
                self._cache[name] = BUILDERS[name](self)
            else:
                frames = {t: self.base(t) for t in recipe_inputs(name)}
                self._cache[name] = self.spark.sql(RECIPES[name].strip(), **frames)
        return self._cache[name]

    def dict(self, *names: str) -> dict[str, DataFrame]:
        return {n: self[n] for n in names}


def oracle_with(*names: str) -> str:
    """``WITH`` clause binding the named recipes for a DuckDB query."""
    return "WITH " + ",\n".join(f"{n} AS ({recipe_sql(n)})" for n in names)
