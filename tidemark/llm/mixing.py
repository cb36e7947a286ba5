"""Mixing sources to target weights by capped water-filling.

Targets share the total size by weight; a source whose share exceeds ``max_epochs`` times its own
size is clamped there and the excess is reshared among the others in proportion to their weights
until nobody is above. The feasible point is ``min(cap, level * weight)``: sorted by cap/weight, the
clamped sources are a prefix, so running sums give the level without iterating.

A source is then repeated ``floor(target / size)`` whole times, and the missing words come from a
seeded order of its documents: each takes one more repetition until the target is met, the last one
a fractional repetition. Documents are dealt into 4,096 bins by their seeded hash, bins are summed
by partial aggregates, and only the one bin per source in which the target falls is sorted, so a
source that holds a third of all rows is never gathered into one task.

Defined results: null text has size 0; null sources are one source, last in code point order; a null
doc_id hashes as the text ``null``; repeated rows are separate rows; an empty table gives no rows;
sources of size 0 have target 0. Input columns whose names clash with the added ones are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import WORD, materialise

BIN_HEX = 3  # 16**3 bins
ADDED = ["size", "source_size", "target", "taken"]


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def water_fill(sources: DataFrame, weights: list[int], max_epochs: int) -> DataFrame:
    """Per source (source, source_size): weight and target. One row per source."""
    every = Window.partitionBy()
    before = Window.orderBy("ratio", "rank").rowsBetween(Window.unboundedPreceding, -1)
    cycle = F.array(*[F.lit(w) for w in weights])
    ranked = (
        sources.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
        .withColumn("weight", F.element_at(cycle, (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int")))
        .withColumn("cap", F.col("source_size") * max_epochs)
        .withColumn("ratio", F.col("cap").cast("double") / F.col("weight"))
    )
    levels = ranked.withColumns({
        "level": (F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0))).cast("double")
        / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))).cast("double"),
        "pos": F.row_number().over(Window.orderBy("ratio", "rank")),
    })
    free = F.col("level") * F.col("weight") <= F.col("cap")
    first = levels.withColumn("free_pos", F.min(F.when(free, F.col("pos"))).over(every))
    final = first.withColumn("fill", F.max(F.when(F.col("pos") == F.col("free_pos"), F.col("level"))).over(every))
    target = F.when(F.col("pos") < F.col("free_pos"), F.col("cap").cast("double")).otherwise(F.col("fill") * F.col("weight"))
    return final.select("source", "source_size", "weight", target.alias("target"))


def mix(docs: DataFrame, weights: list[int] | None = None, max_epochs: int = 3, seed: str = "mix") -> DataFrame:
    """All rows and columns of ``docs`` with size, source_size, target and taken."""
    clash = {a.lower() for a in ADDED}
    docs = docs.drop(*[c for c in docs.columns if c.lower() in clash])
    own = docs.columns
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).cast("binary"))
    sized = docs.withColumns({"size": n_words(F.col("text")), "__key": key})
    binned = sized.withColumn("__bin", F.substring("__key", 1, BIN_HEX))

    sums = materialise(binned.groupBy("source", "__bin").agg(F.sum("size").alias("bin_size")))
    targets = water_fill(sums.groupBy("source").agg(F.sum("bin_size").alias("source_size")), weights or [1, 2, 3], max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    plan = targets.withColumn("whole", F.least(whole, F.lit(max_epochs)).cast("long")).withColumn(
        "extra", F.greatest(F.lit(0), F.round("target").cast("long") - F.col("whole") * F.col("source_size")))
    running = F.sum("bin_size").over(Window.partitionBy("source").orderBy("__bin")) - F.col("bin_size")
    edge = (
        sums.withColumn("ahead", running)
        .join(plan.select(F.col("source").alias("s"), "extra"), F.col("source").eqNullSafe(F.col("s")))
        .where((F.col("ahead") <= F.col("extra")) & (F.col("extra") < F.col("ahead") + F.col("bin_size")))
        .select(F.col("source").alias("s"), F.col("__bin").alias("edge_bin"), "ahead")
    )
    # Without an edge the whole source takes its extra repetition (or there is none to take).
    plan = materialise(
        plan.join(edge, F.col("source").eqNullSafe(F.col("s")), "left")
        .select(F.col("source").alias("__source"), "source_size", "target", F.col("whole").alias("__whole"),
                F.col("extra").alias("__extra"), F.coalesce("edge_bin", F.lit("g")).alias("__edge"),
                F.col("ahead").alias("__ahead")))

    rows = binned.join(plan, F.col("source").eqNullSafe(F.col("__source")))
    below = F.when((F.col("__bin") < F.col("__edge")) & (F.col("__extra") > 0), F.col("size")).otherwise(F.lit(0))
    plain = rows.where(F.col("__bin") != F.col("__edge")).withColumn("__more", below)
    order = Window.partitionBy("source").orderBy("__key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("__extra") - F.col("__ahead") - F.coalesce(F.sum("size").over(order), F.lit(0))
    inside = rows.where(F.col("__bin") == F.col("__edge")).withColumn(
        "__more", F.least(F.greatest(left, F.lit(0)), F.col("size")))
    return plain.unionByName(inside).select(
        *own, "size", "source_size", "target", (F.col("__whole") * F.col("size") + F.col("__more")).alias("taken"))


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS k
  FROM documents),
src AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) AS rnk FROM src),
weighted AS (
  SELECT *, (rnk - 1) % 3 + 1 AS weight, source_size * 3 AS cap,
         CAST(source_size * 3 AS DOUBLE) / ((rnk - 1) % 3 + 1) AS ratio FROM ranked),
levels AS (
  SELECT *, row_number() OVER (ORDER BY ratio, rnk) AS pos,
         CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0) AS DOUBLE)
           / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER b, 0) AS DOUBLE) AS level
  FROM weighted WINDOW b AS (ORDER BY ratio, rnk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
firsts AS (
  SELECT *, min(CASE WHEN level * weight <= cap THEN pos END) OVER () AS free_pos FROM levels),
filled AS (
  SELECT *, max(CASE WHEN pos = free_pos THEN level END) OVER () AS fill FROM firsts),
targets AS (
  SELECT source, source_size,
         CASE WHEN pos < free_pos THEN CAST(cap AS DOUBLE) ELSE fill * weight END AS target FROM filled),
plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN least(CAST(floor(target / source_size) AS BIGINT), 3) ELSE 0 END AS whole
  FROM targets),
rows_ AS (
  SELECT s.doc_id, s.size, p.source_size, p.target, p.whole,
         greatest(0, CAST(round(p.target) AS BIGINT) - p.whole * p.source_size) AS extra,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.k, s.doc_id, s.size
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM sized s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source)
"""
ORACLE_SQL = ORACLE + """
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(whole * size + least(greatest(extra - ahead, 0), size) AS BIGINT) AS taken
FROM rows_
"""
