"""Temporal joins: validity-interval joins, as-of joins, event windows (C-07..C-13).

As-of (C-08): facts and panel rows are unioned and the newest fact is carried forward
with ``last(struct, ignorenulls)`` over the security's rows in time order: linear
(days + quarters), one shuffle by security, no days x quarters blow-up. The carried
struct holds the fact's effective date so a staleness cap (C-09) is a plain compare.
Per-security windows here run over daily series, bounded by the trading calendar.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def link_to_permno(facts: DataFrame, link: DataFrame, date_col: str) -> DataFrame:
    """C-07: gvkey -> permno where linkdt <= date <= linkenddt (NULL end open)."""
    l = link.select("gvkey", F.col("lpermno").alias("permno"), "linkdt", "linkenddt")
    cond = (F.col(date_col) >= F.col("linkdt")) & (F.col("linkenddt").isNull() | (F.col(date_col) <= F.col("linkenddt")))
    return facts.join(l, "gvkey", "inner").filter(cond).drop("linkdt", "linkenddt")


def asof_join(panel: DataFrame, facts: DataFrame, by, panel_date: str, fact_date: str,
              value_cols: list[str], tie_cols: list[str] | None = None, strict: bool = False,
              max_age_days: int | None = None, prefix: str = "", fact_by=None,
              panel_shift_days: int = 0) -> DataFrame:
    """Attach to each panel row the newest fact with ``fact_date <= panel_date``.

    ``strict`` uses ``<`` instead. Ties on ``fact_date`` go to the greatest
    ``tie_cols``. ``max_age_days`` nulls a match older than that many days. Panel
    columns travel through the union, so there is no join back. Output: the panel
    columns plus ``prefix + value`` for each value and ``prefix + fact_date``.
    """
    tie_cols = tie_cols or []
    by = [by] if isinstance(by, str) else list(by)
    fact_by = by if fact_by is None else ([fact_by] if isinstance(fact_by, str) else list(fact_by))
    payload = [F.col(fact_date).alias("_eff")] + [F.col(c).alias("_v_" + c) for c in value_cols]
    # facts sort before (inclusive) or after (strict) panel rows of the same date
    fact_k, panel_k = (1, 0) if strict else (0, 1)
    keys = [f"_by{i}" for i in range(len(by))]
    f = facts.select(*[F.col(c).alias(k) for c, k in zip(fact_by, keys)], F.col(fact_date).alias("_t"),
                     F.lit(fact_k).alias("_k"), *[F.col(c).alias("_tie" + str(i)) for i, c in enumerate(tie_cols)],
                     F.struct(*payload).alias("_fact"))
    lookup = F.col(panel_date) if not panel_shift_days else F.date_sub(F.col(panel_date), panel_shift_days)
    p = panel.select("*", *[F.col(c).alias(k) for c, k in zip(by, keys)], lookup.alias("_t"), F.lit(panel_k).alias("_k"))
    u = p.unionByName(f, allowMissingColumns=True)
    order = [F.col("_t"), F.col("_k")] + [F.col("_tie" + str(i)).asc_nulls_first() for i in range(len(tie_cols))]
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = u.withColumn("_m", F.last("_fact", ignorenulls=True).over(w)).filter(F.col("_k") == panel_k)
    m = F.col("_m")
    fresh = m.isNotNull()
    if max_age_days is not None:
        fresh = fresh & (F.datediff(F.col("_t"), m["_eff"]) <= max_age_days)
    return carried.select(*panel.columns, *[F.when(fresh, m["_v_" + c]).alias(prefix + c) for c in value_cols],
                          F.when(fresh, m["_eff"]).alias(prefix + fact_date))


def next_row_join(events: DataFrame, rows: DataFrame, by: str, event_date: str, row_date: str,
                  row_cols: list[str]) -> DataFrame:
    """C-13: each event with ``row_cols`` of the first row of its key on or after the event's date.

    The as-of carry run backwards: rows and events are unioned, and walking from the last day to
    the first the newest row seen is carried to the events. Linear, one shuffle by key.
    """
    r = rows.select(F.col(by).alias("_by"), F.col(row_date).alias("_t"), F.lit(0).alias("_k"),
                    F.struct(*[F.col(c).alias(c) for c in row_cols]).alias("_row"))
    e = events.select("*", F.col(by).alias("_by"), F.col(event_date).alias("_t"), F.lit(1).alias("_k"))
    w = Window.partitionBy("_by").orderBy(F.col("_t").desc(), "_k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    u = e.unionByName(r, allowMissingColumns=True).withColumn("_m", F.last("_row", ignorenulls=True).over(w))
    return u.filter(F.col("_k") == 1).select(*events.columns, *[F.col("_m")[c].alias(c) for c in row_cols])


def attach_point_in_time(panel: DataFrame, sources: list[tuple[str, DataFrame, str, list[str], int | None]],
                         flows: tuple[DataFrame, list[str], int] | None = None) -> DataFrame:
    """Several as-of carries and trailing calendar sums in ONE window pass.

    ``sources``: (name, facts, fact_date, value_cols, max_age_days); each facts frame has
    ``permno`` and at most one row per (permno, fact_date) (dedupe first). ``flows``:
    (daily frame with permno/date, value columns, days) summed over the trailing days.
    Panel rows, facts and flows are unioned and ordered by day, then kind (facts and
    flows before the panel row of the same day, inclusive as-of), in one number whose
    multiplier is the number of kinds, so any number of sources keeps its order; carries
    use a running frame, flows a RANGE frame on the same key, so one shuffle and one
    sort serve all.
    """
    flow_kind = len(sources)
    panel_kind = flow_kind + 1
    kinds = panel_kind + 1

    def day(c):
        return F.datediff(F.col(c), F.lit("1970-01-01").cast("date")).cast("long")

    p = panel.select("*", (day("date") * kinds + panel_kind).alias("_key"), F.lit(True).alias("_panel"))
    parts = [p]
    for i, (name, facts, fdate, vals, _) in enumerate(sources):
        s = F.struct(F.col(fdate).alias("_eff"), *[F.col(v).alias(v) for v in vals])
        parts.append(facts.select("permno", (day(fdate) * kinds + i).alias("_key"), s.alias(f"_src_{name}")))
    if flows is not None:
        daily, cols, _ = flows
        parts.append(daily.select("permno", (day("date") * kinds + flow_kind).alias("_key"), *cols))
    u = parts[0]
    for part in parts[1:]:
        u = u.unionByName(part, allowMissingColumns=True)
    w = Window.partitionBy("permno").orderBy("_key")
    carried = {}
    for name, _, _, _, _ in sources:
        carried[f"_m_{name}"] = F.last(f"_src_{name}", ignorenulls=True).over(
            w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    if flows is not None:
        _, cols, days = flows
        frame = w.rangeBetween(-(kinds * (days - 1) + panel_kind), 0)
        for c in cols:
            carried[f"_f_{c}"] = F.coalesce(F.sum(c).over(frame), F.lit(0.0))
    u = u.withColumns(carried).filter(F.col("_panel"))
    out = [F.col(c) for c in panel.columns]
    for name, _, fdate, vals, max_age in sources:
        m = F.col(f"_m_{name}")
        fresh = m.isNotNull()
        if max_age is not None:
            fresh = fresh & (F.datediff(F.col("date"), m["_eff"]) <= max_age)
        out += [F.when(fresh, m[v]).alias(v) for v in vals] + [F.when(fresh, m["_eff"]).alias(fdate)]
    if flows is not None:
        out += [F.col(f"_f_{c}").alias(c) for c in flows[1]]
    return u.select(*out)
