"""Column semantics kit: the few rules where a naive Spark translation answers differently.

M1 guarded ratios, M2 null-keeping clips, M3 min-periods guard, M5 sums of nulls,
M7 horizontal ops that skip nulls, M11 cumulative sums that keep nulls, M12 guarded logs.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(a, b) -> Column:
    """a / b, NULL on a zero or NULL denominator (ANSI-safe)."""
    return F.try_divide(col(a), col(b))


def safe_ln(x) -> Column:
    """ln(x) for x > 0, else NULL."""
    x = col(x)
    return F.when(x > 0, F.ln(x))


def clip_lower(x, lo) -> Column:
    x = col(x)
    return F.when(x.isNotNull(), F.greatest(x, F.lit(lo) if not isinstance(lo, Column) else lo))


def clip_upper(x, hi) -> Column:
    x = col(x)
    return F.when(x.isNotNull(), F.least(x, F.lit(hi) if not isinstance(hi, Column) else hi))


def clip(x, lo, hi) -> Column:
    """Clip keeping NULL input as NULL; a NULL bound leaves that side unclipped."""
    x = col(x)
    lo = lo if isinstance(lo, Column) else F.lit(lo)
    hi = hi if isinstance(hi, Column) else F.lit(hi)
    return F.when(x.isNotNull(), F.least(F.greatest(x, lo), hi))


def sum_or_zero(x) -> Column:
    """Aggregate sum that is 0 when every input is NULL."""
    return F.coalesce(F.sum(col(x)), F.lit(0))


def bit(cond: Column, value: int) -> Column:
    """Bool to bit; a NULL condition contributes 0."""
    return F.when(cond, F.lit(value)).otherwise(F.lit(0))


def rows_frame(w: WindowSpec, n: int) -> WindowSpec:
    return w.rowsBetween(-(n - 1), Window.currentRow)


def full(agg, x, w: WindowSpec, n: int, min_periods: int | None = None) -> Column:
    """Rolling ``agg`` over the last ``n`` rows, NULL until ``min_periods`` non-null values."""
    frame = rows_frame(w, n)
    need = n if min_periods is None else min_periods
    x = col(x)
    return F.when(F.count(x).over(frame) >= need, agg(x).over(frame))


def ewm_alpha(span: int) -> float:
    return 2.0 / (span + 1.0)


def ewm_frame_rows(span: int, tol_log: float = 36.8) -> int:
    """Rows K after which adjusted-EWM weights fall below exp(-tol_log) of the newest."""
    q = 1.0 - ewm_alpha(span)
    return int(math.ceil(tol_log / -math.log(q)))


EXP_RANGE = 690.0  # exp of this, times any price, stays a finite double


def ewm_mean(x, span: int, w: WindowSpec, pos: Column) -> Column:
    """Adjusted exponentially weighted mean (alpha = 2/(span+1)) as running sums.

    num_t = sum_i q^(t-i) x_i = q^t * sum_i q^-i x_i, both sums running (O(1) per row,
    no per-row arrays). ``pos`` is the row position inside the window partition,
    starting at 0; partitions are bounded (see ``series.split_series``) so q^-pos
    stays inside the double range, and a position beyond it is an error, never a wrong
    value. NULL inputs carry no weight; the result is NULL until the first non-null input.
    """
    q = 1.0 - ewm_alpha(span)
    x = col(x)
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    limit = int(EXP_RANGE / -math.log(q))
    too_long = F.raise_error(F.lit(f"an EWM of span {span} holds at most {limit} rows a partition: use smaller chunks"))
    up = F.when(pos <= limit, F.pow(F.lit(q), -pos)).otherwise(too_long.cast("double"))
    num = F.sum(x * up).over(running)
    den = F.sum(F.when(x.isNotNull(), up)).over(running)
    return F.try_divide(num, den)


def running_sum_keep_null(x, w: WindowSpec) -> Column:
    """Cumulative sum that is NULL where the input is NULL."""
    x = col(x)
    return F.when(x.isNotNull(), F.sum(x).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))


# Fixed value: rounding nudge. Inputs carry exactly 6 decimals, so averages over 20/50/200
# rows sit exactly on a rounding tie at the 7th decimal; engines that sum in another order
# land 1e-14 either side of it. Shifting by 1.3e-9 (off the 5e-9 grid of such averages)
# puts every such value clearly on one side in every engine.
ROUND_NUDGE = 1.3e-9


def round6(c: Column, digits: int = 6) -> Column:
    return F.round(c + F.lit(ROUND_NUDGE), digits)


def round_doubles(df, digits: int = 6):
    """Round every DOUBLE/FLOAT column (output contract for value comparison)."""
    from pyspark.sql.types import DoubleType, FloatType

    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            cols.append(round6(F.col(f.name), digits).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


# ---------------------------------------------------------------------------
# Rolling statistics in O(1) per row.
#
# Spark evaluates a sliding ROWS frame by re-aggregating the whole frame for every
# row (O(N) per row). Sums, counts, means, variances and regression slopes are
# instead differences of running sums (``running`` frames are incremental) looked up
# with ``lag``; maxima and minima combine lagged block maxima. Running sums restart
# at every window partition, which the split series keeps to a few thousand rows.
# ---------------------------------------------------------------------------


def finite(x: Column) -> Column:
    """Neither NaN nor infinite (NULL stays NULL)."""
    return F.abs(x) < F.lit(float("inf"))


class Prefix:
    """Running sums of a column (and of its square / product with a partner).

    NaN and infinite values would stay in a running sum for good, so the sums leave them out and a
    running count of them makes NaN of the windows that hold one, and of no other.
    """

    def __init__(self, w: WindowSpec, centers: dict[str, str] | None = None):
        """``centers`` maps a column to a per-partition constant column used as its centre
        (sums of squares of large values stay small); other columns are not centred."""
        self.w = w
        self.run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        self.cols: dict[str, Column] = {}
        self.centers: dict[str, Column] = {}
        self.center_of = dict(centers or {})

    def _add(self, name: str, expr: Column) -> str:
        self.cols.setdefault(name, F.sum(expr).over(self.run))
        return name

    def count(self, x: str) -> str:
        return self._add(f"_pc_{x}", F.col(x).isNotNull().cast("long"))

    def _centered(self, x: str) -> Column:
        """x minus its centre K (a constant per partition, else 0): same variance, and the
        differences of running sums keep their precision."""
        k = F.col(self.center_of[x]).cast("double") if x in self.center_of else F.lit(0.0)
        self.centers.setdefault(f"_pk_{x}", F.when(finite(k), k).otherwise(F.lit(0.0)))
        self._add(f"_pn_{x}", (~finite(F.col(x).cast("double"))).cast("long"))
        return F.col(x).cast("double") - F.col(f"_pk_{x}")

    def s1(self, x: str) -> str:
        d = self._centered(x)
        return self._add(f"_p1_{x}", F.when(finite(d), d).otherwise(F.lit(0.0)))

    def s2(self, x: str) -> str:
        d = self._centered(x)
        return self._add(f"_p2_{x}", F.when(finite(d), d * d).otherwise(F.lit(0.0)))

    def pair(self, y: str, x: str) -> None:
        yc, xc = F.col(y).cast("double"), F.col(x).cast("double")
        both, sound = yc.isNotNull() & xc.isNotNull(), finite(yc) & finite(xc)
        k = f"{y}_{x}"
        self._add(f"_qn_{k}", both.cast("long"))
        self._add(f"_qb_{k}", (both & ~sound).cast("long"))
        for name, value in (("_qx_", xc), ("_qy_", yc), ("_qxx_", xc * xc), ("_qxy_", xc * yc)):
            self._add(name + k, F.when(sound, value).otherwise(F.lit(0.0)))

    def apply(self, df):
        if self.centers:
            df = df.withColumns(self.centers)
        out = df.withColumns(self.cols)
        self.cols, self.centers = {}, {}
        return out


def _window_diff(w: WindowSpec, name: str, n: int) -> Column:
    return F.col(name) - F.coalesce(F.lag(F.col(name), n).over(w), F.lit(0))


def _held(w: WindowSpec, name: str, n: int) -> Column:
    """Whether the last ``n`` rows hold a NaN or infinite value; a running count that has met only NULLs is NULL."""
    return F.coalesce(_window_diff(w, name, n), F.lit(0)) > 0


def roll_count(w: WindowSpec, x: str, n: int) -> Column:
    return _window_diff(w, f"_pc_{x}", n)


def roll_mean(w: WindowSpec, x: str, n: int, min_periods: int | None = None) -> Column:
    c = roll_count(w, x, n)
    mean = F.col(f"_pk_{x}") + ratio(_window_diff(w, f"_p1_{x}", n), c)
    return F.when(c >= (n if min_periods is None else min_periods),
                  F.when(_held(w, f"_pn_{x}", n), F.lit(float("nan"))).otherwise(mean))


def roll_sum(w: WindowSpec, x: str, n: int, min_periods: int | None = None) -> Column:
    c = roll_count(w, x, n)
    total = _window_diff(w, f"_p1_{x}", n) + F.col(f"_pk_{x}") * c
    return F.when(c >= (n if min_periods is None else min_periods),
                  F.when(_held(w, f"_pn_{x}", n), F.lit(float("nan"))).otherwise(total))


def roll_var(w: WindowSpec, x: str, n: int, min_periods: int | None = None) -> Column:
    c = roll_count(w, x, n)
    s1, s2 = _window_diff(w, f"_p1_{x}", n), _window_diff(w, f"_p2_{x}", n)
    var = F.greatest(ratio(s2 - s1 * ratio(s1, c), c - 1), F.lit(0.0))
    need = n if min_periods is None else min_periods
    return F.when((c >= need) & (c >= 2), F.when(_held(w, f"_pn_{x}", n), F.lit(float("nan"))).otherwise(var))


def roll_std(w: WindowSpec, x: str, n: int, min_periods: int | None = None) -> Column:
    return F.sqrt(roll_var(w, x, n, min_periods))


def roll_slope(w: WindowSpec, y: str, x: str, n: int) -> tuple[Column, Column]:
    """(pair count, OLS slope of y on x) over the last ``n`` rows, pairs with both non-null."""
    k = f"{y}_{x}"
    cnt = _window_diff(w, f"_qn_{k}", n)
    sx, sy = _window_diff(w, f"_qx_{k}", n), _window_diff(w, f"_qy_{k}", n)
    sxx, sxy = _window_diff(w, f"_qxx_{k}", n), _window_diff(w, f"_qxy_{k}", n)
    slope = ratio(sxy - sx * ratio(sy, cnt), sxx - sx * ratio(sx, cnt))
    return cnt, F.when(_held(w, f"_qb_{k}", n), F.lit(float("nan"))).otherwise(slope)


BLOCK = 16


def roll_extreme(w: WindowSpec, x: str, n: int, fn: str = "max") -> Column:
    """Max/min over the last ``n`` rows from block extremes: an ``BLOCK``-row frame at
    lags 0, BLOCK, 2*BLOCK, ... plus one remainder frame (about n/BLOCK + 2*BLOCK
    updates per row instead of n). NULLs are skipped as in the plain aggregate."""
    agg = F.max if fn == "max" else F.min
    comb = F.greatest if fn == "max" else F.least
    if n <= 2 * BLOCK:
        return agg(x).over(w.rowsBetween(-(n - 1), Window.currentRow))
    full_blocks, rem = divmod(n, BLOCK)
    blk = agg(x).over(w.rowsBetween(-(BLOCK - 1), Window.currentRow))
    parts = [blk] + [F.lag(blk, k * BLOCK).over(w) for k in range(1, full_blocks)]
    if rem:
        tail = agg(x).over(w.rowsBetween(-(rem - 1), Window.currentRow))
        parts.append(F.lag(tail, full_blocks * BLOCK).over(w))
    return comb(*parts)


def roll_quantile(w: WindowSpec, x: str, n: int, p: float, blocks: int = 4, count: Column | None = None) -> Column:
    """Linear-interpolated quantile of the last ``n`` rows, only when all ``n`` are non-null.

    Only the k = floor(p*(n-1)) + 2 smallest values matter, and each of them is among
    the k smallest of its block, so every row sorts one block frame (n/blocks rows),
    keeps its k smallest, and merges the lagged lists of the other blocks
    (blocks*k values) instead of sorting all n. ``sort_array`` sorts primitives; ``array_sort``
    would call an interpreted comparison for every pair.
    """
    pos = p * (n - 1)
    lo = int(math.floor(pos))
    frac = pos - lo
    k = min(lo + 2, n)
    size = -(-n // blocks)
    cnt = count if count is not None else F.count(F.col(x)).over(w.rowsBetween(-(n - 1), Window.currentRow))

    def smallest(rows: int) -> Column:
        frame = w.rowsBetween(-(rows - 1), Window.currentRow)
        return F.slice(F.sort_array(F.collect_list(F.col(x)).over(frame)), 1, k)

    full_blocks, rem = divmod(n, size)
    blk = smallest(size)
    parts = [blk] + [F.lag(blk, i * size).over(w) for i in range(1, full_blocks)]
    if rem:
        parts.append(F.lag(smallest(rem), full_blocks * size).over(w))
    merged = F.sort_array(F.concat(*parts))
    a = F.element_at(merged, lo + 1)
    b = F.element_at(merged, min(lo + 2, n))
    return F.when(cnt == n, a + F.lit(frac) * (b - a))
