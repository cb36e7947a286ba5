"""Helpers that write DuckDB SQL text for the oracle side."""

from __future__ import annotations

from tidemark.functions.semantics import ROUND_NUDGE, ewm_alpha, ewm_frame_rows


def div(a: str, b: str) -> str:
    return f"(CASE WHEN ({b}) <> 0 THEN ({a}) / ({b}) END)"


def sln(x: str) -> str:
    return f"(CASE WHEN ({x}) > 0 THEN ln({x}) END)"


def clip_lo(x: str, lo: str = "CAST(0 AS DOUBLE)") -> str:
    return f"(CASE WHEN ({x}) IS NOT NULL THEN greatest({x}, {lo}) END)"


def clip_hi(x: str, hi: str = "CAST(0 AS DOUBLE)") -> str:
    return f"(CASE WHEN ({x}) IS NOT NULL THEN least({x}, {hi}) END)"


def frame(n: int, part: str = "permno", order: str = "date") -> str:
    return f"(PARTITION BY {part} ORDER BY {order} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def full(agg: str, x: str, n: int, part: str = "permno", order: str = "date", min_periods: int | None = None) -> str:
    f = frame(n, part, order)
    need = n if min_periods is None else min_periods
    return f"(CASE WHEN count({x}) OVER {f} >= {need} THEN {agg}({x}) OVER {f} END)"


def ewm_list(x: str, span: int, part: str = "permno", order: str = "date") -> str:
    """List of the last K values (bounded frame), to feed ``ewm_from_list``."""
    return f"list({x}) OVER {frame(ewm_frame_rows(span), part, order)}"


def ewm_from_list(lst: str, span: int) -> str:
    q = repr(1.0 - ewm_alpha(span))
    num = f"list_sum(list_transform({lst}, lambda v, i: v * power({q}, len({lst}) - i)))"
    den = (f"list_sum(list_transform({lst}, lambda v, i: CASE WHEN v IS NULL THEN CAST(0 AS DOUBLE) "
           f"ELSE power({q}, len({lst}) - i) END))")
    return f"(CASE WHEN {den} > 0 THEN {num} / {den} END)"


def rnd(expr: str) -> str:
    """Same rounding as ``semantics.round6`` (nudge, then 6 decimals)."""
    return f"round(({expr}) + {ROUND_NUDGE!r}, 6)"


def r6(expr: str, alias: str) -> str:
    return f"{rnd(expr)} AS {alias}"


def select_rounded(inner: str, keys: list[str], floats: list[str], alias: str = "q") -> str:
    cols = list(keys) + [r6(c, c) for c in floats]
    return f"SELECT {', '.join(cols)} FROM ({inner}) {alias}"
