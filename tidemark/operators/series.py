"""Per-security time series split into bounded chunks.

Every rolling, lag and EWM column of the pod looks back a bounded number of rows
(at most ~650: MACD_signal is a 165-row EWM of a 479-row EWM). So a security's
series can be cut into chunks of ``chunk_rows`` consecutive rows, each preceded by
a copy of the last ``halo_rows`` rows of the chunk before it. Windows then run over
``(key, _chunk)``: none ever holds more than ``chunk_rows + halo_rows`` rows of
one security, and the halo copies are dropped afterwards. The rows are dealt by
``key`` alone, so that positions, chunks and what is carried over a whole series
share one exchange; a series has one row a day, so the calendar bounds what one
key brings to a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_CHUNK_ROWS = 2048
POD_HALO_ROWS = 650


def with_series_index(df: DataFrame, key: str, order: list[Column], date_col: str = "date",
                      first_of: tuple[str, ...] = ()) -> DataFrame:
    """Add ``_i``: 0-based position of each row in its key's series, in ``order``; ``_rows``, the length of the series;
    and for ``first_of`` columns ``_first_<c>``, the series' first value that is not NULL. Rows without a key or a date are
    dropped.

    The rows are dealt by ``key``, once: every later window over ``key`` or ``(key, _chunk)`` finds them so and moves none.
    """
    w = Window.partitionBy(key).orderBy(*order)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return df.filter(F.col(key).isNotNull() & F.col(date_col).isNotNull()).withColumns({
        "_i": F.row_number().over(w) - 1, "_rows": F.count(F.lit(1)).over(whole),
        **{f"_first_{c}": F.first(c, ignorenulls=True).over(whole) for c in first_of}})


def split_series(df: DataFrame, key: str, chunk_rows: int = DEFAULT_CHUNK_ROWS,
                 halo_rows: int = POD_HALO_ROWS) -> DataFrame:
    """Assign ``_chunk`` and ``_halo`` to an indexed series (needs ``_i`` and ``_rows``).

    A row lands in chunk ``_i div chunk_rows``; rows in the last ``halo_rows`` of a
    chunk are also copied into the next chunk with ``_halo = true``. ``_p`` is the
    row's position inside its chunk partition (halo rows first), 0-based; ``_last_chunk``
    is the chunk of the series' last row (``_rows`` is dropped for it).
    """
    if halo_rows > chunk_rows:
        raise ValueError("halo_rows must not exceed chunk_rows")
    own = F.floor(F.col("_i") / chunk_rows).cast("long")
    pos_in_chunk = F.col("_i") - own * chunk_rows
    targets = F.when(pos_in_chunk >= chunk_rows - halo_rows, F.array(own, own + 1)).otherwise(F.array(own))
    out = df.withColumn("_chunk", F.explode(targets))
    out = out.withColumn("_halo", F.col("_chunk") != own)
    # halo rows sit before the chunk's own rows; their position counts back from the boundary
    start = F.col("_chunk") * chunk_rows - halo_rows
    out = out.withColumn("_last_chunk", F.floor((F.col("_rows") - 1) / chunk_rows).cast("long")).drop("_rows")
    return out.withColumn("_p", F.col("_i") - F.greatest(start, F.lit(0)))


def chunk_window(key: str):
    return Window.partitionBy(key, "_chunk").orderBy("_i")


def drop_halo(df: DataFrame) -> DataFrame:
    return df.filter(~F.col("_halo")).drop("_halo", "_chunk", "_p", "_last_chunk")


def earlier_chunks(df: DataFrame) -> DataFrame:
    """The chunks of a split frame that a later one follows."""
    return df.filter(F.col("_chunk") < F.col("_last_chunk"))


def total_before(key: str, value: str) -> Column:
    """The sum of ``value`` over the own rows of all chunks before the row's chunk (NULL in a first chunk), for rows dealt
    by ``key``."""
    upto = Window.partitionBy(key).orderBy("_chunk").rangeBetween(Window.unboundedPreceding, -1)
    return F.sum(F.when(~F.col("_halo"), F.col(value))).over(upto)


def series_running_sum(df: DataFrame, key: str, value: str, out: str, before: str) -> DataFrame:
    """Cumulative sum over the whole series on a split frame (M11: NULL stays NULL).

    In-chunk running sum of own rows plus ``before``, the total of all earlier chunks (``total_before``;
    NULL in a first chunk).
    """
    v = F.col(value)
    w = chunk_window(key).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inner = F.sum(F.when(~F.col("_halo"), v)).over(w)
    total = F.coalesce(F.col(before), F.lit(0)) + F.coalesce(inner, F.lit(0))
    return df.withColumn(out, F.when(v.isNotNull() & ~F.col("_halo"), total))
