"""Ways to keep one hot key from landing in one task.

Aggregations need no help: Spark combines per map task before the shuffle. Windows and
many-to-many joins do, because AQE splits neither a window partition nor a join whose side was
aggregated on the join key. Two tools cover every use in this package:

* ``earlier_total``: split a key into ordered buckets (``add_slices`` makes them from data), number rows inside each bucket, and add
  the total of the earlier buckets. No task ever sees more than one bucket of a key.
* ``salted_join``: spread the rows of hot keys over ``salts`` tasks and repeat the matching rows of
  the other side that many times. Cold keys are joined as usual.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A key is hot when it holds more than this share of the rows, so there are fewer than
# 1 / HOT_SHARE hot keys: the list of them is bounded whatever the size of the data.
HOT_SHARE = 1 / 128
# Smallest share that may be asked for: the list of hot keys is broadcast.
LEAST_SHARE = 1e-4
SALTS = 128
# Cells of more rows are cut into slices, of about half as many rows each and at most so many.
SLICE_ROWS = 200_000
SLICES = 256
# There are fewer large cells than this, and at most twice as many borders.
LARGE_CELLS = 100_000


def hot_keys(df: DataFrame, key: str, share: float = HOT_SHARE) -> DataFrame:
    """Keys holding more than ``share`` of the rows: at most ``1 / share`` rows."""
    if not LEAST_SHARE <= share <= 1:
        raise ValueError(f"share must lie between {LEAST_SHARE} and 1, not {share}")
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()
    return counts.where(F.col("_n") > total * share).select(key)


def salted_join(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    key: str,
    spread: Column,
    hot: DataFrame,
    how: str = "inner",
    salts: int = SALTS,
    bounded: bool = False,
) -> DataFrame:
    """Equi-join on ``on`` (which contains ``key``) with the ``hot_keys`` of ``big`` salted.

    ``spread`` is any well-mixed row identifier of ``big``; the salt is a hash of it, not a random
    number, so a recomputed task produces the same rows. Only a ``bounded`` list of hot keys is
    marked for broadcast; for any other, Spark goes by its measured size.
    """
    hot = hot.withColumn("_hot", F.lit(True))
    hot = F.broadcast(hot) if bounded else hot
    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1)))
    left = big.join(hot, key, "left").withColumn("_salt", F.coalesce(salt, F.lit(0))).drop("_hot")
    right = (
        small.join(hot, key, "left")
        .withColumn("_salt", F.explode(F.coalesce(copies, F.array(F.lit(0)))))
        .drop("_hot")
    )
    return left.join(right, [*on, "_salt"], how).drop("_salt")


def add_slices(
    df: DataFrame, cell: Sequence[str], column: str, to: str, rows: int = SLICE_ROWS, most: int = SLICES
) -> DataFrame:
    """Cut the rows of large cells into slices that follow the order of a unique id, never NULL.

    Borders are ids sampled, by hash, inside each cell of more than ``rows`` rows, so the cut follows
    the ids that the cell holds: counters, time-ordered ids, texts and stray ids alike. A cell
    counts as large only above 1 / ``LARGE_CELLS`` of all rows, which bounds the large cells and
    their borders whatever the size of the data; both lists are broadcast. All other rows have
    slice 0. ``cell`` columns must not be NULL.
    """
    counts = df.groupBy(*cell).agg(F.count(F.lit(1)).alias("_n"))
    least = F.greatest(counts.agg(F.sum("_n")).scalar() / LARGE_CELLS, F.lit(rows))
    wanted = F.least(F.ceil(2 * F.col("_n") / least), F.lit(most))
    large = counts.where(F.col("_n") > least).withColumn("_share", wanted / F.col("_n"))
    unit = F.pmod(F.xxhash64(F.lit(1), column), F.lit(1 << 40)) / float(1 << 40)
    sample = df.select(*cell, column).join(F.broadcast(large), list(cell)).where(unit < F.col("_share"))
    borders = sample.groupBy(*cell).agg(F.sort_array(F.collect_list(column)).alias("_borders"))
    below = F.size(F.filter("_borders", lambda border: border <= F.col(column)))
    joined = df.join(F.broadcast(borders), list(cell), "left")
    known = F.col("_borders").isNotNull() & F.col(column).isNotNull()
    return joined.withColumn(to, F.when(known, below).otherwise(F.lit(0))).drop("_borders")


def earlier_total(value: str, keys: Sequence[str], order: Sequence[str]) -> Column:
    """Sum of ``value`` over the earlier buckets of the same key (0 for the first one).

    For frames with one row per key and bucket, so that the window partition is the number of
    buckets of a key, not its number of rows.
    """
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(w), F.lit(0))
