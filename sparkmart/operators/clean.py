"""Cleaning: deduplicate, normalise, fill, flag, score. Every function is lazy."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.functions import expr


def dedup(
    df: DataFrame,
    keys: str | Sequence[str],
    order_by: Sequence[str] = ("load_date",),
    ties: Sequence[str] | None = None,
) -> DataFrame:
    """Keep the newest row per key.

    Rows that agree on ``order_by`` are ordered by ``ties`` (default: every other column), so the
    survivor never depends on partitioning. Rows without a key count as one key. Catalyst limits
    each map task to one row per key before the shuffle (WindowGroupLimit), which keeps a heavily
    duplicated key cheap.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    newest = [c for c in order_by if c in df.columns]
    if ties is None:
        ties = [c for c in df.columns if c not in keys and c not in newest]
    w = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in newest], *[F.asc(c) for c in ties])
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") == 1).drop("_rank")


def remap(df: DataFrame, mapping: Mapping[str, Mapping[str, str]]) -> DataFrame:
    return df.withColumns(
        {
            c: F.coalesce(
                *[F.when(F.col(c) == old, F.lit(new)) for old, new in pairs.items()], F.col(c)
            )
            for c, pairs in mapping.items()
        }
    )


def casing(
    df: DataFrame,
    title: Sequence[str] = (),
    lower: Sequence[str] = (),
    mapping: Mapping[str, Mapping[str, str]] | None = None,
) -> DataFrame:
    out = df.withColumns(
        {**{c: expr.title(c) for c in title}, **{c: F.lower(F.col(c)) for c in lower}}
    )
    return remap(out, mapping) if mapping else out


def parse_dates(
    df: DataFrame, columns: Mapping[str, Sequence[str]] | Sequence[str], kind: str = "date"
) -> DataFrame:
    """Parse text columns written in mixed formats; unreadable text becomes NULL.

    Columns that are already dates or timestamps are left alone.
    """
    default = expr.DATE_FORMATS if kind == "date" else expr.TIMESTAMP_FORMATS
    parse = expr.parse_date if kind == "date" else expr.parse_ts
    formats = columns if isinstance(columns, Mapping) else {c: default for c in columns}
    text = {c: f for c, f in formats.items() if isinstance(df.schema[c].dataType, T.StringType)}
    return df.withColumns({c: parse(c, f) for c, f in text.items()})


def fill(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Replace NULLs (and only NULLs) by constants of the column's own type."""
    return df.withColumns(
        {
            c: F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType))
            for c, v in values.items()
        }
    )


def fill_mean(
    df: DataFrame, columns: Sequence[str], digits: int = 2, known: Mapping[str, float | None] | None = None
) -> DataFrame:
    """Replace NULLs by the rounded global mean, read as a scalar subquery in the same job, or ``known``."""
    if known is None:
        means = df.agg(F.struct(*[expr.rnd(F.avg(c), digits).alias(c) for c in columns])).scalar()
        return df.withColumns({c: F.coalesce(F.col(c), means.getField(c)) for c in columns})
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(known[c]).cast("double")) for c in columns})


def outlier_bounds(df: DataFrame, columns: Sequence[str], k: float = 3.0):
    """One scalar struct with ``avg + k * stddev`` per column: one aggregate for all columns."""
    return df.agg(F.struct(*[(F.avg(c) + k * F.stddev(c)).alias(c) for c in columns])).scalar()


def flag_outliers(
    df: DataFrame, flags: Mapping[str, str], k: float = 3.0, known: Mapping[str, float | None] | None = None
) -> DataFrame:
    """Add a boolean per column: above the upper ``k``-sigma bound. NULL is not an outlier.

    ``known`` gives the bounds; else they are computed from ``df``.
    """
    bounds = outlier_bounds(df, list(flags), k) if known is None else None
    bound = lambda c: F.lit(known[c]).cast("double") if bounds is None else bounds.getField(c)
    return df.withColumns({flag: F.coalesce(F.col(c) > bound(c), F.lit(False)) for c, flag in flags.items()})


def quality_score(df: DataFrame, penalties: Mapping[str, str]) -> DataFrame:
    """``1 - sum(penalty of raised flags)``, computed in decimal so that 1 - 0.2 is exactly 0.8."""
    score = F.lit(Decimal("1.0"))
    for flag, penalty in penalties.items():
        score = score - F.when(F.col(flag), F.lit(Decimal(penalty))).otherwise(F.lit(Decimal("0.0")))
    return df.withColumn("data_quality_score", score.cast("double"))


def drop_bots(df: DataFrame, flag: str = "is_bot") -> DataFrame:
    return df.where(~F.col(flag))
