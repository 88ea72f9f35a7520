"""Cleaned entities load by load: one load is merged into the state that the loads before it left.

The state of an entity is a ``BucketStore`` of its newest row for each key, with everything done that
looks at one row (casing, dates, constant fills). A load is deduplicated and normalised by itself; its
keys replace those of the state, and only the buckets it touches are read and written. What looks at
all rows (fill means, outlier bounds) comes from moments kept for each bucket: counts, exact sums and
sums of squares, added up on the driver, one row a bucket. So reading the entity after any load is a
scan of the live buckets with constants, without a shuffle.

The result equals cleaning the whole history again: of a key's rows the newest load wins, and loads have
different dates. A load that comes late, or comes again with other rows, is merged where it belongs,
and the loads after it are merged anew from their raw rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from decimal import ROUND_HALF_UP, Decimal, localcontext

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.operators import clean
from sparkmart.plans import silver
from sparkmart.sources.buckets import BucketStore, Entry

SQUARES = "decimal(38,8)"
SUMS = "decimal(38,8)"


def store(spark: SparkSession, folder: str, name: str, raw: DataFrame, buckets: int = 64) -> BucketStore:
    """The state of an entity; ``raw`` (of any load) gives its columns."""
    recipe = silver.RECIPES[name]
    schema = silver.normalise(raw.limit(0), recipe).schema
    return BucketStore(spark, f"{folder.rstrip('/')}/{name}", schema, [recipe.key], buckets)


def _measures(recipe: silver.Recipe) -> list[str]:
    return list(dict.fromkeys([*recipe.fill_mean, *recipe.outliers]))


def _moments(recipe: silver.Recipe) -> dict[str, Column]:
    """Aggregates of the rows that take part: all but those of bots. NaN counts as no value."""
    part = ~F.col("is_bot") if recipe.bots else F.lit(True)
    out = {"rows": F.count_if(part)}
    for c in _measures(recipe):
        value = F.when(part, F.nanvl(F.col(c).cast("double"), F.lit(None)))
        out[f"n_{c}"] = F.count(value)
        out[f"s_{c}"] = F.sum(value.cast(SUMS))
        out[f"q_{c}"] = F.sum((value * value).cast(SQUARES))
    return out


def merge(store: BucketStore, raw: DataFrame, name: str, load_date: str) -> dict[int, Entry]:
    """Merge the raw rows of one load into the state as it was before that date."""
    recipe = silver.RECIPES[name]
    new = silver.normalise(clean.dedup(raw, recipe.key), recipe)
    rows, touched = store.incoming(new, load_date)
    before = store.entries(before=load_date)
    old = store.read({b: before[b] for b in touched if b in before})
    # Rows without a key count as one key.
    again = rows.select(F.col(recipe.key).alias("_key"))
    kept = old.join(again, old[recipe.key].eqNullSafe(again["_key"]), "left_anti")
    return store.commit(load_date, kept.unionByName(rows.drop("_bucket")), touched, before, _moments(recipe))


def advance(store: BucketStore, raw_of: Callable[[str], DataFrame], name: str, load_date: str) -> list[str]:
    """Merge a load and then, again, all that were merged for later dates; the dates in order.

    ``raw_of`` gives the raw rows of a date, as the bronze tables keep them.
    """
    dates = [load_date, *(v for v in store.versions() if v > load_date)]
    for date in dates:
        merge(store, raw_of(date), name, date)
    return dates


def _total(entries: Mapping[int, Entry], key: str) -> Decimal:
    return sum((Decimal(e.stats[key]) for e in entries.values() if key in e.stats), Decimal(0))


def statistics(entries: Mapping[int, Entry], recipe: silver.Recipe, k: float = 3.0) -> tuple[dict[str, float | None], dict[str, float | None]]:
    """Fill means and outlier bounds from the moments of all buckets. NULLs that a mean fills count
    as that mean in the bounds."""
    means: dict[str, float | None] = {}
    bounds: dict[str, float | None] = {}
    with localcontext() as context:
        context.prec = 60
        rows = _total(entries, "rows")
        for c in _measures(recipe):
            n, s, q = (_total(entries, f"{p}_{c}") for p in "nsq")
            if c in recipe.fill_mean:
                mean = _half_up(s / n) if n else None
                means[c] = mean
                if mean is not None:
                    filled = rows - n
                    n, s, q = rows, s + filled * Decimal(repr(mean)), q + filled * Decimal(repr(mean)) ** 2
            if c in recipe.outliers:
                spread = max(Decimal(0), (q - s * s / n) / (n - 1)).sqrt() if n > 1 else None
                bounds[c] = None if spread is None else float(s / n) + k * float(spread)
    return means, bounds


def _half_up(value: Decimal, digits: int = 2) -> float:
    wide = Decimal(repr(float(value))).quantize(Decimal(1).scaleb(-10), ROUND_HALF_UP)
    return float(wide.quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP))


def cleaned(store: BucketStore, name: str, load_date: str, k: float = 3.0) -> DataFrame:
    """The entity after the loads up to a date, flagged and scored; columns as ``silver.entity`` gives."""
    recipe = silver.RECIPES[name]
    entries = store.entries(upto=load_date)
    means, bounds = statistics(entries, recipe, k)
    return silver.judged(store.read(entries), recipe, load_date, k, means, bounds)


def entity(
    spark: SparkSession, folder: str, name: str, raw: DataFrame, dates: Sequence[str], buckets: int = 64
) -> DataFrame:
    """All loads of a raw table that holds several, merged one after the other."""
    state = store(spark, folder, name, raw, buckets)
    for date in dates:
        merge(state, raw.where(F.col("load_date") == date), name, date)
    return cleaned(state, name, dates[-1])
