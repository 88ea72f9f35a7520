"""Five attribution models, their comparison, pivot and budget signals.

Shares are rounded to six digits unless ``digits=None``: a share of a customer with millions of
touches would round to 0.

Input is one row per marketing touch: ``touch_id, customer_id, channel, campaign,
touchpoint_date, touch_cost, is_converted``.

A customer's touches are never gathered in one task. They are first reduced to cells (customer and
day, for positions also a slice of large days); everything a model needs to know about a customer is a window
over these cells, and the touch-level models join it back on the cell key, which spreads a hot
customer over its days. The comparison works on cells alone and joins nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.functions import expr
from sparkmart.operators import skew

# Model names in report order, and their columns in the pivot.
MODELS = ["last_click", "first_click", "linear", "time_decay", "position_based"]

# Models that leave out touches without a customer; the click models treat them as one customer.
KNOWN_CUSTOMER_ONLY = ["linear", "time_decay", "position_based"]

TOUCH_COLUMNS = [
    "touch_id", "customer_id", "channel", "campaign", "touchpoint_date", "touch_cost",
    "is_converted",
]

_DAY = "touchpoint_date"


def _with_customer_totals(cells: DataFrame, customer: str, half_life_days: float) -> DataFrame:
    """Add each customer's totals, first conversion, end touches and decay weight to its cells.

    Cells carry ``_n`` touches, ``_conversions``, ``_first`` and ``_last`` (structs that start with
    day and touch id). All windows share one shuffle on the customer.
    """
    by_customer = Window.partitionBy(customer)
    converted_day = F.when(F.col("_conversions") > 0, F.col(_DAY))
    # Decimal: the sum does not depend on the order in which cells arrive.
    weight = (F.col("_n") * F.col("_weight")).cast("decimal(38,18)")
    return (
        cells.withColumns(
            {
                "total_touches": F.sum("_n").over(by_customer),
                "_total_conversions": F.sum("_conversions").over(by_customer),
                "_conversion_day": F.min(converted_day).over(by_customer),
                "_first_touch": F.min("_first").over(by_customer),
                "_last_touch": F.max("_last").over(by_customer),
            }
        )
        .withColumn("days_before_conversion", F.datediff("_conversion_day", _DAY))
        .withColumn("_weight", _decay_weight(half_life_days))
        .withColumn("_total_weight", F.sum(weight).over(by_customer).cast("double"))
    )


def _decay_weight(half_life_days: float) -> Column:
    """2^(-days / half life) up to the first conversion, 0 after it or without one."""
    days = F.col("days_before_conversion")
    return F.when(days >= 0, F.pow(F.lit(2.0), -days / F.lit(float(half_life_days)))).otherwise(
        F.lit(0.0)
    )


def _rounded(share: Column, digits: int | None) -> Column:
    return share if digits is None else expr.rnd(share, digits)


def _linear_credit(digits: int | None) -> Column:
    share = _rounded(F.lit(1.0) / F.nullif(F.col("total_touches"), F.lit(0)), digits)
    return F.when(F.col("_total_conversions") > 0, share).otherwise(F.lit(0.0))


def _decay_credit(digits: int | None) -> Column:
    share = _rounded(F.col("_weight") / F.nullif(F.col("_total_weight"), F.lit(0.0)), digits)
    return F.when(F.col("_total_weight") > 0, share).otherwise(F.lit(0.0))


def _middle_credit(first: float, last: float, digits: int | None) -> Column:
    """Credit of one touch that is neither first nor last."""
    rest = F.lit(round(1.0 - first - last, 10))
    return _rounded(rest / F.nullif(F.col("total_touches") - 2, F.lit(0)), digits)


# Cell key of a touch. It is never NULL, so one partitioning serves the aggregate, the join and
# the window inside a cell; an unknown day sorts first.
_CELL = ["_customer", "_day", "_range"]


def _keyed(touches: DataFrame, ranked: bool) -> DataFrame:
    customer = F.concat(F.lit("c"), F.col("customer_id").cast("string"))
    rows = touches.select(*TOUCH_COLUMNS).withColumns(
        {
            "_customer": F.coalesce(customer, F.lit("")),
            "_day": F.coalesce(F.col(_DAY), F.lit("0001-01-01").cast("date")),
        }
    )
    if not ranked:
        return rows.withColumn("_range", F.lit(0))
    return skew.add_slices(rows, ["_customer", "_day"], "touch_id", "_range")


def _touch_cells(rows: DataFrame, half_life_days: float) -> DataFrame:
    cells = (
        rows.groupBy(*_CELL, _DAY)
        .agg(
            F.count("touch_id").alias("_n"),
            F.sum("is_converted").alias("_conversions"),
            F.min("touch_id").alias("_min_id"),
            F.max("touch_id").alias("_max_id"),
        )
        .withColumns(
            {
                "_first": F.struct("_day", F.col("_min_id").alias("id")),
                "_last": F.struct("_day", F.col("_max_id").alias("id")),
            }
        )
    )
    return _with_customer_totals(cells, "_customer", half_life_days).select(
        *_CELL,
        "total_touches",
        "_total_conversions",
        "days_before_conversion",
        F.col("_first_touch.id").alias("_first_id"),
        F.col("_last_touch.id").alias("_last_id"),
        "_weight",
        "_total_weight",
        skew.earlier_total("_n", ["_customer"], ["_day", "_range"]).alias("_before"),
    )


def _touches_with_totals(
    touches: DataFrame, half_life_days: float = 7.0, ranked: bool = False
) -> DataFrame:
    """Every touch with its customer's totals, joined on the cell it belongs to."""
    rows = _keyed(touches, ranked)
    return rows.join(_touch_cells(rows, half_life_days), _CELL)


def _is_first() -> Column:
    return F.col("touch_id") == F.col("_first_id")


def _is_last() -> Column:
    return F.col("touch_id") == F.col("_last_id")


def _position_credit(first: float, last: float, digits: int | None) -> Column:
    n = F.col("total_touches")
    return (
        F.when(F.col("_total_conversions") == 0, F.lit(0.0))
        .when(n == 1, F.lit(1.0))
        .when(n == 2, F.lit(0.5))
        .when(_is_first(), F.lit(first))
        .when(_is_last(), F.lit(last))
        .otherwise(_middle_credit(first, last, digits))
    )


def _credit(
    model: str, first: float = 0.4, last: float = 0.4, digits: int | None = 6
) -> Column:
    """Credit of a touch under a model, from the columns of ``_touches_with_totals``."""
    credit = {
        "first_click": lambda: expr.flag01(_is_first() & (F.col("_total_conversions") > 0)),
        "last_click": lambda: expr.flag01(_is_last() & (F.col("is_converted") == 1)),
        "linear": lambda: _linear_credit(digits),
        "time_decay": lambda: _decay_credit(digits),
        "position_based": lambda: _position_credit(first, last, digits),
    }[model]()
    return credit.cast("double")


def _known(touches: DataFrame) -> DataFrame:
    return touches.where(F.col("customer_id").isNotNull())


def _credited(
    rows: DataFrame, model: str, extra: Sequence[str | Column] = (), **options
) -> DataFrame:
    credit = _credit(model, **options)
    return rows.select(
        *TOUCH_COLUMNS,
        *extra,
        credit.alias("attribution_credit"),
        credit.alias("attributed_conversions"),
        F.lit(model).alias("attribution_model"),
    )


def first_click(touches: DataFrame) -> DataFrame:
    """The earliest touch of a customer with any conversion gets 1."""
    return _credited(_touches_with_totals(touches), "first_click")


def last_click(touches: DataFrame) -> DataFrame:
    """The latest touch of a customer gets 1, only if that touch itself converted."""
    return _credited(_touches_with_totals(touches), "last_click")


def linear(touches: DataFrame, digits: int | None = 6) -> DataFrame:
    """Every touch of a converting customer gets the same share."""
    return _credited(_touches_with_totals(_known(touches)), "linear", digits=digits)


def time_decay(
    touches: DataFrame, half_life_days: float = 7.0, digits: int | None = 6
) -> DataFrame:
    """Shares halve every ``half_life_days`` before the first conversion."""
    rows = _touches_with_totals(_known(touches), half_life_days)
    return _credited(rows, "time_decay", ["days_before_conversion"], digits=digits)


def _positions(rows: DataFrame) -> DataFrame:
    in_cell = Window.partitionBy(*_CELL).orderBy("touch_id")
    return rows.withColumn("touch_position", F.col("_before") + F.row_number().over(in_cell))


def _position_label() -> Column:
    label = expr.cases([(_is_first(), "first"), (_is_last(), "last")], "middle")
    return label.alias("touch_position_label")


def position_based(
    touches: DataFrame, first: float = 0.4, last: float = 0.4, digits: int | None = 6
) -> DataFrame:
    """Fixed shares for the first and last touch, the rest split over the touches between."""
    rows = _positions(_touches_with_totals(_known(touches), ranked=True))
    extra = ["total_touches", "touch_position", _position_label()]
    return _credited(rows, "position_based", extra, first=first, last=last, digits=digits)


# Columns that a model's own table has beside those of all models.
MODEL_COLUMNS = {
    "time_decay": ["days_before_conversion"],
    "position_based": ["total_touches", "touch_position", "touch_position_label"],
}


def credits(touches: DataFrame, digits: int | None = 6) -> DataFrame:
    """Every touch with its credit under each model (NULL where a model leaves it out) and the
    columns of the models' own tables: five tables from one pass over the touches."""
    rows = _positions(_touches_with_totals(touches, ranked=True))
    known = F.col("customer_id").isNotNull()
    amounts = []
    for model in MODELS:
        credit = _credit(model, digits=digits)
        amounts.append(F.when(known, credit).alias(model) if model in KNOWN_CUSTOMER_ONLY else credit.alias(model))
    own = ["days_before_conversion", "total_touches", "touch_position", _position_label()]
    return rows.select(*TOUCH_COLUMNS, *own, *amounts)


def of_model(credited: DataFrame, model: str) -> DataFrame:
    """The table of one model, a projection of ``credits``."""
    credit = F.col(model)
    return credited.where(credit.isNotNull()).select(
        *TOUCH_COLUMNS,
        *MODEL_COLUMNS.get(model, []),
        credit.alias("attribution_credit"),
        credit.alias("attributed_conversions"),
        F.lit(model).alias("attribution_model"),
    )


STACK_COLUMNS = [
    "channel", "campaign", "touch_cost", "attribution_credit", "attributed_conversions",
    "attribution_model",
]


def stack(models: Sequence[DataFrame]) -> DataFrame:
    """Model outputs on top of each other, reduced to the columns they share."""
    out, *rest = [m.select(*STACK_COLUMNS) for m in models]
    for m in rest:
        out = out.unionByName(m)
    return out


def all_models(touches: DataFrame, models: Sequence[str] = tuple(MODELS)) -> DataFrame:
    """The same rows as ``stack`` of the models, from one pass over the touches."""
    known = F.col("customer_id").isNotNull()
    entries = []
    for model in models:
        applies = known if model in KNOWN_CUSTOMER_ONLY else F.lit(True)
        entry = F.struct(
            F.lit(model).alias("attribution_model"), _credit(model).alias("attribution_credit")
        )
        entries.append(F.when(applies, entry))
    rows = _touches_with_totals(touches)
    return (
        rows.select("channel", "campaign", "touch_cost", F.inline(F.array(*entries)))
        .where(F.col("attribution_model").isNotNull())
        .withColumn("attributed_conversions", F.col("attribution_credit"))
        .select(*STACK_COLUMNS)
    )


def channel_credits(
    touches: DataFrame,
    half_life_days: float = 7.0,
    first: float = 0.4,
    last: float = 0.4,
    digits: int | None = 6,
) -> DataFrame:
    """Touches, spend and credit per model and channel, without a row per touch and model.

    All touches of a customer on one day in one channel share the same linear, decay and middle
    credit, so a cell contributes ``n`` times that credit; only the end touches stand out.
    """
    day = F.col(_DAY).alias("day")
    cells = (
        touches.groupBy("customer_id", _DAY, "channel")
        .agg(
            F.count("touch_id").alias("_n"),
            F.count(F.lit(1)).alias("_rows"),
            expr.money_total("touch_cost").alias("_spend"),
            F.sum("is_converted").alias("_conversions"),
            F.min("touch_id").alias("_min_id"),
            F.max("touch_id").alias("_max_id"),
            F.max_by("is_converted", "touch_id").alias("_max_converted"),
        )
        .withColumns(
            {
                "_first": F.struct(day, F.col("_min_id").alias("id")),
                "_last": F.struct(
                    day, F.col("_max_id").alias("id"), F.col("_max_converted").alias("converted")
                ),
            }
        )
    )
    rows = _with_customer_totals(cells, "customer_id", half_life_days)
    has_first = F.col("_first").eqNullSafe(F.col("_first_touch"))
    has_last = F.col("_last").eqNullSafe(F.col("_last_touch"))
    n, total, converting = F.col("_n"), F.col("total_touches"), F.col("_total_conversions") > 0
    ends = expr.flag01(has_first) * F.lit(first) + expr.flag01(has_last) * F.lit(last)
    between = n - expr.flag01(has_first) - expr.flag01(has_last)
    position = (
        F.when(~converting, F.lit(0.0))
        .when(total <= 2, n / total)
        .otherwise(ends + between * _middle_credit(first, last, digits))
    )
    credits = {
        "last_click": expr.flag01(has_last & (F.col("_last_touch.converted") == 1)),
        "first_click": expr.flag01(has_first & converting),
        "linear": n * _linear_credit(digits),
        "time_decay": n * _decay_credit(digits),
        "position_based": position,
    }
    known = F.col("customer_id").isNotNull()
    aggregates = []
    for model in MODELS:
        counted = known if model in KNOWN_CUSTOMER_ONLY else F.lit(True)
        credit = credits[model].cast("decimal(28,6)" if digits == 6 else "decimal(38,18)")
        aggregates.append(
            F.struct(
                F.lit(model).alias("attribution_model"),
                F.sum(F.when(counted, F.col("_rows"))).alias("total_touches"),
                F.sum(F.when(counted, F.col("_spend"))).cast("double").alias("total_spend"),
                F.sum(F.when(counted, credit)).cast("double").alias("credit"),
            ).alias(model)
        )
    summary = rows.groupBy("channel").agg(*aggregates)
    return summary.select("channel", F.inline(F.array(*MODELS))).where(
        F.col("total_touches").isNotNull()
    )


def compare(touches: DataFrame, models: Sequence[str] = tuple(MODELS), **options) -> DataFrame:
    """Per model and channel: credit, shares, effective CAC and the reallocation signal.

    Shares divide figures that are already rounded, by the total over the channels of a model.
    """
    by_model = Window.partitionBy("attribution_model")
    credit, spend = F.col("attributed_conversions"), F.col("total_spend")
    credit_share = expr.ratio(credit, F.sum(credit).over(by_model), 100.0)
    spend_share = expr.ratio(spend, F.sum(spend).over(by_model), 100.0)
    return (
        channel_credits(touches, **options)
        .where(F.col("attribution_model").isin(*models))
        .select(
            "attribution_model",
            "channel",
            "total_touches",
            expr.rnd("total_spend", 2).alias("total_spend"),
            expr.rnd("credit", 2).alias("attributed_conversions"),
        )
        .withColumns({"_credit_share": credit_share, "_spend_share": spend_share})
        .select(
            "attribution_model",
            "channel",
            "total_touches",
            "total_spend",
            "attributed_conversions",
            expr.rnd("_credit_share", 2).alias("conversion_share_pct"),
            expr.ratio(spend, credit, digits=2).alias("effective_cac"),
            expr.rnd("_spend_share", 2).alias("spend_share_pct"),
            expr.rnd(F.col("_credit_share") - F.col("_spend_share"), 2).alias(
                "reallocation_signal"
            ),
        )
    )


def pivot_shares(comparison: DataFrame) -> DataFrame:
    """Channel by model conversion shares, and their spread."""
    share = F.col("conversion_share_pct")
    return comparison.groupBy("channel").agg(
        *[
            F.max(F.when(F.col("attribution_model") == m, share)).alias(f"{m}_pct") for m in MODELS
        ],
        expr.rnd(F.max(share) - F.min(share), 1).alias("variance_across_models"),
    )


def recommend(comparison: DataFrame, model: str = "linear", limit: float = 5.0) -> DataFrame:
    signal = F.col("reallocation_signal")
    advice = expr.cases(
        [(signal >= limit, "Increase budget"), (signal <= -limit, "Reduce budget")],
        "Maintain budget",
    )
    return comparison.where(F.col("attribution_model") == model).select(
        "channel",
        "spend_share_pct",
        "conversion_share_pct",
        "reallocation_signal",
        advice.alias("recommendation"),
    )
