"""Column helpers shared by the operators.

Two conventions keep results identical between runs, cluster sizes and engines:

* money is summed as ``decimal`` with eight digits (exact, so independent of partial-aggregation
  order, and no cents are lost on the way), rounded once, and returned as ``double``;
* ``rnd`` rounds half up on the decimal form of a double, so float noise such as
  ``100.49999999999999`` cannot move a result by one unit.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnLike = Column | str

MONEY = "decimal(28,8)"

# Fixed value: what a NULL contributes to a surrogate key.
NULL_KEY = "_dbt_utils_surrogate_key_null_"

# Accepted raw spellings of a date and of a timestamp, tried in this order.
DATE_FORMATS = ("yyyy-MM-dd", "MM/dd/yyyy", "MMMM dd yyyy", "yyyy/MM/dd")
TIMESTAMP_FORMATS = (
    "yyyy-MM-dd HH:mm:ss",
    "MM/dd/yyyy HH:mm:ss",
    "MMMM dd yyyy HH:mm:ss",
    "yyyy/MM/dd HH:mm:ss",
    "yyyy-MM-dd",
    "MM/dd/yyyy",
    "MMMM dd yyyy",
    "yyyy/MM/dd",
)


def as_col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def title(c: ColumnLike) -> Column:
    """Title case; only blanks start a new word, so ``NEAR-PRIME`` becomes ``Near-prime``."""
    return F.initcap(F.lower(as_col(c)))


def cases(pairs: Sequence[tuple[Column, object]], default: object = None) -> Column:
    """First matching condition wins; a NULL condition does not match."""
    (cond, value), *rest = pairs
    out = F.when(cond, F.lit(value))
    for cond, value in rest:
        out = out.when(cond, F.lit(value))
    return out.otherwise(F.lit(default))


def band(c: ColumnLike, steps: Sequence[tuple[float, object]], default: object) -> Column:
    """Label by descending lower bound: ``band("score", [(750, "Excellent"), ...], "Poor")``."""
    return cases([(as_col(c) >= bound, label) for bound, label in steps], default)


def rank_map(c: ColumnLike, ranks: dict[object, int], default: int) -> Column:
    return cases([(as_col(c) == value, rank) for value, rank in ranks.items()], default)


def rnd(c: ColumnLike, digits: int) -> Column:
    """Half-up rounding on the decimal form. NaN becomes NULL; 28 integer digits are the limit."""
    return F.round(as_col(c).cast("decimal(38,10)"), digits).cast("double")


def ratio(num: ColumnLike, den: ColumnLike, scale: float = 1.0, digits: int | None = None) -> Column:
    """``num / den * scale``; NULL where the denominator is zero or NULL."""
    out = as_col(num).cast("double") / F.nullif(as_col(den).cast("double"), F.lit(0.0))
    if scale != 1.0:
        out = out * F.lit(scale)
    return out if digits is None else rnd(out, digits)


def money_total(c: ColumnLike) -> Column:
    """Exact decimal sum with eight digits, for sums that are aggregated again or divided.

    NaN is an unknown amount, ignored like NULL.
    """
    return F.sum(as_col(c).cast(MONEY))


def money_sum(c: ColumnLike, digits: int = 2) -> Column:
    """Sum of the amounts as they are, rounded once."""
    return F.round(money_total(c), digits).cast("double")


def money_avg(c: ColumnLike, digits: int = 2) -> Column:
    return ratio(money_total(c), F.count(as_col(c).cast(MONEY)), digits=digits)


def sum_if(value: ColumnLike, cond: Column) -> Column:
    return F.sum(F.when(cond, as_col(value)).otherwise(F.lit(0)))


def rate_pct(flag: ColumnLike, digits: int = 2) -> Column:
    """Mean of a 0/1 column in percent."""
    return rnd(F.avg(as_col(flag)) * 100, digits)


def ndv(c: ColumnLike, approx: bool = False) -> Column:
    return F.approx_count_distinct(as_col(c)) if approx else F.count_distinct(as_col(c))


def flag01(cond: Column) -> Column:
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def surrogate_key(*cols: ColumnLike) -> Column:
    return F.md5(
        F.concat_ws("-", *[F.coalesce(as_col(c).cast("string"), F.lit(NULL_KEY)) for c in cols])
    )


def _has_shape(c: Column, fmt: str) -> Column:
    """Whether a text looks like a format: its length and its first sign, or a letter at its start. A failed
    parse is far dearer than this look, as it raises an error inside."""
    if "MMM" in fmt:
        return (F.substring(c, 1, 1) >= "A") & ((F.instr(c, ":") > 0) == F.lit(":" in fmt))
    sign = next((k for k, x in enumerate(fmt) if not x.isalpha()), None)
    same = F.length(c) == len(fmt)
    return same if sign is None else same & (F.substring(c, sign + 1, 1) == fmt[sign])


def _first_parsed(c: Column, formats: Sequence[str], parse) -> Column:
    """The first format that parses: those of the text's shape, and for what is left all of them in order.

    Formats whose parts have no fixed width could read a text of another one's shape; with such formats
    the order alone decides.
    """
    parts = {run for f in formats for run in re.findall("[A-Za-z]+", f)}
    if not parts <= {"yyyy", "MM", "MMM", "MMMM", "dd", "HH", "mm", "ss"}:
        return F.coalesce(*[parse(f) for f in formats])
    return F.coalesce(*[F.when(_has_shape(c, f), parse(f)) for f in formats], *[parse(f) for f in formats])


def parse_date(c: ColumnLike, formats: Sequence[str] = DATE_FORMATS) -> Column:
    text = as_col(c)
    return _first_parsed(text, formats, lambda f: F.try_to_date(text, f))


def parse_ts(c: ColumnLike, formats: Sequence[str] = TIMESTAMP_FORMATS) -> Column:
    """Wall-clock timestamp, the same in every session time zone.

    Texts are read as UTC and counted from the epoch, so that no zone's clock changes take part.
    """
    text = F.concat(as_col(c), F.lit(" +0000"))
    parsed = _first_parsed(as_col(c), formats, lambda f: F.try_to_timestamp(text, F.lit(f"{f} xx")))
    micros = F.unix_micros(parsed)
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    seconds = (micros / F.lit(1_000_000).cast("decimal(20,0)")).cast("decimal(18,6)")
    return start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def epoch_seconds(df: DataFrame, column: str) -> Column:
    """Whole seconds, rounded down. Wall-clock timestamps are counted without any time zone."""
    c = F.col(column)
    if not isinstance(df.schema[column].dataType, T.TimestampNTZType):
        return F.unix_timestamp(c)
    days = F.unix_date(F.to_date(c)).cast("bigint")
    return days * 86400 + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
