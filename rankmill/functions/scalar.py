"""Scalar column functions.

Every function returns a ``Column`` built from Spark SQL built-ins, so it stays
inside whole-stage codegen. Spark 4 runs in ANSI mode: divisions and casts that
can fail are written with ``when`` / ``try_*``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_ts(c, fmt: str | None = None, strict: bool = True) -> Column:
    """String → timestamp (F1). ``strict`` raises on bad input like the
    reference's parser; ``strict=False`` gives null instead."""
    c = col(c)
    if strict:
        return F.to_timestamp(c, fmt) if fmt else F.to_timestamp(c)
    return F.try_to_timestamp(c, F.lit(fmt)) if fmt else F.try_to_timestamp(c)


def hour_of_day(ts) -> Column:  # F2
    return F.hour(col(ts))


def day_of_week_monday0(ts) -> Column:
    """Day of week with Monday = 0 … Sunday = 6 (F3); ``dayofweek`` would be Sunday = 1."""
    return F.weekday(col(ts))


def month_of(ts) -> Column:  # F4
    return F.month(col(ts))


def weekend_flag(ts) -> Column:
    """1 on Saturday/Sunday, 0 otherwise and when the timestamp is missing."""
    return F.coalesce(F.weekday(col(ts)) >= 5, F.lit(False)).cast("int")


def days_to_weeks(c) -> Column:
    """Days → weeks rounded half-to-even, as double."""
    return F.bround(col(c) / F.lit(7.0)).cast("double")


def equal_flag(a, b) -> Column:
    """1 when both sides are equal, 0 when they differ or one is null."""
    return F.coalesce(col(a) == col(b), F.lit(False)).cast("int")


def any_not_null_flag(*cols) -> Column:
    """1 when any of the columns has a value (F8)."""
    cond = None
    for c in cols:
        cond = col(c).isNotNull() if cond is None else (cond | col(c).isNotNull())
    return cond.cast("int")


def fill(c, value) -> Column:  # F9
    return F.coalesce(col(c), F.lit(value))


def safe_ratio(num, den) -> Column:
    """``num / den``, null when the denominator is null or zero."""
    den = col(den)
    return F.when(den.isNotNull() & (den != 0), col(num) / den)


def value_for_money(review, price, max_score: float = 100.0) -> Column:
    """review / price for positive prices; ``max_score`` for a free hotel with
    reviews; 0 otherwise and when the result is missing (F12)."""
    p, r = col(price), col(review)
    return F.coalesce(
        F.when(p > 0, r / p).when((p == 0) & (r > 0), F.lit(float(max_score))).otherwise(F.lit(0.0)),
        F.lit(0.0),
    )


def clip_upper(c, upper) -> Column:
    """Clip to ``upper``, nulls stay null."""
    c = col(c)
    return F.when(c.isNotNull(), F.least(c, F.lit(upper)))


def log1p(c) -> Column:  # F14
    return F.log1p(col(c))


# fixed values: strings that mean "no value" in run logs
NA_STRINGS = ["not available", "n/a"]


def parse_number(c) -> Column:
    """String or number → double; sentinel strings and parse failures → null
    (F15, F16)."""
    s = col(c).cast("string")
    return F.when(~F.lower(F.trim(s)).isin(*NA_STRINGS), s.try_cast("double"))


def fmt_number(c, decimals: int = 4, na: str = "N/A") -> Column:
    """Fixed-decimal text, ``na`` for null."""
    return F.when(col(c).isNotNull(), F.format_string(f"%.{decimals}f", col(c))).otherwise(F.lit(na))


def differs(a, b) -> Column:
    """Null-aware inequality (P7): a missing side counts as different."""
    return F.coalesce(col(a) != col(b), F.lit(True))


def percent_text(c, decimals: int = 2) -> Column:
    """Round and add a percent sign."""
    return F.concat(F.round(col(c), decimals).cast("string"), F.lit("%"))


def label_map(c, mapping: dict, default=None) -> Column:
    """Value → label lookup."""
    expr = None
    for k, v in mapping.items():
        expr = F.when(col(c) == F.lit(k), F.lit(v)) if expr is None else expr.when(col(c) == F.lit(k), F.lit(v))
    return expr.otherwise(F.lit(default)) if default is not None else expr


def run_timestamp() -> Column:
    """Run id text ``yyyyMMdd_HHmmss``."""
    return F.date_format(F.current_timestamp(), "yyyyMMdd_HHmmss")
