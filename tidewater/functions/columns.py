"""Column-expression builders (scalar functions F1-F7, projections P6-P10, P17-P18).

All of these return ``Column`` objects built from ``pyspark.sql.functions`` so
they stay JVM-side inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "col_or", "parse_event_time", "event_flag", "default_zero", "array_len_or_zero",
    "user_segment", "age_group", "session_key", "deterministic_id", "money",
    "money_sum", "money_avg", "safe_rate", "payment_draw", "epoch_time",
    "json_key_long", "pick_by_mod",
]

# Fixed values that must equal the reference: tier → segment and age bands.
PREMIUM_TIERS = ["gold", "platinum"]
MEDIUM_TIER = "silver"
AGE_BANDS = [(25, "18-24"), (35, "25-34"), (45, "35-44"), (55, "45-54")]
AGE_TOP_BAND = "55+"


def col_or(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_event_time(c, ntz: bool = False) -> Column:
    """ISO-8601 text → timestamp; unparseable text gives NULL (F1)."""
    c = col_or(c)
    return c.try_cast("timestamp_ntz") if ntz else F.try_to_timestamp(c)


def epoch_time(c, ntz: bool = False) -> Column:
    """Seconds since the epoch (whole or fractional) → timestamp (F1)."""
    t = F.timestamp_micros(F.round(col_or(c).cast("decimal(28,6)") * 1_000_000).cast("bigint"))
    return t.cast("timestamp_ntz") if ntz else t


def event_flag(c, value) -> Column:
    """1 when the column equals ``value`` (or is in a list of values), else 0."""
    c = col_or(c)
    cond = c.isin(list(value)) if isinstance(value, (list, tuple, set)) else (c == value)
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def default_zero(c) -> Column:
    """Missing amount → 0.0."""
    return F.coalesce(col_or(c), F.lit(0.0))


def array_len_or_zero(c) -> Column:
    """Array length, null array → 0."""
    c = col_or(c)
    return F.when(c.isNotNull(), F.size(c)).otherwise(F.lit(0))


def user_segment(tier) -> Column:
    """gold/platinum → premium, silver → medium, anything else → basic."""
    tier = col_or(tier)
    return (F.when(tier.isin(PREMIUM_TIERS), "premium")
            .when(tier == MEDIUM_TIER, "medium")
            .otherwise("basic"))


def age_group(age) -> Column:
    """Age bands; null age falls through to the top band, like the reference (P10)."""
    age = col_or(age)
    expr = None
    for bound, label in AGE_BANDS:
        expr = F.when(age < bound, label) if expr is None else expr.when(age < bound, label)
    return expr.otherwise(AGE_TOP_BAND)


def session_key(user, ts) -> Column:
    """``session_<user>_<yyyymmdd>``."""
    return F.concat(F.lit("session_"), col_or(user).cast("string"), F.lit("_"),
                    F.date_format(col_or(ts), "yyyyMMdd"))


def deterministic_id(prefix: str, key, n: int = 8, salt: str = "") -> Column:
    """Reproducible id ``<prefix><first n hex of sha256(key||salt)>`` upper-cased."""
    k = F.concat(col_or(key).cast("string"), F.lit(salt))
    return F.concat(F.lit(prefix), F.upper(F.substring(F.sha2(k, 256), 1, n)))


def money(c) -> Column:
    """Money as exact decimal(15,2) (the warehouse contract's type)."""
    return col_or(c).cast("decimal(15,2)")


def money_sum(c) -> Column:
    """Exact, order-independent sum of money, returned as double."""
    return F.sum(money(c)).cast("double")


def money_avg(c) -> Column:
    """Average of money = exact sum / count of non-null values (null when none)."""
    c = col_or(c)
    return F.try_divide(F.sum(money(c)).cast("double"), F.count(c))


def safe_rate(num, den) -> Column:
    """num / den, NULL when den is 0 or NULL (A13; ANSI `/` would throw)."""
    return F.try_divide(col_or(num).cast("double"), col_or(den))


def payment_draw(key, rate: float) -> Column:
    """Deterministic stand-in for ``random() < rate`` keyed by the order id.

    Bucket = first 8 hex digits of md5(key) read as an integer, mod 100.
    """
    bucket = F.pmod(F.conv(F.substring(F.md5(col_or(key).cast("string")), 1, 8), 16, 10)
                    .cast("bigint"), F.lit(100))
    return bucket < F.lit(int(round(rate * 100)))


def json_key_long(c, key: str) -> Column:
    """Integer field of a JSON text column; bad JSON or bad value gives NULL."""
    return F.get_json_object(col_or(c), f"$.{key}").try_cast("bigint")


def pick_by_mod(key, values) -> Column:
    """values[key mod len(values)], a deterministic categorical assignment."""
    n = len(values)
    idx = (F.pmod(col_or(key), F.lit(n)) + 1).cast("int")
    return F.element_at(F.array(*[F.lit(v) for v in values]), idx)
