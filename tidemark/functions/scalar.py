"""Column expressions: safe arithmetic, symbols, units, money, calendar and name rules."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import schemas


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(a: str | Column, b: str | Column) -> Column:
    """``a / b`` as a double; null on a zero divisor."""
    return F.try_divide(col(a).cast("double"), col(b).cast("double"))


def clip(c: str | Column, low, high) -> Column:
    """Bound a value, keeping null null (``greatest`` and ``least`` alone would skip it)."""
    value = col(c)
    bound = lambda b: b if isinstance(b, Column) else F.lit(b)
    return F.when(value.isNotNull(), F.least(F.greatest(value, bound(low)), bound(high)))


def pct_change(now: str | Column, before: str | Column) -> Column:
    return safe_div(now, before) - 1


def log_return(now: str | Column, before: str | Column) -> Column:
    """Natural log of the ratio; null unless the ratio is positive."""
    return F.ln(safe_div(now, before))


def lookup(c: str | Column, table: Mapping[str, object]) -> Column:
    """Value of a short literal map, or null."""
    pairs = [F.lit(x) for item in table.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), col(c))


# --- symbols -------------------------------------------------------------------------------------


def clean_symbol(c: str | Column, kind: str = "stock", anchored: bool = True) -> Column:
    """Upper-case, drop exchange suffixes, map to the canonical symbol, apply the asset's format.

    ``anchored=False`` removes a suffix wherever it occurs, one suffix after the other.
    """
    symbol = F.upper(F.trim(col(c)))
    if anchored:
        endings = "|".join(re.escape(x) for x in schemas.EXCHANGE_SUFFIXES)
        symbol = F.regexp_replace(symbol, f"({endings})$", "")
    else:
        for suffix in schemas.EXCHANGE_SUFFIXES:
            symbol = F.replace(symbol, F.lit(suffix), F.lit(""))
    symbol = F.coalesce(lookup(symbol, schemas.SYMBOL_MAP), symbol)
    if kind == "crypto":
        bare = F.translate(symbol, "-/", "")
        short = (~bare.endswith("USDT")) & (F.length(bare) <= 6)
        return F.when(short, F.concat(bare, F.lit("USDT"))).otherwise(bare)
    if kind == "forex":
        return F.translate(symbol, "/", "")
    return symbol


def pair_label(base: str | Column, quote: str | Column) -> Column:
    return F.concat(col(base), F.lit("/"), col(quote))


def pair_symbol(base: str | Column, quote: str | Column, prefix: str = "") -> Column:
    return F.concat(F.lit(prefix), F.upper(col(base)), F.upper(col(quote)))


def pair_ticker(pair: str | Column) -> Column:
    """``EUR/USD`` or ``EURUSD`` -> ``C:EURUSD``."""
    return F.concat(F.lit("C:"), F.translate(F.upper(col(pair)), "/", ""))


def with_quote(symbol: str | Column, quote: str) -> Column:
    """Replace the quote currency of ``X/USD``; add it to a bare symbol."""
    s = col(symbol)
    return F.when(s.contains("/USD"), F.replace(s, F.lit("/USD"), F.lit(f"/{quote}"))).otherwise(
        F.concat(s, F.lit(f"/{quote}"))
    )


def base_currency(symbol: str | Column) -> Column:
    return F.substring(col(symbol), 1, 3)


def quote_currency(symbol: str | Column) -> Column:
    s = col(symbol)
    return F.substring(s, F.lit(4), F.length(s))


def fund_category(name: str | Column) -> Column:
    lowered = F.lower(col(name))
    result = F
    for category, words in schemas.FUND_RULES:
        pattern = "|".join(re.escape(w) for w in words)
        result = result.when(lowered.rlike(pattern), F.lit(category))
    return result.otherwise(F.lit("other"))


def valid_symbol(c: str | Column) -> Column:
    return F.length(F.trim(col(c))) > 0


# --- units and money -----------------------------------------------------------------------------


def clean_unit(c: str | Column) -> Column:
    unit = F.lower(F.trim(col(c)))
    return F.coalesce(lookup(unit, schemas.UNIT_MAP), unit)


def to_usd(value: str | Column, currency: str | Column) -> Column:
    """Value in US dollars; an unknown or missing currency leaves it as it is."""
    rate = F.coalesce(lookup(F.upper(col(currency)), schemas.CURRENCY_RATES), F.lit(1.0))
    return col(value) / rate


def to_celsius(value: str | Column, units: str | Column) -> Column:
    v = col(value)
    return F.when(col(units) == "imperial", (v - 32) * 5 / 9).otherwise(v)


def to_metres_per_second(value: str | Column, units: str | Column) -> Column:
    v = col(value)
    return F.when(col(units) == "imperial", v * 0.44704).otherwise(v)


def parse_number(c: str | Column) -> Column:
    """``"1,234.5"`` -> 1234.5; null when it is not a number."""
    return F.regexp_replace(F.trim(col(c)), ",", "").try_cast("double")


def integral(c: str | Column) -> Column:
    """A whole number as bigint; null for anything else."""
    number = col(c).try_cast("double")
    return F.when(number == F.floor(number), number.try_cast("bigint"))


def spread_pips(bid: str | Column, ask: str | Column) -> Column:
    return (col(ask) - col(bid)) * 10000


def volatility_level(high: str | Column, low: str | Column) -> Column:
    move = safe_div(col(high) - col(low), low)
    return (
        F.when(move > 0.05, "Very High").when(move > 0.03, "High").when(move > 0.02, "Medium").otherwise("Low")
    )


def as_text(c: str | Column, digits: int = 1) -> Column:
    """Share as percent text, as used in reports."""
    return F.concat(F.format_number(col(c) * 100, digits), F.lit("%"))


# --- time ----------------------------------------------------------------------------------------


def parse_time(c: str | Column) -> Column:
    """UTC timestamp from text; digits that are no date are epoch milliseconds."""
    text = col(c).cast("string")
    millis = F.when(text.rlike(r"^-?\d{9,}$"), F.timestamp_millis(text.try_cast("bigint")))
    return F.coalesce(millis, F.try_to_timestamp(text))


def epoch_seconds(c: str | Column) -> Column:
    return F.timestamp_seconds(col(c).try_cast("bigint"))


def epoch_millis(c: str | Column) -> Column:
    return F.timestamp_millis(col(c).try_cast("bigint"))


def time_parts(c: str | Column) -> dict[str, Column]:
    """Date parts with Monday as day 0 and ISO weeks."""
    t = col(c)
    return {
        "date": F.to_date(t),
        "year": F.year(t),
        "month": F.month(t),
        "day": F.dayofmonth(t),
        "hour": F.hour(t),
        "minute": F.minute(t),
        "day_of_week": F.weekday(t),
        "day_of_year": F.dayofyear(t),
        "week_of_year": F.weekofyear(t),
    }


def calendar_features(c: str | Column) -> dict[str, Column]:
    d = F.to_date(col(c))
    month_end = d == F.last_day(d)
    return {
        "day_of_week": F.weekday(d),
        "day_of_month": F.dayofmonth(d),
        "month": F.month(d),
        "quarter": F.quarter(d),
        "year": F.year(d),
        "is_month_end": month_end,
        "is_quarter_end": month_end & F.month(d).isin(3, 6, 9, 12),
    }


def season(c: str | Column) -> Column:
    month = F.month(col(c))
    return (
        F.when(month.isin(12, 1, 2), "Winter")
        .when(month.isin(3, 4, 5), "Spring")
        .when(month.isin(6, 7, 8), "Summer")
        .when(month.isNotNull(), "Fall")
    )


def is_weekend(c: str | Column) -> Column:
    return F.weekday(col(c)) >= 5


def floor_start(c: str | Column, timeframe: str | Column) -> Column:
    """Start of the day, the week (Monday) or the month, by bar timeframe."""
    t, frame = col(c), timeframe if isinstance(timeframe, Column) else F.lit(timeframe)
    return (
        F.when(frame == "W1", F.date_trunc("week", t))
        .when(frame == "MN1", F.date_trunc("month", t))
        .otherwise(F.date_trunc("day", t))
    )


# --- weather -------------------------------------------------------------------------------------


def heat_index(t: str | Column, h: str | Column) -> Column:
    """Regression formula applied from 26.7 degrees on; below it the temperature itself.

    The coefficients are those published for Fahrenheit; they are applied to the value as given.
    """
    t, h = col(t), col(h)
    fitted = (
        -42.379
        + 2.04901523 * t
        + 10.14333127 * h
        - 0.22475541 * t * h
        - 6.83783e-3 * t * t
        - 5.481717e-2 * h * h
        + 1.22874e-3 * t * t * h
        + 8.5282e-4 * t * h * h
        - 1.99e-6 * t * t * h * h
    )
    return F.when(t < 26.7, t).otherwise(fitted)


def wind_chill(t: str | Column, wind: str | Column) -> Column:
    t = col(t)
    w = F.power(col(wind), 0.16)
    return F.when(t > 10, t).otherwise(13.12 + 0.6215 * t - 11.37 * w + 0.3965 * t * w)


def comfort_index(t: str | Column, h: str | Column) -> Column:
    """0-100, best at 21 degrees and 50 % humidity."""
    temperature = F.greatest(F.lit(0.0), 100 - F.abs(col(t) - 21) * 5)
    humidity = F.greatest(F.lit(0.0), 100 - F.abs(col(h) - 50) * 2)
    return temperature * 0.6 + humidity * 0.4


# --- names ---------------------------------------------------------------------------------------


def clean_name(name: str) -> str:
    """Lower case, blanks and dashes to underscores, nothing but letters, digits and underscores."""
    return re.sub(r"[^\w]", "", re.sub(r"[ \-]", "_", str(name).lower()))
