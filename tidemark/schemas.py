"""Entities, merge keys, validation rules and lookup values.

The values in this file are fixed: results depend on them.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class Entity:
    """A stored table: columns, merge keys (with the value a null key stands for) and partitioning."""

    table: str
    schema: T.StructType
    keys: tuple[str, ...]
    time: str
    null_keys: dict[str, str] = field(default_factory=dict)


def _schema(ddl: str) -> T.StructType:
    stamps = "source string, created_at timestamp, updated_at timestamp"
    return T._parse_datatype_string(f"{ddl}, {stamps}")


_DDL = {
    "stock_prices": (
        "symbol string, date date, open decimal(12,4), high decimal(12,4), low decimal(12,4), "
        "close decimal(12,4), volume bigint, adj_close decimal(12,4), dividend_amount decimal(12,4), "
        "split_coefficient decimal(12,4)",
        ("symbol", "date"),
        "date",
        {},
    ),
    "forex_rates": (
        "from_currency string, to_currency string, date date, open decimal(15,6), high decimal(15,6), "
        "low decimal(15,6), close decimal(15,6), volume bigint",
        ("from_currency", "to_currency", "date"),
        "date",
        {},
    ),
    "forex_mt5": (
        "from_currency string, to_currency string, timestamp timestamp, open decimal(15,6), "
        "high decimal(15,6), low decimal(15,6), close decimal(15,6), volume bigint, "
        "real_volume bigint, timeframe string, broker string, account_type string, is_bid boolean, "
        "tick_count bigint",
        ("from_currency", "to_currency", "timestamp", "timeframe", "broker"),
        "timestamp",
        {"broker": "default"},
    ),
    "crypto_prices": (
        "symbol string, exchange string, timestamp timestamp, open decimal(20,8), high decimal(20,8), "
        "low decimal(20,8), close decimal(20,8), volume decimal(30,8), quote_volume decimal(30,8)",
        ("symbol", "exchange", "timestamp"),
        "timestamp",
        {},
    ),
    "economic_indicators": (
        "series_id string, date date, value decimal(20,6), realtime_start date, realtime_end date, "
        "seasonal_adjustment string, region string, is_revised boolean, revision_number int, "
        "data_release_date date",
        ("series_id", "date", "seasonal_adjustment", "region"),
        "date",
        {"seasonal_adjustment": "NSA", "region": "US"},
    ),
    "weather_data": (
        "location string, latitude decimal(9,6), longitude decimal(9,6), timestamp timestamp, "
        "temperature decimal(5,2), humidity decimal(5,2), pressure decimal(7,2), "
        "wind_speed decimal(6,2), weather_condition string",
        ("location", "timestamp"),
        "timestamp",
        {},
    ),
    "sentiment_data": (
        "entity string, timestamp timestamp, sentiment_score decimal(5,4), confidence decimal(5,4), "
        "raw_text string, url string",
        ("source", "entity", "timestamp"),
        "timestamp",
        {},
    ),
    "pipeline_runs": (
        "pipeline_id string, run_id string, status string, start_time timestamp, ended_at timestamp, "
        "records_processed bigint, records_failed bigint, warning_count bigint, "
        "duration_seconds double, error_message string",
        ("run_id",),
        "start_time",
        {},
    ),
}


def entity(table: str) -> Entity:
    """The entity stored in ``table`` (needs an active session to parse its types)."""
    ddl, keys, time, null_keys = _DDL[table]
    return Entity(table, _schema(ddl), keys, time, null_keys)


TABLES = tuple(_DDL)

# Cleaning schemas: the logical type each column is coerced to.
CLEAN_SCHEMAS = {
    "stock": {
        "symbol": "str", "date": "datetime", "open": "float", "high": "float", "low": "float",
        "close": "float", "volume": "int",
    },
    "weather": {
        "location": "str", "timestamp": "datetime", "temperature": "float", "humidity": "float",
        "pressure": "float", "wind_speed": "float",
    },
    "forex": {
        "from_currency": "str", "to_currency": "str", "date": "datetime", "open": "float",
        "high": "float", "low": "float", "close": "float",
    },
    "economic": {"series_id": "str", "date": "datetime", "value": "float"},
}

MISSING_THRESHOLD = 0.1
Z_THRESHOLD = 3.0
PASS_RATE = 0.95
ERROR_RATE_ALERT = 0.05
FAILURE_STREAK_ALERT = 3
LOAD_FAILURE_THRESHOLD = 0.05

# Canonical column names and the names accepted for them; the first rule that matches wins.
COLUMN_ALIASES = {
    "timestamp": ("timestamp", "time", "datetime", "date_time"),
    "date": ("date", "trade_date", "transaction_date", "observation_date"),
    "time": ("trade_time",),
    "open": ("open", "open_price", "opening_price"),
    "high": ("high", "high_price", "highest_price"),
    "low": ("low", "low_price", "lowest_price"),
    "close": ("close", "close_price", "closing_price", "price"),
    "volume": ("volume", "trade_volume", "vol"),
    "symbol": ("symbol", "ticker", "instrument", "pair"),
    "exchange": ("exchange", "venue", "market"),
    "adj_close": ("adj_close", "adjusted_close", "adjusted_closing_price"),
    "dividend": ("dividend", "dividend_amount"),
    "split": ("split", "split_coefficient"),
    "value": ("value", "observation", "measure"),
    "series_id": ("series_id", "series_code", "indicator_id"),
    "temperature": ("temperature", "temp"),
    "humidity": ("humidity", "relative_humidity"),
    "pressure": ("pressure", "air_pressure"),
    "wind_speed": ("wind_speed", "wind_velocity"),
    "sentiment_score": ("sentiment_score", "sentiment", "polarity"),
    "confidence": ("confidence", "confidence_score"),
}

NUMERIC_COLUMNS = (
    "open", "high", "low", "close", "volume", "adj_close", "dividend", "split", "value",
    "temperature", "humidity", "pressure", "wind_speed", "sentiment_score", "confidence",
)
PRICE_COLUMNS = ("open", "high", "low", "close", "adj_close", "value")

REQUIRED_COLUMNS = {
    "stock": ("timestamp", "symbol", "open", "high", "low", "close", "volume"),
    "crypto": ("timestamp", "symbol", "open", "high", "low", "close", "volume", "exchange"),
    "forex": ("timestamp", "symbol", "open", "high", "low", "close"),
    "economic": ("timestamp", "series_id", "value"),
    "weather": ("timestamp", "location", "temperature", "humidity", "pressure", "wind_speed"),
    "sentiment": ("timestamp", "entity", "sentiment_score", "confidence"),
}
TEXT_COLUMNS = ("symbol", "exchange", "series_id", "location", "entity")

# The columns that name a series, by data type.
SERIES_KEYS = {
    "stock": ("symbol",), "crypto": ("symbol",), "forex": ("symbol",), "economic": ("series_id",),
    "weather": ("location",), "sentiment": ("entity",),
}

TARGET_GRANULARITY = {
    "stock": "1d", "crypto": "1h", "forex": "1h", "economic": "1d", "weather": "1h", "sentiment": "1d",
}

# Longest median gap, in seconds, that still counts as the granularity.
GRANULARITY_LIMITS = (
    ("1m", 60), ("5m", 300), ("15m", 900), ("30m", 1800), ("1h", 3600), ("1d", 86400),
    ("1w", 7 * 86400), ("1M", 30 * 86400),
)

# Units of each currency per US dollar.
CURRENCY_RATES = {
    "USD": 1.0, "EUR": 0.85, "GBP": 0.73, "JPY": 110.0, "CAD": 1.25, "AUD": 1.35, "CHF": 0.92,
    "CNY": 6.45, "INR": 75.0,
}

EXCHANGE_SUFFIXES = (".US", ".O", ".N", ".TO", ".V", ".AX", ".L", ".DE")

SYMBOL_MAP = {
    "AAPL.O": "AAPL", "AAPL.US": "AAPL", "MSFT.O": "MSFT", "MSFT.US": "MSFT", "GOOGL.O": "GOOGL",
    "GOOGL.US": "GOOGL", "BTC-USD": "BTCUSDT", "BTC/USD": "BTCUSDT", "ETH-USD": "ETHUSDT",
    "ETH/USD": "ETHUSDT", "EUR/USD": "EURUSD", "GBP/USD": "GBPUSD", "USD/JPY": "USDJPY",
    "AUD/USD": "AUDUSD",
}

UNIT_MAP = {
    "percent": "percentage", "pct": "percentage", "%": "percentage", "us dollars": "usd",
    "dollars": "usd", "$": "usd", "euros": "eur", "pounds": "gbp", "yens": "jpy",
}

# Fund categories by keyword in the name; the first rule that matches wins.
FUND_RULES = (
    ("broad_market", ("spdr", "spy", "s&p", "standard & poor")),
    ("tech", ("nasdaq", "qqq", "invesco qqq")),
    ("broad_market", ("vanguard", "total stock", "vti")),
    ("broad_market", ("ishares", "core s&p")),
    ("financial", ("financial", "xlf")),
    ("tech", ("technology", "xlk")),
    ("energy", ("energy", "xle")),
    ("healthcare", ("health", "xlu")),
    ("innovative", ("ark", "innovation")),
    ("dividend", ("dividend", "income")),
)

FUND_CATEGORIES = {
    "broad_market": ("SPY", "VTI", "IVV", "VOO"),
    "sector": ("XLF", "XLK", "XLE", "XLV", "XLI", "XLP", "XLY", "XLU", "XLB"),
    "tech": ("QQQ", "XLK"),
    "innovative": ("ARKK", "ARKG", "ARKF"),
}

# symbol: (name, region, type)
INDEX_METADATA = {
    "DJI": ("Dow Jones Industrial Average", "US", "price_weighted"),
    "IXIC": ("NASDAQ Composite", "US", "market_cap_weighted"),
    "GSPC": ("S&P 500", "US", "market_cap_weighted"),
    "RUT": ("Russell 2000", "US", "market_cap_weighted"),
    "FTSE": ("FTSE 100", "UK", "market_cap_weighted"),
    "N225": ("Nikkei 225", "Japan", "price_weighted"),
    "HSI": ("Hang Seng Index", "Hong Kong", "market_cap_weighted"),
    "AXJO": ("S&P/ASX 200", "Australia", "market_cap_weighted"),
    "STOXX50E": ("EURO STOXX 50", "Europe", "market_cap_weighted"),
    "VIX": ("CBOE Volatility Index", "US", "volatility"),
}

# The items requested by default, by asset type.
DEFAULT_ITEMS = {
    "forex": ("EUR/USD", "GBP/USD", "USD/JPY", "USD/CHF", "AUD/USD", "USD/CAD", "NZD/USD"),
    "stock": ("AAPL", "MSFT", "GOOGL", "AMZN", "TSLA", "META", "NVDA", "JPM", "JNJ", "V"),
    "crypto": ("BTC/USD", "ETH/USD", "BNB/USD", "XRP/USD", "ADA/USD", "SOL/USD", "DOT/USD", "DOGE/USD"),
    "etf": ("SPY", "QQQ", "VTI", "IVV", "VOO", "ARKK", "XLF", "XLK", "XLE", "XLV"),
    "index": ("DJI", "IXIC", "GSPC", "RUT", "FTSE", "N225", "HSI", "AXJO"),
    "city": ("New York", "London", "Tokyo"),
    "indicator": ("GDP", "UNRATE", "CPIAUCSL"),
}

INTERVALS = (
    "1min", "5min", "15min", "30min", "45min", "1h", "2h", "4h", "1day", "1week", "1month",
)
CANDLE_SECONDS = {"1m": 60, "5m": 300, "15m": 900, "1h": 3600, "6h": 21600, "1d": 86400}
TIMEFRAMES = ("M1", "M5", "M15", "M30", "H1", "H4", "D1", "W1", "MN1")

_PRICE_RANGE = {"min": 0, "max": 1000000}
_RATE_RANGE = {"min": 0.0001, "max": 1000}

# numeric, positive, range and consistency rules of the validator, by data type.
VALIDATION = {
    "stock": {
        "numeric": ("open", "high", "low", "close", "volume", "adj_close"),
        "positive": ("open", "high", "low", "close", "volume"),
        "ranges": {
            "open": _PRICE_RANGE, "high": _PRICE_RANGE, "low": _PRICE_RANGE, "close": _PRICE_RANGE,
            "volume": {"min": 0, "max": 1e12}, "adj_close": _PRICE_RANGE,
        },
        "consistency": (
            ("high", ">=", "low"), ("high", ">=", "open"), ("high", ">=", "close"),
            ("low", "<=", "open"), ("low", "<=", "close"),
        ),
        "unique": ("timestamp", "symbol"),
    },
    "crypto": {
        "numeric": ("open", "high", "low", "close", "volume"),
        "positive": ("open", "high", "low", "close", "volume"),
        "ranges": {
            "open": _PRICE_RANGE, "high": _PRICE_RANGE, "low": _PRICE_RANGE, "close": _PRICE_RANGE,
            "volume": {"min": 0, "max": 1e15},
        },
        "consistency": (),
        "unique": ("timestamp", "symbol", "exchange"),
    },
    "forex": {
        "numeric": ("open", "high", "low", "close"),
        "positive": ("open", "high", "low", "close"),
        "ranges": {"open": _RATE_RANGE, "high": _RATE_RANGE, "low": _RATE_RANGE, "close": _RATE_RANGE},
        "consistency": (),
        "unique": ("timestamp", "symbol"),
    },
    "economic": {
        "numeric": ("value",),
        "positive": (),
        "ranges": {"value": {"min": -1e12, "max": 1e12}},
        "consistency": (),
        "unique": ("timestamp", "series_id"),
    },
    "weather": {
        "numeric": ("temperature", "humidity", "pressure", "wind_speed"),
        "positive": (),
        "ranges": {
            "temperature": {"min": -100, "max": 100}, "humidity": {"min": 0, "max": 100},
            "pressure": {"min": 800, "max": 1100}, "wind_speed": {"min": 0, "max": 150},
        },
        "consistency": (),
        "unique": ("timestamp", "location"),
    },
    "sentiment": {
        "numeric": ("sentiment_score", "confidence"),
        "positive": (),
        "ranges": {"sentiment_score": {"min": -1, "max": 1}, "confidence": {"min": 0, "max": 1}},
        "consistency": (),
        "unique": ("timestamp", "entity", "source"),
    },
}

_OHLC_CHECKS = {
    "high_gte_low": "high >= low",
    "high_gte_open": "high >= open",
    "high_gte_close": "high >= close",
    "low_lte_open": "low <= open",
    "low_lte_close": "low <= close",
    "positive_prices": "open > 0 AND high > 0 AND low > 0 AND close > 0",
    "volume_non_negative": "volume >= 0",
}
_CURRENCY_CHECK = {
    "currency_codes": "from_currency RLIKE '^[A-Z]{3}$' AND to_currency RLIKE '^[A-Z]{3}$' "
    "AND from_currency <> to_currency",
}

# Row constraints per table. A row breaks a constraint only when the predicate is false, not null.
TABLE_CHECKS = {
    "forex_rates": {**_OHLC_CHECKS, **_CURRENCY_CHECK},
    "stock_prices": {
        **_OHLC_CHECKS,
        "adj_close_positive": "adj_close IS NULL OR adj_close > 0",
        "symbol_format": "symbol RLIKE '^[A-Z]{1,10}$'",
    },
    "weather_data": {
        "humidity_range": "humidity BETWEEN 0 AND 100",
        "cloud_range": "cloudiness BETWEEN 0 AND 100",
        "wind_direction_range": "wind_direction BETWEEN 0 AND 360",
        "hour_range": "hour IS NULL OR hour BETWEEN 0 AND 23",
        "latitude_range": "latitude BETWEEN -90 AND 90",
        "longitude_range": "longitude BETWEEN -180 AND 180",
        "precipitation_non_negative": "precipitation >= 0",
        "wind_speed_non_negative": "wind_speed >= 0",
        "uv_non_negative": "uvi >= 0",
    },
    "economic_indicators": {
        "date_order": "period_start IS NULL OR period_end IS NULL OR period_start <= period_end",
        "revision_non_negative": "revision_number >= 0",
        "series_format": "series_id RLIKE '^[A-Z0-9]{1,50}$'",
    },
    "pipeline_runs": {
        "status_valid": "status IN ('running', 'success', 'partial_success', 'failed', 'cancelled')",
        "counts_non_negative": "records_processed >= 0 AND records_failed >= 0 AND warning_count >= 0",
        "extract_duration_positive": "extract_duration_seconds IS NULL OR extract_duration_seconds > 0",
        "ended_after_started": "ended_at IS NULL OR ended_at >= start_time",
        "retry_non_negative": "retry_count >= 0",
        "duration_adds_up": "duration_seconds IS NULL OR duration_seconds = "
        "coalesce(extract_duration_seconds, 0) + coalesce(transform_duration_seconds, 0) "
        "+ coalesce(load_duration_seconds, 0)",
    },
    "forex_mt5": {
        **_OHLC_CHECKS,
        **_CURRENCY_CHECK,
        "real_volume_non_negative": "real_volume IS NULL OR real_volume >= 0",
        "tick_count_non_negative": "tick_count IS NULL OR tick_count >= 0",
        "timeframe_valid": "timeframe IN ('M1', 'M5', 'M15', 'M30', 'H1', 'H4', 'D1', 'W1', 'MN1')",
    },
    "crypto_prices": {k: v for k, v in _OHLC_CHECKS.items()},
    "sentiment_data": {
        "score_range": "sentiment_score BETWEEN -1 AND 1",
        "confidence_range": "confidence BETWEEN 0 AND 1",
    },
}

# word: (polarity in -1..1, subjectivity in 0..1)
LEXICON = {
    "good": (0.7, 0.6), "great": (0.8, 0.75), "excellent": (1.0, 1.0), "best": (1.0, 0.3),
    "better": (0.5, 0.5), "positive": (0.23, 0.55), "strong": (0.43, 0.73), "gain": (0.4, 0.4),
    "gains": (0.4, 0.4), "rise": (0.3, 0.3), "rises": (0.3, 0.3), "profit": (0.4, 0.4),
    "growth": (0.4, 0.3), "happy": (0.8, 1.0), "success": (0.3, 0.0), "new": (0.14, 0.45),
    "bad": (-0.7, 0.67), "terrible": (-1.0, 1.0), "worst": (-1.0, 1.0), "worse": (-0.4, 0.6),
    "negative": (-0.3, 0.4), "weak": (-0.38, 0.63), "loss": (-0.4, 0.4), "losses": (-0.4, 0.4),
    "fall": (-0.3, 0.3), "falls": (-0.3, 0.3), "crisis": (-0.5, 0.5), "poor": (-0.4, 0.6),
    "sad": (-0.5, 1.0), "risk": (-0.2, 0.4), "failed": (-0.5, 0.3), "error": (-0.3, 0.3),
}

# Words that turn the sentiment of the words after them round, and words that make it stronger or weaker.
NEGATIONS = ("no", "not", "never", "none", "neither", "nor", "without", "cannot")
DEGREES = {"very": 1.5, "extremely": 2.0, "really": 1.3, "highly": 1.5, "rather": 0.8, "slightly": 0.5, "barely": 0.3}
