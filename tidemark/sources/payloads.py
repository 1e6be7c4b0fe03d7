"""Landed JSON payloads to typed rows.

Every reader takes rows of ``payload STRING`` plus whatever identifies the request (``item`` by
default, and ``requested_at``) and returns one row per record. Readers are projections only: no
shuffle, no state, so they run the same on a batch and on a stream. Numbers arrive as text in many
payloads, so fields are declared as strings and converted with ``try_cast``; what does not convert
becomes null. ``rejects`` gives the payloads that hold an error or no record.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import scalar

Reader = Callable[..., DataFrame]

_TYPES = {"d": "double", "l": "bigint", "b": "boolean", "i": "int"}


def parse(df: DataFrame, ddl: str, name: str = "_p") -> DataFrame:
    """Parse the payload; fields of another shape become null."""
    return df.withColumn(name, F.from_json("payload", ddl))


def kept(df: DataFrame) -> list[str]:
    """The request columns, which every reader passes on."""
    return [c for c in df.columns if c != "payload" and not c.startswith("_p")]


def fields(source: str, spec: str) -> list[Column]:
    """``"open:d name:s=Unknown t>time:ts"``: field, optional new name, type and default.

    Types: d double, l bigint, i int, b boolean, s string, ts timestamp text, s0 epoch seconds,
    ms epoch milliseconds, date.
    """
    out = []
    for part in spec.split():
        body, _, default = part.partition("=")
        path, _, kind = body.partition(":")
        path, _, name = path.partition(">")
        value = F.col(f"{source}.{path}")
        if kind in _TYPES:
            value = value.try_cast(_TYPES[kind])
        elif kind == "ts":
            value = F.try_to_timestamp(value)
        elif kind == "s0":
            value = scalar.epoch_seconds(value)
        elif kind == "ms":
            value = scalar.epoch_millis(value)
        elif kind == "date":
            value = value.try_cast("date")
        if default:
            value = F.coalesce(value, F.lit(default if kind in ("s", "") else float(default)).cast(_TYPES.get(kind, "string")))
        out.append(value.alias(name or path.split(".")[-1]))
    return out


def _struct(names: str, inner: str = "string") -> str:
    return "struct<" + ",".join(f"`{n}`:{inner}" for n in names.split()) + ">"


def _exploded(df: DataFrame, array: str, keep: Sequence[str], position: str | None = None) -> DataFrame:
    """One row per array element ``r``, with its position when asked for."""
    if position:
        return df.select(*keep, F.posexplode(array).alias(position, "_r"))
    return df.select(*keep, F.explode(array).alias("_r"))


# --- errors --------------------------------------------------------------------------------------


def error_kind(payload: str | Column = "payload") -> Column:
    """``rate_limit``, ``api_error``, ``unparsable`` or null for a usable payload."""
    p = F.col(payload) if isinstance(payload, str) else payload
    code = F.get_json_object(p, "$.code").try_cast("int")
    bad = F.get_json_object(p, "$.code").isNotNull() & ((code != 200) | code.isNull())
    shape = F.try_parse_json(p)
    return (
        F.when(p.isNull() | shape.isNull(), "unparsable")
        .when(code == 429, "rate_limit")
        .when(bad, "api_error")
    )


def split_errors(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable payloads, rejected payloads with ``error_kind``)."""
    tagged = raw.withColumn("error_kind", error_kind())
    return tagged.filter("error_kind IS NULL").drop("error_kind"), tagged.filter("error_kind IS NOT NULL")


# --- bars, symbol lists and quotes of the multi-asset vendor -------------------------------------


def bars(raw: DataFrame, asset_type: str | None = None, interval: str | None = None) -> DataFrame:
    """``{meta, values[]}`` -> rows; meta fields become columns unless a value column has the name."""
    record = _struct("datetime open high low close volume")
    p = parse(raw, f"meta map<string,string>, values array<{record}>")
    rows = _exploded(p.withColumn("_meta", F.col("_p.meta")).withColumn("_values", F.col("_p.values")), "_values", [*kept(raw), "_meta"], "_seq")
    meta = lambda k: F.try_element_at("_meta", F.lit(k))
    item = F.col("item") if "item" in raw.columns else F.lit(None).cast("string")
    return rows.select(
        *kept(raw),
        F.try_to_timestamp("_r.datetime").alias("timestamp"),
        *fields("_r", "open:d high:d low:d close:d volume:d"),
        F.coalesce(item, meta("symbol")).alias("symbol"),
        (F.lit(interval) if interval else meta("interval")).alias("interval"),
        meta("currency").alias("currency"),
        meta("exchange").alias("exchange"),
        F.coalesce(F.lit(asset_type).cast("string"), meta("type")).alias("asset_type"),
        "_seq",
    )


def symbols(raw: DataFrame, asset_type: str | None = None) -> DataFrame:
    """``{data[]}`` -> one row per symbol; ``type`` becomes ``asset_type`` unless a constant is given.

    Funds also get a category; indices their region and type.
    """
    record = _struct("symbol name currency exchange country type mic_code access isin currency_base currency_quote")
    rows = _exploded(parse(raw, f"data array<{record}>"), "_p.data", kept(raw))
    out = rows.select(
        *kept(raw),
        *fields("_r", "symbol:s name:s currency:s exchange:s country:s mic_code:s access:s isin:s currency_base:s currency_quote:s"),
        (F.lit(asset_type) if asset_type else F.col("_r.type")).alias("asset_type"),
    )
    if asset_type == "etf":
        out = out.withColumn("category", scalar.fund_category("name"))
    return with_index_metadata(out) if asset_type == "index" else out


def with_index_metadata(df: DataFrame, symbol: str = "symbol") -> DataFrame:
    """Region and type of an index from the fixed list; ``Unknown`` outside it."""
    part = lambda n: {k: v[n] for k, v in schemas.INDEX_METADATA.items()}
    unknown = F.lit("Unknown")
    return df.withColumns(
        {
            "region": F.coalesce(scalar.lookup(symbol, part(1)), unknown),
            "index_type": F.coalesce(scalar.lookup(symbol, part(2)), unknown),
        }
    )


def quotes(raw: DataFrame, kind: str = "stock") -> DataFrame:
    """Quote object -> one row, the 52-week object flattened; extra columns by asset class."""
    week = _struct("low high low_change high_change low_change_percent high_change_percent range percent_change")
    names = "symbol name exchange currency open high low close volume previous_close change percent_change average_volume base_currency quote_currency"
    ddl = ",".join(f"`{n}` string" for n in names.split()) + f", fifty_two_week {week}"
    ddl += ", meta " + _struct("name currency exchange")
    out = parse(raw, ddl).filter(F.col("_p").isNotNull())
    base = [
        *kept(raw),
        *fields(
            "_p",
            "symbol:s open:d high:d low:d close:d volume:d previous_close:d change:d percent_change:d average_volume:d",
        ),
        F.col("_p.fifty_two_week").alias("fifty_two_week"),
        *fields(
            "_p.fifty_two_week",
            "high>week_high:d low>week_low:d range>week_range:s percent_change>week_percent_change:d",
        ),
    ]
    symbol = F.col("_p.symbol")
    extra = {
        "stock": [],
        "crypto": [
            F.substring_index(symbol, "/", 1).alias("base_currency"),
            F.when(symbol.contains("/"), F.substring_index(symbol, "/", -1)).alias("quote_currency"),
        ],
        "forex": [
            F.substring_index(symbol, "/", 1).alias("base_currency"),
            F.when(symbol.contains("/"), F.substring_index(symbol, "/", -1)).alias("quote_currency"),
        ],
        "etf": [F.coalesce(F.col(f"_p.meta.{c}"), F.col(f"_p.{c}")).alias(c) for c in ("name", "currency", "exchange")],
        "index": [F.coalesce(F.col("_p.meta.name"), F.col("_p.name")).alias("name")],
    }[kind]
    out = out.select(*base, *extra)
    return with_index_metadata(out) if kind == "index" else out


# --- quotes, candles, profiles, news and calendar of the quote vendor -----------------------------


def short_quotes(raw: DataFrame) -> DataFrame:
    """``{c,d,dp,h,l,o,pc,v}``; absent fields are 0, a payload without ``c`` gives no row."""
    out = parse(raw, ",".join(f"`{n}` string" for n in "c d dp h l o pc v".split())).filter("_p.c IS NOT NULL")
    return out.select(
        *kept(raw),
        *fields(
            "_p",
            "c>current_price:d=0 d>change:d=0 dp>percent_change:d=0 h>high_price:d=0 l>low_price:d=0 "
            "o>open_price:d=0 pc>previous_close:d=0 v>volume:d=0",
        ),
    )


def profiles(raw: DataFrame) -> DataFrame:
    names = "name exchange currency country finnhubIndustry marketCapitalization shareOutstanding weburl logo ipo"
    out = parse(raw, ",".join(f"`{n}` string" for n in names.split())).filter("_p.name IS NOT NULL")
    return out.select(
        *kept(raw),
        *fields(
            "_p",
            "name>company_name:s exchange:s currency:s=USD country:s finnhubIndustry>industry:s "
            "marketCapitalization>market_cap:d=0 shareOutstanding>share_outstanding:d=0 weburl>web_url:s "
            "logo>logo_url:s ipo>ipo_date:date",
        ),
    )


def calendar(raw: DataFrame, start: Column | None = None, end: Column | None = None) -> DataFrame:
    """Economic events; an optional range filters by date."""
    names = "id country category event reference source sourceURL actual previous forecast unit importance date"
    rows = _exploded(parse(raw, f"economicCalendar array<{_struct(names)}>"), "_p.economicCalendar", kept(raw))
    out = rows.select(
        *kept(raw),
        *fields(
            "_r",
            "id>event_id:s country:s category:s event:s reference:s source:s sourceURL>source_url:s actual:s "
            "previous:s forecast:s unit:s importance:s date:ts",
        ),
    )
    if start is not None:
        out = out.filter(F.col("date") >= start)
    return out if end is None else out.filter(F.col("date") <= end)


def candles(raw: DataFrame, resolution: str = "D") -> DataFrame:
    """Parallel arrays ``t,o,h,l,c,v`` with status ``ok``; volume 0 when absent."""
    ddl = "s string, " + ",".join(f"`{n}` array<string>" for n in "tohlcv")
    p = parse(raw, ddl).filter("_p.s = 'ok'")
    # An absent array is zipped as an empty one; otherwise it would void all the others.
    nothing = F.array().cast("array<string>")
    arrays = F.arrays_zip(*[F.coalesce(F.col(f"_p.{n}"), nothing).alias(n) for n in "tohlcv"])
    rows = p.select(*kept(raw), F.posexplode(arrays).alias("_seq", "_r"))
    return rows.select(
        *kept(raw),
        *fields("_r", "t>timestamp:s0 o>open:d h>high:d l>low:d c>close:d v>volume:d=0"),
        F.lit(resolution).alias("resolution"),
        "_seq",
    ).filter("timestamp IS NOT NULL")


def news(raw: DataFrame, category: str = "general") -> DataFrame:
    names = "id datetime headline summary source url related image lang hasPaywall"
    rows = _exploded(parse(raw, f"array<{_struct(names)}>"), "_p", kept(raw))
    return rows.select(
        *kept(raw),
        F.lit(category).alias("category"),
        *fields(
            "_r",
            "id>news_id:l datetime:s0 headline:s summary:s source:s url:s related:s image:s lang:s=en",
        ),
        F.coalesce(F.col("_r.hasPaywall").try_cast("boolean"), F.lit(False)).alias("has_paywall"),
    )


# --- macro series ---------------------------------------------------------------------------------


def observations(raw: DataFrame) -> DataFrame:
    """Observations; the missing marker ``.`` and values that do not parse are left out."""
    rows = _exploded(
        parse(raw, f"observations array<{_struct('date value realtime_start realtime_end')}>"),
        "_p.observations", kept(raw), "_seq",
    )
    out = rows.filter("_r.value <> '.'").select(
        *kept(raw), *fields("_r", "date:date value:d realtime_start:date realtime_end:date"), "_seq"
    )
    return out.dropna(subset=["date", "value"])


def observation_rejects(raw: DataFrame) -> DataFrame:
    """Observations that are not the missing marker and still do not parse."""
    rows = _exploded(parse(raw, f"observations array<{_struct('date value')}>"), "_p.observations", kept(raw))
    bad = F.col("_r.value").try_cast("double").isNull() | F.col("_r.date").try_cast("date").isNull()
    return rows.filter((F.coalesce(F.col("_r.value"), F.lit("")) != ".") & bad).select(*kept(raw), "_r.date", "_r.value")


_SERIES = (
    "id>series_id:s realtime_start:date realtime_end:date title:s observation_start:date observation_end:date "
    "frequency:s frequency_short:s units:s units_short:s seasonal_adjustment:s seasonal_adjustment_short:s "
    "last_updated:ts popularity:l group_popularity:l notes:s"
)
_SERIES_NAMES = " ".join(part.split(">")[0].split(":")[0] for part in _SERIES.split())


def series_list(raw: DataFrame) -> DataFrame:
    """Search results and category listings."""
    rows = _exploded(parse(raw, f"seriess array<{_struct(_SERIES_NAMES)}>"), "_p.seriess", kept(raw))
    return rows.select(*kept(raw), *fields("_r", _SERIES))


def series_info(raw: DataFrame) -> DataFrame:
    """First element only."""
    p = parse(raw, f"seriess array<{_struct(_SERIES_NAMES)}>").withColumn("_r", F.get("_p.seriess", 0))
    return p.filter("_r IS NOT NULL").select(*kept(raw), *fields("_r", _SERIES))


# --- aggregate bars -------------------------------------------------------------------------------


def aggregates(raw: DataFrame, forex: bool = False) -> DataFrame:
    """``results[]`` with epoch-millisecond bars; FX bars may lack a volume."""
    rows = _exploded(parse(raw, f"results array<{_struct('t o h l c v vw n')}>"), "_p.results", kept(raw), "_seq")
    volume = "v>volume:d=0" if forex else "v>volume:d"
    return rows.select(
        *kept(raw),
        *fields("_r", f"t>timestamp:ms o>open:d h>high:d l>low:d c>close:d {volume} vw>vwap:d n>transactions:l"),
        "_seq",
    )


def tickers(raw: DataFrame) -> DataFrame:
    """Ticker details (an object) or search results (an array) under ``results``."""
    record = _struct("ticker name market locale primary_exchange type currency_name active")
    p = raw.withColumns(
        {
            "_p_many": F.from_json("payload", f"results array<{record}>").getField("results"),
            "_p_one": F.from_json("payload", f"results {record}").getField("results"),
        }
    )
    one = F.when(F.col("_p_one.ticker").isNotNull(), F.array("_p_one"))
    rows = p.select(*kept(raw), F.explode(F.coalesce(one, F.col("_p_many"))).alias("_r"))
    return rows.select(
        *kept(raw),
        *fields("_r", "ticker>symbol:s name:s market:s locale:s primary_exchange:s type:s currency_name:s active:b"),
    ).filter("symbol IS NOT NULL")


# --- weather --------------------------------------------------------------------------------------

_SKY = "weather array<struct<main:string,description:string,icon:string>>"
_SKY_FIELDS = "main>weather_main:s description>weather_description:s icon>weather_icon:s"
_MAIN = _struct("temp feels_like temp_min temp_max pressure humidity sea_level grnd_level")
_MAIN_FIELDS = "temp>temperature:d feels_like:d temp_min:d temp_max:d pressure:d humidity:d sea_level:d grnd_level:d"
_WIND_FIELDS = "speed>wind_speed:d deg>wind_direction:d gust>wind_gust:d"


def _sky(df: DataFrame, source: str) -> DataFrame:
    return df.withColumn("_sky", F.get(f"{source}.weather", 0))


def _wet(source: str, what: str, hours: Sequence[str]) -> list[Column]:
    return [F.col(f"{source}.{what}.`{h}`").try_cast("double").alias(f"{what}_{h}") for h in hours]


def current_weather(raw: DataFrame, units: str = "metric") -> DataFrame:
    """Deep object -> one flat row; a payload whose ``cod`` is an error gives none."""
    two = "struct<`1h`:string,`3h`:string>"
    ddl = (
        f"cod string, coord {_struct('lat lon')}, dt string, main {_MAIN}, visibility string, "
        f"wind {_struct('speed deg gust')}, clouds struct<`all`:string>, rain {two}, snow {two}, {_SKY}, "
        f"sys {_struct('sunrise sunset country')}, timezone string, id string, name string"
    )
    p = _sky(parse(raw, ddl).filter("_p.main IS NOT NULL AND coalesce(_p.cod, '200') = '200'"), "_p")
    return p.select(
        *kept(raw),
        *fields("_p", "coord.lat>latitude:d coord.lon>longitude:d dt>timestamp:s0"),
        *fields("_p.main", _MAIN_FIELDS),
        *fields("_p", "visibility:d"),
        *fields("_p.wind", _WIND_FIELDS),
        *fields("_p.clouds", "all>cloudiness:d"),
        *_wet("_p", "rain", ("1h", "3h")),
        *_wet("_p", "snow", ("1h", "3h")),
        *fields("_sky", _SKY_FIELDS),
        *fields("_p.sys", "sunrise:s0 sunset:s0"),
        *fields("_p", "timezone:i sys.country>country:s id>city_id:l name>city_name:s"),
        F.lit(units).alias("units"),
    )


def forecast(raw: DataFrame, units: str = "metric") -> DataFrame:
    """Three-hour forecast: one row per entry, with the city's fields."""
    three = "struct<`3h`:string>"
    entry = (
        f"struct<dt:string,main:{_MAIN},visibility:string,wind:{_struct('speed deg gust')},"
        f"clouds:struct<`all`:string>,pop:string,rain:{three},snow:{three},{_SKY.replace(' ', ':', 1)}>"
    )
    city = f"struct<coord:{_struct('lat lon')},country:string,timezone:string>"
    p = parse(raw, f"cod string, city {city}, list array<{entry}>").filter("_p.cod = '200'")
    rows = _sky(p.select(*kept(raw), F.col("_p.city").alias("_c"), F.explode("_p.list").alias("_r")), "_r")
    return rows.select(
        *kept(raw),
        *fields("_c", "coord.lat>latitude:d coord.lon>longitude:d country:s timezone:i"),
        *fields("_r", "dt>timestamp:s0"),
        *fields("_r.main", _MAIN_FIELDS),
        *fields("_r", "visibility:d"),
        *fields("_r.wind", _WIND_FIELDS),
        *fields("_r.clouds", "all>cloudiness:d"),
        *fields("_r", "pop:d"),
        *_wet("_r", "rain", ("3h",)),
        *_wet("_r", "snow", ("3h",)),
        *fields("_sky", _SKY_FIELDS),
        F.lit("3hour").alias("forecast_type"),
        F.lit(units).alias("units"),
    )


def daily_forecast(raw: DataFrame, days: int = 7, units: str = "metric") -> DataFrame:
    """The first ``days`` entries of the daily forecast."""
    entry = (
        "struct<dt:string,sunrise:string,sunset:string,moonrise:string,moonset:string,moon_phase:string,"
        f"temp:{_struct('day min max night eve morn')},feels_like:{_struct('day night eve morn')},pressure:string,"
        "humidity:string,dew_point:string,wind_speed:string,wind_deg:string,wind_gust:string,clouds:string,"
        f"uvi:string,pop:string,rain:string,snow:string,{_SKY.replace(' ', ':', 1)}>"
    )
    p = parse(raw, f"lat string, lon string, daily array<{entry}>")
    rows = _sky(
        p.select(*kept(raw), F.col("_p").alias("_c"), F.explode(F.slice("_p.daily", 1, days)).alias("_r")), "_r"
    )
    return rows.select(
        *kept(raw),
        *fields("_c", "lat>latitude:d lon>longitude:d"),
        F.to_date(scalar.epoch_seconds("_r.dt")).alias("date"),
        *fields("_r", "dt>timestamp:s0 sunrise:s0 sunset:s0 moonrise:s0 moonset:s0 moon_phase:d"),
        *fields("_r.temp", "day>temp_day:d min>temp_min:d max>temp_max:d night>temp_night:d eve>temp_eve:d morn>temp_morn:d"),
        *fields("_r.feels_like", "day>feels_like_day:d night>feels_like_night:d eve>feels_like_eve:d morn>feels_like_morn:d"),
        *fields(
            "_r",
            "pressure:d humidity:d dew_point:d wind_speed:d wind_deg>wind_direction:d wind_gust:d "
            "clouds>cloudiness:d uvi:d pop:d rain:d snow:d",
        ),
        *fields("_sky", _SKY_FIELDS),
        F.lit("daily").alias("forecast_type"),
        F.lit(units).alias("units"),
    )


def historical_weather(raw: DataFrame, units: str = "metric") -> DataFrame:
    """The day's ``current`` record and its ``hourly`` records, told apart by ``data_type``."""
    one = "struct<`1h`:string>"
    entry = (
        "struct<dt:string,temp:string,feels_like:string,pressure:string,humidity:string,dew_point:string,uvi:string,"
        "clouds:string,visibility:string,wind_speed:string,wind_deg:string,wind_gust:string,pop:string,"
        f"rain:{one},snow:{one},{_SKY.replace(' ', ':', 1)},sunrise:string,sunset:string>"
    )
    p = parse(raw, f"lat string, lon string, current {entry}, hourly array<{entry}>").filter("_p.current IS NOT NULL")
    tagged = F.concat(
        F.array(F.struct(F.lit("historical").alias("data_type"), F.col("_p.current").alias("r"))),
        F.transform(
            F.coalesce(F.col("_p.hourly"), F.array()),
            lambda h: F.struct(F.lit("historical_hourly").alias("data_type"), h.alias("r")),
        ),
    )
    rows = p.select(*kept(raw), F.col("_p").alias("_c"), F.inline(tagged)).withColumnRenamed("r", "_r")
    return _sky(rows, "_r").select(
        *kept(raw),
        *fields("_c", "lat>latitude:d lon>longitude:d"),
        *fields(
            "_r",
            "dt>timestamp:s0 temp>temperature:d feels_like:d pressure:d humidity:d dew_point:d uvi:d clouds>cloudiness:d "
            "visibility:d wind_speed:d wind_deg>wind_direction:d wind_gust:d pop:d",
        ),
        *_wet("_r", "rain", ("1h",)),
        *_wet("_r", "snow", ("1h",)),
        *fields("_sky", _SKY_FIELDS),
        *fields("_r", "sunrise:s0 sunset:s0"),
        "data_type",
        F.lit(units).alias("units"),
    )


def air_pollution(raw: DataFrame) -> DataFrame:
    gases = "co no no2 o3 so2 pm2_5 pm10 nh3"
    entry = f"struct<dt:string,main:struct<aqi:string>,components:{_struct(gases)}>"
    p = parse(raw, f"coord {_struct('lat lon')}, list array<{entry}>")
    rows = p.select(*kept(raw), F.col("_p.coord").alias("_c"), F.explode("_p.list").alias("_r"))
    return rows.select(
        *kept(raw),
        *fields("_c", "lat>latitude:d lon>longitude:d"),
        *fields("_r", "dt>timestamp:s0 main.aqi>aqi:l"),
        *fields("_r.components", " ".join(f"{g}:d" for g in gases.split())),
    )


def places(raw: DataFrame) -> DataFrame:
    """First match of a place lookup: (latitude, longitude)."""
    p = parse(raw, f"array<{_struct('name lat lon country')}>").withColumn("_r", F.get("_p", 0))
    return p.filter("_r IS NOT NULL").select(*kept(raw), *fields("_r", "name:s lat>latitude:d lon>longitude:d country:s"))


# --- positional candles, tickers and symbol records ----------------------------------------------


def _positions(raw: DataFrame) -> DataFrame:
    return _exploded(parse(raw, "array<array<string>>"), "_p", kept(raw), "_seq").filter("size(_r) >= 6")


def _at(n: int, kind: str, name: str) -> Column:
    return F.get("_r", n).try_cast(kind).alias(name)


_OHLC_AT = lambda o, h, l, c: [_at(o, "double", "open"), _at(h, "double", "high"), _at(l, "double", "low"), _at(c, "double", "close")]


def terminal_candles(raw: DataFrame, timeframe: str = "D1", broker: str = "default") -> DataFrame:
    """``[time, o, h, l, c, tick volume, spread, real volume]``; a real volume of 0 is unknown."""
    rows = _positions(raw)
    real = F.get("_r", 7).try_cast("bigint")
    return rows.select(
        *kept(raw),
        F.lit(broker).alias("broker"),
        scalar.base_currency("item").alias("from_currency"),
        scalar.quote_currency("item").alias("to_currency"),
        F.lit(timeframe).alias("timeframe"),
        scalar.epoch_seconds(F.get("_r", 0)).alias("timestamp"),
        *_OHLC_AT(1, 2, 3, 4),
        _at(5, "bigint", "tick_volume"),
        F.when(real > 0, real).alias("real_volume"),
        "_seq",
    )


def symbol_records(raw: DataFrame) -> DataFrame:
    names = "spread point digits bid ask volume last volume_min volume_max trade_tick_size"
    p = parse(raw, ",".join(f"`{n}` string" for n in names.split())).filter("_p.point IS NOT NULL")
    return p.select(
        *kept(raw),
        *fields(
            "_p",
            "spread:l point:d digits:l bid:d ask:d volume:d last>last_price:d volume_min>min_volume:d "
            "volume_max>max_volume:d trade_tick_size>tick_size:d",
        ),
    )


def dated_series(raw: DataFrame, newest: int | None = None) -> DataFrame:
    """Map of date -> ``{"1. open": ...}`` under the payload's time-series key -> rows.

    ``newest`` keeps only that many latest dates of each payload.
    """
    maps = F.from_json("payload", "map<string,string>")
    key = F.get(F.filter(F.map_keys(maps), lambda k: k.startswith("Time Series")), 0)
    inner = F.from_json(F.try_element_at(maps, key), "map<string,map<string,string>>")
    entries = F.map_entries(inner)
    if newest is not None:
        newer = lambda a, b: F.when(a.getField("key") > b.getField("key"), -1).otherwise(1)
        entries = F.slice(F.array_sort(entries, newer), 1, newest)
    rows = raw.withColumn("_p", entries).select(*kept(raw), F.inline("_p"))
    value = lambda k, kind: F.try_element_at("value", F.lit(k)).try_cast(kind)
    return rows.select(
        *kept(raw),
        F.col("key").try_cast("date").alias("date"),
        *[value(f"{n}. {c}", "double").alias(c) for n, c in enumerate(("open", "high", "low", "close"), 1)],
        value("5. volume", "bigint").alias("volume"),
    )


def spot_rates(raw: DataFrame) -> DataFrame:
    """Spot exchange-rate object -> (pair, rate, timestamp)."""
    p = parse(raw, "`Realtime Currency Exchange Rate` map<string,string>")
    rate = "`Realtime Currency Exchange Rate`"
    value = lambda k: F.try_element_at(F.col(f"_p.{rate}"), F.lit(k))
    return p.select(
        *kept(raw),
        scalar.pair_label(value("1. From_Currency Code"), value("3. To_Currency Code")).alias("pair"),
        value("5. Exchange Rate").try_cast("double").alias("rate"),
        F.try_to_timestamp(value("6. Last Refreshed")).alias("timestamp"),
    ).filter("rate IS NOT NULL")


def klines(raw: DataFrame, exchange: str = "binance") -> DataFrame:
    """Twelve-element arrays; an error object gives no row."""
    return _positions(raw).filter("size(_r) >= 9").select(
        *kept(raw),
        F.lit(exchange).alias("exchange"),
        scalar.epoch_millis(F.get("_r", 0)).alias("timestamp"),
        *_OHLC_AT(1, 2, 3, 4),
        _at(5, "double", "volume"),
        scalar.epoch_millis(F.get("_r", 6)).alias("close_time"),
        _at(7, "double", "quote_volume"),
        _at(8, "bigint", "trades"),
        "_seq",
    )


def day_tickers(raw: DataFrame, exchange: str = "binance") -> DataFrame:
    """24-hour ticker: one object or an array of objects."""
    record = _struct(
        "symbol priceChange priceChangePercent weightedAvgPrice prevClosePrice lastPrice bidPrice askPrice openPrice "
        "highPrice lowPrice volume quoteVolume openTime closeTime count"
    )
    p = raw.withColumns({"_p_many": F.from_json("payload", f"array<{record}>"), "_p_one": F.from_json("payload", record)})
    one = F.when(F.ltrim("payload").startswith("{"), F.array("_p_one")).otherwise(F.col("_p_many"))
    rows = p.select(*kept(raw), F.explode(one).alias("_r")).filter("_r.symbol IS NOT NULL")
    return rows.select(
        *kept(raw),
        F.lit(exchange).alias("exchange"),
        *fields(
            "_r",
            "symbol:s priceChange>price_change:d priceChangePercent>price_change_percent:d "
            "weightedAvgPrice>weighted_avg_price:d prevClosePrice>prev_close_price:d lastPrice>last_price:d "
            "bidPrice>bid_price:d askPrice>ask_price:d openPrice>open_price:d highPrice>high_price:d "
            "lowPrice>low_price:d volume:d quoteVolume>quote_volume:d openTime>open_time:ms closeTime>close_time:ms "
            "count>trades:l",
        ),
    )


def exchange_candles(raw: DataFrame, interval: str = "1d", exchange: str = "coinbase") -> DataFrame:
    """``[t, low, high, open, close, volume]`` (note the order)."""
    return _positions(raw).select(
        *kept(raw),
        F.lit(exchange).alias("exchange"),
        F.lit(schemas.CANDLE_SECONDS[interval]).alias("granularity_seconds"),
        scalar.epoch_seconds(F.get("_r", 0)).alias("timestamp"),
        *_OHLC_AT(3, 2, 1, 4),
        _at(5, "double", "volume"),
        "_seq",
    )


def exchange_tickers(raw: DataFrame, exchange: str = "coinbase") -> DataFrame:
    """Ticker object; its time may be absent."""
    names = "trade_id price size bid ask volume time"
    p = parse(raw, ",".join(f"`{n}` string" for n in names.split())).filter("_p.price IS NOT NULL")
    return p.select(
        *kept(raw),
        F.lit(exchange).alias("exchange"),
        *fields("_p", "trade_id:l price:d size:d bid:d ask:d volume:d time:ts"),
    )


READERS: Mapping[str, Reader] = {
    "bars": bars, "symbols": symbols, "quotes": quotes, "short_quotes": short_quotes, "profiles": profiles,
    "calendar": calendar, "candles": candles, "news": news, "observations": observations,
    "series_list": series_list, "series_info": series_info, "aggregates": aggregates, "tickers": tickers,
    "current_weather": current_weather, "forecast": forecast, "daily_forecast": daily_forecast,
    "historical_weather": historical_weather, "air_pollution": air_pollution, "places": places,
    "terminal_candles": terminal_candles, "symbol_records": symbol_records, "dated_series": dated_series,
    "spot_rates": spot_rates, "klines": klines, "day_tickers": day_tickers,
    "exchange_candles": exchange_candles, "exchange_tickers": exchange_tickers,
}


def read(source: str, raw: DataFrame, **options) -> DataFrame:
    """Rows of the payloads of one source; payloads that hold an error are left to ``split_errors``."""
    return READERS[source](raw, **options)


def landed(spark, path: str, stream: bool = False) -> DataFrame:
    """Landed payload files (Parquet with ``payload``, ``item``, ``requested_at``)."""
    ddl = "payload string, item string, requested_at timestamp"
    return (spark.readStream if stream else spark.read).schema(ddl).parquet(path)
