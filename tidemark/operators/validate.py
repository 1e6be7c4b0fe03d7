"""Data-quality checks as counters, their summary, and the rows that break declared rules.

``results`` has one row per key and *emitted* check: a check that finds nothing emits nothing, except
the required-columns check. Two passes over the rows give them all: one aggregate with the row-wise counters,
the moments for z-scores and the lengths of the series, then one pass in the order of the series, in which anomalies,
repeats and gaps are found together.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.scalar import lookup
from tidemark.operators.clean import SEQ, is_numeric
from tidemark.operators.series import ROWS_PER_CHUNK, Series, attach, join_on, over_series
from tidemark.operators.stats import BUFFERED_ROWS, quantiles
from tidemark.session import pin, small, stage

RESULT_COLUMNS = ("check_name", "level", "passed", "violations", "detail")


def _result(name: str, level: Column | str, passed: Column | bool, violations: Column, **detail) -> Column:
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    described = [lit(v).cast("string").alias(k) for k, v in detail.items()]
    return F.struct(
        F.lit(name).alias("check_name"),
        lit(level).alias("level"),
        lit(passed).cast("boolean").alias("passed"),
        violations.cast("bigint").alias("violations"),
        F.to_json(F.struct(*described)).alias("detail") if described else F.lit("{}").alias("detail"),
    )


class _Counters:
    """Collects named aggregates and the results built from them."""

    def __init__(self) -> None:
        self.aggregates: dict[str, Column] = {}
        self.results: list[Column] = []

    def count(self, predicate: Column) -> Column:
        name = f"_c{len(self.aggregates)}"
        self.aggregates[name] = F.count_if(predicate)
        return F.col(name)

    def add(self, name: str, level, passed, violations: Column, when: Column | None = None, **detail) -> None:
        shown = violations > 0 if when is None else when
        self.results.append(F.when(shown, _result(name, level, passed, violations, **detail)))


def results(
    df: DataFrame,
    kind: str,
    s: Series,
    rules: Mapping | None = None,
    required: Sequence[str] | None = None,
    missing_threshold: float = schemas.MISSING_THRESHOLD,
    z_threshold: float = schemas.Z_THRESHOLD,
    now: Column | None = None,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """(keys, check_name, level, passed, violations, detail) for every emitted check."""
    rules = rules or schemas.VALIDATION[kind]
    required = schemas.REQUIRED_COLUMNS[kind] if required is None else required
    types = dict(df.dtypes)
    now = F.current_timestamp() if now is None else now
    numeric = [c for c in rules["numeric"] if c in types and is_numeric(types[c])]
    counters = _Counters()
    total = F.col("_rows")

    absent = [c for c in required if c not in types]
    counters.add(
        "required_columns", "ERROR" if absent else "INFO", not absent, F.lit(len(absent)), F.lit(True),
        missing=",".join(absent),
    )
    for c in rules["numeric"]:
        if c in types:
            missing = counters.count(F.col(c).isNull())
            share = missing / total
            fine = share <= missing_threshold
            counters.add(
                f"missing_values_{c}", F.when(fine, "WARNING").otherwise("ERROR"), fine, missing,
                missing_percentage=F.round(share, 6),
            )
    for c in rules["numeric"]:
        if c in types and c not in numeric:
            text = counters.count(F.col(c).try_cast("double").isNull())
            counters.add(f"data_type_{c}", "ERROR", False, text, F.lit(True), expected_type="numeric")
    for c, bounds in rules["ranges"].items():
        if c in types and is_numeric(types[c]):
            below, above = counters.count(F.col(c) < bounds["min"]), counters.count(F.col(c) > bounds["max"])
            counters.add(f"range_min_{c}", "ERROR", False, below, minimum=bounds["min"])
            counters.add(f"range_max_{c}", "ERROR", False, above, maximum=bounds["max"])
    for c in rules["positive"]:
        if c in types and is_numeric(types[c]):
            counters.add(f"positive_values_{c}", "ERROR", False, counters.count(F.col(c) < 0))
    for left, operator, right in rules["consistency"]:
        if left in types and right in types:
            a, b = F.col(left), F.col(right)
            broken = counters.count(a < b if operator == ">=" else a > b)
            word = "gte" if operator == ">=" else "lte"
            counters.add(f"consistency_{left}_{word}_{right}", "ERROR", False, broken)
    if s.time in types:
        counters.add("null_timestamps", "ERROR", False, counters.count(F.col(s.time).isNull()))
        future = counters.count(F.col(s.time).cast("timestamp") > now + F.expr("INTERVAL 1 DAY"))
        counters.add("future_timestamps", "WARNING", True, future)

    aggregates = [F.count(F.lit(1)).alias("_rows")]
    aggregates += [e.alias(name) for name, e in counters.aggregates.items()]
    for c in numeric:
        aggregates += [F.avg(c).alias(f"_mean_{c}"), F.stddev_samp(c).alias(f"_std_{c}"), F.count(c).alias(f"_n_{c}")]
    wide = pin(df.groupBy(*s.keys).agg(*aggregates))
    parts = [wide.select(*s.keys, F.inline(F.array_compact(F.array(*counters.results))))]

    unique = [c for c in rules["unique"] if c in types]
    # In the order of a series rows of the same time are neighbours.
    by_time = s.time in types and set(unique) - set(s.keys) == {s.time}
    if numeric or s.time in types:
        parts.append(_ordered(df, s, wide, numeric, unique if by_time else [], z_threshold, rows_per_chunk, s.time in types))
    if unique and not by_time:
        parts.append(_duplicates(df, s, unique))
    if s.time in types and SEQ in types:
        parts.append(_order(df, s, rows_per_chunk))
    return reduce(lambda a, b: a.unionByName(b), parts)


def _emit(df: DataFrame, s: Series, result: Column) -> DataFrame:
    return df.withColumn("_r", result).filter("_r.violations > 0").select(*s.keys, "_r.*")


def _repeats(count: Column, unique: Sequence[str]) -> Column:
    return _result("duplicate_records", "ERROR", False, count, columns=",".join(unique))


def _ordered(
    df: DataFrame, s: Series, wide: DataFrame, numeric: Sequence[str], unique: Sequence[str], threshold: float,
    rows_per_chunk: int, timed: bool,
) -> DataFrame:
    """Anomalies, members of repeated times and gaps of more than twice the median gap, per series.

    ``wide`` holds the moments and the length of every series, so neither is counted again.
    """
    moments = [f"{name}_{c}" for c in numeric for name in ("_mean", "_std", "_n")]
    rows = df.select(*dict.fromkeys([*s.keys, *(s.order if timed else ()), *numeric]))
    rows = join_on(rows, small(wide.select(*s.keys, *moments)), s.keys)
    flags = {}
    for c in numeric:
        usable = (F.col(f"_n_{c}") > 2) & (F.col(f"_std_{c}") > 0)
        z = F.when(usable, (F.col(c) - F.col(f"_mean_{c}")) / F.col(f"_std_{c}"))
        flags[c] = F.coalesce(F.abs(z) > threshold, F.lit(False)).alias(f"_a_{c}")
    rows = rows.select(*dict.fromkeys([*s.keys, *(s.order if timed else ())]), *flags.values())
    counted = [F.count_if(f"_a_{c}").alias(f"_a_{c}") for c in numeric]
    found = [_result(f"anomalies_{c}", "WARNING", True, F.col(f"_a_{c}"), z_score_threshold=threshold) for c in numeric]
    if timed:
        rows = _with_median(_with_neighbours(rows, s, wide, rows_per_chunk), s, wide)
        large = F.when(F.col("_gap") > 2 * F.col("_median"), F.col("_gap"))
        counted += [
            F.count_if("_repeat").alias("_repeats"), F.count(large).alias("_large"), F.sum(large).alias("_total"),
            F.max(large).alias("_largest"), F.max("_median").alias("_median"),
        ]
        found += [_repeats(F.col("_repeats"), unique)] if unique else []
        found.append(
            _result(
                "time_gaps", "WARNING", True, F.col("_large"),
                total_gap_seconds=F.round("_total", 3), median_seconds=F.round("_median", 3),
                largest_seconds=F.round("_largest", 3),
            )
        )
    return rows.groupBy(*s.keys).agg(*counted).select(*s.keys, F.inline(F.array(*found))).filter("violations > 0")


def _with_neighbours(rows: DataFrame, s: Series, wide: DataFrame, rows_per_chunk: int) -> DataFrame:
    """Seconds since the row before as ``_gap``, and whether a neighbour has the same time as ``_repeat``."""
    micros = F.unix_micros(F.col(s.time).cast("timestamp"))

    def steps(frame: DataFrame, part: Series) -> DataFrame:
        w = part.window()
        same = [f(F.lit(1)).over(w).isNotNull() & F.col(s.time).eqNullSafe(f(s.time).over(w)) for f in (F.lag, F.lead)]
        return frame.withColumns({"_gap": (micros - F.lag(micros).over(w)) / 1e6, "_repeat": same[0] | same[1]})

    if _longest(wide) <= rows_per_chunk:
        return steps(rows, s)
    return over_series(rows, s, steps, lookback=1, lookahead=1, rows_per_chunk=rows_per_chunk)


def _with_median(rows: DataFrame, s: Series, wide: DataFrame) -> DataFrame:
    """The median gap of the series; in the same shuffle as the gaps while the values of a series fit a buffer."""
    if _longest(wide) <= BUFFERED_ROWS:
        return rows.withColumn("_median", F.percentile("_gap", F.lit(0.5)).over(Window.partitionBy(*s.keys)))
    rows = stage(rows)
    medians = quantiles(rows.filter(F.col("_gap").isNotNull()).select(*s.keys, "_gap"), s.keys, {"_gap": [0.5]})
    return attach(rows, medians.withColumnRenamed("_gap_p50", "_median"), s.keys)


def _longest(wide: DataFrame) -> int:
    return wide.agg(F.max("_rows")).first()[0] or 0


def _duplicates(df: DataFrame, s: Series, unique: Sequence[str]) -> DataFrame:
    """All members of a duplicated key count, whatever its columns."""
    by = list(dict.fromkeys([*s.keys, *unique]))
    copies = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    total = copies.groupBy(*s.keys).agg(F.sum("_n").alias("_n"))
    return _emit(total, s, _repeats(F.col("_n"), unique))


def _order(df: DataFrame, s: Series, rows_per_chunk: int) -> DataFrame:
    """Rows whose time does not exceed that of the row delivered before them."""
    spaced = gaps_in_delivery(df, s, rows_per_chunk)
    late = spaced.groupBy(*s.keys).agg(F.count_if(F.col("gap") <= 0).alias("_n"))
    return _emit(late, s, _result("chronological_order", "WARNING", True, F.col("_n")))


def gaps_in_delivery(df: DataFrame, s: Series, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    micros = F.unix_micros(F.col(s.time).cast("timestamp"))
    delivered = Series(s.keys, SEQ)
    return over_series(
        df.select(*s.keys, s.time, SEQ),
        delivered,
        lambda frame, part: frame.withColumn("gap", (micros - F.lag(micros, 1).over(part.window())) / 1e6),
        lookback=1,
        rows_per_chunk=rows_per_chunk,
    )


def summary(checks: DataFrame, keys: Sequence[str], pass_rate: float = schemas.PASS_RATE) -> DataFrame:
    """Totals, counts by level, pass rate and validity per key."""
    by_level = [
        F.count_if((F.col("level") == level) & ~F.col("passed")).alias(f"failed_{level.lower()}")
        for level in ("WARNING", "ERROR", "CRITICAL")
    ]
    totals = checks.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_checks"), F.count_if("passed").alias("passed_checks"), *by_level
    )
    rate = F.when(F.col("total_checks") > 0, F.col("passed_checks") / F.col("total_checks")).otherwise(1.0)
    return totals.withColumn("pass_rate", rate).withColumn(
        "is_valid", (F.col("pass_rate") >= pass_rate) & (F.col("failed_critical") == 0)
    )


def filter_invalid(
    df: DataFrame, checks: DataFrame, kind: str, s: Series, rules: Mapping | None = None,
    pass_rate: float = schemas.PASS_RATE,
) -> DataFrame:
    """Drop the rows that fail a failed range, positivity or null-time check of an invalid series.

    As such a filter keeps only rows for which the comparison holds, nulls in a failed column go too.
    """
    return _judged(df, checks, kind, s, rules, pass_rate).filter(F.size("_broken") == 0).select(*df.columns)


def invalid_rows(
    df: DataFrame, checks: DataFrame, kind: str, s: Series, rules: Mapping | None = None,
    pass_rate: float = schemas.PASS_RATE,
) -> DataFrame:
    """The rows that ``filter_invalid`` drops, with the names of the checks they fail as ``failed_checks``."""
    judged = _judged(df, checks, kind, s, rules, pass_rate).filter(F.size("_broken") > 0)
    return judged.select(*df.columns, F.col("_broken").alias("failed_checks"))


def _judged(
    df: DataFrame, checks: DataFrame, kind: str, s: Series, rules: Mapping | None, pass_rate: float
) -> DataFrame:
    """The rows with the names of the failed checks because of which they may not be loaded, as ``_broken``."""
    rules = rules or schemas.VALIDATION[kind]
    types = dict(df.dtypes)
    failed = F.collect_set(
        F.when(~F.col("passed") & F.col("level").isin("ERROR", "CRITICAL"), F.col("check_name"))
    )  # at most one name per declared rule
    verdict = join_on(
        checks.groupBy(*s.keys).agg(failed.alias("_failed")),
        summary(checks, s.keys, pass_rate).select(*s.keys, "is_valid"),
        s.keys,
    )
    rows = attach(df, verdict, s.keys)
    broken = []

    def require(check: str, holds: Column) -> None:
        hit = F.array_contains("_failed", check)
        broken.append(F.when(F.coalesce(hit, F.lit(False)) & ~F.coalesce(holds, F.lit(False)), F.lit(check)))

    for c, bounds in rules["ranges"].items():
        if c in types and is_numeric(types[c]):
            require(f"range_min_{c}", F.col(c) >= bounds["min"])
            require(f"range_max_{c}", F.col(c) <= bounds["max"])
    for c in rules["positive"]:
        if c in types and is_numeric(types[c]):
            require(f"positive_values_{c}", F.col(c) >= 0)
    if s.time in types:
        require("null_timestamps", F.col(s.time).isNotNull())
    names = F.array_compact(F.array(*broken)) if broken else F.array().cast("array<string>")
    empty = F.array().cast("array<string>")
    return rows.withColumn("_broken", F.when(F.coalesce(F.col("is_valid"), F.lit(True)), empty).otherwise(names))


def validate(df: DataFrame, kind: str, s: Series, **options) -> tuple[DataFrame, DataFrame]:
    """(rows that may be loaded, check results). The results are pinned, as both outputs use them."""
    checks = pin(results(df, kind, s, **options))
    return filter_invalid(df, checks, kind, s, options.get("rules")), checks


def report(checks: DataFrame, keys: Sequence[str], as_json: bool = True) -> DataFrame:
    """One report line per check, as JSON or as text."""
    fields = [*keys, *RESULT_COLUMNS]
    if as_json:
        return checks.select(*keys, F.to_json(F.struct(*fields)).alias("report"))
    status = F.when(F.col("passed"), "PASS").otherwise("FAIL")
    line = F.format_string("[%s] %s: %s (%d)", F.col("level"), F.col("check_name"), status, F.col("violations"))
    return checks.select(*keys, line.alias("report"))


# --- declared row constraints --------------------------------------------------------------------


def failed_checks(table: str, columns: Sequence[str], checks: Mapping[str, str] | None = None) -> Column:
    """Names of the constraints a row breaks; a predicate that is null is not broken.

    Constraints over columns the table does not have are skipped.
    """
    checks = checks if checks is not None else schemas.TABLE_CHECKS[table]
    broken = []
    for name, predicate in checks.items():
        if _mentions(predicate) <= set(columns):
            holds = F.coalesce(F.expr(predicate), F.lit(True))
            broken.append(F.when(~holds, F.lit(name)))
    return F.array_compact(F.array(*broken)) if broken else F.array().cast("array<string>")


def _mentions(predicate: str) -> set[str]:
    words = re.findall(r"[a-z][a-z0-9_]*", re.sub(r"'[^']*'", "", predicate))
    return set(words) - {"coalesce"}


def quarantine(
    df: DataFrame, table: str, checks: Mapping[str, str] | None = None, not_null: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """(valid rows, invalid rows with the array ``failed_checks``). No shuffle, also on streams."""
    failed = failed_checks(table, df.columns, checks)
    nulls = [F.when(F.col(c).isNull(), F.lit(f"{c}_not_null")) for c in not_null]
    if nulls:
        failed = F.concat(failed, F.array_compact(F.array(*nulls)))
    tagged = df.withColumn("failed_checks", failed)
    ok = F.size("failed_checks") == 0
    return tagged.filter(ok).drop("failed_checks"), tagged.filter(~ok)


def metrics(checks: DataFrame, table: str, day: Column, threshold: float = schemas.PASS_RATE) -> DataFrame:
    """Check results in the shape of the quality-metrics table."""
    types = (
        F.when(F.col("check_name").rlike("^(missing|required|null|time_gaps)"), "completeness")
        .when(F.col("check_name").rlike("^(consistency|duplicate|chrono)"), "consistency")
        .when(F.col("check_name").startswith("future"), "timeliness")
        .otherwise("accuracy")
    )
    status = F.when(F.col("passed") & (F.col("level") == "WARNING"), "warn").when(F.col("passed"), "pass").otherwise("fail")
    return checks.select(
        F.lit(table).alias("table_name"), day.alias("check_date"), types.alias("check_type"),
        F.col("check_name").alias("metric_name"), F.col("violations").cast("double").alias("metric_value"),
        F.lit(threshold).alias("threshold"), status.alias("status"), F.col("detail").alias("details"),
    )


# --- run health ----------------------------------------------------------------------------------


def source_status(runs: DataFrame, source: str, started: str, failed: str) -> DataFrame:
    """Per source: runs, error rate, last success and failures in a row since then, with alerts.

    The streak is the number of failures after the last success, so it needs two small aggregates
    and no window over a source's whole history.
    """
    success = F.max(F.when(~F.col(failed), F.col(started)))
    status = runs.groupBy(source).agg(
        F.count(F.lit(1)).alias("runs"),
        F.avg(F.col(failed).cast("double")).alias("error_rate"),
        success.alias("_last"),
    )
    marked = join_on(runs, small(pin(status.select(source, "_last"))), [source])
    after = marked.filter(F.col("_last").isNull() | (F.col(started) > F.col("_last")))
    streaks = after.groupBy(source).agg(F.count_if(F.col(failed)).alias("_streak"))
    streak = F.coalesce(F.col("_streak"), F.lit(0)).cast("bigint")
    return join_on(status, streaks, [source]).select(
        source,
        "runs",
        "error_rate",
        F.col("_last").alias("last_success"),
        streak.alias("consecutive_failures"),
        (F.col("error_rate") > schemas.ERROR_RATE_ALERT).alias("high_error_rate"),
        (streak >= schemas.FAILURE_STREAK_ALERT).alias("failing"),
    )


def frequency_check(found: DataFrame, declared: Mapping[str, str], key: str) -> DataFrame:
    """Detected granularity against the declared one."""
    expected = lookup(key, declared)
    return found.withColumn("declared", expected).withColumn("matches", F.col("granularity") == expected)
