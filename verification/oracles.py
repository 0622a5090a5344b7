"""SQL that DuckDB runs on the given tables, one statement per registered query.

Written from the definitions, not from the Spark code: joins where the operators stack
and group, window functions where they count values, printf for rounding.
"""

from __future__ import annotations

from verification import views

CAUSES = ["carrier_delay", "weather_delay", "nas_delay", "security_delay", "late_aircraft_delay"]
# The phases of a timing log in order, and how reports name them.
PHASE_LABELS = {
    "spark_start_s": "Spark start",
    "loading_s": "Loading",
    "filtering_s": "Filtering",
    "computation_s": "Computation",
    "all_airlines_computation_s": "All-airlines computation",
    "top10_computation_s": "Top-10 computation",
    "computation_percentiles_s": "Percentiles computation",
    "computation_minmax_s": "Min/max computation",
    "output_s": "Output",
    "total_s": "Total",
    "wall_total_s": "Wall total",
    "end_to_end_s": "End-to-end",
    "spark_stop_s": "Spark stop",
}
PHASES, LABELS = list(PHASE_LABELS), list(PHASE_LABELS.values())
KEY = ["yr", "mon", "dom", "carrier", "flight_num", "origin_id", "dest_id", "crs_dep_time"]
LAYOUT = {
    "yr": "YEAR", "mon": "MONTH", "dom": "DAY_OF_MONTH", "carrier": "OP_UNIQUE_CARRIER",
    "flight_num": "OP_CARRIER_FL_NUM", "origin_id": "ORIGIN_AIRPORT_ID", "dest_id": "DEST_AIRPORT_ID",
}


def _with(body: str, *ctes: tuple[str, str]) -> str:
    parts = ",\n".join(f"{name} AS ({sql})" for name, sql in ctes)
    return f"WITH {parts}\n{body}"


RAW = ("flights_raw", views.FLIGHTS_RAW)
CLEAN = ("flights", views.FLIGHTS)


def _raw(body: str, *ctes) -> str:
    return _with(body, RAW, *ctes)


def _clean(body: str, *ctes) -> str:
    return _with(body, RAW, CLEAN, *ctes)


def _layout(column: str) -> str:
    return f'{column} AS "{LAYOUT.get(column, column.upper())}"'


def _printed(expression: str, digits: int) -> str:
    """Rounded on the exact binary value."""
    return f"CAST(printf('%.{digits}f', {expression}) AS DOUBLE)"


def _shown(expression: str) -> str:
    return f"CASE WHEN {expression} IS NULL THEN '—' ELSE printf('%.2f', {expression}) END"


PROCESSED = ", ".join(
    _layout(c)
    for c in ["yr", "mon", "dom", "carrier", "crs_dep_time", "dep_delay", "arr_delay", "cancelled", "diverted", *CAUSES]
)
CLEAN_ALL = _clean(f"SELECT {PROCESSED} FROM flights")

# --- the analyses ---

MONTHLY_SQL = """
SELECT mon AS month, carrier AS airline, count(*) AS total_flights,
  count(*) FILTER (WHERE cancelled = 1) AS cancelled_flights,
  count(*) FILTER (WHERE cancelled = 0) AS non_cancelled_flights,
  round(avg(dep_delay) FILTER (WHERE cancelled = 0), 4) AS dep_delay_mean,
  min(dep_delay) FILTER (WHERE cancelled = 0) AS dep_delay_min,
  max(dep_delay) FILTER (WHERE cancelled = 0) AS dep_delay_max,
  round(avg(arr_delay) FILTER (WHERE cancelled = 0), 4) AS arr_delay_mean,
  min(arr_delay) FILTER (WHERE cancelled = 0) AS arr_delay_min,
  max(arr_delay) FILTER (WHERE cancelled = 0) AS arr_delay_max,
  round(count(*) FILTER (WHERE cancelled = 1) / count(*) * 100.0E0, 4) AS cancellation_rate
FROM flights WHERE carrier IN ('AA', 'DL') GROUP BY mon, carrier
"""
MONTHLY = ("monthly", MONTHLY_SQL)
MONTHLY_METRICS = [
    "dep_delay_mean", "dep_delay_min", "dep_delay_max", "arr_delay_mean", "arr_delay_min", "arr_delay_max",
    "cancellation_rate",
]

CARRIERS_SQL = f"""
SELECT carrier, count(*) AS num_flights, round(avg(arr_delay), 4) AS arrdelay_mean,
  {", ".join(f"round(avg({c}), 4) AS {c}_mean" for c in CAUSES)}
FROM flights WHERE cancelled = 0 AND diverted = 0 AND arr_delay IS NOT NULL GROUP BY carrier
"""
CARRIERS = ("carriers", CARRIERS_SQL)
TOP = ("top", "SELECT * FROM carriers WHERE num_flights >= 500 ORDER BY arrdelay_mean DESC, carrier LIMIT 10")
CAUSE_MEANS = [f"{c}_mean" for c in CAUSES]
RANKED = (
    "ranked",
    "SELECT CAST(row_number() OVER (ORDER BY arrdelay_mean DESC, carrier) AS INT) AS rank, carrier, num_flights, "
    f"arrdelay_mean, {', '.join(CAUSE_MEANS)} FROM top",
)

DEPARTED = (
    "departed",
    "SELECT carrier AS airline, CAST(floor(crs_dep_time / 100) AS INT) AS hour, dep_delay FROM flights "
    "WHERE carrier IN ('AA', 'DL', 'UA', 'WN') AND cancelled = 0 AND dep_delay IS NOT NULL "
    "AND floor(crs_dep_time / 100) BETWEEN 0 AND 23",
)


def _percentiles(function: str) -> str:
    found = ", ".join(
        f"round({function}(dep_delay, {p}), 4) AS {n}"
        for p, n in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"), (0.9, "p90"))
    )
    return f"SELECT airline, hour, count(*) AS num_flights, {found} FROM departed GROUP BY airline, hour"


def _digest(source: str, keys: str) -> str:
    """Centroids in order, cut where the scale function of their middle rank passes a whole number."""
    return (
        f"SELECT {keys}, sum(total) AS total, CAST(sum(weight) AS BIGINT) AS weight, min(low) AS low, max(high) AS high FROM ("
        f"SELECT *, floor((asin(2 * least(greatest(middle / whole, 0.0E0), 1.0E0) - 1) / pi() + 0.5E0) * 100) AS unit FROM ("
        f"SELECT *, CAST(sum(weight) OVER (PARTITION BY {keys} ORDER BY total / weight, low, high, weight ROWS UNBOUNDED PRECEDING) AS DOUBLE) "
        f"- weight / 2.0E0 AS middle, CAST(sum(weight) OVER (PARTITION BY {keys}) AS DOUBLE) AS whole FROM {source}) a) b GROUP BY {keys}, unit"
    )


_DIGESTS = (
    (
        "q3_values",
        "SELECT carrier AS airline, CAST(floor(crs_dep_time / 100) AS INT) AS hour, mon, dep_delay * count(*) AS total, "
        "count(*) AS weight, dep_delay AS low, dep_delay AS high FROM flights WHERE carrier IN ('AA', 'DL', 'UA', 'WN') "
        "AND cancelled = 0 AND dep_delay IS NOT NULL AND floor(crs_dep_time / 100) BETWEEN 0 AND 23 GROUP BY 1, 2, 3, dep_delay",
    ),
    ("q3_monthly", _digest("q3_values", "airline, hour, mon")),
    ("q3_rolled", _digest("q3_monthly", "airline, hour")),
)


def _digest_read(source: str) -> str:
    def found(p: float, name: str) -> str:
        return (
            f"round(min(CASE WHEN {p}E0 * whole >= before AND {p}E0 * whole < place THEN mean_before + (mean - mean_before) * (({p}E0 * whole - before) / (place - before)) "
            f"WHEN ending AND {p}E0 * whole >= place THEN mean + (most - mean) * (({p}E0 * whole - place) / (whole - place)) END), 4) AS {name}"
        )

    names = ", ".join(found(p, n) for p, n in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"), (0.9, "p90")))
    return (
        f"SELECT airline, hour, CAST(max(whole) AS BIGINT) AS num_flights, {names} FROM (SELECT *, "
        "coalesce(lag(place) OVER o, 0.0E0) AS before, coalesce(lag(mean) OVER o, least_one) AS mean_before, lead(place) OVER o IS NULL AS ending "
        "FROM (SELECT *, total / weight AS mean, CAST(sum(weight) OVER (PARTITION BY airline, hour ORDER BY total / weight, low, high, weight "
        "ROWS UNBOUNDED PRECEDING) AS DOUBLE) - weight / 2.0E0 AS place, CAST(sum(weight) OVER g AS DOUBLE) AS whole, min(low) OVER g AS least_one, "
        f"max(high) OVER g AS most FROM {source} WINDOW g AS (PARTITION BY airline, hour)) a "
        "WINDOW o AS (PARTITION BY airline, hour ORDER BY mean, low, high, weight)) b GROUP BY airline, hour"
    )


HOURLY = ("hourly", _percentiles("quantile_disc"))
HOURLY_METRICS = ["num_flights", "p25", "p50", "p75", "p90"]
EXTREMES = (
    "extremes",
    "SELECT airline, min(dep_delay) AS min_delay, max(dep_delay) AS max_delay FROM departed GROUP BY airline",
)


def _tall(source: str, ids: str, metrics: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT {ids}, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM {source}" for m in metrics
    )


# --- quality ---

ALL_NULL = "(" + " AND ".join(f"{c} IS NULL" for c in CAUSES) + ")"
ANY_NULL = "(" + " OR ".join(f"{c} IS NULL" for c in CAUSES) + ")"
TOTAL = "(" + " + ".join(CAUSES) + ")"
BAD_CLOCK = (
    "(crs_dep_time IS NULL OR crs_dep_time < 0 OR crs_dep_time > 2400 "
    "OR ((crs_dep_time % 100) + 100) % 100 >= 60)"
)
BAND_TESTS = {"le_0": "{d} <= 0", "gt_0_lt_15": "{d} > 0 AND {d} < 15", "ge_15": "{d} >= 15"}


def _n(test: str) -> str:
    return f"count(*) FILTER (WHERE {test})"


STATUS_METRICS = {
    **{
        f"{flag}_{name}": _n(f"{flag} {test}")
        for flag in ("cancelled", "diverted")
        for name, test in (("0", "= 0"), ("1", "= 1"), ("null", "IS NULL"), ("other", "NOT IN (0, 1)"))
    },
    "cancelled_and_diverted": _n("cancelled = 1 AND diverted = 1"),
}
DELAY_METRICS = {
    "dep_delay_null_eligible": _n("cancelled = 0 AND dep_delay IS NULL"),
    "dep_delay_min": "min(dep_delay)",
    "dep_delay_max": "max(dep_delay)",
    "dep_delay_negative": _n("dep_delay < 0"),
    "arr_delay_null_eligible": _n("cancelled = 0 AND diverted = 0 AND arr_delay IS NULL"),
    "arr_delay_min": "min(arr_delay)",
    "arr_delay_max": "max(arr_delay)",
    "arr_delay_negative": _n("arr_delay < 0"),
}
BAND_METRICS = {
    f"{d}_{band}_{name}": _n(f"{test.format(d=d)}{extra}")
    for d in ("dep_delay", "arr_delay")
    for band, test in BAND_TESTS.items()
    for name, extra in (("total", ""), ("all_null", f" AND {ALL_NULL}"), ("any_null", f" AND {ANY_NULL}"))
}
CAUSE_METRICS = {
    f"{c}_{name}": _n(f"{c} {test}") for c in CAUSES for name, test in (("null", "IS NULL"), ("negative", "< 0"))
}
CLOCK_METRICS = {
    "crs_null": _n("crs_dep_time IS NULL"),
    "crs_negative": _n("crs_dep_time < 0"),
    "crs_above_2400": _n("crs_dep_time > 2400"),
    "crs_bad_minutes": _n("((crs_dep_time % 100) + 100) % 100 >= 60"),
    "crs_invalid": _n(BAD_CLOCK),
}


def _reconcile(name: str, late: str) -> dict[str, str]:
    known = f"{late} AND {TOTAL} IS NOT NULL"
    off = f"{known} AND abs({TOTAL} - arr_delay) > 1e-6"
    return {
        f"{name}_flights": _n(late),
        f"{name}_all_causes_null": _n(f"{late} AND {ALL_NULL}"),
        f"{name}_comparable": _n(known),
        f"{name}_equal": _n(f"{known} AND abs({TOTAL} - arr_delay) <= 1e-6"),
        f"{name}_differ": _n(off),
        f"{name}_less": _n(f"{known} AND {TOTAL} < arr_delay - 1e-6"),
        f"{name}_greater": _n(f"{known} AND {TOTAL} > arr_delay + 1e-6"),
        f"{name}_abs_diff_sum": f"sum(abs({TOTAL} - arr_delay)) FILTER (WHERE {off})",
        f"{name}_abs_diff_max": f"max(abs({TOTAL} - arr_delay)) FILTER (WHERE {off})",
    }


RECONCILE_METRICS = {**_reconcile("gt_0", "arr_delay > 0"), **_reconcile("ge_15", "arr_delay >= 15")}


def _columns(metrics: dict[str, str]) -> str:
    return "SELECT " + ", ".join(f"{sql} AS {name}" for name, sql in metrics.items()) + " FROM flights_raw"


def _reconcile_row(name: str) -> str:
    return (
        f"SELECT '{name}' AS threshold, {name}_flights AS flights, {name}_all_causes_null AS all_causes_null, "
        f"coalesce({name}_all_causes_null / nullif({name}_flights, 0) * 100.0E0, 0.0E0) AS all_causes_null_pct, "
        f"{name}_comparable AS comparable, {name}_equal AS equal, {name}_differ AS differ, {name}_less AS less, "
        f"{name}_greater AS greater, {name}_abs_diff_sum / nullif({name}_differ, 0) AS mean_abs_diff, "
        f"{name}_abs_diff_max AS max_abs_diff FROM r"
    )


def _band_row(delay: str, band: str) -> str:
    p = f"{delay}_{band}"
    return (
        f"SELECT '{delay.upper()}' AS delay, '{band}' AS band, {p}_total AS total, {p}_all_null AS all_causes_null, "
        f"{p}_any_null AS any_cause_null, "
        f"coalesce({p}_all_null / nullif({p}_total, 0) * 100.0E0, 0.0E0) AS all_causes_null_pct, "
        f"coalesce({p}_any_null / nullif({p}_total, 0) * 100.0E0, 0.0E0) AS any_cause_null_pct FROM b"
    )


PROFILE_METRICS = {
    "rows": "count(*)", **STATUS_METRICS, **DELAY_METRICS, **BAND_METRICS, **CAUSE_METRICS, **RECONCILE_METRICS,
    **CLOCK_METRICS,
}

EXAMPLE_TESTS = {
    "cancelled_and_diverted": ("cancelled = 1 AND diverted = 1", 5),
    "late_15_all_causes_null": (f"arr_delay >= 15 AND {ALL_NULL}", 5),
    "negative_causes": (" OR ".join(f"{c} < 0" for c in CAUSES), 5),
    "invalid_crs_dep_time": (BAD_CLOCK, 5),
    "cause_sum_differs": (f"arr_delay >= 15 AND abs({TOTAL} - arr_delay) > 1e-6", 5),
    "late_all_causes_null": (f"arr_delay > 0 AND {ALL_NULL}", 10),
}
EXAMPLE_COLUMNS = [*KEY, "cancelled", "diverted", "dep_delay", "arr_delay", *CAUSES]


def _example(name: str, test: str, k: int) -> str:
    columns = ", ".join(
        f'CAST({c} AS DOUBLE) AS "{c.upper()}"' if c in ("cancelled", "diverted") else _layout(c)
        for c in EXAMPLE_COLUMNS
    )
    order = ", ".join(f"{c} NULLS FIRST" for c in EXAMPLE_COLUMNS)
    total = TOTAL if name == "cause_sum_differs" else "CAST(NULL AS DOUBLE)"
    return (
        f"SELECT {columns}, '{name}' AS \"check\", {total} AS total_cause_delay, "
        f"{total} - arr_delay AS total_minus_arr_delay, "
        f"CAST(row_number() OVER (ORDER BY {order}) AS INT) AS position "
        f"FROM flights_raw WHERE {test} QUALIFY row_number() OVER (ORDER BY {order}) <= {k}"
    )


def _night(variant: str, test: str) -> str:
    order = "crs_dep_time, carrier, dep_delay NULLS FIRST, cancelled, diverted"
    return (
        'SELECT carrier AS "OP_UNIQUE_CARRIER", crs_dep_time AS "CRS_DEP_TIME", dep_delay AS "DEP_DELAY", '
        'cancelled AS "CANCELLED", diverted AS "DIVERTED", CAST(floor(crs_dep_time / 100) AS INT) AS "HOUR", '
        f"'{variant}' AS variant, CAST(row_number() OVER (ORDER BY {order}) AS INT) AS position FROM flights "
        f"WHERE carrier = 'WN' AND floor(crs_dep_time / 100) BETWEEN 0 AND 4 AND {test} "
        f"QUALIFY row_number() OVER (ORDER BY {order}) <= 100"
    )


# --- comparison: the second table changed in known ways ---

CHANGED = (
    "changed",
    f"""
SELECT CASE WHEN carrier = 'DL' THEN 'D2' ELSE carrier END AS carrier, num_flights,
  arrdelay_mean + CASE carrier WHEN 'UA' THEN 1.0E0 WHEN 'WN' THEN 1e-5 ELSE 0.0E0 END AS arrdelay_mean,
  {", ".join(CAUSE_MEANS)}
FROM carriers WHERE carrier <> 'AA'
""",
)
COPIES = ("copies", "SELECT 'OO' AS carrier, 2 AS n")

DIFF = _clean(
    """
SELECT l.carrier, CAST(NULL AS VARCHAR) AS "column", CAST(NULL AS VARCHAR) AS left_value, CAST(NULL AS VARCHAR) AS right_value, 'only_left' AS kind
FROM carriers l ANTI JOIN changed r ON l.carrier = r.carrier
UNION ALL
SELECT r.carrier, NULL, NULL, NULL, 'only_right' FROM changed r ANTI JOIN carriers l ON l.carrier = r.carrier
UNION ALL
SELECT l.carrier, NULL, '1', CAST(c.n AS VARCHAR), 'duplicate_right' FROM carriers l JOIN copies c ON l.carrier = c.carrier
UNION ALL
SELECT l.carrier, 'arrdelay_mean', CAST(l.arrdelay_mean AS VARCHAR), CAST(r.arrdelay_mean AS VARCHAR), 'value'
FROM carriers l JOIN changed r ON l.carrier = r.carrier
WHERE l.carrier NOT IN (SELECT carrier FROM copies)
  AND abs(l.arrdelay_mean - r.arrdelay_mean) > greatest(1e-4 * greatest(abs(l.arrdelay_mean), abs(r.arrdelay_mean)), 1e-4)
""",
    CARRIERS, CHANGED, COPIES,
)

# --- timing logs ---

TLOG = ("tlog", views.TLOG)
LOG = ("log", views.PHASE_LOG)
TEXT = ("textlog", views.TEXT_LOG)


def _stats(source: str, keys: str, digits: int | None = 3) -> str:
    def r(sql: str) -> str:
        return sql if digits is None else _printed(sql, digits)

    std = "coalesce(stddev_samp(time_s), 0.0E0)" if digits else "round(stddev_samp(time_s), 6)"
    return (
        f"SELECT {keys}, count(*) AS n, {r('avg(time_s)')} AS mean_s, {r(std)} AS std_s, "
        f"{r('quantile_cont(time_s, 0.5)')} AS median_s, {r('min(time_s)')} AS min_s, {r('max(time_s)')} AS max_s "
        f"FROM {source} WHERE time_s IS NOT NULL GROUP BY {keys}"
    )


STATS = ("stats", _stats("log", "worker_count, query, impl, phase"))
# How reports name the techniques, and their notes.
ALGORITHM = (
    "CASE WHEN impl = 'df' THEN 'Spark DataFrame' WHEN impl = 'rdd' AND query = 'Q3' THEN 'RDD + t-digest' "
    "WHEN impl = 'rdd' THEN 'Spark RDD' ELSE '' END"
)
NOTE = (
    "CASE phase WHEN 'end_to_end_s' THEN 'includes output' WHEN 'computation_percentiles_s' "
    "THEN 'Q3 percentile computation' WHEN 'computation_s' THEN 'main computation phase' ELSE '' END"
)
SLOT = "worker_count * 10 + CASE impl WHEN 'df' THEN 0 WHEN 'rdd' THEN 1 ELSE 9 END"


def _processing(source: str, keys: str, value: str) -> str:
    using = f"USING ({keys})"
    single = f"""
SELECT {keys}, 'processing_s' AS phase, phase AS source_phase, {value} FROM {source}
WHERE (phase = 'computation_s' AND (query = 'Q1' OR (query = 'Q2' AND impl = 'rdd')))
   OR (phase = 'computation_percentiles_s' AND query = 'Q3')
"""
    both = f"""
SELECT {keys}, 'processing_s' AS phase, 'all_airlines_computation_s+top10_computation_s' AS source_phase,
  a.{value} + b.{value} AS {value}
FROM (SELECT * FROM {source} WHERE phase = 'all_airlines_computation_s' AND query = 'Q2' AND impl = 'df') a
JOIN (SELECT * FROM {source} WHERE phase = 'top10_computation_s' AND query = 'Q2' AND impl = 'df') b {using}
"""
    return f"{single} UNION ALL {both}"


GROUP = "worker_count, query, impl"
PROCESSING = ("processing", _processing("stats", GROUP, "mean_s"))
GRID = (
    "grid",
    "SELECT q.query, i.impl FROM (VALUES ('Q1'), ('Q2'), ('Q3')) q(query), (VALUES ('df'), ('rdd')) i(impl)",
)
IMPL_LABEL = "CASE impl WHEN 'df' THEN 'DataFrame' ELSE 'RDD' END"

RUNS = (
    "runs",
    "SELECT worker_count, query, impl, iteration, phase, max(time_s) AS time_s FROM log "
    "GROUP BY worker_count, query, impl, iteration, phase",
)


def _compare(source: str, keys: str) -> str:
    return (
        f"SELECT {keys}, d.mean_s AS df_mean_s, r.mean_s AS rdd_mean_s, {_printed('r.mean_s - d.mean_s', 3)} AS delta_s, "
        "CASE WHEN r.mean_s > 0 THEN d.mean_s / r.mean_s ELSE CAST('inf' AS DOUBLE) END AS df_over_rdd, "
        "CASE WHEN r.mean_s > d.mean_s THEN 'df' WHEN r.mean_s < d.mean_s THEN 'rdd' ELSE 'equal' END AS faster "
        f"FROM (SELECT * FROM {source} WHERE impl = 'df') d JOIN (SELECT * FROM {source} WHERE impl = 'rdd') r USING ({keys})"
    )


def _direct(mode: str, source: str) -> str:
    values = ["mean_s", "std_s", "median_s", "min_s", "max_s"]
    plain = ", ".join(values)
    labels = {"spark_start_s": "Spark start", "loading_s": "Loading", "wall_total_s": "End-to-end", "spark_stop_s": "Spark stop"}
    parts = [
        f"SELECT query, '{label}' AS phase, {plain} FROM {source} WHERE phase = '{phase}'" for phase, label in labels.items()
    ]
    parts.append(f"SELECT query, 'Processing', {plain} FROM {source} WHERE phase = 'computation_s' AND query = 'Q1'")
    parts.append(
        "SELECT a.query, 'Processing', " + ", ".join(f"a.{v} + b.{v}" for v in values)
        + f" FROM {source} a JOIN {source} b ON a.query = b.query AND a.query = 'Q2' "
        "AND a.phase = 'all_airlines_computation_s' AND b.phase = 'top10_computation_s'"
    )
    parts.append(
        f"SELECT query, 'Processing', {plain} FROM {source} WHERE query = 'Q3' AND phase IN ('computation_s', "
        "'computation_percentiles_s') QUALIFY row_number() OVER (PARTITION BY query ORDER BY phase DESC) = 1"
    )
    # 'computation_s' sorts after 'computation_percentiles_s', so it is preferred.
    texts = ", ".join(f"{_shown(v)} AS {v.removesuffix('_s')}" for v in values)
    return f"SELECT query, phase, '{mode}' AS mode, {texts} FROM ({' UNION ALL '.join(parts)}) p"


def _case(column: str, values: list, otherwise: str) -> str:
    whens = " ".join(f"WHEN '{p}' THEN {v}" for p, v in zip(PHASES, values))
    return f"CASE {column} {whens} ELSE {otherwise} END"


_TEXT_NUMBER = "TRY_CAST(trim({c}) AS DOUBLE)"


def all_sql() -> dict[str, str]:
    sql: dict[str, str] = {}

    raw_columns = {
        "YEAR": "yr", "MONTH": "mon", "DAY_OF_MONTH": "dom", "OP_UNIQUE_CARRIER": "carrier",
        "OP_CARRIER_FL_NUM": "flight_num", "ORIGIN_AIRPORT_ID": "origin_id",
        "ORIGIN_CITY_MARKET_ID": "CAST(NULL AS INT)", "ORIGIN_STATE_ABR": "CAST(NULL AS VARCHAR)",
        "DEST_AIRPORT_ID": "dest_id", "DEST_CITY_MARKET_ID": "CAST(NULL AS INT)",
        "DEST_STATE_ABR": "CAST(NULL AS VARCHAR)", "CRS_DEP_TIME": "crs_dep_time", "DEP_TIME": "CAST(NULL AS DOUBLE)",
        "DEP_DELAY": "dep_delay", "CRS_ARR_TIME": "CAST(NULL AS INT)", "ARR_TIME": "CAST(NULL AS DOUBLE)",
        "ARR_DELAY": "arr_delay", "CANCELLED": "CAST(cancelled AS DOUBLE)",
        "CANCELLATION_CODE": "CAST(NULL AS VARCHAR)", "DIVERTED": "CAST(diverted AS DOUBLE)",
        "ACTUAL_ELAPSED_TIME": "CAST(NULL AS DOUBLE)", "DISTANCE": "CAST(NULL AS DOUBLE)",
        **{c.upper(): c for c in CAUSES},
    }
    sql["csv_roundtrip"] = _raw(
        "SELECT " + ", ".join(f'{e} AS "{n}"' for n, e in raw_columns.items()) + " FROM flights_raw"
    )
    by_name = PROCESSED.replace("cancelled AS", "CAST(cancelled AS DOUBLE) AS").replace(
        "diverted AS", "CAST(diverted AS DOUBLE) AS"
    )
    sql["csv_by_name"] = _raw(f"SELECT {by_name} FROM flights_raw")
    sql["result_readback"] = _clean(
        "SELECT "
        + ", ".join(
            f"CAST({c} AS VARCHAR) AS {c}" for c in ["carrier", "num_flights", "arrdelay_mean", *CAUSE_MEANS]
        )
        + " FROM carriers",
        CARRIERS,
    )
    sql["csv_one_file"], sql["csv_by_name_mixed"] = sql["csv_roundtrip"], sql["csv_by_name"]
    for name in ("clean_flights", "ingest_filter", "ingest_incremental", "ingest_when_complete", "parquet_roundtrip"):
        sql[name] = CLEAN_ALL
    sql["output_ready"] = _clean(
        "SELECT 'processed' AS output, count(*) AS rows, count(*) > 0 AS ready FROM flights "
        "UNION ALL SELECT 'monthly', count(*), count(*) > 0 FROM monthly",
        MONTHLY,
    )
    q1_values = (
        "SELECT 'q1:metric:' || metric || ':' || airline AS key, CAST(month AS VARCHAR) AS field, value "
        f"FROM ({_tall('monthly', 'month, airline', MONTHLY_METRICS)}) t"
    )
    q3_minmax_values = (
        "SELECT 'q3:metric:' || metric AS key, airline AS field, value "
        f"FROM ({_tall('extremes', 'airline', ['min_delay', 'max_delay'])}) t"
    )
    sql["feed_republish"] = _clean(
        f"SELECT *, 'q1' AS feed FROM ({q1_values}) a UNION ALL SELECT *, 'q3' FROM ({q3_minmax_values}) b",
        MONTHLY, DEPARTED, EXTREMES,
    )
    sql["feed_versions"] = sql["feed_republish"]
    coerced = _TEXT_NUMBER.format(c="time_s")
    workers = f"CAST(trunc({_TEXT_NUMBER.format(c='worker_count')}) AS BIGINT)"
    sql["dq_coerce"] = _with(
        f"SELECT event_id, {coerced} AS time_value, coalesce({coerced}, 0.0E0) AS time_or_zero, "
        f"{workers} AS workers, coalesce({workers}, 0) AS workers_or_zero, event_id * 3000000000 AS large FROM textlog",
        TEXT,
    )
    sql["hhmm_hour"] = _raw(
        "SELECT crs_dep_time, CAST(floor(crs_dep_time / 100) AS INT) AS hour, "
        "((crs_dep_time % 100) + 100) % 100 >= 60 AS bad_minutes, count(*) AS flights "
        "FROM flights_raw GROUP BY crs_dep_time"
    )

    sql["q1_monthly_stats"] = _clean("SELECT * FROM monthly", MONTHLY)
    sql["q1_via_join"] = _clean(
        f"SELECT month, airline, {', '.join(MONTHLY_METRICS)} FROM monthly "
        "WHERE dep_delay_mean IS NOT NULL AND arr_delay_mean IS NOT NULL",
        MONTHLY,
    )
    sql["q2_carrier_stats"] = _clean("SELECT * FROM carriers", CARRIERS)
    sql["q2_top10"] = _clean("SELECT * FROM top", CARRIERS, TOP)
    for name in ("q3_hourly_percentiles", "q3_hourly_percentiles_approx"):
        sql[name] = _clean("SELECT * FROM hourly", DEPARTED, HOURLY)
    sql["q3_exact_interp"] = _clean(_percentiles("quantile_cont"), DEPARTED)
    sql["q3_minmax"] = _clean("SELECT * FROM extremes", DEPARTED, EXTREMES)
    sql["q3_sketch_ranks"] = _clean(
        "SELECT airline, hour, count(*) AS num_flights, TRUE AS p25_ok, TRUE AS p50_ok, TRUE AS p75_ok, "
        "TRUE AS p90_ok FROM departed GROUP BY airline, hour",
        DEPARTED,
    )
    sql["q3_digest_ranks"] = sql["q3_sketch_ranks"]
    sql["q3_sketch"] = _clean(_digest_read("q3_rolled"), *_DIGESTS)
    sql["carrier_hourly_status"] = _clean(
        "SELECT CAST(floor(crs_dep_time / 100) AS INT) AS hour, count(*) AS total_flights, "
        f"{_n('cancelled = 1')} AS cancelled, {_n('cancelled = 0')} AS not_cancelled, "
        f"{_n('dep_delay IS NULL')} AS dep_delay_null FROM flights WHERE carrier = 'WN' GROUP BY 1"
    )
    sql["night_flights"] = _clean(
        " UNION ALL ".join(
            f"SELECT * FROM ({_night(v, t)}) t"
            for v, t in (
                ("all", "TRUE"), ("not_cancelled", "cancelled = 0"),
                ("with_delay", "cancelled = 0 AND dep_delay IS NOT NULL"),
            )
        )
    )
    sql["crs_time_range"] = _clean(
        "SELECT min(crs_dep_time) AS min_crs_dep_time, max(crs_dep_time) AS max_crs_dep_time "
        "FROM flights WHERE carrier = 'WN'"
    )

    sql["dq_status"] = _raw(_columns(STATUS_METRICS))
    sql["dq_delays"] = _raw(_columns(DELAY_METRICS))
    sql["dq_hhmm"] = _raw(_columns(CLOCK_METRICS))
    sql["dq_delay_bands"] = _raw(
        " UNION ALL ".join(_band_row(d, b) for d in ("dep_delay", "arr_delay") for b in BAND_TESTS),
        ("b", _columns(BAND_METRICS)),
    )
    sql["dq_cause_nulls"] = _raw(
        " UNION ALL ".join(
            f"SELECT '{c.upper()}' AS cause, {_n(f'{c} IS NULL')} AS nulls, {_n(f'{c} < 0')} AS negatives FROM flights_raw"
            for c in CAUSES
        )
    )
    sql["dq_cause_reconcile"] = _raw(
        f"{_reconcile_row('gt_0')} UNION ALL {_reconcile_row('ge_15')}", ("r", _columns(RECONCILE_METRICS))
    )
    sql["dq_missing_causes"] = _raw(
        'SELECT mon AS "MONTH", CAST(grouping(mon) AS INT) AS is_total, count(*) AS total_rows, '
        f"{_n('arr_delay > 0')} AS positive_delay_rows, {_n(f'arr_delay > 0 AND {ALL_NULL}')} AS all_causes_null, "
        f"{_n(f'arr_delay > 0 AND NOT {ALL_NULL}')} AS at_least_one_cause, "
        f"coalesce({_n(f'arr_delay > 0 AND {ALL_NULL}')} / nullif({_n('arr_delay > 0')}, 0) * 100.0E0, 0.0E0) "
        "AS all_causes_null_pct FROM flights_raw GROUP BY ROLLUP (mon)"
    )
    sql["dq_row_counts"] = _raw(
        "SELECT 'month' AS dimension, CAST(mon AS VARCHAR) AS value, count(*) AS rows, mon NOT IN (1, 2, 3, 4) AS unexpected "
        "FROM flights_raw WHERE mon IS NOT NULL GROUP BY mon "
        "UNION ALL SELECT 'carrier', coalesce(carrier, 'NULL'), count(*), FALSE FROM flights_raw GROUP BY 2 "
        "UNION ALL SELECT 'total', 'all', count(*), FALSE FROM flights_raw"
    )
    sql["dq_duplicates"] = _raw(
        "SELECT count(*) AS duplicate_groups, CAST(coalesce(sum(n), 0) AS BIGINT) AS rows_in_groups FROM "
        f"(SELECT count(*) AS n FROM flights_raw GROUP BY {', '.join(KEY)} HAVING count(*) > 1) d"
    )
    sql["dq_examples"] = _raw(
        " UNION ALL ".join(f"SELECT * FROM ({_example(n, t, k)}) e" for n, (t, k) in EXAMPLE_TESTS.items())
    )
    sql["dq_profile"] = _raw(
        " UNION ALL ".join(
            f"SELECT '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM p" for m in PROFILE_METRICS
        ),
        ("p", _columns(PROFILE_METRICS)),
    )
    sql["dq_number_texts"] = _clean(
        "SELECT carrier, replace(format('{:,}', count(*)), ',', '.') AS flights_text, "
        "translate(format('{:,.2f}', sum(arr_delay)), ',.', '.,') AS minutes_text FROM flights GROUP BY carrier"
    )

    sql["result_diff"] = DIFF
    sql["result_key_sets"] = _clean(
        "SELECT coalesce(l.carrier, r.carrier) AS carrier, CASE WHEN r.carrier IS NULL THEN 'only_left' "
        "WHEN l.carrier IS NULL THEN 'only_right' ELSE 'both' END AS membership "
        "FROM carriers l FULL JOIN changed r ON l.carrier = r.carrier",
        CARRIERS, CHANGED,
    )
    sql["result_order"] = _clean(
        "SELECT CAST(l.rank AS VARCHAR) AS rank, 'key' AS \"column\", l.carrier AS left_value, r.carrier AS right_value, "
        "'order' AS kind FROM ranked l JOIN ranked r ON r.rank = CASE l.rank WHEN 2 THEN 3 WHEN 3 THEN 2 END",
        CARRIERS, TOP, RANKED,
    )

    sql["feed_q1_rows"] = _clean(
        "SELECT 'q1:row:' || airline || ':' || CAST(month AS VARCHAR) AS key, month, airline, "
        f"{', '.join(MONTHLY_METRICS)} FROM monthly",
        MONTHLY,
    )
    sql["feed_q1_values"] = _clean(q1_values, MONTHLY)
    sql["feed_q1_series"] = _clean(
        "SELECT 'q1:ts:' || metric || ':' || airline AS key, metric, airline, "
        "make_timestamp(2025, month, 1, 0, 0, 0) AS ts, value "
        f"FROM ({_tall('monthly', 'month, airline', MONTHLY_METRICS)}) t",
        MONTHLY,
    )
    sql["feed_q1_wide"] = _clean(
        "SELECT make_timestamp(2025, month, 1, 0, 0, 0) AS ts, max(dep_delay_mean) FILTER (WHERE airline = 'AA') AS \"AA\", "
        "max(dep_delay_mean) FILTER (WHERE airline = 'DL') AS \"DL\", "
        "strftime(make_timestamp(2025, month, 1, 0, 0, 0), '%b') AS label FROM monthly GROUP BY month",
        MONTHLY,
    )
    ranked = (CARRIERS, TOP, RANKED)
    sql["feed_q2_ranked"] = _clean("SELECT 'q2:row:' || CAST(rank AS VARCHAR) AS key, * FROM ranked", *ranked)
    all_causes = f"({' + '.join(CAUSE_MEANS)})"
    minutes = " UNION ALL ".join(
        f"SELECT rank, carrier, '{c}' AS cause, {c} AS minutes, CASE WHEN {all_causes} > 0 "
        f"THEN {_printed(f'{c} / {all_causes} * 100.0E0', 4)} ELSE 0.0E0 END AS share_pct FROM ranked"
        for c in CAUSE_MEANS
    )
    sql["feed_cause_share"] = _clean(minutes, *ranked)
    sql["feed_q2_values"] = _clean(
        " UNION ALL ".join(
            f"SELECT 'q2:metric:{m}' AS key, CAST(rank AS VARCHAR) AS field, CAST({m} AS VARCHAR) AS value FROM ranked"
            for m in ("carrier", "num_flights", "arrdelay_mean")
        )
        + " UNION ALL SELECT 'q2:metric:cause_abs:' || cause, CAST(rank AS VARCHAR), CAST(minutes AS VARCHAR) FROM shares"
        " UNION ALL SELECT 'q2:metric:cause_pct:' || cause, CAST(rank AS VARCHAR), CAST(share_pct AS VARCHAR) FROM shares",
        *ranked, ("shares", minutes),
    )
    sql["feed_q3_rows"] = _clean(
        "SELECT 'q3:row:hourly:' || airline || ':' || CAST(hour AS VARCHAR) AS key, * FROM hourly", DEPARTED, HOURLY
    )
    q3_tall = _tall("hourly", "airline, hour", HOURLY_METRICS)
    sql["feed_q3_values"] = _clean(
        "SELECT 'q3:metric:' || metric || ':' || airline AS key, CAST(hour AS VARCHAR) AS field, value "
        f"FROM ({q3_tall}) t",
        DEPARTED, HOURLY,
    )
    sql["feed_q3_series"] = _clean(
        "SELECT 'q3:ts:' || metric || ':' || airline AS key, metric, airline, "
        f"make_timestamp(2025, 1, 1, hour, 0, 0) AS ts, value FROM ({q3_tall}) t",
        DEPARTED, HOURLY,
    )
    sql["feed_q3_wide"] = _clean(
        "SELECT make_timestamp(2025, 1, 1, hour, 0, 0) AS ts, "
        + ", ".join(f"max(p90) FILTER (WHERE airline = '{a}') AS \"{a}\"" for a in ("AA", "DL", "UA", "WN"))
        + " FROM hourly GROUP BY hour",
        DEPARTED, HOURLY,
    )
    sql["feed_q3_minmax"] = _clean("SELECT 'q3:minmax:' || airline AS key, * FROM extremes", DEPARTED, EXTREMES)
    sql["feed_last_wins"] = (
        "SELECT event_type, date_trunc('hour', ts) AS ts, value, event_id FROM events "
        "QUALIFY row_number() OVER (PARTITION BY event_type, date_trunc('hour', ts) ORDER BY event_id DESC) = 1"
    )
    sql["feed_upsert"] = sql["feed_last_wins"]
    sql["feed_json_rows"] = _with(
        'SELECT worker_count AS "Worker Count", query AS "Query", impl AS "Format", phase AS "Phase", n AS "Iterations", '
        'mean_s AS "Mean", std_s AS "Std Dev", median_s AS "Median", min_s AS "Min", max_s AS "Max" FROM stats',
        LOG, STATS,
    )

    sql["bench_normalise"] = _with(
        f"SELECT *, {ALGORITHM} AS algorithm, {NOTE} AS note FROM ("
        f"SELECT CAST({workers} AS INT) AS worker_count, upper(trim(query)) AS query, lower(trim(impl)) AS impl, trim(phase) AS phase, "
        "coalesce(CAST(coalesce(nullif(trim(iteration), ''), nullif(trim(iteration_idx), ''), nullif(trim(run), '')) AS BIGINT), 0) "
        f"AS iteration, {coerced} AS time_s FROM textlog) t WHERE worker_count IS NOT NULL AND time_s IS NOT NULL",
        TEXT,
    )
    sql["bench_normalise_stats"] = _with(
        "SELECT worker_count, query, impl, phase, n, mean_s, std_s, median_s, min_s, max_s, "
        f"{ALGORITHM} AS algorithm, {NOTE} AS note FROM stats",
        LOG, STATS,
    )
    sql["bench_stats"] = _with(_stats("tlog", "worker_count, query, impl, phase"), TLOG)
    sql["bench_report"] = _with(
        "SELECT *, CASE WHEN query = 'Q3' AND impl = 'df' THEN 'percentile_approx (Greenwald-Khanna, Spark native)' "
        "WHEN query = 'Q3' THEN 't-digest (aggregateByKey, merge sul driver)' WHEN impl = 'df' THEN 'groupBy+agg' "
        "ELSE 'combineByKey' END AS algorithm, 20 AS total_iterations, 5 AS warmup_iterations, 15 AS valid_iterations, "
        "CASE WHEN phase IN ('output_s', 'end_to_end_s') THEN 'includes_output' ELSE 'computation_only' END AS note FROM stats",
        LOG, STATS,
    )
    sql["bench_stats_raw"] = _with(_stats("tlog", "worker_count, query, impl, phase", None), TLOG)
    sql["bench_boxstats"] = _with(
        f"SELECT make_timestamp(2025, 1, 1, 0, 0, 0) + to_minutes({SLOT}) AS time, query, worker_count, impl, "
        f"CAST(worker_count AS VARCHAR) || 'W ' || impl AS \"group\", {SLOT} AS group_order, count(*) AS n, "
        "min(time_s) AS min_s, quantile_cont(time_s, 0.25) AS q1_s, quantile_cont(time_s, 0.5) AS median_s, "
        "quantile_cont(time_s, 0.75) AS q3_s, max(time_s) AS max_s FROM tlog "
        "WHERE phase = 'end_to_end_s' AND query IN ('Q1', 'Q2', 'Q3') GROUP BY query, worker_count, impl",
        TLOG,
    )
    sql["bench_box_rows"] = _with(
        "SELECT *, CAST(group_order AS VARCHAR) || ':' || CAST(iteration AS VARCHAR) || ':' || CAST(\"index\" AS VARCHAR) AS field "
        "FROM (SELECT query, worker_count, impl, run_id AS iteration, time_s, "
        f"CAST(worker_count AS VARCHAR) || 'W ' || impl AS \"group\", {SLOT} AS group_order, "
        f"row_number() OVER (PARTITION BY query ORDER BY {SLOT}, run_id, time_s) - 1 AS \"index\" "
        "FROM tlog WHERE phase = 'end_to_end_s') t",
        TLOG,
    )
    sql["bench_warmup_drop"] = _with(
        "SELECT worker_count, query, impl, phase, run_id, time_s, place - 5 AS iteration FROM "
        "(SELECT *, dense_rank() OVER (PARTITION BY worker_count, query, impl ORDER BY run_id) AS place "
        "FROM (SELECT * REPLACE (run_id // 60 AS run_id) FROM tlog) r) t WHERE place > 5",
        TLOG,
    )
    sql["bench_union"] = _with(
        "SELECT worker_count, query, impl, phase, CASE WHEN impl = 'df' THEN run_id END AS run_id, time_s FROM tlog", TLOG
    )
    sql["bench_workers"] = _with("SELECT DISTINCT worker_count FROM tlog", TLOG)
    sql["bench_processing"] = _with("SELECT * FROM processing", LOG, STATS, PROCESSING)
    sql["bench_processing_runs"] = _with(_processing("runs", f"{GROUP}, iteration", "time_s"), LOG, RUNS)
    sql["bench_processing_join"] = _with(
        f"SELECT {GROUP}, mean_s FROM processing WHERE query = 'Q2' AND impl = 'df'", LOG, STATS, PROCESSING
    )
    sql["bench_total"] = _with(
        f"SELECT {GROUP}, iteration, {_printed('sum(time_s)', 3)} AS total_s FROM log "
        f"WHERE phase IN ('loading_s', 'filtering_s', 'computation_s') GROUP BY {GROUP}, iteration",
        LOG,
    )
    sql["bench_compare"] = _with(_compare("stats", "worker_count, query, phase"), LOG, STATS)
    sql["bench_compare_phases"] = _with(
        _compare("s", "query, phase")
        + " WHERE phase IN ('loading_s', 'filtering_s', 'computation_s', 'computation_percentiles_s', "
        "'computation_minmax_s', 'output_s', 'end_to_end_s')",
        LOG, ("s", _stats("log", "query, impl, phase")),
    )
    sql["bench_cold_vs_warm"] = _with(
        f"{_direct('cold start', 'cold')} UNION ALL {_direct('warmup', 'warm')}",
        LOG,
        ("cold", _stats("(SELECT * FROM log WHERE impl = 'df')", "query, phase")),
        ("warm", _stats("(SELECT * FROM log WHERE impl = 'rdd')", "query, phase")),
    )
    sql["bench_phase_order"] = _with(
        "SELECT CAST(substr(query, 2) AS INT) AS query_order, "
        f"{_case('phase', list(range(13)), '999')} AS phase_order, query, "
        f"{_case('phase', [repr(v) for v in LABELS], 'phase')} AS phase, CAST(n AS VARCHAR) AS n, "
        + ", ".join(f"{_shown(v)} AS {v.removesuffix('_s')}" for v in ("mean_s", "std_s", "median_s", "min_s", "max_s"))
        + " FROM s",
        LOG, ("s", _stats("log", "query, phase")),
    )
    stages = ["loading_s", "filtering_s", "processing_s", "output_s", "end_to_end_s"]
    sql["bench_phase_breakdown"] = _with(
        f"SELECT g.query, {IMPL_LABEL.replace('impl', 'g.impl')} AS impl, "
        + ", ".join(
            _shown(f"max(a.mean_s) FILTER (WHERE a.phase = '{s}')") + f" AS {s.removesuffix('_s')}" for s in stages
        )
        + " FROM grid g LEFT JOIN (SELECT query, impl, phase, mean_s FROM stats WHERE worker_count = 2 UNION ALL "
        "SELECT query, impl, phase, mean_s FROM processing WHERE worker_count = 2) a USING (query, impl) "
        "GROUP BY g.query, g.impl",
        LOG, STATS, PROCESSING, GRID,
    )
    sql["bench_scaling_table"] = _with(
        f"SELECT g.query, {IMPL_LABEL.replace('impl', 'g.impl')} AS impl, "
        + ", ".join(
            f"coalesce(max(printf('%.2f ± %.2f', s.mean_s, s.std_s)) FILTER (WHERE s.worker_count = {w}), '—') AS \"{w}W\""
            for w in (1, 2, 3, 4)
        )
        + " FROM grid g LEFT JOIN (SELECT * FROM stats WHERE phase = 'end_to_end_s') s USING (query, impl) "
        "GROUP BY g.query, g.impl",
        LOG, STATS, GRID,
    )
    for name, source, phase, ctes in (
        ("bench_wide_line", "stats", "end_to_end_s", (LOG, STATS)),
        ("bench_wide_line_processing", "processing", "processing_s", (LOG, STATS, PROCESSING)),
    ):
        sql[name] = _with(
            "SELECT query, worker_count, max(mean_s) FILTER (WHERE impl = 'df') AS df, "
            f"max(mean_s) FILTER (WHERE impl = 'rdd') AS rdd, '{phase}' AS display_phase FROM {source} "
            f"WHERE phase = '{phase}' GROUP BY query, worker_count",
            *ctes,
        )
    sql["bench_missing"] = _with(
        "SELECT w.worker_count, g.query, g.impl, p.phase, coalesce(s.n, 0) AS n, "
        "CASE WHEN coalesce(s.n, 0) = 0 THEN 'missing' ELSE 'few' END AS finding "
        "FROM (SELECT DISTINCT worker_count FROM tlog WHERE phase = 'end_to_end_s') w CROSS JOIN grid g "
        "CROSS JOIN (VALUES ('end_to_end_s'), ('processing_s')) p(phase) "
        "LEFT JOIN (SELECT worker_count, query, impl, phase, count(*) AS n FROM tlog GROUP BY ALL) s "
        "USING (worker_count, query, impl, phase) WHERE coalesce(s.n, 0) < 5",
        TLOG, GRID,
    )
    sql["dq_running"] = sql["dq_profile"]
    return sql
