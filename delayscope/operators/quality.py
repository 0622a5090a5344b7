"""Data-quality checks of raw flight records.

The checks are counters over a fixed list of yes/no questions about a record. A single
report counts them straight from the records. ``quality_profile`` evaluates every counter
of every report: it packs the answers of a record into one integer, counts records per
distinct integer (a few hundred, combined on the map side) and works out the counters
from those. Only the duplicate audit has to move anything per record.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from delayscope.functions import all_null, percent
from delayscope.operators.ranking import first_k
from delayscope.schema import CAUSES, FLAGS, FLIGHT_KEY

SUM_TOLERANCE = 1e-6
EXPECTED_MONTHS = (1, 2, 3, 4)
DELAYS = ["DEP_DELAY", "ARR_DELAY"]
GAP = "_gap"
CLOCK_FAULTS = ["null", "negative", "above_2400", "bad_minutes"]


_TOTAL = " + ".join(CAUSES)
_GAP = f"({_TOTAL} - ARR_DELAY)"
_ALL_NULL = "(" + " AND ".join(f"{cause} IS NULL" for cause in CAUSES) + ")"
_BAD_CLOCK = (
    "(CRS_DEP_TIME IS NULL OR CRS_DEP_TIME < 0 OR CRS_DEP_TIME > 2400 OR pmod(CRS_DEP_TIME, 100) >= 60)"
)
_BANDS = {"le_0": "{0} <= 0", "gt_0_lt_15": "({0} > 0 AND {0} < 15)", "ge_15": "{0} >= 15"}


def questions() -> dict[str, str]:
    """Every yes/no question about a record that some counter asks, as a SQL condition."""
    asked = {}
    for flag in FLAGS:
        name = flag.lower()
        asked |= {
            f"{name}_0": f"{flag} = 0",
            f"{name}_1": f"{flag} = 1",
            f"{name}_null": f"{flag} IS NULL",
            f"{name}_other": f"{flag} NOT IN (0, 1)",
        }
    for delay in DELAYS:
        name = delay.lower()
        asked |= {f"{name}_null": f"{delay} IS NULL", f"{name}_negative": f"{delay} < 0"}
        asked |= {f"{name}_{band}": test.format(delay) for band, test in _BANDS.items()}
    for cause in CAUSES:
        asked |= {f"{cause.lower()}_null": f"{cause} IS NULL", f"{cause.lower()}_negative": f"{cause} < 0"}
    return asked | {
        "causes_equal": f"abs({_GAP}) <= {SUM_TOLERANCE}D",
        "causes_less": f"{_GAP} < -{SUM_TOLERANCE}D",
        "causes_greater": f"{_GAP} > {SUM_TOLERANCE}D",
        "crs_null": "CRS_DEP_TIME IS NULL",
        "crs_negative": "CRS_DEP_TIME < 0",
        "crs_above_2400": "CRS_DEP_TIME > 2400",
        "crs_bad_minutes": "pmod(CRS_DEP_TIME, 100) >= 60",
    }


class Records:
    """Counters over the records themselves."""

    def __init__(self, raw: DataFrame):
        self.frame = raw.selectExpr("*", f"abs({_GAP}) AS {GAP}")
        self._asked = questions()

    def holds(self, question: str) -> str:
        return f"coalesce({self._asked[question]}, false)"

    def count(self, test: str = "true") -> str:
        return f"count_if({test})"

    def total(self, test: str, column: str) -> str:
        return f"sum({column}) FILTER (WHERE {test})"

    def largest(self, column: str, test: str = "true") -> str:
        return f"max({column}) FILTER (WHERE {test})"

    def smallest(self, column: str) -> str:
        return f"min({column})"


class AnswerCounts:
    """The same counters over records counted by their answers (and columns ``by``)."""

    def __init__(self, raw: DataFrame, by: Sequence[str] = ()):
        asked = questions()
        self._bit = {name: 1 << place for place, name in enumerate(asked)}
        packed = " + ".join(f"if({test}, {self._bit[name]}L, 0L)" for name, test in asked.items())
        measured = [*DELAYS, GAP]
        self.frame = (
            raw.selectExpr(
                *by, f"{packed} AS _answers", *DELAYS, f"if(abs({_GAP}) > {SUM_TOLERANCE}D, abs({_GAP}), null) AS {GAP}"
            )
            .groupBy(*by, "_answers")
            .agg(
                F.count(F.lit(1)).alias("_n"),
                *(F.min(c).alias(f"{c}_min") for c in measured),
                *(F.max(c).alias(f"{c}_max") for c in measured),
                F.sum(GAP).alias(f"{GAP}_sum"),
            )
        )

    def holds(self, question: str) -> str:
        return f"(_answers & {self._bit[question]}L) <> 0"

    def count(self, test: str = "true") -> str:
        return f"coalesce(sum(_n) FILTER (WHERE {test}), 0)"

    def total(self, test: str, column: str) -> str:
        return f"sum({column}_sum) FILTER (WHERE {test})"

    def largest(self, column: str, test: str = "true") -> str:
        return f"max({column}_max) FILTER (WHERE {test})"

    def smallest(self, column: str) -> str:
        return f"min({column}_min)"


class MergedCounts(AnswerCounts):
    """The same counters over stored counts of several parts, added up."""

    def __init__(self, counts: DataFrame, by: Sequence[str] = ()):
        self._bit = {name: 1 << place for place, name in enumerate(questions())}
        measured = [*DELAYS, GAP]
        self.frame = counts.groupBy(*by, "_answers").agg(
            F.sum("_n").alias("_n"),
            *(F.min(f"{c}_min").alias(f"{c}_min") for c in measured),
            *(F.max(f"{c}_max").alias(f"{c}_max") for c in measured),
            F.sum(f"{GAP}_sum").alias(f"{GAP}_sum"),
        )


Counted = Records | AnswerCounts
Counters = dict[str, str]


def _all_null(over: Counted) -> str:
    return "(" + " AND ".join(over.holds(f"{cause.lower()}_null") for cause in CAUSES) + ")"


def _any_null(over: Counted) -> str:
    return "(" + " OR ".join(over.holds(f"{cause.lower()}_null") for cause in CAUSES) + ")"


def status_counters(over: Counted) -> Counters:
    names = [f"{flag.lower()}_{kind}" for flag in FLAGS for kind in ("0", "1", "null", "other")]
    both = f"{over.holds('cancelled_1')} AND {over.holds('diverted_1')}"
    return {name: over.count(over.holds(name)) for name in names} | {"cancelled_and_diverted": over.count(both)}


def delay_counters(over: Counted) -> Counters:
    flown = over.holds("cancelled_0")
    eligible = {"DEP_DELAY": flown, "ARR_DELAY": f"{flown} AND {over.holds('diverted_0')}"}
    counters = {}
    for delay in DELAYS:
        name = delay.lower()
        counters |= {
            f"{name}_null_eligible": over.count(f"{eligible[delay]} AND {over.holds(f'{name}_null')}"),
            f"{name}_min": over.smallest(delay),
            f"{name}_max": over.largest(delay),
            f"{name}_negative": over.count(over.holds(f"{name}_negative")),
        }
    return counters


def band_counters(over: Counted) -> Counters:
    counters = {}
    for name in (f"{delay.lower()}_{band}" for delay in DELAYS for band in _BANDS):
        inside = over.holds(name)
        counters |= {
            f"{name}_total": over.count(inside),
            f"{name}_all_null": over.count(f"{inside} AND {_all_null(over)}"),
            f"{name}_any_null": over.count(f"{inside} AND {_any_null(over)}"),
        }
    return counters


def cause_counters(over: Counted) -> Counters:
    names = [f"{cause.lower()}_{kind}" for cause in CAUSES for kind in ("null", "negative")]
    return {name: over.count(over.holds(name)) for name in names}


THRESHOLDS = ["gt_0", "ge_15"]
RECONCILED = [
    "flights", "all_causes_null", "comparable", "equal", "differ", "less", "greater",
    "abs_diff_sum", "abs_diff_max",
]


def reconcile_counters(over: Counted) -> Counters:
    """Do the causes of a late flight add up to its arrival delay?"""
    very_late, late_at_all = over.holds("arr_delay_ge_15"), over.holds("arr_delay_gt_0_lt_15")
    less, more = over.holds("causes_less"), over.holds("causes_greater")
    counters = {}
    for name, late in zip(THRESHOLDS, (f"({very_late} OR {late_at_all})", very_late)):
        off = f"{late} AND ({less} OR {more})"
        values = [
            over.count(late),
            over.count(f"{late} AND {_all_null(over)}"),
            over.count(f"{late} AND NOT {_any_null(over)}"),
            over.count(f"{late} AND {over.holds('causes_equal')}"),
            over.count(off),
            over.count(f"{late} AND {less}"),
            over.count(f"{late} AND {more}"),
            over.total(off, GAP),
            over.largest(GAP, off),
        ]
        counters |= {f"{name}_{part}": value for part, value in zip(RECONCILED, values)}
    return counters


def clock_counters(over: Counted) -> Counters:
    faults = [over.holds(f"crs_{fault}") for fault in CLOCK_FAULTS]
    counters = {f"crs_{name}": over.count(test) for name, test in zip(CLOCK_FAULTS, faults)}
    return counters | {"crs_invalid": over.count(" OR ".join(faults))}


def _evaluated(over: Counted, counters: Counters) -> DataFrame:
    return over.frame.selectExpr(*(f"{value} AS {name}" for name, value in counters.items()))


def _percent_or_zero(part: str, whole: str) -> str:
    return f"coalesce(try_divide({part}, {whole}) * 100.0D, 0.0D)"


# --- reports --------------------------------------------------------------------------


def status_report(raw: DataFrame) -> DataFrame:
    """Values of both flags, and records that are cancelled and diverted: one row."""
    over = Records(raw)
    return _evaluated(over, status_counters(over))


def delay_report(raw: DataFrame) -> DataFrame:
    """Unexpected NULLs, extremes and negative values of both delays: one row."""
    over = Records(raw)
    return _evaluated(over, delay_counters(over))


def clock_report(raw: DataFrame) -> DataFrame:
    """Invalid scheduled departures by reason: one row."""
    over = Records(raw)
    return _evaluated(over, clock_counters(over))


def delay_bands(raw: DataFrame) -> DataFrame:
    """Flights per delay and band, and how many lack all or some causes. Bands always appear."""
    over = Records(raw)
    rows = [
        f"'{delay}', '{band}', {delay}_{band}_total, {delay}_{band}_all_null, {delay}_{band}_any_null"
        for delay in DELAYS
        for band in _BANDS
    ]
    tall = _evaluated(over, band_counters(over)).selectExpr(
        f"stack({len(rows)}, {', '.join(rows)}) AS (delay, band, total, all_causes_null, any_cause_null)"
    )
    return tall.selectExpr(
        "*",
        f"{_percent_or_zero('all_causes_null', 'total')} AS all_causes_null_pct",
        f"{_percent_or_zero('any_cause_null', 'total')} AS any_cause_null_pct",
    )


def cause_nulls(raw: DataFrame) -> DataFrame:
    """NULL and negative values of each cause."""
    over = Records(raw)
    rows = [f"'{cause}', {cause}_null, {cause}_negative" for cause in CAUSES]
    return _evaluated(over, cause_counters(over)).selectExpr(
        f"stack({len(rows)}, {', '.join(rows)}) AS (cause, nulls, negatives)"
    )


def cause_reconcile(raw: DataFrame) -> DataFrame:
    """One row per threshold (delay > 0, delay >= 15); differences only over differing rows."""
    over = Records(raw)
    rows = [f"'{name}', " + ", ".join(f"{name}_{part}" for part in RECONCILED) for name in THRESHOLDS]
    tall = _evaluated(over, reconcile_counters(over)).selectExpr(
        f"stack({len(rows)}, {', '.join(rows)}) AS (threshold, {', '.join(RECONCILED)})"
    )
    return tall.selectExpr(
        "threshold", "flights", "all_causes_null",
        f"{_percent_or_zero('all_causes_null', 'flights')} AS all_causes_null_pct",
        "comparable", "equal", "differ", "less", "greater",
        "try_divide(abs_diff_sum, differ) AS mean_abs_diff",
        "abs_diff_max AS max_abs_diff",
    )


def quality_profile(raw: DataFrame) -> DataFrame:
    """Every counter of every report in one pass over the records: (metric, value)."""
    return profile_from(AnswerCounts(raw))


def profile_from(over: AnswerCounts) -> DataFrame:
    """The profile of records counted by their answers."""
    counters = {
        "rows": over.count(),
        **status_counters(over), **delay_counters(over), **band_counters(over), **cause_counters(over),
        **reconcile_counters(over), **clock_counters(over),
    }
    rows = ", ".join(f"'{name}', cast({name} AS double)" for name in counters)
    return _evaluated(over, counters).selectExpr(f"stack({len(counters)}, {rows}) AS (metric, value)")


def missing_causes(raw: DataFrame, per: str) -> DataFrame:
    """Late flights without any cause, per file (or other column) and in total.

    ``is_total`` is 1 on the total row, whose ``per`` is NULL, and 0 elsewhere, also where
    ``per`` itself is NULL. The roll-up runs over one row per file, so it does not multiply
    the facts.
    """
    late = F.col("ARR_DELAY") > 0
    per_file = raw.groupBy(per).agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(late).alias("positive_delay_rows"),
        F.count_if(late & all_null(CAUSES)).alias("all_causes_null"),
        F.count_if(late & ~all_null(CAUSES)).alias("at_least_one_cause"),
    )
    return _with_total(per_file, per)


def missing_causes_from(over: AnswerCounts, per: str) -> DataFrame:
    """The same from counted answers that carry the column ``per``."""
    late = f"({over.holds('arr_delay_ge_15')} OR {over.holds('arr_delay_gt_0_lt_15')})"
    per_file = over.frame.groupBy(per).agg(
        F.expr(over.count()).alias("total_rows"),
        F.expr(over.count(late)).alias("positive_delay_rows"),
        F.expr(over.count(f"{late} AND {_all_null(over)}")).alias("all_causes_null"),
        F.expr(over.count(f"{late} AND NOT {_all_null(over)}")).alias("at_least_one_cause"),
    )
    return _with_total(per_file, per)


def _with_total(per_file: DataFrame, per: str) -> DataFrame:
    counts = [c for c in per_file.columns if c != per]
    return (
        per_file.rollup(per)
        .agg(F.grouping(per).cast("int").alias("is_total"), *(F.sum(c).alias(c) for c in counts))
        .withColumn("all_causes_null_pct", F.coalesce(percent("all_causes_null", "positive_delay_rows"), F.lit(0.0)))
    )


# --- row counts and duplicates -------------------------------------------------------


def row_counts(raw: DataFrame, expected_months: Iterable[int] = EXPECTED_MONTHS) -> DataFrame:
    """Rows per month, per carrier (NULL shown as 'NULL') and in total.

    Facts are counted once by (month, carrier); the grouping sets expand only that small
    table. ``unexpected`` marks months that should not occur.
    """
    return row_counts_from(raw.groupBy("MONTH", "OP_UNIQUE_CARRIER").agg(F.count(F.lit(1)).alias("_n")), expected_months)


def row_counts_from(counted: DataFrame, expected_months: Iterable[int] = EXPECTED_MONTHS) -> DataFrame:
    """The same from rows counted by (MONTH, OP_UNIQUE_CARRIER)."""
    base = counted.select("MONTH", F.coalesce("OP_UNIQUE_CARRIER", F.lit("NULL")).alias("_carrier"), "_n")
    level = F.grouping_id("MONTH", "_carrier")
    sets = base.groupingSets([["MONTH"], ["_carrier"], []], "MONTH", "_carrier").agg(
        F.sum("_n").alias("rows"), level.alias("_level")
    )
    dimension = F.when(F.col("_level") == 1, "month").when(F.col("_level") == 2, "carrier").otherwise("total")
    strange = (F.col("_level") == 1) & ~F.col("MONTH").isin(list(expected_months))
    known = ~((F.col("_level") == 1) & F.col("MONTH").isNull())
    return sets.where(known).select(
        dimension.alias("dimension"),
        F.when(F.col("_level") == 1, F.col("MONTH").cast("string"))
        .when(F.col("_level") == 2, F.col("_carrier"))
        .otherwise("all")
        .alias("value"),
        "rows",
        F.coalesce(strange, F.lit(False)).alias("unexpected"),
    )


#: Filter slots per record of the duplicate audit, and the largest filter that is broadcast.
SLOTS_PER_RECORD = 16
BROADCAST_BYTES = 64 << 20
#: Slots of one bitmap: a fixed value of Spark's bitmap functions.
_BITMAP_SLOTS = 32768


def _suspects(raw: DataFrame, key: Sequence[str]) -> DataFrame:
    """The keys of records that may share their key with another record.

    A record is one slot of a filter. Slots are counted, which moves a few bytes a record
    instead of the key; the slots that two records fall into become bitmaps, built by
    bit operations. Where the bitmaps are small enough every task tests its own records, and
    only those in a repeated slot move.
    """
    records = raw.count()
    slots = max(_BITMAP_SLOTS, 1 << max(0, records * SLOTS_PER_RECORD - 1).bit_length())
    slot = (F.pmod(F.xxhash64(*key), F.lit(slots)) + 1).alias("_slot")
    repeated = raw.select(slot).groupBy("_slot").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    bitmaps = repeated.groupBy(F.bitmap_bucket_number("_slot").alias("_block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_slot")).alias("_bitmap")
    )
    if slots // 8 <= BROADCAST_BYTES:
        bitmaps = F.broadcast(bitmaps)
    place = F.bitmap_bit_position("_slot")
    byte = F.conv(F.hex(F.substring("_bitmap", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = byte.bitwiseAND(F.call_function("shiftleft", F.lit(1), (place % 8).cast("int"))) != 0
    tested = raw.select(*key, slot).withColumn("_block", F.bitmap_bucket_number("_slot")).join(bitmaps, "_block")
    return tested.where(hit).select(*key)


def duplicate_audit(raw: DataFrame, key: Sequence[str] = FLIGHT_KEY) -> DataFrame:
    """Key groups that occur more than once, and the rows in them. NULLs compare equal.

    Nearly every key is unique. A filter of slots that hold two records singles out the
    keys that may repeat; only these are shuffled and counted exactly.
    """
    repeated = _suspects(raw, key).groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    return repeated.agg(
        F.count(F.lit(1)).alias("duplicate_groups"), F.coalesce(F.sum("_n"), F.lit(0)).alias("rows_in_groups")
    )


# --- examples ------------------------------------------------------------------------

EXAMPLES_PER_CHECK = {
    "cancelled_and_diverted": 5,
    "late_15_all_causes_null": 5,
    "negative_causes": 5,
    "invalid_crs_dep_time": 5,
    "cause_sum_differs": 5,
    "late_all_causes_null": 10,
}


def violations() -> dict[str, str]:
    """What each check looks for, as a SQL condition."""
    return {
        "cancelled_and_diverted": "CANCELLED = 1 AND DIVERTED = 1",
        "late_15_all_causes_null": f"ARR_DELAY >= 15 AND {_ALL_NULL}",
        "negative_causes": f"least({', '.join(CAUSES)}) < 0",
        "invalid_crs_dep_time": _BAD_CLOCK,
        "cause_sum_differs": f"ARR_DELAY >= 15 AND abs({_GAP}) > {SUM_TOLERANCE}D",
        "late_all_causes_null": f"ARR_DELAY > 0 AND {_ALL_NULL}",
    }


def examples(raw: DataFrame, per_check: Mapping[str, int] = EXAMPLES_PER_CHECK) -> DataFrame:
    """The first few records violating each check, in record order.

    The first pass counts violations per date and check. A check's first k records lie on
    the dates before and including the one that completes k: at most k dates, since each
    has a violation. The second pass looks only at records of those dates.
    """
    tests = {name: test for name, test in violations().items() if name in per_check}
    date, shown = FLIGHT_KEY[:3], [*FLIGHT_KEY, *FLAGS, *DELAYS, *CAUSES]
    limit = "CASE check " + " ".join(f"WHEN '{name}' THEN {k}" for name, k in per_check.items()) + " END"

    per_date = raw.groupBy(*date).agg(*(F.expr(f"count_if({test})").alias(name) for name, test in tests.items()))
    pairs = ", ".join(f"'{name}', {name}" for name in tests)
    earlier = Window.partitionBy("check").orderBy(*date).rowsBetween(Window.unboundedPreceding, -1)
    wanted = (
        per_date.selectExpr(*date, f"stack({len(tests)}, {pairs}) AS (check, n)")
        .where("n > 0")
        .withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
        .where(f"before < {limit}")
        .groupBy(*date)
        .agg(F.collect_set("check").alias("_wanted"))
    )

    flags = ", ".join(f"if({test}, '{name}', '')" for name, test in tests.items())
    same_date = [F.col(f"r.{c}").eqNullSafe(F.col(f"w.{c}")) for c in date]
    tagged = (
        raw.select(*shown).alias("r")
        .join(F.broadcast(wanted).alias("w"), same_date)
        .select("r.*", "w._wanted")
        .selectExpr(*shown, "_wanted", f"explode(array_remove(array({flags}), '')) AS check")
        .where("array_contains(_wanted, check)")
    )
    order = [F.col(c).asc_nulls_first() for c in shown]
    first = first_k(tagged, ["check"], order, max(per_check.values()))
    differs = "check = 'cause_sum_differs'"
    return first.where(f"position <= {limit}").selectExpr(
        *shown, "check", f"if({differs}, {_TOTAL}, null) AS total_cause_delay",
        f"if({differs}, {_GAP}, null) AS total_minus_arr_delay", "position",
    )
