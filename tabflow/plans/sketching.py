"""Queries: windows of days from stored sketches, compared with counts of the rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabflow.operators import drift, outliers, profile, sketches
from tabflow.plans.inputs import EVENTS_SQL, scored_events
from tabflow.plans.monitoring import END_DAY
from tabflow.plans.registry import query
from tabflow.sources.shared import new_path, persist_state
from tabflow.sources.tables import table

NUMERIC, TEXT = ["value", "probability"], ["event_type"]
WINDOWS = {"week": 7, "month": 30}
SHARES = [0.05, 0.25, 0.5, 0.75, 0.95]


def stored(spark, root) -> str:
    """The store of all days of the scored events."""
    path = new_path(spark, "days")
    rows = scored_events(table(spark, root, "events")).select("ts", *NUMERIC, *TEXT, F.col("user_id").cast("string").alias("user_id"))
    sketches.store_days(sketches.summarise_days(rows, "ts", NUMERIC, [*TEXT, "user_id"]), path)
    return path


def end_day():
    return F.lit(END_DAY).cast("date")


def window_rows(spark, root, days):
    day = F.to_date("ts")
    rows = scored_events(table(spark, root, "events"))
    return rows.filter(day.between(F.date_sub(end_day(), days), end_day()))


def within_bound(found, rows, columns, bound):
    """Adds `within_bound`: the share of real rows below and up to each value brackets its share, give or
    take the bound. `found` has a few rows per feature."""
    long = rows.select(*columns).unpivot([], columns, "feature", "x").withColumnRenamed("feature", "of")
    met = found.join(long, F.col("feature") == F.col("of")).groupBy(*found.columns)
    below, upto = F.count_if(F.col("x") < F.col("value")) / F.col("n"), F.count_if(F.col("x") <= F.col("value")) / F.col("n")
    return met.agg(((below - bound <= F.col("share")) & (upto + bound >= F.col("share"))).alias("within_bound"))


def windows_sql(select: str) -> str:
    parts = [
        f"SELECT '{w}' AS window_name, {select} FROM scored_events, (VALUES ('value', value), ('probability', probability)) f(feature, x)"
        for w in WINDOWS
    ]
    return " UNION ALL ".join(parts)


@query(
    "monitor_window_sketches",
    f"WITH {EVENTS_SQL} "
    + " UNION ALL ".join(
        f"""SELECT '{w}' AS window_name, '{c}' AS feature, s AS share, count({c}) AS n, true AS within_bound
FROM scored_events, (VALUES {", ".join(f"({s}::DOUBLE)" for s in SHARES)}) v(s)
WHERE CAST(ts AS DATE) BETWEEN DATE '{END_DAY}' - INTERVAL {d} DAY AND DATE '{END_DAY}' GROUP BY s"""
        for w, d in WINDOWS.items()
        for c in NUMERIC
    ),
)
def monitor_window_sketches(spark, root):
    """Quantiles of the week and of the month from the daily sketches alone, each judged by real ranks.

    Twice the error that 99 % of sketches keep: beyond it lies far less than one in a million.
    """
    path, united = stored(spark, root), None
    for name, days in WINDOWS.items():
        merged = persist_state(sketches.merge_days(sketches.stored_days(spark, path, end_day(), days)), "merged")
        found = persist_state(sketches.quantiles(merged, SHARES), "quantiles")
        judged = within_bound(found, window_rows(spark, root, days), NUMERIC, 2 * sketches.rank_error())
        part = judged.select(F.lit(name).alias("window_name"), "feature", "share", "n", "within_bound")
        united = part if united is None else united.unionByName(part)
    return united


@query(
    "drift_psi_sketches",
    f"""WITH {EVENTS_SQL}, w AS (SELECT DATE '{END_DAY}' - INTERVAL 7 DAY AS first)
SELECT f AS feature, count(*) FILTER (WHERE CAST(ts AS DATE) < first) AS n_ref, count(*) FILTER (WHERE CAST(ts AS DATE) >= first) AS n_cur, true AS close
FROM scored_events, w, (VALUES ('value'), ('probability')) v(f)
WHERE CAST(ts AS DATE) BETWEEN first - INTERVAL 30 DAY AND DATE '{END_DAY}' GROUP BY f""",
)
def drift_psi_sketches(spark, root):
    """PSI of the week against the thirty days before it from sketches, close to that of the rows."""
    path = stored(spark, root)
    week = sketches.merge_days(sketches.stored_days(spark, path, end_day(), 7))
    before = sketches.merge_days(sketches.stored_days(spark, path, F.date_sub(end_day(), 8), 29))
    found = sketches.drift_psi(persist_state(before, "before"), persist_state(week, "week"))
    rows = scored_events(table(spark, root, "events"))
    day, first = F.to_date("ts"), F.date_sub(end_day(), 7)
    old = rows.filter(day.between(F.date_sub(first, 30), F.date_sub(first, 1))).select(*NUMERIC)
    exact = drift.drift_psi(old, rows.filter(day.between(first, end_day())).select(*NUMERIC), NUMERIC, exact=True)
    joined = found.join(exact.select("feature", F.col("psi").alias("exact")), "feature")
    return joined.select("feature", "n_ref", "n_cur", (F.abs(F.col("psi") - F.col("exact")) < 0.03).alias("close"))


@query(
    "outlier_iqr_sketches",
    f"""WITH {EVENTS_SQL} SELECT count(*) AS n, true AS close FROM scored_events
WHERE CAST(ts AS DATE) BETWEEN DATE '{END_DAY}' - INTERVAL 30 DAY AND DATE '{END_DAY}'""",
)
def outlier_iqr_sketches(spark, root):
    """Bounds from the month's sketches flag about the rows that exact quartiles flag: quartiles are off
    by 0.7 % of the rows at most, and few rows lie between the two bounds."""
    merged = sketches.merge_days(sketches.stored_days(spark, stored(spark, root), end_day(), 30))
    bounds = persist_state(sketches.iqr_bounds(merged, ["value"]), "bounds")
    rows = window_rows(spark, root, 30).select("value")
    exact = persist_state(outliers.fit_iqr(rows, ["value"], exact=True), "bounds")
    count = lambda state: outliers.flag(rows, state).agg(F.count_if("value_outlier").alias("flagged"), F.count("*").alias("n"))
    ours, theirs = count(bounds), count(exact).select(F.col("flagged").alias("exactly"))
    joined = ours.withColumn("exactly", theirs.scalar())
    return joined.select("n", (F.abs(F.col("flagged") - F.col("exactly")) <= 0.01 * F.col("n")).alias("close"))


@query(
    "agg_distinct_sketches",
    """SELECT 'event_type' AS feature, count(event_type) AS n, count(DISTINCT event_type) AS n_distinct, true AS within_bound FROM events
UNION ALL SELECT 'user_id', count(user_id), count(DISTINCT user_id), true FROM events
UNION ALL SELECT 'value', count(value), count(DISTINCT value), true FROM events""",
)
def agg_distinct_sketches(spark, root):
    """Distinct values over all days from daily states, within five standard errors of the exact counts."""
    path, columns = stored(spark, root), ["event_type", "user_id", "value"]
    merged = sketches.merge_days(sketches.stored_days(spark, path, F.lit("2030-01-01").cast("date"), 10_000))
    exact = profile.distinct_count(table(spark, root, "events"), columns).withColumnRenamed("n_distinct", "exactly")
    joined = sketches.distinct_counts(merged).join(exact, "feature")
    error = F.abs(F.col("n_distinct") - F.col("exactly"))
    bound = F.greatest(F.lit(1.0), 5 * sketches.distinct_error() * F.col("exactly"))
    return joined.select("feature", "n", F.col("exactly").alias("n_distinct"), (error <= bound).alias("within_bound"))


@query(
    "agg_top_values_summary",
    "SELECT user_id, n, true AS by_summary FROM (SELECT user_id, count(*) AS n FROM events GROUP BY user_id ORDER BY n DESC, user_id LIMIT 10)",
)
def agg_top_values_summary(spark, root):
    """Frequent users: a bounded summary per task, and exact counts of what survives in it."""
    best, proved = sketches.frequent_values(table(spark, root, "events"), "user_id", 10)
    return best.withColumn("by_summary", F.lit(proved))
