"""Queries: aggregates, profiles and quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabflow.functions import expressions as ex
from tabflow.functions.state import scalar_row
from tabflow.operators import binning, missing, outliers, profile
from tabflow.plans.inputs import EVENTS_SQL, WITH_CUSTOMERS, WITH_GAPS, gapped_customers, scored_events
from tabflow.plans.registry import query, rounded
from tabflow.plans.relational import bucket_sql
from tabflow.sources.shared import persist_state
from tabflow.sources.tables import customers, table


def long_sql(source: str, columns: list[str], record: str, prefix: str = "") -> str:
    """UNION ALL of one SELECT per column; `{c}` in the record stands for the column."""
    selects = [f"SELECT '{c}' AS feature, {record.format(c=c)} FROM {source}" for c in columns]
    return prefix + " UNION ALL ".join(selects)


@query(
    "agg_column_stats",
    "SELECT count(l_extendedprice) AS n, count(DISTINCT l_extendedprice) AS n_distinct, "
    "min(l_extendedprice) AS min_value, max(l_extendedprice) AS max_value FROM lineitem",
)
def agg_column_stats(spark, root):
    return profile.column_stats(table(spark, root, "lineitem"), "l_extendedprice")


LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "agg_moments",
    long_sql(
        "lineitem",
        LINE_NUMBERS,
        "round(min({c}), 5) AS min, round(max({c}), 5) AS max, round(avg({c}), 5) AS mean, round(stddev_samp({c}), 5) AS std",
    ),
)
def agg_moments(spark, root):
    return rounded(profile.moments(table(spark, root, "lineitem"), LINE_NUMBERS), 5)


@query(
    "agg_quantiles",
    long_sql(
        "lineitem",
        LINE_NUMBERS,
        "unnest([0, 1, 2]) AS position, unnest([quantile_disc({c}, 0.25), quantile_disc({c}, 0.5), quantile_disc({c}, 0.75)]) AS value",
    ),
)
def agg_quantiles(spark, root):
    return profile.quantiles(table(spark, root, "lineitem"), LINE_NUMBERS, [0.25, 0.5, 0.75], exact=True)


@query("agg_quantiles_approx")
def agg_quantiles_approx(spark, root):
    """The bounded-summary form of `agg_quantiles`, one aggregate for all columns."""
    return profile.quantiles(table(spark, root, "lineitem"), LINE_NUMBERS, [0.25, 0.5, 0.75])


@query(
    "agg_describe",
    long_sql(
        "orders",
        ["o_orderkey", "o_custkey", "o_totalprice"],
        "unnest(['count', 'mean', 'stddev', 'min', 'max']) AS stat, unnest([count({c})::DOUBLE, round(avg({c}), 3), "
        "round(stddev_samp({c}), 3), round(min({c})::DOUBLE, 3), round(max({c})::DOUBLE, 3)]) AS value",
    ),
)
def agg_describe(spark, root):
    return rounded(profile.describe(table(spark, root, "orders")), 3)


@query(
    "agg_class_distribution",
    WITH_CUSTOMERS + "SELECT churned, count(*) AS n, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM cust), 6) AS pct "
    "FROM cust GROUP BY churned",
)
def agg_class_distribution(spark, root):
    return rounded(profile.class_distribution(customers(spark, root), "churned"))


TENURE_CASE = """CASE WHEN tenure_months BETWEEN 0 AND 24 THEN 'New' WHEN tenure_months BETWEEN 25 AND 48 THEN 'Established'
WHEN tenure_months BETWEEN 49 AND 72 THEN 'Loyal' ELSE 'Invalid' END"""


@query(
    "agg_bin_distribution",
    WITH_CUSTOMERS + f"""SELECT {TENURE_CASE} AS tenure_monthsBins, count(*) AS n,
round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM cust), 6) AS pct, {TENURE_CASE} = 'Invalid' AS is_invalid
FROM cust GROUP BY {TENURE_CASE}""",
)
def agg_bin_distribution(spark, root):
    binned = binning.bin_custom(customers(spark, root), "tenure_months", binning.TENURE_BINS)
    return rounded(profile.bin_distribution(binned, "tenure_monthsBins"))


GAP_COLUMNS = ["c_custkey", "charges", "segment", "charges_text", "order_count", "total_spend", "tenure_months"]
BLANK = {"segment", "charges_text"}


def missing_sql() -> str:
    parts = [
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL{f' OR {c} = ' + chr(39) * 2 if c in BLANK else ''}) AS missing_count FROM gaps"
        for c in GAP_COLUMNS
    ]
    union = " UNION ALL ".join(parts)
    return f"{union} UNION ALL SELECT 'TOTAL', CAST(sum(missing_count) AS BIGINT) FROM ({union})"


@query("agg_missing_counts", WITH_GAPS + missing_sql())
def agg_missing_counts(spark, root):
    return missing.missing_counts(gapped_customers(spark, root).select(*GAP_COLUMNS))


@query(
    "agg_distinct_count",
    long_sql("part", ["p_brand", "p_type", "p_size", "p_name"], "count(DISTINCT {c}) AS n_distinct"),
)
def agg_distinct_count(spark, root):
    return profile.distinct_count(table(spark, root, "part"), ["p_brand", "p_type", "p_size", "p_name"])


def mode_sql(source: str, column: str) -> str:
    return (
        f"(SELECT '{column}' AS feature, CAST({column} AS VARCHAR) AS value, count(*) AS n FROM {source} "
        f"WHERE {column} IS NOT NULL GROUP BY {column} ORDER BY n DESC, CAST({column} AS VARCHAR) LIMIT 1)"
    )


@query(
    "agg_mode",
    WITH_GAPS + mode_sql("gaps", "segment") + " UNION ALL " + mode_sql("gaps", "c_nationkey")
    + " UNION ALL " + mode_sql("gaps", "order_count"),
)
def agg_mode(spark, root):
    return missing.column_modes(gapped_customers(spark, root), ["segment", "c_nationkey", "order_count"])


@query(
    "agg_top_values",
    "SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey ORDER BY n DESC, l_partkey LIMIT 10",
)
def agg_top_values(spark, root):
    return profile.top_values(table(spark, root, "lineitem"), "l_partkey", 10)


@query(
    "agg_duplicates",
    "SELECT CAST(sum(n - 1) AS BIGINT) AS duplicate_rows FROM "
    "(SELECT count(*) AS n FROM lineitem GROUP BY l_quantity, l_discount, l_tax, l_returnflag, l_linestatus)",
)
def agg_duplicates(spark, root):
    lines = table(spark, root, "lineitem").select("l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus")
    return profile.duplicate_count(lines)


def shifted_events(spark, root):
    """Events, some of them twice, and some again a microsecond later."""
    events = table(spark, root, "events")
    later = events.filter("event_id % 17 = 0").withColumn("ts", F.col("ts") + F.expr("INTERVAL '0.000001' SECOND"))
    return events.unionByName(events.filter("event_id % 13 = 0")).unionByName(later)


SHIFTED_SQL = """shifted AS (SELECT * FROM events UNION ALL SELECT * FROM events WHERE event_id % 13 = 0
  UNION ALL SELECT event_id, ts + INTERVAL 1 MICROSECOND, user_id, event_type, value, props FROM events WHERE event_id % 17 = 0)"""
EVENT_COPIES_SQL = "SELECT CAST(sum(n - 1) AS BIGINT) AS d FROM (SELECT count(*) AS n FROM shifted GROUP BY event_id, ts, user_id, event_type, value, props)"


@query("agg_duplicates_events", f"WITH {SHIFTED_SQL} SELECT d AS duplicate_rows FROM ({EVENT_COPIES_SQL})")
def agg_duplicates_events(spark, root):
    """All columns of a table with timestamps that differ in the last digit."""
    return profile.duplicate_count(shifted_events(spark, root))


@query(
    "quality_gate_events",
    f"""WITH {SHIFTED_SQL}, copies AS ({EVENT_COPIES_SQL}), n AS (SELECT count(*) AS total FROM shifted)
SELECT 'total_rows' AS metric, total AS value FROM n UNION ALL SELECT 'total_columns', 6 UNION ALL SELECT 'missing_values', 0
UNION ALL SELECT 'duplicate_rows', d FROM copies UNION ALL SELECT 'passed', 1
UNION ALL SELECT 'target=' || event_type, count(*) FROM shifted GROUP BY event_type""",
)
def quality_gate_events(spark, root):
    return profile.quality_gate(shifted_events(spark, root), "event_type")


@query(
    "profile_table",
    "SELECT '*' AS feature, 'rows' AS stat, count(*)::DOUBLE AS value FROM part UNION ALL SELECT '*', 'columns', 6.0::DOUBLE UNION ALL "
    + long_sql(
        "part",
        ["p_partkey", "p_size", "p_retailprice"],
        "unnest(['count', 'mean', 'stddev', 'min', 'max']) AS stat, unnest([count({c})::DOUBLE, round(avg({c}), 3), "
        "round(stddev_samp({c}), 3), round(min({c})::DOUBLE, 3), round(max({c})::DOUBLE, 3)]) AS value",
    ),
)
def profile_table(spark, root):
    return rounded(profile.profile_table(table(spark, root, "part")), 3)


@query(
    "profile_column",
    WITH_GAPS + long_sql(
        "gaps",
        ["charges", "total_spend"],
        "'double' AS dtype, count(*) - count({c}) AS null_count, "
        "round((count(*) - count({c})) * 100.0::DOUBLE / count(*), 4) AS null_pct, round(avg({c}), 4) AS mean, "
        "round(stddev_samp({c}), 4) AS std, round(min({c}), 4) AS min, round(max({c}), 4) AS max, "
        "round(quantile_disc({c}, 0.25), 4) AS q1, round(quantile_disc({c}, 0.5), 4) AS median, round(quantile_disc({c}, 0.75), 4) AS q3",
    ),
)
def profile_column(spark, root):
    return rounded(profile.profile_numeric(gapped_customers(spark, root), ["charges", "total_spend"], exact=True), 4)


@query(
    "profile_column_text",
    WITH_GAPS + """, counts AS (SELECT segment AS value, count(*) AS n FROM gaps GROUP BY segment)
SELECT 'segment' AS feature, 'string' AS dtype, (SELECT count(*) - count(segment) FROM gaps) AS null_count,
round((SELECT (count(*) - count(segment)) * 100.0::DOUBLE / count(*) FROM gaps), 6) AS null_pct,
(SELECT count(*) FROM counts) AS n_distinct, value, n FROM counts""",
)
def profile_column_text(spark, root):
    return rounded(profile.profile_categorical(gapped_customers(spark, root), "segment"))


QUALITY_COLUMNS = ["segment", "charges_text", "tenure_months", "order_count", "churned"]


@query(
    "quality_gate",
    WITH_GAPS + """, facts AS (SELECT count(*) AS total, count(*) FILTER (WHERE segment IS NULL OR segment = '') AS absent FROM gaps),
copies AS (SELECT CAST(sum(n - 1) AS BIGINT) AS d FROM
  (SELECT count(*) AS n FROM gaps GROUP BY segment, charges_text, tenure_months, order_count, churned))
SELECT 'total_rows' AS metric, total AS value FROM facts
UNION ALL SELECT 'total_columns', 5 UNION ALL SELECT 'missing_values', absent FROM facts
UNION ALL SELECT 'duplicate_rows', d FROM copies
UNION ALL SELECT 'passed', CASE WHEN absent <= total * 0.5 THEN 1 ELSE 0 END FROM facts
UNION ALL SELECT 'target=' || CAST(churned AS VARCHAR), count(*) FROM gaps GROUP BY churned""",
)
def quality_gate(spark, root):
    return profile.quality_gate(gapped_customers(spark, root).select(*QUALITY_COLUMNS), "churned")


@query(
    "summary_stages",
    WITH_GAPS + f""", q AS (SELECT quantile_disc(total_spend, 0.25) AS q1, quantile_disc(total_spend, 0.75) AS q3 FROM gaps),
flags AS (SELECT charges IS NULL AS no_charge,
  total_spend < q1 - 0.5 * (q3 - q1) OR total_spend > q3 + 0.5 * (q3 - q1) AS is_out,
  {bucket_sql("c_custkey")} < 2000 AS is_test, churned FROM gaps, q),
c AS (SELECT count(*) AS initial, count(*) FILTER (WHERE no_charge) AS m, count(*) FILTER (WHERE NOT no_charge AND is_out) AS o,
  count(*) FILTER (WHERE NOT no_charge AND NOT is_out AND NOT is_test) AS train, count(*) FILTER (WHERE NOT no_charge AND NOT is_out AND is_test) AS test FROM flags)
SELECT 'initial_rows' AS metric, initial::DOUBLE AS value FROM c UNION ALL SELECT 'rows_removed_missing', m FROM c
UNION ALL SELECT 'rows_removed_outliers', o FROM c UNION ALL SELECT 'final_train_rows', train FROM c
UNION ALL SELECT 'final_test_rows', test FROM c
UNION ALL SELECT 'test_split_ratio', round(test::DOUBLE / (train + test), 6) FROM c
UNION ALL SELECT 'train_target=' || churned, count(*) FILTER (WHERE NOT no_charge AND NOT is_out AND NOT is_test)::DOUBLE FROM flags GROUP BY churned
UNION ALL SELECT 'test_target=' || churned, count(*) FILTER (WHERE NOT no_charge AND NOT is_out AND is_test)::DOUBLE FROM flags GROUP BY churned""",
)
def summary_stages(spark, root):
    gaps = gapped_customers(spark, root)
    state = persist_state(outliers.fit_iqr(gaps, ["total_spend"], factor=0.5, exact=True))
    bounds = scalar_row(state)["total_spend"]
    return rounded(
        profile.stage_summary(
            gaps,
            ex.is_missing(gaps, "charges"),
            ex.outside(F.col("total_spend"), bounds["lower"], bounds["upper"]),
            ex.hash_bucket(["c_custkey"]) < 2000,
            "churned",
        )
    )


@query(
    "summary_inference",
    f"""WITH {EVENTS_SQL} SELECT count(*) AS num_predictions, round(avg(prediction), 6) AS avg_prediction,
count(*) FILTER (WHERE prediction = 1) AS churn_count, count(*) FILTER (WHERE prediction <> 1) AS retain_count, round(avg(probability), 6) AS avg_probability,
count(*) FILTER (WHERE probability > 0.7) AS high_risk, count(*) FILTER (WHERE probability > 0.5 AND probability <= 0.7) AS medium_risk,
count(*) FILTER (WHERE probability <= 0.5) AS low_risk FROM scored_events""",
)
def summary_inference(spark, root):
    return rounded(profile.inference_summary(scored_events(table(spark, root, "events")), "prediction", "probability"))
