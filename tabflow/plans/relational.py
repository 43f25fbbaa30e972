"""Queries: projections, filters, joins, sorts, samples, set operations, scalar functions."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tabflow.functions import expressions as ex
from tabflow.functions.state import scalar_row
from tabflow.operators import drift, encoding, evaluate, monitor, outliers, projection, scaling, scoring
from tabflow.plans.inputs import (
    EVENTS_SQL,
    PREDICTIONS_SQL,
    SPLIT_DAY,
    WITH_CUSTOMERS,
    WITH_GAPS,
    document_predictions,
    document_truth,
    event_halves,
    gapped_customers,
    moment,
    scored_events,
)
from tabflow.plans.registry import query, rounded
from tabflow.sources.shared import persist_state
from tabflow.sources.tables import SCORED_SQL, customers, scored_lines, table

PRIORITY_CODES = {"1-URGENT": 0, "2-HIGH": 1, "3-MEDIUM": 2, "4-NOT SPECIFIED": 3, "5-LOW": 4}
PRIORITY_CASE = "CASE o_orderpriority " + " ".join(
    f"WHEN '{text}' THEN {code}" for text, code in PRIORITY_CODES.items()
)
PART_SQL = "coalesce(length(CAST({key} AS VARCHAR)) || '=' || CAST({key} AS VARCHAR), '~')"
BUCKET_SQL = "CAST('0x' || substr(md5('{seed}:' || " + PART_SQL + "), 1, 8) AS BIGINT)"


def bucket_sql(key: str, seed: str = "42", buckets: int = ex.HASH_BUCKETS) -> str:
    return BUCKET_SQL.format(seed=seed, key=key) + f" % {buckets}"


# --- projections -----------------------------------------------------------------------


@query(
    "proj_features_target",
    WITH_CUSTOMERS
    + """SELECT x.c_custkey, x.c_mktsegment, x.tenure_months, round(x.total_spend, 2) AS total_spend, y.churned
FROM cust x JOIN cust y ON x.c_custkey = y.c_custkey""",
)
def proj_features_target(spark, root):
    """Features and target apart, linked again by the key they both keep."""
    features, target = projection.features_target(customers(spark, root), "churned", "c_custkey")
    kept = features.select("c_custkey", "c_mktsegment", "tenure_months", F.round("total_spend", 2).alias("total_spend"))
    return kept.join(target, "c_custkey")


@query("proj_drop", "SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag, l_shipdate FROM lineitem")
def proj_drop(spark, root):
    gone = ["l_partkey", "l_suppkey", "l_extendedprice", "l_discount", "l_tax", "l_linestatus", "not_there"]
    return projection.drop_present(table(spark, root, "lineitem"), gone)


@query("proj_rename", "SELECT o_orderkey, o_orderpriority AS priority, o_orderstatus AS status FROM orders")
def proj_rename(spark, root):
    renamed = table(spark, root, "orders").withColumnsRenamed({"o_orderpriority": "priority", "o_orderstatus": "status"})
    return renamed.select("o_orderkey", "priority", "status")


@query(
    "proj_alias_output",
    f"WITH {EVENTS_SQL} SELECT event_id, round(probability, 6) AS probability, prediction, "
    "prediction AS churn_prediction, round(probability, 6) AS churn_probability FROM scored_events",
)
def proj_alias_output(spark, root):
    scored = scored_events(table(spark, root, "events")).select("event_id", "probability", "prediction")
    return rounded(scoring.alias_output(scored))


@query(
    "proj_cast",
    "SELECT o_orderkey, TRY_CAST(o_orderstatus AS DOUBLE) AS o_orderstatus, CAST(o_custkey AS INTEGER) AS o_custkey, "
    "TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS rank FROM orders",
)
def proj_cast(spark, root):
    orders = table(spark, root, "orders").select(
        "o_orderkey", "o_orderstatus", "o_custkey", F.substring("o_orderpriority", 1, 1).alias("rank")
    )
    return projection.cast_columns(orders, {"o_orderstatus": "double", "o_custkey": "int", "rank": "int", "none": "int"})


@query("proj_existing_only", "SELECT p_partkey, p_brand, p_size FROM part")
def proj_existing_only(spark, root):
    part = table(spark, root, "part")
    return part.select(*ex.present(part, ["p_partkey", "p_brand", "p_colour", "p_size"]))


# --- filters ---------------------------------------------------------------------------


@query("filter_equality", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'")
def filter_equality(spark, root):
    return table(spark, root, "orders").filter(F.col("o_orderstatus") == "F").select("o_orderkey", "o_orderstatus")


@query(
    "filter_range",
    "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity BETWEEN 10 AND 20 "
    "AND l_shipdate BETWEEN TIMESTAMP '1996-01-01 00:00:00' AND TIMESTAMP '1999-12-31 00:00:00'",
)
def filter_range(spark, root):
    lines = table(spark, root, "lineitem")
    dates = projection.in_range(F.col("l_shipdate"), moment("1996-01-01 00:00:00"), moment("1999-12-31 00:00:00"))
    inside = lines.filter(projection.in_range(F.col("l_quantity"), 10, 20) & dates)
    return inside.select("l_orderkey", "l_linenumber", "l_quantity")


@query(
    "filter_missing",
    WITH_GAPS + "SELECT c_custkey, segment, charges FROM gaps "
    "WHERE segment IS NULL OR segment = '' OR charges IS NULL OR isnan(charges)",
)
def filter_missing(spark, root):
    gaps = gapped_customers(spark, root)
    absent = ex.is_missing(gaps, "segment") | ex.is_missing(gaps, "charges")
    return gaps.filter(absent).select("c_custkey", "segment", "charges")


@query(
    "filter_numeric_text",
    WITH_GAPS + "SELECT c_custkey, CASE WHEN regexp_matches(trim(charges_text), '^[0-9.]+$') "
    "THEN TRY_CAST(trim(charges_text) AS DOUBLE) END AS charges FROM gaps",
)
def filter_numeric_text(spark, root):
    gaps = gapped_customers(spark, root)
    return gaps.select("c_custkey", ex.numeric_text(F.col("charges_text")).alias("charges"))


@query(
    "blank_to_zero",
    WITH_GAPS + "SELECT c_custkey, CASE WHEN trim(charges_text) = '' THEN 0.0::DOUBLE "
    "ELSE TRY_CAST(trim(charges_text) AS DOUBLE) END AS charges FROM gaps",
)
def blank_to_zero(spark, root):
    gaps = gapped_customers(spark, root)
    return gaps.select("c_custkey", ex.blank_to_zero(F.col("charges_text")).alias("charges"))


IQR_TWO_SQL = """q AS (
  SELECT quantile_disc(l_quantity, 0.25) AS a1, quantile_disc(l_quantity, 0.75) AS a3,
         quantile_disc(l_extendedprice, 0.25) AS b1, quantile_disc(l_extendedprice, 0.75) AS b3
  FROM lineitem)"""


@query(
    "filter_multi_flag",
    f"WITH {IQR_TWO_SQL} SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem, q "
    "WHERE CAST(l_quantity < a1 - 0.25 * (a3 - a1) OR l_quantity > a3 + 0.25 * (a3 - a1) AS INTEGER) "
    "+ CAST(l_extendedprice < b1 - 0.25 * (b3 - b1) OR l_extendedprice > b3 + 0.25 * (b3 - b1) AS INTEGER) < 2",
)
def filter_multi_flag(spark, root):
    lines = table(spark, root, "lineitem")
    bounds = persist_state(outliers.fit_iqr(lines, ["l_quantity", "l_extendedprice"], factor=0.25, exact=True))
    kept = outliers.remove(lines, bounds, min_outliers=2)
    return kept.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")


# --- joins -----------------------------------------------------------------------------


@query(
    "join_pred_truth",
    f"WITH {PREDICTIONS_SQL} SELECT doc_id, round(score, 6) AS score, prediction, label FROM joined",
)
def join_pred_truth(spark, root):
    return rounded(monitor.with_truth(document_predictions(spark, root), document_truth(spark, root), ["doc_id"]))


@query(
    "join_split_anti",
    f"SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey NOT IN "
    f"(SELECT o_orderkey FROM orders WHERE {bucket_sql('o_orderkey')} < 2000)",
)
def join_split_anti(spark, root):
    """Training rows as all rows whose key is not in the sampled test rows."""
    orders = table(spark, root, "orders")
    test = projection.sample_fraction(orders, 0.2, ["o_orderkey"])
    return projection.without(orders, test, ["o_orderkey"]).select("o_orderkey", "o_orderstatus")


@query(
    "join_category_align",
    f"""SELECT coalesce(a.event_type, b.event_type) AS value, coalesce(a.n, 0) AS ref, coalesce(b.n, 0) AS cur
FROM (SELECT event_type, count(*) AS n FROM events WHERE ts < TIMESTAMP '{SPLIT_DAY}' GROUP BY 1) a
FULL OUTER JOIN (SELECT event_type, count(*) AS n FROM events WHERE ts >= TIMESTAMP '{SPLIT_DAY}' GROUP BY 1) b
ON a.event_type = b.event_type""",
)
def join_category_align(spark, root):
    reference, current = event_halves(spark, root)
    return drift.aligned_counts(reference, current, ["event_type"]).select("value", "ref", "cur")


@query(
    "join_stats_apply",
    """SELECT l_orderkey, l_linenumber,
round((l_extendedprice - (SELECT avg(l_extendedprice) FROM lineitem)) / (SELECT stddev_samp(l_extendedprice) FROM lineitem), 6) AS z
FROM lineitem""",
)
def join_stats_apply(spark, root):
    """Fitted statistics reach every row as a scalar subquery, without a join."""
    lines = table(spark, root, "lineitem")
    row = scalar_row(scaling.fit_moments(lines, ["l_extendedprice"]))["l_extendedprice"]
    z = (F.col("l_extendedprice") - row["mean"]) / row["std"]
    return rounded(lines.select("l_orderkey", "l_linenumber", z.alias("z")))


@query(
    "join_code_lookup",
    """WITH counts AS (SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand),
codes AS (SELECT p_brand, CAST(row_number() OVER (ORDER BY n DESC, p_brand) - 1 AS INTEGER) AS code FROM counts)
SELECT p_partkey, part.p_brand, code AS p_brand_index FROM part LEFT JOIN codes ON part.p_brand = codes.p_brand""",
)
def join_code_lookup(spark, root):
    part = table(spark, root, "part").select("p_partkey", "p_brand")
    return encoding.apply_index(part, encoding.fit_index(part, ["p_brand"]), ["p_brand"])


# --- sorts, limits, samples ------------------------------------------------------------

RULES_SQL = """rules AS (
  SELECT m.model, s.label, CASE m.model WHEN 'score' THEN s.score WHEN 'discount' THEN s.d ELSE s.q END AS p
  FROM (SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label, l_discount * 10 AS d, l_quantity / 50 AS q,
               round((l_discount * 10 + l_quantity / 50) / 2, 4) AS score FROM lineitem) s,
       (VALUES ('score'), ('discount'), ('quantity')) m(model))"""


def rule_predictions(spark, root, cuts):
    """(algorithm, trial, cut, label, prediction) of formula models at several cut-offs, one scan."""
    lines = table(spark, root, "lineitem").select(
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("label"), "l_discount", "l_quantity"
    )
    lines = lines.withColumn("score", F.round((F.col("l_discount") * 10 + F.col("l_quantity") / 50) / 2, 4))
    rules = {"score": F.col("score"), "discount": F.col("l_discount") * 10, "quantity": F.col("l_quantity") / 50}
    records = [
        F.struct(
            F.lit(name).alias("algorithm"),
            F.lit(i + 1).alias("trial"),
            F.lit(f"cut={cut}").alias("params"),
            F.when(value > cut, 1).otherwise(0).alias("prediction"),
        )
        for name, value in rules.items()
        for i, cut in enumerate(cuts)
    ]
    return lines.select("label", F.inline(F.array(*records)))


def rule_metrics_sql(group: str, where: str = "") -> str:
    return f"""SELECT {group},
  avg(CASE WHEN label = y THEN 1.0::DOUBLE ELSE 0 END) AS accuracy,
  coalesce(2.0::DOUBLE * count(*) FILTER (WHERE label = 1 AND y = 1)
    / nullif(2 * count(*) FILTER (WHERE label = 1 AND y = 1) + count(*) FILTER (WHERE label = 0 AND y = 1) + count(*) FILTER (WHERE label = 1 AND y = 0), 0), 0) AS f1_score
  FROM calls {where} GROUP BY {group}"""


@query(
    "rank_models",
    f"""WITH {RULES_SQL},
calls AS (SELECT model, label, CASE WHEN p > 0.55 THEN 1 ELSE 0 END AS y FROM rules),
m AS ({rule_metrics_sql("model")})
SELECT model, round(accuracy, 6) AS accuracy, round(f1_score, 6) AS f1_score,
  row_number() OVER (ORDER BY accuracy DESC, model) = 1 AS is_best FROM m""",
)
def rank_models(spark, root):
    calls = rule_predictions(spark, root, [0.55]).withColumnRenamed("algorithm", "model")
    metrics = evaluate.binary_metrics(calls, "label", "prediction", ["model"])
    return rounded(evaluate.rank_models(metrics.select("model", "accuracy", "f1_score")))


@query(
    "compare_tuning",
    f"""WITH {RULES_SQL},
cuts AS (SELECT * FROM (VALUES (1, 0.15), (2, 0.35), (3, 0.55), (4, 0.75)) c(trial, cut)),
calls AS (SELECT model AS algorithm, trial, 'cut=' || CAST(cut AS VARCHAR) AS params, label,
          CASE WHEN p > cut THEN 1 ELSE 0 END AS y FROM rules, cuts),
m AS ({rule_metrics_sql("algorithm, trial, params")}),
b AS (SELECT *, row_number() OVER (PARTITION BY algorithm ORDER BY f1_score DESC, trial) AS r,
      count(*) OVER (PARTITION BY algorithm) AS trials FROM m)
SELECT algorithm, trial, params, round(f1_score, 6) AS best_score, trials,
  row_number() OVER (ORDER BY f1_score DESC, algorithm) = 1 AS is_best FROM b WHERE r = 1""",
)
def compare_tuning(spark, root):
    """Best cut-off per formula model by f1, and the overall winner."""
    calls = rule_predictions(spark, root, [0.15, 0.35, 0.55, 0.75])
    trials = evaluate.binary_metrics(calls, "label", "prediction", ["algorithm", "trial", "params"])
    return rounded(evaluate.best_trials(trials.withColumnRenamed("f1_score", "score")))


@query(
    "sample_fraction", f"SELECT l_orderkey, l_linenumber FROM lineitem WHERE {bucket_sql('l_orderkey')} < 1000"
)
def sample_fraction(spark, root):
    lines = table(spark, root, "lineitem").select("l_orderkey", "l_linenumber")
    return projection.sample_fraction(lines, 0.1, ["l_orderkey"])


@query(
    "sample_n",
    f"SELECT o_orderkey, o_orderpriority FROM orders ORDER BY md5('42:' || {PART_SQL.format(key='o_orderkey')}) LIMIT 1000",
)
def sample_n(spark, root):
    return projection.sample_rows(table(spark, root, "orders").select("o_orderkey", "o_orderpriority"), 1000, ["o_orderkey"])


@query(
    "sample_n_pair",
    f"SELECT c_custkey FROM customer ORDER BY md5('42:' || {PART_SQL.format(key='c_name')} || ':' || {PART_SQL.format(key='c_mktsegment')}) LIMIT 101",
)
def sample_n_pair(spark, root):
    """An exact number of rows by a key of two text columns."""
    return projection.sample_rows(table(spark, root, "customer"), 101, ["c_name", "c_mktsegment"]).select("c_custkey")


@query("limit_rows", "SELECT least(100, count(*)) AS n FROM orders")
def limit_rows(spark, root):
    return table(spark, root, "orders").limit(100).agg(F.count("*").alias("n"))


# --- set operations --------------------------------------------------------------------


@query(
    "set_union",
    "SELECT o_orderkey, o_orderstatus FROM orders UNION ALL "
    "SELECT l_orderkey, l_linestatus FROM lineitem",
)
def set_union(spark, root):
    lines = table(spark, root, "lineitem").select(
        F.col("l_linestatus").alias("o_orderstatus"), F.col("l_orderkey").alias("o_orderkey")
    )
    return table(spark, root, "orders").select("o_orderkey", "o_orderstatus").unionByName(lines)


@query(
    "set_except",
    "SELECT o_custkey, o_orderstatus FROM orders EXCEPT ALL "
    "SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderpriority = '1-URGENT'",
)
def set_except(spark, root):
    """Copies count: each row of the second table takes away one copy only."""
    orders = table(spark, root, "orders")
    urgent = orders.filter(F.col("o_orderpriority") == "1-URGENT")
    columns = ["o_custkey", "o_orderstatus"]
    return orders.select(*columns).exceptAll(urgent.select(*columns))


@query(
    "set_distinct",
    "SELECT DISTINCT value FROM (SELECT l_returnflag AS value FROM lineitem UNION ALL SELECT l_linestatus FROM lineitem)",
)
def set_distinct(spark, root):
    return projection.distinct_values(table(spark, root, "lineitem"), ["l_returnflag", "l_linestatus"])


# --- scalar functions ------------------------------------------------------------------


@query(
    "fn_case",
    "SELECT o_orderkey, CASE WHEN o_totalprice < 50000 THEN 'small' WHEN o_totalprice < 150000 THEN 'medium' "
    "ELSE 'large' END AS size FROM orders",
)
def fn_case(spark, root):
    price = F.col("o_totalprice")
    size = ex.first_match([(price < 50000, F.lit("small")), (price < 150000, F.lit("medium"))], F.lit("large"))
    return table(spark, root, "orders").select("o_orderkey", size.alias("size"))


@query(
    "fn_clip",
    WITH_GAPS + "SELECT c_custkey, CASE WHEN charges IS NULL THEN NULL ELSE least(greatest(charges, 500.0), 8000.0) END "
    "AS charges FROM gaps",
)
def fn_clip(spark, root):
    gaps = gapped_customers(spark, root)
    return gaps.select("c_custkey", ex.clip(F.col("charges"), F.lit(500.0), F.lit(8000.0)).alias("charges"))


@query(
    "fn_round_pct",
    f"WITH {SCORED_SQL} SELECT l_orderkey, l_linenumber, round(score * 100, 2) AS pct, "
    "CAST(CAST(round(score * 100) AS BIGINT) AS VARCHAR) || '%' AS pct_text FROM scored",
)
def fn_round_pct(spark, root):
    return scored_lines(spark, root).select(
        "l_orderkey", "l_linenumber", ex.percent(F.col("score")).alias("pct"), ex.percent_text(F.col("score")).alias("pct_text")
    )


@query(
    "fn_label",
    f"WITH {EVENTS_SQL} SELECT event_id, CASE WHEN prediction = 1.0 THEN 'Churn' ELSE 'Retained' END AS status "
    "FROM scored_events",
)
def fn_label(spark, root):
    scored = scored_events(table(spark, root, "events"))
    return scored.select("event_id", ex.prediction_label(F.col("prediction")).alias("status"))


@query(
    "fn_confidence",
    f"WITH {EVENTS_SQL} SELECT event_id, CASE WHEN abs(probability - 0.5) > 0.3 THEN 'high' ELSE 'medium' END "
    "AS confidence FROM scored_events",
)
def fn_confidence(spark, root):
    scored = scored_events(table(spark, root, "events"))
    return scored.select("event_id", ex.confidence(F.col("probability")).alias("confidence"))


@query(
    "fn_regex",
    "SELECT p_partkey, regexp_matches(p_brand, '^Brand#[1-3][0-9]$') AS low_brand FROM part",
)
def fn_regex(spark, root):
    return table(spark, root, "part").select("p_partkey", F.col("p_brand").rlike("^Brand#[1-3][0-9]$").alias("low_brand"))


@query(
    "fn_null_test",
    WITH_GAPS + "SELECT c_custkey, segment IS NULL AS no_segment, coalesce(isnan(charges), false) AS is_nan, "
    "coalesce(segment, 'MISSING') AS segment FROM gaps",
)
def fn_null_test(spark, root):
    return gapped_customers(spark, root).select(
        "c_custkey",
        F.col("segment").isNull().alias("no_segment"),
        F.isnan(F.coalesce("charges", F.lit(0.0))).alias("is_nan"),
        F.coalesce("segment", F.lit("MISSING")).alias("segment"),
    )


@query(
    "fn_cast",
    "SELECT l_orderkey, l_linenumber, TRY_CAST(l_returnflag AS DOUBLE) AS as_double, "
    "CAST(l_quantity > 25 AS INTEGER) AS as_int, CAST(l_linenumber AS DOUBLE) AS number FROM lineitem",
)
def fn_cast(spark, root):
    return table(spark, root, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_returnflag").try_cast("double").alias("as_double"),
        (F.col("l_quantity") > 25).cast("int").alias("as_int"),
        F.col("l_linenumber").cast("double").alias("number"),
    )


@query("fn_now", "SELECT o_orderkey, true AS of_this_run FROM orders")
def fn_now(spark, root):
    """Each row's scoring time: the time of the run, the same for all rows."""
    before = F.lit(datetime.now(timezone.utc)).cast("timestamp")
    stamped = table(spark, root, "orders").select("o_orderkey", F.current_timestamp().alias("prediction_timestamp"))
    one = stamped.agg((F.min("prediction_timestamp") == F.max("prediction_timestamp")).alias("one"))
    recent = F.col("prediction_timestamp").between(before - F.expr("INTERVAL 1 MINUTE"), before + F.expr("INTERVAL 1 HOUR"))
    return stamped.select("o_orderkey", F.coalesce(recent & one.scalar(), F.lit(False)).alias("of_this_run"))


@query(
    "fn_vector_get",
    "SELECT vec_id, round(CAST(embedding[1] AS DOUBLE), 6) AS first_value, round(CAST(embedding[8] AS DOUBLE), 6) AS eighth_value "
    "FROM embeddings",
)
def fn_vector_get(spark, root):
    vectors = table(spark, root, "embeddings").select("vec_id", array_to_vector("embedding").alias("v"))
    return rounded(
        vectors.select(
            "vec_id", ex.vector_get(F.col("v"), 0).alias("first_value"), ex.vector_get(F.col("v"), 7).alias("eighth_value")
        )
    )


@query(
    "fn_parse_date",
    "SELECT event_id, CAST(ts AS DATE) AS file_date, CAST(ts AS DATE) - INTERVAL 7 DAY <= DATE '2024-01-10' AS in_window FROM events",
)
def fn_parse_date(spark, root):
    """The date found in a file name made from each event's day, and a window test on it."""
    name = F.concat(F.lit("/data/predictions_"), F.date_format("ts", "yyyy-MM-dd"), F.lit(".csv"))
    named = table(spark, root, "events").select("event_id", ex.date_in_name(name, "predictions").alias("file_date"))
    return named.withColumn("in_window", F.date_sub("file_date", 7) <= F.lit("2024-01-10").cast("date"))
