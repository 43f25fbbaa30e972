"""Queries: missing values, outliers, binning, encoding, scaling, splitting, and all of them together."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabflow.operators import binning, encoding, missing, outliers, profile, scaling, split
from tabflow.plans import prepare
from tabflow.plans.inputs import GAPS_SQL, WITH_CUSTOMERS, WITH_GAPS, gapped_customers
from tabflow.plans.profiling import LINE_NUMBERS, TENURE_CASE, long_sql
from tabflow.plans.registry import query, rounded
from tabflow.plans.relational import PART_SQL, PRIORITY_CASE, PRIORITY_CODES, bucket_sql
from tabflow.sources.shared import persist_state
from tabflow.sources.tables import customers, table

# --- missing values --------------------------------------------------------------------


@query("impute_drop_critical", WITH_GAPS + "SELECT c_custkey, charges, segment FROM gaps WHERE charges IS NOT NULL")
def impute_drop_critical(spark, root):
    kept = missing.drop_missing(gapped_customers(spark, root), ["charges"])
    return kept.select("c_custkey", "charges", "segment")


@query(
    "impute_drop_any",
    WITH_GAPS + "SELECT c_custkey, charges, segment FROM gaps WHERE charges IS NOT NULL AND segment IS NOT NULL",
)
def impute_drop_any(spark, root):
    return missing.drop_missing(gapped_customers(spark, root).select("c_custkey", "charges", "segment"))


@query(
    "impute_mean",
    WITH_GAPS + "SELECT c_custkey, round(coalesce(charges, (SELECT avg(charges) FROM gaps)), 6) AS charges FROM gaps",
)
def impute_mean(spark, root):
    gaps = gapped_customers(spark, root).select("c_custkey", "charges")
    return rounded(missing.apply_fill(gaps, missing.fit_fill(gaps, ["charges"], "mean")))


@query(
    "impute_median",
    WITH_GAPS + "SELECT c_custkey, coalesce(charges, (SELECT quantile_disc(charges, 0.5) FROM gaps)) AS charges FROM gaps",
)
def impute_median(spark, root):
    gaps = gapped_customers(spark, root).select("c_custkey", "charges")
    state = persist_state(missing.fit_fill(gaps, ["charges"], "median", exact=True))
    return missing.apply_fill(gaps, state)


@query(
    "impute_mode",
    WITH_GAPS + """SELECT c_custkey, coalesce(segment, (SELECT segment FROM gaps WHERE segment IS NOT NULL
GROUP BY segment ORDER BY count(*) DESC, segment LIMIT 1)) AS segment FROM gaps""",
)
def impute_mode(spark, root):
    gaps = gapped_customers(spark, root).select("c_custkey", "segment")
    return missing.apply_fill(gaps, missing.fit_fill(gaps, ["segment"], "mode"))


@query(
    "impute_constant",
    WITH_GAPS + "SELECT c_custkey, coalesce(charges, -1.0) AS charges, coalesce(segment, 'none') AS segment FROM gaps",
)
def impute_constant(spark, root):
    gaps = gapped_customers(spark, root).select("c_custkey", "charges", "segment")
    return missing.fill_constant(missing.fill_constant(gaps, -1.0, ["charges"]), "none")


@query(
    "impute_all_numeric",
    WITH_GAPS + """, wide AS (SELECT charges, CASE WHEN order_count > 8 THEN total_spend END AS spend FROM gaps)
SELECT round(coalesce(charges, (SELECT avg(charges) FROM wide)), 4) AS charges,
round(coalesce(spend, (SELECT avg(spend) FROM wide)), 4) AS spend FROM wide""",
)
def impute_all_numeric(spark, root):
    gaps = gapped_customers(spark, root)
    wide = gaps.select("charges", F.when(F.col("order_count") > 8, F.col("total_spend")).alias("spend"))
    return rounded(missing.fill_all_numeric(wide), 4)


@query("impute_placeholder", WITH_GAPS + "SELECT c_custkey, coalesce(segment, 'MISSING') AS segment FROM gaps")
def impute_placeholder(spark, root):
    return missing.placeholder(gapped_customers(spark, root).select("c_custkey", "segment"), ["segment"])


# --- outliers --------------------------------------------------------------------------

FACTOR = 0.5
PRICE_BOUNDS = f"""q AS (SELECT quantile_disc(l_extendedprice, 0.25) AS q1, quantile_disc(l_extendedprice, 0.75) AS q3 FROM lineitem),
b AS (SELECT q1 - {FACTOR} * (q3 - q1) AS lower, q3 + {FACTOR} * (q3 - q1) AS upper FROM q)"""


def price_bounds(lines):
    return persist_state(outliers.fit_iqr(lines, ["l_extendedprice"], FACTOR, exact=True), "bounds")


@query(
    "outlier_iqr_bounds",
    long_sql(
        "lineitem",
        LINE_NUMBERS,
        "round(quantile_disc({c}, 0.25) - 1.5 * (quantile_disc({c}, 0.75) - quantile_disc({c}, 0.25)), 6) AS lower, "
        "round(quantile_disc({c}, 0.75) + 1.5 * (quantile_disc({c}, 0.75) - quantile_disc({c}, 0.25)), 6) AS upper",
    ),
)
def outlier_iqr_bounds(spark, root):
    return rounded(outliers.bounds_table(outliers.fit_iqr(table(spark, root, "lineitem"), LINE_NUMBERS, exact=True)))


@query(
    "outlier_iqr_flag",
    f"WITH {PRICE_BOUNDS} SELECT l_orderkey, l_linenumber, l_extendedprice < lower OR l_extendedprice > upper "
    "AS l_extendedprice_outlier FROM lineitem, b",
)
def outlier_iqr_flag(spark, root):
    lines = table(spark, root, "lineitem")
    flagged = outliers.flag(lines, price_bounds(lines))
    return flagged.select("l_orderkey", "l_linenumber", "l_extendedprice_outlier")


@query(
    "outlier_remove",
    f"WITH {PRICE_BOUNDS} SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem, b "
    "WHERE NOT (l_extendedprice < lower OR l_extendedprice > upper)",
)
def outlier_remove(spark, root):
    lines = table(spark, root, "lineitem")
    kept = outliers.handle(lines, price_bounds(lines), "remove", min_outliers=1)
    return kept.select("l_orderkey", "l_linenumber", "l_extendedprice")


@query(
    "outlier_cap",
    f"WITH {PRICE_BOUNDS} SELECT l_orderkey, l_linenumber, round(least(greatest(l_extendedprice, lower), upper), 4) "
    "AS l_extendedprice FROM lineitem, b",
)
def outlier_cap(spark, root):
    lines = table(spark, root, "lineitem")
    capped = outliers.handle(lines, price_bounds(lines), "cap")
    return rounded(capped.select("l_orderkey", "l_linenumber", "l_extendedprice"), 4)


@query(
    "outlier_zscore",
    "WITH m AS (SELECT avg(value) AS a, stddev_samp(value) AS s FROM events) "
    "SELECT event_id, value FROM events, m WHERE abs(value - a) / s > 3.0",
)
def outlier_zscore(spark, root):
    events = table(spark, root, "events")
    flagged = outliers.flag(events, outliers.fit_zscore(events, ["value"]))
    return flagged.filter("value_outlier").select("event_id", "value")


# --- binning ---------------------------------------------------------------------------


@query("bin_custom", WITH_CUSTOMERS + f"SELECT c_custkey, {TENURE_CASE} AS tenure_monthsBins FROM cust")
def bin_custom(spark, root):
    base = customers(spark, root).select("c_custkey", "tenure_months")
    return binning.bin_custom(base, "tenure_months", binning.TENURE_BINS)


@query(
    "bin_custom_inference",
    WITH_CUSTOMERS + f"SELECT c_custkey, tenure_months, replace({TENURE_CASE}, 'Invalid', 'Unknown') AS tenure_bin FROM cust",
)
def bin_custom_inference(spark, root):
    base = customers(spark, root).select("c_custkey", "tenure_months")
    return binning.bin_custom(base, "tenure_months", binning.TENURE_BINS, binning.UNKNOWN, "tenure_bin", keep=True)


@query(
    "bin_bucketizer",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity >= 5 AND l_quantity < 15 THEN 'few' WHEN l_quantity >= 15 AND l_quantity < 30 THEN 'some'
WHEN l_quantity >= 30 AND l_quantity <= 45 THEN 'many' ELSE 'Unknown' END AS l_quantityBins FROM lineitem""",
)
def bin_bucketizer(spark, root):
    lines = table(spark, root, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return binning.bin_buckets(lines, "l_quantity", [5, 15, 30, 45], ["few", "some", "many"])


@query(
    "bin_bucketizer_index",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity < 15 THEN 0.0::DOUBLE WHEN l_quantity < 30 THEN 1.0::DOUBLE
ELSE 2.0::DOUBLE END AS l_quantityBins FROM lineitem WHERE l_quantity BETWEEN 5 AND 45""",
)
def bin_bucketizer_index(spark, root):
    """Bucket numbers without labels; rows outside the splits are skipped."""
    lines = table(spark, root, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return binning.bin_buckets(lines, "l_quantity", [5, 15, 30, 45], handle_invalid="skip")


# --- encoding --------------------------------------------------------------------------


def codes_sql(source: str, column: str) -> str:
    return f"""(SELECT coalesce({column}, 'MISSING') AS category,
  CAST(row_number() OVER (ORDER BY count(*) DESC, coalesce({column}, 'MISSING')) - 1 AS INTEGER) AS code
  FROM {source} GROUP BY coalesce({column}, 'MISSING'))"""


@query(
    "encode_index",
    WITH_GAPS + f"SELECT c_custkey, segment, code AS segment_index FROM gaps "
    f"JOIN {codes_sql('gaps', 'segment')} ON category = coalesce(segment, 'MISSING')",
)
def encode_index(spark, root):
    gaps = gapped_customers(spark, root).select("c_custkey", "segment")
    return encoding.apply_index(gaps, encoding.fit_index(gaps, ["segment"]), ["segment"])


@query(
    "encode_label_map",
    "SELECT 'p_brand' AS feature, * FROM " + codes_sql("part", "p_brand")
    + " UNION ALL SELECT 'p_type', * FROM " + codes_sql("part", "p_type")
    + " UNION ALL SELECT 'p_name', * FROM " + codes_sql("part", "p_name"),
)
def encode_label_map(spark, root):
    return encoding.fit_index(table(spark, root, "part"), ["p_brand", "p_type", "p_name"])


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY"]


@query(
    "encode_onehot",
    "SELECT c_custkey, " + ", ".join(f"CAST(c_mktsegment = '{s}' AS INTEGER) AS c_mktsegment_{s}" for s in SEGMENTS)
    + ", CAST(c_mktsegment NOT IN (" + ", ".join(f"'{s}'" for s in SEGMENTS) + ") AS INTEGER) AS c_mktsegment_other FROM customer",
)
def encode_onehot(spark, root):
    base = table(spark, root, "customer").select("c_custkey", "c_mktsegment")
    return encoding.one_hot(base, "c_mktsegment", SEGMENTS).drop("c_mktsegment")


KNOWN_PRIORITIES = {text: code for text, code in PRIORITY_CODES.items() if code < 4}


@query(
    "encode_ordinal",
    "SELECT o_orderkey, " + PRIORITY_CASE.replace(" WHEN '5-LOW' THEN 4", "") + " END AS o_orderpriority FROM orders",
)
def encode_ordinal(spark, root):
    """Fixed codes; the lowest priority is left out of the map and becomes NULL."""
    orders = table(spark, root, "orders").select("o_orderkey", "o_orderpriority")
    return encoding.encode_ordinal(orders, {"o_orderpriority": KNOWN_PRIORITIES})


@query(
    "encode_ordinal_inference",
    "SELECT o_orderkey, " + PRIORITY_CASE.replace(" WHEN '5-LOW' THEN 4", "") + " ELSE 0 END AS o_orderpriority FROM orders",
)
def encode_ordinal_inference(spark, root):
    orders = table(spark, root, "orders").select("o_orderkey", "o_orderpriority")
    return encoding.encode_ordinal(orders, {"o_orderpriority": KNOWN_PRIORITIES}, unmapped="default", default=0)


@query(
    "encode_target",
    "SELECT l_orderkey, l_linenumber, CASE WHEN l_linestatus = 'O' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label FROM lineitem",
)
def encode_target(spark, root):
    """MLlib's indexer in text order: F before O."""
    lines = table(spark, root, "lineitem").select("l_orderkey", "l_linenumber", "l_linestatus")
    model = encoding.target_stage("l_linestatus").fit(lines)
    return model.transform(lines).select("l_orderkey", "l_linenumber", "label")


@query("decode_index", "SELECT p_partkey, p_type AS name FROM part")
def decode_index(spark, root):
    part = table(spark, root, "part").select("p_partkey", "p_type")
    codes = encoding.fit_index(part, ["p_type"])
    indexed = encoding.apply_index(part, codes, ["p_type"]).select("p_partkey", "p_type_index")
    return encoding.decode_index(indexed, codes, "p_type", "name").select("p_partkey", "name")


# --- scaling ---------------------------------------------------------------------------


@query(
    "scale_minmax",
    """WITH s AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi, min(l_tax) AS a, max(l_tax) AS b FROM lineitem)
SELECT l_orderkey, l_linenumber, round((l_extendedprice - lo) / (hi - lo), 6) AS l_extendedprice, round((l_tax - a) / (b - a), 6) AS l_tax FROM lineitem, s""",
)
def scale_minmax(spark, root):
    lines = table(spark, root, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_tax")
    return rounded(scaling.scale_minmax(lines, scaling.fit_moments(lines, ["l_extendedprice", "l_tax"])))


@query(
    "scale_standard",
    """WITH s AS (SELECT avg(l_extendedprice) AS m, stddev_samp(l_extendedprice) AS d FROM lineitem)
SELECT l_orderkey, l_linenumber, round((l_extendedprice - m) / d, 6) AS l_extendedprice FROM lineitem, s""",
)
def scale_standard(spark, root):
    lines = table(spark, root, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return rounded(scaling.scale_standard(lines, scaling.fit_moments(lines, ["l_extendedprice"])))


@query(
    "scale_stats",
    """WITH s AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi, min(l_quantity) AS a, max(l_quantity) AS b FROM lineitem),
v AS (SELECT (l_extendedprice - lo) / (hi - lo) AS l_extendedprice, (l_quantity - a) / (b - a) AS l_quantity FROM lineitem, s) """
    + long_sql(
        "v",
        ["l_extendedprice", "l_quantity"],
        "round(min({c}), 6) AS min, round(max({c}), 6) AS max, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std",
    ),
)
def scale_stats(spark, root):
    lines, columns = table(spark, root, "lineitem"), ["l_extendedprice", "l_quantity"]
    scaled = scaling.scale_minmax(lines, scaling.fit_moments(lines, columns))
    return rounded(profile.moments(scaled, columns))


@query(
    "scale_fit_train_apply_test",
    WITH_CUSTOMERS + f""", parts AS (SELECT *, {bucket_sql('c_custkey')} < 2000 AS is_test FROM cust),
s AS (SELECT min(total_spend) AS lo, max(total_spend) AS hi FROM parts WHERE NOT is_test)
SELECT c_custkey, CASE WHEN is_test THEN 'test' ELSE 'train' END AS split, round((total_spend - lo) / (hi - lo), 6) AS total_spend FROM parts, s""",
)
def scale_fit_train_apply_test(spark, root):
    """The range comes from the training rows only and scales both parts."""
    parts = split.assign_random(customers(spark, root), ["c_custkey"]).select("c_custkey", "split", "total_spend")
    state = scaling.fit_moments(split.part(parts, "train"), ["total_spend"])
    return rounded(scaling.scale_minmax(parts, state))


def scaled_sql(column: str) -> str:
    return f"round(({column} - min({column}) OVER ()) / (max({column}) OVER () - min({column}) OVER ()), 6)"


@query(
    "scale_vector",
    "SELECT l_orderkey, l_linenumber, " + ", ".join(f"{scaled_sql(c)} AS f{i}" for i, c in enumerate(["l_quantity", "l_extendedprice", "l_tax"])) + " FROM lineitem",
)
def scale_vector(spark, root):
    """MLlib's scaler over an assembled vector."""
    lines = table(spark, root, "lineitem")
    vectors = scaling.assemble(lines, ["l_quantity", "l_extendedprice", "l_tax"], output="features_unscaled")
    scaled = scaling.vector_scaler().fit(vectors).transform(vectors)
    parts = vector_to_array("features")
    return rounded(scaled.select("l_orderkey", "l_linenumber", *[parts[i].alias(f"f{i}") for i in range(3)]))


@query(
    "assemble_features",
    WITH_GAPS + "SELECT c_custkey, CAST(charges AS DOUBLE) AS f0, total_spend AS f1, CAST(tenure_months AS DOUBLE) AS f2 "
    "FROM gaps WHERE charges IS NOT NULL",
)
def assemble_features(spark, root):
    """Vector assembly that skips invalid rows, shown as an array."""
    vectors = scaling.assemble(gapped_customers(spark, root), ["charges", "total_spend", "tenure_months"], "skip")
    parts = vector_to_array("features")
    return vectors.select("c_custkey", *[parts[i].alias(f"f{i}") for i in range(3)])


# --- splitting -------------------------------------------------------------------------


@query(
    "split_random",
    f"SELECT o_orderkey, CASE WHEN {bucket_sql('o_orderkey')} < 2000 THEN 'test' ELSE 'train' END AS split FROM orders",
)
def split_random(spark, root):
    return split.assign_random(table(spark, root, "orders"), ["o_orderkey"]).select("o_orderkey", "split")


def stratified_sql(rows: str, columns: str, stratum: str, key: str, rule: str = "quota") -> str:
    place = f"row_number() OVER (PARTITION BY {stratum} ORDER BY md5('42:' || {key}))"
    quota = f"floor(count(*) OVER (PARTITION BY {stratum}) * 0.2::DOUBLE)"
    test = f"{place} <= {quota}" if rule == "quota" else f"CAST('0x' || substr(md5('42:' || {key}), 1, 8) AS BIGINT) % 10000 < 2000"
    return f"SELECT {columns}, CASE WHEN {test} THEN 'test' ELSE 'train' END AS split, '{rule}' AS split_rule FROM {rows}"


@query("split_stratified", stratified_sql("orders", "o_orderkey, o_orderstatus", "o_orderstatus", PART_SQL.format(key="o_orderkey")))
def split_stratified(spark, root):
    orders = table(spark, root, "orders").select("o_orderkey", "o_orderstatus")
    state = split.fit_stratified(orders, "o_orderstatus", ["o_orderkey"])
    return split.assign_stratified(orders, state, "o_orderstatus", ["o_orderkey"])


PAIR_SQL = PART_SQL.format(key="c_name") + " || ':' || " + PART_SQL.format(key="c_mktsegment")


@query("split_stratified_pair", stratified_sql("customer", "c_custkey, c_nationkey", "c_nationkey", PAIR_SQL))
def split_stratified_pair(spark, root):
    """Quotas by a key of two text columns."""
    rows, keys = table(spark, root, "customer"), ["c_name", "c_mktsegment"]
    state = split.fit_stratified(rows, "c_nationkey", keys)
    done = split.assign_stratified(rows, state, "c_nationkey", keys, on_small_class="quota")
    return done.select("c_custkey", "c_nationkey", "split", "split_rule")


@query(
    "split_stratified_fallback",
    stratified_sql(
        "(SELECT c_custkey, CASE WHEN c_custkey = 1 THEN 'rare' ELSE c_mktsegment END AS segment FROM customer)",
        "c_custkey, segment", "segment", PART_SQL.format(key="c_custkey"), "random",
    ),
)
def split_stratified_fallback(spark, root):
    """One class of a single row: all rows are split by the random rule, and say so."""
    segment = F.when(F.col("c_custkey") == 1, "rare").otherwise(F.col("c_mktsegment")).alias("segment")
    rows = table(spark, root, "customer").select("c_custkey", segment)
    state = split.fit_stratified(rows, "segment", ["c_custkey"])
    return split.assign_stratified(rows, state, "segment", ["c_custkey"])


@query(
    "split_xy",
    WITH_CUSTOMERS + f""", parts AS (SELECT *, CASE WHEN {bucket_sql('c_custkey')} < 2000 THEN 'test' ELSE 'train' END AS s FROM cust)
SELECT 'X_' || s AS part, c_custkey, round(total_spend, 2) AS value FROM parts
UNION ALL SELECT 'Y_' || s, c_custkey, CAST(churned AS DOUBLE) FROM parts""",
)
def split_xy(spark, root):
    """The rows of the four tables."""
    base = customers(spark, root).select("c_custkey", "total_spend", "churned")
    parts = split.four_way(split.assign_random(base, ["c_custkey"]), "churned", "c_custkey")
    united = None
    for name, frame in parts.items():
        value = F.col("total_spend" if name.startswith("X") else "churned").cast("double").alias("value")
        rows = frame.select(F.lit(name).alias("part"), "c_custkey", value)
        united = rows if united is None else united.unionByName(rows)
    return rounded(united, 2)


@query(
    "split_kfold",
    f"SELECT CAST({bucket_sql('l_orderkey', 'fold', 5)} AS INTEGER) AS fold, count(*) AS n FROM lineitem GROUP BY 1",
)
def split_kfold(spark, root):
    folded = split.assign_folds(table(spark, root, "lineitem"), ["l_orderkey"], 5)
    return folded.groupBy("fold").agg(F.count("*").alias("n"))


@query(
    "split_validation",
    f"""SELECT o_orderkey, CASE WHEN {bucket_sql('o_orderkey')} < 2000 THEN 'test'
WHEN {bucket_sql('o_orderkey')} < 4000 THEN 'validation' ELSE 'train' END AS split FROM orders""",
)
def split_validation(spark, root):
    return split.assign_three_way(table(spark, root, "orders"), ["o_orderkey"]).select("o_orderkey", "split")


# --- everything together ---------------------------------------------------------------

ROLES = prepare.Roles(
    key="c_custkey",
    target="churned",
    numeric=["charges", "total_spend"],
    nominal=["segment"],
    capped=["charges", "total_spend"],
    bins={"tenure_months": binning.TENURE_BINS},
    ordinal={"tenure_monthsBins": encoding.TENURE_CODES},
    drop=["c_nationkey", "charges_text"],
)


@query(
    "prepare_customers",
    f"""WITH {GAPS_SQL},
parts AS (SELECT *, {bucket_sql('c_custkey')} < 2000 AS is_test FROM gaps),
means AS (SELECT avg(charges) AS mc, avg(total_spend) AS ms FROM parts WHERE NOT is_test),
filled AS (SELECT c_custkey, segment, tenure_months, churned, is_test, coalesce(charges, mc) AS charges,
           coalesce(total_spend, ms) AS spend FROM parts, means),
q AS (SELECT quantile_disc(charges, 0.25) AS c1, quantile_disc(charges, 0.75) AS c3,
             quantile_disc(spend, 0.25) AS s1, quantile_disc(spend, 0.75) AS s3 FROM filled WHERE NOT is_test),
capped AS (SELECT c_custkey, segment, tenure_months, churned, is_test,
             least(greatest(charges, c1 - 1.5 * (c3 - c1)), c3 + 1.5 * (c3 - c1)) AS charges,
             least(greatest(spend, s1 - 1.5 * (s3 - s1)), s3 + 1.5 * (s3 - s1)) AS spend FROM filled, q),
r AS (SELECT min(charges) AS c_lo, max(charges) AS c_hi, min(spend) AS s_lo, max(spend) AS s_hi FROM capped WHERE NOT is_test),
codes AS {codes_sql("(SELECT segment FROM parts WHERE NOT is_test)", "segment")},
done AS (SELECT CASE WHEN is_test THEN 'test' ELSE 'train' END AS split, c_custkey, churned,
  CASE WHEN tenure_months BETWEEN 0 AND 24 THEN 0 WHEN tenure_months BETWEEN 25 AND 48 THEN 1
       WHEN tenure_months BETWEEN 49 AND 72 THEN 2 END AS tenure_code,
  code, (charges - c_lo) / (c_hi - c_lo) AS charges, (spend - s_lo) / (s_hi - s_lo) AS spend
  FROM capped, r, codes WHERE category = coalesce(segment, 'MISSING'))
SELECT split, c_custkey, churned, tenure_code, CAST(code AS INTEGER) AS segment_index, round(charges, 6) AS charges, round(spend, 6) AS total_spend FROM done""",
)
def prepare_customers(spark, root):
    """Split, fit every step on the training part, apply to both: one row per customer.

    The customer table is joined and reduced once and written; the fits read it from there.
    """
    base = persist_state(gapped_customers(spark, root), "customers")
    parts = split.assign_random(base, ["c_custkey"])
    done = prepare.fit(split.part(parts, "train"), ROLES).apply(parts)
    columns = ["split", "c_custkey", "churned", F.col("tenure_monthsBins").alias("tenure_code"), "segment_index"]
    return rounded(done.select(*columns, "charges", "total_spend"))
