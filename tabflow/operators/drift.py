"""Drift between a reference and a current table, all features in one plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabflow.functions.expressions import known, numeric_columns, text_columns
from tabflow.functions.ordered import exact_quantiles, running_totals, with_bucket
from tabflow.functions.pvalues import chi_square_tail, kolmogorov_tail
from tabflow.functions.state import entries, melt, scalar_row

# When a feature counts as drifted, and how strongly.
KS_LIMIT, KS_HIGH = 0.3, 0.5
CHI2_LIMIT, CHI2_HIGH, CHI2_MEDIUM = 0.05, 0.01, 0.03
PSI_LIMIT = 0.2
SHARE_FLOOR = 1e-4


def shared_features(reference: DataFrame, current: DataFrame) -> tuple[list[str], list[str]]:
    """Numeric and text columns that both tables have, by the current table's types."""
    numeric = [c for c in numeric_columns(current) if c in reference.columns]
    text = [c for c in text_columns(current) if c in reference.columns]
    return numeric, text


def shared_feature_table(reference: DataFrame, current: DataFrame) -> DataFrame:
    """(feature, kind, n_ref, n_cur): shared columns and their values on both sides.

    A feature can be tested when both counts are positive. One pass over each table.
    """
    numeric, text = shared_features(reference, current)
    kinds = {**{c: "numerical" for c in numeric}, **{c: "categorical" for c in text}}
    filled = lambda df: df.agg(*[F.count(known(df, c)).alias(c) for c in kinds])
    before = scalar_row(filled(reference))
    return entries(
        filled(current),
        [
            {"feature": F.lit(c), "kind": F.lit(kind), "n_ref": before[c], "n_cur": F.col(c)}
            for c, kind in kinds.items()
        ],
    )


def _both(reference: DataFrame, current: DataFrame, columns: list[str], kind: str) -> DataFrame:
    """Long form (feature, value, ref, cur) of both tables without NULL values."""
    ref = melt(reference, columns, kind=kind).select("*", F.lit(1).alias("ref"), F.lit(0).alias("cur"))
    cur = melt(current, columns, kind=kind).select("*", F.lit(0).alias("ref"), F.lit(1).alias("cur"))
    rows = ref.unionByName(cur).filter(F.col("value").isNotNull())
    return rows.filter(~F.isnan("value")) if kind == "double" else rows


def aligned_counts(reference: DataFrame, current: DataFrame, columns: list[str], kind: str = "string") -> DataFrame:
    """(feature, value, ref, cur): counts on both sides, 0 where a side lacks the value.

    The full outer alignment of two counts, as one count over the union: one shuffle of
    pre-aggregated rows and no join.
    """
    rows = _both(reference, current, columns, kind)
    return rows.groupBy("feature", "value").agg(F.sum("ref").alias("ref"), F.sum("cur").alias("cur"))


def drift_ks(reference: DataFrame, current: DataFrame, columns: list[str]) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov test per numeric feature."""
    counts = aligned_counts(reference, current, columns, "double")
    curve = running_totals(counts, ["feature"], "value", ["ref", "cur"])
    gap = F.abs(F.col("ref_run").cast("double") / F.col("ref_all") - F.col("cur_run").cast("double") / F.col("cur_all"))
    # a feature without values on one side has no test
    curve = curve.filter((F.col("ref_all") > 0) & (F.col("cur_all") > 0))
    tested = curve.groupBy("feature").agg(
        F.max(gap).alias("statistic"), F.max("ref_all").alias("n_ref"), F.max("cur_all").alias("n_cur")
    )
    d = F.col("statistic")
    return tested.select(
        "feature",
        "statistic",
        kolmogorov_tail(d, F.col("n_ref"), F.col("n_cur")).alias("p_value"),
        (d > KS_LIMIT).alias("drift_detected"),
        F.when(d > KS_HIGH, "high").when(d > KS_LIMIT, "medium").otherwise("low").alias("magnitude"),
    )


def drift_chi2(reference: DataFrame, current: DataFrame, columns: list[str], smoothing: float = 0.0) -> DataFrame:
    """Chi-square test per categorical feature, the reference scaled to the current total.

    A category new to the current table makes the statistic infinite (p = 0) unless
    `smoothing` rows are added to every reference category.
    """
    counts = aligned_counts(reference, current, columns)
    totals = counts.groupBy("feature").agg(
        F.sum("ref").alias("n_ref"), F.sum("cur").alias("n_cur"), F.count("*").alias("k")
    )
    totals = totals.filter((F.col("n_ref") > 0) & (F.col("n_cur") > 0))
    # one row per feature, so bounded by the columns of the table
    joined = counts.join(F.broadcast(totals), "feature")
    expected = (F.col("ref") + smoothing) / (F.col("n_ref") + smoothing * F.col("k")) * F.col("n_cur")
    part = F.when(expected > 0, (F.col("cur") - expected) ** 2 / expected).otherwise(
        F.when(F.col("cur") > 0, F.lit(float("inf"))).otherwise(F.lit(0.0))
    )
    tested = joined.groupBy("feature").agg(
        F.sum(part).alias("statistic"), (F.first("k") - 1).cast("int").alias("df")
    )
    tested = tested.withColumn("p_value", chi_square_tail(F.col("statistic"), F.col("df")))
    p = F.col("p_value")
    return tested.select(
        "feature",
        "statistic",
        "df",
        "p_value",
        (p < CHI2_LIMIT).alias("drift_detected"),
        F.when(p < CHI2_HIGH, "high").when(p < CHI2_MEDIUM, "medium").otherwise("low").alias("magnitude"),
    )


def reference_splits(reference: DataFrame, columns: list[str], bins: int = 10, exact: bool = False) -> DataFrame:
    """(feature, splits): inner quantiles of the reference table, the fitted state of PSI."""
    shares = [i / bins for i in range(1, bins)]
    if not exact:
        long = melt(reference, columns).filter(F.col("value").isNotNull() & ~F.isnan("value"))
        return long.groupBy("feature").agg(F.percentile_approx("value", shares, 10_000).alias("splits"))
    found = exact_quantiles(reference, columns, shares)
    # at most `bins` values per feature
    ordered = F.array_sort(F.collect_list(F.struct("position", "value")))
    return found.groupBy("feature").agg(F.transform(ordered, lambda s: s["value"]).alias("splits"))


def drift_psi(reference: DataFrame, current: DataFrame, columns: list[str], bins: int = 10, exact: bool = False):
    """Population stability index per numeric feature over bins of the reference."""
    state = reference_splits(reference, columns, bins, exact)
    splits = state.select(F.map_from_entries(F.collect_list(F.struct("feature", "splits")))).scalar()
    rows = _both(reference, current, columns, "double")
    binned = with_bucket(rows, "value", splits[F.col("feature")], bins - 1)
    counts = binned.groupBy("feature", "_bucket").agg(F.sum("ref").alias("ref"), F.sum("cur").alias("cur"))
    # at most `bins` rows per feature from here on
    totals = counts.groupBy("feature").agg(F.sum("ref").alias("n_ref"), F.sum("cur").alias("n_cur"))
    totals = totals.filter((F.col("n_ref") > 0) & (F.col("n_cur") > 0))
    shares = counts.join(F.broadcast(totals), "feature")
    r = F.greatest(F.col("ref").cast("double") / F.col("n_ref"), F.lit(SHARE_FLOOR))
    c = F.greatest(F.col("cur").cast("double") / F.col("n_cur"), F.lit(SHARE_FLOOR))
    psi = shares.groupBy("feature").agg(F.sum((c - r) * F.log(c / r)).alias("psi"))
    return psi.withColumn("drift_detected", F.col("psi") > PSI_LIMIT)


def drift_score(ks: DataFrame, chi2: DataFrame, features: int) -> DataFrame:
    """One row: overall flag, drifted features, and the score averaged over all features.

    A drifted numeric feature adds its statistic, a drifted categorical one 1 - p.
    """
    numeric = ks.select("drift_detected", F.col("statistic").alias("weight"))
    text = chi2.select("drift_detected", (1 - F.col("p_value")).alias("weight"))
    hit = F.col("drift_detected")
    total: Column = F.coalesce(F.sum(F.when(hit, F.col("weight"))), F.lit(0.0))
    return numeric.unionByName(text).agg(
        F.coalesce(F.bool_or(hit), F.lit(False)).alias("overall_drift_detected"),
        F.count_if(hit).alias("drifted_features"),
        (total / float(max(features, 1))).alias("drift_score"),
    )
