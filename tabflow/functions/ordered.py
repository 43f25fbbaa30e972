"""Quantiles, order statistics and running totals that never sort a whole group in one task.

Running totals sort distinct values by ranges, add up each range, and run a window inside a range
only. Exact quantiles bracket their rank by approximate percentiles and order only the brackets.
Quotas by digest count digits of the digest until the interval that holds the quota is small.
Nothing here is bounded by the number of groups, and a NULL group is a group.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabflow.functions.expressions import known
from tabflow.functions.state import STATE, null_safe_join, with_state
from tabflow.sources.shared import persist_state

BRACKET_ACCURACY = 50_000  # rank error of the percentiles that bracket an exact quantile
SORTED_ROWS = 50_000  # digests of one group that a task may put in order
DIGITS = 3  # hexadecimal digits of a digest that are counted in one round


def with_bucket(df: DataFrame, value: str, splits: Column, most: int) -> DataFrame:
    """Add `_bucket`: how many of the sorted split points, at most `most`, are <= the value.

    A binary search written as one projection per step, so it stays in generated code.
    """
    out = df.withColumns({"_splits": splits, "_bucket": F.lit(0)})
    for jump in (2**i for i in reversed(range(most.bit_length()))):
        at = F.col("_bucket")
        reached = F.get("_splits", at + jump - 1) <= F.col(value)
        out = out.withColumn("_bucket", at + F.when(reached, jump).otherwise(0))
    return out.drop("_splits")


def in_ranges(df: DataFrame, order: list[Column]) -> DataFrame:
    """The rows with `_range` and `_within`: ranges of the whole order and each row's place in its own.

    Ranges hold about equally many rows, as many ranges as the shuffle has partitions. They are
    written first, so a retried task cannot change them.
    """
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return persist_state(ranged.select("*", F.spark_partition_id().alias("_range"), within.alias("_within")), "ranges")


def running_totals(counts: DataFrame, keys: list[str], value: str, measures: list[str]) -> DataFrame:
    """Add `<m>_run` (sum up to and including the value) and `<m>_all` (group sum) to distinct
    rows (keys, value).

    The range totals have one row per range and one more per group; a window over values runs
    inside a range only.
    """
    rows = in_ranges(counts.select(*keys, value, *measures), [*map(F.col, keys), F.col(value)])
    inside = rows.groupBy(*keys, "_range").agg(*[F.sum(m).alias(f"_in_{m}") for m in measures])
    group = Window.partitionBy(*keys)
    earlier = group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = inside.select(
        *keys,
        "_range",
        *[F.coalesce(F.sum(f"_in_{m}").over(earlier), F.lit(0)).alias(f"_before_{m}") for m in measures],
        *[F.sum(f"_in_{m}").over(group).alias(f"{m}_all") for m in measures],
    )
    joined = null_safe_join(rows, totals, [*keys, "_range"])
    upto = Window.partitionBy(*keys, "_range").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    return joined.select(
        *keys,
        value,
        *measures,
        *[(F.sum(m).over(upto) + F.col(f"_before_{m}")).alias(f"{m}_run") for m in measures],
        *[f"{m}_all" for m in measures],
    )


def digest_quota(digests: DataFrame, keys: list[str], quota: Callable[[Column], Column]) -> DataFrame:
    """Rows (keys, rows, quota, digest): per group the smallest digest up to which `quota` rows lie.

    `digests` has the columns keys and `digest` (hexadecimal text); `quota` maps the number of rows to
    the wanted one, and a group without any has no digest. Rows are counted by leading digits with
    map-side sums, and the interval that holds the quota by further digits, until no interval holds
    more than SORTED_ROWS; only those rows are put in order.
    """
    digits = lambda taken: F.substring("digest", taken + 1, DIGITS)
    group = Window.partitionBy(*keys)
    counted = digests.groupBy(*keys, digits(0).alias("prefix")).agg(F.count("*").alias("n"))
    run = F.sum("n").over(group.orderBy("prefix").rowsBetween(Window.unboundedPreceding, 0))
    counted = counted.select(*keys, "prefix", "n", run.alias("upto"), F.sum("n").over(group).alias("rows"))
    counted = counted.withColumn("quota", F.least(quota(F.col("rows")), F.col("rows")).cast("long"))
    place = F.struct("upto", "n", "prefix")
    first = F.min(F.when(F.col("upto") >= F.greatest("quota", F.lit(1)), place)).alias("place")
    held = persist_state(counted.groupBy(*keys, "rows", "quota").agg(first).select(*keys, "rows", "quota", "place.*"), "quota")
    taken, total = DIGITS, held
    while taken < 30 and (held.agg(F.max("n")).first()[0] or 0) > SORTED_ROWS:
        inside = _inside(digests, held, keys, taken)
        deeper = inside.groupBy(*keys, "quota", "prefix", "before", digits(taken).alias("next")).agg(F.count("*").alias("n"))
        run = F.sum("n").over(group.orderBy("next").rowsBetween(Window.unboundedPreceding, 0)) + F.col("before")
        deeper = deeper.select(*keys, "quota", "n", run.alias("upto"), F.concat("prefix", "next").alias("prefix"))
        held = persist_state(deeper.groupBy(*keys, "quota").agg(first).select(*keys, "quota", "place.*"), "quota")
        taken += DIGITS
    merged = _inside(digests, held, keys, taken).groupBy(*keys, "quota", "before", "digest").agg(F.count("*").alias("n"))
    run = F.sum("n").over(group.orderBy("digest").rowsBetween(Window.unboundedPreceding, 0)) + F.col("before")
    reached = merged.select(*keys, "digest", "quota", run.alias("run")).filter((F.col("run") >= F.col("quota")) & (F.col("quota") > 0))
    last = reached.groupBy(*keys).agg(F.min("digest").alias("digest"))
    return null_safe_join(total.select(*keys, "rows", "quota"), last, keys, "left")


def _inside(digests: DataFrame, held: DataFrame, keys: list[str], taken: int) -> DataFrame:
    """The digests of each group's interval, with its quota and the rows before the interval."""
    state = held.select(*keys, "quota", "prefix", (F.col("upto") - F.col("n")).alias("before"))
    named = digests.select(*keys, "digest", F.substring("digest", 1, taken).alias("prefix"))
    return null_safe_join(named, state, [*keys, "prefix"])


def exact_quantiles(
    df: DataFrame, columns: list[str], shares: list[float], accuracy: int = BRACKET_ACCURACY
) -> DataFrame:
    """Discrete quantiles (feature, position, value) of several columns; missing values are left out.

    A quantile p is the smallest value whose cumulative share is at least p. Approximate
    percentiles a little below and above p bracket it; their rank error is at most
    1 / accuracy. A second scan counts the values inside the brackets and, as one row each, the
    values between them; the counted values are ordered by ranges. A rank that lies between
    brackets is an error, never a wrong value.
    """
    values = df.select(*[known(df, c).cast("double").alias(c) for c in columns])
    values = values.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) for c in columns])
    size, margin = len(shares), 4 / accuracy
    positions = sorted(range(size), key=lambda i: shares[i])
    shares = sorted(shares)
    ends = [max(p - margin, 0.0) for p in shares] + [min(p + margin, 1.0) for p in shares]
    brackets = values.agg(*[F.percentile_approx(c, F.array(*map(F.lit, ends)), F.lit(accuracy)).alias(c) for c in columns])
    return quantiles_in(values, brackets, columns, shares, positions)


def quantiles_in(values: DataFrame, brackets: DataFrame, columns: list[str], shares: list[float], positions: list[int]) -> DataFrame:
    """The quantiles of ascending shares, given one row of bracket ends (low ends, then high ends).

    A value is placed by the last bracket that starts at or below it: itself inside the bracket, and
    one common mark, ordered after the bracket, above it or below all brackets.
    """
    bracket, size, placed = F.col(STATE), len(shares), {}
    nothing = F.lit(None).cast("double")
    mark = lambda i: F.struct(F.lit(i).alias("bracket"), F.lit(1).alias("between"), nothing.alias("value"))
    for c in columns:
        here, at = F.col(c), mark(-1)
        for i in range(size):
            low, high = bracket[c][i], bracket[c][i + size]
            inside = F.struct(F.lit(i).alias("bracket"), F.lit(0).alias("between"), here.alias("value"))
            at = F.when(here >= low, F.when(here <= high, inside).otherwise(mark(i))).otherwise(at)
        placed[c] = F.when(here.isNotNull(), at)
    long = with_state(values, brackets).withColumns(placed).drop(STATE).unpivot([], columns, "feature", "place")
    counts = long.filter(F.col("place").isNotNull()).groupBy("feature", "place").agg(F.count("*").alias("n"))
    ranked = running_totals(counts, ["feature"], "place", ["n"])
    hits = [F.min(F.when(F.col("n_run") >= F.greatest(p * F.col("n_all"), F.lit(1.0)), F.col("place"))).alias(f"q{i}") for i, p in enumerate(shares)]
    found = ranked.groupBy("feature").agg(*hits)
    problem = F.raise_error(F.lit("quantile outside its bracket: raise the accuracy")).cast("double")
    checked = [
        F.struct(
            F.lit(positions[i]).alias("position"),
            F.when(F.col(f"q{i}")["between"] == 0, F.col(f"q{i}")["value"]).otherwise(problem).alias("value"),
        )
        for i in range(size)
    ]
    return found.select("feature", F.inline(F.array(*checked)))


def numbered(df: DataFrame, order: list[Column], group: str) -> DataFrame:
    """Add `position`, 0-based inside each group in the given order, for groups of any size.

    The order must begin with the group. Each range of the order numbers its own rows and the row
    counts of the group's earlier ranges are added.
    """
    rows = in_ranges(df, order)
    # one row per (group, range): its count, then the count of the group's earlier ranges
    part = rows.groupBy(group, "_range").agg(F.count("*").alias("_n"), F.min("_within").alias("_first"))
    earlier = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = part.select(group, "_range", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    joined = null_safe_join(rows, offsets, [group, "_range"])
    return joined.withColumn("position", F.col("_within") - F.col("_first") + F.col("_offset")).drop(
        "_range", "_within", "_first", "_offset"
    )
