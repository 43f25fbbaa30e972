"""Mixing sources to target weights by capped water-filling.

`water_fill` gives every source its target; `sample` turns targets into whole repetitions for every
document and one further repetition for a seeded part of each source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabflow.llm.common import draw, named, picked
from tabflow.sources.shared import persist_state

DIGIT = 12
DRAW_BITS = 60
TAKE_ALL = (1 << 62) - 1


def source_sizes(docs: DataFrame, source: str, size: str) -> DataFrame:
    """Rows (source, source_size); null is a source of its own."""
    return picked(docs, source=source, size=size).groupBy("source").agg(F.sum("size").alias("source_size"))


def cyclic_weights(sizes: DataFrame, weights: list[int]) -> DataFrame:
    """Adds `weight`: the given weights in turn over the sources by code point, null last.

    One row per source is ordered here, never the documents.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    turn = F.element_at(F.array(*[F.lit(w) for w in weights]), (place % len(weights) + 1).cast("int"))
    return sizes.select("*", turn.cast("double").alias("weight"))


def water_fill(sources: DataFrame, budget: float | None = None, max_epochs: int = 3) -> DataFrame:
    """Adds `target` to rows (source, source_size, weight).

    The budget (default: the sum of all sizes) is shared by weight. A source whose share exceeds
    `max_epochs` times its size stops there; what it leaves is shared again by weight among the
    others, until no share exceeds its stop. Every round is one aggregate over the sources; the
    driver sees four numbers. A budget above all stops gives every source its stop. An empty table
    has no targets; a source without words has the target 0.
    """
    sources = persist_state(sources, "sources")
    stop = (F.col("source_size") * max_epochs).cast("double")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    budget = float(total if budget is None else budget)
    level, stopped = 0.0, -1
    while True:
        full = F.col("weight") * F.lit(level) >= stop if stopped >= 0 else F.lit(False)
        n, held, free = sources.agg(
            F.sum(full.cast("long")), F.sum(F.when(full, stop)), F.sum(F.when(~full, F.col("weight")))
        ).first()
        if n == stopped or not free:
            break
        level, stopped = (budget - (held or 0.0)) / free, n or 0
    level_share = F.col("weight") * F.lit(level)
    return sources.select("*", F.when(level_share >= stop, stop).otherwise(level_share).alias("target"))


def _digit(bits_left: int) -> Column:
    return F.shiftright("draw", bits_left).bitwiseAND((1 << DIGIT) - 1)


def _crossings(rows: DataFrame, digit: Column) -> DataFrame:
    """Per source the first digit whose running words exceed the quota, and the words before it."""
    summed = rows.groupBy("source", "quota", "before", digit.alias("digit")).agg(F.sum("size").alias("words"))
    upto = F.col("before") + F.sum("words").over(Window.partitionBy("source").orderBy("digit"))
    over = summed.select("source", "quota", "digit", "words", upto.alias("upto")).filter("upto > quota")
    return over.groupBy("source", "quota").agg(
        F.min("digit").alias("digit"), F.min_by(F.col("upto") - F.col("words"), "digit").alias("before")
    )


def _same(a: str, b: str = "source") -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def cutoffs(rows: DataFrame, quotas: DataFrame) -> DataFrame:
    """Per source the largest draw that still belongs to the quota.

    Rows (source, draw, size) in the order of their draws are taken while the middle of a row lies
    within the quota. Two rounds sum words per source and 12 bits of the draw; only the rows of one
    interval in 16 million of a source are then put in order, so a hot source is no hot task.
    Rows with equal draws are taken or left together. No row: all of the source fits.
    """
    state = quotas.select("source", "quota", F.lit(0).cast("long").alias("before"))
    prefix, bits = F.lit(0).cast("long"), DRAW_BITS
    inside = rows.join(state.withColumnRenamed("source", "of"), _same("of")).drop("of")
    for _ in range(2):
        bits -= DIGIT
        crossing = persist_state(
            _crossings(inside, _digit(bits)).select(
                F.col("source").alias("of"), "quota", "before", F.col("digit")
            ),
            "crossing",
        )
        kept = inside.drop("quota", "before")
        inside = kept.join(crossing, _same("of") & (_digit(bits) == F.col("digit"))).drop("of", "digit")
    ordered = Window.partitionBy("source").orderBy("draw").rangeBetween(Window.unboundedPreceding, 0)
    middle = 2 * (F.col("before") + F.sum("size").over(ordered)) - F.col("size")
    start = F.shiftleft(F.shiftright("draw", bits), bits) - 1
    placed = inside.select("source", "draw", start.alias("start"), (middle <= 2 * F.col("quota")).alias("fits"))
    return placed.groupBy("source").agg(
        F.greatest(F.max(F.when(F.col("fits"), F.col("draw"))), F.min("start")).alias("cutoff")
    )


def plan(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """The targets with `whole`, the repetitions of every document of a source (floor of target / size),
    and `cutoff`, the largest draw that has one repetition more."""
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    planned = targets.select("source", "source_size", "target", whole.alias("whole"))
    rest = F.col("target") - F.col("whole") * F.col("source_size")
    limits = cutoffs(rows.select("source", "draw", "size"), planned.select("source", rest.alias("quota")))
    limits = limits.select(F.col("source").alias("limit_of"), "cutoff")
    out = planned.join(limits, _same("limit_of"), "left").drop("limit_of")
    cutoff = F.when(rest > 0, F.coalesce("cutoff", F.lit(TAKE_ALL))).otherwise(-1)
    return persist_state(out.withColumn("cutoff", cutoff), "mix")


def sample(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """Adds source_size, target and `copies` to rows with `source` and `draw`.

    The number of copies depends on the plan and the draw alone, so reruns agree.
    """
    joined = rows.join(planned.withColumnRenamed("source", "plan_of"), _same("plan_of"), "left").drop("plan_of")
    extra = (F.col("draw") <= F.col("cutoff")).cast("long")
    return joined.withColumn("copies", F.col("whole") + extra).drop("whole", "cutoff")


def _rows(docs: DataFrame, size: Column, seed: int, key: str, text: str, source: str) -> DataFrame:
    return docs.select(
        named(key).alias("key"), named(source).alias("source"), size.alias("size"),
        draw(seed, named(key), named(text)).alias("draw"),
    )


def _planned(rows: DataFrame, weights: list[int], max_epochs: int) -> DataFrame:
    sizes = source_sizes(rows, "source", "size")
    return plan(rows, water_fill(cyclic_weights(sizes, weights), max_epochs=max_epochs))


def mix(
    docs: DataFrame,
    size: Column,
    weights: list[int],
    seed: int = 11,
    max_epochs: int = 3,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """Rows (key, source, size, draw, source_size, target, copies), one per document.

    Null sources are one source; a null key or text has a draw of its own; repeated rows share their
    draw and so their copies; an empty table gives no rows.
    """
    rows = persist_state(_rows(docs, size, seed, key, text, source), "sizes")
    return sample(rows, _planned(rows, weights, max_epochs))


def mixed_documents(
    docs: DataFrame,
    size: Column,
    weights: list[int],
    seed: int = 11,
    max_epochs: int = 3,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """The documents of the mix with all their columns, each as often as `mix` takes it."""
    rows = persist_state(_rows(docs, size, seed, key, text, source), "sizes")
    planned = _planned(rows, weights, max_epochs)
    whole = docs.select(
        F.struct(*[named(c) for c in docs.columns]).alias("row"), named(source).alias("source"),
        draw(seed, named(key), named(text)).alias("draw"),
    )
    taken = sample(whole, planned).filter("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")
