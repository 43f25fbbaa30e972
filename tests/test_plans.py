"""Plan checks over the catalogue: no Python in the row path, no joins of all pairs."""

import pathlib
import re

import pytest

from tabflow.operators import missing, outliers, projection, scaling
from tabflow.plans.catalogue import CATALOGUE
from tests.conftest import counted, executed, planned

LAZY = [n for n, q in CATALOGUE.items() if q.run.__module__.split(".")[-1] in ("relational", "profiling", "evaluation")]
SOURCE = pathlib.Path(__file__).parent.parent / "tabflow"


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_pairs(spark, smoke, name):
    plan = planned(CATALOGUE[name].run(spark, smoke))
    for bad in ("EvalPython", "InPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan


def test_library_has_no_driver_loops_or_local_checkpoints():
    files = [p for p in SOURCE.rglob("*.py") if "llm" not in p.parts]  # that subpackage has rules of its own
    text = "\n".join(p.read_text() for p in files)
    for bad in (r"\.collect\(\)", r"\.toPandas\(", r"localCheckpoint", r"crossJoin", r"\.rdd\b", r"coalesce\(1\)", r"@udf", r"pandas_udf"):
        assert not re.search(bad, text), bad


def test_filters_and_columns_reach_the_scan(spark, smoke):
    plan = executed(CATALOGUE["filter_range"].run(spark, smoke))
    assert "PushedFilters: [IsNotNull(l_quantity)" in plan and "GreaterThanOrEqual(l_quantity,10.0)" in plan
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert set(c.split(":")[0] for c in schema.split(",")) == {"l_orderkey", "l_linenumber", "l_quantity", "l_shipdate"}


def test_row_wise_operators_do_not_shuffle_rows(spark, smoke):
    lines = spark.read.parquet(f"{smoke}/lineitem.parquet").select("l_orderkey", "l_extendedprice", "l_tax")
    state = outliers.fit_iqr(lines, ["l_extendedprice"])
    out = outliers.cap(missing.apply_fill(lines, missing.fit_fill(lines, ["l_tax"])), state)
    out = scaling.scale_minmax(out, scaling.fit_moments(lines, ["l_tax"]))
    main = out.select("l_orderkey", "l_extendedprice", "l_tax")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in main and "Repartition" not in main
    sampled = projection.sample_fraction(lines, 0.1, ["l_orderkey"])
    assert "Exchange" not in planned(sampled)


def test_a_fit_reads_once_and_its_state_is_one_subquery(spark, smoke):
    columns = ["l_quantity", "l_extendedprice", "l_tax"]
    lines = spark.read.parquet(f"{smoke}/lineitem.parquet").select("l_orderkey", *columns)
    watched, seen = counted(lines)
    capped = outliers.cap(lines, outliers.fit_iqr(watched, columns))
    assert capped.count() == capped.filter("l_tax >= 0").count() == lines.count()
    assert len(set(re.findall(r"Subquery subquery#(\d+)", planned(capped)))) == 1
    seen.value = 0
    capped.collect()
    assert seen.value == lines.count()


@pytest.mark.parametrize("name", ["join_stats_apply", "outlier_iqr_flag", "scale_minmax", "split_random"])
def test_result_does_not_depend_on_partitioning(spark, smoke, name, tmp_path):
    base = sorted(map(tuple, CATALOGUE[name].run(spark, smoke).collect()))
    for source in ("lineitem", "orders"):
        spark.read.parquet(f"{smoke}/{source}.parquet").repartition(7).write.parquet(f"{tmp_path}/{source}.parquet")
    assert sorted(map(tuple, CATALOGUE[name].run(spark, str(tmp_path)).collect())) == base
