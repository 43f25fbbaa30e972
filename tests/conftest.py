import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = "/root/testdata"


def pytest_configure(config):
    config.addinivalue_line("markers", "slow: minutes of fitting; a full run has them, -m 'not slow' leaves them out")


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def smoke():
    return f"{DATA}/sf0.001"


def rows(df, *order):
    """Collected rows as tuples, sorted by the given columns."""
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def executed(df) -> str:
    """The plan as finally run, with its subqueries."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def planned(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def counted(df):
    """The same table, and an accumulator of the rows read from it by all jobs and retries."""
    seen = df.sparkSession.sparkContext.accumulator(0)

    def watch(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    return df.mapInPandas(watch, df.schema), seen
