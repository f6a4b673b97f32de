import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(root / "warehouse"))
        .config("spark.checkpoint.dir", str(root / "shared"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def setting(spark):
    """Change a session setting for one test."""
    before = {}

    def change(key, value):
        before.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture
def lines(spark):
    return lambda *values: spark.createDataFrame([(v,) for v in values], "value string")


def final_plan(df) -> str:
    """The plan as it ran, with what AQE changed."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def first_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def files_read(df) -> int:
    """Files that the scans of ``df`` opened."""
    df.collect()
    total, plans = 0, [df._jdf.queryExecution().executedPlan()]
    while plans:
        plan = plans.pop()
        files = plan.metrics().get("numFiles")
        total += files.get().value() if files.isDefined() else 0
        children = plan.children()
        plans += [children.apply(n) for n in range(children.length())]
    return total
