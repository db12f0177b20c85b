import pytest

from harvestlake.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__driver__memory="4g",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture
def column(spark):
    """Evaluate an expression over single input values, in order."""

    def run(build, values, kind="STRING"):
        rows = [(i, v) for i, v in enumerate(values)]
        from pyspark.sql import functions as F

        df = spark.createDataFrame(rows, f"i INT, x {kind}")
        return [r[0] for r in df.orderBy("i").select(build(F.col("x"))).collect()]

    return run
