import pytest

from tickflow.session import local_session

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session(4, shuffle_partitions=4, memory="4g")


@pytest.fixture
def value(spark):
    """Evaluate one SQL text over literal columns: value("to_x(a)", a="1D")."""

    def run(sql: str, **columns: str):
        frame = spark.range(1).selectExpr(*[f"{text} as {name}" for name, text in columns.items()])
        return frame.selectExpr(f"{sql} as out").first()["out"]

    return run
