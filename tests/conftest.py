import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

from millrace.session import build_session, scratch_schema  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("shared")
    session = build_session(
        "local[4]",
        "millrace-tests",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": str(folder),
            "spark.sql.warehouse.dir": str(folder / "warehouse"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set runtime settings for one test."""
    before = {}

    def set_all(**settings):
        for key, value in settings.items():
            key = key.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield set_all
    for key, value in before.items():
        spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


@pytest.fixture
def schema(spark):
    with scratch_schema(spark) as name:
        yield name


@pytest.fixture
def executed():
    """The plan as it ran, after AQE."""

    def plan(df) -> str:
        df.write.format("noop").mode("overwrite").save()
        jdf = df._jdf
        jdf.queryExecution().executedPlan().execute().count()
        return jdf.queryExecution().executedPlan().toString()

    return plan


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
