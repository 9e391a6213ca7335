import pytest
from pyspark.sql import SparkSession

from tidemark.session import SETTINGS


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "2")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    )
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Build a frame from rows and a DDL schema."""
    return lambda schema, *rows: spark.createDataFrame(list(rows), schema)


@pytest.fixture
def with_settings(spark):
    """Set SQL settings for one test."""
    changed = {}

    def apply(**settings):
        for name, value in settings.items():
            name = name.replace("__", ".")
            changed.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield apply
    for name, value in changed.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)
