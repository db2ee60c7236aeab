import pytest
from pyspark.sql import SparkSession

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.log.level", "ERROR")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    from commerce_engine.session import configure

    yield configure(session)


@pytest.fixture(scope="session")
def star(spark):
    from commerce_engine.sources.star import OrderTables

    return OrderTables(spark, FOLDER)
