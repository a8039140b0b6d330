import pytest
from pyspark.sql import SparkSession

SMALL = "/root/testdata/sf0.001"


def local_session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .appName("playlake-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    session = local_session()
    yield session
    session.stop()


@pytest.fixture
def out(tmp_path):
    return str(tmp_path)
