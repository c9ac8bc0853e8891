import pytest

from threadloom.session import drop_stages, local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 4, shuffle_partitions=4)
    session.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    yield session
    drop_stages(session)
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture
def shuffle_partitions(spark):
    """Set the number of shuffle partitions for one test."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    yield lambda n: spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.shuffle.partitions", before)
