import contextlib

import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark():
    conf = {"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g", "spark.sql.session.timeZone": "UTC", "spark.ui.showConsoleProgress": "false"}
    s = SparkSession.builder.master("local[4]").config(map=conf).getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@contextlib.contextmanager
def small_broadcasts(spark, below="256k", most="2500k"):
    """Tables of up to 256 kB may be broadcast; one that Spark takes for such and that needs 2.5 MB in the driver is an error."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": below, "spark.sql.maxBroadcastTableSize": most}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
