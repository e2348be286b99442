import os

os.environ.setdefault("SPARK_LOCAL_IP", "127.0.0.1")

import pytest


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    conf = {
        "spark.sql.shuffle.partitions": "4", "spark.sql.session.timeZone": "UTC", "spark.ui.enabled": "false", "spark.driver.memory": "4g", "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": f"file://{tmp_path_factory.mktemp('shared')}", "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    }
    s = SparkSession.builder.master("local[4]").config(map=conf).getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
