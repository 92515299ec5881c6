import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    conf = {
        "spark.sql.shuffle.partitions": "2", "spark.ui.enabled": "false", "spark.sql.session.timeZone": "UTC", "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": str(shared / "checkpoints"), "spark.sql.warehouse.dir": str(shared / "warehouse"), "spark.driver.memory": "4g",
    }
    session = SparkSession.builder.master("local[2]").config(map=conf).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
