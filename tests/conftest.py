import datetime as dt
import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]").appName("dunlin-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.log.level", "ERROR")
        .getOrCreate()
    )
    yield session
    session.stop()


@pytest.fixture
def hot(spark):
    """Lower the row limit so that small frames take the split path."""
    spark.conf.set("dunlin.hotKeyRows", "8")
    yield spark
    spark.conf.unset("dunlin.hotKeyRows")


def rows(df, *cols):
    out = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in out.collect()), key=repr)


def day(text):
    return dt.date.fromisoformat(text)


def ts(text):
    return dt.datetime.fromisoformat(text)
