import datetime as dt
import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from shelfmark import schemas
from shelfmark.session import AT_START, SETTINGS


@pytest.fixture(scope="session")
def spark():
    builder = SparkSession.builder.master("local[4]").appName("tests")
    for k, v in (SETTINGS | AT_START | {"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
                             "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g"}).items():
        builder = builder.config(k, v)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


RUN_TS = dt.datetime(2025, 11, 25, 4, 0, 0)


@pytest.fixture(scope="session")
def make_pages(spark):
    """Rows of (source, url, html[, seq[, status[, run_id]]]) as a pages table."""
    def build(rows):
        out = []
        for i, r in enumerate(rows):
            source, url, html, *rest = r
            seq, status, run = (list(rest) + [i, 200, "r1"][len(rest):])[:3]
            out.append((source, url, status, html, run, RUN_TS, seq, RUN_TS))
        return spark.createDataFrame(out, schemas.PAGES)
    return build
