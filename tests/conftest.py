from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from corpusloom.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "local[8]", "tests", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "6g"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def texts(spark):
    """A one-column frame of texts, and one Column function applied to it."""

    def apply(function, *values):
        from pyspark.sql import functions as F

        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
        rows = df.select("i", function(F.col("v")).alias("out")).orderBy("i").collect()
        out = [r.out for r in rows]
        return out[0] if len(values) == 1 else out

    return apply
