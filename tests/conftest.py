from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

from gleanspark.session import session  # noqa: E402


# made on import, since test modules build Columns at their top level
SPARK = session("tests", **{
    "spark.master": "local[8]", "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "6g",
})
SPARK.sparkContext.setLogLevel("ERROR")


@pytest.fixture(scope="session")
def spark():
    return SPARK


@pytest.fixture
def values(spark):
    """Results of Columns over one string column `s`, in input order."""

    def run(column, inputs):
        rows = spark.createDataFrame([(i, s) for i, s in enumerate(inputs)], "i int, s string")
        return [r["v"] for r in rows.select("i", column.alias("v")).orderBy("i").collect()]

    return run
