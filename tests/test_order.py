from __future__ import annotations

from pyspark.sql import functions as F

from gleanspark.operators.order import with_position


def test_positions(spark):
    rows = [(i % 7, i) for i in range(1000)] + [(3, 3)] * 500
    df = spark.createDataFrame(rows, "a int, at int").repartition(9)
    got = with_position(df, [F.desc("a"), "at"], "place", first=1).orderBy("place").collect()
    assert [r["place"] for r in got] == list(range(1, 1501))
    assert [(r["a"], r["at"]) for r in got] == sorted(rows, key=lambda r: (-r[0], r[1]))
    assert with_position(df.limit(0), ["a"]).count() == 0
