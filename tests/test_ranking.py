"""Global positions and running totals against a sort on the driver."""

from pyspark.sql import functions as F

from sitelens.plans.ranking import running_total, with_position


def test_positions_with_ties_and_nulls(spark):
    df = spark.range(0, 500, 1, 7).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 11 == 1, None).otherwise(F.col("id").cast("string")).alias("key"),
        (F.col("id") % 5).alias("value"))
    got = with_position(df, ["key", F.col("value").desc()]).collect()
    assert sorted(r.position for r in got) == list(range(500))
    by_place = [(r.key, r.value) for r in sorted(got, key=lambda r: r.position)]
    assert by_place == sorted(by_place, key=lambda r: (r[0] is not None, r[0] or "", -r[1]))


def test_running_total(spark):
    df = spark.createDataFrame([(i * 7 % 100, i) for i in range(100)], "place long, value long")
    got = {r.place: r.total for r in running_total(df, ["place"], F.col("value"), "total").collect()}
    total = 0
    for place, value in sorted((i * 7 % 100, i) for i in range(100)):
        assert got[place] == total
        total += value


def test_no_rows(spark):
    assert with_position(spark.createDataFrame([], "key string"), ["key"]).count() == 0
