import numpy as np
import pytest
from pyspark.sql import functions as F

from meterstar.operators import ranking


@pytest.fixture
def skewed(spark):
    """20,000 rows; a third share one value, and there are NULLs and NaNs."""
    value = F.when(F.col("id") % 3 == 0, 7.0).otherwise((F.col("id") * 7919 % 10007) / 10.0)
    value = F.when(F.col("id") % 1000 == 1, F.lit(float("nan"))).when(F.col("id") % 1000 == 2, F.lit(None)).otherwise(value)
    return spark.range(20_000).withColumn("v", value)


@pytest.mark.parametrize("buffer_rows", [5, 300, 100_000])
@pytest.mark.parametrize("partitions", [1, 7])
def test_quantiles_are_exact(skewed, buffer_rows, partitions):
    probabilities = (0.0, 0.01, 0.25, 0.31, 0.5, 0.75, 0.98, 1.0)
    got = ranking.quantiles(skewed.repartition(partitions), {"v": probabilities}, buffer_rows)["v"]
    values = skewed.toPandas()["v"].dropna().to_numpy()
    for p in probabilities:
        assert got[p] == pytest.approx(np.quantile(values, p), abs=1e-9)


def test_quantiles_of_nothing_and_one_value(spark):
    empty = spark.createDataFrame([], "v double")
    assert ranking.quantiles(empty, {"v": (0.5,)}) == {"v": {0.5: None}}
    one = spark.createDataFrame([(3.0,)], "v double")
    assert ranking.quantiles(one, {"v": (0.25, 0.9)}) == {"v": {0.25: 3.0, 0.9: 3.0}}


@pytest.mark.parametrize("rows", [1, 3, 4, 6, 4001])
@pytest.mark.parametrize("buffer_rows", [2, 100_000])
def test_ntile_equals_the_window_function(spark, rows, buffer_rows):
    df = spark.range(rows).withColumn("v", F.when(F.col("id") % 3 == 0, 5.0).otherwise((F.col("id") * 37 % 11).cast("double")))
    tiles = [ranking.Tiles("a", "v"), ranking.Tiles("b", "v", 7, descending=True)]
    got = ranking.ntile(df, "id", tiles, buffer_rows).orderBy("id").collect()
    want = df.selectExpr("*", "ntile(4) over (order by v, id) a", "ntile(7) over (order by v desc, id) b").orderBy("id").collect()
    assert got == want


def test_ntile_of_keys_beyond_the_doubles(spark):
    df = spark.range(9).select((F.col("id") + 2**60).alias("id"), F.lit(1.0).alias("v"))
    df = df.union(spark.createDataFrame([(-(2**62), 1.0)], "id bigint, v double"))
    got = ranking.ntile(df, "id", [ranking.Tiles("a", "v")], 2).orderBy("id").collect()
    assert [r["a"] for r in got] == [1, 1, 1, 2, 2, 2, 3, 3, 4, 4]


@pytest.mark.parametrize("partitions", [1, 4, 37])
def test_prefix_sums_and_index_follow_the_global_order(spark, partitions):
    df = spark.range(5000).select("id", (F.col("id") * 7919 % 5003).alias("v")).repartition(partitions)
    got = ranking.ordered_prefix(df, [F.desc("v")], {"running": "id", "place": F.lit(1)}).toPandas().sort_values("place")
    assert (got["v"].diff().dropna() < 0).all()
    assert (got["running"].to_numpy() == got["id"].cumsum().to_numpy()).all()
    assert got["place"].tolist() == list(range(1, 5001))


def test_rank_shares_places_among_ties(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 5.0), (3, 1.0), (4, None)], "id int, v double")
    got = {r["id"]: r["place"] for r in ranking.rank(df, "v", "place", descending=True).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: None}


@pytest.mark.parametrize("partitions", [1, 6])
def test_rank_within_groups_equals_the_window_function(spark, partitions):
    value = F.when(F.col("id") % 50 != 7, (F.col("id") * 31 % 17).cast("double"))
    group = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 41 != 0, F.concat(F.lit("g"), F.col("id") % 5))
    df = spark.range(2000).select("id", value.alias("v"), group.alias("g")).repartition(partitions)
    got = ranking.rank(df, "v", "place", by=["g"], rank_nulls=True).orderBy("id").collect()
    want = df.selectExpr("*", "cast(rank() over (partition by g order by v nulls last) as bigint) place").orderBy("id").collect()
    assert got == want
