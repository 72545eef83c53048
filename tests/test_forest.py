"""Exact trees against a plain recursive search, and the cluster's splits against the local ones."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterstar.operators import forest


def brute(x, y, w, numeric, leaf, depth=None):
    """A nested tuple (feature, threshold, left, right), or a mean."""
    mean = (w * y).sum() / w.sum()
    best, least = None, ((w * (y - mean) ** 2).sum()) * (1 - 1e-9)
    for f in range(x.shape[1]) if depth is None or depth > 0 else ():
        values = np.unique(x[:, f])
        pairs = [((a + b) / 2, x[:, f] > (a + b) / 2) for a, b in zip(values, values[1:])] if f < numeric else [(v, x[:, f] == v) for v in values]
        for limit, right in pairs:
            if right.sum() >= leaf and (~right).sum() >= leaf:
                cost = sum((w[side] * (y[side] - (w[side] * y[side]).sum() / w[side].sum()) ** 2).sum() for side in (right, ~right))
                if cost < least - 1e-9 * max(least, 1e-12):
                    best, least = (f, limit, right), cost
    if best is None:
        return mean
    f, limit, right = best
    down = None if depth is None else depth - 1
    return f, limit, brute(x[~right], y[~right], w[~right], numeric, leaf, down), brute(x[right], y[right], w[right], numeric, leaf, down)


def brute_value(tree, row, numeric):
    while isinstance(tree, tuple):
        f, limit, left, right = tree
        tree = right if (row[f] > limit if f < numeric else row[f] == limit) else left
    return tree


def sample(seed, n=150):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.normal(size=n), rng.integers(0, 6, n), np.round(rng.normal(size=n), 1), rng.integers(0, 4, n), rng.integers(0, 9, n)]).astype(float)
    y = 2 * (x[:, 0] > 0.3) + np.where(x[:, 3] == 2, -1.5, 0) + 0.2 * x[:, 1] + rng.normal(0, 0.4, n)
    return x, y, rng.poisson(1.0, n)


@pytest.mark.parametrize("seed, leaf, depth", [(1, 2, None), (2, 1, None), (3, 5, None), (4, 2, 3)])
def test_tree_equals_a_plain_search(seed, leaf, depth):
    x, y, w = sample(seed)
    held = w > 0
    wanted = brute(x[held], y[held], w[held].astype(float), 3, leaf, depth)
    got = forest.grown(x, y, w, 3, leaf, depth)
    values = got.predict(x, 3)
    # Equal splits may part rows outside the sample differently, those inside never.
    np.testing.assert_allclose(values[held], [brute_value(wanted, row, 3) for row in x[held]], rtol=1e-9)


def test_trees_of_few_equal_or_heavy_rows():
    one = forest.grown(np.array([[1.0, 2.0]]), np.array([3.0]), np.array([2]), 1)
    assert one.value.tolist() == [3.0] and one.feature.tolist() == [-1]
    same = forest.grown(np.ones((20, 2)), np.arange(20.0), np.ones(20), 1)
    assert same.feature.tolist() == [-1] and same.value[0] == pytest.approx(9.5)
    pure = forest.grown(np.arange(20.0)[:, None], np.full(20, 4.0), np.ones(20), 1)
    assert pure.feature.tolist() == [-1]
    chain = forest.grown(np.arange(300.0)[:, None], 1.1 ** np.arange(300.0), np.ones(300), 1, 1)
    assert (chain.feature < 0).sum() == 300       # a very uneven tree is as deep as it needs to be


def rows_of(spark, x, y):
    return spark.createDataFrame([(i, float(b), [float(v) for v in a]) for i, (a, b) in enumerate(zip(x, y))], "UsageID bigint, y double, x array<double>")


def predicted(model, df, **options):
    return [r["prediction"] for r in forest.predict_forest(model, df, **options).orderBy("UsageID").collect()]


@pytest.fixture(scope="module")
def rows(spark):
    x, y, _ = sample(7, 240)
    return rows_of(spark, x, y)


def test_splits_of_the_cluster_equal_local_ones(spark, rows, monkeypatch):
    monkeypatch.setattr(forest, "GROUP_ROWS", 70)          # of the rows scored together
    local = forest.fit_forest(rows, 3, trees=4)
    spread = forest.fit_forest(rows.repartition(5), 3, trees=4, group_rows=40)
    assert local.splits is None and spread.splits.count() > 8 and local.subtrees.count() == 4
    wanted = predicted(local, rows)
    np.testing.assert_allclose(predicted(spread, rows), wanted, rtol=1e-9)
    np.testing.assert_allclose(predicted(local, rows, broadcast_bytes=0), wanted, rtol=1e-9)
    limited = forest.fit_forest(rows, 3, trees=2, depth=2, group_rows=40)
    np.testing.assert_allclose(predicted(limited, rows), predicted(forest.fit_forest(rows, 3, trees=2, depth=2), rows), rtol=1e-9)


def test_rows_that_fit_a_task_are_sent_once_per_batch_of_trees(spark, rows, monkeypatch):
    """Trees of one batch share their rows, and are the trees that rows sent tree by tree give."""
    monkeypatch.setattr(forest, "_level_splits", lambda *_: pytest.fail("the cluster split rows that one task may hold"))
    assert forest.GROUP_ROWS >= 300_000              # a sample of 0.1 GB stays below
    whole = forest.fit_forest(rows.repartition(3), 3, trees=13)
    assert whole.subtrees.select("tree").distinct().count() == 13
    members = forest._members(rows, 13, "UsageID", 42).toPandas()
    for tree, part in members.groupby("tree"):
        x, y, w = np.stack(part["x"]), part["y"].to_numpy(), part["w"].to_numpy()
        order = np.lexsort([y, w, *x.T])
        wanted = forest.grown(x[order], y[order], w[order], 3)
        got = forest._as_tree(whole.subtrees.where(F.col("tree") == tree).first().asDict())
        np.testing.assert_allclose(got.predict(x, 3), wanted.predict(x, 3), rtol=1e-9)
    monkeypatch.setattr(forest, "_members", lambda *_: pytest.fail("rows were sent once per tree"))
    forest.fit_forest(rows, 3, trees=2)


def test_nodes_that_cannot_be_split_end_on_the_cluster_too(spark):
    flat = spark.range(200).select(F.col("id").alias("UsageID"), (F.col("id") % 7).cast("double").alias("y"), F.array(F.lit(1.0), F.lit(0.0)).alias("x"))
    model = forest.fit_forest(flat, 1, trees=3, group_rows=20)
    local = forest.fit_forest(flat, 1, trees=3)
    np.testing.assert_allclose(predicted(model, flat), predicted(local, flat), rtol=1e-9)


def test_samples_are_poisson_and_depend_on_keys_alone(rows):
    drawn = forest._members(rows.repartition(7), 40, "UsageID", 42)
    share = drawn.groupBy("tree").agg(F.sum("w").alias("w"), F.count(F.lit(1)).alias("n")).collect()
    assert len(share) == 40
    assert np.mean([r["w"] for r in share]) == pytest.approx(240, rel=0.05)
    assert np.mean([r["n"] for r in share]) == pytest.approx(240 * (1 - np.exp(-1)), rel=0.05)
    again = forest._members(rows, 40, "UsageID", 42)
    assert drawn.exceptAll(again).isEmpty()


def test_forest_beats_the_mean_on_rows_it_has_not_seen(spark):
    x, y, _ = sample(9, 900)
    model = forest.fit_forest(rows_of(spark, x[:600], y[:600]), 3, trees=30)
    got = np.array(predicted(model, rows_of(spark, x[600:], y[600:])))
    error, plain = np.mean((got - y[600:]) ** 2), np.mean((y[:600].mean() - y[600:]) ** 2)
    assert error < 0.4 * plain


def walked(tree, x, numeric):
    out = []
    for row in x:
        at = 0
        while tree.feature[at] >= 0:
            f = tree.feature[at]
            right = row[f] > tree.threshold[at] if f < numeric else row[f] == tree.threshold[at]
            at = tree.right[at] if right else tree.left[at]
        out.append(tree.value[at])
    return np.array(out)


@pytest.mark.parametrize("few_values", [1 << 16, 20])
@pytest.mark.parametrize("seed, leaf, depth, scale", [(1, 2, None, 1.0), (2, 1, None, 1e-4), (3, 5, None, 1.0), (4, 2, 4, 1.0)])
def test_large_nodes_split_by_themselves_are_exact(monkeypatch, few_values, seed, leaf, depth, scale):
    """Sums taken from the parent's, sorted features and a part with far smaller differences give the plain search's tree."""
    monkeypatch.setattr(forest, "FEW_NODE_ROWS", 12)
    monkeypatch.setattr(forest, "FEW_VALUES", few_values)
    monkeypatch.setattr(forest, "FEW_ROWS", 9)
    x, y, w = sample(seed)
    y = np.where(x[:, 1] > 2, 40 + y, y * scale)
    tree = forest.grown(x, y, w, 3, leaf, depth)
    held = w > 0
    wanted = brute(x[held], y[held], w[held], 3, leaf, depth)
    np.testing.assert_allclose(tree.predict(x, 3), [brute_value(wanted, row, 3) for row in x], rtol=1e-9)
    np.testing.assert_array_equal(tree.predict(x, 3), walked(tree, x, 3))


def test_labels_split_off_one_by_one_do_not_sum_all_rows_again(monkeypatch):
    """Of each split only the smaller side is summed, so a long chain of splits costs few passes over the rows."""
    rng = np.random.default_rng(5)
    label = rng.integers(0, 40, 60_000)
    x = np.column_stack([rng.normal(size=len(label)), label]).astype(float)
    summed, real = [], forest._Sums.of.__func__
    monkeypatch.setattr(forest._Sums, "of", classmethod(lambda cls, rows, *rest: summed.append(len(rows)) or real(cls, rows, *rest)))
    tree = forest.grown(x, (label % 3).astype(float), np.ones(len(label)), 1)
    assert (tree.feature >= 0).sum() > 15
    assert sum(summed) < 2.5 * len(label)
    np.testing.assert_array_equal(tree.predict(x, 1), label % 3)


def test_training_sets_of_several_groups_stay_whole(spark, rows, monkeypatch):
    monkeypatch.setattr(forest, "_level_splits", lambda *_: pytest.fail("the cluster split rows that one task may hold"))
    whole = forest.fit_forest(rows, 3, trees=2, group_rows=60)
    assert whole.splits is None and whole.subtrees.count() == 2
    assert forest.WHOLE * forest.GROUP_ROWS >= 1_700_000     # the training rows of 1 GB


def test_each_batch_of_trees_has_a_task_of_its_own(spark, rows):
    grown = forest._whole_trees(forest.materialise(rows), 3, 24, 2, None, "UsageID", 42)
    counts = [r["count"] for r in grown.groupBy(F.spark_partition_id()).count().collect()]
    assert counts == [6] * 4


def test_rows_with_the_same_key_may_arrive_in_any_order(spark):
    x, y, _ = sample(11, 120)
    twice = rows_of(spark, x, y).withColumn("UsageID", F.col("UsageID") % 15)
    one, other = (forest.fit_forest(df, 3, trees=3).subtrees for df in (twice.repartition(5), twice.orderBy(F.desc("y")).coalesce(1)))
    assert [r.asDict() for r in one.orderBy("tree").collect()] == [r.asDict() for r in other.orderBy("tree").collect()]


def test_a_large_forest_scores_rows_pack_by_pack(spark, rows):
    model = forest.fit_forest(rows, 3, trees=5)
    wanted = predicted(model, rows)
    np.testing.assert_allclose(predicted(model, rows.repartition(3), broadcast_bytes=model.bytes() // 2), wanted, rtol=1e-12)
    np.testing.assert_allclose(predicted(model, rows, broadcast_bytes=0), wanted, rtol=1e-12)
