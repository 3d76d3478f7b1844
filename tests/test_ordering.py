"""Range-split windows equal plain windows, also for hot and NULL keys and for ties."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textquarry.operators import windows as X
from textquarry.operators.ordering import numbered, previous, running, split_ranges


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(1)
    data = []
    for i in range(3000):
        # One group holds most rows; a NULL group exists too.
        group = "hot" if rng.random() < 0.7 else rng.choice(["a", "b", None])
        data.append((i, group, rng.randrange(50), rng.choice([None, 1, 2, 3])))
    rng.shuffle(data)
    return spark.createDataFrame(data, "id bigint, g string, k int, v int").repartition(5)


@pytest.mark.parametrize("per_range", [100, 700, 10_000])
def test_running_matches_window(rows, per_range):
    out = running(rows, ["k", "id"], {"s": F.col("v"), "n": F.lit(1).cast("bigint")}, ["g"], per_range)
    w = W.partitionBy("g").orderBy("k", "id").rowsBetween(W.unboundedPreceding, 0)
    want = rows.select("id", F.sum(F.coalesce("v", F.lit(0))).over(w).alias("s"), F.count("*").over(w).alias("n"))
    assert sorted(map(tuple, out.select("id", "s", "n").collect())) == sorted(map(tuple, want.collect()))


@pytest.mark.parametrize("per_range", [100, 10_000])
def test_numbered_without_partition(rows, per_range):
    out = {r.id: r.row_number for r in numbered(rows, ["k", "id"], rows_per_range=per_range).collect()}
    ordered = sorted((r.k, r.id) for r in rows.collect())
    assert out == {rid: i + 1 for i, (_, rid) in enumerate(ordered)}


def test_ranges_are_used_and_ordered(rows):
    cut = split_ranges(rows, ["k", "id"], 100)
    bounds = cut.groupBy("_range").agg(F.min(F.struct("k", "id")).alias("lo"), F.max(F.struct("k", "id")).alias("hi"), F.count("*").alias("n"))
    found = bounds.orderBy("_range").collect()
    assert len(found) > 10
    assert all(a.hi < b.lo for a, b in zip(found, found[1:]))
    assert max(r.n for r in found) < 1000


def test_previous(rows):
    out = {r.id: r.before for r in previous(rows, ["id"], {"before": "g"}, 100).collect()}
    ordered = [r.g for r in sorted(rows.collect(), key=lambda r: r.id)]
    assert [out[i] for i in range(3000)] == [None, *ordered[:-1]]


def test_group_runs_keeps_separate_runs(spark):
    df = spark.createDataFrame([(1, "x", "a"), (2, "x", "b"), (3, "y", "c"), (4, "x", "d")], "o int, g string, t string")
    got = X.group_runs(df, ["o"], "g", ["t"], rows_per_range=1).orderBy("run_id").collect()
    assert [(r.g, r.t) for r in got] == [("x", ["a", "b"]), ("y", ["c"]), ("x", ["d"])]


def test_take_until_drops_the_crossing_row(spark):
    df = spark.createDataFrame([(1, 5), (2, 5), (3, 1), (4, 1)], "id int, n int")
    assert [r.id for r in X.take_until(df, ["id"], F.col("n"), 10).orderBy("id").collect()] == [1, 2]
    assert [r.id for r in X.take_until(df, ["id"], F.col("n"), 9).collect()] == [1]
    assert X.take_until(df, ["id"], F.col("n"), 4).count() == 0


@pytest.mark.parametrize("cap", [1, 10, 37])
def test_ordered_bins_equal_a_loop(spark, cap):
    rng = random.Random(cap)
    sizes = [rng.randrange(0, 15) for _ in range(120)]
    df = spark.createDataFrame(list(enumerate(sizes)), "id int, size int")
    want, held, bin_no = [], 0, -1
    for s in sizes:
        if bin_no < 0 or held + s > cap:
            bin_no, held = bin_no + 1, s
        else:
            held += s
        want.append(bin_no)
    one_range = [r.bin for r in X.ordered_bins(df, ["id"], "size", cap).orderBy("id").collect()]
    assert one_range == want
    if cap == 37:
        assert X.ordered_bins(df.limit(0), ["id"], "size", cap).count() == 0
        many = [r.bin for r in X.ordered_bins(df, ["id"], "size", cap, rows_per_range=40).orderBy("id").collect()]
        assert many == want


def test_transfer_tables_compose():
    """Any cut into ranges, with loads of all kinds, gives the bins of one loop."""
    rng = random.Random(11)
    for _ in range(400):
        cap = rng.choice([1, 5, 10, 40])
        sizes = [rng.choice([0, 0, 1, 3, 7, 50]) if rng.random() < 0.5 else rng.randrange(12) for _ in range(rng.randrange(1, 60))]
        starts, held = [], None
        for i, s in enumerate(sizes):
            if held is None or held + s > cap:
                starts.append(i)
                held = 0
            held += s
        cuts = sorted({0, *(rng.randrange(len(sizes)) for _ in range(rng.randrange(6)))})
        ranges = [X._Range(np.array(sizes[a:b]), cap) for a, b in zip(cuts, [*cuts[1:], len(sizes)])]
        rows = [(k, *t) for k, r in enumerate(ranges) for t in sorted(r.transfers())]
        tables = pd.DataFrame(rows, columns=["_range", "least", "adds", "left", "bins"])
        halves = [tables.iloc[: len(tables) // 2], tables.iloc[len(tables) // 2 :]]
        entering = pd.concat(X._compose(iter(halves), cap)).values.tolist()
        got = [cuts[k] + int(i) for k, load, _ in entering for i in ranges[k].starts(load)]
        assert got == starts, (sizes, cuts, cap)
        assert [before for _, _, before in entering] == [sum(s < c for s in starts) for c in cuts]


def test_long_ranges_have_small_tables():
    sizes = np.random.default_rng(1).integers(1, 5000, 20_000)
    assert len(X._Range(sizes, 60_000).transfers()) <= 3

def test_epoch_order_covers_each_epoch(spark):
    df = spark.range(50).withColumnRenamed("id", "key")
    got = X.epoch_order(df, "key", 120, rows_per_range=30).orderBy("position").collect()
    assert [r.position for r in got] == list(range(1, 121))
    assert sorted(r.key for r in got[:50]) == list(range(50))
    assert [r.key for r in got[:50]] != [r.key for r in got[50:100]]


def test_moving_average_short_series_is_kept(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 3.0), ("b", 1, 1.0), ("b", 2, 2.0), ("b", 3, 6.0)], "g string, x int, y double")
    got = {(r.g, r.x): r.smoothed for r in X.moving_average(df, "x", "y", 3, ["g"]).collect()}
    assert got == {("a", 1): 1.0, ("a", 2): 3.0, ("b", 2): 3.0}
