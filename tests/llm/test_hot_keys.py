"""Keys that hold a third of all rows are split over tasks, in joins, stars and length classes."""

import collections
import random

import pytest
from pyspark.sql import functions as F

from lexitrend.llm import op6_packing
from lexitrend.llm.common import HOT_PARTS, SLICE_ROWS, hot_keys, split_join
from lexitrend.llm.components import _with_least, components
from tests.llm import edge


@pytest.mark.parametrize("how", ["inner", "left"])
def test_split_join_equals_a_join(spark, how):
    rng = random.Random(1)
    rows = [(7 if k % 3 == 0 else rng.randrange(2000), k) for k in range(6000)] + [(None, -1)]
    left = spark.createDataFrame(rows, "key long, at long")
    right = spark.createDataFrame([(k, f"g{k}") for k in range(0, 2000, 7)], "key long, name string")
    counts = left.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("key is not null")
    hot = hot_keys(counts, ["key"], "n", len(rows))
    assert [tuple(r)[0] for r in hot.collect()] == [7]
    got = split_join(left, right, ["key"], hot, F.col("at"), how)
    assert got.columns == ["key", "at", "name"]
    want = left.join(right, "key", how).select("key", "at", "name")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_hot_keys_are_few_and_slices_small(spark):
    counts = spark.createDataFrame([(k, 10 ** 9 // (k + 1)) for k in range(5000)], "key long, n long")
    total = sum(10 ** 9 // (k + 1) for k in range(5000))
    got = {r["_hot0"]: r["_slices"] for r in hot_keys(counts, ["key"], "n", total).collect()}
    assert len(got) < HOT_PARTS and sum(got.values()) < 2 * HOT_PARTS
    for k in range(5000):
        assert 10 ** 9 // (k + 1) / got.get(k, 1) <= max(total // HOT_PARTS, SLICE_ROWS)


def test_edges_of_a_star_centre_are_spread(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        n = 6000
        edges = spark.range(n).select(F.lit(0).cast("long").alias("u"), (F.col("id") + 1).alias("v"))
        found = _with_least(edges, n)
        assert found.count() == n and {r["m"] for r in found.select("m").distinct().collect()} == {0}
        sizes = [r["count"] for r in found.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert len(sizes) > 1 and max(sizes) < n / 2
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_components_of_large_stars_with_either_end_least(spark):
    edges = [(0, k) for k in range(1, 900)] + [(5000, k) for k in range(1000, 1900)] + [(899, 1000)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "u long, v long")).collect()))
    assert set(got.values()) == {0} and set(got) == {*range(900), *range(1000, 1900), 5000}


def test_a_class_with_most_pieces_has_most_parts(spark):
    """Equal lengths in most rows: packed whole, and every sequence gapless from 0."""
    rows = [(k if k % 3 else None, "same words here" if k % 4 else "other " * (k % 90 + 1)) for k in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = op6_packing.pack(docs, edge.tokenizer("word")).collect()
    assert collections.Counter(r["doc_id"] for r in got) == collections.Counter(i for i, _ in rows)
    at = collections.defaultdict(list)
    for r in got:
        at[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in at.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= op6_packing.SEQ_LEN


def test_components_plans_stay_short(spark, monkeypatch):
    """Each frame a step writes has one aggregate (its partial and final half) and no look-up of hot
    nodes where there is none: the driver plans, compiles and records all of them."""
    from lexitrend.llm import components as C

    plans, real = [], C.staged

    def staged(df, name="stage"):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, name)

    monkeypatch.setattr(C, "staged", staged)
    edges = [(k, k + 1) for k in range(30)] + [(100, 101)]
    got = dict(map(tuple, C.components(spark.createDataFrame(edges, "u long, v long")).collect()))
    assert got == {**{k: 0 for k in range(31)}, 100: 100, 101: 100}
    assert max(p.count("HashAggregate") for p in plans) <= 2 and not any("_slices" in p for p in plans)
