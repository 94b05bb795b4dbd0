from collections import Counter

import pytest
from pyspark.sql import functions as F

import lakesieve.operators.reconcile as reconcile
from lakesieve.operators import delta_totals, reconcile_counts, rows_to_delete, rows_to_insert, snapshot_upsert
from lakesieve.sinks import upsert


def frame(spark, rows):
    return spark.createDataFrame(rows, "a int, b string")


@pytest.mark.parametrize("by", ["columns", "fingerprint"])
def test_delta_with_copies_and_nulls(spark, by):
    source = frame(spark, [(1, "x"), (1, "x"), (2, None), (None, None), (5, "new"), (5, "new")])
    target = frame(spark, [(1, "x"), (2, "gone"), (None, None), (None, None)])
    assert Counter(map(tuple, rows_to_insert(source, target, by).collect())) == {(2, None): 1, (5, "new"): 2}
    assert Counter(map(tuple, rows_to_delete(source, target, by).collect())) == {(2, "gone"): 1}
    assert tuple(reconcile_counts(source, target, by).first()) == (6, 4, 6, 3, 1, 2)


def test_empty_sides(spark):
    rows, none = frame(spark, [(1, "x")]), frame(spark, [])
    assert tuple(reconcile_counts(rows, none).first()) == (1, 0, 1, 1, 0, 1)
    assert tuple(reconcile_counts(none, rows).first()) == (0, 1, 0, 0, 1, 0)
    assert tuple(reconcile_counts(none, none).first()) == (0, 0, 0, 0, 0, 0)


def test_snapshot_keeps_copies(spark):
    source = frame(spark, [(1, "x"), (1, "x")]).withColumn("source_only", F.lit(1))
    target = spark.createDataFrame([("y", 1, 9)], "b string, a int, target_only int")
    new, counts = snapshot_upsert(source, target)
    assert new.columns == ["b", "a"] and new.count() == 2
    assert (counts.first()["to_insert"], counts.first()["to_delete"]) == (2, 1)
    with pytest.raises(ValueError, match="no column"):
        snapshot_upsert(source.select("source_only"), target)


def test_hot_row_is_counted_per_side_before_the_shuffle(spark):
    n = 200_000
    hot = spark.range(n).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("a"), F.lit("x").alias("b"))
    row = reconcile_counts(hot, hot.filter("a <> -1")).first()
    assert row["to_insert"] == (n + 2) // 3 and row["to_delete"] == 0


def test_many_copies_are_written_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(reconcile, "_BLOCK", 7)
    source = frame(spark, [(1, "x")] * 50 + [(2, "y")] * 7 + [(3, "z")] * 8 + [(4, "w")])
    rows = rows_to_insert(source, frame(spark, [(4, "w")]))
    assert Counter(r["a"] for r in rows.collect()) == {1: 50, 2: 7, 3: 8}


def test_blocks_are_spread_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(reconcile, "_BLOCK", 100)
    source = frame(spark, [(1, "x")]).select(F.explode(F.sequence(F.lit(1), F.lit(20_000))).alias("i"), "a", "b").drop("i")
    rows = rows_to_insert(source, frame(spark, [(4, "w")]))
    per_task = rows.groupBy(F.spark_partition_id()).count().collect()
    assert len(per_task) == 8 and max(r["count"] for r in per_task) < 6_000


def test_both_ways_take_the_same_values_as_equal(spark):
    left = spark.sql("SELECT 0.0D d, map('a', 1, 'b', 2) m")
    right = spark.sql("SELECT -0.0D d, map('b', 2, 'a', 1) m")
    for by in ("columns", "fingerprint"):
        assert rows_to_insert(left, right, by).count() == 0


def test_variants_are_compared(spark):
    left = spark.sql("SELECT parse_json('[1, 2]') v UNION ALL SELECT parse_json('[3]')")
    assert rows_to_insert(left, left.limit(1)).count() == 1


def test_odd_names(spark):
    source = frame(spark, [(1, "x"), (2, "y")]).toDF("a.b", "c `d`")
    assert [tuple(r) for r in rows_to_insert(source, source.limit(1)).collect()] == [(2, "y")]


def test_weak_hash_needs_fingerprints(spark):
    rows = frame(spark, [(1, None)])
    assert rows_to_insert(rows, rows, "fingerprint", null_safe=False).isEmpty()
    with pytest.raises(ValueError, match="fingerprints"):
        rows_to_insert(rows, rows, null_safe=False)
    with pytest.raises(ValueError, match="columns or fingerprint"):
        reconcile_counts(rows, rows, by="magic")


def test_totals(spark):
    outcomes = spark.createDataFrame([("processed", 5), ("processed", 0), ("skipped", None), ("failed", None)], "outcome string, appended long")
    assert tuple(delta_totals(outcomes).first()) == (2, 1, 1, 5)


TARGET = [("L", "a", 1, "me"), ("L", "b", 2, "me")]
CHANGES = [("L", "b", 20, "you"), ("T", "b", 30, "you")]
SCHEMA = "g string, code string, upto int, created_by string"


def test_upsert(spark):
    target, changes = spark.createDataFrame(TARGET, SCHEMA), spark.createDataFrame(CHANGES, SCHEMA)
    merged = upsert(target, changes, ["g", "code"], ["upto"])
    expected = [("L", "a", 1, "me"), ("L", "b", 20, "me"), ("T", "b", 30, "you")]
    assert sorted(map(tuple, merged.collect())) == expected
    again = upsert(merged, changes, ["g", "code"], ["upto"])
    assert sorted(map(tuple, again.collect())) == expected


def test_null_keys_match_nothing(spark):
    one = spark.createDataFrame([("L", None, 1, "me")], SCHEMA)
    assert upsert(one, one, ["g", "code"], ["upto"]).count() == 2


def test_upsert_writes_nulls_and_takes_the_latest(spark):
    target = spark.createDataFrame(TARGET, SCHEMA)
    changes = spark.createDataFrame([("L", "b", None, "you"), ("L", "a", 7, "x"), ("L", "a", 9, "y"), ("L", "a", 8, "z")], SCHEMA)
    merged = upsert(target, changes, ["g", "code"], ["upto"], latest_by="upto")
    assert sorted(map(tuple, merged.collect()), key=str) == [("L", "a", 9, "me"), ("L", "b", None, "me")]
