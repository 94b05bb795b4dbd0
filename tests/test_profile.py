import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lakesieve.operators import all_null_rows, duplicate_count, null_counts, profile, scorecard

BOTH = pytest.mark.parametrize("by", ["columns", "fingerprint"])


@BOTH
def test_against_plain_python(spark, by):
    rng = random.Random(7)
    rows = [tuple(rng.choice([None, 1, 2]) for _ in range(3)) for _ in range(500)]
    row = profile(spark.createDataFrame(rows, "a int, b int, c int"), by).first()
    nulls = sum(v is None for r in rows for v in r)
    repeats = sum(n - 1 for n in Counter(rows).values())
    assert row["number_of_records"] == 500
    assert row["total_cell_nulls"] == nulls
    assert row["total_null_record"] == sum(all(v is None for v in r) for r in rows)
    assert row["total_duplicated_records"] == repeats
    assert row["percentage_of_null_values"] == pytest.approx(nulls / 1500 * 100, abs=0.005)
    assert row["uniqueness_score"] == pytest.approx(1 - repeats / 500, abs=5e-5)


@BOTH
def test_empty_table(spark, by):
    row = profile(spark.createDataFrame([], "a int, b string"), by).first()
    assert row["is_empty"] and row["number_of_records"] == 0 and row["table_size_mb"] == 0.0
    assert (row["completeness_score"], row["uniqueness_score"], row["data_score"]) == (1.0, 1.0, 100.0)


def test_no_columns(spark):
    row = profile(spark.range(3).select()).first()
    assert (row["number_of_records"], row["total_cell_nulls"], row["total_duplicated_records"]) == (3, 0, 0)
    assert duplicate_count(spark.range(3).select()).first()[0] == 0


@BOTH
def test_odd_column_names(spark, by):
    df = spark.createDataFrame([(1, None, 3), (1, None, 3)], "count int, `a.b ``c``` string, `n` int")
    assert profile(df, by).first()["total_duplicated_records"] == 1
    assert [tuple(r) for r in null_counts(df).collect()] == [("count", 0), ("a.b `c`", 2), ("n", 0)]


def test_repeated_column_name(spark):
    df = spark.createDataFrame([(1, None)], "x int, y int").toDF("x", "x")
    assert profile(df).first()["total_cell_nulls"] == 1


@BOTH
def test_special_numbers(spark, by):
    df = spark.sql("SELECT * FROM VALUES (0.0D), (-0.0D), (double('NaN')), (double('NaN')), (NULL), (NULL) AS t(x)")
    row = profile(df, by).first()
    assert row["total_duplicated_records"] == 3
    assert row["total_cell_nulls"] == 2


@BOTH
def test_nested_columns(spark, by):
    df = spark.sql("SELECT array(1, 2) a, named_struct('t', TIMESTAMP '2024-01-01 00:00:00.000001') s, X'00FF' b "
                   "UNION ALL SELECT array(1, 2), named_struct('t', TIMESTAMP '2024-01-01 00:00:00.000002'), X'00FF' "
                   "UNION ALL SELECT array(1, 2), named_struct('t', TIMESTAMP '2024-01-01 00:00:00.000001'), X'00FF'")
    assert duplicate_count(df, by).first()[0] == 1


@BOTH
def test_maps_and_variants(spark, by):
    df = spark.sql("SELECT map('a', 1, 'b', 2) m, parse_json('[1]') v UNION ALL SELECT map('b', 2, 'a', 1), parse_json('[1]')")
    assert profile(df, by).first()["total_duplicated_records"] == 1


@BOTH
def test_more_columns_than_one_mask(spark, by):
    width = 130
    df = spark.range(4).select(*[
        F.when(F.col("id") % (i + 1) == 0, F.lit(None).cast("int")).otherwise(F.lit(i)).alias(f"c{i}") for i in range(width)])
    row = profile(df, by).first()
    assert row["total_cell_nulls"] == sum(k % (i + 1) == 0 for k in range(4) for i in range(width))
    assert row["total_null_record"] == 1


def test_size_counts_the_bytes_of_the_json_rows(spark):
    n = 40_000
    df = spark.range(n).select(F.lit("é" * 20).alias("t"), F.lit(None).cast("string").alias("e"))
    per_row = len('{"t":"' + "é" * 20 + '","e":null}'.encode().decode()) + 20
    assert profile(df).first()["table_size_mb"] == round(n * per_row / 1048576, 2)
    assert profile(df, size=False).first()["table_size_mb"] == 0.0


def test_scorecard(spark):
    card = scorecard({"orders_2024": spark.createDataFrame([(1,), (1,), (None,)], "x int"),
                      "misc": spark.createDataFrame([], "x int")},
                     {"orders_2024": "2024-01-01"}, as_of="now")
    rows = {r["table_name"]: r for r in card.collect()}
    full, empty = rows["orders_2024"], rows["misc"]
    assert (full["category"], full["processing_status"], full["ingestion_timestamp"]) == ("Sales", "SUCCESS", "2024-01-01")
    assert (full["percentage_of_null_values"], full["completeness_score"], full["uniqueness_score"], full["data_score"]) == (
        33.33, 0.6667, 0.6667, 66.67)
    assert (empty["category"], empty["processing_status"], empty["ingestion_timestamp"]) == ("Other", "EMPTY_TABLE", "")
    assert empty["data_score"] == 100.0 and empty["check_timestamp"] == "now"


def test_all_null_rows(spark):
    df = spark.createDataFrame([(None, None), (1, None)], "a int, `b.c` int")
    assert all_null_rows(df).count() == 1
    assert all_null_rows(spark.range(2).select()).count() == 0


def test_fingerprints_tell_rows_apart(spark):
    from itertools import product

    from lakesieve.functions.hashing import row_fingerprint

    texts = [None, "", "|", "1", "1|", "|1", "a", "a|", "|a"]
    rows = [(n, a, b) for n, a, b in product([None, 1, 11], texts, texts)]
    df = spark.createDataFrame(rows, "n int, a string, b string")
    prints = {bytes(r[0]) for r in df.select(row_fingerprint(df.schema.fields)).collect()}
    assert len(prints) == len(rows) and {len(p) for p in prints} == {32}
    same = spark.sql("SELECT 0.0D x, map('a', 1, 'b', 2) m UNION ALL SELECT -0.0D, map('b', 2, 'a', 1)")
    assert len({bytes(r[0]) for r in same.select(row_fingerprint(same.schema.fields)).collect()}) == 1
