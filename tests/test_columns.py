import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakesieve.contracts import RULE_RESULT, SCORECARD
from lakesieve.functions import with_row_hash
from lakesieve.operators import (
    cast_if_present, dates_to_string, drop_null_columns, fill_defaults, ordered_list, overlap,
    standard_names, standardize_columns, with_constants,
)
from lakesieve.plans import WORKBOOK_HEADERS


def test_standardize_prefers_the_exact_mapping(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["Access Code", "access code!", "a.b `c`"])
    assert standardize_columns(df, {"Access Code": "code"}).columns == ["code", "access_code", "a_b_c"]


def test_colliding_names_are_refused():
    with pytest.raises(ValueError, match="both be named"):
        standard_names(["discamt", "DiscAmt"], WORKBOOK_HEADERS)
    with pytest.raises(ValueError, match="both be named"):
        standard_names(["a b", "A_B"])


def test_drop_null_columns(spark):
    df = spark.createDataFrame([(1, None, None, "x"), (None, None, None, "y")],
                               "a int, `b.c` string, s struct<x:int>, `d d` string")
    assert drop_null_columns(df.withColumn("v", F.lit(None))).columns == ["a", "d d"]
    assert drop_null_columns(df.filter("false")).columns == df.columns
    assert drop_null_columns(df.select(F.lit(None).alias("v"))).columns == []


def test_drop_void_fields_inside_structs(spark):
    df = spark.sql("SELECT 1 AS a, named_struct('x', NULL, 'y.z', named_struct('v', NULL, 'w', 2), 'n', named_struct('q', NULL)) AS s, "
                   "named_struct('x', NULL) AS gone, CAST(NULL AS STRUCT<p: INT>) AS empty")
    kept = drop_null_columns(df)
    assert kept.dtypes == [("a", "int"), ("s", "struct<y.z:struct<w:int>>")]
    assert kept.first()["s"][0]["w"] == 2


def test_dates_to_string_covers_every_date_type(spark):
    df = spark.sql("SELECT DATE '2024-02-03' d, TIMESTAMP '2024-02-03 04:05:06' t, "
                   "TIMESTAMP_NTZ '2024-02-03 23:59:59' n, 5 AS x, CAST(NULL AS DATE) AS e")
    assert tuple(dates_to_string(df).first()) == ("2024-02-03", "2024-02-03", "2024-02-03", 5, None)


def test_cast_if_present(spark):
    df = spark.createDataFrame([("2024-01-02",), ("never",)], "event_date string")
    values = [r[0] for r in cast_if_present(df, "event_date").collect()]
    assert values == [datetime.datetime(2024, 1, 2), None]
    assert cast_if_present(df, "other") is df


def test_constants(spark):
    row = with_constants(spark.range(1), {"a": "x", "b": 2, "c": None}).first()
    assert (row["a"], row["b"], row["c"]) == ("x", 2, None)


def test_overlap(spark):
    source = spark.createDataFrame([(1, 2, 3)], ["a", "b", "c.d"])
    target = spark.createDataFrame([(1, 2, 3)], ["c.d", "z", "a"])
    assert overlap(target, source).columns == ["c.d", "a"]
    assert overlap(target.select("z"), source) is None


def test_fill_defaults(spark):
    df = spark.createDataFrame([(None, "7")], "table_name string, failed_count string")
    row = fill_defaults(df, RULE_RESULT).first()
    assert row["table_name"] == "" and row["failed_count"] == 7 and row["failure_rate"] == 0.0
    assert fill_defaults(df, SCORECARD).first()["is_empty"] is False
    assert fill_defaults(df, SCORECARD).dtypes == [(f.name, f.dataType.simpleString()) for f in SCORECARD]


def hashes(df, **kw):
    return [r["hash_value"] for r in with_row_hash(df, **kw).collect()]


def test_null_safe_hash_keeps_nulls_and_separators_apart(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None), ("a||b", None, None)], "x string, y string, z string")
    assert len(set(hashes(df))) == 3
    assert len(set(hashes(df, null_safe=False))) == 1


def test_hash_of_every_type(spark):
    df = spark.sql("SELECT 1 i, 1.5D d, X'FF' b, array(1, NULL) a, map('k', 1) m, named_struct('x', NULL, 'y', 2) s, "
                   "TIMESTAMP '2024-01-01 00:00:00.000001' t, NULL v, parse_json('{\"q\": 1}') j")
    later = df.withColumn("t", F.expr("t + INTERVAL '0.000001' SECOND"))
    nested = df.withColumn("s", F.expr("named_struct('x', 2, 'y', NULL)"))
    values = hashes(df) + hashes(later) + hashes(nested) + hashes(df.withColumn("b", F.expr("X'FE'")))
    assert len(set(values)) == 4
    assert all(len(v) == 64 for v in values)
    assert hashes(df.drop("m", "j"), null_safe=False)


def test_ordered_list(spark):
    df = spark.createDataFrame([("t", 3, "c"), ("t", 1, "a"), ("u", 1, "z"), ("t", 2, None)], "k string, o int, v string")
    lists = {r["k"]: r["values"] for r in ordered_list(df.repartition(4), "k", "o", "v").collect()}
    assert lists == {"t": ["a", None, "c"], "u": ["z"]}


def test_contract_types():
    assert [f.dataType for f in RULE_RESULT][7:11] == [T.LongType(), T.LongType(), T.DoubleType(), T.DoubleType()]
    assert len(RULE_RESULT) == 12 and len(SCORECARD) == 17
