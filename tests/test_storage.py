from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lakesieve.contracts import RULE_RESULT
from lakesieve.operators import Rule, evaluate_all
from lakesieve.sinks import fit_partitions, land, read_results, replace_table, silver_path, write_results, write_table
from lakesieve.sources import (
    LayerSource, latest_partition, latest_partition_dir, read_catalog, read_landing, read_layer, read_partition,
    read_table, resolve_partition, resolve_partition_dir,
)
from lakesieve.storage import WORK_FOLDER, child_names, partition_dirs, scratch_path, scratch_root


@pytest.mark.parametrize("category,expected", [
    (None, "s://b/x/orders/"), ("", "s://b/x/orders/"), ("transactions", "s://b/x/orders/transactions/"),
    ("2025 reports", "s://b/x/orders/2025 reports/"),
])
def test_output_path(category, expected):
    assert silver_path("s://b/x/", "orders", category) == expected


def test_scratch_is_the_shared_folder(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_cluster_without_shared_folder_is_refused():
    class Context:
        master, applicationId = "yarn", "app"
        def getCheckpointDir(self): return None

    class Session:
        sparkContext = Context()
        class conf:
            @staticmethod
            def get(key, default): return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_root(Session())


def test_replace_a_table_that_is_being_read(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(5), path)
    replace_table(read_table(spark, path).filter("id > 2"), path)
    assert sorted(r[0] for r in read_table(spark, path).collect()) == [3, 4]
    assert child_names(spark, str(tmp_path)) == [WORK_FOLDER, "t"]
    assert child_names(spark, str(tmp_path / WORK_FOLDER)) == []


def test_failed_replacement_keeps_the_old_data(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(5), path)
    with pytest.raises(Exception, match="boom"):
        replace_table(spark.range(3).select(F.raise_error(F.lit("boom")).cast("string").alias("x")), path)
    assert read_table(spark, path).count() == 5


@pytest.fixture(scope="module")
def slices(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("bronze"))
    rows = [(1, "2025-01-01"), (2, "2025-01-01"), (3, "2025-01-10_00:00:00"), (4, "2025-01-9")]
    (spark.createDataFrame(rows, "n int, ingestion_ts string").write.partitionBy("ingestion_ts").parquet(f"{root}/t"))
    return root


def test_partitions_are_strings_in_string_order(spark, slices):
    root = f"{slices}/t"
    assert set(partition_dirs(spark, root, "ingestion_ts")) == {"2025-01-01", "2025-01-10_00:00:00", "2025-01-9"}
    assert latest_partition_dir(spark, root) == "2025-01-9"
    assert resolve_partition_dir(spark, root) == "2025-01-9"
    assert resolve_partition_dir(spark, root, requested="2025-01-01") == "2025-01-01"
    assert resolve_partition_dir(spark, root, requested="2024") is None
    assert latest_partition_dir(spark, root, "other") is None


def test_read_partition(spark, slices):
    rows = read_partition(spark, f"{slices}/t", "2025-01-10_00:00:00")
    assert rows.columns == ["n"] and [r["n"] for r in rows.collect()] == [3]
    with pytest.raises(ValueError, match="no partition"):
        read_partition(spark, f"{slices}/t", "2024")


def test_partition_of_a_dataframe(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,)], "p string")
    assert latest_partition(df, "p") == "b"
    assert resolve_partition(df, "p", "a") == "a"
    assert resolve_partition(df, "p", "z") is None
    assert latest_partition(df.filter("false"), "p") is None


def test_layers(spark, slices):
    source = LayerSource(bronze=slices, silver=slices)
    assert read_layer(spark, source, "bronze", "t", "2025-01-01").count() == 2
    assert read_layer(spark, source, "silver", "t").count() == 4
    for layer, message in (("copper", "unknown layer"), ("gold", "JDBC url")):
        with pytest.raises(ValueError, match=message):
            read_layer(spark, source, layer, "t")
    with pytest.raises(ValueError, match="folder"):
        read_layer(spark, LayerSource(), "silver", "t")


def test_catalog(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "c"))
    spark.sql(f"CREATE TABLE default.three_rows USING parquet LOCATION '{tmp_path}/c'")
    assert read_catalog(spark, "default", "three_rows").count() == 3


AWKWARD = [(1, 'say "hi",\nthen\\go', datetime(2024, 1, 1, 0, 0, 0, 123456), None), (2, "", None, 1.5), (3, "  two\r\nlines ", None, None),
           (4, None, None, None)]


@pytest.mark.parametrize("fmt", ["json", "csv"])
def test_landing_keeps_awkward_values(spark, tmp_path, fmt):
    df = spark.createDataFrame(AWKWARD, "id int, t string, ts timestamp_ntz, v double")
    folder = land(df, str(tmp_path), "recs", fmt, ts="2025-01-01_10:00:00")
    assert folder == f"{tmp_path}/{fmt}/ingestion_dt=2025-01-01_10-00-00/recs"
    assert sorted(map(tuple, read_landing(spark, folder, fmt, df.schema).collect())) == AWKWARD
    names = child_names(spark, f"{tmp_path}/{fmt}")
    assert ("latest" in names) == (fmt == "json")


@pytest.mark.parametrize("refresh", [False, True])
def test_landed_csv_lines_are_records(spark, tmp_path, refresh):
    texts = ["\\n", "\\\\b\n", "\\", "\r", "\\0", "\\e", " ", "\t \n", "", None, '"\n"', "a,b\\", "x"]
    one = spark.createDataFrame([(t,) for t in texts], "`a\nb\\` string")
    folder = land(one, str(tmp_path), "one", "csv", ts="1", refresh_latest=refresh)
    folder = f"{tmp_path}/csv/latest/one" if refresh else folder
    got = [r[0] for r in read_landing(spark, folder, "csv", one.schema).collect()]
    assert sorted(got, key=repr) == sorted(texts, key=repr)
    assert spark.read.text(folder).where("value NOT LIKE 'a%'").count() == len(texts)
    numbers = spark.createDataFrame([(1,), (None,)], "n int")
    folder = land(numbers, str(tmp_path), "numbers", "csv")
    assert sorted(map(repr, read_landing(spark, folder, "csv", "n int").collect())) == ["Row(n=1)", "Row(n=None)"]


def test_one_landed_csv_file_is_read_by_many_tasks(spark, tmp_path):
    df = spark.range(20_000).selectExpr("id", "concat('line\\n', repeat('\\\\', 1 + int(id % 3)), id) AS t").coalesce(1)
    folder = land(df, str(tmp_path), "recs", "csv")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50k")
    try:
        landed = read_landing(spark, folder, "csv", df.schema)
        assert len(landed.inputFiles()) == 1 and landed.rdd.getNumPartitions() > 4
        assert landed.exceptAll(df).count() == 0 and landed.count() == 20_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_landing_latest(spark, tmp_path):
    df = spark.createDataFrame(AWKWARD, "id int, t string, ts timestamp_ntz, v double")
    land(df, str(tmp_path), "recs", "csv", ts="1", refresh_latest=True)
    assert sorted(map(tuple, read_landing(spark, f"{tmp_path}/csv/latest/recs", "csv", df.schema).collect())) == AWKWARD
    assert land(df, str(tmp_path), "recs", "json").endswith("/json/latest/recs")
    with pytest.raises(ValueError, match="json, csv"):
        land(df, str(tmp_path), "recs", "parquet")
    with pytest.raises(ValueError, match="json or csv"):
        read_landing(spark, str(tmp_path), "parquet", df.schema)


def test_results_replace_only_their_tables(spark, tmp_path):
    path = str(tmp_path / "r")
    one = spark.createDataFrame([(1,)], "n int")
    rules = {"7": [Rule("r", "n > 0")], "b": [Rule("r", "n > 0")]}
    write_results(evaluate_all({"7": one, "b": one}, rules, as_of="old"), path)
    write_results(evaluate_all({"b": one}, rules, as_of="new"), path)
    rows = read_results(spark, path, RULE_RESULT)
    assert rows.dtypes == [(f.name, f.dataType.simpleString()) for f in RULE_RESULT]
    assert {(r["table_name"], r["validated_time"]) for r in rows.collect()} == {("7", "old"), ("b", "new")}


def test_no_results_are_an_empty_typed_table(spark, tmp_path):
    path = str(tmp_path / "r")
    write_results(spark.createDataFrame([], RULE_RESULT), path)
    rows = read_results(spark, path, RULE_RESULT)
    assert rows.count() == 0 and len(rows.columns) == 12


def test_fit_partitions(spark):
    df = spark.range(1000)

    def parts(**kw):
        return fit_partitions(df, **kw).rdd.getNumPartitions()

    assert parts(rows=1000) == 10
    assert parts(rows=1000, rows_per_part=50) == 20
    assert parts(rows=1000, rows_per_part=1) == 1000
    assert "REBALANCE" in fit_partitions(df)._jdf.queryExecution().toString().upper()
