import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakesieve.functions import (
    checkpoint_code, fiscal_year, kebab_case, kebab_name, keyword_category, label_category,
    snake_case, snake_name, split_label, stored_code, strip_affix,
)


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return row.select(column).first()[0]


@pytest.mark.parametrize("text,expected", [
    ("Hello World!!  Test", "hello_world_test"), ("__a--b__", "a_b"), ("", ""), ("???", ""),
    ("Ünïcode Name", "n_code_name"), (None, None), ("already_snake", "already_snake"),
])
def test_snake_case(spark, text, expected):
    assert one(spark, snake_case("x"), x=text) == expected


def test_kebab_case(spark):
    assert one(spark, kebab_case("x"), x="Hello World!!  Test") == "hello-world-test"


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(st.text(max_size=20), min_size=1, max_size=30))
def test_names_and_columns_agree(spark, texts):
    rows = spark.createDataFrame([(t,) for t in texts], "x string")
    for r in rows.select("x", snake_case("x").alias("s"), kebab_case("x").alias("k")).collect():
        assert r["s"] == snake_name(r["x"])
        assert r["k"] == kebab_name(r["x"])


@pytest.mark.parametrize("text,expected", [
    ("FY17", "FY17"), ("Hart fy20 x FY21", "fy20"), ("FY2", ""), ("none", ""), ("xFy199", "Fy19"),
])
def test_fiscal_year(spark, text, expected):
    assert one(spark, fiscal_year("x"), x=text) == expected


@pytest.mark.parametrize("text,expected", [
    ("FY17", "FY"), ("Donation FY18", "donation"), ("Hart FY20", "hart"), ("Notes", "OTHERS"),
    ("  gift   fy2020 ", "gift"), ("GiftFY20", "gift"), ("Gift 2 FY20", "OTHERS"),
    ("FY20 extra", "OTHERS"), ("", "OTHERS"), (None, "OTHERS"), ("\tDonation\u00a0FY18\n", "donation"),
])
def test_label_category(spark, text, expected):
    assert one(spark, label_category("x"), x=text) == expected


@pytest.mark.parametrize("text,expected", [
    ("Hart FY20", ("Hart", "FY20")), ("  Hart \t FY20 x", ("Hart", "FY20")), ("FY20", ("FY20", None)),
])
def test_split_label(spark, text, expected):
    rows = spark.createDataFrame([(text,)], "x string").select(*split_label("x"))
    assert rows.columns == ["museum_code", "fiscal_year"]
    assert tuple(rows.first()) == expected


def test_keyword_category_takes_the_first_match(spark):
    rules = {"A": ["apple", "pie"], "B": ["pie", "app"]}
    assert one(spark, keyword_category("x", rules), x="APPLE pie") == "A"
    assert one(spark, keyword_category("x", rules), x="App") == "B"
    assert one(spark, keyword_category("x", rules), x="pear") == "Other"
    assert one(spark, keyword_category("x", rules), x=None) == "Other"
    assert one(spark, keyword_category("x", {}), x="pear") == "Other"


def test_checkpoint_codes(spark):
    code = checkpoint_code(F.lit("lake"), "k", "s")
    assert one(spark, code, k="Final Sales", s="Gift!") == "lake.final_sales.gift"
    assert one(spark, code, k="Final Sales", s="") == "lake.final_sales"
    assert one(spark, code, k="Final Sales", s=None) == "lake.final_sales"
    assert one(spark, stored_code(F.lit("Loading"), code), k="a", s=None) == "loading.lake.a"


def test_strip_affix_is_anchored(spark):
    column = strip_affix("x", "raw.", "_json")
    assert one(spark, column, x="raw.a_json_json") == "a_json"
    assert one(spark, column, x="rawxa_json_b") == "rawxa_json_b"
    assert one(spark, column, x="a raw.b") == "a raw.b"
    assert re.escape("raw.") != "raw."
