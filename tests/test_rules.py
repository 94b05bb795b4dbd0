import json

import pytest

from lakesieve.contracts import RULE_RESULT
from lakesieve.operators import (
    DEFAULT_RULES, Rule, evaluate_all, evaluate_rules, evaluate_rules_isolated, failing_rows,
    gate_report, include_exclude, load_rules, rules_by_table, semi_join_normalized, validate_table,
)


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(
        [(1, "a@b.com", 5), (None, "a@bcom", -1), (3, None, 0), (4, "nonsense", None)], "customer_id int, email string, n int")


def test_counts_rates_and_messages(spark, people):
    rules = [Rule("positive", "n <= 0", "desc", "HIGH"), Rule("fine", "n > 100"), Rule("key", "customer_id IS NULL")]
    rows = {r["rule_name"]: r for r in evaluate_rules(people, rules, "people", "ts", "now").collect()}
    r = rows["positive"]
    assert (r["rule_status"], r["failed_count"], r["total_count"], r["failure_rate"], r["validity_score"]) == ("FAILED", 2, 4, 50.0, 50.0)
    assert r["error_message"] == "Rule failed: 2 records out of 4 failed validation"
    assert (r["table_name"], r["ingestion_time"], r["validated_time"], r["severity"]) == ("people", "ts", "now", "HIGH")
    assert (rows["fine"]["rule_status"], rows["fine"]["error_message"]) == ("PASSED", "")
    assert rows["key"]["failed_count"] == 1


def test_schema_is_the_contract(spark, people):
    result = evaluate_rules(people, [Rule("a", "n > 0")], "people")
    assert result.dtypes == [(f.name, f.dataType.simpleString()) for f in RULE_RESULT]


def test_builtin_email_rule_requires_a_dot(spark, people):
    builtin = rules_by_table(load_rules(spark))
    assert sum(len(r) for r in builtin.values()) == len(DEFAULT_RULES)
    email = next(r for r in builtin["customer_table"] if r.name == "email_format_check")
    assert {r["email"] for r in failing_rows(people, email.condition).collect()} == {"a@bcom", "nonsense"}


def test_only_bad_rules_are_errors(spark, people):
    rules = [Rule("ok", "n <= 0"), Rule("no_column", "nope = 1"), Rule("no_syntax", "n <"), Rule("not_boolean", "n + 1"),
             Rule("bad_cast", "CAST(email AS INT) > 0"), Rule("raises", "raise_error('x') IS NULL"), Rule("aggregate", "count(*) > 1"),
             Rule("subquery", "n = (SELECT max(id) FROM range(6))")]
    rows = evaluate_rules_isolated(people, rules, "people").collect()
    assert [(r["rule_name"], r["rule_status"]) for r in rows] == [
        ("ok", "FAILED"), ("no_column", "ERROR"), ("no_syntax", "ERROR"), ("not_boolean", "ERROR"),
        ("bad_cast", "ERROR"), ("raises", "ERROR"), ("aggregate", "ERROR"), ("subquery", "FAILED")]
    errors = [r for r in rows if r["rule_status"] == "ERROR"]
    assert all((r["failed_count"], r["total_count"], r["validity_score"]) == (0, 4, 100.0) for r in errors)
    assert all(r["error_message"].startswith("SQL condition error") for r in errors)


def test_empty_table_passes_even_broken_rules(spark, people):
    rows = evaluate_rules(people.filter("false"), [Rule("a", "n > 0"), Rule("b", "nope")], "t").collect()
    assert {(r["rule_status"], r["error_message"], r["validity_score"]) for r in rows} == {("PASSED", "Table is empty", 100.0)}


def test_more_rules_than_one_pass(spark, people):
    rules = [Rule(f"r{i}", f"n > {i - 40}") for i in range(70)] + [Rule("bad", "nope"), Rule("raises", "raise_error('x') IS NULL")]
    rows = evaluate_rules_isolated(people, rules, "people").collect()
    assert [r["rule_name"] for r in rows] == [r.name for r in rules]
    values = [5, -1, 0]
    assert [r["failed_count"] for r in rows[:70]] == [sum(v > i - 40 for v in values) for i in range(70)]
    assert [r["rule_status"] for r in rows[70:]] == ["ERROR", "ERROR"]
    assert evaluate_rules(people, [], "people").schema == RULE_RESULT


def test_rules_are_counted_without_a_line_for_each_row(spark, people):
    """Also conditions that no aggregate can hold are counted, which takes such lines."""
    def lines(rules):
        result = evaluate_rules(people, rules, "people")
        plan = result._jdf.queryExecution().optimizedPlan().toString()
        return "explode(" in plan, [(r["failed_count"], r["total_count"]) for r in result.collect()]

    assert lines([Rule("a", "n <= 0"), Rule("b", "n > 3")]) == (False, [(2, 4), (1, 4)])
    assert lines([Rule("a", "n <= 0"), Rule("r", "rand() >= 0")]) == (True, [(2, 4), (4, 4)])


def test_evaluate_all(spark, people):
    rules = {"people": [Rule("a", "n > 0"), Rule("b", "n < 0")]}
    assert evaluate_all({" People ": people, "other": people}, rules).count() == 2
    assert evaluate_all({"other": people}, rules).schema == RULE_RESULT


def test_load_rules_defaults(spark, tmp_path):
    path = tmp_path / "rules.json"
    path.write_text(json.dumps([
        {"rule": "r1", "serverity": "LOW", "sql_condition": [{"a": "x > 1", "b": "y > 1"}, {"c": "z > 1"}]},
        {"severity": "HIGH", "serverity": "LOW", "rule_description": "d", "sql_condition": [{"a": "x < 0"}]},
        {"rule": "none", "sql_condition": []},
    ], indent=2))
    rows = [tuple(r) for r in load_rules(spark, str(path)).collect()]
    assert sorted(rows) == [
        ("a", "Unknown Rule", "d", "HIGH", "x < 0"), ("a", "r1", "", "LOW", "x > 1"),
        ("b", "r1", "", "LOW", "y > 1"), ("c", "r1", "", "LOW", "z > 1")]


def test_unreadable_rules_fall_back(spark, tmp_path):
    broken = tmp_path / "broken.json"
    broken.write_text('[{"rule": "a", "sql_condition": ')
    for path in (str(broken), str(tmp_path / "absent.json"), None):
        assert load_rules(spark, path).count() == len(DEFAULT_RULES)


@pytest.mark.parametrize("required,key,passed,reason", [
    (["customer_id"], "email", False, "null 'email' values"), (["nope", "email"], "email", False, "missing column 'nope'"),
    (["email"], "absent", False, "missing column 'absent'"),
])
def test_gate(spark, people, required, key, passed, reason):
    result = validate_table(people, required, key)
    assert (result.passed, result.reason, result.rows) == (passed, reason, 4)


def test_gate_passes_and_rejects_empty(spark, people):
    assert validate_table(people.filter("customer_id IS NOT NULL"), ["email"], "customer_id").passed
    assert gate_report(people.filter("false"), ["nope"], "nope").first()["reason"] == "no records"


def test_include_exclude(spark):
    df = spark.createDataFrame([("a",), ("b",), (" ",), (None,), ("c",)], "k string")

    def kept(**kw):
        return [r["k"] for r in include_exclude(df, "k", **kw).orderBy("k").collect()]

    assert kept() == ["a", "b", "c"]
    assert kept(include={"a", "c", None}, exclude={"c", None}) == ["a"]
    assert kept(include=set()) == []
    assert kept(exclude=df.filter("k = 'a'")) == ["b", "c"]
    many = {f"x{i}" for i in range(2000)} | {"b"}
    assert kept(include=many) == ["b"] and kept(exclude=many) == ["a", "c"]


def test_semi_join_normalized(spark):
    left = spark.createDataFrame([(" A ", 1), ("b", 2), ("b", 3), (None, 4)], "k string, n int")
    right = spark.createDataFrame([("a",), ("A",), (None,), ("c",)], "k string")
    assert [r["n"] for r in semi_join_normalized(left, right, "k").collect()] == [1]
