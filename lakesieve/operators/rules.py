"""SQL business rules over a table, many of them in one pass.

A rule condition is SQL text that is TRUE for a failing row. Text comes from users, so a rule may
not even analyze, or may break on the data; either makes that rule an ERROR row, no other.
Write patterns as raw strings (``r'\\.'``): in a plain SQL literal the backslash is an escape.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..contracts import RULE_RESULT
from .isolation import run_isolated

log = logging.getLogger(__name__)

CONFIG_SCHEMA = (
    "rule string, rule_description string, severity string, serverity string, "
    "sql_condition array<map<string,string>>"
)

# The built-in rules, as (table, rule, description, severity, condition).
DEFAULT_RULES = [
    ("customer_table", "email_format_check", "Check if email column contains valid email format", "HIGH",
     r"email IS NOT NULL AND email NOT REGEXP r'^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$'"),
    ("customer_table", "customer_id_not_null", "Check if customer_id is not null", "CRITICAL",
     "customer_id IS NULL"),
    ("order_table", "order_amount_positive", "Check if order amount is positive", "MEDIUM",
     "order_amount <= 0"),
    ("order_table", "order_date_valid", "Check if order date is not in future", "HIGH",
     "order_date > CURRENT_DATE"),
    ("product_table", "product_price_positive", "Check if product price is positive", "MEDIUM",
     "price <= 0"),
]


@dataclass(frozen=True)
class Rule:
    name: str
    condition: str
    description: str = ""
    severity: str = "MEDIUM"


def load_rules(spark: SparkSession, path: str | None = None, multi_line: bool = True) -> DataFrame:
    """One row (table_name, rule_name, rule_description, severity, sql_condition) per table and rule.

    The file is one JSON array, or one object per line with ``multi_line=False``. Without a path,
    or when it cannot be read or is malformed, the built-in rules apply.
    """
    columns = ["table_name", "rule_name", "rule_description", "severity", "sql_condition"]
    builtin = spark.createDataFrame(DEFAULT_RULES, ", ".join(f"{c} string" for c in columns))
    if path is None:
        return builtin
    try:
        config = spark.read.schema(CONFIG_SCHEMA).json(path, multiLine=multi_line, mode="FAILFAST")
        per_table = config.select(
            F.coalesce("rule", F.lit("Unknown Rule")).alias("rule_name"),
            F.coalesce("rule_description", F.lit("")).alias("rule_description"),
            F.coalesce("severity", "serverity", F.lit("MEDIUM")).alias("severity"),
            F.explode("sql_condition").alias("by_table"),
        )
        rules = per_table.select(
            F.explode("by_table").alias("table_name", "sql_condition"),
            "rule_name", "rule_description", "severity",
        ).select(*columns)
        # Reads every field once, so a malformed file shows here and not in a later job.
        rules.agg(*[F.max(F.length(c)) for c in columns]).collect()
        return rules
    except (PySparkException, Py4JJavaError) as error:
        log.warning("rules at %s cannot be read, using the built-in ones: %s", path, error)
        return builtin


def rules_by_table(rules: DataFrame) -> dict[str, list[Rule]]:
    """The configuration as plan input. Table names match without case or outer blanks."""
    grouped: dict[str, list[Rule]] = {}
    for r in rules.collect():
        rule = Rule(r["rule_name"], r["sql_condition"], r["rule_description"], r["severity"])
        grouped.setdefault(r["table_name"].strip().lower(), []).append(rule)
    return grouped


def _analysis_error(df: DataFrame, condition: str) -> str | None:
    try:
        df.filter(condition)
        return None
    except PySparkException as error:
        return f"SQL condition error: {error}"


def _analyzed(df: DataFrame, rules: Sequence[Rule]) -> dict[Rule, str | None]:
    distinct = list(dict.fromkeys(rules))
    try:
        df.filter(reduce(Column.__and__, [F.expr(r.condition) for r in distinct]))
        return dict.fromkeys(distinct)
    except PySparkException:
        return {r: _analysis_error(df, r.condition) for r in distinct}


def _numbers(df: DataFrame, conditions: Mapping[int, str]) -> DataFrame:
    """(i, n) that add up to the rows failing condition i.

    Spark compiles each count of an aggregate to a method of its own. Conditions side by side in an array
    become one method, which is too long for the JVM to compile when there are many.
    """
    try:
        counts = df.agg(*[F.count_if(F.expr(c)).alias(str(i)) for i, c in conditions.items()])
        each = F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"`{i}`").alias("n")) for i in conditions])
        return counts.select(F.inline(each)).repartition("i")  # a row per rule
    except PySparkException:
        failing = F.array(*[F.when(F.expr(c), F.lit(i)) for i, c in conditions.items()])
        return df.select(failing.alias("failing")).select(F.explode("failing").alias("i"), F.lit(1).alias("n"))


def evaluate_rules(
    df: DataFrame, rules: Sequence[Rule], table_name: str, ingestion_time: str = "", as_of: str = "",
    errors: Mapping[Rule, str | None] | None = None,
) -> DataFrame:
    """One 12-column line per rule, from one scan of the table for any number of rules.

    Rules are counted in one aggregate. Conditions that can't stand in one, as they are
    non-deterministic, make each row the numbers of the rules it fails, which are counted.
    Conditions that do not analyze become ERROR lines; ``errors``, if given, already says which
    ones do. An empty table passes every rule, whatever its condition.
    """
    if not rules:
        return df.sparkSession.createDataFrame([], RULE_RESULT)
    found = _analyzed(df, rules) if errors is None else errors
    # Rule -1 stands for every row. One line per rule is left, so the counts fit into one row.
    numbers = _numbers(df, {-1: "true"} | {i: r.condition for i, r in enumerate(rules) if found[r] is None})
    counts = numbers.where("i IS NOT NULL").groupBy("i").agg(F.sum("n").alias("count")).agg(
        F.map_from_entries(F.collect_list(F.struct("i", "count"))).alias("counts"))

    def counted(i: int) -> Column:
        return F.coalesce(F.try_element_at("counts", F.lit(i)), F.lit(0).cast("long"))

    total, failed = F.col("total"), F.col("failed")
    lines = F.array(*[
        F.struct(
            F.lit(i).alias("i"), F.lit(r.name).alias("rule_name"), F.lit(r.description).alias("rule_description"),
            F.lit(r.severity).alias("severity"), F.lit(found[r]).cast("string").alias("error"),
            counted(i).alias("failed"),
        )
        for i, r in enumerate(rules)
    ])
    broken = F.col("error").isNotNull() & (total > 0)
    share = failed.cast("double") / F.nullif(total.cast("double"), F.lit(0.0))
    return counts.select(counted(-1).alias("total"), F.inline(lines)).select(
        F.lit(table_name).alias("table_name"),
        "rule_name", "rule_description", "severity",
        F.lit(as_of).alias("validated_time"),
        F.lit(ingestion_time).alias("ingestion_time"),
        F.when(broken, "ERROR").when(failed == 0, "PASSED").otherwise("FAILED").alias("rule_status"),
        failed.alias("failed_count"),
        total.alias("total_count"),
        F.coalesce(F.round(share * 100, 2), F.lit(0.0)).alias("failure_rate"),
        F.coalesce(F.round((1 - share) * 100, 2), F.lit(100.0)).alias("validity_score"),
        (F.when(total == 0, "Table is empty")
         .when(broken, F.col("error"))
         .when(failed == 0, "")
         .otherwise(F.format_string("Rule failed: %d records out of %d failed validation", failed, total))
         ).alias("error_message"),
    )


def evaluate_rules_isolated(
    df: DataFrame, rules: Sequence[Rule], table_name: str, ingestion_time: str = "", as_of: str = ""
) -> DataFrame:
    """As :func:`evaluate_rules`, run at once, with rules that break on the data singled out.

    The result has one line per rule, so it is held on the driver between the runs. Only errors
    that Spark reports about data or SQL count against a rule; a failing cluster raises.
    """
    known = _analyzed(df, rules)

    def run(part: Sequence[Rule]) -> list[Row]:
        return evaluate_rules(df, part, table_name, ingestion_time, as_of, known).collect()

    def on_error(rule: Rule, error: Exception) -> list[Row]:
        message = f"SQL condition error: {error}"
        return evaluate_rules(df, [rule], table_name, ingestion_time, as_of, {rule: message}).collect()

    def suspects(part: Sequence[Rule], error: Exception) -> list[Rule]:
        # Most errors quote the piece of SQL that failed.
        quoted = [c.fragment() for c in error.getQueryContext()]
        return [r for r in part if any(q and q in r.condition for q in quoted)]

    rows = run_isolated(list(rules), run, on_error, PySparkException, suspects)
    place = {r.name: i for i, r in enumerate(rules)}
    rows.sort(key=lambda row: place[row["rule_name"]])
    return df.sparkSession.createDataFrame(rows, RULE_RESULT)


def evaluate_all(
    tables: Mapping[str, DataFrame], rules: Mapping[str, Sequence[Rule]],
    ingestion_times: Mapping[str, str] | None = None, as_of: str = "",
) -> DataFrame:
    """All tables that have rules, one scan each, as one result set."""
    times = ingestion_times or {}
    results = [
        evaluate_rules(df, rules[name.strip().lower()], name, times.get(name, ""), as_of)
        for name, df in tables.items() if rules.get(name.strip().lower())
    ]
    if not results:
        spark = next(iter(tables.values())).sparkSession
        return spark.createDataFrame([], RULE_RESULT)
    return reduce(DataFrame.unionByName, results)
