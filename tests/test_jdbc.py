"""The JDBC layer against recording stand-ins: what Spark would be asked to do.

No database is started here, so the round trip itself is not covered.
"""

import pytest
from pyspark.sql import functions as F

from lakesieve.sinks import append_jdbc, overwrite_jdbc
from lakesieve.sources import count_jdbc, jdbc_columns, read_jdbc, read_jdbc_query
from lakesieve.sources import jdbc as source
from lakesieve.sources.jdbc import remote_name

URL, PROPS = "jdbc:test:db", {"user": "u"}


class Recorder:
    """Stands in for a session or a DataFrame; every ``read`` and ``write`` starts a new request.

    ``answers`` maps a part of the requested dbtable to a DataFrame.
    """

    def __init__(self, answers=None):
        self.answers, self.calls = answers or {}, []

    def repartition(self, n):
        return self

    read = property(lambda self: Request(self))
    write = property(lambda self: Request(self))


class Request:
    def __init__(self, owner):
        self.owner, self.current = owner, {}

    def format(self, name):
        self.current["format"] = name
        return self

    def mode(self, name):
        self.current["mode"] = name
        return self

    def option(self, key, value):
        self.current[key] = value
        return self

    def options(self, **kw):
        self.current.update(kw)
        return self

    def save(self):
        self.owner.calls.append(dict(self.current))

    def jdbc(self, url, table, predicates=None, properties=None):
        self.owner.calls.append({"url": url, "dbtable": table, "predicates": predicates, "properties": properties})
        return "by predicates"

    def load(self):
        self.owner.calls.append(dict(self.current))
        for part, answer in self.owner.answers.items():
            if part in self.current["dbtable"]:
                return answer
        raise AssertionError(self.current)


def test_names_are_quoted():
    assert remote_name('odd"name', "dw") == '"dw"."odd""name"'


def test_query_and_count(spark):
    session = Recorder({"count(*)": spark.createDataFrame([(42,)], "c bigint")})
    assert count_jdbc(session, URL, "t", PROPS, "s") == 42
    assert session.calls[0]["dbtable"] == '(SELECT count(*) AS c FROM "s"."t") AS t'
    assert session.calls[0]["user"] == "u" and session.calls[0]["format"] == "jdbc"
    read_jdbc_query(session, URL, "SELECT count(*) AS c FROM x", PROPS)


def test_table_without_a_key_is_one_read(spark):
    whole = spark.range(3)
    session = Recorder({'"t"': whole})
    assert read_jdbc(session, URL, "t", PROPS) is whole


def test_table_is_split_on_its_key(spark):
    session = Recorder({"min(": spark.createDataFrame([(5, 900)], "LO bigint, HI bigint"), '"t"': spark.range(1)})
    read_jdbc(session, URL, "t", PROPS, partition_column="the id", num_partitions=7)
    last = session.calls[-1]
    assert (last["partitionColumn"], last["lowerBound"], last["upperBound"], last["numPartitions"]) == ('"the id"', "5", "900", 7)


@pytest.mark.parametrize("ends,lower,upper", [
    ("CAST(5.00 AS DECIMAL(10,2)) lo, CAST(9.50 AS DECIMAL(10,2)) hi", "5", "9"),
    ("DATE '2024-01-01' lo, DATE '2024-02-01' hi", "2024-01-01", "2024-02-01"),
])
def test_bounds_of_other_types(spark, ends, lower, upper):
    session = Recorder({"min(": spark.sql(f"SELECT {ends}"), '"t"': spark.range(1)})
    read_jdbc(session, URL, "t", partition_column="k", num_partitions=2)
    assert (session.calls[-1]["lowerBound"], session.calls[-1]["upperBound"]) == (lower, upper)


def test_empty_remote_table(spark):
    whole = spark.range(0)
    session = Recorder({"min(": spark.sql("SELECT CAST(NULL AS INT) lo, CAST(NULL AS INT) hi"), '"t"': whole})
    assert read_jdbc(session, URL, "t", partition_column="k", num_partitions=2) is whole
    assert "partitionColumn" not in session.calls[-1]


def test_predicates(spark):
    session = Recorder()
    assert read_jdbc(session, URL, "t", PROPS, "s", predicates=["a < 1", "a >= 1"]) == "by predicates"
    assert session.calls[0]["predicates"] == ["a < 1", "a >= 1"] and session.calls[0]["properties"]["user"] == "u"


def test_columns_in_ordinal_order(spark):
    session = Recorder({"information_schema": spark.createDataFrame(
        [("t", "b", 2), ("t", "a", 1), ("u", "z", 1)], "TABLE_NAME string, COLUMN_NAME string, ORDINAL_POSITION int")})
    assert jdbc_columns(session, URL, "it's") == {"t": ["a", "b"], "u": ["z"]}
    assert "table_schema = 'it''s'" in session.calls[0]["dbtable"]


def test_writes():
    df = Recorder()
    append_jdbc(df, URL, "t", PROPS, "s")
    overwrite_jdbc(df, URL, "t", PROPS)
    overwrite_jdbc(df, URL, "t", PROPS, truncate=True, writers=3, batch_size=10)
    first, second, third = df.calls
    assert (first["mode"], first["batchsize"], first["dbtable"], first["numPartitions"]) == ("append", 5000, '"s"."t"', 8)
    assert (second["mode"], second["batchsize"], second["numPartitions"], second["truncate"]) == ("overwrite", 5000, 8, False)
    assert (third["truncate"], third["numPartitions"], third["batchsize"]) == (True, 3, 10)
