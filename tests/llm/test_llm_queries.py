"""Registered queries against SQL or brute force over whole tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from lakesieve.llm.queries import ORACLES, QUERIES

from helpers import near_components, texts_of

TABLES = ("documents", "benchmark", "labels", "conversations")


def rows(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_same_answer_as_sql(spark, small, key):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    df = QUERIES[key](spark, small)
    result = con.execute(ORACLES[key])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    expected = sorted((tuple(r[names.index(c)] for c in sorted(names)) for r in result.fetchall()), key=repr)
    assert rows(df) == expected


def test_one_query_per_operator_is_registered():
    found = contract.queries()
    assert [sum(k.startswith(f"op{n}_") for k in found) for n in range(1, 14)] == [1] * 13
    assert "pipeline" in found


@pytest.mark.parametrize("key", ["op1_toxicity", "op2_secret_scan", "op3_byte_bpe", "op4_token_counts", "op10_language_id"])
def test_one_row_per_document(spark, small, key):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    got = QUERIES[key](spark, small)
    assert sorted(r.doc_id for r in got.select("doc_id").collect()) == sorted(i for i, _ in texts_of(docs))


def test_near_duplicates_of_all_documents(spark, small):
    expected = near_components(texts_of(spark.read.parquet(f"{small}/documents.parquet")))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op6_minhash_near_dup"](spark, small).collect()}
    assert got == expected


def test_language_of_held_out_documents(spark, medium):
    docs = spark.read.parquet(f"{medium}/documents.parquet").select("doc_id", "lang")
    held = QUERIES["op10_language_id"](spark, medium).where("held_out").join(docs, "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.98
    assert not any(r.rejected for r in held)


def test_toxicity_of_held_out_documents(spark):
    large = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{large}/labels.parquet")
    held = QUERIES["op1_toxicity"](spark, large).where("held_out").join(labels, "doc_id").collect()
    toxic, clean = ([r.score for r in held if r.toxic == k] for k in (1, 0))
    better = sum((t > c) + 0.5 * (t == c) for t in toxic for c in clean) / (len(toxic) * len(clean))
    assert better > 0.94
    assert sum(s >= 0.7 for s in clean) < 0.01 * len(clean)
    assert sum(s >= 0.7 for s in toxic) >= 0.7 * len(toxic)
