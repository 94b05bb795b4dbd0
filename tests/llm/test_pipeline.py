"""The corpus pipeline against its parts by brute force."""

import gc
import hashlib

import public_tokenizers
import pyarrow as pa
import tiktoken

import corpus_pipeline as pipeline
from lakesieve.llm import bpe
from lakesieve.llm.common import give_back, numbered

from helpers import LOWER, contamination, near_components, no_documents, odd_documents, texts_of


def expected(docs, items, clean=lambda text: any(c.isalpha() for c in text)):
    docs = [(i, t) for i, t in docs if clean(t)]
    last = {}
    for i, t in sorted(docs, key=lambda d: d[0]):
        last[t.translate(LOWER)] = i
    docs = [(i, t) for i, t in docs if last[t.translate(LOWER)] == i]
    found = near_components(docs)
    docs = [(i, t) for i, t in docs if found[i][1] == i]
    return [(i, t) for i, t in docs if not (lambda n, hit, _: hit and 20 * hit >= n)(*contamination(t, items))]


def test_pipeline_is_its_stages(spark, small):
    docs = texts_of(spark.read.parquet(f"{small}/documents.parquet"))
    items = [tuple(r) for r in spark.read.parquet(f"{small}/benchmark.parquet").select("item_id", "text").collect()]
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN,
                                  mergeable_ranks=bpe.read_ranks(f.read()), special_tokens={})
    want = []
    for i, t in expected(docs, items):
        ids = coder.encode_ordinary(t)
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(t.encode()).hexdigest()))
    got = [tuple(r) for r in pipeline.run(spark, small).collect()]
    assert sorted(got) == sorted(want) and 0 < len(got) < len(docs)


def test_stages_keep_the_columns_and_take_odd_tables(spark, small, tmp_path):
    for n, docs in enumerate((odd_documents(spark), no_documents(spark))):
        for k, (_, stage) in enumerate(pipeline.STAGES):
            path = str(tmp_path / f"{n}-{k}")
            out = stage(spark, docs, small)
            if k < len(pipeline.STAGES) - 1:
                assert out.columns == pipeline.COLUMNS
            out.write.parquet(path)
            docs = spark.read.parquet(path)
        assert docs.count() == 0 or n == 0


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", None, None) for i, t in rows],
                                 "doc_id bigint, text string, lang string, source string, n_chars bigint")


def pairs(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_a_rejected_row_takes_no_row_with_its_id(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    known = pipeline.identify_language(spark, docs, small).orderBy("doc_id").limit(2).collect()
    (i, first), (_, second) = [(r.doc_id, r.text) for r in known]
    odd = documents(spark, [(None, ""), (None, second), (i, " \n"), (None, None)])
    out = pairs(pipeline.identify_language(spark, docs.select(*pipeline.COLUMNS).unionByName(odd), small))
    assert (None, second) in out and (i, first) in out
    assert (i, " \n") not in out and (None, "") not in out

    item = next(r.text for r in spark.read.parquet(f"{small}/benchmark.parquet").collect() if len(r.text.split()) > 13)
    docs = documents(spark, [(None, item), (None, "a clean text"), (3, item), (3, "another clean text")])
    assert pairs(pipeline.drop_benchmark_passages(spark, docs, small)) == [(3, "another clean text"), (None, "a clean text")]


def test_one_row_of_each_group_of_copies_stays(spark, small):
    docs = documents(spark, [(None, "copy"), (5, "Copy"), (7, "copy"), (7, "other"), (None, "alone"), (9, "same"),
                             (9, "same"), (9, "Same"), (None, "no id"), (None, "No id"), (None, "no id")])
    out = pairs(pipeline.drop_exact_copies(spark, docs, small))
    assert [(i, t.lower()) for i, t in out] == [(7, "copy"), (7, "other"), (9, "same"), (None, "alone"), (None, "no id")]


def test_one_row_of_each_group_of_near_copies_stays(spark, small):
    one, two, three = (" ".join(f"{w}{n}" for n in range(40)) for w in "abc")
    docs = documents(spark, [(None, one), (8, one + " x"), (6, one + " y"), (None, two), (None, two + " x"), (None, two),
                             (6, three), (6, three + " x"), (None, "alone"), (None, ""), (6, "too")])
    out = pairs(pipeline.drop_near_copies(spark, docs, small))
    assert [(i, t[:3]) for i, t in out] == [(6, "a0 "), (6, "c0 "), (6, "too"), (None, ""), (None, "alo"), (None, "b0 ")]


def test_tokens_are_made_of_small_batches(spark, monkeypatch):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], names=["n"])

    monkeypatch.setattr(pipeline.bpe, "encode_texts", lambda docs, *_: docs.mapInArrow(sizes, "n long"))
    docs = spark.range(3_000).coalesce(1)
    found = [r.n for r in pipeline.encode(spark, docs, "").collect()]
    assert sum(found) == 3_000 and max(found) <= 500


def test_rows_are_numbered_without_python_workers(spark, small):
    plan = numbered(spark.read.parquet(f"{small}/documents.parquet"))._jdf.queryExecution().optimizedPlan().toString()
    assert "LocalRelation" in plan and "LogicalRDD" not in plan and "ExternalRDD" not in plan


def test_workers_keep_no_encoder_after_tokens(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").repartition(8)
    assert pipeline.encode(spark, docs, small).count() == docs.count()

    def encoders(batches):
        rows = sum(batch.num_rows for batch in batches)
        give_back()
        held = sum(type(o).__name__ == "TextEncoder" for o in gc.get_objects())
        yield pa.RecordBatch.from_arrays([pa.array([rows]), pa.array([held])], names=["n", "held"])

    found = docs.select("doc_id").mapInArrow(encoders, "n long, held long").collect()
    assert sum(r.n for r in found) == docs.count() and sum(r.held for r in found) == 0


def test_stages_begin_with_shrunk_heaps(spark, small):
    beans = spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans
    collected = lambda: sum(b.getCollectionCount() for b in beans() if "Old" in b.getName() or "MarkSweep" in b.getName())
    for _, stage in pipeline.STAGES:
        before = collected()
        stage(spark, no_documents(spark), small)
        assert collected() > before
