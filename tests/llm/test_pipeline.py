import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lakestrata.llm import queries
from tests.conftest import SF_SMALL
from tests.llm import test_repeats
from tests.llm.cases import awkward, frame, prose

pytest.importorskip("public_tokenizers")


def test_stages_are_named_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "MinHash near-dedup", "substring dedup", "secret scans", "best-fit packing"]


def test_stages_pass_on_documents(spark):
    good = "The cat of the house was in a box and it is on the mat with that dog for this " + prose(1, 100)
    docs = frame(spark, awkward() + [(100, good), (101, good), (102, good + ' token = "ab8ca1b325bc4f85aa6a79e73fc4cbfc2098878e"'),
                                     (103, prose(60, 60) + " the of and to in " + good)])
    kept = corpus_pipeline.quality_rules(spark, docs, "")
    assert {100, 101, 102, 103} <= {r["doc_id"] for r in kept.collect()}
    one = corpus_pipeline.near_dedup(spark, kept, "")
    ids = [r["doc_id"] for r in one.collect()]
    assert 100 in ids and 101 not in ids and 103 in ids and len(ids) == len(set(ids))
    rows = [(r["doc_id"], r["text"]) for r in one.collect()]
    cut = corpus_pipeline.substring_dedup(spark, one, "")
    want = {w[0]: w[4].decode() if w[2] else t for w, (_, t) in zip(test_repeats.brute(rows, True), rows, strict=True)}
    assert {r["doc_id"]: r["text"] for r in cut.collect()} == want
    masked = corpus_pipeline.secret_scans(spark, cut, "")
    assert masked.columns == docs.columns and all(r["n_chars"] == len(r["text"]) for r in masked.collect())
    packed = corpus_pipeline.best_fit_packing(spark, masked, "").collect()
    assert {r["doc_id"] for r in packed} == set(ids)


def test_run_on_the_smallest_tables(spark):
    out = corpus_pipeline.run(spark, SF_SMALL)
    rows = out.collect()
    assert rows and all(0 < r["length"] <= 4096 for r in rows)
    # the ids are there whole, in gapless sequences, each document from its start to its end id
    assert all(len(r["ids"]) == 4 * r["length"] and zlib.crc32(r["ids"]) == r["ids_crc32"] for r in rows)
    places, documents = {}, {}
    for r in rows:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        documents.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["length"], bytes(r["ids"])))
    for own in places.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:i]) for i in range(len(own))] and sum(n for _, n in own) <= 4096
    for own in documents.values():
        own.sort()
        assert [(p, s) for p, s, *_ in own] == [(i, sum(x[2] for x in own[:i])) for i in range(len(own))]
        assert own[-1][3][-4:] == (1).to_bytes(4, "little")


def test_stages_on_an_empty_table_with_more_columns(spark):
    """No rows, and columns that operators use inside, through all stages."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0).withColumns({c: F.lit("x") for c in ("id", "uid", "word", "length")})
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_SMALL)
        assert out.count() == 0
        assert name == "best-fit packing" or set(out.columns) == set(docs.columns)
        docs = out


@pytest.mark.parametrize("name", ["op4_toxicity", "op5_secret_scan", "op6_bpe", "op7_pii", "op8_minhash_near_dedup", "op10_best_fit_packing"])
def test_queries_cover_every_document(spark, name):
    docs = {r["doc_id"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id").collect()}
    assert {r["doc_id"] for r in queries.QUERIES[name](spark, SF_SMALL).collect()} == docs
