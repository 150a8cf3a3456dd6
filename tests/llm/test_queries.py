"""Registered queries: names, SQL twins, and whole-table results of those without SQL."""

import re
import zlib

import pytest

import __spark_entry__ as E
import corpus_pipeline
from tessera.llm import queries as Q
from tests.conftest import SF_SMALL
from tests.llm import test_cross_align, test_packing, test_periodic, test_piece_codec, test_simhash

NO_SQL = {"op1_simhash_near_dedup", "op5_karmarkar_karp_shards", "op6_pu_toxicity", "op9_pack_powers_of_two", "op11_periodic_runs",
          "op12_cross_tokenizer_alignment", "op13_sentencepiece_codec"}


def test_one_query_per_operator_and_the_pipeline():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in Q.QUERIES) == list(range(1, 14))
    assert set(Q.QUERIES) - set(Q.ORACLES) == NO_SQL
    assert set(E.queries()) >= set(Q.QUERIES) | {"pipeline"} and set(E.oracle_sql()) >= set(Q.ORACLES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "mixing", "packing"]


@pytest.fixture(scope="module")
def documents(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]


def test_op1_on_driver_rows(spark, documents):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in Q.QUERIES["op1_simhash_near_dedup"](spark, SF_SMALL).collect()}
    fps = [test_simhash.brute_fingerprint(t) for _, t in documents]
    comp = test_simhash.brute_components([i for i, _ in documents], fps)
    assert got == {i: (f"{f:016x}", c) for (i, _), f, c in zip(documents, fps, comp)}


def test_op5_on_driver_rows(spark, documents):
    got = Q.QUERIES["op5_karmarkar_karp_shards"](spark, SF_SMALL).collect()
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in got) == sorted(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in documents)
    sums = {}
    for r in got:
        sums[r.shard] = sums.get(r.shard, 0) + r.size
    assert len(sums) == 8 and max(sums.values()) - min(sums.values()) < max(r.size for r in got)


def test_op6_on_driver_rows(spark, documents):
    got = Q.QUERIES["op6_pu_toxicity"](spark, SF_SMALL).collect()
    assert sorted(r.doc_id for r in got) == sorted(i for i, _ in documents)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.5) for r in got)


def test_op9_on_driver_rows(spark, documents):
    got = Q.QUERIES["op9_pack_powers_of_two"](spark, SF_SMALL).collect()
    n = {}
    for r in got:
        n[r.doc_id] = n.get(r.doc_id, 0) + r.length
    assert n == {i: len(test_packing.plain(t)) + 1 for i, t in documents}


def test_op11_on_driver_rows(spark, documents):
    got = Q.QUERIES["op11_periodic_runs"](spark, SF_SMALL).collect()
    assert sorted(map(tuple, got)) == sorted(test_periodic.brute_row(i, t) for i, t in documents)


def test_op12_on_driver_rows(spark, documents):
    got = Q.QUERIES["op12_cross_tokenizer_alignment"](spark, SF_SMALL).collect()
    assert sorted(map(tuple, got)) == sorted(test_cross_align.brute(test_cross_align.encoders(), documents))


def test_op13_on_driver_rows(spark, documents):
    m = test_piece_codec.model()
    got = Q.QUERIES["op13_sentencepiece_codec"](spark, SF_SMALL).collect()
    assert sorted(map(tuple, got)) == sorted(test_piece_codec.brute(m, i, t) for i, t in documents)
