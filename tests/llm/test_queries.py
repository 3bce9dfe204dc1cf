"""Every registered query of the training-data operators: SQL where there is some, brute force otherwise."""

import zlib

import numpy as np
import pytest

import __spark_entry__ as E
import corpus_pipeline
from vaultsmith.llm import catalog
from vaultsmith.llm._tokens import tokenizer_path
from vaultsmith.llm.lattice import SPACE, Pieces, best_path, words

from ..conftest import SF_SMALL
from ..oracle import duck, spark_rows, sql_rows

ORACLE = catalog.oracle_sql()


def documents():
    return duck(SF_SMALL).execute("SELECT doc_id, coalesce(text, '') FROM documents ORDER BY doc_id").fetchall()


def test_one_query_per_operator():
    names = sorted(catalog.queries(), key=lambda n: int(n[2:].split("_")[0]))
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14))
    assert set(names) | {"pipeline"} <= set(E.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    cols, expected = sql_rows(duck(SF_SMALL), ORACLE[name])
    df = catalog.queries()[name](spark, SF_SMALL)
    assert sorted(df.columns) == sorted(cols)
    assert spark_rows(df) == expected


def encoded(name, end):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path(name))
    return [(i, np.array(t.encode(x, add_special_tokens=False).ids + [end], "<u4")) for i, x in documents()]


def test_packing_holds_every_id_once(spark):
    rows = catalog.queries()["op2_hilbert_packing"](spark, SF_SMALL).collect()
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append(r)
    truth = encoded("byte_bpe_50k.json", 1)
    assert set(by_doc) == {i for i, _ in truth}
    for i, ids in truth:
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[at:at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    last = max(by_seq)
    for s, pieces in by_seq.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at == 2048 or (s == last and at <= 2048)


def test_token_files_read_back(spark):
    rows = {r["doc_id"]: r for r in catalog.queries()["op4_rans_token_files"](spark, SF_SMALL).collect()}
    at = 0
    for i, ids in encoded("word_bpe_49k.json", 2):
        assert (rows[i]["start"], rows[i]["n_tokens"], rows[i]["ids_crc32"]) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_lattice_is_the_best_path(spark):
    model = Pieces(tokenizer_path("piece_bpe_32k.model"))
    rows = {r["doc_id"]: r for r in catalog.queries()["op7_lattice_encoding"](spark, SF_SMALL).collect()}
    known = {}
    for i, text in documents():
        ids = []
        for u in words(text):
            if u not in known:
                known[u] = best_path(SPACE + u, model)
            ids += known[u]
        assert (rows[i]["n_tokens"], rows[i]["ids_crc32"]) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        assert rows[i]["round_trip"] and SPACE not in text


def test_toxicity_on_labels(spark):
    """Flags nearly all documents labelled toxic and leaves nearly all others alone."""
    sf = "/root/testdata/sf0.1"
    rows = {r["doc_id"]: r for r in catalog.queries()["op8_toxicity"](spark, sf).collect()}
    labels = duck(sf).execute("SELECT doc_id, toxic FROM labels").fetchall()
    caught = [rows[i]["toxic"] for i, t in labels if t]
    wrong = [rows[i]["toxic"] for i, t in labels if not t]
    assert np.mean(caught) >= 0.94 and np.mean(wrong) <= 0.03
    assert all(r["kept"] != r["toxic"] and 0 <= r["expected_severity"] <= 3 for r in rows.values())
    assert len({r["severity"] for r in rows.values()}) == 4


def test_pipeline_equals_its_stages_by_brute_force(spark):
    from vaultsmith.llm.minmax import _words, shingle_set

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "toxicity", "near-duplicates", "packing"]
    kept = {r["doc_id"] for r in catalog.queries()["op9_quality_rules"](spark, SF_SMALL).where("kept").collect()}
    after = corpus_pipeline.quality_stage(spark, docs, SF_SMALL)
    assert after.columns == docs.columns and {r["doc_id"] for r in after.collect()} == kept
    after = corpus_pipeline.toxicity_stage(spark, after, SF_SMALL)
    left = {r["doc_id"]: r["text"] for r in after.collect()}
    assert set(left) <= kept
    sets = {i: set(shingle_set(_words(t), 5).tolist()) for i, t in left.items()}
    group = {i: i for i in sets}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                group[y] = x
    expected = {i for i in ids if root(i) == i}
    after = corpus_pipeline.near_duplicate_stage(spark, after, SF_SMALL)
    assert after.columns == docs.columns and {r["doc_id"] for r in after.collect()} == expected
    packed = corpus_pipeline.run(spark, SF_SMALL)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == expected
