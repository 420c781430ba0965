"""The training-data queries against their SQL, or against plain versions where SQL has none."""

import hashlib
import zlib

import brute
import numpy as np
import pyarrow.parquet as pq
import pytest
from compare import connect, differences
from newsloom.llm.oracles import all_oracles
from newsloom.llm.queries import all_queries, tokenizer_path

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLE = all_queries(), all_oracles()


@pytest.fixture(scope="module")
def docs():
    table = pq.read_table(f"{SF_DIR}/documents.parquet")
    return dict(zip(table.column("doc_id").to_pylist(), table.column("text").to_pylist(), strict=True))


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_sql(spark, name):
    assert differences(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLE[name]) == []


def test_simhash_groups_equal_all_pairs(spark, docs):
    rows = {r["doc_id"]: r for r in QUERIES["op2_simhash_groups"](spark, SF_DIR).collect()}
    codes = [brute.fingerprint(t) for t in docs.values()]
    assert [rows[d]["fingerprint"] for d in docs] == [f"{c:016x}" for c in codes]
    assert [rows[d]["component_id"] for d in docs] == brute.groups(list(docs), codes)


def test_bpe_roundtrip_equals_the_library(spark, docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    rows = {r["doc_id"]: r for r in QUERIES["op6_bpe_roundtrip"](spark, SF_DIR).collect()}
    assert len(rows) == len(docs)
    for doc_id, text in docs.items():
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        assert rows[doc_id]["n_tokens"] == len(ids)
        assert rows[doc_id]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert rows[doc_id]["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


def check_packed(rows, texts, size=1024):
    """Each id in one piece, checksums right, sequences without gaps and not too long."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert set(pieces) == set(texts)
    for doc_id, text in texts.items():
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for r in sorted(pieces[doc_id], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    padding = total = 0
    for places in sequences.values():
        filled = 0
        for offset, length in sorted(places):
            assert offset == filled and length > 0
            filled += length
        assert filled <= size
        padding += 0 if filled & (filled - 1) == 0 else size - filled
        total += filled
    return padding / total


def test_packing_is_exact_with_little_padding(spark, docs):
    assert check_packed(QUERIES["op7_packing"](spark, SF_DIR).collect(), docs) < 0.02


def test_classifier_on_held_out_labels(spark):
    sf_dir = "/root/testdata/sf0.1"
    rows = {r["doc_id"]: r for r in QUERIES["op9_quality_classifier"](spark, sf_dir).collect()}
    labels = pq.read_table(f"{sf_dir}/labels.parquet").to_pylist()
    assert all(r["held_out"] == brute.held_out(d) and 0 <= r["score"] <= 1 for d, r in rows.items())
    tested = [(x["quality"], rows[x["doc_id"]]) for x in labels if rows[x["doc_id"]]["held_out"]]
    assert len(tested) > 1000
    right = [r["predicted"] == label and r["predicted"] == (r["score"] >= 0.5) for label, r in tested]
    kept = [r["predicted"] for label, r in tested if label == 1]
    dropped = [not r["predicted"] for label, r in tested if label == 0]
    print(np.mean(right), np.mean(kept), np.mean(dropped))
    assert np.mean(right) > 0.97 and np.mean(kept) > 0.98 and np.mean(dropped) > 0.85


def test_pii_equals_the_patterns_as_written(spark, docs):
    rows = {r["doc_id"]: r for r in QUERIES["op10_pii"](spark, SF_DIR).collect()}
    for doc_id, text in docs.items():
        spans = brute.base_spans(text)
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert rows[doc_id]["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        for kind in ("email", "ip", "card", "phone"):
            assert rows[doc_id][f"n_{kind}"] == sum(s[0] == kind for s in spans)
        assert set(listed.split(",")) - {""} <= set(rows[doc_id]["spans"].split(","))


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF_DIR)
        assert after.dtypes == docs.dtypes
        docs = spark.createDataFrame(after.toArrow(), docs.schema)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    kept = {r["doc_id"] for r in QUERIES["op5_quality_rules"](spark, SF_DIR).where("kept").collect()}
    assert set(texts) <= kept
    codes = [brute.fingerprint(t) for t in texts.values()]
    masked = [t for t in texts.values() if "[EMAIL]" in t or "[IP]" in t]
    assert masked and not any(brute.base_spans(t) for t in texts.values())
    assert len(texts) > 0.7 * len(kept) and len(codes) == len(texts)
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    assert check_packed(rows, texts) < 0.03
