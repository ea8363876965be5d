"""The pipeline against a plain version of each stage, and every query on the smallest tables."""

import string
from collections import Counter

import pytest
import sentencepiece
from oracle_check import compare, connect
from test_dartminhash import classes_by_hand

import corpus_pipeline
from ledgerproof.llm import hyperlang, mixing, pieces
from ledgerproof.llm.common import mod_hash, settle
from ledgerproof.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    ok, _, message = compare(spark, connect(SF), name, QUERIES[name], ORACLES[name], SF)
    assert ok, message


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_runs(spark, name):
    got = QUERIES[name](spark, SF)
    assert got.count() > 0


def stages_by_hand(spark, docs, rows):
    """(doc_id, text) rows of every stage, from the one before."""
    profiles = hyperlang.learn(docs, mod_hash("doc_id", 3) != 1)
    langs, scores = hyperlang.judge([t or "" for _, t, *_ in rows], profiles)
    kept = [r for r, lang, s in zip(rows, langs, scores, strict=True) if lang != "und" and s >= corpus_pipeline.LEAST_SCORE]
    yield kept
    best = {}
    for r in kept:
        text = (r[1] or "").translate(LOWER)
        if text not in best or (r[0] if r[0] is not None else -1) > (best[text][0] if best[text][0] is not None else -1):
            best[text] = r
    kept = list(best.values())
    yield kept
    stay = {r[0] for r in classes_by_hand([(r[0], r[1]) for r in kept]) if r[3]}
    kept = [r for r in kept if r[0] in stay]
    yield kept
    # The mix itself has a test of its own; here its counts must take effect.
    frame = spark.createDataFrame(kept, docs.schema)
    copies = {r.doc_id: r.copies for r in mixing.mix(frame).collect()}
    kept = [r for r in kept for _ in range(copies[r[0]])]
    yield kept
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    yield [(r[0], library.encode(r[1] or "")) for r in kept]


def check(spark, docs):
    rows = [tuple(r) for r in docs.collect()]
    now = docs
    for (name, stage), wanted in zip(corpus_pipeline.STAGES, stages_by_hand(spark, docs, rows), strict=True):
        now = settle(stage(spark, now, SF), "test-stage")
        if name == "pieces":
            assert Counter((r.doc_id, tuple(r.ids)) for r in now.collect()) == Counter((i, tuple(x)) for i, x in wanted)
        else:
            assert now.columns == docs.columns
            assert Counter(r.doc_id for r in now.collect()) == Counter(r[0] for r in wanted), name
    return now


def test_pipeline_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    last = check(spark, docs)
    again = corpus_pipeline.run(spark, SF)
    assert again.exceptAll(last).isEmpty() and last.exceptAll(again).isEmpty()


def test_pipeline_on_nasty_rows(spark, nasty):
    check(spark, nasty)


def test_pipeline_on_nothing(spark, empty):
    now = empty
    for _, stage in corpus_pipeline.STAGES:
        now = settle(stage(spark, now, SF), "test-stage")
    assert now.count() == 0
