"""The registered queries on the small tables: SQL, contracts and the pipeline."""

import os

import pytest

import __spark_entry__ as ent
import corpus_pipeline
from duetto.llm import language, neardup, packing, secrets, toxicity
from duetto.llm.common import table
from llm import brute
from oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables missing")
NAMES = [n for n in ent.queries() if n.startswith("op")]


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in NAMES) == list(range(1, 14))
    assert "pipeline" in ent.queries()


@pytest.mark.parametrize("name", sorted(n for n in ent.oracle_sql() if n.startswith("op")))
def test_query_matches_sql(spark, con, name):
    ok, msg = compare(spark, con, SF, name, ent.queries()[name], ent.oracle_sql()[name])
    assert ok, msg


COLUMNS = {
    "op1": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op2": {"doc_id": "bigint", "n_assign": "bigint", "n_access": "bigint", "n_hex": "bigint",
            "base_sha256": "string", "spans": "string"},
    "op3": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op4": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op5": {"page_id": "bigint", "host": "string", "path": "string", "rule": "string", "verdict": "string"},
    "op6": {"doc_id": "bigint"},
    "op7": {"doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint",
            "n_dup_lines": "bigint", "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean"},
    "op8": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"},
    "op9": {"doc_id": "bigint", "n_words": "bigint", "n_base": "bigint", "first_word": "bigint",
            "last_word": "bigint", "base_labels": "string", "labels": "string", "score": "double"},
    "op10": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op11": {"conv_id": "bigint", "depth": "bigint", "parent_conv_id": "bigint", "n_convs": "bigint",
             "n_children": "bigint", "n_leaves": "bigint", "saved_tokens": "bigint", "ends_sha256": "string"},
    "op12": {"vec_id": "bigint", "cluster": "int", "distance": "bigint", "cluster_inertia": "bigint",
             "inertia": "bigint", "centroid_sha256": "string"},
    "op13": {"doc_id": "bigint", "n_words": "bigint", "n_hit": "bigint", "n_items": "bigint",
             "items_sha256": "string", "contaminated": "boolean"},
}


@pytest.mark.parametrize("name", NAMES)
def test_columns_of_the_contract(spark, name):
    got = dict(ent.queries()[name](spark, SF).dtypes)
    want = COLUMNS[name.split("_")[0]]
    assert {c: got.get(c) for c in want} == want


def test_stages_on_the_documents(spark):
    docs = table(spark, SF, "documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "language", "near_dedup", "secrets", "packing"]
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    # Toxicity and language: the rows whose verdict says so.
    bad = {r["doc_id"] for r in toxicity.judge_toxicity(docs, table(spark, SF, "labels")).collect()
           if r["predicted"]}
    one = corpus_pipeline.civil(spark, docs, SF)
    assert one.columns == docs.columns
    kept = {r["doc_id"] for r in one.collect()}
    assert kept == set(texts) - bad
    one = one.checkpoint()
    two = corpus_pipeline.identified(spark, one, SF).checkpoint()
    judged = {r["doc_id"]: r for r in language.identify(one).collect()}
    kept = {r["doc_id"] for r in two.collect()}
    assert kept == {i for i, r in judged.items() if r["lang_pred"] != "und" and r["score"] >= language.least_score(4)}
    # Near-duplicates: the smallest of each component, by comparing all pairs.
    three = corpus_pipeline.deduplicated(spark, two, SF).checkpoint()
    comp = brute.near_components([(i, texts[i]) for i in sorted(kept)], corpus_pipeline.NEAR_PERCENT)
    kept = {r["doc_id"] for r in three.collect()}
    assert kept == {i for i in comp if comp[i] == i}
    # Secrets: all rows stay, no base span is left.
    four = corpus_pipeline.redacted(spark, three, SF).checkpoint()
    out = {r["doc_id"]: r["text"] for r in four.collect()}
    assert set(out) == kept
    for i, t in out.items():
        assert (t == texts[i]) == (not secrets_in(spark, three, i))
        assert not brute.secret_spans(t)
    # Packing: every word of what is left, once.
    five = corpus_pipeline.packed(spark, four, SF).collect()
    assert sum(r["length"] for r in five) == sum(len(brute.words(t)) for t in out.values())
    assert {r["doc_id"] for r in five} == kept
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, SF).collect()} == kept


_SPANS: dict = {}


def secrets_in(spark, docs, doc_id):
    if not _SPANS:
        _SPANS.update({r["doc_id"]: r["spans"] for r in secrets.scan_secrets(docs).collect()})
    return _SPANS[doc_id]


def test_stages_of_empty_tables(spark):
    docs = table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0
    assert neardup.near_duplicates(docs).count() == 0 and packing.pack_documents(docs).count() == 0
