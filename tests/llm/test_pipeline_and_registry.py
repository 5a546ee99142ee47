"""Registered queries, their SQL, and the pipeline's stages on their own inputs."""

import re
import sys
from collections import defaultdict
from pathlib import Path

import pytest
from llm_cases import SF, make

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))

import corpus_pipeline  # noqa: E402

from dimwright.llm.queries import QUERIES, SQL  # noqa: E402


def test_one_query_per_operator():
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert set(QUERIES) | {"pipeline"} <= names
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))
    assert set(SQL) <= set(QUERIES) and set(SQL) <= set(__spark_entry__.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_queries_equal_their_sql(spark, name):
    from oracle_check import duck, rows_key

    got = QUERIES[name](spark, SF)
    told = duck(SF).execute(SQL[name])
    columns = [c[0] for c in told.description]
    assert sorted(got.columns) == sorted(columns)
    assert rows_key(got.columns, [tuple(r) for r in got.collect()]) == rows_key(columns, told.fetchall())


def test_results_have_one_row_per_document(spark):
    ids = sorted(r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect())
    for name in ("op1_sentencepiece_bpe", "op4_language_id", "op7_pii", "op8_feistel_sharding", "op9_minhash_dedup",
                 "op10_quality_rules", "op11_token_alignment", "op12_quality_classifier"):
        assert sorted(r.doc_id for r in QUERIES[name](spark, SF).select("doc_id").collect()) == ids


def test_pipeline_stages(spark, odd):
    """Each stage on its own input: columns stay, and its decision is the operator's."""
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "exact", "near", "private", "packed"]
    stages = dict(corpus_pipeline.STAGES)
    for docs in (odd, make(spark, [])):
        for name in ("language", "exact", "near", "private"):
            out = stages[name](spark, docs, SF)
            assert out.schema == docs.schema or out.columns == docs.columns
            out.count()
    kept = [r.text for r in stages["language"](spark, odd, SF).collect()]
    assert all(t and any(c.isalpha() for c in t) for t in kept) and "a" in kept
    assert stages["packed"](spark, make(spark, []), SF).count() == 0


def test_pipeline_against_brute_force(spark, corpus_rows):
    """Every text that reaches the packer: with letters, largest id of equal texts, smallest of each component."""
    from test_corpus_operators import brute_near

    largest = {}
    for doc_id, text, _ in corpus_rows:
        if text and any(c.isalpha() for c in text):
            largest[text] = max(doc_id, largest.get(text, doc_id))
    rows = [(i, t) for t, i in largest.items()]
    component = defaultdict(list)
    for line in brute_near(rows):
        doc_id, _, c, _ = eval(line)
        component[c].append(doc_id)
    want = {min(ids) for ids in component.values()}
    got = {r.doc_id for r in corpus_pipeline.run(spark, SF).select("doc_id").distinct().collect()}
    assert got == want
