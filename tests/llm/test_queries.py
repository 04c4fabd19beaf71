"""The registered queries and the pipeline on the smallest driver tables."""

import hashlib
from collections import Counter

import corpus_pipeline
import pytest
from brightlake.llm import queries
from tests.llm.helpers import SF, words
from tests.llm.test_corpus_ops import brute_components
from tests.llm.test_text_ops import counts

COLUMNS = {
    "op1_toxicity": "doc_id held_out score predicted",
    "op2_minhash_neardup": "doc_id n_shingles component_id kept",
    "op3_license_scan": "doc_id license first_word n_shared n_template containment",
    "op4_lm_scoring": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op5_sharding": "doc_id size text_crc32 law shard slot grown_shard",
    "op6_html_extraction": "page_id url text n_chars",
    "op7_fingerprints": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op8_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op9_bpe_encoding": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op10_source_mixing": "doc_id size source_size target taken"}


@pytest.mark.parametrize("name", COLUMNS)
def test_query_returns_its_columns_for_every_row(spark, name):
    df = queries.QUERIES[name](spark, SF)
    assert set(COLUMNS[name].split()) <= set(df.columns)
    rows = df.count()
    if name == "op6_html_extraction":
        assert rows == spark.read.parquet(f"{SF}/pages.parquet").count()
    elif name != "op3_license_scan":
        assert rows == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_pipeline_stages_take_effect(spark, scratch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = [tuple(r) for r in docs.collect()]
        out = stage(spark, docs, SF)
        path = f"{scratch}/{name}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        after = docs.collect()
        ids, kept = [r[0] for r in before], Counter(r[0] for r in after)
        if name == "quality":
            failed = {r[0] for r in before if (n := counts(r[1]))[0] < 50 or 2 * n[4] > n[0]}
            assert not failed & set(kept) and set(kept) <= set(ids)
        elif name == "toxicity":
            assert set(kept) <= set(ids) and len(kept) > 0.6 * len(ids)
        elif name == "near_dedup":
            expect = brute_components([(r[0], r[1]) for r in before], 5)
            assert set(kept) == {k for k, c in expect.items() if k == c}
        elif name == "mixing":
            size = {r[0]: len(words(r[1])) for r in before}
            assert set(kept) <= set(ids) and max(kept.values()) <= 3
            assert abs(sum(size[k] * n for k, n in kept.items()) - sum(size.values())) \
                < 0.05 * sum(size.values())
        if name != "encoding":
            assert docs.columns == columns
        else:
            assert Counter(r.doc_id for r in after) == Counter(ids)
            text = {r[0]: r[1] for r in before}
            assert all(r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()
                       for r in after)
