"""The pipeline, stage by stage, against brute force on small documents."""

import re

import pytest

from ledgerflow.llm import neardup, packing, pii, quality
from test_simhash import components_of

corpus_pipeline = pytest.importorskip("corpus_pipeline")


@pytest.fixture(scope="module")
def kept(spark, given, tmp_path_factory):
    """What each stage made of the documents."""
    folder, docs, result = tmp_path_factory.mktemp("pipeline"), given, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, "").write.parquet(f"{folder}/{name}")
        docs = result[name] = spark.read.parquet(f"{folder}/{name}")
    return result


def test_columns_pass_through(kept, given):
    assert list(kept) == ["quality_rules", "near_dedup", "personal_data", "mix_sources", "packing"]
    for name, docs in list(kept.items())[:-1]:
        assert docs.dtypes == given.dtypes, name


def test_quality(kept, given):
    def good(text):
        measures = quality.measure(text)
        return not quality.base_failed(measures[0], measures[4]) and not any(rule(text) for rule in quality.RULES.values())

    expected = sorted(r.doc_id for r in given.collect() if good(r.text or ""))
    assert sorted(r.doc_id for r in kept["quality_rules"].collect()) == expected


def test_one_of_each_group(kept):
    rows = sorted(kept["quality_rules"].collect(), key=lambda r: r.doc_id)
    groups = components_of([neardup.fingerprint(r.text) for r in rows], 4)
    expected = sorted({rows[g].doc_id for g in groups})
    assert sorted(r.doc_id for r in kept["near_dedup"].collect()) == expected


def test_personal_data_is_masked(kept):
    before = {r.doc_id: r.text for r in kept["near_dedup"].collect()}
    after = {r.doc_id: r for r in kept["personal_data"].collect()}
    assert after.keys() == before.keys()
    found = 0
    for name, row in after.items():
        spans = pii.base_spans(before[name])
        found += len(spans)
        assert all(before[name][a:b] not in row.text for a, _, b in spans)
        assert row.n_chars == len(row.text)
        if not re.search(r"[0-9@]", before[name]):
            assert row.text == before[name]
    assert found > 3


def test_packing_holds_every_token_of_the_mix(kept):
    pieces, mixed = kept["packing"].collect(), kept["mix_sources"].collect()
    encode = packing.encoder(packing.public_vocabulary()).tokenizer.encode
    tokens = sum(len(encode(r.text, add_special_tokens=False).ids) + 1 for r in mixed)
    assert sum(p.length for p in pieces) == tokens
    assert {p.doc_id for p in pieces} == {r.doc_id for r in mixed}


def test_run_gives_the_same(spark, kept, tmp_path, given):
    given.drop("found").write.parquet(f"{tmp_path}/documents.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(p.ids_crc32 for p in found.collect()) == sorted(p.ids_crc32 for p in kept["packing"].collect())


def test_empty_table(spark, given):
    docs = given.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
    assert docs.count() == 0
