"""Identifiers that no double holds, in one batch with a missing one, and columns whose
names clash with those of results and steps."""

import pytest

import corpus_pipeline
from corpusloom.llm import (
    class_ngrams,
    exact_dedup,
    jaccard_join,
    line_templates,
    packing,
    quality,
    secret_scan,
    suffix_dedup,
    token_files,
    tree_bpe,
)

LARGE = 2**60
PROSE = " ".join(f"word{i}" for i in range(60))
ROWS = [
    (LARGE + 1, PROSE),
    (LARGE + 3, PROSE + " more"),
    (LARGE + 5, PROSE),
    (None, PROSE),
    (LARGE + 7, "x " * 12_000),
    (-LARGE - 1, "password = abcdefghijklmnop"),
]
CLASHES = ["spans", "base", "row", "kept", "n", "found", "document", "component_id", "kept_id", "key", "c"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "s", len(t), *CLASHES) for i, t in ROWS]
    columns = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, "
    schema = columns + ", ".join(f"{c} STRING" for c in CLASHES)
    return spark.createDataFrame(rows, schema).coalesce(1)


@pytest.fixture(scope="module")
def labels_folder(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("labels"))
    rows = [(LARGE + 1, 1, 0), (None, 1, 0)]
    schema = "doc_id BIGINT, quality INT, toxic INT"
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/labels.parquet")
    return folder


def _ids(frame):
    return sorted((r["doc_id"] for r in frame.select("doc_id").collect()), key=str)


OPERATORS = {
    "class_ngrams": class_ngrams.class_bigram_scores,
    "secret_scan": secret_scan.find_secrets,
    "tree_bpe": tree_bpe.encode_documents,
    "token_files": lambda docs: token_files.token_files(docs).documents(),
    "exact_dedup": exact_dedup.exact_duplicates,
    "suffix_dedup": suffix_dedup.suffix_dedup,
    "line_templates": line_templates.line_dedup,
    "jaccard_join": jaccard_join.near_duplicates,
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_identifiers_are_exact(docs, name):
    assert _ids(OPERATORS[name](docs)) == sorted((i for i, _ in ROWS), key=str)


def test_identifiers_of_pieces(docs):
    assert set(_ids(packing.pack(docs).places())) == {i for i, _ in ROWS}


def test_identifiers_of_verdicts(spark, docs, labels_folder):
    labels = spark.read.parquet(f"{labels_folder}/labels.parquet")
    assert _ids(quality.quality_verdicts(docs, labels)) == sorted((i for i, _ in ROWS), key=str)


def test_components_have_exact_identifiers(docs):
    found = {r["doc_id"]: r["component_id"] for r in jaccard_join.near_duplicates(docs).collect()}
    assert found[LARGE + 3] == found[LARGE + 5] == found[LARGE + 1] == LARGE + 1
    assert found[None] is None


def test_stages_keep_columns_that_clash(spark, docs, labels_folder):
    stages = dict(corpus_pipeline.STAGES)
    kept = {
        "quality_rules": {LARGE + 1, LARGE + 3, LARGE + 5, None},
        "exact_dedup": {LARGE + 3, LARGE + 5, LARGE + 7, -LARGE - 1},
        "jaccard_join": {LARGE + 1, LARGE + 7, -LARGE - 1, None},
        "secret_scan": {i for i, _ in ROWS},
    }
    for name, wanted in kept.items():
        found = stages[name](spark, docs, labels_folder)
        assert found.columns == docs.columns
        rows = found.collect()
        assert {r["doc_id"] for r in rows} == wanted, name
        assert all([r[c] for c in CLASHES] == CLASHES for r in rows)
    text = {r["doc_id"]: r["text"] for r in rows}
    assert text[-LARGE - 1] == "[secret]"
    assert set(_ids(stages["packing"](spark, docs, labels_folder))) == {i for i, _ in ROWS}
