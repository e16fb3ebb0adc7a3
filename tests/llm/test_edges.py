"""Every operator and pipeline stage over odd rows, no rows, and columns whose names clash with its own."""

import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.conftest import NASTY
from threadloom.llm import (
    decontamination,
    html_text,
    lattice_lm,
    near_duplicates,
    packing,
    quality_classifier,
    quality_rules,
    token_counts,
    token_store,
    toxicity,
)

CLASHING = ["rules", "found", "toxicity", "counts", "size", "label", "rank", "row", "word", "print", "rep", "node", "quality_score"]


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame(
        [(1, None), (2, ""), (3, "a line a line a line"), (3, "a line a line a line"), (None, "without"), (4, "zz " * 30)],
        "item_id BIGINT, text STRING",
    )


@pytest.fixture(scope="module")
def labels(labels_of):
    return labels_of([(k, k % 2, (k + 1) % 2) for k in range(11)] + [(4, None, None), (None, 1, 1), (99, 1, 1)])


def reports(docs, labels, benchmark):
    return {
        "op1": token_counts.report(docs),
        "op3": quality_classifier.report(docs, labels),
        "op4": quality_rules.report(docs),
        "op5": token_store.report(docs),
        "op6": decontamination.report(docs, benchmark),
        "op7": toxicity.report(docs, labels),
        "op8": lattice_lm.report(docs),
        "op9": near_duplicates.report(docs),
    }


def test_odd_rows_keep_their_places(nasty, labels, benchmark):
    clashing = nasty.withColumns({name: F.lit("x") for name in CLASHING})
    for name, result in reports(clashing, labels, benchmark).items():
        rows = result.collect()
        assert sorted(str(row.doc_id) for row in rows) == sorted(str(number) for number, _ in NASTY), name
        by_id = {}
        for row in rows:  # repeated rows have equal results, but for their places in a store
            values = {key: value for key, value in row.asDict().items() if key != "start"}
            assert by_id.setdefault(row.doc_id, values) == values, name
    packed = packing.pack(clashing).collect()
    assert sum(row.length for row in packed) == sum(
        row.doc_tokens for row in packed if row.start == 0
    )
    assert {row.doc_id for row in packed} == {number for number, _ in NASTY}


def test_defined_results_of_empty_texts(nasty, labels, benchmark):
    found = {name: {row.doc_id: row for row in result.collect()} for name, result in reports(nasty, labels, benchmark).items()}
    for k in (0, 1, 2):
        assert (found["op1"][k].n_words, found["op1"][k].n_tokens) == (0, 0)
        assert (found["op4"][k].n_words, found["op4"][k].base_failed, found["op4"][k].kept) == (0, True, False)
        assert (found["op5"][k].n_tokens, found["op5"][k].ids_crc32) == (1, zlib.crc32(b"\x02\0\0\0"))
        assert (found["op6"][k].n_words, found["op6"][k].contaminated) == (0, False)
        assert found["op8"][k].n_tokens == 1
        assert (found["op9"][k].n_shingles, found["op9"][k].component_id, found["op9"][k].kept) == (0, k, True)
    assert found["op9"][5].component_id == 4 and not found["op9"][5].kept
    assert found["op9"][None].kept
    for name in ("op3", "op7"):
        assert found[name][0].score == found[name][1].score == found[name][2].score
        assert all(0 <= row.score <= 1 for row in found[name].values())


def test_no_rows(no_docs, labels, benchmark):
    for name, result in reports(no_docs, labels, benchmark).items():
        assert result.count() == 0, name
    assert packing.pack(no_docs).count() == 0


def test_nothing_to_learn_or_search(nasty, labels, benchmark):
    assert {row.score for row in quality_classifier.report(nasty, labels.limit(0)).collect()} == {0.5}
    assert {row.score for row in toxicity.report(nasty, labels.limit(0)).collect()} == {0.0}
    assert {row.n_hit for row in decontamination.report(nasty, benchmark.limit(0)).collect()} == {0}
    held_out = lattice_lm.scored(nasty, F.lit(True)).collect()
    assert {row.train_tokens for row in held_out} == {0} and {row.n_known for row in held_out} == {0}


def test_pages(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<p>"), (4, "u", "plain text"), (4, "u", "plain text"),
            (None, "u", "<div>a &amp; b</div>"), (5, "u", "<p>" + "long word " * 20_000)]
    pages = spark.createDataFrame(rows, "page_id BIGINT, url STRING, html STRING")
    found = html_text.report(pages.withColumn("text", F.lit("x"))).collect()
    assert sorted((str(row.page_id), row.text[:10], row.n_chars) for row in found) == [
        ("1", "", 0), ("2", "", 0), ("3", "", 0), ("4", "plain text", 10), ("4", "plain text", 10),
        ("5", "long word ", 199_999), ("None", "a & b", 5)]
    assert html_text.report(pages.limit(0)).count() == 0


@pytest.mark.parametrize("empty", [False, True])
def test_stages_keep_columns_and_survive(spark, nasty, labels, benchmark, empty, tmp_path):
    docs = (nasty.limit(0) if empty else nasty).withColumns({name: F.lit("x") for name in CLASHING})
    nasty.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, str(tmp_path))
        if name == "packing":
            assert (result.count() == 0) == empty
        else:
            assert result.columns == docs.columns, name
            assert result.count() <= docs.count()
