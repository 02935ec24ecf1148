"""Every operator and stage on empty tables, nulls, clashing columns, repeats and a very long text; and the pipeline."""

import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sessionlens.llm import catalog, decontam, kneser_ney, line_dedup, mixing, near_dup, sharding, span_dedup, topk, toxicity, url_filter

from sessionlens.llm import pipeline as corpus_pipeline

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that operators use inside, as extra columns of the input.
CLASH = ("size", "t", "key", "bands", "shard", "slot", "p", "c0", "toxic", "copies", "rank", "word", "n", "label", "nid")

OPERATORS = {
    "sharding": lambda d, b, x: sharding.shard_documents(d),
    "near_dup": lambda d, b, x: near_dup.near_duplicates(d),
    "span_dedup": lambda d, b, x: span_dedup.dedup_spans(d),
    "mixing": lambda d, b, x: mixing.mix_documents(d),
    "mixed_rows": lambda d, b, x: mixing.mixed_rows(d),
    "kneser_ney": lambda d, b, x: kneser_ney.score_documents(d),
    "line_dedup": lambda d, b, x: line_dedup.dedup_lines(d),
    "decontam": lambda d, b, x: decontam.contamination(d, b),
    "toxicity": lambda d, b, x: toxicity.toxicity(d, x),
    "non_toxic": lambda d, b, x: toxicity.non_toxic(d, x),
}
ONE_ROW_EACH = set(OPERATORS) - {"mixed_rows", "non_toxic"}


@pytest.fixture(scope="module", autouse=True)
def package(spark):
    catalog.with_package(spark)


def tables(spark, rows):
    docs = spark.createDataFrame(rows, DOCS)
    for i, c in enumerate(CLASH):
        docs = docs.withColumn(c, F.lit(i))
    items = spark.createDataFrame([(1, "alpha beta gamma", "x")], "item_id long, text string, iid string")
    labels = spark.createDataFrame([(1, 1, 0, 5), (2, 1, 1, 5)], "doc_id long, quality int, toxic int, text int")
    return docs, items, labels


def rows_of(n_long):
    text = "Alpha beta gamma, delta epsilon.\n" * 3
    out = [(1, text, "en", "a", 9), (1, text, "en", "a", 9), (2, text + " x", None, None, None), (None, None, None, None, None), (None, None, None, None, None), (3, "", "en", "b", 0), (4, "   \n\t", "en", "b", 5), (5, "é" * 300, "fr", "b", 3)]
    return out + ([(6, "word " * n_long + "w" * n_long, "en", "a", n_long)] if n_long else [])


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_edges(spark, name):
    docs, items, labels = tables(spark, rows_of(60_000))
    got = OPERATORS[name](docs, items, labels)
    n = got.count()
    if name in ONE_ROW_EACH:
        assert n == docs.count()
        assert Counter(r.doc_id for r in got.select("doc_id").collect()) == Counter(r.doc_id for r in docs.select("doc_id").collect())
    else:
        assert got.columns == docs.columns


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty(spark, name):
    docs, items, labels = tables(spark, [])
    assert OPERATORS[name](docs, items.limit(0), labels.limit(0)).count() == 0


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_all_null(spark, name):
    docs, items, labels = tables(spark, [(None,) * 5] * 3)
    n = OPERATORS[name](docs, items, labels).count()
    assert n == 3 if name in ONE_ROW_EACH else n <= 6


def test_empty_pages_and_vectors(spark):
    assert url_filter.filter_urls(spark.createDataFrame([], "page_id long, url string, html string, words string")).count() == 0
    assert topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>, v int")).count() == 0
    assert topk.top_k(spark.createDataFrame([(100, [1.0, 2.0])], "vec_id long, embedding array<float>")).count() == 0


def test_stages_keep_columns(spark):
    docs, _, _ = tables(spark, rows_of(0))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.count() <= 2 * docs.count()
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, docs.limit(0), SF).count()


def test_the_script_has_the_stages():
    import corpus_pipeline as script

    assert script.STAGES is corpus_pipeline.STAGES and script.run is corpus_pipeline.run and script.ORACLE_SQL is None


def test_scratch_tables_go(spark):
    """What an operator wrote on its way is gone; what its result reads is not."""
    from pathlib import Path

    from sessionlens.llm.common import disposable, local_path, shared_dir, written

    folder = Path(local_path(shared_dir(spark)))
    with disposable(spark) as keep:
        a, b = written(spark.range(3), "one"), written(spark.range(4), "two")
        keep(b)
    assert b.count() == 4 and Path(local_path(b.scratch_path)).exists() and not Path(local_path(a.scratch_path)).exists()
    before = set(folder.iterdir())
    near_dup.near_duplicates(spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f")], "doc_id long, text string")).count()
    assert len(set(folder.iterdir()) - before) == 2


def test_pipeline_decisions(spark):
    """run() against the stages' rules, told from the operators' own brute-force tests."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels, items = spark.read.parquet(f"{SF}/labels.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    judged = {r.doc_id: r.toxic for r in toxicity.toxicity(docs, labels).collect()}
    kept = corpus_pipeline.toxicity(spark, docs, SF)
    assert {r.doc_id for r in kept.collect()} == {i for i, x in judged.items() if not x}
    from test_operators import classes

    groups = classes([(r.doc_id, r.text) for r in kept.collect()])
    once = corpus_pipeline.near_duplicates(spark, kept, SF)
    ids = [r.doc_id for r in once.collect()]
    assert sorted(groups[i] for i in ids) == sorted(set(groups.values()))
    clean = corpus_pipeline.decontamination(spark, once, SF)
    bad = {r.doc_id for r in decontam.contamination(once, items).where("contaminated").collect()}
    assert {r.doc_id for r in clean.collect()} == set(ids) - bad
    mixed = corpus_pipeline.mix(spark, clean, SF)
    taken = {r.doc_id: r.taken for r in mixing.mix_documents(clean).collect()}
    words = {r.doc_id: r.size for r in mixing.mix_documents(clean).collect()}
    n = Counter(r.doc_id for r in mixed.collect())
    assert all(n[i] * words[i] == taken[i] for i in taken)
    final = corpus_pipeline.run(spark, SF).collect()
    assert Counter(r.doc_id for r in final) == n
    crc = {r.doc_id: zlib.crc32(r.text.encode()) for r in docs.collect()}
    assert all(r.text_crc32 == crc[r.doc_id] for r in final)
    loads = Counter(r.shard for r in final)
    assert max(loads.values()) - min(loads[s] for s in range(16)) <= 1
