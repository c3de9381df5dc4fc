"""The corpus pipeline on the smallest tables: each stage's decisions against plain versions."""

from collections import Counter
from pathlib import Path

import pytest

import corpus_pipeline
from fiscora.llm.line_dedup import MIN_WORDS

from . import plain

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).is_dir(), reason="test tables are not here")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Every stage's input and output, written and read again."""
    folder, docs, out = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{DATA}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        stage(spark, docs, DATA).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        out[name] = (before, docs)
    return out


def rows(frame):
    return [(r["doc_id"], r["text"]) for r in frame.collect()]


def test_all_but_the_last_keep_the_columns(stages):
    names = [n for n, _ in corpus_pipeline.STAGES]
    for name in names[:-1]:
        before, after = stages[name]
        assert after.columns == before.columns and [f.dataType for f in after.schema] == [f.dataType for f in before.schema]


def test_toxic_documents_go(spark, stages):
    before, after = stages["toxicity"]
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    left = Counter(rows(after))
    assert not left - Counter(rows(before))
    kept = {i for i, _ in left}
    clean = [i for i, y in labels.items() if y == 0]
    assert sum(i in kept for i in clean) >= 0.95 * len(clean)


def test_repeated_lines_go(stages):
    before, after = stages["line_dedup"]
    expected = [(i, kept) for i, _, n, _, kept in plain.line_rows(sorted(rows(before)), MIN_WORDS) if n == 0 or kept.strip()]
    assert Counter(rows(after)) == Counter(expected)
    assert all(r["n_chars"] == len(r["text"]) for r in after.collect())


def test_no_later_copy_of_a_line_stays(spark):
    rows = [(1, "MIT License\n\nfirst text of its own"), (2, "}\n\nMIT License"), (3, "second text\nMIT License\n}\n\nend"), (4, "}")]
    docs = spark.createDataFrame([(i, t, *plain.FILL) for i, t in rows], plain.DOCUMENTS)
    after = corpus_pipeline.dedup_lines(spark, docs, DATA)
    assert {r["doc_id"]: r["text"] for r in after.collect()} == {1: rows[0][1], 2: "}\n", 3: "second text\nend"}


def test_one_of_each_class_stays(stages):
    before, after = stages["near_dedup"]
    texts = rows(before)
    kept = [row for row, c in zip(texts, plain.near_classes(texts, 5, 80), strict=True) if c[3] or not c[1]]
    assert Counter(rows(after)) == Counter(kept)


def test_benchmark_passages_go(spark, stages):
    before, after = stages["decontamination"]
    grams = {g for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect() for g in plain.shingle_set(r["text"], 8)}
    expected = [(i, t) for i, t in rows(before) if len(plain.shingle_set(t, 8) & grams) < 3]
    assert Counter(rows(after)) == Counter(expected)


def test_everything_is_packed(stages):
    before, after = stages["packing"]
    total = Counter()
    for r in after.collect():
        total[r["doc_id"]] += r["n_tokens"]
    assert total == Counter({i: len(plain.words(t)) for i, t in rows(before)})


def test_run_gives_the_last_stage(spark, stages):
    found = corpus_pipeline.run(spark, DATA)
    assert found.columns == stages["packing"][1].columns and found.count() == stages["packing"][1].count()


def test_empty_documents_pass_through(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, DATA)
    assert docs.count() == 0


def test_odd_rows_pass_through(spark):
    """Nulls, blank and very long texts, repeated rows, and columns named like internal ones."""
    docs = spark.createDataFrame(plain.odd_rows(), plain.DOCUMENTS)
    ids = Counter(r["doc_id"] for r in docs.collect())
    expected = {
        "toxicity": ids,
        # later copies of whole texts are gone, blank texts are not
        "line_dedup": ids - Counter([2, 2, None, 11, 11]),
        "near_dedup": Counter([1, 3, 4, 5, 6, 7, 9, 10, 12, 14, 16, 17, None]),
        "decontamination": Counter([1, 3, 4, 5, 6, 7, 9, 10, 12, 14, 16, 17, None]),
    }
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, DATA)
        assert after.columns == docs.columns
        assert Counter(r["doc_id"] for r in after.collect()) == expected[name], name
        docs = after
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, DATA)
    assert {r["doc_id"] for r in packed.collect()} == set(expected["decontamination"])
