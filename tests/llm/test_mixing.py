from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from loadstar.llm import mixing as M
from loadstar.llm.common import word_count
from tests.llm import brute


@pytest.mark.parametrize("bucket_rows", [1, 3, 1000])
def test_targets_and_cuts(docs, rows, bucket_rows):
    size, sources = defaultdict(int), sorted({s for *_, s in rows if s}) + [None]
    for _, t, s in rows:
        size[s] += len(brute.words(t))
    target = dict(zip(sources, brute.targets([size[s] for s in sources]), strict=True))
    got = M.mix_sources(docs, bucket_rows=bucket_rows).collect()
    assert len(got) == len(rows)
    taken = defaultdict(int)
    for r in got:
        assert r.source_size == size[r.source]
        assert r.target == pytest.approx(target[r.source])
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    for s in sources:
        assert abs(taken[s] - target[s]) <= 1


def test_cut_does_not_depend_on_buckets_or_partitions(docs):
    def mix(df, n):
        return sorted((str(r.doc_id), r.size, r.taken) for r in M.mix_sources(df, bucket_rows=n).collect())

    assert mix(docs, 2) == mix(docs.repartition(7), 500)


def test_documents_hold_what_the_mix_takes(docs):
    mixed = M.mixed_documents(docs)
    assert mixed.columns == docs.columns
    got = {r.source: r.n for r in mixed.groupBy("source").agg(F.sum(word_count(F.col("text"))).alias("n")).collect()}
    want = {r.source: r.n for r in M.mix_sources(docs).groupBy("source").agg(F.sum("taken").alias("n")).collect() if r.n}
    assert got == want


def test_only_empty_texts(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert {(r.doc_id, r.target, r.taken) for r in M.mix_sources(df).collect()} == {(1, 0.0, 0), (2, 0.0, 0)}
    assert M.mixed_documents(df).count() == 0


def test_empty_table(no_docs):
    assert M.mix_sources(no_docs).count() == 0


def test_no_python_in_the_plan(docs):
    plan = M.mix_sources(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
