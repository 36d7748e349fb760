import random
import zlib

import pytest
from pyspark.sql import functions as F

from loadstar.llm import toxicity as K
from tests.llm.conftest import prose

BAD = ["vilething", "grolmworm", "snarkfool"]


def rows():
    rng = random.Random(21)
    out = []
    for i in range(600):
        toxic = int(rng.random() < 0.2)
        w = prose(rng, rng.randint(30, 120)).split(" ")
        for _ in range(rng.randint(2, 5) if toxic else 0):
            w.insert(rng.randrange(len(w)), rng.choice(BAD))
        out.append((i, " ".join(w), toxic))
    return out


@pytest.fixture(scope="module")
def frames(spark):
    docs = [(i, t, "x", 1) for i, t, _ in rows()] + [(900, None, "x", 1), (901, "", "x", 1), (902, "long " * 50_000, "x", 1), (None, "a", "x", 1), (3, rows()[3][1], "x", 1)]
    labels = [(i, 1, y) for i, _, y in rows()] + [(None, 1, 1), (5, 1, None)]
    return spark.createDataFrame(docs, "doc_id long, text string, toxic string, score int"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_documents_are_told_apart(frames):
    docs, labels = frames
    scores = {r.doc_id: r.score for r in K.toxicity_scores(docs, K.fit(docs, labels)).collect()}
    assert len(scores) == 604 and all(0 <= s <= 1 for s in scores.values())
    held = [(scores[i] >= 0.5, y) for i, _, y in rows() if zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(held) > 80
    assert sum(p == y for p, y in held) / len(held) > 0.95
    assert scores[900] == scores[901] < 0.5


def test_labels_of_the_held_out_fold_are_not_used(frames, spark):
    docs, labels = frames
    other = labels.withColumn("toxic", F.when(K.fold(F.col("doc_id")) == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert K.fit(docs, labels) == K.fit(docs, other)


def test_without_both_classes(frames):
    docs, labels = frames
    for some in (labels.limit(0), labels.where("toxic = 0")):
        scores = {r.score for r in K.toxicity_scores(docs, K.fit(docs, some)).collect()}
        assert len(scores) == 1 and 0 < scores.pop() < 0.5


def test_windows_cover_the_whole_text():
    packers = K._packer(b"base"), K._packer(b"base " + b"vilething ")
    text = b"a" * 10_000 + b" vilething"
    assert K.gains(text, *packers)[-1] > 0
    assert len(K.gains(b"", *packers)) == 1


def test_weak_and_noisy_terms_of_any_part_are_kept():
    rng = random.Random(22)
    rare = [f"rareslur{c}" for c in "bdfgk"]
    head = "the same forty characters begin every text here: "
    toxic = [head + prose(rng, 30) + (" vilething" if i % 10 else "") + f" {rare[i // 20 % 5] if i % 20 < 6 else 'x'}" for i in range(400)]
    ordinary = [head + prose(rng, 30) + (" vilething" if i % 12 == 0 else "") for i in range(400)]
    content, terms = K.dictionaries(toxic, ordinary)
    assert {b"vilething", *(r.encode() for r in rare)} <= set(terms[len(content) :].split())


def test_the_sample_sees_whole_texts(spark):
    text = "start " + "a" * 9000 + " middle " + "b" * 9000 + " end"
    got = spark.createDataFrame([(text,), ("short",), ("",)], "text string").select(K._spread(F.col("text")).alias("t")).collect()
    assert [r.t for r in got[1:]] == ["short", ""]
    assert got[0].t.startswith("start") and got[0].t.endswith(" end") and "a" in got[0].t and "bb" in got[0].t
    assert len(got[0].t) <= K.SAMPLE_CHARS + K.SPREAD


def test_empty_table(frames):
    docs, labels = frames
    assert K.toxicity_scores(docs.limit(0), K.fit(docs.limit(0), labels)).count() == 0
