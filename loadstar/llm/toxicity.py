"""Toxicity by compression distance between two zstandard dictionaries.

One dictionary holds ordinary text, the other the same text followed by the terms that
set toxic training texts apart. A window that compresses shorter with the second holds
such terms. A text is cut into overlapping windows, whole to its end; the gains of its
windows are summed up in a few numbers, and a calibrated logistic threshold turns them
into a score between 0 and 1.

Learning uses a bounded sample of labelled rows outside the held-out fold, about
``SAMPLE`` of each class picked by a hash of their ids (never over twice that), and
``SAMPLE_CHARS`` characters of each, spread over the whole text.
One half of the sample gives the dictionaries, the other half the calibration. Scoring
reads every text in full.

Defined results: a null or empty text has one empty window. Without labels of both
classes every score is the smoothed share of toxic labels. Repeated labels count once
for each row. Repeated documents are scored one by one. Other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadstar.llm.common import batch, table

SAMPLE, SAMPLE_CHARS = 4000, 3000
SPREAD = 6  # passages of a longer text
BASE_BYTES = 32 << 10
MORE, LEAST_Z = 3, 4  # shares in toxic over ordinary texts, and their z value
WINDOW, STEP = 64, 40
LEVEL = 3
FOLDS = 5
_STRIP = ".,!?;:\"'()[]"


@dataclass(frozen=True)
class Model:
    """Two dictionary contents and the calibration of the window gains."""

    ordinary: bytes
    toxic: bytes
    center: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]
    bias: float


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def _packer(content: bytes) -> zstandard.ZstdCompressor:
    options = dict(level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False)
    if content:
        options["dict_data"] = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        options["dict_data"].precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(**options)


def gains(text: bytes, ordinary: zstandard.ZstdCompressor, toxic: zstandard.ZstdCompressor) -> np.ndarray:
    """Bytes that the toxic dictionary saves over the ordinary one, window by window."""
    short, long = toxic.compress, ordinary.compress
    windows = [text[i : i + WINDOW] for i in range(0, max(1, len(text) - WINDOW + STEP), STEP)]
    return np.array([len(long(w)) - len(short(w)) for w in windows])


def features(gain: np.ndarray) -> tuple[float, ...]:
    over = np.maximum(gain - 1, 0)
    n = len(gain)
    return (float(gain.max()), float(np.log1p(over.sum())), float(over.sum() / n), float((gain >= 3).sum() / np.sqrt(n)), float(np.log(n)))


def _terms(texts: list[str]) -> Counter:
    """In how many texts each word occurs, and each beginning of a longer word."""
    found: Counter = Counter()
    for t in texts:
        whole = {w.strip(_STRIP) for w in t.lower().split()}
        found.update(whole | {w[:n] for w in whole for n in range(4, min(len(w), 8))})
    found.pop("", None)
    return found


def _distinct(texts: list[str]) -> list[str]:
    """Each text once: copies would make their rare words look telling."""
    return list(dict.fromkeys(texts))


def dictionaries(toxic: list[str], ordinary: list[str]) -> tuple[bytes, bytes]:
    """Contents of the ordinary and the toxic dictionary.

    A term belongs to toxic text if it is in more toxic than ordinary texts, both in
    proportion and beyond chance (the z value of two shares), however weak beside other
    terms. The strongest are last, where zstandard reaches them at the least cost.
    Whole passages of toxic texts are not added: their ordinary words hide the gain of
    the terms.
    """
    toxic, ordinary = _distinct(toxic), _distinct(ordinary)
    base, room = [], BASE_BYTES
    for t in ordinary:
        if room <= 0:
            break
        part = t.encode()[: min(400, room)]
        base.append(part)
        room -= len(part) + 1
    content = b" ".join(base)
    if not toxic or not ordinary:
        return content, content
    a, b, na, nb = _terms(toxic), _terms(ordinary), len(toxic), len(ordinary)
    z = {}
    for w, n in a.items():
        p, q = n / na, b[w] / nb
        if n >= 2 and p > MORE * (b[w] + 0.5) / nb:
            both = (n + b[w]) / (na + nb)
            z[w] = (p - q) / np.sqrt(both * (1 - both) * (1 / na + 1 / nb) + 1e-12)
    strong = {w for w, v in z.items() if v >= LEAST_Z}
    # A beginning that is nearly always continued in one way adds nothing to the longer term.
    spare = {w[:n] for w in strong for n in range(4, len(w)) if a[w] >= 0.8 * a[w[:n]]}
    terms = [w for _, w in sorted((z[w], w) for w in strong - spare)]
    forms = [f for w in terms for f in (w, w.capitalize())]
    return content, content + b" " + " ".join(forms).encode() + b" "


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights of a ridge logistic regression by Newton's steps."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    ridge = np.full(len(w), 1e-2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + ridge * w
        hess = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


def _spread(text: Column) -> Column:
    """The text, or if longer than ``SAMPLE_CHARS`` passages from its beginning to its end."""
    size, n = SAMPLE_CHARS // SPREAD, F.length(text)
    parts = [F.substring(text, (1 + F.floor((n - size) * k / (SPREAD - 1))).cast("int"), F.lit(size)) for k in range(SPREAD)]
    return F.when(n <= SAMPLE_CHARS, text).otherwise(F.concat_ws(" ", *parts))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from the labelled rows outside fold 0, a bounded sample of them."""
    ids = F.col("doc_id").cast("long")
    labels = labels.select(ids.alias("_id"), F.col("toxic").cast("int").alias("toxic")).where("_id is not null and toxic in (0, 1)")
    labels = labels.where(fold(F.col("_id")) != 0)
    # A hash picks about SAMPLE rows of each class, so that tasks return no more than their share.
    number = {r.toxic: r["count"] for r in labels.groupBy("toxic").count().collect()}
    place = F.pmod(F.xxhash64(F.lit(10), "_id"), F.lit(1_000_000))
    picked = [labels.where((F.col("toxic") == c) & (place < math.ceil(1e6 * SAMPLE / number.get(c, 1)))).orderBy(place, "_id").limit(2 * SAMPLE) for c in (1, 0)]
    sample = F.broadcast(picked[0].unionAll(picked[1]))  # at most 4 * SAMPLE rows of two numbers
    rows = docs.select(ids.alias("doc_id"), _spread(F.coalesce("text", F.lit(""))).alias("text")).join(sample, F.col("doc_id") == F.col("_id"))
    rows = rows.select("toxic", "text", (F.xxhash64(F.lit(11), "doc_id") % 2 == 0).alias("half"), F.xxhash64(F.lit(12), "doc_id").alias("h"))
    rows = rows.orderBy("h", "text").limit(4 * SAMPLE).collect()
    learn = {c: [r.text for r in rows if r.half and r.toxic == c] for c in (0, 1)}
    ordinary, toxic = dictionaries(learn[1], learn[0])
    check = [r for r in rows if not r.half] or rows
    y = np.array([r.toxic for r in check], float)
    share = (y.sum() + 0.5) / (len(y) + 2)
    n = len(features(np.zeros(1)))
    if len(set(y)) < 2:
        return Model(ordinary, toxic, (0.0,) * n, (1.0,) * n, (0.0,) * n, float(np.log(share / (1 - share))))
    packers = _packer(ordinary), _packer(toxic)
    x = np.array([features(gains(r.text.encode(), *packers)) for r in check])
    center, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    weights, bias = _logistic((x - center) / scale, y)
    return Model(ordinary, toxic, tuple(map(float, center)), tuple(map(float, scale)), tuple(map(float, weights)), bias)


_OUT = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


def _scored(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    packers = _packer(model.ordinary), _packer(model.toxic)
    for b in batches:
        x = np.array([features(gains(t or b"", *packers)) for t in b.column(1).cast(pa.binary()).to_pylist()])
        logit = (x - np.array(model.center)) / np.array(model.scale) @ np.array(model.weights) + model.bias
        yield batch(_OUT, doc_id=b.column(0), score=1 / (1 + np.exp(-np.clip(logit, -30, 30))))


def toxicity_scores(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id`` and the ``score`` of each whole text."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(lambda b: _scored(b, model), "doc_id long, score double")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by the dictionaries of the labelled ones."""
    docs = table(spark, sf_dir, "documents")
    scores = toxicity_scores(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scores.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
