"""Suffix-array deduplication of byte strings.

Every byte covered by a string of ``width`` bytes that also starts earlier (in a
document with a smaller id, or earlier in the same one) is removed. How strings of
different documents come together, and how lists of several shards are merged by binary
search, is told in ``passages``; this module sorts the shards.

Defined results: null texts are empty. Matches never cross documents. A null id stands
behind all others. Rows that share an id and the text count as one place; different
texts of one id (or without an id) are documents in the order of a hash. Very long texts are cut in overlapping parts. An
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadstar.llm.common import batch, portions, strings, table
from loadstar.llm.passages import LAST_ID, Spec, covered_tokens, places, removed_by_document, repeated_windows
from loadstar.llm.suffix import classes, common_prefixes, joined, suffix_array

WIDTH = 100
GRAM = 24
_BITS = 9  # 256 byte values and the separator


def search(contents: list[bytes], ids: np.ndarray, start: np.ndarray, spec: Spec) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every window of the pieces (piece, offset), and whether it starts earlier.

    Pieces come in order of place, so the first of equal windows is the one that stands
    first in the joined text.
    """
    seq, begin = joined([np.frombuffer(c, np.uint8).astype(np.int32) + 1 for c in contents])
    order = suffix_array(seq, _BITS)
    group, first, _ = classes(common_prefixes(seq, order, _BITS, spec.width), spec.width)
    earliest = np.minimum.reduceat(order, first) if len(order) else order
    of = np.empty(len(seq), np.int64)
    of[order] = earliest[group]
    n = np.maximum(np.diff(begin) - spec.width, 0)
    piece = np.repeat(np.arange(len(contents)), n)
    offset = np.arange(n.sum()) - np.repeat(np.concatenate([[0], np.cumsum(n)[:-1]]), n)
    at = of[begin[piece] + offset]
    other = np.searchsorted(begin, at, side="right") - 1
    place = start[other] + at - begin[other]
    return piece, offset, (ids[other] != ids[piece]) | (place != start[piece] + offset)


_OUT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())])


def _kept(batches: Iterator[pa.RecordBatch], width: int, content: bool) -> Iterator[pa.RecordBatch]:
    for b in portions(batches):
        data, offsets = strings(b.column(1))
        gone = covered_tokens(b.column(2), offsets, width)
        sha, kept, removed, spans = [], [], [], []
        for low, high in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            mine = gone[low:high]
            text = data[low:high][~mine].tobytes()
            sha.append(hashlib.sha256(text).hexdigest())
            kept.append(text if content else None)
            removed.append(int(mine.sum()))
            spans.append(int(np.count_nonzero(mine[1:] & ~mine[:-1]) + (mine[:1].sum())))
        yield batch(_OUT, doc_id=b.column(0), n_bytes=np.diff(offsets), n_removed=removed, n_spans=spans, kept_sha256=sha, kept=kept)


def remove_repeats(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, content: bool = True, shard_bytes: int = 2 << 20) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` and the ``kept`` bytes.

    The kept bytes need not be valid UTF-8, since strings may begin inside a character.
    """
    rows = places(docs)
    spec = Spec("byte", width, min(gram, width), same_document=True, shard_bytes=shard_bytes)
    rows = removed_by_document(rows, repeated_windows(rows, spec, search))
    out = rows.mapInArrow(lambda b: _kept(b, width, content), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return out.withColumn("doc_id", F.nullif("doc_id", F.lit(LAST_ID)))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the strings of 100 bytes that start earlier."""
    return remove_repeats(table(spark, sf_dir, "documents"), content=False).drop("kept")
