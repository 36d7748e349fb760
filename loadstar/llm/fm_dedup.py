"""Substring deduplication of word sequences with a compressed FM-index per shard.

Every word covered by ``width`` consecutive words of its document that also start in a
document with a smaller id is removed. How documents come together in shards is told
in ``passages``. A shard indexes its pieces; the pieces of documents are then streamed
from right to left through backward search, which gives each place its matching
statistics: the longest sequence from there that the index holds (up to ``width``) and
the interval of suffixes that start with it. Where the length reaches the threshold,
the smallest document of the interval decides.

Defined results: null texts have no words. A null id stands behind all others. Rows that
share an id and the text count as one document; different texts of one id (or without an
id) are documents in the order of a hash. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadstar.llm.common import batch, portions, strings, table, words
from loadstar.llm.passages import LAST_ID, Spec, covered_tokens, places, removed_by_document, repeated_windows, tokens_of
from loadstar.llm.suffix import classes, common_prefixes, joined, suffix_array

WIDTH = 50
GRAM = 12


class WaveletTree:
    """A wavelet tree, level by level (as a wavelet matrix): bits packed by 64, with counts.

    It takes ``bits`` bits and half as many again for counts per token, and answers how
    often a symbol occurs before a place with one lookup per level.
    """

    def __init__(self, seq: np.ndarray, bits: int):
        self.bits, self.levels = bits, []
        n = len(seq)
        for level in range(bits - 1, -1, -1):
            bit = (seq >> level) & 1 == 1
            packed = np.zeros((n // 64 + 1) * 8, np.uint8)
            packed[: -(-n // 8)] = np.packbits(bit, bitorder="little")
            words64 = packed.view("<u8")
            before = np.concatenate([[0], np.cumsum(np.bitwise_count(words64), dtype=np.uint32)[:-1]]).astype(np.uint32)
            self.levels.append((level, words64, before, n - int(bit.sum())))
            seq = np.concatenate([seq[~bit], seq[bit]])
        self.start = self._walk(np.arange(1 << bits), np.zeros(1 << bits, np.int64))

    def _walk(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level, words64, before, zeros in self.levels:
            block = at >> 6
            inside = words64[block] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1))
            ones = before[block] + np.bitwise_count(inside)
            at = np.where((symbol >> level) & 1 == 1, zeros + ones, at - ones).astype(np.int64)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each place."""
        return self._walk(symbol, at) - self.start[symbol]


class FMIndex:
    """Backward search over a joined sequence; tokens from 1, separators 0."""

    def __init__(self, seq: np.ndarray, depth: int):
        n_symbols = int(seq.max(initial=0)) + 1
        self.bits = max(1, (n_symbols - 1).bit_length())
        self.depth = depth
        self.order = suffix_array(seq, self.bits)
        self.lcp = common_prefixes(seq, self.order, self.bits, depth)
        self.group, self.first, self.end = classes(self.lcp, depth)
        counts = np.bincount(seq, minlength=1 << self.bits)
        self.below = np.concatenate([[0], np.cumsum(counts)])[:-1]
        self.tree = WaveletTree(seq[self.order - 1], self.bits)
        self.n, self.n_symbols = len(seq), n_symbols

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the patterns with ``symbol`` put before them."""
        both = self.tree.rank(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
        return self.below[symbol] + both[: len(symbol)], self.below[symbol] + both[len(symbol) :]

    def _shorter(self, low: int, high: int) -> tuple[int, int, int]:
        """The next larger interval around one, and the length of its pattern."""
        length = max(int(self.lcp[low]), int(self.lcp[high]) if high < self.n else 0)
        if not length:
            return 0, self.n, 0
        reach = 64
        while True:
            less = np.flatnonzero(self.lcp[max(0, low - reach) : low + 1] < length)
            if len(less) or low - reach <= 0:
                low = max(0, low - reach) + (int(less[-1]) if len(less) else 0)
                break
            reach *= 4
        reach = 64
        while True:
            less = np.flatnonzero(self.lcp[high : high + reach] < length)
            if len(less) or high + reach >= self.n:
                high = high + int(less[0]) if len(less) else self.n
                break
            reach *= 4
        return low, high, length

    def matching_statistics(self, seq: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For every place of the texts: matched length (up to the depth) and first suffix.

        Texts are streamed side by side, each from its end. Tokens the index does not
        know match nothing. A pattern of full length drops its last token before it
        grows on; one that cannot grow falls back to the next shorter that the index
        holds.
        """
        seq = np.where(seq < self.n_symbols, seq, 0).astype(np.int64)
        length, row = np.zeros(len(seq), np.int32), np.zeros(len(seq), np.int64)
        begin, at = bounds[:-1], bounds[1:] - 1
        low, high, have = np.zeros(len(at), np.int64), np.full(len(at), self.n), np.zeros(len(at), np.int64)
        lanes = np.flatnonzero(at >= begin)
        while len(lanes):
            symbol = seq[at[lanes]]
            l, h = self.extend(symbol, low[lanes], high[lanes])
            ok = (l < h) & (symbol > 0)
            fine = lanes[ok]
            l, h, grown = l[ok], h[ok], have[fine] + 1
            over = grown > self.depth
            if over.any():
                c = self.group[l[over]]
                l[over], h[over] = self.first[c], self.end[c]
            low[fine], high[fine], have[fine] = l, h, np.minimum(grown, self.depth)
            length[at[fine]], row[at[fine]] = have[fine], l
            at[fine] -= 1
            for k in lanes[~ok].tolist():
                if have[k] and seq[at[k]] > 0:
                    low[k], high[k], have[k] = self._shorter(int(low[k]), int(high[k]))
                else:  # the token is not in the index
                    at[k] -= 1
                    low[k], high[k], have[k] = 0, self.n, 0
            lanes = lanes[at[lanes] >= begin[lanes]]
        return length, row


def search(contents: list[bytes], ids: np.ndarray, start: np.ndarray, spec: Spec) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every window of the pieces (piece, offset), and whether a smaller document has it."""
    data = np.frombuffer(b"".join(contents), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(c) for c in contents])]).astype(np.int64)
    hashes, bounds, _, _ = tokens_of("word", data, offsets)
    symbols = np.unique(hashes, return_inverse=True)[1].reshape(-1) + 1
    seq, begin = joined([symbols[i:j] for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)])
    index = FMIndex(seq, spec.width)
    owner = np.repeat(ids, np.diff(begin))
    smallest = np.minimum.reduceat(owner[index.order], index.first) if len(seq) else owner
    length, row = index.matching_statistics(symbols, bounds)
    n = np.maximum(np.diff(bounds) - spec.width + 1, 0)
    piece = np.repeat(np.arange(len(contents)), n)
    offset = np.arange(n.sum()) - np.repeat(np.concatenate([[0], np.cumsum(n)[:-1]]), n)
    at = bounds[piece] + offset
    found = (length[at] >= spec.width) & (smallest[index.group[row[at]]] < ids[piece])
    return piece, offset, found


_OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.string())])


def _kept(batches: Iterator[pa.RecordBatch], width: int, content: bool) -> Iterator[pa.RecordBatch]:
    for b in portions(batches):
        data, offsets = strings(b.column(1))
        starts, ends, bounds = words(data, offsets)
        gone = covered_tokens(b.column(2), bounds, width)
        raw = data.tobytes()
        sha, kept, removed = [], [], []
        for low, high, first, last in zip(bounds[:-1].tolist(), bounds[1:].tolist(), offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            mine = gone[low:high]
            if mine.any():
                stay = np.flatnonzero(~mine) + low
                text = b" ".join([raw[i:j] for i, j in zip(starts[stay].tolist(), ends[stay].tolist(), strict=True)])
            else:
                text = b" ".join(raw[first:last].split())  # splits at the same six bytes
            sha.append(hashlib.sha256(text).hexdigest())
            kept.append(text.decode() if content else None)
            removed.append(int(mine.sum()))
        yield batch(_OUT, doc_id=b.column(0), n_words=np.diff(bounds), n_removed=removed, kept_sha256=sha, kept=kept)


def remove_repeats(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, content: bool = True, shard_bytes: int = 2 << 20) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` and the ``kept`` words joined by spaces."""
    rows = places(docs)
    spec = Spec("word", width, min(gram, width), same_document=False, shard_bytes=shard_bytes)
    rows = removed_by_document(rows, repeated_windows(rows, spec, search))
    out = rows.mapInArrow(lambda b: _kept(b, width, content), "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")
    return out.withColumn("doc_id", F.nullif("doc_id", F.lit(LAST_ID)))


def op2_fm_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the windows of 50 words that a smaller document holds."""
    return remove_repeats(table(spark, sf_dir, "documents"), content=False).drop("kept")


#: Every window as its text; a word goes if a window over it also starts in a smaller id.
OP2_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), windows AS (
  SELECT rid, doc_id, i, array_to_string(words[i:i + 49], ' ') AS fifty
  FROM (SELECT *, unnest(range(1, len(words) - 48)) AS i FROM d WHERE len(words) >= 50)
), again AS (
  SELECT rid, i FROM (SELECT rid, i, doc_id, min(doc_id) OVER (PARTITION BY fifty) AS first_id FROM windows) WHERE first_id < doc_id
), gone AS (
  SELECT DISTINCT rid, unnest(range(i, i + 50)) AS i FROM again
), each AS (
  SELECT rid, unnest(range(1, len(words) + 1)) AS i, unnest(words) AS word FROM d
), kept AS (
  SELECT rid, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n FROM each ANTI JOIN gone USING (rid, i) GROUP BY rid
)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (rid)
"""
