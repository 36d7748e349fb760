"""Hierarchical Pitman-Yor language model, seated by Gibbs sampling over partitioned restaurants.

Tokens are lower-cased words and one end for each text. A token's context is the word before
it: each word of the training texts has a restaurant of its own, and the start of a text has
one. The context restaurants share one parent, the restaurant of words without context, whose
parent is uniform over the known words and one unknown. Customers of a context restaurant are the tokens seen there; each of its tables
sends one customer to the parent, where each table is a draw from the uniform base.

One sweep of the sampler draws, for every pair of context and word, the number of tables of
its customers from the conditional distribution given the parent's probability of the word
and the context's other tables, then the tables of each word in the parent. What a table
seats beyond its number does not enter any probability, so it is summed out: the weights of
1 to c tables are products of the chances to open one and generalized Stirling numbers, which
is exact up to ``EXACT`` customers; of larger groups, ``PARTICLES`` seatings grow side by side in
portions of a sixteenth and are drawn anew after each by how well they explain it (their mean
number of tables is within about a tenth of the exact one). All words sample at once, with the counts of the sweep before. After
``BURN`` sweeps the predictive probabilities of ``SAMPLES`` sweeps are averaged.

Everything that grows is dealt by word, also what belongs to contexts: a pair of context and word
is dealt by its rarer one where one of them is among the ``FREQUENT`` most frequent words, and by
the second otherwise, so no word owns more than two parts in ``FREQUENT`` of all pairs, and
portions of text add up their counts before they are shuffled. A context of a rarer word has its
pairs in many buckets. Before each sweep, every bucket sends the tables it has there to the task
that adds them up, and hears their sum. Tables of a frequent word behind rarer ones are spread in
the same way; the parent seats them one sweep later than the others. What all tasks need is bounded
by ``FREQUENT``: totals of the frequent words, and the matrix of log probabilities of these in the
contexts of each other, 4 bytes for each of about ``FREQUENT`` squared. So pairs of two frequent
words, however hot, are scored where their text is and are not shuffled; all others are asked of
their owner's bucket, which has all that its probability needs.

Defined results: a null or empty text is one end token. Rows without an id are trained on and
not held out. Rows are scored each, repeated ones too. Without training tokens every
probability is one. Words are told apart by their XXH64. Columns other than ``doc_id, text``
are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadstar.llm.common import discard, portions, stored, strings, table, words
from loadstar.llm.xxh64 import xxh64

FREQUENT = 1022  # words whose pairs are scored where their text is
BURN = 2  # sweeps before the first that counts
SAMPLES = 3  # sweeps whose probabilities are averaged
STRENGTH = 1.0  # concentration of every restaurant
EXACT = 400  # customers up to which numbers of tables are drawn exactly
FIRST = 32  # customers that larger groups begin with
PARTICLES = 16  # seatings of a larger group that are kept side by side
SEED = 12
PORTION = 4 << 20  # bytes of text whose counts are added up before the shuffle
BUCKET_TOKENS = 1 << 20  # tokens a bucket of words should hold
DESK_TOKENS = 1 << 23  # tokens whose contexts are added up by one task
ASKED = 1 << 17  # pairs that are answered at a time
BATCH = 2 * PORTION - (PORTION >> 3)  # bytes of rows that pass between Spark and Python at a time
_FLAT = 1 << 18  # weights of numbers of tables held at a time
_END = np.uint64(0)  # hash of the end token; no word has it

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, and the bounds between texts."""
    data = _LOWER[data]
    starts, ends, first = words(data, offsets)
    h = xxh64(data, starts, ends) if len(starts) else np.zeros(0, np.uint64)
    h[h == _END] = 1
    bounds = first + np.arange(len(first))
    out = np.full(bounds[-1], _END)
    out[np.arange(len(h)) + np.repeat(np.arange(len(first) - 1), np.diff(first))] = h
    return out, bounds


def _small(x: np.ndarray) -> bytes:
    """Non-negative integers in the fewest bytes that hold the largest, which the first byte tells.

    Zero there means one byte each, and behind them places and values of the few that need more.
    """
    width = np.min_scalar_type(int(x.max(initial=0))).itemsize
    if width > 1:
        large = np.flatnonzero(x > 255)
        if 16 * len(large) < (width - 1) * len(x):
            return b"\0" + x.astype(np.uint8).tobytes() + large.astype("<u8").tobytes() + x[large].astype("<u8").tobytes()
    return bytes([width]) + x.astype(f"<u{width}").tobytes()


def _wide(blob: bytes, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0, np.int64)
    out = np.frombuffer(blob, f"<u{blob[0] or 1}", n, 1).astype(np.int64)
    if not blob[0]:
        at, values = np.frombuffer(blob, "<u8", offset=n + 1).reshape(2, -1).astype(np.int64)
        out[at] = values
    return out


def _longs(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, np.uint64)


def _bucket(h: np.ndarray, number: int) -> np.ndarray:
    """Buckets in order of hashes."""
    return ((h >> np.uint64(32)) * np.uint64(number) >> np.uint64(32)).astype(np.int64)


def _counted(h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes, sorted, with the sums of their counts."""
    order = np.argsort(h)
    h, n = h[order], n[order]
    at = np.flatnonzero(np.concatenate([np.ones(min(len(h), 1), bool), h[1:] != h[:-1]]))
    return h[at], np.add.reduceat(n, at) if len(at) else n


def _pieces(bucket: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of equal buckets."""
    cuts = np.flatnonzero(np.diff(bucket, prepend=-1)).tolist()
    return list(zip(cuts, [*cuts[1:], len(bucket)], strict=False)) if cuts else []


@contextmanager
def _batches_of(spark: SparkSession, size: int) -> Iterator[None]:
    """Batches of at most about ``size`` bytes; rows of state are large, and both sides hold a batch."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(size))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


_COUNTS = "bucket int, words binary, counts binary"
_Rows = Iterator[pa.RecordBatch]


def _rows(ddl_names: list[str], rows: list[tuple], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=ddl_names)


def _word_counts(batches: _Rows, number: int) -> _Rows:
    """Words of the training texts, counted within portions and dealt by hash."""
    for b in portions(batches, size=PORTION):
        h, bounds = tokens(*strings(b.column(1)))
        learn = np.repeat(~np.asarray(b.column(2)).astype(bool), np.diff(bounds))
        h, n = np.unique(h[learn], return_counts=True)
        bucket = _bucket(h, number)
        rows = [(int(bucket[i]), h[i:j].tobytes(), _small(n[i:j])) for i, j in _pieces(bucket)]
        yield _rows(["bucket", "words", "counts"], rows, [pa.int32(), pa.binary(), pa.binary()])


def _each(batches: _Rows) -> Iterator[dict]:
    """Single rows; a batch may hold many large ones."""
    for b in batches:
        for low in range(0, b.num_rows, 16):
            yield from b.slice(low, 16).to_pylist()


def _groups(batches: _Rows, by: str = "bucket") -> Iterator[tuple[int, list[dict]]]:
    """Rows of each bucket; they come in order of buckets."""
    current, held = None, []
    for row in _each(batches):
        if row[by] != current:
            if held:
                yield current, held
            current, held = row[by], []
        held.append(row)
    if held:
        yield current, held


def _vocabulary(batches: _Rows, top: int) -> _Rows:
    """Per bucket: tokens, distinct words, and its most frequent words."""
    names, types = ["tokens", "distinct", "word", "count"], [pa.int64()] * 4
    for _, rows in _groups(batches):
        parts = [(_longs(r["words"]), _wide(r["counts"], len(r["words"]) // 8)) for r in rows]
        h, n = _counted(*(np.concatenate(x) for x in zip(*parts, strict=True)))
        best = np.lexsort((h, -n))[:top]
        yield _rows(names, [(int(n.sum()), len(h), None, None)], types)
        yield _rows(names, [(0, 0, int(w), int(c)) for w, c in zip(h[best].view(np.int64), n[best], strict=True)], types)


@dataclass(frozen=True)
class Vocabulary:
    """Training tokens, distinct training words, and the frequent words, sorted by hash.

    With ``shared``, all rarer words are one context.
    """

    tokens: int
    distinct: int
    words: np.ndarray
    counts: np.ndarray
    shared: bool = False

    @property
    def rare(self) -> int:
        return len(self.words)

    @property
    def start(self) -> int:
        return len(self.words) + 1

    @property
    def contexts(self) -> int:
        return len(self.words) + 2

    @property
    def other(self) -> int:
        return 2 * len(self.words) + 2

    @property
    def size(self) -> int:
        return len(self.words) + 2 + 3 * len(self.words) + _EXTRA

    @property
    def desks(self) -> int:
        """Ranges of hashes in which totals of contexts of rarer words are added up; fewer than buckets, so that each hears of many at a time."""
        return max(32, math.ceil(self.tokens / DESK_TOKENS))

    def codes(self, h: np.ndarray) -> np.ndarray:
        """Places of frequent words; ``rare`` for all others."""
        if not len(self.words):
            return np.zeros(len(h), np.int64)
        at = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
        return np.where(self.words[at] == h, at, self.rare)

    def coded(self, h: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
        """Distinct words, and of all tokens the place among these, the code, and both of the token before."""
        distinct, word = np.unique(h, return_inverse=True)
        word = word.astype(np.int32)
        code = self.codes(distinct).astype(np.int32)[word]
        before = np.concatenate([code[:1], code[:-1]])
        before[bounds[:-1]] = self.start
        return distinct, word, code, np.concatenate([word[:1], word[:-1]]), before

    def dealt(self, word: np.ndarray, code: np.ndarray, previous: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For all tokens the owner's place and the context.

        The owner of a pair is its rarer word, so that no owner is in more than two parts in
        ``FREQUENT`` of all pairs; of two rarer or two frequent words it is the second. Contexts are
        the codes of frequent words and of the start; ``contexts`` and a code, where the owner is
        the context of this frequent word; and ``other`` for the rarer words, told by their hash.
        """
        if self.shared:
            return word, before
        rarer, hot = before == self.rare, code < self.rare
        context = np.where(rarer, np.where(hot, self.contexts + code, self.other), before)
        return np.where(rarer & hot, previous, word), context

    def parts(self, totals: np.ndarray) -> list[np.ndarray]:
        """Tables of each frequent context, of each frequent word behind rarer ones, and the parent's
        customers and tables of each frequent word."""
        return np.split(totals[:-_EXTRA], [self.contexts, self.contexts + self.rare, self.contexts + 2 * self.rare])


def vocabulary(rows: DataFrame, frequent: int = FREQUENT, shared: bool = False) -> Vocabulary:
    """Counts over all training rows of ``doc_id, text, held_out``."""
    number = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = rows.mapInArrow(lambda b: _word_counts(b, number), _COUNTS).repartition(F.col("bucket")).sortWithinPartitions("bucket")
    found = stored(counts.mapInArrow(lambda b: _vocabulary(b, frequent), "tokens long, distinct long, word long, count long"), "lm-words")
    n, v = found.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("distinct"), F.lit(0))).first()
    best = found.where("word is not null").orderBy(F.desc("count"), "word").limit(frequent).collect()
    discard(found)
    h = np.array([r["word"] for r in best], np.int64).view(np.uint64)
    order = np.argsort(h)
    return Vocabulary(n, v, h[order], np.array([r["count"] for r in best], np.int64)[order], shared)


def _by_word(h: np.ndarray, context: np.ndarray, last: np.ndarray, far: np.ndarray, known: Vocabulary, number: int) -> list[tuple]:
    """Rows of sorted owners: bucket, distinct owners, their numbers of entries, and the entries."""
    bucket = _bucket(h, number)
    out = []
    for i, j in _pieces(bucket):
        at = np.flatnonzero(np.concatenate([[True], h[i + 1 : j] != h[i : j - 1]]))
        runs = np.diff(np.append(at, j - i))
        blobs = h[i:j][at].tobytes(), _small(runs), context[i:j].astype(np.uint16).tobytes(), _small(last[i:j])
        out.append((int(bucket[i]), *blobs, far[i:j][context[i:j] == known.other].tobytes()))
    return out


_PAIRS = "bucket int, a binary, b binary, c binary, d binary, e binary"
_PAIR_NAMES = [c.split()[0] for c in _PAIRS.split(", ")]
_PAIR_TYPES = [pa.int32(), *[pa.binary()] * 5]


def _pairs(batches: _Rows, known: Vocabulary, number: int) -> _Rows:
    """Training counts of pairs of context and word, added up within portions and dealt by owner.

    Pairs of two rarer words that only held-out texts have come with a count of zero, and so do
    frequent words behind rarer ones, whose counts are with the rarer word.
    """
    for b in portions(batches, size=PORTION):
        h, bounds = tokens(*strings(b.column(1)))
        learn = np.repeat(~np.asarray(b.column(2)).astype(bool), np.diff(bounds))
        distinct, word, code, previous, before = known.coded(h, bounds)
        owner, context = known.dealt(word, code, previous, before)
        follows = np.unique(word[learn & (context >= known.contexts) & (context < known.other)])
        use = learn | (context == known.other)
        far = np.where(context == known.other, previous, 0)
        owner, context, far, n = (np.concatenate([x[use], y]) for x, y in ((owner, follows), (context, 0 * follows), (far, 0 * follows), (learn, 0 * follows)))
        owner, context, far, n = _added(owner, context, far, n.astype(np.int64))
        yield _rows(_PAIR_NAMES, _by_word(distinct[owner], context, n, distinct[far], known, number), _PAIR_TYPES)


def _added(owner: np.ndarray, context: np.ndarray, far: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct (owner, context, other context), sorted, with the sums of their counts; all are places."""
    if not len(n):
        return owner, context, far, n
    key, size = owner.astype(np.int64) * 65536 + context, int(far.max()) + 1
    if int(key.max()) < (1 << 62) // size:
        key = key * size + far
        order = np.argsort(key)
        key = key[order]
        at = np.flatnonzero(np.diff(key, prepend=-1))
    else:
        order = np.lexsort((far, key))
        at = np.flatnonzero((np.diff(key[order], prepend=-1) != 0) | (np.diff(far[order], prepend=-1) != 0))
    first = order[at]
    return owner[first], context[first], far[first], np.add.reduceat(n[order], at)


#: State of a bucket: owners; contexts of rarer words that its pairs have, sorted; cells of each
#: owner, the cells' context (see ``Vocabulary.dealt``), places of the other contexts, customers and
#: tables, tables in the parent, the tables added up over samples, in each sample the parent's
#: probabilities and the tables of owners as contexts, and totals (see ``_Cells.summary``). Kind 0;
#: answers about contexts of rarer words are kind 1.
_STATE = "kind int, bucket int, words binary, reach binary, runs binary, context binary, far binary, customers binary, tables binary, above binary, summed binary, parent binary, behind binary, totals binary"
_STATE_NAMES = [c.split()[0] for c in _STATE.split(", ")]
_STATE_TYPES = [pa.int32(), pa.int32(), *[pa.binary()] * 12]
_EXTRA = 6


class _Cells:
    """Cells of one bucket."""

    def __init__(self, row: dict | None, known: Vocabulary):
        row = row or dict.fromkeys(_STATE_NAMES, b"")
        self.known = known
        self.words = _longs(row["words"])
        self.owner = np.repeat(np.arange(len(self.words)), _wide(row["runs"], len(self.words)))
        self.context = np.frombuffer(row["context"], np.uint16).astype(np.int64)
        self.customers, self.tables, self.summed = (_wide(row[c], len(self.context)) for c in ("customers", "tables", "summed"))
        self.above = _wide(row["above"], len(self.words))
        self.code = known.codes(self.words)
        self.reach = _longs(row["reach"])
        self.other = self.context == known.other
        self.far = _wide(row["far"], int(self.other.sum()))
        self.follows = (self.context >= known.contexts) & ~self.other

    def places(self, h: np.ndarray) -> np.ndarray:
        """Places of words; one behind the last of the frequent ones for unknown words."""
        return _found(self.words, h, len(self.words) + self.known.rare)

    def behind(self, h: np.ndarray) -> np.ndarray:
        """Places of rarer words among contexts, behind the frequent ones."""
        return self.known.contexts + _found(self.reach, h, len(self.reach))

    def at(self) -> tuple[np.ndarray, np.ndarray]:
        """Places of each cell's word (frequent ones stand behind the owners) and context."""
        word, where = self.owner.copy(), self.context.copy()
        word[self.follows] = len(self.words) + self.context[self.follows] - self.known.contexts
        where[self.follows] = self.behind(self.words)[self.owner[self.follows]]
        where[self.other] = self.known.contexts + self.far
        return word, where

    def asked(self, distinct: np.ndarray, owner: np.ndarray, context: np.ndarray, far: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for questions, which tell words by their hashes."""
        word, where = self.places(distinct)[owner], context.copy()
        follows = np.flatnonzero((context >= self.known.contexts) & (context < self.known.other))
        word[follows] = len(self.words) + context[follows] - self.known.contexts
        where[follows] = self.behind(distinct)[owner[follows]]
        where[context == self.known.other] = self.behind(far)
        return word, where

    def sent(self, tables: np.ndarray, elsewhere: np.ndarray) -> np.ndarray:
        """Tables that the parent seats of each owner; those of frequent words ``elsewhere`` come by code."""
        out = np.bincount(self.owner[~self.follows], tables[~self.follows], len(self.words)).astype(np.int64)
        hot = self.code < self.known.rare
        out[hot] += elsewhere[self.code[hot]]
        return out

    def summary(self, tables: np.ndarray, sent: np.ndarray, above: np.ndarray) -> np.ndarray:
        """Tables of each frequent context, of each frequent word behind rarer ones, the parent's
        customers and tables of each frequent word, of all words, and room for counts of counts."""
        known, hot = self.known, self.code < self.known.rare
        seated, follows = self.context < known.contexts, self.follows
        parts = [np.bincount(self.context[seated], tables[seated], known.contexts), np.bincount(self.context[follows] - known.contexts, tables[follows], known.rare)]
        parts += [np.bincount(self.code[hot], x[hot], known.rare) for x in (sent, above)]
        return np.concatenate([*parts, [sent.sum(), above.sum()], [0] * 4]).astype(np.int64)


def _found(sorted_: np.ndarray, h: np.ndarray, missing: int) -> np.ndarray:
    if not len(sorted_):
        return np.full(len(h), missing)
    at = np.minimum(np.searchsorted(sorted_, h), len(sorted_) - 1)
    return np.where(sorted_[at] == h, at, missing)


def _state(row: dict, **changed: bytes) -> pa.RecordBatch:
    return _rows(_STATE_NAMES, [tuple((row | changed)[c] for c in _STATE_NAMES)], _STATE_TYPES)


def _cells(batches: _Rows, known: Vocabulary) -> _Rows:
    """Training counts of every (context, word), each group of customers at one table."""
    for bucket, rows in _groups(batches):
        words_ = [_longs(r["a"]) for r in rows]
        runs = np.concatenate([_wide(r["b"], len(w)) for r, w in zip(rows, words_, strict=True)])
        contexts = [np.frombuffer(r["c"], np.uint16) for r in rows]
        n = np.concatenate([_wide(r["d"], len(c)) for r, c in zip(rows, contexts, strict=True)])
        context = np.concatenate(contexts).astype(np.int64)
        others, other = np.unique(np.concatenate([_longs(r["e"]) for r in rows]), return_inverse=True)
        far = np.zeros(len(context), np.int64)
        far[context == known.other] = other
        owners, place = np.unique(np.concatenate(words_), return_inverse=True)
        del rows, words_, contexts, other
        place, context, far, n = _added(np.repeat(place, runs), context, far, n)
        present = np.flatnonzero(np.bincount(place[(n > 0) | (context != known.other)], minlength=len(owners)))
        place, context, far, n = (x[n > 0] for x in (place, context, far, n))
        runs = np.bincount(place, minlength=len(owners))[present]
        owners = owners[present]
        reach = np.zeros(0, np.uint64) if known.shared else np.union1d(owners[known.codes(owners) == known.rare], others)
        if not len(owners) and not len(reach):
            continue
        one = _small(np.ones(len(n), np.int64))
        row = {"kind": 0, "bucket": bucket, "words": owners.tobytes(), "reach": reach.tobytes(), "runs": _small(runs)}
        row |= {"context": context.astype(np.uint16).tobytes(), "far": _small(np.searchsorted(reach, others)[far[context == known.other]])}
        row |= {"customers": _small(n), "tables": one, "above": _small(np.ones(len(owners), np.int64)), "summed": _small(np.zeros(len(n), np.int64)), "parent": b"", "behind": b""}
        held = _Cells(row, known)
        cells = held.sent(held.tables, np.zeros(known.rare, np.int64))
        totals = held.summary(held.tables, cells, held.above)
        totals[: known.contexts] = held.summary(n, cells, held.above)[: known.contexts]
        rarer = cells[held.code == known.rare]
        totals[-4:] = (n == 1).sum(), (n == 2).sum(), (rarer == 1).sum(), (rarer == 2).sum()
        yield _state(row, totals=totals.astype("<i8").tobytes())


_SENT = "bucket int, source int, words binary, counts binary"
_REPLY = "kind int, bucket int, source int, counts binary"


def _sent(batches: _Rows, known: Vocabulary, samples: int) -> _Rows:
    """Each bucket's tables in contexts of rarer words, dealt by context.

    With ``samples``, its customers there too, and what the owners' samples before the last had.
    """
    names, types = [c.split()[0] for c in _SENT.split(", ")], [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    for r in _each(batches):
        held = _Cells(r, known)
        where = held.at()[1] - known.contexts
        inside = np.flatnonzero(where >= 0)
        counted = [held.tables, held.customers] if samples else [held.tables]
        values = [np.bincount(where[inside], x[inside], len(held.reach)).astype(np.int64) for x in counted]
        if samples:
            place = held.behind(held.words) - known.contexts
            rarer = held.code == known.rare
            for x in np.frombuffer(r["behind"], "<u4").reshape(samples - 1, len(held.words)):
                values.append(np.zeros(len(held.reach), np.int64))
                values[-1][place[rarer]] = x[rarer]
        values = np.stack(values, axis=1)
        bucket = _bucket(held.reach, known.desks)
        yield _rows(names, [(int(bucket[i]), r["bucket"], held.reach[i:j].tobytes(), _small(values[i:j].ravel())) for i, j in _pieces(bucket)], types)


def _replied(batches: _Rows, width: int) -> _Rows:
    """Sums over all buckets, for each that sent some of the words."""
    names, types = [c.split()[0] for c in _REPLY.split(", ")], [pa.int32(), pa.int32(), pa.int32(), pa.binary()]
    for bucket, rows in _groups(batches):
        sent = [_longs(r["words"]) for r in rows]
        values = np.concatenate([_wide(r["counts"], len(w) * width).reshape(-1, width) for r, w in zip(rows, sent, strict=True)])
        found, place = np.unique(np.concatenate(sent), return_inverse=True)
        sums = np.stack([np.bincount(place, values[:, k], len(found)).astype(np.int64) for k in range(width)], axis=1)[place]
        ends = np.cumsum([len(w) for w in sent]).tolist()
        yield _rows(names, [(1, r["source"], bucket, _small(sums[i:j].ravel())) for r, i, j in zip(rows, [0, *ends], ends, strict=False)], types)


def _replies(state: DataFrame, known: Vocabulary, samples: int = 0) -> DataFrame:
    """Totals of the contexts of rarer words, for each bucket that has pairs with them."""
    sent = state.mapInArrow(lambda b: _sent(b, known, samples), _SENT).repartitionById(known.desks, F.col("bucket"))
    return sent.mapInArrow(lambda b: _replied(b, 1 + samples), _REPLY)


def _met(state: DataFrame, number: int, replies: DataFrame | None, asks: DataFrame | None = None) -> DataFrame:
    """The state of each bucket, followed by the answers to it in order of contexts, then by questions."""
    both = state.drop("totals")
    for more in (replies, asks):
        both = both.unionByName(more, allowMissingColumns=True) if more is not None else both
    order = [c for c in ("bucket", "kind", "source", "portion") if c in both.columns]
    return _in_buckets(both, number).sortWithinPartitions(*order)


def _in_buckets(rows: DataFrame, number: int) -> DataFrame:
    """Two buckets to a partition, whatever their numbers hash to."""
    return rows.repartitionById((number + 1) // 2, F.shiftright("bucket", 1))


def _answered(rows: list[dict], reach: np.ndarray, desks: int, width: int) -> np.ndarray:
    """Totals of the contexts in ``reach`` as rows."""
    parts = [np.zeros((0, width), np.int64)]
    for (i, j), r in zip(_pieces(_bucket(reach, desks)), rows, strict=True):
        parts.append(_wide(r["counts"], (j - i) * width).reshape(-1, width))
    return np.concatenate(parts)


def _totals(batches: _Rows) -> _Rows:
    total = None
    for b in batches:
        for blob in b.column(0).to_pylist():
            now = np.frombuffer(blob, "<i8")
            total = now if total is None else total + now
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], names=["i", "value"])


def _gathered(state: DataFrame, size: int) -> np.ndarray:
    """Totals over all buckets, as long as there are contexts."""
    out = np.zeros(size, np.int64)
    for r in state.select("totals").mapInArrow(_totals, "i int, value long").groupBy("i").agg(F.sum("value").alias("value")).collect():
        out[r["i"]] = r["value"]
    return out


@lru_cache(maxsize=8)
def _stirling(discount: float, size: int) -> np.ndarray:
    """Logarithms of the summed seating weights of n customers at k tables."""
    out = np.full((size + 1, size + 1), -np.inf)
    out[1, 1] = 0
    k = np.arange(size + 1)
    for n in range(1, size):
        with np.errstate(divide="ignore", invalid="ignore"):
            stay = np.where(k <= n, np.log(np.maximum(n - k * discount, 0)) + out[n], -np.inf)
        out[n + 1] = np.logaddexp(np.concatenate([[-np.inf], out[n, :-1]]), stay)
    return out


def _exactly(customers: np.ndarray, chance: np.ndarray, others: np.ndarray, discount: float, strength: float, rng: np.random.Generator) -> np.ndarray:
    """Numbers of tables of groups of up to ``EXACT`` customers, all weights written out."""
    weights = _stirling(discount, EXACT)
    out = np.ones(len(customers), np.int64)
    ends = np.cumsum(customers)
    low = 0
    while low < len(customers):
        high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + _FLAT, side="right")))
        c = customers[low:high]
        begin = np.cumsum(c) - c
        group = np.repeat(np.arange(len(c)), c)
        k = np.arange(len(group)) - begin[group]
        opened = np.log((strength + discount * (others[low:high][group] + k)) * chance[low:high][group])
        opened = np.cumsum(opened)
        opened -= (opened[begin] - np.log((strength + discount * others[low:high]) * chance[low:high]))[group]
        score = opened + weights[c[group], k + 1] - np.log(-np.log(rng.random(len(k))))
        best = np.flatnonzero(score == np.maximum.reduceat(score, begin)[group])
        out[low:high][group[best]] = k[best] + 1
        low = high
    return out


def _in_portions(customers: np.ndarray, chance: np.ndarray, others: np.ndarray, discount: float, strength: float, rng: np.random.Generator) -> np.ndarray:
    """The same for large groups: ``PARTICLES`` seatings of each grow by a sixteenth at a time.

    After each portion they are drawn anew by the probability of its dishes, since seatings
    with few tables explain a dish better than they are likely to arise.
    """
    shape = (len(customers), PARTICLES)
    chance, others = (np.repeat(x, PARTICLES).reshape(shape) for x in (chance, others))
    seats = _exactly(np.full(others.size, FIRST), chance.ravel(), others.ravel(), discount, strength, rng).reshape(shape)
    now = np.full(len(customers), FIRST, np.int64)
    out = np.zeros(len(customers), np.int64)
    left = np.arange(len(customers))
    while len(left):
        more = np.minimum(customers[left] - now, np.maximum(1, now // 16))
        new = (strength + discount * (others[left] + seats)) * chance[left]
        dish = new + now[:, None] - discount * seats
        weight = more[:, None] * np.log(dish)
        seats = seats + rng.binomial(np.broadcast_to(more[:, None], seats.shape), new / dish)
        weight = np.cumsum(np.exp(weight - weight.max(axis=1, keepdims=True)), axis=1)
        drawn = (np.arange(PARTICLES) + rng.random((len(left), 1))) / PARTICLES * weight[:, -1:]
        again = np.minimum((weight[:, :, None] < drawn[:, None, :]).sum(axis=1), PARTICLES - 1)
        seats = np.take_along_axis(seats, again, axis=1)
        now = now + more
        done = now == customers[left]
        out[left[done]] = seats[done, rng.integers(PARTICLES, size=int(done.sum()))]
        left, now, seats = left[~done], now[~done], seats[~done]
    return out


def seated(customers: np.ndarray, chance: np.ndarray, others: np.ndarray, discount: float, strength: float, rng: np.random.Generator) -> np.ndarray:
    """Numbers of tables drawn for groups of customers that share a dish.

    ``chance`` is the parent's probability of the dish, ``others`` the restaurant's other tables.
    """
    out = np.empty(len(customers), np.int64)
    large = customers > EXACT
    for method, of in ((_exactly, ~large), (_in_portions, large)):
        out[of] = method(customers[of], chance[of], others[of], discount, strength, rng)
    return out


@dataclass(frozen=True)
class Model:
    """What all tasks know: bounded by the number of contexts."""

    known: Vocabulary
    seen: np.ndarray  # training tokens in each context
    discount: float
    discount_above: float
    strength: float
    samples: list[np.ndarray] = field(default_factory=list)  # totals of each sample

    @property
    def uniform(self) -> float:
        return 1.0 / (self.known.distinct + 1)

    def above(self, customers: np.ndarray, tables: np.ndarray, totals: np.ndarray) -> np.ndarray:
        """The parent's probabilities of words."""
        all_customers, all_tables = totals[-_EXTRA : 2 - _EXTRA].tolist()
        rest = (self.strength + self.discount_above * all_tables) * self.uniform
        return (customers - self.discount_above * tables + rest) / (self.strength + all_customers)

    def frequent(self, totals: np.ndarray) -> np.ndarray:
        """The parent's probabilities of the frequent words."""
        return self.above(*self.known.parts(totals)[2:], totals)

    def backing(self) -> np.ndarray:
        """For each sample, the weight of the parent in each frequent context."""
        tables = np.array([s[: len(self.seen)] for s in self.samples], np.float64)
        return (self.strength + self.discount * tables) / (self.strength + self.seen)


def _swept(batches: _Rows, model: Model, totals: np.ndarray, sweep: int, counts: bool, seed: int) -> _Rows:
    """Each bucket after one sweep; ``counts`` adds the state before it to the samples."""
    known = model.known
    frequent, elsewhere, hot_sent, _ = known.parts(totals)
    for bucket, rows in _groups(batches):
        r, held = rows[0], _Cells(rows[0], known)
        rarer = _answered(rows[1:], held.reach, known.desks, 1)[:, 0]
        word, where = held.at()
        hot = held.code < known.rare
        sent = held.sent(held.tables, np.zeros(known.rare, np.int64))
        sent[hot] = hot_sent[held.code[hot]]
        own = model.above(sent, held.above, totals)
        changed = {}
        if counts:
            behind = np.append(rarer, 0)[np.minimum(held.behind(held.words) - known.contexts, len(rarer))]
            changed = {"summed": _small(held.summed + held.tables), "parent": r["parent"] + own.tobytes(), "behind": r["behind"] + behind.astype("<u4").tobytes()}
        rng = np.random.default_rng([seed, sweep, bucket])
        several = np.flatnonzero(held.customers > 1)
        chance = np.concatenate([own, model.frequent(totals)])[word[several]]
        others = np.concatenate([frequent, rarer])[where[several]] - held.tables[several]
        tables = held.tables.copy()
        tables[several] = seated(held.customers[several], chance, others, model.discount, model.strength, rng)
        # Tables of frequent words behind rarer ones are spread over all buckets: the parent seats those of the sweep before.
        sent = held.sent(tables, elsewhere)
        several = np.flatnonzero(sent > 1)
        others = totals[1 - _EXTRA] - held.above[several]
        above = np.minimum(sent, 1)
        above[several] = seated(sent[several], np.full(len(several), model.uniform), others, model.discount_above, model.strength, rng)
        now = held.summary(tables, sent, above)
        yield _state(r, tables=_small(tables), above=_small(above), totals=now.astype("<i8").tobytes(), **changed)


def _discount(once: int, twice: int) -> float:
    """The usual estimate from how many counts are one and two."""
    return min(0.95, max(0.05, once / (once + 2 * twice))) if once else 0.5


def train(cells: DataFrame, known: Vocabulary, number: int, burn: int = BURN, samples: int = SAMPLES, strength: float = STRENGTH, seed: int = SEED) -> tuple[DataFrame, Model]:
    """Sweeps over the stored cells; the state after them and what is known of its samples."""
    counted = _gathered(cells, known.size)
    one, two, words_one, words_two = counted[-4:].tolist()
    _, elsewhere, hot, _ = known.parts(counted)
    words_one, words_two = words_one + int((elsewhere + hot == 1).sum()), words_two + int((elsewhere + hot == 2).sum())
    model = Model(known, counted[: known.contexts], _discount(one, two), _discount(words_one, words_two), strength)
    # At first each group of customers has one table, and so has each word in the parent.
    totals = _gathered(cells.mapInArrow(lambda b: _first_totals(b, known), "totals binary"), known.size)
    _, elsewhere, hot, _ = known.parts(totals)  # views
    hot += elsewhere
    totals[-_EXTRA] += elsewhere.sum()
    state = cells
    for sweep in range(burn + samples):
        met = state if known.shared else _met(state, number, _replies(state, known))
        after = stored(met.mapInArrow(lambda b, s=sweep, t=totals: _swept(b, model, t, s, s > burn, seed), _STATE), "lm-state")
        discard(state)
        if sweep > burn:
            model.samples.append(totals)
        state, totals = after, _gathered(after, known.size)
    model.samples.append(totals)
    return state, model


def _first_totals(batches: _Rows, known: Vocabulary) -> _Rows:
    for r in _each(batches):
        held = _Cells(r, known)
        now = held.summary(held.tables, held.sent(held.tables, np.zeros(known.rare, np.int64)), held.above)
        yield _rows(["totals"], [(now.astype("<i8").tobytes(),)], [pa.binary()])


class _Words:
    """Probabilities of one bucket's words, averaged over the samples."""

    def __init__(self, model: Model, row: dict | None, replies: list[dict]):
        self.model = model
        self.held = held = _Cells(row, model.known)
        known, samples, size = model.known, len(model.samples), len(held.words)
        sent = held.sent(held.tables, np.zeros(known.rare, np.int64))
        hot = held.code < known.rare
        sent[hot] = known.parts(model.samples[-1])[2][held.code[hot]]
        chance = [*np.frombuffer(row["parent"] if row else b"", np.float64).reshape(samples - 1, size), model.above(sent, held.above, model.samples[-1])]
        unknown = [model.above(np.zeros(1), np.zeros(1), s) for s in model.samples]
        # Places of words: the bucket's, the frequent ones, and one for all that are unknown.
        self.chance = np.array([np.concatenate([c, model.frequent(s), u]) for c, s, u in zip(chance, model.samples, unknown, strict=True)])
        rarer = _answered(replies, held.reach, known.desks, 1 + samples)
        seen, behind = rarer[:, min(1, samples)], [*rarer[:, 2:].T, rarer[:, 0]]
        # Of contexts: the frequent ones, the rarer ones, and one for all that training never had.
        weight = (model.strength + model.discount * np.array(behind, np.float64)) / (model.strength + seen)
        self.backing = np.concatenate([model.backing(), weight, np.ones((samples, 1))], axis=1)
        seen = np.concatenate([model.seen, seen, [0]])
        word, where = held.at()
        cells = word * len(seen) + where
        own = (samples * held.customers - model.discount * (held.summed + held.tables)) / samples / (model.strength + seen[where])
        order = np.argsort(cells)
        self.cells, self.first = cells[order], own[order]
        counted = held.customers[~held.follows]
        self.counts = np.bincount(held.owner[~held.follows], counted, self.chance.shape[1]).astype(np.int64)

    def probability(self, word: np.ndarray, context: np.ndarray) -> np.ndarray:
        """Of words in contexts, both by place."""
        own = np.zeros(len(word))
        if len(self.cells):
            cell = word * self.backing.shape[1] + context
            at = np.minimum(np.searchsorted(self.cells, cell), len(self.cells) - 1)
            own = np.where(self.cells[at] == cell, self.first[at], 0.0)
        for s in range(len(self.chance)):
            own = own + self.backing[s][context] * self.chance[s][word] / len(self.chance)
        return own


def _frequent(batches: _Rows, model: Model) -> _Rows:
    """Own probabilities of frequent words in frequent contexts that had them."""
    known, samples = model.known, len(model.samples)
    for r in _each(batches):
        held = _Cells(r, known)
        word = held.code[held.owner]
        use = np.flatnonzero((word < known.rare) & (held.context < known.contexts))
        own = (samples * held.customers[use] - model.discount * (held.summed[use] + held.tables[use])) / samples / (model.strength + model.seen[held.context[use]])
        row = (word[use].astype(np.uint16).tobytes(), held.context[use].astype(np.uint16).tobytes(), own.tobytes())
        yield _rows(["word", "context", "own"], [row], [pa.binary()] * 3)


def _matrix(state: DataFrame, model: Model) -> np.ndarray:
    """Log probabilities of the frequent words in all frequent contexts."""
    out = model.backing().T @ np.array([model.frequent(s) for s in model.samples]) / len(model.samples)
    for r in state.mapInArrow(lambda b: _frequent(b, model), "word binary, context binary, own binary").toLocalIterator():
        out[np.frombuffer(r["context"], np.uint16), np.frombuffer(r["word"], np.uint16)] += np.frombuffer(r["own"], np.float64)
    return np.log10(out).astype(np.float32)


#: Kind 2: places of pairs that are not in the matrix, by owner: context and text. Kind 3: the texts
#: of a portion, with sums over their frequent words.
_ASKS = "kind int, bucket int, portion long, a binary, b binary, c binary, d binary, e binary"
_ASK_NAMES = [c.split()[0] for c in _ASKS.split(", ")]
_ASK_TYPES = [pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 5]


def _asks(batches: _Rows, known: Vocabulary, number: int, matrix) -> _Rows:
    part = TaskContext.get().partitionId()
    log_counts = np.log10(known.counts + 1.0)
    for nth, b in enumerate(portions(batches, size=PORTION)):
        portion = part << 32 | nth
        h, bounds = tokens(*strings(b.column(1)))
        sizes = np.diff(bounds)
        text = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        distinct, word, code, previous, before = known.coded(h, bounds)
        hot = code < known.rare
        here = hot if known.shared else hot & (before != known.rare)
        score = np.bincount(text[here], matrix.value[before[here], code[here]].astype(np.float64), len(sizes))
        sums = np.stack([np.bincount(text[hot], minlength=len(sizes)), np.bincount(text[hot], log_counts[code[hot]], len(sizes)), score])
        ids, held = b.column(0), np.asarray(b.column(2)).astype(bool)
        blobs = np.asarray(ids.fill_null(0)).tobytes(), np.asarray(ids.is_null()).tobytes(), held.tobytes(), _small(sizes), sums.tobytes()
        yield _rows(_ASK_NAMES, [(3, portion % number, portion, *blobs)], _ASK_TYPES)
        owner, context = known.dealt(word, code, previous, before)
        ask = np.flatnonzero(~here)
        ask = np.sort(owner[ask] * np.int64(len(h)) + ask) % max(len(h), 1)
        asked = _by_word(distinct[owner[ask]], context[ask], text[ask], distinct[previous[ask]], known, number)
        yield _rows(_ASK_NAMES, [(2, row[0], portion, *row[1:]) for row in asked], _ASK_TYPES)


_ANSWERS = "portion long, kind int, a binary, b binary, c binary, d binary, e binary"
_ANSWER_NAMES = [c.split()[0] for c in _ANSWERS.split(", ")]
_ANSWER_TYPES = [pa.int64(), pa.int32(), *[pa.binary()] * 5]


def _answers(batches: _Rows, model: Model) -> _Rows:
    """For each portion of a bucket: sums over each text's rarer pairs. Rows of texts pass."""
    current, state, replies, asks, size, words_ = None, None, [], [], 0, None
    for r in _each(batches):
        if asks and (r["bucket"] != current or r["kind"] != 2 or size > ASKED):
            words_ = words_ or _Words(model, state, replies)
            yield _told(words_, asks)
            state, replies, asks, size = None, [], [], 0
        if r["bucket"] != current:
            current, state, replies, words_ = r["bucket"], None, [], None
        if r["kind"] == 0:
            state = r
        elif r["kind"] == 1:
            replies.append(r)
        elif r["kind"] == 2:
            asks.append(r)
            size += len(r["c"]) // 2
        else:
            yield _rows(_ANSWER_NAMES, [(r["portion"], 3, *(r[c] for c in "abcde"))], _ANSWER_TYPES)
    if asks:
        yield _told(words_ or _Words(model, state, replies), asks)


def _told(words_: _Words, asks: list[dict]) -> pa.RecordBatch:
    known = words_.model.known
    distinct = [_longs(r["a"]) for r in asks]
    runs = np.concatenate([_wide(r["b"], len(d)) for r, d in zip(asks, distinct, strict=True)])
    contexts = [np.frombuffer(r["c"], np.uint16) for r in asks]
    text = np.concatenate([_wide(r["d"], len(c)) + (k << 32) for k, (r, c) in enumerate(zip(asks, contexts, strict=True))])
    distinct, context = np.concatenate(distinct), np.concatenate(contexts).astype(np.int64)
    owner = np.repeat(np.arange(len(distinct)), runs)
    word, where = words_.held.asked(distinct, owner, context, np.concatenate([_longs(r["e"]) for r in asks]))
    # Frequent words are counted with their texts; here they follow their owners.
    counts = words_.counts[word]
    rows, at = np.unique(text, return_inverse=True)
    sums = [np.bincount(at, x).astype(np.float32) for x in (np.log10(words_.probability(word, where)), np.log10(counts + 1.0))]
    seen = np.bincount(at, counts > 0).astype(np.int64)
    out = [(asks[k]["portion"], 2, _small(rows[i:j] & 0xFFFFFFFF), *(x[i:j].tobytes() for x in sums), _small(seen[i:j]), None) for k, (i, j) in enumerate(_pieces(rows >> 32))]
    return _rows(_ANSWER_NAMES, out, _ANSWER_TYPES)


_SHOWN = "doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double"


def _summed(batches: _Rows) -> _Rows:
    """The texts of each portion with the sums of all their pairs; rows come in order of portions."""
    names = [c.split()[0] for c in _SHOWN.split(", ")]
    for _, rows in _groups(batches, "portion"):
        texts = next(r for r in rows if r["kind"] == 3)
        held = np.frombuffer(texts["c"], bool)
        known, base, score = np.frombuffer(texts["e"], np.float64).reshape(3, -1).copy()
        for r in rows:
            if r["kind"] == 2:
                at = _wide(r["a"], len(r["b"]) // 4)
                score[at] += np.frombuffer(r["b"], np.float32)
                base[at] += np.frombuffer(r["c"], np.float32)
                known[at] += _wide(r["d"], len(at))
        ids = pa.array(np.frombuffer(texts["a"], np.int64), mask=np.frombuffer(texts["b"], bool))
        columns = [ids, pa.array(held), pa.array(_wide(texts["d"], len(held))), pa.array(known.astype(np.int64)), pa.array(base), pa.array(score)]
        yield pa.RecordBatch.from_arrays(columns, names=names)


def language_model_scores(
    docs: DataFrame,
    held_out: Column,
    contexts: int | None = None,
    burn: int = BURN,
    samples: int = SAMPLES,
    strength: float = STRENGTH,
    seed: int = SEED,
    frequent: int = FREQUENT,
) -> DataFrame:
    """Log10 probabilities of all texts under a model of those not held out.

    Every word is a context of its own. ``contexts`` asks for a smaller model, in which only so
    many words are and all rarer ones share one; ``frequent`` only says where work is done.
    Returns ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score,
    perplexity``; ``base_score`` is that of add-one counts without contexts.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.coalesce(held_out, F.lit(False)).alias("held_out"))
    with _batches_of(spark, BATCH):
        known = vocabulary(rows, frequent if contexts is None else contexts, contexts is not None)
        parts = min(int(spark.conf.get("spark.sql.shuffle.partitions")), 32)
        number = max(parts, math.ceil(known.tokens / BUCKET_TOKENS))
        pairs = _in_buckets(rows.mapInArrow(lambda b: _pairs(b, known, number), _PAIRS), number).sortWithinPartitions("bucket")
        cells = stored(pairs.mapInArrow(lambda b: _cells(b, known), _STATE), "lm-cells")
        state, model = train(cells, known, number, burn, samples, strength, seed)
        replies = None if known.shared else stored(_replies(state, known, samples), "lm-replies")

        matrix = spark.sparkContext.broadcast(_matrix(state, model))
        asks = rows.mapInArrow(lambda b: _asks(b, known, number, matrix), _ASKS)
        met = _met(state.drop("behind"), number, replies, asks)
        answers = stored(met.mapInArrow(lambda b: _answers(b, model), _ANSWERS), "lm-answers")
        if replies is not None:
            discard(replies)
    found = answers.repartition(F.col("portion")).sortWithinPartitions("portion").mapInArrow(_summed, _SHOWN)
    smooth = math.log10(known.tokens + known.distinct + 1)
    return found.select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(known.tokens).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * smooth).alias("base_score"),
        "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )


def op12_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents; those with crc32(doc_id) % 7 = 2 are held out."""
    fold = F.crc32(F.col("doc_id").cast("string")) % 7
    return language_model_scores(table(spark, sf_dir, "documents"), fold == 2)
