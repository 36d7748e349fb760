"""Repeated windows of a corpus: cutting texts into pieces that meet at a common key.

The question is which windows of ``width`` tokens (words, bytes) also start earlier in
the corpus. Each window has a key, the smallest hash among the runs of ``gram`` tokens
inside it, so equal windows have equal keys wherever they stand. Neighbouring windows
mostly share their key; a maximal run of them is a *piece*, about one for every
(width - gram) / 2 tokens. Windows of different keys never have to be compared:

1. ``cut`` lists the pieces of every text (key, content hash, place). Of pieces with
   equal content a task passes on only its first; the others repeat it.
2. Pieces are shuffled by key. Pieces of equal content are one class, whose first
   place stands for all; every other occurrence is covered by it as a whole. A class
   that is alone with its key, and within which nothing can repeat, needs no search.
3. The first occurrences of the remaining classes are fetched from their texts and
   dealt to shards by key. A shard is searched by an index (suffix array, FM-index)
   and returns, for each piece, the windows that start earlier elsewhere.
4. Keys whose pieces exceed a shard are dealt over several. Such shards also return
   what is left in them, one row per different window, and a merge finds the first
   place of each by binary search among the shards' sorted lists.

Everything but steps 3 and 4 moves hashes and places only, and no key's pieces or
text are ever held by one task beyond the size of a shard.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loadstar.llm.common import BYTE_VALUES, batch, mix, portions, prefix_hash, slices, span_hash, stored, strings, word_hashes, words

_BLOCK = 1 << 18  # tokens worked on at a time, so that arrays stay in the cache
_LONGEST = 1 << 20  # windows of one text cut at a time
_ROWS = 1 << 17  # pieces handed on at a time


@dataclass(frozen=True)
class Spec:
    """What a window is, and which earlier occurrences count."""

    unit: str  # "word" or "byte"
    width: int
    gram: int
    same_document: bool  # whether an earlier start in the same document counts
    shard_bytes: int = 2 << 20


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    done, out = 1, x
    while 2 * done <= width:
        out = np.minimum(out[:-done], out[done:])
        done *= 2
    if done < width:
        out = np.minimum(out[: len(x) - width + 1], out[width - done :])
    return out


def cut_tokens(tokens: np.ndarray, bounds: np.ndarray, width: int, gram: int) -> dict[str, np.ndarray]:
    """Pieces of the texts that ``bounds`` delimits in ``tokens``.

    ``row`` (which text), ``start`` (first window, counted in its text), ``n`` (windows),
    ``key``, ``content`` and ``again``: whether a window may occur twice in the piece.
    """
    none = np.zeros(0, np.int64)
    if len(tokens) < width:
        return dict(row=none, start=none, n=none, key=none, content=none, again=np.zeros(0, bool))
    prefix = prefix_hash(tokens)
    grams = span_hash(prefix, slice(0, len(tokens) - gram + 1), slice(gram, None))
    span = width - gram + 1
    low = sliding_min(grams, span)
    n = len(low)
    # A window counts if it ends inside the text it starts in.
    edge = np.zeros(n + 1, np.int8)
    begin, last = bounds[:-1], bounds[1:] - width + 1
    full = last > begin
    edge[begin[full]] += 1
    np.subtract.at(edge, last[full], 1)
    valid = np.cumsum(edge[:n], dtype=np.int8) > 0
    change = np.empty(n, bool)
    change[0] = True
    np.not_equal(low[1:], low[:-1], out=change[1:])
    change[1:] |= ~valid[:-1]
    first = np.flatnonzero(change & valid)
    stops = np.empty(n, bool)
    stops[-1] = True
    stops[:-1] = change[1:] | ~valid[1:]
    end = np.flatnonzero(stops & valid) + 1
    # A run of equal windows needs its smallest gram twice: one leaves or enters meanwhile.
    stay = ~change[1:]
    twice = np.flatnonzero(((grams[: n - 1] == low[:-1]) & stay) | ((grams[span : span + n - 1] == low[1:]) & stay))
    again = np.zeros(len(first), bool)
    at = np.searchsorted(first, twice, side="right") - 1
    at = at[(at >= 0) & (twice < end[np.maximum(at, 0)])]
    again[at] = True
    row = np.searchsorted(bounds, first, side="right") - 1
    content = span_hash(prefix, first, end + width - 1)
    return dict(row=row, start=first - bounds[row], n=end - first, key=low[first].view(np.int64), content=content.view(np.int64), again=again)


def tokens_of(unit: str, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray | None, np.ndarray | None]:
    """Hash of each token, the texts' bounds in tokens, and of words the first byte and the end."""
    if unit == "byte":
        return BYTE_VALUES[data], offsets, None, None
    starts, ends, bounds = words(data, offsets)
    return word_hashes(data, starts, ends), bounds, starts, ends


_PIECES = pa.schema([("key", pa.int64()), ("content", pa.int64()), ("doc_id", pa.int64()), ("row", pa.int64()), ("start", pa.int64()), ("n", pa.int64()), ("again", pa.bool_())])
_PIECES_DDL = "key long, content long, doc_id long, row long, start long, n long, again boolean"


def _cut_block(ids: np.ndarray, rows: np.ndarray, tokens: np.ndarray, bounds: np.ndarray, spec: Spec) -> dict[str, np.ndarray]:
    parts = []
    for low, high in slices(bounds, _BLOCK):
        begin, end = bounds[low], bounds[high]
        # A very long text goes in overlapping parts; a piece may then end earlier, which is all right.
        for at in range(begin, max(end, begin + 1), _LONGEST) if high == low + 1 else [begin]:
            stop = min(at + _LONGEST + spec.width - 1, end) if high == low + 1 else end
            inner = np.clip(bounds[low : high + 1], at, stop) - at
            found = cut_tokens(tokens[at:stop], inner, spec.width, spec.gram)
            if high == low + 1:
                found["start"] += at - begin
            found["row"] += low
            parts.append(found)
    if not parts:
        parts = [cut_tokens(np.zeros(0, np.uint64), np.zeros(1, np.int64), spec.width, spec.gram)]
    out = {k: np.concatenate([p[k] for p in parts]) for k in parts[0]}
    out["doc_id"], out["row"] = ids[out["row"]], rows[out["row"]]
    return out


def _cut(batches: Iterator[pa.RecordBatch], spec: Spec) -> Iterator[pa.RecordBatch]:
    for b in batches:
        parts = []
        for small in portions([b]):
            data, offsets = strings(small.column(1))
            tokens, bounds = tokens_of(spec.unit, data, offsets)[:2]
            ids, rows = (small.column(i).to_numpy(zero_copy_only=False) for i in (0, 2))
            parts.append(_cut_block(ids, rows, tokens, bounds, spec))
        found = {k: np.concatenate([p[k] for p in parts]) for k in parts[0]} if parts else {}
        if not found or not len(found["key"]):
            continue
        # Of equal contents only the first place of this batch has to meet the others.
        same = mix(found["key"].view(np.uint64)) ^ found["content"].view(np.uint64)
        order = np.lexsort((found["start"], found["row"], found["doc_id"], same))
        same = same[order]
        new = np.concatenate([[True], same[1:] != same[:-1]])
        head = order[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
        later = (found["doc_id"][order] != found["doc_id"][head]) | (found["row"][order] != found["row"][head])
        if spec.same_document:
            later |= found["start"][order] != found["start"][head]
        for low in range(0, len(order), _ROWS):
            part = order[low : low + _ROWS]
            key = pa.array(found["key"][part], pa.int64(), mask=later[low : low + _ROWS])
            yield batch(_PIECES, key=key, **{k: v[part] for k, v in found.items() if k != "key"})


def pieces(docs: DataFrame, spec: Spec) -> DataFrame:
    """All pieces of ``docs`` (``doc_id, text, row``). A null ``key``: repeats an earlier piece."""
    return docs.mapInArrow(lambda b: _cut(b, spec), _PIECES_DDL)


def resolve(found: DataFrame, spec: Spec) -> DataFrame:
    """Pieces that repeat, and pieces to search.

    ``doc_id, row, start, n, covered``; where not ``covered`` also ``key`` and ``key_tokens``,
    the size of all different pieces of that key.
    """
    met = found.where("key is not null")
    same = W.partitionBy("key", "content").orderBy("doc_id", "row", "start")
    if spec.same_document:
        met = met.withColumn("covered", F.rank().over(same) > 1)
    else:
        met = met.withColumn("covered", F.first(F.struct("doc_id", "row")).over(same) < F.struct("doc_id", "row"))
    key = W.partitionBy("key")
    size = F.when(~F.col("covered"), F.col("n") + spec.width - 1).otherwise(0)
    met = met.withColumn("lone", F.min("content").over(key) == F.max("content").over(key))
    met = met.withColumn("key_again", F.max("again").over(key)).withColumn("key_tokens", F.sum(size).over(key))
    met = met.where("covered or not lone or key_again").select("doc_id", "row", "start", "n", "covered", "key", "key_tokens")
    local = found.where("key is null").select("doc_id", "row", "start", "n", F.lit(True).alias("covered"), "key", F.lit(None).cast("long").alias("key_tokens"))
    return met.unionByName(local)


_WANTED = pa.schema([("key", pa.int64()), ("key_tokens", pa.int64()), ("doc_id", pa.int64()), ("row", pa.int64()), ("start", pa.int64()), ("content", pa.binary())])


def _fetch(batches: Iterator[pa.RecordBatch], spec: Spec) -> Iterator[pa.RecordBatch]:
    """Cut the wanted pieces out of their texts."""
    for b in portions(batches, column=0):
        data, offsets = strings(b.column(0))
        raw = data.tobytes()
        _, bounds, begin, end = tokens_of(spec.unit, data, offsets) if spec.unit == "word" else (None, offsets, None, None)
        wanted = b.column(1)
        rows = np.repeat(np.arange(len(b)), np.diff(np.asarray(wanted.offsets)))
        flat = wanted.flatten()
        start, n = flat.field("start").to_numpy(), flat.field("n").to_numpy()
        low = bounds[rows] + start
        high = low + n + spec.width - 1
        if spec.unit == "word":
            low, high = begin[low], end[high - 1]
        content = pa.array([raw[i:j] for i, j in zip(low.tolist(), high.tolist(), strict=True)], pa.binary())
        yield batch(_WANTED, key=flat.field("key"), key_tokens=flat.field("key_tokens"), doc_id=flat.field("doc_id"), row=flat.field("row"), start=start, content=content)


def _shard(spec: Spec, shards: int) -> F.Column:
    """The shard of a piece: by key, and by place too for keys larger than a shard."""
    salts = F.greatest(F.lit(1), F.ceil(F.col("key_tokens") * F.lit(_token_bytes(spec) / spec.shard_bytes)))
    salt = F.pmod(F.xxhash64("doc_id", "row", "start"), salts)
    return F.pmod(F.xxhash64("key", F.when(salts > 1, salt).otherwise(0)), F.lit(shards))


def _token_bytes(spec: Spec) -> int:
    return 7 if spec.unit == "word" else 1


Search = Callable[[list[bytes], np.ndarray, np.ndarray, Spec], tuple[np.ndarray, np.ndarray, np.ndarray]]
_MARKS = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("start", pa.int64()), ("n", pa.int64()), ("window", pa.int64()), ("key", pa.int64())])
_MARKS_DDL = "doc_id long, row long, start long, n long, window long, key long"


def _runs(owner: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Consecutive places of one owner as (owner, first, number)."""
    if not len(at):
        return owner, at, at
    new = np.concatenate([[True], (owner[1:] != owner[:-1]) | (at[1:] != at[:-1] + 1)])
    first = np.flatnonzero(new)
    return owner[first], at[first], np.diff(np.append(first, len(at)))


def _rank(ids: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Number of each (id, row) in their order; equal ones are neighbours and share it."""
    new = np.zeros(len(ids), np.int64)
    new[1:] = (ids[1:] != ids[:-1]) | (rows[1:] != rows[:-1])
    return np.cumsum(new)


def _search(table: pa.Table, spec: Spec, search: Search) -> pa.Table:
    """Search one shard: windows that start earlier, and of large keys those left."""
    table = table.sort_by([("doc_id", "ascending"), ("row", "ascending"), ("start", "ascending")])
    contents = table["content"].to_pylist()
    ids, rows, start = (table[c].to_numpy() for c in ("doc_id", "row", "start"))
    piece, offset, repeats = search(contents, _rank(ids, rows), start, spec)
    hit = repeats.astype(bool)
    owner, at, n = _runs(piece[hit], offset[hit])
    out = [batch(_MARKS, doc_id=ids[owner], row=rows[owner], start=start[owner] + at, n=n, window=pa.nulls(len(n), pa.int64()), key=pa.nulls(len(n), pa.int64()))]
    large = table["key_tokens"].to_numpy() * _token_bytes(spec) > spec.shard_bytes
    left = ~hit & large[piece]
    if left.any():
        owner, at = piece[left], offset[left]
        hashes = np.zeros(len(owner), np.uint64)
        for p in np.unique(owner):
            data = np.frombuffer(contents[p], np.uint8)
            tokens = tokens_of(spec.unit, data, np.array([0, len(data)]))[0]
            mine = owner == p
            hashes[mine] = span_hash(prefix_hash(tokens), at[mine], at[mine] + spec.width)
        out.append(batch(_MARKS, doc_id=ids[owner], row=rows[owner], start=start[owner] + at, n=np.ones(len(owner), np.int64), window=hashes.view(np.int64), key=table["key"].to_numpy()[owner]))
    return pa.Table.from_batches(out)


def _merge(table: pa.Table, spec: Spec) -> pa.Table:
    """Windows that several shards had left: all but the first place of each.

    The places of one shard's list are looked up in the sorted list of all.
    """
    docs, rows, start = (table[c].to_numpy() for c in ("doc_id", "row", "start"))
    place = np.lexsort((rows, docs))
    ids = np.empty(len(place), np.int64)
    ids[place] = _rank(docs[place], rows[place])
    window = mix(table["window"].to_numpy().view(np.uint64)) ^ table["key"].to_numpy().view(np.uint64)
    order = np.lexsort((start, ids, window))
    ordered = window[order]
    first = order[np.searchsorted(ordered, window)]
    later = ids != ids[first]
    if spec.same_document:
        later |= start != start[first]
    at = np.flatnonzero(later)
    at = at[np.lexsort((start[at], ids[at]))]
    owner, begin, n = _runs(ids[at], start[at])
    none = pa.nulls(len(n), pa.int64())
    one = np.searchsorted(ids[place], owner)
    return pa.Table.from_batches([batch(_MARKS, doc_id=docs[place[one]], row=rows[place[one]], start=begin, n=n, window=none, key=none)])


LAST_ID = (1 << 63) - 1


def places(docs: DataFrame) -> DataFrame:
    """``doc_id, text, row`` without nulls. Rows of equal id and text are one place, other
    texts of an id have a ``row`` (a hash) of their own, which also puts them in order."""
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.withColumn("row", F.xxhash64("text"))


def repeated_windows(docs: DataFrame, spec: Spec, search: Search) -> DataFrame:
    """``doc_id, row, start, n``: ranges of windows that start earlier in the corpus.

    ``docs`` has ``doc_id``, ``text`` and ``row`` (see :func:`places`) without nulls.
    """
    links = stored(resolve(pieces(docs, spec), spec), "pieces")
    wanted = links.where("not covered")
    total = wanted.agg(F.sum(F.col("n") + spec.width - 1)).first()[0] or 0
    shards = max(1, -(-total * _token_bytes(spec) // spec.shard_bytes))
    per_doc = wanted.groupBy("doc_id", "row").agg(F.collect_list(F.struct("key", "key_tokens", "doc_id", "row", "start", "n")).alias("wanted"))
    per_doc = per_doc.withColumnsRenamed({"doc_id": "_id", "row": "_row"})
    texts = docs.join(per_doc, (F.col("doc_id") == F.col("_id")) & (F.col("row") == F.col("_row"))).select("text", "wanted")
    found = texts.mapInArrow(lambda b: _fetch(b, spec), "key long, key_tokens long, doc_id long, row long, start long, content binary")
    found = found.withColumn("shard", _shard(spec, shards))
    marks = found.groupBy("shard").applyInArrow(lambda t: _search(t, spec, search), _MARKS_DDL)
    marks = stored(marks, "marks")
    done = links.where("covered").select("doc_id", "row", "start", "n").unionByName(marks.where("window is null").select("doc_id", "row", "start", "n"))
    open_windows = marks.where("window is not null")
    n_open = open_windows.count()
    if n_open:
        parts = max(1, n_open // 500_000)
        open_windows = open_windows.withColumn("part", F.pmod(F.xxhash64("window", "key"), F.lit(parts)))
        merged = open_windows.groupBy("part").applyInArrow(lambda t: _merge(t, spec), _MARKS_DDL)
        done = done.unionByName(merged.select("doc_id", "row", "start", "n"))
    return done


def removed_by_document(docs: DataFrame, ranges: DataFrame) -> DataFrame:
    """``docs`` with the list ``ranges`` of (start, n) of each, null where there is none."""
    per_doc = ranges.groupBy(F.col("doc_id").alias("_id"), F.col("row").alias("_row")).agg(F.collect_list(F.struct("start", "n")).alias("ranges"))
    return docs.join(per_doc, (F.col("doc_id") == F.col("_id")) & (F.col("row") == F.col("_row")), "left").select("doc_id", "text", "ranges")


def covered_tokens(ranges: pa.Array, bounds: np.ndarray, width: int) -> np.ndarray:
    """True for every token that a window of its text's ranges covers."""
    n = int(bounds[-1])
    edge = np.zeros(n + 1, np.int32)
    counts = np.diff(np.asarray(ranges.offsets))
    if ranges.null_count:
        counts = np.where(np.asarray(ranges.is_valid()), counts, 0)
    flat = ranges.flatten()
    begin = np.repeat(bounds[:-1], counts) + flat.field("start").to_numpy()
    np.add.at(edge, begin, 1)
    np.subtract.at(edge, begin + flat.field("n").to_numpy() + width - 1, 1)
    return np.cumsum(edge[:n]) > 0
