"""SimHash near-duplicates: fingerprints, and all links within three bits.

A fingerprint has a bit for each of 64 majority votes over the XXH64 hashes of a text's
word shingles. Links are found by meeting in the middle: fingerprints emit variants of
themselves within half the radius, variants are shuffled, and fingerprints that meet at
a variant are verified. The radius is 3, so one side has to reach 1 bit and the other
2. Which side does what follows from parity, which differs exactly at odd distances:

* even fingerprints emit the 64 variants at one bit;
* odd fingerprints emit themselves, the 64 at one bit, and at two bits those whose bits
  lie in the same half. Of three bits two always share a half, so this suffices.

That is 561 variants on average in place of 2081, and no pair within three bits is
lost: distance 1 meets at the odd one, 2 at a one-bit variant or (both odd, same half)
at the fingerprint itself, 3 at a two-bit variant of the odd side.

Variants travel packed, 8 bytes each: a one-to-one mix of the variant gives a bucket
(its top bits) and the rest, which shares a 64-bit entry with the number of the flip.
Fingerprints that meet are linked to the nearest of them, or along a common flipped
bit where all are two away, so the links of a meeting grow with its members, not with
their pairs.

Defined results: null and empty texts have fingerprint zero, which links like any
other. Null ids take part and are never the smallest of a component unless alone.
Repeated rows are returned each. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadstar.llm.common import batch, mix, portions, stored, strings, table, words
from loadstar.llm.components import components
from loadstar.llm.xxh64 import xxh64

RADIUS = 3
SHINGLE = 3
_BLOCK = 1 << 20
_CHUNK = 4096  # fingerprints whose variants a task holds at a time
_CODE_BITS = 11
BUCKET_BYTES = 4 << 20  # packed variants a bucket should hold
EMIT_BYTES = 32 << 20  # packed variants a task should emit

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPREAD = np.uint64(0x0101010101010101)


def _majority(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each range of hashes, the bits set in over half of them."""
    n = np.diff(first)
    out = np.zeros(len(n), np.uint64)
    rows = np.flatnonzero(n)
    if not len(rows):
        return out
    # Byte counters hold up to 255 votes, so ranges are first summed in blocks of that.
    blocks = -(-n[rows] // 255)
    begin = np.concatenate([[0], np.cumsum(blocks)])
    nth = np.arange(begin[-1]) - np.repeat(begin[:-1], blocks)
    at = np.repeat(first[:-1][rows], blocks) + 255 * nth
    for j in range(8):
        votes = np.add.reduceat((h >> np.uint64(j)) & _SPREAD, at).astype("<u8")
        counts = np.add.reduceat(votes.view(np.uint8).reshape(-1, 8).astype(np.int64), begin[:-1], axis=0)
        over = 2 * counts > n[rows][:, None]
        for byte in range(8):
            out[rows] |= over[:, byte].astype(np.uint64) << np.uint64(8 * byte + j)
    return out


def fingerprints(data: np.ndarray, offsets: np.ndarray, shingle: int = SHINGLE) -> np.ndarray:
    """Fingerprints of the texts between ``offsets``."""
    data = _LOWER[data]
    starts, ends, first = words(data, offsets)
    size = ends - starts
    # Words joined by one space each, so that every shingle is one range of bytes.
    at = np.concatenate([[0], np.cumsum(size + 1)])
    joined = np.full(at[-1] if len(size) else 0, 32, np.uint8)
    begin = at[:-1]
    place = np.arange(size.sum()) + np.repeat(np.arange(len(size)), size)
    source = np.arange(size.sum()) + np.repeat(starts - np.concatenate([[0], np.cumsum(size)[:-1]]), size) if len(size) else np.zeros(0, np.int64)
    joined[place] = data[source]
    n_words = np.diff(first)
    n = np.where(n_words >= shingle, n_words - shingle + 1, np.minimum(n_words, 1))
    bounds = np.concatenate([[0], np.cumsum(n)])
    nth = np.arange(bounds[-1]) - np.repeat(bounds[:-1], n)
    low = np.repeat(first[:-1], n) + nth
    last = low + np.repeat(np.minimum(n_words, shingle), n) - 1
    h = xxh64(joined, begin[low], begin[last] + size[last]) if len(low) else np.zeros(0, np.uint64)
    return _majority(h, bounds)


def _prints(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    """All columns but the text, and the fingerprint."""
    for b in portions(batches, size=_BLOCK):
        found = fingerprints(*strings(b.column(1)), shingle)
        names = [n for n in b.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), pa.array(found.view(np.int64))], names=[*names, "fp"])


def simhash(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id`` and fingerprint ``fp`` (as a signed long) of every document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(lambda b: _prints(b, shingle), "doc_id long, fp long")


def _flips() -> np.ndarray:
    """Flip number to bit mask: 0 none, then one bit, then two bits of the same half."""
    one = [1 << i for i in range(64)]
    two = [1 << i | 1 << j for h in (0, 32) for i in range(h, h + 32) for j in range(i + 1, h + 32)]
    return np.array([0, *one, *two], np.uint64)


FLIPS = _flips()
_EVEN = np.arange(1, 65)


def _odd(fp: np.ndarray) -> np.ndarray:
    return np.bitwise_count(fp) & 1 == 1


def _unshift(x: np.ndarray, n: int) -> np.ndarray:
    """Inverse of ``x ^ (x >> n)``."""
    out = x.copy()
    for k in range(n, 64, n):
        out ^= x >> np.uint64(k)
    return out


_INV1 = np.uint64(pow(0xBF58476D1CE4E5B9, -1, 1 << 64))
_INV2 = np.uint64(pow(0x94D049BB133111EB, -1, 1 << 64))


def unmix(x: np.ndarray) -> np.ndarray:
    """Inverse of ``common.mix``."""
    return _unshift(_unshift(_unshift(x, 31) * _INV2, 27) * _INV1, 30)


def _packed(fp: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and entry of every variant the fingerprints emit."""
    odd = _odd(fp)
    masks = [(fp[odd][:, None] ^ FLIPS[None, :], np.arange(len(FLIPS))), (fp[~odd][:, None] ^ FLIPS[_EVEN][None, :], _EVEN)]
    variant = np.concatenate([m.ravel() for m, _ in masks])
    code = np.concatenate([np.broadcast_to(c, m.shape).ravel() for m, c in masks]).astype(np.uint64)
    mixed = mix(variant)
    bucket = (mixed >> np.uint64(64 - bits)).astype(np.int64)
    return bucket, (mixed << np.uint64(bits)) | code


_VARIANTS = pa.schema([("bucket", pa.int64()), ("entries", pa.binary())])


def _emit(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        fps = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        for k in range(0, len(fps), _CHUNK):
            bucket, entry = _packed(fps[k : k + _CHUNK], bits)
            order = np.argsort(bucket.astype(np.uint16) if bits <= 16 else bucket, kind="stable")
            bucket, entry = bucket[order], entry[order]
            cuts = np.flatnonzero(np.diff(bucket)) + 1
            begin = np.concatenate([[0], cuts])
            sizes = 8 * np.concatenate([begin, [len(entry)]]).astype(np.int32)
            blobs = pa.BinaryArray.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(sizes.tobytes()), pa.py_buffer(entry.tobytes())])
            yield pa.RecordBatch.from_arrays([pa.array(bucket[begin], pa.int64()), blobs], schema=_VARIANTS)


def meetings(bucket: int, entry: np.ndarray, bits: int, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Verified links among the fingerprints whose variants met in a bucket."""
    entry = np.sort(entry)
    key = entry >> np.uint64(_CODE_BITS)
    same = key[1:] == key[:-1]
    in_group = np.concatenate([same, [False]]) | np.concatenate([[False], same])
    entry, key = entry[in_group], key[in_group]
    if not len(entry):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    # The entry's upper bits are the mixed variant without the bucket's bits.
    mixed = (np.uint64(bucket) << np.uint64(64 - bits)) | ((entry >> np.uint64(_CODE_BITS)) << np.uint64(_CODE_BITS) >> np.uint64(bits))
    code = (entry & np.uint64((1 << _CODE_BITS) - 1)).astype(np.int64)
    fp = unmix(mixed) ^ FLIPS[code]
    new = np.concatenate([[True], key[1:] != key[:-1]])
    head = np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))
    near = code[head] <= 64  # entries are in order of distance within a group
    pairs = [(fp[head[near]], fp[near])]
    far = np.flatnonzero(~near)
    if len(far):
        mask = FLIPS[code[far]]
        low = np.bitwise_count((mask & (~mask + np.uint64(1))) - np.uint64(1)).astype(np.int64)
        high = 63 - np.bitwise_count(~(mask - np.uint64(1) | mask)).astype(np.int64)
        member, bit = np.concatenate([far, far]), np.concatenate([low, high])
        order = np.lexsort((bit, head[member]))
        member, bit = member[order], bit[order]
        chain = (bit[1:] == bit[:-1]) & (head[member[1:]] == head[member[:-1]])
        pairs.append((fp[member[:-1][chain]], fp[member[1:][chain]]))
    a, b = (np.concatenate(x) for x in zip(*pairs, strict=True))
    ok = (a != b) & (np.bitwise_count(a ^ b) <= radius)
    return a[ok], b[ok]


_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _meet(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Rows come in order of buckets; one bucket is held at a time."""
    current, blobs = None, []

    def links() -> pa.RecordBatch:
        a, b = meetings(current, np.frombuffer(b"".join(blobs), np.uint64), bits)
        return batch(_LINKS, a=a.view(np.int64), b=b.view(np.int64))

    for b in batches:
        for bucket, blob in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            if bucket != current:
                if blobs:
                    yield links()
                current, blobs = bucket, []
            blobs.append(blob)
    if blobs:
        yield links()


def links(prints: DataFrame) -> DataFrame:
    """Links ``a, b`` between distinct fingerprints of the column ``fp``, enough of them
    to connect all that are within three bits."""
    n = prints.count()
    emitted = n * (len(FLIPS) + len(_EVEN)) / 2 * 8
    bits = min(40, max(_CODE_BITS, math.ceil(math.log2(max(1, emitted / BUCKET_BYTES)))))
    # The variants are many times the fingerprints, so the tasks that emit them are set by their size.
    tasks = max(int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(emitted / EMIT_BYTES))
    variants = prints.select("fp").repartition(tasks, F.col("fp")).mapInArrow(lambda b: _emit(b, bits), "bucket long, entries binary")
    variants = variants.repartition(F.col("bucket")).sortWithinPartitions("bucket")
    return variants.mapInArrow(lambda b: _meet(b, bits), "a long, b long").distinct()


def _roots(prints: DataFrame) -> DataFrame:
    """``fp, root`` for every fingerprint: the smallest fingerprint that links lead to."""
    distinct = stored(prints.select("fp").distinct(), "simhash-prints")
    found = components(links(distinct))
    return distinct.join(found.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, fp, component_id``: the smallest id that links lead to, its own included."""
    rows = stored(simhash(docs, shingle), "simhash")
    first = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-firsts")
    labels = stored(first.join(_roots(first), "fp"), "simhash-roots")
    least = labels.groupBy("root").agg(F.min("first_id").alias("component_id"))
    labels = labels.join(least, "root").select("fp", "component_id")
    return rows.join(labels, "fp").select("doc_id", "fp", F.coalesce("component_id", "doc_id").alias("component_id"))


def _row_key(docs: DataFrame) -> Column:
    """128 bits of a digest of the whole row."""
    return F.substring(F.unhex(F.sha2(F.to_json(F.struct(*docs.columns)), 256)), 1, 16)


def keep_one(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """One document of each group of linked fingerprints, with all columns.

    It is the document with the smallest id; rows without an id come last, and of rows
    with the same id the one with the smallest digest stays, so a rerun keeps the same rows.
    Rows are told apart by a digest of all their columns; of rows equal in every column one stays.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), _row_key(docs).alias("key"))
    prints = stored(rows.mapInArrow(lambda b: _prints(b, shingle), "doc_id long, key binary, fp long"), "simhash-rows")
    members = prints.join(_roots(prints), "fp").groupBy("root", "doc_id", "key").agg(F.count("*").alias("n"))
    members = stored(members, "simhash-members")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    first = members.groupBy("root").agg(F.min(order).alias("first"))
    # Few rows go and fewer repeat, so these lists are what the texts are joined with.
    marked = members.join(first, "root").where("key <> first.key or n > 1")
    marked = stored(marked.select(F.col("key").alias("_key"), (F.col("key") == F.col("first.key")).alias("_repeated")), "simhash-gone")
    keyed = docs.withColumn("_row_key", _row_key(docs))
    kept = keyed.join(marked, F.col("_row_key") == F.col("_key"), "left_anti")
    repeated = marked.where("_repeated")
    if not repeated.isEmpty():
        kept = kept.unionAll(keyed.join(repeated, F.col("_row_key") == F.col("_key"), "left_semi").dropDuplicates(["_row_key"]))
    return kept.select(*docs.columns)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints and components of all documents."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
