"""Token files: one zstandard frame per document, one shared dictionary, an offset index.

A dataset is a folder with ``dictionary`` (trained once) and part files. A part file is

    magic, item size, dictionary SHA-256 | frame of document 1 | frame 2 | ... |
    index: doc_id, has_id, frame offset, number of ids, CRC-32 of the ids | footer

The index lets a reader fetch one short document by reading the footer, the index and
that one frame. Ids are little-endian unsigned integers of the item size (2 bytes where
the vocabulary fits, else 4). Part files hold disjoint, ascending ranges of ``doc_id``.

Defined results: a null or empty text is the end id alone. A null ``doc_id`` sorts
first. Repeated rows are written once each, ties of ``doc_id`` by text. Strings of
special tokens inside a text are ordinary text. An empty table gives no part file.
Tasks write files under names of their own and report them in a manifest; a task that
runs again leaves a file nobody names.

The dictionary is fitted on a bounded sample: about ``DICT_DOCS`` documents picked by a
hash of their ids, ``DICT_CHARS`` characters of each. It only affects compression.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loadstar.llm.common import batch, slices, stored, strings, table
from loadstar.sources.session import new_folder

DICT_DOCS, DICT_CHARS, DICT_BYTES = 1000, 4096, 64 << 10
MEMO_SIZE = 500_000
_BLOCK = 1 << 20  # bytes of text encoded at a time
END_ID = 2
MAGIC = b"TOKFRM01"
_HEAD = struct.Struct("<8sI32s")
_FOOT = struct.Struct("<QQ8s")
_INDEX = np.dtype([("doc_id", "<i8"), ("has_id", "u1"), ("offset", "<u8"), ("n", "<u4"), ("crc", "<u4")])

# White space as byte-level tokenizers see it: a run belongs together but for its last
# character, which stands alone unless it is a space before a word; then it is the word's.
_PIECES = re.compile(r"\s+(?!\S)| ?\S+|\s")
_ODD = re.compile("[\x1c-\x1f]")  # white space to this module's regex, not to the library


# Latin letters with punctuation behind them, by far the most common kind of piece: byte-level
# tokenizers split it into the letters and the marks.
_LATIN = re.compile(r"( ?[A-Za-zÀ-ÖØ-öø-ɏ]+)([!-&(-/:-@\[-`{-~]*)")


def _visible() -> dict[int, str]:
    """How byte-level vocabularies spell bytes: printable ones as they are, the rest from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + n) for n, b in enumerate(rest)}


class Encoder:
    """Texts to ids through the tokenizers library, with repeated pieces encoded once.

    Byte-level tokenizers split a text into pieces before merging, and no such piece
    reaches over the cuts of ``_PIECES``. So the ids of a text are those of its parts,
    and the library has to merge each different part only once in a while.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.vocabulary = self.tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2" if self.vocabulary <= 1 << 16 else "<u4")
        self.as_bytes = [i.to_bytes(self.dtype.itemsize, "little") for i in range(self.vocabulary)]
        self.spelling = _visible()
        self.memo: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {}
        self.merge = self.tokenizer.model.tokenize
        # Only a tokenizer that splits the probe as assumed gets the short cuts.
        probe = ["a", " été,", "x", " y..", "Z"]
        expected = [t for p in probe for t in _LATIN.fullmatch(p).groups() if t]
        splits = self.tokenizer.pre_tokenizer.pre_tokenize_str("\n".join(probe)) if self.tokenizer.pre_tokenizer else []
        self.cuts = self.tokenizer.normalizer is None and [t for t, _ in splits if t != self._spelled("\n")] == [*map(self._spelled, expected)]

    def _spelled(self, text: str) -> str:
        return text.encode().decode("latin-1").translate(self.spelling)

    def _ids(self, text: str) -> bytes:
        found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return b"".join(map(self.as_bytes.__getitem__, found[0].ids))

    def _merged(self, split: str) -> bytes:
        table = self.as_bytes
        spelled = split.replace(" ", "Ġ") if split.isascii() else self._spelled(split)
        return b"".join([table[t.id] for t in self.merge(spelled)])

    def _learn(self, piece: str) -> bytes:
        simple = _LATIN.fullmatch(piece)
        if not simple:
            return self._ids(piece)
        word, marks = simple.groups()
        if not marks:
            return self._merged(word)
        if marks not in self.marks:
            self.marks[marks] = self._merged(marks)
        return (self.memo.get(word) or self._merged(word)) + self.marks[marks]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as bytes of the item type."""
        if not self.cuts:
            return [self._ids(t) for t in texts]
        memo = self.memo
        parts = [_PIECES.findall(t) for t in texts]
        new = set().union(*parts).difference(memo)
        memo.update([(x, self._learn(x)) for x in new])
        found = [b"".join(map(memo.__getitem__, p)) for p in parts]
        if len(self.marks) > MEMO_SIZE:
            self.marks.clear()
        if len(memo) > MEMO_SIZE:  # what came first is what is common
            for x in new:
                del memo[x]
        return [self._ids(t) if _ODD.search(t) else f for t, f in zip(texts, found, strict=True)]


@functools.lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def train_dictionary(docs: DataFrame, tokenizer: str) -> bytes:
    """Dictionary bytes fitted on the id arrays of the bounded sample; may be empty."""
    share = max(1, docs.count() // DICT_DOCS)
    sample = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(share)) == 0).select(F.substring("text", 1, DICT_CHARS).alias("t"))
    texts = sorted(r.t for r in sample.limit(2 * DICT_DOCS).collect())
    encoder = Encoder(tokenizer)
    samples = [s for s in encoder.encode(texts) if s] if texts else []
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples).as_bytes()
    except zstandard.ZstdError:  # too little to train on
        return b"".join(samples)[:DICT_BYTES]


def _dictionary(content: bytes) -> zstandard.ZstdCompressionDict | None:
    if not content:
        return None
    found = zstandard.ZstdCompressionDict(content)
    found.precompute_compress(level=1)
    return found


def _write(batches: Iterator[pa.RecordBatch], folder: str, tokenizer: str, content: bytes, end_id: int) -> Iterator[pa.RecordBatch]:
    encoder = _encoder(tokenizer)
    packer = zstandard.ZstdCompressor(level=1, dict_data=_dictionary(content), write_content_size=True)
    end = np.array([end_id], encoder.dtype).tobytes()
    fs, base = pa.fs.FileSystem.from_uri(folder)
    path = f"{base}/part-{uuid.uuid4().hex}.tok"
    out, offset, index = None, _HEAD.size, []
    for b in batches:
        if out is None:
            out = fs.open_output_stream(path)
            out.write(_HEAD.pack(MAGIC, encoder.dtype.itemsize, hashlib.sha256(content).digest()))
        for low, high in slices(strings(b.column(1))[1], _BLOCK):
            found = encoder.encode(b.column(1)[low:high].to_pylist())
            for i, ids in zip(b.column(0)[low:high].to_pylist(), found, strict=True):
                ids += end
                wide = np.frombuffer(ids, encoder.dtype).astype("<u4")
                frame = packer.compress(ids)
                index.append((i or 0, i is not None, offset, len(wide), zlib.crc32(wide.tobytes())))
                out.write(frame)
                offset += len(frame)
    if out is None:
        return
    rows = np.array(index, _INDEX)
    out.write(rows.tobytes())
    out.write(_FOOT.pack(offset, len(rows), MAGIC))
    out.close()
    known = rows["has_id"] == 1
    yield batch(
        _MANIFEST,
        path=[path],
        first_id=[int(rows["doc_id"][known][0]) if known.any() else None],
        part=[TaskContext.get().partitionId()],
        has_null=[bool(not known.all())],
        n_docs=[len(rows)],
        n_tokens=[int(rows["n"].sum(dtype=np.int64))],
    )


_MANIFEST = pa.schema([("path", pa.string()), ("first_id", pa.int64()), ("part", pa.int64()), ("has_null", pa.bool_()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())])


def write_tokens(docs: DataFrame, tokenizer: str, folder: str | None = None, end_id: int = END_ID) -> tuple[str, DataFrame]:
    """Encode ``docs`` (``doc_id, text``) into part files; the folder and its manifest.

    The manifest has one row per part file, with ``start``: the ids in all files before.
    """
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "tokens")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    content = train_dictionary(docs, tokenizer)
    fs, base = pa.fs.FileSystem.from_uri(folder)
    fs.create_dir(base)
    with fs.open_output_stream(f"{base}/dictionary") as out:
        out.write(content)
    # Rows of one id, or of none, may be many: the text's hash cuts them over part files.
    order = [F.col("doc_id"), F.xxhash64("text")]
    rows = docs.repartitionByRange(*order).sortWithinPartitions(*order, "text")
    manifest = rows.mapInArrow(lambda b: _write(b, folder, tokenizer, content, end_id), "path string, first_id long, part long, has_null boolean, n_docs long, n_tokens long")
    manifest = stored(manifest, "tokens-manifest")
    # One row per part file, not per document; partitions are in order of ids.
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    return folder, manifest.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_index(fs: pa.fs.FileSystem, path: str, content: bytes) -> tuple[np.ndarray, int]:
    """The index of a part file and its item size; raises if the dictionary is another."""
    size = fs.get_file_info(path).size
    with fs.open_input_file(path) as f:
        magic, item, digest = _HEAD.unpack(f.read_at(_HEAD.size, 0))
        at, n, tail = _FOOT.unpack(f.read_at(_FOOT.size, size - _FOOT.size))
        if magic != MAGIC or tail != MAGIC or digest != hashlib.sha256(content).digest():
            raise ValueError(f"{path} is not a token file of this dictionary")
        return np.frombuffer(f.read_at(n * _INDEX.itemsize, at), _INDEX), item


def read_document(folder: str, path: str, nth: int) -> np.ndarray:
    """Ids of the ``nth`` document of a part file, reading its frame alone."""
    fs, base = pa.fs.FileSystem.from_uri(folder)
    content = fs.open_input_file(f"{base}/dictionary").read()
    index, item = read_index(fs, path, content)
    with fs.open_input_file(path) as f:
        at = int(index["offset"][nth])
        end = int(index["offset"][nth + 1]) if nth + 1 < len(index) else _last(fs, path)
        frame = f.read_at(end - at, at)
    return np.frombuffer(zstandard.ZstdDecompressor(dict_data=_dictionary(content)).decompress(frame), f"<u{item}")


_READ = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def _read(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    fs, base = pa.fs.FileSystem.from_uri(folder)
    content = fs.open_input_file(f"{base}/dictionary").read()
    unpacker = zstandard.ZstdDecompressor(dict_data=_dictionary(content))
    for b in batches:
        for path, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            index, item = read_index(fs, path, content)
            n = np.zeros(len(index), np.int64)
            crc = np.zeros(len(index), np.int64)
            ends = np.append(index["offset"][1:], _last(fs, path)).astype(np.int64)
            with fs.open_input_stream(path) as f:
                f.read(_HEAD.size)
                for k, size in enumerate(ends - index["offset"].astype(np.int64)):
                    ids = np.frombuffer(unpacker.decompress(f.read(int(size))), f"<u{item}").astype("<u4")
                    n[k], crc[k] = len(ids), zlib.crc32(ids.tobytes())
            if (n != index["n"]).any() or (crc != index["crc"]).any():
                raise ValueError(f"{path} is damaged")
            starts = start + np.concatenate([[0], np.cumsum(n)[:-1]])
            ids = pa.array(index["doc_id"], pa.int64(), mask=index["has_id"] == 0)
            yield batch(_READ, doc_id=ids, start=starts, n_tokens=n, ids_crc32=crc)


def _last(fs: pa.fs.FileSystem, path: str) -> int:
    """Where the last frame ends."""
    size = fs.get_file_info(path).size
    with fs.open_input_file(path) as f:
        return _FOOT.unpack(f.read_at(_FOOT.size, size - _FOOT.size))[0]


def read_tokens(folder: str, manifest: DataFrame) -> DataFrame:
    """Every document of the dataset, decoded: ``doc_id, start, n_tokens, ids_crc32``."""
    # A given number of partitions stays as it is; by size alone these few bytes would be one task.
    files = manifest.select("path", "start").repartition(max(1, manifest.count()), F.col("path"))
    return files.mapInArrow(lambda b: _read(b, folder), "doc_id long, start long, n_tokens long, ids_crc32 long")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def token_rows(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Write the token files of ``docs`` and read them back."""
    return read_tokens(*write_tokens(docs, tokenizer or default_tokenizer()))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places, lengths and checksums of all documents, as read from their token files."""
    return token_rows(table(spark, sf_dir, "documents"))
