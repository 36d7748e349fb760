import random
import zlib

import numpy as np
import pytest

from loadstar.llm import tokens as K


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(K.default_tokenizer())
    found.encode_special_tokens = True
    return found


def ids_of(tokenizer, text):
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, K.END_ID], "<u4")


def test_encoder_equals_the_library(tokenizer):
    rng = random.Random(3)
    signs = [" ", " ", "\n", "\t", "a", "b", "é", "1", ".", "'s", "it", "\x1c", "\x1d", "\x85", " ", "<|endoftext|>", "😀", "\r", "ª", "%", "Ā", "ж", "́"]
    texts = ["".join(rng.choices(signs, k=rng.randint(0, 14))) for _ in range(4000)]
    encoder = K.Encoder(K.default_tokenizer())
    want = [np.array(e.ids, encoder.dtype).tobytes() for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert encoder.encode(texts) == want
    assert encoder.encode(texts) == want  # now from memory


def test_files_round_trip(docs, rows, tokenizer):
    folder, manifest = K.write_tokens(docs, K.default_tokenizer())
    got = K.read_tokens(folder, manifest).collect()
    start, want = 0, []
    for i, t, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = ids_of(tokenizer, t)
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want


def test_one_document_is_read_alone(docs, rows, tokenizer):
    folder, manifest = K.write_tokens(docs.where("doc_id = 80"), K.default_tokenizer())
    (part,) = [r for r in manifest.collect() if r.n_docs]
    text = next(t for i, t, _ in rows if i == 80)
    assert K.read_document(folder, part.path, 0).tolist() == ids_of(tokenizer, text).tolist()


def test_another_dictionary_is_refused(docs):
    import pyarrow.fs

    folder, manifest = K.write_tokens(docs.where("doc_id < 5"), K.default_tokenizer())
    fs, base = pyarrow.fs.FileSystem.from_uri(folder)
    with pytest.raises(ValueError):
        K.read_index(fs, manifest.first().path, b"other")


def test_empty_table(no_docs):
    assert K.token_rows(no_docs).count() == 0


def test_rows_without_an_id_are_dealt_over_files_and_tasks(spark, tokenizer):
    texts = [f"text number {i}" for i in range(400)]
    docs = spark.createDataFrame([(None, t) for t in texts] + [(7, t) for t in texts] + [(9, "last")], "doc_id long, text string")
    merging = "spark.sql.adaptive.coalescePartitions.enabled"  # these rows are few enough for one file
    spark.conf.set(merging, "false")
    try:
        folder, manifest = K.write_tokens(docs.repartition(4), K.default_tokenizer())
    finally:
        spark.conf.set(merging, "true")
    assert manifest.where("has_null and n_docs < 400").count() > 1 and manifest.count() > 4
    read = K.read_tokens(folder, manifest)
    assert read.groupBy(K.F.spark_partition_id()).count().count() > 3
    got = sorted(map(tuple, read.collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [None] * 400 + [7] * 400 + [9]
    assert [r[1] for r in got] == np.concatenate([[0], np.cumsum([r[2] for r in got])[:-1]]).tolist()
    want = sorted(zlib.crc32(ids_of(tokenizer, t).tobytes()) for t in texts)
    assert sorted(r[3] for r in got[:400]) == sorted(r[3] for r in got[400:800]) == want
