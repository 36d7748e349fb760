"""Removal of repeated word windows and byte strings, and the indexes it works with."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from loadstar.llm import fm_dedup, suffix_dedup
from loadstar.llm.passages import Spec, cut_tokens, sliding_min
from loadstar.llm.suffix import common_prefixes, joined, suffix_array
from tests.llm import brute
from tests.llm.conftest import prose


def texts(seed):
    """Byte strings with much repetition."""
    rng = random.Random(seed)
    alphabet = b"ab" if seed % 2 else b"abcdefgh"
    base = [bytes(rng.choices(alphabet, k=rng.randint(0, 60))) for _ in range(4)]
    return [b"".join(rng.choice(base)[rng.randint(0, 10) :] for _ in range(rng.randint(0, 4))) for _ in range(rng.randint(1, 8))]


def suffix(seq, i):
    end = i + int(np.argmax(seq[i:] == 0))
    return (*seq[i:end].tolist(), end - len(seq))


@pytest.mark.parametrize("seed", range(8))
def test_suffix_array_and_common_prefixes(seed):
    seq, _ = joined([np.frombuffer(t, np.uint8).astype(np.int32) + 1 for t in texts(seed)])
    order = suffix_array(seq, 9)
    assert order.tolist() == sorted(range(len(seq)), key=lambda i: suffix(seq, i))
    lcp = common_prefixes(seq, order, 9, 12)
    for r in range(1, len(order)):
        a, b = suffix(seq, order[r - 1])[:-1], suffix(seq, order[r])[:-1]
        common = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        assert lcp[r] == min(common, 12)


@pytest.mark.parametrize("seed", range(8))
def test_suffix_search_finds_earlier_windows(seed):
    parts, width = texts(seed), 5
    ids = np.arange(len(parts)) // 2
    piece, offset, hit = suffix_dedup.search(parts, ids, np.arange(len(parts)) * 1000, Spec("byte", width, 2, True))
    seen, want = set(), []
    for i, p in enumerate(parts):
        for j in range(len(p) - width + 1):
            want.append((i, j, p[j : j + width] in seen))
            seen.add(p[j : j + width])
    assert list(zip(piece.tolist(), offset.tolist(), hit.tolist(), strict=True)) == want


@pytest.mark.parametrize("seed", range(8))
def test_matching_statistics(seed):
    rng = random.Random(seed)
    corpus = [[rng.randint(1, 2 + seed % 4) for _ in range(rng.randint(1, 40))] for _ in range(5)]
    seq, _ = joined([np.array(c) for c in corpus])
    index = fm_dedup.FMIndex(seq, depth := 6)
    held = {tuple(c[i:j]) for c in corpus for i in range(len(c)) for j in range(i + 1, min(len(c), i + depth) + 1)}
    streams = [[rng.randint(0, 7) for _ in range(rng.randint(0, 30))] for _ in range(4)] + corpus[:1]
    bounds = np.cumsum([0, *map(len, streams)])
    length, row = index.matching_statistics(np.array(sum(streams, []), np.int64), bounds)
    for k, s in enumerate(streams):
        for j in range(len(s)):
            most = max((m for m in range(1, min(depth, len(s) - j) + 1) if tuple(s[j : j + m]) in held), default=0)
            assert length[bounds[k] + j] == most
            at = index.order[row[bounds[k] + j]]
            assert seq[at : at + most].tolist() == s[j : j + most]


def test_wavelet_tree_ranks():
    rng = np.random.default_rng(5)
    seq = rng.integers(0, 37, 500)
    tree = fm_dedup.WaveletTree(seq, 6)
    symbol, at = rng.integers(0, 37, 300), rng.integers(0, 501, 300)
    assert tree.rank(symbol, at).tolist() == [int((seq[:a] == s).sum()) for s, a in zip(symbol, at, strict=True)]


def test_sliding_min():
    x = np.random.default_rng(6).integers(0, 100, 50)
    for w in (1, 2, 3, 7, 16, 50):
        assert sliding_min(x, w).tolist() == [x[i : i + w].min() for i in range(51 - w)]


def test_pieces_cover_every_window_once():
    rng = np.random.default_rng(8)
    tokens = rng.integers(1, 4, 400).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    bounds = np.array([0, 3, 150, 150, 158, 400])
    cut = cut_tokens(tokens, bounds, 9, 3)
    covered = [(int(r), int(s) + k) for r, s, n in zip(cut["row"], cut["start"], cut["n"], strict=True) for k in range(n)]
    assert covered == [(r, j) for r in range(5) for j in range(bounds[r + 1] - bounds[r] - 8)]
    by_window = {}
    for r, s, n, key in zip(cut["row"], cut["start"], cut["n"], cut["key"], strict=True):
        for k in range(n):
            w = tokens[bounds[r] + s + k :][:9].tobytes()
            assert by_window.setdefault(w, key) == key


# A shard of 1500 bytes splits common keys, so lists of several shards are merged.
@pytest.mark.parametrize("width, gram, shard", [(50, 12, 4 << 20), (12, 4, 1500)])
def test_words(docs, rows, width, gram, shard):
    got = fm_dedup.remove_repeats(docs, width, gram, shard_bytes=shard).collect()
    assert len(got) == len(rows)
    want = brute.repeated_words([(i, t) for i, t, _ in rows], width)
    for r in got:
        w, gone = want[r.doc_id]
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        assert (r.n_words, r.n_removed, r.kept.encode()) == (len(w), sum(gone), kept), r.doc_id
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize("width, gram, shard", [(100, 24, 4 << 20), (20, 6, 1500)])
def test_bytes(docs, rows, width, gram, shard):
    got = suffix_dedup.remove_repeats(docs, width, gram, shard_bytes=shard).collect()
    assert len(got) == len(rows)
    want = brute.repeated_bytes([(i, t) for i, t, _ in rows], width)
    for r in got:
        b, gone = want[r.doc_id]
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        assert (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) == (len(b), sum(gone), brute.spans(gone), kept), r.doc_id
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize("shard", [4 << 20, 400])
def test_texts_that_share_an_id_or_have_none(spark, shard):
    rng = random.Random(14)
    shared = [prose(rng, 30).replace("\n", " ") for _ in range(3)]
    docs = []
    for i in [None] * 6 + [7, 7, 7, 8, 9, 9]:
        docs.append((i, " ".join([prose(rng, rng.randint(0, 40)), rng.choice(shared), prose(rng, rng.randint(0, 200))])))
    docs += [docs[0], docs[6], (7, ""), (None, "short"), (7, "short"), (10, prose(rng, 100))]
    df = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    order = {(r.doc_id, r.text): r.h for r in df.select("doc_id", "text", F.xxhash64("text").alias("h")).collect()}
    place = sorted(order, key=lambda d: (d[0] is None, d[0] or 0, order[d]))
    ranked = [(n, t) for n, (_, t) in enumerate(place)]
    words, strings = brute.repeated_words(ranked, 12), brute.repeated_bytes(ranked, 20)
    want_words, want_bytes = Counter(), Counter()
    for d in docs:
        w, gone = words[place.index(d)]
        want_words[d[0], " ".join(x.decode() for x, g in zip(w, gone, strict=True) if not g)] += 1
        b, gone = strings[place.index(d)]
        want_bytes[d[0], bytes(x for x, g in zip(b, gone, strict=True) if not g)] += 1
    assert Counter((r.doc_id, r.kept) for r in fm_dedup.remove_repeats(df, 12, 4, shard_bytes=shard).collect()) == want_words
    assert Counter((r.doc_id, bytes(r.kept)) for r in suffix_dedup.remove_repeats(df, 20, 6, shard_bytes=shard).collect()) == want_bytes


def test_empty_table(no_docs):
    assert fm_dedup.remove_repeats(no_docs).count() == 0
    assert suffix_dedup.remove_repeats(no_docs).count() == 0


def test_different_words_are_never_taken_for_equal(spark):
    common = " ".join(f"w{i}" for i in range(49))
    docs = [(i, f"{common} {w}") for i, w in enumerate(brute.thue_morse(1024))]
    found = fm_dedup.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert [r.n_removed for r in found] == [0, 0]
