import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from loadstar.llm import simhash as S
from loadstar.llm.common import mix, strings
from loadstar.llm.components import components
from loadstar.llm.xxh64 import xxh64
from tests.llm import brute
from tests.llm.conftest import prose


def test_xxh64_of_all_lengths():
    rng = random.Random(1)
    parts = [rng.randbytes(n) for n in [*range(0, 70), 100, 255, 1000]]
    ends = np.cumsum([len(p) for p in parts])
    starts = ends - [len(p) for p in parts]
    got = xxh64(np.frombuffer(b"".join(parts), np.uint8), starts, ends)
    assert got.tolist() == [xxhash.xxh64_intdigest(p, seed=42) for p in parts]


def test_fingerprints(rows):
    texts = [t for _, t, _ in rows if len(t or "") < 20_000]
    assert S.fingerprints(*strings(pa.array(texts, pa.string()))).tolist() == [brute.fingerprint(t) for t in texts]


def test_mix_is_one_to_one():
    x = np.random.default_rng(2).integers(0, 1 << 63, 1000, dtype=np.uint64)
    assert (S.unmix(mix(x)) == x).all()


def ball(seed=4):
    """Fingerprints around a few centres, at one to seven bits."""
    rng = random.Random(seed)
    out = set()
    for _ in range(25):
        centre = rng.getrandbits(64)
        out.add(centre)
        for _ in range(6):
            flips = rng.sample(range(64), rng.randint(1, 7))
            out.add(centre ^ sum(1 << b for b in flips))
    return sorted(out)


@pytest.mark.parametrize("bits", [11, 14])
def test_meetings_connect_all_pairs_within_three_bits(bits):
    fps = np.array(ball(), np.uint64)
    bucket, entry = S._packed(fps, bits)
    linked = set()
    for b in np.unique(bucket):
        for a, c in zip(*S.meetings(int(b), entry[bucket == b], bits), strict=True):
            assert (int(a) ^ int(c)).bit_count() <= 3
            linked.add(frozenset((int(a), int(c))))
    nodes = fps.tolist()
    assert brute.groups(nodes, lambda a, b: frozenset((a, b)) in linked) == brute.groups(nodes, lambda a, b: (a ^ b).bit_count() <= 3)


def test_components_of_documents(docs, rows):
    near = {(str(r.doc_id), r.fp % (1 << 64), r.component_id) for r in S.near_duplicates(docs).collect()}
    prints = {i: brute.fingerprint(t) for i, t, _ in rows if i is not None}
    root = brute.groups(prints, lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3)
    for i, fp in prints.items():
        assert (str(i), fp, root[i]) in near
    assert len([r for r in near if r[0] != "None"]) == len(prints)


def test_one_of_each_group_stays(docs, rows):
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns
    prints = {r: brute.fingerprint(r[1]) for r in rows}
    root = brute.groups(set(prints.values()), lambda a, b: (a ^ b).bit_count() <= 3)
    first = {}
    for r in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0)):
        first.setdefault(root[prints[r]], r[:2])
    assert sorted(map(str, ((r.doc_id, r.text) for r in kept.collect()))) == sorted(map(str, first.values()))


def test_rows_of_one_id_are_told_apart(spark):
    rng = random.Random(13)
    a, b, c = prose(rng, 80), prose(rng, 80), prose(rng, 80)
    docs = [(1, a, "s"), (2, a, "s"), (2, b, "s"), (2, b, "s"), (2, b, "t"), (4, b, "s"), (None, b, "s"), (None, c, "s"), (None, c, "t"), (None, "", None), (9, None, "")]
    frames = [spark.createDataFrame(docs[k:] + docs[:k], "doc_id long, text string, source string").repartition(1 + k) for k in (0, 3)]
    kept = [sorted(map(str, S.keep_one(f).collect())) for f in frames]
    assert kept[0] == kept[1]  # whatever the order of rows
    found = sorted((r.doc_id is None, r.doc_id or 0, r.text) for r in S.keep_one(frames[0]).collect())
    assert found == [(False, 1, a), (False, 2, b), (False, 9, None), (True, 0, c)]


def test_chain_and_hub(spark):
    chain = [(i, i + 1) for i in range(200)]
    hub = [(1000, 1000 + i) for i in range(1, 300)]
    found = {r.node: r.root for r in components(spark.createDataFrame(chain + hub + [(5, 5)], "a long, b long")).collect()}
    assert found == {i: 0 for i in range(201)} | {1000 + i: 1000 for i in range(300)}


def test_empty_table(no_docs):
    assert S.near_duplicates(no_docs).count() == 0
    assert S.keep_one(no_docs).count() == 0
