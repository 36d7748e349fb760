import math
import random

import pytest

from loadstar.llm import decontamination as K
from tests.llm import brute
from tests.llm.conftest import prose


def bench_rows():
    rng = random.Random(11)
    items = [(i, prose(rng, rng.randint(12, 50))) for i in range(20)]
    return [*items, (30, None), (31, ""), (32, "too short"), (33, "eight words are enough for one seed only"), (0, items[0][1]), (None, prose(rng, 20))]


def leaky_rows():
    rng = random.Random(12)
    items = [t for _, t in bench_rows()]
    rows = [(i, prose(rng, rng.randint(0, 80)), "s") for i in range(30)]
    for k in range(20):
        w = items[k].split()
        for j in range(k % 5, len(w), 6 if k % 2 else 1000):
            w[j] = "zz"  # every sixth word replaced, or one word
        rows.append((100 + k, prose(rng, 20) + " " + " ".join(w) + " " + prose(rng, 9), "s"))
    rows.append((200, items[3].upper(), "s"))
    rows.append((201, " ".join(items[4].split()[:9]), "s"))  # too little of an item
    rows.append((202, items[23], "s"))
    rows += [(203, None, None), (204, "", "s"), (None, items[5], "s"), (100, rows[30][1], "s"), (205, "the " * 2000, "s")]
    return rows


def expected(docs, items):
    out = {}
    for d, text, *_ in docs:
        w = brute.words((text or "").lower())
        for i, item in items:
            v = brute.words((item or "").lower())
            starts = {
                a - b
                for m in K.MASKS
                for b in range(len(v) - m[-1])
                for a in range(len(w) - m[-1])
                if all(w[a + o] == v[b + o] for o in m)
            }
            for s in starts:
                equal = [0 <= s + j < len(w) and w[s + j] == v[j] for j in range(len(v))]
                n = min(K.STRETCH, len(v))
                best = max(sum(equal[j : j + n]) for j in range(len(v) - n + 1))
                if best >= math.ceil(K.SIMILARITY * n):
                    out[(d, i)] = max(out.get((d, i), (0, 0, -(10**9))), (sum(equal), best, -s))
    return {k: (a, b, -s) for k, (a, b, s) in out.items()}


@pytest.fixture(scope="module")
def frames(spark):
    docs = [(d, t, s, "w", 1, 2) for d, t, s in leaky_rows()]
    return (
        spark.createDataFrame(docs, "doc_id long, text string, source string, words string, seed int, at int"),
        spark.createDataFrame(bench_rows(), "item_id long, text string"),
    )


@pytest.mark.parametrize("limit", [K.BROADCAST_SEEDS, 0])
def test_pairs(frames, limit, monkeypatch):
    monkeypatch.setattr(K, "BROADCAST_SEEDS", limit)
    got = {(r.doc_id, r.item_id): (r.n_equal, r.best_equal, r.doc_start) for r in K.contaminated_pairs(*frames).collect()}
    want = expected(leaky_rows(), bench_rows())
    assert got == want
    assert {(100 + k, k) for k in range(20)} <= got.keys() and (200, 3) in got and (None, 5) in got
    assert not {201, *range(30)} & {d for d, _ in got}


def test_leaks_go_and_the_rest_stays(frames):
    docs, bench = frames
    kept = K.without_leaks(docs, bench)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(ids) == sorted(d for d, *_ in leaky_rows() if d is not None and (d < 30 or d in (201, 203, 204, 205)))


def test_rows_are_judged_by_their_own_text(frames, spark):
    _, bench = frames
    leak = next(t for _, t in bench_rows() if len(t.split()) >= 20)
    docs = [(None, leak), (None, "clean " * 60), (7, leak), (7, "also clean " * 30), (8, leak)]
    kept = K.without_leaks(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()
    assert sorted(map(str, kept)) == sorted(map(str, spark.createDataFrame([docs[1], docs[3]], "doc_id long, text string").collect()))


def test_empty_tables(frames):
    docs, bench = frames
    assert K.contaminated_pairs(docs.limit(0), bench).count() == 0
    assert K.without_leaks(docs, bench.limit(0)).count() == len(leaky_rows())


def test_no_python_in_the_plan(frames):
    plan = K.contaminated_pairs(*frames)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
