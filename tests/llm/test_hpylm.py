import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from loadstar.llm import hpylm as H
from tests.llm.conftest import frame, prose

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain_tokens(text):
    import re

    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)), None]


def partitions(n):
    """All ways to seat n customers, as sizes of tables."""
    seats = [[]]
    for _ in range(n):
        seats = [s[:k] + [s[k] + 1] + s[k + 1 :] for s in seats for k in range(len(s))] + [s + [1] for s in seats]
    return seats


def test_numbers_of_tables_follow_the_seating_law():
    n, chance, others, discount, strength = 6, 0.3, 4, 0.6, 0.8
    weight = Counter()
    for sizes in partitions(n):
        w = math.prod(math.prod(k - discount for k in range(1, s)) for s in sizes)
        weight[len(sizes)] += w * math.prod((strength + discount * (others + i)) * chance for i in range(len(sizes)))
    total = sum(weight.values())
    many = 40_000
    drawn = H.seated(np.full(many, n), np.full(many, chance), np.full(many, others), discount, strength, np.random.default_rng(1))
    for k in range(1, n + 1):
        assert abs((drawn == k).mean() - weight[k] / total) < 0.01


def test_large_groups_agree_with_exact_numbers():
    for chance, others, discount in ((0.02, 30, 0.7), (0.3, 3, 0.5), (0.001, 900, 0.8)):
        group = np.full(3000, 390), np.full(3000, chance), np.full(3000, others), discount, 1.0, np.random.default_rng(2)
        exact, grown = H._exactly(*group), H._in_portions(*group)
        assert abs(grown.mean() / exact.mean() - 1) < 0.15
        assert abs(grown.std() / exact.std() - 1) < 0.2
    assert (H.seated(np.array([10**9]), np.array([0.5]), np.array([0]), 0.5, 1.0, np.random.default_rng(3)) > 1).all()


def test_integers_in_few_bytes():
    rng = np.random.default_rng(6)
    mostly = np.where(rng.random(1000) < 0.01, 1 << 40, rng.integers(0, 256, 1000))
    for x in (np.zeros(0, np.int64), np.arange(256), np.arange(70_000), np.array([0, 255, 256]), np.array([1 << 62]), mostly):
        assert H._wide(H._small(x), len(x)).tolist() == x.tolist()
    assert len(H._small(mostly)) < 1500


def test_tokens_of_texts():
    data = "A b\n".encode() + b"" + "Ünd É".encode()
    h, bounds = H.tokens(np.frombuffer(data, np.uint8), np.array([0, 4, 4, len(data)]))
    x = lambda s: xxhash.xxh64_intdigest(s.encode(), seed=42)
    assert bounds.tolist() == [0, 3, 4, 7]
    assert h.tolist() == [x("a"), x("b"), 0, 0, x("Ünd"), x("É"), 0]


@pytest.fixture(scope="module")
def scored(spark, docs):
    fold = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    return H.language_model_scores(docs, fold, contexts=40).collect()


def expected_base(rows):
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, *_ in rows]
    counts = Counter(t for (_, text, _), h in zip(rows, held, strict=True) if not h for t in plain_tokens(text))
    n, v = sum(counts.values()), len(counts)
    out = []
    for (i, text, _), h in zip(rows, held, strict=True):
        words = plain_tokens(text)
        base = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in words)
        out.append((i, h, len(words), sum(counts[t] > 0 for t in words), n, base))
    return sorted(out, key=str)


def test_counts_and_base_scores(rows, scored):
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in scored), key=str)
    want = expected_base(rows)
    key = lambda r: (str(r[:5]), r[5])
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    np.testing.assert_allclose([r[5] for r in got], [r[5] for r in want], rtol=1e-6)
    assert all(r.perplexity == pytest.approx(10 ** (-r.score / r.n_tokens)) for r in scored)


def test_scores_are_those_of_the_sampled_tables(spark, rows):
    """Probabilities recomputed text by text from the tables that the sweeps left."""
    data = frame(spark, rows).select("doc_id", "text", (F.col("doc_id") % 5 == 2).alias("held_out")).fillna(False, ["held_out"])
    kept = {}
    real = H.train

    def spy(*args, **kwargs):
        kept["state"], kept["model"] = real(*args, **kwargs)
        return kept["state"], kept["model"]

    H.train = spy
    try:
        out = {(r.doc_id, r.n_tokens): r.score for r in H.language_model_scores(data, F.col("held_out"), contexts=30).collect()}
    finally:
        H.train = real
    model = kept["model"]
    samples = len(model.samples)
    cells, above = {}, {}
    for r in kept["state"].collect():
        h, runs = H._longs(r["words"]), H._wide(r["runs"], len(r["words"]) // 8)
        context = np.frombuffer(r["context"], np.uint16)
        customers, tables, summed = (H._wide(r[c], len(context)) for c in ("customers", "tables", "summed"))
        parent = np.frombuffer(r["parent"], np.float64).reshape(samples - 1, -1)
        at = 0
        for k, n in enumerate(runs.tolist()):
            last = (tables[at : at + n].sum() - model.discount_above * H._wide(r["above"], len(h))[k] + (1 + model.discount_above * model.samples[-1][-5]) / (len(model.known.counts) and model.known.distinct + 1)) / (1 + model.samples[-1][-6])
            above[int(h[k])] = [*parent[:, k], last]
            for j in range(at, at + n):
                cells[int(h[k]), int(context[j])] = (customers[j], summed[j] + tables[j])
            at += n
    unknown = [(1 + model.discount_above * s[-5]) / (model.known.distinct + 1) / (1 + s[-6]) for s in model.samples]
    # In every context the probabilities of all words and of the unknown one add up to one.
    for context in (0, 7, model.known.rare, model.known.start):
        total = 0.0
        for w in [*above, None]:
            c, t = cells.get((w, context), (0, 0))
            p = above.get(w, unknown)
            total += (c - model.discount * t / samples) / (1 + model.seen[context])
            total += sum((1 + model.discount * s[context]) / (1 + model.seen[context]) * q for s, q in zip(model.samples, p, strict=True)) / samples
        assert total == pytest.approx(1, abs=1e-6)
    codes = {int(h): k for k, h in enumerate(model.known.words)}
    for i, text, _ in rows:
        previous, score = model.known.start, 0.0
        for t in plain_tokens(text):
            h = 0 if t is None else xxhash.xxh64_intdigest(t.encode(), seed=42)
            c, tables = cells.get((h, previous), (0, 0))
            p = (c - model.discount * tables / samples) / (1 + model.seen[previous])
            p += sum((1 + model.discount * s[previous]) / (1 + model.seen[previous]) * q for s, q in zip(model.samples, above.get(h, unknown), strict=True)) / samples
            score += math.log10(p)
            previous = codes.get(h, model.known.rare)
        assert out[i, len(plain_tokens(text))] == pytest.approx(score, rel=1e-5)


def test_context_helps_on_held_out_texts(spark):
    rng = random.Random(4)
    vocabulary = prose(rng, 60).split()
    follow = {w: rng.sample(vocabulary, 3) for w in vocabulary}

    def text():
        out = [rng.choice(vocabulary)]
        for _ in range(80):
            out.append(rng.choice(follow[out[-1]]))
        return " ".join(out)

    docs = spark.createDataFrame([(i, text()) for i in range(120)], "doc_id long, text string")
    got = H.language_model_scores(docs, F.col("doc_id") % 7 == 2)
    held = [r for r in got.collect() if r.held_out]
    again = [r for r in H.language_model_scores(docs.repartition(5), F.col("doc_id") % 7 == 2).collect() if r.held_out]
    tokens = sum(r.n_tokens for r in held)
    assert 10 ** (-sum(r.score for r in held) / tokens) < 6 < 30 < 10 ** (-sum(r.base_score for r in held) / tokens)
    assert sorted(r.score for r in held) == pytest.approx(sorted(r.score for r in again))  # whatever the partitions


def pair_tables(state, model):
    """{(word, context): (customers, tables in all samples, in the last)}, contexts as hashes or codes, and
    {word: (its tables in the parent, in the samples before the last its probabilities there and its tables as a context)}."""
    known = model.known
    cells, owners = {}, {}
    for r in state.collect():
        h, runs = H._longs(r["words"]).tolist(), H._wide(r["runs"], len(r["words"]) // 8).tolist()
        codes, far = np.frombuffer(r["context"], np.uint16).tolist(), np.frombuffer(r["context"], np.uint16)
        far = iter(H._longs(r["reach"])[H._wide(r["far"], int((far == known.other).sum()))].tolist())
        customers, tables, summed = (H._wide(r[c], len(codes)).tolist() for c in ("customers", "tables", "summed"))
        at = 0
        for w, n in zip(h, runs, strict=True):
            for j in range(at, at + n):
                pair = (w, codes[j])
                if codes[j] == known.other:
                    pair = (w, ("word", next(far)))
                elif codes[j] >= known.contexts:
                    pair = (int(known.words[codes[j] - known.contexts]), ("word", w))
                assert pair not in cells
                cells[pair] = customers[j], summed[j] + tables[j], tables[j]
            at += n
        before = [np.frombuffer(r[c], t).reshape(len(model.samples) - 1, len(h)).T.tolist() for c, t in (("parent", "<f8"), ("behind", "<u4"))]
        owners |= dict(zip(h, zip(H._wide(r["above"], len(h)).tolist(), *before, strict=True), strict=True))
    return cells, owners


@pytest.mark.parametrize(("frequent", "samples"), [(0, 1), (9, 3), (40, 2)])
def test_every_word_is_a_context_of_its_own(spark, rows, frequent, samples):
    """Probabilities recomputed text by text from the tables that the sweeps left."""
    data = frame(spark, rows).select("doc_id", "text", (F.col("doc_id") % 5 == 2).alias("held_out")).fillna(False, ["held_out"])
    kept = {}
    real = H.train

    def spy(*args, **kwargs):
        kept["state"], kept["model"] = real(*args, **kwargs)
        return kept["state"], kept["model"]

    H.train = spy
    try:
        out = {(r.doc_id, r.n_tokens): r for r in H.language_model_scores(data, F.col("held_out"), samples=samples, frequent=frequent).collect()}
    finally:
        H.train = real
    model = kept["model"]
    cells, owners = pair_tables(kept["state"], model)
    code = {int(h): k for k, h in enumerate(model.known.words)}
    hashed = lambda t: 0 if t is None else xxhash.xxh64_intdigest(t.encode(), seed=42)
    want, totals = Counter(), Counter()
    texts = [(i, [hashed(t) for t in plain_tokens(text)]) for i, text, _ in rows]
    for i, words in texts:
        contexts = [model.known.start, *(code.get(h, ("word", h)) for h in words[:-1])]
        if i is None or i % 5 != 2:
            want.update(zip(words, contexts, strict=True))
            totals.update(contexts)
    assert {pair: c for pair, (c, _, _) in cells.items()} == want  # every pair is there, none is merged
    assert all(1 <= t <= c for c, _, t in cells.values())
    tables, sent = Counter(), Counter()
    for (w, context), (_, _, t) in cells.items():
        tables[context] += t
        sent[w] += t
    last = model.samples[-1]
    sent = {**sent, **dict(zip(model.known.words.tolist(), model.known.parts(last)[2].tolist(), strict=True))}
    assert last[-6] == sum(sent.values()) and last[-5] == sum(n for n, *_ in owners.values())
    rest = [(1 + model.discount_above * s[-5]) / (model.known.distinct + 1) for s in model.samples]
    unknown = [r / (1 + s[-6]) for r, s in zip(rest, model.samples, strict=True)]
    parent = {w: [*p, (sent[w] - model.discount_above * n + rest[-1]) / (1 + last[-6])] for w, (n, p, _) in owners.items()}
    assert len(parent) == model.known.distinct
    for s in range(samples):
        assert sum(p[s] for p in parent.values()) + unknown[s] == pytest.approx(1)

    def behind(context):
        if isinstance(context, int):
            return [s[context] for s in model.samples]
        return [*owners[context[1]][2], tables[context]] if context[1] in owners else [0] * samples

    def probability(w, context):
        c, t, _ = cells.get((w, context), (0, 0, 0))
        weights = [1 + model.discount * n for n in behind(context)]
        return (c + (sum(x * p for x, p in zip(weights, parent.get(w, unknown), strict=True)) - model.discount * t) / samples) / (1 + totals[context])

    some = [*totals][:: max(1, len(totals) // 40)]
    assert all(sum(probability(w, c) for w in [*parent, None]) == pytest.approx(1) for c in some)
    for i, words in texts:
        contexts = [model.known.start, *(code.get(h, ("word", h)) for h in words[:-1])]
        score = sum(math.log10(probability(w, c)) for w, c in zip(words, contexts, strict=True))
        assert out[i, len(words)].score == pytest.approx(score, rel=1e-5)
    again = {(r.doc_id, r.n_tokens): r.score for r in H.language_model_scores(data, F.col("held_out"), contexts=10**4, samples=samples).collect()}
    assert sum(again.values()) == pytest.approx(sum(r.score for r in out.values()), rel=0.01)


def test_contexts_behind_the_frequent_words_tell_what_follows(spark):
    rng = random.Random(5)
    pairs = [f"a{k} b{k}" for k in range(2000)]
    docs = [(i, " ".join(rng.sample(pairs, 300))) for i in range(60)]
    got = [r for r in H.language_model_scores(spark.createDataFrame(docs, "doc_id long, text string"), F.col("doc_id") % 7 == 2).collect() if r.held_out]
    # Half of the words follow from the one before; without its context, each is one of 2,000.
    assert 10 ** (-sum(r.score for r in got) / sum(r.n_tokens for r in got)) < 100


def test_nothing_to_learn_from(spark, no_docs):
    assert H.language_model_scores(no_docs, F.lit(False)).count() == 0
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in H.language_model_scores(docs, F.lit(True)).collect()}
    assert (got[1].n_tokens, got[1].n_known, got[1].base_score, got[1].score, got[2].n_tokens) == (3, 0, 0, 0, 1)


def test_held_out_perplexity_of_the_documents(spark, sf_dir):
    held = [r for r in H.op12_language_model(spark, sf_dir).collect() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
