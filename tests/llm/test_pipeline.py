"""The pipeline against a plain restatement, and the registration of all queries."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from loadstar.llm import catalog
from loadstar.llm.quality import POLICIES
from loadstar.llm.tokens import END_ID, default_tokenizer
from tests.llm import brute
from tests.llm.conftest import frame, prose
from tests.llm.test_decontamination import expected


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory, rows):
    path = str(tmp_path_factory.mktemp("tables"))
    rng = random.Random(31)
    bench = [(i, prose(rng, 25)) for i in range(4)]
    docs = rows + [(300 + i, prose(rng, 60) + " " + t + " " + prose(rng, 20), "s1") for i, t in bench]
    frame(spark, docs).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, docs, bench


def survivors(docs, bench):
    """Rows that the first three stages keep."""
    fails = {
        "few_words": lambda m: m["n_words"] < 50,
        "repeats": lambda m: 100 * m["n_repeat_words"] > 50 * m["n_words"],
        "symbols": lambda m: 10 * m["n_symbols"] > m["n_words"],
        "dup_lines": lambda m: 2 * m["n_dup_lines"] > m["n_lines"],
        "short_words": lambda m: m["word_chars"] < 2 * m["n_words"],
        "long_words": lambda m: m["word_chars"] > 15 * m["n_words"],
    }
    good = [r for r in docs if not any(fails[f](brute.quality(r[1])) for f in POLICIES["v2"])]
    prints = {r: brute.fingerprint(r[1]) for r in good}
    root = brute.groups(set(prints.values()), lambda a, b: (a ^ b).bit_count() <= 3)
    order = {i: (1 << 62) if i is None else i for i, *_ in good}
    first = {}
    for r in sorted(set(good), key=lambda r: order[r[0]]):
        first.setdefault(root[prints[r]], r)
    one = set(first.values())
    leaks = {d for d, _ in expected(one, bench)}
    return sorted((r for r in one if r[0] not in leaks), key=lambda r: order[r[0]])


def test_stages_against_brute_force(spark, folder):
    path, docs, bench = folder
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "simhash_near_dedup", "decontamination", "mixing", "token_files"]
    frames, current = [], spark.read.parquet(f"{path}/documents.parquet")
    columns = current.columns
    for _, stage in corpus_pipeline.STAGES[:3]:
        current = stage(spark, current, path)
        assert current.columns == columns
        frames.append(current)
    want = survivors(docs, bench)
    assert sorted(map(str, [r.doc_id for r in frames[-1].collect()])) == sorted(str(r[0]) for r in want)

    sizes = {}
    for _, t, s in want:
        sizes[s] = sizes.get(s, 0) + len(brute.words(t))
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    target = dict(zip(order, brute.targets([sizes[s] for s in order]), strict=True))
    mixed = corpus_pipeline.mix(spark, current, path)
    assert mixed.columns == columns
    rows = mixed.collect()
    taken = Counter()
    for r in rows:
        taken[r.source] += len(brute.words(r.text))
        assert r.n_chars == len(r.text)
    assert all(abs(taken[s] - target[s]) <= 1 for s in order)

    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(default_tokenizer())
    tokenizer.encode_special_tokens = True
    out = corpus_pipeline.run(spark, path).orderBy("start").collect()
    ids = [np.array([*tokenizer.encode(r.text, add_special_tokens=False).ids, END_ID], "<u4") for r in rows]
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in out) == Counter((r.doc_id, len(i), zlib.crc32(i.tobytes())) for r, i in zip(rows, ids, strict=True))
    assert [r.start for r in out] == np.concatenate([[0], np.cumsum([r.n_tokens for r in out])[:-1]]).tolist()


def test_pipeline_on_an_empty_table(spark, tmp_path):
    frame(spark, []).limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_all_operators_are_registered():
    names = entry.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}
    assert "pipeline" in names
    assert catalog.ORACLE_SQL.keys() <= names.keys()


def test_sql_twins(spark, sf_dir):
    import duckdb

    for name, sql in catalog.ORACLE_SQL.items():
        db = duckdb.connect()
        for t in ("conversations", "pages", "documents", "benchmark"):
            db.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
        want = db.sql(sql)
        got = catalog.QUERIES[name](spark, sf_dir)
        assert sorted(want.columns) == sorted(got.columns)
        columns = sorted(got.columns)
        assert Counter(map(tuple, got.select(*columns).collect())) == Counter(db.sql(f"select {', '.join(columns)} from ({sql})").fetchall())


@pytest.mark.parametrize("name", ["op2_fm_dedup", "op3_suffix_dedup", "op4_decontamination", "op5_token_files", "op6_simhash", "op7_quality_rules", "op8_mixing"])
def test_queries_read_the_whole_table(spark, folder, name):
    path, docs, bench = folder
    got = catalog.QUERIES[name](spark, path).collect()
    if name == "op4_decontamination":
        assert {(r.doc_id, r.item_id) for r in got} == set(expected(docs, bench))
        return
    assert Counter(r.doc_id for r in got) == Counter(i for i, *_ in docs)
    for r in got:
        if name == "op2_fm_dedup":
            assert r.n_removed == sum(brute.repeated_words([d[:2] for d in docs], 50)[r.doc_id][1]) if r.doc_id in (31, 40, 300) else True
        if name == "op3_suffix_dedup":
            assert r.n_removed == sum(brute.repeated_bytes([d[:2] for d in docs], 100)[r.doc_id][1]) if r.doc_id in (31, 40, 60) else True
        if name == "op6_simhash" and r.doc_id is not None:
            assert r.fingerprint == f"{brute.fingerprint(next(t for i, t, _ in docs if i == r.doc_id)):016x}"
