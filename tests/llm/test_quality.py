from collections import Counter

from loadstar.llm import quality as Q
from tests.llm import brute


def test_measurements_match_plain_counting(docs, rows):
    got = Counter(tuple(r[m] for m in ("doc_id", *Q.MEASURES)) for r in Q.quality_ledger(docs).collect())
    want = Counter((i, *(brute.quality(t)[m] for m in Q.MEASURES)) for i, t, _ in rows)
    assert got == want


def test_policies_are_masks_over_the_ledger(docs):
    for r in Q.quality_ledger(docs).withColumn("base", Q.rejected("base")).withColumn("v2", Q.rejected("v2")).collect():
        few = r.n_words < 50
        repeats = 100 * r.n_repeat_words > 50 * r.n_words
        assert r.base == (few or repeats)
        assert r.v2 >= r.base
        assert bool(r.fail_bits & Q.mask(("few_words",))) == few


def test_ablation_counts(docs):
    ledger = Q.quality_ledger(docs)
    bits = [r.fail_bits for r in ledger.collect()]
    for r in Q.ablations(ledger, "v2").collect():
        bit = Q.mask((r.rule,))
        assert r.n_failed == sum(bool(b & bit) for b in bits)
        assert r.n_only_this == sum(b == bit for b in bits)
        assert r.n_rejected == sum(b != 0 for b in bits)


def test_keeps_clean_documents_with_all_columns(docs, rows):
    kept = Q.keep_documents(docs)
    assert kept.columns == docs.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids[0] == 3 and all(ids[i] for i in range(12)) and ids[90]
    assert not any(ids[i] for i in (20, 21, 22, 23, 24, 60, 61, 71))


def test_rows_are_judged_by_their_own_text(spark):
    good = [" ".join(f"word{i}x{k}" for i in range(60)) for k in range(3)]
    docs = [(None, ""), (None, None), (None, good[0]), (5, "few"), (5, good[1]), (6, good[2]), (6, good[2])]
    kept = Q.keep_documents(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert Counter(map(tuple, kept)) == Counter([(None, good[0]), (5, good[1]), (6, good[2]), (6, good[2])])


def test_empty_table(no_docs):
    assert Q.quality_ledger(no_docs).count() == 0
    assert Q.ablations(Q.quality_ledger(no_docs)).count() == 0


def test_different_lines_are_never_taken_for_equal(spark):
    text = "\n".join(brute.thue_morse(1024))
    row = Q.quality_ledger(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row.n_dup_lines == 0
