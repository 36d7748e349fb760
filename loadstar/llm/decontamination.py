"""Benchmark decontamination by spaced seeds.

A seed is a fixed mask over consecutive words that looks at some positions and ignores
the others, so a replaced word between them does not hide a copied passage. The seeds
of the benchmark items and of all documents are joined by hash. Every hit fixes an
alignment of item and document; there all words of the item are compared, and the pair
counts when some stretch of ``STRETCH`` words (the whole item if shorter) agrees in at
least ``SIMILARITY`` of its places.

Only DataFrame functions are used. Seeds are looked up without moving the documents as
long as the benchmark's seeds are few (``BROADCAST_SEEDS``, counted before); beyond
that the join shuffles by seed.

Defined results: words are split at ASCII white space and compared in lower case. Null
and empty texts have no words. Items with fewer words than the shortest mask have no
seed and are never found. Repeated rows of a document are one result row. Null ids of
documents or items are kept as ids of their own. Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadstar.llm.common import stored, table, word_list

#: Positions each mask looks at. Five words each, over seven and nine.
MASKS = ((0, 1, 3, 5, 6), (0, 2, 3, 7, 8))
STRETCH, SIMILARITY = 13, 0.8
BROADCAST_SEEDS = 1_000_000


def _hashes(text: Column) -> Column:
    return F.transform(word_list(F.lower(text)), lambda w: F.xxhash64(w))


def _once(value: Column) -> Column:
    """A generator of one row. Unlike a projection it is not merged into expressions
    above it, which would evaluate ``value`` again for every element they look at."""
    return F.explode(F.array(value))


def _seeds(words: Column, number: int, masks: tuple[tuple[int, ...], ...]) -> Column:
    """Seed hashes of one mask at all positions of an array of word hashes."""
    mask = masks[number]
    starts = F.size(words) - mask[-1]
    at = F.when(starts > 0, F.sequence(F.lit(0), starts - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.xxhash64(F.lit(number), *(F.get(words, i + o) for o in mask)))


def _seed_rows(df: DataFrame, columns: list[str], masks: tuple[tuple[int, ...], ...]) -> DataFrame:
    """One row per seed: ``columns``, ``words``, ``seed`` and its word position ``at``."""
    each = [_seeds(F.col("words"), k, masks) for k in range(len(masks))]
    if len(masks) == 1:
        return df.select(*columns, "words", F.posexplode(each[0]).alias("at", "seed"))
    df = df.withColumn("_seeds", F.concat(*each))
    rows = df.select(*columns, "words", F.posexplode("_seeds").alias("_nth", "seed"))
    at, before = F.col("_nth"), F.lit(0)
    for mask in masks[:-1]:
        before = before + F.greatest(F.lit(0), F.size("words") - mask[-1])
        at = F.when(F.col("_nth") >= before, F.col("_nth") - before).otherwise(at)
    return rows.withColumn("at", at).drop("_nth")


def contaminated_pairs(
    docs: DataFrame,
    benchmark: DataFrame,
    masks: tuple[tuple[int, ...], ...] = MASKS,
    stretch: int = STRETCH,
    similarity: float = SIMILARITY,
) -> DataFrame:
    """One row per document and item that share a passage.

    ``doc_id, item_id, n_item_words, n_equal`` (equal words of the best alignment),
    ``best_equal`` and ``best_words`` (of its best stretch) and ``doc_start``, the word
    of the document at which the item's first word would stand.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), _once(_hashes(F.col("text"))).alias("words"))
    items = _seed_rows(items, ["item_id"], masks).select("item_id", F.col("words").alias("item"), "seed", F.col("at").alias("item_at"))
    if items.count() <= BROADCAST_SEEDS:
        items = F.broadcast(items)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _once(_hashes(F.col("text"))).alias("words"))
    hits = _seed_rows(rows, ["doc_id"], masks).join(items, "seed")

    # The item's words against the document's along the alignment of the hit.
    start = F.col("at") - F.col("item_at")
    hits = hits.withColumn("doc_start", start)
    equal = F.transform("item", lambda w, i: F.when((F.col("doc_start") + i >= 0) & F.get("words", F.greatest(F.lit(0), F.col("doc_start") + i)).eqNullSafe(w), 1).otherwise(0))
    hits = hits.select("doc_id", "item_id", "doc_start", _once(equal).alias("equal"))
    hits = hits.withColumn("best_words", F.least(F.lit(stretch), F.size("equal")))

    # Sums of all stretches in one pass: add the entering word, take off the leaving one.
    zero = F.struct(F.lit(0).alias("now"), F.lit(0).alias("best"), F.lit(0).alias("i"))

    def step(state: Column, e: Column) -> Column:
        leaving = F.when(state["i"] >= F.col("best_words"), F.get("equal", F.greatest(F.lit(0), state["i"] - F.col("best_words")))).otherwise(0)
        now = state["now"] + e - leaving
        return F.struct(now.alias("now"), F.greatest(state["best"], now).alias("best"), (state["i"] + 1).alias("i"))

    best = F.aggregate("equal", zero, step, lambda s: s["best"])
    total = F.aggregate("equal", F.lit(0), lambda s, e: s + e)
    hits = hits.select(
        "doc_id",
        "item_id",
        F.size("equal").alias("n_item_words"),
        total.alias("n_equal"),
        best.alias("best_equal"),
        "best_words",
        "doc_start",
    )
    hits = hits.where(F.col("best_equal") >= F.ceil(F.lit(similarity) * F.col("best_words")))
    pick = F.struct("n_equal", "best_equal", (-F.col("doc_start")).alias("_back"))
    found = hits.groupBy("doc_id", "item_id", "n_item_words", "best_words").agg(F.max(pick).alias("pick"))
    return found.select(
        "doc_id",
        "item_id",
        "n_item_words",
        F.col("pick.n_equal").alias("n_equal"),
        F.col("pick.best_equal").alias("best_equal"),
        "best_words",
        (-F.col("pick._back")).alias("doc_start"),
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that share no passage with any item, with all their columns.

    Every row is judged by its own text, whatever other rows share its id.
    """
    row = F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    bad = contaminated_pairs(docs.select(row.alias("doc_id"), "text"), benchmark, **options).select(F.col("doc_id").alias("_leak")).distinct()
    bad = stored(bad, "leaks")  # so that its size is known when the join is planned
    return docs.join(bad, row == F.col("_leak"), "left_anti")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of documents and benchmark items that share a passage."""
    return contaminated_pairs(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _seed_sql(table: str, key: str) -> str:
    """Seeds of both masks as lists of words, with their place."""
    parts = []
    for number, mask in enumerate(MASKS):
        picked = ", ".join(f"words[pos + {o + 1}]" for o in mask)
        parts.append(
            f"""SELECT {key}, pos, {number} AS mask, [{picked}] AS seed
    FROM (SELECT {key}, words, unnest(range(greatest(len(words) - {mask[-1]}, 0))) AS pos FROM {table})"""
        )
    return " UNION ALL ".join(parts)


#: Hits by equal word lists, then every word of the item along each alignment.
OP4_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS words FROM documents
), t AS (
  SELECT row_number() OVER () AS tid, item_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS words FROM benchmark
), ds AS ({_seed_sql("d", "rid")}), ts AS ({_seed_sql("t", "tid")}),
hits AS (
  SELECT DISTINCT rid, tid, ds.pos - ts.pos AS doc_start FROM ds JOIN ts USING (mask, seed)
), e AS (
  SELECT doc_id, item_id, doc_start, len(t.words) AS n, least({STRETCH}, len(t.words)) AS best_words,
    [CASE WHEN doc_start + i >= 0 AND d.words[doc_start + i + 1] = t.words[i + 1] THEN 1 ELSE 0 END FOR i IN range(len(t.words))] AS equal
  FROM hits JOIN d USING (rid) JOIN t USING (tid)
), scored AS (
  SELECT *, list_sum(equal) AS n_equal,
    list_max([list_sum(equal[i:i + best_words - 1]) FOR i IN range(1, n - best_words + 2)]) AS best_equal FROM e
)
SELECT doc_id, item_id, n::INTEGER AS n_item_words, best.n_equal::INTEGER AS n_equal, best.best_equal::INTEGER AS best_equal,
  best_words::INTEGER AS best_words, (-best.back)::INTEGER AS doc_start
FROM (
  SELECT doc_id, item_id, n, best_words, max({{'n_equal': n_equal, 'best_equal': best_equal, 'back': -doc_start}}) AS best
  FROM scored WHERE best_equal >= ceil({SIMILARITY} * best_words) GROUP BY doc_id, item_id, n, best_words
)
"""
