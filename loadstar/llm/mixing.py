"""Mixing sources to target weights, cut at each source's budget.

Every document gets a random key from a hash of its id. Within a source, documents in
key order form a random stream; whole passes over it (epochs) and one pass that stops
at the remaining budget give the source its target. The stream's prefix sums are taken
in two steps: the key range is cut into buckets, bucket totals are summed up per
source, and only documents of one bucket are ever ordered together. So a source with a
third of all rows is spread over as many tasks as it has buckets.

Only DataFrame functions are used.

Defined results: a null text has size 0, null is a source of its own and sorts last,
sources without any word have target 0 and take nothing. Documents of size 0 are taken
with the pass that covers their place and never change a sum. Repeated rows are equal
in every column of the order, so they are interchangeable. The document at the cut
gives just the words that are missing, so a source misses its target by less than one
word. An empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loadstar.llm.common import stored, table, word_count

#: Most often that a document may be repeated.
MAX_EPOCHS = 3
#: Documents a bucket should hold; only sets the grain, never the result.
BUCKET_ROWS = 1000


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source: ``source``, ``source_size``, ``target``.

    ``sizes`` has ``source`` and ``size``. All words are shared out by weight; a target
    stops at ``max_epochs`` times its source, and what is over is shared again by
    weight among the rest. The end of that is a common level L with
    target = min(cap, L * weight), found in one pass over the sources in order of
    cap / weight: L is right once no further source is above its cap.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    cycle = F.array(*(F.lit(w).cast("double") for w in weights))
    by_name = W.orderBy(F.col("source").asc_nulls_last())  # one row per source, not per document
    per = per.withColumn("weight", F.element_at(cycle, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
    per = per.withColumn("cap", F.lit(float(max_epochs)) * F.col("source_size"))
    fill = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(W.unboundedPreceding, -1)
    after = fill.rowsBetween(W.currentRow, W.unboundedFollowing)
    everything = W.partitionBy()
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    per = per.withColumn("level", level)
    # The first source that its level does not lift above its cap, and all after it, share one level.
    per = per.withColumn("open", F.col("level") * F.col("weight") <= F.col("cap"))
    per = per.withColumn("level", F.min(F.when(F.col("open"), F.struct(F.col("cap") / F.col("weight"), F.col("level").alias("level")))).over(everything)["level"])
    share = F.least(F.col("cap"), F.coalesce(F.col("level") * F.col("weight"), F.col("cap")))
    return per.select("source", "source_size", "n_docs", share.alias("target"))


def mix_sources(docs: DataFrame, seed: int = 8, weights: tuple[int, ...] = (1, 2, 3), bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, copies, part, taken``.

    ``docs`` needs ``doc_id, text, source``. ``copies`` is how often the mix holds the
    whole document and ``part`` how many of its first words once more (only at the cut
    of its source); ``taken = copies * size + part``.
    """
    sizes = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        word_count(F.col("text")).alias("size"),
        # A repeated id with another text needs its own place in the order.
        F.xxhash64(F.lit(seed), F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit(""))).alias("key"),
    )
    sizes = stored(sizes, "mix-sizes")
    targets = source_targets(sizes, weights)

    # Bucket b holds the keys of the b-th part of the key range: order by (bucket, key) is order by key.
    n_buckets = F.greatest(F.lit(1), F.ceil(F.col("n_docs") / F.lit(bucket_rows))).cast("long")
    part = F.shiftrightunsigned(F.col("key"), 33)  # 31 bits, in order of the key taken as unsigned
    placed = sizes.join(targets, sizes["source"].eqNullSafe(targets["source"])).drop(targets["source"])
    placed = placed.withColumn("bucket", F.shiftright(part * n_buckets, 31))
    totals = placed.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    ahead = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    totals = totals.select(
        F.col("source").alias("_source"),
        F.col("bucket").alias("_bucket"),
        F.coalesce(F.sum("bucket_size").over(ahead), F.lit(0)).alias("ahead"),
    )
    placed = placed.join(totals, placed["source"].eqNullSafe(F.col("_source")) & (F.col("bucket") == F.col("_bucket")))
    order = W.partitionBy("source", "bucket").orderBy(F.shiftrightunsigned("key", 1), "key", "doc_id").rowsBetween(W.unboundedPreceding, W.currentRow)
    end = F.col("ahead") + F.sum("size").over(order)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    rest = F.floor(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long")
    last = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), F.col("rest") - (F.col("_end") - F.col("size"))))
    placed = placed.withColumn("_end", end).withColumn("epochs", epochs).withColumn("rest", rest).withColumn("last", last)
    whole = F.col("last") == F.col("size")
    return placed.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        (F.col("epochs") + F.when(whole & (F.col("size") > 0), 1).otherwise(0)).alias("copies"),
        F.when(whole, F.lit(0).cast("long")).otherwise(F.col("last")).alias("part"),
        (F.col("epochs") * F.col("size") + F.col("last")).alias("taken"),
        "key",
    )


def mixed_documents(docs: DataFrame, seed: int = 8, **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mix holds it, the cut one shortened."""
    mix = mix_sources(docs, seed, **options).where("taken > 0")
    # Rows of one key are equal in id and text; of several, each takes one row of the mix.
    same = W.partitionBy("doc_id", "key", "source").orderBy("taken")
    mix = mix.select(
        F.col("doc_id").alias("_id"),
        F.col("key").alias("_key"),
        F.col("source").alias("_source"),
        F.row_number().over(same).alias("_nth"),
        F.col("copies").cast("int").alias("_copies"),
        F.col("part").cast("int").alias("_part"),
    )
    key = F.xxhash64(F.lit(seed), F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")))
    rows = docs.withColumn("_k", key).withColumn("_s", F.col("source").cast("string"))
    rows = rows.withColumn("_n", F.row_number().over(W.partitionBy("doc_id", "_k", "_s").orderBy("_k")))
    joined = rows.join(
        mix,
        F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (F.col("_k") == F.col("_key")) & F.col("_s").eqNullSafe(F.col("_source")) & (F.col("_n") == F.col("_nth")),
    )
    joined = joined.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies") + F.when(F.col("_part") > 0, 1).otherwise(0))))
    pieces = F.regexp_extract_all("text", F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    text = F.when(F.col("_copy") > F.col("_copies"), F.array_join(F.slice(pieces, 1, F.col("_part")), "")).otherwise(F.col("text"))
    return joined.withColumn("text", text).select(*docs.columns)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents, by source weights 1, 2, 3 in turn."""
    mix = mix_sources(table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken", "source", "copies", "part")
