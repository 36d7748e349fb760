"""Quality rules as a ledger: each rule is evaluated once, policies are bit masks over it.

``quality_ledger`` measures every text once and stores, besides the measurements, one
bit for each rule that the text fails. A policy is a named, versioned mask: a document
is rejected when it fails a rule of the mask. Policies and their ablations therefore
never touch the texts again.

Defined results: a null or empty text has no words, all measurements zero and fails
``few_words`` only. Repeated rows are measured one by one. An empty table gives an
empty ledger. Other columns of the input are not read; columns of the same names as
measurements do not clash, since only the id and the text are selected.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from loadstar.llm.common import batch, portions, prefix_hash, slices, span_hash, strings, table, word_hashes, words

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
_OUT = pa.schema([("doc_id", pa.int64())] + [(m, pa.int64()) for m in MEASURES])
_DDL = "doc_id long, " + ", ".join(f"{m} long" for m in MEASURES)

#: Characters that count as symbols, fixed by the rule.
SYMBOLS = b"#*$%&|<>"
_IS_SYMBOL = np.isin(np.arange(256), np.frombuffer(SYMBOLS, np.uint8))
_IS_LEAD = (np.arange(256) & 0xC0) != 0x80  # first byte of a code point
_BLOCK = 1 << 20  # bytes of text worked on at a time


def _rules() -> dict[str, Column]:
    """Rule name to the condition under which a text fails it. The order fixes the bits."""
    c = F.col
    return {
        "few_words": c("n_words") < 50,
        "repeats": 100 * c("n_repeat_words") > 50 * c("n_words"),
        "symbols": 10 * c("n_symbols") > c("n_words"),
        "dup_lines": 2 * c("n_dup_lines") > c("n_lines"),
        "short_words": c("word_chars") < 2 * c("n_words"),
        "long_words": c("word_chars") > 15 * c("n_words"),
    }


RULES = ("few_words", "repeats", "symbols", "dup_lines", "short_words", "long_words")
#: Versioned policies: the rules whose failure rejects a document.
POLICIES = {
    "base": ("few_words", "repeats"),
    "v1": ("few_words", "repeats", "symbols"),
    "v2": RULES,
}
DEFAULT_POLICY = "v2"


def mask(rules: tuple[str, ...]) -> int:
    """The bits of the named rules."""
    return sum(1 << RULES.index(r) for r in rules)


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def _earlier_equal(owner: np.ndarray, value: np.ndarray) -> np.ndarray:
    """True where the same owner has an equal value at a smaller index."""
    key = value ^ (owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    same &= owner[order][1:] == owner[order][:-1]
    out = np.zeros(len(key), bool)
    out[order[1:][same]] = True
    return out


def _any_equal(owner: np.ndarray, value: np.ndarray) -> np.ndarray:
    """True where the same owner has an equal value at another index."""
    key = value ^ (owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    same &= owner[order][1:] == owner[order][:-1]
    out = np.zeros(len(key), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def measure(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Measurements of the texts between ``offsets``."""
    starts, ends, first = words(data, offsets)
    n_words = np.diff(first)
    rows = np.arange(len(n_words))
    out = {"n_words": n_words, "n_symbols": _sums(_IS_SYMBOL[data], offsets)}
    lead = np.zeros(len(data) + 1, np.int64)
    np.cumsum(_IS_LEAD[data], out=lead[1:])
    out["word_chars"] = _sums(lead[ends] - lead[starts], first)

    # Lines: pieces between line feeds, hashed whole; only those with a word count.
    feeds = np.flatnonzero(data == 10)
    line_start = np.union1d(offsets[:-1], feeds + 1)
    line_start = line_start[line_start < len(data)]
    line_end = np.append(line_start[1:], len(data))
    closed = (line_end > line_start) & (data[line_end - 1] == 10) if len(line_start) else np.zeros(0, bool)
    line_end = line_end - closed
    line_row = np.searchsorted(offsets, line_start, side="right") - 1
    holds = np.searchsorted(starts, line_end) > np.searchsorted(starts, line_start)
    line_start, line_end, line_row = line_start[holds], line_end[holds], line_row[holds]
    dup = _earlier_equal(line_row, word_hashes(data, line_start, line_end))
    out["n_lines"] = np.bincount(line_row, minlength=len(rows))[: len(rows)]
    out["n_dup_lines"] = np.bincount(line_row[dup], minlength=len(rows))[: len(rows)]

    # Windows of three words inside one row.
    covered = np.zeros(len(starts) + 3, bool)
    if len(starts) >= 3:
        owner = np.repeat(rows, n_words)
        prefix = prefix_hash(word_hashes(data, starts, ends))
        at = np.flatnonzero(owner[2:] == owner[:-2])
        again = at[_any_equal(owner[at], span_hash(prefix, at, at + 3))]
        for shift in range(3):
            covered[again + shift] = True
    out["n_repeat_words"] = _sums(covered[: len(starts)], first)
    return out


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids = b.column(0)
        data, offsets = strings(b.column(1))
        for low, high in slices(offsets, _BLOCK):
            span = offsets[low : high + 1]
            found = measure(data[span[0] : span[-1]], span - span[0])
            yield batch(_OUT, doc_id=ids[low:high], **found)


def _measured_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first column as it is, beside the measurements of the text in the second."""
    for b in portions(batches):
        found = measure(*strings(b.column(1)))
        yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(found[m], pa.int64()) for m in MEASURES)], names=["row", *MEASURES])


def quality_ledger(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, the measurements and ``fail_bits``."""
    found = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return _with_bits(found.mapInArrow(_measured, _DDL))


def _with_bits(found: DataFrame) -> DataFrame:
    bits = [F.when(fails, F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")) for i, fails in enumerate(_rules().values())]
    return found.withColumn("fail_bits", reduce(Column.bitwiseOR, bits))


def rejected(policy: str) -> Column:
    """Whether a ledger row fails a rule of the policy."""
    return F.col("fail_bits").bitwiseAND(F.lit(mask(POLICIES[policy])).cast("long")) != 0


def ablations(ledger: DataFrame, policy: str = DEFAULT_POLICY) -> DataFrame:
    """For each rule of the policy: documents that fail it, and that only it rejects.

    Documents are first counted by their distinct failure bits, at most two to the
    number of rules, so nothing but these counts is shuffled.
    """
    bits = F.col("fail_bits").bitwiseAND(F.lit(mask(POLICIES[policy])).cast("long"))
    counts = ledger.groupBy(bits.alias("bits")).agg(F.count("*").alias("n"))
    each = F.array(*(F.struct(F.lit(r).alias("rule"), F.lit(1 << RULES.index(r)).cast("long").alias("bit")) for r in POLICIES[policy]))
    rows = counts.select("bits", "n", F.inline(each))
    return rows.groupBy("rule").agg(
        F.sum(F.when(F.col("bits").bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("bits") == F.col("bit"), F.col("n")).otherwise(0)).alias("n_only_this"),
        F.sum(F.when(F.col("bits") != 0, F.col("n")).otherwise(0)).alias("n_rejected"),
    )


def keep_documents(docs: DataFrame, policy: str = DEFAULT_POLICY) -> DataFrame:
    """The documents the policy does not reject, with all their columns.

    Every row is judged by its own text, whatever other rows share its id.
    """
    rows = docs.select(F.struct("*").alias("row"), F.col("text").cast("string").alias("text"))
    schema = StructType([StructField("row", docs.schema), *(StructField(m, LongType()) for m in MEASURES)])
    ledger = _with_bits(rows.mapInArrow(_measured_rows, schema))
    return ledger.where(~rejected(policy)).select("row.*")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measurements, ledger and verdicts for all documents."""
    ledger = quality_ledger(table(spark, sf_dir, "documents"))
    return ledger.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        rejected("base").alias("base_failed"),
        (~rejected(DEFAULT_POLICY)).alias("kept"),
        "n_lines",
        "fail_bits",
    )


#: Failure bits in the order of the rules; a window's words count once however often they are covered.
OP7_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT rid, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d
), lines AS (
  SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid
), windows AS (
  SELECT rid, i, words[i:i + 2] AS three FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM w)
), often AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, three) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM often) GROUP BY rid
), m AS (
  SELECT doc_id, len(words) AS n_words, coalesce(list_sum([length(x) FOR x IN words]), 0)::BIGINT AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines
  FROM w LEFT JOIN lines USING (rid) LEFT JOIN covered USING (rid)
), b AS (
  SELECT *, (n_words < 50)::BIGINT + 2 * (100 * n_repeat_words > 50 * n_words)::BIGINT + 4 * (10 * n_symbols > n_words)::BIGINT
    + 8 * (2 * n_dup_lines > n_lines)::BIGINT + 16 * (word_chars < 2 * n_words)::BIGINT + 32 * (word_chars > 15 * n_words)::BIGINT AS fail_bits
  FROM m
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
  n_repeat_words::BIGINT AS n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  fail_bits = 0 AS kept, n_lines::BIGINT AS n_lines, fail_bits::BIGINT AS fail_bits
FROM b
"""
