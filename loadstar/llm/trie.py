"""Prefix trie of conversations, with subtree totals by parallel tree contraction.

Conversations that start with the same turns share the nodes of these turns. A node is
known by a digest of its turns; a conversation's digests are chained over blocks of
``BLOCK`` turns and over the blocks' digests, so a very long conversation is worked on
by many tasks. Positions come from a range sort and the counts of the partitions before.

Subtree totals are sums over all descendants. :func:`subtree_totals` contracts the tree
in rounds of joins: *rake* removes all leaves and adds what they hold to their parents,
*compress* takes an independent set of nodes out of unary chains (a node goes if its own
coin is 1 and its unary parent's is 0) and adds what they hold to the node above. Each
round removes all leaves and about a quarter of every chain, so their number grows with
the logarithm of the tree's size, whatever its depth. Then the rounds are undone in
reverse: a node that left a chain has what it held then, plus the total of the node
below it.

Defined results: rows without a ``conv_id`` belong to no conversation. A null role or text
is empty. Turns come in order of ``turn``, null first, then role and a digest of role and
text; repeated rows are turns of their own. An empty table has no root. Columns other
than ``conv_id, turn, role, text`` are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loadstar.llm.common import stored, table, word_count
from loadstar.sources.session import new_folder

BLOCK = 256  # turns whose digests are chained in one row
FAMILY = 20  # conversations that share the opening of the first of them
_NO_ENDS = hashlib.sha256(b"").hexdigest()


def _root() -> Column:
    return F.unhex(F.lit("00"))


def _digest(*parts: Column) -> Column:
    """128 bits of the SHA-256 of binary columns."""
    return F.substring(F.unhex(F.sha2(F.concat(*parts), 256)), 1, 16)


_PLACED = "conv_id long, part int, nth long, item binary, words long"


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of conversations, each with its number within the partition."""
    part, current, nth = TaskContext.get().partitionId(), None, 0
    for b in batches:
        numbers = []
        for conv in b.column(0).to_pylist():
            nth = nth + 1 if conv == current else 0
            current = conv
            numbers.append(nth)
        parts = pa.array([part] * len(numbers), pa.int32())
        columns = [b.column(0), parts, pa.array(numbers, pa.int64()), b.column(1), b.column(2)]
        yield pa.RecordBatch.from_arrays(columns, names=["conv_id", "part", "nth", "item", "words"])


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, pos, item, words`` of every turn: place from 0, digest, words in its text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    item = _digest(*(F.encode(c, "UTF-8") for c in (F.length(role).cast("string"), F.lit(":"), role, text)))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        item.alias("item"),
        word_count(F.col("text").cast("string")).alias("words"),
    ).where("conv_id is not null")
    order = [F.asc("conv_id"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("item")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "item", "words")
    placed = stored(rows.mapInArrow(_numbered, _PLACED), "trie-turns")
    # Only a conversation that is cut by a partition's edge has turns before the partition.
    parts = placed.groupBy("conv_id", "part").agg(F.max("nth").alias("last"))
    ahead = F.sum(F.col("last") + 1).over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    cut = stored(parts.select("conv_id", "part", ahead.alias("ahead")).where("ahead > 0"), "trie-cuts")
    pos = (F.col("nth") + F.coalesce("ahead", F.lit(0))).alias("pos")
    return placed.join(cut, ["conv_id", "part"], "left").select("conv_id", pos, "item", "words")


def rebuilt(turns: DataFrame, family: int = FAMILY) -> tuple[DataFrame, DataFrame]:
    """Turns and sizes after each conversation took the opening of its family's first one.

    The first h turns of conversation c are replaced by as many of conversation
    ``c - c % family``, h being ``crc32(c) % 4``. Returns turns and ``conv_id, size``.
    """
    h = (F.crc32(F.col("conv_id").cast("string")) % 4).cast("long")
    own = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    donors = turns.where((F.col("conv_id") % family == 0) & (F.col("pos") < 3))
    donors = stored(donors.select(F.col("conv_id").alias("donor"), *(F.col(c).alias(f"_{c}") for c in ("pos", "item", "words"))), "trie-donors")
    convs = own.select("conv_id", "n", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % family).alias("donor"))
    convs = convs.join(donors.groupBy("donor").agg(F.count("*").alias("of")), "donor", "left")
    got = F.least("h", F.coalesce("of", F.lit(0)))
    convs = convs.select("conv_id", "h", "donor", got.alias("got"), (got + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("size"))
    convs = stored(convs, "trie-convs")
    given = convs.join(donors, "donor").where("_pos < h")
    given = given.select("conv_id", F.col("_pos").alias("pos"), F.col("_item").alias("item"), F.col("_words").alias("words"), "size")
    kept = turns.join(convs, "conv_id").where("pos >= h")
    kept = kept.select("conv_id", (F.col("pos") - F.col("h") + F.col("got")).alias("pos"), "item", "words", "size")
    return kept.unionAll(given), convs.select("conv_id", "size")


def prefixes(turns: DataFrame) -> DataFrame:
    """``conv_id, depth, node, parent, words, is_last`` for every turn of ``conv_id, pos, item, words, size``.

    ``node`` is the digest of all turns up to this one, ``parent`` that of the turns before.
    """
    block = F.floor(F.col("pos") / BLOCK).alias("block")
    turn = F.struct("pos", "item", "words")
    blocks = turns.groupBy("conv_id", block, "size").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    blocks = stored(blocks, "trie-blocks")
    # Where a block starts is the chain of the digests of the blocks before.
    long = blocks.where(f"size > {BLOCK}")
    digest = F.aggregate("turns", _root(), lambda acc, t: _digest(acc, t["item"]))
    chained = long.select("conv_id", "block", digest.alias("digest")).groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("block", "digest"))).alias("all"))
    starts = F.aggregate("all", F.array(_root()), lambda acc, b: F.concat(acc, F.array(_digest(F.element_at(acc, -1), b["digest"]))))
    chained = chained.select("conv_id", F.posexplode(starts).alias("block", "start"))
    blocks = blocks.join(chained.withColumn("block", F.col("block").cast("long")), ["conv_id", "block"], "left")
    ids = F.aggregate("turns", F.array(F.coalesce("start", _root())), lambda acc, t: F.concat(acc, F.array(_digest(F.element_at(acc, -1), t["item"]))))
    rows = blocks.select("conv_id", "size", ids.alias("ids"), F.posexplode("turns").alias("i", "turn"))
    depth = F.col("turn.pos") + 1
    return rows.select(
        "conv_id",
        depth.alias("depth"),
        F.get("ids", F.col("i") + 1).alias("node"),
        # A block's first turn hangs on the last node of the block before.
        F.when(F.col("i") > 0, F.get("ids", F.col("i"))).when(depth == 1, _root()).alias("parent"),
        F.col("turn.words").alias("words"),
        (depth == F.col("size")).alias("is_last"),
    )


def _linked(found: DataFrame) -> DataFrame:
    """``prefixes`` with the parents that lie in another block."""
    edges = found.where(f"depth % {BLOCK} = 0 and not is_last")
    edges = edges.select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("node").alias("above"))
    return found.join(edges, ["conv_id", "depth"], "left").withColumn("parent", F.coalesce("parent", "above")).drop("above")


def _ended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of the ids of each node; rows come in order of nodes and ids."""
    current, state = None, None
    for b in batches:
        nodes, digests = [], []
        for node, conv in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            if node != current:
                if current is not None:
                    nodes.append(current)
                    digests.append(state.hexdigest())
                current, state = node, hashlib.sha256(str(conv).encode())
            else:
                state.update(b",%d" % conv)
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(digests, pa.string())], names=["node", "ends_sha256"])
    if current is not None:
        yield pa.RecordBatch.from_arrays([pa.array([current], pa.binary()), pa.array([state.hexdigest()])], names=["node", "ends_sha256"])


def _raked(live: DataFrame, values: Sequence[str]) -> DataFrame:
    """All live nodes: leaves marked, what leaves hold added to their parents, unary nodes marked."""
    kids = live.where("parent is not null").groupBy(F.col("parent").alias("_of")).agg(F.count("*").alias("_n"))
    marked = live.join(kids, F.col("node") == F.col("_of"), "left").withColumn("leaf", F.col("_n").isNull())
    lost = [F.sum(F.when(F.col("leaf"), F.col(v)).otherwise(0)).alias(f"_{v}") for v in values]
    from_below = marked.where("parent is not null").groupBy(F.col("parent").alias("_to")).agg(F.count_if(~F.col("leaf")).alias("_left"), *lost)
    held = [(F.col(v) + F.coalesce(f"_{v}", F.lit(0))).alias(v) for v in values]
    rows = marked.drop("_of", "_n").join(from_below, F.col("node") == F.col("_to"), "left")
    return rows.select("node", "parent", *held, "coins", "leaf", F.coalesce(F.col("_left") == 1, F.lit(False)).alias("unary"))


def subtree_totals(tree: DataFrame, values: Sequence[str]) -> DataFrame:
    """``node`` and, for each of ``values``, its sum over the node and all its descendants.

    ``tree`` has a row for each node with its ``parent`` (null at a root); a forest works
    too. Values are longs without nulls.
    """
    # Every node has coins for 60 rounds; a round uses the last bit, so all rounds run the same code.
    names = ["node", "parent", *values, "coins"]
    kept = [F.col(v).alias(f"_{v}") for v in values]
    grown = [(F.col(v) + F.coalesce(f"_{v}", F.lit(0))).alias(v) for v in values]
    live = stored(tree.select("node", "parent", *values, F.xxhash64("node").alias("coins")), "tree")
    rounds: list[tuple[DataFrame, DataFrame]] = []
    while True:
        raked = stored(_raked(live, values), "tree-raked")
        rest = raked.where("not leaf")
        unary = raked.where("unary")
        coin = F.col("coins").bitwiseAND(1)
        above = unary.where(coin == 0).select(F.col("node").alias("_above"))
        out = unary.where(coin == 1).join(above, F.col("parent") == F.col("_above"))
        below = rest.select(F.col("node").alias("below"), F.col("parent").alias("_up"))
        out = stored(out.join(below, F.col("node") == F.col("_up")).select("node", "parent", *values, "below"), "tree-out")
        rounds.append((raked.where("leaf").select("node", *values), out))
        again = len(rounds) % 60 == 0
        coins = (F.xxhash64("node", F.lit(len(rounds))) if again else F.shiftright("coins", 1)).alias("coins")
        if out.isEmpty():
            if rest.isEmpty():
                break
            live = rest.select("node", "parent", *values, coins)
            continue
        up = out.select(F.col("node").alias("_out"), F.col("parent").alias("_new"))
        more = out.select(F.col("parent").alias("_to"), *kept)
        left = rest.join(out.select(F.col("node").alias("_gone")), F.col("node") == F.col("_gone"), "left_anti")
        left = left.join(up, F.col("parent") == F.col("_out"), "left").join(more, F.col("node") == F.col("_to"), "left")
        live = left.select("node", F.coalesce("_new", "parent").alias("parent"), *grown, coins)

    # All totals go to one folder, so each round's plan reads one scan however many rounds there were.
    path = new_folder(tree.sparkSession, "tree-totals")
    rounds[-1][0].write.parquet(path)
    totals = tree.sparkSession.read.schema(rounds[-1][0].schema).parquet
    for leaves, out in reversed(rounds[:-1]):
        if not out.isEmpty():
            known = totals(path).select(F.col("node").alias("_below"), *kept)
            out.join(known, F.col("below") == F.col("_below")).select("node", *grown).write.mode("append").parquet(path)
        leaves.write.mode("append").parquet(path)
    return totals(path)


def prefix_trie(turns: DataFrame, sizes: DataFrame) -> DataFrame:
    """One row for each distinct prefix of the conversations, root included.

    ``turns`` has ``conv_id, pos, item, words, size``, ``sizes`` has ``conv_id, size`` of all
    conversations, those without turns too. The ids of the conversations that end at a node
    are digested in ascending order, in one pass over sorted rows that holds one id at a time.
    """
    found = stored(prefixes(turns), "trie-prefixes")
    found = stored(_linked(found), "trie-linked")
    keys = [F.col(c) for c in ("node", "parent", "depth", "words")]
    nodes = found.groupBy(*keys).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"))
    root = sizes.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    root = root.select(_root().alias("node"), F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("words"), "conv_id", "n_convs")
    nodes = nodes.unionAll(root)
    kids = found.select("node", "parent").distinct().groupBy(F.col("parent").alias("_of")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(kids, F.col("node") == F.col("_of"), "left").drop("_of").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long"))
    nodes = stored(nodes, "trie-nodes")
    ends = found.where("is_last").select("node", "conv_id").unionAll(sizes.where("size = 0").select(_root().alias("node"), "conv_id"))
    ends = ends.repartition("node").sortWithinPartitions("node", "conv_id").mapInArrow(_ended, "node binary, ends_sha256 string")
    tree = nodes.select("node", "parent", (F.col("n_children") == 0).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"))
    totals = subtree_totals(tree, ["n_leaves", "saved_tokens"])
    above = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    rows = nodes.join(above, "parent", "left").join(totals, "node").join(ends, "node", "left")
    shown = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    return rows.select(*shown, F.coalesce("ends_sha256", F.lit(_NO_ENDS)).alias("ends_sha256"))


def op13_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of all conversations, rebuilt with shared openings."""
    turns, sizes = rebuilt(ordered_turns(table(spark, sf_dir, "conversations")))
    return prefix_trie(turns, sizes)


#: CRC-32 of a decimal number, bit by bit, then the nodes as lists of turns; a node's subtree
#: is all nodes of which its list is a prefix.
OP13_SQL = r"""
WITH rows AS (
  SELECT CAST(conv_id AS BIGINT) AS conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn NULLS FIRST, role, text) AS turns
  FROM rows GROUP BY conv_id
), crcs AS (
  SELECT conv_id, turns, conv_id - conv_id % 20 AS donor,
    xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), [CAST(ascii(d) AS BIGINT) FOR d IN string_split(CAST(conv_id AS VARCHAR), '')]),
      lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), CAST(range(8) AS BIGINT[])),
        lambda c, i: xor(c >> 1, CAST(3988292384 AS BIGINT) * (c & 1)))), CAST(4294967295 AS BIGINT)) % 4 AS h
  FROM convs
), built AS (
  SELECT c.conv_id, list_concat(coalesce(d.turns[1:c.h], []), c.turns[c.h + 1:]) AS turns
  FROM crcs c LEFT JOIN convs d ON d.conv_id = c.donor
), members AS (
  SELECT conv_id, d AS depth, turns[1:d] AS node, d = len(turns) AS is_last
  FROM (SELECT conv_id, turns, unnest(range(len(turns) + 1)) AS d FROM built)
), nodes AS (
  SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (is_last), '') AS ends
  FROM members GROUP BY node, depth
), kids AS (
  SELECT node[1:depth - 1] AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1
), valued AS (
  SELECT n.*, coalesce(k.n_children, 0) AS n_children,
    CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * len(regexp_extract_all(n.node[depth].text, '[^\x20\x09-\x0D]+')) END AS saved
  FROM nodes n LEFT JOIN kids k ON n.node = k.node
), sums AS (
  SELECT node[1:d] AS node, CAST(sum(CAST(n_children = 0 AS BIGINT)) AS BIGINT) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens
  FROM (SELECT node, n_children, saved, unnest(range(depth + 1)) AS d FROM valued) GROUP BY 1
)
SELECT v.conv_id, CAST(v.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, CAST(v.n_convs AS BIGINT) AS n_convs,
  CAST(v.n_children AS BIGINT) AS n_children, s.n_leaves, s.saved_tokens, sha256(v.ends) AS ends_sha256
FROM valued v JOIN sums s ON v.node = s.node LEFT JOIN nodes p ON v.depth > 0 AND p.node = v.node[1:v.depth - 1]
"""
