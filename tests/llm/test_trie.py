import hashlib
import random
import zlib
from collections import defaultdict

import duckdb

from loadstar.llm import trie
from tests.llm.brute import words

NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def key(row):
    digest = hashlib.sha256(f"{len(row[2] or '')}:{row[2] or ''}{row[3] or ''}".encode()).digest()
    return (row[1] is not None, row[1] or 0, row[2] or "", digest[:16])


def brute(rows):
    """The trie of rebuilt conversations, by plain lists."""
    convs = defaultdict(list)
    for row in sorted((r for r in rows if r[0] is not None), key=key):
        convs[row[0]].append((row[2] or "", row[3] or ""))
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(convs):
        h = zlib.crc32(str(c).encode()) % 4
        built = tuple(convs.get(c - c % 20, [])[:h] + convs[c][h:])
        for d in range(len(built) + 1):
            members[built[:d]].append(c)
        ends[built].append(str(c))
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in kids[node]) if kids[node] else 1
        own = (len(members[node]) - 1) * len(words(node[-1][1])) if node else 0
        saved[node] = own + sum(saved[k] for k in kids[node])
    return sorted(
        (members[n][0], len(n), members[n[:-1]][0] if n else None, len(members[n]), len(kids[n]), leaves[n], saved[n], hashlib.sha256(",".join(ends[n]).encode()).hexdigest())
        for n in members
    )


def hazards():
    rng = random.Random(3)
    texts = ["hi there", "", None, "a b\tc", "x " * 3000, "é ß"]
    rows = [(c, t, rng.choice(["user", "assistant", None]), rng.choice(texts)) for c in range(60) for t in range(rng.randint(1, 6))]
    rows += [(c, t, "user", "same") for c in range(100, 160) for t in range(3)]  # copies
    rows += [(200, None, "user", "no turn"), (200, None, "user", "no turn"), (200, 5, "b", "tie"), (200, 5, "a", "tie")]
    rows += [(None, 0, "user", "nobody's"), (303, 0, "system", "only")]  # 300 is absent
    rows += [(401, t, "user", f"turn {t % 7}") for t in range(90)]  # several blocks
    rows += [(402, t, "user", f"turn {t % 7}") for t in range(70)]
    return rows


def frame(spark, rows):
    data = [(*r, "n", "p", 1, 1, 1, 1) for r in rows]
    return spark.createDataFrame(data, "conv_id long, turn long, role string, text string, node string, parent string, pos long, words long, n long, size long")


def found(conversations):
    return sorted(tuple(r) for r in trie.prefix_trie(*trie.rebuilt(trie.ordered_turns(conversations))).select(*NAMES).collect())


def test_every_awkward_case(spark, monkeypatch):
    monkeypatch.setattr(trie, "BLOCK", 8)
    rows = hazards()
    assert found(frame(spark, rows).repartition(5)) == brute(rows)


def test_no_rows_give_no_root(spark):
    assert found(frame(spark, hazards()).limit(0)) == []


def test_turnless_conversation_is_a_member_of_the_root(spark):
    c = next(c for c in range(1, 200) if zlib.crc32(str(c).encode()) % 4 == 3 and c % 20)
    rows = [(c, 0, "user", "gone")]
    assert found(frame(spark, rows)) == brute(rows) == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


def test_contraction_finds_every_subtree_total(spark):
    rng = random.Random(5)
    shapes = {
        "chain": lambda i: i - 1,
        "comb": lambda i: i - 1 if i % 2 else max(i - 2, 0),
        "random": lambda i: rng.randrange(i),
        "star": lambda i: 0,
        "forest": lambda i: rng.randrange(i) if i % 9 else None,
    }
    rows, expected = [], {}
    for shape, above in shapes.items():
        n = 40 if shape == "chain" else 60
        parent = [None] + [above(i) for i in range(1, n)]
        value = [rng.randint(0, 9) for _ in range(n)]
        rows += [((shape, i), parent[i] if parent[i] is None else (shape, parent[i]), value[i], 1) for i in range(n)]
        for i in reversed(range(n)):
            if parent[i] is not None:
                value[parent[i]] += value[i]
        expected |= {str((shape, i)): value[i] for i in range(n)}
    code = lambda x: None if x is None else str(x).encode()
    tree = spark.createDataFrame([(code(a), code(b), v, one) for a, b, v, one in rows], "node binary, parent binary, v long, one long")
    out = trie.subtree_totals(tree, ["v", "one"]).collect()
    assert {r.node.decode(): r.v for r in out} == expected
    assert len(out) == len(rows)


def test_sql_agrees(spark, sf_dir):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{sf_dir}/conversations.parquet'")
    expected = con.sql(trie.OP13_SQL)
    rows = trie.op13_trie(spark, sf_dir).select(*expected.columns).collect()
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, expected.fetchall()))


def test_totals_are_one_scan_however_many_rounds(spark):
    # A long chain takes many rounds; the totals must not be a union that grows with them.
    n = 64
    rows = [(str(i).encode(), None if i == 0 else str(i - 1).encode(), 1) for i in range(n)]
    tree = spark.createDataFrame(rows, "node binary, parent binary, v long")
    out = trie.subtree_totals(tree, ["v"])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation ") == 1
    assert {int(r.node): r.v for r in out.collect()} == {i: n - i for i in range(n)}
