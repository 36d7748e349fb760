import hashlib
import random

import pytest

from loadstar.llm import chat as K

PARTS = ["\\", "#", "##", "###", "</turn>", "\n", ":", ": ", "a", "</", "turn>", "\\h", "\\t", "\\c", "\\\\", "h", "t", "é", "😀"]


def turn_rows():
    rng = random.Random(2)
    roles = ["user", "assistant", "x: y", "a\\:b###", "", None]
    rows = [(i, k, rng.choice(roles), "".join(rng.choices(PARTS, k=rng.randint(0, 9)))) for i in range(80) for k in range(rng.randint(1, 4))]
    rows += [(500, 0, "assistant", None), (500, 0, "assistant", None), (500, None, "assistant", "first"), (None, 1, "user", "z"), (501, 0, "user", "long " * 40_000)]
    return rows


@pytest.fixture(scope="module")
def turns(spark):
    data = [(*r, "p", 3, "h") for r in turn_rows()]
    return spark.createDataFrame(data, "conv_id long, turn long, role string, text string, piece string, nth int, head string")


def conversations(rows):
    out = {}
    for c, k, r, t in sorted(rows, key=lambda x: (x[1] is not None, x[1] or 0, x[2] or "", x[3] or "")):
        out.setdefault(c, []).append((r or "", t or ""))
    return out


def test_round_trip_of_control_strings(turns):
    want = conversations(turn_rows())
    got = K.read_back(K.format_chat(K.canonical_turns(turns))).collect()
    assert len(got) == len(want)
    for r in got:
        assert [(t.role, t.text) for t in r.turns] == want[r.conv_id]
        assert r.loss_text == "".join(t for role, t in want[r.conv_id] if role == "assistant")
        assert r.formatted.count("</turn>\n") == len(want[r.conv_id])


def test_spans_mark_assistant_texts(turns):
    for r in K.format_chat(K.canonical_turns(turns)).where("conv_id < 80").collect():
        marked = [r.formatted[s.start : s.start + s.length] for s in r.loss_spans]
        want = [t if role == "assistant" else "" for role, t in conversations(turn_rows())[r.conv_id]]
        plain = [m.replace("\\\\", "\0").replace("\\h", "###").replace("\\t", "</turn>").replace("\0", "\\") for m in marked]
        assert plain == want


def test_layouts_by_fingerprint(spark):
    tables = {
        "a struct<z:int>, conv_id long, messages array<struct<role:string,content:string,extra:int>>": ((1,), 1, [("user", "q", 1), ("assistant", None, 2)]),
        "conv_id long, conversations array<struct<from:string,value:string>>": (1, [("human", "q"), ("gpt", None)]),
        "conv_id long, prompt string, completion string, turn_no int": (1, "q", None, 4),
        "conv_id long, instruction string, output string": (1, "q", None),
    }
    for schema, row in tables.items():
        got = K.canonical_turns(spark.createDataFrame([row], schema)).collect()
        assert sorted(map(tuple, got), key=lambda r: r[1]) == [(1, 0, "user", "q"), (1, 1, "assistant", None)], schema
    assert len({K.fingerprint(x.paths) for x in K.LAYOUTS}) == len(K.LAYOUTS)
    with pytest.raises(ValueError):
        K.canonical_turns(spark.createDataFrame([(1, "q")], "conv_id long, question string"))


def test_json_rows_each_by_their_own_paths(spark):
    rows = [
        (1, '{"messages":[{"role":"user","content":"hi"},{"role":"assistant","content":"yo"}],"x":1}'),
        (2, '{"conversations":[{"from":"human","value":"hi"},{"from":"gpt","value":"yo"}]}'),
        (3, '{"instruction":"hi","output":"yo"}'),
        (4, '{"instruction":"s","input":"hi","output":"yo"}'),
        (5, "{bad"),
        (6, None),
        (7, '{"z":1}'),
    ]
    got = K.canonical_json(spark.createDataFrame(rows, "conv_id long, j string"), "j").collect()
    found = conversations([tuple(r) for r in got])
    pair = [("user", "hi"), ("assistant", "yo")]
    assert found == {1: pair, 2: pair, 3: pair, 4: [("system", "s"), *pair]}


def test_query_has_the_control_case(spark, tmp_path):
    spark.createDataFrame([(3, 0, "user", "a"), (3, 1, "assistant", None)], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: r for r in K.op1_chat_format(spark, str(tmp_path)).collect()}
    said = "\\### Assistant: </turn> ok"
    assert got[-7].turns_sha256 == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()
    assert (got[-7].loss_chars, got[-7].loss_sha256) == (len(said), hashlib.sha256(said.encode()).hexdigest())
    assert (got[3].n_turns, got[3].loss_chars) == (2, 0)


def test_empty_table_and_plan(turns):
    out = K.read_back(K.format_chat(K.canonical_turns(turns.limit(0))))
    assert out.count() == 0
    plan = K.format_chat(turns)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("name", ["prompt", "response", "completion", "instruction", "input", "output", "content", "value"])
def test_columns_named_like_another_layout(spark, name):
    rows = spark.createDataFrame([(1, 0, "user", "hi", "x")], f"conv_id long, turn long, role string, text string, {name} string")
    assert [tuple(r) for r in K.canonical_turns(rows).collect()] == [(1, 0, "user", "hi")]


def test_the_layout_that_needs_most_is_taken(spark):
    rows = spark.createDataFrame([(1, "do", "with", "done", "p")], "conv_id long, instruction string, input string, output string, prompt string")
    assert [r.text for r in K.canonical_turns(rows).orderBy("turn").collect()] == ["do", "with", "done"]
    texts = ['{"instruction": "do", "input": "with", "output": "done", "prompt": "p"}', '{"prompt": "p", "response": "r", "value": 3}', '{"prompt": "p"}']
    rows = spark.createDataFrame(list(enumerate(texts)), "conv_id long, j string")
    got = K.canonical_json(rows, "j").orderBy("conv_id", "turn").collect()
    assert [(r.conv_id, r.text) for r in got] == [(0, "do"), (0, "with"), (0, "done"), (1, "p"), (1, "r")]
