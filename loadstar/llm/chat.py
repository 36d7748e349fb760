"""Chat formatting: layouts are recognised by a fingerprint of their field paths.

``fingerprint`` hashes nested field paths; a layout is recognised where the paths it needs
have its hash, those that need more paths first, and its declarative mapping turns the data
into canonical rows ``conv_id, turn, role, text``. Tables are recognised by their schema,
JSON strings row by row by the paths each holds. ``format_chat`` then renders every
conversation in one template and records which spans a model is trained on, and
``read_back`` recovers the turns from the rendered text.

The template is ``### role: text</turn>`` and a line feed per turn. Inside texts and
roles a backslash becomes two, ``###`` becomes ``\\h``, ``</turn>`` becomes ``\\t``, in
roles also a colon ``\\c``. So control strings occur only where the template puts them
and unescaping restores every text.

Only DataFrame functions are used.

Defined results: a null text or role is empty. Null conversation ids form one
conversation. Turns go by turn number (null first), then role, then text; repeated rows
are repeated turns. Other columns are ignored, whatever their names, also where they are
the names of another layout. A conversation
is one row, so its text must fit one. Layouts nobody registered raise ``ValueError`` for
tables and give no turns for single JSON strings. Empty tables give no rows.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadstar.llm.common import table


@dataclass(frozen=True)
class Layout:
    """A known layout and how it maps to turns.

    ``messages`` names an array of structs with the fields ``role`` and ``text``; else
    ``fixed`` lists (role, field) pairs of one exchange; else the table has one row per
    turn with the fields ``turn``, ``role`` and ``text``. ``roles`` renames roles.
    """

    name: str
    messages: str | None = None
    role: str = "role"
    text: str = "text"
    turn: str = "turn"
    fixed: tuple[tuple[str, str], ...] = ()
    roles: dict[str, str] = field(default_factory=dict, hash=False)

    @property
    def paths(self) -> frozenset[str]:
        if self.messages:
            return frozenset({f"{self.messages}[].{self.role}", f"{self.messages}[].{self.text}"})
        if self.fixed:
            return frozenset(f for _, f in self.fixed)
        return frozenset({self.turn, self.role, self.text})


LAYOUTS = (
    Layout("turn rows"),
    Layout("messages", messages="messages", text="content"),
    Layout("shared conversations", messages="conversations", role="from", text="value", roles={"human": "user", "gpt": "assistant"}),
    Layout("prompt", fixed=(("user", "prompt"), ("assistant", "completion"))),
    Layout("prompt and response", fixed=(("user", "prompt"), ("assistant", "response"))),
    Layout("instruction", fixed=(("user", "instruction"), ("assistant", "output"))),
    Layout("instruction with input", fixed=(("system", "instruction"), ("user", "input"), ("assistant", "output"))),
)


def field_paths(schema: T.DataType, prefix: str = "") -> set[str]:
    """Paths of all leaves; ``[]`` stands for any element of an array."""
    if isinstance(schema, T.StructType):
        return {p for f in schema for p in field_paths(f.dataType, f"{prefix}.{f.name}" if prefix else f.name)}
    if isinstance(schema, T.ArrayType):
        return field_paths(schema.elementType, prefix + "[]")
    return {prefix}


def fingerprint(paths: Iterable[str]) -> str:
    """Hash of field paths in sorted order."""
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


def by_detail(layouts: tuple[Layout, ...]) -> list[Layout]:
    """Layouts in the order in which they are tried: those with more paths first."""
    return sorted(layouts, key=lambda x: -len(x.paths))


def match(paths: set[str], layouts: tuple[Layout, ...] = LAYOUTS) -> Layout | None:
    """The first layout whose own fingerprint the paths have, whatever other paths there are."""
    return next((x for x in by_detail(layouts) if fingerprint(x.paths & paths) == fingerprint(x.paths)), None)


def _turns(layout: Layout, get) -> Column:
    """An array of (turn, role, text) structs; ``get`` gives a top-level field."""
    if layout.messages:
        return F.transform(
            get(layout.messages),
            lambda m, i: F.struct(i.cast("long").alias("turn"), m[layout.role].cast("string").alias("role"), m[layout.text].cast("string").alias("text")),
        )
    if layout.fixed:
        return F.array(*(F.struct(F.lit(i).cast("long").alias("turn"), F.lit(r).alias("role"), get(f).cast("string").alias("text")) for i, (r, f) in enumerate(layout.fixed)))
    return F.array(F.struct(get(layout.turn).cast("long").alias("turn"), get(layout.role).cast("string").alias("role"), get(layout.text).cast("string").alias("text")))


def _renamed(layout: Layout, role: Column) -> Column:
    for old, new in layout.roles.items():
        role = F.when(role == old, new).otherwise(role)
    return role


def _with_role(layout: Layout, turn: Column) -> Column:
    return turn.withField("role", _renamed(layout, turn["role"]))


def _variant_field(kind: str, name: str) -> Column:
    return F.try_variant_get(F.col("_value"), f"$.{name}", kind)


def canonical_turns(df: DataFrame, conv_id: str = "conv_id", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """``conv_id, turn, role, text`` of a table whose schema some layout matches."""
    layout = match(field_paths(df.schema), layouts)
    if layout is None:
        raise ValueError(f"no layout has the field paths {sorted(field_paths(df.schema))}")
    rows = df.select(F.col(conv_id).cast("long").alias("conv_id"), F.inline(_turns(layout, lambda f: F.col(f"`{f}`"))))
    return rows.withColumn("role", _renamed(layout, F.col("role")))


def canonical_json(df: DataFrame, json: str, conv_id: str = "conv_id", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """The same for a column of JSON objects, each in a layout of its own.

    The field paths are taken row by row from the parsed value; a row of an unknown
    layout or of broken JSON gives no turns.
    """
    layouts = tuple(x for x in layouts if x.messages or x.fixed)
    names = sorted({p.split("[]")[0] for x in layouts for p in x.paths})
    arrays = {x.messages for x in layouts if x.messages}
    inner = {a: sorted({f for x in layouts if x.messages == a for f in (x.role, x.text)}) for a in arrays}
    value = F.try_parse_json(F.col(json))
    present = []
    for name in names:
        if name in arrays:
            first = F.try_variant_get(value, f"$.{name}[0]", "variant")
            present += [F.when(F.try_variant_get(first, f"$.{f}", "string").isNotNull(), F.lit(f"{name}[].{f}")) for f in inner[name]]
        else:
            present.append(F.when(F.try_variant_get(value, f"$.{name}", "string").isNotNull(), F.lit(name)))
    paths = F.array_compact(F.array(*present))
    turns = F.lit(None).cast("array<struct<turn:bigint,role:string,text:string>>")
    for layout in reversed(by_detail(layouts)):
        kind = "string" if layout.fixed else f"array<struct<{layout.role}:string,{layout.text}:string>>"
        found = _turns(layout, functools.partial(_variant_field, kind))
        found = F.transform(found, functools.partial(_with_role, layout))
        own = F.array_sort(F.array_intersect(F.col("_paths"), F.array(*map(F.lit, sorted(layout.paths)))))
        mark = F.sha2(F.array_join(own, "\n"), 256)
        turns = F.when(mark == fingerprint(layout.paths), found).otherwise(turns)
    rows = df.select(F.col(conv_id).cast("long").alias("conv_id"), value.alias("_value"), paths.alias("_paths"))
    return rows.select("conv_id", F.inline(turns))


def escape(text: Column, role: bool = False) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    text = F.replace(F.replace(text, F.lit("###"), F.lit("\\h")), F.lit("</turn>"), F.lit("\\t"))
    return F.replace(text, F.lit(":"), F.lit("\\c")) if role else text


def unescape(text: Column) -> Column:
    """Pairs of backslashes are split off first; what is left of backslashes starts an escape."""

    def plain(part: Column) -> Column:
        part = F.replace(F.replace(part, F.lit("\\h"), F.lit("###")), F.lit("\\t"), F.lit("</turn>"))
        return F.replace(part, F.lit("\\c"), F.lit(":"))

    parts = F.transform(F.split(text, r"\\\\"), plain)
    return F.when(F.contains(text, F.lit("\\")), F.array_join(parts, "\\")).otherwise(text)


def format_chat(turns: DataFrame, trained: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """``conv_id``, the ``formatted`` text and ``loss_spans``, one (start, length) per turn.

    Spans count code points of the formatted text; turns that are not trained on have
    length 0.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    head, body = F.concat(F.lit("### "), escape(F.col("role"), role=True), F.lit(": ")), escape(F.col("text"))
    close = F.lit("</turn>\n")
    # Lengths alone go through the windows; the pieces are built after the shuffle.
    rows = rows.withColumn("n_head", F.length(head)).withColumn("n_body", F.length(body))
    size = (F.col("n_head") + F.col("n_body") + F.length(close)).cast("long")
    order = W.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    rows = rows.withColumn("nth", F.row_number().over(order))
    rows = rows.withColumn("end", F.sum(size).over(order.rowsBetween(W.unboundedPreceding, W.currentRow)))
    start = F.col("end") - F.length(close) - F.col("n_body")
    length = F.when(F.col("role").isin(*trained), F.col("n_body")).otherwise(F.lit(0)).cast("long")
    rows = rows.withColumn("piece", F.concat(head, body, close))
    each = F.struct("nth", "piece", F.struct(start.alias("start"), length.alias("length")).alias("span"))
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(each)).alias("each"))
    return whole.select("conv_id", F.array_join(F.col("each.piece"), "").alias("formatted"), F.col("each.span").alias("loss_spans"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Adds ``turns``, the unescaped (role, text) pairs, and ``loss_text`` of the spans."""
    pieces = F.split("formatted", "</turn>\n")
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)

    def turn(piece: Column) -> Column:
        head = F.substring_index(piece, ": ", 1)
        return F.struct(
            unescape(F.substr(head, F.lit(5))).alias("role"),
            unescape(F.substr(piece, F.length(head) + 3)).alias("text"),
        )

    # A span ends where its turn's piece ends, so its text is the piece's tail.
    under = F.zip_with(F.col("_pieces"), F.col("loss_spans"), lambda p, s: unescape(F.right(p, s["length"].cast("int"))))
    rows = formatted.withColumn("_pieces", pieces)
    return rows.select("*", F.transform("_pieces", turn).alias("turns"), F.array_join(under, "").alias("loss_text")).drop("_pieces")


#: A conversation whose texts are made of the template's own control strings.
CONTROL_CASE = (-7, "\\### Assistant: </turn> ok")


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one of control strings in another layout, read back."""
    rows = canonical_turns(table(spark, sf_dir, "conversations"))
    conv, said = CONTROL_CASE
    message = [F.struct(F.lit(r).alias("role"), F.lit(said).alias("content")) for r in ("user", "assistant")]
    case = spark.range(1).select(F.lit(conv).cast("long").alias("conv_id"), F.array(*message).alias("messages"))
    back = read_back(format_chat(rows.unionByName(canonical_turns(case))))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


OP1_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), e AS (
  SELECT *, replace(replace(replace(replace(role, '\', '\\'), '###', '\h'), '</turn>', '\t'), ':', '\c') AS r,
    replace(replace(replace(text, '\', '\\'), '###', '\h'), '</turn>', '\t') AS x FROM t
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
  CAST(sum(length('### ' || r || ': ' || x || '</turn>' || chr(10))) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
