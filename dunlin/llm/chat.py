"""Chat formatting by schema fingerprints, in DataFrame functions only.

Records come in many layouts: one row per turn, lists of messages, prompt and answer columns.
The nested field paths of a layout are hashed; the hash selects a declarative ``Mapping`` that
turns the record into canonical turns (role, text). A typed table has one fingerprint, from its
schema; a table of JSON texts has one per record. Turns are written with a template whose
control strings cannot occur inside a text, with a mask of what a model is trained on, and can
be read back exactly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

START, END = "<|im_start|>", "<|im_end|>"
TURNS = "array<struct<role: string, text: string>>"


@dataclass(frozen=True)
class Mapping:
    """How records with the nested field paths ``paths`` (and any of ``optional``) become turns.

    ``rows``: (order, role, text) of a table with one row per turn. ``items``: (list, role,
    text) of a list of messages. ``fields``: (role, paths) of single turns; the paths that hold
    a text are joined by an empty line, and a turn without any is left out.
    """

    name: str
    paths: tuple[str, ...]
    optional: tuple[str, ...] = ()
    rows: tuple[str, str, str] | None = None
    items: tuple[str, str, str] | None = None
    fields: tuple[tuple[str, tuple[str, ...]], ...] = ()


#: Names of one role in different layouts.
ROLES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}

#: The first that fits is taken, where a table fits several.
MAPPINGS = (
    Mapping("turn_rows", ("conv_id", "turn", "role", "text"), rows=("turn", "role", "text")),
    Mapping("messages", ("messages[].role", "messages[].content"), items=("messages", "role", "content")),
    Mapping("conversations", ("conversations[].from", "conversations[].value"), items=("conversations", "from", "value")),
    Mapping("dialogue", ("dialogue.turns[].speaker", "dialogue.turns[].utterance"),
            items=("dialogue.turns", "speaker", "utterance")),
    Mapping("instruction", ("instruction", "output"), ("input", "system"),
            fields=(("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",)))),
    Mapping("completion", ("prompt", "completion"), ("system",),
            fields=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("completion",)))),
    Mapping("response", ("prompt", "response"), ("system",),
            fields=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",)))),
    Mapping("nested_prompt", ("prompt.text", "response.text"),
            fields=(("user", ("prompt.text",)), ("assistant", ("response.text",)))),
    Mapping("question", ("question", "answer"), ("context",),
            fields=(("user", ("context", "question")), ("assistant", ("answer",)))),
)


def fingerprint(paths: Iterable[str]) -> str:
    """Hash of a set of nested field paths."""
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


def fingerprints(mapping: Mapping) -> list[str]:
    """Hashes of the path sets that a mapping takes: its paths and any of the optional ones."""
    some = (c for k in range(len(mapping.optional) + 1) for c in combinations(mapping.optional, k))
    return [fingerprint((*mapping.paths, *more)) for more in some]


def schema_paths(kind: DataType, path: str = "") -> list[str]:
    """Nested field paths of the values in a type; ``[]`` stands for the elements of a list."""
    if isinstance(kind, StructType):
        return [p for f in kind for p in schema_paths(f.dataType, f"{path}.{f.name}" if path else f.name)]
    if isinstance(kind, ArrayType):
        return schema_paths(kind.elementType, f"{path}[]")
    return [path]


def mapping_of(schema: StructType, mappings: Iterable[Mapping] = MAPPINGS) -> Mapping:
    """The mapping whose fingerprint a table's schema has. Paths that no part of a mapping
    names are other columns and don't count."""
    paths = set(schema_paths(schema))
    for m in mappings:
        if fingerprint(paths & {*m.paths, *m.optional}) in fingerprints(m):
            return m
    raise ValueError(f"no mapping has these paths: {', '.join(sorted(paths))}")


def _named(role: Column) -> Column:
    out = role
    for alias, name in ROLES.items():
        out = F.when(role == alias, name).otherwise(out)
    return out


def _turns(m: Mapping, value, items) -> Column:
    """The turns of a record. ``value(path)``: a text of it; ``items(path, role, text)``: a list
    of (role, text) of it."""
    if m.items:
        listed = F.coalesce(items(*m.items), F.array().cast(TURNS))
        return F.transform(listed, lambda x: F.struct(_named(x["role"]).alias("role"), x["text"].alias("text")))
    one = [F.when(F.coalesce(*map(value, paths)).isNotNull(),
                  F.struct(F.lit(role).alias("role"), F.concat_ws("\n\n", *map(value, paths)).alias("text")))
           for role, paths in m.fields]
    return F.filter(F.array(*one), lambda x: x.isNotNull())


def _clean(turns: Column) -> Column:
    """NULL roles and texts are empty."""
    return F.transform(turns, lambda x: F.struct(
        F.coalesce(x["role"], F.lit("")).alias("role"), F.coalesce(x["text"], F.lit("")).alias("text")))


def canonical(records: DataFrame, conv_id: str = "conv_id") -> DataFrame:
    """(conv_id, turns) of a table in any known layout; other columns are ignored.

    Rows of turns are put together by ``conv_id`` (NULL is an id) in the order of their turn,
    ties by role and text, NULL first; repeated rows are turns of their own. Every other layout
    has one conversation per row, which is not shuffled. A conversation without turns has an
    empty list; an empty table gives no rows.
    """
    m = mapping_of(records.schema)
    if m.rows:
        turn, role, text = (F.col(c) for c in m.rows)
        rows = records.select(
            F.col(conv_id).alias("conv_id"), F.struct(
                turn.alias("turn"), F.coalesce(role.cast("string"), F.lit("")).alias("role"),
                F.coalesce(text.cast("string"), F.lit("")).alias("text")).alias("t"))
        whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
        return whole.select("conv_id", F.transform("turns", lambda t: t.dropFields("turn")).alias("turns"))
    there = set(schema_paths(records.schema))

    def value(path):
        return F.col(path).cast("string") if path in there else F.lit(None).cast("string")

    def items(path, role, text):
        return F.transform(F.col(path), lambda x: F.struct(
            x[role].cast("string").alias("role"), x[text].cast("string").alias("text")))

    return records.select(F.col(conv_id).alias("conv_id"), _clean(_turns(m, value, items)).alias("turns"))


def _shape_paths(shape: Column) -> Column:
    """Nested field paths in the text of a variant's schema, such as
    ``OBJECT<a: ARRAY<OBJECT<b: STRING>>>``: names and brackets are folded over a stack."""
    tokens = F.regexp_extract_all(shape, F.lit(r"([^<>,: ][^<>,:]*: |OBJECT<|ARRAY<|>|[A-Z_]+(?:\([0-9, ]+\))?)"), F.lit(1))
    state = F.struct(F.array().cast("array<string>").alias("open"), F.array().cast("array<string>").alias("paths"))

    def closed(stack):  # what a value ends: the name it belongs to
        return F.when(F.startswith(F.element_at(stack, -1), F.lit(".")), F.slice(stack, 1, F.size(stack) - 1)).otherwise(stack)

    def step(s, token):
        opened = F.when(token == "OBJECT<", F.lit("")).when(token == "ARRAY<", F.lit("[]")).when(
            token.endswith(": "), F.concat(F.lit("."), F.regexp_replace(token, ": $", "")))
        dropped = F.when(F.size(s["open"]) > 0, F.slice(s["open"], 1, F.size(s["open"]) - 1)).otherwise(s["open"])
        stack = F.when(opened.isNotNull(), F.concat(s["open"], F.array(opened))).when(
            token == ">", F.when(F.size(dropped) > 0, closed(dropped)).otherwise(dropped)).otherwise(
            F.when(F.size(s["open"]) > 0, closed(s["open"])).otherwise(s["open"]))
        here = F.regexp_replace(F.array_join(s["open"], ""), r"^\.", "")
        paths = F.when(opened.isNotNull() | (token == ">"), s["paths"]).otherwise(F.concat(s["paths"], F.array(here)))
        return F.struct(stack.alias("open"), paths.alias("paths"))

    return F.array_distinct(F.aggregate(tokens, state, step, lambda s: s["paths"]))


def canonical_json(records: DataFrame, json: str = "json", conv_id: str = "conv_id") -> DataFrame:
    """(conv_id, layout, turns) of a table whose records are JSON texts of mixed layouts. The
    fingerprint of each record selects its mapping; a record that fits none, NULL or broken
    JSON has a NULL layout and no turns. Mappings of single rows per turn are for tables."""
    parsed = records.select(F.col(conv_id).alias("conv_id"), F.try_parse_json(F.col(json)).alias("v"))
    shaped = parsed.withColumn("paths", _shape_paths(F.schema_of_variant("v")))
    usable = [m for m in MAPPINGS if not m.rows]

    def fits(m):
        own = F.array_sort(F.array_intersect("paths", F.array(*map(F.lit, (*m.paths, *m.optional)))))
        return F.sha2(F.array_join(own, "\n"), 256).isin(fingerprints(m))

    def value(path):
        return F.try_variant_get("v", f"$.{path}", "string")

    def items(path, role, text):
        listed = F.try_variant_get("v", f"$.{path}", f"array<struct<`{role}`: string, `{text}`: string>>")
        return F.transform(listed, lambda x: F.struct(x[role].alias("role"), x[text].alias("text")))

    named = shaped.withColumn("layout", F.coalesce(*(F.when(fits(m), m.name) for m in usable)))
    turns = F.coalesce(*(F.when(F.col("layout") == m.name, _turns(m, value, items)) for m in usable), F.array().cast(TURNS))
    return named.select("conv_id", "layout", _clean(turns).alias("turns"))


def escape(text: Column) -> Column:
    """Break up what could be read as a control string: ``<|`` becomes ``<\\|``, ``<\\|``
    becomes ``<\\\\|`` and so on. No result holds ``<|``."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", "<$1|")


def _head(role: Column) -> Column:
    """A role stands on the line of its marker, so its line breaks are control strings."""
    return F.concat(F.lit(START), F.replace(escape(role), F.lit("\n"), F.lit("<|nl|>")), F.lit("\n"))


def format_chats(conversations: DataFrame, trained: str = "assistant") -> DataFrame:
    """Adds ``formatted``, the turns with their markers, and ``mask``, per turn its ``length``
    in code points and the range ``loss_from`` to ``loss_to`` (from its start, end exclusive)
    that a model is trained on: the text of each turn of the role ``trained``, nothing else."""
    parts = F.transform("turns", lambda t: F.struct(
        _head(t["role"]).alias("head"), escape(t["text"]).alias("body"), (t["role"] == trained).alias("own")))
    tail = f"{END}\n"
    staged = conversations.withColumn("__parts", parts)
    formatted = F.array_join(F.transform("__parts", lambda p: F.concat(p["head"], p["body"], F.lit(tail))), "")

    def mask(p):
        head, body = F.length(p["head"]), F.length(p["body"])
        return F.struct((head + body + len(tail)).alias("length"), head.alias("loss_from"),
                        (head + F.when(p["own"], body).otherwise(0)).alias("loss_to"))

    return staged.withColumns({"formatted": formatted, "mask": F.transform("__parts", mask)}).drop("__parts")


def read_back(formatted: DataFrame) -> DataFrame:
    """Adds what the output says: ``read_turns`` (role, text) and ``loss_text``, all text under
    the mask, unescaped. Markers are unambiguous, so the text is cut at them."""
    cut = F.split("formatted", START.replace("|", r"\|"), -1)
    pieces = F.transform(F.slice(cut, 2, F.size(cut) - 1), lambda p: F.concat(F.lit(START), p))
    out = formatted.withColumn("__pieces", F.arrays_zip(pieces.alias("text"), F.col("mask")))

    def turn(p):
        head = F.substring_index(p["text"], "\n", 1)
        role = F.substr(head, F.lit(len(START) + 1))
        at = F.length(head) + 1
        body = F.substr(p["text"], at + 1, F.length(p["text"]) - at - len(END) - 1)
        return F.struct(unescape(F.replace(role, F.lit("<|nl|>"), F.lit("\n"))).alias("role"), unescape(body).alias("text"))

    def under(p):
        return unescape(F.substr(p["text"], p["mask"]["loss_from"] + 1, p["mask"]["loss_to"] - p["mask"]["loss_from"]))

    return out.withColumns({
        "read_turns": F.transform("__pieces", turn),
        "loss_text": F.array_join(F.transform("__pieces", under), ""),
    }).drop("__pieces")
