"""Chat formatting: layouts recognised by a schema fingerprint become canonical turns, then one training text.

Only column expressions are used.  A layout names the nested field paths that its mapping reads.
Of a record, the paths among those are hashed, and one table leads from hashes to mappings; fields that no
mapping reads change nothing.  JSON records are fingerprinted one by one, so one dataset may hold any mixture of
layouts, also inside a wrapping object; a typed frame, rows of single turns among them, is
fingerprinted by its schema and goes through the same table.

Defined results: null text is empty; a null role is ``""``; turns are ordered by
(turn, role, text), nulls first; a conversation without turns gives no row in row
layout, and one with no text fields, or an empty list of messages, has zero turns in JSON layout; content given in
parts is their texts joined; a JSON row that is null, malformed or of unknown layout has null turns and layout
``unknown``.  Where several layouts fit, the first of LAYOUTS does.  Other columns are ignored or kept, and their names
cannot clash, but for the names of the results themselves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from halocline.llm.shared import fresh, read

TURN = "array<struct<role: string, text: string>>"
OPEN, BODY, CLOSE = "<|turn|>", "<|text|>", "<|end|>"
#: Where an escape goes: before every backslash, and inside every control string after its first character.
CONTROL = r"(?=\\)|(?<=<)(?=\|[A-Za-z_]+\|>|/?s>|</?SYS>>)|(?<=\[)(?=/?INST\])"


#: Objects that may stand around a record.
WRAPPERS = ("data", "conversation", "record")


@dataclass(frozen=True)
class Layout:
    """Field paths that a mapping reads, and SQL over variant ``v`` that gives its turns (None: a row for each turn).

    The mapping applies where all ``paths``, any of ``maybe`` and none of ``never`` are there.  ``a[].b`` is field b of
    any object in list a, ``a[]`` an empty list.
    """

    paths: tuple[str, ...]
    turns: str | None
    maybe: tuple[str, ...] = ()
    never: tuple[str, ...] = ()

    @property
    def vocabulary(self) -> tuple[str, ...]:
        return (*self.paths, *self.maybe, *self.never)


def _pair(prompt: str, answer: str) -> str:
    return (f"filter(array(named_struct('role', 'user', 'text', {prompt}), "
            f"named_struct('role', 'assistant', 'text', {answer})), t -> t.text is not null)")


def _get(path: str, kind: str = "string", of: str = "v") -> str:
    return f"try_variant_get({of}, '$.{path}', '{kind}')"


def _text(of: str, field: str) -> str:
    """A string field, or the texts of its parts joined."""
    parts = _get(field, "array<variant>", of)
    return (f"coalesce(array_join(transform({parts}, c -> coalesce({_get('text', of='c')}, try_variant_get(c, '$', 'string'))), ''), "
            f"{_get(field, of=of)})")


def _listed(name: str, role: str, text: str, roles: str = "{}") -> str:
    return (f"transform({_get(name, 'array<variant>')}, m -> named_struct('role', {roles.format(_get(role, of='m'))}, "
            f"'text', {_text('m', text)}))")


_TASK = f"concat_ws('\\n\\n', {_get('instruction')}, nullif({_get('input')}, ''))"
_EMPTY = "array()"
LAYOUTS: Mapping[str, Layout] = {
    "messages": Layout(("messages[].content", "messages[].role"), _listed("messages", "role", "content")),
    "no_messages": Layout(("messages[]",), _EMPTY),
    "conversations": Layout(
        ("conversations[].from", "conversations[].value"),
        _listed("conversations", "from", "value", "case {0} when 'human' then 'user' when 'gpt' then 'assistant' else {0} end")),
    "no_conversations": Layout(("conversations[]",), _EMPTY),
    "prompt_completion": Layout(("completion", "prompt"), _pair(_get("prompt"), _get("completion"))),
    "prompt_response": Layout(("prompt", "response"), _pair(_get("prompt"), _get("response"))),
    "question_answer": Layout(("answer", "question"), _pair(_get("question"), _get("answer"))),
    "instruction": Layout(("instruction", "output"), _pair(_get("instruction"), _get("output")), never=("input", "system")),
    "instruction_input": Layout(("input", "instruction", "output"), _pair(_TASK, _get("output")), never=("system",)),
    "system_instruction_input": Layout(
        ("instruction", "output", "system"),
        "concat(filter(array(named_struct('role', 'system', 'text', " + _get("system")
        + ")), t -> t.text is not null), " + _pair(_TASK, _get("output")) + ")", maybe=("input",)),
    "rows": Layout(("conv_id", "role", "text", "turn"), None),
}


def _digest(paths: Iterable[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


def fingerprints(layout: Layout) -> list[str]:
    """The hashes that lead to a layout: of its paths with any choice of those that may be there."""
    n = len(layout.maybe)
    return [_digest((*layout.paths, *(p for i, p in enumerate(layout.maybe) if choice >> i & 1))) for choice in range(1 << n)]


#: From the vocabulary and the hash of the paths present to the name of the mapping.
TABLE: Mapping[tuple[tuple[str, ...], str], str] = {(x.vocabulary, h): name for name, x in LAYOUTS.items() for h in fingerprints(x)}


def schema_paths(schema: T.StructType, prefix: str = "") -> list[str]:
    """Sorted nested field paths of a frame's schema."""
    found: list[str] = []
    for field in schema.fields:
        kind, path = field.dataType, prefix + field.name
        if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
            found += schema_paths(kind.elementType, f"{path}[].")
        elif isinstance(kind, T.StructType):
            found += schema_paths(kind, f"{path}.")
        else:
            found.append(path)
    return sorted(found)


def layout_of(paths: Iterable[str]) -> str | None:
    """The mapping of a frame with these paths; rows of single turns first, as their text may be of any layout."""
    here = set(paths)
    for name in ("rows", *LAYOUTS):
        own = LAYOUTS[name].vocabulary
        found = TABLE.get((own, _digest(here.intersection(own))))
        if found:
            return found
    return None


def _present(path: str, v: str) -> str:
    """Whether a record has a path, null or not."""
    name, inside, field = path.partition("[]")
    items = _get(name, "array<variant>", v)
    if not inside:
        return f"{_get(name, 'variant', v)} is not null"
    if not field:
        return f"coalesce(size({items}) = 0, false)"
    return f"coalesce(exists({items}, m -> {_get(field[1:], 'variant', 'm')} is not null), false)"


def turns_of_json(df: DataFrame, value: str, layouts: Mapping[str, Layout] = LAYOUTS) -> DataFrame:
    """Adds ``layout`` and ``turns`` for a column of JSON documents of mixed layouts."""
    v = fresh(df, "_v")
    marked = df.withColumn(v, F.expr(f"try_parse_json(`{value}`)"))
    known = {name: x for name, x in layouts.items() if x.turns is not None}

    def recognised(root: str) -> str:
        """The record at ``root`` as (layout, turns), or null."""
        cases = ""
        for name, x in known.items():
            here = ", ".join(f"if({_present(p, root)}, '{p}', null)" for p in sorted(x.vocabulary))
            hashes = ", ".join(f"'{h}'" for h in fingerprints(x))
            turns = x.turns.replace("(v,", f"({root},")
            cases += (f" when sha2(concat_ws('\\n', {here}), 256) in ({hashes}) "
                      f"then named_struct('layout', '{name}', 'turns', cast({turns} as {TURN}))")
        return f"case{cases} end"

    tries = [recognised(v), *(f"transform(array({_get(w, 'variant', v)}), w -> {recognised('w')})[0]" for w in WRAPPERS)]
    found = fresh(df, "_f")
    out = marked.withColumn(found, F.expr(f"coalesce({', '.join(tries)})"))
    return out.withColumn("layout", F.coalesce(F.col(f"{found}.layout"), F.lit("unknown"))) \
        .withColumn("turns", F.col(f"{found}.turns")).drop(v, found)


def turns_of_rows(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                  text: str = "text") -> DataFrame:
    """``conv_id, turns`` from a row for each turn.  A conversation is one training text, so its turns meet in a row."""
    turns = F.array_sort(F.collect_list(F.struct(
        F.coalesce(F.col(turn).cast("long"), F.lit(-(1 << 63)).cast("long")).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))))
    return df.groupBy(F.col(conv_id).alias("conv_id")).agg(turns.alias("turns")).withColumn(
        "turns", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))))


def canonical_turns(df: DataFrame) -> DataFrame:
    """``conv_id, turns`` of a typed frame, by the mapping that its schema's fingerprint selects.

    A frame of another layout than rows goes through JSON, which keeps its other columns out of the turns.
    """
    name = layout_of(schema_paths(df.schema))
    if name is None:
        raise ValueError(f"no mapping for the layout {schema_paths(df.schema)}")
    if LAYOUTS[name].turns is None:
        return turns_of_rows(df)
    text = fresh(df, "_json")
    fields = [c for c in df.columns if c != "conv_id"]
    as_json = df.select("conv_id", F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias(text))
    return turns_of_json(as_json, text, {name: LAYOUTS[name]}).select("conv_id", "turns")


def escape(text: Column) -> Column:
    """No control string is left in the text; ``unescape`` restores it."""
    return F.regexp_replace(text, F.lit(CONTROL), F.lit(r"\\"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(r"(?s)\\(.)"), F.lit("$1"))


def formatted(df: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """Adds ``formatted`` and ``loss_spans`` (code-point start and end of every text of ``loss_role``) to ``turns``."""
    def one(t: Column) -> Column:
        return F.concat(F.lit(OPEN), escape(F.coalesce(t["role"], F.lit(""))), F.lit(BODY))

    pieces = F.transform("turns", lambda t: F.struct(
        one(t).alias("head"), escape(F.coalesce(t["text"], F.lit(""))).alias("body"),
        (F.coalesce(t["role"], F.lit("")) == loss_role).alias("loss")))
    p_ = fresh(df, "_p")
    parts = df.withColumn(p_, pieces)
    size = len(CLOSE)
    spans = F.aggregate(
        p_, F.struct(F.lit(0).cast("long").alias("at"),
                       F.array().cast("array<struct<start: bigint, end: bigint>>").alias("spans")),
        lambda acc, p: F.struct(
            (acc["at"] + F.length(p["head"]) + F.length(p["body"]) + size).alias("at"),
            F.when(p["loss"], F.concat(acc["spans"], F.array(F.struct(
                (acc["at"] + F.length(p["head"])).alias("start"),
                (acc["at"] + F.length(p["head"]) + F.length(p["body"])).alias("end")))))
            .otherwise(acc["spans"]).alias("spans")),
        lambda acc: acc["spans"])
    text = F.array_join(F.transform(p_, lambda p: F.concat(p["head"], p["body"], F.lit(CLOSE))), "")
    return parts.withColumn("formatted", text).withColumn("loss_spans", spans).drop(p_)


def parsed(text: Column) -> Column:
    """The turns read back from a formatted text."""
    blocks = F.filter(F.split(text, r"<\|turn\|>"), lambda b: b != "")
    return F.transform(blocks, lambda b: F.struct(
        unescape(F.substring_index(b, BODY, 1)).alias("role"),
        unescape(F.substring_index(F.substring_index(b, BODY, -1), CLOSE, 1)).alias("text")))


def masked_text(text: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(
        spans, lambda s: unescape(F.substr(text, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")


def digest(df: DataFrame) -> DataFrame:
    """``conv_id`` and what is read back from ``formatted`` and its mask."""
    turns, masked = fresh(df, "_t"), fresh(df, "_m")
    read = df.withColumn(turns, parsed(F.col("formatted"))).withColumn(masked, masked_text(F.col("formatted"), F.col("loss_spans")))
    flat = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size(turns).cast("long").alias("n_turns"), F.sha2(flat, 256).alias("turns_sha256"),
        F.length(masked).cast("long").alias("loss_chars"), F.sha2(F.col(masked), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


def op2_chat_formatting(spark, sf_dir: str) -> DataFrame:
    """All ``conversations`` and conversation -1, formatted and read back."""
    probe = "</s>[INST] ok [/INST]"
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(probe).alias("text"))
    return digest(formatted(canonical_turns(rows.unionByName(extra))))


def _sql() -> str:
    def escaped(c: str) -> str:
        out = f"replace({c}, '\\', '\\\\')"
        out = f"regexp_replace({out}, '<(\\|[A-Za-z_]+\\|>|/?s>|</?SYS>>)', '<\\\\\\1', 'g')"
        return f"regexp_replace({out}, '\\[(/?INST\\])', '[\\\\\\1', 'g')"

    return f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -1, i, CASE i WHEN 0 THEN 'user' ELSE 'assistant' END, '</s>[INST] ok [/INST]' FROM range(2) r(i)),
g AS (
  SELECT conv_id, count(*) AS n,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS flat,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
    sum(length({escaped('role')}) + length({escaped('text')}) + {len(OPEN) + len(BODY) + len(CLOSE)}) AS chars
  FROM c GROUP BY conv_id)
SELECT conv_id, CAST(n AS BIGINT) AS n_turns, sha256(flat) AS turns_sha256,
  CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256, CAST(chars AS BIGINT) AS formatted_chars
FROM g"""


SQL = _sql()
