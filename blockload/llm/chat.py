"""Chat formatting (operator 4): heterogeneous records to canonical turns, and
turns to training text with a loss mask.

Layouts are told apart by **schema fingerprint**: a digest of the nested field
paths of a record (names and nesting, no types or values). Each known
fingerprint selects a declarative mapping, a list of rules saying which path
holds which role's text; adding a layout means adding a mapping.

The template writes a turn as ``<s>role``, a line feed, the text, ``</s>`` and
a line feed. Control strings inside roles and texts are escaped by putting a
backslash after their first character (and one more where there are already
some), which is undone exactly on reading.

Everything is a built-in expression; the only shuffle brings the rows of one
conversation together, and a conversation is one text by definition.

Defined results: a null text or role is empty; rows are ordered by turn
(nulls first), then role, then text; a record whose fingerprint is unknown
gets null turns and layout ``unknown`` and is kept; records are taken column
by column, so extra columns play no part.
"""

from __future__ import annotations

import dataclasses

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURNS = "array<struct<role:string,text:string>>"
ASSISTANT = "assistant"

# The strings with a meaning in the template or in common chat
# templates, which never stand unescaped in a formatted text's content.
BEGIN, END = "<s>", "</s>"
CONTROL = r"(<|\[)(\\*)(/?(?:s>|INST\]|SYS\]))"
ESCAPED = r"(<|\[)\\(\\*)(/?(?:s>|INST\]|SYS\]))"

# Role names of known layouts and what they mean.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


@dataclasses.dataclass(frozen=True)
class Field:
    """A turn of ``role`` whose text is the named fields joined by blank
    lines; without any non-empty field there is no turn."""

    role: str
    names: tuple[str, ...]


@dataclasses.dataclass(frozen=True)
class Items:
    """One turn for each item of the list ``name``."""

    name: str
    role: str
    text: str
    renamed: bool = False      # role names are those of ROLES


@dataclasses.dataclass(frozen=True)
class Mapping:
    name: str
    shape: str                 # the nested field paths, as paths_of() gives them
    rules: tuple[Field | Items, ...]


def _flat(name: str, *rules: Field) -> Mapping:
    fields = sorted({n for r in rules for n in r.names})
    return Mapping(name, f"OBJECT<{', '.join(fields)}>", rules)


MAPPINGS = (
    Mapping("messages", "OBJECT<messages: ARRAY<OBJECT<content, role>>>", (Items("messages", "role", "content"),)),
    Mapping("sharegpt", "OBJECT<conversations: ARRAY<OBJECT<from, value>>>",
            (Items("conversations", "from", "value", True),)),
    Mapping("turns", "OBJECT<turns: ARRAY<OBJECT<role, text>>>", (Items("turns", "role", "text"),)),
    _flat("prompt", Field("user", ("prompt",)), Field(ASSISTANT, ("response",))),
    _flat("completion", Field("user", ("prompt",)), Field(ASSISTANT, ("completion",))),
    _flat("question", Field("user", ("question",)), Field(ASSISTANT, ("answer",))),
    _flat("instruction", Field("user", ("instruction",)), Field(ASSISTANT, ("output",))),
    _flat("alpaca", Field("user", ("instruction", "input")), Field(ASSISTANT, ("output",))),
    _flat("system_prompt", Field("system", ("system",)), Field("user", ("prompt",)), Field(ASSISTANT, ("response",))),
)


def paths_of(record: Column) -> Column:
    """Nested field paths of a variant: its schema without the leaf types."""
    shape = F.schema_of_variant(record)
    kind = r"[A-Z]+(?:\([0-9, ]*\))?"
    leaf = rf": (?:ARRAY<{kind}>|{kind})(?=, |>|$)"
    return F.regexp_replace(shape, leaf, "")


def fingerprint(record: Column) -> Column:
    return F.sha2(paths_of(record), 256)


def _role(role: Column, renamed: bool) -> Column:
    known = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])
    return F.coalesce(known[role], role, F.lit("")) if renamed else F.coalesce(role, F.lit(""))


def _rule(record: Column, rule: Field | Items) -> Column:
    if isinstance(rule, Items):
        kind = f"array<struct<`{rule.role}`:string,`{rule.text}`:string>>"
        items = F.try_variant_get(record, f"$.{rule.name}", kind)
        return F.transform(items, lambda x: F.struct(
            _role(x[rule.role], rule.renamed).alias("role"), F.coalesce(x[rule.text], F.lit("")).alias("text")))
    parts = [F.try_variant_get(record, f"$.{n}", "string") for n in rule.names]
    text = F.array_join(F.filter(F.array(*parts), lambda x: x.isNotNull() & (x != "")), "\n\n")
    turn = F.array(F.struct(F.lit(rule.role).alias("role"), text.alias("text")))
    if len(rule.names) == 1 or rule.role == ASSISTANT:
        return turn
    return F.when(text != "", turn).otherwise(F.array().cast(TURNS))


def canonical_turns(records: DataFrame, record: str = "record", mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """``records`` with fingerprint, layout and turns, from the variant column
    ``record`` (see ``parse_json`` and ``to_variant_object``)."""
    col = F.col(f"`{record}`")
    keep = [F.col(f"`{c}`") for c in records.columns if c.lower() not in ("fingerprint", "layout", "turns", "_shape")]
    out = records.select(*keep, fingerprint(col).alias("fingerprint"))
    layout, turns = F.lit("unknown"), F.lit(None).cast(TURNS)
    for m in reversed(mappings):
        hit = F.col("fingerprint") == F.sha2(F.lit(m.shape), 256)
        made = [_rule(col, r).cast(TURNS) for r in m.rules]
        layout = F.when(hit, m.name).otherwise(layout)
        turns = F.when(hit, made[0] if len(made) == 1 else F.concat(*made)).otherwise(turns)
    return out.withColumn("layout", layout).withColumn("turns", turns)


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def _escape_role(role: Column) -> Column:
    return F.replace(F.replace(escape(role), F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A"))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(F.replace(role, F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%")))


def format_turns(records: DataFrame) -> DataFrame:
    """``records`` with ``formatted`` and ``loss_spans``, the code point ranges
    (start, end) of the assistant's texts in it."""
    written = F.transform("turns", lambda t: F.struct(
        t["role"].alias("role"), F.concat(F.lit(BEGIN), _escape_role(t["role"]), F.lit("\n")).alias("head"),
        escape(t["text"]).alias("body")))
    tail = END + "\n"
    out = records.withColumn("_w", written)
    out = out.withColumn("formatted", F.array_join(
        F.transform("_w", lambda w: F.concat(w["head"], w["body"], F.lit(tail))), ""))
    state = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,loss:boolean>>").alias("s"))

    def step(acc: Column, w: Column) -> Column:
        start = acc["at"] + F.length(w["head"])
        end = start + F.length(w["body"])
        span = F.struct(start.alias("start"), end.alias("end"), (w["role"] == ASSISTANT).alias("loss"))
        return F.struct((end + len(tail)).alias("at"), F.concat(acc["s"], F.array(span)).alias("s"))

    spans = F.aggregate("_w", state, step, lambda acc: acc["s"])
    return out.withColumn("loss_spans", F.transform(
        F.filter(spans, lambda s: s["loss"]),
        lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))).drop("_w")


def read_back(formatted: Column) -> Column:
    """The turns of a formatted text."""
    parts = F.filter(F.split(formatted, END + "\n"), lambda p: p != "")
    return F.transform(parts, lambda p: F.struct(
        _unescape_role(F.substring_index(F.substr(p, F.lit(len(BEGIN) + 1)), "\n", 1)).alias("role"),
        unescape(F.substr(p, F.locate("\n", p) + 1)).alias("text")))


def masked_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped text by text."""
    return F.array_join(F.transform(spans, lambda s: unescape(
        F.substr(formatted, s["start"] + 1, s["end"] - s["start"]))), "")


def conversation_records(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) rows as one record per conversation."""
    message = F.struct(F.coalesce("text", F.lit("")).alias("content"), F.coalesce("role", F.lit("")).alias("role"))
    ordered = F.array_sort(F.collect_list(F.struct(
        F.col("turn").isNotNull().alias("t0"), "turn", F.coalesce("role", F.lit("")).alias("r"),
        F.coalesce("text", F.lit("")).alias("x"), message.alias("message"))))
    grouped = rows.groupBy("conv_id").agg(F.transform(ordered, lambda o: o["message"]).alias("messages"))
    return grouped.select("conv_id", F.to_variant_object(F.struct("messages")).alias("record"))
