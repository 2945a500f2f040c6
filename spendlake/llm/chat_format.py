"""Chat formatting by schema fingerprints; DataFrame functions only.

Records are JSON texts of unlike layouts, or typed structs. The nested field paths of a record are
hashed, and the hash selects a declarative mapping that turns the layout into canonical turns (role,
text); a typed record has its paths from the schema and is not written as JSON in between. Turns
are written as ``<turn>role\\ntext</turn>\\n``. Inside roles and texts the control strings are
escaped: ``\\`` is written ``\\b``, ``<turn>`` ``\\o``, ``</turn>`` ``\\c`` and, in roles, a line end ``\\n``;
since every backslash then begins one of these, replacing them back in the opposite order restores
the text exactly. The output has the formatted text and its segments, of which those with ``loss``
(the texts of assistants) are what a model is trained on.

Defined cases: a null text or role is empty; a record that is no JSON or has an unknown layout
has no turns, an empty formatted text and a null layout; empty tables give empty results; each
record is formatted by itself, so repeated rows give repeated results. A conversation is one
output text, so its turns have to meet in one row. Spark's parser reads JSON texts of at most
``JSON_CHARS`` characters a value; a longer record that it can't read has the status ``too large``.
"""
from __future__ import annotations

import hashlib
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ESCAPES = (("\\", "\\b"), ("<turn>", "\\o"), ("</turn>", "\\c"))
OPEN, CLOSE = "<turn>", "</turn>\n"
JSON_CHARS = 20_000_000
TURN = "struct<role: string, text: string>"
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


class Layout(NamedTuple):
    """``sample`` shows the field paths; ``schema`` reads the record; ``many`` names an array with
    its role and text fields, ``fixed`` lists (role, fields) whose texts are joined by an empty line."""
    name: str
    sample: str
    schema: str
    many: tuple[str, str, str] | None = None
    fixed: tuple[tuple[str, tuple[str, ...]], ...] = ()


LAYOUTS = (
    Layout("messages", '{"messages":[{"role":"","content":""}]}',
           "messages array<struct<role string, content string>>", many=("messages", "role", "content")),
    Layout("conversations", '{"conversations":[{"from":"","value":""}]}',
           "conversations array<struct<`from` string, value string>>", many=("conversations", "from", "value")),
    Layout("instruction", '{"instruction":"","input":"","output":""}',
           "instruction string, input string, output string", fixed=(("user", ("instruction", "input")), ("assistant", ("output",)))),
    Layout("instruction_only", '{"instruction":"","output":""}',
           "instruction string, output string", fixed=(("user", ("instruction",)), ("assistant", ("output",)))),
    Layout("prompt", '{"prompt":"","completion":""}',
           "prompt string, completion string", fixed=(("user", ("prompt",)), ("assistant", ("completion",)))),
    Layout("prompt_response", '{"prompt":"","response":""}',
           "prompt string, response string", fixed=(("user", ("prompt",)), ("assistant", ("response",)))),
    Layout("system_prompt", '{"system":"","prompt":"","response":""}', "system string, prompt string, response string",
           fixed=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",)))),
    Layout("nested_prompt", '{"prompt":{"system":"","user":""},"response":""}',
           "prompt struct<system string, user string>, response string",
           fixed=(("system", ("prompt.system",)), ("user", ("prompt.user",)), ("assistant", ("response",)))),
)


def fingerprint(record: Column) -> Column:
    """Digest of a record's nested field paths, whatever the types of the values."""
    paths = F.schema_of_variant(F.try_parse_json(record))
    return F.sha2(F.regexp_replace(paths, r"(: |<)(STRING|BIGINT|DOUBLE|BOOLEAN|VOID|DECIMAL\([0-9, ]*\))", "$1"), 256)


def paths_of(kind: T.DataType) -> str:
    """The field paths of a type, as ``fingerprint`` sees those of a record."""
    if isinstance(kind, T.StructType):
        return "OBJECT<" + ", ".join(f"{f.name}: {paths_of(f.dataType)}" for f in sorted(kind.fields, key=lambda f: f.name)) + ">"
    return f"ARRAY<{paths_of(kind.elementType)}>" if isinstance(kind, T.ArrayType) else ""


def typed_fingerprint(kind: T.DataType) -> str:
    """``fingerprint`` of the records of a type."""
    return hashlib.sha256(paths_of(kind).encode()).hexdigest()


def escaped(text: Column) -> Column:
    for plain, code in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescaped(text: Column) -> Column:
    for plain, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def _escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit("\\n"))


def _unescaped_role(role: Column) -> Column:
    return unescaped(F.replace(role, F.lit("\\n"), F.lit("\n")))


def _made(read: Column, x: Layout) -> Column:
    """The turns of a record read in the layout ``x``."""
    if x.many:
        array, role, text = x.many
        made = F.transform(read[array], lambda t: F.struct(F.coalesce(t[role], F.lit("")).alias("role"), F.coalesce(t[text], F.lit("")).alias("text")))
        for old, new in ROLES.items() if role == "from" else ():
            made = F.transform(made, lambda t: F.struct(F.when(t["role"] == old, F.lit(new)).otherwise(t["role"]).alias("role"), t["text"].alias("text")))
    else:
        def field(path: str) -> Column:
            value = read
            for part in path.split("."):
                value = value[part]
            return F.nullif(value, F.lit(""))
        made = F.array(*[F.struct(F.lit(role).alias("role"), F.concat_ws("\n\n", *[field(p) for p in paths]).alias("text")) for role, paths in x.fixed])
    return made.cast(f"array<{TURN}>")


def canonical_turns(record: Column, layouts: tuple[Layout, ...] = LAYOUTS, kind: T.DataType | None = None) -> tuple[Column, Column]:
    """The layout's name and its turns, chosen by fingerprint; ``kind``: type of a record that is no JSON text."""
    name, turns = F.lit(None).cast("string"), F.lit(None).cast(f"array<{TURN}>")
    typed = kind is not None and not isinstance(kind, T.StringType)
    own = None if typed else fingerprint(record)
    for x in reversed(layouts):
        if typed:
            if typed_fingerprint(kind) == typed_fingerprint(T._parse_datatype_string(x.schema)):
                there = record.isNotNull()
                name, turns = F.when(there, F.lit(x.name)), F.when(there, _made(record, x))
            continue
        fits = own == fingerprint(F.lit(x.sample))
        made = _made(F.from_json(record, x.schema, {"maxStringLen": str((1 << 31) - 1)}), x)
        name, turns = F.when(fits, F.lit(x.name)).otherwise(name), F.when(fits, made).otherwise(turns)
    return name, F.coalesce(turns, F.array().cast(f"array<{TURN}>"))


def segments(turns: Column) -> Column:
    """Pieces of the formatted text; ``loss`` marks the texts of assistants."""
    piece = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    return F.flatten(F.transform(turns, lambda t: F.array(
        piece(F.concat(F.lit(OPEN), _escaped_role(t["role"]), F.lit("\n")), F.lit(False)),
        piece(escaped(t["text"]), t["role"] == "assistant"),
        piece(F.lit(CLOSE), F.lit(False)))))


def format_chat(records: DataFrame, record: str = "record", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns with layout, status (``ok``, ``no layout``, ``too large``), formatted text and segments of every record."""
    keep = [c for c in (records.columns if keep is None else keep) if c not in ("layout", "status", "turns", "segments", "formatted")]
    kind = records.schema[record].dataType
    name, turns = canonical_turns(F.col(record), kind=kind)
    unread = F.lit(False)
    if isinstance(kind, T.StringType):
        unread = (F.length(record) > JSON_CHARS) & F.try_parse_json(F.col(record)).isNull()
    status = F.when(name.isNotNull(), F.lit("ok")).when(unread, F.lit("too large")).otherwise(F.lit("no layout"))
    out = records.select(*keep, name.alias("layout"), status.alias("status"), segments(turns).alias("segments"))
    return out.select(*keep, "layout", "status", F.array_join("segments.text", "").alias("formatted"), "segments")


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text."""
    parts = F.split(formatted, F.lit("</turn>\n"))
    body = F.transform(F.slice(parts, F.lit(1), F.size(parts) - 1), lambda p: F.substr(p, F.lit(len(OPEN) + 1)))
    return F.transform(body, lambda p: F.struct(_unescaped_role(F.substring_index(p, "\n", 1)).alias("role"),
                                                unescaped(F.substr(p, F.instr(p, F.lit("\n")) + 1)).alias("text")))


def records_of_turns(rows: DataFrame, key: str = "conv_id") -> DataFrame:
    """One typed record (``messages`` layout) per conversation from rows by turn; ties go by role and text."""
    turn = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("content"))
    out = rows.groupBy(key).agg(F.array_sort(F.collect_list(turn)).alias("t"))
    message = lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content"))
    return out.select(key, F.struct(F.transform("t", message).alias("messages")).alias("record"))


def chat_digests(formatted: DataFrame, key: str = "conv_id") -> DataFrame:
    """Counts and digests read back from the formatted text and its loss segments."""
    turns = read_turns(F.col("formatted"))
    line = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = unescaped(F.array_join(F.filter("segments", lambda s: s["loss"])["text"], ""))
    return formatted.select(key, F.size(turns).cast("long").alias("n_turns"), F.sha2(line, 256).alias("turns_sha256"),
                            F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
                            F.length("formatted").cast("long").alias("formatted_chars"))
