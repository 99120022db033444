"""Chat formatting: records of several layouts into one canonical, reversible text.

A record is a variant. Its fingerprint is the hash of its nested field paths, without
types and values, so that one hash names one layout; declarative mappings, chosen by
fingerprint, say where the turns are. Further fields do no harm, an empty list of turns
gives none, and a text that is not a string is its JSON. A record whose layout no mapping
knows has null turns and is kept, so that nothing is lost unseen.

Every turn becomes ``<|turn|>role<|text|>text<|end|>``. Control strings of this and of
other common templates inside a role or a text get one more backslash after their first
character; reading takes it away again, so that any text comes back whole.

Null roles and texts are empty. Rows of one conversation are ordered by turn, null first,
and ties by role and text; repeated rows stay as turns of their own. A null conversation
id is an id like others. Only the named columns are read. Empty tables give no rows.
"""

from __future__ import annotations

import functools
import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
LEARNED_ROLE = "assistant"

# Control strings are one of these openings, any backslashes, and one of these tails.
_PLAIN = r"([<\[])(\\*)(/?s>|/?SYS>>|\||/?INST\])"
_ESCAPED = r"([<\[])\\(\\*)(/?s>|/?SYS>>|\||/?INST\])"

TURNS_TYPE = "array<struct<role:string,text:string>>"


def _has(record: Column, field: str) -> Column:
    """Whether a variant has a field, be it null."""
    return F.try_variant_get(record, f"$.{field}", "variant").isNotNull()


def _text(record: Column, field: str) -> Column:
    return F.try_variant_get(record, f"$.{field}", "string")


@dataclass(frozen=True)
class ListLayout:
    """The turns are the elements of an array of objects; an empty array has none."""

    name: str
    path: str
    role: str
    text: str

    def shape(self) -> str:
        fields = ", ".join(sorted([self.role, self.text]))
        return f"OBJECT<{self.path}: ARRAY<OBJECT<{fields}>>>"

    def _elements(self, record: Column) -> Column:
        return F.try_variant_get(record, f"$.{self.path}", "array<variant>")

    def fits(self, record: Column) -> Column:
        """Whether the field paths hold those of this layout, among whatever others."""
        found = self._elements(record)
        objects = F.forall(found, lambda e: F.schema_of_variant(e).startswith("OBJECT<"))
        both = F.exists(found, lambda e: _has(e, self.role)) & F.exists(found, lambda e: _has(e, self.text))
        return found.isNotNull() & objects & ((F.size(found) == 0) | both)

    def turns(self, record: Column) -> Column:
        return F.transform(
            self._elements(record),
            lambda e: F.struct(_text(e, self.role).alias("role"), _text(e, self.text).alias("text")),
        )


@dataclass(frozen=True)
class FieldLayout:
    """Each turn is a field of its own; the roles are fixed by the field."""

    name: str
    fields: tuple[tuple[str, str], ...]  # (field, role) in the order of the turns
    optional: tuple[str, ...] = ()  # fields that give no turn where they are absent

    def shape(self) -> str:
        return f"OBJECT<{', '.join(sorted(field for field, _ in self.fields))}>"

    def fits(self, record: Column) -> Column:
        """Whether the record has all required fields, among whatever others."""
        wanted = [_has(record, field) for field, _ in self.fields if field not in self.optional]
        return F.schema_of_variant(record).startswith("OBJECT<") & functools.reduce(Column.__and__, wanted)

    def turns(self, record: Column) -> Column:
        def turn(field: str, role: str) -> Column:
            made = F.struct(F.lit(role).alias("role"), _text(record, field).alias("text"))
            return F.when(_has(record, field), made) if field in self.optional else made

        return F.filter(F.array(*(turn(*field) for field in self.fields)), lambda t: t.isNotNull())


MAPPINGS = (
    ListLayout("messages", "messages", "role", "content"),
    ListLayout("conversations", "conversations", "from", "value"),
    FieldLayout("prompt", (("prompt", "user"), ("response", "assistant"))),
    FieldLayout("instruction", (("system", "system"), ("instruction", "user"), ("output", "assistant")), ("system",)),
)


def paths_of(record: Column) -> Column:
    """The tree of field paths of a variant: its schema without the types of values."""
    return F.regexp_replace(F.schema_of_variant(record), r": (?!OBJECT<|ARRAY<)[A-Z]+(?:\([0-9, ]*\))?", "")


def fingerprint(record: Column) -> Column:
    return F.sha2(paths_of(record), 256)


def canonical_turns(df: DataFrame, record: str = "record", out: str = "turns", mappings=MAPPINGS) -> DataFrame:
    """``df`` with ``layout`` (null if unknown) and the turns, chosen by fingerprint.

    A fingerprint that is not that of a mapping itself goes to the first mapping whose
    required paths are among its paths. This looks at paths only, so that it is the same
    for all records of one fingerprint.
    """
    found = fingerprint(df[record])
    layout = F.lit(None).cast("string")
    for mapping in reversed(mappings):
        layout = F.when(mapping.fits(df[record]), F.lit(mapping.name)).otherwise(layout)
    for mapping in mappings:
        same = found == hashlib.sha256(mapping.shape().encode()).hexdigest()
        layout = F.when(same, F.lit(mapping.name)).otherwise(layout)
    named = df.withColumn("layout", F.when(df[record].isNotNull(), layout))
    turns = F.lit(None).cast(TURNS_TYPE)
    for mapping in mappings:
        turns = F.when(F.col("layout") == mapping.name, mapping.turns(named[record])).otherwise(turns)
    return named.withColumn(out, turns)


def escaped(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), _PLAIN, r"$1\\$2$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def formatted(turns: Column) -> Column:
    """The canonical text of an array of turns."""
    parts = F.transform(
        turns,
        lambda t: F.concat(F.lit(TURN), escaped(t["role"]), F.lit(TEXT), escaped(t["text"]), F.lit(END)),
    )
    return F.array_join(parts, "")


def read_turns(text: Column) -> Column:
    """The turns of a canonical text: role and text as they were, and whether they are learned."""
    closed = F.slice(F.split(text, r"<\|end\|>", -1), F.lit(1), F.size(F.split(text, r"<\|end\|>", -1)) - 1)

    def turn(part: Column) -> Column:
        fields = F.split(F.substring(part, len(TURN) + 1, 2_000_000_000), r"<\|text\|>", 2)
        role = unescaped(fields[0])
        return F.struct(role.alias("role"), unescaped(fields[1]).alias("text"), (role == LEARNED_ROLE).alias("learned"))

    return F.transform(closed, turn)


def loss_spans(text: Column) -> Column:
    """Code points (start, end exclusive) of the escaped texts that are learned."""
    parts = F.split(text, r"<\|end\|>", -1)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(state: Column, part: Column) -> Column:
        fields = F.split(part, r"<\|text\|>", 2)
        stop = state["at"] + F.length(part)
        span = F.struct((stop - F.length(fields[1])).cast("int").alias("start"), stop.cast("int").alias("end"))
        learned = unescaped(F.substring(fields[0], len(TURN) + 1, 2_000_000_000)) == LEARNED_ROLE
        return F.struct(
            (stop + len(END)).alias("at"),
            F.when(learned, F.concat(state["spans"], F.array(span))).otherwise(state["spans"]).alias("spans"),
        )

    return F.aggregate(parts, start, step, lambda state: state["spans"])


def learned_text(text: Column, spans: Column) -> Column:
    """What lies under the loss mask, unescaped, with nothing between."""
    cut = F.transform(spans, lambda s: unescaped(F.substr(text, s["start"] + 1, s["end"] - s["start"])))
    return F.array_join(cut, "")


def format_records(df: DataFrame, record: str = "record", mappings=MAPPINGS) -> DataFrame:
    """``df`` with layout, turns, the formatted text and its loss mask as spans."""
    with_turns = canonical_turns(df, record, "turns", mappings)
    return with_turns.withColumn("formatted", formatted(F.col("turns"))).withColumn(
        "loss_spans", loss_spans(F.col("formatted"))
    )


def records(df: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows by turn as one record for each conversation, in the layout its shape calls for."""
    rows = df.select(
        df[key].alias("conv_id"),
        F.struct(
            df[turn].alias("turn"),
            F.coalesce(df[role], F.lit("")).alias("role"),
            F.coalesce(df[text], F.lit("")).alias("text"),
        ).alias("t"),
    )
    grouped = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    roles, t = F.col("t.role"), F.col("t")
    pair = roles == F.array(F.lit("user"), F.lit("assistant"))
    triple = roles == F.array(F.lit("system"), F.lit("user"), F.lit("assistant"))
    messages = F.transform(t, lambda x: F.struct(x["role"].alias("role"), x["text"].alias("content")))
    speakers = F.transform(t, lambda x: F.struct(x["role"].alias("from"), x["text"].alias("value")))
    record = (
        F.when(pair, F.to_variant_object(F.struct(t[0]["text"].alias("prompt"), t[1]["text"].alias("response"))))
        .when(
            triple,
            F.to_variant_object(
                F.struct(t[0]["text"].alias("system"), t[1]["text"].alias("instruction"), t[2]["text"].alias("output"))
            ),
        )
        .when(F.size(t) % 2 == 0, F.to_variant_object(F.struct(speakers.alias("conversations"))))
        .otherwise(F.to_variant_object(F.struct(messages.alias("messages"))))
    )
    return grouped.select("conv_id", record.alias("record"))
