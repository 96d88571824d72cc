"""Chat formatting: conversations as training strings, made of Spark expressions only.

1. The turns of a conversation are collected as structs and sorted by (turn, role, text).
2. Adjacent turns of one role are merged: the places where the role changes head the blocks, a
   block is the slice of turns up to the next head.
3. Every block is rendered as ``start role body text (join text ...) end`` and cut into segments
   with a label: the texts of trained roles are under the loss mask (label true), marks, roles and
   all other texts are not. The concatenated segments are the formatted string.

Control strings inside texts and roles are broken by an escape mark after their first character,
and the mark itself is doubled with another digit, so nothing in a text can open or close a turn
and ``parse`` gives every turn back as it was, merged or not.

A conversation is one row of the result, as its training string is; one shuffle on the
conversation id, no window, no join, no Python.

Defined results: a null text or role is the empty string; a null conversation id is a
conversation; a null turn number comes first; equal turn numbers go by role and text, repeated
rows are all kept; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table


@dataclass(frozen=True)
class Template:
    """Marks of a turn, the roles whose texts are trained, and other strings to break in texts."""

    start: str = "<|im_start|>"
    body: str = "<|im_sep|>"
    join: str = "<|im_join|>"
    end: str = "<|im_end|>"
    trained: tuple[str, ...] = ("assistant",)
    reserved: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|endoftext|>")
    escape: str = "␛"

    @property
    def controls(self) -> tuple[str, ...]:
        return (self.start, self.body, self.join, self.end, *self.reserved)


DEFAULT = Template()


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once, however often it is used."""
    return F.transform(F.array(value), then)[0]


def _quoted(text: str) -> str:
    return re.sub(r"([^\w\s])", r"\\\1", text)


def escape(text: Column, template: Template = DEFAULT) -> Column:
    """The text without any control string of the template; ``unescape`` gives it back."""
    mark = template.escape
    broken = "|".join(f"{_quoted(c[0])}(?={_quoted(c[1:])})" for c in template.controls)
    doubled = F.replace(text, F.lit(mark), F.lit(mark + "0"))
    return F.regexp_replace(doubled, broken, f"$0{mark}1")


def unescape(text: Column, template: Template = DEFAULT) -> Column:
    mark = template.escape
    whole = F.replace(text, F.lit(mark + "1"), F.lit(""))
    return F.replace(whole, F.lit(mark + "0"), F.lit(mark))


def _blocks(turns: Column) -> Column:
    """Adjacent turns of one role as ``struct(role, texts)``, in order."""
    heads = F.filter(F.sequence(F.lit(1), F.size(turns)), lambda i: (i == 1) | (
        F.element_at(turns, i)["role"] != F.element_at(turns, F.greatest(i - 1, F.lit(1)))["role"]))
    return _let(heads, lambda h: F.transform(h, lambda at, k: F.struct(
        F.element_at(turns, at)["role"].alias("role"),
        F.transform(F.slice(turns, at, F.coalesce(F.get(h, k + 1), F.size(turns) + 1) - at), lambda t: t["text"]).alias("texts"))))


def _segment(text: Column, label: Column) -> Column:
    return F.struct(text.alias("text"), label.alias("label"))


def _segments(block: Column, template: Template) -> Column:
    """A rendered block as ``struct(text, label)`` pieces; only texts of trained roles are labelled."""
    learnt = block["role"].isin(*template.trained)
    texts = F.transform(block["texts"], lambda t, k: F.array(
        _segment(F.when(k == 0, F.lit(template.body)).otherwise(F.lit(template.join)), F.lit(False)),
        _segment(escape(t, template), learnt)))
    return F.concat(F.array(_segment(F.concat(F.lit(template.start), escape(block["role"], template)), F.lit(False))),
                    F.flatten(texts), F.array(_segment(F.lit(template.end), F.lit(False))))


def format_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text", template: Template = DEFAULT) -> DataFrame:
    """One row per conversation: ``conv_col``, ``formatted`` and its ``segments`` (text, label)."""
    whole = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(""))
    rows = turns.select(F.col(conv_col).alias(conv_col), F.struct(
        F.col(turn_col).alias("turn"), whole(role_col).alias("role"), whole(text_col).alias("text")).alias("_turn"))
    sorted_turns = rows.groupBy(conv_col).agg(F.sort_array(F.collect_list("_turn")).alias("_turns"))
    segments = _let(F.col("_turns"), lambda t: F.flatten(F.transform(_blocks(t), lambda b: _segments(b, template))))
    out = sorted_turns.select(conv_col, segments.alias("segments"))
    return out.select(conv_col, F.array_join(F.col("segments")["text"], "").alias("formatted"), "segments")


def parse(formatted: Column, template: Template = DEFAULT) -> Column:
    """The turns of a formatted string as ``array<struct<role, text>>``, unescaped and unmerged."""
    blocks = F.filter(F.split(formatted, _quoted(template.start), -1), lambda b, k: k > 0)
    return F.flatten(F.transform(blocks, lambda b: _let(
        F.split(F.substring_index(b, template.end, 1), _quoted(template.body), -1),
        lambda two: F.transform(F.split(two[1], _quoted(template.join), -1), lambda t: F.struct(
            unescape(two[0], template).alias("role"), unescape(t, template).alias("text"))))))


def learnt_text(segments: Column, template: Template = DEFAULT) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["label"]), lambda s: unescape(s["text"], template)), "")


def _probe(spark: SparkSession) -> DataFrame:
    """Conversation -1: a user and an assistant row whose texts are control strings."""
    return spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))


def op12_chat_formatting(spark, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").unionByName(_probe(spark))
    made = format_conversations(turns)
    read = made.select("conv_id", parse(F.col("formatted")).alias("turns"), learnt_text(F.col("segments")).alias("learnt"),
                       F.length("formatted").cast("long").alias("formatted_chars"))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("learnt").cast("long").alias("loss_chars"), F.sha2(F.col("learnt"), 256).alias("loss_sha256"), "formatted_chars")


#: Turns in order; the length of the formatted string from the marks, the role changes and the
#: strings that the template breaks.
OP12_ORACLE = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, i, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) v(i, r)),
e AS (SELECT *, row_number() OVER o AS k, lag(role) OVER o IS DISTINCT FROM role AS head,
             [length(s) + length(s) - length(replace(s, chr(9243), ''))
              + len(regexp_extract_all(s, '<\|im_start\|>|<\|im_sep\|>|<\|im_join\|>|<\|im_end\|>|<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>|<\|endoftext\|>')) * 2
              for s in [role, text]] AS n
      FROM c WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(n[2] + CASE WHEN head THEN 12 + n[1] + 10 + 10 ELSE 11 END) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
