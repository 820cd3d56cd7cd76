"""Chat formatting: turns as structs, sorted, merged and joined by Spark expressions alone.

The template, for each run of adjacent turns of one role::

    <|im_start|>role
    text<|im_sep|>text<|im_end|>

``<|im_sep|>`` stands between turns of one run, so that the turns can be read
back one by one. Texts and roles are escaped: a backslash is doubled and ``<|``
becomes ``<\\|``, so that none of their characters can form a marker. In roles a
newline gets a backslash too. A backslash in front of any character is dropped on
the way back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
#: A role's line: characters that aren't escaped, or a backslash and what it guards.
ROLE_LINE = r"^((?:[^\\\n]|\\[\s\S])*+)\n"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\\n"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\s\S])", "$1")


def format_chats(
    rows: DataFrame,
    trained: str = "assistant",
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One row per conversation: conv_id, formatted, segments.

    ``segments`` is an array of (text, loss) whose texts, joined, are
    ``formatted``; loss marks the texts of the ``trained`` role, and nothing else
    is under the mask. A conversation is one string and thus one task's work; the
    shuffle carries each turn once.

    Turns go by ``turn``, then role and text, nulls first. A null text is empty; a
    null role is the role of no name (an empty string). Rows of a null
    conversation form one of their own; repeated rows are turns like any other.
    Empty table: no rows. Other columns aren't looked at.
    """
    turns = rows.select(
        F.col(conv).alias("conv_id"),
        F.struct(
            F.col(turn).alias("turn"),
            F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
        ).alias("t"),
    )
    sorted_turns = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    at = lambda i: F.get(F.col("t"), i)
    first = sorted_turns.withColumn("first", F.filter(F.sequence(F.lit(0), F.size("t") - 1), lambda i: (i == 0) | (at(i)["role"] != at(i - 1)["role"])))
    # a run of one role: from its first turn to before the next run's
    merged = first.select(
        "conv_id",
        F.transform(
            "first",
            lambda start, k: F.struct(
                at(start)["role"].alias("role"),
                F.transform(F.slice("t", start + 1, F.coalesce(F.get(F.col("first"), k + 1), F.size("t")) - start), lambda x: x["text"]).alias("texts"),
            ),
        ).alias("runs"),
    )
    mark = lambda said: F.struct(said.alias("text"), F.lit(False).alias("loss"))
    segments = merged.select(
        "conv_id",
        F.flatten(
            F.transform(
                "runs",
                lambda run: F.concat(
                    F.array(mark(F.concat(F.lit(START), escape_role(run["role"]), F.lit("\n")))),
                    F.flatten(
                        F.transform(
                            run["texts"],
                            lambda said, k: F.concat(
                                F.when(k > 0, F.array(mark(F.lit(SEP)))).otherwise(F.array().cast("array<struct<text:string,loss:boolean>>")),
                                F.array(F.struct(escape(said).alias("text"), (run["role"] == F.lit(trained)).alias("loss"))),
                            ),
                        )
                    ),
                    F.array(mark(F.lit(END + "\n"))),
                ),
            )
        ).alias("segments"),
    )
    return segments.select("conv_id", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "segments")


def loss_spans(segments: Column) -> Column:
    """The mask as (start, length) in characters of ``formatted``, from 0."""
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"))
    return F.aggregate(
        segments,
        start,
        lambda acc, s: F.struct(
            (acc["at"] + F.length(s["text"])).alias("at"),
            F.when(s["loss"], F.concat(acc["spans"], F.array(F.struct(acc["at"].alias("start"), F.length(s["text"]).cast("bigint").alias("length"))))).otherwise(acc["spans"]).alias("spans"),
        ),
        lambda acc: acc["spans"],
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation: an array of (role, text)."""
    blocks = F.filter(F.split(formatted, r"<\|im_end\|>\n"), lambda b: b != "")
    return F.flatten(
        F.transform(
            F.transform(blocks, lambda b: F.substring(b, len(START) + 1, 2**31 - 1)),
            lambda b: F.transform(
                F.split(F.regexp_replace(b, ROLE_LINE, ""), r"<\|im_sep\|>"),
                lambda said: F.struct(unescape(F.regexp_extract(b, ROLE_LINE, 1)).alias("role"), unescape(said).alias("text")),
            ),
        )
    )
