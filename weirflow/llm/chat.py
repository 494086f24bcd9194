"""Chat formatting: turns to one training text with a loss mask, by Spark expressions only.

Turn structs are collected per conversation and sorted, adjacent turns of one role are merged with an array aggregation,
and the pieces are concatenated. The template is

    <|im_start|>role<|im_sep|>text<|im_next|>text of a merged turn<|im_end|>

Control strings inside roles and texts are broken by a backslash after their first character, and backslashes are doubled,
so ``unescape`` gives every text back exactly.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# This template's own marks, and marks of other common templates that must not be read as control.
START, SEP, NEXT, END = "<|im_start|>", "<|im_sep|>", "<|im_next|>", "<|im_end|>"
CONTROL = (START, SEP, NEXT, END, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|endoftext|>")


def _openings() -> str:
    """Matches the first character of each control string."""
    by_first: dict[str, list[str]] = {}
    for mark in CONTROL:
        by_first.setdefault(mark[0], []).append(re.escape(mark[1:]).replace("/", r"\/"))
    return "|".join(f"{re.escape(c)}(?=(?:{'|'.join(rest)}))" for c, rest in by_first.items())


def escape(text: Column) -> Column:
    """Double backslashes and put one after the first character of every control string."""
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, f"({_openings()})", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_chats(df: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans (start and end in code points, end exclusive).

    Null roles and texts count as empty; a null conv_id is one conversation. Turns come by number (nulls first), then role, then
    text, so ties and repeated rows have one order; repeated rows stay. An empty text gives an empty span. No rows give no rows.
    Escaping is done before rows are gathered; a conversation is one row in the end, so it has to fit one.
    """
    turns = df.select(
        df["conv_id"].alias("conv_id"),
        F.struct(
            df["turn"].alias("turn"),
            escape(F.coalesce(df["role"], F.lit(""))).alias("role"),
            escape(F.coalesce(df["text"], F.lit(""))).alias("text"),
        ).alias("t"),
    )
    chats = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    at = lambda i: F.element_at("turns", i)
    first_of_run = F.aggregate(
        F.sequence(F.lit(1), F.size("turns")),
        F.array().cast("array<int>"),
        lambda seen, i: F.when((i == 1) | (at(i)["role"] != at(F.greatest(i - 1, F.lit(1)))["role"]), F.concat(seen, F.array(i))).otherwise(seen),
    )
    chats = chats.withColumn("runs", first_of_run)
    after = lambda k: F.when(k + 1 < F.size("runs"), F.element_at("runs", F.least(k + 2, F.size("runs")))).otherwise(F.size("turns") + 1)
    block = lambda i, k: F.struct(at(i)["role"].alias("role"), F.transform(F.slice("turns", i, after(k) - i), lambda t: t["text"]).alias("texts"))
    piece = lambda s, loss: F.struct(s.alias("s"), loss.alias("loss"))

    def pieces(b: Column) -> Column:
        texts = F.transform(b["texts"], lambda s, k: F.array(
            piece(F.when(k == 0, F.concat(F.lit(START), b["role"], F.lit(SEP))).otherwise(F.lit(NEXT)), F.lit(False)),
            piece(s, b["role"] == loss_role),
        ))
        return F.concat(F.flatten(texts), F.array(piece(F.lit(END), F.lit(False))))

    chats = chats.withColumn("pieces", F.flatten(F.transform(F.transform("runs", block), pieces)))
    spans = F.aggregate(
        "pieces",
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans")),
        lambda acc, p: F.struct(
            (acc["at"] + F.length(p["s"])).alias("at"),
            F.when(p["loss"], F.concat(acc["spans"], F.array(F.struct(acc["at"].alias("start"), (acc["at"] + F.length(p["s"])).alias("end")))))
            .otherwise(acc["spans"]).alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    return chats.select("conv_id", F.array_join(F.transform("pieces", lambda p: p["s"]), "").alias("formatted"), spans.alias("loss_spans"))


def _split(text: Column, mark: str, limit: int = -1) -> Column:
    return F.split(text, rf"\Q{mark}\E", limit)


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text as array<struct<role, text>>, unescaped."""
    blocks = _split(formatted, END)
    blocks = F.slice(blocks, 1, F.size(blocks) - 1)
    def turns(block: Column) -> Column:
        parts = _split(F.substring(block, len(START) + 1, 2147483647), SEP, 2)
        return F.transform(_split(parts[1], NEXT), lambda s: F.struct(unescape(parts[0]).alias("role"), unescape(s).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")


def digest(chats: DataFrame) -> DataFrame:
    """What a reader gets back from the formatted texts, as counts and hashes."""
    read = chats.select("conv_id", "formatted", read_turns(F.col("formatted")).alias("turns"), loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
