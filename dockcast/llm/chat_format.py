"""Chat formatting: turns as rows become one string per conversation, with a loss mask, and can be read back.

A conversation's turns are collected as structs and sorted; adjacent turns of one role are merged into one block by an
array aggregation; the blocks are concatenated. The template, in which a block's further texts follow a separator:

    <|im_start|>ROLE newline TEXT [<|im_sep|>TEXT]... <|im_end|> newline

Control strings start with `<|`. Inside texts every `<`, backslashes, `|` gets one backslash more, so `<|` never occurs
there and reading back removes it again. Roles are URL-encoded, so they hold no newline and no `<`.

The mask is a run-length list over the string's code points, one entry per control run and per text, with `loss` true for
the texts of one role.

Defined results: NULL text or role is empty; NULL conversation ids form one conversation; turns sort by (turn, role,
text), NULL first, so ties and repeated rows have one order; an empty table gives no rows; other columns are ignored.
One conversation is one output value, so it is built in one task; its size is the only thing that bounds that task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockcast.llm.common import computed_once, let, whole_text

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
#: A control run: the end of a block with the next block's start, the first start, or a separator.
CONTROL = r"<\|im_end\|>\n(?:<\|im_start\|>[^\n]*\n)?|<\|im_start\|>[^\n]*\n|<\|im_sep\|>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", r"<$1|")


def _merged(turns: Column) -> Column:
    """Adjacent turns of one role as one struct with all their texts, in order."""
    none = F.array().cast("array<struct<role:string,texts:array<string>>>")

    def step(done: Column, turn: Column) -> Column:
        last = F.get(done, F.size(done) - 1)
        alone = F.struct(turn["role"].alias("role"), F.array(turn["text"]).alias("texts"))
        longer = F.struct(last["role"].alias("role"), F.concat(last["texts"], F.array(turn["text"])).alias("texts"))
        return F.when(
            (F.size(done) > 0) & (last["role"] == turn["role"]),
            F.concat(F.slice(done, 1, F.size(done) - 1), F.array(longer)),
        ).otherwise(F.concat(done, F.array(alone)))

    return F.aggregate(turns, none, step)


def _runs(block: Column, first: Column, loss_role: str) -> Column:
    """The mask of one block: a control run and a text for each of its texts."""
    before = F.length(block["role"]) + F.lit(len(START) + 1) + F.when(first, F.lit(0)).otherwise(F.lit(len(END)))
    loss = block["role"] == F.url_encode(F.lit(loss_role))
    run = lambda n, on: F.struct(n.cast("int").alias("length"), on.alias("loss"))
    return F.flatten(
        F.transform(
            block["texts"],
            lambda t, i: F.array(run(F.when(i == 0, before).otherwise(F.lit(len(SEP))), F.lit(False)), run(F.length(t), loss)),
        )
    )


def format_conversations(turns: DataFrame, conv: str = "conv_id", loss_role: str = "assistant") -> DataFrame:
    """One row per conversation: its id, `formatted` and `mask`."""
    turn = F.struct(
        F.col("turn"), F.url_encode(whole_text("role")).alias("role"), escape(whole_text("text")).alias("text")
    )
    collected = turns.groupBy(conv).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    blocks = collected.select(conv, _merged(F.col("turns")).alias("blocks"))
    body = lambda b: F.concat(F.lit(START), b["role"], F.lit("\n"), F.array_join(b["texts"], SEP), F.lit(END))
    end = F.struct(F.lit(len(END)).alias("length"), F.lit(False).alias("loss"))
    return blocks.select(
        conv,
        computed_once(F.array_join(F.transform("blocks", body), "")).alias("formatted"),
        computed_once(F.concat(F.flatten(F.transform("blocks", lambda b, i: _runs(b, i == 0, loss_role))), F.array(end))).alias("mask"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns again, from the formatted string alone: array<struct<role, text>>."""

    def block(b: Column) -> Column:
        head = F.substring_index(b, "\n", 1)
        body = F.substring(b, F.length(head) + 2, F.length(b) - F.length(head) - F.lit(1 + len(END)))
        role = F.try_url_decode(head)
        return F.transform(F.split(body, r"<\|im_sep\|>", -1), lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    blocks = F.split(formatted, r"<\|im_start\|>", -1)
    return F.flatten(F.transform(F.slice(blocks, 2, F.size(blocks)), block))


def loss_texts(formatted: Column, mask: Column) -> Column:
    """The texts under the mask, unescaped. Cuts the string at its control runs and fails if the mask does not fit them."""
    marks = F.regexp_extract_all(formatted, F.lit(CONTROL), F.lit(0))
    gaps = F.split(formatted, CONTROL, -1)

    def pick(parts: Column) -> Column:
        texts = F.zip_with(
            parts["marks"],
            F.slice(parts["gaps"], 2, F.size(parts["gaps"])),
            lambda m, g: F.struct(F.length(m).alias("control"), F.length(g).alias("length"), g.alias("text")),
        )
        runs = F.transform(texts, lambda t, i: F.struct(t.alias("t"), F.get(mask, 2 * i).alias("c"), F.get(mask, 2 * i + 1).alias("m")))
        fits = F.forall(runs, lambda r: (r["c"]["length"] == r["t"]["control"]) & (F.coalesce(r["m"]["length"], F.lit(0)) == r["t"]["length"]))
        chosen = F.filter(runs, lambda r: F.coalesce(r["m"]["loss"], F.lit(False)))
        return F.when(fits, F.transform(chosen, lambda r: unescape(r["t"]["text"]))).otherwise(
            F.raise_error(F.lit("the mask does not fit the string")).cast("array<string>")
        )

    return let(F.struct(marks.alias("marks"), gaps.alias("gaps")), pick)
