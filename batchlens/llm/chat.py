"""Chat formatting with Spark expressions only.

A conversation's rows are collected as structs, sorted by turn, adjacent turns of one role are merged into a block
by array aggregation, and blocks are put together as text:

    ### <role>:\\n<text>[<part/><text>]...</turn>\\n

``&``, ``<`` and ``#`` (and ``:`` and line feeds in roles) are written as entities inside texts, so no text can hold
a control string, and reading back gives every turn as it was. The loss mask is the list of character spans of the
assistant's texts in the formatted string.

Defined results: a null text or role is empty; rows without conv_id are one conversation; ties of turn are ordered by
role, then text, nulls first; repeated rows are turns of their own; an empty table gives an empty one; other columns
are not looked at. Turns are merged in slices of SLICE turns, so a very long conversation costs linear time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLICE = 256
PART, END = "<part/>", "</turn>\n"
LEARNED_ROLE = "assistant"

_BLOCKS = "array<struct<role:string,parts:array<string>>>"
_SPANS = "struct<at:bigint,spans:array<struct<start:bigint,len:bigint>>>"


def escape(c: Column) -> Column:
    c = F.replace(c, F.lit("&"), F.lit("&amp;"))
    c = F.replace(c, F.lit("<"), F.lit("&lt;"))
    return F.replace(c, F.lit("#"), F.lit("&num;"))


def unescape(c: Column) -> Column:
    for entity, char in (("&num;", "#"), ("&lt;", "<"), ("&colon;", ":"), ("&newline;", "\n"), ("&amp;", "&")):
        c = F.replace(c, F.lit(entity), F.lit(char))
    return c


def _escape_role(c: Column) -> Column:
    return F.replace(F.replace(escape(c), F.lit(":"), F.lit("&colon;")), F.lit("\n"), F.lit("&newline;"))


def _merge(turns: Column) -> Column:
    """Blocks of adjacent turns of one role."""

    def step(acc, x):
        last = F.element_at(acc, -1)
        joined = F.struct(last["role"].alias("role"), F.concat(last["parts"], F.array(x["text"])).alias("parts"))
        new = F.struct(x["role"].alias("role"), F.array(x["text"]).alias("parts"))
        same = (F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1))["role"] == x["role"])
        return F.when(same, F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(joined))).otherwise(F.concat(acc, F.array(new))).cast(_BLOCKS)

    return F.aggregate(turns, F.array().cast(_BLOCKS), step)


def format_chat(conversations: DataFrame) -> DataFrame:
    """conv_id, formatted string, loss_spans array<struct<start,len>> (code points, from 0)."""
    turns = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    sets = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    # Slices of turns become blocks; a block that goes on over a slice's end keeps one header and one end.
    blocks = sets.select(
        "conv_id",
        F.transform(
            F.sequence(F.lit(0), F.floor((F.size("turns") - 1) / SLICE).cast("int")),
            lambda i: _merge(
                F.transform(
                    F.slice("turns", i * SLICE + 1, F.lit(SLICE)),
                    lambda t: F.struct(_escape_role(t["role"]).alias("role"), escape(t["text"]).alias("text")),
                )
            ),
        ).alias("slices"),
    )
    edges = blocks.select(
        "conv_id", "slices",
        F.transform("slices", lambda s: s[0]["role"]).alias("firsts"),
        F.transform("slices", lambda s: F.element_at(s, -1)["role"]).alias("lasts"),
    )
    learned = F.lit(LEARNED_ROLE)

    def pieces(s: Column, i: Column) -> Column:
        """Text of one slice's blocks with, for every piece, whether it is learned."""
        more_before = (i > 0) & (F.try_element_at("lasts", i) == s[0]["role"])
        more_after = F.try_element_at("firsts", i + 2) == F.element_at(s, -1)["role"]

        def block(b: Column, j: Column) -> Column:
            head = F.when((j == 0) & more_before, F.lit(PART)).otherwise(F.concat(F.lit("### "), b["role"], F.lit(":\n")))
            tail = F.when((j == F.size(s) - 1) & F.coalesce(more_after, F.lit(False)), F.lit("")).otherwise(F.lit(END))
            texts = F.transform(
                b["parts"],
                lambda p, k: F.array(
                    F.struct(F.when(k == 0, head).otherwise(F.lit(PART)).alias("s"), F.lit(False).alias("loss")),
                    F.struct(p.alias("s"), (b["role"] == learned).alias("loss")),
                ),
            )
            return F.concat(F.flatten(texts), F.array(F.struct(tail.alias("s"), F.lit(False).alias("loss"))))

        return F.flatten(F.transform(s, block))

    cut = edges.select("conv_id", F.transform("slices", pieces).alias("pieces"))

    def spans(ps: Column) -> Column:
        def step(acc, p):
            n = F.length(p["s"]).cast("long")
            span = F.array(F.struct(acc["at"].alias("start"), n.alias("len")))
            return F.struct((acc["at"] + n).alias("at"), F.when(p["loss"], F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans")).cast(_SPANS)

        return F.aggregate(ps, F.struct(F.lit(0).cast("long").alias("at"), F.array().alias("spans")).cast(_SPANS), step)

    masked = cut.select(
        "conv_id",
        F.transform("pieces", lambda ps: F.array_join(F.transform(ps, lambda p: p["s"]), "")).alias("texts"),
        F.transform("pieces", spans).alias("masks"),
    )
    shifts = masked.select(
        "conv_id", "texts", "masks",
        F.transform(
            F.sequence(F.lit(0), F.size("masks") - 1),
            lambda i: F.aggregate(F.slice("masks", F.lit(1), i), F.lit(0).cast("long"), lambda a, m: a + m["at"]),
        ).alias("shift"),
    )
    moved = F.transform(
        "masks",
        lambda m, i: F.transform(m["spans"], lambda s: F.struct((s["start"] + F.element_at("shift", i + 1)).alias("start"), s["len"].alias("len"))),
    )
    return shifts.select("conv_id", F.array_join("texts", "").alias("formatted"), F.flatten(moved).alias("loss_spans"))


def read_chat(formatted: DataFrame) -> DataFrame:
    """The turns (role, text) and the text under the loss mask, out of formatted conversations."""
    blocks = formatted.select(
        "conv_id", "formatted", "loss_spans",
        F.transform(
            F.filter(F.split("formatted", END), lambda b: b != ""),
            lambda b: F.struct(
                F.substring_index(b, ":\n", 1).alias("head"),
                F.split(F.substr(b, F.length(F.substring_index(b, ":\n", 1)) + 3), PART).alias("parts"),
            ),
        ).alias("blocks"),
    )
    turn = F.flatten(
        F.transform(
            "blocks",
            lambda b: F.transform(
                b["parts"], lambda p: F.struct(unescape(F.substr(b["head"], F.lit(5))).alias("role"), unescape(p).alias("text"))
            ),
        )
    )
    under = F.transform("loss_spans", lambda s: unescape(F.substr("formatted", (s["start"] + 1).cast("int"), s["len"].cast("int"))))
    return blocks.select("conv_id", "formatted", turn.alias("turns"), F.array_join(under, "").alias("loss_text"))


def digests(read: DataFrame) -> DataFrame:
    """n_turns and digests of what ``read_chat`` returns."""
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


#: DuckDB SQL for the digests of table ``conversations`` with conversation -7.
SQL = r"""
with c as (
  select conv_id, turn, coalesce(role, '') role, coalesce("text", '') t from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e as (
  select *, lag(role) over w before_, lead(role) over w after_,
    length(replace(replace(replace(t, '&', '&amp;'), '<', '&lt;'), '#', '&num;')) n,
    length(replace(replace(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '#', '&num;'), ':', '&colon;'), chr(10), '&newline;')) r
  from c window w as (partition by conv_id order by turn nulls first, role, t))
select conv_id, count(*) n_turns,
  sha256(string_agg(role || chr(10) || t || chr(10), '' order by turn nulls first, role, t)) turns_sha256,
  length(coalesce(string_agg(t, '' order by turn nulls first, t) filter (role = 'assistant'), '')) loss_chars,
  sha256(coalesce(string_agg(t, '' order by turn nulls first, t) filter (role = 'assistant'), '')) loss_sha256,
  cast(sum(n + case when before_ = role then 7 else 6 + r end + case when after_ = role then 0 else 8 end) as bigint) formatted_chars
from e group by conv_id
"""
