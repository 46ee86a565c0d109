r"""Chat formatting with Spark expressions.

The turns of a conversation are collected as structs and sorted; adjacent turns of one role are merged into a block;
blocks are concatenated. The template is::

    <turn ROLE>
    TEXT</turn>
    <turn ROLE>
    TEXT<turn+>TEXT</turn>

``<turn+>`` parts the turns merged into one block, so reading back gives every turn. Control strings begin with
``<turn`` or ``</turn``. Inside a text their ``<`` becomes ``&lt;``, and an ``&`` that would read as such an escape
becomes ``&amp;``; everything else stays as it is, and ``read_back`` undoes it exactly.

Defined cases: null text and null role are empty; rows of one conversation with the same turn number are ordered by
role and text and all kept; a null conversation id is one conversation of its own; an empty table gives no rows.
One conversation is one row, so its turns meet in one task, as its formatted text must.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spotgrid.llm.arrays import bind, running_sums

LOSS_ROLE = "assistant"
OPEN, CLOSE, JOIN = "<turn ", "</turn>\n", "<turn+>"


def escape(text: Column) -> Column:
    """Mask control strings: ``&(amp;)*lt;turn`` gets one more ``amp;``, ``<turn`` becomes ``&lt;turn``."""
    masked = F.regexp_replace(text, r"&((?:amp;)*lt;/?turn)", r"&amp;$1")
    return F.regexp_replace(masked, r"<(/?turn)", r"&lt;$1")


def unescape(text: Column) -> Column:
    bare = F.regexp_replace(text, r"&lt;(/?turn)", r"<$1")
    return F.regexp_replace(bare, r"&amp;((?:amp;)*lt;/?turn)", r"&$1")


def escape_role(role: Column) -> Column:
    return F.replace(F.replace(F.replace(role, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(F.replace(role, F.lit("&gt;"), F.lit(">")), F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def _blocks(turns: Column) -> Column:
    """Runs of one role in a sorted array of (turn, role, text): array of (role, texts)."""
    n = F.size(turns)
    is_start = lambda i: (i == 0) | (F.get(turns, i)["role"] != F.get(turns, i - 1)["role"])
    starts = F.filter(F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>")), is_start)

    def block(starts: Column) -> Column:
        def one(start: Column, i: Column) -> Column:
            run = F.slice(turns, start + 1, F.coalesce(F.get(starts, i + 1), n) - start)
            return F.struct(F.get(turns, start)["role"].alias("role"), F.transform(run, lambda x: x["text"]).alias("texts"))

        return F.transform(starts, one)

    return bind(starts, block)


def format_chats(chats: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", loss_role: str = LOSS_ROLE) -> DataFrame:
    """One row per conversation: key, formatted text and loss_spans, the (start, stop) code points of each loss turn's text."""
    rows = chats.select(F.col(key).alias(key), F.struct(
        F.col(turn).alias("turn"), F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text")).alias("_turn"))
    sorted_turns = rows.groupBy(key).agg(F.array_sort(F.collect_list("_turn")).alias("turns"))
    merged = sorted_turns.select(key, bind(F.col("turns"), _blocks).alias("blocks"))
    # Each turn becomes (what stands before its text, its escaped text, whether it bears loss).
    piece = lambda lead, body, loss: F.struct(lead.alias("lead"), escape(body).alias("body"), loss.alias("loss"))

    def pieces(b: Column, k: Column) -> Column:
        head = F.concat(F.when(k > 0, F.lit(CLOSE)).otherwise(F.lit("")), F.lit(OPEN), escape_role(b["role"]), F.lit(">\n"))
        return F.transform(b["texts"], lambda x, i: piece(F.when(i == 0, head).otherwise(F.lit(JOIN)), x, b["role"] == loss_role))

    cut = merged.select(key, F.flatten(F.transform("blocks", pieces)).alias("pieces"))

    def spans(pieces: Column) -> Column:
        ends = running_sums(F.transform(pieces, lambda p: (F.length(p["lead"]) + F.length(p["body"])).cast("long")))
        every = bind(ends, lambda e: F.transform(pieces, lambda p, i: F.struct(
            p["loss"].alias("loss"), (F.get(e, i) - F.length(p["body"])).alias("start"), F.get(e, i).alias("stop"))))
        return F.transform(F.filter(every, lambda s: s["loss"]), lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop")))

    return cut.select(
        key, F.concat(F.array_join(F.transform("pieces", lambda p: F.concat(p["lead"], p["body"])), ""), F.lit(CLOSE)).alias("formatted"),
        bind(F.col("pieces"), spans).alias("loss_spans"))


def read_back(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of (role, text)."""
    def turns(block: Column) -> Column:
        head = F.substring_index(block, ">\n", 1)
        body = F.substr(block, F.length(head) + 3)
        role = unescape_role(F.substr(head, F.lit(len(OPEN) + 1)))
        return F.transform(F.split(body, r"<turn\+>", -1), lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    blocks = F.filter(F.split(formatted, r"</turn>\n", -1), lambda b: b != "")
    return F.flatten(F.transform(blocks, turns))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), (s["stop"] - s["start"]).cast("int")))), "")
