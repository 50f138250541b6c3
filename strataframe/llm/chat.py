r"""Chat formatting into budgeted, turn-aligned windows, with DataFrame functions only.

A conversation's turns are numbered and their tokens summed by prefix sums over fixed blocks of turn numbers, so a
very long conversation is spread over tasks. Windows are chosen greedily in chunks of so many turns as a block has numbers: a window goes on
until the prefix sum passes what its first turn's sum, the system turn and the repeated history leave of the budget; a chunk begins
a new one. Each window but the first repeats the system turn and the last few turns before it that fit the history budget and, beside a
long turn, what is left; repeated turns are not under the loss mask. A system turn that leaves nothing is repeated all the same, and every other
turn stands alone. Only numbers are folded; texts meet their windows by chunk, and are grouped without another shuffle.

Template: <s>, then for each turn "[INST] role [/INST] text</s>". In roles and texts a backslash becomes two, and a
backslash is put after the first character of <s>, </s>, [INST] and [/INST]; `unescape` undoes both.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strataframe.storage import stored

BOS, OPEN, CLOSE, END = "<s>", "[INST] ", " [/INST] ", "</s>"
#: What counts as a token: up to six word characters, or another visible character.
TOKEN = r"[A-Za-z0-9_]{1,6}|[^A-Za-z0-9_ \t\n\r\f\x0B]"
HEAD_TOKENS = 4


@dataclass(frozen=True)
class ChatParams:
    """budget: tokens of a window. history_tokens: what of it repeated history may take. history_turns: turns
    repeated at most. block: turn numbers that one task orders together, and turns of a chunk; more than history_turns."""

    budget: int = 1024
    history_tokens: int = 256
    history_turns: int = 2
    block: int = 256


def escape(c: Column) -> Column:
    doubled = F.regexp_replace(c, r"\\", r"\\\\")
    return F.regexp_replace(doubled, r"(<)(?=/?s>)|(\[)(?=/?INST\])", r"$1$2\\")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)\\(.)", "$1")


def _windows(p: ChatParams) -> Column:
    """array of (first, from, upto): the windows of a chunk's turns xs (with those before that may be history), by their first new turn, that
    of their history, and the one after their last. Sums are differences of prefix sums."""
    long = lambda v: F.lit(v).cast("long")
    kind = "array<struct<first:bigint,from:bigint>>"
    begin = F.col("chunk") * p.block

    def told(x: Column, i: Column) -> Column:
        """A turn with the history that a window from it on would have: as many turns back as fit."""
        room = F.least(long(p.history_tokens), p.budget - F.col("system") - x["tokens"])
        before = [F.get("xs", i - k) for k in range(1, p.history_turns + 1)]
        sums = [F.when(b["is_system"], F.lit(None)).otherwise(x["start"] - b["start"]) for b in before]
        fits = [F.when(s <= room, F.struct(s.alias("sum"), (x["ordinal"] - k).alias("from"))) for k, s in enumerate(sums, 1)]
        best = F.coalesce(*reversed(fits), F.struct(long(0).alias("sum"), x["ordinal"].alias("from")))
        return F.struct(x["ordinal"].alias("ordinal"), x["tokens"].alias("tokens"), x["start"].alias("start"), best.alias("past"))

    def step(done: Column, x: Column) -> Column:
        more = (F.size(done["wins"]) > 0) & (x["start"] + x["tokens"] - done["start"] + done["base"] <= p.budget)
        base = F.when(x["ordinal"] == 0, long(0)).otherwise(F.col("system") + x["past"]["sum"])
        wins = F.concat(done["wins"], F.array(F.struct(x["ordinal"].alias("first"), x["past"]["from"].alias("from")))).cast(kind)
        fresh = F.struct(wins.alias("wins"), x["start"].alias("start"), base.cast("long").alias("base"))
        return F.when((x["ordinal"] < begin) | more, done).otherwise(fresh)

    empty = F.struct(F.array().cast(kind).alias("wins"), long(0).alias("start"), long(0).alias("base"))
    found = F.aggregate(F.transform("xs", told), empty, step, lambda done: done["wins"])
    # bound once, as the argument of an outer function
    after = lambda wins: F.transform(wins, lambda w, i: F.struct(w["first"].alias("first"), w["from"].alias("from"), F.coalesce(F.get(wins, i + 1)["first"], (begin + p.block).cast("long")).alias("upto")))
    return F.transform(F.array(found), after)[0]


def format_windows(turns: DataFrame, params: ChatParams = ChatParams(), conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per window: conv_id, first_turn (ordinal of its first new turn), n_turns, n_repeated (leading turns
    repeated from before), n_tokens, over_budget, formatted, loss_spans (array of start, end in code points).

    Turns are ordered by turn (null first), then role, then a hash of the text; rows that repeat all are turns of their
    own. Null roles and texts count as empty; rows with a null conv_id are one conversation. A turn is never cut:
    over_budget is true only of windows with one new turn, where that turn and the system turn exceed the budget. An empty
    table gives no windows; other columns are not read. One task orders the turns of a block, so rows that share a
    turn number, or have none, are ordered together.
    """
    p = params
    rows = turns.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))
    rows = rows.withColumns({"body": escape(F.col("text")), "head": F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(CLOSE)), "tie": F.xxhash64("text")})
    rows = rows.withColumn("tokens", (F.regexp_count("body", F.lit(TOKEN)) + HEAD_TOKENS).cast("long"))
    rows = rows.withColumn("block", F.coalesce(F.floor(F.col("turn") / p.block), F.lit(-(1 << 62))))
    lead = F.min(F.struct("turn", "role", "tie", "tokens")).alias("lead")
    per_block = rows.groupBy("conv_id", "block").agg(F.sum("tokens").alias("t"), F.count("*").alias("c"), lead)
    before = W.partitionBy("conv_id").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    opening = F.first("lead").over(W.partitionBy("conv_id").orderBy("block").rowsBetween(W.unboundedPreceding, W.currentRow))
    offsets = per_block.withColumn("lead", opening).select(
        F.col("conv_id").alias("oc"), F.col("block").alias("ob"), *(F.coalesce(F.sum(x).over(before), F.lit(0)).alias(f"{x}0") for x in "tc"), F.sum("c").over(W.partitionBy("conv_id")).alias("total"),
        F.when(F.col("lead.role") == "system", F.col("lead.tokens")).otherwise(0).alias("system"),
    )
    inside = W.partitionBy("conv_id", "block").orderBy("turn", "role", "tie")
    up_to = inside.rowsBetween(W.unboundedPreceding, 0)
    # null is a key like any other within a struct
    placed = rows.join(offsets, (F.struct("conv_id") == F.struct(F.col("oc"))) & (F.col("block") == F.col("ob")))
    placed = placed.select(
        F.struct("conv_id").alias("conv"), "role", "tokens", "system", "total", F.concat("head", "body", F.lit(END)).alias("piece"), F.length("head").alias("head_chars"), F.length("body").alias("body_chars"),
        (F.col("c0") + F.row_number().over(inside) - 1).alias("ordinal"), (F.col("t0") + F.sum("tokens").over(up_to) - F.col("tokens")).alias("start"),
    )
    placed = stored(placed.withColumn("is_system", (F.col("ordinal") == 0) & (F.col("role") == "system")), "turns")
    own = F.floor(F.col("ordinal") / p.block)
    # the last turns of a chunk may be history of the next one's first window, the system turn goes to every chunk
    late = (F.col("ordinal") % p.block >= p.block - p.history_turns) & ((own + 1) * p.block < F.col("total"))
    chunks = F.when(F.col("is_system"), F.sequence(F.lit(0).cast("long"), F.floor((F.col("total") - 1) / p.block))).when(late, F.array(own, own + 1)).otherwise(F.array(own))
    dealt = placed.withColumn("chunk", F.explode(chunks))
    numbers = F.struct("ordinal", "tokens", "start", "is_system")
    folded = dealt.filter(~F.col("is_system") | (F.col("chunk") == 0)).groupBy("conv", "chunk").agg(F.array_sort(F.collect_list(numbers)).alias("xs"), F.first("system").alias("system"))
    spans = dealt.join(stored(folded.select("conv", "chunk", _windows(p).alias("wins")), "windows"), ["conv", "chunk"])
    within = F.filter("wins", lambda w: (F.col("ordinal") >= w["from"]) & (F.col("ordinal") < w["upto"]) | F.col("is_system"))
    every = spans.withColumn("w", F.explode(within)).withColumns({"first": F.col("w.first"), "repeated": F.col("ordinal") < F.col("w.first")})
    names = ["role", "tokens", "piece", "head_chars", "body_chars"]
    # a window holds budget / HEAD_TOKENS turns at most
    windows = every.groupBy("conv", "chunk", "first").agg(F.array_sort(F.collect_list(F.struct("ordinal", "repeated", *names))).alias("parts")).withColumn("conv_id", F.col("conv.conv_id"))
    starts = F.transform("parts", lambda x, i: F.aggregate(F.slice("parts", F.lit(1), i), F.lit(len(BOS)).cast("long"), lambda n, y: n + F.length(y["piece"])) + x["head_chars"])
    marked = F.transform(F.arrays_zip(F.col("parts").alias("part"), starts.alias("at")), lambda x: F.struct((x["part"]["role"] == "assistant").alias("target"), x["part"]["repeated"].alias("repeated"), x["at"].alias("start"), (x["at"] + x["part"]["body_chars"]).alias("end")))
    loss = F.transform(F.filter("spans", lambda x: x["target"] & ~x["repeated"]), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))
    windows = windows.withColumns({"spans": marked, "n_tokens": F.aggregate("parts", F.lit(0).cast("long"), lambda n, x: n + x["tokens"])})
    return windows.select(
        "conv_id", F.array_min(F.transform(F.filter("parts", lambda x: ~x["repeated"]), lambda x: x["ordinal"])).alias("first_turn"), F.size("parts").alias("n_turns"), F.size(F.filter("parts", lambda x: x["repeated"])).alias("n_repeated"),
        "n_tokens", (F.col("n_tokens") > p.budget).alias("over_budget"), F.concat(F.lit(BOS), F.array_join(F.transform("parts", lambda x: x["piece"]), "")).alias("formatted"), loss.alias("loss_spans"),
    )


def read_windows(windows: DataFrame) -> DataFrame:
    """conv_id, first_turn, turns (array of role, text: the new turns, parsed from the formatted text), loss (the text
    under the loss mask, unescaped), formatted."""
    body = F.substr("formatted", F.lit(len(BOS) + 1))
    pieces = F.split(body, END, -1)
    new = F.slice(pieces, F.col("n_repeated") + 1, F.size(pieces) - 1 - F.col("n_repeated"))
    role = lambda x: unescape(F.substr(F.substring_index(x, CLOSE, 1), F.lit(len(OPEN) + 1)))
    said = lambda x: unescape(F.substr(x, F.length(F.substring_index(x, CLOSE, 1)) + len(CLOSE) + 1))
    turns = F.transform(new, lambda x: F.struct(role(x).alias("role"), said(x).alias("text")))
    loss = F.array_join(F.transform("loss_spans", lambda s: unescape(F.substr("formatted", s["start"] + 1, s["end"] - s["start"]))), "")
    return windows.select("conv_id", "first_turn", turns.alias("turns"), loss.alias("loss"), "formatted")
