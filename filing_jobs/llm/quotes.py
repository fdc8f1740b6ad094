"""Conversations in reply order, without quotes.

Lines that begin with quote marks (``>``, also nested) are quotes of their level. A run of lines of
one level is a passage; normalised and hashed it is looked up among what the messages themselves say:
their whole text, their paragraphs and their lines. The message found is what the quoting one replies
to. A message without a found quote replies to the turn before it. Everything is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filing_jobs.llm.common import stored, while_stored

MARKS = r"^[ \t]*((?:>[ \t]?)+)"
#: A passage shorter than this many characters, normalised, names messages of its own conversation only.
SHORTEST = 12
#: Turns of a conversation that are put in order at a time.
RANGE = 1024


def level_of(line: Column) -> Column:
    """The number of quote marks in front of a line."""
    return F.length(F.regexp_replace(F.regexp_extract(line, MARKS, 1), r"[ \t]", ""))


def normal(text: Column) -> Column:
    """Lower case, without marks at the beginning of lines, white space as single blanks."""
    plain = F.regexp_replace(text, r"(?m)^[ \t]*(?:>[ \t]?)+", "")
    return F.lower(F.trim(F.regexp_replace(plain, r"\s+", " ")))


def names_messages(text: Column, conv: Column) -> Column:
    return (F.length(text) >= SHORTEST) | ((F.length(text) > 0) & conv.isNotNull())


def hashed(text: Column, conv: Column) -> Column:
    """The passage's hash; that of a short one belongs to its conversation."""
    return F.sha2(F.when(F.length(text) >= SHORTEST, text).otherwise(F.concat(F.to_json(F.struct(conv.alias("conv"))), text)), 256)


def parsed(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, turn, role, body, lines, passages): the message's own words and its quoted passages by level."""
    source = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    lines = F.transform(F.split(F.regexp_replace(source, "\r\n?", "\n"), "\n"), lambda x: F.struct(level_of(x).alias("level"), x.alias("line")))
    rows = df.select(F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").alias("turn"), F.col(f"`{role}`").alias("role"), lines.alias("lines"))
    own = F.array_join(F.transform(F.filter("lines", lambda x: x["level"] == 0), lambda x: x["line"]), "\n")
    # fold the lines: a change of level closes the passage that is open
    start = F.struct(F.array().cast("array<struct<level:int,text:string>>").alias("done"), F.lit(0).alias("level"), F.lit("").alias("text"))

    def step(acc: Column, x: Column) -> Column:
        same = acc["level"] == x["level"]
        closed = F.when(same | (acc["level"] == 0), acc["done"]).otherwise(F.concat(acc["done"], F.array(F.struct(acc["level"].alias("level"), acc["text"].alias("text")))))
        grown = F.when(x["level"] == 0, F.lit("")).when(same, F.concat(acc["text"], F.lit("\n"), x["line"])).otherwise(x["line"])
        return F.struct(closed.alias("done"), x["level"].alias("level"), grown.alias("text"))

    def finish(acc: Column) -> Column:
        return F.when(acc["level"] == 0, acc["done"]).otherwise(F.concat(acc["done"], F.array(F.struct(acc["level"].alias("level"), acc["text"].alias("text")))))

    quoted = F.exists("lines", lambda x: x["level"] > 0)
    passages = F.when(quoted, F.aggregate("lines", start, step, finish)).otherwise(F.array().cast("array<struct<level:int,text:string>>"))
    body = F.trim(F.regexp_replace(own, r"\n{3,}", "\n\n"), F.lit("\n \t"))
    return rows.select("conv", "turn", "role", F.when(quoted, body).otherwise(own).alias("body"), passages.alias("passages"))


def originals(messages: DataFrame) -> DataFrame:
    """(hash, conv, turn) of what each message itself says: all of it, its paragraphs, its lines."""
    said = F.array_distinct(F.concat(F.array("body"), F.split("body", r"\n[ \t]*\n"), F.split("body", "\n")))
    rows = messages.select("conv", "turn", F.explode(F.transform(said, normal)).alias("part"))
    return rows.where(names_messages(F.col("part"), F.col("conv"))).select(hashed(F.col("part"), F.col("conv")).alias("hash"), "conv", "turn")


def links(df: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, turn, role, body, n_quotes, to_conv, to_turn, by_quote): every message and the one it replies to.

    Of its quoted passages the outermost level counts first, then the longest, then the last one; a
    passage that is found nowhere is tried line by line. A passage said in the same conversation before
    links there (latest such turn), however short it is; otherwise, from SHORTEST characters on, to the first
    message anywhere, in order of conversation and turn, that says it, if that is not the message itself.
    Without such a link: the turn before, if any. Repeated (conv, turn) rows stay, each with its own text.
    Null text counts as empty; a message with a null turn comes first in its conversation; one without a
    conversation stands alone (its quotes are only looked up among all messages).
    """
    messages = parsed(df, conv_col, turn_col, role_col, text_col).withColumn("row", F.struct(F.col("conv"), F.col("turn"), F.xxhash64("role", "body", F.to_json("passages"))))
    whole = F.transform("passages", lambda p: F.struct(p["level"].alias("level"), F.lit(0).alias("part"), normal(p["text"]).alias("text")))
    each = F.flatten(F.transform("passages", lambda p: F.transform(F.split(p["text"], "\n"), lambda x: F.struct(p["level"].alias("level"), F.lit(1).alias("part"), normal(x).alias("text")))))
    asked = messages.where(F.size("passages") > 0).select("row", F.posexplode(F.concat(whole, each)).alias("pos", "q")).where(names_messages(F.col("q.text"), F.col("row.conv")))
    asked = asked.select("row", F.col("row.conv").alias("own_conv"), F.col("row.turn").alias("own_turn"), "pos", F.col("q.level").alias("level"), F.col("q.part").alias("part"), F.length("q.text").alias("size"), hashed(F.col("q.text"), F.col("row.conv")).alias("hash"))

    # one message stands for all that say the same: the first anywhere, and the latest before in the conversation
    said = originals(messages).join(asked.select("hash").distinct(), "hash", "left_semi")
    first = said.groupBy("hash").agg(F.min(F.struct("conv", "turn")).alias("first"))
    both = asked.where("own_conv is not null").withColumn("asks", F.lit(0)).unionByName(said.where("conv is not null").select("hash", F.col("conv").alias("own_conv"), F.col("turn").alias("own_turn"), F.lit(1).alias("asks")), allowMissingColumns=True)
    upto = Window.partitionBy("hash", "own_conv").orderBy("own_turn", "asks").rowsBetween(Window.unboundedPreceding, 0)
    earlier = both.withColumn("earlier", F.max(F.when(F.col("asks") == 1, F.col("own_turn"))).over(upto)).where("asks = 0").drop("asks")
    found = earlier.unionByName(asked.where("own_conv is null"), allowMissingColumns=True).join(first, "hash", "left")
    elsewhere = F.when(~F.col("first.conv").eqNullSafe(F.col("own_conv")) | (F.col("first.turn") < F.col("own_turn")), F.col("first"))
    target = F.when(F.col("earlier").isNotNull(), F.struct(F.col("own_conv").alias("conv"), F.col("earlier").alias("turn"))).otherwise(elsewhere)
    best = found.withColumn("target", target).where("target is not null").groupBy("row").agg(F.min_by("target", F.struct("level", "part", -F.col("size"), -F.col("pos"))).alias("target"))

    # the turn before, also where one conversation has very many: inside ranges of turns, then over the ranges
    turns = messages.where("conv is not null").select("conv", "turn").distinct().withColumn("range", F.floor(F.col("turn") / RANGE))
    over = Window.partitionBy("conv").orderBy("range")
    ranges = turns.groupBy("conv", "range").agg(F.max("turn").alias("most")).withColumn("most", F.lag("most").over(over)).toDF("r_conv", "r_range", "most")
    inside = turns.withColumn("last", F.lag("turn").over(Window.partitionBy("conv", "range").orderBy("turn")))
    before_turn = inside.join(ranges, (F.col("conv") == F.col("r_conv")) & F.col("range").eqNullSafe(F.col("r_range"))).select(F.col("conv").alias("l_conv"), F.col("turn").alias("l_turn"), F.coalesce("last", "most").alias("last"))
    joined = messages.join(best.withColumnRenamed("row", "b_row"), F.col("row").eqNullSafe(F.col("b_row")), "left").join(before_turn, (F.col("conv") == F.col("l_conv")) & F.col("turn").eqNullSafe(F.col("l_turn")), "left")
    quoted = F.col("target").isNotNull()
    return joined.select(
        "conv", "turn", "role", "body", F.size("passages").alias("n_quotes"),
        F.when(quoted, F.col("target.conv")).when(F.col("last").isNotNull(), F.col("conv")).alias("to_conv"),
        F.when(quoted, F.col("target.turn")).otherwise(F.col("last")).alias("to_turn"),
        quoted.alias("by_quote"),
    )


def in_order(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """``links`` of every message with ``at``: its place among all, by conversation, turn, role, text and then the other columns.

    Sorted by ranges, so that a conversation of any length lies in many tasks; places skip from one range to the next.
    """
    with while_stored(links(df, **columns), "links") as found:
        # identical rows are dealt by their place in the stored table, so they need not lie in one range
        rows = found.withColumn("row", F.monotonically_increasing_id()).orderBy("conv", "turn", "role", "body", "n_quotes", "to_conv", "to_turn", "by_quote", "row")
        return stored(rows.drop("row").withColumn("at", F.monotonically_increasing_id()), "in-order")


def chats(df: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, part, messages): conversations as lists of (position, turn, role, content, reply_to) without quotes.

    A row holds at most RANGE messages, of one range of RANGE turns (``part``), so that neither a very long conversation
    nor a turn with very many messages is ever in one row; several rows may have one part.
    ``position`` is the message's place in the whole conversation, from 0, in reply order: a link inside a conversation
    always leads to an earlier turn. Messages without a conversation each are one. ``reply_to`` is null for a first message and for a reply to another
    conversation; ``to_conv`` and ``to_turn`` give the message replied to wherever it is. No rows, no chats.
    """
    placed = in_order(df, {"conv_col": conv_col, "turn_col": turn_col, "role_col": role_col, "text_col": text_col})
    message = {"turn": F.col("turn"), "role": F.col("role"), "content": F.col("body"), "reply_to": F.when(F.col("to_conv").eqNullSafe(F.col("conv")), F.col("to_turn"))} | {c: F.col(c) for c in ("to_conv", "to_turn", "n_quotes", "by_quote")}
    part = F.floor(F.col("turn") / RANGE)
    # chunks of at most RANGE places that follow one another; null turns come first in them
    cut = placed.where("conv is not null").withColumns({"chunk": F.expr(f"at div {RANGE}"), "range": F.coalesce(part, F.lit(-(1 << 54)))})
    before = lambda *keys: Window.partitionBy(*keys[:-1]).orderBy(keys[-1]).rowsBetween(Window.unboundedPreceding, -1)
    chunks = cut.groupBy("conv", "chunk").agg(F.count("*").alias("n")).select("conv", "chunk", F.coalesce(F.sum("n").over(before("conv", "chunk")), F.lit(0)).alias("ahead"))
    ranges = cut.groupBy("conv", "chunk", "range").agg(F.count("*").alias("n")).select("conv", "chunk", "range", F.coalesce(F.sum("n").over(before("conv", "chunk", "range")), F.lit(0)).alias("inside"))
    start = ranges.join(chunks, ["conv", "chunk"]).select("conv", "chunk", "range", (F.col("ahead") + F.col("inside")).alias("start"))
    # only the counts are joined; the messages are shuffled once, into their rows
    of = cut.groupBy("conv", "chunk", "range").agg(F.array_sort(F.collect_list(F.struct("at", *(c.alias(n) for n, c in message.items())))).alias("m")).join(start, ["conv", "chunk", "range"])
    numbered = F.transform("m", lambda m, i: F.struct((F.col("start") + i).alias("position"), *(m[n].alias(n) for n in message)))
    whole = of.select(F.col("conv").alias(conv_col), F.floor(F.element_at("m", 1)["turn"] / RANGE).alias("part"), numbered.alias("messages"))
    alone = F.array(F.struct(F.lit(0).cast("long").alias("position"), *(c.alias(n) for n, c in message.items())))
    return whole.unionByName(placed.where("conv is null").select(F.col("conv").alias(conv_col), part.alias("part"), alone.alias("messages")))
