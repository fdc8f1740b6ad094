"""Linking quotes to original messages."""

import random

from filing_jobs.llm import queries, quotes


def test_links(spark):
    rows = [
        (1, 0, "user", "How do I cook the rice?\n\nAnd what about the beans, please?"),
        (1, 1, "assistant", "Boil it for ten minutes."),
        (1, 2, "user", "> Boil it   for TEN minutes.\nThanks, and then?\n\n\n\nBye"),
        (1, 3, "assistant", ">> Boil it for ten minutes.\n> Thanks, and then?\n>\n> Bye\nThen eat."),
        (1, 4, "user", "> And what about the beans, please?\n> nobody ever said this line\nSoak them."),
        (2, 0, "user", "Somebody wrote\n> Boil it for ten minutes.\nbut > this is no quote"),
        (2, 1, "assistant", "> short\nok"),
        (3, 0, "user", None),
        (3, 1, None, ""),
        (None, 0, "user", "> How do I cook the rice?"),
        (4, None, "user", "hello there everybody"),
        (4, 1, "user", "> hello there everybody\r\n> hello there everybody"),
        (6, 0, "a", "Yes?"), (6, 1, "b", "Yes please\nnow"), (6, 2, "a", "fine"), (6, 3, "b", "> yes PLEASE\nmore"), (6, 4, "b", "> ok\nsaid elsewhere only"),
        (None, 1, "user", "alone"), (None, 2, "user", "> alone\ntoo"),
        (5, 0, "a", "same again and again"), (5, 0, "b", "same again and again"), (5, 1, "a", "> same again and again"),
    ]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, conv int, hash string").repartition(3)
    got = {(r["conv"], r["turn"], r["role"]): r for r in quotes.links(df).collect()}
    assert len(got) == len(rows)
    to = {k: (r["to_conv"], r["to_turn"], r["by_quote"]) for k, r in got.items()}
    assert to[1, 0, "user"] == (None, None, False) and to[1, 1, "assistant"] == (1, 0, False)
    assert to[1, 2, "user"] == (1, 1, True) and to[1, 3, "assistant"] == (1, 2, True) and to[1, 4, "user"] == (1, 0, True)
    assert to[2, 0, "user"] == (1, 1, True) and to[2, 1, "assistant"] == (2, 0, False) and to[6, 3, "b"] == (6, 1, True) and to[6, 4, "b"] == (6, 3, False) and to[None, 0, "user"] == (1, 0, True)
    assert to[3, 0, "user"] == (None, None, False) and to[3, 1, None] == (3, 0, False)
    assert to[4, None, "user"] == (None, None, False) and to[5, 1, "a"] == (5, 0, True)
    assert got[1, 2, "user"]["body"] == "Thanks, and then?\n\nBye" and got[1, 3, "assistant"]["n_quotes"] == 2 and got[3, 0, "user"]["body"] == ""
    assert got[2, 0, "user"]["body"] == "Somebody wrote\nbut > this is no quote"
    chats = {r["conv_id"]: r for r in quotes.chats(df.where("turn is not null")).collect()}
    assert to[None, 1, "user"] == (None, None, False) and to[None, 2, "user"] == (None, None, False)
    nulls = [r["messages"] for r in quotes.chats(df.where("turn is not null")).collect() if r["conv_id"] is None]
    assert len(chats) == 7 and len(nulls) == 3 and all(len(m) == 1 for m in nulls)
    assert [m["turn"] for m in chats[1]["messages"]] == [0, 1, 2, 3, 4] and [m["reply_to"] for m in chats[1]["messages"]] == [None, 0, 1, 2, 0]
    assert quotes.chats(df.limit(0)).count() == 0


def test_plain_conversations_stay_as_they_are(spark):
    df = spark.createDataFrame([(1, k, "user", f"  text {k}\n\n\n\nmore ") for k in range(3)], "conv_id long, turn long, role string, text string")
    (chat,) = quotes.chats(df).collect()
    assert [m["content"] for m in chat["messages"]] == [f"  text {k}\n\n\n\nmore " for k in range(3)] and [m["reply_to"] for m in chat["messages"]] == [None, 0, 1]


def test_long_conversations(spark):
    df = spark.createDataFrame([(1, 7 * k, "user", f"text number {k}") for k in range(700)], "conv_id long, turn long, role string, text string")
    got = {r["turn"]: r["to_turn"] for r in quotes.links(df).collect()}
    assert got == {7 * k: 7 * (k - 1) if k else None for k in range(700)}
    assert sum(len(r["messages"]) for r in quotes.chats(df).collect()) == 700 and quotes.chats(df).count() == 5


def test_query_is_that_of_the_built_conversations(spark, tmp_path, monkeypatch):
    rows = [(1, 1, "b", "> Boil it for ten minutes.\nYes"), (1, 0, "a", "Where is it?"), (2, 0, "a", "Boil it for ten minutes."), (None, 3, "a", None)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    built = []
    monkeypatch.setattr(quotes, "chats", lambda df, own=quotes.chats: built.append(own(df)) or built[0])
    found = queries.op6_chat_quotes(spark, str(tmp_path)).collect()
    assert {(r["conv_id"], r["turn"]): (r["part"], r["position"]) for r in found} == {(1, 0): (0, 0), (1, 1): (0, 1), (2, 0): (0, 0), (None, 3): (0, 0)}
    got = {(r["conv_id"], r["turn"]): tuple(r)[3:8] for r in found}
    assert len(built) == 1 and got == {(1, 0): ("Where is it?", 0, None, None, False), (1, 1): ("Yes", 1, 2, 0, True), (2, 0): ("Boil it for ten minutes.", 0, None, None, False), (None, 3): ("", 0, None, None, False)}
    (chat,) = [r for r in built[0].collect() if r["conv_id"] == 1]
    assert [(m["turn"], m["to_conv"], m["to_turn"]) for m in chat["messages"]] == [(0, None, None), (1, 2, 0)]


def test_positions_of_repeated_and_null_turns(spark, monkeypatch):
    monkeypatch.setattr(quotes, "RANGE", 64)
    r = random.Random(2)
    rows = [(k % 3, r.choice([None, 0, 0, 1, 5, 70]), r.choice(["a", "b", None]), r.choice(["yes", "no", "maybe so", None])) for k in range(900)] + [(None, k % 4, "a", "alone") for k in range(5)]
    rows += [(7, 2, "a", "the very same")] * 300
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(6)
    chats = quotes.chats(df).collect()
    assert all(len(c["messages"]) <= 64 for c in chats) and sum(len(c["messages"]) for c in chats) == len(rows)
    for conv in (0, 1, 2, 7):
        key = lambda m: tuple((x is not None, x) for x in (m["turn"], m["role"], m["content"], m["n_quotes"], m["to_conv"], m["to_turn"], m["by_quote"]))
        messages = sorted((m for c in chats if c["conv_id"] == conv for m in c["messages"]), key=lambda m: m["position"])
        assert [m["position"] for m in messages] == list(range(len(messages))) and [key(m) for m in messages] == sorted(map(key, messages))
        assert all(c["messages"] == sorted(c["messages"], key=lambda m: m["position"]) for c in chats)
    assert [m["position"] for c in chats if c["conv_id"] is None for m in c["messages"]] == [0] * 5
