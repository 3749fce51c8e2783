"""Preference formatting against plain Python."""

import random

from pyspark.sql import functions as F

from ledgerstrata.llm.chat import CLOSE, OPEN, format_preferences, swapped_replies, turns_of

PAIRS = "pair_id long, chosen array<struct<role:string,text:string>>, rejected array<struct<role:string,text:string>>"


def render(turns):
    out, spans = "", []
    for role, text in turns:
        start = len(out) + len(OPEN) + len(role) + 1
        out += f"{OPEN}{role}\n{text}{CLOSE}\n"
        if role == "assistant":
            spans.append((start, len(out) - 1))
    return out, spans


def formatted(chosen, rejected):
    n = 0
    while n < min(len(chosen), len(rejected)) and chosen[n] == rejected[n]:
        n += 1
    (a, sa), (b, sb) = render(chosen[n:]), render(rejected[n:])
    return n, render(chosen[:n])[0], a, b, sa, sb


def test_equals_plain_python(spark):
    rng = random.Random(51)
    turn = lambda: (rng.choice(["user", "assistant", "system"]), rng.choice(["", "hi", "é😀", "x\ny"]))
    pairs = []
    for i in range(200):
        shared = [turn() for _ in range(rng.randint(0, 3))]
        pairs.append((i, shared + [turn() for _ in range(rng.randint(0, 3))], shared + [turn() for _ in range(rng.randint(0, 3))]))
    df = spark.createDataFrame(pairs, PAIRS).withColumn("_n", F.lit(7)).withColumn("prompt_id", F.lit(1))
    got = {r.pair_id: r for r in format_preferences(df).collect()}
    for i, chosen, rejected in pairs:
        r = got[i]
        spans = [[tuple(s) for s in side] for side in (r.chosen_spans, r.rejected_spans)]
        assert (r.n_common, r.prompt, r.chosen, r.rejected, *spans) == formatted(chosen, rejected)
        assert r._n == 7


def test_nulls_and_empty_tables(spark):
    pairs = [(1, None, [("user", None)]), (2, [(None, "x"), None], [(None, "x")]), (None, None, None)]
    got = {r.pair_id: r for r in format_preferences(spark.createDataFrame(pairs, PAIRS)).collect()}
    assert got[1].prompt == "" and got[1].rejected == render([("user", "")])[0]
    assert got[2].n_common == 1 and got[2].chosen == got[2].rejected == ""
    assert got[None].n_common == 0 and got[None].prompt == ""
    assert format_preferences(spark.createDataFrame([], PAIRS)).count() == 0


def test_turns_and_swapped_replies(spark):
    rows = [
        (2, 1, "assistant", "a2"), (2, 0, "user", "q2"), (2, 2, "user", "more"),
        (3, 0, "user", "q3"), (3, 1, "assistant", "a3"), (3, 1, "assistant", "a3"),
        (4, 0, "assistant", None), (6, 0, "user", "q"), (None, 0, "assistant", "x"), (7, None, None, None),
    ]
    convs = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    turns = {r.conv_id: [tuple(t) for t in r.turns] for r in turns_of(convs).collect()}
    assert turns[2] == [("user", "q2"), ("assistant", "a2"), ("user", "more")]
    assert turns[7] == [("", "")] and None not in turns
    got = {r.conv_id: ([t.text for t in r.chosen], [t.text for t in r.rejected]) for r in swapped_replies(convs).collect()}
    assert got == {2: (["q2", "a2"], ["q2", "a3"]), 3: (["q3", "a3", "a3"], ["q3", "a3", "a2"]), 4: ([""], [])}
    assert swapped_replies(convs.limit(0)).count() == 0


def test_columns_named_like_results_give_way(spark, tmp_path):
    df = spark.createDataFrame([(1, [("user", "a")], [("user", "b")])], PAIRS)
    for name in ("Prompt", "n_common", "chosen_spans", "rejected_spans", "a.b"):
        df = df.withColumn(name, F.lit("old"))
    got = format_preferences(df)
    assert got.columns == ["pair_id", "a.b", "n_common", "prompt", "chosen", "rejected", "chosen_spans", "rejected_spans"]
    got.write.parquet(str(tmp_path / "out"))
    assert got.first().prompt == "" and got.first()["a.b"] == "old"
