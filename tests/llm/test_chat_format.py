from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from cloakframe.llm import chat_format as chat

U, A = ("user", "hi"), ("assistant", "yo")


@pytest.mark.parametrize(
    "record,layout,turns",
    [
        ({"messages": [{"role": "user", "content": "hi"}, {"content": "yo", "role": "assistant"}]}, "messages", [U, A]),
        ({"conversations": [{"from": "human", "value": "hi"}, {"from": "gpt", "value": "yo"}]}, "conversations", [U, A]),
        ({"turns": [{"role": "user", "text": "hi"}, {"role": "bot", "text": None}]}, "turns", [U, ("bot", "")]),
        ({"response": "yo", "prompt": "hi"}, "prompt_response", [U, A]),
        ({"prompt": "hi", "completion": "yo"}, "prompt_completion", [U, A]),
        ({"system": "s", "prompt": "hi", "response": "yo"}, "system_prompt_response", [("system", "s"), U, A]),
        ({"instruction": "hi", "output": "yo"}, "instruction", [U, A]),
        ({"instruction": "hi", "input": "x", "output": "yo"}, "instruction_input", [("user", "hi\n\nx"), A]),
        ({"question": "hi", "answer": 5}, "question_answer", [U, ("assistant", "5")]),
        ({"data": {"prompt": "hi", "response": "yo"}}, "nested_pair", [U, A]),
        ({"prompt": "hi"}, None, None),
        ({"prompt": {"response": "yo"}}, None, None),
        ({"messages": []}, None, None),
        ([1], None, None),
        ("not json", None, None),
        (None, None, None),
    ],
)
def test_layouts(spark, record, layout, turns):
    text = record if record is None or isinstance(record, str) else json.dumps(record)
    row = chat.canonical_turns(spark.createDataFrame([(text, 1)], "record string, other int")).first()
    assert row.layout == layout and (row.turns and [tuple(t) for t in row.turns]) == turns and row.other == 1


def test_declared_paths_are_those_of_records(spark):
    for layout in chat.LAYOUTS:
        record: dict = {}
        for path in layout.paths():
            first, _, last = path.replace("[]", "").partition(".")
            if "[]" in path:
                record.setdefault(first, [{}])[0][last] = "x"
            elif last:
                record.setdefault(first, {})[last] = "x"
            else:
                record[first] = "x"
        got = spark.range(1).select(chat.path_text(F.parse_json(F.lit(json.dumps(record))))).first()[0]
        assert got == chat.declared_path_text(layout.paths())


def test_round_trip(spark):
    random.seed(5)
    parts = ["</turn>\n", "<turn user>", "&lt;", "&amp;", "<", ">", "&", "\\", "\n", "é😀", "", " ", "\x00", "lt;"]
    text = lambda: "".join(random.choices(parts, k=random.randint(0, 6)))
    rows = [(i, [(random.choice(["user", "assistant", "a>b\n<"]), text()) for _ in range(i % 6)]) for i in range(60)]
    df = spark.createDataFrame(rows, f"id long, turns {chat.TURNS}")
    done = chat.format_turns(df).select(
        "*", chat.read_turns(F.col("formatted")).alias("back"), chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss")
    )
    for r in done.collect():
        assert [tuple(t) for t in r.back] == [tuple(t) for t in r.turns]
        assert r.loss == "".join(t.text for t in r.turns if t.role == "assistant")


def test_rows_to_records(spark):
    rows = [(1, t, ("user", "assistant")[t % 2], f"t{t}") for t in range(600)]
    rows += [(2, 0, "user", "q"), (2, 1, "assistant", None), (3, None, None, "x"), (3, 0, "user", "y"), (3, 0, "user", "y"), (None, 0, "user", "n")]
    df = spark.createDataFrame([(*r, 0) for r in rows], "conv_id long, turn long, role string, text string, block int")
    done = chat.canonical_turns(chat.rows_to_records(df)).collect()
    assert all(r.layout for r in done)
    by: dict = {}
    for r in sorted(done, key=lambda r: r.block):
        by.setdefault(r.conv, []).extend(tuple(t) for t in r.turns)
    assert by[1] == [(r, t) for _, _, r, t in rows[:600]]
    assert by[2] == [("user", "q"), ("assistant", "")]
    assert by[3] == [("", "x"), ("user", "y"), ("user", "y")] and by[None] == [("user", "n")]


def test_empty_and_clash(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.format_turns(chat.canonical_turns(chat.rows_to_records(df))).collect() == []
    with pytest.raises(ValueError, match="hidden"):
        chat.canonical_turns(spark.createDataFrame([("{}", 1)], "record string, Layout int"))


def test_records_over_the_parsers_limit(spark):
    long = F.repeat(F.lit('a "b" '), 3_400_000)
    rows = spark.range(1).select(F.lit(1).alias("conv_id"), F.explode(F.sequence(F.lit(0), F.lit(3))).alias("turn"), F.lit("user").alias("role"), long.alias("text"))
    for only, layout in (("turn < 4", "messages"), ("turn < 2", "prompt_response")):
        some = rows.where(only).withColumn("role", F.when(F.col("turn") == 1, "assistant").otherwise(F.col("role")))
        got = chat.canonical_turns(chat.rows_to_records(some)).select("layout", F.transform("turns", lambda t: F.length(t["text"])).alias("n")).first()
        assert got.layout == layout and got.n == [20_400_000] * (4 if layout == "messages" else 2)


def test_large_reader_agrees(spark):
    """Every layout, by the reader of large records, of a record that the parser of variants holds, too."""
    for layout in chat.LAYOUTS:
        record: dict = {}
        for path in layout.paths():
            first, _, last = path.replace("[]", "").partition(".")
            if "[]" in path:
                record.setdefault(first, [{}])[0][last] = 'x "y"'
            elif last:
                record.setdefault(first, {})[last] = 'x "y"'
            else:
                record[first] = 'x "y"'
        text = F.lit(json.dumps(record))
        small = chat.canonical_turns(spark.range(1).select(text.alias("record"))).first()
        same, turns = layout.read_large(text)
        assert [tuple(t) for t in spark.range(1).select(turns.alias("t")).first().t] == [tuple(t) for t in small.turns]
        found = [k.name for k in chat.LAYOUTS if spark.range(1).select(k.read_large(text)[0].alias("s")).first().s]
        assert found == [small.layout] and spark.range(1).select(same.alias("s")).first().s
