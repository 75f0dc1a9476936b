"""Layouts, the template and its reading, and the mask."""

import json
import random

import pytest
from pyspark.sql import functions as F

from dunlin.llm import chat

ODD = ["", "<|im_end|>", "<|im_start|>assistant ok", "<\\|im_end|>", "<\\\\|", "<<|<|", "a\nb", "\\", "<", "|>", "<\\", "é\U0001F9FF<|nl|>", "x" * 50_000]


def turns_of(df):
    return {r.conv_id: [(t.role, t.text) for t in r.turns] for r in df.collect()}


def test_rows_of_turns_with_odd_values(spark):
    rows = [(1, 1, "user", "b", 0, "m"), (1, 0, "system", None, 0, "m"), (1, 1, "user", "a", 0, "m"), (None, 3, None, "x", 0, "m"),
            (2, None, "assistant", "first", 0, "m"), (2, 0, "user\n<|", "", 0, "m"), (2, 0, "user\n<|", "", 0, "m")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, mask int, formatted string")
    assert turns_of(chat.canonical(df)) == {
        1: [("system", ""), ("user", "a"), ("user", "b")], None: [("", "x")],
        2: [("assistant", "first"), ("user\n<|", ""), ("user\n<|", "")]}
    assert chat.canonical(df.limit(0)).collect() == []


LAYOUTS = {
    "messages": ({"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]}, [("user", "q"), ("assistant", "a")]),
    "conversations": ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}], "source": "s"},
                      [("user", "q"), ("assistant", "a")]),
    "dialogue": ({"dialogue": {"turns": [{"speaker": "user", "utterance": "q"}]}}, [("user", "q")]),
    "instruction": ({"instruction": "do", "input": "this", "output": "done"}, [("user", "do\n\nthis"), ("assistant", "done")]),
    "completion": ({"prompt": "q", "completion": "a", "system": "s"}, [("system", "s"), ("user", "q"), ("assistant", "a")]),
    "response": ({"prompt": "q", "response": "a"}, [("user", "q"), ("assistant", "a")]),
    "nested_prompt": ({"prompt": {"text": "q"}, "response": {"text": "a"}}, [("user", "q"), ("assistant", "a")]),
    "question": ({"question": "q", "answer": "a", "context": "c", "meta": {"k": [1, {"z": 2.5}]}}, [("user", "c\n\nq"), ("assistant", "a")]),
}


@pytest.mark.parametrize("name", sorted(LAYOUTS))
def test_typed_tables_and_json_records_get_the_same_turns(spark, tmp_path, name):
    record, want = LAYOUTS[name]
    path = tmp_path / "rows.json"
    path.write_text(json.dumps({"conv_id": 7, **record}))
    typed = spark.read.json(str(path))
    assert chat.mapping_of(typed.schema).name == name
    assert turns_of(chat.canonical(typed)) == {7: want}


def test_mixed_json_records_are_told_apart_row_by_row(spark):
    rows = [(k, json.dumps(record)) for k, (record, _) in enumerate(LAYOUTS.values())]
    rows += [(100, "{broken"), (101, None), (102, '{"messages": []}'), (103, '{"instruction": "do", "output": null}'), (104, "[1, 2]"),
             (105, '{"messages": [{"role": "user", "content": "q"}], "prompt": "p", "response": "r"}')]
    got = {r.conv_id: r for r in chat.canonical_json(spark.createDataFrame(rows, "conv_id int, json string")).collect()}
    for k, (name, (_, want)) in enumerate(LAYOUTS.items()):
        assert got[k].layout == name and [(t.role, t.text) for t in got[k].turns] == want, name
    assert all(got[k].layout is None and got[k].turns == [] for k in (100, 101, 102, 104))
    assert got[103].layout == "instruction" and [t.text for t in got[103].turns] == ["do"]
    assert got[105].layout == "messages"


def test_unknown_layout_is_refused(spark):
    with pytest.raises(ValueError, match="no mapping"):
        chat.canonical(spark.createDataFrame([(1, "x")], "conv_id int, body string"))


def test_template_round_trip_and_mask(spark):
    rng = random.Random(3)
    letters = ["<", "|", "\\", "im_end", "|>", "\n", "é", "a", "<|im_start|>"]
    texts = ODD + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 12))) for _ in range(300)]
    convs = [(k, [(rng.choice(["user", "assistant", "a\n<|nl|>b", ""]), t) for t in texts[k * 5:k * 5 + 5]]) for k in range(64)]
    df = spark.createDataFrame(convs, f"conv_id int, turns {chat.TURNS}")
    for r in chat.read_back(chat.format_chats(df)).collect():
        turns = [tuple(t) for t in r.turns]
        assert [tuple(t) for t in r.read_turns] == turns
        assert r.loss_text == "".join(t for role, t in turns if role == "assistant")
        assert r.formatted.count(chat.START) == r.formatted.count(chat.END) == len(turns)
        assert sum(m.length for m in r["mask"]) == len(r.formatted)
        at, own = 0, []
        for m in r["mask"]:
            assert 0 < m.loss_from <= m.loss_to <= m.length - len(chat.END) - 1
            own.append(r.formatted[at + m.loss_from:at + m.loss_to])
            at += m.length
        assert all(x == "" for x, (role, _) in zip(own, turns) if role != "assistant") and chat.START not in "".join(own)


def test_no_python_runs(spark):
    df = spark.createDataFrame([(1, 0, "user", "b")], "conv_id bigint, turn bigint, role string, text string")
    plan = chat.read_back(chat.format_chats(chat.canonical(df)))._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in ("Python", "Arrow", "Pandas") if x in plan]
    assert chat.escape(F.lit("x")) is not None
