from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest
from hypothesis import given, strategies as st

from aduana.llm.chat import PROBE, escaped, op1_chat, read_back, turns_of, unescaped, windows
from aduana.llm.packing import default_tokenizer, token_ids
from tests.llm.cases import crowded, table

ROWS = "conv_id long, turn long, role string, text string"
LONG = [
    (1, i, "system" if i == 0 else ("user", "assistant")[i % 2], f"turn {i} <turn x> \\ </turn>\n " * (1 + i % 7))
    for i in range(700)
]
ODD = [
    (2, 5, "assistant", "twice"), (2, 5, "assistant", "twice"), (2, None, "user", "no number"), (2, 3, "system", None),
    (3, 0, "assistant", ""), (None, 1, "assistant", "no id"), (None, None, None, None), (4, -5, "assistant", "x " * 9000),
    (4, 10**12, "assistant", "far"), (5, 1, "a>\n\\<turn b", "odd role"), (5, 2, "assistant", "é𝒳"),
]


def expected(rows):
    by_id = defaultdict(list)
    for conv, turn, role, text in rows:
        by_id[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in by_id.items():
        turns.sort()
        every = "".join(f"{t[2]}\n{t[3]}\n" for t in turns)
        learned = "".join(t[3] for t in turns if t[2] == "assistant")
        out[conv] = (
            len(turns), hashlib.sha256(every.encode()).hexdigest(), len(learned),
            hashlib.sha256(learned.encode()).hexdigest(),
        )
    return out


def digests(df):
    return {r["conv_id"]: tuple(r)[1:5] for r in df.collect()}


@given(st.text(st.sampled_from("\\<>/turnlg \n"), max_size=40))
def test_escaping_is_reversible_and_hides_the_marks(text):
    assert unescaped(escaped(text)) == text
    assert "<turn" not in escaped(text) and "</turn" not in escaped(text)


def test_whole_table(spark):
    df = table(spark, "conversations")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)]
    got = op1_chat(spark, df)
    assert digests(got) == expected(rows)
    assert all(r["formatted_chars"] > r["loss_chars"] for r in got.collect())


def test_odd_rows(spark):
    df = crowded(spark.createDataFrame(ODD + LONG, ROWS))
    assert digests(read_back(windows(df, budget=200, history_tokens=80, segment_turns=64))) == expected(ODD + LONG)
    assert digests(read_back(windows(df))) == expected(ODD + LONG)
    assert windows(df.limit(0)).count() == 0
    assert digests(op1_chat(spark, df.limit(0))).keys() == {-7}


def test_tokens_are_those_of_the_text(spark):
    """Turns of two letters, of backslashes, of marks; many roles: the text of a window has the tokens it states."""
    kinds = ["ok", "\\" * 30, "<turn a></turn>" * 3, "", "  \n", "é𝒳!", "it's", " x ", "\n\n"]
    rows = [(c, t, ["user", "assistant", "a b\n", ""][t % 4], kinds[c]) for c in range(len(kinds)) for t in range(600)]
    path = default_tokenizer()
    for r in windows(spark.createDataFrame(rows, ROWS)).collect():
        assert len(token_ids(r["text"], path)) == r["n_tokens"] <= 2048


@pytest.mark.parametrize("step", [1, 10, 600])
def test_history_at_any_numbering(spark, step):
    """Segments and history go by the order of the turns, not by their numbers."""
    rows = [(1, step * i, "system" if i == 0 else ("user", "assistant")[i % 2], f"turn {i} " * 9) for i in range(300)]
    df = spark.createDataFrame(rows, ROWS).repartition(4)
    got = windows(df, budget=300, history_tokens=120, history_turns=3, segment_turns=64).orderBy("segment", "window").collect()
    assert len({r["segment"] for r in got}) == 5 and not any(r["alone"] for r in got)
    repeated = [[unescaped(t) for _, t in turns_of(r["text"])[:r["n_repeated"]]] for r in got]
    assert all(x[0] == "turn 0 " * 9 and len(x) >= 3 for x in repeated[1:])
    assert [(r["segment"], r["window"], r["n_repeated"]) for r in got] == _shape(spark, 1)


def _shape(spark, step):
    rows = [(1, step * i, "system" if i == 0 else ("user", "assistant")[i % 2], f"turn {i} " * 9) for i in range(300)]
    got = windows(spark.createDataFrame(rows, ROWS), budget=300, history_tokens=120, history_turns=3, segment_turns=64)
    return [(r["segment"], r["window"], r["n_repeated"]) for r in got.orderBy("segment", "window").collect()]


def test_turns_without_a_number_are_spread(spark):
    rows = [(1, None, "assistant", "same")] * 500 + [(None, 3, "user", f"t{i % 5}") for i in range(400)]
    df = spark.createDataFrame(rows, ROWS)
    got = windows(df, segment_turns=50)
    assert {(r["conv_id"], r["segment"]) for r in got.collect()} == {(1, i) for i in range(10)} | {(None, i) for i in range(8)}
    assert digests(read_back(got)) == expected(rows)


def test_windows_keep_budget_system_turn_and_history(spark):
    df = spark.createDataFrame(LONG, ROWS).repartition(5)
    rows = windows(df, budget=300, history_tokens=120, history_turns=3, segment_turns=100)
    rows = rows.orderBy("segment", "window").collect()
    texts = {(role, text): number for _, number, role, text in LONG}
    repeated = 0
    for i, r in enumerate(rows):
        turns = [texts[t] for t in turns_of(r["text"])]
        head, fresh = turns[:r["n_repeated"]], turns[r["n_repeated"]:]
        assert r["n_tokens"] <= 300
        assert fresh == list(range(fresh[0], fresh[-1] + 1)) and r["first_turn"] == fresh[0]
        if i:
            assert head[0] == 0  # the system turn, once
            assert head[1:] == list(range(fresh[0] - len(head) + 1, fresh[0])) and len(head) <= 4
            repeated += len(head) - 1
        learned = [r["text"][s["start"]:s["end"]] for s in r["loss"]]
        assert [unescaped(x) for x in learned] == [LONG[n][3] for n in fresh if LONG[n][2] == "assistant"]
    assert repeated > len(rows)  # most have a history, also at the start of a segment
    assert sum(len(turns_of(r["text"])) - r["n_repeated"] for r in rows) == len(LONG)
