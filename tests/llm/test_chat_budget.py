"""Windows of conversations of all shapes: budget, order, context and targets against a plain reading."""

import random

import pytest

from keyedlake.llm import chat


@pytest.fixture(scope="module")
def made(spark):
    rnd = random.Random(5)
    rows = []
    for c in range(60):
        turns = rnd.randint(1, 40)
        for t in range(turns):
            size = rnd.choice([1, 5, 30, 200, 700, 1500 if c % 10 == 0 else 400])
            role = "system" if t == 0 and c % 2 else ("user", "assistant")[t % 2]
            rows.append((c, t, role, " ".join(f"w{rnd.randint(0, 9)}" for _ in range(size if role != "system" else min(size, 300)))))
    rows += [(100, 0, "system", "s " * 1200), (100, 1, "user", "u"), (100, 2, "assistant", "a " * 900), (100, 3, "user", "b " * 900)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    return rows, chat.format_windows(df).orderBy("conv_id", "window").collect(), df


def test_no_window_over_budget_unless_a_turn_is(made):
    _, windows, _ = made
    over = [w for w in windows if w.n_tokens > chat.BUDGET]
    assert over and all(w.n_turns == 1 for w in over)
    assert max(w.n_tokens for w in windows if w.n_turns > 1) > 0.9 * chat.BUDGET


def test_turns_are_new_once_and_in_order(made):
    rows, windows, df = made
    said = {}
    for c, _, role, text in rows:
        said.setdefault(c, []).append((role, text))
    new, targets = {}, {}
    for w in chat.read_back(chat.format_windows(df)).orderBy("conv_id", "window").collect():
        new.setdefault(w.conv_id, []).extend((t.role, t.text) for t in w.turns)
        targets.setdefault(w.conv_id, []).extend(w.targets)
    assert new == said
    assert targets == {c: [t for r, t in turns if r == "assistant"] for c, turns in said.items()}


def test_context_is_the_system_turn_and_recent_turns(made):
    rows, windows, _ = made
    opening = {c: f"### system:\n{text}</turn>\n" for c, t, role, text in rows if t == 0 and role == "system"}
    again = [w for w in windows if w.n_repeated and w.conv_id in opening]
    assert again and sum(w.text.startswith(opening[w.conv_id]) for w in again) > len(again) / 2
    for w in windows:
        turns = w.text.split("</turn>\n")[:-1]
        assert len(turns) == w.n_turns and w.n_repeated < w.n_turns
