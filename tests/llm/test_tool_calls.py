"""Order, cycles, broken messages and schemas of tool calls, against brute force."""

import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from histload.llm import tool_calls

CALLS = "conv_id long, turn long, call_id string, name string, arguments string, depends_on array<string>"
MESSAGES = "conv_id long, turn long, role string, text string"


def brute_order(calls):
    """Of each call its place, or None if it is on a cycle or waits for one."""
    turns = {(c, i): t for c, t, i, _, _, _ in calls}
    needs = {(c, i): [(c, d) for d in dict.fromkeys(after) if (c, d) in turns] for c, _, i, _, _, after in calls}
    place, left = {}, set(turns)
    while True:
        free = [k for k in left if not any(d in left for d in needs[k])]
        if not free:
            return place | dict.fromkeys(left)
        for k in free:
            place[k] = max([(turns[k], 0), *((place[d][0], place[d][1] + 1) for d in needs[k])])
        left -= set(free)


def orders(spark, calls):
    rows = tool_calls.ordered(spark.createDataFrame(calls, CALLS)).collect()
    assert len(rows) == len(calls)
    turns = {(c, i): t for c, t, i, _, _, _ in calls}
    for r in rows:
        if r.cyclic:
            assert (r["at"], r.step) == (turns[r.conv_id, r.call_id], 0)
    return {(r.conv_id, r.call_id): None if r.cyclic else (r["at"], r.step) for r in rows}


def call(conv, turn, i, *after):
    return (conv, turn, i, "t", "{}", list(after))


def test_order_and_cycles_of_random_graphs(spark):
    rng, calls = random.Random(5), []
    for conv in range(60):
        n = rng.randint(1, 12)
        forward = rng.random() < 0.6  # no cycles, but against the order of turns
        rank = rng.sample(range(n), n)
        for i in range(n):
            others = [j for j in range(n) if not forward or rank[j] < rank[i]]
            calls.append(call(conv, rng.randint(0, 4), f"c{i}", *(f"c{j}" for j in rng.sample(others, min(len(others), rng.randint(0, 2))))))
    want = brute_order(calls)
    assert orders(spark, calls) == want
    assert sum(p is None for p in want.values()) > 50 < sum(p is not None and p[1] > 0 for p in want.values())


def test_calls_that_wait_for_a_cycle_are_marked(spark):
    calls = [call(1, 0, "c0", "c1"), call(1, 1, "c1", "c0"), call(1, 2, "c2", "c1"), call(1, 3, "c3", "c2"), call(1, 4, "c4"), call(2, 0, "c0", "c0"), call(3, 0, "c0")]
    assert {k for k, p in orders(spark, calls).items() if p is None} == {(1, "c0"), (1, "c1"), (1, "c2"), (1, "c3"), (2, "c0")}


def test_rounds_of_a_chain_grow_with_its_logarithm(spark, monkeypatch):
    n, rounds = 1000, []
    kept = tool_calls.stored
    monkeypatch.setattr(tool_calls, "stored", lambda df, name, *a: rounds.append(name) or kept(df, name, *a))
    calls = [call(1, n - i, f"c{i}", *([f"c{i - 1}"] if i else [])) for i in range(n)]
    calls += [call(2, i % 2, f"c{i}", f"c{1 - i}") for i in range(2)] + [call(2, i, f"d{i}", f"d{i - 1}") for i in range(1, 30)]
    found = orders(spark, calls)
    assert found == brute_order(calls) and found[1, "c999"] == (n, n - 1)
    assert rounds.count("settled") <= 13


def test_every_broken_message_gives_a_row(spark):
    said = lambda **o: json.dumps(o)
    messages = [
        (1, 0, "assistant", said(tool_calls={"id": "a"})),
        (1, 1, "tool", said(content="no identifier")),
        (1, 2, "tool", "no JSON"),
        (1, 3, None, "no role"),
        (1, 4, "tool", said(tool_call_id="gone", content=1)),
        (1, 5, "robot", "?"),
        (1, 6, "tool", None),
        (1, 7, "assistant", said(tool_calls=["text"])),
        (1, 8, "user", "x" * 300_000),
    ]
    table = spark.createDataFrame(messages, MESSAGES).withColumns({c: F.lit("x") for c in ("error", "place", "name", "n_calls", "call_id", "content")})
    rows = tool_calls.linked(*tool_calls.exchanges(table), {"answer": {"prompt": ("string", True), "turn": ("integer", True)}}).collect()
    assert Counter((r.status, r.errors) for r in rows) == Counter(
        [
            ("unlinked", "tool_calls are no array"),
            ("unlinked", "tool_call_id is missing"),
            ("unlinked", "the message is no JSON object"),
            ("unlinked", "the message is no JSON object"),
            ("unlinked", "no such role: null"),
            ("unlinked", "no such role: robot"),
            ("unlinked", "arguments are no JSON object; unknown tool"),
            ("orphan", ""),
            # plain texts of the assistant are results as well
            ("orphan", ""),
            ("orphan", ""),
            ("unanswered", ""),
        ]
    )


@pytest.mark.parametrize(
    "given, wrong",
    [
        ({"unit": "m", "n": 5, "tags": ["a"], "at": {"x": 1}}, ""),
        ({"unit": "ft", "n": 11, "tags": ["a", 2], "at": {"x": "y"}}, "at.x is no integer; n is above 10; tags holds what is no string; unit is none of m, km"),
        ({"n": 0.5, "at": {"z": 1}}, "at.x is missing; unknown: at.z; n is below 1; unit is missing"),
        ({"unit": 3, "at": [], "tags": {}}, "at is no object; tags is no array; unit is no string"),
    ],
)
def test_schemas_with_rules(spark, given, wrong):
    schema = {
        "unit": ("string", True, {"enum": ["m", "km"]}),
        "n": ("number", False, {"minimum": 1, "maximum": 10}),
        "tags": ("array", False, {"items": "string"}),
        "at": ("object", False, {"properties": {"x": ("integer", True)}}),
    }
    calls = spark.createDataFrame([(1, 0, "a", "go", json.dumps(given), [])], CALLS)
    results = spark.createDataFrame([], "conv_id long, turn long, call_id string, content string")
    assert tool_calls.linked(calls, results, {"go": schema}).first().errors == wrong
