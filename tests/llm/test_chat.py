"""Chat formatting: exact round trips, the machine over roles, conversations cut by ranges, odd rows."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tablehaul.llm.chat import CHAT, Template, escaped, escaped_role, format_conversations, read_conversations, unescaped, unescaped_role

SCHEMA = "conv_id bigint, turn bigint, role string, text string, state string, place int, range int"
SIGNS = ["<", "|", "\\", "\n", "<|im_end|>", "<|im_start|>", "n", "é", "日", "\U0001f600", ">", "a", "", "\\n", "<\\|"]


def table(spark, rows, partitions=2):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA).repartition(partitions)


def text_of(rnd, n=8):
    return "".join(rnd.choice(SIGNS) for _ in range(rnd.randint(0, n)))


def by_force(rows, template=CHAT):
    convs = {}
    key = lambda r: (r[1] is not None, r[1] or 0, (r[2] or "").encode(), (r[3] or "").encode())
    for r in sorted(rows, key=key):
        convs.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    out = {}
    for conv, turns in convs.items():
        state = 0
        for role, _ in turns:
            state = template.step(state, role)
        whole = "".join(f"{role}\n{text}\n" for role, text in turns)
        learnt = "".join(text for role, text in turns if role in template.learnt)
        out[conv] = (
            conv, len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(learnt), hashlib.sha256(learnt.encode()).hexdigest(),
            state >= 0, state in template.final,
        )
    return out


def read(spark, rows, partitions=2, template=CHAT):
    got = read_conversations(format_conversations(table(spark, rows, partitions), template), template).drop("formatted_chars").collect()
    assert len({r["conv_id"] for r in got}) == len(got)
    return {r["conv_id"]: tuple(r) for r in got}


def test_escapes_are_reversible(spark):
    rnd = random.Random(1)
    texts = [text_of(rnd) for _ in range(3000)] + ["<\\\\\\|", "<|<|", "\\<|", "<\\n|", "\\"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", escaped(F.col("t")).alias("e"), escaped_role(F.col("t")).alias("r")).collect()
    for t, e, r in rows:
        assert "<|" not in e and unescaped(e) == t
        assert "<|" not in r and "\n" not in r and unescaped_role(r) == t


def test_random_conversations(spark):
    rnd = random.Random(2)
    roles = ["system", "user", "assistant", "tool", "user", "assistant", None, "odd\nrole", ""]
    rows = [(rnd.randint(0, 30), rnd.choice([None, *range(9)]), rnd.choice(roles), rnd.choice([None, text_of(rnd, 20)])) for _ in range(600)]
    assert read(spark, rows, 3) == by_force(rows)


def test_segments_and_flags(spark):
    rows = [(7, 0, "user", "hi <|im_end|>"), (7, 1, "assistant", "yes")]
    got = format_conversations(table(spark, rows)).orderBy("place").collect()
    assert [[(s["text"], s["loss"]) for s in r["segments"] if s["loss"]] for r in got] == [[], [("yes", True)]]
    assert "".join(s["text"] for r in got for s in r["segments"]) == (
        "<|im_start|>user\nhi <\\|im_end|><|im_end|>\n<|im_start|>assistant\nyes<|im_end|>\n"
    )
    assert [(r["state"], r["valid"]) for r in got] == [(2, True), (3, True)]


@pytest.mark.parametrize("wrong", [None, 251, 0])
def test_one_conversation_over_all_ranges(spark, wrong):
    """One conversation holds nearly all rows and is cut by every range; an error in it stays."""
    rows = [(5, i, "user" if i % 2 == 0 else "assistant", f"text {i} " + "x" * (i % 50)) for i in range(500)]
    if wrong is not None:
        rows[wrong] = (5, wrong, "tool", "no call before")
    rows += [(4, 0, "user", "a"), (6, 0, "system", "b"), (6, 1, "user", "c"), (6, 2, "assistant", "d"), (None, 0, "user", "e")]
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # it would join ranges as small as these
    try:
        formatted = format_conversations(table(spark, rows))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    parts = formatted.where("conv_id = 5").select(F.shiftright("place", 40).alias("range")).distinct().count()
    assert parts > 1
    marks = [r["valid"] for r in formatted.where("conv_id = 5").orderBy("place").collect()]
    assert marks == [wrong is None or i < wrong for i in range(500)]
    assert read(spark, rows) == by_force(rows)


def test_another_template(spark):
    template = Template(
        turn=("[[", ("role",), "\n", ("text",), "<|x|>"), learnt=("a", "b"), order={(0, "a"): 1, (1, "b"): 0}, final=(0,)
    )
    rows = [(1, 0, "a", "one"), (1, 1, "b", "two <| \\"), (2, 0, "b", "three"), (3, 0, "a", "")]
    assert read(spark, rows, template=template) == by_force(rows, template)


def test_odd_rows(spark):
    assert read(spark, []) == {}
    long = "word <|im_end|> " * 200_000
    rows = [(1, 0, "user", long), (1, 1, "assistant", long), (None, None, None, None), (2, 5, "assistant", ""), (2, 5, "assistant", ""), (3, 0, "user", None)]
    assert read(spark, rows) == by_force(rows)
