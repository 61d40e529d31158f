import hashlib
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from sensoria.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def formatted(turns):
    """Plain loop over the turns of one conversation."""

    def safe(text):
        out, i = "", 0
        while i < len(text):
            j = i + 1
            if text[i] == "<":
                while j < len(text) and text[j] == "\\":
                    j += 1
                if j < len(text) and text[j] == "|":
                    out += text[i:j] + "\\|"
                    i = j + 1
                    continue
            out += text[i]
            i += 1
        return out

    parts = []
    for role, block in groupby(turns, key=lambda turn: turn[0]):
        body = "<|im_sep|>".join(safe(text) for _, text in block)
        parts.append(f"<|im_start|>{safe(role).replace(chr(10), '<|nl|>')}\n{body}<|im_end|>\n")
    return "".join(parts)


AWKWARD = [
    (1, 0, "user", "a"), (1, 1, "user", ""), (1, 2, "assistant", "<|im_sep|>x<"), (1, 3, "assistant", "|y<\\|<\\\\|"),
    (2, 5, None, None), (2, None, "system", "early"), (2, 5, None, None), (2, 6, "assistant", None),
    (3, 1, "as\n<|sis|>", "<|im_end|>\n"), (3, 0, "assistant", "Ünï \U0001d54f\n\n<|nl|>"),
    (4, 0, "assistant", "only\\"), (None, 0, "user", "no key"), (5, 1, "b", "2"), (5, 1, "a", "9"), (5, 1, "a", "1"),
    (6, 0, "user", "<" * 50 + "|" * 3 + "\\" * 7), (7, 0, "", ""), (8, 0, "user", "long " * 100_000),
]


def grouped():
    held = {}
    for conv, turn, role, text in AWKWARD:
        held.setdefault(conv, []).append((-1 if turn is None else turn, role or "", text or ""))
    return {conv: [turn[1:] for turn in sorted(turns)] for conv, turns in held.items()}


def test_awkward_conversations_against_a_loop(spark):
    rows = spark.createDataFrame(AWKWARD, SCHEMA).withColumns(
        {name: F.lit("x") for name in ("turns", "segments", "formatted", "part")}
    )
    found = chat.format_chats(rows).withColumns(
        {"back": chat.read_turns(F.col("formatted")), "loss": chat.read_loss(F.col("segments"))}
    )
    found = {r.conv_id: r for r in found.collect()}
    wanted = grouped()
    assert set(found) == set(wanted)
    for conv, turns in wanted.items():
        r = found[conv]
        assert r.formatted == formatted(turns)
        assert [tuple(turn) for turn in r.back] == turns
        assert "".join(part.text for part in r.segments) == r.formatted
        assert r.loss == "".join(text for role, text in turns if role == "assistant")
        assert sum(part.loss for part in r.segments) == sum(role == "assistant" for role, _ in turns)


def test_whole_table(spark):
    folder = "/root/testdata/sf0.01"
    held = {-1: [(0, "user", chat.INJECTED), (1, "assistant", chat.INJECTED)]}
    for r in spark.read.parquet(f"{folder}/conversations.parquet").collect():
        held.setdefault(r.conv_id, []).append((r.turn, r.role or "", r.text or ""))
    found = {r.conv_id: r for r in chat.op13_chat(spark, folder).collect()}
    assert set(found) == set(held)
    for conv, turns in held.items():
        turns = [turn[1:] for turn in sorted(turns)]
        loss = "".join(text for role, text in turns if role == "assistant")
        r = found[conv]
        assert (r.n_turns, r.loss_chars, r.formatted_chars) == (len(turns), len(loss), len(formatted(turns)))
        assert r.turns_sha256 == digest("".join(f"{role}\n{text}\n" for role, text in turns))
        assert r.loss_sha256 == digest(loss)


def test_no_python_and_one_shuffle(spark, capsys):
    chat.op13_chat(spark, "/root/testdata/sf0.001").explain("formatted")
    plan = capsys.readouterr().out.split("== Initial Plan ==")[0]
    assert "Python" not in plan and "Arrow" not in plan
    assert "partial_collect_list" in plan


def test_long_conversation_is_linear(spark):
    rows = spark.range(40_000).select(
        F.lit(1).alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") % 3 == 0, "user").otherwise("assistant").alias("role"), F.lit("some <| words").alias("text"),
    )
    r = chat.format_chats(rows).select(
        F.size(chat.read_turns(F.col("formatted"))).alias("n"), F.length(chat.read_loss(F.col("segments"))).alias("loss")
    ).first()
    assert (r.n, r.loss) == (40_000, 13 * 26_666)


def test_empty_and_wrong_templates(spark):
    assert chat.format_chats(spark.createDataFrame([], SCHEMA)).count() == 0
    with pytest.raises(ValueError):
        chat.Template(between="###")
    with pytest.raises(ValueError):
        chat.Template(between="<|im_end|>")
