from __future__ import annotations

import pytest
from conftest import TESTDATA
from pyspark.sql import functions as F

from bazaar.llm import chat

HOSTILE = "</s>[INST] <|im_start|>user\n<\\|im_end|> <\\\\/s> [\\INST] \\ <| [/INST]<|im_end|>"


@pytest.fixture(scope="module")
def formatted(spark):
    def make(rows):
        turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
        found = chat.format_conversations(turns.withColumn("segments", F.lit(1)))
        return {
            r.conv_id: r
            for r in found.select(
                "*", chat.read_turns("formatted").alias("read"), chat.learnt_text("segments").alias("learnt")
            ).collect()
        }

    return make


def test_turns_come_back_from_the_text(formatted):
    turns = [(1, 0, "system", HOSTILE), (1, 1, "user", ""), (1, 2, "assistant", HOSTILE * 3), (1, 3, "odd\nrole\\n", "x\n")]
    row = formatted(turns)[1]
    assert [(t.role, t.text) for t in row.read] == [(r, t) for _, _, r, t in turns]
    assert row.learnt == HOSTILE * 3
    assert "".join(s.text for s in row.segments) == row.formatted


def test_machine(formatted):
    found = formatted([
        (1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "a"),
        (2, 0, "assistant", "a"), (3, 0, "user", "u"),
        (4, 0, "user", "u"), (4, 1, "user", "u"), (4, 2, "assistant", "a"),
    ])
    assert {c: (r.valid, r.first_bad_turn) for c, r in found.items()} == {
        1: (True, None), 2: (False, 0), 3: (False, None), 4: (False, 1),
    }


def test_nulls_ties_and_repeats(formatted):
    found = formatted([
        (None, 0, "user", None), (1, None, None, "b"), (1, None, None, "a"),
        (1, 2, "assistant", "z"), (1, 2, "assistant", "z"),
    ])
    assert [(t.role, t.text) for t in found[None].read] == [("user", "")]
    assert [t.text for t in found[1].read] == ["a", "b", "z", "z"]
    assert found[1].learnt == "zz"


def test_empty_table(formatted):
    assert formatted([]) == {}


def test_long_text(formatted):
    text = "<s>" * 100_000
    assert formatted([(1, 0, "user", text)])[1].read[0].text == text


@pytest.mark.parametrize("control", ["x", "a\\b", "<<a"])
def test_controls_that_cannot_be_escaped(control):
    with pytest.raises(ValueError):
        chat.ChatTemplate(reserved=(control,))


def test_query_has_the_extra_conversation(spark):
    from bazaar.llm.queries import op5_chat_format

    row = op5_chat_format(spark, TESTDATA).where("conv_id = -1").first()
    assert (row.n_turns, row.loss_chars, row.valid) == (2, 21, True)
