import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from telvault.llm import chat

PIECES = ["<|im_start|>", "<|im_end|>", "\n", "\\", "</s>", "[INST]", "[/INST]", "<", "|", ">", "user", "a", "é", "<|im_end|", "<\\|im_end|>", "<<SYS>>", "<|eot_id|>", ""]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "", "a\nb", "<|im_end|>", "x\\"]), st.lists(st.sampled_from(PIECES), max_size=8).map("".join)), max_size=5),
       st.sampled_from([chat.CHATML, chat.HEADERS]))
def test_texts_come_back(turns, template):
    writer, reader = chat.Writer(template), chat.Reader(template)
    pieces = [p for role, text in turns for p in writer.turn("start", role, text)[2]]
    assert reader.turns("".join(t for t, _ in pieces)) == (turns, "")
    assert [reader.unescape(t) for t, loss in pieces if loss] == [text for role, text in turns if role == "assistant"]
    for (_, text), body in zip(turns, pieces[1::3]):
        assert not any(c in body[0] for c in template.control)


def test_machine_names_wrong_turns(spark):
    talks = {1: "su a", 2: "sua", 3: "ua", 4: "au", 5: "usa", 6: "uaua", 7: "", 8: "uua"}
    names = {"s": "system", "u": "user", "a": "assistant", " ": "tool"}
    rows = [(c, k, names[x], "t") for c, said in talks.items() for k, x in enumerate(said)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string")
    wrong = {r["conv_id"]: r["n_problems"] for r in chat.read_back(chat.segments(df)).collect()}
    assert {c for c, n in wrong.items() if n == 0} == {2, 3, 6} and set(wrong) == {1, 2, 3, 4, 5, 6, 8}
    problems = {(r["conv_id"], r["n"]): r["problem"] for r in chat.segments(df).where("part = 0").collect()}
    assert problems[4, 0] == "assistant may not follow start" and problems[4, 1] == "a conversation may not end when asked"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("template", [chat.CHATML, chat.HEADERS])
def test_messy_rows(spark, template):
    rng = random.Random(4)
    rows = [(c % 7 if c % 9 else None, rng.choice([None, 0, 1, 2, 3]), rng.choice(["user", "assistant", None, "odd role\n"]),
             rng.choice([None, "", "x" * 200_000, "".join(rng.choice(PIECES) for _ in range(30))])) for c in range(120)]
    rows += rows[:10]
    df = spark.createDataFrame([(*r, 1, "x", None) for r in rows], "conv_id bigint, turn int, role string, text string, n int, part string, loss string").repartition(4)
    got = {r["conv_id"]: tuple(r)[1:5] for r in chat.read_back(chat.segments(df, template=template), template=template).collect()}
    want = {}
    none = lambda x: (x is not None, x if x is not None else 0)
    for c in {r[0] for r in rows}:
        turns = sorted((r[1:] for r in rows if r[0] == c), key=lambda r: (none(r[0]), (r[1] is not None, (r[1] or "").encode()), (r[2] is not None, (r[2] or "").encode())))
        said = "".join(t or "" for _, role, t in turns if role == "assistant")
        want[c] = (len(turns), digest("".join(f"{role or ''}\n{t or ''}\n" for _, role, t in turns)), len(said), digest(said))
    assert got == want
    assert chat.read_back(chat.segments(df.where("false"))).count() == 0


def test_written_pieces_can_be_sorted_and_read_back(spark):
    df = spark.createDataFrame([(c, k, ("user", "assistant")[k % 2], f"</s> {c} {k}") for c in range(20) for k in range(6)], "conv_id bigint, turn int, role string, text string")
    pieces = chat.segments(df)
    again = pieces.repartition(5).repartition("conv_id").sortWithinPartitions("conv_id", "n", "part")
    assert sorted(chat.read_back(again).collect()) == sorted(chat.read_back(pieces).collect())


def test_templates_are_checked():
    with pytest.raises(ValueError):
        chat.Template(before_role="role: ")
    with pytest.raises(ValueError):
        chat.Template(control=("a\\b",))
