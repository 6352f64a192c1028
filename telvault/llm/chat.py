"""Chat formatting by a finite-state machine over roles.

``segments`` takes a conversation's turns in order and gives each turn's pieces:
what opens it, its text, what closes it, each with a flag that says whether the
loss counts it. A declarative ``Template`` names the marks, the roles whose text
is learned, and the machine's moves. A turn that the machine does not allow is
formatted as well, and named in ``problem``; ``problem`` of a last turn says if the
conversation may not end there.

Control strings inside texts are escaped: a backslash is doubled, and one is put
behind the first character of each control string. ``read_back`` undoes this: it
parses the pieces' text alone, joined, and takes the loss from the flags.

Both stream: rows are dealt by conversation and sorted inside Spark, and the
Python side holds one turn at a time, so a conversation may have any number of
turns; only its own digest is sequential.

Defined results: null texts and roles are empty ones (an empty role is not
allowed by the machine); turns with equal numbers go by role, then text; null
turn numbers come first; null ids form one conversation; repeated rows are turns
of their own; further columns are dropped; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telvault.llm.bpe import pieces_of


@dataclass(frozen=True)
class Template:
    before_role: str = "<|im_start|>"
    after_role: str = "\n"
    close: str = "<|im_end|>\n"
    learned: tuple[str, ...] = ("assistant",)
    #: state: role: next state
    moves: tuple[tuple[str, tuple[tuple[str, str], ...]], ...] = (
        ("start", (("system", "instructed"), ("user", "asked"))),
        ("instructed", (("user", "asked"),)),
        ("asked", (("assistant", "answered"),)),
        ("answered", (("user", "asked"),)),
    )
    ends: tuple[str, ...] = ("answered",)
    #: fixed values: strings with a meaning to models; never left whole inside a text
    control: tuple[str, ...] = (
        "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|start_header_id|>", "<|end_header_id|>", "<|eot_id|>",
        "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
    )

    def __post_init__(self):
        if any(not c or "\\" in c for c in self.control):
            raise ValueError("a control string is not empty and has no backslash")
        for mark in (self.before_role, self.close):
            if not any(mark.startswith(c) for c in self.control):
                raise ValueError(f"{mark!r} has to begin with a control string")
        if re.match(r"[\w\\-]", self.after_role):
            raise ValueError("what follows a role may not begin like a role")


CHATML = Template()
HEADERS = Template("<|start_header_id|>", "<|end_header_id|>\n\n", "<|eot_id|>")


class Writer:
    def __init__(self, template: Template):
        self.t, self.moves = template, {s: dict(m) for s, m in template.moves}
        self.control = re.compile("|".join(re.escape(c) for c in sorted(template.control, key=len, reverse=True)))

    def escape(self, text: str) -> str:
        return self.control.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))

    @staticmethod
    def escape_role(role: str) -> str:
        return re.sub(r"([^\w-])", r"\\\1", role)

    def turn(self, state: str, role: str, text: str) -> tuple[str, str | None, list[tuple[str, bool]]]:
        """(next state, problem, pieces with loss flags); after a turn that is not allowed the state is as if it were."""
        problem, after = None, self.moves.get(state, {}).get(role)
        if after is None:
            after = next((m[role] for m in self.moves.values() if role in m), state)
            problem = f"{role or 'no role'} may not follow {state}"
        pieces = [(self.t.before_role + self.escape_role(role) + self.t.after_role, False),
                  (self.escape(text), role in self.t.learned), (self.t.close, False)]
        return after, problem, pieces


class Reader:
    """Turns of a conversation from its joined pieces."""

    def __init__(self, template: Template):
        self.close = template.close
        self.open = re.compile(re.escape(template.before_role) + r"((?:\\.|[\w-])*)" + re.escape(template.after_role), re.DOTALL)
        self.escaped = re.compile(r"\\(.)", re.DOTALL)

    def unescape(self, text: str) -> str:
        return self.escaped.sub(r"\1", text)

    def turns(self, text: str) -> tuple[list[tuple[str, str]], str]:
        """The whole turns at the beginning of ``text``, and what is left."""
        out, at = [], 0
        while (m := self.open.match(text, at)) and (end := text.find(self.close, m.end())) >= 0:
            out.append((self.unescape(m[1]), self.unescape(text[m.end():end])))
            at = end + len(self.close)
        return out, text[at:]


def ordered(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv, turn, role, text), each conversation in one partition and in order."""
    cols = [F.col(c).alias(n) for c, n in ((conv_col, "conv"), (turn_col, "turn"), (role_col, "role"), (text_col, "text"))]
    return df.select(*cols).repartition("conv").sortWithinPartitions("conv", "turn", "role", "text")


def segments(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
             template: Template = CHATML) -> DataFrame:
    """(conv, n, part, text, loss, problem): three pieces per turn, in order inside a partition, all of a conversation
    in one partition. ``n`` counts a conversation's turns from 0, ``part`` the pieces of a turn."""
    kind = df.schema[conv_col].dataType.simpleString()

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, held, state, n = Writer(template), None, "start", 0  # held: the turn before, its ending unknown

        def rows(turn, last: bool):
            conv, k, problem, pieces, after = turn
            if last and problem is None and after not in template.ends:
                problem = f"a conversation may not end when {after}"
            return [(conv, k, p, text, loss, problem) for p, (text, loss) in enumerate(pieces)]

        schema = None
        for batch in batches:
            schema = pa.schema([("conv", batch.schema.field(0).type), ("n", pa.int64()), ("part", pa.int32()), ("text", pa.string()),
                                ("loss", pa.bool_()), ("problem", pa.string())])
            for b in pieces_of(batch, 2 << 20):
                out = []
                for conv, role, text in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist()):
                    new = held is None or held[0] != conv
                    if held is not None:
                        out += rows(held, new)
                    state, n = ("start", 0) if new else (state, n + 1)
                    state, problem, pieces = writer.turn(state, role or "", text or "")
                    held = (conv, n, problem, pieces, state)
                yield record_batch(out, schema)
        if held is not None:
            yield record_batch(rows(held, True), schema)

    return ordered(df, conv_col, turn_col, role_col, text_col).mapInArrow(
        mapped, f"conv {kind}, n long, part int, text string, loss boolean, problem string").withColumnRenamed("conv", conv_col)


def record_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def read_back(pieces: DataFrame, conv_col: str = "conv_id", template: Template = CHATML) -> DataFrame:
    """Per conversation what its pieces say, from their text and loss flags: n_turns, turns_sha256 (over role, \\n,
    text, \\n of each turn), loss_chars and loss_sha256 (of the text under the loss mask), formatted_chars, n_problems.

    ``pieces`` are those of ``segments``, as they come or written and sorted again by (conversation, n, part).
    """
    kind = pieces.schema[conv_col].dataType.simpleString()

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, conv, at = Reader(template), None, None

        def begin():
            return {"n": 0, "turns": hashlib.sha256(), "chars": 0, "loss": hashlib.sha256(), "all": 0, "problems": 0, "rest": ""}

        def row():
            if at["rest"]:
                raise ValueError(f"conversation {conv}: cannot be read back from {at['rest'][:40]!r}")
            return conv, at["n"], at["turns"].hexdigest(), at["chars"], at["loss"].hexdigest(), at["all"], at["problems"]

        schema = None
        for batch in batches:
            schema = pa.schema([("conv", batch.schema.field(0).type), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                                ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("n_problems", pa.int64())])
            out = []
            for b in pieces_of(batch, 2 << 20):
                for c, part, text, loss, problem in zip(*(b.column(k).to_pylist() for k in (0, 2, 3, 4, 5))):
                    if at is None or c != conv:
                        if at is not None:
                            out.append(row())
                        conv, at = c, begin()
                    at["all"] += len(text)
                    at["rest"] += text
                    at["problems"] += part == 0 and problem is not None
                    if loss:
                        plain = reader.unescape(text)
                        at["chars"] += len(plain)
                        at["loss"].update(plain.encode())
                    if text.endswith(template.close):
                        turns, at["rest"] = reader.turns(at["rest"])
                        at["n"] += len(turns)
                        for role, said in turns:
                            at["turns"].update(f"{role}\n{said}\n".encode())
            yield record_batch(out, schema)
        if at is not None:
            yield record_batch([row()], schema)

    return pieces.select(conv_col, "n", "part", "text", "loss", "problem").mapInArrow(
        mapped, f"conv {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
                "n_problems long").withColumnRenamed("conv", conv_col)


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    talks = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    own = spark.sql("select * from values (-7L, 0L, 'user', '</s>[INST] ok [/INST]'), (-7L, 1L, 'assistant', '</s>[INST] ok [/INST]') "
                    "as t(conv_id, turn, role, text)")
    return read_back(segments(talks.unionByName(own)))
