"""Chat formatting: a finite-state machine over roles, a declarative template, and segments with loss flags.

Rows are partitioned by conversation and sorted by turn; each task then walks its rows as a stream, one turn at a
time. Memory doesn't grow with the length of a conversation, and nothing is grouped into a list.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kilnwatt.llm.common import lean, table


@dataclass(frozen=True)
class Template:
    """Marks around the text of each role; `loss` roles are trained on. `control` strings never occur in formatted text
    except as marks: `escape` is put into each, behind its first character, and lengthened if it already stands there."""

    opening: dict[str, str] = field(default_factory=lambda: {"system": "<<SYS>>\n", "user": "[INST] ", "assistant": "<s>"})
    closing: dict[str, str] = field(default_factory=lambda: {"system": "\n<</SYS>>\n", "user": " [/INST]", "assistant": "</s>"})
    #: A role without marks of its own is named in the text.
    other: tuple[str, str, str] = ("[ROLE] ", " [/ROLE]", " [/TURN]")
    loss: frozenset[str] = frozenset({"assistant"})
    escape: str = "\u200b"

    @property
    def control(self) -> list[str]:
        marks = [*self.opening.values(), *self.closing.values(), *self.other]
        return sorted({m.strip() for m in marks}, key=lambda m: (-len(m), m))


#: state -> role -> next state. A conversation is valid if it never leaves the table and ends in an accepting state.
TURNS = {
    "start": {"system": "system", "user": "user"},
    "system": {"user": "user"},
    "user": {"assistant": "assistant"},
    "assistant": {"user": "user"},
}
ACCEPTING = frozenset({"user", "assistant"})

SEGMENTS = "conv_id long, turn_no long, part string, text string, loss boolean, state string"


class Codec:
    """Escaping for one template, and its inverse.

    `<s>` becomes `<ZWSPs>`. A text that holds the escaped form itself gets one more escape there, so that a run of n
    escapes behind the first character of a mark always stands for n - 1.
    """

    def __init__(self, template: Template):
        import re

        e = re.escape(template.escape)
        parts = "|".join(f"{re.escape(m[0])}{e}*{re.escape(m[1:])}" for m in template.control)
        self._any = re.compile(parts)
        self._escaped = re.compile("|".join(f"{re.escape(m[0])}{e}+{re.escape(m[1:])}" for m in template.control))
        self._e = template.escape

    def write(self, text: str) -> str:
        return self._any.sub(lambda m: m[0][0] + self._e + m[0][1:], text)

    def read(self, text: str) -> str:
        return self._escaped.sub(lambda m: m[0][0] + m[0][1 + len(self._e) :], text)


def format_segments(conversations: DataFrame, template: Template | None = None) -> DataFrame:
    """One row per segment: (conv_id, turn_no, part, text, loss, state), in the order of the formatted text.

    `part` is `open`, `text` or `close`; the formatted conversation is the concatenation of its segments. `state` is the
    machine's state after the turn, `invalid` from the first turn that breaks the order. Null text and null role count as
    empty; a null conv_id is a conversation of its own; turns tie by role, then text; repeated rows are turns. An empty
    table gives an empty result.
    """
    template = template or Template()
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    ordered = rows.repartition(F.col("conv_id")).sortWithinPartitions("conv_id", "turn", "role", "text")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(template)
        conv, state, number = object(), "start", 0
        for batch in batches:
            out: list[tuple] = []
            held = 0
            for row in batch.to_pylist():
                if row["conv_id"] != conv:
                    conv, state, number = row["conv_id"], "start", 0
                role, said = row["role"], codec.write(row["text"])
                state = TURNS.get(state, {}).get(role, "invalid")
                if role in template.opening:
                    before, after = template.opening[role], template.closing[role]
                else:
                    before, after = template.other[0] + codec.write(role) + template.other[1], template.other[2]
                loss = role in template.loss
                out += [(conv, number, "open", before, False, state), (conv, number, "text", said, loss, state), (conv, number, "close", after, False, state)]
                number += 1
                held += len(said)
                if held > 8_000_000:
                    yield _batch(out)
                    out, held = [], 0
            if out:
                yield _batch(out)

    return ordered.mapInArrow(lean(walk), SEGMENTS)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.string()]
    names = ["conv_id", "turn_no", "part", "text", "loss", "state"]
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


class Parser:
    """Turns of one formatted conversation, from its text alone: no flags, columns or lengths.

    The text may be fed in pieces cut anywhere. A turn begins with an opening mark and ends at its closing mark; neither
    occurs inside a text, which `Codec` sees to, nor across the end of a text, since no mark ends as it begins. At most
    the turn that is still open is held.
    """

    def __init__(self, template: Template):
        self._marks = sorted(((before, role) for role, before in template.opening.items()), key=lambda m: -len(m[0]))
        self._template, self._codec = template, Codec(template)
        self._left, self._role, self._close, self._seen = "", None, "", 0

    def feed(self, text: str) -> Iterator[tuple[str, str]]:
        """Role and text of each turn that ends within what has been fed so far."""
        self._left += text
        while self._left:
            if self._role is None and not self._open():
                return
            at = self._left.find(self._close, self._seen)
            if at < 0:
                self._seen = max(0, len(self._left) - len(self._close) + 1)
                return
            turn = self._role, self._codec.read(self._left[:at])
            self._left = self._left[at + len(self._close) :]
            self._role, self._seen = None, 0
            yield turn

    def _open(self) -> bool:
        """Whether an opening mark has come whole; it is taken off."""
        for before, role in self._marks:
            if self._left.startswith(before):
                self._left, self._role, self._close = self._left[len(before) :], role, self._template.closing[role]
                return True
        named, end, close = self._template.other
        if self._left.startswith(named):
            at = self._left.find(end, len(named))
            if at < 0:
                return False
            self._role, self._close = self._codec.read(self._left[len(named) : at]), close
            self._left = self._left[at + len(end) :]
            return True
        if any(m.startswith(self._left) for m in [named, *(before for before, _ in self._marks)]):
            return False
        raise ValueError(f"no opening mark: {self._left[:40]!r}")

    def end(self) -> None:
        if self._left or self._role is not None:
            raise ValueError(f"a turn without its closing mark: {self._left[:40]!r}")


class Trained:
    """Digest of the text under the loss mask: each run of masked text is unescaped by itself."""

    def __init__(self, codec: Codec):
        self._codec, self._run, self.chars, self.digest = codec, [], 0, hashlib.sha256()

    def feed(self, text: str, loss: bool) -> None:
        if loss:
            self._run.append(text)
        elif text:
            self.end()

    def end(self) -> None:
        said = self._codec.read("".join(self._run))
        self.digest.update(said.encode())
        self.chars += len(said)
        self._run = []


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean"


def read_back(segments: DataFrame, template: Template | None = None) -> DataFrame:
    """Parse the formatted text of every conversation by its marks and digest the turns, one row per conversation.

    Of `segments` only the text in its order and the loss mask over it are used: roles, ends of turns and the order of
    roles (`valid`) come from the text. A text that doesn't parse is an error. `segments` may come in any order: it is
    partitioned and sorted again, which costs nothing directly after `format_segments`.
    """
    template = template or Template()
    order = segments.withColumn("_part", F.expr("case part when 'open' then 0 when 'text' then 1 else 2 end"))
    ordered = order.repartition(F.col("conv_id")).sortWithinPartitions("conv_id", "turn_no", "_part").select("conv_id", "text", "loss")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(template)
        conv, seen = None, False
        parser = trained = turns = None
        n = chars = 0
        state = "start"

        def row() -> dict:
            parser.end()
            trained.end()
            return {
                "conv_id": conv, "n_turns": n, "turns_sha256": turns.hexdigest(), "loss_chars": trained.chars,
                "loss_sha256": trained.digest.hexdigest(), "formatted_chars": chars, "valid": state in ACCEPTING,
            }

        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if not seen or r["conv_id"] != conv:
                    if seen:
                        out.append(row())
                    conv, seen, state, n, chars = r["conv_id"], True, "start", 0, 0
                    parser, trained, turns = Parser(template), Trained(codec), hashlib.sha256()
                chars += len(r["text"])
                trained.feed(r["text"], r["loss"])
                for role, said in parser.feed(r["text"]):
                    turns.update(f"{role}\n{said}\n".encode())
                    state = TURNS.get(state, {}).get(role, "invalid")
                    n += 1
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=_DIGEST_SCHEMA)
        if seen:
            yield pa.RecordBatch.from_pylist([row()], schema=_DIGEST_SCHEMA)

    return ordered.mapInArrow(lean(digest), DIGESTS)


_DIGEST_SCHEMA = pa.schema(
    [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("valid", pa.bool_())]
)

#: Conversation -1 of the query: both turns say the template's own control strings.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Format all conversations and one of control strings, then read every turn back from the output."""
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL_TEXT).alias("text"),
    )
    return read_back(format_segments(given.unionByName(extra)))
