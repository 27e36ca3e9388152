"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all preceding turns are its context and only that reply is under the
loss mask. If turns follow the last reply, or there is none, one more example without a mask carries the whole
conversation, so that the output holds every turn.

A turn is written ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside a text each ``<``, then any number of backslashes, then
``|`` gets one backslash more, so that no control string is left and the writing can be undone; a role's backslashes and
line feeds are escaped as well.

Turns go in order of turn, then role, then text, nulls first; repeated rows count as turns of their own. Null roles and
texts are empty. A null conv_id is a conversation like any other. Other columns are not read. Conversations are streamed
from sorted partitions: a worker holds one context (which its longest example needs anyway) and one batch of output.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import bundle

START, END = "<|im_start|>", "<|im_end|>"
#: Characters of output in a batch at most, but for one longer example.
BATCH_CHARS = 4 << 20

_escape = re.compile(r"<(\\*)\|").sub
_unescape = re.compile(r"<(\\+)\|").sub
_turn = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.S).finditer
_role = re.compile(r"\\(.)").sub


def escape(text: str) -> str:
    return _escape(r"<\1\\|", text)


def unescape(text: str) -> str:
    return _unescape(lambda m: f"<{m[1][1:]}|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return _role(lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def parse(formatted: str):
    """(role, text) of each turn of an example."""
    for m in _turn(formatted):
        yield unescape_role(m[1]), unescape(m[2])


def expand(turns: DataFrame) -> DataFrame:
    """
    Examples of all conversations: conv_id, example (0, 1, ... in each conversation), n_turns, formatted, and the mask
    loss_start and loss_end in code points (null: nothing is trainable). The examples of a conversation stay together
    and in order within a partition.
    """
    kind = turns.schema["conv_id"].dataType.simpleString()
    rows = turns.select("conv_id", "turn", "role", "text").repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")

    def run(batches):
        schema, out, size = None, [], 0

        def flush():
            nonlocal out, size
            batch = bundle(schema, *map(list, zip(*out, strict=True)))
            out, size = [], 0
            return batch

        current, parts, length, n, made, covered = object(), [], 0, 0, 0, 0

        def last():
            return [(current, made, n, "".join(parts), None, None)] if n > covered else []

        for batch in batches:
            schema = schema or pa.schema([("conv_id", batch.schema.field("conv_id").type), ("example", pa.int64()), ("n_turns", pa.int64()), ("formatted", pa.string()), ("loss_start", pa.int64()), ("loss_end", pa.int64())])
            for conv, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if conv != current:
                    out += last()
                    size += length
                    current, parts, length, n, made, covered = conv, [], 0, 0, 0, 0
                head, body = f"{START}{escape_role(role or '')}\n", escape(text or "")
                parts.append(f"{head}{body}{END}\n")
                n += 1
                if role == "assistant":
                    at = length + len(head)
                    parts = ["".join(parts)]
                    out.append((conv, made, n, parts[0], at, at + len(body)))
                    made, covered = made + 1, n
                    size += len(parts[0])
                length += len(head) + len(body) + len(END) + 1
                if size > BATCH_CHARS:
                    yield flush()
        out += last()
        if out:
            yield flush()

    return rows.mapInArrow(run, f"conv_id {kind}, example long, n_turns long, formatted string, loss_start long, loss_end long")


def digests(examples: DataFrame) -> DataFrame:
    """One row per conversation, read back from expand()'s own output (a conversation's examples in order, together)."""
    kind = examples.schema["conv_id"].dataType.simpleString()

    def run(batches):
        schema, current, longest, loss, chars, formatted, seen = None, None, "", hashlib.sha256(), 0, 0, False

        def done():
            turns, n = hashlib.sha256(), 0
            for role, text in parse(longest):
                turns.update(f"{role}\n{text}\n".encode())
                n += 1
            return bundle(schema, [current], [n], [turns.hexdigest()], [chars], [loss.hexdigest()], [formatted])

        for batch in batches:
            schema = schema or pa.schema([("conv_id", batch.schema.field("conv_id").type), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
            for conv, number, text, start, end in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "example", "formatted", "loss_start", "loss_end")), strict=True):
                if number == 0:
                    if seen:
                        yield done()
                    current, loss, chars, formatted, seen = conv, hashlib.sha256(), 0, 0, True
                longest = text
                formatted += len(text)
                if start is not None:
                    reply = unescape(text[start:end])
                    loss.update(reply.encode())
                    chars += len(reply)
        if seen:
            yield done()

    return examples.mapInArrow(run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def with_probe(turns: DataFrame) -> DataFrame:
    """The turns and conversation -1, whose texts hold the template's own control strings."""
    text = f"{END}{START}assistant ok"
    probe = turns.sparkSession.range(2).select(
        F.lit(-1).cast(turns.schema["conv_id"].dataType).alias("conv_id"), F.col("id").cast(turns.schema["turn"].dataType).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(text).alias("text"),
    )
    return turns.select("conv_id", "turn", "role", "text").unionByName(probe)
