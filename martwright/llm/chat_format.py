"""Conversations as one text each, by a compiled template, with the spans that a loss may be taken on."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import rows_in, rows_out
from .template import Template, many_lines, unescape_marks

START, END = "<|im_start|>", "<|im_end|>"

#: Marks each turn. Control strings inside roles and texts are escaped, so marks are the only ``<|`` in the output.
CHAT_TEMPLATE = (
    "{% for message in messages %}"
    "{{ '<|im_start|>' ~ (message.role | line | escape) ~ '\\n' }}"
    "{% if message.role == 'assistant' %}{% generation %}{{ message.text | escape }}{% endgeneration %}"
    "{% else %}{{ message.text | escape }}{% endif %}"
    "{{ '<|im_end|>' ~ '\\n' }}"
    "{% endfor %}"
)

#: A formatted conversation longer than this is returned in several pieces, cut between turns.
PIECE_CHARS = 1 << 20

_SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32())])
_PIECES = "conv_id long, piece long, text string, loss array<struct<start:int,end:int>>"
_DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


def format_conversations(
    conversations: DataFrame,
    template: str = CHAT_TEMPLATE,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    piece_chars: int = PIECE_CHARS,
) -> DataFrame:
    """(conv_id, piece, text, loss): the formatted text in order, with the loss spans of each piece in code points.

    * Turns are ordered by (turn, role, text), nulls first; repeated turns are all rendered. A null role or text is empty.
    * Rows with a null conversation id form one conversation with a null id.
    * Other columns are ignored, whatever their names. An empty table gives an empty result.

    One shuffle deals the turns by conversation and sorts them; a task then streams through its conversations, and
    holds a piece and one turn at a time however long a conversation is. A text never crosses pieces.
    """
    rows = conversations.select(
        F.col(conv_id).cast("long").alias("conv_id"),
        F.col(turn).alias("turn"),
        F.col(role).cast("string").alias("role"),
        F.col(text).cast("string").alias("text"),
    )
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").drop("turn")
    compiled = Template(template)

    def pieces(turns: Iterator[tuple]) -> Iterator[tuple]:
        for key, group in groupby(turns, key=lambda r: r[0]):
            messages = ({"role": r or "", "text": t or ""} for _, r, t in group)
            piece, parts, loss, size = 0, [], [], 0
            for made, learned in compiled.render(messages):
                if learned:
                    loss.append({"start": size, "end": size + len(made)})
                parts.append(made)
                size += len(made)
                if size >= piece_chars:
                    yield key, piece, "".join(parts), loss
                    piece, parts, loss, size = piece + 1, [], [], 0
            yield key, piece, "".join(parts), loss

    kinds = [pa.int64(), pa.int64(), pa.string(), pa.list_(_SPAN)]
    names = ["conv_id", "piece", "text", "loss"]
    return dealt.mapInArrow(lambda batches: rows_out(pieces(rows_in(batches)), names, kinds), _PIECES)


def parse_turns(texts: Iterator[str]) -> Iterator[tuple[str, str]]:
    """(role, text) read back from the pieces of one conversation formatted by :data:`CHAT_TEMPLATE`."""
    held = ""
    for more in texts:
        held += more
        at = 0
        while (end := held.find(END + "\n", at)) >= 0:
            role, _, text = held[at + len(START) : end].partition("\n")
            yield many_lines(unescape_marks(role)), unescape_marks(text)
            at = end + len(END) + 1
        held = held[at:]
    if held:
        raise ValueError(f"{len(held)} characters after the last turn")


def read_back(pieces: DataFrame) -> DataFrame:
    """Per conversation what its formatted text says: turns, loss text and length, as counts and SHA-256 digests.

    ``pieces`` must come straight from :func:`format_conversations`, whose partitions hold whole conversations in order.
    """

    def digests(rows: Iterator[tuple]) -> Iterator[tuple]:
        for key, group in groupby(rows, key=lambda r: r[0]):
            turns, learned = hashlib.sha256(), hashlib.sha256()
            n_turns = loss_chars = chars = 0

            def texts(group=group, learned=learned):
                nonlocal loss_chars, chars
                for _, _, text, loss in group:
                    chars += len(text)
                    for span in loss:
                        part = unescape_marks(text[span["start"] : span["end"]])
                        loss_chars += len(part)
                        learned.update(part.encode())
                    yield text

            for role, text in parse_turns(texts()):
                n_turns += 1
                turns.update(f"{role}\n{text}\n".encode())
            yield key, n_turns, turns.hexdigest(), loss_chars, learned.hexdigest(), chars

    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    return pieces.mapInArrow(lambda batches: rows_out(digests(rows_in(batches)), names, kinds), _DIGESTS)
