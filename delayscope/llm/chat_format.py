"""Chat formatting with typed content parts.

A conversation is a list of turns, a turn a role and a list of parts (text, image, audio,
document). A visitor walks the parts in order and writes one flat text: text parts escaped,
every other part as a numbered placeholder, whose attachment reference and expanded token
count it records. The formatted text reads back to the same turns, and the spans that
carry loss (what the assistant says) are marked in it.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed values of the template.
CLOSE, HEAD = "</s>", "<|turn|>"
ESCAPE = "\\"

PARTS = "array<struct<type:string,text:string,ref:string,tokens:int>>"
#: Tokens a placeholder expands to when a part does not say.
DEFAULT_TOKENS = {"image": 256, "audio": 128, "document": 512}

_TO_ESCAPE = re.compile(r"[\\<\[]")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
#: A turn as it stands in the output: head with role, then the body up to the closing mark.
_TURN = re.compile(r"<\|turn\|>((?:[^\\\n]|\\.)*+)\n((?:[^\\<]++|\\.|<(?!/s>))*+)</s>", re.DOTALL)
_PLACEHOLDER = re.compile(r"<\|(image|audio|document):(\d+)\|>")


def escape(text: str) -> str:
    """A backslash before whatever could start a control string, and before a backslash.

    No look-ahead: parts are joined later, and two harmless ends must not make a mark.
    """
    return _TO_ESCAPE.sub(lambda m: ESCAPE + m.group(), text)


def escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\n")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def unescape_role(text: str) -> str:
    return _ESCAPED.sub(lambda m: "\n" if m.group(1) == "n" else m.group(1), text)


@dataclass
class Flattener:
    """Visits the parts of a conversation in order."""

    pieces: list[str] = field(default_factory=list)
    length: int = 0
    refs: list[dict] = field(default_factory=list)
    spans: list[tuple[int, int]] = field(default_factory=list)

    def write(self, piece: str) -> None:
        self.pieces.append(piece)
        self.length += len(piece)

    def visit(self, part: dict) -> None:
        kind = part.get("type") or "text"
        getattr(self, f"visit_{kind}", self.visit_unknown)(part)

    def visit_text(self, part: dict) -> None:
        self.write(escape(part.get("text") or ""))

    def visit_image(self, part: dict) -> None:
        self._attach("image", part)

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part)

    def visit_document(self, part: dict) -> None:
        self._attach("document", part)

    def visit_unknown(self, part: dict) -> None:
        raise ValueError(f"unknown content part {part.get('type')!r}")

    def _attach(self, kind: str, part: dict) -> None:
        tokens = part.get("tokens")
        self.refs.append({
            "position": len(self.refs), "type": kind, "ref": part.get("ref"),
            "tokens": DEFAULT_TOKENS[kind] if tokens is None else tokens, "at": self.length,
        })
        self.write(f"<|{kind}:{len(self.refs) - 1}|>")

    def turn(self, role: str | None, parts: Iterable[dict] | None) -> None:
        self.write(f"{HEAD}{escape_role(role or '')}\n")
        start = self.length
        for part in parts or []:
            self.visit(part)
        if role == "assistant":
            self.spans.append((start, self.length))
        self.write(CLOSE)


def format_conversation(turns: Iterable[tuple[str | None, list[dict] | None]]) -> tuple[str, list[dict], list[tuple[int, int]]]:
    """Formatted text, attachment records and loss spans (code points, end exclusive)."""
    flat = Flattener()
    for role, parts in turns:
        flat.turn(role, parts)
    return "".join(flat.pieces), flat.refs, flat.spans


def parse_conversation(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn; placeholders stay in the text as they are."""
    turns, at = [], 0
    for match in _TURN.finditer(formatted):
        if match.start() != at:
            raise ValueError(f"not a turn at {at}")
        turns.append((unescape_role(match.group(1)), unescape(match.group(2))))
        at = match.end()
    if at != len(formatted):
        raise ValueError(f"not a turn at {at}")
    return turns


def attachments_of(formatted: str) -> list[tuple[str, int]]:
    """(type, position) of each placeholder, in order."""
    return [(m.group(1), int(m.group(2))) for m in _PLACEHOLDER.finditer(formatted) if not _escaped(formatted, m.start())]


def _escaped(text: str, at: int) -> bool:
    slashes = 0
    while at - slashes > 0 and text[at - slashes - 1] == ESCAPE:
        slashes += 1
    return slashes % 2 == 1


FORMATTED = (
    "conv_id bigint, n_turns bigint, formatted string, expanded_tokens bigint, "
    "attachments array<struct<position:int,type:string,ref:string,tokens:int,at:int>>, "
    "loss_spans array<struct<start:int,end:int>>"
)


def format_chats(turns: DataFrame) -> DataFrame:
    """One row per conversation, from rows (conv_id, turn, role, parts or text).

    Turns are ordered by ``turn``; equal or null turn numbers are ordered by role and text,
    so repeated rows have a defined result and each is kept. Null text is empty, a null
    role the empty role, null parts no parts. A null conv_id is a conversation of its own.
    A conversation is one record of the output, so its turns meet in one task: its size is
    bounded by what one training example can hold. Other columns are not read.
    """
    if "parts" in turns.columns:
        parts = F.col("parts").cast(PARTS)
    else:
        parts = F.array(F.struct(
            F.lit("text").alias("type"), F.col("text").cast("string").alias("text"),
            F.lit(None).cast("string").alias("ref"), F.lit(None).cast("int").alias("tokens"),
        )).cast(PARTS)
    gathered = (
        turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.struct(
            F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), parts.alias("parts"),
        ).alias("row"))
        .groupBy("conv_id").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    )

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema([
            ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("formatted", pa.string()), ("expanded_tokens", pa.int64()),
            ("attachments", pa.list_(pa.struct([("position", pa.int32()), ("type", pa.string()), ("ref", pa.string()), ("tokens", pa.int32()), ("at", pa.int32())]))),
            ("loss_spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
        ])
        for batch in batches:
            out = []
            for conv, rows in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                text, refs, spans = format_conversation((r["role"], r["parts"]) for r in rows)
                out.append({
                    "conv_id": conv, "n_turns": len(rows), "formatted": text, "expanded_tokens": sum(r["tokens"] for r in refs),
                    "attachments": refs, "loss_spans": [{"start": a, "end": b} for a, b in spans],
                })
            yield pa.RecordBatch.from_pylist(out, schema=kinds)

    return gathered.mapInArrow(render, FORMATTED)


DIGESTS = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what the formatted texts and their loss spans say, parsed from them."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema([
            ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
            ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
        ])
        for batch in batches:
            out = []
            for conv, text, spans in zip(*(batch.column(i).to_pylist() for i in range(3))):
                turns = parse_conversation(text)
                said = "".join(unescape(text[s["start"]:s["end"]]) for s in spans)
                whole = "".join(f"{role}\n{body}\n" for role, body in turns)
                out.append({
                    "conv_id": conv, "n_turns": len(turns), "turns_sha256": hashlib.sha256(whole.encode()).hexdigest(),
                    "loss_chars": len(said), "loss_sha256": hashlib.sha256(said.encode()).hexdigest(), "formatted_chars": len(text),
                })
            yield pa.RecordBatch.from_pylist(out, schema=kinds)

    return formatted.select("conv_id", "formatted", "loss_spans").mapInArrow(digest, DIGESTS)
