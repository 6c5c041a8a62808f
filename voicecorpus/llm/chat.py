"""Chat formatting over typed content parts.

A turn's content is a list of parts (text, image, audio, document).  A visitor flattens
them into one text with ordered placeholders, and records for each attachment its
reference, its place and how many tokens it expands to.  The template then marks turns:

    <s>                                           a conversation begins
    [INST] {text} [/INST]                         user
    {text}</s>                                    assistant; {text} alone is under the loss mask
    <|role|>{role}<|text|>{text}<|end|>           any other role

Control strings inside roles and texts are broken by a backslash after their first
character, and backslashes are doubled; so none occurs but those of the template, and
``unescape`` gives the text back exactly.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BEGIN, USER, USER_END, ANSWER_END = "<s>", "[INST] ", " [/INST]", "</s>"
ROLE, ROLE_TEXT, OTHER_END = "<|role|>", "<|text|>", "<|end|>"
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
OTHER = "<|part|>"  # of a part of any other type
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", ROLE, ROLE_TEXT, OTHER_END, *PLACEHOLDERS.values(), OTHER)
_CONTROL = re.compile("|".join(re.escape(c) for c in CONTROLS) + r"|\\")
_ESCAPED = re.compile(r"\\(\\?)")


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: "\\\\" if m[0] == "\\" else m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


@dataclass
class Flat:
    """A visitor over typed parts.  ``text`` is escaped; placeholders in it are not."""

    patch: int = 14
    audio_rate: float = 25.0
    page_tokens: int = 512
    text: list[str] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)
    size: int = 0

    def visit(self, part: dict | None) -> None:
        part = part or {}
        kind = part.get("type") or "text"
        getattr(self, f"visit_{kind}", self.visit_unknown)(part)

    def visit_text(self, part: dict) -> None:
        self._add(escape(part.get("text") or ""))

    def visit_image(self, part: dict) -> None:
        self._attach("image", part, math.ceil((part.get("width") or 0) / self.patch) * math.ceil((part.get("height") or 0) / self.patch))

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part, math.ceil((part.get("seconds") or 0) * self.audio_rate))

    def visit_document(self, part: dict) -> None:
        self._attach("document", part, (part.get("pages") or 0) * self.page_tokens)

    def visit_unknown(self, part: dict) -> None:
        """Any other type: recorded under its own name, with a placeholder that expands to nothing."""
        self._attach(str(part.get("type")), part, 0)

    def _attach(self, kind: str, part: dict, tokens: int) -> None:
        self.attachments.append({"kind": kind, "ref": part.get("ref"), "place": self.size, "tokens": int(tokens)})
        self._add(PLACEHOLDERS.get(kind, OTHER))

    def _add(self, s: str) -> None:
        self.text.append(s)
        self.size += len(s)


def flatten(content: str | list | None, **sizes) -> Flat:
    """A plain text (null: empty) or a list of parts."""
    flat = Flat(**sizes)
    for part in [{"type": "text", "text": content}] if not isinstance(content, list) else content:
        flat.visit(part)
    return flat


@dataclass
class Turn:
    """A formatted turn: ``loss`` is the span of ``text`` under the loss mask, if any."""

    text: str
    loss: tuple[int, int] | None
    attachments: list[dict]


def format_turn(role: str | None, content: str | list | None, first: bool, **sizes) -> Turn:
    """One turn in the template; a null role counts as empty."""
    flat = flatten(content, **sizes)
    body = "".join(flat.text)
    head = BEGIN if first else ""
    head, tail = {"user": (head + USER, USER_END), "assistant": (head, ANSWER_END)}.get(role, (f"{head}{ROLE}{escape(role or '')}{ROLE_TEXT}", OTHER_END))
    for a in flat.attachments:
        a["place"] += len(head)
    return Turn(head + body + tail, (len(head), len(head) + len(body)) if role == "assistant" else None, flat.attachments)


def read_turn(text: str, at: int) -> tuple[str, str, int]:
    """(role, escaped body, end) of the formatted turn that begins at ``at``."""
    if text.startswith(BEGIN, at):
        at += len(BEGIN)
    if text.startswith(USER, at):
        end = text.index(USER_END, at + len(USER))
        return "user", text[at + len(USER) : end], end + len(USER_END)
    if text.startswith(ROLE, at):
        mid, end = text.index(ROLE_TEXT, at), text.index(OTHER_END, at)
        return unescape(text[at + len(ROLE) : mid]), text[mid + len(ROLE_TEXT) : end], end + len(OTHER_END)
    end = text.index(ANSWER_END, at)
    return "assistant", text[at:end], end + len(ANSWER_END)


SEGMENT_CHARS = 1 << 20
FORMATTED = (
    "conv_id long, segment int, formatted string, loss array<struct<start:int,end:int>>, "
    "attachments array<struct<turn:long,kind:string,ref:string,place:int,tokens:long>>, expanded_tokens long"
)


def _segments(batches: Iterator[pa.RecordBatch], sizes: dict, limit: int) -> Iterator[dict]:
    """Formatted segments of the conversations in a stream sorted by conversation and turn."""
    now: dict | None = None
    for b in batches:
        for conv, turn, role, text, parts in zip(*(c.to_pylist() for c in b.columns), strict=True):
            first = now is None or now["conv_id"] != conv
            if now and (first or now["size"] >= limit):
                yield now
                now = {"conv_id": conv, "segment": 0 if first else now["segment"] + 1, "text": [], "size": 0, "loss": [], "attachments": []}
            elif first:
                now = {"conv_id": conv, "segment": 0, "text": [], "size": 0, "loss": [], "attachments": []}
            t = format_turn(role, json.loads(parts) if parts is not None else text, first, **sizes)
            if t.loss:
                now["loss"].append({"start": now["size"] + t.loss[0], "end": now["size"] + t.loss[1]})
            now["attachments"] += [a | {"turn": turn, "place": a["place"] + now["size"]} for a in t.attachments]
            now["text"].append(t.text)
            now["size"] += len(t.text)
    if now:
        yield now


def _sorted(turns: DataFrame) -> DataFrame:
    parts = F.to_json("parts") if "parts" in turns.columns else F.lit(None).cast("string")
    text = F.col("text").cast("string") if "text" in turns.columns else F.lit(None).cast("string")
    d = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), text.alias("text"), parts.alias("parts"))
    return d.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text", "parts")


def format_conversations(turns: DataFrame, segment_chars: int = SEGMENT_CHARS, **sizes) -> DataFrame:
    """One row for each segment of each conversation (schema ``FORMATTED``).

    ``turns``: conv_id, turn, role and text, or parts (an array of structs with type and,
    as they apply, text, ref, width, height, seconds, pages), which goes before text where
    it is not null.  Turns are ordered by (turn, role, text, parts), nulls first; repeated
    rows are turns of their own; a null conv_id is a conversation; other columns are not
    read.  A conversation past ``segment_chars`` continues in a further segment after a
    whole turn, so a worker holds one segment however long a conversation is.  A part of an
    unknown type has a placeholder of its own and is recorded as an attachment of no tokens.
    ``expanded_tokens`` counts what the attachments expand to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("conv_id", pa.int64()), ("segment", pa.int32()), ("formatted", pa.string()), ("loss", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), ("attachments", pa.list_(pa.struct([("turn", pa.int64()), ("kind", pa.string()), ("ref", pa.string()), ("place", pa.int32()), ("tokens", pa.int64())]))), ("expanded_tokens", pa.int64())])
        for s in _segments(batches, sizes, segment_chars):
            row = {"conv_id": s["conv_id"], "segment": s["segment"], "formatted": "".join(s["text"]), "loss": s["loss"], "attachments": s["attachments"], "expanded_tokens": sum(a["tokens"] for a in s["attachments"])}
            yield pa.RecordBatch.from_pylist([row], schema)

    return _sorted(turns).mapInArrow(run, FORMATTED)


DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def digests(turns: DataFrame, segment_chars: int = SEGMENT_CHARS) -> DataFrame:
    """Format each conversation, read the formatted text back, and digest what is read.

    One row for each conversation (schema ``DIGEST``); nulls and ties as in
    ``format_conversations``.  A conversation's turns pass through one task, as a hash of
    them in order must, but in segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[list] = []
        turns = loss = None
        for s in _segments(batches, {}, segment_chars):
            if s["segment"] == 0:
                if len(out) >= 1000:
                    yield _batch(out)
                    out = []
                turns, loss = hashlib.sha256(), hashlib.sha256()
                out.append([s["conv_id"], 0, turns, 0, loss, 0])
            row, text, at = out[-1], "".join(s["text"]), 0
            while at < len(text):
                role, body, at = read_turn(text, at)
                turns.update(f"{role}\n{unescape(body)}\n".encode())
                row[1] += 1
            for span in s["loss"]:
                said = unescape(text[span["start"] : span["end"]])
                loss.update(said.encode())
                row[3] += len(said)
            row[5] += len(text)
        if out:
            yield _batch(out)

    return _sorted(turns).mapInArrow(run, DIGEST)


def _batch(rows: list[list]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    cols = zip(*[[x.hexdigest() if hasattr(x, "hexdigest") else x for x in r] for r in rows], strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=[c.split()[0] for c in DIGEST.split(", ")])


def op9_chat(spark, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    said = F.lit("</s>[INST] ok [/INST]")
    probe = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said.alias("text"))
    return digests(turns.unionByName(probe))


def oracle_sql() -> str:
    """The same for DuckDB: hashes of the turns themselves, and lengths as the template has them."""
    marks = "|".join("".join(f"\\{x}" if x in "[]|/\\" else x for x in c) for c in (*CONTROLS, "\\"))
    escaped = lambda c: f"(len({c}) + len(regexp_extract_all({c}, '{marks}')))"
    user, other = len(USER + USER_END), len(ROLE + ROLE_TEXT + OTHER_END)
    return f"""WITH t AS (SELECT conv_id::BIGINT AS conv_id, turn::BIGINT AS turn, coalesce(role, '') AS r, coalesce(text, '') AS t, role, text FROM conversations
  UNION ALL SELECT -7, turn, role, said, role, said FROM (VALUES (0, 'user'), (1, 'assistant')) AS x(turn, role), (SELECT '</s>[INST] ok [/INST]' AS said))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(r || chr(10) || t || chr(10), '' ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST)) AS turns_sha256,
  coalesce(sum(len(t)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars, sha256(coalesce(string_agg(t, '' ORDER BY turn NULLS FIRST, text NULLS FIRST) FILTER (role = 'assistant'), '')) AS loss_sha256,
  ({len(BEGIN)} + sum({escaped('t')} + CASE role WHEN 'user' THEN {user} WHEN 'assistant' THEN {len(ANSWER_END)} ELSE {other} + {escaped('r')} END))::BIGINT AS formatted_chars
FROM t GROUP BY conv_id"""


ORACLE_SQL = oracle_sql()
