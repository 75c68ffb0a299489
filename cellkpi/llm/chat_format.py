"""Chat formatting of typed content parts.

A turn's content is a list of parts (text, image, audio, document). A visitor
flattens them in order: texts are escaped, attachments become numbered
placeholders, and for each attachment its reference, place and expanded token
count are recorded. A turn reads ``<|turn|>role<|says|>content<|end|>``. Control
strings inside roles and texts get a backslash after their first character and
backslashes are doubled, so the output can be read back exactly. The loss mask
lists the content of assistant turns, in code points of the formatted text.

Conversations are dealt by id and sorted by turn, then streamed: a task holds
the conversation at hand and no more. (One conversation is one output text, so
it is the smallest unit; conversations of any number share the tasks.)

Defined cases: a null id is a conversation of its own; null turns come first;
equal turns follow role, then text, then content; null role or text is empty;
a null or unknown part type is text; null parts are skipped; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellkpi.llm.common import arrow_batches, table

TURN, SAYS, END = "<|turn|>", "<|says|>", "<|end|>"
CONTROL = re.compile(r"\\|<\||</?s>|\[/?INST\]|<</?SYS>>")
_ESCAPED = re.compile(r"\\(\\?)")
_TURN = re.compile(re.escape(TURN) + "(.*?)" + re.escape(SAYS) + "(.*?)" + re.escape(END), re.S)
PLACEHOLDER = re.compile(r"<\|(image|audio|document)_(\d+)\|>")
TRAINED_ROLE = "assistant"
PART = ("struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>")
IMAGE_PATCH, AUDIO_TOKENS_A_SECOND, DOCUMENT_TOKENS_A_PAGE = 28, 25, 768
ATTACHMENTS = "array<struct<kind:string,ref:string,turn:int,start:int,end:int,tokens:int>>"


def escape(text: str) -> str:
    return CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


class Flattener:
    """Visitor of one conversation's parts; appends to the formatted text."""

    def __init__(self) -> None:
        self.out: list[str] = []
        self.at = 0
        self.loss: list[dict] = []
        self.attachments: list[dict] = []
        self.turns = 0

    def put(self, text: str) -> None:
        self.out.append(text)
        self.at += len(text)

    def turn(self, role: str | None, parts: list[dict]) -> None:
        self.put(TURN + escape(role or "") + SAYS)
        start = self.at
        for p in parts:
            if p is not None:
                getattr(self, f"visit_{p.get('type')}", self.visit_text)(p)
        if role == TRAINED_ROLE:
            self.loss.append({"start": start, "end": self.at})
        self.put(END)
        self.turns += 1

    def visit_text(self, p: dict) -> None:
        self.put(escape(p.get("text") or ""))

    def visit_image(self, p: dict) -> None:
        side = lambda n: max(1, math.ceil((n or 0) / IMAGE_PATCH))
        self._attach("image", p, side(p.get("width")) * side(p.get("height")))

    def visit_audio(self, p: dict) -> None:
        self._attach("audio", p, max(1, math.ceil((p.get("seconds") or 0) * AUDIO_TOKENS_A_SECOND)))

    def visit_document(self, p: dict) -> None:
        self._attach("document", p, max(1, p.get("pages") or 0) * DOCUMENT_TOKENS_A_PAGE)

    def _attach(self, kind: str, p: dict, tokens: int) -> None:
        start = self.at
        self.put(f"<|{kind}_{len(self.attachments) + 1}|>")
        self.attachments.append({"kind": kind, "ref": p.get("ref"), "turn": self.turns,
                                 "start": start, "end": self.at, "tokens": tokens})

    def row(self, conv_id) -> dict:
        return {"conv_id": conv_id, "formatted": "".join(self.out), "n_turns": self.turns, "loss_mask": self.loss,
                "attachments": self.attachments, "attachment_tokens": sum(a["tokens"] for a in self.attachments)}


_FORMATTED = ("conv_id long, formatted string, n_turns long, loss_mask array<struct<start:int,end:int>>, "
              f"attachments {ATTACHMENTS}, attachment_tokens long")
_SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32())])
_ATTACHED = pa.struct([("kind", pa.string()), ("ref", pa.string()), ("turn", pa.int32()), ("start", pa.int32()),
                       ("end", pa.int32()), ("tokens", pa.int32())])
_ARROW = pa.schema([("conv_id", pa.int64()), ("formatted", pa.string()), ("n_turns", pa.int64()),
                    ("loss_mask", pa.list_(_SPAN)), ("attachments", pa.list_(_ATTACHED)), ("attachment_tokens", pa.int64())])


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, open_, done = None, None, []
    for b in batches:
        rows = zip(*(b.column(c).to_pylist() for c in ("conv_id", "role", "text", "content")), strict=True)
        for conv, role, text, content in rows:
            if open_ is None or conv != now:
                if open_ is not None:
                    done.append(open_.row(now))
                now, open_ = conv, Flattener()
            open_.turn(role, [{"type": "text", "text": text}] if content is None else content)
        if done:
            yield pa.RecordBatch.from_pylist(done, _ARROW)
            done = []
    if open_ is not None:
        yield pa.RecordBatch.from_pylist([open_.row(now)], _ARROW)


def format_conversations(turns: DataFrame) -> DataFrame:
    """One row a conversation from rows (conv_id, turn, role, text[, content
    array of parts; it stands in for text where not null])."""
    arrow_batches(turns.sparkSession, 2048)
    content = F.col("content").cast(f"array<{PART}>") if "content" in turns.columns else F.lit(None).cast(f"array<{PART}>")
    rows = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text", content.alias("content"))
    return (rows.repartition("conv_id")
            .sortWithinPartitions("conv_id", "turn", "role", "text", F.to_json(F.struct("content")))
            .mapInArrow(_stream, _FORMATTED))


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, content) of each turn, unescaped."""
    return [(unescape(r), unescape(c)) for r, c in _TURN.findall(formatted)]


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for conv, text, mask in zip(*(b.column(c).to_pylist() for c in ("conv_id", "formatted", "loss_mask")), strict=True):
            turns = read_turns(text)
            loss = "".join(unescape(text[m["start"]:m["end"]]) for m in mask)
            out.append((conv, len(turns), hashlib.sha256("".join(f"{r}\n{c}\n" for r, c in turns).encode()).hexdigest(),
                        len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text)))
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=_DIGEST_NAMES) if out else \
            pa.RecordBatch.from_pylist([], pa.schema(list(zip(_DIGEST_NAMES, (pa.int64(), pa.int64(), pa.string()) * 2, strict=True))))


_DIGEST_NAMES = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]


def digests(formatted: DataFrame) -> DataFrame:
    return formatted.select("conv_id", "formatted", "loss_mask").mapInArrow(
        _read_back, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.sql("SELECT -1L AS conv_id, turn, role, '</s>[INST] ok [/INST]' AS text "
                      "FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)")
    return digests(format_conversations(turns.unionByName(probe)))


OP4_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, t.turn, t.role, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) t(turn, role))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(23 + length(regexp_replace(role || text, '(\\|<\||</?s>|\[/?INST\]|<</?SYS>>)', '\1_', 'g'))) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""
