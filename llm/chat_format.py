"""Chat formatting with typed content parts.

A turn's content is a list of typed parts. A visitor with one method per part
type flattens them, in order, into text and placeholders; each image, audio or
document part leaves a placeholder ``<|image:k|>`` (k counts the attachments of
the turn), an attachment record (kind, reference) and the number of tokens the
placeholder expands to.

Template, one turn: ``<|turn|>role<|body|>content<|end|>``. Inside roles and
texts ``&`` becomes ``&amp;`` and the first character of a control string
becomes ``&lt;`` or ``&#91;``, so no control string survives in a text and the
replacement can be undone without loss.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import table

TURN, BODY, END = "<|turn|>", "<|body|>", "<|end|>"
#: Strings that mark structure in this or in common chat templates. Fixed values.
CONTROL = re.compile(r"&|<(?=\||s>|/s>|<SYS>>|</SYS>>)|\[(?=INST\]|/INST\])")
ENTITY = re.compile(r"&(?:amp|lt|#91);")
ESCAPES = {"&": "&amp;", "<": "&lt;", "[": "&#91;"}
PLAIN = {v: k for k, v in ESCAPES.items()}

SEGMENT = ("conv_id long, turn long, role string, segment string, body_start int, body_end int, "
           "loss boolean, attachments array<struct<kind:string,ref:string,tokens:long>>, expanded_tokens long")


def escape(text: str) -> str:
    return CONTROL.sub(lambda m: ESCAPES[m[0]], text)


def unescape(text: str) -> str:
    return ENTITY.sub(lambda m: PLAIN[m[0]], text)


class Flattener:
    """Visitor over one turn's parts; ``visit`` dispatches on the part's type."""

    def __init__(self, patch: int = 28, audio_rate: int = 25, page_tokens: int = 512) -> None:
        self.patch, self.audio_rate, self.page_tokens = patch, audio_rate, page_tokens
        self.out: list[str] = []
        self.attachments: list[tuple[str, str, int]] = []

    def visit(self, part: dict) -> None:
        getattr(self, f"visit_{part.get('type')}", self.visit_unknown)(part)

    def visit_text(self, part: dict) -> None:
        self.out.append(escape(part.get("text") or ""))

    def visit_image(self, part: dict) -> None:
        side = lambda k: max(1, math.ceil((part.get(k) or self.patch) / self.patch))
        self._attach("image", part, side("width") * side("height"))

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part, max(1, math.ceil((part.get("seconds") or 0) * self.audio_rate)))

    def visit_document(self, part: dict) -> None:
        self._attach("document", part, max(1, int(part.get("pages") or 1)) * self.page_tokens)

    def visit_unknown(self, part: dict) -> None:
        """A type without a method is kept as its JSON text: nothing is lost."""
        self.out.append(escape(json.dumps(part, ensure_ascii=False, sort_keys=True)))

    def _attach(self, kind: str, part: dict, tokens: int) -> None:
        self.out.append(f"<|{kind}:{len(self.attachments)}|>")
        self.attachments.append((kind, part.get("ref"), tokens))


def _parts(text: str | None, typed: bool) -> list[dict]:
    """A plain text is one text part. With ``typed``, a JSON list of objects
    is a list of parts; every other text stays one text part."""
    if typed and text and text.lstrip().startswith("["):
        try:
            found = json.loads(text)
        except ValueError:
            found = None
        if isinstance(found, list) and all(isinstance(x, dict) for x in found):
            return found
    return [{"type": "text", "text": text or ""}]


def format_turns(turns: DataFrame, typed: bool = True) -> DataFrame:
    """One formatted segment per turn; a conversation is the concatenation of
    its segments by turn (then role and text, so ties have one order).

    Needs conv_id, turn, role, text; other columns are ignored. Null text is
    the empty text, a null role the empty role, null ids and turns stay and
    sort first. Repeated rows are repeated turns. ``loss`` marks assistant
    bodies; body_start and body_end are code points of the segment.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("segment", pa.string()),
                            ("body_start", pa.int32()), ("body_end", pa.int32()), ("loss", pa.bool_()),
                            ("attachments", pa.list_(pa.struct([("kind", pa.string()), ("ref", pa.string()), ("tokens", pa.int64())]))),
                            ("expanded_tokens", pa.int64())])
        for b in batches:
            rows = []
            for conv, turn, role, text in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                v = Flattener()
                for part in _parts(text, typed):
                    v.visit(part)
                head, body = f"{TURN}{escape(role or '')}{BODY}", "".join(v.out)
                rows.append((conv, turn, role or "", head + body + END, len(head), len(head) + len(body), role == "assistant",
                             [dict(zip(("kind", "ref", "tokens"), a, strict=True)) for a in v.attachments], sum(a[2] for a in v.attachments)))
            cols = list(zip(*rows, strict=True)) or [[]] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(cols, schema, strict=True)], schema=schema)
    return (turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
            .mapInArrow(run, SEGMENT))


def read_turn(segment: str) -> tuple[str, str]:
    """Role and body of a formatted turn, unescaped."""
    role, _, body = segment[len(TURN):-len(END)].partition(BODY)
    return unescape(role), unescape(body)


def read_back(segments: DataFrame) -> DataFrame:
    """Digests of each conversation, parsed from its formatted segments.

    The segments of a conversation are hashed one after the other as they
    stream by in order; no conversation is held whole, however long.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        key, state = object(), None
        for pdf in batches:
            done = []
            for conv, segment, start, end, loss in pdf.itertuples(index=False):
                conv = None if pd.isna(conv) else int(conv)
                if state is None or conv != key:
                    if state:
                        done.append(close(key, state))
                    key, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, body = read_turn(segment)
                state[0] += 1
                state[1].update(f"{role}\n{body}\n".encode())
                if loss:
                    kept = unescape(segment[start:end])
                    state[2] += len(kept)
                    state[3].update(kept.encode())
                state[4] += len(segment)
            yield typed(pd.DataFrame(done, columns=names))
        if state:
            yield typed(pd.DataFrame([close(key, state)], columns=names))

    def close(key, s):
        return key, s[0], s[1].hexdigest(), s[2], s[3].hexdigest(), s[4]

    def typed(pdf):
        return pdf.astype({"conv_id": "Int64"})

    order = ["conv_id", "turn", "role", "segment"]
    return (segments.select(*order, "body_start", "body_end", "loss")
            .repartition("conv_id").sortWithinPartitions(*order)
            .select("conv_id", "segment", "body_start", "body_end", "loss")
            .mapInPandas(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"))


#: A conversation whose texts consist of control strings. Fixed values.
PROBE = "</s>[INST] ok [/INST]"


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    probe = (spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                   F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                   F.lit(PROBE).alias("text")).coalesce(1))
    return read_back(format_turns(turns.unionByName(probe), typed=False))


ORACLE_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, regexp_replace(regexp_replace(replace(text, '&', '&amp;'),
      '<(\||s>|/s>|<SYS>>|</SYS>>)', '&lt;\1', 'g'), '\[(INST\]|/INST\])', '&#91;\1', 'g') AS body FROM t)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
  CAST(sum(length(role) + length(body) + 23) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
