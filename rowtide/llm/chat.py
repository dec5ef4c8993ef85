"""Chat formatting of typed content parts.

A turn is a list of parts: text, image, audio or document. A visitor flattens the parts in order into one string; parts
other than text become placeholders, with a record of the attachment (its place, kind, reference) and the number of
tokens that the placeholder expands to. Turns are marked with control strings. Adjacent texts are one text; where it
holds a control string, the escape character is put behind its first character, so that no control string stays whole, and
the escape character itself is doubled. Reading back undoes both, so texts come back exactly, apart from placeholders.

Turns are formatted row by row. A conversation is read back as a stream of its turns in order; a task holds one batch
and the running digests, never a whole conversation.

Edge cases: null text is empty, null role is empty, a null turn comes first; equal turns of a conversation are ordered by
role and text; rows with a null conversation id are one conversation; unknown kinds of parts raise an error; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from math import ceil

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The template's own control strings, and those of common chat templates, which texts must not forge.
TURN, BODY, END = "<|turn|>", "<|body|>", "<|end|>"
IMAGE, AUDIO, DOCUMENT = "<|image|>", "<|audio|>", "<|document|>"
CONTROL = [TURN, BODY, END, IMAGE, AUDIO, DOCUMENT, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>"]
ESCAPE = "\\"
PATCH, IMAGE_TOKENS, AUDIO_TOKENS_PER_S, PAGE_TOKENS = 28, 256, 25, 512

_special = re.compile("|".join(map(re.escape, [ESCAPE, *CONTROL])))
_token = re.compile(r"\\.|" + "|".join(map(re.escape, [TURN, BODY, END, IMAGE, AUDIO, DOCUMENT])), re.DOTALL)
_kind_of = {IMAGE: "image", AUDIO: "audio", DOCUMENT: "document"}

PART = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
_SEGMENT = "segment string, start int, end int, n_tokens long, attachments array<struct<place:int,kind:string,ref:string,tokens:long>>"


def escape(text: str) -> str:
    return _special.sub(lambda m: m.group()[0] + ESCAPE + m.group()[1:], text)


class Flatten:
    """Visitor over the parts of one turn."""

    def __init__(self, count_text: Callable[[str], int] = lambda text: len(text.split())):
        self.out: list[str] = []
        self.text: list[str] = []  # of the text parts since the last placeholder
        self.attachments: list[tuple[int, str, str | None, int]] = []
        self.n_tokens = 0
        self.count_text = count_text

    def visit(self, part: dict) -> None:
        getattr(self, f"visit_{part['kind']}", self.unknown)(part)

    def unknown(self, part: dict) -> None:
        raise ValueError(f"unknown kind of part: {part['kind']}")

    def visit_text(self, part: dict) -> None:
        self.text.append(part.get("text") or "")

    def close_text(self) -> None:
        text = "".join(self.text)
        self.out.append(escape(text))
        self.n_tokens += self.count_text(text)
        self.text = []

    def visit_image(self, part: dict) -> None:
        sized = part.get("width") and part.get("height")
        self._attach(IMAGE, part, ceil(part["width"] / PATCH) * ceil(part["height"] / PATCH) if sized else IMAGE_TOKENS)

    def visit_audio(self, part: dict) -> None:
        self._attach(AUDIO, part, max(1, ceil((part.get("seconds") or 0) * AUDIO_TOKENS_PER_S)))

    def visit_document(self, part: dict) -> None:
        self._attach(DOCUMENT, part, max(1, part.get("pages") or 0) * PAGE_TOKENS)

    def _attach(self, mark: str, part: dict, tokens: int) -> None:
        self.close_text()
        self.attachments.append((len(self.attachments), part["kind"], part.get("ref"), tokens))
        self.out.append(mark)
        self.n_tokens += tokens


def format_turn(role: str, parts: list[dict]) -> tuple[str, int, int, int, list]:
    """The turn's string, the span of its content in it (code points), expanded tokens and attachments."""
    visitor = Flatten()
    for part in parts:
        visitor.visit(part)
    visitor.close_text()
    head, content = f"{TURN}{escape(role)}{BODY}", "".join(visitor.out)
    return head + content + END, len(head), len(head) + len(content), visitor.n_tokens, visitor.attachments


def read_turns(text: str) -> Iterator[tuple[str, list[tuple[str, str]], int, int]]:
    """Role, parts (kind and, of texts, the unescaped text) and the content's span for every turn of a formatted string."""
    role, parts, held, at, start = "", [], [], 0, 0
    for m in _token.finditer(text):
        held.append(text[at : m.start()])
        at = m.end()
        found = m.group()
        if found[0] == ESCAPE:
            held.append(found[1:])
        elif found == TURN:
            held = []
        elif found == BODY:
            role, parts, held, start = "".join(held), [], [], at
        else:
            parts.append(("text", "".join(held)))
            held = []
            if found == END:
                yield role, [p for p in parts if p != ("text", "")], start, m.start()
            else:
                parts.append((_kind_of[found], found))


def _format(role: pd.Series, parts: pd.Series) -> pd.DataFrame:
    rows = [format_turn(r or "", [dict(p) if isinstance(p, dict) else p.asDict() for p in (ps if ps is not None else [])]) for r, ps in zip(role, parts, strict=True)]
    return pd.DataFrame(rows, columns=["segment", "start", "end", "n_tokens", "attachments"])


def format_conversations(turns: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """``conv, turn, segment, loss_start, loss_end, n_tokens, attachments`` for every row of ``turns(conv_id, turn, role, parts)``.

    A conversation's formatted string is its segments in order. The loss mask covers ``loss_start`` to ``loss_end`` of a segment.
    """
    learned = F.coalesce(F.col("role") == loss_role, F.lit(False))
    rows = turns.select(F.col("conv_id").cast("string").alias("conv"), F.col("turn").cast("long").alias("turn"), learned.alias("learned"), F.pandas_udf(_format, _SEGMENT)(F.col("role"), F.col("parts")).alias("f"))
    span = {f"loss_{c}": F.when(F.col("learned"), F.col(f"f.{c}")).otherwise(F.lit(0)) for c in ("start", "end")}
    return rows.select("conv", "turn", "f.segment", *[v.alias(c) for c, v in span.items()], "f.n_tokens", "f.attachments")


def _read_map(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = ["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    state: list | None = None

    def row() -> tuple:
        return state[0], state[1], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5]

    for frame in frames:
        done = []
        for conv, segment, lo, hi in zip(frame["conv"], frame["segment"], frame["loss_start"], frame["loss_end"], strict=True):
            if state is None or state[0] != conv:
                if state is not None:
                    done.append(row())
                state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, parts, start, end in read_turns(segment):
                text = "".join(t for _, t in parts)
                state[1] += 1
                state[2].update(f"{role}\n{text}\n".encode())
                if (start, end) == (lo, hi):
                    state[3] += len(text)
                    state[4].update(text.encode())
            state[5] += len(segment)
        yield pd.DataFrame(done, columns=names)
    if state is not None:
        yield pd.DataFrame([row()], columns=names)


def read_back(segments: DataFrame) -> DataFrame:
    """Digests per conversation, from the formatted segments alone."""
    ordered = segments.select("conv", "turn", "segment", "loss_start", "loss_end").repartition("conv").sortWithinPartitions("conv", "turn", "segment")
    found = ordered.mapInPandas(_read_map, "conv string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    return found.withColumn("conv_id", F.col("conv").cast("long")).drop("conv")


def text_parts(turns: DataFrame) -> DataFrame:
    """``turns(conv_id, turn, role, text)`` with each text as one part."""
    part = F.struct(F.lit("text").alias("kind"), F.coalesce("text", F.lit("")).alias("text"), F.lit(None).alias("ref"), F.lit(None).alias("width"), F.lit(None).alias("height"), F.lit(None).alias("seconds"), F.lit(None).alias("pages"))
    return turns.select("conv_id", "turn", "role", F.array(part).cast(f"array<{PART}>").alias("parts"))


ORACLE_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, regexp_replace(text, '(\\|<\|turn\|>|<\|body\|>|<\|end\|>|<\|image\|>|<\|audio\|>|<\|document\|>|<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>|<\|im_start\|>|<\|im_end\|>|<\|endoftext\|>)', '\\\1', 'g') AS esc FROM c
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length(role) + length(esc) + 23)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""
