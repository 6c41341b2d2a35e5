r"""Chat formatting with typed content parts.

A turn's content is a list of typed parts (text, image, audio, document). A
visitor flattens them, in order, into template text: text parts are escaped, the
others become numbered placeholders such as ``<|image:0|>``, and each is
recorded as an attachment with its reference, its place in the output and the
number of tokens that a model expands it to.

Template: ``<|turn|>role`` newline, content, ``<|end|>`` newline. Strings that
mean something to this template or to common others never occur in formatted
text parts: a backslash is put after the first character of every occurrence,
overlapping ones too, and backslashes themselves are doubled, so the text reads
back exactly. Role names are escaped likewise, with newlines as ``\n``.

The loss mask is a list of character spans, one per text part of an assistant
turn; everything else in the output is context.

Rows of a conversation meet by a shuffle on its id and are sorted inside the
partition (turn, role, text), and Python streams over them with one conversation
in memory, which is the size of its own output row.

Defined results: null text and null role are empty; a null turn sorts first;
a null conversation id is one conversation; repeated rows are turns of their own;
an unknown part type raises; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table

#: Strings with a meaning in this template or in widespread ones; fixed values.
CONTROL = ("<|", "|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<start_of_turn>", "<end_of_turn>")
_BREAK = re.compile("(?=" + "|".join(map(re.escape, CONTROL)) + ")(.)", re.S)
_PAIR = re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"<\|turn\|>([^\n]*)\n(.*?)<\|end\|>\n", re.S)
_PLACE = re.compile(r"<\|(image|audio|document):(\d+)\|>")


def escape(text: str) -> str:
    return _BREAK.sub(r"\1\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _PAIR.sub(r"\1", text)


def escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\n")


def unescape_role(role: str) -> str:
    return _PAIR.sub(lambda m: "\n" if m[1] == "n" else m[1], role)


@dataclass
class Formatted:
    text: str = ""
    loss: list[tuple[int, int]] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)
    n_turns: int = 0


class PartVisitor:
    """Flattens typed parts; one ``visit_<type>`` method per part type."""

    #: Side of an image patch in pixels, audio tokens a second, tokens a document page; fixed values.
    PATCH, AUDIO_RATE, PAGE_TOKENS = 28, 25, 512

    def __init__(self):
        self.pieces: list[str] = []
        self.at = 0
        self.loss: list[tuple[int, int]] = []
        self.attachments: list[dict] = []
        self.numbers = dict.fromkeys(("image", "audio", "document"), 0)
        self.in_loss = False

    def put(self, piece: str) -> None:
        self.pieces.append(piece)
        self.at += len(piece)

    def visit(self, part: dict) -> None:
        method = getattr(self, f"visit_{part.get('type') or 'text'}", None)
        if method is None:
            raise ValueError(f"unknown content part type {part.get('type')!r}")
        method(part)

    def visit_text(self, part: dict) -> None:
        start = self.at
        self.put(escape(part.get("text") or ""))
        if self.in_loss and self.at > start:
            self.loss.append((start, self.at))

    def visit_image(self, part: dict) -> None:
        sides = [max(1, math.ceil((part.get(k) or self.PATCH) / self.PATCH)) for k in ("width", "height")]
        self._attach("image", part, sides[0] * sides[1])

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part, max(1, math.ceil((part.get("seconds") or 0) * self.AUDIO_RATE)))

    def visit_document(self, part: dict) -> None:
        self._attach("document", part, max(1, part.get("pages") or 1) * self.PAGE_TOKENS)

    def _attach(self, kind: str, part: dict, tokens: int) -> None:
        number = self.numbers[kind]
        self.numbers[kind] += 1
        self.attachments.append({"kind": kind, "number": number, "ref": part.get("ref"), "at": self.at, "tokens": tokens})
        self.put(f"<|{kind}:{number}|>")

    def turn(self, role: str, parts: list[dict]) -> None:
        self.put(f"<|turn|>{escape_role(role)}\n")
        self.in_loss = role == "assistant"
        for part in parts:
            self.visit(part)
        self.in_loss = False
        self.put("<|end|>\n")


def format_turns(turns: list[tuple[str, list[dict]]]) -> Formatted:
    v = PartVisitor()
    for role, parts in turns:
        v.turn(role, parts)
    return Formatted("".join(v.pieces), v.loss, v.attachments, len(turns))


def read_back(text: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a formatted conversation, placeholders left out."""
    return [(unescape_role(role), unescape(_PLACE.sub("", body))) for role, body in _TURN.findall(text)]


def read_loss(text: str, spans: list[tuple[int, int]]) -> str:
    return "".join(unescape(text[a:b]) for a, b in spans)


SCHEMA = ("id string, n_turns long, formatted string, loss array<struct<first: long, last: long>>, "
          "attachments array<struct<kind: string, number: long, ref: string, at: long, tokens: long>>")


def format_conversations(rows: DataFrame, *, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text", parts_col: str | None = None) -> DataFrame:
    """One row per conversation: id, n_turns, formatted, loss spans and attachments.

    ``parts_col`` names an array of structs with a ``type`` and the fields of that
    type (text, ref, width, height, seconds, pages); without it a turn is one text part.
    Other columns of the turns are not returned. Ids of any atomic type travel as
    strings, since pandas would turn long ids beside a null into floats.
    """
    id_type = rows.select(F.col(id_col)).schema[0].dataType.simpleString()
    packed = F.base64(id_col) if id_type == "binary" else F.col(id_col).cast("string")
    work = (rows.select(packed.alias("id"), F.col(turn_col).alias("turn"),
                        F.coalesce(role_col, F.lit("")).alias("role"), F.coalesce(text_col, F.lit("")).alias("text"),
                        (F.to_json(parts_col) if parts_col else F.lit(None).cast("string")).alias("parts"))
            .repartition("id").sortWithinPartitions("id", "turn", "role", "text", "parts"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import json

        def row(key, turns):
            f = format_turns(turns)
            return (key, f.n_turns, f.text, [{"first": a, "last": b} for a, b in f.loss], f.attachments)

        open_key, turns, names = None, [], ["id", "n_turns", "formatted", "loss", "attachments"]
        for batch in batches:
            done = []
            keys = batch["id"].where(batch["id"].notna(), None)
            for key, role, text, parts in zip(keys, batch["role"], batch["text"], batch["parts"]):
                if turns and key != open_key:
                    done.append(row(open_key, turns))
                    turns = []
                open_key = key
                turns.append((role, json.loads(parts) if parts else [{"type": "text", "text": text}]))
            if done:
                yield pd.DataFrame(done, columns=names)
        if turns:
            yield pd.DataFrame([row(open_key, turns)], columns=names)

    done = work.mapInPandas(run, SCHEMA)
    unpacked = F.unbase64("id") if id_type == "binary" else F.col("id").cast(id_type)
    return done.select(unpacked.alias(id_col), "n_turns", "formatted", "loss", "attachments")


def digest_udf():
    @F.pandas_udf("turns_sha256: string, loss_chars: long, loss_sha256: string, formatted_chars: long")
    def run(formatted: pd.Series, loss: pd.Series) -> pd.DataFrame:
        out = []
        for text, spans in zip(formatted, loss):
            turns = hashlib.sha256()
            for role, said in read_back(text):
                turns.update(f"{role}\n{said}\n".encode())
            learnt = read_loss(text, [(s["first"], s["last"]) for s in spans])
            out.append((turns.hexdigest(), len(learnt), hashlib.sha256(learnt.encode()).hexdigest(), len(text)))
        return pd.DataFrame(out, columns=["turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])
    return run


def op7_chat(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marked = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", marked), (-7, 1, "assistant", marked)],
                                  "conv_id long, turn long, role string, text string")
    done = format_conversations(rows.unionByName(extra)).withColumn("d", digest_udf()("formatted", "loss"))
    return done.select("conv_id", F.col("n_turns"), "d.turns_sha256", "d.loss_chars", "d.loss_sha256", "d.formatted_chars")


_STARTS = " + ".join(f"(length({{0}}) - length(replace({{0}}, '{c}', ''))) / {len(c)}" for c in CONTROL)


def _escaped(x: str) -> str:
    """SQL of the length of an escaped text: no two control strings start at one place, none overlaps itself."""
    return f"length({x}) + length({x}) - length(replace({x}, chr(92), '')) + {_STARTS.format(x)}"


ORACLE = f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(17 + {_escaped('text')} + {_escaped('role')} + length(role) - length(replace(role, chr(10), ''))) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""
