"""Chat formatting from an event log.

Events address messages of a conversation: ``delta`` appends streamed text, ``edit`` replaces a message's
text, ``regenerate`` discards it so that following deltas write it anew. The log is dealt out in ranges of
(conversation, message), sorted by sequence, and folded in one pass that holds one message at a time; a
conversation of any length is split between tasks at message borders. Each message is rendered on its own,
so a conversation's formatted text is the concatenation of its rendered messages.

Template, per message: TURN, role, newline, text, END, newline. Control strings inside roles and texts are
broken by a backslash after their first character and backslashes are doubled, which ``unescape`` undoes.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

TURN, END = "<|turn|>", "<|end|>"
#: Strings that mark turns in this or in other common templates.
CONTROL = (TURN, END, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>",
           "<|endoftext|>")
_ESCAPE = re.compile("\\\\|" + "|".join(map(re.escape, CONTROL)))
_ESCAPED = re.compile(r"\\(.)", re.S)
_PIECE = re.compile(re.escape(TURN) + r"((?:[^\\\n]|\\.)*)\n(.*)" + re.escape(END) + r"\n", re.S)

EVENTS = "conv_id long, turn long, copy int, seq long, kind string, role string, text string"
MESSAGES = "conv_id long, turn long, copy int, role string, text string"
RENDERED = "conv_id long, turn long, copy int, formatted string, loss_start int, loss_end int"
DIGEST = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
          "formatted_chars long")


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: "\\\\" if m[0] == "\\" else f"{m[0][0]}\\{m[0][1:]}", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(role: str, text: str) -> tuple[str, int, int]:
    """(formatted message, start and end of the span under the loss mask; empty unless the role is assistant)."""
    head = f"{TURN}{escape(role)}\n".replace("\n", "\\\n", role.count("\n"))
    body = escape(text)
    start = len(head)
    return f"{head}{body}{END}\n", start, start + len(body) * (role == "assistant")


def parse(formatted: str) -> tuple[str, str]:
    """(role, text) of a formatted message: the inverse of ``render``."""
    m = _PIECE.fullmatch(formatted)
    if not m:
        raise ValueError(f"not a formatted message: {formatted[:80]!r}")
    return unescape(m[1]), unescape(m[2])


def conversation_events(conversations: DataFrame) -> DataFrame:
    """An event log whose fold gives back ``conversations`` (conv_id, turn, role, text; null text: empty).

    Every message is streamed in two deltas. By a hash of its key, a third of the messages are first drafted
    and regenerated, and a third are first sent with another text and then edited. Rows that repeat a (conv_id,
    turn) stay messages of their own (``copy``, by role and text).
    """
    c = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                             F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                             F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    c = c.withColumn("copy", F.row_number().over(W.partitionBy("conv_id", "turn").orderBy("role", "text")))
    half = (F.length("text") / 2).cast("int")
    first, second = F.col("text").substr(F.lit(1), half), F.col("text").substr(half + 1, F.length("text"))

    def event(kind: str, text):
        return F.struct(F.lit(kind).alias("kind"), text.alias("text"))

    streamed = [event("delta", first), event("delta", second)]
    draft = event("delta", F.concat(F.lit("draft: "), first))
    log = (F.when(F.pmod(F.hash("conv_id", "turn"), F.lit(3)) == 0,
                  F.array(draft, event("regenerate", F.lit("")), *streamed))
           .when(F.pmod(F.hash("conv_id", "turn"), F.lit(3)) == 1, F.array(draft, event("edit", F.col("text"))))
           .otherwise(F.array(*streamed)))
    return (c.select("conv_id", "turn", "copy", "role", F.posexplode(log).alias("seq", "e"))
            .select("conv_id", "turn", "copy", F.col("seq").cast("long").alias("seq"), "e.kind", "role", "e.text"))


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 2000) -> Iterator[pa.RecordBatch]:
    out: list[tuple] = []
    for r in rows:
        out.append(r)
        if len(out) >= size:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), schema)], schema=schema)
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), schema)], schema=schema)


_MSG = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("copy", pa.int32()), ("role", pa.string()),
                  ("text", pa.string())])
_REN = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("copy", pa.int32()), ("formatted", pa.string()),
                  ("loss_start", pa.int32()), ("loss_end", pa.int32())])
_DIG = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                  ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns))


def reconstruct(events: DataFrame) -> DataFrame:
    """Final messages of an event log with the columns of EVENTS (others are ignored).

    Within a message, events apply by ``seq``; ties in seq by kind and text. The role is that of the first event
    that has one. A message's texts may be null (empty). Unknown kinds raise an error. A message that is all
    regenerated and never rewritten is an empty text. An empty log gives no rows.
    """
    key = ["conv_id", "turn", "copy"]
    log = (events.select(*(F.col(n).cast(t).alias(n) for n, t in (x.split() for x in EVENTS.split(", "))))
           .repartitionByRange(*key).sortWithinPartitions(*key, "seq", "kind", "text"))

    def fold(batches):
        def messages():
            now, role, parts = None, None, []
            for conv, turn, copy, _, kind, who, text in _rows(batches):
                if now != (conv, turn, copy):
                    if now is not None:
                        yield (*now, role or "", "".join(parts))
                    now, role, parts = (conv, turn, copy), None, []
                role = role if role is not None else who
                if kind == "delta":
                    parts.append(text or "")
                elif kind == "edit":
                    parts = [text or ""]
                elif kind == "regenerate":
                    parts = []
                else:
                    raise ValueError(f"unknown event kind: {kind!r}")
            if now is not None:
                yield (*now, role or "", "".join(parts))
        yield from _batches(messages(), _MSG)

    return log.mapInArrow(fold, MESSAGES)


def format_messages(messages: DataFrame) -> DataFrame:
    """Each message's formatted text and the span in it that the loss mask covers (narrow, one row each)."""
    def work(batches):
        def rendered():
            for conv, turn, copy, role, text in _rows(batches):
                yield (conv, turn, copy, *render(role or "", text or ""))
        yield from _batches(rendered(), _REN)

    return messages.select(*(F.col(n).cast(t).alias(n) for n, t in (x.split() for x in MESSAGES.split(", ")))).mapInArrow(work, RENDERED)


def read_back(rendered: DataFrame) -> DataFrame:
    """Per conversation, digests of what the formatted text says (parsed, not taken from the input).

    Messages stream by in order; a conversation's state is two running hashes and three counts, so its length
    does not matter for memory. Turns order by turn, then copy; null turns come first; null conv_id is a
    conversation of its own.
    """
    ordered = (rendered.select(*(x.split()[0] for x in RENDERED.split(", ")))
               .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "copy"))

    def work(batches):
        def digests():
            now, s = None, None
            for conv, _, _, piece, lo, hi in _rows(batches):
                if s is None or now != conv:
                    if s is not None:
                        yield (now, s[0], s[1].hexdigest(), s[2], s[3].hexdigest(), s[4])
                    now, s = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, text = parse(piece)
                loss = unescape(piece[lo:hi])
                s[0] += 1
                s[1].update(f"{role}\n{text}\n".encode())
                s[2] += len(loss)
                s[3].update(loss.encode())
                s[4] += len(piece)
            if s is not None:
                yield (now, s[0], s[1].hexdigest(), s[2], s[3].hexdigest(), s[4])
        yield from _batches(digests(), _DIG)

    return ordered.mapInArrow(work, DIGEST)


#: The conversation that the query adds: its texts are themselves control strings.
ADDED = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def formatted_digests(conversations: DataFrame) -> DataFrame:
    """All conversations and the added one: events, fold, render, read back."""
    c = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                             F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    added = conversations.sparkSession.createDataFrame(ADDED, "conv_id long, turn long, role string, text string")
    return read_back(format_messages(reconstruct(conversation_events(c.unionByName(added)))))
