"""Operator 6: chat formatting by event-sourced reconstruction.

A conversation is a log of events ``(conv_id, seq, kind, message, role,
text)``.  The log is partitioned by conversation, sorted by ``seq`` and
folded, one event at a time:

* ``start``: a message begins (role; its text, if any, is the first part);
* ``delta``: a streamed part is appended to the message;
* ``edit``: the message's text is replaced;
* ``regenerate``: the message is emptied and all messages after it go.

A ``delta``, ``edit`` or ``regenerate`` of an unknown message begins it.  The
folded conversation is rendered as ``<|im_start|>ROLE\\nTEXT<|im_end|>\\n`` per
message, with the spans of assistant texts as loss mask (code points, end
exclusive).  Control strings inside roles and texts are escaped reversibly:
a backslash is doubled and ``<|`` becomes ``<\\|``, so an unescaped ``<|`` is
always the template's own; a role's newline becomes ``\\n``.

Memory: a task reads its sorted events as a stream and holds one
conversation's messages, which are the output row itself.  Conversations are
dealt by id; one conversation is one output row and can't be split.

Nulls and empties: null texts and roles are empty; a null ``seq`` or turn
sorts first; rows with a null conv_id form one conversation with null id;
rows equal in (conv_id, seq) are ordered by their other columns and all
kept; an empty log gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
EVENT_COLUMNS = ("conv_id", "seq", "kind", "message", "role", "text")
FORMATTED = "conv_id long, formatted string, loss_spans array<struct<start:long,end:long>>"
DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.S)
FLUSH_CHARS = 4_000_000


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text, flags=re.S)


class Conversation:
    """The fold's state: messages in the order in which they began."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.messages: dict[str, tuple[str, list[str]]] = {}

    def apply(self, kind: str, message: str, role: str, text: str) -> None:
        if message not in self.messages:
            self.messages[message] = (role, [text])
        elif kind == "regenerate":
            order = list(self.messages)
            for later in order[order.index(message) + 1 :]:
                del self.messages[later]
            self.messages[message] = (role or self.messages[message][0], [text])
        elif kind == "edit":
            self.messages[message] = (role or self.messages[message][0], [text])
        else:
            self.messages[message][1].append(text)

    def render(self) -> tuple[str, list[dict]]:
        parts, spans, at = [], [], 0
        for role, texts in self.messages.values():
            head = f"{START}{escape(role).replace(chr(10), chr(92) + 'n')}\n"
            body = escape("".join(texts))
            if role == "assistant":
                spans.append({"start": at + len(head), "end": at + len(head) + len(body)})
            parts += [head, body, END, "\n"]
            at += len(head) + len(body) + len(END) + 1
        return "".join(parts), spans


def format_events(events: DataFrame) -> DataFrame:
    """``(conv_id, formatted, loss_spans)`` per conversation of an event log."""

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state, done, chars = None, [], 0

        def flushed():
            frame = pd.DataFrame(done, columns=["conv_id", "formatted", "loss_spans"])
            frame["conv_id"] = frame["conv_id"].astype("Int64")
            return frame

        for batch in batches:
            ids = batch["conv_id"].astype("Int64").to_list()
            columns = [batch[c].to_list() for c in ("kind", "message", "role", "text")]
            for conv, kind, message, role, text in zip(ids, *columns):
                conv = None if conv is pd.NA else conv
                if state is None or state.conv_id != conv:
                    if state is not None:
                        done.append((state.conv_id, *state.render()))
                        chars += len(done[-1][1])
                        if chars > FLUSH_CHARS:
                            yield flushed()
                            done, chars = [], 0
                    state = Conversation(conv)
                state.apply(kind, message, role, text)
        if state is not None:
            done.append((state.conv_id, *state.render()))
        if done:
            yield flushed()

    text = {c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("kind", "message", "role", "text")}
    log = events.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("seq").cast("long").alias("seq"), *text.values())
    return log.repartition("conv_id").sortWithinPartitions(*EVENT_COLUMNS).mapInPandas(fold, FORMATTED)


def turns_as_events(turns: DataFrame) -> DataFrame:
    """A table of finished turns as the event log of how they may have come about.

    Every message starts and streams its text in parts.  By a hash of the
    turn, a third of them first stream a draft, after which another message
    starts; then they are regenerated, which takes both away.  Another third
    stream a draft that an edit empties.  What is left of the log is the
    turns themselves.

    Turns with the same number are messages of their own (in order of role,
    then of a hash of the text).  A null turn has no order for parts: its
    messages start and stream their text at once.
    """
    turn = F.coalesce(F.col("turn").cast("string"), F.lit(""))
    # Equal rows stay apart by their place among the equals.
    same = turns.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("n"))
    each = same.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"), F.xxhash64("text").alias("h"),
                       F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("copy"))
    message = F.concat_ws("\x1f", turn, F.coalesce("role", F.lit("")), F.col("h").cast("string"), F.col("copy").cast("string"))
    # Messages of one turn share it: a regeneration takes away those behind it, which all begin again in order.
    how = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(3))
    named = each.select("conv_id", "turn", "role", "text", message.alias("message"), how.alias("how"))

    def step(at: int, kind: str, text: Column, message: Column = F.col("message"), role: Column = F.col("role")) -> Column:
        return F.struct(F.lit(at).alias("at"), F.lit(kind).alias("kind"), message.alias("message"), role.alias("role"), text.alias("text"))

    third = F.greatest(F.lit(1), F.ceil(F.char_length("text") / 3).cast("int"))
    parts = [F.substring("text", k * third + 1, third) for k in range(3)]
    empty, draft, edited = F.lit(""), F.col("how") == 1, F.col("how") == 2
    numbered = F.array(
        step(0, "start", empty),
        F.when(draft | edited, step(1, "delta", F.reverse("text"))),
        F.when(draft, step(2, "start", F.lit("a reply to the draft"), F.concat("message", F.lit("\x1freply")), F.lit("user"))),
        F.when(draft, step(3, "regenerate", empty)).when(edited, step(3, "edit", empty)),
        # What a regeneration took away of the messages of the same turn begins again here.
        *[step(4 + k, "delta", parts[k]) for k in range(3)],
    )
    at_once = F.array(step(0, "start", empty), step(1, "delta", F.col("text")))
    steps = F.when(F.col("turn").isNull(), at_once).otherwise(F.filter(numbered, lambda e: e.isNotNull()))
    return named.select("conv_id", "turn", F.explode(steps).alias("e")).select(
        "conv_id", (8 * F.col("turn") + F.col("e.at")).alias("seq"), "e.kind", "e.message", "e.role", "e.text"
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """The digest columns, parsed from the rendered texts and their loss spans alone."""

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for conv, out, spans in zip(batch["conv_id"].astype("Int64").to_list(), batch["formatted"], batch["loss_spans"]):
                turns = TURN.findall(out)
                of_turns = hashlib.sha256()
                for role, text in turns:
                    of_turns.update(f"{unescape(role)}\n{unescape(text)}\n".encode("utf-8", "surrogatepass"))
                of_loss, chars = hashlib.sha256(), 0
                for span in spans:
                    text = unescape(out[span["start"] : span["end"]])
                    chars += len(text)
                    of_loss.update(text.encode("utf-8", "surrogatepass"))
                rows.append((None if conv is pd.NA else conv, len(turns), of_turns.hexdigest(), chars, of_loss.hexdigest(), len(out)))
            frame = pd.DataFrame(rows, columns=[c.split()[0] for c in DIGEST.split(", ")])
            frame["conv_id"] = frame["conv_id"].astype("Int64")
            yield frame

    return formatted.select("conv_id", "formatted", "loss_spans").mapInPandas(digest, DIGEST)
