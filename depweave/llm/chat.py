"""Chat formatting from an event log.

A log has rows (conv_id, seq, turn, kind, role, text). Kinds:

* `message` starts the turn anew with its text and role,
* `delta` adds its text to the end of the turn,
* `edit` replaces the text of the turn so far,
* `regenerate` empties the turn and takes back all later turns logged before it.

Events are partitioned by conversation and sorted by seq (then turn, kind, text), folded into one
message per turn and rendered. A rendered turn is

    <s>[INST] role [/INST]text</s>

and control strings inside role and text are broken by a backslash, backslashes being doubled, so
that reading back gives the original. Assistant texts are under the loss mask: `loss_start` and
`loss_chars` are the code points of a rendered turn that it covers.

Defined cases: null texts and roles are empty, a null conv_id is a conversation of its own, a null
seq or turn comes first; an event of unknown or null kind counts as `message`. A conversation without
events has no row. The turns of a conversation are never gathered: a very long one is streamed in
order, a row per turn.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Fixed values of the template.
OPEN, MIDDLE, CLOSE = "<s>[INST] ", " [/INST]", "</s>"
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]")
MASKED_ROLE = "assistant"

_READ = re.compile(
    f"{re.escape(OPEN)}(.*?){re.escape(MIDDLE)}(.*?){re.escape(CLOSE)}", re.DOTALL
)


def escaped(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for control in CONTROLS:
        out = F.replace(out, F.lit(control), F.lit(control[0] + "\\" + control[1:]))
    return out


def unescaped(text: str) -> str:
    """A doubled backslash stands for one, a single one for nothing."""
    return re.sub(r"\\(\\?)", r"\1", text) if "\\" in text else text


def fold(events: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text): the final message of each turn that is left."""
    log = events.select(
        "conv_id",
        "seq",
        "turn",
        F.when(F.col("kind").isin("delta", "edit", "regenerate"), F.col("kind"))
        .otherwise("message")
        .alias("kind"),
        "role",
        F.coalesce("text", F.lit("")).alias("text"),
    )
    # What is regenerated at the lowest turn from here to the end of the log decides what stays;
    # the frame grows row by row, so nothing but a minimum is held.
    order = ["seq", "turn", "kind", "text"]
    later = (
        W.partitionBy("conv_id")
        .orderBy(*[F.desc_nulls_last(c) for c in order])
        .rowsBetween(W.unboundedPreceding, -1)
    )
    again = F.when(F.col("kind") == "regenerate", F.coalesce("turn", F.lit(-(2**62))))
    turn = F.coalesce("turn", F.lit(-(2**62)))
    alive = log.withColumn("again", F.min(again).over(later)).where(
        F.col("again").isNull() | (turn <= F.col("again"))
    )
    # Within a turn the last event that starts it anew counts, and the deltas after it.
    turns = alive.groupBy("conv_id", "turn").agg(
        F.sort_array(F.collect_list(F.struct("seq", "kind", "text", "role"))).alias("log")
    )
    size = F.size("log")
    fresh = F.array_max(
        F.transform(
            F.sequence(F.lit(1), size),
            lambda i: F.when(F.element_at("log", i)["kind"] != "delta", i).otherwise(0),
        )
    )
    kept = F.slice("log", F.greatest(fresh, F.lit(1)), size)
    roles = F.filter(F.transform("log", lambda e: e["role"]), lambda r: r.isNotNull())
    return turns.select(
        "conv_id",
        "turn",
        F.coalesce(F.try_element_at(roles, F.lit(-1)), F.lit("")).alias("role"),
        F.array_join(F.transform(kept, lambda e: e["text"]), "").alias("text"),
    )


def render(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, formatted, loss_start, loss_chars): one row per turn; the conversation is the
    rows' `formatted` one after the other. `loss_start` is null outside the mask."""
    head = F.concat(F.lit(OPEN), escaped(F.col("role")), F.lit(MIDDLE))
    body = escaped(F.col("text"))
    masked = F.col("role") == MASKED_ROLE
    return messages.select(
        "conv_id",
        "turn",
        F.concat(head, body, F.lit(CLOSE)).alias("formatted"),
        F.when(masked, F.char_length(head)).alias("loss_start"),
        F.when(masked, F.char_length(body)).alias("loss_chars"),
    )


def format_events(events: DataFrame) -> DataFrame:
    return render(fold(events))


class _Digest:
    """What is known of a conversation while its turns go by."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.n_turns, self.loss_chars, self.chars = conv_id, 0, 0, 0
        self.turns, self.loss, self.text = hashlib.sha256(), hashlib.sha256(), ""

    def read(self, formatted: str, start: float | None, length: float | None) -> None:
        self.chars += len(formatted)
        if start is not None and start == start:
            loss = unescaped(formatted[int(start) : int(start + length)])
            self.loss_chars += len(loss)
            self.loss.update(loss.encode())
        self.text += formatted
        at = 0
        for match in _READ.finditer(self.text):
            if match.start() != at:
                raise ValueError("the formatted text can't be read back")
            at = match.end()
            self.n_turns += 1
            self.turns.update(f"{unescaped(match[1])}\n{unescaped(match[2])}\n".encode())
        self.text = self.text[at:]

    def row(self) -> tuple:
        if self.text:
            raise ValueError("the formatted text can't be read back")
        digests = self.turns.hexdigest(), self.loss.hexdigest()
        return self.conv_id, self.n_turns, digests[0], self.loss_chars, digests[1], self.chars


DIGEST = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string,"
    " formatted_chars long"
)


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what the formatted text says, read from the text and its loss spans alone; a row
    per conversation. Turns are streamed in order: memory is that of one turn."""
    names = [part.split()[0] for part in DIGEST.split(",")]

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, done = None, []
        for frame in frames:
            for null, conv_id, text, start, length in zip(
                frame["is_null"], frame["id"], frame["formatted"], frame["loss_start"],
                frame["loss_chars"], strict=True,
            ):
                own = None if null else conv_id
                if current is None or current.conv_id != own:
                    done += [current.row()] if current else []
                    current = _Digest(own)
                current.read(text, start, length)
            yield _frame(done)
            done = []
        if current:
            yield _frame([current.row()])

    def _frame(rows: list[tuple]) -> pd.DataFrame:
        frame = pd.DataFrame(rows, columns=names)
        return frame.astype({"conv_id": "Int64"})

    ordered = (
        formatted.withColumn("is_null", F.col("conv_id").isNull())
        .withColumn("id", F.coalesce("conv_id", F.lit(0)).cast("long"))
        .repartition("is_null", "id")
        .sortWithinPartitions("is_null", "id", "turn")
    )
    columns = ["is_null", "id", "formatted", "loss_start", "loss_chars"]
    return ordered.select(columns).mapInPandas(read, DIGEST)


def events_of(conversations: DataFrame, chars: int = 512) -> DataFrame:
    """The log of finished conversations (conv_id, turn, role, text): each row is streamed as a
    message of up to `chars` characters and deltas with the rest. Rows of the same turn are turns of
    their own, in order of role and text."""
    order = W.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = conversations.select(
        "conv_id",
        F.row_number().over(order).cast("long").alias("turn"),
        "role",
        F.coalesce("text", F.lit("")).alias("text"),
    )
    last = F.greatest(F.ceil(F.char_length("text") / chars) - 1, F.lit(0)).cast("int")
    parts = rows.select("*", F.explode(F.sequence(F.lit(0), last)).alias("part"))
    return parts.select(
        "conv_id",
        (F.col("turn") * 2**31 + F.col("part")).alias("seq"),
        "turn",
        F.when(F.col("part") == 0, "message").otherwise("delta").alias("kind"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.substring("text", F.col("part") * chars + 1, F.lit(chars)).alias("text"),
    )
