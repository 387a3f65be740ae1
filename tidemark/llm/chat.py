"""Chat formatting by event sourcing: an event log per conversation becomes rendered messages.

Events: ``conv_id, seq, kind, ref, role, text``. They are dealt out by conversation, sorted by ``seq`` and folded:

* ``message`` opens a message;
* ``delta`` appends its text to the message ``ref`` (a ``seq``), or to the latest opened one if ``ref`` is null;
* ``edit`` replaces what message ``ref`` says so far (latest opened one if null);
* ``regenerate`` opens a message in the place of ``ref`` (the latest opened one if null): that one and all after it go.

Null texts are empty, null roles too; events that refer to no message are left out; equal ``seq`` are ordered by kind,
role, text, so repeated rows give repeated messages in a fixed order; null ``conv_id`` is one conversation of its own,
null ``seq`` comes first. An empty log gives no rows. Extra columns are not read.

The result has one row per final message, so no conversation is ever held whole: the formatted conversation is its
``piece`` values in the order of ``position``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
KINDS = ("message", "delta", "edit", "regenerate")
EVENT = "conv_id long, seq long, kind string, ref long, role string, text string"


def escape(text: Column) -> Column:
    """A backslash more after ``<`` wherever ``<``, any backslashes and ``|`` meet: no control string is left."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def escape_role(role: Column) -> Column:
    """As a text, and on one line."""
    return F.replace(F.replace(escape(role), F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A"))


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def unescape_role(role: str) -> str:
    return unescape(role.replace("%0A", "\n").replace("%25", "%"))


def fold(events: DataFrame) -> DataFrame:
    """``conv_id, position, role, text``: the messages that are left when the log has been read."""
    order = [F.col("seq").asc_nulls_first(), "kind", "ref", "role", "text"]
    log = Window.partitionBy("conv_id").orderBy(*order)
    upto = log.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = log.rowsBetween(Window.unboundedPreceding, -1)
    opens = F.col("kind").isin("message", "regenerate")
    events = events.select("conv_id", "seq", "kind", "ref", "role", F.coalesce("text", F.lit("")).alias("text")).where(F.col("kind").isin(*KINDS))
    numbered = events.withColumn("at", F.row_number().over(log)).withColumns({
        "latest": F.last(F.when(opens, F.col("at")), ignorenulls=True).over(upto),
        "earlier": F.last(F.when(opens, F.col("at")), ignorenulls=True).over(before),
    })
    # an explicit ref: the latest message opened under that seq; a join of the few rows that have one
    named = numbered.where(opens).groupBy("conv_id", F.col("seq").alias("ref")).agg(F.max("at").alias("named"))
    with_ref = numbered.where(F.col("ref").isNotNull()).alias("e").join(
        named.where(F.col("ref").isNotNull()).alias("n"), F.col("e.conv_id").eqNullSafe(F.col("n.conv_id")) & (F.col("e.ref") == F.col("n.ref")), "left"
    ).select("e.*", "n.named")
    aimed = numbered.where(F.col("ref").isNull()).withColumn("named", F.lit(None).cast("int")).unionByName(with_ref)
    slot = F.when(opens, F.col("at")).when(F.col("ref").isNull(), F.col("latest")).otherwise(F.col("named"))
    drops_from = F.when(F.col("kind") == "regenerate", F.when(F.col("ref").isNull(), F.col("earlier")).otherwise(F.col("named")))
    backwards = Window.partitionBy("conv_id").orderBy(F.col("at").desc()).rowsBetween(Window.unboundedPreceding, -1)
    placed = aimed.withColumns({"slot": slot, "cut": F.min(drops_from).over(backwards)})
    # a slot is dead if any later event than its opening cuts at or before it; the opening row knows
    part = F.struct("at", "kind", "role", "text", "cut")
    parts = placed.where(F.col("slot").isNotNull()).groupBy("conv_id", "slot").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    first = F.col("parts")[0]
    last_edit = F.coalesce(F.array_max(F.transform(F.filter("parts", lambda x: x["kind"] == "edit"), lambda x: x["at"])), F.lit(0))
    text = F.array_join(F.transform(F.filter("parts", lambda x: x["at"] >= last_edit), lambda x: x["text"]), "")
    return parts.where(first["cut"].isNull() | (first["cut"] > F.col("slot"))).select(
        "conv_id", F.col("slot").alias("position"), F.coalesce(first["role"], F.lit("")).alias("role"), text.alias("text")
    )


def render(messages: DataFrame, trained: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """Adds ``piece`` and the code points ``loss_start`` to ``loss_end`` in it under the loss mask (null: none).

    A piece is ``<|im_start|>role``, a line feed, the escaped text, ``<|im_end|>`` and a line feed.
    """
    head = F.concat(F.lit(OPEN), escape_role(F.col("role")), F.lit("\n"))
    body = escape(F.col("text"))
    rendered = messages.withColumns({"head": head, "body": body}).withColumn("piece", F.concat("head", "body", F.lit(CLOSE + "\n")))
    masked = F.col("role").isin(*trained)
    return rendered.withColumns({
        "loss_start": F.when(masked, F.char_length("head")),
        "loss_end": F.when(masked, F.char_length("head") + F.char_length("body")),
    }).drop("head", "body")


def format_chat(events: DataFrame) -> DataFrame:
    return render(fold(events))


PIECE = re.compile(re.escape(OPEN) + "([^\n]*)\n(.*)" + re.escape(CLOSE) + "\n", re.DOTALL)
DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


class Reading:
    """One conversation read back from its pieces, in a few hundred bytes."""

    def __init__(self, conv_id):
        self.conv_id, self.turns, self.chars, self.loss_chars = conv_id, 0, 0, 0
        self.turns_hash, self.loss_hash = hashlib.sha256(), hashlib.sha256()

    def add(self, piece: str, start, end) -> None:
        role, text = PIECE.fullmatch(piece).groups()
        self.turns += 1
        self.chars += len(piece)
        self.turns_hash.update(f"{unescape_role(role)}\n{unescape(text)}\n".encode())
        if not pd.isna(start):
            loss = unescape(piece[int(start) : int(end)])
            self.loss_chars += len(loss)
            self.loss_hash.update(loss.encode())

    def row(self) -> tuple:
        return self.conv_id, self.turns, self.turns_hash.hexdigest(), self.loss_chars, self.loss_hash.hexdigest(), self.chars


def digest(formatted: DataFrame) -> DataFrame:
    """Per conversation what its pieces say, read piece by piece in order; a long conversation streams through its task."""
    names = [x.split()[0] for x in DIGEST.split(", ")]

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, done = None, []
        for f in frames:
            for conv, piece, start, end in zip(f["conv_id"], f["piece"], f["loss_start"], f["loss_end"]):
                conv = None if pd.isna(conv) else int(conv)
                if now is None or conv != now.conv_id:
                    if now is not None:
                        done.append(now.row())
                    now = Reading(conv)
                now.add(piece, start, end)
            if done:
                yield pd.DataFrame(done, columns=names).astype({"conv_id": "Int64"})
                done = []
        if now is not None:
            yield pd.DataFrame([now.row()], columns=names).astype({"conv_id": "Int64"})

    dealt = formatted.select("conv_id", "position", "piece", "loss_start", "loss_end").repartition("conv_id")
    return dealt.sortWithinPartitions("conv_id", "position").drop("position").mapInPandas(read, DIGEST)
