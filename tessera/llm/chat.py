"""Chat formatting by prefix-target expansion.

A conversation becomes one formatted text, kept as a row per turn (segment) with its place in the text. Every assistant
turn is an example of its own: all turns before it are context, and only its reply is trainable. Examples point into the
formatted text, so a conversation of n turns takes space in proportion to n, not to its square; `digests` reads
them back, and `materialised` writes their texts out.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import ship, written

OPEN, AFTER_ROLE, CLOSE = "### ", ": ", "</turn>\n"
TRAINED = "assistant"
#: Control strings and what stands for them inside texts, the escape character first.
ESCAPES = (("\\", "\\\\"), ("</turn>", "\\e"), ("###", "\\h"))
_BACK = {"\\": "\\", "e": "</turn>", "h": "###", "c": ":"}

SEGMENTS = "conv_id long, seq long, role string, segment string, start long, loss_start long, loss_end long"
DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def escaped(text: str) -> str:
    for what, into in ESCAPES:
        text = text.replace(what, into)
    return text


def unescaped(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: _BACK[m[1]], text)


def formatted(role: str, text: str) -> tuple[str, int, int]:
    """The segment of a turn, and where its text begins and ends in it."""
    head = OPEN + escaped(role).replace(":", "\\c") + AFTER_ROLE
    body = escaped(text)
    return head + body + CLOSE, len(head), len(head) + len(body)


def parsed(text: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted text."""
    out = []
    for segment in text.split(CLOSE)[:-1]:
        role, _, body = segment[len(OPEN) :].partition(AFTER_ROLE)
        if not segment.startswith(OPEN):
            raise ValueError("a turn without its head")
        out.append((unescaped(role), unescaped(body)))
    return out


def _one_place(df: DataFrame, *order: str) -> DataFrame:
    """Conversations whole and in order in their tasks; rows stream through, none is gathered."""
    return df.repartition("conv_id").sortWithinPartitions("conv_id", *order)


def segments(conversations: DataFrame) -> DataFrame:
    """One row per turn: conv_id, seq (from 0), role, segment, start (in the conversation's text), loss_start, loss_end.

    Turns follow `turn` (nulls first), ties role and text, and repeated rows are repeated turns. Null texts and roles are
    empty. Rows without conv_id are one conversation. The loss span is null for turns that are not trained; places count
    code points of the whole conversation. The table is written to the shared folder.
    """
    ship(conversations.sparkSession)
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        current, seq, place, begun = None, 0, 0, False
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
        for b in batches:
            out = []
            for conv, role, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                if not begun or conv != current:
                    current, seq, place, begun = conv, 0, 0, True
                segment, a, e = formatted(role, text)
                trained = role == TRAINED
                out.append((conv, seq, role, segment, place, place + a if trained else None, place + e if trained else None))
                seq, place = seq + 1, place + len(segment)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=[x.split()[0] for x in SEGMENTS.split(", ")])

    return written(_one_place(rows, "turn", "role", "text").select("conv_id", "role", "text").mapInArrow(run, SEGMENTS), "segments")


def examples(segs: DataFrame) -> DataFrame:
    """One row per trained turn: the formatted text from 0 to context_end is context, loss_start to loss_end is trainable."""
    return segs.where("loss_start is not null").select("conv_id", F.col("seq").alias("target"), F.col("start").alias("context_end"), "loss_start", "loss_end")


def materialised(segs: DataFrame) -> DataFrame:
    """conv_id, target, text, loss_start, loss_end with the texts of the examples, for conversations short enough to repeat."""
    whole = segs.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "segment"))), lambda x: x["segment"]), "").alias("whole"))
    out = examples(segs).join(whole.withColumnRenamed("conv_id", "_c"), F.col("conv_id").eqNullSafe(F.col("_c")))
    return out.select("conv_id", "target", F.substring("whole", F.lit(1), F.col("loss_end").cast("int")).alias("text"), "loss_start", "loss_end")


def digests(segs: DataFrame, made: DataFrame | None = None) -> DataFrame:
    """Reads the examples back: per conversation, turns and their hash, trained code points and their hash, formatted code points.

    The examples (`made`; by default those of `examples`, written to the shared folder) meet the turns they point into, in order
    and streaming. The context of each must be all turns before its target. What is trained comes from their loss spans alone;
    the formatted text ends with the last example, and turns after the last reply are added from the segments.
    """
    ship(segs.sparkSession)
    made = written(examples(segs), "examples") if made is None else made

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        state = None

        def done(rows: list) -> object:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=[x.split()[0] for x in DIGESTS.split(", ")])

        close = lambda s: (s["conv"], s["turns"], s["all"].hexdigest(), s["chars"], s["loss"].hexdigest(), s["end"] + s["after"])
        for b in batches:
            rows = []
            for conv, seq, segment, start, a, e in zip(*(b.column(i).to_pylist() for i in range(6)), strict=True):
                if state is None or state["conv"] != conv:
                    if state is not None:
                        rows.append(close(state))
                    state = {"conv": conv, "turns": 0, "all": hashlib.sha256(), "chars": 0, "loss": hashlib.sha256(), "end": 0, "after": 0, "target": None}
                if segment is not None:
                    if start != state["end"] + state["after"]:
                        raise ValueError("a turn that does not follow the one before")
                    for role, text in parsed(segment):
                        state["turns"] += 1
                        state["all"].update(f"{role}\n{text}\n".encode())
                    state["target"] = seq, start, segment
                    state["after"] += len(segment)
                    continue
                if state["target"] is None or state["target"][:2] != (seq, start):
                    raise ValueError("an example whose context is not all turns before its target")
                reply = state["target"][2]
                loss = unescaped(reply[a - start : e - start])
                state["chars"] += len(loss)
                state["loss"].update(loss.encode())
                state["end"], state["after"] = e + len(CLOSE), 0
            if rows:
                yield done(rows)
        if state is not None:
            yield done([close(state)])

    none = F.lit(None)
    turns = segs.select("conv_id", "seq", F.lit(0).alias("kind"), "segment", "start", none.cast("long").alias("loss_start"), none.cast("long").alias("loss_end"))
    targets = made.select("conv_id", F.col("target").alias("seq"), F.lit(1).alias("kind"), none.cast("string").alias("segment"), F.col("context_end").alias("start"), "loss_start", "loss_end")
    rows = _one_place(turns.union(targets), "seq", "kind").select("conv_id", "seq", "segment", "start", "loss_start", "loss_end")
    return rows.mapInArrow(run, DIGESTS)
