r"""Chat formatting by event-sourced reconstruction, in DataFrame functions only.

A log is a set of events (conv_id, seq, kind, target, role, text):

* ``message``    starts message ``target``
* ``delta``      appends its text to message ``target``
* ``edit``       replaces the text of message ``target``
* ``regenerate`` discards the text of message ``target``; later deltas refill it

Events are partitioned by conversation and message and folded in order of
``seq``: a message's final text is that of its last replacing event (message,
edit, regenerate) followed by the deltas after it.  Messages stand in order of
their first event.

Template of a turn: ``### Role: text</turn>\n``.  Inside roles and texts a
backslash becomes ``\b``, ``<`` becomes ``\l``, each ``##`` becomes ``\h#``; in
roles ``:`` also becomes ``\c``.  Hence ``</turn>`` and ``###`` occur only as
control strings, and the output reads back exactly.  The roles system, user and
assistant are shown capitalised; any other role is marked by a leading ``\r``.
The loss mask covers the (escaped) texts of the assistant.

Defined results: null text is empty; a null role is the empty role; a null
``seq`` sorts first; events with equal ``seq`` are ordered by kind (message,
edit, regenerate, delta), then target, role and text; a delta or edit of a
message that never began starts it with the event's role.  Repeated rows are
events in their own right.  Null conv_ids form one conversation of their own.
An empty log gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

END = "</turn>\n"
KNOWN = ("system", "user", "assistant")


def escape(text: Column) -> Column:
    for raw, safe in (("\\", "\\b"), ("<", "\\l"), ("##", "\\h#")):
        text = F.replace(text, F.lit(raw), F.lit(safe))
    return text


def unescape(text: Column) -> Column:
    for safe, raw in (("\\c", ":"), ("\\h#", "##"), ("\\l", "<"), ("\\b", "\\")):
        text = F.replace(text, F.lit(safe), F.lit(raw))
    return text


def _header(role: Column) -> Column:
    shown = F.when(role.isin(*KNOWN), F.initcap(role)).otherwise(
        F.concat(F.lit("\\r"), F.replace(escape(role), F.lit(":"), F.lit("\\c"))))
    return F.concat(F.lit("### "), shown, F.lit(": "))


def reconstruct(events: DataFrame) -> DataFrame:
    """Final messages: (conv_id, position, role, text) from an event log."""
    rank = (F.when(F.col("kind") == "message", 0).when(F.col("kind") == "edit", 1)
            .when(F.col("kind") == "regenerate", 2).otherwise(3))
    text = F.coalesce(F.col("text"), F.lit(""))
    entry = F.struct(
        F.col("seq").cast("long").alias("seq"), rank.alias("rank"), F.coalesce("role", F.lit("")).alias("role"),
        F.when(F.col("kind") == "regenerate", F.lit("")).otherwise(text).alias("text"))
    folded = (events.groupBy("conv_id", "target")
              .agg(F.array_sort(F.collect_list(entry)).alias("log")))
    last_reset = F.aggregate(
        "log", F.struct(F.lit(0).alias("i"), F.lit(1).alias("reset")),
        lambda acc, e: F.struct((acc["i"] + 1).alias("i"),
                                F.when(e["rank"] < 3, acc["i"] + 1).otherwise(acc["reset"]).alias("reset")),
        lambda acc: acc["reset"])
    kept = F.slice("log", F.col("reset"), F.size("log"))
    return (folded.withColumn("reset", last_reset)
            .select("conv_id", F.struct(F.element_at("log", 1)["seq"].alias("seq"),
                                        F.col("target")).alias("position"),
                    F.element_at("log", 1)["role"].alias("role"),
                    F.array_join(F.transform(kept, lambda e: e["text"]), "").alias("text")))


def render(messages: DataFrame) -> DataFrame:
    """(conv_id, formatted, turns): ``turns`` holds each formatted turn with its
    place and its loss span, in code points of ``formatted``."""
    header, body = _header(F.col("role")), escape(F.col("text"))
    rows = messages.select("conv_id", "position", header.alias("header"), body.alias("body"),
                           (F.col("role") == "assistant").alias("loss"))
    rows = rows.withColumn("chunk", F.concat("header", "body", F.lit(END)))
    before = Window.partitionBy("conv_id").orderBy("position", "chunk").rowsBetween(
        Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("chunk").cast("long")).over(before), F.lit(0).cast("long"))
    rows = rows.withColumn("start", start).withColumn("from", F.col("start") + F.length("header"))
    rows = rows.select("conv_id", F.struct(
        "start", F.col("chunk"), F.col("loss"), "from",
        (F.col("from") + F.length("body")).alias("to")).alias("turn"))
    return (rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
            .select("conv_id", F.array_join("turns.chunk", "").alias("formatted"), "turns"))


def read_back(formatted: Column) -> Column:
    """The turns (role, text) parsed from a formatted conversation."""
    chunks = F.filter(F.split(formatted, r"</turn>\n", -1), lambda c: c != "")

    def turn(chunk):
        shown = F.regexp_extract(chunk, r"(?s)\A### ([^:]*): ", 1)
        role = F.when(shown.startswith("\\r"), unescape(F.substr(shown, F.lit(3)))).otherwise(F.lower(shown))
        text = F.substr(chunk, F.length(shown) + F.lit(len("### ") + len(": ") + 1))
        return F.struct(role.alias("role"), unescape(text).alias("text"))

    return F.transform(chunks, turn)


def loss_text(turns: Column) -> Column:
    """All text under the loss mask, unescaped, in order, nothing between."""
    masked = F.filter(turns, lambda t: t["loss"])
    return F.array_join(F.transform(masked, lambda t: unescape(F.substr(
        t["chunk"], (t["from"] - t["start"] + 1).cast("int"), (t["to"] - t["from"]).cast("int")))), "")
