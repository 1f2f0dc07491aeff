"""Chat rendering from every participant's perspective. DataFrame functions only.

For each participant the dialogue is rendered with that speaker as the assistant and all others as
named users; the loss mask covers exactly what the assistant says. System messages are context for
everyone and never a participant. A dialogue is stored in parts of ``TURNS`` consecutive turn
numbers, so a conversation of any length is rows of bounded size.

``dialogues`` renders whole conversations: every participant has every part, offsets count from the
start of the conversation, and the parts in order are the full rendering. ``render`` takes each part
as a dialogue of its own, without what was said before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

TURNS = 64
START, END = "<|im_start|>", "<|im_end|>"
SYSTEM = "system"


def plain(text: Column) -> Column:
    """Text in which nobody can write a marker of the format."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|im_"), F.lit("< |im_"))


def messages(turns: DataFrame) -> DataFrame:
    """Distinct messages with their window. Without ``conv_id`` or ``turn`` a message stands alone."""
    placed = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("unknown")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).distinct()
    alone = F.col("conv_id").isNull() | F.col("turn").isNull()
    return placed.withColumn("part", F.when(~alone, F.floor(F.col("turn") / TURNS))).withColumn(
        "alone", F.when(alone, F.sha2(F.concat_ws("\x1f", F.coalesce(F.col("turn").cast("string"), F.lit("")), "role", "text"), 256)))


def render(turns: DataFrame) -> DataFrame:
    """Every part as a dialogue of its own: ``(conv_id, participant, part, n_turns, n_trained, text, mask)``, one row per conversation,
    participant and window.

    ``mask`` lists ``start-end`` of what is trained, in code points of ``text``, end exclusive: the
    assistant's words and the end marker. Messages follow by turn, then role and text; equal rows
    count once. A null text is empty, a null role is the participant ``unknown``. A message without
    ``conv_id`` or ``turn`` is a dialogue of its own. Empty tables give no rows.
    """
    grouped = _parts(messages(turns))
    speakers = F.array_distinct(F.filter(F.transform("said", lambda m: m["role"]), lambda r: r != SYSTEM))
    return _rendered(grouped.withColumns({"participant": F.explode(speakers), "before": F.lit(0)}))


def dialogues(turns: DataFrame, context: bool = False) -> DataFrame:
    """``(conv_id, participant, part, n_turns, n_trained, text, mask)``: every part of every conversation
    for every participant of the whole conversation.

    The texts of a conversation and participant, joined in order of ``part``, are the full rendering;
    ``mask`` counts from its start and is empty where the participant is silent. ``n_turns`` and
    ``n_trained`` count the messages of the part. With ``context`` there is a further column of that
    name: the system messages of all parts before, rendered, for readers of single parts. Otherwise as
    ``render``: order, equal and null rows, messages without ``conv_id`` or ``turn``.
    """
    said = messages(turns).withColumn("dialogue", F.concat_ws("/", F.coalesce(
        F.col("conv_id").cast("string"), F.lit("")), F.coalesce("alone", F.lit(""))))
    who = said.where(F.col("role") != SYSTEM).select("dialogue", F.col("role").alias("participant")).distinct()
    # As others read it a part has one length; a participant's own messages have another head.
    head = F.length(_head("role", F.lit(False)))
    lengths = said.groupBy("dialogue", "part").agg(
        F.sum(head + F.length(_body("text")) + 1).alias("length"))
    own = said.where(F.col("role") != SYSTEM).groupBy("dialogue", "part", F.col("role").alias("participant")).agg(
        F.sum(F.length(_head("role", F.lit(True))) - head).alias("shift"))
    before = Window.partitionBy("dialogue", "participant").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    places = lengths.join(who, "dialogue").join(own, ["dialogue", "part", "participant"], "left").select(
        "dialogue", "part", "participant",
        F.coalesce(F.sum(F.col("length") + F.coalesce("shift", F.lit(0))).over(before), F.lit(0)).alias("before"))
    parts = _parts(said, "dialogue")
    # A message that stands alone has no part and is a dialogue with nothing before it.
    views = parts.join(who, "dialogue").join(places, ["dialogue", "part", "participant"], "left").withColumn(
        "before", F.coalesce("before", F.lit(0)))
    if not context:
        return _rendered(views)
    system = said.where(F.col("role") == SYSTEM).select(
        "dialogue", F.col("part").alias("at"), F.struct("turn", "role", "text").alias("m"))
    earlier = parts.select("dialogue", "part").join(system, "dialogue").where("at < part").groupBy("dialogue", "part").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("m")), lambda m: F.concat(
            _head(m["role"], F.lit(False)), _body(m["text"]), F.lit("\n"))), "").alias("context"))
    return _rendered(views.join(earlier, ["dialogue", "part"], "left").withColumn(
        "context", F.coalesce("context", F.lit(""))), "context")


def _head(role: Column | str, mine: Column) -> Column:
    role = F.col(role) if isinstance(role, str) else role
    return F.when(mine, F.lit(f"{START}assistant\n")).when(
        role == SYSTEM, F.lit(f"{START}system\n")).otherwise(
        F.concat(F.lit(f"{START}user name="), plain(role), F.lit("\n")))


def _body(text: Column | str) -> Column:
    return F.concat(plain(F.col(text) if isinstance(text, str) else text), F.lit(END))


def _parts(said: DataFrame, *keys: str) -> DataFrame:
    return said.groupBy(*keys, "conv_id", "part", "alone").agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("said"))


def _rendered(views: DataFrame, *more: str) -> DataFrame:
    """The rows of a part and ``participant``, whose text begins at offset ``before``."""

    def piece(m):
        mine = m["role"] == F.col("participant")
        head, body = _head(m["role"], mine), _body(m["text"])
        return F.struct(F.concat(head, body, F.lit("\n")).alias("text"), mine.alias("mine"),
                        F.length(head).alias("head"), F.length(body).alias("body"))

    views = views.withColumn("pieces", F.transform("said", piece))
    none = F.expr("struct(cast(before as bigint) as at, cast(array() as array<string>) as spans)")

    def step(state, p):
        begin = state["at"] + p["head"]
        end = begin + p["body"]
        span = F.array(F.concat_ws("-", begin.cast("string"), end.cast("string")))
        return F.struct((end + 1).alias("at"), F.when(p["mine"], F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"))

    spans = F.aggregate("pieces", none, step)["spans"]
    return views.select(
        "conv_id", "participant", "part", F.size("said").alias("n_turns"), F.size(spans).alias("n_trained"),
        F.array_join(F.transform("pieces", lambda p: p["text"]), "").alias("text"), F.array_join(spans, ",").alias("mask"), *more)
