"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target number of words. Its ratio of target to size says how often each of its
documents is wanted: the whole part is a certain number of copies of every document. What is left of
the target is sampled with unequal probabilities, in proportion to the binary digits of a document's
size, so a document of twice the words has one part more; who reaches 1 that way gets a further
certain copy. Documents of a source are ranked by their random odds divided by their inclusion odds,
and the sample is the head of that order: as many documents as bring the words nearest to the
target, so the size of the sample is fixed in words. A source has some 30 sizes in digits at most, so
the factor that makes the probabilities meet the target comes from sums over these.

Ranks are cut into slots. Words per source and slot are summed in the map tasks, running sums are
taken over those sums, and only inside the slot where a source's sample ends is the order of single
documents looked at; a source that holds a third of all documents is no single group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillstream.llm.scratch import save

WORD = r"[^\x20\x09-\x0D]+"
#: Two levels of slots: the second cuts the slot in which the sample of a source ends.
SLOTS = 4096
DIGITS = 13
#: Equal rows are counted, and written out again in pieces of so many.
PIECE = 100_000


def word_count(text: str) -> Column:
    """Words of a text; null and blank texts have none."""
    return F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def uniform(digest: Column) -> Column:
    """A number in (0, 1) out of the head of a hexadecimal digest."""
    return (F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("double") + 0.5) / float(16 ** DIGITS)


def draws(docs: DataFrame, seed: int) -> DataFrame:
    """``(doc_id, source, size, u)``, one row per row of ``docs``; equal rows have draws of their own.

    Equal rows are counted in the map tasks and numbered, so the draws do not depend on where rows lie.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    rows = docs.select(
        "doc_id", F.col("source").cast("string").alias("source"), word_count("text").alias("size"),
        F.md5(F.concat_ws("\x1f", name, text, F.lit(str(seed)))).alias("digest"))
    counted = save(rows.groupBy("doc_id", "source", "size", "digest").agg(F.count(F.lit(1)).alias("n")), "counted")
    few = counted.where(F.col("n") <= PIECE).withColumn("k", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    pieces = counted.where(F.col("n") > PIECE).withColumn(
        "piece", F.explode(F.expr(f"sequence(0L, (n - 1) div {PIECE})"))).repartition("digest", "piece")
    many = pieces.withColumn("k", F.explode(F.expr(
        f"sequence(piece * {PIECE} + 1, least(n, (piece + 1) * {PIECE}))"))).drop("piece")
    own = F.when(F.col("k") == 1, F.col("digest")).otherwise(F.md5(F.concat_ws(":", "digest", F.col("k").cast("string"))))
    return few.unionByName(many).select("doc_id", "source", "size", uniform(own).alias("u"))


def ranked_sources(sizes: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    """Sources with the weights dealt out in code point order, null last.

    Places are counted inside ranges of the sorted sources and offset by the ranges before, so that
    millions of sources are no single sorted task.
    """
    ranged = save(sizes.repartitionByRange(F.asc_nulls_last("source")).withColumn("range", F.spark_partition_id()), "sources")
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy("range").agg(F.count(F.lit(1)).alias("n")).select(
        "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    place = F.col("offset") + F.row_number().over(Window.partitionBy("range").orderBy(F.asc_nulls_last("source"))) - 1
    dealt = F.array(*[F.lit(float(w)) for w in weights])
    return ranged.join(offsets, "range").withColumn("place", place).select(
        "source", "source_size", F.get(dealt, F.col("place") % len(weights)).alias("weight"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), limit: float = 3.0) -> DataFrame:
    """``(source, source_size, target)``: shares of all words by weight, at most ``limit`` times a source.

    What a limit cuts off is shared among the sources below theirs by weight, until none is above.
    Two sums per round reach the driver, nothing that grows with the sources.
    """
    named = save(ranked_sources(sizes, weights), "weighted")
    cap = F.col("source_size") * limit
    total = named.agg(F.sum("source_size")).first()[0] or 0
    per_weight, capped_before = 0.0, -1
    while True:
        # The share per unit of weight only grows, so a source once at its limit stays there.
        at_limit = F.col("weight") * per_weight > cap
        taken, weight, n = named.agg(
            F.sum(F.when(at_limit, F.col("source_size")).otherwise(0)), F.sum(F.when(~at_limit, F.col("weight"))),
            F.count(F.when(at_limit, 1))).first()
        if n == capped_before or not weight:
            break
        capped_before = n
        per_weight = (total - limit * taken) / weight
    return named.select("source", "source_size", F.least(cap, F.col("weight") * per_weight).alias("target"))


def chances(classes: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(source_key, digits, copies, chance, quota)`` of each size class of a source.

    ``chance`` is ``digits`` times a factor of the source and less than 1; a class that would reach 1
    has a copy more and no chance, and the others share what is left. ``quota`` is the words to sample.
    """
    order = Window.partitionBy("source_key").orderBy(F.desc("digits"))
    source = Window.partitionBy("source_key")
    larger = F.coalesce(F.sum("class_size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = F.sum(F.col("digits") * F.col("class_size")).over(order.rowsBetween(0, Window.unboundedFollowing))
    # The factor if exactly the larger classes are certain; the greatest that leaves this class below 1 holds.
    tried = classes.join(wanted, "source_key").withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")).withColumn(
        "tried", (F.col("rest") - larger) / F.nullif(parts, F.lit(0)))
    rated = tried.withColumn("factor", F.max(F.when(F.col("tried") * F.col("digits") <= 1, F.col("tried"))).over(source)).withColumn(
        "rate", F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(F.col("factor") * F.col("digits"), F.lit(1.0)))))
    certain = F.col("rate") >= 1
    open_size = F.sum(F.when(certain, 0).otherwise(F.col("class_size"))).over(source)
    left = F.col("rest") - F.sum(F.when(certain, F.col("class_size")).otherwise(0)).over(source)
    return rated.select(
        "source_key", "digits", "source_size", "target",
        (F.col("whole") + F.when(certain & (F.col("rest") > 0), 1).otherwise(0)).alias("copies"),
        F.when(certain, 0.0).otherwise(F.col("rate")).alias("chance"), F.least(left, open_size).alias("quota"))


def _running(rows: DataFrame, slot: str) -> DataFrame:
    """Words before each slot of a source."""
    before = Window.partitionBy("source_key").orderBy(slot).rowsBetween(Window.unboundedPreceding, -1)
    summed = rows.groupBy("source_key", slot).agg(F.sum("size").alias("slot_size"))
    return summed.withColumn("before", F.coalesce(F.sum("slot_size").over(before), F.lit(0)))


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), limit: float = 3.0, seed: int = 1) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``size``, ``source_size``, ``target``, ``taken``.

    ``taken`` is a whole multiple of ``size``: the certain copies and, for sampled documents, one
    more. A source's taken words differ from its target by at most half of the document at which its
    sample ends. Null, empty and blank texts have size 0 and take nothing. Documents without source
    are one source, which comes last. The draw depends on ``doc_id`` and the text alone, so reruns
    agree and new columns change nothing; equal rows are drawn one by one. An empty table gives no rows.
    """
    # Null is a source of its own; the key tells it from a source named by the empty text.
    key = F.when(F.col("source").isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), "source"))
    drawn = save(draws(docs, seed).withColumns({"source_key": key, "digits": F.length(F.bin("size"))}), "drawn")
    classes = save(drawn.groupBy("source", "source_key", "digits").agg(F.sum("size").alias("class_size")), "classes")
    sizes = classes.groupBy("source").agg(F.sum("class_size").alias("source_size"))
    wanted = targets(sizes, weights, limit).withColumn("source_key", key).withColumn("whole", F.floor(F.when(
        F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))).drop("source")
    rates = save(chances(classes.drop("source"), wanted), "chances")
    odds = F.when(F.col("chance") > 0, (F.col("u") / (1 - F.col("u"))) / (F.col("chance") / (1 - F.col("chance"))))
    # odds / (1 + odds) lies in (0, 1) and keeps the order.
    ordered = (
        drawn.drop("source").join(rates, ["source_key", "digits"]).withColumn("odds", odds)
        .withColumn("place", F.col("odds") / (1 + F.col("odds")) * SLOTS)
        .withColumn("slot", F.floor("place")).withColumn("fine", F.floor((F.col("place") - F.col("slot")) * SLOTS))
    )
    sampled = ordered.where("chance > 0 and size > 0")
    quota = rates.select("source_key", "quota").distinct()
    coarse = _running(sampled, "slot").join(quota, "source_key")
    cut = coarse.where((F.col("before") < F.col("quota")) & (F.col("before") + F.col("slot_size") >= F.col("quota"))).select(
        "source_key", F.col("slot").alias("end_slot"), (F.col("quota") - F.col("before")).alias("quota_2"))
    inside = sampled.join(cut, "source_key").where("slot = end_slot")
    second = _running(inside, "fine").join(cut, "source_key")
    cut_2 = second.where((F.col("before") < F.col("quota_2")) & (F.col("before") + F.col("slot_size") >= F.col("quota_2"))).select(
        "source_key", "end_slot", F.col("fine").alias("end_fine"), (F.col("quota_2") - F.col("before")).alias("left"))
    order = Window.partitionBy("source_key").orderBy("odds", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    last = (
        sampled.join(cut_2, "source_key").where("slot = end_slot and fine = end_fine")
        .withColumn("before", F.coalesce(F.sum("size").over(order), F.lit(0)))
        .where(F.col("before") + F.col("size") / 2 <= F.col("left"))
        .groupBy("source_key").agg(F.max(F.struct("odds", "doc_id", "size")).alias("last"))
    )
    ending = cut_2.join(last, "source_key", "left")
    chosen = (
        (F.col("slot") < F.col("end_slot"))
        | ((F.col("slot") == F.col("end_slot")) & (F.col("fine") < F.col("end_fine")))
        | ((F.col("slot") == F.col("end_slot")) & (F.col("fine") == F.col("end_fine"))
           & (F.struct("odds", "doc_id", "size") <= F.col("last")))
    )
    extra = F.when((F.col("chance") > 0) & chosen, 1).otherwise(0)
    return ordered.join(ending.select("source_key", "end_slot", "end_fine", "last"), "source_key", "left").select(
        "doc_id", "size", "source_size", "target", ((F.col("copies") + extra) * F.col("size")).alias("taken"))
