"""Similarity join on word n-gram sets by vertical partitioning of the global n-gram order.

All n-grams are ordered by a 64-bit hash, and the order is cut into fragments. Two sets that
differ in at most ``d`` n-grams differ in at most ``d`` fragments, so with ``d + 1`` fragments at
least one is equal: a document is announced once per fragment, under a hash of what it has there,
and only documents that meet are compared. Overlaps are then counted fragment by fragment and
summed per pair. The hash order needs no counting pass and cuts evenly; a common passage never
fills a whole fragment, so it makes nobody meet.

Before that, most documents are found to have no partner at all: in one stretch of the order all
n-grams are counted, and a set with more n-grams there that no other set has than a link allows to
differ is left alone. Only the others are cut into fragments.

How copies stay cheap without losing a link between different texts:

* equal sets are one node, named by its smallest ``doc_id``;
* in every meeting list one central set (the one that meets most others) is compared with the
  rest first, and the links found are contracted to components;
* only pairs are compared of which the parities of the fragment sizes allow a link (sets differ in at
  least as many n-grams as there are fragments of which one has an even and the other an odd number);
* after that, members of different components are compared only if they share one of their rarest
  n-grams (see :func:`_prefixes`). Versions of one text that are too far apart meet in many lists,
  but share common n-grams only, so their pairs are never made.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from tillstream.llm import block_repeats as packing
from tillstream.llm.components import components
from tillstream.llm.scratch import partitions, save
from tillstream.llm.words import Batches, WordIds, flat, lists, mix, shingle_set, signed, slices, texts

#: Fragments for counting overlaps, and finer ones whose parities bound the difference of two sets.
COUNT_BITS = 4
PARITY_BITS = 9
#: Fragments beyond ``d + 1``: so many may be empty in a set before "empty" is announced as well. One in
#: thirty or so is empty; with these hardly any set announces that, whose lists would hold most sets.
SPARE, SPARE_SHARE = 2, 8
GROWTH = 1.25
#: N-grams of the counted stretch that a task sorts and packs together; several arrays of this length live at once.
COUNTED_KEYS = 400_000
#: Eighths of the order in which n-grams are counted. A set without partner has about this share of
#: its n-grams there, which must be clearly more than the share that a link allows to differ.
COUNTED_EIGHTHS = 3


@dataclass(frozen=True)
class Level:
    """Sets of ``low`` to ``high`` n-grams are cut into ``parts`` fragments (0: only equal sets link), of
    which ``spare`` may be empty."""

    low: int
    high: int
    parts: int
    spare: int


def levels(percent: int, largest: int = 1 << 31) -> list[Level]:
    """Size classes for links at ``100 * intersection >= percent * union``.

    A class grows at least as much as a linked partner may be larger.
    """
    out, low = [], 1
    while low <= largest:
        high = max(low, int(low * max(GROWTH, 100 / percent)))
        differ = 2 * high * (100 - percent) // (100 + percent)
        spare = SPARE + differ // SPARE_SHARE
        out.append(Level(low, high, differ + 1 + spare if differ else 0, spare))
        low = high + 1
    return out


def _cut(values: np.ndarray, parts: int) -> np.ndarray:
    return ((values >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)


def meeting_keys(values: np.ndarray, table: list[Level], percent: int) -> np.ndarray:
    """Keys of the fragments of a sorted set; linked different sets have a key in common."""
    size, keys = len(values), []
    at = next(i for i, level in enumerate(table) if size <= level.high)
    # A larger partner lies in the same class or, if this set is large enough, in the next one.
    for i in (at, at + 1):
        level = table[i]
        if not level.parts or (i > at and 100 * size < percent * level.low):
            continue
        part = _cut(values, level.parts)
        starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        names = mix(np.arange(level.parts, dtype=np.uint64) + np.uint64(i << 40))
        keys.append(mix(np.add.reduceat(values, starts) + names[part[starts].astype(np.int64)]))
        if level.parts - len(starts) > level.spare:
            empty = np.ones(level.parts, bool)
            empty[part[starts].astype(np.int64)] = False
            keys.append(mix(~names[empty]))
    return np.concatenate(keys) if keys else np.empty(0, np.uint64)


def _names(n: int):
    def run(batches: Batches) -> Batches:
        ids = WordIds()
        for batch in slices(batches):
            sets = [shingle_set(ids.of((t or b"").lower().split()), n) for t in texts(batch)]
            names = [xxhash.xxh3_128_digest(v.tobytes()) if len(v) else None for v in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(v) for v in sets], pa.int64()), pa.array(names, pa.binary())],
                ["doc_id", "n_shingles", "set_id"])

    return run


def _counted(n: int, bins: int):
    """Packed n-grams of the counted stretch; flagged are those that a group holds more than once."""

    def run(batches: Batches) -> Batches:
        ids = WordIds()
        for batch in batches:
            for docs, keys, flags in packing._groups(described(batch, ids), COUNTED_KEYS):
                k, d, _, first = packing._local(docs, keys, flags)
                if len(k):
                    starts = np.flatnonzero(first)
                    many = np.diff(np.r_[starts, len(k)]) > 1
                    yield packing._rows(packing._bin_of(k[starts], bins), d[starts], k[starts], many, np.uint32)

    def described(batch, ids):
        for part in slices([batch]):
            for doc_id, text in zip(part.column("doc_id").to_pylist(), texts(part)):
                values = shingle_set(ids.of((text or b"").lower().split()), n)
                # A copy: a view would keep the whole set alive until its group is packed.
                values = values[: np.searchsorted(values, np.uint64(COUNTED_EIGHTHS << 61))].copy()
                if doc_id is not None and len(values):
                    yield doc_id, values, np.zeros(len(values), bool)

    return run


def _alone(groups: int):
    """For each document of one range of hashes, how many n-grams no other one has; packed by group."""

    def run(key, table):
        docs, many, grams = packing._unpack(table, np.uint32)
        order = np.argsort(grams, kind="stable")
        docs, many, grams = docs[order], many[order], grams[order]
        edge = grams[1:] != grams[:-1]
        own = np.r_[True, edge] & np.r_[edge, True] & ~many
        found, counts = np.unique(docs[own], return_counts=True)
        part = found % groups
        order = np.argsort(part, kind="stable")
        part, found, counts = part[order], found[order], counts[order]
        starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(part) else np.empty(0, int)
        offsets = pa.array(np.r_[starts, len(part)].astype(np.int32))
        return pa.table({
            "part": pa.array(part[starts], pa.int64()),
            "docs": pa.ListArray.from_arrays(offsets, pa.array(found, pa.int64())),
            "counts": pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int32()))})

    return run


def _summed(table):
    docs, counts = flat(table.column("docs")), flat(table.column("counts"))
    found, place = np.unique(docs, return_inverse=True)
    return pa.table({"doc_id": pa.array(found, pa.int64()), "n_alone": pa.array(np.bincount(place, counts).astype(np.int64))})


def may_link(rows: DataFrame, named: DataFrame, n: int, percent: int) -> DataFrame:
    """``doc_id`` of the documents that the n-grams of the counted stretch leave a chance of a partner.

    A partner must hold all but ``(100 - percent) %`` of a set. A document with more n-grams of its own
    than that is left out; rows that share a ``doc_id`` are judged for the smallest of their sets.
    """
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bins = max(partitions(rows.sparkSession), size // packing.RANGE_BYTES + 1)
    packed = rows.mapInArrow(_counted(n, bins), packing.PACKED).groupBy("bin").applyInArrow(
        _alone(bins), "part long, docs array<long>, counts array<int>")
    alone = packed.groupBy("part").applyInArrow(_summed, "doc_id long, n_alone long")
    per_doc = named.groupBy("doc_id").agg(F.sum("n_shingles").alias("total"), F.min("n_shingles").alias("least"))
    left = 100 * F.coalesce("n_alone", F.lit(0)) <= 100 * F.col("total") - percent * F.col("least")
    return per_doc.join(alone, "doc_id", "left").where(left).select("doc_id")


def _describe(n: int, percent: int):
    table = levels(percent)

    def run(batches: Batches) -> Batches:
        ids = WordIds()
        for batch in slices(batches):
            sizes, names, keys, parities = [], [], [], []
            for text in texts(batch):
                values = shingle_set(ids.of((text or b"").lower().split()), n)
                sizes.append(len(values))
                if not len(values):
                    names.append(None)
                    keys.append(values.view(np.int64))
                    parities.append(np.empty(0, np.int64))
                    continue
                names.append(xxhash.xxh3_128_digest(values.tobytes()))
                keys.append(signed(meeting_keys(values, table, percent)))
                fine = (values >> np.uint64(64 - PARITY_BITS)).astype(np.int64)
                odd = np.bincount(fine, minlength=1 << PARITY_BITS) & 1
                parities.append(np.packbits(odd.astype(np.uint8)).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(names, pa.binary()),
                 lists(keys), lists(parities)],
                ["doc_id", "n_shingles", "set_id", "keys", "parities"])

    return run


def _segments(n: int):
    def run(batches: Batches) -> Batches:
        ids = WordIds()
        for batch in slices(batches):
            docs, names, parts, values_of = [], [], [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch)):
                values = shingle_set(ids.of((text or b"").lower().split()), n)
                name = xxhash.xxh3_128_digest(values.tobytes())
                part = (values >> np.uint64(64 - COUNT_BITS)).astype(np.int32)
                edges = np.searchsorted(part, np.arange((1 << COUNT_BITS) + 1))
                for p in np.unique(part):
                    docs.append(doc_id)
                    names.append(name)
                    parts.append(int(p))
                    values_of.append(signed(values[edges[p] : edges[p + 1]]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs, pa.int64()), pa.array(names, pa.binary()), pa.array(parts, pa.int32()),
                 lists(values_of)], ["node", "set_id", "part", "grams"])

    return run


def _verified(pairs: DataFrame, segments: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` that link: overlaps counted by fragment, then summed."""
    left = segments.select(F.col("node").alias("a"), F.col("set_id").alias("set_a"), "part", F.col("grams").alias("x"))
    right = segments.select(F.col("node").alias("b"), F.col("set_id").alias("set_b"), "part", F.col("grams").alias("y"))
    counted = (
        pairs.join(left, "a").join(right, ["b", "part"])
        .select("a", "b", "set_a", "set_b", F.size(F.array_intersect("x", "y")).cast("long").alias("common"))
        .groupBy("a", "b", "set_a", "set_b").agg(F.sum("common").alias("common"))
    )
    of = sizes.select("set_id", "n_shingles")
    both = (
        counted.join(of.toDF("set_a", "size_a"), "set_a").join(of.toDF("set_b", "size_b"), "set_b")
    )
    return both.where(100 * F.col("common") >= percent * (F.col("size_a") + F.col("size_b") - F.col("common"))).select(
        "a", "b").distinct()


def _meetings(nodes: DataFrame) -> DataFrame:
    """``(key, node)`` of every key under which at least two different nodes meet."""
    rows = nodes.select(F.explode("keys").alias("key"), F.col("doc_id").alias("node"))
    several = (
        rows.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high"))
        .where("low <> high").select("key")
    )
    return rows.join(several, "key").distinct()


def _stars(meetings: DataFrame) -> DataFrame:
    """Every node with the most central node of each of its lists."""
    size = meetings.groupBy("key").agg(F.count(F.lit(1)).alias("size"))
    central = meetings.join(size, "key").groupBy("node").agg(F.sum("size").alias("weight"))
    hubs = (
        meetings.join(central, "node").groupBy("key")
        .agg(F.max(F.struct("weight", (-F.col("node")).alias("name"))).alias("best"))
        .select("key", (-F.col("best.name")).alias("hub"))
    )
    return meetings.join(hubs, "key").where("node <> hub").select(
        F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()


def _may_link(x: str, y: str, percent: int) -> Column:
    """Whether sizes and parities of two nodes allow a link."""
    differ = F.expr(" + ".join(
        f"bit_count({x}.parities[{i}] ^ {y}.parities[{i}])" for i in range((1 << PARITY_BITS) // 64)))
    a, b = F.col(f"{x}.size"), F.col(f"{y}.size")
    return (100 * F.least(a, b) >= percent * F.greatest(a, b)) & ((100 + percent) * differ <= (100 - percent) * (a + b))


def _plausible(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sizes and parities allow a link; no other is worth shipping its n-grams."""
    known = nodes.select("doc_id", F.col("n_shingles").alias("size"), "parities")
    x, y = known.alias("x"), known.alias("y")
    joined = pairs.join(x, F.col("a") == F.col("x.doc_id")).join(y, F.col("b") == F.col("y.doc_id"))
    return joined.where(_may_link("x", "y", percent)).select("a", "b").distinct()


def _open(meetings: DataFrame, labels: DataFrame, nodes: DataFrame) -> DataFrame:
    """``(node, set_id, size, label)`` of the sets that meet one of another component."""
    marked = meetings.join(labels, "node", "left").select("key", "node", F.coalesce("component", "node").alias("label"))
    open_keys = (
        marked.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"))
        .where("low <> high").select("key")
    )
    found = marked.join(open_keys, "key").select("node", "label").distinct()
    # A row that comes twice is one set, or its n-grams would count twice.
    known = nodes.select(F.col("doc_id").alias("node"), "set_id", F.col("n_shingles").alias("size")).distinct()
    return known.join(found, "node")


def _prefixes(open_: DataFrame, segments: DataFrame, percent: int) -> DataFrame:
    """``(gram, node, label, size, place)``: the n-grams by which a link to another component must show.

    N-grams are ordered by how many sets hold them, those of one component alone before all others. Of linked
    sets each holds ``percent %`` of the other's n-grams, so the first common one stands among the first
    ``(100 - percent) %`` of both, and one more. Edits fill these places, and common text is left out.
    """
    grams = segments.join(open_, ["node", "set_id"]).select("node", "set_id", "size", "label", F.explode("grams").alias("gram"))
    held = grams.groupBy("gram").agg(
        F.count(F.lit(1)).alias("held"), (F.min("label") != F.max("label")).alias("shared"))
    order = Window.partitionBy("node", "set_id").orderBy("shared", "held", "gram")
    placed = grams.join(held, "gram").withColumn("place", F.row_number().over(order) - 1)
    return placed.where((100 * F.col("place") <= (100 - percent) * F.col("size")) & F.col("shared")).select(
        "gram", "node", "label", "size", "place")


def _rest(prefixes: DataFrame, percent: int) -> DataFrame:
    """Pairs from different components that share an n-gram of their prefixes from which on enough can be common."""
    x, y = prefixes.alias("x"), prefixes.alias("y")
    sizes = F.col("x.size"), F.col("y.size")
    left = F.least(F.col("x.size") - F.col("x.place"), F.col("y.size") - F.col("y.place"))
    enough = (100 * F.least(*sizes) >= percent * F.greatest(*sizes)) & (
        (100 + percent) * left >= percent * (F.col("x.size") + F.col("y.size")))
    apart = (F.col("x.node") < F.col("y.node")) & (F.col("x.label") != F.col("y.label"))
    return x.join(y, (F.col("x.gram") == F.col("y.gram")) & apart & enough).select(
        F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()


def link_components(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_shingles``, ``component_id``.

    Two documents link when ``100 * |intersection| >= percent * |union|`` of their distinct
    ``n``-word windows (A-Z in lower case; a text of fewer words is one window). The component is
    the smallest ``doc_id`` reachable by links. Texts that are null, empty or blank have no window
    and form a component of their own. Rows that share a ``doc_id`` are one document, and rows
    without one get a null component. Further columns of ``docs`` are ignored; no rows give none.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    described = save(rows.mapInArrow(_names(n), "doc_id long, n_shingles long, set_id binary"), "sets")
    named = described.where("doc_id is not null and set_id is not null")
    sizes = save(named.groupBy("set_id").agg(
        F.min("doc_id").alias("node"), F.first("n_shingles").alias("n_shingles")), "set_names")
    open_ = may_link(rows, named, n, percent).join(sizes.select(F.col("node").alias("doc_id")), "doc_id", "left_semi")
    rows = save(rows.join(open_, "doc_id", "left_semi"), "open_texts")
    keyed = rows.mapInArrow(
        _describe(n, percent), "doc_id long, n_shingles long, set_id binary, keys array<long>, parities array<long>")
    nodes = save(keyed.join(sizes.select(F.col("node").alias("doc_id"), "set_id"), ["doc_id", "set_id"], "left_semi"), "nodes")
    meetings = save(_meetings(nodes), "meetings")
    wanted = meetings.select(F.col("node").alias("doc_id")).distinct()
    segments = save(
        rows.join(wanted, "doc_id", "left_semi").mapInArrow(
            _segments(n), "node long, set_id binary, part int, grams array<long>")
        .dropDuplicates(["node", "set_id", "part"]), "segments")
    stars = save(_plausible(_stars(meetings), nodes, percent), "stars")
    links = save(_verified(stars, segments, sizes, percent), "links")
    labels = components(links, "a", "b")
    open_ = save(_open(meetings, labels, nodes), "open_sets")
    prefixes = save(_prefixes(open_, segments, percent), "prefixes")
    rest = save(_rest(prefixes, percent).join(stars, ["a", "b"], "left_anti"), "rest")
    # The components stand for the links they came from.
    labels = components(labels.toDF("a", "b").union(_verified(rest, segments, sizes, percent)), "a", "b")
    named_rows = (
        described.where("set_id is not null").select("doc_id", "n_shingles", "set_id")
        .join(sizes.select("set_id", "node"), "set_id", "left").join(labels, "node", "left")
    )
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "node"))
    plain = described.where("set_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return named_rows.select("doc_id", "n_shingles", component.alias("component_id")).union(plain)


def keep_one(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that are the smallest of their component, with all their columns.

    Of repeated rows of one ``doc_id`` one stays; rows without ``doc_id`` all stay.
    """
    first = link_components(docs, n, percent).where("doc_id = component_id").select("doc_id").distinct()
    kept = docs.join(first.select(F.col("doc_id").cast(docs.schema["doc_id"].dataType).alias("doc_id")), "doc_id", "left_semi")
    return kept.dropDuplicates(["doc_id"]).select(docs.columns).unionByName(docs.where("doc_id is null"))
