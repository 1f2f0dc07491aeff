"""Benchmark passages in documents by SimHash of item-sized windows. DataFrame functions only.

Texts become lower-case words of letters and digits, and every run of ``n`` words a 64-bit shingle.
A window has as many words as a benchmark item. The fingerprint is the majority of each bit over the
shingles, counted with repeats; shingles that no item holds carry no weight there. Fingerprints are cut
into blocks, and by the pigeonhole principle two of them within the radius agree in some block up to
``radius // BLOCKS`` bits. An item is therefore listed under every value that near each of its blocks,
a window under its own block values, and both meet by size, block and value: all pairs within the radius,
none of the others once the distance has been taken. A bit of an item whose majority is larger than
all that a similar window can lack or have besides is firm, and a window that differs in a firm bit
goes; this loses no pair. What is left is verified by the exact weighted similarity: sum of the
smaller over sum of the larger shingle counts.

A window can only reach the similarity if enough of its shingles occur in some item. Positions
without such a shingle are left out before any window is built, which loses nothing and leaves a
handful of windows per passage. Only the items' shingle hashes are broadcast, and only after they
have been counted; beyond ``BROADCAST_SHINGLES`` the positions are shuffled to them instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillstream.llm.scratch import save

BROADCAST_SHINGLES = 2_000_000
BITS = 64
BLOCKS = 5
#: Windows of similarity 0.8 differ in about 10 bits, with a spread of some 3.
RADIUS = 19
WORD_BREAK = r"[^\p{L}\p{N}]+"


def _shingles(words: str, n: int) -> Column:
    """Shingle hashes by position; fewer than ``n`` words are one shingle, no words none."""
    return F.expr(
        f"case when size({words}) >= {n} then "
        f"transform(sequence(1, size({words}) - {n - 1}), i -> xxhash64(slice({words}, i, {n}))) "
        f"when size({words}) > 0 then array(xxhash64({words})) end")


def _words(text: str) -> Column:
    return F.array_remove(F.split(F.lower(F.col(text).cast("string")), WORD_BREAK), "")


def _fingerprint(rows: DataFrame, keys: list[str], margin: str | None = None) -> DataFrame:
    """SimHash of the shingles ``h`` of each group. Two bit counts travel in one number.

    With ``margin``, an expression over keys and ``weight``, also the mask ``firm`` of the bits whose
    majority is larger than that.
    """
    half = BITS // 2
    counts = [
        F.sum(F.expr(f"shiftrightunsigned(h, {i}) & 4294967297L")).alias(f"c{i}") for i in range(half)
    ]
    grouped = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("weight"), *counts)
    ones = [f"(c{i} & 4294967295L)" for i in range(half)] + [f"shiftrightunsigned(c{i}, {half})" for i in range(half)]

    def mask(test: str) -> Column:
        return F.expr(" | ".join(f"if({test.format(c)}, shiftleft(1L, {i}), 0L)" for i, c in enumerate(ones)))

    out = [mask("2 * {} > weight").alias("print")]
    if margin is not None:
        out.append(mask(f"abs(2 * {{}} - weight) > {margin}").alias("firm"))
    return grouped.select(*keys, *out)


def _blocks() -> list[tuple[int, int]]:
    """(shift, width) of the blocks of a fingerprint."""
    edges = [BITS * k // BLOCKS for k in range(BLOCKS + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _block_values(name: str, flips: int = 0) -> Column:
    """``array<struct<block, value>>``: each block of a fingerprint with up to ``flips`` bits changed."""
    parts = []
    for block, (shift, width) in enumerate(_blocks()):
        mine = f"(shiftrightunsigned({name}, {shift}) & {(1 << width) - 1}L)"
        masks = f"filter(sequence(0L, {(1 << width) - 1}L), m -> bit_count(m) <= {flips})" if flips else "array(0L)"
        parts.append(f"transform({masks}, m -> named_struct('block', {block}, 'value', {mine} ^ m))")
    return F.expr(f"concat({', '.join(parts)})")


def _near(prints: DataFrame, item_prints: DataFrame, radius: int) -> DataFrame:
    """``(item_size, print, item_id)`` of all fingerprints within the radius that agree in the firm bits.

    Equal fingerprints of windows, as copies of one passage have, are one row here.
    """
    windows = prints.select("item_size", "print").distinct().select("item_size", "print", F.inline(_block_values("print")))
    items = item_prints.select("item_id", "item_size", "item_print", "firm", F.inline(_block_values("item_print", radius // BLOCKS)))
    apart = F.col("print").bitwiseXOR(F.col("item_print"))
    return (
        windows.join(items, ["item_size", "block", "value"])
        .where((F.bit_count(apart) <= radius) & (apart.bitwiseAND(F.col("firm")) == 0))
        .select("item_size", "print", "item_id").distinct()
    )


def _windows(hits: DataFrame, sizes: list[int], n: int, similarity: float) -> DataFrame:
    """Windows of each item size in which enough positions hold a known shingle, with these as ``grams``.

    ``known`` are a document's known positions with their shingles, in order; a window is found from
    its first known position, and may start as many positions before it as may be unknown.
    """
    rows = hits.withColumn("item_size", F.explode(F.array(*[F.lit(s) for s in sizes]))).withColumns({
        "total": F.greatest(F.lit(1), F.col("n_words") - (n - 1)),
        "item_span": F.greatest(F.lit(1), F.col("item_size") - (n - 1)),
    }).withColumn("span", F.least("total", "item_span")).withColumn(
        "need", F.expr(f"cast(ceil({similarity} * (span + item_span) / {1 + similarity} - 1e-9) as int)"))
    # Only the positions that a window can reach travel with it, however many the document has.
    firsts = rows.where("need <= size(at)").select("doc_id", "copy", "item_size", "total", "span", F.inline(F.expr("""
        transform(filter(sequence(0, size(at) - need), j -> at[j + need - 1] - at[j] < span), j -> named_struct(
            'first', at[j], 'enough', at[j + need - 1], 'prior', if(j > 0, at[greatest(j - 1, 0)], -1),
            'ahead', slice(known, j + 1, span)))""")))
    least_back = F.expr("greatest(0, first - (total - span))")
    most_back = F.expr("least(first, span - 1 - (enough - first), first - prior - 1)")
    placed = firsts.where(least_back <= most_back).withColumn("back", F.explode(F.sequence(least_back, most_back)))
    return placed.withColumn("start", F.col("first") - F.col("back")).select("doc_id", "copy", "item_size", "span", "start", F.expr(
        "transform(filter(ahead, x -> x.pos < start + span), x -> x.h)").alias("grams"))


def leaks(docs: DataFrame, items: DataFrame, n: int = 5, similarity: float = 0.8,
          radius: int = RADIUS) -> DataFrame:
    """``(doc_id, item_id, start_word, item_words, similarity)``: the best window per document and item.

    Pairs have a weighted shingle similarity of ``similarity`` or more and fingerprints that differ in
    ``radius`` bits at most; all such pairs are given. In a document shorter than an
    item the whole document is the window. Of equally similar windows the first counts. Texts that
    are null, empty or without letters and digits hold nothing and match nothing, and rows without
    ``doc_id`` or ``item_id`` are left out. Repeated rows count once; different texts under one
    ``doc_id`` are searched one by one. Further columns are ignored; no items give no rows.
    """
    bench = items.where("item_id is not null").select("item_id", _words("text").alias("w")).where("size(w) > 0")
    bench = save(bench.select("item_id", F.size("w").alias("item_size"), _shingles("w", n).alias("s")).distinct(), "items")
    sizes = sorted(r[0] for r in bench.select("item_size").distinct().collect())
    grams = bench.select("item_id", "item_size", F.explode("s").alias("h")).withColumn(
        "item_span", F.greatest(F.lit(1), F.col("item_size") - (n - 1)))
    known = grams.select("h").distinct()
    if known.count() <= BROADCAST_SHINGLES:
        known = F.broadcast(known)
    texts = docs.where("doc_id is not null").select(
        "doc_id", F.xxhash64(F.col("text").cast("string")).alias("copy"), _words("text").alias("w"))
    hits = (
        texts.select("doc_id", "copy", F.size("w").alias("n_words"), F.posexplode(_shingles("w", n)).alias("pos", "h"))
        .join(known, "h").groupBy("doc_id", "copy", "n_words")
        .agg(F.array_sort(F.collect_set(F.struct("pos", "h"))).alias("known"))
        .withColumn("at", F.col("known.pos"))
    )
    keys = ["doc_id", "copy", "item_size", "span", "start"]
    windows = save(_windows(hits, sizes, n, similarity), "windows") if sizes else None
    if windows is None:
        return docs.sparkSession.createDataFrame(
            [], f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, "
                f"item_id {items.schema['item_id'].dataType.simpleString()}, "
                "start_word int, item_words int, similarity double")
    prints = save(_fingerprint(windows.select(*keys, F.explode("grams").alias("h")), keys), "prints")
    whole = grams.select("item_id", "item_size", "item_span").distinct().join(grams.select("item_id", "h"), "item_id")
    # What a similar window of the item's size lacks of the item and has besides, at most.
    item_prints = _fingerprint(
        whole, ["item_id", "item_size", "item_span"],
        f"weight + item_span - {4 * similarity / (1 + similarity)} * item_span + 1e-9",
    ).select("item_id", "item_size", F.col("print").alias("item_print"), "firm")
    met = prints.join(_near(prints, item_prints, radius), ["item_size", "print"]).select(*keys, "item_id")
    mine = (
        met.join(windows.select(*keys, "grams"), keys)
        .select(*keys, "item_id", F.explode("grams").alias("h"))
        .groupBy(*keys, "item_id", "h").agg(F.count(F.lit(1)).alias("here"))
    )
    theirs = grams.groupBy("item_id", "h").agg(F.count(F.lit(1)).alias("there"))
    both = (
        mine.join(theirs, ["item_id", "h"]).groupBy(*keys, "item_id")
        .agg(F.sum(F.least("here", "there")).alias("common"))
        .withColumn("item_span", F.greatest(F.lit(1), F.col("item_size") - (n - 1)))
        .withColumn("similarity", F.expr("common / (span + item_span - common)"))
        .where(F.col("similarity") >= similarity)
    )
    best = both.groupBy("doc_id", "item_id").agg(F.max(F.struct(
        "similarity", (-F.col("start")).alias("back"), "item_size")).alias("best"))
    return best.select(
        "doc_id", "item_id", (-F.col("best.back")).cast("int").alias("start_word"),
        F.col("best.item_size").cast("int").alias("item_words"), "best.similarity")
