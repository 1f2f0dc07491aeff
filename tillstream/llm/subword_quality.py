"""Quality classifier on learned subword embeddings.

A document is the average of the vectors of its hashed features: words, character n-grams of
words, and a mark for every word that was used just before. A softmax layer turns the average into two class probabilities. Vectors and layer are
trained together by stochastic gradient descent in numpy, on a bounded sample of labelled rows;
the trained model has a fixed size. For scoring, vectors and layer fold into one number per
feature, so a text costs one lookup per word.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tillstream.llm.words import Batches, WordIds, texts, windows


@dataclass(frozen=True)
class Settings:
    """Model and training. ``sample`` bounds the labelled rows of each class that are fitted."""

    buckets: int = 1 << 15
    width: int = 8
    shortest: int = 3
    longest: int = 5
    look_back: int = 3
    sample: int = 3000
    epochs: int = 6
    rate: float = 0.5
    seed: int = 7


#: Bytes whose n-grams are hashed at once; a longer word is cut into such pieces.
PIECE = 1 << 20


def _pieces(words: list[bytes], settings: Settings) -> Iterator[tuple[list[bytes], list[int]]]:
    """The marked words in groups of bounded size, and the place of each.

    A word beyond ``PIECE`` comes alone, in pieces that overlap by ``longest - 1`` bytes.
    """
    held, places, n = [], [], 0
    for place, word in enumerate(words):
        marked = b"<" + word + b">"
        if n and n + len(marked) > PIECE:
            yield held, places
            held, places, n = [], [], 0
        if len(marked) > PIECE:
            for i in range(0, len(marked), PIECE):
                yield [marked[i : i + PIECE + settings.longest - 1]], [place]
        else:
            held.append(marked)
            places.append(place)
            n += len(marked)
    if held:
        yield held, places


def word_features(words: list[bytes], settings: Settings) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Buckets of all words and of their character n-grams, and for each the place of its word.

    They come in parts of bounded size. The words of a part are hashed at once, as one long array of
    bytes whose windows inside a word count.
    """
    yield (np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)) % np.uint64(settings.buckets)
           ).astype(np.int64), np.arange(len(words))
    for marked, places in _pieces(words, settings):
        flat = np.frombuffer(b"".join(marked), np.uint8).astype(np.uint64)
        owner = np.repeat(places, [len(m) for m in marked])
        for n in range(settings.shortest, settings.longest + 1):
            grams = windows(flat, n)
            inside = owner[: len(grams)] == owner[n - 1 :] if len(grams) else np.empty(0, bool)
            # What begins in the overlap belongs to the next piece.
            inside[PIECE if len(marked) == 1 else len(inside) :] = False
            yield ((grams[inside] + np.uint64(n)) % np.uint64(settings.buckets)).astype(np.int64), owner[: len(grams)][inside]


def again(numbers: np.ndarray, look_back: int) -> int:
    """How many words were used within the ``look_back`` words before."""
    seen = np.zeros(len(numbers), bool)
    for back in range(1, min(look_back, len(numbers) - 1) + 1):
        seen[back:] |= numbers[back:] == numbers[:-back]
    return int(seen.sum())


def again_bucket(settings: Settings) -> int:
    return xxhash.xxh3_64_intdigest(b"\x00again") % settings.buckets


def bag(text: bytes | None, settings: Settings) -> tuple[np.ndarray, np.ndarray, int]:
    """Buckets of the features of a whole text, how often each occurs, and their total, in small types."""
    words = (text or b"").split()
    if not words:
        return np.empty(0, np.uint16), np.empty(0, np.uint16), 0
    distinct, counts = zip(*Counter(words).items())
    total, times = np.zeros(settings.buckets), np.array(counts, float)
    for found, owner in word_features(list(distinct), settings):
        total += np.bincount(found, times[owner], settings.buckets)
    total[again_bucket(settings)] += again(WordIds().of(words), settings.look_back)
    used = np.flatnonzero(total)
    often = total[used].astype(np.int64)
    small = lambda x: x.astype(np.min_scalar_type(int(x.max(initial=0))))
    return small(used), small(often), int(often.sum())


def features(text: bytes | None, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the features of a whole text, and the share of each; both empty without words."""
    found, often, total = bag(text, settings)
    return found.astype(np.int64), often / max(1, total)


def train(rows: Iterable[tuple[bytes | None, int]], settings: Settings) -> tuple[np.ndarray, float]:
    """Weight of every feature bucket and the bias, for the log odds of label 1.

    Without rows of both classes every weight is 0 and the bias says the known class. Texts are read
    one by one; only their features are kept.
    """
    rng = np.random.default_rng(settings.seed)
    labels, bags = [], []
    for text, y in rows:
        labels.append(y)
        bags.append(bag(text, settings))
    if len(set(labels)) < 2:
        known = 0.0 if not labels else (4.0 if labels[0] == 1 else -4.0)
        return np.zeros(settings.buckets), known
    vectors = rng.uniform(-1, 1, (settings.buckets, settings.width)) / settings.width
    layer = np.zeros((settings.width, 2))
    bias = np.zeros(2)
    steps, done = settings.epochs * len(bags), 0
    for _ in range(settings.epochs):
        for i in rng.permutation(len(bags)):
            rate = settings.rate * (1 - done / steps)
            done += 1
            found, often, total = bags[i]
            share = often / max(1, total)
            mean = share @ vectors[found]
            z = mean @ layer + bias
            odds = np.exp(z - z.max())
            wrong = odds / odds.sum()
            wrong[labels[i]] -= 1
            back = layer @ wrong
            layer -= rate * np.outer(mean, wrong)
            bias -= rate * wrong
            # The share of a feature in its document is small; without the count its vector would not move.
            vectors[found] -= rate * np.outer(share * len(found), back)
    folded = vectors @ (layer[:, 1] - layer[:, 0])
    return folded, float(bias[1] - bias[0])


class _Sums(dict):
    """Row of each word in arrays with the weight and the number of its features."""

    LIMIT = 500_000
    LIMIT_BYTES = 1 << 26

    def __init__(self, weights: np.ndarray, settings: Settings):
        super().__init__()
        self.weights, self.settings = weights, settings
        self.sums, self.counts, self.held = np.zeros(0), np.zeros(0), 0

    def learn(self, texts_: list[list[bytes]]) -> None:
        """Make sure that all words of these texts have a row."""
        if len(self) > self.LIMIT or self.held > self.LIMIT_BYTES:
            self.clear()
            self.sums, self.counts, self.held = np.zeros(0), np.zeros(0), 0
        new = [w for w in set().union(*texts_) if w not in self]
        if new:
            sums, counts = np.zeros(len(new)), np.zeros(len(new))
            for found, owner in word_features(new, self.settings):
                low, high = (owner[0], owner[-1] + 1) if len(owner) else (0, 0)
                sums[low:high] += np.bincount(owner - low, self.weights[found], high - low)
                counts[low:high] += np.bincount(owner - low, minlength=high - low)
            self.update(zip(new, range(len(self), len(self) + len(new))))
            self.held += sum(map(len, new))
            self.sums = np.r_[self.sums, sums]
            self.counts = np.r_[self.counts, counts]


#: Words of texts that are looked up together.
CHUNK_WORDS = 300_000


def _chunks(batch: pa.RecordBatch):
    held, n = [], 0
    for text in texts(batch):
        words = (text or b"").split()
        held.append(words)
        n += len(words)
        if n >= CHUNK_WORDS:
            yield held
            held, n = [], 0
    yield held


def _scorer(weights: np.ndarray, bias: float, settings: Settings, name: str) -> Callable[[Batches], Batches]:
    mark = float(weights[again_bucket(settings)])

    def score(words: list[bytes], known: _Sums) -> float:
        rows = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        marks = again(rows, settings.look_back)
        n = known.counts[rows].sum() + marks
        z = bias + ((known.sums[rows].sum() + marks * mark) / n if n else 0.0)
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))

    def run(batches: Batches) -> Batches:
        known = _Sums(weights, settings)
        for batch in batches:
            scores = []
            for chunk in _chunks(batch):
                known.learn(chunk)
                scores += [score(words, known) for words in chunk]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.float64())], [*batch.schema.names, name])

    return run


def fold_of(doc_id: str = "doc_id") -> Column:
    """The fold of a document: CRC-32 of its id as text, modulo 5. Without an id: null."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5


def training_rows(docs: DataFrame, labels: DataFrame, settings: Settings) -> DataFrame:
    """At most ``settings.sample`` labelled texts of each class outside the held-out fold: (doc_id, text, quality).

    The first by a hash of the id are taken, so the choice is the same on each run. A document with
    both labels counts as label 0. Rows of one id are one text, the smallest, chosen in the map
    tasks, so a labelled id that is repeated any number of times is still one row.
    """
    known = (
        labels.where("doc_id is not null and quality is not null").groupBy("doc_id")
        .agg(F.min("quality").cast("int").alias("quality")).where(fold_of() != 0)
    )
    picked = [
        known.where(F.col("quality") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(settings.sample)
        for label in (0, 1)
    ]
    chosen = picked[0].union(picked[1])
    rows = docs.select("doc_id", F.col("text").cast("string").cast("binary").alias("text")).join(chosen, "doc_id")
    return rows.groupBy("doc_id", "quality").agg(F.min("text").alias("text")).select("doc_id", "text", "quality")


def _fit(rows: DataFrame, settings: Settings) -> tuple[np.ndarray, float]:
    """Train on the bounded sample in one task; only the model comes to the driver."""

    def run(batches: Batches) -> Batches:
        weights, bias = train((row for batch in batches for row in zip(
            texts(batch), batch.column("quality").to_pylist())), settings)
        yield pa.RecordBatch.from_arrays(
            [pa.array([weights.tobytes()], pa.binary()), pa.array([bias], pa.float64())], ["weights", "bias"])

    ordered = rows.repartition(1).sortWithinPartitions("doc_id").select("text", "quality")
    model = ordered.mapInArrow(run, "weights binary, bias double").first()
    return (np.frombuffer(bytes(model.weights)), model.bias) if model else train([], settings)  # no rows, no task


def with_score(docs: DataFrame, labels: DataFrame, name: str, settings: Settings = Settings()) -> DataFrame:
    """``docs`` with the probability of label 1 as a further column ``name``, which must be new."""
    weights, bias = _fit(training_rows(docs, labels, settings), settings)
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])
    return docs.mapInArrow(_scorer(weights, bias, settings, name), schema)


def score(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), threshold: float = 0.3) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``held_out``, ``score``, ``predicted``.

    ``score`` is the probability of label 1 from the whole text alone; null, empty and blank texts
    get the score of no features. ``predicted`` is 1 from ``threshold`` on. ``held_out`` is true for
    documents whose fold is 0, whose labels are never used; a null ``doc_id`` is not held out. No
    labels at all give everyone 0.5. Further columns of ``docs`` and ``labels`` are ignored.
    """
    plain = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return with_score(plain, labels, "score", settings).select(
        "doc_id", F.coalesce(fold_of() == 0, F.lit(False)).alias("held_out"), "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` whose score reaches ``threshold``, with all their columns."""
    name = "score"
    while name in docs.columns:
        name = f"_{name}"
    return with_score(docs, labels, name, settings).where(F.col(name) >= threshold).drop(name)
