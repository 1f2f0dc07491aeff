"""Line labels by a linear-chain conditional random field, and quality rules on top.

Each line of a text is content or boilerplate. A chain over the lines scores each label by the
line's features and each pair of neighbouring labels; Viterbi decoding gives the best labelling of
all lines together. The share of a document's words that lies in content lines decides whether it
is kept.

The features are the line's shape and its spread: lines that stand in many texts beside other lines
in each are marked, which Spark counts over all documents. Lines of copies keep their neighbours and
are not.

Line labels are hidden in training, only documents are labelled. Each round (expectation
maximisation over a bounded sample) takes the model's own line probabilities, moved just as far as
is needed for good documents to have a large share of content and for poor ones to have a small
one, and fits the chain to them. So the lines of one document may differ.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tillstream.llm.scratch import save
from tillstream.llm.subword_quality import Settings as _Sampling, training_rows
from tillstream.llm.words import Batches, WordIds, lists, signed, texts, windows

SYMBOLS = "#*$%&|<>"
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
N_SHAPES = 9
#: Shapes and spread.
N_FEATURES = N_SHAPES + 1
BOILERPLATE, CONTENT = 0, 1


@dataclass(frozen=True)
class Settings:
    """Training and decision. ``sample`` bounds the labelled documents of each class.

    Good documents are taken to have a content share of ``good_share`` or more, poor ones of
    ``poor_share`` or less. ``doubt`` is what a full spread takes from a line's log odds of being
    content. A line beside ``wide`` different lines has a full spread.
    """

    sample: int = 1500
    rounds: int = 6
    steps: int = 20
    rate: float = 0.2
    decay: float = 1e-3
    good_share: float = 0.8
    poor_share: float = 0.3
    doubt: float = 4.0
    wide: int = 64
    least_share: float = 0.5


def line_features(lines: list[str], ids: WordIds) -> np.ndarray:
    """One row per line: bias, length, and shares of symbols, capitals, digits, repeats and marks."""
    seen: set[str] = set()
    out = np.zeros((len(lines), N_SHAPES), np.float32)
    for i, line in enumerate(lines):
        words = line.encode().split()
        n, chars = len(words), max(1, len(line))
        numbers = ids.of(words)
        neighbours = np.mean(numbers[1:] == numbers[:-1]) if n > 1 else 0.0
        letters = sum(map(str.isupper, line)) / chars
        out[i] = (
            1.0, min(1.0, np.log1p(n) / 5), min(1.0, 4 * sum(map(line.count, SYMBOLS)) / chars), letters,
            sum(map(line.count, "0123456789")) / chars, neighbours, 1 - len(set(words)) / n if n else 0.0,
            float(n > 0 and line in seen), line.count("!") / max(1, n))
        seen.add(line)
    return out


def viterbi(scores: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Best label of every line; of equal labellings the one with content later on."""
    best, back = scores[0], np.zeros(scores.shape, np.int8)
    for i in range(1, len(scores)):
        via = best[:, None] + moves
        back[i] = via.argmax(0)
        best = via.max(0) + scores[i]
    labels = np.zeros(len(scores), np.int8)
    labels[-1] = best[1] >= best[0]
    for i in range(len(scores) - 1, 0, -1):
        labels[i - 1] = back[i, labels[i]]
    return labels


class Chains:
    """Chains of lines side by side, longest first, so that step ``t`` is one array of all chains that reach it."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths
        self.starts = np.cumsum(lengths) - lengths
        self.active = np.searchsorted(-lengths, -np.arange(lengths.max()), "left")

    def per_line(self, values: np.ndarray) -> np.ndarray:
        return np.repeat(values, self.lengths)

    def total(self, values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values, self.starts)

    def expect(self, scores: np.ndarray, moves: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probability of each label of each line, and expected pairs of labels, weighted by chain."""
        ahead, behind = scores.copy(), np.zeros_like(scores)
        for t in range(1, len(self.active)):
            here = self.starts[: self.active[t]] + t
            last = ahead[here - 1]
            for y in (0, 1):
                ahead[here, y] += np.logaddexp(last[:, 0] + moves[0, y], last[:, 1] + moves[1, y])
        for t in range(len(self.active) - 1, 0, -1):
            here = self.starts[: self.active[t]] + t
            after = scores[here] + behind[here]
            for y in (0, 1):
                behind[here - 1, y] = np.logaddexp(moves[y, 0] + after[:, 0], moves[y, 1] + after[:, 1])
        ends = ahead[self.starts + self.lengths - 1]
        total = self.per_line(np.logaddexp(ends[:, 0], ends[:, 1]))
        later = np.ones(len(scores), bool)
        later[self.starts] = False
        here = np.flatnonzero(later)
        after = scores[here] + behind[here] - total[here, None]
        share = self.per_line(weight)[here]
        pairs = np.array([[np.dot(share, np.exp(ahead[here - 1, a] + moves[a, b] + after[:, b])) for b in (0, 1)]
                          for a in (0, 1)])
        return np.exp(ahead + behind - total[:, None]), pairs


def marginals(scores: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability of each label of each line of one chain, and expected number of each pair of labels."""
    return Chains(np.array([len(scores)])).expect(scores, moves, np.ones(1))


#: Steps by which the push of a document is halved in, and the furthest push.
HALVINGS, FURTHEST = 10, 30.0


def expected_labels(chains: Chains, scores, moves, sizes, good, weight, settings: Settings):
    """Line probabilities nearest to the model's that give each document the share its label asks for."""
    words = np.where(chains.per_line(chains.total(sizes)) > 0, sizes, 1.0)
    share = words / chains.per_line(chains.total(words))
    pull = share * chains.per_line(chains.lengths)  # 1 for a line of middling size
    sign = np.where(good, 1.0, -1.0)

    def pushed(by: np.ndarray):
        moved = scores.copy()
        moved[:, CONTENT] += chains.per_line(by * sign) * pull
        single, pairs = chains.expect(moved, moves, weight)
        content = chains.total(share * single[:, CONTENT])
        return single, pairs, np.where(good, content >= settings.good_share, content <= settings.poor_share)

    low, high = np.zeros(len(good)), np.full(len(good), FURTHEST)
    single, pairs, met = pushed(low)
    if met.all():
        return single, pairs
    high[met] = 0.0
    for _ in range(HALVINGS):
        middle = (low + high) / 2
        _, _, enough = pushed(middle)
        low, high = np.where(enough, low, middle), np.where(enough, middle, high)
    single, pairs, _ = pushed(high)
    return single, pairs


def _climb(gradient, at: np.ndarray, steps: int, rate: float) -> np.ndarray:
    """Gradient ascent with a step size per weight (Adam)."""
    mean, square = np.zeros_like(at), np.zeros_like(at)
    for t in range(1, steps + 1):
        g = gradient(at)
        mean, square = 0.9 * mean + 0.1 * g, 0.99 * square + 0.01 * g * g
        at = at + rate * (mean / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.99**t)) + 1e-8)
    return at


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the features by label, and of the pairs of labels, from (features, words by line, label).

    Without rows of both labels every line is content.
    """
    weights, moves = np.zeros((N_FEATURES, 2)), np.zeros((2, 2))
    if len({y for _, _, y in rows}) < 2:
        weights[0, CONTENT] = 1.0
        return weights, moves
    rows = sorted(rows, key=lambda r: -len(r[0]))
    x = np.concatenate([r[0] for r in rows]).astype(float)
    sizes = np.concatenate([r[1] for r in rows]).astype(float)
    good = np.array([r[2] == 1 for r in rows])
    chains = Chains(np.array([len(r[0]) for r in rows]))
    weight = 1 / chains.lengths / len(rows)
    of_line = chains.per_line(weight)
    doubt = settings.doubt * x[:, -1]

    # The start: every line as its document, less what its spread says.
    first = 1 / (1 + np.exp(doubt - np.where(chains.per_line(good), 2.0, -2.0)))
    u = _climb(lambda u: x.T @ (of_line * (first - 1 / (1 + np.exp(-x @ u)))) - settings.decay * u,
               np.zeros(N_FEATURES), 10 * settings.steps, settings.rate)
    at = np.r_[u, np.zeros(4)]

    def scored(at: np.ndarray):
        weights = np.zeros((N_FEATURES, 2))
        weights[:, CONTENT] = at[:N_FEATURES]
        return x @ weights, at[N_FEATURES:].reshape(2, 2)

    for _ in range(settings.rounds):
        scores, moves = scored(at)
        scores[:, CONTENT] -= doubt
        wanted, wanted_pairs = expected_labels(chains, scores, moves, sizes, good, weight, settings)

        def gradient(at: np.ndarray) -> np.ndarray:
            single, pairs = chains.expect(*scored(at), weight)
            up = x.T @ (of_line * (wanted[:, CONTENT] - single[:, CONTENT]))
            return np.r_[up, (wanted_pairs - pairs).ravel()] - settings.decay * at

        at = _climb(gradient, at, settings.steps, settings.rate / 2)
    weights[:, CONTENT] = at[:N_FEATURES]
    return weights, at[N_FEATURES:].reshape(2, 2)


def repeated_words(ids: np.ndarray, n: int = 3) -> int:
    """Words inside ``n``-word windows that the text holds twice or more."""
    grams = windows(ids, n)
    if not len(grams):
        return 0
    _, group, counts = np.unique(grams, return_inverse=True, return_counts=True)
    edge = np.zeros(len(ids) + 1, np.int64)
    starts = np.flatnonzero(counts[group] > 1)
    edge[starts] += 1
    np.subtract.at(edge, starts + n, 1)
    return int((np.cumsum(edge) > 0).sum())


def line_keys(lines: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Number of every line (0 if blank); of each different one, its number and those of the lines around it.

    Blank lines are passed over. Beside the first and the last line there is one line only, which counts
    for both sides; an only line stands beside 0.
    """
    keys = np.array([xxhash.xxh3_64_intdigest(s.encode()) | 1 if (s := line.strip(BLANKS)) else 0 for line in lines],
                    np.uint64)
    full = keys[keys > 0]
    around = np.r_[full[1:2], full, full[-2:-1]] if len(full) > 1 else np.zeros(len(full) + 2, np.uint64)
    _, at = np.unique(full, return_index=True)
    return keys, full[at], around[at], around[at + 2]


_COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean"
_LINES = "text_key binary, shapes binary, sizes array<int>, lines array<long>, key array<long>, before array<long>, after array<long>"


def _measure(batches: Batches) -> Batches:
    ids = WordIds()
    for batch in batches:
        counts, marks, shapes, sizes, numbered = [], [], [], [], []
        for raw in texts(batch):
            raw = raw or b""
            text = raw.decode("utf-8", "replace")
            lines = text.split("\n")
            numbers = ids.of(raw.split())
            n = len(numbers)
            repeats = repeated_words(numbers)
            seen: set[str] = set()
            duplicates = 0
            for line in lines:
                duplicates += line in seen and bool(line.strip(BLANKS))
                seen.add(line)
            counts.append((n, len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)), duplicates,
                           repeats, n < 50 or 100 * repeats > 50 * n))
            marks.append(xxhash.xxh3_128_digest(raw))
            shapes.append(line_features(lines, ids).tobytes())
            sizes.append(np.array([len(line.encode().split()) for line in lines], np.int32))
            numbered.append(line_keys(lines))
        columns = list(zip(*counts)) if counts else [[]] * 6
        arrays = [pa.array(c, k) for c, k in zip(columns, [pa.int64()] * 5 + [pa.bool_()])]
        arrays += [pa.array(marks, pa.binary()), pa.array(shapes, pa.binary()), lists(sizes, pa.int32())]
        arrays += [lists([signed(r[i]) for r in numbered]) for i in range(4)]
        names = [f.split()[0] for f in f"{_COUNTS}, {_LINES}".split(", ")]
        others = [i for i, name in enumerate(batch.schema.names) if name != "text"]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(i) for i in others], *arrays], [*[batch.schema.names[i] for i in others], *names])


def measured(docs: DataFrame) -> DataFrame:
    """Counts of every text and, for each line, its shape, words and number; all other columns are kept."""
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text")
    return docs.mapInArrow(_measure, f"{kept}, {_COUNTS}, {_LINES}")


def spread_lines(rows: DataFrame, wide: int) -> DataFrame:
    """Lines that stand beside different lines in different texts: (text_key, spread), spread a list of (key, spread).

    The spread of a line is the logarithm of the number of different lines next to it (the lesser of
    both sides), 1 at ``wide``, times their share in the number of texts. Equal texts count once.
    """
    spots = rows.dropDuplicates(["text_key"]).select("text_key", F.inline(F.arrays_zip("key", "before", "after")))
    sides = spots.select("key", F.expr("stack(2, 0, before, 1, after) as (side, other)"))
    beside = sides.groupBy("key", "side", "other").agg(F.count(F.lit(1)).alias("texts"))
    least = F.least("lines_before", "lines_after")
    spread = (
        beside.groupBy("key").agg(
            F.sum(1 - F.col("side")).alias("lines_before"), F.sum("side").alias("lines_after"),
            F.sum(F.expr("if(side = 0, texts, 0)")).alias("texts"))
        .where(least > 1)
        .select("key", (F.least(F.lit(1.0), F.log2(least) / float(np.log2(wide))) * least / F.col("texts")).alias("spread"))
    )
    return (
        spots.select("text_key", "key").join(spread, "key").groupBy("text_key")
        .agg(F.collect_list(F.struct("key", "spread")).alias("spread"))
    )


def _with_spread(batch: pa.RecordBatch) -> list[np.ndarray]:
    """The features of the lines of each row: shapes and spread."""
    out = []
    for shapes, lines, spread in zip(*(batch.column(c).to_pylist() for c in ("shapes", "lines", "spread"))):
        known = {s["key"]: s["spread"] for s in spread or ()}
        shape = np.frombuffer(shapes, np.float32).reshape(len(lines), N_SHAPES)
        out.append(np.column_stack([shape, [known.get(line, 0.0) for line in lines]]))
    return out


def _fit(sample: DataFrame, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Train on the bounded sample in one task; only the weights come to the driver."""

    def run(batches: Batches) -> Batches:
        rows = [row for batch in batches for row in zip(
            _with_spread(batch), batch.column("sizes").to_pylist(), batch.column("quality").to_pylist())]
        model = train(rows, settings)
        yield pa.RecordBatch.from_arrays([pa.array([w.tobytes()], pa.binary()) for w in model], ["weights", "moves"])

    ordered = sample.repartition(1).sortWithinPartitions("doc_id").select("shapes", "lines", "spread", "sizes", "quality")
    model = ordered.mapInArrow(run, "weights binary, moves binary").first()
    if model is None:  # no rows, no task
        return train([], settings)
    return np.frombuffer(bytes(model.weights)).reshape(-1, 2), np.frombuffer(bytes(model.moves)).reshape(2, 2)


def _rules(weights: np.ndarray, moves: np.ndarray, settings: Settings):
    def run(batches: Batches) -> Batches:
        for batch in batches:
            rows = []
            for x, sizes, n, failed in zip(
                    _with_spread(batch), *(batch.column(c).to_pylist() for c in ("sizes", "n_words", "base_failed"))):
                labels = viterbi(x @ weights, moves)
                share = float(np.array(sizes)[labels == CONTENT].sum() / n) if n else 0.0
                rows.append((not failed and share >= settings.least_share, share, "".join("BC"[k] for k in labels)))
            columns = list(zip(*rows)) if rows else [[]] * 3
            names = ["doc_id", *[f.split()[0] for f in _COUNTS.split(", ")]]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in names],
                 *[pa.array(c, k) for c, k in zip(columns, [pa.bool_(), pa.float64(), pa.string()])]],
                [*names, "kept", "content_share", "line_labels"])

    return run


def judge(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per row of ``docs`` with its counts, ``base_failed``, ``kept``, ``content_share`` and
    ``line_labels``, one letter per line (C content, B boilerplate).

    A document of fewer than 50 words, or half of whose words lie in repeated 3-word windows, fails;
    any other is kept if at least ``least_share`` of its words lie in content lines. Null, empty and
    blank texts have no words and fail. Without labels of both kinds every line is content. Labels of
    held-out documents are not learned from. Further columns are ignored.

    What is kept of the lines (not the texts) is written once to the shared folder, as are the lines
    with a spread.
    """
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    rows = save(measured(docs), "lines")
    spread = save(spread_lines(rows, settings.wide), "spread")
    sample = measured(training_rows(docs, labels, _Sampling(sample=settings.sample)))
    weights, moves = _fit(sample.join(spread, "text_key", "left"), settings)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.drop("key", "before", "after").join(spread, "text_key", "left").drop("text_key").mapInArrow(
        _rules(weights, moves, settings),
        f"doc_id {kind}, {_COUNTS}, kept boolean, content_share double, line_labels string")
