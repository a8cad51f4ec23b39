"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained in numpy.

A word is a run of bytes that are no ASCII white space or punctuation, A-Z lowered, between
two boundary marks. Its vector is the mean of its hashed byte n-grams' embeddings (three to
six bytes), so a misspelling that was never seen shares most of its parts with the word it
stands for. The words of a segment of eight are averaged and classified by a linear softmax;
a text is as toxic as its most toxic segment, since a few words decide. Embeddings and
softmax are trained jointly on the labels of whole texts: first on the average of all
segments, then on each text's highest one.

Fitting is one task and uses at most ``SAMPLE`` labelled rows of either class (those with the smallest hash
of their id); everything else reads all rows. Two thirds of the sample train, the rest set
the scale of the scores. If the labelled rows hold only one class, that class is the score of
every text.

Nulls and texts without words score as the softmax scores no evidence, never above 0.5. A
row without a label, or with a null label or id, is only scored. Extra columns stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rookery.llm.batches import freeing, mix, slices, small_batches, text_bytes

SAMPLE = 3000  # labelled rows of each class that a fit may use
BUCKETS = 1 << 17
DIM = 8
SEGMENT = 8
SIZES = (3, 4, 5, 6)
ROUNDS, WARM = 60, 20
RATE = 1.0
THRESHOLD = 0.7

_CODE = np.full(256, 1, np.uint8)  # 1 marks a boundary
_CODE[[*range(ord("0"), ord("9") + 1), *range(ord("a"), ord("z") + 1), *range(128, 256)]] = [
    *range(ord("0"), ord("9") + 1),
    *range(ord("a"), ord("z") + 1),
    *range(128, 256),
]
_CODE[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)


@dataclass
class Bags:
    """Words of a slice: where their grams are, and each text's first word."""

    codes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray


def words_of(texts: pa.Array) -> Bags:
    """Words with a boundary mark before and behind every text's bytes."""
    data, offsets = text_bytes(texts)
    shift = np.arange(len(offsets) - 1) + 1
    codes = np.ones(len(data) + len(offsets), np.uint8)
    codes[np.arange(len(data)) + np.repeat(shift, np.diff(offsets))] = _CODE[data]
    inside = codes != 1
    starts = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
    ends = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
    bounds = offsets + np.arange(len(offsets))
    return Bags(codes, starts, ends, np.searchsorted(starts, bounds))


def _grams(codes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For each size, the bucket of the gram that starts at every byte."""
    rolled = np.zeros(len(codes), np.uint64)
    for size in range(1, SIZES[-1] + 1):
        rolled = rolled[: max(0, len(codes) - size + 1)] * np.uint64(0x100000001B3)
        rolled += codes[size - 1 : size - 1 + len(rolled)]
        if size in SIZES:
            yield size, (mix(rolled) >> np.uint64(40)).astype(np.int64) & (BUCKETS - 1)


def _gram_counts(bags: Bags) -> np.ndarray:
    lengths = bags.ends - bags.starts + 2
    return sum(np.maximum(lengths - size + 1, 0) for size in SIZES)


def word_scores(bags: Bags, weights: np.ndarray) -> np.ndarray:
    """The mean weight of every word's grams."""
    total = np.zeros(len(bags.starts))
    for size, grams in _grams(bags.codes):
        sums = np.concatenate([[0.0], np.cumsum(weights[grams], dtype=np.float64)])
        last = np.minimum(np.maximum(bags.ends + 2 - size, bags.starts - 1), len(sums) - 1)
        total += sums[last] - sums[np.minimum(bags.starts - 1, last)]
    return total / np.maximum(_gram_counts(bags), 1)


def _segments(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First word of every segment (one more at the end), first segment of every text."""
    counts = -(-np.diff(first) // SEGMENT)
    bounds = np.concatenate([[0], np.cumsum(counts)])
    place = np.arange(bounds[-1]) - np.repeat(bounds[:-1], counts)
    starts = np.repeat(first[:-1], counts) + place * SEGMENT
    return np.append(starts, first[-1]), bounds


def segment_means(scores: np.ndarray, starts: np.ndarray) -> np.ndarray:
    if len(starts) < 2:
        return np.zeros(0)
    return np.add.reduceat(scores, starts[:-1]) / np.diff(starts)


@dataclass
class Model:
    """A weight per bucket (embedding times softmax difference), a bias and a scale."""

    weights: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def probability(self, logits: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * logits + self.shift, -30, 30)))

    def logits(self, texts: pa.Array) -> np.ndarray:
        bags = words_of(texts)
        starts, bounds = _segments(bags.first)
        means = segment_means(word_scores(bags, self.weights), starts)
        out = np.full(len(bounds) - 1, self.bias)
        full = np.flatnonzero(np.diff(bounds))
        if len(full):
            out[full] += np.maximum.reduceat(means, bounds[:-1][full])
        return out


def fit(
    texts: pa.Array | list[str],
    labels: np.ndarray,
    totals: tuple[int, int] | None = None,
    seed: int = 4,
) -> Model:
    """Train on whole texts; two thirds learn, one third sets the scale.

    ``totals`` are the classes' sizes where the texts were drawn, so that the scale fits the
    classes' true shares. Of one class only, or without any row, every text gets its label, or
    0.
    """
    labels = np.asarray(labels, np.float64)
    if not isinstance(texts, pa.Array):
        texts = pa.array(texts, pa.string())
    if len(np.unique(labels)) < 2:
        certain = 30.0 if len(labels) and labels[0] == 1 else -30.0
        return Model(np.zeros(BUCKETS, np.float32), certain)
    rng = np.random.default_rng(seed)
    learns = rng.random(len(labels)) < 2 / 3
    if len(set(labels[learns])) < 2 or len(set(labels[~learns])) < 2:
        learns[:] = True
    model = _train(texts.filter(pa.array(learns)), labels[learns], rng)
    rest = ~learns if not learns.all() else learns
    held = texts.filter(pa.array(rest))
    logits = np.concatenate(
        [model.logits(held.slice(i, 64)) for i in range(0, len(held), 64)]
    )
    model.slope, model.shift = _scale(logits, labels[rest], totals)
    empty = model.slope * model.bias + model.shift
    model.shift -= max(0.0, empty)
    return model


def _scale(
    logits: np.ndarray, labels: np.ndarray, totals: tuple[int, int] | None
) -> tuple[float, float]:
    """Logistic regression of the labels on the logits, targets smoothed."""
    ones = labels.sum()
    weight = np.ones(len(labels))
    if totals:
        weight = np.where(labels == 1, totals[1] / ones, totals[0] / (len(labels) - ones))
        weight /= weight.mean()
    goals = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (len(labels) - ones + 2))
    slope, shift = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * logits + shift, -30, 30)))
        w = weight * np.maximum(p * (1 - p), 1e-9)
        pull = weight * (goals - p)
        hessian = np.array([[w @ logits**2 + 1e-3, w @ logits], [w @ logits, w.sum() + 1e-3]])
        step = np.linalg.solve(hessian, [pull @ logits, pull.sum()])
        slope, shift = slope + np.clip(step[0], -1, 1), shift + np.clip(step[1], -2, 2)
    return max(float(slope), 1e-3), float(shift)


def _word_keys(bags: Bags) -> np.ndarray:
    """A 64-bit hash of every word."""
    base, inverse = 0x9E3779B97F4A7C17, pow(0x9E3779B97F4A7C17, -1, 2**64)
    power = np.full(len(bags.codes), np.uint64(base))
    np.multiply.accumulate(power, out=power)
    sums = np.zeros(len(bags.codes) + 1, np.uint64)
    np.cumsum(mix(bags.codes.astype(np.uint64)) * power, out=sums[1:])
    power[:] = np.uint64(inverse)
    np.multiply.accumulate(power, out=power)
    return (sums[bags.ends] - sums[bags.starts]) * power[bags.starts]


def _lexicon(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Every word's number, each text's first word, and the grams of the distinct words.

    Texts are worked on a few at a time; the grams come as pairs (word number, bucket).
    """
    keys, first, known = [], [np.zeros(1, np.int64)], np.zeros(0, np.uint64)
    owners, buckets = [], []
    for begin in range(0, len(texts), 32):
        bags = words_of(texts.slice(begin, 32))
        own = _word_keys(bags)
        keys.append(own)
        first.append(bags.first[1:] + first[-1][-1])
        distinct, sample = np.unique(own, return_index=True)
        fresh = ~np.isin(distinct, known)
        distinct, sample = distinct[fresh], sample[fresh]
        starts, ends = bags.starts[sample], bags.ends[sample]
        for size, grams in _grams(bags.codes):
            counts = np.maximum(ends - starts + 3 - size, 0)
            owner = np.repeat(np.arange(len(sample)), counts)
            place = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            owners.append((owner + len(known)).astype(np.int32))
            buckets.append(grams[starts[owner] - 1 + place].astype(np.int32))
        known = np.concatenate([known, distinct])
    order = np.argsort(known).astype(np.int32)
    ranked = known[order]
    word = np.concatenate([order[np.searchsorted(ranked, own)] for own in keys])
    return word, np.concatenate(first), np.concatenate(owners), np.concatenate(buckets)


def _train(texts: pa.Array, labels: np.ndarray, rng: np.random.Generator) -> Model:
    word, first, rows, buckets = _lexicon(texts)
    count = int(word.max(initial=-1)) + 1
    share = 1.0 / np.maximum(np.bincount(rows, minlength=count), 1)

    segments, bounds = _segments(first)
    owner = np.repeat(np.arange(len(segments) - 1, dtype=np.int32), np.diff(segments))
    size = np.diff(segments)
    text = np.repeat(np.arange(len(labels), dtype=np.int32), np.diff(bounds))
    per_text = np.maximum(np.diff(bounds), 1)
    balance = np.where(labels == 1, 0.5 / labels.sum(), 0.5 / (1 - labels).sum())
    full = np.flatnonzero(np.diff(bounds))

    vectors = rng.normal(0, 0.1, (BUCKETS, DIM))
    softmax = rng.normal(0, 0.1, DIM)
    bias = 0.0
    speed = [np.zeros_like(vectors), np.zeros(DIM), 0.0]
    for t in range(1, ROUNDS + 1):
        weights = vectors @ softmax
        score = np.bincount(rows, weights[buckets], count) * share
        means = segment_means(score[word], segments)
        if t <= WARM:
            logit = np.bincount(text, means, len(labels)) / per_text + bias
            pull = (1.0 / per_text)[text]
        else:
            top = np.full(len(labels), -np.inf)
            top[full] = np.maximum.reduceat(means, bounds[:-1][full])
            pull = (means == top[text]).astype(np.float64)
            pull /= np.maximum(np.bincount(text, pull, len(labels)), 1)[text]
            logit = np.where(np.isfinite(top), top, 0.0) + bias
        error = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels) * balance
        by_word = np.bincount(word, (pull * error[text] / size)[owner], count)
        by_bucket = np.bincount(buckets, (by_word * share)[rows], BUCKETS)
        # Plain momentum, one step size for all buckets: what many texts agree on moves, what
        # single texts would like to memorise hardly does.
        step = RATE / np.abs(by_bucket).max()
        speed[0] *= 0.8
        for k, pull_of in enumerate(softmax / np.abs(softmax).max()):
            speed[0][:, k] -= step * by_bucket * pull_of
        speed[1] = 0.8 * speed[1] - 0.02 * np.sign(by_bucket @ vectors)
        speed[2] = 0.8 * speed[2] - 0.2 * error.sum()
        vectors += speed[0]
        softmax, bias = softmax + speed[1], bias + speed[2]
    return Model((vectors @ softmax).astype(np.float32), float(bias))


def _known(labelled: DataFrame) -> DataFrame:
    """One label per id, the higher of several."""
    return (
        labelled.select(F.col("doc_id").cast("long").alias("doc_id"), "label")
        .filter("doc_id IS NOT NULL AND label IN (0, 1)")
        .groupBy("doc_id")
        .agg(F.max("label").cast("int").alias("label"))
    )


def sample(documents: DataFrame, labelled: DataFrame, limit: int = SAMPLE) -> DataFrame:
    """Texts and labels (text, label) of at most ``limit`` ids per class.

    Of several rows of one id the text with the smallest hash is taken.
    """
    known, chosen = _known(labelled), None
    for label in (0, 1):
        part = (
            known.filter(F.col("label") == label)
            .orderBy(F.xxhash64("doc_id"), "doc_id")
            .limit(limit)
        )
        chosen = part if chosen is None else chosen.unionByName(part)
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # At most 2 * limit rows of two numbers are broadcast.
    return (
        texts.join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "label")
        .agg(F.min(F.struct(F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"), "text")).alias("one"))
        .select("one.text", "label")
    )


def fit_on(documents: DataFrame, labelled: DataFrame, limit: int = SAMPLE) -> Model:
    """Fit on labelled rows (doc_id, label 0 or 1) of the documents."""
    small_batches(documents.sparkSession)
    counts = dict(_known(labelled).groupBy("label").count().collect())
    # One task trains, so that neither texts nor gradients take the driver's memory. Partitions
    # keep their order.
    chosen = sample(documents, labelled, limit).coalesce(1)
    found = chosen.mapInArrow(freeing(_fitted(counts.get(0, 0), counts.get(1, 0))), _MODEL).collect()
    if not found:
        return fit([], np.zeros(0))
    (row,) = found
    return Model(np.frombuffer(row["weights"], np.float32), row["bias"], row["slope"], row["shift"])


_MODEL = "weights BINARY, bias DOUBLE, slope DOUBLE, shift DOUBLE"


def _fitted(*totals: int):
    """The model of a partition's texts and labels, as one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, labels = [pa.array([], pa.string())], [np.zeros(0)]
        for batch in batches:
            texts.append(batch.column("text").cast(pa.string()).fill_null(""))
            labels.append(batch.column("label").to_numpy().astype(np.float64))
        model = fit(pa.concat_arrays(texts), np.concatenate(labels), totals)
        columns = [model.weights.tobytes(), float(model.bias), float(model.slope), float(model.shift)]
        kinds = [pa.binary(), pa.float64(), pa.float64(), pa.float64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([value], kind) for value, kind in zip(columns, kinds)],
            names=["weights", "bias", "slope", "shift"],
        )

    return run


def score(documents: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All columns plus ``score`` (0 to 1) of the whole text; a column of that name goes."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    small_batches(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in slices(batches, "text"):
            found = model.probability(model.logits(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(found)], names=["row", "score"]
            )

    # the caller's columns travel in one struct, whatever their names
    own = documents.drop("score")
    packed = documents.select(F.struct(*[F.col(f"`{c}`") for c in own.columns]).alias("row"), F.col(text).alias("text"))
    schema = packed.select("row").schema.add("score", "double")
    return packed.mapInArrow(freeing(run), schema).select("row.*", "score")
