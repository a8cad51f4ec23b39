"""Spelling variants: rare near neighbours of frequent words, found by pivotal grams.

Words are near if one inserted, deleted or replaced code point turns one into the other. A
word's form is the near word of largest count, if that is at least ``RATIO`` times its own;
following forms leads to its root.

Near words are found without comparing all words:

1. All bigrams are ranked, rarest first. A word's prefix is its three rarest bigram places (an
   edit spoils two bigrams at most) and all places of bigrams that rank no later.
2. Of the prefix, dynamic programming chooses two places that do not overlap and whose
   bigrams are rarest together: the pivots. One edit spoils one of them at most.
3. Of two near words, the pivots of the one whose third bigram ranks first lie in the other's
   prefix. So pivots are looked up among prefixes, with position limits: an edit before the
   bigram moves its place by the difference of the lengths, one behind it does not, and what
   lies on the other side of the bigram is the same in both words, and so is one half of what
   lies on the edit's side. A lookup is an equality of length, place and these parts of the
   word, taken as one hash, for each of the six ways in which an edit can act and both halves.
4. Candidates are verified by their edit distance.

Code points are below 256, so there are at most 65,536 bigrams, whose counts are gathered and
broadcast. Occurrences of words are counted in the map tasks; a word in a third of all texts is
one row per task. Prefixes and pivots are made in Arrow batches, all else by DataFrame
functions.

Null and empty texts hold no words, texts of any length are read whole, repeated rows count
each time, a null id is written as nothing, an empty table gives no rows. Other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from rookery.llm.batches import stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RUN = r"[A-Za-zÀ-ÿ]+"
LEAST = 7
OFTEN = 2
RATIO = 10
DAMAGE = 31
_GRAMS = 1 << 16
_FAR = 1 << 60


def lowered(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def runs(documents: DataFrame, damage: int = DAMAGE) -> DataFrame:
    """Every run of letters with a code point taken out of one in ``damage``: word.

    Which runs and which code point the CRC-32 of ``<doc_id>:<run>`` says.
    """
    found = documents.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("owner"),
        F.explode(F.regexp_extract_all(lowered(F.col("text")), F.lit(RUN), F.lit(0))).alias("run"),
    ).filter(F.char_length("run") >= LEAST)
    code = F.crc32(F.concat("owner", F.lit(":"), "run").cast("binary"))
    at = (code % F.char_length("run")).cast("int")
    cut = F.concat(
        F.substr("run", F.lit(1), at), F.substr("run", at + 2, F.char_length("run"))
    )
    return found.select(F.when(code % damage == 0, cut).otherwise(F.col("run")).alias("word"))


def counted(words: DataFrame, least: int = LEAST, often: int = OFTEN) -> DataFrame:
    """Distinct words of enough length and occurrences: word, n."""
    return (
        words.filter(F.char_length("word") >= least)
        .groupBy("word")
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") >= often)
    )


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bigram numbers of a list of words in a row, their words and their places."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    letters = np.frombuffer("".join(words).encode("latin-1"), np.uint8).astype(np.int32)
    counts = np.maximum(lengths - 1, 0)
    owner = np.repeat(np.arange(len(words)), counts)
    place = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    at = np.repeat(np.cumsum(lengths) - lengths, counts) + place
    return letters[at] * 256 + letters[at + 1], owner, place


def _bigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences of every bigram in a batch."""
    for batch in batches:
        if batch.num_rows:
            codes, _, _ = _codes(batch.column("word").to_pylist())
            grams, counts = np.unique(codes, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(grams, pa.int32()), pa.array(counts, pa.int64())], names=["g", "w"]
            )


def weights(words: DataFrame) -> np.ndarray:
    """How often every bigram occurs in the words; 65,536 numbers."""
    counts = words.mapInArrow(_bigrams, "g INT, w LONG").groupBy("g").agg(F.sum("w").alias("w"))
    out = np.zeros(_GRAMS, np.int64)
    for row in counts.collect():  # one row per bigram
        out[row["g"]] = row["w"]
    return out


def pivots(weight: np.ndarray, place: np.ndarray, size: np.ndarray) -> np.ndarray:
    """For every row the two columns that do not overlap and are rarest together.

    A row holds the prefix of a word in order of place, ``size`` columns of it. Dynamic
    programming from left to right, all rows at once: for each column the best pair is its
    weight and the lightest earlier column that it does not overlap.
    """
    rows = np.arange(len(weight))
    before = np.full(len(weight), -1)  # lightest column but the previous one
    pair = np.full((len(weight), 2), -1)
    least = np.full(len(weight), _FAR)

    def lighter(one: np.ndarray, other: np.ndarray) -> np.ndarray:
        heavy = np.where(one < 0, _FAR, weight[rows, one])
        return np.where((other >= 0) & (np.where(other < 0, _FAR, weight[rows, other]) < heavy), other, one)

    for k in range(weight.shape[1]):
        previous = np.full(len(weight), k - 1)
        everything = lighter(before, previous)
        apart = (place[:, k] - place[:, k - 1] > 1) if k else np.zeros(len(weight), bool)
        free = np.where(apart, everything, before)
        total = np.where(free < 0, _FAR, weight[rows, free] + weight[:, k])
        better = (k < size) & (total < least)
        least[better] = total[better]
        pair[better, 0] = free[better]
        pair[better, 1] = k
        before = everything
    return pair


def _prefixes(shared):
    """Rows (word, length, g, p, pivot) of every word's prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rarity = shared.value
        rank = np.empty(_GRAMS, np.int64)
        rank[np.lexsort((np.arange(_GRAMS), rarity))] = np.arange(_GRAMS)
        for batch in batches:
            if not batch.num_rows:
                continue
            column = batch.column("word")
            codes, owner, place = _codes(column.to_pylist())
            ranks = rank[codes]
            counts = np.bincount(owner, minlength=batch.num_rows)
            order = np.lexsort((ranks, owner))
            third = ranks[order][np.cumsum(counts) - counts + 2]
            kept = ranks <= third[owner]
            codes, owner, place = codes[kept], owner[kept], place[kept]
            size = np.bincount(owner, minlength=batch.num_rows)
            slot = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
            grid = np.zeros((2, batch.num_rows, size.max()), np.int64)
            grid[0, owner, slot] = rarity[codes]
            grid[1, owner, slot] = place
            chosen = pivots(grid[0], grid[1], size)
            pivot = (slot == chosen[owner, 0]) | (slot == chosen[owner, 1])
            lengths = counts + 1
            yield pa.RecordBatch.from_arrays(
                [
                    column.take(pa.array(owner)),
                    pa.array(lengths[owner], pa.int32()),
                    pa.array(codes, pa.int32()),
                    pa.array(place, pa.int32()),
                    pa.array(pivot),
                ],
                names=["word", "length", "g", "p", "pivot"],
            )

    return run


def prefixes(words: DataFrame) -> DataFrame:
    """The prefix of every word: a row per place with word, length, g, p and pivot.

    Words need four code points at least and none beyond U+00FF.
    """
    shared = words.sparkSession.sparkContext.broadcast(weights(words))
    return words.mapInArrow(
        _prefixes(shared), "word STRING, length INT, g INT, p INT, pivot BOOLEAN"
    )


def near_pairs(words: DataFrame) -> DataFrame:
    """Pairs (left, right), left < right, that differ by exactly one edit.

    ``words`` has each word once.
    """
    return (
        candidates(words)
        .filter(F.levenshtein("word", "other", 1) == 1)
        .select(F.least("word", "other").alias("left"), F.greatest("word", "other").alias("right"))
        .distinct()
    )


def candidates(words: DataFrame) -> DataFrame:
    """Rows (key, word, other) of words that a pivot found; all near words are among them."""
    held = stage(prefixes(words), "grams")

    def ways(*each: tuple[int, int, int]) -> Column:
        names = ("side", "more", "moved")
        return F.explode(F.array(*[
            F.struct(*[F.lit(value).alias(name) for name, value in zip(names, one)]) for one in each
        ])).alias("way")

    index = _keyed(held, ways((0, 0, 0), (1, 0, 0))).withColumnRenamed("word", "other")
    # replaced: same length and place; longer or shorter by one: the place moves if the edit
    # lies before it
    probes = _keyed(
        held.filter("pivot"),
        ways((0, 0, 0), (1, 0, 0), (0, 1, 0), (0, -1, 0), (1, 1, 1), (1, -1, -1)),
    )
    return probes.join(index, "key").filter("word != other")


def _keyed(held: DataFrame, ways: Column) -> DataFrame:
    """Rows (word, key) of every place, way and half.

    The one edit lies behind the bigram (side 0) or before it (side 1): what the word has up to
    the bigram's end, or from its start, is in the other word, too. Of the ``rest`` letters that
    the looked-up word has on the edit's side, the edit leaves the first half or the last half
    alone, whether it replaces, inserts or deletes. The key is a hash of what is left alone:
    ``left`` letters at the word's start and ``right`` letters at its end.
    """
    side, long = F.col("way.side"), F.col("length") + F.col("way.more")
    place = F.col("p") + F.col("way.moved")
    rest = F.when(side == 0, long - place - 2).otherwise(place)
    placed = held.select("word", "length", "p", ways).select(
        "word", "length", side.alias("side"), long.alias("long"), place.alias("place"),
        rest.alias("rest"), F.explode(F.array(F.lit(0), F.lit(1))).alias("half"),
    )
    first = F.shiftright("rest", 1)
    last = F.col("rest") - first
    left = F.when(F.col("side") == 0, F.col("place") + 2).otherwise(F.lit(0))
    right = F.when(F.col("side") == 0, F.lit(0)).otherwise(F.col("long") - F.col("place"))
    left = F.when(F.col("half") == 0, left + first).otherwise(left)
    right = F.when(F.col("half") == 1, right + last).otherwise(right)
    # without a letter on the edit's side nothing can be replaced or deleted there
    return placed.filter("rest > 0 OR (rest = 0 AND length > long)").select(
        "word",
        F.xxhash64(
            "long", "place", "side", "half",
            F.substr("word", F.lit(1), left),
            F.substr("word", F.col("length") - right + 1, right),
        ).alias("key"),
    )


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """Words (word, n) with n_near, form, form_n and root."""
    words = stage(words, "words")
    pairs = stage(near_pairs(words.select("word")), "near")
    both = pairs.unionByName(pairs.select(F.col("right").alias("left"), F.col("left").alias("right")))
    beside = both.join(words.select(F.col("word").alias("right"), F.col("n").alias("m")), "right")
    # the largest count, then the smallest word
    rank = Window.partitionBy("left").orderBy(F.desc("m"), "right")
    best = beside.select(
        F.col("left").alias("word"), "right", "m", F.row_number().over(rank).alias("k"),
        F.count("*").over(Window.partitionBy("left")).alias("n_near"),
    ).filter("k = 1")
    enough = F.col("m") >= ratio * F.col("n")
    found = stage(
        words.join(best, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(enough, F.col("right")).alias("form"),
            F.when(enough, F.col("m")).alias("form_n"),
        ),
        "variants",
    )
    roots = _roots(found.filter("form IS NOT NULL").select("word", F.col("form").alias("root")))
    return found.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))


def _roots(links: DataFrame) -> DataFrame:
    """Every linked word with the end of its chain, by following links twice as far each time.

    Counts grow by ``RATIO`` from word to form, so chains are short.
    """
    links = stage(links, "roots")
    while True:
        further = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        jumped = stage(
            links.join(further, "root", "left").select(
                "word", F.coalesce("next", "root").alias("root"),
                F.col("next").isNotNull().alias("moved"),
            ),
            "roots",
        )
        links = jumped.select("word", "root")
        if jumped.filter("moved").isEmpty():
            return links
