"""Mix sources to target weights: soft domains and rates by projected gradient.

A classifier learned from a labelled table gives every document a posterior over domains. A
document of t tokens and rate r then counts r * t * p tokens towards each domain; rates are
the nonnegative solution of least squares between these expected totals and the targets.

The classifier is naive Bayes over words and form. Words: at most ``WORDS`` marks a domain,
the words that labelled documents of the domain hold significantly more often than others,
in three levels of strength; a document's mark is the strongest of its words. Form: six binned
properties of the whole text (words, word length, distinct words, symbols, sentence marks,
capitals). Marks are learned from one half of at most ``SAMPLE`` labelled documents a domain,
chosen by a hash of the id, and weighed on the labelled documents outside that half.

Documents in the same bins, a cell, have one posterior, so the fit needs tokens by cell only;
there are ``SHAPES`` cells for each level of mark and domain at most, whatever the number of
documents. Every step of the accelerated projected gradient is one aggregation of the cells'
table to one number per domain. The gradient is scaled by the document's tokens, which gives
one rate per cell and leaves the minimum where it is. Steps end when the targets are met or the
totals stand still, after ``MOST_STEPS`` at the latest; ``residual`` is the largest share of the total by which a domain misses.

A rate becomes ``floor(rate)`` copies and one more with the remaining probability, decided by
a hash of the document's id and text. Everything on rows is DataFrame functions; tokens are
words between blanks or line ends. Texts are parsed once and whole, whatever their length.

Null and empty texts have no tokens and the posterior of their bins. Labels are joined by
doc_id; of several labels of one id the smallest counts. Labels that are no target are left
out. Domains without a labelled document are dropped and the other weights scaled up; without
any labelled document all rates are 1. Repeated rows count each time; an empty table gives no
rows; columns of any name stay, but for those that are added.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from rookery.llm.batches import stage
from rookery.operators.once import evaluate_once

MOST_STEPS = 160
TOLERANCE = 1e-4  # share of the total tokens by which a domain may miss its target
_HELD = 40  # steps after which the rates so far are written
SAMPLE = 3000  # labelled documents of each domain from which marks are learned
WORDS = 200  # marks of each domain
LEVELS = [0.7, 2.0, 4.0]  # log-ratio from which a mark is weak, clear, strong
_EDGES = [
    [10, 50, 150, 500, 2000],  # words
    [4.0, 5.5, 8.0],  # characters a word
    [0.3, 0.7, 0.95],  # distinct words a word
    [0.002, 0.05, 0.8],  # symbols a word
    [0.01, 0.12, 0.25],  # sentence marks a word
    [0.005, 0.03, 0.4],  # capitals a character
]
SHAPES = math.prod(len(edges) + 1 for edges in _EDGES)
_MARK = len(_EDGES)  # number of the property that marks make


def _words(text: Column) -> Column:
    body = F.translate(F.coalesce(text, F.lit("")), "\t\n\r\f\u000b", "     ")
    return F.filter(F.split(body, " "), lambda w: w != "")


def _for_marks(doc_id: Column) -> Column:
    """The half of the labelled documents that marks are learned from."""
    return F.pmod(F.xxhash64(F.lit("marks"), doc_id), F.lit(2)) == 0


def _labels(labelled: DataFrame, names: list[str]) -> DataFrame:
    """One domain per id."""
    return (
        labelled.filter(F.col("doc_id").isNotNull() & F.col("domain").isin(*names))
        .groupBy("doc_id")
        .agg(F.min("domain").alias("domain"))
    )


def _texts_for_marks(documents: DataFrame, labelled: DataFrame, names: list[str]) -> DataFrame:
    """Texts (doc_id, text, domain) that marks are learned from."""
    rank = Window.partitionBy("domain").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = (
        _labels(labelled, names)
        .filter(_for_marks(F.col("doc_id")))
        .withColumn("k", F.row_number().over(rank))
        .filter(F.col("k") <= SAMPLE)
        .drop("k")
    )
    # At most SAMPLE rows a domain are broadcast; a shuffle would move every text.
    return documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")


def marks(documents: DataFrame, labelled: DataFrame, names: list[str]) -> list[list[str]]:
    """Words by level and domain, the weakest level first: ``WORDS`` a domain at most."""
    texts = _texts_for_marks(documents, labelled, names)
    totals = dict(texts.groupBy("domain").count().collect())
    every = sum(totals.values())
    by_domain = [
        F.sum((F.col("domain") == name).cast("long")).alias(f"n{d}") for d, name in enumerate(names)
    ]
    counts = (
        texts.select("domain", F.explode(F.array_distinct(_words(F.col("text")))).alias("word"))
        .groupBy("word")
        .agg(F.count("*").alias("n"), *by_domain)
        .filter("n >= 5")
    )
    each = []
    for d, name in enumerate(names):
        own, rest = totals.get(name, 0), every - totals.get(name, 0)
        if not own or not rest:
            continue
        here = (F.col(f"n{d}") + 0.5) / (own + 1)
        there = (F.col("n") - F.col(f"n{d}") + 0.5) / (rest + 1)
        spread = F.sqrt(here * (1 - here) / own + there * (1 - there) / rest)
        each.append(
            F.struct(
                F.lit(d).alias("d"), F.log(here / there).alias("ratio"),
                ((here - there) / spread).alias("score"),
            )
        )
    found: list[list[str]] = [[] for _ in range(len(LEVELS) * len(names))]
    if not each:
        return found
    best = Window.partitionBy("d").orderBy(F.desc("score"), "word")
    rows = (
        counts.withColumn("one", F.explode(F.array(*each)))
        .select("word", "one.*")
        .filter(F.col("ratio") >= LEVELS[0])
        .withColumn("k", F.row_number().over(best))
        .filter(F.col("k") <= WORDS)
        .collect()  # domains * WORDS rows at most
    )
    for row in rows:
        level = sum(row["ratio"] >= edge for edge in LEVELS) - 1
        found[level * len(names) + row["d"]].append(row["word"])
    return found


def _level(word: Column, lexicon: list[list[str]]) -> Column:
    """Number of the last list that holds a word, from 1; 0 if none does."""
    found = F.lit(0)
    for k, words in enumerate(lexicon, 1):
        if words:
            found = F.when(word.isin(*words), k).otherwise(found)
    return found


def measured(
    documents: DataFrame, lexicon: list[list[str]], text: str, kept: list[str]
) -> DataFrame:
    """Columns row (a struct of the kept ones), doc_id, tokens, cell and chance (0 to 1)."""
    body = F.coalesce(F.col(text), F.lit(""))
    packed = documents.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        body.alias("body"),
        _chance(F.col("doc_id"), F.col(text)).alias("chance"),
    )
    split = evaluate_once(packed, "words", _words(F.col("body")))
    mark = F.lit(0)
    if any(lexicon):
        strongest = F.array_max(F.transform("words", lambda w: _level(w, lexicon)))
        mark = F.coalesce(strongest, F.lit(0))
    counted = evaluate_once(
        split,
        "of",
        F.struct(
            F.size("words").cast("long").alias("tokens"),
            F.size(F.array_distinct("words")).alias("kinds"),
            mark.alias("mark"),
        ),
    )
    tokens = F.greatest(F.col("of.tokens"), F.lit(1))
    length = F.length("body")
    body = F.col("body")
    values = [
        F.col("of.tokens"),
        length / tokens,
        F.col("of.kinds") / tokens,
        F.regexp_count(body, F.lit(r"[|!#*&%$]")) / tokens,
        F.regexp_count(body, F.lit(r"[.,;?]")) / tokens,
        F.regexp_count(body, F.lit("[A-Z]")) / F.greatest(length, F.lit(1)),
    ]
    cell = F.col("of.mark")
    for value, edges in zip(values, _EDGES):
        reached = reduce(Column.__add__, [(value >= edge).cast("int") for edge in edges])
        cell = cell * (len(edges) + 1) + reached
    return evaluate_once(
        counted, "into", F.struct(F.col("of.tokens").alias("tokens"), cell.alias("cell"))
    ).select("row", "doc_id", "into.tokens", "into.cell", "chance")


def _bins(cell: Column) -> list[Column]:
    """A cell's bin of every property, the mark last."""
    out = []
    for edges in reversed(_EDGES):
        out.append((cell % (len(edges) + 1)).cast("int"))
        cell = F.floor(cell / (len(edges) + 1))
    return [*out[::-1], cell.cast("int")]


@dataclass
class Domains:
    """Names, and log-probabilities: prior by domain, by property and bin for each domain."""

    names: list[str]
    prior: list[float]
    likelihood: list[list[list[float]]]

    def posterior(self, cell: Column) -> Column:
        def vector(values: list[float]) -> Column:
            return F.array(*[F.lit(value) for value in values])

        each = []
        for k, at in enumerate(_bins(cell)):
            by_bin = [list(of_bin) for of_bin in zip(*[one[k] for one in self.likelihood])]
            each.append(F.get(F.array(*[vector(row) for row in by_bin]), at))
        logs = F.aggregate(
            F.array(*each),
            vector(self.prior),
            lambda held, one: F.zip_with(held, one, lambda x, y: x + y),
        )
        weights = F.transform(
            F.array(logs), lambda v: F.transform(v, lambda x: F.exp(x - F.array_max(v)))
        )[0]
        whole = F.transform(
            F.array(weights),
            lambda w: F.transform(w, lambda x: x / F.aggregate(w, F.lit(0.0), lambda a, y: a + y)),
        )
        return whole[0]


def learn(cells: DataFrame, labelled: DataFrame, names: list[str]) -> Domains | None:
    """Naive Bayes from labelled (doc_id, domain) and the documents' (doc_id, cell).

    Marks count where they were not learned.
    """
    bins = [len(edges) + 1 for edges in _EDGES] + [len(LEVELS) * len(names) + 1]
    pairs = F.array(
        *[F.struct(F.lit(k).alias("k"), at.alias("at")) for k, at in enumerate(_bins(F.col("cell")))]
    )
    counts = (
        cells.join(_labels(labelled, names), "doc_id")
        .select("doc_id", "domain", F.explode(pairs).alias("one"))
        .filter((F.col("one.k") != _MARK) | ~_for_marks(F.col("doc_id")))
        .groupBy("domain", "one.k", "one.at")
        .agg(F.count("*").alias("n"))
        .collect()  # domains * bins rows at most
    )
    seen = {(row["domain"], row["k"], row["at"]): row["n"] for row in counts}
    held = {
        (name, k): sum(n for (d, p, _), n in seen.items() if d == name and p == k)
        for name in names for k in range(len(bins))
    }
    totals = {name: held[name, 0] for name in names}
    found = [name for name in names if totals[name]]
    if not found:
        return None
    every = sum(totals.values())
    likelihood = [
        [
            [
                math.log((seen.get((name, k, b), 0) + 0.5) / (held[name, k] + 0.5 * size))
                for b in range(size)
            ]
            for k, size in enumerate(bins)
        ]
        for name in found
    ]
    return Domains(found, [math.log(totals[name] / every) for name in found], likelihood)


def _folded(steps: list[tuple[list[float], float]], least: float) -> Column:
    """A cell's rate after more steps: (scaled residual by domain, momentum)."""
    start = F.struct("rate", "ahead")
    if not steps:
        return start
    moves = F.array(
        *[
            F.struct(
                F.array(*[F.lit(float(v)) for v in residual]).alias("residual"),
                F.lit(float(momentum)).alias("momentum"),
            )
            for residual, momentum in steps
        ]
    )

    def move(held: Column, step: Column) -> Column:
        slope = F.aggregate(
            F.zip_with("posterior", step["residual"], lambda p, g: p * g),
            F.lit(0.0),
            lambda a, x: a + x,
        )
        rate = F.greatest(F.lit(least), held["ahead"] - slope)
        return F.struct(
            rate.alias("rate"),
            (rate + step["momentum"] * (rate - held["rate"])).alias("ahead"),
        )

    return F.aggregate(moves, start, move)


def fit_rates(
    cells: DataFrame,
    domains: Domains,
    targets: dict[str, float],
    least: float = 0.0,
    steps: int = MOST_STEPS,
) -> DataFrame:
    """A rate per cell (cell, posterior, rate, residual), from rows of (cell, tokens).

    Expected domain totals approach the targets' shares of one total: the present tokens, or,
    if ``least`` is positive, the smallest total for which no domain has to shrink.
    """
    grouped = cells.groupBy("cell").agg(F.sum("tokens").alias("tokens"))
    table = stage(
        grouped.withColumn("posterior", domains.posterior(F.col("cell")))
        .withColumns({"rate": F.lit(1.0), "ahead": F.lit(1.0)})
        .coalesce(1),
        "cells",
    )
    size = len(domains.names)
    both = [(a, b) for a in range(size) for b in range(size)]
    share = [F.get("posterior", F.lit(d)) for d in range(size)]
    squares = table.agg(*[F.sum(F.col("tokens") * share[a] * share[b]) for a, b in both]).first()
    # no step this long overshoots
    steepest = np.linalg.eigvalsh(np.reshape([v or 0.0 for v in squares], (size, size))).max()

    def totals(rate: Column) -> list[float]:
        row = table.select(F.col("tokens") * rate, "posterior").toDF("mass", "posterior").agg(
            *[F.sum(F.col("mass") * F.get("posterior", F.lit(d))).alias(f"m{d}") for d in range(size)]
        ).first()
        return [float(value or 0.0) for value in row]

    natural = totals(F.lit(1.0))
    weights = [max(0.0, float(targets[name])) for name in domains.names]
    whole = sum(weights) or 1.0
    weights = [w / whole for w in weights]
    total = sum(natural)
    if least > 0:
        total = max([least * n / w for n, w in zip(natural, weights) if w > 0], default=total)
    goals = [w * total for w in weights]
    scale = max(sum(natural), 1.0)
    history: list[tuple[list[float], float]] = []
    speed = 1.0
    before = None
    for _ in range(steps):
        now = totals(_folded(history, least)["ahead"])
        residual = [(m - goal) / scale for m, goal in zip(now, goals)]
        still = before is not None and max(abs(a - b) for a, b in zip(residual, before)) < TOLERANCE / 100
        if max(map(abs, residual)) < TOLERANCE or still:
            break
        before = residual
        faster = (1 + math.sqrt(1 + 4 * speed * speed)) / 2
        history.append(([r * scale / max(steepest, 1e-9) for r in residual], (speed - 1) / faster))
        speed = faster
        if len(history) == _HELD:
            moved = _folded(history, least)
            table = stage(
                table.select("cell", "tokens", "posterior", moved.alias("m")).select(
                    "cell", "tokens", "posterior", "m.rate", "m.ahead"
                ),
                "cells",
            )
            history = []
    rate = _folded(history, least)["rate"]
    missed = max(abs(m - goal) / scale for m, goal in zip(totals(rate), goals))
    return table.select(
        "cell", "posterior", rate.alias("rate"), F.lit(float(missed)).alias("residual")
    )


def _chance(*identity: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit("copies"), *identity), F.lit(1 << 30)) / float(1 << 30)


def mix(
    documents: DataFrame,
    labelled: DataFrame,
    targets: dict[str, float],
    least: float = 0.0,
    kept: list[str] | None = None,
) -> DataFrame:
    """The kept columns (all) plus tokens, posterior, rate, residual, copies and domains.

    ``copies`` is whole; its expected number is the rate. ``domains`` names the posterior's
    entries. Rates are joined by cell, of which there is a bounded number.
    """
    names = list(targets)
    added = ["tokens", "posterior", "rate", "residual", "copies", "domains"]
    kept = [c for c in (documents.columns if kept is None else kept) if c not in added]
    lexicon = marks(documents, labelled, names)
    rows = stage(
        measured(documents, lexicon, "text", kept), "measured"
    )
    narrow = rows.select("doc_id", "cell", "tokens")
    domains = learn(narrow, labelled, names)
    if domains is None:
        fitted = narrow.select("cell").distinct().select(
            "cell", F.array().cast("array<double>").alias("posterior"), F.lit(1.0).alias("rate"),
            F.lit(0.0).alias("residual"),
        )
    else:
        fitted = fit_rates(narrow, domains, targets, least)
    whole = F.floor("rate")
    copies = (whole + (F.col("chance") < F.col("rate") - whole).cast("int")).cast("int")
    return rows.join(F.broadcast(fitted), "cell").select(
        "row.*", "tokens", "posterior", "rate", "residual", copies.alias("copies"),
        F.array(*[F.lit(n) for n in (domains.names if domains else [])])
        .cast("array<string>").alias("domains"),
    )
