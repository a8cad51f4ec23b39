"""Personal data: base rules, overlapping candidates, boosted trees, calibrated thresholds.

Base spans (e-mail, ip, card, phone) follow fixed patterns and checks and always stay. Beyond
them, high-recall generators propose spans that may overlap: addresses with ``@`` or ``dot``
spelt out, dotted numbers, groups of digits with any separators, long mixed tokens and values
of keywords. A candidate is described by binned features of its format (digits, groups,
separators, letters, checksum) and of its context (the words before it, its neighbours).
Boosted regression trees score it; they learn from the candidates that the rules can tell
apart for certain (valid forms against versions, short numbers, failing checksums), so forms
the rules do not know are judged by what they share with known ones. Addresses are described
as if nothing in them were spelt out or in brackets; a bare ``at`` without ``dot`` is told apart, and behind a
plain word it is certain prose.

Features are counted over all candidates of all texts. The counts of at most ``CELLS``
distinct feature combinations (the commonest) come to the driver, where the trees are fitted.
Trees are then CASE expressions. They score all counted combinations, the rare ones too, and
each generator's threshold is the lowest score (in bins) above which certain candidates are
right in ``PRECISION`` of all cases. All work on texts is DataFrame functions, each row on its
own; nothing is shuffled but feature counts.

Added spans never overlap base spans, nor each other (earlier generators win). Nulls and empty
texts have no spans. Without certain candidates of both sorts nothing is added. Positions are
code points, ends exclusive. Repeated rows and extra columns stay as they are.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from rookery.llm.batches import stage

CELLS = 20_000
TREES, DEPTH, RATE = 24, 3, 0.4
PRECISION = 0.95
BINS, LIMIT = 64, 32.0  # score bins a unit of log-odds, the highest odds told apart
KINDS = ["email", "ip", "card", "phone", "secret"]

# Base patterns. Look-behinds and possessive runs only keep the matcher linear; matches are
# the same as without them.
BASE = {
    "email": (
        r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
    ),
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
_AT = r"(?:@|[\x20]?[(\[{]at[)\]}][\x20]?|\x20at\x20)"
_DOT = r"(?:\.|[\x20]?[(\[{]dot[)\]}][\x20]?|\x20dot\x20)"
GENERATORS = {
    "email": rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++{_AT}[A-Za-z0-9-]++(?:{_DOT}[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:(?:\.|\[\.\]|\(\.\))[0-9]++)++",
    "digits": r"(?:\+|\()?[0-9](?:[\x20().\-/]{0,3}+[0-9])++",
    "secret": (
        r"(?i:passw(?:or)?d|pwd|token|secret|api[_-]?key)[\x20]?[=:][\x20]?\"?[^\s\",;]++"
        r"|(?<![A-Za-z0-9_/+-])[A-Za-z0-9_/+-]{16,}+"
    ),
}
# What a text must have for a pattern to match in it; looked up once per text. Whatever a pattern
# matches has its sign.
_SIGNS = {
    "_digit": lambda text: text.rlike("[0-9]"),
    "_at": lambda text: text.contains("@"),
    "_plus": lambda text: text.contains("+"),
    "_spelt": lambda text: text.rlike(rf"{_AT}[A-Za-z0-9-]++{_DOT}[A-Za-z0-9-]"),
}


def _signed(documents: DataFrame, text: str) -> DataFrame:
    body = F.coalesce(F.col(text), F.lit(""))
    return documents.withColumn("_body", body).withColumns(
        {name: sign(F.col("_body")) for name, sign in _SIGNS.items()}
    )


# Words before a candidate that say what it is, by class.
_CONTEXT = [
    r"(?i)(?:phone|tel|call|mobile|fax|cell|whatsapp)\W*$",
    r"(?i)(?:mail|contact|write|address)\W*$",
    r"(?i)(?:card|visa|mastercard|amex|credit|debit|account|iban)\W*$",
    r"(?i)(?:ip|host|server|addr)\W*$",
    r"(?i)(?:password|token|secret|key|login)\W*$",
    r"(?i)(?:version|license|licence|chapter|page|section|no|by-nc|by-sa|by)\W*$",
]


# --- spans ------------------------------------------------------------------

_STRIDE = 256


def _running(values: Column) -> Column:
    """What comes before each value: sums of those to its left."""
    start = F.struct(
        F.lit(0).cast("long").alias("sum"), F.array().cast("array<bigint>").alias("seen")
    )
    return F.aggregate(
        values,
        start,
        lambda held, x: F.struct(
            (held["sum"] + x).alias("sum"),
            F.concat(held["seen"], F.array(held["sum"])).alias("seen"),
        ),
        lambda held: held["seen"],
    )


def _with_places(rows: DataFrame, patterns: dict[str, tuple[Column, str]]) -> DataFrame:
    """Add for each name the matches of its pattern: start, match, text before and after.

    Starts are running sums of the lengths between matches, summed in strides, so that a text
    with very many matches takes time in proportion. Each step is a column of its own: an
    expression that is used twice would search the text twice.
    """
    columns = rows.columns
    body = F.col("_body")
    none = F.array().cast("array<string>")
    found = {}
    for name, (sign, pattern) in patterns.items():
        found[f"{name}_m"] = F.when(sign, F.regexp_extract_all(body, F.lit(pattern), F.lit(0)))
    rows = rows.withColumns({name: F.coalesce(column, none) for name, column in found.items()})
    rows = rows.withColumns(
        {
            f"{n}_g": F.when(F.size(f"{n}_m") > 0, F.split(body, p, -1)).otherwise(none)
            for n, (_, p) in patterns.items()
        }
    )
    rows = rows.withColumns(
        {
            f"{n}_l": F.zip_with(
                F.slice(f"{n}_g", F.lit(1), F.size(f"{n}_m")),
                f"{n}_m",
                lambda gap, match: (F.length(gap) + F.length(match)).cast("long"),
            )
            for n in patterns
        }
    )

    def strides(name: str) -> Column:
        count = F.ceil(F.size(f"{name}_l") / _STRIDE).cast("int")
        numbers = F.filter(F.sequence(F.lit(0), count), lambda k: k < count)
        return F.transform(
            numbers, lambda k: F.slice(f"{name}_l", k * _STRIDE + 1, F.lit(_STRIDE))
        )

    rows = rows.withColumns({f"{name}_s": strides(name) for name in patterns})
    zero = F.lit(0).cast("long")
    rows = rows.withColumns(
        {
            f"{n}_b": _running(
                F.transform(f"{n}_s", lambda one: F.aggregate(one, zero, lambda x, y: x + y))
            )
            for n in patterns
        }
    )

    def starts(name: str) -> Column:
        return F.flatten(
            F.zip_with(
                f"{name}_b",
                f"{name}_s",
                lambda base, one: F.transform(_running(one), lambda x: x + base),
            )
        )

    def places(name: str) -> Column:
        return F.transform(
            F.arrays_zip(F.col(f"{name}_a").alias("at"), F.col(f"{name}_m").alias("match")),
            lambda one, i: F.struct(
                (one["at"] + F.length(F.get(f"{name}_g", i))).alias("start"),
                one["match"].alias("match"),
                F.right(F.get(f"{name}_g", i), F.lit(24)).alias("before"),
                F.left(F.get(f"{name}_g", i + 1), F.lit(4)).alias("after"),
            ),
        )

    rows = rows.withColumns({f"{name}_a": starts(name) for name in patterns})
    return rows.select(*columns, *[places(name).alias(name) for name in patterns])


_SPAN = "array<struct<kind:string,start:bigint,end:bigint>>"


def _none(kind: str) -> Column:
    return F.array().cast(kind)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the checksum of 13 to 19 digits holds."""
    doubled = F.translate(F.reverse(digits), "0123456789", "0246813579")
    plain = F.reverse(digits)

    def total(one: Column) -> Column:
        return F.aggregate(one, F.lit(0), lambda a, x: a + x)

    odd = F.transform(
        F.sequence(F.lit(1), F.length(digits)),
        lambda i: F.when(i % 2 == 0, F.substring(doubled, i, F.lit(1)))
        .otherwise(F.substring(plain, i, F.lit(1)))
        .cast("int"),
    )
    return F.when(F.length(digits).between(13, 19), total(odd) % 10 == 0).otherwise(False)


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        return match.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")
    if kind == "card":
        return _luhn(_digits(match))
    if kind == "phone":
        return F.length(_digits(match)).between(9, 15)
    return F.lit(True)


def _span(kind: Column, start: Column, match: Column) -> Column:
    return F.struct(
        kind.alias("kind"), start.alias("start"), (start + F.length(match)).alias("end")
    )


def _base_spans() -> Column:
    """Spans of the base rules, by kind as listed, then start."""

    def of(kind: str) -> Column:
        return F.transform(
            F.filter(f"_base_{kind}", lambda place: _valid(kind, place["match"])),
            lambda place: _span(F.lit(kind), place["start"], place["match"]),
        )

    return F.concat(*[of(kind) for kind in BASE])


_BASE_SIGNS = {"email": "_at", "ip": "_digit", "card": "_digit", "phone": "_plus"}


def _base_patterns() -> dict[str, tuple[Column, str]]:
    return {f"_base_{kind}": (F.col(_BASE_SIGNS[kind]), p) for kind, p in BASE.items()}


def _generator_patterns() -> dict[str, tuple[Column, str]]:
    # Nothing cheaper than its pattern tells whether a text has a secret.
    signs = {"email": F.col("_spelt"), "secret": F.lit(True)}
    return {
        f"_any_{name}": (signs.get(name, F.col("_digit")), p) for name, p in GENERATORS.items()
    }


# --- candidates -------------------------------------------------------------


def _bin(value: Column, edges: list[int]) -> Column:
    """How many edges the value reaches."""
    out = F.lit(0)
    for edge in edges:
        out = out + (value >= edge).cast("int")
    return out


# An address, if one at all, with a bare ``at`` and nothing else spelt out: mostly prose.
_BARE = r"^[^\x20]+\x20at\x20[A-Za-z0-9.-]+$"
_DOMAIN = r"@(?!(?i:www)\.)(?:[A-Za-z0-9-]+\.)+(?:[A-Za-z]{2,}|(?i:xn--)[A-Za-z0-9-]+)$"


def _plain(name: str, match: Column) -> Column:
    """A match with its separators as they are when not spelt out."""
    if name == "email":
        return F.regexp_replace(F.regexp_replace(match, _AT, "@"), _DOT, ".")
    if name == "ip":
        return F.regexp_replace(match, r"[()\[\]]", "")
    return match


def _features(generator: int, name: str, place: Column) -> list[Column]:
    match, before, after = _plain(name, place["match"]), place["before"], place["after"]
    digits = _digits(match)
    groups = F.regexp_replace(F.regexp_replace(match, "[0-9]+", "#"), "[^#]", "")
    longest = F.array_max(F.transform(F.split(match, "[^0-9]+"), lambda x: F.length(x)))
    context = F.lit(0)
    for number, pattern in enumerate(_CONTEXT, 1):
        context = F.when(before.rlike(pattern), number).otherwise(context)
    bare = place["match"].rlike(_BARE).cast("int") if name == "email" else F.lit(1)
    address = _valid("ip", match).cast("int") if name == "ip" else F.lit(0)
    return [
        bare,  # before the generator, so that trees prefer it where both tell the same
        F.lit(generator),
        _bin(F.length(digits), [1, 4, 7, 9, 10, 11, 13, 15, 16, 17, 20]),
        _bin(F.length(groups), [1, 2, 3, 4, 5, 8]),
        _bin(longest, [1, 2, 3, 4, 5, 8, 12]),
        match.rlike(r"[()\[\]]").cast("int"),  # not the plus sign, which makes a number certain
        _bin(F.length(F.regexp_replace(match, "[^.]", "")), [1, 2, 3, 4]),
        match.rlike("[a-z]").cast("int") + 2 * match.rlike("[A-Z]").cast("int"),
        _bin(F.length(match), [4, 8, 12, 16, 20, 24, 32, 48]),
        match.rlike(r"[=:]").cast("int"),
        _luhn(digits).cast("int") + 2 * address,
        match.rlike(r"^[0-9]{1,3}(?:\D+[0-9]{1,3}){3}$").cast("int")
        + 2 * match.rlike(r"^\+?(?:[0-9]{1,3}\W{1,2})?\(?[0-9]{3}\W{1,3}[0-9]{3}\W[0-9]{4}$").cast("int"),
        context,
        before.rlike(r"[A-Za-z0-9]$").cast("int") + 2 * after.rlike(r"^[A-Za-z0-9]").cast("int"),
    ]


def _certain(generator: str, place: Column) -> Column:
    """1 or 0 where the rules are sure of a candidate, else null."""
    match = place["match"]
    digits = F.length(_digits(match))
    if generator == "email":
        # A word, "at" and a domain are prose, unless they follow a word for mail.
        prose = match.rlike(_BARE) & match.rlike(r"^[A-Za-z]+\x20")
        return (
            F.when(match.rlike(r"^[^\x20()\[\]{}]+$"), 1)
            .when(~_plain(generator, match).rlike(_DOMAIN), 0)
            .when(prose & ~place["before"].rlike(_CONTEXT[1]), 0)
        )
    if generator == "ip":
        # Plain valid addresses are base spans; those with brackets are what this may add.
        return F.when(~match.rlike(r"[(\[]"), _valid("ip", match).cast("int"))
    if generator == "digits":
        plus = match.startswith("+")
        return (
            F.when(plus & digits.between(9, 15), 1)
            .when(_luhn(_digits(match)), 1)
            .when(digits < 7, 0)
            .when(~plus & (digits >= 13), 0)
            .when(match.rlike("^[0-9]+$"), 0)
        )
    keyed = match.rlike(r"[=:]\s?\"?(?=[^\s]*[0-9])(?=[^\s]*[A-Za-z])[^\s]{8,}$")
    shape = match.rlike(r"^[A-Z]{4}(?=[A-Z0-9]*[0-9])[A-Z0-9]{16}$")
    dull = ~match.rlike("[0-9]") | ~match.rlike("[A-Za-z]")
    return F.when(keyed | shape, 1).when(dull, 0)


_CANDIDATE = "array<struct<generator:int,label:int,start:bigint,match:string,features:array<int>>>"


def _candidates() -> Column:
    """Every generator's spans with their features."""

    def of(number: int, name: str) -> Column:
        return F.transform(
            f"_any_{name}",
            lambda place: F.struct(
                F.lit(number).alias("generator"),
                _certain(name, place).alias("label"),
                place["start"].alias("start"),
                place["match"].alias("match"),
                F.array(*_features(number, name, place)).alias("features"),
            ),
        ).cast(_CANDIDATE)

    return F.concat(*[of(number, name) for number, name in enumerate(GENERATORS)])


# --- boosted trees ----------------------------------------------------------


@dataclass
class Trees:
    """Trees as nested (feature, edge, left, right) or leaf values; a threshold a generator."""

    start: float
    trees: list
    thresholds: list[float]

    def column(self, features: Column) -> Column:
        """The log-odds of a candidate."""

        def of(node) -> Column:
            if isinstance(node, float):
                return F.lit(node)
            feature, edge, left, right = node
            return F.when(F.get(features, F.lit(feature)) <= edge, of(left)).otherwise(of(right))

        out = F.lit(self.start)
        for tree in self.trees:
            out = out + of(tree)
        return out

    def scores(self, x: np.ndarray) -> np.ndarray:
        def of(node, rows: np.ndarray) -> np.ndarray:
            if isinstance(node, float):
                return np.full(len(rows), node)
            feature, edge, left, right = node
            return np.where(rows[:, feature] <= edge, of(left, rows), of(right, rows))

        return self.start + sum((of(tree, x) for tree in self.trees), np.zeros(len(x)))


def _grow(x: np.ndarray, gradient: np.ndarray, weight: np.ndarray, depth: int):
    """A tree on weighted gradients (Newton steps), split where the gain is largest."""
    value = float(RATE * gradient.sum() / (weight.sum() + 1.0))
    best = (1e-6, 0, 0)
    if depth:
        whole = gradient.sum() ** 2 / (weight.sum() + 1.0)
        for feature in range(x.shape[1]):
            bins = int(x[:, feature].max()) + 1
            g = np.cumsum(np.bincount(x[:, feature], gradient, bins))[:-1]
            h = np.cumsum(np.bincount(x[:, feature], weight, bins))[:-1]
            if len(g):
                rest = gradient.sum() - g, weight.sum() - h
                gain = g**2 / (h + 1.0) + rest[0] ** 2 / (rest[1] + 1.0) - whole
                edge = int(gain.argmax())
                best = max(best, (float(gain[edge]), -feature, edge))
    if best[0] <= 1e-6:
        return value
    feature, edge = -best[1], best[2]
    left = x[:, feature] <= edge
    return (
        feature,
        edge,
        _grow(x[left], gradient[left], weight[left], depth - 1),
        _grow(x[~left], gradient[~left], weight[~left], depth - 1),
    )


def fit_trees(x: np.ndarray, labels: np.ndarray, counts: np.ndarray) -> Trees | None:
    """Boost on distinct feature rows, their labels and how often they occur."""
    ones, all_rows = float(counts[labels == 1].sum()), float(counts.sum())
    if not 0 < ones < all_rows:
        return None
    # A form that occurs very often should not drown the others.
    weight = np.sqrt(counts)
    model = Trees(float(np.log(ones / (all_rows - ones))), [], [])
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-model.scores(x)))
        tree = _grow(x, weight * (labels - p), weight * np.maximum(p * (1 - p), 1e-6), DEPTH)
        model.trees.append(tree)
    return model


def calibrate(model: Trees, cells: DataFrame) -> None:
    """Set each generator's threshold by all cells (features, label, n), whatever their number.

    Their scores are rounded down to bins, so what comes to the driver is bounded.
    """
    score = F.greatest(F.least(model.column(F.col("features")), F.lit(LIMIT)), F.lit(-LIMIT))
    bins = (
        cells.select(
            F.get("features", F.lit(1)).alias("generator"),
            F.floor(score * BINS).alias("bin"),
            "n",
            (F.col("n") * F.col("label")).alias("right"),
        )
        .groupBy("generator", "bin")
        .agg(F.sum("n").alias("seen"), F.sum("right").alias("right"))
        .collect()
    )
    for generator in range(len(GENERATORS)):
        own = sorted((b for b in bins if b["generator"] == generator), key=lambda b: -b["bin"])
        right = np.cumsum([b["right"] for b in own])
        seen = np.cumsum([b["seen"] for b in own])
        fits = np.flatnonzero((right + 2 * PRECISION) / (seen + 2) >= PRECISION)
        if not len(fits):
            model.thresholds.append(np.inf)
            continue
        # Between the last bin that still fits and the next one below it, at odds of 4 at least.
        around = [b["bin"] for b in own[fits[-1] : fits[-1] + 2]]
        lowest = (around[0] + around[1] + 1) / 2 / BINS if len(around) == 2 else -np.inf
        model.thresholds.append(max(lowest, float(np.log(4.0))))


def fit(documents: DataFrame, text: str = "text") -> Trees | None:
    """Count all candidates' features, fit the trees and set the thresholds."""
    # The outer form, as the plain one would be searched for empty arrays first: all work twice.
    one = F.explode_outer("found").alias("one")
    counted = (
        _with_places(_signed(documents.select(text), text).drop(text), _generator_patterns())
        .select(_candidates().alias("found"))
        .select(one)
        .filter("one.label IS NOT NULL")
        .groupBy("one.features", "one.label")
        .agg(F.count("*").alias("n"))
    )
    counted = stage(counted, "pii-cells")
    cells = counted.orderBy(F.desc("n"), "features", "label").limit(CELLS).collect()
    if not cells:
        return None
    model = fit_trees(
        np.array([cell["features"] for cell in cells], np.int64),
        np.array([cell["label"] for cell in cells], np.float64),
        np.array([cell["n"] for cell in cells], np.float64),
    )
    if model is not None:
        calibrate(model, counted)
    return model


def _accepted(model: Trees) -> Column:
    limits = F.array(*[F.lit(t if np.isfinite(t) else 1e9) for t in model.thresholds])
    return F.filter(
        "_found", lambda c: model.column(c["features"]) >= F.get(limits, c["generator"])
    )


def _free(number: int, name: str) -> Column:
    """A generator's accepted spans that overlap none of ``_kept``."""
    own = F.transform(
        F.filter("_found", lambda c: c["generator"] == number),
        lambda c: _span(_kind(name, c["match"]), c["start"], c["match"]),
    )
    return F.filter(
        own,
        lambda s: ~F.exists(
            "_kept", lambda t: (t["start"] < s["end"]) & (s["start"] < t["end"])
        ),
    )


def _kind(generator: str, match: Column) -> Column:
    if generator != "digits":
        return F.lit(generator)
    return F.when(F.length(_digits(match)) >= 13, F.lit("card")).otherwise(F.lit("phone"))


def find(documents: DataFrame, model: Trees | None, text: str = "text") -> DataFrame:
    """All columns plus base_spans and added_spans (arrays of kind, start, end)."""
    columns = [c for c in documents.columns if c not in ("base_spans", "added_spans")]
    rows = _signed(documents.select(*columns), text)
    patterns = _base_patterns() | (_generator_patterns() if model else {})
    rows = _with_places(rows, patterns).withColumn("base_spans", _base_spans())
    if model is None:
        return rows.select(*columns, "base_spans", _none(_SPAN).alias("added_spans"))
    rows = rows.withColumn("_found", _candidates()).withColumns(
        {"_found": _accepted(model), "_kept": F.col("base_spans")}
    )
    # Each step is a column of its own, so that it is worked out once per text.
    for number, name in enumerate(GENERATORS):
        rows = rows.withColumn("_kept", F.concat("_kept", _free(number, name)))
    added = F.slice("_kept", F.size("base_spans") + 1, F.size("_kept"))
    return rows.select(*columns, "base_spans", added.alias("added_spans"))


def listed(spans: Column) -> Column:
    """``kind:start:end`` by kind as listed, then start, joined by commas."""


    def of(kind: str) -> Column:
        own = F.filter(spans, lambda s: s["kind"] == kind)
        return F.array_sort(own, lambda a, b: (a["start"] - b["start"]).cast("int"))

    ordered = [of(kind) for kind in KINDS]
    return F.array_join(
        F.transform(
            F.concat(*ordered),
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def redact(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in angle brackets, overlaps as one."""
    ordered = F.array_sort(spans, lambda a, b: (a["start"] - b["start"]).cast("int"))
    start = F.struct(F.lit(0).cast("long").alias("end"), F.lit("").alias("out"))

    def step(held: Column, s: Column) -> Column:
        between = F.substring(text, (held["end"] + 1).cast("int"), (s["start"] - held["end"]).cast("int"))
        added = F.concat(held["out"], between, F.lit("<"), F.upper(s["kind"]), F.lit(">"))
        return F.struct(
            F.greatest(held["end"], s["end"]).alias("end"),
            F.when(s["start"] >= held["end"], added).otherwise(held["out"]).alias("out"),
        )

    done = F.aggregate(
        ordered,
        start,
        step,
        lambda held: F.concat(held["out"], F.substring(text, (held["end"] + 1).cast("int"), F.length(text))),
    )
    return F.when(F.size(spans) > 0, done).otherwise(text)
