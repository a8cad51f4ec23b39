"""Near-duplicate classes: banded MinHash, sequential Bayesian pruning, exact confirmation.

Documents are sets of distinct five-word shingles (A-Z lowered; fewer words make one shingle).
Two documents are linked if ``100 * |both| >= 75 * |either|``; a class is what links reach.

1. Every text is read once: 240 MinHash values in 48 bands of five. A link of similarity 0.75
   shares no band with a probability of 2e-6, closer ones far less. Equal sets collapse into
   one representative before anything is compared.
2. Each band bucket names its smallest member as pivot, and each document is compared with
   its smallest pivot: one pair per document, however large a bucket is.
3. Links found so connect most of a bucket. Members outside the bucket's largest class are
   then compared with the members of other classes, in blocks of signatures; pairs within a
   class are never formed. In two rounds each member only hands on the pair that matches best
   in each bucket. In the last round members with any surviving pair bring their texts, and
   the pairs left are confirmed where they meet: only links are written, one per member and
   class, so a group of members that are just too different costs comparisons but no rows.
4. A comparison reads the signatures in batches and stops once the posterior probability of
   a similarity of 0.75 or more (uniform prior) is below ``MISS``. Survivors are confirmed on
   their full shingle sets (64-bit shingle hashes).

Classes are found by repeated minimum and pointer jumping over staged link tables; no link,
class or signature passes through the driver. Null ids and texts, empty texts: a document
without words is linked with nothing. Rows that share a doc_id are told apart by their texts
and linked like any others; ``component_id`` is the smallest doc_id, a null id the smallest
of all and its class's id null. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from rookery.llm.batches import (
    binary_lists,
    distinct,
    freeing,
    key_filter,
    mix,
    release,
    shingles,
    shuffle_partitions,
    slices,
    small_batches,
    stage,
    words,
)

SHINGLE = 5
BANDS, ROWS = 48, 5
HASHES = BANDS * ROWS
MISS = 1e-6
BATCH = 48  # signature values compared before the posterior is looked at
ROUNDS = 2  # rounds in which members hand on their best pair only
CHUNK = 256  # bucket members compared as one block
_NULL_ID = -(2**63)

_random = np.random.default_rng(75)
_FACTORS = _random.integers(1, 2**31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_TERMS = _random.integers(0, 2**32, HASHES, dtype=np.uint32)


def similar(both: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The link rule on intersection and set sizes."""
    return 100 * both >= 75 * (left + right - both)


@lru_cache(maxsize=None)
def fewest_matches(seen: int, miss: float = MISS, similarity: float = 0.75) -> int:
    """Matches among ``seen`` signature values below which a pair is given up.

    With a uniform prior the similarity is Beta(m + 1, seen - m + 1) distributed; its upper
    tail is a binomial sum.
    """
    trials, tail = seen + 1, 0.0
    for matches in range(trials):
        tail += math.comb(trials, matches) * similarity**matches * (
            1 - similarity
        ) ** (trials - matches)
        if tail >= miss:
            return matches
    return trials


# --- signatures -------------------------------------------------------------


def minhash(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A signature per set (rows); sets must not be empty."""
    short = (values >> np.uint64(32)).astype(np.uint32)
    out = np.empty((HASHES, len(bounds) - 1), np.uint32)
    scratch = np.empty(len(short), np.uint32)
    for k in range(HASHES):
        np.multiply(short, _FACTORS[k], out=scratch)
        np.bitwise_xor(scratch, _TERMS[k], out=scratch)
        out[k] = np.minimum.reduceat(scratch, bounds[:-1])
    return np.ascontiguousarray(out.T)


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """One 64-bit key per row and band, different between bands."""
    keys = np.zeros((len(signatures), BANDS), np.uint64)
    bands = signatures.reshape(len(signatures), BANDS, ROWS).astype(np.uint64)
    for r in range(ROWS):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + bands[:, :, r] + np.uint64(1))
    return mix(keys + np.arange(BANDS, dtype=np.uint64))


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Set size, set identity, signature (16 bits a value) and band keys of every text."""
    for batch in slices(batches, "text", 1 << 19):
        values, bounds = distinct(*shingles(words(batch.column("text"), lower=True), SHINGLE))
        sizes = np.diff(bounds)
        full = np.flatnonzero(sizes)
        signatures = np.zeros((len(sizes), HASHES), np.uint16)
        keys = np.zeros((len(sizes), BANDS), np.int64)
        sums = np.zeros((len(sizes), 2), np.uint64)
        if len(full):
            starts = np.append(bounds[full], len(values))
            signed = minhash(values, starts)
            signatures[full] = signed.astype(np.uint16)
            keys[full] = band_keys(signed).view(np.int64)
            sums[full, 0] = np.add.reduceat(mix(values + np.uint64(1)), starts[:-1])
            sums[full, 1] = np.add.reduceat(mix(values + np.uint64(2)), starts[:-1])
        width = np.arange(len(sizes) + 1)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("id"),
                batch.column("tie"),
                pa.array(sizes.astype(np.int64)),
                pa.array(sums[:, 0].view(np.int64)),
                pa.array(sums[:, 1].view(np.int64)),
                binary_lists(signatures.ravel(), width * HASHES),
                pa.ListArray.from_arrays(
                    pa.array((width * BANDS).astype(np.int32)), pa.array(keys.ravel())
                ),
            ],
            names=["id", "tie", "n_shingles", "s1", "s2", "signature", "bands"],
        )


_SIGNED = (
    "id LONG, tie LONG, n_shingles LONG, s1 LONG, s2 LONG, signature BINARY, bands ARRAY<LONG>"
)


# --- comparing --------------------------------------------------------------


def _matrix(column: pa.Array) -> np.ndarray:
    starts = np.frombuffer(column.buffers()[1], np.int32)
    begin = int(starts[column.offset])
    data = np.frombuffer(column.buffers()[2], np.uint16, len(column) * HASHES, begin)
    return data.reshape(len(column), HASHES)


def matched(
    left: np.ndarray, right: np.ndarray, i: np.ndarray, j: np.ndarray, miss: float = MISS
) -> np.ndarray:
    """Equal values of the pairs (left[i], right[j]); 0 for those given up on the way."""
    alive = np.arange(len(i))
    matches = np.zeros(len(i), np.int64)
    for begin in range(0, HASHES, BATCH):
        part = slice(begin, begin + BATCH)
        matches[alive] += (left[i[alive], part] == right[j[alive], part]).sum(axis=1)
        alive = alive[matches[alive] >= fewest_matches(begin + BATCH, miss)]
    out = np.zeros(len(i), np.int64)
    out[alive] = matches[alive]
    return out


def _prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            pairs = np.arange(batch.num_rows)
            left, right = _matrix(batch.column("left")), _matrix(batch.column("right"))
            keep = matched(left, right, pairs, pairs) > 0
            yield batch.select(["a", "b"]).filter(pa.array(keep))


def _runs(batch: pa.RecordBatch, names: list[str]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Stretches of a batch with equal values in ``names`` (integers)."""
    columns = [batch.column(name).to_numpy() for name in names]
    fresh = np.ones(batch.num_rows, bool)
    fresh[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    starts = np.append(np.flatnonzero(fresh), batch.num_rows)
    for begin, end in zip(starts[:-1], starts[1:]):
        yield tuple(int(c[begin]) for c in columns), batch.slice(begin, end - begin)


def _blocks(batches: Iterator[pa.RecordBatch], hold, meet) -> Iterator[pa.RecordBatch]:
    """Walk rows in order of key, block and side.

    A block of light members comes first (side 0) and is held as ``hold(rows)``; the bucket's
    members follow (side 1) in pieces of ``CHUNK`` and meet it as ``meet(held, rows)``. At the
    end of a block ``meet(held, None)`` says what is left to say.
    """
    at, held = None, []
    for batch in batches:
        for (key, block, side), rows in _runs(batch, ["key", "block", "side"]):
            if at != (key, block):
                for one in held:
                    yield from meet(at, one, None)
                at, held = (key, block), []
            if side == 0:
                held.append(hold(rows))
                continue
            for begin in range(0, rows.num_rows, CHUNK):
                for one in held:
                    yield from meet(at, one, rows.slice(begin, CHUNK))
    for one in held:
        yield from meet(at, one, None)


def _wanted(a, c, rows: pa.RecordBatch, both_ways: bool) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of different classes; two light members meet once unless ``both_ways``."""
    b, d = rows.column("rep").to_numpy(), rows.column("comp").to_numpy()
    wanted = c[:, None] != d[None, :]
    if not both_ways:
        heavy = rows.column("heavy").to_numpy(zero_copy_only=False)
        wanted &= heavy[None, :] | (a[:, None] < b[None, :])
    return np.nonzero(wanted)


def _held(rows: pa.RecordBatch) -> dict:
    count = rows.num_rows
    return {
        "rep": rows.column("rep").to_numpy().copy(),
        "comp": rows.column("comp").to_numpy().copy(),
        "signature": _matrix(rows.column("signature")).copy(),
        "most": np.zeros(count, np.int64),
        "other": np.zeros(count, np.int64),
    }


def _best_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each held member's best surviving pair with another class."""

    def meet(_, one: dict, rows: pa.RecordBatch | None) -> Iterator[pa.RecordBatch]:
        if rows is None:
            found = one["most"] > 0
            a, b = one["rep"][found], one["other"][found]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], names=["a", "b"]
            )
            return
        i, j = _wanted(one["rep"], one["comp"], rows, True)
        grid = np.zeros((len(one["rep"]), rows.num_rows), np.int64)
        grid[i, j] = matched(one["signature"], _matrix(rows.column("signature")), i, j)
        first = grid.argmax(axis=1)
        top = grid[np.arange(len(grid)), first]
        better = top > one["most"]
        one["most"][better] = top[better]
        one["other"][better] = rows.column("rep").to_numpy()[first[better]]

    yield from _blocks(batches, _held, meet)


def _active(groups: int):
    """Who has a surviving pair with whom, by groups of light members.

    Light members are dealt over ``groups`` whatever their bucket. Returned are the light
    members with a surviving pair (side 0) and the members that a group meets (side 1).
    """

    def rows_of(side: int, reps: np.ndarray, met: np.ndarray, bounds: np.ndarray):
        lists = pa.ListArray.from_arrays(
            pa.array(bounds.astype(np.int32)), pa.array(met.astype(np.int64))
        )
        sides = pa.array(np.full(len(reps), side, np.int64))
        return pa.RecordBatch.from_arrays(
            [sides, pa.array(reps), lists], names=["side", "rep", "groups"]
        )

    def hold(rows: pa.RecordBatch) -> dict:
        one = _held(rows)
        group = mix(one["rep"].astype(np.uint64)) % np.uint64(groups)
        return one | {"group": group.astype(np.int64)}

    def meet(_, one: dict, rows: pa.RecordBatch | None) -> Iterator[pa.RecordBatch]:
        if rows is None:
            found = one["most"] > 0
            own = one["group"][found]
            yield rows_of(0, one["rep"][found], own, np.arange(len(own) + 1))
            return
        i, j = _wanted(one["rep"], one["comp"], rows, False)
        alive = matched(one["signature"], _matrix(rows.column("signature")), i, j) > 0
        one["most"][i[alive]] = 1
        met = np.unique(np.stack([j[alive], one["group"][i[alive]]]), axis=1)
        members, begins = np.unique(met[0], return_index=True)
        bounds = np.append(begins, met.shape[1])
        yield rows_of(1, rows.column("rep").to_numpy()[members], met[1], bounds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _blocks(batches, hold, meet)

    return run


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact links between held members and those that meet them, one a member and class."""

    def sets(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        return distinct(*shingles(words(rows.column("text"), lower=True), SHINGLE))

    def hold(rows: pa.RecordBatch) -> dict:
        values, bounds = sets(rows)
        order = np.argsort(values, kind="stable")
        owner = np.repeat(np.arange(rows.num_rows), np.diff(bounds))[order]
        return _held(rows) | {
            "values": values[order], "owner": owner, "sizes": np.diff(bounds), "known": set()
        }

    def meet(_, one: dict, rows: pa.RecordBatch | None) -> Iterator[pa.RecordBatch]:
        if rows is None:
            return
        values, bounds = sets(rows)
        i, j = _wanted(one["rep"], one["comp"], rows, False)
        alive = matched(one["signature"], _matrix(rows.column("signature")), i, j) > 0
        i, j = i[alive], j[alive]
        b, d = rows.column("rep").to_numpy(), rows.column("comp").to_numpy()
        links = []
        for n in np.unique(j).tolist():
            own = values[bounds[n] : bounds[n + 1]]
            low = np.searchsorted(one["values"], own, "left")
            count = np.searchsorted(one["values"], own, "right") - low
            place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            both = np.bincount(
                one["owner"][np.repeat(low, count) + place], minlength=len(one["rep"])
            )
            for k in i[j == n][similar(both, one["sizes"], len(own))[i[j == n]]].tolist():
                if (k, d[n]) not in one["known"]:
                    one["known"].add((k, d[n]))
                    links.append((max(one["rep"][k], b[n]), min(one["rep"][k], b[n])))
        yield pa.RecordBatch.from_arrays(
            [pa.array([link[k] for link in links], pa.int64()) for k in (0, 1)], names=["a", "b"]
        )

    yield from _blocks(batches, hold, meet)


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact links, from rows in order of pivot and salt, the pivot's own text first."""
    at, pivot = None, None
    for batch in batches:
        for part in slices([batch], "text"):
            values, bounds = distinct(*shingles(words(part.column("text"), lower=True), SHINGLE))
            columns = (part.column(n).to_pylist() for n in ("b", "salt", "side", "a"))
            links = []
            for n, (b, salt, side, a) in enumerate(zip(*columns)):
                own = values[bounds[n] : bounds[n + 1]]
                if side == 0:
                    at, pivot = (b, salt), own.copy()
                elif at == (b, salt):
                    both = len(np.intersect1d(own, pivot, assume_unique=True))
                    if similar(both, len(own), len(pivot)):
                        links.append((a, b))
            yield pa.RecordBatch.from_arrays(
                [pa.array([link[k] for link in links], pa.int64()) for k in (0, 1)],
                names=["a", "b"],
            )


PAIR = "a LONG, b LONG"


def confirm(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (a, b) that are links on their full sets; ``texts`` holds rep and text.

    The members of a pivot b are dealt over salts of about ``CHUNK`` members; its text goes
    once to each.
    """
    counts = pairs.groupBy("b").agg(F.ceil(F.count("*") / CHUNK).alias("salts"))
    members = (
        pairs.join(counts, "b")
        .withColumn("salt", F.pmod(F.xxhash64("a"), F.col("salts")))
        .join(texts.withColumnRenamed("rep", "a"), "a")
        .select("b", "salt", F.lit(1).alias("side"), "a", "text")
    )
    pivots = (
        counts.join(texts.withColumnRenamed("rep", "b"), "b")
        .withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)))
        .select("b", "salt", F.lit(0).alias("side"), F.col("b").alias("a"), "text")
    )
    return (
        members.unionByName(pivots)
        .repartition(shuffle_partitions(pairs.sparkSession), "b", "salt")
        .sortWithinPartitions("b", "salt", "side")
        .mapInArrow(freeing(_confirm), PAIR)
    )


# --- classes ----------------------------------------------------------------


def components(links: DataFrame) -> DataFrame:
    """Connected components of links (a, b): node, comp (the smallest node that is reached).

    Each round every node points at its smallest neighbour, pointers are followed twice and
    links are contracted to what they point at, until none is left. A round at least halves
    the nodes of a component.
    """
    edges = stage(links.select("a", "b").filter("a != b").distinct(), "links")
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    labels = stage(nodes.select("node", F.col("node").alias("comp")), "labels")
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("to"))
        points = stage(least.select("a", F.least("a", "to").alias("to")), "points")
        further = points.select(F.col("a").alias("to"), F.col("to").alias("next"))
        jumped = stage(
            points.join(further, "to").select(F.col("a").alias("from"), F.col("next").alias("to")),
            "points",
        )
        labels = stage(
            labels.join(jumped.withColumnRenamed("from", "comp"), "comp", "left").select(
                "node", F.coalesce("to", "comp").alias("comp")
            ),
            "labels",
        )
        edges = stage(
            edges.join(jumped.select(F.col("from").alias("a"), F.col("to").alias("x")), "a")
            .join(jumped.select(F.col("from").alias("b"), F.col("to").alias("y")), "b")
            .filter("x != y")
            .select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b"))
            .distinct(),
            "links",
        )
    return labels


def _first_links(buckets: DataFrame, signatures: DataFrame, texts: DataFrame) -> DataFrame:
    """Links between each member and its smallest pivot."""
    pairs = (
        buckets.filter("rep != pivot")
        .groupBy(F.col("rep").alias("a"))
        .agg(F.min("pivot").alias("b"))
    )
    pruned = (
        pairs.join(signatures.toDF("a", "left"), "a")
        .join(signatures.toDF("b", "right"), "b")
        .mapInArrow(freeing(_prune), PAIR)
    )
    return confirm(pruned, texts)


def _mixed(buckets: DataFrame, comps: DataFrame, signatures: DataFrame) -> DataFrame:
    """Rows (key, block, side, rep, comp, heavy, signature) of buckets with several classes.

    Light members, those outside their bucket's largest class, are dealt over blocks of about
    ``CHUNK`` (side 0); all of the bucket's members go to every block of it (side 1).
    """
    members = buckets.join(comps.withColumnRenamed("node", "rep"), "rep", "left").select(
        "key", "rep", F.coalesce("comp", "rep").alias("comp")
    )
    sizes = members.groupBy("key", "comp").agg(F.count("*").alias("n"))
    mixed = (
        sizes.groupBy("key")
        .agg(
            F.sum("n").alias("n"),
            F.max("n").alias("most"),
            F.count("*").alias("classes"),
            F.max_by("comp", "n").alias("largest"),
        )
        .filter("classes > 1")
        .select("key", "largest", F.ceil((F.col("n") - F.col("most")) / CHUNK).alias("blocks"))
    )
    placed = (
        members.join(mixed, "key")
        .withColumn("heavy", F.col("comp") == F.col("largest"))
        .join(signatures, "rep")
    )
    return _dealt(placed)


def _dealt(placed: DataFrame) -> DataFrame:
    every = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    own = F.pmod(F.xxhash64("rep"), F.col("blocks"))
    columns = ["rep", "comp", "heavy", "signature"]
    light = placed.filter("not heavy").select(
        "key", own.alias("block"), F.lit(0).cast("long").alias("side"), *columns
    )
    return light.unionByName(
        placed.select(
            "key", F.explode(every).alias("block"), F.lit(1).cast("long").alias("side"), *columns
        )
    )


def _in_order(rows: DataFrame) -> DataFrame:
    return rows.repartition(
        shuffle_partitions(rows.sparkSession), "key", "block"
    ).sortWithinPartitions("key", "block", "side")


def _best_links(
    buckets: DataFrame, comps: DataFrame, signatures: DataFrame, texts: DataFrame
) -> DataFrame:
    """Links among the best pairs between classes."""
    rows = _in_order(_mixed(buckets, comps, signatures))
    return confirm(rows.mapInArrow(freeing(_best_pairs), PAIR).distinct(), texts)


def _all_links(
    buckets: DataFrame, comps: DataFrame, signatures: DataFrame, texts: DataFrame
) -> DataFrame:
    """All links between classes, one per member and class at least.

    Members bring their text once per group of light members they meet, however many buckets
    they share.
    """
    rows = _mixed(buckets, comps, signatures)
    lights = rows.filter("side = 0").select("rep").distinct().count()
    met = _in_order(rows).mapInArrow(
        freeing(_active(-(-lights // CHUNK) or 1)), "side LONG, rep LONG, groups ARRAY<LONG>"
    )
    active = stage(
        met.groupBy("side", "rep")
        .agg(F.array_distinct(F.flatten(F.collect_set("groups"))).alias("groups"))
        .select(
            F.explode("groups").alias("key"), F.lit(0).cast("long").alias("block"), "side", "rep"
        ),
        "active",
    )
    bringing = (
        active.join(comps.withColumnRenamed("node", "rep"), "rep", "left")
        .withColumns({"comp": F.coalesce("comp", "rep"), "heavy": F.lit(True)})
        .join(signatures, "rep")
        .join(texts, "rep")
    )
    return _in_order(bringing).mapInArrow(freeing(_linked), PAIR).distinct()


def keyed(documents: DataFrame) -> DataFrame:
    """doc_id, text, and what tells a row apart: id (a null is the smallest) and tie."""
    doc_id = F.col("doc_id").cast("long")
    return documents.select(
        doc_id.alias("doc_id"),
        F.coalesce(doc_id, F.lit(_NULL_ID)).alias("id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("tie"),
        "text",
    )


def classes(documents: DataFrame) -> DataFrame:
    """One row per document: id, tie (see ``keyed``), n_shingles, comp, component.

    ``comp`` names the class, ``component`` is its smallest id; both are null for a document
    without words.
    """
    small_batches(documents.sparkSession)
    rows = keyed(documents)
    signed = stage(
        rows.select("id", "tie", "text")
        .mapInArrow(freeing(_signed), _SIGNED)
        .withColumn("row", F.monotonically_increasing_id()),
        "signed",
    )
    identity = ["n_shingles", "s1", "s2"]
    sets = stage(
        signed.filter("n_shingles > 0")
        .groupBy(*identity)
        .agg(F.min("id").alias("low"), F.min("row").alias("rep")),
        "sets",
    )
    bands = stage(
        signed.select(F.col("row").alias("rep"), "bands")
        .join(sets.select("rep"), "rep")
        .select("rep", F.explode("bands").alias("key")),
        "bands",
    )
    shared = stage(
        bands.groupBy("key")
        .agg(F.min("rep").alias("pivot"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("key", "pivot"),
        "shared",
    )
    buckets = stage(
        bands.filter(key_filter(shared, "key")).join(shared, "key"), "buckets"
    )
    involved = stage(buckets.select("rep").distinct(), "involved")
    places = stage(
        signed.select(F.col("row").alias("rep"), "id", "tie", "signature")
        .filter(key_filter(involved, "rep"))
        .join(involved, "rep"),
        "signatures",
    )
    signatures = places.select("rep", "signature")
    owners = places.select("rep", "id", "tie")
    texts = stage(
        rows.select("id", "tie", "text")
        .filter(key_filter(owners, "id"))
        .join(owners, ["id", "tie"])
        .select("rep", "text")
        .dropDuplicates(["rep"]),
        "texts",
    )
    release(documents.sparkSession)
    named = components(_first_links(buckets, signatures, texts))
    for links_of in (*[_best_links] * ROUNDS, _all_links):
        links = stage(_contract(links_of(buckets, named, signatures, texts), named), "links")
        if not links.isEmpty():
            named = stage(_named(named, components(links)), "named")
        release(documents.sparkSession)
    classes = sets.join(named.withColumnRenamed("node", "rep"), "rep", "left").withColumn(
        "comp", F.coalesce("comp", "rep")
    )
    lows = classes.groupBy("comp").agg(F.min("low").alias("component"))
    found = classes.join(lows, "comp").select(*identity, "comp", "component")
    return signed.select("id", "tie", *identity).join(found, identity, "left").drop("s1", "s2")


def near_duplicates(documents: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    lowest = F.coalesce("component", "id")
    return classes(documents).select(
        _real(F.col("id")).alias("doc_id"),
        "n_shingles",
        _real(lowest).alias("component_id"),
        (F.col("id") == lowest).alias("kept"),
    )


def _real(identity: Column) -> Column:
    return F.when(identity != _NULL_ID, identity)


def _contract(links: DataFrame, comps: DataFrame) -> DataFrame:
    """Links between the classes that their ends belong to."""
    ends = links.join(comps.toDF("a", "x"), "a", "left").join(comps.toDF("b", "y"), "b", "left")
    return ends.select(
        F.coalesce("x", "a").alias("a"), F.coalesce("y", "b").alias("b")
    ).filter("a != b")


def _named(first: DataFrame, second: DataFrame) -> DataFrame:
    """Nodes of both rounds with their final class."""
    moved = first.join(second.toDF("comp", "final"), "comp", "left").select(
        "node", F.coalesce("final", "comp").alias("comp")
    )
    return moved.unionByName(second.join(first, "node", "left_anti").select("node", "comp"))


def deduplicate(documents: DataFrame) -> DataFrame:
    """The documents with one row of each class: its smallest id, then its first text by hash.

    Documents without words all stay. Only members of classes of several rows, and the few
    others that a key filter takes for them, are shuffled.
    """
    found = stage(classes(documents).filter("comp IS NOT NULL"), "classes")
    several = stage(
        found.groupBy("comp")
        .agg(F.count("*").alias("n"), F.min(F.struct("id", "tie")).alias("first"))
        .filter("n > 1"),
        "several",
    )
    members = stage(
        found.join(several, "comp").select(
            "id", "tie", (F.struct("id", "tie") == F.col("first")).alias("stays")
        ).distinct(),
        "members",
    )
    rows = documents.select(
        F.struct(*documents.columns).alias("row"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID)).alias("id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("tie"),
    ).withColumn("suspect", key_filter(members, "id"))
    copies = Window.partitionBy("id", "tie").orderBy("id")
    checked = (
        rows.filter("suspect")
        .join(members, ["id", "tie"], "left")
        .withColumn("copy", F.row_number().over(copies))
        .filter("stays IS NULL OR (stays AND copy = 1)")
    )
    return rows.filter("not suspect").select("row.*").unionByName(checked.select("row.*"))
