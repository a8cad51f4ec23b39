"""Similarity join of shingle sets by parity sketches.

Documents are sets of distinct five-word shingles (A-Z lowered; fewer words make one shingle).
Two are linked if ``100 * |both| >= 80 * |either|``, that is, if they differ in at most a ninth
of their sizes' sum. Classes are what links reach. No step misses a link.

Parity sketches XOR token hashes into bits, so a token that only one of two sets has flips
what it is hashed to:

- Bits: a token flips one of 4 to 8 bits per shingle. The Hamming distance of two sketches is
  at most the symmetric difference, so a pair that differs in more bits than a link may differ
  in shingles is none. Sketches have powers of two as lengths; the longer one is folded.
- Blocks: the hash range is cut into blocks, and a block's word is the XOR of the 64-bit hashes
  of its tokens. A token changes one block, so two sets that differ in d tokens agree in all
  but d blocks.

Sizes are cut into bands that grow by half, each with its own number of blocks (3.5 tokens a
block at the top, more blocks than a link of that band can change). A set has blocks for its
own band and, where a link can reach it, for the next one. Of w words that hold tokens, a link
changes d at most, so linked sets share w - d of them; each keeps its d + 1 first words in an
order that both sets share, those of most tokens first, and one that both keep is left. Sets
with fewer words keep all, empty blocks included, which match only among such sets. Equal words
make a bucket, the pigeonhole join.

Equal sets are one representative. Every member of a bucket is first compared with one pivot,
and classes found so are never compared within. In buckets of at most ``FEW`` members the pairs
of different classes are then listed, each once however many buckets it shares. Larger buckets
are never paired out: what is left of them is compared in blocks of ``CHUNK`` rows; in two
rounds a member hands on its closest pair only, in the last one the texts meet where they are
compared. Bit sketches prune, full sets (64-bit shingle hashes) confirm. Nothing is gathered
on the driver but bounded bitmaps.

Null ids and texts, empty texts: a document without words is linked with nothing. Rows that
share a doc_id are told apart by their texts and linked like others; a null id is the smallest.
Texts of any length are read whole; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rookery.llm import neardup as graph
from rookery.llm.batches import (
    binary_lists,
    distinct,
    key_filter,
    mix,
    shingles,
    shuffle_partitions,
    slices,
    stage,
    words,
)

SHINGLE = 5
CHUNK = graph.CHUNK
FEW = 32  # members of a bucket whose pairs are listed
ROUNDS = 2
TOKENS = 3.5  # tokens a block at the top of a band
_WORDS = 16  # sketch words compared before pairs are given up
_NONE = np.uint64(0x5851F42D4C957F2D)


def similar(both, left, right):
    """The link rule on intersection and set sizes."""
    return 100 * both >= 80 * (left + right - both)


def most_apart(left, right):
    """The largest symmetric difference of linked sets of these sizes."""
    return (left + right) // 9


def _bands() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First size, last size and number of blocks of every band (none: 0)."""
    starts = [1]
    while starts[-1] < 1 << 40:
        starts.append(max(starts[-1] + 1, starts[-1] * 3 // 2))
    first = np.array(starts[:-1], np.int64)
    last = np.array(starts[1:], np.int64) - 1
    apart = most_apart(last, last)
    blocks = np.maximum(np.ceil((last + 1) / TOKENS).astype(np.int64), apart + 3)
    return first, last, np.where(apart > 0, blocks, 0)


FIRST, LAST, BLOCKS = _bands()


# --- sketches ---------------------------------------------------------------


def block_keys(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The keys under which every set is looked up, and their bounds by set.

    ``values`` are the sorted hashes of each set.
    """
    sizes = np.diff(bounds)
    own = np.searchsorted(FIRST, sizes, "right") - 1
    following = np.minimum(own + 1, len(FIRST) - 1)
    reaches = 100 * sizes >= 80 * FIRST[following]
    sets = np.repeat(np.arange(len(sizes)), 2)
    bands = np.stack([own, following], axis=1).ravel()
    used = np.stack([sizes > 0, (sizes > 0) & reaches], axis=1).ravel() & (BLOCKS[bands] > 0)
    sets, bands = sets[used], bands[used]
    if not len(sets):
        return np.zeros(0, np.uint64), np.zeros(len(sizes) + 1, np.int64)

    counts = sizes[sets]
    role = np.repeat(np.arange(len(sets)), counts)
    tokens = values[np.arange(counts.sum()) + np.repeat(bounds[sets] - np.cumsum(counts) + counts, counts)]
    blocks = BLOCKS[bands]
    # hashes ascend, so do their blocks
    block = ((tokens >> np.uint64(32)) * blocks[role].astype(np.uint64)) >> np.uint64(32)
    fresh = np.ones(len(tokens), bool)
    fresh[1:] = (block[1:] != block[:-1]) | (role[1:] != role[:-1])
    begins = np.flatnonzero(fresh)
    held = np.diff(np.append(begins, len(tokens)))
    role, block = role[begins], block[begins]
    word = np.bitwise_xor.reduceat(mix(tokens + np.uint64(3)), begins)
    where = bands[role].astype(np.uint64) << np.uint64(48) | block
    keys = mix(word ^ mix(where + _NONE)) + held.astype(np.uint64)

    apart = most_apart(counts, np.minimum(LAST[bands], counts * 5 // 4))
    full = np.bincount(role, minlength=len(sets))
    order = np.lexsort((keys, -held, role))
    rank = np.arange(len(role)) - np.repeat(np.cumsum(full) - full, full)
    enough = full > apart
    kept = order[~enough[role[order]] | (rank <= apart[role[order]])]
    owner, chosen = [role[kept]], [keys[kept]]
    for one in np.flatnonzero(~enough).tolist():
        empty = np.setdiff1d(np.arange(blocks[one], dtype=np.uint64), block[role == one])
        where = np.uint64(int(bands[one]) << 48) | empty
        owner.append(np.full(len(empty), one))
        chosen.append(mix(where ^ _NONE))
    owner, chosen = sets[np.concatenate(owner)], np.concatenate(chosen)
    order = np.argsort(owner, kind="stable")
    ends = np.cumsum(np.bincount(owner, minlength=len(sizes)))
    return chosen[order], np.concatenate([[0], ends])


def bit_sketches(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every set's size and bits as 64-bit words, and their bounds by set."""
    sizes = np.diff(bounds)
    width = 1 << np.ceil(np.log2(np.maximum(sizes * 4, 64) / 64)).astype(np.int64)
    ends = np.cumsum(width)
    begins = ends - width
    owner = np.repeat(np.arange(len(sizes)), sizes)
    at = (mix(values + np.uint64(4)) & (width[owner] * 64 - 1).astype(np.uint64)).astype(np.int64)
    flips = np.bincount(begins[owner] * 64 + at, minlength=int(ends[-1]) * 64 if len(ends) else 0)
    bits = np.packbits((flips & 1).astype(bool), bitorder="little").view(np.uint64)
    out = np.empty(len(bits) + len(sizes), np.uint64)
    heads = begins + np.arange(len(sizes))
    body = np.ones(len(out), bool)
    body[heads] = False
    out[heads] = sizes
    out[body] = bits
    return out, np.append(heads, len(out))


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Set size, set identity, bit sketch and block keys of every text."""
    for batch in slices(batches, "text", 1 << 19):
        values, bounds = distinct(*shingles(words(batch.column("text"), lower=True), SHINGLE))
        sizes = np.diff(bounds)
        full = np.flatnonzero(sizes)
        sums = np.zeros((len(sizes), 2), np.uint64)
        if len(full):
            starts = bounds[full]
            sums[full, 0] = np.add.reduceat(mix(values + np.uint64(1)), starts)
            sums[full, 1] = np.add.reduceat(mix(values + np.uint64(2)), starts)
        keys, ends = block_keys(values, bounds)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("id"),
                batch.column("tie"),
                pa.array(sizes.astype(np.int64)),
                pa.array(sums[:, 0].view(np.int64)),
                pa.array(sums[:, 1].view(np.int64)),
                binary_lists(*bit_sketches(values, bounds)),
                pa.ListArray.from_arrays(
                    pa.array(ends.astype(np.int32)), pa.array(keys.view(np.int64))
                ),
            ],
            names=["id", "tie", "n_shingles", "s1", "s2", "signature", "keys"],
        )


_SIGNED = (
    "id LONG, tie LONG, n_shingles LONG, s1 LONG, s2 LONG, signature BINARY, keys ARRAY<LONG>"
)


@dataclass
class Sketches:
    """Bit sketches of some rows."""

    flat: np.ndarray
    begins: np.ndarray
    width: np.ndarray
    size: np.ndarray

    @staticmethod
    def of(column: pa.Array) -> Sketches:
        offsets = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4)
        begins = offsets.astype(np.int64)
        data = np.frombuffer(column.buffers()[2], np.uint64, (begins[-1] - begins[0]) // 8, begins[0])
        begins = (begins - begins[0]) // 8
        sizes = data[begins[:-1]].astype(np.int64)
        return Sketches(data.copy(), begins[:-1] + 1, np.diff(begins) - 1, sizes)

    def words(self, rows: np.ndarray, width: int, begin: int) -> np.ndarray:
        """Words from ``begin`` on of sketches folded to a width."""
        columns = np.arange(begin, min(begin + _WORDS, width))
        at = self.begins[rows][:, None] + columns[None, :]
        out = self.flat[at]
        for k in range(1, int(self.width[rows[0]]) // width):
            out = out ^ self.flat[at + k * width]
        return out


def closeness(left: Sketches, right: Sketches, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For pairs (left[i], right[j]): 0 if no link can be, else more for fewer different bits."""
    a, b = left.size[i], right.size[j]
    limit = most_apart(a, b)
    out = np.zeros(len(i), np.int64)
    able = similar(np.minimum(a, b), a, b) & (a > 0) & (b > 0)
    shape = left.width[i] << 32 | right.width[j]
    for both in np.unique(shape[able]).tolist():
        alive = np.flatnonzero(able & (shape == both))
        width = min(both >> 32, both & 0xFFFFFFFF)
        apart = np.zeros(len(i), np.int64)
        for begin in range(0, width, _WORDS):
            one, other = left.words(i[alive], width, begin), right.words(j[alive], width, begin)
            apart[alive] += np.bitwise_count(one ^ other).sum(axis=1, dtype=np.int64)
            alive = alive[apart[alive] <= limit[alive]]
            if not len(alive):
                break
        out[alive] = 1 + limit[alive] - apart[alive]
    return out


# --- comparing --------------------------------------------------------------


def _pairs(a, b) -> pa.RecordBatch:
    a, b = np.asarray(a, np.int64), np.asarray(b, np.int64)
    ends = [pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))]
    return pa.RecordBatch.from_arrays(ends, names=["a", "b"])


def _sets(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return distinct(*shingles(words(rows.column("text"), lower=True), SHINGLE))


def _prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            each = np.arange(batch.num_rows)
            left, right = Sketches.of(batch.column("left")), Sketches.of(batch.column("right"))
            keep = closeness(left, right, each, each) > 0
            yield batch.select(["a", "b"]).filter(pa.array(keep))


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links among rows in order of pivot and salt, the pivot's own text first."""
    at, pivot = None, None
    for batch in batches:
        for part in slices([batch], "text"):
            values, bounds = _sets(part)
            a, b = [], []
            columns = (part.column(name).to_pylist() for name in ("b", "salt", "side", "a"))
            for n, (low, salt, side, high) in enumerate(zip(*columns)):
                own = values[bounds[n] : bounds[n + 1]]
                if side == 0:
                    at, pivot = (low, salt), own.copy()
                elif at == (low, salt):
                    both = len(np.intersect1d(own, pivot, assume_unique=True))
                    if similar(both, len(own), len(pivot)):
                        a.append(high)
                        b.append(low)
            yield _pairs(a, b)


def confirm(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (a, b) that are links on their full sets; ``texts`` holds rep and text.

    A pivot b meets its members in salts of about ``CHUNK``, its text once in each.
    """
    salts = pairs.groupBy("b").agg(F.ceil(F.count("*") / CHUNK).alias("salts"))
    members = (
        pairs.join(salts, "b")
        .join(texts.toDF("a", "text"), "a")
        .select("b", F.pmod(F.xxhash64("a"), F.col("salts")).alias("salt"), F.lit(1).alias("side"), "a", "text")
    )
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1))
    heads = salts.join(texts.toDF("b", "text"), "b").select(
        "b", every.alias("salt"), F.lit(0).alias("side"), F.col("b").alias("a"), "text"
    )
    return (
        members.unionByName(heads)
        .repartition(shuffle_partitions(pairs.sparkSession), "b", "salt")
        .sortWithinPartitions("b", "salt", "side")
        .mapInArrow(_confirm, graph.PAIR)
    )


def _hold(rows: pa.RecordBatch) -> dict:
    count = rows.num_rows
    return {
        "rep": rows.column("rep").to_numpy().copy(),
        "comp": rows.column("comp").to_numpy().copy(),
        "sketch": Sketches.of(rows.column("signature")),
        "most": np.zeros(count, np.int64),
        "other": np.zeros(count, np.int64),
    }


def _near(one: dict, rows: pa.RecordBatch, both_ways: bool) -> tuple[np.ndarray, ...]:
    """Pairs of a held block and rows of other classes that may be links: i, j, closeness."""
    i, j = graph._wanted(one["rep"], one["comp"], rows, both_ways)
    close = closeness(one["sketch"], Sketches.of(rows.column("signature")), i, j)
    found = close > 0
    return i[found], j[found], close[found]


def _closest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each held member's closest pair with another class."""

    def meet(_, one: dict, rows: pa.RecordBatch | None) -> Iterator[pa.RecordBatch]:
        if rows is None:
            found = one["most"] > 0
            yield _pairs(one["rep"][found], one["other"][found])
            return
        i, j, close = _near(one, rows, True)
        order = np.argsort(close, kind="stable")
        i, j, close = i[order], j[order], close[order]
        better = close > one["most"][i]
        one["most"][i[better]] = close[better]  # the closest is written last
        one["other"][i[better]] = rows.column("rep").to_numpy()[j[better]]

    yield from graph._blocks(batches, _hold, meet)


def _active(groups: int):
    """Light members with a possible link (side 0) and the members that meet them (side 1).

    Light members are dealt over ``groups``; a member is sent to every group it meets.
    """

    def send(side: int, reps: np.ndarray, met: list[np.ndarray]) -> pa.RecordBatch:
        bounds = np.concatenate([[0], np.cumsum([len(m) for m in met])]).astype(np.int32)
        flat = np.concatenate([np.zeros(0, np.int64), *met])
        lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat))
        sides = pa.array(np.full(len(reps), side, np.int64))
        return pa.RecordBatch.from_arrays(
            [sides, pa.array(reps), lists], names=["side", "rep", "groups"]
        )

    def hold(rows: pa.RecordBatch) -> dict:
        one = _hold(rows)
        group = mix(one["rep"].astype(np.uint64)) % np.uint64(groups)
        return one | {"group": group.astype(np.int64)}

    def meet(_, one: dict, rows: pa.RecordBatch | None) -> Iterator[pa.RecordBatch]:
        if rows is None:
            found = one["most"] > 0
            yield send(0, one["rep"][found], list(one["group"][found][:, None]))
            return
        i, j, _close = _near(one, rows, False)
        one["most"][i] = 1
        members = np.unique(j)
        met = [np.unique(one["group"][i[j == n]]) for n in members]
        yield send(1, rows.column("rep").to_numpy()[members], met)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from graph._blocks(batches, hold, meet)

    return run


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of held members with those that meet them, one for a member and class."""

    def hold(rows: pa.RecordBatch) -> dict:
        values, bounds = _sets(rows)
        return _hold(rows) | {"values": values, "bounds": bounds, "known": set()}

    def meet(_, one: dict, rows: pa.RecordBatch | None) -> Iterator[pa.RecordBatch]:
        if rows is None:
            return
        i, j, close = _near(one, rows, False)
        values, bounds = _sets(rows)
        rep, comp = rows.column("rep").to_numpy(), rows.column("comp").to_numpy()
        a, b = [], []
        for n in np.argsort(-close, kind="stable").tolist():
            left, right = i[n], j[n]
            if (left, comp[right]) in one["known"]:
                continue
            own = one["values"][one["bounds"][left] : one["bounds"][left + 1]]
            other = values[bounds[right] : bounds[right + 1]]
            both = len(np.intersect1d(own, other, assume_unique=True))
            if similar(both, len(own), len(other)):
                one["known"].add((left, comp[right]))
                a.append(one["rep"][left])
                b.append(rep[right])
        yield _pairs(a, b)

    yield from graph._blocks(batches, hold, meet)


# --- classes ----------------------------------------------------------------


def _pruned(pairs: DataFrame, signatures: DataFrame, texts: DataFrame) -> DataFrame:
    """The links among pairs (a, b)."""
    both = pairs.join(signatures.toDF("a", "left"), "a").join(signatures.toDF("b", "right"), "b")
    return confirm(stage(both.mapInArrow(_prune, graph.PAIR), "pairs"), texts)


def _first_links(buckets: DataFrame, signatures: DataFrame, texts: DataFrame) -> DataFrame:
    """Links between each member and its smallest pivot."""
    pairs = (
        buckets.filter("rep != pivot")
        .groupBy(F.col("rep").alias("a"))
        .agg(F.min("pivot").alias("b"))
    )
    return _pruned(pairs, signatures, texts)


def _few_links(buckets, comps, signatures, texts) -> DataFrame:
    """All links between classes in buckets of few members."""
    members = (
        buckets.filter(F.col("n") <= FEW)
        .join(comps.withColumnRenamed("node", "rep"), "rep", "left")
        .select("key", "rep", F.coalesce("comp", "rep").alias("comp"))
    )
    pairs = (
        members.toDF("key", "a", "c")
        .join(members.toDF("key", "b", "d"), "key")
        .filter("a > b AND c != d")
        .select("a", "b")
        .distinct()
    )
    return _pruned(pairs, signatures, texts)


def _many(buckets: DataFrame) -> DataFrame:
    return buckets.filter(F.col("n") > FEW)


def _closest_links(buckets, comps, signatures, texts) -> DataFrame:
    """Links among the closest pairs between classes."""
    rows = graph._in_order(graph._mixed(_many(buckets), comps, signatures))
    return confirm(stage(rows.mapInArrow(_closest, graph.PAIR).distinct(), "pairs"), texts)


def _all_links(buckets, comps, signatures, texts) -> DataFrame:
    """Links between classes, one per member and class at least."""
    rows = graph._mixed(_many(buckets), comps, signatures)
    lights = rows.filter("side = 0").select("rep").distinct().count()
    met = graph._in_order(rows).mapInArrow(
        _active(-(-lights // CHUNK) or 1), "side LONG, rep LONG, groups ARRAY<LONG>"
    )
    active = stage(
        met.select("side", "rep", F.explode("groups").alias("key"))
        .distinct()
        .withColumn("block", F.lit(0).cast("long")),
        "active",
    )
    bringing = (
        active.join(comps.withColumnRenamed("node", "rep"), "rep", "left")
        .withColumns({"comp": F.coalesce("comp", "rep"), "heavy": F.lit(True)})
        .join(signatures, "rep")
        .join(texts, "rep")
    )
    return graph._in_order(bringing).mapInArrow(_linked, graph.PAIR).distinct()


def classes(documents: DataFrame) -> DataFrame:
    """One row per document: id, tie (see ``neardup.keyed``), n_shingles, component.

    ``component`` is the smallest id of the class, null for a document without words.
    """
    rows = graph.keyed(documents)
    signed = stage(
        rows.select("id", "tie", "text")
        .mapInArrow(_signed, _SIGNED)
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
    # a few that only seem to be representatives may pass: they link with their own
    keys = (
        signed.filter("n_shingles > 0")
        .select(F.col("row").alias("rep"), "keys")
        .filter(key_filter(sets, "rep"))
        .select("rep", F.explode("keys").alias("key"))
    )
    shared = stage(
        keys.groupBy("key")
        .agg(F.min("rep").alias("pivot"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("key", "pivot", "n"),
        "shared",
    )
    buckets = stage(keys.filter(key_filter(shared, "key")).join(shared, "key"), "buckets")
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
    named = graph.components(_first_links(buckets, signatures, texts))
    for links_of in (_few_links, *[_closest_links] * ROUNDS, _all_links):
        links = stage(graph._contract(links_of(buckets, named, signatures, texts), named), "links")
        if not links.isEmpty():
            named = stage(graph._named(named, graph.components(links)), "named")
    found = sets.join(named.withColumnRenamed("node", "rep"), "rep", "left").withColumn(
        "comp", F.coalesce("comp", "rep")
    )
    lows = found.groupBy("comp").agg(F.min("low").alias("component"))
    labelled = found.join(lows, "comp").select(*identity, "component")
    return signed.select("id", "tie", *identity).join(labelled, identity, "left").drop("s1", "s2")


def linked_classes(documents: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    return classes(documents).select(
        graph._real(F.col("id")).alias("doc_id"),
        "n_shingles",
        graph._real(F.coalesce("component", "id")).alias("component_id"),
    )
