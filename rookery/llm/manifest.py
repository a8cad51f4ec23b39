"""Merkle manifest of a dataset, and its check by a recursive query that climbs the tree.

Every row is a leaf: H of its columns, where H is the SHA-256 of the concatenated inputs and
digests enter as lower-case hex. The leaves of a group ascend by ``order``. While a level has
several nodes, every ``FAN`` consecutive ones (the last run may be shorter) become their H;
what remains is the group's subroot. The subroots, in order of their groups, likewise give the
root.

``build`` stores the tree as two tables. ``runs`` has one row per run of leaves. ``nodes`` has
the inner nodes but the root: node, parent, and the digests of the siblings to its left and
right. ``climb`` joins them in a recursive common table expression: every step takes the
claimed digests of a run's leaves to the parent, folds each into the parent's digest and
appends the siblings that were used. The leaves of one run have the same siblings above it, so
they travel in one row with one list of siblings.

Near the root all leaves meet few nodes. Nodes above ``STRETCH`` leaves are therefore stored
once per stretch of that many leaves, linked to the copies of their parents: no node row is
met by more than ``STRETCH`` leaves, at a price of one row per level and stretch. Leaves are
numbered in ranges of their order, never in one task per group.

Null values are leaves like others (``-``); a null group comes first, a null id is the smallest
of its group. Equal rows are equal leaves side by side. Texts of any length are hashed whole.
An empty table has an empty manifest and no root. Columns that are not named are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from rookery.llm.batches import shuffle_partitions, stage

FAN = 8
STRETCH_LEVEL = 3
STRETCH = FAN**STRETCH_LEVEL
TOP = 32  # level number of subroots; the levels above them count on
_LEVEL_BIT = 56  # node number: level, then the place of a leaf
_ROW_LIMIT = "spark.sql.cteRecursionRowLimit"

CLIMB = """
    WITH RECURSIVE climb(run, node, folded, siblings) AS (
        SELECT run, node, folded, CAST('' AS BINARY) FROM {start}
        UNION ALL
        SELECT c.run, n.parent,
               transform(c.folded, d -> unhex(sha2(
                   concat(lower(hex(n.before)), lower(hex(d)), lower(hex(n.after))), 256))),
               concat(c.siblings, n.before, n.after)
        FROM climb c JOIN {nodes} n ON n.node = c.node
    )
    SELECT run, folded, siblings FROM climb WHERE node IS NULL
"""


@dataclass
class Manifest:
    runs: DataFrame  # run, node, alone, first, leaves (slot, id, leaf, claim)
    nodes: DataFrame  # node, parent, before, after
    groups: DataFrame  # first, group, subroot
    root: str | None


def leaf(columns: dict[str, Column]) -> Column:
    """H of a row: every value as byte count, colon and text; a null as a dash."""
    parts = []
    for value in columns.values():
        text = value.cast("string")
        parts.append(
            F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
        )
    return F.unhex(F.sha2(F.concat(*parts), 256))


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _combined(digests: Column) -> Column:
    """H of an array of digests."""
    return F.unhex(F.sha2(F.array_join(F.transform(digests, _hex), ""), 256))


def _joined(digests: Column) -> Column:
    """An array of digests as one binary."""
    return F.aggregate(digests, F.lit(b""), lambda done, one: F.concat(done, one))


def _ranked(leaves: DataFrame, order: list[str]) -> DataFrame:
    """All rows with their place in the order (from 0), numbered in ranges."""
    spark = leaves.sparkSession
    local = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    dealt = (
        leaves.repartitionByRange(shuffle_partitions(spark), *order)
        .sortWithinPartitions(*order)
        .withColumns({"part": F.spark_partition_id(), "at": local})
    )
    held = stage(dealt, "ranked")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = held.groupBy("part").agg(F.count("*").alias("n"))  # one row per partition
    begins = counts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("begin"))
    return (
        held.join(F.broadcast(begins), "part")
        .withColumn("place", F.col("begin") + F.col("at"))
        .drop("part", "at", "begin")
    )


def _height(count: Column) -> Column:
    """Levels above the leaves until one node is left."""
    powers = F.array(*[F.lit(FAN**k) for k in range(19)])
    return F.size(F.filter(powers, lambda p: p < count))


def _number(level: Column | int, place: Column) -> Column:
    level = level if isinstance(level, Column) else F.lit(level)
    return F.shiftleft(level.cast("long"), _LEVEL_BIT) + place


def _levels(level: DataFrame, most: int, name: str) -> list[DataFrame]:
    """Runs of every level: first, n, index (of the parent), members (k, digest).

    ``level`` has first, n (a tree's first leaf place and number of leaves), k and digest.
    """
    runs, size = [], 1
    while size < most:
        made = stage(
            level.filter(F.col("n") > size)
            .groupBy("first", "n", F.expr(f"k DIV {FAN}").alias("index"))
            .agg(F.sort_array(F.collect_list(F.struct("k", "digest"))).alias("members"))
            .withColumn("digest", _combined(F.col("members.digest"))),
            name,
        )
        runs.append(made)
        level = made.select("first", "n", F.col("index").alias("k"), "digest")
        size *= FAN
    return runs


def _beside(members: Column, k: Column) -> tuple[Column, Column]:
    """Digests of a member's left and right siblings, each joined."""

    def side(keep) -> Column:
        return _joined(F.transform(F.filter(members, keep), lambda m: m["digest"]))

    return side(lambda m: m["k"] < k), side(lambda m: m["k"] > k)


def _siblings(runs: DataFrame) -> DataFrame:
    """Every member of the runs with its siblings: first, n, index, k, before, after."""
    each = runs.select("first", "n", "index", "members", F.explode("members.k").alias("k"))
    before, after = _beside(F.col("members"), F.col("k"))
    return each.select(
        "first", "n", "index", "k", before.alias("before"), after.alias("after")
    )


def _group_nodes(runs: DataFrame, level: int, single: bool) -> DataFrame:
    """Node rows of one level (1 or more) inside the groups."""
    unit = FAN ** min(level, STRETCH_LEVEL)
    per = FAN**level // unit
    last = F.least((F.col("k") + 1) * per, F.expr(f"(n + {unit - 1}) DIV {unit}")) - 1
    copies = _siblings(runs).withColumn(
        "stretch", F.explode(F.sequence((F.col("k") * per).cast("long"), last.cast("long")))
    )
    at = F.col("stretch") * unit
    wide = FAN ** min(level + 1, STRETCH_LEVEL)
    own = F.col("first") + at
    above = F.col("first") + F.expr(f"stretch * {unit} DIV {wide}") * wide
    top = F.lit(None).cast("long") if single else _number(TOP, above)
    parent = F.when(F.col("n") <= FAN ** (level + 1), top).otherwise(_number(level + 1, above))
    return copies.select(
        _number(level, own).alias("node"), parent.alias("parent"), "before", "after"
    )


def _top_nodes(runs: DataFrame, level: int, groups: DataFrame, count: int) -> DataFrame:
    """Node rows of one level over the groups, one per stretch of every group below."""
    unit = F.least(F.lit(STRETCH), F.pow(F.lit(FAN), F.col("height"))).cast("long")
    last = F.expr("(n + unit - 1) DIV unit") - 1
    below = (
        groups.select("first", "n", unit.alias("unit"), F.expr(f"number DIV {FAN**level}").alias("k"))
        .join(_siblings(runs).select("k", "before", "after"), "k")
        .withColumn("stretch", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    )
    own = F.col("first") + F.col("stretch") * F.col("unit")
    root = FAN ** (level + 1) >= count
    parent = F.lit(None).cast("long") if root else _number(TOP + level + 1, own)
    return below.select(
        _number(TOP + level, own).alias("node"), parent.alias("parent"), "before", "after"
    )


def build(
    documents: DataFrame,
    columns: list[str],
    group: str,
    order: str,
    shown: dict[str, Column] | None = None,
) -> Manifest:
    """The manifest of ``documents``, as staged tables.

    ``columns`` make a leaf. ``shown`` replaces columns by what a copy of the dataset shows
    for them; the digest of that row is the leaf's ``claim``, which ``climb`` checks.
    """
    own = {name: F.col(name) for name in columns}
    digests = stage(
        documents.select(
            F.col(group).alias("group"),
            F.col(order).alias("id"),
            leaf(own).alias("leaf"),
            leaf(own | (shown or {})).alias("claim"),
        ).withColumn("row", F.monotonically_increasing_id()),
        "leaves",
    )
    placed = stage(_ranked(digests, ["group", "id", "leaf", "row"]), "places")
    groups = stage(
        placed.groupBy("group").agg(F.min("place").alias("first"), F.count("*").alias("n")),
        "groups",
    )
    sizes = groups.agg(F.count("*"), F.max("n")).first()
    count, most = sizes[0], sizes[1] or 0

    leaves = placed.join(
        groups.withColumnRenamed("group", "of"), F.col("group").eqNullSafe(F.col("of"))
    ).withColumn("k", F.col("place") - F.col("first"))
    level_one = F.when(F.col("n") > FAN, _number(1, F.col("run")))
    over = F.lit(None).cast("long") if count == 1 else _number(TOP, F.col("first"))
    bottom = stage(
        leaves.groupBy("first", "n", F.expr(f"k DIV {FAN}").alias("index"))
        .agg(F.sort_array(F.collect_list(F.struct("k", "id", "leaf", "claim"))).alias("leaves"))
        .withColumn("run", F.col("first") + F.col("index") * FAN)
        .select(
            "run",
            F.coalesce(level_one, over).alias("node"),
            (F.col("n") == 1).alias("alone"),
            "first",
            "n",
            "index",
            "leaves",
        ),
        "runs",
    )
    lowest = F.when(F.col("alone"), F.col("leaves")[0]["leaf"]).otherwise(
        _combined(F.col("leaves.leaf"))
    )
    first_level = bottom.select("first", "n", F.col("index").alias("k"), lowest.alias("digest"))
    upper = _levels(
        first_level.withColumn("n", F.expr(f"(n + {FAN - 1}) DIV {FAN}")),
        -(-most // FAN),
        "inner",
    )
    subroots = first_level.filter(F.col("n") <= FAN).select("first", "digest")
    for level, runs in enumerate(upper, 1):
        done = runs.filter(F.col("n") <= FAN**level).select("first", "digest")
        subroots = subroots.unionByName(done)
    numbered = _ranked(groups, ["group"]).withColumnRenamed("place", "number")
    named = stage(
        numbered.join(subroots, "first").withColumn("height", _height(F.col("n"))), "subroots"
    )
    tops = _levels(
        named.select(
            F.lit(0).cast("long").alias("first"), F.lit(count).cast("long").alias("n"),
            F.col("number").alias("k"), "digest",
        ),
        count,
        "top",
    )
    parts = [
        # n counts leaves again: a stretch is a number of leaves
        _group_nodes(
            runs.join(groups.select("first", F.col("n").alias("all")), "first")
            .withColumn("n", F.col("all")),
            level,
            count == 1,
        )
        for level, runs in enumerate(upper, 1)
    ]
    parts += [_top_nodes(runs, level, named, count) for level, runs in enumerate(tops)]
    nodes = documents.sparkSession.createDataFrame(
        [], "node LONG, parent LONG, before BINARY, after BINARY"
    )
    for part in parts:
        nodes = nodes.unionByName(part)
    last = (tops[-1] if tops else named).select(_hex(F.col("digest"))).first()
    return Manifest(
        bottom,
        stage(nodes, "nodes"),
        named.select("first", "group", _hex(F.col("digest")).alias("subroot")),
        last[0] if last else None,
    )


def climb(manifest: Manifest) -> DataFrame:
    """One row per leaf: group, id, leaf, subroot, proof, folded.

    ``proof`` is all siblings on the way to the root, lowest first, left to right; ``folded``
    is the root that the leaf's claim and this proof give.
    """
    spark = manifest.runs.sparkSession
    leaves = F.col("leaves")

    def fold(one: Column) -> Column:
        rest = F.transform(
            leaves,
            lambda other: F.when(other["k"] == one["k"], other["claim"]).otherwise(other["leaf"]),
        )
        return F.when(F.col("alone"), one["claim"]).otherwise(_combined(rest))

    start = manifest.runs.select("run", "node", F.transform("leaves", fold).alias("folded"))
    limit = spark.conf.get(_ROW_LIMIT)
    spark.conf.set(_ROW_LIMIT, "-1")  # the climb has a row per run and level
    try:
        reached = stage(spark.sql(CLIMB, start=start, nodes=manifest.nodes), "climbed")
    finally:
        spark.conf.set(_ROW_LIMIT, limit)
    each = manifest.runs.join(reached, "run").select(
        "first", "leaves", "folded", "siblings", F.posexplode("leaves").alias("slot", "one")
    )
    beside = F.filter(leaves, lambda other: other["k"] != F.col("one.k"))
    return each.join(manifest.groups, "first").select(
        "group",
        F.col("one.id").alias("id"),
        _hex(F.col("one.leaf")).alias("leaf"),
        "subroot",
        F.concat(
            F.array_join(F.transform(beside, lambda other: _hex(other["leaf"])), ""),
            _hex(F.col("siblings")),
        ).alias("proof"),
        _hex(F.get("folded", F.col("slot"))).alias("folded"),
    )
