"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``nodes`` points of a ring of hashes. A key belongs to the first point at or
after its own hash; a shard takes keys up to its capacity, and keys that find it full continue
clockwise to the next shard that has room. Capacities are whole shares of
``(1 + slack) * rows / shards``; without slack they add up to the rows, so the row counts
of any two shards differ by one at most. A key moves only as far as the ring is full.

Keys between two neighbouring points form an arc and share one order of shards to try, so
only their number matters for who goes where. The table is reduced to counts by arc and
sub-arc; the walk around the ring is planned on these counts, whose number is fixed by the
ring (``shards * nodes * SUBS``), not by the rows. Each row then finds its shard from its
rank in its arc: the sub-arc's offset plus its rank in the sub-arc. A sub-arc is chosen by a
hash of id, size and checksum, so rows that share an id do not share a task.

Everything per row is DataFrame functions. Null ids and texts are keys like any other (size
1, checksum 0); equal rows take neighbouring slots in any order; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rookery.llm.batches import stage

NODES = 64
SUBS = 64


def _point(*parts: Column) -> Column:
    """A place on the ring: a hash without its sign."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 1)


def ring(documents: DataFrame, shards: int, nodes: int = NODES) -> DataFrame:
    """The ring's arcs in clockwise order: arc, end (its point), owner."""
    spark = documents.sparkSession
    owner, node = F.expr(f"CAST(id DIV {nodes} AS INT)"), F.col("id") % nodes
    points = spark.range(shards * nodes).select(
        _point(F.lit("node"), owner, node).alias("end"), owner.alias("owner")
    )
    order = Window.orderBy("end", "owner")
    return points.select((F.row_number().over(order) - 1).alias("arc"), "end", "owner")


def _plan(
    owners: list[int], counts: list[int], shards: int, slack: float
) -> list[tuple[int, int, int, int]]:
    """Which ranks of each arc go to which shard: (arc, from rank, shard, first slot).

    Every arc tries the shards in the order in which their points follow it. In each turn the
    arcs that still hold keys try their next shard, clockwise.
    """
    total, arcs = sum(counts), len(owners)
    roomy = int(total * (1 + slack))
    room = [roomy // shards + (shard < roomy % shards) for shard in range(shards)]
    if slack:
        room = [max(r, -(-total // shards)) for r in room]
    tries: list[list[int]] = []
    order: list[int] = []
    for arc in range(2 * arcs - 1, -1, -1):  # nearest first, wrapping once
        owner = owners[arc % arcs]
        order = [owner, *(shard for shard in order if shard != owner)]
        if arc < arcs:
            tries.append(order)
    tries.reverse()
    placed, used, plan = [0] * arcs, [0] * shards, []
    for turn in range(shards):
        for arc in range(arcs):
            left = counts[arc] - placed[arc]
            if left and turn < len(tries[arc]):
                shard = tries[arc][turn]
                take = min(left, room[shard] - used[shard])
                if take:
                    plan.append((arc, placed[arc], shard, used[shard]))
                    placed[arc] += take
                    used[shard] += take
    return plan


def assign(
    rows: DataFrame, key: str, shards: int, slack: float = 0.0, nodes: int = NODES
) -> DataFrame:
    """All columns plus shard and slot (from 0, without gaps in each shard).

    ``rows`` is written to the shared scratch folder once: pass narrow columns.
    """
    spark = rows.sparkSession
    arcs = ring(rows, shards, nodes).orderBy("arc").collect()  # shards * nodes rows
    # Arc by prefix: the ring is cut into equal cells, each with the arcs that touch it.
    placed = rows.withColumns(
        {
            "_at": _point(F.lit("key"), F.col(key)),
            "_sub": F.pmod(F.xxhash64(F.lit("sub"), *rows.columns), F.lit(SUBS)).cast("int"),
        }
    )
    cells = 1 << max(4, (len(arcs) - 1).bit_length())
    width = (1 << 63) // cells
    ends = [row["end"] for row in arcs]
    lookup, arc = [], 0
    for cell in range(cells):
        while arc < len(ends) and ends[arc] < cell * width:
            arc += 1
        later, bounds = arc, []
        while later < len(ends) and ends[later] < (cell + 1) * width:
            bounds.append(ends[later])
            later += 1
        lookup.append((cell, arc, bounds))
    table = spark.createDataFrame(lookup, "_cell INT, _first INT, _bounds ARRAY<LONG>")
    passed = F.size(F.filter("_bounds", lambda end: end < F.col("_at")))
    located = (
        placed.withColumn("_cell", F.expr(f"CAST(_at DIV {width} AS INT)"))
        .join(F.broadcast(table), "_cell")
        .withColumn("_arc", (F.col("_first") + passed) % len(arcs))
        .drop("_cell", "_first", "_bounds")
    )
    held = stage(located, "ring")

    subs = held.groupBy("_arc", "_sub").agg(F.count("*").alias("n"))
    before = Window.partitionBy("_arc").orderBy("_sub").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stage(
        subs.withColumn("_offset", F.coalesce(F.sum("n").over(before), F.lit(0))), "arcs"
    )
    counts = {r["_arc"]: r["n"] for r in offsets.groupBy("_arc").agg(F.sum("n").alias("n")).collect()}
    plan = _plan(
        [row["owner"] for row in arcs],
        [counts.get(number, 0) for number in range(len(arcs))],
        shards,
        slack,
    )
    by_arc: dict[int, list[tuple[int, int, int]]] = {}
    for number, start, shard, slot in plan:
        by_arc.setdefault(number, []).append((start, shard, slot))
    spans = spark.createDataFrame(
        list(by_arc.items()),
        "_arc INT, _spans ARRAY<STRUCT<start: LONG, shard: INT, slot: LONG>>",
    )
    rank = Window.partitionBy("_arc", "_sub").orderBy("_at", *rows.columns)
    span = F.element_at(
        F.filter("_spans", lambda one: one["start"] <= F.col("_rank")), -1
    )
    return (
        held.withColumn("_rank", F.row_number().over(rank) - 1)
        .join(F.broadcast(offsets.select("_arc", "_sub", "_offset")), ["_arc", "_sub"])
        .withColumn("_rank", F.col("_rank") + F.col("_offset"))
        .join(F.broadcast(spans), "_arc")
        .withColumn("_span", span)
        .select(
            *rows.columns,
            F.col("_span.shard").alias("shard"),
            (F.col("_span.slot") + F.col("_rank") - F.col("_span.start")).alias("slot"),
        )
    )
