"""Document fingerprints: the k smallest distinct shingle hashes.

Shingles are five consecutive words, A-Z lowered; a text of fewer words is one shingle. The
sketch of a union is the k smallest of both sketches, so parts of a document or of a corpus
merge. From two sketches follow resemblance, containment and distinct shingle counts; while
a sketch holds fewer than k hashes it is the whole set and its estimates are exact.

A fingerprint is the ascending hashes, eight big-endian bytes each; as text, base64. A null
or empty text, or one without words, has the empty fingerprint: it resembles another empty
one (1.0) and nothing else (0.0).
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from rookery.llm.batches import (
    binary_lists,
    distinct,
    shingles,
    shuffle_partitions,
    slices,
    words,
)

K = 256
SHINGLE = 5
_NULL_ID = -(2**63)


def _bottom(values: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k smallest distinct values of each text, ascending, and their bounds."""
    values, bounds = distinct(values, bounds)
    rank = np.arange(len(values)) - np.repeat(bounds[:-1], np.diff(bounds))
    counts = np.minimum(np.diff(bounds), k)
    return values[rank < k], np.concatenate([[0], np.cumsum(counts)])


def sketch(texts: pa.Array, k: int = K) -> tuple[np.ndarray, np.ndarray]:
    values, bounds = shingles(words(texts, lower=True), SHINGLE)
    return _bottom(values, bounds, k)


def resemblance(left: np.ndarray, right: np.ndarray, k: int = K) -> float:
    """Estimated Jaccard similarity: the shared part of the union's k smallest hashes."""
    if not len(left) or not len(right):
        return 1.0 if len(left) == len(right) else 0.0
    union = np.union1d(left, right)[:k]
    shared = np.intersect1d(left, right, assume_unique=True)
    return float(np.count_nonzero(shared <= union[-1]) / len(union))


def distinct_count(hashes: np.ndarray, k: int = K) -> float:
    if len(hashes) < k:
        return float(len(hashes))
    return (k - 1) / ((float(hashes[-1]) + 1.0) / 2.0**64)


def containment(left: np.ndarray, right: np.ndarray, k: int = K) -> float:
    """Estimated share of the left set that the right set holds."""
    if not len(left):
        return 1.0
    union = np.union1d(left, right)[:k]
    both = distinct_count(union, k) * resemblance(left, right, k)
    return min(1.0, both / distinct_count(left, k))


def decode(fingerprint: str | bytes | None) -> np.ndarray:
    raw = base64.b64decode(fingerprint) if isinstance(fingerprint, str) else fingerprint or b""
    return np.frombuffer(raw, ">u8").astype(np.uint64)


def _encode(hashes: np.ndarray) -> str:
    return base64.b64encode(hashes.astype(">u8").tobytes()).decode()


def fingerprint(documents: DataFrame, text: str = "text", k: int = K) -> DataFrame:
    """All columns plus ``fingerprint`` (binary), from the whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            values, bounds = sketch(batch.column("_text"), k)
            prints = binary_lists(values.astype(">u8"), bounds)
            kept = batch.drop_columns(["_text"])
            yield kept.append_column("fingerprint", prints)

    base = documents.drop("fingerprint")
    schema = base.schema.add("fingerprint", "binary")
    return base.withColumn("_text", F.col(text)).mapInArrow(run, schema)


def merge(fingerprints: DataFrame, keys: list[str], k: int = K) -> DataFrame:
    """One fingerprint per key from those of its parts: keys, fingerprint, distinct_shingles.

    Parts are merged inside every map task first, so a key with very many parts sends one
    sketch per task.
    """

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, np.ndarray] = {}
        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in keys]
            parts = batch.column("fingerprint").to_pylist()
            for *key, part in zip(*columns, parts):
                known = held.get(tuple(key), np.zeros(0, np.uint64))
                held[tuple(key)] = np.union1d(known, decode(part))[:k]
            if len(held) > 4096:
                yield out(held)
                held = {}
        if held:
            yield out(held)

    schema = fingerprints.select(*keys, "fingerprint").schema

    def out(held: dict[tuple, np.ndarray]) -> pa.RecordBatch:
        columns = [list(values) for values in zip(*held)]
        prints = [hashes.astype(">u8").tobytes() for hashes in held.values()]
        return pa.RecordBatch.from_pydict(
            dict(zip([*keys, "fingerprint"], [*columns, prints])), schema=arrow
        )

    arrow = to_arrow_schema(schema)

    def union(parts: pa.Table) -> pa.Table:
        hashes = np.zeros(0, np.uint64)
        for part in parts["fingerprint"].to_pylist():
            hashes = np.union1d(hashes, decode(part))[:k]
        row = parts.slice(0, 1).select(keys)
        row = row.append_column("fingerprint", pa.array([hashes.astype(">u8").tobytes()]))
        return row.append_column("distinct_shingles", pa.array([distinct_count(hashes, k)]))

    result = fingerprints.select(*keys, "fingerprint").schema.add("distinct_shingles", "double")
    thinned = fingerprints.select(*keys, "fingerprint").mapInArrow(thin, schema)
    return thinned.groupBy(*keys).applyInArrow(union, result)


# --- every document against an edit of itself and the next document ----------


def _edited(own: str, following: str) -> str:
    """The last quarter replaced by the start of the following text."""
    cut = len(own) // 4
    return own[: len(own) - cut] + following[:cut]


def _walk(k: int):
    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in slices(batches, "text"):
            texts = batch.column("text").fill_null("")
            values, bounds = sketch(texts, k)
            columns = (
                batch.column("bucket").to_pylist(),
                batch.column("own").to_pylist(),
                batch.column("doc_id").to_pylist(),
                texts.to_pylist(),
            )
            for i, (bucket, own, doc_id, text) in enumerate(zip(*columns)):
                yield bucket, own, doc_id, text, values[bounds[i] : bounds[i + 1]]

    def result(pending: list[tuple]) -> pa.RecordBatch:
        edited = [_edited(text, following) for _, text, _, following, _ in pending]
        values, bounds = sketch(pa.array(edited, pa.string()), k)
        prints = [values[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
        return pa.RecordBatch.from_pydict(
            {
                "doc_id": pa.array([row[0] for row in pending], pa.int64()),
                "n_chars": pa.array([len(row[1]) for row in pending], pa.int64()),
                "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in edited],
                "fingerprint": [_encode(row[2]) for row in pending],
                "edited_fingerprint": [_encode(found) for found in prints],
                "near_edited": [resemblance(r[2], p, k) for r, p in zip(pending, prints)],
                "near_next": [resemblance(r[2], r[4], k) for r in pending],
                "distinct_shingles": [distinct_count(r[2], k) for r in pending],
            }
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, pending, size = None, [], 0
        for now in rows_of(batches):
            if before is not None and before[1] and before[0] == now[0]:
                pending.append((before[2], before[3], before[4], now[3], now[4]))
                size += len(before[3])
                if size > 1 << 19:
                    yield result(pending)
                    pending, size = [], 0
            before = now
        if pending:
            yield result(pending)

    return run


def against_next(documents: DataFrame, k: int = K) -> DataFrame:
    """Fingerprint every text and its edit, and compare with the edit and the next text.

    The next document is that of the next doc_id; the last one's is the first (a single
    document's is itself). A null doc_id counts as the smallest, rows with one doc_id follow
    each other in order of their texts.

    Documents are dealt into consecutive ranges of ids, bounded by ids that occur. The row
    that opens a range also goes, as a mere neighbour, to the end of the range before it, so
    each range is walked on its own. Only range bounds pass through the driver.
    """
    spark = documents.sparkSession
    parts = shuffle_partitions(spark)
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID)).alias("id"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    bounds = rows.agg(
        F.min("id").alias("low"),
        F.percentile_approx("id", [i / parts for i in range(parts)], 100 * parts).alias("at"),
    ).first()
    low = _NULL_ID if bounds["low"] is None else bounds["low"]
    heads = np.array(sorted({low, *(bounds["at"] or [])}), np.int64)

    @F.pandas_udf("long")
    def range_of(ids: pd.Series) -> pd.Series:
        """Twice the number of the id's range, plus one if the id opens it."""
        number = np.searchsorted(heads, ids.to_numpy(), "right") - 1
        return pd.Series(2 * number + (heads[number] == ids.to_numpy()))

    number = F.shiftright("code", 1)
    own = F.struct(number.alias("bucket"), F.lit(True).alias("own"))
    before = F.pmod(number - 1, F.lit(len(heads))).cast("long")
    neighbour = F.struct(before.alias("bucket"), F.lit(False).alias("own"))
    places = F.when(F.col("code") % 2 == 1, F.array(own, neighbour)).otherwise(F.array(own))
    return (
        rows.withColumn("code", range_of("id"))
        .withColumn("place", F.explode(places))
        .select("place.bucket", "place.own", "doc_id", "id", "text")
        .repartitionById(len(heads), F.col("bucket").cast("int"))
        .sortWithinPartitions("bucket", F.desc("own"), "id", "text")
        .select("bucket", "own", "doc_id", "text")
        .mapInArrow(
            _walk(k),
            "doc_id LONG, n_chars LONG, edited_sha256 STRING, fingerprint STRING, "
            "edited_fingerprint STRING, near_edited DOUBLE, near_next DOUBLE, "
            "distinct_shingles DOUBLE",
        )
    )
