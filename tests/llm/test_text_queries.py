"""Registered text queries on the smallest tables: SQL, brute force and held-out accuracy."""

from __future__ import annotations

import base64
import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from rookery.llm import queries
from rookery.llm.batches import stage
from tests.compare import differences, duck
from tests.conftest import SMALL
from tests.llm.test_text_operators import base_spans, brute_strip, shingle_set

tiktoken = pytest.importorskip("tiktoken")
public_tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def texts(spark):
    return dict(
        (r.doc_id, r.text or "") for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    )


def result(spark, name):
    return {r["doc_id"]: r for r in queries.QUERIES[name](spark, SMALL).collect()}


def test_all_operators_are_registered():
    numbers = {name.split("_")[0] for name in queries.QUERIES}
    assert numbers == {f"op{n}" for n in range(1, 14)}
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query_matches_sql(spark, name):
    connection = duck(SMALL)
    assert differences(queries.QUERIES[name](spark, SMALL), connection, queries.ORACLES[name]) == []
    connection.close()


def test_fingerprints(spark, texts):
    found = result(spark, "op1_fingerprints")
    order = sorted(texts)
    for doc_id, other in zip(order, order[1:] + order[:1]):
        row, text = found[doc_id], texts[doc_id]
        cut = len(text) // 4
        edit = text[: len(text) - cut] + texts[other][:cut]
        assert row.edited_sha256 == hashlib.sha256(edit.encode()).hexdigest()
        one, two = shingle_set(text), shingle_set(edit)
        exact = len(one & two) / len(one | two) if one | two else 1.0
        assert abs(row.near_edited - exact) < 0.16


def test_shards(spark, texts):
    found = result(spark, "op2_ring")
    slots = {}
    for doc_id, row in found.items():
        raw = texts[doc_id].encode()
        assert (row["size"], row.text_crc32) == (len(raw) + 1, zlib.crc32(raw))
        slots.setdefault(row.shard, []).append(row.slot)
    assert set(slots) == set(range(16)) and len(found) == len(texts)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_personal_data(spark, texts):
    for doc_id, row in result(spark, "op3_pii").items():
        spans = base_spans(texts[doc_id])
        assert row.base_sha256 == hashlib.sha256(spans.encode()).hexdigest()
        assert set(filter(None, spans.split(","))) <= set(row.spans.split(","))


def test_toxicity(spark, texts):
    found = result(spark, "op4_toxicity")
    assert set(found) == set(texts)
    for doc_id, row in found.items():
        assert row.held_out == (zlib.crc32(str(doc_id).encode()) % 3 == 1)
        assert 0 <= row.score <= 1 and row.predicted == (row.score >= 0.7)


def test_toxicity_is_accurate_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    found = queries.op4_toxicity(spark, folder).filter("held_out")
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    rows = np.array(found.join(labels, "doc_id").select("score", "toxic").collect(), float)
    rank = rows[:, 0].argsort().argsort() + 1
    ones = rows[:, 1].sum()
    area = (rank[rows[:, 1] == 1].sum() - ones * (ones + 1) / 2) / (ones * (len(rows) - ones))
    assert area > 0.85
    assert (rows[rows[:, 1] == 0, 0] >= 0.7).mean() < 0.02


def test_mixing_meets_its_targets(spark):
    rows = queries.op5_mixing(spark, SMALL)
    totals = rows.agg(
        *[F.sum(F.expr(f"tokens * rate * p_{n}")).alias(n) for n in ("good", "plain", "toxic")],
        F.sum("tokens").alias("all"),
    ).first()
    for name, share in (("good", 0.6), ("plain", 0.3), ("toxic", 0.1)):
        assert abs(totals[name] / totals["all"] - share) < 0.005


def test_posteriors_are_accurate_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    labels = queries.domain_labels(spark.read.parquet(f"{folder}/labels.parquet"))
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    documents = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    names = ["good", "plain", "toxic"]
    mixed = queries.mixing.mix(
        documents, labels.filter(~held_out), dict.fromkeys(names, 1 / 3), kept=["doc_id"]
    )
    rows = mixed.filter(held_out).join(labels, "doc_id").select("posterior", "domain").collect()
    for k, name in enumerate(names):
        scores = np.array([r.posterior[k] for r in rows])
        truth = np.array([r.domain == name for r in rows])
        one, other = scores[truth][:, None], scores[~truth][None, :]
        area = ((one > other) + 0.5 * (one == other)).mean()
        assert area > 0.8, (name, area)


def test_token_ids(spark, texts):
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    reference = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    plain, files = result(spark, "op7_bpe"), result(spark, "op6_rangecoder")
    start = 0
    for doc_id in sorted(texts):
        ids = reference.encode_ordinary(texts[doc_id])
        row = plain[doc_id]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(texts[doc_id].encode()).hexdigest()
        row = files[doc_id]
        ended = np.array([*ids, 0], "<u4").tobytes()
        assert (row.start, row.n_tokens, row.ids_crc32) == (start, len(ids) + 1, zlib.crc32(ended))
        start += len(ids) + 1


def test_repeats(spark, texts):
    expected = brute_strip(list(texts.items()))
    for doc_id, row in result(spark, "op10_substrings").items():
        count, gone, kept = expected[doc_id, texts[doc_id]]
        digest = hashlib.sha256(kept.encode()).hexdigest()
        assert (row.n_words, row.n_removed, row.kept_sha256) == (count, gone, digest)


# --- pipeline ---------------------------------------------------------------


def test_pipeline_stages_in_turn(spark, texts):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").withColumn("score", F.lit("mine"))
    columns = docs.columns
    held = stage(docs, "start")
    for name, function in corpus_pipeline.STAGES:
        before, held = held, stage(function(spark, held, SMALL), name)
        if name == "toxicity":
            assert held.columns == columns
            assert held.select("doc_id").exceptAll(before.select("doc_id")).isEmpty()
        elif name == "near_duplicates":
            rows = [(r.doc_id, shingle_set(r.text)) for r in before.collect()]
            kept = {r.doc_id for r in held.collect()}
            alone = {
                a for a, x in rows
                if not any(x and a != b and 100 * len(x & y) >= 75 * len(x | y) for b, y in rows)
            }
            assert alone <= kept and len(kept) == held.count() < before.count()
            left = [(a, x) for a, x in rows if a in kept]
            for n, (_, x) in enumerate(left):
                for _, y in left[:n]:
                    assert not (x and 100 * len(x & y) >= 75 * len(x | y))
        elif name == "personal_data":
            assert held.columns == columns and held.count() == before.count()
            assert all(base_spans(r.text) == "" for r in held.collect())
        elif name == "mixing":
            assert held.columns == columns
            assert {r.doc_id for r in held.collect()} == {r.doc_id for r in before.collect()}
        else:
            assert held.filter("NOT round_trip").isEmpty() and held.count() == before.count()


def test_pipeline_of_awkward_rows(spark):
    schema = spark.read.parquet(f"{SMALL}/documents.parquet").schema
    rows = [(1, None, None, None, None), (None, "", "en", "s", 0), (3, "a@b.cc " * 30, "en", "s", 5)]
    rows += [(4, "one two three", None, None, 3), (4, "one two three", None, None, 3)]
    for given in (rows, []):
        docs = spark.createDataFrame(given, schema)
        for _, function in corpus_pipeline.STAGES:
            docs = function(spark, docs, SMALL)
        assert docs.count() == max(0, len(given) - 1)
