"""What steps keep in workers, in batches and on disk while they run."""

from __future__ import annotations

import os
import time

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rookery.llm import batches, bpe, neardup, substrings, toxicity

public_tokenizers = pytest.importorskip("public_tokenizers")
corpus_pipeline = pytest.importorskip("corpus_pipeline")

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def documents(spark):
    return spark.createDataFrame(
        [(1, "one two three four five six"), (2, None), (3, "")], "doc_id LONG, text STRING"
    )


def largest_batch(spark):
    texts = spark.range(0, 4000, 1, 1).select(F.repeat(F.lit("word "), 1000).alias("text"))

    def measure(found):
        for batch in found:
            yield pa.RecordBatch.from_pydict({"bytes": [batch.nbytes]})

    return max(row["bytes"] for row in texts.mapInArrow(measure, "bytes LONG").collect())


@pytest.mark.parametrize(
    "operator",
    [
        substrings.remove_repeats,
        neardup.deduplicate,
        lambda docs: bpe.encode(docs, RANKS),
        lambda docs: toxicity.score(docs, toxicity.fit([], [])),
    ],
    ids=["substrings", "neardup", "bpe", "toxicity"],
)
def test_workers_get_texts_by_a_few_megabytes(spark, operator):
    spark.conf.unset(LIMIT)
    assert largest_batch(spark) > 15_000_000
    operator(documents(spark)).collect()
    assert largest_batch(spark) < 1.1 * batches.BATCH_BYTES


def plan_of(frame):
    return frame._jdf.queryExecution().toString()


def test_a_text_is_sent_to_the_encoder_once(spark):
    docs = documents(spark)
    assert "_text" not in plan_of(bpe.encode(docs, RANKS))
    renamed = bpe.encode(docs.withColumnRenamed("text", "ids"), RANKS, "ids")
    same = [(row["doc_id"], bytes(row["ids"])) for row in bpe.encode(docs, RANKS).collect()]
    assert renamed.columns == ["doc_id", "ids", "token_bytes"]
    assert sorted((row["doc_id"], bytes(row["ids"])) for row in renamed.collect()) == sorted(same)


def test_pipeline_decodes_in_a_step_of_its_own(spark):
    result = corpus_pipeline.bpe_stage(spark, documents(spark), "")
    assert plan_of(result).split("== Physical Plan ==")[1].count("MapInArrow") == 1
    rows = {row["doc_id"]: row for row in result.collect()}
    assert {k: row["round_trip"] for k, row in rows.items()} == {1: True, 2: True, 3: True}
    assert rows[1]["n_tokens"] > 0 and rows[2]["n_tokens"] == rows[3]["n_tokens"] == 0


def shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    found = set()
    for folder in manager.localDirsString():
        for _, _, names in os.walk(folder):
            found.update(n for n in names if n.startswith("shuffle_") and n.endswith(".data"))
    return found


def test_release_gives_up_files_of_the_step_that_has_just_ended(spark):
    earlier = shuffle_files(spark)
    counts = batches.stage(spark.range(100_000).groupBy(F.col("id") % 1000).count(), "counts")
    own = shuffle_files(spark) - earlier
    assert own
    batches.release(spark)
    deadline = time.time() + 10
    while own & shuffle_files(spark) and time.time() < deadline:
        time.sleep(0.1)
    assert not own & shuffle_files(spark)
    assert counts.count() == 1000
