"""One local session and a few hand-made games for all tests."""

from __future__ import annotations

import os
import sys
import uuid

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])

from pyspark.sql import SparkSession, functions as F  # noqa: E402

from rookery import schemas, tune  # noqa: E402
from rookery.session import scratch_root  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session)
    session.stop()


@pytest.fixture
def folder(spark):
    """A fresh folder per test under the session's scratch folder."""
    path = f"{scratch_root(spark)}/test-{uuid.uuid4().hex}"
    os.makedirs(path)
    return path


def side(username, rating, result):
    return {"username": username, "rating": rating, "result": result, "uuid": None, "@id": None}


HEADERS = '[Event "Live"]\n[Date "2026.08.15"]\n[ECO "{code}"]\n\n'

UNCLOCKED = " ".join(
    (f"{i // 2 + 1}. " if i % 2 == 0 else "") + f"N{'abcdefgh'[i % 8]}{i % 8 + 1}"
    for i in range(39)
)


def _clock_text(i):
    start = 60.9 if i % 2 == 0 else 60.8
    left = start - (i // 2) * (2.3 if i % 2 == 0 else 1.3333)
    return f"{{[%clk 0:{int(left // 60):02d}:{left % 60:04.1f}]}}"


CLOCKED = " ".join(
    f"{i // 2 + 1}{'.' if i % 2 == 0 else '...'} B{'abcdefgh'[i % 8]}{i % 8 + 1} {_clock_text(i)}"
    for i in range(20)
)


def game(number, **changes):
    """A raw game record; keyword arguments replace fields."""
    record = {
        "url": f"https://games.example.org/live/{number}",
        "uuid": f"u-{number}",
        "pgn": HEADERS.format(code="B90") + UNCLOCKED + " 1-0\n",
        "time_control": "600",
        "time_class": "rapid",
        "rules": "chess",
        "rated": True,
        "end_time": 1_786_795_200,  # 2026-08-15 12:00 UTC
        "fen": f"fen-{number}",
        "eco": "https://games.example.org/openings/Sicilian-Defense-Main-Line",
        "white": side("Anna", 2250, "win"),
        "black": side("Bert", 2190, "checkmated"),
        "_ingested_at": None,
        "_source_endpoint": "player/anna/games/2026/08",
        "year": 2026,
        "month": 8,
    }
    record.update(changes)
    return record


SAMPLES = [
    game(98234571),
    game(
        98234999,
        pgn=HEADERS.format(code="C42") + " ".join(f"{m}. e{m % 8 + 1} d{m % 8 + 1}" for m in range(1, 17))
        + " 1/2-1/2\n",
        white=side("Bert", 2191, "agreed"),
        black=side("Anna", 2249, "agreed"),
        end_time=1_786_881_600,
    ),
    game(
        98235123,
        pgn=HEADERS.format(code="D37") + CLOCKED + " 0-1\n",
        time_control="60",
        time_class="bullet",
        white=side("Anna", 3401, "resigned"),
        black=side("Carl", 3300, "win"),
        end_time=1_787_400_000,  # 2026-08-22
    ),
]


@pytest.fixture
def raw(spark):
    """Builds a raw games DataFrame from records."""

    def build(records=SAMPLES):
        rows = [tuple(r[name] for name in schemas.RAW_GAMES.fieldNames()) for r in records]
        return spark.createDataFrame(rows, schemas.RAW_GAMES)

    return build


def one(df):
    rows = df.collect()
    assert len(rows) == 1, rows
    return rows[0]


def evaluate(spark, *columns):
    """Evaluate literal expressions on one row."""
    return one(spark.range(1).select(*columns))


def values(spark, function, inputs):
    """Apply a Column function to a list of strings."""
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i INT, v STRING")
    return [r[1] for r in frame.select("i", function(F.col("v"))).orderBy("i").collect()]
