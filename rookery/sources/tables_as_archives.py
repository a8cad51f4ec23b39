"""Game archives derived from the star-schema test tables.

Every order becomes a game record (a third of them landed twice, as games of
two tracked players are) and every customer a player, by integer arithmetic on
the keys. Dates, results and formats come from the table columns. The records
have the faults real archives have: unreadable URLs, missing times and ratings,
unmapped result codes, games without moves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rookery import schemas
from rookery.operators.once import evaluate_once

SITE = "https://games.example.org"
# 1995-01-01 UTC. Eight order days make one day of play, so that players meet
# several games a day.
DAY_ZERO = 788918400


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_GAME = {
    "url": f"""CASE WHEN k % 211 = 0 THEN '{SITE}/live/none'
                    WHEN k % 97 = 0 THEN concat('{SITE}/live/', k + 1, '/')
                    ELSE concat('{SITE}/live/', k + 1) END""",
    "uuid": "concat('g-', k)",
    "pgn": "game_text",
    "time_control": """CASE f WHEN '1' THEN CASE WHEN k % 2 = 0 THEN '60' ELSE '60+1' END
                              WHEN '2' THEN '180+2' WHEN '3' THEN '600'
                              WHEN '4' THEN '1/259200' ELSE '900+10' END""",
    "time_class": """CASE f WHEN '1' THEN 'Bullet' WHEN '2' THEN 'blitz' WHEN '3' THEN 'Rapid'
                            WHEN '4' THEN 'daily' ELSE 'puzzle' END""",
    "rules": """CASE WHEN k % 53 = 5 THEN NULL WHEN k % 29 = 3 THEN 'threecheck'
                     ELSE 'chess' END""",
    "rated": "CASE WHEN k % 101 = 1 THEN NULL ELSE k % 10 <> 0 END",
    "end_time": "CASE WHEN k % 503 = 1 THEN NULL ELSE ended END",
    "fen": "concat('fen-', k)",
    "eco": f"""CASE WHEN k % 47 = 0 THEN NULL
                    ELSE concat('{SITE}/openings/Opening-', k % 20, '-Line-', (k div 20) % 3,
                                CASE WHEN k % 6 = 0 THEN '/' ELSE '' END) END""",
    "white": """named_struct('username', concat('Player', c),
                  'rating', CASE WHEN k % 113 = 7 THEN NULL ELSE 1500 + (k * 37 + c) % 1500 + copy END,
                  'result', CASE s WHEN 'F' THEN 'win' ELSE reason END,
                  'uuid', concat('u-', c), '@id', concat('id-', c))""",
    "black": """named_struct('username', CASE WHEN k % 601 = 2 THEN NULL
                    ELSE concat('PLAYER', CASE WHEN k % 401 = 0 THEN c ELSE c + 1 + k % 7 END) END,
                  'rating', 1500 + (k * 53 + c * 3) % 1500,
                  'result', CASE s WHEN 'O' THEN 'win' ELSE reason END,
                  'uuid', CAST(NULL AS STRING), '@id', CAST(NULL AS STRING))""",
    "_ingested_at": """timestamp_seconds(placed + 2592000
                         + CASE WHEN k % 9 = 0 THEN 0 ELSE copy * 3600 END)""",
    "_source_endpoint": "concat('player/', CASE copy WHEN 0 THEN 'p' ELSE 'a' END, c, '/games')",
    "year": "year(timestamp_seconds(ended))",
    "month": "month(timestamp_seconds(ended))",
}

_REASON = """CASE WHEN s = 'P' THEN
    CASE k % 7 WHEN 0 THEN 'agreed' WHEN 1 THEN 'repetition' WHEN 2 THEN 'stalemate'
               WHEN 3 THEN 'insufficient' WHEN 4 THEN '50move'
               WHEN 5 THEN 'timevsinsufficient' ELSE 'newdraw' END
    ELSE CASE k % 5 WHEN 0 THEN 'checkmated' WHEN 1 THEN 'resigned' WHEN 2 THEN 'timeout'
                    WHEN 3 THEN 'abandoned' ELSE 'mystery' END END"""

_CODE = "concat(substr('ABCDE', int(k % 5) + 1, 1), lpad(string(k % 20), 2, '0'))"

_RESULT = "CASE s WHEN 'F' THEN '1-0' WHEN 'O' THEN '0-1' ELSE '1/2-1/2' END"

# k % 61 half-moves. Every third game has clocks, some only for the first half.
_HALF_MOVES = """array_join(transform(
    CASE WHEN k % 61 = 0 THEN array() ELSE sequence(1, int(k % 61)) END,
    p -> concat(
      CASE WHEN p % 2 = 1 THEN concat((p + 1) div 2, '. ')
           WHEN k % 3 = 0 THEN concat(p div 2, '... ') ELSE '' END,
      substr('abcdefgh', int((k + p) % 8) + 1, 1), p % 8 + 1,
      CASE WHEN k % 3 = 0 AND (k % 12 <> 0 OR p <= (k % 61) div 2)
           THEN concat(' {[%clk 0:0', 9 - p div 8, ':', lpad(string(59 - p % 60), 2, '0'),
                       '.', p % 10, ']}')
           ELSE '' END)), ' ')"""

# 8, 12 and 61 divide this number: keys from 0 on have the half-moves of their remainder.
_CYCLE = 1464

_MOVETEXT = f"""trim(concat(CASE WHEN k < 0 THEN {_HALF_MOVES} ELSE cycled END,
    ' ', result_token))"""


_GAME_TEXT = f"""concat('[Event "Live"]\\n[Date "2026.08.15"]\\n',
    CASE WHEN k % 31 = 0 THEN '' ELSE concat('[ECO "', code, '"]\\n') END,
    CASE WHEN k % 307 = 0 THEN '' ELSE concat('\\n', {_MOVETEXT}, '\\n') END)"""


def raw_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Game records from the orders table."""
    orders = _table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS k",
        "o_custkey AS c",
        "o_orderstatus AS s",
        "substr(o_orderpriority, 1, 1) AS f",
        f"{DAY_ZERO} + (unix_seconds(CAST(o_orderdate AS TIMESTAMP)) - {DAY_ZERO}) div 691200 * 86400"
        " AS placed",
    )
    # The table may be one row group. Its five narrow columns are dealt out before texts of a
    # hundred times their size are made of them.
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = (
        orders.repartition(partitions, "k")
        .withColumn("ended", F.expr("placed + (k * 7919) % 86400"))
        .withColumns(
            {
                "reason": F.expr(_REASON),
                "code": F.expr(_CODE),
                "result_token": F.expr(_RESULT),
            }
        )
    )
    half_moves = spark.range(_CYCLE).withColumnRenamed("id", "k").select(
        F.col("k").alias("cycle"), F.expr(_HALF_MOVES).alias("cycled")
    )
    cycle = F.expr(f"CASE WHEN k >= 0 THEN k % {_CYCLE} END")
    with_moves = parts.join(F.broadcast(half_moves), cycle == F.col("cycle"), "left")
    written = evaluate_once(with_moves, "game_text", F.expr(_GAME_TEXT))
    copies = F.expr("CASE WHEN k % 3 = 0 THEN array(0, 1) ELSE array(0) END")
    return written.withColumn("copy", F.explode(copies)).select(
        *[F.expr(_GAME[f.name]).cast(f.dataType).alias(f.name) for f in schemas.RAW_GAMES.fields]
    )


def games(spark: SparkSession, sf_dir: str) -> int:
    """Number of games in the archives, copies not counted; read from the table's footers."""
    return _table(spark, sf_dir, "orders").count()


_LINEAGE = {
    "_ingested_at": "timestamp_seconds(1700000000 + copy * 86400)",
    "_source_endpoint": "concat('player/player', c)",
}

_PROFILE = {
    "username": "concat('Player', c)",
    "player_id": "c + 1000",
    "name": "c_name",
    "title": "CASE WHEN c % 18 = 0 THEN 'GM' END",
    "status": "lower(c_mktsegment)",
    "country": f"concat('{SITE}/country/N', c_nationkey)",
    "followers": "(c * 7) % 1000 + copy",
    "joined": "631152000 + (c * 86400 * 3) % 157680000",
    "last_online": "CASE WHEN c % 50 = 3 THEN NULL ELSE 1600000000 + c * 61 END",
    "is_streamer": "CASE WHEN c % 4 = 1 THEN NULL ELSE c % 4 = 2 END",
    "url": f"concat('{SITE}/member/player', c)",
    **_LINEAGE,
}


def raw_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles from the customer table, a quarter of them landed twice."""
    customers = _table(spark, sf_dir, "customer").withColumn("c", F.col("c_custkey"))
    copies = customers.withColumn(
        "copy", F.explode(F.expr("CASE WHEN c % 4 = 0 THEN array(0, 1) ELSE array(0) END"))
    )
    return copies.select(
        *[
            F.expr(_PROFILE[f.name]).cast(f.dataType).alias(f.name)
            for f in schemas.RAW_PROFILES.fields
        ]
    )


def _format(shift: int) -> str:
    return f"""named_struct(
        'last', named_struct('rating', 1400 + (c * {shift}) % 1400 + copy),
        'best', named_struct('rating', 1500 + (c * {shift}) % 1400),
        'record', CASE WHEN c % 13 = 0 THEN NULL ELSE named_struct(
            'win', (c * {shift}) % 97, 'loss', (c + {shift}) % 89, 'draw', c % {shift}) END)"""


_STATS = {
    "username": "concat('player', c)",
    "fide": "CASE WHEN c % 3 = 0 THEN 1800 + c % 900 END",
    "chess_rapid": _format(11),
    "chess_blitz": f"CASE WHEN c % 5 = 1 THEN NULL ELSE {_format(17)} END",
    "chess_bullet": f"CASE WHEN c % 3 = 0 THEN NULL ELSE {_format(23)} END",
    **_LINEAGE,
}


def raw_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics for six players in seven, some landed twice."""
    customers = _table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("c"))
    copies = customers.filter("c % 7 <> 5").withColumn(
        "copy", F.explode(F.expr("CASE WHEN c % 4 = 2 THEN array(0, 1) ELSE array(0) END"))
    )
    return copies.select(
        *[F.expr(_STATS[f.name]).cast(f.dataType).alias(f.name) for f in schemas.RAW_STATS.fields]
    )


def raw_titled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two title lists that overlap."""
    customers = _table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("c"))
    lists = F.expr(
        "filter(array(IF(c % 9 = 0, 'GM', NULL), IF(c % 10 = 0, 'IM', NULL)), t -> t IS NOT NULL)"
    )
    return customers.select("c", F.explode(lists).alias("title")).select(
        F.expr("concat('PLAYER', c)").alias("username"),
        "title",
        F.expr("timestamp_seconds(1700000000)").alias("_ingested_at"),
        F.expr("concat('titled/', title)").alias("_source_endpoint"),
    )
