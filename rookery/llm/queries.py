"""The operators as queries over whole tables, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rookery.llm import (
    bpe,
    fingerprints,
    manifest,
    mixing,
    neardup,
    paritysketch,
    pii,
    rangecoder,
    ring,
    spelling,
    substrings,
    topk,
    toxicity,
)

Query = Callable[[SparkSession, str], DataFrame]


def _read(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").select(*columns)


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.against_next(_read(spark, sf_dir, "documents", "doc_id", "text"))


def op2_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = _read(spark, sf_dir, "documents", "doc_id", "text").select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    return ring.assign(rows, "doc_id", 16).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _read(spark, sf_dir, "documents", "doc_id", "text")
    found = pii.find(documents, pii.fit(documents))
    base, spans = F.col("base_spans"), F.concat("base_spans", "added_spans")

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(kind) for kind in ("email", "ip", "card", "phone")],
        F.sha2(pii.listed(base), 256).alias("base_sha256"),
        pii.listed(spans).alias("spans"),
    )


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _read(spark, sf_dir, "documents", "doc_id", "text")
    labels = _read(spark, sf_dir, "labels", "doc_id", "toxic")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    model = toxicity.fit_on(
        documents, labels.filter(~held_out).select("doc_id", F.col("toxic").alias("label"))
    )
    return toxicity.score(documents, model).select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def domain_labels(labels: DataFrame) -> DataFrame:
    """The labelled table's domains: toxic, good or plain."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good")
    return labels.select("doc_id", domain.otherwise("plain").alias("domain"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _read(spark, sf_dir, "documents", "doc_id", "text")
    labels = domain_labels(_read(spark, sf_dir, "labels", "doc_id", "quality", "toxic"))
    targets = {"good": 0.6, "plain": 0.3, "toxic": 0.1}
    mixed = mixing.mix(documents, labels, targets, kept=["doc_id"])

    def share(name: str) -> Column:
        at = F.array_position("domains", name)
        return F.when(at > 0, F.get("posterior", (at - 1).cast("int"))).otherwise(0.0)

    return mixed.select(
        "doc_id", "tokens", *[share(name).alias(f"p_{name}") for name in targets], "rate", "copies"
    )


def op6_rangecoder(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _read(spark, sf_dir, "documents", "doc_id", "text")
    files = rangecoder.write(documents, public_tokenizers.path("byte_bpe_50k.json"))
    return rangecoder.read(files).select(
        "doc_id",
        "start",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    documents = _read(spark, sf_dir, "documents", "doc_id", "text")
    encoded = bpe.encode(documents, ranks).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        "ids",
        "token_bytes",
    )
    return bpe.decode(encoded, ranks).select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _read(spark, sf_dir, "embeddings", "vec_id", "embedding")
    finite = F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    )
    scaled = vectors.filter(finite).select(
        "vec_id", F.transform("embedding", lambda x: F.floor(64 * x.cast("double"))).alias("v")
    )
    return topk.top_k(scaled, "vec_id", "v", F.col("vec_id") % 20 == 0, 20)


def op9_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_read(spark, sf_dir, "documents", "doc_id", "text"))


def op10_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _read(spark, sf_dir, "documents", "doc_id", "text")
    return substrings.remove_repeats(documents).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


LEAF = ["doc_id", "source", "lang", "n_chars", "text"]


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proofs of all rows, a third of which show their text in lower case."""
    documents = _read(spark, sf_dir, "documents", *LEAF)
    lower = F.translate("text", spelling.UPPER, spelling.LOWER)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    shown = {"text": F.when(tampered, lower).otherwise(F.col("text"))}
    made = manifest.build(documents, LEAF, "lang", "doc_id", shown)
    return manifest.climb(made).select(
        F.col("id").alias("doc_id"),
        "leaf",
        "subroot",
        F.lit(made.root).alias("root"),
        F.sha2("proof", 256).alias("proof_sha256"),
        F.col("folded").alias("folded_root"),
        (F.col("folded") == F.lit(made.root)).alias("verified"),
    )


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _read(spark, sf_dir, "documents", "doc_id", "text")
    words = spelling.counted(spelling.runs(documents))
    return spelling.variants(words).select("word", "form", "root", "n", "n_near", "form_n")


def op13_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paritysketch.linked_classes(_read(spark, sf_dir, "documents", "doc_id", "text"))


QUERIES: dict[str, Query] = {
    "op1_fingerprints": op1_fingerprints,
    "op2_ring": op2_ring,
    "op3_pii": op3_pii,
    "op4_toxicity": op4_toxicity,
    "op5_mixing": op5_mixing,
    "op6_rangecoder": op6_rangecoder,
    "op7_bpe": op7_bpe,
    "op8_topk": op8_topk,
    "op9_neardup": op9_neardup,
    "op10_substrings": op10_substrings,
    "op11_manifest": op11_manifest,
    "op12_spelling": op12_spelling,
    "op13_parity": op13_parity,
}

# CRC-32 in SQL: the table of 256 remainders, and its use on a list of bytes.
_CRC_TABLE = """
    crc_table AS (
        SELECT list(c ORDER BY i) AS t FROM (
            SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1
                THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS c FROM range(256) r(i))
    )
"""


def _crc32(octets: str) -> str:
    return (
        f"xor(list_reduce({octets}, lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), "
        "4294967295), 4294967295)"
    )


def _ascii(text: str) -> str:
    return f"list_transform(string_split({text}, ''), lambda x: CAST(ord(x) AS BIGINT))"


def _leaf(text: str) -> str:
    values = ("doc_id", "source", "lang", "n_chars", text)
    shown = [
        f"coalesce(strlen(CAST({v} AS VARCHAR)) || ':' || CAST({v} AS VARCHAR), '-')" for v in values
    ]
    return f"sha256({' || '.join(shown)})"


_LOWER = f"translate(text, '{spelling.UPPER}', '{spelling.LOWER}')"


ORACLES: dict[str, str] = {
    "op8_topk": """
        WITH vectors AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        scores AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
            FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id
            WHERE q.vec_id % 20 = 0
        ),
        ranked AS (
            SELECT query_id, CAST(row_number() OVER (
                PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
                vec_id, score
            FROM scores
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
    """,
    "op9_neardup": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                          'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
            FROM documents
        ),
        shingles AS (
            SELECT DISTINCT doc_id, s FROM (
                SELECT doc_id, unnest(CASE
                    WHEN len(w) = 0 THEN []
                    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                    ELSE list_transform(range(1, len(w) - 3),
                                        lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
                FROM words)
        ),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        links AS (
            SELECT a.doc_id AS a, b.doc_id AS b
            FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
            JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
            GROUP BY a.doc_id, b.doc_id, x.n, y.n
            HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))
        ),
        reached(doc_id, other) AS (
            SELECT doc_id, doc_id FROM documents
            UNION
            SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other
        ),
        lowest AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
        SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id,
               d.doc_id = component_id AS kept
        FROM documents d JOIN lowest USING (doc_id) LEFT JOIN sizes USING (doc_id)
    """,
    "op10_substrings": r"""
        WITH words AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
            FROM documents
        ),
        windows AS (
            SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS s
            FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 18, 1))) AS i FROM words)
        ),
        repeats AS (
            SELECT doc_id, i FROM (
                SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS k
                FROM windows)
            WHERE k > 1
        ),
        covered AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM repeats),
        places AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM words),
        kept AS (
            SELECT doc_id, string_agg(w[p], ' ' ORDER BY p) AS t, count(*) AS n
            FROM places ANTI JOIN covered USING (doc_id, p) GROUP BY doc_id
        )
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, len(w) - coalesce(n, 0) AS n_removed,
               sha256(coalesce(t, '')) AS kept_sha256
        FROM words LEFT JOIN kept USING (doc_id)
    """,
    "op11_manifest": f"""
        WITH RECURSIVE {_CRC_TABLE},
        leaves AS (
            SELECT doc_id, lang, {_leaf('text')} AS leaf,
                   CASE WHEN {_crc32(_ascii('CAST(doc_id AS VARCHAR)'))} % 3 = 0
                        THEN {_leaf(_LOWER)} ELSE {_leaf('text')} END AS claim
            FROM documents, crc_table
        ),
        placed AS (
            SELECT *, row_number() OVER (
                PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
            FROM leaves
        ),
        tree(lang, level, pos, digest, n) AS (
            SELECT lang, 0, pos, leaf, count(*) OVER (PARTITION BY lang) FROM placed
            UNION ALL
            SELECT lang, level + 1, pos // 8, sha256(string_agg(digest, '' ORDER BY pos)),
                   (n + 7) // 8
            FROM tree WHERE n > 1 GROUP BY lang, level, n, pos // 8
        ),
        subroots AS (
            SELECT lang, digest, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos,
                   count(*) OVER () AS n
            FROM tree WHERE n = 1
        ),
        top(level, pos, digest, n) AS (
            SELECT 0, pos, digest, n FROM subroots
            UNION ALL
            SELECT level + 1, pos // 8, sha256(string_agg(digest, '' ORDER BY pos)), (n + 7) // 8
            FROM top WHERE n > 1 GROUP BY level, n, pos // 8
        ),
        inner_steps AS (
            SELECT lang, level, pos, digest,
                   coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING
                                                         AND 1 PRECEDING), '') AS l,
                   coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN 1 FOLLOWING
                                                         AND UNBOUNDED FOLLOWING), '') AS r
            FROM tree WHERE n > 1
            WINDOW w AS (PARTITION BY lang, level, pos // 8 ORDER BY pos)
        ),
        top_steps AS (
            SELECT level, pos, digest,
                   coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING
                                                         AND 1 PRECEDING), '') AS l,
                   coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN 1 FOLLOWING
                                                         AND UNBOUNDED FOLLOWING), '') AS r
            FROM top WHERE n > 1
            WINDOW w AS (PARTITION BY level, pos // 8 ORDER BY pos)
        ),
        climb(doc_id, lang, leaf, k, level, pos, folded, proof) AS (
            SELECT doc_id, lang, leaf, pos, 0, pos, claim, '' FROM placed
            UNION ALL
            SELECT c.doc_id, c.lang, c.leaf, c.k, c.level + 1, c.pos // 8,
                   sha256(s.l || c.folded || s.r), c.proof || s.l || s.r
            FROM climb c JOIN inner_steps s
            ON s.lang IS NOT DISTINCT FROM c.lang AND s.level = c.level AND s.pos = c.pos
        ),
        at_subroot AS (
            SELECT *, row_number() OVER (PARTITION BY lang, doc_id, k ORDER BY level DESC) AS last
            FROM climb
        ),
        on_top(doc_id, leaf, k, subroot, level, pos, folded, proof) AS (
            SELECT c.doc_id, c.leaf, c.k, s.digest, 0, s.pos, c.folded, c.proof
            FROM at_subroot c JOIN subroots s ON s.lang IS NOT DISTINCT FROM c.lang
            WHERE c.last = 1
            UNION ALL
            SELECT c.doc_id, c.leaf, c.k, c.subroot, c.level + 1, c.pos // 8,
                   sha256(s.l || c.folded || s.r), c.proof || s.l || s.r
            FROM on_top c JOIN top_steps s ON s.level = c.level AND s.pos = c.pos
        ),
        ended AS (
            SELECT *, row_number() OVER (PARTITION BY subroot, doc_id, k ORDER BY level DESC) AS last
            FROM on_top
        )
        SELECT e.doc_id, leaf, subroot, t.digest AS root, sha256(proof) AS proof_sha256,
               folded AS folded_root, folded = t.digest AS verified
        FROM ended e, top t WHERE e.last = 1 AND t.n = 1
    """,
    "op12_spelling": rf"""
        WITH RECURSIVE {_CRC_TABLE},
        found AS (
            SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
                   unnest(regexp_extract_all({_LOWER}, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run
            FROM documents
        ),
        long AS (SELECT id, run, count(*) AS k FROM found WHERE length(run) >= 7 GROUP BY ALL),
        coded AS (
            SELECT run, k, {_crc32(
                "flatten(list_transform(string_split(id || ':' || run, ''), "
                "lambda x: CASE WHEN ord(x) < 128 THEN [CAST(ord(x) AS BIGINT)] "
                "ELSE [192 | (CAST(ord(x) AS BIGINT) >> 6), 128 | (CAST(ord(x) AS BIGINT) & 63)] END))"
            )} AS h
            FROM long, crc_table
        ),
        cut AS (
            SELECT k, CASE WHEN h % 31 = 0
                THEN left(run, CAST(h % length(run) AS INT))
                     || substr(run, CAST(h % length(run) AS INT) + 2)
                ELSE run END AS word
            FROM coded
        ),
        words AS (
            SELECT word, CAST(sum(k) AS BIGINT) AS n FROM cut WHERE length(word) >= 7
            GROUP BY word HAVING sum(k) >= 2
        ),
        -- words that differ by one edit agree with one code point left out or none
        parts AS (
            SELECT word, length(word) AS len, p, left(word, p - 1) || substr(word, p + 1) AS rest
            FROM (SELECT word, unnest(range(1, length(word) + 1)) AS p FROM words)
        ),
        pairs AS (
            SELECT a.word AS x, b.word AS y FROM parts a JOIN parts b
            ON a.rest = b.rest AND a.p = b.p AND a.word <> b.word
            UNION
            SELECT a.word, b.word FROM parts a JOIN words b ON a.rest = b.word
            UNION
            SELECT b.word, a.word FROM parts a JOIN words b ON a.rest = b.word
        ),
        ranked AS (
            SELECT x, y, w.n AS m, count(*) OVER (PARTITION BY x) AS n_near,
                   row_number() OVER (PARTITION BY x ORDER BY w.n DESC, y) AS k
            FROM pairs JOIN words w ON w.word = y
        ),
        forms AS (
            SELECT word, n, coalesce(n_near, 0) AS n_near,
                   CASE WHEN m >= 10 * n THEN y END AS form,
                   CASE WHEN m >= 10 * n THEN m END AS form_n
            FROM words LEFT JOIN ranked ON x = word AND k = 1
        ),
        chain(word, root, form) AS (
            SELECT word, word, form FROM forms
            UNION ALL
            SELECT c.word, f.word, f.form FROM chain c JOIN forms f ON f.word = c.form
        )
        SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n
        FROM forms f JOIN chain c ON c.word = f.word AND c.form IS NULL
    """,
    "op13_parity": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                          'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
            FROM documents
        ),
        shingles AS (
            SELECT DISTINCT doc_id, s FROM (
                SELECT doc_id, unnest(CASE
                    WHEN len(w) = 0 THEN []
                    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                    ELSE list_transform(range(1, len(w) - 3),
                                        lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
                FROM words)
        ),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        links AS (
            SELECT a.doc_id AS a, b.doc_id AS b
            FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
            JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
            GROUP BY a.doc_id, b.doc_id, x.n, y.n
            HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))
        ),
        reached(doc_id, other) AS (
            SELECT doc_id, doc_id FROM documents
            UNION
            SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other
        ),
        lowest AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
        SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id
        FROM documents d JOIN lowest USING (doc_id) LEFT JOIN sizes USING (doc_id)
    """,
}
