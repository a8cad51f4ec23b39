"""Text operators against brute force on small tables with awkward rows."""

from __future__ import annotations

import base64
import hashlib
import os
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rookery.llm import (
    batches,
    bpe,
    fingerprints,
    mixing,
    neardup,
    pii,
    rangecoder,
    ring,
    substrings,
    topk,
    toxicity,
)

tiktoken = pytest.importorskip("tiktoken")
Tokenizer = pytest.importorskip("tokenizers").Tokenizer
public_tokenizers = pytest.importorskip("public_tokenizers")

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id LONG, text STRING, score STRING, tokens STRING, cell STRING, id STRING, row STRING"


def frame(spark, rows):
    """Documents with extra columns whose names the operators use inside."""
    return spark.createDataFrame([(*row, "a", "b", "c", "d", "e") for row in rows], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def prose(seed, count, words=("alpha", "beta", "gamma", "delta", "Omega", "pi")):
    pick = random.Random(seed)
    return " ".join(pick.choice(words) + str(pick.randrange(40)) for _ in range(count))


LONG = prose(1, 60_000)
AWKWARD = [
    (1, None),
    (2, ""),
    (3, " \t\n "),
    (4, "one two"),
    (5, "ONE  two"),
    (6, prose(6, 80)),
    (7, prose(6, 80) + " tail"),
    (8, prose(6, 80)),
    (8, prose(6, 80)),
    (9, LONG),
    (None, prose(9, 30)),
    (11, "é日本 😀 it's we'll <|endoftext|>"),
]


def words(text, lower=False):
    text = text or ""
    if lower:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    return re.findall("[^\x20\x09-\x0d]+", text)


def shingle_set(text):
    found = words(text, lower=True)
    if len(found) < 5:
        return {tuple(found)} if found else set()
    return {tuple(found[i : i + 5]) for i in range(len(found) - 4)}


# --- fingerprints -----------------------------------------------------------


def test_fingerprints_of_awkward_rows(spark):
    rows = fingerprints.against_next(frame(spark, AWKWARD)).collect()
    order = sorted(AWKWARD, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    expected = []
    for (doc_id, text), (_, following) in zip(order, order[1:] + order[:1]):
        text, following = text or "", following or ""
        cut = len(text) // 4
        edited = text[: len(text) - cut] + following[:cut]
        expected.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest()))
    got = [(r.doc_id, r.n_chars, r.edited_sha256) for r in rows]
    assert sorted(got, key=str) == sorted(expected, key=str)
    by_id = {r.doc_id: r for r in rows}
    assert by_id[6].fingerprint == by_id[8].fingerprint != by_id[7].fingerprint
    assert by_id[1].fingerprint == by_id[3].fingerprint == ""
    assert by_id[1].near_next == 1.0 and by_id[3].near_next == 0.0
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)


def test_fingerprint_estimates_and_merging(spark):
    left, right = prose(3, 3000), prose(4, 2000)
    both = f"{left} {right}"
    docs = frame(spark, [(1, left), (2, right), (3, both)])
    made = fingerprints.fingerprint(docs)
    prints = {r.doc_id: fingerprints.decode(bytes(r.fingerprint)) for r in made.collect()}
    exact = {i: shingle_set(t) for i, t in ((1, left), (2, right), (3, both))}
    jaccard = len(exact[1] & exact[3]) / len(exact[1] | exact[3])
    assert abs(fingerprints.resemblance(prints[1], prints[3]) - jaccard) < 0.12
    assert fingerprints.containment(prints[1], prints[3]) > 0.85
    assert abs(fingerprints.distinct_count(prints[3]) / len(exact[3]) - 1) < 0.2
    parts = made.filter("doc_id < 3").withColumn("corpus", F.lit("x"))
    merged = fingerprints.merge(parts, ["corpus"]).collect()
    union = np.union1d(prints[1], prints[2])[: fingerprints.K]
    assert len(merged) == 1
    assert (fingerprints.decode(bytes(merged[0].fingerprint)) == union).all()


# --- sharding ---------------------------------------------------------------


@pytest.mark.parametrize("slack", [0.0, 0.25])
def test_ring_balance(spark, slack):
    rows = [(None if i % 50 == 0 else i % 7 if i % 3 == 0 else i, i % 11) for i in range(900)]
    table = spark.createDataFrame(rows, "key LONG, size INT")
    found = ring.assign(table, "key", 7, slack, nodes=16).collect()
    assert sorted((r.key or -1, r.size) for r in found) == sorted((k or -1, s) for k, s in rows)
    slots = {}
    for row in found:
        slots.setdefault(row.shard, []).append(row.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots.get(shard, [])) for shard in range(7)]
    if slack:
        assert max(sizes) <= 900 * 1.25 / 7 + 1
    else:
        assert max(sizes) - min(sizes) <= 1


def test_ring_moves_few_keys(spark):
    table = spark.range(4000).withColumnRenamed("id", "key")
    before = {r.key: r.shard for r in ring.assign(table, "key", 10).collect()}
    after = {r.key: r.shard for r in ring.assign(table, "key", 11).collect()}
    assert sum(before[k] != after[k] for k in before) < 0.35 * len(before)


def test_ring_of_nothing(spark):
    assert ring.assign(spark.createDataFrame([], "key LONG"), "key", 4).collect() == []


# --- personal data ----------------------------------------------------------

_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for i, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + i % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in (("email", _EMAIL), ("ip", _IP), ("card", _CARD), ("phone", _PHONE)):
        for match in pattern.finditer(text or ""):
            digits = re.sub("[^0-9]", "", match.group())
            wrong = (
                (kind == "ip" and any(int(p) > 255 for p in match.group().split(".")))
                or (kind == "card" and not (13 <= len(digits) <= 19 and luhn(digits)))
                or (kind == "phone" and not 9 <= len(digits) <= 15)
            )
            if not wrong:
                out.append(f"{kind}:{match.start()}:{match.end()}")
    return ",".join(out)


def personal(seed, count):
    pick = random.Random(seed)
    alphabet = "0123456789+-. ()@ab.%é😀"
    return [
        (100 + i, "".join(pick.choice(alphabet) for _ in range(pick.randrange(0, 90))))
        for i in range(count)
    ]


def test_base_spans_match_the_plain_patterns(spark):
    rows = [*AWKWARD, *personal(3, 600), (50, "1.2.3.4" * 3), (51, "9" * 4000), (52, "+12 " * 900)]
    rows += [(53, "a@b.c%x@d.e 0.00.0.5 4111-1111-1111-1111 +1 (389) 555-5010")]
    found = pii.find(frame(spark, rows), None).select(
        "doc_id", "text", pii.listed(F.col("base_spans")).alias("spans"), "score"
    )
    for row in found.collect():
        assert row.spans == base_spans(row.text), row.text
        assert row.score == "a"


def test_trees_add_unknown_forms_and_leave_clean_text(spark):
    known = [(i, f"text here call +1 ({300 + i}) 555-{2000 + i} and so on") for i in range(60)]
    known += [(100 + i, f"version {i % 7}.{i % 3} of section {i}") for i in range(60)]
    known += [(200 + i, f"card 4{i:03d} 1234 99 x") for i in range(40)]
    model = pii.fit(frame(spark, known))
    asked = [(1, "ring (389) 555-5010 now"), (2, "no digits at all"), (3, "version 2.0"), (4, None)]
    found = {
        r.doc_id: (r.spans, r.red)
        for r in pii.find(frame(spark, asked), model)
        .select(
            "doc_id",
            pii.listed(F.concat("base_spans", "added_spans")).alias("spans"),
            pii.redact(F.col("text"), F.concat("base_spans", "added_spans")).alias("red"),
        )
        .collect()
    }
    assert found[1] == ("phone:5:19", "ring <PHONE> now")
    assert found[2] == ("", "no digits at all") and found[3] == ("", "version 2.0")
    assert found[4] == ("", None)


def _labels(spark, texts):
    """Every candidate of the texts, with the label the rules give it."""
    rows = frame(spark, list(enumerate(texts)))
    places = pii._with_places(pii._signed(rows, "text"), pii._generator_patterns())
    found = places.select(F.explode(pii._candidates()).alias("one")).select("one.*").collect()
    return {(list(pii.GENERATORS)[r.generator], r.match): r.label for r in found}


def test_spelt_addresses_and_secrets_need_no_other_sign(spark):
    assert _labels(spark, ["so jane (at) example.org", "or kim [at] example.net", "it is at home"]) == {
        ("email", "jane (at) example.org"): None,
        ("email", "kim [at] example.net"): None,
    }
    assert _labels(spark, ["password: swordfishlake", "see internationalization"]) == {
        ("secret", "password: swordfishlake"): 0,
        ("secret", "internationalization"): 0,
    }
    assert _labels(spark, ["look at www.example.org", "mail jane at example.org", "x [at] 3.5"]) == {
        ("email", "look at www.example.org"): 0,
        ("email", "jane at example.org"): None,
        ("email", "x [at] 3.5"): 0,
        ("ip", "3.5"): 0,
        ("digits", "3.5"): 0,
    }


def test_spelt_addresses_are_added_and_prose_is_not(spark):
    known = [(i, f"mail kim{'abcdefghij'[i % 10]}@example.org today") for i in range(60)]
    known += [(100 + i, f"version {i % 7}.{i % 3} of it") for i in range(60)]
    prose = [(200 + i, f"the shop {'is was open'.split()[i % 3]} at example.com") for i in range(30)]
    asked = [
        (1, "so jane (at) example.org"),
        (2, "so jane [at] example [dot] org"),
        (3, "it was hosted at example.org"),
    ]
    for rows in (known, known + prose):
        found = pii.find(frame(spark, asked), pii.fit(frame(spark, rows))).select(
            "doc_id", pii.listed(F.col("added_spans")).alias("spans")
        )
        spans = {r.doc_id: r.spans for r in found.collect()}
        assert spans == {1: "email:3:24", 2: "email:3:30", 3: ""}


def test_numbers_in_brackets_are_judged_as_plain_ones(spark):
    assert _labels(spark, ["10[.]0[.]0[.]1"]) == {
        ("ip", "10[.]0[.]0[.]1"): None,
        ("digits", "10"): 0,
    }
    known = [(i, f"host 10.{i}.7.{i + 3} and 12[.]{i}[.]0[.]4 up") for i in range(60)]
    known += [(100 + i, f"version {i}.{i % 3}.1 or 3.{300 + i}.1.2") for i in range(60)]
    asked = [
        (1, "see 10[.]0[.]0[.]1 now"),
        (2, "see 10(.)0(.)0(.)1 now"),
        (3, "see 10[.]999[.]0[.]1 now"),
        (4, "see 3[.]2[.]1 now"),
    ]
    found = pii.find(frame(spark, asked), pii.fit(frame(spark, known)))
    spans = {r.doc_id: r.added_spans for r in found.collect()}
    assert [[(s.kind, s.start, s.end) for s in spans[i]] for i in (1, 2, 3, 4)] == [
        [("ip", 4, 18)],
        [("ip", 4, 18)],
        [],
        [],
    ]


def test_thresholds_count_forms_that_the_trees_have_not_seen(spark, monkeypatch):
    known = [(i, f"call +1 ({300 + i}) 555-{2000 + i} and so on") for i in range(100)]
    known += [(100 + i, "an internationalization text") for i in range(60)]
    rare = ["12", "1234", "1 2 3", "1 2 3 4", "12 34", "123 4", "123 456", "1-2-3-4-5", "12345"]
    rare += ["123456789", "1234567890", "12345678901", "1 23", "1 2 3 4 5 6", "1234567"]
    known += [(200 + i, f"seen {form} times") for i, form in enumerate(rare)]
    digits = list(pii.GENERATORS).index("digits")
    monkeypatch.setattr(pii, "CELLS", 2)
    assert pii.fit(frame(spark, known[:160])).thresholds[digits] < 10
    assert pii.fit(frame(spark, known)).thresholds[digits] == np.inf


def test_personal_data_of_nothing(spark):
    assert pii.fit(empty(spark)) is None
    assert pii.find(empty(spark), None).collect() == []


# --- toxicity ---------------------------------------------------------------


def _toxic_sample(count):
    pick = random.Random(5)
    texts, labels = [], []
    for i in range(count):
        body = prose(1000 + i, pick.randrange(20, 120)).split()
        bad = i % 4 == 0
        if bad:
            for _ in range(2):
                body.insert(pick.randrange(len(body)), pick.choice(["wretch", "nitwit"]))
        texts.append(" ".join(body))
        labels.append(int(bad))
    return texts, np.array(labels)


def test_toxicity_finds_words_and_misspellings(spark):
    texts, labels = _toxic_sample(400)
    model = toxicity.fit(texts, labels, (3000, 100))
    rows = [(1, "alpha1 beta2 you nitwit gamma3"), (2, "what nitwitt is this"), (3, prose(77, 300))]
    rows += [(4, None), (5, ""), (6, LONG), (7, "!!! ...")]
    scores = {r.doc_id: r.score for r in toxicity.score(frame(spark, rows), model).collect()}
    assert scores[1] >= toxicity.THRESHOLD and scores[2] > 0.3
    assert all(scores[i] <= 0.5 for i in (3, 4, 5, 6, 7)), scores
    held, truth = _toxic_sample(80)
    found = model.probability(model.logits(pa.array(held)))
    assert ((found >= toxicity.THRESHOLD) == truth).mean() > 0.95


def test_toxicity_without_both_classes(spark):
    documents = frame(spark, AWKWARD)
    labels = spark.createDataFrame([(4, 0), (6, None), (None, 1)], "doc_id LONG, label INT")
    model = toxicity.fit_on(documents, labels)
    rows = toxicity.score(documents, model).collect()
    assert len(rows) == len(AWKWARD) and all(r.score < 0.01 for r in rows)
    assert toxicity.score(empty(spark), model).collect() == []
    nothing = toxicity.fit_on(empty(spark), labels)
    assert all(r.score < 0.01 for r in toxicity.score(documents, nothing).collect())


def test_toxicity_takes_one_text_per_labelled_id(spark):
    """An id with very many rows does not push the others out of the sample."""
    rows = [(1, f"copy {n}") for n in range(500)] + [(n, "fine words") for n in range(2, 12)]
    labels = spark.createDataFrame([(n, int(n == 1)) for n in range(1, 12)], "doc_id LONG, label INT")
    taken = toxicity.sample(frame(spark, rows), labels, 5).collect()
    assert sorted(r.label for r in taken) == [0] * 5 + [1]


def test_toxicity_trains_in_a_task(spark, monkeypatch):
    texts = [f"{'vile' if i % 3 == 0 else 'kind'} words number {i}" for i in range(60)]
    documents = frame(spark, list(enumerate(texts)))
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(60)], "doc_id LONG, label INT")
    rows = toxicity.sample(documents, labels).collect()
    direct = toxicity.fit([r.text for r in rows], [r.label for r in rows], (40, 20))

    driver, own = os.getpid(), toxicity.fit

    def elsewhere(*args):
        assert os.getpid() != driver
        return own(*args)

    monkeypatch.setattr(toxicity, "fit", elsewhere)
    model = toxicity.fit_on(documents, labels)
    assert np.array_equal(model.weights, direct.weights)
    assert (model.bias, model.slope, model.shift) == (direct.bias, direct.slope, direct.shift)


def test_toxicity_keeps_columns_of_any_name(spark):
    model = toxicity.fit(["a", "b"], np.array([0, 0]))
    own = spark.createDataFrame([(1, "x", "y", "z")], "doc_id LONG, text STRING, _text STRING, row STRING")
    scored = toxicity.score(own, model)
    assert scored.columns == ["doc_id", "text", "_text", "row", "score"]
    assert scored.first()[:4] == (1, "x", "y", "z")


# --- mixing -----------------------------------------------------------------


def test_rates_meet_targets(spark):
    rows, labels = [], []
    for i in range(400):
        good = i % 4 != 0
        text = prose(i, 60) if good else "spam | spam | ! spam ! " * 20
        rows.append((i, text))
        labels.append((i, "good" if good else "poor"))
    documents = frame(spark, rows)
    labelled = spark.createDataFrame(labels[::3], "doc_id LONG, domain STRING")
    for least, targets in ((0.0, {"good": 0.5, "poor": 0.5}), (1.0, {"good": 0.5, "poor": 0.5})):
        mixed = mixing.mix(documents, labelled, targets, least).collect()
        totals = np.zeros(2)
        for row in mixed:
            totals += row.rate * row["posterior"][0] * np.array([0, 0])
            tokens = len(words(row.text))
            totals += row.rate * tokens * np.array(row.posterior)
        assert abs(totals[0] / totals.sum() - 0.5) < 0.01
        assert min(r.rate for r in mixed) >= least
        assert min(r.copies for r in mixed) >= least


def test_rates_equal_brute_force_least_squares(spark):
    """Projected gradient on the same cells in numpy, one rate a cell."""
    posterior = np.array([[0.9, 0.1, 0.0], [0.2, 0.7, 0.1], [0.1, 0.1, 0.8], [0.4, 0.3, 0.3]])
    tokens = np.array([500.0, 300.0, 150.0, 50.0])
    domains = mixing.Domains(["a", "b", "c"], [0.0] * 3, [])
    domains.posterior = lambda cell: F.get(
        F.array(*[F.array(*[F.lit(float(x)) for x in row]) for row in posterior]), cell
    )
    cells = spark.createDataFrame([(k, int(t)) for k, t in enumerate(tokens)], "cell INT, tokens LONG")
    for shares in ([0.5, 0.3, 0.2], [0.05, 0.05, 0.9]):  # the second is out of reach
        goals = np.array(shares) * tokens.sum()
        rate = np.ones(4)
        for _ in range(200_000):
            miss = (rate * tokens) @ posterior - goals
            rate = np.maximum(0, rate - posterior @ miss / tokens.sum())
        fitted = mixing.fit_rates(cells, domains, dict(zip("abc", shares))).collect()
        got = np.array([r.rate for r in sorted(fitted, key=lambda r: r.cell)])
        mine, best = (got * tokens) @ posterior, (rate * tokens) @ posterior
        assert np.abs(mine - best).max() / tokens.sum() < 1e-3
        assert abs(fitted[0].residual - np.abs(mine - goals).max() / tokens.sum()) < 1e-6


def test_mixing_of_awkward_rows(spark):
    documents = frame(spark, AWKWARD)
    nothing = spark.createDataFrame([], "doc_id LONG, domain STRING")
    rows = mixing.mix(documents, nothing, {"good": 1.0}).collect()
    assert len(rows) == len(AWKWARD) and all(r.rate == 1.0 and r.copies == 1 for r in rows)
    labelled = spark.createDataFrame([(6, "good"), (6, "bad"), (None, "good")], "doc_id LONG, domain STRING")
    assert len(mixing.mix(documents, labelled, {"good": 1.0, "none": 1.0}).collect()) == len(AWKWARD)
    assert mixing.mix(empty(spark), labelled, {"good": 1.0}).collect() == []


def test_mixing_moves_no_text_to_choose_those_for_marks(spark):
    documents = frame(spark, [(i, f"text {i}") for i in range(20)])
    labelled = spark.createDataFrame([(i, "good") for i in range(20)], "doc_id LONG, domain STRING")
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")  # as if the labels looked large
    try:
        plan = mixing._texts_for_marks(documents, labelled, ["good"])
        shown = plan._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(name, before)
    assert "BroadcastHashJoin" in shown and "SortMergeJoin" not in shown


# --- byte-level BPE ---------------------------------------------------------


@pytest.fixture(scope="module")
def reference_bpe():
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def test_bpe_matches_and_round_trips(spark, reference_bpe):
    pick = random.Random(8)
    alphabet = "abstmdrvelle''''  \t\n\r19²!?-é日本  😀'"
    rows = [*AWKWARD, (60, "a" * 3000), (61, " " * 500 + "x"), (62, "ab'll" * 400)]
    rows += [
        (100 + i, "".join(pick.choice(alphabet) for _ in range(pick.randrange(0, 60))))
        for i in range(1500)
    ]
    encoded = bpe.encode(frame(spark, rows), RANKS)
    for row in encoded.collect():
        ids = np.frombuffer(row.ids, "<u4").tolist()
        assert ids == reference_bpe.encode_ordinary(row.text or ""), row.text
        assert row.score == "a"
    for row in bpe.decode(encoded, RANKS).collect():
        assert bytes(row.decoded).decode() == (row.text or "")
    assert bpe.decode(bpe.encode(empty(spark), RANKS), RANKS).collect() == []


# --- token-id files ---------------------------------------------------------


@pytest.mark.parametrize(
    "ids",
    [
        [],
        [5],
        [0] * 3000,
        list(range(5000)),
        [random.Random(1).randrange(2**32) for _ in range(2500)],
        [random.Random(i).choice([1, 2, 3, 70000]) for i in range(2500)],
    ],
)
def test_range_coder_round_trip(ids):
    table, blocks = rangecoder.encode_ids(np.array(ids, np.int64))
    assert len(blocks) == -(-len(ids) // rangecoder.BLOCK)
    assert rangecoder.decode_blocks(table, blocks, len(ids)).tolist() == ids


def test_damage_is_found():
    ids = np.arange(3000) % 700
    table, blocks = rangecoder.encode_ids(ids)
    broken = bytearray(blocks[1])
    broken[20] ^= 0x55
    with pytest.raises(ValueError, match="block 1"):
        rangecoder.decode_blocks(table, [blocks[0], bytes(broken), blocks[2]], len(ids))


def test_token_files_of_awkward_rows(spark):
    library = Tokenizer.from_file(JSON)
    files = rangecoder.write(frame(spark, AWKWARD), JSON)
    rows = rangecoder.read(files).orderBy("start").collect()
    order = sorted(AWKWARD, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start = 0
    for row, (doc_id, text) in zip(rows, order, strict=True):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        assert (50256 in ids) == ("<|endoftext|>" in (text or ""))
        assert (row.doc_id, row.start) == (doc_id, start)
        assert zlib.crc32(row.ids) == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    assert rangecoder.read(rangecoder.write(empty(spark), JSON)).collect() == []


# --- top-k ------------------------------------------------------------------


def test_top_k_is_exact(spark):
    rng = np.random.default_rng(3)
    vectors = [(i, rng.integers(-30, 30, 12).tolist()) for i in range(900)]
    vectors += [(900 + i, [1] * 12) for i in range(60)]  # ties
    vectors += [(2000, None), (2001, [1, None] + [0] * 10), (2002, [7, 7]), (None, [1] * 12)]
    vectors += [(2020, [1, 2]), (40, vectors[40][1])]  # other length, repeated row
    table = spark.createDataFrame(vectors, "vec_id LONG, v ARRAY<LONG>")
    found = topk.top_k(table, "vec_id", "v", F.col("vec_id") % 20 == 0, 5).collect()
    whole = [(i, v) for i, v in vectors if i is not None and v and None not in v]
    expected = []
    for i, v in whole:
        if i % 20 == 0:
            scored = [
                (-int(np.dot(v, w)), j) for j, w in whole if j != i and len(w) == len(v)
            ]
            expected += [(i, j, -s) for s, j in sorted(scored)[:5]]
    got = [(r.query_id, r.vec_id, r.score) for r in found]
    once = {e for e in expected if e[0] != 40}
    assert {g for g in got if g[0] != 40} == once
    assert topk.top_k(table.limit(0), "vec_id", "v", F.lit(True), 5).collect() == []


# --- near duplicates --------------------------------------------------------


def brute_classes(rows):
    sets = [(doc_id, shingle_set(text)) for doc_id, text in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                parent[root(i)] = root(j)
    rank = lambda d: (d is not None, d or 0)
    lowest = {}
    for i, (doc_id, _) in enumerate(rows):
        lowest[root(i)] = min(lowest.get(root(i), doc_id), doc_id, key=rank)
    return [
        (doc_id, len(sets[i][1]), lowest[root(i)] if sets[i][1] else doc_id)
        for i, (doc_id, _) in enumerate(rows)
    ]


def edited(text, seed, share):
    pick = random.Random(seed)
    return " ".join(w if pick.random() > share else f"new{pick.randrange(999)}" for w in text.split())


def test_near_duplicates_match_brute_force(spark):
    rows = list(AWKWARD)
    for group in range(6):
        text = prose(500 + group, 150)
        rows += [(1000 + group * 50 + i, edited(text, i, 0.004 * (i % 9))) for i in range(40)]
    rows += [(3000 + i, prose(3000 + i, 60)) for i in range(60)]
    found = neardup.near_duplicates(frame(spark, rows)).collect()
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=str)
    assert got == sorted(brute_classes(rows), key=str)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_deduplicate_keeps_one_of_each_class(spark):
    documents = frame(spark, AWKWARD)
    kept = neardup.deduplicate(documents)
    assert kept.columns == documents.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=str)
    assert ids == sorted([1, 2, 3, 4, 6, 9, None, 11], key=str)
    assert neardup.deduplicate(empty(spark)).collect() == []


def test_posterior_bound():
    assert neardup.fewest_matches(48) < neardup.fewest_matches(96) < neardup.fewest_matches(240)
    assert neardup.fewest_matches(240) < 0.75 * 240


# --- repeated passages ------------------------------------------------------


def brute_strip(rows, size=20):
    order = sorted(
        {(d, t) for d, t in rows}, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")
    )
    seen, out = set(), {}
    for doc_id, text in order:
        found = words(text)
        gone = set()
        for i in range(len(found) - size + 1):
            window = tuple(found[i : i + size])
            if window in seen:
                gone.update(range(i, i + size))
            seen.add(window)
        kept = " ".join(w for i, w in enumerate(found) if i not in gone)
        out[doc_id, text] = (len(found), len(gone), kept)
    return out


def test_repeats_match_brute_force(spark):
    passage = prose(42, 45)
    rows = [*AWKWARD, (20, f"{prose(20, 30)} {passage} {prose(21, 30)}")]
    rows += [(21, f"{prose(22, 10)}\n{passage}\t{prose(23, 10)} {passage}"), (22, "x " * 100)]
    rows += [(23, passage), (24, prose(1, 60_000)[:5000])]
    found = substrings.remove_repeats(frame(spark, rows)).collect()
    expected = brute_strip(rows)
    wanted = [(doc_id, *expected[doc_id, text]) for doc_id, text in rows]
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in found]
    assert sorted(got, key=str) == sorted(wanted, key=str)
    assert substrings.remove_repeats(empty(spark)).collect() == []


def test_gap_codes_round_trip():
    rng = np.random.default_rng(2)
    for offsets in ([], [0], [65535], [0, 255, 256, 511, 65000], np.unique(rng.integers(0, 65536, 900))):
        coded = substrings._gaps(np.array(offsets, np.int64))
        assert substrings._offsets(coded).tolist() == list(offsets)


def test_a_task_gives_freed_memory_back():
    """Also where a small block behind the freed ones is still held."""
    held = []

    def resident():
        with open("/proc/self/status") as file:
            return int(re.search(r"RssAnon:\s+(\d+)", file.read()).group(1)) / 1024

    def run(_):
        parts = [np.ones(8_000) for _ in range(3_000)]  # 64 KB each
        held.append([np.ones(100) for _ in range(1_000)])
        yield len(parts)

    before = resident()
    assert list(batches.freeing(run)(iter([]))) == [3_000]
    assert resident() - before < 60 and held
