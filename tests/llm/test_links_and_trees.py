"""Merkle manifest, spelling variants and parity-sketch join against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from rookery.llm import manifest, paritysketch, queries, spelling
from rookery.llm.batches import distinct
from tests.llm.test_text_operators import AWKWARD, prose, shingle_set

UPPER, LOWER = spelling.UPPER, spelling.LOWER
EXTRA = "node STRING, word STRING, row STRING, key STRING, n STRING"


def saved(spark, path, rows, schema):
    """A folder with a documents table, and extra columns that operators use inside."""
    more = ("a", "b", "c", "d", "e")
    frame = spark.createDataFrame([(*row, *more) for row in rows], f"{schema}, {EXTRA}")
    frame.write.parquet(f"{path}/documents.parquet")
    return path


# --- manifest ---------------------------------------------------------------


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_manifest(rows):
    def leaf_of(row, text):
        doc_id, _, lang, source, n_chars = row
        values = (doc_id, source, lang, n_chars, text)
        return sha(
            "".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)
        )

    def fold(level):
        """All levels up to one node, and each first node's path of siblings."""
        paths, at = [[] for _ in level], list(range(len(level)))
        while len(level) > 1:
            for n, k in enumerate(at):
                run = range(k // 8 * 8, min(len(level), k // 8 * 8 + 8))
                paths[n].append(([level[i] for i in run if i < k], [level[i] for i in run if i > k]))
            level = [sha("".join(level[i : i + 8])) for i in range(0, len(level), 8)]
            at = [k // 8 for k in at]
        return level[0], paths

    groups = {}
    for row in rows:
        text, doc_id = row[1], row[0]
        shown = text
        if doc_id is not None and text is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0:
            shown = text.translate(str.maketrans(UPPER, LOWER))
        groups.setdefault(row[2], []).append((doc_id, leaf_of(row, text), leaf_of(row, shown)))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[name] = fold([x[1] for x in groups[name]])
    root, over = fold([trees[name][0] for name in names])
    out = []
    for name, top in zip(names, over):
        subroot, paths = trees[name]
        for (doc_id, leaf, claim), path in zip(groups[name], paths):
            folded = claim
            for before, after in path + top:
                folded = sha("".join([*before, folded, *after]))
            proof = sha("".join("".join(a + b) for a, b in path + top))
            out.append((doc_id, leaf, subroot, root, proof, folded, folded == root))
    return sorted(out, key=str)


def manifest_rows(counts):
    rows = []
    for lang, count in counts:
        for n in range(count):
            text = None if n % 11 == 3 else f"Text {n} É" if n % 7 else ""
            rows.append((10 * len(rows) % 7919, text, lang, "s" if n % 3 else None, n))
    return rows


DOCUMENTS = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG"


@pytest.mark.parametrize(
    "counts",
    [
        [("en", 1)],
        [("en", 8)],
        [("en", 9), (None, 1)],
        [("en", 1300), ("de", 513), (None, 64), ("é", 65), ("z", 1)],
        [(f"l{n}", 1 + n % 3) for n in range(70)],
    ],
    ids=["lone", "run", "null", "stretches", "groups"],
)
def test_manifest_of_small_trees(spark, folder, counts):
    rows = manifest_rows(counts)
    got = queries.op11_manifest(spark, saved(spark, folder, rows, DOCUMENTS)).collect()
    assert sorted(map(tuple, got), key=str) == brute_manifest(rows)


def test_manifest_of_awkward_rows(spark, folder):
    rows = [(doc_id, text, "en", None, None) for doc_id, text in AWKWARD]
    rows += [(None, None, None, None, None)] * 3 + [(8, "one", "en", "s", 3)] * 20
    got = queries.op11_manifest(spark, saved(spark, folder, rows, DOCUMENTS)).collect()
    assert sorted(map(tuple, got), key=str) == brute_manifest(rows)


def test_manifest_of_nothing(spark, folder):
    path = saved(spark, folder, [], DOCUMENTS)
    assert queries.op11_manifest(spark, path).collect() == []


def test_no_node_row_is_met_by_more_than_a_stretch(spark):
    rows = spark.range(3000).select(F.col("id").alias("k"), F.lit("g").alias("g"))
    made = manifest.build(rows, ["k"], "g", "k")
    low = F.shiftleft(F.lit(1).cast("long"), 56) - 1
    places = made.nodes.select((F.shiftright("node", 56)).alias("level"), F.col("node").bitwiseAND(low).alias("p"))
    counts = {r.level: r.n for r in places.groupBy("level").agg(F.count("*").alias("n")).collect()}
    assert counts == {1: 375, 2: 47, 3: 6}
    assert made.nodes.select("node").distinct().count() == made.nodes.count()
    leaves = [hashlib.sha256(f"{len(str(k))}:{k}".encode()).hexdigest() for k in range(3000)]
    while len(leaves) > 1:
        leaves = [sha("".join(leaves[i : i + 8])) for i in range(0, len(leaves), 8)]
    assert made.root == leaves[0]


# --- spelling ---------------------------------------------------------------


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    k = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[k + 1 :] == b[k + 1 :] or a[k:] == b[k + 1 :] or a[k + 1 :] == b[k:]


def brute_variants(counts):
    out = {}
    for word, n in counts.items():
        beside = sorted((-m, other) for other, m in counts.items() if near(word, other))
        form = beside[0][1] if beside and -beside[0][0] >= 10 * n else None
        out[word] = (form, n, len(beside), counts[form] if form else None)
    result = []
    for word, (form, n, count, form_n) in out.items():
        root = word
        while out[root][0]:
            root = out[root][0]
        result.append((word, form, root, n, count, form_n))
    return sorted(result)


def brute_words(rows):
    counts = {}
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(str.maketrans(UPPER, LOWER))
            code = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if code % 31 == 0:
                at = code % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] = counts.get(run, 0) + 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def test_variants_of_random_words(spark):
    pick = np.random.default_rng(5)
    counts = {}
    for _ in range(150):
        letters = "abc" if pick.random() < 0.5 else "abcdeéüÀx"
        word = "".join(pick.choice(list(letters), pick.integers(7, 11)))
        counts[word] = int(10 ** pick.uniform(0.4, 4))
        for _ in range(4):
            at, new = pick.integers(len(word) + 1), str(pick.choice(list(letters)))
            other = [word[:at] + new + word[at:], word[:at] + new + word[at + 1 :], word[:at] + word[at + 1 :]]
            other = other[pick.integers(3)]
            if len(other) >= 7:
                counts.setdefault(other, int(10 ** pick.uniform(0.4, 3)))
    frame = spark.createDataFrame(list(counts.items()), "word STRING, n LONG")
    got = spelling.variants(frame).select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert sorted(map(tuple, got)) == brute_variants(counts)


def test_chains_lead_to_their_root(spark):
    words = ["aaaaaaab", "aaaaaabb", "aaaaabbb", "aaaabbbb", "aaabbbbb", "aabbbbbb"]
    counts = {word: 2 * 10**k for k, word in enumerate(words)}
    frame = spark.createDataFrame(list(counts.items()), "word STRING, n LONG")
    got = {r.word: r.root for r in spelling.variants(frame).collect()}
    assert set(got.values()) == {words[-1]}


def test_pivots_do_not_overlap_and_are_the_rarest():
    pick = np.random.default_rng(6)
    size = pick.integers(3, 7, 500)
    weight = pick.integers(1, 50, (500, 6))
    place = np.sort(np.argsort(pick.random((500, 9)), axis=1)[:, :6], axis=1)
    chosen = spelling.pivots(weight, place, size)
    for w, p, n, (a, b) in zip(weight, place, size, chosen):
        totals = [w[i] + w[j] for j in range(n) for i in range(j) if p[j] - p[i] > 1]
        assert p[b] - p[a] > 1 and w[a] + w[b] == min(totals)


def test_spelling_compares_few_words_that_only_share_a_rare_bigram(spark):
    chance = random.Random(12)
    words = {"zq" + "".join(chance.choices("abcdefgh", k=8)) for _ in range(400)}
    words |= {w[:k] + w[k + 1 :] for w in sorted(words)[:40] for k in (0, 3, 5, 9)}
    words |= {w[:k] + "x" + w[k:] for w in sorted(words)[:40] for k in (0, 4, 10)}
    words |= {w[:k] + "x" + w[k + 1 :] for w in sorted(words)[:40] for k in (1, 6)}
    frame = spark.createDataFrame([(w,) for w in sorted(words)], "word STRING")
    assert spelling.candidates(frame).count() < 60 * len(words)

    def near(a, b):
        a, b = sorted((a, b), key=len)
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))

    got = {(r.left, r.right) for r in spelling.near_pairs(frame).collect()}
    assert got == {(a, b) for a in words for b in words if a < b and near(a, b)}


def test_spelling_of_awkward_rows(spark, folder):
    rows = [*AWKWARD, (12, "Überall überALL ÜBERALL straßenbahn×÷ " * 3), (None, "Ärgerlich " * 40)]
    rows += [(n, "necessary " * 5 + "receive received") for n in range(100, 200)]
    path = saved(spark, folder, rows, "doc_id LONG, text STRING")
    got = queries.op12_spelling(spark, path).collect()
    assert sorted(map(tuple, got)) == brute_variants(brute_words(rows))
    assert any(r.form for r in got)


def test_spelling_of_nothing(spark, folder):
    for part, rows in enumerate(([], [(1, None), (2, "short words")])):
        path = saved(spark, f"{folder}/{part}", rows, "doc_id LONG, text STRING")
        assert queries.op12_spelling(spark, path).collect() == []


# --- parity sketches --------------------------------------------------------


def brute_links(rows):
    order = lambda doc_id: -1 if doc_id is None else doc_id
    sets = [(doc_id, shingle_set(text)) for doc_id, text in rows]
    group = list(range(len(sets)))
    for i, (_, x) in enumerate(sets):
        for j, (_, y) in enumerate(sets[:i]):
            if x and y and 100 * len(x & y) >= 80 * len(x | y) and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    lowest = {}
    for g, (doc_id, _) in zip(group, sets):
        lowest[g] = min(lowest.get(g, doc_id), doc_id, key=order)
    return sorted(
        ((d, len(s), lowest[g]) for g, (d, s) in zip(group, sets)), key=str
    )


def found_links(spark, rows):
    frame = spark.createDataFrame(
        [(*row, "a", "b", "c", "d", "e") for row in rows], f"doc_id LONG, text STRING, {EXTRA}"
    )
    return sorted(map(tuple, paritysketch.linked_classes(frame).collect()), key=str)


def test_links_of_awkward_rows(spark):
    assert found_links(spark, AWKWARD) == brute_links(AWKWARD)
    assert found_links(spark, []) == []


def edited(text, share, seed):
    """The text with every so many words replaced."""
    pick, out = np.random.default_rng(seed), text.split()
    for at in pick.choice(len(out), round(len(out) * share), replace=False):
        out[at] = f"w{pick.integers(10**6)}"
    return " ".join(out)


def test_links_at_the_threshold(spark):
    rows = []
    for size in (5, 6, 7, 9, 12, 20, 33, 60, 150, 400, 1500):
        base = prose(size, size)
        for k in range(8):  # an end that differs: the similarity falls in small steps
            keep = max(1, round(size * (1 - k / 30)))
            rows.append((len(rows), " ".join(base.split()[:keep] + [f"x{k}{n}" for n in range(k % 3)])))
        rows += [(len(rows) + k, edited(base, 0.02 * k, k)) for k in range(4)]
    assert found_links(spark, rows) == brute_links(rows)


def test_links_of_a_large_group(spark):
    base = prose(7, 200)
    passage = prose(8, 60)
    rows = [(n, edited(base, 0.01 + 0.002 * (n % 12), n)) for n in range(300)]
    rows += [(1000 + n, passage + " " + prose(9 + n, 60)) for n in range(100)]
    rows += [(2000 + n, base) for n in range(20)]
    assert found_links(spark, rows) == brute_links(rows)


def random_set(pick, size):
    return np.unique(pick.integers(0, 2**63, size, dtype=np.uint64) * np.uint64(2))


def test_linked_sets_share_a_key_and_few_bits():
    pick = np.random.default_rng(11)
    for size in [*range(5, 40), 60, 100, 137, 300, 999, 5000] * 4:
        one = random_set(pick, size)
        gone = pick.integers(0, len(one) // 5 + 1)
        fresh = 0
        while True:  # as many new tokens as a link allows
            left = len(one) - gone
            if not paritysketch.similar(left, len(one), left + fresh + 1):
                break
            fresh += 1
        kept = np.delete(one, pick.choice(len(one), gone, replace=False))
        other = np.union1d(kept, random_set(pick, fresh))
        both = len(np.intersect1d(one, other))
        if not paritysketch.similar(both, len(one), len(other)):
            continue
        values = np.concatenate([one, other])
        bounds = np.array([0, len(one), len(values)])
        keys, ends = paritysketch.block_keys(values, bounds)
        if len(one) != both or len(other) != both:
            assert len(np.intersect1d(keys[: ends[1]], keys[ends[1] :]))
        flat, starts = paritysketch.bit_sketches(values, bounds)
        sketches = paritysketch.Sketches(flat, starts[:-1] + 1, np.diff(starts) - 1, np.diff(bounds))
        close = paritysketch.closeness(sketches, sketches, np.array([0]), np.array([1]))
        assert close[0] >= 1 + paritysketch.most_apart(len(one), len(other)) - (
            len(one) + len(other) - 2 * both
        )


def test_unlike_sets_share_no_keys():
    pick = np.random.default_rng(12)
    sets = [random_set(pick, size) for size in (50, 70, 300, 300, 301)]
    values, bounds = np.concatenate(sets), np.cumsum([0, *map(len, sets)])
    keys, ends = paritysketch.block_keys(*distinct(values, bounds))
    assert len(np.unique(keys)) == len(keys) == ends[-1]
