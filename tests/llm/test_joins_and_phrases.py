"""Jaccard join, collocations and hard negatives against brute force, with odd rows and hot groups."""

import math
import random
import re
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F
from test_edges import TEXTS, documents, prose

from haulgrain.llm import collocations as phrases
from haulgrain.llm import hard_negatives as hard
from haulgrain.llm import prefix_join

# --- n-gram Jaccard join


def components_of(spark, rows, extra=False):
    found = prefix_join.jaccard_components(documents(spark, rows, extra)).collect()
    return {r.doc_id: (r.n_shingles, r.component_id) for r in found}


def changed(text, rng, n):
    words = text.split()
    for at in rng.sample(range(len(words)), n):
        words[at] = f"new{rng.randint(0, 10**9)}"
    return " ".join(words)


def test_jaccard_join_of_odd_rows(spark):
    rows = [(d, t) for d, t in TEXTS if d is not None]
    wanted = brute.near_components(rows, k=3, percent=90)
    assert components_of(spark, rows) == wanted == components_of(spark, rows, extra=True)
    assert components_of(spark, []) == {}
    without_id = [(None, prose(1, 60)), (None, None), (5, prose(1, 60))]
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in prefix_join.jaccard_components(documents(spark, without_id)).collect())
    assert got == [("5", 58, "5"), ("None", 0, "None"), ("None", 58, "5")]


def test_jaccard_join_around_the_threshold(spark):
    rng = random.Random(4)
    base = [prose(i, 80 + 40 * i) for i in range(6)]
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(100 + i, changed(base[i % 6], rng, 1 + i % 5)) for i in range(90)]
    words = prose(9, 60).split()
    rows += [(500 + i, " ".join(words[i : i + 40])) for i in range(12)] + [(600 + i, " ".join(words[:i])) for i in range(1, 30)]
    assert components_of(spark, rows) == brute.near_components(rows, k=3, percent=90)


def test_jaccard_join_of_large_groups(spark, monkeypatch):
    """Copies, near copies, near misses of one template and a passage that many documents share; every way is taken."""
    monkeypatch.setattr(prefix_join, "FREQUENT", 8)
    monkeypatch.setattr(prefix_join, "SHORT_LIST", 4)
    monkeypatch.setattr(prefix_join, "SHARE", 7)
    exact = []
    inner = prefix_join.exact_pairs
    monkeypatch.setattr(prefix_join, "exact_pairs", lambda *a: exact.append(1) or inner(*a))
    rng = random.Random(7)
    near, far, passage = prose(20, 150), prose(21, 120), prose(22, 60)
    rows = [(i, near) for i in range(40)]
    rows += [(100 + i, changed(near, rng, 1 + i % 3)) for i in range(60)]
    rows += [(300 + i, changed(far, rng, 4 + i % 4)) for i in range(60)]
    rows += [(500 + i, f"{prose(500 + i, 30)} {passage} {prose(600 + i, 30)}") for i in range(60)]
    rows += [(700 + i, changed(dict(rows)[500 + i], rng, 1)) for i in range(0, 60, 7)]
    assert components_of(spark, rows) == brute.near_components(rows, k=3, percent=90)
    assert exact


def test_jaccard_pairs_grow_with_documents(spark):
    """Pairs verified for a growing group of near copies stay in proportion to it."""
    rng, counts = random.Random(8), {}
    for n in (60, 240):
        text, seen = prose(30, 200), []
        rows = [(i, changed(text, rng, 1)) for i in range(n)]
        inner = prefix_join.verified

        def counting(pairs, *rest, inner=inner, seen=seen):
            seen.append(pairs.count())
            return inner(pairs, *rest)

        prefix_join.verified = counting
        try:
            components_of(spark, rows)
        finally:
            prefix_join.verified = inner
        counts[n] = sum(seen)
    assert counts[240] <= 6 * counts[60] and counts[240] <= 8 * 240


# --- collocations


def collocations_by_brute_force(rows, longest=3, least=10, contained=50, top=2000):
    grams, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(brute.LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for m in range(1, longest + 1):
                grams[lang].update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, f in grams.items():
        wanted = {g: a for g, a in f.items() if len(g) > 1 and a >= least}
        scored, holders = [], Counter()
        for h, b in wanted.items():
            for m in range(2, len(h)):
                for i in range(len(h) - m + 1):
                    holders[h[i : i + m]] = max(holders[h[i : i + m]], b)
        for g, a in wanted.items():
            if g in holders and 100 * holders[g] >= contained * a:
                continue
            score, _, x, y = min((1000000 * a * a // (f[g[:k]] * f[g[k:]]), k, f[g[:k]], f[g[k:]]) for k in range(1, len(g)))
            scored.append((-score, -a, " ".join(g).encode(), x, y))
        for rank, (score, a, g, x, y) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, g.decode(), -a, x, y, total[lang], -score))
    return sorted(out)


def in_languages(spark, rows):
    return spark.createDataFrame([(i, t, lang, None, None) for i, (lang, t) in enumerate(rows)], "doc_id bigint, text string, lang string, source string, n_chars bigint")


def drawn(seed, n, vocabulary):
    rng = random.Random(seed)
    words = [w + ("" if rng.random() < 0.9 else rng.choice(".,;:!?\n\x0b")) for w in rng.choices(vocabulary, k=n)]
    return " ".join(words)


VOCABULARY = ["the", "THE", "of", "a", "é", "data", "x" * 300, "under way", "\x00", "中文", "w1", "w2", "w3", "w4", "w5"]


@pytest.mark.parametrize("longest", [2, 3, 4])
def test_collocations_by_brute_force(spark, longest):
    rows = [(lang, drawn(i, 400, VOCABULARY)) for i, lang in enumerate(["en", "en", "de", None, "und", "en"])]
    rows += [("en", None), (None, ""), ("fr", " \t\n.,"), ("fr", "of the of the"), ("en", "of the " * 3000)]
    wanted = collocations_by_brute_force(rows, longest, 5, 50, 40)
    assert sorted(map(tuple, phrases.collocations(in_languages(spark, rows), longest, 5, 50, 40).collect())) == wanted


def test_collocations_in_small_buckets_with_merges_and_hot_pairs(spark, monkeypatch):
    """No word is very frequent, or all are; buckets merge what they gather again and again; words share a hash at first."""
    rows = [("en", drawn(i, 700, VOCABULARY[:8] + [f"v{j}" for j in range(30)])) for i in range(8)]
    wanted = collocations_by_brute_force(rows)
    for share, gathered in ((1, 1 << 22), (1000, 50)):
        monkeypatch.setattr(phrases, "SHARE", share)
        monkeypatch.setattr(phrases, "GATHERED", gathered)
        assert sorted(map(tuple, phrases.collocations(in_languages(spark, rows)).collect())) == wanted


def test_words_that_share_a_hash_get_others(spark, monkeypatch):
    inner = phrases._word_counts
    clash = lambda texts, seed: inner(texts, seed) if seed else inner(texts, seed).withColumn("word_hash", F.lit(7).cast("bigint"))
    monkeypatch.setattr(phrases, "_word_counts", clash)
    rows = [("en", drawn(i, 300, VOCABULARY)) for i in range(3)]
    words, seed = phrases.word_table(in_languages(spark, rows).select("lang", "text"))
    assert seed == 1 and words.count() == words.select("word").distinct().count() > 5
    monkeypatch.setattr(phrases, "_word_counts", inner)


def test_collocations_of_odd_rows(spark):
    assert phrases.collocations(documents(spark, [])).collect() == []
    plain = phrases.collocations(documents(spark), least=2).collect()
    clash = phrases.collocations(documents(spark, extra=True), least=2).collect()
    assert sorted(plain) == sorted(clash) and {r.lang for r in plain} == {"und"}
    assert sorted(map(tuple, plain)) == collocations_by_brute_force([(None, t) for _, t in TEXTS], least=2)


def test_multikey_quicksort_counts():
    rng = np.random.default_rng(1)
    for depth in (2, 3, 5):
        for _ in range(40):
            n = int(rng.integers(0, 300))
            going, columns = np.ones(n, bool), []
            for _ in range(depth):
                column = rng.integers(1, 6, n).astype(np.uint64)
                column[~going] = 0
                columns.append(column)
                going = going & (rng.random(n) < 0.8)
            weights, wanted = rng.integers(1, 4, n), Counter()
            for i in range(n):
                for d in range(depth):
                    if columns[d][i]:
                        wanted[tuple(int(c[i]) for c in columns[: d + 1])] += int(weights[i])
            found = phrases.frequent_runs(columns, weights, 7)
            got = {tuple(map(int, r[:-1])): int(r[-1]) for f in found if f for r in zip(*f, strict=True)}
            assert got == {k: v for k, v in wanted.items() if v >= 7}


# --- hard negatives


def hard_by_brute_force(rows, positives=5, negatives=10, low=30, high=90):
    kept = []
    for vec_id, vector, label in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        kept.append((vec_id, (label + 1) % 10 if vec_id % 7 == 0 else label, [math.floor(256 * x) for x in vector]))
    out = []
    for a, label, q in kept:
        if a % 100:
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, p)), b, lb == label) for b, lb, p in kept if b != a and len(p) == len(q))
        own = [(-s, b) for s, b, same in scored if same][:positives]
        for ps, p in own:
            fits = [(-s, b) for s, b, same in scored if not same and 30 * ps <= 100 * -s <= 90 * ps][:negatives]
            out += [(a, p, rank, b, ps, s) for rank, (s, b) in enumerate(fits, 1)]
    return sorted(out)


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")


def random_vectors(seed, n, d, centres=4, noise=0.6):
    rng = np.random.default_rng(seed)
    middle = rng.normal(0, 1 / np.sqrt(d), (centres, d))
    return [(i, (middle[rng.integers(centres)] + noise * rng.normal(0, 1 / np.sqrt(d), d)).tolist(), int(rng.integers(0, 10))) for i in range(n)]


def mined(spark, rows):
    return sorted(map(tuple, hard.hard_negatives(hard.relabelled(vectors(spark, rows))).collect()))


def test_hard_negatives_by_brute_force(spark):
    rows = random_vectors(1, 1500, 16)
    rows += [(2000 + i, rows[300][1], i % 3) for i in range(400)]  # one very common vector
    rows += [(5000, None, 1), (5001, [], 1), (5100, [], 1), (5102, [], 2), (5200, [1.0, None], 1), (5201, [float("nan")] * 16, 2), (5300, [0.0] * 16, 3)]
    rows += [(5400, [float("inf")] * 16, 3), (5500, rows[100][1], None), (5600, [0.5] * 3, 4), (5601, [0.5] * 3, 4), (5602, [0.2] * 3, 5), (-100, rows[5][1], 2)]
    wanted = hard_by_brute_force(rows)
    assert mined(spark, rows) == wanted and len(wanted) > 500
    assert mined(spark, rows + rows[:50] + rows[-5:]) == wanted  # repeated rows count once


def test_hard_negatives_in_small_groups_and_large_numbers(spark, monkeypatch):
    monkeypatch.setattr(hard, "BLOCK_BYTES", 1 << 10)
    monkeypatch.setattr(hard, "GROUP_ANCHORS", 4)
    rows = [(i, [x * 40000 for x in v], label % 3) for i, v, label in random_vectors(2, 900, 8)]
    assert mined(spark, rows) == hard_by_brute_force(rows)


def test_hard_negatives_of_odd_tables(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0, 0.0], 1), (2, [1.0, 0.1], 2)]) == []
    assert mined(spark, [(100, [1.0, 0.0], 1)]) == []
    rows = random_vectors(3, 300, 4)
    plain = mined(spark, rows)
    extra = vectors(spark, rows)
    for name in ("dim", "curve", "anchor", "part", "block", "score", "rank", "grp"):
        extra = extra.withColumn(name, F.lit("own"))
    assert sorted(map(tuple, hard.hard_negatives(hard.relabelled(extra)).collect())) == plain
    with_null = vectors(spark, rows + [(None, [1.0] * 4, 1)])
    assert sorted(map(tuple, hard.hard_negatives(hard.relabelled(with_null)).collect())) == plain


def test_zone_maps_leave_blocks_unread(spark):
    """Far clusters: the windows of an anchor do not read the blocks of vectors that point elsewhere."""
    rng = np.random.default_rng(5)
    rows = []
    for i in range(4000):
        axis = i // 500
        vector = rng.normal(0, 0.02, 8)
        vector[axis] += 1.0
        rows.append((i, vector.tolist(), i % 10))
    seen = {}
    inner = hard._must_read

    def counting(groups, zones):
        found = inner(groups, zones)
        seen["read"], seen["all"] = found.count(), groups.count() * zones.select("block").distinct().count()
        return found

    hard._must_read = counting
    try:
        got = mined(spark, rows)
    finally:
        hard._must_read = inner
    assert got == hard_by_brute_force(rows)
    assert seen["read"] < seen["all"]


def test_curve_keeps_neighbours_together():
    """On a full grid the key orders cells so that successive ones touch."""
    for d in (2, 3):
        bits = 3
        level = np.stack(np.meshgrid(*[np.arange(1 << bits)] * d, indexing="ij"), axis=-1).reshape(-1, d)
        turn = (level + 0.5) / (1 << bits)
        values = np.tan((turn - 0.5) * np.pi) * hard.SCALE / np.sqrt(d)
        order = sorted(range(len(level)), key=hard.hilbert_keys(values, bits=bits).__getitem__)
        steps = np.abs(np.diff(level[order], axis=0)).sum(axis=1)
        assert (steps == 1).all()
