"""The vectorised kernel against plain Python."""

import random
import re

import numpy as np
import pyarrow as pa

from haulgrain.llm import chaining, line_dedup, minhash, pii
from haulgrain.llm import kernel as K


def texts(seed, n=60):
    r = random.Random(seed)
    return ["".join(r.choice("ab é\n\t  |Z9") for _ in range(r.randint(0, 30))) for _ in range(n)] + ["", "\n", " ", "a"]


def test_words_lines_and_chunks():
    for limit in (1, 40, 1 << 20):
        own = texts(limit)
        found_words, found_lines, rows = [], [], []
        for lo, hi, buf, offsets in K.chunks(pa.array([None, *own]), limit):
            rows += range(lo, hi)
            for pick, out in ((K.spans(K.NON_SPACE[buf], offsets), found_words), (K.split(buf, offsets, 10), found_lines)):
                starts, ends, first = pick
                pieces = [buf[s:e].tobytes().decode() for s, e in zip(starts, ends, strict=True)]
                out += [pieces[a:b] for a, b in zip(first[:-1], first[1:], strict=True)]
        assert rows == list(range(len(own) + 1))
        assert found_words == [[], *(re.findall(r"[^\x20\x09-\x0D]+", t) for t in own)]
        assert found_lines == [[""], *(t.split("\n") for t in own)]


def test_hashes_depend_on_content_only():
    own = texts(7)
    by_text = {}
    for limit in (1, 1 << 20):
        for _, _, buf, offsets in K.chunks(pa.array(own), limit):
            starts, ends, first = K.spans(K.NON_SPACE[buf], offsets)
            hashes = K.span_hash(K.prefix_hash(buf), starts, ends)
            for s, e, h in zip(starts, ends, hashes.tolist(), strict=True):
                assert by_text.setdefault(buf[s:e].tobytes(), h) == h
            values, at, _ = K.grams(hashes, first, 3)
            owner = K.owners(first)
            assert all(owner[i] == owner[i + 2] for i in at) and len(values) == sum(max(0, n - 2) for n in np.diff(first))
    assert len(set(by_text.values())) == len(by_text)


def test_signatures_estimate_similarity():
    r = np.random.default_rng(1)
    probes = minhash.probe_order()
    for size in (3, 40, 2000):
        agree = []
        for _ in range(60):
            common = r.integers(0, 1 << 62, size).astype(np.uint64)
            a, b = (np.unique(np.append(common, r.integers(0, 1 << 62, size // 3).astype(np.uint64))) for _ in "ab")
            agree.append((minhash.densified(a, probes) == minhash.densified(b, probes)).mean())
        assert abs(np.mean(agree) - size / (size + 2 * (size // 3))) < 0.05


def test_winnowing_selects_a_line_of_every_window():
    r = np.random.default_rng(2)
    hashes = r.integers(0, 5, 300).astype(np.uint64)
    first = np.array([0, 2, 120, 300])
    values, at, chosen = line_dedup.winnowed(hashes, first, 3)
    assert len(values) == 116 + 178
    for a, c in zip(at, chosen, strict=True):
        window = hashes[a : a + 3].tolist()
        assert a <= c <= a + 2 and hashes[c] == min(window) and hashes[c] not in window[c - a + 1 :]


def test_seeds_are_selected_in_every_window():
    r = np.random.default_rng(3)
    values, owner = r.integers(0, 50, 200).astype(np.uint64), np.repeat([0, 1, 2], [3, 97, 100])
    chosen = set(chaining.selected(values, owner).tolist())
    for i in range(3, 200 - chaining.WINDOW + 1):
        if owner[i] == owner[i + chaining.WINDOW - 1]:
            assert any(j in chosen for j in range(i, i + chaining.WINDOW))
    assert chosen & {0, 1, 2}


def test_chains_are_the_best_by_quadratic_search():
    r = random.Random(4)
    for _ in range(200):
        n = r.randint(1, 25)
        at = np.array(sorted(r.sample(range(120), n)))
        from_at = np.array([r.randint(0, 120) for _ in range(n)])
        best, k = [], chaining.SEED
        for j in range(n):
            options = [float(k)]
            for i in range(j):
                dx, dy = at[j] - at[i], from_at[j] - from_at[i]
                if dx > 0 and dy > 0:
                    options.append(best[i] + min(k, dx, dy) - chaining.GAP_COST * (max(0, dx - k) + max(0, dy - k)))
            best.append(max(options))
        found = chaining.chained(at, from_at)
        used = [m for _, path in found for m in path]
        assert len(used) == len(set(used))
        for _, path in found:
            assert all(at[a] < at[b] and from_at[a] < from_at[b] for a, b in zip(path, path[1:], strict=False))
        if max(best) >= chaining.LEAST_SCORE and found:
            assert found[0][0] <= max(best) + 1e-9 and found[0][0] >= max(best) - 3 * k * chaining.GAP_COST * n


def test_linear_patterns_match_the_plain_ones():
    import brute

    r = random.Random(6)
    for _ in range(4000):
        text = "".join(r.choice("a1.2@-+ (4)x%9") for _ in range(r.randint(0, 40)))
        spans = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in pii.base_spans(text))
        assert spans == brute.personal(text)[2], text
