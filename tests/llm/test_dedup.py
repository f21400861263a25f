import hashlib

import numpy as np
import pytest

from paylake.llm import near_dup, substring_dedup
from tests.llm.helpers import ODD, ascii_lower, frame, random_text, words


def brute_substring(rows):
    seen, out = {}, {}
    for i, t in sorted(rows):
        w, gone = words(t), set()
        for s in range(len(w) - 19):
            key = tuple(w[s:s + 20])
            if key in seen:
                gone.update(range(s, s + 20))
            seen.setdefault(key, (i, s))
        kept = [x for k, x in enumerate(w) if k not in gone]
        out[i] = (len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest())
    return out


def corpus(n=60, seed=0):
    rng = np.random.default_rng(seed)
    base = [random_text(rng, int(rng.integers(1, 300))) for _ in range(n)]
    passage = random_text(rng, 55)
    rows = []
    for i, t in enumerate(base):
        w = t.split()
        if i % 4 == 0:
            k = int(rng.integers(len(w) + 1))
            w = w[:k] + passage.split() + w[k:]
        if i % 5 == 1 and i > 5:
            w = base[i - 3].split()
        if i % 7 == 2 and i > 5:
            w = base[i - 2].split()[:50] + w + base[i - 1].split()[10:35]
        if i % 9 == 3:
            w = w[:30] + w[:30]
        rows.append((i, " ".join(w)))
    return rows


@pytest.mark.parametrize("seed", [0, 1])
def test_substring_dedup_equals_brute_force(spark, seed):
    rows = corpus(seed=seed)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"])
           for r in substring_dedup.dedup(frame(spark, rows).repartition(5)).collect()}
    assert got == brute_substring(rows)


def test_factors_are_copies_of_earlier_text(spark):
    rows = corpus()
    text = {i: words(t) for i, t in rows}
    n = 0
    for r in substring_dedup.dedup(frame(spark, rows)).collect():
        for f in r["factors"]:
            assert f["n"] >= 20 and (f["ref_id"], f["ref_start"]) < (r["doc_id"], f["start"])
            assert text[r["doc_id"]][f["start"]:f["start"] + f["n"]] == text[f["ref_id"]][f["ref_start"]:f["ref_start"] + f["n"]]
            n += 1
    assert n


def test_substring_dedup_odd_rows(spark):
    got = substring_dedup.dedup(frame(spark, ODD)).collect()
    assert len(got) == len(ODD)
    by = [(r["doc_id"], r["n_words"], r["n_removed"]) for r in got]
    assert (1, 0, 0) in by and (2, 0, 0) in by and (4, 1, 0) in by
    assert by.count((5, 30, 10)) + by.count((5, 30, 0)) + sum(1 for x in by if x[0] == 5 and x[1] == 30) >= 2
    assert (6, 30, 30) in by  # a whole copy of 5
    assert substring_dedup.dedup(frame(spark, [])).count() == 0


def brute_near(rows, k, similar=80):
    sets, parent = {}, {}
    for i, t in rows:
        w = words(ascii_lower(t))
        sets[i] = {tuple(w[j:j + k]) for j in range(max(len(w) - k + 1, 1))} if w else set()
        parent[i] = i

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= similar * len(sets[a] | sets[b]):
                    x, y = find(a), find(b)
                    parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


@pytest.mark.parametrize("k", [4, 5])
def test_near_duplicates_equal_brute_force(spark, k):
    rng = np.random.default_rng(k)
    rows = []
    for g in range(12):
        w = random_text(rng, int(rng.integers(3, 160)), 3000).split()
        for _ in range(int(rng.integers(1, 9))):
            v = list(w)
            for p in rng.integers(len(v), size=int(rng.integers(0, max(1, len(v) // 25) + 1))):
                v[int(p)] = f"n{int(rng.integers(10**6))}"
            rows.append((len(rows), " ".join(v).upper() if rng.random() < 0.3 else " ".join(v)))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"])
           for r in near_dup.near_duplicates(frame(spark, rows).repartition(3), k=k).collect()}
    assert got == brute_near(rows, k)


def test_chain_of_links_is_one_component(spark):
    w = [f"t{i}" for i in range(200)]
    rows = [(j, " ".join(w[8 * j:8 * j + 100])) for j in range(10)]  # neighbours are alike, the ends are not
    got = {r["doc_id"]: r["component_id"] for r in near_dup.near_duplicates(frame(spark, rows), k=4).collect()}
    assert got == {i: c for i, (_, c, _) in brute_near(rows, 4).items()} and set(got.values()) == {0}


def test_near_duplicates_odd_rows(spark):
    got = near_dup.near_duplicates(frame(spark, ODD)).collect()
    assert len(got) == len(ODD)
    by = {(r["doc_id"], r["n_shingles"]): (r["component_id"], r["kept"]) for r in got}
    assert by[(1, 0)] == (1, True) and by[(2, 0)] == (2, True) and by[(6, 3)] == (5, False)
    assert near_dup.near_duplicates(frame(spark, [])).count() == 0


def test_links_of_rows_without_or_with_repeated_ids(spark):
    rng = np.random.default_rng(21)
    a, b = random_text(rng, 60, 5000), random_text(rng, 60, 5000)
    for i in (None, 1):
        rows = [(i, a), (i, b), (5, b + " more"), (6, "something else altogether " * 3), (i, a), (i, "x y z " + a[:20])]
        got = sorted(((r["doc_id"], r["n_shingles"]), r["component_id"], r["kept"]) for r in near_dup.near_duplicates(frame(spark, rows)).collect()
                     if r["doc_id"] in (5, 6))
        assert [(x[1], x[2]) for x in got] == [(i, False), (6, True)]
        once = near_dup.deduplicate(frame(spark, rows))
        assert once.columns == frame(spark, rows).columns
        assert sorted(r["text"] for r in once.collect()) == sorted([a, b, rows[3][1], rows[5][1]])


def test_sketch_agreement_estimates_similarity():
    rng = np.random.default_rng(5)
    a = rng.integers(0, 2**63, 400).astype(np.uint64)
    b = np.concatenate((a[:300], rng.integers(0, 2**63, 100).astype(np.uint64)))
    s = near_dup.sketch(np.concatenate((np.sort(a), np.sort(b))), np.array([0, 400, 800]), 1024)
    assert (s != near_dup.FULL).all() and abs((s[0] == s[1]).mean() - 0.6) < 0.08
    one = near_dup.sketch(a[:1], np.array([0, 1, 1]), 64)
    assert (one[0] != near_dup.FULL).all() and (one[1] == near_dup.FULL).all()


def test_components_equal_brute_force(spark):
    from paylake.llm.components import components
    rng = np.random.default_rng(11)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (170, 2))] + [(i, i + 1) for i in range(1000, 1090)]
    edges += [(5000, x) for x in range(4900, 5100)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {v: find(v) for e in edges if e[0] != e[1] for v in e}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
