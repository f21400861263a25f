import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from paylake.llm import balanced_packing, doc_tree, fill_middle
from tests.llm.helpers import ODD, ascii_lower, frame, random_text

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute_search(rows, items, k=20):
    docs = [(i, Counter(TERM.findall(ascii_lower(t)))) for i, t in rows]
    docs = [(i, c) for i, c in docs if c]
    n_docs, n_terms = len(docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in docs:
            m = 75 + 25 * sum(c.values()) * n_docs // n_terms
            s = sum(q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 12 * m))
                    for t, q in Counter(TERM.findall(ascii_lower(text))).items() if c[t])
            if s > 0:
                scores.append((-s, i is not None, i or 0, i))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scores, key=lambda x: x[:3])[:k])]
    return sorted(out, key=repr)


def _bench(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize(("block_bytes", "tree_entries"), [(1 << 20, 1 << 20), (300, 400), (1, 30)])
def test_ranked_search_equals_brute_force(spark, block_bytes, tree_entries):
    rng = np.random.default_rng(11)
    rows = [(i, random_text(rng, int(rng.integers(1, 60)), 80)) for i in range(300)]
    rows += [(1000 + i, rows[3][1]) for i in range(150)]  # a group of copies over many leaves: ties by id
    rows += [(2000 + i, rows[3][1] + f" w{i % 7}") for i in range(80)]
    items = [(i, random_text(rng, int(rng.integers(1, 15)), 80)) for i in range(12)]
    items += [(20, rows[3][1]), (21, "W1 w1, W1 (w2)"), (22, ""), (23, None), (24, "none of these"), (25, "naïve ÉT w5")]
    got = doc_tree.search(frame(spark, rows).repartition(3), _bench(spark, items), block_bytes=block_bytes, tree_entries=tree_entries)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute_search(rows, items)


def test_ranked_search_odd_rows(spark):
    items = [(0, "a null id and a text"), (1, "same text under"), (2, "words on x é"), (3, "x" * 300000)]
    got = doc_tree.search(frame(spark, ODD), _bench(spark, items))
    assert sorted(map(tuple, got.collect()), key=repr) == brute_search(ODD, items)
    assert doc_tree.search(frame(spark, []), _bench(spark, items)).count() == 0
    assert doc_tree.search(frame(spark, ODD), _bench(spark, [])).count() == 0
    assert doc_tree.search(frame(spark, ODD), _bench(spark, [(0, None), (1, " ,")])).count() == 0


def test_tree_bounds_hold_and_cut_the_search():
    rng = np.random.default_rng(12)
    paths = [sorted(rng.choice(200, int(rng.integers(1, 30)), replace=False) ** 2 // 200) for _ in range(4000)]
    paths = [sorted(set(p)) for p in paths]
    at = np.concatenate(([0], np.cumsum([len(p) for p in paths])))
    terms, counts = np.concatenate(paths), rng.integers(1, 9, at[-1])
    tree = doc_tree.Tree(np.arange(4000), rng.integers(75, 200, 4000), at, terms, counts, leaf=16)
    scored = 0
    for _ in range(20):
        weights = np.zeros(200, np.int64)
        weights[rng.integers(0, 200, 8)] = rng.integers(1, 9000, 8)
        every = np.add.reduceat(weights[tree.terms] * tree.shares, tree.at[:-1])
        open_ = [tree.root]
        while open_:
            node = open_.pop()
            assert tree._bound(node, weights) >= every[node.lo:node.hi].max()
            assert node.first_id == tree.ids[node.lo:node.hi].min() and node.m == tree.m[node.lo:node.hi].min()
            if node.children:
                assert [c.lo for c in node.children[1:]] + [node.hi] == [c.hi for c in node.children]
            open_ += node.children
        best = []
        scored += tree.search(weights, best, 20)
        want = sorted(((int(s), -int(i)) for s, i in zip(every, tree.ids) if s > 0), reverse=True)[:20]
        assert sorted(best, reverse=True) == want
    assert scored < 0.8 * 20 * 4000


def brute_middle(i, text, joining="A-Za-z"):
    text = text or ""
    units = re.findall(rf"[{joining}]+|[^{joining}]" if joining else r"(?s).", text)
    n = len(units)
    digest = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h = [int(digest[8 * j:8 * j + 8], 16) for j in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in fill_middle.MARKS) or h[2] % 100 >= 90:
        return i, n, "plain", None, None, text, text
    form = "spm" if h[3] % 100 < 20 else "psm"
    return i, n, form, len(p), len(m), f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}", text


def test_fill_in_middle_equals_brute_force(spark):
    rng = np.random.default_rng(13)
    letters = np.array(list("abzAZ  09_\n\té日😀<>PSM"))
    rows = [(i, "".join(rng.choice(letters, int(rng.integers(0, 90))))) for i in range(400)]
    rows += [(-5, "has a <M> mark"), (1 << 40, "abc"), (401, "word"), (402, "é"), (403, "́x"), (404, "a" * 200000 + " é" * 9999)] + ODD
    made = fill_middle.transform(frame(spark, rows).repartition(5))
    made = made.withColumn("back", fill_middle.restore(F.col("output"), F.col("form")))
    got = sorted(map(tuple, made.collect()), key=repr)
    assert got == sorted((brute_middle(i, t) for i, t in rows), key=repr)
    assert {x[2] for x in got} == {"plain", "psm", "spm"}
    assert fill_middle.transform(frame(spark, [])).count() == 0


@pytest.mark.parametrize("joining", ["", "0123456789"])
def test_fill_in_middle_other_units(spark, joining):
    rows = [(i, t) for i, t in enumerate(["ab12é345 x9", "1234567890" * 20, "日本 2024年"] * 20)]
    made = fill_middle.transform(frame(spark, rows), joining=joining)
    made = made.withColumn("back", fill_middle.restore(F.col("output"), F.col("form")))
    assert sorted(map(tuple, made.collect())) == sorted(brute_middle(i, t, "0-9" if joining else "") for i, t in rows)


def test_wavelet_matrix_ranks():
    rng = np.random.default_rng(14)
    for n in (0, 1, 63, 64, 65, 1000):
        symbols = rng.integers(0, 8, n).astype(np.uint8)
        matrix = fill_middle.WaveletMatrix(symbols, 3)
        for s in range(8):
            want = np.concatenate(([0], np.cumsum(symbols == s)))
            assert (matrix.rank(s, np.arange(n + 1)) == want).all()


def brute_differencing(sizes, k):
    """Partial partitions as full lists of k windows, the two most uneven merged in turn."""
    parts = [[0] * (k - 1) + [int(s)] for s in sizes]
    while len(parts) > 1:
        parts.sort(key=lambda p: p[0] - p[-1])
        a, b = parts.pop(0), parts.pop(0)
        parts.append(sorted(x + y for x, y in zip(a, reversed(b), strict=True)))
    return parts[0]


def test_differencing_near_equal():
    rng = np.random.default_rng(15)
    for k in (1, 2, 5, 16):
        for n in (1, 3, 40, 300):
            sizes = rng.integers(1, 257, n)
            window = balanced_packing.differencing(sizes, k)
            sums = np.bincount(window, sizes, k)
            assert len(window) == n and window.min() >= 0 and window.max() < k
            want = brute_differencing(sizes, k)
            assert sums.sum() == sum(want) and sums.max() - sums.min() <= max(want) - min(want) + 8
    assert sorted(np.bincount(balanced_packing.differencing(np.array([8, 7, 6, 5, 4]), 2), [8, 7, 6, 5, 4])) == [14, 16]
    assert len(balanced_packing.differencing(np.zeros(0, np.int64), 3)) == 0


def test_windows_rise_until_none_is_over():
    for sizes in ([5, 5, 5], [10], [6, 6, 6, 6], [9, 1, 9, 1, 2]):
        window = balanced_packing.deal(np.array(sizes), 10)
        assert np.bincount(window, sizes).max() <= 10


def test_balanced_packing_round_trip(spark):
    import tokenizers
    plain = tokenizers.Tokenizer.from_file(balanced_packing.vocabulary_path())
    rng = np.random.default_rng(16)
    rows = [(i, random_text(rng, int(n))) for i, n in enumerate(rng.integers(1, 3000, 120))]
    rows += [(500, "a <|endoftext|> in a text"), (501, "<|endoftext|>"), (502, "日本語 😀   x"), (503, "é" * 5000)]
    rows += [r for r in ODD if r[0] is not None and r[0] != 5] + [(None, "null id " * 400)]
    packed = balanced_packing.pack(frame(spark, rows).repartition(3)).withColumn("crc", F.crc32("ids")).collect()
    parts, windows = defaultdict(dict), defaultdict(list)
    for r in packed:
        ids = np.frombuffer(r["ids"], "<u4")
        assert len(ids) == r["length"] > 0 and r["crc"] == zlib.crc32(r["ids"])
        parts[r["doc_id"], r["doc_tokens"]][r["start"]] = ids
        windows[r["sequence_id"]].append((r["offset"], r["length"]))
    got = Counter()
    for (i, n), p in parts.items():
        assert [s for s in sorted(p)] == np.concatenate(([0], np.cumsum([len(p[s]) for s in sorted(p)])[:-1])).tolist()
        ids = np.concatenate([p[s] for s in sorted(p)]).tolist()
        assert len(ids) == n
        got[i, tuple(ids)] += 1
    twice = {r for r in rows if rows.count(r) > 1}
    want = Counter((i, (*plain.encode(t or "", add_special_tokens=False).ids, 0)) for i, t in set(rows))
    assert got == want
    assert len(packed) == sum(len(p) for p in parts.values()) + sum(
        len(parts[i, len(plain.encode(t).ids) + 1]) * (rows.count((i, t)) - 1) for i, t in twice)
    sums = []
    for spans in windows.values():
        spans.sort()
        assert [s for s, _ in spans] == [0, *np.cumsum([n for _, n in spans])[:-1].tolist()]
        sums.append(sum(n for _, n in spans))
    assert max(sums) <= 1024 and sum(1024 - s for s in sums) < 0.03 * sum(sums)
    assert balanced_packing.pack(frame(spark, [])).count() == 0
    odd = balanced_packing.pack(frame(spark, ODD))
    assert odd.filter("start = 0").count() == len(ODD)
    assert odd.agg(F.sum("length")).first()[0] == sum(len(plain.encode(t or "").ids) + 1 for _, t in ODD)


def test_special_tokens_in_texts():
    import tokenizers
    plain = tokenizers.Tokenizer.from_file(balanced_packing.vocabulary_path())
    coder = balanced_packing.JsonTokenizer(open(balanced_packing.vocabulary_path(), "rb").read())
    texts = ["a<|endoftext|>b c", "<|endoftext|>", "", "<|endoftext|><|endoftext|> x", None, " hi ", "<|endoftext |>"]
    ids, at = coder.encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [plain.encode(t or "", add_special_tokens=False).ids for t in texts]
