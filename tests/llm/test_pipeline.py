"""The pipeline's stages against brute force on the smallest tables."""

from collections import Counter

import numpy as np

import corpus_pipeline
from paylake.llm import packing
from paylake.llm.common import materialize
from tests.llm.helpers import CLASHES, ODD, ascii_lower, frame, words
from tests.llm.test_dedup import brute_near
from tests.llm.test_models_and_mixing import brute_targets
from tests.llm.test_text_operators import ITEM, brute_measures

SF = "/root/testdata/sf0.001"


def kept_by_rules(text):
    n, chars, symbols, dup, rep = brute_measures(text)
    return not (n < 20 or 100 * rep > 30 * n or 10 * symbols > 6 * n or (dup >= 3 and 200 * rep > 30 * n) or chars < 2 * n or chars > 20 * n)


def contaminated(text, windows):
    w, hit = ITEM.findall(ascii_lower(text)), set()
    for n, known in windows.items():
        for s in range(len(w) - n + 1):
            if tuple(w[s:s + n]) in known:
                hit.update(range(s, s + n))
    return bool(hit) and 20 * len(hit) >= len(w)


def test_stages_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, rows = docs.columns, {r["doc_id"]: r for r in docs.collect()}
    windows = {}
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        x = ITEM.findall(ascii_lower(r["text"]))
        n = min(13, len(x))
        for s in range(len(x) - n + 1 if n else 0):
            windows.setdefault(n, set()).add(tuple(x[s:s + n]))
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF), "test-stage")
        out[name] = docs
        if name != "token packing":
            assert docs.columns == columns
    ids = {k: sorted(r["doc_id"] for r in v.select("doc_id").collect()) for k, v in out.items() if k != "token packing"}
    want = sorted(i for i, r in rows.items() if kept_by_rules(r["text"]))
    assert ids["quality rules"] == want
    near = brute_near([(i, rows[i]["text"]) for i in want], 5)
    want = [i for i in want if near[i][2]]
    assert ids["near duplicates"] == want and len(want) < len(near)
    want = [i for i in want if not contaminated(rows[i]["text"], windows)]
    assert ids["decontamination"] == want
    size, goal, got, largest = Counter(), {}, Counter(), Counter()
    for i in want:
        size[rows[i]["source"]] += len(words(rows[i]["text"]))
        largest[rows[i]["source"]] = max(largest[rows[i]["source"]], len(words(rows[i]["text"])))
    for i, n in Counter(ids["mixing"]).items():
        assert n <= 2
        got[rows[i]["source"]] += n * len(words(rows[i]["text"]))
    goal = brute_targets(dict(size))
    assert all(abs(got[s] - goal[s]) <= largest[s] for s in goal)
    coder = packing.Tokenizer(open(packing.VOCABULARY, "rb").read()).coder
    tokens = Counter()
    for r in packing.segments(out["token packing"]).collect():
        tokens[r["doc_id"]] += len(np.frombuffer(r["ids"], "<u2"))
    assert tokens == {i: n * (len(coder.encode_ordinary(rows[i]["text"])) + 1) for i, n in Counter(ids["mixing"]).items()}


def test_stages_take_odd_rows_and_clashing_columns(spark):
    clean = [(100 + i, " ".join(f"word{i}x{j}" for j in range(40))) for i in range(5)]
    for rows, n in ((ODD + clean, 5), ([], 0)):
        docs = frame(spark, rows)
        columns = docs.columns
        assert set(CLASHES) < set(columns)
        for name, stage in corpus_pipeline.STAGES:
            docs = materialize(stage(spark, docs, SF), "test-odd")
            if name != "token packing":
                assert docs.columns == columns
            if name == "decontamination":
                assert docs.filter("doc_id >= 100").count() == n
