import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeward.llm import op6_ngram_join as op6
from llm_helpers import rows


def brute(items):
    """class_id and n_links by comparing all pairs."""
    sets = []
    for _, t, _ in items:
        w = re.findall(r"\w+", (t or "").lower())
        sets.append({tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    parent, links = list(range(len(items))), [0] * len(items)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(items)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and min(len(a), len(b)) >= 0.8 * max(len(a), len(b)) and len(a & b) >= 0.8 * len(a | b) - 1e-9:
                links[i] += 1
                links[j] += 1
                parent[root(i)] = root(j)
    classes = {}
    for k in range(len(items)):
        classes.setdefault(root(k), []).append(items[k][0])
    least = {c: min((x for x in ids if x is not None), default=None) for c, ids in classes.items()}
    return sorted(((items[k][0], least[root(k)], links[k]) for k in range(len(items))), key=repr)


def corpus(seed, groups=12, most=25, length=120):
    r = random.Random(seed)
    words = ["".join(r.choice("abcdefghij") for _ in range(r.randint(2, 7))) for _ in range(3000)]
    passage = [r.choice(words) for _ in range(60)]
    items, k = [], 0
    for g in range(groups):
        base = [r.choice(words) for _ in range(length)] + (passage if g % 2 else [])
        for _ in range(r.randint(1, most)):
            w = list(base)
            for _ in range(r.choice([0, 0, 1, 1, 2, 3, 4, 6])):
                w[r.randrange(len(w))] = r.choice(words)
            items.append((k, " ".join(w) + r.choice(["", ".", " !"]), "s"))
            k += 1
    r.shuffle(items)
    return items


def test_links_equal_brute_force(make_docs):
    items = corpus(1)
    assert rows(op6.link_rows(make_docs(items)), "doc_id", "class_id", "n_links") == brute(items)


def test_hot_group_over_many_blocks(make_docs, monkeypatch):
    monkeypatch.setattr(op6, "CHUNK", 16)
    items = corpus(2, groups=2, most=1, length=150)
    r = random.Random(3)
    base = items[0][1].split()
    for k in range(100, 260):
        w = list(base)
        for _ in range(r.randint(0, 5)):
            w[r.randrange(len(w))] = f"new{r.randrange(1000)}"
        items.append((k, " ".join(w), "s"))
    assert rows(op6.link_rows(make_docs(items)), "doc_id", "class_id", "n_links") == brute(items)


def test_edge_cases(edge_docs, make_docs):
    items, docs = edge_docs
    assert rows(op6.link_rows(docs), "doc_id", "class_id", "n_links") == brute(items)
    kept = op6.representatives(docs)
    assert kept.columns == docs.columns
    got = [r.doc_id for r in kept.collect()]
    # (5, 6) and the five copies of one text are classes; documents without words stay
    assert sorted(got, key=repr) == sorted([1, 2, None, 3, 5, 7, 8, 9], key=repr)
    assert op6.link_rows(make_docs([])).collect() == [] and op6.representatives(make_docs([])).collect() == []


def test_representatives_are_the_smallest_ids(make_docs):
    items = corpus(4, groups=6)
    wanted = sorted({(c,) for _, c, _ in brute(items)}, key=repr)
    assert rows(op6.representatives(make_docs(items)), "doc_id") == wanted


def test_no_qualifying_pair_is_pruned_by_the_first_band_rule():
    for n, least in op6.least_matches(0.8, 1e-6):
        assert 0 < least < 0.8 * n


def test_min_hash_estimates_similarity():
    r = np.random.default_rng(0)
    a = np.unique(r.integers(0, 2**63, 9000, dtype=np.uint64))
    b = np.unique(np.concatenate([a[:8000], r.integers(0, 2**63, 1000, dtype=np.uint64)]))
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert np.mean(op6.signature(a) == op6.signature(b)) == pytest.approx(true, abs=0.12)


def test_components(spark):
    r = random.Random(6)
    edges = [(k, k + 1) for k in range(60)] + [(100, k) for k in range(101, 160)] + \
            [(r.randint(200, 260), r.randint(200, 260)) for _ in range(60)]
    df = spark.createDataFrame([(str(a).encode(), str(b).encode()) for a, b in edges if a != b], "a binary, b binary")
    got = {bytes(x.node): bytes(x.root) for x in op6.components(df).collect()}
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            parent[root(str(a).encode())] = root(str(b).encode())
    assert set(got) == set(parent)
    for a in parent:
        for b in parent:
            assert (got[a] == got[b]) == (root(a) == root(b))
    assert op6.components(df.filter(F.lit(False))).collect() == []
