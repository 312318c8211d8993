import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from lakeward.llm import op3_mix, op9_stream_dedup

from llm_helpers import brute_targets, rows


def brute_dedup(items):
    groups = defaultdict(list)
    for i, t, _ in items:
        groups[t or ""].append(i)
    out = []
    for i, t, _ in items:
        ids = [x for x in groups[t or ""] if x is not None]
        keep = max(ids) if ids else None
        out.append((i, keep, len(groups[t or ""]), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=repr)


NAMES = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def test_dedup_rows_edge_cases(edge_docs):
    items, docs = edge_docs
    assert rows(op9_stream_dedup.dedup_rows(docs), *NAMES) == brute_dedup(items)


def test_dedup_compares_bytes_when_digests_collide(make_docs):
    r = random.Random(1)
    items = [(k, f"text {r.randint(0, 40)}", "s") for k in range(300)]
    weak = lambda c: F.substring(F.sha2(c, 256), 1, 1)  # noqa: E731  16 digests for 41 texts
    docs = make_docs(items)
    assert rows(op9_stream_dedup.dedup_rows(docs, weak), *NAMES) == brute_dedup(items)
    kept = op9_stream_dedup.distinct_documents(docs, weak)
    assert rows(kept, "doc_id") == sorted(((x[0],) for x in brute_dedup(items) if x[3]), key=repr)
    assert kept.columns == docs.columns


def test_distinct_documents_edge_cases(edge_docs):
    items, docs = edge_docs
    kept = op9_stream_dedup.distinct_documents(docs)
    assert kept.columns == docs.columns
    wanted = {(x[0], x[4]) for x in brute_dedup(items) if x[3]}
    got = [(r.doc_id, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in kept.collect()]
    assert len(got) == len(set(got)) and set(got) == wanted


def test_dedup_of_an_empty_table(make_docs):
    assert op9_stream_dedup.dedup_rows(make_docs([])).collect() == []
    assert op9_stream_dedup.distinct_documents(make_docs([])).collect() == []


def size(t):
    return len(re.findall("[^\x20\x09-\x0d]+", t or ""))


def check_mix(items, docs):
    got = op3_mix.taken(docs).collect()
    assert Counter((r.doc_id, r.size) for r in got) == Counter((i, size(t)) for i, t, _ in items)
    sizes, longest = Counter(), Counter()
    for _, t, s in items:
        sizes[s] += size(t)
        longest[s] = max(longest[s], size(t))
    target, taken = brute_targets(sizes), Counter()
    source = {(i, size(t)): s for i, t, s in items}
    for r in got:
        s = source[r.doc_id, r.size]
        assert r.source_size == sizes[s] and r.target == pytest.approx(target[s])
        assert 0 <= r.taken <= 2 * r.size and (not r.size or r.taken % r.size == 0)
        taken[s] += r.taken
    for s in sizes:
        assert abs(taken[s] - target[s]) <= longest[s] + 1e-6


def test_mix_edge_cases(edge_docs):
    check_mix(*edge_docs)


def test_mix_targets_and_hot_source(make_docs):
    r = random.Random(2)
    items = [(k, " ".join(["w"] * r.choice([1, 3, 20, 20, 20, 300])), r.choice(["hot"] * 6 + ["a", "b", "c", None]))
             for k in range(3000)]
    docs = make_docs(items)
    check_mix(items, docs)
    first, again = op3_mix.taken(docs), op3_mix.taken(docs.repartition(3))
    assert rows(first, "doc_id", "taken") == rows(again, "doc_id", "taken")
    mixed, plan = op3_mix.mixed(docs), op3_mix.plan(docs)
    assert mixed.columns == docs.columns
    wanted = {x.doc_id: x.copies for x in plan.collect() if x.copies}
    assert Counter(x.doc_id for x in mixed.select("doc_id").collect()) == wanted


def test_mix_repeats_and_empty(edge_docs, make_docs):
    _, docs = edge_docs
    plan = Counter()
    for x in op3_mix.plan(docs).collect():
        plan[x.doc_id, x.source, x.size] += x.copies
    got = Counter((x.doc_id, x.source, size(x.text)) for x in op3_mix.mixed(docs).collect())
    assert got == +plan
    assert op3_mix.taken(make_docs([])).collect() == [] and op3_mix.mixed(make_docs([])).collect() == []
