import random
import re
from collections import Counter

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from lakeward.llm.common import written
from lakeward.llm.queries import BYTE_TOKENIZER

from llm_helpers import brute_targets

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def write(spark, folder, items, marks):
    spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in items],
                          "doc_id bigint, text string, lang string, source string, n_chars bigint") \
        .write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")


def test_stages_take_effect(spark, tmp_path):
    r = random.Random(8)
    words = ["".join(r.choice("aeioulnrst") for _ in range(r.randint(3, 8))) for _ in range(2000)]
    items, marks, toxic, near, copies = [], [], set(), [], []
    for k in range(600):
        w = [r.choice(words) for _ in range(80)]
        if r.random() < 0.2:
            w.insert(5, r.choice(["idiot", "scum", "m0r0n", "moron"]))
            toxic.add(k)
        items.append((k, " ".join(w), f"s{k % 4}"))
        marks.append((k, 1, int(k in toxic)))
    clean = [i for i in items if i[0] not in toxic]
    for n, (k, t, s) in enumerate(clean[:30]):
        items.append((1000 + n, t, s))
        copies.append((k, 1000 + n))
    for n, (k, t, s) in enumerate(clean[30:60]):
        w = t.split()
        w[40] = "changed"
        items.append((2000 + n, " ".join(w), s))
        near.append((k, 2000 + n))
    items += [(3000, None, None), (3001, "", "s0")]
    folder = str(tmp_path)
    write(spark, folder, items, marks)
    docs, kept = spark.read.parquet(f"{folder}/documents.parquet"), {}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "mix", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, folder), f"test-{name}")
        if name != "packing":
            assert docs.columns == COLUMNS
        kept[name] = {x.doc_id for x in docs.select("doc_id").collect()}
    every = {i for i, _, _ in items}
    assert len(toxic - kept["toxicity"]) >= 0.95 * len(toxic) and len(every - toxic - kept["toxicity"]) <= 5
    left = kept["toxicity"]
    assert {b for _, b in copies} & left <= kept["exact_dedup"]
    assert not {a for a, b in copies if b in left} & kept["exact_dedup"]
    assert {a for a, _ in near} & left <= kept["near_dedup"]
    assert not {b for a, b in near if a in left} & kept["near_dedup"]
    plain = {i for i, _, _ in clean[60:]} & left
    assert plain <= kept["near_dedup"]
    assert kept["packing"] == kept["mix"] <= kept["near_dedup"]


def plain_chain(items):
    """What the stages before the mix keep of (doc_id, text, source), worked out one by one."""
    def toxic(text):
        return any(w in TOXIC for w in (text or "").split())

    clean = [i for i in items if not toxic(i[1])]
    largest = {}
    for i, t, _ in clean:
        largest[t or ""] = max(largest.get(t or "", i), i, key=lambda x: (x is not None, x or 0))
    single = {(i, t or "", s) for i, t, s in clean if i == largest[t or ""]}

    def shingles(text):
        words = re.findall(r"\w+", text.lower())
        return {tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))} if words else set()

    sets = [(shingles(t), row) for row in sorted(single, key=repr) for t in [row[1]]]
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][0], sets[b][0]
            if x and y and len(x & y) >= 0.8 * len(x | y) - 1e-9:
                parent[root(a)] = root(b)
    groups = {}
    for k, (_, row) in enumerate(sets):
        groups.setdefault(root(k), []).append(row)
    # here a null doc_id comes after all others
    return {min(g, key=lambda row: (row[0] is None, row[0] or 0)) for g in groups.values()}


TOXIC = ("idiot", "scum", "moron")


def test_run_against_a_plain_chain(spark, tmp_path):
    """Nulls, repeated rows, copies, near copies, a long text and clashing columns through the whole chain."""
    r = random.Random(12)
    words = ["".join(r.choice("bcdfghjklmnp") + r.choice("aeiou") for _ in range(r.randint(1, 4))) for _ in range(900)]
    items, marks = [], []
    for k in range(260):
        w = [r.choice(words) for _ in range(r.randint(30, 90))]
        bad = r.random() < 0.25
        if bad:
            w.insert(r.randint(0, 20), r.choice(TOXIC))
        items.append((k, " ".join(w), f"s{k % 3}"))
        marks.append((k, 1, int(bad)))
    clean = [i for i in items if not any(w in TOXIC for w in i[1].split())]
    items += [(400 + n, t, s) for n, (_, t, s) in enumerate(clean[:10])]  # copies
    for n, (_, t, s) in enumerate(clean[20:30]):  # near copies: one word of many changed
        w = (t + " " + t).split()
        items += [(500 + n, " ".join(w), s), (600 + n, " ".join([*w[:-1], "changed"]), s)]
    items += [clean[40], clean[40], clean[41]]  # repeated rows
    items += [(None, "a text without any number at all, of more than five words", "s1"), (None, None, None), (700, None, "s0"),
              (701, "", None), (702, " ".join(r.choice(words) for _ in range(30_000)), "s2")]
    folder = str(tmp_path)
    spark.createDataFrame([(i, t, None if i == 5 else "en", s, None, "row", 1, "digest") for i, t, s in items],
                          "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, copies int, "
                          "digest string").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(marks + [(None, 1, None)], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")

    want = plain_chain(items)
    got = corpus_pipeline.run(spark, folder).collect()
    # every document that the mix takes is packed whole, as often as it is taken
    library = Tokenizer.from_file(public_tokenizers.path(BYTE_TOKENIZER))
    texts = {i: t for i, t, _ in want}
    tokens = {i: len(library.encode(t, add_special_tokens=False).ids) + 1 for i, t in texts.items()}
    packed = Counter()
    for row in got:
        assert row.doc_id in tokens and row.doc_tokens == tokens[row.doc_id] and row.length > 0
        packed[row.doc_id] += row.length
    copies = {i: n / tokens[i] for i, n in packed.items()}
    assert set(copies.values()) <= {1.0, 2.0}
    # sequences have no gaps and no overlaps, and none is longer than it may be
    held = {}
    for row in got:
        held.setdefault(row.sequence_id, []).append((row.offset, row.length))
    for pieces in held.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    # the sources' shares: weights 3, 1, 2 by code point, at most twice their size, null last
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    sizes, taken = Counter(), Counter()
    for i, t, s in want:
        sizes[s] += size(t)
        taken[s] += size(t) * copies.get(i, 0)
    targets = brute_targets(dict(sizes))
    longest = {s: max(size(t) for _, t, o in want if o == s) for s in sizes}
    for s in sizes:
        assert abs(taken[s] - targets[s]) <= longest[s] + 1, s


def test_empty_tables(spark, tmp_path):
    write(spark, str(tmp_path), [], [])
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
