import hashlib
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from lakeward.llm import op13_prefix_trie as trie

from llm_helpers import rows

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id bigint, turn bigint, role string, text string, key string, digest string"


def in_order(data):
    convs = {}
    for conv, turn, role, text in data:
        if conv is not None:
            role, text = role or "", text or ""
            tie = np.uint64(xxhash.xxh64_intdigest(text.encode(), xxhash.xxh64_intdigest(role.encode(), 42))).astype("int64")
            convs.setdefault(conv, []).append((turn is not None, turn or 0, tie, role, text))
    return {c: [t[3:] for t in sorted(turns)] for c, turns in convs.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = convs.get(c - (c % 20 if c >= 0 else -(-c % 20)), [])[:h] + own[h:]
    return out


def brute(convs):
    """Every node by its whole sequence of turns."""
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for seq, inside in members.items():
        subtree = [s for s in members if s[:len(seq)] == seq]
        leaves = [s for s in subtree if not any(len(o) == len(s) + 1 and o[:-1] == s for o in subtree)]
        words = sum((len(members[s]) - 1) * (len(re.findall(r"[^\x20\x09-\x0D]+", s[-1][1])) if s else 0) for s in subtree)
        ends = ",".join(str(c) for c in sorted(inside) if len(convs[c]) == len(seq))
        out.append((min(inside), len(seq), min(members[seq[:-1]]) if seq else None, len(inside),
                    sum(len(s) == len(seq) + 1 for s in subtree), len(leaves), words,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def table(spark, data):
    return spark.createDataFrame([(*row, "x", "y") for row in data], SCHEMA)


def edge_data():
    r = random.Random(1)
    said = ["", None, "a b", "a  b\t c", "über ä", "x " * 3000, "\x0b", "ab cd"]
    data = []
    for c in [*range(-25, 30), 40, 41, 59, 61, 100, 119]:
        for t in range(r.randint(1, 7)):
            data.append((c, t if r.random() < 0.9 else None, r.choice(["user", "assistant", None]),
                         r.choice(said) if r.random() < 0.3 else f"w {t} {r.choice('xyz')}"))
    # copies, also of long conversations; one that is the beginning of another
    for c in range(200, 240):
        data += [(c, t, "user", f"t{t}") for t in range(c % 3 + 9)]
    data += [(300, t, "u", f"long {t}") for t in range(60)] + [(301, t, "u", f"long {t}") for t in range(57)]
    # repeated rows, equal turn numbers, null ids
    data += [(310, 1, "u", "same")] * 3 + [(311, 1, "u", "b"), (311, 1, "u", "a"), (None, 1, "u", "lost"), (None, None, None, None)]
    # fewer turns than the head it would replace, and no base: no turns are left
    data += [(c, 0, "u", "only") for c in range(1001, 1020)]
    return data


def test_nodes_against_brute_force(spark):
    data = edge_data()
    got = trie.contract_nodes(table(spark, data))
    assert got.columns == COLUMNS and {t for n, t in got.dtypes if n != "ends_sha256"} == {"bigint"}
    assert rows(got, *COLUMNS) == brute(rebuilt(in_order(data)))


def test_plain_conversations_and_short_runs(spark, monkeypatch):
    """Running sums over many runs and pieces, without the shared heads."""
    monkeypatch.setattr(trie, "RUN", 3)
    monkeypatch.setattr(trie, "PIECE", 2)
    data = edge_data()
    assert rows(trie.nodes(*trie.plain(table(spark, data))), *COLUMNS) == brute(in_order(data))


def test_empty_and_single(spark):
    assert trie.contract_nodes(table(spark, [(1, 1, "u", "t")]).limit(0)).collect() == []
    assert trie.contract_nodes(table(spark, [(None, 1, "u", "t")])).collect() == []
    for data in ([(7, 1, "u", "one two")], [(20, None, None, None)]):
        assert rows(trie.contract_nodes(table(spark, data)), *COLUMNS) == brute(rebuilt(in_order(data)))


def test_one_conversation_holds_most_rows(spark):
    data = [(5, t, "u", f"turn {t % 7}") for t in range(900)] + [(c, t, "u", f"turn {t % 7}") for c in (6, 7) for t in range(40)]
    turns, members = trie.plain(table(spark, data))
    got = trie.nodes(turns, members)
    assert got.count() == 901
    deep = got.filter(F.col("depth").isin(0, 40, 41, 900)).select("depth", "n_convs", "n_leaves", "saved_tokens")
    assert rows(deep, "depth", "n_convs", "n_leaves", "saved_tokens") == [(0, 3, 1, 160), (40, 3, 1, 4), (41, 1, 1, 0), (900, 1, 1, 0)]


@pytest.mark.parametrize("table_dir", ["/root/testdata/sf0.01"])
def test_given_table_against_brute_force(spark, table_dir):
    df = spark.read.parquet(f"{table_dir}/conversations.parquet")
    data = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    assert rows(trie.contract_nodes(df), *COLUMNS) == brute(rebuilt(in_order(data)))
