"""Candidate filters against brute force: nothing that can qualify is lost, and how few others come."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from lakeward.functions.similarity_udf import jaro_winkler
from lakeward.operators import candidates as c
from lakeward.operators import matching as m


def lev(a, b):
    prev = list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        cur = [i]
        for j, cb in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (ca != cb)))
        prev = cur
    return prev[-1]


def names_of(spark, names, block="B"):
    rows = [(block, n) for n in names] if isinstance(block, str) else list(zip(block, names, strict=True))
    return spark.createDataFrame(rows, f"{m.BLOCK} string, {m.NAME} string").distinct()


def pairs_of(df):
    got = [(r.zone_u, r.zone_v) for r in df.collect()]
    assert len(got) == len(set(got)), "a pair came twice"
    return set(got)


def edited(rnd, name, alphabet, edits):
    for _ in range(edits):
        p, kind = rnd.randrange(len(name) + 1), rnd.randrange(3)
        name = name[:p] + (rnd.choice(alphabet) if kind else "") + name[p + (kind != 1):]
    return name or "A"


@pytest.mark.parametrize("medium", [0.35, 0.6, 0.8, 0.92, 1.0])
def test_edit_candidates_lose_nothing(spark, medium):
    rnd = random.Random(int(medium * 100))
    names = set()
    for _ in range(40):
        name = " ".join("".join(rnd.choice("ABC") for _ in range(rnd.randint(1, 7))) for _ in range(rnd.randint(1, 4)))
        names |= {name, edited(rnd, name, "ABC ", 1), edited(rnd, name, "ABC ", 3)}
    names = sorted({n.strip() for n in names if n.strip()} | {"A", "B", "AB", "", "ABCABC ABCABC"})
    got = pairs_of(m.fuzzy_candidates(names_of(spark, names), medium))
    for a, b in itertools.combinations(names, 2):
        sim = round(1 - lev(a, b) / max(len(a), len(b)), 4)
        if round(0.9 * sim + 0.1 * (a.split(" ")[0] == b.split(" ")[0]), 4) >= medium:
            assert (min(a, b), max(a, b)) in got or not a, (a, b)


def test_candidates_stay_near_the_names(spark):
    """Long names, and names that share most of their text, give candidates in proportion to the names."""
    rnd = random.Random(3)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    word = lambda n: "".join(rnd.choice(letters) for _ in range(n))
    for names in ([f"SUPPLIER 0000 {word(40)}" for _ in range(600)], [word(200) for _ in range(300)],
                  [" ".join(word(9) for _ in range(20)) for _ in range(300)]):
        near = [edited(rnd, n, letters, 2) for n in names[:50]]
        found = pairs_of(m.fuzzy_candidates(names_of(spark, names + near), 0.8))
        assert {(min(p), max(p)) for p in zip(names, near)} - {(n, n) for n in names} <= found
        assert len(found) <= len(names)


def test_rows_of_a_name_grow_with_its_length(spark):
    """The rows that go into the join are in proportion to the names' length, whatever the budget."""
    def rows(length, slack):
        names = ["".join(random.Random(k).choice("ABCDEFGH") for _ in range(length)) for k in range(20)]
        items = spark.createDataFrame([("B", n, n) for n in names], "block string, name string, rest string")
        return [side.count() / len(names) for side in c.edit_pieces(items, ["block"], slack)]

    for slack in (0.1, 0.2, 0.4):
        for length in (20, 200):
            x, y = rows(length, slack)
            assert x <= slack * length + 1 and y <= 4 * length


@pytest.mark.parametrize("medium", [0.75, 0.8, 0.9])
def test_jaro_winkler_equals_brute_force(spark, medium):
    rnd = random.Random(11)
    names = set()
    for _ in range(30):
        name = " ".join("".join(rnd.choice("ABCDE") for _ in range(rnd.randint(2, 8))) for _ in range(rnd.randint(1, 3)))
        swapped = list(name)
        k = rnd.randrange(len(name))
        swapped[k:k + 2] = swapped[k:k + 2][::-1]
        names |= {name, edited(rnd, name, "ABCDE ", 2), "".join(swapped), name[::-1], name + " " + name[:3]}
    names = sorted(n.strip() for n in names if n.strip())
    blocks = ["HOT" if k % 5 else "OTHER" for k in range(len(names))]
    rows = [(k, b, n) for k, (b, n) in enumerate(zip(blocks, names, strict=True))]
    z = m.standardize(spark.createDataFrame(rows, "LocationID int, Borough string, Zone string"))
    norm = {(r.borough_norm, r.zone_norm) for r in z.collect()}
    want, lev_only = set(), 0
    for (ba, a), (bb, b) in itertools.combinations(sorted(norm), 2):
        if ba == bb:
            token = a.split(" ")[0] == b.split(" ")[0]
            if round(0.9 * round(jaro_winkler(a, b), 4) + 0.1 * token, 4) >= medium:
                want.add((ba, min(a, b), max(a, b)))
                lev_only += round(0.9 * round(1 - lev(a, b) / max(len(a), len(b)), 4) + 0.1 * token, 4) < medium
    got = m.name_pair_scores(z, 0.95, medium, scorer=m.JARO_WINKLER).filter("zone_u <> zone_v")
    got = [(r.borough, r.zone_u, r.zone_v) for r in got.collect()]
    assert len(got) == len(set(got)) and set(got) == want and lev_only > 0


def test_jaro_winkler_bound_of_the_threshold(spark):
    with pytest.raises(ValueError):
        m.fuzzy_candidates(names_of(spark, ["A", "B"]), 0.7, m.JARO_WINKLER)
    with pytest.raises(ValueError):
        m.fuzzy_candidates(names_of(spark, ["A", "B"]), 0.1)


def test_bands_of_all_scorers(spark):
    rows = [(1, "B", "ALPHA"), (2, "B", "ALPHA"), (3, "B", "ALPHAS"), (4, "B", "OMEGA"), (4, "B", "OMEGA"), (9, "C", "SOLO")]
    z = m.standardize(spark.createDataFrame(rows, "LocationID int, Borough string, Zone string"))
    bands = {r.scorer: tuple(r)[2:] for s in (m.LEVENSHTEIN, m.JARO_WINKLER, m.HEURISTIC)
             for r in m.audit_by_block(z, s, high=0.95, medium=0.7 if s == m.LEVENSHTEIN else 0.8).collect()}
    # 1-2, 1-3, 1-4 (twice), 2-3, 2-4 (twice), 3-4 (twice)
    assert bands == {"levenshtein": (9, 1, 2, 6), "jaro_winkler": (9, 1, 2, 6), "heuristic": (9, 1, 8, 0)}


def test_golden_row_is_a_hash_aggregate_and_survives_a_hot_key(spark):
    hot = spark.range(20_000).select(F.col("id").cast("int").alias("LocationID"), F.lit("B").alias("Borough"),
                                     F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("N"), F.col("id")))
                                     .alias("Zone"), F.col("id").cast("string").alias("service_zone"))
    hot = hot.unionByName(hot.filter("LocationID = 0").withColumn("service_zone", F.lit("a tie")))
    z = m.standardize(hot)
    golden = m.golden_master(z, now="2025-01-01 00:00:00")
    plan = golden._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate(keys=[match_key" in plan and "min(" in plan and "Window" not in plan
    got = {r.match_key: (r.location_id, r.service_zone) for r in golden.collect()}
    assert len(got) == 13_334 and got["B::HOT"] == (0, "0")


def test_golden_rows_of_other_column_names(spark):
    from lakeward.operators import stewardship as sw

    z = m.standardize(spark.createDataFrame([(1, "Alpha One"), (2, "Alpha Onee")], "LocationID int, zone_name string"))
    golden = m.golden_master(z, now="2025-01-01 00:00:00")
    assert [(r.borough, r.zone_name, r.service_zone) for r in sw.master_table(golden).orderBy("golden_id").collect()] == [
        ("UNKNOWN", "Alpha One", None), ("UNKNOWN", "Alpha Onee", None)]
    queue = sw.queue_table(m.match_decisions(z, medium=0.7), golden).collect()
    assert [(q.borough, q.zone_name) for q in queue] == [("UNKNOWN", "Alpha Onee")]


def test_numbered_names_are_compared_directly(spark, monkeypatch):
    """Names that differ in a few digits have no rare piece: each pair of them is met once, not once a digit."""
    numbered = [f"SUPPLIER {k:09d}" for k in range(0, 90_000, 300)]
    other = [f"SUPPLIER {word} TRADING HOUSE" for word in ("ALPHA", "ALPHAS", "BRAVO", "CHARLIE")]
    taken = []
    direct = c._direct_pairs
    monkeypatch.setattr(c, "_direct_pairs", lambda x, *rest: taken.append({r.x for r in x.collect()}) or direct(x, *rest))
    got = pairs_of(m.fuzzy_candidates(names_of(spark, numbered + other), 0.8))
    assert set(numbered) <= taken[0]
    wanted = {(a, b) for a, b in itertools.combinations(sorted(numbered + other), 2)
              if round(0.9 * round(1 - lev(a, b) / max(len(a), len(b)), 4) + 0.1, 4) >= 0.8}
    assert wanted <= got and len(got - wanted) < 0.1 * len(wanted)
