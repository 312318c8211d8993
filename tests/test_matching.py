import itertools
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lakeward.operators import matching as m


def _lev(a, b):
    prev = list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        cur = [i]
        for j, cb in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (ca != cb)))
        prev = cur
    return prev[-1]


def _brute(rows, high, medium):
    """Reference semantics on Python rows (id, block, name) already normalised."""
    out = []
    for a, b in itertools.combinations(rows, 2):
        if a[0] is None or b[0] is None or a[1] is None or a[1] != b[1] or a[0] == b[0]:
            continue
        a, b = (a, b) if a[0] < b[0] else (b, a)
        L = max(len(a[2]), len(b[2]))
        sim = 0.0 if L == 0 else round(1 - _lev(a[2], b[2]) / L, 4)
        tm = 1.0 if a[2].split(" ")[0] == b[2].split(" ")[0] else 0.0
        conf = round(sim * 0.9 + tm * 0.1, 4)
        dec = "AUTO_MERGE" if conf >= high else ("STEWARD_REVIEW" if conf >= medium else "REJECT")
        out.append((a[0], b[0], a[2], b[2], dec, a[1]))
    return out


def _by_key(rows, pairs):
    """Actionable pairs of different names per pair of match keys: golden ids, names, decision, pairs."""
    golden = {}
    for i, block, name in rows:
        if i is not None:
            golden[block, name] = min(i, golden.get((block, name), i))
    found = Counter()
    for _, _, za, zb, dec, block in pairs:
        if dec != "REJECT" and za != zb:
            (ia, na), (ib, nb) = sorted((golden[block, n], n) for n in (za, zb))
            found[ia, ib, na, nb, dec] += 1
    return sorted((*key, n) for key, n in found.items())


KEY_COLUMNS = ["id_a", "id_b", "zone_a", "zone_b", "decision", "pair_count"]


def _entities(spark, rows):
    return spark.createDataFrame([(i, blk, name, "s") for i, blk, name in rows],
                                 "LocationID int, Borough string, Zone string, service_zone string")


@pytest.mark.parametrize("medium,high", [(0.8, 0.95), (0.6, 0.9), (0.9, 0.97)])
def test_candidates_equal_brute_force(spark, medium, high):
    rnd = random.Random(7)
    alpha = "ABCDE "
    base = ["".join(rnd.choice(alpha) for _ in range(rnd.randint(1, 14))).strip() or "A" for _ in range(40)]
    rows = []
    for i in range(160):
        name = rnd.choice(base)
        if rnd.random() < 0.5:  # perturb: one edit
            p = rnd.randrange(len(name))
            name = name[:p] + rnd.choice("ABCDE") + name[p + 1:]
        blk = "HOT" if i < 110 else rnd.choice(["B1", "B2"])  # one block holds most rows
        rows.append((i, blk, name))
    rows += [(500, "HOT", rows[0][2]), (500, "HOT", rows[1][2]), (None, "HOT", "ABC"), (600, None, "ABC")]
    z = m.standardize(_entities(spark, rows))
    norm = [(r.location_id, r.borough_norm, r.zone_norm) for r in z.collect()]
    expect = _brute(norm, high, medium)
    want = _by_key(norm, expect)
    got = sorted(tuple(r) for r in m.match_decisions(z, high, medium).select(*KEY_COLUMNS).collect())
    assert got == want
    audit = m.match_audit(z, high, medium).first()
    assert audit.total_pairs_compared == len(expect)
    assert audit.auto_merge_pairs == sum(e[4] == "AUTO_MERGE" for e in expect)
    assert audit.steward_review_pairs == sum(e[4] == "STEWARD_REVIEW" for e in expect)
    assert audit.reject_pairs == sum(e[4] == "REJECT" for e in expect)


def test_pair_edges(spark):
    rows = [(1, "SOLO", "A"), (2, "B", "SAME"), (2, "B", "SAME"), (None, "B", "SAME"), (3, None, "SAME")]
    z = m.standardize(_entities(spark, rows))
    a = m.match_audit(z).first()
    assert a.total_pairs_compared == 0  # one-row block, equal ids, NULL id, NULL block never pair


def test_missing_borough_and_id_text(spark):
    df = spark.createDataFrame([("1", "A"), ("N/A", "B"), ("1.0", "C")], "LocationID string, Zone string")
    z = m.standardize(df).collect()
    assert [r.borough_norm for r in z] == ["UNKNOWN"] * 3
    assert [r.location_id for r in z] == [1, None, 1]
    with pytest.raises(ValueError):
        m.standardize(spark.createDataFrame([(1,)], "Zone int"))


def test_golden_master_null_id_first_and_tie_break(spark):
    rows = [(None, "B", "X"), (5, "B", "X"), (5, "B", "X "), (7, "B", "Y")]
    df = spark.createDataFrame([(i, b, z, s) for (i, b, z), s in zip(rows, ["s1", "s2", "s0", "s3"])],
                               "LocationID int, Borough string, Zone string, service_zone string")
    g = {r.match_key: r for r in m.golden_master(m.standardize(df)).collect()}
    assert g["B::X"].location_id is None  # NULL id sorts first, as the ranking window does
    assert g["B::Y"].location_id == 7 and g["B::Y"].mdm_state == "ACTIVE"
    df2 = df.filter("LocationID is not null")
    g2 = {r.match_key: r for r in m.golden_master(m.standardize(df2)).collect()}
    assert g2["B::X"].service_zone == "s2"  # tie on id 5: decided by the next columns (Borough, Zone)


def test_survivorship_first_non_null(spark):
    df = spark.createDataFrame([(1, "B", "X", None), (2, "B", "X", "late"), (3, "B", "X", "later")],
                               "LocationID int, Borough string, Zone string, service_zone string")
    s = m.survivorship_first_non_null(m.standardize(df)).first()
    assert s.location_id == 1 and s.service_zone == "late"


def test_steward_queue_order_and_dense_ids(spark):
    from lakeward.operators.keys import dense_ids

    df = spark.range(0, 1000).withColumn("k", (F.col("id") * 7919) % 1000)
    ids = sorted((r.k, r.gid) for r in dense_ids(df, ["k"], "gid", partitions=5).collect())
    assert [g for _, g in ids] == list(range(1, 1001))


def test_single_hot_block_on_driver_parts_equals_brute_force(spark):
    """Every part of the smallest driver table in ONE block (the whole table is the hot key)."""
    from tests.conftest import SF_SMALL
    from lakeward.sources import fixtures as fx

    e = fx.part_entities(spark, SF_SMALL).withColumn("Borough", F.lit("ONE BLOCK"))
    z = m.standardize(e)
    norm = [(r.location_id, r.borough_norm, r.zone_norm) for r in z.collect()]
    expect = _brute(norm, 0.95, 0.80)
    want = _by_key(norm, expect)
    got = sorted(tuple(r) for r in m.match_decisions(z).select(*KEY_COLUMNS).collect())
    assert got == want
    audit = m.match_audit(z).first()
    assert audit.total_pairs_compared == len(expect) == len(norm) * (len(norm) - 1) // 2
    assert audit.steward_review_pairs == sum(e[4] == "STEWARD_REVIEW" for e in expect)
    assert audit.reject_pairs == sum(e[4] == "REJECT" for e in expect)


def test_auto_merge_members_star(spark):
    rows = [(1, "B", "SAME"), (3, "B", "SAME"), (3, "B", "same"), (7, "B", "SAME"), (None, "B", "SAME"),
            (8, "B", ""), (9, "B", ""), (10, "B", None), (11, "B", None), (12, None, "SAME")]
    got = m.auto_merge_members(m.standardize(_entities(spark, rows)))
    assert sorted((r.location_id, r.golden_id) for r in got.collect()) == [(3, 1), (7, 1)]


def test_approval_of_a_doubly_loaded_record_reaches_the_master(spark):
    from lakeward.operators import stewardship as sw

    names = [(1, "B", "ALPHA CENTRAL PARK"), (5, "B", "ALPHA CENTRAL PERK X"), (5, "B", "ALPHA CENTRAL PERK X"),
             (9, "B", "ALPHA CENTRAL PERK X")]
    z = m.standardize(_entities(spark, names))
    golden = m.golden_master(z, now="2025-01-01 00:00:00")
    decisions = m.match_decisions(z, high=0.95, medium=0.7)
    queue = sw.queue_table(decisions, golden)
    entries = queue.collect()
    assert [(e.queue_id, e.location_id, e.match_key) for e in entries] == [(1, 5, "B::ALPHA CENTRAL PERK X")]
    assert decisions.first().pair_count == 3
    verdicts = queue.select("queue_id", F.lit("APPROVED").alias("status"))
    after = sw.master_after_approvals(golden, sw.apply_decisions(queue, verdicts)).collect()
    assert {r.location_id: r.mdm_state for r in after} == {1: "ACTIVE", 5: "DEPRECATED"}


def test_audit_counts_exact_beyond_two_to_the_53(spark):
    per_id = spark.createDataFrame([("B", "N", 1, 4_000_000_000), ("B", "N", 2, 1)],
                                   f"{m.BLOCK} string, {m.NAME} string, {m.ID} int, _m long")
    assert m.block_pair_totals(per_id).first().pairs == 4_000_000_000
    even = spark.createDataFrame([("B", "N", 1, 2_000_000_001), ("B", "N", 2, 2_000_000_003)], per_id.schema)
    assert m.block_pair_totals(even).first().pairs == 2_000_000_001 * 2_000_000_003
