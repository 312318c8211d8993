"""Registered matching / dedup queries (M-01..M-16, J-03, J-06, W-01, O-01, O-02, A-04, A-13)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import governance as gov
from ..operators import matching as m
from ..operators import stewardship as sw
from ..session import scratch_path
from ..sources import fixtures as fx
from ..sources.snapshots import SnapshotTable
from . import jobs
from .catalog import RUN_CLOCK, query


def _parts(spark, sf_dir):
    return m.standardize(fx.part_entities(spark, sf_dir))


def _suppliers(spark, sf_dir):
    return m.standardize(fx.supplier_entities(spark, sf_dir))


@query("normalized_names")
def normalized_names(spark, sf_dir):
    """Standardised names, blocks and match keys of the part entities."""
    return _parts(spark, sf_dir)


@query("normalized_names_declared")
def normalized_names_declared(spark, sf_dir):
    """Declared standardisation: block upper+trim only, and the declared key expression."""
    e = fx.part_entities(spark, sf_dir)
    return m.standardize(e, borough_mode="upper_trim").withColumn("declared_key", m.declared_match_key(e))


@query("dup_by_match_key")
def dup_by_match_key(spark, sf_dir):
    """Match keys held by more than one entity row."""
    return m.dup_by_match_key(_parts(spark, sf_dir))


@query("dup_by_id")
def dup_by_id(spark, sf_dir):
    """Ids held by more than one row when two sources (parts and suppliers) are loaded together."""
    both = fx.part_entities(spark, sf_dir).unionByName(fx.supplier_entities(spark, sf_dir))
    return m.dup_by_id(m.standardize(both))


@query("match_name_pairs")
def match_name_pairs(spark, sf_dir):
    """Actionable name pairs per block with the number of entity pairs each stands for."""
    return m.name_pair_scores(_parts(spark, sf_dir))


@query("match_decisions")
def match_decisions(spark, sf_dir):
    """AUTO_MERGE / STEWARD_REVIEW pairs of match keys, by golden ids (parts by brand)."""
    return m.match_decisions(_parts(spark, sf_dir))


@query("match_decisions_suppliers")
def match_decisions_suppliers(spark, sf_dir):
    """Actionable pairs of match keys of suppliers blocked by nation."""
    return m.match_decisions(_suppliers(spark, sf_dir))


@query("auto_merge_members")
def auto_merge_members(spark, sf_dir):
    """Every further id of a match key -> the key's golden id (parts by brand)."""
    return m.auto_merge_members(_parts(spark, sf_dir))


@query("steward_queue")
def steward_queue(spark, sf_dir):
    """Steward review queue (PENDING), highest confidence first."""
    return m.steward_queue(m.match_decisions(_parts(spark, sf_dir)), now=RUN_CLOCK)


@query("match_audit")
def match_audit(spark, sf_dir):
    """Run audit: rows, pairs compared, pairs per decision band (parts by brand)."""
    return m.match_audit(_parts(spark, sf_dir))


@query("match_audit_suppliers")
def match_audit_suppliers(spark, sf_dir):
    """Run audit for suppliers blocked by nation."""
    return m.match_audit(_suppliers(spark, sf_dir))


@query("golden_master")
def golden_master(spark, sf_dir):
    """One row per match key: the row of the smallest id, stamped ACTIVE."""
    return m.golden_master(_parts(spark, sf_dir), now=RUN_CLOCK)


@query("survivorship_first_non_null")
def survivorship_first_non_null(spark, sf_dir):
    """Attribute-wise survivorship per match key (MIN id, FIRST_NON_NULL by id)."""
    return m.survivorship_first_non_null(_parts(spark, sf_dir))


@query("match_heuristic")
def match_heuristic(spark, sf_dir):
    """Declared heuristic scorer (1.0 equal key, else 0.85) over the actionable name pairs."""
    pairs = m.name_pair_scores(_parts(spark, sf_dir))
    return m.heuristic_scores(pairs).select("borough", "zone_u", "zone_v", "pair_count",
                                            "heuristic_score", "heuristic_decision")


def _golden(spark, sf_dir):
    return m.golden_master(_parts(spark, sf_dir), now=RUN_CLOCK)


def _queue(spark, sf_dir):
    return sw.queue_table(m.match_decisions(_parts(spark, sf_dir)), _golden(spark, sf_dir), now=RUN_CLOCK)


def _steward_decisions(queue):
    """A steward's verdicts on all entries: every status in turn, so each one occurs."""
    statuses = F.array(*[F.lit(status) for status in gov.STEWARD_STATUSES])
    return queue.select("queue_id", F.get(statuses, (F.col("queue_id") % 4).cast("int")).alias("status"))


def _applied(spark, sf_dir):
    queue = _queue(spark, sf_dir)
    return sw.apply_decisions(queue, _steward_decisions(queue), now="2025-01-02 00:00:00")


@query("master_table_shape")
def master_table_shape(spark, sf_dir):
    """Golden master in the relational master-table shape with dense golden ids."""
    return sw.master_table(_golden(spark, sf_dir))


@query("steward_queue_table")
def steward_queue_table(spark, sf_dir):
    """Steward review queue in the relational shape (one OPEN entry per pair of keys to review)."""
    return _queue(spark, sf_dir)


@query("steward_apply")
def steward_apply(spark, sf_dir):
    """Queue after applying steward verdicts (OPEN / IN_REVIEW / APPROVED / REJECTED)."""
    return _applied(spark, sf_dir)


@query("steward_master_after")
def steward_master_after(spark, sf_dir):
    """Master after approvals, as its next version: approved duplicates move ACTIVE -> DEPRECATED."""
    root = scratch_path(spark, "steward")
    SnapshotTable(spark, root).commit(_golden(spark, sf_dir))
    jobs.steward_job(spark, root, _applied(spark, sf_dir), now="2025-01-02 00:00:00")
    return SnapshotTable(spark, root).read().select("location_id", "match_key", "mdm_state", "updated_at_utc")


@query("match_jaro_winkler")
def match_jaro_winkler(spark, sf_dir):
    """Jaro-Winkler scorer (Arrow UDF) over the actionable distinct name pairs."""
    from ..functions.similarity_udf import jaro_winkler_similarity

    pairs = m.name_pair_scores(_parts(spark, sf_dir))
    return pairs.select("borough", "zone_u", "zone_v", "pair_count",
                        jaro_winkler_similarity("zone_u", "zone_v").alias("jaro_winkler"))


@query("match_name_pairs_jaro_winkler")
def match_name_pairs_jaro_winkler(spark, sf_dir):
    """Actionable name pairs under the Jaro-Winkler scorer, found by its own candidate filter."""
    return m.name_pair_scores(_parts(spark, sf_dir), scorer=m.JARO_WINKLER)


@query("match_by_scorer")
def match_by_scorer(spark, sf_dir):
    """Pairs per decision band and block under each of the three scorers."""
    z = _parts(spark, sf_dir)
    per_id = m.id_multiplicity(z)
    audits = [m.audit_by_block(z, scorer, per_id=per_id) for scorer in (m.LEVENSHTEIN, m.JARO_WINKLER, m.HEURISTIC)]
    return audits[0].unionByName(audits[1]).unionByName(audits[2])


@query("match_declared_blocking")
def match_declared_blocking(spark, sf_dir):
    """Pairs per band under the declared blocking key and the declared (heuristic) scorer."""
    e = fx.part_entities(spark, sf_dir)
    z = m.blocked_by(m.standardize(e), m.declared_match_key(e))
    return m.audit_by_block(z, m.HEURISTIC)
