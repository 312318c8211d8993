"""Registered quality-gate queries (D-01..D-15, A-01..A-03, A-09..A-12, J-07)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality as q
from ..sources import fixtures as fx
from .catalog import query


@query("dq_flags")
def dq_flags(spark, sf_dir):
    """Every trip with one boolean per code rule and the conjunction ``dq_pass``."""
    return q.quality_gate(fx.trips(spark, sf_dir)).flagged


@query("dq_passed")
def dq_passed(spark, sf_dir):
    """Rows passing every rule; flag columns kept, ``dq_pass`` dropped."""
    return q.quality_gate(fx.trips(spark, sf_dir)).passed


@query("quarantine_rows")
def quarantine_rows(spark, sf_dir):
    """Rows failing at least one rule, with all flags."""
    return q.quality_gate(fx.trips(spark, sf_dir)).quarantined


@query("dq_report")
def dq_report(spark, sf_dir):
    """Totals and one failure count per rule (one aggregate pass)."""
    return q.quality_gate(fx.trips(spark, sf_dir)).report


@query("dq_pass_rate")
def dq_pass_rate(spark, sf_dir):
    """Pass rate against the declared minimum (0.95)."""
    g = q.quality_gate(fx.trips(spark, sf_dir))
    return q.with_pass_rate(g.report).select("total_rows", "passed_rows", "pass_rate", "min_pass_rate", "gate_ok")


@query("dq_top_failures")
def dq_top_failures(spark, sf_dir):
    """All rules ranked by failure count (ties by name)."""
    g = q.quality_gate(fx.trips(spark, sf_dir))
    return q.top_failures(g.report, g.rules)


@query("dq_scorecard")
def dq_scorecard(spark, sf_dir):
    """Scorecard per (dimension, severity)."""
    g = q.quality_gate(fx.trips(spark, sf_dir))
    return q.scorecard(g.flagged, g.rules)


@query("dq_declared_rules")
def dq_declared_rules(spark, sf_dir):
    """The gate driven by the declared rule catalogue (SQL text parsed by Spark)."""
    t = fx.trips(spark, sf_dir)
    g = q.quality_gate(t, q.declared_rules(columns=t.columns))
    return g.report


@query("dq_declared_rules_text")
def dq_declared_rules_text(spark, sf_dir):
    """The declared rules over the untyped export: text that does not convert fails its rules."""
    t = fx.trips_as_text(spark, sf_dir)
    return q.quality_gate(t, q.declared_rules(df=t)).report


@query("null_profile")
def null_profile(spark, sf_dir):
    """NULL share per trip column with the 1 % block-load threshold."""
    return q.null_profile(fx.trips(spark, sf_dir))


@query("referential_integrity")
def referential_integrity(spark, sf_dir):
    """Matched / unmatched rows per location key against the master subset."""
    return q.referential_integrity(fx.trips(spark, sf_dir), fx.master_zones(spark, sf_dir))


@query("referential_rejects")
def referential_rejects(spark, sf_dir):
    """Trip rows whose pickup location is not in the master (the reject side of the split)."""
    _, rejected = q.referential_split(fx.trips(spark, sf_dir), fx.master_zones(spark, sf_dir), "PULocationID")
    return rejected.select("*", F.lit("PULocationID").alias("key_column"))
