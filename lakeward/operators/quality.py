"""Quality gate: rule flags, pass/quarantine split, reports, pass-rate stop, scorecard, profiles.

Design for scale: every rule is a built-in boolean expression evaluated in one projection (one
whole-stage-codegen span); every report is one aggregate over the flagged frame (partial
aggregation per task, one tiny final shuffle); the gate job writes passed and quarantined rows
in a single partitioned write with the counts taken by an ``Observation`` (see plans.jobs).
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import governance as gov
from ..functions.time import as_timestamp
from ..sources.files import preferred_column
from ..functions.casts import to_int
from ..functions.rows import explode_rows

DQ_PASS = "dq_pass"


@dataclass(frozen=True)
class Rule:
    """A named boolean check; rows where ``condition`` is false *or NULL* fail it."""

    name: str
    condition: Column
    dimension: str = "validity"
    severity: str = "medium"
    #: Columns (name, type) that the condition is to see typed: see ``flag_frame``.
    typed: tuple[tuple[str, str], ...] = ()

    @property
    def fail_col(self) -> str:
        return f"{self.name}_fail_count"


class QualityGateFailed(RuntimeError):
    """Raised when the pass rate is below the configured minimum."""


def _known(df: DataFrame, column: str, bounds) -> Column:
    return F.col(column).isNotNull()


def _ordered(df: DataFrame, earlier: str, later: str, bounds) -> Column:
    return as_timestamp(df, earlier) <= as_timestamp(df, later)


def _within(df: DataFrame, column: str, bounds) -> Column:
    """NULL passes; text that is no number gives NULL in the comparison, so its row fails."""
    value = F.col(column)
    number = value.try_cast("double") if dict(df.dtypes)[column] == "string" else value
    low, high = (F.lit(bound) for bound in bounds)
    inside = number >= low if bounds[1] is None else number.between(low, high)
    return value.isNull() | inside


RULE_KINDS = {"known": _known, "ordered": _ordered, "within": _within}


def code_rules(df: DataFrame, table=None,
               pickup_candidates=gov.GATE_PICKUP_CANDIDATES,
               dropoff_candidates=gov.GATE_DROPOFF_CANDIDATES) -> list[Rule]:
    """The rules of a rule table (default: the gate's) that ``df`` has the columns for."""
    roles = {"pickup": preferred_column(df, pickup_candidates),
             "dropoff": preferred_column(df, dropoff_candidates)}
    rules = []
    for name, kind, needs, bounds, dimension, severity in gov.GATE_RULES if table is None else table:
        columns = [roles.get(need, need) for need in needs]
        if set(columns) <= set(df.columns):
            rules.append(Rule(name, RULE_KINDS[kind](df, *columns, bounds), dimension, severity))
    return rules


def declared_rules(specs: list[gov.RuleSpec] | None = None, columns: list[str] | None = None,
                   df: DataFrame | None = None, declared=gov.TRIP_SCHEMA) -> list[Rule]:
    """Rules from the declared catalogue; the SQL text is parsed by Spark (``F.expr``).

    With ``columns`` given (or ``df``), a rule referring to an absent column is skipped (same policy
    as the code rules); the reference is a simple identifier scan of the expression text. Columns
    that ``df`` holds as text though the declared schema gives them a type are converted for the
    rule, and a row whose text does not convert fails every rule that refers to the column.
    """
    specs = gov.declared_rules() if specs is None else specs
    columns = df.columns if columns is None and df is not None else columns
    texts = {name for name, kind in df.dtypes if kind == "string"} if df is not None else set()
    out = []
    for s in specs:
        names = _identifiers(s.expression_sql)
        if columns is not None and not names <= set(columns):
            continue
        typed = tuple((n, t) for n, t in declared if n in names & texts and t != "string")
        out.append(Rule(s.id, F.expr(s.expression_sql), s.dimension, s.severity, typed))
    return out


def _identifiers(sql: str) -> set[str]:
    keywords = {"IS", "NOT", "NULL", "AND", "OR", "TRUE", "FALSE", "BETWEEN", "IN"}
    return {t for t in re.findall(r"[A-Za-z_][A-Za-z0-9_]*", sql) if t.upper() not in keywords}


def flag_frame(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Input columns + one non-NULL boolean per rule + ``dq_pass`` (their conjunction; true with no rules).

    Rules with ``typed`` columns are evaluated on a shadow projection in which these columns are
    converted (``try_cast``) under their own names; the input columns themselves stay as they came.
    """
    clash = [r.name for r in rules if r.name in df.columns] + ([DQ_PASS] if DQ_PASS in df.columns else [])
    if clash:
        raise ValueError(f"rule/flag names collide with input columns: {clash}")
    plain = [F.coalesce(r.condition, F.lit(False)).alias(r.name) for r in rules if not r.typed]
    flagged = df.select("*", *plain)
    shadowed = dict(pair for r in rules for pair in r.typed)
    if shadowed:
        raw = F.struct(*[F.col(f"`{c}`") for c in flagged.columns]).alias("_raw")
        shadow = flagged.select(raw, *[(F.col(f"`{c}`").try_cast(shadowed[c]) if c in shadowed else F.col(f"`{c}`")).alias(c)
                                       for c in df.columns])

        def holds(rule: Rule) -> Column:
            converted = [F.col("_raw")[c].isNull() | F.col(f"`{c}`").isNotNull() for c, _ in rule.typed]
            return reduce(lambda a, b: a & b, converted, F.coalesce(rule.condition, F.lit(False)))

        flagged = shadow.select("_raw.*", *[holds(r).alias(r.name) for r in rules if r.typed])
    conj = reduce(lambda a, b: a & b, [F.col(r.name) for r in rules], F.lit(True))
    return flagged.select(*[F.col(f"`{c}`") for c in df.columns], *[F.col(r.name) for r in rules]).withColumn(DQ_PASS, conj)


def split(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(passed without ``dq_pass``, quarantined with all flags)."""
    return flagged.filter(F.col(DQ_PASS)).drop(DQ_PASS), flagged.filter(~F.col(DQ_PASS))


def report_measures(rules: list[Rule]) -> list[Column]:
    """Aggregate expressions of the gate report (counts are 0, not NULL, on empty input)."""
    return [
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col(DQ_PASS)).alias("passed_rows"),
        F.count_if(~F.col(DQ_PASS)).alias("failed_rows"),
        *[F.count_if(~F.col(r.name)).alias(r.fail_col) for r in rules],
    ]


def gate_report(flagged: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row: total / passed / failed and one failure count per rule."""
    return flagged.agg(*report_measures(rules))


@dataclass
class GateResult:
    rules: list[Rule]
    flagged: DataFrame
    passed: DataFrame
    quarantined: DataFrame
    report: DataFrame


def quality_gate(df: DataFrame, rules: list[Rule] | None = None) -> GateResult:
    rules = code_rules(df) if rules is None else rules
    flagged = flag_frame(df, rules)
    passed, quarantined = split(flagged)
    return GateResult(rules, flagged, passed, quarantined, gate_report(flagged, rules))


def with_pass_rate(report: DataFrame, min_pass_rate: float = gov.DEFAULT_MIN_PASS_RATE) -> DataFrame:
    """Adds ``pass_rate`` (passed/total; NULL on empty input), the threshold and ``gate_ok``."""
    rate = F.when(F.col("total_rows") > 0, F.col("passed_rows") / F.col("total_rows"))
    return (report.withColumn("pass_rate", rate)
                  .withColumn("min_pass_rate", F.lit(float(min_pass_rate)))
                  .withColumn("gate_ok", F.coalesce(F.col("pass_rate") >= F.col("min_pass_rate"), F.lit(True))))


def enforce_pass_rate(report_row: dict, min_pass_rate: float = gov.DEFAULT_MIN_PASS_RATE) -> None:
    """Stop the job (after its report was written) when the pass rate is under the minimum."""
    total = report_row.get("total_rows") or 0
    if total and report_row["passed_rows"] / total < min_pass_rate:
        raise QualityGateFailed(
            f"pass rate {report_row['passed_rows'] / total:.4f} below minimum {min_pass_rate}")


def top_failures(report: DataFrame, rules: list[Rule], k: int | None = None) -> DataFrame:
    """Rules ranked by failure count (desc, then name); the top ``k`` when given.

    Works on the one-row report, so the ranking window sees at most one row per rule.
    """
    from pyspark.sql import Window

    long = report.unpivot([], [r.fail_col for r in rules], "fail_col", "fail_count")
    long = long.select(F.regexp_replace("fail_col", "_fail_count$", "").alias("rule"), "fail_count")
    ranked = long.withColumn("failure_rank", F.row_number().over(Window.orderBy(F.desc("fail_count"), "rule")))
    return ranked.filter(F.col("failure_rank") <= k) if k is not None else ranked


def scorecard(flagged: DataFrame, rules: list[Rule]) -> DataFrame:
    """Per (dimension, severity): rule count, summed rule failures, rows failing any rule of the
    group, and the group's pass rate. One aggregate pass over the flagged frame."""
    groups: dict[tuple[str, str], list[Rule]] = {}
    for r in rules:
        groups.setdefault((r.dimension, r.severity), []).append(r)
    measures = [F.count(F.lit(1)).alias("_total")]
    for i, (_, rs) in enumerate(sorted(groups.items())):
        all_ok = reduce(lambda a, b: a & b, [F.col(r.name) for r in rs])
        measures.append(F.count_if(~all_ok).alias(f"_rows_{i}"))
        measures.append(reduce(lambda a, b: a + b, [F.count_if(~F.col(r.name)) for r in rs]).alias(f"_fails_{i}"))
    wide = flagged.agg(*measures)
    rows = [[F.lit(dim).alias("dimension"), F.lit(sev).alias("severity"),
             F.lit(len(rs)).cast("long").alias("rule_count"),
             F.col(f"_fails_{i}").cast("long").alias("rule_failures"),
             F.col(f"_rows_{i}").alias("failed_rows"),
             F.col("_total").alias("total_rows"),
             F.when(F.col("_total") > 0, 1 - F.col(f"_rows_{i}") / F.col("_total")).alias("pass_rate")]
            for i, ((dim, sev), rs) in enumerate(sorted(groups.items()))]
    return explode_rows(wide, rows)


def null_profile(df: DataFrame, columns: list[str] | None = None, max_null_share: float = 0.01) -> DataFrame:
    """NULL count and share per column in one pass; ``blocks_load`` when the share reaches the limit."""
    columns = df.columns if columns is None else columns
    wide = df.agg(F.count(F.lit(1)).alias("_total"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    long = wide.unpivot(["_total"], columns, "column_name", "null_count")
    share = F.when(F.col("_total") > 0, F.col("null_count") / F.col("_total"))
    return long.select(
        "column_name", "null_count", F.col("_total").alias("total_rows"), share.alias("null_share"),
        F.coalesce(share >= F.lit(max_null_share), F.lit(False)).alias("blocks_load"))


def referential_split(trips: DataFrame, master_ids: DataFrame, key: str, id_col: str = "LocationID") -> tuple[DataFrame, DataFrame]:
    """(rows whose ``key`` is in the master, rows whose key is not — NULL keys included)."""
    ids = master_ids.select(to_int(master_ids, id_col).alias("_rid")).dropna().distinct()
    k = to_int(trips, key)
    return (trips.join(ids, k == F.col("_rid"), "left_semi"),
            trips.join(ids, k == F.col("_rid"), "left_anti"))


def referential_integrity(trips: DataFrame, master_ids: DataFrame, keys=("PULocationID", "DOLocationID"),
                          id_col: str = "LocationID") -> DataFrame:
    """Per foreign key: rows matched / unmatched and the match rate, in one pass over the facts.

    The distinct master key set is joined once per role as a bounded broadcast; the fact side is
    scanned once and aggregated with partial aggregation.
    """
    ids = master_ids.select(to_int(master_ids, id_col).alias("_rid")).dropna().distinct()
    j = trips.select(*[to_int(trips, k).alias(k) for k in keys])
    for i, k in enumerate(keys):
        hit = ids.select(F.col("_rid").alias(f"_hit{i}"))
        j = j.join(hit, F.col(k) == F.col(f"_hit{i}"), "left")
    wide = j.agg(F.count(F.lit(1)).alias("_total"),
                 *[F.count(F.col(f"_hit{i}")).alias(f"_m{i}") for i in range(len(keys))])
    rows = [[F.lit(k).alias("key_column"), F.col(f"_m{i}").alias("matched_rows"),
             (F.col("_total") - F.col(f"_m{i}")).alias("unmatched_rows"),
             F.when(F.col("_total") > 0, F.col(f"_m{i}") / F.col("_total")).alias("match_rate")]
            for i, k in enumerate(keys)]
    return explode_rows(wide, rows)
