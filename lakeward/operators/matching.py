"""Master-data matching: standardisation, duplicate evidence, fuzzy candidates, decisions,
golden master, survivorship, audit.

Pair semantics (per entity row a, b): same non-NULL block, ``a.id < b.id`` (NULL ids never pair),
name similarity ``1 - lev/maxlen`` (4 places), confidence ``0.9*sim + 0.1*first-token-equal``
(4 places), decision by inclusive thresholds.

Scale design — no operator here enumerates all pairs of a block:

* Rows are first collapsed to distinct ``(block, name)`` groups. Pairs of rows with the *same*
  name are exact duplicates (similarity 1.0, or 0.0 / NULL for empty / NULL names); they are
  scored once per group and counted arithmetically.
* Pairs of *different* names that can reach the medium threshold come from the exact filters of
  ``candidates.py``: names are equi-joined on their rarest pieces, a key far finer than the block,
  so a hot block spreads over many tasks, and every pair that passes the filter is scored exactly.
* Pair counts per decision come from arithmetic over group sizes plus the verified candidates;
  the reject band is the remainder, never materialised.
* Products hold one row per pair of match keys, named by their golden ids, with the number of
  row pairs it stands for; rows of one key are listed as a star (member id -> golden id). No
  product holds a row per pair of entity rows.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import governance as gov
from ..functions import text as tx
from ..functions.casts import to_int
from ..functions.similarity_udf import jaro_winkler_similarity
from ..functions.time import stamp
from ..session import shared_dir
from ..sources.files import require_columns, resolve_any
from .candidates import ROUNDING, edit_candidates, jaro_winkler_candidates

BLOCK, NAME, ID = "borough_norm", "zone_norm", "location_id"
PAIR_COLUMNS = ["id_a", "id_b", "zone_a", "zone_b", "borough", "name_similarity", "token_a", "token_b",
                "token_match", "match_confidence", "decision", "pair_count"]
LEVENSHTEIN, JARO_WINKLER, HEURISTIC = "levenshtein", "jaro_winkler", "heuristic"
#: Name similarities that the pair plan can use.
SCORERS = {LEVENSHTEIN: tx.lev_similarity, JARO_WINKLER: jaro_winkler_similarity}


# ----------------------------------------------------------------------------------- standardise

def standardize(entities: DataFrame, borough_mode: str = "normalize") -> DataFrame:
    """Entity rows + ``location_id`` (int), ``zone_norm``, ``borough_norm``, ``match_key``.

    ``borough_mode="normalize"`` applies the full name standardisation to the block attribute
    (code behaviour); ``"upper_trim"`` applies only upper + trim (declared behaviour). A missing
    Borough column gives the block ``UNKNOWN``.
    """
    require_columns(entities, "LocationID", what="zone reference")
    zone_col = resolve_any(entities, "Zone", "zone_name", what="zone reference")
    z = entities.withColumn("LocationID", to_int(entities, "LocationID")).withColumnRenamed("LocationID", ID)
    cols = {NAME: tx.normalize_text(zone_col)}
    if "Borough" in entities.columns:
        cols[BLOCK] = tx.normalize_text("Borough") if borough_mode == "normalize" else tx.upper_trim("Borough")
    else:
        cols[BLOCK] = F.lit("UNKNOWN")
    return z.withColumns(cols).withColumn("match_key", tx.concat_key(F.col(BLOCK), F.col(NAME)))


def declared_match_key(entities: DataFrame) -> Column:
    """The declared blocking expression on raw attributes (NULL when either part is NULL)."""
    zone_col = resolve_any(entities, "Zone", "zone_name")
    return tx.declared_key(F.col("Borough"), F.col(zone_col))


def blocked_by(z: DataFrame, key: Column) -> DataFrame:
    """Standardised rows whose block is ``key``, e.g. the declared blocking key: every operator of the
    pair plan then compares rows of equal key only (rows with a NULL key pair with none)."""
    return z.withColumn(BLOCK, key)


# ----------------------------------------------------------------------------- duplicate evidence

def dup_by_match_key(z: DataFrame) -> DataFrame:
    return z.groupBy("match_key").count().filter(F.col("count") > 1)


def dup_by_id(z: DataFrame) -> DataFrame:
    return z.groupBy(ID).count().filter(F.col("count") > 1)


# ------------------------------------------------------------------------------------- scoring

def _scored(df: DataFrame, a: str, b: str, high: float, medium: float, scorer: str = LEVENSHTEIN) -> DataFrame:
    # staged so that each expression is computed once (similarity feeds confidence feeds decision)
    df = df.withColumn("name_similarity", SCORERS[scorer](F.col(a), F.col(b)))
    df = df.withColumns({"token_a": tx.first_token(F.col(a)), "token_b": tx.first_token(F.col(b))})
    df = df.withColumn("token_match", tx.token_match("token_a", "token_b"))
    df = df.withColumn("match_confidence", tx.match_confidence("name_similarity", "token_match"))
    return df.withColumn("decision", tx.decision("match_confidence", high, medium))


# ------------------------------------------------------------------------ name groups / counts

def pairable_rows(z: DataFrame) -> DataFrame:
    """Rows that can take part in a pair: non-NULL block and id."""
    return z.filter(F.col(BLOCK).isNotNull() & F.col(ID).isNotNull()).select(BLOCK, NAME, ID)


def id_multiplicity(z: DataFrame) -> DataFrame:
    """``(block, name, id, _m)``: how many pairable rows share each (block, name, id).

    Every figure and product of the matching plan derives from this table, so it is computed once
    and checkpointed to the shared checkpoint folder: later branches (group sizes, candidates,
    pair counts, id expansion) read its files instead of re-reading and re-normalising the
    entity table, and a lost executor recomputes from the files, not from the sources.
    """
    per_id = pairable_rows(z).groupBy(BLOCK, NAME, ID).agg(F.count(F.lit(1)).alias("_m"))
    shared_dir(z.sparkSession)
    return per_id.checkpoint(eager=True)


def _pairs_of(multiplicity):
    """Pairs of rows with distinct ids, ``(n^2 - sum of m_id^2) / 2``, in exact decimal arithmetic.

    Counts are longs: more than 2^63 pairs (a block of over 4.29e9 rows) raise instead of wrapping.
    """
    m = multiplicity.cast("decimal(18,0)")
    n = F.sum(m).cast("decimal(19,0)")
    return ((n * n - F.sum(m * m)) * F.lit(Decimal("0.5"))).cast("long")


def name_groups(per_id: DataFrame) -> DataFrame:
    """Per (block, name): rows ``n``, ``same_name_pairs`` = pairs of rows with distinct ids, and the
    ``golden_id`` (see ``golden_ids``).

    ``(n^2 - sum over ids of m_id^2) / 2`` where ``m_id`` is the multiplicity of an id in the group.
    A hash aggregate with map-side partial aggregation; a hot group is pre-aggregated per task.
    """
    return per_id.groupBy(BLOCK, NAME).agg(
        F.sum("_m").alias("n"),
        _pairs_of(F.col("_m")).alias("same_name_pairs"),
        F.min(ID).alias("golden_id"))


def block_pair_totals(per_id: DataFrame) -> DataFrame:
    """Per block: all row pairs with distinct ids, by the same arithmetic (no pair is built)."""
    by_id = per_id.groupBy(BLOCK, ID).agg(F.sum("_m").alias("_m"))
    return by_id.groupBy(BLOCK).agg(
        _pairs_of(F.col("_m")).alias("pairs"))


# ------------------------------------------------------------------------- candidate generation

def fuzzy_candidates(names: DataFrame, medium: float, scorer: str = LEVENSHTEIN, kept: list[str] = ()) -> DataFrame:
    """Distinct pairs (block, name_x, name_y), ``x != y``, that *may* reach ``medium``; exact filter.

    ``names`` has distinct non-NULL ``(borough_norm, zone_norm)``. Returns columns
    ``borough_norm, zone_u, zone_v`` with ``zone_u < zone_v``, and the columns ``kept`` of ``names``
    as ``*_u`` and ``*_v``. Bounds of ``medium``: above 0.1009 for
    edit distance, above 0.7309 for Jaro-Winkler (below, names without anything in common qualify).
    """
    weight, bonus = gov.CONFIDENCE_WEIGHTS
    if scorer == LEVENSHTEIN:
        found = edit_candidates(names, BLOCK, NAME, medium, weight, bonus, kept)
    else:
        found = jaro_winkler_candidates(names, BLOCK, NAME, (medium - bonus) / weight - ROUNDING, medium / weight - ROUNDING, kept)
    straight = F.col("x") < F.col("y")
    return found.select(
        F.col("block").alias(BLOCK), F.least("x", "y").alias("zone_u"), F.greatest("x", "y").alias("zone_v"),
        *[F.when(straight, F.col(f"{c}_x")).otherwise(F.col(f"{c}_y")).alias(f"{c}_u") for c in kept],
        *[F.when(straight, F.col(f"{c}_y")).otherwise(F.col(f"{c}_x")).alias(f"{c}_v") for c in kept])


# --------------------------------------------------------------------------------- name pairs

def name_pair_scores(z: DataFrame, high: float = gov.HIGH_CONFIDENCE, medium: float = gov.MEDIUM_CONFIDENCE,
                     actionable_only: bool = True, per_id: DataFrame | None = None,
                     scorer: str = LEVENSHTEIN) -> DataFrame:
    """Scored distinct-name pairs per block with the number of id pairs they stand for.

    ``scorer``: the name similarity (``SCORERS``); each has a candidate filter of its own, so a pair
    that only one of them accepts is found by that one.

    Columns: borough, zone_u, zone_v, name_similarity, token_u, token_v, token_match,
    match_confidence, decision, pair_count. Same-name groups appear with ``zone_u = zone_v``.
    With ``actionable_only`` only pairs at or above ``medium`` are returned (the rest is REJECT).
    """
    scores = _pair_scores(z, high, medium, per_id, scorer).drop("_id_u", "_id_v")
    if actionable_only:
        scores = scores.filter(F.col("match_confidence") >= F.lit(medium))
    return scores


def _pair_scores(z: DataFrame, high: float, medium: float, per_id: DataFrame | None, scorer: str = LEVENSHTEIN) -> DataFrame:
    """``name_pair_scores`` with the golden ids ``_id_u`` and ``_id_v`` of the two names.

    Pairs may be far more than names, so a name takes its rows and golden id along into the pair
    instead of pairs being joined with names again.
    """
    per_id = id_multiplicity(z) if per_id is None else per_id
    groups = name_groups(per_id)
    same = groups.filter(F.col("same_name_pairs") > 0).select(
        BLOCK, F.col(NAME).alias("zone_u"), F.col(NAME).alias("zone_v"), F.col("same_name_pairs").alias("pair_count"),
        F.col("golden_id").alias("_id_u"), F.col("golden_id").alias("_id_v"))
    same = _scored(same, "zone_u", "zone_v", high, medium, scorer)

    names = groups.filter(F.col(NAME).isNotNull()).select(BLOCK, NAME, F.col("n").alias("_n"), F.col("golden_id").alias("_id"))
    cand = fuzzy_candidates(names, medium, scorer, ["_n", "_id"])
    cand = _scored(cand, "zone_u", "zone_v", high, medium, scorer).filter(F.col("match_confidence") >= F.lit(medium))
    # id pairs between two different names: n_u * n_v minus pairs of rows sharing one id. These come
    # from ids under several names of a block only, and from the candidates among these names (work
    # bounded by the ids of the candidates, not by the block)
    several = per_id.filter(F.col(NAME).isNotNull()).groupBy(BLOCK, ID).agg(F.count(F.lit(1)).alias("_names")) \
        .filter("_names > 1").select(BLOCK, ID)
    multi = per_id.filter(F.col(NAME).isNotNull()).join(several, [BLOCK, ID], "left_semi")
    mu = multi.select(BLOCK, F.col(NAME).alias("zone_u"), ID, F.col("_m").alias("_mu"))
    mv = multi.select(BLOCK, F.col(NAME).alias("zone_v"), ID, F.col("_m").alias("_mv"))
    keys = fuzzy_candidates(multi.select(BLOCK, NAME).distinct(), medium, scorer)
    shared = (keys.join(mu, [BLOCK, "zone_u"]).join(mv, [BLOCK, "zone_v", ID])
                  .groupBy(BLOCK, "zone_u", "zone_v").agg(F.sum(F.col("_mu") * F.col("_mv")).alias("_shared")))
    fuzzy = (cand.join(shared, [BLOCK, "zone_u", "zone_v"], "left")
                 .withColumn("pair_count", (F.col("_n_u") * F.col("_n_v") - F.coalesce("_shared", F.lit(0))).cast("long"))
                 .filter(F.col("pair_count") > 0))
    cols = [F.col(BLOCK).alias("borough"), "zone_u", "zone_v", "name_similarity",
            F.col("token_a").alias("token_u"), F.col("token_b").alias("token_v"),
            "token_match", "match_confidence", "decision", "pair_count", "_id_u", "_id_v"]
    return same.select(*cols).unionByName(fuzzy.select(*cols))


def golden_ids(per_id: DataFrame) -> DataFrame:
    """Per (block, name) the id of its golden row among the rows that can pair: the smallest."""
    return per_id.groupBy(BLOCK, NAME).agg(F.min(ID).alias("golden_id"))


def match_decisions(z: DataFrame, high: float = gov.HIGH_CONFIDENCE, medium: float = gov.MEDIUM_CONFIDENCE,
                    per_id: DataFrame | None = None, scores: DataFrame | None = None) -> DataFrame:
    """AUTO_MERGE / STEWARD_REVIEW pairs of different match keys, one row per pair of keys.

    ``id_a`` and ``id_b`` are the golden ids of the two keys, ``id_a`` the smaller one (equal ids:
    the smaller name first); ``pair_count`` is the number of entity-row pairs the row stands for.
    Rows of one key are in ``auto_merge_members``.
    """
    per_id = id_multiplicity(z) if per_id is None else per_id
    if scores is None:
        pairs = _pair_scores(z, high, medium, per_id).filter(
            (F.col("zone_u") != F.col("zone_v")) & (F.col("match_confidence") >= F.lit(medium)))
    else:
        ids = golden_ids(per_id)
        pairs = scores.filter(F.col("zone_u") != F.col("zone_v"))
        for side in ("u", "v"):
            pairs = pairs.join(ids.select(F.col(BLOCK).alias("borough"), F.col(NAME).alias(f"zone_{side}"),
                                          F.col("golden_id").alias(f"_id_{side}")), ["borough", f"zone_{side}"])
    ends = [F.struct(F.col(f"_id_{side}").alias("id"), F.col(f"zone_{side}").alias("zone"),
                     F.col(f"token_{side}").alias("token")) for side in ("u", "v")]
    pairs = pairs.withColumns({"_a": F.least(*ends), "_b": F.greatest(*ends)})
    named = {f"{field}_{side}": F.col(f"_{side}.{field}") for field in ("id", "zone", "token") for side in ("a", "b")}
    return pairs.withColumns(named).select(*PAIR_COLUMNS)


def auto_merge_members(z: DataFrame, high: float = gov.HIGH_CONFIDENCE,
                       per_id: DataFrame | None = None) -> DataFrame:
    """Rows of one match key that merge without review, as a star: every further id -> golden id.

    A key of n ids gives n - 1 rows. Empty names score 0.1 at most and NULL names have no score,
    so neither merges at a threshold above that.
    """
    per_id = id_multiplicity(z) if per_id is None else per_id
    keys = _scored(golden_ids(per_id), NAME, NAME, high, high).filter(F.col("decision") == gov.AUTO_MERGE)
    members = per_id.join(keys.select(BLOCK, NAME, "golden_id"), [BLOCK, NAME])
    return (members.filter(F.col(ID) > F.col("golden_id"))
                   .select(ID, "golden_id", BLOCK, NAME, tx.concat_key(F.col(BLOCK), F.col(NAME)).alias("match_key")))


def steward_queue(decisions: DataFrame, now=None) -> DataFrame:
    """The steward product: STEWARD_REVIEW pairs of keys, status PENDING, highest confidence first."""
    return (decisions.filter(F.col("decision") == gov.STEWARD_REVIEW)
                     .select("id_a", "id_b", "zone_a", "zone_b", "borough", "name_similarity", "match_confidence",
                             "decision", F.lit(gov.PENDING).alias("review_status"),
                             stamp(now).alias("submitted_at_utc"), "pair_count")
                     .orderBy(F.desc("match_confidence"), "id_a", "id_b"))


def match_audit(z: DataFrame, high: float = gov.HIGH_CONFIDENCE, medium: float = gov.MEDIUM_CONFIDENCE,
                per_id: DataFrame | None = None, scores: DataFrame | None = None) -> DataFrame:
    """Run audit: rows, all pairs compared, pairs per decision band (reject = the remainder).

    Every figure is exact; none needs the pair list: totals come from group-size arithmetic,
    actionable bands from the verified candidates weighted by their pair counts.
    """
    per_id = id_multiplicity(z) if per_id is None else per_id
    scores = name_pair_scores(z, high, medium, per_id=per_id) if scores is None else scores
    totals = block_pair_totals(per_id).agg(F.coalesce(F.sum("pairs"), F.lit(0)).cast("long").alias("total_pairs_compared"))
    bands = scores.agg(
        F.coalesce(F.sum(F.when(F.col("decision") == gov.AUTO_MERGE, F.col("pair_count"))), F.lit(0))
         .cast("long").alias("auto_merge_pairs"),
        F.coalesce(F.sum(F.when(F.col("decision") == gov.STEWARD_REVIEW, F.col("pair_count"))), F.lit(0))
         .cast("long").alias("steward_review_pairs"))
    rowsn = z.agg(F.count(F.lit(1)).alias("total_zone_rows"))
    out = rowsn.crossJoin(totals).crossJoin(bands)  # three one-row aggregates
    return out.select(
        "total_zone_rows", "total_pairs_compared", "auto_merge_pairs", "steward_review_pairs",
        (F.col("total_pairs_compared") - F.col("auto_merge_pairs") - F.col("steward_review_pairs")).alias("reject_pairs"),
        F.lit(float(high)).alias("high_conf_threshold"), F.lit(float(medium)).alias("med_conf_threshold"))


def audit_by_block(z: DataFrame, scorer: str, high: float = gov.HIGH_CONFIDENCE, medium: float = gov.MEDIUM_CONFIDENCE,
                   per_id: DataFrame | None = None) -> DataFrame:
    """Per block: all row pairs and how many fall in each decision band under ``scorer``.

    The heuristic scorer gives every pair one of two constants, so its bands are arithmetic over
    group sizes; the others count their verified pairs, and the rest of a block is the reject band.
    """
    per_id = id_multiplicity(z) if per_id is None else per_id
    if scorer != HEURISTIC:
        scores = name_pair_scores(z, high, medium, per_id=per_id, scorer=scorer)
        return bands_by_block(per_id, scores).select(F.lit(scorer).alias("scorer"), "*")
    equal = name_groups(per_id).groupBy(F.col(BLOCK).alias("borough")).agg(F.sum("same_name_pairs").alias("equal"))
    pairs = block_pair_totals(per_id).select(F.col(BLOCK).alias("borough"), "pairs").join(equal, "borough")
    counts = pairs.select("borough", F.inline(F.array(*[
        F.struct(tx.decision(F.lit(score), high, medium).alias("decision"), n.alias("pair_count"))
        for score, n in ((gov.HEURISTIC_EXACT_SCORE, F.col("equal")),
                         (gov.HEURISTIC_OTHER_SCORE, F.col("pairs") - F.col("equal")))])))
    return bands_by_block(per_id, counts).select(F.lit(scorer).alias("scorer"), "*")


def bands_by_block(per_id: DataFrame, scores: DataFrame) -> DataFrame:
    """Per block with pairs: all of them, and those of ``scores`` (borough, decision, pair_count) per
    band; what ``scores`` does not have is the reject band."""
    found = scores.groupBy("borough").agg(*[
        F.sum(F.when(F.col("decision") == band, F.col("pair_count"))).alias(band)
        for band in (gov.AUTO_MERGE, gov.STEWARD_REVIEW)])
    merge, review = (F.coalesce(F.col(band), F.lit(0)).cast("long") for band in (gov.AUTO_MERGE, gov.STEWARD_REVIEW))
    totals = block_pair_totals(per_id).filter("pairs > 0").select(F.col(BLOCK).alias("borough"), "pairs")
    return totals.join(found, "borough", "left").select(
        "borough", F.col("pairs").alias("total_pairs_compared"), merge.alias("auto_merge_pairs"),
        review.alias("steward_review_pairs"), (F.col("pairs") - merge - review).alias("reject_pairs"))


# ------------------------------------------------------------------------------ golden master

def _id_order() -> Column:
    """The id as a long that sorts NULL ids first (ids are ints, so no id has this value)."""
    return F.coalesce(F.col(ID).cast("bigint"), F.lit(-(1 << 63)))


def golden_master(z: DataFrame, now=None, tie_break: list[str] | None = None) -> DataFrame:
    """One whole row per match key: the row with the smallest id (NULL ids first), ties broken
    on the remaining columns so the choice is deterministic.

    Two phases instead of a ranking window. The smallest id per key is a hash aggregate on a
    fixed-width buffer, combined map-side, so a key holding a large share of rows is one row per
    task at the shuffle. Its rows are then joined back on (key, id), a key as fine as the ids, and
    only they are compared on the tie-break columns.
    """
    tie_break = tie_break if tie_break is not None else [c for c in z.columns if c not in (ID, "match_key")]
    rows = z.select("match_key", _id_order().alias("_order"), F.struct(*[F.col(c) for c in z.columns]).alias("_row"))
    smallest = z.groupBy("match_key").agg(F.min(_id_order()).alias("_order"))
    # ``match_key`` comes from concat_ws and is never NULL
    tied = rows.join(smallest, ["match_key", "_order"])
    order = F.struct(*[F.struct(F.col(f"_row.{c}").isNotNull(), F.col(f"_row.{c}")).alias(f"_t{i}")
                       for i, c in enumerate(tie_break)]) if tie_break else F.lit(0)
    best = tied.groupBy("match_key").agg(F.min_by("_row", order).alias("_row"))
    ts = stamp(now)
    return best.select("_row.*").withColumns({
        "mdm_state": F.lit(gov.MASTER_DEFAULT_STATE),
        "created_at_utc": ts, "updated_at_utc": ts,
        "survivorship_rule": F.lit(gov.MASTER_SURVIVORSHIP_TEXT)})


def survivorship_first_non_null(z: DataFrame, attributes=("Zone", "Borough", "service_zone")) -> DataFrame:
    """Attribute-wise survivorship per match key: MIN(id) and, per attribute, the first non-NULL
    value in the order of the golden row (rows with a NULL id count too; equal ids: the smallest value).

    As for the golden row, a hash aggregate finds the ids (the smallest, and per attribute the first
    that has a value), and only the rows of these ids are read for the values.
    """
    attributes = [a for a in attributes if a in z.columns]
    firsts = z.groupBy("match_key").agg(
        F.min(ID).alias(ID), *[F.min(F.when(F.col(a).isNotNull(), _id_order())).alias(f"_o{i}")
                               for i, a in enumerate(attributes)])
    if not attributes:
        return firsts
    orders = [f"_o{i}" for i in range(len(attributes))]
    wanted = firsts.withColumn("_order", F.explode_outer(F.array_distinct(F.array_compact(F.array(*orders)))))
    values = z.select("match_key", _id_order().alias("_order"), *[F.col(a).alias(f"_v{i}") for i, a in enumerate(attributes)])
    return wanted.join(values, ["match_key", "_order"], "left").groupBy("match_key").agg(
        F.min(ID).alias(ID), *[F.min(F.when(F.col("_order") == F.col(f"_o{i}"), F.col(f"_v{i}"))).alias(a)
                               for i, a in enumerate(attributes)])


def heuristic_scores(pairs: DataFrame, high: float = gov.HIGH_CONFIDENCE, medium: float = gov.MEDIUM_CONFIDENCE,
                     key_a: str = "zone_u", key_b: str = "zone_v") -> DataFrame:
    """Declared deterministic scorer over candidate pairs: 1.0 on equal keys, else 0.85."""
    score = F.when(F.col(key_a) == F.col(key_b), F.lit(gov.HEURISTIC_EXACT_SCORE)).otherwise(
        F.lit(gov.HEURISTIC_OTHER_SCORE))
    return pairs.withColumn("heuristic_score", score).withColumn(
        "heuristic_decision", tx.decision(F.col("heuristic_score"), high, medium))
