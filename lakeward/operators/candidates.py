"""Candidate pairs of names for the two similarity scorers, without comparing all pairs of a block.

Both filters are exact: no pair that can reach the threshold is lost, and every pair comes out once,
at the rarest piece its two names share, so no ``distinct`` follows.

*Edit distance.* If ``y`` (the shorter name, or equal) is within ``t`` edits of ``x``, and ``x`` is cut
into ``C`` disjoint chunks, at least ``C - t`` chunks stand unchanged in ``y``, at most ``t`` places
away. So one of the ``t + 1`` rarest chunks of ``x`` is a piece of ``y``: only these are joined, and
pieces that many names share (``SUPPLIER 0000``) are left out as long as a name has rarer ones.
Chunks are as long as leaves two of them unchanged; a joined pair goes on only if all ``C - t`` are
there and the joined one is the rarest of them. A name gives rows in proportion to its length.

Short names in which only a few characters differ (numbered ones) have chunks of one or two
characters, and no chunk is rare. How many pairs a name's rarest chunks bring is known before the
join; where that is no fewer than the names it can be compared with, the name is compared with
these directly: each such pair once, by length and bounded distance. The names of a group are then
spread over slices, so that a hot group is the work of many tasks.

Names with the same first token and names with different ones are joined apart: without the bonus
for equal tokens a pair may differ in fewer characters, and with it the token, which costs no edit,
is part of the key and cut off the names.

*Jaro-Winkler.* With ``m`` matching characters, Jaro is at most ``(m/|x| + m/|y| + 1) / 3`` and ``m`` at
most the number of characters the names have in common. That number, with the bonus of the common
prefix, bounds a pair's score. Characters with their occurrence number (``E1``, ``E2``) are a name's
pieces; a pair that has enough of them in common shares one of the rarest few.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Covers the rounding of similarity and confidence to 4 places.
ROUNDING = 0.001
#: Names of a group that one slice compares with the group's names.
SLICE = 256


def _rarest_first(pieces: DataFrame, key: list[str], holders: DataFrame, name: list[str], kept: list[str]) -> DataFrame:
    """Per name: ``ranked``, its pieces by how many rows of ``holders`` have the same ``key`` (``held``),
    rarest first, and ``order``, their numbers ``i``."""
    frequency = holders.groupBy(*key).agg(F.count(F.lit(1)).alias("held"))
    return pieces.join(frequency, key, "left") \
        .groupBy(*name, *kept) \
        .agg(F.array_sort(F.collect_list(F.struct(F.coalesce("held", F.lit(0)).alias("held"), "i"))).alias("ranked")) \
        .withColumn("order", F.col("ranked")["i"])


# --------------------------------------------------------------------------------- edit distance

def edit_pieces(items: DataFrame, group: list[str], slack: float, kept: list[str] = ()) -> tuple[DataFrame, DataFrame]:
    """The two sides of the piece join of ``items`` (group, name, rest, ``kept``): the rarest chunks of
    every name as the longer of a pair (their ``place`` among its rarest, and ``work``: the pairs that
    all of them bring), and the pieces of every name as the shorter."""
    def budget(length: Column) -> Column:
        return F.floor(length * F.lit(slack) + F.lit(1e-9)).cast("int")

    def chunk(rest: Column, t: Column) -> Column:
        return F.greatest(F.lit(1), F.floor(rest / (t + 2)).cast("int"))

    items = items.withColumns({"r": F.length("rest"), "head": F.length("name") - F.length("rest")}) \
        .withColumn("t", budget(F.col("head") + F.col("r")))
    # a rest no longer than the budget is within it of every shorter one: these pairs are answers,
    # joined by the group alone (q = 0)
    x = items.withColumn("q", F.when(F.col("r") <= F.col("t"), F.lit(0)).otherwise(chunk(F.col("r"), F.col("t"))))
    x = x.withColumn("chunks", F.when(F.col("q") == 0, F.lit(1)).otherwise(F.floor(F.col("r") / F.greatest("q", F.lit(1)))).cast("int"))
    cut = x.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))) \
        .withColumn("piece", F.substr("rest", F.col("i") * F.col("q") + 1, F.col("q")))

    # y: its pieces of every length that a partner, at least as long, may be cut into
    longest = F.greatest(F.col("r"), F.floor((F.col("head") + F.col("r")) / F.lit(1 - slack)).cast("int") - F.col("head"))
    qs = F.transform(F.sequence("r", longest), lambda r: F.when(r <= budget(F.col("head") + r), F.lit(0))
                     .otherwise(chunk(r, budget(F.col("head") + r))))
    y = items.withColumn("q", F.explode(F.array_distinct(qs))).filter(F.col("q") <= F.col("r"))
    starts = F.sequence(F.lit(1), F.when(F.col("q") == 0, F.lit(1)).otherwise(F.col("r") - F.col("q") + 1))
    y = y.withColumn("piece", F.explode(F.array_distinct(F.transform(starts, lambda s: F.substr(F.col("rest"), s, F.col("q"))))))
    key = [*group, "q", "piece"]
    y = y.select(*key, F.col("name").alias("y"), F.col("rest").alias("ry"), *kept)

    ranked = _rarest_first(cut, key, y, [*group, "name"], ["rest", "r", "t", "q", "chunks", *kept])
    # the chunks that can go missing and one more
    joined = F.slice("ranked", 1, F.least("t", F.col("chunks") - 1) + 1)
    x = ranked.withColumn("work", F.aggregate(joined["held"], F.lit(0).cast("bigint"), lambda a, b: a + b)) \
        .select("*", F.posexplode(joined["i"]).alias("place", "i")) \
        .withColumn("piece", F.substr("rest", F.col("i") * F.col("q") + 1, F.col("q")))
    return x.select(*key, F.col("name").alias("x"), F.col("rest").alias("rx"), "r", "t", "chunks", "order", "i", "place", "work",
                    *kept), y


def _within(longer: str, shorter: str) -> Column:
    """Whether ``shorter`` may be a partner of ``longer`` (of equal length: the smaller text) and is
    within ``t`` edits of it."""
    less = F.length(longer) - F.length(shorter)
    fits = (less >= 0) & (less <= F.col("t")) & ((less > 0) | (F.col(shorter) < F.col(longer)))
    return fits & (F.call_function("levenshtein", F.col(longer), F.col(shorter), F.col("t")) >= 0)


def _direct_pairs(x: DataFrame, items: DataFrame, group: list[str], kept: list[str]) -> DataFrame:
    """Pairs of the names ``x`` (group, x, rx, t, mates and ``kept`` as ``*_x``) with those of ``items``.

    The names of a group go to one slice per ``SLICE`` names of it, and a slice meets all of the group.
    """
    slices = F.ceil(F.col("mates") / F.lit(SLICE)).cast("int")
    tasks = int(x.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = x.withColumn("slice", F.pmod(F.xxhash64("x"), slices).cast("int")).drop("mates")
    sizes = x.select(*group, "mates").distinct()
    y = items.select(*group, F.col("name").alias("y"), F.col("rest").alias("ry"), *[F.col(c).alias(f"{c}_y") for c in kept]) \
        .join(sizes, group).withColumn("slice", F.explode(F.sequence(F.lit(0), slices - 1))).drop("mates")
    # few rows that make many pairs: a number of tasks of its own keeps them from being put together
    key = [*group, "slice"]
    joined = spread.repartition(tasks, *key).join(y.repartition(tasks, *key), key)
    return joined.filter(_within("rx", "ry"))


def _edit_pairs(items: DataFrame, group: list[str], slack: float, kept: list[str]) -> DataFrame:
    """Pairs (group, x, y and ``kept`` of both, as ``*_x`` and ``*_y``) of ``items`` (group, name, rest,
    ``kept``) whose rests may be within ``floor(slack * length of the longer name)`` edits; the names
    differ by their rests only."""
    x, y = edit_pieces(items, group, slack, kept)
    x = x.withColumnsRenamed({c: f"{c}_x" for c in kept})
    y = y.withColumnsRenamed({c: f"{c}_y" for c in kept})
    found = [*group, "x", "y", *[f"{c}_{side}" for side in "xy" for c in kept]]
    mates = items.groupBy(*group).agg(F.count(F.lit(1)).alias("mates"))
    x = x.join(mates, group)
    # q = 0 has no piece but the empty one: all of the group
    direct = (F.col("q") == 0) | (F.col("work") >= F.col("mates"))
    straight = x.filter(direct & (F.col("place") == 0)).select(*group, "x", "rx", "t", "mates", *[f"{c}_x" for c in kept])

    def stands(i: Column) -> Column:
        first = F.greatest(F.lit(1), i * F.col("q") + 1 - F.col("t"))
        window = F.substr(F.col("ry"), first, i * F.col("q") + 1 + F.col("t") + F.col("q") - first)
        return F.contains(window, F.substr(F.col("rx"), i * F.col("q") + 1, F.col("q")))

    shorter = F.col("r") - F.length("ry")
    joined = x.filter(~direct).join(y, [*group, "q", "piece"]).filter(
        (shorter >= 0) & (shorter <= F.col("t")) & ((shorter > 0) | (F.col("ry") < F.col("rx"))))
    joined = joined.withColumn("standing", F.filter("order", stands)).filter(
        (F.size("standing") >= F.col("chunks") - F.col("t")) & (F.get("standing", F.lit(0)) == F.col("i")))
    return joined.filter(_within("rx", "ry")).select(*found).unionByName(
        _direct_pairs(straight, items, group, kept).select(*found))


def edit_candidates(names: DataFrame, block: str, name: str, medium: float, weight: float, bonus: float,
                    kept: list[str] = ()) -> DataFrame:
    """Distinct pairs (block, x, y and ``kept`` of both, as ``*_x`` and ``*_y``), ``x != y``, that may
    reach confidence ``medium``.

    Confidence is ``weight * (1 - distance / longer length)`` plus ``bonus`` for equal first tokens.
    ``names``: distinct non-NULL (block, name) and the columns ``kept``; empty names reach nothing and
    are left out.
    """
    least = (medium - bonus) / weight - ROUNDING
    if least <= 0:
        raise ValueError(f"at a threshold of {bonus + weight * ROUNDING:.4f} or less all names of equal first token qualify")
    items = names.filter(F.length(name) > 0).select(F.col(block).alias("block"), F.col(name).alias("name"), *kept) \
        .withColumn("token", F.substring_index("name", " ", 1))
    same = items.withColumn("rest", F.substr("name", F.length("token") + 1))
    columns = ["block", "x", "y", *[f"{c}_{side}" for side in "xy" for c in kept]]
    found = _edit_pairs(same, ["block", "token"], 1 - least, kept).select(*columns)
    least_apart = medium / weight - ROUNDING
    if least_apart <= 1:
        # only blocks that have different tokens
        tokens = items.groupBy("block").agg(F.min("token").alias("_least"), F.max("token").alias("_most"))
        mixed = items.join(tokens.filter("_least <> _most").select("block"), "block", "left_semi")
        apart = _edit_pairs(mixed.withColumn("rest", F.col("name")), ["block"], 1 - least_apart, kept)
        found = found.unionByName(apart.select(*columns).filter(
            F.substring_index("x", " ", 1) != F.substring_index("y", " ", 1)))
    return found


# ---------------------------------------------------------------------------------- Jaro-Winkler

PREFIX, SCALE, BOOST = 4, 0.1, 0.7


def _least_jaro(score: float, prefix: int) -> float:
    """The Jaro similarity that a pair with ``prefix`` equal first characters needs for ``score``."""
    boosted = (score - SCALE * prefix) / (1 - SCALE * prefix)
    # the prefix counts only above the boost threshold
    return min(score, max(boosted, BOOST)) if prefix else score


def jaro_winkler_candidates(names: DataFrame, block: str, name: str, score: float, apart: float,
                            kept: list[str] = ()) -> DataFrame:
    """Distinct pairs (block, x, y and ``kept`` of both, as ``*_x`` and ``*_y``), ``x != y``, that may have a Jaro-Winkler similarity of at least
    ``score`` if their first tokens are equal and ``apart`` if not.

    ``score`` must be above 0.7 (below it, names may have almost nothing in common).
    """
    if score <= BOOST:
        raise ValueError(f"the Jaro-Winkler filter works for similarities above {BOOST}")
    nth = Window.partitionBy("block", "name", "letter").orderBy("at")
    items = names.filter(F.length(name) > 0).select(F.col(block).alias("block"), F.col(name).alias("name"), *kept)
    letters = items.select("block", "name", *kept, F.posexplode(F.split("name", "")).alias("at", "letter")) \
        .filter(F.col("letter") != "")
    letters = letters.withColumn("piece", F.concat("letter", F.row_number().over(nth).cast("string")))
    ranked = _rarest_first(letters.withColumn("i", F.col("piece")), ["block", "piece"], letters, ["block", "name"], kept) \
        .drop("ranked").withColumnRenamed("order", "pieces")

    ranked = ranked.withColumns({"token": F.substring_index("name", " ", 1), "lead": F.substr("name", F.lit(1), F.lit(1))})

    def pairs(equal: list[str], unequal: list[str], target: float, prefix: int) -> DataFrame:
        """Pairs equal in the columns ``equal`` and not in ``unequal``, with at most ``prefix`` equal
        first characters, that may reach ``target``."""
        share = 3 * _least_jaro(target, prefix) - 1
        # the shortest similar enough partner of a name of length l has (share - 1) * l characters and
        # needs the fewest in common: all of its own
        fewest = F.greatest(F.lit(1), F.ceil((share - 1) * F.length("name") - F.lit(1e-9)).cast("int"))
        side = ranked.withColumn("rare", F.slice("pieces", 1, F.length("name") - fewest + 1)) \
            .withColumn("piece", F.explode("rare"))
        key = ["block", *equal, "piece"]
        x = side.select(*key, F.col("name").alias("x"), *[F.col(c).alias(f"{c}_x") for c in ("pieces", "rare", *unequal, *kept)])
        y = side.select(*key, F.col("name").alias("y"), *[F.col(c).alias(f"{c}_y") for c in ("pieces", "rare", *unequal, *kept)])
        joined = x.join(y, key).filter(F.col("x") < F.col("y"))
        for c in unequal:
            joined = joined.filter(F.col(f"{c}_x") != F.col(f"{c}_y"))
        # once, at the rarest piece that both have among their rarest
        joined = joined.filter(F.get(F.array_intersect("rare_x", "rare_y"), F.lit(0)) == F.col("piece"))
        needed = F.lit(_least_jaro(target, 0))
        for k in range(1, prefix + 1):
            same = F.substr("x", F.lit(1), F.lit(k)) == F.substr("y", F.lit(1), F.lit(k))
            long_enough = (F.length("x") >= k) & (F.length("y") >= k)
            needed = F.when(same & long_enough, F.lit(_least_jaro(target, k))).otherwise(needed)
        common = F.size(F.array_intersect("pieces_x", "pieces_y"))
        bound = (common / F.length("x") + common / F.length("y") + 1) / 3
        return joined.filter(bound >= needed - F.lit(1e-9)).select("block", "x", "y", *[f"{c}_{side}" for side in "xy" for c in kept])

    found = pairs(["token"], [], score, PREFIX)
    if apart <= 1:
        found = found.unionByName(pairs(["lead"], ["token"], apart, PREFIX)).unionByName(pairs([], ["lead"], apart, 0))
    return found
