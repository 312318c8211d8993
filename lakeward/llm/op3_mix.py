"""Mixing sources to target weights by systematic sampling.

A document's size is its number of words. Sources, in code-point order with null last, have the
weights 3, 1, 2, 3, 1, 2, ...; together they share 150 % of all words. A source's target stops at
twice its own size and the excess is shared again by weight until no target is above its bound.
Every document of a source has the same expected number of copies, target / source size (at most
2). The running sum of the expected copies over the source's documents, plus one random offset per
source, gives a document one copy for each integer boundary that its step crosses.

Documents are summed up in order of size, so that documents of every length are taken evenly: the
words taken differ from the target by less than the source's longest document.

The running sum needs no task that sees a whole source: documents are range-partitioned by
(source, size, doc_id), a document's rank is its place in its partition plus the number of the
source's documents in earlier partitions, and the sum is rank times the (constant) step.

Defined edge cases: null text has size 0; a null source is a source of its own and comes last; a
source of size 0 has target 0 and takes nothing; repeated rows are separate documents; ties in size
and doc_id are broken by a hash of the text. An empty table gives an empty result. ``mixed`` carries
extra columns along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import packed, text_or_empty, width, written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_COPIES = 2
SEED = 20240601


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in the text: word starts are counted after folding the spaces."""
    # every run of spaces becomes one space, the ends go; what is left has one space between words
    folded = F.trim(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " "))
    spaces = F.length(folded) - F.length(F.replace(folded, F.lit(" "), F.lit("")))
    return F.when(folded == "", F.lit(0)).otherwise(spaces + 1).cast("bigint")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST_COPIES) -> DataFrame:
    """Per source of ``sizes`` (source, source_size, n_docs): its target.

    Works on one row per source. Raising the common level ``w * level`` until the shares are used
    up is what sharing the excess again and again comes to; sources are at their bound in
    ascending order of bound / weight.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    ranked = sizes.withColumn("place", F.row_number().over(order))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]),
                          ((F.col("place") - 1) % len(weights) + 1).cast("int")).cast("bigint")
    bounded = (ranked.withColumn("weight", weight).withColumn("bound", F.col("source_size") * most)
               .withColumn("total", F.sum("source_size").over(everything))
               .withColumn("all_weight", F.sum("weight").over(everything)))
    by_ratio = Window.orderBy(F.col("bound") / F.col("weight"), "place").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    summed = bounded.withColumn("bounds", F.sum("bound").over(by_ratio)).withColumn(
        "weights", F.sum("weight").over(by_ratio))
    # the level if exactly the sources before this one are at their bound; it is at its bound too
    # if its own bound is not above that level
    left = F.col("total") * F.lit(share) - (F.col("bounds") - F.col("bound"))
    at_bound = F.col("bound") * (F.col("all_weight") - F.col("weights") + F.col("weight")) <= left * F.col("weight")
    fixed = F.when(at_bound, F.col("bound")).otherwise(F.lit(0))
    fixed_weight = F.when(at_bound, F.col("weight")).otherwise(F.lit(0))
    levels = (summed.withColumn("at_bound", at_bound)
              .withColumn("level", (F.col("total") * F.lit(share) - F.sum(fixed).over(everything))
                          / F.nullif(F.col("all_weight") - F.sum(fixed_weight).over(everything), F.lit(0))))
    target = F.when(F.col("at_bound"), F.col("bound").cast("double")).otherwise(F.col("weight") * F.col("level"))
    return levels.select("source", "source_size", "n_docs", target.alias("target"))


def offset_of(source: Column, seed: int = SEED) -> Column:
    """One random offset in [0, 1) per source, the same in every run."""
    return F.pmod(F.xxhash64(F.coalesce(source, F.lit("\x00null")), F.lit(seed)), F.lit(1 << 30)) / F.lit(1 << 30)


def plan(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """Per row: doc_id, text_key, source, size, source_size, target, copies."""
    spark = docs.sparkSession
    text = text_or_empty()
    keyed = docs.select("doc_id", "source", word_count(text).alias("size"), F.xxhash64(text).alias("text_key"))
    placed = written(
        written(keyed, "mix-sizes").repartitionByRange(width(spark), F.col("source").asc_nulls_last(), "size", "doc_id",
                                                       "text_key")
        .sortWithinPartitions(F.col("source").asc_nulls_last(), "size", "doc_id", "text_key")
        .withColumn("part", F.spark_partition_id())
        # within a partition the ids count up by one in the sorted order
        .withColumn("place", F.monotonically_increasing_id()), "mix-placed")
    # one row per source and partition that holds it
    cells = placed.groupBy("source", "part").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"),
                                                 F.sum("size").alias("words"))
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("earlier", F.coalesce(F.sum("n").over(before), F.lit(0)))
    sources = cells.groupBy("source").agg(F.sum("words").alias("source_size"), F.sum("n").alias("n_docs"))
    targets = source_targets(sources)
    step = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    steps = targets.withColumn("step", step).withColumn("offset", offset_of(F.col("source"), seed))
    c, s = cells.alias("c"), steps.alias("s")
    cells = written(c.join(s, F.col("c.source").eqNullSafe(F.col("s.source")), "inner").select(
        F.col("c.source").alias("cell_source"), F.col("part").alias("cell_part"), "first", "earlier",
        "source_size", "target", "step", "offset"), "mix-cells")
    ranked = placed.join(cells, (F.col("part") == F.col("cell_part"))
                         & F.col("source").eqNullSafe(F.col("cell_source"))) \
        .withColumn("rank", F.col("place") - F.col("first") + F.col("earlier"))
    crossed = F.floor(F.col("step") * (F.col("rank") + 1) + F.col("offset")) \
        - F.floor(F.col("step") * F.col("rank") + F.col("offset"))
    return ranked.select("doc_id", "text_key", "source", "size", "source_size", "target",
                         crossed.cast("int").alias("copies"))


def taken(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken (words, repeats counted)."""
    return plan(docs, seed).select("doc_id", "size", "source_size", "target",
                                   (F.col("copies") * F.col("size")).cast("bigint").alias("taken"))


def mixed(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The mix: every row of ``docs`` as often as it is taken.

    Rows that agree in doc_id, source and text are repeats of one document: the copies that the plan
    gives to all of them are made from one of them.
    """
    def key(text_key: Column) -> list[Column]:
        # 96 bits over the document's identity, never null
        parts = [F.col("doc_id"), F.col("source"), text_key, F.col("doc_id").isNull(), F.col("source").isNull()]
        return [F.xxhash64(*parts), F.hash(*parts)]

    a, b = key(F.col("text_key"))
    copies = plan(docs, seed).select(a.alias("a"), b.alias("b"), "copies").groupBy("a", "b").agg(
        F.sum("copies").cast("int").alias("copies")).filter("copies > 0")
    a, b = key(F.xxhash64(text_or_empty()))
    rows = packed(docs, a=a, b=b).dropDuplicates(["a", "b"]).join(copies, ["a", "b"])
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
