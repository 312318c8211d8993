"""Prefix trie of conversations by fixed-length block hashing.

A turn's digest is tagged with its place in the conversation; the digest of a prefix is the sum of
its turns' tagged digests (four sums of 32-bit words, 128 bits in all), so a block of ``BLOCK`` turns
adds one number to its conversation's prefix and any prefix is a running sum.

Conversations are first grouped by their successive block digests: one row per distinct block
behind a distinct prefix, with its number of conversations and the smallest of them. Where only one
block follows a prefix, all its turns are nodes with the same members. Where several follow, the
siblings diverge inside the block, and only these blocks are cut into turns that are grouped again.

Sums over subtrees need no walk from level to level. A node belongs to its smallest member; the
nodes of one conversation are then the lower end of its path. A node's subtree is the rest of its
owner's path, summed from below, and the whole paths of the other owners that pass through it, which
every owner adds to the nodes above its own (by block first, by turn where the path leaves the block).

No conversation is held by one task: turns are numbered by a global sort with the counts of the
partitions before, running sums go over runs of ``RUN`` blocks and then over the runs' totals. The
ids that end in a node are hashed in order, as text made in pieces beforehand, by a task that keeps
the state of the hash only.

Defined edge cases: null role or text is empty; rows with a null conv_id belong to no conversation
and are left out; turns of equal number are ordered by a hash of role and text (null numbers come
first), repeated rows are turns of their own; a conversation without turns is a member of the root
only; an empty table has no node; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import text_or_empty, width, written

BLOCK = 4
#: Blocks (or nodes) of a conversation over which one running sum goes.
RUN = 1024
#: Ids in a piece of text that is hashed.
PIECE = 4096
WORD = "[^\\x20\\x09-\\x0D]+"
PARTS = ["a", "b", "c", "d"]
EMPTY = hashlib.sha256().hexdigest()


def _running(rows: DataFrame, group: str, place: str, sums: list[str], falling: bool = False) -> DataFrame:
    """Add ``<s>_before`` for every s of ``sums``: the sum over the rows of the group before this one
    (after it, if ``falling``), by runs of RUN places and then over the totals of runs."""
    order = F.col(place).desc() if falling else F.col(place)
    run_order = F.col("run").desc() if falling else F.col("run")
    rows = rows.withColumn("run", F.floor(F.col(place) / RUN))
    inside = Window.partitionBy(group, "run").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    runs = Window.partitionBy(group).orderBy(run_order).rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy(group, "run").agg(*[F.sum(s).alias(s) for s in sums])
    # only conversations longer than one run have a row here
    carried = totals.select(group, "run", F.row_number().over(runs.rowsBetween(Window.unboundedPreceding, 0)).alias("r"),
                            *[F.sum(s).over(runs).alias(f"{s}_carried") for s in sums]).filter("r > 1").drop("r")
    zero = F.lit(0).cast("bigint")
    return rows.join(carried, [group, "run"], "left").withColumns({
        f"{s}_before": F.coalesce(F.sum(s).over(inside), zero) + F.coalesce(F.col(f"{s}_carried"), zero) for s in sums}) \
        .drop("run", *[f"{s}_carried" for s in sums])


def numbered(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The turns of every conversation (conv, part, at, digest, words), sorted, and how many turns of
    the conversation each partition holds (conv, part, first, n, earlier)."""
    role, text = text_or_empty("role"), text_or_empty("text")
    rows = conversations.filter("conv_id is not null").select(
        F.col("conv_id").alias("conv"), "turn",
        F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("words"),
        # the order of equal turn numbers: ranges are found in a pass of their own, which only needs these
        F.xxhash64(role, text).alias("tie"), F.monotonically_increasing_id().alias("place"))
    by = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("tie"), F.col("place")]
    number = F.monotonically_increasing_id()
    turns = rows.repartitionByRange(width(conversations.sparkSession), *by).sortWithinPartitions(*by) \
        .select("conv", "digest", "words", F.shiftright(number, 33).alias("part"),
                number.bitwiseAND(F.lit((1 << 33) - 1)).alias("at"))
    turns = written(turns, "trie-turns")
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = turns.groupBy("conv", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    return turns, counts.withColumn("earlier", F.coalesce(F.sum("n").over(earlier), F.lit(0).cast("bigint")))


def plain(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns (conv, pos, digest, words, length) and members (conv, length) of the conversations as they are."""
    turns, counts = numbered(conversations)
    members = counts.groupBy("conv").agg(F.sum("n").alias("length"))
    placed = counts.join(members, "conv").select("conv", "part", "first", "earlier", "length")
    return turns.join(placed, ["conv", "part"]).select(
        "conv", (F.col("earlier") + F.col("at") - F.col("first") + 1).alias("pos"), "digest", "words", "length"), members


def with_shared_heads(conversations: DataFrame, every: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """As ``plain``, of conversations rebuilt on a shared head: conversation c gets the first h turns
    of conversation c - c % every in place of its own first h; h = crc32(c as text) % most. The
    remainder has c's sign, so negative ids share the heads of the multiple next to 0."""
    turns, counts = numbered(conversations)
    h = F.crc32(F.col("conv").cast("string")) % most
    own = counts.groupBy("conv").agg(F.sum("n").alias("n")).select(
        "conv", "n", h.alias("h"), (F.col("conv") - F.col("conv") % every).alias("base"))
    heads = own.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    members = own.join(heads, "base", "left").select(
        "conv", "base", "h", F.least(F.coalesce("base_n", F.lit(0)), "h").alias("head"),
        F.greatest(F.col("n") - F.col("h"), F.lit(0).cast("bigint")).alias("rest"))
    members = members.withColumn("length", F.col("head") + F.col("rest"))
    placed = counts.join(members, "conv").select("conv", "part", "first", "earlier", "h", "head", "length")
    ranked = turns.join(placed, ["conv", "part"]) \
        .withColumn("rank", F.col("earlier") + F.col("at") - F.col("first") + 1)
    tails = ranked.filter("rank > h").select(
        "conv", (F.col("rank") - F.col("h") + F.col("head")).alias("pos"), "digest", "words", "length")
    # at most `most - 1` turns of a base, for at most `every` conversations that share it
    first = ranked.filter((F.col("conv") % every == 0) & (F.col("rank") < most)) \
        .select(F.col("conv").alias("base"), F.col("rank").alias("pos"), "digest", "words")
    taken = members.select("conv", "base", "h", "length").join(first, "base").filter("pos <= h") \
        .select("conv", "pos", "digest", "words", "length")
    return taken.unionByName(tails), members.select("conv", "length")


def _blocks(turns: DataFrame) -> DataFrame:
    """One row per block of a conversation: conv, k, length, before (digest of the prefix before it),
    keys (of the prefixes that end in it) and words of its turns."""
    tagged = F.sha2(F.concat_ws(":", "pos", "digest"), 256)
    entry = F.struct("pos", *[F.conv(F.substring("tagged", 1 + 8 * i, 8), 16, 10).cast("bigint").alias(p)
                              for i, p in enumerate(PARTS)], "words")
    blocks = turns.withColumn("tagged", tagged) \
        .groupBy("conv", F.floor((F.col("pos") - 1) / BLOCK).alias("k"), "length") \
        .agg(F.array_sort(F.collect_list(entry)).alias("turns"))  # at most BLOCK of them

    def total(values: Column, start: Column) -> Column:
        return F.aggregate(values, start, lambda x, y: x + y)

    blocks = blocks.withColumns({p: total(F.col("turns")[p], F.lit(0).cast("bigint")) for p in PARTS})
    blocks = _running(blocks, "conv", "k", PARTS)

    def key(upto: Column) -> Column:
        return F.struct(*[total(F.slice(F.col("turns")[p], 1, upto), F.col(f"{p}_before")).alias(p) for p in PARTS])

    return blocks.select("conv", "k", "length", F.struct(*[F.col(f"{p}_before").alias(p) for p in PARTS]).alias("before"),
                         F.transform("turns", lambda t, i: key(i + 1)).alias("keys"),
                         F.col("turns")["words"].alias("words"))


def _nodes(blocks: DataFrame) -> DataFrame:
    """key, parent, depth, words, n (members) and conv (the smallest) of every node but the root."""
    groups = written(blocks.groupBy("k", "before", F.element_at("keys", -1).alias("after")).agg(
        F.count(F.lit(1)).alias("n"), F.min("conv").alias("conv"), F.first("keys").alias("keys"),
        F.first("words").alias("words")), "trie-blocks-distinct")
    # first blocks follow the root, which all conversations share: they are taken as diverging unseen
    later = groups.filter("k > 0")
    alone = later.groupBy("before").agg((F.count(F.lit(1)) == 1).alias("alone"))
    later = later.join(alone, "before")
    groups = later.unionByName(groups.filter("k = 0").withColumn("alone", F.lit(False)))

    def cut(rows: DataFrame) -> DataFrame:
        return rows.select("k", "before", "keys", "words", "n", "conv", F.posexplode("keys").alias("j", "key")).select(
            "key", F.when(F.col("j") == 0, F.col("before")).otherwise(F.get("keys", F.col("j") - 1)).alias("parent"),
            (F.col("k") * BLOCK + F.col("j") + 1).alias("depth"), F.get("words", F.col("j")).alias("words"), "n", "conv")

    # siblings that diverge: the same turns may stand in several blocks
    apart = cut(groups.filter(~F.col("alone"))).groupBy("key", "parent", "depth", "words") \
        .agg(F.sum("n").alias("n"), F.min("conv").alias("conv"))
    return cut(groups.filter("alone")).unionByName(apart)


def _ends(blocks: DataFrame, members: DataFrame) -> DataFrame:
    """key and the SHA-256 of the ids of the conversations that end there."""
    spark = blocks.sparkSession
    last = blocks.filter(F.col("k") == F.floor((F.col("length") - 1) / BLOCK)) \
        .select(*[F.element_at("keys", -1)[p].alias(p) for p in PARTS], "conv")
    turnless = members.filter("length = 0").select(*[F.lit(0).cast("bigint").alias(p) for p in PARTS], "conv")
    parts = width(spark)

    def keyed(b: pa.RecordBatch, *others: str) -> Iterator[tuple]:
        return zip(zip(*[b.column(p).to_pylist() for p in PARTS], strict=True),
                   *[b.column(c).to_pylist() for c in others], strict=True)

    def out(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
        columns = list(zip(*[(*key, *rest) for key, *rest in rows], strict=True))
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string() if n in ("text", "sha") else pa.int64())
                                           for n, c in zip(names, columns, strict=True)], names)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, key, ids = [], None, []
            for k, conv in keyed(b, "conv"):
                if ids and (k != key or len(ids) == PIECE):
                    rows.append((key, ids[0], ",".join(map(str, ids))))
                    ids = []
                key = k
                ids.append(conv)
            if ids:
                rows.append((key, ids[0], ",".join(map(str, ids))))
            if rows:
                yield out(rows, [*PARTS, "first", "text"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = state = None
        for b in batches:
            rows = []
            for k, text in keyed(b, "text"):
                if k != key:
                    if state is not None:
                        rows.append((key, state.hexdigest()))
                    key, state = k, hashlib.sha256(text.encode())
                else:
                    state.update(("," + text).encode())
            if rows:
                yield out(rows, [*PARTS, "sha"])
        if state is not None:
            yield out([(key, state.hexdigest())], [*PARTS, "sha"])

    keys = ", ".join(f"{p} bigint" for p in PARTS)
    texts = last.unionByName(turnless).repartitionByRange(parts, *PARTS, "conv").sortWithinPartitions(*PARTS, "conv") \
        .mapInArrow(pieces, f"{keys}, first bigint, text string")
    return texts.repartition(parts, *PARTS).sortWithinPartitions(*PARTS, "first") \
        .mapInArrow(hashed, f"{keys}, sha string").select(F.struct(*PARTS).alias("key"), F.col("sha").alias("ends"))


def nodes(turns: DataFrame, members: DataFrame) -> DataFrame:
    """The trie's nodes: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = turns.sparkSession
    zero = F.lit(0).cast("bigint")
    blocks = written(_blocks(turns), "trie-blocks")
    members = written(members, "trie-members")
    found = written(_nodes(blocks), "trie-nodes")
    children = found.groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("n_children"))
    found = written(found.join(children, "key", "left").select(
        found["*"], F.coalesce("n_children", zero).alias("n_children"),
        F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("bigint").alias("leaf"),
        ((F.col("n") - 1) * F.col("words")).alias("saved")), "trie-nodes-children")

    # the rest of the owner's path
    sums = ["saved", "leaf"]
    paths = _running(found, "conv", "depth", sums, falling=True)
    # what an owner's path adds to the nodes above it
    owners = found.groupBy("conv").agg(*[F.sum(s).alias(s) for s in sums], (F.min("depth") - 1).alias("above")) \
        .filter("above > 0 and (saved > 0 or leaf > 0)")
    taken = F.greatest(F.lit(0), F.least(F.lit(BLOCK), F.col("above") - F.col("k") * BLOCK))
    shared = blocks.drop("length", "words").join(owners, "conv") \
        .withColumn("keys", F.slice("keys", F.lit(1), taken.cast("int")))
    passing = shared.filter(F.size("keys") > 0).groupBy("keys").agg(*[F.sum(s).alias(s) for s in sums]) \
        .select(F.explode("keys").alias("key"), *sums) \
        .groupBy("key").agg(*[F.sum(s).alias(f"{s}_passing") for s in sums])

    # one row: the root
    facts = members.agg(F.count(F.lit(1)).alias("n"), F.min("conv").alias("conv")).first()
    if not facts["n"]:
        return spark.createDataFrame([], "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, "
                                         "n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string")
    total = found.agg(F.sum("saved").alias("saved"), F.sum("leaf").alias("leaf"),
                      F.count_if(F.col("depth") == 1).alias("children")).first()
    below = paths.join(passing, "key", "left").select(
        "key", "parent", F.col("conv").alias("conv_id"), "depth", F.col("n").alias("n_convs"), "n_children",
        *[(F.col(s) + F.col(f"{s}_before") + F.coalesce(f"{s}_passing", zero)).alias(name)
          for s, name in (("leaf", "n_leaves"), ("saved", "saved_tokens"))])
    root = spark.range(1).select(
        F.struct(*[zero.alias(p) for p in PARTS]).alias("key"), F.lit(None).cast(found.schema["parent"].dataType).alias("parent"),
        *[F.lit(v).cast("bigint").alias(n) for n, v in (
            ("conv_id", facts["conv"]), ("depth", 0), ("n_convs", facts["n"]), ("n_children", total["children"]),
            ("n_leaves", total["leaf"] or 1), ("saved_tokens", total["saved"] or 0))])
    parents = found.select(F.col("key").alias("parent"), F.col("conv").alias("parent_conv_id"))
    return below.unionByName(root).join(_ends(blocks, members), "key", "left").join(parents, "parent", "left").select(
        "conv_id", "depth", F.when(F.col("depth") == 1, F.lit(facts["conv"])).otherwise(F.col("parent_conv_id"))
        .alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends", F.lit(EMPTY)).alias("ends_sha256"))


def contract_nodes(conversations: DataFrame) -> DataFrame:
    """The trie of the conversations rebuilt on shared heads."""
    return nodes(*with_shared_heads(conversations))
