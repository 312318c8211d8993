"""Similarity join of documents on word n-grams with Bayesian candidate pruning.

Documents are sets of shingles of five words. Sets that agree are one *set class* with a weight
(copies are never compared with each other). Classes that agree in a band of their MinHash values
meet in a bucket; of buckets with the same members only the one of the smallest band is kept. In a
bucket, a pair's MinHash values are compared in steps: after each step a pair is dropped when the
posterior probability that its Jaccard similarity reaches the threshold (uniform prior) is below
the tolerance. What is left is verified exactly on the full shingle sets.

Scale: a bucket of m classes is cut into blocks of about 512 x 512 classes, each a group of rows of
its own, so no task sees a whole large bucket; pairs are enumerated inside a block in vector
operations and never become rows. A pair is handled only in the bucket of the first band in which
it agrees, so it counts once. Shingle sets, the bulky part, are made again from the text and only
for classes that have an unpruned pair. A block gives out, per member, the weight it is linked to,
and a spanning forest of its links; connected components come from alternating large-star and
small-star steps, each written to the shared folder.

Two sets of similarity s share no band with probability (1 - s**4)**24: 3e-6 at 0.8, 1e-11 at 0.9.

Defined edge cases: words are runs of letters, digits and underscores of the lower-cased text; a
text of one to four words is one shingle; a text without words (null, empty) is linked to nothing
and is a class of its own; a null doc_id takes part, and a class's id is its smallest doc_id that
is not null; repeated rows are copies; texts are shingled whole; empty tables give empty results;
extra columns are ignored by ``link_rows`` and carried by ``representatives``.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import give_back, packed, slices, text_or_empty, width, written

WORDS = 5
THRESHOLD = 0.8
TOLERANCE = 1e-6
BANDS, ROWS = 24, 4
HASHES = BANDS * ROWS
STEP = 16
#: Classes, and shingles of their texts, that a chunk of a large bucket holds on average (long texts
#: make chunks of fewer classes); a block verifies two chunks.
CHUNK, CHUNK_SHINGLES = 512, 400_000
#: Announces needed texts to the scan: at most 16**5 = 1,048,576 prefixes, whatever the input.
PREFIX_DIGITS = 5
REMEMBERED = 400_000

_WORD = re.compile(r"\w+")
_MULTIPLIERS = np.random.default_rng(7).integers(1, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_known: dict[str, int] = {}


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """The text's shingles as sorted distinct 64-bit numbers."""
    import xxhash

    found = _WORD.findall(text.lower())
    if not found:
        return np.zeros(0, np.uint64)
    if len(_known) > REMEMBERED:
        _known.clear()
    for w in set(found).difference(_known):
        _known[w] = xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"))
    h = np.fromiter(map(_known.__getitem__, found), np.uint64, len(found))
    n = max(1, len(h) - words + 1)
    out = np.full(n, min(len(h), words), np.uint64)
    for k in range(min(words, len(h))):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[k:k + n]
    out ^= out >> np.uint64(31)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(29)
    return np.unique(out)


def signature(found: np.ndarray) -> np.ndarray:
    """The set's MinHash values (32 bits each)."""
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), 4096):
        np.minimum(least, (found[at:at + 4096, None] * _MULTIPLIERS).min(axis=0), out=least)
    return (least >> np.uint64(32)).astype("<u4")


def least_matches(threshold: float, tolerance: float, hashes: int = HASHES, step: int = STEP) -> list[tuple[int, int]]:
    """(values compared, fewest matches that keep a pair): P(similarity >= threshold | matches) >= tolerance.

    With a uniform prior the posterior is Beta(m + 1, n - m + 1), whose upper tail at t is
    P(Binomial(n + 1, t) <= m).
    """
    out = []
    for n in range(step, hashes + 1, step):
        tail, m = 0.0, 0
        while True:
            tail += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if tail >= tolerance:
                break
            m += 1
        out.append((n, m))
    return out


def _signatures(docs: DataFrame, words: int) -> DataFrame:
    """Per row: doc_id, text_key, set_id (null without words), n, sig."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 4 << 20):
            sets = [shingles(t, words) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "text_key": batch.column("text_key"),
                "set_id": pa.array([hashlib.md5(s.tobytes()).digest() if len(s) else None for s in sets], pa.binary()),
                "n": pa.array([len(s) for s in sets], pa.int32()),
                "sig": pa.array([signature(s).tobytes() if len(s) else None for s in sets], pa.binary())})
        _known.clear()  # the worker lives on
        give_back()

    text = text_or_empty()
    return docs.select("doc_id", F.md5(text).alias("text_key"), text.alias("text")).mapInArrow(
        run, "doc_id bigint, text_key string, set_id binary, n int, sig binary")


def _blocks(classes: DataFrame) -> DataFrame:
    """(block, band, diagonal, chunk, set_id) of every class that shares a bucket."""
    keys = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.struct(
        b.alias("band"), F.xxhash64(b, F.substring(F.col("sig"), b * ROWS * 4 + 1, F.lit(ROWS * 4))).alias("key")))
    banded = classes.select("set_id", "n", F.inline(keys)).select("band", "key", "set_id", "n")
    buckets = banded.groupBy("band", "key").agg(
        F.count(F.lit(1)).alias("m"), F.sum("n").alias("shingles"), F.sum(F.xxhash64("set_id").cast("decimal(20,0)")).alias("s"),
        F.bit_xor(F.xxhash64("set_id", F.lit(1))).alias("x")).filter("m > 1")
    # of buckets with the same members, that of the smallest band: the one where their pairs first agree
    kept = buckets.groupBy("m", "s", "x").agg(
        F.min(F.struct("band", "key")).alias("b"), F.max("shingles").alias("shingles")).select(
        "b.band", "b.key", F.ceil(F.greatest(F.col("m") / CHUNK, F.col("shingles") / CHUNK_SHINGLES)).cast("int")
        .alias("chunks"))
    member = banded.join(kept, ["band", "key"]).withColumn(
        "chunk", F.pmod(F.xxhash64("set_id", F.lit(2)), F.col("chunks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other")
    low, high = F.least("chunk", "other"), F.greatest("chunk", "other")
    return member.select("band", "key", "set_id", "chunk", other).select(
        F.xxhash64("band", "key", low, high).alias("block"), "band", (F.col("chunk") == F.col("other")).alias("diagonal"),
        "chunk", "set_id")


def _groups(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.Table]:
    """Rows of one value of ``column`` together; the input is sorted by it."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        values = batch.column(column).to_numpy()
        cuts = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(values)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a == b:
                continue
            if held and held[-1].column(column)[0].as_py() != values[a]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _candidates(group: pa.Table, threshold: float, steps: list[tuple[int, int]]) -> Iterator[tuple[int, np.ndarray]]:
    """(i, others): the pairs of a block that the Bayesian test leaves; a pair comes once over all blocks."""
    n = group.column("n").to_numpy()
    sig = np.frombuffer(b"".join(group.column("sig").to_pylist()), "<u4").reshape(len(n), HASHES)
    chunk, band = group.column("chunk").to_numpy(), int(group.column("band")[0].as_py())
    diagonal = bool(group.column("diagonal")[0].as_py())
    order = np.argsort(n, kind="stable")
    sizes, sig, chunk = n[order], sig[order], chunk[order]
    for i in range(len(n) - 1):
        # sorted by size: similarity is at most the ratio of the sizes
        end = np.searchsorted(sizes, sizes[i] / threshold * (1 + 1e-9), side="right")
        at = np.arange(i + 1, end)
        if not diagonal:
            at = at[chunk[at] != chunk[i]]
        if not len(at):
            continue
        at = at[(sig[at, band * ROWS:(band + 1) * ROWS] == sig[i, band * ROWS:(band + 1) * ROWS]).all(axis=1)]
        if band and len(at):
            first = (sig[at, :band * ROWS] == sig[i, :band * ROWS]).reshape(len(at), band, ROWS).all(axis=2).any(axis=1)
            at = at[~first]
        matches, done = np.zeros(len(at), np.int64), 0
        for upto, least in steps:
            if not len(at):
                break
            matches = matches + (sig[at, done:upto] == sig[i, done:upto]).sum(axis=1)
            at, matches, done = at[matches >= least], matches[matches >= least], upto
        if len(at):
            yield order[i], order[at]


def _by_block(rows: DataFrame) -> DataFrame:
    return rows.repartition(width(rows.sparkSession), "block").sortWithinPartitions("block")


def _unpruned(blocks: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """The block members that have an unpruned pair there."""
    steps = least_matches(threshold, tolerance)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, "block"):
            seen = np.zeros(group.num_rows, bool)
            for i, others in _candidates(group, threshold, steps):
                seen[i] = True
                seen[others] = True
            if seen.any():
                yield from group.filter(pa.array(seen)).combine_chunks().to_batches()

    return _by_block(blocks).mapInArrow(run, blocks.schema)


def _verified(members: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """(a, b, links): a link of the block's spanning forest, or (b null) the weight that a is linked to."""
    steps = least_matches(threshold, tolerance)
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("links", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, "block"):
            ids, weight = group.column("set_id").to_pylist(), group.column("weight").to_numpy()
            sets = [np.frombuffer(x, "<u8") for x in group.column("shingles").to_pylist()]
            distinct, dense = np.unique(np.concatenate(sets), return_inverse=True)
            dense = np.split(dense, np.cumsum([len(s) for s in sets])[:-1])
            mark, links, parent = np.zeros(len(distinct), bool), np.zeros(len(ids), np.int64), list(range(len(ids)))
            rows: list[tuple] = []

            def root(x: int) -> int:
                while parent[x] != x:
                    parent[x] = x = parent[parent[x]]
                return x

            for i, others in _candidates(group, threshold, steps):
                mark[dense[i]] = True
                lengths = np.array([len(sets[j]) for j in others])
                hits = mark[np.concatenate([dense[j] for j in others])]
                both = np.add.reduceat(hits.astype(np.int64), np.concatenate([[0], np.cumsum(lengths)[:-1]]))
                mark[dense[i]] = False
                # in whole numbers where the threshold allows: both / union >= threshold
                linked = others[both >= threshold * (len(sets[i]) + lengths - both) - 1e-9]
                links[i] += weight[linked].sum()
                links[linked] += weight[i]
                for j in linked:
                    if (p := root(i)) != (q := root(j)):
                        parent[p] = q
                        rows.append((ids[i], ids[j], 0))
            rows += [(ids[k], None, int(links[k])) for k in np.flatnonzero(links)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                    zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

    return _by_block(members).mapInArrow(run, "a binary, b binary, links bigint")


def _sets(docs: DataFrame, needed: DataFrame, words: int) -> DataFrame:
    """(text_key, shingles) of the texts in ``needed`` (text_key)."""
    prefix = F.substring("text_key", 1, PREFIX_DIGITS).alias("prefix")
    text = text_or_empty()
    texts = docs.select(F.md5(text).alias("text_key"), text.alias("text")).withColumn("prefix", prefix) \
        .join(F.broadcast(needed.select(prefix).distinct()), "prefix", "left_semi") \
        .groupBy("text_key").agg(F.first("text").alias("text")).join(needed, "text_key", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 4 << 20):
            yield pa.RecordBatch.from_pydict({"text_key": batch.column("text_key"), "shingles": pa.array(
                [shingles(t, words).tobytes() for t in batch.column("text").to_pylist()], pa.binary())})
        _known.clear()
        give_back()

    return texts.select("text_key", "text").mapInArrow(run, "text_key string, shingles binary")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b): alternating large-star and small-star steps."""
    def star(e: DataFrame, small: bool) -> DataFrame:
        if small:  # every edge at its larger end
            e = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        else:
            e = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = e.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        e = e.join(least, "a")
        moved = e.filter("b <> m" if small else "b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        if small:
            moved = moved.unionByName(least.select("a", F.col("m").alias("b")))
        return moved.filter("a <> b").distinct()

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")),
                           F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())

    edges, before = written(edges.filter("a <> b").distinct(), "edges"), None
    while (now := state(edges)) != before and now[0]:
        before, edges = now, written(star(star(edges, False), True), "edges")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def link_table(docs: DataFrame, words: int = WORDS, threshold: float = THRESHOLD,
               tolerance: float = TOLERANCE) -> DataFrame:
    """Per row: doc_id, text_key, set_id, class_id, n_links."""
    rows = written(_signatures(docs, words), "signatures")
    classes = written(rows.filter("n > 0").groupBy("set_id").agg(
        F.count(F.lit(1)).alias("weight"), F.min("doc_id").alias("least_doc"),
        F.min(F.struct("text_key", "n", "sig")).alias("one")).select(
        "set_id", "weight", "least_doc", "one.*"), "set-classes")
    blocks = _blocks(classes).join(classes.select("set_id", "text_key", "n", "weight", "sig"), "set_id") \
        .select("block", "band", "diagonal", "chunk", "set_id", "text_key", "n", "weight", "sig")
    members = written(_unpruned(blocks, threshold, tolerance), "unpruned")
    sets = _sets(docs, members.select("text_key").distinct(), words)
    found = written(_verified(members.join(sets, "text_key"), threshold, tolerance), "links")
    links = found.filter("b is null").groupBy(F.col("a").alias("set_id")).agg(F.sum("links").alias("links"))
    labels = written(components(found.filter("b is not null").select("a", "b")), "components")
    named = labels.join(classes.select(F.col("set_id").alias("node"), "least_doc"), "node")
    ids = named.groupBy("root").agg(F.min("least_doc").alias("class_id"), F.min("node").alias("class_key"))
    of_set = (classes.select("set_id", "weight", "least_doc")
              .join(links, "set_id", "left")
              .join(labels.join(ids, "root").select(F.col("node").alias("set_id"), "class_id", "class_key"), "set_id",
                    "left")
              .select("set_id", F.when(F.col("class_key").isNull(), F.col("least_doc")).otherwise(F.col("class_id"))
                      .alias("class_id"), F.coalesce("class_key", "set_id").alias("class_key"),
                      (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links")))
    return rows.select("doc_id", "text_key", "set_id").join(of_set, "set_id", "left").select(
        "doc_id", "text_key", "class_key", F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(
            F.col("class_id")).alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"))


def link_rows(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, class_id (smallest doc_id of its connected class), n_links.

    n_links is the number of other rows whose similarity reaches the threshold, copies included.
    """
    return link_table(docs).select("doc_id", "class_id", "n_links")


def representatives(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay: per class the document with the smallest doc_id.

    Rows that agree in doc_id and text are one document. Documents without words stay.
    """
    def key(text_key: Column) -> Column:
        return F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), text_key)

    table = link_table(docs).select("doc_id", "class_key", key(F.col("text_key")).alias("key"))
    place = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "key")
    stays = table.filter("class_key is not null").groupBy("class_key").agg(F.min(place).alias("p")).select("p.key") \
        .unionByName(table.filter("class_key is null").select("key").distinct())
    rows = packed(docs, key=key(F.md5(text_or_empty())))
    return rows.dropDuplicates(["key"]).join(stays, "key", "left_semi").select("row.*")
