"""Approximate nearest neighbours with balanced posting lists.

Largest inner products become smallest distances by one more component, sqrt(M**2 - |x|**2) for a
row (M the largest norm) and 0 for a query. A bounded sample is split again and again in halves
until lists are of the wanted size; the halves' means, refined by a few k-means steps, are the
centroids, numbered so that neighbours have near numbers. A graph over the centroids stays in
memory and is searched best first, for many vectors at once. A vector goes to its nearest list and,
if it lies near a border, to others whose centroid is at most ``BORDER`` times as far (up to
``COPIES``). A query goes to the lists whose centroid is at most ``RATIO`` times as far as its
nearest one, and to more until they hold enough rows.

Lists are scored in cells of ``GROUP`` neighbouring lists. Cells with many rows or queries are
split by hash on both sides, so a cell is a bounded matrix product however hot a list is. Equal
vectors are one row with their smallest ids (one more than the neighbours asked for: no other can
be in an answer). The best of every cell are scored again in double precision on the original
vectors, in a fixed order of summation.

Defined edge cases: vectors that are null, empty, zero, or hold null or non-finite components take
no part, nor do rows with a null id; vectors of different lengths are searched each length by
itself; finite components of any size are searched (a product that overflows is infinite); rows that agree in id and vector are one; an empty table, or one
without valid queries, gives an empty result; with few rows all candidates are returned; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import width, written

NEIGHBOURS = 20
LIST = 128
MOST_LISTS = 8192
#: The centroids are fitted on at most so many numbers (vectors x components), those of smallest hash.
SAMPLE_VALUES = 1_000_000
COPIES, BORDER = 8, 1.1
RATIO = 1.13
#: Centroids asked of the graph at first; four times as many where these are all wanted.
BEAM = 64
#: Vectors longer than so many times the sample's 99th percentile are a list of their own.
FAR = 4.0
#: A query's lists hold at least so many rows per neighbour asked for.
LEAST_ROWS = 20
GROUP = 64
CELL_ROWS, CELL_QUERIES = 65_536, 16_384
DEGREE, ENTRIES = 24, 8


class Centroids:
    """Centroids with a neighbour graph that is searched best first."""

    def __init__(self, sample: np.ndarray, lists: int, rounds: int = 3):
        groups = [np.arange(len(sample))]
        while len(groups) < lists:
            groups = [half for g in groups for half in self._halves(sample, g)] if len(groups) * 2 <= lists \
                else self._split_largest(sample, groups, lists)
        c = np.stack([sample[g].mean(axis=0) for g in groups])
        for _ in range(rounds):
            # a list's share of the sample beyond its due makes it seem farther: keeps lists balanced
            near = self._nearest(sample, c, np.zeros(len(c)))
            load = np.bincount(near, minlength=len(c)) * len(c) / len(sample)
            near = self._nearest(sample, c, load)
            for k in range(len(c)):
                if (own := near == k).any():
                    c[k] = sample[own].mean(axis=0)
        self.c, self.norm = c, (c**2).sum(axis=1)
        near = np.concatenate([np.argsort(self._distances(c[at:at + 512], c), axis=1, kind="stable")[:, 1:DEGREE + 1]
                               for at in range(0, len(c), 512)])
        random = np.random.default_rng(3).integers(0, len(c), (len(c), 2))
        self.graph = np.concatenate([near, random], axis=1)
        self.entries = np.unique(np.linspace(0, len(c) - 1, min(ENTRIES, len(c))).astype(int))

    @staticmethod
    def _distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
        return np.maximum((x**2).sum(axis=1)[:, None] + (c**2).sum(axis=1) - 2 * x @ c.T, 0)

    @classmethod
    def _nearest(cls, x: np.ndarray, c: np.ndarray, load: np.ndarray) -> np.ndarray:
        return np.concatenate([(cls._distances(x[at:at + 2048], c) * (1 + 0.02 * load)).argmin(axis=1)
                               for at in range(0, len(x), 2048)])

    @staticmethod
    def _halves(sample: np.ndarray, g: np.ndarray) -> list[np.ndarray]:
        if len(g) < 2:
            return [g]
        x = sample[g] - sample[g].mean(axis=0)
        axis = x[np.argmax((x**2).sum(axis=1))]
        for _ in range(4):  # power iteration: the direction in which the group is widest
            axis = x.T @ (x @ axis)
            axis = axis / (np.linalg.norm(axis) or 1)
        order = np.argsort(x @ axis, kind="stable")
        return [g[order[:len(g) // 2]], g[order[len(g) // 2:]]]

    def _split_largest(self, sample: np.ndarray, groups: list[np.ndarray], lists: int) -> list[np.ndarray]:
        largest = set(sorted(range(len(groups)), key=lambda k: -len(groups[k]))[:lists - len(groups)])
        return [h for k, g in enumerate(groups) for h in (self._halves(sample, g) if k in largest else [g])]

    def search(self, x: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Per row of ``x`` about the ``beam`` nearest centroids and their distances, nearest first."""
        n, k = len(x), len(self.c)
        beam = min(beam, k)
        rows, size = np.arange(n)[:, None], (x**2).sum(axis=1)[:, None]

        def far(ids: np.ndarray) -> np.ndarray:
            return np.maximum(size + self.norm[ids] - 2 * np.einsum("nd,nkd->nk", x, self.c[ids]), 0)

        seen, opened = np.zeros((n, k), bool), np.zeros((n, k), bool)
        ids = np.repeat(self.entries[None], n, axis=0)
        seen[rows, ids] = True
        dist = far(ids)
        while True:
            state = np.where(opened[rows, ids], np.inf, dist)
            step = min(4, ids.shape[1])
            nxt = np.argpartition(state, step - 1, axis=1)[:, :step]
            live = np.isfinite(np.take_along_axis(state, nxt, 1))
            if not live.any():
                break
            here = np.take_along_axis(ids, nxt, 1)
            opened[rows, here] |= live
            new = self.graph[here].reshape(n, -1)
            fresh = ~seen[rows, new] & np.repeat(live, self.graph.shape[1], axis=1)
            seen[rows, np.where(fresh, new, ids[:, :1])] = True
            # the same neighbour may come twice in one step: the first counts
            order = np.argsort(new, axis=1, kind="stable")
            twice = np.zeros_like(fresh)
            ranked = np.take_along_axis(new, order, 1)
            np.put_along_axis(twice, order[:, 1:], ranked[:, 1:] == ranked[:, :-1], 1)
            d = np.where(fresh & ~twice, far(new), np.inf)
            ids, dist = np.concatenate([ids, new], axis=1), np.concatenate([dist, d], axis=1)
            if ids.shape[1] > beam:
                best = np.argpartition(dist, beam - 1, axis=1)[:, :beam]
                ids, dist = np.take_along_axis(ids, best, 1), np.take_along_axis(dist, best, 1)
        order = np.argsort(dist, axis=1, kind="stable")
        return np.take_along_axis(ids, order, 1), np.sqrt(np.take_along_axis(dist, order, 1))


def _valid(vectors: DataFrame, id_column: str, column: str) -> DataFrame:
    """(id, vec): rows that take part, components in double precision."""
    rows = vectors.select(F.col(id_column).cast("bigint").alias("id"), F.col(column).cast("array<double>").alias("vec"))
    odd = F.exists("vec", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    # -0.0 + 0.0 is 0.0: vectors that differ in the sign of a zero are equal
    rows = rows.filter("id is not null and vec is not null and size(vec) > 0").filter(~odd) \
        .filter(F.exists("vec", lambda v: v != 0)).withColumn("vec", F.transform("vec", lambda v: v + F.lit(0.0)))
    return rows.distinct()


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(len(column), -1)


def _as_binary(rows: DataFrame, schema: str, others: list[str]) -> DataFrame:
    """The array column ``vec`` as little-endian doubles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vecs = [np.asarray(v, "<f8").tobytes() for v in b.column("vec").to_pylist()]
            yield pa.RecordBatch.from_pydict({c: b.column(c) for c in others} | {"vec": pa.array(vecs, pa.binary())})

    return rows.select(*others, "vec").mapInArrow(run, schema)


def _may_be_best(near: np.ndarray, lengths: np.ndarray, asked: float, d: int, most: int) -> np.ndarray:
    """Which candidates can be among the ``most`` best in double precision (ties too), from their
    single-precision products, their lengths and the query's."""
    # components and products are rounded to 24 bits and d of them are summed; tiny ones may underflow
    error = (d + 4) * 2.0**-23 * lengths * asked + d * 2.0**-148 * (1 + lengths + asked)
    low, high = near - error, near + error
    # an overflown product tells nothing
    odd = ~np.isfinite(near) | ~np.isfinite(error)
    low[odd], high[odd] = -np.inf, np.inf
    return high >= np.partition(low, len(low) - most)[len(low) - most]


def _norms(x: np.ndarray) -> np.ndarray:
    """Lengths of rows of any finite numbers (squares of large ones overflow, of small ones vanish)."""
    most = np.abs(x).max(axis=1)
    with np.errstate(over="ignore"):
        return most * np.sqrt(((x / most[:, None])**2).sum(axis=1))


def search(vectors: DataFrame, is_query: Column, id_column: str = "vec_id", column: str = "embedding",
           neighbours: int = NEIGHBOURS) -> DataFrame:
    """Per query (rows for which ``is_query`` of ``id`` holds): query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    rows = written(_as_binary(_valid(vectors, id_column, column), "id bigint, vec binary", ["id"]), "vectors")
    # vectors of different lengths have no product: each length is a search of its own
    lengths = sorted(r["bytes"] for r in rows.select(F.length("vec").alias("bytes")).distinct().collect())
    found = [_search(rows.filter(F.length("vec") == n) if len(lengths) > 1 else rows, is_query, neighbours) for n in lengths]
    if not found:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    return reduce(DataFrame.unionByName, found)


def _search(rows: DataFrame, is_query: Column, neighbours: int) -> DataFrame:
    """The search among ``rows`` (id, vec), whose vectors have one length."""
    spark = rows.sparkSession
    # equal vectors: their smallest ids, one more than neighbours asked for; the rank filter is
    # applied before the shuffle too, so a very common vector leaves a few rows per task
    few = rows.withColumn("r", F.row_number().over(Window.partitionBy("vec").orderBy("id"))) \
        .filter(F.col("r") <= neighbours + 1)
    items = written(few.groupBy("vec").agg(F.array_sort(F.collect_list("id")).alias("ids")), "distinct-vectors")
    facts = items.agg(F.count(F.lit(1)).alias("n"), F.max(F.length("vec")).alias("bytes")).first()
    most = max(64, SAMPLE_VALUES // (facts["bytes"] // 8))
    sample = items.select("vec", F.xxhash64("vec").alias("h")).orderBy("h", "vec").limit(most).collect()
    sample = np.stack([np.frombuffer(r["vec"], "<f8") for r in sample])

    def norms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_pydict({"m": [float(_norms(_matrix(b.column("vec"))).max())]})

    largest = items.select("vec").mapInArrow(norms, "m double").agg(F.max("m")).first()[0]
    # a few vectors far longer than all others would shrink these to a point: they are a list of
    # their own, which every query reads
    radius = min(largest, FAR * float(np.quantile(_norms(sample), 0.99)))
    sample = sample[_norms(sample) <= radius]

    def lifted(x: np.ndarray) -> np.ndarray:
        x = x / radius
        return np.hstack([x, np.sqrt(np.maximum(1 - (x**2).sum(axis=1), 0))[:, None]])

    lists = int(max(1, min(MOST_LISTS, facts["n"] // LIST, len(sample) // 4)))
    shared = spark.sparkContext.broadcast(Centroids(lifted(sample), lists))  # at most MOST_LISTS centroids
    far_list = (lists // GROUP + 1) * GROUP if largest > radius else None

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                b = whole.slice(at, 1024)
                far = _norms(_matrix(b.column("vec"))) > radius
                if far.any():
                    own = b.filter(pa.array(far))
                    yield pa.RecordBatch.from_pydict({
                        "list": pa.array([far_list] * own.num_rows, pa.int32()),
                        "first": pa.array([True] * own.num_rows, pa.bool_()), "ids": own.column("ids"), "vec": own.column("vec")})
                    b = b.filter(pa.array(~far))
                if not b.num_rows:
                    continue
                ids, dist = shared.value.search(lifted(_matrix(b.column("vec"))), 3 * COPIES)
                ids, dist = ids[:, :COPIES], dist[:, :COPIES]
                row, k = np.nonzero(dist <= dist[:, :1] * BORDER + 1e-12)
                got = b.take(pa.array(row))
                yield pa.RecordBatch.from_pydict({
                    "list": pa.array(ids[row, k], pa.int32()), "first": pa.array(k == 0, pa.bool_()),
                    "ids": got.column("ids"), "vec": got.column("vec")})

    postings = written(items.select("ids", "vec").mapInArrow(
        assign, "list int, first boolean, ids array<bigint>, vec binary"), "postings")
    held = postings.filter(F.col("first") & (F.col("list") < lists)).groupBy("list").agg(F.count(F.lit(1)).alias("n")).collect()  # one row per list
    holds = np.zeros(lists, np.int64)
    for r in held:
        holds[r["list"]] = r["n"]
    enough = LEAST_ROWS * neighbours

    def _probed(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) of the lists that every row of ``x`` reads. The graph is searched for as many
        nearest centroids as it takes until one of them is not wanted any more."""
        rows_, lists_, left, beam = [], [], np.arange(len(x)), min(lists, BEAM)
        while len(left):
            ids, dist = shared.value.search(x[left], beam)
            # distances are to a point at distance of the largest norm: ratios as for rows
            before = np.cumsum(holds[ids], axis=1) - holds[ids]
            wanted = ((dist <= dist[:, :1] * RATIO + 1e-12) | (before < enough)) & np.isfinite(dist)
            done = ~wanted[:, -1] if beam < lists else np.ones(len(left), bool)
            row, k = np.nonzero(wanted[done])
            rows_.append(left[done][row])
            lists_.append(ids[done][row, k])
            left, beam = left[~done], min(lists, 4 * beam)
        if far_list is not None:
            rows_.append(np.arange(len(x)))
            lists_.append(np.full(len(x), far_list))
        return np.concatenate(rows_), np.concatenate(lists_)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                b = whole.slice(at, 256)
                x = _matrix(b.column("vec"))
                # a query longer than all lists asks by its direction
                x = x / np.maximum(radius, _norms(x))[:, None]
                row, lists_of = _probed(np.hstack([x, np.zeros((len(x), 1))]))
                got = pa.table({"id": pa.array(row), "group": pa.array(lists_of // GROUP, pa.int32()),
                                "list": pa.array(lists_of, pa.int32())}) \
                    .group_by(["id", "group"]).aggregate([("list", "list")])
                mine = b.take(got.column("id").combine_chunks())
                yield pa.RecordBatch.from_pydict({
                    "query_id": mine.column("id"), "group": got.column("group").combine_chunks(),
                    "lists": got.column("list_list").combine_chunks(), "qvec": mine.column("vec")})

    queries = written(rows.filter(is_query).select("id", "vec").mapInArrow(
        probe, "query_id bigint, group int, lists array<int>, qvec binary"), "probes")
    group = F.floor(F.col("list") / GROUP).cast("int").alias("group")
    split = (postings.groupBy(group).agg(F.ceil(F.count(F.lit(1)) / CELL_ROWS).alias("shards"))
             .join(queries.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / CELL_QUERIES).alias("parts")), "group"))
    split = written(split, "cells")

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1).cast("array<int>"))

    left = postings.withColumn("group", group).join(split, "group").select(
        "group", F.pmod(F.xxhash64("vec"), F.col("shards")).cast("int").alias("shard"), every("parts").alias("part"),
        "list", "ids", "vec")
    right = queries.join(split, "group").select(
        "group", every("shards").alias("shard"),
        F.pmod(F.xxhash64("query_id", "qvec"), F.col("parts")).cast("int").alias("part"), "query_id", "lists", "qvec")

    def score(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows) and len(asked):
            # the same vector in several lists of the cell is scored once
            code, first = np.unique(rows["vec"].to_numpy(object), return_inverse=True)
            x = np.frombuffer(b"".join(code), "<f8").reshape(len(code), -1)
            low = int(rows["list"].min())
            member = np.zeros((int(rows["list"].max()) - low + 1, len(code)), bool)
            member[rows["list"].to_numpy() - low, first] = True
            owner = np.zeros(len(code), np.int64)
            owner[first] = np.arange(len(rows))
            ids = rows["ids"].to_numpy()
            q = np.frombuffer(b"".join(asked["qvec"]), "<f8").reshape(len(asked), -1)
            names = asked["query_id"].to_numpy()
            with np.errstate(over="ignore"):
                single, asked_single = x.astype("float32"), q.astype("float32")
            length, asked_length = np.sqrt((x**2).sum(axis=1)), np.sqrt((q**2).sum(axis=1))
            for at in range(0, len(q), 256):
                with np.errstate(over="ignore", invalid="ignore"):
                    near = asked_single[at:at + 256] @ single.T
                for k, probed in enumerate(asked["lists"].iloc[at:at + 256]):
                    probed = np.asarray(probed) - low
                    probed = probed[(probed >= 0) & (probed < len(member))]
                    found = np.flatnonzero(member[probed].any(axis=0))
                    if len(found) > neighbours + 1:
                        found = found[_may_be_best(near[k, found], length[found], asked_length[at + k], x.shape[1],
                                                   neighbours + 1)]
                    exact = (x[found] * q[at + k]).sum(axis=1)
                    each = [ids[owner[f]] for f in found]
                    vec_id = np.concatenate([*each, np.zeros(0, np.int64)]).astype(np.int64)
                    value = np.repeat(exact, [len(e) for e in each])
                    other = vec_id != names[at + k]
                    vec_id, value = vec_id[other], value[other]
                    best = np.lexsort((vec_id, -value))[:neighbours]
                    out.append((np.full(len(best), names[at + k]), vec_id[best], value[best]))
        if not out:
            return pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"),
                                 "score": pd.Series(dtype="float64")})
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), map(np.concatenate, zip(*out, strict=True)),
                                     strict=True)))

    parts = width(spark)
    keys = ["group", "shard", "part"]
    found = left.repartition(parts, *keys).groupBy(*keys).cogroup(right.repartition(parts, *keys).groupBy(*keys)) \
        .applyInPandas(score, "query_id bigint, vec_id bigint, score double")
    place = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= neighbours) \
        .select("query_id", "rank", "vec_id", "score")
