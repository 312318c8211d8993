import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from lakeward.llm import op12_sharding as s

from llm_helpers import rows


def brute(items, shards=8):
    """(doc_id, size, crc, shard, slot) of (doc_id, text) by plain prefix sums."""
    def key(item):
        doc_id, text = item
        return hashlib.sha256((text or "").encode()).digest(), doc_id is not None, doc_id or 0

    items = sorted(items, key=key)
    sizes = [len((t or "").encode()) + 1 for _, t in items]
    total, before, slots, out = sum(sizes), 0, [0] * shards, []
    for (doc_id, text), size in zip(items, sizes, strict=True):
        shard = min(shards - 1, (2 * before + size) * shards // (2 * total))
        out.append((doc_id, size, zlib.crc32((text or "").encode()), "bytes", shard, slots[shard], None))
        slots[shard] += 1
        before += size
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]


def test_edge_documents(spark, edge_docs, make_docs):
    items, docs = edge_docs
    got = s.sharded(docs)
    assert rows(got, *COLUMNS) == brute([(i, t) for i, t, _ in items])
    assert dict(got.dtypes) == {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string",
                                "shard": "int", "slot": "bigint", "grown_shard": "int"}
    assert s.sharded(docs.limit(0)).collect() == []
    one = make_docs([(1, "only", "a")])
    assert rows(s.sharded(one), *COLUMNS) == brute([(1, "only")])


def test_hot_text_and_repeated_rows_are_balanced(spark, make_docs):
    """A third of all rows is one text, a sixth one repeated row: shards stay equal."""
    items = [(k, "the same text", "a") for k in range(400)] + [(None, "again", "b")] * 200 + \
        [(k, f"text {k} " * (k % 9 + 1), "c") for k in range(1000, 1600)]
    got = s.sharded(make_docs(items).repartition(5))
    assert rows(got, *COLUMNS) == brute([(i, t) for i, t, _ in items])
    bytes_ = [r.b for r in got.groupBy("shard").agg(F.sum("size").alias("b")).collect()]
    assert len(bytes_) == 8 and max(bytes_) - min(bytes_) <= 2 * max(len(t) + 1 for _, t, _ in items)


@pytest.mark.parametrize("shards", [1, 3, 50])
def test_any_number_of_shards_and_order(spark, make_docs, tmp_path, shards):
    items = [(k, "x" * (k % 13), "s") for k in range(300)]
    folder = f"{tmp_path}/shards"
    manifest = s.write_shards(make_docs(items), folder, shards, [F.col("doc_id")])
    got = s.read_shards(spark, folder).select("row.*", "size", "shard", "slot")
    sizes = [k % 13 + 1 for k in range(300)]
    want, slots = [], [0] * shards
    for k in range(300):
        shard = min(shards - 1, (2 * sum(sizes[:k]) + sizes[k]) * shards // (2 * sum(sizes)))
        want.append((k, "x" * (k % 13), shard, slots[shard]))
        slots[shard] += 1
    # contiguous in the given order, whole rows, gapless slots
    assert rows(got, "doc_id", "text", "shard", "slot") == sorted(want, key=repr)
    assert manifest.agg(F.sum("rows"), F.sum("bytes")).first()[:] == (300, sum(sizes))
    # a shard's runs are read from the files it names
    for run in manifest.collect():
        held = spark.read.parquet(run["file"]).filter(F.col("at").between(run["first"], run["first"] + run["rows"] - 1))
        assert held.count() == run["rows"] and held.agg(F.sum("size")).first()[0] == run["bytes"]


def test_given_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    items = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert rows(s.sharded(docs), *COLUMNS) == brute(items)
