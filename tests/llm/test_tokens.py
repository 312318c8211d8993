import random
import struct
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from lakeward.llm import op7_token_records, op8_packing
from lakeward.llm.tokens import WordEncoder
from lakeward.session import scratch_path

from llm_helpers import rows

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")


def plain(path, texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    return [t.encode(x, add_special_tokens=False).ids for x in texts]


@pytest.mark.parametrize("path,kept", [(WORD, False), (BYTE, True)])
def test_word_by_word_is_the_library(path, kept):
    r = random.Random(9)
    alphabet = ["a", "B", "ß", "é", "e\u0301", "1", "'", "s", "'s", "!", " ", " ", " ", "\n", "  ", "\t", "\x1c", "\u00a0", "\u3000",
                "日本", "<|endoftext|>", "\U0001f600", "\u212b", "Σ", "\r\n", "\x00", "\u0301"]
    texts = ["".join(r.choice(alphabet) for _ in range(r.randint(0, 40))) for _ in range(4000)]
    texts += ["", " ", "\n", "\n\n\n", " a", "a ", "a\nb", "a \nb", "a\n b", "it's 'tis <|endoftext|> x<|startoftext|>y"]
    got = WordEncoder(path, kept).encode(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == plain(path, texts)


def test_records_round_trip(edge_docs, make_docs, spark):
    items, docs = edge_docs
    folder = scratch_path(spark, "records")
    manifest = op7_token_records.write_records(docs, WORD, 2, folder, partitions=3)
    ids = {i: x + [2] for i, x in enumerate(plain(WORD, [t or "" for _, t, _ in items]))}
    got = op7_token_records.read_records(spark, folder).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted((i for i, _, _ in items), key=lambda i: (i is not None, i or 0))
    start = 0
    for r in got:
        assert r.start == start
        start += r.n_tokens
    crc = lambda x: zlib.crc32(np.array(x, "<u4").tobytes())
    assert sorted((r.doc_id or -1, r.n_tokens, r.ids_crc32) for r in got) == sorted(
        (i or -1, len(ids[k]), crc(ids[k])) for k, (i, _, _) in enumerate(items))
    assert manifest.agg(F.sum("ids")).first()[0] == start
    shuffled = op7_token_records.read_shuffled(spark, folder, 1).collect()
    assert sorted((r.doc_id or -1, tuple(r.ids)) for r in shuffled) == sorted(
        (i or -1, tuple(ids[k])) for k, (i, _, _) in enumerate(items))
    assert [r.position for r in shuffled] != [r.position for r in op7_token_records.read_shuffled(spark, folder, 2).collect()]
    assert op7_token_records.digest(make_docs([]), WORD).collect() == []


def test_damaged_records_are_found():
    import io

    whole = op7_token_records.frame(op7_token_records.pack_payload(7, struct.pack("<2I", 5, 2)))
    assert op7_token_records.unpack_payload(op7_token_records.read_frame(io.BytesIO(whole))) == (7, struct.pack("<2I", 5, 2))
    wide = struct.pack("<2I", 70_000, 2)
    assert op7_token_records.unpack_payload(op7_token_records.pack_payload(None, wide)) == (None, wide)
    assert op7_token_records.unpack_payload(op7_token_records.pack_payload(3, b"")) == (3, b"")
    for k in range(len(whole)):
        broken = bytearray(whole)
        broken[k] ^= 1
        with pytest.raises(ValueError):
            op7_token_records.read_frame(io.BytesIO(bytes(broken)))
    for cut in (3, 11, 14, len(whole) - 1):
        with pytest.raises(ValueError):
            op7_token_records.read_frame(io.BytesIO(whole[:cut]))


def check_packing(items, got, most_padding):
    ids = defaultdict(list)
    for (i, t, _), x in zip(items, plain(BYTE, [t or "" for _, t, _ in items]), strict=True):
        ids[i].append(x + [1])
    sequences, seen = defaultdict(list), defaultdict(list)
    for r in got:
        assert 1 <= r.length <= 2048
        sequences[r.sequence_id].append(r)
        seen[r.doc_id].append(r)
        assert any(len(x) == r.doc_tokens and zlib.crc32(np.array(x[r.start:r.start + r.length], "<u4").tobytes())
                   == r.ids_crc32 for x in ids[r.doc_id])
    used = padding = 0
    for pieces in sequences.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 2048
        used += at
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    assert used == sum(len(x) for xs in ids.values() for x in xs)
    for i, pieces in seen.items():
        if len(ids[i]) == 1:
            at = 0
            for p in sorted(pieces, key=lambda p: p.start):
                assert p.start == at
                at += p.length
            assert at == len(ids[i][0])
    assert padding <= most_padding * used


def test_packing_edge_cases(edge_docs, make_docs):
    items, docs = edge_docs
    check_packing(items, op8_packing.pack(docs, BYTE).collect(), 0.02)
    assert op8_packing.pack(make_docs([]), BYTE).collect() == []


def test_packing_many_documents(make_docs):
    r = random.Random(4)
    items = [(k, " ".join(["word"] * r.choice([1, 5, 40, 300, 700, 1023, 1500, 2047, 2048, 9000])), "s") for k in range(600)]
    docs = make_docs(items).repartition(5)
    got = op8_packing.pack(docs, BYTE)
    check_packing(items, got.collect(), 0.01)
    assert rows(got, "doc_id", "start", "length") == rows(got, "doc_id", "start", "length")


def test_classes_hold_a_fixed_number():
    p = op8_packing.Packer(0, capacity=64, slack=0.0)
    for n in range(1, 200):
        lengths = list(p.lengths(n))
        assert sum(lengths) == n and all((64 // x) * x == 64 for x in lengths if 64 % x == 0)
