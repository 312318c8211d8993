import itertools
import math
import random
import time
import zlib
from collections import Counter

import numpy as np
import pytest

from lakeward.llm import op4_toxicity as op4
from llm_helpers import rows

LEXICON = ["idiot", "moron", "worthless", "pathetic", "scum"]


@pytest.fixture(scope="module")
def model():
    r = random.Random(0)
    words = LEXICON * 40 + "the house stands on hill and people walk home slowly after work every day".split() * 60
    words += ["".join(r.choice("aeioulnrst") for _ in range(r.randint(3, 8))) for _ in range(300)]
    from collections import Counter

    counts = Counter()
    for w in words:
        w = "  " + w + " "
        for k in range(len(w) - 2):
            counts[w[k:k + 3]] += 1
    return op4.CharacterModel(counts)


@pytest.mark.parametrize("token,word", [
    ("1d10t", "idiot"), ("m0r0n", "moron"), ("w0rthl3$$", "worthless"), ("p@th3tic", "pathetic"), ("s.c.u.m", "scum"),
    ("idiooooot", "idiot"), ("scum!!!", "scum"), ("house", "house"), ("\"home,\"", "home")])
def test_restored(model, token, word):
    assert op4.words_of_token(token, model) == [word]


def test_spaced_runs(model):
    assert "idiot" in list(op4.spaced_words("you i d i o t there", model))
    assert "moron" in list(op4.spaced_words("m 0 r 0 n", model))
    assert list(op4.spaced_words("a b here", model)) == []
    assert op4.words_of_token("12345", model) == [] and op4.words_of_token("---", model) == []


@pytest.mark.parametrize("token,word", [
    ("!d!ot", "idiot"), ("!d!ot!", "idiot"), ("(um", "um"), ("$(um", "scum"), ("+he", "the"), ("(house", "house"),
    ("house!", "house"), ("house!!", "house"), ("m0r0n!", "moron"), ("(m0r0n)", "moron"), ("|d|ot", "idiot"),
    ("\"(scum!\"", "scum")])
def test_signs_at_the_edges_may_be_letters(model, token, word):
    assert op4.words_of_token(token, model) == [word]


def test_words_joined_by_signs_stay_apart(model):
    assert op4.words_of_token("hill-scum!", model) == ["hill", "scum"]
    assert op4.words_of_token("(scum/hill", model) == ["scum", "hill"]


def test_signs_and_digits_alone_are_read(model):
    counts = op4.Counter(model.counts)
    counts.update({"  a": 40, " as": 40, "ass": 40, "ss ": 40})
    more = op4.CharacterModel(counts)
    assert op4.words_of_token("@$$", more) == ["ass"] and op4.words_of_token("4$$!", more) == ["ass"]
    for number in ("12345", "$12.50", "10:30", "(555)", "+49", "2024-01-15", "100!", "---", "!!!", "|"):
        assert op4.words_of_token(number, more) == [], number


@pytest.mark.parametrize("text", ["s c u m.", "(s c u m)", "s  c  u  m", "s\tc\tu\tm", "s\nc\r\nu m", "you s c u m, go",
                                  "_s c u m_", "'s c u m'", "$ c u m!", "go:s c u m's", "s\u00a0c u m"])
def test_spaced_runs_end_at_punctuation(model, text):
    assert "scum" in list(op4.spaced_words(text, model))


def labelled(spark, make_docs, n=1500, seed=1):
    r = random.Random(seed)
    plain = "the house stands on hill and people walk home slowly after work every day in town with many friends".split()
    disguise = {"idiot": "1d10t", "moron": "m0r0n", "scum": "$cum", "pathetic": "p@thetic", "worthless": "worthle$$"}
    items, marks = [], []
    for k in range(n):
        w = [r.choice(plain) for _ in range(r.randint(5, 60))]
        toxic = r.random() < 0.2
        if toxic:
            bad = r.choice(LEXICON)
            w.insert(r.randrange(len(w)), disguise[bad] if r.random() < 0.3 else bad)
        items.append((k, " ".join(w), "s"))
        marks.append((k, 1, int(toxic)))
    return items, marks, make_docs(items), spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int")


def test_held_out_rows_are_predicted(spark, make_docs):
    items, marks, docs, labels = labelled(spark, make_docs)
    got = {r.doc_id: r for r in op4.scores(docs, labels).collect()}
    truth = {i: t for i, _, t in marks}
    assert len(got) == len(items)
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    tested = [i for i in got if got[i].held_out]
    assert sum(got[i].predicted == truth[i] for i in tested) >= 0.98 * len(tested)
    kept = op4.clean(docs, labels)
    assert kept.columns == docs.columns
    assert rows(kept, "doc_id") == sorted(((i,) for i, r in got.items() if not r.predicted), key=repr)


def test_held_out_labels_are_never_read(spark, make_docs):
    items, marks, docs, labels = labelled(spark, make_docs, 400)
    flipped = spark.createDataFrame([(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in marks],
                                    "doc_id bigint, quality int, toxic int")
    assert rows(op4.scores(docs, labels), "doc_id", "score") == rows(op4.scores(docs, flipped), "doc_id", "score")


def test_edge_cases(spark, edge_docs, make_docs):
    items, docs = edge_docs
    labels = spark.createDataFrame([(1, 1, 1), (3, None, 0), (None, 1, 1), (4, 1, None), (4, 1, 0), (4, 1, 1)],
                                   "doc_id bigint, quality int, toxic int")
    got = op4.scores(docs, labels).collect()
    assert sorted((r.doc_id or -1) for r in got) == sorted((i or -1) for i, _, _ in items)
    assert all(0 <= r.score <= 1 for r in got)
    none = op4.scores(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.0}
    assert op4.scores(make_docs([]), labels).collect() == []


def enumerated(token, model, spaced):
    """The cheapest of all readings of a token, every one of them tried."""
    best = (float("inf"), "")
    for path in itertools.product(*op4._options(token)):
        for ends in itertools.product((False, True), repeat=len(path) if spaced else 0):
            state, cost, text = "  ", 0.0, ""
            for k, (reading, extra) in enumerate(path):
                cost += extra
                for c in reading:
                    cost += model.cost(state, op4.symbol(c))
                    state, text = state[1] + op4.symbol(c), text + c
                if spaced and ends[k] and reading:
                    cost += model.cost(state, " ") + op4.WORD_END
                    state, text = "  ", text + " "
            cost += 0 if state[1] == " " else model.cost(state, " ")
            best = min(best, (cost, text))
    return best


@pytest.mark.parametrize("spaced", [False, True])
def test_viterbi_finds_the_cheapest_of_all_readings(model, spaced):
    r = random.Random(21)
    for _ in range(60):
        token = "".join(r.choice("ids1!0o3@.-u") * r.choice((1, 1, 1, 3)) for _ in range(r.randint(1, 4)))[:6]
        cost, text = op4.decoded(token, model, spaced)
        least, _ = enumerated(token, model, spaced)
        assert cost == pytest.approx(least, rel=1e-12), token


def test_long_tokens_take_time_in_proportion(model):
    def seconds(n):
        began = time.process_time()
        op4.decoded("1d10t" * n, model)
        return time.process_time() - began

    seconds(2000)
    assert seconds(32_000) < 30 * max(seconds(2000), 0.01)


def test_decision_list_against_a_plain_loop():
    r = random.Random(22)
    for _ in range(20):
        names = [f"f{k}" for k in range(12)]
        rows_ = [sorted(r.sample(range(12), r.randint(0, 5))) for _ in range(120)]
        toxic = [r.random() < (0.9 if 3 in row or 7 in row else 0.1) for row in rows_]
        got, rest = op4.decision_list(names, [np.array(x, np.int32) for x in rows_], np.array(toxic))
        # the rule with the largest gain first, on the rows that no earlier rule covers
        left, want = list(range(len(rows_))), {}
        telling = {f for f in range(12) if sum(toxic[k] for k in left if f in rows_[k]) >= sum(not toxic[k] for k in left if f in rows_[k])}
        while left:
            base = sum(toxic[k] for k in left) / len(left)
            if not 0 < base < 1:
                break

            def gain(f):
                pos, neg = (sum(toxic[k] == t for k in left if f in rows_[k]) for t in (True, False))
                p = pos / max(1, pos + neg)
                if f not in telling or p < 0.5:
                    return 0.0
                return (pos * math.log(p / base) if pos else 0) + (neg * math.log((1 - p) / (1 - base)) if neg else 0)

            best = max(range(12), key=lambda f: (gain(f), -f))
            if gain(best) < math.log(12 / op4.SIGNIFICANCE):
                break
            pos, neg = (sum(toxic[k] == t for k in left if best in rows_[k]) for t in (True, False))
            want[names[best]] = (pos + 0.5) / (pos + neg + 1)
            left = [k for k in left if best not in rows_[k]]
        assert got == pytest.approx(want) and list(got) == list(want)
        assert rest == pytest.approx((sum(toxic[k] for k in left) + 0.5) / (len(left) + 1) if left else 0.5)


def test_trigram_counts_against_a_plain_loop():
    r = random.Random(23)
    words = {"".join(r.choice("abzé日ßZ'1!-") for _ in range(r.randint(0, 7))): r.randint(1, 9) for _ in range(500)}
    want = Counter()
    for word, n in words.items():
        word = op4.EDGE.sub("", word)
        if op4.PLAIN.fullmatch(word):
            w = "  " + "".join(map(op4.symbol, word)) + " "
            for k in range(len(w) - 2):
                want[w[k:k + 3]] += n
    assert op4.trigram_counts(words) == want
    assert op4.trigram_counts({}) == {} and op4.trigram_counts({"!!": 3}) == {}
