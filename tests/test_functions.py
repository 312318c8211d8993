from pyspark.sql import functions as F

from lakeward.functions import text as tx
from lakeward.functions.similarity_udf import jaro_winkler


def test_normalize_text_edges(spark):
    df = spark.createDataFrame(
        [(None,), ("",), ("  ",), ("St. John's--Park",), ("Café  Zürich",), ("a\tb   c",)], "s string")
    out = [r[0] for r in df.select(tx.normalize_text("s")).collect()]
    assert out == [None, "", "", "ST JOHN S PARK", "CAF Z RICH", "A B C"]


def test_lev_similarity_and_confidence_null_paths(spark):
    df = spark.createDataFrame(
        [("ABC", "ABD"), ("", ""), (None, "X"), (None, ""), (None, None), ("A", "")], "a string, b string")
    sim = tx.lev_similarity("a", "b")
    tm = tx.token_match(tx.first_token("a"), tx.first_token("b"))
    rows = df.select(sim.alias("s"), tx.match_confidence(sim, tm).alias("c"),
                     tx.decision(tx.match_confidence(sim, tm), 0.95, 0.80).alias("d")).collect()
    assert rows[0].s == 0.6667 and rows[0].c == 0.6 and rows[0].d == "REJECT"
    assert rows[1].s == 0.0 and rows[1].c == 0.1 and rows[1].d == "REJECT"  # both empty
    assert rows[2].s is None and rows[2].c is None and rows[2].d == "REJECT"  # NULL side
    assert rows[3].s == 0.0  # greatest() skips the NULL length, max length 0
    assert rows[4].s is None
    assert rows[5].s == 0.0


def test_decision_bounds_inclusive(spark):
    df = spark.createDataFrame([(0.95,), (0.8,), (0.7999,), (None,)], "c double")
    out = [r[0] for r in df.select(tx.decision("c", 0.95, 0.80)).collect()]
    assert out == ["AUTO_MERGE", "STEWARD_REVIEW", "REJECT", "REJECT"]


def test_keys(spark):
    df = spark.createDataFrame([("Queens", "Astoria"), (None, "X"), (" q ", None)], "b string, z string")
    out = df.select(tx.concat_key(tx.normalize_text("b"), tx.normalize_text("z")).alias("k"),
                    tx.declared_key("b", "z").alias("d")).collect()
    assert out[0].k == "QUEENS::ASTORIA" and out[0].d == "QUEENS::ASTORIA"
    assert out[1].k == "X" and out[1].d is None  # concat_ws skips NULL, || does not
    assert out[2].k == "Q" and out[2].d is None


def test_jaro_winkler_reference_values():
    assert round(jaro_winkler("MARTHA", "MARHTA"), 4) == 0.9611
    assert round(jaro_winkler("DIXON", "DICKSONX"), 4) == 0.8133
    assert jaro_winkler("", "") == 0.0 and jaro_winkler("A", "A") == 1.0
    assert jaro_winkler(None, "A") is None


def test_text_to_int_reads_ids_like_the_lenient_cast(spark):
    from lakeward.functions.casts import text_to_int

    cases = [("1", 1), ("1.0", 1), ("-7.9", -7), (" 42 ", 42), ("+5", 5), (".", 0), ("5.", 5),
             ("N/A", None), ("", None), ("-", None), ("1e3", None), ("2147483647", 2147483647),
             ("2147483648", None), ("-2147483648.5", -2147483648), (None, None)]
    df = spark.createDataFrame([(t,) for t, _ in cases], "t string")
    got = [r.v for r in df.select(text_to_int(F.col("t")).alias("v")).collect()]
    assert got == [v for _, v in cases]
