import re

from lakeward.llm import op5_license, op10_url_filter

from llm_helpers import rows


def judge(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = re.split(r"[?#]", url.split("://", 1)[1], maxsplit=1)[0]
        host, _, path = rest.partition("/")
        path = "/" + path if "/" in rest else ""
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = [(h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = min(fit, key=lambda x: (-len(x[0]), x[1] != "block", x[0]), default=(None, "allow"))
    return host, path, best[0], best[1]


URLS = [None, "", "no scheme", "http://Example.NET/en/x", "http://a.example.net/en", "http://net", "http://x.net/?q=1",
        "https://badexample.com/de/", "https://WWW.example.com/de/1#t", "ftp://u@h.example.org:80/fr/", "http://org/fr/",
        "http://example.org/FR/", "http:///path", "x://é.net/ü", "http://a.b.c.d.example.net/en/x/y/z?x=http://q.org/fr/",
        "http://" + "a." * 500 + "net/" + "p/" * 3000, "http://example.net./en/", "http://line\nbreak.net/a"]


def test_url_rules(spark):
    pages = spark.createDataFrame([(k, u, "extra") for k, u in enumerate(URLS + URLS)] + [(None, URLS[3], "x")],
                                  "page_id bigint, url string, rule string")
    for rules in (op10_url_filter.BASE_RULES,
                  [("net", "/en", "block"), ("example.net", "", "allow"), ("", "/x", "block"), ("org", "/fr/", "allow")]):
        got = op10_url_filter.judge(pages, op10_url_filter.rules_frame(spark, rules))
        wanted = [(k, *judge(u, rules)) for k, u in enumerate(URLS + URLS)] + [(None, *judge(URLS[3], rules))]
        assert rows(got, "page_id", "host", "path", "rule", "verdict") == sorted(wanted, key=repr)
    assert op10_url_filter.judge(pages.limit(0), op10_url_filter.rules_frame(spark, rules)).collect() == []


def scan(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)

    def places(template):
        return [i for i in range(len(words) - template["span"] + 1)
                if all(words[i + o:i + o + len(k)] == k for o, k in template["keys"])]

    found = [(t, places(t)) for t in op5_license._templates()]
    base = [i for t, p in found if t["base"] for i in p]
    label = lambda which: ",".join(sorted({t["label"] for t, p in found if p and which(t)}))
    return (len(words), len(base), min(base, default=None), max(base, default=None), label(lambda t: t["base"]),
            label(lambda t: True), 1 - 0.5 ** sum(len(p) for _, p in found))


def test_license_scan(make_docs, edge_docs):
    mit = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this. "
           "All rights reserved. CC-BY cc by-sa")
    texts = [mit, "cc by cc by", "cc", "by", "the GNU General Public License and the Lesser general public  license",
             "gnu lesser general public license", "all rights", "ALL RIGHTS RESERVED. all rıghts reserved", "\u212a cc by",
             "x " * 50_000 + "cc by", "Licensed under the Apache License, Version 2.0", None, "", "cc\u00a0by cc0 1.0 universal"]
    items = [(k, t, "s") for k, t in enumerate(texts)] + [(1, texts[1], "s")] + edge_docs[0]
    got = op5_license.scan(make_docs(items))
    names = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    assert rows(got, *names) == sorted(((i, *scan(t)) for i, t, _ in items), key=repr)
    assert op5_license.scan(make_docs([])).collect() == []


def test_rarest_words_become_postings():
    t = [{"keys": [(0, ["the", "rare", "words", "the"])]}]
    assert op5_license.postings_of(t, {"the": 100, "rare": 1, "words": 5}) == [[("rare", 1), ("words", 2)]]


def test_only_key_phrases_decide(make_docs):
    """Words outside the key phrases may be missing from a text and rare or absent in the corpus."""
    other = "one two three four five six the mozilla public license"
    bsd = ("redistribution and use in source and binary forms x y z are permitted "
           "redistribution and use in source and binary forms with or without changes are permitted")
    texts = [other, other + " mozilla public license", bsd, "permission to use copy modify a b distribute this software x y z",
             "t i s free and unencumbered software a b c public domain"]
    common = "mozilla public license redistribution source binary forms permitted permission distribute software domain"
    for extra in ([], [common] * 5):
        items = [(k, t, "s") for k, t in enumerate(texts + extra)]
        got = op5_license.scan(make_docs(items))
        names = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
        want = sorted(((i, *scan(t)) for i, t, _ in items), key=repr)
        assert "mpl-2.0" in want[0][6]
        assert rows(got, *names) == want


def test_templates_hold_the_contract_and_their_own_texts(make_docs):
    assert op5_license.BASE_PHRASES == [("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")]
    # a text is found by its own template, and its plan does not grow with their number
    items = [(k, f"x {text}", "s") for k, (_, text, _) in enumerate(op5_license.TEMPLATES)]
    got = {r.doc_id: r.labels.split(",") for r in op5_license.scan(make_docs(items)).collect()}
    assert all(op5_license.TEMPLATES[k][0] in labels for k, labels in got.items())
    assert "gpl" in got[next(k for k, t in enumerate(op5_license.TEMPLATES) if t[0] == "gpl-notice")]


def test_many_places_of_one_word(make_docs):
    """Long files full of indexed words are looked up in time near proportion to their length."""
    texts = ["license public " * 30_000 + "general public license", "all rights " * 20_000 + "all rights reserved " * 2_000]
    items = [(k, t, "s") for k, t in enumerate(texts)]
    names = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    assert rows(op5_license.scan(make_docs(items)), *names) == sorted(((i, *scan(t)) for i, t, _ in items), key=repr)


def test_sql_twins(spark):
    import duckdb

    from lakeward.llm.oracles import oracle_sql
    from lakeward.llm.queries import queries

    con, sf = duckdb.connect(), "/root/testdata/sf0.001"
    for t in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    for name, sql in oracle_sql().items():
        got = queries()[name](spark, sf)
        cur = con.execute(sql)
        names = [d[0] for d in cur.description]
        assert sorted(names) == sorted(got.columns), name
        assert rows(got, *names) == sorted(cur.fetchall(), key=repr), name
