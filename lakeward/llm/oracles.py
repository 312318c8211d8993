"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations


OP9 = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))"""

# CRC-32 step by step: the table of the 256 byte steps, and the checksum of a list of bytes
_CRC_TABLE = """
crc_table AS (
  SELECT list(v ORDER BY i) AS steps FROM (
    SELECT i, list_reduce(range(8), lambda a, k: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, i) AS v
    FROM range(256) t(i)))"""


def _crc(steps_over: str) -> str:
    return (f"xor(list_reduce({steps_over}, lambda a, b: xor(a >> 8, steps[xor(a % 256, b) + 1]), 4294967295), "
            "4294967295)")


def _codes(text: str) -> str:
    return f"list_transform(range(1, length({text}) + 1), lambda i: CAST(ascii(substr({text}, i, 1)) AS BIGINT))"


OP12 = f"""
WITH {_CRC_TABLE},
docs AS (SELECT doc_id, coalesce(text, '') AS text, octet_length(encode(coalesce(text, '')))::BIGINT + 1 AS size FROM documents),
summed AS (SELECT *, sum(size) OVER () AS total,
    sum(size) OVER (ORDER BY sha256(text), doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING) - size AS before FROM docs),
dealt AS (SELECT *, CAST(least(7, ((2 * before + size) * 8) // (2 * total)) AS INTEGER) AS shard FROM summed),
hexed AS (SELECT *, string_split(hex(encode(text)), '') AS digits FROM dealt),
coded AS (SELECT *, list_transform(range(size - 1), lambda i: strpos('0123456789ABCDEF', digits[2 * i + 1]) * 16
                                   + strpos('0123456789ABCDEF', digits[2 * i + 2]) - 17) AS bytes FROM hexed)
SELECT doc_id, size, {_crc('bytes')} AS text_crc32, 'bytes' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY before) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM coded, crc_table"""

OP13 = rf"""
WITH {_CRC_TABLE},
own AS (SELECT conv_id AS c, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}}
               ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
        FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
heads AS (SELECT c, turns, CAST({_crc(_codes('CAST(c AS VARCHAR)'))} % 4 AS BIGINT) AS h FROM own, crc_table),
rebuilt AS (SELECT a.c, list_concat(coalesce(b.turns[1:a.h], []), a.turns[a.h + 1:]) AS turns
            FROM heads a LEFT JOIN own b ON b.c = a.c - a.c % 20),
prefixes AS (SELECT c, len(turns) AS n, turns, unnest(range(0, len(turns) + 1)) AS d FROM rebuilt),
nodes AS (SELECT turns[1:d] AS seq, d, min(c) AS conv_id, count(*) AS n_convs,
                 sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE n = d), '')) AS ends_sha256,
                 (count(*) - 1) * CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(turns[d]['t'], '[^\x20\x09-\x0D]+')) END AS saved
          FROM prefixes GROUP BY turns[1:d], d, turns[d]['t']),
children AS (SELECT seq[1:d - 1] AS seq, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY seq[1:d - 1]),
full_nodes AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (seq)),
up AS (SELECT saved, n_children = 0 AS leaf, seq, unnest(range(0, d + 1)) AS upto FROM full_nodes),
sums AS (SELECT seq[1:upto] AS seq, sum(saved) AS saved_tokens, count(*) FILTER (WHERE leaf) AS n_leaves FROM up GROUP BY seq[1:upto])
SELECT v.conv_id, v.d AS depth, p.conv_id AS parent_conv_id, v.n_convs, v.n_children, s.n_leaves,
       CAST(s.saved_tokens AS BIGINT) AS saved_tokens, v.ends_sha256
FROM full_nodes v JOIN sums s ON s.seq = v.seq LEFT JOIN nodes p ON v.d > 0 AND p.d = v.d - 1 AND p.seq = v.seq[1:v.d - 1]"""


def _op10() -> str:
    # the rules as the contract states them
    rules = "('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')"
    return rf"""
WITH rules(rule_host, rule_path, rule_verdict) AS (VALUES {rules}),
urls AS (
  SELECT row_number() OVER () AS row_id, page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
fitting AS (
  SELECT row_id, rule_host || rule_path AS rule, rule_verdict,
         row_number() OVER (PARTITION BY row_id ORDER BY length(rule_host || rule_path) DESC,
                            rule_verdict <> 'block', rule_host || rule_path) AS place
  FROM urls JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT page_id, host, path, rule, coalesce(rule_verdict, 'allow') AS verdict
FROM urls LEFT JOIN fitting ON urls.row_id = fitting.row_id AND place = 1"""


# the contract's phrases and labels, and the other licenses' key phrases with their distances
_LICENSES = [
    ("cc-by", [(0, "cc by")]), ("gpl", [(0, "general public license")]), ("reserved", [(0, "all rights reserved")]),
    ("mit", [(0, "permission is hereby granted"), (4, "free of charge"), (8, "any person obtaining a copy")]),
    ("apache-2.0", [(0, "licensed under the apache license"), (5, "version 2 0")]),
    ("bsd", [(0, "redistribution and use in source and binary forms"), (12, "are permitted")]),
    ("isc", [(0, "permission to use copy modify"), (7, "distribute this software")]),
    ("gpl-notice", [(0, "this program is free software"), (5, "you can redistribute it"),
                    (18, "gnu general public license")]),
    ("lgpl", [(0, "gnu lesser general public license")]), ("agpl", [(0, "gnu affero general public license")]),
    ("mpl-2.0", [(0, "mozilla public license")]), ("epl", [(0, "eclipse public license")]),
    ("cc0", [(0, "cc0 1 0 universal")]), ("cc-by-sa", [(0, "cc by sa")]), ("cc-by-nc", [(0, "cc by nc")]),
    ("cc-attribution", [(0, "creative commons attribution")]),
    ("boost", [(0, "any person or organization obtaining a copy"), (13, "covered by this license")]),
    ("zlib", [(0, "this software is provided as is without any express or implied"),
              (12, "in no event will the authors be held liable")]),
    ("unlicense", [(0, "free and unencumbered software"), (7, "public domain")]),
]
_BASE_LICENSES = ("cc-by", "gpl", "reserved")


def _op5() -> str:
    def at(offset: int, phrase: str) -> str:
        return " AND ".join(f"w[i + {offset + k + 1}] = '{x}'" for k, x in enumerate(phrase.split()))

    columns = []
    for k, (_, keys) in enumerate(_LICENSES):
        span = max(o + len(p.split()) for o, p in keys)
        test = " AND ".join(at(o, p) for o, p in keys)
        columns.append(f"list_filter(range(CAST(len(w) AS BIGINT) - {span - 1}), lambda i: {test}) AS t{k}")
    every = range(len(_LICENSES))
    base = " || ".join(f"t{k}" for k in every if _LICENSES[k][0] in _BASE_LICENSES)
    both = " || ".join(f"t{k}" for k in every)

    def labels(which) -> str:
        cases = ", ".join(f"CASE WHEN len(t{k}) > 0 THEN '{_LICENSES[k][0]}' END" for k in every if which(_LICENSES[k][0]))
        return f"coalesce(array_to_string(list_sort(list_distinct(list_filter([{cases}], lambda x: x IS NOT NULL))), ','), '')"

    return rf"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
found AS (SELECT doc_id, len(w) AS n, {', '.join(columns)} FROM words)
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(len({base}) AS BIGINT) AS n_base,
       CAST(list_min({base}) AS BIGINT) AS first_word, CAST(list_max({base}) AS BIGINT) AS last_word,
       {labels(lambda t: t in _BASE_LICENSES)} AS base_labels, {labels(lambda t: True)} AS labels,
       1.0::DOUBLE - pow(0.5::DOUBLE, len({both})) AS score
FROM found"""


def oracle_sql() -> dict[str, str]:
    return {"op5_license_scan": _op5(), "op9_stream_dedup_rows": OP9, "op10_url_verdicts": _op10(),
            "op12_byte_shards": OP12, "op13_prefix_trie_nodes": OP13}
