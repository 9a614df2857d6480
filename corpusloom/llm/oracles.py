"""DuckDB SQL of the queries of problems 4 to 9 that SQL can express on whole tables."""

from __future__ import annotations

from .leakage import PASSAGE
from .queries import BEST, CHUNK_CHARS, SEQUENCE, SIMILARITY, WEIGHTED_SEQUENCE, WEIGHTED_SIMILARITY, WINDOW_TOKENS

_TRIM = r"E' \t\n\r'"


def _number(c: str) -> str:
    return f"TRY_CAST(nullif(regexp_extract({c}, '[0-9]+'), '') AS BIGINT)"


_P4 = f"""WITH t AS (SELECT 'abstract' AS src, record_id AS id, abstract AS text FROM pubmed_complete_metadata UNION ALL SELECT 'chunk', chunk_id, text FROM literature_chunk),
w AS (SELECT src, id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') AS w FROM t WHERE text IS NOT NULL),
s AS (SELECT DISTINCT src, id, unnest(list_transform(generate_series(1, len(w) - {SEQUENCE - 1}), lambda i: array_to_string(w[i:i + {SEQUENCE - 1}], ' '))) AS s FROM w WHERE len(w) >= {SEQUENCE}),
n AS (SELECT src, id, count(*) AS n FROM s GROUP BY ALL),
c AS (SELECT a.src, a.id AS id_a, b.id AS id_b, count(*) AS both FROM s a JOIN s b ON a.src = b.src AND a.s = b.s AND a.id < b.id GROUP BY ALL)
SELECT c.src, c.id_a, c.id_b FROM c JOIN n x ON x.src = c.src AND x.id = c.id_a JOIN n y ON y.src = c.src AND y.id = c.id_b WHERE c.both / (x.n + y.n - c.both) >= {SIMILARITY}"""

_SIDE = """SELECT 'section' AS src, source_file || '/{s}/' || i AS item FROM (SELECT source_file, {s}_sections AS l, unnest(generate_series(1, len({s}_sections))) AS i FROM literature_article WHERE {s}_sections IS NOT NULL)
WHERE length(trim(l[i].text, {t})) > {n}"""

_P5 = f"""SELECT 'chunk' AS src, chunk_id::VARCHAR AS item FROM literature_chunk WHERE length(trim(text, {_TRIM})) > {CHUNK_CHARS}
UNION ALL {_SIDE.format(s="abstract", t=_TRIM, n=CHUNK_CHARS)} UNION ALL {_SIDE.format(s="body", t=_TRIM, n=CHUNK_CHARS)}
UNION ALL SELECT 'window', window_id::VARCHAR FROM literature_embedding_window WHERE len(regexp_extract_all(text, '[^ \\t\\r\\n]+')) > {WINDOW_TOKENS}"""

_SIDE_TEXT = """SELECT 'section' AS src, source_file || '/{s}/' || i AS item, md5(trim(l[i].text, {t})) AS digest, true AS within FROM (SELECT source_file, {s}_sections AS l, unnest(generate_series(1, len({s}_sections))) AS i FROM literature_article WHERE {s}_sections IS NOT NULL)
WHERE length(trim(l[i].text, {t})) > {n}"""

_P5_REJOINED = f"""SELECT 'chunk' AS src, chunk_id::VARCHAR AS item, md5(trim(text, {_TRIM})) AS digest, true AS within FROM literature_chunk WHERE length(trim(text, {_TRIM})) > {CHUNK_CHARS}
UNION ALL {_SIDE_TEXT.format(s="abstract", t=_TRIM, n=CHUNK_CHARS)} UNION ALL {_SIDE_TEXT.format(s="body", t=_TRIM, n=CHUNK_CHARS)}
UNION ALL SELECT 'window', window_id::VARCHAR, md5(trim(text, {_TRIM})), true FROM literature_embedding_window WHERE len(regexp_extract_all(text, '[^ \\t\\r\\n]+')) > {WINDOW_TOKENS}"""

_P6 = f"""WITH a AS (SELECT selection_run, {_number("disease_id")} AS disease_id, {_number("pmid")} AS pmid, min({_number("selection_rank")}) AS r FROM pubmed_selection_audit GROUP BY ALL),
m AS (SELECT {_number("pmid")} AS pmid, min({_number("best_rank")}) AS b FROM pubmed_complete_metadata GROUP BY 1)
SELECT selection_run, disease_id, pmid FROM (SELECT a.*, row_number() OVER (PARTITION BY selection_run, disease_id ORDER BY r, b ASC NULLS LAST, pmid) AS k FROM a LEFT JOIN m USING (pmid)
WHERE disease_id IS NOT NULL AND pmid IS NOT NULL AND r IS NOT NULL) WHERE k <= {BEST}"""


_TEXTS = "SELECT 'abstract' AS src, record_id AS id, abstract AS text FROM pubmed_complete_metadata UNION ALL SELECT 'chunk', chunk_id, text FROM literature_chunk"
_ALNUM = "regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')"
_P4_MEMBERS = f"""SELECT src, id, min(id) OVER (PARTITION BY src, s) AS rep FROM (SELECT src, id, array_to_string(w, ' ') AS s FROM (SELECT src, id, {_ALNUM} AS w FROM ({_TEXTS})) WHERE len(w) >= {SEQUENCE})"""
_P4_LINKS = f"""SELECT p.src, id_a AS a, id_b AS b FROM ({_P4}) p JOIN ({_P4_MEMBERS}) x ON x.src = p.src AND x.id = id_a AND x.rep = id_a JOIN ({_P4_MEMBERS}) y ON y.src = p.src AND y.id = id_b AND y.rep = id_b"""


def _groups(pairs: str, width: int) -> str:
    return f"""WITH RECURSIVE p AS ({pairs}), e AS (SELECT src, id_a AS a, id_b AS b FROM p UNION ALL SELECT src, id_b, id_a FROM p),
t AS ({_TEXTS}), ids AS (SELECT src, id FROM t WHERE len({_ALNUM}) >= {width}),
r AS (SELECT src, id, id AS g FROM ids UNION SELECT r.src, e.b, r.g FROM r JOIN e ON e.src = r.src AND e.a = r.id)
SELECT r.src, r.id, min(r.g) AS group_id, CAST(any_value(coalesce(n.n, 0)) AS BIGINT) AS links FROM r LEFT JOIN (SELECT src, a, count(*) AS n FROM e GROUP BY ALL) n ON n.src = r.src AND n.a = r.id GROUP BY r.src, r.id"""


# multiset overlap: least and greatest multiplicity of every sequence
_P4_WEIGHTED = f"""WITH w AS (SELECT src, id, {_ALNUM} AS w FROM ({_TEXTS}) WHERE text IS NOT NULL),
s AS (SELECT src, id, s, count(*) AS n FROM (SELECT src, id, unnest(list_transform(generate_series(1, len(w) - {WEIGHTED_SEQUENCE - 1}), lambda i: array_to_string(w[i:i + {WEIGHTED_SEQUENCE - 1}], ' '))) AS s FROM w WHERE len(w) >= {WEIGHTED_SEQUENCE}) GROUP BY ALL),
n AS (SELECT src, id, sum(n) AS n FROM s GROUP BY ALL),
c AS (SELECT a.src, a.id AS id_a, b.id AS id_b, sum(least(a.n, b.n)) AS both FROM s a JOIN s b ON a.src = b.src AND a.s = b.s AND a.id < b.id GROUP BY ALL)
SELECT c.src, c.id_a, c.id_b FROM c JOIN n x ON x.src = c.src AND x.id = c.id_a JOIN n y ON y.src = c.src AND y.id = c.id_b WHERE c.both / (x.n + y.n - c.both) >= {WEIGHTED_SIMILARITY}"""


# Characters whose compatibility decomposition holds letters or digits, as far as strip_accents leaves them.
_WIDE = "".join(chr(0xFF01 + ord(c) - 0x21) for c in "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")
_PLAIN = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
_LIGATURES = (("\ufb00", "ff"), ("\ufb01", "fi"), ("\ufb02", "fl"), ("\ufb03", "ffi"), ("\ufb04", "ffl"), ("\u00b9", "1"), ("\u00b2", "2"), ("\u00b3", "3"), ("\u2122", "tm"), ("\u2126", "\u03c9"))


def _latin_words(c: str) -> str:
    x = f"translate({c}, '{_WIDE}', '{_PLAIN}')"
    for a, b in _LIGATURES:
        x = f"replace({x}, '{a}', '{b}')"
    hidden = "[\\x{00AD}\\x{180E}\\x{200B}\\x{200C}\\x{200D}\\x{2060}\\x{FEFF}]|\\p{M}"
    return f"regexp_extract_all(regexp_replace(lower(strip_accents({x})), '{hidden}', '', 'g'), '[a-z0-9]+')"


_P8 = f"""WITH i AS (SELECT item_id, {_latin_words("text")} AS w FROM eval_item WHERE text IS NOT NULL), d AS (SELECT doc_id, {_latin_words("text")} AS w FROM documents WHERE text IS NOT NULL),
p AS (SELECT item_id, k, array_to_string(w[j:j + k - 1], ' ') AS p, count(*) AS n FROM (SELECT item_id, w, least({PASSAGE}, len(w)) AS k, unnest(generate_series(1, len(w) - least({PASSAGE}, len(w)) + 1)) AS j FROM i WHERE len(w) > 0) GROUP BY ALL),
s AS (SELECT DISTINCT doc_id, k, array_to_string(w[j:j + k - 1], ' ') AS p FROM (SELECT doc_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS j FROM d, (SELECT DISTINCT k FROM p) WHERE len(w) >= k)),
f AS (SELECT doc_id, item_id, sum(n) AS n FROM s JOIN p USING (k, p) GROUP BY ALL)"""
_P8_ITEMS = f"""{_P8} SELECT item_id, count(*) AS n_docs, count(CASE WHEN f.n = t.n THEN 1 END) AS n_whole, round(max(f.n / t.n), 6) AS most
FROM f JOIN (SELECT item_id, sum(n) AS n FROM p GROUP BY 1) t USING (item_id) GROUP BY 1"""


def oracle_sql() -> dict[str, str]:
    return {"p4_found": _P4, "p4_groups": _groups(_P4, SEQUENCE), "p4_members": _P4_MEMBERS, "p4_links": _P4_LINKS, "p4_weighted_groups": _groups(_P4_WEIGHTED, WEIGHTED_SEQUENCE), "p5_found": _P5, "p5_rejoined": _P5_REJOINED, "p6_found": _P6, "p8_found": f"{_P8} SELECT doc_id, item_id FROM f", "p8_items": _P8_ITEMS}
