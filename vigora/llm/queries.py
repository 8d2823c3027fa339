"""The queries of this subpackage, and SQL where SQL can express them."""

from __future__ import annotations

from vigora.llm import html, lm, mixing, neardup, neighbours, pieces, quality, quotes, tokens, toxicity

QUERIES = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_tokens": tokens.op2_tokens,
    "op3_quality": quality.op3_quality,
    "op4_quotes": quotes.op4_quotes,
    "op5_pieces": pieces.op5_pieces,
    "op6_mixing": mixing.op6_mixing,
    "op7_html": html.op7_html,
    "op8_neardup": neardup.op8_neardup,
    "op9_neighbours": neighbours.op9_neighbours,
    "op10_lm": lm.op10_lm,
}

#: The learned, hashed and encoding operators have no SQL; tests/llm holds them against brute force.
ORACLES: dict[str, str] = {
    "op8_neardup": r"""WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
 s AS (SELECT doc_id, unnest(CASE WHEN len(w) >= 2 THEN list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) ELSE w END) AS g FROM d),
 n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
 p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
 l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 80 * (x.n + y.n - i)),
 e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
 r(node, reach) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.node, e.b FROM r JOIN e ON r.reach = e.a)
 SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.reach) AS component_id, d.doc_id = min(r.reach) AS kept FROM d JOIN r ON r.node = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id""",
}
