"""The operators' queries and their SQL, by registered name."""

from __future__ import annotations

from tallyworks.llm import (
    ann,
    hilbert,
    html_text,
    langid,
    lexical,
    minhash,
    packing,
    pieces,
    pii,
    quality,
    simhash,
    substrings,
    vector_codes,
)

QUERIES = {
    "op1_quality": quality.op1_quality,
    "op2_nearest": ann.op2_nearest,
    "op3_packing": packing.op3_packing,
    "op4_simhash": simhash.op4_simhash,
    "op5_html": html_text.op5_html,
    "op6_substrings": substrings.op6_substrings,
    "op7_language": langid.op7_language,
    "op8_pii": pii.op8_pii,
    "op9_sharding": hilbert.op9_sharding,
    "op10_pieces": pieces.op10_pieces,
    "op11_fingerprints": minhash.op11_fingerprints,
    "op12_codes": vector_codes.op12_codes,
    "op13_search": lexical.op13_search,
}
#: Words of covered windows go; a window is compared by its words, and goes where it starts in a document with a smaller id.
REPEATED_PASSAGES = r"""
WITH words AS (
    SELECT row_number() OVER () AS rid, doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
windows AS (
    SELECT rid, doc_id, i, array_to_string(w[i:i + 49], ' ') AS passage
    FROM (SELECT *, unnest(generate_series(1, len(w) - 49)) AS i FROM words)),
least AS (SELECT passage, min(doc_id) AS lo FROM windows GROUP BY passage),
gone AS (
    SELECT DISTINCT rid, unnest(generate_series(i, i + 49)) AS p
    FROM windows JOIN least USING (passage) WHERE lo < doc_id),
kept AS (
    SELECT rid, string_agg(word, ' ' ORDER BY p) AS kept_text, count(*) AS n
    FROM (SELECT rid, unnest(w) AS word, unnest(generate_series(1, len(w))) AS p FROM words) ANTI JOIN gone USING (rid, p) GROUP BY rid)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept_text, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (rid)
"""
SQL: dict[str, str] = {
    "op6_substrings": REPEATED_PASSAGES,
    "op12_codes": vector_codes.sql(),
    "op13_search": lexical.SQL,
}
