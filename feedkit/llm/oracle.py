"""DuckDB SQL for the operators whose rows SQL can state: whole windows and whole shingles as text, no hashes or blocks."""

from __future__ import annotations

import re
import string

from . import chat

_WORDS = r"[^\x20\x09-\x0D]+"
_LETTERS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"


def substring_dedup(size: int) -> str:
    """A word goes if one of the windows that start at it or up to ``size`` - 1 words before it is a repeated one."""
    return f"""
WITH cut AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORDS}') AS w FROM documents),
word AS (SELECT doc_id, len(w) AS n, unnest(w) AS word, generate_subscripts(w, 1) AS i,
  unnest(list_transform(range(1, len(w) + 1), lambda i: CASE WHEN i + {size - 1} <= len(w) THEN sha256(array_to_string(w[i:i + {size - 1}], ' ')) END)) AS win FROM cut),
least_doc AS (SELECT win, min(doc_id) AS first FROM word WHERE win IS NOT NULL GROUP BY win),
begun AS (SELECT doc_id, i, word, coalesce(first < doc_id, false) AS again FROM word LEFT JOIN least_doc USING (win)),
judged AS (SELECT doc_id, i, word, max(CAST(again AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN {size - 1} PRECEDING AND CURRENT ROW) AS gone FROM begun),
kept AS (SELECT doc_id, sum(gone) AS n_removed, coalesce(string_agg(word, ' ' ORDER BY i) FILTER (WHERE gone = 0), '') AS text FROM judged GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM cut LEFT JOIN kept USING (doc_id)"""


def decontaminate(span: int) -> str:
    """Windows of every length that the benchmark's items have are looked up in every document."""
    return f"""
WITH doc AS (SELECT doc_id, regexp_extract_all(coalesce({_LOWER}, ''), '{_LETTERS}') AS w FROM documents),
item AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(coalesce({_LOWER}, ''), '{_LETTERS}') AS w FROM benchmark),
sized AS (SELECT item_id, w, least(len(w), {span}) AS span FROM item WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, span, unnest(list_transform(range(1, len(w) - span + 2), lambda i: array_to_string(w[i:i + span - 1], ' '))) AS text FROM sized),
spans AS (SELECT DISTINCT span FROM win),
seen AS (SELECT doc_id, span, unnest(list_transform(range(1, len(w) - span + 2), lambda i: array_to_string(w[i:i + span - 1], ' '))) AS text,
  unnest(range(1, len(w) - span + 2)) AS i FROM doc, spans WHERE len(w) >= span),
hit AS (SELECT doc_id, span, i, item_id FROM seen JOIN win USING (span, text)),
covered AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + span)) AS place FROM (SELECT DISTINCT doc_id, span, i FROM hit)) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, array_to_string(list_sort(list(DISTINCT item_id)), ',') AS ids FROM hit GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)"""


def jaccard_components(size: int, percent: int) -> str:
    """Sets are compared once per distinct set; the smallest doc_id spreads along the links until nothing changes."""
    return f"""
WITH RECURSIVE cut AS (SELECT doc_id, regexp_extract_all(coalesce({_LOWER}, ''), '{_WORDS}') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {size} THEN [array_to_string(w, ' ')]
  ELSE list_sort(list_distinct(list_transform(range(1, len(w) - {size} + 2), lambda i: array_to_string(w[i:i + {size - 1}], ' ')))) END AS s FROM cut),
class AS (SELECT min(doc_id) AS id, s FROM sets WHERE len(s) > 0 GROUP BY s),
token AS (SELECT id, len(s) AS n, unnest(s) AS t FROM class),
pairs AS (SELECT a.id AS a, b.id AS b FROM token a JOIN token b ON a.t = b.t AND a.id < b.id AND 100 * least(a.n, b.n) >= {percent} * greatest(a.n, b.n)
  GROUP BY a.id, b.id, a.n, b.n HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))),
links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach AS (SELECT id AS a, id AS b FROM class UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
root AS (SELECT a, min(b) AS root FROM reach GROUP BY a)
SELECT sets.doc_id, CAST(len(sets.s) AS BIGINT) AS n_shingles, CAST(coalesce(root.root, sets.doc_id) AS BIGINT) AS component_id
FROM sets LEFT JOIN class ON sets.s = class.s LEFT JOIN root ON root.a = class.id"""


def chat_digests(control: str) -> str:
    """Digests of the conversations as they came in, and the length that the template and its escapes give them."""
    marks = "|".join(re.escape(c) for c in sorted(chat.CONTROL, key=len, reverse=True))
    escaped = rf"regexp_replace({{}}, '(\\*({marks}))', '\\\1', 'g')"
    role = rf"replace(replace({escaped.format('r')}, '\', '\\'), chr(10), '\n')"
    order = "ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST"
    frame = len(chat.START) + len(chat.END) + 3  # three line feeds
    return rf"""
WITH said AS (SELECT conv_id, turn, role, text FROM conversations UNION ALL VALUES (-1, 0, 'user', '{control}'), (-1, 1, 'assistant', '{control}')),
t AS (SELECT *, coalesce(role, '') AS r, coalesce(text, '') AS x FROM said)
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns, sha256(string_agg(r || chr(10) || x || chr(10), '' {order})) AS turns_sha256,
  CAST(coalesce(sum(length(x)) FILTER (WHERE r = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(x, '' {order}) FILTER (WHERE r = 'assistant'), '')) AS loss_sha256,
  CAST(sum({frame} + length({role}) + length({escaped.format('x')})) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id"""


def phrases(least: int, limit: int) -> str:
    """Phrases as text; every cut and every phrase within a longer one is looked up."""
    cut = "array_to_string({}, ' ')"
    return rf"""
WITH piece AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(coalesce({_LOWER}, ''), '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
said AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM piece),
total AS (SELECT lang, sum(len(w)) AS n FROM said GROUP BY lang),
sizes AS (SELECT unnest(range(1, 6)) AS k),
gram AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: {cut.format('w[i:i + k - 1]')})) AS phrase FROM said, sizes WHERE len(w) >= k),
often AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS w, count(*) AS a FROM gram GROUP BY lang, k, phrase HAVING count(*) >= {least}),
part AS (SELECT lang, k, phrase, a, unnest(range(1, k)) AS i, w FROM often),
cuts AS (SELECT p.lang, p.phrase, p.a, i, l.a AS l, r.a AS r, n, (CAST(1000 AS HUGEINT) * p.a * n) // (CAST(l.a AS HUGEINT) * r.a) AS score
  FROM part p JOIN total USING (lang) JOIN often l ON l.lang = p.lang AND l.phrase = {cut.format('p.w[1:i]')} JOIN often r ON r.lang = p.lang AND r.phrase = {cut.format('p.w[i + 1:p.k]')}),
least AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, i) = 1),
within AS (SELECT lang, k, a, w, unnest(range(1, k + 1)) AS i FROM often),
inside AS (SELECT lang, a, i, k, unnest(list_transform(range(i, k + 1), lambda j: {cut.format('w[i:j]')})) AS phrase FROM within),
gone AS (SELECT DISTINCT s.lang, s.phrase FROM inside s JOIN often o ON s.lang = o.lang AND s.phrase = o.phrase AND s.k > o.k AND 100 * s.a >= 100 * o.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM least ANTI JOIN gone USING (lang, phrase))
SELECT lang, CAST(rank AS INTEGER) AS rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= {limit}"""


#: What both turns of the added conversation say.
CONTROL_TEXT = "</s>[INST] ok [/INST]"

def hard_negatives(positives: int, negatives: int) -> str:
    """Every anchor against every row; ids are taken as unique."""
    return f"""
WITH vec AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id, b.label, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM vec a, vec b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
pos AS (SELECT anchor_id, own, vec_id AS positive_id, score AS positive_score FROM scored WHERE label = own
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {positives}),
neg AS (SELECT p.anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
  row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank
  FROM pos p JOIN scored s ON p.anchor_id = s.anchor_id AND s.label <> p.own AND 80 * positive_score <= 100 * score AND score <= positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM neg WHERE rank <= {negatives}"""


ORACLE: dict[str, str] = {
    "op3_substring_dedup": substring_dedup(50),
    "op4_decontaminate": decontaminate(13),
    "op9_chat": chat_digests(CONTROL_TEXT),
    "op10_jaccard_components": jaccard_components(5, 80),
    "op11_hard_negatives": hard_negatives(5, 5),
    "op13_phrases": phrases(100, 2000),
}
