"""Registered queries of the text operators: whole tables, production parameters, SQL twins where SQL can say it."""

from __future__ import annotations

from giniflow.llm import (collocations, jaccard, langid, lexical, lm, packing, paragraphs, pieces, pii, quality_net,
                          quality_rules, tokens, winnow)
from giniflow.llm.common import LOWER, UPPER, WORD, read_table

QUERIES = {}
SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_best_fit_packing(spark, sf_dir):
    return packing.pack_documents(read_table(spark, sf_dir, "documents"))


@query
def op2_jaccard_join(spark, sf_dir):
    return jaccard.jaccard_components(read_table(spark, sf_dir, "documents"))


SQL["op2_jaccard_join"] = f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w
  FROM documents),
grams AS (
  SELECT DISTINCT rid, array_to_string(w[i:i + {jaccard.WIDTH - 1}], ' ') AS g
  FROM (SELECT rid, w, unnest(range(1, greatest(len(w) - {jaccard.WIDTH - 1}, least(len(w), 1)) + 1)) AS i FROM d)),
sizes AS (SELECT rid, count(*) AS n FROM grams GROUP BY rid),
link AS (
  SELECT a.rid AS x, b.rid AS y FROM grams a JOIN grams b USING (g) JOIN sizes s ON s.rid = a.rid
  JOIN sizes t ON t.rid = b.rid WHERE 100 * least(s.n, t.n) >= {jaccard.PERCENT} * greatest(s.n, t.n)
  GROUP BY a.rid, b.rid, s.n, t.n HAVING 100 * count(*) >= {jaccard.PERCENT} * (s.n + t.n - count(*))),
reach AS (SELECT x, y FROM link UNION SELECT reach.x, link.y FROM reach JOIN link ON reach.y = link.x),
least_id AS (SELECT x AS rid, min(o.doc_id) AS component_id FROM reach JOIN d o ON o.rid = reach.y GROUP BY x)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, coalesce(component_id, doc_id) AS component_id
FROM d LEFT JOIN sizes USING (rid) LEFT JOIN least_id USING (rid)"""


@query
def op3_quality_net(spark, sf_dir):
    return quality_net.quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query
def op4_lattice_lm(spark, sf_dir):
    return lm.lm_scores(read_table(spark, sf_dir, "documents"), lm.file_blocks(spark))


@query
def op5_language_id(spark, sf_dir):
    return langid.predict_language(read_table(spark, sf_dir, "documents"))


@query
def op6_pii(spark, sf_dir):
    return pii.pii_report(read_table(spark, sf_dir, "documents"))


@query
def op7_winnowing(spark, sf_dir):
    return winnow.contamination_report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


SQL["op7_winnowing"] = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{winnow.LOWER_WORD}') AS w
  FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{winnow.LOWER_WORD}') AS w
  FROM benchmark),
items AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM (SELECT *, least(len(w), {winnow.SPAN}) AS n FROM b WHERE len(w) > 0))),
wins AS (
  SELECT rid, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM d, (SELECT DISTINCT n FROM items) WHERE len(w) >= n)),
hits AS (SELECT DISTINCT rid, n, i, item_id FROM wins JOIN items USING (n, win)),
counted AS (
  SELECT rid, count(DISTINCT pos) AS n_hit
  FROM (SELECT rid, unnest(range(i, i + n)) AS pos FROM (SELECT DISTINCT rid, n, i FROM hits)) GROUP BY rid),
listed AS (
  SELECT rid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT rid, item_id FROM hits WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN counted USING (rid) LEFT JOIN listed USING (rid)"""


@query
def op8_paragraph_minhash(spark, sf_dir):
    return paragraphs.repeated_units(read_table(spark, sf_dir, "documents"))


@query
def op9_quality_rules(spark, sf_dir):
    return quality_rules.quality_report(read_table(spark, sf_dir, "documents"))


@query
def op10_token_counts(spark, sf_dir):
    return tokens.token_counts(read_table(spark, sf_dir, "documents"))


@query
def op11_phrase_collocations(spark, sf_dir):
    return collocations.phrase_collocations(read_table(spark, sf_dir, "documents"))


SQL["op11_phrase_collocations"] = f"""
WITH p AS (
  SELECT coalesce(CAST(lang AS VARCHAR), 'und') AS lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w
  FROM (SELECT lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                                                  '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM p GROUP BY lang),
grams AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM p, (SELECT unnest(range(1, {collocations.LONGEST + 1})) AS k) WHERE len(w) >= k)),
f AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY lang, k, phrase HAVING count(*) >= {collocations.MIN_COUNT}),
cand AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
inside AS (
  SELECT lang, phrase, max(longer) AS longer
  FROM (SELECT lang, longer, array_to_string(w[i:i + m - 1], ' ') AS phrase
        FROM (SELECT lang, a AS longer, w, m, unnest(range(1, k - m + 2)) AS i
              FROM cand, (SELECT unnest(range(2, {collocations.LONGEST})) AS m) WHERE m < k)) GROUP BY lang, phrase),
alone AS (
  SELECT cand.* FROM cand LEFT JOIN inside USING (lang, phrase)
  WHERE longer IS NULL OR CAST(longer AS HUGEINT) * 100 < CAST(a AS HUGEINT) * {collocations.INSIDE_PERCENT}),
cuts AS (
  SELECT lang, phrase, a, cut, array_to_string(w[1:cut], ' ') AS head, array_to_string(w[cut + 1:k], ' ') AS tail
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM alone)),
scored AS (
  SELECT cuts.lang, cuts.phrase, a, cut, x.f AS l, y.f AS r, (CAST(a AS HUGEINT) * 2000000) // (x.f + y.f) AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = head JOIN f y ON y.lang = cuts.lang AND y.phrase = tail),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest)
JOIN totals USING (lang) WHERE rank <= {collocations.MOST}"""


@query
def op12_piece_codec(spark, sf_dir):
    return pieces.digests(pieces.encode_documents(read_table(spark, sf_dir, "documents")))


@query
def op13_ranked_search(spark, sf_dir):
    return lexical.ranked_search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


_TERMS = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), " \
         "'[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

SQL["op13_ranked_search"] = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_TERMS} AS w FROM documents),
t AS (SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM d WHERE len(w) > 0),
tf AS (SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(w) AS term FROM d) GROUP BY rid, term),
weight AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(n_docs) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM tf, t GROUP BY term),
m AS (SELECT rid, doc_id, 50 + (50 * len(w) * n_docs) // n_terms AS m FROM d, t WHERE len(w) > 0),
items AS (SELECT DISTINCT iid, item_id, term
          FROM (SELECT iid, item_id, unnest(w) AS term
                FROM (SELECT row_number() OVER () AS iid, item_id, {_TERMS} AS w FROM benchmark))),
scored AS (
  SELECT iid, item_id, doc_id, rid, CAST(sum(weight.w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
  FROM items JOIN tf USING (term) JOIN weight USING (term) JOIN m USING (rid) GROUP BY iid, item_id, doc_id, rid)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0)
WHERE rank <= {lexical.TOP}"""
