"""DuckDB SQL for the operators that SQL can express, written as plain definitions.

The others (hashed n-gram model, BPE, evidence fusion, surrogates, rule signatures,
hash-ordered template seeds) are tested against brute force in ``tests/llm`` instead; of
operators 2 and 9 the base columns have SQL, as queries of their own.
"""

from __future__ import annotations

from daybook.llm import bwtdedup, covertree, decontaminate, filteraudit, hyperminhash, licenses, projections, quality

_FOLD = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def op1_near_duplicates() -> str:
    """All pairs that share a shingle, linked by the exact similarity; components by recursion."""
    size, percent = hyperminhash.SHINGLE_WORDS, hyperminhash.THRESHOLD_PERCENT
    return f"""WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_FOLD.format('text')}, '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(ws) >= {size} THEN list_transform(range(1, len(ws) - {size} + 2), lambda i: array_to_string(ws[i:i + {size - 1}], ' '))
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS shingle FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (
  SELECT x, y FROM shared JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
  WHERE 100 * k >= {percent} * (nx.n + ny.n - k)),
edge AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION
  SELECT edge.x, reach.other FROM reach JOIN edge ON edge.y = reach.doc_id),
component AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT c.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id,
       c.doc_id = c.component_id AS kept
FROM component c LEFT JOIN n USING (doc_id)"""


def op7_decontaminate() -> str:
    """Windows that agree on two blocks of words, verified by counting the words that differ."""
    window, most, least = decontaminate.WINDOW, decontaminate.SUBSTITUTIONS, decontaminate.MIN_WORDS
    masks = ", ".join(f"({k}, [{', '.join(str(p + 1) for p in m)}])" for k, m in enumerate(decontaminate.MASKS))
    words = "regexp_extract_all({}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"""WITH d AS (SELECT doc_id, {words.format(_FOLD.format('text'))} AS ws FROM documents),
b AS (SELECT item_id, {words.format(_FOLD.format('text'))} AS ws FROM benchmark),
bw AS (
  SELECT item_id, least(len(ws), {window}) AS n, unnest(list_transform(range(1, len(ws) - least(len(ws), {window}) + 2),
         lambda i: ws[i:i + least(len(ws), {window}) - 1])) AS win
  FROM b WHERE len(ws) > 0),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, n, p, ws[p:p + n - 1] AS win
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS p FROM d, sizes WHERE len(ws) >= n)),
mask(id, places) AS (VALUES {masks}),
bm AS (
  SELECT item_id, n, win, id, list_transform(places, lambda i: win[i]) AS k FROM bw, mask WHERE n = {window}
  UNION ALL SELECT item_id, n, win, -1, win FROM bw WHERE n < {window}),
dm AS (
  SELECT doc_id, n, p, win, id, list_transform(places, lambda i: win[i]) AS k FROM dw, mask WHERE n = {window}
  UNION ALL SELECT doc_id, n, p, win, -1, win FROM dw WHERE n < {window}),
hit AS (
  SELECT DISTINCT dm.doc_id, dm.n, dm.p, bm.item_id
  FROM dm JOIN bm ON dm.n = bm.n AND dm.id = bm.id AND dm.k = bm.k
  WHERE len(list_filter(range(1, dm.n + 1), lambda i: dm.win[i] <> bm.win[i])) <= {most}),
found AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items, count(DISTINCT p) AS n_windows, min(p) - 1 AS first_word
  FROM hit WHERE n >= {least} GROUP BY doc_id),
listed AS (
  SELECT doc_id, strong, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY item_id) AS item_ids
  FROM (SELECT DISTINCT doc_id, n >= {least} AS strong, item_id FROM hit) GROUP BY doc_id, strong)
SELECT d.doc_id, found.doc_id IS NOT NULL AS contaminated, found.doc_id IS NULL AS kept,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(s.item_ids, '') AS item_ids,
       CAST(coalesce(n_windows, 0) AS BIGINT) AS n_windows, CAST(first_word AS BIGINT) AS first_word,
       coalesce(w.item_ids, '') AS weak_item_ids
FROM d LEFT JOIN found USING (doc_id) LEFT JOIN listed s ON s.doc_id = d.doc_id AND s.strong
     LEFT JOIN listed w ON w.doc_id = d.doc_id AND NOT w.strong"""


def op10_repeated_strings() -> str:
    """Every window of every text by a 128-bit digest; runs of those that stand twice are cut out."""
    n = bwtdedup.LENGTH
    return f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b FROM documents),
w AS (SELECT r, p, md5_number(b[p:p + {n - 1}]) AS h FROM (SELECT r, b, unnest(range(1, octet_length(b) - {n - 2})) AS p FROM d)),
hit AS (SELECT r, p FROM w SEMI JOIN (SELECT h FROM w GROUP BY h HAVING count(*) > 1) USING (h)),
island AS (
  SELECT r, p, sum(CASE WHEN p <= before + {n} THEN 0 ELSE 1 END) OVER (PARTITION BY r ORDER BY p) AS k
  FROM (SELECT r, p, lag(p) OVER (PARTITION BY r ORDER BY p) AS before FROM hit)),
span AS (SELECT r, k, min(p) AS a, max(p) + {n} AS z FROM island GROUP BY r, k),
part AS (
  SELECT r, a AS k, b[coalesce(lag(z) OVER (PARTITION BY r ORDER BY a), 1):a - 1] AS part FROM span JOIN d USING (r)
  UNION ALL SELECT r, octet_length(any_value(b)) + 1, any_value(b)[max(z):] FROM span JOIN d USING (r) GROUP BY r),
rest AS (SELECT r, unhex(string_agg(hex(part), '' ORDER BY k)) AS kept FROM part GROUP BY r),
sums AS (SELECT r, sum(z - a) AS n_removed, count(*) AS n_spans FROM span GROUP BY r)
SELECT doc_id, octet_length(b) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       coalesce(n_spans, 0) AS n_spans, sha256(coalesce(kept, b)) AS kept_sha256, decode(coalesce(kept, b)) AS text
FROM d LEFT JOIN sums USING (r) LEFT JOIN rest USING (r)"""


def quality_base_counts() -> str:
    """The counts of the base rules of operator 2, word by word and line by line."""
    word = "[^\\x20\\x09-\\x0D]"
    return f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, regexp_extract_all(t, '{word}+') AS ws FROM d),
win AS (
  SELECT r, unnest(range(1, len(ws) - 1)) AS p,
         unnest(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) AS g FROM w),
twice AS (SELECT r, p FROM (SELECT r, p, count(*) OVER (PARTITION BY r, g) AS n FROM win) WHERE n > 1),
marked AS (SELECT r, count(DISTINCT q) AS n FROM (SELECT r, unnest([p, p + 1, p + 2]) AS q FROM twice) GROUP BY r),
line AS (SELECT r, l, count(*) AS n FROM (SELECT r, unnest(string_split(t, chr(10))) AS l FROM d)
         WHERE regexp_matches(l, '{word}') GROUP BY r, l),
dup AS (SELECT r, sum(n - 1) AS n FROM line GROUP BY r)
SELECT doc_id, len(ws) AS n_words, CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
       len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines,
       coalesce(marked.n, 0) AS n_repeat_words,
       len(ws) < {quality.MIN_WORDS} OR 100 * coalesce(marked.n, 0) > {quality.MAX_REPEAT_PERCENT} * len(ws) AS base_failed
FROM d JOIN w USING (r) LEFT JOIN marked USING (r) LEFT JOIN dup USING (r)"""


def license_base_places() -> str:
    """The places of the base phrases of operator 9, phrase by phrase."""
    phrases = " UNION ALL ".join(
        f"""SELECT r, '{label}' AS label, unnest(list_filter(range(1, len(ws) - {len(words) - 2}),
         lambda i: ws[i:i + {len(words) - 1}] = [{', '.join(f"'{x}'" for x in words)}])) - 1 AS place FROM w"""
        for phrase, label in licenses.BASE_PHRASES.items() for words in [phrase.split()])
    return f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_FOLD.format('text')} AS t FROM documents),
w AS (SELECT r, regexp_extract_all(t, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM d),
place AS ({phrases}),
found AS (SELECT r, count(*) AS n, min(place) AS low, max(place) AS high, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
          FROM place GROUP BY r)
SELECT doc_id, len(ws) AS n_words, coalesce(n, 0) AS n_base, CAST(low AS BIGINT) AS first_word, CAST(high AS BIGINT) AS last_word,
       coalesce(labels, '') AS base_labels
FROM d JOIN w USING (r) LEFT JOIN found USING (r)"""


def op11_filter_audit() -> str:
    """Every document walks through every order; a filter's first place in the order decides."""
    return f"""WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS ws FROM t),
least_id AS (SELECT text, min(doc_id) AS least_id FROM t GROUP BY text),
known AS (
  SELECT doc_id, max(coalesce(quality = 1, false)) AS good, max(coalesce(toxic = 1, false)) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
d AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         CASE WHEN len(ws) < {filteraudit.MIN_WORDS} THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(ws)) < {filteraudit.MIN_DISTINCT_PERCENT} * len(ws) THEN 'B' ELSE '' END
         || CASE WHEN 100 * len(regexp_extract_all(text, '[A-Z]')) > {filteraudit.MAX_CAPITALS_PERCENT} * length(text)
            THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN w.doc_id > least_id THEN 'E' ELSE '' END AS failed
  FROM w JOIN least_id USING (text) LEFT JOIN known ON known.doc_id = w.doc_id),
f(f) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM f a, f b, f c, f d, f e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
steps AS (SELECT filter_order, step, filter_order[step] AS f FROM orders, range(1, 6) r(step)),
gone_by AS (
  SELECT part, good, toxic, filter_order, step, s.f, failed = s.f AS alone, contains(failed, s.f) AS fails,
         len(list_filter(range(1, step), lambda k: contains(failed, filter_order[k]))) > 0 AS gone
  FROM d, steps s),
counted AS (
  SELECT part, filter_order, CAST(step AS INTEGER) AS step, f,
         count(*) FILTER (NOT gone AND NOT fails) AS kept, count(*) FILTER (fails AND NOT gone) AS removed,
         count(*) FILTER (fails AND gone) AS redundant, count(*) FILTER (alone) AS unique_fails,
         count(*) FILTER (fails AND NOT gone AND good) AS good_lost,
         count(*) FILTER (fails AND NOT gone AND toxic) AS toxic_lost
  FROM gone_by GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM counted"""


def op12_near_vectors() -> str:
    """All pairs of one label by the cosine, components by recursion."""
    return f"""WITH RECURSIVE t AS (
  SELECT DISTINCT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
n AS (SELECT row_number() OVER () AS k, * FROM t),
link AS (
  SELECT a.k AS x, b.k AS y FROM n a JOIN n b ON a.label = b.label AND len(a.v) = len(b.v) AND a.k <> b.k
  WHERE list_cosine_similarity(a.v, b.v) >= {projections.THRESHOLD}),
reach(k, other) AS (
  SELECT k, k FROM n UNION SELECT link.x, reach.other FROM reach JOIN link ON link.y = reach.k),
found AS (
  SELECT n.vec_id, n.label, n.v, min(o.vec_id) AS component_id,
         (SELECT count(*) FROM link WHERE link.x = n.k) AS n_links
  FROM n JOIN reach USING (k) JOIN n o ON o.k = reach.other GROUP BY n.k, n.vec_id, n.label, n.v)
SELECT e.vec_id, coalesce(n_links, 0) AS n_links, coalesce(component_id, e.vec_id) AS component_id,
       coalesce(e.vec_id = coalesce(component_id, e.vec_id), true) AS kept
FROM embeddings e LEFT JOIN found f
  ON f.vec_id = e.vec_id AND f.label = e.label AND f.v = CAST(e.embedding AS DOUBLE[])"""


def op13_hard_negatives() -> str:
    """All scores of each anchor, ranked."""
    return f"""WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(256 * x)) AS x
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
a AS (SELECT row_number() OVER () AS k, * FROM v WHERE vec_id % 100 = 0),
s AS (
  SELECT a.k, a.vec_id AS anchor_id, a.label = v.label AS same, v.vec_id,
         CAST(CASE WHEN len(a.x) = 0 THEN 0 ELSE list_inner_product(a.x, v.x) END AS BIGINT) AS score
  FROM a JOIN v ON len(a.x) = len(v.x)),
p AS (
  SELECT k, anchor_id, vec_id AS positive_id, score AS positive_score,
         row_number() OVER (PARTITION BY k ORDER BY score DESC, vec_id) AS slot
  FROM s WHERE same AND vec_id <> anchor_id QUALIFY slot <= {covertree.POSITIVES}),
n AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.k, p.slot ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
  FROM p JOIN s ON s.k = p.k AND NOT s.same
    AND {covertree.LOW_PERCENT} * p.positive_score <= 100 * s.score
    AND 100 * s.score <= {covertree.HIGH_PERCENT} * p.positive_score
  QUALIFY rank <= {covertree.NEGATIVES})
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n"""


def all_sql() -> dict[str, str]:
    return {f.__name__: f() for f in (
        op1_near_duplicates, op7_decontaminate, op10_repeated_strings, op11_filter_audit, op12_near_vectors, op13_hard_negatives,
        quality_base_counts, license_base_places)}
