"""SQL for the registered queries that SQL can express, run by another engine on the same tables.

The others have none: learned weights (op2), Bloom filters (op3), local search (op5), tokenizers
(op5, op7) and a parser (op10) have no SQL form. Their tests compare with brute force.
"""

def _url_levels(order: int) -> str:
    """Interpolated probabilities of sequences with contexts of 0 to ``order`` characters."""
    parts = []
    for k in range(order + 1):
        over = f"(PARTITION BY left(gram, {k}))" if k else "()"
        sums = ", ".join(
            f"{kind}, (sum({kind}) OVER {over})::BIGINT AS {kind}_n, (count(*) FILTER ({kind} > 0) OVER {over})::BIGINT AS {kind}_t"
            for kind in ("allow", "block")
        )
        shorter = f"JOIN p{k - 1} q ON right(l.gram, {k}) = q.gram" if k else "CROSS JOIN (SELECT 1 / count(*) AS allow_p, 1 / count(*) AS block_p FROM c0) q"
        mixed = ", ".join(
            f"CASE WHEN {kind}_n > 0 THEN ({kind} + {kind}_t * q.{kind}_p) / ({kind}_n + {kind}_t) ELSE q.{kind}_p END AS {kind}_p"
            for kind in ("allow", "block")
        )
        parts.append(f"""c{k} AS (
  SELECT right(gram, {k + 1}) AS gram, sum(allow)::BIGINT AS allow, sum(block)::BIGINT AS block FROM seen GROUP BY 1
), l{k} AS (
  SELECT gram, {sums} FROM c{k}
), p{k} AS (
  SELECT l.gram, {mixed} FROM l{k} l {shorter}
)""")
    return ", ".join(parts)


URLS = r"""
WITH base AS (
  SELECT page_id, url, regexp_extract(url, '://([^/?#]*)([^?#]*)', ['h', 'p']) AS x,
         translate(coalesce(regexp_extract(url, '(?s)://(.*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS said
  FROM pages
), named AS (
  SELECT row_number() OVER () AS rid, page_id, url, said, coalesce(x.p, '') AS path,
         translate(coalesce(x.h, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host
  FROM base
), rules(verdict, rule, h, p) AS (
  VALUES ('allow', 'org/', 'org', '/'), ('block', 'example.org/es/', 'example.org', '/es/'),
         ('block', 'example.org/en/1', 'example.org', '/en/1'), ('allow', 'com/fr/', 'com', '/fr/'),
         ('block', 'com/de/', 'com', '/de/')
), ruled AS (
  SELECT n.rid, arg_max(r.rule, length(r.rule)) AS rule, arg_max(r.verdict, length(r.rule)) AS label
  FROM named n JOIN rules r
    ON (n.host = r.h OR ends_with(n.host, '.' || r.h)) AND starts_with(n.path, r.p)
  GROUP BY n.rid
), listed AS (
  SELECT n.*, rule, label, coalesce(('0x' || md5(url)[1:6])::BIGINT % 5 = 0, false) AS held,
         chr(2) || chr(2) || chr(2) || chr(2) || chr(2) || chr(2) || said || chr(3) AS padded
  FROM named n LEFT JOIN ruled USING (rid)
), spread AS (
  SELECT rid, label, held, substring(padded, unnest(range(1, length(padded) - 5)), 7) AS gram FROM listed
), seen AS (
  SELECT gram, count(*) FILTER (label = 'allow' AND NOT held) AS allow, count(*) FILTER (label = 'block' AND NOT held) AS block
  FROM spread GROUP BY gram
), """ + _url_levels(6) + r""", model AS (
  SELECT gram, round(1e6 * (ln(allow_p) - ln(block_p)))::BIGINT AS ratio FROM p6
), scored AS (
  SELECT l.* EXCLUDE (padded), t.size, t.total FROM listed l
  JOIN (SELECT rid, count(*) AS size, sum(ratio)::BIGINT AS total FROM spread JOIN model USING (gram) GROUP BY rid) t USING (rid)
), stepped AS (
  SELECT *, greatest(least(floor(total / (size * 10000)), 1000), -1000)::INT AS step FROM scored
), steps AS (
  SELECT step, count(*) FILTER (label = 'allow') AS allow, count(*) FILTER (label = 'block') AS block
  FROM stepped WHERE held AND label IS NOT NULL GROUP BY step
), tried AS (
  SELECT s.step, sum(o.allow) AS all_allow, sum(o.block) AS all_block,
         coalesce(sum(o.allow) FILTER (o.step < s.step), 0) AS lost, coalesce(sum(o.block) FILTER (o.step < s.step), 0) AS stopped,
         floor((coalesce(max(o.step) FILTER (o.step < s.step), s.step) + s.step + 1) / 2)::INT AS halfway
  FROM steps s CROSS JOIN steps o GROUP BY s.step
), cut AS (
  SELECT coalesce(arg_min(halfway, (lost * all_block + (all_block - stopped) * all_allow) * 10000 + step), 0) AS step
  FROM tried WHERE all_allow > 0 AND all_block > 0
)
SELECT page_id, host, path, rule, coalesce(label, CASE WHEN step >= (SELECT step FROM cut) THEN 'allow' ELSE 'block' END) AS verdict,
       total / (size * 1000000.0::DOUBLE) AS score
FROM stepped
"""

CHAT = r"""
WITH turns AS (
  SELECT conv_id, turn, role AS r, text AS t, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -1, unnest([0, 1]), unnest(['user', 'assistant']), '<|im_end|><|im_start|>assistant ok',
         unnest(['user', 'assistant']), '<|im_end|><|im_start|>assistant ok'
), escaped AS (
  SELECT *, regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') AS safe,
         regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'), '<(\\*)\|', '<\\\1|', 'g') AS safe_role
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, r NULLS FIRST, t NULLS FIRST)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (r = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, r NULLS FIRST, t NULLS FIRST) FILTER (r = 'assistant'), '')) AS loss_sha256,
       sum(12 + length(safe_role) + 1 + length(safe) + 11)::BIGINT AS formatted_chars
FROM escaped GROUP BY conv_id
"""

RULES = r"""
WITH split AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), windows AS (
  SELECT rid, unnest(range(1, len(words) - 6)) AS i, words FROM split WHERE len(words) >= 8
), keyed AS (
  SELECT rid, i, array_to_string(words[i:i + 7], ' ') AS w FROM windows
), again AS (
  SELECT k.rid, k.i FROM keyed k JOIN (SELECT rid, w FROM keyed GROUP BY rid, w HAVING count(*) > 1) USING (rid, w)
), covered AS (
  SELECT rid, count(DISTINCT place) AS n FROM (SELECT rid, unnest(range(i, i + 8)) AS place FROM again) GROUP BY rid
), counted AS (
  SELECT rid, doc_id, stratum, len(words)::BIGINT AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')))::BIGINT AS n_capitals,
         len(lines)::BIGINT AS n_lines,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         len(list_filter(range(2, len(words) + 1), lambda i: words[i] = words[i - 1]))::BIGINT AS n_stutters,
         coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM split LEFT JOIN covered USING (rid)
), judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counted
), parts AS (
  SELECT rid, doc_id, stratum, base_failed, unnest([
    {'rule': 'symbols', 'part': n_symbols, 'whole': word_chars}, {'rule': 'capitals', 'part': n_capitals, 'whole': word_chars},
    {'rule': 'stutter', 'part': n_stutters, 'whole': n_words}, {'rule': 'lines', 'part': n_dup_lines, 'whole': n_lines},
    {'rule': 'repeats', 'part': n_repeat_words, 'whole': n_words}]) AS r
  FROM judged
), levels AS (
  SELECT rid, doc_id, stratum, base_failed, r.rule AS rule,
         len(list_filter([50, 40, 30, 25, 20, 15, 12, 10, 8, 6, 5, 4, 3, 2, 1], lambda c: 100 * r.part > c * r.whole)) AS above
  FROM parts
), truth AS (
  SELECT doc_id, min(quality) AS quality FROM labels WHERE quality IS NOT NULL GROUP BY doc_id
), held AS (
  SELECT stratum, rule, above, quality FROM levels JOIN truth USING (doc_id) WHERE NOT base_failed
), chains AS (
  SELECT stratum, rule, count(*) FILTER (quality = 1) AS n_good, count(*) FILTER (quality = 0) AS n_bad FROM held GROUP BY ALL
), tried AS (
  SELECT c.*, l.above, (SELECT count(*) FROM chains) AS chains,
         count(*) FILTER (h.quality = 1 AND h.above >= l.above) AS k_good,
         count(*) FILTER (h.quality = 0 AND h.above >= l.above) AS k_bad
  FROM chains c JOIN held h USING (stratum, rule) CROSS JOIN (SELECT unnest(range(1, 16)) AS above) l
  GROUP BY ALL
), tested AS (
  SELECT *, CASE WHEN k_good >= n_good * 0.01 THEN 1.0 ELSE
    list_sum(list_transform(range(0, k_good + 1), lambda i:
      exp(lgamma(n_good + 1) - lgamma(i + 1) - lgamma(n_good - i + 1) + i * ln(0.01) + (n_good - i) * ln(0.99)))) END AS tail
  FROM tried
), cutoffs AS (
  SELECT stratum, rule, arg_max(above, (k_bad * n_good - k_good * n_bad) * 100 + above) AS least
  FROM tested WHERE tail <= 0.05 / chains AND k_bad * n_good - k_good * n_bad > 0 GROUP BY ALL
), over AS (
  SELECT DISTINCT rid FROM levels JOIN cutoffs USING (stratum, rule) WHERE above >= least
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND rid NOT IN (SELECT rid FROM over) AS kept
FROM judged
"""

NEAR_DUPLICATES = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), sets AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' ')) END) AS s
  FROM split
), sizes AS (
  SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id
), common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM sets x JOIN sets y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common c JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c.n >= 80 * (x.n + y.n - c.n)
), both_ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach(a, b) AS (
  SELECT a, b FROM both_ways UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a
), least AS (
  SELECT a, min(b) AS b FROM reach GROUP BY a
)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(b, d.doc_id)) AS component_id,
       d.doc_id = least(d.doc_id, coalesce(b, d.doc_id)) AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN least ON a = d.doc_id
"""

NEAR_VECTORS = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.vec_id <> y.vec_id
  WHERE list_cosine_similarity(x.e, y.e) >= 0.98
), reach(a, b) AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), least AS (
  SELECT a, min(b) AS b FROM reach GROUP BY a
), degree AS (
  SELECT a, count(*) AS n FROM links GROUP BY a
)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(b, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(b, vec_id)) AS kept
FROM embeddings LEFT JOIN degree d ON d.a = vec_id LEFT JOIN least l ON l.a = vec_id
"""

AUDIT = r"""
WITH said AS (
  SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), read AS (
  SELECT d.doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
  FROM documents d LEFT JOIN said s ON d.doc_id = s.doc_id
), split AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS least FROM read
), failing AS (
  SELECT part, good, toxic,
         (len(words) < 200)::INT + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::INT
         + 4 * (100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 3 * length(text))::INT
         + 8 * regexp_matches(text, '[#$%&*|]')::INT + 16 * coalesce(doc_id > least, false)::INT AS mask
  FROM split
), cells AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM failing GROUP BY ALL
), f(letter, bit) AS (
  VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)
), orders AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM f a, f b, f c, f d, f e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
    AND len(list_distinct([a.bit, b.bit, c.bit, d.bit, e.bit])) = 5
), steps AS (
  SELECT filter_order, step::INT AS step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before
  FROM orders, range(1, 6) r(step)
), counted AS (
  SELECT part, filter_order, step, bit,
         coalesce(sum(n) FILTER (mask & (before | bit) = 0), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (mask & before = 0 AND mask & bit <> 0), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (mask & before <> 0 AND mask & bit <> 0), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (mask = bit), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER (mask & before = 0 AND mask & bit <> 0), 0)::BIGINT AS good_lost,
         coalesce(sum(toxic) FILTER (mask & before = 0 AND mask & bit <> 0), 0)::BIGINT AS toxic_lost
  FROM cells CROSS JOIN steps GROUP BY ALL
)
SELECT * EXCLUDE (bit), (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM counted
"""

PHRASES = r"""
WITH split AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), items AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark
), windows AS (
  SELECT DISTINCT item, size, array_to_string(words[i:i + size - 1], ' ') AS w
  FROM (SELECT item, words, least(len(words), 10) AS size, unnest(range(1, len(words) - least(len(words), 10) + 2)) AS i
        FROM items WHERE len(words) > 0)
), places AS (
  SELECT rid, size, i, array_to_string(words[i:i + size - 1], ' ') AS w
  FROM (SELECT rid, words, size, unnest(range(1, len(words) - size + 2)) AS i FROM split, (SELECT DISTINCT size FROM windows))
), hits AS (
  SELECT rid, size, i, item FROM places JOIN windows USING (size, w)
), covered AS (
  SELECT rid, count(DISTINCT place) AS n FROM (SELECT rid, unnest(range(i, i + size)) AS place FROM hits) GROUP BY rid
), named AS (
  SELECT rid, count(*) AS n, string_agg(item, ',' ORDER BY item) AS joined FROM (SELECT DISTINCT rid, item FROM hits) GROUP BY rid
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(c.n, 0)::BIGINT AS n_hit, coalesce(m.n, 0)::BIGINT AS n_items,
       sha256(coalesce(joined, '')) AS items_sha256, coalesce(c.n, 0) > 0 AS contaminated
FROM split LEFT JOIN covered c USING (rid) LEFT JOIN named m USING (rid)
"""

FILL_IN_MIDDLE = r"""
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
         sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents
), cut AS (
  SELECT doc_id, text, u, len(u) AS n, ('0x' || h[17:24])::BIGINT % 100 AS h3, ('0x' || h[25:32])::BIGINT % 100 AS h4,
         ('0x' || h[1:8])::BIGINT % (len(u) + 1) AS x, ('0x' || h[9:16])::BIGINT % (len(u) + 1) AS y
  FROM drawn
), parts AS (
  SELECT doc_id, text, n, array_to_string(u[1:least(x, y)], '') AS p, array_to_string(u[least(x, y) + 1:greatest(x, y)], '') AS m,
         array_to_string(u[greatest(x, y) + 1:n], '') AS s,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 >= 90 THEN 'plain'
              WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM cut
)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(text) AS restored_sha256
FROM parts
"""

SQL: dict[str, str] = {
    "op1_url_models": URLS,
    "op4_chat_bytes": CHAT,
    "op6_certified_rules": RULES,
    "op8_superminhash": NEAR_DUPLICATES,
    "op9_epsilon_grid": NEAR_VECTORS,
    "op11_gray_walk": AUDIT,
    "op12_fm_index": PHRASES,
    "op13_fenwick_middle": FILL_IN_MIDDLE,
}
