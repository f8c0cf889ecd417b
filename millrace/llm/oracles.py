"""DuckDB SQL of the numbered operators that SQL can express."""

from __future__ import annotations

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP4 = r"""WITH t AS (SELECT DISTINCT CAST(floor(conv_id / 2) AS BIGINT) AS pair_id, CASE WHEN coalesce(conv_id % 2 = 1, false) THEN 'rejected' ELSE 'chosen' END AS side,
    coalesce(turn, -1) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations),
  s AS (SELECT *, row_number() OVER (PARTITION BY pair_id, side, turn ORDER BY role, text) AS sub FROM t),
  g AS (SELECT pair_id, turn, sub, max(CASE WHEN side = 'chosen' THEN role END) AS cr, max(CASE WHEN side = 'chosen' THEN text END) AS ct,
    max(CASE WHEN side = 'rejected' THEN role END) AS rr, max(CASE WHEN side = 'rejected' THEN text END) AS rt FROM s GROUP BY ALL),
  f AS (SELECT *, sum(CASE WHEN cr IS NOT DISTINCT FROM rr AND ct IS NOT DISTINCT FROM rt THEN 0 ELSE 1 END) OVER (PARTITION BY pair_id ORDER BY turn, sub) = 0 AS common, CAST(floor(turn / 256) AS BIGINT) AS part FROM g),
  l AS (SELECT pair_id, part, turn, sub, 'p' AS side, cr AS role, ct AS text FROM f WHERE common
    UNION ALL SELECT pair_id, part, turn, sub, 'c', cr, ct FROM f WHERE NOT common AND cr IS NOT NULL
    UNION ALL SELECT pair_id, part, turn, sub, 'r', rr, rt FROM f WHERE NOT common AND rr IS NOT NULL),
  o AS (SELECT *, '<|' || role || '|>' || chr(10) AS head FROM l),
  p AS (SELECT *, coalesce(sum(length(head) + length(text) + 8) OVER (PARTITION BY pair_id, part, side ORDER BY turn, sub ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(head) AS a FROM o),
  x AS (SELECT pair_id, part, side, count(*) AS n, string_agg(head || text || '<|end|>' || chr(10), '' ORDER BY turn, sub) AS shown,
    string_agg(CASE WHEN role = 'assistant' THEN CAST(CAST(a AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(a + length(text) AS BIGINT) AS VARCHAR) END, ',' ORDER BY turn, sub) AS spans FROM p GROUP BY ALL)
  SELECT pair_id, part, coalesce(max(CASE WHEN side = 'p' THEN n END), 0) AS n_prompt_turns, coalesce(max(CASE WHEN side = 'p' THEN shown END), '') AS prompt,
    coalesce(max(CASE WHEN side = 'c' THEN shown END), '') AS chosen, coalesce(max(CASE WHEN side = 'c' THEN spans END), '') AS chosen_spans,
    coalesce(max(CASE WHEN side = 'r' THEN shown END), '') AS rejected, coalesce(max(CASE WHEN side = 'r' THEN spans END), '') AS rejected_spans FROM x GROUP BY pair_id, part"""

_WORD = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
OP5 = rf"""WITH b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, {_WORD}) AS w FROM benchmark),
  bw AS (SELECT DISTINCT item, least(10, len(w)) AS k, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS gram FROM (SELECT *, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM b WHERE len(w) > 0)),
  d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, {_WORD}) AS w FROM documents),
  dw AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS gram FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM bw) WHERE len(w) >= k)),
  h AS (SELECT DISTINCT doc_id, i, dw.k, item FROM dw JOIN bw ON dw.k = bw.k AND dw.gram = bw.gram),
  n AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM h) GROUP BY doc_id),
  t AS (SELECT doc_id, count(DISTINCT item) AS n_items, array_to_string(list_sort(list_distinct(list(item))), ',') AS items FROM h GROUP BY doc_id)
  SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated FROM d LEFT JOIN n USING (doc_id) LEFT JOIN t USING (doc_id)"""

OP9 = rf"""WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w FROM documents),
  s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS gram FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 5, 0) + 2)) AS i FROM d WHERE len(w) > 0)),
  n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
  m AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY 1, 2),
  e AS (SELECT a, b FROM m JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
  u AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
  r AS (SELECT doc_id AS v, doc_id AS t FROM d UNION SELECT r.v, u.b FROM r JOIN u ON r.t = u.a),
  k AS (SELECT v AS doc_id, min(t) AS component_id FROM r GROUP BY v)
  SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM k LEFT JOIN n USING (doc_id)"""

OP11 = rf"""WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER.format("coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
  w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
  t AS (SELECT lang, sum(len(w)) AS n FROM w GROUP BY lang),
  g AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE len(w) >= k)),
  f AS (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 100),
  c AS (SELECT lang, k, phrase, a, cut, array_to_string(string_split(phrase, ' ')[1:cut], ' ') AS h, array_to_string(string_split(phrase, ' ')[cut + 1:k], ' ') AS e FROM (SELECT *, unnest(range(1, k)) AS cut FROM f WHERE k >= 2)),
  s AS (SELECT c.lang, c.k, c.phrase, c.a, c.cut, x.a AS l, y.a AS r, n, CAST((1000::HUGEINT * c.a * n) // (x.a::HUGEINT * y.a) AS BIGINT) AS score
    FROM c JOIN t ON t.lang = c.lang JOIN f x ON x.lang = c.lang AND x.phrase = h JOIN f y ON y.lang = c.lang AND y.phrase = e),
  b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
  d AS (SELECT b.* FROM b WHERE NOT EXISTS (SELECT 1 FROM f z WHERE z.lang = b.lang AND z.k > b.k AND z.k >= 3 AND 100 * z.a >= 100 * b.a AND contains(' ' || z.phrase || ' ', ' ' || b.phrase || ' '))),
  o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM d)
  SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score FROM o WHERE rank <= 2000"""

OP12 = r"""WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size, md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || md5(coalesce(text, ''))) AS key FROM documents),
  s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1 AS rank FROM d GROUP BY source),
  w AS (SELECT *, [3, 1, 2][rank % 3 + 1] AS weight FROM s),
  o AS (SELECT *, sum(source_size) OVER () AS total, row_number() OVER x AS i, coalesce(sum(source_size) OVER (x ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bound,
    sum(weight) OVER () - coalesce(sum(weight) OVER (x ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS free FROM w WINDOW x AS (ORDER BY source_size / weight, rank)),
  l AS (SELECT *, CAST(3 * total - 4 * bound AS DOUBLE) AS num, CAST(2 * free AS DOUBLE) AS den FROM o),
  f AS (SELECT num, den, i FROM l WHERE weight * num / den <= 2 * source_size ORDER BY i LIMIT 1),
  t AS (SELECT l.source, l.source_size, CASE WHEN f.i IS NULL OR l.i < f.i THEN CAST(2 * l.source_size AS DOUBLE) ELSE l.weight * f.num / f.den END AS target FROM l LEFT JOIN f ON true),
  p AS (SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole,
    CAST(coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
  SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CAST(size * (whole + CASE WHEN start + size / 2 < target - whole * source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM p"""

OP13 = r"""WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
  g AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
  e AS (SELECT part, len(w) < 200 AS a, 100 * len(list_distinct(w)) < 50 * len(w) AS b, 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 3 * length(text) AS c,
    regexp_matches(text, '[#$%&*|]') AS d, coalesce(t.doc_id > min(t.doc_id) OVER (PARTITION BY text), false) AS e, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic FROM t LEFT JOIN g ON t.doc_id = g.doc_id),
  f AS (SELECT *, a::INT || '' || b::INT || c::INT || d::INT || e::INT AS flags FROM e),
  n AS (SELECT part, flags, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL),
  l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
  o AS (SELECT p.x || q.x || r.x || s.x || u.x AS filter_order FROM l p, l q, l r, l s, l u WHERE len(list_distinct([p.x, q.x, r.x, s.x, u.x])) = 5),
  y AS (SELECT part, filter_order, step, n, good, toxic, flags, len(replace(flags, '0', '')) AS failed, flags[ascii(filter_order[step]) - 64] = '1' AS fails,
    list_sum([CAST(flags[ascii(filter_order[k]) - 64] AS INT) FOR k IN range(1, step)]) > 0 AS gone FROM n, o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
  z AS (SELECT part, filter_order, step, sum(CASE WHEN NOT coalesce(gone, false) AND NOT fails THEN n ELSE 0 END) AS kept, sum(CASE WHEN NOT coalesce(gone, false) AND fails THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN gone AND fails THEN n ELSE 0 END) AS redundant, sum(CASE WHEN fails AND failed = 1 THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN NOT coalesce(gone, false) AND fails THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN NOT coalesce(gone, false) AND fails THEN toxic ELSE 0 END) AS toxic_lost FROM y GROUP BY ALL),
  h AS (SELECT part, filter_order[step] AS x, sum(removed) AS shapley FROM z GROUP BY ALL)
  SELECT z.part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
    toxic_lost::BIGINT AS toxic_lost, shapley::BIGINT AS shapley FROM z JOIN h ON z.part = h.part AND h.x = filter_order[step]"""

ORACLES = {"op4_preference": OP4, "op5_decontamination": OP5, "op9_near_dedup": OP9, "op11_phrases": OP11, "op12_mixing": OP12, "op13_filter_audit": OP13}
