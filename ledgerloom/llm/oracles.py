"""Comparison SQL for the queries that SQL can express. Each reads its whole tables."""

from __future__ import annotations

from ledgerloom.llm.texts import UPPER

_BLANK = "||".join(f"chr({c})" for c in (32, 9, 10, 11, 12, 13))


def _lower(text: str) -> str:
    return f"translate({text}, '{UPPER}', '{UPPER.lower()}')"


def _words(text: str) -> str:
    return rf"regexp_extract_all({_lower(f"coalesce({text}, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _components(links: str, nodes: str) -> str:
    """node and component (least reachable node) from links in both directions."""
    return f"""SELECT node, min(other) AS component FROM (
      WITH RECURSIVE reach(node, other) AS (SELECT n, n FROM ({nodes}) UNION
        SELECT r.node, l.b FROM reach r JOIN ({links}) l ON l.a = r.other) SELECT * FROM reach) GROUP BY node"""


_DECONTAMINATE = f"""WITH b AS (SELECT item_id, w, least(len(w), 13) AS n FROM (SELECT item_id, {_words("text")} AS w FROM benchmark
      WHERE item_id IS NOT NULL) WHERE len(w) > 0),
    windows AS (SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS t
      FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM b)),
    lengths AS (SELECT DISTINCT n FROM b),
    d AS (SELECT doc_id, {_words("text")} AS w FROM documents),
    places AS (SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS t
      FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lengths WHERE len(w) >= n)),
    hits AS (SELECT doc_id, i, n, item_id FROM places JOIN windows USING (n, t)),
    hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
    items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
      FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
  SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
  FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)"""

_VALID = """SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings WHERE embedding IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0"""
_NEAR = f"""SELECT a.vec_id AS a, b.vec_id AS b FROM ({_VALID}) a JOIN ({_VALID}) b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.9"""
_EMBEDDINGS = f"""WITH links AS MATERIALIZED ({_NEAR}), groups AS ({_components("SELECT * FROM links", "SELECT DISTINCT a AS n FROM links")}),
    counts AS (SELECT a AS node, count(*) AS n FROM links GROUP BY a)
  SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(component, vec_id) AS component_id, vec_id = coalesce(component, vec_id) AS kept
  FROM embeddings LEFT JOIN counts c ON vec_id = c.node LEFT JOIN groups g ON vec_id = g.node"""

_SHINGLES = f"""SELECT DISTINCT doc_id, s FROM (SELECT doc_id, unnest(CASE WHEN len(w) = 1 THEN w
    ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s
  FROM (SELECT doc_id, list_filter(regexp_split_to_array({_lower("coalesce(text, '')")}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents))"""
_MINHASH = f"""WITH s AS MATERIALIZED ({_SHINGLES}), sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
    near AS (SELECT a, b FROM shared h JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * h.n >= 80 * (x.n + y.n - h.n)),
    links AS MATERIALIZED (SELECT a, b FROM near UNION ALL SELECT b, a FROM near),
    groups AS ({_components("SELECT * FROM links", "SELECT DISTINCT a AS n FROM links")})
  SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(component, d.doc_id) AS component_id,
    d.doc_id = coalesce(component, d.doc_id) AS kept
  FROM documents d LEFT JOIN sizes x ON x.doc_id = d.doc_id LEFT JOIN groups g ON g.node = d.doc_id"""

_LINES = f"""WITH lines AS (SELECT doc_id, line, i, {_lower(f"trim(line, {_BLANK})")} AS k FROM (SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS i
      FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))),
    refs AS (SELECT k, max(doc_id) AS last FROM lines WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3)
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
  FROM (SELECT l.*, r.last IS NOT NULL AND r.last <> l.doc_id AS gone FROM lines l LEFT JOIN refs r ON l.k = r.k) GROUP BY doc_id"""

ORACLE = {
    "op1_decontaminate": _DECONTAMINATE,
    "op3_embeddings": _EMBEDDINGS,
    "op4_minhash": _MINHASH,
    "op5_line_dedup": _LINES,
}

# Each order is played as it is defined, step by step; the potential has no part in it.
_AUDIT = r"""WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    f AS (SELECT doc_id, part, (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT
        + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t))::INT + 8 * regexp_matches(t, '[#$%&*|]')::INT
        + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)::INT AS m FROM d),
    l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS bad FROM labels GROUP BY doc_id),
    c AS (SELECT part, m, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (bad) AS bad FROM f LEFT JOIN l USING (doc_id) GROUP BY ALL),
    x AS (SELECT unnest(range(5)) AS i),
    o AS (SELECT [a.i, b.i, c.i, d.i, e.i] AS p FROM x a, x b, x c, x d, x e WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
    s AS (SELECT p, k AS step, 1 << p[k] AS bit, coalesce(list_sum(list_transform(p[1 : k - 1], lambda i: 1 << i)), 0)::BIGINT AS seen
      FROM (SELECT p, unnest([1, 2, 3, 4, 5]) AS k FROM o)),
    r AS (SELECT part, array_to_string(list_transform(p, lambda i: chr((65 + i)::INT)), '') AS filter_order, step::INT AS step, chr((65 + log2(bit)::INT)::INT) AS filter,
        coalesce(sum(n) FILTER (m & (seen | bit) = 0), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (m & bit <> 0 AND m & seen = 0), 0)::BIGINT AS removed,
        coalesce(sum(n) FILTER (m & bit <> 0 AND m & seen <> 0), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (m = bit), 0)::BIGINT AS unique_fails,
        coalesce(sum(good) FILTER (m & bit <> 0 AND m & seen = 0), 0)::BIGINT AS good_lost, coalesce(sum(bad) FILTER (m & bit <> 0 AND m & seen = 0), 0)::BIGINT AS toxic_lost
      FROM c, s GROUP BY part, p, step, bit, seen)
  SELECT *, (sum(removed) OVER (PARTITION BY part, filter))::BIGINT AS shapley FROM r"""

ORACLE["op11_filter_audit"] = _AUDIT

_NEGATIVES = """WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
      list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
      WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS score
      FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
    p AS (SELECT a, b, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5)
  SELECT p.a AS anchor_id, p.b AS positive_id, (row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.b))::INT AS rank,
    s.b AS negative_id, p.score AS positive_score, s.score AS negative_score
  FROM p JOIN s ON s.a = p.a AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
  QUALIFY rank <= 10"""

ORACLE["op12_hard_negatives"] = _NEGATIVES
