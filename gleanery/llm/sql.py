"""SQL counterparts of the queries that SQL can express, for small tables."""

from __future__ import annotations

from gleanery.llm.secrets import EXAMPLE_OWNERS, EXAMPLE_REPOSITORIES

TOP_K = """WITH v AS (
    SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e FROM embeddings
    WHERE len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5"""

_WORDS = r"""regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+')"""

WINDOWS = f"""WITH d AS (SELECT doc_id, coalesce({_WORDS.format("text")}, []) AS w FROM documents),
i AS (SELECT item_id, {_WORDS.format("text")} AS w FROM benchmark WHERE text IS NOT NULL),
sized AS (SELECT item_id, w, least(10, len(w)) AS size FROM i WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, size, array_to_string(list_slice(w, pos, pos + size - 1), ' ') AS body
    FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS pos FROM sized)),
starts AS (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS pos FROM d, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size),
hits AS (SELECT s.doc_id, s.pos, s.size, x.item_id FROM starts s JOIN windows x ON x.size = s.size AND x.body = array_to_string(list_slice(s.w, s.pos, s.pos + s.size - 1), ' ')),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(pos, pos + size)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS listed
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(c.n, 0) AS n_hit, coalesce(x.n, 0) AS n_items,
    sha256(coalesce(x.listed, '')) AS items_sha256, coalesce(c.n, 0) > 0 AS contaminated
FROM d LEFT JOIN covered c USING (doc_id) LEFT JOIN items x USING (doc_id)"""

# The patterns of the operator, with letters in either case spelled out.
_ASSIGN = (
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
)


def _found(kind: int, name: str, pattern: str, group: int, keep: str) -> str:
    return f"""SELECT doc_id, owner, repository, {kind} AS kind, '{name}' AS name, x.at AS a, x.at + length(x.m) AS b, x.v AS v FROM (
        SELECT doc_id, owner, repository, unnest([{{'at': CAST(list_sum([length(s) FOR s IN g[1:i]]) + coalesce(list_sum([length(s) FOR s IN m[1:i - 1]]), 0) AS BIGINT), 'm': m[i], 'v': v[i]}}
            FOR i IN range(1, len(m) + 1)]) AS x
        FROM (SELECT doc_id, coalesce(source, '') AS owner, coalesce(lang, '') AS repository, regexp_extract_all(text, '{pattern}') AS m,
            regexp_extract_all(text, '{pattern}', {group}) AS v, string_split_regex(text, '{pattern}') AS g FROM documents)) WHERE {keep}"""


SECRETS = f"""WITH found AS ({_found(0, "assign", _ASSIGN, 2, "length(x.v) >= 6")}
    UNION ALL {_found(1, "access", "AKIA[A-Z0-9]{16,}", 0, "true")}
    UNION ALL {_found(2, "hex", "[0-9a-f]{24,}", 0, "true")}
    UNION ALL {_found(3, "live", "[A-Za-z0-9+/_=-]{20,}", 0, "regexp_matches(x.v, '[a-z]') AND regexp_matches(x.v, '[A-Z]') AND regexp_matches(x.v, '[0-9]')")}),
owned AS (SELECT v, count(DISTINCT owner) AS owners, count(DISTINCT {{'o': owner, 'r': repository}}) AS repositories FROM found GROUP BY v),
told AS (SELECT f.*, owners, repositories, owners >= {EXAMPLE_OWNERS} OR repositories >= {EXAMPLE_REPOSITORIES} AS example FROM found f JOIN owned USING (v)),
spans AS (SELECT *, name || ':' || a || ':' || b AS listed FROM told WHERE kind < 3 OR NOT example),
by_doc AS (SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
    sha256(coalesce(string_agg(listed, ',' ORDER BY a, kind) FILTER (kind < 3), '')) AS base_sha256, string_agg(listed, ',' ORDER BY a, kind) AS spans,
    count(*) FILTER (kind = 3) AS n_live, count(*) FILTER (example) AS n_example, max(owners) AS most_owners, max(repositories) AS most_repositories FROM spans GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
    coalesce(base_sha256, sha256('')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example,
    coalesce(most_owners, 0) AS most_owners, coalesce(most_repositories, 0) AS most_repositories
FROM documents LEFT JOIN by_doc USING (doc_id)"""

JACCARD = r"""WITH RECURSIVE d AS (
    SELECT doc_id, coalesce([w FOR w IN regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') IF w <> ''], []) AS w
    FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, pos, pos + 2), ' ') AS x FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS pos FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (SELECT c.a, c.b FROM (SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS i FROM s p JOIN s q ON p.x = q.x AND p.doc_id <> q.doc_id GROUP BY ALL) c
    JOIN n na ON na.doc_id = c.a JOIN n nb ON nb.doc_id = c.b WHERE 100 * c.i >= 90 * (na.n + nb.n - c.i)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) m USING (doc_id)"""

# The checksum goes over the UTF-8 bytes of characters up to U+00FF, by the table of the reflected polynomial.
VARIANTS = r"""WITH RECURSIVE entries AS (SELECT list(list_reduce([CAST(b AS BIGINT)] || CAST(range(8) AS BIGINT[]), lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS t FROM range(256) AS r(b)),
runs AS (SELECT doc_id, w, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS w FROM documents)
    WHERE length(w) >= 6 GROUP BY ALL),
points AS (SELECT doc_id, w, n, [unicode(c) FOR c IN string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w, '')] AS p FROM runs),
octets AS (SELECT doc_id, w, n, flatten([CASE WHEN c < 128 THEN [CAST(c AS BIGINT)] ELSE [192 + (c >> 6), 128 + (c & 63)] END FOR c IN p]) AS o FROM points),
checked AS (SELECT w, n, xor(list_reduce([4294967295::BIGINT] || o, lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1])), 4294967295) AS h FROM octets, entries),
changed AS (SELECT CASE WHEN h % 199 = 0 THEN substr(w, 1, CAST(h % length(w) AS BIGINT)) || substr(w, CAST(h % length(w) AS BIGINT) + 2) ELSE w END AS word, n FROM checked),
v AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM changed WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
less AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS k FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)),
pairs AS (SELECT a.word, b.word AS other, b.n AS m FROM less a JOIN less b ON a.k = b.k AND a.i = b.i AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM v a JOIN less b ON a.word = b.k
    UNION SELECT b.word, a.word, a.n FROM v a JOIN less b ON a.word = b.k),
near AS (SELECT word, count(*) AS n_near, max(m) AS top FROM pairs GROUP BY word),
formed AS (SELECT v.word, v.n, coalesce(x.n_near, 0) AS n_near, CASE WHEN x.top >= 5 * v.n THEN x.top END AS form_n,
    CASE WHEN x.top >= 5 * v.n THEN (SELECT min(p.other) FROM pairs p WHERE p.word = v.word AND p.m = x.top) END AS form FROM v LEFT JOIN near x USING (word)),
steps AS (SELECT word, word AS at FROM formed UNION ALL SELECT s.word, f.form FROM steps s JOIN formed f ON f.word = s.at WHERE f.form IS NOT NULL),
roots AS (SELECT s.word, s.at AS root FROM steps s JOIN formed f ON f.word = s.at WHERE f.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN roots USING (word)"""

NEGATIVES = """WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e
    FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
    SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_inner_product(CAST(a.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
    FROM v a JOIN v c ON a.vec_id <> c.vec_id AND len(a.e) = len(c.e) WHERE a.vec_id % 50 = 0),
positives AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place
    FROM scored WHERE same QUALIFY place <= 5),
ranked AS (SELECT p.anchor_id, p.positive_id, row_number() OVER (PARTITION BY p.anchor_id, p.place ORDER BY s.score DESC, s.vec_id) AS rank, s.vec_id AS negative_id,
    p.positive_score, s.score AS negative_score, p.place
    FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score, CAST(place AS INTEGER) AS positive_rank FROM ranked WHERE rank <= 3"""

SQL = {
    "op4_exact_top_k": TOP_K,
    "op6_decontamination": WINDOWS,
    "op8_secret_scan": SECRETS,
    "op10_jaccard_join": JACCARD,
    "op11_spelling_variants": VARIANTS,
    "op13_hard_negatives": NEGATIVES,
}
