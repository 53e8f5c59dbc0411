"""DuckDB SQL of the operators that it can express over small tables.

These compare everything with everything or hold every window of every text: they say
what is right and are no way to run over large tables.
"""

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Bytes of UTF-8 characters in hexadecimal; what it does not match belongs to a character cut in half.
_MORE = "[89AB]."
_WHOLE = "|".join((
    "[0-7].", f"(?:C[2-9A-F]|D.){_MORE}", f"(?:E0[AB].|E[1-9A-CEF]{_MORE}|ED[89].){_MORE}", f"(?:F0[9AB].|F[1-3]{_MORE}|F48.){_MORE}{_MORE}",
))
REPEATS_SQL = f"""WITH t AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
 s AS (SELECT r, i, sha256(substring(x, 2 * i + 1, 800)) AS key FROM (SELECT r, x, unnest(range(0, len(x) // 2 - 399)) AS i FROM t)),
 hit AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY key) AS n FROM s) WHERE n > 1),
 run AS (SELECT r, min(i) AS a, max(i) + 400 AS b FROM (SELECT r, i, sum(CASE WHEN i <= p + 400 THEN 0 ELSE 1 END) OVER (PARTITION BY r ORDER BY i) AS g
  FROM (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS p FROM hit)) GROUP BY r, g),
 gap AS (SELECT r, a, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS z FROM (SELECT r, a, b FROM run UNION ALL SELECT r, len(x) // 2, NULL FROM t)),
 rest AS (SELECT r, coalesce(string_agg(substring(x, 2 * z + 1, 2 * (a - z)), '' ORDER BY a), '') AS y FROM gap JOIN t USING (r) WHERE a > z GROUP BY r),
 gone AS (SELECT r, sum(b - a) AS removed, count(*) AS spans FROM run GROUP BY r)
 SELECT doc_id, CAST(len(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(spans, 0) AS BIGINT) AS n_spans,
 sha256(unhex(coalesce(y, ''))) AS kept_sha256, decode(unhex(regexp_replace(coalesce(y, ''), '({_WHOLE})|..', '\\1', 'g'))) AS text
 FROM t LEFT JOIN rest USING (r) LEFT JOIN gone USING (r)"""

#: The five primes of XXH64.
_P1, _P2, _P3, _P4, _P5 = 11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261
_M = 1 << 64


def _u(x: int) -> str:
    return f"{x}::UHUGEINT"


def _times(x: str, p: int) -> str:
    return f"(({x}) * {_u(p)} % {_u(_M)})"


def _plus(*x: str) -> str:
    return f"(({' + '.join(x)}) % {_u(_M)})"


def _turned(x: str, n: int) -> str:
    return f"list_transform([({x}) * {_u(1 << n)}], lambda v: v % {_u(_M)} + v // {_u(_M)})[1]"


def _round(h: str, k: str) -> str:
    return _times(_turned(_plus(h, _times(k, _P2)), 31), _P1)


def _mixed(h: str, n: int) -> str:
    return f"list_transform([{h}], lambda v: xor(v, v // {_u(1 << n)}))[1]"


def _word(x: str, at: str, n: int) -> str:
    """The n bytes of the hexadecimal x from at on, the lowest first."""
    return f"CAST('0x' || {' || '.join(f'substr({x}, 2 * ({at} + {k}) + 1, 2)' for k in reversed(range(n)))} AS UHUGEINT)"


def _xxh64(seed: int) -> str:
    """WITH members from s(x), distinct hexadecimal strings, to hashed(x, h)."""
    start = [(seed + _P1 + _P2) % _M, (seed + _P2) % _M, seed, (seed - _P1) % _M]
    lane = [f"list_reduce(list_transform(range(0, n // 32), lambda k: {_word('x', f'(32 * k + {8 * j})', 8)}), lambda h, k: {_round('h', 'k')}, {_u(v)})" for j, v in enumerate(start)]
    joined = _plus(*(_turned(f"v{j}", r) for j, r in enumerate((1, 7, 12, 18))))
    for j in range(4):
        joined = _plus(_times(f"xor({joined}, {_round(_u(0), f'v{j}')})", _P1), _u(_P4))
    eight = _plus(_times(_turned(f"xor(h, {_round(_u(0), 'k')})", 27), _P1), _u(_P4))
    four = _plus(_times(_turned(f"xor(h, {_times('k', _P1)})", 23), _P2), _u(_P3))
    one = _times(_turned(f"xor(h, {_times('k', _P5)})", 11), _P1)
    end = _mixed(_times(_mixed(_times(_mixed("h", 33), _P2), 29), _P3), 32)
    return f""" lanes AS (SELECT x, n, {', '.join(f'{v} AS v{j}' for j, v in enumerate(lane))} FROM (SELECT x, len(x) // 2 AS n FROM s)),
 begun AS (SELECT x, n, {_plus(f"CASE WHEN n >= 32 THEN {joined} ELSE {_u((seed + _P5) % _M)} END", 'n::UHUGEINT')} AS h FROM lanes),
 by8 AS (SELECT x, n, list_reduce(list_transform(range(n // 32 * 4, n // 8), lambda k: {_word('x', '(8 * k)', 8)}), lambda h, k: {eight}, h) AS h FROM begun),
 by4 AS (SELECT x, n, CASE WHEN n % 8 >= 4 THEN list_transform([{_word('x', '(n // 8 * 8)', 4)}], lambda k: {four})[1] ELSE h END AS h FROM by8),
 by1 AS (SELECT x, list_reduce(list_transform(range(n // 4 * 4, n), lambda k: {_word('x', 'k', 1)}), lambda h, k: {one}, h) AS h FROM by4),
 hashed AS (SELECT x, CAST({end} AS UBIGINT) AS h FROM by1)"""


SIMHASH_SQL = f"""WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id,
 regexp_extract_all({_LOWERED}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
 c AS (SELECT r, hex(encode(array_to_string(w[i : i + 2], ' '))) AS x FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
 s AS (SELECT DISTINCT x FROM c),
{_xxh64(42)},
 bits AS (SELECT r, {' + '.join(f'CASE WHEN 2 * sum(h // {1 << b}::UBIGINT % 2) > count(*) THEN {1 << b}::UBIGINT ELSE 0::UBIGINT END' for b in range(64))} AS f FROM c JOIN hashed USING (x) GROUP BY r),
 p AS (SELECT doc_id, coalesce(f, 0::UBIGINT) AS f FROM d LEFT JOIN bits USING (r)),
 u AS (SELECT f, min(doc_id) AS least FROM p GROUP BY f),
 link AS (SELECT a.f AS a, b.f AS b FROM u AS a, u AS b WHERE bit_count(CAST(xor(a.f, b.f) AS BIT)) <= 3),
 reach AS (SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
 root AS (SELECT reach.a AS f, min(u.least) AS component_id FROM reach JOIN u ON u.f = reach.b GROUP BY reach.a)
 SELECT doc_id, lower(lpad(hex(f), 16, '0')) AS fingerprint, component_id FROM p JOIN root USING (f)"""


LINKS_SQL = """WITH RECURSIVE e AS (SELECT row_number() OVER () AS r, vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
 fine AS (SELECT r, vec_id, list_transform(v, lambda x: coalesce(x, 0) / sqrt(list_sum(list_transform(v, lambda y: y * y)))) AS v FROM e
  WHERE len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0),
 link AS (SELECT a.r AS a, b.r AS b FROM fine AS a JOIN fine AS b ON len(a.v) = len(b.v) AND a.r <> b.r WHERE list_dot_product(a.v, b.v) >= 0.9),
 reach AS (SELECT r AS a, r AS b FROM e UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
 root AS (SELECT reach.a AS r, min(vec_id) AS component_id FROM reach JOIN e ON e.r = reach.b GROUP BY reach.a)
 SELECT vec_id, (SELECT count(*) FROM link WHERE a = e.r) AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept FROM e JOIN root USING (r)"""


def _clusters_sql(k: int = 40, rounds: int = 5, size: int = 64) -> str:
    """Each round as two common tables: the nearest centroids and the next ones."""
    parts = [
        f"e AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        f"v AS MATERIALIZED (SELECT r, i, CAST(floor(256 * CAST(embedding[i] AS DOUBLE)) AS BIGINT) AS x FROM e, range(1, {size + 1}) t(i))",
        f"s AS (SELECT r, row_number() OVER (ORDER BY sha256('2:' || vec_id), r) - 1 AS k FROM e QUALIFY k < {k})",
        "c0 AS MATERIALIZED (SELECT k, i, x AS y FROM s JOIN v USING (r))",
    ]
    for n in range(rounds + 1):
        parts.append(f"a{n} AS MATERIALIZED (SELECT r, min(m) % {k} AS k, min(m) // {k} AS d FROM (SELECT r, k, CAST(sum((x - y) * (x - y)) AS BIGINT) * {k} + k AS m FROM v JOIN c{n} USING (i) GROUP BY r, k) GROUP BY r)")
        if n < rounds:
            mean = f"SELECT k, i, CAST(sum(x) AS BIGINT) AS t, count(*) AS n FROM v JOIN a{n} USING (r) GROUP BY k, i"
            parts.append(f"c{n + 1} AS MATERIALIZED (SELECT k, i, coalesce((t - ((t % n) + n) % n) // n, y) AS y FROM c{n} LEFT JOIN ({mean}) USING (k, i))")
    parts.append(f"h AS (SELECT k, sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY i)) AS h FROM c{rounds} GROUP BY k)")
    out = "SELECT vec_id, CAST(k AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia, h AS centroid_sha256"
    return f"WITH {', '.join(parts)} {out} FROM e JOIN a{rounds} USING (r) JOIN h USING (k)"


CLUSTERS_SQL = _clusters_sql()


DIVERGENCE_SQL = r"""WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
 t AS MATERIALIZED (SELECT lang, source, term, count(*) AS n, count(DISTINCT r) AS docs FROM (SELECT r, lang, source, unnest(w) AS term FROM d) GROUP BY ALL),
 k AS MATERIALIZED (SELECT lang, term, CAST(sum(n) AS HUGEINT) AS n FROM t GROUP BY ALL HAVING sum(docs) >= 10),
 v AS (SELECT lang, count(*) AS v, sum(n) AS n FROM k GROUP BY ALL),
 g AS MATERIALIZED (SELECT DISTINCT lang, source FROM d),
 c AS (SELECT g.lang, g.source, k.term, k.n AS whole, CAST(coalesce(t.n, 0) AS HUGEINT) AS n FROM g JOIN k USING (lang) LEFT JOIN t USING (lang, source, term)),
 p AS MATERIALIZED (SELECT c.lang, c.source, term, c.n, 1 + (1000000000 * (c.n + 2)) // (sum(c.n) OVER (PARTITION BY c.lang, c.source) + 2 * v.v) AS p, 1 + (1000000000 * (whole + 2)) // (v.n + 2 * v.v) AS q FROM c JOIN v USING (lang)),
 f AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value FROM p a JOIN p b USING (lang, term) WHERE a.source <> b.source GROUP BY ALL),
 o AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM p WHERE n > 0 AND p > q)
 SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM o QUALIFY part = 'pair' OR rank <= 10"""
