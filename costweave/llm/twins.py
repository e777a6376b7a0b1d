"""SQL twins that are put together from parts: conversation repair, clustering, byte dedup."""

from __future__ import annotations


def repair_sql() -> str:
    """The programme as a recursive query that carries, for each state, the cheapest way so far."""
    kind = "STRUCT(c BIGINT, a VARCHAR, o VARCHAR[])[]"

    def insert(ways, *roles):
        for role in roles:
            ways = f"list_transform({ways}, lambda w: {{'c': w.c + 3, 'a': w.a || 'I', 'o': list_append(w.o, '{role}:')}})"
        return ways

    def consume(ways, letter, cost, role=None):
        out = f"list_append(w.o, {role} || ':' || text)" if role else "w.o"
        return f"list_transform({ways}, lambda w: {{'c': w.c + {cost}, 'a': w.a || '{letter}', 'o': {out}}})"

    def when(test, ways):
        return f"CASE WHEN {test} THEN {ways} ELSE [] END"

    def least(*ways):
        joined = "flatten([" + ", ".join(ways) + "])"
        return f"(CASE WHEN len({joined}) > 0 THEN [list_min({joined})] ELSE [] END)::{kind}"

    open_ = "coalesce(fault, '') NOT IN ('blank', 'duplicate')"
    more = "(CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END)"
    before_user = "flatten([s0, s1, p3])"

    def keep(letter, ways):
        return when(f"{open_} AND left(role, 1) = '{letter}'", consume(ways, "K", more, "role"))

    def rerole(role, ways):
        return when(open_, consume(ways, "R", f"3 + {more}", f"'{role}'"))

    p2 = f"flatten([s2, {insert('s0', 'user')}, {insert('s1', 'user')}, {insert('s3', 'user')}, {insert('s2', 'assistant', 'user')}])"
    p3 = (f"flatten([s3, {insert('s2', 'assistant')}, {insert('s0', 'user', 'assistant')}, "
          f"{insert('s1', 'user', 'assistant')}, {insert('s3', 'user', 'assistant')}])")
    return rf"""
    WITH RECURSIVE crc_table AS (
        SELECT list_transform(range(256), lambda n: list_reduce(
            [n::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0],
            lambda c, z: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS t),
    drawn AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               xor(list_reduce(
                   list_prepend(4294967295::BIGINT, list_transform(
                       string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
                       lambda s: ord(s)::BIGINT)),
                   lambda c, b: xor(c >> 8, t[(xor(c, b) & 255)::INT + 1])), 4294967295) % 20 AS f
        FROM conversations, crc_table),
    damaged AS (
        SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
               CASE f WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
        FROM drawn, unnest(range(CASE f WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS u(copy)),
    placed AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
               rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS ended
        FROM damaged),
    turns AS (
        SELECT *, CASE WHEN ended = '' THEN 'blank'
                       WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                       WHEN right(ended, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
               lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair
        FROM placed),
    counted AS (
        SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
               count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
               count(*) FILTER (fault = 'truncated') AS truncated,
               count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal
        FROM turns GROUP BY conv_id),
    ways AS (
        SELECT conv_id, 0::BIGINT AS i, [{{'c': 0, 'a': '', 'o': []}}]::{kind} AS s0,
               []::{kind} AS s1, []::{kind} AS s2, []::{kind} AS s3 FROM counted
        UNION ALL
        SELECT conv_id, i,
               {least(consume('s0', 'D', 4))},
               {least(consume('s1', 'D', 4), keep('s', 's0'))},
               {least(consume('p2', 'D', 4), keep('u', before_user), rerole('user', before_user))},
               {least(consume('p3', 'D', 4), keep('a', 'p2'), rerole('assistant', 'p2'))}
        FROM (SELECT w.conv_id, r.i, role, text, fault, s0, s1, s2, s3, {p2} AS p2, {p3} AS p3
              FROM ways w JOIN turns r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i + 1)),
    ended AS (
        SELECT w.conv_id, list_min(flatten([s0, s3, {insert('s2', 'assistant')}, {insert('s1', 'user', 'assistant')}])) AS best
        FROM ways w JOIN counted c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.n = w.i)
    SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
           coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost,
           coalesce(best.a, '') AS audit, sha256(coalesce(array_to_string(best.o, chr(10)), '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) a
    LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM a.conv_id
    LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM a.conv_id
    """


def cluster_sql(rounds: int = 10, k: int = 8) -> str:
    """Plain distances to every centroid, round after round."""
    start = r"""
    WITH kept AS (
        SELECT row_number() OVER () AS r, vec_id,
               list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
        FROM embeddings
        WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
    c0 AS MATERIALIZED (
        SELECT row_number() OVER (ORDER BY sha256('3:' || coalesce(vec_id::VARCHAR, '')), v) - 1 AS c, v
        FROM kept QUALIFY c < %d)""" % k
    square = "list_sum(list_transform(list_zip(k.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT"
    parts = [start]
    for i in range(rounds + 1):
        parts.append(f"""
    a{i} AS MATERIALIZED (
        SELECT r, vec_id, k.v AS v, min({{'d': {square}, 'c': c.c}}) AS near
        FROM kept k, c{i} c GROUP BY r, vec_id, k.v)""")
        if i < rounds:
            parts.append(f"""
    c{i + 1} AS MATERIALIZED (
        SELECT c.c, coalesce(m.v, c.v) AS v FROM c{i} c LEFT JOIN (
            SELECT c, list(mean ORDER BY j) AS v FROM (
                SELECT near.c AS c, j,
                       ((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS mean
                FROM (SELECT near, unnest(v) AS x, generate_subscripts(v, 1) AS j FROM a{i}) GROUP BY near.c, j)
            GROUP BY c) m ON m.c = c.c)""")
    return ",".join(parts) + f"""
    SELECT vec_id, near.c::INT AS cluster, near.d AS distance,
           sum(near.d) OVER (PARTITION BY near.c)::BIGINT AS cluster_inertia, sum(near.d) OVER ()::BIGINT AS inertia,
           sha256(array_to_string(c{rounds}.v, ',')) AS centroid_sha256
    FROM a{rounds} JOIN c{rounds} ON c{rounds}.c = near.c
    """


#: The hash of every string of 400 bytes; blocks of 1,024 starts keep slicing cheap.
BYTE_DEDUP = r"""
    WITH rows AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
    texts AS (SELECT b, octet_length(b) AS size, count(*) AS n, row_number() OVER () AS t FROM rows GROUP BY b),
    blocks AS (
        SELECT t, n, low, b[low + 1:low + 1423] AS piece FROM texts, unnest(range(0, size - 399, 1024)) AS u(low)),
    starts AS (
        SELECT t, n, low + j AS s, md5(piece[j + 1:j + 400]) AS w
        FROM blocks, unnest(range(0, least(1024, octet_length(piece) - 399))) AS v(j)),
    again AS (SELECT w FROM starts GROUP BY w HAVING sum(n) > 1),
    found AS (
        SELECT t, s, coalesce(s - lag(s) OVER (PARTITION BY t ORDER BY s) > 400, true) AS opens
        FROM starts SEMI JOIN again USING (w)),
    numbered AS (SELECT t, s, count(*) FILTER (opens) OVER (PARTITION BY t ORDER BY s) AS span FROM found),
    removed AS (SELECT t, span, min(s) AS low, max(s) + 400 AS high FROM numbered GROUP BY t, span),
    kept_before AS (
        SELECT t, low, high, coalesce(lag(high) OVER (PARTITION BY t ORDER BY low), 0) AS upto FROM removed),
    cut AS (
        SELECT t, count(*) AS n_spans, sum(high - low) AS n_removed, max(high) AS last,
               string_agg(hex(b[upto + 1:low]), '' ORDER BY low) AS front
        FROM kept_before JOIN texts USING (t) GROUP BY t)
    SELECT doc_id, size AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0) AS n_spans,
           CASE WHEN n_spans IS NULL THEN sha256(rows.b) ELSE sha256(unhex(front || hex(rows.b[last + 1:size]))) END AS kept_sha256
    FROM rows JOIN texts ON texts.b = rows.b LEFT JOIN cut USING (t)
"""
