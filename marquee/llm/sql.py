"""The same results as DuckDB SQL, where SQL can express the operator."""

from __future__ import annotations

_BLANKS = r"[\x20\x09-\x0D]+"
_ASSIGN = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""


def _spans(kinds: list[tuple[str, str, int]]) -> str:
    """CTE ``spans``: every match of each (kind, pattern, group) with its place, in code points."""
    hits = "\nUNION ALL\n".join(
        f"SELECT doc_id, owner, repository, t, '{kind}' AS kind, {place} AS place, string_split_regex(t, '{pattern}') AS gaps,"
        f" regexp_extract_all(t, '{pattern}') AS found, regexp_extract_all(t, '{pattern}', {group}) AS vals FROM texts"
        for place, (kind, pattern, group) in enumerate(kinds)
    )
    return f"""
texts AS (
    SELECT doc_id, coalesce(text, '') AS t, coalesce(source, '') AS owner,
           coalesce(source, '') || '/' || coalesce(lang, '') AS repository
    FROM documents
), hits AS ({hits}), numbered AS (
    SELECT *, unnest(generate_series(1, len(found))) AS i FROM hits WHERE len(found) > 0
), spans AS (
    SELECT doc_id, owner, repository, t, kind, place, vals[i] AS val,
           (list_sum(list_transform(gaps[1:i], lambda g: length(g)))
            + coalesce(list_sum(list_transform(found[1:i - 1], lambda f: length(f))), 0))::BIGINT AS s,
           (list_sum(list_transform(gaps[1:i], lambda g: length(g)))
            + list_sum(list_transform(found[1:i], lambda f: length(f))))::BIGINT AS e
    FROM numbered
)"""


_OP1 = f"""
WITH {_spans([("assign", _ASSIGN, 2), ("access", "AKIA[A-Z0-9]+", 0), ("hex", "[0-9a-f]+", 0)])},
good AS (
    SELECT * FROM spans
    WHERE length(val) >= CASE kind WHEN 'assign' THEN 8 WHEN 'access' THEN 16 ELSE 32 END
), owners AS (
    SELECT val, count(DISTINCT owner) AS n_owners, count(DISTINCT (owner, repository)) AS n_repositories FROM good GROUP BY val
), judged AS (
    SELECT doc_id, e - length(val) AS s, e,
           CASE WHEN n_owners > 2 THEN 'copied'
                WHEN len(list_distinct(string_split(val, ''))) >= 6
                     AND NOT regexp_matches(val, '(?i)example|changeme|placeholder|your_|dummy|xxxx|1234567') THEN 'live' END AS kind,
           good.kind AS of, n_owners, n_repositories
    FROM good JOIN owners USING (val)
), listed AS (
    SELECT doc_id, s, place, kind, e FROM good
    UNION ALL
    SELECT DISTINCT doc_id, s, CASE kind WHEN 'live' THEN 3 ELSE 4 END, kind, e FROM judged WHERE kind IS NOT NULL
), joined AS (
    SELECT doc_id, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, place, e) AS spans,
           string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, place, e) FILTER (place < 3) AS base,
           count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
           count(*) FILTER (kind = 'hex') AS n_hex
    FROM listed GROUP BY doc_id
), verdicts AS (
    SELECT doc_id, count(*) FILTER (kind = 'live') AS n_live, count(*) FILTER (kind = 'copied') AS n_copied,
           max(n_repositories) AS n_repositories, max(n_owners) AS n_owners
    FROM judged GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
       coalesce(n_live, 0) AS n_live, coalesce(n_copied, 0) AS n_copied,
       coalesce(n_repositories, 0) AS n_repositories, coalesce(n_owners, 0) AS n_owners
FROM documents d LEFT JOIN joined USING (doc_id) LEFT JOIN verdicts USING (doc_id)
"""

_NEAR = "lower(substr(t, greatest(s - 40, 0) + 1, s - greatest(s - 40, 0)) || ' ' || substr(t, e + 1, 40))"
_OP9 = rf"""
WITH {_spans([
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", 0),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", 0),
    ("card", r"[0-9]([\x20-]?[0-9])+", 0),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 0),
    ("iban", r"[A-Z]{2}[0-9]{2}(?:(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?|[A-Z0-9]{11,30})", 0),
])},
figured AS (
    SELECT *, regexp_replace(val, '[^0-9]', '', 'g') AS figures, replace(val, ' ', '') AS code FROM spans
), good AS (
    SELECT * FROM figured WHERE CASE kind
        WHEN 'email' THEN true
        WHEN 'ip' THEN list_bool_and(list_transform(string_split(val, '.'), lambda p: length(ltrim(p, '0')) <= 3
                       AND coalesce(try_cast(ltrim(p, '0') AS INT), 0) <= 255))
        WHEN 'card' THEN length(figures) BETWEEN 13 AND 19 AND list_sum(list_transform(range(length(figures)),
                       lambda i: CASE WHEN i % 2 = 0 THEN figures[length(figures) - i]::INT
                                 WHEN figures[length(figures) - i]::INT > 4 THEN figures[length(figures) - i]::INT * 2 - 9
                                 ELSE figures[length(figures) - i]::INT * 2 END)) % 10 = 0
        WHEN 'phone' THEN length(figures) BETWEEN 9 AND 15
        ELSE NOT regexp_matches(CASE WHEN s > 0 THEN substr(t, s, 1) ELSE '' END || substr(t, e + 1, 1), '[A-Za-z0-9]')
             AND array_to_string(list_transform(string_split(substr(code, 5) || substr(code, 1, 4), ''),
                       lambda c: CASE WHEN c BETWEEN 'A' AND 'Z' THEN (ascii(c) - 55)::VARCHAR ELSE c END), '')::HUGEINT % 97 = 1 END
), scored AS (
    SELECT doc_id, kind, place, s, e, round(least(greatest(
        CASE kind WHEN 'email' THEN 0.7 WHEN 'ip' THEN 0.4 WHEN 'card' THEN 0.6 WHEN 'phone' THEN 0.5 ELSE 0.7 END::DOUBLE
        + CASE WHEN regexp_matches({_NEAR}, CASE kind WHEN 'email' THEN 'mail|contact|write to|address'
               WHEN 'ip' THEN '\bip\b|server|host|login|logged' WHEN 'card' THEN 'card|visa|credit|payment|cvv'
               WHEN 'phone' THEN 'phone|call|mobile|fax|tel' ELSE 'iban|account|bank|transfer' END) THEN 0.25 ELSE 0.0 END::DOUBLE
        - CASE WHEN regexp_matches({_NEAR}, 'example|sample|test|dummy|version') THEN 0.3 ELSE 0.0 END::DOUBLE, 0.0), 1.0), 2) AS score
    FROM good
), joined AS (
    SELECT doc_id, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY place, s) AS spans,
           string_agg(kind || ':' || s || ':' || e, ',' ORDER BY place, s) FILTER (kind <> 'iban') AS base,
           string_agg(score::VARCHAR, ',' ORDER BY place, s) AS scores, max(score) AS top_score,
           count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip,
           count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone,
           count(*) FILTER (kind = 'iban') AS n_iban
    FROM scored GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card,
       coalesce(n_phone, 0) AS n_phone, coalesce(n_iban, 0) AS n_iban, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans, coalesce(scores, '') AS scores, top_score
FROM documents d LEFT JOIN joined USING (doc_id)
"""

_OP4 = rf"""
WITH texts AS (
    SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '{_BLANKS}', ' ', 'g')) AS text_sha256 FROM documents
), answers AS (
    SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM texts GROUP BY text_sha256
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM texts JOIN answers USING (text_sha256)
"""

_OP7 = r"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
           md5(coalesce(doc_id::VARCHAR, '') || ':0') AS key
    FROM documents
), sources AS (
    SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
    FROM sized GROUP BY source
), weighed AS (
    SELECT *, place % 3 + 1 AS weight, sum(source_size) OVER ()::BIGINT AS total FROM sources
), levels AS (
    SELECT *, (total - 3 * coalesce(sum(source_size) OVER (ORDER BY source_size / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT)
           / (sum(weight) OVER ()::BIGINT - coalesce(sum(weight) OVER (ORDER BY source_size / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT) AS level
    FROM weighed
), cuts AS (
    SELECT *, 3 * source_size < level * weight AS cut FROM levels
), shares AS (
    SELECT *, CASE WHEN cut THEN (3 * source_size)::DOUBLE
                   ELSE (SELECT level FROM cuts WHERE NOT cut ORDER BY source_size / weight, place LIMIT 1) * weight END AS target
    FROM cuts
), bounds AS (
    SELECT *, sum(target) OVER (ORDER BY place ROWS UNBOUNDED PRECEDING) / nullif(total, 0) AS upper FROM shares
), tiled AS (
    SELECT *, coalesce(lag(upper) OVER (ORDER BY place), 0) AS lower FROM bounds
), points AS (
    SELECT (n % 1134903170) * 701408733 % 1134903170 / 1134903170.0::DOUBLE AS point
    FROM range((SELECT (ceil(max(total) / 256) + ceil(max(total) / 256 / 16) + 64 * count(*))::BIGINT FROM shares)) r(n)
), dealt AS (
    SELECT place, count(point)::BIGINT AS slots FROM tiled LEFT JOIN points ON point >= lower AND point < upper AND target > 0 GROUP BY place
), placed AS (
    SELECT doc_id, size, s.place, source_size, target, least(slots * 256, round(target)::BIGINT) AS stop,
           coalesce(sum(size) OVER (PARTITION BY s.place ORDER BY key, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS first
    FROM sized JOIN tiled s ON sized.source IS NOT DISTINCT FROM s.source JOIN dealt USING (place)
)
SELECT doc_id, size, source_size, target,
       (greatest(least(first + size, stop) - first, 0)
        + greatest(least(first + size + source_size, stop) - first - source_size, 0)
        + greatest(least(first + size + 2 * source_size, stop) - first - 2 * source_size, 0))::BIGINT AS taken
FROM placed
"""

_OP8 = r"""
WITH rows AS (
    SELECT DISTINCT doc_id, coalesce(text, '') AS text FROM documents
), split AS (
    SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM rows
), windows AS (
    SELECT doc_id, text, i - 1 AS place, lines[i:i + 2] AS w
    FROM (SELECT *, unnest(generate_series(1, len(lines) - 2)) AS i FROM split WHERE len(lines) >= 3)
    WHERE trim(array_to_string(lines[i:i + 2], ''), ' ') <> ''
), ordered AS (
    SELECT *, row_number() OVER (PARTITION BY w ORDER BY doc_id NULLS FIRST, place) AS nth FROM windows
), covered AS (
    SELECT DISTINCT doc_id, text, place + k AS line FROM ordered, range(3) r(k) WHERE nth > 1
), marked AS (
    SELECT doc_id, text, line, line - row_number() OVER (PARTITION BY doc_id, text ORDER BY line) AS island FROM covered
), islands AS (
    SELECT doc_id, text, min(line) AS first, max(line) AS last, count(*) AS n, list(line) AS gone FROM marked GROUP BY doc_id, text, island
), gone AS (
    SELECT doc_id, text, string_agg(first || '-' || last, ',' ORDER BY first) AS removed, sum(n)::BIGINT AS n_removed, flatten(list(gone)) AS gone
    FROM islands GROUP BY doc_id, text
)
SELECT d.doc_id, len(string_split(coalesce(d.text, ''), chr(10)))::BIGINT AS n_lines, coalesce(n_removed, 0) AS n_removed,
       coalesce(removed, '') AS removed,
       CASE WHEN gone IS NULL THEN coalesce(d.text, '') ELSE array_to_string(list_transform(list_filter(
           list_zip(string_split(d.text, chr(10)), range(len(string_split(d.text, chr(10))))), lambda p: NOT list_contains(gone, p[2])), lambda p: p[1]), chr(10)) END AS text
FROM documents d LEFT JOIN gone g ON d.doc_id IS NOT DISTINCT FROM g.doc_id AND coalesce(d.text, '') = g.text
"""

_OP12 = r"""
WITH split AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), items AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), windows AS (
    SELECT DISTINCT item_id, n, array_to_string(w[s:s + n - 1], ' ') AS content
    FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS s FROM items WHERE len(w) > 0)
), met AS (
    SELECT DISTINCT doc_id, s, d.n, item_id
    FROM (SELECT doc_id, s, n, array_to_string(w[s:s + n - 1], ' ') AS content
          FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS s
                FROM split, (SELECT DISTINCT n FROM windows))) d
    JOIN windows USING (content, n)
), hit AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit
    FROM (SELECT doc_id, unnest(generate_series(s, s + n - 1)) AS place FROM met) GROUP BY doc_id
), listed AS (
    SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS name FROM met) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM split LEFT JOIN hit USING (doc_id) LEFT JOIN listed USING (doc_id)
"""


def _clusters(rounds: int = 5, clusters: int = 40) -> str:
    """The rounds one after another: ``c0`` to ``c5`` hold the centroids, component by component."""
    steps = [
        f"""
kept AS (
    SELECT vec_id, embedding FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), v AS (
    SELECT vec_id, place, floor(256 * component::DOUBLE)::BIGINT AS x
    FROM (SELECT vec_id, unnest(embedding) AS component, generate_subscripts(embedding, 1) AS place FROM kept)
), c0 AS (
    SELECT number, place, x FROM v
    JOIN (SELECT vec_id, row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS number FROM kept) USING (vec_id)
    WHERE number < {clusters}
)"""
    ]
    for place in range(rounds + 1):
        steps.append(
            f"""a{place} AS MATERIALIZED (
    SELECT vec_id, arg_min(number, (distance, number)) AS number, min(distance) AS distance
    FROM (SELECT vec_id, number, sum((v.x - c.x) * (v.x - c.x))::BIGINT AS distance
          FROM v JOIN c{place} c USING (place) GROUP BY vec_id, number)
    GROUP BY vec_id
)"""
        )
        if place < rounds:
            steps.append(
                f"""c{place + 1} AS MATERIALIZED (
    SELECT number, place, coalesce(moved, c{place}.x) AS x FROM c{place}
    LEFT JOIN (SELECT number, place, ((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS moved
               FROM v JOIN a{place} USING (vec_id) GROUP BY number, place) USING (number, place)
)"""
            )
    return (
        "WITH "
        + ", ".join(steps)
        + f"""
SELECT vec_id, number::INT AS cluster, distance, (sum(distance) OVER (PARTITION BY number))::BIGINT AS cluster_inertia,
       (sum(distance) OVER ())::BIGINT AS inertia, centroid_sha256
FROM a{rounds} JOIN (SELECT number, sha256(string_agg(x::VARCHAR, ',' ORDER BY place)) AS centroid_sha256 FROM c{rounds} GROUP BY number) USING (number)
"""
    )


SQL = {
    "op1_secret_scan": _OP1,
    "op4_exact_dedup": _OP4,
    "op7_source_mix": _OP7,
    "op8_line_dedup": _OP8,
    "op9_personal_data": _OP9,
    "op12_decontamination": _OP12,
    "op13_centroids": _clusters(),
}
