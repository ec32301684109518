"""The same queries as SQL for a single-node engine."""

from __future__ import annotations

from ..functions.sentiment import WORD
from ..functions.values import MISSING
from ..functions.words import ENGLISH_STOP_WORDS, INTENSITY, NEGATORS, POLARITY
from ..plans.search import KEYWORD, LISTS
from ..schemas import FOREIGN_KEYS, MAX_LENGTHS, PRIMARY_KEYS, TABLES
from .queries import ALLOWED_DOMAINS, DISTRIBUTOR, INDEXED_PHRASES, INDEXED_WORDS, NEXT_TEXT, PERSON, SEARCHED, SIMILAR_TITLE, SOURCE, TAG, TITLE


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _in(words: tuple[str, ...]) -> str:
    return "(" + ", ".join(_quoted(word) for word in words) + ")"


def _values(entries: dict[str, float]) -> str:
    return ", ".join(f"({_quoted(word)}, CAST({weight} AS DECIMAL(4,2)))" for word, weight in entries.items())


STOP = _in(ENGLISH_STOP_WORDS)
NORMAL = "lower(regexp_replace(text, '[^a-zA-Z\\s]', '', 'g'))"
TOKENS = f"string_split_regex(regexp_replace({NORMAL}, '\\s+$', ''), '\\s')"

# Words one per row, their two predecessors by window, then the mean rounded half up in whole numbers.
SENTIMENT = f"""
lexicon(word, weight) AS (VALUES {_values(POLARITY)}),
intensity(word, factor) AS (VALUES {_values(INTENSITY)}),
doc_words AS (
  SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos
  FROM (SELECT doc_id, regexp_extract_all(lower(text), {_quoted(WORD)}) AS words FROM documents)),
in_context AS (
  SELECT doc_id, word, lag(word, 1) OVER w AS p1, lag(word, 2) OVER w AS p2
  FROM doc_words WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
hits AS (
  SELECT doc_id, greatest(-1, least(1, weight * coalesce(factor, CAST(1 AS DECIMAL(4,2)))
    * CASE WHEN (CASE WHEN factor IS NULL THEN p1 ELSE p2 END) IN {_in(NEGATORS)}
      THEN CAST(-0.5 AS DECIMAL(2,1)) ELSE CAST(1.0 AS DECIMAL(2,1)) END)) AS score
  FROM in_context c JOIN lexicon l ON l.word = c.word LEFT JOIN intensity i ON i.word = c.p1),
totals AS (
  SELECT doc_id, CAST(sum(CAST(score AS DECIMAL(8,5))) * 100000 AS BIGINT) AS t, count(*) * 100 AS d FROM hits GROUP BY doc_id),
scored AS (
  SELECT x.*, CAST(coalesce(CAST(sign(t) * ((2 * abs(t) + d) // (2 * d)) AS DECIMAL(10,0)), 0) * CAST(0.001 AS DECIMAL(4,3))
    AS DECIMAL(4,3)) AS polarity
  FROM documents x LEFT JOIN totals USING (doc_id))"""

LABEL = "CASE WHEN polarity < -0.3 THEN 'Negative' WHEN polarity < 0.3 THEN 'Neutral' ELSE 'Positive' END"


def _mean_and_verdict(group: str, source: str) -> str:
    return f"""
    SELECT {group}, n_reviews, polarity_mean,
      CASE WHEN polarity_mean > 0.3 THEN 'Positive' WHEN polarity_mean > -0.3 THEN 'Neutral' ELSE 'Negative' END AS verdict
    FROM (SELECT {group}, count(*) AS n_reviews,
            CAST(round_even(CAST(sum(polarity) AS DOUBLE) / count(*), 3) AS DECIMAL(4,3)) AS polarity_mean
          FROM {source} GROUP BY {group})"""


REVIEW_TYPE = "CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 'Critic Review' ELSE 'User Review' END"

# The relational model over the given tables, and over the records made from parts.
MODEL = f"""{SENTIMENT},
movies AS (
  SELECT p_partkey AS movie_id, p_name AS title, release_date, p_brand AS distributor, p_type AS ratings,
    p_size AS runtime, p_type || ' ' || p_brand AS summary, CAST(p_size / 5 AS DECIMAL(3,1)) AS m_u_score,
    TRY_CAST(p_retailprice / 100 AS DECIMAL(3,1)) AS m_c_score, 'https://img.example.com/' || p_partkey AS image
  FROM part LEFT JOIN (SELECT l_partkey AS p_partkey, min(CAST(l_shipdate AS DATE)) AS release_date
                       FROM lineitem GROUP BY l_partkey) USING (p_partkey)),
actors AS (SELECT s_suppkey AS actor_id, s_name AS name FROM supplier),
directors AS (SELECT s_suppkey AS director_id, s_name AS name FROM supplier),
plays_in AS (SELECT DISTINCT l_partkey AS movie_id, l_suppkey AS actor_id FROM lineitem),
directed AS (SELECT DISTINCT movie_id, director_id FROM (
  SELECT l_partkey AS movie_id, min(l_suppkey) AS director_id FROM lineitem GROUP BY l_partkey, l_returnflag)),
part_tags AS (SELECT p_partkey AS movie_id, unnest(string_split(p_name, ' ')) AS genre_type FROM part),
genres AS (
  SELECT DISTINCT dense_rank() OVER (ORDER BY lower(genre_type), genre_type) AS genre_id, genre_type FROM part_tags),
movie_genre AS (SELECT DISTINCT movie_id, genre_id FROM part_tags JOIN genres USING (genre_type)),
stream_links AS (SELECT page_id AS movie_id, url FROM pages),
critic_reviews AS (
  SELECT doc_id AS critic_id, text AS c_c_review, text AS c_review,
    CAST((n_chars % 100) / 10 AS DECIMAL(3,1)) AS c_score, polarity
  FROM scored WHERE doc_id IN (SELECT doc_id FROM labels)),
user_reviews AS (
  SELECT doc_id AS review_id, text AS u_c_review, text AS u_review, source AS username,
    CAST(n_chars % 11 AS DECIMAL(3,1)) AS u_score, polarity
  FROM scored WHERE doc_id NOT IN (SELECT doc_id FROM labels)),
critique AS (SELECT critic_id AS movie_id, critic_id FROM critic_reviews),
reviews AS (SELECT review_id AS movie_id, review_id FROM user_reviews)"""

RECORDS = """
records AS (
  SELECT p_partkey AS id, p_name AS title, p_brand AS distributor,
    CASE WHEN p_size % 7 <> 0 THEN CAST(DATE '1995-01-01' + p_size * 30 AS DATE) END AS date,
    ['Actor ' || p_size, p_type, p_type] AS starring, [p_brand] AS director, string_split(p_name, ' ') AS genres,
    CASE WHEN p_size % 5 <> 0 THEN p_size END AS runtime, p_type, p_type || ' ' || p_brand AS summary, p_size
  FROM part),
cleaned AS (
  SELECT doc_id, source || ' ' || doc_id AS reviewer_name, text, CASE WHEN lang = 'es' THEN 'Otra ' || title ELSE title END AS title,
    CASE WHEN lang <> 'fr' THEN date END AS date, doc_id IN (SELECT doc_id FROM labels) AS critic
  FROM documents LEFT JOIN records ON id = doc_id),
linked AS (
  SELECT c.*, (SELECT min(id) FROM records r WHERE r.title = c.title AND (c.date IS NULL OR r.date = c.date)) AS movie_id
  FROM cleaned c)"""


def _names(field: str) -> str:
    _, dim, bridge, key, name = next(row for row in LISTS if row[0] == field)
    return f"""coalesce((SELECT string_agg(d.{name}, ',' ORDER BY d.{key}) FROM {bridge} b JOIN {dim} d USING ({key})
      WHERE b.movie_id = m.movie_id), {_quoted(MISSING)}) AS {field}s"""


NAME_LISTS = ", ".join(_names(row[0]) for row in LISTS)


def _found(field: str) -> str:
    word = _quoted(SEARCHED[field].lower())
    for name, dim, bridge, key, column in LISTS:
        if name == field:
            return f"""SELECT DISTINCT m.* FROM movies m, {bridge} b, {dim} d
              WHERE m.movie_id = b.movie_id AND b.{key} = d.{key} AND contains(lower(d.{column}), {word})"""
    return f"SELECT * FROM movies WHERE contains(lower({field}), {word})"


def _search(field: str) -> str:
    return f"""WITH {MODEL}, found AS ({_found(field)})
    SELECT row_number() OVER (ORDER BY release_date DESC NULLS LAST, movie_id) AS num, m.movie_id, CAST(0 AS BIGINT) AS page,
      title, release_date, distributor, {NAME_LISTS}, ratings, runtime, m_c_score, m_u_score, summary, image
    FROM found m"""


def _search_order(name: str, column: str) -> str:
    return f"""SELECT '{name}' AS sorted_by, row_number() OVER (ORDER BY {column} DESC NULLS LAST, movie_id) AS rank,
      movie_id AS p_partkey FROM movies"""


def _check(check: str, table: str, columns: str, violations: str) -> str:
    return f"""SELECT '{check}' AS "check", '{table}' AS "table", '{columns}' AS "columns", count(*) AS violations
      FROM ({violations})"""


def _checks() -> str:
    parts = []
    for table, keys in PRIMARY_KEYS.items():
        columns = ",".join(keys)
        parts.append(_check("primary key", table, columns, f"SELECT {columns} FROM {table} GROUP BY {columns} HAVING count(*) > 1"))
    for child, key, parent in FOREIGN_KEYS:
        parts.append(_check("foreign key", child, key, f"""SELECT DISTINCT {key} FROM {child} c
          WHERE {key} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{key} = c.{key})"""))
    for table, limits in MAX_LENGTHS.items():
        for column, limit in limits.items():
            parts.append(_check("length", table, column, f"SELECT 1 FROM {table} WHERE length({column}) > {limit}"))
    return " UNION ALL ".join(parts)


# Brute force: every pair of items with a common token.
def _similar(items: str) -> str:
    return f"""
items AS ({items}),
item_tokens AS (
  SELECT item, token, count(*) AS tf
  FROM (SELECT item, unnest(regexp_extract_all(lower(title), '\\w\\w+')) AS token FROM items)
  WHERE token NOT IN {STOP} GROUP BY item, token),
token_idf AS (
  SELECT token, count(*) AS df,
    CAST(ln((1.0::DOUBLE + (SELECT count(*) FROM items)) / (1.0::DOUBLE + count(*))) + 1 AS DECIMAL(16,7)) AS idf
  FROM item_tokens GROUP BY token),
weights AS (SELECT item, token, CAST(tf * idf AS DECIMAL(16,7)) AS weight FROM item_tokens JOIN token_idf USING (token)),
squares AS (SELECT item, CAST(sum(weight * weight) AS DOUBLE) AS square FROM weights GROUP BY item),
dots AS (
  SELECT a.item, b.item AS other, CAST(sum(a.weight * b.weight) AS DOUBLE) AS dot
  FROM weights a JOIN weights b USING (token) GROUP BY a.item, b.item),
pairs AS (
  SELECT d.item, d.other, d.dot / (sqrt(s.square) * sqrt(o.square)) AS score
  FROM dots d JOIN squares s ON s.item = d.item JOIN squares o ON o.item = d.other)"""


SIMILAR = _similar("SELECT p_partkey AS item, p_name AS title FROM part")
CAST_SIMILAR = _similar(
    "SELECT p_partkey AS item, (SELECT string_agg(DISTINCT s_name, ' ') FROM lineitem JOIN supplier ON s_suppkey = l_suppkey"
    " WHERE l_partkey = p_partkey) AS title FROM part"
)

LINKS = """
links AS (
  SELECT page_id, url, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS href FROM pages),
resolved AS (
  SELECT page_id, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || href AS abs_url FROM links)"""

GIVEN_PAGES = """
parsed AS (
  SELECT page_id, url, nullif(trim(replace(regexp_extract(html, '<title>([^<]*)</title>', 1), '&amp;', '&')), '') AS distributor,
    coalesce(nullif(trim(replace(regexp_extract(html, '<article><h1>([^<]*)</h1>', 1), '&amp;', '&')), ''),
      nullif(trim(replace(regexp_extract(html, '<title>([^<]*)</title>', 1), '&amp;', '&')), '')) AS title,
    nullif(trim(replace(regexp_extract(html, '<div class="ad">([^<]*)</div>', 1), '&amp;', '&')), '') AS summary,
    list_transform(list_zip(regexp_extract_all(regexp_extract(html, '<nav>(.*?)</nav>', 1), '<a href="([^"]*)">', 1),
      regexp_extract_all(regexp_extract(html, '<nav>(.*?)</nav>', 1), '<a href="[^"]*">([^<]*)</a>', 1)),
      lambda z: {'h': replace(z[1], '&amp;', '&'), 'x': replace(z[2], '&amp;', '&')}) AS entries
  FROM pages)"""

ORDER_CATALOG = """
reviews_in AS (
  SELECT DISTINCT l_orderkey, l_linenumber, o_custkey AS title,
    CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS date
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey)"""

ORACLE: dict[str, str] = {
    "normalise_text": f"SELECT doc_id, trim({NORMAL}, ' \t\r\n') AS t FROM documents",
    "tokenise": f"SELECT doc_id, token, count(*) AS n FROM (SELECT doc_id, unnest({TOKENS}) AS token FROM documents) GROUP BY doc_id, token",
    "clean_text": f"""SELECT doc_id, array_to_string(list_filter({TOKENS}, lambda w: w NOT IN {STOP}), ' ') AS review_clean
      FROM documents""",
    "sentiment_doc": f"WITH {SENTIMENT} SELECT doc_id, polarity FROM scored",
    "sentiment_label": f"WITH {SENTIMENT} SELECT doc_id, {LABEL} AS label FROM scored",
    "sentiment_verdict": f"WITH {SENTIMENT} {_mean_and_verdict('source', 'scored')}",
    "movie_sentiment": f"WITH {MODEL} {_mean_and_verdict('movie_id', '(SELECT movie_id, polarity FROM reviews JOIN user_reviews USING (review_id))')}",
    "review_stats": f"""WITH {SENTIMENT}, typed AS (
        SELECT {REVIEW_TYPE} AS kind, polarity, CAST(n_chars % 101 AS DOUBLE) AS score FROM scored)
      SELECT coalesce(kind, 'all') AS review_type, count(*) AS n, min(polarity) AS min_sentiment, max(polarity) AS max_sentiment,
        round(CAST(sum(polarity) AS DOUBLE) / count(polarity), 6) AS avg_sentiment,
        min(score) AS min_score, max(score) AS max_score, round(sum(score) / count(score), 6) AS avg_score
      FROM typed GROUP BY ROLLUP (kind)""",
    "label_distribution": f"""WITH {SENTIMENT}, labelled AS (SELECT source, {LABEL} AS label FROM scored)
      SELECT source, count(*) FILTER (label = 'Positive') AS positive, count(*) FILTER (label = 'Neutral') AS mixed,
        count(*) FILTER (label = 'Negative') AS negative FROM labelled GROUP BY source""",
    "review_projection": "SELECT doc_id, lang, source FROM documents",
    "parse_date": """WITH texts AS (
        SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'TBA' ELSE strftime(o_orderdate, '%B %-d, %Y') END AS s FROM orders)
      SELECT o_orderkey, strftime(try_strptime(s, '%B %d, %Y'), '%Y-%m-%d') AS d, try_strptime(s, '%B %d, %Y') IS NULL AS is_undated
      FROM texts""",
    "parse_score": """WITH texts AS (
        SELECT p_partkey, CASE WHEN p_size % 7 = 0 THEN 'tbd' ELSE CAST(p_size * 2 AS VARCHAR) END AS s FROM part)
      SELECT p_partkey, TRY_CAST(TRY_CAST(s AS DOUBLE) / 10 AS DECIMAL(3,1)) AS score10, TRY_CAST(s AS BIGINT) AS whole,
        round(TRY_CAST(s AS DOUBLE) / 7, 3) AS rounded FROM texts""",
    "parse_minutes": """SELECT p_partkey, TRY_CAST(split_part(CASE WHEN p_size % 5 <> 0 THEN p_size || ' min' END, ' ', 1) AS INTEGER)
      AS minutes FROM part""",
    "host_of_url": "SELECT page_id, split_part(url, '/', 3) AS host FROM pages",
    "na_labels": f"""SELECT p_partkey, coalesce(nullif(p_brand, 'Brand#12'), {_quoted(MISSING)}) AS brand,
        coalesce(s_name, {_quoted(MISSING)}) AS supplier
      FROM part LEFT JOIN (SELECT l_partkey, min(l_suppkey) AS s FROM lineitem GROUP BY 1) ON l_partkey = p_partkey
      LEFT JOIN supplier ON s_suppkey = s""",
    "tag_normalise": "SELECT p_partkey AS id, replace(replace(p_name, 'small', 'SciFi'), 'red', 'Noir') AS tag FROM part",
    "json_fields": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
    "nested_flatten": """SELECT p_partkey AS id, p_name AS title, replace(p_name, ' ', ',') AS genres,
      CAST(p_size * 2 AS VARCHAR) AS meta_score_score,
      CASE WHEN p_size % 7 = 0 THEN 'tbd' ELSE CAST(p_size / 5 AS VARCHAR) END AS user_score_score FROM part""",
    "explode_distinct": f"""WITH {RECORDS}
      SELECT DISTINCT 'actors' AS kind, unnest(starring) AS name FROM records UNION ALL
      SELECT DISTINCT 'directors', unnest(director) FROM records UNION ALL
      SELECT DISTINCT 'genres', unnest(genres) FROM records""",
    "dim_keys": f"WITH {MODEL} SELECT genre_id, genre_type FROM genres",
    "bridge": f"WITH {MODEL} SELECT movie_id AS p_partkey, genre_id FROM movie_genre",
    "review_keys": """SELECT row_number() OVER (ORDER BY src, id, turn NULLS FIRST) AS review_id, * FROM (
      SELECT 'documents' AS src, doc_id AS id, CAST(NULL AS BIGINT) AS turn, CAST(length(text) AS INTEGER) AS text_len FROM documents
      UNION ALL SELECT 'conversations', conv_id, turn, CAST(length(text) AS INTEGER) FROM conversations)""",
    "pk_violations": "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1",
    "fk_orphans": "SELECT doc_id, count(*) AS n FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) GROUP BY doc_id",
    "length_violations": "SELECT page_id, CAST(length(url) AS INTEGER) AS n FROM pages WHERE length(url) > 40",
    "range_violations": "SELECT c_custkey, c_acctbal FROM customer WHERE TRY_CAST(c_acctbal AS DECIMAL(5,2)) IS NULL AND c_acctbal IS NOT NULL",
    "model_checks": f"WITH {MODEL} {_checks()}",
    "match_review": f"""WITH {ORDER_CATALOG}
      SELECT l_orderkey, l_linenumber, min(o_orderkey) AS matched_orderkey FROM reviews_in LEFT JOIN orders
        ON o_custkey = title AND (date IS NULL OR CAST(o_orderdate AS DATE) = date) GROUP BY l_orderkey, l_linenumber""",
    "match_unmatched": f"""WITH {ORDER_CATALOG}
      SELECT l_orderkey, l_linenumber FROM reviews_in WHERE NOT EXISTS (
        SELECT 1 FROM orders WHERE o_orderstatus = 'F' AND o_custkey = title AND (date IS NULL OR CAST(o_orderdate AS DATE) = date))""",
    "rank_lookup": """WITH ranks AS (SELECT p_name, max(p_partkey) AS rank FROM part WHERE p_type = 'PROMO' GROUP BY p_name)
      SELECT p_partkey, CASE WHEN row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) = 1 THEN coalesce(rank, -1) ELSE -1 END AS rank
      FROM part LEFT JOIN ranks USING (p_name)""",
    "star_schema": f"""WITH {RECORDS}
      SELECT DISTINCT 'directed' AS link, id AS movie_id, unnest(director) AS value FROM records UNION ALL
      SELECT DISTINCT 'plays_in', id, unnest(starring) FROM records UNION ALL
      SELECT DISTINCT 'movie_genre', id, unnest(genres) FROM records UNION ALL
      SELECT 'reviews', movie_id, reviewer_name FROM linked WHERE NOT critic AND movie_id IS NOT NULL UNION ALL
      SELECT 'critique', movie_id, md5(text) FROM linked WHERE critic AND movie_id IS NOT NULL UNION ALL
      SELECT 'stream_links', id, 'https://play.example.com/' || id FROM records""",
    "star_movies": f"""WITH {RECORDS}
      SELECT id AS movie_id, title, date AS release_date, distributor, p_type AS ratings, runtime, summary,
        CASE WHEN p_size % 7 <> 0 THEN CAST(p_size / 5 AS DECIMAL(3,1)) END AS m_u_score,
        TRY_CAST(p_size * 2 / 10 AS DECIMAL(3,1)) AS m_c_score, 'https://img.example.com/' || id AS image FROM records""",
    "model_counts": f"""WITH {RECORDS}
      SELECT 'movies' AS name, count(*) AS n FROM records UNION ALL
      SELECT 'actors', count(DISTINCT v) FROM (SELECT unnest(starring) AS v FROM records) UNION ALL
      SELECT 'directors', count(DISTINCT v) FROM (SELECT unnest(director) AS v FROM records) UNION ALL
      SELECT 'genres', count(DISTINCT v) FROM (SELECT unnest(genres) AS v FROM records) UNION ALL
      SELECT 'user_reviews', count(*) FROM cleaned WHERE NOT critic UNION ALL
      SELECT 'critic_reviews', count(*) FROM cleaned WHERE critic UNION ALL
      SELECT 'total_reviews', count(*) FROM cleaned UNION ALL
      SELECT 'movies_without_date', count(*) FROM records WHERE date IS NULL UNION ALL
      SELECT 'unmatched_reviews', count(*) FROM linked WHERE movie_id IS NULL""",
    "table_counts": f"WITH {MODEL} " + " UNION ALL ".join(
        f"SELECT '{name}' AS name, count(*) AS n FROM {name}" for name in ("movies", "actors", "directors", "user_reviews", "critique")
    ),
    "names_of_item": f"""SELECT p_partkey, coalesce(names, {_quoted(MISSING)}) AS names FROM part LEFT JOIN (
        SELECT l_partkey, string_agg(s_name, ',' ORDER BY s_name) AS names
        FROM (SELECT DISTINCT l_partkey, s_name FROM lineitem JOIN supplier ON s_suppkey = l_suppkey) GROUP BY l_partkey)
      ON l_partkey = p_partkey""",
    "names_paged": f"""WITH pairs AS (SELECT DISTINCT l_partkey, l_suppkey, s_name FROM lineitem JOIN supplier ON s_suppkey = l_suppkey),
      placed AS (SELECT *, (row_number() OVER (PARTITION BY l_partkey ORDER BY l_suppkey) - 1) // 10 AS page FROM pairs)
      SELECT p_partkey, coalesce(page, 0) AS page, coalesce(names, {_quoted(MISSING)}) AS names FROM part LEFT JOIN (
        SELECT l_partkey, page, string_agg(s_name, ',' ORDER BY l_suppkey) AS names FROM placed GROUP BY l_partkey, page)
      ON l_partkey = p_partkey""",
    "names_of_title": f"""WITH {MODEL}
      SELECT row_number() OVER (ORDER BY lower(name), name, d.director_id, m.movie_id) AS num, d.director_id, name
      FROM movies m JOIN directed USING (movie_id) JOIN directors d USING (director_id) WHERE lower(title) = lower({_quoted(TITLE)})""",
    "items_of_name": f"""WITH {MODEL}
      SELECT row_number() OVER (ORDER BY lower(title), title, m.movie_id) AS num, m.movie_id AS p_partkey, title AS p_name
      FROM movies m JOIN plays_in USING (movie_id) JOIN actors USING (actor_id) WHERE lower(name) = lower({_quoted(PERSON)})""",
    "items_of_tag": f"""WITH {MODEL}
      SELECT row_number() OVER (ORDER BY lower(title), title, m.movie_id) AS num, m.movie_id AS p_partkey, title AS p_name
      FROM movies m JOIN movie_genre USING (movie_id) JOIN genres USING (genre_id) WHERE lower(genre_type) = lower({_quoted(TAG)})
      ORDER BY num LIMIT 25""",
    "items_by_brand": f"""WITH {MODEL}
      SELECT row_number() OVER (ORDER BY lower(title), title, movie_id) AS num, movie_id AS p_partkey, title AS p_name
      FROM movies WHERE lower(distributor) = lower({_quoted(DISTRIBUTOR)}) ORDER BY num LIMIT 20""",
    "reviews_of_item": f"""WITH {SENTIMENT}
      SELECT row_number() OVER (ORDER BY polarity DESC NULLS LAST, doc_id) AS num, doc_id, polarity FROM scored
      WHERE source = {_quoted(SOURCE)}""",
    "user_reviews_of_title": f"""WITH {MODEL}
      SELECT row_number() OVER (ORDER BY u_score DESC NULLS LAST, review_id) AS num, review_id, username, u_score, polarity
      FROM movies JOIN reviews USING (movie_id) JOIN user_reviews USING (review_id) WHERE lower(title) = lower({_quoted(TITLE)})""",
    "critic_reviews_of_title": f"""WITH {MODEL}
      SELECT row_number() OVER (ORDER BY polarity DESC NULLS LAST, critic_id) AS num, critic_id, c_score, polarity
      FROM movies JOIN critique USING (movie_id) JOIN critic_reviews USING (critic_id) WHERE lower(title) = lower({_quoted(TITLE)})""",
    "genre_list": f"""WITH {MODEL}
      SELECT row_number() OVER (ORDER BY lower(genre_type), genre_type) AS num, genre_id, genre_type FROM genres""",
    "image_links": f"""WITH {MODEL}
      SELECT min(movie_id) AS movie_id, arg_min(image, movie_id) AS image FROM movies GROUP BY title""",
    "id_title_lookup": "SELECT p_name AS title, min(p_partkey) AS first_id FROM part GROUP BY p_name",
    "title_of_id": "SELECT doc_id AS movie_id, p_name AS title FROM documents LEFT JOIN part ON p_partkey = doc_id",
    "title_positions": """WITH placed AS (SELECT p_name, file_row_number AS i FROM (
        SELECT p_name, row_number() OVER (ORDER BY p_partkey) - 1 AS file_row_number FROM part))
      SELECT p_name AS title, min(i) AS index, p_name AS found FROM placed GROUP BY p_name""",
    "links_of_movies": "SELECT page_id AS movie_id, url, split_part(url, '/', 3) AS host FROM pages",
    "clean_feed": f"""WITH {SENTIMENT}, {RECORDS}
      SELECT CAST(c.doc_id AS VARCHAR) AS reviewer_name, c.title AS movie_name, CASE WHEN lang <> 'fr' AND c.title IS NOT NULL THEN coalesce(strftime(c.date, '%B %-d, %Y'), 'TBA') END AS release_date,
        {REVIEW_TYPE.replace("doc_id IN", "c.doc_id IN")} AS review_type, CAST(n_chars % 10 AS VARCHAR) AS review_score,
        array_to_string(list_filter({TOKENS.replace("text", "scored.text")}, lambda w: w NOT IN {STOP}), ' ') AS review_clean, polarity AS sentiment_score
      FROM cleaned c JOIN scored ON scored.doc_id = c.doc_id""",
    "keyword_check": f"SELECT conv_id, turn, regexp_matches(text, {_quoted(KEYWORD)}) AS ok FROM conversations",
    **{f"search_{field}": _search(field) for field in SEARCHED},
    "search_order": f"WITH {MODEL} " + " UNION ALL ".join(
        _search_order(name, column)
        for name, column in (("release_date", "release_date"), ("metacritic_score", "m_c_score"), ("user_score", "m_u_score"))
    ),
    "search_count": f"WITH {MODEL} " + " UNION ALL ".join(
        f"SELECT '{field}' AS name, count(*) AS n FROM ({_found(field)})" for field in SEARCHED
    ),
    "text_search": """SELECT * FROM (
        SELECT 'documents' AS source, doc_id AS id, text FROM documents UNION ALL
        SELECT 'conversations', conv_id, text FROM conversations UNION ALL
        SELECT 'benchmark', item_id, text FROM benchmark) WHERE contains(lower(text), 'the')""",
    "feed_union": """SELECT CASE WHEN role = 'user' THEN 'User Review' ELSE 'Critic Review' END AS review_type, conv_id, turn,
      CASE WHEN role = 'user' THEN role END AS reviewer FROM conversations""",
    "idf": f"WITH {SIMILAR} SELECT token, df, round(CAST(idf AS DOUBLE), 6) AS idf FROM token_idf",
    "tfidf": f"""WITH {SIMILAR} SELECT item, token, round(CAST(weight AS DOUBLE) / sqrt(square), 6) AS weight
      FROM weights JOIN squares USING (item)""",
    "cosine": f"""WITH {SIMILAR} SELECT item, other, round(score, 6) AS score FROM pairs
      WHERE item = (SELECT min(item) FROM items WHERE title = {_quoted(SIMILAR_TITLE)}) AND other <> item""",
    "similar_title": f"""WITH {SIMILAR}
      SELECT row_number() OVER (ORDER BY p.score DESC, other) AS rk, other, round(p.score, 6) AS score
      FROM pairs p JOIN items o ON o.item = other
      WHERE p.item = (SELECT min(item) FROM items WHERE title = {_quoted(SIMILAR_TITLE)}) AND o.title <> {_quoted(SIMILAR_TITLE)}
      ORDER BY rk LIMIT 10""",
    "similar_topk": f"""WITH {SIMILAR}
      SELECT item, other, round(score, 6) AS score, CAST(rk AS INTEGER) AS rk FROM (
        SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, other) AS rk FROM pairs WHERE item <> other)
      WHERE rk <= 10""",
    "similar_wide": f"""WITH {CAST_SIMILAR}
      SELECT item, other, round(score, 6) AS score, CAST(rk AS INTEGER) AS rk FROM (
        SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, other) AS rk FROM pairs WHERE item <> other)
      WHERE rk <= 10""",
    "detail_wide": f"""WITH {CAST_SIMILAR}
      SELECT item AS movie_id, string_agg(CAST(other AS VARCHAR), '|' ORDER BY rk) AS similar FROM (
        SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, other) AS rk FROM pairs WHERE item <> other)
      WHERE rk <= 5 GROUP BY item""",
    "detail_flat": f"""WITH {MODEL}, {SIMILAR},
      best AS (
        SELECT item AS movie_id, string_agg(CAST(other AS VARCHAR), '|' ORDER BY rk) AS similar_movie_id FROM (
          SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, other) AS rk FROM pairs WHERE item <> other)
        WHERE rk <= 5 GROUP BY item)
      SELECT m.movie_id, CAST(0 AS BIGINT) AS page, title, {NAME_LISTS}, m_u_score, m_c_score, split_part(url, '/', 3) AS links_host,
        similar_movie_id, CASE WHEN critic_id IS NOT NULL THEN (SELECT {LABEL} FROM scored WHERE doc_id = critic_id)
          WHEN review_id IS NOT NULL THEN '' END AS critic_reviews_label,
        CASE WHEN review_id IS NOT NULL THEN username WHEN critic_id IS NOT NULL THEN '' END AS user_reviews_reviewer,
        CASE WHEN review_id IS NOT NULL THEN CAST(u.polarity AS VARCHAR) WHEN critic_id IS NOT NULL THEN '' END AS user_reviews_polarity
      FROM movies m LEFT JOIN stream_links USING (movie_id) LEFT JOIN best USING (movie_id)
        LEFT JOIN critique USING (movie_id) LEFT JOIN reviews USING (movie_id) LEFT JOIN user_reviews u USING (review_id)""",
    "page_fields": """SELECT page_id, nullif(regexp_extract(html, '<title>([^<]*)</title>', 1), '') AS title,
      coalesce(nullif(regexp_extract(html, '<h1>([^<]*)</h1>', 1), ''), nullif(regexp_extract(html, '<title>([^<]*)</title>', 1), '')) AS h1,
      CAST(len(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS INTEGER) AS n_links FROM pages""",
    "page_records": f"""WITH {GIVEN_PAGES}
      SELECT CAST(CASE WHEN page_id = min(page_id) OVER (PARTITION BY title) THEN max(page_id) OVER (PARTITION BY title) ELSE -1 END AS BIGINT) AS id,
        title, distributor, summary, 'Not Rated' AS rating, starring, stream_link
      FROM (SELECT *, array_to_string(list_transform(entries, lambda e: e.x), '|') AS starring,
        array_to_string(list_transform(entries, lambda e: e.h), '|') AS stream_link FROM parsed)""",
    "page_scores": f"""WITH {GIVEN_PAGES}
      SELECT page_id, entries[1].x AS first, entries[2].x AS second,
        regexp_extract(url, '^([a-zA-Z]+://[^/?#]*)', 1) || entries[1].h AS link FROM parsed""",
    "page_reviews": f"""WITH {GIVEN_PAGES}, entries AS (SELECT distributor AS movie_name, unnest(entries) AS e FROM parsed)
      SELECT 'Critic Review' AS review_type, movie_name, NULL::VARCHAR AS reviewer_name, e.x AS review FROM entries
      UNION ALL SELECT 'User Review', movie_name, e.h, e.x FROM entries""",
    "page_blocks": """WITH bodies AS (SELECT page_id, regexp_extract_all(html, '(?s)<p>(.*?)</p>', 1) AS b FROM pages)
      SELECT * FROM (SELECT page_id, CAST(unnest(range(len(b))) AS INTEGER) AS pos, trim(unnest(b), ' \t\r\n') AS paragraph FROM bodies)
      WHERE paragraph <> ''""",
    "page_pairs": """WITH lists AS (SELECT page_id, regexp_extract_all(html, '<li><a href="([^"]*)">', 1) AS h,
        regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a></li>', 1) AS x FROM pages)
      SELECT page_id, CAST(unnest(range(greatest(len(h), len(x)))) AS INTEGER) AS pos, unnest(h) AS href, unnest(x) AS text FROM lists""",
    "page_links": f"WITH {LINKS} SELECT page_id, href FROM links",
    "resolve_links": f"WITH {LINKS} SELECT page_id, abs_url FROM resolved",
    "link_domains": f"""WITH {LINKS}, hosts AS (SELECT split_part(abs_url, '/', 3) AS host FROM resolved)
      SELECT host, count(*) AS n FROM hosts WHERE """
    + " OR ".join(f"host = '{domain}' OR ends_with(host, '.{domain}')" for domain in ALLOWED_DOMAINS)
    + " GROUP BY host",
    "frontier": f"WITH {LINKS} SELECT DISTINCT abs_url FROM resolved WHERE abs_url NOT IN (SELECT regexp_replace(url, '#.*$', '') FROM pages)",
    "next_pages": f"""WITH found AS (
        SELECT page_id, url, nullif(regexp_extract(html, '<a href="([^"]*)">{NEXT_TEXT}</a>', 1), '') AS href FROM pages)
      SELECT page_id, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || href AS next_url FROM found""",
    "listing_pairs": """WITH lists AS (SELECT page_id, regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a></li>', 1) AS x,
        regexp_extract_all(html, 'track\\((\\d+)\\)', 1) AS r FROM pages)
      SELECT page_id, CAST(unnest(range(greatest(len(x), len(r)))) AS INTEGER) AS pos, unnest(x) AS title, CAST(unnest(r) AS BIGINT) AS rank FROM lists""",
    "file_order_keys": "SELECT doc_id, row_number() OVER () AS review_id FROM documents",
    "indexed_titles": " UNION ALL ".join(
        f"SELECT '{state}' AS state, {_quoted(word)} AS keyword, p_partkey AS movie_id, name AS title "
        f"FROM (SELECT p_partkey, {name} AS name FROM part) WHERE contains(lower(name), {_quoted(word.lower())})"
        for state, name in (("before", "p_name"), ("after", "CASE WHEN p_size > 25 THEN p_name || ' II' ELSE p_name END"))
        for word in INDEXED_WORDS
    ),
    "phrase_search": """WITH feed AS (SELECT 'documents' AS source, doc_id AS id, 0::BIGINT AS turn, text FROM documents
        UNION ALL SELECT 'conversations', conv_id, turn, text FROM conversations UNION ALL SELECT 'benchmark', item_id, 0, text FROM benchmark)
      """
    + " UNION ALL ".join(
        f"SELECT '{how}' AS how, {_quoted(phrase)} AS phrase, source, id, turn FROM feed WHERE contains(lower(text), {_quoted(phrase.lower())})"
        for phrase in INDEXED_PHRASES
        for how in ("words", "trigrams")
    ),
    "key_register": """WITH first AS (SELECT DISTINCT s_name AS name FROM supplier WHERE s_nationkey % 2 = 0),
      one AS (SELECT name, row_number() OVER (ORDER BY lower(name), name) AS key FROM first),
      added AS (SELECT name, (SELECT count(*) FROM first) + row_number() OVER (ORDER BY lower(name), name) AS key
                FROM (SELECT DISTINCT s_name AS name FROM supplier WHERE s_name NOT IN (SELECT name FROM first))),
      two AS (SELECT * FROM one UNION ALL SELECT * FROM added)
      SELECT 1 AS load, name, key FROM one UNION ALL SELECT 2, name, key FROM two UNION ALL SELECT 3, name, key FROM two""",
    "snapshot_model": f"WITH {MODEL} "
    + " UNION ALL ".join(
        f"SELECT '{name}' AS name, count(*) AS n, '{reader}' AS reader FROM {name}" + (" WHERE movie_id % 2 = 0" if (name, reader) == ("stream_links", "late") else "")
        for name in TABLES
        for reader in ("early", "late")
    )
    + " UNION ALL SELECT 'long_movies', count(*), 'early' FROM movies WHERE runtime > 25"
    + " UNION ALL SELECT 'long_movies', count(*), 'late' FROM movies WHERE runtime > 15",
    "split_files": " UNION ALL ".join(
        f"SELECT '{how}' AS format, doc_id, coalesce(text, '') AS text, source FROM documents" for how in ("json", "tsv")
    ),
    "crawl_rounds": f"""WITH {LINKS} SELECT abs_url, min(page_id % 3) + 1 AS round FROM resolved
      WHERE abs_url NOT IN (SELECT regexp_replace(url, '#.*$', '') FROM pages) GROUP BY abs_url""",
}
