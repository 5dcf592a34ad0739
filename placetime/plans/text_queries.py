"""Tokens, rewriting, links, marks and snippets over documents and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from placetime.functions import text
from placetime.operators import arrays, search
from placetime.plans.fixtures import ASKED_SQL, SEARCH_DOCS_SQL, asked, search_documents
from placetime.plans.registry import documents, query, table
from placetime.session import checkpointed

_RULES = {"e": "ea", "a": "th", "t": "e"}


@query(r"""
SELECT doc_id, pos, token FROM (
  SELECT doc_id, unnest(range(len(tokens))) AS pos, unnest(tokens) AS token
  FROM (SELECT doc_id, regexp_extract_all(text, '\d*\+|\d*\-|F|L|R|\[|\]|\|') AS tokens FROM documents))
""")
def extracted_tokens(spark, sf):
    return arrays.tokens(documents(spark, sf), "text", ["doc_id"])


def _rewrite_sql(source: str) -> str:
    cases = " ".join(f"WHEN ch = '{k}' THEN '{v}'" for k, v in _RULES.items())
    return f"array_to_string(list_transform(string_split({source}, ''), lambda ch: CASE {cases} ELSE ch END), '')"


@query(f"""
WITH once AS (SELECT doc_id, {_rewrite_sql("text")} AS t FROM documents),
twice AS (SELECT doc_id, {_rewrite_sql("t")} AS t FROM once)
SELECT doc_id, length(t) AS characters, md5(t) AS digest FROM twice
""")
def rewritten_text(spark, sf):
    docs = documents(spark, sf).select("doc_id", text.rewrite("text", _RULES, rounds=2).alias("t"))
    return docs.select("doc_id", F.length("t").alias("characters"), F.md5(F.col("t").cast("binary")).alias("digest"))


@query(r"""
WITH cut AS (
  SELECT page_id, regexp_extract_all(regexp_replace(url, '^((?:[^/]|/.)*)/$', '\1'), '((?:[^./]|/.)*)(?:\.|$)', 1) AS p FROM pages
), parts AS (
  SELECT page_id, CASE WHEN len(p) > 0 AND p[len(p)] = '' THEN p[1:len(p) - 1] ELSE p END AS p FROM cut
)
SELECT page_id, unnest(range(len(p))) AS pos, regexp_replace(unnest(p), '/(.)', '\1', 'g') AS part FROM parts
""")
def split_with_escape(spark, sf):
    parts = text.split_escaped("url", ".", "/")
    return arrays.exploded(table(spark, sf, "pages"), parts, ["page_id"], "pos", "part")


@query("""
SELECT page_id, split_part(url, '#', 1) AS page, NOT contains(url, '#') AS is_page FROM pages
""")
def link_parts(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", text.link_page("url").alias("page"), text.link_is_page("url").alias("is_page")
    )


@query("""
SELECT page_id, concat(split_part(url, '#', 1), CASE WHEN instr(split_part(url, '#', 1), '?') > 1 THEN '&' ELSE '?' END,
       'q=', regexp_extract(url, '//([^./]*)', 1), substr(url, length(split_part(url, '#', 1)) + 1)) AS href FROM pages
""")
def link_with_parameter(spark, sf):
    value = F.regexp_extract("url", "//([^./]*)", 1)
    return table(spark, sf, "pages").select("page_id", text.add_parameter("url", "q", value).alias("href"))


# each document is searched for a word of its own: the third one, or its language if there are fewer
_WORD_SQL = "coalesce(nullif(regexp_extract(text, '^\\S+\\s+\\S+\\s+(\\S+)', 1), ''), lang)"


def _word():
    return F.coalesce(F.nullif(F.regexp_extract("text", r"^\S+\s+\S+\s+(\S+)", 1), F.lit("")), F.col("lang"))


SNIPPET_SQL = """
  SELECT {keys}, CASE WHEN hit = 0 THEN text ELSE concat(
           substr(marked, begin + 1, stop - begin + until),
           CASE WHEN until < length(tail) THEN '…' ELSE '' END) END AS snippet
  FROM (SELECT *, length(regexp_extract(tail, '^[^ ,:]*')) AS until FROM (
    SELECT *, substr(marked, stop + 1) AS tail FROM (
      SELECT *, begin + 234 AS stop FROM (
        SELECT *, concat(head, '<mark class=''search-match''>', substr(text, hit, length(query)), '</mark>',
                         substr(text, hit + length(query))) AS marked,
               CASE WHEN hit - 1 < 50 THEN 0 ELSE hit - 1 - length(regexp_extract(head, '[^ ,:]*$')) END AS begin
        FROM (SELECT *, substr(text, 1, hit - 1) AS head FROM (
          SELECT *, instr(lower(text), lower(query)) AS hit FROM {source}))))))"""


@query(f"""
WITH asked AS (SELECT doc_id, text, coalesce(nullif(reverse(regexp_extract(reverse(text), '^\\S*\\s+\\S+\\s+(\\S+)', 1)), ''), lang) AS query FROM documents)
{SNIPPET_SQL.format(keys="doc_id, query", source="asked")}
""")
def snippets(spark, sf):
    late_word = F.reverse(F.regexp_extract(F.reverse("text"), r"^\S*\s+\S+\s+(\S+)", 1))
    asked_for = F.coalesce(F.nullif(late_word, F.lit("")), F.col("lang"))
    docs = documents(spark, sf).select("doc_id", "text", asked_for.alias("query"))
    return docs.select("doc_id", "query", text.snippet("text", "query").alias("snippet"))


@query(f"""
WITH words AS (SELECT doc_id, text, {_WORD_SQL} AS word FROM documents)
SELECT doc_id, md5(regexp_replace(text, concat('(?i)(', regexp_escape(word), ')'), '<mark>\\1</mark>', 'g')) AS digest,
       len(regexp_extract_all(text, concat('(?i)', regexp_escape(word)))) AS marks
FROM words
""")
def marked_matches(spark, sf):
    docs = documents(spark, sf).select("doc_id", "text", _word().alias("word"))
    marked = docs.withColumn("marked", text.mark_all("text", "word"))
    plain = (F.length("marked") - F.length("text")) / len("<mark></mark>")
    return marked.select(
        "doc_id", F.md5(F.col("marked").cast("binary")).alias("digest"), plain.cast("bigint").alias("marks")
    )


@query(f"""
WITH words AS (SELECT doc_id, text, {_WORD_SQL} AS word FROM documents),
marked AS (SELECT *, concat('<mark>', word, 'x</mark> ', regexp_replace(text, concat('(?i)(', regexp_escape(word), ')'), '<mark>\\1</mark>', 'g')) AS m FROM words)
SELECT doc_id, md5(concat('<mark>', word, 'x</mark> ', text)) AS digest, length(m) - length(concat('<mark>', word, 'x</mark> ', text)) AS dropped FROM marked
""")
def unmarked_matches(spark, sf):
    """The marks of the document's word go, one of another word in front of the text stays."""
    other = F.concat(F.lit("<mark>"), F.col("word"), F.lit("x</mark> "))
    docs = documents(spark, sf).select("doc_id", "text", _word().alias("word"))
    marked = docs.withColumn("m", F.concat(other, text.mark_all("text", "word")))
    back = marked.withColumn("back", text.unmark("m", "word"))
    return back.select("doc_id", F.md5(F.col("back").cast("binary")).alias("digest"), (F.length("m") - F.length("back")).cast("bigint").alias("dropped"))


@query("SELECT doc_id, source AS title, lang AS section FROM documents")
def renamed_fields(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source", "lang")
    return search.rename_fields(docs, {"title": "source", "section": "lang", "crumbs": "path"})


_LACKING_SQL = """
lacking AS (
  SELECT doc_id, CASE WHEN toxic = 1 THEN NULL ELSE concat('p', doc_id) END AS href,
         CASE WHEN quality = 0 THEN NULL ELSE source END AS title, text
  FROM documents LEFT JOIN labels USING (doc_id))"""


def _lacking(spark, sf):
    both = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return both.select(
        "doc_id",
        F.when(F.coalesce(F.col("toxic"), F.lit(0)) != 1, F.concat(F.lit("p"), "doc_id")).alias("href"),
        F.when(F.coalesce(F.col("quality"), F.lit(1)) != 0, F.col("source")).alias("title"), "text",
    )


@query(f"""
WITH {_LACKING_SQL}
SELECT 'href' AS field, count(*) - count(href) AS missing FROM lacking
UNION ALL SELECT 'title', count(*) - count(title) FROM lacking
UNION ALL SELECT 'text', count(*) - count(text) FROM lacking
""")
def missing_fields(spark, sf):
    return search.missing_fields(_lacking(spark, sf))


@query(f"WITH {_LACKING_SQL} SELECT doc_id, href, title FROM lacking WHERE href IS NOT NULL AND title IS NOT NULL AND text IS NOT NULL")
def valid_documents(spark, sf):
    return search.valid_documents(_lacking(spark, sf)).select("doc_id", "href", "title")


@query("SELECT doc_id, source AS title, length(text) AS characters FROM documents")
def required_fields(spark, sf):
    """Every row passes the check that fails a job at the first row without a required field."""
    docs = documents(spark, sf).withColumnsRenamed({"source": "title"}).withColumn("href", F.concat(F.lit("p"), "doc_id"))
    return search.require_fields(docs).select("doc_id", "title", F.length("text").cast("bigint").alias("characters"))


# --- search -----------------------------------------------------------------------

_SCORED_SQL = f"""
{SEARCH_DOCS_SQL}, {ASKED_SQL}, scored AS (
  SELECT query_id, doc_id, round((
    CASE WHEN contains(lower(title), lower(query)) THEN 20 ELSE 0 END
    + CASE WHEN contains(lower(section), lower(query)) THEN 20 ELSE 0 END
    + CASE WHEN contains(lower(text), lower(query)) THEN 10 ELSE 0 END) / 50e0, 9) AS score
  FROM docs JOIN asked ON contains(lower(title), lower(query)) OR contains(lower(section), lower(query))
                       OR contains(lower(text), lower(query))
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM scored
), hits AS (SELECT * FROM ranked WHERE rank <= 50)"""


@query(f"WITH {_SCORED_SQL} SELECT query_id, doc_id, score FROM scored")
def exact_search(spark, sf):
    found = search.match_documents(search_documents(spark, sf), asked(spark, sf), fuzzy=False)
    return found.select("query_id", "doc_id", "score")


_WHOLE_ASKED_SQL = """
asked AS (SELECT item_id AS query_id, text AS query FROM benchmark)"""


@query(f"WITH {_SCORED_SQL.replace(ASKED_SQL, _WHOLE_ASKED_SQL)} SELECT query_id, doc_id, score FROM scored")
def long_exact_search(spark, sf):
    """Whole benchmark texts as queries."""
    long = table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))
    return search.match_documents(search_documents(spark, sf), long, fuzzy=False).select("query_id", "doc_id", "score")


# every asked text has 10 to 19 characters, so one edit is allowed: a character of the query
# missing or replaced in the text ('.?' in its place), or one more character between two
_FUZZY_SQL = f"""
{SEARCH_DOCS_SQL}, {ASKED_SQL}, folded AS (
  SELECT query_id, lower(query) AS q, length(query) AS n FROM asked
), patterns AS (
  SELECT query_id, q, n, concat('(?s)', string_agg(concat(
    regexp_escape(substr(q, 1, i - 1)), '.?', regexp_escape(substr(q, i + 1)),
    CASE WHEN i < n THEN concat('|', regexp_escape(substr(q, 1, i)), '.', regexp_escape(substr(q, i + 1))) ELSE '' END), '|')) AS pattern
  FROM (SELECT *, unnest(range(1, n + 1)) AS i FROM folded) GROUP BY query_id, q, n
), fields AS (
  SELECT doc_id, 20 AS weight, lower(title) AS v FROM docs UNION ALL SELECT doc_id, 20, lower(section) FROM docs
  UNION ALL SELECT doc_id, 10, lower(text) FROM docs
), edited AS (
  SELECT query_id, doc_id, weight, n, CASE WHEN contains(v, q) THEN 0 WHEN regexp_matches(v, pattern) THEN 1 END AS edits
  FROM fields JOIN patterns ON contains(v, substr(q, 1, n // 2)) OR contains(v, substr(q, n // 2 + 1))
)"""


@query(f"""
WITH {_FUZZY_SQL}
SELECT query_id, doc_id, round(sum(weight * (1 - edits / n)) / 50, 9) AS score, min(edits) AS edits
FROM edited WHERE edits IS NOT NULL GROUP BY 1, 2
""")
def fuzzy_search(spark, sf):
    return search.match_documents(search_documents(spark, sf), asked(spark, sf))


# 24 characters, so two edits are allowed and one of three pieces is unchanged. The stretch around
# each place of a piece is compared; levenshtein counts bytes, so the characters of a query are
# numbered and all others are one more
_TWO_EDITS_SQL = f"""
{SEARCH_DOCS_SQL}, asked AS (SELECT item_id AS query_id, substr(text, 11, 24) AS query FROM benchmark), folded AS (
  SELECT query_id, lower(query) AS q, length(query) AS n, floor(0.1e0 * length(query) + 1e-9)::BIGINT AS k FROM asked WHERE length(query) > 0
), pieces AS (
  SELECT *, n * i // (k + 1) AS start, substr(q, n * i // (k + 1) + 1, n * (i + 1) // (k + 1) - n * i // (k + 1)) AS piece
  FROM (SELECT *, unnest(range(k + 1)) AS i FROM folded)
), fields AS (
  SELECT doc_id, 20 AS weight, lower(title) AS v FROM docs UNION ALL SELECT doc_id, 20, lower(section) FROM docs
  UNION ALL SELECT doc_id, 10, lower(text) FROM docs
), met AS (
  SELECT query_id, q, n, k, start, doc_id, weight, v, length(piece) AS size, list_transform(string_split(v, piece), lambda x: length(x)) AS gaps
  FROM fields JOIN pieces ON contains(v, piece)
), places AS (
  SELECT *, unnest(list_transform(range(1, len(gaps)), lambda j: list_sum(gaps[1:j]) + (j - 1) * size)) AS found FROM met
), stretches AS (
  SELECT DISTINCT query_id, doc_id, weight, q, n, k, string_split(q, '') AS own,
    substr(v, greatest(found - start - k, 0)::BIGINT + 1, (found - start + n + k - greatest(found - start - k, 0))::BIGINT) AS w FROM places
), numbered AS (
  SELECT query_id, doc_id, weight, n, k, array_to_string(list_transform(own, lambda c: chr(64 + list_position(own, c)::INT)), '') AS q,
    array_to_string(list_transform(string_split(w, ''), lambda c: chr(64 + coalesce(list_position(own, c), 0)::INT)), '') AS w FROM stretches
), edited AS (
  SELECT query_id, doc_id, weight, n, k, min(list_min(flatten(list_transform(range(1, length(w) + 1), lambda a:
    list_transform(range(n - k, n + k + 1), lambda m: levenshtein(substr(w, a, m), q)))))) AS edits
  FROM numbered GROUP BY ALL
)"""


@query(f"""
WITH {_TWO_EDITS_SQL}
SELECT query_id, doc_id, round(sum(weight * (1 - edits / n)) / 50, 9) AS score, min(edits)::INT AS edits
FROM (SELECT query_id, doc_id, weight, n, min(edits) AS edits FROM edited WHERE edits <= k GROUP BY ALL) GROUP BY 1, 2
""")
def long_fuzzy_search(spark, sf):
    """Queries of which two characters may differ."""
    long = table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), F.substring("text", 11, 24).alias("query"))
    return search.match_documents(search_documents(spark, sf), long)


# the languages and sources are few words, so whole fields match as well
_FIELD_ASKED_SQL = """
asked AS (SELECT DISTINCT source AS query_id, source AS query FROM documents
          UNION SELECT DISTINCT lang, lang FROM documents)"""
_FIELD_SCORED_SQL = _SCORED_SQL.replace(ASKED_SQL, _FIELD_ASKED_SQL)


def _field_queries(spark, sf):
    docs = table(spark, sf, "documents")
    words = docs.select(F.col("source").alias("query")).union(docs.select("lang")).distinct()
    return words.select(F.col("query").alias("query_id"), "query")


@query(f"WITH {_FIELD_SCORED_SQL} SELECT query_id, doc_id, score, rank FROM hits")
def top_documents(spark, sf):
    found = search.match_documents(search_documents(spark, sf), _field_queries(spark, sf), fuzzy=False)
    return search.top_hits(found).select("query_id", "doc_id", "score", F.col("rank").cast("bigint").alias("rank"))


def _field_hits(spark, sf):
    docs, words = search_documents(spark, sf), _field_queries(spark, sf)
    hits = search.top_hits(search.match_documents(docs, words, fuzzy=False))
    return search.present_hits(hits, docs, words)


_PAGED_SQL = f"""
{_FIELD_SCORED_SQL}, linked AS (
  SELECT hits.*, split_part(href, '#', 1) AS page, NOT contains(href, '#') AS is_page FROM hits JOIN docs USING (doc_id)
), paged AS (
  SELECT *, count(*) OVER (PARTITION BY query_id, page) AS page_hits,
         row_number() OVER (PARTITION BY query_id, page ORDER BY is_page DESC, CASE WHEN is_page THEN -rank ELSE 0 END, rank) AS in_page,
         min(rank) OVER (PARTITION BY query_id, page) AS page_first
  FROM linked
), grouped AS (SELECT *, dense_rank() OVER (PARTITION BY query_id ORDER BY page_first) AS page_order FROM paged)"""


@query(f"WITH {_PAGED_SQL} SELECT query_id, doc_id, page, is_page, page_order, in_page, page_hits FROM grouped")
def hits_by_page(spark, sf):
    grouped = search.group_by_page(_field_hits(spark, sf))
    return grouped.select(
        "query_id", "doc_id", "page", "is_page", F.col("page_order").cast("bigint").alias("page_order"),
        F.col("in_page").cast("bigint").alias("in_page"), "page_hits",
    )


@query(f"""
WITH {_PAGED_SQL}
SELECT query_id, page, page_order, in_page AS shown, CASE WHEN in_page = 1 THEN 'doc' ELSE 'item' END AS kind, doc_id,
       CAST(NULL AS BIGINT) AS more FROM grouped WHERE in_page <= 2
UNION ALL
SELECT query_id, page, page_order, 3, 'more', NULL, page_hits - 2 FROM grouped WHERE in_page = 1 AND page_hits > 2
""")
def collapsed_hits(spark, sf):
    shown = search.collapse(search.group_by_page(_field_hits(spark, sf)), after=2)
    return shown.select(
        "query_id", "page", F.col("page_order").cast("bigint").alias("page_order"),
        F.col("shown").cast("bigint").alias("shown"), "kind", "doc_id", "more",
    )


_SHOWN = """SELECT query_id, page, page_order, in_page AS shown, CASE WHEN in_page = 1 THEN 'doc' ELSE 'item' END AS kind, doc_id,
       CAST(NULL AS BIGINT) AS more FROM grouped"""


def _shown(rows):
    return rows.select(
        "query_id", "page", F.col("page_order").cast("bigint").alias("page_order"),
        F.col("shown").cast("bigint").alias("shown"), "kind", "doc_id", "more",
    )


@query(f"WITH {_PAGED_SQL} {_SHOWN}")
def uncollapsed_hits(spark, sf):
    """A limit of 0 shows every row."""
    return _shown(search.collapse(search.group_by_page(_field_hits(spark, sf)), after=0))


@query(f"""
WITH {_PAGED_SQL} {_SHOWN} WHERE in_page = 1
UNION ALL SELECT query_id, page, page_order, 2, 'more', NULL, page_hits - 1 FROM grouped WHERE in_page = 1 AND page_hits > 1
""")
def hits_collapsed_to_pages(spark, sf):
    """True shows one row of each page."""
    return _shown(search.collapse(search.group_by_page(_field_hits(spark, sf)), after=True))


@query(f"""
WITH {_PAGED_SQL}, opened AS (SELECT DISTINCT query_id, page FROM grouped WHERE page_order % 2 = 1)
SELECT query_id, page, page_order, CASE WHEN in_page > 1 THEN in_page + 1 ELSE in_page END AS shown,
       CASE WHEN in_page = 1 THEN 'doc' ELSE 'item' END AS kind, doc_id, CAST(NULL AS BIGINT) AS more
FROM grouped WHERE in_page = 1 OR page_order % 2 = 1
UNION ALL SELECT query_id, page, page_order, 2, 'more', NULL, page_hits - 1 FROM grouped WHERE in_page = 1 AND page_hits > 1
""")
def expanded_hits(spark, sf):
    """Every second page is opened by its reader and shows all its rows."""
    grouped = checkpointed(search.group_by_page(_field_hits(spark, sf)))
    opened = grouped.where("page_order % 2 = 1").select("query_id", "page")
    return _shown(search.collapse(grouped, after=1, expanded=opened))


@query(f"""
WITH {_FIELD_SCORED_SQL}
SELECT query_id, count(DISTINCT split_part(href, '#', 1)) AS pages FROM hits JOIN docs USING (doc_id) GROUP BY query_id
""")
def matching_pages(spark, sf):
    return search.page_counts(_field_hits(spark, sf))


@query(f"""
WITH {_PAGED_SQL.replace(_FIELD_ASKED_SQL, ASKED_SQL)}, shown AS (
  SELECT g.query_id, g.page, g.page_order, g.in_page AS shown, CASE WHEN in_page = 1 THEN 'doc' ELSE 'item' END AS kind,
         g.doc_id, CAST(NULL AS BIGINT) AS more, d.title, d.text, a.query,
         concat(split_part(d.href, '#', 1), '?q=', a.query, substr(d.href, length(split_part(d.href, '#', 1)) + 1)) AS href
  FROM grouped g JOIN docs d USING (doc_id) JOIN asked a ON a.query_id = g.query_id WHERE in_page <= 3
), cut AS ({SNIPPET_SQL.format(keys="query_id, doc_id", source="shown")})
SELECT s.query_id, s.page, s.page_order, s.shown, s.kind, s.doc_id, s.more, s.title, s.href, c.snippet AS text
FROM shown s JOIN cut c ON s.query_id = c.query_id AND s.doc_id = c.doc_id
UNION ALL
SELECT query_id, page, page_order, 4, 'more', NULL, page_hits - 3, NULL, NULL, NULL FROM grouped WHERE in_page = 1 AND page_hits > 3
""")
def whole_search(spark, sf):
    shown = search.search(search_documents(spark, sf), asked(spark, sf), fuzzy=False)
    return shown.select(
        "query_id", "page", F.col("page_order").cast("bigint").alias("page_order"),
        F.col("shown").cast("bigint").alias("shown"), "kind", "doc_id", "more", "title", "href", "text",
    )
