import random

import pytest
from pyspark.sql import functions as F

from placetime.operators import search
from placetime.plans import fixtures
from placetime.plans.registry import table


def fewest_edits(query, value):
    """Plain dynamic programme: edits between a query and the best part of a text."""
    column = list(range(len(query) + 1))
    best = column[-1]
    for ch in value:
        new = [0]
        for i, q in enumerate(query, 1):
            new.append(min(new[-1] + 1, column[i] + 1, column[i - 1] + (q != ch)))
        column = new
        best = min(best, column[-1])
    return best


def brute_force(documents, queries, fuzzy):
    found = {}
    for qid, query in queries:
        if not query:
            continue
        q = query.lower()
        k = int(0.1 * len(q) + 1e-9) if fuzzy else 0
        for doc in documents:
            score = 0.0
            for field, weight in (("title", 20), ("section", 20), ("text", 10)):
                value = (doc[field] or "").lower()
                e = fewest_edits(q, value) if value else len(q)
                if e <= k:
                    score += weight * (1 - e / len(q)) / 50
            if score:
                found[qid, doc["doc_id"]] = round(score, 9)
    return found


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(11)
    words = ["alpha", "beta", "gamma", "delta", "Über", "straße", "été", "omega"]

    def phrase(n):
        return " ".join(rng.choice(words) for _ in range(n))

    def damaged(value):
        out = list(value)
        for _ in range(rng.choice([0, 1, 2])):
            at = rng.randrange(len(out))
            action = rng.choice("dis")
            if action == "d":
                del out[at]
            elif action == "i":
                out.insert(at, rng.choice("abé"))
            else:
                out[at] = rng.choice("xyz")
        return "".join(out)

    queries = [(i, phrase(rng.choice([1, 3, 4, 6]))) for i in range(12)] + [(90, ""), (91, None), (92, "a")]
    documents = []
    for i in range(60):
        body = phrase(rng.choice([0, 3, 30]))
        if rng.random() < 0.6:
            body += damaged(rng.choice(queries[:12])[1]) + phrase(2)
        documents.append({
            "doc_id": i, "href": f"p{i // 4}.html" + (f"#s{i}" if i % 4 else ""), "title": phrase(1),
            "section": None if i % 7 == 0 else damaged(rng.choice(queries[:12])[1]), "text": body or None,
        })
    docs = spark.createDataFrame(
        [tuple(d.values()) for d in documents], "doc_id bigint, href string, title string, section string, text string"
    )
    asked = spark.createDataFrame(queries, "query_id int, query string")
    return documents, queries, docs, asked


@pytest.mark.parametrize("fuzzy", [False, True])
def test_matches_equal_brute_force(corpus, fuzzy):
    documents, queries, docs, asked = corpus
    got = search.match_documents(docs, asked, fuzzy).collect()
    scores = {(r.query_id, r.doc_id): r.score for r in got}
    assert len(scores) == len(got)
    assert scores == brute_force(documents, queries, fuzzy)


@pytest.mark.parametrize("fuzzy", [False, True])
def test_blocks_of_bytes_and_of_queries(corpus, monkeypatch, fuzzy):
    documents, queries, docs, asked = corpus
    monkeypatch.setattr(search, "_BYTES_AT_ONCE", 50)
    monkeypatch.setattr(search, "_QUERIES_AT_ONCE", 1)
    got = {(r.query_id, r.doc_id): r.score for r in search.match_documents(docs, asked, fuzzy).collect()}
    assert got == brute_force(documents, queries, fuzzy)


def test_equal_queries_are_found_alike(corpus, spark):
    documents, queries, docs, _ = corpus
    twice = spark.createDataFrame([(i + k, q) for i, q in queries[:4] for k in (0, 500)], "query_id int, query string")
    got = {(r.query_id, r.doc_id) for r in search.match_documents(docs, twice).collect()}
    assert got and got == {(q + k, d) for q, d in brute_force(documents, queries[:4], True) for k in (0, 500)}


@pytest.mark.parametrize("width", [12, 24])
def test_candidates_are_few(spark, sf, width):
    """At most ten times the hits, over real documents and queries cut from them."""
    folder = sf.replace("0.001", "0.01")
    docs = fixtures.search_documents(spark, folder)
    asked = table(spark, folder, "benchmark").select(F.col("item_id").alias("query_id"), F.lower(F.substring("text", 11, width)).alias("query"))
    folded = docs.select("doc_id", *(F.lower(f).alias(f) for f in search.WEIGHTS))
    found = search.match_documents(docs, asked, width > 12).count()
    assert 0 < found <= search.candidates(folded, asked, search.THRESHOLD if width > 12 else 0.0).count() <= 10 * found


def test_runs_of_long_and_short_queries(spark):
    docs = spark.createDataFrame([(1, None, None, "x" * 5000 + "needle in é haystack" + "y" * 5000), (2, "T", "", "né"), (3, None, None, None)], "doc_id long, title string, section string, text string")
    asked = spark.createDataFrame([(1, "needle in é haystack" + "y" * 300), (2, "é"), (3, "NÉ"), (4, "x" * 4000), (5, "x" * 5001)], "query_id long, query string")
    got = {(r.query_id, r.doc_id) for r in search.match_documents(docs, asked, fuzzy=False).collect()}
    assert got == {(1, 1), (2, 1), (2, 2), (3, 2), (4, 1)}


def test_edits_are_verified_in_bounded_blocks(corpus, monkeypatch):
    documents, queries, *_ = corpus
    pairs = [(d["text"], q.lower()) for d in documents for _, q in queries if q]
    texts, asked = [t.lower() if t else t for t, _ in pairs], [q for _, q in pairs]
    whole = search._fewest_edits(texts, asked, 0.1)
    monkeypatch.setattr(search, "_VERIFY_AT_ONCE", 3)
    assert search._fewest_edits(texts, asked, 0.1) == whole


def test_top_hits_break_ties_by_document(spark):
    scored = spark.createDataFrame([(1, 5, 0.2), (1, 4, 0.2), (1, 3, 0.9), (2, 1, 0.1)], "query_id int, doc_id int, score double")
    got = sorted(tuple(r) for r in search.top_hits(scored, 2).select("query_id", "rank", "doc_id").collect())
    assert got == [(1, 1, 3), (1, 2, 4), (2, 1, 1)]


def page_hits(spark):
    links = ["a.html#1", "b.html", "a.html", "a.html#2", "a.html#3", "c.html#1"]
    return spark.createDataFrame([(1, i + 1, link) for i, link in enumerate(links)], "query_id int, rank int, link string")


def test_grouping_puts_the_page_first(spark):
    got = search.group_by_page(page_hits(spark)).orderBy("page_order", "in_page").collect()
    assert [r.link for r in got] == ["a.html", "a.html#1", "a.html#2", "a.html#3", "b.html", "c.html#1"]


def shown(df):
    return [(r.kind, r.link, r.more) for r in df.orderBy("page_order", "shown").collect()]


def test_collapse(spark):
    grouped = search.group_by_page(page_hits(spark))
    rest = [("doc", "b.html", None), ("doc", "c.html#1", None)]
    first = [("doc", "a.html", None), ("item", "a.html#1", None), ("item", "a.html#2", None), ("item", "a.html#3", None)]
    assert shown(search.collapse(grouped, 3)) == first[:3] + [("more", None, 1)] + rest
    assert shown(search.collapse(grouped, 4)) == first + rest
    assert shown(search.collapse(grouped, True)) == first[:1] + [("more", None, 3)] + rest
    assert shown(search.collapse(grouped, None)) == first + rest
    opened = spark.createDataFrame([(1, "a.html")], "query_id int, page string")
    assert shown(search.collapse(grouped, 2, opened)) == first[:2] + [("more", None, 2)] + first[2:] + rest


def test_page_counts_and_whole_search(corpus, spark):
    _, _, docs, asked = corpus
    assert search.page_counts(page_hits(spark)).collect() == [(1, 3)]
    found = search.search(docs, asked, limit=5)
    per_query = found.where("kind != 'more'").groupBy("query_id").count().collect()
    assert per_query and max(r["count"] for r in per_query) <= 5
    one = found.where("text LIKE '%<mark%'").first()
    assert "q=" in one.href and one.text.count("<mark") == 1


def test_collapse_without_a_limit_shows_all(spark):
    rows = [(1, "p", 1, i, 5) for i in range(1, 6)]
    grouped = spark.createDataFrame(rows, "query_id int, page string, page_order int, in_page int, page_hits int")
    for after in (0, None, False):
        assert search.collapse(grouped, after).count() == 5
    assert [r.kind for r in search.collapse(grouped, True).orderBy("shown").collect()] == ["doc", "more"]


def test_required_fields(spark):
    df = spark.createDataFrame([("h", "t", "x"), (None, "t", None)], "href string, title string, text string")
    assert {r.field: r.missing for r in search.missing_fields(df).collect()} == {"href": 1, "title": 0, "text": 1}
    assert search.valid_documents(df).count() == 1
    with pytest.raises(Exception, match="missing fields: href, text"):
        search.require_fields(df).select("href").collect()


def test_rename_only_what_exists(spark):
    df = spark.createDataFrame([("a", "b")], "name string, title string")
    got = search.rename_fields(df, {"title": "name", "text": "body", "section": "section"})
    assert got.columns == ["title"] and got.first()["title"] == "a"
    assert search.rename_fields(df.select("name"), {"title": "name"}).select(F.col("title")).count() == 1
