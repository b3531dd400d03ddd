"""The query catalogue: every operator over the supplied tables, with the SQL that gives the same rows.

Where the tables lack a layer (papers, articles, raw files), queries derive one from whole tables by plain expressions, which the
SQL repeats. Tie-breaks are explicit everywhere, so results do not depend on partitioning."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataforge.functions import links as L
from strataforge.functions import papers as P
from strataforge.functions import text as X
from strataforge.functions.vectors import hash_vector
from strataforge.operators import audit, cleanup, incremental, literature, retrieval, stages, textplan, validate, wikigraph
from strataforge.operators import boxes as boxes_of
from strataforge.operators.rounds import kept, new_folder
from strataforge.sources import files, sqlite
from strataforge.sources.tables import spread, table
from strataforge.streaming import events as E
from strataforge.streaming import upsert

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function as a query under its name."""
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# ---- tokens, text functions


@query(r"SELECT doc_id, len(regexp_extract_all(text, '\S+'))::INT AS token_count, length(text)::INT AS chars FROM documents")
def token_count(spark, d):
    return table(spark, d, "documents").select("doc_id", X.token_count(F.col("text")).alias("token_count"), F.length("text").alias("chars"))


@query(r"""SELECT doc_id, n::INT AS token_count, CASE WHEN n < 100 THEN 'WARNING' WHEN n > 500 THEN 'ERROR' END AS severity
FROM (SELECT doc_id, len(regexp_extract_all(text, '\S+')) AS n FROM documents) WHERE n < 100 OR n > 500""")
def size_flags(spark, d):
    rows = table(spark, d, "documents").select("doc_id", X.token_count(F.col("text")).alias("token_count"))
    n = F.col("token_count")
    return rows.filter((n < validate.MIN_TOKENS) | (n > validate.MAX_TOKENS)).withColumn("severity", F.when(n < validate.MIN_TOKENS, "WARNING").otherwise("ERROR"))


@query(r"""SELECT p_partkey, trim(regexp_replace(lower(p_name), '[^\p{L}\p{N}]+', '_', 'g'), '_') AS slug,
trim(regexp_replace(regexp_replace(lower(p_name), '[^\w\s-]', '', 'g'), '[\s_]+', '-', 'g'), '-') AS anchor,
left(trim(regexp_replace(regexp_replace(p_name, '[^\w\s-]', '', 'g'), '\s+', '_', 'g'), '_'), 60) AS file_title,
replace(replace(p_type, '"', '\"'), chr(10), ' ') AS yaml, replace(trim(p_brand), '|', '\|') AS cell FROM part""")
def slugs(spark, d):
    name = F.col("p_name")
    return table(spark, d, "part").select("p_partkey", X.slug(name).alias("slug"), X.toc_slug(name).alias("anchor"), X.safe_title(name, F.col("p_partkey")).alias("file_title"), X.yaml_escape(F.col("p_type")).alias("yaml"), X.clean(F.col("p_brand")).alias("cell"))


@query(r"""WITH s AS (SELECT doc_id, string_split(regexp_replace(trim(text, ' ' || chr(10)), '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)) AS parts FROM documents),
u AS (SELECT doc_id, unnest(list_filter(list_transform(parts, lambda x: trim(x, ' ' || chr(10))), lambda x: x <> '')) AS sentence, generate_subscripts(list_filter(parts, lambda x: trim(x, ' ' || chr(10)) <> ''), 1) AS pos FROM s)
SELECT doc_id, (pos - 1)::INT AS pos, sentence FROM u""")
def sentence_split(spark, d):
    return table(spark, d, "documents").select("doc_id", F.posexplode(X.sentences(F.col("text"))).alias("pos", "sentence"))


@query(r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
SELECT doc_id, count(*) FILTER (contains(trim(line), '|') AND length(trim(line)) > 2) AS table_lines, count(*) FILTER (regexp_matches(line, '^(\s*[-*+]\s+|\s*\d+[.)]\s+)')) AS list_lines,
count(*) FILTER (regexp_matches(trim(line), '^(```|~~~)')) AS fence_lines, count(*) FILTER (regexp_matches(line, '^#{1,6}\s+\S')) AS heading_lines FROM l GROUP BY doc_id""")
def line_kinds(spark, d):
    lines = F.split("text", "\n")
    n = lambda f: F.size(F.filter(lines, f)).cast("long")
    return table(spark, d, "documents").select("doc_id", n(X.is_table_line).alias("table_lines"), n(X.is_list_line).alias("list_lines"), n(X.is_fence_line).alias("fence_lines"), n(lambda x: X.is_heading_line(x)).alias("heading_lines"))


@query(r"""SELECT event_id, try_cast(json_extract_string(props, '$.k') AS INT) AS k, coalesce(try_cast(event_type AS INT), -1) AS parsed,
coalesce(nullif('', ''), nullif(event_type, ''), '') AS alias, left(trim(replace(event_type, chr(10), ' ')), 180) AS shown FROM events""")
def field_parsing(spark, d):
    kind = F.col("event_type")
    return table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").try_cast("int").alias("k"), X.parse_int(kind, -1).alias("parsed"), X.nonempty(F.lit(""), kind).alias("alias"), X.display_preview(kind).alias("shown"))


@query(r"""SELECT o_orderkey, CASE WHEN regexp_matches(c, '^\d+$') THEN 'ch' || lpad((c::BIGINT)::VARCHAR, 2, '0') ELSE c END AS chapter_id
FROM (SELECT o_orderkey, (o_orderkey % 10)::VARCHAR AS c FROM orders)""")
def chapter_ids(spark, d):
    return table(spark, d, "orders").select("o_orderkey", X.chapter_key(F.col("o_orderkey") % 10).alias("chapter_id"))


# ---- chunks, evidence, embeddings, wiki


def chunks_of(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("document_id"), F.col("lang").alias("topic"), "text")
    return stages.fixed_chunks(spread(docs))


CHUNKS = r"""w AS (SELECT doc_id, lang, list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '') AS ws FROM documents),
cut AS (SELECT doc_id, lang, ws, unnest(range(ceil(len(ws) / 500.0)::INT)) AS i FROM w),
chunks AS (SELECT 'chunk_' || doc_id || '_ch01_' || lpad((i + 1)::VARCHAR, 4, '0') AS chunk_id, doc_id AS document_id, 'ch01' AS chapter_id, lang AS topic, (i + 1)::INT AS sequence,
len(ws[i * 500 + 1:(i + 1) * 500])::INT AS token_count, array_to_string(ws[i * 500 + 1:(i + 1) * 500], ' ') AS content FROM cut)"""
EVIDENCE = CHUNKS + """,
evidence AS (SELECT 'evidence_' || chunk_id AS evidence_id, chunk_id, document_id, chapter_id, topic, token_count, round(least(1.0::DOUBLE, token_count / 500.0::DOUBLE), 4) AS score,
left(content, 400) AS content_preview, sha256(content) AS hash_sha256 FROM chunks)"""


@query(f"WITH {CHUNKS} SELECT * FROM chunks")
def fixed_window_chunks(spark, d):
    return chunks_of(spark, d)


@query(f"WITH {EVIDENCE} SELECT * FROM evidence")
def evidence_index(spark, d):
    return stages.build_evidence(chunks_of(spark, d)).drop("limitations")


@query(f"WITH {EVIDENCE} SELECT topic, count(*) AS records, round_even(avg(score), 6) AS mean_score FROM evidence GROUP BY topic")
def by_topic_counts(spark, d):
    return stages.build_evidence(chunks_of(spark, d)).groupBy("topic").agg(F.count("*").alias("records"), F.bround(F.avg("score"), 6).alias("mean_score"))


@query(f"""WITH {CHUNKS} SELECT count(*) AS chunks, count(DISTINCT document_id) AS documents, count(DISTINCT (document_id, chapter_id)) AS chapters, round_even(avg(token_count), 2) AS avg_tokens,
max(token_count) AS max_tokens, min(token_count) AS min_tokens FROM chunks""")
def chunk_stats(spark, d):
    return stages.chunk_stats(chunks_of(spark, d))


VECTOR = lambda text: f"list_transform(range(64), lambda i: round(('0x' || substr(sha256({text}) || sha256(unhex(sha256({text}))), 2 * i::INT + 1, 2))::INT / 255.0::DOUBLE, 6))"


@query(f"SELECT item_id, (unnest(range(64)))::INT AS pos, unnest({VECTOR('text')}) AS value FROM benchmark")
def hash_vectors(spark, d):
    return table(spark, d, "benchmark").select("item_id", F.posexplode(hash_vector(F.col("text"))).alias("pos", "value"))


EMBEDDED = EVIDENCE + f", embedded AS (SELECT 'emb_' || chunk_id AS embedding_id, chunk_id, evidence_id, topic, {VECTOR('content_preview')} AS vector FROM evidence)"
FOUND = EMBEDDED + f""", best AS (SELECT embedding_id, chunk_id, evidence_id, round(list_cosine_similarity(vector, {VECTOR("'lorem ipsum'")}), 6) AS score FROM embedded ORDER BY score DESC, embedding_id LIMIT 5)"""


@query(f"WITH {FOUND} SELECT embedding_id, chunk_id, b.evidence_id, b.score, document_id::VARCHAR AS document_id, chapter_id, token_count, content_preview FROM best b JOIN evidence e USING (chunk_id)")
def hash_search_topk(spark, d):
    evidence = kept(stages.build_evidence(chunks_of(spark, d)).drop("limitations"))  # the layer that both sides read
    return retrieval.search(stages.build_embeddings(evidence), evidence, "lorem ipsum", 5)


@query(f"WITH {EMBEDDED} SELECT embedding_id, evidence_id, topic, list_sum(list_transform(vector, lambda x: round(x * 1000000)::BIGINT))::BIGINT AS total FROM embedded")
def embedding_build(spark, d):
    made = stages.build_embeddings(stages.build_evidence(chunks_of(spark, d)))
    return made.select("embedding_id", "evidence_id", "topic", F.aggregate("vector", F.lit(0).cast("long"), lambda a, x: a + F.round(x * 1000000).cast("long")).alias("total"))


PAGE = r"""'# Topic ' || topic || chr(10) || chr(10) || 'Domain: corpus' || chr(10) || 'Entries: ' || count(*) || chr(10) || chr(10) ||
string_agg('## ' || evidence_id || chr(10) || chr(10) || '- chunk_id: ' || chunk_id || chr(10) || '- document_id: ' || document_id || chr(10) || '- chapter_id: ' || chapter_id || chr(10) || '- token_count: ' || token_count || chr(10) || chr(10)
|| trim(content_preview, ' ' || chr(10)) || chr(10), chr(10) ORDER BY evidence_id)"""


@query(f"WITH {EVIDENCE} SELECT topic, count(*) AS entries, {PAGE} AS page FROM evidence GROUP BY topic")
def wiki_page_text(spark, d):
    return stages.wiki_pages(stages.build_evidence(chunks_of(spark, d)), "corpus")


@query(f"""WITH {EVIDENCE} SELECT topic, '' AS place, '# Topic ' || topic || chr(10) || chr(10) || 'Domain: corpus' || chr(10) || 'Entries: ' || count(*) || chr(10) AS value FROM evidence GROUP BY topic
UNION ALL SELECT topic, evidence_id, '## ' || evidence_id || chr(10) || chr(10) || '- chunk_id: ' || chunk_id || chr(10) || '- document_id: ' || document_id || chr(10) || '- chapter_id: ' || chapter_id || chr(10) || '- token_count: ' || token_count || chr(10) || chr(10)
|| trim(content_preview, ' ' || chr(10)) || chr(10) FROM evidence""")
def wiki_page_lines(spark, d):
    """Topic pages as rows: what write_pages writes, in any size."""
    return stages.page_lines(stages.build_evidence(chunks_of(spark, d)), "corpus")


@query("""SELECT '# Wiki corpus' || chr(10) || chr(10) || '## Topics' || chr(10) || chr(10) || string_agg('- [' || lang || '](' || lang || '.md)', chr(10) ORDER BY lang) AS page FROM (SELECT DISTINCT lang FROM documents)""")
def wiki_readme(spark, d):
    return stages.wiki_readme(table(spark, d, "documents").select(F.col("lang").alias("topic")), "corpus")


# ---- vectors


def query_vector(vectors: DataFrame) -> list[float]:
    """The embedding of vec_id 0: one row, passed on as a literal so that no side of a join is the whole table."""
    return [float(x) for x in vectors.filter("vec_id = 0").select("embedding").first().embedding]


def scored_vectors(spark, d):
    vectors = table(spark, d, "embeddings")
    return retrieval.score(vectors, query_vector(vectors), "embedding").select("vec_id", "label", "score")


SCORED = "SELECT v.vec_id, v.label, round(list_cosine_similarity(v.embedding::DOUBLE[], q.embedding::DOUBLE[]), 6) AS score FROM embeddings v, (SELECT embedding FROM embeddings WHERE vec_id = 0) q"


@query(f"SELECT * FROM ({SCORED}) ORDER BY score DESC, vec_id LIMIT 10")
def vector_topk(spark, d):
    return retrieval.top_k(scored_vectors(spark, d), 10, "vec_id")


@query("""WITH q AS (SELECT embedding FROM embeddings WHERE vec_id = 0) SELECT 'emb_' || v.vec_id AS embedding_id, 'd' || v.label AS domain, round(list_cosine_similarity(v.embedding::DOUBLE[], q.embedding::DOUBLE[]), 6) AS score
FROM embeddings v, q WHERE v.label = 1 ORDER BY score DESC, embedding_id LIMIT 10""")
def sqlite_search(spark, d):
    """All vectors into a store of SQLite shards, then a search in one domain, which SQLite looks up."""
    vectors = table(spark, d, "embeddings")
    query_of = query_vector(vectors)
    text = lambda name, c: F.concat(F.lit(name), F.col(c).cast("string"))
    rows = vectors.select(text("emb_", "vec_id").alias("embedding_id"), text("c", "vec_id").alias("chunk_id"), text("e", "vec_id").alias("evidence_id"), text("d", "label").alias("domain"), F.col("embedding").cast("array<double>").alias("vector"))
    path = new_folder(rows, "sqlite")
    sqlite.write_vectors(rows, path, shards=8)
    found = sqlite.read_vectors(spark, path, domain="d1").filter("vector is not null")
    return retrieval.top_k(retrieval.score(found, query_of), 10, "embedding_id").select("embedding_id", "domain", "score")


@query(f"SELECT *, row_number() OVER (PARTITION BY label ORDER BY score DESC, vec_id)::INT AS rank FROM ({SCORED}) QUALIFY rank <= 3")
def vector_topk_by_label(spark, d):
    return retrieval.top_k_by(scored_vectors(spark, d), "label", 3, "vec_id")


@query("""WITH v AS (SELECT vec_id, CASE WHEN vec_id % 50 = 7 THEN NULL WHEN vec_id % 50 = 8 THEN embedding[1:63] ELSE embedding END AS e, CASE WHEN vec_id % 50 = 9 THEN 'other' WHEN vec_id % 50 = 10 THEN '' ELSE 'hash-v1' END AS m FROM embeddings)
SELECT vec_id::VARCHAR AS identifier, 'embedding_model_version' AS rule, 'model_version missing' AS description FROM v WHERE m = ''
UNION ALL SELECT vec_id::VARCHAR, 'embedding_model_version_consistency', 'inconsistent model_version ''other'' (expected ''hash-v1'')' FROM v WHERE m = 'other'
UNION ALL SELECT vec_id::VARCHAR, 'embedding_vector_type', 'vector is not a list' FROM v WHERE e IS NULL
UNION ALL SELECT vec_id::VARCHAR, 'embedding_vector_dimension_consistency', 'inconsistent vector dimension 63 (expected 64)' FROM v WHERE len(e) = 63""")
def vector_consistency(spark, d):
    nth, e = F.col("vec_id") % 50, F.col("embedding")
    vector = F.when(nth == 7, F.lit(None)).when(nth == 8, F.slice(e, 1, 63)).otherwise(e)
    model = F.when(nth == 9, "other").when(nth == 10, "").otherwise("hash-v1")
    rows = table(spark, d, "embeddings").select("vec_id", vector.cast("array<double>").alias("vector"), model.alias("model_version"))
    return validate.vector_rules(rows, key="vec_id").select("identifier", "rule", "description")


# ---- links


@query("SELECT DISTINCT page_id, unnest(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1)) AS link FROM pages")
def html_links(spark, d):
    return table(spark, d, "pages").select("page_id", F.explode(L.html_links(F.col("html"))).alias("link"))


@query(r"""SELECT page_id, regexp_matches(url, '(?i)^https?://') AS external, regexp_matches(url, '(?i)^(#|mailto:|tel:|data:)') AS ignored,
lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)) AS host, regexp_extract(url, '^[^?#]*') AS path, regexp_replace(lower(replace(url, '\', '/')), '^[./]+', '') AS key FROM pages""")
def external_links(spark, d):
    url = F.col("url")
    return table(spark, d, "pages").select("page_id", L.is_external(url).alias("external"), L.is_ignored(url).alias("ignored"), L.host(url).alias("host"), L.link_path(url).alias("path"), L.meta_path(url).alias("key"))


@query(r"""SELECT page_id, len(regexp_extract_all(html, '<h1'))::INT AS h1, len(regexp_extract_all(html, '<h2'))::INT AS h2,
CASE WHEN len(regexp_extract_all(html, '<h1')) > 1 THEN 1 WHEN len(regexp_extract_all(html, '<h2')) > 1 THEN 2 WHEN len(regexp_extract_all(html, '<h1')) = 1 THEN 1 WHEN len(regexp_extract_all(html, '<h2')) = 1 THEN 2 ELSE 1 END AS split_level FROM pages""")
def heading_counts(spark, d):
    n = lambda k: F.regexp_count("html", F.lit(f"<h{k}"))
    level = F.when(n(1) > 1, 1).when(n(2) > 1, 2).when(n(1) == 1, 1).when(n(2) == 1, 2).otherwise(1)
    return table(spark, d, "pages").select("page_id", n(1).alias("h1"), n(2).alias("h2"), level.alias("split_level"))


ARTICLES = """a AS (SELECT n_nationkey AS page_id, upper(left(n_name, 1)) || substr(lower(n_name), 2) AS title, '[[' || lower(r_name) || '|region]] and [[File:x.png]] [[ ' || lower(r_name) || ' ]]' AS wikitext FROM nation JOIN region ON n_regionkey = r_regionkey)"""


def articles(spark, d):
    """Nations as articles that link to their region and a file."""
    both = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    region = F.lower("r_name")
    return both.select(F.col("n_nationkey").alias("page_id"), F.lower("n_name").alias("title"), F.concat(F.lit("[["), region, F.lit("|region]] and [[File:x.png]] [[ "), region, F.lit(" ]]")).alias("wikitext"))


@query(f"WITH {ARTICLES} SELECT page_id, replace(title, '_', ' ') AS title, upper(substr(wikitext, 3, 1)) || regexp_extract(wikitext, '^\\[\\[.([^|]*)', 1) AS link FROM a")
def wiki_links(spark, d):
    return articles(spark, d).select("page_id", L.wiki_title(F.col("title")).alias("title"), F.explode(L.wiki_links(F.col("wikitext"))).alias("link"))


#: Redirects: every customer points to a third of its key (16 chained keys at most), multiples of ten are articles, 7 and 8 a cycle.
HOPS = "hops AS (SELECT c_custkey AS k, CASE WHEN c_custkey = 7 THEN 8 WHEN c_custkey = 8 THEN 7 WHEN c_custkey % 10 = 0 OR c_custkey < 3 THEN NULL ELSE c_custkey // 3 END AS nxt FROM customer)"


def redirect_pages(spark, d):
    k = F.col("c_custkey")
    target = F.when(k == 7, 8).when(k == 8, 7).when((k % 10 == 0) | (k < 3), F.lit(None)).otherwise(F.floor(k / 3))
    return table(spark, d, "customer").select(k.cast("string").alias("title"), target.cast("bigint").cast("string").alias("redirect_target"), target.isNotNull().alias("is_redirect"), F.array().cast("array<string>").alias("links"))


@query(f"""WITH RECURSIVE {HOPS}, walk AS (SELECT k AS title, k AS page, 1 AS n FROM hops UNION ALL SELECT title, nxt, n + 1 FROM walk JOIN hops ON page = k WHERE nxt IS NOT NULL AND n < 8),
done AS (SELECT title, page FROM walk JOIN hops ON page = k WHERE nxt IS NULL) SELECT h.k::VARCHAR AS title, page::VARCHAR AS canonical FROM hops h LEFT JOIN done ON h.k = title""")
def redirect_resolve(spark, d):
    pages = redirect_pages(spark, d)
    return wikigraph.resolve_redirects(pages.select("title"), pages)


#: Links: customer k links to 2k and 2k + 1.
@query("""WITH RECURSIVE walk AS (SELECT c_custkey AS k, 0 AS depth, '' AS parent FROM customer WHERE c_custkey IN (1, 5) UNION
SELECT c_custkey, depth + 1, k::VARCHAR FROM walk JOIN customer ON c_custkey IN (2 * k, 2 * k + 1) WHERE depth < 4),
first AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY depth) AS n FROM walk) SELECT k::VARCHAR AS title, depth, parent FROM first WHERE n = 1""")
def bfs_depth(spark, d):
    k = F.col("c_custkey")
    pages = table(spark, d, "customer").select(k.cast("string").alias("title"), F.array((2 * k).cast("string"), (2 * k + 1).cast("string")).alias("links"), F.lit(False).alias("is_redirect"), F.lit(None).cast("string").alias("redirect_target"))
    seeds = spark.createDataFrame([("1", 0), ("5", 1)], "title string, pos long")
    return wikigraph.expand(seeds, pages, 4)


#: The same graph behind a queue that stops at 100 pages and 300 titles: its steps one after the other, as a recursion.
@query("""WITH RECURSIVE q AS (SELECT [{'k': 1, 'd': 0, 'p': ''}, {'k': 5, 'd': 0, 'p': ''}] AS waiting, []::BIGINT[] AS seen, NULL::STRUCT(k BIGINT, d INTEGER, p VARCHAR) AS hit
UNION ALL SELECT CASE WHEN hit IS NULL OR hit.d >= 9 THEN waiting[2:] ELSE (waiting[2:] || [{'k': 2 * x.k, 'd': x.d + 1, 'p': x.k::VARCHAR}, {'k': 2 * x.k + 1, 'd': x.d + 1, 'p': x.k::VARCHAR}])[:greatest(len(waiting) - 1, 300 - len(seen))] END, seen, hit
FROM (SELECT waiting, waiting[1] AS x, CASE WHEN fresh THEN seen || [waiting[1].k] ELSE seen END AS seen, CASE WHEN fresh THEN waiting[1] END AS hit
FROM (SELECT *, waiting[1].k <= (SELECT max(c_custkey) FROM customer) AND NOT list_contains(seen, waiting[1].k) AS fresh FROM q WHERE len(waiting) > 0 AND len(seen) < 100)))
SELECT hit.k::VARCHAR AS title, hit.d AS depth, hit.p AS parent, len(seen) AS number FROM q WHERE hit IS NOT NULL""")
def bounded_crawl(spark, d):
    k = F.col("c_custkey")
    pages = table(spark, d, "customer").select(k.cast("string").alias("title"), F.array((2 * k).cast("string"), (2 * k + 1).cast("string")).alias("links"), F.lit(False).alias("is_redirect"), F.lit(None).cast("string").alias("redirect_target"))
    return wikigraph.crawl(spark.createDataFrame([("1", 0), ("5", 1)], "title string, pos long"), pages, 9, 100)


@query("""WITH pages AS (SELECT c_custkey::VARCHAR AS title, c_mktsegment AS wikitext FROM customer WHERE c_custkey % 5 <> 0),
articles AS (SELECT c_custkey::VARCHAR AS title, CASE WHEN c_custkey % 3 = 0 THEN 'old' ELSE c_mktsegment END AS text FROM customer)
SELECT a.title, p.title AS canonical, CASE WHEN p.title IS NULL THEN 'missing' WHEN text = wikitext THEN 'unchanged' ELSE 'changed' END AS status FROM articles a LEFT JOIN pages p ON a.title = p.title""")
def article_refresh(spark, d):
    rows = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("title"), F.col("c_mktsegment").alias("wikitext"), F.lit(1).alias("revision_id"), F.lit("x").alias("updated_at"), F.lit(False).alias("is_redirect"), F.lit(None).cast("string").alias("redirect_target"))
    pages = rows.filter(F.col("title").cast("int") % 5 != 0)
    stored = rows.select("title", F.when(F.col("title").cast("int") % 3 == 0, "old").otherwise(F.col("wikitext")).alias("text"), "revision_id", "updated_at")
    return wikigraph.refresh(stored, pages)


# ---- checks between layers


@query("SELECT doc_id, sha256(text) AS hash FROM documents QUALIFY row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) > 1")
def dup_ids(spark, d):
    hashed = table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("hash"))
    return validate.repeated(hashed, F.col("hash"), ["doc_id"])


@query("SELECT sha256(text) AS hash, min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY 1")
def exact_dedup(spark, d):
    return incremental.exact_groups(table(spark, d, "documents"), "text", "doc_id")


@query("SELECT doc_id FROM documents ANTI JOIN labels USING (doc_id)")
def missing_embedding(spark, d):
    return validate.unresolved(table(spark, d, "documents").select("doc_id"), table(spark, d, "labels"), ["doc_id"])


@query("SELECT doc_id, quality FROM (SELECT doc_id + 17 AS doc_id, quality FROM labels) ANTI JOIN documents USING (doc_id)")
def unresolved_reference(spark, d):
    return validate.unresolved(table(spark, d, "labels").select((F.col("doc_id") + 17).alias("doc_id"), "quality"), table(spark, d, "documents"), ["doc_id"])


@query("""SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem ANTI JOIN (SELECT o_orderkey AS l_orderkey, (o_orderkey % 5 + 1)::BIGINT AS l_linenumber FROM orders) USING (l_orderkey, l_linenumber)""")
def pair_reference(spark, d):
    known = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), (F.col("o_orderkey") % 5 + 1).alias("l_linenumber"))
    return validate.unresolved(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey"), known, ["l_orderkey", "l_linenumber"])


@query("""SELECT conv_id, (turn + (conv_id + turn) // 11)::INT AS turn, (row_number() OVER (PARTITION BY conv_id ORDER BY turn + (conv_id + turn) // 11) - 1)::INT AS expected FROM conversations QUALIFY (turn + (conv_id + turn) // 11)::INT <> expected""")
def sequence_check(spark, d):
    later = (F.col("turn") + F.floor((F.col("conv_id") + F.col("turn")) / 11)).cast("int")  # every eleventh number is left out
    rows = table(spark, d, "conversations").select("conv_id", later.alias("turn"))
    return validate.sequence_breaks(rows, "conv_id", "turn", 0)


@query("""WITH r AS (SELECT conv_id, turn, turn * 3 - (conv_id % 4) * (turn % 2) AS s, turn * 3 + 2 AS e FROM conversations)
SELECT conv_id, turn, s AS start, e AS stop, lag(e) OVER (PARTITION BY conv_id ORDER BY turn) AS previous_end FROM r QUALIFY s < previous_end""")
def overlap_check(spark, d):
    t, c = F.col("turn"), F.col("conv_id")
    rows = table(spark, d, "conversations").select("conv_id", "turn", (t * 3 - c % 4 * (t % 2)).alias("start"), (t * 3 + 2).alias("stop"))
    return validate.overlaps(rows, "conv_id", "turn", "start", "stop")


def layers(spark, d):
    """Chunks and evidence of the corpus with faults: every 7th document has no source, every 11th loses its chunks, every 13th
    evidence is there twice."""
    cut = chunks_of(spark, d).withColumn("source_id", F.when(F.col("document_id") % 7 == 0, "").otherwise(F.lit("s"))).withColumn("source_file", F.col("source_id"))
    cut = kept(cut)  # as in a workspace, layers are tables that several checks read
    evidence = stages.build_evidence(cut)
    evidence = kept(evidence.unionByName(evidence.filter(F.col("document_id") % 13 == 0)))
    return cut.filter(F.col("document_id") % 11 != 0), evidence


MESSAGES = EVIDENCE + """, e AS (SELECT *, CASE WHEN document_id % 7 = 0 THEN '' ELSE 's' END AS src FROM evidence), e2 AS (SELECT * FROM e UNION ALL SELECT * FROM e WHERE document_id % 13 = 0),
messages AS (
SELECT 'lineage' AS validator, evidence_id AS identifier, 'lineage' AS rule, 'duplicate evidence_id' AS description, 'ERROR' AS severity FROM e WHERE document_id % 13 = 0
UNION ALL SELECT 'metadata', 'source_references', 'required_field', 'layer40: missing required field source_references', 'ERROR' FROM e2 WHERE src = ''
UNION ALL SELECT 'references', chunk_id, 'reference_chunk', 'chunk reference unresolved', 'FATAL' FROM e2 WHERE document_id % 11 = 0
UNION ALL SELECT 'references', chunk_id, 'reference_source', 'source references missing', 'ERROR' FROM e2 WHERE src = ''
UNION ALL SELECT 'size', evidence_id, 'size_evidence_content', 'evidence preview empty', 'WARNING' FROM e2 WHERE trim(content_preview) = '')"""


@query(f"WITH {MESSAGES} SELECT * FROM messages")
def validator_messages(spark, d):
    return validate.validate("30_to_40", *layers(spark, d)).select("validator", "identifier", "rule", "description", "severity")


@query(f"""WITH {MESSAGES}, n AS (SELECT count(*)::INT AS checked FROM e2)
SELECT validator, checked, count(*) FILTER (severity IN ('ERROR', 'FATAL')) AS failed, greatest(0, checked - count(*) FILTER (severity IN ('ERROR', 'FATAL'))) AS passed,
max_by(severity, list_position(['INFO', 'WARNING', 'ERROR', 'FATAL'], severity)) AS worst FROM messages, n GROUP BY validator, checked""")
def validator_summary(spark, d):
    chunks, evidence = layers(spark, d)
    return validate.summary(validate.validate("30_to_40", chunks, evidence), evidence.count())


@query(f"""WITH {CHUNKS} SELECT chunk_id, token_count, 'token_count below minimum' AS warning FROM chunks WHERE token_count < 100""")
def chunk_warnings(spark, d):
    rows = chunks_of(spark, d)
    checked = validate.chunk_metadata(rows).select("chunk_id", F.explode("warnings").alias("warning"))
    return rows.select("chunk_id", "token_count").join(checked, "chunk_id")


@query("""SELECT field FROM (VALUES ('source_id'), ('domain'), ('source_file'), ('created_at'), ('updated_at'), ('hash_sha256'), ('lineage')) t(field)""")
def missing_fields(spark, d):
    present = chunks_of(spark, d).columns
    want = F.array_except(F.array(*(F.lit(c) for c in validate.CHUNK_FIELDS)), F.array(*(F.lit(c) for c in present)))
    return spark.range(1).select(F.explode(want).alias("field"))


# ---- incremental


OLD_NEW = """old AS (SELECT doc_id, sha256(text) AS h FROM documents WHERE doc_id % 9 <> 1),
new AS (SELECT doc_id, CASE WHEN doc_id % 5 = 2 THEN sha256(text || 'x') ELSE sha256(text) END AS h FROM documents WHERE doc_id % 8 <> 3),
diff AS (SELECT coalesce(n.doc_id, o.doc_id) AS doc_id, CASE WHEN o.doc_id IS NULL THEN 'new' WHEN n.doc_id IS NULL THEN 'removed' WHEN o.h = n.h THEN 'unchanged' ELSE 'modified' END AS status FROM old o FULL JOIN new n USING (doc_id))"""


def states(spark, d):
    docs, i = table(spark, d, "documents"), F.col("doc_id")
    old = docs.filter(i % 9 != 1).select("doc_id", F.sha2("text", 256).alias("sha256"))
    new = docs.filter(i % 8 != 3).select("doc_id", F.sha2(F.when(i % 5 == 2, F.concat("text", F.lit("x"))).otherwise(F.col("text")), 256).alias("sha256"))
    return old, new


@query(f"WITH {OLD_NEW} SELECT * FROM diff")
def manifest_diff(spark, d):
    return incremental.manifest_diff(*states(spark, d), key="doc_id")


@query(f"""WITH {OLD_NEW} SELECT count(*) FILTER (status <> 'removed') AS total, count(*) FILTER (status = 'new') AS new, count(*) FILTER (status = 'removed') AS removed,
count(*) FILTER (status = 'modified') AS modified, count(*) FILTER (status = 'unchanged') AS unchanged, count(*) FILTER (status <> 'unchanged') > 0 AS changed FROM diff""")
def change_summary(spark, d):
    return incremental.change_summary(incremental.manifest_diff(*states(spark, d), key="doc_id"))


@query(f"WITH {OLD_NEW} SELECT doc_id, CASE status WHEN 'new' THEN 'created' WHEN 'modified' THEN 'updated' ELSE 'skipped' END AS status FROM diff WHERE status <> 'removed'")
def write_status(spark, d):
    return incremental.write_status(*states(spark, d), "doc_id", "sha256").select("doc_id", "status")


@query("""WITH l0 AS (SELECT source, sha256(doc_id::VARCHAR) AS node, doc_id::VARCHAR || ':' || sha256(text) AS line, 1 AS n FROM documents),
l1 AS (SELECT source, node[1:6] AS node, node[1:6] || ':' || sha256(string_agg(line, chr(10) ORDER BY line)) AS line, sum(n) AS n FROM l0 GROUP BY source, node[1:6]),
l2 AS (SELECT source, node[1:4] AS node, node[1:4] || ':' || sha256(string_agg(line, chr(10) ORDER BY line)) AS line, sum(n) AS n FROM l1 GROUP BY source, node[1:4]),
l3 AS (SELECT source, node[1:2] AS node, node[1:2] || ':' || sha256(string_agg(line, chr(10) ORDER BY line)) AS line, sum(n) AS n FROM l2 GROUP BY source, node[1:2])
SELECT source, sum(n)::BIGINT AS files, sha256(string_agg(line, chr(10) ORDER BY line)) AS checksum FROM l3 GROUP BY source""")
def directory_checksum(spark, d):
    files = table(spark, d, "documents").select("source", "doc_id", F.sha2("text", 256).alias("sha256"))
    return incremental.directory_checksum(files, "source", "doc_id")


@query("""WITH u AS (SELECT doc_id, lang, n_chars, 0 AS g FROM documents WHERE doc_id % 4 <> 0 UNION ALL SELECT doc_id, 'xx', n_chars + 1, 1 FROM documents WHERE doc_id % 3 = 0)
SELECT doc_id, lang, n_chars FROM u QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY g DESC) = 1""")
def upsert_last_wins(spark, d):
    docs, i = table(spark, d, "documents").select("doc_id", "lang", "n_chars"), F.col("doc_id")
    return incremental.upsert_last(docs.filter(i % 4 != 0), docs.filter(i % 3 == 0).select("doc_id", F.lit("xx").alias("lang"), (F.col("n_chars") + 1).alias("n_chars")), "doc_id")


@query("""WITH o AS (SELECT doc_id, lang, n_chars % 100 AS score FROM documents WHERE doc_id % 4 <> 0), n AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'xx' END AS lang, n_chars % 70 AS score FROM documents WHERE doc_id % 3 = 0)
SELECT coalesce(o.doc_id, n.doc_id) AS doc_id, CASE WHEN o.doc_id IS NULL OR n.score > o.score THEN coalesce(n.lang, o.lang) ELSE o.lang END AS lang,
CASE WHEN o.doc_id IS NULL OR n.score > o.score THEN coalesce(n.score, o.score) ELSE o.score END AS score FROM o FULL JOIN n ON o.doc_id = n.doc_id""")
def upsert_if_better(spark, d):
    docs, i, n = table(spark, d, "documents"), F.col("doc_id"), F.col("n_chars")
    old = docs.filter(i % 4 != 0).select("doc_id", "lang", (n % 100).alias("score"))
    new = docs.filter(i % 3 == 0).select("doc_id", F.when(i % 2 == 0, "xx").alias("lang"), (n % 70).alias("score"))
    return incremental.upsert_if_better(old, new, "doc_id", "score")


@query("SELECT d.doc_id, coalesce(l.quality = 1, false) AS downloaded, CASE WHEN l.doc_id IS NOT NULL THEN 'pdf/' || d.doc_id || '.pdf' END AS file_path FROM documents d LEFT JOIN labels l USING (doc_id)")
def mark_downloaded(spark, d):
    rows = table(spark, d, "documents").select("doc_id", F.lit(False).alias("downloaded"), F.lit(None).cast("string").alias("file_path"))
    done = table(spark, d, "labels").select("doc_id", "quality")
    return incremental.mark(rows, done, "doc_id", {"downloaded": F.col("quality") == 1, "file_path": F.concat(F.lit("pdf/"), rows.doc_id.cast("string"), F.lit(".pdf"))})


@query("""SELECT doc_id, doc_id IN (SELECT doc_id FROM labels) AS labelled, doc_id IN (SELECT vec_id FROM embeddings) AS embedded, length(text)::INT AS size FROM documents""")
def file_metadata(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.length("text").alias("size"))
    layers = {"labels": table(spark, d, "labels"), "embeddings": table(spark, d, "embeddings").withColumnRenamed("vec_id", "doc_id")}
    listed = files.layer_listing(docs, layers, "doc_id")
    return listed.select("doc_id", F.col("in_labels").alias("labelled"), F.col("in_embeddings").alias("embedded"), "size")


@query("""WITH f AS (SELECT CASE WHEN c_custkey = 77 THEN 'f0/n0.pdf' WHEN c_custkey = 78 THEN 'f0/n0_3.pdf' ELSE 'f' || c_custkey % 7 || '/P' || c_custkey || '.pdf' END AS original, CASE WHEN c_custkey = 77 THEN 'n0.pdf' WHEN c_custkey = 78 THEN 'n0_3.pdf' ELSE 'n' || c_custkey % 11 || '.pdf' END AS name FROM customer),
r AS (SELECT original, split_part(original, '/', 1) || '/' || left(name, -4) AS stem, row_number() OVER (PARTITION BY split_part(original, '/', 1), name ORDER BY lower(original), original) AS nth FROM f WHERE original NOT IN ('f0/n0.pdf', 'f0/n0_3.pdf')),
n AS (SELECT *, CASE WHEN stem <> 'f0/n0' THEN nth WHEN nth = 1 THEN 2 ELSE nth + 2 END AS k FROM r) SELECT original, stem || CASE WHEN k > 1 THEN '_' || k ELSE '' END || '.pdf' AS renamed FROM n""")
def rename_log(spark, d):
    """Customers' files in seven folders get eleven names; two files of the first folder have names already that others want."""
    k = F.col("c_custkey")
    path = F.when(k == 77, "f0/n0.pdf").when(k == 78, "f0/n0_3.pdf").otherwise(F.concat(F.lit("f"), k % 7, F.lit("/P"), k, F.lit(".pdf")))
    name = F.when(k == 77, "n0.pdf").when(k == 78, "n0_3.pdf").otherwise(F.concat(F.lit("n"), k % 11, F.lit(".pdf")))
    return files.rename_plan(table(spark, d, "customer").select(path.alias("rel_path"), name.alias("new_name")))


@query("""SELECT doc_id, 'old' AS side FROM documents ANTI JOIN labels USING (doc_id) UNION ALL SELECT doc_id, 'both' FROM (SELECT doc_id FROM documents INTERSECT SELECT doc_id FROM labels) UNION ALL SELECT vec_id, 'new' FROM (SELECT vec_id FROM embeddings EXCEPT SELECT doc_id FROM documents)""")
def set_operations(spark, d):
    a, b, c = (table(spark, d, t).select(F.col(k).alias("doc_id")) for t, k in (("documents", "doc_id"), ("labels", "doc_id"), ("embeddings", "vec_id")))
    return incremental.set_changes(a, b, "doc_id").filter("side <> 'new'").unionByName(incremental.set_changes(a, c, "doc_id").filter("side = 'new'"))


# ---- cleanup


def raw_and_documents(spark, d):
    """Pages as raw files (a fifth moved, a seventh gone) and as the documents made from them."""
    pages, i = table(spark, d, "pages"), F.col("page_id")
    name = F.concat(F.lit("F"), (i % 40).cast("string"), F.lit("_"), i.cast("string"), F.lit(".html"))
    path = F.concat(F.lit("src/"), name)
    moved = F.when(i % 5 == 0, F.concat(F.lit("new/"), name)).when(i % 5 == 1, F.concat(F.lit("new/x"), i.cast("string"), F.lit(".html"))).otherwise(path)
    raw = pages.filter(i % 7 != 0).select(moved.alias("rel_path"), F.sha2("html", 256).alias("sha256"))
    docs = pages.select(i.alias("source_id"), name.alias("source_file"), path.alias("lineage"), F.sha2("html", 256).alias("hash_sha256"))
    return docs, raw


@query("""WITH p AS (SELECT page_id AS i, 'F' || (page_id % 40) || '_' || page_id || '.html' AS name, sha256(html) AS h FROM pages),
raw AS (SELECT i, CASE WHEN i % 5 = 0 THEN 'new/' || name WHEN i % 5 = 1 THEN 'new/x' || i || '.html' ELSE 'src/' || name END AS path, h FROM p WHERE i % 7 <> 0),
uniq AS (SELECT h, min(path) AS path FROM raw GROUP BY h HAVING count(*) = 1)
SELECT p.i AS source_id, CASE WHEN raw.i IS NOT NULL AND p.i % 5 > 1 THEN 'ok' WHEN raw.i IS NOT NULL AND p.i % 5 = 0 OR uniq.h IS NOT NULL THEN 'renamed_or_moved' ELSE 'missing' END AS status,
CASE WHEN raw.i IS NOT NULL AND p.i % 5 > 1 THEN 'lineage.layer00_path' WHEN raw.i IS NOT NULL AND p.i % 5 = 0 THEN 'source_file(name)' WHEN uniq.h IS NOT NULL THEN 'hash_sha256' ELSE 'not_found' END AS match,
CASE WHEN raw.i IS NOT NULL AND p.i % 5 <> 1 THEN raw.path ELSE uniq.path END AS raw_path FROM p LEFT JOIN raw ON p.i = raw.i LEFT JOIN uniq ON p.h = uniq.h""")
def source_match_waterfall(spark, d):
    return cleanup.match_sources(*raw_and_documents(spark, d)).select("source_id", "status", "match", "raw_path")


LAYERS = """docs AS (SELECT doc_id AS document_id, source AS source_id FROM documents), gone AS (SELECT DISTINCT source AS source_id FROM documents WHERE source IN ('src3', 'src7')),
gdocs AS (SELECT * FROM docs SEMI JOIN gone USING (source_id)), ch AS (SELECT 'c' || doc_id AS chunk_id, doc_id AS document_id FROM documents),
ev AS (SELECT 'e' || doc_id AS evidence_id, 'c' || (doc_id // 2) AS chunk_id, CASE WHEN doc_id % 3 = 0 THEN source ELSE '' END AS source_id FROM documents),
gch AS (SELECT * FROM ch SEMI JOIN gdocs USING (document_id)), gev AS (SELECT * FROM ev WHERE source_id IN (SELECT source_id FROM gone) OR chunk_id IN (SELECT chunk_id FROM gch)),
kept AS (SELECT * FROM ev ANTI JOIN gev USING (evidence_id)), em AS (SELECT 'm' || doc_id AS embedding_id, 'c' || (doc_id // 3) AS chunk_id, 'e' || doc_id AS evidence_id FROM documents)"""


@query(f"""WITH {LAYERS} SELECT 'documents' AS layer, document_id::VARCHAR AS id FROM gdocs UNION ALL SELECT 'chunks', chunk_id FROM gch UNION ALL SELECT 'evidence', evidence_id FROM gev
UNION ALL SELECT 'embeddings', embedding_id FROM em WHERE chunk_id NOT IN (SELECT chunk_id FROM kept) AND evidence_id NOT IN (SELECT evidence_id FROM kept)""")
def cleanup_cascade(spark, d):
    t, i = table(spark, d, "documents"), F.col("doc_id")
    named = lambda p, x: F.concat(F.lit(p), x.cast("bigint").cast("string"))
    docs = t.select(i.alias("document_id"), F.col("source").alias("source_id"))
    missing = t.filter(F.col("source").isin("src3", "src7")).select(F.col("source").alias("source_id"))
    chunks = t.select(named("c", i).alias("chunk_id"), i.alias("document_id"))
    evidence = t.select(named("e", i).alias("evidence_id"), named("c", F.floor(i / 2)).alias("chunk_id"), F.when(i % 3 == 0, F.col("source")).otherwise("").alias("source_id"))
    embeddings = t.select(named("m", i).alias("embedding_id"), named("c", F.floor(i / 3)).alias("chunk_id"), named("e", i).alias("evidence_id"))
    gone = cleanup.cascade(missing, docs, docs, chunks, evidence, embeddings)
    ids = {"documents": "document_id", "chunks": "chunk_id", "evidence": "evidence_id", "embeddings": "embedding_id"}
    return validate.union([gone[k].select(F.lit(k).alias("layer"), F.col(c).cast("string").alias("id")) for k, c in ids.items()])


@query("SELECT DISTINCT lang AS topic FROM documents ANTI JOIN (SELECT DISTINCT lang FROM documents WHERE lang IN ('en', 'de')) k USING (lang)")
def stale_topics(spark, d):
    topics = table(spark, d, "documents").select(F.col("lang").alias("topic"))
    return cleanup.stale_topics(topics, topics.filter(F.col("topic").isin("en", "de")))


@query(r"""WITH p AS (SELECT page_id, lower(regexp_extract(url, '://([^/?#]*)', 1)) AS h, regexp_replace(regexp_extract(url, '://[^/?#]*/([a-z]*)', 1), '[^a-z]', '') AS s, page_id % 3 AS k FROM pages),
n AS (SELECT page_id, trim(regexp_replace(h, '[^\p{L}\p{N}]+', '_', 'g'), '_') AS src, s AS stem, ['html', 'pdf', 'txt'][k + 1] AS ext FROM p)
SELECT page_id, src || '_' || stem || CASE WHEN count(*) OVER (PARTITION BY src, stem) > 1 THEN '_' || ext ELSE '' END AS document_id FROM n""")
def name_collisions(spark, d):
    url = F.col("url")
    stem = F.regexp_extract(url, "://[^/?#]*/([a-z]*)", 1)
    ext = F.array(F.lit("html"), F.lit("pdf"), F.lit("txt"))[(F.col("page_id") % 3).cast("int")]
    raw = table(spark, d, "pages").select("page_id", F.concat(L.host(url), F.lit("/"), stem, F.lit("."), ext).alias("rel_path"))
    return stages.document_names(raw).select("page_id", "document_id")


# ---- audit


#: Records some of whose ids are empty, and pages that hold ids as they are, within longer ids, and within words.
AUDIT = EVIDENCE + """, records AS (SELECT evidence_id, chunk_id, 'chap' || (document_id % 11) AS chapter_id, CASE WHEN document_id % 23 = 0 THEN '' ELSE 'doc:' || document_id END AS document_id,
CASE WHEN document_id % 7 = 0 THEN ' ' ELSE 'src-' || (document_id % 20) || '-x' END AS source_id, document_id AS n FROM evidence),
pages AS (SELECT '# x (' || evidence_id || ').' AS page FROM records WHERE n % 4 = 0 UNION ALL SELECT 'see doc:' || n || '7 and[' || chunk_id || '0' FROM records WHERE n % 5 = 0 UNION ALL SELECT 'is in achap' || (n % 3) || 'ter' FROM records WHERE n % 9 = 0),
one AS (SELECT string_agg(page, chr(10)) AS whole FROM pages), ids AS (SELECT DISTINCT unnest([evidence_id, chunk_id, chapter_id, document_id, trim(source_id)]) AS id FROM records),
found AS (SELECT id FROM ids, one WHERE id <> '' AND contains(whole, id)),
flags AS (SELECT evidence_id, chunk_id, chapter_id, document_id, trim(source_id) AS source_id, coalesce(nullif(trim(source_id), ''), nullif(document_id, ''), evidence_id) AS source_key,
evidence_id IN (FROM found) AS in_evidence_id, chunk_id IN (FROM found) AS in_chunk_id, chapter_id IN (FROM found) AS in_chapter_id, document_id IN (FROM found) AS in_document_id, trim(source_id) IN (FROM found) AS in_source_id FROM records),
used AS (SELECT *, in_chunk_id AS layer30, in_chapter_id AS layer20, in_document_id OR in_source_id AS layer10, in_evidence_id OR in_chunk_id OR in_chapter_id OR in_document_id OR in_source_id AS integrated FROM flags),
rollup_ AS (SELECT source_key, count(*) AS records, bool_or(integrated) AS integrated, bool_or(layer30) AS layer30, bool_or(layer20) AS layer20, bool_or(layer10) AS layer10 FROM used GROUP BY source_key)"""


def audit_tables(spark, d):
    n = F.col("n")
    text = lambda *parts: F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))
    records = stages.build_evidence(chunks_of(spark, d)).withColumn("n", F.col("document_id")).select(
        "evidence_id", "chunk_id", text("chap", n % 11).alias("chapter_id"), F.when(n % 23 == 0, "").otherwise(text("doc:", n)).alias("document_id"), F.when(n % 7 == 0, " ").otherwise(text("src-", n % 20, "-x")).alias("source_id"), "n"
    )
    texts = [(4, text("# x (", F.col("evidence_id"), ").")), (5, text("see doc:", n, "7 and[", F.col("chunk_id"), "0")), (9, text("is in achap", n % 3, "ter"))]
    pages = records.select(F.explode(F.array_compact(F.array(*(F.when(n % k == 0, t) for k, t in texts)))).alias("page"))
    return records, pages


@query(f"WITH {AUDIT} FROM used")
def audit_records(spark, d):
    return audit.integration(*audit_tables(spark, d))


@query(f"WITH {AUDIT} FROM rollup_")
def audit_rollup(spark, d):
    return audit.source_rollup(audit_records(spark, d))


#: Layers that lack some of the chunks, chapters, documents and sources that records name.
LINEAGE = """lost AS (SELECT evidence_id, '30' AS layer, chunk_id AS id, 'chunk_missing' AS problem FROM records WHERE n % 11 = 0 UNION ALL SELECT evidence_id, '20', chapter_id, 'chapter_missing' FROM records WHERE n % 11 > 8
UNION ALL SELECT evidence_id, '10', document_id, 'document_missing' FROM records WHERE n % 17 = 0 AND document_id <> '' UNION ALL SELECT evidence_id, '10', trim(source_id), 'source_missing' FROM records WHERE n % 20 > 16 AND trim(source_id) <> '')"""


def lineage_of(spark, d):
    records, n = audit_tables(spark, d)[0], F.col("n")
    documents = records.select(F.when(n % 17 != 0, F.col("document_id")).alias("document_id"), F.when(n % 20 < 17, F.col("source_id")).alias("source_id"))
    return audit.broken_lineage(records, records.filter(n % 11 != 0), records.filter(n % 11 < 9).select(F.initcap("chapter_id").alias("chapter")), documents)


@query(f"WITH {AUDIT}, {LINEAGE} FROM lost")
def broken_lineage(spark, d):
    return lineage_of(spark, d)


#: A page per language that links to other languages' pages, one that does not exist, and the web.
PAGES_MD = """md AS (SELECT DISTINCT lang AS topic, '[a](en.md) [b](de) [c](zz.md#x) [d](https://example.com/x) [e](#top) [a](en.md) <https://example.org>' AS page FROM documents)"""


@query(f"""WITH {PAGES_MD} SELECT topic, pos, link, kind FROM md, (VALUES (0, 'en.md', 'internal'), (1, 'de', 'internal'), (2, 'zz.md#x', 'internal'), (3, 'https://example.com/x', 'external'), (4, '#top', 'ignored'), (5, 'https://example.org', 'external')) l(pos, link, kind)""")
def md_links(spark, d):
    return audit.page_links(md_pages(spark, d))


def md_pages(spark, d):
    text = "[a](en.md) [b](de) [c](zz.md#x) [d](https://example.com/x) [e](#top) [a](en.md) <https://example.org>"
    return table(spark, d, "documents").select(F.col("lang").alias("topic")).distinct().withColumn("page", F.lit(text))


@query(f"WITH {PAGES_MD} SELECT topic, 2 AS pos, 'zz.md#x' AS link, 'internal' AS kind FROM md")
def broken_links(spark, d):
    pages = md_pages(spark, d)
    return audit.broken_links(audit.page_links(pages), pages.select(F.concat("topic", F.lit(".md")).alias("name")))


@query(f"""WITH {AUDIT}, {LINEAGE}, {PAGES_MD}, requests AS (SELECT n_nationkey AS k FROM nation WHERE n_nationkey < 4)
SELECT (SELECT count(*) FROM used) AS index_records, (SELECT count(*) FROM pages) AS wiki_files, count(*) AS sources_total, count(*) FILTER (integrated) AS sources_integrated, count(*) FILTER (NOT integrated) AS sources_missing,
count(*) FILTER (NOT layer30) AS sources_missing_layer30_ref, count(*) FILTER (NOT layer20) AS sources_missing_layer20_ref, count(*) FILTER (NOT layer10) AS sources_missing_layer10_ref, (SELECT count(*) FROM lost) AS lineage_missing_links,
(SELECT count(*) * 3 FROM md) AS internal_links_checked, (SELECT count(*) FROM md) AS internal_links_broken, (SELECT count(*) FROM md) AS external_links_checked, 0::BIGINT AS external_links_broken, (SELECT count(*) FROM md) AS external_links_stale FROM rollup_""")
def audit_summary(spark, d):
    records, (_, pages), topics = audit_records(spark, d), audit_tables(spark, d), md_pages(spark, d)
    links = audit.page_links(topics)
    broken = audit.broken_links(links, topics.select(F.concat("topic", F.lit(".md")).alias("name")))
    checks = links.filter("link = 'https://example.org'").select("link", F.lit(200).alias("http_status"), F.lit("1995-01-01").cast("date").alias("last_modified"))
    return audit.audit_summary(records, pages, lineage_of(spark, d), links, broken, audit.external_findings(links, checks, "1998-08-01"))


@query("""SELECT page_id AS topic, url AS link, CASE length(url) % 5 WHEN 0 THEN 'skipped' WHEN 1 THEN 'error' WHEN 2 THEN 'error' WHEN 3 THEN 'stale' ELSE 'ok' END AS status FROM pages""")
def external_link_status(spark, d):
    """The addresses of all pages as links, against what requests gave, which is derived from their lengths."""
    links = table(spark, d, "pages").select(F.col("page_id").alias("topic"), F.lit(0).alias("pos"), F.col("url").alias("link"), F.lit("external").alias("kind"))
    m = F.length("link") % 5
    checks = links.select("link").distinct().filter(m > 0).select("link", F.when(m == 1, 404).when(m > 2, 200).alias("http_status"), F.when(m == 3, F.lit("1990-01-01").cast("date")).alias("last_modified"))
    return audit.external_findings(links, checks, "1998-08-01").drop("pos")


@query("""SELECT o_orderkey AS link, o_orderdate::DATE AS last_modified, (DATE '1998-08-01' - o_orderdate::DATE)::INT AS age_days FROM orders WHERE (DATE '1998-08-01' - o_orderdate::DATE) > 730""")
def stale_links(spark, d):
    rows = table(spark, d, "orders").select(F.col("o_orderkey").alias("link"), F.col("o_orderdate").cast("date").alias("last_modified"))
    return audit.stale(rows, "1998-08-01")


# ---- literature


def papers(spark, d):
    """Documents as papers: the first line as title, the rest of the fields from the id."""
    i, t = F.col("doc_id"), F.col("text")
    return spread(table(spark, d, "documents")).select(
        i.alias("paper_id"), F.substring(F.split(t, "\n")[0], 1, 80).alias("title"), t.alias("abstract"), F.col("source").alias("journal"), (F.lit(1995) + i % 31).cast("int").alias("year"),
        (i % 3 == 0).alias("is_open_access"), F.concat(F.lit("d"), (i % 97).cast("string")).alias("doi"), F.col("source"), (i % 4 == 0).alias("downloaded"),
    )


TOPICS = [("alpha", ["the", "THAN", "ou"], ["review"], ["worthless"]), ("beta", ["der", "que"], [], []), ("gamma", [], ["la", "en", "of"], ["idiot", "scum"])]


def topics(spark):
    return spark.createDataFrame(TOPICS, "topic string, keywords array<string>, boost_terms array<string>, penalty_terms array<string>")


PAPERS = """p AS (SELECT doc_id AS paper_id, left(string_split(text, chr(10))[1], 80) AS title, text AS abstract, source AS journal, 1995 + doc_id % 31 AS year, doc_id % 3 = 0 AS oa FROM documents),
x AS (SELECT *, lower(concat_ws(' ', nullif(title, ''), nullif(abstract, ''), nullif(journal, ''))) AS t, 2024 - year AS age FROM p),
topics(topic, kws, boosts, pens) AS (VALUES ('alpha', ['the', 'than', 'ou'], ['review'], ['worthless']), ('beta', ['der', 'que'], []::VARCHAR[], []::VARCHAR[]), ('gamma', []::VARCHAR[], ['la', 'en', 'of'], ['idiot', 'scum'])),
y AS (SELECT *, CASE WHEN regexp_matches(t, '\\bmeta.analy') THEN 1.0 WHEN regexp_matches(t, '\\breview\\b') THEN 0.4 WHEN regexp_matches(t, '\\brct\\b') THEN 0.85 ELSE 0.3 END AS st,
CASE WHEN len(kws) > 0 THEN len(list_filter(kws, lambda k: contains(t, k))) / len(kws)::DOUBLE ELSE 0 END AS kw, CASE WHEN len(boosts) > 0 THEN least(1.0, 1.5 * len(list_filter(boosts, lambda k: contains(t, k))) / len(boosts)::DOUBLE) ELSE 0 END AS bo,
CASE WHEN age <= 2 THEN 1.0::DOUBLE WHEN age <= 10 THEN 1.0::DOUBLE - age / 10.0::DOUBLE * 0.5 ELSE greatest(0.1::DOUBLE, 0.5::DOUBLE - (age - 10) * 0.02::DOUBLE) END AS re,
len(list_filter(pens, lambda k: contains(t, k))) > 0 AND NOT contains(t, 'adult') AS pen FROM x, topics),
scored AS (SELECT paper_id, topic, CASE WHEN pen THEN 0 ELSE least(1.0, 0.30 * kw + 0.25 * bo + 0.20 * st + 0.15 * re + CASE WHEN oa THEN 0.10 ELSE 0 END) END AS s FROM y)"""


@query(f"WITH {PAPERS} SELECT paper_id, topic, round(s, 6) AS relevance_score FROM scored")
def paper_score(spark, d):
    return rounded_scores(spark, d)


def rounded_scores(spark, d, least=None):
    scored = literature.score_papers(papers(spark, d), topics(spark), as_of_year=2024, digits=None, least=least)
    return scored.select("paper_id", "topic", F.round("relevance_score", 6).alias("relevance_score"))


@query(f"WITH {PAPERS} SELECT paper_id, topic, round(s, 6) AS relevance_score, row_number() OVER (PARTITION BY topic ORDER BY round(s, 6) DESC, paper_id)::INT AS rank FROM scored WHERE round(s, 6) >= 0.4 QUALIFY rank <= 20")
def rank_topn(spark, d):
    return literature.rank(rounded_scores(spark, d, least=0.39))  # a little less, as scores are rounded afterwards


@query("SELECT doc_id AS paper_id, len(list_filter(['the', 'of', 'zzz'], lambda k: contains(lower(text), k))) / 3.0::DOUBLE AS share FROM documents")
def keyword_score(spark, d):
    words = F.array(F.lit("THE"), F.lit("of"), F.lit("zzz"))
    return table(spark, d, "documents").select(F.col("doc_id").alias("paper_id"), P.keyword_share(F.lower("text"), words).alias("share"))


@query("""SELECT o_orderkey, CASE o_orderkey % 9 WHEN 0 THEN 'meta-analysis' WHEN 1 THEN 'systematic review' WHEN 2 THEN 'randomized controlled trial' WHEN 3 THEN 'cohort study' WHEN 4 THEN 'cross-sectional'
WHEN 5 THEN 'case-control' WHEN 6 THEN 'review' WHEN 7 THEN 'case report' ELSE 'unknown' END AS study_type FROM orders""")
def study_types(spark, d):
    titles = ["A meta analysis", "Systematic review of x", "An RCT", "Prospective cohort", "Cross sectional data", "case-control", "In review", "A case report", "reviewing cases"]
    title = F.element_at(F.array(*(F.lit(t) for t in titles)), (F.col("o_orderkey") % 9 + 1).cast("int"))
    return table(spark, d, "orders").select("o_orderkey", title.alias("title")).select("o_orderkey", P.study_type(F.lower("title")).alias("study_type"))


@query("SELECT source, count(*) AS papers, count(*) FILTER (doc_id % 4 = 0) AS downloaded, count(*) FILTER (doc_id % 3 = 0) AS open_access FROM documents GROUP BY source")
def source_stats(spark, d):
    return literature.source_stats(papers(spark, d))


@query("SELECT doc_id AS paper_id, n_chars AS relevance_score FROM documents WHERE doc_id % 3 = 0 AND doc_id % 4 <> 0 ORDER BY n_chars DESC, doc_id LIMIT 15")
def pending_downloads(spark, d):
    rows = papers(spark, d).join(table(spark, d, "documents").select(F.col("doc_id").alias("paper_id"), F.col("n_chars").alias("relevance_score")), "paper_id")
    return literature.pending_downloads(rows, 15).select("paper_id", "relevance_score")


@query("SELECT doc_id AS paper_id, n_chars AS relevance_score FROM documents WHERE lang = 'en' AND n_chars >= 100 ORDER BY n_chars DESC, doc_id LIMIT 10")
def best_papers(spark, d):
    rows = table(spark, d, "documents").select(F.col("doc_id").alias("paper_id"), F.col("n_chars").alias("relevance_score"), F.array("lang").alias("topics"))
    return literature.best(rows, 10, "en", 100).select("paper_id", "relevance_score")


@query(r"""SELECT c_custkey, c_name || ' - ' || CASE WHEN c_custkey % 3 = 0 THEN 'Doe, Roe et al.' ELSE 'Doe, Roe' END || ' (' || (1900 + c_custkey % 125) || ').pdf' AS file_name,
(1900 + c_custkey % 125)::INT AS year, 'https://doi.org/10/' || c_custkey AS url, (1900 + c_custkey % 125) || '_PMC' || c_custkey || '_' || regexp_replace(c_name, '[^\w\s-]', '', 'g') AS download FROM customer""")
def paper_names(spark, d):
    k, year = F.col("c_custkey"), (F.lit(1900) + F.col("c_custkey") % 125).cast("int")
    authors = F.when(k % 3 == 0, F.array(F.lit("Doe, Jane"), F.lit("Roe, R."), F.lit("Poe"))).otherwise(F.array(F.lit("Jane Doe"), F.lit("Roe, R.")))
    doi = F.concat(F.lit("10/"), k.cast("string"))
    return table(spark, d, "customer").select("c_custkey", P.paper_file_name(F.concat("c_name", F.lit(" (library genesis)")), authors, year).alias("file_name"), P.year_in(F.concat(F.lit("in "), year.cast("string"), F.lit(" x"))).alias("year"), P.best_url(F.lit(""), F.lit(None).cast("string"), doi).alias("url"), P.download_name(year, F.concat(F.lit("PMC-"), k.cast("string")), F.col("c_name")).alias("download"))


@query("SELECT count(*) AS papers, count(*) FILTER (doc_id % 4 = 0) AS downloaded, count(*) FILTER (doc_id % 3 = 0) AS open_access FROM documents")
def paper_totals(spark, d):
    return literature.totals(papers(spark, d))


@query("SELECT source, 'alpha' AS topic, 'q' AS query, count(*) AS result_count, '2024-01-01' AS searched_at FROM documents GROUP BY source")
def search_log(spark, d):
    return literature.log_searches(papers(spark, d), "alpha", "q", "2024-01-01")


@query(f"""WITH {PAPERS}, best AS (SELECT paper_id, round(s, 6) AS s FROM scored WHERE topic = 'beta' AND round(s, 6) >= 0.3 QUALIFY row_number() OVER (ORDER BY round(s, 6) DESC, paper_id) <= 20),
old AS (SELECT doc_id AS paper_id, 'old' AS title, CASE WHEN doc_id % 2 = 0 THEN 0.0 ELSE 1.0 END AS s FROM documents WHERE doc_id % 5 = 0)
SELECT coalesce(o.paper_id, b.paper_id) AS paper_id, CASE WHEN o.paper_id IS NULL OR b.s > o.s THEN p.paper_id || ' ' || p.title ELSE 'old' END AS title, CASE WHEN o.paper_id IS NULL OR b.s > o.s THEN b.s ELSE o.s END::DOUBLE AS relevance_score
FROM old o FULL JOIN best b ON o.paper_id = b.paper_id LEFT JOIN p ON p.paper_id = b.paper_id""")
def paper_store(spark, d):
    """Papers found twice for one topic go into a store that has a fifth of them, half of these with a better score."""
    p = F.col("paper_id")
    once = papers(spark, d).drop("doi").withColumns({"topic": F.lit("beta"), "doi": F.lit(None).cast("string"), "arrival": p, "title": F.concat(p.cast("string"), F.lit(" "), "title")})
    again = once.withColumn("arrival", F.col("arrival") + (1 << 40))
    store = papers(spark, d).filter(p % 5 == 0).select("paper_id", F.lit("old").alias("title"), F.when(p % 2 == 0, 0.0).otherwise(1.0).alias("relevance_score"))
    return literature.update_store(store, once.unionByName(again), topics(spark), 2024, 0.3, 20, digits=6)


@query("""SELECT 'orders' AS layer, 'document_id' AS kind, o_custkey::VARCHAR AS id FROM orders UNION SELECT 'orders', 'chunk_id', o_orderkey::VARCHAR FROM orders UNION SELECT 'lineitem', 'chunk_id', l_orderkey::VARCHAR FROM lineitem""")
def id_sets(spark, d):
    orders = table(spark, d, "orders").select(F.col("o_custkey").alias("document_id"), F.col("o_orderkey").alias("chunk_id"))
    return audit.id_sets({"orders": orders, "lineitem": table(spark, d, "lineitem").select(F.col("l_orderkey").alias("chunk_id"))})


@query("""SELECT c_custkey, 'a/' || CASE c_custkey % 4 WHEN 0 THEN 'b/x.md' WHEN 1 THEN 'x.md' WHEN 2 THEN 'b/c/x.md' ELSE 'x' END AS path FROM customer WHERE c_custkey % 4 < 3 UNION ALL SELECT c_custkey, 'x/y.md' FROM customer WHERE c_custkey % 4 = 3""")
def resolved_paths(spark, d):
    links = F.array(F.lit("x.md"), F.lit("../x.md"), F.lit("./c//x.md"), F.lit("/x/y.md"))
    k = F.col("c_custkey")
    return table(spark, d, "customer").select("c_custkey", L.resolve_path(F.lit("a/b"), links[(k % 4).cast("int")]).alias("path"))


@query("""SELECT n_nationkey, CASE n_nationkey % 4 WHEN 0 THEN n_name WHEN 1 THEN n_nationkey::VARCHAR WHEN 2 THEN 'true' ELSE n_name END AS value FROM nation""")
def json_scalars(spark, d):
    k, name = F.col("n_nationkey"), F.col("n_name")
    text = F.when(k % 4 == 0, F.concat(F.lit('"'), name, F.lit('"'))).when(k % 4 == 1, k.cast("string")).when(k % 4 == 2, "true").otherwise(F.concat(F.lit("'"), name, F.lit("'")))
    return table(spark, d, "nation").select("n_nationkey", X.json_scalar(text).alias("value"))


@query("SELECT count(DISTINCT source) AS stages, sum(n_chars % 7)::BIGINT AS created, sum(n_chars % 5)::BIGINT AS updated, 0::BIGINT AS skipped, count(*) AS warnings, count(*) FILTER (lang = 'en') AS errors FROM documents")
def run_summary(spark, d):
    reports = table(spark, d, "documents").groupBy(F.col("source").alias("stage")).agg(F.sum(F.col("n_chars") % 7).alias("created"), F.sum(F.col("n_chars") % 5).alias("updated"), F.lit(0).alias("skipped"), F.array_repeat(F.lit("w"), F.count("*").cast("int")).alias("warnings"), F.array_repeat(F.lit("e"), F.count_if(F.col("lang") == "en").cast("int")).alias("errors"))
    return stages.run_summary(reports)


@query("""WITH RECURSIVE p AS (SELECT doc_id AS paper_id, source AS topic, 'd' || doc_id // 2 AS doi, left(lower(trim(left(string_split(text, chr(10))[1], 80))), 80) AS t FROM documents),
n AS (SELECT *, list_filter(['d' || doi, CASE WHEN t <> '' THEN 't' || t END], lambda x: x IS NOT NULL) AS keys, row_number() OVER (PARTITION BY topic ORDER BY paper_id) AS i FROM p),
walk AS (SELECT DISTINCT topic, 0::BIGINT AS i, []::VARCHAR[] AS seen, NULL::BIGINT AS kept FROM p
UNION ALL SELECT n.topic, n.i, CASE WHEN list_has_any(seen, keys) THEN seen ELSE seen || keys END, CASE WHEN NOT list_has_any(seen, keys) THEN paper_id END FROM walk JOIN n ON n.topic = walk.topic AND n.i = walk.i + 1)
SELECT n.paper_id, left(string_split(text, chr(10))[1], 80) AS title, 'd' || doc_id // 2 AS doi, source AS topic, n.paper_id AS arrival FROM walk JOIN n ON kept = n.paper_id JOIN documents ON doc_id = n.paper_id""")
def greedy_dedup(spark, d):
    rows = papers(spark, d).select("paper_id", "title", F.concat(F.lit("d"), F.floor(F.col("paper_id") / 2).cast("string")).alias("doi"), F.col("journal").alias("topic"), F.col("paper_id").alias("arrival"))
    return literature.dedup_greedy(rows)


# ---- text planners and converters (stateful: no SQL twin, brute-force tests)


def chapter_rows(spark, d):
    """Documents with headings put in: every fifth line becomes a second-level heading of three words."""
    lines = F.transform(F.split("text", "\n"), lambda x, i: F.when(i % 5 == 0, F.concat(F.lit("## "), F.array_join(F.slice(F.split(x, " "), 1, 3), " "), F.lit("\n\n"), x)).otherwise(F.concat(x, F.lit("\n"))))
    docs = spread(table(spark, d, "documents"))
    return docs.select(F.col("doc_id").cast("string").alias("document_id"), F.col("source").alias("source_id"), F.lit("corpus").alias("domain"), F.col("lang").alias("topic"), F.concat("source", F.lit(".md")).alias("source_file"), F.lit("md").alias("source_format"), F.lit("2024-01-01").alias("created_at"), F.lit("2024-01-01").alias("updated_at"), F.sha2("text", 256).alias("hash_sha256"), F.array_join(lines, "\n").alias("body"))


#: The chapters of chapter_rows: five lines each, the first one's first three words as title.
CHAPTERS = r"""l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents),
g AS (SELECT doc_id, (pos // 5 + 1)::INT AS chapter, array_to_string(string_split(min(line) FILTER (pos % 5 = 0), ' ')[1:3], ' ') AS title, sum(len(regexp_extract_all(line, '\S+')))::INT AS word_count FROM l GROUP BY ALL),
t AS (SELECT *, (max(chapter) OVER (PARTITION BY doc_id))::INT AS chapters_total, left(trim(regexp_replace(regexp_replace(title, '[^\p{L}\p{N}_\s-]', '', 'g'), '[\s_]+', '_', 'g'), '_'), 60) AS safe FROM g),
chapters AS (SELECT doc_id::VARCHAR AS document_id, chapter, chapters_total, 2 AS split_level, title, word_count,
doc_id || '_' || lpad(chapter::VARCHAR, 3, '0') || '_' || CASE WHEN safe = '' THEN 'Kapitel_' || chapter ELSE safe END || '.md' AS file_name FROM t WHERE word_count >= 30)"""


@query(f"WITH {CHAPTERS} SELECT * FROM chapters")
def chapter_split(spark, d):
    return stages.split_chapters(chapter_rows(spark, d)).select("document_id", "chapter", "chapters_total", "split_level", "title", "word_count", "file_name")


@query(f"""WITH {CHAPTERS} SELECT document_id, max(chapters_total) AS chapters_total, string_agg(lpad(chapter::VARCHAR, 3, ' ') || '. [' || title || '](' || file_name || ')  _' || format('{{:,}}', word_count) || ' Wörter_', chr(10) ORDER BY chapter) AS toc FROM chapters GROUP BY document_id""")
def chapter_toc(spark, d):
    return stages.chapter_toc(stages.split_chapters(chapter_rows(spark, d)))


#: Parts as a printed list: a page of 20, a line a part, a box a word; every seventh page has a line of text across in between.
@query("""SELECT p_partkey // 20 AS page, 1 AS "table", (p_partkey % 20 + 1)::INT AS "row", [p_partkey::VARCHAR, p_name, CASE WHEN p_size % 4 = 0 THEN '' ELSE p_brand END, p_size::VARCHAR] AS cells FROM part WHERE p_partkey // 20 % 7 <> 3
UNION ALL SELECT p_partkey // 20, CASE WHEN p_partkey % 20 < 10 THEN 1 ELSE 2 END, (p_partkey % 10 + 1)::INT, [p_partkey::VARCHAR, p_name, CASE WHEN p_size % 4 = 0 THEN '' ELSE p_brand END, p_size::VARCHAR] FROM part WHERE p_partkey // 20 % 7 = 3""")
def box_tables(spark, d):
    k = F.col("p_partkey")
    y = (k % 20) * 14 + F.when(k % 20 >= 10, 14).otherwise(0)

    def words(text, x):
        """A box a word, six units a letter, from x on."""
        parts = F.split(text, " ")
        at = lambda i: x + 6 * F.length(F.array_join(F.slice(parts, 1, i), " ")) + F.when(i > 0, 6).otherwise(0)
        return F.transform(parts, lambda w, i: F.struct(at(i).cast("double").alias("x0"), (at(i) + 6 * F.length(w)).cast("double").alias("x1"), w.alias("text")))

    cells = F.concat(words(k.cast("string"), F.lit(10)), words(F.col("p_name"), F.lit(100)), F.when(F.col("p_size") % 4 != 0, words(F.col("p_brand"), F.lit(600))).otherwise(F.array().cast("array<struct<x0:double,x1:double,text:string>>")), words(F.col("p_size").cast("string"), F.lit(800)))
    boxes = table(spark, d, "part").select(F.floor(k / 20).alias("page"), y.cast("double").alias("y0"), (y + 10).cast("double").alias("y1"), F.inline(cells))
    text = boxes.filter("page % 7 = 3").select("page").distinct().select("page", F.lit(140.0).alias("y0"), F.lit(150.0).alias("y1"), F.lit(10.0).alias("x0"), F.lit(700.0).alias("x1"), F.lit("across").alias("text"))
    return boxes_of.tables(boxes.unionByName(text), ["page"])


#: What is known of a user is the event with the greatest value, of equal ones the first.
@query("""SELECT user_id, event_id, ts, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY value DESC NULLS LAST, ts, event_id) = 1""")
def stream_upsert(spark, d):
    path = f"{d}/events.parquet"
    schema = spark.read.parquet(path).schema
    folder, _, name = path.rpartition("/")
    events = spark.readStream.schema(schema).option("pathGlobFilter", name).parquet(folder)
    rows = events.select("user_id", "event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type", "value")
    return upsert.streamed_upsert(rows, "user_id", "value", ["ts", "event_id"]).withColumn("ts", F.col("ts").cast(schema["ts"].dataType))


#: Those chapters as blocks (a heading, its first two lines if they are of one kind, then a block a line), blocks above the maximum as pieces, pieces packed one after the other.
CHUNK_PLAN = CHAPTERS + r""", kept AS (SELECT doc_id, chapter, title FROM t WHERE word_count >= 30),
raw AS (SELECT l.doc_id, pos // 5 + 1 AS chapter, pos, CASE WHEN pos % 5 = 0 THEN ltrim(line) WHEN pos % 5 = 4 OR pos = max(pos) OVER (PARTITION BY l.doc_id) THEN rtrim(line) ELSE line END AS text, contains(line, '|') AND length(trim(line)) > 2 AS tabled FROM l),
paired AS (SELECT *, lag(tabled) OVER (PARTITION BY doc_id, chapter ORDER BY pos) AS before FROM raw), linked AS (SELECT *, max(CASE WHEN pos % 5 = 1 AND tabled = before THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, chapter) AS one FROM paired),
lines AS (SELECT doc_id, chapter, pos % 5 + 1 - CASE WHEN pos % 5 >= 1 THEN one ELSE 0 END AS b, string_agg(text, chr(10) ORDER BY pos) AS text FROM linked GROUP BY ALL),
blocks AS (SELECT doc_id, chapter, 0 AS b, '## ' || trim(title) AS text, true AS head FROM kept UNION ALL SELECT lines.doc_id, lines.chapter, b, text, false FROM lines JOIN kept ON lines.doc_id = kept.doc_id AND lines.chapter = kept.chapter WHERE trim(text) <> ''),
sized AS (SELECT *, len(regexp_extract_all(text, '\S+')) AS n FROM blocks), long AS (SELECT * FROM sized WHERE n > 500 AND NOT head AND NOT (contains(text, '|') AND length(trim(text)) > 2)),
parts AS (SELECT doc_id, chapter, b, list_filter(list_transform(string_split(regexp_replace(trim(text), '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), lambda x: trim(x)), lambda x: x <> '') AS ss FROM long),
sent AS (SELECT doc_id, chapter, b, unnest(ss) AS text, generate_subscripts(ss, 1) AS j FROM parts), sents AS (SELECT *, len(regexp_extract_all(text, '\S+')) AS n FROM sent),
grouped AS (SELECT doc_id, chapter, b, 0::BIGINT AS j, 0 AS g, 0::BIGINT AS size, false AS open FROM long
UNION ALL SELECT s.doc_id, s.chapter, s.b, s.j, g + CASE WHEN n > 500 OR NOT open OR size + n > 500 THEN 1 ELSE 0 END, CASE WHEN n > 500 THEN 0 WHEN NOT open OR size + n > 500 THEN n ELSE size + n END, n <= 500
FROM grouped p JOIN sents s ON s.doc_id = p.doc_id AND s.chapter = p.chapter AND s.b = p.b AND s.j = p.j + 1),
groups AS (SELECT s.doc_id, s.chapter, s.b, g, string_agg(text, ' ' ORDER BY s.j) AS text, max(n) > 500 AS windows FROM grouped p JOIN sents s ON s.doc_id = p.doc_id AND s.chapter = p.chapter AND s.b = p.b AND s.j = p.j GROUP BY ALL),
worded AS (SELECT *, regexp_extract_all(text, '\S+') AS ws FROM groups),
pieces AS (SELECT doc_id, chapter, b, 0 AS g, 0 AS w, text, n, head FROM sized WHERE (doc_id, chapter, b) NOT IN (SELECT (doc_id, chapter, b) FROM long)
UNION ALL SELECT doc_id, chapter, b, g, 0, text, len(ws), false FROM worded WHERE NOT windows
UNION ALL SELECT doc_id, chapter, b, g, w, array_to_string(ws[w * 500 + 1:(w + 1) * 500], ' '), len(ws[w * 500 + 1:(w + 1) * 500]), false FROM (SELECT *, unnest(range((len(ws) + 499) // 500)) AS w FROM worded WHERE windows)),
placed AS (SELECT *, row_number() OVER (PARTITION BY doc_id, chapter ORDER BY b, g, w) AS i, greatest(b, 1) AS number FROM pieces),
fold AS (SELECT doc_id, chapter, 0::BIGINT AS i, 1 AS chunk, 1 AS next_chunk, 0::BIGINT AS size, 0 AS held FROM kept
UNION ALL SELECT doc_id, chapter, i, c, CASE WHEN NOT head AND s >= 300 THEN c + 1 ELSE c END, CASE WHEN NOT head AND s >= 300 THEN 0 ELSE s END, CASE WHEN NOT head AND s >= 300 THEN 0 ELSE 1 END
FROM (SELECT p.doc_id, p.chapter, p.i, head, f.next_chunk + CASE WHEN shut THEN 1 ELSE 0 END AS c, CASE WHEN shut THEN n ELSE f.size + n END AS s
FROM (SELECT f.*, p.head, p.n, held > 0 AND CASE WHEN head THEN size >= 300 ELSE size + n > 500 END AS shut, p.i AS at FROM fold f JOIN placed p ON p.doc_id = f.doc_id AND p.chapter = f.chapter AND p.i = f.i + 1) f
JOIN (SELECT doc_id, chapter, i FROM placed) p ON p.doc_id = f.doc_id AND p.chapter = f.chapter AND p.i = f.at)),
chunks AS (SELECT p.doc_id, p.chapter, chunk, trim(string_agg(text, chr(10) || chr(10) ORDER BY p.i), ' ' || chr(10)) || chr(10) AS content, sum(n)::INT AS token_count, min(number)::INT AS paragraph_start, max(number)::INT AS paragraph_end
FROM fold f JOIN placed p ON p.doc_id = f.doc_id AND p.chapter = f.chapter AND p.i = f.i GROUP BY ALL),
named AS (SELECT *, 'ch' || CASE WHEN chapter < 100 THEN lpad(chapter::VARCHAR, 2, '0') ELSE chapter::VARCHAR END AS chapter_id FROM chunks)"""


@query(f"""WITH RECURSIVE {CHUNK_PLAN} SELECT 'chunk_' || doc_id || '_' || chapter_id || '_' || lpad(chunk::VARCHAR, 4, '0') AS chunk_id, doc_id::VARCHAR AS document_id, chapter_id, chunk AS sequence, token_count,
sha256(content) AS hash_sha256, paragraph_start, paragraph_end FROM named""")
def chunk_plan_full(spark, d):
    chunks = stages.plan_chunks(stages.split_chapters(chapter_rows(spark, d)), textplan.Rules())
    return chunks.select("chunk_id", "document_id", "chapter_id", "sequence", "token_count", "hash_sha256", "lineage.paragraph_start", "lineage.paragraph_end")


@query()
def normalised_documents(spark, d):
    from strataforge.sources import convert

    pages = spread(table(spark, d, "pages")).select(F.concat(F.lit("page"), F.col("page_id").cast("string")).alias("document_id"), F.concat(F.lit("pages/"), F.col("page_id").cast("string"), F.lit(".html")).alias("rel_path"), F.lit("html").alias("ext"), F.lit("2024-01-01T00:00:00Z").alias("mtime"), F.sha2("html", 256).alias("sha256"), F.col("html").cast("binary").alias("content"))
    made = convert.to_markdown(pages)
    return stages.normalise_documents(made.filter("error is null"), "web").select("document_id", "source_id", "topic", "source_format", "hash_sha256", "body", F.size("warnings").alias("warnings"))


@query()
def html_to_md(spark, d):
    from strataforge.sources import convert

    return convert.to_markdown(spread(table(spark, d, "pages")).select("page_id", F.lit("html").alias("ext"), F.concat(F.lit("p"), F.col("page_id").cast("string"), F.lit(".html")).alias("rel_path"), F.col("html").cast("binary").alias("content"))).select("page_id", "markdown", "error")


@query(f"WITH {FOUND} SELECT evidence_id AS id, score, 'evidence' AS layer, round(score * 0.75, 4) AS confidence FROM best")
def answer_context(spark, d):
    found = hash_search_topk(spark, d).select(F.col("evidence_id").alias("id"), F.col("content_preview").alias("text"), "score")
    return retrieval.answer_context([("wiki", found.limit(0)), ("evidence", found)]).select("id", "score", "layer", "confidence")


@query("""WITH w AS (SELECT l_returnflag AS grp, l_linenumber::DOUBLE AS size, sum(l_quantity) AS w FROM lineitem GROUP BY 1, 2), b AS (SELECT grp, max_by(size, (w, -size)) AS body FROM w GROUP BY grp),
h AS (SELECT grp, body, list(size ORDER BY size DESC) FILTER (size > body + 0.5) AS larger FROM w JOIN b USING (grp) GROUP BY ALL) SELECT grp, body, CASE WHEN len(larger) > 0 THEN larger[1:3] ELSE [body + 6, body + 3, body + 1] END AS headings FROM h""")
def weighted_mode(spark, d):
    lines = table(spark, d, "lineitem").select(F.col("l_returnflag").alias("grp"), F.col("l_linenumber").alias("size"), F.col("l_quantity").alias("weight"))
    return boxes_of.heading_sizes(lines, ["grp"])


@query("""SELECT stage, position::INT AS position FROM (VALUES ('discover_sources', 0), ('ingest', 1), ('chapter_splitter', 2), ('chunk_builder', 3), ('evidence_index', 4), ('embedding_builder', 5), ('wiki_builder', 6), ('analysis_builder', 7)) t(stage, position)""")
def stage_order(spark, d):
    from strataforge.plans.registry import STAGES, order

    return spark.createDataFrame([(s, i) for i, s in enumerate(order(STAGES))], "stage string, position int")


# ---- event windows (an extension: there are no streams in the original scope)


@query("SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS events, round(sum(value), 2) AS total FROM events GROUP BY 1, 2")
def hourly_events(spark, d):
    return E.hourly(table(spark, d, "events"))


@query("""WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER w < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM g) SELECT user_id, min(ts) AS session_start, count(*) AS events FROM s GROUP BY user_id, k""")
def sessions(spark, d):
    return E.sessions(table(spark, d, "events"))


@query("SELECT event_type, user_id, min(ts) AS first_ts, count(*) AS n FROM events GROUP BY 1, 2")
def first_events(spark, d):
    return E.first_events(table(spark, d, "events"))


@query("SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS events, round(sum(value), 2) AS total FROM events GROUP BY 1, 2")
def hourly_events_streamed(spark, d):
    """The same as hourly_events through Structured Streaming, all input available at once."""
    return E.streamed_hourly(spark, f"{d}/events.parquet")


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
