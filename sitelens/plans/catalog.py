"""Registered queries: Spark plan + DuckDB twin, one entry per operator group.

Every query reads the driver's tables (or data Spark derives from them)
and runs over whole tables.  Outputs are flat columns with explicit
aliases so both engines agree on names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sitelens import vocab
from sitelens.functions import html as H
from sitelens.operators import links as LK
from sitelens.plans import sqlfrag as S
from sitelens.sources.tables import pages as read_pages
from sitelens.sources.tables import spread

SparkQuery = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, SparkQuery] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: SparkQuery) -> SparkQuery:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


KEEP, SKIP = vocab.TEST_KEEP_KEYWORDS, vocab.TEST_SKIP_KEYWORDS


# --- P1, P4, P5: page fields ------------------------------------------------

@register("page_headings", f"""
WITH {S.pages_cte()},
h AS (SELECT page_id, entity, {S.title('html')} AS title,
             list_transform(regexp_extract_all({S.strip_noise('html')}, '(?is)<h1\\b[^>]*>(.*?)</h1>', 1), lambda x: {S.node_text('x')}) AS h1,
             list_transform(regexp_extract_all({S.strip_noise('html')}, '(?is)<h2\\b[^>]*>(.*?)</h2>', 1), lambda x: {S.node_text('x')}) AS h2
      FROM pg)
SELECT page_id, entity, title, array_to_string(h1, ' | ') AS h1_text, CAST(len(h1) AS BIGINT) AS n_h1,
       array_to_string(h2[1:2], ' | ') AS h2_text FROM h
""")
def page_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_pages(spark, sf_dir)
    h = p.select("page_id", "entity", H.title(F.col("html")).alias("title"),
                 H.headings(F.col("html"), 1).alias("h1"), H.headings(F.col("html"), 2, 2).alias("h2"))
    return h.select("page_id", "entity", "title", F.array_join("h1", " | ").alias("h1_text"),
                    F.size("h1").cast("bigint").alias("n_h1"), F.array_join("h2", " | ").alias("h2_text"))


# --- P6, P7, P8: anchors -----------------------------------------------------

@register("page_links", f"""
WITH {S.links_cte().strip()}
SELECT entity, page_id, CAST(link_seq AS INTEGER) AS link_seq, href, url, text, title FROM links
""")
def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    lk = LK.extract_links(read_pages(spark, sf_dir))
    return lk.select("entity", "page_id", "link_seq", "href", "url", "text", "title")


# --- F1: crawlable links (test vocabulary in text or URL) --------------------

@register("same_domain_links", f"""
WITH {S.links_cte().strip()}
SELECT entity, page_id, CAST(link_seq AS INTEGER) AS link_seq, url, text FROM links
WHERE starts_with(url, 'http') AND {S.authority('url')} = entity
  AND NOT {S.any_contains('lower(url)', vocab.CRAWL_DOC_EXTENSIONS)}
  AND ({S.any_contains('text', KEEP)} OR {S.any_contains('lower(url)', KEEP)})
""")
def same_domain_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    lk = LK.crawlable(LK.extract_links(read_pages(spark, sf_dir)), keywords=KEEP)
    return lk.select("entity", "page_id", "link_seq", "url", "text")


# --- F2-F4, W1, A1, W2: ranked links per site --------------------------------

_QUALIFIED = f"""
qual AS (SELECT * FROM links WHERE trim(text) <> '' AND NOT {S.any_contains('lower(text)', SKIP)}
         AND {S.any_contains('lower(text)', KEEP)}),
firsts AS (SELECT entity, url, page_seq, link_seq, text FROM (
           SELECT *, row_number() OVER (PARTITION BY entity, url ORDER BY page_seq, link_seq) AS rn FROM qual) WHERE rn = 1)"""


@register("link_dedup_first", f"""
WITH {S.links_cte().strip()}, {_QUALIFIED.strip()}
SELECT entity, url, page_seq, CAST(link_seq AS INTEGER) AS link_seq, text FROM firsts
""")
def link_dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    lk = LK.extract_links(read_pages(spark, sf_dir))
    return LK.first_per_url(LK.qualify(lk, KEEP, SKIP))


@register("top_links_per_site", f"""
WITH {S.links_cte().strip()}, {_QUALIFIED.strip()},
scored AS (SELECT *, {S.count_contains('lower(text)', KEEP)} AS relevance_score FROM firsts),
ranked AS (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY relevance_score DESC, page_seq, link_seq) AS rank
           FROM scored)
SELECT entity, CAST(rank AS INTEGER) AS rank, url, text, relevance_score FROM ranked WHERE rank <= {vocab.TOP_LINKS}
""")
def top_links_per_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    lk = LK.extract_links(read_pages(spark, sf_dir))
    return LK.rank_links(lk, KEEP, SKIP)


# --- P11, P12: whole-page text for matching ----------------------------------

@register("page_plain_text", f"""
WITH {S.pages_cte()}
SELECT page_id, entity, {S.plain_text('html')} AS plain_text,
       CAST(length({S.plain_text('html')}) AS INTEGER) AS n_chars FROM pg
""")
def page_plain_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_pages(spark, sf_dir).select("page_id", "entity", H.plain_text(F.col("html")).alias("plain_text"))
    return p.select("page_id", "entity", "plain_text", F.length("plain_text").alias("n_chars"))


# --- J2, J3, A1-A6, A15, A16: section classification -------------------------

from sitelens.operators import frontier as FR  # noqa: E402
from sitelens.operators import sections as SC  # noqa: E402

SECTIONS = vocab.TEST_SECTION_KEYWORDS


def _content_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_pages(spark, sf_dir)
    return p.select("entity", "page_id", "url", H.region_text(F.col("html")).alias("content"))


def _sections_sql(source: str, text: str) -> str:
    parts = [f"SELECT entity, page_id, {S.q(s)} AS section, {i} AS section_ord, "
             f"CAST({S.count_contains(f'lower({text})', kws)} AS INTEGER) AS hits FROM {source}"
             for i, (s, kws) in enumerate(SECTIONS.items())]
    return ("(SELECT entity, page_id, section, CAST(section_ord AS INTEGER) AS section_ord, hits, "
            "least(CAST(0.9 AS DOUBLE), hits * CAST(0.3 AS DOUBLE)) AS confidence FROM ("
            + " UNION ALL ".join(parts) + ") WHERE hits > 0)")


_PAGE_SECTIONS_CTE = (f"{S.pages_cte()}, ct AS (SELECT entity, page_id, url, {S.region_text('html')} AS content FROM pg), "
                      f"ps AS {_sections_sql('ct', 'content')}")


@register("page_sections", f"WITH {_PAGE_SECTIONS_CTE} SELECT * FROM ps")
def page_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SC.page_sections(_content_pages(spark, sf_dir), sections=SECTIONS)


@register("document_sections", f"""
WITH d AS (SELECT source AS entity, doc_id AS page_id, text FROM documents), ds AS {_sections_sql('d', 'text')}
SELECT entity, page_id AS doc_id, section, section_ord, hits, confidence FROM ds
""")
def document_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sitelens.sources.tables import table
    d = spread(table(spark, sf_dir, "documents"), "doc_id", "text").select(
        F.col("source").alias("entity"), F.col("doc_id").alias("page_id"), F.col("text"))
    out = SC.page_sections(d, content="text", sections=SECTIONS)
    return out.withColumnRenamed("page_id", "doc_id")


@register("page_category", f"""
WITH {_PAGE_SECTIONS_CTE}
SELECT entity, page_id, section AS category, confidence FROM (
  SELECT *, row_number() OVER (PARTITION BY entity, page_id ORDER BY confidence DESC, section_ord) AS rn FROM ps)
WHERE rn = 1
""")
def page_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SC.page_category(page_sections(spark, sf_dir))


_ALL_SECTIONS = "[" + ", ".join(S.q(s) for s in SECTIONS) + "]"


@register("section_coverage", f"""
WITH {_PAGE_SECTIONS_CTE},
f AS (SELECT e.entity, coalesce(list_sort(list(DISTINCT ps.section) FILTER (WHERE ps.section IS NOT NULL)), []) AS found
      FROM (SELECT DISTINCT entity FROM pg) e LEFT JOIN ps ON ps.entity = e.entity GROUP BY e.entity),
m AS (SELECT entity, found, list_sort(list_filter({_ALL_SECTIONS}, lambda s: NOT list_contains(found, s))) AS missing FROM f)
SELECT entity, array_to_string(found, ',') AS found, array_to_string(missing, ',') AS missing,
       CAST(len(found) AS INTEGER) AS n_found, {len(SECTIONS)} AS n_required, len(missing) = 0 AS complete FROM m
""")
def section_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    sites = read_pages(spark, sf_dir).select("entity")
    cov = SC.coverage(page_sections(spark, sf_dir), sites, SECTIONS)
    return cov.select("entity", F.array_join("found", ",").alias("found"), F.array_join("missing", ",").alias("missing"),
                      "n_found", "n_required", "complete")


@register("coverage_gaps", f"""
WITH {_PAGE_SECTIONS_CTE},
req AS (SELECT unnest({_ALL_SECTIONS}) AS section, CAST(generate_subscripts({_ALL_SECTIONS}, 1) - 1 AS INTEGER) AS section_ord)
SELECT e.entity, r.section, r.section_ord FROM (SELECT DISTINCT entity FROM pg) e CROSS JOIN req r
WHERE NOT EXISTS (SELECT 1 FROM ps WHERE ps.entity = e.entity AND ps.section = r.section)
""")
def coverage_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    sites = read_pages(spark, sf_dir).select("entity")
    return SC.coverage_gaps(page_sections(spark, sf_dir), sites, SECTIONS).select("entity", "section", "section_ord")


@register("link_priorities", f"""
WITH {S.links_cte().strip()},
la AS (SELECT entity, page_id, link_seq, url,
              list_filter([{', '.join(f"CASE WHEN {S.any_contains('lower(text)', kws)} THEN {S.q(s)} END" for s, kws in SECTIONS.items())}],
                          lambda s: s IS NOT NULL) AS expected
       FROM links WHERE trim(text) <> '')
SELECT entity, page_id, CAST(link_seq AS INTEGER) AS link_seq, url, CAST(0.8 AS DOUBLE) AS relevance_score,
       'high' AS priority, array_to_string(expected, ',') AS expected_content
FROM la WHERE len(expected) > 0
""")
def link_priorities(spark: SparkSession, sf_dir: str) -> DataFrame:
    lk = LK.extract_links(read_pages(spark, sf_dir))
    la = SC.link_analysis(lk, SECTIONS)
    return la.withColumn("expected_content", F.array_join("expected_content", ","))


# --- I1, I2, J4, J5, A7: frontier expansion over derived links ---------------

def _derived_links(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The derived edges with the place of the first link that gives each, all of high priority."""
    seeds, edges = _derived_edges(spark, sf_dir, None, ["link_seq"])
    return seeds, edges.groupBy("src", "dst").agg(F.min("link_seq").alias("link_seq")).withColumn("priority", F.lit("high"))


def _derived_edges(spark: SparkSession, sf_dir: str, keep: list[str] | None,
                   more: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Link k of the i-th page of a site points to page (7*i + 13*k + 1) mod n of
    the same site of n pages (test graph: no anchor of the corpus resolves to a
    page of the table).  Nodes are page ids."""
    p = read_pages(spark, sf_dir)
    place = Window.partitionBy("entity").orderBy("page_id")
    ids = p.select("entity", "page_id").withColumn("i", F.row_number().over(place) - 1)
    sizes = ids.groupBy("entity").agg(F.count(F.lit(1)).alias("n"))
    lk = LK.extract_links(p)
    if keep is not None:
        lk = lk.where(F.trim("text") != "").where(SC.any_contains(F.lower(F.col("text")), keep))
    e = lk.select("entity", "page_id", "link_seq").join(ids, ["entity", "page_id"]).join(sizes, "entity")
    more = more or []
    e = e.select("entity", F.col("page_id").alias("src"), *more,
                 F.pmod(F.col("i") * 7 + F.col("link_seq") * 13 + 1, F.col("n")).alias("i")).distinct()
    edges = e.join(ids.withColumnRenamed("page_id", "dst"), ["entity", "i"]).select("src", "dst", *more)
    seeds = ids.where("i = 0").select("entity", F.col("page_id").alias("url"))
    return seeds, edges


def _reach(spark: SparkSession, sf_dir: str, keep: list[str] | None) -> DataFrame:
    seeds, edges = _derived_edges(spark, sf_dir, keep)
    return FR.crawl(seeds, edges).select("entity", F.col("url").alias("page_id"),
                                         F.col("depth").cast("int").alias("depth"))


def _reach_sql(keep: list[str] | None) -> str:
    cond = f"WHERE trim(text) <> '' AND {S.any_contains('lower(text)', keep)}" if keep else ""
    return f"""
{S.links_cte().strip()}, {S.pages_cte()},
ids AS (SELECT entity, page_id, row_number() OVER (PARTITION BY entity ORDER BY page_id) - 1 AS i,
               count(*) OVER (PARTITION BY entity) AS n FROM pg),
edges AS (SELECT DISTINCT s.page_id AS src, d.page_id AS dst
          FROM (SELECT * FROM links {cond}) l JOIN ids s ON s.page_id = l.page_id
          JOIN ids d ON d.entity = s.entity AND d.i = (7 * s.i + 13 * l.link_seq + 1) % s.n),
seeds AS (SELECT entity, page_id FROM ids WHERE i = 0),
reach AS (SELECT entity, page_id, min(depth) AS depth FROM rr GROUP BY entity, page_id)"""


def _reach_rec() -> str:
    # a shortest path has fewer steps than the site has pages
    return """rr(entity, page_id, depth) AS (
  SELECT entity, page_id, 0 FROM seeds
  UNION
  SELECT rr.entity, e.dst, rr.depth + 1 FROM rr JOIN edges e ON e.src = rr.page_id
  JOIN ids ON ids.page_id = rr.page_id WHERE rr.depth < ids.n)"""


def _reach_query(keep: list[str] | None, tail: str) -> str:
    body = _reach_sql(keep).strip()
    # the recursive CTE must precede its use; DuckDB allows any order under WITH RECURSIVE
    return f"WITH RECURSIVE {body.replace('reach AS', _reach_rec() + ', reach AS', 1)}\n{tail}"


@register("frontier_reach", _reach_query(None, "SELECT entity, page_id, CAST(depth AS INTEGER) AS depth FROM reach"))
def frontier_reach(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reach(spark, sf_dir, None).select("entity", "page_id", "depth")


@register("frontier_reach_filtered", _reach_query(KEEP, "SELECT entity, page_id, CAST(depth AS INTEGER) AS depth FROM reach"))
def frontier_reach_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reach(spark, sf_dir, KEEP).select("entity", "page_id", "depth")


@register("crawl_stats", _reach_query(KEEP, f""",
rel AS (SELECT DISTINCT ps.page_id FROM ({_sections_sql(f"(SELECT {S.authority('url')} AS entity, page_id, {S.region_text('html')} AS content FROM pages)", 'content')}) ps)
SELECT r.entity, count(*) AS total_pages_visited, count(rel.page_id) AS relevant_pages_found,
       CAST(max(r.depth) AS INTEGER) AS rounds
FROM reach r LEFT JOIN rel ON rel.page_id = r.page_id GROUP BY r.entity""").replace("\n,\nrel AS", ",\nrel AS").replace("FROM rr GROUP BY entity, page_id)\n,", "FROM rr GROUP BY entity, page_id),"))
def crawl_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    visited = _reach(spark, sf_dir, KEEP)
    ps = page_sections(spark, sf_dir).select(F.col("page_id").alias("url"), "section")
    return FR.crawl_stats(visited.withColumnRenamed("page_id", "url"), ps)


@register("crawl_snapshots", _reach_query(KEEP, f""",
rel AS (SELECT DISTINCT ps.page_id FROM ({_sections_sql(f"(SELECT {S.authority('url')} AS entity, page_id, {S.region_text('html')} AS content FROM pages)", 'content')}) ps),
each AS (SELECT r.entity, r.depth, count(*) AS n, count(rel.page_id) AS n_rel
         FROM reach r LEFT JOIN rel ON rel.page_id = r.page_id GROUP BY 1, 2)
SELECT entity, CAST(depth AS INTEGER) AS round,
       CAST(sum(n) OVER (PARTITION BY entity ORDER BY depth) AS BIGINT) AS total_pages_visited,
       CAST(sum(n_rel) OVER (PARTITION BY entity ORDER BY depth) AS BIGINT) AS relevant_pages_found
FROM each""").replace("\n,\nrel AS", ",\nrel AS"))
def crawl_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A crawl that ends after two rounds and is taken up again; its counts after every round."""
    from sitelens.session import scratch_dir
    from sitelens.sources.snapshots import SnapshotStore
    seeds, edges = _derived_edges(spark, sf_dir, KEEP)
    path = scratch_dir(spark, "crawl-snapshots")
    FR.crawl(seeds, edges, snapshots=SnapshotStore(spark, path), stop_after=2)
    store = SnapshotStore(spark, path)
    FR.crawl(seeds, edges, snapshots=store)
    ps = page_sections(spark, sf_dir).select(F.col("page_id").alias("url"), "section")
    return FR.history(store, ps)


# --- P18, P19, P20, A11, U3, U5: fragments, leaves and the deep merge ---------

from sitelens import taxonomy as TX  # noqa: E402
from sitelens.functions.jsonpaths import json_leaves as flat_leaves  # noqa: E402
from sitelens.functions.jsonpaths import schema_paths  # noqa: E402
from sitelens.operators import merge as MG  # noqa: E402
from sitelens.operators import records as RC  # noqa: E402
from sitelens.operators import validate as VD  # noqa: E402
from sitelens.operators import matchindex as MI  # noqa: E402


def _fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return RC.rule_fragments(read_pages(spark, sf_dir))


_FRAG_CTE = f"""{S.links_cte().strip()}, {S.pages_cte()},
cnt AS (SELECT page_id AS seq, count(*) AS n FROM links GROUP BY page_id),
fr AS (SELECT pg.entity, pg.page_id AS seq, coalesce({S.title('pg.html')}, '') AS title,
              regexp_extract(pg.html, {S.q(RC.LANG_RE)}, 1) AS lang, coalesce(cnt.n, 0) AS n
       FROM pg LEFT JOIN cnt ON cnt.seq = pg.page_id)"""


@register("json_leaves", f"""
WITH {_FRAG_CTE}
SELECT entity, seq, 'title' AS field_path, 'string' AS kind, title AS value, 0 AS ord FROM fr
UNION ALL SELECT entity, seq, 'lang', 'string', lang, 1 FROM fr
UNION ALL SELECT entity, page_id, 'tags[' || link_seq || ']', 'string', text, CAST(2 + link_seq AS INTEGER) FROM links
UNION ALL SELECT entity, seq, 'stats.anchors', 'number', CAST(n AS VARCHAR), CAST(2 + n AS INTEGER) FROM fr
""")
def json_leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_leaves(_fragments(spark, sf_dir), "json", ["entity", "seq"])


_MERGE_CTE = f"""{_FRAG_CTE},
ttl AS (SELECT entity, coalesce(arg_min(title, seq) FILTER (WHERE title <> ''), arg_min(title, seq)) AS v FROM fr GROUP BY entity),
lng AS (SELECT entity, coalesce(arg_min(lang, seq) FILTER (WHERE lang <> ''), arg_min(lang, seq)) AS v FROM fr GROUP BY entity),
anc AS (SELECT entity, coalesce(arg_min(n, seq) FILTER (WHERE n <> 0), arg_min(n, seq)) AS v FROM fr GROUP BY entity),
tt AS (SELECT entity, min(seq) FILTER (WHERE n > 0) AS t_seq, min(seq) AS f_seq FROM fr GROUP BY entity),
it AS (SELECT l.entity, l.page_id AS seq, l.link_seq AS idx, l.text, tt.t_seq, tt.f_seq FROM links l
       JOIN tt ON tt.entity = l.entity WHERE tt.t_seq IS NOT NULL AND l.page_id >= tt.t_seq),
firsts AS (SELECT entity, seq, idx, text FROM (
           SELECT *, row_number() OVER (PARTITION BY entity, text ORDER BY seq, idx) AS rn FROM it) WHERE rn = 1),
items AS (SELECT entity, seq, idx, text FROM firsts
          UNION ALL
          SELECT entity, seq, idx, text FROM it WHERE seq = t_seq AND t_seq = f_seq
            AND (entity, seq, idx) NOT IN (SELECT (entity, seq, idx) FROM firsts)),
merged AS (
  SELECT entity, 'title' AS path, 'node' AS node_type, 'string' AS kind, v AS value, CAST(NULL AS BIGINT) AS item_seq, CAST(NULL AS INTEGER) AS item_idx FROM ttl
  UNION ALL SELECT entity, 'lang', 'node', 'string', v, NULL, NULL FROM lng
  UNION ALL SELECT entity, 'tags', 'node', 'array', NULL, NULL, NULL FROM tt
  UNION ALL SELECT entity, 'stats', 'node', 'object', NULL, NULL, NULL FROM tt
  UNION ALL SELECT entity, 'stats.anchors', 'node', 'number', CAST(v AS VARCHAR), NULL, NULL FROM anc
  UNION ALL SELECT entity, 'admissions', 'node', 'object', NULL, NULL, NULL FROM tt
  UNION ALL SELECT entity, 'contact', 'node', 'object', NULL, NULL, NULL FROM tt
  UNION ALL SELECT entity, 'tags', 'item', 'string', text, seq, CAST(idx AS INTEGER) FROM items)"""


def _merged(spark: SparkSession, sf_dir: str):
    return MG.merge_fragments(_fragments(spark, sf_dir), TX.top_keys())


@register("merged_records", f"WITH {_MERGE_CTE} SELECT * FROM merged")
def merged_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged, items, _ = _merged(spark, sf_dir)
    return MG.flat_record(merged, items)


#: Upserts in which the fragments arrive, dealt without regard to their order.
UPSERTS = 3


@register("merged_records_incremental", ORACLES["merged_records"])
def merged_records_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sitelens.session import scratch_dir
    fragments = _fragments(spark, sf_dir)
    store = MG.RecordStore(spark, scratch_dir(spark, "records"))
    for k in range(UPSERTS):
        store.upsert(fragments.where(F.pmod(F.xxhash64("seq"), F.lit(UPSERTS)) == k), k, TX.top_keys())
    return MG.flat_record(*MG.finish(store.summary()))


# --- V1-V8, J6-J10, A12, A14: validation --------------------------------------

def record_leaves(merged: DataFrame, items: DataFrame) -> DataFrame:
    """Validation leaves of merged records: scalar nodes as 'a.b', array items
    as 'a.b[i]' in final order (object items are walked further)."""
    scal = merged.where(~F.col("kind").isin("object", "array")).select(
        "entity", F.array_join("path", ".").alias("field_path"), "kind", "value")
    from sitelens.operators.ordinals import ordinal_within
    it = ordinal_within(items.select("entity", F.array_join("path", ".").alias("p"), "seq", "idx", "kind", "value"),
                        ["entity", "p"], ["seq", "idx"])
    flat_items = it.where(F.col("kind") != "object").select(
        "entity", F.format_string("%s[%d]", "p", "pos").alias("field_path"), "kind", "value")
    objects = it.where(F.col("kind") == "object").select("entity", "p", "pos", F.col("value").alias("json"))
    obj_items = flat_leaves(objects, "json", ["entity", "p", "pos"]).select(
        "entity", F.format_string("%s[%d].%s", "p", "pos", "field_path").alias("field_path"), "kind", "value")
    return scal.unionByName(flat_items).unionByName(obj_items).withColumn("ord", F.lit(0))


def _validation_inputs(spark: SparkSession, sf_dir: str):
    """Leaves, pages and the record's parts."""
    merged, items, _ = _merged(spark, sf_dir)
    pg = read_pages(spark, sf_dir).select("entity", "url", "page_seq", H.plain_text(F.col("html")).alias("text"))
    return record_leaves(merged, items), pg, merged, items


def _validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    leaves, pg, _, _ = _validation_inputs(spark, sf_dir)
    return VD.validate_fields(leaves, pg)


def _indexed(spark: SparkSession, sf_dir: str) -> MI.IndexedValidation:
    """The same results as compared pairs and counts."""
    leaves, pg, _, _ = _validation_inputs(spark, sf_dir)
    return MI.IndexedValidation(leaves, pg)


_VALIDATION_CTE = f"""{_MERGE_CTE},
leaves AS (SELECT entity, path AS field_path, kind, value FROM merged WHERE node_type = 'node' AND kind NOT IN ('object', 'array')
           UNION ALL
           SELECT entity, path || '[' || (row_number() OVER (PARTITION BY entity, path ORDER BY item_seq, item_idx) - 1) || ']', kind, value
           FROM merged WHERE node_type = 'item'),
pt AS (SELECT entity, url, page_seq, {S.squash_ws(f"lower({S.plain_text('html')})")} AS cc FROM pg),
pairs AS (SELECT l.entity, l.field_path, l.kind, l.value, p.url, p.page_seq, p.cc,
                 {S.squash_ws('lower(l.value)')} AS cv FROM leaves l JOIN pt p ON p.entity = l.entity),
m AS (SELECT *, (kind <> 'string' OR value = {S.q(vocab.NOT_PUBLISHED)}) AS skip, contains(cc, cv) AS exact,
             CASE WHEN cv = '' THEN 0 ELSE len(string_split(cv, ' ')) END AS n_words,
             len(list_filter(string_split(cv, ' '), lambda w: contains(cc, w))) AS matched FROM pairs),
res AS (SELECT entity, field_path, url, page_seq,
               CASE WHEN skip THEN TRUE WHEN exact THEN TRUE ELSE matched >= n_words * 0.75 END AS is_valid,
               CASE WHEN skip THEN '' WHEN exact THEN cv WHEN matched >= n_words * 0.75 THEN cv ELSE '' END AS source_text,
               CASE WHEN skip THEN {S.q(VD.SKIPPED)} WHEN exact THEN {S.q(VD.EXACT)}
                    WHEN matched >= n_words * 0.75 THEN 'Fuzzy match (' || matched || '/' || n_words || ' words)'
                    ELSE {S.q(VD.NO_MATCH)} END AS notes FROM m)"""


@register("field_validation", f"WITH {_VALIDATION_CTE} SELECT entity, field_path, url, is_valid, source_text, notes FROM res")
def field_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _validation(spark, sf_dir).select("entity", "field_path", "url", "is_valid", "source_text", "notes")


@register("field_verdict", f"""WITH {_VALIDATION_CTE}
SELECT entity, field_path, bool_or(is_valid) AS valid_anywhere, arg_min(url, page_seq) FILTER (WHERE is_valid) AS first_source_url,
       count(*) AS pages_checked FROM res GROUP BY entity, field_path""")
def field_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _indexed(spark, sf_dir).verdicts()


@register("validation_summary", f"""WITH {_VALIDATION_CTE}
SELECT entity, count(*) AS total_fields, CAST(count_if(is_valid) AS BIGINT) AS valid_fields,
       CAST(count_if(NOT is_valid) AS BIGINT) AS invalid_fields, count_if(is_valid) * 100.0 / count(*) AS validation_rate,
       CAST(count_if(contains(notes, 'Exact match')) AS BIGINT) AS exact_matches,
       CAST(count_if(contains(notes, 'Fuzzy match')) AS BIGINT) AS fuzzy_matches,
       CAST(count_if(contains(notes, {S.q(vocab.NOT_PUBLISHED)})) AS BIGINT) AS not_published
FROM res GROUP BY entity""")
def validation_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _indexed(spark, sf_dir).summary(["entity"])


@register("validation_rollup", f"""WITH {_VALIDATION_CTE}
SELECT entity, regexp_extract(field_path, '^([^.\\[]*)', 1) AS section, count(*) AS total_fields,
       CAST(count_if(is_valid) AS BIGINT) AS valid_fields,
       CAST(grouping(entity, regexp_extract(field_path, '^([^.\\[]*)', 1)) AS INTEGER) AS level
FROM res GROUP BY ROLLUP (entity, regexp_extract(field_path, '^([^.\\[]*)', 1))""")
def validation_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _indexed(spark, sf_dir).rollup()


def record_urls(merged: DataFrame, items: DataFrame, pages: DataFrame) -> DataFrame:
    """The URL list of each record: the page of every value that the merge kept, so a
    page counts as often as it gave one (``times``): the pages' columns and that."""
    seqs = (merged.where(F.col("kind") != "object").select("entity", F.col("source_seq").alias("page_seq"))
            .unionByName(items.select("entity", F.col("seq").alias("page_seq"))))
    return pages.join(seqs.groupBy("entity", "page_seq").agg(F.count(F.lit(1)).alias("times")), ["entity", "page_seq"])


@register("record_url_validation", f"""WITH {_VALIDATION_CTE},
src AS (SELECT entity, coalesce(min(seq) FILTER (WHERE title <> ''), min(seq)) AS seq FROM fr GROUP BY entity
        UNION ALL SELECT entity, coalesce(min(seq) FILTER (WHERE lang <> ''), min(seq)) FROM fr GROUP BY entity
        UNION ALL SELECT entity, coalesce(min(seq) FILTER (WHERE n <> 0), min(seq)) FROM fr GROUP BY entity
        UNION ALL SELECT entity, coalesce(t_seq, f_seq) FROM tt
        UNION ALL SELECT entity, seq FROM items)
SELECT res.entity, count(*) AS total_fields, CAST(count_if(is_valid) AS BIGINT) AS valid_fields,
       CAST(count_if(NOT is_valid) AS BIGINT) AS invalid_fields, count_if(is_valid) * 100.0 / count(*) AS validation_rate,
       CAST(count_if(contains(notes, 'Exact match')) AS BIGINT) AS exact_matches,
       CAST(count_if(contains(notes, 'Fuzzy match')) AS BIGINT) AS fuzzy_matches,
       CAST(count_if(contains(notes, {S.q(vocab.NOT_PUBLISHED)})) AS BIGINT) AS not_published
FROM res JOIN src ON src.entity = res.entity AND src.seq = res.page_seq GROUP BY res.entity""")
def record_url_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every leaf against the record's own list of URLs, repeated ones counted each time."""
    leaves, pg, merged, items = _validation_inputs(spark, sf_dir)
    return MI.IndexedValidation(leaves, record_urls(merged, items, pg)).summary(["entity"])


SCHEMA = schema_paths(TX.SAMPLE_PROGRAM)
_SCHEMA_VALUES = ", ".join(f"({S.q('.'.join(p))}, {S.q(k)}, {o})" for p, k, o in SCHEMA)


@register("schema_issues", f"""WITH {_MERGE_CTE},
sp(path, kind, ord) AS (VALUES {_SCHEMA_VALUES}),
dn AS (SELECT entity, path, kind AS data_kind FROM merged WHERE node_type = 'node'),
j AS (SELECT e.entity, sp.path, sp.kind, CAST(sp.ord AS INTEGER) AS ord, dn.data_kind
      FROM (SELECT DISTINCT entity FROM dn) e CROSS JOIN sp LEFT JOIN dn ON dn.entity = e.entity AND dn.path = sp.path),
raw AS (SELECT entity, path, ord, CASE WHEN data_kind IS NULL THEN 'Missing required field: ' || path
                                  ELSE 'Type mismatch at ' || path || ': expected dict' END AS issue
        FROM j WHERE data_kind IS NULL OR (kind = 'object' AND data_kind <> 'object'))
SELECT entity, path, ord, issue FROM raw r
WHERE NOT EXISTS (SELECT 1 FROM raw a WHERE a.entity = r.entity AND starts_with(r.path, a.path || '.'))""")
def schema_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged, _, _ = _merged(spark, sf_dir)
    sp = spark.createDataFrame(SCHEMA, "path array<string>, kind string, ord int")
    dn = merged.select("entity", "path", "kind")
    return VD.structure_issues(sp, dn).select("entity", "path", "ord", "issue")


# --- P15, P16, A10, W3-W5: token usage and rate windows ----------------------

from sitelens.operators import usage as US  # noqa: E402
from sitelens.sources.tables import table  # noqa: E402

# Test limits: the derived call log is far below the production limits.
RATE_GAP_SECONDS = 4 * 3600
RATE_TPM, RATE_RPM, RATE_TPD = 600, 3, 5000


@register("token_estimates", """
SELECT conv_id, count(*) AS n_messages, CAST(sum(length(coalesce(text, ''))) AS BIGINT) AS n_chars,
       CAST(sum(length(coalesce(text, ''))) // 4 AS BIGINT) AS est_tokens
FROM conversations GROUP BY conv_id
""")
def token_estimates(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    return c.groupBy("conv_id").agg(F.count("*").alias("n_messages"),
                                    F.sum(F.length(F.coalesce("text", F.lit("")))).cast("bigint").alias("n_chars"),
                                    US.token_estimate(F.col("text")).alias("est_tokens"))


_CALLS_SQL = ("calls AS (SELECT user_id AS caller, ts, event_id AS call_id, CAST(props ->> '$.k' AS BIGINT) AS prompt_tokens, "
              "CAST(trunc(value) AS BIGINT) AS completion_tokens FROM events)")


@register("token_cost", f"""
WITH {_CALLS_SQL}
SELECT caller, count(*) AS requests, sum(prompt_tokens) AS prompt_tokens, sum(completion_tokens) AS completion_tokens,
       sum(prompt_tokens + completion_tokens) AS total_tokens,
       round(sum(prompt_tokens) / 1000.0::DOUBLE * 0.03::DOUBLE + sum(completion_tokens) / 1000.0::DOUBLE * 0.06::DOUBLE, 6) AS cost
FROM calls GROUP BY caller
""")
def token_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls = US.calls_from_events(table(spark, sf_dir, "events"))
    return US.usage_totals(calls, ["caller"])


@register("rate_sessions", f"""
WITH {_CALLS_SQL},
c AS (SELECT *, prompt_tokens + completion_tokens AS tot,
             lag(ts) OVER (PARTITION BY caller ORDER BY ts, call_id) AS prev FROM calls),
s AS (SELECT *, prev IS NULL OR epoch_us(ts) - epoch_us(prev) > {RATE_GAP_SECONDS * 1_000_000} AS session_start FROM c),
g AS (SELECT *, sum(CAST(session_start AS INTEGER)) OVER (PARTITION BY caller ORDER BY ts, call_id) AS sess FROM s),
r AS (SELECT *, coalesce(sum(tot) OVER (PARTITION BY caller, sess ORDER BY ts, call_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS mt,
             count(tot) OVER (PARTITION BY caller, sess ORDER BY ts, call_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mr,
             coalesce(sum(tot) OVER (PARTITION BY caller ORDER BY ts, call_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS tu
      FROM g)
SELECT caller, call_id, session_start, CAST(mt AS BIGINT) AS minute_tokens, CAST(mr AS BIGINT) AS minute_requests,
       CAST(tu AS BIGINT) AS tokens_used, mt >= {RATE_TPM} AS tpm_blocked, mr >= {RATE_RPM} AS rpm_blocked,
       tu >= {RATE_TPD} AS tpd_blocked, prompt_tokens + mt > {RATE_TPM} AS must_wait
FROM r
""")
def rate_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls = US.calls_from_events(table(spark, sf_dir, "events"))
    r = US.rate_windows(calls, RATE_GAP_SECONDS, RATE_TPM, RATE_RPM, RATE_TPD, chunk_seconds=86400)
    return r.drop("ts")


# --- A8, A9, F8, F10: URL accessibility --------------------------------------

from sitelens.operators import fetchlog as FL  # noqa: E402

_STATUS_CTE = f"""n AS (SELECT count(*) AS n FROM pages),
log AS (SELECT p.url, e.ts, e.event_id, CASE WHEN e.event_type = 'error' THEN 500 ELSE 200 END AS status
        FROM events e, n JOIN pages p ON p.page_id = e.user_id % n.n),
att AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY ts, event_id) AS attempt FROM log),
st AS (SELECT url, min(attempt) FILTER (WHERE status = 200) AS ok_at, count(*) AS n_attempts FROM att WHERE attempt <= 3 GROUP BY url),
status AS (SELECT p.url, st.ok_at IS NOT NULL AS accessible, CAST(coalesce(st.ok_at, st.n_attempts, 0) AS INTEGER) AS attempts_used,
                  regexp_matches(p.url, {S.q(FL.WELL_FORMED_RE)}) AS well_formed
           FROM (SELECT DISTINCT url FROM pages) p LEFT JOIN st ON st.url = p.url)"""


def _status(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages").select("page_id", "url")
    log = FL.fetch_log_from_events(table(spark, sf_dir, "events"), p)
    return FL.url_status(log, p)


@register("url_status", f"WITH {_STATUS_CTE} SELECT * FROM status")
def url_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _status(spark, sf_dir)


@register("accessible_pages", f"""WITH {_STATUS_CTE}, {S.pages_cte()}
SELECT entity, count(*) AS n_urls, CAST(count_if(accessible) AS BIGINT) AS n_accessible
FROM pg JOIN status USING (url) GROUP BY entity""")
def accessible_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    st = _status(spark, sf_dir)
    p = read_pages(spark, sf_dir).select("entity", "url")
    return p.join(st, "url").groupBy("entity").agg(F.count("*").alias("n_urls"),
                                                    F.count_if("accessible").alias("n_accessible"))


# --- P2, P3, P9, P10, P17: selector main content and prompt payloads ----------

from sitelens.operators import content as CT  # noqa: E402


@register("main_content")  # no SQL twin: DOM selectors; golden fixtures in tests/test_content.py
def main_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = CT.main_content(read_pages(spark, sf_dir))
    return out.select("entity", "page_id", "title", "content", "dom_content",
                      F.length("content").alias("content_chars"))


@register("prompt_payloads")  # no SQL twin: JSON text formatting differs between engines
def prompt_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_pages(spark, sf_dir)
    mc = CT.main_content(p).select("page_id", "content")
    pages_c = p.join(mc, "page_id")
    lk = LK.extract_links(p)
    return RC.prompt_payloads(pages_c, lk, list(SECTIONS), prefix=None)


# --- T1-T3: streaming forms (run to completion with availableNow) ------------

import os  # noqa: E402

from sitelens.streaming import streams as ST  # noqa: E402

STREAM_GAP_SECONDS = 4 * 3600


@register("stream_new_urls", f"WITH {S.links_cte().strip()} SELECT DISTINCT entity, url FROM links")
def stream_new_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ST.run_new_urls(spark, os.path.join(sf_dir, "pages.parquet")).select("entity", "url")


@register("stream_usage_sessions", f"""
WITH {_CALLS_SQL},
c AS (SELECT *, prompt_tokens + completion_tokens AS tot, lag(ts) OVER (PARTITION BY caller ORDER BY ts, call_id) AS prev FROM calls),
g AS (SELECT *, sum(CAST(prev IS NULL OR epoch_us(ts) - epoch_us(prev) > {STREAM_GAP_SECONDS * 1_000_000} AS INTEGER))
             OVER (PARTITION BY caller ORDER BY ts, call_id) AS sess FROM c)
SELECT caller, min(ts) AS session_start, max(ts) + INTERVAL {STREAM_GAP_SECONDS} SECOND AS session_end,
       count(*) AS n_calls, sum(tot) AS tokens FROM g GROUP BY caller, sess
""")
def stream_usage_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ST.run_usage_sessions(spark, os.path.join(sf_dir, "events.parquet"), f"{STREAM_GAP_SECONDS} seconds")
    return out.select("caller", F.col("session_start").cast("timestamp_ntz").alias("session_start"),
                      F.col("session_end").cast("timestamp_ntz").alias("session_end"), "n_calls", "tokens")


#: Files, and so micro-batches, in which the derived links arrive.
STREAM_LINK_FILES = 3


@register("stream_frontier_reach", ORACLES["frontier_reach"])
def stream_frontier_reach(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The links arrive in files dealt by their target, so that most pages' links come in several batches."""
    from sitelens.session import scratch_dir
    from sitelens.streaming import frontier_stream as FS
    seeds, edges = _derived_edges(spark, sf_dir, None)
    path = scratch_dir(spark, "stream-links")
    edges.repartition(STREAM_LINK_FILES, "dst").write.parquet(path)
    found = FS.run_reach(seeds, path, "src bigint, dst bigint")
    return found.select("entity", F.col("url").alias("page_id"), F.col("depth").cast("int").alias("depth"))


@register("stream_page_sections", f"WITH {_PAGE_SECTIONS_CTE} SELECT * FROM ps")
def stream_page_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ST.run_page_sections(spark, os.path.join(sf_dir, "pages.parquet"), SECTIONS, H.region_text)
    return out.select("entity", "page_id", "section", "section_ord", "hits", "confidence")


# --- I1 end to end: crawl over the corpus's own links -------------------------

#: The run time that the written documents carry.
RUN_TS = "2024-05-06 07:08:09"

_SITE_CRAWL = f"""
WITH RECURSIVE {S.links_cte().strip()}, {S.pages_cte()},
ct AS (SELECT entity, page_id, url, {S.region_text('html')} AS content FROM pg),
crawlable AS (SELECT l.* FROM links l
              WHERE starts_with(l.url, 'http') AND {S.authority('l.url')} = l.entity
                AND NOT {S.any_contains('lower(l.url)', vocab.CRAWL_DOC_EXTENSIONS)}
                AND ({S.any_contains('l.text', KEEP)} OR {S.any_contains('lower(l.url)', KEEP)})),
emitted AS (SELECT page_id, url AS dst FROM crawlable
            WHERE trim(text) <> ''
              AND ({' OR '.join(S.any_contains('lower(text)', kws) for kws in SECTIONS.values())})),
edges AS (SELECT DISTINCT p.url AS src, e.dst FROM emitted e JOIN pg p ON p.page_id = e.page_id),
seeds AS (SELECT entity, arg_min(url, page_id) AS url FROM pg GROUP BY entity),
rr(entity, url, depth) AS (
  SELECT entity, url, 0 FROM seeds
  UNION
  -- only pages have links, so a shortest path has fewer steps than there are pages
  SELECT rr.entity, e.dst, rr.depth + 1 FROM rr JOIN edges e ON e.src = rr.url
  WHERE rr.depth < (SELECT count(*) FROM pages)),
visited AS (SELECT entity, url, CAST(min(depth) AS INTEGER) AS depth FROM rr GROUP BY entity, url),
relevant AS (
  SELECT v.entity, v.depth, min(p.page_id) AS page_id FROM visited v JOIN pg p ON p.entity = v.entity AND p.url = v.url
  GROUP BY 1, 2, v.url HAVING min(p.page_id) IN (SELECT page_id FROM ({_sections_sql('ct', 'content')})))"""


def _crawl(spark: SparkSession, sf_dir: str):
    from sitelens.plans import sitejob as J
    return J.crawl_sites(read_pages(spark, sf_dir), sections=SECTIONS, link_keywords=KEEP,
                         coverage_stop=False, content_profile="region")


@register("site_crawl", f"{_SITE_CRAWL} SELECT entity, url, depth FROM visited")
def site_crawl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _crawl(spark, sf_dir).visited.select("entity", "url", F.col("depth").cast("int").alias("depth"))


@register("crawl_ranked_links", f"""{_SITE_CRAWL},
first AS (
  SELECT l.entity, l.url, arg_min(l.text, (r.depth, l.page_id, l.link_seq)) AS text,
         min((r.depth, l.page_id, l.link_seq)) AS place
  FROM crawlable l JOIN relevant r ON r.page_id = l.page_id
  WHERE trim(l.text) <> '' AND NOT {S.any_contains('lower(l.text)', SKIP)} AND {S.any_contains('lower(l.text)', KEEP)}
  GROUP BY 1, 2),
scored AS (SELECT *, CAST({S.count_contains('lower(text)', KEEP)} AS INTEGER) AS relevance_score FROM first)
SELECT entity, CAST(rank AS INTEGER) AS rank, url, text, relevance_score
FROM (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY relevance_score DESC, place) AS rank FROM scored)
WHERE rank <= {vocab.TOP_LINKS}""")
def crawl_ranked_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sitelens.plans import sitejob as J
    return J.rank_sites(_crawl(spark, sf_dir), KEEP, SKIP)


@register("crawl_documents", f"""{_SITE_CRAWL}
SELECT v.entity, count(*) AS total_pages_visited,
       (SELECT count(*) FROM relevant r WHERE r.entity = v.entity) AS relevant_pages_found
FROM visited v GROUP BY v.entity""")
def crawl_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sitelens.sources import sinks as SK
    out = _crawl(spark, sf_dir)
    return SK.crawl_counts(out.visited, out.relevant)


# --- SNK1, SNK2, SRC2, SRC3: documents written and read again ------------------

_RANKED_SQL = ORACLES["crawl_ranked_links"]


@register("ranked_documents_read_back", _RANKED_SQL)
def ranked_documents_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sitelens.session import scratch_dir
    from sitelens.sources import sinks as SK
    from sitelens.sources import tables as TB
    path = f"{scratch_dir(spark, 'ranked')}/{RUN_TS.translate(str.maketrans(' ', '_', ':-'))}"
    SK.write_documents(SK.ranked_url_documents(crawl_ranked_links(spark, sf_dir), RUN_TS), path)
    return TB.ranked_urls(spark, path)


@register("crawl_documents_read_back", f"""{_SITE_CRAWL}
SELECT l.entity, CAST(row_number() OVER (PARTITION BY l.page_id ORDER BY l.link_seq) - 1 AS INTEGER) AS link_seq,
       l.url, l.text, l.title
FROM crawlable l JOIN relevant r ON r.page_id = l.page_id""")
def crawl_documents_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sitelens.session import scratch_dir
    from sitelens.sources import sinks as SK
    from sitelens.sources import tables as TB
    path = f"{scratch_dir(spark, 'crawled')}/{RUN_TS.translate(str.maketrans(' ', '_', ':-'))}"
    SK.write_documents(_crawl(spark, sf_dir).documents, path)
    return TB.crawl_result_links(spark, path).drop("page_seq")


#: Sections that end a site's crawl in ``frontier_reach_covered``.
COVERED = list(SECTIONS)[:2]


@register("frontier_reach_covered", _reach_query(None, f""",
ps AS ({_sections_sql(f"(SELECT {S.authority('url')} AS entity, page_id, {S.region_text('html')} AS content FROM pages)", 'content')}),
firsts AS (SELECT r.entity, ps.section, min(r.depth) AS depth FROM reach r JOIN ps ON ps.page_id = r.page_id
           WHERE ps.section IN ({', '.join(S.q(x) for x in COVERED)}) GROUP BY 1, 2),
ends AS (SELECT entity, max(depth) AS depth FROM firsts GROUP BY entity HAVING count(*) = {len(COVERED)})
SELECT r.entity, r.page_id, CAST(r.depth AS INTEGER) AS depth FROM reach r LEFT JOIN ends e ON e.entity = r.entity
WHERE e.depth IS NULL OR r.depth <= e.depth""").replace("\n,\nps AS", ",\nps AS"))
def frontier_reach_covered(spark: SparkSession, sf_dir: str) -> DataFrame:
    seeds, edges = _derived_edges(spark, sf_dir, None)
    ps = page_sections(spark, sf_dir).select(F.col("page_id").alias("url"), "section")
    return (FR.crawl(seeds, edges, page_sections=ps, required=COVERED)
            .select("entity", F.col("url").alias("page_id"), F.col("depth").cast("int").alias("depth")))


_ORDER_CTE = _reach_query(None, "").strip()
_ORDER_CTE = _ORDER_CTE[:_ORDER_CTE.index("edges AS")].replace("WITH RECURSIVE", "", 1)


@register("frontier_order", f"""WITH RECURSIVE {_ORDER_CTE}
edges AS (SELECT s.page_id AS src, d.page_id AS dst, min(l.link_seq) AS link_seq
          FROM links l JOIN ids s ON s.page_id = l.page_id
          JOIN ids d ON d.entity = s.entity AND d.i = (7 * s.i + 13 * l.link_seq + 1) % s.n GROUP BY 1, 2),
rec(entity, visited, rim) AS (
  SELECT entity, [page_id], [page_id] FROM ids WHERE i = 0
  UNION ALL
  SELECT entity, list_concat(visited, fresh), fresh FROM (
    SELECT entity, visited, list(dst ORDER BY came) AS fresh FROM (
      SELECT r.entity, r.visited, e.dst, min((list_position(r.rim, e.src), e.link_seq)) AS came
      FROM rec r JOIN edges e ON list_contains(r.rim, e.src)
      WHERE NOT list_contains(r.visited, e.dst) GROUP BY 1, 2, 3)
    GROUP BY 1, 2)),
popped AS (SELECT entity, unnest(visited) AS page_id, unnest(range(0, len(visited))) AS pos
           FROM (SELECT entity, arg_max(visited, len(visited)) AS visited FROM rec GROUP BY 1)),
ps AS ({_sections_sql(f"(SELECT {S.authority('url')} AS entity, page_id, {S.region_text('html')} AS content FROM pages)", 'content')}),
firsts AS (SELECT p.entity, ps.section, min(p.pos) AS pos FROM popped p JOIN ps ON ps.page_id = p.page_id
           WHERE ps.section IN ({', '.join(S.q(x) for x in COVERED)}) GROUP BY 1, 2),
ends AS (SELECT entity, max(pos) AS pos FROM firsts GROUP BY entity HAVING count(*) = {len(COVERED)})
SELECT p.entity, p.page_id, p.pos FROM popped p LEFT JOIN ends e ON e.entity = p.entity
WHERE e.pos IS NULL OR p.pos <= e.pos""")
def frontier_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived graph's pages in the order of a site's queue, up to the page that completes it."""
    from sitelens.operators import frontier_order as FO
    seeds, links = _derived_links(spark, sf_dir)
    ps = page_sections(spark, sf_dir).select(F.col("page_id").alias("url"), "section")
    return (FO.crawl_in_order(seeds, links, ps, COVERED)
            .select("entity", F.col("url").alias("page_id"), "pos"))


# --- A17: duplicate content (exact copies after normalisation) ----------------

from sitelens.operators import dedup as DD  # noqa: E402

_DOC_HASH = f"sha256({S.squash_ws('lower(text)')})"


@register("duplicate_content", f"""
SELECT {_DOC_HASH} AS content_hash, count(*) AS n_copies, min(doc_id) AS keep_doc_id
FROM documents GROUP BY {_DOC_HASH} HAVING count(*) > 1
""")
def duplicate_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return DD.duplicate_groups(spread(table(spark, sf_dir, "documents"), "doc_id", "text"), "doc_id", "text")


@register("distinct_documents", f"""
SELECT d.doc_id, g.content_hash FROM documents d JOIN (
  SELECT {_DOC_HASH} AS content_hash, min(doc_id) AS keep_doc_id FROM documents GROUP BY {_DOC_HASH}) g
ON g.keep_doc_id = d.doc_id
""")
def distinct_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents"), "doc_id", "text")
    return DD.keep_first(docs, "doc_id", "text").select("doc_id", "content_hash")


@register("schema_issues_full", f"""WITH {_MERGE_CTE},
sp(path, kind, ord) AS (VALUES {_SCHEMA_VALUES}),
dn AS (SELECT entity, path, kind AS data_kind FROM merged WHERE node_type = 'node'),
j AS (SELECT e.entity, sp.path, sp.kind, CAST(sp.ord AS INTEGER) AS ord, dn.data_kind
      FROM (SELECT DISTINCT entity FROM dn) e CROSS JOIN sp LEFT JOIN dn ON dn.entity = e.entity AND dn.path = sp.path),
raw AS (SELECT entity, path, ord, CASE WHEN data_kind IS NULL THEN 'Missing required field: ' || path
                                       WHEN kind = 'object' THEN 'Type mismatch at ' || path || ': expected dict'
                                       ELSE 'Type mismatch at ' || path || ': expected ' || kind END AS issue
        FROM j WHERE data_kind IS NULL OR (kind = 'object' AND data_kind <> 'object')
                  OR (kind <> 'object' AND data_kind <> kind AND data_kind <> 'null'))
SELECT entity, path, ord, issue FROM raw r
WHERE NOT EXISTS (SELECT 1 FROM raw a WHERE a.entity = r.entity AND starts_with(r.path, a.path || '.'))""")
def schema_issues_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged, _, _ = _merged(spark, sf_dir)
    sp = spark.createDataFrame(SCHEMA, "path array<string>, kind string, ord int")
    dn = merged.select("entity", "path", "kind")
    return VD.structure_issues(sp, dn, full_types=True).select("entity", "path", "ord", "issue")


# --- J2 for large vocabularies: one automaton pass per text -------------------

@register("document_sections_large", ORACLES["document_sections"])
def document_sections_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sitelens.operators import vocabmatch as VM
    d = spread(table(spark, sf_dir, "documents"), "doc_id", "text").select(
        F.col("source").alias("entity"), F.col("doc_id").alias("page_id"), "text")
    out = VM.page_sections_large(d, "text", VM.vocab_table(spark, SECTIONS))
    return out.withColumnRenamed("page_id", "doc_id")


# --- J9, J10, P20: fragments of every page in right and wrong shapes ----------

#: Shape of a page's fragment by the length of its HTML: right, wrong kinds, keys with
#: dots, a missing comma, no object, cut short.  ``@`` is the page's number.
_SHAPES = [
    '{"title":"@","lang":"en","tags":["@"],"stats":{"anchors":@,"words":1},'
    '"admissions":{"deadline":"","requirements":{"gpa":"3"}},"contact":{"email":"@"}}',
    '{"title":"@","lang":null,"tags":"none","stats":"@","admissions":[],"contact":{"email":@}}',
    '{"title":@,"lang":true,"stats.anchors":@,"stats":{"words":"@","anchors.all":@},'
    '"admissions":{"deadline":@,"requirements":"none","requirements.gpa":3.5},"contact":null}',
    '{"title":"@","lang":"en" "tags":[]}',
    '[@, {"title":"@"}]',
    '{"title":"@, "lang":',
]
_SHAPED = f"""SELECT page_id, shape, replace(form, '@', CAST(page_id AS VARCHAR)) AS j
FROM pages JOIN (VALUES {", ".join(f"({k}, {S.q(form)})" for k, form in enumerate(_SHAPES))}) f(shape, form)
ON shape = length(coalesce(html, '')) % {len(_SHAPES)}"""


def _shaped_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.col("page_id").cast("string")
    form = F.element_at(F.array(*[F.lit(form) for form in _SHAPES]),
                        (F.length(F.coalesce("html", F.lit(""))) % len(_SHAPES) + 1).cast("int"))
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").cast("bigint").alias("seq"), number.alias("entity"),
                                                 F.replace(form, F.lit("@"), number).alias("json"))
    return MG.fragment_nodes(pages)


def _shaped_issues(spark: SparkSession, sf_dir: str, full_types: bool) -> DataFrame:
    nodes = _shaped_nodes(spark, sf_dir).where("depth > 0").select("entity", "path", "kind")
    sp = spark.createDataFrame(SCHEMA, "path array<string>, kind string, ord int")
    return VD.structure_issues(sp, nodes, full_types).select(F.col("entity").cast("bigint").alias("page_id"),
                                                             "path", "ord", "issue")


def _shaped_issues_sql(mismatch: str) -> str:
    return f"""WITH sp(path, kind, ord) AS (VALUES {_SCHEMA_VALUES}),
doc AS (SELECT page_id, CASE WHEN shape < 3 THEN j END AS j FROM ({_SHAPED})),
typed AS (SELECT page_id, path, kind, CAST(ord AS INTEGER) AS ord,
                 json_type(CAST(j AS JSON), '/' || replace(path, '.', '/')) AS t FROM doc CROSS JOIN sp WHERE j IS NOT NULL),
dn AS (SELECT *, CASE WHEN t IS NULL THEN NULL WHEN t = 'VARCHAR' THEN 'string' WHEN t = 'BOOLEAN' THEN 'boolean'
                      WHEN t IN ('OBJECT', 'ARRAY', 'NULL') THEN lower(t) ELSE 'number' END AS data_kind FROM typed),
raw AS (SELECT page_id, path, ord, CASE WHEN data_kind IS NULL THEN 'Missing required field: ' || path
                                        WHEN kind = 'object' THEN 'Type mismatch at ' || path || ': expected dict'
                                        ELSE 'Type mismatch at ' || path || ': expected ' || kind END AS issue
        FROM dn WHERE data_kind IS NULL OR {mismatch})
SELECT page_id, path, ord, issue FROM raw r
WHERE NOT EXISTS (SELECT 1 FROM raw a WHERE a.page_id = r.page_id AND starts_with(r.path, a.path || '.'))"""


_NOT_A_DICT = "(kind = 'object' AND data_kind <> 'object')"


@register("fragment_schema_issues", _shaped_issues_sql(_NOT_A_DICT))
def fragment_schema_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page's fragment against the schema: missing fields, and other kinds where an object is due."""
    return _shaped_issues(spark, sf_dir, full_types=False)


@register("fragment_schema_issues_full", _shaped_issues_sql(
    f"{_NOT_A_DICT} OR (kind <> 'object' AND data_kind <> kind AND data_kind <> 'null')"))
def fragment_schema_issues_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the stricter check of every kind."""
    return _shaped_issues(spark, sf_dir, full_types=True)


@register("fragment_errors", f"""SELECT page_id, reason, position, context FROM (
SELECT page_id, 'invalid JSON: Expecting '','' delimiter' AS reason, CAST(strpos(j, '"tags"') - 1 AS INTEGER) AS position,
       substr(j, greatest(strpos(j, '"tags"') - 51, 0) + 1,
              strpos(j, '"tags"') + 49 - greatest(strpos(j, '"tags"') - 51, 0)) AS context FROM ({_SHAPED}) WHERE shape = 3
UNION ALL SELECT page_id, 'not an object', 0, left(j, 100) FROM ({_SHAPED}) WHERE shape = 4
UNION ALL SELECT page_id, 'invalid JSON: Expecting '','' delimiter', CAST(strpos(j, 'lang') - 1 AS INTEGER),
       left(j, strpos(j, 'lang') + 49) FROM ({_SHAPED}) WHERE shape = 5)""")
def fragment_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fragments that are no JSON object: reason, position and the text around it."""
    return MG.fragment_errors(_shaped_nodes(spark, sf_dir)).select(F.col("seq").alias("page_id"), "reason",
                                                                   "position", "context")


# --- SNK3, SNK4, V7: documents in ordered parts -------------------------------

#: Few pieces a part, so that the small tables' documents have several parts.
TEST_PIECES_PER_PART = 500


def _read_back(spark: SparkSession, pieces: DataFrame, order: list[str], name: str) -> DataFrame:
    from sitelens.session import scratch_dir
    from sitelens.sources import parts as PT
    root = f"{scratch_dir(spark, name)}/{RUN_TS.translate(str.maketrans(' ', '_', ':-'))}"
    PT.write_parts(pieces, order, root, TEST_PIECES_PER_PART)
    return PT.read_lines(spark, root)


def _lines_sql(pieces: str) -> str:
    """pieces: entity, a list ``place`` that orders, value."""
    return f"""\nSELECT entity, unnest(range(len(l))) AS line, unnest(l) AS text FROM (
SELECT entity, string_split(string_agg(value, chr(10) ORDER BY place), chr(10)) AS l FROM ({pieces}) GROUP BY entity)"""


_MEMBER = " " * 10


def _member_sql(name: str, value: str, source: str, place: int, comma: str = ",") -> str:
    return f"""SELECT entity, [{place}, 0, 0] AS place, '{_MEMBER}"{name}": ' || {value} || '{comma}' AS value FROM {source}"""


@register("record_documents_read_back", f"WITH {_MERGE_CTE}" + _lines_sql(f"""
SELECT entity, [0, 0, 0] AS place, '{{
  "institutions": [
    {{
      "institution_name": ' || CAST(to_json(entity) AS VARCHAR) || ',
      "programs": [
        {{' AS value FROM ttl
UNION ALL {_member_sql('admissions', "'{}'", 'ttl', 1)}
UNION ALL {_member_sql('contact', "'{}'", 'ttl', 2)}
UNION ALL {_member_sql('lang', 'CAST(to_json(v) AS VARCHAR)', 'lng', 3)}
UNION ALL SELECT entity, [4, 0, 0], '{_MEMBER}"stats": {{
{_MEMBER}  "anchors": ' || v || '
{_MEMBER}}},' FROM anc
UNION ALL SELECT entity, [5, 0, 0], '{_MEMBER}"tags": [' || CASE WHEN t_seq IS NULL THEN '],' ELSE '' END FROM tt
UNION ALL SELECT entity, [6, seq, idx], '{_MEMBER}  ' || CAST(to_json(text) AS VARCHAR)
       || CASE WHEN row_number() OVER (PARTITION BY entity ORDER BY seq DESC, idx DESC) = 1 THEN '' ELSE ',' END FROM items
UNION ALL SELECT entity, [7, 0, 0], '{_MEMBER}],' FROM tt WHERE t_seq IS NOT NULL
UNION ALL {_member_sql('title', 'CAST(to_json(v) AS VARCHAR)', 'ttl', 8, '')}
UNION ALL SELECT entity, [9, 0, 0], '        }}
      ]
    }}
  ]
}}' FROM ttl"""))
def record_documents_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records as JSON documents, written in parts and read back line by line."""
    from sitelens.sources import sinks as SK
    merged, items, _ = _merged(spark, sf_dir)
    return _read_back(spark, SK.record_pieces(merged, items), SK.RECORD_ORDER, "record-documents")


_BAR = "-" * 80


@register("report_documents_read_back", f"WITH {_VALIDATION_CTE}," + f"""
pieces AS (SELECT entity, 0 AS body, CAST(0 AS BIGINT) AS page_seq, '' AS field_path, 'Validation Report - ' || entity || '
Generated: {RUN_TS}
{_BAR}
Total fields validated: ' || count(*) || '
Valid fields: ' || count_if(is_valid) || '
Invalid fields: ' || count_if(NOT is_valid) || '
Validation rate: ' || printf('%.2f', CAST(count_if(is_valid) * 100.0 / count(*) AS DOUBLE)) || '%

Match Type Breakdown:
Exact matches: ' || count_if(contains(notes, 'Exact match')) || '
Fuzzy matches: ' || count_if(contains(notes, 'Fuzzy match')) || '
Not published fields: ' || count_if(contains(notes, {S.q(vocab.NOT_PUBLISHED)})) || '
{_BAR}
Detailed Results:' AS value FROM res GROUP BY entity
UNION ALL SELECT entity, 1, page_seq, field_path, '
Field: ' || field_path || '
Valid: ' || CASE WHEN is_valid THEN 'True' ELSE 'False' END || '
Source URL: ' || url || CASE WHEN source_text <> '' THEN '
Source text: ' || left(source_text, {vocab.REPORT_PREFIX}) || '...' ELSE '' END || '
Notes: ' || notes FROM res)""" + _lines_sql("""
SELECT entity, row_number() OVER (PARTITION BY entity ORDER BY body, page_seq, field_path) AS place, value FROM pieces"""))
def report_documents_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validation reports, written in parts and read back line by line."""
    from sitelens.sources import sinks as SK
    from sitelens.session import stored
    # pairs are compared once, for the head and for the body
    results = stored(_validation(spark, sf_dir), "report-results")
    return _read_back(spark, SK.report_pieces(results, VD.summary(results, ["entity"]), RUN_TS), SK.REPORT_ORDER,
                      "report-documents")


# --- SRC2, SRC6: documents larger than a row -----------------------------------

@register("crawl_documents_split_read", ORACLES["crawl_documents_read_back"])
def crawl_documents_split_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crawl documents read without any of them in one row."""
    from pyspark.sql import types as T
    from sitelens.session import scratch_dir
    from sitelens.sources import bigjson as BJ
    from sitelens.sources import sinks as SK
    path = scratch_dir(spark, "crawled")
    SK.write_documents(_crawl(spark, sf_dir).documents, path)
    return BJ.crawl_result_links(spark, path, T.StructType([T.StructField("entity", T.StringType())])).drop("page_seq")


@register("record_document_items", f"""WITH {_MERGE_CTE}
SELECT entity, CAST(row_number() OVER (PARTITION BY entity ORDER BY seq, idx) - 1 AS BIGINT) AS idx, text FROM items""")
def record_document_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records written in parts; the items of one of their lists read from these."""
    from sitelens.session import scratch_dir
    from sitelens.sources import bigjson as BJ
    from sitelens.sources import parts as PT
    from sitelens.sources import sinks as SK
    merged, items, _ = _merged(spark, sf_dir)
    root = scratch_dir(spark, "record-documents")
    PT.write_parts(SK.record_pieces(merged, items), SK.RECORD_ORDER, root, TEST_PIECES_PER_PART)
    found = BJ.json_members(spark, f"{root}/parts", ["institutions", 0, "programs", 0, "tags"], PT.PARTITIONS, "split")
    return found.select("entity", "idx", F.element_at(F.from_json(F.concat(F.lit("["), F.col("json"), F.lit("]")),
                                                                  "array<string>"), 1).alias("text"))


# --- P5, A3, SRC4, F7, F8, F9, P13, O2 -----------------------------------------

_NAMED_META = (f"list_filter(regexp_extract_all({S.strip_noise('html')}, {S.q(H.META_RE)}, 1), "
               f"lambda t: lower({S.attr_value('t', 'name')}) = 'description')")


@register("page_descriptions", f"""WITH {S.pages_cte()}, m AS (SELECT entity, page_id, {_NAMED_META}[1] AS tag FROM pg)
SELECT entity, page_id, nullif({S.attr_value('tag', 'content')}, '') AS description FROM m""")
def page_descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_pages(spark, sf_dir).select("entity", "page_id", H.meta_description(F.col("html")).alias("description"))


@register("page_section_maps", f"""WITH {_PAGE_SECTIONS_CTE}
SELECT pg.entity, pg.page_id, coalesce(string_agg(section, ',' ORDER BY section_ord), '') AS sections,
       coalesce(string_agg(section || ':' || CAST(round(confidence * 10) AS INTEGER), ',' ORDER BY section_ord), '') AS tenths
FROM pg LEFT JOIN ps ON ps.page_id = pg.page_id GROUP BY pg.entity, pg.page_id""")
def page_section_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page's sections in the taxonomy's order, and its map of confidences in tenths."""
    maps = SC.analyze_pages(_content_pages(spark, sf_dir), sections=SECTIONS)
    tenths = F.transform("relevant_sections", lambda s: F.concat_ws(
        ":", s, F.round(F.element_at("section_confidence", s) * 10).cast("int").cast("string")))
    return maps.select("entity", "page_id", F.array_join("relevant_sections", ",").alias("sections"),
                       F.array_join(tenths, ",").alias("tenths"))


@register("url_list_read_back", f"""WITH {_STATUS_CTE}
SELECT p.url, count(*) AS n_lines, CASE WHEN bool_or(s.accessible) THEN count(*) ELSE 0 END AS n_accessible
FROM pages p JOIN status s ON s.url = p.url GROUP BY p.url
UNION ALL SELECT '', count(*), 0 FROM pages""")
def url_list_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A text file of all pages' URLs, padded and each with an empty line after it, read back; the
    lines of accessible URLs."""
    from sitelens.session import scratch_dir
    from sitelens.sources import tables as TB
    path = scratch_dir(spark, "url-list")
    url = F.col("url")
    (table(spark, sf_dir, "pages").select(F.explode(F.array(F.concat(F.lit("  "), url, F.lit("\t")), F.lit(""))))
     .write.text(path))
    lines = TB.url_list(spark, path)
    open_ = FL.accessible_only(lines, _status(spark, sf_dir)).groupBy("url").agg(F.count(F.lit(1)).alias("n"))
    return (lines.groupBy("url").agg(F.count(F.lit(1)).alias("n_lines")).join(open_, "url", "left")
            .select("url", "n_lines", F.coalesce("n", F.lit(0)).alias("n_accessible")))


#: Least relevance of ``top_links_by_score``.
MIN_SCORE = 2


@register("top_links_by_score", f"SELECT * FROM ({ORACLES['top_links_per_site']}) WHERE relevance_score >= {MIN_SCORE}")
def top_links_by_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return LK.rank_links(LK.extract_links(read_pages(spark, sf_dir)), KEEP, SKIP, min_score=MIN_SCORE)


def _content_sizes(batches):
    """An extractor that tells what it was given."""
    import json

    import pandas as pd
    for pdf in batches:
        yield pd.DataFrame({"entity": pdf["entity"], "seq": pdf["seq"], "source_url": pdf["url"],
                            "json": [json.dumps({"batch_no": int(b), "chars": len(c)})
                                     for b, c in zip(pdf["batch_no"], pdf["content"], strict=True)]})


_NOT_WEB = S.any_contains("lower(url)", vocab.EXTRACT_DOC_EXTENSIONS)


@register("extraction_batches", f"""WITH {S.pages_cte()},
r AS (SELECT entity, url, {S.region_text('html')} AS content, row_number() OVER (PARTITION BY entity ORDER BY page_id) AS rank FROM pg)
SELECT entity, rank AS seq, url, (rank - 1) // {vocab.EXTRACT_BATCH} AS batch_no, CAST(length(content) AS BIGINT) AS chars
FROM r WHERE content <> '' AND NOT {_NOT_WEB}""")
def extraction_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A site's pages, ranked as they come, that reach the extractor, with their batch and what they hold."""
    from sitelens.operators.ordinals import ordinal_within
    pages = read_pages(spark, sf_dir)
    ranks = ordinal_within(pages.select("entity", "page_id"), ["entity"], ["page_id"]).select(
        "page_id", (F.col("pos") + 1).alias("rank"))
    todo = (pages.where(~RC.non_web(F.col("url"))).withColumn("content", H.region_text(F.col("html")))
            .join(ranks, "page_id"))
    found = RC.extract_fragments(todo, _content_sizes)
    return found.select("entity", "seq", F.col("source_url").alias("url"),
                        F.get_json_object("json", "$.batch_no").cast("bigint").alias("batch_no"),
                        F.get_json_object("json", "$.chars").cast("bigint").alias("chars"))
