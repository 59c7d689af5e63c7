"""Updates of stored tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from vellum import jobs
from vellum.operators import flatten, matching, payloads, reports, upsert
from vellum.operators.digests import content_digest, digest_sql
from vellum.plans import fixtures as fx
from vellum.plans.flattening import owned_parts
from vellum.plans.nested import nested_works
from vellum.plans.registry import ORACLES, job
from vellum.session import scratch_path
from vellum.sources import snapshot, writers
from vellum.sources.keyed import RangeTable


def now():
    return F.expr(fx.spark_sql(fx.NOW))


def _date_text(df, *names):
    for name in names:
        kind = dict(df.dtypes)[name]
        c = F.date_format(name, "yyyy-MM-dd HH:mm:ss") if kind.startswith("timestamp") else F.col(name).cast("string")
        df = df.withColumn(name, c)
    return df


# The best cached abstract per work, as the transfer and the ranking query use it.
BEST = """best AS (
      SELECT * FROM (
        SELECT openalex_id, upper(wrapper) AS abstract_source, abstract, title, time_created, record_id,
               CASE upper(wrapper) WHEN 'WOS' THEN 10 WHEN 'SCOPUS' THEN 8 WHEN 'DIMENSIONS' THEN 6
                    WHEN 'PUBMED' THEN 4 ELSE 1 END AS source_rank
        FROM request WHERE solarized IS NULL AND abstract IS NOT NULL AND openalex_id IS NOT NULL)
      QUALIFY row_number() OVER (PARTITION BY openalex_id
                                 ORDER BY source_rank DESC, time_created DESC, record_id DESC) = 1)"""


@job(
    "snk_partial_update",
    f"""
    WITH <<index>>, <<request>>, {BEST}
    SELECT i.id, i.doi,
           CASE WHEN w THEN b.title ELSE i.title END AS title,
           CASE WHEN w THEN b.abstract ELSE i.abstract END AS abstract,
           CASE WHEN w THEN concat(COALESCE(b.title, ''), ' ', COALESCE(b.abstract, '')) ELSE i.title_abstract END
             AS title_abstract,
           CASE WHEN w THEN b.abstract_source ELSE i.abstract_source END AS abstract_source,
           strftime(CASE WHEN w THEN <NOW> ELSE i.abstract_date END, '%Y-%m-%d %H:%M:%S') AS abstract_date
    FROM (SELECT idx.*, b.openalex_id IS NOT NULL AND idx.abstract IS NULL AS w FROM idx
          LEFT JOIN best b ON b.openalex_id = idx.id) i
    LEFT JOIN best b ON b.openalex_id = i.id
    """,
)
def snk_partial_update(spark, sf_dir):
    best = reports.best_abstract(fx.request(spark, sf_dir))
    filled = upsert.fill_abstracts(fx.index(spark, sf_dir), best, now())
    return _date_text(filled, "abstract_date").select(
        "id", "doi", "title", "abstract", "title_abstract", "abstract_source", "abstract_date"
    )


@job(
    "snk_upsert_overwrite",
    """
    WITH <<index>>, <<update>>
    SELECT id, title, abstract, CAST(updated_date AS STRING) AS updated_date FROM upd
    UNION ALL
    SELECT id, title, abstract, CAST(updated_date AS STRING) FROM idx WHERE id NOT IN (SELECT id FROM upd)
    """,
)
def snk_upsert_overwrite(spark, sf_dir):
    columns = ["id", "title", "abstract", "updated_date"]
    old, new = fx.index(spark, sf_dir).select(columns), fx.update(spark, sf_dir).select(columns)
    return _date_text(upsert.upsert(old, new, "id"), "updated_date")


@job(
    "snk_insert_or_replace",
    """
    WITH <<request>>, <<old_works>>, newest AS (
      SELECT * FROM (SELECT openalex_id, abstract, wrapper, time_created, record_id FROM request
                     WHERE openalex_id IS NOT NULL)
      QUALIFY row_number() OVER (PARTITION BY openalex_id ORDER BY time_created, record_id) = 1)
    SELECT openalex_id, abstract, wrapper FROM newest
    UNION ALL
    SELECT openalex_id, abstract, NULL FROM old_works WHERE openalex_id NOT IN (SELECT openalex_id FROM newest)
    """,
)
def snk_insert_or_replace(spark, sf_dir):
    incoming = fx.request(spark, sf_dir).select("openalex_id", "abstract", "wrapper", "time_created", "record_id")
    replaced = upsert.insert_or_replace(
        fx.old_works(spark, sf_dir), incoming, "openalex_id", ["time_created", "record_id"]
    )
    return replaced.select("openalex_id", "abstract", "wrapper")


# Existing rows take the last non-null fields of incoming rows with a common identifier, the others are added.
_MERGE = """pairs AS (
      SELECT e.record_id AS e_id, n.* FROM existing e JOIN incoming n
        ON e.openalex_id = n.openalex_id OR e.doi = n.doi OR e.pubmed_id = n.pubmed_id),
    news AS (
      SELECT e_id, arg_max(openalex_id, (time_created, record_id)) FILTER (WHERE openalex_id IS NOT NULL) AS openalex_id,
             arg_max(doi, (time_created, record_id)) FILTER (WHERE doi IS NOT NULL) AS doi,
             arg_max(pubmed_id, (time_created, record_id)) FILTER (WHERE pubmed_id IS NOT NULL) AS pubmed_id,
             arg_max(title, (time_created, record_id)) FILTER (WHERE title IS NOT NULL) AS title,
             arg_max(abstract, (time_created, record_id)) FILTER (WHERE abstract IS NOT NULL) AS abstract
      FROM pairs GROUP BY e_id)
    SELECT e.record_id, COALESCE(n.openalex_id, e.openalex_id) AS openalex_id, COALESCE(n.doi, e.doi) AS doi,
           COALESCE(n.pubmed_id, e.pubmed_id) AS pubmed_id, e.wos_id, COALESCE(n.title, e.title) AS title,
           COALESCE(n.abstract, e.abstract) AS abstract
    FROM existing e LEFT JOIN news n ON n.e_id = e.record_id
    UNION ALL
    SELECT record_id, openalex_id, doi, pubmed_id, NULL, title, abstract FROM incoming
    WHERE record_id NOT IN (SELECT record_id FROM pairs)
"""


@job(
    "snk_merge_any_id",
    """
    WITH <<request>>, existing AS (SELECT record_id, openalex_id, doi, pubmed_id, wos_id, title, abstract FROM request
                                   WHERE wrapper = 'WOS'),
    incoming AS (SELECT record_id, openalex_id, doi, pubmed_id, title, abstract, time_created FROM request
                 WHERE wrapper IN ('PUBMED', 'SCOPUS')),
    """
    + _MERGE,
)
def snk_merge_any_id(spark, sf_dir):
    request = fx.request(spark, sf_dir)
    existing = request.where("wrapper = 'WOS'").select(
        "record_id", "openalex_id", "doi", "pubmed_id", "wos_id", "title", "abstract"
    )
    incoming = request.where("wrapper IN ('PUBMED', 'SCOPUS')").select(
        "record_id", "openalex_id", "doi", "pubmed_id", "title", "abstract", "time_created"
    )
    return matching.merge_any_id(existing, incoming, "record_id", ["time_created", "record_id"])


# Rows of a batch that share identifiers, directly or over others of the batch, are one row.
@job(
    "snk_merge_batch",
    """
    WITH RECURSIVE <<request>>,
    existing AS (SELECT record_id, openalex_id, doi, pubmed_id, wos_id, title, abstract FROM request
                 WHERE wrapper = 'WOS' AND record_id // 4 NOT IN (SELECT doc_id FROM documents WHERE source = 'src7')),
    batch AS (SELECT record_id, openalex_id, doi, pubmed_id, title, abstract, time_created FROM request
              WHERE wrapper <> 'WOS'),
    held AS (
      SELECT record_id, 'o' AS kind, openalex_id AS v FROM batch WHERE openalex_id IS NOT NULL
      UNION ALL SELECT record_id, 'd', doi FROM batch WHERE doi IS NOT NULL
      UNION ALL SELECT record_id, 'p', pubmed_id FROM batch WHERE pubmed_id IS NOT NULL),
    links AS (
      SELECT DISTINCT h.record_id AS a, m.hub AS b
      FROM held h JOIN (SELECT kind, v, min(record_id) AS hub FROM held GROUP BY kind, v) m USING (kind, v)
      WHERE h.record_id <> m.hub),
    both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
    reach AS (
      SELECT record_id AS origin, record_id AS node FROM batch
      UNION
      SELECT r.origin, l.b FROM reach r JOIN both_ways l ON l.a = r.node),
    roots AS (SELECT origin AS record_id, min(node) AS root FROM reach GROUP BY origin),
    incoming AS (
      SELECT arg_min(record_id, (time_created, record_id)) AS record_id,
             arg_max(openalex_id, (time_created, record_id)) FILTER (WHERE openalex_id IS NOT NULL) AS openalex_id,
             arg_max(doi, (time_created, record_id)) FILTER (WHERE doi IS NOT NULL) AS doi,
             arg_max(pubmed_id, (time_created, record_id)) FILTER (WHERE pubmed_id IS NOT NULL) AS pubmed_id,
             arg_max(title, (time_created, record_id)) FILTER (WHERE title IS NOT NULL) AS title,
             arg_max(abstract, (time_created, record_id)) FILTER (WHERE abstract IS NOT NULL) AS abstract,
             max(time_created) AS time_created
      FROM batch JOIN roots USING (record_id) GROUP BY root),
    """
    + _MERGE,
)
def snk_merge_batch(spark, sf_dir):
    request = fx.request_sources(spark, sf_dir)
    existing = request.where("wrapper = 'WOS' AND source <> 'src7'").select(
        "record_id", "openalex_id", "doi", "pubmed_id", "wos_id", "title", "abstract"
    )
    incoming = request.where("wrapper <> 'WOS'").select(
        "record_id", "openalex_id", "doi", "pubmed_id", "title", "abstract", "time_created"
    )
    return matching.merge_batch(existing, incoming, "record_id", ["time_created", "record_id"])


# The rows of each table that a work owns, as the flattening queries define them: (query, condition, key, columns with their kind).
_TEXT = "text"
_OWNED = {
    "works": ("flt_works", "true", "work_id", dict.fromkeys(
        "work_id title abstract countries_distinct_count display_name language publication_date publication_year volume issue first_page "
        "last_page primary_location type type_crossref cited_by_count id_doi id_mag id_pmid id_pmcid is_oa oa_status oa_url "
        "oa_any_repository_has_fulltext apc_paid apc_list license is_paratext is_retracted fulltext_origin has_fulltext indexed_in "
        "institutions_distinct_count is_authors_truncated mesh grants created_date updated_date".split(), _TEXT)),
    "works_authorships": ("flt_authorships", "true", "work_id", dict.fromkeys(
        "work_id author_id countries position exact_position raw_affiliation raw_author_name raw_affiliation_strings is_corresponding".split(),
        _TEXT)),
    "works_authorship_institutions": ("flt_authorship_institutions", "true", "work_id", dict.fromkeys(
        "work_id author_id institution_id n".split(), _TEXT)),
    "works_locations": ("flt_locations", "true", "work_id", dict.fromkeys(
        "work_id source_id is_oa is_primary is_accepted is_published landing_page_url license pdf_url version".split(), _TEXT)),
    "works_concepts": ("flt_scored_tags", "kind = 'concept'", "work_id", {
        "work_id": _TEXT, "kind": _TEXT, "tag_id": _TEXT, "display_name": _TEXT, "score": "fraction"}),
    "works_sdgs": ("flt_scored_tags", "kind = 'sdg'", "work_id", {
        "work_id": _TEXT, "kind": _TEXT, "tag_id": _TEXT, "display_name": _TEXT, "score": "fraction"}),
    "works_topics": ("flt_topic_rank", "true", "work_id", {"work_id": _TEXT, "topic_id": _TEXT, "rank": _TEXT, "score": "fraction"}),
    "works_references": ("flt_edges", "kind = 'references'", "source_id", dict.fromkeys("kind source_id target_id".split(), _TEXT)),
    "works_related": ("flt_edges", "kind = 'related'", "source_id", dict.fromkeys("kind source_id target_id".split(), _TEXT)),
}


def _digests_sql(kept: str, rows: dict[str, str] | None = None) -> str:
    """(part, work_id, n, digest) of every owned table, for works whose id meets a condition; ``rows`` replaces a table's query."""
    parts = []
    for part, (query, condition, key, columns) in _OWNED.items():
        source = (rows or {}).get(part, ORACLES[query])
        source = f"SELECT * FROM ({source}) WHERE {condition} AND {kept.format(key=key)}"
        parts.append(f"SELECT '{part}' AS part, {key} AS work_id, n, digest FROM ({digest_sql(source, key, columns)})")
    return " UNION ALL ".join(parts)


def _digests(tables):
    """The same of the tables a work owns."""
    merged = None
    for part, rows in owned_parts(tables).items():
        key = _OWNED[part][2]
        found = content_digest(rows, key).select(F.lit(part).alias("part"), F.col(key).alias("work_id"), "n", "digest")
        merged = found if merged is None else merged.unionByName(found)
    return merged


@job(
    "del_merged_ids",
    "WITH <<merged_ids>> " + _digests_sql("{key} NOT IN (SELECT id FROM merged_ids)"),
)
def del_merged_ids(spark, sf_dir):
    root = scratch_path(spark, "merges")
    log = fx.merged_ids(spark, sf_dir)
    log.write.option("compression", "gzip").csv(f"{root}/merged_ids/works", header=True)
    tables = flatten.flatten_works(nested_works(spark, sf_dir))
    return _digests(upsert.delete_merged(tables, snapshot.read_merge_log(spark, root), "work"))


@job(
    "del_cascade",
    "WITH <<update>> " + _digests_sql("{key} NOT IN (SELECT id FROM upd)"),
)
def del_cascade(spark, sf_dir):
    tables = flatten.flatten_works(nested_works(spark, sf_dir))
    return _digests(upsert.delete_entity(tables, fx.update(spark, sf_dir), "work"))


# Changed works have a new title, and their first author only.
_CHANGED = {
    "works": f"""SELECT * REPLACE (CASE WHEN work_id IN (SELECT id FROM changed) THEN concat('New ', title) ELSE title END AS title)
        FROM ({ORACLES["flt_works"]})""",
    "works_authorships": f"""SELECT * FROM ({ORACLES["flt_authorships"]})
        WHERE exact_position = 0 OR work_id NOT IN (SELECT id FROM changed)""",
    "works_authorship_institutions": """WITH <<lines>>, parts AS (
          SELECT doc_id, line, unnest(list_filter(string_split_regex(line, '[.] '), lambda s: s <> '')) AS s FROM lines
          WHERE i = 0 OR concat('W', doc_id) NOT IN (SELECT id FROM changed))
        SELECT concat('W', doc_id) AS work_id, concat('A', length(line)) AS author_id, concat('I', length(s)) AS institution_id, count(*) AS n
        FROM parts GROUP BY ALL""",
}


@job(
    "upd_replace_entity",
    "WITH changed AS (SELECT concat('W', CAST(doc_id AS STRING)) AS id FROM labels WHERE quality = 1) " + _digests_sql("true", _CHANGED),
)
def upd_replace_entity(spark, sf_dir):
    works = nested_works(spark, sf_dir)
    changed = fx.table(spark, sf_dir, "labels").where("quality = 1").select(
        F.concat(F.lit("https://openalex.org/W"), F.col("doc_id").cast("string")).alias("id")
    )
    records = works.join(changed, "id", "left_semi").withColumns(
        {"title": F.concat(F.lit("New "), F.col("title")), "authorships": F.slice("authorships", 1, 1)}
    )
    return _digests(jobs.update_tables(flatten.flatten_works(works), records, "work"))


@job(
    "upd_mark_written",
    f"""
    WITH <<request>>, {BEST}
    SELECT record_id, CASE WHEN openalex_id IN (SELECT openalex_id FROM best) THEN true ELSE solarized END AS solarized
    FROM request
    """,
)
def upd_mark_written(spark, sf_dir):
    request = fx.request(spark, sf_dir)
    return upsert.mark_written(request, reports.best_abstract(request)).select("record_id", "solarized")


@job(
    "upd_reset_written",
    """
    WITH <<request>>
    SELECT wrapper, CAST(NULL AS BOOLEAN) AS solarized, count(*) AS n FROM request GROUP BY wrapper
    """,
)
def upd_reset_written(spark, sf_dir):
    return reports.written_state(upsert.reset_written(fx.request(spark, sf_dir)))


@job(
    "upd_backfill_doi",
    """
    WITH <<request>>
    SELECT record_id, CASE WHEN doi IS NOT NULL THEN doi
                           WHEN wrapper = 'WOS' AND raw IS NOT NULL
                                THEN concat(CASE WHEN strpos(raw, 'openalexworkID') > 0 THEN '10.5555/S' ELSE '10.5555/R' END,
                                            CAST(record_id // 4 AS STRING))
                           WHEN wrapper = 'PUBMED' AND strpos(raw, '"doi"') > 0
                                THEN concat('10.5555/P', CAST(record_id // 4 AS STRING)) END AS doi
    FROM request
    """,
)
def upd_backfill_doi(spark, sf_dir):
    return payloads.backfill_doi(fx.request(spark, sf_dir)).select("record_id", "doi")


@job(
    "upd_preserve_abstract",
    """
    WITH <<index>>, <<update>>, j AS (
      SELECT u.*, i.abstract AS old_abstract, i.abstract_source AS old_source, i.abstract_date AS old_date
      FROM upd u LEFT JOIN idx i ON i.id = u.id)
    SELECT id, title, COALESCE(abstract, old_abstract) AS abstract,
           CASE WHEN abstract IS NULL AND old_abstract IS NOT NULL
                THEN CASE WHEN old_source = 'OpenAlex' THEN 'OpenAlex_old' ELSE old_source END
                WHEN abstract IS NOT NULL THEN abstract_source END AS abstract_source,
           strftime(CASE WHEN COALESCE(abstract, old_abstract) IS NOT DISTINCT FROM old_abstract THEN old_date
                         ELSE <NOW> END, '%Y-%m-%d %H:%M:%S') AS abstract_date
    FROM j
    UNION ALL
    SELECT id, title, abstract, abstract_source, strftime(abstract_date, '%Y-%m-%d %H:%M:%S')
    FROM idx WHERE id NOT IN (SELECT id FROM upd)
    """,
)
def upd_preserve_abstract(spark, sf_dir):
    following = upsert.apply_update(fx.index(spark, sf_dir), fx.update(spark, sf_dir), now())
    return _date_text(following, "abstract_date").select("id", "title", "abstract", "abstract_source", "abstract_date")


# The same from and into stored files, of which only those with an updated document are rewritten.
@job("upd_preserve_stored", ORACLES["upd_preserve_abstract"])
def upd_preserve_stored(spark, sf_dir):
    table = RangeTable(spark, scratch_path(spark, "stored"), "id", rows=500)
    table.create(fx.index(spark, sf_dir))
    jobs.update_stored(table, fx.update(spark, sf_dir), now())
    return _date_text(table.read(), "abstract_date").select("id", "title", "abstract", "abstract_source", "abstract_date")


# Records merged away, deleted from stored files.
@job(
    "del_stored",
    """
    WITH <<index>>, <<merged_ids>>
    SELECT id, doi, title, abstract FROM idx WHERE id NOT IN (SELECT id FROM merged_ids)
    """,
)
def del_stored(spark, sf_dir):
    table = RangeTable(spark, scratch_path(spark, "stored"), "id", rows=500)
    table.create(fx.index(spark, sf_dir))
    table.delete(fx.merged_ids(spark, sf_dir))
    return table.read().select("id", "doi", "title", "abstract")


@job(
    "snk_hit_export",
    """
    WITH <<index>>
    SELECT id AS openalex_id, COALESCE(doi, '') AS doi, CASE WHEN length(abstract) > 0 THEN 1 ELSE 0 END AS has_abstract,
           CASE WHEN abstract_source = 'SCOPUS' THEN 1 ELSE 0 END AS added_abstract
    FROM idx WHERE strpos(lower(title_abstract), 'the') > 0
    """,
)
def snk_hit_export(spark, sf_dir):
    hits = fx.index(spark, sf_dir).where(F.lower("title_abstract").contains("the"))
    return writers.hit_list(hits.withColumn("external_abstract", F.col("abstract_source") == "SCOPUS"))


@job(
    "join_retain_old",
    """
    WITH <<index>>, <<old_works>>
    SELECT i.id, CASE WHEN w THEN i.old ELSE i.abstract END AS abstract,
           CASE WHEN w THEN concat(COALESCE(i.title, ''), ' ', i.old) ELSE i.title_abstract END AS title_abstract,
           CASE WHEN w THEN 'OpenAlex_old' ELSE i.abstract_source END AS abstract_source,
           strftime(CASE WHEN w THEN <NOW> ELSE i.abstract_date END, '%Y-%m-%d %H:%M:%S') AS abstract_date
    FROM (SELECT idx.*, o.abstract AS old, idx.abstract IS NULL AND o.abstract IS NOT NULL AS w
          FROM idx LEFT JOIN old_works o ON o.openalex_id = idx.id) i
    """,
)
def join_retain_old(spark, sf_dir):
    following, _, _ = upsert.retain_old(fx.old_works(spark, sf_dir), fx.index(spark, sf_dir), now())
    return _date_text(following, "abstract_date").select(
        "id", "abstract", "title_abstract", "abstract_source", "abstract_date"
    )


@job(
    "agg_reconciliation",
    """
    WITH <<index>>, <<old_works>>
    SELECT count(*) AS n_works, count(o.abstract) AS n_with_abstract,
           count(*) FILTER (WHERE o.abstract IS NOT NULL AND i.id IS NOT NULL) AS n_matched,
           count(*) FILTER (WHERE o.abstract IS NOT NULL AND i.id IS NOT NULL AND i.abstract IS NULL) AS n_updated
    FROM old_works o LEFT JOIN idx i ON i.id = o.openalex_id
    """,
)
def agg_reconciliation(spark, sf_dir):
    return upsert.reconcile(fx.old_works(spark, sf_dir), fx.index(spark, sf_dir))
