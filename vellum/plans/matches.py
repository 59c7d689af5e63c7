"""Joins on one or any of several identifiers."""

from __future__ import annotations

from pyspark.sql import functions as F

from vellum.operators import matching, queueing, reports
from vellum.operators.joins import left_lookup
from vellum.plans import fixtures as fx
from vellum.plans.registry import job

MATCH = """(q.doi IS NOT NULL AND q.doi = r.doi) OR (q.openalex_id IS NOT NULL AND q.openalex_id = r.openalex_id)
      OR (q.pubmed_id IS NOT NULL AND q.pubmed_id = r.pubmed_id)
      OR (q.scopus_id IS NOT NULL AND q.scopus_id = r.scopus_id) OR (q.wos_id IS NOT NULL AND q.wos_id = r.wos_id)"""


@job(
    "join_any_id_counts",
    f"""
    WITH <<queue>>, <<request>>
    SELECT q.queue_id, q.on_conflict,
           count(*) FILTER (WHERE r.record_id IS NOT NULL) AS num_has_request,
           count(*) FILTER (WHERE r.abstract IS NOT NULL) AS num_has_abstract,
           count(*) FILTER (WHERE r.title IS NOT NULL) AS num_has_title,
           count(*) FILTER (WHERE r.raw IS NOT NULL) AS num_has_raw,
           count(*) FILTER (WHERE r.record_id IS NOT NULL AND r.wrapper = 'SCOPUS') AS num_has_source_request,
           count(*) FILTER (WHERE r.abstract IS NOT NULL AND r.wrapper = 'SCOPUS') AS num_has_source_abstract,
           count(*) FILTER (WHERE r.title IS NOT NULL AND r.wrapper = 'SCOPUS') AS num_has_source_title,
           count(*) FILTER (WHERE r.raw IS NOT NULL AND r.wrapper = 'SCOPUS') AS num_has_source_raw
    FROM queue q LEFT JOIN request r ON {MATCH}
    GROUP BY q.queue_id, q.on_conflict
    """,
)
def join_any_id_counts(spark, sf_dir):
    counted = queueing.with_counts(fx.queue(spark, sf_dir), fx.request(spark, sf_dir), "SCOPUS")
    return counted.select("queue_id", "on_conflict", *[c for c in counted.columns if c.startswith("num_has")])


@job(
    "join_any_id_lookup",
    f"""
    WITH <<queue>>, <<request>>
    SELECT r.record_id, r.wrapper, r.title FROM request r
    WHERE EXISTS (SELECT 1 FROM queue q WHERE {MATCH})
    """,
)
def join_any_id_lookup(spark, sf_dir):
    found = matching.lookup_records(fx.queue(spark, sf_dir), fx.request(spark, sf_dir))
    return found.select("record_id", "wrapper", "title")


def _complete_sql(kinds: list[str]) -> str:
    """The cascade spelt out: one step per identifier kind, each over the result of the one before."""
    steps, previous = [], "answers"
    for n, kind in enumerate(kinds):
        filled = ", ".join(
            f"COALESCE(r.{c}, arg_min(q.{c}, (q.time_created, q.queue_id)) FILTER (WHERE q.{c} IS NOT NULL)) AS {c}"
            if c != kind
            else f"r.{c}"
            for c in kinds
        )
        groups = ", ".join(f"r.{c}" for c in kinds)
        steps.append(
            f"step{n} AS (SELECT r.record_id, {filled} FROM {previous} r LEFT JOIN queue q ON q.{kind} = r.{kind} "
            f"GROUP BY r.record_id, {groups})"
        )
        previous = f"step{n}"
    return ", ".join(steps)


_KINDS = ["doi", "openalex_id", "pubmed_id", "scopus_id", "wos_id", "queue_id"]


@job(
    "join_complete_ids",
    f"""
    WITH <<queue>>, <<request>>, answers AS (
      SELECT record_id, doi, openalex_id, pubmed_id, scopus_id, wos_id, CAST(NULL AS BIGINT) AS queue_id FROM request),
    {_complete_sql(_KINDS)}
    SELECT * FROM step5
    """,
)
def join_complete_ids(spark, sf_dir):
    answers = fx.request(spark, sf_dir).select(
        "record_id", *_KINDS[:-1], F.lit(None).cast("bigint").alias("queue_id")
    )
    return matching.complete_ids(answers, fx.queue(spark, sf_dir), _KINDS)


@job(
    "join_missing_abstract",
    """
    WITH <<index>>, <<queue>>
    SELECT id, doi FROM idx WHERE abstract IS NULL AND id IN (SELECT openalex_id FROM queue)
    """,
)
def join_missing_abstract(spark, sf_dir):
    found = queueing.lacking_abstract(fx.index(spark, sf_dir), fx.queue(spark, sf_dir))
    return found.select("id", "doi")


@job(
    "join_exclude_known",
    """
    WITH <<index>>, <<queue>>, <<request>>
    SELECT id AS openalex_id, doi FROM idx
    WHERE id NOT IN (SELECT openalex_id FROM request WHERE abstract IS NOT NULL AND openalex_id IS NOT NULL
                     UNION SELECT openalex_id FROM queue WHERE openalex_id IS NOT NULL)
    """,
)
def join_exclude_known(spark, sf_dir):
    known = queueing.known_ids(fx.request(spark, sf_dir), fx.queue(spark, sf_dir))
    candidates = fx.index(spark, sf_dir).select(F.col("id").alias("openalex_id"), "doi")
    return candidates.join(known, "openalex_id", "left_anti")


@job(
    "join_items_import",
    """
    WITH <<request>>, known AS (SELECT item_id FROM request WHERE item_id IS NOT NULL AND abstract IS NOT NULL)
    SELECT 'PROJECT' AS wrapper, concat('I', doc_id) AS item_id, concat('10.5555/D', doc_id) AS doi,
           concat('W', doc_id) AS openalex_id, split_part(text, chr(10), 1) AS title, text AS abstract,
           concat('{"meta":{"lang":"', lang, '"},"project_id":"', source, '","publication_year":',
                  1990 + n_chars % 36, '}') AS raw
    FROM documents
    WHERE length(text) > 100 AND source <> 'src18' AND concat('I', doc_id) NOT IN (SELECT item_id FROM known)
    """,
)
def join_items_import(spark, sf_dir):
    documents = fx.table(spark, sf_dir, "documents")
    item = documents.selectExpr("concat('I', doc_id) AS item_id", "text", "source AS project_id")
    academic = documents.selectExpr(
        "concat('I', doc_id) AS item_id",
        "concat('10.5555/D', doc_id) AS doi",
        "CASE WHEN source <> 'src18' THEN concat('W', doc_id) END AS openalex_id",
        "split_part(text, '\\n', 1) AS title",
        "map('lang', lang, 'places', source) AS meta",
        "CAST(1990 + n_chars % 36 AS INT) AS publication_year",
    )
    return reports.import_items(item, academic, fx.request(spark, sf_dir))


@job(
    "join_doi_repair",
    """
    WITH <<request>>, <<works>>, known AS (
      SELECT lower(replace(doi, 'https://doi.org/', '')) AS k, max(upper(replace(id, 'https://openalex.org/', ''))) AS id
      FROM works JOIN labels USING (doc_id) WHERE doi IS NOT NULL GROUP BY 1)
    SELECT r.record_id, COALESCE(r.openalex_id, k.id) AS openalex_id
    FROM request r LEFT JOIN known k ON k.k = lower(r.doi)
    """,
)
def join_doi_repair(spark, sf_dir):
    works = fx.works(spark, sf_dir)
    # the works somebody asked for, in the spelling of a hand-made list
    references = fx.table(spark, sf_dir, "labels").selectExpr("concat('w', doc_id) AS openalex_id")
    repaired = matching.repair_ids(fx.request(spark, sf_dir), works, references)
    return repaired.select("record_id", "openalex_id")


@job(
    "join_venue_report",
    """
    SELECT p.p_name AS display_name, p.p_brand AS publisher, p.p_type AS homepage_url, count(*) AS documents,
           count(CASE WHEN w.type = 'journal-article' THEN 1 END) AS journal_documents,
           count(CASE WHEN w.type <> 'journal-article' THEN 1 END) AS other_documents,
           CAST(sum(CASE WHEN w.type IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS no_type_documents
    FROM (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'journal-article' WHEN o_orderstatus = 'O' THEN 'book' END
            AS type FROM orders) w
    LEFT JOIN lineitem l ON l.l_orderkey = w.o_orderkey
    LEFT JOIN part p ON p.p_partkey = l.l_partkey
    GROUP BY 1, 2, 3
    """,
)
def join_venue_report(spark, sf_dir):
    works = fx.table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS work_id",
        "CASE WHEN o_orderstatus = 'F' THEN 'journal-article' WHEN o_orderstatus = 'O' THEN 'book' END AS type",
    )
    hosts = fx.table(spark, sf_dir, "lineitem").selectExpr("l_orderkey AS work_id", "l_partkey AS venue_id")
    venues = fx.table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS venue_id", "p_name AS display_name", "p_brand AS publisher", "p_type AS homepage_url"
    )
    return reports.venue_report(works, hosts, venues)


@job(
    "join_works_abstracts",
    """
    WITH <<works>>, <<old_works>>
    SELECT w.doc_id, w.title, o.abstract AS abstract, o.abstract IS NOT NULL AS found
    FROM works w LEFT JOIN (SELECT * FROM old_works WHERE abstract IS NOT NULL) o
      ON o.openalex_id = replace(w.id, 'https://openalex.org/', '')
    """,
)
def join_works_abstracts(spark, sf_dir):
    works = fx.works(spark, sf_dir).selectExpr("doc_id", "title", "replace(id, 'https://openalex.org/', '') AS work_id")
    abstracts = fx.old_works(spark, sf_dir).where(F.col("abstract").isNotNull())
    joined = left_lookup(works, abstracts, "work_id", "openalex_id", ["doc_id"])
    return joined.select("doc_id", "title", "abstract", F.col("abstract").isNotNull().alias("found"))


@job(
    "join_works_abstracts_inner",
    """
    WITH <<works>>, <<old_works>>
    SELECT w.doc_id, w.title, o.abstract FROM works w
    JOIN old_works o ON o.openalex_id = replace(w.id, 'https://openalex.org/', '') WHERE o.abstract IS NOT NULL
    """,
)
def join_works_abstracts_inner(spark, sf_dir):
    works = fx.works(spark, sf_dir).selectExpr("doc_id", "title", "replace(id, 'https://openalex.org/', '') AS work_id")
    abstracts = fx.old_works(spark, sf_dir).where(F.col("abstract").isNotNull())
    return works.join(abstracts, F.col("work_id") == F.col("openalex_id")).select("doc_id", "title", "abstract")


@job(
    "join_year_spine",
    """
    WITH <<works>>, years AS (SELECT unnest(range(1900, 2031)) AS year)
    SELECT CAST(y.year AS INT) AS year, count(w.doc_id) AS cnt_all, count(*) FILTER (WHERE w.language = 'en') AS cnt_en,
           count(*) FILTER (WHERE w.language <> 'en') AS cnt_other,
           count(*) FILTER (WHERE w.doc_id IS NOT NULL AND w.language IS NULL) AS cnt_null
    FROM years y LEFT JOIN works w ON w.publication_year = y.year GROUP BY y.year
    """,
)
def join_year_spine(spark, sf_dir):
    lang = F.col("language")
    counts = {
        "cnt_all": F.count(F.lit(1)),
        "cnt_en": F.count_if(lang == "en"),
        "cnt_other": F.count_if(lang != "en"),
        "cnt_null": F.count_if(lang.isNull()),
    }
    return reports.per_year(spark, fx.works(spark, sf_dir), 1900, 2030, counts)


@job(
    "join_skip_existing",
    """
    WITH <<queue>>, <<request>>
    SELECT q.queue_id FROM queue q
    WHERE NOT EXISTS (SELECT 1 FROM request r WHERE r.wrapper = 'PUBMED' AND (r.doi = q.doi OR r.pubmed_id = q.pubmed_id))
    """,
)
def join_skip_existing(spark, sf_dir):
    kept = matching.skip_existing(
        fx.queue(spark, sf_dir), fx.request(spark, sf_dir), "queue_id", "PUBMED", ("doi", "pubmed_id")
    )
    return kept.select("queue_id")


@job(
    "join_sample_missed",
    """
    WITH <<index>>, <<update>>
    SELECT CAST(publication_year AS INT) AS publication_year, count(*) AS n_sampled,
           count(*) FILTER (WHERE id NOT IN (SELECT id FROM upd)) AS n_missed
    FROM idx GROUP BY 1
    """,
)
def join_sample_missed(spark, sf_dir):
    return reports.missed_in(fx.index(spark, sf_dir), fx.update(spark, sf_dir), "id", ["publication_year"])


@job(
    "que_lookup_status",
    f"""
    WITH <<queue>>, <<request>>, m AS (
      SELECT q.queue_id, max(CASE WHEN r.abstract IS NOT NULL THEN 1 ELSE 0 END) = 1 AS answered,
             arg_min(r.record_id, (r.time_created, r.record_id)) FILTER (WHERE r.abstract IS NOT NULL) AS hit_record,
             arg_min(r.record_id, (r.time_created, r.record_id)) AS any_record
      FROM queue q JOIN request r ON {MATCH} GROUP BY q.queue_id)
    SELECT q.queue_id, COALESCE(m.answered, false) AS hit, NOT COALESCE(m.answered, false) AS missed,
           NOT COALESCE(m.answered, false) AS queued, COALESCE(m.hit_record, m.any_record) AS record_id
    FROM queue q LEFT JOIN m USING (queue_id)
    """,
)
def que_lookup_status(spark, sf_dir):
    return _status(spark, sf_dir).select("queue_id", "hit", "missed", "queued", "record_id")


def _status(spark, sf_dir):
    return matching.lookup_status(
        fx.queue(spark, sf_dir), fx.request(spark, sf_dir), "queue_id", empty_abstract_as_missing=True,
        fetch_on_missing_entry=True,
    )


@job(
    "agg_lookup_summary",
    f"""
    WITH <<queue>>, <<request>>, m AS (
      SELECT q.queue_id, max(CASE WHEN r.abstract IS NOT NULL THEN 1 ELSE 0 END) AS answered
      FROM queue q JOIN request r ON {MATCH} GROUP BY q.queue_id)
    SELECT CAST(sum(COALESCE(answered, 0)) AS BIGINT) AS n_hit, CAST(sum(1 - COALESCE(answered, 0)) AS BIGINT) AS n_queued,
           CAST(sum(1 - COALESCE(answered, 0)) AS BIGINT) AS n_missed,
           count(*) FILTER (WHERE COALESCE(answered, 0) = 0 AND queue_id NOT IN (SELECT doc_id FROM labels)) AS n_added
    FROM queue q LEFT JOIN m USING (queue_id)
    """,
)
def agg_lookup_summary(spark, sf_dir):
    # added: missed, and not in the queue before; the labelled documents stand for those that were
    before = fx.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("queue_id"), F.lit(True).alias("before"))
    status = _status(spark, sf_dir).join(before, "queue_id", "left")
    return matching.lookup_summary(status, F.col("missed") & F.col("before").isNull())


@job(
    "que_cascade",
    f"""
    WITH <<queue>>, <<request>>, ranked AS (
      SELECT q.queue_id, r.record_id, r.wrapper, r.abstract,
             row_number() OVER (PARTITION BY q.queue_id ORDER BY
               CASE r.wrapper WHEN 'DIMENSIONS' THEN 0 WHEN 'SCOPUS' THEN 1 ELSE 2 END, r.time_created, r.record_id) AS n
      FROM queue q JOIN request r ON ({MATCH})
      WHERE r.wrapper IN ('DIMENSIONS', 'SCOPUS', 'WOS') AND r.abstract IS NOT NULL)
    SELECT q.queue_id, r.wrapper AS answered_by, r.record_id, r.abstract
    FROM queue q LEFT JOIN ranked r ON r.queue_id = q.queue_id AND r.n = 1
    """,
)
def que_cascade(spark, sf_dir):
    found = matching.cascade(
        fx.queue(spark, sf_dir), fx.request(spark, sf_dir), "queue_id", ("DIMENSIONS", "SCOPUS", "WOS")
    )
    return found.select("queue_id", "answered_by", "record_id", "abstract")
