"""Coverage reports, picks, samples and sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from vellum.operators import reports
from vellum.plans import fixtures as fx
from vellum.plans.registry import job
from vellum.plans.tables import BEST

SINCE = "<TS>'2024-01-10 00:00:00'"


def since():
    return F.expr(fx.spark_sql(SINCE))


def _filtered_counts(groups: dict[str, str]) -> str:
    return ",\n".join(
        f"count(*) FILTER (WHERE wrapper = '{s}' AND {condition}) AS n_{s.lower()}{suffix}"
        for suffix, condition in groups.items()
        for s in ("DIMENSIONS", "SCOPUS", "PUBMED", "WOS")
    )


_COVERAGE = _filtered_counts(
    {
        "": "true",
        "_abs": "abstract IS NOT NULL",
        "_no_oa": "abstract IS NOT NULL AND openalex_id IS NULL",
        "_no_doi": "abstract IS NOT NULL AND doi IS NULL",
    }
)


@job(
    "agg_source_coverage",
    f"""
    WITH <<request>>
    SELECT count(*) AS n_total, count(*) FILTER (WHERE openalex_id IS NULL) AS n_missing_oa_id, {_COVERAGE}
    FROM request WHERE time_created >= {SINCE}
    """,
)
def agg_source_coverage(spark, sf_dir):
    return reports.source_coverage(fx.request(spark, sf_dir), since())


@job(
    "agg_unmatched_coverage",
    f"""
    WITH <<request>>
    SELECT count(*) AS n_total, count(*) FILTER (WHERE openalex_id IS NULL) AS n_missing_oa_id,
           {_filtered_counts({"": "true", "_no_oa": "openalex_id IS NULL"})}
    FROM request WHERE abstract IS NOT NULL AND time_created >= {SINCE}
    """,
)
def agg_unmatched_coverage(spark, sf_dir):
    return reports.unmatched_coverage(fx.request(spark, sf_dir), since())


@job(
    "agg_queue_depth",
    """
    WITH <<queue>>
    SELECT CASE WHEN sources IS NOT NULL THEN CAST(json_array_length(sources) AS INT) END AS num_sources, count(*) AS n
    FROM queue WHERE time_created > <TS>'2024-03-05 00:00:00' GROUP BY 1
    """,
)
def agg_queue_depth(spark, sf_dir):
    moment = F.expr(fx.spark_sql("<TS>'2024-03-05 00:00:00'"))
    return reports.queue_depth(fx.queue(spark, sf_dir).where(F.col("time_created") > moment))


@job(
    "agg_written_state",
    """
    WITH <<request>> SELECT wrapper, solarized, count(*) AS n FROM request GROUP BY wrapper, solarized
    """,
)
def agg_written_state(spark, sf_dir):
    return reports.written_state(fx.request(spark, sf_dir))


@job(
    "agg_lang_freq",
    """
    WITH <<works>> SELECT language, count(*) AS num_works FROM works GROUP BY language
    """,
)
def agg_lang_freq(spark, sf_dir):
    return reports.frequencies(fx.works(spark, sf_dir), "language")


_STATS_SQL = """count(*) AS n_total, count(title) AS n_with_title, count(abstract) AS n_with_abstract,
           count(*) FILTER (WHERE raw IS NOT NULL AND lower(wrapper) = 'scopus') AS n_with_scopus,
           count(*) FILTER (WHERE raw IS NOT NULL AND lower(wrapper) = 'dimensions') AS n_with_dimensions"""


@job(
    "agg_daily_stats",
    f"""
    WITH <<request>>
    SELECT strftime(date_trunc('day', time_created), '%Y-%m-%d') AS day, {_STATS_SQL}
    FROM request GROUP BY 1
    """,
)
def agg_daily_stats(spark, sf_dir):
    return reports.daily_stats(fx.request(spark, sf_dir)).withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@job("agg_total_stats", f"WITH <<request>> SELECT {_STATS_SQL} FROM request")
def agg_total_stats(spark, sf_dir):
    return reports.total_stats(fx.request(spark, sf_dir))


_COLLAPSED = ("doi", "pubmed_id", "scopus_id", "wos_id", "dimensions_id", "title", "abstract")


@job(
    "agg_collapse_records",
    "WITH <<request>> SELECT openalex_id, "
    + ", ".join(
        f"arg_min({c}, (time_created, record_id)) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in _COLLAPSED
    )
    + " FROM request WHERE openalex_id IS NOT NULL GROUP BY openalex_id",
)
def agg_collapse_records(spark, sf_dir):
    return reports.collapse_records(fx.request(spark, sf_dir), _COLLAPSED)


@job(
    "agg_fill_rate",
    """
    WITH <<works>>
    SELECT count(*) FILTER (WHERE abstract IS NOT NULL) AS filled, count(*) FILTER (WHERE abstract IS NULL) AS empty
    FROM works
    """,
)
def agg_fill_rate(spark, sf_dir):
    return reports.fill_rate(fx.works(spark, sf_dir), "abstract")


_PROFILE = ("abstract_source", "publication_year", "doi", "created_date", "language")


@job(
    "agg_completeness",
    "WITH <<works>>, c AS (SELECT count(*) AS n, count(*) FILTER (WHERE is_xpac) AS is_xpac, "
    + ", ".join(f"count({c}) AS {c}" for c in _PROFILE)
    + " FROM works), u AS ("
    + " UNION ALL ".join(f"SELECT '{c}' AS field, {c} AS n_present, n FROM c" for c in ("is_xpac", *_PROFILE))
    + ") SELECT field, n_present, n - n_present AS n_absent, round(n_present / n, 6) AS share FROM u",
)
def agg_completeness(spark, sf_dir):
    return reports.completeness(fx.works(spark, sf_dir), ("is_xpac",), _PROFILE)


@job(
    "agg_year_ratio",
    """
    WITH <<works>>, years AS (SELECT unnest(range(1990, 2026)) AS year),
    s AS (SELECT publication_year AS year, count(*) AS n FROM works WHERE abstract IS NOT NULL GROUP BY 1),
    t AS (SELECT publication_year AS year, count(*) AS n FROM works GROUP BY 1)
    SELECT CAST(y.year AS INT) AS year, COALESCE(s.n, 0) AS n_sample, COALESCE(t.n, 0) AS n_total,
           round(COALESCE(s.n, 0) / t.n * 100, 6) AS ratio
    FROM years y LEFT JOIN s USING (year) LEFT JOIN t USING (year)
    """,
)
def agg_year_ratio(spark, sf_dir):
    works = fx.works(spark, sf_dir)
    return reports.year_ratio(spark, works.where(F.col("abstract").isNotNull()), works, 1990, 2025)


@job(
    "agg_date_range",
    """
    WITH <<works>>
    SELECT CAST(min(created_date) AS STRING) AS first_created, CAST(max(created_date) AS STRING) AS last_created,
           CAST(min(updated_date) AS STRING) AS first_updated, CAST(max(updated_date) AS STRING) AS last_updated
    FROM works
    """,
)
def agg_date_range(spark, sf_dir):
    ranges = reports.date_range(fx.works(spark, sf_dir))
    return ranges.select(*[F.col(c).cast("string").alias(c) for c in ranges.columns])


@job(
    "agg_repair_worklist",
    """
    WITH <<request>>
    SELECT 'no_work' AS task, record_id, doi, strftime(time_created, '%Y-%m-%d %H:%M:%S') AS time_created,
           CAST(NULL AS BIGINT) AS n
    FROM request WHERE doi IS NOT NULL AND openalex_id IS NULL AND wrapper = 'PUBMED'
    UNION ALL
    SELECT 'no_doi', record_id, doi, strftime(time_created, '%Y-%m-%d %H:%M:%S'), NULL
    FROM request WHERE wrapper = 'DIMENSIONS' AND doi IS NULL
    UNION ALL
    SELECT 'to_repair', NULL, NULL, NULL, count(*) FROM request WHERE doi IS NOT NULL AND openalex_id IS NULL
    """,
)
def agg_repair_worklist(spark, sf_dir):
    request = fx.request(spark, sf_dir)
    tasks = (
        reports.repair_worklist(request, "PUBMED").withColumn("task", F.lit("no_work"))
        .unionByName(reports.without_doi(request, "DIMENSIONS").withColumn("task", F.lit("no_doi")))
    )
    listed = tasks.select(
        "task", "record_id", "doi", F.date_format("time_created", "yyyy-MM-dd HH:mm:ss").alias("time_created"),
        F.lit(None).cast("bigint").alias("n"),
    )
    total = reports.repairable(request).agg(F.count(F.lit(1)).alias("n")).withColumn("task", F.lit("to_repair"))
    return listed.unionByName(total, allowMissingColumns=True)


@job(
    "win_best_abstract",
    f"""
    WITH <<request>>, {BEST}
    SELECT openalex_id, abstract_source, abstract, title, source_rank, record_id FROM best
    """,
)
def win_best_abstract(spark, sf_dir):
    return reports.best_abstract(fx.request(spark, sf_dir)).drop("time_created")


@job(
    "win_complete_record",
    f"""
    WITH <<request>>
    SELECT openalex_id, record_id, title, abstract FROM request
    WHERE openalex_id IS NOT NULL AND abstract IS NOT NULL AND title IS NOT NULL AND time_created >= {SINCE}
    QUALIFY row_number() OVER (PARTITION BY openalex_id ORDER BY time_created, record_id) = 1
    """,
)
def win_complete_record(spark, sf_dir):
    rows = reports.complete_records(fx.request(spark, sf_dir), since())
    return rows.select("openalex_id", "record_id", "title", "abstract")


@job(
    "win_partition_count",
    """
    WITH <<request>> SELECT record_id, wrapper, count(*) OVER (PARTITION BY wrapper) AS n FROM request
    """,
)
def win_partition_count(spark, sf_dir):
    return reports.with_group_count(fx.request(spark, sf_dir).select("record_id", "wrapper"), "wrapper")


@job(
    "srt_seeded_sample",
    """
    WITH <<index>>
    SELECT DISTINCT id, md5(concat('4243:', id)) AS h FROM idx WHERE abstract IS NOT NULL AND NOT COALESCE(is_xpac, false)
    ORDER BY h, id LIMIT 100
    """,
)
def srt_seeded_sample(spark, sf_dir):
    usable = fx.index(spark, sf_dir).where(F.col("abstract").isNotNull() & ~F.coalesce("is_xpac", F.lit(False)))
    sample = reports.seeded_sample(usable, "id", 100, 4243)
    return sample.select("id", F.md5(F.concat(F.lit("4243:"), "id")).alias("h"))


_SETS = ("works", "updated", "cached")


@job(
    "set_pairwise_overlap",
    """
    WITH <<index>>, <<update>>, <<request>>, s AS (
      SELECT 'works' AS name, id FROM idx WHERE abstract IS NOT NULL
      UNION SELECT 'updated', id FROM upd
      UNION SELECT 'cached', openalex_id FROM request WHERE wrapper = 'PUBMED' AND openalex_id IS NOT NULL)
    SELECT a.name AS "left", b.name AS "right", a.n AS n_left, b.n AS n_right, a.n + b.n - i.n AS n_union,
           i.n AS n_intersect, a.n - i.n AS n_left_only, b.n - i.n AS n_right_only
    FROM (SELECT name, count(*) AS n FROM s GROUP BY name) a
    JOIN (SELECT name, count(*) AS n FROM s GROUP BY name) b ON a.name <> b.name
    JOIN (SELECT x.name AS l, y.name AS r, count(*) AS n FROM s x JOIN s y USING (id) GROUP BY 1, 2) i
      ON i.l = a.name AND i.r = b.name
    """,
)
def set_pairwise_overlap(spark, sf_dir):
    cached = fx.request(spark, sf_dir).where("wrapper = 'PUBMED' AND openalex_id IS NOT NULL")
    return reports.pairwise_overlap(
        {
            "works": fx.index(spark, sf_dir).where(F.col("abstract").isNotNull()).select("id"),
            "updated": fx.update(spark, sf_dir).select("id"),
            "cached": cached.select("openalex_id"),
        }
    )
