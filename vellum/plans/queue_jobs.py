"""The gap-filling queue."""

from __future__ import annotations

from pyspark.sql import functions as F

from vellum import jobs
from vellum.operators import queueing
from vellum.plans import fixtures as fx
from vellum.plans.matches import MATCH
from vellum.plans.registry import ORACLES, job
from vellum.plans.tables import now
from vellum.session import scratch_path
from vellum.sources import writers
from vellum.sources.snapshot import read_id_csv

# What the sources answer: matched by DOI only, some answers too short to be an abstract.
RESPONSES = {
    "record_id": "1000000000 + doc_id * 4 + k",
    "wrapper": "wrapper",
    "doi": "concat('10.5555/D', CAST(doc_id AS STRING))",
    "openalex_id": "CAST(NULL AS STRING)",
    "pubmed_id": "CASE WHEN wrapper = 'PUBMED' THEN CAST(doc_id AS STRING) END",
    "scopus_id": "CASE WHEN wrapper = 'SCOPUS' THEN concat('2-s2.0-', CAST(doc_id AS STRING)) END",
    "wos_id": "CASE WHEN wrapper = 'WOS' THEN concat('WOS:', CAST(doc_id AS STRING)) END",
    "title": "split_part(text, chr(10), 1)",
    "abstract": "CASE WHEN source = 'src1' AND wrapper = 'DIMENSIONS' THEN 'too short' WHEN lang = 'fr' THEN NULL "
    "ELSE concat('answer ', text) END",
    "raw": "concat('{\"n\":', CAST(n_chars AS STRING), '}')",
    "time_created": "<HOURS>(<TS>'2024-06-01 00:00:00', k)",
}
_WRAPPER_ROWS = ", ".join(f"({i}, '{w}')" for i, w in enumerate(fx.WRAPPERS))
_RESPONSES_CTE = (
    "responses AS (SELECT " + ", ".join(f"{e} AS {n}" for n, e in RESPONSES.items())
    + f" FROM documents CROSS JOIN (VALUES {_WRAPPER_ROWS}) AS w(k, wrapper))"
)

# The queue with its source lists as lists of (source, priority).
_LISTS = (
    "SELECT * REPLACE (list_transform(from_json(sources, '[[\"JSON\"]]'), "
    "lambda p: {'source': p[1]->>'$', 'priority': CAST(p[2] AS INT)}) AS sources) FROM queue"
)
_DEFAULT = "[{'source': 'DIMENSIONS', 'priority': 2}, {'source': 'SCOPUS', 'priority': 2}]"
_AS_TEXT = (
    "concat('[', array_to_string(list_transform(sources, lambda s: concat('[\"', s.source, '\",', s.priority, ']')), "
    "','), ']')"
)
_ELIGIBLE = """(priority = 1 OR on_conflict = 1 OR (on_conflict = 3 AND num_has_abstract = 0)
        OR (on_conflict = 4 AND num_has_source_raw = 0) OR (on_conflict = 2 AND num_has_source_request = 0))"""


def responses(spark, sf_dir):
    wrappers = F.posexplode(F.array(*map(F.lit, fx.WRAPPERS))).alias("k", "wrapper")
    rows = fx.table(spark, sf_dir, "documents").select("*", wrappers)
    return rows.selectExpr(*[f"{fx.spark_sql(e)} AS {n}" for n, e in RESPONSES.items()])


def _text(df):
    return df.withColumn("sources", queueing.format_sources(F.col("sources")))


@job(
    "que_default_sources",
    f"""
    WITH <<queue>>, q AS ({_LISTS}), d AS (SELECT queue_id, COALESCE(sources, {_DEFAULT}) AS sources FROM q)
    SELECT queue_id, {_AS_TEXT} AS sources FROM d
    """,
)
def que_default_sources(spark, sf_dir):
    return _text(queueing.default_sources(fx.queue(spark, sf_dir))).select("queue_id", "sources")


@job(
    "que_enqueue",
    """
    WITH <<index>>, <<queue>>, <<request>>
    SELECT id AS openalex_id, doi, CAST(NULL AS STRING) AS pubmed_id,
           '[["DIMENSIONS",2],["SCOPUS",2],["PUBMED",2],["WOS",2]]' AS sources, 2 AS on_conflict
    FROM idx
    WHERE abstract IS NULL AND doi IS NOT NULL
      AND id NOT IN (SELECT openalex_id FROM request WHERE abstract IS NOT NULL AND openalex_id IS NOT NULL)
      AND id NOT IN (SELECT openalex_id FROM queue WHERE openalex_id IS NOT NULL)
    """,
)
def que_enqueue(spark, sf_dir):
    candidates = fx.index(spark, sf_dir).where(F.col("abstract").isNull()).select(
        F.col("id").alias("openalex_id"), "doi", F.lit(None).cast("string").alias("pubmed_id")
    )
    entries = queueing.enqueue(
        candidates,
        fx.request(spark, sf_dir),
        fx.queue(spark, sf_dir),
        now(),
        sources=queueing.GAP_SOURCES,
        need_doi=True,
    )
    return _text(entries).drop("time_created")


@job(
    "srt_pending_topn",
    """
    WITH <<queue>>
    SELECT queue_id, strftime(time_created, '%Y-%m-%d %H:%M:%S') AS time_created FROM queue
    WHERE sources IS NOT NULL AND strpos(sources, '[["SCOPUS"') = 1
      AND time_created BETWEEN <TS>'2024-03-02 00:00:00' AND <TS>'2024-03-18 00:00:00'
    ORDER BY time_created, queue_id LIMIT 25
    """,
)
def srt_pending_topn(spark, sf_dir):
    after, before = (F.expr(fx.spark_sql(f"<TS>'2024-03-{d} 00:00:00'")) for d in ("02", "18"))
    rows = queueing.pending(fx.queue(spark, sf_dir), "SCOPUS", 25, True, after, before)
    return rows.select("queue_id", F.date_format("time_created", "yyyy-MM-dd HH:mm:ss").alias("time_created"))


_COUNTED = f"""SELECT q.queue_id, any_value(q.on_conflict) AS on_conflict, any_value(q.sources[1].source) AS source,
             any_value(q.sources[1].priority) AS priority,
             count(*) FILTER (WHERE r.abstract IS NOT NULL) AS num_has_abstract,
             count(*) FILTER (WHERE r.raw IS NOT NULL AND r.wrapper = q.sources[1].source) AS num_has_source_raw,
             count(*) FILTER (WHERE r.record_id IS NOT NULL AND r.wrapper = q.sources[1].source)
               AS num_has_source_request
      FROM {{queue}} q LEFT JOIN {{request}} r ON {MATCH} GROUP BY q.queue_id"""


@job(
    "que_eligible",
    f"""
    WITH <<queue>>, <<request>>, q AS ({_LISTS}),
    d AS (SELECT * REPLACE (COALESCE(sources, {_DEFAULT}) AS sources) FROM q),
    c AS ({_COUNTED.format(queue="d", request="request")})
    SELECT queue_id, source, CAST(priority AS INT) AS priority, num_has_abstract, num_has_source_raw,
           num_has_source_request, {_ELIGIBLE} AS eligible FROM c
    """,
)
def que_eligible(spark, sf_dir):
    entries = queueing.default_sources(fx.queue(spark, sf_dir))
    counted = queueing.with_counts(entries, fx.request(spark, sf_dir))
    return counted.select(
        "queue_id", "source", "priority", "num_has_abstract", "num_has_source_raw", "num_has_source_request",
        queueing.is_eligible().alias("eligible"),
    )


def _list_sql(column: str, before: str, after: str) -> str:
    return (
        f"list_transform(list_sort(list_distinct(list({column}) FILTER (WHERE {column} IS NOT NULL))), "
        f"lambda x: concat('{before}', x, '{after}'))"
    )


def _in_sql(name: str, column: str, separator: str, opening: str, closing: str, quote: str) -> str:
    return (
        f"CASE WHEN count({column}) > 0 THEN concat('{name}{opening}', "
        f"array_to_string({_list_sql(column, quote, quote)}, '{separator}'), '{closing}') END"
    )


_CLAUSES = {
    "SCOPUS": "array_to_string(list_concat({}, {}), ' OR ')".format(
        _list_sql("scopus_id", "EID(", ")"), _list_sql("doi", 'DOI("', '")')
    ),
    "PUBMED": "array_to_string(list_concat({}, {}), ' OR ')".format(
        _list_sql("pubmed_id", '"', '"[PMID]'), _list_sql("doi", '"', '"[DOI]')
    ),
    "WOS": "concat_ws(' OR ', {}, {}, {})".format(
        _in_sql("DO", "doi", " OR ", "=(", ")", '"'),
        _in_sql("PMID", "pubmed_id", " OR ", "=(", ")", ""),
        _in_sql("UT", "wos_id", " OR ", "=(", ")", ""),
    ),
    "DIMENSIONS": "concat_ws(' or ', {}, {})".format(
        _in_sql("doi", "doi", ",", " in [", "]", '"'), _in_sql("pmid", "pubmed_id", ",", " in [", "]", '"')
    ),
}
_HELD = {"SCOPUS": "scopus_id, doi", "PUBMED": "pubmed_id, doi", "WOS": "doi, pubmed_id, wos_id",
         "DIMENSIONS": "doi, pubmed_id"}


@job(
    "que_batches",
    f"WITH <<queue>>, q AS ({_LISTS}), d AS (SELECT * REPLACE (COALESCE(sources, {_DEFAULT}) AS sources) FROM q) "
    + " UNION ALL ".join(
        f"""SELECT '{source}' AS source, batch, count(*) AS n_entries, {clause} AS clause
        FROM (SELECT *, (row_number() OVER (ORDER BY time_created, queue_id) - 1) // 25 AS batch FROM d
              WHERE sources[1].source = '{source}' AND COALESCE({_HELD[source]}) IS NOT NULL) GROUP BY batch"""
        for source, clause in _CLAUSES.items()
    ),
)
def que_batches(spark, sf_dir):
    entries = queueing.default_sources(fx.queue(spark, sf_dir))
    merged = None
    for source in _CLAUSES:
        waiting = entries.where(F.get("sources", F.lit(0))["source"] == source)
        batches = queueing.lookup_batches(waiting, source, 25)
        merged = batches if merged is None else merged.unionByName(batches)
    return merged


def _complete(kinds, answers: str, donors: str, prefix: str, carried: str = "", same: str = "") -> tuple[str, str]:
    """Completion of identifiers step by step, as table expressions.

    ``carried`` is one more column that goes through the steps, ``same`` one more condition on a donor.
    """
    more = f", r.{carried}" if carried else ""
    steps, previous = [], answers
    for n, kind in enumerate(kinds):
        filled = ", ".join(
            f"r.{c}" if c == kind else
            f"COALESCE(r.{c}, arg_min(q.{c}, (q.time_created, q.queue_id)) FILTER (WHERE q.{c} IS NOT NULL)) AS {c}"
            for c in kinds
        )
        steps.append(
            f"{prefix}{n} AS (SELECT r.record_id{more}, {filled} FROM {previous} r LEFT JOIN {donors} q "
            f"ON q.{kind} = r.{kind}{same} GROUP BY r.record_id{more}, {', '.join('r.' + c for c in kinds)})"
        )
        previous = f"{prefix}{n}"
    return ", ".join(steps), previous


_KINDS = ("doi", "openalex_id", "pubmed_id", "scopus_id", "wos_id", "queue_id")
_LAND, _LANDED = _complete(_KINDS, "answers", "queue", "c")


@job(
    "que_land",
    f"""
    WITH <<queue>>, {_RESPONSES_CTE},
    answers AS (SELECT *, CAST(NULL AS BIGINT) AS queue_id FROM responses), {_LAND}
    SELECT a.record_id, c.doi, c.openalex_id, c.pubmed_id, c.scopus_id, c.wos_id, c.queue_id,
           CASE WHEN length(a.abstract) >= 1000 THEN a.abstract END AS abstract
    FROM answers a JOIN {_LANDED} c USING (record_id)
    """,
)
def que_land(spark, sf_dir):
    landed = queueing.land(responses(spark, sf_dir), fx.queue(spark, sf_dir), min_abstract_length=1000)
    return landed.select(
        "record_id", "doi", "openalex_id", "pubmed_id", "scopus_id", "wos_id", "queue_id", "abstract"
    )


@job(
    "que_drop_sources",
    f"""
    WITH <<queue>>, <<request>>, q AS ({_LISTS}), found AS (
      SELECT DISTINCT openalex_id FROM request WHERE wrapper = 'PUBMED' AND abstract IS NOT NULL),
    n AS (SELECT queue_id, CASE WHEN openalex_id IN (SELECT openalex_id FROM found WHERE openalex_id IS NOT NULL)
                 THEN list_filter(sources, lambda s: s.priority = 1)
                 ELSE list_filter(sources, lambda s: s.source <> 'SCOPUS') END AS sources
          FROM q WHERE sources IS NOT NULL)
    SELECT queue_id, {_AS_TEXT} AS sources FROM n
    """,
)
def que_drop_sources(spark, sf_dir):
    asked = fx.queue(spark, sf_dir).where(F.col("sources").isNotNull())
    with_text = fx.request(spark, sf_dir).where("wrapper = 'PUBMED' AND abstract IS NOT NULL")
    found = asked.join(with_text, "openalex_id", "left_semi")
    return _text(queueing.advance(asked, found, "SCOPUS"))


@job(
    "que_drop_finished",
    """
    WITH <<queue>>, kept AS (
      SELECT queue_id, time_created FROM queue
      WHERE (sources IS NULL OR sources <> '[["WOS",1]]') AND time_created <= <TS>'2024-03-15 00:00:00')
    SELECT queue_id FROM kept WHERE queue_id NOT IN (SELECT doc_id FROM labels)
    """,
)
def que_drop_finished(spark, sf_dir):
    queue = fx.queue(spark, sf_dir)
    emptied = queue.withColumn("sources", queueing.without_source(F.col("sources"), "WOS"))
    moment = F.expr(fx.spark_sql("<TS>'2024-03-15 00:00:00'"))
    kept = queueing.drop_created_after(queueing.drop_finished(emptied), moment)
    labelled = fx.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("queue_id"))
    return queueing.drop_queued(kept, labelled).select("queue_id")


@job(
    "que_record_misses",
    f"""
    WITH <<queue>>, <<request>>
    SELECT w.wrapper AS wrapper, q.openalex_id, q.doi, q.pubmed_id, CAST(NULL AS STRING) AS abstract
    FROM queue q CROSS JOIN (VALUES {_WRAPPER_ROWS}) AS w(k, wrapper)
    WHERE NOT EXISTS (SELECT 1 FROM request r WHERE r.wrapper = w.wrapper AND r.abstract IS NOT NULL
                      AND (r.doi = q.doi OR r.openalex_id = q.openalex_id OR r.pubmed_id = q.pubmed_id))
    """,
)
def que_record_misses(spark, sf_dir):
    queue, request = fx.queue(spark, sf_dir), fx.request(spark, sf_dir).where("abstract IS NOT NULL")
    kinds, merged = ("doi", "openalex_id", "pubmed_id"), None
    for source in fx.WRAPPERS:
        answers = request.where(F.col("wrapper") == source)
        missed = queueing.record_misses(queue, answers, "queue_id", source, now(), kinds)
        merged = missed if merged is None else merged.unionByName(missed)
    return merged.select("wrapper", "openalex_id", "doi", "pubmed_id", "abstract")


_TURN, _TURNED = _complete(_KINDS, "answers", "asked", "c", "wrapper", " AND q.sources[1].source = r.wrapper")


@job(
    "que_turn",
    f"""
    WITH <<queue>>, <<request>>, {_RESPONSES_CTE}, q AS ({_LISTS}),
    waiting AS (SELECT * REPLACE (COALESCE(sources, {_DEFAULT}) AS sources) FROM q),
    counted AS ({_COUNTED.format(queue="waiting", request="request")}),
    asked AS (SELECT t.* FROM waiting t JOIN counted c USING (queue_id)
              WHERE {_ELIGIBLE.replace("on_conflict", "c.on_conflict")}),
    answers AS (SELECT r.*, CAST(NULL AS BIGINT) AS queue_id FROM responses r
                WHERE EXISTS (SELECT 1 FROM asked q WHERE q.sources[1].source = r.wrapper AND ({MATCH}))),
    {_TURN},
    landed AS (SELECT a.record_id, a.wrapper, c.doi, c.openalex_id, c.queue_id,
                      CASE WHEN length(a.abstract) >= 25 THEN a.abstract END AS abstract
               FROM answers a JOIN {_TURNED} c USING (record_id)),
    found AS (SELECT DISTINCT queue_id FROM landed WHERE abstract IS NOT NULL AND queue_id IS NOT NULL),
    following AS (
      SELECT * FROM (
        SELECT queue_id, CASE WHEN queue_id IN (SELECT queue_id FROM found)
                              THEN list_filter(sources, lambda s: s.priority = 1)
                              ELSE list_filter(sources, lambda s: s.source <> sources[1].source) END AS sources
        FROM waiting)
      WHERE len(sources) > 0)
    SELECT 'queue' AS part, queue_id, {_AS_TEXT} AS content FROM following
    UNION ALL
    SELECT 'landed', queue_id, concat_ws('|', record_id, doi, openalex_id, wrapper, abstract) FROM landed
    """,
)
def que_turn(spark, sf_dir):
    queue, landed = queueing.work_turn(fx.queue(spark, sf_dir), fx.request(spark, sf_dir), responses(spark, sf_dir))
    left = queue.select(
        F.lit("queue").alias("part"), "queue_id", queueing.format_sources(F.col("sources")).alias("content")
    )
    rows = landed.select(
        F.lit("landed").alias("part"), "queue_id",
        F.concat_ws("|", "record_id", "doi", "openalex_id", "wrapper", "abstract").alias("content"),
    )
    return left.unionByName(rows)


# The first forty of the works a job would queue, of which there may be no more than the bound.
@job(
    "srt_capped",
    ORACLES["que_enqueue"] + " ORDER BY openalex_id LIMIT 40",
)
def srt_capped(spark, sf_dir):
    entries = queueing.at_most(que_enqueue(spark, sf_dir), queueing.MOST_QUEUED)
    return queueing.capped(entries, 40, ["openalex_id"])


def _round_sql(n: int) -> str:
    """One round over the queue q<n> and the cache r<n>, giving q<n+1>, landed<n> and r<n+1>."""
    steps, completed = _complete(_KINDS, f"answers{n}", f"asked{n}", f"c{n}_", "wrapper", " AND q.sources[1].source = r.wrapper")
    return f"""
    counted{n} AS MATERIALIZED ({_COUNTED.format(queue=f"q{n}", request=f"r{n}")}),
    asked{n} AS MATERIALIZED (SELECT t.* FROM q{n} t JOIN counted{n} c USING (queue_id)
              WHERE {_ELIGIBLE.replace("on_conflict", "c.on_conflict")}),
    answers{n} AS MATERIALIZED (SELECT r.*, CAST(NULL AS BIGINT) AS queue_id FROM responses r
                WHERE EXISTS (SELECT 1 FROM asked{n} q WHERE q.sources[1].source = r.wrapper AND ({MATCH}))),
    {steps},
    landed{n} AS MATERIALIZED (
      SELECT a.record_id, a.wrapper, c.openalex_id, c.doi, c.pubmed_id, c.scopus_id, c.wos_id, c.queue_id, a.title, a.raw,
             CASE WHEN length(a.abstract) >= 25 THEN a.abstract END AS abstract
      FROM answers{n} a JOIN {completed} c USING (record_id)),
    q{n + 1} AS MATERIALIZED (
      SELECT * FROM (
        SELECT * REPLACE (CASE WHEN queue_id IN (SELECT queue_id FROM landed{n}
                                                 WHERE abstract IS NOT NULL AND queue_id IS NOT NULL)
                               THEN list_filter(sources, lambda s: s.priority = 1)
                               ELSE list_filter(sources, lambda s: s.source <> sources[1].source) END AS sources)
        FROM q{n})
      WHERE len(sources) > 0),
    r{n + 1} AS MATERIALIZED (
      SELECT * FROM r{n} UNION ALL
      SELECT record_id, wrapper, openalex_id, doi, pubmed_id, scopus_id, wos_id, title, abstract, raw FROM landed{n})"""


_ROUNDS = 5  # one more than the longest list and the round in which nothing moves


@job(
    "que_rounds",
    f"""
    WITH <<queue>>, <<request>>, {_RESPONSES_CTE}, q AS ({_LISTS}),
    q0 AS (SELECT * REPLACE (COALESCE(sources, {_DEFAULT}) AS sources) FROM q),
    r0 AS (SELECT record_id, wrapper, openalex_id, doi, pubmed_id, scopus_id, wos_id, title, abstract, raw FROM request),
    {", ".join(_round_sql(n) for n in range(_ROUNDS))}
    SELECT 'queue' AS part, queue_id, {_AS_TEXT} AS content FROM q{_ROUNDS}
    UNION ALL
    SELECT DISTINCT 'landed', queue_id, concat_ws('|', record_id, doi, openalex_id, wrapper, abstract)
    FROM ({" UNION ALL ".join(f"SELECT * FROM landed{n}" for n in range(_ROUNDS))})
    """,
)
def que_rounds(spark, sf_dir):
    root = scratch_path(spark, "rounds")
    answers = responses(spark, sf_dir)
    done = jobs.work_rounds(
        spark, root, fx.queue(spark, sf_dir), fx.request(spark, sf_dir), lambda asked: answers, rounds=10
    )
    left = writers.read_version(spark, f"{root}/queue", done).select(
        F.lit("queue").alias("part"), "queue_id", queueing.format_sources(F.col("sources")).alias("content")
    )
    rows = spark.read.parquet(f"{root}/landed").select(
        F.lit("landed").alias("part"), "queue_id",
        F.concat_ws("|", "record_id", "doi", "openalex_id", "wrapper", "abstract").alias("content"),
    )
    return left.unionByName(rows.distinct())


@job(
    "que_enqueue_range",
    """
    WITH <<index>>, <<queue>>, <<request>>
    SELECT id AS openalex_id, replace(doi, 'https://doi.org/', '') AS doi,
           CAST(NULL AS STRING) AS sources, 2 AS on_conflict
    FROM idx
    WHERE abstract IS NULL AND (created_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'
                                OR updated_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-25')
      AND id NOT IN (SELECT openalex_id FROM request WHERE abstract IS NOT NULL AND openalex_id IS NOT NULL)
      AND id NOT IN (SELECT openalex_id FROM queue WHERE openalex_id IS NOT NULL)
    """,
)
def que_enqueue_range(spark, sf_dir):
    entries = jobs.queue_missing(
        fx.index(spark, sf_dir), fx.request(spark, sf_dir), fx.queue(spark, sf_dir), "2024-01-05", "2024-01-25", now()
    )
    return _text(entries).select("openalex_id", "doi", "sources", "on_conflict")


@job(
    "que_enqueue_file",
    """
    WITH <<queue>>, <<request>>, listed AS (
      SELECT concat('W', CAST(doc_id AS STRING)) AS openalex_id, concat('10.5555/L', CAST(doc_id AS STRING)) AS doi,
             CASE WHEN toxic = 1 THEN CAST(doc_id AS STRING) END AS pubmed_id FROM labels)
    SELECT openalex_id, doi, pubmed_id, '[["DIMENSIONS",2],["SCOPUS",2],["PUBMED",2],["WOS",2]]' AS sources FROM listed
    WHERE openalex_id NOT IN (SELECT openalex_id FROM request WHERE abstract IS NOT NULL AND openalex_id IS NOT NULL)
      AND openalex_id NOT IN (SELECT openalex_id FROM queue WHERE openalex_id IS NOT NULL)
    """,
)
def que_enqueue_file(spark, sf_dir):
    root = scratch_path(spark, "listed")
    number = F.col("doc_id").cast("string")
    fx.table(spark, sf_dir, "labels").select(
        F.concat(F.lit("W"), number).alias("openalex_id"), F.concat(F.lit("10.5555/L"), number).alias("doi"),
        F.when(F.col("toxic") == 1, number).alias("pmid"),
    ).write.csv(root, header=True)
    listed = read_id_csv(spark, root)
    entries = jobs.queue_file(listed, fx.request(spark, sf_dir), fx.queue(spark, sf_dir), now(), queueing.GAP_SOURCES)
    return _text(entries).select("openalex_id", "doi", "pubmed_id", "sources")
