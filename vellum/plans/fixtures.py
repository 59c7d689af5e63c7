"""Catalogue tables derived from the driver tables.

The same expressions build the Spark frames and the oracle's common table expressions. They keep every row and
the whole text of their base table; missing values come from what a row is (its source, language or wrapper).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.operators.joins import SENT_KEYS, with_keys
from vellum.operators.queueing import parse_sources
from vellum.session import cut_lineage

WRAPPERS = ("WOS", "SCOPUS", "DIMENSIONS", "PUBMED")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_DOC = "CAST(doc_id AS STRING)"
_TITLE = "split_part(text, chr(10), 1)"
_START = "<TS>'2024-01-01 00:00:00'"

WORKS = {
    "doc_id": "doc_id",
    "id": f"concat('https://openalex.org/W', {_DOC})",
    "doi": f"CASE WHEN source IN ('src3', 'src11', 'src17') THEN NULL ELSE concat('https://doi.org/10.5555/D', {_DOC}) END",
    "title": f"CASE WHEN source = 'src14' THEN NULL ELSE {_TITLE} END",
    "abstract": "CASE WHEN source IN ('src2', 'src5', 'src8', 'src13', 'src18') THEN NULL ELSE text END",
    "abstract_source": "CASE WHEN source IN ('src2', 'src5', 'src8', 'src13', 'src18') THEN NULL "
    "WHEN source IN ('src1', 'src7') THEN 'SCOPUS' ELSE 'OpenAlex' END",
    "language": "CASE WHEN source = 'src19' THEN NULL ELSE lang END",
    "source_id": "source",
    "publication_year": "CAST(1990 + n_chars % 36 AS INT)",
    "type": "CASE WHEN source IN ('src0', 'src9') THEN 'book' WHEN source = 'src15' THEN NULL "
    "ELSE 'journal-article' END",
    "is_xpac": "CASE WHEN source = 'src6' THEN true WHEN source = 'src10' THEN CAST(NULL AS BOOLEAN) ELSE false END",
    "created_date": "DATE '2024-01-01' + CAST(n_chars % 60 AS INT)",
    "updated_date": "DATE '2024-02-01' + CAST(n_chars % 45 AS INT)",
}

INDEX = {
    "id": f"concat('W', {_DOC})",
    **{c: WORKS[c] for c in ("doi", "title", "abstract")},
    "title_abstract": "CASE WHEN source = 'src14' AND source IN ('src2', 'src5', 'src8', 'src13', 'src18') THEN NULL ELSE "
    f"concat(COALESCE({WORKS['title']}, ''), ' ', COALESCE({WORKS['abstract']}, '')) END",
    "abstract_source": WORKS["abstract_source"],
    "abstract_date": "CASE WHEN source = 'src1' THEN <TS>'2023-06-01 00:00:00' ELSE CAST(NULL AS <TSTYPE>) END",
    **{c: WORKS[c] for c in ("is_xpac", "created_date", "updated_date", "publication_year")},
}

REQUEST = {
    "record_id": "doc_id * 4 + k",
    "wrapper": "wrapper",
    "openalex_id": "CASE WHEN wrapper = 'PUBMED' AND lang = 'fr' THEN NULL "
    "WHEN wrapper = 'WOS' AND source IN ('src2', 'src4') THEN NULL "
    f"ELSE concat('W', {_DOC}) END",
    # many works share one placeholder value
    "doi": "CASE WHEN wrapper = 'DIMENSIONS' AND lang = 'es' THEN NULL "
    "WHEN wrapper = 'PUBMED' AND source IN ('src5', 'src9') THEN NULL "
    "WHEN wrapper = 'WOS' AND source IN ('src11', 'src12') THEN NULL "
    "WHEN wrapper = 'SCOPUS' AND lang = 'de' THEN '10.5555/pending' "
    f"ELSE concat('10.5555/D', {_DOC}) END",
    "pubmed_id": f"CASE WHEN lang = 'en' AND wrapper IN ('PUBMED', 'DIMENSIONS') THEN {_DOC} END",
    "scopus_id": f"CASE WHEN wrapper = 'SCOPUS' THEN concat('2-s2.0-', {_DOC}) END",
    "wos_id": f"CASE WHEN wrapper = 'WOS' THEN concat('WOS:', {_DOC}) END",
    "dimensions_id": f"CASE WHEN wrapper = 'DIMENSIONS' THEN concat('pub.', {_DOC}) END",
    "item_id": f"CASE WHEN wrapper = 'PUBMED' AND source = 'src16' THEN concat('I', {_DOC}) END",
    "title": f"CASE WHEN wrapper = 'DIMENSIONS' AND source = 'src12' THEN NULL ELSE {_TITLE} END",
    "abstract": "CASE WHEN source = 'src18' THEN NULL WHEN wrapper = 'WOS' AND source IN ('src0', 'src1', 'src2', 'src3') THEN NULL "
    "WHEN wrapper = 'SCOPUS' AND source IN ('src2', 'src3', 'src4') THEN NULL "
    "WHEN wrapper = 'DIMENSIONS' AND lang IN ('de', 'es') THEN NULL "
    "WHEN wrapper = 'PUBMED' AND lang <> 'en' THEN NULL "
    "ELSE concat(wrapper, ': ', text) END",
    "solarized": "CASE WHEN source = 'src1' THEN true WHEN source = 'src7' THEN false ELSE CAST(NULL AS BOOLEAN) END",
    "raw": "CASE WHEN source = 'src7' AND wrapper = 'PUBMED' THEN NULL "
    """WHEN wrapper = 'WOS' THEN concat('{"dynamic_data":{"cluster_related":{"identifiers":{"identifier":["""
    """{"type":"issn","value":"', source, '"},{"type":"', CASE WHEN lang = 'en' THEN 'xref_doi' """
    """WHEN lang = 'fr' THEN 'openalexworkID' ELSE 'doi' END, '","value":"10.5555/R', """
    f"""{_DOC}, '"}},{{"type":"doi","value":"10.5555/S', {_DOC}, '"}}]}}}}}}}}') """
    """WHEN wrapper = 'PUBMED' THEN concat('{"PubmedData":[{"ArticleIdList":[{"ArticleId":["""
    """{"@IdType":"pubmed","_text":"', """
    f"""{_DOC}, '"}},{{"@IdType":"', CASE WHEN source = 'src9' THEN 'pii' ELSE 'doi' END, '","_text":"10.5555/P', """
    f"""{_DOC}, '"}}]}}]}}]}}') """
    f"""WHEN wrapper = 'SCOPUS' THEN concat('{{"eid":"2-s2.0-', {_DOC}, '"}}') """
    f"""ELSE concat('{{"id":"pub.', {_DOC}, '"}}') END""",
    "time_created": f"<HOURS>({_START}, (n_chars * 13 + k * 5) % 1000)",
}

QUEUE = {
    "queue_id": "doc_id",
    "openalex_id": f"CASE WHEN source = 'src18' THEN NULL ELSE concat('W', {_DOC}) END",
    "doi": "CASE WHEN lang = 'de' THEN '10.5555/pending' WHEN source = 'src3' THEN NULL "
    f"ELSE concat('10.5555/D', {_DOC}) END",
    "pubmed_id": f"CASE WHEN source IN ('src6', 'src9', 'src18') THEN {_DOC} END",
    "scopus_id": f"CASE WHEN source IN ('src3', 'src7') THEN concat('2-s2.0-', {_DOC}) END",
    "wos_id": f"CASE WHEN source IN ('src10') THEN concat('WOS:', {_DOC}) END",
    "sources": "CASE WHEN source IN ('src0', 'src4', 'src8', 'src12', 'src16') THEN NULL "
    """WHEN source IN ('src1', 'src5', 'src9', 'src13') THEN '[["DIMENSIONS",2],["SCOPUS",1]]' """
    """WHEN source IN ('src2', 'src6', 'src10', 'src14', 'src18') THEN '[["SCOPUS",2],["PUBMED",2],["WOS",1]]' """
    """ELSE '[["WOS",1]]' END""",
    "on_conflict": "CASE WHEN source IN ('src1', 'src6') THEN 1 WHEN lang = 'en' THEN 2 WHEN lang = 'fr' THEN 3 "
    "ELSE 4 END",
    "time_created": f"<HOURS>(<TS>'2024-03-01 00:00:00', n_chars % 500)",
}

OLD_WORKS = {
    "openalex_id": f"concat('W', {_DOC})",
    "abstract": "CASE WHEN source = 'src5' THEN NULL ELSE concat('old ', text) END",
}

# Works that were looked at again: those with a label. Some lost their abstract, some have a new one.
UPDATE = {
    "id": f"concat('W', {_DOC})",
    "doi": WORKS["doi"],
    "title": f"concat('New ', {_TITLE})",
    "abstract": "CASE WHEN quality = 0 THEN NULL WHEN toxic = 1 THEN concat(text, ' (revised)') ELSE text END",
    "abstract_source": "CASE WHEN quality = 0 THEN NULL ELSE 'OpenAlex' END",
    "is_xpac": WORKS["is_xpac"],
    "created_date": WORKS["created_date"],
    "updated_date": "DATE '2024-04-01' + CAST(n_chars % 3 AS INT)",
    "publication_year": WORKS["publication_year"],
}

NOW = "<TS>'2024-06-01 12:00:00'"


def spark_sql(expression: str) -> str:
    """An expression in Spark's dialect."""
    out = expression.replace("<TSTYPE>", "TIMESTAMP_NTZ").replace("<TS>", "TIMESTAMP_NTZ ")
    while "<HOURS>(" in out:
        out = _rewrite_hours(out, "{0} + make_dt_interval(0, CAST({1} AS INT))")
    return out


def duck_sql(expression: str) -> str:
    """The same in the oracle's dialect."""
    out = expression.replace("<TSTYPE>", "TIMESTAMP").replace("<TS>", "TIMESTAMP ")
    while "<HOURS>(" in out:
        out = _rewrite_hours(out, "{0} + to_hours(CAST({1} AS BIGINT))")
    return out


def _rewrite_hours(text: str, form: str) -> str:
    start = text.index("<HOURS>(")
    depth, cut, i = 0, None, start + len("<HOURS>(")
    begin = i
    while True:
        if text[i] == "(":
            depth += 1
        elif text[i] == ")":
            if depth == 0:
                break
            depth -= 1
        elif text[i] == "," and depth == 0 and cut is None:
            cut = i
        i += 1
    return text[:start] + form.format(text[begin:cut].strip(), text[cut + 1 : i].strip()) + text[i + 1 :]


def _select(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{spark_sql(e)} AS `{name}`" for name, e in columns.items()])


def _columns(columns: dict[str, str]) -> str:
    return ",\n  ".join(f"{duck_sql(e)} AS {name}" for name, e in columns.items())


def works(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(table(spark, sf_dir, "documents"), WORKS)


def index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(table(spark, sf_dir, "documents"), INDEX)


def request(spark: SparkSession, sf_dir: str) -> DataFrame:
    wrappers = F.posexplode(F.array(*map(F.lit, WRAPPERS))).alias("k", "wrapper")
    return _select(table(spark, sf_dir, "documents").select("*", wrappers), REQUEST)


def request_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``request`` joined with ``source`` on the document's id.

    A row is a row of its document, which has the source already; only documents whose id comes again are joined, so that no
    text moves for the others.
    """
    documents = table(spark, sf_dir, "documents")
    again = documents.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 AND doc_id IS NOT NULL").select("doc_id")
    again = cut_lineage(again, "repeated")
    n = again.count()
    wrappers = F.posexplode(F.array(*map(F.lit, WRAPPERS))).alias("k", "wrapper")
    rows = _select(documents.where("doc_id IS NOT NULL").select("*", wrappers), REQUEST | {"source": "source", "_doc": "doc_id"})
    if not n:
        return rows.drop("_doc")
    named = with_keys(documents, again, "doc_id", n).select(F.col("doc_id").alias("_doc"), "source")
    few = F.broadcast(again) if n <= SENT_KEYS else again
    once = rows.join(few, rows["_doc"] == few["doc_id"], "left_anti")
    more = with_keys(rows, again.withColumnRenamed("doc_id", "_doc"), "_doc", n).drop("source").join(named, "_doc")
    return once.unionByName(more).drop("_doc")


def queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(table(spark, sf_dir, "documents"), QUEUE).withColumn("sources", parse_sources(F.col("sources")))


def old_works(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(table(spark, sf_dir, "documents"), OLD_WORKS)


def update(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    # short labels go to the texts
    return _select(documents.join(F.broadcast(labels) if labels.count() <= SENT_KEYS else labels, "doc_id"), UPDATE)


def merged_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact copies are merged into the copy with the smallest id."""
    keyed = table(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("h"))
    kept = keyed.groupBy("h").agg(F.min("doc_id").alias("keep"))
    return keyed.join(kept, "h").where(F.col("doc_id") > F.col("keep")).select(
        F.lit("2024-03-01").alias("merge_date"),
        F.concat(F.lit("W"), F.col("doc_id").cast("string")).alias("id"),
        F.concat(F.lit("W"), F.col("keep").cast("string")).alias("merge_into_id"),
    )


_WRAPPER_ROWS = ", ".join(f"({i}, '{w}')" for i, w in enumerate(WRAPPERS))

CTES = {
    "works": f"works AS (SELECT\n  {_columns(WORKS)}\nFROM documents)",
    "index": f"idx AS (SELECT\n  {_columns(INDEX)}\nFROM documents)",
    "request": f"request AS (SELECT\n  {_columns(REQUEST)}\nFROM documents "
    f"CROSS JOIN (VALUES {_WRAPPER_ROWS}) AS w(k, wrapper))",
    "queue": f"queue AS (SELECT\n  {_columns(QUEUE)}\nFROM documents)",
    "old_works": f"old_works AS (SELECT\n  {_columns(OLD_WORKS)}\nFROM documents)",
    "update": f"upd AS (SELECT\n  {_columns(UPDATE)}\nFROM documents JOIN labels USING (doc_id))",
    "merged_ids": "merged_ids AS (SELECT concat('W', CAST(doc_id AS STRING)) AS id, "
    "concat('W', CAST(keep AS STRING)) AS merge_into_id FROM documents JOIN "
    "(SELECT text, min(doc_id) AS keep FROM documents GROUP BY text) USING (text) WHERE doc_id > keep)",
    # one row per line of a text, numbered from 0
    "lines": "lines AS (SELECT doc_id, source, lang, len(ls) AS n_lines, unnest(ls) AS line, "
    "CAST(generate_subscripts(ls, 1) - 1 AS INT) AS i FROM (SELECT *, string_split(text, chr(10)) AS ls FROM documents))",
    # one row per token, positions from 0
    "tokens": r"tokens AS (SELECT doc_id, unnest(ts) AS term, generate_subscripts(ts, 1) - 1 AS pos FROM "
    r"(SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]{1,127}') AS ts FROM documents))",
}


def oracle(sql: str) -> str:
    """SQL with ``<<name>>`` replaced by the table expression of that name."""
    for name, cte in CTES.items():
        sql = sql.replace(f"<<{name}>>", cte)
    return duck_sql(sql.replace("<NOW>", NOW)).strip()
