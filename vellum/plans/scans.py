"""Scans of snapshots, id lists and other corpora."""

from __future__ import annotations

from pyspark.sql import functions as F

from vellum.functions.ids import strip_id
from vellum.operators.documents import with_abstract
from vellum.operators.flatten import flatten_works
from vellum.operators.upsert import first_seen
from vellum.plans import fixtures as fx
from vellum.plans.nested import nested_works
from vellum.plans.registry import job
from vellum.session import scratch_path
from vellum.sources import corpora, snapshot, writers

_PUBLISHED: dict[tuple[str, str], str] = {}


def published_snapshot(spark, sf_dir) -> str:
    """The works as a snapshot on shared storage: gzip JSON lines below one folder per update day."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _PUBLISHED:
        root = scratch_path(spark, "snapshot")
        publish(fx.works(spark, sf_dir), root)
        _PUBLISHED[key] = root
    return _PUBLISHED[key]


def publish(works, root: str) -> None:
    """Add works to a snapshot."""
    rows = works.drop("doc_id", "abstract_source", "source_id")
    rows.write.mode("append").partitionBy("updated_date").option("compression", "gzip").json(f"{root}/works")


@job(
    "src_scan_snapshot",
    """
    WITH <<works>>
    SELECT concat('W', doc_id) AS id, title, abstract, CAST(updated_date AS STRING) AS updated_date FROM works
    """,
)
def src_scan_snapshot(spark, sf_dir):
    schema = "id STRING, title STRING, abstract STRING"
    records = snapshot.read_snapshot(spark, published_snapshot(spark, sf_dir), schema=schema)
    good, _ = snapshot.split_corrupt(records)
    return good.select(
        strip_id(F.col("id")).alias("id"), "title", "abstract",
        F.col("updated_date").cast("string").alias("updated_date"),
    )


@job(
    "src_scan_nested",
    r"""
    SELECT concat('W', CAST(doc_id AS STRING)) AS id, split_part(text, chr(10), 1) AS title,
           NULLIF(array_to_string(regexp_extract_all(text, '[^ \t\r\n]+'), ' '), '') AS abstract,
           CAST(len(string_split(text, chr(10))) AS INT) AS n_authors, lang AS language,
           CASE WHEN source NOT IN ('src1', 'src2') THEN source END AS volume,
           CAST(1990 + n_chars % 36 AS INT) AS publication_year
    FROM documents
    """,
)
def src_scan_nested(spark, sf_dir):
    root = scratch_path(spark, "nested")
    works = nested_works(spark, sf_dir, wide=True)
    works.write.partitionBy("updated_date").option("compression", "gzip").json(f"{root}/works")
    good, _ = snapshot.split_corrupt(snapshot.read_snapshot(spark, root))
    return with_abstract(good).select(
        strip_id(F.col("id")).alias("id"), "title", "abstract", F.size("authorships").alias("n_authors"), "language",
        "biblio.volume", "publication_year",
    )


@job(
    "src_partition_since",
    """
    WITH <<works>>
    SELECT 'from' AS bound, id FROM works WHERE updated_date >= DATE '2024-03-01'
    UNION ALL
    SELECT 'after', id FROM works WHERE updated_date > DATE '2024-03-01'
    """,
)
def src_partition_since(spark, sf_dir):
    root = published_snapshot(spark, sf_dir)
    parts = [
        snapshot.read_snapshot(spark, root, schema="id STRING", since="2024-03-01", inclusive=inclusive).select(
            F.lit(bound).alias("bound"), "id"
        )
        for bound, inclusive in (("from", True), ("after", False))
    ]
    return parts[0].unionByName(parts[1])


@job(
    "src_skip_partitions",
    """
    WITH <<works>>, days AS (SELECT updated_date, dense_rank() OVER (ORDER BY updated_date) AS place FROM works
                             GROUP BY updated_date)
    SELECT id FROM works JOIN days USING (updated_date) WHERE place > 10
    """,
)
def src_skip_partitions(spark, sf_dir):
    root = published_snapshot(spark, sf_dir)
    # as many files as there are below the first ten days
    files = snapshot.read_snapshot(spark, root, schema="id STRING").inputFiles()
    days = sorted({f.split("updated_date=")[1][:10] for f in files})[:10]
    skip = sum(f.split("updated_date=")[1][:10] in days for f in files)
    return snapshot.read_snapshot(spark, root, schema="id STRING", skip=skip).select("id")


@job(
    "src_resume_ledger",
    "WITH <<works>> SELECT id, title FROM works WHERE updated_date >= DATE '2024-02-20'",
)
def src_resume_ledger(spark, sf_dir):
    root = published_snapshot(spark, sf_dir)
    day = F.regexp_extract("path", r"updated_date=(\d{4}-\d{2}-\d{2})", 1)
    done = snapshot.snapshot_files(spark, f"{root}/works").where(day < "2024-02-20")
    records, _ = snapshot.read_pending(spark, root, done, schema="id STRING, title STRING")
    return records.select("id", "title")


@job(
    "src_tolerant_decode",
    """
    SELECT doc_id, CASE WHEN source <> 'src4' THEN split_part(text, chr(10), 1) END AS title,
           source = 'src4' AS broken
    FROM documents WHERE source <> 'src5'
    """,
)
def src_tolerant_decode(spark, sf_dir):
    title = F.split_part("text", F.lit("\n"), F.lit(1)).alias("title")
    line = (
        F.when(F.col("source") == "src4", F.concat(F.lit('{"title": "'), F.col("lang"), F.lit('" "x":')))
        .when(F.col("source") == "src5", F.lit("   "))
        .otherwise(F.to_json(F.struct(title, F.col("text").alias("not_declared"))))
    )
    lines = fx.table(spark, sf_dir, "documents").select("doc_id", line.alias("line"))
    decoded = snapshot.decode_lines(lines, "line", "title STRING")
    # a broken line may still show the fields before the break
    broken = F.col(snapshot.CORRUPT).isNotNull()
    return decoded.select("doc_id", F.when(~broken, F.col("title")).alias("title"), broken.alias("broken"))


@job(
    "src_dedup_first",
    """
    SELECT md5(text) AS id, min(doc_id) AS doc_id, arg_min(source, doc_id) AS source FROM documents
    WHERE lang <> 'es' GROUP BY text
    """,
)
def src_dedup_first(spark, sf_dir):
    key = F.when(F.col("lang") != "es", F.md5("text")).alias("id")
    records = fx.table(spark, sf_dir, "documents").select(key, "doc_id", "source")
    return first_seen(records, "id", ["doc_id"])


@job(
    "src_id_list",
    """
    SELECT DISTINCT concat('W', length(text)) AS openalex_id FROM documents
    UNION SELECT DISTINCT source FROM documents
    """,
)
def src_id_list(spark, sf_dir):
    path = scratch_path(spark, "ids")
    lines = F.array(
        F.concat(F.lit("  W"), F.length("text").cast("string"), F.lit(" ")), F.lit(""), F.lit("  "), F.col("source")
    )
    fx.table(spark, sf_dir, "documents").select(F.explode(lines).alias("value")).write.text(path)
    return snapshot.read_id_list(spark, path)


@job(
    "src_source_dump",
    """
    SELECT 'DIMENSIONS' AS wrapper, concat('pub.', doc_id) AS dimensions_id, concat('10.5555/D', doc_id) AS doi,
           CASE WHEN lang <> 'de' THEN CAST(doc_id AS STRING) END AS pubmed_id, source AS title, text AS abstract,
           concat('{"id":"pub.', doc_id, '","doi":"10.5555/D', doc_id, '","pmid":', CASE WHEN lang = 'de' THEN '"NaN"'
                  ELSE concat(doc_id, '.0') END, ',"title":"', source, '","abstract":', to_json(text), '}') AS raw
    FROM documents
    """,
)
def src_source_dump(spark, sf_dir):
    dump = fx.table(spark, sf_dir, "documents").selectExpr(
        "concat('pub.', doc_id) AS id",
        "concat('10.5555/D', doc_id) AS doi",
        "CASE WHEN lang = 'de' THEN double('NaN') ELSE CAST(doc_id AS DOUBLE) END AS pmid",
        "source AS title",
        "text AS abstract",
    )
    return corpora.source_dump(dump)


@job(
    "src_json_to_typed",
    """
    SELECT 's2.papers' AS target, CAST(doc_id AS STRING) AS key_id, concat('10.5555/D', doc_id) AS doi,
           split_part(text, chr(10), 1) AS title, CAST(1990 + n_chars % 36 AS INT) AS publication_year,
           lang = 'en' AS flag, concat('[{"name":"', source, '"}]') AS authors,
           '2024-01-02 03:04:05' AS updated_date
    FROM documents
    UNION ALL
    SELECT 's2.s2orc', CAST(doc_id AS STRING), concat('10.5555/D', doc_id), text, NULL, NULL,
           concat('{"license":"', lang, '"}'), '2024-01-02 03:04:05' FROM documents
    UNION ALL
    SELECT 's2.tldrs', CAST(doc_id AS STRING), NULL, split_part(text, chr(10), 1), NULL, NULL, 'model one', NULL FROM documents
    UNION ALL
    SELECT 's2.authors', CAST(c_custkey AS STRING), NULL, c_name, CAST(c_nationkey AS INT), NULL,
           concat('["', c_mktsegment, '"]'), '2024-01-02 03:04:05' FROM customer
    UNION ALL
    SELECT 's2.abstracts', CAST(doc_id AS STRING), concat('10.5555/D', doc_id), text, NULL, NULL, NULL,
           '2024-01-02 03:04:05' FROM documents
    UNION ALL
    SELECT 'core.works', CAST(doc_id AS STRING), concat('10.5555/D', doc_id), split_part(text, chr(10), 1),
           CASE WHEN lang <> 'fr' THEN CAST(1990 + n_chars % 36 AS INT) END, lang = 'en',
           concat('["', source, '"]'), NULL
    FROM documents
    """,
)
def src_json_to_typed(spark, sf_dir):
    documents = fx.table(spark, sf_dir, "documents").select(
        "*",
        F.concat(F.lit("10.5555/D"), F.col("doc_id").cast("string")).alias("doi"),
        F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"),
        F.expr("CAST(1990 + n_chars % 36 AS INT)").alias("year"),
    )
    moment = F.lit("2024-01-02T03:04:05").alias("updated")
    paper = F.struct(
        F.col("doc_id").alias("corpusid"),
        F.struct(F.col("doi").alias("DOI")).alias("externalids"),
        "title",
        F.col("year").cast("string").alias("year"),
        (F.col("lang") == "en").alias("isopenaccess"),
        F.array(F.struct(F.col("source").alias("name"))).alias("authors"),
        moment,
    )
    abstract = F.struct(
        F.col("doc_id").alias("corpusid"),
        F.struct(F.struct(F.col("doi").alias("DOI")).alias("externalids")).alias("openaccessinfo"),
        F.col("text").alias("abstract"),
        moment,
    )
    core = F.struct(
        F.col("doc_id").alias("coreId"),
        "doi",
        "title",
        F.when(F.col("lang") == "fr", F.lit("unknown")).otherwise(F.col("year").cast("string")).alias("year"),
        F.when(F.col("lang") == "en", F.lit("x.pdf")).alias("fullTextIdentifier"),
        F.array("source").alias("authors"),
    )

    def table(name, record):
        return corpora.json_to_table(documents.select(F.to_json(record).alias("value")), name)

    stamp = F.date_format("updated_date", "yyyy-MM-dd HH:mm:ss").alias("updated_date")
    papers = table("s2.papers", paper).select(
        F.lit("s2.papers").alias("target"), F.col("corpus_id").alias("key_id"), "doi", "title", "publication_year",
        F.col("is_open_access").alias("flag"), "authors", stamp,
    )
    abstracts = table("s2.abstracts", abstract).select(
        F.lit("s2.abstracts").alias("target"), F.col("corpus_id").alias("key_id"), "doi",
        F.col("abstract").alias("title"), stamp,
    )
    works = table("core.works", core).select(
        F.lit("core.works").alias("target"), F.col("core_id").alias("key_id"), "doi", "title", "publication_year",
        F.col("full_text_available").alias("flag"), "authors",
    )
    full = F.struct(
        F.col("doc_id").alias("corpusid"), F.struct(F.col("doi").alias("doi")).alias("externalids"),
        F.struct(
            F.struct(F.struct(F.col("lang").alias("license")).alias("oainfo")).alias("source"), F.col("text").alias("text")
        ).alias("content"),
        moment,
    )
    texts = table("s2.s2orc", full).select(
        F.lit("s2.s2orc").alias("target"), F.col("corpus_id").alias("key_id"), "doi", F.col("full_text").alias("title"),
        F.col("open_access_metadata").alias("authors"), stamp,
    )
    summary = F.struct(F.col("doc_id").alias("corpusid"), F.lit("model one").alias("model"), F.col("title").alias("text"))
    summaries = table("s2.tldrs", summary).select(
        F.lit("s2.tldrs").alias("target"), F.col("corpus_id").alias("key_id"), F.col("summary").alias("title"),
        F.col("model").alias("authors"),
    )
    person = F.struct(
        F.col("c_custkey").alias("authorid"), F.col("c_name").alias("name"), F.array("c_mktsegment").alias("aliases"),
        F.col("c_nationkey").alias("papercount"), moment,
    )
    people = fx.table(spark, sf_dir, "customer").select(F.to_json(person).alias("value"))
    authors = corpora.json_to_table(people, "s2.authors").select(
        F.lit("s2.authors").alias("target"), F.col("author_id").alias("key_id"), F.col("name").alias("title"),
        F.col("paper_count").alias("publication_year"), F.col("aliases").alias("authors"), stamp,
    )
    merged = papers
    for part in (abstracts, works, texts, summaries, authors):
        merged = merged.unionByName(part, allowMissingColumns=True)
    return merged


@job(
    "snk_csv_tables",
    """
    WITH <<lines>>
    SELECT 'works_references' AS part, concat('W', doc_id) AS first_id, concat('W', length(line)) AS second_id,
           CAST(NULL AS STRING) AS listed FROM lines
    UNION ALL
    SELECT 'works_authorships', concat('W', doc_id), CASE WHEN line <> '' THEN concat('A', length(line)) END,
           concat('{', upper(lang), '}') FROM lines
    """,
)
def snk_csv_tables(spark, sf_dir):
    root = scratch_path(spark, "csv")
    tables = flatten_works(nested_works(spark, sf_dir))
    authorships = tables["works_authorships"].select("work_id", "author_id", "countries")
    written = {"works_references": tables["works_references"], "works_authorships": authorships}
    writers.write_tables(written, root, "csv")
    edges = spark.read.option("header", "true").csv(f"{root}/works_references")
    people = spark.read.option("header", "true").csv(f"{root}/works_authorships")
    return edges.select(
        F.lit("works_references").alias("part"), F.col("src_work_id").alias("first_id"),
        F.col("trgt_work_id").alias("second_id"), F.lit(None).cast("string").alias("listed"),
    ).unionByName(
        people.select(
            F.lit("works_authorships").alias("part"), F.col("work_id").alias("first_id"),
            F.col("author_id").alias("second_id"), F.col("countries").alias("listed"),
        )
    )


@job(
    "src_split_fulltext",
    """
    SELECT 'record' AS part, doc_id AS core_id, source AS content FROM documents
    UNION ALL
    SELECT 'full_text', doc_id, text FROM documents WHERE lang <> 'es'
    """,
)
def src_split_fulltext(spark, sf_dir):
    archive = fx.table(spark, sf_dir, "documents").selectExpr(
        "doc_id AS coreId", "source AS provider_id", "CASE WHEN lang <> 'es' THEN text END AS fullText"
    )
    records, texts = corpora.split_full_text(archive)
    return records.select(
        F.lit("record").alias("part"), F.col("coreId").alias("core_id"), F.col("provider_id").alias("content")
    ).unionByName(
        texts.select(
            F.lit("full_text").alias("part"), F.col("coreId").alias("core_id"), F.col("fullText").alias("content")
        )
    )
