"""Nested records to tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.operators import flatten
from vellum.plans.nested import nested_entities, nested_works
from vellum.plans.registry import job

_DATES = "'2024-01-01 10:00:00' AS created_date, '2024-02-01 00:00:00' AS updated_date"


def _plain(df: DataFrame) -> DataFrame:
    """Lists, dates and floats in a form both engines print alike."""
    columns = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind.startswith("array"):
            c = F.array_join(c, "|")
        elif kind.startswith("timestamp"):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif kind == "float":
            c = c.cast("double")
        columns.append(c.alias(name))
    return df.select(*columns)


def _entity(entity: str):
    def run(spark, sf_dir, table):
        return _plain(flatten.FLATTENERS[entity](nested_entities(spark, sf_dir, entity))[table])

    return run


@job(
    "flt_authors",
    f"""
    SELECT CAST(c_custkey AS STRING) AS n, concat('A', c_custkey) AS author_id,
           CAST(floor(c_acctbal) AS INT) AS cited_by_count, c_nationkey AS works_count, c_nationkey + 1 AS h_index,
           c_nationkey + 2 AS i10_index, c_name AS display_name,
           concat(c_name, '|', c_mktsegment, ' etc') AS display_name_alternatives,
           concat('I', c_nationkey) AS last_known_institution, c_custkey AS id_mag,
           concat('0000-', c_custkey) AS id_orcid, c_mktsegment AS id_scopus, CAST(NULL AS STRING) AS id_twitter,
           CAST(NULL AS STRING) AS id_wikipedia, {_DATES}
    FROM customer
    """,
)
def flt_authors(spark, sf_dir):
    return _entity("author")(spark, sf_dir, "authors").withColumn("n", F.col("id_mag").cast("string"))


@job(
    "flt_institutions",
    f"""
    SELECT 'institutions' AS part, concat('I', s_suppkey) AS institution_id, concat_ws('|', 'education',
           concat('http://example.org/', s_suppkey), CAST(floor(s_acctbal) AS INT), s_nationkey, s_nationkey + 1,
           s_nationkey + 2, s_name, concat(s_name, '|a', s_nationkey), NULL, concat('https://ror.org/', s_suppkey),
           s_suppkey, NULL, 'Q1', concat('grid.', s_suppkey), concat('city ', s_nationkey), '1', NULL,
           concat('country ', s_nationkey), 'DE') AS rest, s_nationkey / 4.0 AS number
    FROM supplier
    UNION ALL
    SELECT 'associations', concat('I', s_suppkey),
           concat_ws('|', concat('I', CASE WHEN s_acctbal >= 0 THEN s_nationkey ELSE s_nationkey + 100 END),
                     CASE WHEN s_acctbal >= 0 THEN 'parent' ELSE 'child' END), NULL
    FROM supplier
    UNION ALL
    SELECT 'concepts', concat('I', s_suppkey), concat('C', s_nationkey), s_nationkey / 4.0 FROM supplier
    """,
)
def flt_institutions(spark, sf_dir):
    tables = flatten.flatten_institutions(nested_entities(spark, sf_dir, "institution"))
    main, links, concepts = (
        _plain(tables[t]) for t in ("institutions", "institutions_associations", "institutions_concepts")
    )
    rest = [c for c in main.columns if c not in ("institution_id", "latitude", "longitude", "created_date", "updated_date")]
    parts = [
        main.select(
            F.lit("institutions").alias("part"), "institution_id", F.concat_ws("|", *rest).alias("rest"),
            F.col("latitude").alias("number"),
        ),
        links.select(
            F.lit("associations").alias("part"), F.col("parent_institution_id").alias("institution_id"),
            F.concat_ws("|", "child_institution_id", "relationship").alias("rest"),
            F.lit(None).cast("double").alias("number"),
        ),
        concepts.select(
            F.lit("concepts").alias("part"), "institution_id", F.col("concept_id").alias("rest"),
            F.col("score").alias("number"),
        ),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@job(
    "flt_publishers",
    f"""
    SELECT concat('P', s_suppkey) AS publisher_id, CAST(floor(s_acctbal) AS INT) AS cited_by_count,
           s_nationkey AS works_count, s_nationkey + 1 AS h_index, s_nationkey + 2 AS i10_index,
           s_name AS display_name, s_name AS alternate_titles, 'DE|FR' AS country_codes, 'r' AS id_ror,
           concat('Q', s_suppkey) AS id_wikidata, s_nationkey AS hierarchy_level,
           concat('P', s_suppkey, '|P', s_nationkey) AS lineage, concat('P', s_nationkey) AS parent, {_DATES}
    FROM supplier WHERE s_acctbal >= 0
    """,
)
def flt_publishers(spark, sf_dir):
    return _entity("publisher")(spark, sf_dir, "publishers")


@job(
    "flt_funders",
    f"""
    SELECT concat('F', p_partkey) AS funder_id, p_size + 3 AS cited_by_count, p_size AS works_count,
           p_size + 1 AS h_index, p_size + 2 AS i10_index, p_name AS display_name,
           concat(p_brand, '|', p_type) AS alternate_titles, p_type AS description,
           CAST(NULL AS STRING) AS homepage_url, 'r' AS id_ror, 'Q1' AS id_wikidata,
           CAST(p_size AS STRING) AS id_crossref, concat('10.1/', p_partkey) AS id_doi, {_DATES}
    FROM part
    """,
)
def flt_funders(spark, sf_dir):
    return _entity("funder")(spark, sf_dir, "funders")


@job(
    "flt_concepts",
    """
    SELECT 'concepts' AS part, concat('C', p_partkey) AS concept_id,
           concat_ws('|', p_size + 3, p_size, p_name, p_type, p_size, p_partkey, p_brand, 'Q1') AS rest,
           CAST(NULL AS DOUBLE) AS score
    FROM part
    UNION ALL
    SELECT 'ancestors', concat('C', p_partkey + a), concat('C', p_partkey), NULL
    FROM (SELECT p_partkey, unnest(range(1, p_size + 1)) AS a FROM part)
    UNION ALL
    SELECT 'related', concat('C', p_partkey), concat('C', p_size), p_size / 4.0 FROM part
    """,
)
def flt_concepts(spark, sf_dir):
    tables = flatten.flatten_concepts(nested_entities(spark, sf_dir, "concept"))
    main, above, related = (_plain(tables[t]) for t in ("concepts", "concepts_ancestors", "concepts_related"))
    rest = ("cited_by_count", "works_count", "display_name", "description", "level", "id_mag", "id_umls_cui",
            "id_umls_aui", "id_wikidata", "id_wikipedia")
    return (
        main.select(
            F.lit("concepts").alias("part"), "concept_id", F.concat_ws("|", *rest).alias("rest"),
            F.lit(None).cast("double").alias("score"),
        )
        .unionByName(
            above.select(
                F.lit("ancestors").alias("part"), F.col("parent_concept_id").alias("concept_id"),
                F.col("child_concept_id").alias("rest"), F.lit(None).cast("double").alias("score"),
            )
        )
        .unionByName(
            related.select(
                F.lit("related").alias("part"), F.col("concept_a_id").alias("concept_id"),
                F.col("concept_b_id").alias("rest"), "score",
            )
        )
    )


@job(
    "flt_sources",
    f"""
    SELECT concat('S', p_partkey) AS source_id, p_size + 3 AS cited_by_count, p_size AS works_count,
           p_size + 1 AS h_index, p_size + 2 AS i10_index, p_name AS display_name, p_brand AS abbreviated_title,
           p_name AS alternate_titles, 'DE' AS country_code, CAST(NULL AS STRING) AS homepage_url,
           lower(p_type) AS type, p_size * 10 AS apc_usd,
           concat('https://openalex.org/P', p_size) AS host_organization, p_brand AS host_organization_name,
           concat('P', p_size) AS host_organization_lineage,
           CASE WHEN p_size > 10 THEN concat('The ', p_type) END AS societies, p_size > 25 AS is_in_doaj,
           p_size > 20 AS is_oa, p_partkey AS id_mag, 'f' AS id_fatcat, '1234-5678|8765-4321' AS id_issn,
           '1234-5678' AS id_issn_l, 'Q1' AS id_wikidata, {_DATES}
    FROM part
    """,
)
def flt_sources(spark, sf_dir):
    return _entity("source")(spark, sf_dir, "sources")


@job(
    "flt_topics",
    f"""
    SELECT concat('T', p_partkey) AS topic_id, concat('https://en.wikipedia.org/', p_partkey) AS id_wikipedia,
           p_name AS display_name, p_type AS description, concat(p_brand, '|', p_type) AS keywords,
           p_size * 10 AS subfield_id, p_type AS subfield, p_size AS field_id, p_brand AS field,
           CAST(NULL AS INT) AS domain_id, 'x' AS domain, p_size AS works_count, p_size + 3 AS cited_by_count, {_DATES}
    FROM part
    """,
)
def flt_topics(spark, sf_dir):
    return _entity("topic")(spark, sf_dir, "topics")


@job(
    "flt_taxonomy",
    """
    SELECT l.level AS level, p_partkey AS id, p_name AS display_name, p_type AS description,
           concat(p_brand, '|', p_type) AS display_name_alternatives,
           CASE WHEN l.level = 'subfield' THEN p_size END AS field_id,
           CASE WHEN l.level = 'subfield' THEN p_brand END AS field,
           CASE WHEN l.level <> 'domain' THEN p_size + 1 END AS domain_id,
           CASE WHEN l.level <> 'domain' THEN p_type END AS domain, p_size AS works_count
    FROM part CROSS JOIN (VALUES ('subfield'), ('field'), ('domain')) AS l(level)
    """,
)
def flt_taxonomy(spark, sf_dir):
    merged = None
    for level in ("subfield", "field", "domain"):
        rows = _entity(level)(spark, sf_dir, f"{level}s").withColumnRenamed(f"{level}_id", "id")
        rows = rows.withColumn("level", F.lit(level))
        merged = rows if merged is None else merged.unionByName(rows, allowMissingColumns=True)
    return merged.select(
        "level", F.col("id").cast("bigint").alias("id"), "display_name", "description", "display_name_alternatives",
        "field_id", "field", "domain_id", "domain", "works_count",
    )


def _institutions(rows):
    return rows.groupBy("work_id", "author_id", "institution_id").agg(F.count(F.lit(1)).alias("n"))


def _tags(tables):
    concepts = tables["works_concepts"].select(
        F.lit("concept").alias("kind"), "work_id", F.col("concept_id").alias("tag_id"),
        F.lit(None).cast("string").alias("display_name"), F.col("score").cast("double").alias("score"),
    )
    goals = tables["works_sdgs"].select(
        F.lit("sdg").alias("kind"), "work_id", F.col("sdg_id").alias("tag_id"), "display_name",
        F.col("score").cast("double").alias("score"),
    )
    return concepts, goals


def _edges(tables):
    cited = tables["works_references"].select(
        F.lit("references").alias("kind"), F.col("src_work_id").alias("source_id"),
        F.col("trgt_work_id").alias("target_id"),
    )
    related = tables["works_related"].select(
        F.lit("related").alias("kind"), F.col("work_a_id").alias("source_id"), F.col("work_b_id").alias("target_id")
    )
    return cited, related


def owned_parts(tables):
    """The tables that a work owns, each in the shape of the query that flattens it."""
    concepts, goals = _tags(tables)
    cited, related = _edges(tables)
    return {
        "works": _plain(tables["works"]), "works_authorships": _plain(tables["works_authorships"]),
        "works_authorship_institutions": _institutions(tables["works_authorship_institutions"]), "works_locations": tables["works_locations"],
        "works_concepts": concepts, "works_sdgs": goals, "works_topics": _plain(tables["works_topics"]),
        "works_references": cited, "works_related": related,
    }


@job(
    "flt_works",
    r"""
    WITH <<lines>>, per AS (
      SELECT doc_id, concat('[', string_agg(concat('{"funder":"F', length(line),
               '","funder_display_name":null,"award_id":"', source, '"}'), ',' ORDER BY i) FILTER (WHERE line <> ''), ']') AS grants,
             concat('[', string_agg(concat('{"is_major_topic":', CASE WHEN i = 0 THEN 'true' ELSE 'false' END,
               ',"descriptor_ui":"D', length(line), '","descriptor_name":"', lang, '","qualifier_ui":"Q', i,
               '","qualifier_name":null}'),
               ',' ORDER BY i), ']') AS mesh, bool_or(line <> '') AS funded
      FROM lines GROUP BY doc_id)
    SELECT concat('W', doc_id) AS work_id, split_part(text, chr(10), 1) AS title,
           NULLIF(array_to_string(regexp_extract_all(text, '[^ \t\r\n]+'), ' '), '') AS abstract,
           1 AS countries_distinct_count, split_part(text, chr(10), 1) AS display_name, lang AS language,
           '2024-01-01' AS publication_date, CAST(1990 + n_chars % 36 AS INT) AS publication_year,
           CASE WHEN source NOT IN ('src1', 'src2') THEN source END AS volume, CAST(NULL AS STRING) AS issue,
           CAST(n_chars AS STRING) AS first_page, CAST(NULL AS STRING) AS last_page,
           CASE WHEN split_part(text, chr(10), 1) <> ''
                THEN concat('S', length(split_part(text, chr(10), 1)) % 50) END AS primary_location,
           'article' AS type, 'journal-article' AS type_crossref, CAST(n_chars AS INT) AS cited_by_count,
           concat('10.5555/D', doc_id) AS id_doi, doc_id AS id_mag, CAST(NULL AS STRING) AS id_pmid,
           CAST(NULL AS STRING) AS id_pmcid, source = 'src9' AS is_oa,
           CASE WHEN source = 'src9' THEN 'gold' WHEN source <> 'src8' THEN 'closed' END AS oa_status,
           CASE WHEN source <> 'src8' THEN concat('http://example.org/', doc_id) END AS oa_url,
           false AS oa_any_repository_has_fulltext,
           CASE WHEN source NOT IN ('src2', 'src12', 'src3') THEN CAST(n_chars AS INT) END AS apc_paid,
           CAST(n_chars + 1 AS INT) AS apc_list, CAST(NULL AS STRING) AS license, false AS is_paratext,
           source = 'src13' AS is_retracted, 'pdf' AS fulltext_origin, true AS has_fulltext,
           CASE WHEN source <> 'src4' THEN concat(source, '|', lang) END AS indexed_in,
           2 AS institutions_distinct_count, false AS is_authors_truncated, p.mesh AS mesh,
           CASE WHEN p.funded THEN p.grants END AS grants, '2024-01-01 10:00:00' AS created_date,
           '2024-02-01 00:00:00' AS updated_date
    FROM documents d LEFT JOIN per p USING (doc_id)
    """,
)
def flt_works(spark, sf_dir):
    return _plain(flatten.works_table(nested_works(spark, sf_dir)))


@job(
    "flt_authorships",
    """
    WITH <<lines>>
    SELECT concat('W', doc_id) AS work_id, CASE WHEN line <> '' THEN concat('A', length(line)) END AS author_id,
           upper(lang) AS countries,
           CASE WHEN i = 0 THEN 'first' WHEN i = n_lines - 1 THEN 'last' ELSE 'middle' END AS position,
           i AS exact_position, line AS raw_affiliation, split_part(line, ' ', 1) AS raw_author_name,
           line AS raw_affiliation_strings, i = 0 AS is_corresponding
    FROM lines
    """,
)
def flt_authorships(spark, sf_dir):
    return _plain(flatten.works_authorships(nested_works(spark, sf_dir)))


@job(
    "flt_authorship_institutions",
    """
    WITH <<lines>>, parts AS (
      SELECT doc_id, line, unnest(list_filter(string_split_regex(line, '[.] '), lambda s: s <> '')) AS s FROM lines)
    SELECT concat('W', doc_id) AS work_id, concat('A', length(line)) AS author_id,
           concat('I', length(s)) AS institution_id, count(*) AS n
    FROM parts GROUP BY ALL
    """,
)
def flt_authorship_institutions(spark, sf_dir):
    return _institutions(flatten.works_authorship_institutions(nested_works(spark, sf_dir)))


@job(
    "flt_locations",
    """
    WITH <<lines>>, keyed AS (
      SELECT *, CAST(length(line) % 50 AS STRING) AS s,
             CASE WHEN length(line) % 3 > 0 THEN concat('pdf', length(line) % 3) END AS pdf FROM lines)
    SELECT concat('W', k.doc_id) AS work_id, CASE WHEN k.line <> '' THEN concat('S', k.s) END AS source_id,
           k.source = 'src9' AS is_oa,
           k.line <> '' AND p.line <> '' AND k.s = p.s AND k.pdf IS NOT DISTINCT FROM p.pdf AS is_primary,
           k.i = 0 AS is_accepted, k.i > 0 AS is_published,
           concat('http://example.org/', k.doc_id, '/', k.i) AS landing_page_url, CAST(NULL AS STRING) AS license,
           k.pdf AS pdf_url, 'publishedVersion' AS version
    FROM keyed k JOIN keyed p ON p.doc_id = k.doc_id AND p.i = 0
    """,
)
def flt_locations(spark, sf_dir):
    return flatten.works_locations(nested_works(spark, sf_dir))


@job(
    "flt_scored_tags",
    """
    WITH <<lines>>
    SELECT 'concept' AS kind, concat('W', doc_id) AS work_id, concat('C', length(line)) AS tag_id,
           CAST(NULL AS STRING) AS display_name, length(line) / 8.0 AS score FROM lines
    UNION ALL
    SELECT 'sdg', concat('W', doc_id), concat('sdg/', length(line) % 17), lang, length(line) / 2.0
    FROM lines WHERE line <> ''
    """,
)
def flt_scored_tags(spark, sf_dir):
    concepts, goals = _tags(flatten.flatten_works(nested_works(spark, sf_dir)))
    return concepts.unionByName(goals)


@job(
    "flt_edges",
    """
    WITH <<lines>>
    SELECT 'references' AS kind, concat('W', doc_id) AS source_id, concat('W', length(line)) AS target_id FROM lines
    UNION ALL
    SELECT 'related', concat('W', doc_id), concat('W', length(line) + 1) FROM lines
    """,
)
def flt_edges(spark, sf_dir):
    cited, related = _edges(flatten.flatten_works(nested_works(spark, sf_dir)))
    return cited.unionByName(related)


@job(
    "flt_topic_rank",
    """
    WITH <<lines>>
    SELECT concat('W', doc_id) AS work_id, concat('T', length(line)) AS topic_id, length(line) / 4.0 AS score,
           i + 1 AS rank
    FROM lines
    """,
)
def flt_topic_rank(spark, sf_dir):
    return _plain(flatten.works_topics(nested_works(spark, sf_dir)))


@job(
    "flt_counts_by_year",
    """
    WITH rows AS (
      SELECT 'author' AS entity, concat('A', c_custkey) AS id, c_nationkey AS a, CAST(floor(c_acctbal) AS INT) AS b
      FROM customer
      UNION ALL
      SELECT 'institution', concat('I', s_suppkey), s_nationkey, CAST(floor(s_acctbal) AS INT) FROM supplier
      UNION ALL SELECT 'concept', concat('C', p_partkey), p_size, p_size + 3 FROM part
      UNION ALL SELECT 'venue', concat('S', p_partkey), p_size, p_size + 3 FROM part)
    SELECT entity, id, 2020 AS year, a AS works_count, b AS cited_by_count FROM rows
    UNION ALL SELECT entity, id, 2021, b, a FROM rows
    """,
)
def flt_counts_by_year(spark, sf_dir):
    merged = None
    for entity in ("author", "institution", "concept", "source"):
        name = "venue" if entity == "source" else entity
        rows = flatten.counts_by_year(nested_entities(spark, sf_dir, entity), name)
        rows = rows.withColumnRenamed(f"{name}_id", "id").withColumn("entity", F.lit(name))
        merged = rows if merged is None else merged.unionByName(rows)
    return merged


@job(
    "flt_side_tables",
    """
    SELECT 'institutions_geo' AS part, concat('I', s_suppkey) AS id,
           concat_ws('|', concat('city ', s_nationkey), '1', 'DE', concat('country ', s_nationkey)) AS content
    FROM supplier
    UNION ALL
    SELECT 'institutions_ids', concat('I', s_suppkey),
           concat_ws('|', 'x', 'r', concat('grid.', s_suppkey), 'Q1', s_suppkey) FROM supplier
    UNION ALL
    SELECT 'concepts_ids', concat('C', p_partkey), concat_ws('|', p_partkey, 'x', concat('["', p_brand, '"]'), '[]', 'Q1')
    FROM part
    UNION ALL
    SELECT 'works_biblio', concat('W', doc_id),
           concat_ws('|', CASE WHEN source NOT IN ('src1', 'src2') THEN source END, n_chars) FROM documents
    UNION ALL
    SELECT 'works_open_access', concat('W', doc_id),
           CASE WHEN source = 'src8' THEN '' ELSE concat_ws('|', CASE WHEN source = 'src9' THEN 'gold' ELSE 'closed' END,
                     concat('http://example.org/', doc_id)) END FROM documents
    """,
)
def flt_side_tables(spark, sf_dir):
    institutions = nested_entities(spark, sf_dir, "institution")
    concepts = nested_entities(spark, sf_dir, "concept")
    works = nested_works(spark, sf_dir)
    geo = flatten.side_table(institutions, "institution", "geo").drop("latitude", "longitude")
    access = flatten.works_v0(works)["works_open_access"]
    parts = {
        "institutions_geo": geo,
        "institutions_ids": flatten.side_table(institutions, "institution", "ids"),
        "concepts_ids": flatten.side_table(concepts, "concept", "ids"),
        "works_biblio": flatten.side_table(works, "work", "biblio"),
        "works_open_access": access,
    }
    merged = None
    for name, rows in parts.items():
        key, *rest = rows.columns
        rows = rows.select(
            F.lit(name).alias("part"), F.col(key).alias("id"), F.concat_ws("|", *rest).alias("content")
        )
        merged = rows if merged is None else merged.unionByName(rows)
    return merged


@job(
    "flt_authorships_outer",
    """
    WITH <<lines>>, parts AS (
      SELECT doc_id, i, n_lines, line, list_filter(string_split_regex(line, '[.] '), lambda s: s <> '') AS ss
      FROM lines WHERE line <> ''),
    rows AS (
      SELECT doc_id, i, n_lines, line, unnest(CASE WHEN len(ss) = 0 THEN [NULL] ELSE ss END) AS s FROM parts)
    SELECT concat('W', doc_id) AS work_id,
           CASE WHEN i = 0 THEN 'first' WHEN i = n_lines - 1 THEN 'last' ELSE 'middle' END AS author_position,
           concat('A', length(line)) AS author_id, CASE WHEN s IS NOT NULL THEN concat('I', length(s)) END AS institution_id,
           line AS raw_affiliation_string
    FROM rows
    """,
)
def flt_authorships_outer(spark, sf_dir):
    return flatten.works_authorships_v0(nested_works(spark, sf_dir))


@job(
    "flt_parents_v0",
    """
    SELECT 'authors' AS part, concat('A', c_custkey) AS id,
           concat_ws('|', c_name, concat('["\\"', c_name, '\\"","', c_mktsegment, ', etc",""]'), c_nationkey,
                     CAST(floor(c_acctbal) AS INT), concat('https://openalex.org/I', c_nationkey), '2024-02-01') AS content
    FROM customer
    UNION ALL
    SELECT 'institutions', concat('I', s_suppkey),
           concat_ws('|', concat('https://ror.org/', s_suppkey), s_name, 'DE', 'education',
                     concat('http://example.org/', s_suppkey), '["''"]',
                     concat('["', s_name, '","a,', s_nationkey, '"]'), s_nationkey, CAST(floor(s_acctbal) AS INT),
                     '2024-02-01')
    FROM supplier
    UNION ALL
    SELECT 'concepts', concat('C', p_partkey), concat_ws('|', 'Q1', p_name, p_size, p_type, p_size, p_size + 3, '2024-02-01')
    FROM part
    UNION ALL
    SELECT 'venues', concat('S', p_partkey),
           concat_ws('|', '1234-5678', '["1234-5678"]', p_name, p_brand, p_size, p_size + 3,
                     CASE WHEN p_size > 20 THEN 'true' ELSE 'false' END, CASE WHEN p_size > 25 THEN 'true' ELSE 'false' END,
                     '2024-02-01')
    FROM part
    UNION ALL
    SELECT 'works', concat('W', doc_id),
           concat_ws('|', concat('https://doi.org/10.5555/D', doc_id), doc_id, split_part(text, chr(10), 1),
                     1990 + n_chars % 36, '2024-01-01', 'article', n_chars,
                     CASE WHEN source = 'src13' THEN 'true' ELSE 'false' END, 'false',
                     CASE WHEN source = 'src9' THEN 'true' ELSE 'false' END,
                     array_to_string(regexp_extract_all(text, '[^ \t\r\n]+'), ' '))
    FROM documents
    """,
)
def flt_parents_v0(spark, sf_dir):
    merged = None
    for entity, table in (("author", "authors"), ("institution", "institutions"), ("concept", "concepts"),
                          ("source", "venues"), ("work", "works")):
        records = nested_works(spark, sf_dir) if entity == "work" else nested_entities(spark, sf_dir, entity)
        rows = flatten.flatten_entity(records, entity, "v0")[table]
        rest = [c for c in rows.columns if c != "id"]
        rows = rows.select(F.lit(table).alias("part"), "id", F.concat_ws("|", *rest).alias("content"))
        merged = rows if merged is None else merged.unionByName(rows)
    return merged


@job(
    "flt_host_venues",
    """
    WITH <<lines>>
    SELECT 'host' AS part, concat('W', doc_id) AS work_id, concat('S', length(line) % 50) AS other_id,
           concat('http://example.org/', doc_id, '/0') AS url, source = 'src9' AS flag, 'publishedVersion' AS version,
           CAST(NULL AS STRING) AS license, CAST(NULL AS STRING) AS name, CAST(NULL AS STRING) AS qualifier FROM lines
    WHERE i = 0 AND line <> ''
    UNION ALL
    SELECT 'alternate', concat('W', doc_id), concat('V', length(line)), concat('http://example.org/v/', i), i = 0,
           NULL, lang, NULL, NULL FROM lines WHERE line <> ''
    UNION ALL
    SELECT 'mesh', concat('W', doc_id), concat('D', length(line)), NULL, i = 0, NULL, NULL, lang, concat('Q', i) FROM lines
    UNION ALL
    SELECT 'referenced', concat('W', doc_id), concat('W', length(line)), NULL, NULL, NULL, NULL, NULL, NULL FROM lines
    """,
)
def flt_host_venues(spark, sf_dir):
    tables = flatten.works_v0(nested_works(spark, sf_dir))

    venue = {"other_id": "venue_id", "url": "url", "flag": "is_oa", "version": "version", "license": "license"}
    heading = {"other_id": "descriptor_ui", "flag": "is_major_topic", "name": "descriptor_name", "qualifier": "qualifier_ui"}

    def part(name, table, columns):
        def value(target):
            return F.col(columns[target]) if target in columns else F.lit(None).cast("boolean" if target == "flag" else "string")

        names = ("other_id", "url", "flag", "version", "license", "name", "qualifier")
        return tables[table].select(F.lit(name).alias("part"), "work_id", *[value(n).alias(n) for n in names])

    return (
        part("host", "works_host_venues", venue)
        .unionByName(part("alternate", "works_alternate_host_venues", venue))
        .unionByName(part("mesh", "works_mesh", heading))
        .unionByName(part("referenced", "works_referenced_works", {"other_id": "referenced_work_id"}))
    )
