"""Nested records built row by row from the driver tables: one list element per line of a text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.functions.text import positions_by_item
from vellum.plans.fixtures import table
from vellum.session import scratch_path, widen

_URL = "https://openalex.org/"
_ENTRIES = "ARRAY<STRUCT<term: STRING, positions: ARRAY<INT>>>"


def _lines(element: str, keep: str | None = None) -> str:
    """SQL of a list with one ``element`` per line, which may use ``line`` and its place ``i``."""
    source = "ls"
    if keep:
        source = f"filter({source}, line -> {keep})"
    return f"transform({source}, (line, i) -> {element})"


_SOURCE = f"""CASE WHEN line <> '' THEN named_struct(
    'id', concat('{_URL}S', length(line) % 50), 'display_name', concat('source ', length(line) % 50),
    'host_organization', concat('{_URL}P', lang), 'host_organization_name', concat('host ', lang),
    'host_organization_lineage', array(concat('{_URL}P', lang)), 'is_in_doaj', false, 'is_oa', source = 'src9',
    'issn', array('1234-5678'), 'issn_l', '1234-5678', 'type', 'journal') END"""

_LOCATION = f"""named_struct(
    'is_accepted', i = 0, 'is_oa', source = 'src9', 'is_primary', CAST(NULL AS BOOLEAN), 'is_published', i > 0,
    'landing_page_url', concat('http://example.org/', doc_id, '/', i), 'license', CAST(NULL AS STRING),
    'pdf_url', CASE WHEN length(line) % 3 > 0 THEN concat('pdf', length(line) % 3) END,
    'source', {_SOURCE}, 'version', 'publishedVersion')"""

_AUTHORSHIP = f"""named_struct(
    'author', named_struct('id', CASE WHEN line <> '' THEN concat('{_URL}A', length(line)) END,
                           'display_name', concat('name ', length(line)), 'orcid', CAST(NULL AS STRING)),
    'author_position', CASE WHEN i = 0 THEN 'first' WHEN i = size(ls) - 1 THEN 'last'
                            ELSE 'middle' END,
    'countries', array(upper(lang)),
    'institutions', transform(filter(split(line, '[.] '), s -> s <> ''), s -> named_struct(
        'id', concat('{_URL}I', length(s)), 'display_name', concat('institution ', length(s)),
        'country_code', upper(lang), 'ror', CAST(NULL AS STRING), 'type', 'education')),
    'is_corresponding', i = 0, 'raw_affiliation_string', line, 'raw_affiliation_strings', array(line),
    'raw_author_name', split_part(line, ' ', 1))"""

_VENUE = f"""named_struct('id', CASE WHEN line <> '' THEN concat('{_URL}V', length(line)) END,
    'url', concat('http://example.org/v/', i), 'is_oa', i = 0, 'version', CAST(NULL AS STRING), 'license', lang)"""

_WORK = {
    "id": f"concat('{_URL}W', doc_id)",
    "doi": "concat('https://doi.org/10.5555/D', doc_id)",
    "title": "split_part(text, '\\n', 1)",
    "display_name": "split_part(text, '\\n', 1)",
    "language": "lang",
    "type": "'article'",
    "type_crossref": "'journal-article'",
    "publication_date": "'2024-01-01'",
    "publication_year": "CAST(1990 + n_chars % 36 AS INT)",
    "cited_by_count": "CAST(n_chars AS INT)",
    "is_oa": "source = 'src9'",
    "is_paratext": "false",
    "is_retracted": "source = 'src13'",
    "is_xpac": "source = 'src6'",
    "is_authors_truncated": "false",
    "has_fulltext": "true",
    "fulltext_origin": "'pdf'",
    "license": "CAST(NULL AS STRING)",
    "indexed_in": "CASE WHEN source <> 'src4' THEN array(source, lang) END",
    "countries_distinct_count": "1",
    "institutions_distinct_count": "2",
    "ids": "named_struct('doi', concat('10.5555/D', doc_id), 'mag', doc_id, 'openalex', concat('W', doc_id), "
    "'pmid', CAST(NULL AS STRING), 'pmcid', CAST(NULL AS STRING))",
    "biblio": "named_struct('volume', CASE WHEN source NOT IN ('src1', 'src2') THEN source END, "
    "'issue', CAST(NULL AS STRING), 'first_page', CAST(n_chars AS STRING), 'last_page', CAST(NULL AS STRING))",
    "open_access": "CASE WHEN source <> 'src8' THEN named_struct('oa_status', CASE WHEN source = 'src9' THEN 'gold' "
    "ELSE 'closed' END, 'oa_url', concat('http://example.org/', doc_id), 'any_repository_has_fulltext', false, "
    "'is_oa', source = 'src9') ELSE named_struct('oa_status', CAST(NULL AS STRING), 'oa_url', CAST(NULL AS STRING), "
    "'any_repository_has_fulltext', false, 'is_oa', false) END",
    "abstract_inverted_index": "abstract_inverted_index",
    "authorships": _lines(_AUTHORSHIP),
    "locations": _lines(_LOCATION),
    "primary_location": f"get({_lines(_LOCATION)}, 0)",
    "host_venue": "CAST(NULL AS STRUCT<id: STRING, url: STRING, is_oa: BOOLEAN, version: STRING, license: STRING>)",
    "alternate_host_venues": _lines(_VENUE),
    "concepts": _lines(
        f"named_struct('id', concat('{_URL}C', length(line)), 'display_name', line, 'level', i, "
        "'wikidata', CAST(NULL AS STRING), 'score', CAST(length(line) AS DOUBLE) / 8)"
    ),
    "topics": _lines(
        f"named_struct('id', concat('{_URL}T', length(line)), 'display_name', line, "
        "'score', CAST(length(line) AS DOUBLE) / 4)"
    ),
    "sustainable_development_goals": _lines(
        "named_struct('id', concat('sdg/', length(line) % 17), 'display_name', lang, "
        "'score', CAST(length(line) AS DOUBLE) / 2)",
        "line <> ''",
    ),
    "mesh": _lines(
        "named_struct('is_major_topic', i = 0, 'descriptor_ui', concat('D', length(line)), "
        "'descriptor_name', lang, 'qualifier_ui', concat('Q', i), "
        "'qualifier_name', CAST(NULL AS STRING))"
    ),
    "grants": _lines(
        f"named_struct('funder', concat('{_URL}F', length(line)), 'funder_display_name', CAST(NULL AS STRING), "
        "'award_id', source)",
        "line <> ''",
    ),
    "apc_list": "named_struct('value', CAST(n_chars AS INT), 'currency', 'EUR', 'provenance', 'doaj', "
    "'value_usd', CAST(n_chars + 1 AS INT))",
    "apc_paid": "CASE WHEN source IN ('src2', 'src12') THEN '[{\"value_usd\":5}]' "
    "WHEN source <> 'src3' THEN concat('{\"value\":3,\"value_usd\":', n_chars, '}') END",
    "referenced_works": _lines(f"concat('{_URL}W', length(line))"),
    "related_works": _lines(f"concat('{_URL}W', length(line) + 1)"),
    "created_date": "'2024-01-01T10:00:00'",
    "updated_date": "'2024-02-01'",
}


_STAGED: dict[tuple[str, str, str], str] = {}


def stored(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]) -> DataFrame:
    """A derived table, written once per session as a catalogue would hold it, so that scans can prune and filter."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STAGED:
        path = scratch_path(spark, name)
        write(path)
        _STAGED[key] = path
    return spark.read.parquet(_STAGED[key])


def _staged(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    return stored(spark, sf_dir, name, lambda path: build().write.parquet(path))


_TASKS: dict[tuple[str, str], int] = {}


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents, spread over more tasks only if their files can't be read by as many tasks as there are cores."""
    documents = table(spark, sf_dir, "documents")
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _TASKS:  # reads no column
        _TASKS[key] = documents.select(F.spark_partition_id().alias("task")).distinct().count()
    return documents if _TASKS[key] >= spark.sparkContext.defaultParallelism else widen(documents)


def nested_works(spark: SparkSession, sf_dir: str, wide: bool = False) -> DataFrame:
    """Works with authors, locations, concepts and the rest as nested lists; what a query doesn't read isn't built.

    ``wide`` spreads them over ``spark.sql.shuffle.partitions`` tasks in any case, for what holds or writes whole works.
    """
    documents = widen(table(spark, sf_dir, "documents")) if wide else _documents(spark, sf_dir)
    documents = documents.withColumn("ls", F.split("text", "\n")).withColumn("abstract_inverted_index", _inverted_text())
    return documents.selectExpr(*[f"{e} AS {name}" for name, e in _WORK.items()])


def inverted_works(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inverted abstracts: token to positions, for the whole text of every document."""
    return _staged(spark, sf_dir, "inverted", lambda: _inverted(spark, sf_dir))


def _inverted_text() -> Column:
    words = F.regexp_extract_all("text", F.lit(r"[^ \t\r\n]+"), F.lit(0))
    return F.map_from_entries(F.coalesce(positions_by_item(words), F.array().cast(_ENTRIES)))


def _inverted(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = widen(table(spark, sf_dir, "documents"))
    return documents.select("doc_id", _inverted_text().alias("abstract_inverted_index"))


def torn_works(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inverted abstracts that are not whole: one line is one token, and its position may be far off or taken.

    Lines at places 2, 7, 12, .. stand at the place before theirs, lines at places 4, 9, 14, .. far past the end, so both
    leave a gap. Equal lines are one token.
    """
    return _staged(spark, sf_dir, "torn", lambda: _torn(spark, sf_dir))


def _torn(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = F.transform(F.split("text", "\n"), lambda line, i: F.struct(
        F.concat(F.lit("t"), F.length(line).cast("string")).alias("t"),
        F.when(i % 5 == 2, i - 1).when(i % 5 == 4, i + 100_000).otherwise(i).alias("p"),
    ))
    tokens = F.array_distinct(lines["t"])
    places = F.transform(tokens, lambda t: F.transform(F.filter(lines, lambda x: x["t"] == t), lambda x: x["p"]))
    return widen(table(spark, sf_dir, "documents")).select(
        "doc_id", F.map_from_arrays(tokens, places).alias("abstract_inverted_index")
    )


_STATS = "named_struct('yr_mean_citedness', 1.0D, 'h_index', {h}, 'i10_index', {i})"
_DATES = {"created_date": "'2024-01-01T10:00:00'", "updated_date": "'2024-02-01'"}
_YEARS = (
    "array(named_struct('year', 2020, 'works_count', {a}, 'cited_by_count', {b}), "
    "named_struct('year', 2021, 'works_count', {b}, 'cited_by_count', {a}))"
)


def _scored(prefix: str, key: str) -> str:
    return (
        f"array(named_struct('id', concat('{_URL}{prefix}', {key}), 'display_name', 'x', 'level', 0, "
        f"'wikidata', 'Q1', 'score', CAST({key} AS DOUBLE) / 4))"
    )


_ENTITIES = {
    "author": (
        "customer",
        {
            "id": f"concat('{_URL}A', c_custkey)",
            "orcid": "CAST(NULL AS STRING)",
            "display_name": "c_name",
            "display_name_alternatives": "array(concat('\"', c_name, '\"'), concat(c_mktsegment, ', etc'), '')",
            "works_count": "c_nationkey",
            "cited_by_count": "CAST(floor(c_acctbal) AS INT)",
            "summary_stats": _STATS.format(h="c_nationkey + 1", i="c_nationkey + 2"),
            "last_known_institution": f"named_struct('id', concat('{_URL}I', c_nationkey), 'display_name', 'x', "
            "'country_code', 'DE', 'ror', 'r', 'type', 'education')",
            "ids": "named_struct('mag', c_custkey, 'openalex', concat('A', c_custkey), 'orcid', "
            "concat('0000-', c_custkey), 'scopus', c_mktsegment, 'twitter', CAST(NULL AS STRING), "
            "'wikipedia', CAST(NULL AS STRING))",
            "counts_by_year": _YEARS.format(a="c_nationkey", b="CAST(floor(c_acctbal) AS INT)"),
            **_DATES,
        },
    ),
    "institution": (
        "supplier",
        {
            "id": f"concat('{_URL}I', s_suppkey)",
            "ror": "concat('https://ror.org/', s_suppkey)",
            "display_name": "s_name",
            "display_name_acronyms": "array('''')",
            "display_name_alternatives": "array(s_name, concat('a,', s_nationkey))",
            "country_code": "'DE'",
            "homepage_url": "concat('http://example.org/', s_suppkey)",
            "type": "'education'",
            "works_count": "s_nationkey",
            "cited_by_count": "CAST(floor(s_acctbal) AS INT)",
            "summary_stats": _STATS.format(h="s_nationkey + 1", i="s_nationkey + 2"),
            "ids": "named_struct('openalex', 'x', 'ror', 'r', 'grid', concat('grid.', s_suppkey), 'wikipedia', "
            "CAST(NULL AS STRING), 'wikidata', 'Q1', 'mag', s_suppkey)",
            "geo": "named_struct('city', concat('city ', s_nationkey), 'geonames_city_id', '1', 'region', "
            "CAST(NULL AS STRING), 'country_code', 'DE', 'country', concat('country ', s_nationkey), "
            "'latitude', CAST(s_nationkey AS DOUBLE) / 4, 'longitude', CAST(s_nationkey AS DOUBLE) / 8)",
            "associated_institutions": "CASE WHEN s_acctbal >= 0 THEN array(named_struct('id', "
            f"concat('{_URL}I', s_nationkey), 'display_name', 'x', 'country_code', 'DE', 'ror', 'r', 'type', 't', "
            "'relationship', 'parent')) END",
            "associated_insitutions": "CASE WHEN s_acctbal < 5000 THEN array(named_struct('id', "
            f"concat('{_URL}I', s_nationkey + 100), 'display_name', 'x', 'country_code', 'DE', 'ror', 'r', 'type', "
            "'t', 'relationship', 'child')) END",
            "x_concepts": _scored("C", "s_nationkey"),
            "counts_by_year": _YEARS.format(a="s_nationkey", b="CAST(floor(s_acctbal) AS INT)"),
            **_DATES,
        },
    ),
    "publisher": (
        "supplier",
        {
            "id": f"CASE WHEN s_acctbal < 0 THEN 'short' ELSE concat('{_URL}P', s_suppkey) END",
            "display_name": "s_name",
            "alternate_titles": "array(s_name)",
            "country_codes": "array('DE', 'FR')",
            "hierarchy_level": "s_nationkey",
            "lineage": f"array(concat('{_URL}P', s_suppkey), 'short', concat('{_URL}P', s_nationkey))",
            "parent_publisher": f"named_struct('id', concat('{_URL}P', s_nationkey))",
            "works_count": "s_nationkey",
            "cited_by_count": "CAST(floor(s_acctbal) AS INT)",
            "summary_stats": _STATS.format(h="s_nationkey + 1", i="s_nationkey + 2"),
            "ids": "named_struct('openalex', 'x', 'ror', 'r', 'wikidata', concat('Q', s_suppkey))",
            **_DATES,
        },
    ),
    "funder": (
        "part",
        {
            "id": f"concat('{_URL}F', p_partkey)",
            "display_name": "p_name",
            "alternate_titles": "array(p_brand, p_type)",
            "description": "p_type",
            "homepage_url": "CAST(NULL AS STRING)",
            "works_count": "p_size",
            "cited_by_count": "p_size + 3",
            "summary_stats": _STATS.format(h="p_size + 1", i="p_size + 2"),
            "ids": "named_struct('openalex', 'x', 'ror', 'r', 'wikidata', 'Q1', 'crossref', "
            "CAST(p_size AS STRING), 'doi', concat('10.1/', p_partkey))",
            **_DATES,
        },
    ),
    "concept": (
        "part",
        {
            "id": f"concat('{_URL}C', p_partkey)",
            "wikidata": "'Q1'",
            "display_name": "p_name",
            "description": "p_type",
            "level": "p_size",
            "works_count": "p_size",
            "cited_by_count": "p_size + 3",
            "summary_stats": _STATS.format(h="p_size + 1", i="p_size + 2"),
            "ids": "named_struct('mag', p_partkey, 'openalex', 'x', 'umls_cui', array(p_brand), 'umls_aui', "
            "CAST(array() AS ARRAY<STRING>), 'wikidata', 'Q1', 'wikipedia', CAST(NULL AS STRING))",
            "ancestors": f"transform(sequence(1, p_size), a -> named_struct('id', concat('{_URL}C', p_partkey + a), "
            "'display_name', 'x', 'level', 0, 'wikidata', 'Q1'))",
            "related_concepts": _scored("C", "p_size"),
            "counts_by_year": _YEARS.format(a="p_size", b="p_size + 3"),
            **_DATES,
        },
    ),
    "source": (
        "part",
        {
            "id": f"concat('{_URL}S', p_partkey)",
            "display_name": "p_name",
            "abbreviated_title": "p_brand",
            "alternate_titles": "array(p_name)",
            "country_code": "'DE'",
            "homepage_url": "CAST(NULL AS STRING)",
            "type": "lower(p_type)",
            "apc_usd": "p_size * 10",
            "host_organization": f"concat('{_URL}P', p_size)",
            "host_organization_name": "p_brand",
            "host_organization_lineage": f"array(concat('{_URL}P', p_size))",
            "societies": "CASE WHEN p_size > 10 THEN array(named_struct('url', 'u', 'organization', "
            "concat('The ', p_type))) END",
            "is_in_doaj": "p_size > 25",
            "is_oa": "p_size > 20",
            "issn": "array('1234-5678')",
            "issn_l": "'1234-5678'",
            "publisher": "p_brand",
            "works_count": "p_size",
            "cited_by_count": "p_size + 3",
            "summary_stats": _STATS.format(h="p_size + 1", i="p_size + 2"),
            "ids": "named_struct('fatcat', 'f', 'issn', array('1234-5678', '8765-4321'), 'issn_l', '1234-5678', "
            "'mag', p_partkey, 'openalex', 'x', 'wikidata', 'Q1')",
            "counts_by_year": _YEARS.format(a="p_size", b="p_size + 3"),
            **_DATES,
        },
    ),
    "topic": (
        "part",
        {
            "id": f"concat('{_URL}T', p_partkey)",
            "display_name": "p_name",
            "description": "p_type",
            "keywords": "array(p_brand, p_type)",
            "ids": "named_struct('wikipedia', concat('https://en.wikipedia.org/', p_partkey))",
            "subfield": f"named_struct('id', concat('{_URL}subfields/', p_size * 10), 'display_name', p_type)",
            "field": f"named_struct('id', concat('{_URL}fields/', p_size), 'display_name', p_brand)",
            "domain": f"named_struct('id', '{_URL}domains/', 'display_name', 'x')",
            "works_count": "p_size",
            "cited_by_count": "p_size + 3",
            **_DATES,
        },
    ),
}

for _level in ("subfield", "field", "domain"):
    _ENTITIES[_level] = (
        "part",
        {
            "id": f"concat('{_URL}{_level}s/', p_partkey)",
            "display_name": "p_name",
            "display_name_alternatives": "array(p_brand, concat(p_type, ','))",
            "description": "p_type",
            "ids": "named_struct('wikidata', 'Q1', 'wikipedia', CAST(NULL AS STRING))",
            "field": f"named_struct('id', concat('{_URL}fields/', p_size), 'display_name', p_brand)",
            "domain": f"named_struct('id', concat('{_URL}domains/', p_size + 1), 'display_name', p_type)",
            "works_count": "p_size",
            "cited_by_count": "p_size + 3",
            **_DATES,
        },
    )


def nested_entities(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    """Nested records of an entity other than works."""
    base, columns = _ENTITIES[entity]
    return table(spark, sf_dir, base).selectExpr(*[f"{e} AS {name}" for name, e in columns.items()])
