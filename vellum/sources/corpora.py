"""Other corpora: JSON lines to typed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Output column, JSON path, type. A "json" column keeps the nested JSON as text.
CORE_WORKS = (
    ("core_id", "$.coreId", "string"),
    ("doi", "$.doi", "string"),
    ("mag_id", "$.magId", "string"),
    ("issn", "$.issn", "string"),
    ("oai", "$.oai", "string"),
    ("identifiers", "$.identifiers", "json"),
    ("title", "$.title", "string"),
    ("abstract", "$.abstract", "string"),
    ("work_language", "$.language", "json"),
    ("full_text_available", "$.fullTextIdentifier", "present"),
    ("authors", "$.authors", "json"),
    ("contributors", "$.contributors", "json"),
    ("publisher", "$.publisher", "string"),
    ("publisher_journals", "$.journals", "json"),
    ("provider_id", "$.provider_id", "string"),
    ("publication_year", "$.year", "int"),
    ("publication_date", "$.datePublished", "string"),
    ("work_topics", "$.topics", "json"),
    ("work_evaluation", "$.subjects", "json"),
    ("work_enrichments", "$.enrichments", "json"),
    ("work_relations", "$.relations", "json"),
    ("work_urls", "$.urls", "json"),
    ("full_text_url", "$.fullTextIdentifier", "string"),
)

S2_ABSTRACTS = (
    ("corpus_id", "$.corpusid", "string"),
    ("doi", "$.openaccessinfo.externalids.DOI", "string"),
    ("mag_id", "$.openaccessinfo.externalids.MAG", "string"),
    ("abstract", "$.abstract", "string"),
    ("open_access_status", "$.openaccessinfo.status", "string"),
    ("open_access_license", "$.openaccessinfo.license", "string"),
    ("open_access_url", "$.openaccessinfo.url", "string"),
    ("external_ids", "$.openaccessinfo.externalids", "json"),
    ("updated_date", "$.updated", "timestamp_ntz"),
)

S2_AUTHORS = (
    ("author_id", "$.authorid", "string"),
    ("external_ids", "$.externalids", "json"),
    ("name", "$.name", "string"),
    ("aliases", "$.aliases", "json"),
    ("url", "$.url", "string"),
    ("homepage", "$.homepage", "string"),
    ("affiliations", "$.affiliations", "json"),
    ("paper_count", "$.papercount", "int"),
    ("citation_count", "$.citationcount", "int"),
    ("hindex", "$.hindex", "int"),
    ("updated_date", "$.updated", "timestamp_ntz"),
)

S2_PAPERS = (
    ("corpus_id", "$.corpusid", "string"),
    ("doi", "$.externalids.DOI", "string"),
    ("mag_id", "$.externalids.MAG", "string"),
    ("external_ids", "$.externalids", "json"),
    ("title", "$.title", "string"),
    ("publication_year", "$.year", "int"),
    ("publication_venue", "$.venue", "string"),
    ("authors", "$.authors", "json"),
    ("is_open_access", "$.isopenaccess", "boolean"),
    ("url", "$.url", "string"),
    ("s2_fields_of_study", "$.s2fieldsofstudy", "json"),
    ("citation_count", "$.citationcount", "int"),
    ("reference_count", "$.referencecount", "int"),
    ("influential_citation_count", "$.influentialcitationcount", "int"),
    ("updated_date", "$.updated", "timestamp_ntz"),
)

S2_FULL_TEXTS = (
    ("corpus_id", "$.corpusid", "string"),
    ("doi", "$.externalids.doi", "string"),
    ("mag_id", "$.externalids.mag", "string"),
    ("external_ids", "$.externalids", "json"),
    ("open_access_metadata", "$.content.source.oainfo", "json"),
    ("full_text", "$.content.text", "string"),
    ("annotations", "$.content.annotations", "json"),
    ("updated_date", "$.updated", "timestamp_ntz"),
)

S2_SUMMARIES = (
    ("corpus_id", "$.corpusid", "string"),
    ("model", "$.model", "string"),
    ("summary", "$.text", "string"),
)

TABLES = {
    "core.works": CORE_WORKS,
    "s2.abstracts": S2_ABSTRACTS,
    "s2.authors": S2_AUTHORS,
    "s2.papers": S2_PAPERS,
    "s2.s2orc": S2_FULL_TEXTS,
    "s2.tldrs": S2_SUMMARIES,
}


def json_to_table(lines: DataFrame, table: str, data: str = "value") -> DataFrame:
    """Typed columns of one corpus table from JSON text; values that do not convert become NULL.

    The text is parsed once for all top-level keys; only a nested path parses its own, small part again.
    """
    fields = [(name, path.removeprefix("$.").split("."), kind) for name, path, kind in TABLES[table]]
    keys = list(dict.fromkeys(path[0] for _, path, _ in fields))
    parts = lines.select(F.json_tuple(data, *keys).alias(*[f"_{k}" for k in keys]))
    return parts.select(*[_typed(path, kind).alias(name) for name, path, kind in fields])


def _typed(path: list[str], kind: str) -> Column:
    value = F.col(f"_{path[0]}")
    if len(path) > 1:
        value = F.get_json_object(value, "$." + ".".join(path[1:]))
    if kind == "present":
        return value.isNotNull()
    return value if kind in ("string", "json") else value.try_cast(kind)


def split_full_text(archive: DataFrame, id_col: str = "coreId", text_col: str = "fullText") -> tuple[DataFrame, DataFrame]:
    """(records without their full text, full texts that exist). Both prune the other's columns at the scan."""
    return archive.drop(text_col), archive.select(id_col, text_col).where(F.col(text_col).isNotNull())


def source_dump(dump: DataFrame) -> DataFrame:
    """Cache rows of one source's bulk file; a fractional ``pmid`` becomes integer text, NaN becomes NULL."""
    pmid = F.col("pmid").cast("double")
    return dump.select(
        F.lit("DIMENSIONS").alias("wrapper"),
        F.col("id").alias("dimensions_id"),
        "doi",
        F.when(~F.isnan(pmid), pmid.cast("bigint").cast("string")).alias("pubmed_id"),
        "title",
        "abstract",
        F.to_json(F.struct(*dump.columns)).alias("raw"),
    )
