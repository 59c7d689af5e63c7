"""Declared record schemas. Unknown keys are dropped, every field may be missing."""

from __future__ import annotations

SUMMARY = "STRUCT<yr_mean_citedness: DOUBLE, h_index: INT, i10_index: INT>"
COUNTS_BY_YEAR = "ARRAY<STRUCT<year: INT, works_count: INT, cited_by_count: INT>>"
NAMED = "STRUCT<id: STRING, display_name: STRING>"
CONCEPT_REF = "STRUCT<id: STRING, display_name: STRING, level: INT, wikidata: STRING>"
SCORED_CONCEPT = "STRUCT<id: STRING, display_name: STRING, level: INT, wikidata: STRING, score: DOUBLE>"
INSTITUTION_REF = "STRUCT<id: STRING, display_name: STRING, country_code: STRING, ror: STRING, type: STRING>"
LINKED_INSTITUTION = (
    "STRUCT<id: STRING, display_name: STRING, country_code: STRING, ror: STRING, type: STRING, relationship: STRING>"
)
SOURCE_REF = (
    "STRUCT<id: STRING, display_name: STRING, host_organization: STRING, host_organization_name: STRING, "
    "host_organization_lineage: ARRAY<STRING>, is_in_doaj: BOOLEAN, is_oa: BOOLEAN, issn: ARRAY<STRING>, "
    "issn_l: STRING, type: STRING>"
)
LOCATION = (
    "STRUCT<is_accepted: BOOLEAN, is_oa: BOOLEAN, is_primary: BOOLEAN, is_published: BOOLEAN, "
    f"landing_page_url: STRING, license: STRING, pdf_url: STRING, source: {SOURCE_REF}, version: STRING>"
)
AUTHORSHIP = (
    "STRUCT<author: STRUCT<id: STRING, display_name: STRING, orcid: STRING>, author_position: STRING, "
    f"countries: ARRAY<STRING>, institutions: ARRAY<{INSTITUTION_REF}>, is_corresponding: BOOLEAN, "
    "raw_affiliation_string: STRING, raw_affiliation_strings: ARRAY<STRING>, raw_author_name: STRING>"
)
TOPIC_REF = (
    f"STRUCT<id: STRING, display_name: STRING, score: DOUBLE, subfield: {NAMED}, field: {NAMED}, domain: {NAMED}>"
)
MESH = (
    "STRUCT<is_major_topic: BOOLEAN, descriptor_ui: STRING, descriptor_name: STRING, qualifier_ui: STRING, "
    "qualifier_name: STRING>"
)
PRICE = "STRUCT<value: INT, currency: STRING, provenance: STRING, value_usd: INT>"
HOST_VENUE = (
    "STRUCT<id: STRING, url: STRING, is_oa: BOOLEAN, version: STRING, license: STRING>"
)

WORK = f"""
    id STRING, doi STRING, title STRING, display_name STRING, language STRING, type STRING, type_crossref STRING,
    publication_date STRING, publication_year INT, cited_by_count INT, is_oa BOOLEAN, is_paratext BOOLEAN,
    is_retracted BOOLEAN, is_xpac BOOLEAN, is_authors_truncated BOOLEAN, has_fulltext BOOLEAN,
    fulltext_origin STRING, license STRING, indexed_in ARRAY<STRING>, countries_distinct_count INT,
    institutions_distinct_count INT,
    ids STRUCT<doi: STRING, mag: BIGINT, openalex: STRING, pmid: STRING, pmcid: STRING>,
    biblio STRUCT<volume: STRING, issue: STRING, first_page: STRING, last_page: STRING>,
    open_access STRUCT<oa_status: STRING, oa_url: STRING, any_repository_has_fulltext: BOOLEAN, is_oa: BOOLEAN>,
    abstract_inverted_index MAP<STRING, ARRAY<INT>>, authorships ARRAY<{AUTHORSHIP}>, locations ARRAY<{LOCATION}>,
    primary_location {LOCATION}, host_venue {HOST_VENUE}, alternate_host_venues ARRAY<{HOST_VENUE}>,
    concepts ARRAY<{SCORED_CONCEPT}>, topics ARRAY<{TOPIC_REF}>,
    sustainable_development_goals ARRAY<STRUCT<id: STRING, display_name: STRING, score: DOUBLE>>,
    mesh ARRAY<{MESH}>, grants ARRAY<STRUCT<funder: STRING, funder_display_name: STRING, award_id: STRING>>,
    apc_list {PRICE}, apc_paid STRING, referenced_works ARRAY<STRING>, related_works ARRAY<STRING>,
    created_date STRING, updated_date STRING
"""

# All that the retain-old job reads of a work.
WORK_ABSTRACT = "id STRING, title STRING, abstract_inverted_index MAP<STRING, ARRAY<INT>>"

AUTHOR = f"""
    id STRING, orcid STRING, display_name STRING, display_name_alternatives ARRAY<STRING>, works_count INT,
    cited_by_count INT, summary_stats {SUMMARY}, last_known_institution {INSTITUTION_REF},
    ids STRUCT<mag: BIGINT, openalex: STRING, orcid: STRING, scopus: STRING, twitter: STRING, wikipedia: STRING>,
    counts_by_year {COUNTS_BY_YEAR}, created_date STRING, updated_date STRING
"""

INSTITUTION = f"""
    id STRING, ror STRING, display_name STRING, display_name_acronyms ARRAY<STRING>,
    display_name_alternatives ARRAY<STRING>, country_code STRING, homepage_url STRING, type STRING, works_count INT,
    cited_by_count INT, summary_stats {SUMMARY},
    ids STRUCT<openalex: STRING, ror: STRING, grid: STRING, wikipedia: STRING, wikidata: STRING, mag: BIGINT>,
    geo STRUCT<city: STRING, geonames_city_id: STRING, region: STRING, country_code: STRING, country: STRING,
               latitude: DOUBLE, longitude: DOUBLE>,
    associated_institutions ARRAY<{LINKED_INSTITUTION}>, associated_insitutions ARRAY<{LINKED_INSTITUTION}>,
    x_concepts ARRAY<{SCORED_CONCEPT}>, counts_by_year {COUNTS_BY_YEAR}, created_date STRING, updated_date STRING
"""

PUBLISHER = f"""
    id STRING, display_name STRING, alternate_titles ARRAY<STRING>, country_codes ARRAY<STRING>, hierarchy_level INT,
    lineage ARRAY<STRING>, parent_publisher STRUCT<id: STRING>, works_count INT, cited_by_count INT,
    summary_stats {SUMMARY}, ids STRUCT<openalex: STRING, ror: STRING, wikidata: STRING>, created_date STRING,
    updated_date STRING
"""

FUNDER = f"""
    id STRING, display_name STRING, alternate_titles ARRAY<STRING>, description STRING, homepage_url STRING,
    works_count INT, cited_by_count INT, summary_stats {SUMMARY},
    ids STRUCT<openalex: STRING, ror: STRING, wikidata: STRING, crossref: STRING, doi: STRING>, created_date STRING,
    updated_date STRING
"""

CONCEPT = f"""
    id STRING, wikidata STRING, display_name STRING, description STRING, level INT, works_count INT,
    cited_by_count INT, summary_stats {SUMMARY},
    ids STRUCT<mag: BIGINT, openalex: STRING, umls_cui: ARRAY<STRING>, umls_aui: ARRAY<STRING>, wikidata: STRING,
               wikipedia: STRING>,
    ancestors ARRAY<{CONCEPT_REF}>, related_concepts ARRAY<{SCORED_CONCEPT}>, counts_by_year {COUNTS_BY_YEAR},
    created_date STRING, updated_date STRING
"""

SOURCE = f"""
    id STRING, display_name STRING, abbreviated_title STRING, alternate_titles ARRAY<STRING>, country_code STRING,
    homepage_url STRING, type STRING, apc_usd INT, host_organization STRING, host_organization_name STRING,
    host_organization_lineage ARRAY<STRING>, societies ARRAY<STRUCT<url: STRING, organization: STRING>>,
    is_in_doaj BOOLEAN, is_oa BOOLEAN, issn ARRAY<STRING>, issn_l STRING, publisher STRING, works_count INT,
    cited_by_count INT, summary_stats {SUMMARY},
    ids STRUCT<fatcat: STRING, issn: ARRAY<STRING>, issn_l: STRING, mag: BIGINT, openalex: STRING, wikidata: STRING>,
    counts_by_year {COUNTS_BY_YEAR}, created_date STRING, updated_date STRING
"""

TOPIC = f"""
    id STRING, display_name STRING, description STRING, keywords ARRAY<STRING>, ids STRUCT<wikipedia: STRING>,
    subfield {NAMED}, field {NAMED}, domain {NAMED}, works_count INT, cited_by_count INT, created_date STRING,
    updated_date STRING
"""

TAXON = f"""
    id STRING, display_name STRING, display_name_alternatives ARRAY<STRING>, description STRING,
    ids STRUCT<wikidata: STRING, wikipedia: STRING>, field {NAMED}, domain {NAMED}, works_count INT,
    cited_by_count INT, created_date STRING, updated_date STRING
"""

ENTITIES = {
    "work": WORK,
    "author": AUTHOR,
    "institution": INSTITUTION,
    "publisher": PUBLISHER,
    "funder": FUNDER,
    "concept": CONCEPT,
    "source": SOURCE,
    "topic": TOPIC,
    "subfield": TAXON,
    "field": TAXON,
    "domain": TAXON,
}

MERGE_LOG = "merge_date STRING, id STRING, merge_into_id STRING"
