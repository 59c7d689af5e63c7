"""Nested records to relational tables. Every child table is its own narrow read of the same records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.functions.ids import parse_id, remove_prefix, strip_id
from vellum.functions.text import clean_list, rebuild_sorted
from vellum.operators.documents import encoded_nested, is_primary, with_abstract

# Prefixes of the numeric taxonomies.
SUBFIELD_PREFIX = "https://openalex.org/subfields/"
FIELD_PREFIX = "https://openalex.org/fields/"
DOMAIN_PREFIX = "https://openalex.org/domains/"

_STATS = (
    "cited_by_count",
    "works_count",
    "summary_stats.h_index",
    "summary_stats.i10_index",
)


def _id(name: str = "id") -> Column:
    return strip_id(F.col(name))


def _dates() -> list[Column]:
    return [F.col(c).try_cast("timestamp_ntz").alias(c) for c in ("created_date", "updated_date")]


def _list(name: str, strip=None) -> Column:
    return clean_list(F.col(name), strip).alias(name)


def flatten_authors(authors: DataFrame) -> dict[str, DataFrame]:
    table = authors.select(
        _id().alias("author_id"),
        *_STATS,
        "display_name",
        _list("display_name_alternatives"),
        strip_id(F.col("last_known_institution.id")).alias("last_known_institution"),
        F.col("ids.mag").alias("id_mag"),
        F.col("ids.orcid").alias("id_orcid"),
        F.col("ids.scopus").alias("id_scopus"),
        F.col("ids.twitter").alias("id_twitter"),
        F.col("ids.wikipedia").alias("id_wikipedia"),
        *_dates(),
    )
    return {"authors": table}


def flatten_institutions(institutions: DataFrame) -> dict[str, DataFrame]:
    table = institutions.select(
        _id().alias("institution_id"),
        "type",
        "homepage_url",
        *_STATS,
        "display_name",
        _list("display_name_alternatives"),
        _list("display_name_acronyms"),
        F.col("ror").alias("id_ror"),
        F.col("ids.mag").alias("id_mag"),
        F.col("ids.wikipedia").alias("id_wikipedia"),
        F.col("ids.wikidata").alias("id_wikidata"),
        F.col("ids.grid").alias("id_grid"),
        "geo.city",
        "geo.geonames_city_id",
        "geo.region",
        "geo.country",
        "geo.country_code",
        F.col("geo.latitude").cast("float").alias("latitude"),
        F.col("geo.longitude").cast("float").alias("longitude"),
        *_dates(),
    )
    # the older name of the field is misspelt
    linked = F.coalesce("associated_institutions", "associated_insitutions")
    associations = (
        institutions.select(_id().alias("parent_institution_id"), F.explode(linked).alias("other"))
        .where(F.col("other.id").isNotNull())
        .select(
            "parent_institution_id",
            strip_id(F.col("other.id")).alias("child_institution_id"),
            F.col("other.relationship").alias("relationship"),
        )
    )
    return {
        "institutions": table,
        "institutions_associations": associations,
        "institutions_concepts": _scored(institutions, "institution_id", "x_concepts", "concept_id"),
    }


def flatten_publishers(publishers: DataFrame) -> dict[str, DataFrame]:
    table = publishers.select(
        _id().alias("publisher_id"),
        *_STATS,
        "display_name",
        _list("alternate_titles"),
        _list("country_codes"),
        F.col("ids.ror").alias("id_ror"),
        F.col("ids.wikidata").alias("id_wikidata"),
        "hierarchy_level",
        _list("lineage", strip_id),
        strip_id(F.col("parent_publisher.id")).alias("parent"),
        *_dates(),
    )
    return {"publishers": table.where(F.col("publisher_id").isNotNull())}


def flatten_funders(funders: DataFrame) -> dict[str, DataFrame]:
    table = funders.select(
        _id().alias("funder_id"),
        *_STATS,
        "display_name",
        _list("alternate_titles"),
        "description",
        "homepage_url",
        F.col("ids.ror").alias("id_ror"),
        F.col("ids.wikidata").alias("id_wikidata"),
        F.col("ids.crossref").alias("id_crossref"),
        F.col("ids.doi").alias("id_doi"),
        *_dates(),
    )
    return {"funders": table}


def flatten_concepts(concepts: DataFrame) -> dict[str, DataFrame]:
    table = concepts.select(
        _id().alias("concept_id"),
        *_STATS,
        "display_name",
        "description",
        "level",
        F.col("ids.mag").alias("id_mag"),
        clean_list(F.col("ids.umls_cui")).alias("id_umls_cui"),
        clean_list(F.col("ids.umls_aui")).alias("id_umls_aui"),
        F.col("ids.wikidata").alias("id_wikidata"),
        F.col("ids.wikipedia").alias("id_wikipedia"),
        *_dates(),
    )
    ancestors = concepts.select(_id().alias("child_concept_id"), F.explode("ancestors").alias("other")).select(
        strip_id(F.col("other.id")).alias("parent_concept_id"), "child_concept_id"
    )
    return {
        "concepts": table,
        "concepts_ancestors": ancestors,
        "concepts_related": _scored(concepts, "concept_a_id", "related_concepts", "concept_b_id"),
    }


def flatten_sources(sources: DataFrame) -> dict[str, DataFrame]:
    societies = F.transform("societies", lambda s: s["organization"])
    table = sources.select(
        _id().alias("source_id"),
        *_STATS,
        "display_name",
        "abbreviated_title",
        _list("alternate_titles"),
        "country_code",
        "homepage_url",
        "type",
        "apc_usd",
        "host_organization",
        "host_organization_name",
        _list("host_organization_lineage", strip_id),
        clean_list(societies).alias("societies"),
        "is_in_doaj",
        "is_oa",
        F.col("ids.mag").alias("id_mag"),
        F.col("ids.fatcat").alias("id_fatcat"),
        clean_list(F.col("ids.issn")).alias("id_issn"),
        F.col("ids.issn_l").alias("id_issn_l"),
        F.col("ids.wikidata").alias("id_wikidata"),
        *_dates(),
    )
    return {"sources": table}


def _taxon(name: str, prefix: str) -> list[Column]:
    return [
        parse_id(F.col(f"{name}.id"), prefix).alias(f"{name}_id"),
        F.col(f"{name}.display_name").alias(name),
    ]


def flatten_topics(topics: DataFrame) -> dict[str, DataFrame]:
    table = topics.select(
        _id().alias("topic_id"),
        F.col("ids.wikipedia").alias("id_wikipedia"),
        "display_name",
        "description",
        _list("keywords"),
        *_taxon("subfield", SUBFIELD_PREFIX),
        *_taxon("field", FIELD_PREFIX),
        *_taxon("domain", DOMAIN_PREFIX),
        "works_count",
        "cited_by_count",
        *_dates(),
    )
    return {"topics": table}


def flatten_taxonomy(taxa: DataFrame, level: str) -> dict[str, DataFrame]:
    """Subfields, fields or domains, each with the levels above it."""
    prefixes = {"subfield": SUBFIELD_PREFIX, "field": FIELD_PREFIX, "domain": DOMAIN_PREFIX}
    levels = list(prefixes)
    above = levels[levels.index(level) + 1 :]
    table = taxa.select(
        parse_id(F.col("id"), prefixes[level]).alias(f"{level}_id"),
        F.col("ids.wikipedia").alias("id_wikipedia"),
        F.col("ids.wikidata").alias("id_wikidata"),
        "display_name",
        "description",
        _list("display_name_alternatives"),
        *[c for name in above for c in _taxon(name, prefixes[name])],
        "works_count",
        "cited_by_count",
        *_dates(),
    )
    return {f"{level}s": table}


def _scored(records: DataFrame, key: str, items: str, other: str) -> DataFrame:
    return records.select(_id().alias(key), F.explode(items).alias("item")).select(
        key, strip_id(F.col("item.id")).alias(other), F.col("item.score").cast("float").alias("score")
    )


def flatten_works(works: DataFrame) -> dict[str, DataFrame]:
    """The works table and its child tables."""
    return {
        "works": works_table(works),
        "works_authorships": works_authorships(works),
        "works_authorship_institutions": works_authorship_institutions(works),
        "works_locations": works_locations(works),
        "works_concepts": _scored(works, "work_id", "concepts", "concept_id"),
        "works_sdgs": works_sdgs(works),
        "works_topics": works_topics(works),
        "works_references": _edges(works, "referenced_works", "src_work_id", "trgt_work_id"),
        "works_related": _edges(works, "related_works", "work_a_id", "work_b_id"),
    }


def price_usd(raw: Column) -> Column:
    """``value_usd`` of a price object; NULL where the field holds a list."""
    return F.when(~F.ltrim(raw).startswith("["), F.get_json_object(raw, "$.value_usd").try_cast("int"))


def works_table(works: DataFrame) -> DataFrame:
    return encoded_nested(with_abstract(works)).select(
        _id().alias("work_id"),
        "title",
        "abstract",
        "countries_distinct_count",
        "display_name",
        "language",
        "publication_date",
        "publication_year",
        "biblio.volume",
        "biblio.issue",
        "biblio.first_page",
        "biblio.last_page",
        strip_id(F.col("primary_location.source.id")).alias("primary_location"),
        "type",
        "type_crossref",
        "cited_by_count",
        F.col("ids.doi").alias("id_doi"),
        F.col("ids.mag").alias("id_mag"),
        F.col("ids.pmid").alias("id_pmid"),
        F.col("ids.pmcid").alias("id_pmcid"),
        "is_oa",
        "open_access.oa_status",
        "open_access.oa_url",
        F.col("open_access.any_repository_has_fulltext").alias("oa_any_repository_has_fulltext"),
        price_usd(F.col("apc_paid")).alias("apc_paid"),
        F.col("apc_list.value_usd").alias("apc_list"),
        "license",
        "is_paratext",
        "is_retracted",
        "fulltext_origin",
        "has_fulltext",
        _list("indexed_in"),
        "institutions_distinct_count",
        "is_authors_truncated",
        "mesh",
        "grants",
        *_dates(),
    )


def works_authorships(works: DataFrame) -> DataFrame:
    """One row per author, numbered from 0; the author id may be missing."""
    return works.select(_id().alias("work_id"), F.posexplode("authorships").alias("exact_position", "a")).select(
        "work_id",
        strip_id(F.col("a.author.id")).alias("author_id"),
        F.col("a.countries").alias("countries"),
        F.col("a.author_position").alias("position"),
        "exact_position",
        F.col("a.raw_affiliation_string").alias("raw_affiliation"),
        F.col("a.raw_author_name").alias("raw_author_name"),
        F.col("a.raw_affiliation_strings").alias("raw_affiliation_strings"),
        F.col("a.is_corresponding").alias("is_corresponding"),
    )


def works_authorship_institutions(works: DataFrame) -> DataFrame:
    """One row per author and institution; authors without one do not appear."""
    authors = works.select(_id().alias("work_id"), F.explode("authorships").alias("a")).select(
        "work_id", strip_id(F.col("a.author.id")).alias("author_id"), F.col("a.institutions.id").alias("ids")
    )
    return authors.select("work_id", "author_id", F.explode("ids").alias("id")).select(
        "work_id", "author_id", _id().alias("institution_id")
    )


def works_locations(works: DataFrame) -> DataFrame:
    """One row per location; the source id may be missing."""
    flagged = F.transform(
        "locations", lambda loc: F.struct(loc.alias("l"), is_primary(loc, F.col("primary_location")).alias("p"))
    )
    return works.select(_id().alias("work_id"), F.inline(flagged)).select(
        "work_id",
        strip_id(F.col("l.source.id")).alias("source_id"),
        F.col("l.is_oa").alias("is_oa"),
        F.col("p").alias("is_primary"),
        F.col("l.is_accepted").alias("is_accepted"),
        F.col("l.is_published").alias("is_published"),
        F.col("l.landing_page_url").alias("landing_page_url"),
        F.col("l.license").alias("license"),
        F.col("l.pdf_url").alias("pdf_url"),
        F.col("l.version").alias("version"),
    )


def works_sdgs(works: DataFrame) -> DataFrame:
    goals = works.select(_id().alias("work_id"), F.explode("sustainable_development_goals").alias("g"))
    return goals.select(
        "work_id",
        F.col("g.id").alias("sdg_id"),
        F.col("g.display_name").alias("display_name"),
        F.col("g.score").cast("float").alias("score"),
    )


def works_topics(works: DataFrame) -> DataFrame:
    """One row per topic, ranked from 1."""
    return works.select(_id().alias("work_id"), F.posexplode("topics").alias("place", "t")).select(
        "work_id",
        strip_id(F.col("t.id")).alias("topic_id"),
        F.col("t.score").cast("float").alias("score"),
        (F.col("place") + 1).alias("rank"),
    )


def _edges(works: DataFrame, items: str, source: str, target: str) -> DataFrame:
    return works.select(_id().alias(source), F.explode(items).alias("other")).select(
        source, strip_id(F.col("other")).alias(target)
    )


# The older table layout: other names, 1:1 side tables, one row per author and institution.


def _prefix_free(name: str = "id") -> Column:
    return remove_prefix(F.col(name))


def counts_by_year(records: DataFrame, entity: str) -> DataFrame:
    """Yearly counts of institutions, authors, concepts or venues."""
    rows = records.select(_prefix_free().alias(f"{entity}_id"), F.explode("counts_by_year").alias("c"))
    return rows.select(f"{entity}_id", "c.year", "c.works_count", "c.cited_by_count")


def side_table(records: DataFrame, entity: str, part: str) -> DataFrame:
    """A 1:1 table of one nested object, for records that have it. Lists inside become JSON text."""
    fields = dict(zip(*_struct_fields(records, part)))
    values = [
        F.to_json(f"{part}.{name}").alias(name) if kind.startswith("array") else F.col(f"{part}.{name}")
        for name, kind in fields.items()
    ]
    return records.where(F.col(part).isNotNull()).select(_prefix_free().alias(f"{entity}_id"), *values)


def _struct_fields(records: DataFrame, part: str) -> tuple[list[str], list[str]]:
    struct = records.schema[part].dataType
    return struct.names, [f.dataType.simpleString() for f in struct.fields]


def works_authorships_v0(works: DataFrame) -> DataFrame:
    """Author times institutions; an author without institution keeps one row with NULL."""
    authors = works.select(_prefix_free().alias("work_id"), F.explode("authorships").alias("a")).where(
        F.col("a.author.id").isNotNull()
    )
    listed = F.filter(F.col("a.institutions.id"), lambda i: i.isNotNull())
    return authors.select(
        "work_id",
        F.col("a.author_position").alias("author_position"),
        remove_prefix(F.col("a.author.id")).alias("author_id"),
        F.explode_outer(listed).alias("institution_id"),
        F.col("a.raw_affiliation_string").alias("raw_affiliation_string"),
    ).withColumn("institution_id", _prefix_free("institution_id"))


def host_venues(works: DataFrame) -> DataFrame:
    """The venue of the primary location, or of the older host venue field, where it has an id."""
    location = F.when(
        F.col("primary_location").isNotNull(),
        F.struct(
            F.col("primary_location.source.id").alias("id"),
            F.col("primary_location.landing_page_url").alias("url"),
            F.col("primary_location.is_oa").alias("is_oa"),
            F.col("primary_location.version").alias("version"),
            F.col("primary_location.license").alias("license"),
        ),
    )
    venues = works.select(_prefix_free().alias("work_id"), F.coalesce(location, F.col("host_venue")).alias("v"))
    return _venue_rows(venues)


def alternate_host_venues(works: DataFrame) -> DataFrame:
    return _venue_rows(works.select(_prefix_free().alias("work_id"), F.explode("alternate_host_venues").alias("v")))


def _venue_rows(venues: DataFrame) -> DataFrame:
    return venues.where(F.col("v.id").isNotNull()).select(
        "work_id",
        remove_prefix(F.col("v.id")).alias("venue_id"),
        F.col("v.url").alias("url"),
        F.col("v.is_oa").alias("is_oa"),
        F.col("v.version").alias("version"),
        F.col("v.license").alias("license"),
    )


def works_mesh(works: DataFrame) -> DataFrame:
    """One row per subject heading."""
    return works.select(_prefix_free().alias("work_id"), F.explode("mesh").alias("m")).select(
        "work_id",
        F.col("m.descriptor_ui").alias("descriptor_ui"),
        F.col("m.descriptor_name").alias("descriptor_name"),
        F.col("m.qualifier_ui").alias("qualifier_ui"),
        F.col("m.qualifier_name").alias("qualifier_name"),
        F.col("m.is_major_topic").alias("is_major_topic"),
    )


def referenced_works(works: DataFrame) -> DataFrame:
    """Citation edges; empty targets are left out."""
    rows = works.select(_prefix_free().alias("work_id"), F.explode("referenced_works").alias("other"))
    return rows.where(F.length("other") > 0).select("work_id", _prefix_free("other").alias("referenced_work_id"))


def institutions_v0(institutions: DataFrame) -> dict[str, DataFrame]:
    """The older institutions layout."""
    linked = F.coalesce("associated_institutions", "associated_insitutions")
    links = institutions.select(_prefix_free().alias("institution_id"), F.explode(linked).alias("other"))
    return {
        "institutions": institutions.select(
            _prefix_free().alias("id"), "ror", "display_name", "country_code", "type", "homepage_url",
            F.to_json("display_name_acronyms").alias("display_name_acronyms"),
            F.to_json("display_name_alternatives").alias("display_name_alternatives"), "works_count",
            "cited_by_count", "updated_date",
        ),
        "institutions_ids": side_table(institutions, "institution", "ids"),
        "institutions_geo": side_table(institutions, "institution", "geo"),
        "institutions_associated_institutions": links.where(F.col("other.id").isNotNull()).select(
            "institution_id", remove_prefix(F.col("other.id")).alias("associated_institution_id"),
            F.col("other.relationship").alias("relationship"),
        ),
        "institutions_counts_by_year": counts_by_year(institutions, "institution"),
    }


def authors_v0(authors: DataFrame) -> dict[str, DataFrame]:
    """The older authors layout."""
    return {
        "authors": authors.where(F.col("id").isNotNull()).select(
            _prefix_free().alias("id"), "orcid", "display_name",
            F.to_json("display_name_alternatives").alias("display_name_alternatives"), "works_count",
            "cited_by_count", F.col("last_known_institution.id").alias("last_known_institution"), "updated_date",
        ),
        "authors_ids": side_table(authors, "author", "ids"),
        "authors_counts_by_year": counts_by_year(authors, "author"),
    }


def concepts_v0(concepts: DataFrame) -> dict[str, DataFrame]:
    """The older concepts layout."""
    above = concepts.select(_prefix_free().alias("concept_id"), F.explode("ancestors").alias("other"))
    related = concepts.select(_prefix_free().alias("concept_id"), F.explode("related_concepts").alias("other"))
    return {
        "concepts": concepts.select(
            _prefix_free().alias("id"), "wikidata", "display_name", "level", "description", "works_count",
            "cited_by_count", "updated_date",
        ),
        "concepts_ancestors": above.where(F.col("other.id").isNotNull()).select(
            "concept_id", remove_prefix(F.col("other.id")).alias("ancestor_id")
        ),
        "concepts_related_concepts": related.where(F.col("other.id").isNotNull()).select(
            "concept_id", remove_prefix(F.col("other.id")).alias("related_concept_id"),
            F.col("other.score").alias("score"),
        ),
        "concepts_ids": side_table(concepts, "concept", "ids"),
        "concepts_counts_by_year": counts_by_year(concepts, "concept"),
    }


def venues_v0(sources: DataFrame) -> dict[str, DataFrame]:
    """The older venues table with its id and yearly count tables."""
    table = sources.select(
        _prefix_free().alias("id"), "issn_l", F.to_json("issn").alias("issn"), "display_name", "publisher",
        "works_count", "cited_by_count", "is_oa", "is_in_doaj", "homepage_url", "updated_date",
    )
    ids = side_table(sources, "venue", "ids").select("venue_id", "openalex", "issn_l", "issn", "mag")
    return {"venues": table, "venues_ids": ids, "venues_counts_by_year": counts_by_year(sources, "venue")}


def works_v0(works: DataFrame) -> dict[str, DataFrame]:
    """All tables of the older works layout."""
    table = works.select(
        _prefix_free().alias("id"), "doi", "ids.mag", "ids.pmid", "ids.pmcid", "title", "publication_year",
        "publication_date", "type", "cited_by_count", "is_retracted", "is_paratext",
        F.col("open_access.is_oa").alias("is_open_access"),
        rebuild_sorted(F.col("abstract_inverted_index")).alias("abstract"),
    )
    concepts = works.select(_prefix_free().alias("work_id"), F.explode("concepts").alias("c"))
    return {
        "works": table,
        "works_host_venues": host_venues(works),
        "works_alternate_host_venues": alternate_host_venues(works),
        "works_authorships": works_authorships_v0(works),
        "works_biblio": side_table(works, "work", "biblio"),
        "works_concepts": concepts.where(F.col("c.id").isNotNull()).select(
            "work_id", remove_prefix(F.col("c.id")).alias("concept_id"), F.col("c.score").alias("score")
        ),
        "works_mesh": works_mesh(works),
        "works_referenced_works": referenced_works(works),
        "works_open_access": side_table(works, "work", "open_access").select("work_id", "oa_status", "oa_url"),
    }


FLATTENERS_V0 = {
    "work": works_v0,
    "author": authors_v0,
    "institution": institutions_v0,
    "concept": concepts_v0,
    "source": venues_v0,
}

FLATTENERS = {
    "work": flatten_works,
    "author": flatten_authors,
    "institution": flatten_institutions,
    "publisher": flatten_publishers,
    "funder": flatten_funders,
    "concept": flatten_concepts,
    "source": flatten_sources,
    "topic": flatten_topics,
    "subfield": lambda taxa: flatten_taxonomy(taxa, "subfield"),
    "field": lambda taxa: flatten_taxonomy(taxa, "field"),
    "domain": lambda taxa: flatten_taxonomy(taxa, "domain"),
}


def flatten_entity(records: DataFrame, entity: str, layout: str = "v1") -> dict[str, DataFrame]:
    """All tables of one entity. ``records`` should come from a columnar copy (``stage_snapshot``): each table then
    reads its own columns only, where every table over JSON would parse the text again."""
    return (FLATTENERS if layout == "v1" else FLATTENERS_V0)[entity](records)
