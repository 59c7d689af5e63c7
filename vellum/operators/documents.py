"""Catalogue works to flat search documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.functions.ids import strip_id
from vellum.functions.text import rebuild_positional, title_abstract


def json_or_null(items: Column) -> Column:
    """A list as JSON without null fields; an empty list is NULL."""
    return F.when(F.size(items) > 0, F.to_json(items))


def is_primary(location: Column, primary: Column) -> Column:
    """Whether a location is the primary one: same source, PDF and version, a missing value equals a missing one."""
    same = (
        primary["source"].isNotNull()
        & location["source"].isNotNull()
        & location["source"]["id"].eqNullSafe(primary["source"]["id"])
        & location["source"]["display_name"].eqNullSafe(primary["source"]["display_name"])
        & location["pdf_url"].eqNullSafe(primary["pdf_url"])
        & location["version"].eqNullSafe(primary["version"])
    )
    return F.coalesce(same, F.lit(False))


def in_collection(works: DataFrame, collection: str = "all") -> DataFrame:
    """``all`` works, the ``base`` ones, or only the expansion pack (``xpac``). Unmarked works are base."""
    expansion = F.coalesce("is_xpac", F.lit(False))
    if collection == "all":
        return works
    return works.where(expansion if collection == "xpac" else ~expansion)


def with_abstract(works: DataFrame, index_col: str = "abstract_inverted_index") -> DataFrame:
    """Add the abstract as text."""
    return works.withColumn("abstract", rebuild_positional(F.col(index_col)))


def to_documents(works: DataFrame, authorship_limit: int | None = None) -> DataFrame:
    """One search document per work: flat fields, nested lists as JSON text."""
    primary = F.col("primary_location")
    locations = F.transform(
        "locations",
        lambda loc: F.struct(
            loc["is_oa"].alias("is_oa"),
            is_primary(loc, primary).alias("is_primary"),
            loc["landing_page_url"].alias("landing_page_url"),
            loc["license"].alias("license"),
            loc["source"].alias("source"),
            loc["pdf_url"].alias("pdf_url"),
            loc["version"].alias("version"),
        ),
    )
    authorships = F.col("authorships")
    if authorship_limit is not None:
        authorships = F.slice(authorships, 1, authorship_limit)
    abstract = F.col("abstract")
    return with_abstract(works).select(
        strip_id(F.col("id")).alias("id"),
        "title",
        abstract,
        title_abstract(F.col("title"), abstract).alias("title_abstract"),
        json_or_null(authorships).alias("authorships"),
        F.when(F.col("biblio.volume").isNotNull(), F.to_json("biblio")).alias("biblio"),
        "cited_by_count",
        "created_date",
        "doi",
        F.col("ids.mag").cast("string").alias("mag"),
        F.col("ids.pmid").alias("pmid"),
        F.col("ids.pmcid").alias("pmcid"),
        json_or_null(F.col("indexed_in")).alias("indexed_in"),
        F.col("open_access.is_oa").alias("is_oa"),
        "is_paratext",
        "is_retracted",
        primary["is_published"].alias("is_published"),
        primary["is_accepted"].alias("is_accepted"),
        "language",
        primary["source"]["host_organization_name"].alias("publisher"),
        primary["source"]["host_organization"].alias("publisher_id"),
        json_or_null(locations).alias("locations"),
        "publication_date",
        "publication_year",
        "type",
        "updated_date",
        "is_xpac",
        F.when(abstract.isNotNull(), F.lit("OpenAlex")).alias("abstract_source"),
        F.lit(None).cast("timestamp").alias("abstract_date"),
    )


def encoded_nested(works: DataFrame) -> DataFrame:
    """Grants and subject headings as JSON text, funder ids stripped; empty lists are NULL."""
    grants = F.transform(
        "grants",
        lambda g: F.struct(
            strip_id(g["funder"]).alias("funder"),
            g["funder_display_name"].alias("funder_display_name"),
            g["award_id"].alias("award_id"),
        ),
    )
    # these two keep their null fields, unlike the documents
    options = {"ignoreNullFields": "false"}
    return works.withColumn("grants", F.when(F.size("grants") > 0, F.to_json(grants, options))).withColumn(
        "mesh", F.when(F.size("mesh") > 0, F.to_json("mesh", options))
    )
