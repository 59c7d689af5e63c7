"""Source payloads: extraction from raw JSON and XML, and one record shape for all sources."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNIFIED = ("title", "abstract", "doi", "pubmed_id", "scopus_id", "wos_id", "dimensions_id", "raw")

_WOS_IDENTIFIERS = (
    "STRUCT<dynamic_data: STRUCT<cluster_related: STRUCT<identifiers: STRUCT<identifier: "
    "ARRAY<STRUCT<type: STRING, value: STRING>>>>>>"
)
_PUBMED_IDS = (
    "STRUCT<PubmedData: ARRAY<STRUCT<ArticleIdList: ARRAY<STRUCT<ArticleId: "
    "ARRAY<STRUCT<`@IdType`: STRING, `_text`: STRING>>>>>>>"
)


def wos_identifier(raw: Column, *types: str) -> Column:
    """Value of the first cluster identifier of one of the given types."""
    listed = F.from_json(raw, _WOS_IDENTIFIERS)["dynamic_data"]["cluster_related"]["identifiers"]["identifier"]
    return F.get(F.filter(listed, lambda x: x["type"].isin(*types)), F.lit(0))["value"]


def pubmed_doi(raw: Column) -> Column:
    """First article id marked as a DOI, over all id lists of the payload."""
    data = F.from_json(raw, _PUBMED_IDS)["PubmedData"]
    lists = F.flatten(F.transform(data, lambda d: d["ArticleIdList"]))
    ids = F.flatten(F.transform(lists, lambda a: a["ArticleId"]))
    return F.get(F.filter(ids, lambda x: x["@IdType"] == "doi"), F.lit(0))["_text"]


def backfill_doi(request: DataFrame) -> DataFrame:
    """Fill a missing DOI from the payload of the two sources that bury it there; others stay as they are."""
    buried = F.when(F.col("wrapper") == "WOS", wos_identifier(F.col("raw"), "xref_doi", "doi")).when(
        F.col("wrapper") == "PUBMED", pubmed_doi(F.col("raw"))
    )
    return request.withColumn("doi", F.coalesce("doi", buried))


def _unified(payloads: DataFrame, **values: Column) -> DataFrame:
    empty = F.lit(None).cast("string")
    keep = [c for c in payloads.columns if c not in UNIFIED]
    return payloads.select(*keep, *[values.get(name, empty).alias(name) for name in UNIFIED])


def unify_scopus(payloads: DataFrame, raw: str = "raw") -> DataFrame:
    """Entries of a Scopus search response."""
    return _unified(
        payloads,
        title=F.get_json_object(raw, "$['dc:title']"),
        abstract=F.get_json_object(raw, "$['dc:description']"),
        doi=F.get_json_object(raw, "$['prism:doi']"),
        scopus_id=F.get_json_object(raw, "$.eid"),
        raw=F.col(raw),
    )


def unify_dimensions(payloads: DataFrame, raw: str = "raw") -> DataFrame:
    """Publications of a Dimensions search response."""
    return _unified(
        payloads,
        title=F.get_json_object(raw, "$.title"),
        abstract=F.get_json_object(raw, "$.abstract"),
        doi=F.get_json_object(raw, "$.doi"),
        dimensions_id=F.get_json_object(raw, "$.id"),
        raw=F.col(raw),
    )


def unify_pubmed(payloads: DataFrame, raw: str = "raw") -> DataFrame:
    """``PubmedArticle`` XML: text of the first title, paragraphs of the first abstract, marked DOI, first PMID."""

    def parts(path: str) -> Column:
        return F.xpath(F.col(raw), F.lit(path))

    title, abstract = parts("(//ArticleTitle)[1]//text()"), parts("(//Abstract)[1]//text()")
    return _unified(
        payloads,
        title=F.nullif(F.array_join(title, " "), F.lit("")),
        abstract=F.nullif(F.array_join(abstract, "\n\n"), F.lit("")),
        doi=F.get(parts('(//ArticleId[@IdType="doi"])[1]/text()'), F.lit(0)),
        pubmed_id=F.get(parts("(//PMID)[1]/text()"), F.lit(0)),
        raw=F.col(raw),
    )


# The extension point: a source name and how its payloads become unified records.
ADAPTERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "SCOPUS": unify_scopus,
    "DIMENSIONS": unify_dimensions,
    "PUBMED": unify_pubmed,
}


def register_adapter(source: str, adapter: Callable[[DataFrame], DataFrame]) -> None:
    """Add or replace the adapter of a source."""
    ADAPTERS[source.upper()] = adapter


def unify(payloads: DataFrame, source: str) -> DataFrame:
    """Unified records of one source's payloads; other columns pass through."""
    return ADAPTERS[source.upper()](payloads).withColumn("wrapper", F.lit(source.upper()))


def unify_all(payloads: DataFrame, source_col: str = "wrapper") -> DataFrame:
    """Unified records of a mixed table of payloads. Rows of a source without adapter keep their payload, the rest is NULL."""
    merged = None
    known = F.upper(source_col).isin(list(ADAPTERS))
    for source in ADAPTERS:
        part = unify(payloads.where(F.upper(source_col) == source).drop(source_col), source)
        merged = part if merged is None else merged.unionByName(part)
    other = payloads.where(~F.coalesce(known, F.lit(False))).withColumnRenamed(source_col, "wrapper")
    raw = other["raw"] if "raw" in other.columns else F.lit(None).cast("string")
    other = _unified(other, raw=raw)
    return other if merged is None else merged.unionByName(other)
