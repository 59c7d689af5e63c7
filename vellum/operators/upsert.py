"""Keyed updates of stored tables. Each takes the current state and returns the next one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.functions.text import title_abstract
from vellum.operators.joins import first_per_key
from vellum.session import cut_lineage

# Which tables an entity owns, and by which column.
OWNED_TABLES = {
    "author": {"authors": "author_id"},
    "institution": {
        "institutions": "institution_id",
        "institutions_associations": "parent_institution_id",
        "institutions_concepts": "institution_id",
    },
    "publisher": {"publishers": "publisher_id"},
    "source": {"sources": "source_id"},
    "concept": {
        "concepts": "concept_id",
        "concepts_ancestors": "child_concept_id",
        "concepts_related": "concept_a_id",
    },
    "funder": {"funders": "funder_id"},
    "work": {
        "works": "work_id",
        "works_authorships": "work_id",
        "works_authorship_institutions": "work_id",
        "works_concepts": "work_id",
        "works_locations": "work_id",
        "works_sdgs": "work_id",
        "works_topics": "work_id",
        "works_references": "src_work_id",
        "works_related": "work_a_id",
    },
}


def upsert(old: DataFrame, new: DataFrame, key: str, mode: str = "replace") -> DataFrame:
    """The old table with the rows of ``new`` (unique per key) put in.

    ``replace`` takes new rows whole, ``patch`` sets the columns ``new`` has, also to NULL, for keys that exist,
    ``coalesce`` does the same with non-null values only and adds unknown keys.
    """
    if mode == "replace":
        kept = old.join(new.select(key), key, "left_anti")
        return kept.unionByName(new, allowMissingColumns=True)
    changed = [c for c in new.columns if c != key]
    staged = new.select(F.col(key), *[F.col(c).alias(f"_{c}") for c in changed], F.lit(True).alias("_found"))
    how = "left" if mode == "patch" else "full"
    joined = old.join(staged, key, how)

    def value(c: str) -> Column:
        if c not in changed:
            return F.col(c)
        if mode == "patch":
            return F.when(F.col("_found"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c)
        return F.coalesce(F.col(f"_{c}"), F.col(c)).alias(c)

    return joined.select(*[value(c) for c in old.columns])


def insert_or_replace(old: DataFrame, new: DataFrame, key: str, order: Sequence[str | Column]) -> DataFrame:
    """Replace by key, after reducing ``new`` to its first row per key in ``order``."""
    return upsert(old, first_per_key(new.where(F.col(key).isNotNull()), [key], order), key)


def first_seen(records: DataFrame, key: str, order: Sequence[str | Column]) -> DataFrame:
    """Records with an id, one per id: the first in file order."""
    return first_per_key(records.where(F.col(key).isNotNull()), [key], order)


def delete_ids(table: DataFrame, ids: DataFrame, column: str, id_col: str = "id") -> DataFrame:
    """Rows whose ``column`` is not among the ids; rows without a value stay."""
    gone = ids.select(F.col(id_col).alias(column)).distinct()
    return table.join(gone, column, "left_anti")


def delete_entity(tables: dict[str, DataFrame], ids: DataFrame, entity: str, id_col: str = "id") -> dict[str, DataFrame]:
    """Every table without the rows the given ids own. Edges that only point at such an id stay."""
    owned = OWNED_TABLES[entity]
    # one list for all tables, of known size, so that a short one goes to the tasks and no table is shuffled for it
    ids = cut_lineage(ids.select(id_col).distinct(), "gone")
    return {
        name: delete_ids(table, ids, owned[name], id_col) if name in owned else table
        for name, table in tables.items()
    }


def replace_entity(
    tables: dict[str, DataFrame], updates: dict[str, DataFrame], entity: str
) -> dict[str, DataFrame]:
    """Delete what the updated entities own, then insert their new rows."""
    parent, key = next(iter(OWNED_TABLES[entity].items()))
    kept = delete_entity(tables, updates[parent], entity, key)
    return {
        name: table.unionByName(updates[name], allowMissingColumns=True) if name in updates else table
        for name, table in kept.items()
    }


def delete_merged(tables: dict[str, DataFrame], merged: DataFrame, entity: str) -> dict[str, DataFrame]:
    """Remove records that were merged into another one, with what they own."""
    return delete_entity(tables, merged, entity)


def mark_written(request: DataFrame, written: DataFrame, id_col: str = "openalex_id") -> DataFrame:
    """Set the done flag on *every* cache row of the written works, not only on the row that was used."""
    ids = written.select(id_col).distinct().withColumn("_written", F.lit(True))
    # rows that are done already, or have no id, stay out of the join
    settled = F.col(id_col).isNull() | F.coalesce("solarized", F.lit(False))
    marked = request.where(~settled).join(ids, id_col, "left")
    marked = marked.withColumn("solarized", F.coalesce("_written", "solarized")).select(*request.columns)
    return request.where(settled).unionByName(marked)


def reset_written(request: DataFrame) -> DataFrame:
    """Clear the done flag."""
    return request.withColumn("solarized", F.lit(None).cast("boolean"))


def fill_abstracts(index: DataFrame, best: DataFrame, now: Column, force: bool = False) -> DataFrame:
    """Write cached abstracts into the index.

    ``best`` has one row per openalex_id (title, abstract, abstract_source). Only documents without an abstract
    change, unless ``force``; all other columns stay. Ids the index does not have are left out. Documents with an
    abstract, the bulk of the index, are neither joined nor shuffled unless ``force``.
    """
    staged = best.select(
        F.col("openalex_id").alias("_id"),
        F.col("title").alias("_title"),
        F.col("abstract").alias("_abstract"),
        F.col("abstract_source").alias("_source"),
        F.lit(True).alias("_found"),
    )
    open_documents = index if force else index.where(F.col("abstract").isNull())
    joined = open_documents.join(staged, F.col("id") == F.col("_id"), "left")
    changes = {
        "title": F.col("_title"),
        "abstract": F.col("_abstract"),
        "title_abstract": title_abstract(F.col("_title"), F.col("_abstract")),
        "abstract_source": F.col("_source"),
        "abstract_date": now,
    }
    filled = _set_where(joined, F.col("_found"), changes, index.columns)
    return filled if force else index.where(F.col("abstract").isNotNull()).unionByName(filled)


def _set_where(df: DataFrame, condition: Column, changes: dict[str, Column], columns: Sequence[str]) -> DataFrame:
    return df.select(
        *[F.when(condition, changes[c]).otherwise(F.col(c)).alias(c) if c in changes else F.col(c) for c in columns]
    )


def updated_documents(index: DataFrame, update: DataFrame, now: Column, found: bool = False) -> DataFrame:
    """The documents to write for updated works, so that no abstract is lost.

    An updated work replaces its document. Where only the old document has an abstract it is kept, and its source
    becomes ``OpenAlex_old`` when it was ``OpenAlex``. A changed abstract gets a new ``abstract_date``, an
    unchanged one keeps the old date. ``found``: the index given is what was found of the updates' ids.
    """
    keeps = F.col("abstract").isNull() & F.col("_abstract").isNotNull()
    # an update is small beside the index: its ids, not the index's texts, travel first
    held = index if found else index.join(update.select("id"), "id", "left_semi")
    before = held.select(
        F.col("id").alias("_id"),
        F.col("abstract").alias("_abstract"),
        F.col("abstract_source").alias("_source"),
        F.col("abstract_date").alias("_date"),
    )
    joined = update.join(before, F.col("id") == F.col("_id"), "left")
    retired = F.when(F.col("_source") == "OpenAlex", F.lit("OpenAlex_old")).otherwise(F.col("_source"))
    unchanged = keeps | F.col("abstract").eqNullSafe(F.col("_abstract"))
    abstract = F.when(keeps, F.col("_abstract")).otherwise(F.col("abstract"))
    changes = {
        "abstract": abstract,
        "title_abstract": title_abstract(F.col("title"), abstract),
        "abstract_source": F.when(keeps, retired).when(
            F.col("abstract").isNotNull(), F.coalesce("abstract_source", F.lit("OpenAlex"))
        ),
        "abstract_date": F.when(unchanged, F.col("_date")).otherwise(now),
    }
    columns = list(dict.fromkeys([*update.columns, *changes]))
    return joined.select(*[changes[c].alias(c) if c in changes else F.col(c) for c in columns])


def apply_update(index: DataFrame, update: DataFrame, now: Column) -> DataFrame:
    """The whole index after an update; ``update`` has one row per id."""
    return upsert(index, updated_documents(index, update, now), "id")


def retain_old(old: DataFrame, index: DataFrame, now: Column) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Bring abstracts of an older snapshot back into documents that lack one.

    ``old`` is (openalex_id, abstract), one row per id. Gives the next index, the cache rows to append, and the
    counters processed / with abstract / matched / updated.
    """
    usable = old.where(F.col("abstract").isNotNull()).select(
        F.col("openalex_id").alias("_id"), F.col("abstract").alias("_old")
    )
    joined = index.where(F.col("abstract").isNull()).join(usable, F.col("id") == F.col("_id"), "left")
    write = F.col("_old").isNotNull()
    changes = {
        "abstract": F.col("_old"),
        "title_abstract": title_abstract(F.col("title"), F.col("_old")),
        "abstract_source": F.lit("OpenAlex_old"),
        "abstract_date": now,
    }
    filled = _set_where(joined, write, changes, index.columns)
    following = index.where(F.col("abstract").isNotNull()).unionByName(filled)
    cache_rows = joined.where(write).select(
        F.lit("OpenAlex_old").alias("wrapper"),
        F.col("id").alias("openalex_id"),
        F.col("_old").alias("abstract"),
        F.lit(True).alias("solarized"),
        now.alias("time_created"),
    )
    return following, cache_rows, reconcile(old, index)


def reconcile(old: DataFrame, index: DataFrame) -> DataFrame:
    """One row of counters: processed, with abstract, matched in the index, updated."""
    present = index.select(F.col("id").alias("_id"), F.col("abstract").isNull().alias("_lacks"))
    joined = old.select("openalex_id", F.col("abstract").isNotNull().alias("_has")).join(
        present, F.col("openalex_id") == F.col("_id"), "left"
    )
    return joined.agg(
        F.count(F.lit(1)).alias("n_works"),
        F.count_if(F.col("_has")).alias("n_with_abstract"),
        F.count_if(F.col("_has") & F.col("_id").isNotNull()).alias("n_matched"),
        F.count_if(F.col("_has") & F.col("_lacks")).alias("n_updated"),
    )
