"""The catalogue's jobs from end to end: current tables in, next tables out.

Each job is a plan over DataFrames; where the tables live and how they are written is the caller's choice
(``vellum.sources.writers`` has versioned tables and batch logs).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.functions.ids import strip_url
from vellum.functions.text import rebuild_positional
from vellum.operators import queueing, reports, upsert
from vellum.operators.documents import in_collection, to_documents
from vellum.operators.flatten import flatten_entity
from vellum.operators.joins import first_per_key
from vellum.operators.search import missing_in_range
from vellum.sources import writers
from vellum.sources.keyed import RangeTable


def ingest(
    index: DataFrame | None, works: DataFrame, collection: str = "all", authorship_limit: int | None = None
) -> DataFrame:
    """Snapshot works into the index, replacing documents with the same id; of several records the newest counts."""
    documents = to_documents(in_collection(works, collection), authorship_limit)
    order = F.struct("updated_date", F.xxhash64(*[c for c in documents.columns if c != "id"]))
    newest = first_per_key(documents.where(F.col("id").isNotNull()), ["id"], [order], last=True)
    return newest if index is None else upsert.upsert(index, newest, "id")


def transfer(
    index: DataFrame,
    request: DataFrame,
    now: Column,
    force: bool = False,
    after: Column | None = None,
    before: Column | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Cached abstracts into the index. Gives the next index, the next cache, and one row (n_total, n_skipped)."""
    best = reports.best_abstract(request, after, before)
    target = index if force else index.where(F.col("abstract").isNull())
    written = target.select(F.col("id").alias("openalex_id")).withColumn("_open", F.lit(True))
    counters = best.select("openalex_id").join(written, "openalex_id", "left").agg(
        F.count(F.lit(1)).alias("n_total"), F.count_if(F.col("_open").isNull()).alias("n_skipped")
    )
    return upsert.fill_abstracts(index, best, now, force), upsert.mark_written(request, best), counters


def daily_update(index: DataFrame, update: DataFrame, now: Column) -> tuple[DataFrame, DataFrame]:
    """A day's changed works into the index; gives the next index and the works to queue for an abstract."""
    lacking = update.where(F.col("abstract").isNull() & F.col("doi").isNotNull() & F.col("id").isNotNull())
    entries = lacking.select(
        F.col("id").alias("openalex_id"),
        strip_url(F.col("doi")).alias("doi"),
        F.lit(None).cast("string").alias("pubmed_id"),
        F.lit(None).cast(queueing.SOURCES_TYPE).alias("sources"),
        F.lit(queueing.CONFLICT_DO_NOTHING).alias("on_conflict"),
        now.alias("time_created"),
    )
    return upsert.apply_update(index, update, now), entries


def match_old_snapshot(
    works: DataFrame, index: DataFrame, now: Column
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Bring back abstracts from an older snapshot's works (id, abstract_inverted_index).

    Gives the next index, cache rows to append, and counters.
    """
    rows = works.where(F.col("id").isNotNull()).select(
        strip_url(F.col("id")).alias("openalex_id"),
        rebuild_positional(F.col("abstract_inverted_index")).alias("abstract"),
    )
    # a work may occur in several partitions: one of its abstracts, else none
    return upsert.retain_old(rows.groupBy("openalex_id").agg(F.max("abstract").alias("abstract")), index, now)


def _candidates(documents: DataFrame) -> DataFrame:
    pmid = F.col("pmid") if "pmid" in documents.columns else F.lit(None).cast("string")
    return documents.select(
        F.col("id").alias("openalex_id"), strip_url(F.col("doi")).alias("doi"), pmid.alias("pubmed_id")
    )


def queue_missing(
    index: DataFrame,
    request: DataFrame,
    queue: DataFrame,
    since: str,
    until: str,
    now: Column,
    sources: Sequence[tuple[str, int]] | None = None,
    limit: int | None = None,
    most: int | None = None,
) -> DataFrame:
    """Queue entries for documents without abstract created or updated between two days, both included.

    Against queueing millions by accident the caller may take the first ``limit`` new entries only, or have an error if
    there are more than ``most``.
    """
    entries = queueing.enqueue(_candidates(missing_in_range(index, since, until)), request, queue, now, sources)
    entries = entries if most is None else queueing.at_most(entries, most)
    return entries if limit is None else queueing.capped(entries, limit, ["openalex_id"])


def queue_file(
    listed: DataFrame,
    request: DataFrame,
    queue: DataFrame,
    now: Column,
    sources: Sequence[tuple[str, int]] | None = None,
) -> DataFrame:
    """Queue entries for a list of (openalex_id, doi, pubmed_id), as ``read_id_csv`` gives it."""
    return queueing.enqueue(listed, request, queue, now, sources)


def queue_ids(
    index: DataFrame, ids: DataFrame, now: Column, sources: Sequence[tuple[str, int]] = queueing.GAP_SOURCES
) -> tuple[DataFrame, DataFrame]:
    """Queue entries for the listed ids that lack an abstract and have a DOI, whether known or not.

    Gives the entries and one row of counters: checked, missing abstract, queued.
    """
    lacking = queueing.lacking_abstract(index, ids)
    entries = _candidates(lacking.where(F.col("doi").isNotNull())).select(
        "*",
        queueing.sources_of(sources).alias("sources"),
        F.lit(queueing.CONFLICT_DO_NOTHING).alias("on_conflict"),
        now.alias("time_created"),
    )
    present = lacking.select(F.col("id").alias("openalex_id"), F.col("doi").isNotNull().alias("_doi"))
    counters = ids.join(present, "openalex_id", "left").agg(
        F.count(F.lit(1)).alias("n_checked"),
        F.count_if(F.col("_doi").isNotNull()).alias("n_missing_abstract"),
        F.count_if(F.col("_doi")).alias("n_queued"),
    )
    return entries, counters


def sample_ids(
    index: DataFrame, n: int, seed: int | str = 4243, ensure_abstract: bool = False, include_xpac: bool = False
) -> DataFrame:
    """A reproducible random sample of ids. Without ``include_xpac`` only works marked as not xpac are drawn."""
    rows = index.where(F.col("abstract").isNotNull()) if ensure_abstract else index
    rows = rows if include_xpac else rows.where(~F.col("is_xpac"))
    return reports.seeded_sample(rows, "id", n, seed)


def update_tables(tables: dict[str, DataFrame], records: DataFrame, entity: str) -> dict[str, DataFrame]:
    """Changed records of one entity into the flat tables: delete what they own, then insert."""
    return upsert.replace_entity(tables, flatten_entity(records, entity), entity)


def update_stored(table: RangeTable, update: DataFrame, now: Column) -> int:
    """``daily_update`` of a stored index: reads the documents of updated works and rewrites the files that hold them.

    ``update`` has one row per id. Gives the number of files rewritten.
    """
    return table.upsert(upsert.updated_documents(table.rows_of(update), update, now))


def _list_digest(queue: DataFrame) -> tuple:
    """Number of entries and an order-free sum over their source lists: equal if no entry moved."""
    total = F.sum(F.xxhash64("queue_id", F.to_json("sources")).cast("decimal(38,0)"))
    return tuple(queue.agg(F.count(F.lit(1)), total).first())


def work_rounds(
    spark: SparkSession,
    root: str,
    queue: DataFrame,
    request: DataFrame,
    ask: Callable[[DataFrame], DataFrame],
    rounds: int,
    min_abstract_length: int = 25,
    until: datetime | None = None,
) -> int:
    """Work the queue round after round until no entry moves, at most ``rounds`` rounds in all and none that starts after ``until``.

    ``ask`` gets the entries to ask for and gives the sources' answers. Below ``root`` lie the queue after each round (version
    0 is the queue as it was) and the cache rows each round has landed; the cache is ``request`` and all of those. A round
    counts once its queue is written: its rows come first, and a round that was broken off is done again and replaces
    them. Called again with the same ``root`` the work goes on after the last finished round. Gives the number of finished rounds.
    """
    queues, landed = f"{root}/queue", f"{root}/landed"
    done = writers.latest_version(spark, queues)
    if done is None:
        writers.write_version(queueing.default_sources(queue), queues, 0)
        done = 0
    current = writers.read_version(spark, queues, done)
    state = _list_digest(current)
    if done and state == _list_digest(writers.read_version(spark, queues, done - 1)):
        return done
    while done < rounds and (until is None or datetime.now() < until):
        cache = request
        for earlier in range(1, done + 1):
            cache = cache.unionByName(writers.read_batch(spark, landed, earlier), allowMissingColumns=True)
        following, rows = queueing.work_turn(current, cache, ask, min_abstract_length)
        done += 1
        writers.append_batch(rows, landed, done)
        writers.write_version(following, queues, done)
        current = writers.read_version(spark, queues, done)
        before, state = state, _list_digest(current)
        if state == before:
            break
    return done
