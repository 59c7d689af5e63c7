"""The gap-filling queue as table transforms: queue, cache and responses in, next queue and cache out."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.functions.ids import ID_COLUMNS, clean_doi
from vellum.functions.text import at_least
from vellum.operators.joins import first_per_key, numbered, with_keys
from vellum.operators.matching import complete_ids, count_matches, fold_matches, semi_match, shared_ids
from vellum.session import cut_lineage

# Priority of a source in a queue entry.
SOURCE_FORCE, SOURCE_TRY = 1, 2

# What to do when the cache already has rows for a queued work.
CONFLICT_FORCE, CONFLICT_DO_NOTHING, CONFLICT_RETRY_ABSTRACT, CONFLICT_RETRY_RAW = 1, 2, 3, 4

# Sources of an entry that names none, and of works queued from an id list.
DEFAULT_SOURCES = (("DIMENSIONS", SOURCE_TRY), ("SCOPUS", SOURCE_TRY))
GAP_SOURCES = tuple((s, SOURCE_TRY) for s in ("DIMENSIONS", "SCOPUS", "PUBMED", "WOS"))

SOURCES_TYPE = "ARRAY<STRUCT<source: STRING, priority: INT>>"

COUNTERS = ("request", "abstract", "title", "raw")


def sources_of(pairs: Sequence[tuple[str, int]]) -> Column:
    """An ordered list of (source, priority)."""
    return F.array(*[F.struct(F.lit(s).alias("source"), F.lit(p).alias("priority")) for s, p in pairs])


def parse_sources(text: Column) -> Column:
    """``[["SCOPUS", 2], ...]`` as a list of (source, priority)."""
    pairs = F.from_json(text, "ARRAY<ARRAY<STRING>>")
    return F.transform(
        pairs, lambda p: F.struct(p[0].alias("source"), p[1].cast("int").alias("priority"))
    )


def format_sources(sources: Column) -> Column:
    """The list back as JSON text."""
    parts = F.transform(sources, lambda s: F.concat(F.lit('["'), s["source"], F.lit('",'), s["priority"], F.lit("]")))
    return F.concat(F.lit("["), F.array_join(parts, ","), F.lit("]"))


def capped(df: DataFrame, limit: int, order: Sequence[str]) -> DataFrame:
    """Fail-safe for queueing: the first ``limit`` rows in ``order``. A caller's choice, never a default."""
    if limit < 0:
        raise ValueError(f"a limit cannot be {limit}")
    return df.orderBy(*order).limit(limit)


#: Fixed value: more than so many entries are not queued at one go.
MOST_QUEUED = 100_000


def at_most(rows: DataFrame, most: int = MOST_QUEUED) -> DataFrame:
    """The rows, if there are no more than ``most``; otherwise an error, before anything is written.

    At most ``most`` + 1 rows are counted.
    """
    if rows.limit(most + 1).count() > most:
        raise ValueError(f"more than {most} rows")
    return rows


def lacking_abstract(index: DataFrame, ids: DataFrame, id_col: str = "openalex_id") -> DataFrame:
    """Documents among the given ids that have no abstract."""
    return index.where(F.col("abstract").isNull()).join(ids, F.col("id") == F.col(id_col), "left_semi")


def known_ids(request: DataFrame, queue: DataFrame) -> DataFrame:
    """Ids with a cached abstract, and ids queued already."""
    cached = request.where(F.col("abstract").isNotNull()).select("openalex_id")
    return cached.unionByName(queue.select("openalex_id")).where(F.col("openalex_id").isNotNull()).distinct()


def enqueue(
    candidates: DataFrame,
    request: DataFrame,
    queue: DataFrame,
    now: Column,
    sources: Sequence[tuple[str, int]] | None = None,
    on_conflict: int = CONFLICT_DO_NOTHING,
    need_doi: bool = False,
) -> DataFrame:
    """New queue rows (still without queue_id) for candidates (openalex_id, doi, pubmed_id) nobody knows yet."""
    fresh = candidates.join(known_ids(request, queue), "openalex_id", "left_anti")
    if need_doi:
        fresh = fresh.where(F.col("doi").isNotNull())
    fresh = first_per_key(fresh.select("openalex_id", "doi", "pubmed_id"), ["openalex_id"], ["doi", "pubmed_id"])
    listed = F.lit(None).cast(SOURCES_TYPE) if sources is None else sources_of(sources)
    return fresh.select(
        "openalex_id",
        "doi",
        "pubmed_id",
        listed.alias("sources"),
        F.lit(on_conflict).alias("on_conflict"),
        now.alias("time_created"),
    )


def number_entries(entries: DataFrame, queue: DataFrame) -> DataFrame:
    """Give new entries ids above those in use, and store them: later reads all see the same ids."""
    last = queue.agg(F.coalesce(F.max("queue_id"), F.lit(0))).first()[0]
    return cut_lineage(entries.withColumn("queue_id", F.monotonically_increasing_id() + F.lit(last + 1)), "entries")


def default_sources(queue: DataFrame) -> DataFrame:
    """Entries without sources get the default ones."""
    return queue.withColumn("sources", F.coalesce("sources", sources_of(DEFAULT_SOURCES)))


def pending(
    queue: DataFrame,
    source: str,
    limit: int,
    oldest_first: bool = True,
    created_after: Column | None = None,
    created_before: Column | None = None,
) -> DataFrame:
    """The oldest (or newest) ``limit`` entries whose next source is ``source``. Taken before any join."""
    rows = queue.where(F.get("sources", F.lit(0))["source"] == source)
    if created_before is not None:
        rows = rows.where(F.col("time_created") <= created_before)
    if created_after is not None:
        rows = rows.where(F.col("time_created") >= created_after)
    by = F.asc if oldest_first else F.desc
    return rows.orderBy(by("time_created"), "queue_id").limit(limit)


def with_counts(entries: DataFrame, request: DataFrame, source: str | None = None) -> DataFrame:
    """Entries with eight counters of their cache rows: all, and those from the entry's source.

    ``source`` is the source whose turn it is; None takes each entry's own next source.
    """
    present = {
        "request": F.col("record_id").isNotNull(),
        "abstract": F.col("abstract").isNotNull(),
        "title": F.col("title").isNotNull(),
        "raw": F.col("raw").isNotNull(),
    }
    head = F.get("sources", F.lit(0))
    asked = head["source"] if source is None else F.lit(source)
    counts = count_matches(entries, request, "queue_id", present, own=(asked, F.col("wrapper")))
    names = {n: f"num_has_{n}" for n in COUNTERS} | {f"{n}_own": f"num_has_source_{n}" for n in COUNTERS}
    counts = counts.select("queue_id", *[F.col(n).alias(to) for n, to in names.items()])
    return entries.join(counts, "queue_id", "left").select(
        *[F.col(c) for c in entries.columns],
        head["source"].alias("source"),
        head["priority"].alias("priority"),
        *[F.coalesce(F.col(n), F.lit(0)).cast("long").alias(n) for n in names.values()],
    )


def with_presence(entries: DataFrame, request: DataFrame) -> DataFrame:
    """Entries with what eligibility asks about their cache rows: any abstract, and a row and a payload of their own next source.

    Existence needs no counting: each identifier value keeps the sources that have a row or a payload for it, a handful, and an entry
    looks its values up. This is linear in the identifiers of both tables.
    """
    head = F.get("sources", F.lit(0))
    kinds = shared_ids(entries, request)
    rows = request.select(*kinds, "wrapper", F.col("abstract").isNotNull().alias("text"), F.col("raw").isNotNull().alias("payload"))
    found = fold_matches(
        entries, rows, "queue_id",
        {"text": F.max("text"), "rows": F.collect_set("wrapper"), "payloads": F.collect_set(F.when(F.col("payload"), F.col("wrapper")))},
        {"text": F.max("text"), "rows": F.flatten(F.collect_list("rows")), "payloads": F.flatten(F.collect_list("payloads"))},
        kinds,
    )

    def holds(sources: str) -> Column:
        return F.coalesce(F.array_contains(sources, F.col("source")), F.lit(False))

    known = entries.withColumns({"source": head["source"], "priority": head["priority"]}).join(found, "queue_id", "left")
    return known.select(
        *entries.columns, "source", "priority", F.coalesce("text", F.lit(False)).alias("has_abstract"),
        holds("rows").alias("has_source_request"), holds("payloads").alias("has_source_raw"),
    )


def is_eligible(counted: bool = True) -> Column:
    """Whether an entry is to be asked for now, by its counters or, not ``counted``, by what ``with_presence`` found."""
    policy = F.col("on_conflict")

    def none(name: str) -> Column:
        return F.col(f"num_has_{name}") == 0 if counted else ~F.col(f"has_{name}")

    return (
        (F.col("priority") == SOURCE_FORCE)
        | (policy == CONFLICT_FORCE)
        | ((policy == CONFLICT_RETRY_ABSTRACT) & none("abstract"))
        | ((policy == CONFLICT_RETRY_RAW) & none("source_raw"))
        | ((policy == CONFLICT_DO_NOTHING) & none("source_request"))
    )


def _listed(values: Column, form) -> Column:
    return F.transform(F.array_sort(values), form)


def _quoted(v: Column) -> Column:
    return F.concat(F.lit('"'), v, F.lit('"'))


def _bracketed(name: str, values: Column, separator: str, opening: str, closing: str, form) -> Column:
    return F.when(
        F.size(values) > 0,
        F.concat(F.lit(name + opening), F.array_join(_listed(values, form), separator), F.lit(closing)),
    )


def _lookup_clause(source: str) -> tuple[tuple[str, ...], Column]:
    """(identifier kinds a source understands, the clause for one batch of them)."""
    def plain(v: Column) -> Column:
        return v

    def wrapped(before: str, after: str):
        return lambda v: F.concat(F.lit(before), v, F.lit(after))

    dois, pmids = F.col("doi"), F.col("pubmed_id")
    if source == "SCOPUS":
        parts = F.concat(
            _listed(F.col("scopus_id"), wrapped("EID(", ")")), _listed(dois, wrapped('DOI("', '")'))
        )
        return ("scopus_id", "doi"), F.array_join(parts, " OR ")
    if source == "PUBMED":
        parts = F.concat(_listed(pmids, wrapped('"', '"[PMID]')), _listed(dois, wrapped('"', '"[DOI]')))
        return ("pubmed_id", "doi"), F.array_join(parts, " OR ")
    if source == "WOS":
        return ("doi", "pubmed_id", "wos_id"), F.concat_ws(
            " OR ",
            _bracketed("DO", dois, " OR ", "=(", ")", _quoted),
            _bracketed("PMID", pmids, " OR ", "=(", ")", plain),
            _bracketed("UT", F.col("wos_id"), " OR ", "=(", ")", plain),
        )
    if source == "DIMENSIONS":
        return ("doi", "dimensions_id", "pubmed_id"), F.concat_ws(
            " or ",
            _bracketed("doi", dois, ",", " in [", "]", _quoted),
            _bracketed("id", F.col("dimensions_id"), ",", " in [", "]", _quoted),
            _bracketed("pmid", pmids, ",", " in [", "]", _quoted),
        )
    raise ValueError(f"unknown source {source}")


def lookup_batches(entries: DataFrame, source: str, size: int) -> DataFrame:
    """Lookup clauses for all entries, at most ``size`` entries each, oldest first.

    Entries are numbered in the order of the whole queue (``numbered``) and cut by ``size``. Entries without an
    identifier the source knows are left out.
    """
    kinds, clause = _lookup_clause(source)
    held = [k for k in kinds if k in entries.columns]
    known = F.coalesce(*[F.col(k) for k in held]).isNotNull()
    rows = entries.where(known).select(
        "queue_id",
        "time_created",
        *[
            (clean_doi(F.col(k)) if k == "doi" else F.col(k).cast("string")).alias(k)
            if k in held
            else F.lit(None).cast("string").alias(k)
            for k in kinds
        ],
    )
    placed = numbered(rows, ["time_created", "queue_id"])
    batched = placed.withColumn("batch", F.floor(F.col("place") / size).cast("long"))
    # collect_set of at most ``size`` values each
    grouped = batched.groupBy("batch").agg(
        F.count(F.lit(1)).alias("n_entries"), *[F.collect_set(k).alias(k) for k in kinds]
    )
    return grouped.select(F.lit(source).alias("source"), "batch", "n_entries", clause.alias("clause"))


def land(
    responses: DataFrame,
    queued: DataFrame,
    id_cols: Sequence[str] = ID_COLUMNS,
    min_abstract_length: int = 25,
) -> DataFrame:
    """Responses as cache rows: identifiers completed from the queued rows, too short abstracts removed."""
    kinds = [c for c in id_cols if c in responses.columns and c in queued.columns]
    rows = responses if "queue_id" in responses.columns else responses.withColumn(
        "queue_id", F.lit(None).cast(queued.schema["queue_id"].dataType)
    )
    completed = complete_ids(rows, queued, [*kinds, "queue_id"])
    return completed.withColumn("abstract", at_least(F.col("abstract"), min_abstract_length))


def record_misses(
    references: DataFrame, answers: DataFrame, key: str, source: str, now: Column, id_cols: Sequence[str] | None = None
) -> DataFrame:
    """Cache rows with identifiers only, for references no answer matches."""
    kinds = shared_ids(references, answers, id_cols)
    missed = references.join(semi_match(references, answers, key, kinds), key, "left_anti")
    return missed.select(
        F.lit(source).alias("wrapper"), *kinds, F.lit(None).cast("string").alias("title"),
        F.lit(None).cast("string").alias("abstract"), F.lit(None).cast("string").alias("raw"),
        now.alias("time_created"),
    )


def without_source(sources: Column, source: str | Column) -> Column:
    """The list less one source."""
    return F.filter(sources, lambda s: s["source"] != source)


def forced_only(sources: Column) -> Column:
    """The sources that are asked whatever others found."""
    return F.filter(sources, lambda s: s["priority"] == SOURCE_FORCE)


def advance(asked: DataFrame, found: DataFrame, source: str | Column) -> DataFrame:
    """(queue_id, sources) of the entries just worked on: forced sources only where an abstract was found,
    otherwise all sources but this one."""
    hits = found.select("queue_id").distinct().withColumn("_found", F.lit(True))
    joined = asked.join(hits, "queue_id", "left")
    following = F.when(F.col("_found"), forced_only(F.col("sources"))).otherwise(
        without_source(F.col("sources"), source)
    )
    return joined.select("queue_id", following.alias("sources"))


def apply_changes(queue: DataFrame, changes: DataFrame) -> DataFrame:
    """The queue with new source lists, without the entries that have none left."""
    staged = changes.select("queue_id", F.col("sources").alias("_sources"))
    joined = queue.join(staged, "queue_id", "left")
    return drop_finished(joined.withColumn("sources", F.coalesce("_sources", "sources")).select(*queue.columns))


def drop_finished(queue: DataFrame) -> DataFrame:
    """Entries with an empty source list go; those without a list yet stay."""
    return queue.where(F.col("sources").isNull() | (F.size("sources") > 0))


def drop_queued(queue: DataFrame, ids: DataFrame) -> DataFrame:
    """The queue without the given queue_ids."""
    return queue.join(ids.select("queue_id"), "queue_id", "left_anti")


def drop_created_after(queue: DataFrame, moment: Column) -> DataFrame:
    """Take back what was queued after a moment."""
    return queue.where(F.col("time_created") <= moment)


def _by_source(df: DataFrame, source: Column, kinds: Sequence[str]) -> DataFrame:
    """Identifiers with the source in front, so that rows of different sources never match."""
    return df.withColumns({k: F.concat(source, F.lit("|"), F.col(k).cast("string")) for k in kinds})


def work_turn(
    queue: DataFrame,
    request: DataFrame,
    responses: DataFrame | Callable[[DataFrame], DataFrame],
    min_abstract_length: int = 25,
) -> tuple[DataFrame, DataFrame]:
    """One turn of every entry at its next source. Gives the next queue and the cache rows to append.

    All sources and all entries are worked at once: the eligible entries are asked, ``responses`` holds what the sources
    answer, or is called with the entries asked and gives that, answers match entries of their own source on any identifier,
    and every entry's list moves on. ``jobs.work_rounds`` stores both results and goes on with the next turn.
    """
    head = F.get("sources", F.lit(0))["source"]
    base = default_sources(queue)
    waiting = base.where(F.size("sources") > 0)
    asked = with_presence(waiting, request).where(is_eligible(counted=False)).select(*waiting.columns)
    asked = cut_lineage(asked, "asked")
    responses = responses(asked) if callable(responses) else responses
    kinds = [c for c in shared_ids(responses, asked) if c != "queue_id"]
    offered = _by_source(responses, F.col("wrapper"), kinds)
    own = _by_source(asked, head, kinds)
    # sources may offer far more than was asked for: identifiers tell which of it answers, and only that is shuffled
    answering = cut_lineage(semi_match(offered, own, "record_id", kinds), "answering")
    answers = with_keys(offered, answering, "record_id", answering.count())
    landed = land(answers, own, min_abstract_length=min_abstract_length)
    bare = {k: F.substring(F.col(k), F.length("wrapper") + 2, F.length(k)) for k in kinds}
    landed = cut_lineage(landed.withColumns(bare), "landed")
    found = landed.where(F.col("abstract").isNotNull() & F.col("queue_id").isNotNull())
    return drop_finished(apply_changes(base, advance(waiting, found, head))), landed
