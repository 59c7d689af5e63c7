"""Selection, sampling, set and coverage reports."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.functions.ids import ID_COLUMNS
from vellum.operators.joins import first_per_key
from vellum.session import cut_lineage

# How much a source is trusted, by name; any other source has the last value.
SOURCE_RANK = {"WOS": 10, "SCOPUS": 8, "DIMENSIONS": 6, "PUBMED": 4}
OTHER_RANK = 1

# Parts over which a group's rows are spread when the group's size is looked up.
SALTS = 32


def source_rank(wrapper: Column) -> Column:
    """Rank of a cache row's source."""
    name = F.upper(wrapper)
    rank = F.when(F.lit(False), 0)
    for source, value in SOURCE_RANK.items():
        rank = rank.when(name == source, value)
    return rank.otherwise(OTHER_RANK)


def best_abstract(
    request: DataFrame,
    after: Column | None = None,
    before: Column | None = None,
    include_failed: bool = False,
) -> DataFrame:
    """One cached abstract per work not written yet: best source, then newest, then largest record id.

    Rows whose done flag is NULL are candidates; ``include_failed`` adds those where it is FALSE.
    """
    open_rows = F.col("solarized").isNull() | (~F.col("solarized") if include_failed else F.lit(False))
    rows = request.where(open_rows & F.col("abstract").isNotNull() & F.col("openalex_id").isNotNull())
    if before is not None:
        rows = rows.where(F.col("time_created") <= before)
    if after is not None:
        rows = rows.where(F.col("time_created") >= after)
    ranked = rows.select(
        "openalex_id",
        F.upper("wrapper").alias("abstract_source"),
        "abstract",
        "title",
        "time_created",
        source_rank(F.col("wrapper")).alias("source_rank"),
        "record_id",
    )
    return first_per_key(ranked, ["openalex_id"], ["source_rank", "time_created", "record_id"], last=True)


def complete_records(request: DataFrame, since: Column | None = None) -> DataFrame:
    """One cache row with id, title and abstract per work: the earliest."""
    rows = request.where(
        F.col("openalex_id").isNotNull() & F.col("abstract").isNotNull() & F.col("title").isNotNull()
    )
    if since is not None:
        rows = rows.where(F.col("time_created") >= since)
    return first_per_key(rows, ["openalex_id"], ["time_created", "record_id"])


def collapse_records(request: DataFrame, columns: Sequence[str]) -> DataFrame:
    """All cache rows of a work as one: per column the earliest value present. Rows without a work are left out."""
    order = F.struct("time_created", "record_id")
    return request.where(F.col("openalex_id").isNotNull()).groupBy("openalex_id").agg(
        *[F.min_by(F.col(c), F.when(F.col(c).isNotNull(), order)).alias(c) for c in columns]
    )


def with_group_count(df: DataFrame, key: str, name: str = "n") -> DataFrame:
    """The size of its group beside each row, by aggregate and lookup; a large group is not gathered."""
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(SALTS)).cast("int"))
    counts = df.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias(name))
    counts = counts.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.col("_salt") == F.col("_part"))
    return salted.join(counts, same).drop("_key", "_salt", "_part")


def source_coverage(request: DataFrame, since: Column | None = None) -> DataFrame:
    """Counts of cache rows by source: all, with abstract, with abstract but without catalogue id or DOI."""
    rows = request if since is None else request.where(F.col("time_created") >= since)
    has = F.col("abstract").isNotNull()
    groups = {
        "": F.lit(True),
        "_abs": has,
        "_no_oa": has & F.col("openalex_id").isNull(),
        "_no_doi": has & F.col("doi").isNull(),
    }
    return rows.agg(
        F.count(F.lit(1)).alias("n_total"),
        F.count_if(F.col("openalex_id").isNull()).alias("n_missing_oa_id"),
        *[
            F.count_if((F.col("wrapper") == source) & condition).alias(f"n_{source.lower()}{suffix}")
            for suffix, condition in groups.items()
            for source in ("DIMENSIONS", "SCOPUS", "PUBMED", "WOS")
        ],
    )


def unmatched_coverage(request: DataFrame, since: Column | None = None) -> DataFrame:
    """Counts of cache rows with an abstract by source, and of those without a catalogue id."""
    rows = request.where(F.col("abstract").isNotNull())
    rows = rows if since is None else rows.where(F.col("time_created") >= since)
    lost = F.col("openalex_id").isNull()
    sources = ("DIMENSIONS", "SCOPUS", "PUBMED", "WOS")
    return rows.agg(
        F.count(F.lit(1)).alias("n_total"),
        F.count_if(lost).alias("n_missing_oa_id"),
        *[F.count_if(F.col("wrapper") == s).alias(f"n_{s.lower()}") for s in sources],
        *[F.count_if((F.col("wrapper") == s) & lost).alias(f"n_{s.lower()}_no_oa") for s in sources],
    )


def stats_columns() -> list[Column]:
    """Counters of cache rows: all, with title, with abstract, answered by two of the sources."""
    answered = F.col("raw").isNotNull()
    return [
        F.count(F.lit(1)).alias("n_total"),
        F.count("title").alias("n_with_title"),
        F.count("abstract").alias("n_with_abstract"),
        F.count_if(answered & (F.lower("wrapper") == "scopus")).alias("n_with_scopus"),
        F.count_if(answered & (F.lower("wrapper") == "dimensions")).alias("n_with_dimensions"),
    ]


def daily_stats(request: DataFrame, limit: int | None = None) -> DataFrame:
    """Cache growth per day, latest days first; all of them, or the latest ``limit``."""
    day = F.date_trunc("day", "time_created").alias("day")
    days = request.groupBy(day).agg(*stats_columns()).orderBy(F.desc("day"))
    return days if limit is None else days.limit(limit)


def total_stats(request: DataFrame) -> DataFrame:
    """The same counters over the whole cache."""
    return request.agg(*stats_columns())


def completeness(df: DataFrame, flags: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Per column: how often a flag is true, or a value is present, and its share of all rows."""
    counted = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col(f)).alias(f) for f in flags],
        *[F.count(c).alias(c) for c in columns],
    )
    names = [*flags, *columns]
    pairs = ", ".join(f"'{n}', `{n}`" for n in names)
    return counted.selectExpr("n", f"stack({len(names)}, {pairs}) AS (field, n_present)").select(
        "field",
        "n_present",
        (F.col("n") - F.col("n_present")).alias("n_absent"),
        F.round(F.col("n_present") / F.col("n"), 6).alias("share"),
    )


def year_spine(spark: SparkSession, first: int, last: int) -> DataFrame:
    """Every year from first to last."""
    return spark.range(first, last + 1).select(F.col("id").cast("int").alias("year"))


def per_year(spark: SparkSession, works: DataFrame, first: int, last: int, counts: dict[str, Column]) -> DataFrame:
    """Counts per year, years without works included. Works are counted before they meet the years."""
    counted = works.groupBy(F.col("publication_year").alias("year")).agg(*[c.alias(n) for n, c in counts.items()])
    return year_spine(spark, first, last).join(counted, "year", "left").select(
        "year", *[F.coalesce(F.col(n), F.lit(0)).alias(n) for n in counts]
    )


def year_ratio(spark: SparkSession, sample: DataFrame, totals: DataFrame, first: int, last: int) -> DataFrame:
    """Histogram of a sample beside that of all works, with the share in percent."""
    counted = per_year(spark, sample, first, last, {"n_sample": F.count(F.lit(1))})
    everything = totals.groupBy(F.col("publication_year").alias("year")).agg(F.count(F.lit(1)).alias("n_total"))
    return counted.join(everything, "year", "left").select(
        "year",
        "n_sample",
        F.coalesce("n_total", F.lit(0)).alias("n_total"),
        F.round(F.col("n_sample") / F.col("n_total") * 100, 6).alias("ratio"),
    )


#: Hexadecimal digits that one step of the search for a bound looks at.
DIGITS = 4


def smallest_draws(drawn: DataFrame, draw: str, key: str, n: int) -> DataFrame:
    """The ``n`` rows with the smallest ``draw`` (hexadecimal text of one length), ties by ``key``, as a plain filter.

    The bound is found digit by digit: rows are counted by the next digits of those that share the digits known so far, at most
    16 ** DIGITS counts a step, until the rows up to a prefix are exactly ``n``. Rows with equal draws at the bound, repeats of one
    value, are the only ones ever sorted. The table is read once for each step, so it should be stored.
    """
    if n <= 0:
        return drawn.where(F.lit(False))
    length = drawn.agg(F.max(F.length(draw))).first()[0] or 0
    prefix, left = "", n
    while len(prefix) < length:
        width = min(length, len(prefix) + DIGITS)
        counts = (
            drawn.where(F.col(draw).startswith(prefix))
            .groupBy(F.substring(draw, 1, width).alias("p"))
            .agg(F.count(F.lit(1)).alias("n"))
        )
        for found, rows in sorted(tuple(r) for r in counts.collect()):
            if rows >= left:
                break
            left -= rows
        else:
            return drawn  # fewer than n rows in all
        prefix = found
        if rows == left:
            return drawn.where(F.substring(draw, 1, width) <= prefix)
    ties = drawn.where(F.col(draw) == prefix).orderBy(key).limit(left)
    return drawn.where(F.col(draw) < prefix).unionByName(ties)


def seeded_sample(df: DataFrame, key: str, n: int, seed: int | str) -> DataFrame:
    """``n`` distinct keys in the order of their draws, the same for the same seed however the table is partitioned.

    They are those with the smallest draws. No task holds n rows; the distinct keys are stored with their draws.
    """
    drawn = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    ids = df.select(key).where(F.col(key).isNotNull()).distinct().withColumn("_drawn", drawn)
    return smallest_draws(cut_lineage(ids, "draws"), "_drawn", key, n).orderBy("_drawn", key).drop("_drawn")


def pairwise_overlap(sets: dict[str, DataFrame]) -> DataFrame:
    """For every ordered pair of named id sets: sizes, union, intersection, and what only one of them has.

    Ids are reduced to one row of flags each; the pairs are sums over those rows.
    """
    names = list(sets)
    tagged = None
    for name, ids in sets.items():
        part = ids.select(F.col(ids.columns[0]).alias("id"), F.lit(name).alias("name"))
        tagged = part if tagged is None else tagged.unionByName(part)
    flags = tagged.groupBy("id").agg(*[F.max(F.col("name") == n).alias(f"in_{i}") for i, n in enumerate(names)])
    counted = []
    for i, j in permutations(range(len(names)), 2):
        a, b = F.col(f"in_{i}"), F.col(f"in_{j}")
        counted.append(
            F.struct(
                F.lit(names[i]).alias("left"),
                F.lit(names[j]).alias("right"),
                F.count_if(a).alias("n_left"),
                F.count_if(b).alias("n_right"),
                F.count_if(a | b).alias("n_union"),
                F.count_if(a & b).alias("n_intersect"),
                F.count_if(a & ~b).alias("n_left_only"),
                F.count_if(b & ~a).alias("n_right_only"),
            ).alias(f"p{i}_{j}")
        )
    return flags.agg(*counted).select(F.inline(F.array(*[f"p{i}_{j}" for i, j in permutations(range(len(names)), 2)])))


def venue_report(works: DataFrame, host_venues: DataFrame, venues: DataFrame) -> DataFrame:
    """Documents per venue: all, journal articles, other types, no type.

    Works are counted per venue id first; names are looked up for the counted venues only.
    """
    kind = F.col("type")
    counts = {
        "documents": F.count(F.lit(1)),
        "journal_documents": F.count_if(kind == "journal-article"),
        "other_documents": F.count_if(kind != "journal-article"),
        "no_type_documents": F.count_if(kind.isNull()),
    }
    per_venue = (
        works.join(host_venues, "work_id", "left").groupBy("venue_id").agg(*[c.alias(n) for n, c in counts.items()])
    )
    named = per_venue.join(venues, "venue_id", "left")
    keys = ("display_name", "publisher", "homepage_url")
    return named.groupBy(*keys).agg(*[F.sum(n).alias(n) for n in counts]).orderBy(F.desc("documents"), *keys)


def import_items(
    item: DataFrame, academic_item: DataFrame, request: DataFrame, min_length: int = 100, wrapper: str = "PROJECT"
) -> DataFrame:
    """Cache rows from project items with text and a catalogue id that have no cached abstract yet.

    ``meta`` is a map of text; its ``places`` entry is not taken over.
    """
    known = request.where(F.col("item_id").isNotNull() & F.col("abstract").isNotNull()).select("item_id").distinct()
    texts = item.where(F.col("text").isNotNull() & (F.length("text") > min_length))
    joined = texts.join(academic_item, "item_id").where(F.col("openalex_id").isNotNull())
    meta = F.map_filter("meta", lambda k, _: k != "places")
    raw = F.to_json(
        F.struct(meta.alias("meta"), F.col("project_id"), F.col("publication_year"))
    )
    return joined.join(known, "item_id", "left_anti").select(
        F.lit(wrapper).alias("wrapper"),
        "item_id",
        *[c for c in ID_COLUMNS if c != "item_id" and c in academic_item.columns],
        "title",
        F.col("text").alias("abstract"),
        raw.alias("raw"),
    )


def written_state(request: DataFrame) -> DataFrame:
    """Cache rows per source and done flag."""
    return request.groupBy("wrapper", "solarized").agg(F.count(F.lit(1)).alias("n"))


def queue_depth(queue: DataFrame) -> DataFrame:
    """Queue entries per number of sources left; entries without a list count apart."""
    left = F.when(F.col("sources").isNotNull(), F.size("sources")).alias("num_sources")
    return queue.groupBy(left).agg(F.count(F.lit(1)).alias("n"))


def frequencies(df: DataFrame, column: str, name: str = "num_works") -> DataFrame:
    """Rows per value, most frequent first."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias(name)).orderBy(F.desc(name), column)


def repairable(request: DataFrame, source: str | None = None) -> DataFrame:
    """Cache rows with a DOI but no catalogue id."""
    rows = request.where(F.col("doi").isNotNull() & F.col("openalex_id").isNull())
    return rows if source is None else rows.where(F.col("wrapper") == source)


def repair_worklist(request: DataFrame, source: str | None = None) -> DataFrame:
    """The same, newest first."""
    return repairable(request, source).orderBy(F.desc("time_created"), "record_id")


def without_doi(request: DataFrame, source: str) -> DataFrame:
    """Cache rows of a source that carry no DOI."""
    return request.where((F.col("wrapper") == source) & F.col("doi").isNull())


def missed_in(sample: DataFrame, infos: DataFrame, key: str, groups: Sequence[str]) -> DataFrame:
    """Per group, how many sampled rows there are and how many have no info row."""
    found = infos.select(F.col(key)).distinct().withColumn("_found", F.lit(True))
    return sample.join(found, key, "left").groupBy(*groups).agg(
        F.count(F.lit(1)).alias("n_sampled"), F.count_if(F.col("_found").isNull()).alias("n_missed")
    )


def fill_rate(df: DataFrame, column: str) -> DataFrame:
    """How many rows have the column, how many do not."""
    c = F.col(column)
    return df.agg(F.count(c).alias("filled"), F.count_if(c.isNull()).alias("empty"))


def date_range(works: DataFrame) -> DataFrame:
    """First and last day of creation and of update."""
    return works.agg(
        F.min("created_date").alias("first_created"),
        F.max("created_date").alias("last_created"),
        F.min("updated_date").alias("first_updated"),
        F.max("updated_date").alias("last_updated"),
    )
