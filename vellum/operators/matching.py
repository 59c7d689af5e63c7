"""Matching records on any of several identifier kinds.

Every job here first turns the identifiers of a row into (id_type, id_value) rows and joins those on equality.
What is needed from the other side is aggregated per identifier value *before* the join, so a value shared by a
large part of both tables (a placeholder DOI) costs one row on one side and never a product of the two groups.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.functions.ids import ID_COLUMNS, doi_key, strip_url
from vellum.operators.joins import left_lookup
from vellum.session import cut_lineage


def shared_ids(left: DataFrame, right: DataFrame, id_cols: Sequence[str] | None = None) -> list[str]:
    """The identifier kinds both tables have, in matching order."""
    return [c for c in (id_cols or ID_COLUMNS) if c in left.columns and c in right.columns]


def id_rows(df: DataFrame, id_cols: Sequence[str], *keep: str | Column) -> DataFrame:
    """One row per non-null identifier: ``keep`` columns, id_type, id_value."""
    entries = F.array(
        *[F.struct(F.lit(c).alias("id_type"), F.col(c).cast("string").alias("id_value")) for c in id_cols]
    )
    return df.select(*keep, F.inline(F.filter(entries, lambda e: e["id_value"].isNotNull())))


def semi_match(left: DataFrame, right: DataFrame, key: str, id_cols: Sequence[str] | None = None) -> DataFrame:
    """Keys of the ``left`` rows that share at least one identifier with ``right``, each once."""
    kinds = shared_ids(left, right, id_cols)
    known = id_rows(right, kinds).distinct()
    return id_rows(left, kinds, key).join(known, ["id_type", "id_value"], "left_semi").select(key).distinct()


def lookup_records(references: DataFrame, request: DataFrame, id_cols: Sequence[str] | None = None) -> DataFrame:
    """Cache rows that share any identifier with any reference, each once and all of them."""
    return request.join(semi_match(request, references, "record_id", id_cols), "record_id", "left_semi")


def fold_matches(
    left: DataFrame,
    right: DataFrame,
    key: str,
    facts: dict[str, Column],
    merge: dict[str, Column],
    id_cols: Sequence[str] | None = None,
) -> DataFrame:
    """Per ``left`` key, facts about the matching ``right`` rows.

    ``facts`` are aggregates over right rows of one identifier value, ``merge`` aggregates them over the
    identifiers of one left row. A pair that agrees on several identifiers is met more than once, so only
    aggregates that do not mind (min, max, any) belong here. Keys without a match are absent.
    """
    kinds = shared_ids(left, right, id_cols)
    needed = [c for c in right.columns if c not in ("id_type", "id_value")]
    per_value = (
        id_rows(right, kinds, *needed)
        .groupBy("id_type", "id_value")
        .agg(*[c.alias(name) for name, c in facts.items()])
    )
    return (
        id_rows(left, kinds, key)
        .join(per_value, ["id_type", "id_value"])
        .groupBy(key)
        .agg(*[c.alias(name) for name, c in merge.items()])
    )


def _subset_keys(df: DataFrame, kinds: Sequence[str], *keep: str) -> DataFrame:
    """One row per non-empty subset of a row's identifiers: ``keep``, subset_key, sign.

    ``sign`` is +1 for an odd number of identifiers and -1 for an even one.
    """
    # lengths make the joined text unambiguous whatever the identifiers contain
    entries = F.array(
        *[
            F.when(
                F.col(c).isNotNull(),
                F.concat(F.lit(f"{i}:"), F.length(F.col(c).cast("string")), F.lit(":"), F.col(c).cast("string")),
            )
            for i, c in enumerate(kinds)
        ]
    )
    some = F.coalesce(*[F.col(c).cast("string") for c in kinds]).isNotNull()
    rows = df.where(some).select(*keep, F.filter(entries, lambda e: e.isNotNull()).alias("_ids"))
    masks = F.expr("sequence(1, shiftleft(1, size(_ids)) - 1)")
    rows = rows.withColumn("_mask", F.explode(masks))
    return rows.select(
        *keep,
        F.expr("array_join(filter(_ids, (e, i) -> (shiftright(_mask, i) & 1) = 1), '|')").alias("subset_key"),
        F.expr("IF(bit_count(_mask) % 2 = 1, 1, -1)").alias("sign"),
    )


def count_matches(
    left: DataFrame,
    right: DataFrame,
    key: str,
    conditions: dict[str, Column],
    id_cols: Sequence[str] | None = None,
    right_key: str = "record_id",
    own: tuple[Column, Column] | None = None,
) -> DataFrame:
    """Per ``left`` key, how many distinct ``right`` rows match on any identifier, by condition.

    Inclusion-exclusion: a right row that agrees on a set A of identifiers is counted once, because the signed
    number of non-empty subsets of A is one. So it is enough to count right rows per identifier subset (partly
    aggregated before the shuffle) and to add the counts up with their signs. The work is linear in both tables
    for a fixed number of identifier kinds, also when one identifier value fills a third of each of them; no
    pair of rows is ever formed. Keys without a match are absent.

    Only right rows that share an identifier with the left table are given subsets; the others are never expanded.

    ``own`` is a pair of columns, one of the left and one of the right table: counters named ``<name>_own`` then count
    the matching rows in which they are equal, from the same expansion.
    """
    kinds = shared_ids(left, right, id_cols)
    flags = [F.coalesce(c, F.lit(False)).cast("int").alias(name) for name, c in conditions.items()]
    mark = (own[1] if own else F.lit(None)).cast("string").alias("_mark")
    rows = right.select(F.col(right_key).alias("_row"), *kinds, *flags, mark)
    near = rows.join(semi_match(rows, left, "_row", kinds), "_row", "left_semi")
    counted = (
        _subset_keys(near, kinds, "_mark", *conditions)
        .groupBy("subset_key", "_mark")
        .agg(*[F.sum(n).alias(n) for n in conditions])
    )
    wanted = left.withColumn("_wanted", (own[0] if own else F.lit(None)).cast("string"))
    signed = {n: F.col("sign") * F.col(n) for n in conditions}
    sums = [F.sum(c).alias(n) for n, c in signed.items()]
    if own:
        same = F.col("_mark") == F.col("_wanted")
        sums += [F.sum(F.when(same, c).otherwise(0)).alias(f"{n}_own") for n, c in signed.items()]
    return _subset_keys(wanted, kinds, key, "_wanted").join(counted, "subset_key").groupBy(key).agg(*sums)


def complete_ids(
    responses: DataFrame,
    queue: DataFrame,
    id_cols: Sequence[str],
    order: Sequence[str] = ("time_created", "queue_id"),
    key: str = "record_id",
) -> DataFrame:
    """Fill missing identifiers of a response from the queued rows it matches.

    Identifier kinds are tried in the given order. At each step the queued rows with the same value are taken in
    ``order`` and the first value present fills what is still missing, including kinds used by later steps. The
    queued rows of a value are reduced to one row first, so each step is a join with at most one partner. Only
    identifiers go through the steps; texts and payloads join the result once, by ``key``.
    """
    completed = responses.select(key, *id_cols)
    for kind in id_cols:
        others = [c for c in id_cols if c != kind]
        donors = (
            queue.where(F.col(kind).isNotNull())
            .groupBy(F.col(kind).alias("_value"))
            .agg(
                *[
                    F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.struct(*order))).alias(f"_{c}")
                    for c in others
                ]
            )
        )
        completed = left_lookup(completed, donors, kind, "_value", [key]).select(
            *[
                F.coalesce(F.col(c), F.col(f"_{c}")).alias(c) if c in others else F.col(c)
                for c in completed.columns
            ]
        )
    others = [c for c in responses.columns if c not in id_cols]
    if others == [key]:
        return completed.select(*responses.columns)
    return responses.select(*others).join(completed, key).select(*responses.columns)


def skip_existing(
    references: DataFrame, request: DataFrame, key: str, source: str, kinds: Sequence[str], null_equal: bool = False
) -> DataFrame:
    """References of which no row of ``source`` shares a value in any of ``kinds``.

    With ``null_equal`` a missing identifier on both sides counts as shared.
    """
    answered = request.where(F.col("wrapper") == source)
    if null_equal:
        def fill(df: DataFrame) -> DataFrame:
            return df.select(
                *[c for c in df.columns if c not in kinds],
                *[F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null")).alias(c) for c in kinds],
            )

        known = semi_match(fill(references), fill(answered), key, kinds)
    else:
        known = semi_match(references, answered, key, kinds)
    return references.join(known, key, "left_anti")


def repair_ids(request: DataFrame, catalogue: DataFrame, reference_ids: DataFrame) -> DataFrame:
    """Cache rows with a DOI but no catalogue id, given the id the catalogue has for that DOI.

    Only ids in ``reference_ids`` count, since a DOI may belong to several works; of several, the largest id
    is used.
    """
    wanted = reference_ids.select(F.upper("openalex_id").alias("_id")).distinct()
    known = (
        catalogue.where(F.col("doi").isNotNull())
        .select(doi_key(F.col("doi")).alias("_key"), F.upper(strip_url(F.col("id"))).alias("_id"))
        .join(wanted, "_id", "left_semi")
        .groupBy("_key")
        .agg(F.max("_id").alias("_id"))
    )
    broken = F.col("openalex_id").isNull() & F.col("doi").isNotNull()
    # the rows that need no repair, texts and all, stay out of the join
    repaired = request.where(broken).withColumn("_key", F.lower("doi")).join(known, "_key", "left")
    repaired = repaired.withColumn("openalex_id", F.col("_id")).select(*request.columns)
    return request.where(~broken).unionByName(repaired)


def lookup_status(
    references: DataFrame,
    request: DataFrame,
    key: str,
    empty_abstract_as_missing: bool = False,
    fetch_on_missing_entry: bool = False,
    id_cols: Sequence[str] | None = None,
) -> DataFrame:
    """Each reference with hit/missed/queued flags and the earliest cache row that answers it."""
    kinds = shared_ids(references, request, id_cols)
    first = F.struct("time_created", "record_id")
    answers = F.col("abstract").isNotNull() if empty_abstract_as_missing else F.lit(True)
    # flags before the identifiers are unpivoted, so that no text is carried along
    rows = request.select(*kinds, first.alias("row"), answers.alias("answers"))
    found = fold_matches(
        references,
        rows,
        key,
        {"hit_row": F.min(F.when(F.col("answers"), F.col("row"))), "any_row": F.min("row")},
        {"hit_row": F.min("hit_row"), "any_row": F.min("any_row")},
        kinds,
    )
    status = references.join(found, key, "left")
    hit = F.col("hit_row").isNotNull()
    return status.select(
        *[F.col(c) for c in references.columns],
        hit.alias("hit"),
        (~hit).alias("missed"),
        (~hit if fetch_on_missing_entry else F.lit(False)).alias("queued"),
        F.coalesce("hit_row.record_id", "any_row.record_id").alias("record_id"),
    )


def lookup_summary(status: DataFrame, added: Column | None = None) -> DataFrame:
    """Numbers of hits, queued, missed and added references."""
    return status.agg(
        *[F.sum(F.col(flag).cast("long")).alias(f"n_{flag}") for flag in ("hit", "queued", "missed")],
        F.sum((added if added is not None else F.lit(False)).cast("long")).alias("n_added"),
    )


def cascade(
    references: DataFrame,
    request: DataFrame,
    key: str,
    source_order: Sequence[str],
    id_cols: Sequence[str] | None = None,
) -> DataFrame:
    """Ask the sources in turn: each reference gets the abstract of the first source that has one.

    One pass instead of a chain of anti joins: the best (source place, time, record) per identifier value, then
    per reference. References nobody answers keep NULLs.
    """
    place = F.coalesce(*[F.when(F.col("wrapper") == s, F.lit(i)) for i, s in enumerate(source_order)])
    kinds = shared_ids(references, request, id_cols)
    usable = request.withColumn("_place", place).where(F.col("_place").isNotNull() & F.col("abstract").isNotNull())
    rows = usable.select(*kinds, F.struct("_place", "time_created", "record_id").alias("row"))
    found = fold_matches(references, rows, key, {"best": F.min("row")}, {"best": F.min("best")}, kinds)
    picked = references.join(found, key, "left").withColumn("record_id", F.col("best.record_id")).drop("best")
    texts = request.select(F.col("record_id").alias("_record"), F.col("wrapper").alias("answered_by"), "abstract")
    return left_lookup(picked, texts, "record_id", "_record", [key])


def merge_any_id(
    existing: DataFrame,
    incoming: DataFrame,
    incoming_key: str,
    order: Sequence[str],
    id_cols: Sequence[str] | None = None,
) -> DataFrame:
    """Existing rows take the non-null fields of incoming rows they share an identifier with; others are added.

    ``order`` (ending in a unique column) says which incoming row wins a field: the last one. Incoming rows are
    matched against the table as it was before the batch.
    """
    kinds = shared_ids(existing, incoming, id_cols)
    return _merge_places(existing, incoming, _places(existing, incoming, incoming_key, order, kinds), incoming_key, order, kinds)


def _fields(existing: DataFrame, incoming: DataFrame, kinds: Sequence[str]) -> tuple[list[str], list[str]]:
    """The fields that incoming rows give to existing ones: identifiers, others."""
    fields = [c for c in incoming.columns if c in existing.columns and c != "record_id"]
    return [c for c in fields if c in kinds], [c for c in fields if c not in kinds]


def _places(existing: DataFrame, incoming: DataFrame, key: str, order: Sequence[str], kinds: Sequence[str]) -> DataFrame:
    """Incoming rows without texts: identifiers, order, and for each other field where its value stands (``_at_``), if there is one."""
    place = F.struct(*[F.col(o).alias(f"o{i}") for i, o in enumerate(order)], F.col(key).alias("key"))
    kept = [c for c in incoming.columns if c in {key, "record_id", *order, *kinds}]
    _, others = _fields(existing, incoming, kinds)
    return incoming.select(*kept, *[F.when(F.col(c).isNotNull(), place).alias(f"_at_{c}") for c in others])


def _merge_places(
    existing: DataFrame, incoming: DataFrame, places: DataFrame, key: str, order: Sequence[str], kinds: Sequence[str]
) -> DataFrame:
    """``merge_any_id`` of rows of which ``places`` says where in ``incoming`` their values stand; each value is fetched once, at the end."""
    ids, others = _fields(existing, incoming, kinds)
    rows = cut_lineage(places.withColumn("_row", F.monotonically_increasing_id()), "places")
    place = F.struct(*[F.col(o).alias(f"o{i}") for i, o in enumerate(order)], F.col(key).alias("key"))
    won = [F.when(F.col(c).isNotNull(), F.struct(place.alias("place"), F.col(c).alias("value"))).alias(f"_{c}") for c in ids]
    won += [F.when(F.col(f"_at_{c}").isNotNull(), F.struct(place.alias("place"), F.col(f"_at_{c}").alias("value"))).alias(f"_{c}") for c in others]
    latest = {f"_{c}": F.max(f"_{c}") for c in [*ids, *others]}
    winners = fold_matches(existing.select("record_id", *kinds), rows.select(*kinds, *won), "record_id", latest, latest, kinds)
    added = rows.join(semi_match(rows, existing, key, kinds), key, "left_anti")
    # rows of the result by their number or, if they exist, their id
    old, new = (F.concat(F.lit(mark), F.col(c).cast("string")).alias("_out") for mark, c in (("=", "record_id"), ("+", "_row")))
    found = winners.select(old, *[F.col(f"_{c}.value").alias(f"n_{c}") for c in ids], *[F.col(f"_{c}.value").alias(f"_at_{c}") for c in others])
    found = cut_lineage(found.unionByName(added.select(new, *[f"_at_{c}" for c in others]), allowMissingColumns=True), "found")
    keys = F.array_distinct(F.array_compact(F.array(*[F.col(f"_at_{c}.key") for c in others])))
    gains = found.select("_out", *[f"n_{c}" for c in ids])
    if others:
        wanted = found.select("_out", F.explode(keys).alias("_key"), *[f"_at_{c}" for c in others])
        own = F.struct(*[F.col(o).alias(f"o{i}") for i, o in enumerate(order)], F.col(key).alias("key")).alias("_own")
        offered = incoming.select(F.col(key).alias("_from"), own, *[F.col(c).alias(f"v_{c}") for c in others])
        fetched = wanted.join(offered, F.col("_key") == F.col("_from")).where(
            reduce(or_, [F.col(f"_at_{c}").eqNullSafe(F.col("_own")) for c in others])
        )
        values = [F.when(F.col(f"_at_{c}").eqNullSafe(F.col("_own")), F.col(f"v_{c}")).alias(f"n_{c}") for c in others]
        gains = gains.unionByName(fetched.select("_out", *values), allowMissingColumns=True)
    news = gains.groupBy("_out").agg(*[F.max(f"n_{c}").alias(f"n_{c}") for c in [*ids, *others]])
    taken = [c for c in added.columns if c in existing.columns and (c in ids or c == "record_id")]
    rows_out = existing.withColumn("_out", old).unionByName(added.select(new, *taken), allowMissingColumns=True)
    return rows_out.join(news, "_out", "left").select(
        *[F.coalesce(F.col(f"n_{c}"), F.col(c)).alias(c) if c in ids or c in others else F.col(c) for c in existing.columns]
    )


def collapse_linked(rows: DataFrame, key: str, order: Sequence[str], id_cols: Sequence[str]) -> DataFrame:
    """One row for all rows that are linked by shared identifiers, directly or over other rows.

    Every field has the last non-null value in ``order`` (ending in a unique column), the key is that of the first row.
    Rows that share no identifier stay as they are and are neither aggregated nor sent along.
    """
    from vellum.operators.components import shared_value_components

    linked = cut_lineage(shared_value_components(rows, key, id_cols), "linked")
    alone = rows.join(linked.select(F.col("node").alias(key)), key, "left_anti")
    place = F.struct(*order)
    fields = [c for c in rows.columns if c != key]
    grouped = (
        rows.join(linked.withColumnRenamed("node", key), key)
        .groupBy("root")
        .agg(
            F.min_by(key, place).alias(key),
            *[F.max_by(c, F.when(F.col(c).isNotNull(), place)).alias(c) for c in fields],
        )
    )
    return alone.unionByName(grouped.select(*rows.columns))


def merge_batch(
    existing: DataFrame, incoming: DataFrame, incoming_key: str, order: Sequence[str], id_cols: Sequence[str] | None = None
) -> DataFrame:
    """``merge_any_id`` of a batch whose rows may share identifiers with each other.

    Rows of the batch that are linked by identifiers become one row first, whatever their order, and that row meets the
    existing ones with all identifiers of its rows. Existing rows are not merged with each other.
    """
    kinds = shared_ids(existing, incoming, id_cols)
    places = cut_lineage(_places(existing, incoming, incoming_key, order, kinds), "places")
    return _merge_places(existing, incoming, collapse_linked(places, incoming_key, order, kinds), incoming_key, order, kinds)


def with_enough_ids(references: DataFrame, id_cols: Sequence[str], at_least: int = 2) -> DataFrame:
    """References that carry at least so many of the given identifiers."""
    present = sum((F.col(c).isNotNull().cast("int") for c in id_cols), F.lit(0))
    return references.where(present >= at_least)
