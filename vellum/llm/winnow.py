"""Document fingerprints by winnowing, in column expressions only.

Every run of ``gram`` bytes of a text has a hash. Of every ``window`` consecutive hashes the smallest is chosen, the rightmost
if several are equal; the chosen hashes and their byte positions are the fingerprint. Two texts that share a run of
``gram + window - 1`` bytes therefore share a chosen hash, and the positions tell where it is in each of them.

A position is chosen exactly if so many neighbours to its left have no smaller hash, and to its right only larger ones, that
a whole window fits among them. That is what the expressions test, so the hashes of a text are computed once and no window is
built.

Null texts count as empty and have an empty fingerprint; documents without id come before all others. A text shorter than ``gram`` bytes is one hash of all of it; with
fewer hashes than ``window`` the one window is the whole text. Equal texts have equal fingerprints. Repeated rows give
repeated results; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class WinnowConfig:
    """gram: bytes hashed together. window: hashes of which the smallest is chosen. ranges: ranges of ids for each shuffle partition."""

    gram: int = 12
    window: int = 32
    ranges: int = 4


def gram_hashes(text: Column, config: WinnowConfig) -> Column:
    """The hashes of all runs of bytes of a text, in order; none for an empty text."""
    data = text.cast("binary")
    last = F.greatest(F.octet_length(text) - F.lit(config.gram - 1), F.lit(1))
    # the bytes are bound to a variable once: read from the row, they would be copied for every run
    grams = F.transform(
        F.array(data), lambda b: F.transform(F.sequence(F.lit(1), last), lambda i: F.xxhash64(F.substring(b, i, F.lit(config.gram))))
    )
    return F.when(F.octet_length(text) > 0, grams[0]).otherwise(F.array().cast("array<bigint>"))


def reach(h: Column, i: Column, step: int, most: int, own: Column) -> Column:
    """How far from position i the hashes stay larger (to the right) or no smaller (to the left), up to ``most``."""
    length = F.lit(most)
    for far in range(most, 0, -1):
        other = F.get(h, i + F.lit(step * far))
        stays = other > own if step > 0 else other >= own
        length = F.when(stays, length).otherwise(F.lit(far - 1))  # outside the text there is no hash, which ends the run
    return length


def chosen(h: Column, config: WinnowConfig) -> Column:
    """The chosen positions (from 0) of the hashes ``h``, ascending."""
    most = config.window - 1
    need = F.least(F.lit(config.window), F.size(h)) - 1

    def fits(h: Column, i: Column) -> Column:
        own = F.get(h, i)
        return reach(h, i, 1, most, own) + reach(h, i, -1, most, own) >= need

    positions = F.when(F.size(h) > 0, F.sequence(F.lit(0), F.size(h) - 1)).otherwise(F.array().cast("array<int>"))
    return F.filter(positions, lambda i: fits(h, i))


def fingerprint(text: Column, config: WinnowConfig | None = None) -> Column:
    """Array of (hash, position) of the chosen hashes of a text."""
    config = config or WinnowConfig()
    hashes = F.transform(
        F.array(gram_hashes(text, config)),
        lambda h: F.transform(chosen(h, config), lambda i: F.struct(F.get(h, i).alias("hash"), i.alias("position"))),
    )
    return hashes[0]


def marks_between(data: Column, lo: Column, hi: Column, config: WinnowConfig) -> Column:
    """The marks of bytes ``data`` at the positions lo to hi, from no more bytes than can have a say in them."""
    reach = config.window - 1
    start = F.greatest(lo - reach, F.lit(0))
    stop = F.least(hi + reach + config.gram, F.octet_length(data))
    part = fingerprint(F.substring(data, start + 1, F.greatest(stop - start, F.lit(0))), config)
    moved = F.transform(part, lambda m: moved_by(m, start))
    return F.when(lo <= hi, F.filter(moved, lambda m: m["position"].between(lo, hi))).otherwise(F.slice(moved, 1, 0))


def moved_by(mark: Column, by: Column) -> Column:
    return F.struct(mark["hash"].alias("hash"), (mark["position"] + by).cast("int").alias("position"))


def joined_marks(data: Column, a: Column, b: Column, marks: Column, next_marks: Column, config: WinnowConfig) -> Column:
    """The fingerprint of ``data``, which is the first a bytes of one text and then the first b bytes of another.

    Away from the seam and from the end, a mark depends on the hashes of one text only, so it is a mark of that text; only
    the positions around the seam and at the end are looked at anew.
    """
    gram, window = config.gram, config.window
    last = F.greatest(F.octet_length(data) - gram, F.lit(0))
    first_end = a - gram - window + 1  # last position that sees the first text only
    lo, hi = F.lit(window - 1), b - gram - window + 1  # the same in the second text
    some = lo <= hi
    seam = marks_between(data, F.greatest(first_end + 1, F.lit(0)), F.when(some, a + window - 2).otherwise(last), config)
    end = marks_between(data, F.when(some, a + hi + 1).otherwise(last + 1), last, config)
    first = F.filter(marks, lambda m: m["position"] <= first_end)
    second = F.transform(F.filter(next_marks, lambda m: m["position"].between(lo, hi)), lambda m: moved_by(m, a))
    return F.concat(first, seam, second, end)


def written(marks: Column) -> Column:
    """A fingerprint as text: the last eight hexadecimal digits of the hash and the position of each mark."""

    def mark(m: Column) -> Column:
        return F.concat(F.lower(F.lpad(F.hex(m["hash"].bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")), F.lit(":"), m["position"].cast("string"))

    return F.array_join(F.transform(marks, mark), " ")


def likeness(a: Column, b: Column) -> Column:
    """Shared hashes over all hashes of two fingerprints; 1 for two empty ones."""
    x, y = F.array_distinct(a["hash"]), F.array_distinct(b["hash"])
    both, total = F.size(F.array_intersect(x, y)), F.size(x) + F.size(y)
    return F.when(total == 0, 1.0).otherwise(both / (total - both)).cast("double")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", config: WinnowConfig | None = None) -> DataFrame:
    """(doc_id, marks) of every whole text."""
    return docs.select(F.col(id_col).alias("doc_id"), fingerprint(F.coalesce(F.col(text_col), F.lit("")), config).alias("marks"))


def id_ranges(docs: DataFrame, buckets: int) -> Column:
    """The range of each id among about equally full ranges, from approximate quantiles of the ids."""
    shares = [i / buckets for i in range(1, buckets)]
    found = docs.select(F.percentile_approx("id", F.array(*map(F.lit, shares)), F.lit(10_000))).first()[0] or []
    borders = sorted(set(found))
    bucket = F.lit(0)
    return F.size(F.filter(F.array(*map(F.lit, borders)), lambda x: x < F.col("id"))) if borders else bucket


def edited_fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", config: WinnowConfig | None = None
) -> DataFrame:
    """Fingerprints of every text, of its edited text, and how like they and the next document's are.

    The edited text has the last half of the code points replaced by the first as many (or all) of the next document by id;
    after the last comes the first. Documents of equal id follow one another by text. Documents are sorted within ranges of
    their ids; only the first document of each range is looked up across ranges.
    """
    config = config or WinnowConfig()
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.withColumn("bucket", id_ranges(rows.select("id"), config.ranges * parts))

    some = F.when(F.bool_and(F.col("id").isNotNull()), F.min("id"))  # a missing id comes first
    least = ranged.groupBy("bucket").agg(some.alias("least"))  # one row for each range
    first = ranged.join(F.broadcast(least), "bucket").filter(F.col("id").eqNullSafe(F.col("least")))
    first = first.groupBy("bucket").agg(F.min("text").alias("text"))
    whole = Window.orderBy("bucket")  # over at most as many rows as there are ranges
    first = first.withColumn("after", F.coalesce(F.lead("text").over(whole), F.first("text").over(whole.rowsBetween(Window.unboundedPreceding, 0))))
    after = first.select("bucket", "after")

    order = Window.partitionBy("bucket").orderBy("id", "text")
    dealt = ranged.repartition(parts, "bucket").sortWithinPartitions("bucket", "id", "text")
    marked = dealt.withColumn("marks", fingerprint(F.col("text"), config))
    led = marked.withColumn("next", F.lead("text").over(order)).withColumn("next_marks", F.lead("marks").over(order))
    led = led.join(after, "bucket")
    following = F.coalesce("next", "after")
    half = F.floor(F.char_length("text") / 2).cast("int")
    both = led.withColumns(
        {
            "next_marks": F.coalesce("next_marks", F.when(F.col("next").isNull(), fingerprint(F.col("after"), config))),
            "kept": F.substring("text", F.lit(1), F.char_length("text") - half),
            "taken": F.substring(following, F.lit(1), half),
        }
    )
    both = both.withColumn("edited", F.concat("kept", "taken"))
    a, b = F.octet_length("kept"), F.octet_length("taken")
    edited_marks = F.transform(
        F.array(F.col("edited").cast("binary")),
        lambda data: joined_marks(data, a, b, F.col("marks"), F.col("next_marks"), config),
    )[0]
    both = both.withColumn("edited_marks", edited_marks)
    return both.select(
        F.col("id").alias("doc_id"),
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        written(F.col("marks")).alias("fingerprint"),
        written(F.col("edited_marks")).alias("edited_fingerprint"),
        likeness(F.col("marks"), F.col("edited_marks")).alias("near_edited"),
        likeness(F.col("marks"), F.col("next_marks")).alias("near_next"),
    )
