"""Stored tables with a key that change in place of being rewritten.

``KeyedLog`` is for streams: batches of rows are added as deltas, dealt to buckets by the hash of their key. Who wants some keys
reads the buckets of those keys; deltas of like size are merged, so a bucket holds few of them however many batches
came. ``RangeTable`` is for tables that are read more than changed: files sorted by key, of which an update rewrites the ones that
hold a changed key and no other.

Both switch from one state to the next by a manifest, keep earlier states readable until ``forget`` is called, and take one
writer at a time. Keys are text or whole numbers. A log keeps the last row without key as one more
key, a table keeps all of them.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from vellum.operators import upsert
from vellum.operators.joins import SENT_KEYS, first_per_key, with_keys
from vellum.session import cut_lineage
from vellum.sources.manifest import Manifest, Version


#: Rows of a bucket that one task writes, where their number is known.
PART_ROWS = 1 << 15


class KeyedLog:
    """The last row of every key, by ``order`` and then by batch, of all batches added.

    ``buckets`` is fixed by the first batch; ``fan`` deltas of like size in one bucket are merged into one.
    """

    def __init__(
        self, spark: SparkSession, root: str, key: str, schema: str | StructType, order: tuple[str, ...] = (), buckets: int = 16,
        fan: int = 4,
    ):
        self.spark, self.root, self.key, self.order, self.fan = spark, root, key, order, fan
        self.schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        self.stored = StructType([*self.schema.fields, StructField("_batch", LongType())])
        self.manifest = Manifest(spark, root)
        latest = self.manifest.latest()
        self.buckets = latest.facts["buckets"] if latest else buckets

    def _bucket(self, key: str) -> Column:
        return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(self.buckets)).cast("int")

    def _dealt(self, rows: DataFrame, most: int) -> DataFrame:
        """Rows dealt by bucket, a bucket of ``most`` rows at most to as many tasks as those need; the rows of a key to one."""
        part = F.pmod(F.hash(F.col(self.key).cast("string")), F.lit(max(1, -(-most // PART_ROWS))))
        return rows.withColumn("_part", part).repartition("_bucket", "_part")

    def _write(self, rows: DataFrame, folder: str) -> dict[int, int]:
        """A file of each task for each bucket it has, of rows dealt by bucket; the rows of each bucket."""
        path = f"{self.root}/data/{folder}"
        rows.drop("_part").sortWithinPartitions("_bucket", self.key).write.mode("overwrite").partitionBy("_bucket").parquet(path)
        stored = self.spark.read.schema(StructType([*self.stored.fields, StructField("_bucket", IntegerType())])).parquet(path)
        return {r["_bucket"]: r["n"] for r in stored.groupBy("_bucket").agg(F.count(F.lit(1)).alias("n")).collect()}

    def append(self, rows: DataFrame, batch: int, n: int = 0) -> None:
        """Add a batch (one row per key). A batch that is in already, or an older one, is left out.

        ``n``, the number of rows where it is known, spreads the writing of a large batch.
        """
        latest = self.manifest.latest() or Version(0, None, [], {"buckets": self.buckets})
        if latest.batch is not None and latest.batch >= batch:
            return
        folder = f"batch-{batch}"
        dealt = rows.select(*self.schema.names, F.lit(batch).cast("long").alias("_batch"), self._bucket(self.key).alias("_bucket"))
        found = self._write(self._dealt(dealt, n // self.buckets), folder)
        entries = latest.entries + [{"bucket": b, "folder": folder, "rows": n} for b, n in sorted(found.items())]
        following = Version(latest.number + 1, batch, entries, latest.facts)
        self.manifest.commit(following)
        self._merge(following)

    def _due(self, entries: list[dict]) -> list[dict]:
        """The newest deltas of a bucket that are to become one: as many as are together no smaller than the next older one,
        once there are ``fan`` of like size."""
        tier = [int(math.log(max(e["rows"], 1), self.fan)) for e in entries]
        start = len(entries) - 1
        while start > 0 and tier[start - 1] <= max(tier[start:]):
            start -= 1
        return entries[start:] if len(entries) - start >= self.fan else []

    def _merge(self, version: Version) -> None:
        """Merge the deltas that are due, in all buckets at once, as the next version."""
        by_bucket: dict[int, list[dict]] = {}
        for entry in version.entries:
            by_bucket.setdefault(entry["bucket"], []).append(entry)
        due = {b: merge for b, entries in by_bucket.items() if (merge := self._due(entries))}
        if not due:
            return
        # dealt once: the last row of a key is found in its part of its bucket, where it is written
        rows = self._read([e for merge in due.values() for e in merge])
        rows = self._dealt(rows, max(sum(e["rows"] for e in merge) for merge in due.values()))
        folder = f"merge-{version.number + 1}-{uuid.uuid4().hex[:8]}"
        found = self._write(self._last(rows, "_bucket", "_part"), folder)
        entries = []
        for b, held in sorted(by_bucket.items()):
            entries += held[: len(held) - len(due.get(b, []))]
            if b in due:
                entries.append({"bucket": b, "folder": folder, "rows": found[b]})
        self.manifest.commit(Version(version.number + 1, version.batch, entries, version.facts))

    def _read(self, entries: list[dict]) -> DataFrame:
        paths = sorted(f"{self.root}/data/{e['folder']}/_bucket={e['bucket']}" for e in entries)
        return self.spark.read.schema(self.stored).parquet(*paths).withColumn("_bucket", self._bucket(self.key))

    def _last(self, rows: DataFrame, *dealt: str) -> DataFrame:
        return first_per_key(rows, [*dealt, self.key], [*self.order, "_batch"], last=True)

    def _last_of_all(self, rows: DataFrame) -> DataFrame:
        """The same of a whole log, whose texts stay where they are: keys with several rows, and the batch of the last of
        these, are found from the columns that order them and go to every task. Keys that one batch has twice are numbered."""
        known = rows.groupBy(F.col(self.key).alias("_of")).agg(
            F.max(F.struct(*self.order, "_batch")).alias("_best"), F.count(F.lit(1)).alias("_n"), F.size(F.collect_set("_batch")).alias("_in")
        )
        again = known.where("_n > 1").select("_of", F.when(F.col("_n") == F.col("_in"), F.col("_best._batch")).alias("_keep"), F.lit(True).alias("_again"))
        again = cut_lineage(again, "again")
        n, twice = again.agg(F.count(F.lit(1)), F.count_if(F.col("_keep").isNull())).first()
        if n > SENT_KEYS:
            return self._last(rows)
        if not n:
            return rows
        marked = rows.join(F.broadcast(again), F.col(self.key).eqNullSafe(F.col("_of")), "left")
        found = marked.where("_again IS NULL OR _batch = _keep").select(rows.columns)
        if not twice:
            return found
        return found.unionByName(self._last(marked.where("_again AND _keep IS NULL").select(rows.columns)))

    def read(self, only: DataFrame | None = None, before: int | None = None) -> DataFrame:
        """The last row of every key, or of the keys in ``only``; ``before`` a batch: as it was when that batch came.

        Of ``only`` the bucket numbers and their counts come to the driver, at most ``buckets`` of them; other buckets are not
        opened, and the log's rows are not shuffled to find a batch's keys. What is found is dealt by key, as joins on it need it.
        """
        version = self.manifest.latest(before)
        entries = version.entries if version else []
        if only is not None and entries:
            counted = only.groupBy(self._bucket(self.key).alias("_bucket")).agg(F.count(F.lit(1)).alias("n"))
            wanted = {r["_bucket"]: r["n"] for r in counted.collect()}
            entries = [e for e in entries if e["bucket"] in wanted]
        if not entries:
            return self.spark.createDataFrame([], self.schema)
        rows = self._read(entries)
        if only is None:
            return self._last_of_all(rows).select(self.schema.names)
        return self._last(with_keys(rows, only, self.key, sum(wanted.values()))).select(self.schema.names)

    def deltas(self) -> int:
        """The most files a bucket has now."""
        held: dict[int, int] = {}
        for e in (self.manifest.latest() or Version(0)).entries:
            held[e["bucket"]] = held.get(e["bucket"], 0) + 1
        return max(held.values(), default=0)

    def forget(self, keep: int = 2) -> int:
        return self.manifest.forget(keep)


class RangeTable:
    """A table as files sorted by ``key`` with their key ranges, of about ``rows`` rows each."""

    def __init__(self, spark: SparkSession, root: str, key: str, rows: int = 1_000_000):
        self.spark, self.root, self.key, self.rows = spark, root, key, rows
        self.manifest = Manifest(spark, root)

    def _stored(self, version: Version, written: list[str], kept: list[dict]) -> None:
        """Commit the next version: files kept and files of folders just written, with the range and size of each."""
        entries = list(kept)
        for folder in written:
            path = f"{self.root}/data/{folder}"
            found = self.spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("file")).agg(
                F.min(self.key).alias("lo"), F.max(self.key).alias("hi"), F.count(F.lit(1)).alias("rows")
            )
            for r in found.collect():
                entries.append({"folder": folder, "file": r["file"], "lo": r["lo"], "hi": r["hi"], "rows": r["rows"]})
        self.manifest.commit(Version(version.number + 1, None, entries, version.facts))

    def _ranged(self, rows: DataFrame, folder: str) -> bool:
        """Write rows as sorted files by ranges of the key; whether there were any."""
        n = rows.count()
        if n:
            files = -(-n // self.rows)
            rows.repartitionByRange(files, self.key).sortWithinPartitions(self.key).write.parquet(f"{self.root}/data/{folder}")
        return n > 0

    def create(self, rows: DataFrame) -> None:
        """The first version, or a whole new state."""
        latest = self.manifest.latest() or Version(0)
        folder = f"v{latest.number + 1}-{uuid.uuid4().hex[:8]}"
        facts = {"schema": rows.schema.json()}
        written = [folder] if self._ranged(cut_lineage(rows, "created"), folder) else []
        self._stored(Version(latest.number, None, [], facts), written, [])

    def _latest(self) -> Version:
        latest = self.manifest.latest()
        if latest is None:
            raise ValueError(f"there is no table at {self.root}")
        return latest

    def _read(self, entries: list[dict], version: Version) -> DataFrame:
        schema = StructType.fromJson(json.loads(version.facts["schema"]))
        if not entries:
            return self.spark.createDataFrame([], schema).withColumn("_file", F.lit(None).cast("string"))
        rows = self.spark.read.schema(schema).parquet(*[e["file"] for e in entries])
        return rows.withColumn("_file", F.col("_metadata.file_path"))

    def read(self, lo=None, hi=None) -> DataFrame:
        """All rows, or those with a key in a range: files beyond it are not opened."""
        version = self._latest()
        rows = self._read([e for e in version.entries if _meets(e, lo, hi)], version).drop("_file")
        if lo is not None:
            rows = rows.where(F.col(self.key) >= F.lit(lo))
        return rows if hi is None else rows.where(F.col(self.key) <= F.lit(hi))

    def holders(self, keys: DataFrame) -> tuple[Version, list[dict], DataFrame]:
        """The files that hold any of the keys, and the place (key, _file) of each key found.

        Files whose range none of the keys can meet are not opened, of the others the key column is read. The names of the
        files hit come to the driver.
        """
        version = self._latest()
        wanted = keys.select(self.key).where(F.col(self.key).isNotNull()).distinct()
        bounds = wanted.agg(F.min(self.key), F.max(self.key)).first()
        near = [e for e in version.entries if bounds[0] is not None and _meets(e, *bounds)]
        places = self._read(near, version).select(self.key, "_file").join(wanted, self.key, "left_semi")
        places = cut_lineage(places.distinct(), "places")
        hit = {r[0] for r in places.select("_file").distinct().collect()}
        return version, [e for e in near if e["file"] in hit], places

    def rows_of(self, keys: DataFrame) -> DataFrame:
        """The rows of some keys, read from the files that hold them."""
        version, hit, _ = self.holders(keys)
        return self._read(hit, version).drop("_file").join(keys.select(self.key).distinct(), self.key, "left_semi")

    def _change(self, keys: DataFrame, change: Callable[[DataFrame, DataFrame], DataFrame]) -> int:
        """Rewrite the files that hold some of the keys; gives their number.

        ``change`` gets their rows with the file of each in ``_file``, and the keys' places, and gives the rows to write; rows
        without file are new and become files of their own.
        """
        version, hit, places = self.holders(keys)
        following = cut_lineage(change(self._read(hit, version), places), "changed")
        names = f"v{version.number + 1}-{uuid.uuid4().hex[:8]}", f"v{version.number + 1}-{uuid.uuid4().hex[:8]}"
        written = []
        old = following.where("_file IS NOT NULL")
        if hit and not old.isEmpty():
            one = old.withColumn("_part", F.xxhash64("_file")).repartition(len(hit), "_part").sortWithinPartitions("_part", self.key)
            one.drop("_file").write.partitionBy("_part").parquet(f"{self.root}/data/{names[0]}")
            written.append(names[0])
        if self._ranged(following.where("_file IS NULL").drop("_file"), names[1]):
            written.append(names[1])
        gone = {e["file"] for e in hit}
        self._stored(version, written, [e for e in version.entries if e["file"] not in gone])
        return len(hit)

    def upsert(self, new: DataFrame, mode: str = "replace") -> int:
        """``operators.upsert.upsert`` of rows (unique per key) on the files that hold one of their keys; gives the number of those."""

        def change(old: DataFrame, places: DataFrame) -> DataFrame:
            rows = new.join(places, self.key, "left") if mode == "replace" else new
            return upsert.upsert(old, rows, self.key, mode).select(*old.columns)

        return self._change(new, change)

    def delete(self, ids: DataFrame, id_col: str = "id") -> int:
        """Take out the rows of some ids; gives the number of files rewritten."""
        keys = ids.select(F.col(id_col).alias(self.key))
        return self._change(keys, lambda old, places: upsert.delete_ids(old, keys, self.key, self.key))

    def forget(self, keep: int = 2) -> int:
        return self.manifest.forget(keep)


def _meets(entry: dict, lo, hi) -> bool:
    """Whether a file's range can hold a key from lo to hi."""
    if entry["lo"] is None:
        return lo is None and hi is None
    return (hi is None or entry["lo"] <= hi) and (lo is None or entry["hi"] >= lo)
