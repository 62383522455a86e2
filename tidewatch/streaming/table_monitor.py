"""Measuring a table that is rebuilt, appended to or loses files, by the files that changed.

A table is a set of files. The monitor keeps what each file adds to a suite's measurements: its
partial aggregates per date and how often it holds each key. A refresh reads the files that are new
or were written anew and nothing else; files that are gone are retracted. Partials of a file are
left out when it goes, so minima and maxima need no inverse. Keys are counted over all files in hash
buckets: a refresh adds and takes off counts in the buckets it touches, and a measurement reads
three numbers per bucket.

Everything is a version: a refresh writes folders of its own and commits them by one last file.
Until then readers, and a run that follows one that was killed, see the version before. One refresh
runs at a time.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewatch.functions.numeric import wall_clock
from tidewatch.operators.checks import KeyedCheck
from tidewatch.operators.suite import Suite, key_totals, measure_partials
from tidewatch.sources.tables import append_measurements, read_measurements

FILE = "__file"
MANIFEST = "path string, modified timestamp, length long, file long, version long"
BUCKETS = "bucket int, binding int, keys long, filled_keys long, copies long, version long"


def _same_path(path: Column) -> Column:
    """One spelling for the paths of listings and of the rows' metadata (which is percent-encoded)."""
    return F.regexp_replace(path, "^([A-Za-z][A-Za-z0-9+.-]*):/+", "$1:/")


@dataclass
class TableMonitor:
    """A suite over the parquet files under ``path``; ``folder`` holds the state of all versions.

    ``schema`` is that of the table, partition columns included; ``derived`` adds columns that the
    suite is bound to, each from values of its row. ``buckets`` divides the keys. Once a version draws on more
    than ``compact_after`` earlier ones, a refresh writes all of its state anew.
    """

    spark: SparkSession
    path: str
    schema: StructType
    suite: Suite
    folder: str
    derived: Mapping[str, Column] = field(default_factory=dict)
    buckets: int = 64
    compact_after: int = 50

    def __post_init__(self) -> None:
        self.counted = self.suite.counted_keys()
        for i, b in self.suite.of_family(KeyedCheck):
            if i not in self.counted:
                raise ValueError(f"{b.check.name} can't be measured from keys and their counts")

    @property
    def identity(self) -> str:
        return hashlib.sha256(self.folder.encode()).hexdigest()[:16]

    # ------------------------------------------------------------------ versions

    def version(self) -> int | None:
        """Number of the newest committed version."""
        try:
            found = self.spark.read.schema("version long").parquet(f"{self.folder}/commits/*")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return found.agg(F.max("version")).first()[0]

    def _manifest(self, version: int | None) -> DataFrame:
        if version is None:
            return self.spark.createDataFrame([], MANIFEST)
        return self.spark.read.schema(MANIFEST).parquet(f"{self.folder}/manifest/version-{version}")

    def _buckets(self, version: int | None) -> DataFrame:
        if version is None:
            return self.spark.createDataFrame([], BUCKETS)
        return self.spark.read.schema(BUCKETS).parquet(f"{self.folder}/buckets/version-{version}")

    def _stored(self, kind: str, manifest: DataFrame) -> DataFrame:
        """State of the manifest's files, from the versions that hold it."""
        versions = [r[0] for r in manifest.select("version").distinct().collect()]  # a bounded number
        frames = [
            self.spark.read.parquet(f"{self.folder}/{kind}/version-{v}").withColumn("version", F.lit(v).cast("long"))
            for v in sorted(versions)
        ]
        files = manifest.select(F.col("file").alias(FILE), "version")
        return reduce(DataFrame.unionByName, frames).join(files, [FILE, "version"], "left_semi").drop("version")

    def _write(self, df: DataFrame, kind: str, version: int, by: str | None = None) -> None:
        writer = df.write.mode("overwrite")  # what a killed run may have left
        (writer.partitionBy(by) if by else writer).parquet(f"{self.folder}/{kind}/version-{version}")

    # ------------------------------------------------------------------ refresh

    def files(self) -> DataFrame:
        """The table's files now, from a listing: their contents aren't read."""
        listing = (
            self.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
            .option("recursiveFileLookup", True).load(self.path)
        )
        path = _same_path(F.col("path"))
        return listing.select(
            path.alias("path"), F.col("modificationTime").alias("modified"), "length",
            F.xxhash64(path).alias("file"),
        )

    def _rows(self, paths: list[str]) -> DataFrame:
        read = self.spark.read.schema(self.schema).option("basePath", self.path).parquet(*paths)
        encoded = F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))
        rows = read.select("*", F.xxhash64(_same_path(F.url_decode(encoded))).alias(FILE))
        return rows.withColumns(dict(self.derived))

    def refresh(self) -> int:
        """Take in what changed since the last version; the number of the version that holds it."""
        last = self.version()
        version = 0 if last is None else last + 1
        now, before = self.files(), self._manifest(last)
        same = ["path", "modified", "length", "file"]
        # one look at the table for all that follows: its files now, and those of the last version
        found = now.withColumn("now", F.lit(True)).join(before, same, "full").select(
            *same, "version", F.coalesce("now", F.lit(False)).alias("now")
        )
        self._write(found, "changes", version)
        changes = self.spark.read.schema(found.schema).parquet(f"{self.folder}/changes/version-{version}")
        fresh = changes.where("version is null").select(*same)
        kept, lost = (changes.where(f"version is not null and {x}now").select(*same, "version") for x in ("", "not "))
        # a line per version that is drawn on
        counts = changes.groupBy("version", "now").agg(F.count(F.lit(1)), F.count_distinct("file")).collect()
        if any(files != names for _, _, files, names in counts):
            raise RuntimeError("two files have names of equal hashes; rename one")
        gone = any(v is not None and not here for v, here, _, _ in counts)
        drawn_on = {v for v, here, _, _ in counts if v is not None and here}
        # Spark's own file index lists paths on the driver as well
        added = [r["path"] for r in fresh.select("path").collect()]
        if last is not None and not added and not gone:
            return last
        anew, stays = len(drawn_on) > self.compact_after, bool(drawn_on)

        rows = self._rows(added) if added else None
        own = {
            "partials": None if rows is None else self.suite.partials(rows, count_rows=True, by=[FILE]),
            "keys": None,
        }
        if self.counted and rows is not None:
            own["keys"] = self.suite.key_counts(self.suite.key_rows(rows, self.counted, by=[FILE]))
        for kind, new in own.items():
            if kind == "keys" and not self.counted:
                continue
            carried = self._stored(kind, kept) if anew and stays else None
            parts = [x for x in (new, carried) if x is not None]
            if parts:
                self._write(reduce(DataFrame.unionByName, parts), kind, version)
        if self.counted:
            self._merge_keys(last, version, fresh if added else None, lost if gone else None)
        carried = kept.withColumn("version", F.lit(version).cast("long")) if anew else kept
        new = fresh.withColumn("version", F.lit(version).cast("long"))
        self._write(new.unionByName(carried), "manifest", version)
        done = self.spark.createDataFrame([(version,)], "version long").coalesce(1)
        done.write.mode("overwrite").parquet(f"{self.folder}/commits/version-{version}")
        return version

    def _merge_keys(
        self, last: int | None, version: int, fresh: DataFrame | None, lost: DataFrame | None
    ) -> None:
        """Add the new files' counts to the buckets of keys and take the lost files' off."""
        changes = []
        if fresh is not None:
            # a version that carries earlier files over holds their counts as well
            new = self.spark.read.parquet(f"{self.folder}/keys/version-{version}")
            changes.append(new.join(fresh.select(F.col("file").alias(FILE)), FILE, "left_semi"))
        if lost is not None:
            gone = self._stored("keys", lost)
            changes.append(gone.withColumn("copies", -F.col("copies")))
        if not changes:
            self._write(self._buckets(last), "buckets", version)
            return
        delta = reduce(DataFrame.unionByName, changes).drop(FILE)
        key = [c for c in delta.columns if c != "copies"]
        delta = delta.withColumn("bucket", F.pmod(F.xxhash64(*key), F.lit(self.buckets)).cast("int"))
        earlier = self._buckets(last)
        touched = delta.select("bucket").distinct()
        at = earlier.groupBy("bucket").agg(F.max("version").alias("version"))
        places = touched.join(at, "bucket", "left").collect()  # at most ``buckets``
        touched = [r["bucket"] for r in places]
        for v in sorted({r["version"] for r in places} - {None}):
            held = self.spark.read.schema(delta.schema).parquet(f"{self.folder}/merged/version-{v}")
            own = [r["bucket"] for r in places if r["version"] == v]  # partitions: the others aren't read
            delta = delta.unionByName(held.where(F.col("bucket").isin(own)))
        # by bucket: a task writes whole buckets, one file each; counts were merged per file before
        merged = delta.repartition("bucket").groupBy("bucket", *key).agg(F.sum("copies").alias("copies")).where("copies <> 0")
        self._write(merged, "merged", version, by="bucket")
        counts = self.spark.read.schema(merged.schema).parquet(f"{self.folder}/merged/version-{version}")
        totals = key_totals(counts, by=["bucket"]).withColumn("version", F.lit(version).cast("long"))
        untouched = earlier.where(~F.col("bucket").isin(touched))
        self._write(totals.unionByName(untouched), "buckets", version)

    # ------------------------------------------------------------------ measuring

    def measure(self, measured_at) -> DataFrame:
        """Measurement rows of the table as it was at the last refresh."""
        version = self.version()
        if version is None:
            raise RuntimeError("refresh the monitor before it measures")
        at = wall_clock(measured_at)
        parts = []
        if len(self.counted) < len(self.suite.bindings):
            manifest = self._manifest(version)
            if manifest.isEmpty():
                none = self.spark.createDataFrame([], self.schema).withColumns(dict(self.derived))
                partials = self.suite.partials(none, count_rows=True)
            else:
                partials = self.suite.merged(self._stored("partials", manifest))
            parts.append(measure_partials(partials, self.suite, measured_at))
        if self.counted:
            wide = self.suite.measure_keys(self._buckets(version), self.counted)
            parts.append(self.suite.rows_of(wide, self.counted, at))
        return reduce(DataFrame.unionByName, parts)


def keep_measuring_table(
    monitor: TableMonitor,
    log_path: str,
    clock: Callable[[], dt.datetime],
    poll_seconds: float = 60.0,
    stop: Callable[[], bool] = lambda: False,
) -> None:
    """Look for changed files at an interval and append a measurement for each new version.

    A version that an earlier run committed and did not live to measure is measured first.
    """
    earlier = read_measurements(monitor.spark, log_path).where(F.col("monitor") == monitor.identity)
    done = earlier.agg(F.max("batch_id")).first()[0]
    while True:
        version = monitor.refresh()
        if version != done:
            append_measurements(monitor.measure(clock()), log_path, version, monitor.identity)
            done = version
        if stop():
            return
        time.sleep(poll_seconds)
