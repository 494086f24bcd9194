"""Keyed tables in versions: a change rewrites the buckets it touches and is published at once.

A table is a folder of parquet files laid out as ``wf_place=<attempt>/wf_bucket=<n>``; a row's bucket is the hash of its key. A manifest says
which attempt holds each bucket now, and a new manifest appears by one rename, so readers see a change whole or not at all. A merge reads
the buckets of its delta and nothing else of the table: it shuffles the delta and those buckets. Work lost or repeated half way leaves
folders that no manifest names.

The manifest also keeps a ledger of named loads: rows offered, rows found in what the load left, and its version.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirflow.plans.merge import require_unique_keys, rows_after_max

BUCKETS = 16
Merge = Callable[[DataFrame, DataFrame], DataFrame]  # (touched part of the table, delta) to the part's new content


@dataclass
class Manifest:
    """What a version is: where each bucket is held, and what was loaded."""

    version: int
    keys: list[str]
    buckets: int
    schema: str
    held: dict[int, str] = field(default_factory=dict)
    loads: list[dict] = field(default_factory=list)


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    # -- manifests ---------------------------------------------------------------------------------------------------------------------

    def _versions(self) -> list[int]:
        found = self._fs.globStatus(self._path(f"{self.path}/_manifests/*.json")) or []
        return sorted(int(s.getPath().getName()[:-5]) for s in found)

    def manifest(self, version: int | None = None) -> Manifest:
        """The newest manifest, or that of an earlier version."""
        known = self._versions()
        if not known:
            raise ValueError(f"no table at {self.path}")
        name = f"{self.path}/_manifests/{known[-1] if version is None else version}.json"
        text = self.spark.read.option("wholetext", True).text(name).first()[0]
        raw = json.loads(text)
        raw["held"] = {int(k): v for k, v in raw["held"].items()}
        return Manifest(**raw)

    def _publish(self, manifest: Manifest) -> None:
        """One rename makes the version visible; it fails where another writer was first."""
        folder = f"{self.path}/_manifests"
        draft = self._path(f"{folder}/_draft-{manifest.version}")
        out = self._fs.create(draft, True)
        out.write(bytearray(json.dumps(asdict(manifest)).encode()))
        out.close()
        target = self._path(f"{folder}/{manifest.version}.json")
        if self._fs.exists(target) or not self._fs.rename(draft, target):
            raise RuntimeError(f"version {manifest.version} was published by another writer")

    # -- reading -----------------------------------------------------------------------------------------------------------------------

    def read(self, version: int | None = None, buckets: Sequence[int] | None = None) -> DataFrame:
        """The table as of a version, or only some of its buckets: folders are chosen by partition values, nothing else is scanned."""
        return self._rows(self.manifest(version), buckets)

    def _rows(self, now: Manifest, buckets: Sequence[int] | None = None) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(now.schema))
        places: dict[str, list[int]] = {}
        for bucket, place in now.held.items():
            if buckets is None or bucket in buckets:
                places.setdefault(place, []).append(bucket)
        if not places:
            return self.spark.createDataFrame([], schema)
        layout = T.StructType([*schema.fields, T.StructField("wf_place", T.StringType()), T.StructField("wf_bucket", T.IntegerType())])
        rows = self.spark.read.schema(layout).option("basePath", f"{self.path}/data").parquet(*(f"{self.path}/data/wf_place={p}" for p in sorted(places)))
        condition: Column = F.lit(False)
        for place, some in sorted(places.items()):
            condition = condition | ((F.col("wf_place") == place) & F.col("wf_bucket").isin(*sorted(some)))
        return rows.filter(condition).select(*schema.names)

    def touched(self, delta: DataFrame, now: Manifest | None = None) -> list[int]:
        """The buckets of a delta's keys: at most one small number per bucket reaches the driver."""
        now = now or self.manifest()
        return sorted(r.b for r in delta.select(_bucket(now.keys, now.buckets).alias("b")).distinct().collect())

    # -- writing -----------------------------------------------------------------------------------------------------------------------

    def _write(self, rows: DataFrame, keys: Sequence[str], buckets: int) -> dict[int, str]:
        """The rows into folders of their own; where each bucket that has any is now. Every attempt has its own folder."""
        place = uuid.uuid4().hex
        rows = rows.withColumn("wf_bucket", _bucket(keys, buckets))
        rows.repartition("wf_bucket").sortWithinPartitions("wf_bucket", *keys).write.partitionBy("wf_bucket").parquet(f"{self.path}/data/wf_place={place}")
        found = self._fs.globStatus(self._path(f"{self.path}/data/wf_place={place}/wf_bucket=*")) or []
        return {int(s.getPath().getName().split("=")[1]): place for s in found}

    def create(self, rows: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> Manifest:
        """First version of the table. Keys must be unique. A bucket is rewritten whole, so choose as many as keep it below a file."""
        if self._versions():
            raise ValueError(f"there is a table at {self.path}")
        require_unique_keys(rows, keys)
        made = Manifest(0, list(keys), buckets, rows.schema.json(), self._write(rows, keys, buckets))
        self._publish(made)
        return made

    def _staged(self, now: Manifest, delta: DataFrame, merge: Merge) -> Manifest:
        require_unique_keys(delta, now.keys)
        touched = self.touched(delta, now)
        if not touched:
            return replace(now, version=now.version + 1)
        part = self._rows(now, touched)
        held = self._write(merge(part, delta).select(*part.columns), now.keys, now.buckets)
        return replace(now, version=now.version + 1, held={**{b: p for b, p in now.held.items() if b not in touched}, **held})

    def change(self, delta: DataFrame, merge: Merge) -> Manifest:
        """Merge a delta with unique keys: ``merge(part, delta)`` gives the new content of the buckets that the delta touches."""
        made = self._staged(self.manifest(), delta, merge)
        self._publish(made)
        return made

    def run(self, statements: Sequence[Callable[[DataFrame], tuple[DataFrame, Merge]]]) -> Manifest:
        """Several statements as one change. Each is given the table as those before it left it, and returns a delta and a merge. Only
        what the last one leaves is published: readers see all of them or none."""
        start = now = self.manifest()
        for statement in statements:
            now = self._staged(now, *statement(self._rows(now)))
        made = replace(now, version=start.version + 1)
        self._publish(made)
        return made

    def forget(self) -> int:
        """Delete all versions but the newest, with every folder that it does not name; returns how many folders went. Not while another
        writer is at work: its folders are not named yet."""
        now = self.manifest()
        gone = [s.getPath() for s in self._fs.globStatus(self._path(f"{self.path}/data/wf_place=*")) or []]
        gone = [f for f in gone if f.getName().split("=")[1] not in now.held.values()]
        for version in self._versions()[:-1]:
            self._fs.delete(self._path(f"{self.path}/_manifests/{version}.json"), False)
        for place in set(now.held.values()):  # a folder still in use may hold buckets that were rewritten elsewhere
            for s in self._fs.globStatus(self._path(f"{self.path}/data/wf_place={place}/wf_bucket=*")) or []:
                if now.held.get(int(s.getPath().getName().split("=")[1])) != place:
                    gone.append(s.getPath())
        for folder in gone:
            self._fs.delete(folder, True)
        return len(gone)

    # -- loads -------------------------------------------------------------------------------------------------------------------------

    def load(self, name: str, rows: DataFrame, merge: Merge) -> dict:
        """A named load, once: one that the ledger has is not run again. It is published only if all its keys are found in what it left."""
        now = self.manifest()
        done = [x for x in now.loads if x["name"] == name]
        if done:
            return done[0]
        offered = rows.count()
        made = self._staged(now, rows, merge)
        found = self._rows(made, self.touched(rows, now)).join(rows.select(*now.keys), now.keys, "left_semi").count()
        if found != offered:
            raise ValueError(f"load {name}: {offered} rows offered, {found} found")
        entry = {"name": name, "offered": offered, "found": found, "version": made.version}
        self._publish(replace(made, loads=[*now.loads, entry]))
        return entry

    def ledger(self) -> DataFrame:
        """(name, offered, found, version) of every load."""
        rows = [(x["name"], x["offered"], x["found"], x["version"]) for x in self.manifest().loads]
        return self.spark.createDataFrame(rows, "name string, offered long, found long, version int")


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def materialise(table: VersionedTable, source: DataFrame, keys: Sequence[str], column: str, merge: Merge, *, buckets: int = BUCKETS, full: bool = False) -> Manifest:
    """A model kept incrementally: the first run, or a full one into a new place, takes all rows; later runs those after the table's
    latest ``column``."""
    if full or not table._versions():
        return table.create(source, keys, buckets)
    return table.change(rows_after_max(source, table.read(), column), merge)
