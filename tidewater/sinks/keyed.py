"""Keyed tables that grow: a log of deltas over buckets that split as they fill.

A table holds one row per key.  A commit appends a batch's rows, by bucket, as a
delta; a reader combines a key's rows (sum, max, ...).  So what a commit writes
follows the batch, not the table.  A bucket with too many deltas is compacted into
one piece in the commit that finds it so, and one with too many rows is split by
further bits of the key's hash (extendible hashing): buckets stay bounded however
far the table grows, and nothing but the full bucket is rewritten.

A manifest (a small JSON file per version) names the folders of every bucket and
the last batch.  Data is written first, then the manifest appears by a rename: a
commit that dies leaves the old table, a replayed batch finds itself applied.
There is one writer at a time, as with a streaming query.
"""

from __future__ import annotations

import json
import math
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.session import delete_path

#: Rows and deltas that a bucket may hold.
BUCKET_ROWS = 1_000_000
DELTAS = 8
#: Bits of the hash that a bucket has at most: the directory has two to that many entries.
DEEPEST = 20

COMBINE = {"sum": F.sum, "max": F.max, "min": F.min, "any": F.any_value}


class KeyedTable:
    """The table under ``path``.  ``combine`` names, for every column but the keys, how
    rows of one key become one; it is stored with the table, so readers need neither."""

    def __init__(self, spark: SparkSession, path: str, keys=None, combine: dict[str, str] | None = None,
                 bucket_rows: int = BUCKET_ROWS, deltas: int = DELTAS):
        self.spark, self.path = spark, path.rstrip("/")
        self.keys = [keys] if isinstance(keys, str) else list(keys or [])
        self.combine, self.bucket_rows, self.deltas = combine or {}, bucket_rows, deltas
        self._fs, self._jvm = None, spark.sparkContext._jvm
        found = self.manifest()
        if found:
            self.keys, self.combine = found["keys"], found["combine"]

    # ------------------------------------------------------------ manifests

    def _path(self, name: str):
        path = self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        if self._fs is None:
            self._fs = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return path

    def _names(self, folder: str) -> list[str]:
        path = self._path(folder)
        return sorted(f.getPath().getName() for f in self._fs.listStatus(path)) if self._fs.exists(path) else []

    def versions(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self._names("manifest") if n.endswith(".json") and not n.startswith((".", "_")))

    def _load(self, version: int) -> dict:
        stream = self._fs.open(self._path(f"manifest/{version:012d}.json"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def manifest(self, before: int | None = None) -> dict | None:
        """The newest manifest; with ``before``, the newest that a batch before it left."""
        for version in reversed(self.versions()):
            found = self._load(version)
            if before is None or found["batch"] is None or found["batch"] < before:
                return found
        return None

    def _publish(self, manifest: dict) -> None:
        """The manifest appears whole or not at all; a version exists once."""
        draft = self._path(f"manifest/.draft-{uuid.uuid4().hex}")
        out = self._fs.create(draft, True)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        name = self._path(f"manifest/{manifest['version']:012d}.json")
        if self._fs.exists(name) or not self._fs.rename(draft, name):
            raise RuntimeError(f"another writer committed version {manifest['version']} of {self.path}")

    def vacuum(self, keep: int = 2) -> None:
        """Remove manifests but the last ``keep``, and data that none of these names
        (also that of commits that died)."""
        versions = self.versions()
        held = {f.split("/")[0] for v in versions[-keep:] for b in self._load(v)["buckets"] for f in b["folders"]}
        for v in versions[:-keep]:
            self._fs.delete(self._path(f"manifest/{v:012d}.json"), False)
        for name in self._names("data"):
            if name not in held:
                delete_path(self.spark, f"{self.path}/data/{name}")

    # ------------------------------------------------------------ buckets

    @staticmethod
    def _id(depth: int, bits: int) -> int:
        return (1 << depth) | bits

    def _bucket(self, buckets: list[dict]) -> Column:
        """Bucket of a row: looked up by the low bits of the key's hash in a directory of
        two to the deepest bucket's depth entries (2,048 for a billion keys)."""
        depth = max(b["depth"] for b in buckets)
        directory = [0] * (1 << depth)
        for b in buckets:
            for i in range(b["bits"], 1 << depth, 1 << b["depth"]):
                directory[i] = self._id(b["depth"], b["bits"])
        slot = F.pmod(F.xxhash64(*self.keys), F.lit(1 << depth)).cast("int") + 1
        return F.element_at(F.expr(f"array({', '.join(map(str, directory))})"), slot)

    def _fitting(self, rows: DataFrame, targets: list[dict]) -> list[dict]:
        """The targets, split further until none of them gets more of ``rows`` than it may
        hold: the hash fills them evenly only on average."""
        while True:
            sizes = {r[0]: r[1] for r in rows.groupBy(self._bucket(targets)).count().collect()}  # a row per bucket
            full = [b for b in targets if sizes.get(self._id(b["depth"], b["bits"]), 0) > self.bucket_rows and b["depth"] < DEEPEST]
            if not full:
                return targets
            targets = [b for b in targets if b not in full] + [
                {**b, "depth": b["depth"] + 1, "bits": b["bits"] | i << b["depth"]} for b in full for i in range(2)]

    def _combined(self, df: DataFrame, schema: T.StructType | None = None) -> DataFrame:
        """One row per key, in the stored types (those of the first commit's sums)."""
        out = df.groupBy(*self.keys).agg(*(COMBINE[how](c).alias(c) for c, how in self.combine.items()))
        return out.select(*(F.col(f.name).cast(f.dataType) for f in schema.fields)) if schema else out

    def _rows(self, manifest: dict | None, buckets: list[dict]) -> DataFrame:
        folders = [f"{self.path}/data/{f}" for b in buckets for f in b["folders"]]
        schema = T.StructType.fromJson(manifest["schema"])
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def read(self, before: int | None = None, touching: DataFrame | None = None) -> DataFrame:
        """One row per key: the newest table, or as it was ``before`` a batch.  With
        ``touching``, only the buckets that the keys of that table fall into are read."""
        manifest = self.manifest(before)
        if manifest is None:
            raise FileNotFoundError(f"no keyed table at {self.path}" + (f" before batch {before}" if before is not None else ""))
        buckets = manifest["buckets"]
        if touching is not None and len(buckets) > 1:
            asked = {r[0] for r in touching.select(self._bucket(buckets)).distinct().collect()}  # a row per bucket
            buckets = [b for b in buckets if self._id(b["depth"], b["bits"]) in asked]
        rows = self._rows(manifest, buckets)
        return rows if all(len(b["folders"]) < 2 for b in buckets) else self._combined(rows, rows.schema)

    # ------------------------------------------------------------ commits

    def append(self, batch: DataFrame, batch_id: int | None = None) -> bool:
        """Commit a batch.  False if it (or a later one) was committed before."""
        old = self.manifest()
        if old is not None and batch_id is not None and old["batch"] is not None and old["batch"] >= batch_id:
            return False
        columns = [*self.keys, *self.combine]
        schema = T.StructType.fromJson(old["schema"]) if old else self._combined(batch).schema
        buckets = old["buckets"] if old else [{"depth": 0, "bits": 0, "rows": 0, "folders": []}]
        commit = uuid.uuid4().hex
        fresh, full = self._combined(batch, schema).persist(), None
        try:
            new = {r[0]: r[1] for r in fresh.groupBy(self._bucket(buckets)).count().collect()}  # a row per bucket
            if not new and old is not None:
                self._publish({**old, "version": old["version"] + 1, "batch": batch_id if batch_id is not None else old["batch"],
                               "written": 0})
                return True
            kept, targets, rewritten = [], [], []
            for b in buckets:
                rows = b["rows"] + new.get(self._id(b["depth"], b["bits"]), 0)
                split = max(0, math.ceil(math.log2(rows / (0.7 * self.bucket_rows)))) if rows > self.bucket_rows else 0
                if split or (len(b["folders"]) >= self.deltas and rows > b["rows"]):
                    rewritten.append(b)
                    targets += [{"depth": b["depth"] + split, "bits": b["bits"] | i << b["depth"], "rows": 0, "folders": []}
                                for i in range(1 << split)]
                else:
                    kept.append(b)
            gone = [self._id(b["depth"], b["bits"]) for b in rewritten]
            rows = fresh.select(*columns)
            if rewritten:
                was = self._bucket(buckets)
                full = rows.filter(was.isin(gone))
                if old is not None:
                    full = full.unionByName(self._rows(old, rewritten).select(*columns))
                full = self._combined(full, schema).persist()
                targets = self._fitting(full, targets)
                rows = rows.filter(~was.isin(gone)).unionByName(full)
            after = kept + targets
            # A bucket's rows of a commit go into one file: they are bounded, since full buckets are split first.
            (rows.withColumn("bucket", self._bucket(after)).repartition("bucket")
             .write.partitionBy("bucket").parquet(f"{self.path}/data/{commit}"))
        finally:
            fresh.unpersist()
            if full is not None:
                full.unpersist()
        sizes = {r[0]: r[1] for r in self.spark.read.parquet(f"{self.path}/data/{commit}").groupBy("bucket").count().collect()}
        out = []
        for b in after:
            name = self._id(b["depth"], b["bits"])
            more = [f"{commit}/bucket={name}"] if name in sizes else []
            out.append({**b, "rows": b["rows"] + sizes.get(name, 0), "folders": b["folders"] + more})
        self._publish({"version": old["version"] + 1 if old else 0, "batch": batch_id if batch_id is not None else (old or {}).get("batch"),
                       "keys": self.keys, "combine": self.combine, "schema": schema.jsonValue(), "buckets": out, "written": sum(sizes.values())})
        self.vacuum()
        return True

    def insert_absent(self, batch: DataFrame, order_cols=None, batch_id: int | None = None) -> bool:
        """Commit the first row per key of the batch, of keys the table does not hold."""
        from tidewater.operators.curate import first_per_key
        fresh = first_per_key(batch, self.keys, order_cols or self.keys)
        if self.manifest() is not None:
            held = self.read(touching=fresh).select(*(F.col(k).alias(f"held_{k}") for k in self.keys))
            same = [F.col(k).eqNullSafe(F.col(f"held_{k}")) for k in self.keys]
            fresh = fresh.join(held, same, "left_anti")
        return self.append(fresh, batch_id)


def read_keyed(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the keyed table at ``path``."""
    return KeyedTable(spark, path).read()
