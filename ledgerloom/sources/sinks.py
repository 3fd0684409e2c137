"""Writing read models, the append-only ledger and exports."""

from __future__ import annotations

import json
import time
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Folders of ids that the ledger's index is split into.
ID_BUCKETS = 64


class _Files:
    """Whole files and folders of any file system that Spark knows."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.conf, self.path = spark._jvm, spark._jsc.hadoopConfiguration(), path.rstrip("/")
        self.system = self._at("").getFileSystem(self.conf)

    def _at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, name: str = "") -> list[str]:
        """What lies in a folder; nothing if there is none."""
        at = self._at(name)
        return sorted(f.getPath().getName() for f in self.system.listStatus(at)) if self.system.exists(at) else []

    def exists(self, name: str) -> bool:
        return self.system.exists(self._at(name))

    def age(self, name: str) -> float:
        """Seconds since something was last changed."""
        return time.time() - self.system.getFileStatus(self._at(name)).getModificationTime() / 1000

    def read(self, name: str) -> str:
        stream = self.system.open(self._at(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        stream = self.system.create(self._at(name), True)
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()

    def move(self, source: str, target: str) -> bool:
        """Give something its name in one step; False if the name is taken."""
        self.system.mkdirs(self._at(target).getParent())
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.system.getUri(), self.conf)
        options = self.jvm.java.lang.reflect.Array.newInstance(
            self.jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 0)
        try:
            context.rename(self._at(source), self._at(target), options)
        except Exception:  # the name was taken meanwhile, or else there is a fault to show
            if self.exists(target):
                return False
            raise
        return True

    def drop(self, name: str) -> None:
        self.system.delete(self._at(name), True)


def _latest(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    columns = [c for c in df.columns if c not in keys]
    row = F.struct(*columns)
    # Equal versions are settled by the whole row, so any order of arrival gives one result.
    last = F.max_by(row, F.struct(order, *[c for c in columns if c != order]))
    return df.groupBy(*keys).agg(last.alias("row")).select(*keys, "row.*")


def upsert_read_model(
    batch_df: DataFrame, batch_id: int, path: str, keys: list[str], order: str, writer: str = "main"
) -> None:
    """Store the latest row per key of a batch.

    Each batch is a folder of its own, found by writer and batch id, that gets its name when all of it is
    written, so the cost follows the batch and not the table. A batch that comes again is left as it is, also after it
    has been folded into a generation. `read_model` merges generation and batches; the highest
    ``order`` wins, whenever it arrived.
    """
    files = _Files(batch_df.sparkSession, path)
    name = f"batches/{writer}/{batch_id}"
    if files.exists(name) or _holds(_manifest(files)[1]["folded"], writer, batch_id):
        return
    # Hidden from readers and from `compact_read_model` until it is moved.
    making = f"_making/{uuid.uuid4().hex}"
    _latest(batch_df, keys, order).write.parquet(f"{files.path}/{making}")
    if not files.move(making, name):
        files.drop(making)


def _manifest(files: _Files) -> tuple[int, dict]:
    """Number and content of the latest manifest: the live generation, and the batches folded into it."""
    numbers = [int(name) for name in files.names("manifests") if name.isdigit()]
    if not numbers:
        return 0, {"generation": None, "folded": {}}
    return max(numbers), json.loads(files.read(f"manifests/{max(numbers):012d}"))


def _holds(folded: dict[str, list], writer: str, batch_id: int) -> bool:
    return any(low <= batch_id <= high for low, high in folded.get(writer, ()))


def _snapshot(files: _Files) -> tuple[int, dict, list[tuple[str, int]]]:
    """The latest manifest, and the batches after it."""
    while True:
        number, manifest = _manifest(files)
        batches = [
            (writer, int(batch)) for writer in files.names("batches") for batch in files.names(f"batches/{writer}")
            if not _holds(manifest["folded"], writer, int(batch))
        ]
        # Batches listed while another generation went live may have been folded: look again.
        if _manifest(files)[0] == number:
            return number, manifest, batches


def _merged(spark: SparkSession, files: _Files, keys: list[str], order: str) -> tuple[DataFrame, int, dict, list]:
    number, manifest, batches = _snapshot(files)
    paths = [f"{files.path}/batches/{writer}/{batch}" for writer, batch in batches]
    if manifest["generation"]:
        paths.append(f"{files.path}/generations/{manifest['generation']}")
    if not paths:
        raise FileNotFoundError(f"no read model at {files.path}")
    return _latest(spark.read.parquet(*paths), keys, order), number, manifest, batches


def read_model(spark: SparkSession, path: str, keys: list[str], order: str) -> DataFrame:
    """The read model: latest row per key over the live generation and the batches after it.

    What is live is settled here; a compaction while the rows are read changes nothing.
    """
    return _merged(spark, _Files(spark, path), keys, order)[0]


def compact_read_model(spark: SparkSession, path: str, keys: list[str], order: str) -> bool:
    """Fold the batches there are into a new generation, while writers and readers go on.

    The generation becomes live when its manifest gets the next number, in one step. Of two compactions at
    once one wins; the other returns False, and nothing is lost. Replaced files stay until `vacuum_read_model`.
    """
    files = _Files(spark, path)
    merged, number, manifest, batches = _merged(spark, files, keys, order)
    if not batches:
        return True
    generation = uuid.uuid4().hex
    merged.write.parquet(f"{files.path}/generations/{generation}")
    folded = {writer: [tuple(run) for run in runs] for writer, runs in manifest["folded"].items()}
    for writer in {writer for writer, _ in batches}:
        held = [*folded.get(writer, ()), *((batch, batch) for w, batch in batches if w == writer)]
        runs: list[list[int]] = []
        for low, high in sorted(held):
            if runs and low <= runs[-1][1] + 1:
                runs[-1][1] = max(runs[-1][1], high)
            else:
                runs.append([low, high])
        folded[writer] = runs
    files.write(f"_making/{generation}", json.dumps({"generation": generation, "folded": folded}))
    if files.move(f"_making/{generation}", f"manifests/{number + 1:012d}"):
        return True
    files.drop(f"_making/{generation}")
    files.drop(f"generations/{generation}")
    return False


def vacuum_read_model(spark: SparkSession, path: str, keep_seconds: float = 86_400) -> None:
    """Delete generations and batches that were replaced so long ago, and what was begun then and never finished.

    A reader or compaction that began longer ago than that may fail; nothing that is live is touched.
    """
    files = _Files(spark, path)

    def old(name: str) -> bool:
        return files.age(name) >= keep_seconds

    numbers = sorted(int(name) for name in files.names("manifests") if name.isdigit())
    # What the latest of the old manifests does not name was replaced before it.
    settled = max((n for n in numbers if old(f"manifests/{n:012d}")), default=None)
    if settled is not None:
        kept = {n: json.loads(files.read(f"manifests/{n:012d}")) for n in numbers if n >= settled}
        live = {manifest["generation"] for manifest in kept.values()}
        for name in files.names("generations"):
            if name not in live and old(f"generations/{name}"):
                files.drop(f"generations/{name}")
        for writer in files.names("batches"):
            for batch in files.names(f"batches/{writer}"):
                if _holds(kept[settled]["folded"], writer, int(batch)):
                    files.drop(f"batches/{writer}/{batch}")
        for n in numbers:
            if n < settled:
                files.drop(f"manifests/{n:012d}")
    for name in files.names("_making"):
        if old(f"_making/{name}"):
            files.drop(f"_making/{name}")


def _id(key: str) -> Column:
    """An id as text: whole numbers of any width are the same id."""
    return F.col(f"`{key}`").cast("string")


def _bucket(key: str) -> Column:
    return F.pmod(F.xxhash64(_id(key)), F.lit(ID_BUCKETS)).cast("int")


def _indexed(spark: SparkSession, files: _Files, buckets: list[int] | None = None) -> DataFrame:
    """Stored ids, of some buckets of the index only."""
    schema = "`stored/key` string, bucket int"
    chosen = [b for b in files.names("_ids") if b.startswith("bucket=")] if buckets is None else [
        f"bucket={b}" for b in buckets if files.exists(f"_ids/bucket={b}")]
    if not chosen:
        return spark.createDataFrame([], schema).select("stored/key")
    return spark.read.schema(schema).option("basePath", f"{files.path}/_ids").parquet(
        *[f"{files.path}/_ids/{name}" for name in chosen]).select("stored/key")


def _index(rows: DataFrame, files: _Files, key: str) -> None:
    """Append ids to the index."""
    rows.select(_id(key).alias("stored/key"), _bucket(key).alias("bucket")).distinct().hint("rebalance", "bucket").write.mode(
        "append").partitionBy("bucket").parquet(f"{files.path}/_ids")


def _unknown(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return rows.join(ids, _id(key).eqNullSafe(F.col("`stored/key`")), "left_anti")


def append_ledger(df: DataFrame, path: str, key: str = "entry_id", period: str = "period_id") -> None:
    """Append posted rows; entries already stored, in whatever period or none, are left as they are.

    An entry is stored or skipped as a whole. Ids are looked up in an index beside the ledger, split by a hash
    of the id: a batch reads the buckets of its own ids, not the ledger. A mark stands while rows and index are
    written; where it is found, or no index, the ids are taken from the ledger again first. One writer at a time.
    """
    spark = df.sparkSession
    files = _Files(spark, path)
    if any(not name.startswith("_") for name in files.names()) and (files.exists("_appending") or not files.exists("_ids")):
        stored = spark.read.schema(T.StructType([df.schema[key]])).parquet(path)
        _index(_unknown(stored, _indexed(spark, files), key), files, key)
        if files.exists("_appending"):
            files.drop(files.read("_appending"))
            files.drop("_appending")
    buckets = [row[0] for row in df.select(_bucket(key)).distinct().collect()]
    # The batch is looked at twice, for its rows and their ids: what is fresh is settled once.
    fresh = _unknown(df, _indexed(spark, files, buckets), key)
    making = f"_making/{uuid.uuid4().hex}"
    fresh.write.parquet(f"{files.path}/{making}")
    fresh = spark.read.schema(df.schema).parquet(f"{files.path}/{making}")
    files.write("_appending", making)
    fresh.hint("rebalance", period).write.mode("append").partitionBy(period).parquet(path)
    _index(fresh, files, key)
    files.drop("_appending")
    files.drop(making)


def _loads(files: _Files) -> list[str]:
    """Folders of a roll-up that count: those whose numbers no other covers."""
    ranges = sorted((tuple(map(int, name.split("-"))) for name in files.names("loads")), key=lambda r: (r[0], -r[1]))
    out: list[tuple[int, int]] = []
    for low, high in ranges:
        if not out or high > out[-1][1]:
            out.append((low, high))
    return [f"{low:09d}-{high:09d}" for low, high in out]


def fold_rollup(
    lines: DataFrame, path: str, dimensions: list[str], measures: list[str], key: str = "entry_id", tries: int = 5
) -> None:
    """Add the lines of entries not yet in to figures kept by ``dimensions``; late periods are figures like others.

    A load is one folder with the sums it adds and the ids it brings, in buckets, that gets its number in one step. An
    entry is in or out as a whole, whatever was lost or comes again; of two loads at once one has the number, and
    the other looks again at what is known. Reads the ids of the batch's buckets, never the ledger or the figures.
    """
    spark = lines.sparkSession
    files = _Files(spark, path)
    buckets = [row[0] for row in lines.select(_bucket(key)).distinct().collect()]
    for _ in range(tries):
        loads = _loads(files)
        ids = [f"{files.path}/loads/{load}/ids/bucket={b}" for load in loads for b in buckets if files.exists(f"loads/{load}/ids/bucket={b}")]
        brought = lines.select(_id(key).alias("stored/key"), _bucket(key).alias("bucket")).distinct()
        if ids:
            # Entries are settled first, a narrow row each; lines then meet only the ids that are fresh, often few or none.
            known = spark.read.schema("`stored/key` string").parquet(*ids).withColumnRenamed("stored/key", "known/key")
            brought = brought.join(known, F.col("`stored/key`").eqNullSafe(F.col("`known/key`")), "left_anti")
        making = f"_making/{uuid.uuid4().hex}"
        brought.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{files.path}/{making}/ids")
        fresh = lines
        if ids:
            settled = spark.read.schema("`stored/key` string").parquet(f"{files.path}/{making}/ids").select("stored/key")
            fresh = lines.join(settled, _id(key).eqNullSafe(F.col("`stored/key`")), "left_semi")
        fresh.groupBy(*dimensions).agg(*[F.sum(m).alias(m) for m in measures]).write.parquet(f"{files.path}/{making}/figures")
        number = int(loads[-1].split("-")[1]) + 1 if loads else 0
        if files.move(making, f"loads/{number:09d}-{number:09d}"):
            return
        files.drop(making)
    raise RuntimeError(f"others kept adding to {path}")


def rollup(spark: SparkSession, path: str, dimensions: list[str], measures: list[str]) -> DataFrame:
    """The figures kept by `fold_rollup`: sums over all loads."""
    files = _Files(spark, path)
    parts = [f"{files.path}/loads/{load}/figures" for load in _loads(files)]
    return spark.read.parquet(*parts).groupBy(*dimensions).agg(*[F.sum(m).alias(m) for m in measures])


def compact_rollup(spark: SparkSession, path: str, dimensions: list[str], measures: list[str]) -> bool:
    """Fold all loads into one folder, which covers their numbers from the moment it has its name; replaced ones are left
    for `vacuum_rollup`. False if another compaction was first."""
    files = _Files(spark, path)
    loads = _loads(files)
    if len(loads) < 2:
        return True
    making = f"_making/{uuid.uuid4().hex}"
    figures = spark.read.parquet(*[f"{files.path}/loads/{load}/figures" for load in loads])
    figures.groupBy(*dimensions).agg(*[F.sum(m).cast(figures.schema[m].dataType).alias(m) for m in measures]).write.parquet(
        f"{files.path}/{making}/figures")
    ids = reduce(DataFrame.unionByName, [
        spark.read.schema("`stored/key` string, bucket int").parquet(f"{files.path}/loads/{load}/ids") for load in loads])
    ids.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{files.path}/{making}/ids")
    if files.move(making, f"loads/{loads[0].split('-')[0]}-{loads[-1].split('-')[1]}"):
        return True
    files.drop(making)
    return False


def vacuum_rollup(spark: SparkSession, path: str, keep_seconds: float = 86_400) -> None:
    """Delete loads that a folder of such an age covers, and what was begun then and never finished."""
    files = _Files(spark, path)
    old = [name for name in _loads(files) if files.age(f"loads/{name}") >= keep_seconds]
    covered = [tuple(map(int, name.split("-"))) for name in old]
    for name in files.names("loads"):
        low, high = map(int, name.split("-"))
        if name not in old and any(a <= low and high <= b for a, b in covered):
            files.drop(f"loads/{name}")
    for name in files.names("_making"):
        if files.age(f"_making/{name}") >= keep_seconds:
            files.drop(f"_making/{name}")


def export_table(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Write a table for a warehouse, split by column values.

    Rows are rebalanced by those columns, which gives few files per value and still
    splits a value that holds a large share of the rows.
    """
    rows = df.hint("rebalance", *partition_by) if partition_by else df.hint("rebalance")
    rows.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
