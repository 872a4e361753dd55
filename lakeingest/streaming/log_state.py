"""State tables kept as runs: a batch of changes is written once, runs are merged on read and compacted by size.

``RunTable`` holds rows by key in ``buckets`` (a hash of the key). Applying version ``v`` writes the batch's own rows only, as
a run ``data/_run=<v>/_bucket=<b>``; nothing that is already there is read or written again. Readers merge the runs of a
bucket. When a bucket has ``fan`` runs of similar size they are merged into one of the next size, so a row is rewritten about
log(table / batch) times in all, and a bucket never has more than about ``fan`` runs of each size.

What merging means is up to the subclass, as long as it may be done in any order:

- ``KeyedLog``: the latest change of each key (current state, deletes kept as tombstones);
- ``TotalsLog``: sums of signed changes per group (aggregates that follow updates and deletes).

A manifest per version names the runs of each bucket and is written last. Applying the newest version again (a replayed
micro-batch) starts from the manifest before it and writes the same folders; older versions are refused.
"""

from __future__ import annotations

import json
import logging
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.silver import latest_per_key, orderable
from ..session import delete_path, list_names, read_text, write_text

log = logging.getLogger(__name__)

#: Rows that a file keeps at least when a run is spread over more files than its size needs.
ROWS_OF_SPREAD_FILE = 50_000

Runs = dict[int, list[tuple[str, int]]]
Staged = tuple[DataFrame, dict[int, int]]


def runs_to_merge(runs: list[tuple[str, int]], fan: int) -> list[str]:
    """Names of the runs to merge into one: of the smallest size (power of ``fan``) that has ``fan`` runs, and of the sizes
    above as long as the merged run completes them, too; none if no size has ``fan`` runs."""
    def tier(rows: int) -> int:
        return int(math.log(max(rows, 1), fan) + 1e-9)
    sizes: dict[int, list[tuple[str, int]]] = {}
    for name, rows in runs:
        sizes.setdefault(tier(rows), []).append((name, rows))
    full = [t for t in sorted(sizes) if len(sizes[t]) >= fan]
    if not full:
        return []
    chosen = list(sizes[full[0]])
    while True:
        up = tier(sum(rows for _, rows in chosen))
        more = [r for r in sizes.get(up, []) if r not in chosen]
        if up == full[0] or len(more) + 1 < fan:
            return [name for name, _ in chosen]
        chosen += more
        full[0] = up


class RunTable:
    """Rows by key, kept as runs (see the module)."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], buckets: int = 64, fan: int = 4,
                 rows_per_file: int = 4_000_000):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)
        self.buckets, self.fan, self.rows_per_file = buckets, fan, rows_per_file

    def merge(self, rows: DataFrame) -> DataFrame:
        """One row per key (and bucket) of the rows of several runs; the order of merging must not matter."""
        raise NotImplementedError

    # -- manifest -------------------------------------------------------------
    def versions(self) -> list[int]:
        return sorted(int(n.split(".")[0]) for n in list_names(self.spark, f"{self.path}/_manifest") if n.endswith(".json"))

    def manifest(self, below: int | None = None) -> tuple[int | None, Runs, int]:
        """(version, runs of each bucket, bucket count) of the newest version (below a version)."""
        found = [v for v in self.versions() if below is None or v < below]
        if not found:
            return None, {}, self.buckets
        body = json.loads(read_text(self.spark, f"{self.path}/_manifest/{found[-1]:012d}.json"))
        return found[-1], {int(b): [(n, r) for n, r in runs] for b, runs in body["runs"].items()}, body["buckets"]

    def _folder(self, run: str, bucket: int) -> str:
        return f"{self.path}/data/_run={run}/_bucket={bucket}"

    def _read(self, runs: Runs) -> DataFrame | None:
        paths = [self._folder(name, b) for b, names in sorted(runs.items()) for name, _ in names]
        if not paths:
            return None
        # Later runs may have columns that earlier ones lack: the recorded schema has them all.
        schema = json.loads(read_text(self.spark, f"{self.path}/_schema.json"))
        from pyspark.sql.types import StructType
        return (self.spark.read.option("basePath", f"{self.path}/data").schema(StructType.fromJson(schema)).parquet(*paths)
                .drop("_run"))

    def _record_schema(self, rows: DataFrame) -> None:
        from pyspark.sql.types import StructType

        from ..functions.nested import grow, nullable
        text = read_text(self.spark, f"{self.path}/_schema.json")
        known = StructType.fromJson(json.loads(text)) if text else None
        now = nullable(rows.schema) if known is None else grow(known, rows.schema)
        if now != known:
            write_text(self.spark, f"{self.path}/_schema.json", json.dumps(now.jsonValue()))

    def current(self, below: int | None = None) -> DataFrame | None:
        """The merged rows, with ``_bucket``; as of the version before ``below``, if given."""
        rows = self._read(self.manifest(below)[1])
        return None if rows is None else self.merge(rows)

    # -- apply ----------------------------------------------------------------
    def bucket_of(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in self.keys]), F.lit(self.buckets)).cast("int")

    def _write(self, rows: DataFrame, run: str, total: int, counts: dict[int, int] | None = None) -> dict[int, int]:
        """Write a run, by bucket; rows of each bucket (at most ``buckets`` numbers, counted unless known)."""
        target = f"{self.path}/data/_run={run}"
        # Enough files for every core to write some, unless they would be small.
        spread = min(math.ceil(4 * self.spark.sparkContext.defaultParallelism / self.buckets),
                     total // (self.buckets * ROWS_OF_SPREAD_FILE))
        parts = max(1, math.ceil(total / self.buckets / self.rows_per_file), spread)
        part = F.pmod(F.xxhash64(F.lit("part"), *[F.col(f"`{k}`") for k in self.keys]), F.lit(parts))
        rows.repartition(F.col("_bucket"), part).write.mode("overwrite").partitionBy("_bucket").parquet(target)
        if counts is not None:
            return counts
        if not any(n.startswith("_bucket=") for n in list_names(self.spark, target)):
            return {}
        counts = self.spark.read.schema(rows.schema).parquet(target).groupBy("_bucket").count()
        return {int(r[0]): int(r[1]) for r in counts.collect()}

    def stage(self, changes: DataFrame, version: int) -> Staged:
        """The batch merged to one row per key and staged in the shared folder, with the rows of each bucket: it is read
        several times and made once."""
        known = self.versions()
        if known and version < known[-1]:
            from .sink import CheckpointMismatchError
            raise CheckpointMismatchError(
                f"state {self.path} is at version {known[-1]}; version {version} comes from a reset checkpoint")
        staging = f"{self.path}/_staging/_version={version}"
        rows = self.merge(self.prepared(changes))
        rows.write.mode("overwrite").parquet(staging)
        staged = self.spark.read.schema(rows.schema).parquet(staging)
        return staged, {int(r[0]): int(r[1]) for r in staged.groupBy("_bucket").count().collect()}

    def apply(self, changes: DataFrame, version: int, staged: Staged | None = None) -> None:
        """Add a batch as ``version`` (monotonic, e.g. the batch id); the newest may be applied again.

        ``staged`` is what ``stage`` made of these changes, if it has been called.
        """
        staged, counts = staged or self.stage(changes, version)
        total = sum(counts.values())
        if not total:
            return
        _, runs, count = self.manifest(below=version)
        self._record_schema(staged)
        if runs and count != self.buckets:
            log.info("state %s: %d buckets become %d", self.path, count, self.buckets)
            moved = self._read(runs).withColumn("_bucket", self.bucket_of())
            staged = self.merge(moved.unionByName(staged, allowMissingColumns=True))
            total, runs, counts = total + sum(r for names in runs.values() for _, r in names), {}, None
        for b, n in self._write(staged, str(version), total, counts).items():
            runs.setdefault(b, []).append((str(version), n))
        self._compact(runs, version)
        body = {"buckets": self.buckets, "runs": {str(b): names for b, names in sorted(runs.items())}}
        write_text(self.spark, f"{self.path}/_manifest/{version:012d}.json", json.dumps(body))

    def prepared(self, changes: DataFrame) -> DataFrame:
        return changes.withColumn("_bucket", self.bucket_of())

    def _compact(self, runs: Runs, version: int) -> None:
        """Merge the runs of the buckets that have enough of one size; only those are read and written."""
        chosen: Runs = {}
        for b, names in runs.items():
            merged = set(runs_to_merge(names, self.fan))
            if merged:
                chosen[b] = [r for r in names if r[0] in merged]
        if not chosen:
            return
        rows = self.merge(self._read(chosen))
        written = self._write(rows, f"{version}c", sum(n for names in chosen.values() for _, n in names))
        for b, names in chosen.items():
            runs[b] = [r for r in runs[b] if r not in names] + [(f"{version}c", written.get(b, 0))]
        log.info("state %s: version %d merged the runs of %d bucket(s)", self.path, version, len(chosen))

    # -- retention ------------------------------------------------------------
    def obsolete(self, retain_manifests: int = 2) -> list[str]:
        """Folders and manifests that are not needed once the newest ``retain_manifests`` manifests are kept."""
        versions = self.versions()
        kept = versions[-retain_manifests:] if retain_manifests > 0 else []
        live = {(name, b) for v in kept for b, names in self.manifest(below=v + 1)[1].items() for name, _ in names}
        out = [f"{self.path}/_manifest/{v:012d}.json" for v in versions if v not in kept]
        for run in list_names(self.spark, f"{self.path}/data"):
            for folder in list_names(self.spark, f"{self.path}/data/{run}"):
                if folder.startswith("_bucket=") and (run.split("=", 1)[1], int(folder.split("=", 1)[1])) not in live:
                    out.append(f"{self.path}/data/{run}/{folder}")
        newest = versions[-1] if versions else None
        out += [f"{self.path}/_staging/{n}" for n in list_names(self.spark, f"{self.path}/_staging")
                if n.startswith("_version=") and int(n.split("=", 1)[1]) != newest]
        return sorted(out)

    def vacuum(self, retain_manifests: int = 2, dry_run: bool = False) -> list[str]:
        """Delete what ``obsolete`` lists (unless ``dry_run``); run it between micro-batches."""
        paths = self.obsolete(retain_manifests)
        if not dry_run:
            for p in paths:
                delete_path(self.spark, p)
        return paths


class KeyedLog(RunTable):
    """Current state per key from change records: the last change of a key counts, deletes hide it.

    Deletes are kept as tombstones, so an older change that arrives late cannot bring a key back.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], order_by: Sequence[str], deleted: str | Column,
                 **options):
        super().__init__(spark, path, keys, **options)
        self.order_by = list(order_by)
        self.deleted = F.expr(deleted) if isinstance(deleted, str) else deleted

    def prepared(self, changes: DataFrame) -> DataFrame:
        return changes.withColumns({"_is_deleted": F.coalesce(self.deleted, F.lit(False)), "_bucket": self.bucket_of()})

    def merge(self, rows: DataFrame) -> DataFrame:
        return latest_per_key(rows, [*self.keys, "_bucket"], self.order_by)

    def visible(self, below: int | None = None) -> DataFrame | None:
        rows = self.current(below)
        return None if rows is None else rows.where(~F.col("_is_deleted")).drop("_is_deleted", "_bucket")

    def signed_changes(self, changes: DataFrame, version: int, staged: Staged | None = None) -> DataFrame:
        """What ``version`` changes in the visible rows: the old row of a key with ``_sign`` -1, its new row with +1.

        Only keys of the batch are looked up, in their buckets of the state before ``version``. Keys whose visible row
        stays the same give nothing. ``staged`` is what ``stage`` made of these changes, if it has been called.
        """
        new, touched = staged or self.stage(changes, version)
        _, runs, _ = self.manifest(below=version)
        before = self._read({b: names for b, names in runs.items() if b in touched})
        both = new.withColumn("_new", F.lit(True))
        if before is not None:
            # The hint keeps the keys of a batch off the driver.
            old = before.join(new.select(*self.keys).hint("shuffle_merge"), self.keys, "left_semi")
            both = both.unionByName(old.withColumn("_new", F.lit(False)), allowMissingColumns=True)
        # The order of ``merge``, over the rows before the batch and over all rows: one aggregation finds both.
        names = [c for c in both.columns if c != "_new"]
        ordered = orderable(both, [*self.keys, *self.order_by, "_new"])
        row = F.struct(*[F.col(f"`{c}`") for c in names])
        order = F.struct(*[F.col(f"`{c}`").alias(f"o{i}") for i, c in enumerate(self.order_by + ordered)])
        pairs = both.groupBy(*self.keys).agg(
            F.max_by(row, F.when(~F.col("_new"), order)).alias("old"), F.max_by(row, order).alias("now"))
        # Maps have no equality.
        same = (F.col("old").eqNullSafe(F.col("now")) if len(orderable(both, ["_new"])) == len(names)
                else F.to_json("old") == F.to_json("now"))
        signed = pairs.select(F.explode(F.array(
            F.struct(F.col("old").alias("row"), F.lit(-1).alias("sign")),
            F.struct(F.col("now").alias("row"), F.lit(1).alias("sign")))).alias("s"),
            (F.col("old").isNotNull() & same).alias("still"))
        shown = signed.where("s.row IS NOT NULL AND NOT s.row._is_deleted AND NOT still")
        return shown.select("s.row.*", F.col("s.sign").alias("_sign")).drop("_is_deleted", "_bucket")


class TotalsLog(RunTable):
    """Sums per group that follow signed changes. ``measures`` (name -> expression over a change) are summed times ``_sign``.

    Expressions should be integers or decimals, whose sums are exact in any order; ``_rows`` counts the rows of a group, and
    a group without rows is not shown.
    """

    def __init__(self, spark: SparkSession, path: str, groups: dict[str, Column], measures: dict[str, Column], **options):
        super().__init__(spark, path, list(groups), **options)
        self.groups, self.measures = groups, measures

    def prepared(self, changes: DataFrame) -> DataFrame:
        parts = {name: (value * F.col("_sign")) for name, value in self.measures.items()}
        rows = changes.select(*[c.alias(n) for n, c in self.groups.items()], F.col("_sign").cast("long").alias("_rows"),
                              *[F.coalesce(c, F.lit(0)).alias(n) for n, c in parts.items()])
        return rows.withColumn("_bucket", self.bucket_of())

    def merge(self, rows: DataFrame) -> DataFrame:
        names = ["_rows", *self.measures]
        kinds = {f.name: f.dataType for f in rows.schema.fields}
        return rows.groupBy(*self.keys, "_bucket").agg(*[F.sum(n).cast(kinds[n]).alias(n) for n in names])

    def visible(self) -> DataFrame | None:
        rows = self.current()
        return None if rows is None else rows.where("_rows <> 0").drop("_bucket")


def start_state_stream(changes: DataFrame, state: KeyedLog, checkpoint: str, totals: Sequence[TotalsLog] = (),
                       processing_time: str | None = None, name: str | None = None) -> StreamingQuery:
    """Keep ``state`` and any totals over its visible rows up to date, one version of each per micro-batch.

    The signed changes are made from the state before the batch, and staged if several tables read them; each table takes
    them as its own version.
    A batch that is run again makes the same changes and overwrites the same runs.
    """
    def each(batch: DataFrame, batch_id: int) -> None:
        staged = state.stage(batch, batch_id)
        if totals:
            signed = state.signed_changes(batch, batch_id, staged)
            if len(totals) > 1:         # read by each of them: made once
                at = f"{state.path}/_signed/_version={batch_id}"
                signed.write.mode("overwrite").parquet(at)
                signed = state.spark.read.schema(signed.schema).parquet(at)
            for t in totals:
                t.apply(signed, batch_id)
            for old in list_names(state.spark, f"{state.path}/_signed"):
                if old.startswith("_version=") and old != f"_version={batch_id}":
                    delete_path(state.spark, f"{state.path}/_signed/{old}")
        state.apply(batch, batch_id, staged)

    writer = changes.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(processingTime=processing_time) if processing_time else writer.trigger(availableNow=True)
    return writer.start()
