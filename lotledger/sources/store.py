"""A site's listing table that runs change while others read it.

A folder holds merged rows in files by hash bucket of the key (`base`), what batches
added since (`log`: inserted rows, and narrow rows of links seen again), and numbered
manifests. A manifest names all that counts, together with the state of the run;
it is written last. What no manifest names doesn't exist for readers, so a job that dies
half-way leaves the version before it in place.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from lotledger.operators.joins import KEY
from lotledger.operators.merge import MANDATORY, PRICE, Run, merge_run

_BUCKET = re.compile(r"_(\d{5})\.c\d{3}")


@dataclass(frozen=True)
class RunState:
    """What a run has met so far: new links tried, and of the inserted rows how many have each mandatory column."""

    run: int = 0
    attempted: int = 0
    filled: dict[str, int] = field(default_factory=dict)

    def plus(self, run: int, attempted: int, filled: dict[str, int]) -> RunState:
        """The state after a batch; the first batch of another run starts anew."""
        old = self if self.run == run else RunState(run)
        return RunState(run, old.attempted + attempted, {c: old.filled.get(c, 0) + n for c, n in filled.items()})

    def bad_fields(self, mandatory: Sequence[str]) -> list[str]:
        return [c for c in mandatory if self.attempted and not self.filled.get(c, 0)]


@dataclass(frozen=True)
class Manifest:
    """One version of the table. `batches` has the last batch of each run that is not closed."""

    version: int = 0
    buckets: int = 0
    base: str | None = None
    files: tuple[str, ...] = ()
    inserts: tuple[str, ...] = ()
    touches: tuple[str, ...] = ()
    batches: dict[str, int] = field(default_factory=dict)
    state: RunState = field(default_factory=RunState)
    iteration_id: int = 0
    bad_fields: tuple[str, ...] = ()

    def folders(self) -> set[str]:
        return {*self.inserts, *self.touches, *([self.base] if self.base else [])}


class Store:
    """The table of one site under `root`. `schema` is that of its rows, run columns included.

    `buckets` counts for a new table only. A join with a large batch leaves the stored rows where they
    are if there are as many buckets as shuffle partitions or more.
    """

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, buckets: int | None = None, key: str = KEY, fold_after: int = 16):
        self.spark, self.root, self.key, self.fold_after = spark, root.rstrip("/"), key, fold_after
        self.schema = T.StructType([T.StructField(f.name, f.dataType) for f in schema])
        self.meta = T.StructType([self.schema[c] for c in (key, "iteration_id", "parse_date")])
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self._jvm = spark.sparkContext._jvm
        self._files = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # Manifests

    def _path(self, where: str):
        return self._jvm.org.apache.hadoop.fs.Path(where)

    def versions(self) -> list[int]:
        folder = self._path(f"{self.root}/manifest")
        if not self._files.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._files.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if re.fullmatch(r"\d{12}\.json", n))

    def manifest(self, version: int | None = None) -> Manifest:
        """The given version, or the last that was committed (an empty one if there is none)."""
        if version is None:
            known = self.versions()
            if not known:
                return Manifest(buckets=self.buckets)
            version = known[-1]
        stream = self._files.open(self._path(f"{self.root}/manifest/{version:012d}.json"))
        try:
            told = json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        told["state"] = RunState(**told["state"])
        return Manifest(**{k: tuple(v) if isinstance(v, list) else v for k, v in told.items()})

    def commit(self, manifest: Manifest) -> Manifest:
        """Make this the current version. It fails if another job has committed since it was read."""
        target = self._path(f"{self.root}/manifest/{manifest.version:012d}.json")
        draft = self._path(f"{self.root}/manifest/_{uuid.uuid4().hex}")
        out = self._files.create(draft, False)
        try:
            out.write(bytearray(json.dumps(asdict(manifest)).encode()))
        finally:
            out.close()
        if self._files.exists(target) or not self._files.rename(draft, target):
            self._files.delete(draft, False)
            raise RuntimeError(f"version {manifest.version} of {self.root} was committed by another job")
        return manifest

    def vacuum(self, keep: int = 2) -> None:
        """Delete manifests but the last `keep`, and what they named and none of these does."""
        versions = self.versions()
        old, live = versions[:-keep], set()
        for v in versions[-keep:]:
            live |= self.manifest(v).folders()
        for v in old:
            dead = self.manifest(v).folders() - live
            for folder in dead:
                self._files.delete(self._path(f"{self.root}/{folder}"), True)
            self._files.delete(self._path(f"{self.root}/manifest/{v:012d}.json"), False)

    # Reading

    def bucket(self, manifest: Manifest) -> Column:
        """The bucket of a key, as the writer of bucketed files deals it."""
        return F.pmod(F.hash(self.key), F.lit(manifest.buckets))

    def base(self, manifest: Manifest) -> DataFrame:
        """The merged rows, known to be dealt by key: joins on the key don't shuffle them."""
        if manifest.base is None:
            return self.spark.createDataFrame([], self.schema)
        name = f"lotledger_{uuid.uuid4().hex}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema)
        self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`) INTO {manifest.buckets} BUCKETS LOCATION '{self.root}/{manifest.base}'")
        try:
            return self.spark.table(name)
        finally:
            self.spark.sql(f"DROP TABLE {name}")

    def _log(self, folders: Sequence[str], schema: T.StructType) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{f}" for f in folders])

    def rows(self, manifest: Manifest | None = None) -> DataFrame:
        """Each listing of a version once, with its latest run columns."""
        manifest = manifest or self.manifest()
        base, added = self.base(manifest), self._log(manifest.inserts, self.schema)
        if not manifest.touches:
            return base.unionByName(added) if manifest.inserts else base
        latest = self._log(manifest.touches, self.meta).groupBy(self.key).agg(F.max(F.struct("iteration_id", "parse_date")).alias("_t"))

        def touched(rows: DataFrame) -> DataFrame:
            last = F.greatest(F.struct("iteration_id", "parse_date"), F.col("_t"))
            return rows.join(latest, self.key, "left").select(*[last[c].alias(c) if c in ("iteration_id", "parse_date") else F.col(c) for c in self.schema.fieldNames()])

        # Apart, so that the stored rows keep their buckets.
        return touched(base).unionByName(touched(added)) if manifest.inserts else touched(base)

    def keys_of(self, batch: DataFrame, manifest: Manifest) -> DataFrame:
        """Stored keys among which those of the batch are: of the merged rows only files of the batch's buckets are opened."""
        wanted = {r[0] for r in batch.select(self.bucket(manifest)).distinct().collect()}
        files = [f"{self.root}/{manifest.base}/{f}" for f in manifest.files if int(_BUCKET.search(f)[1]) in wanted]
        only = T.StructType([self.schema[self.key]])
        added = self._log(manifest.inserts, only)
        return self.spark.read.schema(only).parquet(*files).unionByName(added) if files else added

    # Writing

    def _write_base(self, rows: DataFrame, buckets: int) -> tuple[str, tuple[str, ...]]:
        folder, name = f"base/{uuid.uuid4().hex}", f"lotledger_{uuid.uuid4().hex}"
        writer = rows.select(*self.schema.fieldNames()).write.format("parquet").bucketBy(buckets, self.key).sortBy(self.key)
        # A file whose filter has none of a few wanted keys is not read beyond it.
        writer.option(f"parquet.bloom.filter.enabled#{self.key}", "true").option("path", f"{self.root}/{folder}").saveAsTable(name)
        self.spark.sql(f"DROP TABLE {name}")
        names = [s.getPath().getName() for s in self._files.listStatus(self._path(f"{self.root}/{folder}"))]
        return folder, tuple(sorted(n for n in names if n.endswith(".parquet")))

    def publish(self, rows: DataFrame, run: Run, bad_fields: Sequence[str], manifest: Manifest | None = None) -> Manifest:
        """The next version is these rows and the control values of the run that made them; both change at once."""
        manifest = manifest or self.manifest()
        base, files = self._write_base(rows, manifest.buckets)
        return self.commit(Manifest(manifest.version + 1, manifest.buckets, base, files, iteration_id=run.iteration_id, bad_fields=tuple(bad_fields)))

    def merge(self, batch: DataFrame, run: Run, bad_fields: Sequence[str] = (), change_price: bool = False, price: str = PRICE) -> Manifest:
        """Touch and insert the batch (a row per link, with the table's columns) and publish the result."""
        manifest = self.manifest()
        return self.publish(merge_run(self.rows(manifest), batch, run, change_price, self.key, price), run, bad_fields, manifest)

    def applied(self, run: Run, batch_id: int, manifest: Manifest) -> bool:
        """Whether a batch is in the table already. A closed run takes no more batches."""
        if run.iteration_id <= manifest.iteration_id:
            raise ValueError(f"run {run.iteration_id} of {self.root} is closed")
        return batch_id <= manifest.batches.get(str(run.iteration_id), -1)

    def add(self, inserted: DataFrame, touched: DataFrame, attempted: int, run: Run, batch_id: int, manifest: Manifest, mandatory: Sequence[str] = MANDATORY) -> Manifest:
        """A batch's inserted rows and touched links as the next version; every `fold_after` batches the log is folded."""
        new, seen = (f"log/{kind}-{uuid.uuid4().hex}" for kind in ("new", "seen"))
        inserted.select(*self.schema.fieldNames()).write.parquet(f"{self.root}/{new}")
        touched.select(*self.meta.fieldNames()).write.parquet(f"{self.root}/{seen}")
        rows = self._log([new], self.schema)
        known = [c for c in mandatory if c in self.schema.fieldNames()]
        counts = rows.agg(F.count("*"), *[F.count(c) for c in known]).first()
        filled = {c: 0 for c in mandatory} | dict(zip(known, counts[1:]))
        out = self.commit(replace(
            manifest, version=manifest.version + 1,
            inserts=(*manifest.inserts, *([new] if counts[0] else [])), touches=(*manifest.touches, seen),
            batches=manifest.batches | {str(run.iteration_id): batch_id}, state=manifest.state.plus(run.iteration_id, attempted, filled),
        ))
        return self.fold(out) if len(out.touches) >= self.fold_after else out

    def fold(self, manifest: Manifest | None = None, keep: int = 2) -> Manifest:
        """Merge the log into the base; what batches have been applied stays known."""
        manifest = manifest or self.manifest()
        if not manifest.inserts and not manifest.touches:
            return manifest
        base, files = self._write_base(self.rows(manifest), manifest.buckets)
        out = self.commit(replace(manifest, version=manifest.version + 1, base=base, files=files, inserts=(), touches=()))
        self.vacuum(keep)
        return out

    def close(self, run: Run, mandatory: Sequence[str] = MANDATORY) -> Manifest:
        """End a streamed run: its control values, from the counts of all its batches, and the folded table become current together."""
        manifest = self.manifest()
        state = manifest.state if manifest.state.run == run.iteration_id else RunState(run.iteration_id)
        closed = {"iteration_id": run.iteration_id, "bad_fields": tuple(state.bad_fields(mandatory)), "batches": {}, "state": RunState()}
        if manifest.inserts or manifest.touches:
            base, files = self._write_base(self.rows(manifest), manifest.buckets)
            closed |= {"base": base, "files": files, "inserts": (), "touches": ()}
        out = self.commit(replace(manifest, version=manifest.version + 1, **closed))
        self.vacuum()
        return out

    def control(self, site: str) -> DataFrame:
        """The control row (site_name, iteration_id, bad_fields) of the current version; none before the first run is closed."""
        m = self.manifest()
        rows = [(site, m.iteration_id, list(m.bad_fields))] if m.iteration_id else []
        return self.spark.createDataFrame(rows, "site_name string, iteration_id bigint, bad_fields array<string>")
