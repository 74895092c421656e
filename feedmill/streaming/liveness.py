"""Liveness across micro-batches: the live keys as a log-structured table.

What has to outlive a batch is the set of live keys, cut into buckets by a hash.
Next to the stream's checkpoint each bucket has a base, the keys that were live at
some batch, and there are deltas, what later batches made of the keys they touched.

- A batch writes one delta with its own keys and nothing else.
- It reads the buckets that it touches: base and deltas, the newest word on a key counts.
- `FAN` deltas of a level are merged to one of the next level, so that there are few.
- A bucket whose deltas outgrow a part of its base gets a new base; one that has
  grown too large splits all buckets anew.

A manifest per batch, found by the number of the batch, names the files that count.
A batch done again reads the manifest of the batch before and writes the same files.
"""

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedmill.operators.liveness import KEY
from feedmill.sources import files
from feedmill.tables import empty_table

LIVE_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in KEY])
# `epoch` is the batch that said it.
_ROW = T.StructType(
    [
        *LIVE_SCHEMA.fields,
        T.StructField("hash", T.LongType()),
        T.StructField("live", T.BooleanType()),
        T.StructField("epoch", T.LongType()),
    ]
)
_COLUMNS = _ROW.fieldNames()

#: Keys of a bucket, about; with more than twice that many in the mean, the table gets more buckets.
BUCKET_ROWS = 250_000
#: Deltas of a level that are merged into one.
FAN = 8
#: A bucket whose deltas have more rows than this part of its base gets a new base,
#: if they are more than `LEAST_ROWS` at all.
OUTGROWN = 0.25
LEAST_ROWS = 1_000
#: Rows of a file.
FILE_ROWS = 500_000
#: Manifests whose files are kept: that of a batch, the one it was made from, and one to spare.
KEPT = 3


@dataclass
class Manifest:
    """The files that count after a batch.

    `base` maps a bucket to [batch that wrote it, rows]; what deltas say of it counts
    if it is of a later batch. `deltas` are [last batch in it, level, {bucket: rows}].
    `written` are the rows that the batch wrote, in whatever file.
    """

    n_buckets: int = 1
    base: dict[int, list[int]] = field(default_factory=dict)
    deltas: list[list] = field(default_factory=list)
    written: int = 0

    @staticmethod
    def of(text: str) -> "Manifest":
        raw = json.loads(text)
        base = {int(b): v for b, v in raw["base"].items()}
        deltas = [[e, level, {int(b): n for b, n in rows.items()}] for e, level, rows in raw["deltas"]]
        return Manifest(raw["n_buckets"], base, deltas, raw["written"])

    def rows(self, bucket: int) -> int:
        return sum(rows.get(bucket, 0) for _, _, rows in self.deltas)

    def paths(self) -> set[str]:
        bases = {_base_path(e, self.n_buckets, b) for b, (e, n) in self.base.items() if n}
        return bases | {_delta_path(e, level) for e, level, _ in self.deltas}


def _base_path(epoch: int, n_buckets: int, bucket: int) -> str:
    return f"base/version={epoch}-{n_buckets}/bucket={bucket}"


def _delta_path(epoch: int, level: int) -> str:
    return f"delta/epoch={epoch}/level={level}"


def _bucket(n_buckets: int) -> Column:
    return F.pmod(F.col("hash"), F.lit(n_buckets)).cast("int")


class LiveKeys:
    """The live keys of one stream, before and after each of its batches. `initial_keys` are live before the first."""

    def __init__(self, checkpoint: str, initial_keys: DataFrame | None = None) -> None:
        self._folder = f"{checkpoint.rstrip('/')}/live_keys"
        self._initial = initial_keys
        self._known: dict[int, Manifest] = {}

    def _manifest_path(self, epoch: int) -> str:
        return f"{self._folder}/manifest/{epoch:012d}.json"

    def manifest(self, spark: SparkSession, epoch: int) -> Manifest:
        """The files that count after a batch; -1 stands for the start."""
        if epoch not in self._known:
            text = files.read_text(spark, self._manifest_path(epoch))
            if text is None and epoch >= 0:
                raise FileNotFoundError(f"no live keys of batch {epoch} in {self._folder}")
            self._keep(epoch, Manifest.of(text) if text is not None else self._start(spark))
        return self._known[epoch]

    def _keep(self, epoch: int, manifest: Manifest) -> None:
        self._known = {e: m for e, m in self._known.items() if e > epoch - KEPT} | {epoch: manifest}

    def _start(self, spark: SparkSession) -> Manifest:
        """A base of the initial keys."""
        manifest = Manifest()
        if self._initial is not None:
            keys = self._initial.select(*KEY).distinct().withColumn("hash", F.xxhash64(*KEY)).withColumns({"live": F.lit(True), "epoch": F.lit(-1).cast("long")})
            n = keys.count()
            manifest.n_buckets = max(1, -(-n // BUCKET_ROWS))
            manifest.written = self._write_base(keys, -1, manifest, range(manifest.n_buckets))
        files.write_text(spark, self._manifest_path(-1), json.dumps(manifest.__dict__))
        return manifest

    def _write_base(self, keys: DataFrame, epoch: int, manifest: Manifest, buckets) -> int:
        """Write new bases of these buckets and note them; how many rows that were."""
        placed = keys.select(*_COLUMNS, _bucket(manifest.n_buckets).alias("bucket"))
        path = f"{self._folder}/base/version={epoch}-{manifest.n_buckets}"
        spread = placed.repartition(max(1, min(len(buckets), 200)), "bucket")
        spread.sortWithinPartitions("bucket", "hash").write.mode("overwrite").partitionBy("bucket").parquet(path)
        written = keys.sparkSession.read.schema(T.StructType([*_ROW.fields, T.StructField("bucket", T.IntegerType())])).parquet(path)
        rows = {r["bucket"]: r["n"] for r in written.groupBy("bucket").agg(F.count("*").alias("n")).collect()}  # a row per bucket
        for bucket in buckets:
            manifest.base[bucket] = [epoch, rows.get(bucket, 0)]
        return sum(rows.values())

    def _read(self, spark: SparkSession, manifest: Manifest, buckets: set[int]) -> DataFrame | None:
        """What base and deltas say of the keys of some buckets."""
        base = [_base_path(manifest.base[b][0], manifest.n_buckets, b) for b in sorted(buckets) if manifest.base.get(b, [0, 0])[1]]
        found = spark.read.schema(_ROW).parquet(*[f"{self._folder}/{p}" for p in base]) if base else None
        deltas = self._deltas(spark, manifest, manifest.deltas, buckets)
        if found is None or deltas is None:
            return deltas if found is None else found
        return found.unionByName(deltas)

    def _deltas(self, spark: SparkSession, manifest: Manifest, deltas: list[list], buckets: set[int]) -> DataFrame | None:
        """The rows of deltas that are newer than the base of their bucket."""
        told = [d for d in deltas if buckets & d[2].keys()]
        if not told:
            return None
        rows = spark.read.schema(_ROW).parquet(*[f"{self._folder}/{_delta_path(e, level)}" for e, level, _ in told])
        if len(buckets) < manifest.n_buckets:
            rows = rows.where(_bucket(manifest.n_buckets).isin(sorted(buckets)))
        since: dict[int, list[int]] = {}
        for bucket in buckets & manifest.base.keys():
            if manifest.base[bucket][0] >= 0:
                since.setdefault(manifest.base[bucket][0], []).append(bucket)
        for epoch, based in since.items():
            rows = rows.where((F.col("epoch") > epoch) | ~_bucket(manifest.n_buckets).isin(based))
        return rows

    @staticmethod
    def _newest(rows: DataFrame) -> DataFrame:
        """The newest word on each key."""
        last = F.max(F.struct("epoch", "live"))
        return rows.groupBy("hash", *KEY).agg(last.alias("last")).select(*KEY, "hash", "last.live", "last.epoch")

    def after(self, spark: SparkSession, epoch: int) -> DataFrame:
        """All keys that are live after a batch."""
        manifest = self.manifest(spark, epoch)
        rows = self._read(spark, manifest, set(range(manifest.n_buckets)))
        if rows is None:
            return empty_table(spark, LIVE_SCHEMA)
        return self._newest(rows).where("live").select(*KEY)

    @staticmethod
    def _touched(batch: DataFrame, n_buckets: int) -> set[int]:
        hashed = batch.select(F.xxhash64(*KEY).alias("hash")).select(_bucket(n_buckets).alias("b"))
        return {r["b"] for r in hashed.distinct().collect()}  # at most one row per bucket

    def before(self, batch: DataFrame, epoch: int) -> DataFrame:
        """Those keys of the batch that were live before it."""
        spark = batch.sparkSession
        manifest = self.manifest(spark, epoch - 1)
        rows = self._read(spark, manifest, self._touched(batch, manifest.n_buckets)) if manifest.base or manifest.deltas else None
        if rows is None:
            return empty_table(spark, LIVE_SCHEMA)
        keys = batch.select(F.xxhash64(*KEY).alias("hash"), *KEY).distinct()
        return self._newest(rows.join(keys, ["hash", *KEY], "left_semi")).where("live").select(*KEY)

    def _write_delta(self, rows: DataFrame, n: int, epoch: int, level: int) -> None:
        path = f"{self._folder}/{_delta_path(epoch, level)}"
        rows = rows.select(*_COLUMNS).coalesce(max(1, -(-n // FILE_ROWS)))
        rows.sortWithinPartitions("hash").write.mode("overwrite").parquet(path)

    def store(self, batch: DataFrame, epoch: int) -> None:
        """Write what the batch made of its keys: the last op of a key decides."""
        spark = batch.sparkSession
        old = self.manifest(spark, epoch - 1)
        new = Manifest(old.n_buckets, dict(old.base), [list(d) for d in old.deltas])
        last = batch.groupBy(*KEY).agg(F.max_by(F.col("op") != "DELETE", "seq").alias("live"))
        last = last.withColumns({"hash": F.xxhash64(*KEY), "epoch": F.lit(epoch).cast("long")}).persist()
        try:
            counts = last.groupBy(_bucket(new.n_buckets).alias("bucket")).agg(F.count("*").alias("n")).collect()
            rows = {r["bucket"]: r["n"] for r in counts}
            if rows:
                self._write_delta(last, sum(rows.values()), epoch, 0)
                new.deltas.append([epoch, 0, rows])
                new.written += sum(rows.values())
        finally:
            last.unpersist()
        self._compact(spark, new, epoch)
        files.write_text(spark, self._manifest_path(epoch), json.dumps(new.__dict__))
        self._keep(epoch, new)
        # Deltas that the batch wrote and merged at once.
        levels = 1 + max((d[1] for d in new.deltas), default=0)
        passed = {_delta_path(epoch, level) for level in range(levels)} - new.paths()
        self._sweep(spark, epoch, passed)

    def _compact(self, spark: SparkSession, new: Manifest, epoch: int) -> None:
        live = sum(n for _, n in new.base.values())
        every = set(range(new.n_buckets))
        outgrown = {b for b in every if (n := new.rows(b)) > max(LEAST_ROWS, OUTGROWN * new.base.get(b, [0, 0])[1])}
        if outgrown:
            grown = live + sum(new.rows(b) for b in every)
            if grown > 2 * BUCKET_ROWS * new.n_buckets:
                self._split(spark, new, epoch, grown)
                return
            kept = self._newest(self._read(spark, new, outgrown)).where("live")
            new.written += self._write_base(kept, epoch, new, outgrown)
            for delta in new.deltas:
                delta[2] = {b: n for b, n in delta[2].items() if b not in outgrown}
            new.deltas = [d for d in new.deltas if d[2]]
        level = 0
        while len(same := [d for d in new.deltas if d[1] == level]) >= FAN:
            self._merge(spark, new, epoch, level, same)
            level += 1

    def _merge(self, spark: SparkSession, new: Manifest, epoch: int, level: int, same: list[list]) -> None:
        """The deltas of a level as one of the next."""
        merged = self._newest(self._deltas(spark, new, same, {b for _, _, rows in same for b in rows})).persist()
        try:
            counts = merged.groupBy(_bucket(new.n_buckets).alias("bucket")).agg(F.count("*").alias("n")).collect()
            rows = {r["bucket"]: r["n"] for r in counts}
            self._write_delta(merged, sum(rows.values()), epoch, level + 1)
        finally:
            merged.unpersist()
        new.written += sum(rows.values())
        new.deltas = [d for d in new.deltas if d[1] != level] + [[epoch, level + 1, rows]]

    def _split(self, spark: SparkSession, new: Manifest, epoch: int, grown: int) -> None:
        """All keys in more buckets."""
        kept = self._newest(self._read(spark, new, set(range(new.n_buckets)))).where("live")
        new.n_buckets, new.base, new.deltas = -(-grown // BUCKET_ROWS), {}, []
        new.written += self._write_base(kept, epoch, new, range(new.n_buckets))

    def _sweep(self, spark: SparkSession, epoch: int, passed: set[str]) -> None:
        """Remove what only the manifest that is no longer kept names, and what none will."""
        for path in sorted(passed):
            files.remove(spark, f"{self._folder}/{path}")
        gone = epoch - KEPT
        if gone < -1:
            return
        text = files.read_text(spark, self._manifest_path(gone))
        if text is None:
            return
        still = set().union(*(self.manifest(spark, e).paths() for e in range(gone + 1, epoch + 1)))
        for path in sorted(Manifest.of(text).paths() - still):
            files.remove(spark, f"{self._folder}/{path}")
        files.remove(spark, self._manifest_path(gone))
