"""Versioned Parquet tables with keyed upsert.

Layout: ``<root>/<table>/v=<batch>-<random>/_bucket=<b>/*.parquet`` and one manifest per batch,
``<root>/_manifest/<batch>.json``, that names the live version of every bucket. A batch writes new versions
of the buckets it touches, for all its tables, into folders that no other batch has, and becomes visible at once when
its manifest is put in place. Of two batches with the same number only the first to publish does; the other raises
:class:`BatchConflict`, has changed nothing that can be read, and is to be made again. A batch that has a manifest is
not applied again. A stream passes a token (stream, epoch) instead of
a number of its own; the manifest keeps the last epoch of every stream, so replays are harmless and other writers
may publish in between.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jsonloom.operators.align import align_columns, common_schema
from jsonloom.operators.ordering import keep_last
from jsonloom.session import cut_lineage

# Buckets of a new table unless given: at least this many, or the session's shuffle partitions if more.
# A table of 100 TB wants thousands, so that a bucket is rewritten by a few tasks.
FEWEST_BUCKETS = 16
# Rows of a bucket one merge task takes; a larger bucket is merged and written by several tasks.
ROWS_PER_TASK = 4_000_000
_BUCKET, _SPLIT = "_bucket", "_split"


def _name(batch: int) -> str:
    return f"{batch:020d}"


def _bucket_of(key: list[str], buckets: int):
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def _placed(df: DataFrame, key: list[str], buckets: int, rows: int) -> DataFrame:
    """Rows by bucket, and by further splits of a bucket that is too large for one task."""
    splits = max(1, rows // (buckets * ROWS_PER_TASK))
    split = F.pmod(F.hash(*key), F.lit(splits)).cast("int")
    return df.withColumns({_BUCKET: _bucket_of(key, buckets), _SPLIT: split}).repartition(_BUCKET, _SPLIT)


class BatchConflict(OSError):
    """Another writer published a batch of this number first."""


def _number(version: str) -> int:
    """The batch a version was written by."""
    return int(version.split("-")[0])


@dataclass
class TableEntry:
    """A table in a manifest. ``parts`` are (bucket, version) pairs; bucket -1 is a whole appended batch."""

    schema: T.StructType
    key: list[str] | None = None
    buckets: int = FEWEST_BUCKETS
    parts: list[tuple[int, str]] = field(default_factory=list)
    # schema a version was written with
    written: dict[str, T.StructType] = field(default_factory=dict)

    def to_dict(self) -> dict:
        return {
            "schema": self.schema.jsonValue(), "key": self.key, "buckets": self.buckets,
            "parts": [list(p) for p in self.parts],
            "written": _named_schemas(self.written),
        }

    @staticmethod
    def from_dict(d: dict) -> TableEntry:
        read = T.StructType.fromJson
        return TableEntry(
            read(d["schema"]), d["key"], d["buckets"], [(b, v) for b, v in d["parts"]],
            {v: schema for group in d["written"] for schema in [read(group["schema"])] for v in group["versions"]},
        )


def _named_schemas(written: dict[str, T.StructType]) -> list[dict]:
    """Each schema once, with the versions that have it."""
    groups: dict[str, list[str]] = {}
    for version, schema in written.items():
        groups.setdefault(schema.json(), []).append(version)
    return [{"schema": json.loads(text), "versions": versions} for text, versions in groups.items()]


class TableStore:
    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        self.buckets = buckets or max(FEWEST_BUCKETS, int(spark.conf.get("spark.sql.shuffle.partitions")))
        self._manifests: dict[int, str] = {}

    # -- files ---------------------------------------------------------------------------------

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def _fs(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def batches(self) -> list[int]:
        """Published batches in order."""
        folder = self._path("_manifest")
        if not self._fs().exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs().listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json"))

    def _load(self, batch: int | None) -> dict:
        known = [b for b in self.batches() if batch is None or b <= batch]
        if not known:
            return {"tables": {}, "applied": {}}
        # a manifest never changes once it is there
        if known[-1] not in self._manifests:
            path = f"{self.root}/_manifest/{_name(known[-1])}.json"
            text = self.spark.read.option("wholetext", True).text(path).first().value
            self._manifests = {b: t for b, t in sorted(self._manifests.items())[-7:]} | {known[-1]: text}
        return json.loads(self._manifests[known[-1]])

    def manifest(self, batch: int | None = None) -> dict[str, TableEntry]:
        """Tables as of ``batch`` (the newest published one by default)."""
        return {t: TableEntry.from_dict(d) for t, d in self._load(batch)["tables"].items()}

    def _publish(self, batch: int, tables: dict[str, TableEntry], applied: dict[str, int]) -> None:
        content = {"tables": {t: e.to_dict() for t, e in tables.items()}, "applied": applied}
        fs, temporary = self._fs(), self._path("_manifest", f".{_name(batch)}-{uuid.uuid4().hex}.tmp")
        stream = fs.create(temporary, True)
        stream.write(bytearray(json.dumps(content).encode()))
        stream.close()
        jvm, target = self.spark._jvm, self._path("_manifest", f"{_name(batch)}.json")
        kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self.spark.sparkContext._gateway.new_array(kind, 1)
        options[0] = kind.NONE  # the target must not exist
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self.spark._jsc.hadoopConfiguration()).rename(
                fs.makeQualified(temporary), fs.makeQualified(target), options
            )
        except Py4JJavaError as error:
            fs.delete(temporary, False)
            if "FileAlreadyExistsException" in str(error.java_exception):
                raise BatchConflict(f"batch {batch} was published by another writer") from None
            raise

    # -- reading -------------------------------------------------------------------------------

    def tables(self) -> list[str]:
        return list(self.manifest())

    def read(self, table: str, batch: int | None = None) -> DataFrame:
        """The table as of a batch."""
        return self._read_parts(table, self.manifest(batch)[table])

    def read_all(self, batch: int | None = None) -> dict[str, DataFrame]:
        return {t: self._read_parts(t, e) for t, e in self.manifest(batch).items() if not t.startswith("_")}

    def _read_parts(self, table: str, entry: TableEntry, buckets: set[int] | None = None) -> DataFrame:
        groups: dict[str, list[str]] = {}
        for bucket, version in entry.parts:
            if buckets is None or bucket in buckets:
                folder = f"{self.root}/{table}/v={version}" + (f"/{_BUCKET}={bucket}" if bucket >= 0 else "")
                groups.setdefault(entry.written[version].json(), []).append(folder)
        if not groups:
            return self.spark.createDataFrame([], entry.schema)
        frames = [
            align_columns(self.spark.read.schema(T.StructType.fromJson(json.loads(s))).parquet(*paths), entry.schema)
            for s, paths in groups.items()
        ]
        return reduce(DataFrame.unionByName, [f.select(*entry.schema.fieldNames()) for f in frames])

    def changed(self, table: str, since: int, until: int | None = None) -> DataFrame | None:
        """Rows that came (``_sign`` 1) and went (-1) between two batches, None where nothing did.

        Only parts whose version changed are read: a row that a merge wrote again as it was comes and goes. Columns are
        those of the newer table.
        """
        if since and since not in self.batches():
            raise ValueError(f"batch {since} was deleted")
        new, old = self.manifest(until).get(table), self.manifest(since).get(table) if since else None
        if new is None:
            return None
        gone = set(old.parts) - set(new.parts) if old else set()
        came = set(new.parts) - set(old.parts if old else [])
        sides = []
        for parts, entry, sign in ((came, new, 1), (gone, old, -1)):
            if parts:
                some = TableEntry(entry.schema, entry.key, entry.buckets, sorted(parts), entry.written)
                sides.append(align_columns(self._read_parts(table, some), new.schema).select(*new.schema.fieldNames()).withColumn("_sign", F.lit(sign)))
        return reduce(DataFrame.unionByName, sides) if sides else None

    def read_near(self, table: str, keys: DataFrame, batch: int | None = None) -> DataFrame:
        """The buckets of a keyed table that hold the given keys; ``keys`` has the key columns and is read twice."""
        entry = self.manifest(batch)[table]
        buckets = {row[0] for row in keys.select(_bucket_of(entry.key, entry.buckets)).distinct().collect()}
        return self._read_parts(table, entry, buckets)

    # -- writing -------------------------------------------------------------------------------

    def batch(self, batch_id: int | None = None, token: tuple[str, int] | None = None) -> Batch:
        """A batch with the next free number unless one is given; ``token`` names a stream and its epoch."""
        return Batch(self, self.next_batch() if batch_id is None else batch_id, token)

    def next_batch(self) -> int:
        return (self.batches() or [0])[-1] + 1

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete data no manifest of the last ``keep`` batches names, and the older manifests."""
        batches = self.batches()
        kept = batches[-keep:]
        live = {(t, v) for k in kept for t, e in self.manifest(k).items() for _, v in e.parts}
        fs, dropped = self._fs(), []
        for table in {t for k in kept for t in self.manifest(k)}:
            folder = self._path(table)
            for status in fs.listStatus(folder) if fs.exists(folder) else []:
                name = status.getPath().getName()
                version = name[2:] if name.startswith("v=") else None
                if version is not None and _number(version) <= batches[-1] and (table, version) not in live:
                    fs.delete(status.getPath(), True)
                    dropped.append(f"{table}/{name}")
        for old in batches[:-keep]:
            fs.delete(self._path("_manifest", f"{_name(old)}.json"), False)
        return dropped


class Batch:
    """Changes to several tables that become visible together at :meth:`commit`."""

    def __init__(self, store: TableStore, batch_id: int, token: tuple[str, int] | None = None):
        self.store, self.id = store, batch_id
        self.version = f"{batch_id}-{uuid.uuid4().hex[:12]}"
        before = store._load(batch_id - 1)
        self.entries = {t: TableEntry.from_dict(d) for t, d in before["tables"].items()}
        self.applied: dict[str, int] = before["applied"]
        self.published = batch_id in store.batches()
        if token is not None:
            stream, epoch = token
            self.published |= self.applied.get(stream, -1) >= epoch
            self.applied = {**self.applied, stream: max(epoch, self.applied.get(stream, -1))}

    def __enter__(self) -> Batch:
        return self

    def __exit__(self, kind, *_):
        if kind is None:
            self.commit()

    def commit(self) -> None:
        if not self.published:
            self.store._publish(self.id, self.entries, self.applied)
            self.published = True

    def create(self, table: str, schema: T.StructType, key: list[str] | None = None, buckets: int | None = None) -> None:
        """Add an empty table unless it exists."""
        if table not in self.entries:
            self.entries[table] = TableEntry(schema, key, buckets or self.store.buckets)

    def _entry(self, table: str, df: DataFrame, key: list[str] | None, schema: T.StructType | None) -> TableEntry:
        self.create(table, schema or df.schema, key)
        entry = self.entries[table]
        wanted = schema or df.schema
        if schema is None or not set(entry.schema.fieldNames()) <= set(schema.fieldNames()):
            wanted = common_schema([entry.schema, wanted])
        entry.schema = wanted
        return entry

    def _folder(self, table: str) -> str:
        return f"{self.store.root}/{table}/v={self.version}"

    def upsert(
        self, table: str, df: DataFrame, key: list[str], order: list[str], schema: T.StructType | None = None, unique: bool = False
    ) -> None:
        """Merge rows by key; the last row in ``order`` wins, new rows win over stored ones.

        Only buckets that receive rows are read and written again. ``df`` is read twice (touched
        buckets, merge), so it should come from files. ``unique``: it has a row per key, so none has to be found.
        """
        if self.published:
            return
        positions = [c for c in order if c not in df.columns]
        if positions:
            raise ValueError(f"order columns {positions} are not in the rows")
        hidden = [c for c in order if schema is not None and c not in schema.fieldNames()]
        entry = self._entry(table, df.drop(*hidden), key, schema)
        if entry.key != key:
            raise ValueError(f"{table} is keyed by {entry.key}, not {key}")
        newest = df if unique else keep_last(df, key, order)
        columns = entry.schema.fieldNames()
        incoming = align_columns(newest.drop(*hidden), entry.schema).select(*columns).withColumn("_new", F.lit(1))
        rows = align_columns(df.select(*key), T.StructType([entry.schema[k] for k in key]))
        sizes = rows.groupBy(_bucket_of(key, entry.buckets)).count().collect()  # at most one row per bucket
        touched = {r[0] for r in sizes}
        if not touched:
            return
        if touched.isdisjoint(b for b, _ in entry.parts):
            merged = _placed(incoming, key, entry.buckets, sum(r[1] for r in sizes)).drop("_new", _SPLIT)
        else:
            stored = self.store._read_parts(table, entry, touched)
            total = sum(r[1] for r in sizes) + stored.count()  # from the file footers
            both = stored.withColumn("_new", F.lit(0)).unionByName(incoming)
            # one exchange serves the merge and the layout of the files; a task's rows differ in the key, so sorts begin with it
            placed = _placed(both, key, entry.buckets, total)
            merged = keep_last(placed, [*reversed(key), _BUCKET, _SPLIT], ["_new"]).drop("_new", _SPLIT)
        merged.write.mode("overwrite").partitionBy(_BUCKET).parquet(self._folder(table))
        entry.parts = [p for p in entry.parts if p[0] not in touched] + [(b, self.version) for b in sorted(touched)]
        self._written(entry)

    def append(
        self, table: str, df: DataFrame, schema: T.StructType | None = None, skip_empty: bool = False
    ) -> None:
        """Add rows to a table without a key. ``skip_empty`` names no part for a batch without rows."""
        if self.published:
            return
        entry = self._entry(table, df, None, schema)
        align_columns(df, entry.schema).select(*entry.schema.fieldNames()).write.mode("overwrite").parquet(self._folder(table))
        if skip_empty and self.store.spark.read.schema(entry.schema).parquet(self._folder(table)).count() == 0:
            return
        entry.parts = [p for p in entry.parts if p[1] != self.version] + [(-1, self.version)]
        self._written(entry)

    def kept(self, df: DataFrame) -> DataFrame:
        """The rows as files beside the tables, for steps that read them more than once."""
        return cut_lineage(df)

    def compact(self, table: str) -> None:
        """Write a table's parts as one version, so its manifest entry stays short after many appends."""
        if not self.published and table in self.entries:
            self.replace(table, self.store._read_parts(table, self.entries[table]))

    def replace(self, table: str, df: DataFrame, key: list[str] | None = None) -> None:
        """Write the whole table anew (read the old version first; it stays until vacuum)."""
        if self.published:
            return
        self.create(table, df.schema, key)
        entry = self.entries[table]
        entry.schema, entry.key = df.schema, key or entry.key
        if entry.key:
            placed = _placed(df, entry.key, entry.buckets, df.count())
            placed.drop(_SPLIT).write.mode("overwrite").partitionBy(_BUCKET).parquet(self._folder(table))
            written = self.store.spark.read.parquet(self._folder(table)).select(_BUCKET).distinct().collect()
            entry.parts = sorted((r[0], self.version) for r in written)
        else:
            df.write.mode("overwrite").parquet(self._folder(table))
            entry.parts = [(-1, self.version)]
        entry.written = {}
        self._written(entry)

    def _written(self, entry: TableEntry) -> None:
        used = {v for _, v in entry.parts}
        entry.written = {v: s for v, s in entry.written.items() if v in used} | {self.version: entry.schema}
