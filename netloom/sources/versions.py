"""Collections published as whole versions in a shared folder.

``data/`` holds table folders that are never changed, ``versions/`` one small
manifest per version: the folders of each table and the batches it contains.
A commit writes its folders first and then gives its manifest the next number
by a rename that refuses to replace another, so a reader sees the version
before or the one after, a job that fails leaves the last version as it was,
and of two writers at once one fails with ``Conflict`` and may try again.
The rename is atomic on HDFS; object stores need a file system client with
atomic rename.

A batch that is in the version already is not applied again. An append to a
table with keys is refused if a key is there already or comes twice (null
matches null). A table without rows is kept; columns beyond the model are
dropped.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from netloom.sources.collection import Collection, conform, key_violations


class Conflict(RuntimeError):
    """Another writer published a version first."""


class KeyClash(ValueError):
    """An appended key is in the table already, or comes twice."""


class Versions:
    def __init__(self, spark: SparkSession, path: str, model: Mapping[str, StructType],
                 keys: Mapping[str, list[str]] | None = None):
        self.spark, self.path, self.model, self.keys = spark, path.rstrip("/"), dict(model), dict(keys or {})

    # ---- reading ----------------------------------------------------------------

    def latest(self) -> int:
        """Number of the last version; 0 before the first."""
        folder = self._path("versions")
        fs = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(folder):
            return 0
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return max([int(n[: -len(".json")]) for n in names if n.endswith(".json")], default=0)

    def manifest(self, version: int | None = None) -> dict:
        version = self.latest() if version is None else version
        if version == 0:
            return {"tables": {}, "batches": []}
        return json.loads(self.spark.read.option("wholetext", True).text(self._file(version)).first()[0])

    def read(self, version: int | None = None, name: str = "collection") -> Collection:
        """The collection as of a version, the last one by default."""
        folders = self.manifest(version)["tables"]
        tables = {t: self._load(t, f) for t, f in folders.items()}
        return Collection(name, tables, {t: self.model[t] for t in tables})

    # ---- writing ----------------------------------------------------------------

    def commit(self, batch: str, append: Mapping[str, DataFrame] | None = None,
               replace: Mapping[str, DataFrame] | None = None) -> int:
        """Publish the next version: the last one with rows appended to some tables
        and others replaced. Returns its number, or the last one's if it holds the batch."""
        append, replace = dict(append or {}), dict(replace or {})
        base = self.latest()
        old = self.manifest(base)
        if batch in old["batches"]:
            return base
        both = set(append) & set(replace)
        if both:
            raise ValueError(f"tables {sorted(both)} both appended and replaced")
        tables = dict(old["tables"])
        for t, df in {**append, **replace}.items():
            # what is checked is what was written, whatever the source gives when read again
            added = self._write(t, df)
            kept = tables.get(t, []) if t in append else []
            self._check(t, [added], kept)
            tables[t] = [*kept, added]
        self._publish(base + 1, {"tables": tables, "batches": [*old["batches"], batch]})
        return base + 1

    def _check(self, t: str, added: list[str], kept: list[str]) -> None:
        keys = self.keys.get(t)
        if not keys:
            return
        new = self._load(t, added)
        clash = key_violations(new, keys).select(*keys)
        if kept:
            clash = clash.union(new.select(*keys).intersect(self._load(t, kept).select(*keys)))
        first = clash.first()
        if first is not None:
            raise KeyClash(f"{t}: {first.asDict()}")

    def _write(self, t: str, df: DataFrame) -> str:
        folder = f"data/{t}-{uuid.uuid4().hex}"
        conform(df, self.model[t]).write.parquet(f"{self.path}/{folder}")
        return folder

    def _load(self, t: str, folders: list[str]) -> DataFrame:
        return self.spark.read.schema(self.model[t]).parquet(*[f"{self.path}/{f}" for f in folders])

    # ---- files ------------------------------------------------------------------

    def _path(self, name: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def _file(self, version: int) -> str:
        return f"{self.path}/versions/{version:012d}.json"

    def _publish(self, version: int, manifest: dict) -> None:
        sc = self.spark.sparkContext
        jvm, conf = sc._jvm, sc._jsc.hadoopConfiguration()
        draft, final = self._path(f"versions/draft-{uuid.uuid4().hex}"), jvm.org.apache.hadoop.fs.Path(self._file(version))
        fs = draft.getFileSystem(conf)
        out = fs.create(draft, False)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf)
        plain = sc._gateway.new_array(getattr(jvm, "org.apache.hadoop.fs.Options$Rename"), 0)  # no overwriting
        try:
            files.rename(draft, final, plain)
        except Exception as e:
            fs.delete(draft, False)
            if fs.exists(final):
                raise Conflict(f"version {version} is there already") from e
            raise
