"""Named collections of tables with declared schemas.

A ``Collection`` is an immutable mapping from table name to a lazy
DataFrame plus the declared schema of each table. Every change returns a
new collection; tables are never materialised by the collection itself.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from netloom.sources.json_document import read_tables, write_tables


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select the declared columns in declared order, cast to declared types.

    Raises when a declared column is missing (extra columns are dropped).
    """
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; have {df.columns}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


@dataclass(frozen=True)
class Collection:
    name: str
    tables: Mapping[str, DataFrame] = field(default_factory=dict)
    model: Mapping[str, StructType] = field(default_factory=dict)

    # ---- building ---------------------------------------------------------

    def add_table(self, name: str, df: DataFrame, schema: StructType | None = None) -> Collection:
        if name in self.tables:
            raise ValueError(f"table {name!r} already in collection {self.name!r}")
        schema = schema or self.model.get(name)
        if schema is not None:
            df = conform(df, schema)
        return Collection(self.name, {**self.tables, name: df}, {**self.model, name: schema or df.schema})

    def add_empty_table(self, spark: SparkSession, name: str, schema: StructType | None = None) -> Collection:
        schema = schema or self.model[name]
        return self.add_table(name, spark.createDataFrame([], schema), schema)

    def add_rows(self, spark: SparkSession, name: str, rows: Iterable[tuple], schema: StructType | None = None) -> Collection:
        """Inline rows (tuples in schema order) as a table."""
        schema = schema or self.model[name]
        return self.add_table(name, spark.createDataFrame(list(rows), schema), schema)

    def merge(self, other: Collection) -> Collection:
        dup = set(self.tables) & set(other.tables)
        if dup:
            raise ValueError(f"tables {sorted(dup)} in both collections")
        return Collection(self.name, {**self.tables, **other.tables}, {**self.model, **other.model})

    def subset(self, name: str, *table_names: str) -> Collection:
        return Collection(name, {t: self.tables[t] for t in table_names}, {t: self.model[t] for t in table_names})

    def replace(self, name: str, df: DataFrame) -> Collection:
        if name not in self.tables:
            raise KeyError(name)
        return Collection(self.name, {**self.tables, name: conform(df, self.model[name])}, self.model)

    def append(self, name: str, df: DataFrame) -> Collection:
        """Bag union by column name with the existing table."""
        if name not in self.tables:
            return self.add_table(name, df)
        added = conform(df, self.model[name])
        return Collection(self.name, {**self.tables, name: self.tables[name].unionByName(added)}, self.model)

    def append_all(self, other: Collection) -> Collection:
        out = self
        for t, df in other.tables.items():
            out = out.append(t, df)
        return out

    # ---- reading ------------------------------------------------------------

    def table(self, name: str) -> DataFrame:
        return self.tables[name]

    def __getitem__(self, name: str) -> DataFrame:
        return self.tables[name]

    def names(self) -> list[str]:
        return list(self.tables)

    def schema(self, name: str) -> StructType:
        return self.model[name]

    def sizes(self) -> DataFrame:
        """One row per table: table name and row count, in one job."""
        parts = [df.groupBy().agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(t).alias("table_name"), "n_rows")
                 for t, df in self.tables.items()]
        return reduce(DataFrame.unionByName, parts)

    def key_violations(self, name: str, keys: list[str]) -> DataFrame:
        return key_violations(self.tables[name], keys)

    def check_keys(self, keys: Mapping[str, list[str]] | None = None) -> DataFrame:
        """Every duplicated key of every keyed table, in one job:
        (table_name, key as text, n_rows). Keys default to ``schemas.KEYS``."""
        from netloom.schemas import KEYS

        keys = KEYS if keys is None else keys
        parts = []
        for t, df in self.tables.items():
            k = keys.get(t)
            if not k:
                continue
            text = F.to_json(F.struct(*[F.col(c) for c in k]))
            parts.append(key_violations(df, k).select(F.lit(t).alias("table_name"), text.alias("key"), "n_rows"))
        if not parts:
            raise ValueError("no keyed tables in the collection")
        return reduce(DataFrame.unionByName, parts)

    # ---- sinks ------------------------------------------------------------

    def write(self, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
        """One folder per table under ``path`` (distributed write)."""
        for t, df in self.tables.items():
            df.write.format(fmt).mode(mode).save(f"{path.rstrip('/')}/{t}")

    def write_document(self, path: str) -> None:
        """The collection as one JSON document of arrays, in parts under ``path``."""
        write_tables(self.tables, path)

    @classmethod
    def read(cls, spark: SparkSession, name: str, path: str, model: Mapping[str, StructType],
             fmt: str = "parquet") -> Collection:
        """Read a collection written by ``write`` (or one JSON-lines folder per table)."""
        tables = {}
        for t, s in model.items():
            reader = spark.read.format(fmt)
            if fmt != "parquet":
                reader = reader.schema(s)
            tables[t] = conform(reader.load(f"{path.rstrip('/')}/{t}"), s)
        return cls(name, tables, dict(model))

    def show(self, name: str, n: int = 20) -> None:
        self.tables[name].show(n, truncate=False)


def key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once, with their multiplicity."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


_CAMEL = re.compile(r"(?<!^)(?=[A-Z])")


def snake(name: str) -> str:
    return _CAMEL.sub("_", name).lower()


def load_json(
    spark: SparkSession,
    path: str,
    model: Mapping[str, StructType],
    name: str = "collection",
    renames: Mapping[str, Mapping[str, str]] | None = None,
    snake_case: bool = True,
) -> Collection:
    """Multi-table JSON document: one object, one array of flat objects per table.

    ``model`` uses the document's table and field names; values are parsed
    with the declared types (an integer ``1`` in a double field reads as 1.0).
    The document is read in byte ranges, see ``json_document``; the path may be a
    folder of parts that ``write_document`` wrote.
    """
    found = read_tables(spark, path, model)
    renames = renames or {}
    tables, schemas = {}, {}
    for t, s in model.items():
        df = found[t]
        mapping = {f.name: renames.get(t, {}).get(f.name, snake(f.name) if snake_case else f.name) for f in s.fields}
        out_t = snake(t) if snake_case else t
        df = df.select(*[F.col(k).alias(v) for k, v in mapping.items()])
        tables[out_t] = df
        schemas[out_t] = StructType([StructField(mapping[f.name], f.dataType, True) for f in s.fields])
    return Collection(name, tables, schemas)
