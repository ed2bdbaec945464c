"""Typed tables: creation, append with rule checks, scans."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens import schemas
from orderlens.operators import audit
from orderlens.session import delete_path, materialize, small_table
from orderlens.sources.versions import Versions


class ConstraintViolation(ValueError):
    """A load would break a rule of its table."""


def create_tables(spark: SparkSession, database: str | None = None) -> list[str]:
    """Create the six catalog tables where they do not exist yet."""
    names = []
    for spec in schemas.TABLES.values():
        name = f"{database}.{spec.name}" if database else spec.name
        columns = ", ".join(f"`{c}` {t.simpleString()}" for c, t in spec.columns.items())
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet")
        names.append(name)
    return names


KEYS_OF_A_BUCKET = 1_000_000
LEAST_BUCKETS = 16


class TableStore:
    """Parquet tables below one folder of a shared file system.

    A load writes folders of its own; they become part of the tables when a manifest that names them
    is published, all tables of a load at once.  Beside the rows of a checked load lie its primary
    keys, in buckets by hash, so a later append reads the buckets of its own keys only; of a load that
    was not checked it reads the key columns.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.versions = Versions(spark, self.folder)

    def path(self, table: str) -> str:
        return f"{self.folder}/{table}"

    def keys_path(self, table: str) -> str:
        return f"{self.folder}/_keys/{table}"

    def loads(self, table: str) -> list[dict]:
        """The published loads of a table: id, path, rows, keys and buckets."""
        return self.versions.current()[1].get(table, [])

    def scan(self, table: str) -> DataFrame:
        """The table as published now; one that was never loaded raises and names its path."""
        loads = self.loads(table)
        if not loads:
            raise AnalysisException(f"nothing has been loaded to {self.path(table)}")
        return self.spark.read.schema(schemas.TABLES[table].schema).parquet(*[x["path"] for x in loads])

    def scan_or_empty(self, table: str) -> DataFrame:
        """The table, or no rows before its first load."""
        return self.scan(table) if self.loads(table) else small_table(self.spark, [], schemas.TABLES[table].schema)

    def begin(self) -> "Load":
        """A load of any tables, published as one."""
        return Load(self)

    def append(self, df: DataFrame, table: str, enforce: bool = True, load_id: str | None = None) -> int:
        """Append rows by column name and return how many; a broken table rule stops the load.

        An append under a ``load_id`` that the table has already leaves it as it is.
        """
        load = self.begin()
        try:
            n = load.append(df, table, enforce, load_id)
            load.publish()
        except BaseException:
            load.abort()
            raise
        return n


class Load:
    """Rows written but not published; its own tables count when rules are checked."""

    def __init__(self, store: TableStore):
        self.store, self.spark = store, store.spark
        self.number, self.state = store.versions.current()
        self.written: list[str] = []

    def append(self, df: DataFrame, table: str, enforce: bool = True, load_id: str | None = None) -> int:
        """See ``TableStore.append``.  Rows are written once, and the rules read what was written.

        The count is read from file footers.  (An ``Observation`` would count in passing, but stays in
        the session, where models whose training summary holds the session can't be sent to tasks.)
        """
        spec = schemas.TABLES[table]
        for known in self.state.get(table, []):
            if load_id is not None and known["id"] == load_id:
                return known["rows"]
        name = load_id or uuid.uuid4().hex
        # a folder of a failed try under the same id is not overwritten but left to itself
        name_of_try = f"{name}-{uuid.uuid4().hex[:8]}"
        path, keys_path = f"{self.store.path(table)}/{name_of_try}", None
        self.written.append(path)
        _conform(df, spec).write.parquet(path)
        rows = self.spark.read.schema(spec.schema).parquet(path)
        n = rows.count()
        if enforce:
            targets = {t: c for c, (t, _) in spec.foreign_keys.items()}
            referenced = {t: self.stored_keys(t, rows.select(c)) for t, c in targets.items()}
            stored = self.stored_keys(table, rows.select(*spec.primary_key)) if spec.primary_key else rows.limit(0)
            raise_violations(rows, spec, referenced, stored)
        buckets = LEAST_BUCKETS
        while buckets * KEYS_OF_A_BUCKET < n:
            buckets *= 2
        if enforce and spec.primary_key:
            keys_path = f"{self.store.keys_path(table)}/load={name_of_try}"
            self.written.append(keys_path)
            keys = rows.select(*spec.primary_key).dropna()
            keys = keys.withColumn("bucket", _bucket(list(spec.primary_key), buckets))
            keys.repartition("bucket").sortWithinPartitions("bucket").write.partitionBy("bucket").parquet(keys_path)
        entry = {"id": name, "path": path, "keys": keys_path, "rows": n, "buckets": buckets}
        self.state = {**self.state, table: [*self.state.get(table, []), entry]}
        return n

    def stored_keys(self, table: str, wanted: DataFrame) -> DataFrame:
        """Primary keys of a table, from the buckets that hold the ``wanted`` ones (its columns, in key order)."""
        spec = schemas.TABLES[table]
        keys = list(spec.primary_key)
        fields = T.StructType([spec.schema[c] for c in keys])
        loads = [x for x in self.state.get(table, []) if x["rows"]]
        found = small_table(self.spark, [], fields)
        plain = [x["path"] for x in loads if x["keys"] is None]
        if plain:
            found = self.spark.read.schema(spec.schema).parquet(*plain).select(*keys)
        loads = [x for x in loads if x["keys"] is not None]
        if not loads:
            return found
        # numbers of buckets are powers of two: the place among the most gives the place among fewer
        most = max(x["buckets"] for x in loads)
        typed = wanted.toDF(*keys).select(*[F.col(c).cast(spec.columns[c]) for c in keys]).dropna()
        places = {r[0] for r in typed.select(_bucket(keys, most)).distinct().collect()}  # at most ``most`` numbers
        for size in sorted({x["buckets"] for x in loads}):
            own = sorted({p % size for p in places})
            paths = [x["keys"] for x in loads if x["buckets"] == size]
            known = T.StructType([*fields, T.StructField("load", T.StringType()), T.StructField("bucket", T.IntegerType())])
            read = self.spark.read.schema(known).option("basePath", self.store.keys_path(table)).parquet(*paths)
            found = found.unionByName(read.where(F.col("bucket").isin(own)).select(*keys))
        return found

    def publish(self) -> None:
        """Let readers see all that was written; fails when another load came first."""
        if self.written:
            self.store.versions.publish(self.number + 1, self.state)
        self.written = []

    def abort(self) -> None:
        """Drop what was written and not published."""
        for path in self.written:
            delete_path(self.spark, path)
        self.written = []


def _bucket(keys: list[str], size: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(size)).cast("int")


def append_table(df: DataFrame, table: str, database: str | None = None, enforce: bool = True) -> None:
    """Append to a catalog table by column name, with the same rules as ``TableStore.append``."""
    spec, spark = schemas.TABLES[table], df.sparkSession

    def full(name: str) -> str:
        return f"{database}.{name}" if database else name

    rows = _conform(df, spec)
    if enforce:
        rows = materialize(rows, f"staged-{table}")
        check_append(rows, spec, lambda name: spark.table(full(name)))
    rows.write.mode("append").saveAsTable(full(table))


def append_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None) -> None:
    """Append to a database table, 1000 rows per statement."""
    df.write.mode("append").option("batchsize", 1000).jdbc(url, table, properties=properties or {})


def _conform(df: DataFrame, spec: schemas.TableSpec) -> DataFrame:
    unknown = [c for c in df.columns if c not in spec.columns]
    if unknown:
        raise ValueError(f"table {spec.name} has no columns {unknown}")
    have = set(df.columns)
    return df.select(
        *[(F.col(c) if c in have else F.lit(None)).cast(t).alias(c) for c, t in spec.columns.items()]
    )


def check_append(rows: DataFrame, spec: schemas.TableSpec, scan) -> None:
    """Raise when the table with the new rows would break one of its rules."""
    raise_violations(rows, spec, {t: scan(t) for t, _ in spec.foreign_keys.values()}, scan(spec.name))


def raise_violations(
    rows: DataFrame, spec: schemas.TableSpec, referenced: dict[str, DataFrame], stored: DataFrame
) -> None:
    found = audit.table_violations(rows, spec, referenced, stored).where(F.col("n_bad") > 0)
    bad = found.collect()  # one row per rule of the table
    if bad:
        raise ConstraintViolation(
            f"{spec.name}: " + "; ".join(f"{r['rule']}({r['column_name']}) x{r['n_bad']}" for r in bad)
        )
