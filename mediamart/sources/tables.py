"""Tables of the session catalog: rebuild, append, upsert, contract check, views.

Each layer is a schema of the catalog with a folder of its own, and a table is a Parquet table laid out as
``mediamart.schemas`` declares it:

* core tables with a video are bucketed and sorted by ``video_id``, so joins and groupings by video need no
  exchange, and partitioned by the number of the load that brought a row (``_load``);
* facts are partitioned by month (``_month``), so that a dashboard read of some days opens only their months;
* dimensions and the raw table are partitioned by a hash bucket of their key (``_bucket``).

Contracts, keys and not-null rules are checked by the job that writes: a row that breaks one fails the job, and a
failed job publishes nothing.  An upsert stores and checks its batch first and then overwrites just the
partitions that the batch touches, by Spark's dynamic partition overwrite.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from mediamart.schemas import BY_VIDEO, CONTRACTS, KEYED, MONTHLY, NOT_NULL, PRIMARY_KEYS

LAYERS = {"raw": "raw", "staging": "staging", "core": "core", "marts": "marts", "reporting": "reporting"}

#: Partition columns; they belong to the layout and are not part of a table's contract.
LAYOUT_COLUMNS = ("_load", "_month", "_bucket")

REFUSED = "load refused"


def check_contract(df: DataFrame, contract: StructType) -> list[str]:
    """Differences in column names and types; an empty list when ``df`` matches."""
    actual = {f.name: f.dataType for f in df.schema}
    wanted = {f.name: f.dataType for f in contract}
    return (
        [f"missing column {name}" for name in wanted if name not in actual]
        + [f"undeclared column {name}" for name in actual if name not in wanted]
        + [
            f"column {name} is {actual[name].simpleString()}, not {wanted[name].simpleString()}"
            for name in wanted
            if name in actual and actual[name] != wanted[name]
        ]
    )


def conform(df: DataFrame, contract: StructType) -> DataFrame:
    """Exactly the declared columns in the declared types; a value that does not fit its type
    is an error under ANSI mode, and so is a missing or undeclared column."""
    wrong = [d for d in check_contract(df, contract) if not d.startswith("column ")]
    if wrong:
        raise ValueError("; ".join(wrong))
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in contract])


def union_evolving(old: DataFrame, new: DataFrame) -> DataFrame:
    """Union by name; a column missing on one side is NULL there."""
    return old.unionByName(new, allowMissingColumns=True)


def upsert(target: DataFrame | None, updates: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``target`` whose key is not in ``updates``, plus all ``updates``."""
    if target is None:
        return updates
    kept = target.join(updates.select(*keys), keys, "left_anti")
    return union_evolving(kept, updates)


def faults(df: DataFrame, key: list[str], not_null: list[str]) -> dict[str, int]:
    """Rows that break the key or a not-null rule, by rule; only rules that are broken."""
    nulls = {c: F.count_if(F.col(c).isNull()) for c in dict.fromkeys([*key, *not_null])}
    found = df.agg(*[n.alias(c) for c, n in nulls.items()]).first().asDict() if nulls else {}
    out = {f"{c} is null": n for c, n in found.items() if n}
    if key:
        repeated = df.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1").agg(F.sum("n")).first()[0]
        out |= {f"repeated {', '.join(key)}": repeated} if repeated else {}
    return out


def checked(df: DataFrame, key: list[str], not_null: list[str], buckets: int | None = None) -> DataFrame:
    """``df`` whose computation fails at the first row that repeats a key or breaks a not-null rule.

    Rows are brought together by the whole key; with ``buckets`` by its first column, into as many tasks, so that
    what is written bucket by bucket needs no other exchange.  No video is too large for a task: its segments and
    events are numbered by a SMALLINT, and a number that comes twice is refused.
    """
    rules = [(F.col(c).isNotNull(), f"{c} is null") for c in dict.fromkeys([*key, *not_null])]
    if key:
        if buckets:
            df = df.repartition(buckets, key[0]).sortWithinPartitions(*key)
        number = F.row_number().over(Window.partitionBy(*key).orderBy(*key))
        df = df.withColumn("_number", number)
        rules.append((F.col("_number") == 1, f"repeated {', '.join(key)}"))
    for holds, rule in rules:
        df = df.filter(F.assert_true(holds, F.lit(f"{REFUSED}, {rule}")).isNull())
    return df.drop("_number")


def _place(uri: str) -> str:
    return re.sub(r"^[a-z0-9]+:(//[^/]*)?", "", uri).rstrip("/")


class Tables:
    """Named tables below one root folder, one schema of the catalog per layer.

    A layer name given in ``layers`` is used as it stands.  One build may write to a warehouse at a time.
    """

    def __init__(self, spark: SparkSession, root: str, layers: dict[str, str] | None = None, buckets: int = 64):
        """``buckets`` of a bucketed or upserted table: its size divided by what one task should write, some
        256 MB.  It counts when a table is created."""
        self.buckets = buckets
        self.spark = spark
        self.root = root.rstrip("/")
        self.layers = {**LAYERS, **(layers or {})}
        self._staged: dict[str, list[str]] = {}
        #: Table to the partitions that its last upsert has rewritten.
        self.touched: dict[str, list[int]] = {}
        for schema in self.layers.values():
            spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{schema}` LOCATION '{self.root}/{schema}'")
            there = spark.catalog.getDatabase(schema).locationUri
            if _place(there) != _place(f"{self.root}/{schema}"):
                raise ValueError(f"schema {schema} is at {there}; name another one in layers")

    def layer_of(self, name: str) -> str:
        prefix = name.split("_")[0]
        layer = {"core": "core", "dim": "marts", "fact": "marts", "stg": "staging", "process": "raw"}
        return self.layers[layer.get(prefix, "reporting")]

    def full(self, name: str) -> str:
        """The name of a table in the catalog."""
        return f"`{self.layer_of(name)}`.`{name}`"

    def exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(self.full(name))

    def scan(self, name: str) -> DataFrame:
        """A stored table with its partition columns."""
        return self.spark.table(self.full(name))

    def read(self, name: str) -> DataFrame | None:
        """The table, or None before its first load."""
        return self.scan(name).drop(*LAYOUT_COLUMNS) if self.exists(name) else None

    def laid_out_by(self, name: str) -> str | None:
        """The partition column of a stored table."""
        return next((c for c in LAYOUT_COLUMNS if c in self.scan(name).columns), None)

    def partitions(self, name: str) -> list[str]:
        """Values of the partition column, as the catalog has them."""
        if not self.exists(name) or not self.laid_out_by(name):
            return []
        found = self.spark.sql(f"SHOW PARTITIONS {self.full(name)}").collect()
        return sorted(r.partition.split("=", 1)[1] for r in found)

    def last_number(self, name: str) -> int:
        """Number of the newest load that brought rows, 0 before the first and for tables that are upserted."""
        if not self.exists(name) or self.laid_out_by(name) != "_load":
            return 0
        return max(map(int, self.partitions(name)), default=0)

    def read_after(self, name: str, number: int) -> DataFrame:
        """Only the rows of later loads; the folders of other loads are not opened."""
        return self.scan(name).filter(F.col("_load") > number).drop(*LAYOUT_COLUMNS)

    # layout

    def _create(self, name: str, schema: StructType, by: str | None) -> None:
        columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema if f.name not in LAYOUT_COLUMNS]
        text = f"CREATE TABLE {self.full(name)} ({', '.join([*columns, *([f'{by} INT'] if by else [])])}) USING parquet"
        text += f" PARTITIONED BY ({by})" if by else ""
        if name in BY_VIDEO:
            text += f" CLUSTERED BY (video_id) SORTED BY ({', '.join(PRIMARY_KEYS[name])}) INTO {self.buckets} BUCKETS"
        self.spark.sql(text)

    def _kind(self, name: str, first: str | None) -> str | None:
        """Partition column of ``name``: as declared, as it is stored, or ``first``."""
        if name in MONTHLY or name in KEYED:
            return "_month" if name in MONTHLY else "_bucket"
        return self.laid_out_by(name) if self.exists(name) else first

    def _number(self, name: str, by: str, keys: list[str]) -> Column:
        if by == "_load":
            return F.lit(self.last_number(name) + 1)
        if by == "_month":
            return F.expr("date_id div 100").cast("int")
        return F.pmod(F.xxhash64(*keys), F.lit(self.buckets)).cast("int")

    def _fitted(self, name: str, df: DataFrame) -> DataFrame:
        """The columns of the table in its order; ones that it lacks are added to it, missing ones are NULL."""
        have = {f.name for f in self.scan(name).schema}
        new = [f for f in df.schema if f.name not in have]
        if new:
            added = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
            self.spark.sql(f"ALTER TABLE {self.full(name)} ADD COLUMNS ({added})")
        return df.select(
            *[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in self.scan(name).schema]
        )

    # writing

    def _rules(self, name: str) -> tuple[list[str], list[str]]:
        return (PRIMARY_KEYS.get(name, []), NOT_NULL.get(name, [])) if name in CONTRACTS else ([], [])

    def _refusing(self, name: str, df: DataFrame, write: Callable[[DataFrame], None], keyed: bool = True) -> None:
        """Write ``df`` if it keeps the rules of the table ``name``, in one job; else raise with what is wrong."""
        key, not_null = self._rules(name)
        rows = checked(df, key if keyed else [], not_null, self.buckets if name in BY_VIDEO else None)
        try:
            write(rows)
        except Exception as error:
            if REFUSED not in str(error):
                raise
            wrong = faults(df, key, not_null)  # only a refused load is read again, to say how many rows
            raise ValueError(f"{name}: {REFUSED}, " + ", ".join(f"{rule}: {n} rows" for rule, n in wrong.items())) from None

    def stage(self, label: str, df: DataFrame) -> DataFrame:
        """Store an intermediate result under a name of its own and read it back; see ``clear``."""
        name = f"stg_{label}_{uuid.uuid4().hex[:12]}"
        self._staged.setdefault(label, []).append(name)
        df.write.saveAsTable(self.full(name))
        return self.spark.table(self.full(name))

    def clear(self, label: str) -> None:
        """Drop what this object has staged under ``label``."""
        for name in self._staged.pop(label, []):
            self.drop(name)

    def sweep(self) -> None:
        """Drop all staged tables, also those that a run which died has left.  Nothing may be running."""
        for table in self.spark.catalog.listTables(self.layers["staging"]):
            if not table.isTemporary and table.name.startswith("stg_"):
                self.drop(table.name)

    def drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.full(name)}")

    def append(self, name: str, df: DataFrame) -> DataFrame:
        """Add rows known to be new; nothing that is already stored is read or rewritten.  No rows, no load."""
        if name in CONTRACTS:
            df = conform(df, CONTRACTS[name])
        by = self._kind(name, "_load")
        first = not self.exists(name)
        if first:
            self._create(name, df.schema, by)
        keys = KEYED.get(name) or self._keys(name)

        def write(rows: DataFrame) -> None:
            placed = rows.withColumn(by, self._number(name, by, keys)) if by else rows
            if by and by != "_load":
                placed = placed.hint("rebalance", F.col(by))
            self._fitted(name, placed).write.insertInto(self.full(name))

        try:
            self._refusing(name, df, write)
        except Exception:
            if first:  # before its first load there is no table
                self.drop(name)
            raise
        return self.read(name)

    def replace(self, name: str, df: DataFrame) -> DataFrame:
        """Full rebuild.  The new rows are stored and checked before the old ones go, so ``df`` may read the table."""
        if name in CONTRACTS:
            df = conform(df, CONTRACTS[name])
        label, kept = f"new_{name}", []
        self._refusing(name, df, lambda rows: kept.append(self.stage(label, rows)))
        by = self._kind(name, None)
        keys = KEYED.get(name) or self._keys(name)
        self.drop(name)
        self._create(name, df.schema, by)
        rows = kept[0]
        if by:
            rows = rows.withColumn(by, self._number(name, by, keys)).hint("rebalance", F.col(by))
        self._fitted(name, rows).write.insertInto(self.full(name))
        self.clear(label)
        return self.read(name)

    def _keys(self, name: str) -> list[str]:
        """The columns by which an undeclared table was last upserted."""
        if not self.exists(name) or self.laid_out_by(name) != "_bucket":
            return []
        found = self.spark.sql(f"SHOW TBLPROPERTIES {self.full(name)}").filter("key = 'keys'").first()
        return found.value.split(",") if found else []

    def upsert(self, name: str, updates: DataFrame, keys: list[str]) -> DataFrame:
        """Replace the rows with the keys of ``updates`` and keep all others.

        The updates are stored and checked first, so they are computed once although they are read
        several times.  Then the partitions that hold one of their keys are read and overwritten in one
        job; Spark moves its files into place when all are written.  Without updates the table stays as it is.
        """
        if name in CONTRACTS:
            updates = conform(updates, CONTRACTS[name])
        by = "_month" if name in MONTHLY else "_bucket"
        label, kept = f"batch_{name}", []
        batch_of = lambda rows: self.stage(label, rows.withColumn(by, self._number(name, by, keys)))
        self._refusing(name, updates, lambda rows: kept.append(batch_of(rows)))
        if not self.exists(name):
            self._create(name, updates.schema, by)
        elif self.laid_out_by(name) != by:
            self._lay_out(name, keys)
        if name not in CONTRACTS:
            self.spark.sql(f"ALTER TABLE {self.full(name)} SET TBLPROPERTIES ('keys' = '{','.join(keys)}')")
        batch = kept[0]
        touched = {r[0] for r in batch.select(by).distinct().collect()}  # at most the buckets, or the months
        stored = self.scan(name)
        left = set()
        if by == "_month" and touched:  # a key may have been stored under another month
            held = stored.select(*keys, by).join(batch.select(*keys), keys, "left_semi")
            left = {r[0] for r in held.select(by).distinct().collect()} - touched
        if touched:
            old = self._fitted(name, batch).limit(0) if not self.partitions(name) else stored.filter(F.col(by).isin(*touched, *left))
            kept_rows = old.join(batch.select(*keys), keys, "left_anti")
            empty = set(left)
            if left:  # a month that only loses rows may lose all of them
                empty -= {r[0] for r in kept_rows.filter(F.col(by).isin(*left)).select(by).distinct().collect()}
            rows = self._fitted(name, union_evolving(kept_rows, batch))
            rows.hint("rebalance", F.col(by)).write.insertInto(self.full(name), overwrite=True)
            for month in empty:
                self.spark.sql(f"ALTER TABLE {self.full(name)} DROP PARTITION ({by} = {month})")
        self.touched[name] = sorted(touched | left)
        self.clear(label)
        return self.read(name)

    def _lay_out(self, name: str, keys: list[str]) -> None:
        """Lay an undeclared table out in buckets of ``keys``."""
        rows = self.stage(f"moved_{name}", self.read(name))
        self.drop(name)
        self._create(name, rows.schema, "_bucket")
        placed = rows.withColumn("_bucket", self._number(name, "_bucket", keys)).hint("rebalance", F.col("_bucket"))
        placed.write.insertInto(self.full(name))
        self.clear(f"moved_{name}")

    def adopt(self) -> list[str]:
        """Register the declared tables that lie below the root, for a session whose catalog does not know them yet."""
        found = []
        for name in CONTRACTS:
            path = f"{self.root}/{self.layer_of(name)}/{name}"
            try:
                schema = None if self.exists(name) else self.spark.read.parquet(path).schema
            except AnalysisException:  # no such table, or nothing in it
                continue
            if schema is None:
                continue
            by = next((c for c in LAYOUT_COLUMNS if c in schema.names), None)
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
            text = f"CREATE TABLE {self.full(name)} ({columns}) USING parquet"
            text += f" PARTITIONED BY ({by})" if by else ""
            if name in BY_VIDEO:
                text += f" CLUSTERED BY (video_id) SORTED BY ({', '.join(PRIMARY_KEYS[name])}) INTO {self.buckets} BUCKETS"
            self.spark.sql(f"{text} LOCATION '{path}'")
            if by:
                self.spark.sql(f"MSCK REPAIR TABLE {self.full(name)}")
            found.append(name)
        return found

    @staticmethod
    def view(name: str, df: DataFrame) -> DataFrame:
        """Register ``df`` as a view; nothing is computed or stored."""
        df.createOrReplaceTempView(name)
        return df
