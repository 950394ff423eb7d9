"""Tables in parts: each part is a partition of the catalog table with a folder of its own.

In a keyed table a row's part is a hash of its key, so the rows a merge can touch are found
by their parts. A merge writes the parts it changes to a new folder, its attempt, and then
points these partitions of the catalog there; all other parts are neither read nor written.
In a table without a key a part is one load.

An attempt becomes part of the table by one change of the table's properties. What follows from it
(partitions that move, the version that a change feed gains) is repeated by the next
load if a load breaks off in between, see :func:`settle`. Before that change an attempt is a folder
nobody reads, so a load that loses a race or breaks off leaves nothing visible.

A reader that plans its query while partitions are moved may see some of them before and
others after; the catalog has no change of several partitions at once.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from ..functions.columns import any_null, as_list, quoted
from ..functions.hashing import packed, unpacked
from .snapshots import COMPRESSION, discard

PART = "_part"
VERSION = "version"
_INT = IntegerType()

# The table properties in which the state of a table is kept.
PARTS_PROPERTY = "rollforward.parts"
KEYS_PROPERTY = "rollforward.keys"
ROOT_PROPERTY = "rollforward.root"
ATTEMPT_PROPERTY = "rollforward.attempt"
SETTLED_PROPERTY = "rollforward.settled"
FEED_PROPERTY = "rollforward.feed"
VERSION_PROPERTY = "rollforward.version"


@dataclass(frozen=True)
class State:
    """How a table is cut, and the last attempt that became part of it."""

    parts: int  # 0: a part is a load
    keys: tuple[str, ...]
    root: str
    attempt: str
    settled: str
    feed: str
    version: int

    @property
    def key_columns(self) -> list[str]:
        return list(self.keys)


def properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def state_of(spark: SparkSession, table: str) -> State | None:
    """The state of a table in parts; None where there is no table, or one of another kind."""
    if not spark.catalog.tableExists(table):
        return None
    found = properties(spark, table)
    if PARTS_PROPERTY not in found:
        return None
    return State(
        int(found[PARTS_PROPERTY]),
        tuple(k for k in found[KEYS_PROPERTY].split("\n") if k),
        found[ROOT_PROPERTY],
        found.get(ATTEMPT_PROPERTY, ""),
        found.get(SETTLED_PROPERTY, ""),
        found.get(FEED_PROPERTY, ""),
        int(found.get(VERSION_PROPERTY, "-1")),
    )


def part_of(keys: Iterable[str], parts: int, spread: Iterable[str] = ()) -> Column:
    """The part of a key. Rows with a NULL key match nothing and are dealt by ``spread``."""
    keys, spread = as_list(keys), as_list(spread)
    dealt = lambda names: F.pmod(F.xxhash64(*[quoted(n) for n in names]), F.lit(parts)).cast("int")
    return F.when(any_null(keys), dealt(spread or keys)).otherwise(dealt(keys))


def default_parts(spark: SparkSession) -> int:
    """As many parts as a shuffle of this session has partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def create_table(
    spark: SparkSession, table: str, schema: StructType, root: str, *, keys: Iterable[str] = (), parts: int | None = None
) -> State:
    """An empty table in parts; without ``keys`` each load is a part."""
    keys = as_list(keys)
    state = {
        PARTS_PROPERTY: str((parts or default_parts(spark)) if keys else 0),
        KEYS_PROPERTY: "\n".join(keys),
        ROOT_PROPERTY: f"{root.rstrip('/')}/{table}",
    }
    _create(spark, table, schema.fields, StructField(PART, _INT), state[ROOT_PROPERTY], state)
    return state_of(spark, table)


def adopt(
    spark: SparkSession, table: str, root: str, keys: Iterable[str], parts: int, spread: Iterable[str] = ()
) -> State:
    """Rewrite a table that is not in parts as one that is; its old files stay where they are."""
    keys = as_list(keys)
    rows = spark.table(table)
    attempt = f"{root.rstrip('/')}/{table}/{uuid.uuid4().hex}"
    replace_partitions(rows.withColumn(PART, part_of(keys, parts, spread) if keys else F.lit(0)), attempt)
    schema = rows.schema
    spark.sql(f"DROP TABLE {table}")
    state = create_table(spark, table, schema, root, keys=keys, parts=parts)
    publish(spark, table, attempt, state)
    return state_of(spark, table)


def rows_of(spark: SparkSession, table: str) -> DataFrame:
    """The rows without their part."""
    return spark.table(table).drop(PART)


def in_parts(df: DataFrame, parts: Iterable[int]) -> DataFrame:
    """Rows of some parts; on a table a filter of partitions."""
    return df.filter(quoted(PART).isin(*parts))


def new_attempt(state: State) -> str:
    return f"{state.root}/{uuid.uuid4().hex}"


def replace_partitions(df: DataFrame, attempt: str, parts: Iterable[int] = (), *, dealt: bool = False) -> None:
    """Write the whole new content of the parts that ``df`` holds, and of ``parts``.

    Rows of a part meet in one task, unless they are many: then adaptive execution splits them.
    If ``df`` is ``dealt``, each part is in one task already and does not move. Of ``parts``,
    those without a row will be empty.
    """
    texts = [f.name for f in df.schema.fields if f.dataType == StringType() and not dealt]
    moved = df.withColumns({t: packed(quoted(t)) for t in texts})
    moved = moved if dealt else moved.hint("rebalance", PART)
    whole = moved.withColumns({t: unpacked(quoted(t)) for t in texts})
    whole.write.option("compression", COMPRESSION).partitionBy(PART).parquet(f"{attempt}/rows")
    spark = df.sparkSession
    for part in parts:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{attempt}/rows/{PART}={part}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)


def write_part(changes: DataFrame, attempt: str, part: int) -> None:
    """Write change rows as a new part: a version of a feed that has no other folder is read there."""
    changes.write.option("compression", COMPRESSION).parquet(f"{attempt}/rows/{PART}={part}")


def write_changes(df: DataFrame, attempt: str) -> None:
    df.write.option("compression", COMPRESSION).parquet(f"{attempt}/changes")


def publish(
    spark: SparkSession, table: str, attempt: str, before: State, feed: str | None = None, version: int | None = None
) -> None:
    """Make an attempt part of the table, and its changes a version of ``feed``.

    Raises if another load did so since ``before`` was read; nothing is visible then.
    """
    require_state(spark, table, before)
    changed = {ATTEMPT_PROPERTY: attempt, FEED_PROPERTY: feed or "", VERSION_PROPERTY: str(-1 if version is None else version)}
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({_listed(changed)})")
    settle(spark, table)


def require_state(spark: SparkSession, table: str, before: State) -> None:
    """Raise if another load has changed the table."""
    now = state_of(spark, table)
    if now is None or now.attempt != before.attempt:
        raise RuntimeError(f"{table} was changed by another load; load again")


def settle(spark: SparkSession, table: str) -> None:
    """Do what follows from the last attempt, where that was not finished; again it does nothing."""
    state = state_of(spark, table)
    if state is None or state.attempt == state.settled:
        return
    if state.feed:
        _add_version(spark, state)
    written = {int(name.partition("=")[2]): path for name, path in folders(spark, f"{state.attempt}/rows", f"{PART}=")}
    if written:  # the catalog is not listed: it may hold many more partitions than these
        new = [f"PARTITION ({PART}={p}) LOCATION {_text(path)}" for p, path in sorted(written.items())]
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(new)}")
    for part, path in sorted(written.items()):
        spark.sql(f"ALTER TABLE {table} PARTITION ({PART}={part}) SET LOCATION {_text(path)}")
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({_listed({SETTLED_PROPERTY: state.attempt})})")
    spark.catalog.refreshTable(table)


def newest_version(spark: SparkSession, feed: str) -> int:
    """The newest version of a change feed in parts, -1 if there is none. Reads the catalog only."""
    return max(partition_values(spark, feed), default=-1) if spark.catalog.tableExists(feed) else -1


def partition_values(spark: SparkSession, table: str) -> list[int]:
    """The values of a table's only partition column."""
    return [int(r[0].partition("=")[2]) for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]


def folders(spark: SparkSession, path: str, prefix: str) -> list[tuple[str, str]]:
    """Name and path of the folders directly below ``path``."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(root):
        return []
    found = [(s.getPath().getName(), s.getPath().toString()) for s in system.listStatus(root) if s.isDirectory()]
    return [(name, full) for name, full in found if name.startswith(prefix)]


def live_folders(spark: SparkSession, table: str) -> set[str]:
    """The folders that a table's partitions are in."""
    return {path.rstrip("/") for path in _locations(spark, table).values()}


def expire(spark: SparkSession, table: str) -> list[str]:
    """Delete the folders below the table's root that no partition of it or its feed is in.

    Not to be called while a load or a query of the table runs: an attempt that is
    being written, or a folder that a running query reads, would go.
    """
    settle(spark, table)
    state = state_of(spark, table)
    if state is None:
        raise ValueError(f"{table} is not a table in parts")
    live = live_folders(spark, table)
    if state.feed:
        live |= live_folders(spark, state.feed)
    gone = []
    for _, attempt in folders(spark, state.root, ""):
        inner = [path for _, path in folders(spark, f"{attempt}/rows", f"{PART}=")] + [f"{attempt}/changes"]
        dead = [path for path in inner if not _among(path, live)]
        for path in dead if len(dead) < len(inner) else [attempt]:
            if discard(spark, path):
                gone.append(path)
    return gone


def _among(path: str, live: set[str]) -> bool:
    plain = lambda p: p.partition(":")[2] if ":" in p.split("/", 1)[0] else p
    return plain(path) in {plain(p) for p in live}


def _locations(spark: SparkSession, table: str) -> dict[int, str]:
    column = next(iter(_partition_columns(spark, table)))
    found = {}
    for value in partition_values(spark, table):
        lines = spark.sql(f"DESCRIBE TABLE EXTENDED {table} PARTITION ({column}={value})").collect()
        found[value] = next(r["data_type"] for r in lines if r["col_name"] == "Location")
    return found


def _partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def _add_version(spark: SparkSession, state: State) -> None:
    """Make the attempt's changes a version of the feed, a partition with that folder."""
    path = f"{state.attempt}/changes"
    if not folders(spark, state.attempt, "changes"):
        [(_, path)] = folders(spark, f"{state.attempt}/rows", f"{PART}=")
    if not spark.catalog.tableExists(state.feed):
        fields = [f for f in spark.read.parquet(path).schema.fields if f.name != VERSION]
        _create(spark, state.feed, fields, StructField(VERSION, _INT), f"{state.root}-{VERSION}s", {PARTS_PROPERTY: "0", KEYS_PROPERTY: "", ROOT_PROPERTY: state.root})
    spark.sql(
        f"ALTER TABLE {state.feed} ADD IF NOT EXISTS PARTITION ({VERSION}={state.version}) LOCATION {_text(path)}"
    )
    spark.catalog.refreshTable(state.feed)


def _create(
    spark: SparkSession, table: str, fields: list[StructField], partition: StructField, path: str, state: dict[str, str]
) -> None:
    columns = [f"{_name(f.name)} {f.dataType.simpleString()}" for f in [*fields, partition]]
    spark.sql(
        f"CREATE TABLE {table} ({', '.join(columns)}) USING parquet PARTITIONED BY ({_name(partition.name)}) "
        f"LOCATION {_text(path)} TBLPROPERTIES ({_listed(state)})"
    )


def _name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _text(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n")
    return f"'{escaped}'"


def _listed(values: dict[str, str]) -> str:
    return ", ".join(f"{_text(k)} = {_text(v)}" for k, v in values.items())
