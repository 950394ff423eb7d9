"""Loading many files: hash, fingerprint, skip known files, fold, merge, log."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, replace
from datetime import datetime, timezone
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from ..functions.columns import any_null, as_list, quoted
from ..functions.conform import conform_schema, lost_value, with_load_stamps
from ..functions.hashing import SLICE_STARTS, hash_slices, row_hash, row_hash_null_safe, with_row_hash
from ..operators import merge
from ..operators.files import (
    LOAD_LOG_SCHEMA,
    file_fingerprints,
    is_loaded,
    log_rows,
    new_files,
)
from ..operators.first import by_repeats, one_per_key
from ..operators.fold import fold_insert_only, fold_keyed
from ..operators.quality import pk_violations
from ..sources.delimited import as_text, inferred_types, list_files, read_csv, typed
from ..sources import parted
from ..sources.parted import publish, replace_partitions
from ..sources.snapshots import COMPRESSION, append, discard, shared_dir, table_or_empty
from ..sources.snapshots import replace_partitions as replace_rejects

FILE_COLUMNS = ("file_name", "file_time")
REWRITTEN = "rewritten"
LOST = "__lost"
LINE = "__line"
FAIL, SET_ASIDE = "fail", "set_aside"
BAD_CAST_PREFIX = "bad_cast:"  # fixed value: what stands in ``reject_reason``


def accept_files(
    rows: DataFrame,
    log: DataFrame,
    *,
    files: DataFrame | None = None,
    hash_column: str = "row_hash",
) -> DataFrame:
    """Files that are new by content: ``file_name``, ``file_time``, ``file_hash``.

    Files are taken in order of ``file_time``, then ``file_name``; of files with equal
    content the first counts. ``files`` lists them all, also those without rows.
    """
    prints = file_fingerprints(rows, FILE_COLUMNS, hash_column, files)
    return new_files(prints, log, [F.col(c) for c in reversed(FILE_COLUMNS)])


def rows_to_load(
    rows: DataFrame, accepted: DataFrame, *, hash_column: str = "row_hash"
) -> DataFrame:
    """Rows of accepted files, once per file and hash, with their ``load_order``.

    Copies within a file enter its fingerprint, but only one of them is loaded.
    """
    kept = rows.join(accepted.select(*FILE_COLUMNS), list(FILE_COLUMNS), "left_semi")
    kept = kept.select(*[quoted(c) for c in rows.columns])
    distinct = one_per_key(kept, ["file_name", hash_column])
    return distinct.withColumn("load_order", F.struct("file_time", "file_name")).drop(
        *FILE_COLUMNS
    )


def doubled_keys(
    rows: DataFrame,
    accepted: DataFrame,
    keys: str | Iterable[str],
    *,
    hash_column: str = "row_hash",
) -> DataFrame:
    """Keys under which one accepted file has different rows; merging it is undefined.

    Only keys and hashes are read, and a key however frequent is one row per task.
    """
    keys = as_list(keys)
    kept = rows.filter(~any_null(keys)).join(
        accepted.select(*FILE_COLUMNS), list(FILE_COLUMNS), "left_semi"
    )
    slices = enumerate(hash_slices(hash_column))
    spans = kept.groupBy("file_name", *[quoted(k) for k in keys]).agg(
        *[f(s).alias(f"__{name}{i}") for i, s in slices for name, f in (("low", F.min), ("high", F.max))],
    )
    differ = [F.col(f"__low{i}") != F.col(f"__high{i}") for i in range(len(SLICE_STARTS))]
    return spans.filter(reduce(or_, differ)).select("file_name", *[quoted(k) for k in keys])


class Staging:
    """Intermediate tables in the shared folder, deleted at the end of a load.

    A staged result is computed once, survives lost executors, and has a known size,
    by which Spark can tell whether to broadcast it.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, *_) -> None:
        for path in self.paths:
            discard(self.spark, path)

    def table(self, df: DataFrame, name: str) -> DataFrame:
        self.paths.append(shared_dir(self.spark, name))
        df.write.option("compression", COMPRESSION).parquet(self.paths[-1])
        return self.spark.read.schema(df.schema).parquet(self.paths[-1])


def load_csv(
    spark: SparkSession,
    paths: str | Iterable[str],
    table: str,
    log_table: str,
    root: str,
    *,
    primary_key: str | Iterable[str] | None = None,
    changes_table: str | None = None,
    load_time: datetime | Column | None = None,
    schema: StructType | str | None = None,
    infer_schema: bool = True,
    header: bool = True,
    delimiter: str = ",",
    drop_index_column: bool = False,
    null_safe_hash: bool = False,
    bad_values: str = FAIL,
    rejects_table: str | None = None,
    parts: int | None = None,
) -> Loaded:
    """Load the files under ``paths`` that ``log_table`` does not know into ``table``.

    The files are parsed and hashed once, into a staged table, and folded into one
    merge, see :func:`merge_into_table`. The log is written last: a run that breaks off
    is repeated by the next one, which changes nothing more, except that rows with a
    NULL key are inserted again.

    With a ``header`` columns go by name, file by file. Without a ``schema`` rows are
    hashed as the text the file holds, so that a file's fingerprint does not depend on
    the files beside it; types are inferred for a new table only.

    A value that does not fit its column's type is an error that stops the load, unless
    ``bad_values`` is ``set_aside``: then its row goes to ``rejects_table`` with
    ``bad_cast:<column>`` as its reason, and the other rows are loaded. Fingerprints cover
    both. Rejects are kept per file content, so a repeated load replaces its own.
    """
    if bad_values not in (FAIL, SET_ASIDE) or (bad_values == SET_ASIDE and rejects_table is None):
        raise ValueError("bad_values is fail, or set_aside with a rejects_table")
    load_time = _time(load_time)
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    exists = spark.catalog.tableExists(table)
    known = spark.table(table).drop(parted.PART).schema if exists else StructType()
    with Staging(spark) as staging:
        parsed = read_csv(
            spark, paths, schema=as_text(schema) if schema is not None else None, infer_schema=False,
            order=known.names, with_file=True, header=header, delimiter=delimiter,
            drop_index_column=drop_index_column, stage=staging.table,
        )
        data = [c for c in parsed.columns if c not in FILE_COLUMNS]
        if schema is not None:
            types = {f.name: f.dataType for f in schema.fields}
        elif exists or not infer_schema:
            types = {c: f.dataType for c in data for f in known.fields if f.name.lower() == c.lower()}
        else:
            types = inferred_types(parsed, data)
        as_typed = {c: typed(quoted(c), types.get(c, StringType())) for c in data}
        tests = [F.when(quoted(c).isNotNull() & as_typed[c].isNull(), F.lit(c)) for c in data]
        # a table's types are applied in the merge; here they tell values that will not fit
        values = {c: quoted(c) if schema is None and exists else as_typed[c] for c in data}
        line = F.to_csv(F.struct(*[quoted(c) for c in data]), {"sep": delimiter}) if bad_values == SET_ASIDE else F.lit(None)
        extra = [F.coalesce(*tests, F.lit(None).cast("string")).alias(LOST), line.cast("string").alias(LINE)]
        hash_ = row_hash_null_safe if null_safe_hash else row_hash
        columns = [values[c].alias(c) for c in data]
        if (schema is not None or exists) and "row_hash" not in {c.lower() for c in data}:
            # the hash of the values as they are stored: cheaper to repeat than to keep
            rows = staging.table(parsed.select(*columns, *FILE_COLUMNS, *extra), "rows")
            rows = rows.withColumn("row_hash", hash_(data))
        else:
            extra.append(hash_(data, [quoted(c) for c in data]).alias("row_hash"))
            rows = staging.table(parsed.select(*columns, *FILE_COLUMNS, *extra), "rows")
        log = table_or_empty(spark, log_table, LOAD_LOG_SCHEMA)
        files = accept_files(rows, log, files=list_files(spark, paths))
        accepted = staging.table(files, "accepted")
        if accepted.isEmpty():
            return Loaded()
        bad = rows.filter(F.col(LOST).isNotNull())
        if bad_values == SET_ASIDE:
            set_aside = _set_aside(bad, accepted, rejects_table, root)
        else:
            taken = bad.join(accepted.select(*FILE_COLUMNS), list(FILE_COLUMNS), "left_semi").select(LOST).first()
            if taken is not None:
                raise ValueError(f"{table}: value does not fit column {taken[0]}")
            set_aside = 0
        good = rows.filter(F.col(LOST).isNull()).drop(LOST, LINE)
        if primary_key is None:
            folded = _first_rows(good, accepted, staging)
        else:
            loads = staging.table(rows_to_load(good, accepted), "loads")  # read three times
            if not doubled_keys(good, accepted, primary_key).isEmpty():
                raise ValueError("Duplicate primary keys detected")
            folded = fold_keyed(loads, primary_key, "load_order", force=REWRITTEN)
            folded = folded.drop("load_seq", "updated_seq", "load_order")
        merged = merge_into_table(
            folded,
            table,
            root,
            primary_key=primary_key,
            changes_table=changes_table,
            load_time=load_time,
            folded=primary_key is not None,
            stored=primary_key is None,
            parts=parts,
        )
        append(log_rows(accepted, load_time), log_table, root)
        return Loaded(accepted.count(), set_aside, merged)


def _first_rows(rows: DataFrame, accepted: DataFrame, staging: Staging) -> DataFrame:
    """Per hash its row from the first accepted file that has it; hashes that occur once are not moved."""
    kept = rows.join(accepted.select(*FILE_COLUMNS), list(FILE_COLUMNS), "left_semi").select(*[quoted(c) for c in rows.columns])
    alone, again = by_repeats(kept, "row_hash")
    first = fold_insert_only(rows_to_load(again, accepted), "load_order").drop("load_seq", "load_order")
    return alone.drop(*FILE_COLUMNS).unionByName(staging.table(first, "first"))


def _set_aside(bad: DataFrame, accepted: DataFrame, rejects_table: str, root: str) -> int:
    """Write rows with a bad value to the rejects; returns their number.

    A file's rejects are one partition named by its content, so writing them again
    replaces them.
    """
    spark = bad.sparkSession
    seen = Observation()
    kept = bad.join(accepted, list(FILE_COLUMNS)).select(
        "file_name",
        F.col(LINE).alias("line"),
        F.concat(F.lit(BAD_CAST_PREFIX), F.col(LOST)).alias("reject_reason"),
        "file_hash",
    )
    replace_rejects(kept.observe(seen, F.count(F.lit(1)).alias("n")), rejects_table, "file_hash", root)
    return seen.get["n"]


@dataclass(frozen=True)
class Merged:
    """What a merge did: rows by kind of change, the parts written, the feed's version."""

    inserted: int = 0
    updated: int = 0
    parts: tuple[int, ...] = ()
    version: int | None = None


@dataclass(frozen=True)
class Loaded:
    """What a load did: files taken, rows set aside, and its merge."""

    files: int = 0
    set_aside: int = 0
    merged: Merged = Merged()


def merge_into_table(
    df: DataFrame,
    table: str,
    root: str,
    *,
    primary_key: str | Iterable[str] | None = None,
    changes_table: str | None = None,
    load_time: datetime | Column | None = None,
    folded: bool = False,
    stored: bool = False,
    parts: int | None = None,
) -> Merged:
    """Create ``table`` from the rows, or merge them into it; its files go under ``root``.

    With ``primary_key`` changed rows are updated and new ones inserted, else rows with
    a new hash are inserted. A new table is cut into ``parts`` by key (as many as a shuffle has
    partitions, if not given), see :mod:`~rollforward.sources.parted`: keys and hashes of the parts that the rows fall
    into are compared first, then the parts with a change alone are read and written. Without
    a key, hashes alone are compared; new rows become a part of their own, or, in a table
    with a key, come to the parts they belong to.

    ``changes_table`` receives the change rows as one new version, together with the rows:
    a merge that breaks off or loses against another load leaves neither. A table
    that another load has changed in the meantime is an error. A value that does not fit the
    table's type and a key that the rows hold twice are errors before anything is written.
    Column names match in any case; ``folded`` rows come from a keyed fold of files that
    were checked. Rows are stored first, as they are read several times; ``stored`` ones are cheap to
    read again. A table that is not in parts is rewritten as one first.
    """
    spark = df.sparkSession
    keys = as_list(primary_key) if primary_key is not None else []
    hashed = df if "row_hash" in df.columns else with_row_hash(df)
    stamped = with_load_stamps(hashed, _time(load_time))
    force = REWRITTEN if folded and keys else None
    parts = parts or parted.default_parts(spark)
    with Staging(spark) as staging:
        state = _opened(spark, table, root, keys, parts)
        target, wanted = _target(spark, table, stamped, [REWRITTEN] if folded else [])
        lost = lost_value(stamped, wanted).alias(LOST)
        conformed = conform_schema(stamped, wanted, [lost])
        cut_by = list(state.keys) if state else keys
        if cut_by:
            dealt = parted.part_of(cut_by, state.parts if state else parts, ["row_hash"])
            conformed = conformed.withColumn(parted.PART, dealt)
        source = conformed if stored else staging.table(conformed, "source")
        bad = source.filter(quoted(LOST).isNotNull()).select(LOST).first()
        if bad is not None:
            raise ValueError(f"{table}: value does not fit column {bad[0]}")
        source = source.drop(LOST)
        if keys and not folded:
            doubled = pk_violations(source.filter(~any_null(keys)), keys)
            if not doubled.isEmpty():
                raise ValueError("Duplicate primary keys detected")
        if state is None:
            state = _created(spark, table, target.schema, root, keys, parts)
            target = spark.table(table)
        parted.require_state(spark, table, state)
        attempt = parted.new_attempt(state)
        try:
            if keys:
                merged = _write_changed_parts(spark, table, source, keys, force, attempt, changes_table is not None)
            else:
                new = _new_rows(spark, table, source)
                if parted.PART in new.columns:
                    new = staging.table(new, "new")
                    merged = _write_new_rows(spark, table, new, attempt, changes_table is not None)
                else:
                    merged = _write_new_part(spark, table, new, attempt)
            if merged.parts:
                version = parted.newest_version(spark, changes_table) + 1 if changes_table else None
                publish(spark, table, attempt, state, changes_table, version)
                merged = replace(merged, version=version)
        except Exception:
            if _is_loose(spark, table, attempt):
                discard(spark, attempt)
            raise
    return merged


def replace_in_table(
    df: DataFrame,
    table: str,
    root: str,
    *,
    keys: str | Iterable[str],
    parts: int | None = None,
) -> Merged:
    """Create ``table`` from the rows, or replace the rows with their keys as a whole.

    Keys are unique in ``df``. Only the parts of these keys are read and written. A table that
    another load has changed in the meantime is an error, and left as it is.
    """
    spark, keys = df.sparkSession, as_list(keys)
    parts = parts or parted.default_parts(spark)
    with Staging(spark) as staging:
        state = _opened(spark, table, root, keys, parts)
        dealt = parted.part_of(keys, state.parts if state else parts)
        source = staging.table(df.withColumn(parted.PART, dealt), "source")
        counts = source.groupBy(parted.PART).count().collect()  # at most one per part
        if state is None:
            state = _created(spark, table, df.schema, root, keys, parts)
        touched = sorted(r[parted.PART] for r in counts)
        if not touched:
            return Merged()
        attempt = parted.new_attempt(state)
        try:
            old = parted.in_parts(spark.table(table), touched)
            replace_partitions(merge.update_all(old, source, keys), attempt)
            publish(spark, table, attempt, state)
        except Exception:
            if _is_loose(spark, table, attempt):
                discard(spark, attempt)
            raise
    return Merged(updated=sum(r["count"] for r in counts), parts=tuple(touched))


def _write_changed_parts(
    spark: SparkSession, table: str, source: DataFrame, keys: list[str], force: str | None, attempt: str, feed: bool
) -> Merged:
    """Write the parts that the source changes, as they will be, and the change rows."""
    touched = [r[0] for r in source.select(parted.PART).distinct().collect()]  # at most one per part
    now = parted.in_parts(spark.table(table), touched)
    kinds = merge.kinds_of_change(now, source, keys, force=force, carry=[parted.PART])
    counts = kinds.groupBy(parted.PART, "kind").count().collect()  # at most two per part
    changed = sorted({r[parted.PART] for r in counts})
    if not changed:
        return Merged()
    old, new = parted.in_parts(spark.table(table), changed), parted.in_parts(source, changed)
    replace_partitions(merge.upsert_changed(old, new, keys, force=force), attempt)
    if feed:
        moved = merge.upsert_changes(old, new, keys, force=force)
        parted.write_changes(moved.drop(parted.PART), attempt)
    n = lambda kind: sum(r["count"] for r in counts if r["kind"] == kind)
    return Merged(n(merge.INSERT), n(merge.UPDATE), tuple(changed))


def _new_rows(spark: SparkSession, table: str, source: DataFrame) -> DataFrame:
    """The change rows of an insert by hash; hashes that neither side has again are not moved."""
    known = spark.table(table).select("row_hash")
    if not parted.partition_values(spark, table):
        return source.withColumn("_change_type", F.lit(merge.INSERT))
    alone, again = by_repeats(source, "row_hash", known)
    return alone.withColumn("_change_type", F.lit(merge.INSERT)).unionByName(merge.insert_only_changes(known, again))


def _write_new_part(spark: SparkSession, table: str, new: DataFrame, attempt: str) -> Merged:
    """Add change rows as a part of their own, written once: the feed's version has the same folder."""
    part, seen = max(parted.partition_values(spark, table), default=-1) + 1, Observation()
    parted.write_part(new.observe(seen, F.count(F.lit(1)).alias("n")), attempt, part)
    if not seen.get["n"]:
        discard(spark, attempt)
        return Merged()
    return Merged(inserted=seen.get["n"], parts=(part,))


def _write_new_rows(spark: SparkSession, table: str, new: DataFrame, attempt: str, feed: bool) -> Merged:
    """Add rows to the parts that their keys belong to."""
    rows = new.drop("_change_type")
    counts = rows.groupBy(parted.PART).count().collect()  # at most one per part
    changed = sorted(r[parted.PART] for r in counts)
    if not changed:
        return Merged()
    known = parted.in_parts(spark.table(table), changed)
    replace_partitions(known.unionByName(rows), attempt)
    if feed:
        parted.write_changes(new.drop(parted.PART), attempt)
    return Merged(inserted=sum(r["count"] for r in counts), parts=tuple(changed))


def _opened(spark: SparkSession, table: str, root: str, keys: list[str], parts: int) -> parted.State | None:
    """The table's state, after what an earlier load left undone; None if there is no table."""
    if not spark.catalog.tableExists(table):
        return None
    state = parted.state_of(spark, table)
    if state is None:
        spread = [c for c in spark.table(table).columns if c == "row_hash"]
        return parted.adopt(spark, table, root, keys, parts, spread)
    if keys and list(state.keys) != keys:
        raise ValueError(f"{table} has the key {list(state.keys)}, not {keys}")
    parted.settle(spark, table)
    return parted.state_of(spark, table)


def _created(
    spark: SparkSession, table: str, schema: StructType, root: str, keys: list[str], parts: int
) -> parted.State:
    if spark.catalog.tableExists(table):
        raise RuntimeError(f"{table} was made by another load; load again")
    return parted.create_table(spark, table, schema, root, keys=keys, parts=parts)


def _is_loose(spark: SparkSession, table: str, attempt: str) -> bool:
    state = parted.state_of(spark, table)
    return state is not None and state.attempt != attempt


def is_file_loaded(spark: SparkSession, log_table: str, file_hash: str) -> bool:
    """Whether the log knows a content hash; without a log it knows none."""
    return is_loaded(table_or_empty(spark, log_table, LOAD_LOG_SCHEMA), file_hash)


def log_file(
    spark: SparkSession,
    log_table: str,
    root: str,
    file_name: str,
    file_hash: str,
    load_time: datetime | None = None,
) -> None:
    """Append one row to the load log."""
    row = (file_name, file_hash, load_time or datetime.now(timezone.utc))
    append(spark.createDataFrame([row], LOAD_LOG_SCHEMA), log_table, root)


def _time(given: datetime | Column | None) -> Column:
    """One time for a whole load, also where it takes several jobs."""
    if isinstance(given, Column):
        return given
    return F.lit(given or datetime.now(timezone.utc)).cast("timestamp")


def _target(
    spark: SparkSession, table: str, source: DataFrame, extra: list[str]
) -> tuple[DataFrame, StructType]:
    """The target table, and the schema the source takes for it with ``extra`` columns."""
    columns = [f for f in source.schema.fields if f.name not in extra]
    target = table_or_empty(spark, table, StructType(columns)).drop(parted.PART)
    known = {name.lower() for name in target.columns}
    unknown = [f.name for f in columns if f.name.lower() not in known]
    if unknown:
        raise ValueError(f"{table} has no column for {sorted(unknown)}")
    kept = [f for f in source.schema.fields if f.name in extra]
    return target, StructType([*target.schema.fields, *kept])
