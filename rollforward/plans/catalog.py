"""Every operator as a query over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.conform import conform_schema, rename_cast, with_load_stamps
from ..functions.hashing import row_hash, row_hash_null_safe, with_row_hash
from ..operators import changes, merge, quality
from ..operators.files import empty_load_log, file_fingerprints, log_rows, new_files
from ..operators.first import all_but_first, dedup_by_hash, keep_first, total_order
from ..operators.fold import fold_insert_only, fold_keyed
from ..operators.part_changes import change_feed_by_parts as changes_of_parts
from ..operators.rollup import latest_rollup, latest_with_ties
from ..sources.delimited import read_csv, write_csv
from ..sources import parted
from ..sources.snapshots import COMPRESSION, replace_partitions, shared_dir
from ..streaming.keyed import KeyedReplay
from ..streaming.replay import StreamReplay
from .circuits import (
    CIRCUIT_ROLLUP,
    CIRCUIT_RULES,
    CIRCUIT_SCHEMA,
    RAW_MAPPING,
    SECTION_ROLLUP,
    SUMMARY_SCHEMA,
)
from .incremental import read_watermark, replay, reset, run
from .ingest import SET_ASIDE, accept_files, load_csv, rows_to_load

Query = Callable[[SparkSession, str], DataFrame]
SNAPSHOT_PARTS = 16


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- inputs derived from the tables -------------------------------------------------


def circuits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as circuit rows: part = circuit, line = section, ship month = date."""
    li = table(spark, sf_dir, "lineitem")
    hashed = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate"]
    return li.select(
        F.when(F.col("l_orderkey") % 97 != 0, F.col("l_partkey")).alias("circuit_id"),
        F.when(F.col("l_orderkey") % 89 != 0, F.col("l_linenumber")).alias("section_id"),
        F.col("l_extendedprice").alias("n_voltage_kv"),
        F.col("l_quantity").alias("f_voltage_kv"),
        F.col("l_discount").alias("f_max_hc"),
        F.col("l_tax").alias("f_min_hc"),
        F.date_trunc("month", "l_shipdate").cast("timestamp_ntz").alias("f_hca_date"),
        F.col("l_quantity").alias("shape_length"),
        (F.year("l_shipdate") - 1995).alias("version"),
        row_hash(hashed).alias("row_hash"),
    )


def redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The circuit rows, some of them delivered a second time."""
    copies = F.when(F.col("row_hash").startswith("0"), F.sequence(F.lit(1), F.lit(2)))
    rows = circuits(spark, sf_dir)
    once = F.array(F.lit(1))
    return rows.withColumn("copy", F.explode(F.coalesce(copies, once))).drop("copy")


def order_snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """orders before and after: finished ones leave, open ones come, urgent ones change."""
    orders = table(spark, sf_dir, "orders")
    urgent = F.col("o_orderpriority") == "1-URGENT"
    price = F.col("o_totalprice")
    k = F.col("o_orderkey").alias("k")
    before = orders.filter(F.col("o_orderstatus") != "O").select(k, price.alias("v"))
    after = orders.filter(F.col("o_orderstatus") != "F").select(
        k, F.when(urgent, price + 1).otherwise(price).alias("v")
    )
    return with_row_hash(before), with_row_hash(after)


def event_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One small file per day and user; many of them have equal content."""
    events = table(spark, sf_dir, "events")
    name = F.concat_ws("-", F.to_date("ts"), "user_id")
    return events.select(name.alias("file_name"), row_hash(["event_type"]).alias("row_hash"))


def daily_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per day a load with one row per user."""
    events = table(spark, sf_dir, "events")
    return events.groupBy(F.to_date("ts").alias("seq"), F.col("user_id").alias("k")).agg(
        F.max("event_type").alias("v")
    )


def delivered_twice(rows: DataFrame, day: str) -> DataFrame:
    """Rows as files, one per day, each followed by a copy of itself an hour later."""
    start = F.col(day).cast("timestamp")
    deliveries = F.array(
        F.struct(F.concat(F.lit("first-"), day).alias("file_name"), start.alias("file_time")),
        F.struct(
            F.concat(F.lit("again-"), day).alias("file_name"),
            (start + F.expr("INTERVAL 1 HOUR")).alias("file_time"),
        ),
    )
    return rows.withColumn("__d", F.explode(deliveries)).select(*rows.columns, "__d.*")


def event_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as a feed with one version per day."""
    return table(spark, sf_dir, "events").withColumn("version", F.day("ts") - 1)


def raw_circuits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as raw text columns _c1 .. _c16, zero discounts unreadable."""
    li = table(spark, sf_dir, "lineitem")
    discount = F.col("l_discount")
    fields = [
        "l_partkey",
        "l_linenumber",
        "l_linestatus",
        "l_returnflag",
        "l_linenumber",
        "l_suppkey",
        "l_extendedprice",
        F.when(discount == 0, "none").otherwise(discount.cast("string")),
        "l_returnflag",
        "l_suppkey",
        "l_quantity",
        "l_discount",
        "l_tax",
        "l_shipdate",
        "l_linestatus",
        "l_quantity",
    ]
    columns = [F.col(f) if isinstance(f, str) else f for f in fields]
    return li.select(
        *[c.cast("string").alias(f"_c{i}") for i, c in enumerate(columns, start=1)]
    )


DQ_RULES = quality.Rules(
    key=("circuit_id", "section_id", "version"),
    required=("circuit_id", "section_id"),
    order=("row_hash",),
    identity=("row_hash",),
)
DQ_TWO_STEP = quality.Rules(
    key=("row_hash",),
    required=("circuit_id", "section_id"),
    order=("version",),
    full_duplicates=quality.OFF,
)
DQ_DROP_ALL = quality.Rules(
    key=DQ_RULES.key,
    required=DQ_RULES.required,
    order=DQ_RULES.order,
    full_duplicates=quality.DROP_ALL,
    identity=DQ_RULES.identity,
)
# Of rows of one section and date the shortest counts, then the one with the smallest hash.
STREAM_RULES = quality.Rules(
    key=("version", "CIRCUIT_ID", "SECTION_ID", "F_HCA_DATE"),
    required=("CIRCUIT_ID", "SECTION_ID"),
    order=("SHAPE_LENGTH", "row_hash"),
)
LINE_ORDER = ("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_discount", "l_tax")
LINE_OUTPUT = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
DQ_COLUMNS = ("circuit_id", "section_id", "version", "f_hca_date", "shape_length", "row_hash")


# ---- sources ------------------------------------------------------------------------


def q_table_scan(spark, sf_dir):
    return table(spark, sf_dir, "orders")


def q_csv_scan(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    path = shared_dir(spark, "csv")
    write_csv(orders, path, delimiter=";")
    return read_csv(spark, path, schema=orders.schema, delimiter=";")


def q_drop_index_column(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    path = shared_dir(spark, "csv")
    indexed = orders.select(F.monotonically_increasing_id().alias("_c0"), *orders.columns)
    write_csv(indexed, path)
    return read_csv(spark, path, schema=indexed.schema, drop_index_column=True)


def q_change_range(spark, sf_dir):
    pending = changes.changes_since(event_versions(spark, sf_dir), 20)
    return pending.select("event_id", "user_id", "version")


def q_change_version(spark, sf_dir):
    one = changes.change_range(event_versions(spark, sf_dir), 7, 7)
    return one.select("event_id", "user_id", "version")


def q_latest_version(spark, sf_dir):
    feed = event_versions(spark, sf_dir).withColumnRenamed("event_type", "table_name")
    return changes.latest_version(feed, "table_name")


def q_change_feed(spark, sf_dir):
    before, after = order_snapshots(spark, sf_dir)
    return changes.change_feed(before, after, "k").select("k", "v", "_change_type")


def q_change_feed_by_parts(spark, sf_dir):
    """Both snapshots are written in parts by key; only parts whose digests differ are compared."""
    sides = []
    for side in order_snapshots(spark, sf_dir):
        path = shared_dir(spark, "snapshot")
        cut = side.withColumn(parted.PART, parted.part_of(["k"], SNAPSHOT_PARTS, ["row_hash"]))
        cut.repartition(parted.PART).write.partitionBy(parted.PART).parquet(path)
        sides.append(spark.read.schema(cut.schema).parquet(path))
    feed = changes_of_parts(*sides, "k", part=parted.PART)
    return feed.select("k", "v", "_change_type")


# ---- hashing and files --------------------------------------------------------------


def q_row_hash(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return with_row_hash(li).select("l_orderkey", "l_linenumber", "l_suppkey", "row_hash")


def q_row_hash_null_safe(spark, sf_dir):
    ids = ["circuit_id", "section_id"]
    return circuits(spark, sf_dir).select(
        F.col("row_hash").alias("id"), row_hash_null_safe(ids).alias("safe_hash")
    )


def q_file_fingerprint(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    day = F.to_date("ts").cast("string").alias("file_name")
    return file_fingerprints(with_row_hash(events).select(day, "row_hash"))


def q_new_files(spark, sf_dir):
    prints = file_fingerprints(event_files(spark, sf_dir))
    log = prints.filter(F.col("file_name") < "2024-01-03").select("file_hash")
    return new_files(prints, log).select("file_name", "file_hash")


def q_load_log(spark, sf_dir):
    prints = file_fingerprints(event_files(spark, sf_dir))
    accepted = new_files(prints, empty_load_log(spark), ["file_name"])
    return log_rows(accepted, F.lit("2024-02-01 00:00:00"))


def q_dedup_row_hash(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("text")
    return dedup_by_hash(with_row_hash(documents)).select("row_hash", "text")


# ---- merges -------------------------------------------------------------------------


def _stamped(df: DataFrame, seq: str) -> DataFrame:
    return df.withColumns({"load_seq": F.lit(seq), "updated_seq": F.lit(seq)})


def q_upsert_changed(spark, sf_dir):
    before, after = order_snapshots(spark, sf_dir)
    merged = merge.upsert_changed(
        _stamped(before, "1"), _stamped(after, "2"), "k", keep=("load_seq",)
    )
    return merged.select("k", "v", "load_seq", "updated_seq")


def q_upsert_changes(spark, sf_dir):
    before, after = order_snapshots(spark, sf_dir)
    moved = merge.upsert_changes(
        _stamped(before, "1"), _stamped(after, "2"), "k", keep=("load_seq",)
    )
    return moved.select("k", "v", "load_seq", "updated_seq", "_change_type")


def q_insert_only_merge(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    rows = events.select("event_id", "ts", row_hash(["user_id", "event_type"]).alias("row_hash"))
    late = F.day("ts") > 15
    target = rows.filter(~late).select("event_id", "row_hash")
    source = dedup_by_hash(rows.filter(late).select("event_id", "row_hash"), order=["event_id"])
    return merge.insert_only(target, source)


def q_merge_update_all(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    finished = F.col("l_linestatus") == "F"

    def rolled(rows):
        return rows.groupBy("l_partkey", "l_linenumber").agg(F.sum("l_quantity").alias("q"))

    return merge.update_all(
        rolled(li.filter(finished)), rolled(li.filter(~finished)), ["l_partkey", "l_linenumber"]
    )


def _text(df: DataFrame, *names: str):
    return [df[name].cast("string").alias(name) for name in names]


def q_upsert_fold(spark, sf_dir):
    loads = daily_states(spark, sf_dir).withColumn("row_hash", row_hash(["v"]))
    folded = fold_keyed(loads, "k", "seq")
    return folded.select("k", "v", *_text(folded, "load_seq", "updated_seq"))


def q_insert_only_fold(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    loads = events.select(
        row_hash(["user_id", "event_type"]).alias("row_hash"), F.to_date("ts").alias("seq")
    )
    first = fold_insert_only(loads, "seq")
    return first.select("row_hash", *_text(first, "load_seq"))


def q_ingest_keyed(spark, sf_dir):
    rows = delivered_twice(daily_states(spark, sf_dir), "seq")
    rows = rows.withColumn("row_hash", row_hash(["seq", "k", "v"]))
    loads = rows_to_load(rows, accept_files(rows, empty_load_log(spark)))
    states = loads.withColumn("row_hash", row_hash(["k", "v"]))
    folded = fold_keyed(states, "k", "load_order")
    names = [F.col(f"{s}.file_name").alias(f"{s[:-4]}_file") for s in ("load_seq", "updated_seq")]
    return folded.select("k", "v", *names)


def q_ingest_keyless(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    daily = events.select(F.to_date("ts").alias("seq"), "user_id", "event_type")
    rows = delivered_twice(daily, "seq")
    rows = rows.withColumn("row_hash", row_hash(["user_id", "event_type"]))
    loads = rows_to_load(rows, accept_files(rows, empty_load_log(spark)))
    first = fold_insert_only(loads, "load_order")
    return first.select("row_hash", F.col("load_seq.file_name").alias("load_file"))


@contextmanager
def scratch_tables(spark: SparkSession, *names: str):
    """Names for the tables of one query; the tables are dropped afterwards."""
    mark = uuid.uuid4().hex
    tables = [f"rollforward_{name}_{mark}" for name in names]
    try:
        yield tables
    finally:
        for name in tables:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def kept(df: DataFrame, name: str) -> DataFrame:
    """The rows, written to a folder of their own that outlives the tables they come from."""
    path = shared_dir(df.sparkSession, name)
    df.write.option("compression", COMPRESSION).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def january(day: int):
    return F.lit(f"2024-01-{day:02d} 00:00:00").cast("timestamp")


def _two_loads(spark, sf_dir, orders, log, moved, root):
    """Both snapshots of orders, loaded by key."""
    for day, snapshot in enumerate(order_snapshots(spark, sf_dir), start=1):
        path = f"{root}/in/{day}"
        write_csv(snapshot.select("k", "v"), path)
        load_csv(
            spark,
            path,
            orders,
            log,
            root,
            primary_key="k",
            changes_table=moved,
            schema="k bigint, v double",
            load_time=january(day),
        )


def q_load_csv(spark, sf_dir):
    root = shared_dir(spark, "load")
    with scratch_tables(spark, "orders", "log", "changes") as (orders, log, moved):
        _two_loads(spark, sf_dir, orders, log, moved, root)
        loaded = parted.rows_of(spark, orders)
        return kept(loaded.select("k", "v", "row_hash", "load_datetime", "updated_datetime"), "loaded")


def q_load_changes(spark, sf_dir):
    root = shared_dir(spark, "load")
    with scratch_tables(spark, "orders", "log", "changes") as (orders, log, moved):
        _two_loads(spark, sf_dir, orders, log, moved, root)
        return kept(spark.table(moved).select("k", "v", "version", "_change_type"), "moved")


def q_load_folder(spark, sf_dir):
    """One folder of files with two orders of columns, whole and broken numbers, and unreadable ones."""
    root, orders = shared_dir(spark, "load"), table(spark, sf_dir, "orders")
    k, price = F.col("o_orderkey").alias("k"), F.col("o_totalprice")
    text = F.when(F.col("o_orderkey") % 97 == 0, "n/a").when(F.col("o_orderkey") % 2 == 0, F.floor(price).cast("string"))
    value = F.coalesce(text, price.cast("string")).alias("v")
    finished = F.col("o_orderstatus") == "F"
    write_csv(orders.filter(finished).select(k, value), f"{root}/in/a")
    write_csv(orders.filter(~finished).select(value, k), f"{root}/in/b")
    with scratch_tables(spark, "orders", "log", "rejects") as (loaded, log, rejects):
        load_csv(
            spark,
            [f"{root}/in/a", f"{root}/in/b"],
            loaded,
            log,
            root,
            primary_key="k",
            schema="k bigint, v double",
            load_time=january(1),
            bad_values=SET_ASIDE,
            rejects_table=rejects,
        )
        good = parted.rows_of(spark, loaded).select("k", "v", F.lit(None).cast("string").alias("reject_reason"))
        key = F.substring_index("line", ",", 1).cast("bigint")
        bad = spark.table(rejects).select(key.alias("k"), F.lit(None).cast("double").alias("v"), "reject_reason")
        return kept(good.unionByName(bad), "folder")


def q_load_csv_keyless(spark, sf_dir):
    root, events = shared_dir(spark, "load"), table(spark, sf_dir, "events")
    late = F.day("ts") > 15
    with scratch_tables(spark, "events", "log") as (loaded, log):
        for day, rows in enumerate((events.filter(~late), events.filter(late)), start=1):
            write_csv(rows.select("user_id", "event_type"), f"{root}/in/{day}")
            load_csv(spark, f"{root}/in/{day}", loaded, log, root, load_time=january(day))
        rows = parted.rows_of(spark, loaded)
        named = rows.select(F.col("user_id").cast("bigint").alias("user_id"), "event_type", "row_hash", "load_datetime")
        return kept(named, "loaded")


# ---- conformance --------------------------------------------------------------------


def q_load_stamp(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    stamped = with_load_stamps(events, F.col("ts"))
    return stamped.select("event_id", "load_datetime", "updated_datetime")


def q_rename_cast(spark, sf_dir):
    return rename_cast(raw_circuits(spark, sf_dir), RAW_MAPPING)


def _partly_named(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("circuit_id"),
        F.col("l_linenumber").alias("section_id"),
        F.col("l_quantity").alias("f_voltage_kv"),
        F.col("l_shipdate").alias("f_hca_date"),
        F.col("l_returnflag").alias("f_notes"),
        F.col("l_tax").cast("string").alias("f_min_hc"),
    )


def q_conform_schema(spark, sf_dir):
    return conform_schema(_partly_named(spark, sf_dir), CIRCUIT_SCHEMA)


def q_conform_summary(spark, sf_dir):
    return conform_schema(_partly_named(spark, sf_dir), SUMMARY_SCHEMA)


# ---- quality ------------------------------------------------------------------------


def q_pk_violations(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    keyed = li.select(F.when(F.col("l_orderkey") % 97 != 0, F.col("l_orderkey")).alias("k"))
    found = quality.pk_violations(keyed, "k")
    return found.select("violation", *_text(found, "k"), "n")


def q_dq_null_rejects(spark, sf_dir):
    rejects = quality.null_rejects(circuits(spark, sf_dir), ["circuit_id", "section_id"])
    return rejects.select("row_hash", F.col("reject_reason").alias("reason"))


def _copies(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("lang", "text")


def q_dq_full_dups_drop_all(spark, sf_dir):
    return quality.unduplicated(_copies(spark, sf_dir))


def q_dq_full_dups_rejected(spark, sf_dir):
    return quality.duplicated(_copies(spark, sf_dir))


def q_dq_pk_first(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    keys = ["l_orderkey", "l_linenumber"]
    return keep_first(li, keys, total_order(li, LINE_ORDER)).select(*LINE_OUTPUT)


def q_dq_pk_rest(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    keys = ["l_orderkey", "l_linenumber"]
    return all_but_first(li, keys, total_order(li, LINE_ORDER)).select(*LINE_OUTPUT)


def q_dq_clean(spark, sf_dir):
    return quality.clean(redelivered(spark, sf_dir), DQ_RULES).select(*DQ_COLUMNS)


def q_dq_rejected(spark, sf_dir):
    rejects = quality.rejected(redelivered(spark, sf_dir), DQ_RULES)
    return rejects.select("row_hash", "reject_reason")


def q_dq_summary(spark, sf_dir):
    return quality.summary(redelivered(spark, sf_dir), DQ_RULES)


def q_dq_clean_two_step(spark, sf_dir):
    kept = quality.clean(redelivered(spark, sf_dir), DQ_TWO_STEP)
    return kept.select("circuit_id", "section_id", "row_hash")


def q_dq_rejected_two_step(spark, sf_dir):
    rejects = quality.rejected(redelivered(spark, sf_dir), DQ_TWO_STEP)
    return rejects.select("row_hash", "reject_reason")


def q_dq_clean_drop_all(spark, sf_dir):
    return quality.clean(redelivered(spark, sf_dir), DQ_DROP_ALL).select(*DQ_COLUMNS)


def q_dq_rejected_drop_all(spark, sf_dir):
    rejects = quality.rejected(redelivered(spark, sf_dir), DQ_DROP_ALL)
    return rejects.select("row_hash", "reject_reason")


def q_dq_summary_drop_all(spark, sf_dir):
    return quality.summary(redelivered(spark, sf_dir), DQ_DROP_ALL)


# ---- rollups and replay -------------------------------------------------------------


def _with_ids(spark, sf_dir):
    return quality.not_null(circuits(spark, sf_dir), ["circuit_id", "section_id"])


def q_latest_with_ties(spark, sf_dir):
    rows = quality.not_null(circuits(spark, sf_dir), ["circuit_id"])
    rows = rows.select("circuit_id", "section_id", "f_hca_date", "row_hash")
    latest = latest_with_ties(rows, "circuit_id", "f_hca_date")
    return latest.select("circuit_id", *_text(latest, "section_id"), "f_hca_date", "row_hash")


def q_circuit_rollup(spark, sf_dir):
    return latest_rollup(_with_ids(spark, sf_dir), CIRCUIT_ROLLUP)


def q_section_rollup(spark, sf_dir):
    return latest_rollup(_with_ids(spark, sf_dir), SECTION_ROLLUP)


def q_incremental_replay(spark, sf_dir):
    return replay(redelivered(spark, sf_dir), CIRCUIT_ROLLUP, CIRCUIT_RULES)


def q_incremental_resume(spark, sf_dir):
    feed = redelivered(spark, sf_dir)
    earlier = replay(feed, CIRCUIT_ROLLUP, CIRCUIT_RULES, until=3)
    return replay(feed, CIRCUIT_ROLLUP, CIRCUIT_RULES, after=3, target=earlier)


@contextmanager
def _replayed(spark, sf_dir):
    """The circuit feed run in two goes: root and the names of feed, rollup, watermark and rejects."""
    root = shared_dir(spark, "run")
    with scratch_tables(spark, "feed", "rollup", "watermark", "rejects") as names:
        rows = redelivered(spark, sf_dir)
        for versions in (F.col("version") <= 2, F.col("version") > 2):
            replace_partitions(rows.filter(versions), names[0], "version", root)
            run(spark, *names, root, mapping={}, change_types=None)
        yield root, *names


def q_incremental_run(spark, sf_dir):
    with _replayed(spark, sf_dir) as (_, _, rollup, _, _):
        return kept(parted.rows_of(spark, rollup), "rollup")


def q_run_rejects(spark, sf_dir):
    with _replayed(spark, sf_dir) as (_, _, _, _, rejects):
        return kept(spark.table(rejects).select("row_hash", "version", "reject_reason"), "rejects")


def q_run_watermark(spark, sf_dir):
    with _replayed(spark, sf_dir) as (_, feed, _, watermark, _):
        mark = spark.table(watermark).filter(F.col("table_name") == feed)
        return kept(mark.select(F.lit("feed").alias("table_name"), "last_processed_version"), "watermark")


def q_reset_replay(spark, sf_dir):
    with _replayed(spark, sf_dir) as (root, *names):
        rollup, watermark = names[1], names[2]
        reset(spark, watermark, root)
        if read_watermark(spark, watermark, names[0]) != changes.NEVER_PROCESSED:
            raise ValueError("the watermark was not reset")
        run(spark, *names, root, mapping={}, change_types=None)
        return kept(parted.rows_of(spark, rollup), "rollup")


def q_files_to_rollup(spark, sf_dir):
    """Raw circuit files, loaded in two goes, their changes typed, checked and rolled up."""
    root, raw = shared_dir(spark, "files"), raw_circuits(spark, sf_dir)
    schema = ", ".join(f"_c{i} string" for i in range(len(raw.columns) + 1))
    names = ("raw", "log", "feed", "rollup", "watermark", "rejects")
    with scratch_tables(spark, *names) as (loaded, log, feed, rollup, watermark, rejects):
        for day, status in enumerate("FO", start=1):
            rows = raw.filter(F.col("_c3") == status)
            indexed = rows.select(F.monotonically_increasing_id().alias("_c0"), *rows.columns)
            write_csv(indexed, f"{root}/in/{day}", header=False)
            load_csv(
                spark, f"{root}/in/{day}", loaded, log, root, changes_table=feed, schema=schema,
                header=False, drop_index_column=True, load_time=january(day),
            )
            run(spark, feed, rollup, watermark, rejects, root)
        return kept(parted.rows_of(spark, rollup), "rollup")


def q_version_watermark(spark, sf_dir):
    feed = event_versions(spark, sf_dir).withColumnRenamed("event_type", "table_name")
    processed = feed.filter(F.col("table_name").isin("click", "view") & (F.col("version") <= 9))
    seen = changes.latest_version(processed, "table_name")
    watermark = seen.select(
        "table_name",
        F.col("current_version").alias("last_processed_version"),
        F.current_timestamp().alias("last_updated"),
    )
    return changes.pending_versions(changes.latest_version(feed, "table_name"), watermark)


def _quarter_of_files(spark: SparkSession, folder: str) -> int:
    """So many files that four micro-batches or more read them all."""
    return max(1, len(spark.read.parquet(folder).inputFiles()) // 4)


def q_stream_replay(spark, sf_dir):
    feed = redelivered(spark, sf_dir)
    feed_dir = shared_dir(spark, "feed")
    feed.write.option("compression", COMPRESSION).partitionBy("version").parquet(feed_dir)
    stream = StreamReplay(shared_dir(spark, "stream"), CIRCUIT_ROLLUP, CIRCUIT_RULES)
    schema = StructType(feed.schema.fields)
    query = stream.start(spark, feed_dir, schema, files_per_batch=_quarter_of_files(spark, feed_dir))
    query.awaitTermination()
    return stream.result(spark)


def q_stream_run(spark, sf_dir):
    """Raw circuit rows with change types, typed and checked over several micro-batches."""
    raw = raw_circuits(spark, sf_dir)
    kind = F.when(F.col("_c2") == "7", "delete").when(F.col("_c2") == "6", "update_preimage").otherwise("insert")
    version = F.year(F.col("_c14").cast("timestamp_ntz")) - 1995
    feed = with_row_hash(raw).withColumns({"_change_type": kind, "version": version})
    feed_dir, out = shared_dir(spark, "feed"), shared_dir(spark, "stream")
    feed.write.option("compression", COMPRESSION).partitionBy("version").parquet(feed_dir)
    stream = KeyedReplay(
        f"rollforward_stream_{uuid.uuid4().hex}", out, CIRCUIT_ROLLUP, STREAM_RULES,
        mapping=RAW_MAPPING, change_types=changes.ROW_STATES,
    )
    try:
        query = stream.start(spark, feed_dir, feed.schema, files_per_batch=_quarter_of_files(spark, feed_dir))
        query.awaitTermination()
        return kept(stream.result(spark), "rollup")
    finally:
        for name in stream.tables:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


QUERIES: dict[str, Query] = {
    name[2:]: function for name, function in list(globals().items()) if name.startswith("q_")
}
