"""What the plans look like, and how they behave when one key holds most rows."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from rollforward.functions.hashing import with_row_hash
from rollforward.operators import merge, quality
from rollforward.operators.files import file_fingerprints
from rollforward.operators.first import flag_first, keep_first, one_per_key, repeated
from rollforward.operators.fold import fold_keyed
from rollforward.operators.rollup import latest_rollup, latest_with_ties
from rollforward.plans.circuits import CIRCUIT_ROLLUP


@contextlib.contextmanager
def settings(spark, **values):
    names = {k: k.replace("__", ".") for k in values}
    old = {n: spark.conf.get(n, None) for n in names.values()}
    for key, name in names.items():
        spark.conf.set(name, values[key])
    try:
        yield
    finally:
        for name, value in old.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def plan(df, mode="simple"):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode)
    return text.getvalue()


def final_plan(df):
    """The plan adaptive execution ended with."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


SKEW = {
    "spark__sql__shuffle__partitions": "16",
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20KB",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "10KB",
    "spark__sql__adaptive__coalescePartitions__enabled": "false",
}


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    """Half of all rows, spread over many files, belong to one key."""
    path = str(tmp_path_factory.mktemp("hot") / "rows")
    rows = spark.range(0, 40000, 1, 16).select(
        F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("k"),
        F.lit("2024-01-01").cast("timestamp").alias("d"),
        F.sha2(F.col("id").cast("string"), 256).alias("v"),
    )
    rows.write.parquet(path)
    return path


def read_hot(spark, path):
    return spark.read.parquet(path)


def largest_share(df):
    sizes = [r["n"] for r in df.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    return max(sizes) / sum(sizes)


def test_flag_first_spreads_a_hot_key(spark, hot):
    with settings(
        spark,
        spark__sql__adaptive__enabled="false",
        spark__sql__shuffle__partitions="16",
        spark__sql__files__maxPartitionBytes="200000",
        spark__sql__files__openCostInBytes="100000",
    ):
        df = read_hot(spark, hot)
        assert df.rdd.getNumPartitions() >= 12
        marked = flag_first(df, "k", [F.col("v")], "first")
        assert largest_share(marked) < 0.35
        assert marked.filter("first").count() == 20001


def test_losing_rows_are_cut_before_the_exchange(spark, hot):
    text = plan(keep_first(read_hot(spark, hot), "k", [F.col("v")]))
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_duplicates_are_combined_on_the_map_side_without_sorting(spark, hot):
    df = read_hot(spark, hot)
    text = plan(one_per_key(df, "v").select("v", "k"))
    assert "Sort" not in text and "partial_min_by" in text


def test_fingerprint_sends_one_row_per_file_and_task(spark, hot):
    df = read_hot(spark, hot).select(F.col("k").alias("file_name"), F.col("v").alias("row_hash"))
    text = plan(file_fingerprints(df))
    assert text.count("Exchange") == 1 and "partial_sum" in text and "Sort" not in text


def test_adaptive_execution_splits_a_hot_key_and_date(spark, hot):
    with settings(spark, **SKEW):
        latest = latest_with_ties(read_hot(spark, hot), "k", "d")
        assert "skew=true" in final_plan(latest)
        assert latest.count() == 40000


def test_adaptive_execution_splits_the_rows_of_a_repeated_key(spark, hot):
    with settings(spark, **SKEW):
        rows = repeated(read_hot(spark, hot), "k")
        assert "skew=true" in final_plan(rows)
        assert rows.count() == 20000


def test_null_keys_of_either_side_stay_where_they_are(spark, hot):
    with settings(
        spark,
        spark__sql__adaptive__enabled="false",
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__shuffle__partitions="16",
        spark__sql__files__maxPartitionBytes="200000",
        spark__sql__files__openCostInBytes="100000",
    ):
        df = with_row_hash(read_hot(spark, hot))
        some_null = df.withColumn("k", F.when(F.col("k") != 0, F.col("k")))
        for merged, n in (
            (merge.upsert_changed(some_null, some_null, "k", keep=()), 60000),
            (merge.update_all(some_null, some_null, "k"), 60000),
            (merge.insert_only(df, df), 40000),
        ):
            assert merged.count() == n
            assert largest_share(merged) < 0.2


def test_a_small_source_does_not_move_the_target(spark, hot):
    target = with_row_hash(read_hot(spark, hot))
    path = hot + "-source"
    target.filter("k > 0").limit(50).write.mode("overwrite").parquet(path)
    source = spark.read.parquet(path)
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="30KB"):
        for merged in (
            merge.upsert_changed(target, source, "k", keep=()),
            merge.insert_only(target, source),
            merge.update_all(target, source, "k"),
        ):
            merged.collect()
            text = plan(merged, "formatted")
            assert "BroadcastHashJoin" in text[: text.index("== Initial Plan ==")]
            moved = re.findall(r"ShuffleQueryStage .*?rowCount=([0-9.E+]+)", text)
            assert all(float(n) <= 50 for n in moved)


def test_rollup_reads_only_its_columns_and_filters_dates_at_the_scan(spark, tmp_path):
    schema = (
        "circuit_id long, section_id long, n_voltage_kv double, f_voltage_kv double, "
        "f_max_hc double, f_min_hc double, f_hca_date timestamp, shape_length double, "
        "f_notes string"
    )
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / "c"))
    df = spark.read.parquet(str(tmp_path / "c"))
    text = plan(latest_rollup(quality.not_null(df, ["circuit_id", "section_id"]), CIRCUIT_ROLLUP))
    assert "f_notes" not in text and "IsNotNull(f_hca_date)" in text
    assert "IsNotNull(section_id)" in text


def test_fold_finds_changes_on_narrow_rows(spark):
    loads = with_row_hash(
        spark.range(1000).selectExpr("id % 300 AS k", "cast(id / 300 AS int) AS seq", "repeat('x', 200) AS wide"), ["k", "wide"]
    )
    with settings(spark, spark__sql__adaptive__enabled="false"):
        folded = fold_keyed(loads, "k", "seq")
        text = plan(folded, "formatted")
    for node in ("Window", "HashAggregate", "SortAggregate"):
        for found in re.findall(rf"^\(\d+\) {node}\b.*\n((?:.+\n)+)", text, re.M):
            assert "wide" not in found
    assert re.search(r"^\(\d+\) Window", text, re.M) and folded.count() == 300
