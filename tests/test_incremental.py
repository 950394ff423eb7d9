"""The batch run: one judgement gives clean rows and rejects."""

from pyspark.sql import functions as F

from rollforward.operators.quality import Rules, rejected
from rollforward.plans import incremental
from rollforward.plans.circuits import CIRCUIT_ROLLUP, CIRCUIT_RULES
from rollforward.sources import parted

from .conftest import rows


def feed_rows(spark):
    return spark.range(120).select(
        F.when(F.col("id") % 11 != 0, F.col("id") % 7).alias("circuit_id"),
        (F.col("id") % 3).alias("section_id"),
        *[(F.col("id") % n).cast("double").alias(c) for n, c in ((5, "n_voltage_kv"), (4, "f_voltage_kv"), (3, "f_max_hc"), (2, "f_min_hc"))],
        F.lit("2024-01-01").cast("timestamp").alias("f_hca_date"),
        (F.col("id") % 6).cast("double").alias("shape_length"),
        F.lit("a note").alias("f_notes"),
        F.sha2((F.col("id") % 40).cast("string"), 256).alias("row_hash"),
        (F.col("id") % 2).cast("int").alias("version"),
    )


def ran(spark, root, name, rules):
    names = [f"{name}_{t}" for t in ("feed", "rollup", "watermark", "rejects")]
    feed_rows(spark).write.partitionBy("version").format("parquet").option("path", f"{root}/feed").saveAsTable(names[0])
    incremental.run(spark, *names, root, rules=rules, mapping={}, change_types=None)
    return rows(parted.rows_of(spark, names[1])), rows(spark.table(names[3]).select("row_hash", "f_notes", "version", "reject_reason"))


def test_a_run_judges_its_rows_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(incremental, "rejected", None)  # no second judgement
    rolled, refused = ran(spark, str(tmp_path), "judged_once", CIRCUIT_RULES)
    feed = feed_rows(spark)
    assert rolled == rows(incremental.replay(feed, CIRCUIT_ROLLUP, CIRCUIT_RULES))
    assert refused == rows(rejected(feed, CIRCUIT_RULES).select("row_hash", "f_notes", "version", "reject_reason"))


def test_rules_across_versions_reject_across_versions(spark, tmp_path):
    rules = Rules(key=("row_hash",), required=CIRCUIT_RULES.required)
    rolled, refused = ran(spark, str(tmp_path), "across", rules)
    feed = feed_rows(spark)
    assert rolled == rows(incremental.replay(feed, CIRCUIT_ROLLUP, rules))
    assert len(refused) == rejected(feed, rules).count()
