from datetime import datetime

from pyspark.sql import functions as F

from rollforward.functions.conform import (
    conform_schema,
    rename_cast,
    required_columns,
    with_load_stamps,
)
from rollforward.plans.circuits import CIRCUIT_SCHEMA, RAW_MAPPING, SUMMARY_SCHEMA

from .conftest import rows


def test_load_stamps_are_text(spark):
    df = spark.createDataFrame([(1,)], "k int")
    stamped = with_load_stamps(df, F.lit(datetime(2024, 5, 6, 7, 8, 9, 999)))
    assert rows(stamped) == [(1, "2024-05-06 07:08:09", "2024-05-06 07:08:09")]
    now = with_load_stamps(df).first()
    assert now.load_datetime == now.updated_datetime and len(now.load_datetime) == 19


def test_raw_columns_become_typed_and_others_pass(spark):
    raw = ["7", "3", "O", "ABC", "1", "2", "12.5", "1e3", "red", "9", "4.0", "5", "6",
           "2024-01-02 03:04:05", "note", "0.5"]
    names = [f"_c{i}" for i in range(1, 17)]
    bad = ["x", "99999999999", "O", None, "1.5", *raw[5:13], "no date", None, "len"]
    df = spark.createDataFrame(
        [(*raw, "h1"), (*bad, "h2")], ", ".join(f"{n} string" for n in [*names, "row_hash"])
    )
    typed = rename_cast(df, RAW_MAPPING)
    assert typed.columns == [*CIRCUIT_SCHEMA.names, "row_hash"]
    kinds = [f.dataType for f in typed.schema.fields[:-1]]
    assert kinds == [f.dataType for f in CIRCUIT_SCHEMA.fields]
    good, broken = (tuple(r) for r in typed.orderBy("row_hash").collect())
    assert good == (7, 3, "O", "ABC", 1, 2, 12.5, 1000.0, "red", 9, 4.0, 5.0, 6.0,
                    datetime(2024, 1, 2, 3, 4, 5), "note", 0.5, "h1")
    assert broken[:5] == (None, None, "O", None, None)
    assert broken[13] is None and broken[15] is None


def test_conform_fills_orders_and_types(spark):
    df = spark.createDataFrame([("5", "x", 1)], "shape_length string, extra string, CIRCUIT_ID int")
    result = conform_schema(df, SUMMARY_SCHEMA)
    assert [f.dataType for f in result.schema] == [f.dataType for f in SUMMARY_SCHEMA]
    assert rows(result) == [(1, None, None, None, None, 5.0)]
    assert result.columns == SUMMARY_SCHEMA.names


def test_not_null_columns_of_a_schema():
    assert required_columns(CIRCUIT_SCHEMA) == ["CIRCUIT_ID", "SECTION_ID"]
    assert required_columns(SUMMARY_SCHEMA) == ["CIRCUIT_ID"]
