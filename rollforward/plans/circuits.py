"""The hosting-capacity circuit tables: schemas, mapping, rules and rollups."""

from __future__ import annotations

from pyspark.sql.types import StructType

from ..operators.quality import OFF, Rules
from ..operators.rollup import Rollup

# Names, types and order of the circuit columns; "!" marks NOT NULL.
CIRCUIT_COLUMNS = """
    CIRCUIT_ID long!, NUM_PHASES integer, OVERUNDER string, PHASES_PRESENT string,
    SECTION_ID long!, N_FEEDER_ID long, N_VOLTAGE_KV double, N_MAX_HC double,
    N_MAP_COLOR string, F_FEEDER_ID long, F_VOLTAGE_KV double, F_MAX_HC double,
    F_MIN_HC double, F_HCA_DATE timestamp, F_NOTES string, SHAPE_LENGTH double
"""
SUMMARY_COLUMNS = """
    CIRCUIT_ID long!, F_VOLTAGE_KV double, F_MAX_HC double, F_MIN_HC double,
    F_HCA_DATE timestamp, SHAPE_LENGTH double
"""


def _schema(columns: str) -> StructType:
    schema = StructType()
    for column in columns.split(","):
        name, kind = column.split()
        schema.add(name, kind.rstrip("!"), nullable=not kind.endswith("!"))
    return schema


CIRCUIT_SCHEMA = _schema(CIRCUIT_COLUMNS)
SUMMARY_SCHEMA = _schema(SUMMARY_COLUMNS)

# Raw files carry no header: field i of the schema is column _c<i>, after an index _c0.
RAW_MAPPING = {
    f"_c{i}": (field.name, field.dataType.simpleString())
    for i, field in enumerate(CIRCUIT_SCHEMA.fields, start=1)
}

CIRCUIT_ROLLUP = Rollup(
    keys=("circuit_id",),
    date="f_hca_date",
    measures=(
        ("normal_voltage", "max", "n_voltage_kv"),
        ("feeder_voltage", "max", "f_voltage_kv"),
        ("feeder_max_hc", "max", "f_max_hc"),
        ("feeder_min_hc", "min", "f_min_hc"),
        ("shape_length", "sum", "shape_length"),
    ),
    date_as="hca_refresh_date",
)
SECTION_ROLLUP = Rollup(
    keys=("circuit_id", "section_id"),
    date=CIRCUIT_ROLLUP.date,
    measures=CIRCUIT_ROLLUP.measures,
    date_as=CIRCUIT_ROLLUP.date_as,
)

# Within a version a row hash counts once; both ids must be there.
CIRCUIT_RULES = Rules(
    key=("version", "row_hash"), required=("circuit_id", "section_id"), full_duplicates=OFF
)
