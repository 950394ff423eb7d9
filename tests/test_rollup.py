import random
from datetime import datetime

from pyspark.sql import functions as F

from rollforward.operators.changes import (
    advance_watermark,
    change_range,
    changes_since,
    empty_watermark,
    last_processed,
    latest_version,
    pending_versions,
    row_states,
)
from rollforward.operators.rollup import latest_rollup, latest_with_ties
from rollforward.plans.circuits import CIRCUIT_ROLLUP, CIRCUIT_RULES, SECTION_ROLLUP
from rollforward.plans.incremental import replay

from .conftest import rows

SCHEMA = (
    "circuit_id long, section_id long, n_voltage_kv double, f_voltage_kv double, "
    "f_max_hc double, f_min_hc double, f_hca_date timestamp, shape_length double, "
    "version int, row_hash string"
)
DAYS = [datetime(2024, 1, d) for d in range(1, 6)]


def random_feed(seed, n=600, versions=5):
    rng = random.Random(seed)
    pick = lambda values: rng.choice([None, *values])
    data = []
    for i in range(n):
        numbers = [pick(map(float, range(9))) for _ in range(4)]
        row = (
            pick(range(15)), pick(range(4)), *numbers, pick(DAYS),
            pick(map(float, range(9))), rng.randrange(versions), f"h{i}",
        )
        data += [row] * rng.choice([1, 1, 1, 2])
        if rng.random() < 0.1:  # the same row again in another version
            data.append((*row[:8], (row[8] + 1) % versions, row[9]))
    return data


def measures(group):
    """The measures over rows, NULLs left out."""
    def over(how, i):
        values = [r[i] for r in group if r[i] is not None]
        return how(values) if values else None

    return over(max, 2), over(max, 3), over(max, 4), over(min, 5), over(sum, 7)


def rolled_up(data, key=lambda r: r[0]):
    groups = {}
    for r in data:
        if r[6] is not None:
            groups.setdefault(key(r), []).append(r)
    result = {}
    for k, group in groups.items():
        newest = max(r[6] for r in group)
        result[k] = (*measures([r for r in group if r[6] == newest]), newest)
    return result


def one_version_at_a_time(data, after=-1, state=None):
    """The versioned loop: check, roll up the version's own rows, replace by key."""
    state = dict(state or {})
    for version in range(after + 1, max(r[8] for r in data) + 1):
        seen, kept = set(), []
        for r in data:
            if r[8] == version and None not in r[:2] and r[9] not in seen:
                seen.add(r[9])
                kept.append(r)
        for k, values in rolled_up(kept).items():
            state[k] = (version, *values)
    return state


def as_dict(df, width=1):
    found = {}
    for r in df.collect():
        r = tuple(r)
        found[r[0] if width == 1 else r[:width]] = r[width:]
    return found


MEASURES = ["normal_voltage", "feeder_voltage", "feeder_max_hc", "feeder_min_hc", "shape_length"]


def test_latest_with_ties(spark):
    data = [
        (1, "a", DAYS[0]), (1, "b", DAYS[1]), (1, "c", DAYS[1]), (1, "d", None),
        (2, "e", None), (None, "f", DAYS[2]), (None, "g", DAYS[0]), (1, "c", DAYS[1]),
    ]
    df = spark.createDataFrame(data, "k int, t string, d timestamp")
    assert rows(latest_with_ties(df, "k", "d"), "k", "t") == [
        (None, "f"), (1, "b"), (1, "c"), (1, "c"),
    ]


def test_rollups_equal_a_plain_computation(spark):
    data = random_feed(1)
    df = spark.createDataFrame(data, SCHEMA)
    by_circuit = latest_rollup(df, CIRCUIT_ROLLUP)
    assert as_dict(by_circuit.select("circuit_id", *MEASURES, "hca_refresh_date")) == rolled_up(data)
    by_section = latest_rollup(df, SECTION_ROLLUP)
    found = as_dict(by_section.select("circuit_id", "section_id", *MEASURES, "hca_refresh_date"), 2)
    assert found == rolled_up(data, key=lambda r: r[:2])


def test_replay_equals_the_loop_over_versions(spark):
    data = random_feed(2)
    feed = spark.createDataFrame(data, SCHEMA)
    names = ["circuit_id", "version", *MEASURES, "hca_refresh_date"]
    full = replay(feed, CIRCUIT_ROLLUP, CIRCUIT_RULES).select(names)
    expected = one_version_at_a_time(data)
    assert as_dict(full) == expected
    for stop in (0, 2):
        earlier = replay(feed, CIRCUIT_ROLLUP, CIRCUIT_RULES, until=stop)
        resumed = replay(feed, CIRCUIT_ROLLUP, CIRCUIT_RULES, after=stop, target=earlier)
        assert as_dict(resumed.select(names)) == expected


def test_a_later_version_wins_even_with_an_older_date(spark):
    data = [
        (1, 1, 9.0, 9.0, 9.0, 9.0, DAYS[4], 9.0, 0, "a"),
        (1, 1, 1.0, 1.0, 1.0, 1.0, DAYS[0], 1.0, 1, "b"),
        (2, 1, 5.0, 5.0, 5.0, 5.0, DAYS[0], 5.0, 0, "c"),
        (2, 1, 6.0, 6.0, 6.0, 6.0, None, 6.0, 1, "d"),
    ]
    result = replay(spark.createDataFrame(data, SCHEMA), CIRCUIT_ROLLUP, CIRCUIT_RULES)
    assert rows(result, "circuit_id", "version", "shape_length") == [(1, 1, 1.0), (2, 0, 5.0)]


def test_ranges_and_row_states(spark):
    feed = spark.createDataFrame(
        [(v, t) for v in range(5) for t in ("insert", "delete", "update_preimage")],
        "version int, _change_type string",
    )
    assert change_range(feed, 2, 3).count() == 6
    assert changes_since(feed, 3).count() == 3
    assert changes_since(feed, -1).count() == 15
    assert row_states(feed).count() == 5
    assert row_states(feed, None).count() == 15


def test_watermark(spark):
    time = F.lit("2024-01-01").cast("timestamp")
    state = empty_watermark(spark)
    assert last_processed(state, "t") == -1
    state = advance_watermark(state, "t", 3, time)
    state = advance_watermark(advance_watermark(state, "u", 1, time), "t", 4, time)
    assert rows(state, "table_name", "last_processed_version") == [("t", 4), ("u", 1)]
    assert last_processed(state, "t") == 4
    feed = spark.createDataFrame(
        [("t", 7), ("t", 6), ("new", 0)], "table_name string, version int"
    )
    current = latest_version(feed, "table_name")
    assert rows(pending_versions(current, state)) == [("new", -1, 0), ("t", 4, 7)]
