"""Tables in parts: what a merge reads and writes, and what is left when one breaks off."""

import os
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from rollforward.plans import incremental, ingest
from rollforward.plans.incremental import read_watermark, run
from rollforward.plans.ingest import load_csv, merge_into_table, replace_in_table
from rollforward.sources import parted
from rollforward.sources.snapshots import publish, replace_partitions

from .conftest import rows
from .test_plans import plan

NOW = datetime(2024, 1, 1, tzinfo=timezone.utc)
OPTIONS = {"primary_key": "id", "load_time": NOW, "parts": 8}


@pytest.fixture
def frame(spark):
    return lambda *r: spark.createDataFrame(list(r), "id long, name string")


def files_below(folder):
    return {os.path.join(d, f) for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")}


def test_a_merge_reads_and_writes_only_the_parts_it_changes(spark, tmp_path, frame, monkeypatch):
    root = str(tmp_path / "root")
    merged = merge_into_table(frame(*[(i, f"n{i}") for i in range(200)]), "parts_t", root, **OPTIONS)
    assert merged.inserted == 200 and merged.parts == tuple(range(8)) and merged.version is None
    before = files_below(root)

    plans = []
    original = ingest.replace_partitions

    def looked_at(df, attempt):
        plans.append(plan(df, "formatted"))
        return original(df, attempt)

    monkeypatch.setattr(ingest, "replace_partitions", looked_at)
    merged = merge_into_table(frame((3, "new"), (4, "n4"), (5, "n5")), "parts_t", root, **OPTIONS)
    assert (merged.inserted, merged.updated, len(merged.parts)) == (0, 1, 1)
    written = files_below(root) - before
    assert written and all(f"{parted.PART}={merged.parts[0]}/" in path for path in written)
    scans = [line for line in plans[0].splitlines() if "PartitionFilters" in line]
    assert scans and all(f"(_part#" in line and f"= {merged.parts[0]})" in line for line in scans if "[]" not in line)
    assert any(f"= {merged.parts[0]})" in line for line in scans)
    assert rows(spark.table("parts_t").filter("id < 6 and id > 2"), "id", "name") == [(3, "new"), (4, "n4"), (5, "n5")]
    assert spark.table("parts_t").count() == 200


def test_a_merge_without_changes_writes_nothing(spark, tmp_path, frame):
    root = str(tmp_path / "root")
    for key in ("id", None):
        table = f"same_{key}_t"
        options = {**OPTIONS, "primary_key": key, "changes_table": f"same_{key}_changes"}
        merge_into_table(frame((1, "a"), (2, "b")), table, root, **options)
        before = files_below(root)
        assert merge_into_table(frame((2, "b")), table, root, **options) == ingest.Merged()
        assert files_below(root) == before and spark.table(f"same_{key}_changes").count() == 2


def test_only_keys_and_hashes_are_compared(spark, tmp_path, frame):
    root = str(tmp_path / "root")
    merge_into_table(frame((1, "a")), "narrow_t", root, **OPTIONS)
    kinds = ingest.merge.kinds_of_change(spark.table("narrow_t"), spark.table("narrow_t"), ["id"])
    for schema in [line for line in plan(kinds, "formatted").splitlines() if "ReadSchema" in line]:
        assert "name" not in schema


def test_a_keyless_merge_adds_a_part(spark, tmp_path, frame):
    root = str(tmp_path / "root")
    for batch in ([(1, "a"), (1, "a")], [(1, "a"), (2, "b")]):
        merge_into_table(frame(*batch).distinct(), "added_t", root, load_time=NOW)
    assert rows(spark.table("added_t"), "id", "_part") == [(1, 0), (2, 1)]


def test_a_keyless_merge_into_a_table_with_a_key(spark, tmp_path, frame):
    root = str(tmp_path / "root")
    merge_into_table(frame((1, "a"), (2, "b")), "both_t", root, **OPTIONS)
    merge_into_table(frame((1, "a"), (3, "c")), "both_t", root, load_time=NOW)
    merge_into_table(frame((3, "d")), "both_t", root, **OPTIONS)
    assert rows(spark.table("both_t"), "id", "name") == [(1, "a"), (2, "b"), (3, "d")]
    with pytest.raises(ValueError, match="has the key"):
        merge_into_table(frame((3, "d")), "both_t", root, primary_key="name", load_time=NOW)


def test_null_keys_are_spread_over_parts(spark, tmp_path, frame):
    root = str(tmp_path / "root")
    merge_into_table(frame(*[(None, f"n{i}") for i in range(100)]), "null_t", root, **OPTIONS)
    assert spark.table("null_t").select("_part").distinct().count() == 8


def test_a_table_of_another_kind_is_taken_over(spark, tmp_path, frame):
    root = str(tmp_path / "root")
    stamped = ingest.with_load_stamps(ingest.with_row_hash(frame((1, "a"), (2, "b"))), F.lit(NOW))
    publish(stamped, "old_t", f"{root}/old_t")
    merge_into_table(frame((2, "c"), (3, "d")), "old_t", root, **OPTIONS)
    assert rows(spark.table("old_t"), "id", "name") == [(1, "a"), (2, "c"), (3, "d")]


def test_a_load_that_breaks_off_while_partitions_move_is_finished(spark, tmp_path, frame, monkeypatch):
    root, options = str(tmp_path / "root"), {**OPTIONS, "changes_table": "moving_changes"}
    merge_into_table(frame(*[(i, "a") for i in range(20)]), "moving_t", root, **options)
    original = parted.settle
    for stop in ("before", "after the version"):

        def broken(session, table, stop=stop):
            if stop == "after the version":
                parted._add_version(session, parted.state_of(session, table))
            raise OSError("broken off")

        name = f"by {stop}"
        with monkeypatch.context() as patched:
            patched.setattr(parted, "settle", broken)
            with pytest.raises(OSError):
                parted_merge = ingest._opened
                patched.setattr(ingest, "_opened", lambda *a: (original(a[0], a[1]), parted_merge_state(*a))[1])
                merge_into_table(frame(*[(i, name) for i in range(10)]), "moving_t", root, **options)
        merge_into_table(frame((50, name)), "moving_t", root, **options)
        assert spark.table("moving_t").filter(F.col("name") == name).count() >= 10
    moved = spark.table("moving_changes")
    assert rows(moved.groupBy("version").count()) == [(0, 20), (1, 20), (2, 1), (3, 20), (4, 2)]


def parted_merge_state(spark, table, *_):
    return parted.state_of(spark, table)


def test_the_loser_of_two_loads_leaves_nothing_visible(spark, tmp_path, frame, monkeypatch):
    root, options = str(tmp_path / "root"), {**OPTIONS, "changes_table": "race_changes"}
    merge_into_table(frame((1, "a")), "race_t", root, **options)
    original = ingest.replace_partitions

    def other_load(df, attempt):  # the other one runs whole while this one writes
        original(df, attempt)
        with monkeypatch.context() as patched:
            patched.setattr(ingest, "replace_partitions", original)
            merge_into_table(frame((2, "b")), "race_t", root, **options)

    with monkeypatch.context() as patched:
        patched.setattr(ingest, "replace_partitions", other_load)
        with pytest.raises(RuntimeError, match="another load"):
            merge_into_table(frame((3, "c")), "race_t", root, **options)
    merge_into_table(frame((3, "c")), "race_t", root, **options)
    assert rows(spark.table("race_t"), "id") == [(1,), (2,), (3,)]
    assert rows(spark.table("race_changes"), "version", "id") == [(0, 1), (1, 2), (2, 3)]
    live = files_below(root)
    assert all("/rows/" in f or "/changes/" in f for f in live)


def test_expired_folders_go_and_live_ones_stay(spark, tmp_path, frame):
    root, options = str(tmp_path / "root"), {**OPTIONS, "changes_table": "expire_changes"}
    for name in "abc":
        merge_into_table(frame(*[(i, name) for i in range(10)]), "expire_t", root, **options)
    before = rows(spark.table("expire_t")), rows(spark.table("expire_changes"))
    files = files_below(root)
    assert parted.expire(spark, "expire_t")
    assert files_below(root) < files
    assert (rows(spark.table("expire_t")), rows(spark.table("expire_changes"))) == before
    assert parted.expire(spark, "expire_t") == []


def test_rows_are_replaced_by_key(spark, tmp_path, frame):
    root = str(tmp_path / "root")
    replace_in_table(frame((1, "a"), (2, None), (None, "x")), "whole_t", root, keys="id", parts=4)
    replace_in_table(frame((2, "b"), (3, "c")), "whole_t", root, keys="id", parts=4)
    assert rows(spark.table("whole_t"), "id", "name") == [(None, "x"), (1, "a"), (2, "b"), (3, "c")]
    assert replace_in_table(frame(), "whole_t", root, keys="id") == ingest.Merged()


FEED = (
    "circuit_id long, section_id long, n_voltage_kv double, f_voltage_kv double, f_max_hc double, f_min_hc double, "
    "f_hca_date timestamp, shape_length double, version int, row_hash string"
)


def test_a_run_that_is_overtaken_changes_nothing(spark, tmp_path, monkeypatch):
    root, names = str(tmp_path / "root"), ("over_feed", "over_roll", "over_mark", "over_rejects")
    feed = lambda v, n: spark.createDataFrame(
        [(1, 1, 1.0, 1.0, 1.0, 1.0, NOW.replace(tzinfo=None), float(n), v, f"h{v}{n}")], FEED
    )
    replace_partitions(feed(0, 5), names[0], "version", root)
    options = {"mapping": {}, "change_types": None, "now": NOW}
    original = incremental.rename_cast

    def other_run(*args):
        monkeypatch.setattr(incremental, "rename_cast", original)
        replace_partitions(feed(1, 7), names[0], "version", root)
        run(spark, *names, root, **options)
        return original(*args)

    monkeypatch.setattr(incremental, "rename_cast", other_run)
    with pytest.raises(RuntimeError, match="another load"):
        run(spark, *names, root, **options)
    assert rows(spark.table(names[1]), "version", "shape_length") == [(1, 7.0)]
    assert read_watermark(spark, names[2], names[0]) == 1


# ---- values that do not fit -----------------------------------------------------------


def put(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def test_bad_values_are_set_aside(spark, tmp_path):
    root = str(tmp_path / "root")
    put(tmp_path / "in", "a.csv", ["id,v", "1,10", "2,abc", "x,3", "4,4.5"])
    put(tmp_path / "in", "b.csv", ["v,id", "7,5"])
    options = {"schema": "id long, v double", "load_time": NOW, "primary_key": "id", "rejects_table": "aside_rejects"}
    with pytest.raises(ValueError, match="does not fit column"):
        load_csv(spark, str(tmp_path / "in"), "aside_t", "aside_log", root, **options)
    assert not spark.catalog.tableExists("aside_t")
    done = load_csv(spark, str(tmp_path / "in"), "aside_t", "aside_log", root, bad_values="set_aside", **options)
    assert (done.files, done.set_aside, done.merged.inserted) == (2, 2, 3)
    assert rows(spark.table("aside_t"), "id", "v") == [(1, 10.0), (4, 4.5), (5, 7.0)]
    found = rows(spark.table("aside_rejects"), "line", "reject_reason")
    assert found == [("2,abc", "bad_cast:v"), ("x,3", "bad_cast:id")]
    # the files are known now, and later ones go on
    put(tmp_path / "in", "c.csv", ["id,v", "6,6"])
    done = load_csv(spark, str(tmp_path / "in"), "aside_t", "aside_log", root, bad_values="set_aside", **options)
    assert (done.files, done.set_aside) == (1, 0) and spark.table("aside_rejects").count() == 2
    with pytest.raises(ValueError, match="rejects_table"):
        load_csv(spark, str(tmp_path / "in"), "aside_t", "aside_log", root, bad_values="set_aside")


def test_values_that_do_not_fit_the_table_are_set_aside(spark, tmp_path):
    root = str(tmp_path / "root")
    options = {"load_time": NOW, "rejects_table": "fits_rejects", "bad_values": "set_aside"}
    put(tmp_path / "in", "a.csv", ["id,v", "1,10"])
    load_csv(spark, str(tmp_path / "in"), "fits_t", "fits_log", root, **options)
    put(tmp_path / "in", "b.csv", ["id,v", "2,1.5", "3,30"])
    load_csv(spark, str(tmp_path / "in"), "fits_t", "fits_log", root, **options)
    assert rows(spark.table("fits_t"), "id", "v") == [(1, 10), (3, 30)]
    assert rows(spark.table("fits_rejects"), "line", "reject_reason") == [("2,1.5", "bad_cast:v")]


def test_a_load_without_a_key_writes_its_rows_once(spark, tmp_path):
    root, folder = str(tmp_path / "root"), tmp_path / "in"
    folder.mkdir()
    options = {"changes_table": "once_changes", "schema": "a int, b string", "load_time": NOW}
    for name, lines in (("1.csv", ["1,x", "2,y", "2,y"]), ("2.csv", ["2,y", "3,z"]), ("3.csv", ["1,x", "2,y"])):
        (folder / name).write_text("\n".join(["a,b", *lines]) + "\n")
        done = load_csv(spark, str(folder / name), "once_t", "once_log", root, **options)
    assert done.merged == ingest.Merged()
    assert rows(spark.table("once_t"), "_part", "a", "b") == [(0, 1, "x"), (0, 2, "y"), (1, 3, "z")]
    assert "_change_type" not in spark.table("once_t").columns
    feed = rows(spark.table("once_changes"), "version", "a", "b", "_change_type")
    assert feed == [(0, 1, "x", "insert"), (0, 2, "y", "insert"), (1, 3, "z", "insert")]
    state = parted.state_of(spark, "once_t")
    assert files_below(f"{state.attempt}/rows") and not files_below(f"{state.attempt}/changes")
    parted.expire(spark, "once_t")
    assert rows(spark.table("once_changes"), "version", "a", "b", "_change_type") == feed
