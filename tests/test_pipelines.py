import random
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from rollforward.operators.changes import last_processed
from rollforward.operators.quality import Rules
from rollforward.plans.circuits import CIRCUIT_RULES
from rollforward.plans.control import create_control_tables
from rollforward.plans.incremental import move_watermark, read_watermark, reset, run
from rollforward.plans import ingest
from rollforward.plans.ingest import is_file_loaded, load_csv, log_file, merge_into_table

from rollforward.sources.snapshots import drop_partitions, replace_partitions

from .conftest import rows


def at(hour):
    return datetime(2024, 1, 1, hour, tzinfo=timezone.utc)


def put(folder, name, lines, header="id,name"):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join([header, *lines]) + "\n")
    return str(folder / name)


def load(spark, path, tag, root, hour, **options):
    options = {"schema": "id long, name string", "load_time": at(hour), **options}
    load_csv(spark, path, f"{tag}_t", f"{tag}_log", str(root), **options)


def stamps(spark, tag):
    return rows(spark.table(f"{tag}_t"), "id", "name", "load_datetime", "updated_datetime")


def test_keyed_loads(spark, tmp_path):
    one = put(tmp_path / "in", "a.csv", ["1,Alice", "2,Bob", "2,Bob"])
    two = put(tmp_path / "in", "b.csv", ["2,Bobby", "3,Cy"])
    copy = put(tmp_path / "in", "c.csv", ["2,Bob", "1,Alice", "2,Bob"])
    options = {"primary_key": "id", "changes_table": "keyed_changes"}
    for hour, path in enumerate([one, two, copy]):
        load(spark, path, "keyed", tmp_path / "root", hour, **options)
    assert stamps(spark, "keyed") == [
        (1, "Alice", "2024-01-01 00:00:00", "2024-01-01 00:00:00"),
        (2, "Bobby", "2024-01-01 00:00:00", "2024-01-01 01:00:00"),
        (3, "Cy", "2024-01-01 01:00:00", "2024-01-01 01:00:00"),
    ]
    log = rows(spark.table("keyed_log"), "file_name")
    assert [name.rsplit("/", 1)[1] for (name,) in log] == ["a.csv", "b.csv"]
    assert rows(spark.table("keyed_changes"), "version", "id", "name", "_change_type") == [
        (0, 1, "Alice", "insert"),
        (0, 2, "Bob", "insert"),
        (1, 2, "Bob", "update_preimage"),
        (1, 2, "Bobby", "update_postimage"),
        (1, 3, "Cy", "insert"),
    ]


def test_keyless_loads_and_empty_files(spark, tmp_path):
    folder = tmp_path / "in"
    put(folder, "a.csv", ["1,Alice", "2,Bob"])
    put(folder, "b.csv", ["2,Bob", "3,Cy", "3,Cy"])
    put(folder, "none.csv", [])
    put(folder, "none2.csv", [])
    load(spark, str(folder), "keyless", tmp_path / "root", 0)
    assert [r[:2] for r in stamps(spark, "keyless")] == [(1, "Alice"), (2, "Bob"), (3, "Cy")]
    assert spark.table("keyless_log").count() == 3  # one of the empty files counts as known
    put(folder, "d.csv", ["3,Cy", "4,Di"])
    load(spark, str(folder), "keyless", tmp_path / "root", 1)
    assert [r[1:3] for r in stamps(spark, "keyless")] == [
        ("Alice", "2024-01-01 00:00:00"),
        ("Bob", "2024-01-01 00:00:00"),
        ("Cy", "2024-01-01 00:00:00"),
        ("Di", "2024-01-01 01:00:00"),
    ]


def test_many_files_at_once_equal_one_at_a_time(spark, tmp_path):
    rng = random.Random(9)
    paths = []
    for i in range(5):
        lines = [f"{k},{rng.choice('ab')}" for k in rng.sample(range(6), 4)]
        paths.append(put(tmp_path / "in", f"f{i}.csv", lines))
    for path in paths:
        load(spark, path, "single", tmp_path / "r1", 0, primary_key="id")
    load(spark, paths, "batch", tmp_path / "r2", 0, primary_key="id")
    assert rows(spark.table("single_t")) == rows(spark.table("batch_t"))
    assert rows(spark.table("single_log")) == rows(spark.table("batch_log"))


def test_key_problems_and_schema_changes(spark, tmp_path):
    twice = put(tmp_path / "in", "a.csv", ["1,Alice", "1,Bob"])
    with pytest.raises(ValueError, match="Duplicate primary keys detected"):
        load(spark, twice, "bad", tmp_path / "root", 0, primary_key="id")
    assert not spark.catalog.tableExists("bad_t") and not spark.catalog.tableExists("bad_log")
    null = put(tmp_path / "in", "b.csv", [",Alice", "2,Bob"])
    load(spark, null, "bad", tmp_path / "root", 1, primary_key="id")
    wider = put(tmp_path / "in", "c.csv", ["3,Cy,x"], header="id,name,more")
    with pytest.raises(ValueError, match="more"):
        load(spark, wider, "bad", tmp_path / "root", 2, schema="id long, name string, more string")
    narrow = put(tmp_path / "in", "d.csv", ["4"], header="id")
    load(spark, narrow, "bad", tmp_path / "root", 3, schema="id long", primary_key="id")
    assert rows(spark.table("bad_t"), "id", "name") == [(None, "Alice"), (2, "Bob"), (4, None)]


def circuit_line(i, circuit, section, day, length):
    return f"{i},{circuit},3,O,ABC,{section},5,12.5,1.0,red,6,{length},2.0,1.0,2024-01-{day:02d},n,{length}"


def test_files_to_rollup(spark, tmp_path):
    folder, root = tmp_path / "in", str(tmp_path / "root")

    def ingest(name, lines, hour):
        folder.mkdir(exist_ok=True)
        (folder / name).write_text("\n".join(lines) + "\n")
        schema = ", ".join(f"_c{i} string" for i in range(17))
        load_csv(
            spark, str(folder / name), "raw_t", "raw_log", root, changes_table="raw_changes",
            schema=schema, header=False, drop_index_column=True, load_time=at(hour),
        )

    def roll(hour):
        run(spark, "raw_changes", "roll_t", "roll_mark", "roll_rejects", root, now=at(hour))

    def result():
        return rows(
            spark.table("roll_t"), "circuit_id", "version", "shape_length", F.col("hca_refresh_date").cast("date").cast("string"),
        )

    ingest("a.csv", [
        circuit_line(0, 1, 1, 5, 2.0), circuit_line(1, 1, 2, 5, 3.0), circuit_line(2, 1, 3, 4, 9.0),
        circuit_line(3, 2, 1, 3, 1.0), circuit_line(4, "", 1, 3, 1.0), circuit_line(5, 3, "x", 3, 1.0),
    ], 0)
    roll(1)
    assert result() == [(1, 0, 5.0, "2024-01-05"), (2, 0, 1.0, "2024-01-03")]
    assert rows(spark.table("roll_rejects"), "reject_reason") == [
        ("null:circuit_id",), ("null:section_id",),
    ]
    assert last_processed(spark.table("roll_mark"), "raw_changes") == 0
    roll(2)  # nothing new
    assert last_processed(spark.table("roll_mark"), "raw_changes") == 0

    ingest("b.csv", [circuit_line(9, 1, 1, 2, 7.0), circuit_line(10, 4, 1, 6, 8.0)], 3)
    ingest("c.csv", [circuit_line(11, 4, 2, 6, 1.5)], 4)
    roll(5)
    assert result() == [
        (1, 1, 7.0, "2024-01-02"), (2, 0, 1.0, "2024-01-03"), (4, 2, 1.5, "2024-01-06"),
    ]
    assert last_processed(spark.table("roll_mark"), "raw_changes") == 2
    assert spark.table("roll_rejects").count() == 2

    before = result()
    reset(spark, "roll_mark", root)
    loose = Rules(key=CIRCUIT_RULES.key, required=("section_id",))
    run(spark, "raw_changes", "roll_t", "roll_mark", "roll_rejects", root, now=at(6), rules=loose)
    assert spark.table("roll_rejects").count() == 1  # the other row is no reject any more
    reset(spark, "roll_mark", root)
    assert last_processed(spark.table("roll_mark"), "raw_changes") == -1
    roll(7)
    assert [r for r in result() if r[0] is not None] == before and spark.table("roll_rejects").count() == 2


def test_control_tables(spark, tmp_path):
    root = str(tmp_path / "root")
    assert not is_file_loaded(spark, "ctl_log", "h")
    for _ in range(2):
        create_control_tables(spark, "ctl_log", "ctl_mark", root)
        assert spark.table("ctl_log").columns == ["file_name", "file_hash", "load_time"]
    assert read_watermark(spark, "ctl_mark", "t") == -1
    log_file(spark, "ctl_log", root, "test_file.csv", "h", at(0))
    move_watermark(spark, "ctl_mark", "t", 3, root, now=at(0))
    create_control_tables(spark, "ctl_log", "ctl_mark", root)
    assert is_file_loaded(spark, "ctl_log", "h") and not is_file_loaded(spark, "ctl_log", "new")
    assert read_watermark(spark, "ctl_mark", "t") == 3
    assert read_watermark(spark, "ctl_mark", "u") == -1


def test_a_dataframe_into_a_table(spark, tmp_path):
    root = str(tmp_path / "root")
    df = spark.createDataFrame([(1, "Alice")], "id long, name string")
    merge_into_table(df, "direct_t", root, primary_key="id", load_time=at(0))
    assert spark.table("direct_t").count() == 1
    more = spark.createDataFrame([(1, "Al"), (2, "Bob")], "id long, name string")
    merge_into_table(more, "direct_t", root, primary_key="id", load_time=at(1))
    assert stamps(spark, "direct") == [
        (1, "Al", "2024-01-01 00:00:00", "2024-01-01 01:00:00"),
        (2, "Bob", "2024-01-01 01:00:00", "2024-01-01 01:00:00"),
    ]
    doubled = spark.createDataFrame([(3, "Cy"), (3, "Di")], "id long, name string")
    with pytest.raises(ValueError, match="Duplicate primary keys detected"):
        merge_into_table(doubled, "direct_t", root, primary_key="id")


def test_fingerprints_do_not_depend_on_the_files_beside(spark, tmp_path):
    folder, root = tmp_path / "in", str(tmp_path / "root")
    put(folder, "1.csv", ["1,10", "2,20"], header="id,v")
    load_csv(spark, str(folder), "mixed_t", "mixed_log", root, load_time=at(0))
    assert dict(spark.table("mixed_t").dtypes)["v"] == "int"
    put(folder, "2.csv", ["3,1.5"], header="id,v")
    with pytest.raises(ValueError, match="does not fit column v"):
        load_csv(spark, str(folder), "mixed_t", "mixed_log", root, load_time=at(1))
    assert spark.table("mixed_t").count() == 2 and spark.table("mixed_log").count() == 1
    put(folder, "2.csv", ["3,30"], header="id,v")
    load_csv(spark, str(folder), "mixed_t", "mixed_log", root, load_time=at(2))
    assert rows(spark.table("mixed_t"), "id", "v") == [(1, 10), (2, 20), (3, 30)]
    assert spark.table("mixed_log").count() == 2


@pytest.mark.parametrize("schema", [None, "id int, name string"])
def test_columns_go_by_name(spark, tmp_path, schema):
    tag = "named" if schema else "inferred"
    folder = tmp_path / "in"
    put(folder, "a.csv", ["1,Alice"], header="id,name")
    load(spark, str(folder), tag, tmp_path / "root", 0, schema=schema, primary_key="id")
    put(folder, "b.csv", ["Bob,2", "Al,1"], header="NAME,id")
    put(folder, "c d.csv", ["3"], header="Id")
    load(spark, str(folder), tag, tmp_path / "root", 1, schema=schema, primary_key="id")
    assert rows(spark.table(f"{tag}_t"), "id", "name") == [(1, "Al"), (2, "Bob"), (3, None)]
    assert spark.table(f"{tag}_t").columns[:2] == ["id", "name"]


def test_values_that_do_not_fit_are_an_error(spark, tmp_path):
    root = str(tmp_path / "root")
    merge_into_table(spark.createDataFrame([(1, 2)], "id int, q int"), "fit_t", root, primary_key="id")
    for values, column in ((("1", "abc"), "q"), (("A7", "5"), "id")):
        with pytest.raises(ValueError, match=f"does not fit column {column}"):
            merge_into_table(spark.createDataFrame([values], "id string, q string"), "fit_t", root, primary_key="id")
    with pytest.raises(ValueError, match="does not fit column q"):
        merge_into_table(spark.createDataFrame([(1, 1.5)], "id int, q double"), "fit_t", root, primary_key="id")
    merge_into_table(spark.createDataFrame([("1", "7")], "ID string, Q string"), "fit_t", root, primary_key="id")
    assert rows(spark.table("fit_t"), "id", "q") == [(1, 7)]


def test_partitions_of_a_range_are_dropped(spark, tmp_path):
    root = str(tmp_path / "root")
    df = spark.createDataFrame([(v, v) for v in range(5)], "x int, version int")
    replace_partitions(df, "ranged_t", "version", root)
    drop_partitions(spark, "ranged_t", "version", 1, 3)
    assert rows(spark.table("ranged_t"), "x") == [(0,), (4,)]


@pytest.mark.parametrize("step", ["publish", "replace_partitions", "append"])
def test_a_broken_off_load_is_repeated(spark, tmp_path, monkeypatch, step):
    tag = f"broken_{step}"
    options = {"primary_key": "id", "changes_table": f"{tag}_changes"}
    first = put(tmp_path / "in", "a.csv", ["1,Alice", "2,Bob"])
    second = put(tmp_path / "in", "b.csv", ["2,Bobby", "3,Cy"])

    def breaks(*args, **kwargs):
        raise OSError("broken off")

    for hour, path in enumerate([first, second]):
        for when in ("before", "after"):
            original = getattr(ingest, step)

            def breaks_after(*args, _original=original, **kwargs):
                _original(*args, **kwargs)
                raise OSError("broken off")

            with monkeypatch.context() as patched:
                patched.setattr(ingest, step, breaks if when == "before" else breaks_after)
                with pytest.raises(OSError):
                    load(spark, path, tag, tmp_path / "root", hour, **options)
            if step == "append" and when == "after":
                break  # the log holds the file: the load is complete
        else:
            load(spark, path, tag, tmp_path / "root", hour, **options)
    assert [r[:2] for r in stamps(spark, tag)] == [(1, "Alice"), (2, "Bobby"), (3, "Cy")]
    moves = rows(spark.table(f"{tag}_changes"), "id", "name", "_change_type")
    assert moves == [
        (1, "Alice", "insert"),
        (2, "Bob", "insert"),
        (2, "Bob", "update_preimage"),
        (2, "Bobby", "update_postimage"),
        (3, "Cy", "insert"),
    ]
    assert spark.table(f"{tag}_log").count() == 2


def test_a_repetition_without_changes_leaves_no_stale_version(spark, tmp_path, monkeypatch):
    options = {"primary_key": "id", "changes_table": "stale_changes", "load_time": at(1)}
    frame = lambda *r: spark.createDataFrame(list(r), "id long, name string")
    root = str(tmp_path / "root")
    merge_into_table(frame((1, "a")), "stale_t", root, **options)
    with monkeypatch.context() as patched:
        patched.setattr(ingest, "publish", lambda *a: (_ for _ in ()).throw(OSError()))
        with pytest.raises(OSError):
            merge_into_table(frame((1, "b")), "stale_t", root, **options)
    merge_into_table(frame((1, "a")), "stale_t", root, **options)
    assert rows(spark.table("stale_changes"), "id", "name", "version") == [(1, "a", 0)]


def test_a_load_beside_another_is_an_error(spark, tmp_path, monkeypatch):
    frame = lambda *r: spark.createDataFrame(list(r), "id long, name string")
    root = str(tmp_path / "root")
    merge_into_table(frame((1, "a")), "beside_t", root, primary_key="id")
    original = ingest.lost_value

    def other_load(*args):  # after the location was read, before anything is written
        with monkeypatch.context() as patched:
            patched.setattr(ingest, "lost_value", original)
            merge_into_table(frame((2, "b")), "beside_t", root, primary_key="id")
        return original(*args)

    monkeypatch.setattr(ingest, "lost_value", other_load)
    with pytest.raises(RuntimeError, match="another load"):
        merge_into_table(frame((3, "c")), "beside_t", root, primary_key="id")
    assert rows(spark.table("beside_t"), "id") == [(1,), (2,)]
