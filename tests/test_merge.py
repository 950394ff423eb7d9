import contextlib
import io
import random
import re

from pyspark.sql import functions as F

from rollforward.functions.hashing import with_row_hash
from rollforward.operators import merge
from rollforward.operators.changes import change_feed
from rollforward.operators.fold import fold_insert_only, fold_keyed
from rollforward.operators.part_changes import change_feed_by_parts, changed_parts, part_digests
from rollforward.sources.parted import part_of

from .conftest import rows

COLUMNS = "case int, k int, v string, load_datetime string, updated_datetime string"
DATA = ["case", "k", "v"]


def frame(spark, data):
    return with_row_hash(spark.createDataFrame(data, COLUMNS), DATA)


def random_load(rng, case, stamp):
    """One load with unique keys and maybe a row without a key."""
    keys = rng.sample(range(6), rng.randint(0, 5))
    data = [(case, k, rng.choice("abc"), stamp, stamp) for k in keys]
    if rng.random() < 0.4:
        data.append((case, None, rng.choice("abc"), stamp, stamp))
    return data


def merge_one_by_one(target, load):
    """The keyed merge as a plain loop over lists of rows."""
    result = list(target)
    for row in load:
        found = [i for i, t in enumerate(target) if row[1] is not None and t[1] == row[1]]
        if not found:
            result.append(row)
        for i in found:
            if result[i][2] != row[2]:
                result[i] = (*row[:3], result[i][3], row[4])
    return result


def random_cases(seed, cases, loads):
    rng = random.Random(seed)
    return {c: [random_load(rng, c, f"t{i}") for i in range(loads)] for c in range(cases)}


def flat(loads):
    return [row for load in loads for row in load]


def in_order(data):
    return sorted(data, key=lambda r: [(v is not None, str(v)) for v in r])


def test_upsert_changed_equals_a_loop(spark):
    cases = random_cases(1, 60, 2)
    target = frame(spark, flat(c[0] for c in cases.values()))
    source = frame(spark, flat(c[1] for c in cases.values()))
    merged = merge.upsert_changed(target, source, ["case", "k"])
    expected = flat(merge_one_by_one(c[0], c[1]) for c in cases.values())
    assert rows(merged.drop("row_hash")) == in_order(expected)


def test_upsert_is_idempotent_and_starts_from_nothing(spark):
    load = frame(spark, [(0, 1, "a", "t0", "t0"), (0, 2, "b", "t0", "t0")])
    empty = load.limit(0)
    first = merge.upsert_changed(empty, load, ["case", "k"])
    assert rows(first) == rows(load)
    later = load.withColumns({"load_datetime": F.lit("t1"), "updated_datetime": F.lit("t1")})
    assert rows(merge.upsert_changed(first, later, ["case", "k"])) == rows(load)


def test_null_keys_are_inserted_every_time(spark):
    load = frame(spark, [(0, None, "a", "t0", "t0")])
    assert merge.upsert_changed(load, load, ["case", "k"]).count() == 2


def test_changes_of_a_merge_turn_target_into_result(spark):
    cases = random_cases(2, 60, 2)
    target = frame(spark, flat(c[0] for c in cases.values()))
    source = frame(spark, flat(c[1] for c in cases.values()))
    moved = merge.upsert_changes(target, source, ["case", "k"])
    assert applied(target, moved) == rows(merge.upsert_changed(target, source, ["case", "k"]))


def applied(old, feed):
    gone = feed.filter(F.col("_change_type").isin("delete", "update_preimage"))
    come = feed.filter(F.col("_change_type").isin("insert", "update_postimage"))
    return rows(
        old.exceptAll(gone.drop("_change_type")).unionByName(come.drop("_change_type"))
    )


def test_change_feed_turns_old_into_new(spark):
    cases = random_cases(3, 60, 2)
    old = frame(spark, flat(c[0] for c in cases.values()))
    new = frame(spark, flat(c[1] for c in cases.values()))
    feed = change_feed(old, new, ["case", "k"], hash_column="row_hash")
    assert applied(old, feed) != rows(old)
    # rows whose hash agrees count as unchanged: compare without the stamps
    data = [*DATA, "row_hash"]
    assert applied(old.select(data), feed.select(*data, "_change_type")) == rows(new.select(data))
    same = change_feed(old.filter("k is not null"), old.filter("k is not null"), ["case", "k"])
    assert same.isEmpty()


def test_change_types(spark):
    old = frame(spark, [(0, 1, "a", "", ""), (0, 2, "b", "", ""), (0, 3, "c", "", "")])
    new = frame(spark, [(0, 1, "a", "", ""), (0, 2, "x", "", ""), (0, 4, "d", "", "")])
    assert rows(change_feed(old, new, ["case", "k"]), "k", "v", "_change_type") == [
        (2, "b", "update_preimage"),
        (2, "x", "update_postimage"),
        (3, "c", "delete"),
        (4, "d", "insert"),
    ]


def test_insert_only(spark):
    target = frame(spark, [(0, 1, "a", "t0", "t0"), (0, 1, "a", "t0", "t0")])
    source = frame(spark, [(0, 1, "a", "t1", "t1"), (0, 2, "b", "t1", "t1")])
    merged = merge.insert_only(target, source)
    assert rows(merged, "k", "v", "load_datetime") == [
        (1, "a", "t0"),
        (1, "a", "t0"),
        (2, "b", "t1"),
    ]
    assert rows(merge.insert_only(merged, source)) == rows(merged)
    assert rows(merge.insert_only_changes(target, source), "k", "_change_type") == [(2, "insert")]


def test_update_all_overwrites_with_null(spark):
    target = spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], "x int, y int, v string")
    source = spark.createDataFrame([(1, 2, None), (3, 1, "c")], "x int, y int, v string")
    assert rows(merge.update_all(target, source, ["x", "y"])) == [
        (1, 1, "a"),
        (1, 2, None),
        (3, 1, "c"),
    ]


def test_keyed_fold_equals_merging_one_by_one(spark):
    cases = random_cases(4, 80, 6)
    for start in ("empty", "existing"):
        expected, initial, loads = [], [], []
        for case in cases.values():
            state = [] if start == "empty" else case[0]
            initial += state
            for seq, load in enumerate(case[1:], start=1):
                state = merge_one_by_one(state, load)
                loads += [(*row, seq) for row in load]
            expected += state
        staged = with_row_hash(spark.createDataFrame(loads, COLUMNS + ", seq int"), DATA)
        folded = fold_keyed(staged, ["case", "k"], "seq")
        source = folded.withColumns(
            {
                "load_datetime": F.concat(F.lit("t"), "load_seq"),
                "updated_datetime": F.concat(F.lit("t"), "updated_seq"),
            }
        ).drop("seq", "load_seq", "updated_seq")
        merged = merge.upsert_changed(
            frame(spark, initial), source, ["case", "k"], force="rewritten"
        )
        assert rows(merged.drop("row_hash")) == in_order(expected)


def test_insert_only_fold_equals_merging_one_by_one(spark):
    cases = random_cases(5, 60, 5)
    expected, loads = [], []
    for case in cases.values():
        seen = {}
        for seq, load in enumerate(case):
            loads += [(*row, seq) for row in load]
            for row in load:
                seen.setdefault(tuple(str(v) for v in row[:3] if v is not None), (*row[:3], seq))
        expected += seen.values()
    staged = with_row_hash(spark.createDataFrame(loads, COLUMNS + ", seq int"), DATA)
    folded = fold_insert_only(staged, "seq")
    assert rows(folded, *DATA, "load_seq") == in_order(expected)


def in_parts(df, keys=("case", "k"), parts=8):
    return df.withColumn("part", part_of(list(keys), parts, ["row_hash"]))


def test_change_feed_by_parts_equals_the_whole_feed(spark):
    cases = random_cases(7, 60, 2)
    old = frame(spark, flat(c[0] for c in cases.values()))
    new = frame(spark, flat(c[1] for c in cases.values()))
    names = [*old.columns, "_change_type"]
    for a, b in ((old, new), (old, old.filter("false")), (new.filter("false"), new), (old, old)):
        whole = rows(change_feed(a, b, ["case", "k"]), *names)
        assert rows(change_feed_by_parts(in_parts(a), in_parts(b), ["case", "k"], part="part"), *names) == whole
    stored = part_digests(in_parts(old), ["case", "k"], part="part")
    found = change_feed_by_parts(in_parts(old), in_parts(new), ["case", "k"], part="part", old_digests=stored)
    assert rows(found, *names) == rows(change_feed(old, new, ["case", "k"]), *names)


def test_change_feed_by_parts_sees_hashes_that_changed_places(spark):
    schema = "k int, row_hash string, part int"
    old = spark.createDataFrame([(1, "a", 0), (2, "b", 0), (3, "c", 1)], schema)
    new = spark.createDataFrame([(1, "b", 0), (2, "a", 0), (3, "c", 1)], schema)
    assert change_feed_by_parts(old, new, "k", part="part").count() == 4
    differ = changed_parts(part_digests(old, "k", part="part"), part_digests(new, "k", part="part"))
    assert rows(differ) == [(0,)]


def test_change_feed_by_parts_reads_only_parts_that_differ(spark, tmp_path):
    sides = []
    for name, value in (("old", 0), ("new", 1)):
        side = spark.range(4000).select(
            F.col("id").alias("k"), F.when(F.col("id") == 17, value).otherwise(5).alias("v")
        )
        side = in_parts(with_row_hash(side, ["k", "v"]), ["k"], 16)
        side.write.partitionBy("part").parquet(str(tmp_path / name))
        sides.append(spark.read.schema(side.schema).parquet(str(tmp_path / name)))
    feed = change_feed_by_parts(*sides, "k", part="part")
    assert rows(feed, "k", "_change_type") == [(17, "update_postimage"), (17, "update_preimage")]
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        feed.explain("formatted")
    scans = re.findall(r"PartitionFilters: (.*)", text.getvalue())
    here = sides[0].filter("k = 17").first()["part"]
    assert len(scans) >= 2 and all(re.search(rf"part#\d+ (=|IN) \(?{here}\b", s) for s in scans)


def test_hashes_move_in_half_their_length(spark):
    old = spark.range(40).select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("row_hash"))
    new = old.withColumn("row_hash", F.when(F.col("k") % 3 == 0, F.lit("short")).otherwise(F.col("row_hash")))
    merged = merge.upsert_changed(old, new, "k", keep=())
    assert "unhex(" in merged._jdf.queryExecution().optimizedPlan().toString()
    assert rows(merged) == rows(new)
    moved = merge.upsert_changes(old, new, "k", keep=())
    assert rows(moved.filter("_change_type = 'update_postimage'").drop("_change_type")) == rows(new.filter("k % 3 = 0"))
    assert merge.kinds_of_change(old, new, "k").count() == 14
    # hashes that are no text are left as they are
    numbers = lambda df: df.withColumn("row_hash", F.length("row_hash"))
    assert rows(merge.upsert_changed(numbers(old), numbers(new), "k", keep=())) == rows(numbers(new))
