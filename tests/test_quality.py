import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rollforward.operators import first, quality
from rollforward.operators.first import flag_first, keep_first, total_order
from rollforward.operators.quality import DROP_ALL, KEEP_ONE, OFF, Rules

from .conftest import rows

SCHEMA = "k int, a string, b int"


def random_rows(seed, n=400):
    rng = random.Random(seed)
    pick = lambda values: rng.choice([None, *values])
    return [(pick(range(12)), pick("pqr"), pick(range(3))) for _ in range(n)]


def text(data):
    return Counter(map(str, data))


def test_null_rejects_name_the_first_column(spark):
    df = spark.createDataFrame([(1, "a", 1), (None, None, 2), (3, None, 3)], SCHEMA)
    found = quality.null_rejects(df, ["k", "a"])
    assert rows(found, "b", "reject_reason") == [(2, "null:k"), (3, "null:a")]


def test_null_filter_keeps_copies(spark):
    df = spark.createDataFrame([(1, "a", None), (1, "a", None), (None, "x", 1)], SCHEMA)
    assert quality.not_null(df, ["k"]).count() == 2


@pytest.mark.parametrize("mode", [KEEP_ONE, OFF])
@pytest.mark.parametrize("order", [(), ("b",)])
def test_every_row_is_clean_or_rejected_once(spark, mode, order):
    data = random_rows(1)
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    rules = Rules(key=("k",), required=("a",), order=order, full_duplicates=mode)
    clean, rejected = quality.split(df, rules)
    kept = [tuple(r) for r in clean.collect()]
    refused = [tuple(r) for r in rejected.collect()]
    assert text([*kept, *[r[:-1] for r in refused]]) == text(data)
    assert len({r[0] for r in kept}) == len(kept)

    passed = [r for r in data if r[1] is not None]
    by_reason = Counter(r[-1] for r in refused)
    expected = {"null:a": len(data) - len(passed)}
    copies = len(passed) - len(set(passed))
    if mode == KEEP_ONE:
        expected["full_duplicate"] = copies
        expected["duplicate_key"] = len(set(passed)) - len(kept)
    else:
        expected["duplicate_key"] = len(passed) - len(kept)
    assert by_reason == expected
    assert dict(rows(quality.summary(df, rules))) == {**expected, "clean": len(kept)}
    if order:
        for key, _, b in kept:
            group = [r[2] for r in passed if r[0] == key]
            assert b == min(group, key=lambda v: (v is not None, v or 0))


def test_split_does_not_depend_on_partitioning(spark):
    df = spark.createDataFrame(random_rows(2), SCHEMA)
    rules = Rules(key=("k",), required=("b",))
    results = {
        (str(rows(quality.clean(d, rules))), str(rows(quality.rejected(d, rules))))
        for d in (df, df.repartition(7), df.coalesce(1), df.orderBy("a"))
    }
    assert len(results) == 1


@pytest.mark.parametrize("identity", [(), ("k", "a", "b")])
def test_drop_all_takes_every_copy_out(spark, identity):
    data = random_rows(3, 150)
    df = spark.createDataFrame(data, SCHEMA)
    rules = Rules(
        key=("k",), required=("k",), full_duplicates=DROP_ALL, identity=identity, order=("a",)
    )
    passed = Counter(r for r in data if r[0] is not None)
    single = [r for r, n in passed.items() if n == 1]
    repeated = [r for r, n in passed.items() if n > 1]
    clean, rejected = quality.split(df, rules)
    kept = [tuple(r) for r in clean.collect()]
    assert set(kept) <= set(single) and {r[0] for r in kept} == {r[0] for r in single}
    refused = {reason: [] for reason in ("full_duplicate", "duplicate_key", "null:k")}
    for row in rejected.collect():
        refused[row.reject_reason].append(tuple(row)[:-1])
    assert text(refused["full_duplicate"]) == text(repeated)
    assert text([*refused["duplicate_key"], *kept]) == text(single)
    counts = {reason: len(found) for reason, found in refused.items()}
    assert dict(rows(quality.summary(df, rules))) == {**counts, "clean": len(kept)}


def test_identity_columns_stand_for_the_row(spark):
    df = spark.createDataFrame([(1, "h", 1), (1, "h", 2), (1, "g", 3), (2, "h2", 4)], SCHEMA)
    rules = Rules(key=("k",), identity=("a",))
    reasons = Counter(r.reject_reason for r in quality.rejected(df, rules).collect())
    assert reasons == {"full_duplicate": 1, "duplicate_key": 1}
    assert quality.unduplicated(df, ["a"]).count() == 2
    assert rows(quality.duplicated(df, ["a"]), "a") == [("h",)]


def test_null_keys_are_one_group(spark):
    df = spark.createDataFrame([(None, "a", 1), (None, "b", 2), (1, "c", 3)], SCHEMA)
    assert quality.clean(df, Rules(key=("k",))).count() == 2
    assert keep_first(df, "k", [F.col("b")]).count() == 2


def test_flag_first_marks_one_row_per_key(spark):
    df = spark.createDataFrame(random_rows(4), SCHEMA).repartition(6)
    order = total_order(df, [F.col("b").desc()])
    marked = flag_first(df, "k", order, "first")
    assert rows(marked.drop("first")) == rows(df)
    assert rows(marked.filter("first").drop("first")) == rows(keep_first(df, "k", order))


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        Rules(key=("k",), full_duplicates="some")


def test_primary_key_checks(spark):
    schema = "id long, name string"
    fine = spark.createDataFrame([(1, "Alice"), (2, "Bob")], schema)
    quality.validate_primary_key(fine, "id")
    assert quality.pk_violations(fine, "id").isEmpty()
    twice = spark.createDataFrame([(1, "Alice"), (1, "Bob")], schema)
    with pytest.raises(ValueError, match="Duplicate primary keys detected"):
        quality.validate_primary_key(twice, "id")
    null = spark.createDataFrame([(None, "Alice"), (2, "Bob"), (2, "Cy")], schema)
    with pytest.raises(ValueError, match="Found NULL primary keys"):
        quality.validate_primary_key(null, "id")
    quality.validate_primary_key(twice, ["id", "name"])
    assert rows(quality.pk_violations(null, "id")) == [
        ("duplicate_key", 2, 2),
        ("null_key", None, 1),
    ]


@pytest.mark.parametrize("mode", ["keep_one", "drop_all"])
def test_identity_under_two_keys_is_no_copy(spark, mode):
    data = [(1, "x", 1), (1, "y", 2), (2, "x", 1), (2, "z", 2), (2, "z", 2)]
    df = spark.createDataFrame(data, "k int, h string, o int")
    rules = Rules(key=("k",), order=("o",), full_duplicates=mode, identity=("h",))
    good, bad = rows(quality.clean(df, rules)), rows(quality.rejected(df, rules))
    assert good == [(1, "x", 1), (2, "x", 1)]
    counted = {r["outcome"]: r["n"] for r in quality.summary(df, rules).collect()}
    assert counted["clean"] == 2
    expected = [(1, "y", 2, "duplicate_key"), (2, "z", 2, "full_duplicate")]
    if mode == "keep_one":
        expected.insert(1, (2, "z", 2, "duplicate_key"))
        assert sum(counted.values()) == len(data)
    assert bad == expected


@pytest.mark.parametrize("mode", [KEEP_ONE, OFF, DROP_ALL])
@pytest.mark.parametrize("identity", [(), ("a",)])
def test_hot_keys_are_judged_like_others(spark, monkeypatch, mode, identity):
    hash_of = F.when(F.col("b") % 2 == 0, F.sha2(F.col("b").cast("string"), 256)).otherwise(F.col("b").cast("string"))
    df = spark.createDataFrame(random_rows(7, 300), SCHEMA).withColumn("h", hash_of).repartition(6)
    rules = Rules(key=("k", "h"), required=("a",), order=("h", "b"), full_duplicates=mode, identity=identity)
    together = rows(quality.judged(df, rules))
    monkeypatch.setattr("rollforward.operators.first.HOT_ROWS", 0)
    assert together == rows(quality.judged(df, rules))
    clean = [r[:-1] for r in together if r[-1] is None]
    assert [str(r) for r in clean] == [str(r) for r in rows(quality.clean(df, rules))]


def test_rejects_move_rows_once(spark, tmp_path):
    spark.createDataFrame(random_rows(8), SCHEMA).write.parquet(str(tmp_path / "rows"))
    df = spark.read.parquet(str(tmp_path / "rows"))
    rules = Rules(key=("k", "a"), required=("k",), order=("b",))
    found = quality._judged_together(quality.not_null(df, rules.required), rules)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert rows(found.filter("reject_reason IS NOT NULL")) == rows(
        quality.rejected(df, rules).filter("reject_reason NOT LIKE 'null:%'")
    )


def test_rows_alone_under_their_key_are_not_moved(spark, monkeypatch):
    df = spark.range(3000).select((F.col("id") % 2900).alias("k"), F.col("id").cast("string").alias("text"))
    others = spark.range(5, 15).select(F.col("id").alias("k")).unionByName(spark.createDataFrame([(None,)], "k long"))
    moved = []
    together = quality._judged_together
    monkeypatch.setattr(quality, "_judged_together", lambda rest, rules: moved.append(rest) or together(rest, rules))
    found = quality.judged(df, Rules(key=("k",), order=("text",)))
    assert found.count() == 3000 and found.filter("reject_reason = 'duplicate_key'").count() == 100
    assert 200 <= moved[0].count() < 300
    alone, again = first.by_repeats(df.dropDuplicates(["k"]), "k", others)
    assert alone.count() + again.count() == 2900
    assert alone.join(others, "k").count() == 0 and 10 <= again.count() < 100
    monkeypatch.setattr(first, "MARKS", 1)  # all keys share a bit: all rows get the exact test
    alone, again = first.by_repeats(df, "k")
    assert alone.count() == 0 and again.count() == 3000
