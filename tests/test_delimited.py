import pytest

from rollforward.sources.delimited import list_files, read_csv, write_csv

from .conftest import rows


def put(folder, name, text):
    path = folder / name
    path.write_text(text)
    return str(path)


def test_header_file(spark, tmp_path):
    path = put(tmp_path, "s.csv", "id,name,age\n1,Alice,30\n2,Bob,41\n3,Cy,25\n")
    df = read_csv(spark, path)
    assert df.columns == ["id", "name", "age"] and df.count() == 3
    assert dict(df.dtypes)["age"] == "int"
    assert dict(read_csv(spark, path, infer_schema=False).dtypes)["age"] == "string"


def test_empty_first_header_cell_is_the_index_column(spark, tmp_path):
    path = put(tmp_path, "s.csv", ",id,name\n0,7,x\n1,8,y\n")
    assert read_csv(spark, path).columns == ["_c0", "id", "name"]
    assert read_csv(spark, path, drop_index_column=True).columns == ["id", "name"]


def test_no_header(spark, tmp_path):
    path = put(tmp_path, "s.csv", "0|7|x\n1|8|y\n")
    df = read_csv(spark, path, header=False, delimiter="|", drop_index_column=True)
    assert df.columns == ["_c1", "_c2"] and rows(df) == [(7, "x"), (8, "y")]


def test_ragged_and_bad_rows_are_kept(spark, tmp_path):
    path = put(tmp_path, "s.csv", "a,b,c\n1\n2,x,3,surplus\n4,,5\nbad,y,6\n")
    df = read_csv(spark, path, schema="a int, b string, c int")
    assert rows(df) == [(None, "y", 6), (1, None, None), (2, "x", 3), (4, None, 5)]


def test_repeated_header_names_are_numbered(spark, tmp_path):
    path = put(tmp_path, "s.csv", "id,id\n1,2\n")
    assert read_csv(spark, path).columns == ["id0", "id1"]


def test_file_identity_and_listing(spark, tmp_path):
    put(tmp_path, "one.csv", "a\n1\n2\n")
    put(tmp_path, "none.csv", "a\n")
    df = read_csv(spark, str(tmp_path), schema="a int", with_file=True)
    names = {r.file_name for r in df.collect()}
    assert {n.rsplit("/", 1)[1] for n in names} == {"one.csv"}
    listed = list_files(spark, str(tmp_path))
    assert {r.file_name.rsplit("/", 1)[1] for r in listed.collect()} == {"one.csv", "none.csv"}
    both = df.join(listed, ["file_name", "file_time"], "left_anti")
    assert both.isEmpty()


@pytest.mark.parametrize("header", [True, False])
def test_round_trip(spark, tmp_path, header):
    df = spark.createDataFrame([(1, "a;b", None), (2, 'q"q', 1.5)], "k int, t string, v double")
    path = str(tmp_path / "out")
    write_csv(df, path, header=header, delimiter=";")
    assert rows(read_csv(spark, path, schema=df.schema, header=header, delimiter=";")) == rows(df)


def test_many_headers_are_one_scan(spark, tmp_path):
    names = ["a", "b", "c", "d"]
    for i in range(24):
        order = names[i % 4 :] + names[: i % 4]
        order = order[: 2 + i % 3]
        put(tmp_path, f"f{i:02d}.csv", ",".join(order) + "\n" + ",".join(f"{n}{i}" for n in order) + "\n")
    df = read_csv(spark, str(tmp_path), infer_schema=False)
    text = df._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Relation") == 2 and "Union" not in text and "Python" not in text  # lines, and their headers
    expected = []
    for i in range(24):
        order = (names[i % 4 :] + names[: i % 4])[: 2 + i % 3]
        expected.append(tuple(f"{n}{i}" if n in order else None for n in names))
    assert rows(df, *names) == sorted(expected, key=lambda r: [(v is not None, str(v)) for v in r])


def test_headers_may_be_quoted_blank_or_alone(spark, tmp_path):
    put(tmp_path, "a.csv", '\n  \n"x,y",,Z\n1,2,3\n\n4,"5,5",6\n')
    put(tmp_path, "b.csv", "z\n")
    put(tmp_path, "c.csv", "")
    put(tmp_path, "d.csv", 'z,"x,y"\r\n7,8\r\n')
    df = read_csv(spark, str(tmp_path), infer_schema=False)
    assert df.columns == ["x,y", "_c1", "Z"]
    assert rows(df) == [("1", "2", "3"), ("4", "5,5", "6"), ("8", None, "7")]


def test_inferred_types(spark, tmp_path):
    put(tmp_path, "a.csv", "i,l,f,d,t,b,s,n\n1,1,1,2024-01-01,2024-01-01T10:00:00,true,x,\n")
    put(tmp_path, "b.csv", "i,l,f,d,t,b,s,n\n-2,30000000000,1.5e3,2024-02-02,2024-01-01 10:00:00.5,False,1,\n")
    types = dict(read_csv(spark, str(tmp_path)).dtypes)
    assert types == {
        "i": "int", "l": "bigint", "f": "double", "d": "date", "t": "timestamp", "b": "boolean", "s": "string", "n": "string",
    }


def test_a_large_file_is_read_in_splits(spark, tmp_path):
    lines = [f"{i},{'x' * 50}" for i in range(4000)]
    put(tmp_path, "a.csv", "k,v\n" + "\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = read_csv(spark, str(tmp_path))
        assert df.count() == 4000 and df.agg({"k": "sum"}).first()[0] == sum(range(4000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
