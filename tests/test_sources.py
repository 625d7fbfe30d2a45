"""S1-S5, P1-P8 and dense ``pos``."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL

from evoclust.sources.points import (
    drop_feature,
    parse_vector,
    points_by_position,
    points_from_columns,
    read_abalone,
    read_iris,
    read_named_csv,
    read_numeric_csv,
    recode,
    with_pos,
)


def write(tmp_path, name, text):
    p = os.path.join(tmp_path, name)
    with open(p, "w") as f:
        f.write(text)
    return p


def test_numeric_csv_and_parse(spark, tmp_path):
    p = write(str(tmp_path), "m.csv", "1,2,3\n4.5,5,6\n\n")
    rows = read_numeric_csv(spark, p).orderBy("row_id").collect()
    assert [r["x"] for r in rows] == [[1.0, 2.0, 3.0], [4.5, 5.0, 6.0]]
    assert [r["pos"] for r in rows] == [0, 1]
    df = spark.createDataFrame([(' "1", .2 ,3',)], "s string")
    assert df.select(parse_vector("s")).collect()[0][0] == [1.0, 0.2, 3.0]


def test_iris_files(spark, tmp_path):
    quoted = write(str(tmp_path), "iris.csv", '"sepal.length","sepal.width","petal.length","petal.width","variety"\n'
                   '5.1,3.5,1.4,.2,"Setosa"\n6.3,3.3,6,2.5,"Virginica"\n')
    raw = write(str(tmp_path), "iris.data", "5.1,3.5,1.4,0.2,Iris-setosa\n7.0,3.2,4.7,1.4,Iris-versicolor\n\n")
    a = read_iris(spark, quoted, header=True).orderBy("row_id").collect()
    b = read_iris(spark, raw).orderBy("row_id").collect()
    assert [r["label"] for r in a] == [0, 2] and a[0]["x"] == [5.1, 3.5, 1.4, 0.2]
    assert [r["label"] for r in b] == [0, 1] and len(b) == 2


def test_abalone(spark, tmp_path):
    p = write(str(tmp_path), "abalone.data", "M,0.455,0.365,0.095,0.514,0.2245,0.101,0.15,15\n"
              "F,0.53,0.42,0.135,0.677,0.2565,0.1415,0.21,29\nI,0.33,0.255,0.08,0.205,0.0895,0.0395,0.055,7\n")
    rows = read_abalone(spark, p).orderBy("row_id").collect()
    assert [r["x"][0] for r in rows] == [2.0, 0.0, 1.0]
    assert [r["label"] for r in rows] == [14, 27, 6]
    assert len(read_abalone(spark, p, with_sex=False).first()["x"]) == 7


def test_columns_recode_drop(spark):
    df = spark.createDataFrame([(3, 1.0, 2, 9), (1, 4.0, 5, 28)], "id long, a double, b int, lab int")
    pts = points_from_columns(df, "id", ["a", "b"], "lab")
    assert pts.orderBy("row_id").first()["x"] == [4.0, 5.0]
    rec = pts.select(recode("label", {28: 27}).alias("l")).orderBy("l").collect()
    assert [r["l"] for r in rec] == [9, 27]
    assert drop_feature(pts, 0).orderBy("row_id").first()["x"] == [5.0]


def test_with_pos_is_dense_and_ordered(spark):
    df = spark.range(0, 1000, 3).select((F.col("id") * 5 % 1001).alias("row_id"), F.array(F.lit(1.0)).alias("x"))
    out = with_pos(df.repartition(5)).orderBy("row_id").collect()
    assert [r["pos"] for r in out] == list(range(len(out)))
    keyless = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    feats = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    got = points_by_position(keyless, feats, num_partitions=3)
    assert got.rdd.getNumPartitions() == 3
    rows = got.orderBy("pos").collect()
    assert [r["pos"] for r in rows] == list(range(6000)) and all(r["row_id"] == r["pos"] for r in rows)
    # input order: the n-th row of the file gets pos n, on every computation
    first = keyless.select(*feats).limit(5).collect()
    assert [r["x"] for r in rows[:5]] == [[float(v) for v in f] for f in first]
    again = sorted((r["pos"], tuple(r["x"])) for r in got.collect())
    assert again == [(r["pos"], tuple(r["x"])) for r in rows]


def test_a_headerless_csv_keeps_all_rows(spark, tmp_path):
    p = write(str(tmp_path), "labelled.csv", "5.1,3.5,1.4,0.2,Iris-setosa\n7.0,3.2,4.7,1.4,Iris-versicolor\n6.3,3.3,6.0,2.5,Iris-virginica\n")
    assert sorted(r["label"] for r in read_iris(spark, p).collect()) == [0, 1, 2]


def test_header_lines_of_several_files(spark, tmp_path):
    files = [write(str(tmp_path), f"{i}.csv", f'a,"b",lab\n{i},.5,{i}\n\n{i + 10},2,1\n') for i in range(3)]
    rows = read_named_csv(spark, files, ["b", "a"], "lab").collect()
    assert sorted(r["x"][1] for r in rows) == [0.0, 1.0, 2.0, 10.0, 11.0, 12.0]
    assert sorted(r["pos"] for r in rows) == list(range(6)) and {r["label"] for r in rows} == {0, 1, 2}
    assert read_numeric_csv(spark, files, header=True, label_last=True).count() == 6


def test_csv_round_trip_of_a_table(spark, tmp_path):
    part = spark.read.parquet(f"{SF_SMALL}/part.parquet").select("p_partkey", "p_size", "p_retailprice")
    part.repartition(3).write.csv(str(tmp_path / "part"), header=True)
    got = read_named_csv(spark, str(tmp_path / "part"), ["p_partkey", "p_retailprice"], "p_size")
    want = sorted((float(r[0]), r[2], r[1]) for r in part.collect())
    assert sorted((r["x"][0], r["x"][1], r["label"]) for r in got.collect()) == want


def test_numbering_an_aggregate_is_dense(spark):
    big = spark.range(50_000).groupBy((F.col("id") * 31 % 50_000).alias("a")).agg(F.max("id").alias("m"), F.max(F.lit("pad" * 9)).alias("p"))
    got = points_by_position(big, ["a", "m"])
    r = got.agg(F.countDistinct("row_id").alias("d"), F.max("row_id").alias("hi"), F.count(F.lit(1)).alias("n")).first()
    assert (r["d"], r["hi"], r["n"]) == (50_000, 49_999, 50_000)


def test_a_repeated_id_is_an_error(spark):
    df = spark.createDataFrame([(1, [0.0]), (2, [1.0]), (1, [2.0])], "row_id bigint, x array<double>")
    with pytest.raises(Exception, match="repeats"):
        with_pos(df).count()
