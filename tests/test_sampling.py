import pytest
from pyspark.sql import functions as F

from conftest import SF_MID
from opinio.operators import sampling as sm
from opinio.options import SplitOptions


@pytest.mark.parametrize("counts,expected", [
    ({0: 500, 1: 500}, {0: (100, 50, 350), 1: (100, 50, 350)}),
    ({0: 1000, 1: 1000}, {0: (200, 100, 700), 1: (200, 100, 700)}),
    ({0: 25000, 1: 25000}, {0: (5000, 2500, 17500), 1: (5000, 2500, 17500)}),
    ({0: 58, 1: 341}, {0: (12, 6, 40), 1: (68, 34, 239)}),
])
def test_quotas(counts, expected):
    assert sm.split_quotas(counts) == expected


def test_quota_errors():
    with pytest.raises(ValueError):
        sm.split_quotas({0: 1, 1: 100})


def _labels(spark):
    return spark.read.parquet(f"{SF_MID}/labels.parquet").select("doc_id", F.col("quality").alias("y"))


def test_split_exact_disjoint_covering(spark):
    df = _labels(spark)
    out = sm.stratified_split(df, "y", "doc_id")
    rows = out.collect()
    assert len(rows) == df.count() and len({r.doc_id for r in rows}) == len(rows)
    got = {}
    for r in rows:
        got[(r.y, r.split)] = got.get((r.y, r.split), 0) + 1
    assert got == {(0, "train"): 40, (0, "val"): 6, (0, "test"): 12, (1, "train"): 239, (1, "val"): 34, (1, "test"): 68}


def test_split_equals_plain_rank_and_ignores_partitioning(spark):
    from pyspark.sql import Window

    df = _labels(spark)
    a = {(r.doc_id, r.split) for r in sm.stratified_split(df.repartition(1), "y", "doc_id").collect()}
    b = {(r.doc_id, r.split) for r in sm.stratified_split(df.repartition(13), "y", "doc_id",
                                                          SplitOptions(bucket_hex_digits=1)).collect()}
    assert a == b
    # bucketed rank == plain row_number over the class
    w = Window.partitionBy("y").orderBy(sm.order_key("doc_id", 42), "doc_id")
    plain = {(r.doc_id, r.rk) for r in df.withColumn("rk", F.row_number().over(w)).collect()}
    bucketed = {(r.doc_id, r.rank) for r in sm.class_rank(df, "y", "doc_id", 42, 2).collect()}
    assert plain == bucketed


def test_folds_stratified(spark):
    df = _labels(spark)
    folds = sm.assign_folds(df, "y", "doc_id", 5, 42)
    sizes = {(r.y, r.fold): r["count"] for r in folds.groupBy("y", "fold").count().collect()}
    for y in (0, 1):
        vals = [sizes[(y, f)] for f in range(5)]
        assert max(vals) - min(vals) <= 1


def test_sample_n_is_the_smallest_keys(spark):
    df = _labels(spark)
    order = df.select("doc_id", sm.order_key("doc_id", 3).alias("k")).orderBy("k", "doc_id").collect()
    for n in (1, 123, df.count()):
        assert {r.doc_id for r in sm.sample_n(df, n, "doc_id", 3).collect()} == {r.doc_id for r in order[:n]}
    assert sm.sample_n(df, None, "doc_id").count() == df.count()
    assert sm.sample_n(df, 10_000, "doc_id").count() == df.count()


def test_fold_ranges_move_no_rows(spark):
    rows = [(i, float(i % 7 > 1), [float(i)]) for i in range(83)] + [(900, 2.0, [0.0])]
    df = spark.createDataFrame(rows, "doc_id long, y double, features array<double>")
    out = sm.fold_ranges(df, "y", "doc_id", 5, 42)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.replace("BroadcastExchange", "")
    got = out.collect()
    for y in (0.0, 1.0, 2.0):
        sizes = [sum(r.y == y and r.fold == k for r in got) for k in range(5)]
        assert sum(sizes) == sum(r[1] == y for r in rows) and max(sizes) - min(sizes) <= 1
    assert sm.fold_ranges(df.limit(0), "y", "doc_id").count() == 0


def test_split_report_tells_null_groups_from_totals(spark):
    from opinio.operators.profile import split_report

    df = spark.createDataFrame([("a", 1), ("a", 0), ("a", None), (None, 1)], "split string, sentiment int")
    got = {(r.level, r.split, r.sentiment): (r.rows, r.share_of_parent, r.share_of_all) for r in split_report(df).collect()}
    third = round(1 / 3, 9)
    assert got == {(0, None, None): (4, 1.0, 1.0), (1, "a", None): (3, 0.75, 0.75), (1, None, None): (1, 0.25, 0.25),
                   (2, "a", 1): (1, third, 0.25), (2, "a", 0): (1, third, 0.25), (2, "a", None): (1, third, 0.25),
                   (2, None, 1): (1, 1.0, 0.25)}
    assert split_report(df.limit(0)).where("level > 0").count() == 0
