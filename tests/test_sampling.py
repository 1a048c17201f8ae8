import hashlib

from pyspark.sql import functions as F

from flowmedallion.operators import sampling as S


def rows(spark, n=20_000, partitions=5):
    # a third of all rows are attacks
    return spark.range(n, numPartitions=partitions).select(
        "id", (F.col("id") % 3 == 0).cast("int").alias("is_attack"), F.lit("x").alias("label")
    )


def digest(key, seed):
    return hashlib.md5(f"{seed}|{key}".encode()).hexdigest()


def test_split_is_disjoint_complete_and_stable(spark):
    df = rows(spark)
    split = S.stratified_split(df, ["id"])
    assert split.count() == 20_000 and split.select("id").distinct().count() == 20_000
    again = S.stratified_split(df.repartition(11), ["id"])
    assert split.exceptAll(again).count() == 0
    test = {r["id"] for r in S.part(split, S.TEST).select("id").collect()}
    assert test == {i for i in range(20_000) if digest(i, 42)[:8] < "33333333"}
    for value, share in ((0, 0.2), (1, 0.2)):
        of_class = split.filter(F.col("is_attack") == value)
        assert abs(of_class.filter("split = 'test'").count() / of_class.count() - share) < 0.02
    plan = split._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_other_seed_gives_other_rows(spark):
    df = rows(spark, 2000)
    one, two = (S.part(S.stratified_split(df, ["id"], seed=s), S.TEST).select("id") for s in (1, 2))
    assert one.exceptAll(two).count() > 0


def test_exact_split_has_exact_class_shares(spark):
    df = rows(spark, 10_001)
    split = S.stratified_split_exact(df, key_cols=["id"])
    counts = {(r["is_attack"], r["split"]): r["count"] for r in split.groupBy("is_attack", "split").count().collect()}
    assert counts == {(1, "test"): 667, (1, "train"): 2667, (0, "test"): 1333, (0, "train"): 5334}
    # brute force: the smallest digests of each class
    attacks = sorted((i for i in range(10_001) if i % 3 == 0), key=lambda i: digest(i, 42))
    test = {r["id"] for r in split.filter("split = 'test' and is_attack = 1").collect()}
    assert test == set(attacks[:667])
    again = S.stratified_split_exact(df.repartition(3), key_cols=["id"])
    assert split.exceptAll(again).count() == 0


def test_exact_split_of_small_and_missing_classes(spark):
    df = spark.createDataFrame([(i, 0) for i in range(10)] + [(99, 1)], "id int, is_attack int")
    split = S.stratified_split_exact(df, key_cols=["id"])
    assert split.filter("split = 'test'").count() == 2 and split.count() == 11
    assert S.stratified_split_exact(df.limit(0), key_cols=["id"]).count() == 0


def test_exact_split_keeps_every_class(spark):
    df = spark.createDataFrame([(i, (0, 1, 2, None)[i % 4]) for i in range(40)], "id int, is_attack int")
    split = S.stratified_split_exact(df, key_cols=["id"])
    counts = {(r["is_attack"], r["split"]): r["count"] for r in split.groupBy("is_attack", "split").count().collect()}
    assert counts == {(c, s): n for c in (0, 1, 2, None) for s, n in (("test", 2), ("train", 8))}


def test_exact_split_with_a_hot_key(spark):
    """One key holds a third of all rows: its copies stay together and no row is lost."""
    df = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("key"), (F.col("id") % 2).cast("int").alias("is_attack")
    )
    split = S.stratified_split_exact(df, key_cols=["key"])
    assert split.count() == 9000
    assert split.filter("key = -1").select("is_attack", "split").distinct().count() == 2
    for value in (0, 1):
        keys = [r["key"] for r in df.filter(F.col("is_attack") == value).collect()]
        cut = sorted(digest(k, 42) for k in keys)[899]
        test = [r["key"] for r in split.filter(f"is_attack = {value} and split = 'test'").collect()]
        assert sorted(test) == sorted(k for k in keys if digest(k, 42) <= cut)


def test_sample_takes_the_same_fraction_of_each_class(spark):
    df = rows(spark)
    sample = S.stratified_sample(df, key_cols=["id"], sample_size=5000)
    by_class = {r["is_attack"]: r["count"] for r in sample.groupBy("is_attack").count().collect()}
    assert abs(by_class[1] / 6667 - 0.25) < 0.03 and abs(by_class[0] / 13_333 - 0.25) < 0.03
    assert sample.exceptAll(S.stratified_sample(df.repartition(9), key_cols=["id"], sample_size=5000)).count() == 0
    assert S.stratified_sample(df, key_cols=["id"], sample_size=10**9).count() == 20_000
    assert S.stratified_sample(df.limit(0), key_cols=["id"]).count() == 0


def test_sample_drops_unknown_classes(spark):
    df = spark.createDataFrame([(1, 0), (2, 1), (3, None), (4, 7)], "id int, is_attack int")
    assert {r["id"] for r in S.stratified_sample(df, key_cols=["id"]).collect()} == {1, 2}


def test_temporal_split(spark):
    days = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", None]
    df = spark.createDataFrame([(d,) for d in days], "day_of_week string")
    split = {r["day_of_week"]: r["split"] for r in S.temporal_split(df).collect()}
    assert split == {"Monday": "train", "Tuesday": "train", "Wednesday": "train", "Thursday": "test", "Friday": "test"}


def test_temporal_split_reads_only_its_days(spark, tmp_path):
    df = spark.createDataFrame([("Monday", 1), ("Friday", 2), ("Sunday", 3)], "day_of_week string, n int")
    df.write.partitionBy("day_of_week").parquet(str(tmp_path / "gold"))
    split = S.temporal_split(spark.read.parquet(str(tmp_path / "gold")))
    assert "PartitionFilters: [day_of_week" in split._jdf.queryExecution().executedPlan().toString()
    assert split.count() == 2


def test_random_rows(spark):
    df = rows(spark, 1000)
    picked = S.random_rows(df, 10, ["id"])
    assert picked.count() == 10 and picked.exceptAll(S.random_rows(df.repartition(4), 10, ["id"])).count() == 0
    assert "TakeOrderedAndProject" in picked._jdf.queryExecution().executedPlan().toString()


def test_sides_are_those_of_the_exact_split(spark):
    columns = "id", F.when(F.col("id") % 4 > 0, F.col("id") % 2).cast("int").alias("is_attack"), (F.col("id") / 3).cast("int").alias("key")
    for n in (0, 1, 2, 1000):
        df = spark.range(n, numPartitions=3).select(*columns)  # a null class, and copies of keys
        for share in (0.0, 0.2, 1.0):
            exact = S.stratified_split_exact(df, key_cols=["key"], test_share=share, seed=43)
            sides = S.stratified_sides(df, key_cols=["key"], test_share=share, seed=43)
            train, test = S.part(exact, S.TRAIN), S.part(exact, S.TEST)
            for found, wanted in ((sides.train(df), train), (sides.test(df), test)):
                assert sorted(map(str, found.collect())) == sorted(map(str, wanted.collect()))
            assert sides.train_rows == train.count()
            bound = S.part(S.bound_train(exact, 300, ["key"]), S.TRAIN)
            assert sorted(map(str, sides.train(df, 300, ["key"]).collect())) == sorted(map(str, bound.collect()))
