from critiq.session import scale_conf


def test_scale_conf_partition_sizing():
    tib = 1024 ** 4
    big = scale_conf(15 * tib, cores=8000)
    assert int(big["spark.sql.shuffle.partitions"]) == 61440        # 15 TiB / 256 MiB
    assert int(scale_conf(10 ** 6, cores=8)["spark.sql.shuffle.partitions"]) == 16   # at least 2 per core
    assert int(scale_conf(10 ** 15 * 50, cores=8)["spark.sql.shuffle.partitions"]) == 100_000


def test_materialized_frames_do_not_carry_growing_estimates(spark):
    from critiq.session import materialize

    def digits(df):
        return len(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))

    rows = spark.range(20).selectExpr("id as k", "array(cast(id as string), null) as v", "if(id = 3, null, id) as n")
    kept = materialize(rows)
    want = sorted(map(tuple, rows.collect()), key=str)
    assert kept.schema == rows.schema
    for _ in range(6):
        kept = materialize(kept.join(kept.select("k"), "k"))
        assert digits(kept) <= 20
    assert sorted(map(tuple, kept.collect()), key=str) == want


def test_materialized_rows_survive_the_collection_of_other_frames(spark):
    import gc

    from critiq.session import materialize

    kept = materialize(spark.range(100))
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    assert kept.count() == 100 and kept.where("id < 7").count() == 7
