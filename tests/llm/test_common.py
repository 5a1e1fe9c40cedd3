import threading

from claimloom.llm import common


def test_runs_side_by_side_keep_their_folders(spark):
    """Two runs in threads of one driver: the one that ends first takes its own tables alone."""
    begun, ended, out = threading.Event(), threading.Event(), {}

    def long_run():
        with common.scratch(spark):
            out["first"] = common.written(spark.range(5), "a")
            begun.set()
            ended.wait(60)
            out["second"] = common.written(spark.range(7), "b")
            out["counts"] = out["first"].count(), out["second"].count()

    run = threading.Thread(target=long_run)
    run.start()
    assert begun.wait(60)
    with common.scratch(spark):
        inner = common.written(spark.range(3), "c")
        with common.scratch(spark):
            common.written(spark.range(1), "d")
        assert inner.count() == 3
    ended.set()
    run.join()
    assert out["counts"] == (5, 7)


def test_sieves_of_awkward_values(spark):
    values = spark.createDataFrame([("a",), ("a",), (None,), ("",)], "k string")
    rows = spark.createDataFrame([("a",), ("",), (None,), ("b",), ("c" * 10000,)], "k string").withColumn("bits", common.F.lit(1))
    got = [r.maybe for r in common.sifted(rows, "k", common.sieve(values, "k")).collect()]
    assert got[:3] == [True, True, True] and not any(got[3:])
    assert not any(r.maybe for r in common.sifted(rows, "k", common.sieve(values.limit(0), "k")).collect())
