import itertools

import pytest
from pyspark.sql import functions as F

from claimloom import catalogue
from claimloom.functions import url as U

PARTS = ["/fit-in/", "/FIT-IN/", "640x", "320X4", "/1200", "-500w", "?w=9", "&Width=", "7", "/W80", "/", ".jpg", "\n"]


@pytest.mark.parametrize("ladder", sorted(U.WIDTH_LADDERS))
def test_parts_leave_out_no_match(spark, ladder):
    urls = spark.createDataFrame([("https://h" + "".join(p),) for n in range(4) for p in itertools.product(PARTS, repeat=n)] + [(None,)], "u string")
    low = F.lower(F.coalesce("u", F.lit("")))
    searched = F.coalesce(*[F.nullif(F.regexp_extract(low, p, 1), F.lit("")) for _, p in U.WIDTH_LADDERS[ladder]], F.lit("0")).cast("int")
    assert urls.where(searched > 0).count() > 20
    assert urls.where(~U.width(F.col("u"), ladder).eqNullSafe(searched)).count() == 0


def test_a_url_is_read_once(spark, tmp_path, capsys):
    """Rows that hold one url keep a row each for each shape, nulls too; no url rule stands where rows are not distinct."""
    rows = [(1, 1, 7, 3.0), (1, 2, 7, 3.0), (2, 1, None, 3.0), (3, 1, 7, None), (3, 1, None, None), (3, 2, None, None)]
    schema = "l_orderkey long, l_linenumber int, l_suppkey long, l_quantity double"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/lineitem.parquet")
    own = catalogue.queries()["q_width_ladders"](spark, str(tmp_path))
    own.explain()
    plan = [line.lstrip(" :+-") for line in capsys.readouterr().out.splitlines()]
    reading = [i for i, line in enumerate(plan) if "regexp" in line]
    assert reading and all(next(line for line in plan[i:] if not line.startswith(("Project", "*"))).startswith("HashAggregate(keys=[parts") for i in reading)
    got = own.collect()
    assert sorted((r.l_orderkey, r.l_linenumber, r.shape) for r in got) == sorted((o, n, s) for o, n, _, _ in rows for s in catalogue.LADDERS)
    assert {(r.w, r.asset, r.largest) for r in got if r.l_orderkey == 1 and r.shape == "rtl"} == {(60, "https://h/img/1/2/slug-7/x.jpg", 77)}
    assert {(r.w, r.asset, r.largest) for r in got if r.l_orderkey == 2} == {(0, "", 77)}
    assert {(r.w, r.asset, r.largest) for r in got if r.l_orderkey == 3} == {(0, "", 0)}
