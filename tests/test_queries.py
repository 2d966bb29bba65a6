import pytest
from oracle import same

from meterline import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_against_sql(spark, name):
    same(queries.QUERIES[name](spark, SF), queries.ORACLE_SQL[name], SF)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 1000
    assert set(e.oracle_sql()) <= set(e.queries())


def test_checksum_ignores_order(spark):
    from meterline.plans.store import checksum

    a = spark.range(1000).selectExpr("cast(id as string) as x")
    assert checksum(a, "x").first() == checksum(a.orderBy("x", ascending=False).repartition(7), "x").first()
