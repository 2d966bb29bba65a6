"""The point store: order of writes over batches, streams, replays and compactions; queries over it."""

import random

import pytest
from pyspark.sql import functions as F

from meterline import Client, PointStore, QueryError, Settings
from meterline.functions import text
from meterline.functions.dialect import runs_on
from meterline.plans import query as q
from meterline.streaming.ingest import to_store

SCHEMA = "host string, v double, time_ns long"


def values(st):
    return {(r["host"], r["time_ns"]): r["v"] for r in st.read("cpu").collect()}


def test_later_writes_win(spark, tmp_path):
    st = PointStore(spark, str(tmp_path / "s"))
    put = lambda *rows, **k: st.append(spark.createDataFrame(rows, SCHEMA), "cpu", ["host"], ["v"], **k)
    put(("a", 1.0, 1), ("b", 1.0, 1))
    put(("a", 2.0, 1), batch=0, writer="s1")
    put(("c", 3.0, 1), batch=0, writer="s2")  # another stream's batch 0 replaces nothing
    assert values(st) == {("a", 1): 2.0, ("b", 1): 1.0, ("c", 1): 3.0}
    put(("a", 4.0, 1))
    put(("a", 2.0, 1), ("d", 2.0, 1), batch=0, writer="s1")  # a replay keeps its place
    assert values(st) == {("a", 1): 4.0, ("b", 1): 1.0, ("c", 1): 3.0, ("d", 1): 2.0}
    st.compact("cpu")
    put(("a", 2.0, 1), ("d", 2.0, 1), batch=0, writer="s1")  # also after a compaction
    assert values(st) == {("a", 1): 4.0, ("b", 1): 1.0, ("c", 1): 3.0, ("d", 1): 2.0}
    put(("d", 9.0, 1))
    assert values(st)["d", 1] == 9.0


def test_stream_adds_to_a_store(spark, tmp_path):
    st = PointStore(spark, str(tmp_path / "s"))
    st.append(spark.createDataFrame([("old", 1.0, 1)], SCHEMA), "cpu", ["host"], ["v"])
    for name in "xy":
        spark.createDataFrame([(name, 2.0, 1)], SCHEMA).write.parquet(str(tmp_path / name))
        stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / name))
        to_store(stream, st, "cpu", ["host"], ["v"], "time_ns", str(tmp_path / f"c{name}")).awaitTermination()
    assert values(st) == {("old", 1): 1.0, ("x", 1): 2.0, ("y", 1): 2.0}


def test_queries_over_a_store(spark, tmp_path):
    st = PointStore(spark, str(tmp_path / "s"))
    st.append(spark.createDataFrame([("a", 1.0, 10), ("b", 2.0, 10), ("a", 3.0, 20)], SCHEMA), "cpu", ["host"], ["v"])
    st.append(spark.createDataFrame([("a", 9.0, 10)], SCHEMA), "cpu", ["host"], ["v"])
    c = Client(spark, Settings(), store=st)
    assert c.query('SELECT host, v FROM "cpu" WHERE host = $h ORDER BY time_ns', params={"h": "a"}).dicts() == [{"host": "a", "v": 9.0}, {"host": "a", "v": 3.0}]
    assert c.query("SELECT column_name FROM information_schema.columns ORDER BY 1").dicts()[0] == {"column_name": "host"}
    assert c.sync_schema() == 1
    for bad, kind in (("SELEC 1", "syntax"), ("SELECT * FROM nowhere", "not_found")):
        with pytest.raises(QueryError) as e:
            c.query(bad)
        assert e.value.kind == kind


def test_flux_sort_then_limit(spark, tmp_path):
    st = PointStore(spark, str(tmp_path / "s"))
    st.append(spark.createDataFrame([("a", 5.0, 1), ("a", 9.0, 2), ("a", 1.0, 3), ("b", 4.0, 1), ("b", 7.0, 2)], SCHEMA), "cpu", ["host"], ["v"])
    c = Client(spark, Settings(dialect=2), store=st)
    ask = lambda tail: sorted(r["_value"] for r in c.query(f'from(bucket: "x") |> range(start: 0) |> {tail}', "flux").dicts())
    assert ask('sort(columns: ["_value"], desc: true) |> limit(n: 1)') == [7.0, 9.0]
    assert ask('sort(columns: ["_value"]) |> limit(n: 1)') == [1.0, 4.0]
    assert ask("limit(n: 1)") == [4.0, 5.0]


def test_flux_literals():
    from datetime import UTC, datetime, timedelta

    assert q.flux_literal({"a": [True, -4, "x${y}\n\"\\"], "t": datetime(2030, 2, 3, 4, 5, 6, 70, tzinfo=UTC), "d": timedelta(days=1, microseconds=5)}) == '{a: [true, -4, "x\\${y}\\n\\"\\\\"], t: 2030-02-03T04:05:06.000070000Z, d: 86400000005us}'
    assert q.flux_literal(0.25) == 'float(v: "0.25")'
    for bad in (float("inf"), {"1": 2}, object(), datetime(2030, 1, 1)):
        with pytest.raises(ValueError):
            q.flux_literal(bad)


def scanned(line):
    """The same question one character at a time."""
    at, fields, inside, surplus = 0, False, False, 0
    while at < len(line):
        c = line[at]
        if c == "\\":
            if at + 1 == len(line):
                return True
            at += 2
            continue
        if c == "\n" and not inside:
            return True
        if not fields:
            fields = c == " "
        elif c == '"':
            inside = not inside and surplus > 0
        elif not inside:
            surplus += (c == "=") - (c == ",")
        at += 1
    return inside


def test_run_on_lines(spark):
    r = random.Random(5)
    lines = ["".join(r.choice('ab=," \\\n') for _ in range(r.randint(0, 14))) for _ in range(4000)]
    want = [scanned(x) for x in lines]
    assert [runs_on(x) for x in lines] == want
    df = spark.createDataFrame(list(enumerate(lines)), "i int, x string")
    assert [x["on"] for x in df.select("i", text.runs_on(F.col("x")).alias("on")).orderBy("i").collect()] == want


def test_float_text_is_pythons(spark):
    r = random.Random(6)
    import struct

    values = [struct.unpack("d", r.randbytes(8))[0] for _ in range(4000)] + [r.uniform(-1, 1) * 10 ** r.randint(-8, 30) for _ in range(4000)] + [s * 2.0**k for k in range(-1074, 1024, 3) for s in (1, -1)] + [float(f"{s}1e{k}") for k in range(-323, 309) for s in ("", "-")] + [0.0, -0.0, 2.0**53 + 2, 123456789.125]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values) if v == v], "i int, v double")
    got = df.select("v", text.float_text(F.col("v")).alias("t"))
    assert "Python" not in got._jdf.queryExecution().executedPlan().toString()
    assert [(repr(x["v"]), x["t"]) for x in got.collect() if repr(x["v"]) != x["t"]] == []
