"""Registered queries of the point pipeline, store and query layer, each with the SQL that it must equal."""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.functions import text
from meterline.functions.dialect import DIALECTS
from meterline.operators import decode, frame, records
from meterline.plans import query as q
from meterline.plans import store
from meterline.plans.cluster import Scratch, ship
from meterline.settings import MeasurementSchema, Predicate, Settings, TagRule

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
UTC_NAIVE = {"naive_datetime": "utc", "on_invalid": "drop"}
NOW = 1_700_000_000_123_456_789


def query(sql: str | None = None):
    """Registers a function (spark, table reader) under its name, with its SQL."""

    def mark(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return fn(spark, lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))

        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLE_SQL[fn.__name__] = sql
        return fn

    return mark


def _events(t, dialect: int = 3, **options) -> DataFrame:
    s = Settings(dialect=dialect, **UTC_NAIVE)
    return frame.encode(t("events"), "events", ["event_type"], ["user_id", "value", "props"], "ts", s, keep=("event_id",), **options)


_EVENT = """concat('events,event_type=', event_type, ' user_id=', user_id, 'i,value=', value::VARCHAR, ',props="',
 replace(replace(props, '\\', '\\\\'), '"', '\\"'), '" ', epoch_us(ts) * 1000)"""


@query(f"SELECT event_id, {_EVENT} AS line FROM events")
def encode_events_v3(spark, t):
    return _events(t).select("event_id", "line")


@query(f"SELECT event_id, {_EVENT} AS line FROM events")
def encode_events_v2(spark, t):
    return _events(t, 2).select("event_id", "line")


LINEITEM = (["l_returnflag", "l_linestatus"], ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], "l_shipdate")
_LINEITEM = """concat('lineitem,l_linestatus=', l_linestatus, ',l_returnflag=', l_returnflag, ' l_quantity=', l_quantity::VARCHAR,
 ',l_extendedprice=', l_extendedprice::VARCHAR, ',l_discount=', l_discount::VARCHAR, ',l_tax=', l_tax::VARCHAR, ' ', epoch_us(l_shipdate) * 1000)"""


def _lineitem(t, **options) -> DataFrame:
    return frame.encode(t("lineitem"), "lineitem", *LINEITEM, Settings(**UTC_NAIVE), **options)


@query(f"SELECT {_LINEITEM} AS line, count(*) AS n FROM lineitem GROUP BY 1")
def encode_lineitem_sorted_tags(spark, t):
    return _lineitem(t).groupBy("line").agg(F.count("*").alias("n"))


def _orders(t, precision: str) -> DataFrame:
    s = Settings(precision=precision, **UTC_NAIVE)
    return frame.encode(t("orders"), "orders", ["o_orderpriority"], ["o_totalprice"], "o_orderdate", s, keep=("o_orderkey",)).select("o_orderkey", "line")


def _orders_sql(unit: int) -> str:
    return f"SELECT o_orderkey, concat('orders,o_orderpriority=', replace(o_orderpriority, ' ', '\\ '), ' o_totalprice=', o_totalprice::VARCHAR, ' ', epoch_us(o_orderdate) * 1000 // {unit}) AS line FROM orders"


@query(_orders_sql(10**9))
def encode_precision_s(spark, t):
    return _orders(t, "s")


@query(_orders_sql(10**6))
def encode_precision_ms(spark, t):
    return _orders(t, "ms")


@query(_orders_sql(10**3))
def encode_precision_us(spark, t):
    return _orders(t, "us")


@query(f"SELECT c_custkey, concat('customer,c_mktsegment=', c_mktsegment, ' c_name=\"', c_name, '\",c_acctbal=', c_acctbal::VARCHAR, ' {NOW}') AS line FROM customer")
def encode_untimed_fixed_now(spark, t):
    return frame.encode(t("customer"), "customer", ["c_mktsegment"], ["c_name", "c_acctbal"], settings=Settings(on_invalid="drop"), now_ns=NOW, keep=("c_custkey",)).select("c_custkey", "line")


def _escaped(t, dialect: int) -> DataFrame:
    d, c = DIALECTS[dialect], F.col("text")
    return t("documents").select("doc_id", F.md5(text.escape_measurement(c, d)).alias("measurement"), F.md5(text.escape_key(c, d)).alias("key"), F.md5(text.quoted(c)).alias("value"))


def _escaped_sql(measurement: str, key: str) -> str:
    def nest(chars: str) -> str:
        out = "text"
        for ch in chars:
            out = f"replace({out}, '{ch}', '\\{ch}')"
        return out

    return f"SELECT doc_id, md5({nest(measurement)}) AS measurement, md5({nest(key)}) AS key, md5(concat('\"', {nest(chr(92) + chr(34))}, '\"')) AS value FROM documents"


@query(_escaped_sql(", =", ",= "))
def escape_documents_v2(spark, t):
    return _escaped(t, 2)


@query(_escaped_sql("\\, ", "\\,= "))
def escape_documents_v3(spark, t):
    return _escaped(t, 3)


@query(f"SELECT count(*) AS lines, sum(strlen(l) + 1)::BIGINT AS bytes FROM (SELECT {_LINEITEM} AS l FROM lineitem)")
def line_bytes(spark, t):
    return _lineitem(t).agg(F.count("line").alias("lines"), F.sum(text.line_bytes(F.col("line"))).cast("long").alias("bytes"))


@query()
def line_checksum(spark, t):
    return store.checksum(_lineitem(t), "line")


_FAULTY = """SELECT event_id, CASE WHEN event_id % 17 = 0 THEN 'NaN'::DOUBLE WHEN event_id % 19 <> 0 THEN value END AS value,
 CASE WHEN event_id % 23 = 0 THEN concat(event_type, chr(10)) WHEN event_id % 29 <> 0 THEN event_type END AS event_type, ts FROM events"""


def _faulty(t) -> DataFrame:
    e, k = t("events"), F.col("event_id")
    value = F.when(k % 17 == 0, F.lit(float("nan"))).when(k % 19 != 0, F.col("value"))
    kind = F.when(k % 23 == 0, F.concat("event_type", F.lit("\n"))).when(k % 29 != 0, F.col("event_type"))
    s = Settings(non_finite="error", measurements={"events": MeasurementSchema(required_tags=("event_type",))}, **UTC_NAIVE)
    return frame.encode(e.select("event_id", value.alias("value"), kind.alias("event_type"), "ts"), "events", ["event_type"], ["value"], "ts", s, keep=("event_id",))


_FAULT = f"""SELECT event_id, CASE WHEN contains(event_type, chr(10)) THEN 'invalid_tag_value' WHEN event_type IS NULL THEN 'missing_tag'
 WHEN isnan(value) THEN 'non_finite' WHEN value IS NULL THEN 'no_fields' END AS code FROM ({_FAULTY})"""


@query(f"SELECT code, 'events' AS measurement, CASE code WHEN 'non_finite' THEN 'value' WHEN 'no_fields' THEN NULL ELSE 'event_type' END AS key, count(*) AS n FROM ({_FAULT}) WHERE code IS NOT NULL GROUP BY 1, 2, 3")
def reject_codes_events(spark, t):
    return frame.rejected_counts(_faulty(t), "events")


@query(f"SELECT min(event_id) AS event_id, arg_min(code, event_id) AS code FROM ({_FAULT}) WHERE code IS NOT NULL")
def reject_first_row(spark, t):
    return _faulty(t).where("reject is not null").agg(F.min("event_id").alias("event_id"), F.min_by("reject.code", "event_id").alias("code"))


@query(f"SELECT event_id, code FROM ({_FAULT}) WHERE code IS NOT NULL ORDER BY event_id LIMIT 1000")
def reject_sample_topk(spark, t):
    return frame.rejected_sample(_faulty(t), ["event_id"]).select("event_id", F.col("reject.code").alias("code"))


def _typed(df: DataFrame, measurement: str, field: str, keep: str, kind: str | None = None, **settings) -> DataFrame:
    s = Settings(on_invalid="drop", measurements={measurement: MeasurementSchema(fields={field: kind} if kind else {})}, **settings)
    return frame.encode(df, measurement, [], [field], settings=s, now_ns=0, keep=(keep,)).select(keep, "line", F.col("reject.code").alias("code"))


@query("SELECT p_partkey, concat('part p_size=', p_size::DOUBLE::VARCHAR, ' 0') AS line, NULL::VARCHAR AS code FROM part")
def coerce_int_to_float(spark, t):
    return _typed(t("part"), "part", "p_size", "p_partkey", "float")


@query("""SELECT o_orderkey, CASE WHEN x = floor(x) THEN concat('orders x=', x::BIGINT, 'i 0') END AS line,
 CASE WHEN x <> floor(x) THEN 'type_conflict' END AS code FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN floor(o_totalprice) ELSE o_totalprice END AS x FROM orders)""")
def coerce_float_to_int(spark, t):
    return _typed(t("orders").select("o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, F.floor("o_totalprice").cast("double")).otherwise(F.col("o_totalprice")).alias("x")), "orders", "x", "o_orderkey", "int")


@query("""SELECT o_orderkey, CASE WHEN abs(x) <= 9007199254740992 THEN concat('orders x=', x::DOUBLE::VARCHAR, ' 0') END AS line,
 CASE WHEN abs(x) > 9007199254740992 THEN 'out_of_range' END AS code FROM (SELECT o_orderkey, 9007199254740000 + o_orderkey AS x FROM orders)""")
def int_as_float_bounds(spark, t):
    return _typed(t("orders").select("o_orderkey", (F.col("o_orderkey") + F.lit(9007199254740000)).alias("x")), "orders", "x", "o_orderkey", int_as_float=True)


@query("""SELECT o_orderkey, concat('orders x=', (o_totalprice * m)::VARCHAR, ' 0') AS line, NULL::VARCHAR AS code
 FROM (SELECT *, CASE o_orderkey % 3 WHEN 0 THEN 1e15 WHEN 1 THEN 1e-9 ELSE -1.0 END::DOUBLE AS m FROM orders)""")
def float_text_ranges(spark, t):
    m = F.when(F.col("o_orderkey") % 3 == 0, F.lit(1e15)).when(F.col("o_orderkey") % 3 == 1, F.lit(1e-9)).otherwise(F.lit(-1.0))
    return _typed(t("orders").select("o_orderkey", (F.col("o_totalprice") * m).alias("x")), "orders", "x", "o_orderkey")


@query("SELECT CASE WHEN strlen(text) > 2000 THEN 'string_too_long' WHEN text IS NULL THEN 'no_fields' ELSE 'accepted' END AS code, count(*) AS n FROM documents GROUP BY 1")
def string_limit(spark, t):
    out = frame.encode(t("documents"), "documents", [], ["text"], settings=Settings(on_invalid="drop", max_string_bytes=2000), now_ns=0)
    return out.groupBy(F.coalesce("reject.code", F.lit("accepted")).alias("code")).agg(F.count("*").alias("n"))


@query("""SELECT CASE WHEN extra IS NOT NULL THEN 'unexpected_tag' WHEN status IS NULL THEN 'missing_tag' WHEN price IS NULL THEN 'missing_field' ELSE 'accepted' END AS code, count(*) AS n FROM (
 SELECT CASE WHEN o_orderkey % 5 = 0 THEN 'x' END AS extra, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderstatus END AS status, CASE WHEN o_orderkey % 11 <> 0 THEN o_totalprice END AS price FROM orders) GROUP BY 1""")
def required_and_closed_tags(spark, t):
    k = F.col("o_orderkey")
    df = t("orders").select(F.when(k % 5 == 0, F.lit("x")).alias("extra"), F.when(k % 7 != 0, F.col("o_orderstatus")).alias("status"), F.when(k % 11 != 0, F.col("o_totalprice")).alias("price"), k.alias("key"))
    schema = MeasurementSchema(tags=("status",), required_tags=("status",), required_fields=("price",))
    out = frame.encode(df, "orders", ["extra", "status"], ["price", "key"], settings=Settings(on_invalid="drop", measurements={"orders": schema}), now_ns=0)
    return out.groupBy(F.coalesce("reject.code", F.lit("accepted")).alias("code")).agg(F.count("*").alias("n"))


def _static(t, policy: str) -> DataFrame:
    s = Settings(on_invalid="drop", static_tags={"o_orderstatus": "F", "site": "x 1"}, conflict=policy)
    df = t("orders").select("o_orderkey", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderstatus")).alias("o_orderstatus"), "o_totalprice")
    return frame.encode(df, "orders", ["o_orderstatus"], ["o_totalprice"], settings=s, now_ns=0, keep=("o_orderkey",)).select("o_orderkey", "line", F.col("reject.code").alias("code"))


def _static_sql(status: str, clash: str = "false") -> str:
    line = f"concat('orders,o_orderstatus=', {status}, ',site=x\\ 1 o_totalprice=', o_totalprice::VARCHAR, ' 0')"
    return f"SELECT o_orderkey, CASE WHEN NOT {clash} THEN {line} END AS line, CASE WHEN {clash} THEN 'tag_conflict' END AS code FROM (SELECT o_orderkey, o_totalprice, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderstatus END AS s FROM orders)"


@query(_static_sql("coalesce(s, 'F')"))
def static_tags_keep(spark, t):
    return _static(t, "keep")


@query(_static_sql("'F'"))
def static_tags_overwrite(spark, t):
    return _static(t, "overwrite")


@query(_static_sql("coalesce(s, 'F')", "coalesce(s <> 'F', false)"))
def static_tags_error(spark, t):
    return _static(t, "error")


@query("SELECT s_suppkey, concat('supplier,kind=Supplier,number=', regexp_extract(s_name, '#0*(\\d+)$', 1), ',s_name=', s_name, ' s_acctbal=', s_acctbal::VARCHAR, ' 0') AS line FROM supplier")
def rule_regex_groups(spark, t):
    rule = TagRule(tags={"s_name": r"^(?P<kind>\w+)#0*(?P<number>\d+)$"}, set={"kind": "{kind}", "number": "{number}"})
    return frame.encode(t("supplier"), "supplier", ["s_name"], ["s_acctbal"], settings=Settings(rules=(rule,)), now_ns=0, keep=("s_suppkey",)).select("s_suppkey", "line")


@query("""SELECT count(*) AS n, band, tier FROM (SELECT CASE WHEN l_quantity >= 40 THEN 'high' WHEN l_quantity > 10 AND l_quantity < 20 THEN 'low' END AS band,
 CASE WHEN l_discount IN (0.05, 0.06) THEN 'promo' END AS tier FROM lineitem) GROUP BY band, tier""")
def rule_predicates(spark, t):
    rules = (TagRule(fields={"l_quantity": Predicate(ge=40)}, set={"band": "high"}), TagRule(fields={"l_quantity": Predicate(gt=10, lt=20)}, set={"band": "low"}), TagRule(fields={"l_discount": Predicate(in_=(0.05, 0.06))}, set={"tier": "promo"}))
    got = lambda k: F.nullif(F.regexp_extract("series", rf"{k}=(\w+)", 1), F.lit(""))
    out = frame.encode(t("lineitem"), "l", [], ["l_quantity", "l_discount"], settings=Settings(rules=rules), now_ns=0, with_series=True)
    return out.groupBy(got("band").alias("band"), got("tier").alias("tier")).agg(F.count("*").alias("n"))


@query("""SELECT doc_id, concat('labels', ',grade=', CASE quality WHEN 1 THEN 'good' ELSE 'bad' END, ',id=', doc_id, ',path=labels/', CASE quality WHEN 1 THEN 'good' ELSE 'bad' END, '-', toxic,
 ' quality=', quality, 'i,toxic=', toxic, 'i 0') AS line FROM labels""")
def rule_chain_templates(spark, t):
    rules = (
        TagRule(fields={"quality": Predicate(eq=1)}, set={"grade": "good"}),
        TagRule(missing_tags=("grade",), set={"grade": "bad"}),
        TagRule(measurement="^(?P<m>lab.*)$", has_tags=("grade",), set={"path": "{m}/{tags[grade]}-{fields[toxic]}"}),
    )
    df = t("labels").select(F.col("doc_id").alias("id"), "quality", "toxic", "doc_id")
    return frame.encode(df, "labels", ["id"], ["quality", "toxic"], settings=Settings(rules=rules), now_ns=0, keep=("doc_id",)).select("doc_id", "line")


@query(f"SELECT event_id, replace({_EVENT}, ' user_id=', concat(',shard=', user_id % 7, ' user_id=')) AS line FROM events")
def enricher_udf(spark, t):
    return _events(t, enrichers=[(lambda m, tags, fields: {"shard": int(fields["user_id"]) % 7}, ("shard",))]).select("event_id", "line")


@query("SELECT event_id, event_type, user_id, value, props, epoch_us(ts) * 1000 AS time_ns FROM events")
def decode_roundtrip_events(spark, t):
    p = decode.parse_lines(_events(t).select("event_id", "line")).withColumn("p", F.col("point"))
    p = p.select("event_id", F.col("p")["tags"]["event_type"].alias("event_type"), decode.field(F.col("p"), "user_id", "integer").cast("long").alias("user_id"), decode.field(F.col("p"), "value", "float").alias("value"), decode.field(F.col("p"), "props", "string").alias("props"), F.col("p")["time"].alias("time_ns"))
    return p


@query("SELECT page_id, url, md5(html) AS html FROM pages")
def decode_roundtrip_pages(spark, t):
    one = frame.encode(t("pages"), "pages", [], ["page_id", "url", "html"], settings=Settings(), now_ns=1)
    lines = decode.explode_lines(one.select(F.concat(F.lit("# page\n"), "line", F.lit("\r\n")).alias("value")))
    p = F.col("point")
    return decode.parse_lines(lines).select(decode.field(p, "page_id", "integer").cast("long").alias("page_id"), decode.field(p, "url", "string").alias("url"), F.md5(decode.field(p, "html", "string")).alias("html"))


@query("SELECT event_id, event_id % 3 = 2 AS runs_on FROM events")
def decode_run_on_lines(spark, t):
    good, quoted = F.lit("m f=1 1"), F.lit('m s="a b",t="c" 1')
    bad = F.lit('m s="open 1')
    line = F.element_at(F.array(good, quoted, bad), (F.col("event_id") % 3 + 1).cast("int"))
    return t("events").select("event_id", line.alias("line")).select("event_id", decode.run_on(F.col("line")).alias("runs_on"))


@query("SELECT o_orderkey, concat('o v=', o_custkey, 'i', CASE WHEN o_orderkey % 2 = 0 THEN ' 7' ELSE concat(' ', epoch_us(o_orderdate)) END) AS line FROM orders")
def stamp_untimed_lines(spark, t):
    timed = F.when(F.col("o_orderkey") % 2 == 0, F.lit("")).otherwise(F.concat(F.lit(" "), F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01', cast(o_orderdate as timestamp_ntz))").cast("string")))
    return t("orders").select("o_orderkey", F.concat(F.lit("o v="), "o_custkey", F.lit("i"), timed).alias("line")).select("o_orderkey", decode.stamp_untimed(F.col("line"), 7).alias("line"))


def _variants(t, mixed: bool) -> DataFrame:
    """The events as records, a measurement for each type; with ``mixed`` measurements "e" and "f", every third value an integer."""

    def make(r: dict) -> dict:
        name = r["event_type"] if not mixed else "e" if r["event_id"] % 2 else "f"
        value = int(r["value"]) if mixed and r["event_id"] % 3 == 0 else r["value"]
        return {"measurement": name, "tags": {"type": r["event_type"]}, "fields": {"id": r["event_id"], "v": value}, "time": r["event_id"]}

    return records.record_rows(t("events").select("event_id", "value", "event_type"), make, "event_id")


@query("""SELECT DISTINCT event_type AS measurement, k AS key, CASE k WHEN 'id' THEN 'integer' ELSE 'float' END AS kind
 FROM (SELECT event_type, unnest(['id', 'v']) AS k, value FROM events) WHERE k = 'id' OR value IS NOT NULL""")
def lock_uniform_types(spark, t):
    return records.locked_types(_variants(t, False)).select("measurement", "key", F.element_at("kinds", 1).alias("kind"))


@query("""SELECT event_id AS seq, CASE WHEN event_id % 2 = 1 OR event_id % 3 = 0 OR value = trunc(value) THEN NULL ELSE 'type_conflict' END AS code FROM events""")
def lock_mixed_fold(spark, t):
    # "f" starts with an integer, so its later fractions conflict; "e" starts with a float, so its integers are coerced
    return records.encode_records(_variants(t, True), now_ns=0).select("seq", "code")


_SYNCED = ("customer", "part", "supplier")


@query(f"""SELECT table_name, column_name, CASE WHEN data_type = 'DOUBLE' THEN 'Float64' WHEN data_type IN ('BIGINT', 'INTEGER') THEN 'Int64' ELSE 'Dictionary(Int32, Utf8)' END AS data_type,
 CASE WHEN data_type = 'DOUBLE' THEN 'float' WHEN data_type IN ('BIGINT', 'INTEGER') THEN 'integer' END AS locked
 FROM information_schema.columns WHERE table_name IN {_SYNCED} UNION ALL SELECT unnest({list(_SYNCED)}), 'time', 'Timestamp(Nanosecond, None)', NULL""")
def schema_sync_columns(spark, t):
    """Tables in a store (texts as tags), their catalog as a schema reader queries it, and the types a client locks from it."""
    from meterline.client import Client

    st = store.PointStore(spark, Scratch(spark, "synced").root)
    for name in _SYNCED:
        df = t(name)
        tags = [c for c, k in df.dtypes if k == "string"]
        st.append(df.withColumn("time_ns", F.lit(0).cast("long")), name, tags, [c for c in df.columns if c not in tags])
    client = Client(spark, store=st)
    client.sync_schema()
    locked = spark.createDataFrame([(*k, v) for k, v in client.locked_types().items()], "table_name string, column_name string, locked string")
    found = client.query("SELECT table_name, column_name, data_type FROM information_schema.columns").df
    return found.join(locked, ["table_name", "column_name"], "left")


ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
_LAST = f"arg_max({{0}}, ({', '.join(ORDER)}))"


@query(f"""SELECT l_returnflag, l_linestatus, l_shipdate, {_LAST.format('l_quantity')} AS l_quantity, {_LAST.format('l_tax')} AS l_tax FROM lineitem GROUP BY 1, 2, 3""")
def lww_lineitem(spark, t):
    return store.last_write(t("lineitem"), ["l_returnflag", "l_linestatus", "l_shipdate"], ["l_quantity", "l_tax"], F.struct(*ORDER))


@query(f"""SELECT l_returnflag, l_shipdate, {_LAST.format('l_quantity')} FILTER (l_orderkey % 2 = 0) AS a, {_LAST.format('l_tax')} FILTER (l_orderkey % 2 = 1) AS b FROM lineitem GROUP BY 1, 2""")
def lww_field_merge(spark, t):
    df = t("lineitem").select("*", F.when(F.col("l_orderkey") % 2 == 0, F.col("l_quantity")).alias("a"), F.when(F.col("l_orderkey") % 2 == 1, F.col("l_tax")).alias("b"))
    return store.last_write(df, ["l_returnflag", "l_shipdate"], ["a", "b"], F.struct(*ORDER))


@query("SELECT count(*) AS series FROM (SELECT DISTINCT l_returnflag, l_linestatus, l_shipdate FROM lineitem)")
def series_cardinality(spark, t):
    return store.series_cardinality(t("lineitem"), ["l_returnflag", "l_linestatus", "l_shipdate"], exact=True)


@query("""SELECT field, count(*) AS series, sum(n - 1)::BIGINT AS overwritten FROM (
 SELECT l_shipdate, 'l_quantity' AS field, count(*) AS n FROM lineitem GROUP BY 1 UNION ALL SELECT l_shipdate, 'l_tax', count(*) FROM lineitem WHERE l_orderkey % 3 = 0 GROUP BY 1) WHERE n > 1 GROUP BY 1""")
def untimed_overwrites(spark, t):
    df = t("lineitem").select("l_shipdate", "l_quantity", F.when(F.col("l_orderkey") % 3 == 0, F.col("l_tax")).alias("l_tax"))
    return store.untimed_overwrites(df, ["l_shipdate"], ["l_quantity", "l_tax"])


def _points(t) -> DataFrame:
    ns = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts").cast("timestamp_ntz")) * 1000
    return t("events").select("event_id", "event_type", "user_id", "value", ns.alias("time_ns"), F.timestamp_micros(F.call_function("div", ns, F.lit(1000))).alias("time"))


def _view(t) -> None:
    _points(t).createOrReplaceTempView("meterline_events")


@query("SELECT event_id, value FROM events WHERE event_type = (SELECT min(event_type) FROM events) AND value > 10")
def sql_param_filter(spark, t):
    _view(t)
    first = t("events").agg(F.min("event_type")).first()[0]
    return q.query(spark, 'SELECT event_id, value FROM "meterline_events" WHERE event_type = $kind AND value > $low', params={"kind": first, "low": 10}).df


@query("SELECT event_type, round(avg(value), 6) AS value FROM events GROUP BY event_type ORDER BY event_type LIMIT 3")
def sql_avg_group_limit(spark, t):
    _view(t)
    return q.query(spark, "SELECT event_type, round(avg(value), 6) AS value FROM meterline_events GROUP BY event_type ORDER BY event_type LIMIT 3").df


@query("SELECT event_id FROM events WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 1 HOUR")
def sql_last_hour_window(spark, t):
    _view(t)
    return q.query(spark, "SELECT event_id FROM meterline_events WHERE time > (SELECT max(time) FROM meterline_events) - interval '1 hour'").df


@query("SELECT count(*) AS n FROM events")
def sql_count(spark, t):
    _view(t)
    return q.query(spark, 'SELECT count(*) AS n FROM "meterline_events"').df


@query("SELECT event_id, value FROM events ORDER BY ts DESC, event_id DESC LIMIT 5")
def sql_order_limit(spark, t):
    _view(t)
    return q.query(spark, "SELECT event_id, value FROM meterline_events ORDER BY time DESC, event_id DESC LIMIT 5").df


@query("SELECT epoch_us(ts) AS us, value FROM events WHERE event_type = (SELECT max(event_type) FROM events)")
def influxql_select_where(spark, t):
    _view(t)
    last = t("events").agg(F.max("event_type")).first()[0]
    got = q.query(spark, 'SELECT value FROM "meterline_events" WHERE event_type = $kind', "influxql", {"kind": last}).df
    return got.select(F.unix_micros("time").alias("us"), "value")


@query("SELECT event_type, count(*) AS n, min(value) AS low FROM events GROUP BY event_type")
def influxql_aggregate(spark, t):
    _view(t)
    return q.query(spark, "SELECT event_type, count(value) AS n, min(value) AS low FROM meterline_events GROUP BY event_type", "influxql").df


def _flux(spark, t, body: str, params: dict | None = None) -> DataFrame:
    def source(_):
        return q.unpivot(_points(t), "events", ["event_id", "event_type"], ["user_id", "value"])

    return q.query(spark, 'from(bucket: "b") |> range(start: 0) ' + body, "flux", params, dialect=2, source=source, now=datetime(2100, 1, 1, tzinfo=UTC)).df


@query("SELECT event_id, event_type, user_id::DOUBLE AS user_id, value FROM events WHERE value > 50")
def flux_filter_pivot(spark, t):
    body = '|> filter(fn: (r) => r._measurement == "events") |> pivot(rowKey: ["_time"], columnKey: ["_field"], valueColumn: "_value") |> filter(fn: (r) => r.value > 50.0)'
    return _flux(spark, t, body).select("event_id", "event_type", "user_id", "value")


@query("SELECT count(*) AS _value FROM events WHERE value >= 25")
def flux_count(spark, t):
    return _flux(spark, t, '|> filter(fn: (r) => r._field == "value" and r._value >= params.low) |> group() |> count()', {"low": 25})


@query("SELECT _field, round(sum(_value), 4) AS _value FROM (SELECT 'value' AS _field, value AS _value FROM events UNION ALL SELECT 'user_id', user_id FROM events) GROUP BY 1")
def flux_group_sum(spark, t):
    return _flux(spark, t, '|> group(columns: ["_field"]) |> sum()').select("_field", F.round("_value", 4).alias("_value"))


@query("SELECT event_type, arg_max(value, ts) AS _value FROM (SELECT event_type, ts, max(value) AS value FROM events GROUP BY 1, 2) GROUP BY 1")
def flux_last(spark, t):
    df = q.unpivot(_points(t).groupBy("event_type", "time_ns").agg(F.max("value").alias("value")), "events", ["event_type"], ["value"])
    body = 'from(bucket: "b") |> range(start: 0) |> filter(fn: (r) => r._field == "value") |> group(columns: ["event_type"]) |> last()'
    return q.query(spark, body, "flux", dialect=2, source=lambda _: df, now=datetime(2100, 1, 1, tzinfo=UTC)).df.select("event_type", "_value")


@query("SELECT event_id, value AS _value FROM events WHERE event_type <> 'click'")
def flux_keep_sort(spark, t):
    return _flux(spark, t, '|> filter(fn: (r) => r._field == "value" and r.event_type != "click") |> keep(columns: ["event_id", "_value"]) |> sort(columns: ["event_id"])')


@query("SELECT upper(event_type) AS kind, count(*) AS _value FROM events GROUP BY 1")
def flux_string_upper(spark, t):
    return _flux(spark, t, '|> filter(fn: (r) => r._field == "value") |> map(fn: (r) => ({r with kind: strings.toUpper(v: r.event_type)})) |> group(columns: ["kind"]) |> count()')


@query("SELECT event_type, epoch_us(ts) * 1000 AS time_ns, arg_max(value, event_id) AS value, arg_max(user_id, event_id) AS user_id FROM events GROUP BY 1, 2")
def store_roundtrip(spark, t):
    st = store.PointStore(spark, Scratch(spark, "store").root)
    points = _points(t)
    st.append(points.where("event_id % 2 = 0"), "events", ["event_type"], ["value", "user_id"], seq="event_id", batch=0)
    st.append(points.where("event_id % 2 = 1"), "events", ["event_type"], ["value", "user_id"], seq="event_id", batch=1)
    merged = store.last_write(st.log("events"), ["event_type", "time_ns"], ["value", "user_id"], F.col("write_seq.seq"))
    return merged


@query("SELECT event_type, count(*) AS n, sum(user_id)::BIGINT AS ids FROM (SELECT event_type, ts, arg_max(user_id, event_id) AS user_id FROM events GROUP BY 1, 2) GROUP BY 1")
def stream_ingest_equals_batch(spark, t):
    from meterline.streaming.ingest import to_store

    scratch = Scratch(spark, "stream")
    points = scratch.keep(_points(t).drop("time").repartition(4), "in")
    st = store.PointStore(spark, f"{scratch.root}/store")
    stream = spark.readStream.schema(points.schema).option("maxFilesPerTrigger", 2).parquet(f"{scratch.root}/in")
    to_store(stream, st, "events", ["event_type"], ["user_id", "value"], "time_ns", f"{scratch.root}/checkpoint", "event_id").awaitTermination()
    merged = store.last_write(st.log("events"), ["event_type", "time_ns"], ["user_id"], F.col("write_seq.seq"))
    return merged.groupBy("event_type").agg(F.count("*").alias("n"), F.sum("user_id").cast("long").alias("ids"))


@query("SELECT event_type, epoch_us(ts) * 1000 AS time_ns, arg_max(value, (event_id % 3) * 1099511627776 + event_id) AS value, arg_max(user_id, (event_id % 3) * 1099511627776 + event_id) AS user_id FROM events GROUP BY 1, 2")
def store_read_in_write_order(spark, t):
    """A batch, a stream, a compaction and another batch in one store: its own ``read`` lets the later write win."""
    from meterline.streaming.ingest import to_store

    scratch = Scratch(spark, "ordered")
    points = _points(t).drop("time")
    st = store.PointStore(spark, f"{scratch.root}/store")
    columns = ("events", ["event_type"], ["value", "user_id"])
    st.append(points.where("event_id % 3 = 0"), *columns, seq="event_id")
    middle = scratch.keep(points.where("event_id % 3 = 1").repartition(4), "in")
    stream = spark.readStream.schema(middle.schema).parquet(f"{scratch.root}/in")
    to_store(stream, st, *columns, "time_ns", f"{scratch.root}/checkpoint", "event_id").awaitTermination()
    st.compact("events")
    st.append(points.where("event_id % 3 = 2"), *columns, seq="event_id")
    return st.read("events").select("event_type", "time_ns", "value", "user_id")


@query("SELECT n_name, count(*) AS n, (sum(o_totalprice) * 100)::BIGINT AS cents FROM (SELECT n_name, o_totalprice::DECIMAL(18,2) AS o_totalprice FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey) GROUP BY n_name")
def sql_join(spark, t):
    for n in ("orders", "customer", "nation"):
        t(n).createOrReplaceTempView(f"meterline_{n}")
    sql = "SELECT n_name, count(*) AS n, cast(sum(p) * 100 AS bigint) AS cents FROM (SELECT n_name, cast(o_totalprice AS decimal(18,2)) AS p FROM meterline_orders JOIN meterline_customer ON c_custkey = o_custkey JOIN meterline_nation ON n_nationkey = c_nationkey) GROUP BY n_name"
    return q.query(spark, sql).df


@query("SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS r FROM orders")
def sql_window(spark, t):
    t("orders").createOrReplaceTempView("meterline_orders")
    return q.query(spark, "SELECT o_orderkey, cast(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS bigint) AS r FROM meterline_orders").df


@query("SELECT n_name AS name FROM nation UNION SELECT r_name FROM region EXCEPT SELECT 'ASIA'")
def sql_union(spark, t):
    for n in ("nation", "region"):
        t(n).createOrReplaceTempView(f"meterline_{n}")
    return q.query(spark, "(SELECT n_name AS name FROM meterline_nation UNION SELECT r_name FROM meterline_region) EXCEPT SELECT 'ASIA'").df


@query("SELECT l_returnflag, l_linestatus, sum(l_quantity)::BIGINT AS sum_qty, count(*) AS n FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)")
def sql_rollup(spark, t):
    t("lineitem").createOrReplaceTempView("meterline_lineitem")
    return q.query(spark, "SELECT l_returnflag, l_linestatus, cast(sum(l_quantity) AS bigint) AS sum_qty, count(*) AS n FROM meterline_lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)").df
