"""Inputs of the registered queries, derived from the test tables.

The tables hold no change messages, topics or catalogs, so these are built from `orders`,
`events`, `lineitem` and `customer` by fixed rules. The check SQL builds the same ones.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from changelake.functions.positions import format_lsn
from changelake.functions.types import Field
from changelake.operators.changes import MESSAGE_SCHEMA
from changelake.session import small_frame, use_utc

INGEST_TS = datetime.datetime(2024, 6, 1, tzinfo=datetime.timezone.utc)
INGEST_MICROS = 1717200000000000

# Type names dealt out to columns by row number, with edge cases at the end.
DEALT_TYPES = [
    "smallint", "int2", "integer", "int4", "bigint", "int8", "serial", "bigserial", "real",
    "float4", "double precision", "float8", "boolean", "bool", "text", "varchar",
    "character varying", "char", "character", "name", "bytea", "date", "time",
    "time without time zone", "time with time zone", "timetz", "timestamp",
    "timestamp without time zone", "timestamp with time zone", "timestamptz", "numeric",
    "decimal", "json", "jsonb", "uuid", "_int4", "text[]", "interval", "point", "int4range",
    "inet", " INTEGER ", "mydouble", "xbool", "my_timestamp", "daterange", "timespan",
    "numeric(10,2)", "USER-DEFINED", "ARRAY",
]

PAYLOAD = [Field("k", "INT64")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    use_utc(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ingest_ts() -> Column:
    return F.lit(INGEST_TS)


def topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as messages of one topic with four partitions.

    The offset is the event id: unique and ascending in each partition, with gaps as in a
    compacted topic.
    """
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("key"),
        F.col("props").alias("value"),
        F.lit("events").alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def dirty_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same topic with payloads of every kind that is not plain."""
    digit = F.col("offset") % 10
    bad = {
        0: F.lit(None).cast("string"),
        1: F.lit(""),
        2: F.lit("not json"),
        3: F.lit('{"k": "12"}'),
        4: F.lit('{"k": null}'),
        5: F.lit('{"other": 1}'),
        6: F.lit("[1]"),
        7: F.lit('{"k": 3.7}'),
    }
    value = F.col("value")
    for n, payload in bad.items():
        value = F.when(digit == n, payload).otherwise(value)
    return topic(spark, sf_dir).withColumn("value", value)


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a change stream: one transaction of one change per order.

    BEGIN, change and COMMIT of order n have seq 4n, 4n+1 and 4n+2; the last order's
    transaction stays open. Three tables share the orders; the third is never announced.
    """
    orders = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    last = orders.agg(F.max("o_orderkey").alias("last")).scalar()
    kind = F.when(F.col("o_orderstatus") == "O", "I").when(F.col("o_orderstatus") == "P", "U")
    kind = kind.otherwise("D")
    custkey_kind = F.when(key % 7 == 0, "n").when(key % 11 == 0, "u").otherwise("t")

    def item(kind: Column, text: Column) -> Column:
        return F.struct(kind.alias("kind"), F.when(kind == "t", text).alias("text"))

    t = F.lit("t")
    key_item = item(t, key.cast("string"))
    whole = F.array(
        key_item,
        item(custkey_kind, F.col("o_custkey").cast("string")),
        item(t, F.col("o_orderstatus")),
    )

    def message(seq: Column, letter: Column | str, **values: Column) -> list[Column]:
        values |= {
            "stream_id": F.lit("s1"),
            "seq": seq,
            "lsn": lsn_text(key),
            "msg_type": F.lit(letter) if isinstance(letter, str) else letter,
            "xid": key,
            "ts": F.col("o_orderdate").cast("timestamp"),
        }
        return [
            values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in MESSAGE_SCHEMA.fields
        ]

    change = message(
        key * 4 + 1,
        kind,
        rel_oid=key % 3 + 16384,
        new_tuple=F.when(kind != "D", whole),
        old_tuple=F.when(kind == "U", F.array(key_item)).when(kind == "D", whole),
    )
    # One branch per message type: a filter on the type drops the other branches, as it would
    # skip the row groups of a landed log.
    return (
        orders.select(change)
        .unionByName(orders.select(message(key * 4, "B")))
        .unionByName(orders.filter(key < last).select(message(key * 4 + 2, "C")))
        .unionByName(orders.filter(key == last).select(message(key * 4 + 6, "T")))
        .unionByName(orders.filter(key == last).select(message(key * 4 + 7, "Y")))
        .unionByName(relations(spark), allowMissingColumns=True)
    )


def relations(spark: SparkSession) -> DataFrame:
    """The announcements of two tables, one of them changed later on."""
    return small_frame(
        spark,
        [
            ("s1", -2, "R", 16384, "shop", "orders_a", ["o_orderkey", "o_custkey", "o_orderstatus"]),
            ("s1", -1, "R", 16385, "shop", "orders_b", ["o_orderkey", "o_custkey"]),
            ("s1", 4003, "R", 16384, "shop", "orders_a", ["o_orderkey", "o_custkey", "status"]),
        ],
        "stream_id string, seq bigint, msg_type string, rel_oid bigint, rel_namespace string, "
        "rel_table string, rel_columns array<string>",
    )


def many_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of `changes`, with a table announced anew after every pending order."""
    orders = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "P")
    key = F.col("o_orderkey")
    announced = orders.select(
        F.lit("s1").alias("stream_id"),
        (key * 4 + 3).alias("seq"),
        F.lit("R").alias("msg_type"),
        (F.col("o_custkey") % 3 + 16384).alias("rel_oid"),
        F.lit("shop").alias("rel_namespace"),
        F.concat(F.lit("v_"), key.cast("string")).alias("rel_table"),
        F.array(F.concat(F.lit("c_"), key.cast("string"))).alias("rel_columns"),
    )
    log = changes(spark, sf_dir).filter(F.col("msg_type") != "R")
    return log.unionByName(announced, allowMissingColumns=True)


ACCOUNTS = [Field("id", "INT64"), Field("status", "STRING"), Field("price", "DECIMAL"), Field("note", "STRING")]


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as the history of their customers' rows in one table, `shop.accounts`: (n, customer, op, id, old_id, note_kind, others).

    Each order is one change. Every tenth deletes the row, the next one of the customer inserts it again; after a third of the orders the
    table is truncated. Every 13th update moves the row between the customer's number and its negative. Updates mostly leave the note unchanged.
    """
    orders = table(spark, sf_dir, "orders")
    n = F.col("o_orderkey")
    cut = orders.agg(F.expr("max(o_orderkey) div 3L")).scalar()
    of_row = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    rows = orders.withColumns({"epoch": (n > cut).cast("int"), "gone": n % 10 == 0})
    before = F.lag(F.struct("epoch", "gone")).over(of_row)
    fresh = before.isNull() | before["gone"] | (before["epoch"] != F.col("epoch"))
    rows = rows.withColumn("op", F.when(fresh, "I").when(F.col("gone"), "D").otherwise("U"))
    # A row that is to be deleted but isn't there is inserted, and then counts as not deleted.
    rows = rows.withColumn("op", F.when(fresh & F.col("gone"), "I").otherwise(F.col("op")))
    rows = rows.withColumn("flips", ((F.col("op") == "U") & (n % 13 == 0)).cast("int"))
    upto = of_row.rowsBetween(Window.unboundedPreceding, 0)
    life = F.sum((F.col("op") == "I").cast("int")).over(upto)
    rows = rows.withColumn("life", life)
    of_life = Window.partitionBy("o_custkey", "life").orderBy("o_orderkey").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("flipped", F.sum("flips").over(of_life))
    sign = lambda k: F.when(k % 2 == 1, -1).otherwise(1)
    return rows.select(
        n.alias("n"), F.col("o_custkey").alias("customer"), "op",
        (F.col("o_custkey") * sign(F.col("flipped"))).alias("id"),
        (F.col("o_custkey") * sign(F.col("flipped") - F.col("flips"))).alias("old_id"),
        F.when((F.col("op") == "U") & (n % 3 != 0), "u").when(n % 7 == 0, "n").otherwise("t").alias("note_kind"),
        F.col("o_orderstatus").alias("status"), F.col("o_totalprice").cast("decimal(12,2)").alias("price"),
        F.concat(F.col("o_orderpriority"), F.lit("/"), n.cast("string")).alias("note"), (n == cut).alias("truncates"),
    )


def account_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`accounts` as change messages: BEGIN, change, COMMIT (and the TRUNCATE) of order n have seq 4n, 4n+1, 4n+3 (and 4n+2); the last one stays open."""
    rows = accounts(spark, sf_dir).withColumn("o_orderkey", F.col("n"))
    last = table(spark, sf_dir, "orders").agg(F.max("o_orderkey")).scalar()
    n = F.col("n")

    def item(kind: Column | str, text: Column) -> Column:
        kind = F.lit(kind) if isinstance(kind, str) else kind
        return F.struct(kind.alias("kind"), F.when(kind == "t", text).alias("text"))

    new = F.array(
        item("t", F.col("id").cast("string")), item("t", F.col("status")), item("t", F.col("price").cast("string")), item(F.col("note_kind"), F.col("note"))
    )
    null = item("n", F.lit(None).cast("string"))
    old = F.array(item("t", F.col("old_id").cast("string")), null, null, null)
    has_old = (F.col("op") == "D") | ((F.col("op") == "U") & ((F.col("id") != F.col("old_id")) | (n % 2 == 0)))

    def message(seq: Column, letter: Column | str, **values: Column) -> list[Column]:
        values |= {
            "stream_id": F.lit("s1"), "seq": seq, "lsn": account_lsn(n), "msg_type": F.lit(letter) if isinstance(letter, str) else letter, "xid": n,
        }
        return [values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in MESSAGE_SCHEMA.fields]

    oid = F.lit(16400)
    announced = small_frame(
        spark, [("s1", -1, "R", 16400, "shop", "accounts", [f.name for f in ACCOUNTS])],
        "stream_id string, seq bigint, msg_type string, rel_oid bigint, rel_namespace string, rel_table string, rel_columns array<string>",
    )
    change = message(n * 4 + 1, F.col("op"), rel_oid=oid, new_tuple=F.when(F.col("op") != "D", new), old_tuple=F.when(has_old, old))
    return (
        rows.select(change)
        .unionByName(rows.select(message(n * 4, "B")))
        .unionByName(rows.filter(n < last).select(message(n * 4 + 3, "C")))
        .unionByName(rows.filter("truncates").select(message(n * 4 + 2, "T", rel_oid=oid)))
        .unionByName(announced, allowMissingColumns=True)
    )


def account_position(n: Column) -> Column:
    """Commit position of an account's order. Ascends with the orders, as in any stream; that of `lsn_text` wraps among every 65,536th."""
    return F.floor(n / 256) * 4294967296 + n % 256 * 65537


def account_lsn(n: Column) -> Column:
    return format_lsn(account_position(n))


def lsn_text(key: Column) -> Column:
    low = (key * 65537) % 4294967296
    return F.concat_ws("/", F.hex(F.expr("o_orderkey div 256")), F.hex(low))


def targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables to capture: all that were announced under a name with an `a`, plus one unknown."""
    return small_frame(
        spark, [("shop.orders_a",), ("unknown.16386",)], "table_name string"
    )


def information_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as the columns of tables, one table per order."""
    line = table(spark, sf_dir, "lineitem")
    dealt = F.col("l_partkey") % len(DEALT_TYPES)
    names = F.array(*[F.lit(n) for n in DEALT_TYPES])
    prefix = (
        F.when(F.col("l_orderkey") % 10 == 0, "pg_").when(F.col("l_orderkey") % 10 == 1, "sql_")
        .otherwise("t_")
    )
    return line.select(
        F.when(F.col("l_orderkey") % 5 == 4, "audit").otherwise("public").alias("table_schema"),
        F.concat(prefix, F.col("l_orderkey").cast("string")).alias("table_name"),
        column_name().alias("column_name"),
        F.get(names, dealt.cast("int")).alias("data_type"),
        F.when(F.col("l_suppkey") % 2 == 0, "_int4").otherwise("numeric").alias("udt_name"),
        F.when(F.col("l_returnflag") == "N", "NO").otherwise("YES").alias("is_nullable"),
        F.col("l_linenumber").alias("ordinal_position"),
    )


def column_name() -> Column:
    return F.concat_ws(
        "_", F.lit("c"), F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey")
    )


def table_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    prefix = (
        F.when(F.col("o_orderkey") % 10 == 0, "pg_").when(F.col("o_orderkey") % 10 == 1, "sql_")
        .otherwise("t_")
    )
    return orders.select(
        F.concat(F.lit("k_"), F.col("o_orderkey").cast("string")).alias("constraint_name"),
        F.when(F.col("o_orderkey") % 5 == 4, "audit").otherwise("public").alias("table_schema"),
        F.concat(prefix, F.col("o_orderkey").cast("string")).alias("table_name"),
        F.when(F.col("o_orderstatus") == "O", "UNIQUE").otherwise("PRIMARY KEY").alias(
            "constraint_type"
        ),
    )


def key_column_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line number 1 is each table's key."""
    line = table(spark, sf_dir, "lineitem").filter(F.col("l_linenumber") == 1)
    return line.select(
        F.concat(F.lit("k_"), F.col("l_orderkey").cast("string")).alias("constraint_name"),
        F.when(F.col("l_orderkey") % 5 == 4, "audit").otherwise("public").alias("table_schema"),
        column_name().alias("column_name"),
    )


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as streams of a catalog, with every kind of mode and destination."""
    key = F.col("c_custkey")
    modes = {0: "full_load", 1: "cdc", 2: "full_load+cdc", 3: "CDC", 4: "mirror"}
    mode = F.lit(None).cast("string")
    for n, text in modes.items():
        mode = F.when(key % 6 == n, text).otherwise(mode)
    dotted = F.concat_ws(".", F.lit("public"), F.lower(F.col("c_mktsegment")), key.cast("string"))
    plain = F.concat(F.lit("cust_"), key.cast("string"))
    return table(spark, sf_dir, "customer").select(
        F.when(key % 4 == 3, plain).otherwise(dotted).alias("table"),
        mode.alias("sync_mode"),
        F.when(key % 3 == 0, F.concat(F.lit("dest_"), key.cast("string")))
        .when(key % 3 == 1, "").alias("destination_table"),
    )


def catalog_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Progress of the streams of customers that have orders; done when none is pending."""
    streams = catalog(spark, sf_dir).select(
        F.col("table").alias("stream_id"),
        F.regexp_extract("table", r"(\d+)$", 1).cast("bigint").alias("custkey"),
    )
    per_customer = table(spark, sf_dir, "orders").groupBy(
        F.col("o_custkey").alias("custkey")
    ).agg(F.bool_and(F.col("o_orderstatus") != "P").alias("full_load_completed"))
    return streams.join(per_customer, "custkey").select("stream_id", "full_load_completed")


def versioned_orders(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders as row changes at place 2n for order n, and the announcements of their table, which changes twice.

    From a third of the keys on a price is there and the key is wider; from two thirds on the date has a time, the customer is text and the status is
    gone. In between the second announcement comes again. Every 13th price is malformed, every fifth change a DELETE.
    """
    orders, key = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    last = F.max("o_orderkey")
    text = {
        "o_orderkey": key.cast("string"),
        "o_custkey": F.col("o_custkey").cast("string"),
        "o_totalprice": F.when(key % 13 == 0, "n/a").otherwise(F.col("o_totalprice").cast("string")),
        "o_orderstatus": F.col("o_orderstatus"),
    }
    day, time = F.date_format("o_orderdate", "yyyy-MM-dd"), F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    first = [("o_orderkey", "int4"), ("o_custkey", "int4"), ("o_orderdate", "date"), ("o_orderstatus", "text")]
    second = [("o_orderkey", "bigint"), ("o_custkey", "int4"), ("o_totalprice", "double precision"), ("o_orderdate", "date"), ("o_orderstatus", "text")]
    third = [("o_orderkey", "bigint"), ("o_orderdate", "timestamp"), ("o_custkey", "varchar"), ("o_totalprice", "double precision")]

    def values(version: list[tuple[str, str]], date: Column) -> Column:
        items = [(text | {"o_orderdate": date})[name] for name, _ in version]
        return F.array(*[F.struct(F.lit("t").alias("kind"), i.alias("text")) for i in items])

    m = orders.agg(last).scalar()
    row = F.when(key <= F.floor(m / 3), values(first, day)).when(key <= F.floor(m * 2 / 3), values(second, day)).otherwise(values(third, time))
    kind = F.when(key % 5 == 0, "D").otherwise("U")
    changes = orders.select(
        F.lit("s1").alias("stream_id"), (key * 2).alias("seq"), kind.alias("msg_type"), F.lit(16384).cast("bigint").alias("rel_oid"),
        F.when(kind == "D", row).alias("old_tuple"), F.when(kind == "U", row).alias("new_tuple"),
    )
    at = [F.lit(-1), F.floor(last / 3) * 2 + 1, F.floor(last / 2) * 2 + 1, F.floor(last * 2 / 3) * 2 + 1]
    told = F.array(*[
        F.struct(
            seq.cast("bigint").alias("seq"), F.array(*[F.lit(n) for n, _ in v]).alias("rel_columns"), F.array(*[F.lit(t) for _, t in v]).alias("rel_types"),
        )
        for seq, v in zip(at, (first, second, second, third))
    ])
    relations = orders.agg(told.alias("told")).select(
        F.lit("s1").alias("stream_id"), F.lit(16384).cast("bigint").alias("rel_oid"), F.lit("shop").alias("rel_namespace"), F.lit("orders").alias("rel_table"),
        F.explode("told").alias("r"),
    ).select("*", "r.*").drop("r")
    return changes, relations
