"""Messages made from the base tables, with known kinds of defects.

The SQL fragments are valid in Spark and DuckDB alike, so a test can show both engines the same
messages. Which defect a message has follows from a remainder of its id (see each fragment).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.envelope import to_envelope

# User records by event_id % 20: 0 no JSON, 1 no value, 2 field absent, 3 nulls, 4 id as text, 5 id beyond
# int, 6 fraction, 7 cut off, 8 array, 9 wrong types, 10 no key, 11 nested object, 12 empty object, else good.
USER_KEY = "CASE WHEN event_id % 20 = 10 THEN NULL ELSE CAST(user_id AS STRING) END"
USER_VALUE = """
CASE event_id % 20
 WHEN 0 THEN 'not json'
 WHEN 1 THEN NULL
 WHEN 2 THEN concat('{"id":', CAST(event_id AS STRING), ',"name":"', event_type, '"}')
 WHEN 3 THEN '{"id":null,"name":null,"age":null}'
 WHEN 4 THEN concat('{"id":"', CAST(event_id AS STRING), '","name":"', event_type, '","age":7}')
 WHEN 5 THEN '{"id":99999999999,"name":"big","age":1}'
 WHEN 6 THEN concat('{"id":', CAST(event_id AS STRING), ',"name":"', event_type, '","age":2.5}')
 WHEN 7 THEN concat('{"id":', CAST(event_id AS STRING), ',"name":"', event_type)
 WHEN 8 THEN concat('[{"id":', CAST(event_id AS STRING), ',"name":"a","age":1},{"id":0,"name":"b","age":2}]')
 WHEN 9 THEN concat('{"id":', CAST(event_id AS STRING), ',"name":7,"age":true}')
 WHEN 11 THEN concat('{"id":', CAST(event_id AS STRING), ',"name":"', event_type, '","age":',
   CAST(user_id AS STRING), ',"specs":{"v":', CAST(value AS STRING), ',"at":"2024-03-22T14:35:00Z"}}')
 WHEN 12 THEN '{}'
 ELSE concat('{"id":', CAST(event_id AS STRING), ',"name":"', event_type, '","age":', CAST(user_id AS STRING), '}')
END"""

# Records with all three fields; id and name take every JSON type, by event_id % 16.
COERCION_VALUE = """
concat('{"id":', CASE event_id % 16
 WHEN 1 THEN '99999999999'
 WHEN 2 THEN '2.7'
 WHEN 3 THEN concat('"', CAST(event_id AS STRING), '"')
 WHEN 4 THEN '" 7 "'
 WHEN 5 THEN '"2.7"'
 WHEN 6 THEN '"x"'
 WHEN 7 THEN 'true'
 WHEN 8 THEN 'null'
 WHEN 9 THEN '{"a":1}'
 WHEN 10 THEN '[1]'
 WHEN 11 THEN '12345678901234567890123'
 WHEN 12 THEN '1e20'
 WHEN 13 THEN '-1e20'
 WHEN 14 THEN '"99999999999"'
 WHEN 15 THEN '""'
 ELSE CAST(event_id AS STRING) END,
 ',"name":', CASE event_id % 16
 WHEN 1 THEN CAST(event_id AS STRING)
 WHEN 2 THEN '1.10'
 WHEN 3 THEN '2.0'
 WHEN 4 THEN '1e20'
 WHEN 5 THEN 'false'
 WHEN 6 THEN 'null'
 WHEN 7 THEN '{"a":1}'
 WHEN 8 THEN '[]'
 WHEN 9 THEN '12345678901234567890123'
 ELSE concat('"', event_type, '"') END,
 ',"age":', CAST(user_id AS STRING), '}')"""

# Products by p_partkey % 10: 0 no JSON, 1 price as text, 2 no in_stock, 3 id as text, 4 product null, else good.
PRODUCT_VALUE = """
CASE p_partkey % 10
 WHEN 0 THEN concat('part ', CAST(p_partkey AS STRING))
 WHEN 1 THEN concat('{"id":', CAST(p_partkey AS STRING), ',"product":"', p_name, '","price":"n/a","in_stock":true}')
 WHEN 2 THEN concat('{"id":', CAST(p_partkey AS STRING), ',"product":"', p_name, '","price":', CAST(p_retailprice AS STRING), '}')
 WHEN 3 THEN concat('{"id":"', CAST(p_partkey AS STRING), '","product":"', p_name, '","price":1,"in_stock":false}')
 WHEN 4 THEN concat('{"id":', CAST(p_partkey AS STRING), ',"product":null,"price":', CAST(p_retailprice AS STRING), ',"in_stock":true}')
 ELSE concat('{"id":', CAST(p_partkey AS STRING), ',"product":"', p_name, '","price":', CAST(p_retailprice AS STRING),
   ',"in_stock":', CASE WHEN p_size > 25 THEN 'true' ELSE 'false' END, '}')
END"""

# Products with few ids: the nation of a customer.
STORE_VALUE = """
concat('{"id":', CAST(c_nationkey AS STRING), ',"product":"', c_name, '","price":', CAST(c_acctbal AS STRING),
 ',"in_stock":', CASE WHEN c_acctbal > 0 THEN 'true' ELSE 'false' END, '}')"""

# Events by event_id % 5: 0 payload absent, 1 cut off, 2 empty text, else good.
EVENT_VALUE = """
CASE event_id % 5
 WHEN 0 THEN concat('{"id":', CAST(event_id AS STRING), ',"timestamp":"', CAST(user_id AS STRING), '"}')
 WHEN 1 THEN concat('{"id":"', CAST(event_id AS STRING), '","timestamp":"')
 WHEN 2 THEN ''
 ELSE concat('{"id":"', CAST(event_id AS STRING), '","timestamp":"2024-03-22","payload":"', event_type, '"}')
END"""

# User records that are all complete except those of partition 3 (event_id % 4), which are cut off.
ONE_BAD_PARTITION_VALUE = """
concat('{"id":', CAST(event_id AS STRING), ',"name":"', event_type, '","age":', CAST(user_id AS STRING),
 CASE WHEN event_id % 4 = 3 THEN '' ELSE '}' END)"""

# Sales with a nested list of two items: the line itself and its delivery.
TRANSACTION_KEY = "concat('txn', CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING))"
TRANSACTION_VALUE = f"""
concat('{{"transaction_id":"', {TRANSACTION_KEY}, '","store_id":"STR', CAST(l_suppkey AS STRING),
 '","timestamp":"', substr(CAST(l_shipdate AS STRING), 1, 10), 'T14:35:00Z","items":[{{"item_id":"', CAST(l_partkey AS STRING),
 '","name":"line","quantity":', CAST(CAST(l_quantity AS BIGINT) AS STRING), ',"price":', CAST(l_extendedprice AS STRING),
 '}},{{"item_id":"delivery","name":"', l_linestatus, '","quantity":1,"price":', CAST(l_tax AS STRING),
 '}}],"payment_method":"', l_returnflag, '"}}')"""

# Records that are easily lost, by event_id % 6: 0 array without elements, 1 empty text, 2 blank text, 3 object without
# fields, 4 key repeated inside a field, else good.
EDGE_VALUE = """
CASE event_id % 6
 WHEN 0 THEN '[]'
 WHEN 1 THEN ''
 WHEN 2 THEN '  '
 WHEN 3 THEN '{}'
 WHEN 4 THEN concat('{"id":', CAST(event_id AS STRING), ',"name":{"a":1,"a":2},"age":3}')
 ELSE concat('{"id":', CAST(event_id AS STRING), ',"name":"', event_type, '","age":', CAST(user_id AS STRING), '}')
END"""

# Records whose fields change their type with the partition (event_id % 4): a timestamp, then text; a large integer, then a
# fraction.
WIDENED_VALUE = """
concat('{"at":"', CASE WHEN event_id % 4 = 3 THEN 'soon' ELSE '2024-03-22T14:35:00+05:30' END,
 '","n":', CASE WHEN event_id % 4 >= 2 THEN '2.5' ELSE '9007199254740993' END, '}')"""

# Timestamp texts by event_id % 10: seven accepted forms, then text, compact date, impossible date.
TIMESTAMP_TEXT = """
CASE event_id % 10
 WHEN 0 THEN concat(substr(CAST(ts AS STRING), 1, 10), 'T14:35:00Z')
 WHEN 1 THEN substr(CAST(ts AS STRING), 1, 10)
 WHEN 2 THEN concat(substr(CAST(ts AS STRING), 1, 10), ' 14:35')
 WHEN 3 THEN concat(substr(CAST(ts AS STRING), 1, 10), 'T14:35:00+05:30')
 WHEN 4 THEN concat(substr(CAST(ts AS STRING), 1, 10), 'T14:35:00.250Z')
 WHEN 5 THEN concat(substr(CAST(ts AS STRING), 1, 10), 'T14:35')
 WHEN 6 THEN concat(substr(CAST(ts AS STRING), 1, 10), 'T20:35:00-05:00')
 WHEN 7 THEN event_type
 WHEN 8 THEN replace(substr(CAST(ts AS STRING), 1, 10), '-', '')
 ELSE concat(substr(CAST(ts AS STRING), 1, 4), '-02-31')
END"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_messages(spark: SparkSession, sf_dir: str, value: str = USER_VALUE, key: str = USER_KEY) -> DataFrame:
    """Envelopes from ``events``: topic is the event type, offset the event id, four partitions."""
    return to_envelope(
        table(spark, sf_dir, "events"),
        key=F.expr(key),
        value=F.expr(value),
        topic=F.col("event_type"),
        partition=F.expr("event_id % 4"),
        offset=F.col("event_id"),
        timestamp=F.col("ts"),
    )


# Offsets by their remainder to 100: 40 to 49 lost, 10 to 13 twice, 12 a third time.
LOST_OFFSET = "event_id div 4 % 100 BETWEEN 40 AND 49"
COPIES = """CASE WHEN event_id div 4 % 100 = 12 THEN 3 WHEN event_id div 4 % 100 BETWEEN 10 AND 13 THEN 2 ELSE 1 END"""


def damaged_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes from ``events`` in four partitions with consecutive offsets, of which some are lost and some come again."""
    events = table(spark, sf_dir, "events").where(f"NOT ({LOST_OFFSET})")
    copies = events.withColumn("copy", F.explode(F.sequence(F.lit(1), F.expr(COPIES))))
    return to_envelope(
        copies,
        key=F.col("user_id").cast("string"),
        value=F.col("props"),
        topic=F.lit("events"),
        partition=F.expr("event_id % 4"),
        offset=F.expr("event_id div 4"),
        timestamp=F.col("ts"),
    )


def keyed_messages(rows: DataFrame, key: str, value: str, topic: str) -> DataFrame:
    """Envelopes from any table with an integer id; the id is the offset of one partition."""
    return to_envelope(
        rows,
        key=F.expr(key).cast("string"),
        value=F.expr(value),
        topic=F.lit(topic),
        partition=F.lit(0),
        offset=F.expr(key),
        timestamp=F.lit("2024-03-22 14:35:00"),
    )


def product_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed_messages(table(spark, sf_dir, "part"), "p_partkey", PRODUCT_VALUE, "products")


def store_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed_messages(table(spark, sf_dir, "customer"), "c_custkey", STORE_VALUE, "stores")


def transaction_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return lines.select(F.expr(TRANSACTION_KEY).alias("message_key"), F.expr(TRANSACTION_VALUE).alias("json_string"))
