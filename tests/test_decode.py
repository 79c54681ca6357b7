import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronage import ACTIVATION, CONTRACTS, ORDER, PROFILE, avro_to_struct, contract
from patronage.contracts import CONSOLIDATED_COLUMNS
from patronage.operators.curate import curate_customers
from patronage.operators.decode import decode_payload, flatten_payload, split_frame, split_valid
from patronage.operators.normalise import normalise_rows, rows_from_columns


def test_avro_mapping():
    item = {"type": "record", "name": "i", "fields": [{"name": "sku", "type": "string"}, {"name": "n", "type": "int"}]}
    got = avro_to_struct({"type": "record", "name": "r", "fields": [
        {"name": "a", "type": ["null", "string"], "default": None},
        {"name": "b", "type": {"type": "array", "items": item}},
        {"name": "c", "type": {"type": "long", "logicalType": "timestamp-millis"}},
        {"name": "d", "type": "float"}, {"name": "e", "type": ["null", {"type": "long", "logicalType": "timestamp-millis"}]},
        {"name": "f", "type": "boolean"},
    ]})
    assert got.simpleString() == "struct<a:string,b:array<struct<sku:string,n:int>>,c:bigint,d:double,e:bigint,f:boolean>"
    assert all(f.nullable for f in got)


@pytest.mark.parametrize("bad", ["bytes", {"type": "map", "values": "int"}, ["null", "int", "string"],
                                 {"type": "bytes", "logicalType": "decimal"}, {"type": "enum", "symbols": ["A"]}])
def test_avro_types_outside_the_model(bad):
    with pytest.raises(ValueError):
        avro_to_struct({"type": "record", "name": "r", "fields": [{"name": "x", "type": bad}]})


def test_contracts():
    assert set(CONTRACTS) == {"profile", "order", "activation", "segment"}
    assert contract("order") is ORDER and ORDER.key in ORDER.schema.fieldNames()


def test_split_frame(spark):
    data = [(bytes.fromhex("0000000007AABB"),), (bytes.fromhex("00000000"),), (None,), (bytes.fromhex("01FFFFFFFF"),)]
    got = spark.createDataFrame(data, "v binary").select(split_frame(F.col("v")).alias("f")).collect()
    assert (got[0].f.magic, got[0].f.schema_id, bytes(got[0].f.body)) == (0, 7, b"\xaa\xbb")
    assert tuple(got[1].f) == (None, None, None) and tuple(got[2].f) == (None, None, None)
    assert (got[3].f.magic, got[3].f.schema_id, bytes(got[3].f.body)) == (1, 2**32 - 1, b"")


RECORDS = T.StructType.fromJson({"type": "struct", "fields": [
    {"name": n, "type": t, "nullable": True, "metadata": {}} for n, t in
    [("key", "string"), ("value", "string"), ("timestamp", "timestamp"), ("source_seq", "long")]]})


def records(spark, *pairs):
    return spark.createDataFrame([(k, v, None, i) for i, (k, v) in enumerate(pairs)], RECORDS)


ACT = '{"activation_id":"A1","order_id":"O","customer_id":"C","channel":"sms","status":"failed","delivered_at":null}'


def test_bad_records_are_set_aside_with_a_reason(spark, rows_of):
    df = records(
        spark, ("A1", ACT), ("A2", '{"activation_id":"A2","attempts":"x"}'), ("A3", "{broken"), ("A4", None),
        (None, ACT.replace('"activation_id":"A1",', "")), ("A6", ACT.replace('"activation_id":"A1",', "")),
        ("A7", ACT.replace('"customer_id":"C",', "")),
    )
    good, bad = split_valid(decode_payload(df, ACTIVATION), ACTIVATION)
    assert rows_of(good, "source_seq") == [(0,), (5,)]
    assert rows_of(bad, "source_seq", "reason") == [
        (1, "unreadable"), (2, "unreadable"), (3, "null_value"), (4, "no_key"), (6, "no_customer_id")]
    flat = flatten_payload(good).orderBy("source_seq").collect()
    assert flat[0].attempts == 0 and flat[0].message_key == "A1"
    assert flat[1].activation_id is None and flat[1].message_key == "A6"


def test_defaults_and_null_payload(spark):
    df = records(spark, ("c", '{"customer_id":"c","created_at":5}'), ("d", '{"customer_id":"d","created_at":5,"is_active":false}'), ("e", None))
    got = decode_payload(df, PROFILE).orderBy("source_seq").collect()
    assert (got[0].payload.is_active, got[1].payload.is_active, got[2].payload) == (True, False, None)


def test_framed_json_and_binary_key(spark):
    framed = spark.createDataFrame([(b"A1", b"\0\0\0\0\7" + ACT.encode(), None, 1)], "key binary, value binary, timestamp timestamp, source_seq bigint")
    row = decode_payload(framed, ACTIVATION, "framed_json").first()
    assert (row.message_key, row.payload.status) == ("A1", "failed")
    with pytest.raises(ValueError):
        decode_payload(framed, ACTIVATION, "xml")
    with pytest.raises(ValueError):
        decode_payload(framed, ACTIVATION, "framed_avro")


def test_curated_id_falls_back_to_the_message_key(spark):
    df = records(spark, ("k", '{"created_at":1704067200123}'), ("k2", '{"customer_id":"p","created_at":1}'))
    got = curate_customers(flatten_payload(decode_payload(df, PROFILE))).orderBy("source_seq").collect()
    assert [r.customer_id for r in got] == ["k", "p"]
    assert got[0].created_at.microsecond == 123000


@pytest.mark.parametrize("text, expected", [
    ('"a"', "a"), ('""', None), ("null", None), ('{"string":"a"}', "a"), ('{"STRING":"a"}', "a"), ('{"x":"a"}', "a"),
    ('{"string":{"string":"a"}}', "a"), ('{"string":null,"other":"b"}', None), ('{"string":"a","STRING":"b"}', "a"),
    ('{"a":{"a":{"a":{"a":"x"}}}}', "x"), ('{"a":{"a":{"a":{"a":{"a":"x"}}}}}', '{"a":"x"}'), ("5", "5"),
    ('{"x":"a","y":"b"}', '{"x":"a","y":"b"}'),
])
def test_union_strings(spark, text, expected):
    df = spark.createDataFrame([("k", f'{{"email":{text}}}')], "key string, value string")
    assert normalise_rows(df).first()["email"] == expected


@pytest.mark.parametrize("text, whole, real", [
    ("null", 0, 0.0), ('"7"', 7, 7.0), ('" 7 "', 7, 7.0), ('"x"', 0, 0.0), ('"12.7"', 0, 12.7), ("12.7", 12, 12.7),
    ("-12.7", -12, -12.7), ("true", 1, 1.0), ('{"long":5}', 0, 0.0), ("[1]", 0, 0.0), ('"1e3"', 0, 1000.0), ("1e3", 1000, 1000.0),
    ('"1f"', 0, 0.0), ('""', 0, 0.0), ('"+4"', 4, 4.0),
])
def test_numbers(spark, text, whole, real):
    df = spark.createDataFrame([("k", f'{{"order_count":{text},"lifetime_value":{text},"last_order_ts":{text}}}')], "key string, value string")
    row = normalise_rows(df).first()
    assert (row["order_count"], row["lifetime_value"]) == (whole, real)
    assert row["last_order_ts"] == (whole if whole or text == "0" else None)


@pytest.mark.parametrize("text, expected", [
    ("true", True), ('"YES"', True), ('"n"', False), ('"1"', True), ('"0"', False), ('"maybe"', None), ("2", True), ("0", False),
    ("null", None), ('"t"', None), ("{}", False), ('{"a":1}', True), ("[]", False), ("[0]", True), ('""', None), ("0.5", True),
])
def test_booleans(spark, text, expected):
    df = spark.createDataFrame([("k", f'{{"is_active":{text}}}')], "key string, value string")
    assert normalise_rows(df).first()["is_active"] is expected


@pytest.mark.parametrize("value, key, expected", [
    ('{"customer_id":"a"}', "k", "a"), ('{"CUSTOMER_ID":7}', "k", "7"), ("{}", "k", "k"), ('{"customer_id":""}', "k", "k"),
    ('{"customer_id":0}', "k", "k"), ('{"customer_id":0}', None, "0"), ('{"customer_id":null}', "k", "k"), ("{}", None, None),
    ('{"customer_id":"a","Customer_Id":"b"}', "k", "b"), ('{"customer_id":""}', None, ""),
])
def test_customer_id(spark, value, key, expected):
    df = spark.createDataFrame([(key, value)], "key string, value string")
    assert normalise_rows(df).first()["customer_id"] == expected


def test_values_that_are_no_object_are_left_out(spark):
    df = spark.createDataFrame([("k", v) for v in ("[1]", "5", '"x"', "null", "{bad", None)], "key string, value string")
    assert normalise_rows(df).count() == 0


def test_positional_rows(spark):
    df = spark.createDataFrame([(["c", "1"],), ([],)], "columns array<string>")
    first, second = rows_from_columns(df, CONSOLIDATED_COLUMNS).collect()
    assert first[:3] == ("c", "1", None) and len(first) == len(CONSOLIDATED_COLUMNS) and not any(second)


def test_amounts_that_are_no_number_are_quarantined_and_small_ones_kept(spark):
    from patronage.functions.money import exact_sum, to_cents

    rows = spark.createDataFrame([(k, json.dumps({"order_id": k, "customer_id": "c", "placed_at": 1, "items": []}).replace("}", f', "order_total": {v}}}'), None, n)
                                  for n, (k, v) in enumerate([("o1", "1.5"), ("o2", '"Infinity"'), ("o3", '"NaN"')])],
                                 "key string, value string, timestamp timestamp, source_seq bigint")
    good, bad = split_valid(decode_payload(rows, ORDER), ORDER)
    assert [r.source_seq for r in good.collect()] == [0]
    assert all(r.reason in ("bad_order_total", "unreadable") for r in bad.collect()) and bad.count() == 2
    amounts = spark.createDataFrame([(0.004,), (0.004,), (float("inf"),), (float("nan"),)], "a double")
    assert amounts.agg(exact_sum(amounts.a)).first()[0] == 0.008
    assert [r[0] for r in amounts.select(to_cents(amounts.a)).collect()] == [0, 0, None, None]
