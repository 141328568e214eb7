import json

from pyspark.sql import functions as F

from keyedlake.functions import parse as P
from keyedlake.schema import ENVELOPE_SCHEMA, TRANSACTION_COLUMNS


def _envelope(spark, values):
    rows = [(b"k", None if v is None else v.encode(), "t", 0, i, None) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, ENVELOPE_SCHEMA)


def test_json_edge_inputs(spark):
    good = json.dumps({"parcelId": "P1", "area": "Makati", "transactionAmount": 5.5, "extra": 1})
    values = [good, "not json", "null", "", "[1,2]", json.dumps({"area": "X"}),
              json.dumps({"parcelId": 123}), json.dumps({"parcelId": "P2", "transactionAmount": "7"}),
              json.dumps({"PARCELID": "P3"})]
    out = P.parse_transactions(_envelope(spark, values), layout="console").collect()
    by_offset = {r.kafka_offset: r for r in out}
    assert len(out) == len(values)  # console layout keeps every message
    assert by_offset[0].parcelId == "P1" and by_offset[0].transactionAmount == 5.5
    for i in (1, 2, 3, 4, 5, 8):
        assert by_offset[i].parcelId is None
    assert by_offset[6].parcelId == "123"  # number for a string field -> its text
    assert by_offset[7].parcelId == "P2" and by_offset[7].transactionAmount is None


def test_table_layout_drops_keyless(spark):
    values = [json.dumps({"parcelId": "P1"}), json.dumps({"area": "A"}), "junk"]
    out = P.parse_transactions(_envelope(spark, values), layout="table")
    assert out.columns == [*TRANSACTION_COLUMNS, "kafka_partition", "kafka_offset"]
    assert [r.parcelId for r in out.collect()] == ["P1"]


def test_high_value_and_encode_roundtrip(spark):
    df = spark.createDataFrame([("P1", 2_000_000.0), ("P2", 10.0)], "parcelId string, transactionAmount double")
    assert [r.parcelId for r in P.high_value(df).collect()] == ["P1"]
    enc = P.encode_messages(df)
    back = enc.select(F.from_json("value", "parcelId string, transactionAmount double").alias("t")).select("t.*")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_kafka_source_reports_missing_connector(spark):
    import pytest

    from keyedlake.sources import kafka as K
    if K.kafka_available(spark):
        pytest.skip("connector present")
    with pytest.raises(RuntimeError, match="spark-sql-kafka"):
        K.kafka_source(spark, "localhost:9092", "transactions")


def test_unparsable_messages_are_set_aside(spark):
    ok = '{"transactionId":"1","parcelId":"p","transactionAmount":2.5}'
    values = [ok, ok[:-9], "", None, "[]", '"text"', '{"parcelId":null}', "{}", '{"parcelId":"q","transactionAmount":"much"}',
              '{"parcelId":"r","unknown":1}', "nul\0"]
    rows = [(b"k%d" % i, None if v is None else v.encode(), "t", 3, i, None) for i, v in enumerate(values)]
    env = spark.createDataFrame(rows, "key binary, value binary, topic string, partition int, offset long, timestamp timestamp")
    kept, aside = P.split_messages(env)
    got = {r.kafka_offset: (r.reason, r.raw_value, r.kafka_key, r.kafka_partition) for r in aside.collect()}
    assert sorted(r.kafka_offset for r in kept.collect()) == [0, 9] and len(got) == len(values) - 2
    assert all(got[k][0] in ("not parsable", "no parcelId") for k in (2, 4))  # no object at all
    assert {k: v[0] for k, v in got.items() if k not in (2, 4)} == {
        1: "not parsable", 3: "no value", 5: "not parsable", 6: "no parcelId", 7: "no parcelId", 8: "not parsable",
        10: "not parsable"}
    assert all(v[1] == values[k] and v[2] == f"k{k}" and v[3] == 3 for k, v in got.items())
