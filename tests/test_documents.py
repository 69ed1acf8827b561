"""Edge rows for message parsing, enrichment and the report (FIXTURES.md)."""

import json

from pyspark.sql import functions as F

from flowdex.functions.documents import doc_to_json, mapify
from flowdex.functions.text import decode_utf8
from flowdex.operators import histogram, sqlreport
from flowdex.operators.documents import prepare_documents


def _docs(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, value string")
    return {r["id"]: r["doc"] for r in df.select("id", mapify("value").alias("doc")).collect()}


def test_mapify_edge_rows(spark):
    docs = _docs(spark, ["not json", "[1,2]", "{}", None,
                         '{"a":"x","n":7,"b":true,"o":{"z":1},"u":null}',
                         '{"a":"1","a":"2"}', '{"f":1.50}'])
    assert docs[0] == {} and docs[1] == {} and docs[2] == {} and docs[3] == {}
    assert docs[4] == {"a": "x", "n": "7", "b": "true", "o": '{"z":1}'}
    assert docs[5] == {"a": "2"}
    assert docs[6] == {"f": "1.5"}


def test_prepare_keeps_empty_documents(spark):
    df = spark.createDataFrame([("not json",), ('{"a":"b"}',)], "value string")
    assert prepare_documents(df).count() == 2
    assert prepare_documents(df, drop_empty=True).count() == 1


def test_enrich_missing_field_and_existing_tag(spark):
    rows = [("2024-01-01", '{"f":"x","histo_supp":"zz"}'),
            ("2024-01-01", '{"other":"x"}'),
            ("2024-01-02", '{"f":"x"}')]
    df = spark.createDataFrame(rows, "batch string, value string")
    out = histogram.render(histogram.enrich(df, "f"), keep=["batch"]).collect()
    texts = sorted((r["batch"], r["value"]) for r in out)
    assert texts[0] == ("2024-01-01", '{"f":"x","histo_supp":"1","histo_field":"f","histo_valu":"x"}')
    assert texts[1] == ("2024-01-01", '{"other":"x"}')
    assert json.loads(texts[2][1]) == {"f": "x", "histo_field": "f", "histo_valu": "x", "histo_supp": "2"}


def test_report_threshold_null_host_and_escaping(spark):
    msgs = [
        '{"host":"a","path":"/var/log/system.log","lineno":70}',
        '{"host":"a","path":"/var/log/system.log","lineno":71}',
        '{"path":"/var/log/system.log","lineno":90}',
        '{"host":"h\\"2","path":"/var/log/system.log","lineno":80}',
        '{"host":"b","path":"/var/log/auth.log","lineno":99}',
    ]
    df = spark.createDataFrame([(m,) for m in msgs], "value string")
    report = sqlreport.sql_analyzer(df)
    rows = {r["host"]: (r["host_c"], r["line_a"]) for r in report.collect()}
    assert rows == {"a": (1, 71.0), None: (0, 90.0), 'h"2': (1, 80.0)}
    texts = sorted(r["value"] for r in sqlreport.render_report(report).collect())
    assert '{"count":0,"mean":90.0}' in texts
    assert '{"host":"h\\"2","count":1,"mean":80.0}' in texts
    legacy = sqlreport.render_report(report, legacy_keys=True).collect()
    assert all('"sum":' in r["value"] for r in legacy)


def test_report_order_is_deterministic(spark):
    msgs = [f'{{"host":"h{i % 3}","path":"/var/log/system.log","lineno":80}}' for i in range(9)]
    df = spark.createDataFrame([(m,) for m in msgs], "value string")
    hosts = [r["host"] for r in sqlreport.sql_analyzer(df).collect()]
    assert hosts == ["h0", "h1", "h2"]


def test_inferred_schema_ignores_non_objects(spark):
    df = spark.createDataFrame([('{"a":1}',), ("[1]",), ("junk",), ('{"a":2.5,"b":"x"}',)], "value string")
    schema = sqlreport.infer_json_schema(df)
    assert schema is not None and "a" in schema and "b" in schema
    empty = spark.createDataFrame([], "value string")
    assert sqlreport.infer_json_schema(empty) is None
    assert sqlreport.sql_analyzer(empty, statement="SELECT * FROM logstash", schema=None) is None


def test_malformed_utf8_becomes_replacement(spark):
    df = spark.createDataFrame([(bytearray(b"a\xff\xfeb"),)], "data binary")
    assert df.select(decode_utf8("data").alias("t")).first()["t"] == "a��b"


def test_doc_json_key_order(spark):
    df = spark.createDataFrame([('{"z":"1","a":"2"}',)], "value string")
    assert df.select(doc_to_json(mapify("value"))).first()[0] == '{"z":"1","a":"2"}'


def test_empty_batch_enrich(spark):
    df = spark.createDataFrame([], "batch string, value string")
    assert histogram.enrich(df, "f").count() == 0


def test_field_values_on_null_member(spark):
    df = spark.createDataFrame([('{"f":null}',), ('{"f":"v"}',)], "value string")
    vals = sorted(str(r[0]) for r in histogram.with_documents(df, "f").select("histo_valu").collect())
    assert vals == ["None", "v"]
    assert df.select(F.size(mapify("value"))).collect()[0][0] == 0


def test_bind_view_rewrites_only_table_references():
    from flowdex.operators.sqlreport import DEFAULT_STATEMENT, bind_view
    bound = bind_view(DEFAULT_STATEMENT, "logstash")
    assert "FROM {logstash} AS logstash WHERE" in bound and bound.count("{logstash}") == 1
    assert bind_view("SELECT 'logstash' AS s FROM logstash", "logstash") == (
        "SELECT 'logstash' AS s FROM {logstash} AS logstash")
    assert bind_view("SELECT logstash_x FROM t", "logstash") is None
    assert bind_view('SELECT "a" FROM logstash', "logstash") is None


def test_sql_analyzer_leaves_catalog_alone(spark):
    df = spark.createDataFrame([('{"host":"a","path":"/var/log/system.log","lineno":80}',)], "value string")
    spark.catalog.dropTempView("logstash")
    assert [r["host"] for r in sqlreport.sql_analyzer(df).collect()] == ["a"]
    assert not spark.catalog.tableExists("logstash")


def test_on_missing_fail_stops_the_job(spark):
    import pytest
    df = spark.createDataFrame([("2024-01-01", '{"f":"x"}'), ("2024-01-01", '{"g":"y"}')],
                               "batch string, value string")
    assert histogram.enrich(df, "f").count() == 2  # default: passed through uncounted
    with pytest.raises(Exception, match="message without field 'f'"):
        histogram.enrich(df, "f", on_missing="fail").collect()
    with pytest.raises(ValueError):
        histogram.with_documents(df, "f", on_missing="ignore")
