import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from flowdex.functions.json_types import known, readable, widen
from flowdex.operators import sqlreport
from flowdex.plans.analyzers import SqlAnalyzer
from flowdex.session import work_dir
from flowdex.streaming.schema_state import SchemaState

SIMPLE = st.sampled_from([T.NullType(), T.LongType(), T.DoubleType(), T.StringType(), T.BooleanType(), T.DecimalType(3, 1),
                          T.DecimalType(38, 20), T.DecimalType(20, 0)])
TYPES = st.recursive(SIMPLE, lambda t: st.one_of(
    t.map(T.ArrayType), st.dictionaries(st.sampled_from("abc"), t).map(
        lambda d: T.StructType([T.StructField(k, v) for k, v in d.items()]))), max_leaves=6)


def unordered(t):
    if isinstance(t, T.StructType):
        return tuple(sorted((f.name, unordered(f.dataType)) for f in t.fields)), "struct"
    return ("array", unordered(t.elementType)) if isinstance(t, T.ArrayType) else (t.simpleString(), "")


@settings(max_examples=500, deadline=None)
@given(TYPES, TYPES, TYPES)
def test_widen_is_a_join(a, b, c):
    assert unordered(widen(a, a)) == unordered(a)
    assert unordered(widen(a, b)) == unordered(widen(b, a))
    assert unordered(widen(widen(a, b), c)) == unordered(widen(a, widen(b, c)))
    assert widen(widen(a, b), b) == widen(a, b)


def test_order_of_kinds():
    long, point, double, text = T.LongType(), T.DecimalType(5, 2), T.DoubleType(), T.StringType()
    assert widen(long, point) == T.DecimalType(21, 2)
    assert widen(point, double) == double and widen(long, double) == double
    assert widen(double, text) == text and widen(T.BooleanType(), long) == text
    assert widen(T.DecimalType(38, 0), T.DecimalType(38, 38)) == double
    assert known(T.VariantType()) == text
    assert readable(T.StructType().add("a", T.NullType()).add("b", T.StructType())) == T.StructType().add("a", text).add("b", text)


def batch(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_a_field_keeps_its_type(spark):
    state = SchemaState(work_dir(spark, "schema"))
    assert state.advance(batch(spark, "no json", "[1]", None)) is None
    assert state.advance(batch(spark)) is None
    assert state.advance(batch(spark, '{"a":1}')).simpleString() == "struct<a:bigint>"
    third = state.advance(batch(spark, '{"a":1.5,"b":{"x":true},"n":null,"e":{}}'))
    assert third.simpleString() == "struct<a:decimal(20,1),b:struct<x:boolean>,e:string,n:string>"
    fourth = batch(spark, '{"a":123456789}', "{}", "null")  # neither b nor n
    assert state.advance(fourth) == third
    assert [r.a for r in sqlreport.parse_records(fourth, third).collect()][0] == 123456789
    assert state.advance(fourth) == third  # run again
    fifth = state.advance(batch(spark, '{"a":"text","b":{"y":[1,"z"]},"n":2,"e":{"f":1}}'))
    assert fifth.simpleString() == "struct<a:string,b:struct<x:boolean,y:array<string>>,e:struct<f:bigint>,n:bigint>"
    assert len(state._files(spark)[3]) == 2


def test_interrupted_write_is_not_seen(spark):
    root = work_dir(spark, "schema")
    state = SchemaState(root, "a bigint")
    before = state.advance(batch(spark, '{"b":1}'))
    hadoop, folder, files, versions = state._files(spark)
    files.create(hadoop.Path(folder, "_2.new"), True).close()
    assert SchemaState(root, "a bigint").advance(batch(spark, '{"a":2}')) == before
    assert SchemaState(root).advance(batch(spark, '{"c":2}')).names == ["a", "b", "c"]


def test_repeated_keys_have_columns(spark):
    rows = batch(spark, '{"a":1}', '{"a":1,"only":2,"a":"last"}', '{"`odd OBJECT<":{"x":1,"x":2.5}}')
    schema = SchemaState(work_dir(spark, "schema")).advance(rows)
    assert set(schema.names) == {"a", "only", "`odd OBJECT<"}
    got = sqlreport.parse_records(rows, schema).collect()
    assert [r["a"] for r in got] == ["1", "last", None] and got[1]["only"] == 2
    assert float(got[2]["`odd OBJECT<"]["x"]) == 2.5


def test_analyzer_with_kept_schema(spark):
    statement = "SELECT host, SUM(n) AS n FROM logstash GROUP BY host ORDER BY host"
    analyzer = SqlAnalyzer(statement, schema="host string, n bigint", schema_dir=work_dir(spark, "schema"))
    batches = [['{"host":"a"}'], ['{"host":"a","n":1.5}'], ['{"host":"b","n":1}'], ["nothing"]]
    out = [[r.value for r in analyzer(batch(spark, *b), i).collect()] for i, b in enumerate(batches)]
    assert out == [['{"host":"a"}'], ['{"host":"a","n":1.5}'], ['{"host":"b","n":1.0}'], ["{}"]]


def test_inference_needs_the_setting(spark):
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "false")
    try:
        with pytest.raises(RuntimeError):
            sqlreport.infer_json_schema(batch(spark, "{}"))
    finally:
        spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
