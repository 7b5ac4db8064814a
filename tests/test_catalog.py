import pytest
from conftest import ROWS1, SEVEN
from pyspark.sql import types as T

from topicflow.errors import InvalidName, SchemaMismatch, TopicExists, UnknownTopic
from topicflow.sources import catalog, log


def test_schema_is_kept(spark, root):
    catalog.create_topic(spark, root, "t", SEVEN)
    schema = catalog.fetch_schema(spark, root, "t")
    assert schema.simpleString() == (
        "struct<_1:string,_2:int,_3:boolean,_4:float,_5:double,_6:bigint,_7:tinyint>"
    )
    assert catalog.list_topics(spark, root) == ["t"]


def test_creating_again(spark, root):
    catalog.create_topic(spark, root, "t", "a int")
    catalog.create_topic(spark, root, "t", "a int")
    with pytest.raises(TopicExists):
        catalog.create_topic(spark, root, "t", "a bigint")


def test_unknown_topic(spark, root):
    with pytest.raises(UnknownTopic):
        catalog.fetch_schema(spark, root, "t")


@pytest.mark.parametrize("name", ["", "a/b", "_hidden", ".hidden", "a b", "a=b", "..", None])
def test_bad_topic_names(spark, root, name):
    with pytest.raises(InvalidName):
        catalog.create_topic(spark, root, name, "a int")


@pytest.mark.parametrize("schema", ["tp_x int", "a int, A int", "_metadata string", ""])
def test_bad_columns(spark, root, schema):
    with pytest.raises(InvalidName):
        catalog.create_topic(spark, root, "t", T.StructType() if not schema else schema)


def test_inferred_schemas(spark, root):
    assert catalog.infer_schema(spark, ["a", "b"]).simpleString() == "struct<value:string>"
    assert catalog.infer_schema(spark, [("a", 1)]).fieldNames() == ["_1", "_2"]
    frame = spark.createDataFrame(ROWS1, SEVEN)
    assert catalog.create_topic_like(spark, root, "t", frame) == frame.schema
    named = spark.createDataFrame([("a",)], "value string")
    assert catalog.infer_schema(spark, ["a"]) == catalog.infer_schema(spark, named)


def test_source_schema():
    schema = T.StructType.fromDDL("a int")
    assert catalog.source_schema(schema) == schema
    assert catalog.source_schema(schema, True).simpleString() == "struct<a:int,_TIMESTAMP_:timestamp>"
    assert catalog.source_schema(schema, True, "at").fieldNames() == ["a", "at"]
    with pytest.raises(InvalidName):
        catalog.source_schema(schema, True, "A")


@pytest.mark.parametrize("ddl", ["b int, a int", "a bigint, b int", "a int", "a int, b int, c int", "A int, b int"])
def test_rows_must_fit(spark, root, ddl):
    catalog.create_topic(spark, root, "t", "a int, b int")
    frame = spark.createDataFrame([], ddl)
    with pytest.raises(SchemaMismatch):
        log.publish(spark, root, "t", frame, producer="p", batch_id=0)


@pytest.mark.parametrize("folder", ["/tmp/a,b", "/tmp/{a}", "/tmp/*"])
def test_folders_that_cannot_be_listed(spark, folder):
    with pytest.raises(InvalidName):
        catalog.create_topic(spark, folder, "t", "a int")
