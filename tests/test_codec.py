import datetime as dt
import math
from decimal import Decimal

import pytest
from conftest import ROWS1, SEVEN
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicflow.errors import InvalidName
from topicflow.functions import codec

EDGE = (
    "i int, l bigint, b boolean, y tinyint, h smallint, f float, d double, s string, t timestamp, n timestamp_ntz, "
    "e date, x decimal(10,4), z binary, a array<int>, m map<string,double>, r struct<p: int, q: array<string>>"
)
AT = dt.datetime(2024, 1, 2, 3, 4, 5, 123456)
ROWS = [
    (1, 2**62 + 1, True, -128, 5, 0.1, 0.1, "plain", AT, AT, AT.date(), Decimal("1.2345"), b"\x00\xff", [1, None],
     {"k": 1.5, "nan": math.nan}, (1, ["a", None])),
    (-1, -(2**63), False, 127, -5, math.nan, math.inf, "", dt.datetime(1969, 12, 31, 23, 59, 59, 1), AT,
     dt.date(1, 1, 1), Decimal("-0.0001"), b"", [], {}, (None, [])),
    (0, 0, None, 0, 0, -math.inf, -math.inf, 'quote " backslash \\ newline \n tab \t ünï 漢字 🎉', AT, AT,
     dt.date(9999, 12, 31), Decimal("999999.9999"), b"abc", [0], {"": 0.0}, None),
    (None,) * 16,
    (3, 3, True, 3, 3, 1e-45, 5e-324, "   ", AT, AT, AT.date(), Decimal("0"), None, None, None, (None, None)),
]


def same(left, right, columns):
    """Rows equal with nulls and NaN equal to themselves, whatever their nesting."""
    key = lambda frame: sorted(map(repr, frame.select(*columns).collect()))
    return key(left) == key(right)


def test_edge_rows_come_back(spark):
    frame = spark.createDataFrame(ROWS, EDGE)
    decoded = codec.decode(codec.encode(frame), frame.schema)
    assert same(codec.accepted(decoded), frame, frame.columns)
    assert codec.rejected(decoded).count() == 0


def test_session_zone_does_not_matter(spark):
    frame = spark.createDataFrame(ROWS, EDGE)
    lines = codec.encode(frame).collect()
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert codec.encode(frame).collect() == lines
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_seven_types(spark):
    frame = spark.createDataFrame(ROWS1, SEVEN)
    decoded = codec.accepted(codec.decode(codec.encode(frame), frame.schema))
    assert decoded.schema.simpleString() == frame.schema.simpleString()
    assert sorted(decoded.collect(), key=str) == sorted(frame.collect(), key=str)


def test_bad_lines_are_set_aside(spark):
    lines = ['{"a":1,"b":"x"}', "not json", '{"a":"word","b":"y"}', '{"a":2', '{"b":null,"a":3}']
    frame = spark.createDataFrame([(line,) for line in lines], "line string")
    decoded = codec.decode(frame, T.StructType.fromDDL("a int, b string"))
    assert sorted((r.a, r.b) for r in codec.accepted(decoded).collect()) == [(1, "x"), (3, None)]
    assert sorted(r.line for r in codec.rejected(decoded).collect()) == sorted([lines[1], lines[2], lines[3]])


def test_lines_are_parsed_once(spark):
    frame = spark.createDataFrame([("{}",)], "line string").repartition(2)
    decoded = codec.accepted(codec.decode(frame, T.StructType.fromDDL("a int, b string")))
    assert decoded._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_map_keys_must_be_text(spark):
    frame = spark.range(1).select(F.array(F.create_map(F.lit(1), F.lit(2))).alias("m"))
    with pytest.raises(InvalidName):
        codec.encode(frame)
