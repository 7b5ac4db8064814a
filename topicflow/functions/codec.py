"""Rows as JSON text and back, losing nothing: nulls, NaN, microseconds, binary, decimals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicflow.errors import InvalidName
from topicflow.functions.rows import quoted

# Both directions must use the same formats.
FORMATS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "dateFormat": "yyyy-MM-dd",
    "timeZone": "UTC",
}
CORRUPT = "tp_corrupt"


def check_encodable(data_type: T.DataType) -> None:
    """JSON object keys are text, so maps need text keys."""
    if isinstance(data_type, T.MapType):
        if not isinstance(data_type.keyType, T.StringType):
            raise InvalidName(f"cannot encode {data_type.simpleString()}: map keys must be strings")
        check_encodable(data_type.valueType)
    elif isinstance(data_type, T.ArrayType):
        check_encodable(data_type.elementType)
    elif isinstance(data_type, T.StructType):
        for field in data_type.fields:
            check_encodable(field.dataType)


def to_line(value: Column) -> Column:
    return F.to_json(value, {**FORMATS, "ignoreNullFields": "false"})


def encode(rows: DataFrame, name: str = "line") -> DataFrame:
    """One JSON text per row."""
    check_encodable(rows.schema)
    return rows.select(to_line(F.struct(*map(quoted, rows.columns))).alias(name))


def parse(line: Column, schema: T.StructType) -> Column:
    """The struct in ``line``, with the text of unreadable lines in an extra last field."""
    target = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    options = {**FORMATS, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return F.from_json(line, target, options)


def unpacked(parsed: Column) -> Column:
    """The fields of a parsed line as columns.

    As the output of a generator they can be filtered without parsing the line again for the filter.
    """
    return F.inline(F.array(parsed))


def decode(lines: DataFrame, schema: T.StructType, name: str = "line") -> DataFrame:
    """Inverse of :func:`encode`; unreadable lines keep their text in ``tp_corrupt``."""
    return lines.select(unpacked(parse(quoted(name), schema)))


def accepted(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def rejected(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("line"))
