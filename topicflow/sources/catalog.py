"""Topic catalogue: create topics, look up and change their schemas, check rows against them.

The first schema of a topic lies in ``<root>/topics/<topic>.json``, later ones in ``<root>/schemas/<topic>/<number>.json``, each put there
only if its number is free. Every batch says which of them it was written with; readers use the newest.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from topicflow.errors import InvalidName, SchemaMismatch, TopicExists, UnknownTopic
from topicflow.storage import Store

TIMESTAMP_COLUMN = "_TIMESTAMP_"
SYSTEM_PREFIX = "tp_"
_NAME = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]*")


def check_name(kind: str, name: str) -> str:
    """Names become directory names, so only plain ones are allowed."""
    if not isinstance(name, str) or not _NAME.fullmatch(name):
        raise InvalidName(f"{kind} {name!r}: use letters, digits, '.', '_' and '-'")
    return name


def as_schema(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def check_columns(schema: T.StructType) -> None:
    seen = set()
    for name in schema.fieldNames():
        key = name.lower()
        if key.startswith(SYSTEM_PREFIX) or key == "_metadata":
            raise InvalidName(f"column {name!r}: names starting with {SYSTEM_PREFIX} and _metadata are reserved")
        if key in seen:
            raise InvalidName(f"column {name!r} appears twice")
        seen.add(key)
    if not seen:
        raise InvalidName("a topic needs at least one column")


def create_topic(spark: SparkSession, root: str, topic: str, schema: T.StructType | str) -> T.StructType:
    """Declare a topic. Creating it again with the same schema changes nothing; with another one it fails."""
    check_name("topic", topic)
    schema = as_schema(schema)
    check_columns(schema)
    store = Store(spark, root)
    if not store.commit_text(f"{root}/topics/{topic}.json", schema.json()):
        known = fetch_schema(spark, root, topic)
        if known.simpleString() != schema.simpleString():
            raise TopicExists(f"topic {topic!r} exists with schema {known.simpleString()}")
        return known
    return schema


def infer_schema(spark: SparkSession, sample: DataFrame | Sequence) -> T.StructType:
    """Schema of a sample: a DataFrame, unnamed tuples (columns _1.._n) or plain values (column value)."""
    if isinstance(sample, DataFrame):
        return sample.schema
    rows = list(sample)
    if rows and not isinstance(rows[0], (tuple, list, dict)):
        rows = [T.Row(value=value) for value in rows]
    return spark.createDataFrame(rows).schema


def create_topic_like(spark: SparkSession, root: str, topic: str, sample: DataFrame | Sequence) -> T.StructType:
    """Declare a topic with the schema of a sample."""
    return create_topic(spark, root, topic, infer_schema(spark, sample))


def schema_path(root: str, topic: str, number: int) -> str:
    return f"{root}/schemas/{topic}/{number:06d}.json" if number else f"{root}/topics/{topic}.json"


def schema_texts(files, root: str, topic: str) -> list[str]:
    """All schemas of a topic, oldest first; none for an unknown topic. ``files`` is a Store or MountedFiles."""
    found: list[str] = []
    while (text := files.text_if_there(schema_path(root, topic, len(found)))) is not None:
        found.append(text)
    return found


def schemas(spark: SparkSession, root: str, topic: str) -> list[T.StructType]:
    """All schemas a topic has had, oldest first."""
    texts = schema_texts(Store(spark, root), root, check_name("topic", topic))
    if not texts:
        raise UnknownTopic(f"topic {topic!r} does not exist")
    return [T.StructType.fromJson(json.loads(text)) for text in texts]


def fetch_schema(spark: SparkSession, root: str, topic: str) -> T.StructType:
    """The newest schema of a topic."""
    return schemas(spark, root, topic)[-1]


_WIDER = {  # what a column's type may become
    "tinyint": ("smallint", "int", "bigint"),
    "smallint": ("int", "bigint"),
    "int": ("bigint",),
    "float": ("double",),
}


def _widens(old: T.DataType, new: T.DataType) -> bool:
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType):
        return old.scale == new.scale and old.precision <= new.precision
    return old == new or new.simpleString() in _WIDER.get(old.simpleString(), ())


def check_change(old: T.StructType, new: T.StructType) -> None:
    """Columns keep their names and order, types may only widen, further columns come last."""
    check_columns(new)
    for place, field in enumerate(old):
        if place >= len(new) or new[place].name != field.name:
            raise SchemaMismatch(f"column {field.name!r} must stay at place {place + 1}")
        if not _widens(field.dataType, new[place].dataType):
            was, becomes = field.dataType.simpleString(), new[place].dataType.simpleString()
            raise SchemaMismatch(f"column {field.name!r} cannot become {becomes} from {was}")


def change_topic(spark: SparkSession, root: str, topic: str, schema: T.StructType | str) -> T.StructType:
    """Give a topic wider types or further columns.

    Batches stay as they are: older ones are read with wider types, and nulls in columns they don't have. Rows in an older
    schema can still be published. A change to the present schema does nothing; of two changes at a time one has to fit the other.
    """
    store, schema = Store(spark, root), as_schema(schema)
    while True:
        known = schemas(spark, root, topic)
        if known[-1].simpleString() == schema.simpleString():
            return known[-1]
        check_change(known[-1], schema)
        store.mkdirs(f"{root}/schemas/{topic}")
        if store.commit_text(schema_path(root, topic, len(known)), schema.json()):
            return schema


def list_topics(spark: SparkSession, root: str) -> list[str]:
    names = Store(spark, root).names(f"{root}/topics")
    return sorted(name.removesuffix(".json") for name in names if not name.startswith("_"))


def nullable(kind: T.DataType) -> T.DataType:
    """The same type with nulls allowed everywhere, as stored data is read."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, nullable(f.dataType), True, f.metadata) for f in kind])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(nullable(kind.elementType), True)
    if isinstance(kind, T.MapType):
        return T.MapType(nullable(kind.keyType), nullable(kind.valueType), True)
    return kind


def source_schema(
    schema: T.StructType, includes_timestamp: bool = False, timestamp_column: str = TIMESTAMP_COLUMN
) -> T.StructType:
    """What a consumer sees: the topic's columns and, when asked for, the receive time last."""
    if not includes_timestamp:
        return schema
    if timestamp_column.lower() in (name.lower() for name in schema.fieldNames()):
        raise InvalidName(f"column {timestamp_column!r} is already in the topic")
    return T.StructType(schema.fields + [T.StructField(timestamp_column, T.TimestampType(), True)])


def check_rows(rows: T.StructType, known: T.StructType | Sequence[T.StructType]) -> int:
    """The number of the topic's newest schema that the rows have. Names, order and types must agree; nothing is cast.

    Nullability may differ.
    """
    known = [known] if isinstance(known, T.StructType) else list(known)
    for number in reversed(range(len(known))):
        if rows.simpleString() == known[number].simpleString():
            return number
    raise SchemaMismatch(f"rows are {rows.simpleString()}, the topic is {known[-1].simpleString()}")
