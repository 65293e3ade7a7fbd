"""Kafka topics with framed Avro values.

Reading and writing need the Spark Kafka and Avro packages on the class path; the
option builders, the framing and the schema text do not.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A framed value is one zero byte, a four-byte schema number, the Avro body.
FRAME_BYTES = 5

_AVRO_TYPES = {
    T.StringType: "string",
    T.DoubleType: "double",
    T.IntegerType: "int",
    T.LongType: "long",
    T.BooleanType: "boolean",
}


def read_options(
    servers: str, topic: str, starting: str = "earliest", security: dict | None = None
) -> dict[str, str]:
    """Source options: the whole topic from ``starting``, then live."""
    return {
        "kafka.bootstrap.servers": servers.replace("SASL_SSL://", ""),
        "subscribe": topic,
        "startingOffsets": starting,
        **{f"kafka.{k}": v for k, v in (security or {}).items()},
    }


def write_options(
    servers: str,
    topic: str,
    compression: str = "lz4",
    linger_ms: int = 50,
    security: dict | None = None,
) -> dict[str, str]:
    """Sink options; records of a key go to one partition, batched and compressed."""
    return {
        "kafka.bootstrap.servers": servers.replace("SASL_SSL://", ""),
        "topic": topic,
        "kafka.compression.type": compression,
        "kafka.linger.ms": str(linger_ms),
        **{f"kafka.{k}": v for k, v in (security or {}).items()},
    }


def sasl_security(user: str, password: str) -> dict[str, str]:
    """Security options for SASL/PLAIN over TLS."""
    login = "org.apache.kafka.common.security.plain.PlainLoginModule"
    quote = lambda s: s.replace("\\", "\\\\").replace('"', '\\"')
    return {
        "security.protocol": "SASL_SSL",
        "sasl.mechanism": "PLAIN",
        "sasl.jaas.config": (
            f'{login} required username="{quote(user)}" password="{quote(password)}";'
        ),
    }


def avro_schema(schema: T.StructType, name: str, namespace: str | None = None) -> str:
    """Avro record schema of a flat table; timestamps are milliseconds."""
    fields = []
    for f in schema.fields:
        if isinstance(f.dataType, T.TimestampType):
            kind = {"type": "long", "logicalType": "timestamp-millis"}
        else:
            kind = _AVRO_TYPES.get(type(f.dataType))
            if kind is None:
                raise TypeError(f"column {f.name}: no Avro type for {f.dataType.simpleString()}")
        fields.append({"name": f.name, "type": ["null", kind] if f.nullable else kind})
    place = {"namespace": namespace} if namespace else {}
    return json.dumps({"type": "record", "name": name, **place, "fields": fields})


def strip_frame(value: Column) -> Column:
    return F.substring(value, FRAME_BYTES + 1, 2147483647)


def add_frame(body: Column, schema_id: int) -> Column:
    header = (0).to_bytes(1, "big") + schema_id.to_bytes(FRAME_BYTES - 1, "big")
    return F.concat(F.lit(bytearray(header)), body)


def decode(df: DataFrame, schema: T.StructType, name: str) -> DataFrame:
    """Columns of a framed Avro ``value``."""
    from pyspark.sql.avro.functions import from_avro

    record = from_avro(strip_frame(F.col("value")), avro_schema(schema, name))
    return df.select(record.alias("r")).select("r.*")


def keyed_records(df: DataFrame, key: str, value: Column) -> DataFrame:
    """The ``key``/``value`` shape a Kafka sink takes."""
    return df.select(F.col(key).cast("string").alias("key"), value.alias("value"))


def encode(df: DataFrame, key: str, schema: T.StructType, name: str, schema_id: int) -> DataFrame:
    """Keyed records with a framed Avro body."""
    from pyspark.sql.avro.functions import to_avro

    row = F.struct(*[F.col(f.name) for f in schema.fields])
    body = to_avro(row, avro_schema(schema, name))
    return keyed_records(df, key, add_frame(body, schema_id))


def read_topic(
    spark: SparkSession, options: dict, schema: T.StructType, name: str, ts: str, delay: str
) -> DataFrame:
    """A topic as a typed stream with its watermark."""
    raw = spark.readStream.format("kafka").options(**options).load()
    return decode(raw, schema, name).withWatermark(ts, delay)


def write_topic(records: DataFrame, options: dict, checkpoint: str, **trigger):
    """Start writing ``encode``d records of a stream to a topic; ``trigger`` as in Spark."""
    writer = records.writeStream.format("kafka").options(**options)
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()
