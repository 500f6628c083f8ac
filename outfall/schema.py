"""Schemas of the tables that enter and leave the operators.

Time is kept as whole nanoseconds (``timestamp_ns``): Spark timestamps stop at
microseconds, and the envelopes carry nanoseconds.
"""

from __future__ import annotations

from pyspark.sql import types as T

LOG = T.StructType(
    [T.StructField("payload", T.BinaryType()), T.StructField("type", T.StringType())]
)
GAUGE_VALUE = T.StructType(
    [T.StructField("unit", T.StringType()), T.StructField("value", T.DoubleType())]
)
GAUGE = T.StructType([T.StructField("metrics", T.MapType(T.StringType(), GAUGE_VALUE))])
COUNTER = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("total", T.DecimalType(20, 0)),
        T.StructField("delta", T.DecimalType(20, 0)),
    ]
)
ENVELOPE = T.StructType(
    [
        T.StructField("env_id", T.LongType()),
        T.StructField("source_id", T.StringType()),
        T.StructField("instance_id", T.StringType()),
        T.StructField("timestamp_ns", T.LongType()),
        T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
        T.StructField("kind", T.StringType()),
        T.StructField("log", LOG),
        T.StructField("gauge", GAUGE),
        T.StructField("counter", COUNTER),
    ]
)
ENVELOPE_BATCH = T.StructType([T.StructField("batch", T.ArrayType(ENVELOPE))])

BINDING = T.StructType(
    [
        T.StructField("app_id", T.StringType()),
        T.StructField("hostname", T.StringType()),
        T.StructField("drain", T.StringType()),
    ]
)
#: A binding is identified by all of its columns.
BINDING_KEY = ["app_id", "hostname", "drain"]

PAGE_BODY = T.StructType(
    [
        T.StructField(
            "results",
            T.MapType(
                T.StringType(),
                T.StructType(
                    [
                        T.StructField("drains", T.ArrayType(T.StringType())),
                        T.StructField("hostname", T.StringType()),
                    ]
                ),
            ),
        ),
        T.StructField("next_id", T.LongType()),
    ]
)
#: One landed response of the drain API: the id asked for, the HTTP status, the body text.
LANDED_PAGE = T.StructType(
    [
        T.StructField("requested_id", T.LongType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("body", T.StringType()),
    ]
)
DNS = T.StructType([T.StructField("host", T.StringType()), T.StructField("ip", T.StringType())])
WORKER = T.StructType(
    [T.StructField("worker", T.StringType()), T.StructField("healthy", T.BooleanType())]
)
HELD = T.StructType([T.StructField("worker", T.StringType()), *BINDING.fields])
#: A rendered message for one drain; ``frame`` is what goes over the wire.
MESSAGE = T.StructType(
    [
        T.StructField("env_id", T.LongType()),
        *BINDING.fields,
        T.StructField("timestamp_ns", T.LongType()),
        T.StructField("scheme", T.StringType()),
        T.StructField("part", T.IntegerType()),
        T.StructField("metric", T.StringType()),
        T.StructField("is_valid", T.BooleanType()),
        T.StructField("frame", T.StringType()),
    ]
)
