"""Record shapes shared by the readers, the operators and the writers."""

from pyspark.sql import types as T

ENTITY_FIELDS = ("mention", "type", "assertion", "context_window")

ENTITY = T.StructType([T.StructField(name, T.StringType()) for name in ENTITY_FIELDS])

ANNOTATION = T.StructType(
    [
        T.StructField("text", T.StringType()),
        T.StructField("entities", T.ArrayType(ENTITY)),
    ]
)

ENTITIES_DDL = "ARRAY<STRUCT<" + ", ".join(f"{f}: STRING" for f in ENTITY_FIELDS) + ">>"
