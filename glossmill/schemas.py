"""The two record types every job in this package produces or consumes."""

from pyspark.sql import types as T

# The five token-level arrays of a sentence are parallel: equal in size, and
# position i is the same token in each.
TOKEN_FIELDS = ("token", "lemma", "pos1", "pos2", "dep")

SENTENCE_SCHEMA = T.StructType(
    [T.StructField("text", T.StringType())]
    + [T.StructField(name, T.ArrayType(T.StringType())) for name in TOKEN_FIELDS]
)

RECORD_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType(), nullable=False),
        T.StructField("tags", T.ArrayType(T.StringType())),
        T.StructField("sentences", T.ArrayType(SENTENCE_SCHEMA)),
    ]
)

# As records are stored: those too large to be a row are several, with the same id and
# tags, in the order of `part`, which is NULL for whole records.
STORED_SCHEMA = T.StructType([*RECORD_SCHEMA.fields, T.StructField("part", T.LongType())])

# One rejected block, or part of one; `raw` has lines that are not UTF-8 in base64.
QUARANTINE_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("block_no", T.LongType()),
        T.StructField("part", T.LongType()),
        T.StructField("reason", T.StringType()),
        T.StructField("lines", T.ArrayType(T.StringType())),
        T.StructField("raw", T.ArrayType(T.StringType())),
    ]
)
