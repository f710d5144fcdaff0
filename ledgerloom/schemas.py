"""Declared table schemas. Nothing in this package infers a schema from data."""

from pyspark.sql import types as T

TRANSACTION = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("merchant_category", T.StringType()),
        T.StructField("location", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("is_fraud", T.BooleanType()),
    ]
)

# Labels are read as text and normalised afterwards, so that "true" and "1" mean the same.
BASE_CODE = T.StructType(
    [
        T.StructField("func", T.StringType()),
        T.StructField("target", T.StringType()),
    ]
)

SYNTHETIC_CODE = T.StructType(
    [
        T.StructField("func", T.StringType()),
        T.StructField("target", T.StringType()),
        T.StructField("bug_type", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("sample_id", T.LongType()),
        T.StructField("batch_id", T.LongType()),
    ]
)

MERGED_CODE = T.StructType(
    [
        T.StructField("func", T.StringType()),
        T.StructField("target", T.IntegerType()),
        T.StructField("source", T.StringType()),
    ]
)

PREDICTION = T.StructType(
    [
        T.StructField("sample_idx", T.LongType()),
        T.StructField("prediction", T.IntegerType()),
        T.StructField("true_label", T.IntegerType()),
        T.StructField("batch_num", T.LongType()),
    ]
)
