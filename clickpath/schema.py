"""Schemas and fixed column lists shared by batch and streaming paths."""

from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# The event columns in wire order, and the model input order.
CORE_COLUMNS = [
    "event_time", "event_type", "product_id", "category_id",
    "category_code", "brand", "price", "user_id", "user_session",
]

FEATURE_COLS = [
    "view_count", "cart_count", "remove_count", "distinct_products",
    "distinct_categories", "distinct_brands", "avg_price", "max_price",
    "session_duration_sec", "has_cart",
]

# Event time text format and the tokens read as null.
EVENT_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss 'UTC'"
NULL_TOKENS = ["", "null", "none", "n/a"]

# Wire schema: event_time still text (as on the topic and in the CSV).
WIRE_EVENT_SCHEMA = StructType([
    StructField("event_time", StringType(), True),
    StructField("event_type", StringType(), True),
    StructField("product_id", LongType(), True),
    StructField("category_id", LongType(), True),
    StructField("category_code", StringType(), True),
    StructField("brand", StringType(), True),
    StructField("price", DoubleType(), True),
    StructField("user_id", LongType(), True),
    StructField("user_session", StringType(), True),
])

# All fields as text, for raw CSV reads that must keep bad values visible.
RAW_TEXT_SCHEMA = StructType([StructField(c, StringType(), True) for c in CORE_COLUMNS])

EVENT_SCHEMA = StructType([
    StructField("event_time", TimestampType(), True),
    *WIRE_EVENT_SCHEMA.fields[1:],
])

# The columns of the prediction and registry tables.
PREDICTION_SCHEMA = StructType([
    StructField("user_session", StringType(), True),
    StructField("event_time", TimestampType(), True),
    StructField("purchase_probability", DoubleType(), True),
    StructField("predicted_label", BooleanType(), True),
    StructField("model_version", StringType(), True),
    StructField("scored_at", TimestampType(), True),
])

REGISTRY_SCHEMA = StructType([
    StructField("hdfs_path", StringType(), False),
    StructField("version", StringType(), False),
    StructField("trained_on", StringType(), True),
    StructField("auc_score", DoubleType(), True),
    StructField("accuracy", DoubleType(), True),
    StructField("precision_score", DoubleType(), True),
    StructField("recall_score", DoubleType(), True),
    StructField("precision_purchase", DoubleType(), True),
    StructField("recall_purchase", DoubleType(), True),
    StructField("decision_threshold", DoubleType(), True),
    StructField("promoted", BooleanType(), False),
    StructField("created_at", TimestampType(), False),
    # what the model was fitted on: a scorer must build the same features
    StructField("gap", StringType(), True),
    StructField("distinct_mode", StringType(), True),
    StructField("features", StringType(), True),
])
