"""Explicit schemas of the known feeds and tables.

Names follow the source system exactly, including its spelling
(``oldbalanceOrg`` but ``newbalanceOrig``). Explicit schemas keep a batch whose
amounts happen to be whole numbers a ``double`` batch.
"""

from pyspark.sql import types as T

KEY = "transaction_id"
STEP = "step"

RAW_SCHEMA = T.StructType([
    T.StructField("step", T.IntegerType()),
    T.StructField("type", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("nameOrig", T.StringType()),
    T.StructField("oldbalanceOrg", T.DoubleType()),
    T.StructField("newbalanceOrig", T.DoubleType()),
    T.StructField("nameDest", T.StringType()),
    T.StructField("oldbalanceDest", T.DoubleType()),
    T.StructField("newbalanceDest", T.DoubleType()),
    T.StructField("isFraud", T.IntegerType()),
    T.StructField("isFlaggedFraud", T.IntegerType()),
])

TRANSACTIONS_SCHEMA = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("step", T.IntegerType()),
    T.StructField("type", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("origin_account_id", T.StringType()),
    T.StructField("dest_account_id", T.StringType()),
])

ACCOUNTS_SCHEMA = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("oldbalanceOrg", T.DoubleType()),
    T.StructField("newbalanceOrig", T.DoubleType()),
    T.StructField("oldbalanceDest", T.DoubleType()),
    T.StructField("newbalanceDest", T.DoubleType()),
])

FRAUD_SCHEMA = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("isFraud", T.IntegerType()),
    T.StructField("isFlaggedFraud", T.IntegerType()),
])

FEED_SCHEMAS = {
    "transactions": TRANSACTIONS_SCHEMA,
    "accounts": ACCOUNTS_SCHEMA,
    "fraud": FRAUD_SCHEMA,
}
FEEDS = tuple(FEED_SCHEMAS)


def with_step(schema: T.StructType) -> T.StructType:
    """The feed schema plus the ``step`` batch column (if it lacks one)."""
    if STEP in schema.fieldNames():
        return schema
    return T.StructType(schema.fields + [T.StructField(STEP, T.IntegerType())])


SILVER_COLUMNS = (
    [f.name for f in TRANSACTIONS_SCHEMA.fields]
    + [f.name for f in ACCOUNTS_SCHEMA.fields if f.name != KEY]
    + [f.name for f in FRAUD_SCHEMA.fields if f.name != KEY]
    + ["transaction_time", "is_corrupt"]
)
