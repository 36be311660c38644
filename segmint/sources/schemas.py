"""Schemas of the four inputs (column names as the procedure uses them)."""

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
PRICE = T.DecimalType(18, 6)

TRANSACTIONS = T.StructType(
    [
        T.StructField("Id", T.LongType()),
        T.StructField("CustomerKey", T.LongType()),
        T.StructField("CreateDate", T.TimestampNTZType()),
        T.StructField("Amount", MONEY),  # spend is negative, reversals positive
        T.StructField("IsCancellation", T.IntegerType()),
        T.StructField("OperatorKey", T.IntegerType()),
        T.StructField("FeatureType", T.IntegerType()),
        T.StructField("CardTxType", T.IntegerType()),
    ]
)

USERS = T.StructType(
    [
        T.StructField("User_Key", T.LongType()),
        T.StructField("CreateDate", T.TimestampNTZType()),
    ]
)

RATES_LEGACY = T.StructType(
    [
        T.StructField("Date", T.DateType()),
        T.StructField("Price_USDTRY", PRICE),
    ]
)

RATES_CURRENT = T.StructType(
    [
        T.StructField("Tarih", T.DateType()),
        T.StructField("USD-A", PRICE),
        T.StructField("USD-S", PRICE),
    ]
)
