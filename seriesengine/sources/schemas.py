"""Declared schemas of the landed and raw tables."""

from __future__ import annotations

from pyspark.sql import types as T

INGESTION_TIMESTAMP = "ingestion_timestamp"
INGESTION_DATE = "ingestion_date"

_AUDIT = [
    T.StructField(INGESTION_TIMESTAMP, T.TimestampType()),
    T.StructField(INGESTION_DATE, T.DateType()),
]

# Columns of the raw daily table.
DAILY_RAW = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("open", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("close", T.DoubleType()),
        T.StructField("adj_close", T.DoubleType()),
        T.StructField("volume", T.LongType()),
        T.StructField("dividends", T.DoubleType()),
        T.StructField("stock_splits", T.DoubleType()),
        *_AUDIT,
    ]
)

# Columns of the raw weekly table.
WEEKLY_RAW = T.StructType(
    [
        T.StructField("period", T.DateType()),
        T.StructField("duoarea", T.StringType()),
        T.StructField("area_name", T.StringType()),
        T.StructField("product", T.StringType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("process", T.StringType()),
        T.StructField("process_name", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("units", T.StringType()),
        *_AUDIT,
    ]
)

# Header of a landed daily batch, as source name -> raw name.
DAILY_RENAMES = {
    "Date": "date",
    "Open": "open",
    "High": "high",
    "Low": "low",
    "Close": "close",
    "Adj Close": "adj_close",
    "Volume": "volume",
    "Dividends": "dividends",
    "Stock Splits": "stock_splits",
}

# Hyphenated fields of an API record, as source name -> raw name.
WEEKLY_RENAMES = {
    "area-name": "area_name",
    "product-name": "product_name",
    "process-name": "process_name",
}

# Selection of the weekly series.
WEEKLY_PRODUCT = "EPD2D"
WEEKLY_AREA = "NUS"
API_PAGE_SIZE = 5000

# Landed daily batch; the date is text because sources write it with an offset.
DAILY_LANDED = T.StructType(
    [T.StructField("Date", T.StringType())]
    + [
        T.StructField(name, DAILY_RAW[raw].dataType)
        for name, raw in DAILY_RENAMES.items()
        if name != "Date"
    ]
)

_API_RECORD = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in (
            "period",
            "duoarea",
            "area-name",
            "product",
            "product-name",
            "process",
            "process-name",
            "value",
            "units",
        )
    ]
)

# One page of the API: up to API_PAGE_SIZE records, the reported total of all pages, and
# where the page was asked to begin; pages that do not say are told apart by content.
API_PAGE = T.StructType(
    [
        T.StructField(
            "request",
            T.StructType(
                [T.StructField("params", T.StructType([T.StructField("offset", T.StringType())]))]
            ),
        ),
        T.StructField(
            "response",
            T.StructType(
                [
                    T.StructField("total", T.StringType()),
                    T.StructField("data", T.ArrayType(_API_RECORD)),
                ]
            ),
        ),
    ]
)
