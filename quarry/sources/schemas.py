"""Fixed schemas of the cleaning jobs.

Fixed values: field names and their order are data formats that must stay
as they are, including the spellings ``crateTime`` and ``regPalce``.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Item message fields, in order.
ITEM_FIELDS = ["city", "score", "industry", "companyName", "province", "item", "crateTime", "regStatus"]

# Detail message fields, in order.
DETAIL_FIELDS = ["item", "busScope", "companyAddress", "busCreditCode", "approvalDate", "regPalce",
                 "busPeriod", "orgCode", "companyType", "busRegNum", "industry", "regTime", "scoreImg",
                 "regStatus", "regCapital", "legalPersonName"]


def all_string(fields: list[str]) -> T.StructType:
    return T.StructType([T.StructField(f, T.StringType(), True) for f in fields])


ITEM_SCHEMA = all_string(ITEM_FIELDS)
DETAIL_SCHEMA = all_string(DETAIL_FIELDS)
ITEM_TYPED_SCHEMA = T.StructType([
    T.StructField(f, T.IntegerType() if f == "score" else T.StringType(), True) for f in ITEM_FIELDS])

RATING_SCHEMA = T.StructType([
    T.StructField("user", T.IntegerType()),
    T.StructField("item", T.IntegerType()),
    T.StructField("rating", T.FloatType()),
])

GRAPH_DOCUMENT_SCHEMA = T.StructType([
    T.StructField("content", T.StructType([
        T.StructField("data", T.StructType([
            T.StructField("nodes", T.ArrayType(T.StructType([
                T.StructField("id", T.DoubleType()),
                T.StructField("properties", T.StructType([T.StructField("name", T.StringType())])),
                T.StructField("labels", T.ArrayType(T.StringType())),
            ]))),
        ])),
    ])),
])

KV_SCHEMA = T.StructType([T.StructField("key", T.IntegerType(), False), T.StructField("value", T.StringType())])

EDGE_SCHEMA = T.StructType([
    T.StructField("src", T.StringType()), T.StructField("dst", T.StringType()), T.StructField("cost", T.DoubleType())])
