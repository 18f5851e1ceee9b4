"""Credit-risk feature and label pipeline expressed as Spark DataFrame plans.

Layers
------
``functions``  Column -> Column rules (parsing, bounds, scores)
``operators``  DataFrame -> DataFrame building blocks (joins, dedup, encoding)
``sources``    raw CSV scan, partitioned lake tables, demo views
``plans``      the silver, gold and combined tables, and the backfill
"""

from riskloom.plans.attributes import attributes_gold, attributes_silver
from riskloom.plans.backfill import Lake, backfill, build_bronze, build_gold, build_silver, read_features
from riskloom.plans.clickstream import clickstream_gold, clickstream_silver
from riskloom.plans.combined import combined_features
from riskloom.plans.financials import financials_gold, financials_silver
from riskloom.plans.index_model import IndexModel
from riskloom.plans.loans import label_store, loan_silver

__all__ = [
    "attributes_gold",
    "attributes_silver",
    "IndexModel",
    "Lake",
    "backfill",
    "build_bronze",
    "build_gold",
    "build_silver",
    "clickstream_gold",
    "clickstream_silver",
    "combined_features",
    "financials_gold",
    "financials_silver",
    "label_store",
    "loan_silver",
    "read_features",
]
