"""Order-delivery performance analytics on Spark.

Layers: raw text (Bronze) -> typed and cleaned (Silver) -> one wide row per order and
KPI tables (Gold) -> Spark ML classifier for late deliveries. Every operator is a plain
``DataFrame -> DataFrame`` function built from Spark SQL built-ins.
"""

__all__ = ["session", "schemas"]
