"""loadstar: freight analytics over a shipment star schema, written for Spark.

Every operator takes a :class:`~loadstar.star.Star` (one shipment fact and five
dimensions) or plain DataFrames, and returns a lazy DataFrame.
"""

from loadstar.star import Star

__all__ = ["Star"]
