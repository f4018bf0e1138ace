"""Three-layer batch analytics (Bronze, Silver, Gold) written for Spark.

Transforms take and return DataFrames; only ``sources`` and the ``plans`` that
call it touch storage.
"""

from stratalake.session import get_spark
from stratalake.tables import TABLES, TableSpec

__all__ = ["get_spark", "TABLES", "TableSpec"]
