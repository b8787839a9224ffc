"""Sources and sinks."""

from .files import (
    CatalogTables,
    ParquetTables,
    read_csv,
    write_bucketed,
    write_csv,
    write_mart,
    write_run_metrics,
)
from .layout import KeyedLayout
from .sample_star import EVENTS_AS_OF, ORDERS_AS_OF, SampleStar
from .schemas import DDL, schema_of

__all__ = [
    "CatalogTables", "DDL", "EVENTS_AS_OF", "KeyedLayout", "ORDERS_AS_OF", "ParquetTables", "SampleStar",
    "read_csv", "schema_of", "write_bucketed", "write_csv", "write_mart", "write_run_metrics",
]
