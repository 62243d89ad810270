"""Table reconciliation, profiling, warehouse and ingestion operators for PySpark."""

from plumbline.spec import ReconSpec, TableSpec, prepare

__all__ = ["ReconSpec", "TableSpec", "prepare"]
