"""Event relay operators for PySpark DataFrames and Structured Streaming."""

from postroad.session import prepare, shared_dir

__all__ = ["prepare", "shared_dir"]
