"""payflux: interbank payment clearing as Spark DataFrame operators.

Every operator is a plain function ``DataFrame -> DataFrame`` so the same
code runs on batch frames and on Structured Streaming frames (inside
``foreachBatch`` where a table must be read at batch time).
"""

from payflux.config import FlowConfig

__all__ = ["FlowConfig"]
