"""Replay a table as a stream of file arrivals (tests and the benchmark, local folders only)."""

from __future__ import annotations

import glob
import os
import shutil
import time
from urllib.parse import urlparse

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stage_chunks(df: DataFrame, path: str, order_col: str, n: int = 3,
                 bounds: list[int] | None = None) -> str:
    """Write ``df`` as JSON files, one per ``order_col`` range (``n`` equal
    ranges, or the ranges between the given ``bounds``), with increasing
    modification times (a file source takes files in that order). Returns the
    source folder. For tests and the benchmark: it replays a table as a stream
    of arrivals."""
    lo, hi = df.agg(F.min(order_col), F.max(order_col)).first()
    if bounds is None:
        step = (hi - lo) // n + 1
        bounds = [lo + i * step for i in range(1, n)]
    edges = [lo] + sorted(bounds) + [hi + 1]
    n = len(edges) - 1
    for i in range(n):
        part = df.filter((F.col(order_col) >= edges[i]) & (F.col(order_col) < edges[i + 1]))
        part.coalesce(1).write.mode("overwrite").json(f"{path}/_stage{i}")
    # the files are placed with local file operations: a file: URI (as a
    # checkpoint dir is reported) becomes its local path
    local = urlparse(path).path if path.startswith("file:") else path
    src = f"{local}/src"
    os.makedirs(src, exist_ok=True)
    base = time.time() - 1000
    for i in range(n):
        for f in glob.glob(f"{local}/_stage{i}/part-*.json"):
            dst = f"{src}/chunk{i:04d}.json"
            shutil.copy(f, dst)
            os.utime(dst, (base + 10 * i, base + 10 * i))
    return src
