"""Summarise a Spark event log by SQL execution (no UI needed).

Run a job with ``spark.eventLog.enabled=true`` and ``spark.eventLog.dir`` set
to a scratch folder, then:

    python tools/eventlog_summary.py <event log dir or file> [--last N]

Prints the total wall time per action (description) and, with ``--last N``,
the last N executions in order with their duration and plan root.
"""

from __future__ import annotations

import collections
import glob
import io
import json
import os
import sys


def _lines(path: str):
    files = [path] if os.path.isfile(path) else sorted(
        glob.glob(os.path.join(path, "**", "events_*"), recursive=True)
        + glob.glob(os.path.join(path, "*")))
    for f in files:
        if os.path.isdir(f):
            continue
        with open(f, "rb") as fh:
            if f.endswith(".zstd"):
                import zstandard
                stream = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
            else:
                stream = io.TextIOWrapper(fh, encoding="utf-8")
            for line in stream:
                if line.strip():
                    yield json.loads(line)


def summarise(path: str, last: int = 0) -> None:
    starts, runs = {}, []
    for e in _lines(path):
        ev = e.get("Event", "")
        if ev.endswith("SQLExecutionStart"):
            plan = e.get("physicalPlanDescription", "")
            root = plan.splitlines()[1][:80] if "\n" in plan else ""
            starts[e["executionId"]] = (e["time"], e.get("description", "")[:40], root)
        elif ev.endswith("SQLExecutionEnd") and e["executionId"] in starts:
            t0, desc, root = starts.pop(e["executionId"])
            runs.append((t0, (e["time"] - t0) / 1000, desc, root))
    runs.sort()
    by_desc = collections.defaultdict(lambda: [0, 0.0])
    for _, sec, desc, _ in runs:
        by_desc[desc][0] += 1
        by_desc[desc][1] += sec
    print(f"{len(runs)} SQL executions, {sum(r[1] for r in runs):.1f} s")
    for desc, (n, sec) in sorted(by_desc.items(), key=lambda x: -x[1][1]):
        print(f"{sec:8.2f} s {n:4d}  {desc}")
    if last:
        print("--- last", last)
        for _, sec, desc, root in runs[-last:]:
            print(f"{sec:6.2f} s  {desc:40s} {root}")


if __name__ == "__main__":
    args = sys.argv[1:]
    n = 0
    if "--last" in args:
        i = args.index("--last")
        n = int(args[i + 1])
        del args[i:i + 2]
    summarise(args[0], n)
