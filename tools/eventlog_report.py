"""Longest stages of a Spark event log (e.g. written by
``BENCH_EVENT_LOG_DIR=$(mktemp -d /tmp/run-XXXXXX) python bench.py``).

usage: python tools/eventlog_report.py <event log folder> [top_n]
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def _lines(path: str):
    raw = open(path, "rb").read()
    if path.endswith(".zstd"):
        import zstandard
        raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
    return raw.decode("utf-8", "replace").splitlines()


def stages(folder: str) -> list[dict]:
    out = []
    files = [p for p in glob.glob(os.path.join(folder, "**", "*"), recursive=True)
             if os.path.isfile(p) and not p.endswith(".crc") and "appstatus" not in p]
    for path in files:
        for line in _lines(path):
            try:
                e = json.loads(line)
            except ValueError:
                continue
            if e.get("Event") != "SparkListenerStageCompleted":
                continue
            si = e["Stage Info"]
            acc = {a.get("Name"): a.get("Value") for a in si.get("Accumulables", [])}
            out.append({
                "stage": si["Stage ID"], "tasks": si["Number of Tasks"],
                "seconds": (si.get("Completion Time", 0) - si.get("Submission Time", 0)) / 1000,
                "run_seconds": (acc.get("internal.metrics.executorRunTime") or 0) / 1000,
                "gc_seconds": (acc.get("internal.metrics.jvmGCTime") or 0) / 1000,
                "shuffle_write_mb": (acc.get("internal.metrics.shuffle.write.bytesWritten") or 0) / 2**20,
                "name": si.get("Stage Name", "")[:60],
            })
    return sorted(out, key=lambda s: -s["seconds"])


def main() -> None:
    folder = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    rows = stages(folder)
    print(f"{len(rows)} stages, {sum(r['seconds'] for r in rows):.1f} s wall in total")
    print("stage tasks wall_s run_s gc_s shuffle_mb name")
    for r in rows[:top]:
        print(f"{r['stage']:5d} {r['tasks']:5d} {r['seconds']:6.2f} {r['run_seconds']:6.2f} "
              f"{r['gc_seconds']:5.2f} {r['shuffle_write_mb']:9.2f} {r['name']}")


if __name__ == "__main__":
    main()
