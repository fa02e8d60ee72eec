"""Summarise a Spark event log (file or rolling folder): slowest stages with task counts.

usage: python tools/stage_times.py <event-log-dir> [top_n]
"""

from __future__ import annotations

import glob
import json
import os
import sys


def _lines(f: str):
    if f.endswith(".zstd"):  # Spark 4 compresses event logs with zstd by default
        import io

        import zstandard
        with open(f, "rb") as fh:
            yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
    else:
        with open(f, encoding="utf-8") as fh:
            yield from fh


def events(path: str):
    files = sorted(glob.glob(os.path.join(path, "**", "*"), recursive=True)) if os.path.isdir(path) else [path]
    for f in files:
        if os.path.isfile(f) and not f.endswith(".crc") and "appstatus" not in os.path.basename(f):
            for line in _lines(f):
                try:
                    yield json.loads(line)
                except ValueError:
                    continue


def main() -> None:
    path, top = sys.argv[1], int(sys.argv[2]) if len(sys.argv) > 2 else 15
    stages, owner = [], {}
    for e in events(path):
        if e.get("Event") == "SparkListenerJobStart":
            desc = (e.get("Properties") or {}).get("spark.job.description")
            for sid in e.get("Stage IDs", []):
                owner[sid] = desc or "-"
        if e.get("Event") == "SparkListenerStageCompleted":
            i = e["Stage Info"]
            ms = i.get("Completion Time", 0) - i.get("Submission Time", 0)
            stages.append((ms, i["Stage ID"], i.get("Number of Tasks"), i.get("Stage Name", "")[:70]))
    total = sum(s[0] for s in stages)
    print(f"{len(stages)} stages, {total / 1000:.1f} s of stage time")
    per = {}
    for ms, sid, _, _ in stages:
        per[owner.get(sid, "-")] = per.get(owner.get(sid, "-"), 0) + ms
    print("stage time per job description:")
    for name, ms in sorted(per.items(), key=lambda x: -x[1])[:top]:
        print(f"{ms / 1000:7.2f} s  {name}")
    print("slowest stages:")
    for ms, sid, n, name in sorted(stages, reverse=True)[:top]:
        print(f"{ms / 1000:7.2f} s  stage {sid:5d}  tasks {n:5d}  {name}")


if __name__ == "__main__":
    main()
