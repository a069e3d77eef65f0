"""Summarise stage durations from a Spark event log (no UI needed).

Usage: python tools/stage_times.py <event log file or folder> [top_n]
"""

from __future__ import annotations

import glob
import json
import os
import sys


def _lines(f: str):
    """Lines of one event-log file; rolling logs are zstd-compressed by default in Spark 4."""
    if f.endswith(".zstd"):
        import io

        import zstandard

        with open(f, "rb") as raw:
            reader = zstandard.ZstdDecompressor().stream_reader(raw)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(f, encoding="utf-8") as fh:
            yield from fh


def stages(path: str):
    if os.path.isdir(path):
        files = sorted(f for f in glob.glob(os.path.join(path, "**", "*"), recursive=True)
                       if os.path.isfile(f) and os.path.basename(f).startswith(("events", "local-", "app-")))
    else:
        files = [path]
    for f in files:
        if True:
            for line in _lines(f):
                ev = json.loads(line)
                if ev.get("Event") != "SparkListenerStageCompleted":
                    continue
                info = ev["Stage Info"]
                start, end = info.get("Submission Time"), info.get("Completion Time")
                if start and end:
                    yield (end - start) / 1000.0, info["Stage ID"], info["Number of Tasks"], info["Stage Name"]


def task_times(path: str, stage_id: int):
    """Durations (s) of the tasks of one stage."""
    files = ([f for f in glob.glob(os.path.join(path, "**", "*"), recursive=True) if os.path.isfile(f)
              and os.path.basename(f).startswith(("events", "local-", "app-"))]
             if os.path.isdir(path) else [path])
    out = []
    for f in sorted(files):
        for line in _lines(f):
            ev = json.loads(line)
            if ev.get("Event") == "SparkListenerTaskEnd" and ev.get("Stage ID") == stage_id:
                ti = ev["Task Info"]
                out.append((ti["Finish Time"] - ti["Launch Time"]) / 1000.0)
    return sorted(out, reverse=True)


def main(argv):
    if len(argv) > 2 and argv[1] == "--stage":
        t = task_times(argv[0], int(argv[2]))
        print(f"stage {argv[2]}: {len(t)} tasks, longest {t[:5]}, total {sum(t):.1f} s")
        return
    top = int(argv[1]) if len(argv) > 1 else 15
    rows = sorted(stages(argv[0]), reverse=True)
    print(f"{len(rows)} stages, {sum(r[0] for r in rows):.1f} s in total")
    for secs, sid, tasks, name in rows[:top]:
        print(f"{secs:8.2f} s  stage {sid:4d}  {tasks:5d} tasks  {name[:80]}")


if __name__ == "__main__":
    main(sys.argv[1:])
