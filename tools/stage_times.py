"""Per-job and per-stage durations from a Spark event log (no web UI needed).

Usage: python tools/stage_times.py <event-log-file> [top_n]
"""

from __future__ import annotations

import json
import sys


def _lines(path: str):
    """Events of a plain, rolling (Spark 4 ``eventlog_v2_*`` folder) or zstd-compressed log."""
    import io
    import os
    files = [path]
    if os.path.isdir(path):
        files = sorted((os.path.join(path, f) for f in os.listdir(path) if f.startswith("events_")),
                       key=lambda f: int(os.path.basename(f).split("_")[1]))
    for f in files:
        if f.endswith(".zstd") or f.endswith(".zst"):
            import zstandard
            with open(f, "rb") as fh:
                text = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
                yield from text
        else:
            with open(f) as fh:
                yield from fh


def main() -> None:
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    stages: dict[int, dict] = {}
    jobs: dict[int, dict] = {}
    for line in _lines(path):
        ev = json.loads(line)
        kind = ev.get("Event")
        if kind == "SparkListenerStageCompleted":
            info = ev["Stage Info"]
            sub, done = info.get("Submission Time"), info.get("Completion Time")
            if sub and done:
                stages[info["Stage ID"]] = {"name": info["Stage Name"], "tasks": info["Number of Tasks"],
                                            "ms": done - sub}
        elif kind == "SparkListenerJobStart":
            jobs[ev["Job ID"]] = {"start": ev["Submission Time"], "stages": ev.get("Stage IDs", [])}
        elif kind == "SparkListenerJobEnd" and ev["Job ID"] in jobs:
            jobs[ev["Job ID"]]["ms"] = ev["Completion Time"] - jobs[ev["Job ID"]]["start"]
    print(f"{len(jobs)} jobs, {len(stages)} stages")
    for sid, st in sorted(stages.items(), key=lambda kv: -kv[1]["ms"])[:top]:
        print(f"stage {sid:5d} {st['ms'] / 1000:8.2f}s tasks={st['tasks']:5d} {st['name'][:80]}")


if __name__ == "__main__":
    main()
