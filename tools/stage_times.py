"""Slowest stages from a Spark event log folder (run bench.py with BENCH_EVENT_LOG_DIR).

    python tools/stage_times.py <event log dir> [top]
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys

import zstandard


def _lines(path: str):
    with open(path, "rb") as fh:
        raw = fh.read()
    if path.endswith(".zstd"):
        raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
    yield from raw.decode("utf-8").splitlines()


def main(folder: str, top: int = 15) -> None:
    files = sorted(glob.glob(os.path.join(folder, "**", "events_*"), recursive=True)) or \
        sorted(glob.glob(os.path.join(folder, "*")))
    stages = []
    for f in files:
        for line in _lines(f):
            e = json.loads(line)
            if e.get("Event") == "SparkListenerStageCompleted":
                i = e["Stage Info"]
                stages.append((i["Completion Time"] - i["Submission Time"], i["Stage ID"], i["Number of Tasks"],
                               i["Stage Name"][:70]))
    for ms, sid, tasks, name in sorted(stages, reverse=True)[:top]:
        print(f"{ms:7d} ms  stage {sid:4d}  tasks {tasks:4d}  {name}")
    print(f"{len(stages)} stages, {sum(s[0] for s in stages)} ms total")


if __name__ == "__main__":
    main(sys.argv[1], int(sys.argv[2]) if len(sys.argv) > 2 else 15)
