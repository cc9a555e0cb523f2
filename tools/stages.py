"""Summarise a Spark event log: per job group (query), stage wall time, tasks,
input bytes, shuffle read/write bytes and spill.

Usage: python tools/stages.py EVENT_LOG_FILE_OR_DIR [top_n]
"""

from __future__ import annotations

import json
import sys
from collections import defaultdict
from pathlib import Path


def _files(path: Path):
    if not path.is_dir():
        return [path]
    return sorted(p for p in path.rglob("*") if p.is_file() and
                  (p.name.startswith("events_") or p.name.startswith("local-") or p.name.startswith("app-")))


def _lines(f: Path):
    """Event log lines; rolling logs are zstd-compressed by default."""
    if f.suffix == ".zstd":
        import io

        import zstandard
        with f.open("rb") as fh:
            yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
    else:
        yield from f.open()


def main():
    path = Path(sys.argv[1])
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 5
    job_group, stage_group = {}, {}
    stages = {}
    for f in _files(path):
        for line in _lines(f):
            e = json.loads(line)
            kind = e.get("Event")
            if kind == "SparkListenerJobStart":
                group = (e.get("Properties") or {}).get("spark.jobGroup.id", "-")
                job_group[e["Job ID"]] = group
                for sid in e.get("Stage IDs", []):
                    stage_group[sid] = group
            elif kind == "SparkListenerStageCompleted":
                info = e["Stage Info"]
                acc = {a.get("Name"): a.get("Value") for a in info.get("Accumulables", [])}
                stages[info["Stage ID"]] = {
                    "name": info.get("Stage Name", "")[:60],
                    "ms": (info.get("Completion Time", 0) or 0) - (info.get("Submission Time", 0) or 0),
                    "tasks": info.get("Number of Tasks"),
                    "input": acc.get("internal.metrics.input.bytesRead", 0),
                    "shuffle_read": (acc.get("internal.metrics.shuffle.read.remoteBytesRead", 0) or 0)
                    + (acc.get("internal.metrics.shuffle.read.localBytesRead", 0) or 0),
                    "shuffle_write": acc.get("internal.metrics.shuffle.write.bytesWritten", 0),
                    "spill": acc.get("internal.metrics.diskBytesSpilled", 0),
                }
    per_group = defaultdict(list)
    for sid, st in stages.items():
        per_group[stage_group.get(sid, "-")].append((sid, st))
    for group, items in per_group.items():
        total = sum(st["ms"] for _, st in items)
        print(f"{group}: {len(items)} stages, {total} ms")
        for sid, st in sorted(items, key=lambda x: -x[1]["ms"])[:top]:
            print(f"  stage {sid:4d} {st['ms']:6d} ms tasks={st['tasks']} in={st['input']} "
                  f"shR={st['shuffle_read']} shW={st['shuffle_write']} spill={st['spill']} {st['name']}")


if __name__ == "__main__":
    main()
