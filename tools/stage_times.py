"""Summarise a Spark event log: the slowest stages with their task counts,
input / shuffle / output bytes. Usage: python tools/stage_times.py <event log file or folder> [top]
(write one with BENCH_EVENT_LOG_DIR=<scratch folder> python bench.py)."""

from __future__ import annotations

import json
import sys


def _open(path: str):
    """Text lines of one log file; ``.zstd`` files (Spark's default event log
    compression) are decompressed on the fly."""
    import io
    if path.endswith(".zstd"):
        import zstandard
        raw = zstandard.ZstdDecompressor().stream_reader(open(path, "rb"), read_across_frames=True)
        return io.TextIOWrapper(raw, encoding="utf-8")
    return open(path, encoding="utf-8")


def _lines(path: str):
    """Lines of a single event log file, or of a rolling log folder
    (``eventlog_v2_<app>/events_<n>_<app>``) in order."""
    import os
    import re
    if os.path.isdir(path):
        parts = [f for f in os.listdir(path) if f.startswith("events_")]
        parts.sort(key=lambda f: int(re.match(r"events_(\d+)_", f).group(1)))
        for f in parts:
            yield from _open(os.path.join(path, f))
    else:
        yield from _open(path)


def main() -> None:
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    stages = {}
    for line in _lines(path):
        ev = json.loads(line)
        kind = ev.get("Event")
        if kind == "SparkListenerStageCompleted":
            info = ev["Stage Info"]
            sid = (info["Stage ID"], info["Stage Attempt ID"])
            t0, t1 = info.get("Submission Time"), info.get("Completion Time")
            acc = {a.get("Name"): a.get("Value") for a in info.get("Accumulables", [])}
            stages[sid] = dict(name=info["Stage Name"][:60], tasks=info["Number of Tasks"],
                               sec=((t1 or 0) - (t0 or 0)) / 1000.0,
                               read=acc.get("internal.metrics.input.bytesRead", 0),
                               shuffle_read=acc.get("internal.metrics.shuffle.read.remoteBytesRead", 0)
                               + acc.get("internal.metrics.shuffle.read.localBytesRead", 0),
                               shuffle_write=acc.get("internal.metrics.shuffle.write.bytesWritten", 0),
                               written=acc.get("internal.metrics.output.bytesWritten", 0))
    rows = sorted(stages.items(), key=lambda kv: -kv[1]["sec"])[:top]
    print(f"{'stage':>8} {'sec':>7} {'tasks':>6} {'read MB':>8} {'shufR MB':>9} {'shufW MB':>9} {'out MB':>7}  name")
    for (sid, att), s in rows:
        mb = lambda b: f"{(b or 0) / 1e6:.1f}"
        print(f"{sid:>5}.{att:<2} {s['sec']:>7.2f} {s['tasks']:>6} {mb(s['read']):>8} {mb(s['shuffle_read']):>9} "
              f"{mb(s['shuffle_write']):>9} {mb(s['written']):>7}  {s['name']}")


if __name__ == "__main__":
    main()
