"""Summarise a Spark event log (zstd or plain): per job, its stages' tasks and time.

Usage: python tools/eventlog_summary.py <event-log-dir-or-file>
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def read_events(path: str):
    files = sorted(glob.glob(os.path.join(path, "**", "events_*"), recursive=True)) \
        if os.path.isdir(path) else [path]
    for f in files:
        raw = open(f, "rb").read()
        if f.endswith(".zstd"):
            import zstandard
            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
        for line in raw.decode("utf-8", "replace").splitlines():
            if line.strip():
                yield json.loads(line)


def main() -> None:
    stages, jobs = {}, {}
    for e in read_events(sys.argv[1]):
        ev = e["Event"]
        if ev == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            stages[si["Stage ID"]] = (si["Stage Name"], si["Number of Tasks"],
                                      si.get("Completion Time", 0) - si.get("Submission Time", 0))
        elif ev == "SparkListenerJobStart":
            jobs[e["Job ID"]] = {"start": e["Submission Time"], "stages": e["Stage IDs"]}
        elif ev == "SparkListenerJobEnd":
            jobs[e["Job ID"]]["end"] = e["Completion Time"]
    t0 = min(j["start"] for j in jobs.values())
    for jid, j in sorted(jobs.items()):
        st = [stages[s] for s in j["stages"] if s in stages]
        desc = "; ".join(f"{n[:38]} x{t} {ms}ms" for n, t, ms in st)
        print(f"job {jid:3d} at {(j['start'] - t0) / 1000:6.2f}s "
              f"took {(j.get('end', j['start']) - j['start']) / 1000:5.2f}s | {desc}")


if __name__ == "__main__":
    main()
