"""Summarise a Spark event log (written with spark.eventLog.enabled to a scratch folder): per job, its
description and duration, and per stage, task count and duration.

    python tools/eventlog_stages.py <eventlog dir or file>
"""

import glob
import json
import os
import sys


def main(path: str) -> None:
    files = sorted(glob.glob(os.path.join(path, "**", "*"), recursive=True)) if os.path.isdir(path) else [path]
    jobs = {}
    for f in files:
        if os.path.isdir(f):
            continue
        raw = open(f, "rb").read()
        if f.endswith(".zstd"):
            import zstandard
            raw = zstandard.ZstdDecompressor().stream_reader(raw).read()
        for line in raw.decode("utf-8").splitlines():
            if not line.strip():
                continue
            e = json.loads(line)
            ev = e["Event"]
            if ev == "SparkListenerJobStart":
                desc = e.get("Properties", {}).get("spark.job.description")
                jobs[e["Job ID"]] = (desc, e["Submission Time"])
            elif ev == "SparkListenerJobEnd":
                d, t0 = jobs[e["Job ID"]]
                print(f"job {e['Job ID']:4d} {str(d)[:30]:30s} {e['Completion Time'] - t0:6d} ms")
            elif ev == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                dur = si.get("Completion Time", 0) - si.get("Submission Time", 0)
                print(f"    stage {si['Stage ID']:4d} tasks {si['Number of Tasks']:4d} {dur:6d} ms  {si['Stage Name'][:50]}")


if __name__ == "__main__":
    main(sys.argv[1])
