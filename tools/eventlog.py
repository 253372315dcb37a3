"""Summarise a Spark event log folder: per job, wall time and per-stage (name, tasks, seconds)."""

import glob
import json
import os
import io
import sys

import zstandard


def main(path: str) -> None:
    files = sorted(glob.glob(os.path.join(path, "**", "events_*"), recursive=True)) or \
        [p for p in glob.glob(os.path.join(path, "*")) if os.path.isfile(p)]
    stages, jobs = {}, {}
    for f in files:
        raw = open(f, "rb").read()
        if f.endswith(".zstd"):
            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
        for line in raw.decode().splitlines():
            e = json.loads(line)
            ev = e["Event"]
            if ev == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                acc = {a["Name"]: a.get("Value") for a in si.get("Accumulables", [])}
                stages[si["Stage ID"]] = (si["Number of Tasks"],
                                          (si["Completion Time"] - si["Submission Time"]) / 1000.0,
                                          "run", round(float(acc.get("internal.metrics.executorRunTime", 0)) / 1000, 2),
                                          "cpu", round(float(acc.get("internal.metrics.executorCpuTime", 0)) / 1e9, 2),
                                          "gc", round(float(acc.get("internal.metrics.jvmGCTime", 0)) / 1000, 2),
                                          "deser", round(float(acc.get("internal.metrics.executorDeserializeTime", 0)) / 1000, 2))
            elif ev == "SparkListenerJobStart":
                jobs[e["Job ID"]] = [e["Submission Time"], e["Stage IDs"], None]
            elif ev == "SparkListenerJobEnd":
                jobs[e["Job ID"]][2] = (e["Completion Time"] - jobs[e["Job ID"]][0]) / 1000.0
    t0 = min(v[0] for v in jobs.values())
    for j, (st, sids, dur) in sorted(jobs.items()):
        print(f"job {j:3d} t+{(st - t0) / 1000:6.2f}s dur {dur}s",
              [stages[s] for s in sids if s in stages])


if __name__ == "__main__":
    main(sys.argv[1])
