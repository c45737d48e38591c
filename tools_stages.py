"""Stage times of one query from Spark's event log (no UI, no server).

    python tools_stages.py R2 [sf_dir]

Runs the query once to warm up and once under a job group with the event log
written to a fresh scratch folder, then prints each stage of that run: id,
tasks, seconds, name.
"""

from __future__ import annotations

import glob
import io
import json
import sys
import tempfile


def read_events(folder: str) -> list[dict]:
    import zstandard
    out = []
    for f in glob.glob(f"{folder}/**/events_*", recursive=True):
        raw = open(f, "rb").read()
        if f.endswith(".zstd"):
            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
        for line in raw.decode("utf-8", "ignore").splitlines():
            try:
                e = json.loads(line)
            except ValueError:
                continue
            if isinstance(e, dict):
                out.append(e)
    return out


def main() -> None:
    sys.path.insert(0, ".")
    name = sys.argv[1]
    sf = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
    folder = tempfile.mkdtemp(prefix="events-")
    from layerstar.session import get_session
    from layerstar.plans.catalog import queries
    spark = get_session("local[8]", shuffle_partitions=16,
                        **{"spark.eventLog.enabled": "true", "spark.eventLog.dir": folder})
    q = queries()[name]
    q(spark, sf).write.format("noop").mode("overwrite").save()
    spark.sparkContext.setJobGroup("measured", name)
    q(spark, sf).write.format("noop").mode("overwrite").save()
    spark.stop()
    evs = read_events(folder)
    stages = {}
    for e in evs:
        if e.get("Event") == "SparkListenerJobStart" and \
                e.get("Properties", {}).get("spark.jobGroup.id") == "measured":
            for s in e.get("Stage Infos", []):
                stages[s["Stage ID"]] = s["Stage Name"]
    for e in evs:
        if e.get("Event") == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            if si["Stage ID"] in stages and si.get("Completion Time"):
                secs = (si["Completion Time"] - si["Submission Time"]) / 1000
                print(f"{si['Stage ID']:5d} {si['Number of Tasks']:5d} {secs:7.2f}  {si['Stage Name'][:80]}")


if __name__ == "__main__":
    main()
