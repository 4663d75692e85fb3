"""Print per-job wall times from a Spark event log folder (zstd or plain)."""

import glob
import io
import json
import sys

import zstandard


def events(path):
    for f in sorted(glob.glob(path + "/**/events_*", recursive=True)):
        raw = open(f, "rb")
        stream = zstandard.ZstdDecompressor().stream_reader(raw) if f.endswith(".zstd") else raw
        for line in io.TextIOWrapper(stream, encoding="utf-8"):
            yield json.loads(line)


def main(path):
    jobs = {}
    for e in events(path):
        if e["Event"] == "SparkListenerJobStart":
            p = e.get("Properties", {})
            jobs[e["Job ID"]] = [e["Submission Time"], None, p.get("callSite.short", ""), len(e["Stage IDs"])]
        elif e["Event"] == "SparkListenerJobEnd":
            jobs[e["Job ID"]][1] = e["Completion Time"]
    t0 = min(v[0] for v in jobs.values())
    for j, (s, en, site, n) in sorted(jobs.items()):
        print(f"{j:4d} start={(s - t0) / 1000:7.2f} dur={(en - s) / 1000:6.2f} stages={n} {site[:90]}")


if __name__ == "__main__":
    main(sys.argv[1])
