"""Loads of several tables that readers see all at once or not at all.

A load writes its tables under ``<sink>/loads/<load id>/<table>`` and ends with one
commit file, ``<sink>/commits/<number>-<load id>.json``, put in place by a rename.
Readers follow the commits: a table is where the newest commit that holds it says.
A load that fails has no commit, so readers stay with the generation before; run
again under its id it writes the same folders anew, and once it is committed
another run changes nothing.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def load_dir(sink_dir: str, load_id: str) -> str:
    return f"{sink_dir.rstrip('/')}/loads/{load_id}"


def commits(spark: SparkSession, sink_dir: str) -> list[dict]:
    """All commits, oldest first: {"load_id", "tables": {name: rows}}. A row per load comes to the driver."""
    folder, fs = _fs(spark, f"{sink_dir.rstrip('/')}/commits")
    if not fs.exists(folder):
        return []
    names = sorted(s.getPath().getName() for s in fs.listStatus(folder))
    names = [n for n in names if n.endswith(".json") and n[:1] not in "_."]
    if not names:
        return []
    rows = spark.read.option("wholetext", True).text([f"{folder.toString()}/{n}" for n in names]).collect()
    return sorted((json.loads(r[0]) for r in rows), key=lambda c: (c["number"], c["load_id"]))


def commit(spark: SparkSession, sink_dir: str, load_id: str, tables: dict[str, int]) -> None:
    """Make a finished load the current generation of its tables (name: rows written)."""
    number = 1 + max((c["number"] for c in commits(spark, sink_dir)), default=0)
    base = f"{sink_dir.rstrip('/')}/commits"
    temp, fs = _fs(spark, f"{base}/_{load_id}.tmp")
    out = fs.create(temp, True)
    try:
        out.write(bytearray(json.dumps({"number": number, "load_id": load_id, "tables": tables}).encode()))
    finally:
        out.close()
    final, _ = _fs(spark, f"{base}/{number:012d}-{load_id}.json")
    if not fs.rename(temp, final):
        raise RuntimeError(f"the commit of load {load_id} could not be put in place")


def committed(spark: SparkSession, sink_dir: str, load_id: str) -> dict[str, int] | None:
    """Rows by table of a committed load, None of any other."""
    return next((c["tables"] for c in commits(spark, sink_dir) if c["load_id"] == load_id), None)


def current(spark: SparkSession, sink_dir: str) -> dict[str, str]:
    """Folder of each table's newest committed generation."""
    return {name: f"{load_dir(sink_dir, c['load_id'])}/{name}" for c in commits(spark, sink_dir) for name in c["tables"]}


def retire(spark: SparkSession, sink_dir: str) -> list[str]:
    """Delete the folders of committed loads that no table is read from any more; returns their ids."""
    used = {path.rsplit("/", 2)[1] for path in current(spark, sink_dir).values()}
    gone = []
    for c in commits(spark, sink_dir):
        folder, fs = _fs(spark, load_dir(sink_dir, c["load_id"]))
        if c["load_id"] not in used and fs.exists(folder):
            fs.delete(folder, True)
            gone.append(c["load_id"])
    return gone
