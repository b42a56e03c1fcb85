"""What has been done of a run, so that one that stopped goes on where it stopped.

A run is a day and a start time.  After each of its steps a small record is put into the ledger's
folder, by one rename: the step, the versions of the tables it read and wrote, and what it returned.
Called again with the same day and time, a run passes over the steps recorded; a step that died
before its record is repeated, which the writers allow.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from pricepanel.sinks import manifest as M, tables as K

RECORD = "as_of date, run_ts timestamp, place int, step string, read map<string,bigint>, wrote map<string,bigint>, result string"


class Ledger:
    """The records of one run; without a folder nothing is recorded and every step runs."""

    def __init__(self, spark: SparkSession, path: str | None, as_of: dt.date, run_ts: dt.datetime, tables: Mapping[str, str]):
        self.spark, self.path, self.tables = spark, path, tables
        self.run = {"as_of": as_of.isoformat(), "run_ts": run_ts.isoformat()}
        self.folder = f"{path}/{as_of.isoformat()}/{run_ts:%Y%m%dT%H%M%S%f}"
        self.place = 0

    def versions(self, names: list[str]) -> dict[str, int]:
        return {n: K.version(self.spark, self.tables[n]) for n in names}

    def step(self, name: str, reads: list[str], writes: list[str], work: Callable[[], object]) -> object:
        """Run a step unless it is recorded; what it returned then or now (dates, in lists too)."""
        self.place += 1
        if self.path is None:
            return work()
        at = f"{self.folder}/{self.place:03d}.json"
        text = M.get_text(self.spark, at)
        if text is not None:
            done = json.loads(text)
            if done["step"] != name:
                raise ValueError(f"the ledger has {done['step']} as step {self.place} of this run, not {name}")
            return _read(done["result"])
        before = self.versions(reads)
        result = work()
        M.put_text(self.spark, at, json.dumps({**self.run, "place": self.place, "step": name, "read": before, "wrote": self.versions(writes), "result": _shown(result)}))
        return result


def _shown(result: object):
    if isinstance(result, (list, tuple)):
        return [_shown(x) for x in result]
    return result.isoformat() if isinstance(result, dt.date) else result


def _read(result: object):
    if isinstance(result, list):
        return [_read(x) for x in result]
    return dt.date.fromisoformat(result) if isinstance(result, str) else result


def records(spark: SparkSession, path: str) -> DataFrame:
    """All records: ``RECORD``."""
    return spark.read.schema(RECORD).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").json(path)
