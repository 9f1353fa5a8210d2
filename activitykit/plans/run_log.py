"""Append-only run log, one record per phase, under ``<base>/run_id=<id>``, and its history as a table.

Each record is one JSON-lines file (a few hundred bytes of driver metadata,
written through the session's Hadoop FileSystem without a Spark job); fields left
unset are absent from the text. The history is the folder read back by Spark with
the fixed schema, in phase order.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from activitykit.plans.preflight import run_path
from activitykit.schema import RUN_LOG_SCHEMA
from activitykit.sources import fs

LOG_FIELDS = {f.name for f in RUN_LOG_SCHEMA.fields}


def _now() -> str:
    return dt.datetime.now(dt.timezone.utc).isoformat().replace("+00:00", "Z")


class RunLog:
    def __init__(self, spark: SparkSession, base: str, run_id: str, target_date: str, started_at: str | None = None, append: bool = False):
        self.spark = spark
        self.path = run_path(base, run_id)
        self.run_id = run_id
        self.target_date = target_date
        self.started_at = started_at or _now()
        self._seq = max(map(_seq_of, fs.list_files(spark, self.path)), default=0) if append else 0

    def log(self, status: str, **fields) -> dict:
        unknown = set(fields) - LOG_FIELDS
        if unknown:
            raise ValueError(f"unknown run-log fields: {sorted(unknown)}")
        self._seq += 1
        record = {name: None for name in LOG_FIELDS}
        record.update(
            {k: v for k, v in fields.items() if v is not None and v != [] and v != {}},
            run_id=self.run_id,
            target_date=self.target_date,
            status=status,
            started_at=self.started_at,
            updated_at=_now(),
            seq=self._seq,
        )
        text = json.dumps({f.name: record[f.name] for f in RUN_LOG_SCHEMA.fields if record[f.name] is not None})
        fs.write_text(self.spark, f"{self.path}/record-{self._seq:04d}-{uuid.uuid4().hex[:8]}.json", text + "\n")
        return record


def _seq_of(name: str) -> int:
    parts = name.split("-")
    return int(parts[1]) if len(parts) == 3 and parts[0] == "record" else 0


def journal(spark: SparkSession, base: str, run_id: str) -> dict[str, dict]:
    """status → the fields of its last record, read without a Spark job (a record a phase, a few hundred bytes)."""
    path = run_path(base, run_id)
    found: dict[str, dict] = {}
    for name in sorted(fs.list_files(spark, path), key=_seq_of):
        if _seq_of(name):
            record = json.loads(fs.read_text(spark, f"{path}/{name}"))
            found[record["status"]] = record
    return found


def read_run_log(spark: SparkSession, base: str, run_id: str) -> DataFrame:
    """The run's records in phase order."""
    return spark.read.schema(RUN_LOG_SCHEMA).json(run_path(base, run_id)).orderBy(F.col("seq"))


# ----------------------------------------------------------------------------
# History over runs: the records of all runs as one table, compacted as they age
# ----------------------------------------------------------------------------
COMPACTED, GENERATION = "_compacted", "generation="


def _generation(spark: SparkSession, base: str) -> int:
    """The newest whole compacted generation; 0 if there is none."""
    root = f"{base.rstrip('/')}/{COMPACTED}"
    numbers = [int(n.removeprefix(GENERATION)) for n in fs.list_dirs(spark, root) if n.startswith(GENERATION)]
    return max((n for n in numbers if fs.exists(spark, f"{root}/{GENERATION}{n}/_SUCCESS")), default=0)


def _generation_path(base: str, number: int) -> str:
    return f"{base.rstrip('/')}/{COMPACTED}/{GENERATION}{number}"


def _loose(spark: SparkSession, base: str) -> DataFrame | None:
    """The records that still lie as one file a phase."""
    runs = [f"{base.rstrip('/')}/{n}" for n in fs.list_dirs(spark, base) if n.startswith("run_id=")]
    runs = [r for r in runs if any(_seq_of(name) for name in fs.list_files(spark, r))]
    return spark.read.schema(RUN_LOG_SCHEMA).json([f"{r}/record-*.json" for r in runs]) if runs else None


def read_history(spark: SparkSession, base: str) -> DataFrame:
    """Every record of every run, a row a phase; ``invalid_reason_summary`` is a map column.

    Compacted runs are read from Parquet, the others from their record files. A run that lies in
    both (a compaction that stopped before it removed the files) counts once.
    """
    number, loose = _generation(spark, base), _loose(spark, base)
    if not number:
        return loose if loose is not None else spark.createDataFrame([], RUN_LOG_SCHEMA)
    old = spark.read.schema(RUN_LOG_SCHEMA).parquet(_generation_path(base, number))
    if loose is None:
        return old
    return old.unionByName(loose.join(old.select("run_id").distinct(), "run_id", "left_anti").select(*old.columns))


def compact_history(spark: SparkSession, base: str) -> list[str]:
    """Moves the records of the runs that succeeded into the next Parquet generation; returns those run ids.

    The generation is written whole before any record file goes, and the run's folder stays, so its
    id stays used. Runs that failed keep their files: they may be resumed.
    """
    loose = _loose(spark, base)
    if loose is None:
        return []
    done = [r[0] for r in loose.where(F.col("status") == "SUCCESS").select("run_id").distinct().collect()]  # a row a run
    if not done:
        return []
    number = _generation(spark, base)
    history = read_history(spark, base).join(spark.createDataFrame([(r,) for r in done], "_done string"), F.col("run_id") == F.col("_done"), "left_semi")
    if number:
        history = history.unionByName(spark.read.schema(RUN_LOG_SCHEMA).parquet(_generation_path(base, number))).dropDuplicates(["run_id", "seq"])
    history.coalesce(1).write.mode("overwrite").parquet(_generation_path(base, number + 1))
    for run_id in done:
        path = run_path(base, run_id)
        fs.create_new(spark, f"{path}/compacted.json", json.dumps({"generation": number + 1}) + "\n")
        for name in fs.list_files(spark, path):
            if _seq_of(name):
                fs.delete(spark, f"{path}/{name}")
    if number:
        fs.delete(spark, _generation_path(base, number))
    return sorted(done)
