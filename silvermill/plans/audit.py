"""One record per job run."""

from __future__ import annotations

import logging
import uuid
from dataclasses import dataclass, field, fields
from datetime import datetime, timezone

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)

RUN_SCHEMA = (
    "job_run_id string, job string, status string, process_date string, owner string, repo string, "
    "started_at timestamp, finished_at timestamp, pages bigint, miscounted_pages bigint, corrupt_pages bigint, "
    "misfit_pages bigint, misfits map<string,bigint>, records bigint, rows_written map<string,bigint>, stream string, batch bigint, error string"
)


@dataclass
class Run:
    """A run in progress; as a context manager it is appended to the audit table when it ends,
    with status SUCCESS, or FAILED and the error."""

    spark: SparkSession
    path: str
    job: str
    process_date: str | None = None
    owner: str | None = None
    repo: str | None = None
    job_run_id: str = field(default_factory=lambda: str(uuid.uuid4()))
    status: str = "STARTED"
    started_at: datetime = field(default_factory=lambda: datetime.now(timezone.utc))
    finished_at: datetime | None = None
    pages: int | None = None
    miscounted_pages: int | None = None
    corrupt_pages: int | None = None
    misfit_pages: int | None = None
    misfits: dict[str, int] = field(default_factory=dict)  # by field: values that its type cannot hold
    records: int | None = None
    rows_written: dict[str, int] = field(default_factory=dict)
    stream: str | None = None
    batch: int | None = None
    error: str | None = None

    def __enter__(self) -> Run:
        log.info("job=%s job_run_id=%s status=%s", self.job, self.job_run_id, self.status)
        return self

    def __exit__(self, _, error, __) -> None:
        self.status = "SUCCESS" if error is None else "FAILED"
        self.error = None if error is None else str(error)
        self.finished_at = datetime.now(timezone.utc)
        facts = {f.name: getattr(self, f.name) for f in fields(self) if f.name not in ("spark", "path")}
        log.info("%s", facts)
        columns = {k: _map(v) if isinstance(v, dict) else F.lit(v) for k, v in facts.items()}
        kinds = T.StructType.fromDDL(RUN_SCHEMA)
        row = self.spark.range(1, numPartitions=1).select(*[columns[f.name].cast(f.dataType).alias(f.name) for f in kinds])
        row.write.mode("append").json(self.path)


def _map(counts: dict[str, int]) -> Column:
    return F.create_map(*(F.lit(x) for pair in counts.items() for x in pair))


def read_runs(spark: SparkSession, path: str):
    return spark.read.schema(RUN_SCHEMA).json(path)
