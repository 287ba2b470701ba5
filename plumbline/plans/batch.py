"""The batch job: from stored casts to flags, upload documents, alerts and advanced stages.

Each output is a folder below ``out``. The flags are written first and read again for the others, so the run
itself happens once, and every step overwrites its own folder: a job that is started again after a failure gives
the same files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from plumbline.config import QCConfig
from plumbline.functions.density import derive_density
from plumbline.operators import aggregate
from plumbline.plans.alerts import alerts
from plumbline.plans.run import run_qc
from plumbline.plans.selection import advance_stage, rows_for_casts
from plumbline.schema import CAST, MEASURED_AT, PK, level1, level2
from plumbline.sources.files import JSON_FILES, flags_json, job_folder


def quality_controlled(
    data: DataFrame, casts: DataFrame, stations: DataFrame, metadata: DataFrame | None = None,
    manual_qc: DataFrame | None = None, grey: DataFrame | None = None, cfg: QCConfig | None = None,
    time: str = MEASURED_AT, max_rows: int | None = None,
) -> DataFrame:
    """Rows of the given casts with density derived from salinity, temperature and pressure, and all flags."""
    rows = derive_density(rows_for_casts(data, casts))
    return run_qc(rows, stations, metadata, manual_qc, grey, cfg, time, max_rows)


def upload_rows(qced: DataFrame, original: list[str], cfg: QCConfig | None = None) -> DataFrame:
    """The original columns and the flags of every tested variable, in upload form."""
    flags = [c for v in (cfg or QCConfig()).tested() for c in (level1(v), level2(v))]
    wanted = dict.fromkeys([*original, *flags])
    return aggregate.finalize_flags(qced.select(*[f"`{c}`" for c in wanted if c in qced.columns]))


def run_batch(
    data: DataFrame, casts: DataFrame, stations: DataFrame, out: str, metadata: DataFrame | None = None,
    manual_qc: DataFrame | None = None, grey: DataFrame | None = None, cfg: QCConfig | None = None,
    time: str = MEASURED_AT, min_date: str | None = None, max_rows: int | None = None,
) -> None:
    """Write ``flags``, ``documents``, ``alerts`` and ``casts`` of the selected casts. Intermediate tables go at the end."""
    spark = data.sparkSession
    with job_folder(spark):
        qced = quality_controlled(data, casts, stations, metadata, manual_qc, grey, cfg, time, max_rows)
        qced.write.mode("overwrite").parquet(f"{out}/flags")
        done = spark.read.schema(qced.schema).parquet(f"{out}/flags")
        taken = advance_stage(casts)
        with_rows = taken.join(done.select(CAST).distinct(), CAST, "left_semi")
        flags_json(with_rows, upload_rows(done, data.columns, cfg), sized=done.select(CAST, PK)).write.mode(
            "overwrite").options(**JSON_FILES).json(f"{out}/documents")
        alerts(done, taken, min_date).write.mode("overwrite").parquet(f"{out}/alerts")
        taken.write.mode("overwrite").parquet(f"{out}/casts")
