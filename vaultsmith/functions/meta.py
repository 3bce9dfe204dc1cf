"""The six load-metadata columns every stage and vault table carries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

META_COLUMNS = ["dv_loadts", "dv_appts", "dv_recsrc", "dv_tenant", "dv_bkeycode", "dv_taskid"]
HASHDIFF = "dv_hashdiff"
SUBSEQ = "dv_subseq"
STARTTS = "dv_startts"
ENDTS = "dv_endts"


def stage_meta(run, recsrc: str, tenant: str, bkeycode: str, task_id: str) -> list[Column]:
    """Meta columns of a staged row, in table order."""
    return [
        run.load_ts_col().alias("dv_loadts"),
        run.applied_ts_col().alias("dv_appts"),
        F.lit(recsrc).alias("dv_recsrc"),
        F.lit(tenant).alias("dv_tenant"),
        F.lit(bkeycode).alias("dv_bkeycode"),
        F.lit(task_id).alias("dv_taskid"),
    ]


def load_meta(run, task_id: str, keep_loadts: bool = False) -> list[Column]:
    """Meta columns of a loaded row: a fresh load time (unless kept from the
    stage), the staged applied time / source / tenant / code, the load task id."""
    return [
        F.col("dv_loadts") if keep_loadts else run.load_ts_col().alias("dv_loadts"),
        F.col("dv_appts"),
        F.col("dv_recsrc"),
        F.col("dv_tenant"),
        F.col("dv_bkeycode"),
        F.lit(task_id).alias("dv_taskid"),
    ]
