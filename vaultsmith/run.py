"""Run-level settings: the timestamps and task ids one vault run stamps on
every row, and which semantics to follow.

Both timestamps are literals fixed once per run, so every query of a run is
deterministic and a rerun of the same run is reproducible.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import Column

from .functions.keys import MAX_VARCHAR, timestamp_literal

REFERENCE = "reference"
STRICT = "strict"


@dataclass(frozen=True)
class Run:
    """One vault run.

    ``semantics="reference"`` reproduces the loader's SQL exactly, quirks
    included; ``"strict"`` follows its documented intent (see README).
    """

    load_ts: _dt.datetime | str
    applied_ts: _dt.datetime | str | None = None
    semantics: str = REFERENCE
    task_prefix: str = ""
    max_varchar: int = MAX_VARCHAR

    def __post_init__(self):
        if self.semantics not in (REFERENCE, STRICT):
            raise ValueError(f"semantics must be {REFERENCE!r} or {STRICT!r}")

    @classmethod
    def now(cls, **kw) -> "Run":
        ts = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        return cls(load_ts=ts, **kw)

    @property
    def strict(self) -> bool:
        return self.semantics == STRICT

    @property
    def applied(self) -> _dt.datetime | str:
        # The applied time defaults to the load time ("now" for the run).
        return self.load_ts if self.applied_ts is None else self.applied_ts

    def load_ts_col(self) -> Column:
        return timestamp_literal(self.load_ts)

    def applied_ts_col(self) -> Column:
        return timestamp_literal(self.applied)

    def stage_task(self, target: str) -> str:
        return f"{self.task_prefix}stage_{target}"

    def load_task(self, target: str) -> str:
        return f"{self.task_prefix}load_{target}"
