"""Small builders for the oracle SQL text (ANSI SQL as DuckDB runs it).

They spell out, in plain SQL, the same key / hash expressions the Spark
column builders produce, so each oracle query reads like the loader's own
``INSERT ... SELECT``.
"""

from __future__ import annotations

# Fixed values, written out here so that the oracles do not share the library's.
ZERO_KEY = "-1"
KEY_DELIMITER = "|"
MAX_VARCHAR = 256


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def ts(s: str) -> str:
    return f"TIMESTAMP {q(s)}"


def txt(expr: str) -> str:
    return f"CAST({expr} AS VARCHAR)"


def bounded(expr: str, width: int = MAX_VARCHAR) -> str:
    return f"substring({txt(expr)}, 1, {width})"


def kt(expr: str, width: int = MAX_VARCHAR) -> str:
    """Key text: coalesce(trim(x::varchar(256)), '-1')."""
    return f"coalesce(trim({bounded(expr, width)}), {q(ZERO_KEY)})"


def whole_kt(expr: str) -> str:
    """Key text of the strict mode: never cut."""
    return f"coalesce(trim({txt(expr)}), {q(ZERO_KEY)})"


def newest(appts: str = "dv_appts", loadts: str = "dv_loadts") -> str:
    """A value that sorts by (applied, load) time, NULL as the newest."""
    return f"row(coalesce({appts}, TIMESTAMP 'infinity'), coalesce({loadts}, TIMESTAMP 'infinity'))"


def cws(parts: list[str]) -> str:
    return f"concat_ws({q(KEY_DELIMITER)}, {', '.join(parts)})"


def hk(parts: list[str], tenant: str = "default", code: str = "default") -> str:
    return f"md5({cws([q(tenant), q(code), *parts])})"


def md5_plain(parts: list[str]) -> str:
    return f"md5({cws(parts)})"


def meta(load_ts: str, recsrc: str, task: str, applied_ts: str | None = None,
         tenant: str = "default", code: str = "default") -> str:
    return ", ".join([
        f"{ts(load_ts)} AS dv_loadts",
        f"{ts(applied_ts or load_ts)} AS dv_appts",
        f"{q(recsrc)} AS dv_recsrc",
        f"{q(tenant)} AS dv_tenant",
        f"{q(code)} AS dv_bkeycode",
        f"{q(task)} AS dv_taskid",
    ])


def load_meta(load_ts: str, task: str, alias: str = "s") -> str:
    return ", ".join([
        f"{ts(load_ts)} AS dv_loadts",
        f"{alias}.dv_appts",
        f"{alias}.dv_recsrc",
        f"{alias}.dv_tenant",
        f"{alias}.dv_bkeycode",
        f"{q(task)} AS dv_taskid",
    ])
