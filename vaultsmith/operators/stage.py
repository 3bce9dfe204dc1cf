"""Stagers: one projection per (source, target) pair.

A stage is a pure, map-only projection of the source DataFrame: cast, trim,
zero-key, hash, add the meta columns. There is no shuffle; Catalyst prunes
the source scan to the referenced columns and keeps the whole projection in
one codegen stage.

Raw-vault sources are tables; business-vault sources are Spark SQL text
(``stage_bv_*``), which may join source and vault tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import (
    bounded_text,
    business_key,
    hash_key,
    hashdiff,
    key_text,
    plain_hash,
    output_text,
    text_of,
    whole_key_text,
    zero_key,
)
from ..functions.meta import HASHDIFF, stage_meta
from ..run import Run
from ..spec import Hub, Link, Sat, Source
from ..sources.tables import find_column, virtual_source


def _value(df: DataFrame, name: str) -> Column:
    """Text of a source column, or of a SQL expression if no such column."""
    actual = find_column(df, name)
    return text_of(df, actual) if actual is not None else F.expr(name).cast("string")


def _key(df: DataFrame, name: str, run: Run) -> Column:
    """Normalised key part: reference semantics cut it, strict ones raise if it is too wide."""
    return (whole_key_text if run.strict else key_text)(_value(df, name), run.max_varchar)


def _output(df: DataFrame, name: str) -> Column:
    """Like ``_value``, as the database prints it inside a concatenation."""
    actual = find_column(df, name)
    return output_text(df, actual) if actual is not None else F.expr(name).cast("string")


def _require(df: DataFrame, names, what: str) -> None:
    missing = [n for n in names if find_column(df, n) is None]
    if missing:
        raise ValueError(f"{what}: source has no column(s) {missing}; columns are {df.columns}")


# ------------------------------------------------------------------- hubs
def stage_hub(df: DataFrame, hub: Hub, src: Source, run: Run) -> DataFrame:
    """hk = md5(tenant|bkeycode|key...), bk = key|key..., meta."""
    _require(df, [b for b in src.bks if b.isidentifier()], f"hub {hub.name}")
    parts = [_key(df, b, run) for b in src.bks]
    return df.select(
        hash_key(parts, src.tenant, src.bkeycode).alias(hub.hk),
        business_key(parts).alias(hub.bk),
        *stage_meta(run, src.name, src.tenant, src.bkeycode, run.stage_task(hub.name)),
    )


# ------------------------------------------------------------------ links
def _hub_key_columns(df: DataFrame, link: Link, src: Source, run: Run, business: bool) -> dict[str, list[Column]]:
    """Normalised key parts per hub key, in ``hks`` order.

    A hub key fed by several source columns (a composite key) gets one hash
    over all of them, so it equals the hub's own hash key.
    """
    by_key: dict[str, list[str]] = {}
    for column, key in src.bks.items():
        by_key.setdefault(key, []).append(column)
    out = {}
    for key in link.hks:
        cols = by_key.get(key, [])
        if business:
            if not cols:
                raise ValueError(f"link {link.name}: source {src.name} maps no column to {key}")
            _require(df, cols, f"link {link.name}")
            out[key] = [_key(df, c, run) for c in cols]
        elif not cols or (not run.strict and find_column(df, cols[0]) is None):
            # No mapping, or the (first) mapped column is absent: one zero key.
            out[key] = [zero_key()]
        else:
            out[key] = [
                _key(df, c, run) if find_column(df, c) is not None else zero_key()
                for c in cols
            ]
    return out


def stage_link(df: DataFrame, link: Link, src: Source, run: Run, business: bool = False) -> DataFrame:
    """hk = md5(tenant|bkeycode|all hub-key parts), one hash per hub key,
    child keys (zero key when the source lacks the column), meta.

    Business vault (``business=True``): every mapped column must exist, and in
    reference semantics the hub keys are unsalted ``md5(key)``.
    """
    parts = _hub_key_columns(df, link, src, run, business)
    flat = [p for key in link.hks for p in parts[key]]
    hub_cols = []
    for key in link.hks:
        if business and not run.strict:
            hub_cols.append(plain_hash(parts[key]).alias(key))
        else:
            hub_cols.append(hash_key(parts[key], src.tenant, src.bkeycode).alias(key))
    ck_cols = []
    for column, target in link.cks.items():
        if find_column(df, column) is not None:
            ck_cols.append(_key(df, column, run).alias(target))
        elif business:
            raise ValueError(f"link {link.name}: virtual source {src.name} has no child key column {column}")
        else:
            ck_cols.append(zero_key().alias(target))
    return df.select(
        hash_key(flat, src.tenant, src.bkeycode).alias(link.hk),
        *hub_cols,
        *ck_cols,
        *stage_meta(run, src.name, src.tenant, src.bkeycode, run.stage_task(link.name)),
    )


# ------------------------------------------------------------- satellites
def attribute_sources(sat: Sat, src: Source, strict: bool) -> list[tuple[str, str]]:
    """(target attribute, source column) pairs in insertion order.

    Reference semantics insert by position: the i-th *mapped* source column
    (map order, one per distinct target, last mapping wins) fills the i-th
    target attribute of ``sat.attrs``, whatever its name. Strict semantics
    match by name.
    """
    inverse: dict[str, str] = {}
    for column, target in src.attrs.items():
        inverse[target] = column
    if len(inverse) != len(sat.attrs):
        raise ValueError(
            f"sat {sat.name}: source {src.name} maps {len(inverse)} attributes, the satellite has {len(sat.attrs)}"
        )
    if strict:
        unknown = sorted(set(inverse) - set(sat.attrs))
        if unknown:
            raise ValueError(f"sat {sat.name}: source {src.name} maps to unknown attributes {unknown}")
        return [(t, inverse[t]) for t in sat.attrs]
    return list(zip(sat.attrs, inverse.values()))


def stage_sat(df: DataFrame, sat: Sat, src: Source, run: Run, business: bool = False) -> DataFrame:
    """hk, child keys, attributes, hashdiff, meta.

    Reference semantics: raw-vault child keys are always the zero key and
    attributes / hashdiff are untrimmed; business-vault child keys are raw and
    its hashdiff hashes trimmed, bounded texts. Strict semantics: child keys
    zero-keyed from the real column, attributes trimmed, NULLs kept in place
    in the hashdiff.
    """
    _require(df, [b for b in src.bks if b.isidentifier()], f"sat {sat.name}")
    key_parts = [_key(df, b, run) for b in src.bks]
    ck_cols = []
    for column, target in sat.cks.items():
        present = find_column(df, column) is not None
        if run.strict:
            ck = _key(df, column, run) if present else zero_key()
        elif business:
            if not present:
                raise ValueError(f"sat {sat.name}: virtual source {src.name} has no child key column {column}")
            ck = _value(df, column)
        else:
            ck = zero_key()
        ck_cols.append(ck.alias(target))

    pairs = attribute_sources(sat, src, run.strict)
    _require(df, [c for _, c in pairs if c.isidentifier()], f"sat {sat.name}")
    raw = [_value(df, c) for _, c in pairs]
    if run.strict:
        # Trimmed, never cut: the VARCHAR columns of the table reject what is too wide.
        values = [F.trim(v) for v in raw]
        diff = hashdiff(values, null_as_empty=True)
    elif business:
        values = raw
        diff = hashdiff([F.trim(bounded_text(v, run.max_varchar)) for v in raw])
    else:
        values = raw
        diff = hashdiff([_output(df, c) for _, c in pairs])
    return df.select(
        hash_key(key_parts, src.tenant, src.bkeycode).alias(sat.hk),
        *ck_cols,
        *[v.alias(t) for v, (t, _) in zip(values, pairs)],
        diff.alias(HASHDIFF),
        *stage_meta(run, src.name, src.tenant, src.bkeycode, run.stage_task(sat.name)),
    )


# ---------------------------------------------------------- business vault
def stage_bv_hub(spark: SparkSession, hub: Hub, src: Source, run: Run) -> DataFrame:
    return stage_hub(virtual_source(spark, src.sql), hub, src, run)


def stage_bv_link(spark: SparkSession, link: Link, src: Source, run: Run) -> DataFrame:
    return stage_link(virtual_source(spark, src.sql), link, src, run, business=True)


def stage_bv_sat(spark: SparkSession, sat: Sat, src: Source, run: Run) -> DataFrame:
    return stage_sat(virtual_source(spark, src.sql), sat, src, run, business=True)


def stage(df: DataFrame, entity: Hub | Link | Sat, src: Source, run: Run, business: bool = False) -> DataFrame:
    """Dispatch on the entity kind."""
    if isinstance(entity, Hub):
        return stage_hub(df, entity, src, run)
    if isinstance(entity, Link):
        return stage_link(df, entity, src, run, business)
    return stage_sat(df, entity, src, run, business)
