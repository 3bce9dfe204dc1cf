"""Checks of business-vault SQL before anything is written.

A virtual source may read tables that the same run is about to create. The check analyses
its text in a session of its own, where every table of the model is an empty relation
with the model's columns and types; sources are the real ones, so Spark's analyzer finds
unknown tables and columns, and the stage projection finds unmapped columns. No job runs.

The relations that a text names also say which tables have to be loaded before it.
"""

from __future__ import annotations

import re

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.types import StructType

from ..operators.stage import stage
from ..run import Run
from ..sinks.tables import table_columns
from ..spec import Effectivity, Layer, VaultModel

_TYPES = {"TIMESTAMP_NTZ": T.TimestampNTZType(), "INT": T.IntegerType()}


def relations(spark: SparkSession, sql: str) -> set[tuple[str, ...]]:
    """Names of the relations in a query text, lower-case, as Spark's parser reads them (subqueries and CTEs too)."""
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql.strip().rstrip(";")).toString()
    return {tuple(part.strip(" `").lower() for part in found.split(",")) for found in re.findall(r"UnresolvedRelation \[([^\]]*)\]", plan)}


def _layer_entities(layer: Layer) -> dict:
    return {e.name: e for e in [*layer.entities(), *layer.effs.values()]}


def _table_type(entity, layer: Layer, width: int) -> StructType:
    link = layer.links[entity.link] if isinstance(entity, Effectivity) else None
    return StructType([T.StructField(c, _TYPES.get(t, T.StringType())) for c, t in table_columns(entity, width, link)])


def _tables(model: VaultModel) -> dict[str, tuple]:
    return {name.lower(): (e, layer) for layer in (model.rv, model.bv) for name, e in _layer_entities(layer).items()}


def vault_reads(spark: SparkSession, model: VaultModel) -> dict[str, set[str]]:
    """Per business-vault entity: the tables of the model that its virtual sources name."""
    known = {name: e.name for name, (e, _) in _tables(model).items()}
    schema = model.vault_schema.lower()
    out = {}
    for name, e in _layer_entities(model.bv).items():
        spec = model.bv.links[e.link] if isinstance(e, Effectivity) else e
        named = {r for src in spec.sources for r in relations(spark, src.sql)}
        out[name] = {known[r[-1]] for r in named if len(r) >= 2 and r[-2] == schema and r[-1] in known} - {name}
    return out


def check_virtual_sources(spark: SparkSession, model: VaultModel, run: Run) -> None:
    """Raise ValueError, naming the entity, if a business-vault text can't be analysed or staged."""
    tables, schema = _tables(model), model.vault_schema
    trial = spark.newSession()
    for name, e in _layer_entities(model.bv).items():
        spec = model.bv.links[e.link] if isinstance(e, Effectivity) else e
        for src in spec.sources:
            try:
                text = src.sql.strip().rstrip(";")
                for found in relations(spark, text):
                    table = found[-1]
                    if len(found) >= 2 and found[-2] == schema.lower() and table in tables:
                        entity, layer = tables[table]
                        trial.createDataFrame([], _table_type(entity, layer, run.max_varchar)).createOrReplaceTempView(table)
                        text = re.sub(rf"(?<![\w`.])`?{re.escape(schema)}`?\s*\.\s*`?{re.escape(table)}`?(?![\w`])",
                                      f"`{table}`", text, flags=re.IGNORECASE)
                    elif len(found) == 1 and any(t.name.lower() == table for t in spark.catalog.listTables() if t.isTemporary):
                        trial.createDataFrame([], spark.table(table).schema).createOrReplaceTempView(table)
                stage(trial.sql(text), spec, src, run, True)
            except Exception as problem:
                raise ValueError(f"{name}, virtual source {src.name}: {problem}") from problem
            finally:
                for view in trial.catalog.listTables():
                    if view.isTemporary:
                        trial.catalog.dropTempView(view.name)
