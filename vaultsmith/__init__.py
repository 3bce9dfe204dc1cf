"""vaultsmith — a Spark-native data-vault loader.

Declare hubs, links and satellites (YAML or Python), stage source tables or
Spark SQL queries into hash-keyed rows, and append to each vault table
exactly the rows it still lacks — all as DataFrame joins, aggregates and
windows planned by Catalyst.
"""

from .run import REFERENCE, STRICT, Run
from .spec import Hub, Layer, Link, Sat, Source, VaultModel
from .operators.stage import stage, stage_bv_hub, stage_bv_link, stage_bv_sat, stage_hub, stage_link, stage_sat
from .operators.load import (
    first_source_wins,
    hub_delta,
    link_delta,
    sat_delta,
    sat_delta_ckey,
    sat_delta_multiactive,
    sat_delta_regular,
)

__all__ = [
    "REFERENCE", "STRICT", "Run", "Hub", "Layer", "Link", "Sat", "Source", "VaultModel",
    "stage", "stage_hub", "stage_link", "stage_sat", "stage_bv_hub", "stage_bv_link", "stage_bv_sat",
    "first_source_wins", "hub_delta", "link_delta", "sat_delta", "sat_delta_ckey",
    "sat_delta_multiactive", "sat_delta_regular",
]
