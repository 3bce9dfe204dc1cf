"""Declarative vault model: hubs, links and satellites with their sources.

A model comes from YAML (``VaultModel.from_yaml``) or is built in Python from
the dataclasses below. YAML layout::

    connection: {schemas: {source: source, stage: stage, edwh: edwh}}
    rv:                      # raw vault: sources are tables
      hubs:  {h_customer: {hk: hk_customer, bk: customer_bk,
                           src: {customer: {bks: [c_custkey]}}}}
      links: {l_order: {hk: hk_order_customer, hks: [hk_order, hk_customer],
                        cks: {o_linenumber: linenumber},
                        src: {orders: {bks: {o_orderkey: hk_order,
                                             o_custkey: hk_customer}}}}}
      sats:  {s_customer: {hk: hk_customer, attrs: [name, balance],
                           multiactive: false,
                           src: {customer: {bks: [c_custkey],
                                            attrs: {c_name: name,
                                                    c_acctbal: balance}}}}}
      effs:  {es_order: {link: l_order, drivers: [hk_order]}}
    bv:                      # business vault: each source also has ``sql``
      ...                    # and an entity may list ``dependencies``

Maps keep their YAML order; order matters for hashing.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from .functions.keys import DEFAULT_CODE


@dataclass
class Source:
    """One source feeding a target.

    ``bks`` is a list of key columns for hubs and satellites and a map
    ``source column -> hub key name`` for links. ``attrs`` maps a source
    column to a target attribute. ``sql`` makes it a virtual (business-vault)
    source; ``name`` is then only the record-source label.
    """

    name: str
    bks: list[str] | dict[str, str] = field(default_factory=list)
    attrs: dict[str, str] = field(default_factory=dict)
    tenant: str = DEFAULT_CODE
    bkeycode: str = DEFAULT_CODE
    sql: str | None = None

    def __post_init__(self):
        # An empty tenant / code falls back to the default, like a missing one.
        self.tenant = self.tenant or DEFAULT_CODE
        self.bkeycode = self.bkeycode or DEFAULT_CODE


@dataclass
class Hub:
    name: str
    hk: str
    bk: str
    sources: list[Source]
    dependencies: list[str] = field(default_factory=list)
    kind: str = "hub"


@dataclass
class Link:
    name: str
    hk: str
    hks: list[str]
    sources: list[Source]
    cks: dict[str, str] = field(default_factory=dict)  # source column -> target child key
    dependencies: list[str] = field(default_factory=list)
    kind: str = "link"


@dataclass
class Sat:
    name: str
    hk: str
    attrs: list[str]
    sources: list[Source]
    cks: dict[str, str] = field(default_factory=dict)
    multiactive: bool = False
    dependencies: list[str] = field(default_factory=list)
    kind: str = "sat"

    @property
    def variant(self) -> str:
        if self.cks:
            return "ckey"
        return "multiactive" if self.multiactive else "regular"


@dataclass
class Effectivity:
    """Effectivity satellite of ``link``: validity periods of its rows, driven
    by the hub key(s) ``drivers`` (names from the link's ``hks``)."""

    name: str
    link: str
    drivers: list[str]
    dependencies: list[str] = field(default_factory=list)
    kind: str = "effectivity"


@dataclass
class Layer:
    hubs: dict[str, Hub] = field(default_factory=dict)
    links: dict[str, Link] = field(default_factory=dict)
    sats: dict[str, Sat] = field(default_factory=dict)
    effs: dict[str, Effectivity] = field(default_factory=dict)

    def entities(self) -> list[Hub | Link | Sat]:
        return [*self.hubs.values(), *self.links.values(), *self.sats.values()]


@dataclass
class VaultModel:
    rv: Layer = field(default_factory=Layer)
    bv: Layer = field(default_factory=Layer)
    source_schema: str = "source"
    stage_schema: str = "stage"
    vault_schema: str = "edwh"

    # ------------------------------------------------------------------ io
    @classmethod
    def from_yaml(cls, text_or_path: str) -> "VaultModel":
        import os

        import yaml

        if "\n" not in text_or_path and os.path.exists(text_or_path):
            with open(text_or_path) as fh:
                text_or_path = fh.read()
        return cls.from_dict(yaml.safe_load(text_or_path) or {})

    @classmethod
    def from_dict(cls, conf: dict[str, Any]) -> "VaultModel":
        schemas = ((conf.get("connection") or {}).get("schemas")) or {}
        model = cls(
            rv=_layer(conf.get("rv") or {}, virtual=False),
            bv=_layer(conf.get("bv") or {}, virtual=True),
            source_schema=schemas.get("source", "source"),
            stage_schema=schemas.get("stage", "stage"),
            vault_schema=schemas.get("edwh", "edwh"),
        )
        return model

    # ------------------------------------------------------------ checks
    def validate(self) -> "VaultModel":
        errors = []
        for layer_name, layer in (("rv", self.rv), ("bv", self.bv)):
            for ent in layer.entities():
                errors += [f"{layer_name}.{ent.name}: {e}" for e in validate_entity(ent, layer_name == "bv")]
            for eff in layer.effs.values():
                link = layer.links.get(eff.link)
                if link is None:
                    errors.append(f"{layer_name}.{eff.name}: unknown link {eff.link}")
                elif set(eff.drivers) - set(link.hks) or not eff.drivers:
                    errors.append(f"{layer_name}.{eff.name}: drivers must be hub keys of {eff.link}")
        if errors:
            raise ValueError("invalid vault model:\n  " + "\n  ".join(errors))
        return self


def validate_entity(ent: Hub | Link | Sat, virtual: bool) -> list[str]:
    """Static checks of one entity; column checks happen at staging time."""
    errs = []
    if not ent.sources:
        errs.append("no sources")
    for src in ent.sources:
        if virtual and not src.sql:
            errs.append(f"source {src.name}: business-vault source needs 'sql'")
        if isinstance(ent, Link):
            if not isinstance(src.bks, dict):
                errs.append(f"source {src.name}: link 'bks' must map source column -> hub key")
            else:
                unknown = sorted(set(src.bks.values()) - set(ent.hks))
                if unknown:
                    errs.append(f"source {src.name}: maps to unknown hub keys {unknown}")
        elif not src.bks:
            errs.append(f"source {src.name}: no business-key columns")
        if isinstance(ent, Sat):
            targets = list(dict.fromkeys(src.attrs.values()))
            if len(targets) != len(ent.attrs):
                errs.append(
                    f"source {src.name}: {len(targets)} mapped attributes for {len(ent.attrs)} target attributes"
                )
    if isinstance(ent, Sat) and ent.cks and ent.multiactive:
        errs.append("a multi-active satellite must not have child keys")
    return errs


# ---------------------------------------------------------------- parsing
def _map(value, where: str) -> dict:
    """A mapping, also when written as a YAML list of one-entry mappings."""
    if not value:
        return {}
    if isinstance(value, dict):
        return dict(value)
    if isinstance(value, list) and all(isinstance(x, dict) for x in value):
        return {k: v for x in value for k, v in x.items()}
    raise ValueError(f"{where}: expected a mapping or a list of mappings, got {value!r}")


def _bks(value, where: str):
    """Business keys: a list of columns, or (links) column -> hub key in either form of a mapping."""
    if isinstance(value, list) and any(isinstance(x, dict) for x in value):
        return _map(value, where)
    return value or []


def _sources(entry: dict, virtual: bool) -> list[Source]:
    out = []
    for name, s in (entry.get("src") or {}).items():
        s = s or {}
        out.append(
            Source(
                name=name,
                bks=_bks(s.get("bks"), f"source {name}: bks"),
                attrs=_map(s.get("attrs"), f"source {name}: attrs"),
                tenant=s.get("tenant") or DEFAULT_CODE,
                bkeycode=s.get("bkeycode") or DEFAULT_CODE,
                sql=s.get("sql"),
            )
        )
    return out


def _layer(conf: dict, virtual: bool) -> Layer:
    layer = Layer()
    for name, e in (conf.get("hubs") or {}).items():
        layer.hubs[name] = Hub(name, e["hk"], e["bk"], _sources(e, virtual), list(e.get("dependencies") or []))
    for name, e in (conf.get("links") or {}).items():
        layer.links[name] = Link(
            name, e["hk"], list(e["hks"]), _sources(e, virtual), _map(e.get("cks"), f"link {name}: cks"),
            list(e.get("dependencies") or []),
        )
    for name, e in (conf.get("sats") or {}).items():
        layer.sats[name] = Sat(
            name, e["hk"], list(e["attrs"]), _sources(e, virtual), _map(e.get("cks"), f"sat {name}: cks"),
            bool(e.get("multiactive") or False), list(e.get("dependencies") or []),
        )
    for name, e in (conf.get("effs") or {}).items():
        layer.effs[name] = Effectivity(name, e["link"], list(e["drivers"]), list(e.get("dependencies") or []))
    return layer
