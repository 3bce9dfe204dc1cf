"""Order of business-vault entities from their declared dependencies.

A dependency names a task: ``load__<entity>`` or ``stage__<entity>``.
Reference semantics resolve a name to the *first* task whose name contains
it (raw-vault loads first, then business-vault stages, then business-vault
loads) and ignore names that match nothing, with a warning. Strict
semantics require an exact task name and reject unknown ones.
"""

from __future__ import annotations

import warnings

from ..spec import VaultModel


def task_names(model: VaultModel) -> list[str]:
    """All task names, in the order the original DAG registers them."""
    rv_all = [*model.rv.entities(), *model.rv.effs.values()]
    bv_all = [*model.bv.entities(), *model.bv.effs.values()]
    rv = [f"load__{e.name}" for e in rv_all]
    bv_stage = [f"stage__{e.name}" for e in bv_all]
    bv_load = [f"load__{e.name}" for e in bv_all]
    return [*rv, *bv_stage, *bv_load]


def resolve(dep: str, tasks: list[str], strict: bool) -> str | None:
    if strict:
        if dep not in tasks:
            raise ValueError(f"unknown dependency {dep!r}")
        return dep
    for t in tasks:
        if dep in t:
            return t
    warnings.warn(f"dependency {dep!r} matches no task and is ignored", stacklevel=3)
    return None


def _bv_graph(model: VaultModel, strict: bool, reads: dict[str, set[str]] | None = None) -> tuple[list[str], dict[str, set[str]]]:
    tasks = task_names(model)
    names = [e.name for e in model.bv.entities()] + list(model.bv.effs)
    deps_of = {}
    for ent in [*model.bv.entities(), *model.bv.effs.values()]:
        before = set()
        for dep in ent.dependencies:
            task = resolve(dep, tasks, strict)
            if task is None:
                continue
            target = task.split("__", 1)[1]
            if target in names and target != ent.name:
                before.add(target)
        if hasattr(ent, "link") and ent.link in names:
            before.add(ent.link)
        undeclared = (reads or {}).get(ent.name, set()) & set(names) - before - {ent.name}
        if undeclared:
            text = f"{ent.name} reads {sorted(undeclared)} without declaring a dependency"
            if strict:
                raise ValueError(text)
            warnings.warn(text + "; loaded in that order all the same", stacklevel=3)
            before |= undeclared
        deps_of[ent.name] = before
    return names, deps_of


def bv_levels(model: VaultModel, strict: bool = False, reads: dict[str, set[str]] | None = None) -> list[list[str]]:
    """Business-vault entity names in dependency levels: every entity comes
    after all the entities it depends on; entities of one level are
    independent (model order kept inside a level).

    ``reads`` (see ``dry_run.vault_reads``) adds the tables that an entity's SQL
    names: one that isn't declared is an error in strict semantics, else a warning."""
    names, deps_of = _bv_graph(model, strict, reads)
    levels, done = [], set()
    while len(done) < len(names):
        ready = [n for n in names if n not in done and deps_of[n] <= done]
        if not ready:
            cycle = sorted(n for n in names if n not in done)
            raise ValueError(f"dependency cycle among {cycle}")
        levels.append(ready)
        done.update(ready)
    return levels


def bv_order(model: VaultModel, strict: bool = False) -> list[str]:
    """Business-vault entity names in an order that loads every dependency
    first (hubs, links, satellites, effectivity otherwise in model order)."""
    return [n for level in bv_levels(model, strict) for n in level]
