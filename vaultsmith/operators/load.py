"""Loaders: which staged rows a vault target still lacks.

Every function here is a pure ``DataFrame -> DataFrame`` delta; nothing is
written (see ``vaultsmith.sinks``). The target is read only for the columns
it is compared on, so the Parquet scan of an ever-growing vault table reads
a single key column for hubs, links and regular satellites.

Physical shape (checked with ``explain``):

* existence checks are ``left_anti`` / ``left_semi`` joins; AQE broadcasts the
  small side when its measured size is under the threshold and otherwise
  keeps a shuffled join whose skewed partitions it splits;
* a target of some size is first cut down to the staged keys (``functions.prune``);
* several sources of one target are merged with one partial/final aggregate
  on the key (``first_source_wins``), never a window over a hot key;
* child-key and multi-active loads compare all sources with the target at once, no step is repeated per source.
  The rows of keys that are not heavy (``functions.heavy``) are dealt by their key once, digests packed to their
  bytes (``functions.keys.pack``), and compared, made distinct and numbered where they lie;
* heavy keys go another way: aggregates over a flagged union of staged and target rows, combined map-side,
  give one row per key; only that row is joined back, spread over tasks; their
  multi-active sets are numbered in ranges, as many as a key's size needs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.heavy import is_heavy, join_one_per_key, split
from ..functions.keys import KEY_DELIMITER, pack, text_columns, unpack, whole_digest
from ..functions.meta import HASHDIFF, SUBSEQ, load_meta
from ..functions.prune import no_rows, pruned
from ..functions.windows import latest_rows, time_order, with_set_positions
from ..run import Run
from ..spec import Hub, Link, Sat

_ORD = "_src_ord"
_FIRST = "_first_ord"
#: Sources of a child-key or multi-active satellite that one plan loads: a key's counts are at most 2**16.
SOURCES_AT_ONCE = 16
_TIME = "struct<no_appts: boolean, appts: timestamp_ntz, no_loadts: boolean, loadts: timestamp_ntz>"


def _as_list(stages) -> list[DataFrame]:
    return list(stages) if isinstance(stages, (list, tuple)) else [stages]


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def _made_of(stage: DataFrame, attrs: list[str]) -> list[str]:
    """The ``attrs`` if the hashdiff can be made of them (``keys.pack``): if they are texts all."""
    return attrs if text_columns(stage, attrs) == attrs else []


STAGED_META = ["dv_appts", "dv_recsrc", "dv_tenant", "dv_bkeycode"]


def _distinct_staged(stage: DataFrame, cols: list[str]) -> DataFrame:
    """The ``DISTINCT`` of a load, taken on the staged columns *before* the
    existence check: partial aggregation collapses repeated rows (a hot key's
    copies) map-side, the run literals are stamped afterwards instead of
    being hashed and shuffled, and the anti join stays the last exchange, so
    AQE may split a skewed partition of it. Same rows: the check is on a
    subset of these columns."""
    return stage.select(*cols, *STAGED_META).distinct()


def _existing(target: DataFrame, stages: list[DataFrame], keys: list[str]) -> DataFrame:
    """The target's keys that staged rows can meet, each once: copies of a hot key collapse map-side,
    since a join splits only its staged side."""
    return pruned(target.select(*keys), stages, keys[0]).distinct()


def first_source_wins(stages: list[DataFrame], keys: list[str], target: DataFrame | None = None) -> DataFrame:
    """Rows of the first source (in list order) that has each key, minus keys
    already in ``target``.

    Equals running one ``INSERT ... WHERE NOT EXISTS`` per source in order,
    each seeing the rows the earlier ones inserted. One aggregate on the key
    (partial aggregation collapses a hot key map-side) picks the first source
    per key; the target check runs on that one-row-per-key set; a final join
    on the key brings back the rows, duplicates included.
    """
    stages = _as_list(stages)
    if len(stages) == 1:
        rows = stages[0]
        return rows if target is None else rows.join(_existing(target, stages, keys), keys, "left_anti")
    tagged = union_all([s.withColumn(_ORD, F.lit(i)) for i, s in enumerate(stages)])
    first = tagged.groupBy(*keys).agg(F.min(_ORD).alias(_FIRST))
    if target is not None:
        first = first.join(_existing(target, stages, keys), keys, "left_anti")
    return tagged.join(first, keys).where(F.col(_ORD) == F.col(_FIRST)).drop(_ORD, _FIRST)


# ------------------------------------------------------------------- hubs
def hub_delta(stages, target: DataFrame | None, hub: Hub, run: Run) -> DataFrame:
    """Staged hub rows whose hash key is new.

    Reference semantics keep every staged duplicate of a new key; strict
    semantics keep one row per key.
    """
    cols = [hub.hk, hub.bk]
    if run.strict:
        stages = [_distinct_staged(s, cols) for s in _as_list(stages)]
    rows = first_source_wins(_as_list(stages), [hub.hk], target)
    return rows.select(*cols, *load_meta(run, run.load_task(hub.name)))


# ------------------------------------------------------------------ links
def link_delta(stages, target: DataFrame | None, link: Link, run: Run) -> DataFrame:
    """Staged link rows whose link hash key is new.

    Child keys are not part of the link hash, so in reference semantics a new
    child key under a known link key is not loaded; strict semantics compare
    on (hk, child keys) and keep one row per such key.
    """
    cks = list(link.cks.values())
    keys = [link.hk, *cks] if run.strict else [link.hk]
    cols = [link.hk, *link.hks, *cks]
    stages, digests = _as_list(stages), []
    if target is not None and no_rows(target):
        target = None  # nothing to meet: the staged rows stay where they are
    if run.strict or target is not None or len(stages) > 1:
        # Digests go packed through the distinct and the joins.
        digests = [c for c in text_columns(stages[0], [link.hk, *link.hks]) if all(text_columns(s, [c]) for s in stages)]
        if target is not None:
            if not text_columns(target, [link.hk]):
                digests = [c for c in digests if c != link.hk]
            target = pack(pruned(target.select(*keys), stages, keys[0]), [c for c in digests if c in keys])
        stages = [pack(s.select(*cols, *STAGED_META), digests) for s in stages]
        if run.strict:
            stages = [_distinct_staged(s, cols) for s in stages]
    rows = unpack(first_source_wins(stages, keys, target), digests)
    return rows.select(*cols, *load_meta(run, run.load_task(link.name)))


# ------------------------------------------------------------- satellites
def sat_columns(sat: Sat) -> list[str]:
    """Column order of a satellite table."""
    cols = [sat.hk, *sat.cks.values(), *sat.attrs, HASHDIFF, "dv_loadts", "dv_appts", "dv_recsrc", "dv_tenant",
            "dv_bkeycode"]
    if sat.multiactive and not sat.cks:
        cols.append(SUBSEQ)
    return [*cols, "dv_taskid"]


def sat_delta(stages, target: DataFrame | None, sat: Sat, run: Run) -> DataFrame:
    """Dispatch on the satellite kind: child-key, multi-active or regular."""
    if sat.cks and sat.multiactive:
        raise ValueError(f"sat {sat.name}: a multi-active satellite must not have child keys")
    if sat.cks:
        return sat_delta_ckey(stages, target, sat, run)
    if sat.multiactive:
        return sat_delta_multiactive(stages, target, sat, run)
    return sat_delta_regular(stages, target, sat, run)


def sat_delta_regular(stages, target: DataFrame | None, sat: Sat, run: Run) -> DataFrame:
    """Distinct staged rows of hash keys the satellite does not have yet.

    Reference semantics match on the hash key only, so later changes of a
    known key are never recorded. Strict semantics insert a row when its
    hashdiff differs from the key's latest version (child-key logic with no
    child keys).
    """
    if run.strict:
        return sat_delta_ckey(stages, target, sat, run)
    cols = [sat.hk, *sat.attrs, HASHDIFF]
    stages = [_distinct_staged(s, cols) for s in _as_list(stages)]
    rows = first_source_wins(stages, [sat.hk], target)
    return rows.select(*cols, *load_meta(run, run.load_task(sat.name)))


def _now(run: Run) -> Column:
    """The time, as ``time_order`` makes it, of all rows that a run loads."""
    return F.struct(F.lit(False).alias("no_appts"), run.applied_ts_col().alias("appts"),
                    F.lit(False).alias("no_loadts"), run.load_ts_col().alias("loadts"))


def _of_run(stage: DataFrame, run: Run, *times: str) -> DataFrame:
    """``stage``, failing on rows that another run staged: the loads of several sources count on one time."""
    want = {"dv_appts": run.applied_ts_col(), "dv_loadts": run.load_ts_col()}
    for t in times:
        stage = stage.withColumn(t, F.when(F.col(t).eqNullSafe(want[t]), F.col(t)).otherwise(
            F.raise_error(F.lit(f"{t} differs from the run's: stage and load the sources of a target in one run"))))
    return stage


def _in_groups(stages: list[DataFrame], target: DataFrame | None, compare: list[str], load) -> DataFrame:
    """``load(stages, target)`` over at most SOURCES_AT_ONCE sources at a time, each group seeing the ones before."""
    outs, seen = [], target
    for i in range(0, len(stages), SOURCES_AT_ONCE):
        d = load(stages[i:i + SOURCES_AT_ONCE], seen)
        outs.append(d)
        seen = d.select(*compare) if seen is None else seen.select(*compare).unionByName(d.select(*compare))
    return union_all(outs)


def _bit(ordinal: Column | int) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.lit(ordinal) if isinstance(ordinal, int) else ordinal)


def _tagged(stages: list[DataFrame]) -> DataFrame:
    return union_all([s.withColumn(_ORD, F.lit(i)) for i, s in enumerate(stages)])


def _lowest(mask: Column) -> Column:
    return mask.bitwiseAND(-mask)


def _not_loaded(staged: DataFrame, target: DataFrame, keys: list[str], n: int, run: Run) -> DataFrame:
    """(keys, hashdiff, mask of sources) of the staged values that their sources do not load.

    Staged and target rows meet in one flagged union. Per (key, hashdiff): which
    sources have it, and at which newest time the target has it. Per key: the target's
    newest time, and for every source the oldest time among its hashdiffs; the
    source brings something new if that is older. A value is current if its newest
    time is the key's. What the sources load one after another follows in closed form,
    as all of it gets the run's time:

    * the target's newest time is older (or there is none): the first source with a new
      value loads its values that aren't current, and these alone are current then; of
      the others, the first later source that has a value loads it;
    * it is the run's own: the first source that has a value loads it unless it is current;
    * it is newer: what is current stays, so every source loads what isn't.
    """
    time = time_order()
    fresh = staged.select(*keys, HASHDIFF, _bit(F.col(_ORD)).alias("sources"), F.lit(None).cast(_TIME).alias("at"))
    known = target.select(*keys, HASHDIFF, F.lit(0).cast("long").alias("sources"), time.cast(_TIME).alias("at"))
    values = fresh.unionByName(known).groupBy(*keys, HASHDIFF).agg(F.bit_or("sources").alias("sources"), F.max("at").alias("at"))

    own = lambda j: F.col("sources").bitwiseAND(1 << j) != 0
    aged = F.struct(F.col("at").isNotNull().alias("known"), F.col("at"))
    oldest = [F.min(F.when(own(j), aged)).alias(f"_oldest{j}") for j in range(n)]
    per_key = values.groupBy(*keys).agg(F.max("at").alias("newest"), F.bit_or("sources").alias("staged"), *oldest)
    news = [F.when(~F.col(f"_oldest{j}.known") | (F.col(f"_oldest{j}.at") < F.col("newest")), F.lit(j)) for j in range(n)]
    per_key = per_key.where("staged <> 0").select(*keys, "newest", F.coalesce(*news).alias("first"))

    met = join_one_per_key(values.where("sources <> 0"), per_key, keys, HASHDIFF, staged)
    mask = F.col("sources").bitwiseAND(F.bitwise_not(_loads(run)))
    return met.select(*keys, HASHDIFF, mask.alias("_mask")).where("_mask <> 0")


def _loads(run: Run) -> Column:
    """The mask of the sources that load a value, from its ``sources`` and ``at`` and its key's ``newest`` and
    ``first`` (see ``_not_loaded``)."""
    sources, nothing, now = F.col("sources"), F.lit(0).cast("long"), _now(run).cast(_TIME)
    is_new = ~F.coalesce(F.col("at") == F.col("newest"), F.lit(False))
    first = _bit(F.col("first"))
    later = _lowest(sources.bitwiseAND(-(first * 2)))  # sources behind the first
    older = F.when(is_new & (sources.bitwiseAND(first) != 0), first).otherwise(later)
    return (F.when(F.coalesce(F.col("newest") < now, F.lit(True)), F.coalesce(older, nothing))
            .when(~is_new, nothing).when(F.col("newest") == now, _lowest(sources)).otherwise(sources))


def _new_rows(tagged: DataFrame, target: DataFrame, keys: list[str], cols: list[str], n: int, run: Run) -> DataFrame:
    """The staged rows that their sources load, for keys that are not heavy: staged and target rows are dealt
    by the key once, then compared by windows of the key and the value, see ``_not_loaded``."""
    digests = text_columns(tagged, [keys[0], HASHDIFF])
    attrs = _made_of(tagged, [c for c in cols if c not in (*keys, HASHDIFF)])
    fresh = pack(tagged.select(*cols, *STAGED_META, _ORD), digests, HASHDIFF, attrs)
    known = pack(target.select(*keys, HASHDIFF, "dv_appts", "dv_loadts"), digests)
    rows = fresh.unionByName(known, allowMissingColumns=True).repartition(*keys)
    if HASHDIFF in digests and attrs:
        rows = rows.withColumn(HASHDIFF, whole_digest(HASHDIFF, attrs))

    by_key, by_value = Window.partitionBy(*keys), Window.partitionBy(*keys, HASHDIFF)
    at = F.when(F.col(_ORD).isNull(), time_order().cast(_TIME))
    rows = rows.select("*", F.max(at).over(by_value).alias("at"),
                       F.bit_or(F.coalesce(_bit(F.col(_ORD)), F.lit(0).cast("long"))).over(by_value).alias("sources"))
    if n == 1:  # a single source just loads what isn't current
        rows = rows.select("*", F.max("at").over(by_key).alias("newest"))
        loads = ~F.coalesce(F.col("at") == F.col("newest"), F.lit(False))
    else:
        own = lambda j: F.col("sources").bitwiseAND(1 << j) != 0
        aged = F.struct(F.col("at").isNotNull().alias("known"), F.col("at"))
        oldest = [F.min(F.when(own(j), aged)).over(by_key).alias(f"_oldest{j}") for j in range(n)]
        rows = rows.select("*", F.max("at").over(by_key).alias("newest"), *oldest)
        news = [F.when(~F.col(f"_oldest{j}.known") | (F.col(f"_oldest{j}.at") < F.col("newest")), F.lit(j)) for j in range(n)]
        rows = rows.withColumn("first", F.coalesce(*news))
        loads = _loads(run).bitwiseAND(_bit(F.col(_ORD))) != 0
    # A NULL key or hashdiff never matches: such rows load.
    unmatched = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in [*keys, HASHDIFF]])
    rows = rows.where(F.col(_ORD).isNotNull() & (unmatched | loads))
    return unpack(rows.select(*cols, *STAGED_META, _ORD).distinct(), digests)


def _new_rows_of_heavy(tagged: DataFrame, target: DataFrame, keys: list[str], cols: list[str], n: int, run: Run) -> DataFrame:
    """The same as ``_new_rows`` for heavy keys, whose rows lie in many tasks."""
    # One distinct for all sources: a source's copies collapse map-side.
    rows = tagged.select(*cols, *STAGED_META, _ORD).distinct()
    match = [*keys, HASHDIFF]
    if n == 1:
        # A single source just loads what isn't current. Plain equality: a NULL
        # child key never matches, so such rows load again (here as below).
        return rows.join(latest_rows(target, keys, [HASHDIFF], sketched=tagged), match, "left_anti")
    held = _not_loaded(tagged, target, keys, n, run)
    held = held.select("_mask", *[F.col(k).alias(f"_held_{k}") for k in match])
    same = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_held_{k}") for k in match])
    return rows.join(held, same & (F.col("_mask").bitwiseAND(_bit(F.col(_ORD))) != 0), "left_anti")


def sat_delta_ckey(stages, target: DataFrame | None, sat: Sat, run: Run) -> DataFrame:
    """Distinct staged rows whose (hk, child keys, hashdiff) is not among the
    latest rows (newest by applied time, load time; NULLs newest) of the
    same (hk, child keys).

    Sources load one after another: the rows source 1 adds are "latest"
    when source 2 is compared. The plan is the same for any number of sources (up
    to SOURCES_AT_ONCE; more are loaded in groups) but for the scans of the sources
    themselves, see ``_not_loaded``. Rows with a NULL key are never matched, so they
    always load. Several sources must be staged by the run that loads them.
    """
    stages = _as_list(stages)
    keys = [sat.hk, *sat.cks.values()]
    cols = [*keys, *sat.attrs, HASHDIFF]

    def load(group: list[DataFrame], seen: DataFrame | None) -> DataFrame:
        if len(stages) > 1:
            group = [_of_run(s, run, "dv_appts") for s in group]
        tagged = _tagged(group)
        if seen is None and len(group) == 1:
            digests, attrs = text_columns(tagged, [sat.hk, HASHDIFF]), _made_of(tagged, sat.attrs)
            rows = pack(tagged.select(*cols, *STAGED_META), digests, HASHDIFF, attrs).distinct()
            rows = unpack(rows, digests, HASHDIFF, attrs)
        else:
            if seen is None:
                seen = group[0].select(*keys, HASHDIFF, "dv_appts", "dv_loadts").where("false")
            seen = pruned(seen, group, sat.hk)
            heavy = is_heavy(tagged, keys)
            (light, hot), (light_seen, hot_seen) = split(tagged, heavy), split(seen, heavy)
            rows = _new_rows(light, light_seen, keys, cols, len(group), run).unionByName(
                _new_rows_of_heavy(hot, hot_seen, keys, cols, len(group), run))
        return rows.select(*cols, *load_meta(run, run.load_task(sat.name)))

    return _in_groups(stages, target, [*keys, HASHDIFF, "dv_appts", "dv_loadts"], load)


def _set_values(rows: DataFrame, hk: str, position: Column) -> DataFrame:
    """Of staged and target rows (these have no source): per (key, hashdiff), which ``sources`` have it, and ``at`` which
    newest time the target has it in which position."""
    at = F.when(F.col(_ORD).isNull(), F.struct(time_order().cast(_TIME).alias("time"), position.alias("position")))
    return rows.groupBy(hk, HASHDIFF).agg(F.coalesce(F.bit_or(_bit(F.col(_ORD))), F.lit(0).cast("long")).alias("sources"), F.max(at).alias("at"))


def _sets_to_load(values: DataFrame, hk: str, n: int, run: Run) -> DataFrame:
    """(hk, ``_load``: mask of the sources whose whole set loads, ``_sizes``: their number of distinct hashdiffs).

    ``values`` are those of ``_set_values``. Hashdiffs of a key with the same sources and time are then only
    counted: a key's counts say for any union of sources how many of a source's hashdiffs
    lie in it. So the sources are folded in order over these few counts: a source
    loads unless the current set has its size (the largest position) and holds all of
    its hashdiffs. The sets that a run loads share the run's time, so they are one
    current set: their union, of the size of the largest; with the target's newest set if
    that has the run's time too, and not current at all if the target's is newer. A set
    with a NULL time never equals anything.
    """
    now, newest = _now(run).cast(_TIME), F.col("newest.time")
    comparable = F.coalesce(~newest["no_appts"] & ~newest["no_loadts"], F.lit(False))
    target_size = F.coalesce("newest.position", F.lit(0)).cast("int")
    when_known = lambda *c: F.max(F.when(F.col("time").isNotNull(), F.struct("time", "position", *c))).alias("newest")
    if n == 1:
        sets = values.groupBy(hk, F.col("at.time").alias("time")).agg(F.max("at.position").alias("position"), F.sum("sources").alias("staged"))
        per_key = sets.groupBy(hk).agg(F.sum("staged").alias("staged"), when_known("staged")).where("staged > 0")
        same = comparable & (F.col("newest.staged") == F.col("staged")) & (target_size == F.col("staged"))
        # The one source's bit, not as a literal, which would tell the scans which rows load (see ``_placed_sets``).
        return per_key.where(~F.coalesce(same, F.lit(False))).select(
            hk, F.least(F.lit(1).cast("long"), F.col("staged")).alias("_load"), F.array("staged").alias("_sizes"))

    counts = values.groupBy(hk, "sources", F.col("at.time").alias("time")).agg(
        F.count(F.lit(1)).alias("n"), F.max("at.position").alias("position"))
    is_staged = F.when(F.col("sources") != 0, F.struct("time", "sources", "n"))
    per_key = counts.groupBy(hk).agg(F.bit_or("sources").alias("staged"), when_known(), F.collect_list(is_staged).alias("parts"))
    per_key = per_key.where("staged <> 0")
    # -1, 0, 1: the target's newest set is older than the run (or there is none), as old, newer.
    age = F.when(newest > now, 1).when(newest == now, 0).otherwise(-1)
    per_key = per_key.select(
        hk, target_size.alias("size"), comparable.alias("comparable"), age.alias("age"),
        F.transform("parts", lambda p: F.struct(p["sources"], p["n"], F.coalesce(p["time"] == newest, F.lit(False)).alias("current"))
                    ).alias("parts"))

    def count(keeps) -> Column:
        return F.aggregate("parts", F.lit(0).cast("long"), lambda total, p: total + F.when(keeps(p), p["n"]).otherwise(0))

    has = lambda p, mask: p["sources"].bitwiseAND(mask) != 0

    def step(state, j):
        bit = _bit(j)
        on_target = (F.col("age") == 1) | (state["load"] == 0)  # nothing of this run is current yet
        in_run = lambda p: has(p, state["load"]) | ((F.col("age") == 0) & p["current"])
        held = count(lambda p: has(p, bit) & F.when(on_target, p["current"]).otherwise(in_run(p)))
        size = (F.when(on_target, F.col("size")).when(F.col("age") == 0, F.greatest(state["size"], F.col("size")))
                .otherwise(state["size"]))

        def decide(x):
            same = (~on_target | F.col("comparable")) & (x["held"] == x["own"]) & (x["size"] == x["own"])
            loads = (x["own"] > 0) & ~same
            return F.struct(F.when(loads, state["load"].bitwiseOR(bit)).otherwise(state["load"]).alias("load"),
                            F.when(loads, F.greatest(state["size"], x["own"].cast("int"))).otherwise(state["size"]).alias("size"))

        seen = F.struct(count(lambda p: has(p, bit)).alias("own"), held.alias("held"), size.alias("size"))
        return F.transform(F.array(seen), decide)[0]

    start = F.struct(F.lit(0).cast("long").alias("load"), F.lit(0).alias("size"))
    load = F.aggregate(F.array(*[F.lit(j) for j in range(n)]), start, step, lambda s: s["load"])
    sizes = F.transform(F.array(*[F.lit(j) for j in range(n)]), lambda j: count(lambda p: has(p, _bit(j))))
    return per_key.select(hk, load.alias("_load"), sizes.alias("_sizes")).where("_load <> 0")


def _placed_sets(tagged: DataFrame, target: DataFrame | None, hk: str, n: int, run: Run) -> DataFrame:
    """The rows of the sets that load, with ``dv_subseq``, for keys that are not heavy: staged and target rows are dealt
    by the key once; all the rest is done where they lie.

    They are read twice, to compare the sets and to load them. All texts travel as one array, of which no reading drops
    a part: so both have the same columns, and share the shuffle."""
    digests = text_columns(tagged, [hk, HASHDIFF])
    meta = ["dv_recsrc", "dv_tenant", "dv_bkeycode"]
    attrs = [c for c in tagged.columns if c not in (hk, HASHDIFF, "dv_loadts", "dv_appts", *meta, _ORD)]
    texts = [*_made_of(tagged, attrs), *_made_of(tagged, meta)]
    made_of = attrs if texts == [*attrs, *meta] else []
    rows = pack(tagged.where(F.col(hk).isNotNull()), digests, HASHDIFF, made_of)
    if made_of:
        rows = rows.select(hk, HASHDIFF, "dv_loadts", "dv_appts", _ORD, F.array(*texts).alias("_texts"))
    position = F.col(SUBSEQ)
    if target is not None:
        known = pack(target.where(F.col(hk).isNotNull()).select(hk, HASHDIFF, "dv_loadts", "dv_appts", SUBSEQ), digests)
        if made_of:
            known = known.select(hk, HASHDIFF, "dv_loadts", "dv_appts", F.array(F.col(SUBSEQ).cast("string")).alias("_texts"))
            position = F.col("_texts")[0].cast("int")
        rows = rows.unionByName(known, allowMissingColumns=True)
    rows = rows.repartition(hk)
    if made_of and HASHDIFF in digests:
        made = F.unhex(F.md5(F.concat_ws(KEY_DELIMITER, F.slice("_texts", 1, len(attrs)))))
        rows = rows.withColumn(HASHDIFF, F.when(F.length(HASHDIFF) == 0, made).otherwise(F.col(HASHDIFF)))
    staged = rows.distinct() if run.strict else rows
    if target is not None:
        to_load = _sets_to_load(_set_values(rows, hk, position), hk, n, run)
        # Rows of the target have no source. Nothing here shall tell the scans so: they would be shuffled apart.
        loads = F.coalesce(F.col("_load").bitwiseAND(_bit(F.col(_ORD))), F.lit(0).cast("long")) != 0
        staged = staged.join(to_load, hk).where(loads).drop("_load", "_sizes")
    if made_of:
        staged = staged.select("*", *[F.col("_texts")[i].alias(c) for i, c in enumerate(texts)]).drop("_texts")
    in_set = Window.partitionBy(hk, _ORD).orderBy(HASHDIFF)
    placed = staged.drop(SUBSEQ).withColumn(SUBSEQ, F.dense_rank().over(in_set)).where(F.col(HASHDIFF).isNotNull())
    return unpack(placed, digests)


def _placed_sets_of_heavy(tagged: DataFrame, target: DataFrame | None, hk: str, n: int, run: Run) -> DataFrame:
    """The same as ``_placed_sets`` for heavy keys, whose rows lie in many tasks."""
    rows = tagged.distinct() if run.strict else tagged
    # One row per (key, source, hashdiff); those that load get positions, which are looked up for the rows.
    pairs = tagged.select(hk, _ORD, HASHDIFF).distinct()
    if target is None:
        to_load = pairs.groupBy(hk).agg(F.lit(1).cast("long").alias("_load"), F.array(F.count(F.lit(1))).alias("_sizes"))
    else:
        known = target.select(hk, HASHDIFF, "dv_appts", "dv_loadts", SUBSEQ)
        both = known.unionByName(tagged.select(hk, HASHDIFF, _ORD), allowMissingColumns=True)
        to_load = _sets_to_load(_set_values(both, hk, F.col(SUBSEQ)), hk, n, run)
    picked = join_one_per_key(pairs, to_load, [hk], HASHDIFF, tagged)
    picked = picked.where(F.col("_load").bitwiseAND(_bit(F.col(_ORD))) != 0)
    picked = picked.withColumn("_n", F.element_at("_sizes", F.col(_ORD) + 1)).drop("_load", "_sizes")
    return rows.join(with_set_positions(picked, [hk, _ORD], HASHDIFF, "_n"), [hk, _ORD, HASHDIFF])


def sat_delta_multiactive(stages, target: DataFrame | None, sat: Sat, run: Run) -> DataFrame:
    """Reload the whole staged set of every key whose set of hashdiffs differs
    from its current set (new keys included); keys absent from the stage are
    left alone. ``dv_subseq`` numbers the distinct hashdiffs of a key; the
    staged load time is kept.

    Reference semantics keep staged duplicates and load several sources one
    after another, in one plan that has the same shape for any number of sources
    (see ``_sets_to_load``; more than SOURCES_AT_ONCE are loaded in groups); these must be
    staged by the run that loads them. Strict semantics drop duplicates and load the union
    of the sources at once.
    """
    stages = _as_list(stages)
    if run.strict and len(stages) > 1:
        stages = [union_all(stages)]
    hk = sat.hk
    meta = ["dv_loadts", "dv_appts", "dv_recsrc", "dv_tenant", "dv_bkeycode"]

    def load(group: list[DataFrame], seen: DataFrame | None) -> DataFrame:
        if len(stages) > 1:
            group = [_of_run(s, run, "dv_appts", "dv_loadts") for s in group]
        tagged = _tagged([s.select(hk, *sat.attrs, HASHDIFF, *meta) for s in group])
        if seen is None and len(group) > 1:
            seen = tagged.select(hk, HASHDIFF, "dv_appts", "dv_loadts", F.lit(None).cast("int").alias(SUBSEQ)).where("false")
        heavy = is_heavy(tagged, [hk])
        light, hot = split(tagged, heavy)
        light_seen, hot_seen = (None, None) if seen is None else split(pruned(seen, group, hk), heavy)
        placed = _placed_sets(light, light_seen, hk, len(group), run).unionByName(
            _placed_sets_of_heavy(hot, hot_seen, hk, len(group), run))
        return placed.select(hk, *sat.attrs, HASHDIFF, *meta, F.col(SUBSEQ), F.lit(run.load_task(sat.name)).alias("dv_taskid"))

    return _in_groups(stages, target, [hk, HASHDIFF, "dv_appts", "dv_loadts", SUBSEQ], load)
