"""Quality rules with adaptive thresholds (native DataFrame operations only).

Per language and source, every quality measure gets a quantile sketch: a histogram of
log-linear buckets (the integer's leading ``SKETCH_BITS`` bits, so a bucket is at most
1/32 of its value wide). Bucket counts add up, hence sketches merge in any order and
the result does not depend on partitioning. A measure's fence is its upper quartile
plus ``reach`` interquartile ranges (and likewise below); documents are then joined
with the fences of their group and judged.

In a group of a few documents the upper quartile is the largest of its own values, so no
fence rejects anything. ``quality_rules`` takes the fences of groups with fewer than
``MIN_DOCS`` documents from the merged sketch of the language, or of all documents where
that has too few as well. The registered query and the pipeline do without
(``min_docs=0``): the query's SQL takes every group's own fences, whatever its size.

Defined results: null or empty text has no words and fails the base rules; a null
language or source is a group of its own; repeated rows are judged one by one; other
columns of the input are carried along untouched (own ones named quality, base_failed or
kept are replaced); an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._common import SPACE_CHARS, SPACE_CLASS, bind, bounded_broadcast, keep, table

SYMBOLS = "#*$%&|<>"
WINDOW_WORDS = 5
SKETCH_BITS = 6
#: Fences are broadcast up to this many groups; beyond, the join is shuffled.
MAX_BROADCAST_GROUPS = 100_000
#: Documents (with words) from which on a group's own quartiles are used.
MIN_DOCS = 32

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


@dataclass(frozen=True)
class Measure:
    """An integer measure of a document, judged against its group's quartiles.

    ``spread`` is the least interquartile range assumed: where nearly all documents of a
    group agree, small deviations are not rejected.
    """

    name: str
    sql: str
    spread: int
    two_sided: bool = False


# Integer formulas over the counts; Spark and DuckDB read them alike.
MEASURES = [
    Measure("symbols_pm", "div(1000 * n_symbols, word_chars)", 15),
    Measure("dup_lines_pm", "div(1000 * n_dup_lines, n_lines)", 115),
    Measure("repeats_pm", "div(1000 * n_repeat_words, n_words)", 67),
    Measure("capitals_pm", "div(1000 * n_capitals, word_chars)", 60),
    Measure("word_length_pc", "div(100 * word_chars, n_words)", 120, two_sided=True),
]


def _without(text: Column, chars: str) -> Column:
    return F.length(F.translate(text, chars, ""))


def _covered(hashes: Column) -> Column:
    """Words covered by windows whose hash occurs twice or more; ``hashes`` by window start."""
    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def repeated_starts(s: Column) -> Column:
        same = lambda p, j: F.coalesce(F.get(s, j)["h"] == p["h"], F.lit(False))
        return F.array_compact(F.transform(s, lambda p, k: F.when(same(p, k - 1) | same(p, k + 1), p["i"])))

    def words(starts: Column) -> Column:
        steps = F.transform(starts, lambda p, k: F.least(F.lit(WINDOW_WORDS), F.get(starts, k + 1) - p))
        # The last start has no next one: its whole window counts.
        return F.aggregate(steps, F.lit(0), lambda n, s: n + F.coalesce(s, F.lit(WINDOW_WORDS)))

    return bind(pairs, lambda s: bind(F.sort_array(repeated_starts(s)), words))


def _repeat_words(w: Column) -> Column:
    starts = F.sequence(F.lit(0), F.size(w) - WINDOW_WORDS)
    hashes = F.transform(starts, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW_WORDS)]))
    count = bind(hashes, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), _covered(h)).otherwise(0))
    return F.when(F.size(w) >= WINDOW_WORDS, count).otherwise(0)


def measure(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with one struct column ``quality`` of counts (longs), a map-only projection.

    Fields: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines (with a
    word), n_capitals (A-Z).
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    words = F.filter(F.split(text, f"[{SPACE_CLASS}]+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{SPACE_CLASS}]"))
    by_word = bind(words, lambda w: F.struct(F.size(w).alias("n_words"), _repeat_words(w).alias("n_repeat_words")))
    by_line = bind(lines, lambda x: F.struct(F.size(x).alias("n_lines"),
                                             (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines")))
    n = F.length(text)
    long = lambda c, name: c.cast("long").alias(name)
    one = F.struct(by_word.alias("w"), by_line.alias("l"), _without(text, SPACE_CHARS).alias("word_chars"),
                   (n - _without(text, SYMBOLS)).alias("n_symbols"),
                   (n - _without(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ")).alias("n_capitals"))
    quality = bind(one, lambda q: F.struct(
        long(q["w"]["n_words"], "n_words"), long(q["word_chars"], "word_chars"), long(q["n_symbols"], "n_symbols"),
        long(q["l"]["n_dup_lines"], "n_dup_lines"), long(q["w"]["n_repeat_words"], "n_repeat_words"),
        long(q["l"]["n_lines"], "n_lines"), long(q["n_capitals"], "n_capitals")))
    return docs.withColumn("quality", quality)


def _measures(q: str = "quality") -> Column:
    """Array of (measure, value); null for a document without words."""
    fields = {f: f"{q}.{f}" for f in BASE + ["n_lines", "n_capitals"]}

    def value(m: Measure) -> Column:
        sql = m.sql
        for f, path in fields.items():
            sql = sql.replace(f, path)
        top, bottom = sql[len("div("):-1].split(", ")
        return F.expr(f"({top}) div ({bottom})")

    items = [F.struct(F.lit(m.name).alias("measure"), value(m).alias("value")) for m in MEASURES]
    return F.when(F.col(f"{q}.n_words") > 0, F.array(*items))


def sketch(measured: DataFrame, group_cols: list[str]) -> DataFrame:
    """Mergeable quantile sketches: group, measure, bucket (its lower bound), n."""
    shift = f"greatest(length(bin(m.value)) - {SKETCH_BITS}, 0)"
    return (
        measured.select(*group_cols, F.explode(_measures()).alias("m"))
        .select(*group_cols, "m.measure",
                F.expr(f"shiftleft(shiftright(m.value, {shift}), {shift})").alias("bucket"))
        .groupBy(*group_cols, "measure", "bucket")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def merge(*sketches: DataFrame) -> DataFrame:
    """One sketch of the rows of several (for instance of yesterday's and today's tables)."""
    first, *rest = sketches
    for s in rest:
        first = first.unionByName(s)
    return first.groupBy(*[c for c in first.columns if c != "n"]).agg(F.sum("n").alias("n"))


def fences(sketched: DataFrame, group_cols: list[str], reach: int = 3) -> DataFrame:
    """One row per group: an array ``fences`` of (low, high), in the order of ``MEASURES``.

    A group has at most a few hundred buckets per measure, whatever its number of rows.
    """
    w = Window.partitionBy(*group_cols, "measure")
    upto = F.sum("n").over(w.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum("n").over(w)
    ranked = sketched.withColumn("upto", upto).withColumn("total", total)
    spread = F.create_map(*[F.lit(x) for m in MEASURES for x in (m.name, m.spread)])
    quartiles = ranked.groupBy(*group_cols, "measure").agg(
        F.min(F.when(F.col("upto") * 4 >= F.col("total"), F.col("bucket"))).alias("q1"),
        F.min(F.when(F.col("upto") * 4 >= F.col("total") * 3, F.col("bucket"))).alias("q3"))
    wide = F.lit(reach) * F.greatest(F.col("q3") - F.col("q1"), spread[F.col("measure")])
    two_sided = F.col("measure").isin([m.name for m in MEASURES if m.two_sided])
    fence = F.struct(F.when(two_sided, F.col("q1") - wide).otherwise(F.lit(0)).alias("low"),
                     (F.col("q3") + wide).alias("high"))
    by_name = F.map_from_entries(F.collect_list(F.struct("measure", fence.alias("fence"))))
    return quartiles.groupBy(*group_cols).agg(by_name.alias("by_name")).select(
        *group_cols, F.array(*[F.col("by_name")[m.name] for m in MEASURES]).alias("fences"))


def pooled_fences(sketched: DataFrame, group_cols: list[str], reach: int = 3, min_docs: int = MIN_DOCS) -> DataFrame:
    """``fences``, for groups of fewer than ``min_docs`` documents from the next wider group.

    Wider groups leave out the last group column, then the one before, up to all documents;
    their sketches are sums of the same bucket counts. Only fences are joined, one row a group.
    """
    def level(cols: list[str]) -> DataFrame:
        own = merge(sketched.select(*cols, "measure", "bucket", "n"))
        size = F.sum(F.when(F.col("measure") == MEASURES[0].name, F.col("n")))
        named = [F.col(c).alias(f"_{len(cols)}_{c}") for c in cols]
        right = own.groupBy(*cols).agg(size.alias(f"_size_{len(cols)}"))
        fenced = fences(own, cols, reach).select(*named, F.col("fences").alias(f"_fences_{len(cols)}"))
        return _null_safe(fenced, right, [f"_{len(cols)}_{c}" for c in cols], cols).drop(*cols)

    n = len(group_cols)
    found = level(group_cols).select(*[F.col(f"_{n}_{c}").alias(c) for c in group_cols], f"_size_{n}", f"_fences_{n}")
    for k in range(n - 1, -1, -1):
        wider = group_cols[:k]
        found = _null_safe(found, bounded_broadcast(level(wider), MAX_BROADCAST_GROUPS), wider, [f"_{k}_{c}" for c in wider])
    chosen = F.coalesce(*[F.when(F.col(f"_size_{k}") >= min_docs, F.col(f"_fences_{k}")) for k in range(n, 0, -1)], F.col("_fences_0"))
    return found.select(*group_cols, chosen.alias("fences"))


def _null_safe(left: DataFrame, right: DataFrame, left_cols: list[str], right_cols: list[str]) -> DataFrame:
    """Inner join on equal columns, nulls being equal (all rows by all rows without columns)."""
    on = None
    for a, b in zip(left_cols, right_cols):
        same = left[a].eqNullSafe(right[b])
        on = same if on is None else on & same
    return left.crossJoin(right) if on is None else left.join(right, on)


def judge(measured: DataFrame, fenced: DataFrame, group_cols: list[str]) -> DataFrame:
    """``measured`` joined with its group's fences: adds base_failed and kept."""
    right = fenced.select(*[F.col(c).alias(f"_fence_{c}") for c in group_cols], F.col("fences").alias("_fences"))
    on = None
    for c in group_cols:
        same = measured[c].eqNullSafe(right[f"_fence_{c}"])
        on = same if on is None else on & same
    joined = measured.join(bounded_broadcast(right, MAX_BROADCAST_GROUPS), on, "left")
    q = F.col("quality")
    failed = (q["n_words"] < 10) | (q["n_repeat_words"] * 100 > q["n_words"] * 20)
    inside = F.forall(F.zip_with(_measures(), F.col("_fences"),
                                 lambda m, f: (m["value"] >= f["low"]) & (m["value"] <= f["high"])), lambda ok: ok)
    return (joined.withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(False)))
            .drop("_fences", *[f"_fence_{c}" for c in group_cols]))


def quality_rules(docs: DataFrame, group_cols: tuple[str, ...] = ("lang", "source"), reach: int = 3,
                  min_docs: int = MIN_DOCS, drop: tuple[str, ...] = ()) -> DataFrame:
    """Every row of ``docs`` with columns quality, base_failed, kept, without those in ``drop``.

    Texts are measured once and not shuffled: the rows are written with their counts, the
    sketches are made from the counts alone, then the written rows are judged against the
    (small) table of fences.
    """
    group = list(group_cols)
    measured = keep(measure(docs).drop(*drop), "quality-measured", compression="zstd")
    if min_docs > 0:
        sketched = keep(sketch(measured, group), "quality-sketches")
        fenced = keep(pooled_fences(sketched, group, reach, min_docs), "quality-fences")
    else:
        fenced = keep(fences(sketch(measured, group), group, reach), "quality-fences")
    return judge(measured, fenced, group)


# ---------------------------------------------------------------- query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    # Only counts are kept between the passes, so the texts are measured once.
    measured = keep(measure(docs).select("doc_id", "lang", "source", "quality"), "quality-measured")
    group = ["lang", "source"]
    fenced = keep(fences(sketch(measured, group), group), "quality-fences")
    judged = judge(measured, fenced, group)
    return judged.select("doc_id", *[F.col(f"quality.{c}").alias(c) for c in BASE], "base_failed", "kept")


def _oracle() -> str:
    spreads = " ".join(f"WHEN '{m.name}' THEN {m.spread}" for m in MEASURES)
    two = ", ".join(f"'{m.name}'" for m in MEASURES if m.two_sided)
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws,
      list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM d),
win AS (SELECT r, i, array_to_string(list_slice(ws, i, i + 4), ' ') AS g
        FROM (SELECT r, ws, unnest(range(1, len(ws) - 3)) AS i FROM w)),
rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM win) WHERE c > 1),
cov AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM rep) GROUP BY r),
m AS (SELECT d.r, doc_id, lang, source, len(ws)::BIGINT AS n_words,
      length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
      (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
      (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words,
      len(ls)::BIGINT AS n_lines, (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')))::BIGINT AS n_capitals
      FROM d JOIN w USING (r) LEFT JOIN cov USING (r)),
v AS (SELECT r, lang, source, x.a AS measure, x.v AS v FROM (SELECT r, lang, source, unnest([{", ".join(
        f"{{'a': '{m.name}', 'v': {_duck(m)}}}" for m in MEASURES)}]) AS x FROM m WHERE n_words > 0)),
b AS (SELECT lang, source, measure, (v >> s) << s AS bucket, count(*) AS n
      FROM (SELECT *, greatest(length(bin(v)) - {SKETCH_BITS}, 0)::BIGINT AS s FROM v) GROUP BY ALL),
c AS (SELECT *, sum(n) OVER (PARTITION BY lang, source, measure ORDER BY bucket) AS upto,
      sum(n) OVER (PARTITION BY lang, source, measure) AS total FROM b),
q AS (SELECT lang, source, measure, min(bucket) FILTER (upto * 4 >= total) AS q1,
      min(bucket) FILTER (upto * 4 >= total * 3) AS q3 FROM c GROUP BY ALL),
f AS (SELECT *, 3 * greatest(q3 - q1, CASE measure {spreads} END) AS wide FROM q),
out AS (SELECT r FROM v JOIN f ON v.lang IS NOT DISTINCT FROM f.lang AND v.source IS NOT DISTINCT FROM f.source
        AND v.measure = f.measure WHERE v.v > q3 + wide OR (v.measure IN ({two}) AND v.v < q1 - wide)),
j AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND r NOT IN (SELECT r FROM out) AS kept FROM j"""


def _duck(m: Measure) -> str:
    top, bottom = m.sql[len("div("):-1].split(", ")
    return f"({top}) // ({bottom})"


QUERIES = {"op9_quality_rules": op9_quality_rules}
ORACLE = {"op9_quality_rules": _oracle()}
