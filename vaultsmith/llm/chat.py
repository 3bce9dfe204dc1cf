"""Chat formatting by schema fingerprints.

A record is a JSON object in any of several layouts (message lists, from/value lists,
instruction/input/output, prompt/response, rows by turn). The set of its nested field
paths (``messages[].role``; fields that no layout knows are left out) is hashed; the hash
selects a declarative mapping, which names the paths that become canonical turns (role,
text). Roles are mapped to system, user, assistant and tool where they are known aliases.

The template writes a turn as ``<|im_start|>`` role ``<|im_sep|>`` text ``<|im_end|>``.
Control strings inside roles and texts (those of this template and of others) get a
backslash after their first character, and backslashes are doubled, so the output parses
back to exactly the same turns. The loss mask lists the spans (start, length in code
points of the output) of the assistant texts.

Defined results: null text or role is empty (a null field counts as absent where a layout
fits without it, else as a field without text); turns are in order of their turn number,
nulls first, ties by role and text (repeated rows are repeated turns); a null conv_id is
one conversation (a conversation is one output row, so its turns meet in one task); a
record of no known layout has layout null and no turns; fields and
columns that no layout knows are ignored; an empty table gives only what is added to it.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import bind, table

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
# Control strings of this and other public chat templates.
CONTROL = [
    "<|im_start|>", "<|im_sep|>", "<|im_end|>", "<|endoftext|>", "<|startoftext|>", "<|begin_of_text|>",
    "<|start_header_id|>", "<|end_header_id|>", "<|eot_id|>", "<|system|>", "<|user|>", "<|assistant|>", "<|end|>",
    "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<unk>", "<pad>",
]
# Role names of public layouts.
ROLES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant",
         "function": "tool", "observation": "tool"}
LOSS_ROLE = "assistant"


# ------------------------------------------------------------- layouts
@dataclass(frozen=True)
class Layout:
    """How records with certain field paths become turns.

    ``lists``: (path of a list, field of the role, field of the text, field to sort by or
    None). ``fields``: (path, role) of single texts, in order; several paths of one role in
    a row are joined by an empty line. ``optional``: paths that may be absent.
    """

    name: str
    lists: tuple = ()
    fields: tuple = ()
    optional: tuple = field(default=())

    def paths(self) -> set[str]:
        found = {p for p, _ in self.fields}
        for path, role, text, order in self.lists:
            found |= {f"{path}[].{x}" for x in (role, text, order) if x}
        return found


LAYOUTS = [
    Layout("turn rows", lists=(("turns", "role", "text", "turn"),), optional=("turns[].turn",)),
    Layout("messages", fields=(("system", "system"),), lists=(("messages", "role", "content", None),), optional=("system",)),
    Layout("from/value", fields=(("system", "system"),), lists=(("conversations", "from", "value", None),), optional=("system",)),
    Layout("instruction", fields=(("system", "system"), ("instruction", "user"), ("input", "user"), ("output", "assistant")),
           optional=("system", "input")),
    Layout("prompt/response", fields=(("system", "system"), ("prompt", "user"), ("response", "assistant")), optional=("system",)),
    Layout("prompt/completion", fields=(("system", "system"), ("prompt", "user"), ("completion", "assistant")), optional=("system",)),
    Layout("question/answer", fields=(("context", "user"), ("question", "user"), ("answer", "assistant")), optional=("context",)),
]


def fingerprint(paths: set[str]) -> str:
    return hashlib.sha1("\n".join(sorted(paths)).encode()).hexdigest()


KNOWN = frozenset().union(*[layout.paths() for layout in LAYOUTS])
#: Fingerprint -> layout, one entry per choice of optional paths.
REGISTRY = {
    fingerprint(layout.paths() - set(absent)): layout
    for layout in LAYOUTS
    for n in range(len(layout.optional) + 1)
    for absent in itertools.combinations(layout.optional, n)
}


def field_paths(value, path: str = "") -> set[str]:
    """Paths of the leaves of a JSON value; null fields count as absent, an empty list as itself."""
    if isinstance(value, dict):
        return set().union(*[field_paths(v, f"{path}.{k}" if path else k) for k, v in value.items() if v is not None])
    if isinstance(value, list):
        return set().union(*[field_paths(v, f"{path}[]") for v in value])
    return {path}


def null_paths(value, path: str = "") -> set[str]:
    """Paths of the fields that are there with a null value."""
    if isinstance(value, dict):
        return set().union(*[null_paths(v, f"{path}.{k}" if path else k) for k, v in value.items()])
    if isinstance(value, list):
        return set().union(*[null_paths(v, f"{path}[]") for v in value])
    return {path} if value is None else set()


def layout_of(data: dict) -> tuple[str, Layout | None]:
    """Fingerprint and layout of a record; null fields count where only they complete a layout."""
    found = field_paths(data) & KNOWN
    mark = fingerprint(found)
    if mark in REGISTRY:
        return mark, REGISTRY[mark]
    nulls = null_paths(data)
    for layout in LAYOUTS:
        filled = fingerprint(found | (nulls & layout.paths()))
        if REGISTRY.get(filled) is layout:
            return filled, layout
    return mark, None


def turns_of(record: str | None) -> tuple[str | None, str | None, list[tuple[str, str]]]:
    """(fingerprint, layout name, canonical turns) of a JSON record."""
    try:
        data = json.loads(record or "")
    except ValueError:
        return None, None, []
    if not isinstance(data, dict):
        return None, None, []
    mark, layout = layout_of(data)
    if layout is None:
        return mark, None, []
    out: list[tuple[str, str]] = []
    for path, role in layout.fields:
        text = data.get(path)
        if text is None:
            if path in layout.optional:
                continue
            text = ""
        if out and out[-1][0] == role:
            out[-1] = (role, f"{out[-1][1]}\n\n{text}")
        else:
            out.append((role, str(text)))
    for path, role, text, order in layout.lists:
        items = [x for x in data[path] if isinstance(x, dict)]
        if order:
            items = sorted(items, key=lambda x: (x.get(order) is not None, x.get(order) or 0))
        out += [(ROLES.get(str(x.get(role) or ""), str(x.get(role) or "")), str(x.get(text) or "")) for x in items]
    return mark, layout.name, out


def _canonical(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for records in batches:
        rows = [turns_of(r) for r in records]
        yield pd.DataFrame({"fingerprint": [r[0] for r in rows], "layout": [r[1] for r in rows],
                            "turns": [[{"role": a, "text": b} for a, b in r[2]] for r in rows]})


def canonical_turns(records: DataFrame, record_col: str = "record") -> DataFrame:
    """``records`` with a struct column ``chat`` (one of that name is replaced): fingerprint, layout, turns."""
    chat = F.pandas_udf(_canonical, "fingerprint string, layout string, turns array<struct<role: string, text: string>>")
    return records.withColumn("chat", chat(F.col(f"`{record_col}`").cast("string")))


# ------------------------------------------------------------- template
def escaped(text: Column) -> Column:
    out = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    for c in CONTROL:
        out = F.replace(out, F.lit(c), F.lit(c[0] + "\\" + c[1:]))
    return out


def unescaped(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def format_chat(chats: DataFrame, turns_col: str = "turns") -> DataFrame:
    """``chats`` with ``formatted`` (string) and ``loss_spans`` (array of start, length).

    Columns of these two names are replaced, all others are carried along.
    """
    head = lambda t: F.concat(F.lit(START), t["role"], F.lit(SEP))
    none = F.array().cast("array<struct<start: long, length: long>>")

    def add(state: Column, t: Column) -> Column:
        start = state["at"] + F.length(head(t))
        n = F.length(t["text"])
        span = F.struct(start.cast("long").alias("start"), n.cast("long").alias("length"))
        return F.struct((start + n + len(END)).cast("long").alias("at"),
                        F.when(F.coalesce(t["loss"], F.lit(False)), F.concat(state["spans"], F.array(span)))
                        .otherwise(state["spans"]).alias("spans"))

    turns = F.coalesce(F.col(f"`{turns_col}`"), F.array())
    safe = F.transform(turns, lambda t: F.struct(
        escaped(t["role"]).alias("role"), escaped(t["text"]).alias("text"), (t["role"] == LOSS_ROLE).alias("loss")))
    text = lambda s: F.array_join(F.transform(s, lambda t: F.concat(head(t), t["text"], F.lit(END))), "")
    spans = lambda s: F.aggregate(s, F.struct(F.lit(0).cast("long").alias("at"), none.alias("spans")), add,
                                  lambda x: x["spans"])
    # Both results in one withColumns: neither can be read as an input of the other.
    return chats.withColumns({"formatted": bind(safe, text), "loss_spans": bind(safe, spans)})


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    turns = []
    for part in formatted.split(END)[:-1]:
        role, _, text = part.removeprefix(START).partition(SEP)
        turns.append((unescaped(role), unescaped(text)))
    return turns


def _read_back(formatted: pd.Series, starts: pd.Series, lengths: pd.Series) -> pd.DataFrame:
    rows = []
    for text, begins, sizes in zip(formatted, starts, lengths):
        turns = parse(text)
        loss = "".join(unescaped(text[b:b + n]) for b, n in zip(begins, sizes))
        whole = "".join(f"{role}\n{said}\n" for role, said in turns)
        rows.append((len(turns), hashlib.sha256(whole.encode("utf-8", "surrogatepass")).hexdigest(), len(loss),
                     hashlib.sha256(loss.encode("utf-8", "surrogatepass")).hexdigest(), len(text)))
    return pd.DataFrame(rows, columns=["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])


def read_back(chats: DataFrame) -> DataFrame:
    """``chats`` with a struct column ``back`` (one of that name is replaced), all of it parsed from formatted and loss_spans."""
    read = F.pandas_udf(_read_back, "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    return chats.withColumn("back", read("formatted", F.col("loss_spans.start"), F.col("loss_spans.length")))


# ---------------------------------------------------------------- query
def conversation_records(rows: DataFrame) -> DataFrame:
    """(conv_id, record): one JSON record per conversation from rows by turn (conv_id, turn, role, text)."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    listed = F.sort_array(F.collect_list(turn))
    return rows.groupBy("conv_id").agg(F.to_json(F.struct(listed.alias("turns"))).alias("record"))


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)],
                                  "conv_id long, turn long, role string, text string")
    chats = canonical_turns(conversation_records(rows.unionByName(added))).select("conv_id", "chat.layout", "chat.turns")
    return read_back(format_chat(chats)).select("conv_id", "back.*", "layout")


def _sql_escape(column: str) -> str:
    out = f"replace({column}, chr(92), chr(92) || chr(92))"
    for c in CONTROL:
        out = f"replace({out}, '{c}', '{c[0]}' || chr(92) || '{c[1:]}')"
    return out


_ORACLE = f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT * FROM (VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))),
g AS (SELECT conv_id, count(*) AS n_turns,
      string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS whole,
      coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
      sum(length({_sql_escape('role')}) + length({_sql_escape('text')}) + {len(START + SEP + END)}) AS formatted_chars
      FROM c GROUP BY conv_id)
SELECT conv_id::BIGINT AS conv_id, 'turn rows' AS layout, n_turns::BIGINT AS n_turns, sha256(whole) AS turns_sha256,
       length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars::BIGINT AS formatted_chars FROM g"""

QUERIES = {"op1_chat_formatting": op1_chat_formatting}
ORACLE = {"op1_chat_formatting": _ORACLE}
