"""Results held against what other programs or plain readings of the inputs give."""

import hashlib
import json
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from vaultsmith.llm import catalog, chat, lattice, quality, toxicity
from vaultsmith.llm._tokens import tokenizer_path

from ..conftest import SF_SMALL
from ..oracle import duck

PIECE = tokenizer_path("piece_bpe_32k.model")
END_IN_TEXT = f"x{chat.END}y\\{chat.START}"


@pytest.fixture(scope="module")
def sentencepiece():
    import sentencepiece as sp

    return sp.SentencePieceProcessor(model_file=PIECE)


# ------------------------------------------------------------- op 7
def test_lattice_ids_are_those_of_sentencepiece(spark, sentencepiece):
    rows = {r["doc_id"]: r for r in catalog.queries()["op7_lattice_encoding"](spark, SF_SMALL).collect()}
    for i, text in duck(SF_SMALL).execute("SELECT doc_id, coalesce(text, '') FROM documents").fetchall():
        ids = np.array(sentencepiece.encode(text), "<u4")
        assert (rows[i]["n_tokens"], rows[i]["ids_crc32"]) == (len(ids), zlib.crc32(ids.tobytes())), i


@pytest.mark.parametrize("max_units", [lattice.MAX_BROADCAST_UNITS, 0])
def test_merges_take_the_best_pair_first(spark, sentencepiece, max_units):
    texts = ["Enpaeux", "a" * 59, "a" * 60, "a" * 61, "a" * 62, "aab" * 40, " " * 33, "  x   y ", "漢字\tñ😀①", "\n\n", "relationship" * 5,
             "x" * 2000, None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in lattice.encode(df, PIECE, max_units=max_units).collect():
        text = texts[r["doc_id"]] or ""
        assert np.frombuffer(r["ids"], "<u4").tolist() == sentencepiece.encode(text), text


# ------------------------------------------------------------- op 1
def test_turns_without_any_number_stay(spark):
    rows = [(1, None, "user", "b"), (1, None, "assistant", "a"), (2, None, None, None), (3, None, "user", "x"), (3, 0, "user", "y")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    chats = chat.canonical_turns(chat.conversation_records(df)).select("conv_id", "chat.layout", "chat.turns")
    made = {r["conv_id"]: r for r in chat.read_back(chat.format_chat(chats)).collect()}
    assert {r["layout"] for r in made.values()} == {"turn rows"}
    assert chat.parse(made[1]["formatted"]) == [("assistant", "a"), ("user", "b")]
    assert made[1]["back"]["loss_sha256"] == hashlib.sha256(b"a").hexdigest()
    assert chat.parse(made[2]["formatted"]) == [("", "")]
    assert chat.parse(made[3]["formatted"]) == [("user", "x"), ("user", "y")]


@pytest.mark.parametrize("record,layout,turns", [
    ({"prompt": "hi", "response": None}, "prompt/response", [("user", "hi"), ("assistant", "")]),
    ({"prompt": None, "completion": "yo", "response": None}, "prompt/completion", [("user", ""), ("assistant", "yo")]),
    ({"question": "hi", "answer": None, "context": None}, "question/answer", [("user", "hi"), ("assistant", "")]),
    ({"messages": [{"role": "user", "content": None}, {"role": "assistant", "content": None}]}, "messages", [("user", ""), ("assistant", "")]),
    ({"conversations": [{"from": None, "value": "hi"}], "system": None}, "from/value", [("", "hi")]),
    ({"turns": [{"turn": None, "role": "user", "text": None}]}, "turn rows", [("user", "")]),
    ({"prompt": "hi", "response": "yo", "messages": None, "completion": None}, "prompt/response", [("user", "hi"), ("assistant", "yo")]),
    ({"prompt": "only", "system": None}, None, []),
])
def test_null_fields_are_empty_texts(record, layout, turns):
    assert chat.turns_of(json.dumps(record))[1:] == (layout, turns)


def test_own_columns_stay_beside_the_formatted_text(spark):
    df = spark.createDataFrame([(1, "mine", "x", [("user", "a\\b"), ("assistant", END_IN_TEXT)]), (2, None, None, None)],
                               "safe long, s string, `turns.x` string, turns array<struct<role: string, text: string>>")
    out = chat.format_chat(df)
    assert out.columns == [*df.columns, "formatted", "loss_spans"]
    first, second = sorted(out.collect(), key=lambda r: r["safe"])
    assert (first["safe"], first["s"], first["turns.x"]) == (1, "mine", "x")
    assert chat.parse(first["formatted"]) == [("user", "a\\b"), ("assistant", END_IN_TEXT)]
    assert (second["formatted"], second["loss_spans"]) == ("", [])


# ------------------------------------------------------------- op 8
def by_hand(model, text):
    """Expected severity, severity and flag from the definitions in the module's docstring."""
    words = [w.strip() for w in (text or "").lower().split()]
    times = {}
    for w in words:
        w = re.sub(r"^\W+|\W+$", "", w)
        for f in {w, *(w[:n] + "*" for n in (4, 5, 6) if len(w) >= n)} if w else ():
            times[f] = times.get(f, 0) + 1
    x = sum(min(1000 * times[f] / len(words), 30) / 10 * w for f, w in zip(model.features, model.weights) if f in times)
    tails = [1 / (1 + math.exp(b - x)) for b in model.cuts]
    grade = [a - b for a, b in zip([1, *tails], [*tails, 0])]
    return sum(tails), grade, tails[0]


def test_toxicity_by_hand_on_every_document(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    rows = {r["doc_id"]: r for r in catalog.queries()["op8_toxicity"](spark, SF_SMALL).collect()}
    texts = duck(SF_SMALL).execute("SELECT doc_id, text FROM documents").fetchall()
    assert len(rows) == len(texts) and len(model.features) > 0
    for i, text in texts:
        expected, grade, flag = by_hand(model, text)
        r = rows[i]
        assert abs(r["expected_severity"] - expected) < 2e-6, i
        assert grade[r["severity"]] >= max(grade) - 1e-9 and r["kept"] != r["toxic"], i
        assert r["toxic"] == (flag >= 0.2) or abs(flag - 0.2) < 1e-9, i


def test_toxicity_on_held_out_labels(spark):
    """Fitted on each half of sf0.1's labels, judged by the other half; single halves differ by several points."""
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet").join(labels.select("doc_id"), "doc_id", "left_semi")
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2))
    flagged = {0: [], 1: []}
    for k in (0, 1):
        model = toxicity.fit(docs, labels.where(half == k))
        others = labels.where(half != k).select("doc_id", F.col("toxic").alias("label"))
        for r in toxicity.score(docs.join(others, "doc_id"), model).select("label", "toxicity.toxic").collect():
            flagged[r["label"]].append(r["toxic"])
    assert len(flagged[1]) > 400 and len(flagged[0]) > 3000
    assert np.mean(flagged[1]) >= 0.9 and np.mean(flagged[0]) <= 0.04


# ------------------------------------------------------------- op 9
def test_quality_measures_a_text_once(spark):
    """The rows are written with their counts; the verdict's plan holds no text work."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    judged = quality.quality_rules(docs, min_docs=0).where("kept")
    plan = judged._jdf.queryExecution().optimizedPlan().toString()
    assert "split(" not in plan and "xxhash64" not in plan and "quality" in plan


def test_small_groups_take_wider_fences(spark):
    clean = "the quick brown fox jumps over a lazy dog near some river bank today and then it sleeps"
    junk = clean.replace(" ", " ## ")
    rows = [(i, f"{clean} n{i}", "en", "big") for i in range(60)]
    rows += [(100, junk, "en", "host a"), (101, clean, "en", "host b"), (102, junk, "en", None), (103, clean, "en", None)]
    rows += [(200, junk, "xx", "rare"), (201, clean, "xx", "rare"), (202, junk, None, None), (203, clean, None, None)]
    rows += [(300 + i, f"{junk} n{i}", "en", "code") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r["doc_id"]: r["kept"] for r in quality.quality_rules(docs.where("doc_id < 300")).collect()}
    assert len(kept) == 68 and {i for i, k in kept.items() if not k} == {100, 102, 200, 202}
    own = {r["doc_id"]: r["kept"] for r in quality.quality_rules(docs.where("doc_id < 300"), min_docs=0).collect()}
    assert all(own.values())
    # A group of its own size keeps its own fences.
    assert all(r["kept"] for r in quality.quality_rules(docs).where("doc_id >= 300").collect())


# ------------------------------------------------------------- pipeline
def test_near_duplicates_leave_by_row(spark):
    a, b, c = (" ".join(f"{x}{k}" for k in range(40)) for x in "abc")
    rows = [(5, a, "en"), (5, b, "en"), (3, b, "en"), (7, c, "en"), (7, c, "en"), (8, f"{c} more", "en"), (None, a, "en"), (9, None, "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, Row string").repartition(3)
    left = corpus_pipeline.near_duplicate_stage(spark, docs, SF_SMALL)
    assert left.columns == docs.columns
    assert sorted(map(str, left.collect())) == sorted(map(str, spark.createDataFrame([rows[k] for k in (0, 2, 3, 6, 7)], docs.schema).collect()))


def test_words_with_marks_behind_are_cut_without_the_pattern():
    """Most unseen chunks are letters with marks behind them: no costly split, no normalizer call, the same ids."""
    import random
    import string

    from vaultsmith.llm._tokens import ChunkEncoder, tokenizer_path

    enc = ChunkEncoder(tokenizer_path("word_bpe_49k.json"))
    rnd, letters = random.Random(4), string.ascii_letters + "éÀßµªºÝ"
    words = ["".join(rnd.choices(letters, k=rnd.randint(1, 7))) + "".join(rnd.choices(string.punctuation, k=rnd.randint(0, 4))) for _ in range(3000)]
    split, seen = enc._split, []
    enc._split = lambda text: seen.append(text) or split(text)
    for word in words:
        assert enc._chunk(word) == enc._whole(word), word
    assert not seen and enc._normalize("ÀÉ") == "àé" and enc._normalize is str.lower


def test_ids_are_counted_a_batch_at_a_time(monkeypatch):
    import numpy as np
    import pyarrow as pa

    from vaultsmith.llm import ans

    rows = [np.array(x, np.uint16).tobytes() for x in ([1, 2, 2], [], [7], [2, 1])]
    batch = pa.record_batch([pa.array(rows, pa.binary())], names=["ids"])
    calls, bincount = [], np.bincount
    monkeypatch.setattr(ans.np, "bincount", lambda *a, **k: calls.append(1) or bincount(*a, **k))
    count = lambda *b: {t: n for t, n in zip(*next(ans._counting(np.dtype(np.uint16), 9)(iter(b))).to_pydict().values())}
    assert count(batch) == {1: 2, 2: 3, 7: 1} and len(calls) == 1
    assert count(batch.slice(2)) == {7: 1, 2: 1, 1: 1} and count(batch.slice(1, 1)) == {} and count(batch.slice(0, 0)) == {}
