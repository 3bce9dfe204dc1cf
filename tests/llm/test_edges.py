"""Defined results for nulls, empty and very long texts, ties, repeated rows, empty tables and clashing names."""

import hashlib
import json
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from vaultsmith.llm import ans, chat, lattice, minmax, packing, quality, topk, toxicity, urlrules, warc
from vaultsmith.llm._common import shared_path
from vaultsmith.llm._tokens import ChunkEncoder, tokenizer_path

BYTE = tokenizer_path("byte_bpe_50k.json")
WORD = tokenizer_path("word_bpe_49k.json")
PIECE = tokenizer_path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, lang string, source string, quality string, kept string, node string, ids string"
LONG = "word " * 30_000 + "x" * 20_000

ROWS = [(1, None), (2, ""), (3, "  \n\t "), (4, "two words"), (4, "two words"), (None, "no id at all here"),
        (5, LONG), (6, "Ünïcode 漢字 😀 <|endoftext|> </s> \x1c\x85 end"), (7, "one"), (8, "ONE")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, None, None, "a", "b", "c", "d") for i, t in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


# ------------------------------------------------------------- op 1
def record(**kw):
    return json.dumps(kw)


def test_layouts_give_the_same_turns(spark):
    same = [
        record(messages=[{"role": "user", "content": "hi"}, {"role": "assistant", "content": "yo"}], id=7),
        record(conversations=[{"from": "human", "value": "hi"}, {"from": "gpt", "value": "yo"}]),
        record(instruction="hi", output="yo"), record(prompt="hi", response="yo", score=1.5), record(prompt="hi", completion="yo"),
        record(question="hi", answer="yo", context=None),
        record(turns=[{"turn": 1, "role": "assistant", "text": "yo"}, {"turn": 0, "role": "user", "text": "hi"}]),
    ]
    odd = [None, "", "[]", "{}", "not json", record(foo="x"), record(prompt="only")]
    df = spark.createDataFrame([(k, r, "x") for k, r in enumerate(same + odd)], "conv_id long, record string, chat string")
    rows = {r["conv_id"]: r["chat"] for r in chat.canonical_turns(df).collect()}
    for k in range(len(same)):
        assert [(t["role"], t["text"]) for t in rows[k]["turns"]] == [("user", "hi"), ("assistant", "yo")], same[k]
    assert len({rows[k]["fingerprint"] for k in range(len(same))}) == len(same)
    for k in range(len(same), len(same) + len(odd)):
        assert rows[k]["layout"] is None and rows[k]["turns"] == []


def test_instruction_with_input_and_system(spark):
    assert chat.turns_of(record(system="be", instruction="add", input="1+1", output="2"))[2] == [
        ("system", "be"), ("user", "add\n\n1+1"), ("assistant", "2")]


def test_format_is_reversible(spark):
    texts = [*chat.CONTROL, "\\", "\\\\<s>", "<\\s>", "<<SYS>>[INST]</s></s>", "a\\nb\n", "", "😀é<|im_end|>", "x" * 200_000]
    rows = [(k, 0, "assistant" if k % 2 else "user", t) for k, t in enumerate(texts)] + [
        (100, None, None, None), (100, 1, "assistant", "b"), (100, 1, "assistant", "a"), (100, 1, "assistant", "a"), (None, 0, "a<s>\n", "t")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    chats = chat.canonical_turns(chat.conversation_records(df)).select("conv_id", "chat.turns")
    made = {r["conv_id"]: r for r in chat.read_back(chat.format_chat(chats)).collect()}
    for k, t in enumerate(texts):
        r = made[k]
        assert chat.parse(r["formatted"]) == [("assistant" if k % 2 else "user", t)]
        assert r["back"]["loss_chars"] == (len(t) if k % 2 else 0) and r["back"]["formatted_chars"] == len(r["formatted"])
        body = r["formatted"]
        for c in chat.CONTROL:
            inside = body.removeprefix(chat.START).removesuffix(chat.END).replace(chat.SEP, "", 1)
            assert c not in inside
    assert chat.parse(made[100]["formatted"]) == [("", ""), ("assistant", "a"), ("assistant", "a"), ("assistant", "b")]
    assert made[100]["back"]["loss_sha256"] == hashlib.sha256(b"aab").hexdigest()
    assert chat.parse(made[None]["formatted"]) == [("a<s>\n", "t")]


# ------------------------------------------------------------- op 2
def test_hilbert_keys_walk_the_grid():
    n = 1 << 3
    cells = np.array([(x, y, z) for x in range(n) for y in range(n) for z in range(n)])
    keys = packing.hilbert_keys(cells, 3)
    assert sorted(keys.tolist()) == list(range(n**3))
    path = cells[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_packing_edges(spark, docs, none):
    pieces = packing.pack(docs, BYTE)
    rows = pieces.collect()
    whole = ChunkEncoder(BYTE)._whole
    want = sorted((str(i), np.frombuffer(whole(t or ""), "<u2").tolist() + [1]) for i, t in ROWS)
    total = sum(len(x) for _, x in want)
    assert sum(r["length"] for r in rows) == total
    assert sorted({r["sequence_id"] for r in rows}) == list(range(-(-total // 2048)))
    by_doc = {}
    for r in sorted(rows, key=lambda r: r["start"]):
        if r["doc_id"] != 4:
            by_doc[r["doc_id"]] = by_doc.get(r["doc_id"], []) + np.frombuffer(r["ids"], "<u4").tolist()
    assert {str(k): v for k, v in by_doc.items()} == {k: v for k, v in want if k != "4"}
    full = packing.sequences(pieces).collect()
    assert all(len(r["ids"]) == 2048 or len(r["ids"]) & (len(r["ids"]) - 1) == 0 for r in full)
    assert sum(sum(r["lengths"]) for r in full) == total
    assert packing.pack(none, BYTE).count() == 0


# ------------------------------------------------------------- op 3
def test_audit_finds_exactly_the_damage(spark):
    rows = [(i, f"http://x/{i}", "html " * (i % 7)) for i in range(5000) if i % 13] + [(None, None, None), (77, "u", "twice"), (77, "u", "twice")]
    a = spark.createDataFrame(rows, "page_id long, url string, html string")
    b = a.where("coalesce(page_id, 0) <> 40").withColumn("html", F.when(F.col("page_id") == 4099, "bad").otherwise(F.col("html")))
    b = b.unionByName(spark.createDataFrame([(26, "n", "new"), (77, "u", "twice")], a.schema))
    found = {(r["kind"], r["page_id"], r["file"]) for r in warc.audit(a, b).collect()}
    assert found == {("missing", 40, 0), ("changed", 4099, 1), ("extra", 26, 0), ("changed", 77, 0)}
    assert warc.audit(a, a).count() == 0
    assert warc.audit(a.where("false"), a.where("false")).count() == 0
    assert warc.audit(a.where("page_id = 9"), a.where("false")).first()["kind"] == "missing"


def test_audit_reads_only_differing_branches(spark):
    a = spark.range(3000).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.col("id").cast("string").alias("html"))
    ta, tb = warc.trees(a, a.withColumn("html", F.when(F.col("page_id") == 1234, "x").otherwise(F.col("html"))))
    assert [x.count() for x in ta] == [3000, 188, 12, 1]
    assert [warc._differing(x, y).count() for x, y in zip(ta, tb)] == [1, 1, 1, 1]


# ------------------------------------------------------------- op 4
def test_rans_round_trip_and_checkpoints():
    rng = np.random.default_rng(1)
    counts = np.zeros(50_000, np.int64)
    data = np.minimum(rng.zipf(1.3, 300_000) - 1, 49_999)
    np.add.at(counts, data, 1)
    freq = ans.frequencies(counts)
    assert freq.sum() == 1 << ans.SCALE_BITS and ((freq > 0) == (counts > 0)).all()
    coder = ans.Coder(freq)
    cuts = [0, 0, 5, 5, 1000, 120_000, 300_000]
    docs = [data[a:b] for a, b in zip(cuts, cuts[1:])]
    frame = ans.write_frame(coder, [3, None, 3, 4, 5, 6], docs)
    block = ans.Frame(frame)
    assert (block.tokens(coder) == data).all() and block.ids == [3, None, 3, 4, 5, 6]
    parts = [block.part(coder, k) for k in reversed(range(len(block.marks)))][::-1]
    assert len(parts) > 5 and (np.concatenate(parts) == data).all()
    entropy = -(counts[counts > 0] * np.log2(counts[counts > 0] / counts.sum())).sum() / 8
    assert 4 * len(block.words) < 1.1 * entropy + 8 * ans.LANES
    for at in (10, len(frame) // 2, len(frame) - 1):
        with pytest.raises(ValueError):
            ans.Frame(frame[:at] + bytes([frame[at] ^ 1]) + frame[at + 1:])


@pytest.mark.parametrize("counts", [[0, 5], [1] * 1000 + [10**9], [0, 0, 0]])
def test_frequencies_add_up(counts):
    f = ans.frequencies(np.array(counts))
    assert f.sum() == ((1 << ans.SCALE_BITS) if sum(counts) else 0)
    assert all((x > 0) == (c > 0) for x, c in zip(f, counts))


def test_token_file_edges(spark, docs, none):
    folder = shared_path(spark, "test-ans")
    ans.write_token_files(docs, WORD, folder)
    rows = sorted(ans.read_token_files(spark, folder).collect(), key=lambda r: r["start"])
    whole = ChunkEncoder(WORD)._whole
    assert [r["doc_id"] for r in rows] == sorted((i for i, _ in ROWS), key=lambda i: (i is not None, i or 0))
    texts = {i: t for i, t in ROWS}
    at = 0
    for r in rows:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert r["start"] == at and ids == np.frombuffer(whole(texts[r["doc_id"]] or ""), "<u2").tolist() + [2]
        at += len(ids)
    folder = shared_path(spark, "test-ans")
    ans.write_token_files(none, WORD, folder)
    assert ans.read_token_files(spark, folder, digest=True).count() == 0


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_chunk_encoder_equals_the_tokenizer(path):
    import random

    random.seed(3)
    e = ChunkEncoder(path)
    letters = "ab1.,'s  \n\t\x85\xa0 　\x1c\x1f​́éΣσİß\r\x0b漢&<|>ñÀŁ_-"
    for _ in range(4000):
        text = "".join(random.choice(letters) for _ in range(random.randint(0, 20)))
        assert e.encode(text) == e._whole(text), repr(text)
    assert e.encode("a <|endoftext|> b") == e._whole("a <|endoftext|> b")


# ------------------------------------------------------------- op 5
def test_url_rules(spark):
    urls = {
        None: (None, "allow"), "": (None, "allow"), "no scheme.net/en/": (None, "allow"),
        "http://net/x": ("net/", "block"), "http://net": (None, "allow"), "http://internet/x": (None, "allow"),
        "https://EXAMPLE.net/en/1": ("example.net/en/", "allow"), "https://a.example.net/en": ("net/", "block"),
        "x://a.b.example.com/de/": ("example.com/de/", "block"), "http://example.com/DE/": (None, "allow"),
        "http://w.org/fr/?u=http://x.net/": ("org/fr/", "allow"), "http://a.b?c.net/x": (None, "allow"),
        "http://x.com/?utm_source=1": (None, "block"), "http://ads.x.com/": (None, "block"), "http://x.com/login/": (None, "block"),
        "http://x.org/fr/login/": ("org/fr/", "allow"), "http://x.net:80/": (None, "allow"),
    }
    rows = [(k, u, "h", "r", "b") for k, u in enumerate(urls)] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, rule string, best string")
    out = urlrules.judge_urls(pages, urlrules.HOST_RULES + urlrules.PATTERN_RULES).collect()
    assert len(out) == len(rows)
    for r in out:
        assert (r["rule"], r["verdict"]) == urls[r["url"]], r
        assert r["best"] == "b" and r["path"] is not None
    assert urlrules.judge_urls(pages, []).where("verdict <> 'allow'").count() == 0
    assert urlrules.judge_urls(pages.where("false"), urlrules.HOST_RULES).count() == 0


def test_rules_are_indexed_by_their_rarest_token(spark):
    urls = spark.createDataFrame([(f"http://a{k}.example.net/en/", f"a{k}.example.net/en/") for k in range(5)]
                                 + [("http://b.net/x", "b.net/x")], "url string, full string")
    index = {r["rule"]: r["token"] for r in urlrules.rule_index(urls, urlrules.HOST_RULES + urlrules.PATTERN_RULES).collect()}
    assert index["example.net/en/"] in ("en", "example") and index["net/"] == "net"
    assert index["?utm_source="] in ("utm", "source")


# ------------------------------------------------------------- op 6
def brute(rows, queries, k):
    out = []
    for q, v in sorted(set(queries)):
        scores = sorted(((-sum(x * y for x, y in zip(v, w)), i) for i, w in set(rows) if i != q and len(w) == len(v)))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("block,query_block", [(8192, 1024), (37, 5)])
def test_top_k_equals_brute_force(spark, block, query_block):
    rng = np.random.default_rng(5)
    rows = [(i, tuple(rng.integers(-3, 4, 8).tolist())) for i in range(300)]
    rows += [(i, (1,) * 8) for i in range(300, 400)] + [(400, (0,) * 8), (401, (2, 3)), (402, (5, 5)), (7, rows[7][1])]
    df = spark.createDataFrame([(i, list(v)) for i, v in rows], "vec_id long, v array<long>").distinct()
    got = topk.top_k(df, F.col("vec_id") % 20 == 0, 5, block, query_block).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, [r for r in rows if r[0] % 20 == 0], 5)


def test_unusable_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, -0.5]), (1, None), (2, [nan, 1.0]), (3, [inf, 1.0]), (4, [None, 1.0]), (5, []), (None, [1.0, 1.0]),
            (6, [-0.01, 1.0]), (6, [-0.01, 1.0]), (7, [3e8, 3e8])]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<double>, score int, rank int")
    v = topk.integer_vectors(df, "vec_id", "embedding")
    assert sorted((r["vec_id"], r["v"]) for r in v.collect()) == [(0, [32, -32]), (6, [-1, 64]), (7, [int(64 * 3e8)] * 2)]
    got = topk.top_k(v, F.col("vec_id") % 20 == 0).orderBy("rank").collect()
    assert [tuple(r) for r in got] == [(0, 1, 7, 0), (0, 2, 6, -32 - 2048)]
    assert topk.top_k(v.where("false"), F.col("vec_id") % 20 == 0).count() == 0


# ------------------------------------------------------------- op 7
def test_lattice_edges(spark, docs, none):
    model = lattice.pieces(PIECE)
    want = sorted((str(i), [p for u in lattice.words(t) for p in lattice.best_path(lattice.SPACE + u, model)]) for i, t in ROWS)
    for max_units in (lattice.MAX_BROADCAST_UNITS, 0):
        encoded = lattice.encode(docs, PIECE, max_units=max_units)
        rows = encoded.collect()
        assert sorted((str(r["doc_id"]), np.frombuffer(r["ids"], "<u4").tolist()) for r in rows) == want
    texts = sorted((str(r["doc_id"]), r["text"]) for r in lattice.decode(encoded, PIECE).collect())
    assert texts == sorted((str(i), t or "") for i, t in ROWS)
    assert lattice.encode(none, PIECE).count() == 0


def test_fold_and_loop_take_the_same_path(spark):
    model = lattice.pieces(PIECE)
    words = ["▁the", "▁▁▁▁x", "▁" * 40, "▁relationship", "漢字テスト", "▁ñandú😀", "a" * 300, "\n", "▁x\ty"]
    df = spark.createDataFrame([(w.replace("▁", " ")[1:] if w.startswith("▁") else w,) for w in words], "text string")
    for r in lattice.dictionary(df, PIECE).collect():
        assert r["ids"] == lattice.best_path(r["unit"], model), r["unit"]


# ------------------------------------------------------------- op 8
def test_toxicity_edges(spark, docs, none):
    labels = spark.createDataFrame([(4, 1, 1), (7, 0, 0), (7, 0, None), (99, 0, 1), (None, 0, 1)], "doc_id long, quality int, toxic int")
    out = toxicity.toxicity(docs, labels).collect()
    assert len(out) == len(ROWS) and all(r["kept"] == "b" for r in out)
    for lab in (labels.where("false"), labels.where("toxic = 0")):
        clean = toxicity.toxicity(docs, lab).collect()
        assert {(r["toxicity"]["severity"], r["toxicity"]["toxic"], r["toxicity"]["expected_severity"]) for r in clean} == {(0, False, 0.0)}
    assert toxicity.toxicity(none, labels).count() == 0


def test_severity_follows_dose():
    data, rng = [], np.random.default_rng(0)
    for k in range(400):
        n = int(rng.integers(50, 200))
        hits = int(rng.integers(1, 12)) if k % 2 else 0
        data.append((int(hits > 0), n, hits, [0] if hits else [], [hits] if hits else []))
    model = toxicity.train(("bad",), data)
    assert model.weights[0] > 0 and (np.diff(model.cuts) > 0).all()
    tails = model.tails(np.array([0.0, model.weights[0] * 0.5, model.weights[0] * 3.0]))
    assert tails[0].sum() < 0.3 < tails[1].sum() < tails[2].sum() and tails[2].sum() > 2


# ------------------------------------------------------------- op 9
def test_quality_edges(spark, docs, none):
    rows = quality.quality_rules(docs).collect()
    by_id = {r["doc_id"]: r for r in rows}
    assert len(rows) == len(ROWS)
    assert by_id[1]["quality"]["n_words"] == by_id[2]["quality"]["n_words"] == by_id[3]["quality"]["n_words"] == 0
    assert all(by_id[i]["base_failed"] and not by_id[i]["kept"] for i in (1, 2, 3, 4, 7))
    long = by_id[5]["quality"]
    assert long["n_words"] == 30_001 and long["n_repeat_words"] == 30_000 and by_id[5]["base_failed"]
    assert by_id[1]["node"] == "c"
    assert quality.quality_rules(none).count() == 0


def test_sketches_merge(spark):
    docs = spark.createDataFrame([(i, "word " * (10 + i) + "#" * (i % 9), "en", f"s{i % 2}") for i in range(60)],
                                 "doc_id long, text string, lang string, source string")
    measured, group = quality.measure(docs), ["lang", "source"]
    parts = [quality.sketch(measured.where(F.col("doc_id") % 3 == k), group) for k in range(3)]
    one = quality.sketch(measured, group)
    assert sorted(map(str, quality.merge(*parts).collect())) == sorted(map(str, one.select(*quality.merge(one).columns).collect()))


def test_adaptive_fences_differ_by_group(spark):
    clean = "the quick brown fox jumps over a lazy dog near some river bank today and then it sleeps"
    rows = [(i, clean + f" n{i}", "en", "plain") for i in range(50)] + [(100 + i, clean.replace(" ", " # ") + f" n{i}", "en", "code") for i in range(50)]
    rows.append((999, clean.replace(" ", " # ") + " odd", "en", "plain"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r["doc_id"]: r["kept"] for r in quality.quality_rules(docs).collect()}
    assert not kept.pop(999) and all(kept.values())


# ------------------------------------------------------------- op 10
def test_near_duplicate_edges(spark, docs, none):
    rows = minmax.near_duplicates(docs, shingle=3, percent=85).collect()
    got = sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"]), r["kept"]) for r in rows)
    assert ("1", 0, "1", True) in got and ("2", 0, "2", True) in got and ("3", 0, "3", True) in got
    assert got.count(("4", 1, "4", True)) == 2 and ("None", 3, "None", True) in got
    assert ("7", 1, "7", True) in got and ("8", 1, "7", False) in got
    assert minmax.near_duplicates(none).count() == 0


def test_chain_and_group_of_near_copies(spark):
    """Links form chains; many members too different from each other stay apart."""
    rng = np.random.default_rng(9)
    base = [f"w{k}" for k in range(300)]
    texts = [" ".join(base)]
    for step in range(1, 8):  # each differs a little from the one before
        base = base.copy()
        base[40 * step - 20] = f"new{step}"
        texts.append(" ".join(base))
    core = [f"c{k}" for k in range(200)]
    for k in range(60):
        own = core.copy()
        for at in rng.choice(200, 7, replace=False):
            own[at] = f"x{k}_{at}"
        texts.append(" ".join(own))
    texts += [texts[0], texts[10]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in minmax.near_duplicates(df, shingle=3, percent=85).collect()}
    sets = [set(minmax.shingle_set(minmax._words(t), 3).tolist()) for t in texts]
    group = list(range(len(texts)))
    changed = True
    while changed:
        changed = False
        for a in range(len(texts)):
            for b in range(a):
                if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]) and group[a] != group[b]:
                    low = min(group[a], group[b])
                    group = [low if g in (group[a], group[b]) else g for g in group]
                    changed = True
    assert [got[k] for k in range(len(texts))] == group


def test_min_max_signature_is_unbiased():
    rng = np.random.default_rng(2)
    signer = minmax.Signer()
    close = []
    for _ in range(40):
        pool = rng.integers(0, 2**63, 600, dtype=np.uint64)
        a, b = signer.signature(np.unique(pool[:500])), signer.signature(np.unique(pool[100:]))
        close.append((a == b).mean())
    assert abs(np.mean(close) - 400 / 600) < 0.02
    assert len(signer.mul) * 2 == minmax.ROWS * minmax.BANDS
