"""Classifier, tokenizer, chat, sharding and the pipeline."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer as Library

import corpus_pipeline
from leadmill.llm.bpe import encode_documents, tokenizer
from leadmill.llm.chat import best_paths, format_conversations, read_back, read_path, reply_chains
from leadmill.llm.quality_classifier import fit_nnpu, fit_prior, score_documents
from leadmill.llm.sharding import find_cuts, group_key, shard_documents, smallest_capacity

SF = "/root/testdata/sf0.01"
PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_classifier_ranks_held_out_documents(spark):
    out = score_documents(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    rows = out.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out").collect()
    good, bad = ([r["score"] for r in rows if r["quality"] == q] for q in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.95
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.9
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in out.collect())


def test_prior_and_risk_on_two_clouds():
    rng = np.random.default_rng(3)
    one = lambda x: np.concatenate([x, np.ones((len(x), 1))], axis=1)
    pos, unl = rng.normal(1.5, 1, (4000, 2)), np.concatenate([rng.normal(1.5, 1, (2800, 2)), rng.normal(-1.5, 1, (1200, 2))])
    prior = fit_prior(one(pos), one(unl))
    assert 0.6 < prior < 0.8
    w = fit_nnpu(one(pos), one(unl), prior)
    assert ((one(unl) @ w > 0) == (np.arange(4000) < 2800)).mean() > 0.95


def test_classifier_edge_cases(spark, docs):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (None, 1), (3, None)], "doc_id long, quality int")
    out = score_documents(docs([(1, "a b"), (2, None), (2, None), (None, ""), (3, "x " * 20000)]), labels).collect()
    assert len(out) == 5 and all(0 <= r["score"] <= 1 for r in out)
    assert {r["score"] for r in score_documents(docs([(1, "a")]), labels.where("false")).collect()} == {0.5}
    assert score_documents(docs([]), labels).count() == 0


LETTERS = st.one_of(st.characters(codec="utf-8"), st.sampled_from(list(" \n\t'st  \x1c\x85") + ["<|endoftext|>", " the", "ing", "aaaa", "  "]))


@settings(max_examples=400, deadline=None)
@given(st.lists(LETTERS, max_size=40).map("".join))
def test_tokens_equal_the_library(text):
    lib, own = Library.from_file(PATH), tokenizer(PATH)
    ids = np.frombuffer(own.encode(text), np.int32).tolist()
    assert ids == lib.encode(text, add_special_tokens=False).ids
    assert own.decode(ids) == lib.decode(ids, skip_special_tokens=False)


def test_encode_documents(spark, docs):
    rows = [(1, None), (2, ""), (3, "<|endoftext|> x<|endoftext|>"), (3, "<|endoftext|> x<|endoftext|>"), (None, "é" * 9000), (4, "word " * 30000)]
    lib = Library.from_file(PATH)
    got = Counter((r["row"]["doc_id"], tuple(r["ids"]), r["decoded"]) for r in encode_documents(docs(rows), PATH, ["doc_id", "fp"], True).collect())
    assert got == Counter((i, tuple(lib.encode(t or "", add_special_tokens=False).ids), t or "") for i, t in rows)
    assert encode_documents(docs([]), PATH, ["doc_id"]).count() == 0


def test_many_texts_are_decoded_at_once():
    own = tokenizer(PATH)
    texts = ["", "é a", "x" * 70, "", "<|endoftext|>\n"]
    ids = [np.frombuffer(own.encode(t), np.int32) for t in texts]
    half = np.array([own.automaton.ids["é".encode()[:1]]], np.int32)        # half a character
    for coded, expected in ((ids, texts), ([*ids, half], [*texts, "\ufffd"])):
        offsets = np.concatenate([[0], np.cumsum([len(c) for c in coded])]).astype(np.int32)
        assert own.decode_all(offsets, np.concatenate(coded)).to_pylist() == expected


def test_300000_words_stay_in_memory(monkeypatch):
    own = tokenizer(PATH)
    text = " ".join(f"w{i}" for i in range(300_000))
    first = own.encode(text)
    monkeypatch.setattr(own.automaton, "encode", None)      # every word has been met
    assert own.encode(text) == first


def test_query_tokens_equal_the_library_on_all_documents(spark):
    from leadmill.llm.queries import QUERIES
    lib, texts = Library.from_file(PATH), {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in QUERIES["op6_bpe"](spark, SF).collect():
        ids = lib.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((texts[r["doc_id"]] or "").encode()).hexdigest()


CHAT = [(1, 1, "assistant", "two & <b> &amp; [INST]"), (1, 0, "user", "</s>[INST] ok [/INST]"), (2, 0, "us\ner", None), (2, None, None, "&lt;<|im_end|>\n"),
        (None, 0, "assistant", "x"), (None, 0, "assistant", "x"), (3, 0, "assistant", "é" * 5000)]


def test_conversations_read_back(spark):
    df = spark.createDataFrame(CHAT, "conv_id long, turn int, role string, text string").withColumn("formatted", F.lit(1))
    out = format_conversations(reply_chains(df)).withColumn("back", read_back(F.col("formatted"), F.col("mask"))).collect()
    got = {r["conv"]: (r["back"]["n_turns"], r["back"]["turns"], r["back"]["loss"]) for r in out}
    assert got["c1"] == (2, "user\n</s>[INST] ok [/INST]\nassistant\ntwo & <b> &amp; [INST]\n", "two & <b> &amp; [INST]")
    assert got["c2"] == (2, "\n&lt;<|im_end|>\n\nus\ner\n\n", "") and got[""][0] == 2 and got[""][2] == "xx" and got["c3"][2] == "é" * 5000
    assert all(r["formatted"].count("[INST]") == 0 for r in out)
    assert format_conversations(reply_chains(df.where("false"))).count() == 0


def test_best_branch_of_a_tree(spark):
    rows = [("c", 1, None, 0.0), ("c", 2, 1, 0.1), ("c", 3, 1, 0.9), ("c", 4, 3, 0.2), ("c", 5, 3, None), ("d", 1, None, 1.0), ("d", 7, 99, 5.0),
            ("e", 1, 2, 1.0), ("e", 2, 1, 1.0)] + [("f", i, i - 1 if i else None, 0.5) for i in range(37)]
    df = spark.createDataFrame(rows, "conv string, id long, parent long, score double").withColumn("role", F.lit("user")).withColumn("text", F.col("id").cast("string"))
    paths = defaultdict(list)
    for r in sorted(best_paths(df, 2).collect(), key=lambda r: -r["pos"]):
        paths[r["conv"], r["path"]].append(int(r["text"]))
    assert paths == {("c", 1): [1, 3, 4], ("c", 2): [1, 3, 5], ("d", 1): [7], ("d", 2): [1], ("f", 1): list(range(37))}
    assert read_path("") == []


def shards_by_hand(sizes, n):
    """Least capacity over contiguous partitions, by dynamic programming."""
    best = [0] + [float("inf")] * len(sizes)
    for _ in range(n):
        best = [min([best[i]] + [max(best[j], sum(sizes[j:i])) for j in range(i)]) for i in range(len(sizes) + 1)]
    return best[-1]


@pytest.mark.parametrize("seed", range(6))
def test_capacity_is_the_smallest(seed):
    r = random.Random(seed)
    sizes = [r.randint(1, 50) for _ in range(r.randint(1, 30))] + [400] * (seed % 2)
    r.shuffle(sizes)
    assert smallest_capacity(sizes, 5) == shards_by_hand(sizes, 5)


def test_shards_of_documents(spark, docs, monkeypatch):
    r = random.Random(2)
    rows = [(i, "t" * r.randint(0, 400) + str(i % 311)) for i in range(900)] + [(i, "hot") for i in range(1000, 1400)]
    rows += [(2000, None), (2001, None), (2002, ""), (2003, "é"), (5, rows[5][1]), (None, "null id")]
    monkeypatch.setattr("leadmill.llm.sharding.WHOLE_BELOW", 20)       # several rounds of finer ranges
    monkeypatch.setattr("leadmill.llm.sharding.OPEN_AT_ONCE", 3)
    monkeypatch.setattr("leadmill.llm.sharding.FIRST_DIGITS", 1)
    monkeypatch.setattr("leadmill.llm.sharding.MORE_DIGITS", 1)
    out = shard_documents(docs(rows), 8).collect()
    size = lambda t: len((t or "").encode()) + 1
    assert Counter((x["doc_id"], x["size"], x["text_crc32"]) for x in out) == Counter((i, size(t), zlib.crc32((t or "").encode())) for i, t in rows)
    slots, load, of_text = defaultdict(list), Counter(), defaultdict(set)
    texts = defaultdict(set)
    for i, t in rows:
        texts[i, size(t), zlib.crc32((t or "").encode())].add(t)
    for x in out:
        slots[x["shard"]].append(x["slot"])
        load[x["shard"]] += x["size"]
        (t,) = texts[x["doc_id"], x["size"], x["text_crc32"]]
        of_text[t].add(x["shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and all(len(s) == 1 for s in of_text.values())
    groups = Counter()
    for i, t in rows:
        groups["-" if t is None else hashlib.sha256(t.encode()).hexdigest()] += size(t)
    assert max(load.values()) == smallest_capacity([groups[k] for k in sorted(groups)], 8)
    assert shard_documents(docs([])).count() == 0


def test_cuts_do_not_depend_on_the_search(spark, docs):
    df = spark.range(5000).select(group_key(F.col("id").cast("string")).alias("gkey"), (F.col("id") % 97 + 1).alias("g_size"))
    rows = sorted((r["gkey"], r["g_size"]) for r in df.collect())
    cuts = find_cuts(df, 8)
    loads, at = Counter(), 0
    for k, s in rows:
        loads[sum(k >= c for c in cuts)] += s
    assert max(loads.values()) == smallest_capacity([s for _, s in rows], 8) and len(cuts) == 7


def test_pipeline_stages_and_result(spark):
    sf = "/root/testdata/sf0.001"
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "near_dups", "decontamination", "secret_scans", "tokens"]
    rows = corpus_pipeline.run(spark, sf).collect()
    assert rows and all(r["round_trip"] for r in rows) and len({r["doc_id"] for r in rows}) == len(rows)


def test_pipeline_by_hand(spark, docs):
    import tempfile
    good = [" ".join(f"w{(i * 31 + j * 7) % 997}" for j in range(120)) for i in range(30)]
    rows = [(i, t) for i, t in enumerate(good)]
    rows += [(100, good[0]), (101, good[1] + " more"), (102, "short"), (103, None), (104, good[2] + " token = \"" + "0123456789abcdef" * 2 + "\""),
             (105, " ".join(f"q{i}" for i in range(100)) + " " + " ".join(f"bench{i}" for i in range(20)))]
    sf = tempfile.mkdtemp(prefix="leadmill-test-")
    docs(rows).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(0, " ".join(f"bench{i}" for i in range(20)))], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    out = {r["doc_id"]: r for r in corpus_pipeline.run(spark, sf).collect()}
    assert sorted(out) == list(range(30))
    lib = Library.from_file(PATH)
    for i in range(30):
        assert out[i]["ids"] == lib.encode(good[i], add_special_tokens=False).ids and out[i]["round_trip"]
