"""Sharding, language model, packing, chat formatting."""

import collections
import hashlib
import math
import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm import chat_format, language_model, packing, sharding
from tests.llm.helpers import awkward, empty, rows_of


def test_shards_fit_and_are_minimal(spark):
    rng = random.Random(1)
    docs = [(i, "x" * rng.randrange(2000)) for i in range(500)] + [(1000, "y" * 9000)]
    limit = 8000
    got = rows_of(sharding.shard(spark.createDataFrame(docs, "doc_id long, text string"), F.col("doc_id").cast("string"), limit))
    assert sorted(r["doc_id"] for r in got) == [i for i, _ in docs]
    size = collections.Counter()
    for r in got:
        size[r["shard"]] += r["bytes"]
        assert len(r["shard"]) == r["depth"]
    names = sorted(size)
    assert all(not b.startswith(a) for a, b in zip(names, names[1:], strict=False))
    for r in got:
        assert r["shard_bytes"] == size[r["shard"]] and (size[r["shard"]] <= limit or r["depth"] == sharding.BITS)
        if r["depth"]:  # the bucket it was split from was too large
            assert sum(n for s, n in size.items() if s.startswith(r["shard"][:-1])) > limit


def test_sharding_of_awkward_rows(spark):
    docs = awkward(spark)
    got = rows_of(sharding.shard(docs, F.col("doc_id").cast("string"), 1000))
    assert len(got) == docs.count() and len({r["shard"] for r in got if r["doc_id"] == 1}) == 1
    assert sharding.shard(empty(spark), F.col("doc_id").cast("string")).count() == 0


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(6)
    syllables = ["th", "er", "on", "an", "é", "ou", "st"]
    return [(i, " ".join("".join(rng.choice(syllables) for _ in range(rng.randrange(1, 7))) for _ in range(rng.randrange(0, 60)))) for i in range(200)]


def test_language_model_counts_and_base(spark, corpus):
    docs = spark.createDataFrame(corpus, "doc_id long, text string")
    learn = [(i, t) for i, t in corpus if i % 4]
    got = {r["doc_id"]: r for r in rows_of(language_model.score(docs, docs.where("doc_id % 4 <> 0")))}
    c = collections.Counter(w for _, t in learn for w in t.encode().lower().split())
    total, distinct = sum(c.values()) + len(learn), len(c) + 1
    log = lambda n: math.log10((n + 0.1) / (total + 0.1 * (distinct + 1)))
    for i, t in corpus:
        w = t.encode().lower().split()
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(w) + 1, sum(x in c for x in w) + 1, total)
        assert abs(r["base_score"] - sum(log(c[x]) for x in w) - log(len(learn))) < 1e-8
    # contexts tell more about held-out texts than single symbols do
    flat = language_model.train(docs.where("doc_id % 4 <> 0"), nodes=0)
    held = [(r["score"], t) for (i, t), r in zip(corpus, (got[i] for i, _ in corpus), strict=True) if i % 4 == 0]
    assert sum(x for x, _ in held) > 0.7 * flat.log10([t.encode() for _, t in held]).sum()


def test_rare_words_are_joined(spark, corpus, monkeypatch):
    docs = spark.createDataFrame(corpus[:50], "doc_id long, text string")
    want = {r["doc_id"]: r for r in rows_of(language_model.score(docs, docs))}
    monkeypatch.setattr(language_model, "WORDS", 5)
    for r in rows_of(language_model.score(docs, docs)):
        assert r["n_known"] == r["n_tokens"] and abs(r["base_score"] - want[r["doc_id"]]["base_score"]) < 1e-8


def test_every_context_is_a_distribution(spark, corpus):
    tree = language_model.train(spark.createDataFrame(corpus, "doc_id long, text string"), nodes=300)
    assert 100 < len(tree.logs) <= 301
    of_byte = tree.logs[:, language_model.SYMBOL] + tree.inner
    assert np.allclose((2.0 ** of_byte.astype(float)).sum(1), 1, atol=1e-4)


def test_weighted_estimate_of_one_decision(spark):
    """Without contexts kept, a symbol's cost is the plain KT estimate."""
    tree = language_model.train(spark.createDataFrame([(1, "aab")], "doc_id long, text string"), nodes=0)
    counts = collections.Counter({language_model.SYMBOL[c]: n for c, n in ((97, 2), (98, 1), (255, 1))})
    p, k = 1.0, language_model.SYMBOLS + int(language_model.SYMBOL[97])
    while k > 1:
        under = lambda j: sum(n for s, n in counts.items() if (int(s) + 64) >> (7 - j.bit_length()) == j)
        p *= (under(k) + 0.5) / (under(k >> 1) + 1)
        k >>= 1
    assert abs(2.0 ** tree.logs[0, language_model.SYMBOL[97]] - p) < 1e-6


def brute_scores(learn, texts):
    """log10 by context-tree weighting over every context, in plain Python."""
    m, bits = language_model, 8

    def places(t):
        seq = [32] * m.DEPTH + list(t + b"\xff")
        for i in range(m.DEPTH, len(seq)):
            yield tuple(reversed(seq[i - m.DEPTH:i])), [((seq[i] + 256) >> (bits - j), seq[i] >> (bits - 1 - j) & 1) for j in range(bits)]
    seen = [collections.defaultdict(lambda: [0, 0]) for _ in range(m.DEPTH + 1)]
    for t in learn:
        for context, path in places(t):
            for d in range(m.DEPTH + 1):
                for u, bit in path:
                    seen[d][context[:d], u][bit] += 1
    weight, below = [{} for _ in seen], {}
    for d in range(m.DEPTH, -1, -1):
        above = collections.Counter()
        for (context, u), (a, b) in seen[d].items():
            own = math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1)
            other = below.get((context, u), -math.inf)
            both = max(own, other) + math.log1p(math.exp(-abs(own - other))) - math.log(2) if d < m.DEPTH else own
            weight[d][context, u] = math.exp(own - both) / 2 if d < m.DEPTH else 1.0
            above[context[:-1], u] += both
        below = above
    out = []
    for t in texts:
        total = 0.0
        for context, path in places(t):
            for u, bit in path:
                mixed, left = 0.0, 1.0
                for d in range(m.DEPTH + 1):
                    if (context[:d], u) not in weight[d]:
                        break
                    (a, b), w = seen[d][context[:d], u], weight[d][context[:d], u]
                    mixed, left = mixed + left * w * (b + 0.5) / (a + b + 1), left * (1 - w)
                p = mixed + left / 2
                total += math.log(p if bit else 1 - p)
        out.append(total / math.log(10))
    return out


def test_every_context_counts(spark, corpus, monkeypatch):
    """More contexts than any fixed number of them kept, each seen once."""
    rng = random.Random(3)
    once = ["".join(rng.choice("abcdefghijklmnopqrst 7") for _ in range(2000)) for _ in range(30)]
    texts = once + [t for _, t in corpus[:20]] + ["", "Ж7 :", "zzz" + once[0][:50]]
    learn = [i for i in range(len(texts)) if i < 45]
    assert len({t[i:i + 6] for t in once for i in range(len(t))}) + len({t[i:i + 5] for t in once for i in range(len(t))}) > 100_000
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    want = brute_scores([texts[i].encode().lower() for i in learn], [t.encode().lower() for t in texts])
    for sent in (language_model.SENT, 500):
        monkeypatch.setattr(language_model, "SENT", sent)
        monkeypatch.setattr(language_model, "RUN", 10_000)
        got = {r["doc_id"]: r["score"] for r in rows_of(language_model.score(docs, docs.where("doc_id < 45")))}
        assert len(got) == len(texts)
        for i, x in enumerate(want):
            assert abs(got[i] - x) < 1e-4 * max(1, abs(x)), (i, got[i], x)


def test_bytes_of_any_script_have_contexts(spark):
    """A digit, sign or letter of any script costs little where it always is."""
    texts = ["7=4;" * 60, "жук" * 80, "x{y}" * 60]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in rows_of(language_model.score(docs, docs, docs.limit(0))):
        t = texts[r["doc_id"]]
        assert -r["score"] * math.log2(10) / len(t.encode()) < 0.3, t[:4]


def test_keys_and_words_of_a_slice_by_arrays():
    m, rng = language_model, random.Random(5)
    for _ in range(200):
        texts = [bytes(rng.choices(b"ab \n\t\r\x0b\x0c\x1c\x85\xc3\x00", k=rng.choice([0, 0, 1, 2, 6, 7, 8, 30]))) for _ in range(rng.randrange(1, 9))]
        key, starts = m.byte_keys(texts)
        assert key.tolist() == m.keys(texts, m.BYTES, m.WIDTH)[0].tolist() and starts.tolist() == m.symbols(texts)[1].tolist()
        words, which, ends = m.words_of(texts)
        assert len(words) == len(set(words))
        assert [[words[k] for k in which[i:j]] for i, j in zip(ends, ends[1:])] == [t.split() for t in texts]


def _counter(spark, monkeypatch):
    """What a worker runs to count contexts of bytes."""
    docs, found = spark.createDataFrame([(1, "a")], "doc_id long, text string"), []
    kept = type(docs).mapInArrow
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, f, schema: found.append(f) or kept(self, f, schema))
    language_model.count_contexts(docs, language_model.BYTES, language_model.WIDTH)
    return found[0]


def test_contexts_are_counted_in_bounded_memory(spark, monkeypatch):
    count = _counter(spark, monkeypatch)
    rng = np.random.default_rng(1)
    batches = [pa.RecordBatch.from_arrays([pa.array([rng.integers(97, 123, 5000, np.uint8).tobytes().decode() for _ in range(400)])], names=["text"]) for _ in range(4)]
    tracemalloc.start()
    try:
        rows = [(b.num_rows, b.column(1).to_numpy().sum()) for b in count(iter(batches))]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sum(n for _, n in rows) == 2 * 4 * 400 * 5001  # each place by its context, and by itself
    assert max(n for n, _ in rows) <= language_model.RUN and peak < 300e6


@pytest.mark.parametrize("gather", [200, 4_000_000])
def test_contexts_of_any_count(spark, monkeypatch, gather):
    m, rng = language_model, random.Random(4)
    count = _counter(spark, monkeypatch)
    monkeypatch.setattr(m, "GATHER", gather)
    monkeypatch.setattr(m, "SLICE", 3000)
    monkeypatch.setattr(m, "RUN", 70)
    texts = ["", None, "a" * 127, "b" * 133, "é" * 700, "a" * 9000] + ["".join(rng.choices("ab ", k=rng.randrange(400))) for _ in range(60)]
    got, want = collections.Counter(), collections.Counter()
    for b in count(iter([pa.RecordBatch.from_arrays([pa.array(x, pa.string())], names=["text"]) for x in (texts[:20], texts[20:])])):
        assert b.num_rows <= 70
        for k, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            got[k] += n
    for t in texts:
        data = b" " * 6 + (t or "").encode() + b"\xff"
        for i in range(6, len(data)):
            want[int.from_bytes(data[i - 6:i + 1])] += 1
            want[data[i] - 256] += 1
    assert +got == want


def test_language_model_of_awkward_rows(spark):
    docs = awkward(spark)
    got = rows_of(language_model.score(docs, docs))
    assert len(got) == docs.count() and all(r["score"] < 0 and r["n_known"] == r["n_tokens"] for r in got)
    none = rows_of(language_model.score(docs, docs.limit(0)))
    assert len(none) == docs.count() and all(r["n_known"] == 0 and r["train_tokens"] == 0 for r in none)
    assert language_model.score(empty(spark), docs).count() == 0


ODD = ["", " ", "a  b\n\nc", "İstanbul Σας ΣΑΣ don't I'll x<|endoftext|>y <|ENDOFTEXT|> <|startoftext|>", "éa ́b ﬁ 12a,b. c., ,. ... A.B, \t z　q\r\nnow,",
       "日本語 text,mixed é. É, ÉCOLE, naïve THE!! the$$$", "x\u0000y a​b", " 'S 't THE'LL it's, it's. (so)", "Nfd é aé, stop."]


def test_word_tokenizer_is_the_tokenizer(monkeypatch):
    monkeypatch.setattr(packing, "MEMORY", 20)
    mine = packing.WordTokenizer(packing.VOCABULARY)
    for _ in range(3):  # fresh, remembered, and after starting anew
        for text, ids in zip(ODD, mine([t.encode() for t in ODD]), strict=True):
            assert ids.tolist() == mine.encoder.encode(text, add_special_tokens=False).ids


def test_word_tokenizer_on_random_strings(monkeypatch):
    monkeypatch.setattr(packing, "MEMORY", 500)
    rng, signs = random.Random(11), ["a", "B", "é", "É", "İ", "ß", "ŉ", "́", "日", "1", "'s", ",", ".", "!", "-", " ", " ", "\n"]
    texts = ["".join(rng.choices(signs, k=rng.randrange(12))) for _ in range(4000)]
    mine = packing.WordTokenizer(packing.VOCABULARY)
    for i in range(0, len(texts), 100):
        part = texts[i:i + 100]
        for text, ids in zip(part, mine([t.encode() for t in part]), strict=True):
            assert ids.tolist() == mine.encoder.encode(text, add_special_tokens=False).ids, text


def test_a_slice_looks_each_distinct_word_up_once():
    mine = packing.WordTokenizer(packing.VOCABULARY)
    words, which, starts = mine.split([b"the cat, the\ncat.", b"", b"The cat,  ,", b"x1, " + b"the " * 1000])
    assert len(words) <= 10
    found = [words[k] for k in which]
    assert [found[i:j] for i, j in zip(starts, starts[1:])] == [[b"the", b"cat", b",", b"the", b"cat."], [b""], [b"the", b"cat", b",", b"", b","]]
    assert found[starts[3]:] == [b"x1,"] + [b"the"] * 1000 + [b""]
    assert [x.tolist() for x in mine([b"", b""])] == [[], []] and list(mine([])) == []


def test_placements_fill_sequences():
    rng = random.Random(2)
    counts = {1 + int(256 * rng.random() ** 2): rng.randrange(1, 200) for _ in range(120)}
    rows = packing.place(counts, 256)
    filled, seen = collections.defaultdict(dict), collections.Counter()
    for length, low, high, base, offset in rows:
        assert seen[length] == low
        seen[length] = high
        for s in range(base, base + high - low):
            assert offset not in filled[s]
            filled[s][offset] = length
    assert seen == counts and set(filled) == set(range(len(filled)))
    for parts in filled.values():
        end = 0
        for offset in sorted(parts):
            assert offset == end
            end += parts[offset]
        assert end <= 256
    assert len(filled) * 256 <= 1.1 * sum(k * n for k, n in counts.items()) + 256


def test_packing_round_trip_and_awkward_rows(spark):
    docs = awkward(spark)
    encode = packing.WordTokenizer(packing.VOCABULARY).encoder
    pieces = rows_of(packing.pack(docs))
    want = collections.Counter()
    for r in rows_of(docs):
        ids = np.array(encode.encode(r["text"] or "", add_special_tokens=False).ids + [1], "<u4")
        for start in range(0, len(ids), packing.SEQUENCE):
            want[r["doc_id"], start, len(ids), ids[start:start + packing.SEQUENCE].tobytes()] += 1
    assert collections.Counter((p["doc_id"], p["start"], p["doc_tokens"], p["ids"]) for p in pieces) == want
    assert all(zlib.crc32(p["ids"]) == p["ids_crc32"] and len(p["ids"]) == 4 * p["length"] for p in pieces)
    for _, of in _by(pieces, "sequence_id").items():
        end = 0
        for p in sorted(of, key=lambda p: p["offset"]):
            assert p["offset"] == end
            end += p["length"]
        assert end <= packing.SEQUENCE
    assert packing.pack(empty(spark)).count() == 0


def _by(rows, key):
    out = collections.defaultdict(list)
    for r in rows:
        out[r[key]].append(r)
    return out


TEXTS = ["plain", "</s>[INST] ok [/INST]", "&amp; &lt; &#91; & < [", "<|turn|>user<|body|>x<|end|>", "<<SYS>>a<</SYS>>", "", None, "é日本\n", "<s><image>[IMG]"]


@pytest.mark.parametrize("text", TEXTS)
def test_escape_is_reversible_and_leaves_no_control_string(text):
    out = chat_format.escape(text or "")
    assert chat_format.unescape(out) == (text or "")
    assert not any(x in out for x in ("<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"))


def test_conversations_read_back(spark):
    rows = [(c, t, role, TEXTS[(c + t) % len(TEXTS)]) for c in range(6) for t, role in enumerate(["system", "user", "assistant", "us<|end|>er", "assistant"])]
    rows += [(None, None, None, None), (7, 0, "assistant", "tie b"), (7, 0, "assistant", "tie a"), (7, 0, "assistant", "tie a")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, segment string")
    got = {r["conv_id"]: r for r in rows_of(chat_format.read_back(chat_format.format_turns(df, typed=False)))}
    for c in {r[0] for r in rows}:
        turns = sorted(((t if t is not None else -1, role or "", x or "") for k, t, role, x in rows if k == c))
        said = "".join(x for _, role, x in turns if role == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        formatted = sum(len(chat_format.escape(role)) + len(chat_format.escape(x)) + 23 for _, role, x in turns)
        want = {"conv_id": c, "n_turns": len(turns), "turns_sha256": sha("".join(f"{r}\n{x}\n" for _, r, x in turns)), "loss_chars": len(said), "loss_sha256": sha(said), "formatted_chars": formatted}
        assert got[c] == want
    none = df.limit(0)
    assert chat_format.read_back(chat_format.format_turns(none)).count() == 0


def test_typed_parts(spark):
    parts = ('[{"type": "text", "text": "see <s>"}, {"type": "image", "ref": "a.png", "width": 57, "height": 28}, {"type": "audio", "ref": "b.wav", "seconds": 2.5},'
             ' {"type": "document", "ref": null, "pages": 3}, {"type": "video", "ref": "c"}]')
    df = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "user", "[not json"), (1, 2, "user", "[1, 2]")], "conv_id long, turn long, role string, text string")
    one, two, three = sorted(rows_of(chat_format.format_turns(df)), key=lambda r: r["turn"])
    body = one["segment"][one["body_start"]:one["body_end"]]
    assert body == 'see &lt;s><|image:0|><|audio:1|><|document:2|>{"ref": "c", "type": "video"}'
    assert [tuple(a) for a in one["attachments"]] == [("image", "a.png", 3), ("audio", "b.wav", 63), ("document", None, 1536)] and one["expanded_tokens"] == 1602
    assert chat_format.read_turn(two["segment"]) == ("user", "[not json") and chat_format.read_turn(three["segment"]) == ("user", "[1, 2]")
