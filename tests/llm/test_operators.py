"""Operators against brute force, and on odd tables."""

import itertools
import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from palimpsest.llm import chat, exact_dedup, fixity, hmm, minhash, mixing, pieces, placement, toxicity, vectors
from palimpsest.llm.queries import MODEL, QUERIES, SHARDS


# --------------------------------------------------------------------------- 1

@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load(MODEL)


def all_segmentations(word, v):
    if not word:
        return [(0.0, ())]
    out = []
    for j in range(1, len(word) + 1):
        p = v.pieces.get(word[:j])
        if p is None and j > 1:
            continue
        ids, s = ((p[0],), p[1]) if p else (tuple(v.bytes_[b] for b in word[0].encode()), v.unknown)
        out += [(s + rest, ids + more) for rest, more in all_segmentations(word[j:], v)]
    return out


@pytest.mark.parametrize("text", ["the cats", "tion ing", "a\nb c", "日x 本", "  two", "été là"])
def test_n_best_is_exact(vocabulary, text):
    got = pieces.Encoder(vocabulary, 6).encode(text)
    want = sorted((-s for s, _ in all_segmentations(("▁" + text).replace(" ", "▁"), vocabulary)))[:6]
    assert [-s for s, _ in got] == pytest.approx(want)
    assert len({ids for _, ids in got}) == len(got)
    for _, ids in got:
        assert pieces.decode_ids(np.frombuffer(ids, np.int32).tolist(), vocabulary) == text


def test_best_is_no_worse_than_the_library(vocabulary):
    from sentencepiece import SentencePieceProcessor
    from sentencepiece import sentencepiece_model_pb2 as proto
    model = proto.ModelProto()
    model.ParseFromString(SentencePieceProcessor(model_file=MODEL).serialized_model_proto())
    model.trainer_spec.model_type = proto.TrainerSpec.UNIGRAM          # the library's own lattice over the same scores
    library = SentencePieceProcessor(model_proto=model.SerializeToString())
    encoder = pieces.Encoder(vocabulary, 1)
    for text in ("Hello world", "the nation is reading", "unbelievable things"):
        ids = np.frombuffer(encoder.encode(text)[0][1], np.int32).tolist()
        score = sum(vocabulary.pieces[library.id_to_piece(i)][1] for i in ids)
        theirs = sum(vocabulary.pieces[library.id_to_piece(i)][1] for i in library.encode(text))
        assert score >= theirs and score == pytest.approx(theirs, rel=0.05)


def test_pieces_on_odd_rows(spark, odd, nothing, vocabulary):
    rows = pieces.decode(pieces.encode(odd, "text", vocabulary, 3).withColumn("ids", F.col("nbest")[0]["ids"]), "ids", vocabulary).collect()
    assert len(rows) == 10
    for r in rows:
        assert r["decoded"] == r["text"] and (r["nbest"] is None) == (r["text"] is None)
    assert pieces.encode(nothing, "text", vocabulary, 2).count() == 0


def test_n_best_are_distinct_when_sums_round():
    """Scores whose sums depend on the order of the additions: the two searches need not agree which of equals is first."""
    score = {"a": -0.1, "b": -0.4, "aa": -0.1, "ab": -0.4, "ba": -0.1, "bb": -0.4, "aaa": -0.4, "aab": -0.3, "aba": -0.4, "abb": -0.4,
             "baa": -0.3, "bab": -0.1, "bba": -0.7, "bbb": -0.1}
    v = pieces.Vocabulary({p: (300 + i, s) for i, (p, s) in enumerate(score.items())}, list(range(256)), -10.0, [b""] * 400, False)
    got = pieces.Encoder(v, 6).encode("bbbabbab")
    want = sorted((-s for s, _ in all_segmentations("bbbabbab", v)))[:6]
    assert len({ids for _, ids in got}) == 6 and [-s for s, _ in got] == pytest.approx(want)


def test_n_best_of_a_long_word_takes_linear_memory(vocabulary):
    rng = random.Random(3)
    text = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=8_000))
    encoder = pieces.Encoder(vocabulary, 4)
    tracemalloc.start()
    got = encoder.encode(text)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40e6
    assert len({ids for _, ids in got}) == 4 and sorted((s for s, _ in got), reverse=True) == [s for s, _ in got]
    assert all(pieces.decode_ids(np.frombuffer(ids, np.int32).tolist(), vocabulary) == text for _, ids in got)


# --------------------------------------------------------------------------- 2

SCHEMA = [("f", "b", "string", True), ("f", "z", "integer", False)]


def linked(spark, messages):
    m = spark.createDataFrame(messages, "conv_id long, turn long, role string, text string")
    return chat.link(m, spark.createDataFrame(SCHEMA, "tool string, parameter string, type string, required boolean")).collect()


def test_tool_calls(spark):
    rows = linked(spark, [
        (1, 0, "assistant", '{"tool_calls":[{"id":"a","name":"f","arguments":{"z":1, "b":"x"},"after":["b","none"]},{"id":"b","name":"f","arguments":{"b":3,"q":1}}]}'),
        (1, 1, "tool", '{"tool_call_id":"a","content":{"y":[1, 2],"c":"é"}}'), (1, 2, "tool", '{"tool_call_id":"q","content":"lost"}'),
        (2, 0, "assistant", '{"tool_calls":[{"id":"x","name":"g","arguments":1,"after":["y"]},{"id":"y","name":"f","after":["x"]}]}'),
        (3, 0, "assistant", "plain"), (3, 1, "assistant", None), (3, 2, None, ""), (None, None, "tool", "{}")])
    by = {(r["conv_id"], r["call_id"]): r for r in rows}
    a, b = by[1, "a"], by[1, "b"]
    assert (a["status"], a["level"], a["errors"]) == ("linked", 1, ["after:none"])
    assert a["line"] == '{"arguments":{"b":"x","z":1},"id":"a","name":"f","result":{"c":"é","y":[1,2]}}'
    assert (b["status"], b["level"], b["errors"]) == ("unanswered", 0, ["type:b", "unknown:q"])
    assert by[1, "q"]["status"] == "orphan" and by[None, None]["status"] == "orphan"
    assert by[2, "x"]["status"] == by[2, "y"]["status"] == "cyclic"
    assert by[2, "x"]["errors"] == ["tool"] and by[2, "y"]["errors"] == ["arguments"]
    assert linked(spark, [(9, 0, "user", "hi")]) == []


def test_levels_of_chains_forks_and_cycles(spark):
    rng = random.Random(4)
    calls = [(1, f"c{i}", [f"c{i - 1}"] if i else []) for i in range(70)]
    calls += [(2, f"c{i}", [f"c{rng.randrange(i)}" for _ in range(rng.randrange(4))] if i else []) for i in range(60)]
    calls += [(3, f"c{i}", [f"c{i - 1}", f"c{i - 2}"] if i > 1 else []) for i in range(20)]
    calls += [(4, f"c{i}", [f"c{(i + 1) % 5}"]) for i in range(5)] + [(4, "behind", ["c3", "free"]), (4, "free", []), (4, "self", ["self"])]
    calls += [(5, a, [b for b in "xyz" if b != a]) for a in "xyz"] + [(5, "late", ["x", "free", None, "none"]), (5, "free", [])]
    want = {}
    for chat_id in {c[0] for c in calls}:
        needs = {c: {n for n in after if n} for conv, c, after in calls if conv == chat_id}
        needs = {c: {n for n in after if n in needs} for c, after in needs.items()}
        level = 0
        while front := [c for c, after in needs.items() if (chat_id, c) not in want and all((chat_id, n) in want for n in after)]:
            want |= {(chat_id, c): level for c in front}
            level += 1
        want |= {(chat_id, c): None for c in needs if (chat_id, c) not in want}
    rows = chat.levels(spark.createDataFrame(calls, "conv_id long, call_id string, after array<string>")).collect()
    assert len(rows) == len(calls) and {(r["conv_id"], r["call_id"]): r["level"] for r in rows} == want


def test_calls_without_a_chat(spark):
    rows = linked(spark, [(None, 0, "assistant", '{"tool_calls":[{"id":"a","name":"f","arguments":{"b":"x"}}]}'),
                          (None, 1, "tool", '{"tool_call_id":"a","content":1}')])
    assert sorted((r["status"], r["level"] is None) for r in rows) == [("orphan", True), ("unanswered", False)]


# --------------------------------------------------------------------------- 3

def test_block_max_search_is_exact():
    rng = np.random.default_rng(0)
    words = [f"w{i}" for i in range(40)]
    idf = rng.uniform(1, 5, 40)
    vectors_ = []
    for _ in range(500):
        at = np.sort(rng.choice(40, rng.integers(1, 6), replace=False))
        vectors_.append(toxicity.weigh(at, rng.integers(1, 4, len(at)).astype(float), idf))
    index = toxicity.build(vectors_, rng.integers(0, 2, 500).tolist(), [1.0] * 500, words, idf, 0.0)
    dense = np.zeros((500, 40))
    for t, (ids, w, _) in enumerate(index.postings):
        dense[ids, t] = w
    for at, q in vectors_[:60]:
        found, scores = index.nearest(at, q)
        full = dense[:, at] @ q
        want = np.lexsort((np.arange(500), -np.round(full, 12)))[:toxicity.NEIGHBOURS]
        assert scores == pytest.approx(full[want]) and (full[found] == pytest.approx(scores))


def test_toxicity_learns_and_survives(spark, odd, nothing):
    docs = spark.createDataFrame([(i, f"word{i % 7} filler " + ("nastyword" if i % 4 == 0 else "kind")) for i in range(400)] + [(1000, None), (1001, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(0, 400)] + [(None, None, None)], "doc_id long, quality int, toxic int")
    index = toxicity.learn(docs, labels, F.col("doc_id") % 3 != 1)
    rows = {r["doc_id"]: r for r in toxicity.scored(docs, index).collect()}
    assert all((rows[i]["score"] >= 0.7) == (i % 4 == 0) for i in range(400))
    assert rows[1000]["score"] == rows[1001]["score"] < 0.7 and rows[0]["terms"] == ["nastyword"]
    assert toxicity.scored(odd, index).count() == 10 and toxicity.scored(nothing, index).count() == 0
    empty = toxicity.learn(docs, labels.where("false"), F.lit(True))
    assert {r["score"] for r in toxicity.scored(docs, empty).collect()} == {0.0}
    assert toxicity.accepted_rows(odd, index, 0.7).columns == odd.columns


def test_copies_take_one_place_among_the_examples(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "EXAMPLES", 20)
    bad, good = [f"bad{chr(97 + k)}" for k in range(8)], [f"good{chr(97 + k)}" for k in range(8)]
    texts = [(1, f"{bad[k % 8]} {bad[(k + 1 + k // 8 % 7) % 8]}") for k in range(120)] + [(0, f"{good[k % 8]} {good[(k + 1 + k // 8 % 7) % 8]}") for k in range(2_400)]
    texts += [(1, bad[k % 8]) for k in range(8 * 300)]
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(texts)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, toxic) for i, (toxic, _) in enumerate(texts)], "doc_id long, quality int, toxic int")
    index = toxicity.learn(docs, labels, F.lit(True))
    toxic = np.flatnonzero(index.labels == 1)
    held = {tuple(sorted((t, w[ids == i].item()) for t, (ids, w, _) in enumerate(index.postings) if i in ids)) for i in toxic}
    assert len(toxic) == len(held) == 20                          # distinct vectors, not copies
    assert index.weights[toxic].sum() == pytest.approx(120 + 8 * 300) and len(set(index.weights[toxic].round(6))) > 1


# --------------------------------------------------------------------------- 4

@pytest.mark.parametrize("bits", [64, 1])
def test_exact_dedup(spark, odd, nothing, bits):
    digest = exact_dedup.sha256 if bits == 64 else (lambda t: F.substring(exact_dedup.sha256(t), 1, 1))
    got = exact_dedup.exact_dedup(odd, digest=digest, files_per_trigger=1).collect()
    groups = Counter()
    first = {}
    for r in odd.collect():
        t = _normal(r["text"])
        groups[t] += 1
        key = (r["doc_id"] is None, r["doc_id"] or 0)
        first[t] = min(first.get(t, key), key)
    assert Counter((r["keep_id"], r["group_size"]) for r in got) == Counter(
        {(None if first[t][0] else first[t][1], n): n for t, n in groups.items()})
    assert sum(r["kept"] for r in got) == len(groups)
    assert exact_dedup.exact_dedup(nothing).count() == 0
    assert exact_dedup.kept_rows(odd).count() == len(groups) and exact_dedup.kept_rows(odd).columns == odd.columns


def _normal(text):
    import re
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_term_limit_follows_the_table(spark):
    """A brute-force Tarone limit, and telling words that a handful of labelled texts give."""
    rng = np.random.default_rng(4)
    for share in (0.05, 0.3, 0.5):
        of = Counter(rng.geometric(0.2, 500).tolist())
        least = toxicity.least_evidence(of, share)
        fits = [x for x in np.arange(0, 60, 1e-3) if toxicity.FALSE_TERMS * np.exp(x) >= sum(n for m, n in of.items() if m * -np.log(share) >= x)]
        assert least == pytest.approx(fits[0], abs=2e-3)
    assert toxicity.least_evidence({}, 0.5) == float("inf")
    texts = [(f"w{i} w{i + 1} common", 0) for i in range(30)] + [(f"w{i} nasty common", 1) for i in range(6)]
    train = spark.createDataFrame(texts, "text string, label int")
    assert toxicity.telling_terms(train, 30, 6) == ["nasty"]


# --------------------------------------------------------------------------- 5

def test_forward_is_exact():
    rng = np.random.default_rng(1)
    start, move, emit = rng.dirichlet(np.ones(3)), rng.dirichlet(np.ones(3), 3), rng.dirichlet(np.ones(5), 3).T
    texts = [np.array(t, dtype=np.uint16) for t in ([0], [1, 2, 3], [4, 4, 0, 1, 2], [2, 2])]
    got = hmm.forward(texts, start, move, emit)
    for t, g in zip(texts, got, strict=True):
        p = sum(start[path[0]] * emit[t[0], path[0]] * np.prod([move[a, b] * emit[x, b] for a, b, x in zip(path, path[1:], t[1:], strict=False)])
                for path in itertools.product(range(3), repeat=len(t)))
        assert g == pytest.approx(np.log10(p))
    first, moves, counts, total = hmm.expected(texts, start, move, emit)
    assert first.sum() == pytest.approx(4) and moves.sum() == pytest.approx(7) and counts.sum() == pytest.approx(11) and total == pytest.approx(got.sum())


def test_language_model(spark, sf, nothing):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").union(spark.createDataFrame([(10**6, None), (10**6, "")], "doc_id long, text string"))
    is_train = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2
    rows = hmm.language_model(docs, is_train, rounds=3).collect()
    texts = [(r["doc_id"], hmm.tokens(r["text"]) + [hmm.END]) for r in docs.collect()]
    c = Counter(w for i, t in texts if zlib.crc32(str(i).encode()) % 7 != 2 for w in t)
    n, v = sum(c.values()), len(c)
    want = Counter((i, len(t), sum(c[w] > 0 for w in t), round(sum(np.log10((c[w] + 1) / (n + v + 1)) for w in t), 4)) for i, t in texts)
    assert Counter((r["doc_id"], r["n_tokens"], r["n_known"], round(r["base_score"], 4)) for r in rows) == want
    held = [r for r in rows if not r["train"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    assert hmm.language_model(nothing, F.lit(True), rounds=1).count() == 0


def test_baum_welch_step_against_enumeration(monkeypatch):
    rng = np.random.default_rng(2)
    start, move, emit = rng.dirichlet(np.ones(3)), rng.dirichlet(np.ones(3), 3), rng.dirichlet(np.ones(5), 3).T
    texts = [np.array(t) for t in ([3], [1, 2, 3, 0], [4, 4, 0, 1, 2, 2], [2, 0])]
    first, moves, counts, total = np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3)), 0.0
    for t in texts:
        paths = list(itertools.product(range(3), repeat=len(t)))
        p = np.array([start[q[0]] * emit[t[0], q[0]] * np.prod([move[a, b] * emit[x, b] for a, b, x in zip(q, q[1:], t[1:], strict=False)]) for q in paths])
        total += np.log10(p.sum())
        for q, w in zip(paths, p / p.sum(), strict=True):
            first[q[0]] += w
            for x, i in zip(t, q, strict=True):
                counts[x, i] += w
            for i, j in zip(q, q[1:], strict=False):
                moves[i, j] += w
    for limit in (hmm.TOKENS, 4, 1):               # also with vectors computed again on the way back
        monkeypatch.setattr(hmm, "TOKENS", limit)
        got = hmm.expected(texts, start, move, emit)
        for have, want in zip(got, (first, moves, counts, total), strict=True):
            assert np.allclose(have, want)
        assert hmm.forward(texts, start, move, emit).sum() == pytest.approx(total)
    # A step never lowers the likelihood.
    a, b, c = first / first.sum(), moves / moves.sum(axis=1, keepdims=True), counts / counts.sum(axis=0)
    assert hmm.expected(texts, a, b, c)[3] > total


def test_blocks_do_not_change_scores(spark, odd, monkeypatch):
    """Odd rows; a symbol for every word seen three times, whatever the blocks."""
    def scores():
        return sorted((r["doc_id"] or -1, r["n_tokens"], r["n_known"], round(r["base_score"], 3), round(r["score"], 2))
                      for r in hmm.language_model(odd, F.col("doc_id") != 7, rounds=2).collect())
    whole = scores()
    assert len(whole) == odd.count() and all(s[4] <= 0 for s in whole)
    monkeypatch.setattr(hmm, "BLOCK", 3)
    assert scores() == whole


# --------------------------------------------------------------------------- 6

def test_fixity(spark):
    pages = spark.createDataFrame([(i, f"http://x/{i}", "y" * (i * 37 % 5000)) for i in range(300)] + [(None, None, None)], "page_id long, url string, html string")
    a = fixity.lay_out(pages, 50).cache()
    assert fixity.audit(a, a).count() == 0
    b = a.where("page_id is null or page_id <> 17").withColumn("digest", F.when(F.col("page_id") == 33, "bad").otherwise(F.col("digest")))
    b = b.unionByName(b.where("page_id = 200")).unionByName(b.where("page_id = 5").withColumn("offset", F.lit(1 << 40)))
    got = {(r["archive"], r["kind"]) for r in fixity.audit(a, b).collect()}
    assert got == {(0, "missing"), (0, "altered"), (4, "repeated"), (0, "extra")}
    assert fixity.audit(a, b.where("false")).count() == 301 and fixity.audit(a.where("false"), b.where("false")).count() == 0


# --------------------------------------------------------------------------- 7

def test_permutation_index(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(600, 16))
    rows = [(i, [float(y) for y in x[i]]) for i in range(600)] + [(700, None), (701, [0.0] * 16), (702, [float("nan")] * 16), (703, [None] * 16), (704, [1.0]), (None, [1.0] * 16), (1, [float(y) for y in x[1]])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = vectors.search(df, F.col("id") % 20 == 0, 10, block=200).collect()
    by = {}
    for r in got:
        by.setdefault(r["query_id"], []).append((r["rank"], r["id"], r["score"]))
    assert set(by) == set(range(0, 600, 20))
    full, hit = np.vstack([x, x[1:2]]), 0
    ids = np.array([*range(600), 1])
    for q, found in by.items():
        s = full @ x[q]
        s[q] = -np.inf
        order = np.lexsort((ids, -s))[:10]
        hit += len({ids[i] for i in order} & {i for _, i, _ in found})
        assert [r for r, _, _ in sorted(found)] == list(range(1, 11))
        assert all(sc == pytest.approx(float(x[i] @ x[q])) for _, i, sc in found)
    assert hit / (10 * len(by)) >= 0.9
    assert vectors.search(df.where("false"), F.lit(True), 5).count() == 0
    assert vectors.search(df.where("vec_id in (0, 2)"), F.lit(True), 5).count() == 2


# --------------------------------------------------------------------------- 8

@pytest.mark.parametrize(("size", "share"), [(2, 80), (5, 80)])
def test_near_duplicates(spark, odd, size, share):
    rng = np.random.default_rng(4)
    base = [f"t{i}" for i in range(60)]
    texts = []
    for _ in range(60):                                               # a chain of ever more edits, and a crowd around one text
        base = list(base)
        base[rng.integers(60)] = f"e{rng.integers(10**6)}"
        texts.append(" ".join(base))
    centre = [f"c{i}" for i in range(80)]
    for _ in range(150):
        t = list(centre)
        for i in rng.choice(80, rng.integers(0, 5), replace=False):
            t[i] = f"x{rng.integers(10**6)}"
        texts.append(" ".join(t))
    docs = spark.createDataFrame([(i + 100, t) for i, t in enumerate(texts)], "doc_id long, text string").unionByName(odd.select("doc_id", "text"))
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    sets = [minhash.shingles(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        c = len(sets[i] & sets[j])
        if sets[i] and sets[j] and 100 * c >= share * (len(sets[i]) + len(sets[j]) - c):
            parent[max(root(i), root(j))] = min(root(i), root(j))
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(root(i), []).append(i)
    least = lambda g: min((rows[i][0] is None, rows[i][0] or 0) for i in g)
    want = Counter((rows[i][0], len(sets[i]), None if least(g)[0] else least(g)[1]) for g in groups.values() for i in g)
    got = minhash.near_duplicates(docs, size=size, share=share).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == want
    assert sum(r["first"] for r in got) == len(groups)


def test_near_duplicates_of_nothing(nothing):
    assert minhash.near_duplicates(nothing).count() == 0


# --------------------------------------------------------------------------- 9, 10

def test_mixing(spark, sf, odd, nothing):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = mixing.draws(docs, block_words=2000, shard_words=20_000).cache()
    by = rows.groupBy("source").agg(F.sum(F.col("size") * F.size("shards")).alias("taken"), F.first("target").alias("target"), F.max("size").alias("most"), F.max(F.size("shards")).alias("copies")).collect()
    assert all(abs(r["taken"] - r["target"]) <= r["most"] and r["copies"] <= 2 for r in by)
    assert sum(r["target"] for r in by) == pytest.approx(1.5 * rows.agg(F.sum("size")).first()[0])
    mixed = mixing.mix(docs, block_words=2000, shard_words=20_000)
    assert mixed.count() == rows.agg(F.sum(F.size("shards"))).first()[0]
    assert mixing.draws(nothing).count() == 0 and mixing.draws(odd).count() == 10
    assert mixing.mix(odd).columns[-2:] == ["copy", "shard"]


def test_splitting_tree():
    quotas = np.array([1000, 10, 0, 333])
    tree = mixing.split_quotas(quotas, 7, 1)
    assert (tree.sum(axis=0) == quotas).all() and (tree >= 0).all()
    assert tree.sum(axis=1).max() - tree.sum(axis=1).min() <= 7
    assert (tree == mixing.split_quotas(quotas, 7, 1)).all()


def test_lookup_table(spark, odd):
    owner = placement.fill(SHARDS)
    counts = Counter(owner)
    assert max(counts[s] / w for s, w in SHARDS.items()) - min(counts[s] / w for s, w in SHARDS.items()) <= 2
    fewer = {s: w for s, w in SHARDS.items() if s != "shard-005"}
    changed = sum(a != b for a, b in zip(owner, placement.fill(fewer), strict=True) if a != "shard-005")
    assert changed / len(owner) < 0.2
    rows = placement.place(odd, "doc_id", SHARDS)
    assert rows.count() == 10 and rows.where("shard is null").count() == 0 and rows.columns.count("shard") == 1
    with pytest.raises(ValueError, match="prime"):
        placement.fill(SHARDS, 65536)


def test_queries_cover_the_contract():
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 11))
