"""Fingerprints, clustering and fill-in-middle against brute force, and on odd tables."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from palimpsest.llm import centroids, fim, simhash

# --------------------------------------------------------------------------- 11


def plain_fingerprint(text, words=3):
    text = (text or "").translate({c: c + 32 for c in range(65, 91)})
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [" ".join(w[i:i + words]) for i in range(max(1, len(w) - words + 1))] if w else []
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def plain_components(fps, radius=2):
    """Smallest reachable position of each fingerprint, by comparing all pairs."""
    label = list(range(len(fps)))
    for _ in fps:
        before = list(label)
        for i, j in itertools.combinations(range(len(fps)), 2):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                label[i] = label[j] = min(label[i], label[j])
        if label == before:
            return label
    return label


@pytest.mark.parametrize("radius", [0, 1, 2])
def test_every_pair_within_the_radius_meets_in_a_table(radius):
    tables = simhash.masks(radius)
    assert len(tables) == 2 ** (radius + 1) - 1 and all(20 < m.bit_count() < 64 or radius == 0 for m in tables)
    for bits in itertools.combinations(range(64), radius):
        difference = sum(1 << i for i in bits)
        assert any(not difference & m for m in tables)


def test_fingerprints_equal_a_plain_count(spark, odd, nothing):
    got = simhash.fingerprints(odd.withColumn("key", F.monotonically_increasing_id()), "key").collect()
    texts = {r["key"]: r["text"] for r in odd.withColumn("key", F.monotonically_increasing_id()).collect()}
    assert {r["id"]: r["fp"] & (1 << 64) - 1 for r in got} == {k: plain_fingerprint(t) for k, t in texts.items()}
    assert simhash.fingerprints(nothing).count() == 0


def _clustered(seed, swarm):
    """Fingerprints at all small distances from each other, one swarm among them, and the extreme ones."""
    rng = random.Random(seed)
    centre, found = rng.getrandbits(64), {0, (1 << 64) - 1, 1 << 63, (1 << 63) | 1}
    while len(found) < swarm:
        found.add(centre ^ sum(1 << i for i in rng.sample(range(64), rng.randint(0, 3))))
    for _ in range(30):
        fp = rng.getrandbits(64)
        found.add(fp)
        for _ in range(rng.randint(0, 3)):
            fp ^= sum(1 << i for i in rng.sample(range(64), rng.randint(1, 3)))
            found.add(fp)
    return sorted(found)


@pytest.mark.parametrize(("radius", "bucket"), [(2, 32), (2, 4), (1, 4), (0, 4), (2, 1000)])
def test_links_connect_what_all_pairs_connect(spark, radius, bucket):
    fps = _clustered(radius + bucket, 120)
    rows = spark.createDataFrame([(simhash._signed(f),) for f in fps], "fp long")
    place = {f: i for i, f in enumerate(fps)}
    got = [(r["a"] & (1 << 64) - 1, r["b"] & (1 << 64) - 1) for r in simhash.links(rows, radius, bucket).collect()]
    assert all(0 < (a ^ b).bit_count() <= radius for a, b in got) and len(set(got)) == len(got)
    label = list(range(len(fps)))
    for _ in fps:
        for a, b in got:
            label[place[a]] = label[place[b]] = min(label[place[a]], label[place[b]])
    assert label == plain_components(fps, radius)


def test_near_duplicates_equal_brute_force(spark, odd, nothing, sf):
    rng = random.Random(5)
    base = [" ".join(rng.choices(["a", "bb", "Cc", "d", "e"], k=rng.randint(1, 40))) for _ in range(40)]
    rows = [(i, base[i % 40] if i % 3 else base[i % 40] + " tail") for i in range(150)] + [(150, None), (151, ""), (None, " \n"), (None, base[0])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit(1)).withColumn("size", F.lit("x"))
    got = simhash.near_duplicates(docs)
    label = plain_components([plain_fingerprint(t) for _, t in rows])
    low = {}
    for (i, _), c in zip(rows, label):
        low[c] = min((x for x in (low.get(c), i) if x is not None), default=None)
    want = sorted((str(i), f"{plain_fingerprint(t):016x}", low[c]) for (i, t), c in zip(rows, label))
    assert sorted((str(r["id"]), r["fingerprint"], r["component_id"]) for r in got.collect()) == want
    assert simhash.near_duplicates(nothing).count() == 0
    assert simhash.near_duplicates(odd).count() == odd.count()


def test_other_radii_are_refused(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "fp long"), 3)


# --------------------------------------------------------------------------- 12

def plain_k_means(rows, k, rounds, dims, seed=2, scale=256):
    kept = []
    for i, x in rows:
        if x is not None and len(x) == dims and all(c is not None and np.isfinite(c) for c in x):
            kept.append((i, [int(np.floor(scale * float(c))) for c in x]))
    key = lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), (r[0] is not None, r[0] or 0), r[1])
    means = [v for _, v in sorted(kept, key=key)[:k]]
    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, m)), c) for c, m in enumerate(means))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        means = [[sum(c) // len(groups[j]) for c in zip(*groups[j])] if j in groups else means[j] for j in range(len(means))]
    return [(i, *nearest(v)[::-1]) for i, v in kept], means


def _vectors(n, dims, seed):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(6, dims))
    return [(int(i), (middles[i % 6] + rng.normal(size=dims) * 0.3).round(2).tolist()) for i in range(n)]


@pytest.mark.parametrize("k", [1, 2, 7, 300])
def test_clusters_equal_plain_rounds(spark, k):
    rows = _vectors(200, 8, k)
    rows += [(900, None), (901, [0.1] * 7), (902, [float("nan")] * 8), (903, [float("inf")] + [0.0] * 7), (904, [None] + [0.0] * 7)]
    rows += [(i, rows[3][1]) for i in range(300, 340)] + [(5, rows[9][1]), (None, [0.0] * 8), (906, [-0.001] * 8), (907, [3000.5] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("v", F.lit(1)).withColumn("cluster", F.lit("x"))
    got = centroids.cluster(df, k=k, rounds=4, dims=8).collect()
    want, means = plain_k_means(rows, k, 4, 8)
    assert sorted((str(r["id"]), r["cluster"], r["distance"]) for r in got) == sorted((str(i), c, d) for i, c, d in want)
    assert {r["cluster"]: list(r["centroid"]) for r in got} == {c: means[c] for _, c, _ in want}
    assert {r["inertia"] for r in got} == {sum(d for *_, d in want)}
    assert {r["cluster"]: r["cluster_inertia"] for r in got} == {c: sum(d for _, x, d in want if x == c) for _, c, _ in want}


def test_bounds_spare_most_comparisons(spark):
    rows = _vectors(2000, 8, 3)
    got = centroids.cluster(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=6, rounds=5, dims=8)
    scans = got.agg(F.sum("scans"), F.max("scans")).first()
    assert scans[0] < 0.5 * 6 * 2000 and scans[1] <= 6


def test_loosening_is_a_bound_and_below_the_drift():
    rng = np.random.default_rng(0)
    tighter = 0
    for _ in range(200):
        old = rng.normal(size=(5, 4)) * 100
        new = old + rng.normal(size=(5, 4)) * rng.choice([0, 1, 30], size=(5, 1))
        radius = rng.uniform(0, 120, size=5)
        loose = centroids.loosening(old, new, radius)
        drift = np.sqrt(((new - old) ** 2).sum(axis=1))
        for i in range(5):
            others = [j for j in range(5) if j != i]
            assert loose[i] <= drift[others].max() * (1 + 1e-8)
            tighter += loose[i] < 0.9 * drift[others].max()
            way = rng.normal(size=(400, 4))
            x = old[i] + way / np.linalg.norm(way, axis=1)[:, None] * radius[i] * rng.uniform(0, 1, size=(400, 1)) ** 0.25
            nearer = np.linalg.norm(x[:, None] - old[others], axis=2) - np.linalg.norm(x[:, None] - new[others], axis=2)
            assert nearer.max() <= loose[i] + 1e-6
    assert tighter > 100


def test_large_components_are_exact():
    p = np.array([[(1 << 26) - 1] * 64, [-(1 << 26) + 1] * 64], dtype=np.int64)
    assert centroids.squared_distances(p, p).tolist() == [[0, 64 * ((1 << 27) - 2) ** 2], [64 * ((1 << 27) - 2) ** 2, 0]]


def test_no_vectors(spark):
    none = spark.createDataFrame([(1, None), (2, [1.0])], "vec_id long, embedding array<double>")
    got = centroids.cluster(none)
    assert got.count() == 0 and got.columns == ["id", "cluster", "distance", "cluster_inertia", "inertia", "centroid", "scans"]
    huge = spark.createDataFrame([(1, [1e300] * 2), (2, [1.0, 2.0])], "vec_id long, embedding array<double>")
    assert [r["id"] for r in centroids.cluster(huge, dims=2).collect()] == [2]


# --------------------------------------------------------------------------- 13

def plain_infill(i, text):
    text = text or ""
    u = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    d = hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()
    h = [int(d[8 * k:8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(u) + 1), h[1] % (len(u) + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return len(u), "plain", text, None, None, None
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if h[3] % 100 < 80:
        return len(u), "spm", f"<S>{s}<P>{p}<M>{m}", p, m, s
    return len(u), "psm", f"<P>{p}<S>{s}<M>{m}", p, m, s


def test_infill_equals_a_plain_cut(spark, odd, nothing):
    tricky = ["a", " ", "\n\n x", "a <P> b", "<P", "P> x <S", "$1 \\ $2", "x<M", ">b <", "\x0b\x0c\r\t", "日本 　x y", "𝒳 𝒴  𝒵 ", "\x00 b\x1fc", "end \n"]
    rows = [(i, tricky[i % len(tricky)] + ("" if i % 2 else " tail <")) for i in range(280)]
    docs = odd.select("doc_id", "text", "n_chars").unionByName(spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_chars", F.lit(0)))
    docs = docs.withColumn("n", F.lit("x")).withColumn("Prefix", F.lit(1)).withColumn("a b", F.lit(2))
    cut = fim.fill_in_middle(docs)
    assert cut.columns == ["doc_id", "text", "n_chars", "a b", "n", "form", "output", "prefix", "middle", "suffix"]
    got = cut.withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    assert len(got) == docs.count()
    for r in got:
        assert tuple(r[c] for c in ("n", "form", "output", "prefix", "middle", "suffix")) == plain_infill(r["doc_id"], r["text"])
        assert r["back"] == (r["text"] or "")
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}
    assert fim.fill_in_middle(nothing).count() == 0


def test_infill_of_a_very_long_text(spark):
    ids = [i for i in range(40) if plain_infill(i, "x y")[1] != "plain"][:3]
    texts = {ids[0]: "wort " * 400_000, ids[1]: "x" * 2_000_000, ids[2]: " " * 1_000_000 + "y"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for r in fim.fill_in_middle(docs).withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect():
        assert r["back"] == texts[r["doc_id"]] and r["output"] == plain_infill(r["doc_id"], r["text"])[2]


# --------------------------------------------------------------------------- 9

def test_mix_with_clashing_names_and_without_ids(spark):
    from palimpsest.llm import mixing
    words = spark.range(600).select(F.lit(None).cast("bigint").alias("doc_id"), F.concat(F.lit("w "), F.col("id").cast("string")).alias("text"),
                                    F.concat(F.lit("s"), (F.col("id") % 3).cast("string")).alias("source"))
    for name in ("part", "full", "cut", "n_blocks", "_key", "_source", "_row", "_order", "_block", "ends", "words", "_end", "place", "rest", "quota"):
        words = words.withColumn(name, F.lit(name))
    kept = words.columns
    mixed = mixing.mix(words.withColumn("size", F.lit("x")).withColumn("shard", F.lit("y")), block_words=50, shard_words=300)
    assert mixed.columns == [*kept, "copy", "shard"]
    rows = mixed.collect()
    assert all(r[name] == name for r in rows for name in ("part", "_row", "_order", "ends"))
    drawn = mixing.draws(words, block_words=50, shard_words=300).collect()
    taken, target = {}, {r["source"]: r["target"] for r in drawn}
    for r in rows:
        taken[r["source"]] = taken.get(r["source"], 0) + 2
    # rows without an id are told apart by their text: the miss is below one document
    assert all(abs(taken[s] - target[s]) <= 2 for s in target) and sum(target.values()) == 1800
    assert len({r["shard"] for r in rows}) > 3
    assert sorted(r["text"] for r in mixing.mix(words.repartition(5), block_words=50, shard_words=300).collect()) == sorted(r["text"] for r in rows)


def test_helper_names_of_the_caller_stay(spark, odd):
    from palimpsest.llm import exact_dedup, minhash, placement
    rows = odd.withColumn("_locator", F.lit(-5)).withColumn("_slot", F.lit(-6)).withColumn("_shard", F.lit("own"))
    assert {r["_locator"] for r in exact_dedup.kept_rows(rows).collect()} == {-5}
    assert {r["_locator"] for r in minhash.kept_rows(rows).collect()} == {-5}
    placed = placement.place(rows, "doc_id", {"a": 1, "b": 2}).collect()
    assert {(r["_slot"], r["_shard"]) for r in placed} == {(-6, "own")} and {r["shard"] for r in placed} <= {"a", "b"}
