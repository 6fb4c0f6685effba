"""Toxicity by the nearest labelled examples.

Learning.  Of labelled training texts the terms that tell the labels apart are
kept: those ``LEAST_LIFT`` times as frequent with one label whose counts chance
would hardly give.  The limit is relative to the table: chance is to pass
``FALSE_TERMS`` terms at most, among those frequent enough to pass at all (see
:func:`least_evidence`); a handful of labelled rows can do.  The ``TERMS``
strongest are the most that are kept.  Inverse document frequencies
count all documents.  Examples are a sample of at most ``EXAMPLES`` distinct
vectors per label over such terms, drawn by a hash of the vector and weighted
with the training texts that have it; the index is therefore bounded and
broadcast, and copies take no places of their own.

Scoring.  Texts and examples are TF-IDF vectors over those terms, and the
``NEIGHBOURS`` examples of the largest cosine are found exactly: posting lists
are cut into blocks of ``BLOCK`` examples, each with the largest weight of every
term; blocks are visited in the order of their upper bounds until no bound can
reach the last neighbour.  Neighbours vote with their similarity (and with how
many training texts each stands for).  Votes become scores by a monotone table
that says how often examples, left out in turn with all their copies, with such
a vote were toxic.

Only the text is an input of a score.  Null and empty texts, and texts without
any of the terms, get the score of such training texts.  Equal similarities are
ordered by place in the index.  Without training rows every score is 0.  A
document labelled several times counts as toxic if any label says so; labels
that are null are none.  Columns beside those named are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.llm.files import maybe_in
from palimpsest.session import materialized

TERMS, FALSE_TERMS, LEAST_LIFT = 4096, 1.0, 3.0
#: Supports that are counted apart when the limit is set; higher ones count together.
SUPPORTS = 4096
#: The bound of the labelled sample: so many examples of either label.
EXAMPLES = 4096
NEIGHBOURS, BLOCK = 15, 64
#: Rows of the table from votes to scores, and the weight of its prior.
STEPS, PRIOR = 20, 1.0
#: Terms counted by a task before they are passed on.
FLUSH = 1 << 19

_TERM = re.compile(r"[^\W\d_]+")


def terms(text: str | None) -> list[str]:
    return _TERM.findall((text or "").lower())


def training_texts(docs: DataFrame, labels: DataFrame, train: Column, id_col: str, text_col: str) -> DataFrame:
    """(text, label) of the labelled documents for which ``train`` (a condition on the id) holds."""
    known = labels.where("toxic is not null").where(train).groupBy(F.col("doc_id").alias("_id")).agg(F.max("toxic").alias("label"))
    known = materialized(known)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("text"))
    return maybe_in(rows, known, "_id").join(known, "_id").select("text", F.col("label").cast("int").alias("label"))


def term_counts(train: DataFrame) -> DataFrame:
    """(term, n0, n1): training texts of either label that hold a term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = (Counter(), Counter())

        def out():
            names = list(counts[0].keys() | counts[1].keys())
            batch = pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *[pa.array([c[t] for t in names], pa.int64()) for c in counts]],
                                               names=["term", "n0", "n1"])
            for c in counts:
                c.clear()
            return batch

        for batch in batches:
            for text, label in zip(batch.column("text"), batch.column("label").to_pylist(), strict=True):
                counts[1 if label else 0].update(set(terms(text.as_py())))
                if len(counts[0]) + len(counts[1]) > FLUSH:
                    yield out()
        yield out()

    return train.mapInArrow(run, "term string, n0 bigint, n1 bigint").groupBy("term").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def least_evidence(supports: dict[int, int], share: float) -> float:
    """Evidence (natural logarithms) from which a term counts, so that chance passes FALSE_TERMS terms at most.

    ``supports`` says how many terms are in so many texts; ``share`` is that of the rarer label.  A term in m texts has at most the
    evidence of m texts of that label, so terms that cannot reach the limit need no allowance (Tarone's correction).
    """
    left, below = sum(supports.values()), 0.0
    for m in sorted(supports):
        reach = m * -math.log(share)
        if reach >= math.log(left / FALSE_TERMS):
            return max(below + 1e-6, math.log(left / FALSE_TERMS))           # out of reach for those not counted
        left, below = left - supports[m], reach
    return math.inf


def telling_terms(train: DataFrame, n0: int, n1: int) -> list[str]:
    counts = materialized(term_counts(train))
    support = F.least(F.col("n0") + F.col("n1"), F.lit(SUPPORTS)).alias("m")
    supports = {r["m"]: r["count"] for r in counts.groupBy(support).count().collect()}                       # SUPPORTS rows at most
    a, b, q = F.col("n1").cast("double"), F.col("n0").cast("double"), n1 / (n0 + n1)
    # Chernoff's bound of the chance that of a + b texts so many have one label.
    part = lambda x, p: F.when(x > 0, x * F.log(x / ((a + b) * p))).otherwise(0.0)
    lift = F.greatest(a * n0 / (b * n1 + 1e-9), b * n1 / (a * n0 + 1e-9))
    best = counts.withColumn("evidence", part(a, q) + part(b, 1 - q)).where(
        (F.col("evidence") >= least_evidence(supports, min(q, 1 - q)) - 1e-9) & (lift >= LEAST_LIFT))
    return [r["term"] for r in best.orderBy(F.desc("evidence"), "term").limit(TERMS).select("term").collect()]


def document_frequencies(docs: DataFrame, text_col: str, vocabulary: list[str]) -> tuple[np.ndarray, int]:
    """How many of all documents hold each term, and how many documents there are."""
    place = {t: i for i, t in enumerate(vocabulary)}

    def run(batches):
        df, n = Counter(), 0
        for batch in batches:
            n += batch.num_rows
            for text in batch.column(0):
                df.update({place[t] for t in terms(text.as_py()) if t in place})
        keys = [-1, *df]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array([n, *df.values()], pa.int64())], names=["term", "df"])

    got = docs.select(F.col(text_col).cast("string")).mapInArrow(run, "term bigint, df bigint").groupBy("term").agg(F.sum("df").alias("df"))
    counts = {r["term"]: r["df"] for r in got.collect()}               # a row per term of the vocabulary
    return np.array([counts.get(i, 0) for i in range(len(vocabulary))], dtype=np.float64), counts.get(-1, 0)


@dataclass
class Index:
    """Block-max inverted index of the examples."""

    place: dict[str, int]
    idf: np.ndarray
    labels: np.ndarray
    weights: np.ndarray                     # training texts an example stands for
    postings: list[tuple[np.ndarray, np.ndarray, np.ndarray]]   # per term: examples, weights, start of each block
    block_max: np.ndarray                   # terms x blocks
    nothing: float = 0.0                    # score of texts without terms
    table: np.ndarray | None = None

    def vector(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        counts = Counter(t for t in terms(text) if t in self.place)
        return weigh(np.array([self.place[t] for t in counts], dtype=np.int64), np.array(list(counts.values()), dtype=np.float64), self.idf)

    def nearest(self, at: np.ndarray, q: np.ndarray, k: int = NEIGHBOURS, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of the largest cosine and the cosines; only those above 0."""
        none = np.zeros(0, dtype=np.int64), np.zeros(0)
        if not len(at) or not len(self.labels):
            return none
        bound = q @ self.block_max[at]
        order = np.argsort(-bound, kind="stable")
        found, scores, least = np.zeros(0, dtype=np.int64), np.zeros(0), 0.0
        for b in order:
            # a bound may fall below the cosine by rounding only
            if bound[b] <= 0 or len(found) >= k and bound[b] < least - 1e-12:
                break
            score = np.zeros(BLOCK)
            for t, w in zip(at, q, strict=True):
                ids, weights, starts = self.postings[t]
                low, high = starts[b], starts[b + 1]
                score[ids[low:high] - b * BLOCK] += w * weights[low:high]
            hit = np.flatnonzero(score > 0)
            hit = hit[hit + b * BLOCK != without]
            found, scores = np.concatenate([found, hit + b * BLOCK]), np.concatenate([scores, score[hit]])
            if len(found) > k:
                best = np.lexsort((found, -scores))[:k]
                found, scores = found[best], scores[best]
            if len(found) >= k:
                least = scores.min()
        best = np.lexsort((found, -scores))
        return found[best], scores[best]

    def vote(self, found: np.ndarray, scores: np.ndarray) -> float | None:
        if not len(found):
            return None
        w = scores * self.weights[found]
        return float((w * self.labels[found]).sum() / w.sum())

    def score(self, vote: float | None) -> float:
        if vote is None:
            return self.nothing
        return float(self.table[min(STEPS - 1, int(vote * STEPS))])


def weigh(at: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit TF-IDF vector: (1 + ln tf) * idf."""
    w = (1 + np.log(counts)) * idf[at] if len(at) else np.zeros(0)
    norm = np.sqrt((w * w).sum())
    return (at, w / norm) if norm > 0 else (at[:0], w[:0])


def build(vectors: list[tuple[np.ndarray, np.ndarray]], labels: list[int], stands_for: list[float], vocabulary: list[str],
          idf: np.ndarray, nothing: float) -> Index:
    # Examples with one heaviest term lie together, so blocks hold few terms and bounds are tight.
    order = sorted(range(len(vectors)), key=lambda i: (int(vectors[i][0][np.argmax(vectors[i][1])]), i))
    n_blocks = -(-len(order) // BLOCK)
    lists: list[tuple[list, list]] = [([], []) for _ in vocabulary]
    block_max = np.zeros((len(vocabulary), n_blocks))
    for new, old in enumerate(order):
        for t, w in zip(*vectors[old], strict=True):
            lists[t][0].append(new)
            lists[t][1].append(w)
            block_max[t, new // BLOCK] = max(block_max[t, new // BLOCK], w)
    edges = np.arange(n_blocks + 1) * BLOCK
    postings = [(np.array(i, dtype=np.int64), np.array(w), np.searchsorted(np.array(i, dtype=np.int64), edges)) for i, w in lists]
    index = Index({t: i for i, t in enumerate(vocabulary)}, idf, np.array([labels[i] for i in order], dtype=np.float64),
                  np.array([stands_for[i] for i in order]), postings, block_max, nothing)
    votes = [index.vote(*index.nearest(*vectors[old], without=new)) for new, old in enumerate(order)]
    hits, all_ = np.zeros(STEPS), np.zeros(STEPS)
    for vote, label, weight in zip(votes, index.labels, index.weights, strict=True):
        if vote is not None:
            step = min(STEPS - 1, int(vote * STEPS))
            all_[step] += weight
            hits[step] += weight * label
    middle = (np.arange(STEPS) + 0.5) / STEPS
    index.table = np.clip(np.maximum.accumulate((hits + PRIOR * middle) / (all_ + PRIOR)), 0, 1)
    return index


def learn(docs: DataFrame, labels: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text") -> Index:
    texts = materialized(training_texts(docs, labels, train, id_col, text_col))
    n = {r["label"]: r["count"] for r in texts.groupBy((F.col("label") > 0).cast("int").alias("label")).count().collect()}
    n0, n1 = n.get(0, 0), n.get(1, 0)
    vocabulary = telling_terms(texts, n0, n1) if n0 and n1 else []
    df, total = document_frequencies(docs, text_col, vocabulary) if vocabulary else (np.zeros(0), 0)
    idf = np.log((1 + total) / (1 + df)) + 1
    place = {t: i for i, t in enumerate(vocabulary)}

    def run(batches):
        for batch in batches:
            at, counts = [], []
            for text in batch.column("text"):
                c = sorted(Counter(place[t] for t in terms(text.as_py()) if t in place).items())
                at.append([t for t, _ in c]), counts.append([k for _, k in c])
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(at, pa.list_(pa.int64())), pa.array(counts, pa.list_(pa.int64()))],
                                             names=["label", "at", "counts"])

    vectors = texts.select((F.col("label") > 0).cast("int").alias("label"), "text").mapInArrow(run, "label int, at array<bigint>, counts array<bigint>")
    vectors = materialized(vectors.groupBy("label", "at", "counts").agg(F.count(F.lit(1)).alias("copies")))
    with_terms = vectors.where(F.size("at") > 0)
    empty = {r["label"]: r["copies"] for r in vectors.where(F.size("at") == 0).collect()}      # a row per label
    nothing = empty.get(1, 0) / max(1, empty.get(0, 0) + empty.get(1, 0))
    out, marks, stands = [], [], []
    for label in (0, 1):
        own = with_terms.where(F.col("label") == label)
        picked = own.orderBy(F.xxhash64("at", "counts"), "at", "counts").limit(EXAMPLES).collect()           # the documented bound
        held, drawn = n.get(label, 0) - empty.get(label, 0), sum(r["copies"] for r in picked)
        for r in picked:
            v = weigh(np.array(r["at"], dtype=np.int64), np.array(r["counts"], dtype=np.float64), idf)
            out.append(v), marks.append(label), stands.append(r["copies"] * held / drawn)
    return build(out, marks, stands, vocabulary, idf, nothing)


def scored(docs: DataFrame, index: Index, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, score, vote, and as evidence the neighbours' labels and similarities and the terms found."""
    shared = docs.sparkSession.sparkContext.broadcast(dict(vars(index)))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        index = Index(**shared.value)
        names = {i: t for t, i in index.place.items()}
        for batch in batches:
            score, votes, labels, near, words = [], [], [], [], []
            for text in batch.column("text"):
                at, q = index.vector(text.as_py())
                found, cosines = index.nearest(at, q)
                vote = index.vote(found, cosines)
                score.append(index.score(vote)), votes.append(vote)
                labels.append(index.labels[found].astype(int).tolist()), near.append(cosines.tolist())
                words.append([names[i] for i in at.tolist()])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(score, pa.float64()), pa.array(votes, pa.float64()), pa.array(labels, pa.list_(pa.int32())),
                 pa.array(near, pa.list_(pa.float64())), pa.array(words, pa.list_(pa.string()))],
                names=[id_col, "score", "vote", "labels", "similarities", "terms"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"`{id_col}` {kind}, score double, vote double, labels array<int>, similarities array<double>, terms array<string>")


def accepted_rows(docs: DataFrame, index: Index, threshold: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with all their columns.  No exchange."""
    shared = docs.sparkSession.sparkContext.broadcast(dict(vars(index)))

    def run(batches):
        index = Index(**shared.value)
        for batch in batches:
            texts = batch.column(batch.schema.names.index(text_col))
            clean = [index.score(index.vote(*index.nearest(*index.vector(t.as_py())))) < threshold for t in texts]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
