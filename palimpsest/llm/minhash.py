"""Near duplicates by an inverted join over signature coordinates.

A document's set holds its distinct shingles of ``size`` words (ASCII letters
lower-cased).  Its MinHash signature has ``COORDINATES`` coordinates.  A
document is posted under coordinate-value pairs, and documents that agree in at
least ``MATCHES`` coordinates are candidates: at the similarity 0.8 so few
agree with a probability of about 2 in 100,000.  Two documents that agree in T of
K coordinates share one of the K - T + 1 first ones under any common order, so
only these are posted, rarest first; the others are compared without merging
their lists.  Candidates are confirmed on the full sets of words themselves.

Lists of thousands of near copies must not become all pairs.  The first round
links each document to one centre; documents that may be similar to no other of
a list leave it there.  Later rounds look only into lists that hold several
components and try documents against members of other ones, about the ``TRIES``
most alike at first and sixteen times as many every round, until no untried candidate
between two components is left.  So every link between components is found,
while links inside a component need not be listed.  Near copies share many
lists; a pair belongs to one of those it shares, which alone gives it.

Before texts are compared, candidates must pass a bound that loses nothing: a
document's parity sketch has a bit for each of ``PARITY`` buckets, set if an
odd number of its shingles fall there.  Sketches differ in at most as many bits
as sets differ in shingles, and similar sets differ in few.

Copies (equal word sequences) fall together before posting.  Null and empty
texts have no shingles and are linked with nothing; a text of fewer words than
``size`` has one shingle, all its words.  Rows with equal ids are separate
rows.  Null ids come after all others.  An empty table gives an empty result;
columns beside the id and the text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from palimpsest.functions.expr import fresh
from palimpsest.llm.files import from_files, located, locator, maybe_in
from palimpsest.llm.graph import components
from palimpsest.session import materialized

COORDINATES = 64
MATCHES = 38
TRIES = 32
#: Bits of a parity sketch; 4 bits of each coordinate travel with a posting besides.
PARITY = 512
#: Documents from whose coordinates the order of rarity is taken.  Any order gives the same result.
ORDER_SAMPLE = 20_000
#: Shingles hashed at a time, words kept in a worker's table.
CHUNK, KNOWN_WORDS = 1 << 14, 1 << 17
#: Texts, or signatures with what is worked out from them, that a Python worker gets at a time.
BATCH_ROWS = 1000

_RNG = np.random.default_rng(8)
_MULTIPLY = _RNG.integers(0, 1 << 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _RNG.integers(0, 1 << 63, COORDINATES, dtype=np.uint64)
_STEP = _RNG.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingles(text: str | None, size: int) -> set[bytes]:
    """The full set, as words."""
    w = words(text)
    if not w:
        return set()
    return {b" ".join(w[i:i + size]) for i in range(max(1, len(w) - size + 1))}


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def shingle_hashes(w: list[bytes], size: int, known: dict) -> np.ndarray:
    """Distinct 64-bit hashes of the shingles."""
    h = np.fromiter(map(known.__getitem__, w), dtype=np.uint64, count=len(w))
    n = max(1, len(w) - size + 1)
    total = np.full(n, min(size, len(w)), dtype=np.uint64)
    for j in range(min(size, len(w))):
        total += _mixed(h[j:j + n]) * _STEP[j]
    return np.unique(_mixed(total))


def signature(hashes: np.ndarray) -> np.ndarray:
    out = np.full(COORDINATES, np.iinfo(np.uint32).max, dtype=np.uint32)
    for at in range(0, len(hashes), CHUNK):
        values = (hashes[at:at + CHUNK, None] * _MULTIPLY + _ADD) >> np.uint64(32)
        out = np.minimum(out, values.min(axis=0).astype(np.uint32))
    return out


def parity(hashes: np.ndarray) -> np.ndarray:
    return np.packbits(np.bincount((hashes >> np.uint64(20)).astype(np.int64) % PARITY, minlength=PARITY).astype(np.uint8) & 1)


def packed(signatures: np.ndarray, parities: np.ndarray) -> np.ndarray:
    """What travels with a posting: 4 bits of each coordinate, then the parity sketch, as bytes."""
    low = signatures.astype(np.uint8) & 15
    return np.hstack([(low[:, ::2] << 4) | low[:, 1::2], parities])


def sketches(rows: DataFrame, size: int) -> DataFrame:
    """(id, locator, sequence, n, signature) of (id, text, locator).

    ``sequence`` names the words in order, null if there are none; the signature is followed by the parity sketch.
    """
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Hashes()
        for batch in batches:
            sequence, n, signatures = [], [], []
            for text in batch.column("text"):
                w = words(text.as_py())
                if not w:
                    sequence.append(None), n.append(0), signatures.append(None)
                    continue
                sequence.append(hashlib.sha256(b" ".join(w)).digest())
                h = shingle_hashes(w, size, known)
                n.append(len(h))
                signatures.append(signature(h).tobytes() + parity(h).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("locator"), pa.array(sequence, pa.binary()), pa.array(n, pa.int64()),
                 pa.array(signatures, pa.binary())], names=["id", "locator", "sequence", "n", "signature"])

    return rows.mapInArrow(run, f"id {kind}, locator string, sequence binary, n bigint, signature binary")


def _tokens(signatures: np.ndarray) -> np.ndarray:
    """Coordinate-value pairs as numbers, shape as the input (documents, coordinates)."""
    return (np.arange(signatures.shape[1], dtype=np.int64)[None, :] << 32) | signatures.astype(np.int64)


def _stacked(column) -> tuple[np.ndarray, np.ndarray]:
    """Signatures and parity sketches of a column."""
    both = np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(len(column), -1)
    return np.ascontiguousarray(both[:, :4 * COORDINATES]).view(np.uint32), both[:, 4 * COORDINATES:]


def frequent_tokens(classes: DataFrame, n_classes: int) -> DataFrame:
    """(token, count) of pairs seen three times or more in the sample; bounded by the sample."""
    share = min(1.0, ORDER_SAMPLE / max(1, n_classes))
    sample = classes.where(F.pmod(F.xxhash64("sequence"), F.lit(1 << 20)) < int(share * (1 << 20))).select("signature")

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(_tokens(_stacked(batch.column(0))[0]).ravel())], names=["token"])

    return sample.mapInArrow(run, "token bigint").groupBy("token").agg(F.count(F.lit(1)).alias("count")).where("count > 2")


#: Pairs under which a document is posted.
_POSTED = COORDINATES - MATCHES + 1


def rarity(spark: SparkSession, frequent: dict[int, int]) -> Broadcast:
    keys = np.array(sorted(frequent), dtype=np.int64)
    return spark.sparkContext.broadcast((keys, np.array([frequent[k] for k in keys.tolist()], dtype=np.int64)))


def _rarest(tokens: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The coordinates of the K - T + 1 rarest pairs of each document."""
    often = np.zeros(tokens.shape, dtype=np.int64)
    if len(keys):
        at = np.minimum(np.searchsorted(keys, tokens), len(keys) - 1)
        often = np.where(keys[at] == tokens, counts[at], 0)
    # Rarest first; ties in the order of a hash of the pair, the same for all documents.
    tie = _mixed(tokens.astype(np.uint64)) >> np.uint64(33)
    return np.argsort((often.astype(np.uint64) << np.uint64(31)) | tie, axis=1, kind="stable")[:, :_POSTED]


def postings(classes: DataFrame, rare: Broadcast) -> DataFrame:
    """(token, node) under the K - T + 1 rarest pairs, of the lists that hold several documents."""
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                tokens = _tokens(_stacked(batch.column("signature"))[0])
                first = np.take_along_axis(tokens, _rarest(tokens, *rare.value), 1)
                yield pa.RecordBatch.from_arrays([pa.array(first.ravel()), pa.array(np.repeat(batch.column("node").to_numpy(), _POSTED))],
                                                 names=["token", "node"])

    # Most rare pairs are those of one document: what else a posting holds follows only to the others.
    posted = classes.select("node", "signature").mapInArrow(run, "token bigint, node bigint")
    return posted.withColumn("size", F.count(F.lit(1)).over(Window.partitionBy("token"))).where("size > 1").select("token", "node")


def _lists(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[list[np.ndarray]]:
    """Runs of equal tokens of a sorted partition, each as one array per column."""
    held: list[list[np.ndarray]] = []
    token = None
    for batch in batches:
        if not batch.num_rows:
            continue
        arrays = [np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint8).reshape(batch.num_rows, -1) if c in ("bits", "posted")
                  else batch.column(c).to_numpy(zero_copy_only=False) for c in columns]
        tokens = batch.column("token").to_numpy()
        starts = [0, *(np.flatnonzero(tokens[1:] != tokens[:-1]) + 1).tolist(), len(tokens)]
        for low, high in zip(starts, starts[1:], strict=False):
            if held and tokens[low] != token:
                yield [np.array([token]), *[np.concatenate(x) for x in zip(*held, strict=True)]]
                held = []
            token = tokens[low]
            held.append([a[low:high] for a in arrays])
    if held:
        yield [np.array([token]), *[np.concatenate(x) for x in zip(*held, strict=True)]]


_HALF = COORDINATES // 2
_EQUAL_HALVES = np.array([(x >> 4 == 0) + (x & 15 == 0) for x in range(256)], dtype=np.uint8)
_ONES = np.array([x.bit_count() for x in range(256)], dtype=np.uint8)


def _agree(bits: np.ndarray, n: np.ndarray, i: int, others: np.ndarray, share: int) -> tuple[np.ndarray, np.ndarray]:
    """Which others may be similar to i, and in how many bits their parity sketches differ from its own.

    They agree in enough coordinates, have a fitting size, and their sketches allow the similarity.
    """
    small, large = np.minimum(n[others], n[i]), np.maximum(n[others], n[i])
    fits = others[100 * small >= share * large]
    fits = fits[_EQUAL_HALVES[bits[fits, :_HALF] ^ bits[i, :_HALF]].sum(axis=1) >= MATCHES]
    apart = _ONES[bits[fits, _HALF:] ^ bits[i, _HALF:]].sum(axis=1).astype(np.int64)
    may = (100 + share) * apart <= (100 - share) * (n[fits] + n[i])
    return fits[may], apart[may]


def _batches(rows: Iterator[tuple], names: list[str], size: int = 1 << 15) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*held, strict=True)], names=names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*held, strict=True)], names=names)


def first_round(posted: DataFrame, share: int) -> DataFrame:
    """(token, a, b): documents of a list with their centre a, the first document they agree with; a = b for centres.

    Documents that agree with no other of the list are left out.
    """
    def run(batches):
        def rows():
            for token, node, n, bits in _lists(batches, ["node", "n", "bits"]):
                left = np.arange(len(node))
                centre_of = np.full(len(node), -1)
                while len(left) > 1:
                    centre, left = left[0], left[1:]
                    near, _ = _agree(bits, n, centre, left, share)
                    if len(near):
                        centre_of[near] = centre_of[centre] = centre
                        left = left[centre_of[left] < 0]
                members = np.flatnonzero(centre_of >= 0)
                # The others were not compared with those that had found a centre before them.
                others = members[centre_of[members] != members]
                for i in np.flatnonzero(centre_of < 0) if len(others) else ():
                    if len(_agree(bits, n, i, others, share)[0]):
                        centre_of[i] = i
                for i in np.flatnonzero(centre_of >= 0):
                    yield token[0], node[centre_of[i]], node[i]
        yield from _batches(rows(), ["token", "a", "b"])

    return posted.repartition("token").sortWithinPartitions("token", "node").mapInArrow(run, "token bigint, a bigint, b bigint")


def _unposted(posted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which coordinates each document is posted under, and the values there."""
    among = np.unpackbits(posted[:, :COORDINATES // 8], axis=1).astype(bool)
    values = np.zeros(among.shape, dtype=np.uint32)
    values[among] = np.ascontiguousarray(posted[:, COORDINATES // 8:]).view(np.uint32).ravel()
    return among, values


def _list_of_pair(among: np.ndarray, values: np.ndarray, node: np.ndarray, i: int, others: np.ndarray) -> np.ndarray:
    """The coordinate of the list that gives the pairs of i, the same in all lists that a pair shares.

    It is the first shared one from a place on that the pair gives, so that the pairs of a crowd spread over its lists.
    """
    shared = among[others] & among[i] & (values[others] == values[i])
    place = (np.arange(COORDINATES) - ((node[others] + node[i]) % COORDINATES)[:, None]) % COORDINATES
    return np.where(shared, place, COORDINATES).argmin(axis=1)


def between_components(lists: DataFrame, share: int, tries: int) -> DataFrame:
    """(token, a, b, more): candidates of different components, each from one of the lists that it shares.

    Of each document at most ``tries`` per list, those whose sketches differ least; ``more`` says that some were left for a
    later round.
    """
    def run(batches):
        def rows():
            for token, node, n, bits, posted, label in _lists(batches, ["node", "n", "bits", "posted", "label"]):
                among, values = _unposted(posted)
                # Members of the largest component are only partners: a pair needs one end outside it.
                names, counts = np.unique(label, return_counts=True)
                largest = names[counts.argmax()]
                everyone = np.arange(len(node))
                for i in np.flatnonzero(label != largest):
                    others = everyone[(label != label[i]) & ((label == largest) | (everyone > i))]
                    near, apart = _agree(bits, n, i, others, share)
                    own = _list_of_pair(among, values, node, i, near) == token[0] >> 32
                    near, apart = near[own], apart[own]
                    more = int(len(near) > tries)
                    for j in near[np.lexsort((node[near], apart))[:tries]]:
                        yield token[0], min(node[i], node[j]), max(node[i], node[j]), more
        yield from _batches(rows(), ["token", "a", "b", "more"])

    return lists.repartition("token").sortWithinPartitions("token", "node").mapInArrow(
        run, "token bigint, a bigint, b bigint, more bigint")


def confirmed(pairs: DataFrame, texts: DataFrame, size: int, share: int) -> DataFrame:
    """Pairs (a, b) whose full sets have 100 * common >= share * joint."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("ta"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("tb"))

    def run(batches):
        last, own = None, set()
        for batch in batches:
            keep = []
            for i, (a, ta, tb) in enumerate(zip(batch.column("a").to_pylist(), batch.column("ta"), batch.column("tb"), strict=True)):
                if a != last:
                    last, own = a, shingles(ta.as_py(), size)
                other = shingles(tb.as_py(), size)
                common = len(own & other)
                if 100 * common >= share * (len(own) + len(other) - common):
                    keep.append(i)
            yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))

    return pairs.join(right, "b").join(left, "a").select("a", "b", "ta", "tb").mapInArrow(run, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, share: int = 80) -> DataFrame:
    """One row per row of ``docs``: id, locator, n_shingles, component_id, first (whether this row is the one to keep)."""
    rows = located(docs, id_col, text_col)
    sketch = materialized(sketches(rows, size), BATCH_ROWS)
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "locator")).alias("first")
    grouped = sketch.where("n > 0").groupBy("sequence").agg(first, F.first("n").alias("n"), F.first("signature").alias("signature"))
    classes = materialized(grouped.withColumn("node", F.monotonically_increasing_id()))
    frequent = {r["token"]: r["count"] for r in frequent_tokens(classes, classes.count()).collect()}
    rare = rarity(docs.sparkSession, frequent)
    posted = materialized(postings(classes, rare), BATCH_ROWS)
    placed = classes.select("node", F.col("first.locator").alias("locator"))

    def texts_of(pairs: DataFrame) -> DataFrame:
        ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
        wanted = materialized(placed.join(ends, "node", "left_semi"))
        return maybe_in(rows, wanted).join(wanted, "locator").select("node", "text")

    lists = materialized(first_round(posted.join(low_bits(classes.select("node", "n", "signature"), rare).drop("posted"), "node"), share), BATCH_ROWS)
    pairs = materialized(lists.where("a <> b").groupBy("b").agg(F.min("a").alias("a")).select("a", "b"))
    tried = pairs
    links = materialized(confirmed(pairs, texts_of(pairs), size, share), BATCH_ROWS)
    labels = components(links)
    members = lists.select("token", F.col("b").alias("node"))
    tries = -(-TRIES // _POSTED)                    # of a list: a document's pairs are spread over the lists that it shares
    while True:
        known = members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        of_list = Window.partitionBy("token")
        several = known.withColumn("l", F.min("label").over(of_list)).withColumn("h", F.max("label").over(of_list)).where("l < h")
        members = materialized(several.select("token", "node", "label"))
        if members.isEmpty():
            break
        bits = low_bits(classes.join(members.select("node").distinct(), "node", "left_semi").select("node", "n", "signature"), rare)
        candidates = materialized(between_components(
            members.join(bits, "node").select("token", "node", "n", "bits", "posted", "label"), share, tries), BATCH_ROWS)
        new = materialized(candidates.select("a", "b").join(tried, ["a", "b"], "left_anti"))
        if not new.isEmpty():
            links = materialized(links.unionByName(confirmed(new, texts_of(new), size, share)), BATCH_ROWS)
            labels = components(links)
            tried = materialized(tried.unionByName(new))
        # A list that gave all its candidates is finished; merged components only take candidates away.
        unfinished = candidates.where("more = 1").select("token").distinct()
        members, tries = members.select("token", "node").join(unfinished, "token", "left_semi"), tries * 16
    labelled = classes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    heads = labelled.groupBy("label").agg(F.min("first").alias("head"))
    of_class = labelled.select("sequence", "label").join(heads, "label").select("sequence", "head")
    out = sketch.join(of_class, "sequence", "left")
    alone = F.col("n") == 0
    return out.select(
        F.col("id").alias(id_col), "locator", F.col("n").alias("n_shingles"),
        F.when(alone, F.col("id")).otherwise(F.col("head.id")).alias("component_id"),
        (alone | (F.col("locator") == F.col("head.locator"))).alias("first"))


def low_bits(classes: DataFrame, rare: Broadcast) -> DataFrame:
    """(node, n, bits, posted) of (node, n, signature).

    ``posted`` has a bit for each coordinate, set if the document is posted under it, then the values of these.
    """
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                signatures, parities = _stacked(batch.column("signature"))
                among = np.zeros(signatures.shape, dtype=bool)
                np.put_along_axis(among, _rarest(_tokens(signatures), *rare.value), True, axis=1)
                posted = np.hstack([np.packbits(among, axis=1), signatures[among].reshape(-1, _POSTED).view(np.uint8)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("node"), batch.column("n"), *[pa.array([x.tobytes() for x in rows], pa.binary()) for rows in (packed(signatures, parities), posted)]],
                    names=["node", "n", "bits", "posted"])

    return classes.mapInArrow(run, "node bigint, n bigint, bits binary, posted binary")


def kept_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, share: int = 80) -> DataFrame:
    """One row of every group of near duplicates, with all columns: the one with the smallest id."""
    docs = from_files(docs)
    own = fresh(docs, "_locator")
    stays = near_duplicates(docs, id_col, text_col, size, share).where("first").select(F.col("locator").alias(own))
    return docs.withColumn(own, locator()).join(stays, own, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
