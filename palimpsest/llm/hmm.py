"""Hidden Markov language model of word sequences.

A token is a word (ASCII letters lower-cased) or the end of its text.  Every
word seen ``LEAST_COUNT`` times, the end, and ``CLASSES`` classes of the words
seen less or never (by a hash of their last three bytes) are the symbols that
states emit; their number follows the vocabulary.  A word within its class has
the probability (c + 1) / (C + V + 1), from the counts c of the word, C of the
class and its V distinct words in the training texts; the + 1 leaves room for
unseen words.  Every count comes from all training texts.

Texts are read and cut into tokens once: a block counts the words of its
training texts, and asks for its words a row for each shard of them.  Emissions are a table; neither the driver nor a broadcast ever holds the
vocabulary.  A row of it is a shard, the matrix of some thousand symbols, and a
symbol is a slot in its shard, so what travels are arrays of slots and of
numbers, not rows of single symbols.  Texts lie in blocks of about ``BLOCK``
tokens, and a block numbers its own symbols in the order of shards and slots.  A
round of Baum-Welch sends each block its part of every shard, runs the scaled
forward and backward recursions there, and adds the expected counts shard by
shard.  It does so for one of ``PASSES`` parts of the blocks after another, so
the shuffle files of one part only lie on the disks at a time.  Only states x
states numbers pass through the driver.  Scoring is the scaled forward recursion
alone, which is exact.

Null texts are empty: one token, the end.  Without training texts all
distributions are uniform and all counts 0.  Repeated rows and repeated ids are
rows of their own.  A text longer than a block is a block of its own; the way
back over it keeps one forward vector every ``TOKENS`` tokens and computes the
others again.  Columns beside the id and the text are not read.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.session import discard, materialized

CLASSES, STATES, ROUNDS = 1024, 8, 6
#: Weight of the prior in emissions (tokens per state) and transitions.
PRIOR, SEED = 2000.0, 5
#: Rarer words are always in classes, so that classes have the weight of words seen once or never.
LEAST_COUNT = 3
#: Tokens of a block; tokens that are run through the recursions at a time; rows whose expected counts are turned to columns at a time.
BLOCK, TOKENS, TURNED = 2_000_000, 400_000, 1 << 13
END = b""
#: Parts of the blocks that a round, like the coding and the scoring, takes one after another.
PASSES = 3
#: Distinct words of all blocks that ask one shard; symbols are shard << SLOT_BITS | slot, those of classes lie in negative shards.
SHARD_PLACES, SLOT_BITS, CLASS_SLOTS = 1 << 19, 33, 64
#: The shard of what is not an emission: a row per state of the transitions, then the first states.
MOVES = -1 << 20


def tokens(text: str | None) -> list[bytes]:
    """Words; the end is not among them."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def word_class(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % CLASSES


def _numbering() -> defaultdict:
    """Numbers 0, 1, .. for words as they come."""
    number = defaultdict()
    number.default_factory = number.__len__
    return number


def _numbers(number: defaultdict, words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(number.__getitem__, words), dtype=np.uint32, count=len(words))


# --------------------------------------------------------------------------- blocks

def _listed(values: pa.Array) -> pa.ListArray:
    """A column with one row, the list of all values."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def blocks(rows: DataFrame) -> DataFrame:
    """(block, ids, train, lengths, codes, words, counts, distinct): texts of a split, as places in the list of the block's distinct words; the end is place 0.

    ``words`` are joined by blanks; ``counts`` say how often the training texts hold each.
    """
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, ids, train, lengths, codes, size = _numbering(), [], [], [], [], 0

        def out():
            own = b"".join(codes)
            counts = np.bincount(np.frombuffer(own, dtype=np.uint32)[np.repeat(train, lengths)], minlength=len(number)).astype(np.uint32)
            batch = pa.RecordBatch.from_arrays(
                [_listed(pa.concat_arrays(ids)), _listed(pa.array(train, pa.bool_())), _listed(pa.array(lengths, pa.int64())),
                 pa.array([own], pa.binary()), pa.array([b" ".join(number)], pa.binary()), pa.array([counts.tobytes()], pa.binary()),
                 pa.array([len(number)], pa.int64())], names=["ids", "train", "lengths", "codes", "words", "counts", "distinct"])
            for kept in (number, ids, train, lengths, codes):
                kept.clear()
            return batch

        for batch in batches:
            column = batch.column("id")
            for i, text in enumerate(batch.column("text")):
                w = tokens(text.as_py())
                if size and size + len(w) + 1 > BLOCK:
                    yield out()
                    size = 0
                number[END]
                ids.append(column.slice(i, 1)), train.append(batch.column("train")[i].as_py()), lengths.append(len(w) + 1)
                codes.append(_numbers(number, w).tobytes() + b"\0\0\0\0")
                size += len(w) + 1
        if size:
            yield out()

    return rows.mapInArrow(run, f"ids array<{kind}>, train array<boolean>, lengths array<bigint>, codes binary, words binary, counts binary, distinct bigint").withColumn(
        "block", F.monotonically_increasing_id())


def word_counts(raw: DataFrame, shards: int, parts: int) -> DataFrame:
    """What the blocks ask of so many shards of the words, and the shards themselves as block -1.

    A block gets (shard, block, places, slots, counts) for its words: the place in its list, the slot among the shard's own
    symbols or -1 - class, and the count in all training texts.  A shard is (shard, names, name_counts) of its own symbols, the
    counts (classes, class_c, class_v) of its words within classes, and its tokens and distinct words, n and v.
    """
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, joined, seen in zip(*[batch.column(c).to_pylist() for c in ("block", "words", "counts")], strict=True):
                words, seen = joined.split(b" "), np.frombuffer(seen, dtype=np.uint32)
                of = np.fromiter(map(zlib.crc32, words), dtype=np.uint32, count=len(words)) % shards
                order = np.argsort(of, kind="stable")
                used, low = np.unique(of[order], return_index=True)
                places = np.split(order.astype(np.uint32), low[1:])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(used, pa.int64()), pa.array([block] * len(used), pa.int64()), pa.array([p.tobytes() for p in places], pa.binary()),
                     pa.array([b" ".join([words[i] for i in p.tolist()]) for p in places], pa.binary()),
                     pa.array([seen[p].tobytes() for p in places], pa.binary())], names=["shard", "block", "places", "words", "counts"])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, rows in _runs(batches):
            number = _numbering()
            asked = [_numbers(number, joined.as_py().split(b" ")) for joined in rows.column("words")]
            names, c = list(number), np.zeros(len(number), dtype=np.int64)
            for places, seen in zip(asked, rows.column("counts"), strict=True):
                c[places] += np.frombuffer(seen.as_py(), dtype=np.uint32)         # a block holds a word once
            own = (c >= LEAST_COUNT) | ((c > 0) & (number.get(END, -1) == np.arange(len(c))))
            within = np.fromiter(map(word_class, names), dtype=np.int32, count=len(names))
            slots = np.where(own, np.cumsum(own) - 1, -1 - within).astype(np.int32)
            rare = np.flatnonzero(~own & (c > 0))
            classes, place = np.unique(within[rare], return_inverse=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard] * len(asked), pa.int64()), rows.column("block").combine_chunks(), rows.column("places").combine_chunks(),
                 pa.array([slots[x].tobytes() for x in asked], pa.binary()), pa.array([c[x].tobytes() for x in asked], pa.binary()),
                 *[pa.nulls(len(asked), kind) for kind in (pa.list_(pa.binary()), *[pa.list_(pa.int64())] * 4, pa.int64(), pa.int64())]], names=columns)
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int64()), pa.array([-1], pa.int64()), *[pa.nulls(1, pa.binary())] * 3,
                 _listed(pa.array([names[i] for i in np.flatnonzero(own)], pa.binary())), _listed(pa.array(c[own], pa.int64())),
                 _listed(pa.array(classes, pa.int64())), _listed(pa.array(np.bincount(place, weights=c[rare], minlength=len(classes)).astype(np.int64))),
                 _listed(pa.array(np.bincount(place, minlength=len(classes)).astype(np.int64))), pa.array([int(c.sum())], pa.int64()),
                 pa.array([int((c > 0).sum())], pa.int64())], names=columns)

    columns = ["shard", "block", "places", "slots", "counts", "names", "name_counts", "classes", "class_c", "class_v", "n", "v"]
    asks = raw.select("block", "words", "counts").mapInArrow(ask, "shard bigint, block bigint, places binary, words binary, counts binary")
    return asks.repartition(parts, "shard").sortWithinPartitions("shard").mapInArrow(
        answer, "shard bigint, block bigint, places binary, slots binary, counts binary, names array<binary>, name_counts array<bigint>, "
                "classes array<bigint>, class_c array<bigint>, class_v array<bigint>, n bigint, v bigint")


def together(left: DataFrame, right: DataFrame, parts: int, run, schema: str) -> DataFrame:
    """``run`` on what both tables hold of each block."""
    left = left.withColumnRenamed("block", "of_block")
    return (left.repartition(parts, "of_block").groupBy("of_block").cogroup(right.repartition(parts, "block").groupBy("block"))
            .applyInArrow(run, schema))


def coded(texts: DataFrame, words: DataFrame, rooms: np.ndarray, total: int, distinct: int, parts: int) -> DataFrame:
    """Blocks whose texts are places in the block's list of symbols, with what only words tell of each text.

    The list is ``slots``, in shard ``shards[i]`` up to place ``edges[i]``.  ``words`` are the answers of :func:`word_counts`, ``rooms`` C + V + 1 of each class.  ``base`` is log10 of the base model; ``within`` log10 of the rare words within their classes.
    """
    kind = texts.schema["ids"].dataType.simpleString()

    def run(known: pa.Table, block: pa.Table) -> pa.Table:
        distinct_here = block.column("distinct")[0].as_py()
        symbol, c, room = (np.zeros(distinct_here, dtype=t) for t in (np.int64, np.float64, np.float64))
        for shard, places, slots, counts in zip(*[known.column(x).to_pylist() for x in ("shard", "places", "slots", "counts")], strict=True):
            place, slot = np.frombuffer(places, dtype=np.uint32), np.frombuffer(slots, dtype=np.int32).astype(np.int64)
            within = np.maximum(-1 - slot, 0)
            symbol[place] = np.where(slot >= 0, (shard << SLOT_BITS) + slot, _class_symbol(within))
            c[place] = np.frombuffer(counts, dtype=np.int64)
            room[place] = np.where(slot >= 0, 0.0, rooms[within])
        base = np.log10((c + 1) / (total + distinct + 1))
        within = np.where(room > 0, np.log10((c + 1) / np.maximum(room, 1)), 0.0)
        lengths = block.column("lengths")[0].values.to_numpy()
        codes = np.frombuffer(block.column("codes")[0].as_py(), dtype=np.uint32)
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        symbols, own = np.unique(symbol, return_inverse=True)
        shards, counts = np.unique(symbols >> SLOT_BITS, return_counts=True)
        of_text = lambda x: np.add.reduceat(x[codes], starts)
        return pa.table([block.column("block"), block.column("ids"), block.column("train"), block.column("lengths"),
                         _listed(pa.array(of_text((c > 0).astype(np.int64)))), _listed(pa.array(of_text(base))), _listed(pa.array(of_text(within))),
                         pa.array([_packed(own.astype(np.uint32)[codes], len(symbols))], pa.binary()), _listed(pa.array(shards)), _listed(pa.array(np.cumsum(counts))),
                         pa.array([(symbols & ((1 << SLOT_BITS) - 1)).astype(np.uint32).tobytes()], pa.binary())],
                        names=["block", "ids", "train", "lengths", "known", "base", "within", "codes", "shards", "edges", "slots"])

    return together(words.select("block", "shard", "places", "slots", "counts"), texts.drop("words", "counts"), parts, run,
                    f"block bigint, ids {kind}, train array<boolean>, lengths array<bigint>, known array<bigint>, base array<double>, "
                    "within array<double>, codes binary, shards array<bigint>, edges array<bigint>, slots binary")


def _packed(codes: np.ndarray, most: int) -> bytes:
    """Numbers below ``most``, in three bytes if that is enough, else in four."""
    return np.ascontiguousarray(codes.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3 if most <= 1 << 24 else 4]).tobytes()


def _unpacked(data: bytes, count: int) -> np.ndarray:
    out, data = np.zeros((count, 4), dtype=np.uint8), np.frombuffer(data, dtype=np.uint8).reshape(count, -1)
    out[:, :data.shape[1]] = data
    return out.reshape(-1).view("<u4")


def _class_symbol(of):
    """The symbol of a class, of numbers or of a column."""
    if isinstance(of, Column):
        return F.shiftleft(F.lit(-1) - F.floor(of / CLASS_SLOTS), SLOT_BITS) + of % CLASS_SLOTS
    return ((-1 - of // CLASS_SLOTS) << SLOT_BITS) + of % CLASS_SLOTS


# --------------------------------------------------------------------------- recursions

class Steps:
    """Texts side by side, longest first; token t of all of them lies together, so a step is a run of rows."""

    def __init__(self, texts: list[np.ndarray]):
        lengths = np.array([len(t) for t in texts], dtype=np.int64)
        self.order = np.argsort(-lengths, kind="stable")
        ranked = lengths[self.order]
        active = np.searchsorted(-ranked, -np.arange(ranked[0]), side="left")
        self.edges = np.concatenate([[0], np.cumsum(active)])
        begins = np.concatenate([[0], np.cumsum(lengths)[:-1]])[self.order]
        step = np.repeat(np.arange(len(active)), active)
        rank = np.arange(self.edges[-1]) - self.edges[step]
        self.symbols = np.concatenate(texts)[begins[rank] + step].astype(np.int64)

    def parts(self) -> list[tuple[int, int]]:
        """Runs of steps of at most TOKENS rows, or one step."""
        out, low, last = [], 0, len(self.edges) - 1
        while low < last:
            high = max(low + 1, int(np.searchsorted(self.edges, self.edges[low] + TOKENS, side="right")) - 1)
            out.append((low, high))
            low = high
        return out


class Room:
    """Arrays that are used again for the next texts: fresh memory costs as much time as the sums in it."""

    def __init__(self):
        self.held = {}

    def __call__(self, name: str, kind, *shape: int) -> np.ndarray:
        size = int(np.prod(shape))
        if name not in self.held or len(self.held[name]) < size or self.held[name].dtype != kind:
            self.held[name] = None
            self.held[name] = np.empty(size, kind)
        return self.held[name][:size].reshape(shape)


def _run_forward(edges: list[int], b: np.ndarray, alpha: np.ndarray | None, start: np.ndarray, move: np.ndarray, room: Room):
    """Scaled forward vectors and scales of a run of steps; ``alpha`` are those of the step before."""
    start, move = start.astype(b.dtype), move.astype(b.dtype)
    a, scale, ones = room("a", b.dtype, *b.shape), room("scale", b.dtype, len(b)), np.ones(len(start), b.dtype)
    column, low = scale[:, None], edges[0]
    for high in edges[1:]:
        own = a[low:high]
        if alpha is None:
            own[:] = start
        else:
            np.matmul(alpha[:high - low], move, own)
        np.multiply(own, b[low:high], own)
        np.dot(own, ones, scale[low:high])
        np.divide(own, column[low:high], own)
        alpha, low = own, high
    return a, scale


def _emitted(emit: np.ndarray, symbols: np.ndarray, room: Room) -> np.ndarray:
    """The rows of the symbols, all of which are places in ``emit``."""
    return np.take(emit, symbols, axis=0, out=room("b", emit.dtype, len(symbols), emit.shape[1]), mode="clip")


def forward(texts: list[np.ndarray], start: np.ndarray, move: np.ndarray, emit: np.ndarray, room: Room | None = None) -> np.ndarray:
    """log10 probability of each text."""
    out, room = np.zeros(len(texts)), room or Room()
    if not texts:
        return out
    steps, alpha = Steps(texts), None
    for low, high in steps.parts():
        edges = steps.edges[low:high + 1] - steps.edges[low]
        a, scale = _run_forward(edges.tolist(), _emitted(emit, steps.symbols[steps.edges[low]:steps.edges[high]], room), alpha, start, move, room)
        rank = np.arange(len(scale)) - np.repeat(edges[:-1], np.diff(edges))
        out += np.bincount(rank, weights=np.log10(scale, dtype=np.float64), minlength=len(out))
        alpha = a[edges[-2]:].copy()
    ordered = np.empty_like(out)
    ordered[steps.order] = out
    return ordered


def expected(texts: list[np.ndarray], start: np.ndarray, move: np.ndarray, emit: np.ndarray, room: Room | None = None):
    """Expected counts of first states, transitions and (symbol, state), and the log10 probability.

    Of a run of steps only the vector before it is kept, unless it is the only one; on the way back its others are computed again.
    """
    k, steps = len(start), Steps(texts)
    parts, kept, total, room = steps.parts(), [], 0.0, room or Room()

    def onward(low: int, high: int, alpha: np.ndarray | None):
        edges = steps.edges[low:high + 1] - steps.edges[low]
        b, edges = _emitted(emit, steps.symbols[steps.edges[low]:steps.edges[high]], room), edges.tolist()
        return edges, b, *_run_forward(edges, b, alpha, start, move, room)

    alpha = None
    for low, high in parts:
        kept.append(alpha)
        run = onward(low, high, alpha)
        total += float(np.log10(run[3], dtype=np.float64).sum())
        alpha = run[2][run[0][-2]:].copy()
    moves, counts, beta, first = np.zeros((k, k)), np.zeros((k, len(emit))), None, None
    back = np.ascontiguousarray(move.T, dtype=emit.dtype)
    for (low, high), before in zip(reversed(parts), reversed(kept), strict=True):
        edges, b, a, scale = run if len(parts) == 1 else onward(low, high, before)
        b /= scale[:, None]                         # from here on: emission / scale, then times the backward vector
        own, at_high = room("own", a.dtype, *a.shape), edges[-1]
        own.fill(1)
        for at_low in edges[-2::-1]:
            here = own[at_low:at_high]
            if beta is not None:
                np.matmul(beta, back, here[:len(beta)])
            beta, at_high = b[at_low:at_high], at_low
            np.multiply(beta, here, beta)
        beta = beta.copy() if low else None         # the next run takes its place
        sizes = np.diff(edges)
        previous = np.arange(edges[1], len(a)) - np.repeat(sizes[:-1], sizes[1:])
        own *= a
        place = steps.symbols[steps.edges[low]:steps.edges[high]]
        moves += np.take(a, previous, axis=0, out=room("previous", a.dtype, len(previous), k), mode="clip").T @ b[edges[1]:]
        if before is not None:
            moves += before[:edges[1]].T @ b[:edges[1]]
        weights = room("b", own.dtype, k, len(own))      # in place of b, which is not needed any more
        for at in range(0, len(own), TURNED):
            weights[:, at:at + TURNED] = own[at:at + TURNED].T
        for i in range(k):
            counts[i] += np.bincount(place, weights=weights[i], minlength=len(emit))
        if low == 0:
            first = own[:edges[1]].sum(axis=0)
    return first, moves * move, counts.T, total


def chunks(lengths: np.ndarray) -> Iterator[np.ndarray]:
    """Places of texts of similar length, TOKENS tokens (or one text) at a time."""
    order = np.argsort(-lengths, kind="stable")
    size = np.cumsum(lengths[order])
    low = 0
    while low < len(order):
        done = size[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(size, done + TOKENS, side="right")))
        yield order[low:high]
        low = high


# --------------------------------------------------------------------------- training and scoring

def _block_texts(block: pa.Table) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Texts, lengths and which of them are for training."""
    lengths = block.column("lengths")[0].values.to_numpy()
    codes = _unpacked(block.column("codes")[0].as_py(), lengths.sum())
    train = np.array(block.column("train")[0].values.to_pylist(), dtype=bool)
    return np.split(codes, np.cumsum(lengths)[:-1]), lengths, train


def _emissions(known: pa.Table, totals: np.ndarray, kind=np.float64) -> np.ndarray:
    """A row for each of the block's symbols."""
    order = np.argsort(known.column("shard").to_numpy())
    values = known.column("data").to_pylist()
    emit = np.frombuffer(b"".join([values[i] for i in order]), dtype=np.float32).reshape(-1, len(totals)).astype(kind)
    return emit / totals.astype(kind)


def _round(start: np.ndarray, move: np.ndarray, totals: np.ndarray):
    """Expected counts of a block: (shard, slots, values), and those of transitions and first states as the shard ``MOVES``."""
    states = len(start)

    def run(known: pa.Table, block: pa.Table) -> pa.Table:
        emit = _emissions(known, totals, np.float32)         # counts need no more; scores are taken in double precision
        all_texts, lengths, is_train = _block_texts(block)
        first, moves, counts = np.zeros(states), np.zeros((states, states)), np.zeros((len(emit), states))
        own, room = np.flatnonzero(is_train), Room()
        for part in chunks(lengths[own]):
            f, m, c, _ = expected([all_texts[i] for i in own[part]], start, move, emit, room)
            first += f
            moves += m
            counts += c
        shards, slots, values = [MOVES], [np.arange(states + 1, dtype=np.uint32)], [np.vstack([moves, first])]
        for shard, low, high, of_shard in _shards(block, 0):
            seen = np.flatnonzero(counts[low:high].any(axis=1))
            if len(seen):
                shards.append(shard), slots.append(of_shard[seen]), values.append(counts[low:high][seen])
        return pa.table([pa.array(shards, pa.int64()), pa.array([x.tobytes() for x in slots], pa.binary()),
                         pa.array([x.astype(np.float32).tobytes() for x in values], pa.binary())], names=["shard", "slots", "values"])

    return run


def _shards(blocks: pa.Table | pa.RecordBatch, i: int) -> Iterator[tuple[int, int, int, np.ndarray]]:
    """(shard, its first place, the place behind its last, its slots) of a block."""
    edges = blocks.column("edges")[i].values.to_numpy().tolist()
    slots = np.frombuffer(blocks.column("slots")[i].as_py(), dtype=np.uint32)
    for shard, low, high in zip(blocks.column("shards")[i].values.to_numpy().tolist(), [0, *edges], edges, strict=False):
        yield shard, low, high, slots[low:high]


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """The rows of each shard of a sorted partition."""
    held, last = [], None
    for batch in batches:
        keys = batch.column("shard").to_numpy()
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for low, high in zip(cuts, cuts[1:], strict=False):
            if low == high:
                continue
            if held and keys[low] != last:
                yield last, pa.Table.from_batches(held)
                held = []
            last = int(keys[low])
            held.append(batch.slice(low, high - low))
    if held:
        yield last, pa.Table.from_batches(held)


def _matrix(data: bytes, states: int, kind) -> np.ndarray:
    return np.frombuffer(data, dtype=kind).reshape(-1, states)


def in_shards(symbols: DataFrame, columns: list[str], parts: int) -> DataFrame:
    """(shard, values, sums): the columns of (symbol, ..) as a matrix a shard, in single precision, and its sums in double."""
    def run(batches):
        for shard, rows in _runs(batches):
            yield _shard_row(shard, np.stack([rows.column(c).to_numpy() for c in columns], axis=1), np.float32)

    rows = symbols.select(F.shiftright("symbol", SLOT_BITS).alias("shard"), "symbol", *[F.col(c).cast("double").alias(c) for c in columns])
    return rows.repartition(parts, "shard").sortWithinPartitions("shard", "symbol").mapInArrow(run, _SHARDS)


_SHARDS = "shard bigint, values binary, sums array<double>"


def _shard_row(shard: int, values: np.ndarray, kind) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([np.ascontiguousarray(values, dtype=kind).tobytes()], pa.binary()),
                                       _listed(pa.array(values.sum(axis=0), pa.float64()))], names=["shard", "values", "sums"])


def added(shards: DataFrame, counts: DataFrame, parts: int, states: int, first: bool, last: bool) -> DataFrame:
    """The shards with the counts (shard, slots, values) added.

    The first shards are the prior, one column in single precision for all states; the last are emissions, also in single
    precision; those between and ``MOVES`` are in double precision.
    """
    def run(batches):
        for shard, rows in _runs(batches):
            total, more = None, []
            for slots, values in zip(rows.column("slots").to_pylist(), rows.column("values").to_pylist(), strict=True):
                if slots is None:
                    total = np.repeat(_matrix(values, 1, np.float32).astype(np.float64), states, axis=1) if first else _matrix(values, states, np.float64).copy()
                else:
                    more.append((np.frombuffer(slots, dtype=np.uint32), _matrix(values, states, np.float32)))
            if total is None:                   # only MOVES has no prior
                total = np.zeros((states + 1, states))
            for slots, values in more:
                total[slots] += values
            yield _shard_row(shard, total, np.float32 if last and shard != MOVES else np.float64)

    rows = counts.unionByName(shards.select("shard", F.lit(None).cast("binary").alias("slots"), "values"))
    return rows.repartition(parts, "shard").sortWithinPartitions("shard").mapInArrow(run, _SHARDS)


def train(parted: list[DataFrame], symbols: DataFrame, parts: int, states: int = STATES, rounds: int = ROUNDS):
    """(start, move, totals, emissions) after so many rounds; column i of the matrices (shard, values) is divided by totals[i]."""
    columns = [f"e{i}" for i in range(states)]
    start = np.full(states, 1 / states)
    move = np.full((states, states), 0.1 / max(1, states - 1)) + np.eye(states) * (0.9 - (0.1 / max(1, states - 1)))
    move /= move.sum(axis=1, keepdims=True)
    # The first emissions differ by a factor of mean 1 that a hash of the symbol gives: half the sum of two exponential numbers.
    draw = lambda i, j: F.log((F.pmod(F.xxhash64("name", F.lit(SEED), F.lit(i), F.lit(j)), F.lit(1 << 52)) + 0.5) / float(1 << 52))
    emissions = materialized(in_shards(symbols.select("symbol", *[(F.col("prior") * -0.5 * (draw(i, 0) + draw(i, 1))).alias(c) for i, c in enumerate(columns)]),
                                       columns, parts))
    prior = materialized(in_shards(symbols.select("symbol", (F.col("prior") * PRIOR).cast("float").alias("prior")), ["prior"], parts))
    sums = lambda table: np.array([x or 1.0 for x in table.agg(*[F.sum(F.col("sums")[i]) for i in range(states)]).first()])
    totals = sums(emissions)
    for _ in range(rounds):
        new = prior
        for at, texts in enumerate(parted):
            counts = together(_placed(texts, emissions, parts, states), texts.select("block", "train", "lengths", "codes", "shards", "edges", "slots"), parts,
                              _round(start, move, totals), "shard bigint, slots binary, values binary")
            before, new = new, materialized(added(new, counts, parts, states, at == 0, at == len(parted) - 1))
            if before is not prior:
                discard(before)
        discard(emissions)
        rest = new.where(F.col("shard") == MOVES).first()                  # states + 1 rows
        rest = _matrix(bytes(rest["values"]), states, np.float64) if rest else np.zeros((states + 1, states))
        emissions = new.where(F.col("shard") != MOVES)
        totals = sums(emissions)
        start = rest[states] + 1.0
        start = start / start.sum()
        move = rest[:states] + 1.0
        move /= move.sum(axis=1, keepdims=True)
    return start, move, totals, emissions


def _placed(texts: DataFrame, emissions: DataFrame, parts: int, states: int) -> DataFrame:
    """(block, shard, data): what a block needs of a shard of the emissions, a row of numbers for each of its slots."""
    def ask(batches):
        for batch in batches:
            for i, block in enumerate(batch.column("block").to_pylist()):
                rows = [(shard, slots.tobytes()) for shard, _, _, slots in _shards(batch, i)]
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in rows], pa.int64()), pa.array([block] * len(rows), pa.int64()),
                                                  pa.array([x for _, x in rows], pa.binary())], names=["shard", "block", "data"])

    def answer(batches):
        for shard, rows in _runs(batches):
            blocks, data = rows.column("block").to_pylist(), rows.column("data").to_pylist()
            at = blocks.index(-1)
            values = _matrix(data[at], states, np.float32)
            asked = [i for i in range(len(blocks)) if i != at]
            yield pa.RecordBatch.from_arrays(
                [pa.array([blocks[i] for i in asked], pa.int64()), pa.array([shard] * len(asked), pa.int64()),
                 pa.array([values[np.frombuffer(data[i], dtype=np.uint32)].tobytes() for i in asked], pa.binary())], names=["block", "shard", "data"])

    wanted = texts.select("block", "shards", "edges", "slots").mapInArrow(ask, "shard bigint, block bigint, data binary")
    both = wanted.unionByName(emissions.select("shard", F.lit(-1).cast("bigint").alias("block"), F.col("values").alias("data")))
    return both.repartition(parts, "shard").sortWithinPartitions("shard").mapInArrow(answer, "block bigint, shard bigint, data binary")


def likelihoods(texts: DataFrame, model, parts: int) -> DataFrame:
    """A row per text: id, train, n_tokens, n_known, base, score."""
    start, move, totals, emissions = model
    kind = texts.schema["ids"].dataType.elementType.simpleString()

    def run(known: pa.Table, block: pa.Table) -> pa.Table:
        emit = _emissions(known, totals)
        all_texts, lengths, _ = _block_texts(block)
        out, room = np.zeros(len(lengths)), Room()
        for part in chunks(lengths):
            out[part] = forward([all_texts[i] for i in part], start, move, emit, room)
        values = lambda c: block.column(c)[0].values
        return pa.table([values("ids"), values("train"), values("lengths"), values("known"), values("base"),
                         pa.array(out + values("within").to_numpy())], names=["id", "train", "n_tokens", "n_known", "base", "score"])

    return together(_placed(texts, emissions, parts, len(start)), texts.drop("shards", "edges", "slots"), parts, run,
                    f"id {kind}, train boolean, n_tokens bigint, n_known bigint, base double, score double")


def language_model(docs: DataFrame, is_train: Column, id_col: str = "doc_id", text_col: str = "text", states: int = STATES,
                   rounds: int = ROUNDS) -> DataFrame:
    """Per row: id, train, n_tokens, n_known, train_tokens, base_score, score (log10)."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(is_train, F.lit(False)).alias("train"), F.col(text_col).cast("string").alias("text"))
    raw = materialized(blocks(rows))
    sizes = raw.agg(F.count(F.lit(1)).alias("n"), F.sum("distinct").alias("places")).first()
    parts = max(1, min(2 * sizes["n"], int(spark.conf.get("spark.sql.shuffle.partitions"))))
    shards = max(parts, -(-(sizes["places"] or 0) // SHARD_PLACES))
    counted = materialized(word_counts(raw, shards, parts))
    found = counted.where("block = -1")
    sums = found.agg(F.sum("n").alias("n"), F.sum("v").alias("v"), F.sum(F.size("names")).alias("own")).first()
    total, distinct = sums["n"] or 0, sums["v"] or 0
    classes = found.select(F.explode(F.arrays_zip("classes", "class_c", "class_v")).alias("x")).groupBy("x.classes").agg(
        F.sum("x.class_c").alias("class_c"), F.sum("x.class_v").alias("class_v"))
    everyone = materialized(spark.range(CLASSES).select(F.col("id").alias("classes")).join(F.broadcast(classes), "classes", "left").na.fill(0))   # CLASSES rows
    rooms = np.ones(CLASSES)
    for row in everyone.collect():
        rooms[row["classes"]] += row["class_c"] + row["class_v"]
    prior = (F.col("c") + 1) / F.lit(float(total + (sums["own"] or 0) + CLASSES))
    symbols = found.select("shard", F.posexplode(F.arrays_zip("names", "name_counts")).alias("slot", "x")).select(
        (F.shiftleft("shard", SLOT_BITS) + F.col("slot")).alias("symbol"), F.col("x.names").alias("name"), F.col("x.name_counts").alias("c")).unionByName(
        everyone.select(_class_symbol(F.col("classes")).alias("symbol"), F.concat(F.lit(" "), F.col("classes").cast("string")).cast("binary").alias("name"),
                        F.col("class_c").alias("c"))).select("symbol", "name", prior.alias("prior"))
    of_part = lambda table, i: table.where((F.col("block") >= 0) & (F.pmod("block", F.lit(PASSES)) == i))
    parted = [materialized(coded(of_part(raw, i), of_part(counted, i), rooms, total, distinct, parts)) for i in range(PASSES)]
    discard(raw)
    model = train(parted, symbols, parts, states, rounds)
    scored = [materialized(likelihoods(texts, model, parts)) for texts in parted]
    return reduce(DataFrame.unionByName, scored).select(
        F.col("id").alias(id_col), "train", "n_tokens", "n_known", F.lit(total).cast("bigint").alias("train_tokens"),
        F.col("base").alias("base_score"), "score")
