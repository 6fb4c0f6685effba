"""SentencePiece encoding with the N best segmentations, and decoding.

Pieces and their scores come from a model file; nothing is trained.  A text is
a lattice: an edge for each piece at each place, and for a character without a
piece an edge of the bytes of its UTF-8 form.  A segmentation's score is the sum
of its edges' scores.  Forward Viterbi gives each place the best score from the
left, which is an exact heuristic for a search from the right: A* takes partial
segmentations in the order of what they can still reach, so the first N that
arrive at the start are the N best.

No edge crosses from another character to a blank, so a text falls into words,
and each distinct word is searched once.  Forward Viterbi runs over all new words of one
length at a time, place by place; pieces are found by a walk through their trie from all places at once.
The N best of the text differ from the best in the N - 1 words at most whose second best is
nearest; these words' lists are merged, again best first.  Partial segmentations are chains
of links, so a word of any length, like any text, takes space linear in its length.

For models whose scores are merge ranks (BPE) the lattice is scored with these
ranks; that is a segmentation of its own, not the greedy merge order.

Defined results: null gives null; the empty text has one segmentation, no
pieces, score 0; segmentations of equal score come in the order in which the
search reaches them, which is the same in every run.  Decoding returns the text exactly, but for U+2581, which stands for a blank.  Unknown ids
decode to nothing.  Other columns are kept; one named like the result is replaced.
"""

from __future__ import annotations

import heapq
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

BLANK = "▁"
#: Characters of words kept in a task's table (some 35 bytes each, with all that is known of the word); characters of text encoded
#: between two batches of results.
KNOWN_CHARS, SLICE = 1 << 20, 1 << 20
#: Spreads the keys of the trie's steps.
_SPREAD = 0x9E3779B97F4A7C15
#: Words up to this length are searched together, so many characters at a time; longer ones by themselves.
TOGETHER, STEP = 48, 1 << 18


@dataclass
class Vocabulary:
    pieces: dict[str, tuple[int, float]]
    bytes_: list[int]                       # ids of the 256 bytes
    unknown: float                          # score of a character without a piece
    surface: list[bytes]                    # what an id decodes to
    prefix: bool                            # a blank is put before the text


def load(path: str) -> Vocabulary:
    """Read a model file (on the driver; its size is that of the vocabulary)."""
    from sentencepiece import SentencePieceProcessor
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    model.ParseFromString(SentencePieceProcessor(model_file=path).serialized_model_proto())
    spec = model.normalizer_spec
    if spec.name not in ("identity", "") or spec.remove_extra_whitespaces:
        raise ValueError("only models that leave the text as it is are supported")
    pieces, bytes_, surface = {}, [0] * 256, []
    for i, p in enumerate(model.pieces):
        if p.type == p.BYTE:
            bytes_[int(p.piece[3:5], 16)] = i
            surface.append(bytes([int(p.piece[3:5], 16)]))
        elif p.type in (p.NORMAL, p.USER_DEFINED):
            pieces[p.piece] = (i, p.score)
            surface.append(p.piece.replace(BLANK, " ").encode())
        else:
            surface.append(b"")
    if any(BLANK in p.lstrip(BLANK) for p in pieces):
        raise ValueError("pieces with a blank behind another character are not supported")
    least = min((s for p, (_, s) in pieces.items() if len(p) == 1 and not p.isspace() and p != BLANK), default=0.0)
    return Vocabulary(pieces, bytes_, least - 10, surface, spec.add_dummy_prefix)


class _Link:
    """The ids of an edge and the links of all edges behind it; ordered as the ids from here on."""

    __slots__ = ("own", "behind")

    def __init__(self, own: tuple[int, ...], behind: _Link | None):
        self.own, self.behind = own, behind

    def ids(self) -> Iterator[int]:
        link = self
        while link is not None:
            yield from link.own
            link = link.behind

    def __lt__(self, other: _Link) -> bool:
        a, b = self, other
        while a is not None and b is not None and a is not b:
            if a.own != b.own:
                if len(a.own) != len(b.own):
                    return tuple(a.ids()) < tuple(b.ids())
                return a.own < b.own
            a, b = a.behind, b.behind
        return a is None and b is not None


class _Trie:
    """All pieces as a trie whose steps ``(node, character)`` lie in a hash table; node 0 is the root, and what leads nowhere."""

    def __init__(self, scores: dict[str, float | None], pieces: dict[str, tuple[int, float]]):
        nodes = {p: k for k, p in enumerate(scores, 1)}
        self.score = np.array([np.nan, *[np.nan if s is None else s for s in scores.values()]])
        self.ids = np.array([-1, *[pieces[p][0] if p in pieces else -1 for p in scores]], dtype=np.int32)
        bits = max(10, int(np.ceil(np.log2(len(nodes) + 1))) + 2)
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.next = np.full(1 << bits, -1, dtype=np.int64), np.zeros(1 << bits, dtype=np.int64)
        for piece, node in nodes.items():
            key = nodes.get(piece[:-1], 0) << 21 | ord(piece[-1])
            at = (key * _SPREAD & 0xFFFFFFFFFFFFFFFF) >> (64 - bits)
            while self.keys[at] >= 0:
                at = (at + 1) & self.mask
            self.keys[at], self.next[at] = key, node

    def step(self, node: np.ndarray, chars: np.ndarray) -> np.ndarray:
        """The nodes behind, 0 where no piece goes on."""
        key = node << 21 | chars
        at = (key.view(np.uint64) * np.uint64(_SPREAD) >> self.shift).view(np.int64)
        found = self.keys[at]
        out = np.where(found == key, self.next[at], 0)
        missed = np.flatnonzero((found != key) & (found >= 0))
        while len(missed):
            at[missed] = (at[missed] + 1) & self.mask
            found = self.keys[at[missed]]
            out[missed] = np.where(found == key[missed], self.next[at[missed]], 0)
            missed = missed[(found != key[missed]) & (found >= 0)]
        return out


class Encoder:
    def __init__(self, vocabulary: Vocabulary, n: int):
        self.v, self.n = vocabulary, n
        # Scores of pieces, None for what only starts one: a walk from a place ends where no piece goes on.
        self.scores: dict[str, float | None] = {}
        for piece, (_, score) in vocabulary.pieces.items():
            for j in range(1, len(piece)):
                self.scores.setdefault(piece[:j], None)
            self.scores[piece] = score
        # Blanks with the word behind them; no edge crosses a line break or tab that is in no piece.
        lone = "".join(c for c in "\n\t\r" if not any(c in p for p in vocabulary.pieces))
        self.words = re.compile((f"[{lone}]|" if lone else "") + f"{BLANK}+[^{BLANK}{lone}]*|[^{BLANK}{lone}]+")
        #: Numbers of known words, and by number their best ids, score and distance to the second best.
        self.known: dict[str, int] = {}
        self.parts: list[bytes] = []
        self.facts = np.zeros((2, 1024))
        self.chars = 0
        self.lists: dict[str, list[tuple[float, bytes]]] = {}
        self.listed = 0
        self.trie = _Trie(self.scores, vocabulary.pieces)

    def lattice(self, word: str) -> tuple[list[float], list[list[tuple[int, tuple[int, ...], float]]]]:
        """Best score up to each place, and the edges that end there."""
        n, get = len(word), self.scores.get
        alpha, ends = [0.0] + [-np.inf] * n, [[] for _ in range(n + 1)]
        for i in range(n):
            for j in range(i + 1, n + 1):
                s = get(word[i:j], False)
                if s is not False and s is not None:
                    edge = (i, (self.v.pieces[word[i:j]][0],), s)
                elif j == i + 1:
                    edge = (i, tuple(self.v.bytes_[b] for b in word[i].encode("utf-8", "surrogatepass")), self.v.unknown)
                elif s is None:
                    continue
                else:
                    break
                ends[j].append(edge)
                alpha[j] = max(alpha[j], alpha[i] + edge[2])
                if s is False:
                    break
        return alpha, ends

    def best(self, word: str) -> tuple[bytes, float, float]:
        """Ids of the best segmentation, its score, and how far below the second best is (forward Viterbi, two values a place)."""
        n, get, unknown = len(word), self.scores.get, self.v.unknown
        low = -np.inf
        alpha, second, back = [0.0] + [low] * n, [low] * (n + 1), [0] * (n + 1)
        for i in range(n):
            base, base2 = alpha[i], second[i]
            for j in range(i + 1, n + 1):
                s = get(word[i:j], False)
                if s is False or s is None:
                    if j == i + 1:
                        got, got2 = base + unknown, base2 + unknown
                    elif s is None:
                        continue
                    else:
                        break
                else:
                    got, got2 = base + s, base2 + s
                was = alpha[j]
                if got > was:
                    second[j] = was if was > got2 else got2
                    alpha[j], back[j] = got, i
                elif got > second[j]:
                    second[j] = got
                if s is False:
                    break
        at, ids, pieces = n, [], self.v.pieces
        while at:
            i = back[at]
            p = pieces.get(word[i:at])
            if p is None:
                ids += [self.v.bytes_[b] for b in reversed(word[i].encode("utf-8", "surrogatepass"))]
            else:
                ids.append(p[0])
            at = i
        ids.reverse()
        return array("i", ids).tobytes(), alpha[n], alpha[n] - second[n]

    def _keep(self, words: list[str], ids: list[bytes], scores: np.ndarray, gaps: np.ndarray) -> None:
        low, high = len(self.parts), len(self.parts) + len(words)
        self.known.update(zip(words, range(low, high), strict=True))
        self.parts += ids
        while high > self.facts.shape[1]:
            self.facts = np.concatenate([self.facts, np.zeros_like(self.facts)], axis=1)
        self.facts[0, low:high], self.facts[1, low:high] = scores, gaps
        self.chars += sum(map(len, words))

    def learn(self, texts: list[list[str]]) -> None:
        """Makes all words of these texts known."""
        new = set().union(*texts).difference(self.known)
        if self.chars + sum(map(len, new)) > KNOWN_CHARS and self.known:
            self.known, self.parts, self.chars = {}, [], 0
            new = set().union(*texts)
        by_length: dict[int, list[str]] = {}
        for w in new:
            by_length.setdefault(len(w), []).append(w)
        for n, words in by_length.items():
            if n > TOGETHER:
                ids, scores, gaps = zip(*map(self.best, words), strict=True)
                self._keep(words, list(ids), np.array(scores), np.array(gaps))
                continue
            for at in range(0, len(words), max(1, STEP // n)):
                self._learn(words[at:at + max(1, STEP // n)], n)

    def _learn(self, words: list[str], n: int) -> None:
        """:meth:`best` of many words of ``n`` characters."""
        many, trie = len(words), self.trie
        # place by place: character i of word w stands at i * many + w
        chars = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).reshape(-1, n).T.astype(np.int64).ravel()
        # All edges by their length, each in the order of the places where they begin.
        at, node, edges = np.arange(many * n), np.zeros(many * n, dtype=np.int64), []
        for d in range(n):
            node = trie.step(node, chars[at + d * many])
            on = np.flatnonzero(node)
            at, node = at[on], node[on]
            whole = np.flatnonzero(trie.ids[node] >= 0)
            begin = at[whole]
            edges.append((begin, trie.score[node[whole]], trie.ids[node[whole]], np.searchsorted(begin, np.arange(n + 1) * many)))
            room = np.searchsorted(at, (n - d - 1) * many)          # what can go on
            at, node = at[:room], node[:room]
            if not len(at):
                break
        # One character: a piece or, where there is none, its bytes.
        single, single_ids = np.full(many * n, self.v.unknown), np.full(many * n, -1, dtype=np.int32)
        single[edges[0][0]], single_ids[edges[0][0]] = edges[0][1], edges[0][2]
        alpha, second = np.full((n + 1, many), -np.inf), np.full((n + 1, many), -np.inf)
        alpha[0] = 0.0
        back, last = np.zeros((n + 1, many), dtype=np.int32), np.full((n + 1, many), -1, dtype=np.int32)
        for i in range(n):
            here, j = slice(i * many, (i + 1) * many), i + 1
            got, got2, was = alpha[i] + single[here], second[i] + single[here], alpha[j]
            better = got > was
            second[j] = np.where(better, np.maximum(was, got2), np.maximum(second[j], got))
            alpha[j], back[j], last[j] = np.where(better, got, was), np.where(better, i, back[j]), np.where(better, single_ids[here], last[j])
            for d, (begin, scores, ids, cuts) in enumerate(edges[1:n - i], 2):
                low, high = cuts[i], cuts[i + 1]
                if low == high:
                    continue
                w, s, j = begin[low:high] - i * many, scores[low:high], i + d
                got, was = alpha[i][w] + s, alpha[j][w]
                better = got > was
                second[j][w] = np.where(better, np.maximum(was, second[i][w] + s), np.maximum(second[j][w], got))
                win = w[better]
                alpha[j][win], back[j][win], last[j][win] = got[better], i, ids[low:high][better]
        # backwards, all words at once
        at, every, steps = np.full(many, n, dtype=np.int32), np.arange(many), []
        odd = np.zeros(many, dtype=bool)
        while at.any():
            ids = np.where(at > 0, last[at, every], -2)
            odd |= ids == -1
            steps.append(ids)
            at = np.where(at > 0, back[at, every], 0)
        found = np.array(steps[::-1], dtype=np.int32).T
        used = found > -2
        flat, ends = found[used].tobytes(), (4 * np.cumsum(used.sum(axis=1))).tolist()
        ids = [flat[low:high] for low, high in zip([0, *ends], ends)]
        for k in np.flatnonzero(odd).tolist():
            ids[k] = self.best(words[k])[0]          # characters without a piece are several ids
        self._keep(words, ids, alpha[n], alpha[n] - second[n])

    def n_best(self, word: str) -> list[tuple[float, bytes]]:
        """Up to n segmentations of one word, best first: backward A*."""
        got = self.lists.get(word)
        if got is None:
            alpha, ends = self.lattice(word)
            # An entry is a link: the ids of its edge and the entry behind it.  Ids are put together on arrival only.
            heap = [(-alpha[-1], len(word), _Link((), None), 0.0)]
            got = []
            while heap and len(got) < self.n:
                _, at, link, behind = heapq.heappop(heap)
                if at == 0:
                    got.append((behind, array("i", link.ids()).tobytes()))
                    continue
                for i, own, s in ends[at]:
                    heapq.heappush(heap, (-(alpha[i] + s + behind), i, _Link(own, link), s + behind))
            self.listed += sum(len(b) for _, b in got) + len(word)
            if self.listed >= KNOWN_CHARS:
                self.lists, self.listed = {}, 0
            self.lists[word] = got
        return got

    def split(self, text: str) -> list[str]:
        return self.words.findall(((BLANK if self.v.prefix else "") + text).replace(" ", BLANK)) if text else []

    def encode(self, text: str, words: list[str] | None = None) -> list[tuple[float, bytes]]:
        """Up to n segmentations of a text: (score, ids as 32-bit numbers), best first; ``words`` are known already."""
        if not text:
            return [(0.0, b"")]
        if words is None:
            words = self.split(text)
            self.learn([words])
        numbers = list(map(self.known.__getitem__, words))
        parts = list(map(self.parts.__getitem__, numbers))
        scores, gaps = self.facts.take(numbers, axis=1)
        total = float(scores.sum())
        out = [(total, b"".join(parts))]
        if self.n == 1:
            return out
        near = np.argsort(gaps, kind="stable")[:self.n - 1]
        near = sorted(near[np.isfinite(gaps[near])].tolist())
        choices = [self.n_best(words[i]) for i in near]
        cost = lambda pick: sum(c[0][0] - c[k][0] for c, k in zip(choices, pick, strict=True))
        heap, seen = [(0.0, (0,) * len(near))], {(0,) * len(near)}
        out = []
        while heap and len(out) < self.n:
            lost, pick = heapq.heappop(heap)
            for i, c, k in zip(near, choices, pick, strict=True):
                parts[i] = c[k][1]
            out.append((total - lost, b"".join(parts)))
            for d in range(len(pick)):
                more = pick[:d] + (pick[d] + 1,) + pick[d + 1:]
                if more[d] < len(choices[d]) and more not in seen:
                    seen.add(more)
                    heapq.heappush(heap, (cost(more), more))
        return out


def _plain(v: Vocabulary) -> tuple:
    return v.pieces, v.bytes_, v.unknown, v.surface, v.prefix


def encode(df: DataFrame, text_col: str, vocabulary: Vocabulary, n: int = 1, out: str = "nbest") -> DataFrame:
    """``df`` with ``out``: array of (score, ids), best first."""
    if n < 1:
        raise ValueError("ask for one segmentation at least")
    shared = df.sparkSession.sparkContext.broadcast(_plain(vocabulary))
    names = [c for c in df.columns if c != out]
    kind = pa.list_(pa.struct([("score", pa.float64()), ("ids", pa.list_(pa.int32()))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Vocabulary(*shared.value), n)

        def made(batch, low, high, rows):
            flat = [x for r in rows if r is not None for x in r]
            ids = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *[len(b) // 4 for _, b in flat]]), pa.int32()),
                                           pa.array(np.frombuffer(b"".join(b for _, b in flat), dtype=np.int32)))
            structs = pa.StructArray.from_arrays([pa.array([s for s, _ in flat], pa.float64()), ids], names=["score", "ids"])
            edges = np.cumsum([0, *[0 if r is None else len(r) for r in rows]]).astype(np.int32)
            mask = pa.array([r is None for r in rows], pa.bool_())
            lists = pa.ListArray.from_arrays(pa.array(edges), structs, mask=mask).cast(kind)
            cut = batch.slice(low, high - low)
            return pa.RecordBatch.from_arrays([*[cut.column(cut.schema.names.index(c)) for c in names], lists], names=[*names, out])

        for batch in batches:
            column, texts, low, size = batch.column(batch.schema.names.index(text_col)), [], 0, 0
            for at, text in enumerate(column):
                texts.append(text.as_py())
                size += len(texts[-1] or "")
                if size > SLICE or at + 1 == batch.num_rows:
                    words = [encoder.split(t or "") for t in texts]
                    encoder.learn(words)
                    yield made(batch, low, at + 1, [None if t is None else encoder.encode(t, w) for t, w in zip(texts, words, strict=True)])
                    texts, low, size = [], at + 1, 0
            if batch.num_rows:
                del batch, column, text, words           # or they stay until the next batch has been read

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name != out)
    return df.mapInArrow(run, f"{schema}, `{out}` array<struct<score: double, ids: array<int>>>")


def decode_ids(ids: list[int], v: Vocabulary) -> str:
    if ids and (min(ids) < 0 or max(ids) >= len(v.surface)):
        ids = [i for i in ids if 0 <= i < len(v.surface)]
    text = b"".join(map(v.surface.__getitem__, ids)).decode("utf-8", "replace")
    return text[1:] if v.prefix and text.startswith(" ") else text


def decode(df: DataFrame, ids_col: str, vocabulary: Vocabulary, out: str = "decoded") -> DataFrame:
    """``df`` with ``out``, the text of the ids."""
    shared = df.sparkSession.sparkContext.broadcast(_plain(vocabulary))
    names = [c for c in df.columns if c != out]

    def run(batches):
        v = Vocabulary(*shared.value)
        for batch in batches:
            texts = [None if not ids.is_valid else decode_ids(ids.values.to_numpy().tolist(), v)
                     for ids in batch.column(batch.schema.names.index(ids_col))]
            yield pa.RecordBatch.from_arrays([*[batch.column(batch.schema.names.index(c)) for c in names], pa.array(texts, pa.string())], names=[*names, out])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name != out)
    return df.mapInArrow(run, f"{schema}, `{out}` string")
