"""SentencePiece encoding and decoding with the N best segmentations.

A text is a lattice of vocabulary pieces. Forward Viterbi scores give, for every
place, the best score of the text before it; searching backward from the end
with them as heuristic (A*) is exact, so complete paths leave the queue in order
of score. A segmentation's score is the sum of its pieces' scores.

The lattice has cut places where no piece spans (before a space that follows
another character; checked against the vocabulary when it is loaded). It is
scored segment by segment, each distinct segment once per worker: Viterbi gives
its best path and the loss of its second best. The document's N best are the N
best sums over its segments; they can differ from the best only in the N - 1
segments of least loss, and A* searches those.

White space is kept: a leading space is added, spaces become U+2581. Characters
outside the vocabulary become byte pieces, each scored below every other piece.
Null and empty texts have no ids. Equal scores keep the search's order, which
depends on the text alone. Very long texts are encoded whole, segment by segment.
Repeated rows get equal results. An empty table gives an empty result. Other columns
are not read.
"""

from __future__ import annotations

import heapq
import re
import zlib
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, utf8

SPACE = "▁"
N_BEST = 4
INF = float("inf")
CACHED_SEGMENTS = 50_000
#: Longest segments that are scored many at a time.
MOST_TOGETHER = 40
_SEGMENT = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
#: RE2: a space at an end of the text or beside another, or the space symbol itself.
_UNSAFE = rf"^ | $|  |{SPACE}"


def _step(h: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Hashes of texts one character longer."""
    h = (h ^ (codes.astype(np.uint64) + np.uint64(1))) * np.uint64(0x9E3779B97F4A7C15)  # a NUL in front counts too
    return h ^ (h >> np.uint64(29))


def _hash(piece: str) -> int:
    h = np.zeros(1, np.uint64)
    for c in piece:
        h = _step(h, np.array([ord(c)]))
    return int(h[0])


class Vocabulary:
    """Pieces, ids and scores of a model file."""

    def __init__(self, path: str):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces: dict[str, tuple[tuple[int, ...], float]] = {}
        self.byte_ids: dict[int, int] = {}
        self.raw: list[bytes] = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(piece[1:-1], 16)] = i
                self.raw.append(bytes([int(piece[1:-1], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.raw.append(b"")
            else:
                self.pieces[piece] = ((i,), model.get_score(i))
                self.raw.append(piece.replace(SPACE, " ").encode())
        self.longest = max(map(len, self.pieces))
        self.byte_score = min((s for _, s in self.pieces.values() if s > -1e8), default=0.0) - 10
        if any(SPACE in p.lstrip(SPACE) for p in self.pieces):
            raise ValueError("a piece has a space after another character; segments would not be independent")
        #: For `viterbi_many`: pieces and one-byte characters without a piece, by hash; the last entry is for none.
        table = {p: x for p, x in self.pieces.items()}
        for c in map(chr, range(0x80)):
            if c not in table and ord(c) in self.byte_ids:
                table[c] = self.fallback(c)
        self.index = pd.Index([_hash(p) for p in table], dtype=np.uint64)
        self.by_place = np.array([*(s for _, s in table.values()), -INF])
        self.place_ids = np.array([*(ids[0] for ids, _ in table.values()), -1], np.int32)
        self.known = np.zeros(max(ord(c) for p in table for c in p) + 2, bool)
        self.known[[ord(p) for p in table if len(p) == 1]] = True

    def fallback(self, char: str) -> tuple[tuple[int, ...], float]:
        """Byte pieces and their score, for a character without a piece."""
        raw = char.encode()
        return tuple(self.byte_ids[b] for b in raw), self.byte_score * len(raw)

    def viterbi(self, text: str) -> tuple[list[float], list[int], float]:
        """Best score of the text before every place, the best ids of the whole, and what the second best loses."""
        get, longest = self.pieces.get, self.longest
        best, second, back = [0.0], [-INF], [(0, ())]
        for end in range(1, len(text) + 1):
            one = two = -INF
            entry = None
            for start in range(max(0, end - longest), end):
                p = get(text[start:end])
                if p is None:
                    if start + 1 < end:
                        continue
                    if text[start] in self.pieces:
                        continue
                    p = self.fallback(text[start])
                score = best[start] + p[1]
                if score > one:
                    two, one, entry = one, score, (start, p[0])
                elif score > two:
                    two = score
                score = second[start] + p[1]
                if score > two:
                    two = score
            best.append(one)
            second.append(two)
            back.append(entry)
        parts = []
        place = len(text)
        while place:
            place, ids = back[place]
            parts.append(ids)
        return best, [i for ids in reversed(parts) for i in ids], best[-1] - second[-1]

    def viterbi_many(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """`viterbi` of many short texts: scores, losses and ids.

        Texts of one length are searched together, place by place. Pieces are
        looked up by a 64-bit hash of their characters.
        """
        scores, losses = np.zeros(len(texts)), np.zeros(len(texts))
        ids: list[np.ndarray] = [np.empty(0, np.int32)] * len(texts)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        for size in np.unique(sizes).tolist():
            rows = np.flatnonzero(sizes == size)
            if size <= MOST_TOGETHER:
                codes = np.frombuffer("".join([texts[i] for i in rows.tolist()]).encode("utf-32-le"), np.uint32)
                codes = codes.reshape(len(rows), size)
                whole = self.known[np.minimum(codes, len(self.known) - 1)].all(axis=1)
                for at in range(0, len(rows), 10_000):
                    part = np.flatnonzero(whole[at:at + 10_000]) + at
                    if len(part):
                        found = self._together(codes[part])
                        scores[rows[part]], losses[rows[part]] = found[:2]
                        for i, x in zip(rows[part].tolist(), found[2], strict=True):
                            ids[i] = x
                rows = rows[~whole]
            for i in rows.tolist():
                best, one, losses[i] = self.viterbi(texts[i])
                scores[i], ids[i] = best[-1], np.array(one, np.int32)
        return scores, losses, ids

    def _together(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        n, size = codes.shape
        best, second = np.full((size + 1, n), -INF), np.full((size + 1, n), -INF)
        back, piece = np.zeros((size + 1, n), np.int64), np.full((size + 1, n), -1, np.int32)
        best[0] = 0.0
        found: dict[int, np.ndarray] = {}
        h = np.zeros((n, size + 1), np.uint64)
        for k in range(1, min(size, self.longest) + 1):
            h = _step(h[:, :size - k + 1], codes[:, k - 1:])
            found[k] = self.index.get_indexer(h.ravel()).reshape(h.shape).T
        for end in range(1, size + 1):
            for k in range(min(end, self.longest), 0, -1):
                at = found[k][end - k]
                score = self.by_place[at]
                one, two = best[end - k] + score, second[end - k] + score
                better = one > best[end]
                second[end] = np.maximum(np.where(better, best[end], np.maximum(second[end], one)), two)
                best[end] = np.where(better, one, best[end])
                back[end] = np.where(better, end - k, back[end])
                piece[end] = np.where(better, at, piece[end])
        place, steps, every = np.full(n, size), [], np.arange(n)
        while place.any():
            steps.append(np.where(place > 0, self.place_ids[piece[place, every]], -1))
            place = np.where(place > 0, back[place, every], 0)
        flat = np.stack(steps[::-1], axis=1)
        real = flat >= 0
        return best[size], best[size] - second[size], np.split(flat[real], np.cumsum(real.sum(axis=1))[:-1])

    def n_best(self, text: str, n: int) -> list[tuple[float, list[int]]]:
        """The ``n`` best segmentations of one text, best first, by backward A*."""
        best, first, _ = self.viterbi(text)
        edges: dict[int, list[tuple[float, int, tuple[int, ...], float]]] = {0: []}

        def into(end: int):
            """Pieces that end at a place, by the best score of a path through them."""
            if end not in edges:
                found = [(start, *p) for start in range(max(0, end - self.longest), end)
                         if (p := self.pieces.get(text[start:end])) is not None]
                if text[end - 1] not in self.pieces:
                    found.append((end - 1, *self.fallback(text[end - 1])))
                edges[end] = sorted(((-best[start] - score, start, ids, score) for start, ids, score in found),
                                    key=lambda e: e[:2])
            return edges[end]

        out: list[tuple[float, list[int]]] = []
        # An entry stands for its edge and, until it is taken, for the worse edges into the same place.
        # Of equal scores the one nearest to the start goes first, so ties don't widen the search.
        queue: list[tuple] = []
        count = 0

        def push(end: int, rank: int, after: float, path: tuple) -> None:
            nonlocal count
            if rank < len(into(end)):
                cost, start, ids, score = edges[end][rank]
                count += 1
                heapq.heappush(queue, (cost - after, start, count, end, rank, after, path, ids, score))

        push(len(text), 0, 0.0, ())
        while queue and len(out) < n:
            _, start, _, end, rank, after, path, ids, score = heapq.heappop(queue)
            push(end, rank + 1, after, path)
            if start:
                push(start, 0, after + score, (ids, path))
                continue
            node, found = (ids, path), []
            while node:
                found += node[0]
                node = node[1]
            out.append((after + score, found))
        # Among equal scores the path that Viterbi takes counts as the first.
        others = [x for x in out if x[1] != first][:n - 1]
        return [(best[-1], first), *others]

    def decode(self, ids) -> bytes:
        """The text of an id sequence, without the leading space that encoding adds."""
        text = b"".join(map(self.raw.__getitem__, ids))
        return text[1:] if text[:1] == b" " else text


class Encoder:
    """N best segmentations of whole texts, each distinct segment searched once."""

    def __init__(self, path: str, n: int = N_BEST):
        self.vocabulary, self.n = Vocabulary(path), n
        self._clear()

    def _clear(self) -> None:
        self.place: dict[str, int] = {}
        self.names: list[str] = []
        #: Per segment: score and ids of its best segmentation, and the loss of its second best (inf: none).
        self.scores = np.empty(0)
        self.loss = np.empty(0)
        self.starts = np.zeros(1, np.int64)
        self.pool = np.empty(0, np.int32)
        self.searched: dict[int, list[tuple[float, list[int]]]] = {}

    def learn(self, segments: list[str]) -> np.ndarray:
        new = [s for s in dict.fromkeys(segments) if s not in self.place]
        if new:
            scores, losses, ids = self.vocabulary.viterbi_many(new)
            self.place.update(zip(new, range(len(self.place), len(self.place) + len(new)), strict=True))
            self.names += new
            self.scores = np.append(self.scores, scores)
            self.loss = np.append(self.loss, losses)
            self.starts = np.append(self.starts, len(self.pool) + np.cumsum([len(x) for x in ids]))
            self.pool = np.concatenate([self.pool, *ids])
        return np.fromiter(map(self.place.__getitem__, segments), np.int64, len(segments))

    def segments(self, texts) -> list[np.ndarray]:
        """Places of each text's segments, for an Arrow string array."""
        import pyarrow as pa
        import pyarrow.compute as pc
        texts = pc.fill_null(texts, "")
        unsafe = pc.match_substring_regex(texts, _UNSAFE).to_numpy(zero_copy_only=False)
        cut = pc.split_pattern(pc.if_else(pa.array(unsafe), "", texts), " ")
        words = cut.flatten().dictionary_encode()
        places = self.learn([SPACE + w for w in words.dictionary.to_pylist()])[words.indices.to_numpy()]
        out = np.split(places, cut.offsets.to_numpy()[1:-1] - cut.offsets[0].as_py())
        for i in np.flatnonzero(unsafe).tolist():
            out[i] = self.learn(_SEGMENT.findall(SPACE + texts[i].as_py().replace(" ", SPACE)))
        for i in np.flatnonzero(pc.equal(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)).tolist():
            out[i] = places[:0]
        return out

    def trim(self) -> None:
        """Forget the segments once they are too many; their places are no longer valid."""
        if len(self.place) > CACHED_SEGMENTS:
            self._clear()

    def _alternatives(self, place: int) -> list[tuple[float, list[int]]]:
        """(loss, ids) of the n best of one segment."""
        if place not in self.searched:
            found = self.vocabulary.n_best(self.names[place], self.n)
            self.searched[place] = [(found[0][0] - s, ids) for s, ids in found]
        return self.searched[place]

    def n_best(self, places: np.ndarray) -> list[tuple[float, np.ndarray]]:
        """The best segmentations of the text that these segments make up: (score, ids), best first."""
        starts = self.starts[places]
        lengths = self.starts[places + 1] - starts
        ends = np.cumsum(lengths)
        ids = self.pool[np.repeat(starts - ends + lengths, lengths) + np.arange(len(places) and int(ends[-1]))]
        best = float(self.scores[places].sum())
        plans: list[tuple[float, tuple[tuple[int, int], ...]]] = [(0.0, ())]
        if self.n > 1 and len(places):
            # A plan among the n best changes only segments whose next best loses least.
            for at in sorted(self._least(self.loss[places], min(self.n - 1, len(places)))):
                options = [lost for lost, _ in self._alternatives(int(places[at]))]
                plans = sorted((p + d, (*c, (at, j)) if j else c) for p, c in plans
                               for j, d in enumerate(options))[:self.n]
        out = [(best, ids)]
        for lost, changes in plans[1:]:
            parts, done = [], 0
            for at, j in changes:
                parts += [ids[done:ends[at] - lengths[at]], np.array(self._alternatives(int(places[at]))[j][1], np.int32)]
                done = ends[at]
            out.append((best - lost, np.concatenate([*parts, ids[done:]])))
        return out

    @staticmethod
    def _least(loss: np.ndarray, k: int) -> list[int]:
        """Places of the k smallest, earlier ones first among equals."""
        cut = np.partition(loss, k - 1)[k - 1]
        below = np.flatnonzero(loss < cut)
        return [*below.tolist(), *np.flatnonzero(loss == cut)[:k - len(below)].tolist()]


@lru_cache(maxsize=4)
def _encoder(path: str, n: int) -> Encoder:
    """One per worker process: later tasks find the segments that earlier ones have scored."""
    return Encoder(path, n)


def _lists(arrays: list[np.ndarray]):
    """Arrow array of lists of ids."""
    import pyarrow as pa
    return pa.ListArray.from_arrays(np.cumsum([0, *map(len, arrays)], dtype=np.int32),
                                    np.concatenate([np.empty(0, np.int32), *arrays]).astype(np.int32))


def encode(docs: DataFrame, model: str, n: int = 1, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: key, ``ids`` of the best segmentation, ``scores`` and ``alternatives`` of the n best."""
    def run(batch):
        import pyarrow as pa
        enc = _encoder(model, n)
        found = [enc.n_best(p) for p in enc.segments(batch.column("t"))]
        others = pa.ListArray.from_arrays(np.cumsum([0, *(len(f) - 1 for f in found)], dtype=np.int32),
                                          _lists([i for f in found for _, i in f[1:]]))
        enc.trim()
        return [_lists([f[0][1] for f in found]), [[s for s, _ in f] for f in found], others]

    rows = docs.select(F.col(key), F.col(text).alias("t"))
    return map_rows(rows, run, "ids array<int>, scores array<double>, alternatives array<array<int>>", keep=[key])


def decode(encoded: DataFrame, model: str, ids: str = "ids", key: str = "doc_id") -> DataFrame:
    """key and ``text`` of the ids; null ids give null, bytes that are no UTF-8 U+FFFD."""
    def run(batch):
        vocabulary = _encoder(model, 1).vocabulary
        return [[None if i is None else vocabulary.decode(i).decode("utf-8", "replace")
                 for i in batch.column("i").to_pylist()]]

    rows = encoded.select(F.col(key), F.col(ids).alias("i"))
    return map_rows(rows, run, "text string", keep=[key])


def digest(docs: DataFrame, model: str, n: int = N_BEST, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: key, n_tokens, n best scores and unsigned crc32 of their ids (little-endian
    unsigned 32-bit), and whether decoding the best gives the text back."""
    def run(batch):
        enc = _encoder(model, n)
        tokens, scores, crcs, same = [], [], [], []
        for raw, places in zip(utf8(batch.column("t")), enc.segments(batch.column("t")), strict=True):
            found = enc.n_best(places)
            tokens.append(len(found[0][1]))
            scores.append([s for s, _ in found])
            crcs.append([zlib.crc32(i.astype("<u4")) for _, i in found])
            same.append(enc.vocabulary.decode(found[0][1].tolist()) == (raw or b""))
        enc.trim()
        return [tokens, scores, crcs, same]

    rows = docs.select(F.col(key), F.col(text).alias("t"))
    return map_rows(rows, run, "n_tokens long, scores array<double>, ids_crc32 array<long>, round_trip boolean", keep=[key])
