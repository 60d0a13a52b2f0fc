"""Operator 2: SentencePiece encoding and decoding with N-best segmentation.

Text is escaped as the model says (a space in front, spaces as U+2581) and cut where no piece of the vocabulary
can reach across: in front of a run of U+2581 and around letters that only occur alone. The lattice of a text is then a
chain of small lattices, one for each unit, and most units occur again and again.

Units new to a batch go through the lattice together: one numpy step finds the pieces of one length at all
places of all units, one step of the forward Viterbi pass moves all units on by one letter. The forward scores are the exact
heuristic of a backward A-star search that takes the segmentations of a unit from the lattice in order of their
score. A text's N best differ from its best in the N - 1 units with the least loss at most, so only those are searched.

Scores are log probabilities. A vocabulary made by merging stores ranks instead; with ``scores="rank"`` they
become log probabilities by Zipf's law, -log(rank + 1). A letter without a piece costs ``UNKNOWN`` more than the rarest
piece and is written as the pieces of its bytes.

The vocabulary (some 32,000 short strings, read on the driver from the path given) is broadcast. Nothing is
shuffled. Memory: one small batch, and at most ``KEPT`` units.

Defined cases: a null text gives null ids and an empty one no ids; ties go to the longer last piece; rows are encoded one by
one, so repeated rows and null ids give one row each; U+2581 in a text decodes to a space, which ``round_trip`` then
says; other columns are ignored.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BAR = "▁"
UNKNOWN = 10.0
KEPT = 300_000
#: Units of more letters are searched one by one.
LONG = 500
ROWS = 400
MIX = np.uint64(0x9E3779B97F4A7C15)
NONE = -1e18


def vocabulary(path: str = MODEL, scores: str = "rank") -> dict:
    """Pieces with ids and log probabilities, ids of bytes, and the unknown id, as plain data to broadcast."""
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=path)
    n = m.get_piece_size()
    normal = [i for i in range(n) if not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i) or m.is_unused(i))]
    value = (lambda i: -float(np.log(1.0 - m.get_score(i)))) if scores == "rank" else m.get_score
    return {
        "pieces": [(m.id_to_piece(i), i, value(i)) for i in normal],
        "bytes": {int(m.id_to_piece(i)[3:5], 16): i for i in range(n) if m.is_byte(i)},
        "unknown": m.unk_id(),
        "size": n,
    }


class Encoder:
    """Segmentation over one vocabulary, with a bounded store of solved units."""

    def __init__(self, vocab: dict) -> None:
        self.vocab = vocab
        self.piece = {p: (i, s) for p, i, s in vocab["pieces"]}
        self.longest = max((len(p) for p in self.piece), default=1)
        self.unknown = min((s for _, s in self.piece.values()), default=0.0) - UNKNOWN
        inside = {c for p in self.piece if len(p) > 1 for c in p} - {BAR}
        m = "".join(map(re.escape, sorted(inside)))
        self.unit = re.compile(rf"{BAR}*[{m}]+|{BAR}+|[^{m}{BAR}]" if inside else r"(?s:.)", re.S)
        self.raw = [b""] * vocab["size"]
        for p, (i, _) in self.piece.items():
            self.raw[i] = p.replace(BAR, " ").encode()
        for b, i in vocab["bytes"].items():
            self.raw[i] = bytes([b])
        prefixes = sorted({p[:k] for p in self.piece for k in range(1, len(p) + 1)})
        keys = np.array([self._key(p) for p in prefixes], np.uint64)
        order = np.argsort(keys)
        self.keys = keys[order]
        hit = [self.piece.get(prefixes[k], (-1, NONE)) for k in order]
        self.ids, self.logp = np.array([h[0] for h in hit], np.int32), np.array([h[1] for h in hit])
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[self.keys >> np.uint64(44)] = True
        self.clear()

    @staticmethod
    def _key(p: str) -> int:
        k = 0
        for c in p:
            k = ((k ^ (k >> 31)) + ord(c) + 1) * int(MIX) & (2**64 - 1)
        return k

    def clear(self) -> None:
        self.row: dict[str, int] = {}
        self.score, self.loss = np.zeros(0), np.zeros(0)
        self.starts, self.flat = np.zeros(1, np.int64), np.zeros(0, np.int32)
        self.lists: dict[str, list] = {}

    # -- lattice of many units at once --

    def _solve(self, units: list[str]) -> None:
        """Add the best segmentation, its score and the loss of the second best of each unit."""
        units.sort(key=len)
        score, loss, sizes, flat = [self.score], [self.loss], [], [self.flat]
        at = 0
        while at < len(units):
            if len(units[at]) > LONG:
                two = self.best_of(units[at], 2)
                score.append(np.array([two[0][0]]))
                loss.append(np.array([two[0][0] - two[1][0] if len(two) > 1 else -NONE]))
                sizes.append(np.array([len(two[0][1])]))
                flat.append(np.array(two[0][1], np.int32))
                at += 1
                continue
            n = len(units[at])
            end = at + 1
            while end < len(units) and len(units[end]) <= n + n // 4 and (end - at) * n < 300_000:
                end += 1
            best, lost, size, ids = self._grid(units[at:end])
            score.append(best)
            loss.append(lost)
            sizes.append(size)
            flat.append(ids)
            at = end
        for k, u in enumerate(units, len(self.row)):
            self.row[u] = k
        self.score, self.loss, self.flat = np.concatenate(score), np.concatenate(loss), np.concatenate(flat)
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(np.concatenate(sizes))])

    def _grid(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Score, loss of the second best, number of pieces and pieces of units. Arrays are laid out by place, then unit."""
        n, size = len(units), np.array([len(u) for u in units])
        wide = int(size.max())
        each = np.arange(n)
        cps = np.zeros((wide + self.longest, n), np.uint64)
        chars = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), "<u4")
        u = np.repeat(each, size)
        c = np.arange(len(chars)) - np.repeat(np.cumsum(size) - size, size)
        cps[c, u] = chars + 1
        most = min(self.longest, wide)
        logp, ids = np.full((most, wide, n), NONE), np.full((most, wide, n), -1, np.int32)
        key = np.zeros(len(u), np.uint64)
        for k in range(most):
            key = ((key ^ (key >> np.uint64(31))) + cps[c + k, u]) * MIX
            alive = self.maybe[key >> np.uint64(44)] & (c + k < size[u])
            u, c, key = u[alive], c[alive], key[alive]
            found = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            alive = self.keys[found] == key
            u, c, key, found = u[alive], c[alive], key[alive], found[alive]
            logp[k, c, u], ids[k, c, u] = self.logp[found], self.ids[found]
            if not len(u):
                most = k + 1
                break
        logp[0][(logp[0] <= NONE) & (np.arange(wide)[:, None] < size)] = self.unknown
        forward = np.full((wide + 1, n), NONE)
        forward[0] = 0
        step = np.zeros((wide + 1, n), np.int32)
        for j in range(1, wide + 1):
            for k in range(min(most, j)):
                v = forward[j - k - 1] + logp[k, j - k - 1]
                better = v >= forward[j]
                np.copyto(forward[j], v, where=better)
                np.copyto(step[j], k + 1, where=better)
        backward = np.full((wide + 1, n), NONE)
        backward[size, each] = 0
        for j in range(wide - 1, -1, -1):
            for k in range(min(most, wide - j)):
                np.maximum(backward[j], logp[k, j] + backward[j + k + 1], out=backward[j])
        best = forward[size, each]
        place, live, trail = size.copy(), each, []
        while len(live):
            k = step[place[live], live]
            a = place[live] - k
            trail.append((live, a, ids[k - 1, a, live]))
            logp[k - 1, a, live] = NONE  # what is left leads to the second best
            place[live] = a
            live = live[a > 0]
        second = np.full(n, NONE)
        for k in range(most):
            v = forward[: wide - k] + logp[k, : wide - k]
            v += backward[k + 1 :]
            np.maximum(second, v.max(axis=0), out=second)
        w, a, i = (np.concatenate(x) for x in zip(*trail, strict=True))
        order = np.lexsort((a, w))
        w, a, i = w[order], a[order], i[order]
        if (i < 0).any():
            parts = [self._fallback(units[x][y]) if z < 0 else (z,) for x, y, z in zip(w.tolist(), a.tolist(), i.tolist(), strict=True)]
            w = np.repeat(w, [len(x) for x in parts])
            i = np.array([z for x in parts for z in x], np.int32)
        return best, best - second, np.bincount(w, minlength=n), i

    def _fallback(self, ch: str) -> list[int]:
        return [self.vocab["bytes"].get(b, self.vocab["unknown"]) for b in ch.encode("utf-8", "surrogatepass")]

    # -- N best of one unit --

    def best_of(self, unit: str, n: int) -> list[tuple[float, list[int]]]:
        """The n best segmentations of a unit: forward Viterbi scores, then A-star from its end with them as the rest's exact score."""
        size = len(unit)
        arcs: list[list[tuple[int, float, int | None]]] = [[] for _ in range(size + 1)]
        forward = [0.0] + [NONE] * size
        for j in range(1, size + 1):
            for i in range(max(0, j - self.longest), j):
                hit = self.piece.get(unit[i:j])
                if hit is None and j - i == 1:
                    hit = (None, self.unknown)
                if hit is not None:
                    arcs[j].append((i, hit[1], hit[0]))
                    forward[j] = max(forward[j], forward[i] + hit[1])
        out: list[tuple[float, list[int]]] = []
        # The key is the loss against the best, which is exactly 0 along it; of equal ones the nearest to the start goes first.
        heap: list = [(0.0, size, 0, 0.0, None)]
        made = 0
        while heap and len(out) < n:
            loss, j, _, done, tail = heapq.heappop(heap)
            if j == 0:
                ids: list[int] = []
                while tail is not None:
                    i, a, tail = tail
                    ids.extend(self._fallback(unit[a]) if i is None else (i,))
                out.append((done, ids))
                continue
            for i, s, piece in arcs[j]:
                made += 1
                heapq.heappush(heap, (loss + (forward[j] - (forward[i] + s)), i, made, done + s, (piece, i, tail)))
        return out

    # -- texts --

    def units(self, text: str) -> list[str]:
        return self.unit.findall(BAR + text.replace(" ", BAR)) if text else []

    def encode(self, texts: list[str | None], n: int = 1) -> list[tuple | None]:
        """For each text (ids, score, [(score, ids) of the n best]); None for null."""
        if len(self.row) > KEPT:
            self.clear()
        cut = [None if t is None else self.units(t) for t in texts]
        fresh = {u for c in cut if c for u in c if u not in self.row}
        if fresh:
            self._solve(sorted(fresh))
        out: list[tuple | None] = []
        for c in cut:
            if c is None:
                out.append(None)
                continue
            at = np.array([self.row[u] for u in c], np.int64)
            lo, size = self.starts[at], self.starts[at + 1] - self.starts[at]
            ids = self.flat[np.repeat(lo - (np.cumsum(size) - size), size) + np.arange(size.sum())]
            score = float(self.score[at].sum())
            out.append((ids, score, self._nbest(c, at, score, ids, n)))
        return out

    def _nbest(self, c: list[str], at: np.ndarray, score: float, ids: np.ndarray, n: int) -> list[tuple[float, np.ndarray]]:
        """Scores and ids of a text's n best segmentations, which differ from the best in the n - 1 units with the least loss at most."""
        best: list[tuple[float, tuple]] = [(score, ())]
        if n > 1 and len(c):
            loss = self.loss[at]
            few = np.argpartition(loss, min(n - 1, len(loss)) - 1)[: n - 1]
            for k in few.tolist():
                if loss[k] > -NONE / 2:
                    continue
                u = c[k]
                if (u, n) not in self.lists:
                    self.lists[(u, n)] = [(s, np.array(i, np.int32)) for s, i in self.best_of(u, n)]
                own = self.lists[(u, n)]
                # other segmentations of the unit at place k; of equal scores the one with fewer of them goes first
                ways = ((s + (o - own[0][0]), (*other, (k, i)) if j else other) for s, other in best for j, (o, i) in enumerate(own))
                best = heapq.nlargest(n, ways, key=lambda w: w[0])
        if len(best) == 1:
            return [(score, ids)]
        ends = np.cumsum(self.starts[at + 1] - self.starts[at])
        out = []
        for s, other in best:
            parts, done = [], 0
            for k, i in sorted(other, key=lambda x: x[0]):
                parts += [ids[done : ends[k - 1] if k else 0], i]
                done = ends[k]
            out.append((s, np.concatenate([*parts, ids[done:]])))
        return out

    def decode(self, ids) -> str:
        """The text of piece ids: pieces' text, bytes joined, without the space put in front."""
        raw = b"".join([self.raw[i] for i in ids])
        return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "surrogatepass")


_encoders: dict[int, Encoder] = {}


def encoder_of(vocab: dict) -> Encoder:
    """The encoder of a vocabulary, built once per Python worker."""
    key = hash((vocab["size"], tuple(vocab["pieces"])))
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(vocab)
    return _encoders[key]


def listed(values: pa.Array, sizes: list[int | None]) -> pa.ListArray:
    """Lists of so many of the values each, null for None."""
    ends = np.cumsum([0, *(n or 0 for n in sizes)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values, mask=pa.array([n is None for n in sizes], pa.bool_()))


def id_lists(ids: list[np.ndarray | None]) -> pa.ListArray:
    return listed(pa.array(np.concatenate([np.zeros(0, np.int32), *(i for i in ids if i is not None)]), pa.int32()), [None if i is None else len(i) for i in ids])


def encoded(docs: DataFrame, path: str = MODEL, n: int = 3, scores: str = "rank") -> DataFrame:
    """One row per document: doc_id, ids, score, nbest (score, number of pieces and ids of the n best) and round_trip."""
    vocab = docs.sparkSession.sparkContext.broadcast(vocabulary(path, scores))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder_of(vocab.value)
        for b in batches:
            for lo in range(0, len(b), ROWS):
                part = b.slice(lo, ROWS)
                texts = part["text"].to_pylist()
                got = e.encode(texts, n)
                every = [x for g in got if g is not None for x in g[2]]
                best = pa.StructArray.from_arrays(
                    [pa.array([s for s, _ in every], pa.float64()), pa.array([len(i) for _, i in every], pa.int32()), id_lists([i for _, i in every])],
                    ["score", "pieces", "ids"],
                )
                yield pa.RecordBatch.from_pydict({
                    "doc_id": part["doc_id"],
                    "ids": id_lists([None if g is None else g[0] for g in got]),
                    "score": pa.array([None if g is None else g[1] for g in got], pa.float64()),
                    "nbest": listed(best, [None if g is None else len(g[2]) for g in got]),
                    "round_trip": pa.array([g is None or e.decode(g[0].tolist()) == t for g, t in zip(got, texts, strict=True)], pa.bool_()),
                })

    schema = f"doc_id {kind}, ids array<int>, score double, nbest array<struct<score double, pieces int, ids array<int>>>, round_trip boolean"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def decoded(encodings: DataFrame, path: str = MODEL) -> DataFrame:
    """One row per row of (doc_id, ids): doc_id and text; null ids give a null text."""
    vocab = encodings.sparkSession.sparkContext.broadcast(vocabulary(path))
    kind = encodings.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        e = encoder_of(vocab.value)
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "text": [None if i is None else e.decode(i.tolist()) for i in b["ids"]]})

    return encodings.select("doc_id", "ids").mapInPandas(run, f"doc_id {kind}, text string")
