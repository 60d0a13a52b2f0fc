"""Operator 7: language identification by cross-parsing entropy.

For each language a suffix automaton of a bounded sample of labelled text knows all its substrings. A text is
parsed greedily into the longest phrases that occur in the sample: the automaton is walked letter by letter, and where
no transition exists a phrase ends and the walk starts again at the root. The language whose automaton needs
fewest phrases, weighted by the logarithm of the sample's length (the cost of pointing into it), wins.

All texts of a batch are walked in step: one numpy operation moves every text through every automaton by one letter. Once
few texts are left, the rest of each is walked alone from the states that it has reached, so that a text of any length is
parsed as a whole. What is broadcast is the sample, at most ``SAMPLE`` letters per language.

The sample is drawn from distinct texts: of a text longer than ``STRETCH`` letters one stretch of that many, which starts
at a place given by the text's hash. So copies count once, and a language with long, short or copied texts only is learned too.

Defined cases: a null text or one without a letter (digits and numerals are none) is ``und`` with score 0, as is every text if
nothing can be learned from; combining marks belong to the letter before them; ties go to the alphabetically first
language; repeated rows are judged one by one; rows with a null id are judged, and learned from only if ``teach`` is true
for them; other columns are ignored.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Letters of labelled text per language: the bound of the training sample; and letters of one text in it at most.
SAMPLE, STRETCH = 40_000, 5_000
#: Texts still being walked below which each is walked alone, and letters that are laid out for one walk in step.
FEW, LAID_OUT = 48, 4_000_000
LETTER = r"\p{L}"
NOT_LETTERS = regex.compile(r"[^\p{L}\p{M}]+")


def plain(text: str | None) -> str:
    """Lower-case letters with single spaces between runs of them; empty if there is no letter."""
    out = NOT_LETTERS.sub(" ", (text or "").lower()).strip()
    return out if regex.search(LETTER, out) else ""


@cache
def kinds() -> np.ndarray:
    """For each code point 2 for a letter, 1 for a mark, 0 for others."""
    return np.array([{"L": 2, "M": 1}.get(unicodedata.category(chr(c))[0], 0) for c in range(0x110000)], np.int8)


def automaton(codes: list[int], width: int) -> np.ndarray:
    """Dense transitions (states, width) of the suffix automaton of a text; -1 where there is none."""
    size = 2 * len(codes) + 2
    moves = np.full((size, width), -1, np.int32)
    length, link = [0] * size, [-1] * size
    after: list[dict[int, int]] = [{}]
    last, count = 0, 1
    for c in codes:
        now = count
        count += 1
        length[now] = length[last] + 1
        after.append({})
        p = last
        while p >= 0 and c not in after[p]:
            after[p][c] = now
            p = link[p]
        if p < 0:
            link[now] = 0
        else:
            q = after[p][c]
            if length[p] + 1 == length[q]:
                link[now] = q
            else:
                twin = count
                count += 1
                length[twin] = length[p] + 1
                after.append(after[q].copy())
                link[twin] = link[q]
                link[q] = link[now] = twin
                while p >= 0 and after[p].get(c) == q:
                    after[p][c] = twin
                    p = link[p]
        last = now
    for state, row in enumerate(after):
        for c, to in row.items():
            moves[state, c] = to
    return moves[:count]


class Parser:
    """Automata of all languages in one table, and texts walked through them in step."""

    def __init__(self, samples: list[tuple[str, str]]) -> None:
        self.langs = [k for k, _ in samples]
        alphabet = sorted(set("".join(t for _, t in samples)) - {" "})
        self.code = np.where(kinds() > 0, 1, 0).astype(np.int16)  # 0: space, 1: unknown
        for i, ch in enumerate(alphabet):
            self.code[ord(ch)] = i + 2
        self.width = len(alphabet) + 2
        parts, roots, at = [], [], 0
        for _, t in samples:
            m = automaton(self.code[_points(t)].tolist(), self.width)
            parts.append(np.where(m >= 0, m + at, -1).astype(np.int32))
            roots.append(at)
            at += len(m)
        self.moves = np.concatenate(parts).ravel()
        self.roots = np.array(roots, np.int32)[:, None]
        first = self.moves.reshape(-1, self.width)[self.roots[:, 0]]
        self.first = np.where(first >= 0, first, self.roots).astype(np.int32)
        self.cost = np.array([np.log2(max(2, len(t))) for _, t in samples])

    def encode(self, text: str | None) -> np.ndarray:
        """Codes of a text's letters and of single spaces between runs of them; none if there is no letter."""
        points = _points((text or "").lower())
        if not (kinds()[points] == 2).any():
            return np.zeros(0, np.int16)
        c = self.code[points]
        c = c[(c > 0) | np.concatenate([[False], c[:-1] > 0])]
        return c[:-1] if c[-1] == 0 else c

    def phrases(self, codes: list[np.ndarray]) -> np.ndarray:
        """Phrases per language and text."""
        out = np.zeros((len(self.langs), len(codes)), np.int64)
        order = sorted((k for k in range(len(codes)) if len(codes[k])), key=lambda k: -len(codes[k]))
        at = 0
        while at < len(order):
            end, size = at + 1, len(codes[order[at]])
            while end < len(order) and size + len(codes[order[end]]) <= LAID_OUT:
                size += len(codes[order[end]])
                end += 1
            lanes = order[at:end]
            out[:, lanes] = self._walk([codes[k] for k in lanes])
            at = end
        return out

    def _walk(self, codes: list[np.ndarray]) -> np.ndarray:
        """Phrases per language of texts in descending order of length, none of them empty."""
        sizes = np.array([len(c) for c in codes])
        steps = int(sizes[FEW - 1]) if len(codes) >= FEW else 0  # as long as FEW texts go on
        active = np.searchsorted(-sizes, -np.arange(steps), side="left")
        begin = np.concatenate([[0], np.cumsum(active)])
        laid = np.zeros(begin[-1], np.int32)
        for j, c in enumerate(codes):
            n = min(len(c), steps)
            laid[begin[:n] + j] = c[:n]
        state = np.repeat(self.roots, len(codes), axis=1)
        found = np.ones((len(self.langs), len(codes)), np.int64)
        for t in range(steps):
            n = active[t]
            c = laid[begin[t] : begin[t + 1]]
            to = self.moves[state[:, :n] * self.width + c]
            none = to < 0
            found[:, :n] += none
            state[:, :n] = np.where(none, self.first[:, c], to)
        moves, width = memoryview(self.moves), self.width
        for j in range(int(np.searchsorted(-sizes, -steps, side="left"))):
            rest = codes[j][steps:].tolist()
            for k in range(len(self.langs)):
                now, more, first = int(state[k, j]), 0, self.first[k].tolist()
                for c in rest:
                    now = moves[now * width + c]
                    if now < 0:
                        more += 1
                        now = first[c]
                found[k, j] += more
        return found

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        codes = [self.encode(t) for t in texts]
        bits = self.phrases(codes) * self.cost[:, None]
        best = bits.argmin(axis=0)
        low = np.sort(bits, axis=0)
        score = np.where(low[0] > 0, 1 - low[0] / np.maximum(low[min(1, len(low) - 1)], 1e-9), 0.0) if len(low) > 1 else np.ones(len(texts))
        known = np.array([len(c) > 0 for c in codes], bool)
        return [self.langs[b] if k else "und" for b, k in zip(best, known, strict=True)], np.where(known, score, 0.0)


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


_parsers: dict[int, Parser] = {}


def parser_of(samples: list[tuple[str, str]]) -> Parser:
    """The parser of the samples, built once per Python worker."""
    key = hash(tuple(samples))
    if key not in _parsers:
        _parsers.clear()
        _parsers[key] = Parser(samples)
    return _parsers[key]


def samples_of(docs: DataFrame, teach: Column, sample: int = SAMPLE, stretch: int = STRETCH) -> list[tuple[str, str]]:
    """(lang, text) of at most ``sample`` letters per language, from distinct texts in the order of their hash.

    An aggregate over the texts' hashes measures the distinct text of each language; then texts whose hash lies below a
    share of the range are gathered, four times the sample on average, and each language keeps those of least hash.
    """
    n = F.length("text")
    own = docs.filter(teach & F.col("lang").isNotNull() & F.col("text").rlike(LETTER)).select("lang", "text", F.least(n, F.lit(stretch)).alias("n"), F.xxhash64("text").alias("h"))
    total = own.groupBy("lang", "h").agg(F.max("n").alias("n")).groupBy("lang").agg(F.sum("n").alias("total"))
    share = (F.col("h").cast("double") / F.lit(2.0**64) + 0.5) < 4.0 * sample / F.col("total")
    part = F.substring("text", F.pmod(F.xxhash64("h"), F.greatest(n - stretch, F.lit(0)) + 1).cast("int") + 1, F.lit(stretch))
    some = own.join(F.broadcast(total), "lang").filter(share).select("lang", "h", part.alias("text"))  # total: one row per language
    some = some.groupBy("lang", "h").agg(F.max("text").alias("text"))

    def cut(g: pd.DataFrame) -> pd.DataFrame:
        out, size = [], 0
        for t in g.sort_values(["h", "text"])["text"]:
            t = plain(t)[: sample - size]
            if t:
                out.append(t)
                size += len(t) + 1
            if size >= sample:
                break
        return pd.DataFrame({"lang": [g["lang"].iloc[0]], "sample": [" ".join(out)]})

    rows = some.groupBy("lang").applyInPandas(cut, "lang string, sample string").collect()
    return sorted((r["lang"], r["sample"]) for r in rows if r["sample"])


def language(docs: DataFrame, teach: Column, sample: int = SAMPLE, stretch: int = STRETCH) -> DataFrame:
    """One row per document: doc_id, lang_pred and score; ``teach`` says which rows may be learned from."""
    samples = samples_of(docs, teach, sample, stretch)
    shared = docs.sparkSession.sparkContext.broadcast(samples)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parser = parser_of(shared.value) if shared.value else None
        for b in batches:
            for at in range(0, len(b), 2000):
                part = b.iloc[at : at + 2000]
                langs, score = parser.predict(part["text"].tolist()) if parser else (["und"] * len(part), np.zeros(len(part)))
                yield pd.DataFrame({"doc_id": part["doc_id"], "lang_pred": langs, "score": score})

    return docs.select("doc_id", "text").mapInPandas(run, f"doc_id {kind}, lang_pred string, score double")
