"""Operator 12: alignment of a byte-level vocabulary (A) and a piece vocabulary (B) over the same texts.

Documents are shuffled by their full text, so that each distinct text is tokenised and aligned once, with the number of its
copies as weight. A's tokens are those of a space and the text, B's those of the text, to which B adds the space. Places where tokens
of both end cut them into groups; a link is a pair of occurrences whose byte ranges overlap, so a text has as many links
as there are distinct ends. The table of distinct texts holds each text's measures and its linked id pairs with their
number. Spark sums those, weighted, to corpus-wide counts. The ``COMMON`` most frequent pairs are broadcast to the
texts' pairs; what is left, pairs of few links each, meets its counts by a shuffle. Measures go back to documents by
the SHA-256 of their text.

Inside a task, a text is cut in front of single spaces between two letters or signs, where neither vocabulary can reach across
(checked when the vocabularies are read, else texts stay whole), and a bounded store keeps the tokens, links and digest
text of the pieces between cuts. What is stored are results of the tokenizers' own libraries.

Defined cases: null and empty texts, and texts whose tokens of A or B don't spell the space and the text (such as U+2581,
which B reads as a space), have no tokens: zeros and an empty digest. Each row gives a row, null and repeated ids too. Other columns are
ignored. Strings of special tokens are plain text.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import forget, stored

BYTE_LEVEL = "/opt/tokenizers/byte_bpe_50k.json"
PIECES = "/opt/tokenizers/piece_bpe_32k.model"
#: Bound of the broadcast pairs.
COMMON = 1 << 18
#: Bound of the stored pieces of text, and of the letters of one of them.
KEPT, LONG = 400_000, 200
ROWS = 500
BAR = "▁"
#: A space at an end or beside white space; in other texts every space is a cut.
_ODD = re.compile(r"\A\s|\s\Z| \s|\s ")
_CUT = re.compile(r"(?<=\S) (?=\S)")


def byte_of_letter() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable ones for themselves, the rest from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Aligner:
    """Tokens of both vocabularies for many texts, with a bounded store of solved pieces of text."""

    def __init__(self, byte_level: str = BYTE_LEVEL, pieces: str = PIECES) -> None:
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_level)
        self.a.encode_special_tokens = True
        self.fast = self._fast(byte_level)
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        letters, names = byte_of_letter(), {i: t for t, i in self.a.get_vocab().items()}
        spell = lambda t: bytes(letters[c] for c in t) if all(c in letters for c in t) else t.encode()
        raw_a = [spell(names.get(i, "")) for i in range(max(names) + 1)]
        named = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        raw_b = [bytes([int(t[3:5], 16)]) if self.b.is_byte(i) else t.replace(BAR, " ").encode() for i, t in enumerate(named)]
        self.raw_a, self.raw_b = raw_a, raw_b
        self.size_a, self.size_b = np.array([len(x) for x in raw_a]), np.array([len(x) for x in raw_b])
        whole = any(BAR in t.lstrip(BAR) for t in named) or any(re.search(r"\S ", x.decode("utf-8", "ignore")) for x in raw_a)
        self.cuts = not whole
        self.clear()

    def _fast(self, path: str):
        """The same vocabulary in tiktoken, where the file holds its merges in order of their ids; else None."""
        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        letters = byte_of_letter()
        special = {t.content for t in self.a.get_added_tokens_decoder().values()}
        ranks = {bytes(letters[c] for c in t): i for t, i in model["vocab"].items() if t not in special}
        merges = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        if [model["vocab"][m] for m in merges] != list(range(256, 256 + len(merges))):
            return None
        return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def tokens_a(self, texts: list[str]) -> list[list[int]]:
        if self.fast:
            return [self.fast.encode_ordinary(t) for t in texts]
        return [e.ids for e in self.a.encode_batch(texts, add_special_tokens=False)]

    def tokens_b(self, texts: list[str]) -> list[list[int]]:
        return self.b.encode(texts, num_threads=1)

    def clear(self) -> None:
        self.row: dict[str, int] = {}
        self.counts, self.wrong = np.zeros((0, 4), np.int64), np.zeros(0, bool)
        self.links, self.starts = np.zeros(0, np.int64), np.zeros(1, np.int64)
        self.digest: list[bytes] = []

    def cut(self, text: str) -> list[str]:
        """Pieces of a text that is preceded by a space, each without the space in front of it."""
        if not self.cuts:
            return [text]
        return _CUT.split(text) if _ODD.search(text) else text.split(" ")

    def _wrong(self, pieces: list[str], a: list[list[int]], b: list[list[int]]) -> np.ndarray:
        """Pieces that the tokens of A or of B don't spell."""
        want = [f" {p}".encode("utf-8", "surrogatepass") for p in pieces]
        all_a, all_b = (b"".join([raw[i] for ids in tokens for i in ids]) for raw, tokens in ((self.raw_a, a), (self.raw_b, b)))
        size = [len(w) for w in want]
        right = b"".join(want)
        if all_a == right == all_b and all(size == _sums(tokens, n).tolist() for tokens, n in ((a, self.size_a), (b, self.size_b))):
            return np.zeros(len(pieces), bool)
        return np.array([b"".join([self.raw_a[i] for i in x]) != w or b"".join([self.raw_b[i] for i in y]) != w for x, y, w in zip(a, b, want, strict=True)])

    def _solve(self, pieces: list[str]) -> None:
        """Tokenise and align pieces of text together."""
        if not pieces:
            return
        a, b = self.tokens_a([f" {p}" for p in pieces]), self.tokens_b(pieces)
        wrong = self._wrong(pieces, a, b)
        if wrong.any():
            a, b = ([[] if w else x for x, w in zip(tokens, wrong.tolist(), strict=True)] for tokens in (a, b))
        flat = [np.fromiter(itertools.chain.from_iterable(x), np.int64) for x in (a, b)]
        n_a, n_b = (np.array([len(x) for x in tokens], np.int64) for tokens in (a, b))
        links, link_end, group_end, text, text_end = aligned(*flat, self.size_a[flat[0]], self.size_b[flat[1]])
        piece_end = np.cumsum(_sums(a, self.size_a))
        n_links = np.diff(np.searchsorted(link_end, piece_end, "right"), prepend=0)
        groups = np.searchsorted(group_end, piece_end, "right")
        cut = np.append(0, text_end)[groups].tolist()
        self.digest += [text[x : max(x, y - 1)] for x, y in zip([0, *cut], cut, strict=False)]
        self.row.update(zip(pieces, range(len(self.row), len(self.row) + len(pieces)), strict=True))
        self.counts = np.concatenate([self.counts, np.stack([n_a, n_b, np.diff(groups, prepend=0), n_links], 1)])
        self.wrong = np.concatenate([self.wrong, wrong])
        self.links = np.concatenate([self.links, links])
        self.starts = np.append(self.starts, self.starts[-1] + np.cumsum(n_links))

    def measure(self, texts: list[str]) -> list[tuple]:
        """For each text n_a, n_b, n_groups, n_links, groups_sha256, its id pairs (a * 2**32 + b) and the links of each."""
        if len(self.row) > KEPT:
            self.clear()
        cut = [self.cut(t) for t in texts]
        fresh = sorted({p for c in cut for p in c if p not in self.row})
        self._solve(fresh)
        out = []
        for c in cut:
            at = np.array([self.row[p] for p in c])
            if self.wrong[at].any():
                out.append((0, 0, 0, 0, "", at[:0], at[:0]))
                continue
            counts = self.counts[at]
            n = counts[:, 3]
            links = self.links[np.repeat(self.starts[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
            links.sort()
            first = np.flatnonzero(np.diff(links, prepend=-1))
            pair, times = links[first], np.diff(first, append=len(links))
            sha = hashlib.sha256(b";".join([self.digest[k] for k in at.tolist()])).hexdigest()
            out.append((*counts.sum(axis=0).tolist(), sha, pair, times))
        if any(len(p) > LONG for p in fresh):
            self.clear()
        return out


def _sums(tokens: list[list[int]], size: np.ndarray) -> np.ndarray:
    """Bytes of the tokens of each piece."""
    n = np.array([len(x) for x in tokens], np.int64)
    total = np.append(0, np.cumsum(size[np.fromiter(itertools.chain.from_iterable(tokens), np.int64)]))
    end = np.cumsum(n)
    return total[end] - total[end - n]


def _decimal(ids: np.ndarray, separators: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Ids written one after another with a separator behind each, and where each ends."""
    wide = max(1, len(str(int(ids.max(initial=0)))))
    digits = ids[:, None] // 10 ** np.arange(wide - 1, -1, -1) % 10
    first = wide - 1 - np.floor(np.log10(np.maximum(ids, 1)) + 1e-9).astype(np.int64)
    out = np.empty((len(ids), wide + 1), np.uint8)
    out[:, :wide] = digits + ord("0")
    out[:, wide] = separators
    return out[np.arange(wide + 1) >= first[:, None]].tobytes(), np.cumsum(wide + 1 - first)


def aligned(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, bytes, np.ndarray]:
    """Links (a * 2**32 + b) with their ends, ends of groups, and the groups' text with its end at each group, of tokens with the same bytes in all."""
    end_a, end_b = np.cumsum(size_a), np.cumsum(size_b)
    ends = np.sort(np.concatenate([end_a, end_b]), kind="stable")  # two sorted runs
    again = np.diff(ends, prepend=0) == 0
    both, ends = ends[again], ends[~again]
    links = (a[np.searchsorted(end_a, ends)] << 32) | b[np.searchsorted(end_b, ends)] if len(a) else a
    part = np.concatenate([2 * np.searchsorted(both, end_a), 2 * np.searchsorted(both, end_b) + 1])
    order = np.argsort(part, kind="stable")
    part = part[order]
    step = np.diff(part, append=-1)
    last = part[-1:] // 2 if len(part) else part
    separators = np.where(step == 0, ord(","), np.where((part & 1 == 0) & (step == 1), ord("|"), ord(";")))
    text, token_end = _decimal(np.concatenate([a, b])[order], separators)
    group = np.flatnonzero((part & 1 == 1) & (step != 0))
    assert len(group) == len(both) and (not len(last) or last[0] == len(both) - 1)
    return links, ends, both, text, token_end[group]


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner_of(byte_level: str, pieces: str) -> Aligner:
    """The aligner of two vocabulary files, built once per Python worker."""
    key = (byte_level, pieces)
    if key not in _aligners:
        _aligners.clear()
        _aligners[key] = Aligner(*key)
    return _aligners[key]


MEASURES = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


def distinct_texts(docs: DataFrame, byte_level: str = BYTE_LEVEL, pieces: str = PIECES) -> DataFrame:
    """Each distinct text that isn't empty: key (SHA-256 of the text), copies, measures, pairs (a, b and links of each)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = aligner_of(byte_level, pieces)
        for batch in batches:
            for lo in range(0, len(batch), ROWS):
                b = batch.iloc[lo : lo + ROWS]
                got = own.measure(b["text"].tolist())
                cols = list(zip(*got, strict=True))
                yield pd.DataFrame({"key": b["key"], "copies": b["copies"], "n_a": cols[0], "n_b": cols[1], "n_groups": cols[2], "n_links": cols[3], "groups_sha256": cols[4], "pair": cols[5], "times": cols[6]})

    texts = docs.filter("text <> ''").groupBy("text").agg(F.count("*").alias("copies"))
    return texts.select(F.unhex(F.sha2("text", 256)).alias("key"), "copies", "text").mapInPandas(run, f"key binary, copies long, {MEASURES}, pair array<long>, times array<long>")


def pair_counts(texts: DataFrame) -> DataFrame:
    """Links of each id pair in the corpus: pair, count, and best (whether it is the highest of its B id)."""
    pairs = texts.select("copies", F.explode(F.arrays_zip("pair", "times")).alias("x")).groupBy("x.pair").agg(F.sum(F.col("x.times") * F.col("copies")).alias("count"))
    pairs = stored(pairs, "align-pairs")
    b = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
    highest = pairs.groupBy(b.alias("b")).agg(F.max("count").alias("highest"))  # a row for each id of B
    return pairs.withColumn("b", b).join(highest, "b").select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))


def cross_alignment(docs: DataFrame, byte_level: str = BYTE_LEVEL, pieces: str = PIECES, common: int = COMMON) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    docs = docs.select("doc_id", "text")
    texts = stored(distinct_texts(docs, byte_level, pieces), "align-texts")
    counts = stored(pair_counts(texts), "align-counts")
    # at most ``common`` rows of two numbers and a flag; pairs beyond have at most 1 / common of all links each, so none is hot in the shuffle
    most = F.broadcast(counts.orderBy(F.desc("count"), "pair").limit(common))
    met = texts.select("key", F.explode(F.arrays_zip("pair", "times")).alias("x")).select("key", "x.pair", "x.times").join(most, "pair", "left")
    sums = [F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("count") * F.col("times")).alias("count_sum")]
    rest = F.when(F.col("count").isNull(), F.col("pair"))
    first = stored(met.groupBy("key", rest.alias("pair")).agg(*sums, F.sum("times").alias("times")), "align-sums")
    left = first.filter("pair IS NOT NULL").select("key", "pair", "times").join(counts, "pair").groupBy("key").agg(*sums)
    total = first.filter("pair IS NULL").select("key", "n_best", "count_sum").unionAll(left).groupBy("key").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    measures = stored(texts.drop("pair", "times", "copies").join(total, "key", "left"), "align-measures")
    forget(texts, first, counts)
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    keyed = docs.select("doc_id", F.when(F.col("text") != "", F.unhex(F.sha2("text", 256))).alias("key"))
    # texts without a key stay out of the join, so that they don't meet in one task
    cols = ["doc_id", *map(zero, ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")), F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256")]
    found = keyed.filter("key IS NOT NULL").join(measures, "key", "left").select(cols)
    none = keyed.filter("key IS NULL").select("doc_id", *[F.lit(0).cast("long").alias(c) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")], F.lit("").alias("groups_sha256"))
    return found.unionAll(none)
