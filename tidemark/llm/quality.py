"""Operator 8: quality rules as one projection.

A table of thresholds is compiled into a single ``select``: every measure is a built-in expression over
the text, every rule a comparison of a measure with its bound. No shuffle, no user function.

Defined cases: a null text counts as empty (no words, so it fails the length rule); rows are judged one by
one, so repeated rows and null ids give one result row each; columns other than ``doc_id`` and ``text`` are
ignored whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACES, let, text_or_empty, words

# Frequent function words of the four languages.
STOP_WORDS = [
    "a", "and", "are", "as", "at", "be", "by", "for", "from", "in", "is", "it", "of", "on", "or", "that", "the",
    "this", "to", "was", "with",
    "auf", "das", "dem", "den", "der", "die", "ein", "eine", "für", "ist", "mit", "nicht", "sich", "und", "von", "zu",
    "de", "des", "dans", "du", "en", "est", "et", "la", "le", "les", "par", "pas", "pour", "que", "qui", "sur", "un",
    "une",
    "con", "del", "el", "las", "los", "no", "para", "se", "una", "y",
]


@dataclass(frozen=True)
class Rule:
    """A document passes if ``least <= measure <= most``; an open end is None."""

    measure: str
    least: float | None = None
    most: float | None = None


#: The first two rules are the base rules; the rest is the method's own verdict. They are lenient: clean prose is far inside.
BASE_RULES = (Rule("n_words", least=50), Rule("repeat_ratio", most=0.5))
RULES = (
    Rule("n_words", most=1_000_000),
    Rule("mean_word_chars", least=2, most=14),
    Rule("symbol_ratio", most=0.25),
    Rule("bar_ratio", most=0.2),
    Rule("shout_ratio", most=0.5),
    Rule("stop_ratio", least=0.03),
    Rule("dup_line_ratio", most=0.5),
    Rule("alpha_ratio", least=0.6),
)


#: Bits that hold a window's position beside the upper bits of its hash.
POSITION_BITS = 20


def _tail(a: Column) -> Column:
    return F.slice(a, 2, F.size(a))


def _neighbours(s: Column, same) -> Column:
    """Pairs (a, b) of adjacent elements of a sorted array for which ``same`` holds."""
    pairs = F.zip_with(s, _tail(s), lambda a, b: F.when(same(a, b), F.struct(a.alias("a"), b.alias("b"))))
    return F.filter(pairs, lambda x: x.isNotNull())


def _both(pairs: Column, value) -> Column:
    return F.array_distinct(F.concat(F.transform(pairs, lambda x: value(x["a"])), F.transform(pairs, lambda x: value(x["b"]))))


def _exact(h: Column, positions: Column) -> Column:
    """Those of ``positions`` whose hash occurs at another of them too, in order."""
    s = F.sort_array(F.transform(positions, lambda i: F.struct(F.get(h, i).alias("h"), i.alias("i"))))
    return let(s, lambda s: F.sort_array(let(_neighbours(s, lambda a, b: a["h"] == b["h"]), lambda z: _both(z, lambda x: x["i"]))))


def _repeated_positions(h: Column) -> Column:
    """Start positions, in order, of windows whose hash ``h`` occurs at least twice.

    Hashes are sorted as plain longs that carry the position in their low bits; neighbours that agree in the
    upper bits are then compared in full. A text of more windows than positions fit compares all in full.
    """
    low = F.lit((1 << POSITION_BITS) - 1).cast("long")
    packed = F.sort_array(F.transform(h, lambda x, i: x.bitwiseAND(F.bitwise_not(low)).bitwiseOR(i.cast("long"))))
    alike = let(packed, lambda s: _neighbours(s, lambda a, b: F.shiftright(a, POSITION_BITS) == F.shiftright(b, POSITION_BITS)))
    few = let(alike, lambda z: _both(z, lambda x: x.bitwiseAND(low).cast("int")))
    every = F.transform(h, lambda x, i: i)
    return F.when(F.size(h) <= (1 << POSITION_BITS), let(few, lambda p: _exact(h, p))).otherwise(_exact(h, every))


def n_repeat_words(w: Column) -> Column:
    """Words that lie in a 3-word window found twice or more in the text, the first occurrence included."""

    def windows(h: Column) -> Column:
        n = F.size(h)
        two = F.zip_with(F.slice(h, 1, n - 2), F.slice(h, 2, n - 2), lambda a, b: F.xxhash64(a, b))
        return F.zip_with(two, F.slice(h, 3, n), lambda p, c: F.xxhash64(p, c))

    def covered(p: Column) -> Column:
        following = F.concat(_tail(p), F.array(F.lit(2**31 - 1)))
        steps = F.zip_with(p, following, lambda a, b: F.least(b - a, F.lit(3)))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda s, x: s + x)

    hashed = F.transform(w, lambda x: F.xxhash64(x))
    positions = let(let(hashed, windows), _repeated_positions)
    zero = F.lit(0).cast("long")
    return F.when(F.size(w) >= 4, let(positions, lambda p: F.when(F.size(p) > 0, covered(p)).otherwise(zero))).otherwise(zero)


def measures(text: Column) -> dict[str, Column]:
    """Base measures over a text column; ``words`` and ``lines`` feed the ratios."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, SPACES, "")) > 0)
    return {
        "w": words(text),
        "lines": lines,
        "word_chars": F.length(F.translate(text, SPACES, "")).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long"),
        "n_alpha": F.length(F.regexp_replace(text, r"[^\p{L}]+", "")),
    }


def measured(rows: DataFrame, text: Column, *carried: str) -> DataFrame:
    """The carried columns with the counts over a text."""
    m = rows.select(*carried, *[c.alias(f"_{k}") for k, c in measures(text).items()])
    n = F.size("_w").cast("long")
    return m.select(
        *carried,
        n.alias("n_words"),
        F.col("_word_chars").alias("word_chars"),
        F.col("_n_symbols").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        n_repeat_words(F.col("_w")).alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.col("_n_alpha").alias("n_alpha"),
        F.size(F.filter("_w", lambda x: F.lower(x).isin(STOP_WORDS))).alias("n_stop"),
        F.size(F.filter("_w", lambda x: x.contains("|"))).alias("n_bars"),
        F.size(F.filter("_w", lambda x: x.endswith("!!"))).alias("n_shouts"),
    )


def _ratios() -> dict[str, Column]:
    words_ = F.greatest(F.col("n_words"), F.lit(1))
    return {
        "n_words": F.col("n_words"),
        "mean_word_chars": F.col("word_chars") / words_,
        "symbol_ratio": F.col("n_symbols") / words_,
        "repeat_ratio": F.col("n_repeat_words") / words_,
        "bar_ratio": F.col("n_bars") / words_,
        "shout_ratio": F.col("n_shouts") / words_,
        "stop_ratio": F.col("n_stop") / words_,
        "dup_line_ratio": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "alpha_ratio": F.col("n_alpha") / F.greatest(F.col("word_chars"), F.lit(1)),
    }


def failed(table: tuple[Rule, ...]) -> Column:
    """Whether any rule of the table fails, over the columns of ``measured``."""
    ratio, out = _ratios(), F.lit(False)
    for r in table:
        if r.least is not None:
            out = out | (ratio[r.measure] < F.lit(r.least))
        if r.most is not None:
            out = out | (ratio[r.measure] > F.lit(r.most))
    return out


def quality(docs: DataFrame, rules: tuple[Rule, ...] = RULES, base_rules: tuple[Rule, ...] = BASE_RULES) -> DataFrame:
    """One row per document: the measures, ``base_failed`` and ``kept``.

    ``n_repeat_words`` compares 64-bit hashes of 3-word windows inside one document.
    """
    counted = measured(docs.select("doc_id", "text"), text_or_empty(), "doc_id")
    base = failed(base_rules)
    return counted.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), (~base & ~failed(rules)).alias("kept"),
        *[F.round(v, 6).alias(k) for k, v in _ratios().items() if k in ("symbol_ratio", "stop_ratio", "dup_line_ratio", "alpha_ratio")],
    )


def kept_rows(docs: DataFrame, columns: list[str], rules: tuple[Rule, ...] = RULES, base_rules: tuple[Rule, ...] = BASE_RULES) -> DataFrame:
    """The named columns of the documents that pass all rules, without a join: rows are filtered where they are read."""
    carried = docs.select(F.struct(*columns).alias("_row"))
    counted = measured(carried, F.coalesce(F.col("_row.text"), F.lit("")), "_row")
    return counted.filter(~failed(base_rules) & ~failed(rules)).select("_row.*")
