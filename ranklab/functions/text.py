"""Text and number expressions, all built from Spark's own functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

# Fixed value: what a word is. Letters, digits and underscores, with the combining marks behind
# them; one inner sign may join letters (' . ’ : ·) or digits (. , ; ').
WORD = r"[\p{L}\p{N}_][\p{L}\p{M}\p{N}_]*(?:['.’:·][\p{L}_][\p{L}\p{M}_]*|[.,;'][\p{N}][\p{M}\p{N}]*)*"
# The same language with possessive repetition: no part of a word is ever given back.
_WORD_POSSESSIVE = r"[\p{L}\p{N}_][\p{L}\p{M}\p{N}_]*+(?:['.’:·][\p{L}_][\p{L}\p{M}_]*+|[.,;'][\p{N}][\p{M}\p{N}]*+)*+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once per row and use it many times in `body`."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def lower(text: Column) -> Column:
    return F.lower(text)


def trim_controls(text: Column) -> Column:
    """Cut blanks and control characters (up to U+0020) off both ends."""
    return F.regexp_replace(text, r"^[\x00-\x20]+|[\x00-\x20]+$", "")


def unix_lines(text: Column) -> Column:
    return F.regexp_replace(text, r"\r\n?", "\n")


def tokens(text: Column) -> Column:
    """Lower-cased words in text order. No stop list, no stemming."""
    words = F.regexp_extract_all(F.lower(text), F.lit(_WORD_POSSESSIVE), F.lit(0))
    return F.coalesce(words, F.array().cast("array<string>"))


def join_lines_space(lines: Column) -> Column:
    """Body lines, each followed by one blank."""
    return F.concat(F.array_join(lines, " "), F.lit(" "))


def join_lines_fused(lines: Column) -> Column:
    """Topic lines without any separator: the last word of a line meets the next one."""
    return F.array_join(lines, "")


def split_pick(text: Column, n: int) -> Column:
    """The n-th blank-separated part, counted from 1, or from the end when negative."""
    return F.try_element_at(F.split(text, " "), F.lit(n))


def parse_int(text: Column) -> Column:
    """The number when the whole text is one (sign allowed, blanks not), else null."""
    return F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast("int"))


def parse_double(text: Column) -> Column:
    return text.try_cast("double")


def quantize_length(length: Column) -> Column:
    """Length on a grid of four significant bits above 40; shorter ones stay exact.

    With s = floor(log2(length - 24)) - 3, all bits of length - 24 below s are dropped.
    """
    over = length.cast("int") - F.lit(24)
    bits = F.length(F.bin(over)) - F.lit(4)
    grid = F.lit(24) + F.call_function(
        "shiftleft", F.call_function("shiftright", over, bits), bits)
    return F.when(length < 40, length.cast("int")).otherwise(grid)


def float32_sum(values: Column) -> Column:
    """Sum of an array in single precision, from left to right."""
    return F.aggregate(values, F.lit(0).cast("float"),
                       lambda total, x: (total + x.cast("float")).cast("float"))


def term_runs(words: Column) -> Column:
    """Array of (term, tf) of one document: sort its words, then cut where they change.

    Stays inside the row, so counting terms per document needs no shuffle.
    """
    def cut(s: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(s) - 1),
                          lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))
        runs = let(starts, lambda b: F.transform(b, lambda first, j: F.struct(
            F.get(s, first).alias("term"),
            (F.coalesce(F.get(b, j + 1), F.size(s)) - first).alias("tf"))))
        return F.when(F.size(s) > 0, runs)

    return let(F.sort_array(words), cut)


def placed_words(words: Column) -> Column:
    """Array of (word, at) by word, then place from 0; null where there are no words.

    Sorting is most work of counting words. As a column of its own it is done by Spark's generated code, inside a
    lambda function it is interpreted word by word.
    """
    places = F.sequence(F.lit(0), F.size(words) - 1)
    return F.when(F.size(words) > 0, F.sort_array(F.arrays_zip(words.alias("word"), places.alias("at"))))


def _cut(placed: Column, body: Callable[[Callable, Callable, Column, Column], Column]) -> Column:
    """`body` of (term, positions, starts, ends): the runs of equal words begin at `starts` and stop before `ends`."""
    def runs(words: Column, at: Column) -> Column:
        def term(a: Column, z: Column) -> tuple[Column, Column]:
            return F.get(words, a).alias("term"), (z - a).alias("tf")

        def positions(a: Column, z: Column) -> Column:
            return F.transform(F.sequence(a, z - 1), lambda i: F.get(at, i)).alias("positions")

        first = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: ~F.get(words, i).eqNullSafe(F.get(words, i - 1)))
        return let(first, lambda starts: let(F.concat(F.slice(starts, 2, F.size(starts)), F.array(F.size(words))),
                                             lambda ends: body(term, positions, starts, ends)))

    return F.when(placed.isNotNull(), let(placed.getField("word"), lambda w: let(placed.getField("at"), lambda at: runs(w, at))))


def term_positions(words: Column) -> Column:
    """Array of (term, tf, positions) of one document, positions from 0, ascending."""
    return let(words, lambda w: let(placed_words(w), lambda s: _cut(s, lambda term, positions, starts, ends: F.zip_with(
        starts, ends, lambda a, z: F.struct(*term(a, z), positions(a, z))))))


def nested_terms(placed: Column) -> Column:
    """Struct of two arrays from `placed_words`: terms (term, tf), and their positions."""
    return _cut(placed, lambda term, positions, starts, ends: F.struct(
        F.zip_with(starts, ends, lambda a, z: F.struct(*term(a, z))).alias("terms"),
        F.zip_with(starts, ends, positions).alias("positions")))
