"""Identifier and free-text normalisation."""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

ID_WIDTH = 14

_HANGUL = range(0xAC00, 0xD7A4)
_SURROGATES = range(0xD800, 0xE000)
_MARKS = range(0x0300, 0x0370)
_LATIN_END = "\u0180"

# Conjoining letters of Hangul syllables: 19 leads, 21 vowels and 27 tails; no tail comes first.
_LEADS = "".join(map(chr, range(0x1100, 0x1113)))
_VOWELS = "".join(map(chr, range(0x1161, 0x1176)))
_TAILS = "".join(map(chr, range(0x11A8, 0x11C3)))


@lru_cache(maxsize=1)
def _decompositions() -> tuple[str, str, str, str, tuple[str, ...]]:
    """Compatibility decompositions minus the combining marks, built by rule.

    Returns (from, to, deleted, expanded, expansions): one-to-one characters
    for ``translate``, characters that vanish, and characters that become
    several.  Hangul syllables are left out; they follow a rule of their own.
    """
    one_from, one_to, gone, many, many_to = [], [], [], [], []
    for cp in range(0x80, sys.maxunicode + 1):
        if cp in _HANGUL or cp in _SURROGATES:
            continue
        ch = chr(cp)
        plain = "".join(c for c in unicodedata.normalize("NFKD", ch) if ord(c) not in _MARKS)
        if plain == ch:
            continue
        if not plain:
            gone.append(ch)
        elif len(plain) == 1:
            one_from.append(ch)
            one_to.append(plain)
        else:
            many.append(ch)
            many_to.append(plain)
    return "".join(one_from), "".join(one_to), "".join(gone), "".join(many), tuple(many_to)


def _ranges(chars: str) -> str:
    """Body of a regular-expression class, neighbouring characters merged."""
    out: list[list[int]] = []
    for cp in map(ord, chars):
        if out and cp == out[-1][1] + 1:
            out[-1][1] = cp
        else:
            out.append([cp, cp])
    return "".join(f"\\x{{{lo:x}}}-\\x{{{hi:x}}}" for lo, hi in out)


def digits_only(c: Column) -> Column:
    return F.regexp_replace(c, r"[^\p{Nd}]+", "")


def clean_id(c: Column, width: int = ID_WIDTH) -> Column:
    """Digits only, zero-padded on the left and cut to ``width``.

    A string without digits becomes all zeros; null stays null.
    """
    return F.lpad(digits_only(c), width, "0")


def clean_id_or_null(c: Column, width: int = ID_WIDTH) -> Column:
    """:func:`clean_id`, but a string without digits becomes null."""
    return F.lpad(F.nullif(digits_only(c), F.lit("")), width, "0")


def _jamo(ch: Column) -> Column:
    """Conjoining letters of a Hangul syllable, numbered by lead, vowel and tail."""
    n = F.ascii(ch) - _HANGUL.start
    tail = n % 28
    return F.concat(
        F.substring(F.lit(_LEADS), (n / 588).cast("int") + 1, F.lit(1)),
        F.substring(F.lit(_VOWELS), ((n % 588) / 28).cast("int") + 1, F.lit(1)),
        F.when(tail > 0, F.substring(F.lit(_TAILS), tail, F.lit(1))).otherwise(""),
    )


def strip_accents(c: Column) -> Column:
    """Compatibility-decompose and drop combining marks."""
    one_from, one_to, gone, many, many_to = _decompositions()
    hangul = f"[\\x{{{_HANGUL.start:x}}}-\\x{{{_HANGUL.stop - 1:x}}}]"
    expanded = F.array_join(
        F.transform(
            F.regexp_extract_all(c, F.lit("(?s)."), F.lit(0)),
            lambda ch: F.when(ch.rlike(hangul), _jamo(ch)).otherwise(
                F.coalesce(
                    F.get(F.array(*[F.lit(x) for x in many_to]), F.call_function("locate", ch, F.lit(many)) - 1),
                    ch,
                )
            ),
        ),
        "",
    )
    # Few texts hold a character that expands, so only those pay for it; the
    # short class settles plain Latin text before the long one is tried.
    latin = "".join(ch for ch in many if ch < _LATIN_END)
    may_expand = c.rlike(f"[{_ranges(latin)}\\x{{{ord(_LATIN_END):x}}}-\\x{{10ffff}}]")
    wide = F.when(may_expand & (c.rlike(hangul) | c.rlike(f"[{_ranges(many)}]")), expanded).otherwise(c)
    return F.when(c.rlike(r"[^\x00-\x7f]"), F.translate(wide, one_from + gone, one_to)).otherwise(c)


def collapse_spaces(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def normalise_text(c: Column) -> Column:
    """Accents off, whitespace runs to one blank, trimmed, lower case."""
    return F.lower(collapse_spaces(strip_accents(c)))


def text_trim(c: Column) -> Column:
    """Cast to text and strip surrounding whitespace."""
    return F.regexp_replace(c.cast("string"), r"(?U)^\s+|\s+$", "")


def label_is(c: Column, wanted: str) -> Column:
    """Trimmed, case-insensitive equality with a constant."""
    return F.lower(text_trim(c)) == F.lit(wanted.strip().lower())


def file_stem(c: Column) -> Column:
    """Lower-case file name without folder and last extension."""
    return F.lower(F.regexp_replace(F.element_at(F.split(c, "/"), -1), r"\.[^.]*$", ""))
