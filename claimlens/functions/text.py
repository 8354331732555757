"""Text expressions that reproduce Python string semantics inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The characters Python's str.strip() removes (str.isspace(): Unicode
# White_Space plus U+001C..U+001F), derived from Python's own definition.
PY_WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())

SENTENCE_DELIMS = r"[.!?]+"


def py_strip(c: Column) -> Column:
    """``str.strip()``: Spark's ``trim`` with Python's whitespace set (plain
    ``trim`` only removes U+0020); native and codegen'd, no regex."""
    return F.trim(c, F.lit(PY_WHITESPACE))


def alternation(words, flags: str = "iU") -> str:
    """Regex ``w1|w2|...`` with inline flags (Python ``re.IGNORECASE`` on str
    patterns = Unicode case folding and Unicode \\d/\\w/\\b = ``(?iU)`` in Java)."""
    return f"(?{flags})" + "|".join(words)


def grouped_alternation(patterns, flags: str = "iU") -> str:
    return f"(?{flags})" + "|".join(f"(?:{p})" for p in patterns)


def has_digit(c: Column) -> Column:
    """``bool(re.search(r'\\d+', s))`` with Unicode digits."""
    return F.coalesce(c.rlike(r"(?U)\d"), F.lit(False))


def sentences(c: Column) -> Column:
    """``re.split(r'[.!?]+', s)`` — keeps empty pieces, like Python."""
    return F.split(c, SENTENCE_DELIMS)


def empty_string_array() -> Column:
    return F.array().cast("array<string>")


# Characters outside ASCII that Python's case-insensitive matching equates
# with an ASCII letter: U+0130 and U+0131 with "i", U+017F with "s" (the Kelvin
# sign U+212A already lower-cases to "k").
_FOLD_FROM, _FOLD_TO = "İıſ", "iis"
_REGEX_META = set(".^$*+?{}[]\\|()")


def ascii_fold(c: Column, low: Column | None = None) -> Column:
    """Lower-cased text in which an ASCII word occurs exactly when Python's
    ``re.search(word, text, re.IGNORECASE)`` finds it.  ASCII text, most often,
    is only lower-cased (``low``, where the caller has that as a column)."""
    ascii_only = F.octet_length(c) == F.char_length(c)
    return F.when(ascii_only, F.lower(c) if low is None else low).otherwise(F.lower(F.translate(c, _FOLD_FROM, _FOLD_TO)))


def required(pattern: str) -> tuple[str, bool]:
    """What every match of a regex holds, as far as it is plain to see: its
    longest ASCII literal outside groups (lower-case), and whether a digit
    (``\\d``).  ``("", False)`` where the syntax is beyond this reading."""
    runs, run, digit, depth, i = [], "", False, 0, 0
    if "(?" in pattern.replace("(?:", "("):
        return "", False
    while i < len(pattern):
        c, i = pattern[i], i + 1
        if c == "\\":
            if i == len(pattern) or (pattern[i].isalnum() and pattern[i] not in "bBdDsSwW"):
                return "", False
            digit = digit or (depth == 0 and pattern[i] == "d" and pattern[i + 1:i + 2] not in ("?", "*", "{"))
            c, i = "", i + 1
        elif c == "[":
            end = pattern.find("]", i + 1)
            if end < 0 or "[" in pattern[i:end] or "\\" in pattern[i:end] or "&&" in pattern[i:end]:
                return "", False
            c, i = "", end + 1
        elif c == "{":
            c, i = "?", pattern.find("}", i) + 1
            if not i:
                return "", False
        depth += (c == "(") - (c == ")")
        if c == "|" and depth == 0:
            return "", False
        if depth == 0 and c and c.isascii() and c not in _REGEX_META:
            run += c
            continue
        runs.append(run[:-1] if c and c in "?*" else run)
        run = ""
    return max([*runs, run], key=len).lower(), digit


def pattern_predicate(text: Column, patterns, folded: Column) -> Column:
    """``re.search('|'.join(patterns), text, re.IGNORECASE)``, as a boolean column
    that is null for a null text: plain ASCII patterns are substring tests on the
    folded text, and the others regexes tried only where ``required`` allows it."""
    pred = None
    for pattern in patterns:
        if pattern and pattern.isascii() and not set(pattern) & _REGEX_META:
            p = folded.contains(pattern.lower())
        else:
            literal, digit = required(pattern)
            p = text.rlike(grouped_alternation([pattern]))
            p = has_digit(text) & p if digit else p
            p = folded.contains(literal) & p if literal else p
        pred = p if pred is None else pred | p
    return text.rlike(grouped_alternation(patterns)) if pred is None else pred


def keyword_predicate(text: Column, words, folded: Column | None = None) -> Column:
    """``re.search('|'.join(words), text, re.IGNORECASE)`` as a boolean column.

    Plain ASCII words become ``contains`` tests on the folded text (a fast
    substring scan instead of an N-way case-insensitive regex alternation at
    every position); words with regex syntax stay one ``(?iU)`` regex."""
    plain = [w for w in words if w.isascii() and not (set(w) & _REGEX_META)]
    regex = [w for w in words if w not in plain]
    f = ascii_fold(text) if folded is None else folded
    pred = None
    for w in plain:
        p = f.contains(w.lower())
        pred = p if pred is None else pred | p
    if regex:
        p = text.rlike(alternation(regex))
        pred = p if pred is None else pred | p
    return F.coalesce(pred, F.lit(False)) if pred is not None else F.lit(False)


def zero_pad(n: Column, width: int) -> Column:
    """``'%0{width}d' % n`` for non-negative integers without ``String.format``
    (``lpad`` alone would cut numbers wider than the field)."""
    s = n.cast("string")
    return F.when(F.length(s) >= width, s).otherwise(F.lpad(s, width, "0"))
