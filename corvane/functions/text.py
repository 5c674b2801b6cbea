"""Text expressions. All run inside the JVM; none needs a Python function."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.split() and str.strip() treat as white space.
SPACE = (r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
         r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")

# Markers, boilerplate and fallback of an assistant turn.
ASSISTANT_MARK = "<|im_start|>assistant"
END_MARK = "<|im_end|>"
BOILERPLATE = "Let me help you with that."
NO_ANSWER = ("I apologize, but I couldn't generate a proper response. "
             "Please try rephrasing your question.")

# Letters without a canonical decomposition, and those spelled with two letters.
_PLAIN = {"Ø": "O", "ø": "o", "Đ": "D", "đ": "d", "Ł": "L", "ł": "l", "ı": "i"}
_PAIRS = {"ß": "ss", "Æ": "AE", "æ": "ae", "Œ": "OE", "œ": "oe", "Þ": "Th", "þ": "th"}


def _accent_table() -> tuple[str, str]:
    """Accented Latin letters and their base letters, by canonical decomposition."""
    table = dict(_PLAIN)
    for code in range(0xC0, 0x250):
        base = unicodedata.normalize("NFD", chr(code))[0]
        if base != chr(code) and base.isascii():
            table[chr(code)] = base
    return "".join(table), "".join(table.values())


_ACCENTED, _BASE = _accent_table()


def strip(col: Column) -> Column:
    """Trim every kind of white space at both ends."""
    return F.regexp_replace(col, f"^{SPACE}+|{SPACE}+$", "")


def words(col: Column) -> Column:
    """White-space separated words; no empty items."""
    return F.array_remove(F.split(col, f"{SPACE}+"), "")


def token_count(col: Column) -> Column:
    return F.size(words(col))


def token_message(col: Column) -> Column:
    return F.concat(F.lit("This string has "), token_count(col).cast("string"), F.lit(" tokens."))


def clean_ws(col: Column) -> Column:
    """Runs of newlines become one newline, then other white-space runs one space."""
    return F.regexp_replace(F.regexp_replace(col, "\\n{2,}", "\n"), f"{SPACE}{{2,}}", " ")


def drop_blank_lines(col: Column) -> Column:
    """Drop lines that hold only white space and re-join the rest."""
    kept = F.filter(F.split(col, "\n"), lambda line: F.regexp_like(line, F.lit(f"[^{SPACE[1:]}")))
    return F.array_join(kept, "\n")


def head_chars(col: Column, n: int) -> Column:
    return F.substring(col, 1, n)


def strip_accents(col: Column) -> Column:
    out = F.translate(col, _ACCENTED, _BASE)
    for letter, pair in _PAIRS.items():
        out = F.replace(out, F.lit(letter), F.lit(pair))
    return out


def slug(col: Column) -> Column:
    """Display name: accents stripped, trimmed, hyphens as spaces."""
    return F.replace(strip(strip_accents(col)), F.lit("-"), F.lit(" "))


def tag(col: Column) -> Column:
    """Key of a name: its slug in lower case with hyphens for spaces."""
    return F.replace(strip(F.lower(slug(col))), F.lit(" "), F.lit("-"))


def actor_key(col: Column) -> Column:
    """Text before the first comma, lower case, underscores for spaces."""
    return F.replace(F.lower(F.substring_index(col, ",", 1)), F.lit(" "), F.lit("_"))


def zfill(col: Column, width: int) -> Column:
    """Zero-filled decimal of a non-negative integer; longer numbers stay whole."""
    digits = col.cast("string")
    return F.lpad(digits, F.greatest(F.lit(width), F.length(digits)), F.lit("0"))


def hex_id(name: Column, index: Column) -> Column:
    """Row key: name, then 0x and at least three hex digits."""
    digits = F.lower(F.hex(index.cast("bigint")))
    return F.concat(name, F.lit("0x"), F.lpad(digits, F.greatest(F.lit(3), F.length(digits)), F.lit("0")))


def strip_prefix(text: Column, prompt: Column) -> Column:
    """Drop as many characters as the prompt has, then trim."""
    return strip(F.substring(text, F.length(prompt) + 1, F.length(text)))


def remove_prompt(text: Column, prompt: Column) -> Column:
    """Drop every occurrence of the prompt, then trim."""
    return strip(F.replace(text, prompt, F.lit("")))


def extract_answer(text: Column, mark: str = ASSISTANT_MARK, end: str | None = END_MARK,
                   boilerplate: str = BOILERPLATE, default: str | None = NO_ANSWER) -> Column:
    """Text after the last mark up to the end mark; the whole text when no mark occurs."""
    tail = F.substring_index(text, mark, -1)
    if end is not None:
        tail = F.substring_index(tail, end, 1)
    body = F.when(F.contains(text, F.lit(mark)), tail).otherwise(text)
    if boilerplate:
        body = F.replace(body, F.lit(boilerplate), F.lit(""))
    body = strip(body)
    return body if default is None else F.when(body == "", F.lit(default)).otherwise(body)
