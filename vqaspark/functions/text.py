"""String expressions: normalisation, cleaning, previews, tokenisation.

All of these build Column expressions, so they stay inside whole-stage
codegen; nothing here calls Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's ``str.strip()``/``str.split()`` treat
# as whitespace (``str.isspace``), written as one regex character class.
# Java's ``\s`` misses U+001C..U+001F and needs (?U) for the rest, and
# ``trim`` only removes U+0020, so we spell the set out.
PY_WHITESPACE_CLASS = (
    "[\\t\\n\\x0b\\x0c\\r\\x1c-\\x1f \\x85\\xa0\\x{1680}\\x{2000}-\\x{200a}"
    "\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"
)

# The same set as code points (for Python-side helpers and SQL generation).
PY_WHITESPACE_CODEPOINTS = (
    [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x20, 0x85, 0xA0, 0x1680]
    + list(range(0x2000, 0x200B))
    + [0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


PY_WHITESPACE = "".join(chr(cp) for cp in PY_WHITESPACE_CODEPOINTS)


def py_strip(c) -> Column:
    """Python ``str.strip()`` semantics (all Unicode whitespace, both ends):
    ``trim(BOTH <set> FROM s)``, code-generated, no regex."""
    return F.trim(_c(c), F.lit(PY_WHITESPACE))


def normalize_answer(c) -> Column:
    """``str(x).strip().lower()``; NULL stays NULL."""
    return F.lower(py_strip(c))


def clean_text(c, lowercase: bool = False, remove_special: bool = False) -> Column:
    """Optional lower-casing and removal of characters that are neither
    letters, digits nor whitespace.  Diacritics are letters, so they stay."""
    out = _c(c)
    if remove_special:
        # every whitespace character Python knows stays, not only ASCII ones
        out = F.regexp_replace(out, "[^\\p{L}\\p{N}\\p{M}" + PY_WHITESPACE_CLASS[1:-1] + "]", "")
    if lowercase:
        out = F.lower(out)
    return out


def preview(c, width: int = 100) -> Column:
    """Values longer than ``width`` characters are cut and get ``...``."""
    s = _c(c).cast("string")
    return F.when(F.char_length(s) > width,
                  F.concat(F.substring(s, 1, width), F.lit("..."))).otherwise(s)


def word_count(c) -> Column:
    """Number of whitespace-separated words (Python ``len(s.split())``)."""
    ws = PY_WHITESPACE_CLASS
    return F.size(F.filter(F.split(_c(c), f"{ws}+"), lambda t: t != ""))


def split_words(c) -> Column:
    """Python ``s.split()`` as an array (empty strings dropped)."""
    ws = PY_WHITESPACE_CLASS
    return F.filter(F.split(_c(c), f"{ws}+"), lambda t: t != "")


def ascii_tokens(c) -> Column:
    """ROUGE-compatible tokens: lower, every run of characters outside
    ``[a-z0-9]`` becomes a separator.  Cuts words at diacritics, exactly like
    the scorer the reference calls."""
    return F.regexp_extract_all(F.lower(_c(c)), F.lit("[a-z0-9]+"), 0)


def unicode_tokens(c) -> Column:
    """Lower-cased runs of letters/digits (keeps Vietnamese words whole)."""
    return F.regexp_extract_all(F.lower(_c(c)), F.lit("[\\p{L}\\p{N}]+"), 0)


def tokens(c, tokenizer: str = "ascii") -> Column:
    if tokenizer == "ascii":
        return ascii_tokens(c)
    if tokenizer == "unicode":
        return unicode_tokens(c)
    raise ValueError(f"unknown tokenizer {tokenizer!r}; use 'ascii' or 'unicode'")
