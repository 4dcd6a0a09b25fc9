"""Column expressions for text: normalization, HTML to text, cl100k
pre-token pieces and counts, context strings, slugs and titles.

All of these are built-in Spark expressions (JVM, whole-stage codegen)
except Unicode NFC composition and character references, which have no
built-in and run in Arrow UDFs: NFC for the pieces of a text that can change
under it, references for texts with markup. A worker turns a few of a batch's
texts at a time into Python strings.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, StringType

from docweave.functions.patterns import (
    CONTROL_CHARS,
    JAVA_PRETOKEN_PATTERN,
    QUOTE_DASH_FROM,
    QUOTE_DASH_TO,
    STRIP_CHARS,
    WORD_CHAR,
)

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- C1a: NFC ---------------------------------------------------------------

#: texts of an Arrow batch that are Python strings at a time
_SLICE = 64


def _map_slices(texts: pa.Array, use: Callable[[str], str], mark: str = "") -> pa.Array:
    """``use`` of every text that is not null; beside the batch and its result, a
    worker holds the Python strings of one slice only. ``use`` changes no text
    without ``mark``: a slice of such texts stays as it is."""
    import pyarrow.compute as pc

    part, parts, changed = None, [], False
    for at in range(0, len(texts), _SLICE):
        part = texts.slice(at, _SLICE)
        if pc.any(pc.match_substring(part, mark)).as_py():
            part, changed = pa.array([None if t is None else use(t) for t in part.to_pylist()], texts.type), True
        parts.append(part)
    out = pa.chunked_array(parts, texts.type).combine_chunks() if changed else texts
    del part, parts
    pa.default_memory_pool().release_unused()   # else a worker keeps what each of its batches took
    return out


@F.arrow_udf(StringType())
def _nfc_batch(s: pa.Array) -> pa.Array:
    return _map_slices(s, lambda x: unicodedata.normalize("NFC", x))


_nfc_points: str | None = None


def nfc_sensitive_chars() -> str:
    """The code points that can make a text change under NFC, as one string.

    Built by rule from ``unicodedata``: combining marks (reordering and
    composition), characters NFC rewrites on their own, the second half of
    every canonical pair (they may compose with the character before), and
    the Hangul vowel and trailing jamo. A text without any of them is NFC.
    """
    global _nfc_points
    if _nfc_points is None:
        points = set(range(0x1161, 0x1176)) | set(range(0x11A8, 0x11C3))
        for cp in range(0x300, 0x110000):
            ch = chr(cp)
            if unicodedata.combining(ch) or unicodedata.normalize("NFC", ch) != ch:
                points.add(cp)
            d = unicodedata.decomposition(ch)
            if d and not d.startswith("<") and len(d.split()) == 2:
                points.add(int(d.split()[1], 16))
        _nfc_points = "".join(chr(cp) for cp in sorted(points))
    return _nfc_points


def may_change_under_nfc(c: ColumnOrName) -> Column:
    """True when a text holds an NFC-sensitive code point. A cheap regex
    first drops texts whose code points are all below U+0300 (none of those
    is sensitive); ``translate`` then checks the exact set with a hash lookup
    per character (a regex class of ~1,000 ranges would test them in turn)."""
    c = _col(c)
    exact = F.length(F.translate(c, nfc_sensitive_chars(), "")) < F.length(c)
    return c.rlike("[\\x{0300}-\\x{10FFFF}]") & exact


# A run of characters from U+0300 on with the character before it. Characters below
# U+0300 neither change under NFC nor join what stands before them, so a text's NFC
# is that of its runs put back in their places.
_NFC_RUN = r"[^\n]?[\x{0300}-\x{10FFFF}]++"


def nfc(c: ColumnOrName) -> Column:
    """Unicode NFC. Only texts holding an NFC-sensitive code point go to Python,
    and of them only the runs of characters from U+0300 on, one to a line (no run
    holds an LF); the others are passed as null and kept as they are."""
    c = _col(c)
    runs = _nfc_batch(F.when(may_change_under_nfc(c), F.array_join(F.regexp_extract_all(c, F.lit(_NFC_RUN), 0), "\n")))
    pieces = F.zip_with(F.split(c, _NFC_RUN, -1), F.concat(F.split(runs, "\n", -1), F.array(F.lit(""))),
                        lambda kept, run: F.concat(kept, run))
    return F.when(runs.isNotNull(), F.array_join(pieces, "")).otherwise(c)


# --- C1d: HTML to text --------------------------------------------------------

# One character each, dropped by C1b before any HTML is seen: where markup was,
# and around a link's text.
_CUT, _OPEN, _SHUT = "\x01", "\x02", "\x03"
# An attribute's value in its three forms. No pattern below repeats a group, and
# each stops at the next "<", so the work is linear and needs no deep stack.
_VALUES = (r'"([^"<>]++)"', r"'([^'<>]++)'", r"([^\s\"'<>=`]++)")


@F.arrow_udf(StringType())
def _unescape_batch(s: pa.Array) -> pa.Array:
    import html

    return _map_slices(s, html.unescape, "&")


def decode_entities(c: ColumnOrName) -> Column:
    """All named and numeric character references of HTML, by Python's table in
    Arrow batches. Spark evaluates the argument of a Python step for every row
    before any CASE around it: pass null for texts that need none of this."""
    return _unescape_batch(_col(c))


def has_markup(c: ColumnOrName) -> Column:
    c = _col(c)
    return c.contains("<") & c.contains(">")


def html_to_text(c: ColumnOrName) -> Column:
    """Text nodes of an HTML string joined by LF; a text without both ``<`` and
    ``>`` stays as it is.

    Comments and script/style/noscript are removed (to the end of the text where
    they never close), a link with an href holding a single string (directly or
    inside one child element) becomes ``text (href)``, an image with alt text
    becomes ``[image: alt]``; each run of tags becomes one LF, and entities are
    decoded last. Attribute values may be double-quoted, single-quoted or bare;
    a ``<`` inside a tag ends it.
    """
    c = _col(c)
    s = F.regexp_replace(c, r"(?s)<!--.*?(?:-->|\z)", _CUT)
    s = F.regexp_replace(s, r"(?is)<(script|style|noscript)\b[^<>]*+>.*?(?:</\1\s*+>|\z)", _CUT)
    for value in _VALUES:
        link = rf"(?i)<a\b[^<>]*?\shref\s*+=\s*+{value}[^<>]*+>"
        text = f"{_CUT}{_OPEN}$2{_SHUT} ($1){_CUT}"
        s = F.regexp_replace(s, rf"{link}([^<]++)</a\s*+>", text)
        s = F.regexp_replace(s, rf"{link}<[a-z][^<>]*+>([^<]++)</[a-z][^<>]*+></a\s*+>", text)
        s = F.regexp_replace(s, rf"(?i)<img\b[^<>]*?\salt\s*+=\s*+{value}[^<>]*+>", f"{_CUT}[image: $1]{_CUT}")
    s = F.regexp_replace(s, rf"{_OPEN}\s*+|(?<!\s)\s++{_SHUT}|{_SHUT}", "")
    s = F.regexp_replace(s, r"<[/!?a-zA-Z][^<>]*+>", _CUT)
    # the guard is inside the Python step's argument, and the chain is named there only: it is
    # planned once and runs for markup only; other texts cross to Python as nulls
    text = decode_entities(F.when(has_markup(c), F.regexp_replace(s, f"{_CUT}++", "\n")))
    return F.coalesce(text, c)


# --- C1: normalize ------------------------------------------------------------

_STRIP = f"^[{STRIP_CHARS}]+|[{STRIP_CHARS}]+\\z"


def strip_text(c: ColumnOrName) -> Column:
    """Python ``str.strip()``."""
    return F.regexp_replace(_col(c), _STRIP, "")


def strip_lines(c: ColumnOrName) -> Column:
    """Strip every LF-separated line (blank lines are kept, as empty lines)."""
    return F.array_join(F.transform(F.split(_col(c), "\n", -1), strip_text), "\n")


def normalize_text(c: ColumnOrName, *, html: bool = True, unicode_nfc: bool = True) -> Column:
    """NFC, control characters, newlines, HTML, de-hyphenation,
    quotes and dashes, blank runs, per-line and whole strip; in that order."""
    s = _col(c)
    if unicode_nfc:
        s = nfc(s)
    s = F.regexp_replace(s, CONTROL_CHARS, "")
    s = F.regexp_replace(s, "\r\n?", "\n")
    if html:
        s = html_to_text(s)
    s = F.regexp_replace(s, f"({WORD_CHAR})-\n({WORD_CHAR})", "$1$2")
    s = F.translate(s, QUOTE_DASH_FROM, QUOTE_DASH_TO)
    s = F.regexp_replace(s, "[ \t]+", " ")
    s = F.regexp_replace(s, "\n{3,}", "\n\n")
    return strip_text(strip_lines(s))


# --- C2: cl100k pre-tokens ----------------------------------------------------

def pretokens(c: ColumnOrName) -> Column:
    """cl100k pre-tokenizer pieces of a text, in order; they join back to it.
    One pass of the public pre-tokenizer pattern (Java regex runs its
    lookahead and possessive quantifiers as written)."""
    return F.regexp_extract_all(_col(c), F.lit(JAVA_PRETOKEN_PATTERN), 0)


def token_count(c: ColumnOrName) -> Column:
    """Number of cl100k pre-tokens (``BIGINT``).

    Every pre-token holds at least one BPE token, so this is a lower bound
    of the exact cl100k count (the vocabulary file is not shipped).
    """
    c = _col(c)
    return F.when(c.isNotNull(), F.size(pretokens(c)).cast("bigint"))


# --- C5: context string -------------------------------------------------------

def python_str(c: ColumnOrName, dtype: DataType | None = None) -> Column:
    """``str(value)`` as Python prints it for the common scalar types."""
    c = _col(c)
    if isinstance(dtype, BooleanType):
        text = F.when(c, F.lit("True")).otherwise(F.lit("False"))
    else:
        text = c.cast("string")
    return F.coalesce(text, F.lit("None"))


def build_context(df, columns: list[str]) -> Column:
    """``COLUMN: value; `` for each column, LF-joined, caller's order."""
    types = {f.name: f.dataType for f in df.schema.fields}
    parts = [F.concat(F.lit(f"{name.upper()}: "), python_str(name, types.get(name)), F.lit("; "))
             for name in columns]
    return F.concat_ws("\n", *parts)


# --- C8 / C9: keys and names ----------------------------------------------------

def slug_key(c: ColumnOrName) -> Column:
    """C8 tag key: lower case, spaces to ``-``."""
    return F.replace(F.lower(_col(c)), F.lit(" "), F.lit("-"))


def title_case(c: ColumnOrName) -> Column:
    """Python ``str.title()``: a letter after a non-letter is upper-cased,
    other letters lower-cased (``initcap`` only restarts after spaces)."""
    runs = F.regexp_extract_all(_col(c), F.lit(r"\p{L}+|\P{L}+"), 0)

    def first_upper(ch):
        # title case of one letter; U+00DF has no one-letter upper case
        return F.when(ch == "\u00df", F.lit("Ss")).otherwise(F.upper(ch))

    titled = F.transform(runs, lambda w: F.when(
        w.rlike(r"^\p{L}"), F.concat(first_upper(w.substr(1, 1)), F.lower(w.substr(F.lit(2), F.length(w))))
    ).otherwise(w))
    return F.array_join(titled, "")


def title_name(c: ColumnOrName) -> Column:
    """C8 tag name from a key: ``-`` to space, then title case."""
    return title_case(F.replace(_col(c), F.lit("-"), F.lit(" ")))


def type_key(c: ColumnOrName) -> Column:
    """C9 type key: lower case, words joined by ``_``."""
    return F.replace(F.lower(_col(c)), F.lit(" "), F.lit("_"))


def sha256_hex(c: ColumnOrName) -> Column:
    return F.sha2(_col(c), 256)
