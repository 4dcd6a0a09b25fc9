"""Fixed values and regular expressions shared by the Spark operators and
their DuckDB oracles.

Everything under "FIXED VALUES" must equal what the reference computes with;
it is stated once here, in natural order.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the reference's results)
# ---------------------------------------------------------------------------
CHUNK_SIZE = 400                      # tokens per chunk
CHUNK_OVERLAP = 200                   # tokens shared by neighbouring chunks
ENCODING_NAME = "cl100k_base"
SEPARATORS = ["\n\n", "\n", " ", ""]  # recursive splitter, tried in order
BATCH_SIZE = 1000                     # rows per embedding request file
DROPPED_COLUMN = "Unnamed: 0"         # pandas index column dropped from tabular input
METADATA_SKIP_KEYS = ["id", "context"]
METADATA_SKIP_SUBSTRING = "http"
QUOTE_DASH_FROM = "“”‘’—–"   # “ ” ‘ ’ — –
QUOTE_DASH_TO = "\"\"''--"
STATUS_ADD_TO_BATCH = "add to batch"
STATUS_EMBEDDING = "embedding content"
STATUS_COMPLETE = "complete"
STATUS_PROCESSED = "Processed"
STATUS_PENDING = "pending"
BATCH_TYPE = "embeddings"
PROVIDER_COMPLETED = "completed"
REQUEST_METHOD = "POST"
REQUEST_URL = "/v1/embeddings"
REQUEST_MODEL = "text-embedding-3-small"
REQUEST_ID_PREFIX = "request-"
# Public cl100k_base pre-tokenizer (pat_str of the public tiktoken encoding).
CL100K_PAT_STR = (
    r"""'(?i:[sdmt]|ll|ve|re)|[^\r\n\p{L}\p{N}]?+\p{L}++|\p{N}{1,3}+| ?[^\s\p{L}\p{N}]++[\r\n]*+"""
    r"""|\s++$|\s*[\r\n]|\s+(?!\S)|\s"""
)
# Cells that pandas reads as missing.
NA_CELLS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
            "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]
# ---------------------------------------------------------------------------

# Unicode White_Space, spelled out so Java regex and RE2 use the same set.
WS_CHARS = "\\t\\n\\x0B\\f\\r \\x85\\xA0\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}"
# Python's str.strip() set: White_Space plus the four separators U+001C-001F.
STRIP_CHARS = WS_CHARS + "\\x1C-\\x1F"


def _pretoken_pattern() -> str:
    """The cl100k pre-tokenizer without lookahead or possessive quantifiers.

    ``\\s+(?!\\S)`` keeps the last blank of a run for the next piece. Here the
    run is matched together with that next piece and group 1 holds the part
    before it, so a match with a non-empty group 1 is two pieces: group 1 and
    the rest. This gives the same pieces as the original pattern (checked
    against the ``regex`` module in tests) and runs in Java regex and RE2.
    """
    s = f"[{WS_CHARS}]"
    punct = f"[^{WS_CHARS}\\p{{L}}\\p{{N}}]"
    return (
        "'(?i:[sdmt]|ll|ve|re)"
        "|[^\\r\\n\\p{L}\\p{N}]?\\p{L}+"
        "|\\p{N}{1,3}"
        f"| ?{punct}+[\\r\\n]*"
        f"|{s}+\\z"
        f"|{s}*[\\r\\n]"
        f"|({s}+)(?:{s}\\p{{L}}+| {punct}+[\\r\\n]*|{s})"
        f"|{s}"
    )


PRETOKEN_PATTERN = _pretoken_pattern()


def _java_pretoken_pattern() -> str:
    """The cl100k pre-tokenizer itself, for Java regex (which has lookahead and
    possessive quantifiers), with ``\\s`` spelled as Unicode White_Space and
    ``$`` as end of input."""
    s = f"[{WS_CHARS}]"
    punct = f"[^{WS_CHARS}\\p{{L}}\\p{{N}}]"
    return (
        "'(?i:[sdmt]|ll|ve|re)"
        "|[^\\r\\n\\p{L}\\p{N}]?+\\p{L}++"
        "|\\p{N}{1,3}+"
        f"| ?{punct}++[\\r\\n]*+"
        f"|{s}++\\z"
        f"|{s}*[\\r\\n]"
        f"|{s}+(?!{NON_WS})"
        f"|{s}"
    )


NON_WS = f"[^{WS_CHARS}]"
JAVA_PRETOKEN_PATTERN = _java_pretoken_pattern()

# Control characters dropped by normalization: U+0000-001F except TAB, LF, CR.
CONTROL_CHARS = "[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F]"
# Word character as Python's re understands it (letters, digits, underscore).
WORD_CHAR = "[\\p{L}\\p{N}_]"


def sql_quote(pattern: str) -> str:
    """Quote a pattern as a SQL string literal (for DuckDB oracles)."""
    return "'" + pattern.replace("'", "''") + "'"
