"""Semi-structured metadata: typed JSON entries, the two text renderings
(D1, D2), list cleaning (D3) and JSON rebuilding.

A metadata value is JSON text at rest. ``json_entries`` turns it into an
ordered ``array<struct<key, type, raw>>``:

* ``key``  - object key, in document order;
* ``type`` - the Python type ``json.loads`` would give: str, int, float,
  bool, null, list, dict (read from ``schema_of_variant``);
* ``raw``  - the value as text: strings unquoted, numbers as Spark prints
  them, nested lists/objects as compact JSON in document order.

Python prints nested lists and dicts with ``repr``; here they print as
compact JSON (documented difference).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docweave.functions.patterns import METADATA_SKIP_KEYS, METADATA_SKIP_SUBSTRING
from docweave.functions.text import strip_text, title_case

ENTRY_TYPE = "array<struct<key:string,type:string,raw:string>>"


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def variant_type(v: Column) -> Column:
    """Python type name of a VARIANT value."""
    t = F.schema_of_variant(v)
    return (F.when(v.isNull(), F.lit(None))
            .when(t == "STRING", "str")
            .when(t.rlike(r"^(BIGINT|INT|SMALLINT|TINYINT)$|^DECIMAL\(\d+,0\)$"), "int")
            .when(t.rlike(r"^(DECIMAL|DOUBLE|FLOAT)"), "float")
            .when(t == "BOOLEAN", "bool")
            .when(t == "VOID", "null")
            .when(t.startswith("ARRAY"), "list")
            .when(t.startswith("OBJECT"), "dict"))


def bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often ``use`` names
    it: a lambda variable is a value, an expression inside a lambda runs again."""
    return F.get(F.transform(F.array(value), use), 0)


def _unique_keys(entries: Column) -> Column:
    """A repeated key keeps its first place and its last value, as a dict does."""
    def latest(e):
        keys = F.transform(e, lambda x: x.key)
        last = F.transform(F.array_distinct(keys), lambda k: F.element_at(F.filter(e, lambda x: x.key == k), -1))
        return F.when(F.size(F.array_distinct(keys)) < F.size(keys), last).otherwise(e)
    return bound(entries, latest)


def json_entries(c) -> Column:
    """Ordered typed entries of a JSON object text (empty for null/invalid).

    The text is parsed twice in all, once for the values' texts and once for
    their types; both results list the keys in document order and are zipped
    by place, so the work is linear in the keys."""
    c = _c(c)
    texts = F.map_entries(F.from_json(c, "map<string,string>"))
    variants = F.map_entries(F.from_json(c, "map<string,variant>"))
    entries = F.zip_with(texts, variants, lambda t, v: F.struct(
        t.key.alias("key"), variant_type(v.value).alias("type"), t.value.alias("raw")))
    return F.coalesce(_unique_keys(entries), F.array().cast(ENTRY_TYPE))


def json_elements(raw: Column) -> Column:
    """Typed elements (``key`` null) of a JSON array text."""
    texts = F.from_json(raw, "array<string>")
    variants = F.from_json(raw, "array<variant>")
    elements = F.zip_with(texts, variants, lambda t, v: F.struct(
        F.lit(None).cast("string").alias("key"), variant_type(v).alias("type"), t.alias("raw")))
    return F.coalesce(elements, F.array().cast(ENTRY_TYPE))


def render(e: Column) -> Column:
    """``str(value)`` the way Python prints the entry's value."""
    return (F.when(e.type == "bool", F.when(e.raw == "true", "True").otherwise("False"))
            .when(e.type == "null", "None")
            .otherwise(e.raw))


def json_string(c) -> Column:
    """A string as a JSON string literal (quoted, escaped)."""
    return F.regexp_extract(F.to_json(F.array(_c(c))), r"^\[(.*)\]$", 1)


def value_json(e: Column) -> Column:
    """The entry's value as JSON text."""
    return (F.when(e.type == "str", json_string(e.raw))
            .when(e.type == "null", "null")
            .otherwise(e.raw))


def entries_to_json(entries: Column) -> Column:
    """Rebuild a JSON object text from ``array<struct<key, json>>``."""
    pairs = F.transform(entries, lambda e: F.concat(json_string(e.key), F.lit(":"), e.json))
    return F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}"))


def _allowed_key(key: Column) -> Column:
    return ~key.isin(*METADATA_SKIP_KEYS)


def _keep_pair(e: Column) -> Column:
    """B5 for str values and nested pairs: no null, no '', no http, key allowed."""
    return (e.raw.isNotNull() & (e.type != "null") & ~((e.type == "str") & (e.raw == ""))
            & ~e.raw.contains(METADATA_SKIP_SUBSTRING) & _allowed_key(e.key))


def _pair_text(e: Column) -> Column:
    return F.concat(title_case(e.key), F.lit(": "), render(e), F.lit("; "))


def _nested_pairs(raw: Column) -> Column:
    """``Title(k): v; `` for the filtered pairs of a nested JSON object."""
    kept = F.filter(json_entries(raw), _keep_pair)
    return F.array_join(F.transform(kept, _pair_text), "")


def _scalar_piece(e: Column) -> Column:
    """Shared str / other branches of both renderings."""
    return (F.when(e.type == "str", F.when(_keep_pair(e), _pair_text(e)).otherwise(""))
            .when(e.type == "dict", _nested_pairs(e.raw))
            .when((e.type != "null") & _allowed_key(e.key), _pair_text(e))
            .otherwise(""))


def metadata_text_v1(c=None, entries: Column | None = None) -> Column:
    """First metadata rendering (used when embedding rows are made).
    Pass ``entries`` when the metadata is already parsed."""
    def piece(e):
        def element(x):
            return F.when(x.type == "dict", F.concat(e.key, F.lit(":\n"), _nested_pairs(x.raw))) \
                .otherwise(F.concat(title_case(e.key), F.lit(": "), render(x), F.lit(" ")))
        as_list = F.array_join(F.transform(json_elements(e.raw), element), "")
        return F.when(e.type == "list", as_list).otherwise(_scalar_piece(e))

    if entries is not None:
        return F.concat(F.array_join(F.transform(entries, piece), ""), F.lit("\n\n"))
    c = _c(c)
    text = F.concat(F.array_join(F.transform(json_entries(c), piece), ""), F.lit("\n\n"))
    return F.when(c.isNotNull(), text)


def metadata_text_v2(c=None, entries: Column | None = None) -> Column:
    """Second rendering: empty lists skipped, the first element decides
    the list kind, scalar lists as ``Title(k): a, b`` plus a blank line."""
    def piece(e):
        elements = json_elements(e.raw)
        dict_list = F.array_join(F.transform(
            F.filter(elements, lambda x: x.type == "dict"),
            lambda x: F.concat(e.key, F.lit(":\n"), _nested_pairs(x.raw))), "")
        scalar_list = F.concat(title_case(e.key), F.lit(": "),
                               F.array_join(F.transform(elements, render), ", "), F.lit("\n\n"))
        as_list = (F.when(F.size(elements) == 0, "")
                   .when(elements[0].type == "dict", dict_list)
                   .otherwise(scalar_list))
        return F.when(e.type == "list", as_list).otherwise(_scalar_piece(e))

    if entries is not None:
        return F.concat(F.array_join(F.transform(entries, piece), ""), F.lit("\n\n"))
    c = _c(c)
    text = F.concat(F.array_join(F.transform(json_entries(c), piece), ""), F.lit("\n\n"))
    return F.when(c.isNotNull(), text)


def clean_meta_list(e: Column) -> Column:
    """D3: a list stays (elements as text); a dict gives its keys; a string is
    cut into questions, each trimmed and ending in one ``?``; a string without
    ``?`` and any other value give a one-element list."""
    s = F.replace(e.raw, F.lit("?,"), F.lit("?"))
    questions = F.transform(
        F.filter(F.transform(F.split(s, r"\?", -1), strip_text), lambda x: x != ""),
        lambda x: F.concat(x, F.lit("?")))
    return (F.when(e.type == "list", F.transform(json_elements(e.raw), render))
            .when(e.type == "dict", F.transform(json_entries(e.raw), lambda x: x.key))
            .when((e.type == "str") & s.contains("?"), questions)
            .otherwise(F.array(render(e))))


def joined_value(e: Column) -> Column:
    """``' '.join(v)`` for lists (elements) and dicts (keys); ``str(v)`` otherwise."""
    return (F.when(e.type == "list", F.array_join(F.transform(json_elements(e.raw), render), " "))
            .when(e.type == "dict", F.array_join(F.transform(json_entries(e.raw), lambda x: x.key), " "))
            .otherwise(render(e)))


def entry(entries: Column, key: str) -> Column:
    """The entry for ``key`` (null when absent)."""
    return F.get(F.filter(entries, lambda x: x.key == key), 0)


def has_key(entries: Column, key: str) -> Column:
    return F.exists(entries, lambda x: x.key == key)
