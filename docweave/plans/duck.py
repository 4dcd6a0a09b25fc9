"""DuckDB SQL builders for the oracle queries.

Each builder returns a SQL expression that computes, with DuckDB's own
functions (RE2 regular expressions, JSON functions, list lambdas), what the
matching Spark expression in ``docweave.functions`` computes. They are
written independently of the Spark code and share only the fixed patterns.
"""

from __future__ import annotations

from docweave.functions.patterns import (
    CHUNK_OVERLAP,
    CHUNK_SIZE,
    CONTROL_CHARS,
    PRETOKEN_PATTERN,
    STRIP_CHARS,
    sql_quote,
)

LF = "chr(10)"


def q(s: str) -> str:
    return sql_quote(s)


def chain(source: str, keep: list[str], col: str, steps: list[str]) -> str:
    """Nested SELECTs applying ``steps`` (templates over ``{s}``) to ``col``."""
    sql = f"SELECT {', '.join(keep)}, {col} AS s FROM ({source})"
    for step in steps:
        sql = f"SELECT {', '.join(keep)}, {step.replace('{s}', 's')} AS s FROM ({sql})"
    return sql


def strip(x: str) -> str:
    return f"regexp_replace({x}, {q(f'^[{STRIP_CHARS}]+|[{STRIP_CHARS}]+\\z')}, '', 'g')"


def strip_lines(x: str) -> str:
    return f"array_to_string(list_transform(string_split({x}, {LF}), lambda ln: {strip('ln')}), {LF})"


# references the fixtures hold; the ampersand itself comes last
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", "\u00a0"), ("&copy;", "\u00a9"), ("&middot;", "\u00b7"),
            ("&mdash;", "\u2014"), ("&#8217;", "\u2019"), ("&#xE9;", "\u00e9"), ("&eacute;", "\u00e9"), ("&amp;", "&")]


def html(x: str) -> str:
    """Markup as tokens: hidden elements go first, links and images are rewritten
    one quoting form at a time, what is left of a tag is a line break."""
    s = f"regexp_replace({x}, '(?s)<!--.*?-->', '<x>', 'g')"
    for tag in ("script", "style", "noscript"):
        s = f"regexp_replace({s}, {q(f'(?is)<{tag}([ /][^<>]*)?>.*?(</{tag}[ ]*>|\\z)')}, '<x>', 'g')"
    blank = "[ \\t\\r\\n]"
    for quote, inside in (('"', '[^"<>]+'), ("'", "[^'<>]+"), ("", "[^ \\t\\r\\n\"'<>=`]+")):
        value = f"{quote}({inside}){quote}"
        for inner in (f"{blank}*([^<]*?){blank}*", f"<[a-z][^<>]*>{blank}*([^<]*?){blank}*</[a-z][^<>]*>"):
            s = f"regexp_replace({s}, {q(f'(?i)<a{blank}([^<>]*{blank})?href{blank}*={blank}*{value}[^<>]*>{inner}</a{blank}*>')}, '<x>\\3 (\\2)<x>', 'g')"
        s = f"regexp_replace({s}, {q(f'(?i)<img{blank}([^<>]*{blank})?alt{blank}*={blank}*{value}[^<>]*>')}, '<x>[image: \\2]<x>', 'g')"
    s = f"regexp_replace({s}, '(<[/!?a-zA-Z][^<>]*>)+', {LF}, 'g')"
    for entity, char in ENTITIES:
        s = f"replace({s}, {q(entity)}, {q(char)})"
    return s


def normalize_steps() -> list[str]:
    return [
        "nfc_normalize({s})",
        f"regexp_replace({{s}}, {q(CONTROL_CHARS)}, '', 'g')",
        f"regexp_replace({{s}}, {q(chr(92) + 'r' + chr(92) + 'n?')}, {LF}, 'g')",
        "CASE WHEN contains({s}, '<') AND contains({s}, '>') THEN " + html("{s}") + " ELSE {s} END",
        f"regexp_replace({{s}}, {q('([\\p{L}\\p{N}_])-' + chr(92) + 'n([\\p{L}\\p{N}_])')}, '\\1\\2', 'g')",
        "translate({s}, " + q("“”‘’—–") + ", " + q("\"\"''--") + ")",
        "regexp_replace({s}, '[ \\t]+', ' ', 'g')",
        f"regexp_replace({{s}}, {q(chr(92) + 'n{3,}')}, {LF} || {LF}, 'g')",
        strip_lines("{s}"),
        strip("{s}"),
    ]


def pretoken_groups(x: str, group: int) -> str:
    return f"regexp_extract_all({x}, {q(PRETOKEN_PATTERN.replace(chr(92) + 'Z', chr(92) + 'z'))}, {group})"


def token_count(x: str) -> str:
    g = pretoken_groups(x, 1)
    return f"(len({g}) + len(list_filter({g}, lambda gg: coalesce(gg, '') <> '')))::BIGINT"


def pretokens_select(source: str, keep: list[str], col: str) -> str:
    """Adds a ``toks`` list column: the cl100k pre-token pieces of ``col``."""
    inner = (f"SELECT {', '.join(keep)}, {pretoken_groups(col, 0)} AS pm, {pretoken_groups(col, 1)} AS pg "
             f"FROM ({source})")
    toks = ("flatten(list_transform(list_zip(pm, pg), lambda z: CASE WHEN coalesce(z[2], '') = '' "
            "THEN [z[1]] ELSE [z[2], substr(z[1], length(z[2]) + 1)] END))")
    return f"SELECT {', '.join(keep)}, {toks} AS toks FROM ({inner})"


def window_chunks(toks: str = "toks", size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> str:
    step = size - overlap
    return (f"list_filter(list_transform(generate_series(0, greatest(len({toks}) - 1 - {overlap}, 0), {step}), "
            f"lambda st: array_to_string({toks}[st + 1:st + {size}], '')), lambda c: c <> '')")


def recursive_chunks(source: str, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> str:
    """(id, idx, chunk) of the recursive splitter for a ``source`` of (id, t).

    ``nodes`` are the texts that get split: the whole text, then every piece of
    ``size`` tokens or more, by the next separator it holds. Smaller pieces in a
    row form a group; ``windows`` walks a group chunk by chunk over its running
    token sums: a window reaches to the last sum within ``size`` of its start, and
    the next one starts where the carried rest is within ``overlap`` and the piece
    after it still fits."""
    lf2 = f"({LF} || {LF})"
    which = (f"CASE WHEN start <= 1 AND contains(t, {lf2}) THEN 1 WHEN start <= 2 AND contains(t, {LF}) THEN 2 "
             "WHEN start <= 3 AND contains(t, ' ') THEN 3 ELSE 4 END")
    sep = f"[{lf2}, {LF}, ' '][j]"
    cut = ("list_filter(CASE WHEN j = 4 THEN regexp_extract_all(t, '(?s).') ELSE list_transform(string_split(t, "
           f"{sep}), lambda x, i: CASE WHEN i = 1 THEN x ELSE {sep} || x END) END, lambda x: x <> '')")

    def pieces(nodes: str) -> str:
        rows = f"SELECT id, path, j, {cut} AS ps FROM (SELECT *, {which} AS j FROM {nodes})"
        return (f"SELECT *, {token_count('p')} AS n FROM (SELECT id, path, j, unnest(ps) AS p, "
                f"generate_subscripts(ps, 1) AS ord FROM ({rows}))")

    reach = f"len(list_filter(c, lambda x: x <= (CASE WHEN s = 1 THEN 0 ELSE c[s - 1] END) + {size}))"
    after = f"2 + len(list_filter(c, lambda x: x < greatest(c[e] - {overlap}, c[e + 1] - {size})))"
    return f"""
WITH RECURSIVE nodes AS (
  SELECT id, [0::BIGINT] AS path, t, 1 AS start FROM ({source})
  UNION ALL
  SELECT id, list_append(path, ord), p, j + 1 FROM ({pieces('nodes')}) WHERE n >= {size} AND j < 4),
runs AS (SELECT *, sum((n >= {size})::INT) OVER (PARTITION BY id, path ORDER BY ord) AS run FROM ({pieces('nodes')})),
sums AS (SELECT *, sum(n) OVER (PARTITION BY id, path, run ORDER BY ord) AS c FROM runs WHERE n < {size}),
groups AS MATERIALIZED (
  SELECT row_number() OVER () AS g, * FROM (
    SELECT id, list_append(path, min(ord)) AS place, list(p ORDER BY ord) AS ps, list(c ORDER BY ord) AS c FROM sums GROUP BY id, path, run)),
windows AS (
  SELECT g, s, {reach} AS e FROM (SELECT *, 1 AS s FROM groups)
  UNION ALL
  SELECT g, s, {reach} AS e FROM (SELECT g, c, {after} AS s FROM windows JOIN groups USING (g) WHERE e < len(c))),
texts AS (SELECT id, place, s, {strip("array_to_string(ps[s:e], '')")} AS chunk FROM windows JOIN groups USING (g))
SELECT id, CAST(row_number() OVER (PARTITION BY id ORDER BY place, s) - 1 AS INTEGER) AS idx, chunk FROM texts WHERE chunk <> ''
"""


def title(x: str) -> str:
    return (f"array_to_string(list_transform(regexp_extract_all({x}, '\\p{{L}}+|\\P{{L}}+'), lambda w: "
            f"CASE WHEN regexp_matches(w, '^\\p{{L}}') THEN CASE WHEN substr(w, 1, 1) = chr(223) THEN 'Ss' ELSE upper(substr(w, 1, 1)) END || lower(substr(w, 2)) "
            f"ELSE w END), '')")


# --- JSON entries ------------------------------------------------------------------

def py_type(json_type: str) -> str:
    return (f"CASE {json_type} WHEN 'VARCHAR' THEN 'str' WHEN 'BIGINT' THEN 'int' WHEN 'UBIGINT' THEN 'int' "
            f"WHEN 'HUGEINT' THEN 'int' WHEN 'DOUBLE' THEN 'float' WHEN 'BOOLEAN' THEN 'bool' "
            f"WHEN 'NULL' THEN 'null' WHEN 'ARRAY' THEN 'list' WHEN 'OBJECT' THEN 'dict' END")


def _value_struct(js: str, key: str) -> str:
    """{key, type, raw} for a JSON value expression ``js``."""
    t = f"json_type({js})"
    raw = f"CASE WHEN {t} = 'VARCHAR' THEN json_extract_string({js}, '$') WHEN {t} = 'NULL' THEN NULL ELSE {js}::VARCHAR END"
    return f"{{'key': {key}, 'type': {py_type(t)}, 'raw': {raw}}}"


def entries(m: str, var: str = "k") -> str:
    """Ordered typed entries of a JSON object text (empty for null/invalid)."""
    js = f"json_extract({m}, '$.\"' || {var} || '\"')"
    return (f"coalesce(CASE WHEN json_valid({m}) AND json_type({m}) = 'OBJECT' THEN "
            f"list_transform(json_keys({m}), lambda {var}: {_value_struct(js, var)}) END, [])")


def elements(raw: str, var: str = "el") -> str:
    return f"coalesce(list_transform(json_extract({raw}, '$[*]'), lambda {var}: {_value_struct(var, 'NULL')}), [])"


def render(e: str) -> str:
    return (f"CASE WHEN {e}.type = 'bool' THEN CASE WHEN {e}.raw = 'true' THEN 'True' ELSE 'False' END "
            f"WHEN {e}.type = 'null' THEN 'None' ELSE {e}.raw END")


def value_json(e: str) -> str:
    return f"CASE WHEN {e}.type = 'str' THEN to_json({e}.raw)::VARCHAR WHEN {e}.type = 'null' THEN 'null' ELSE {e}.raw END"


def keep_pair(e: str) -> str:
    return (f"({e}.raw IS NOT NULL AND {e}.type <> 'null' AND NOT ({e}.type = 'str' AND {e}.raw = '') "
            f"AND NOT contains({e}.raw, 'http') AND {e}.key NOT IN ('id', 'context'))")


def pair_text(e: str) -> str:
    return f"{title(e + '.key')} || ': ' || {render(e)} || '; '"


def nested_pairs(raw: str, depth: int) -> str:
    v = f"n{depth}"
    return (f"array_to_string(list_transform(list_filter({entries(raw, 'k' + str(depth))}, lambda {v}: "
            f"{keep_pair(v)}), lambda {v}: {pair_text(v)}), '')")


def scalar_piece(e: str) -> str:
    return (f"CASE WHEN {e}.type = 'str' THEN CASE WHEN {keep_pair(e)} THEN {pair_text(e)} ELSE '' END "
            f"WHEN {e}.type = 'dict' THEN {nested_pairs(e + '.raw', 1)} "
            f"WHEN {e}.type <> 'null' AND {e}.key NOT IN ('id', 'context') THEN {pair_text(e)} ELSE '' END")


def metadata_text_v1(m: str) -> str:
    el = "x1"
    lst = (f"array_to_string(list_transform({elements('e.raw', el)}, lambda {el}: CASE WHEN {el}.type = 'dict' "
           f"THEN e.key || ':' || {LF} || {nested_pairs(el + '.raw', 2)} "
           f"ELSE {title('e.key')} || ': ' || {render(el)} || ' ' END), '')")
    piece = f"CASE WHEN e.type = 'list' THEN {lst} ELSE {scalar_piece('e')} END"
    return (f"CASE WHEN {m} IS NOT NULL THEN array_to_string(list_transform({entries(m)}, lambda e: {piece}), '') "
            f"|| {LF} || {LF} END")


def metadata_text_v2(m: str) -> str:
    els = elements("e.raw", "x1")
    dict_list = (f"array_to_string(list_transform(list_filter({els}, lambda x1: x1.type = 'dict'), lambda x1: "
                 f"e.key || ':' || {LF} || {nested_pairs('x1.raw', 2)}), '')")
    scalar_list = (f"{title('e.key')} || ': ' || array_to_string(list_transform({elements('e.raw', 'x2')}, "
                   f"lambda x2: {render('x2')}), ', ') || {LF} || {LF}")
    lst = (f"CASE WHEN len({els}) = 0 THEN '' WHEN ({els})[1].type = 'dict' THEN {dict_list} "
           f"ELSE {scalar_list} END")
    piece = f"CASE WHEN e.type = 'list' THEN {lst} ELSE {scalar_piece('e')} END"
    return (f"CASE WHEN {m} IS NOT NULL THEN array_to_string(list_transform({entries(m)}, lambda e: {piece}), '') "
            f"|| {LF} || {LF} END")


def entry(ents: str, key: str) -> str:
    return f"list_filter({ents}, lambda z: z.key = {q(key)})[1]"


def has_key(ents: str, key: str) -> str:
    return f"len(list_filter({ents}, lambda z: z.key = {q(key)})) > 0"


def clean_meta_list(e: str) -> str:
    s = f"replace({e}.raw, '?,', '?')"
    questions = (f"list_transform(list_filter(list_transform(string_split({s}, '?'), lambda p: {strip('p')}), "
                 f"lambda p: p <> ''), lambda p: p || '?')")
    return (f"CASE WHEN {e}.type = 'list' THEN list_transform({elements(e + '.raw', 'x3')}, lambda x3: {render('x3')}) "
            f"WHEN {e}.type = 'dict' THEN list_transform({entries(e + '.raw', 'k3')}, lambda x4: x4.key) "
            f"WHEN {e}.type = 'str' AND contains({s}, '?') THEN {questions} "
            f"ELSE [{render(e)}] END")


def joined_value(e: str) -> str:
    return (f"CASE WHEN {e}.type = 'list' THEN array_to_string(list_transform({elements(e + '.raw', 'x5')}, "
            f"lambda x5: {render('x5')}), ' ') "
            f"WHEN {e}.type = 'dict' THEN array_to_string(list_transform({entries(e + '.raw', 'k6')}, "
            f"lambda x6: x6.key), ' ') ELSE {render(e)} END")
