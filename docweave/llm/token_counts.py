"""Token counts by offset-mapped attribution.

A document is encoded once, as a whole. Byte-level ids have fixed byte lengths,
so a running sum gives every token's byte span, and the count of characters
begun before a byte gives its character span (a token that starts or ends
inside a character spans that whole character). Token spans are then joined
with the spans of the document's sections: both are sorted, so two binary
searches per token give the first and last section it meets. The join stays
inside the document's row: nothing is shuffled.

A token that meets several sections is allocated by an explicit rule:
"largest" (default): to the section with most of its characters, the earlier
one on a tie; "first": to the earliest; "share": to each by its part of the
token's characters that lie in sections. A token that meets no section (in the
gap between two fields) goes to the section before it, or to the first. So the
counts of a document's sections always add up to its tokens.

Sections are lines (each with its line break), or given columns of a table,
joined by a separator.

Defined results: null text or fields count as empty; an empty document has one
empty section with 0 tokens; an empty field is a section with an empty span,
which no token meets; repeated rows are documents of their own; an empty table
gives no rows. Special-token strings are ordinary text. Only the id and the
text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.llm.common import bounded_batches, worker_cache

RULES = ("largest", "first", "share")


def _encoding(vocab_path: str, pattern: str):
    cache = worker_cache(f"ranks:{vocab_path}")
    if "encoding" not in cache:
        import base64

        import tiktoken

        with open(vocab_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        lens = np.zeros(max(ranks.values()) + 1, np.int64)
        for piece, k in ranks.items():
            lens[k] = len(piece)
        cache |= {"encoding": tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), "lens": lens}
    return cache["encoding"], cache["lens"]


def char_spans(raw: np.ndarray, byte_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Character spans of the tokens of a UTF-8 text that end at ``byte_ends``."""
    begun = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    byte_starts = np.concatenate([[0], byte_ends[:-1]]) if len(byte_ends) else byte_ends
    return begun[byte_starts + 1] - 1 if len(byte_ends) else byte_ends, begun[byte_ends]


def allocate(ts: np.ndarray, te: np.ndarray, starts: np.ndarray, ends: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, crossing) per section: tokens allocated to it, and how many of
    the tokens that meet it also meet another. Sections are sorted and disjoint."""
    k = len(starts)
    full = np.flatnonzero(ends > starts)
    count, crossing = np.zeros(k), np.zeros(k, np.int64)
    if not len(full):
        if k:
            count[0] = len(ts)
        return count, crossing
    s, e = starts[full], ends[full]
    first, last = np.searchsorted(e, ts, "right"), np.searchsorted(s, te, "left") - 1
    alone = first >= last
    own = np.where(first > last, np.maximum(last, 0), first)
    count[full] += np.bincount(own[alone], minlength=len(full))
    for t in np.flatnonzero(~alone).tolist():
        a, b = first[t], last[t] + 1
        overlap = np.minimum(e[a:b], te[t]) - np.maximum(s[a:b], ts[t])
        crossing[full[a:b]] += 1
        if rule == "share":
            count[full[a:b]] += overlap / overlap.sum()
        else:
            count[full[a + (0 if rule == "first" else int(overlap.argmax()))]] += 1
    return count, crossing


def attribute(docs: DataFrame, vocab_path: str, pattern: str, rule: str = "largest", id_col: str = "doc_id",
              text_col: str = "text", fields: list[str] | None = None, separator: str = "\n\n") -> DataFrame:
    """(id, section, name, start, end, tokens, crossing), one row per section:
    its character span [start, end) in the document, the tokens allocated to it,
    and the tokens that cross its boundary. Sections are the lines of
    ``text_col``, or the columns ``fields`` joined by ``separator``."""
    import pyarrow as pa

    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")

    def lines(parts: tuple) -> tuple[str, list, np.ndarray, np.ndarray]:
        text = parts[0]
        cuts, at = [0], text.find("\n")
        while at >= 0:
            cuts.append(at + 1)
            at = text.find("\n", at + 1)
        if len(cuts) > 1 and cuts[-1] == len(text):
            cuts.pop()
        starts = np.array(cuts, np.int64)
        return text, ["line"] * len(cuts), starts, np.append(starts[1:], len(text))

    def columns(parts: tuple) -> tuple[str, list, np.ndarray, np.ndarray]:
        lens = np.array([len(p) for p in parts], np.int64)
        starts = np.concatenate([[0], np.cumsum(lens[:-1] + len(separator))])
        return separator.join(parts), list(fields), starts, starts + lens

    def run(batches: Iterator) -> Iterator:
        encoding, lens = _encoding(vocab_path, pattern)
        for batch in batches:
            texts = zip(*(batch.column(1 + i).to_pylist() for i in range(batch.num_columns - 1)))
            rows, out = [], [[] for _ in range(6)]
            for r, parts in enumerate(texts):
                text, names, starts, ends = (columns if fields else lines)(tuple(p or "" for p in parts))
                raw = np.frombuffer(text.encode(), np.uint8)
                byte_ends = np.cumsum(lens[np.array(encoding.encode_ordinary(text), np.int64)])
                count, crossing = allocate(*char_spans(raw, byte_ends), starts, ends, rule)
                rows += [r] * len(names)
                for o, v in zip(out, (range(len(names)), names, starts.tolist(), ends.tolist(), count.tolist(), crossing.tolist())):
                    o.extend(v)
            kinds = (pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.float64() if rule == "share" else pa.int64(), pa.int64())
            out[4] = out[4] if rule == "share" else [int(c) for c in out[4]]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), *[pa.array(o, k) for o, k in zip(out, kinds)]],
                                             names=["id", "section", "name", "start", "end", "tokens", "crossing"])

    bounded_batches(docs.sparkSession)
    own = docs.select(F.col(f"`{id_col}`").alias("id"), *[F.col(f"`{c}`").cast("string").alias(f"t{i}") for i, c in enumerate(fields or [text_col])])
    count = "double" if rule == "share" else "bigint"
    return own.mapInArrow(run, f"id {own.schema['id'].dataType.simpleString()}, section int, name string, start bigint, `end` bigint, "
                               f"tokens {count}, crossing bigint")
