"""C2 with a vocabulary: exact byte-pair token counts through a dictionary of
distinct pieces.

Texts are cut into pre-token pieces in the JVM. Each *distinct* piece is merged
once, so merging grows with the vocabulary of the corpus, not with its text; the
counts are joined back and added up per row. Rows are never shuffled by piece as
long as the dictionary is small; beyond ``HOT_BYTES`` the most used pieces and all
single tokens of the vocabulary are broadcast and only the rest, none of it used
often, goes through a shuffle join.

Without a vocabulary file ``functions.text.token_count`` gives the number of
pieces, a lower bound.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.functions.patterns import CL100K_PAT_STR
from docweave.session import stage

#: bytes of the dictionary that may be broadcast
HOT_BYTES = 32 << 20


def read_ranks(spark: SparkSession, vocab_path: str) -> dict[bytes, int]:
    """A vocabulary file of lines ``<base64 token> <rank>``, by Spark's reader."""
    lines = spark.read.text(vocab_path).where("value <> ''").collect()       # one line per token of the vocabulary
    return {base64.b64decode(r.value.split()[0]): int(r.value.split()[1]) for r in lines}


def merged_tokens(piece: bytes, ranks: dict[bytes, int]) -> int:
    """Tokens of one piece: neighbours are merged lowest rank first, leftmost of
    equals, until no pair is a token; n log n for a piece of n bytes."""
    if piece in ranks:
        return 1
    n = count = len(piece)
    end, after, before, gone = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1)), [False] * n
    waiting: list[tuple[int, int, int]] = []

    def offer(i: int) -> None:
        if 0 <= i and after[i] < n and (rank := ranks.get(piece[i:end[after[i]]])) is not None:
            heapq.heappush(waiting, (rank, i, end[after[i]]))

    for i in range(n):
        offer(i)
    while waiting:
        _, i, stop = heapq.heappop(waiting)
        if gone[i] or after[i] >= n or end[after[i]] != stop:
            continue                      # one side was merged otherwise since
        j = after[i]
        end[i], after[i], gone[j] = stop, after[j], True
        if after[i] < n:
            before[after[i]] = i
        count -= 1
        offer(i)
        offer(before[i])
    return count


def token_length(ranks: dict[bytes, int], pattern: str = CL100K_PAT_STR, memo: int = 200_000) -> Callable[[str], int]:
    """Length function for ``chunk_recursive``: exact tokens of a text, every
    distinct piece merged once per worker (a bounded memo)."""
    state: dict = {}

    def length(text: str) -> int:
        if "find" not in state:
            import regex

            state["find"], state["known"] = regex.compile(pattern).findall, {}
        known, total = state["known"], 0
        for piece in state["find"](text):
            n = known.get(piece)
            if n is None:
                if len(known) >= memo:
                    known.clear()
                n = known[piece] = merged_tokens(piece.encode(), ranks)
            total += n
        return total

    return length


def _java(pattern: str) -> Column:
    return F.lit(f"(?U){pattern}")        # Unicode classes, as the pattern means them


def piece_dictionary(pieces: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """(piece, uses, tokens) of a frame of pieces, each distinct one merged once."""
    import pyarrow as pa

    shared = pieces.sparkSession.sparkContext.broadcast(ranks)      # as large as the vocabulary file

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            counts = [merged_tokens(p.encode(), shared.value) for p in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(counts, pa.int64())], names=["piece", "uses", "tokens"])

    used = pieces.where("piece is not null").groupBy("piece").agg(F.count(F.lit(1)).alias("uses"))
    return stage(used.mapInArrow(run, "piece string, uses bigint, tokens bigint"))


def exact_token_counts(df: DataFrame, text_col: str, keep: list[str], vocab_path: str, pattern: str = CL100K_PAT_STR,
                       hot_bytes: int = HOT_BYTES, count_col: str = "token_count") -> DataFrame:
    """(*keep, token_count) per row of ``df``; null for null texts, 0 for empty ones."""
    found = F.regexp_extract_all(F.col(text_col), _java(pattern), 0)
    dictionary = piece_dictionary(df.select(F.explode(found).alias("piece")), read_ranks(df.sparkSession, vocab_path))
    size = F.octet_length("piece") + 32
    level = F.floor(F.log2("uses")).cast("int")
    by_use = dictionary.groupBy(level.alias("level")).agg(
        F.sum(size).alias("all"), F.sum(F.when(F.col("tokens") > 1, size).otherwise(0)).alias("more")).collect()      # at most 63 rows
    if sum(r["all"] for r in by_use) <= hot_bytes:
        hot, rest = dictionary, None
    else:
        least, room = 63, hot_bytes
        for r in sorted(by_use, key=lambda r: -r.level):
            room -= r["more"]
            if room < 0:
                break
            least = r.level
        # single tokens are no more than the vocabulary holds
        is_hot = (F.col("tokens") == 1) | (level >= least)
        hot, rest = dictionary.where(is_hot), dictionary.where(~is_hot)

    rows = df.select(*keep, text_col, F.monotonically_increasing_id().alias("_row"))
    pieces = rows.select("_row", *keep, F.col(text_col).isNull().alias("_null"), F.explode_outer(found).alias("piece"))
    joined = pieces.join(F.broadcast(hot.select("piece", "tokens")), "piece", "left")
    if rest is not None:
        known = joined.where("piece is null or tokens is not null")
        rare = joined.where("piece is not null and tokens is null").drop("tokens").join(rest.select("piece", "tokens"), "piece")
        joined = known.unionByName(rare)
    total = F.when(~F.bool_or("_null"), F.coalesce(F.sum("tokens"), F.lit(0)))
    return (joined.groupBy("_row").agg(*[F.any_value(c).alias(c) for c in keep], total.alias(count_col)).drop("_row"))
