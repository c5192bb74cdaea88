"""Sentence-aligned chunks with overlap.

A document is one row, so all of this happens inside that row: no shuffle.  The fold over the
sentences carries positions and token totals only, never text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions import text as tx

_SPAN = "struct<first:int,last:int,n_tokens:int>"
_STATE = (
    "struct<at:int,first:int,before:int,total:int,tail:array<int>,spans:array<" + _SPAN + ">>"
)


def _cut_long(sentence: Column, size: int) -> Column:
    """A sentence of more than ``size`` tokens as consecutive pieces of at most ``size``."""
    def pieces(tokens: Column) -> Column:
        n_pieces = F.ceil(F.size(tokens) / F.lit(size)).cast("int")
        return F.transform(
            F.sequence(F.lit(0), n_pieces - 1),
            lambda i: F.trim(F.array_join(F.slice(tokens, i * size + 1, F.lit(size)), "")),
        )

    tokens = F.regexp_extract_all(sentence, F.lit(tx.TOKEN_AND_GAP), F.lit(0))
    short = (F.length(sentence) < 2 * size) | (tx.sentence_tokens(sentence) <= size)
    return F.when(short, F.array(sentence)).otherwise(tx.let(tokens, pieces))


def pieces(clean: Column, size: int) -> Column:
    """Sentences of a cleaned text, none longer than ``size`` tokens."""
    return F.flatten(F.transform(tx.sentences(clean), lambda s: _cut_long(s, size)))


def pack(counts: Column, size: int, overlap: int) -> Column:
    """Spans of consecutive pieces holding at most ``size`` tokens each.

    When the next piece does not fit, the span is closed and the next one starts at the earliest
    later piece for which the repeated part stays within ``overlap`` and the new piece still fits.
    ``tail`` holds the running totals at the possible starts, so it is never longer than the overlap.
    """
    start = F.struct(
        F.lit(0).alias("at"), F.lit(1).alias("first"), F.lit(0).alias("before"), F.lit(0).alias("total"),
        F.array(F.lit(0)).alias("tail"), F.from_json(F.lit("[]"), f"array<{_SPAN}>").alias("spans"),
    ).cast(_STATE)

    def step(state: Column, count: Column) -> Column:
        total = state["total"]
        fits = total - state["before"] + count <= size
        starts = F.filter(
            state["tail"],
            lambda p: (p > state["before"]) & (p >= total - overlap) & (p >= total + count - size),
        )
        closed = F.struct(state["first"].alias("first"), state["at"].alias("last"),
                          (total - state["before"]).alias("n_tokens"))

        def advance(first: Column, before: Column, spans: Column) -> Column:
            after = total + count
            tail = F.filter(F.array_append(state["tail"], after), lambda p: p >= after - overlap)
            return F.struct((state["at"] + 1).alias("at"), first.alias("first"), before.alias("before"),
                            after.alias("total"), tail.alias("tail"), spans.alias("spans")).cast(_STATE)

        return F.when(fits, advance(state["first"], state["before"], state["spans"])).otherwise(
            tx.let(starts, lambda s: advance(state["at"] + 2 - F.size(s), s[0],
                                             F.array_append(state["spans"], closed)))
        )

    def finish(state: Column) -> Column:
        last = F.struct(state["first"].alias("first"), state["at"].alias("last"),
                        (state["total"] - state["before"]).alias("n_tokens"))
        return F.when(state["at"] > 0, F.array_append(state["spans"], last)).otherwise(state["spans"])

    return F.aggregate(counts, start, step, finish)


def split_sentences(contracts: DataFrame, key: str = "contract_id", clean: str = "clean_text") -> DataFrame:
    """One row per sentence, numbered from 0 in reading order."""
    split = contracts.select(key, tx.sentences(F.col(clean)).alias("sentences"))
    return tx.exploded(split, [key], "sentences", "sent_idx", "sentence")


def chunk(contracts: DataFrame, size: int = fv.CHUNK_SIZE, overlap: int = fv.CHUNK_OVERLAP,
          key: str = "contract_id", clean: str = "clean_text") -> DataFrame:
    """One row per chunk: ``chunk_idx`` from 0, its text, its token count and the chunks of its document."""
    cut = contracts.select(key, pieces(F.col(clean), size).alias("pieces"))
    packed = cut.select(key, "pieces", pack(F.transform("pieces", tx.sentence_tokens), size, overlap).alias("spans"))
    spread = tx.exploded(packed, [key, "pieces", F.size("spans").alias("n_chunks")], "spans", "chunk_idx", "span")
    members = F.slice("pieces", F.col("span.first"), F.col("span.last") - F.col("span.first") + 1)
    return spread.select(key, "chunk_idx", "n_chunks", F.col("span.n_tokens").alias("n_tokens"),
                         F.array_join(members, " ").alias("chunk_text"))


def chunk_profile(contracts: DataFrame, chunks: DataFrame, contexts: DataFrame) -> DataFrame:
    """Sizes per contract: cleaned characters, chunks, chunk characters, context characters."""
    per_contract = chunks.groupBy("contract_id").agg(
        F.count(F.lit(1)).alias("n_chunks"), F.sum(F.length("chunk_text")).alias("chunk_chars"))
    return (
        contracts.select("contract_id", F.length("clean_text").alias("clean_chars"))
        .join(per_contract, "contract_id")
        .join(contexts.select("contract_id", F.length("context").alias("context_chars")), "contract_id")
    )
