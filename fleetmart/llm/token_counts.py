"""Token counts from an exact histogram of encoded lengths.

Documents are encoded whole and counted by length; a task sends one row per length it has seen, not one per document.
Suffix sums over the lengths then answer, for every context limit: how many documents are longer, how many tokens they
hold, and how many tokens are left when each document is cut at the limit; and any quantile of the lengths. The sums
are made within blocks of ``BLOCK`` lengths and over the blocks, so that no task sees all lengths.

Null and empty texts have length 0. Repeated rows count each. Other columns are ignored, whatever their names. No rows:
no lengths.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetmart.llm.encoding import encoder, public
from fleetmart.session import materialize

BLOCK = 1024


def histogram(docs: DataFrame, tokenizer: str | None = None, text_column: str = "text") -> DataFrame:
    """(length, docs): how many documents have each encoded length."""
    path = tokenizer or public()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, seen = encoder(path).ids, Counter()
        for batch in batches:
            seen.update(len(encode(t.as_py())) // 4 for t in batch.column(0))
        yield pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.int64()), pa.array(seen.values(), pa.int64())], ["length", "docs"])

    return docs.select(text_column).mapInArrow(run, "length long, docs long").groupBy("length").agg(F.sum("docs").alias("docs"))


def suffix_sums(lengths: DataFrame, block: int = BLOCK) -> DataFrame:
    """For each length of a histogram as context limit:

    docs, tokens: of documents with this length; docs_longer, tokens_longer: beyond it; tokens_truncated: left when
    every document is cut at it; share: of documents that it holds whole.
    """
    counted = lengths.select("length", "docs", (F.col("length") * F.col("docs")).alias("tokens"), F.floor(F.col("length") / block).alias("_block"))
    blocks = counted.groupBy("_block").agg(F.sum("docs").alias("_docs"), F.sum("tokens").alias("_tokens"))
    # One row per block of lengths: the only windows here without partitions.
    later = W.orderBy("_block").rowsBetween(1, W.unboundedFollowing)
    rest = W.partitionBy("_block").orderBy("length").rowsBetween(1, W.unboundedFollowing)
    none = F.lit(0)
    beyond = blocks.select(
        "_block",
        F.coalesce(F.sum("_docs").over(later), none).alias("_docs_beyond"),
        F.coalesce(F.sum("_tokens").over(later), none).alias("_tokens_beyond"),
        F.sum("_docs").over(W.partitionBy()).alias("_docs_all"),
        F.sum("_tokens").over(W.partitionBy()).alias("_tokens_all"),
    )
    sums = counted.join(beyond, "_block").select(
        "length",
        "docs",
        "tokens",
        (F.coalesce(F.sum("docs").over(rest), none) + F.col("_docs_beyond")).alias("docs_longer"),
        (F.coalesce(F.sum("tokens").over(rest), none) + F.col("_tokens_beyond")).alias("tokens_longer"),
        "_docs_all",
        "_tokens_all",
    )
    return sums.select(
        "length",
        "docs",
        "tokens",
        "docs_longer",
        "tokens_longer",
        (F.col("_tokens_all") - F.col("tokens_longer") + F.col("length") * F.col("docs_longer")).alias("tokens_truncated"),
        (1 - F.col("docs_longer") / F.col("_docs_all")).alias("share"),
    )


def at_limits(sums: DataFrame, limits: Sequence[int]) -> DataFrame:
    """(context_limit, docs_longer, tokens_longer, tokens_truncated) for any limits, from the suffix sums."""
    # The documents longer than a limit are those from the next length on; what is cut there follows from them.
    found = [
        sums.where(F.col("length") > limit).agg(
            F.lit(limit).cast("long").alias("context_limit"),
            F.coalesce(F.max(F.col("docs") + F.col("docs_longer")), F.lit(0)).alias("docs_longer"),
            F.coalesce(F.max(F.col("tokens") + F.col("tokens_longer")), F.lit(0)).alias("tokens_longer"),
        )
        for limit in limits
    ]
    table = found[0]
    for one in found[1:]:
        table = table.union(one)
    total = sums.agg(F.coalesce(F.max(F.col("tokens") + F.col("tokens_longer")), F.lit(0)).alias("_all"))
    cut = F.col("_all") - F.col("tokens_longer") + F.col("context_limit") * F.col("docs_longer")
    return table.join(F.broadcast(total)).select("context_limit", "docs_longer", "tokens_longer", cut.alias("tokens_truncated"))


def quantiles(sums: DataFrame, shares: Sequence[float]) -> DataFrame:
    """(share, length): the least length that holds at least this share of the documents."""
    found = [sums.where(F.col("share") >= share - 1e-12).agg(F.lit(float(share)).alias("share"), F.min("length").alias("length")) for share in shares]
    table = found[0]
    for one in found[1:]:
        table = table.union(one)
    return table


def token_counts(docs: DataFrame, tokenizer: str | None = None, text_column: str = "text") -> DataFrame:
    """The suffix sums of all of ``docs``; texts are encoded once, and the histogram is kept in the shared folder."""
    return suffix_sums(materialize(histogram(docs, tokenizer, text_column), "lengths"))
