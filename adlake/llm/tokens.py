"""Token counts of documents, and the exact length histogram (operator 5).

Ids are those of the byte-level BPE file that the caller names; the same
vocabulary stands as ranks beside it, and the encoder over the ranks gives the
same ids several times faster (a test holds them against the file's own
tokenizer).  Strings of special tokens are ordinary text.

The histogram aggregates documents by encoded length.  Suffix sums over the
distinct lengths then answer, for every context limit ``L``, how many
documents and tokens there are of at least ``L``, how many tokens are left if
every document is cut at ``L`` (``sum(min(length, L))``), and the quantile of
``L``.  A limit between two lengths has the row of the next lower one, plus
``n_longer`` tokens for each token above it.

Defined results: a null or empty text has length 0 and counts as a document;
repeated rows, also of one id or none, count each; an empty table gives an
empty histogram (no quantile, totals of 0); very long texts are encoded
whole; extra columns are not read.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlake.llm.common import arrow, stage

#: Width of the length bands in which suffix sums run; bands are summed among themselves.
BAND = 4096


@functools.lru_cache(maxsize=4)
def encoder(ranks_path: str, pattern: str):
    """The encoder over a file of ranks, one for each worker process."""
    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def ranks_of(tokenizer: str) -> tuple[str, str]:
    """(file of ranks, pattern) of a public tokenizer file such as ``byte_bpe_50k.json``."""
    import public_tokenizers

    return public_tokenizers.path(tokenizer.removesuffix(".json") + ".tiktoken"), public_tokenizers.PATTERN


def encode_documents(batches: Iterator[pa.RecordBatch], tokenizer: str, use: Callable[[np.ndarray], tuple]) -> Iterator[tuple[list, list]]:
    """(ids of the documents, ``use`` of each one's token ids) of every batch;
    equal texts of a batch are encoded once."""
    encode = encoder(*ranks_of(tokenizer)).encode_ordinary
    for batch in batches:
        seen: dict[str, tuple] = {}
        out = []
        for text in batch.column(1).to_pylist():
            text = text or ""
            if text not in seen:
                seen[text] = use(np.array(encode(text), np.uint32))
            out.append(seen[text])
        yield batch.column(0).to_pylist(), out


def token_lengths(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", extra: int = 0) -> DataFrame:
    """(id, length) of every row: its number of token ids and ``extra`` more; a null text is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, lengths in encode_documents(batches, tokenizer, lambda x: len(x) + extra):
            yield arrow({"id": (ids, pa.int64()), "length": (lengths, pa.int64())})

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, "id long, length long")


def length_histogram(lengths: DataFrame, length: str = "length") -> DataFrame:
    """One row for each distinct length, as the module's text says; exact.

    Partial aggregation leaves one row for each task and length; the histogram
    is kept in the shared folder, so documents are encoded once.  Suffix sums
    run within bands of lengths, over the bands' totals before; neither grows
    with the documents, only with the longest of them.
    """
    hist = stage(lengths.groupBy(F.col(length).alias("context_limit")).agg(F.count("*").alias("n_docs")), "length-histogram")
    tokens = F.col("context_limit") * F.col("n_docs")
    hist = hist.withColumn("band", F.floor(F.col("context_limit") / BAND))
    bands = hist.groupBy("band").agg(F.sum("n_docs").alias("docs"), F.sum(tokens).alias("tokens"))
    above = Window.orderBy(F.col("band").desc()).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")

    def total(column: str, over) -> Column:
        return F.coalesce(F.sum(column).over(over), zero)

    all_docs = Window.orderBy("band").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    bands = bands.select(
        "band",
        total("docs", above).alias("docs_above"),
        total("tokens", above).alias("tokens_above"),
        F.sum("docs").over(all_docs).alias("all_docs"),
        F.sum("tokens").over(all_docs).alias("all_tokens"),
    )
    inside = Window.partitionBy("band").orderBy(F.col("context_limit").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = (
        hist.withColumn("tokens", tokens)
        .join(bands, "band")
        .withColumn("docs_at_least", F.sum("n_docs").over(inside) + F.col("docs_above"))
        .withColumn("tokens_at_least", F.sum("tokens").over(inside) + F.col("tokens_above"))
    )
    longer = F.col("docs_at_least") - F.col("n_docs")
    longer_tokens = F.col("tokens_at_least") - F.col("tokens")
    return out.select(
        "context_limit",
        "n_docs",
        longer.alias("n_longer"),
        F.col("docs_at_least").alias("n_at_least"),
        F.col("tokens_at_least"),
        (F.col("all_tokens") - longer_tokens).alias("tokens_at_most"),
        (F.col("all_tokens") - longer_tokens + longer * F.col("context_limit")).alias("truncated_total"),
        F.col("all_tokens").alias("total_tokens"),
        ((F.col("all_docs") - longer) / F.col("all_docs")).alias("quantile"),
    )


def quantile_length(histogram: DataFrame, q: float) -> int | None:
    """The least length that at least the share ``q`` of the documents do not exceed; none of no documents."""
    return histogram.where(F.col("quantile") >= F.lit(q)).agg(F.min("context_limit")).first()[0]


def truncated_total(histogram: DataFrame, limit: int) -> int:
    """Tokens left when every document is cut at ``limit``, for any limit."""
    row = histogram.where(F.col("context_limit") <= limit).orderBy(F.col("context_limit").desc()).limit(1).collect()
    if row:
        return row[0]["truncated_total"] + row[0]["n_longer"] * (limit - row[0]["context_limit"])
    return limit * (histogram.agg(F.sum("n_docs")).first()[0] or 0)
