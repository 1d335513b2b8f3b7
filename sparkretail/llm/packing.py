"""Batches of documents of similar length under a token budget.

A batch is padded to the upper bound of its length bucket. The bounds are those that make
the padding of the whole corpus smallest: dynamic programming over the global histogram of
lengths. Inside a bucket, documents are dealt into shards of bounded size by a hash, and
each shard is cut into batches, so no bucket is ordered or numbered in one task.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkretail.llm.common import durable
from sparkretail.llm.token_counts import count_tokens

BUCKETS = 16
BUDGET = 65_536  # padded tokens of a batch
SHARD_ROWS = 8_192
EXACT = 4_096  # lengths up to here have a histogram bin of their own
PER_OCTAVE = 64  # bins for each doubling beyond


def word_count(column: str = "text") -> Column:
    """Words that end at ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(column), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def histogram(lengths: DataFrame) -> list[tuple[int, int, int]]:
    """(largest length, rows, summed length) per bin of ``lengths(n_tokens)``.

    Lengths above ``EXACT`` share bins of about 1 %, so there are at most ``EXACT`` plus
    64 for each doubling, whatever the corpus.
    """
    n = F.col("n_tokens")
    beyond = F.floor(F.log2(n / EXACT) * PER_OCTAVE) + EXACT + 1
    bins = lengths.select(F.when(n <= EXACT, n).otherwise(beyond).alias("bin"), "n_tokens")
    rows = bins.groupBy("bin").agg(F.max("n_tokens"), F.count("*"), F.sum("n_tokens")).collect()
    return sorted((r[1], r[2], r[3]) for r in rows)


def boundaries(bins: list[tuple[int, int, int]], buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` buckets with the smallest total padding.

    best[k][j] is the least padding of the first j bins in k buckets. The cost of a bucket
    satisfies the quadrangle inequality, so the best split point grows with j and each
    layer is solved by divide and conquer.
    """
    if not bins:
        return []
    top = np.array([b[0] for b in bins], np.int64)
    rows = np.concatenate(([0], np.cumsum([b[1] for b in bins], dtype=np.int64)))
    total = np.concatenate(([0], np.cumsum([b[2] for b in bins], dtype=np.int64)))
    size = len(bins)

    def padding(i, j: int):
        """Bins i to j-1 in one bucket, for an array of i."""
        return (rows[j] - rows[i]) * top[j - 1] - (total[j] - total[i])

    best = np.array([0, *(padding(0, j) for j in range(1, size + 1))], np.int64)
    splits = []
    for _ in range(1, min(buckets, size)):
        layer, choice = best.copy(), np.zeros(size + 1, np.int64)
        todo = [(1, size, 0, size - 1)]
        while todo:
            low, high, first, last = todo.pop()
            if low > high:
                continue
            j = (low + high) // 2
            i = np.arange(first, min(last, j - 1) + 1)
            costs = best[i] + padding(i, j)
            at = int(np.argmin(costs))
            layer[j], choice[j] = costs[at], i[at]
            todo += [(low, j - 1, first, int(i[at])), (j + 1, high, int(i[at]), last)]
        splits.append(choice)
        best = layer
    ends, j = [], size
    for choice in reversed(splits):
        if j == 0:
            break
        ends.append(j)
        j = int(choice[j])
    if j:
        ends.append(j)
    return sorted({int(top[j - 1]) for j in ends})


def pack(
    docs: DataFrame,
    length: Column | None = None,
    buckets: int = BUCKETS,
    budget: int = BUDGET,
    id_column: str = "doc_id",
    text_column: str = "text",
    tokenizer: str | None = None,
) -> DataFrame:
    """One row per document: doc_id, n_tokens, bucket, padded_to, batch_id, slot, over_budget.

    With ``tokenizer``, the path of a tokenizer file, lengths are its tokens, counted once
    and written without the texts. Otherwise ``length`` gives the length of a document, by
    default its words, which are no tokens: the budget then holds in that unit. A batch holds
    documents of one bucket; its rows times ``padded_to`` stay within ``budget``. A
    document whose bucket is wider than the budget is a batch of its own; ``over_budget``
    marks those that are longer than the budget themselves. Null and empty texts have
    length 0 and are packed too. Ties and repeated rows each get a slot; other columns are
    ignored; an empty table gives an empty result.
    """
    if tokenizer is not None and length is not None:
        raise ValueError("either a length or a tokenizer")
    deal = F.coalesce(F.col(id_column).cast("long"), F.xxhash64(F.col(text_column))).alias("_deal")
    if tokenizer is None:
        length = word_count(text_column) if length is None else length.cast("long")
        rows = docs.select(F.col(id_column).alias("doc_id"), length.alias("n_tokens"), deal)
    else:
        key = F.struct(F.col(id_column).alias("doc_id"), deal).alias("key")
        counted = count_tokens(docs.select(key, F.col(text_column).alias("text")), tokenizer, id_column="key")
        rows = durable(counted.select("doc_id.doc_id", "n_tokens", "doc_id._deal"))
    bins = histogram(rows)
    bounds = boundaries(bins, buckets)
    if not bounds:
        bounds = [0]
    in_bucket = [0] * len(bounds)
    for top, count, _ in bins:
        in_bucket[int(np.searchsorted(bounds, top))] += count
    shards = [max(1, math.ceil(c / SHARD_ROWS)) for c in in_bucket]
    per_batch = [max(1, budget // max(1, b)) for b in bounds]

    def pick(values: list[int]) -> Column:
        return F.element_at(F.array(*[F.lit(v).cast("long") for v in values]), F.col("bucket") + 1)

    limits = F.array(*[F.lit(b).cast("long") for b in bounds])
    rows = rows.withColumn("bucket", F.size(F.filter(limits, lambda b: b < F.col("n_tokens"))))
    rows = rows.withColumn("_hash", F.xxhash64("_deal", "n_tokens"))
    rows = rows.withColumn("_shard", F.pmod(F.col("_hash"), pick(shards)))
    order = Window.partitionBy("bucket", "_shard").orderBy("_hash", "doc_id")
    place = F.row_number().over(order) - 1
    rows = rows.withColumn("_place", place).withColumn("_per", pick(per_batch))
    batch = F.floor(F.col("_place") / F.col("_per")).cast("long")
    number = F.shiftleft(F.col("bucket").cast("long"), 52) + F.shiftleft(F.col("_shard"), 20) + batch
    return rows.select(
        "doc_id",
        "n_tokens",
        "bucket",
        pick(bounds).alias("padded_to"),
        number.alias("batch_id"),
        (F.col("_place") % F.col("_per")).cast("long").alias("slot"),
        (F.col("n_tokens") > budget).alias("over_budget"),
    )


def batches(packed: DataFrame) -> DataFrame:
    """One row per batch of ``pack``: its documents in order, tokens and padding."""
    return (
        packed.groupBy("batch_id", "bucket", "padded_to")
        .agg(
            F.transform(
                F.array_sort(F.collect_list(F.struct("slot", "doc_id"))), lambda s: s["doc_id"]
            ).alias("doc_ids"),
            F.count("*").alias("rows"),
            F.sum("n_tokens").alias("tokens"),
        )
        .withColumn("padding", F.col("rows") * F.col("padded_to") - F.col("tokens"))
    )
