"""Benchmark items found in documents, also with their parts in another order.

Greedy string tiling: the longest match of a document and an item becomes a tile, then the
longest of what is left, down to ``least`` words; no word is in two tiles. Matches of a
length are found by running Karp-Rabin hashes over the unmarked stretches. An item counts
as leaked when tiles cover at least ``threshold`` of its words, in whatever order they come.

Only documents and items that share seeds, runs of ``least`` words, are tiled: every match
of that length or more is made of seeds. The seeds of a benchmark slice, a bounded number,
are sent to the executors, and each document is matched where it is read, so no text is
shuffled. A larger benchmark is worked off slice by slice.
"""

from __future__ import annotations

import heapq
import math
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import BooleanType, StructField, StructType

from sparkretail.llm.shingles import NOT_WORD, U64, WORD_VALUES, shingles, text_blocks, words

LEAST = 5
THRESHOLD = 0.5
SLICE_WORDS = 2_000_000  # words of the benchmark that are sent to the executors at once
MAYBE_BITS = 20

_BASE, _MOD = 1_000_003, (1 << 61) - 1


def _stretches(marked: list[bool], breaks: set[int]) -> Iterator[tuple[int, int]]:
    """Runs of unmarked positions; a run also ends before each position in ``breaks``."""
    start = None
    for i in range(len(marked) + 1):
        if i == len(marked) or marked[i] or i in breaks:
            if start is not None:
                yield start, i
            start = None
        if i < len(marked) and not marked[i] and start is None:
            start = i


def _hashes(tokens: list[int], stretches, length: int) -> Iterator[tuple[int, int]]:
    """(position, running hash) of all windows of ``length`` tokens within the stretches."""
    top = pow(_BASE, length - 1, _MOD)
    for start, end in stretches:
        if end - start < length:
            continue
        value = 0
        for i in range(start, end):
            if i - start >= length:
                value -= tokens[i - length] * top
            value = (value * _BASE + tokens[i]) % _MOD
            if i - start >= length - 1:
                yield i - length + 1, value


def _matches(doc, item, doc_marked, item_marked, breaks, length) -> list[tuple[int, int, int]]:
    """(-length, item position, document position) of the unmarked matches that can be
    extended to neither side and have at least ``length`` words."""
    index = defaultdict(list)
    for at, value in _hashes(item, _stretches(item_marked, set()), length):
        index[value].append(at)
    found = []
    for at, value in _hashes(doc, _stretches(doc_marked, breaks), length):
        for other in index.get(value, ()):
            if (
                at and other and at not in breaks and doc[at - 1] == item[other - 1]
                and not doc_marked[at - 1] and not item_marked[other - 1]
            ):
                continue
            k = 0
            while (
                at + k < len(doc) and other + k < len(item) and doc[at + k] == item[other + k]
                and not doc_marked[at + k] and not item_marked[other + k]
                and not (k and at + k in breaks)
            ):
                k += 1
            if k >= length:
                found.append((-k, other, at))
    return found


def tiles(
    doc: list[int], item: list[int], least: int, breaks: set[int] | None = None
) -> list[tuple[int, int, int]]:
    """(document position, item position, length) of the tiles, in the order of marking.

    ``breaks`` are positions of ``doc`` that do not continue the one before. Among matches
    of equal length the earliest in the item and then in the document is taken.
    """
    breaks = breaks or set()
    doc_marked, item_marked = [False] * len(doc), [False] * len(item)
    found: list[tuple[int, int, int]] = []
    length = max(least, min(len(item), 4 * least))
    while True:
        heap = _matches(doc, item, doc_marked, item_marked, breaks, length)
        longest = -min(heap)[0] if heap else 0
        if longest > 2 * length:
            length = longest
            continue
        heapq.heapify(heap)
        while heap:
            k, other, at = heapq.heappop(heap)
            free = [not doc_marked[at + j] and not item_marked[other + j] for j in range(-k)]
            if all(free):
                doc_marked[at : at - k] = [True] * -k
                item_marked[other : other - k] = [True] * -k
                found.append((at, other, -k))
                continue
            start = None  # earlier tiles have cut it: what is left of it queues again
            for j, ok in enumerate([*free, False]):
                if ok and start is None:
                    start = j
                elif not ok and start is not None:
                    if j - start >= length:
                        heapq.heappush(heap, (start - j, other + start, at + start))
                    start = None
        if length <= least:
            return found
        length = max(least, length // 2)


class Slice:
    """The items of one slice of the benchmark, with an index of their seeds."""

    def __init__(self, ids: list, texts: list[str], least: int):
        self.least = least
        self.items, seeds, owners, places = [], [], [], []
        for row, hashes in enumerate(text_words(pa.array(texts, pa.string()))):
            self.items.append((ids[row], hashes))
            if len(hashes) >= least:
                grams, _ = shingles(hashes, np.array([0, len(hashes)]), least)
                seeds.append(grams)
                owners.append(np.full(len(grams), row))
                places.append(np.arange(len(grams)))
        self.seeds = np.concatenate(seeds) if seeds else np.zeros(0, U64)
        order = np.argsort(self.seeds, kind="stable")
        self.seeds = self.seeds[order]
        self.owners = np.concatenate(owners)[order] if seeds else np.zeros(0, np.int64)
        self.places = np.concatenate(places)[order] if seeds else np.zeros(0, np.int64)
        self.maybe = np.zeros(1 << MAYBE_BITS, bool)
        self.maybe[(self.seeds >> U64(64 - MAYBE_BITS)).astype(np.int64)] = True

    def hits(self, grams: np.ndarray) -> np.ndarray:
        """Positions of ``grams`` that are seeds."""
        at = np.flatnonzero(self.maybe[(grams >> U64(64 - MAYBE_BITS)).astype(np.int64)])
        if not len(at) or not len(self.seeds):
            return at[:0]
        near = np.minimum(np.searchsorted(self.seeds, grams[at]), len(self.seeds) - 1)
        return at[self.seeds[near] == grams[at]]

    def leaks(self, hashes: np.ndarray, grams: np.ndarray, hits: np.ndarray, threshold: float) -> list[dict]:
        """Items of which tiles of the document cover ``threshold`` or more."""
        least = self.least
        low = np.searchsorted(self.seeds, grams[hits], "left")
        high = np.searchsorted(self.seeds, grams[hits], "right")
        of_item: dict[int, tuple[list[int], set[int]]] = {}
        for at, a, b in zip(hits.tolist(), low.tolist(), high.tolist(), strict=True):
            for j in range(a, b):
                starts, covered = of_item.setdefault(int(self.owners[j]), ([], set()))
                starts.append(at)
                covered.update(range(int(self.places[j]), int(self.places[j]) + least))
        found = []
        for row, (starts, covered) in sorted(of_item.items()):
            item_id, item = self.items[row]
            if len(covered) < threshold * len(item):
                continue  # tiles cover no word that no seed covers
            positions = sorted({p for s in starts for p in range(s, s + least)})
            breaks = {i for i in range(1, len(positions)) if positions[i] != positions[i - 1] + 1}
            made = tiles(hashes[positions].tolist(), item.tolist(), least, breaks)
            matched = sum(t[2] for t in made)
            if matched >= threshold * len(item):
                in_item = sorted(made, key=lambda t: t[0])
                found.append(
                    {
                        "item_id": item_id, "item_words": len(item), "matched_words": matched,
                        "coverage": matched / len(item), "n_tiles": len(made),
                        "reordered": [t[1] for t in in_item] != sorted(t[1] for t in made),
                    }
                )
        return found


def text_words(column: pa.Array) -> Iterator[np.ndarray]:
    """Word hashes of each text; words are runs of ASCII letters, digits and non-ASCII
    characters, A-Z as a-z."""
    for _, data, offsets in text_blocks(column):
        hashes, bounds = words(data, offsets, NOT_WORD, WORD_VALUES)
        for i in range(len(bounds) - 1):
            yield hashes[bounds[i] : bounds[i + 1]]


def _matcher(shared, least: int, threshold: float):
    """Rows of documents with seeds, and what leaks in them."""
    built = []

    def search(column: pa.Array) -> Iterator[tuple[int, list[dict]]]:
        if not built:
            built.append(Slice(*shared.value, least))
        part = built[0]
        for first, data, offsets in text_blocks(column):
            hashes, bounds = words(data, offsets, NOT_WORD, WORD_VALUES)
            grams, edges = shingles(hashes, bounds, part.least)
            hits = part.hits(grams)
            cuts = np.searchsorted(hits, edges)
            for i in np.flatnonzero(np.diff(cuts)):
                if bounds[i + 1] - bounds[i] < part.least:
                    continue
                own = hits[cuts[i] : cuts[i + 1]] - edges[i]
                found = part.leaks(
                    hashes[bounds[i] : bounds[i + 1]], grams[edges[i] : edges[i + 1]], own, threshold
                )
                if found:
                    yield first + int(i), found

    return search


def _slices(benchmark: DataFrame) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of the benchmark in parts of about ``SLICE_WORDS`` words."""
    items = benchmark.select("item_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, math.ceil(size / 5 / SLICE_WORDS))
    for i in range(count):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == i).collect()
        yield [r[0] for r in rows], [r[1] for r in rows]


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, least: int = LEAST, threshold: float = THRESHOLD
) -> DataFrame:
    """One row per document and item that leaks in it: doc_id, item_id, item_words,
    matched_words, coverage (0 to 1), n_tiles, reordered.

    Words are runs of ASCII letters, digits and non-ASCII characters; A-Z count as a-z.
    Null and empty texts match nothing, nor do items of fewer than ``least`` words, which
    are too short to be evidence. Repeated documents and items give repeated rows, null
    ids are kept. Other columns are ignored; empty tables give an empty result.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    item_kind = benchmark.schema["item_id"].dataType.simpleString()
    item_type = to_arrow_type(benchmark.schema["item_id"].dataType)
    schema = (
        f"doc_id {kind}, item_id {item_kind}, item_words long, matched_words long, coverage double, "
        "n_tiles long, reordered boolean"
    )
    texts = docs.select("doc_id", "text")
    context = docs.sparkSession.sparkContext

    def of_slice(part: tuple[list, list[str]]) -> DataFrame:
        search = _matcher(context.broadcast(part), least, threshold)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = batch.column(0)
                rows = [
                    {"doc_id": ids[i].as_py()} | leak for i, leaks in search(batch.column(1)) for leak in leaks
                ]
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=_arrow(ids.type, item_type))

        return texts.mapInArrow(run, schema)

    return reduce(DataFrame.unionByName, [of_slice(part) for part in _slices(benchmark)])


def _arrow(id_type: pa.DataType, item_type: pa.DataType) -> pa.Schema:
    return pa.schema(
        [("doc_id", id_type), ("item_id", item_type), ("item_words", pa.int64()), ("matched_words", pa.int64()),
         ("coverage", pa.float64()), ("n_tiles", pa.int64()), ("reordered", pa.bool_())]
    )


def drop_leaking(
    docs: DataFrame, benchmark: DataFrame, least: int = LEAST, threshold: float = THRESHOLD
) -> DataFrame:
    """``docs`` without the documents in which an item leaks; all columns stay as they are."""
    context = docs.sparkSession.sparkContext
    mark = "_leaks"
    while mark in docs.columns:
        mark += "_"
    for part in _slices(benchmark):
        search = _matcher(context.broadcast(part), least, threshold)

        def run(batches: Iterator[pa.RecordBatch], search=search) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                leaks = np.zeros(len(batch), bool)
                leaks[[i for i, _ in search(batch.column(batch.schema.get_field_index("text")))]] = True
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaks)], names=[*batch.schema.names, mark])

        marked = docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(mark, BooleanType())]))
        docs = marked.where(~F.col(mark)).drop(mark)
    return docs
