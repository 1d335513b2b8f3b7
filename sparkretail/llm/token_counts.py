"""Token counts of whole texts under a byte-level BPE vocabulary with word ends.

Texts are cut into pre-tokens; the pre-tokens of a batch that are not yet known are held
as one ragged array of symbols. In each round every sequence applies its lowest-ranked
pair, at all its places at once, until no sequence has a pair left. What is counted is the
symbols that survive. Symbols of all sequences move together, so a round is a few array
operations, whatever the number of sequences.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkretail.llm.pretokens import PIECE, Splitter, byte_alphabet, pieces, read_spec, spelled_out

GROUP = PIECE  # characters counted at once
KNOWN = 400_000  # words, and pre-tokens, a task remembers before it starts anew
NEVER = np.iinfo(np.int64).max


def load(path: str) -> dict:
    """Arrays of a tokenizer file: symbols of bytes, ranked pairs and what they become."""
    spec = read_spec(path)
    model, suffix = spec["model"], spec["model"]["end_of_word_suffix"]
    pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
    vocab = model["vocab"]
    letters = byte_alphabet()
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    size = max(vocab.values()) + 1
    keys = np.array([vocab[a] * size + vocab[b] for a, b in pairs], np.int64)
    made = np.array([vocab[a + b] for a, b in pairs], np.int64)
    order = np.argsort(keys)
    return {
        "size": size,
        "inner": np.array([vocab[c] for c in letters], np.int64),
        "last": np.array([vocab[c + suffix] for c in letters], np.int64),
        "keys": keys[order],
        "ranks": np.arange(len(keys))[order],
        "made": made[order],
        "spelled": spelled_out(pattern),
        "specials": [t["content"] for t in spec["added_tokens"]],
    }


def surviving_symbols(tokens: list[bytes], table: dict) -> np.ndarray:
    """Symbols that are left of each byte string after all merges."""
    sizes = np.array([len(t) for t in tokens], np.int64)
    flat = np.frombuffer(b"".join(tokens), np.uint8)
    symbols = table["inner"][flat]
    ends = np.cumsum(sizes)
    symbols[ends - 1] = table["last"][flat[ends - 1]]
    owner = np.repeat(np.arange(len(tokens)), sizes)
    left = sizes.copy()
    keys, ranks, made, size = table["keys"], table["ranks"], table["made"], table["size"]
    while len(symbols):
        pair = np.append(symbols[:-1] * size + symbols[1:], -1)
        pair[:-1][owner[:-1] != owner[1:]] = -1
        at = np.minimum(np.searchsorted(keys, pair), len(keys) - 1)
        rank = np.where(keys[at] == pair, ranks[at], NEVER)
        starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        lengths = np.diff(np.append(starts, len(owner)))
        lowest = np.minimum.reduceat(rank, starts)
        active = lowest < NEVER
        left[owner[starts]] = lengths
        chosen = (rank == np.repeat(lowest, lengths)) & (rank < NEVER)
        # In a run such as a-a-a the pairs overlap: the first, third, ... are merged.
        places = np.flatnonzero(chosen)
        if not len(places):
            break
        new_run = np.append(True, np.diff(places) > 1)
        run_start = places[np.maximum.accumulate(np.where(new_run, np.arange(len(places)), 0))]
        places = places[(places - run_start) % 2 == 0]
        symbols[places] = made[at[places]]
        stay = np.repeat(active, lengths)
        stay[places + 1] = False
        # A finished sequence has its length in `left` and goes.
        symbols, owner = symbols[stay], owner[stay]
    return left


class Counter:
    """Counts tokens of texts; remembers the words it has met and their pre-tokens."""

    def __init__(self, table: dict):
        self.table = table
        self.splitter = Splitter(table["spelled"], table["specials"])
        self.known: dict[str, int] = {}
        self.pre_tokens: dict[str, int] = {}

    def learn(self, new: list[str]) -> None:
        """Counts of words that are not known: their pre-tokens, each counted once."""
        known, split = self.pre_tokens, self.splitter.split
        parts = [split(word) for word in new]
        unknown = list(set().union(*parts).difference(known))
        if unknown:
            left = surviving_symbols([t.encode("utf-8") for t in unknown], self.table)
            known.update(zip(unknown, left.tolist(), strict=True))
        get = known.__getitem__
        self.known.update((w, get(p[0]) if len(p) == 1 else sum(map(get, p))) for w, p in zip(new, parts))

    def counts(self, texts: list[str]) -> list[int]:
        if len(self.known) > KNOWN or len(self.pre_tokens) > KNOWN:
            self.known, self.pre_tokens = {}, {}
        plain, marks = [], []
        for text in texts:
            cut = self.splitter.cut(text)
            plain.append(" ".join(part for part, special in cut if not special))
            marks.append(len(cut) // 2)
        # Each distinct word of the group leaves Arrow once; the others are numbers.
        split = pc.split_pattern(pa.array(plain, pa.large_string()), " ")
        coded = split.values.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        new = [word for word in distinct if word not in self.known]
        if new:
            self.learn(new)
        sizes = np.array([self.known[word] for word in distinct], np.int64)
        before = np.concatenate(([0], np.cumsum(sizes[coded.indices.to_numpy()])))
        return (np.diff(before[split.offsets.to_numpy()]) + marks).tolist()

    def groups(self, texts: list[str]) -> list[int]:
        """Counts of whole texts, worked off in groups of about ``GROUP`` characters."""
        totals = [0] * len(texts)
        held, owners, size = [], [], 0
        for i, text in enumerate(texts):
            for part in pieces(text):
                held.append(part)
                owners.append(i)
                size += len(part)
                if size >= GROUP:
                    for j, n in zip(owners, self.counts(held), strict=True):
                        totals[j] += n
                    held, owners, size = [], [], 0
        for j, n in zip(owners, self.counts(held) if held else [], strict=True):
            totals[j] += n
        return totals


def count_tokens(
    docs: DataFrame,
    path: str,
    limit: int = 2048,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) per row of ``docs``.

    ``path`` is a tokenizer file; the driver reads it and its arrays, about a megabyte,
    go to the executors. Counts are those of the file's own library without added begin
    or end tokens; a special string inside a text is one token. Null and empty texts have
    0 bytes and 0 tokens. Repeated rows and null ids each keep their row; other columns
    are ignored; an empty table gives an empty result. Nothing is shuffled.
    """
    table = docs.sparkSession.sparkContext.broadcast(load(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(table.value)
        for batch in batches:
            totals = counter.groups(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(totals, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    text = F.coalesce(F.col(text_column), F.lit(""))
    chosen = docs.select(
        F.col(id_column).alias("doc_id"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        text.alias("text"),
    )
    kind = chosen.schema["doc_id"].dataType.simpleString()
    counted = chosen.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
