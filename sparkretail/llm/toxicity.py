"""Toxicity of documents, also where the words are disguised.

1. A character language model counts letter trigrams over all documents.
2. A lexicon of word beginnings and words is learnt from a bounded sample of labels.
3. Every text is searched for the lexicon. Every run without white space and every row of
   letters set apart, of any length, is a character lattice: a sign offers the letters it
   may stand for, none, or the end of a word, a letter that repeats offers to be left out,
   a letter of another script offers its Latin double, all at the cost of a noisy channel.
   Viterbi decoding under the language model restores the likeliest reading, which is
   searched as well. A lattice with one path only is its own reading and is not decoded.
4. The score is a noisy-or over the lexicon entries found.
"""

from __future__ import annotations

import math
import os
import re
import unicodedata
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from sparkretail.llm.common import durable, held_out, unused
from sparkretail.llm.labelled import training_rows
from sparkretail.llm.shingles import mix, text_shingles

SAMPLE = 12_000  # labelled documents the lexicon is learnt from, at most
SHORTEST, LONGEST = 4, 8  # letters of a word beginning
PRECISION = 0.85  # share of toxic documents among those with an entry
SUPPORT = 0.02  # share of the toxic sample that an entry must occur in
LEAST_SUPPORT = 4
ENTRIES = 5_000
CHUNK = 1 << 20
PART = 100_000  # features that a task counts before it hands them on

# Signs and the letters they commonly stand for.
STANDS_FOR = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "(": "c", "¡": "i",
}
ANY = "abcdefghijklmnopqrstuvwxyz"
# Cyrillic and Greek letters that look like Latin ones.
LOOKS_LIKE = {
    "а": "a", "в": "b", "е": "e", "з": "z", "і": "i", "ј": "j", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p",
    "с": "c", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԁ": "d", "ո": "n", "α": "a", "ε": "e", "ι": "i", "κ": "k",
    "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
}
ANY = "abcdefghijklmnopqrstuvwxyz"
# Costs of the channel, in nats: a sign or a foreign letter for a letter, a masked letter,
# a sign put in, a letter repeated (in a run of three or more, and once), a gap between
# letters set apart, the end of a word at a gap, at a sign, at other punctuation.
SIGN, MASKED, EXTRA, REPEAT, TWICE, GAP = 1.0, 1.5, 2.5, 0.3, 2.0, 0.1
SPACED, AT_SIGN, AT_MARK = 0.1, 2.5, 0.0
NUMBER = 12  # more signs or digits in a row are a number or a rule, not letters

LETTER = r"[^\W\d_]"
APART = re.compile(
    rf"(?<![\w@$])(?:(?:{LETTER}|[0-9@$!])[ .\-_*~]{{1,2}}){{2,}}(?:{LETTER}|[0-9@$!])(?![\w@$])"
)
WORDS = re.compile(rf"{LETTER}+")
TOKENS = re.compile(r"\S+")
EDGES = re.compile(r"^[^\w@$€]+|[^\w@$€]+$")
# Where a lattice branches: a sign, a repeated letter, a letter that has a double.
BRANCHES = re.compile(rf"[\W\d_]|({LETTER})\1|[{''.join(LOOKS_LIKE)}]|[\uff21-\uff5a]", re.I)
KEPT = 64  # readings of tokens up to this length are remembered, longer ones decoded anew
REMEMBERED = 500_000

# ---- character language model ----
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(chr(c) for c in range(0xDF, 0x100) if c != 0xF7)
OTHER = len(LETTERS) + 1
SIZE = len(LETTERS) + 2


def _codes() -> np.ndarray:
    """Code of each character below U+0250: 0 is no letter."""
    table = np.zeros(0x250, np.uint8)
    for c in range(0x250):
        low = chr(c).lower()
        if low in LETTERS:
            table[c] = LETTERS.index(low) + 1
        elif chr(c).isalpha():
            table[c] = OTHER
    return table


CODES = _codes()


def encode(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(points < len(CODES), CODES[np.minimum(points, len(CODES) - 1)], OTHER).astype(np.int32)


def _trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(SIZE**3, np.int64)

    def add(text: str) -> None:
        c = encode(text)
        counts[:] += np.bincount(c[:-2] * SIZE * SIZE + c[1:-1] * SIZE + c[2:], minlength=SIZE**3)

    for batch in batches:
        held, size = [], 0
        for text in batch.column(0).to_pylist():
            for start in range(0, len(text), CHUNK):
                # The next part repeats two characters, so no trigram is lost or counted twice.
                held.append(text[start : start + CHUNK + 2])
                size += len(held[-1])
                if size >= CHUNK:
                    add("\n\n" + "\n\n".join(held) + "\n\n")
                    held, size = [], 0
        if held:
            add("\n\n" + "\n\n".join(held) + "\n\n")
    seen = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], names=["code", "n"])


def trigram_counts(docs: DataFrame, text_column: str = "text") -> np.ndarray:
    """Letter trigrams of all texts; the array's size is fixed by the alphabet."""
    texts = docs.select(F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    rows = (
        texts.mapInArrow(_trigrams, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).toArrow()
    )
    counts = np.zeros(SIZE**3)
    counts[rows.column("code").to_numpy()] = rows.column("n").to_numpy()
    return counts


def language_model(counts: np.ndarray, lexicon: dict[str, float], share: float = 0.4) -> np.ndarray:
    """-log P(letter | two before): the corpus mixed with the spelling of the lexicon."""

    def conditional(c):
        c = c.reshape(SIZE, SIZE, SIZE) + 0.01
        two = c / c.sum(2, keepdims=True)
        one = c.sum(0) / c.sum((0, 2), keepdims=False)[:, None]
        return 0.9 * two + 0.1 * one[None]

    spelled = np.zeros(SIZE**3)
    for entry in lexicon:
        whole = entry.endswith("$")
        c = encode("  " + entry.rstrip("$") + ("  " if whole else ""))
        np.add.at(spelled, c[:-2] * SIZE * SIZE + c[1:-1] * SIZE + c[2:], 1.0)
    mixed = (1 - share) * conditional(counts) + share * conditional(spelled) if lexicon else conditional(counts)
    return -np.log(mixed).astype(np.float64)


# ---- decoding ----
def lattice(token: str, apart: bool) -> Iterator[list[tuple[str, float]]]:
    """For each character of a token the letters it may stand for, with costs; "" is no
    letter and a space the end of a word."""
    low = unicodedata.normalize("NFKC", token).lower()
    run_end = 0
    for i, c in enumerate(low):
        if c.isalpha():
            options = [(c, 0.0)]
            if c in LOOKS_LIKE:
                options.append((LOOKS_LIKE[c], SIGN))
            if i and c == low[i - 1]:
                options.append(("", REPEAT if c * 3 in low[max(0, i - 2) : i + 3] else TWICE))
            yield options
            continue
        if i >= run_end:  # measure each run of signs once
            run_end = i + 1
            while run_end < len(low) and not low[run_end].isalpha():
                run_end += 1
            long_run = run_end - i > NUMBER and not apart
        if long_run:
            yield [(" ", 0.0)]
        elif c in STANDS_FOR:
            yield [(x, SIGN) for x in STANDS_FOR[c]] + [("", EXTRA), (" ", AT_SIGN)]
        elif apart:
            yield [("", GAP), (" ", SPACED)]
        elif c in "*#":
            yield [("", EXTRA), (" ", AT_SIGN)] + [(x, MASKED) for x in ANY]
        else:
            yield [("", EXTRA), (" ", AT_MARK)]


INDEX = {c: i + 1 for i, c in enumerate(LETTERS)} | {" ": 0}


def decode(token: str, model: np.ndarray, apart: bool = False) -> str:
    """The likeliest reading of a token. Ties go to the smaller string.

    What all surviving paths share is set down as soon as it is decided, so time grows
    with the length and memory with the undecided rest."""
    settled: list[str] = []
    best = {(0, 0): (0.0, "")}
    for step, options in enumerate(lattice(token, apart)):
        new: dict[tuple[int, int], tuple[float, str]] = {}
        for (a, b), (cost, text) in best.items():
            for letter, price in options:
                if letter == " " and b == 0:  # no empty words
                    state, found = (a, b), (cost + price, text)
                elif letter:
                    code = INDEX.get(letter, OTHER)
                    state, found = (b, code), (cost + price + model[a, b, code], text + letter)
                else:
                    state, found = (a, b), (cost + price, text)
                if state not in new or found < new[state]:
                    new[state] = found
        best = new
        if len(best) == 1 or step % KEPT == KEPT - 1:
            shared = os.path.commonprefix([text for _, text in best.values()])
            settled.append(shared)
            best = {state: (cost, text[len(shared) :]) for state, (cost, text) in best.items()}
    ends = [(cost + model[a, b, 0], text) for (a, b), (cost, text) in best.items()]
    return "".join(settled) + min(ends)[1]


FOLD = str.maketrans(LOOKS_LIKE)
NOT_LETTERS = re.compile(r"[\W\d_]+")
REPEATED = re.compile(r"(.)\1+")
SUPPLY = re.compile(f"[{re.escape(''.join(STANDS_FOR))}*#]")  # signs that may become letters


def skeleton(word: str) -> str:
    """Letters only, foreign doubles replaced, each run of a letter once. If no sign of a
    token may become a letter, the skeleton of each entry in any of its readings is a part
    of the token's own."""
    low = unicodedata.normalize("NFKC", word).lower().translate(FOLD)
    return REPEATED.sub(r"\1", NOT_LETTERS.sub("", low))


def branching(token: str) -> str:
    """The part of a token that has several readings to choose from, or "". Numbers and
    signs without any letter are no words."""
    core = EDGES.sub("", token)
    return core if BRANCHES.search(core) and WORDS.search(core) else ""


# ---- lexicon ----
def word_features(text: str) -> set[str]:
    """Beginnings of the words of a text and, marked by $, whole words."""
    found = set()
    for word in set(WORDS.findall(text.lower())):
        found.update(word[:k] for k in range(SHORTEST, min(LONGEST, len(word)) + 1))
        if len(word) >= 3:
            found.add(word + "$")
    return found


def _feature_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of either kind per feature, handed on in parts of bounded size."""

    def part(counts: dict[str, list[int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array([c[1] for c in counts.values()], pa.int64()),
             pa.array([c[0] for c in counts.values()], pa.int64())],
            names=["feature", "toxic", "clean"],
        )

    counts: dict[str, list[int]] = {}
    for batch in batches:
        for text, y in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
            for feature in word_features(text.as_py()):
                counts.setdefault(feature, [0, 0])[y] += 1
            if len(counts) >= PART:
                yield part(counts)
                counts = {}
    yield part(counts)


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the smallest shingle hash of each text: near copies mostly share it."""
    for batch in batches:
        least = np.zeros(len(batch), np.int64)
        for first, grams, edges in text_shingles(batch.column(0)):
            for i in range(len(edges) - 1):
                own = grams[edges[i] : edges[i + 1]]
                if len(own):
                    least[first + i] = mix(own).min().view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(least)], names=["text", "y", "sketch"]
        )


def prune(found: list[tuple[str, int, int]]) -> dict[str, float]:
    """Entries and their precision. Of a chain of beginnings the longest that keeps nearly
    all toxic documents of the shorter one stays, and nothing that it begins."""
    support = {f: t for f, t, _ in found}
    precision = {f: (t + 0.5) / (t + c + 1) for f, t, c in found}

    def narrower(feature: str) -> bool:
        """A longer entry covers the same documents."""
        need = 0.95 * support[feature]
        return any(
            other != feature and other.startswith(feature.rstrip("$")) and support[other] >= need
            and len(other) > len(feature)
            for other in support
        )

    kept: dict[str, float] = {}
    if not found:
        return kept
    for feature in sorted(support, key=lambda f: (len(f.rstrip("$")), f)):
        if narrower(feature) or any(feature.startswith(k) for k in kept if not k.endswith("$")):
            continue
        kept[feature] = precision[feature]
    return kept


def learn(docs: DataFrame, labels: DataFrame) -> dict:
    """The lexicon with precisions, the language model, and the share of toxic documents
    among those without an entry."""
    sample = training_rows(docs, labels, "toxic", SAMPLE).select("text", "y")
    sample = durable(
        sample.mapInArrow(_sketched, "text string, y int, sketch long").dropDuplicates(["sketch", "y"])
    ).select("text", "y")
    n, toxic = sample.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
    least = max(LEAST_SUPPORT, math.ceil(SUPPORT * toxic))
    rows = (
        sample.mapInArrow(_feature_counts, "feature string, toxic long, clean long")
        .groupBy("feature")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .where(F.col("toxic") >= least)
        .where((F.col("toxic") + 0.5) / (F.col("toxic") + F.col("clean") + 1) >= PRECISION)
        .orderBy(F.desc("toxic"), "feature")
        .limit(ENTRIES)
        .collect()
    )
    lexicon = prune([(r[0], r[1], r[2]) for r in rows])
    model = language_model(trigram_counts(docs), lexicon)
    finder = Finder({"lexicon": lexicon, "model": model, "rest": 0.0})
    missed = sample.mapInArrow(finder.unmatched, "y int").agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
    return {"lexicon": lexicon, "model": model, "rest": (missed[1] + 0.5) / (missed[0] + 10)}


class Finder:
    """Searches texts for the entries of a lexicon, as written and as restored."""

    def __init__(self, learnt: dict):
        self.learnt = learnt
        self.automaton = None
        self.skeletons = None
        self.without: set[str] = set()  # tokens whose readings hold no entry
        self.restored: dict[tuple[str, bool], frozenset[str]] = {}

    def _entries(self, low: str, anywhere: bool = False) -> set[str]:
        if self.automaton is None:
            self.automaton = ahocorasick.Automaton()
            for entry in self.learnt["lexicon"]:
                self.automaton.add_word(entry.rstrip("$"), [])
            for entry in self.learnt["lexicon"]:
                self.automaton.get(entry.rstrip("$")).append(entry)
            self.automaton.make_automaton()
        found = set()
        for end, entries in self.automaton.iter(low):
            start = end + 1 - len(entries[0].rstrip("$"))
            if start and low[start - 1].isalpha() and not anywhere:
                continue
            closed = anywhere or end + 1 == len(low) or not low[end + 1].isalpha()
            found.update(e for e in entries if closed or not e.endswith("$"))
        return found

    def _possible(self, token: str) -> bool:
        """False only if no reading of the token can hold an entry."""
        if SUPPLY.search(unicodedata.normalize("NFKC", token)):
            return True
        if self.skeletons is None:
            self.skeletons = ahocorasick.Automaton()
            for entry in self.learnt["lexicon"]:
                self.skeletons.add_word(skeleton(entry), None)
            self.skeletons.make_automaton()
        return next(self.skeletons.iter(skeleton(token)), None) is not None

    def find(self, text: str) -> tuple[set[str], set[str]]:
        """Entries as written, and further ones as restored."""
        if not self.learnt["lexicon"]:
            return set(), set()
        written = self._entries(text.lower())
        tokens = set(text.split() if len(text) < CHUNK else map(re.Match.group, TOKENS.finditer(text)))
        restored = set()
        for token in tokens.difference(self.without):
            restored |= self._restored(token, False)
        for m in APART.finditer(text):
            restored |= self._restored(m.group(), True)
        return written, restored - written

    def _restored(self, token: str, apart: bool) -> frozenset[str]:
        """The entries in the reading of a token. Where letters stand apart the reading
        does not tell where words begin, so an entry may stand anywhere in it."""
        found = self.restored.get((token, apart))
        if found is not None:
            return found
        core = token if apart else branching(token)
        if not core or not self._possible(core):
            found = frozenset()
        else:
            found = frozenset(self._entries(decode(core, self.learnt["model"], apart), apart))
        if len(token) <= KEPT:
            if len(self.without) + len(self.restored) > REMEMBERED:
                self.without.clear()
                self.restored.clear()
            if found or apart:
                self.restored[token, apart] = found
            else:
                self.without.add(token)
        return found

    def score(self, text: str) -> float:
        written, restored = self.find(text)
        precision = self.learnt["lexicon"]
        clean = 1 - self.learnt["rest"]
        for entry in written:
            clean *= 1 - precision[entry]
        for entry in restored:
            clean *= 1 - 0.9 * precision[entry]
        return 1 - clean

    def unmatched(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left = [
                y for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
                if not any(self.find(text))
            ]
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int32())], names=["y"])


def with_score(docs: DataFrame, learnt: dict, text_column: str = "text", column: str = "score") -> DataFrame:
    """``docs`` with the toxicity of each text, 0 to 1; a null text counts as empty."""
    shared = docs.sparkSession.sparkContext.broadcast(learnt)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(shared.value)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_column)).to_pylist()
            scores = pa.array([finder.score(t or "") for t in texts], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], names=[*batch.schema.names, column])

    schema = StructType([*docs.schema.fields, StructField(column, DoubleType())])
    return docs.mapInArrow(run, schema)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of ``docs(doc_id, text)``.

    The labels of held-out rows are not read, and neither labels nor ids, languages or
    sources are inputs of a score. Null and empty texts have the score of a document
    without any entry. Repeated rows and null ids keep their rows. Without labels, or
    without a toxic one, the lexicon is empty and all texts have the same score. Texts and
    words of any length are read whole; of readings with the same cost the smaller string
    counts. More than ``NUMBER`` signs or digits in a row, and tokens without any letter,
    are numbers or rules and not read as letters. Other columns are ignored; an empty
    table gives an empty result.
    """
    learnt = learn(docs, labels)
    scored = with_score(docs.select("doc_id", "text"), learnt)
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows that are predicted toxic; all columns stay as they are."""
    column = unused(docs, "_score")
    scored = with_score(docs, learn(docs, labels), column=column)
    return scored.where(F.col(column) < 0.5).drop(column)
