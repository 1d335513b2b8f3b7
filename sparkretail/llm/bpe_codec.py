"""Byte-pair encoding and decoding of whole texts in time linear in their length.

Encoding backtracks: at each place the longest token that stands there, found by an
Aho-Corasick automaton, is taken if it is compatible with the token before it, else the
next shorter one, else the token before gives way. Two tokens
are compatible if merging the letters of both would leave them apart; a row of pairwise
compatible tokens is what merging by rank gives, and it is the only one. A place from
which no row went on is never entered again, so each place is left at most once per token
that starts there. Pairs that were judged are kept in a table.

Decoding looks each id up in a table of offsets into one string of all tokens.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkretail.llm.pretokens import SPECIAL, Splitter, byte_alphabet, pieces, read_spec, spelled_out

KNOWN = 300_000  # words a task remembers before it starts anew
LONGEST_KNOWN = 64  # longer words are encoded at each occurrence
PAIRS = 1_000_000  # judged pairs a task remembers
FLUSH = 16 << 20  # bytes of results in a batch
END = chr(256)  # the letter that stands for the end of a word
ALWAYS = 1 << 40  # beyond every rank


def load(path: str) -> dict:
    """What encoder and decoder need of a tokenizer file."""
    spec = read_spec(path)
    model = spec["model"]
    suffix, vocab = model["end_of_word_suffix"], dict(model["vocab"])
    pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
    pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
    contents = {t["content"]: t["id"] for t in spec["added_tokens"]}
    names = {i: t for t, i in vocab.items()} | {i: t for t, i in contents.items()}
    return {
        "suffix": suffix,
        "vocab": vocab,
        "merges": [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs],
        "spelled": spelled_out(pattern),
        "specials": contents,
        "names": [names.get(i) for i in range(max(names) + 1)],
    }


class Encoder:
    def __init__(self, table: dict):
        self.splitter = Splitter(table["spelled"], list(table["specials"]))
        self.specials = table["specials"]
        letters = byte_alphabet()
        byte_of = {c: chr(b) for b, c in enumerate(letters)}
        vocab, suffix = table["vocab"], table["suffix"]
        self.size = size = len(table["names"])
        self.made = [-1] * size  # rank of the merge that makes a token, -1 for letters
        self.left, self.right = [-1] * size, [-1] * size
        self.rank: dict[int, int] = {}
        for rank, (a, b, made) in enumerate(table["merges"]):
            if self.made[made] >= 0:
                raise ValueError("a token that two merges make is not supported")
            self.made[made], self.left[made], self.right[made] = rank, a, b
            self.rank[a * size + b] = rank
        self.pairs: dict[int, bool] = {}
        self.known: dict[str, bytes] = {}
        self.encoded: dict[str, list[int]] = {}
        spelled = {}
        for token in [*letters, *(c + suffix for c in letters), *(t for t in vocab if self.made[vocab[t]] >= 0)]:
            number, end = vocab[token], token.endswith(suffix) and token != suffix
            body = token[: -len(suffix)] if end else token
            # A token that its own letters do not merge to never comes out.
            if self.made[number] < 0 or self._apart(self.left[number], self.right[number], self.made[number]):
                spelled["".join(byte_of[c] for c in body) + END * end] = number
        self.length = [0] * size
        self.shorter = [-1] * size  # the longest token that starts a token
        automaton = ahocorasick.Automaton()
        for text, number in spelled.items():
            self.length[number] = len(text)
            automaton.add_word(text, number)
            self.shorter[number] = next((spelled[text[:k]] for k in range(len(text) - 1, 0, -1) if text[:k] in spelled), -1)
        automaton.make_automaton()
        self.reach = max(self.length)
        self.matches = automaton.iter_long  # longest tokens, each from where the last ended

    def _apart(self, left: int, right: int, before: int = ALWAYS) -> bool:
        """Whether no merge ranked below ``before`` crosses the border of two tokens.

        The later of the two tokens' last merges is undone until both are letters. While
        a pair stood at the border, it was merged if its rank came first; of equal ranks
        the left one is merged first.
        """
        made, rank, size = self.made, self.rank, self.size
        while True:
            if rank.get(left * size + right, ALWAYS) < before:
                return False
            if made[left] > made[right]:
                before, left = made[left], self.right[left]
            elif made[right] >= 0:
                before, right = made[right] + 1, self.left[right]
            else:
                return True

    def compatible(self, left: int, right: int) -> bool:
        key = left * self.size + right
        found = self.pairs.get(key)
        if found is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            found = self.pairs[key] = self._apart(left, right)
        return found

    def encode(self, pre_token: str) -> list[int]:
        """Tokens of one pre-token, which is not empty."""
        text = pre_token.encode("utf-8").decode("latin-1") + END
        size, vocabulary, judged = len(text), self.size, self.pairs.get

        def fits(token: int) -> bool:
            if not out:
                return True
            found = judged(out[-1] * vocabulary + token)
            return self.compatible(out[-1], token) if found is None else found

        # Longest matches one after the other are most often the answer.
        out: list[int] = []
        at, token = 0, -1
        for last, token in self.matches(text):
            if not fits(token):
                break
            out.append(token)
            at = last + 1
        else:
            token = -1
        if at == size:
            return out
        length, shorter = self.length, self.shorter
        open_ = bytearray(b"\1") * (size + 1)
        open_[size - 1] = 0  # the end of the word is no token of its own
        while True:
            token = shorter[token] if token >= 0 else -1
            while token < 0:
                open_[at] = 0
                last = out.pop()
                at -= length[last]
                token = shorter[last]
            while open_[at + length[token]] and fits(token):
                out.append(token)
                at += length[token]
                if at == size:
                    return out
                token = next(self.matches(text[at : at + self.reach]))[1]

    def word(self, word: str) -> bytes:
        """Ids of what stands between two spaces, as little-endian 32-bit integers."""
        if word.startswith(SPECIAL):
            return struct.pack("<I", self.specials[word[1:]])
        ids: list[int] = []
        for token in self.splitter.split(word):
            if len(token) > LONGEST_KNOWN:
                ids += self.encode(token)
            else:
                found = self.encoded.get(token)
                if found is None:
                    found = self.encoded[token] = self.encode(token)
                ids += found
        return struct.pack(f"<{len(ids)}I", *ids)

    def text(self, text: str) -> bytes:
        known, out = self.known, []
        for piece in pieces(text):
            if len(known) > KNOWN or len(self.encoded) > KNOWN:
                known.clear()
                self.encoded.clear()
            found = self.splitter.words(piece)
            new = set(found).difference(known)
            once = {w for w in new if len(w) > LONGEST_KNOWN}
            known.update((w, self.word(w)) for w in new - once)
            if once:
                out += [self.word(w) if w in once else known[w] for w in found]
            else:
                out += map(known.__getitem__, found)
        return b"".join(out)


class Decoder:
    def __init__(self, table: dict):
        parts = [b"" if n is None else b" " + n.encode("utf-8") for n in table["names"]]
        # Ids without a token, and one past the end for ids beyond the table, are empty.
        self.offsets = np.concatenate(([0], np.cumsum([len(p) for p in parts] + [0])))
        self.letters = np.frombuffer(b"".join(parts), np.uint8)

    def text(self, ids: bytes) -> str:
        """The tokens with a space between them."""
        numbers = np.frombuffer(ids, "<u4")
        out = []
        for start in range(0, len(numbers), 1 << 20):
            part = np.minimum(numbers[start : start + (1 << 20)], len(self.offsets) - 2)
            first = self.offsets[part]
            sizes = self.offsets[part + 1] - first
            ends = np.cumsum(sizes)
            places = np.arange(ends[-1]) + np.repeat(first - (ends - sizes), sizes)
            out.append(self.letters[places].tobytes())
        return b"".join(out)[1:].decode("utf-8")


def _mapped(df: DataFrame, path: str, id_column: str, value: Column, results: dict[str, str], make) -> DataFrame:
    """``doc_id`` and the results of ``make(tables)(value)`` for each row, in batches of
    bounded size. Nothing is shuffled; a worker keeps what it made between its tasks."""
    chosen = df.select(F.col(id_column).alias("doc_id"), value.alias("value"))
    id_kind = chosen.schema["doc_id"].dataType.simpleString()
    held = df.sparkSession.sparkContext.broadcast({"tables": load(path)})
    kinds = [pa.binary() if kind == "binary" else pa.string() for kind in results.values()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = held.value
        convert = tables.get("made") or tables.setdefault("made", make(tables["tables"]))
        for batch in batches:
            start, out, size = 0, [], 0
            for i, item in enumerate(batch.column(1)):
                out.append(convert(item.as_py()))
                size += sum(map(len, out[-1]))
                if size >= FLUSH or i == len(batch) - 1:
                    columns = [pa.array(c, kind) for c, kind in zip(zip(*out), kinds)]
                    ids = batch.column(0).slice(start, len(out))
                    yield pa.RecordBatch.from_arrays([ids, *columns], names=["doc_id", *results])
                    start, out, size = i + 1, [], 0

    return chosen.mapInArrow(run, ", ".join([f"doc_id {id_kind}", *(f"{n} {k}" for n, k in results.items())]))


def encode_texts(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, ids) per row of ``docs``: the token ids of the whole text as little-endian
    unsigned 32-bit integers, as the library of the tokenizer file at ``path`` gives them
    without added begin or end tokens. A special string inside a text is its own token.

    Null and empty texts have no ids. Repeated rows and null ids each keep their row; a
    very long text is worked off in pieces that end at spaces, a very long word at once.
    Other columns are ignored, whatever their names; an empty table gives an empty result.
    Nothing is shuffled; the vocabulary, a few megabytes, is sent to the executors.
    """

    def make(tables: dict):
        encode = Encoder(tables).text
        return lambda text: (encode(text),)

    text = F.coalesce(F.col(text_column), F.lit(""))
    return _mapped(docs, path, id_column, text, {"ids": "binary"}, make)


def decode_ids(encoded: DataFrame, path: str, id_column: str = "doc_id", ids_column: str = "ids") -> DataFrame:
    """(doc_id, decoded) per row: the tokens of ``ids`` as text, special ones included, a
    space between them, word-end marks kept, as the library's decode gives them for a file
    without a decoder.

    Ids that the vocabulary does not hold are left out. Null and empty ids give an empty
    text. Repeated rows, null ids of documents, other columns and empty tables as in
    ``encode_texts``.
    """

    def make(tables: dict):
        decode = Decoder(tables).text
        return lambda ids: (decode(ids),)

    ids = F.coalesce(F.col(ids_column), F.lit(b""))
    return _mapped(encoded, path, id_column, ids, {"decoded": "string"}, make)


def round_trip(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, ids, decoded) per row: ``encode_texts`` and ``decode_ids`` of its result in
    one pass."""

    def make(tables: dict):
        encode, decode = Encoder(tables).text, Decoder(tables).text

        def convert(text: str) -> tuple[bytes, str]:
            ids = encode(text)
            return ids, decode(ids)

        return convert

    text = F.coalesce(F.col(text_column), F.lit(""))
    return _mapped(docs, path, id_column, text, {"ids": "binary", "decoded": "string"}, make)
