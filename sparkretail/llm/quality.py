"""Quality of documents from the quality of their lines.

A linear-chain conditional random field labels every line good or bad. A line's features
are computed from its own characters and words and from those of its two neighbours; the
two transition weights make labels run in stretches. Forward-backward gives each line its
marginal, and the marginals, weighted by the bytes of the lines, make up the document's
share of good text, which a logistic function turns into the score.

The field is fitted on a bounded sample of labelled documents. Lines have no labels of
their own: they start with that of their document, and the lines of low-quality documents
are labelled anew by the fitted field, since such a document may have good lines.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from sparkretail.llm.common import held_out
from sparkretail.llm.labelled import training_rows
from sparkretail.llm.shingles import SPACE, SPACE_VALUES, U64, mix, text_blocks, words

SAMPLE = 6_000  # labelled documents the field is fitted on, at most
LONGEST_SAMPLE = 1 << 16  # bytes of a document of the sample, at most
STEPS, ROUNDS, RATE, RIDGE = 150, 2, 0.1, 1e-4

_codes = np.arange(256)
_CLASSES = {
    "upper": (_codes >= 65) & (_codes <= 90),
    "lower": (_codes >= 97) & (_codes <= 122),
    "digit": (_codes >= 48) & (_codes <= 57),
    "space": SPACE,
    "stop": np.isin(_codes, [ord(c) for c in ".,;:?'\"()-"]),
    "sign": np.isin(_codes, [ord(c) for c in "!#$%&*+/<=>@[\\]^_`{|}~"]),
    "bar": _codes == ord("|"),
    "beyond": _codes >= 128,
}
FEATURES = [*_CLASSES, "length", "word_length", "distinct", "stutter", "signed_words", "seen_before", "recurring"]


def line_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features per line, bytes per line, first line of each text and the end).

    Lines end at line feeds. Every text has at least one line, an empty text an empty one.
    """
    breaks = np.flatnonzero(data == 10)
    # A line starts at each text and after each line feed inside a text.
    after = breaks + 1
    owner = np.searchsorted(offsets, breaks, "right") - 1
    after = after[after <= offsets[owner + 1]] if len(breaks) else after
    texts = np.arange(len(offsets) - 1)
    begin = np.concatenate([offsets[:-1], after])
    of_text = np.concatenate([texts, owner])
    order = np.lexsort((begin, of_text))
    begin, of_text = begin[order], of_text[order]
    bounds = np.searchsorted(of_text, np.arange(len(offsets)))
    end = np.empty_like(begin)
    end[:-1] = begin[1:] - 1
    last = bounds[1:] - 1
    end[last] = offsets[1:]
    size = np.maximum(end - begin, 0)

    columns = []
    safe = np.maximum(size, 1)
    for members in _CLASSES.values():
        summed = np.concatenate(([0], np.cumsum(members[data], dtype=np.int64)))
        columns.append((summed[begin + size] - summed[begin]) / safe)
    hashes, _ = words(data, offsets, SPACE, SPACE_VALUES)
    edges = _word_edges(data, begin, size)
    count = np.diff(edges)
    some = np.maximum(count, 1)
    line_of = np.repeat(np.arange(len(begin)), count)
    inked = size * (1 - columns[3])
    columns += [np.log1p(size), np.log1p(inked / some)]
    # Distinct words, words that repeat the one before, words that end in a sign.
    keyed = mix(hashes ^ mix(line_of.astype(U64) + U64(1)))
    sorted_keys = np.sort(keyed)
    order = np.argsort(keyed, kind="stable")
    first = np.append(True, sorted_keys[1:] != sorted_keys[:-1])[: len(keyed)]
    columns.append(np.bincount(line_of[order][first], minlength=len(begin)) / some)
    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (line_of[1:] == line_of[:-1])
    columns.append(np.bincount(line_of[same], minlength=len(begin)) / some)
    inside = ~SPACE[data]
    ends = np.flatnonzero(inside & np.append(~inside[1:], True)) if len(data) else np.zeros(0, np.int64)
    signed = _CLASSES["sign"][data[ends]] if len(data) else np.zeros(0, bool)
    at = np.searchsorted(begin, ends[signed], "right") - 1
    columns.append(np.minimum(1.0, np.bincount(at, minlength=len(begin)) / some))
    # Lines, and words of a text, that occur before in the text.
    line_hash = np.zeros(len(begin), U64)
    if len(hashes):
        with_end = np.append(hashes * (2 * _within(edges, count).astype(U64) + U64(1)), U64(0))
        line_hash = np.where(count > 0, np.add.reduceat(with_end, np.minimum(edges[:-1], len(hashes))), U64(0))
    columns.append((_repeats(line_hash, of_text) & (count > 0)).astype(float))
    text_of_word = of_text[line_of]
    again = _repeats(hashes, text_of_word)
    columns.append(np.bincount(line_of[again], minlength=len(begin)) / some)
    return np.column_stack(columns).astype(np.float32), size, bounds


def _word_edges(data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Where the words of each line begin in the list of all words."""
    if not len(data):
        return np.zeros(len(begin) + 1, np.int64)
    inside = ~SPACE[data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    heads = begin[(size > 0)]
    starts[heads] = inside[heads]
    positions = np.flatnonzero(starts)
    return np.append(np.searchsorted(positions, begin), len(positions))


def _within(edges: np.ndarray, count: np.ndarray) -> np.ndarray:
    return np.arange(int(count.sum())) - np.repeat(edges[:-1], count)


def _repeats(values: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Entries whose value occurs earlier in their group."""
    keyed = mix(values ^ mix(group.astype(U64) + U64(7)))
    order = np.argsort(keyed, kind="stable")
    repeated = np.zeros(len(values), bool)
    if len(values):
        repeated[order[1:]] = keyed[order[1:]] == keyed[order[:-1]]
    return repeated


def with_neighbours(features: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Own features, those of the line before and after (zero at the ends), and a constant."""
    before, behind = np.zeros_like(features), np.zeros_like(features)
    before[1:], behind[:-1] = features[:-1], features[1:]
    before[bounds[:-1]], behind[bounds[1:] - 1] = 0, 0
    return np.hstack([features, before, behind, np.ones((len(features), 1), features.dtype)])


def _by_position(bounds: np.ndarray) -> list[np.ndarray]:
    """For each position the lines there, texts with many lines first."""
    count = np.diff(bounds)
    order = np.argsort(-count, kind="stable")
    count, first = count[order], bounds[:-1][order]
    alive = np.searchsorted(-count, -np.arange(1, int(count.max(initial=0)) + 1), "right")
    return [first[: alive[t]] + t for t in range(len(alive))]


def forward_backward(unary: np.ndarray, stay: np.ndarray, bounds: np.ndarray):
    """Marginals of "good" and, for gradients, expected good-good and bad-bad transitions.

    The state before and after a line is carried as a log-ratio good : bad.
    """
    good, bad = stay
    places = _by_position(bounds)
    ahead, back = unary.copy(), np.zeros_like(unary)
    for t in range(1, len(places)):
        here = places[t]
        r = ahead[here - 1]
        ahead[here] += np.logaddexp(r + good, 0) - np.logaddexp(r, bad)
    for t in range(len(places) - 1, 0, -1):
        here = places[t]
        v = unary[here] + back[here]
        back[here - 1] = np.logaddexp(good + v, 0) - np.logaddexp(v, bad)
    marginal = 1 / (1 + np.exp(-np.clip(ahead + back, -500, 500)))
    inner = np.ones(len(unary), bool)
    inner[bounds[:-1]] = False
    here = np.flatnonzero(inner)
    v, r = unary[here] + back[here], ahead[here - 1]
    scores = np.stack([r + good + v, r, v, np.full_like(v, bad)])
    scores -= scores.max(0)
    weights = np.exp(scores)
    weights /= weights.sum(0)
    return marginal, np.array([weights[0].sum(), weights[3].sum()]), here


def fit(features: np.ndarray, sizes: np.ndarray, bounds: np.ndarray, y: np.ndarray) -> dict:
    """The field and its calibration from documents with labels ``y``."""
    mean, spread = features.mean(0), features.std(0) + 1e-6
    x = with_neighbours(np.clip((features - mean) / spread, -5, 5), bounds).astype(np.float64)
    weights, stay = np.zeros(x.shape[1]), np.zeros(2)
    count = np.diff(bounds)
    document = np.repeat(np.arange(len(y)), count)
    line_y = y[document].astype(float)
    n = len(line_y)
    for round_ in range(ROUNDS):
        moments = [np.zeros(len(weights) + 2), np.zeros(len(weights) + 2)]
        for step in range(1, STEPS + 1):
            marginal, expected, inner = forward_backward(x @ weights, stay, bounds)
            now, before = line_y[inner] > 0.5, line_y[inner - 1] > 0.5
            seen = np.array([(now & before).sum(), (~now & ~before).sum()])
            slope = np.append(x.T @ (line_y - marginal), seen - expected) / n
            slope -= RIDGE * np.append(weights, stay)
            moments[0] = 0.9 * moments[0] + 0.1 * slope
            moments[1] = 0.99 * moments[1] + 0.01 * slope**2
            change = RATE * (moments[0] / (1 - 0.9**step)) / (np.sqrt(moments[1] / (1 - 0.99**step)) + 1e-8)
            weights, stay = weights + change[:-2], np.clip(stay + change[-2:], -4, 4)
        if round_ < ROUNDS - 1:
            # The lines of a low document are what the field takes them for, its worst line bad.
            marginal = forward_backward(x @ weights, stay, bounds)[0]
            worst = np.minimum.reduceat(marginal, bounds[:-1])
            low = y[document] == 0
            line_y = np.where(low, (marginal > 0.5) & (marginal > worst[document]), 1.0).astype(float)
    model = {"mean": mean, "spread": spread, "weights": weights, "stay": stay}
    share = good_share(model, features, sizes, bounds)
    return model | {"scale": _logistic(_logit(share), y)}


def _logit(share: np.ndarray) -> np.ndarray:
    kept = np.clip(share, 1e-4, 1 - 1e-4)
    return np.log(kept / (1 - kept))


def _logistic(z: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Intercept and slope of a one-variable logistic regression (Newton steps)."""
    design = np.column_stack([np.ones_like(z), z])
    beta = np.zeros(2)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        hessian = design.T @ (design * (p * (1 - p))[:, None]) + 1e-3 * np.eye(2)
        beta = beta + np.linalg.solve(hessian, design.T @ (y - p) - 1e-3 * beta)
    return beta


def good_share(model: dict, features: np.ndarray, sizes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Share of good text: marginals weighted by the bytes of the lines, one more each."""
    x = with_neighbours(np.clip((features - model["mean"]) / model["spread"], -5, 5), bounds)
    marginal = forward_backward(x.astype(np.float64) @ model["weights"], model["stay"], bounds)[0]
    weight = sizes + 1.0
    return np.add.reduceat(marginal * weight, bounds[:-1]) / np.add.reduceat(weight, bounds[:-1])


def scores(model: dict, column: pa.Array) -> np.ndarray:
    out = np.zeros(len(column))
    for first, data, offsets in text_blocks(column):
        features, sizes, bounds = line_features(data, offsets)
        z = _logit(good_share(model, features, sizes, bounds))
        a, b = model["scale"]
        out[first : first + len(z)] = 1 / (1 + np.exp(-(a + b * z)))
    return out


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Line features of the sample: per document its label, line sizes and features."""
    for batch in batches:
        labels = batch.column(0).to_pylist()
        for first, data, offsets in text_blocks(batch.column(1)):
            features, sizes, bounds = line_features(data, offsets)
            k = len(bounds) - 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(labels[first : first + k], pa.int32()),
                 pa.array([sizes[a:b].astype("<i8").tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]),
                 pa.array([features[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)])],
                names=["y", "sizes", "features"],
            )


def learn(docs: DataFrame, labels: DataFrame) -> dict | float:
    """A fitted field, or the share of good labels if the sample has only one kind or none."""
    sample = training_rows(docs, labels, "quality", SAMPLE).where(F.octet_length("text") <= LONGEST_SAMPLE)
    found = sample.select("y", "text").mapInArrow(_sampled, "y int, sizes binary, features binary").collect()
    # At most SAMPLE rows; sorted, so that the fit does not depend on the order of files.
    rows = sorted((r[0], bytes(r[1]), bytes(r[2])) for r in found)
    y = np.array([r[0] for r in rows], float)
    if len(set(y)) < 2:
        return float(y.mean()) if len(y) else 0.5
    sizes = [np.frombuffer(r[1], "<i8") for r in rows]
    features = np.concatenate([np.frombuffer(r[2], np.float32).reshape(-1, len(FEATURES)) for r in rows])
    bounds = np.concatenate(([0], np.cumsum([len(s) for s in sizes])))
    return fit(features, np.concatenate(sizes), bounds, y)


def with_score(docs: DataFrame, model: dict | float, text_column: str = "text", column: str = "score") -> DataFrame:
    """``docs`` with the quality of each text, 0 to 1; a null text counts as empty."""
    if not isinstance(model, dict):
        return docs.withColumn(column, F.lit(model))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = scores(shared.value, batch.column(batch.schema.get_field_index(text_column)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], names=[*batch.schema.names, column])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(column, DoubleType())]))


def score_documents(docs: DataFrame, labels: DataFrame, least: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of ``docs(doc_id, text)``.

    The labels of held-out rows are not read, and neither labels nor ids, languages or
    sources are inputs of a score. Null and empty texts are one empty line. Repeated rows
    and null ids keep their rows. Without labels of both kinds all texts have the share of
    good labels as their score (0.5 without any). Other columns are ignored; an empty
    table gives an empty result. The fit takes at most ``SAMPLE`` labelled documents of at
    most ``LONGEST_SAMPLE`` bytes each; every text is scored whole, however long.
    """
    scored = with_score(docs.select("doc_id", "text"), learn(docs, labels))
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= least).cast("int").alias("predicted")
    )
