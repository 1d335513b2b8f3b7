"""License phrases in documents, and lines and passages that contain a license notice.

The notices are found by an exact set-similarity join: a line matches a template when it
holds at least ``THRESHOLD`` of the template's distinct words. Template words are ordered
by their frequency in the whole corpus, rarest first. A matching line holds one of the
first |T| - need + 1 words of the template (prefix filter), has at least ``need`` distinct
words (length filter), and after the first common prefix word both have enough words left
(positional filter). What passes is verified. The templates are a small table, so the
inverted index of their prefixes is a literal of the plan; lines meet it where they are
read, and nothing is shuffled but the word counts.

A notice may run over line breaks. With ``across_lines``, which the registered query sets,
the same filters, with the whole text as one line, leave the templates that any passage of it can hold; for these a window of consecutive
words, ``1 / THRESHOLD`` times as long as the template, slides over the text, and the
template's distinct words inside it are counted at every place. ``oracle`` states the
answer for lines only; the two differ where a notice is found in a window and in no line.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

THRESHOLD = 0.8
MOST_TEMPLATES = 1_000  # the index of the templates is part of the plan

# Phrases and their labels.
PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]

# Common license notices.
NOTICES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("mit-text", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("mit-notice", "Released under the MIT License."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words after A-Z became a-z, and the same words before.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def notices(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(NOTICES, "label string, text string")


def _sql(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _strings(values: list[str]) -> str:
    return f"cast(array({', '.join(_sql(v) for v in values)}) as array<string>)"


def _words(text: str) -> str:
    """SQL for the words of a text with A-Z as a-z."""
    return f"regexp_extract_all(translate({text}, '{UPPER}', '{LOWER}'), {_sql(WORD)}, 0)"


def _distinct(texts: DataFrame, column: str = "text"):
    return F.expr(f"array_distinct({_words(f'coalesce({column}, \"\")')})")


def frequencies(texts: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """Occurrences of the vocabulary's words in all texts."""
    counts = dict.fromkeys(vocabulary, 0)
    if not vocabulary:
        return counts
    word = F.explode(F.regexp_extract_all("text", F.lit(ANY_CASE), F.lit(0)))
    rows = (
        texts.select(word.alias("w")).select(F.translate("w", UPPER, LOWER).alias("w"))
        .where(F.col("w").isin(vocabulary)).groupBy("w").agg(F.count("*").alias("n")).collect()
    )
    return counts | {r["w"]: r["n"] for r in rows}


def _densest(template: str) -> str:
    """SQL for the most distinct words of a template in any window of its span.

    ``ws`` holds the words of the text. A word at place i that stood at p before counts for
    the windows that start after p, after i - span and not after i: one sorted list of
    starts and ends gives the count of every window.
    """
    at = f"""array_sort(filter(transform(ws, (w, i) -> named_struct('w', array_position({template}.words, w), 'i', i)), x -> x.w > 0))"""
    ends = f"""flatten(transform(at, (x, k) -> array(
        named_struct('s', if(k > 0 and at[greatest(k - 1, 0)].w = x.w, greatest(at[greatest(k - 1, 0)].i, x.i - {template}.span), x.i - {template}.span) + 1, 'd', 1),
        named_struct('s', x.i + 1, 'd', -1))))"""
    return f"""aggregate(flatten(transform(array({at}), at -> array_sort({ends}))), named_struct('n', 0, 'best', 0),
        (a, e) -> named_struct('n', a.n + e.d, 'best', greatest(a.best, a.n + e.d)), a -> a.best)"""


def _matches(
    templates: list[tuple[str, list[str], int]], order: dict[str, int], threshold: float, lines: str, across_lines: bool
) -> str:
    """SQL for an array of (label, containment) of the lines, and with ``across_lines`` the
    windows, that match a template."""
    first: dict[str, list[str]] = {}
    known_templates = []
    for number, (label, words, length) in enumerate(templates, 1):
        ranked = sorted(words, key=lambda w: (order[w], w))
        need = max(1, math.ceil(threshold * len(ranked) - 1e-9))
        span = max(length, math.ceil(length / threshold - 1e-9)) if threshold > 0 else length
        known_templates.append(
            f"named_struct('label', {_sql(label)}, 'words', {_strings(ranked)}, 'need', {need}, 'span', {span})"
        )
        for i, word in enumerate(ranked[: len(ranked) - need + 1]):
            first.setdefault(word, []).append(f"named_struct('t', {number}, 'left', {len(ranked) - i})")
    kind = "array<struct<label:string,containment:double>>"
    if not first:
        return f"cast(array() as {kind})"
    index = "map(" + ", ".join(f"{_sql(w)}, array({', '.join(e)})" for w, e in sorted(first.items())) + ")"
    table = f"array({', '.join(known_templates)})"
    vocabulary = sorted({w for _, ws, _ in templates for w in ws}, key=lambda w: (order[w], w))

    # Words of a line that any template has, in the global order.
    def known(words: str) -> str:
        return f"array_intersect({_strings(vocabulary)}, {words})"

    prefixes = f"array_intersect({_strings(sorted(first))}, b)"
    # left counts the template's words from the common one on, the slice those of the line.
    candidates = f"""array_distinct(flatten(transform({prefixes}, w -> transform(filter(
        transform(element_at({index}, w), c -> named_struct('t', element_at({table}, c.t), 'left', c.left)), c ->
        size(b) >= c.t.need and c.left >= c.t.need
        and array_position(c.t.words, w) - 1 + size(b) - array_position(b, w) + 1 >= c.t.need), c -> c.t))))"""

    def found(common: str, passed: str) -> str:
        counted = f"transform({passed}, t -> named_struct('label', t.label, 'need', t.need, 'size', size(t.words), 'common', {common}))"
        return f"""transform(filter({counted}, t -> t.common >= t.need),
            t -> named_struct('label', t.label, 'containment', t.common / t.size))"""

    common = "size(array_intersect(t.words, b))"
    of_lines = f"flatten(transform(transform({lines}, l -> {known(_words('l'))}), b -> {found(common, candidates)}))"
    if not across_lines:
        return f"cast({of_lines} as {kind})"
    in_text = f"filter({candidates}, t -> {common} >= t.need)"
    of_windows = f"""flatten(transform(array({_words('text')}), ws -> flatten(transform(
        array({known('ws')}), b -> {found(_densest('t'), in_text)}))))"""
    return f"cast(concat({of_lines}, {of_windows}) as {kind})"


def scan(
    docs: DataFrame,
    templates: DataFrame | None = None,
    threshold: float = THRESHOLD,
    id_column: str = "doc_id",
    text_column: str = "text",
    across_lines: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score.

    A place is where the words of a phrase stand consecutively; ``first_word`` and
    ``last_word`` are the smallest and largest start of a place, from 0, null without one.
    ``labels`` adds those of the templates that a line, or with ``across_lines`` also a
    window of consecutive words over any lines, contains. ``score`` is 1 with a place, else the best containment of a
    matching line or window, else 0.

    Null and empty texts have no words. Repeated rows and null ids keep their rows; other
    columns are ignored; an empty table gives an empty result. Templates without words
    match nothing.
    """
    spark = docs.sparkSession
    templates = notices(spark) if templates is None else templates
    length = F.regexp_count("text", F.lit(ANY_CASE)).alias("n")
    rows = templates.select("label", _distinct(templates).alias("w"), length).limit(MOST_TEMPLATES + 1).collect()
    if len(rows) > MOST_TEMPLATES:
        raise ValueError(f"more than {MOST_TEMPLATES} templates")
    known = [(r["label"], r["w"], r["n"]) for r in rows if r["w"] and r["label"] is not None]
    docs = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    vocabulary = sorted({w for _, ws, _ in known for w in ws})
    order = frequencies(docs, vocabulary)

    prefix_words = set()
    for _, words, _ in known:
        need = max(1, math.ceil(threshold * len(words) - 1e-9))
        prefix_words.update(sorted(words, key=lambda w: (order[w], w))[: len(words) - need + 1])
    hint = "(?i)" + "|".join(sorted(prefix_words)) if prefix_words else "(?!)"
    # Only lines and texts that hold a prefix word, whatever its surroundings, are taken apart.
    lines = f"filter(split(text, '\\n', -1), l -> l rlike {_sql(hint)})"

    # Interpreted array code runs only on texts that hold what it looks for.
    ending = {p.split()[-1] for p, _ in PHRASES}
    has_phrase = " or ".join(f"text rlike {_sql(f'(?i){w}')}" for w in sorted(ending))
    docs = docs.withColumn("_w", F.expr(f"if({has_phrase}, {_words('text')}, cast(array() as array<string>))"))
    docs = docs.withColumn("_m", F.expr(f"if(text rlike {_sql(hint)}, {_matches(known, order, threshold, lines, across_lines)}, array())"))
    parts = []
    for phrase, label in PHRASES:
        words = phrase.split()
        steps = " and ".join(f"_w[i + {j}] = {_sql(w)}" for j, w in enumerate(words))
        spots = f"filter(sequence(0, size(_w) - {len(words)}), i -> {steps})"
        parts.append(
            f"if(size(_w) < {len(words)}, array(), transform({spots}, i -> named_struct('at', i, 'label', {_sql(label)})))"
        )
    docs = docs.withColumn("_p", F.expr(f"cast(concat({', '.join(parts)}) as array<struct<at:int,label:string>>)"))
    return docs.select(
        "doc_id",
        F.regexp_count("text", F.lit(ANY_CASE)).cast("long").alias("n_words"),
        F.size("_p").cast("long").alias("n_base"),
        F.expr("cast(array_min(transform(_p, x -> x.at)) as bigint)").alias("first_word"),
        F.expr("cast(array_max(transform(_p, x -> x.at)) as bigint)").alias("last_word"),
        F.expr("array_join(array_sort(array_distinct(transform(_p, x -> x.label))), ',')").alias("base_labels"),
        F.expr(
            "array_join(array_sort(array_distinct(concat(transform(_p, x -> x.label), "
            "transform(_m, x -> x.label)))), ',')"
        ).alias("labels"),
        F.expr(
            "if(size(_p) > 0, 1.0D, coalesce(array_max(transform(_m, x -> x.containment)), 0.0D))"
        ).alias("score"),
    )


def oracle() -> str:
    """The same rows in SQL, every line compared with every notice."""
    parts = []
    for phrase, label in PHRASES:
        words = phrase.split()
        steps = " AND ".join(f"ws[i + {j}] = '{w}'" for j, w in enumerate(words))
        parts.append(f"list_transform(list_filter(range(1, len(ws) + 1), lambda i: {steps}), lambda i: {{'at': i - 1, 'label': '{label}'}})")
    pattern = "[0-9a-z\\x{80}-\\x{10FFFF}]+"
    rows = ", ".join(f"('{label}', '{text}')" for label, text in NOTICES)
    return f"""
    WITH lowered AS (
        SELECT row_number() OVER () AS r, doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents),
    worded AS (SELECT r, doc_id, t, regexp_extract_all(t, '{pattern}') AS ws FROM lowered),
    placed AS (SELECT *, {' || '.join(parts)} AS p FROM worded),
    templates(label, text) AS (VALUES {rows}),
    sets AS (
        SELECT label, list_distinct(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{pattern}')) AS w FROM templates),
    lines AS (
        SELECT r, list_distinct(regexp_extract_all(line, '{pattern}')) AS b
        FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM lowered)),
    matched AS (
        SELECT r, label, max(len(list_intersect(b, w)) / len(w)) AS containment
        FROM lines, sets WHERE len(list_intersect(b, w)) >= ceil({THRESHOLD} * len(w) - 1e-9) GROUP BY r, label),
    found AS (SELECT r, list(label) AS labels, max(containment) AS best FROM matched GROUP BY r)
    SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(p) AS BIGINT) AS n_base,
        CAST(list_min(list_transform(p, lambda x: x.at)) AS BIGINT) AS first_word,
        CAST(list_max(list_transform(p, lambda x: x.at)) AS BIGINT) AS last_word,
        array_to_string(list_sort(list_distinct(list_transform(p, lambda x: x.label))), ',') AS base_labels,
        array_to_string(list_sort(list_distinct(
            list_transform(p, lambda x: x.label) || coalesce(labels, []))), ',') AS labels,
        CASE WHEN len(p) > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0.0)::DOUBLE END AS score
    FROM placed LEFT JOIN found USING (r)"""
