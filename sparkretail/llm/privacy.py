"""Personal data: spans by pattern, and terms beside them that give them away.

Everything is a SQL expression. Patterns find e-mail addresses, IP addresses, card and
phone numbers; each value is a protected entity. The words beside an entity are its
context. Over the whole corpus, a term t reveals an entity e by their pointwise mutual
information; divided by the information of e itself, log2(N / n_e), this is the share of e
that t discloses: 1 if t never stands anywhere else. Terms that disclose ``GENERALISE`` or
more are replaced by what kind of word they are, those that disclose ``REMOVE`` or more
are taken out, wherever they stand in a text where they stand beside the entity once. N
counts words, n_e and n_t occurrences, over all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkretail.llm.common import durable

GENERALISE, REMOVE = 0.85, 0.97
SUPPORT = 3  # occurrences of a term beside an entity, at least
WORDS_BESIDE, REACH = 5, 100  # words on each side, within so many characters on the line

# The patterns of the four kinds. A run of letters or digits is only tried at its start (or
# where the match before ended), which changes no match and keeps long runs linear.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = [*PATTERNS, "term"]
# What a text must hold for a kind to be tried at all.
HINTS = {
    "email": "instr({t}, '@') > 0",
    "ip": r"{t} rlike '[0-9]\\.[0-9]'",
    "card": r"{t} rlike '[0-9](?:[\\x20-]?[0-9]){{11}}'",
    "phone": "instr({t}, '+') > 0",
}
SPAN = "struct<s:int,e:int,k:int,v:string>"
TERM = r"[\p{L}\p{N}]+"


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def places(text: str, pattern: str, kind: str = "0", shift: str = "0") -> str:
    """SQL for the matches of a pattern: start, end (code points), kind and value.

    What lies between the matches comes from ``split``, so lengths add up to positions.
    """
    p = _quoted(pattern)
    return f"""aggregate(
        zip_with(split({text}, {p}, -1), regexp_extract_all({text}, {p}, 0), (p, h) -> named_struct('p', p, 'h', h)),
        named_struct('at', cast({shift} as int), 'out', cast(array() as array<{SPAN}>)),
        (a, x) -> named_struct(
            'at', a.at + length(x.p) + coalesce(length(x.h), 0),
            'out', if(x.h is null, a.out, concat(a.out, array(named_struct(
                's', a.at + length(x.p), 'e', a.at + length(x.p) + length(x.h), 'k', {kind}, 'v', x.h))))),
        a -> a.out)"""


def _luhn(value: str) -> str:
    digits = f"reverse(regexp_replace({value}, '[^0-9]', ''))"
    return f"""aggregate(sequence(1, length({digits})), 0, (a, i) -> a + cast(if(i % 2 = 1,
        cast(substring({digits}, i, 1) as int),
        (2 * cast(substring({digits}, i, 1) as int)) div 10 + (2 * cast(substring({digits}, i, 1) as int)) % 10
        ) as int)) % 10 = 0"""


_OCTET = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{0,2})"
_DIGITS = "length(regexp_replace(x.v, '[^0-9]', ''))"
VALID = {
    "email": "true",
    "ip": "x.v rlike " + _quoted(rf"^{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}$"),
    "card": f"{_DIGITS} between 12 and 19 and {_luhn('x.v')}",
    "phone": f"{_DIGITS} between 9 and 15",
}


def base_spans(text: str) -> str:
    """SQL for all valid spans of a text by start, then kind."""
    parts = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        found = places(text, pattern, str(k))
        tried = HINTS[kind].format(t=text)
        parts.append(f"if({tried}, filter({found}, x -> {VALID[kind]}), cast(array() as array<{SPAN}>))")
    joined = f"concat({', '.join(parts)})"
    return f"""array_sort({joined}, (a, b) -> case
        when a.s < b.s then -1 when a.s > b.s then 1 when a.k < b.k then -1 when a.k > b.k then 1 else 0 end)"""


def joined(spans: str) -> str:
    """SQL for kind:start:end, joined by commas."""
    names = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    return f"array_join(transform({spans}, x -> concat({names}[x.k], ':', x.s, ':', x.e)), ',')"


def _contexts() -> str:
    """SQL for the words beside each span: the entity, and the words with their places."""
    before = f"element_at(split(substring(_t, greatest(x.s - {REACH}, 0) + 1, least(x.s, {REACH})), '\\n', -1), -1)"
    after = f"split(substring(_t, x.e + 1, {REACH}), '\\n', -1)[0]"
    left = places(before, TERM, "4", f"x.s - length({before})")
    right = places(after, TERM, "4", "x.e")
    # A word cut off by the reach is not whole, and is left out.
    whole_left = f"filter({left}, w -> w.s > x.s - {REACH} or w.s = 0)"
    whole_right = f"filter({right}, w -> w.e < x.e + {REACH} or w.e = length(_t))"
    words = f"concat(slice(reverse({whole_left}), 1, {WORDS_BESIDE}), slice({whole_right}, 1, {WORDS_BESIDE}))"
    clear = "not exists(spans, b -> w.s < b.e and b.s < w.e)"
    entity = "if(x.k = 0, lower(x.v), if(x.k = 1, x.v, regexp_replace(x.v, '[^0-9]', '')))"
    return f"""flatten(transform(spans, x -> transform(
        filter({words}, w -> {clear} and length(w.v) >= 3 and w.v rlike '\\\\p{{L}}'),
        w -> named_struct('entity', concat(x.k, ':', {entity}), 'term', lower(w.v)))))"""


def find_base(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """``docs`` with ``_t`` (the text, null as empty), ``spans`` and ``contexts``.

    ``_key`` names the text of rows that have contexts, ``_beside`` is that text.
    """
    found = docs.withColumn("_t", F.coalesce(F.col(text_column), F.lit(""))).withColumn("spans", F.expr(base_spans("_t")))
    found = found.withColumn("contexts", F.expr(f"if(size(spans) > 0, {_contexts()}, array())"))
    found = found.withColumn("_beside", F.expr("if(size(contexts) > 0, _t, null)"))
    return found.withColumn("_key", F.sha2("_beside", 256))


def disclosing_terms(found: DataFrame, texts: DataFrame) -> DataFrame:
    """(entity, term, disclosure) of the terms that give an entity away.

    ``found`` has spans and contexts of all rows, ``texts`` the column ``text``.
    """
    entity_of = "if(x.k = 0, lower(x.v), if(x.k = 1, x.v, regexp_replace(x.v, '[^0-9]', '')))"
    entities = (
        found.select(F.explode(F.expr(f"transform(spans, x -> concat(x.k, ':', {entity_of}))")).alias("entity"))
        .groupBy("entity").agg(F.count("*").alias("n_e"))
    )
    pairs = (
        found.select(F.explode("contexts").alias("c")).groupBy("c.entity", "c.term")
        .agg(F.count("*").alias("n_et")).where(F.col("n_et") >= SUPPORT)
    )
    words = texts.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(TERM), F.lit(0))).alias("term"))
    counts = words.groupBy("term").agg(F.count("*").alias("n_t"))
    total = texts.select(F.sum(F.regexp_count("text", F.lit(TERM))).alias("n")).first()[0] or 0
    n = F.lit(float(max(total, 2)))
    information = F.greatest(F.log2(n / F.col("n_e")), F.lit(1e-9))
    pmi = F.log2(F.col("n_et") * n / (F.col("n_e") * F.greatest("n_t", "n_et")))
    return (
        pairs.join(entities, "entity").join(counts, "term")
        .select("entity", "term", (pmi / information).alias("disclosure"))
        .where(F.col("disclosure") >= GENERALISE)
    )


def _occurrences() -> str:
    """SQL for all places of the terms of ``weights`` in a text, outside its base spans."""
    found = f"""aggregate(
        zip_with(split(_beside, {_quoted(TERM)}, -1), regexp_extract_all(_beside, {_quoted(TERM)}, 0),
            (p, h) -> named_struct('p', p, 'h', h, 'd', try_element_at(weights, lower(h)))),
        named_struct('at', 0, 'out', cast(array() as array<struct<s:int,e:int,disclosure:double,v:string>>)),
        (a, x) -> named_struct(
            'at', a.at + length(x.p) + coalesce(length(x.h), 0),
            'out', if(x.d is null, a.out, concat(a.out, array(named_struct(
                's', a.at + length(x.p), 'e', a.at + length(x.p) + length(x.h), 'disclosure', x.d, 'v', x.h))))),
        a -> a.out)"""
    return f"filter({found}, w -> not exists(spans, b -> w.s < b.e and b.s < w.e))"


def _added(found: DataFrame, terms: DataFrame) -> DataFrame:
    """(_key, added): spans of disclosing terms per text, once for all its copies. A term
    counts with the most that it discloses of an entity that it stands beside in the text."""
    beside = found.where("_key IS NOT NULL")
    spots = (
        beside.select("_key", "contexts").dropDuplicates(["_key"])
        .select("_key", F.explode("contexts").alias("c")).select("_key", "c.*").distinct()
    )
    strongest = spots.join(terms, ["entity", "term"]).groupBy("_key", "term").agg(F.max("disclosure").alias("disclosure"))
    weights = strongest.groupBy("_key").agg(F.map_from_entries(F.collect_list(F.struct("term", "disclosure"))).alias("weights"))
    texts = beside.select("_key", "_beside", "spans").dropDuplicates(["_key"])
    return texts.join(weights, "_key").select("_key", F.expr(_occurrences()).alias("added"))


def _everything(digest: DataFrame, texts: DataFrame, columns: list[str]) -> DataFrame:
    """``columns``, spans and added spans per row. Rows without contexts skip the join, and
    keys are those of texts, so a frequent text meets one row."""
    added = _added(digest, disclosing_terms(digest, texts))
    plain = digest.where("_key IS NULL").select(*columns, "spans", F.lit(None).cast(added.schema["added"].dataType).alias("added"))
    beside = digest.where("_key IS NOT NULL").join(added, "_key", "left").select(*columns, "spans", "added")
    return plain.unionByName(beside)


def _all_spans() -> Column:
    more = "transform(coalesce(added, array()), x -> named_struct('s', x.s, 'e', x.e, 'k', 4, 'v', x.v))"
    return F.expr(
        f"""array_sort(concat(spans, {more}), (a, b) -> case
        when a.s < b.s then -1 when a.s > b.s then 1 when a.k < b.k then -1 when a.k > b.k then 1 else 0 end)"""
    )


def find_personal_data(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone, base_sha256 and
    spans (kind:start:end in code points, comma-joined, by start and then kind).

    ``spans`` holds the base spans and those of disclosing terms, kind ``term``, at every
    place of a text that holds them beside an entity. Null and
    empty texts have none. Spans depend on the text alone, so repeated rows agree; null
    ids are kept; other columns are ignored; an empty table gives an empty result.
    """
    docs = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    digest = durable(find_base(docs).select("doc_id", "_key", "_beside", "spans", "contexts"))
    found = _everything(digest, docs, ["doc_id"])

    def number(k: int) -> Column:
        return F.expr(f"cast(size(filter(spans, x -> x.k = {k})) as bigint)")

    return found.select(
        "doc_id",
        *[number(k).alias(f"n_{kind}") for k, kind in enumerate(PATTERNS)],
        F.sha2(F.expr(joined("spans")), 256).alias("base_sha256"),
        _all_spans().alias("spans"),
    ).withColumn("spans", F.expr(joined("spans")))


def sanitise(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """``docs`` with personal data taken out of the text; all columns and rows stay.

    Spans become <EMAIL>, <IP>, <CARD> and <PHONE>; spans that overlap become the first of
    them. Disclosing terms become <NUMBER>, <NAME> or <WORD>, or go entirely. A null text
    stays null.
    """
    digest = durable(
        find_base(docs.select(F.col(text_column).alias("text"))).select("_key", "_beside", "spans", "contexts")
        .where("size(spans) > 0")
    )
    added = _added(digest, disclosing_terms(digest, docs.select(F.col(text_column).alias("text"))))
    names = [c for c in docs.columns]
    # One struct holds the given columns, so none can clash with those made here.
    held = find_base(docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), F.col(text_column).alias("text")))
    kind = added.schema["added"].dataType
    plain = held.where("_key IS NULL").withColumn("added", F.lit(None).cast(kind))
    beside = held.where("_key IS NOT NULL").join(added, "_key", "left")
    columns = ["_row", "_t", "spans", "added"]
    found = plain.select(*columns).unionByName(beside.select(*columns))
    marks = "array('<EMAIL>', '<IP>', '<CARD>', '<PHONE>')[x.k]"
    shape = f"""case when x.disclosure >= {REMOVE} then ''
        when x.v rlike '[0-9]' then '<NUMBER>' when x.v rlike '^\\\\p{{Lu}}' then '<NAME>' else '<WORD>' end"""
    cuts = f"""array_sort(concat(
        transform(spans, x -> named_struct('s', x.s, 'e', x.e, 'm', {marks})),
        transform(coalesce(added, array()), x -> named_struct('s', x.s, 'e', x.e, 'm', {shape}))))"""
    merged = f"""aggregate({cuts}, cast(array() as array<struct<s:int,e:int,m:string>>), (a, x) -> if(
        size(a) > 0 and x.s < element_at(a, -1).e,
        concat(slice(a, 1, size(a) - 1), array(named_struct('s', element_at(a, -1).s,
            'e', greatest(element_at(a, -1).e, x.e), 'm', element_at(a, -1).m))),
        concat(a, array(x))))"""
    found = found.withColumn("_cuts", F.expr(f"if(size(spans) > 0, {merged}, array())"))
    rebuilt = """concat(array_join(transform(_cuts, (x, i) -> concat(
        substring(_t, if(i = 0, 0, _cuts[i - 1].e) + 1, x.s - if(i = 0, 0, _cuts[i - 1].e)), x.m)), ''),
        substring(_t, element_at(_cuts, -1).e + 1, length(_t)))"""
    clean = F.expr(f"if(size(_cuts) > 0, {rebuilt}, _row.`{text_column}`)")
    return found.select(
        *[clean.alias(c) if c == text_column else F.col(f"_row.`{c}`").alias(c) for c in names]
    )
