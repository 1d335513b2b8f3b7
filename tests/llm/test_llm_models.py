"""Classifiers by held-out accuracy, the pipeline stage by stage, and the registered queries."""

import math

import numpy as np
import oracle
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from sparkretail.llm import quality, queries, toxicity
from sparkretail.llm.common import held_out, table
from sparkretail.llm.labelled import training_rows

SF = "/root/testdata/sf0.01"


# ---- toxicity ----
def test_disguised_words_are_restored():
    counts = np.ones(toxicity.SIZE**3)
    lexicon = {w + "$": 0.99 for w in ("idiot", "stupid", "loser", "moron")}
    model = toxicity.language_model(counts, lexicon)
    finder = toxicity.Finder({"lexicon": lexicon, "model": model, "rest": 0.01})
    for text in ("1d10t", "an i d i o t here", "l.o.s.e.r", "idiooooot", "st*pid", "$tup1d", "m-o-r-o-n", "IDIOT###"):
        assert finder.score(text) > 0.5, text
    for text in ("", "nothing here", "idiotic", "jo.81@mail4.example.com", "9233A8ECF7C5", "a b c d", "10.0.0.1"):
        assert finder.score(text) == pytest.approx(0.01), text


def plain_finder():
    lexicon = {w + "$": 0.99 for w in ("idiot", "stupid", "loser", "moron")} | {"wretch": 0.9}
    model = toxicity.language_model(np.ones(toxicity.SIZE**3), lexicon)
    return toxicity.Finder({"lexicon": lexicon, "model": model, "rest": 0.01})


def test_every_token_can_be_restored_whatever_its_length():
    finder = plain_finder()
    for text in (
        "stu" + "u" * 50 + "pid", "https://example.com/a/long/path/of/many/names/and/still/more/1d10t",
        ",".join(["plain"] * 5000) + ",1d10t", "idio7", "stuppid", "s****d", "ｉｄｉｏｔ", "ѕtupid", "wre7ched",
        "a s t u p i d plan", " ".join("x" * 60) + " m o r o n", "x" * 200_000 + "-m0ron", "lo$er",
    ):
        assert finder.score(text) > 0.5, text[:60]
    for text in ("x" * 200_000, "1" * 100_000 + "x", "a" + "*" * 100_000 + "b", "1337 455", "letter by letter", "3f9a7c" * 5000):
        assert finder.score(text) == pytest.approx(0.01), text[:60]


def test_decoding_equals_a_search_over_all_readings():
    finder, r = plain_finder(), np.random.default_rng(3)
    model = finder.learnt["model"]

    def all_readings(token):
        found = [(0.0, 0, 0, "")]
        for options in toxicity.lattice(token, False):
            longer = []
            for cost, a, b, text in found:
                for letter, price in options:
                    if not letter or (letter == " " and b == 0):
                        longer.append((cost + price, a, b, text))
                    else:
                        code = toxicity.INDEX.get(letter, toxicity.OTHER)
                        longer.append((cost + price + model[a, b, code], b, code, text + letter))
            found = longer
        return [(cost + model[a, b, 0], text) for cost, a, b, text in found]

    for _ in range(150):
        token = "".join(r.choice(list("idotsup01!$.-сé"), 7))
        readings = all_readings(token)
        least = min(c for c, _ in readings)
        assert toxicity.decode(token, model) in {t for c, t in readings if c < least + 1e-9}, token
        if not finder._possible(token):
            assert not any(finder._entries(t) for _, t in readings), token


def test_settled_beginnings_do_not_change_a_reading(monkeypatch):
    model, r = plain_finder().learnt["model"], np.random.default_rng(4)
    tokens = ["".join(r.choice(list("idotsup01!$.-"), 90)) for _ in range(20)]
    settled = [toxicity.decode(t, model) for t in tokens]
    monkeypatch.setattr(toxicity, "KEPT", 10**9)
    assert settled == [toxicity.decode(t, model) for t in tokens]


def test_toxic_documents_are_found(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    scored = toxicity.score_documents(docs.withColumn("score", F.lit(2)), labels)
    rows = scored.join(labels, "doc_id").join(docs.select("doc_id", "lang"), "doc_id").where("lang = 'en'").collect()
    assert scored.columns == ["doc_id", "held_out", "score", "predicted"] and scored.count() == docs.count()
    right = np.mean([r.predicted == r.toxic for r in rows])
    assert right > 0.97 and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.score_documents(docs.limit(0), labels.limit(0)).count() == 0


def test_rows_without_text_id_or_labels_have_a_score(spark):
    docs = spark.createDataFrame([(None, None), (1, ""), (1, ""), (2, "x" * 50_000)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for scored in (toxicity.score_documents(docs, labels), quality.score_documents(docs, labels)):
        rows = scored.collect()
        assert len(rows) == 4 and all(not math.isnan(r.score) for r in rows)
        assert not next(r for r in rows if r.doc_id is None).held_out
    kept = toxicity.keep_clean(docs.withColumn("_score", F.lit(9)).withColumn("_SCORE_in", F.lit(8)), labels)
    assert kept.columns == ["doc_id", "text", "_score", "_SCORE_in"] and kept.count() == 4
    assert {(r[2], r[3]) for r in kept.collect()} == {(9, 8)}


# ---- quality ----
def test_marginals_equal_enumeration():
    r = np.random.default_rng(0)
    for n in (1, 2, 5):
        unary, stay = r.normal(size=n), r.normal(size=2)
        weights = np.zeros((2**n, n + 1))
        for code in range(2**n):
            y = [(code >> i) & 1 for i in range(n)]
            score = sum(u for u, v in zip(unary, y, strict=True) if v)
            score += sum(stay[0] if a and b else stay[1] if not a and not b else 0 for a, b in zip(y, y[1:], strict=False))
            weights[code] = [*y, math.exp(score)]
        expected = (weights[:, :n] * weights[:, n:]).sum(0) / weights[:, n].sum()
        got, _, _ = quality.forward_backward(unary, stay, np.array([0, n]))
        assert np.allclose(got, expected)


def test_low_quality_is_told_apart(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    rows = quality.score_documents(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 40 and np.mean([r.predicted == r.quality for r in rows]) > 0.95
    assert quality.score_documents(docs.limit(0), labels).count() == 0


# ---- pipeline and queries ----
def test_every_stage_keeps_its_contract(spark, tmp_path):
    docs = table(spark, SF, "documents")
    extra = spark.createDataFrame(
        [(None, None, "en", "s", None), (90_001, "", "en", "s", 0), (90_001, "", "en", "s", 0)], docs.schema
    )
    docs = docs.unionByName(extra)
    before = {r.doc_id: r.text for r in docs.collect()}
    sizes = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        path = str(tmp_path / name)
        out.write.parquet(path)
        result = spark.read.parquet(path)
        if name != "packing":
            assert result.columns == docs.columns
        docs = result
        sizes.append(result.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] == sizes[-2] and 600 < sizes[-1] < len(before)
    kept = spark.read.parquet(str(tmp_path / "personal_data")).collect()
    assert not any("@" in r.text and ".example.com" in r.text for r in kept if r.text)
    assert all(r.n_chars is None or r.n_chars == len(r.text) for r in kept)
    assert {r.doc_id for r in kept} <= set(before)


def test_stages_take_an_empty_table(spark):
    docs = table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, name):
    assert not oracle.compare(queries.QUERIES[name](spark, SF), oracle.connect(SF), queries.ORACLES[name])


def test_all_are_registered():
    names = entry.queries()
    assert {f"op{n}" for n in range(1, 11)} | {"pipeline"} <= {n.split("_")[0] for n in names}
    assert set(entry.oracle_sql()) <= set(names)


def test_a_repeated_id_is_one_training_row(spark):
    rows = [(1, f"copy {i}") for i in range(50)] + [(2, "b"), (3, None), (4, "d"), (None, "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in (1, 2, 3, 4, 1)], "doc_id long, quality int")
    known = {r.doc_id for r in labels.where(~held_out()).collect()}
    got = training_rows(docs, labels, "quality", 10).collect()
    assert 1 in known and sorted(r.doc_id for r in got) == sorted(known)
    again = training_rows(docs.repartition(5), labels, "quality", 10).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again)) and got[0].asDict().keys() == {"doc_id", "text", "y"}
