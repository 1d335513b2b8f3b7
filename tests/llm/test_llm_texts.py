"""Operators on single texts against plain versions of the same rules."""

import hashlib
import itertools
import math
import random
import re

import oracle
import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from sparkretail.llm import common, decontaminate, licenses, packing, page_text, pretokens, privacy, queries, token_counts
from sparkretail.session import conf_overlay

PATH = public_tokenizers.path("word_bpe_49k.json")


# ---- token counts ----
def test_token_counts_equal_the_library(spark):
    r = random.Random(1)
    texts = [
        None, "", " ", "<|endoftext|>", "a<|startoftext|>b <|endoftext|><|endoftext|>", "aaaaaaa aaaa aaa", "ΑΣ ΟΔΟΣ.",
        "it's we'll '''s", "x" * 5000, "é" * 300, "日本語 テスト", "İstanbul ẞ", "1234 ½ ²", "word " * 300_000,
    ]
    for _ in range(2000):
        texts.append("".join(chr(r.choice([r.randrange(32, 127), r.randrange(0xA0, 0x250), 32])) for _ in range(r.randrange(30))))
    tokenizer = Tokenizer.from_file(PATH)
    expected = [len(e.ids) for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("n_bytes", F.lit(7))
    got = {row.doc_id: row for row in token_counts.count_tokens(docs, PATH).collect()}
    assert [got[i].n_tokens for i in range(len(texts))] == expected
    assert all(got[i].n_bytes == len((t or "").encode()) for i, t in enumerate(texts))
    assert all(row.over_limit == (row.n_tokens > 2048) for row in got.values())
    assert token_counts.count_tokens(docs.limit(0), PATH).count() == 0


# ---- decontamination ----
def greedy_tiles(doc, item, least):
    doc_marked, item_marked, out = [0] * len(doc), [0] * len(item), []
    while True:
        best, found = 0, []
        for o, a in itertools.product(range(len(item)), range(len(doc))):
            k = 0
            while (
                a + k < len(doc) and o + k < len(item) and doc[a + k] == item[o + k]
                and not doc_marked[a + k] and not item_marked[o + k]
            ):
                k += 1
            if k > best:
                best, found = k, []
            if k and k == best:
                found.append((o, a))
        if best < least:
            return out
        for o, a in found:
            if not any(doc_marked[a : a + best]) and not any(item_marked[o : o + best]):
                doc_marked[a : a + best] = item_marked[o : o + best] = [1] * best
                out.append((a, o, best))


def test_tiles_are_greedy():
    r = random.Random(0)
    for _ in range(200):
        kinds = r.choice([2, 3, 6])
        doc = [r.randrange(kinds) for _ in range(r.randrange(50))]
        item = [r.randrange(kinds) for _ in range(r.randrange(30))]
        assert sorted(decontaminate.tiles(doc, item, 3)) == sorted(greedy_tiles(doc, item, 3))


def test_text_item_ids_may_be_null(spark):
    item = " ".join(f"w{i}" for i in range(30))
    other = " ".join(f"v{i}" for i in range(30))
    bench = spark.createDataFrame([(None, item), ("b", other)], "item_id string, text string")
    docs = spark.createDataFrame([("x", item), (None, other)], "doc_id string, text string")
    got = decontaminate.find_leaks(docs, bench).select("doc_id", "item_id").collect()
    assert sorted(map(tuple, got), key=str) == sorted([("x", None), (None, "b")], key=str)


def test_leaks_are_found_in_any_order(spark, monkeypatch):
    item = " ".join(f"w{i}" for i in range(30))
    parts = item.split()
    moved = " ".join(parts[20:] + ["x"] + parts[:10] + ["y"] + parts[10:20])
    rows = [
        (1, "pre " + item.upper() + ". post"), (2, moved), (3, " ".join(parts[:10])), (4, None), (5, ""),
        (None, item), (1, "pre " + item), (6, "clean text " * 5000), (7, "w1 w2"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_leaks", F.lit(1))
    bench = spark.createDataFrame([(10, item), (11, None), (12, "w1 w2"), (13, "other words that stand nowhere at all")], "item_id long, text string")
    for size in (decontaminate.SLICE_WORDS, 1):  # one slice of the benchmark, and many
        monkeypatch.setattr(decontaminate, "SLICE_WORDS", size)
        got = [(r.doc_id, r.item_id, r.matched_words, r.reordered) for r in decontaminate.find_leaks(docs, bench).collect()]
        assert sorted(got, key=str) == sorted(
            [(1, 10, 30, False), (2, 10, 30, True), (None, 10, 30, False), (1, 10, 30, False)], key=str
        )
    kept = decontaminate.drop_leaking(docs, bench)
    assert kept.columns == ["doc_id", "text", "_leaks"]
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 6, 7]
    assert decontaminate.find_leaks(docs.limit(0), bench.limit(0)).count() == 0


# ---- personal data ----
RULES = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def base_spans(text):
    found = []
    for k, (kind, pattern) in enumerate(RULES):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            total = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits)))
            valid = {
                "email": True,
                "ip": kind != "ip" or all(int(x) <= 255 for x in m.group().split(".")),
                "card": 12 <= len(digits) <= 19 and total % 10 == 0,
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if valid:
                found.append((m.start(), k, kind, m.end()))
    return sorted(found)


def test_base_spans_equal_the_patterns(spark):
    r = random.Random(3)
    texts = [
        None, "", "a@b.c_d@e.f x", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "+1 (386) 555-3733", "x" * 20_000,
        "1" * 5000, "a." * 3000 + "@b.c", "256.1.1.1 0255.001.02.3", "é 10.0.0.1 ñ a@b.co",
    ]
    for _ in range(1500):
        texts.append("".join(r.choice("ab1 .@+-()0459\n_é%") for _ in range(r.randrange(40))))
        texts.append("".join(r.choice(["4111111111111111", "+1 386 555 3733", "10.2.3.4", " ", "a@b.c", "-", ".", "\n", "😀"]) for _ in range(r.randrange(9))))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("spans", F.lit(1))
    got = {row.doc_id: row for row in privacy.find_personal_data(docs).collect()}
    for i, text in enumerate(texts):
        spans = base_spans(text)
        digest = hashlib.sha256(",".join(f"{kind}:{a}:{e}" for a, _, kind, e in spans).encode()).hexdigest()
        counts = [sum(s[2] == kind for s in spans) for kind, _ in RULES]
        assert (got[i].base_sha256, [got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone]) == (digest, counts), text
    assert privacy.find_personal_data(docs.limit(0)).count() == 0


def test_disclosing_terms_are_taken_out(spark):
    rows = [(i, f"Customer Zorblax wrote from zor@blax.com today about the order\nthe plain line {i}") for i in range(6)]
    rows += [(100 + i, "the order today about plain words wrote from customer") for i in range(400)] + [(7, None), (8, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", F.lit(1)).withColumn("_key", F.lit("a"))
    found = {r.doc_id: r.spans for r in privacy.find_personal_data(docs).collect()}
    assert found[0] == "term:9:16,email:28:40" and found[100] == found[7] == found[8] == ""
    clean = privacy.sanitise(docs)
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert clean.columns == docs.columns and len(texts) == len(rows)
    assert texts[0] == "Customer  wrote from <EMAIL> today about the order\nthe plain line 0"
    assert texts[100] == rows[6][1] and texts[7] is None and texts[8] == ""


def test_disclosing_terms_are_found_all_over_a_text_that_holds_the_entity(spark):
    far = "x" * 300 + " filler\n" * 40
    rows = [(i, f"Zorblax wrote from zor@blax.com\n{far}Later ZORBLAX, zorblaxian and 😀 a-Zorblax came") for i in range(6)]
    rows += [(50, rows[0][1])] * 3 + [(60, "nobody else here")]
    rows += [(100 + i, "the order wrote from later came nobody and else plain filler a") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found: dict[int, set[str]] = {}
    for r in privacy.find_personal_data(docs).collect():
        found.setdefault(r.doc_id, set()).add(r.spans)
    text = rows[0][1]
    spans = [("email", m.start(), m.end()) for m in re.finditer(r"zor@blax.com", text)]
    spans += [("term", m.start(), m.end()) for m in re.finditer(r"(?i)\bzorblax\b", text)]
    expected = ",".join(f"{k}:{a}:{e}" for k, a, e in sorted(spans, key=lambda x: x[1]))
    assert len(spans) == 4 and found[0] == found[50] == {expected} and found[60] == {""}
    clean = {r.doc_id: r.text for r in privacy.sanitise(docs).collect()}
    assert not re.search(r"(?i)\bzorblax\b", clean[0]) and "zorblaxian" in clean[0] and clean[60] == "nobody else here"


# ---- pages ----
def test_blocks_of_pages():
    def texts(page):
        return [b[2] for b in page_text.parse(page)[0]]

    assert texts("") == [] and texts("<p>a") == ["a"]
    assert texts("<div>x &amp; y&nbsp;z <b>bo</b>ld<br>n</div><p>q") == ["x & y z bold n", "q"]
    assert texts(
        '<body class="has-sidebar"><header>H</header><article><header><h1>T &lt</h1></header><p>a\n b<p>c<ul><li>1<li>2'
        '</ul><footer>f</footer><div class="ad">x</div></article><section id="comments">z</section>'
    ) == ["T <", "a b", "c", "1", "2"]
    assert texts('<script>var t="</p>";</script>k<!-- c --><a title="a > b">L</a>') == ["kL"]
    assert texts("<form><main><p>in</p></main>x</form>") == ["in"]
    assert texts("<table><tr><td>a<td>b<tr><td>c</table>") == ["a", "b", "c"]
    assert texts("<p>un<") == ["un<"] and texts("<nav>m<p>n</nav>z") == ["z"]


def test_the_tree_cuts_what_all_pages_show(spark):
    rows = [
        (i, f"http://h.org/{i}", f'<body><div class="c1">Same words here</div><div class="c2"><p>para {i} unique {i * 7}</p></div></body>')
        for i in range(20)
    ] + [(99, None, None), (98, "http://h.org/1", ""), (97, "http://one.org/", "<div>Same words here</div>")] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(0))
    expected = sorted((i, f"para {i} unique {i * 7}") for i in range(20)) + [
        (97, "Same words here"), (97, "Same words here"), (98, ""), (98, ""), (99, ""), (99, "")
    ]
    for nodes in (100, -1):  # low nodes sent to all tasks, and by a join
        got = page_text.extract(pages, broadcast_nodes=nodes).collect()
        assert sorted((r.page_id, r.text) for r in got) == expected
        assert all(r.n_chars == len(r.text) for r in got)
    assert page_text.extract(pages.limit(0)).count() == 0


def test_articles_of_page_variants_stay(spark):
    body = "<body><nav>menu {0}</nav><article><h1>{1}</h1><p>first {2}</p><p>second {2}</p></article><div class='ad'>buy {0}</div></body>"
    rows = [(i, f"http://h.org/{i}", body.format(i, "One title", "text")) for i in range(12)]
    rows += [(20 + i, f"http://n.org/{i}", body.format(i, "Near copy", "alike").replace("</h1>", f"</h1><p>date {i}</p>")) for i in range(12)]
    rows += [(40 + i, f"http://m.org/{i}", body.format(i, "One title", "text")) for i in range(30)]
    rows += [(80 + i, f"http://m.org/o{i}", body.format(i, f"Title {i}", f"other {i}")) for i in range(10)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for nodes in (100, -1):
        got = {r.page_id: r.text for r in page_text.extract(pages, broadcast_nodes=nodes).collect()}
        assert {got[i] for i in [*range(12), *range(40, 70)]} == {"One title\n\nfirst text\n\nsecond text"}
        assert all("first alike" in got[20 + i] and "second alike" in got[20 + i] for i in range(12))
        assert all(got[80 + i] == f"Title {i}\n\nfirst other {i}\n\nsecond other {i}" for i in range(10))


# ---- licenses ----
def test_licenses_equal_sql(spark, tmp_path):
    import duckdb

    r = random.Random(1)
    words = [*" ".join(t for _, t in licenses.NOTICES).split(), "é", "MİT", "\n", "general", "public", "license", "mit", "LICENSE"]
    rows = [(None, None), (1, ""), (2, "MIT License"), (2, "MIT License")]
    rows += [(10 + i, " ".join(r.choice(words) for _ in range(r.randrange(40)))) for i in range(400)]
    rows += [(5000 + i, r.choice(licenses.NOTICES)[1].replace(r.choice("aeiou"), r.choice("xaei"), 1)) for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs.coalesce(1).write.parquet(str(tmp_path / "documents"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents/*.parquet'")
    assert not oracle.compare(licenses.scan(docs.withColumn("label", F.lit("x"))), con, licenses.oracle())
    assert licenses.scan(docs.limit(0)).count() == 0


def test_licenses_run_over_line_breaks(spark):
    def densest(text, template, threshold=licenses.THRESHOLD):
        words, inside = (re.findall("[0-9a-z\x80-\U0010ffff]+", t.lower()) for t in (text, template))
        span = math.ceil(len(inside) / threshold - 1e-9)
        best = max((len({*words[i : i + span]} & {*inside}) for i in range(len(words))), default=0)
        return best / len({*inside}) if best >= math.ceil(threshold * len({*inside}) - 1e-9) else 0.0

    r = random.Random(3)
    texts = [
        " * Redistribution and use in source and binary forms, with or without\n * modification, are permitted provided",
        "# This Source Code Form is subject to the terms of the Mozilla Public\n# License, v. 2.0. If a copy",
        "released\n\nunder " + "x " * 50 + "the MIT\nlicense",
    ]
    for _ in range(150):
        words = " ".join(t for _, t in r.sample(licenses.NOTICES, 2)).split() + ["w"] * r.randrange(15)
        if r.random() < 0.5:
            words[r.randrange(len(words))] = "v"
        if r.random() < 0.3:
            r.shuffle(words)
        texts.append("\n".join(words))  # no line holds two words
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: x for x in licenses.scan(docs, across_lines=True).collect()}
    assert (got[0].labels, got[0].score) == ("bsd", 1.0)
    assert got[1].labels == "mpl-2.0" and got[1].score >= 0.8
    for i, text in enumerate(texts):
        best = {label: densest(text, t) for label, t in licenses.NOTICES}
        base = set(filter(None, got[i].base_labels.split(",")))
        assert got[i].labels == ",".join(sorted({k for k, v in best.items() if v} | base)), text
        assert abs(got[i].score - (1.0 if base else max(best.values()))) < 1e-12

    whole = "\n".join(" ".join(f"t{r.randrange(400)}" for _ in range(10)) for _ in range(60))
    template = spark.createDataFrame([("whole", whole)], "label string, text string")
    cut = "\n".join(line for i, line in enumerate(whole.split("\n")) if i % 3)
    docs = spark.createDataFrame([(1, "a b\n" + whole + "\nc"), (2, cut)], "doc_id long, text string")
    got = {x.doc_id: x for x in licenses.scan(docs, template, across_lines=True).collect()}
    assert got[1].score == 1.0 and got[2].score == densest(cut, whole)


# ---- packing ----
def test_bounds_have_the_least_padding():
    r = random.Random(0)
    for _ in range(150):
        tops = sorted(r.sample(range(60), r.randrange(1, 9)))
        bins = [(t, n, t * n) for t in tops for n in [r.randrange(1, 6)]]
        buckets = r.randrange(1, 6)

        def cost(bounds, bins=bins):
            return sum(min(b for b in bounds if b >= t) * n - s for t, n, s in bins)

        best = min(
            cost([*inner, tops[-1]]) for m in range(buckets) for inner in itertools.combinations(tops[:-1], m)
        )
        got = packing.boundaries(bins, buckets)
        assert cost(got) == best and len(got) <= buckets


def test_batches_hold_every_row_once_within_the_budget(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_ROWS", 50)
    r = random.Random(2)
    rows = [(i, "w " * r.choice([0, 1, 5, 5, 30, 200])) for i in range(600)]
    rows += [(None, None), (None, None), (1, "w w"), (7000, "w " * 5000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("bucket", F.lit("x"))
    packed = packing.pack(docs, budget=1000, buckets=4)
    got = packed.collect()
    assert sorted((x.doc_id or -1, x.n_tokens) for x in got) == sorted((d or -1, len((t or "").split())) for d, t in rows)
    assert all(x.n_tokens <= x.padded_to for x in got)
    assert len({(x.batch_id, x.slot) for x in got}) == len(rows)
    for b in packing.batches(packed).collect():
        assert b.rows * b.padded_to <= 1000 or b.rows == 1
    assert [x.over_budget for x in got if x.doc_id == 7000] == [True]
    assert packing.pack(docs.limit(0)).count() == 0


def test_the_budget_holds_in_tokens(spark, tmp_path):
    r = random.Random(4)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    texts = ["日本語" * 500, "word " * 40, "", None, "".join(r.choice(letters) for _ in range(300_000))]
    texts += ["".join(r.choice(letters) for _ in range(r.randrange(1, 4000))) for _ in range(200)]
    tokenizer = Tokenizer.from_file(PATH)
    tokens = [len(e.ids) for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    rows = [(i if i % 7 else None, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit("x"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    expected = sorted((d or -1, n) for (d, _), n in zip(rows, tokens, strict=True))
    for packed in (queries.op2_packing(spark, str(tmp_path)), corpus_pipeline.pack(spark, docs, "")):
        got = packed.collect()
        assert sorted((x.doc_id or -1, x.n_tokens) for x in got) == expected
        assert [x.doc_id for x in got if x.over_budget] == [4]
        for b in packing.batches(packed).collect():
            assert b.rows * b.padded_to <= packing.BUDGET or b.rows == 1
    assert corpus_pipeline.pack(spark, docs.limit(0), "").count() == 0


def test_token_counts_hold_little_text_at_once(monkeypatch):
    held, counts = [], token_counts.Counter.counts

    def spied(self, texts):
        held.append(sum(map(len, texts)))
        return counts(self, texts)

    monkeypatch.setattr(token_counts.Counter, "counts", spied)
    texts = ["word " * 60_000] * 20 + ["word " * 900_000]
    got = token_counts.Counter(token_counts.load(PATH)).groups(texts)
    assert got == [60_000] * 20 + [900_000]
    assert sum(held) == sum(map(len, texts)) and max(held) < 2 * pretokens.PIECE + 8


def test_stages_hand_small_batches_to_python(spark, sf):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["n", "size"])

    text = F.repeat(F.lit("word "), 80_000)
    docs = spark.range(0, 40, numPartitions=1).select(F.col("id").alias("doc_id"), text.alias("text"))
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    for stage in (corpus_pipeline.decontamination, corpus_pipeline.pack):
        with conf_overlay(spark, {key: "64m"}):
            assert stage(spark, docs, sf).count() == 40
            got = docs.mapInArrow(sizes, "n long, size long").collect()
        assert sum(x.n for x in got) == 40
        assert max(x.size for x in got) < common.BATCH_BYTES + 500_000
    assert all(hasattr(stage, "__wrapped__") for _, stage in corpus_pipeline.STAGES)
