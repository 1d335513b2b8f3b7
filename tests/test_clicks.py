"""Attribution streams, interval pairs, catalog and wide events."""

import datetime as dt
from decimal import Decimal as D

import pytest
from conftest import collect
from pyspark.sql import functions as F

from sparkretail.operators import compare, matching, windows
from sparkretail.sources import readers, schemas
from sparkretail.sources.readers import plan_text
from sparkretail.streaming import attribution
from sparkretail.synth import clicks as synth
from sparkretail.synth.sales import key_range

START = dt.datetime(2024, 6, 1, 12)
PARTITIONS = 2


def at(minute, second=0):
    return START + dt.timedelta(minutes=minute, seconds=second)


def run_stream(spark, tmp_path, imps, purs, n_files):
    base = str(tmp_path)
    attribution.write_slices(imps, "minute", n_files, f"{base}/imp")
    attribution.write_slices(purs, "minute", n_files, f"{base}/pur")
    pairs = attribution.attribute(
        readers.stream_files(spark, f"{base}/imp", schemas.IMPRESSIONS),
        readers.stream_files(spark, f"{base}/pur", schemas.PURCHASES),
    )
    assert pairs.isStreaming
    attribution.drain_to_files(pairs, f"{base}/out", f"{base}/ckpt", PARTITIONS)
    return spark.read.schema(pairs.schema).parquet(f"{base}/out")


def batch_pairs(imps, purs):
    return attribution.attribute(imps.drop("minute"), purs.drop("minute"))


def test_worked_example(spark, tmp_path):
    imps = spark.createDataFrame(
        [(0, "i1", "vis-1", "camp-summer", at(0), "web"), (4, "i2", "vis-1", "camp-retarget", at(4), "web"),
         (1, "i3", "vis-2", "camp-summer", at(1), "web"), (0, "i4", "vis-4", "camp-summer", at(0), "web")]
        # A visitor without purchases keeps event time moving in every file.
        + [(m, f"tick{m}", "vis-tick", "c", at(m, 30), "web") for m in range(12)],
        "minute INT, " + schemas.IMPRESSIONS,
    )
    purs = spark.createDataFrame(
        [(8, "p1", "vis-1", 17, D("24.00"), at(8)), (11, "p2", "vis-4", 44, D("11.00"), at(11)),
         (5, "p3", "vis-3", 99, D("9.00"), at(5)), (10, "p4", "vis-1", 17, D("24.00"), at(3))]
        + [(m, f"tock{m}", "vis-tock", 1, D("1.00"), at(m, 30)) for m in range(12)],
        "minute INT, " + schemas.PURCHASES,
    )
    got = run_stream(spark, tmp_path, imps, purs, 12)
    on_time = [("i1", "p1", "vis-1", "camp-summer", 17, D("24.00")), ("i2", "p1", "vis-1", "camp-retarget", 17, D("24.00"))]
    assert collect(got) == on_time
    late = attribution.stream_batch_difference(batch_pairs(imps, purs), got)
    assert [(r.impression_id, r.purchase_id, r.surplus) for r in late.collect()] == [("i1", "p4", 1)]


def test_clean_drop_equals_batch(spark, tmp_path):
    imps, purs = synth.impressions(spark, synth.CLEAN_DROP), synth.purchases(spark, synth.CLEAN_DROP)
    got = run_stream(spark, tmp_path, imps, purs, synth.CLEAN_DROP.files)
    assert got.count() > 0
    assert attribution.stream_batch_difference(batch_pairs(imps, purs), got).isEmpty()


def test_restart_continues_from_the_checkpoint(spark, tmp_path):
    imps, purs = synth.impressions(spark, synth.CLEAN_DROP), synth.purchases(spark, synth.CLEAN_DROP)
    base, half = str(tmp_path), synth.CLEAN_DROP.files // 2

    def drain():
        pairs = attribution.attribute(
            readers.stream_files(spark, f"{base}/imp", schemas.IMPRESSIONS),
            readers.stream_files(spark, f"{base}/pur", schemas.PURCHASES),
        )
        attribution.drain_to_files(pairs, f"{base}/out", f"{base}/ckpt", PARTITIONS)
        return spark.read.schema(pairs.schema).parquet(f"{base}/out")

    attribution.write_slices(imps, "minute", half, f"{base}/imp")
    attribution.write_slices(purs, "minute", half, f"{base}/pur")
    first = drain().count()
    for n in range(half, synth.CLEAN_DROP.files):
        for df, side in ((imps, "imp"), (purs, "pur")):
            df.filter(F.col("minute") == n).drop("minute").coalesce(1).write.mode("append").parquet(f"{base}/{side}")
    whole = drain()
    assert 0 < first < whole.count()
    # Pairs across the restart are there, none is written twice.
    assert compare.same_rows(batch_pairs(imps, purs), whole)


def test_late_drop_loses_late_pairs_only(spark, tmp_path):
    spec = synth.StreamSpec(files=12, visitors=600, impressions=600, ontime=80, orphan=8, wide=8, late=40, late_from=8)
    imps, purs = synth.impressions(spark, spec), synth.purchases(spark, spec)
    got = run_stream(spark, tmp_path, imps, purs, spec.files)
    lost = attribution.stream_batch_difference(batch_pairs(imps, purs), got).collect()
    assert lost and all(r.surplus > 0 and "-late-" in r.purchase_id for r in lost)
    # Event time of every late purchase lies at least four minutes before its file, so
    # the watermark of the batch before has passed it for files from the ninth on.
    clearly = purs.filter("purchase_id LIKE '%-late-%' AND purchase_ts < TIMESTAMP '2024-06-01 12:04:00'")
    assert got.join(clearly, "purchase_id", "left_semi").isEmpty()
    assert got.filter("purchase_id LIKE '%-ontime-%'").count() > 500


def test_published_drop_sizes(spark):
    spec = synth.LATE_DROP
    imps, purs = synth.impressions(spark, spec), synth.purchases(spark, spec)
    assert imps.count() == 72_000
    kinds = {r.k: r["count"] for r in purs.groupBy(F.split("purchase_id", "-")[2].alias("k")).count().collect()}
    assert kinds["late"] == 800 and kinds["orphan"] == 960 and kinds["wide"] == 80
    assert 9_000 < kinds["ontime"] <= 9_600
    pairs = batch_pairs(imps, purs)
    of = lambda k: pairs.filter(F.col("purchase_id").contains(f"-{k}-"))
    assert of("orphan").isEmpty()
    assert of("ontime").select("purchase_id").distinct().count() == kinds["ontime"]
    assert of("late").select("purchase_id").distinct().count() == kinds["late"]


@pytest.mark.parametrize("within", [1, 60, 3600])
def test_interval_pairs_match_the_plain_range_join(spark, within):
    a = spark.range(2_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 20).alias("v"),
        F.timestamp_seconds((F.col("id") * 7_919) % 40_000).alias("a_ts"), F.col("id").alias("a_id"),
    )
    b = spark.range(1_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 20).alias("v"),
        F.timestamp_seconds((F.col("id") * 104_729) % 40_000).alias("b_ts"), F.col("id").alias("b_id"),
    )
    got = matching.interval_pairs(a, b, "v", "a_ts", "b_ts", within, rows_per_task=10).select("a_id", "b_id")
    plain = matching.interval_pairs(a, b, "v", "a_ts", "b_ts", within, rows_per_task=None).select("a_id", "b_id")
    seconds = F.unix_micros("b_ts") - F.unix_micros("a_ts")
    want = a.join(b, "v").filter(seconds.between(0, within * 1_000_000)).select("a_id", "b_id")
    assert compare.same_rows(want, got) and compare.same_rows(want, plain)


def test_interval_pairs_join_on_key_and_slot(spark):
    a = spark.range(10).select(F.col("id").alias("v"), F.timestamp_seconds("id").alias("a_ts"))
    b = spark.range(10).select(F.col("id").alias("v"), F.timestamp_seconds("id").alias("b_ts"))
    text = plan_text(matching.interval_pairs(a, b, "v", "a_ts", "b_ts", 60).hint("merge"))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "_slot" in text


def test_catalog_and_enrichment(spark):
    products = spark.range(1, 2_001).withColumnRenamed("id", "product_id")
    cat = synth.catalog(products, 5, tie_rate=0.01, payload_chars=16).persist()
    ties = cat.filter(F.col("product_name").endswith("-alt")).count()
    assert cat.count() == 10_000 + ties and 5 < ties < 40
    assert cat.select(F.length("payload")).distinct().collect() == [(16,)]
    current = windows.current_catalog(cat)
    assert current.count() == 2_000
    # '-alt' sorts before '-v004', so a tie always wins.
    assert current.filter(F.col("product_name").endswith("-alt")).count() == ties
    events = synth.click_events(key_range(spark, 20_000), 2_000, 0.03)
    assert [(f.name, f.dataType.simpleString()) for f in events.schema] == [
        ("event_id", "bigint"), ("product_id", "int"), ("event_type", "string"), ("amount", "decimal(10,2)"),
        ("quantity", "int"), ("session_id", "string"), ("visitor_id", "string"), ("channel", "string"),
        ("country_code", "string"),
    ]
    orphans = events.filter("product_id > 2000").count()
    assert abs(orphans / 20_000 - 0.03) < 0.005
    for max_bytes in (10**9, 0):
        out = matching.enrich_current(events, cat, max_bytes)
        assert out.count() == 20_000 - orphans
        assert out.columns == [
            "event_id", "product_id", "event_type", "amount", "product_name", "category", "brand",
            "list_price", "effective_ts",
        ]


def test_wide_events(spark):
    out = synth.wide_events(key_range(spark, 3_000), payload_chars=256)
    stats = out.agg(F.min(F.length("payload")), F.max(F.length("payload")), F.countDistinct("payload"), F.min("event_ts"), F.max("event_ts")).first()
    assert stats[:3] == (256, 256, 3_000)
    assert dt.datetime(2024, 6, 1) <= stats[3] < stats[4] < dt.datetime(2024, 7, 1)
    assert out.schema["amount"].dataType.simpleString() == "decimal(12,2)"
