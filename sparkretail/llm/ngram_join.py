"""Jaccard self-join of documents on their word shingles, with connected components.

Steps, each a Spark stage:

1. Every text becomes its set of shingle hashes. Texts with equal sets are one class.
2. The hash universe is cut into buckets. Each bucket counts in how many classes a
   shingle occurs. A shingle of one class only cannot be in any intersection, so a class
   with too few shared shingles can have no partner and leaves here. This is exact.
3. Pigeonhole: classes are put into bands of sizes. For each band the shared shingles are
   hashed into segments. Two linked sets differ in at most D shingles, so among D + 1
   non-empty segments one is equal in both. A segment may instead be indexed with its
   one-deletion neighbourhood; it then stands one difference and counts as two. The order
   of the segments and their allocation (0, 1 or 2) follow from costs counted on all
   classes of the band: expected members per list against entries added.
4. All classes of an index list are compared with the list's pivot, exactly. Classes that
   are not linked with their pivot are compared with the pivot's other classes, in blocks.
5. The links give the components.

No list is expanded into pairs: a list of g entries yields g comparisons with its pivot,
and only what is left over meets in blocks of ``BLOCK`` rows.

Class ids and shingles are 64-bit hashes. Comparisons use 40 bits of a shingle besides its
bucket, so a false match within a pair of documents has a chance of about 1e-8.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkretail.llm.common import durable, unused
from sparkretail.llm.components import components
from sparkretail.llm.shingles import U64, mix, text_shingles

TOKENS_PER_BUCKET = 2_000_000
LEAST_BUCKETS = 48
FLUSH = 1_000_000  # shingles held by a scan task before it hands them on
BLOCK = 512  # rows of each side in a block of left-over comparisons
BROADCAST_ROWS = 500_000  # rows to drop (16 bytes each) that are sent to all tasks; beyond, a shuffled join
COSTED_SEGMENTS = 4096  # bands with more segments (sets above 10,000 shingles) keep the plain order
LOW = U64((1 << 40) - 1)

ROWS = "doc_id long, key long, cid long, n int"
SCAN = "bucket int, tokens binary, cids binary, counts binary"
COUNTED = "bucket int, cid long, shared int, weight double, tokens binary"
ALIVE = "cid long, n int, shared int, centre double, tokens array<bigint>, dfs binary"


def _pack(low: np.ndarray) -> np.ndarray:
    return low.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]


def _unpack(raw: np.ndarray) -> np.ndarray:
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, :5] = raw[:, :5]
    return wide.view("<u8").ravel()


def _binary(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Consecutive pieces of ``data`` as a binary column."""
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    buffers = [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(np.ascontiguousarray(data).tobytes())]
    return pa.Array.from_buffers(pa.binary(), len(sizes), buffers)


def _sets(column: pa.Array, width: int) -> Iterator[tuple[np.ndarray, int | None]]:
    """The distinct shingles of each text and the id of its class, null without shingles."""
    for _, grams, edges in text_shingles(column, width):
        for i in range(len(edges) - 1):
            own = np.unique(grams[edges[i] : edges[i + 1]])
            if not len(own):
                yield own, None
                continue
            total = mix(own ^ U64(0x5851F42D4C957F2D)).sum(dtype=U64) + U64(len(own))
            yield own, int(mix(np.array([total], U64)).view(np.int64)[0])


def _rows(width: int):
    """Class and size of every document."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(cid, len(own)) for own, cid in _sets(batch.column(2), width)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([f[0] for f in found], pa.int64()),
                 pa.array([f[1] for f in found], pa.int32())],
                names=["doc_id", "key", "cid", "n"],
            )

    return rows


def _scan(buckets: int, width: int):
    """The shingles of the classes, by bucket."""

    def packed(sets, cids):
        sizes = np.array([len(s) for s in sets])
        tokens = np.concatenate(sets)
        bucket = ((tokens >> U64(40)) % U64(buckets)).astype(np.uint32)
        owner = np.repeat(np.arange(len(sets)), sizes)
        order = np.argsort(bucket, kind="stable")
        bucket, owner, low = bucket[order], owner[order], tokens[order] & LOW
        new = np.ones(len(order), bool)
        new[1:] = (bucket[1:] != bucket[:-1]) | (owner[1:] != owner[:-1])
        runs = np.flatnonzero(new)
        counts = np.diff(np.append(runs, len(order))).astype("<u4")
        named, first, entries = np.unique(bucket[runs], return_index=True, return_counts=True)
        per_bucket = np.add.reduceat(counts, first).astype(np.int64)
        run_cids = np.array(cids, np.int64)[owner[runs]]
        return pa.RecordBatch.from_arrays(
            [pa.array(named.astype(np.int32)), _binary(_pack(low), per_bucket * 5),
             _binary(run_cids, entries * 8), _binary(counts, entries * 4)],
            names=["bucket", "tokens", "cids", "counts"],
        )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, cids, known, held = [], [], set(), 0
        for batch in batches:
            for own, cid in _sets(batch.column(0), width):
                if cid is None or cid in known:
                    continue
                known.add(cid)
                sets.append(own)
                cids.append(cid)
                held += len(own)
                if held >= FLUSH:
                    yield packed(sets, cids)
                    sets, cids, known, held = [], [], set(), 0
        if sets:
            yield packed(sets, cids)

    return scan


def _count(table: pa.Table) -> pa.Table:
    """One bucket: which shingles occur in more than one class."""

    def joined(name):
        return b"".join(table.column(name).to_pylist())

    bucket = table.column("bucket")[0].as_py()
    cids = np.frombuffer(joined("cids"), np.int64)
    counts = np.frombuffer(joined("counts"), "<u4").astype(np.int64)
    raw = np.frombuffer(joined("tokens"), np.uint8).reshape(-1, 5)
    _, first = np.unique(cids, return_index=True)  # a class sent by several scan tasks counts once
    kept = np.zeros(len(cids), bool)
    kept[first] = True
    raw = raw[np.repeat(kept, counts)]
    cids, counts = cids[kept], counts[kept]
    tokens = _unpack(raw)
    order = np.argsort(tokens, kind="stable")
    ordered = tokens[order]
    runs = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
    lengths = np.diff(np.append(runs, len(ordered)))
    df = np.empty(len(tokens), np.int64)
    df[order] = np.repeat(lengths, lengths)
    shared = df > 1
    owner = np.repeat(np.arange(len(cids)), counts)[shared]
    log_df = np.log2(df[shared])
    level = np.minimum(255, log_df * 8).astype(np.uint8)
    sizes = np.bincount(owner, minlength=len(cids))
    weights = np.bincount(owner, log_df, minlength=len(cids)).astype(float)  # integers if there are none
    some = sizes > 0
    return pa.table(
        [pa.array(np.full(int(some.sum()), bucket, np.int32)), pa.array(cids[some]),
         pa.array(sizes[some].astype(np.int32)), pa.array(weights[some]),
         _binary(np.column_stack([raw[shared], level]), sizes[some] * 6)],
        names=["bucket", "cid", "shared", "weight", "tokens"],
    )


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The shared shingles of a class as one sorted list."""
    for batch in batches:
        lists, levels = [], []
        for pieces in batch.column(4):
            tokens, dfs = [], []
            for piece in pieces.as_py():
                raw = np.frombuffer(piece["tokens"], np.uint8).reshape(-1, 6)
                tokens.append(_unpack(raw) | (U64(piece["bucket"]) << U64(40)))
                dfs.append(raw[:, 5])
            tokens, dfs = np.concatenate(tokens), np.concatenate(dfs)
            order = np.argsort(tokens)
            lists.append(tokens[order].astype(np.int64))
            levels.append(dfs[order].tobytes())
        sizes = np.array([len(x) for x in lists], np.int64)
        offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
        values = np.concatenate(lists) if lists else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), batch.column(2), batch.column(3),
             pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)), pa.array(levels, pa.binary())],
            names=["cid", "n", "shared", "centre", "tokens", "dfs"],
        )


class Bands:
    """Bands of set sizes, their segment counts and the differences a linked pair may have."""

    def __init__(self, percent: int, largest: int):
        self.percent = percent
        edges = [1]
        while edges[-1] <= largest:  # the last edge is above the largest set
            edges.append(100 * edges[-1] // percent + 1)
        self.edges = np.array(edges, np.int64)

    def of(self, n: int) -> int:
        return int(np.searchsorted(self.edges, n, "right")) - 1

    def differences(self, total: int) -> int:
        return (100 - self.percent) * total // (100 + self.percent)

    def need(self, band: int) -> int:
        """Segments that hold an equal one for any linked pair of the band."""
        top = int(self.edges[band + 1]) - 1
        return self.differences(top + 100 * top // self.percent) + 1

    def segments(self, band: int) -> int:
        """A quarter more, since some segments of a set stay empty."""
        return self.need(band) + max(2, math.ceil(self.need(band) / 4))

    def roles(self, n: int) -> list[tuple[int, int]]:
        """(band, most differences to a partner): as the smaller set, and as the larger one."""
        own = self.of(n)
        found = [(own, self.differences(n + 100 * n // self.percent))]
        if own:
            found.append((own - 1, self.differences(n + int(self.edges[own]) - 1)))
        return found


def _salt(band: int, factor: int) -> np.uint64:
    return U64((band + 1) * factor % 2**64)


def _segments(tokens: np.ndarray, band: int, count: int):
    """Shingles ordered by segment: (order, non-empty segments, where they start)."""
    seeds = mix(tokens + _salt(band, 0xD6E8FEB86659FD93))
    segment = (seeds % U64(count)).astype(np.int64)
    order = np.argsort(segment, kind="stable")
    named, first = np.unique(segment[order], return_index=True)
    return order, named, first


def _costs(bands: Bands):
    """Per band and segment: classes, shingles, and members that its lists are expected to have."""

    def costs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            sizes = batch.column(0).to_pylist()
            for n, tokens, dfs in zip(sizes, batch.column(1), batch.column(2), strict=True):
                tokens = tokens.values.to_numpy().view(U64)
                level = np.frombuffer(dfs.as_py(), np.uint8)
                for band, _ in bands.roles(n):
                    count = bands.segments(band)
                    if count > COSTED_SEGMENTS:
                        continue
                    order, named, first = _segments(tokens, band, count)
                    rarest = np.minimum.reduceat(level[order], first)
                    into = sums.setdefault(band, np.zeros((3, count)))
                    into[0, named] += 1
                    into[1, named] += np.diff(np.append(first, len(order)))
                    into[2, named] += np.exp2(rarest / 8)
        for band, (sets, size, members) in sums.items():
            k = len(sets)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(k, band, np.int32)), pa.array(np.arange(k, dtype=np.int32)),
                 pa.array(sets), pa.array(size), pa.array(members)],
                names=["band", "segment", "sets", "size", "members"],
            )

    return costs


def allocate(need: int, sets: np.ndarray, size: np.ndarray, members: np.ndarray):
    """(place of each segment in the order, its allocation) for one band.

    Segments come by the members their lists are expected to have. Entries: a list costs
    its expected members, a one-deletion neighbourhood one entry per shingle of the
    segment. While the dearest segment within ``need`` costs more than the neighbourhood
    of the cheapest plain one, that one is allocated 2 and the dearest 0: it comes last and
    is used only by a set that has too few others.
    """
    seen = np.maximum(sets, 1)
    list_cost = np.where(sets > 0, members / seen, np.inf)
    extra = size / seen
    order = np.argsort(list_cost, kind="stable")
    allocation = np.ones(len(order), np.int8)
    low, high = 0, min(need, len(order)) - 1
    while low < high and sets[order[high]] and list_cost[order[high]] > extra[order[low]] + list_cost[order[low]]:
        allocation[order[low]] = 2
        low, high = low + 1, high - 1
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return place, allocation


def signatures(tokens: np.ndarray, n: int, bands: Bands, layouts: dict) -> np.ndarray:
    """Index entries of a set of ``n`` shingles of which ``tokens`` are shared."""
    unique = n - len(tokens)
    found = []
    for band, differences in bands.roles(n):
        need = differences - unique + 1
        if need < 1:
            continue
        count = bands.segments(band)
        order, named, first = _segments(tokens, band, count)
        values = mix(tokens[order] + U64(0xA24BAED4963EE407))
        sums = np.add.reduceat(values, first)
        sizes = np.diff(np.append(first, len(order)))
        place, allocation = layouts.get(band, (np.arange(count), np.ones(count, np.int8)))
        by_place = np.argsort(place[named])
        reach = np.cumsum(np.minimum(allocation[named], sizes)[by_place])
        used = by_place[: int(np.searchsorted(reach, need)) + 1]
        salt = named.astype(U64) * U64(0x9E3779B97F4A7C15) + _salt(band, 0xC2B2AE3D27D4EB4F)
        found.append(mix(sums[used] + salt[used]))
        double = np.zeros(len(named), bool)
        double[used] = (allocation[named] == 2)[used] & (sizes[used] > 1)
        if double.any():
            owner = np.repeat(np.arange(len(named)), sizes)
            mine = double[owner]
            found.append(mix(sums[owner[mine]] - values[mine] + salt[owner[mine]]))
        if not len(reach) or reach[-1] < need:  # too few non-empty segments: the empty ones count too
            empty = np.setdiff1d(np.arange(count), named).astype(U64)
            found.append(mix(empty * U64(0x9E3779B97F4A7C15) + _salt(band, 0xC2B2AE3D27D4EB4F)))
    return np.concatenate(found) if found else np.zeros(0, U64)


def _index(bands: Bands, layouts: dict):
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cids, sizes, centres = (batch.column(i).to_pylist() for i in range(3))
            entries = [
                signatures(t.values.to_numpy().view(U64), n, bands, layouts)
                for t, n in zip(batch.column(3), sizes, strict=True)
            ]
            counts = [len(e) for e in entries]
            if sum(counts):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(entries).view(np.int64)),
                     pa.array(np.repeat(np.array(cids, np.int64), counts)),
                     pa.array(np.repeat(np.array(centres, float), counts))],
                    names=["sig", "cid", "centre"],
                )

    return index


def _left_over(percent: int):
    """Left-over classes of a pivot against a block of its classes; a link per other label."""

    def check(table: pa.Table) -> pa.Table:
        odd = table.filter(pc.equal(table.column("side"), 0))
        other = table.filter(pc.equal(table.column("side"), 1))
        left, right = [], []
        if len(odd) and len(other):
            def columns(part):
                lists = part.column("tokens").combine_chunks()
                lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
                sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
                return [part.column(x).to_numpy() for x in ("cid", "n", "label")] + [lists.flatten().to_numpy(), sizes]

            cid, n, label, flat, sizes = columns(other)
            starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            named, places = np.unique(flat, return_inverse=True)
            cid_o, n_o, label_o, flat_o, sizes_o = columns(odd)
            ends = np.cumsum(sizes_o)
            mark = np.zeros(len(named), np.int64)
            for i in range(len(cid_o)):
                own = flat_o[ends[i] - sizes_o[i] : ends[i]]
                able = (label != label_o[i]) & (
                    (100 + percent) * np.minimum(sizes, sizes_o[i]) >= percent * (n + n_o[i])
                )
                if not able.any():
                    continue
                at = np.minimum(np.searchsorted(named, own), len(named) - 1)
                at = at[named[at] == own]
                mark[at] = 1
                overlap = np.add.reduceat(mark[places], starts)
                mark[at] = 0
                linked = np.flatnonzero(able & ((100 + percent) * overlap >= percent * (n + n_o[i])))
                _, first = np.unique(label[linked], return_index=True)
                left += [cid_o[i]] * len(first)
                right += cid[linked[first]].tolist()
        return pa.table([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])

    return check


def _links(alive: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between classes that join all similar classes into components."""
    largest = alive.agg(F.max("n")).first()[0] or 1
    bands = Bands(percent, largest)
    stats = (
        alive.select("n", "tokens", "dfs")
        .mapInArrow(_costs(bands), "band int, segment int, sets double, size double, members double")
        .groupBy("band", "segment")
        .agg(F.sum("sets").alias("sets"), F.sum("size").alias("size"), F.sum("members").alias("members"))
        .toArrow()  # one row per band and segment: bounded by COSTED_SEGMENTS and the bands
        .to_pandas()
    )
    layouts = {}
    for band, rows in stats.groupby("band"):
        rows = rows.sort_values("segment")
        count = bands.segments(int(band))
        full = np.zeros((3, count))
        full[:, rows.segment] = rows[["sets", "size", "members"]].to_numpy().T
        layouts[int(band)] = allocate(bands.need(int(band)), *full)

    entries = alive.select("cid", "n", "centre", "tokens").mapInArrow(_index(bands, layouts), "sig long, cid long, centre double")
    pivots = (
        entries.groupBy("sig")
        .agg(F.max(F.struct("centre", "cid")).alias("top"), F.count("*").alias("g"))
        .where("g > 1")
        .select("sig", F.col("top.cid").alias("pivot"))
    )
    stars = entries.join(pivots, "sig").where("cid <> pivot").select("cid", "pivot").distinct()
    sets = alive.select("cid", "n", "shared", "tokens")
    other = sets.select([F.col(c).alias(f"{c}_p") for c in sets.columns]).withColumnRenamed("cid_p", "pivot")
    overlap = F.size(F.array_intersect("tokens", "tokens_p"))
    able = (100 + percent) * F.least("shared", "shared_p") >= percent * (F.col("n") + F.col("n_p"))
    near = (100 + percent) * overlap >= percent * (F.col("n") + F.col("n_p"))
    light, light_p = sets.drop("tokens"), other.drop("tokens_p")
    stars = durable(stars.join(light, "cid").join(light_p, "pivot").select("cid", "pivot", able.alias("able")))
    near = (
        stars.where("able").select("cid", "pivot").join(sets, "cid").join(other, "pivot")
        .select("cid", "pivot", near.alias("near"))
    )
    stars = durable(
        near.unionByName(stars.where("NOT able").select("cid", "pivot", F.lit(False).alias("near")))
    )

    links = stars.where("near").select(F.col("cid").alias("a"), F.col("pivot").alias("b"))
    labels = durable(components(links))

    def labelled(df: DataFrame, node: str, name: str) -> DataFrame:
        own = labels.select(F.col("node").alias(node), F.col("label").alias(name))
        return df.join(own, node, "left").withColumn(name, F.coalesce(name, node))

    members = labelled(labelled(stars, "cid", "label"), "pivot", "pivot_label")
    odd = members.where("label <> pivot_label").select("cid", "pivot", "label")
    mixed = odd.groupBy("pivot").agg(F.count("*").alias("odd"))
    of_mixed = members.select("cid", "pivot", "label").join(mixed.select("pivot"), "pivot")
    sizes = of_mixed.groupBy("pivot").agg(F.count("*").alias("members")).join(mixed, "pivot")
    sizes = sizes.select(
        "pivot",
        F.ceil(F.col("odd") / BLOCK).cast("int").alias("odd_blocks"),
        F.ceil(F.col("members") / BLOCK).cast("int").alias("member_blocks"),
    )

    def dealt(df: DataFrame, side: int, own: str, across: str, own_name: str, across_name: str) -> DataFrame:
        return (
            df.join(sizes, "pivot")
            .join(sets, "cid")
            .withColumn(own_name, F.pmod(F.xxhash64("cid"), F.col(own)).cast("int"))
            .withColumn(across_name, F.explode(F.sequence(F.lit(0), F.col(across) - 1)))
            .select("pivot", "i", "j", F.lit(side).alias("side"), "cid", "n", "label", "tokens")
        )

    blocks = dealt(odd, 0, "odd_blocks", "member_blocks", "i", "j").unionByName(
        dealt(of_mixed, 1, "member_blocks", "odd_blocks", "j", "i")
    )
    more = blocks.groupBy("pivot", "i", "j").applyInArrow(_left_over(percent), "a long, b long")
    return links.unionByName(more)


def _classified(docs: DataFrame, percent: int, width: int, id_column: str, text_column: str) -> DataFrame:
    """Per row: doc_id, key of the text, shingles, class, component class and its smallest id."""
    docs = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.xxhash64(F.col(text_column)).alias("key"),
        F.col(text_column).alias("text"),
    )
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(LEAST_BUCKETS, math.ceil(size / 6 / TOKENS_PER_BUCKET))
    rows = durable(docs.mapInArrow(_rows(width), ROWS))
    classes = (
        rows.where("cid IS NOT NULL").groupBy("cid").agg(F.min("doc_id").alias("low"), F.max("n").alias("n"))
    )
    alive = (
        docs.select("text")
        .mapInArrow(_scan(buckets, width), SCAN)
        .groupBy("bucket")
        .applyInArrow(_count, COUNTED)
        .groupBy("cid")
        .agg(
            F.sum("shared").cast("int").alias("shared"),
            F.sum("weight").alias("weight"),
            F.collect_list(F.struct("bucket", "tokens")).alias("pieces"),
        )
        .join(classes.select("cid", "n"), "cid")
        .where(100 * F.col("shared") >= percent * F.col("n"))
        .select("cid", "n", "shared", (F.col("weight") / F.col("n")).alias("centre"), "pieces")
    )
    alive = durable(alive.mapInArrow(_assemble, ALIVE))
    labels = components(_links(alive, percent))
    member = classes.join(labels.withColumnRenamed("node", "cid"), "cid", "left").withColumn(
        "label", F.coalesce("label", "cid")
    )
    lowest = member.groupBy("label").agg(F.min("low").alias("low_id"))
    return rows.join(member.select("cid", "label").join(lowest, "label"), "cid", "left")


def link_documents(
    docs: DataFrame, percent: int = 75, width: int = 5, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(doc_id, n_shingles, component_id, class_id) per row of ``docs``.

    Texts are linked when their sets of distinct ``width``-word shingles have a Jaccard
    similarity of at least ``percent``/100; ``component_id`` is the smallest id reachable
    by links. Words end at ASCII white space and A-Z count as a-z. A text with fewer words
    than ``width`` has its whole sequence as one shingle. Texts with equal sets have the
    same ``class_id``.

    Null, empty and blank texts have no shingles, link with nothing and are their own
    component; their ``class_id`` is null. Repeated rows are linked. A null id is a
    component id only where a component has no other. Other columns are ignored; an empty
    table gives an empty result.
    """
    found = _classified(docs, percent, width, id_column, text_column)
    component = F.when(F.col("cid").isNull(), F.col("doc_id")).otherwise(F.col("low_id"))
    return found.select(
        "doc_id",
        F.col("n").cast("long").alias("n_shingles"),
        component.alias("component_id"),
        F.col("cid").alias("class_id"),
    )


def keep_one(
    docs: DataFrame, percent: int = 75, width: int = 5, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id, null ids last.

    Rows without words all stay. All columns are kept as they are.
    """
    found = durable(_classified(docs, percent, width, id_column, text_column))
    worded = found.where("cid IS NOT NULL")
    top = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("top")
    first = worded.groupBy("label").agg(top)
    stays = F.col("doc_id").eqNullSafe(F.col("top.doc_id")) & (F.col("key") == F.col("top.key"))
    own, lost_id, lost_key = (unused(docs, name) for name in ("_key", "_lost_id", "_lost_key"))
    lost = (
        worded.join(first, "label").where(~stays).select("doc_id", "key").distinct()
        .select(F.col("doc_id").alias(lost_id), F.col("key").alias(lost_key))
    )
    lost = durable(lost)
    if lost.count() <= BROADCAST_ROWS:
        lost = F.broadcast(lost)
    keyed = docs.withColumn(own, F.xxhash64(F.col(text_column)))
    same = keyed[own].eqNullSafe(F.col(lost_key)) & keyed[id_column].cast("long").eqNullSafe(F.col(lost_id))
    kept = keyed.join(lost, same, "left_anti")
    repeated = worded.groupBy("doc_id", "key").count().where("count > 1").limit(1)
    if repeated.count():  # rows that repeat an id and its text: the join above keeps them all
        blank = F.coalesce(F.col(text_column), F.lit("")).rlike(r"^[\x20\x09-\x0D]*$")
        kept = kept.where(blank).unionByName(kept.where(~blank).dropDuplicates([id_column, own]))
    return kept.drop(own)
