"""Near-duplicate documents by an LSH forest of MinHash signatures.

Texts with equal shingle sets form a class. Each of ``TREES`` trees orders the classes by a label of its own, a row of
MinHash values. Classes that share the first ``DEPTH`` values of a label are a region. In a region of ``REGION``
classes at most all pairs are candidates; a denser one is searched deeper: there, the ``NEIGHBOURS`` next ones in label
order, which share the longest prefixes. A region of over ``HOT_REGION`` rows is dealt out over tasks by class. A pair of similarity 0.8 shares
no region of 24 trees with a chance of 3e-8, (1 - 0.8^3)^24; no other step loses a link.

Candidates pass if the sizes and parity sketches of their sets allow the similarity, and are then confirmed on full shingle
sets. A sketch holds, for each of ``SKETCH`` cells, whether an odd number of elements falls into it; two sketches differ in no more cells than the
sets do in elements, so a pair that this bound rules out is not similar. Confirming goes in two rounds: first the most similar partner of every class, then, across the components
found so far, every other candidate. Classes of dense regions meet once more, in a prefix-filter join: shingles have one
order, rarest first by a sketch of their counts, and two similar sets share one of their first ones. Classes of different components
that share such a shingle are candidates. Where more than ``FEW`` classes share it, the components it brings together form a
neighbourhood, and there every class outside the largest component is compared with every class of another
component whose size allows the similarity, and on full sets where bitmaps of the sets allow it too. The classes come
in blocks of ``BLOCK`` of similar size, so these pairs are neither written nor gathered.

Defined results: words are split at ASCII white space and only A-Z is lower-cased; a text of fewer words than a shingle has
one shingle; a text without words, or null, has none and is linked with nothing; a text of any length counts whole; repeated
rows share a component; ties in similarity change nothing, as every link counts; null doc_ids are never a component's id
unless they stand alone; an empty table gives an empty result; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldlens.llm._common import materialize, read
from fieldlens.llm._text import blocks, mix, shingle_sets
from fieldlens.llm.components import components

TREES, DEPTH, DEEPER = 24, 3, 3
VALUES = TREES * DEPTH
REGION, NEIGHBOURS, BLOCK = 16, 4, 512
FEW = 32
SKETCH = 2048
HOT_REGION = 100_000
SKETCH_BITS = 18  # of a shingle that pick its counter; counts only order shingles, any order gives the same links
BROADCAST_IDS = 1_000_000
ROWS_PER_PART = 2_000_000

_RANDOM = np.random.default_rng(7_919)
_XOR = _RANDOM.integers(0, 1 << 32, VALUES, dtype=np.uint32)
_TIMES = _RANDOM.integers(0, 1 << 31, VALUES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def signatures(hashes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """VALUES MinHash values of each set; sets without elements have the largest value throughout."""
    out = np.full((len(ends) - 1, VALUES), 0xFFFFFFFF, np.uint32)
    full = np.flatnonzero(np.diff(ends))
    if len(full):
        folded = (hashes >> np.uint64(32)).astype(np.uint32)
        starts = ends[:-1][full]
        for v in range(VALUES):
            out[full, v] = np.minimum.reduceat((folded ^ _XOR[v]) * _TIMES[v], starts)
    return out


def sketches(hashes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each set its cells' parities as words of 64 bits, and its size as the last word."""
    n = len(ends) - 1
    out = np.zeros((n, SKETCH // 64 + 1), np.uint64)
    out[:, -1] = np.diff(ends)
    for at in range(0, n, 1024):
        to = min(at + 1024, n)
        mine = hashes[ends[at] : ends[to]]
        row = np.repeat(np.arange(to - at), np.diff(ends[at : to + 1]))
        odd = np.bincount(row * SKETCH + (mine & np.uint64(SKETCH - 1)).astype(np.int64), minlength=(to - at) * SKETCH).astype(np.uint8) & 1
        out[at:to, :-1] = np.packbits(odd.reshape(-1, SKETCH), axis=1).view(np.uint64)
    return out


def allowed(x: np.ndarray, y: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Whether pairs of sketches allow the similarity, and an estimate of it that orders pairs."""
    differ = np.bitwise_count(x[:, :-1] ^ y[:, :-1]).sum(axis=1, dtype=np.int64)
    total = (x[:, -1] + y[:, -1]).astype(np.int64)
    sizes = 100 * np.minimum(x[:, -1], y[:, -1]) >= percent * np.maximum(x[:, -1], y[:, -1])
    return sizes & ((100 + percent) * differ <= (100 - percent) * total), 1 - differ / np.maximum(total, 1)


def _binaries(words: np.ndarray) -> pa.Array:
    width = words.shape[1] * words.itemsize
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(words), [None, pa.py_buffer(words.tobytes())]).cast(pa.binary())


def _set_keys(hashes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(hashes + np.uint64(0x51ED270B)))])
    return mix(total[ends[1:]] - total[ends[:-1]] + np.diff(ends).astype(np.uint64)).view(np.int64)


def _shingled(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in blocks(batches, "text"):
        hashes, ends = shingle_sets(batch.column("text"), width)
        columns = [batch.column("doc_id"), batch.column("text_key"), pa.array(np.diff(ends)), pa.array(_set_keys(hashes, ends))]
        columns += [_binaries(signatures(hashes, ends)), _binaries(sketches(hashes, ends))]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_key", "n_shingles", "k", "signature", "sketch"])


def _tree_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, 1000):
            batch = whole.slice(at, 1000)
            n = batch.num_rows
            signed = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint32).reshape(n, VALUES)
            k, size = batch.column("k").to_numpy(), batch.column("n_shingles").to_numpy()
            columns: list[list] = [[], [], [], [], [], []]
            for t in range(TREES):
                label = signed[:, [(DEPTH * t + i) % VALUES for i in range(DEPTH + DEEPER)]]
                key = np.full(n, mix(np.array([t + 1], np.uint64))[0])
                for i in range(DEPTH):
                    key = mix(key ^ label[:, i].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                for column, value in zip(columns, (key.view(np.int64), *(label[:, DEPTH + i].astype(np.int64) for i in range(DEEPER)), k, size)):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in columns], ["region", "d0", "d1", "d2", "k", "n"])


def _neighbours(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Candidate pairs (kind 0) of rows sorted by region and label, and the classes of dense regions (kind 1). Rows that are hot are a part of a dense region."""

    def pairs(key, k, n, hot, dense) -> pa.RecordBatch:
        cut = np.flatnonzero(np.diff(key)) + 1
        runs = np.diff(np.concatenate([[0], cut, [len(key)]]))
        size = np.repeat(runs, runs)
        deep = (size > REGION) | dense | hot
        a, b = [], []
        for d in range(1, min(REGION, len(key))):
            ok = (key[d:] == key[:-d]) & (~deep[d:] | (d <= NEIGHBOURS)) & (np.minimum(n[d:], n[:-d]) >= least * np.maximum(n[d:], n[:-d]))
            if ok.any():
                a.append(k[:-d][ok])
                b.append(k[d:][ok])
        low = np.concatenate([np.minimum(x, y) for x, y in zip(a, b)] + [k[deep]])
        high = np.concatenate([np.maximum(x, y) for x, y in zip(a, b)] + [k[deep]])
        kind = np.concatenate([np.zeros(sum(map(len, a)), np.int32), np.ones(int(deep.sum()), np.int32)])
        return pa.RecordBatch.from_arrays([pa.array(low), pa.array(high), pa.array(kind)], ["a", "b", "kind"])

    held = [np.zeros(0, np.int64)] * 3 + [np.zeros(0, bool)]
    dense = np.zeros(0, bool)
    for batch in batches:
        rows = [np.concatenate([h, batch.column(c).to_numpy()]) for h, c in zip(held[:3], ("region", "k", "n"))]
        rows.append(np.concatenate([held[3], batch.column("hot").to_numpy(zero_copy_only=False)]))
        dense = np.concatenate([dense, np.zeros(len(rows[0]) - len(dense), bool)])
        key = rows[0]
        if not len(key):
            continue
        if dense[0]:
            dense[: int(np.searchsorted(key, key[0], "right"))] = True
        last = int(np.searchsorted(key, key[-1], "left"))
        if dense[last:].any():
            dense[last:] = True
        if len(key) - last > 4 * REGION:  # a dense region goes on: pass it on but for its last rows
            dense[last:] = True
            yield pairs(*rows, dense)
            held, dense = [r[-NEIGHBOURS:] for r in rows], np.ones(NEIGHBOURS, bool)
        else:
            if last:
                yield pairs(*(r[:last] for r in rows), dense[:last])
            held, dense = [r[last:] for r in rows], dense[last:]
    if len(held[0]):
        yield pairs(*held, dense)


def _allowed(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint64).reshape(-1, SKETCH // 64 + 1) for c in ("sa", "sb"))
        keep, estimate = allowed(x, y, percent)
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(estimate)], ["a", "b", "estimate"]).filter(pa.array(keep))


def _confirmed(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for x, y in zip(batch.column("sa").to_pylist(), batch.column("sb").to_pylist()):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(100 * both >= percent * (len(x) + len(y) - both))
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in blocks(batches, "text"):
        hashes, ends = shingle_sets(batch.column("text"), width)
        values = [hashes[ends[i] : ends[i + 1]].tobytes() for i in range(len(ends) - 1)]
        yield pa.RecordBatch.from_arrays([pa.array(_set_keys(hashes, ends)), pa.array(values, pa.binary())], ["k", "s"])


def _with_both(pairs: DataFrame, side: DataFrame, value: str) -> DataFrame:
    first = pairs.join(side.select(F.col("k").alias("a"), F.col(value).alias("sa")), "a")
    return first.join(side.select(F.col("k").alias("b"), F.col(value).alias("sb")), "b").select("a", "b", "sa", "sb")


def _labelled(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs with the component of either side (the class itself where it has no link yet)."""
    both = pairs.join(labels.select(F.col("node").alias("a"), F.col("label").alias("la")), "a", "left")
    both = both.join(labels.select(F.col("node").alias("b"), F.col("label").alias("lb")), "b", "left")
    return both.withColumn("la", F.coalesce("la", "a")).withColumn("lb", F.coalesce("lb", "b"))


def _joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The labels of components that ``links`` may join further."""
    if links.isEmpty():
        return labels
    known = labels.where("node <> label").select(F.col("node").alias("a"), F.col("label").alias("b"))
    return materialize(components(known.union(links.select("a", "b"))))


def _dealt(rows: DataFrame, n_classes: int) -> DataFrame:
    """Rows of the trees, with hot regions cut into parts of about HOT_REGION rows, each a region of its own that counts as dense."""
    if n_classes <= HOT_REGION:  # a region holds a class once
        return rows.withColumn("hot", F.lit(False))
    hot = rows.groupBy("region").count().where(F.col("count") > HOT_REGION).select("region", F.ceil(F.col("count") / HOT_REGION).alias("parts"))
    hot = materialize(hot)  # at most a row for HOT_REGION rows
    if hot.isEmpty():
        return rows.withColumn("hot", F.lit(False))
    hot = F.broadcast(hot) if hot.count() <= BROADCAST_IDS else hot
    cut = rows.join(hot, "region", "left").withColumn("hot", F.col("parts").isNotNull())
    return cut.withColumn("region", F.when(F.col("hot"), F.xxhash64("region", F.pmod(F.xxhash64("k"), "parts"))).otherwise(F.col("region"))).drop("parts")


def near_duplicates(docs: DataFrame, width: int = 4, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, text_key for every row of docs(doc_id, text)."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    keyed = texts.withColumn("text_key", F.xxhash64("text"))
    share = percent / 100
    every = materialize(keyed.mapInArrow(lambda b: _shingled(b, width), "doc_id long, text_key long, n_shingles long, k long, signature binary, sketch binary"))
    classes = materialize(every.where("n_shingles > 0").groupBy("k").agg(F.min("n_shingles").alias("n_shingles"), F.first("signature").alias("signature"), F.first("sketch").alias("sketch"), F.min("doc_id").alias("doc_id")))
    rows = classes.select("k", "n_shingles", "signature").mapInArrow(_tree_rows, "region long, d0 long, d1 long, d2 long, k long, n long")
    n_classes = classes.count()
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), n_classes * TREES // ROWS_PER_PART)
    ordered = _dealt(rows, n_classes).repartition(parts, "region").sortWithinPartitions("region", "d0", "d1", "d2", "k")
    found = materialize(ordered.mapInArrow(lambda b: _neighbours(b, share), "a long, b long, kind int").distinct())

    def possible(pairs: DataFrame) -> DataFrame:
        return _with_both(pairs, classes, "sketch").mapInArrow(lambda b: _allowed(b, percent), "a long, b long, estimate double")

    candidates = materialize(possible(found.where("kind = 0").select("a", "b")))
    dense = found.where("kind = 1").select(F.col("a").alias("k"))
    nodes = candidates.select(F.col("a").alias("k")).union(candidates.select("b")).union(dense.select("k")).distinct()
    nodes = materialize(nodes.join(classes.select("k", "doc_id"), "k"))
    sets = materialize(_class_sets(texts, nodes, width))

    def confirm(pairs: DataFrame) -> DataFrame:
        return _with_both(pairs, sets, "s").mapInArrow(lambda b: _confirmed(b, percent), "a long, b long")

    nearest = Window.partitionBy("k").orderBy(F.desc("estimate"), "a", "b")
    either = candidates.withColumn("k", F.col("a")).union(candidates.withColumn("k", F.col("b")))
    best = either.withColumn("r", F.row_number().over(nearest)).where("r = 1").select("a", "b").distinct()
    labels = materialize(components(confirm(best)))
    rest = _labelled(candidates.select("a", "b").join(best, ["a", "b"], "left_anti"), labels).where("la <> lb").select("a", "b")
    labels = _joined(labels, materialize(confirm(rest)))
    if not dense.isEmpty():
        prefixes = materialize(_prefixes(dense, labels, sets, percent))
        met = prefixes.groupBy("shingle").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("holders"))
        shared = materialize(prefixes.join(met.where("low <> high").select("shingle", "low", "holders"), "shingle"))
        few = materialize(_pairs_apart(shared.where(F.col("holders") <= FEW), percent))
        links = materialize(confirm(materialize(possible(few)).select("a", "b")))
        apart = materialize(shared.where((F.col("holders") > FEW) & (F.col("label") != F.col("low"))).select(F.col("low").alias("a"), F.col("label").alias("b")).distinct())
        if not apart.isEmpty():
            links = links.union(materialize(_across(dense, labels, apart, sets, percent)))
        labels = _joined(labels, links)

    # The smallest doc_id of each component, found on classes; documents then meet their class once.
    linked = labels.withColumnRenamed("node", "k").join(classes.select("k", "doc_id"), "k")
    least = linked.groupBy("label").agg(F.min("doc_id").alias("least"))
    of_class = classes.select("k", "doc_id").join(linked.select("k", "label").join(least, "label"), "k", "left")
    of_class = materialize(of_class.select("k", F.coalesce("least", "doc_id").alias("component")))  # so that the next join can split a hot class
    named = every.select("doc_id", "text_key", "n_shingles", "k").join(of_class, "k", "left")
    out = named.withColumn("component_id", F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id")))
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "text_key")


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs(doc_id, text, ...) without all but one of each group of near-duplicates."""
    found = near_duplicates(docs, width, percent).groupBy("doc_id", "text_key").agg(F.max("kept").alias("kept"), F.count("*").alias("rows"))
    found = materialize(found.where("not kept or rows > 1"))
    few = found.count() <= BROADCAST_IDS

    def matching(rows: DataFrame, how: str) -> DataFrame:
        rows = F.broadcast(rows) if few else rows
        return docs.join(rows, docs["doc_id"].cast("long").eqNullSafe(rows["doc_id"]) & (F.xxhash64(docs["text"]) == rows["text_key"]), how)

    out = matching(found, "left_anti")
    repeated = found.where("kept")
    return out if repeated.isEmpty() else out.union(matching(repeated, "left_semi").dropDuplicates(["doc_id", "text"]))


def _class_sets(texts: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """The full shingle set of each class in nodes(k, doc_id), made anew of one of its texts."""
    n = nodes.count()
    wanted = nodes.select("doc_id").distinct()
    some = texts.join(F.broadcast(wanted) if n <= BROADCAST_IDS else wanted, "doc_id", "left_semi")
    whole = some.mapInArrow(lambda b: _sets(b, width), "k long, s binary")
    named = nodes.where("doc_id is not null").select("k")
    unnamed = nodes.where("doc_id is null").select("k")
    again = texts.where("doc_id is null").mapInArrow(lambda b: _sets(b, width), "k long, s binary").join(unnamed, "k", "left_semi")
    return whole.join(named, "k", "left_semi").union(again).dropDuplicates(["k"])


def _prefixes(dense: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """For each dense class the first shingles of its set, rarest first: shingle, k, label, n, place."""
    held = sets.join(dense, "k", "left_semi")
    shift = np.uint64(64 - SKETCH_BITS)

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(1 << SKETCH_BITS, np.int64)
        for batch in batches:
            flat = np.frombuffer(b"".join(batch.column("s").to_pylist()), np.uint64)
            count += np.bincount((flat >> shift).astype(np.int64), minlength=len(count))
        at = np.flatnonzero(count > 1)  # what a task met once need not be sent to tell rare from frequent
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(count[at])], ["cell", "n"])

    table = held.select("s").mapInArrow(tally, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()  # bounded by SKETCH_BITS
    counts = np.zeros(1 << SKETCH_BITS, np.int64)
    counts[table.column("cell").to_numpy()] = table.column("n").to_numpy()
    counts = dense.sparkSession.sparkContext.broadcast(counts)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                values = [np.frombuffer(s, np.uint64) for s in batch.column("s").to_pylist()]
                size = np.array([len(v) for v in values], np.int64)
                keep = size - -(-percent * size // 100) + 1
                some = [v[np.lexsort((v, counts.value[(v >> shift).astype(np.int64)]))[:m]] for v, m in zip(values, keep)]
                place = np.concatenate([np.zeros(0, np.int64), *map(np.arange, keep)])
                flat = np.concatenate([np.zeros(0, np.uint64), *some]).view(np.int64)
                k, label = (np.repeat(batch.column(c).to_numpy(), keep) for c in ("k", "label"))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (flat, k, label, np.repeat(size, keep), place)], ["shingle", "k", "label", "n", "place"])

    named = held.join(labels.withColumnRenamed("node", "k"), "k", "left").select("k", F.coalesce("label", "k").alias("label"), "s")
    return named.mapInArrow(first, "shingle long, k long, label long, n long, place long")


def _pairs_apart(shared: DataFrame, percent: int) -> DataFrame:
    """Pairs of classes of different components that share a first shingle, if their sizes and its places allow the similarity."""
    x, y = (shared.select("shingle", *(F.col(c).alias(c + side) for c in ("k", "label", "n", "place"))) for side in "xy")
    left = F.least(F.col("nx") - F.col("placex"), F.col("ny") - F.col("placey"))
    sizes = 100 * F.least("nx", "ny") >= percent * F.greatest("nx", "ny")
    places = (100 + percent) * left >= percent * (F.col("nx") + F.col("ny"))
    return x.join(y, "shingle").where((F.col("kx") < F.col("ky")) & (F.col("labelx") != F.col("labely")) & sizes & places).select(F.col("kx").alias("a"), F.col("ky").alias("b")).distinct()


def _across(dense: DataFrame, labels: DataFrame, apart: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between dense classes of different components of one neighbourhood (components joined by pairs in ``apart``)."""
    near = components(apart).select(F.col("node").alias("label"), F.col("label").alias("near"))
    known = dense.join(labels.withColumnRenamed("node", "k"), "k", "left").withColumn("label", F.coalesce("label", "k")).join(near, "label")
    largest = known.groupBy("near", "label").count().groupBy("near").agg(F.max_by("label", F.struct("count", "label")).alias("main"), F.count("*").alias("n"))
    size = (F.octet_length("s") / 8).cast("long")
    inside = known.join(largest.where("n > 1"), "near").drop("n").join(sets, "k")
    # Sizes of a similar pair differ by 100 / percent at most, so they lie in one band or in two adjoining ones.
    inside = materialize(inside.withColumn("band", F.floor(F.log(size.cast("double")) / F.log(F.lit(100 / percent)) + 1e-9)))
    parts = inside.groupBy("near", "band").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
    columns = ["near", "band", "part", "fringe", "k", "label", "s"]
    members = inside.join(parts, ["near", "band"]).withColumn("part", F.pmod(F.xxhash64("k"), "parts").cast("int")).withColumn("fringe", F.lit(False)).select(*columns)
    fringe = inside.where("label <> main").withColumn("band", F.explode(F.sequence(F.col("band") - 1, F.col("band") + 1))).join(parts, ["near", "band"])
    fringe = fringe.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).withColumn("fringe", F.lit(True)).select(*columns)

    def compare(block):
        side = block.column("fringe")
        out = _links_across(block.filter(side), block.filter(pc.invert(side)), percent)
        return pa.table([pa.array([a for a, _ in out], pa.int64()), pa.array([b for _, b in out], pa.int64())], ["a", "b"])

    dealt = members.union(fringe).repartition("near", "band", "part")  # or rows would stay where the join by band put them
    return dealt.groupBy("near", "band", "part").applyInArrow(compare, "a long, b long")


def _bitmaps(sets: list[np.ndarray], width: int) -> np.ndarray:
    """A bit for each cell (of ``width``) that an element of a set falls into, in words of 64."""
    held = np.zeros((len(sets), width), bool)
    for row, s in zip(held, sets):
        row[(s & np.uint64(width - 1)).astype(np.int64)] = True
    return np.packbits(held, axis=1).view(np.uint64)


def _links_across(fringe: pa.Table, members: pa.Table, percent: int) -> list[tuple[int, int]]:
    """Confirmed pairs of fringe and members, one at least for each two components that such a pair links.

    Two bitmaps differ in no more cells than the sets differ in elements, so what they rule out is not similar.
    """
    if not (fringe.num_rows and members.num_rows):
        return []
    joined: dict[int, int] = {}

    def root(x: int) -> int:
        while x in joined:
            x = joined[x]
        return x

    k, label = members.column("k").to_numpy(), members.column("label").to_numpy()
    values = [np.frombuffer(s, np.uint64) for s in members.column("s").to_pylist()]
    size = np.array([len(v) for v in values])
    width = 1 << int(np.clip(np.ceil(np.log2(4 * size.mean() + 1)), 10, 16))
    cells = _bitmaps(values, width)
    out = []
    for own, own_label, s in zip(fringe.column("k").to_pylist(), fringe.column("label").to_pylist(), fringe.column("s").to_pylist()):
        held = np.frombuffer(s, np.uint64)
        rows = np.flatnonzero((label != own_label) & (100 * np.minimum(size, len(held)) >= percent * np.maximum(size, len(held))))
        differ = np.bitwise_count(cells[rows] ^ _bitmaps([held], width)).sum(axis=1, dtype=np.int64)
        rows = rows[(100 + percent) * differ <= (100 - percent) * (size[rows] + len(held))]
        rows = rows[[root(int(x)) != root(own_label) for x in label[rows]]] if len(rows) else rows
        if not len(rows):
            continue
        flat = np.concatenate([values[r] for r in rows])
        at = np.minimum(np.searchsorted(held, flat), len(held) - 1)
        both = np.add.reduceat((held[at] == flat).astype(np.int64), np.concatenate([[0], np.cumsum(size[rows])[:-1]]))
        for r in rows[100 * both >= percent * (size[rows] + len(held) - both)]:
            a, b = root(own_label), root(int(label[r]))
            if a != b:
                joined[max(a, b)] = min(a, b)
                out.append((min(own, int(k[r])), max(own, int(k[r]))))
    return out


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"), width=4, percent=80).drop("text_key")


QUERIES = {"op3_near_dedup": op3_near_dedup}

ORACLE = {
    "op3_near_dedup": r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
  ELSE list_distinct(list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i : i + 3], ' '))) END AS shingles FROM w),
e AS (SELECT doc_id, unnest(shingles) AS shingle FROM s),
n AS (SELECT doc_id, len(shingles)::BIGINT AS n FROM s),
x AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM e a JOIN e b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM x JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * common >= 80 * (na.n + nb.n - common)),
g AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(doc_id, reached) AS (SELECT doc_id, doc_id FROM n UNION SELECT r.doc_id, g.b FROM r JOIN g ON g.a = r.reached)
SELECT doc_id, n AS n_shingles, min(reached) AS component_id, doc_id = min(reached) AS kept FROM r JOIN n USING (doc_id) GROUP BY doc_id, n"""
}
