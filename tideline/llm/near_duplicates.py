"""Near duplicates (operator 8): an LSH forest over MinHash signatures, links confirmed on whole shingle sets.

Each of `TREES` orders sorts documents by their signature from another value on. Documents that share
the first `DEPTH` values of an order are a region, and within it they are sorted by the values that follow, so the denser a
region, the deeper the prefix that neighbours share. First, in a few orders, each document meets
its neighbour by longest common prefix. Regions that hold one component afterwards are done. In all others, in all
orders, neighbours of different components meet, which leaves few components. What a deeper prefix may have parted is found
by an exact pass over the regions that are still open: documents of different components meet in the first order they share,
in shares of bounded size, if their larger sketches allow a link.

A pair of similarity 0.75 shares a region of an order with chance 0.75 ** 4, so it meets in none
of the 32 orders with chance 5e-6; its sketches are too far apart with chance 4e-6.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tideline.llm.graph import components
from tideline.llm.words import SPACE, WordTable, lower_ascii, narrow_batches, split_words, text_batches

SHINGLE = 5
TREES = 32
DEPTH = 4
NEIGHBOUR_TREES = 6
VALUES = TREES * DEPTH
LEAST_PERCENT = 75  # similarity of linked documents, in percent
SKETCH = 1024  # values of which a sketch keeps four bits each
_LONGS = SKETCH // 16
# Differing values of the sketches of a pair that is compared, at most: 4.5 deviations above the 240 of a pair at 0.75.
FURTHEST = 301
REGION_ROWS = 4_096  # rows of a region that one task orders, about
SHARE_ROWS = 512  # rows of a region that meet as many others at once, about

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_BASE = np.uint64(0x00000100000001B3)


def _parameters(values: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(seed)
    return random.integers(0, 2**63, values, dtype=np.uint64) * np.uint64(2) + np.uint64(1), random.integers(0, 2**63, values, dtype=np.uint64)


_FOREST = _parameters(VALUES, 20)
_SKETCHES = _parameters(SKETCH, 21)


@lru_cache(maxsize=1)
def _words() -> WordTable:
    return WordTable("near duplicates", lambda words: [[xxhash.xxh3_64_intdigest(w)] for w in words], np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    x = (x ^ (x >> np.uint64(29))) * _ODD
    return x ^ (x >> np.uint64(32))


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's shingles; fewer words than a shingle make one."""
    words = [split_words(lower_ascii(t)) if t else [] for t in texts]
    table = _words()
    hashes, _ = table.gather(table.rows([w for one in words for w in one]))
    out, at = [], 0
    for one in words:
        h = hashes[at : at + len(one)]
        at += len(one)
        size = min(SHINGLE, len(one))
        if not size:
            out.append(h)
            continue
        n = len(h) - size + 1
        joined = np.full(n, size, np.uint64)
        for k in range(size):
            joined = joined * _BASE + _mixed(h[k : k + n])
        out.append(np.unique(_mixed(joined)))
    return out


def _signatures(sets: list[np.ndarray], parameters: tuple[np.ndarray, np.ndarray] = _FOREST) -> np.ndarray:
    """Smallest hashes (32 bits) of each set under each pair of parameters; sets are not empty."""
    factor, shift = parameters
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    starts = np.cumsum(sizes) - sizes
    items = np.concatenate(sets)
    out = np.empty((len(sets), len(factor)), np.uint64)
    first = 0
    while first < len(sets):  # blocks that stay in the cache
        last = first + 1
        while last < len(sets) and starts[last] + sizes[last] - starts[first] < 40_000:
            last += 1
        block = items[starts[first] : starts[last - 1] + sizes[last - 1]]
        cuts = starts[first:last] - starts[first]
        for k in range(len(factor)):
            out[first:last, k] = np.minimum.reduceat(block * factor[k] + shift[k], cuts) >> np.uint64(32)
        first = last
    return out


def _profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, text_hash, n_shingles, set_hi and set_lo (of the whole set), regions, deeper."""
    names = ["doc_id", "text_hash", "n_shingles", "set_hi", "set_lo", "regions", "deeper"]
    for batch, texts in text_batches(batches):
        sets = shingle_sets(texts)
        some = np.array([k for k, s in enumerate(sets) if len(s)], np.int64)
        numbers = np.zeros((len(sets), 2), np.uint64)
        regions = np.zeros((len(some), TREES), np.uint64)
        deeper = np.zeros((len(some), TREES), np.uint64)
        if len(some):
            values = _signatures([sets[k] for k in some])
            for k in some:
                numbers[k, 0] = np.add.reduce(_mixed(sets[k] + _ODD))
                numbers[k, 1] = np.add.reduce(_mixed(sets[k] ^ _MIX))
            parts = values.reshape(len(some), TREES, DEPTH)
            regions += np.arange(TREES, dtype=np.uint64)
            for k in range(DEPTH):
                regions = _mixed(regions * _BASE + parts[:, :, k])
            after = np.roll(parts, -1, axis=1)
            for k in range(DEPTH):  # the next values of the order, 16 bits of each
                deeper = (deeper << np.uint64(16)) | (_mixed(after[:, :, k]) >> np.uint64(48))
        empty = np.ones(len(sets), np.int64)
        empty[some] = 0

        def lists(rows: np.ndarray, width: int, empty=empty) -> pa.Array:
            offsets = np.concatenate([[0], np.cumsum((1 - empty) * width)]).astype(np.int32)
            return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.reshape(-1).view(np.int64)))

        sizes = pa.array(np.fromiter(map(len, sets), np.int64, len(sets)))
        hi, lo = (pa.array(np.ascontiguousarray(numbers[:, k]).view(np.int64)) for k in range(2))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), sizes, hi, lo, lists(regions, TREES), lists(deeper, TREES)], names=names)


def _pack(values: np.ndarray) -> bytes:
    """48 bits of each hash, sorted."""
    cut = np.sort(values >> np.uint64(16)).astype("<u8")
    return cut.view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpack(packed: bytes) -> np.ndarray:
    six = np.frombuffer(packed, np.uint8).reshape(-1, 6)
    eight = np.zeros((len(six), 8), np.uint8)
    eight[:, :6] = six
    return eight.view("<u8").reshape(-1)


_SKETCH_COLUMNS = [f"s{k}" for k in range(_LONGS)]
_SETS = "node long, packed binary, " + ", ".join(f"{c} long" for c in _SKETCH_COLUMNS)


def _set_batch(nodes: pa.Array, sets: list[np.ndarray]) -> pa.RecordBatch:
    """Nodes with their packed sets and sketches: four bits of each of SKETCH smallest hashes."""
    if sets:
        nibbles = (_signatures(sets, _SKETCHES) & np.uint64(15)).reshape(len(sets), _LONGS, 16) << (np.arange(16, dtype=np.uint64) * np.uint64(4))
        sketches = np.bitwise_or.reduce(nibbles, axis=2).view(np.int64)
    else:
        sketches = np.zeros((0, _LONGS), np.int64)
    columns = [pa.array(np.ascontiguousarray(sketches[:, k])) for k in range(_LONGS)]
    return pa.RecordBatch.from_arrays([nodes, pa.array([_pack(s) for s in sets], pa.binary()), *columns], names=["node", "packed", *_SKETCH_COLUMNS])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in text_batches(batches):
        sets = shingle_sets(texts)
        some = [k for k, s in enumerate(sets) if len(s)]
        yield _set_batch(batch.column(0).take(pa.array(some, pa.int64())), [sets[k] for k in some])


def _common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose sets are similar enough."""
    for batch in batches:
        linked = []
        for left, right in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            both = len(np.intersect1d(_unpack(left), _unpack(right), assume_unique=True))
            linked.append(100 * both >= LEAST_PERCENT * (len(left) // 6 + len(right) // 6 - both))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(linked, pa.bool_()))


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) whose whole sets are similar enough; the set of b travels to a's."""
    right = sets.select(F.col("node").alias("b"), F.col("packed").alias("right"))
    left = sets.select(F.col("node").alias("a"), F.col("packed").alias("left"))
    n, m = F.octet_length("left"), F.octet_length("right")
    both = pairs.select("a", "b").join(right, "b").join(left, "a").where((100 * n >= LEAST_PERCENT * m) & (100 * m >= LEAST_PERCENT * n))
    return both.select("a", "b", "left", "right").mapInArrow(_common, "a long, b long")


def near_duplicates(docs: DataFrame, scratch: str) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, _group and text_hash for every row of `docs` (doc_id, text).

    Rows with equal sets are one node, numbered like the first of them by doc_id; every long is a doc_id, and
    equal ids link nothing. The links between nodes are
    confirmed on whole sets. Texts without a word have no shingles and are linked with nothing.
    Rows without doc_id are linked like others; where a component has no id at all, component_id
    is null. Kept is doc_id = component_id (both null counts). `_group` numbers the components (null
    for texts without words). Intermediate tables lie below `scratch`, on shared storage.
    """
    spark = docs.sparkSession
    narrow_batches(spark)
    # Lets few nodes filter the scan of all texts before they are shuffled.
    spark.conf.set("spark.sql.optimizer.runtime.bloomFilter.enabled", "true")
    spark.conf.set("spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold", "0")

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{scratch}/{name}")
        return spark.read.parquet(f"{scratch}/{name}")

    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
    shape = "doc_id long, text_hash long, n_shingles long, set_hi long, set_lo long, regions array<long>, deeper array<long>"
    profiles = stored(given.mapInArrow(_profiles, shape).withColumn("row", F.monotonically_increasing_id()), "profiles")
    named = profiles.where("n_shingles > 0")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_hash", "row")).alias("first")
    least = named.groupBy("set_hi", "set_lo").agg(first)
    nodes = stored(least.select("set_hi", "set_lo", F.col("first.row").alias("node"), F.col("first.doc_id").alias("id"), F.col("first.text_hash").alias("hash")), "nodes")
    numbered = named.select(F.col("row").alias("node"), "regions", "deeper")
    kept = stored(numbered.join(nodes.select("node"), "node", "left_semi"), "representatives")

    placed = kept.select("node", F.posexplode(F.arrays_zip("regions", "deeper")).alias("tree", "_at")).select("node", "tree", F.col("_at.regions").alias("region"), F.col("_at.deeper").alias("next"))
    shared = placed.groupBy("region").agg(F.min("node").alias("first"), F.max("node").alias("last"), F.count("*").alias("rows")).where("first < last")
    regions = stored(shared.select("region", "rows"), "regions")
    met = stored(placed.join(regions, "region"), "members")

    active = stored(met.select("node").distinct(), "active")
    wanted = nodes.join(active, "node", "left_semi").select("node", "id", "hash")
    by_id = given.join(wanted.where("id is not null"), (F.col("doc_id") == F.col("id")) & (F.col("text_hash") == F.col("hash")))
    by_hash = given.where("doc_id is null").join(wanted.where("id is null"), F.col("text_hash") == F.col("hash"))
    chosen = by_id.select("node", "text").unionByName(by_hash.select("node", "text")).dropDuplicates(["node"])
    sets = stored(chosen.mapInArrow(_sets, _SETS), "sets")

    close = stored(_confirmed(_neighbours(met), sets), "close")
    part = _parts(None, close, f"{scratch}/parts-1")
    beside = stored(_confirmed(_beside(met, part), sets), "beside")
    part = _parts(part, beside, f"{scratch}/parts-2")
    links = stored(_confirmed(_across(met, kept, sets, part), sets), "links")
    part = _parts(part, links, f"{scratch}/parts-3")
    linked = stored(part.join(nodes.select("node", "id"), "node"), "linked")
    ids = linked.groupBy("component").agg(F.min("id").alias("component_id"))
    roots = nodes.join(linked.drop("id").join(ids, "component"), "node", "left")
    id_of = F.when(F.col("component").isNull(), F.col("id")).otherwise(F.col("component_id"))
    rooted = roots.select("set_hi", "set_lo", F.coalesce("component", "node").alias("_group"), id_of.alias("component_id"))

    full = profiles.select("doc_id", "text_hash", "n_shingles", "set_hi", "set_lo")
    some = full.where("n_shingles > 0").join(rooted, ["set_hi", "set_lo"])
    none = full.where("n_shingles = 0").withColumns({"_group": F.lit(None).cast("long"), "component_id": F.col("doc_id")})
    every = some.unionByName(none)
    return every.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "_group", "text_hash")


def one_of_each(docs: DataFrame, scratch: str) -> DataFrame:
    """Rows of `docs`, all columns: one of each component, and all texts without a word.

    The one with the smallest doc_id stays, of rows with the same id the one with the least hash of its text,
    of equal rows one.
    """
    found = near_duplicates(docs.select("doc_id", "text"), f"{scratch}/near")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_hash")).alias("first")
    chosen = found.where("_group is not null").groupBy("_group").agg(first).select("first.doc_id", "first.text_hash")
    chosen.write.parquet(f"{scratch}/chosen")
    chosen = docs.sparkSession.read.parquet(f"{scratch}/chosen").withColumnsRenamed({"doc_id": "_near_id", "text_hash": "_near_hash"})
    keyed = docs.withColumn("_near_text", F.xxhash64("text"))
    wordless = ~F.coalesce(F.col("text").rlike(f"[^{SPACE}]"), F.lit(False))
    worded = keyed.where(~wordless).join(chosen, F.col("doc_id").cast("long").eqNullSafe(F.col("_near_id")) & (F.col("_near_text") == F.col("_near_hash")), "left_semi")
    # Rows with the same id and text are ordered by a hash of their other columns, of whatever type.
    others = F.xxhash64(F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])))
    least = worded.groupBy("doc_id", "_near_text").agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in docs.columns]), others).alias("row")).select("row.*")
    return least.unionByName(docs.where(wordless))


def _neighbours(met: DataFrame) -> DataFrame:
    """Pairs that stand next to each other in one of the first orders, within a region.

    Regions of many rows are dealt to several tasks by a hash; the first rows of the shares meet the region's.
    """
    rows = met.where(F.col("tree") < NEIGHBOUR_TREES)
    shares = F.ceil(F.col("rows") / REGION_ROWS)
    dealt = rows.withColumn("share", F.pmod(F.xxhash64("node"), shares)).repartition("region", "share")
    order = Window.partitionBy("region", "share").orderBy("next", "node")
    beside = dealt.select("region", "share", "rows", "node", F.lead("node").over(order).alias("other"), F.row_number().over(order).alias("place"))
    pairs = beside.where("other is not null").select("node", "other")
    heads = beside.where((F.col("rows") > REGION_ROWS) & (F.col("place") == 1)).select("region", "node")
    first = heads.groupBy("region").agg(F.min("node").alias("other"))
    return _ordered(pairs.unionByName(heads.join(first, "region").select("node", "other")))


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.where("node <> other").select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()


def _parts(part: DataFrame | None, links: DataFrame, scratch: str) -> DataFrame:
    """(node, component) after `links` join the components of `part`; nodes without links are left out."""
    if part is None:
        return components(links, scratch)
    left, right = (part.withColumnsRenamed({"node": x, "component": f"c{x}"}) for x in "ab")
    between = links.join(left, "a", "left").join(right, "b", "left").select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    merged = components(between, scratch)
    outer = merged.select(F.col("node").alias("component"), F.col("component").alias("whole"))
    known = part.join(outer, "component", "left").select("node", F.coalesce("whole", "component").alias("component"))
    known.unionByName(merged.join(part.select("node"), "node", "left_anti")).write.parquet(f"{scratch}/all")
    return links.sparkSession.read.parquet(f"{scratch}/all")


def _open(met: DataFrame, part: DataFrame) -> DataFrame:
    """Members of the regions that hold more than one component, with their components."""
    rows = met.drop("rows").join(part, "node", "left").withColumn("component", F.coalesce("component", "node"))
    several = rows.groupBy("region").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("rows")).where("lo < hi")
    return rows.join(several.select("region", "rows"), "region")


def _beside(met: DataFrame, part: DataFrame) -> DataFrame:
    """Pairs of different components that stand next to each other, by longest common prefix, in a region of any order."""
    share = F.pmod(F.xxhash64("node"), F.ceil(F.col("rows") / REGION_ROWS))
    dealt = _open(met, part).withColumn("share", share).repartition("region", "share")
    order = Window.partitionBy("region", "share").orderBy("next", "node")
    beside = dealt.select("node", "component", F.lead("node").over(order).alias("other"), F.lead("component").over(order).alias("its"))
    return _ordered(beside.where("component <> its").select("node", "other"))


def _differing() -> Column:
    """Values in which the sketches of two rows differ."""
    total = F.lit(0)
    for c in _SKETCH_COLUMNS:
        x = F.col(f"{c}_a").bitwiseXOR(F.col(f"{c}_b"))
        any_bit = x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseOR(F.shiftrightunsigned(x, 2)).bitwiseOR(F.shiftrightunsigned(x, 3))
        total = total + F.bit_count(any_bit.bitwiseAND(F.lit(0x1111111111111111)))
    return total


def _across(met: DataFrame, kept: DataFrame, sets: DataFrame, part: DataFrame) -> DataFrame:
    """Pairs of different components that share a region, if their sketches and sizes allow a link.

    A pair meets in the first order whose region it shares. The rows of a region are dealt to shares, and every two shares meet
    by a key of their own, so no task holds a region.
    """
    facts = sets.select("node", (F.octet_length("packed") / 6).cast("long").alias("n"), *_SKETCH_COLUMNS)
    still = _open(met, part).select("node", "component", "region", "tree", F.ceil(F.col("rows") / SHARE_ROWS).alias("shares"))
    rows = still.join(facts, "node").join(kept.select("node", "regions"), "node").withColumn("share", F.pmod(F.xxhash64("node"), F.col("shares")))
    values = ("node", "n", "component", "regions", *_SKETCH_COLUMNS)
    left = rows.select("region", "tree", F.col("share").alias("i"), F.explode(F.sequence("share", F.col("shares") - 1)).alias("j"), *[F.col(c).alias(f"{c}_a") for c in values])
    right = rows.select("region", F.explode(F.sequence(F.lit(0).cast("long"), "share")).alias("i"), F.col("share").alias("j"), *[F.col(c).alias(f"{c}_b") for c in values])
    sizes = (100 * F.col("n_a") >= LEAST_PERCENT * F.col("n_b")) & (100 * F.col("n_b") >= LEAST_PERCENT * F.col("n_a"))
    once = (left["i"] < left["j"]) | (F.col("node_a") < F.col("node_b"))
    earlier = F.arrays_overlap(*[F.slice(f"regions_{s}", F.lit(1), F.col("tree")) for s in "ab"])
    same = (left["region"] == right["region"]) & (left["i"] == right["i"]) & (left["j"] == right["j"])
    met_ = left.join(right, same & once & (F.col("component_a") != F.col("component_b")) & sizes & (_differing() <= FURTHEST) & ~earlier)
    return _ordered(met_.select(F.col("node_a").alias("node"), F.col("node_b").alias("other")))
