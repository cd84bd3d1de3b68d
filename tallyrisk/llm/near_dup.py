"""Near duplicates: an LSH forest over MinHash signatures, links confirmed on full shingle sets.

1. Texts become sets of word shingles; equal sets (exact copies, whatever their
   number) become one node, named by a 128-bit hash of the set.
2. A node's signature is read as several orders ("trees") of eight values.  In
   each tree, nodes with a common prefix are neighbours.  The prefix starts at
   three values; a region with more nodes than one task may hold is split by
   the next value, and again, so every region gets its own depth.  A region
   still too large at full depth is dealt into parts, in each tree anew.
   Regions with the same members in several trees are looked at once.
3. Inside a region, nodes are linked by their estimated similarity (well under
   the threshold, so that no true link is lost to the estimate), searching from
   node to node among those not reached yet: n - 1 edges at most, never all pairs.
4. The components of these edges hold all candidates of each other.  Their
   texts meet once, and the same search on full shingle sets confirms the links
   exactly.  A component too large for one task is confirmed region by region
   instead.
5. The nodes of regions that were too large, whose links steps 2 to 4 may have
   missed, are joined exactly on their rarest shingles: each set by the prefix
   that its partners must share a shingle of, as far as no link connects the two
   yet.  These pairs are decided on their full sets, too.
6. The components of the confirmed links are the groups.

At similarity 0.8 a pair shares three values in one of 16 trees with a
probability above 0.99998; the pairs of one region are then all decided on
their full sets.

Scale.  Only distinct sets that share a prefix with another set leave step 2.
Shuffles are keyed by hashes of sets, prefixes and components; nothing is
keyed by a value that a third of the rows can share without map-side
combining or skew splitting before.  No step collects to the driver.

Defined cases: null texts and texts without words have an empty set, are
linked with nothing and kept; fewer words than a shingle make one shingle;
equal rows are copies; rows without an id take their group's least id, and are
their own group only if no row in it has one; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .common import Words, flat_array, groups, mix64, ship_package, slices, stored, window_hashes
from .components import connected_components
from .linking import small, spanning_links, units

TREES = 16
DEPTH = 8
LEAST_DEPTH = 3
#: Nodes of one region of the forest, and shingles of one component of candidates, that one task compares.
REGION = 1024
COMPONENT = 10_000_000
HUBS = 16
_RNG = np.random.default_rng(20_11)
MULTIPLIERS = _RNG.integers(0, 1 << 63, TREES * DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every text, sorted within it, and the texts' bounds."""
    words = Words(texts)
    hashes = words.hashes()[words.codes]
    windows, owner = window_hashes(hashes, words.bounds, size)
    lengths = np.diff(words.bounds)
    short = np.flatnonzero((lengths > 0) & (lengths < size))
    if len(short):  # the whole sequence is one shingle
        whole = np.full(len(short), np.uint64(0x5151), np.uint64)
        for k in range(size - 1):
            on = lengths[short] > k
            whole[on] = mix64(whole[on] * np.uint64(0x9E3779B97F4A7C15) + hashes[words.bounds[short[on]] + k])
        windows, owner = np.concatenate([windows, whole]), np.concatenate([owner, short])
    order = np.lexsort((windows, owner))
    windows, owner = windows[order], owner[order]
    first = np.ones(len(windows), bool)
    first[1:] = (windows[1:] != windows[:-1]) | (owner[1:] != owner[:-1])
    windows, owner = windows[first], owner[first]
    return windows, np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(words)))]).astype(np.int64)


def set_keys(sets: np.ndarray, bounds: np.ndarray) -> list[bytes | None]:
    """A 128-bit hash of every set; None for empty ones."""
    cuts = np.minimum(bounds[:-1], max(len(sets) - 1, 0))
    if not len(sets):
        return [None] * (len(bounds) - 1)
    a = np.add.reduceat(mix64(sets + np.uint64(0x1234567)), cuts)
    b = np.add.reduceat(mix64(sets ^ np.uint64(0x9E3779B97F4A7C15)), cuts)
    sizes = np.diff(bounds)
    key = np.stack([mix64(a + sizes.astype(np.uint64)), mix64(b ^ mix64(a))], axis=1).astype(">u8")
    return [key[i].tobytes() if n else None for i, n in enumerate(sizes)]


def signatures(sets: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One row of TREES * DEPTH minima (their upper 32 bits) for every set."""
    sizes = np.diff(bounds)
    full = np.flatnonzero(sizes)
    out = np.zeros((len(sizes), len(MULTIPLIERS)), np.uint32)
    if len(full):
        starts = bounds[:-1][full]
        for k, m in enumerate(MULTIPLIERS):
            out[full, k] = np.minimum.reduceat(sets * m, starts) >> np.uint64(32)
    return out


def _sign(batches: Iterator[pa.RecordBatch], size: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 1000):
        sets, bounds = shingle_sets(batch.column(1), size)
        keys = set_keys(sets, bounds)
        values = signatures(sets, bounds)
        sketches = [row.tobytes() for row in values.astype(np.uint8)]
        values = values.view(np.int32).reshape(-1)
        lists = pa.ListArray.from_arrays(np.arange(0, len(values) + 1, len(MULTIPLIERS), dtype=np.int32), values)
        yield pa.RecordBatch.from_arrays([
            batch.column(0), batch.column(2), pa.array(np.diff(bounds)), pa.array(keys, pa.binary()),
            pa.array(sketches, pa.binary()), lists.cast(schema.field(5).type)], schema=schema)


def _estimated(batches: Iterator[pa.RecordBatch], least: float, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Spanning links of each region (rows: region, node, sketch) by the share of equal signature bytes."""
    width = len(MULTIPLIERS)
    # Unequal values agree in a byte by chance.
    enough = int(np.ceil((least + (1 - least) / 256) * width))
    for table, cuts in groups(batches, "region"):
        sketches = np.frombuffer(b"".join(flat_array(table["sketch"]).to_pylist()), np.uint8).reshape(-1, width)
        nodes = flat_array(table["node"])
        sizes = np.diff(cuts)
        pairs = cuts[:-1][sizes == 2]
        near = pairs[(sketches[pairs] == sketches[pairs + 1]).sum(axis=1) >= enough]
        a, b = [near], [near + 1]
        for start, n in zip(cuts[:-1][sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
            own = sketches[start:start + n]
            edges = spanning_links(n, lambda i, others, own=own: (own[others] == own[i]).sum(axis=1) >= enough)
            a.append(np.array([e[0] for e in edges], np.int64) + start)
            b.append(np.array([e[1] for e in edges], np.int64) + start)
        a, b = np.concatenate(a), np.concatenate(b)
        yield pa.RecordBatch.from_arrays([nodes.take(pa.array(a)), nodes.take(pa.array(b))], schema=schema)


def _confirmed(batches: Iterator[pa.RecordBatch], size: int, similarity: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Spanning links of each unit (rows: unit, node, text): 100 * intersection >= similarity * union."""
    for table, cuts in groups(batches, "unit", 500):
        a, b = [], []
        nodes = flat_array(table["node"])
        for start, stop in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            part = table.slice(start, stop - start)
            texts = flat_array(part["text"])
            sets, bounds = shingle_sets(texts, size)
            # Rows that share the id and the text's hash come more than once, or (by a collision) for another set.
            keys, named = set_keys(sets, bounds), part["node"].to_pylist()
            own = [k for k, key in enumerate(keys) if key == named[k] and (not k or named[k - 1] != key)]
            if len(own) < len(keys):
                sets, bounds = shingle_sets(texts.take(pa.array(own, pa.int64())), size)
            rows = start + np.array(own, np.int64)
            sizes = np.diff(bounds)

            def linked(i: int, others: np.ndarray) -> np.ndarray:
                own = sets[bounds[i]:bounds[i + 1]]
                number = sizes[others]
                fits = (100 * np.minimum(number, len(own)) >= similarity * np.maximum(number, len(own))) & (number > 0)
                yes = np.zeros(len(others), bool)
                some = np.flatnonzero(fits)
                if not len(some) or not len(own):
                    return yes
                number = number[some]
                first = np.concatenate([[0], np.cumsum(number)[:-1]])
                at = np.repeat(bounds[others[some]] - first, number) + np.arange(number.sum())
                values = sets[at]
                place = np.minimum(np.searchsorted(own, values), len(own) - 1)
                shared = np.add.reduceat((own[place] == values).astype(np.int64), first)
                yes[some] = 100 * shared >= similarity * (number + len(own) - shared)
                return yes

            edges = spanning_links(len(rows), linked)
            a += [rows[e[0]] for e in edges]
            b += [rows[e[1]] for e in edges]
        yield pa.RecordBatch.from_arrays(
            [nodes.take(pa.array(a, pa.int64())), nodes.take(pa.array(b, pa.int64()))], schema=schema)


def _regions(nodes: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(region, node) for the regions of the forest that have two to REGION nodes, and (node) for the larger ones, if any."""
    def keyed(rows: DataFrame, depth: int) -> DataFrame:
        return rows.withColumn("region", F.xxhash64("tree", F.slice("signature", F.col("tree") * DEPTH + 1, depth)))

    rows = nodes.select("node", "signature", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"))
    lean = keyed(rows, LEAST_DEPTH).select("region", "node", "tree")
    sizes = stored(lean.groupBy("region").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("node")).alias("members"))
                   .filter(F.col("n") > 1), "regions")
    found, crowded = [], None
    for depth in range(LEAST_DEPTH + 1, DEPTH + 2):
        fine = sizes.filter(F.col("n") <= REGION)
        # Equal members in several trees: one of them is enough.
        once = fine.groupBy("n", "members").agg(F.min("region").alias("region"))
        found.append(lean.join(small(stored(once.select("region"), "once")), "region").select("region", "node"))
        large = sizes.filter(F.col("n") > REGION)
        if large.isEmpty():
            break
        crowd = stored(lean.join(large.select("region", "n"), "region").select("region", "node", "tree", "n"), "crowds")
        parts = F.ceil(F.col("n") / REGION)
        part = F.xxhash64("region", F.pmod(F.xxhash64("node", "tree"), parts))
        if depth == LEAST_DEPTH + 1:
            crowded = stored(crowd.select("node").distinct(), "crowded")
            hubs = _hubs(crowd.withColumn("part", part), nodes).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
            found.append(hubs.select(F.xxhash64("region", "part").alias("region"), "node").unionByName(
                crowd.select(part.alias("region"), "node")).distinct())
        if depth > DEPTH:
            found.append(crowd.select(part.alias("region"), "node"))
            break
        lean = stored(keyed(crowd.select("node", "tree").join(nodes.select("node", "signature"), "node"), depth)
                      .select("region", "node", "tree"), "deeper")
        sizes = stored(lean.groupBy("region").agg(
            F.count("*").alias("n"), F.bit_xor(F.xxhash64("node")).alias("members"))
            .filter(F.col("n") > 1), "regions")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out, crowded


def _sets(batches: Iterator[pa.RecordBatch], size: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The shingles of every node (rows: node, root, text) as a list."""
    for batch in slices(batches, 500):
        sets, bounds = shingle_sets(batch.column(2), size)
        # Not those that share the id and the text's hash by a collision.
        own = [k for k, (key, node) in enumerate(zip(set_keys(sets, bounds), batch.column(0).to_pylist(), strict=True)) if key == node]
        lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(sets.view(np.int64)))
        out = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists.cast(schema.field(2).type)], schema=schema)
        yield out.take(pa.array(own, pa.int64()))


def _prefix_links(rows: DataFrame, nodes: DataFrame, crowded: DataFrame, links: DataFrame, size: int,
                  similarity: int) -> DataFrame | None:
    """Links (a, b) between nodes of ``crowded`` that ``links`` do not connect, all of them; None if there can be none.

    In the order of their shingles from the rarest on, the first one that two
    sets share stands so early in both that enough of either follows it for
    the overlap they need.  Shingles of one component only take up places.
    """
    heads = nodes.join(crowded, "node").select("node", F.col("row.doc_id").alias("id_r"), F.col("row.text_hash").alias("hash_r"))
    heads = heads.join(connected_components(links), "node", "left").withColumn("root", F.coalesce("root", "node"))
    texts = rows.join(small(stored(heads, "crowded-heads")),
                      F.col("doc_id").eqNullSafe(F.col("id_r")) & (F.col("text_hash") == F.col("hash_r")))
    schema = StructType.fromDDL("node binary, root binary, shingles array<long>")
    arrow = to_arrow_schema(schema)
    sets = stored(texts.select("node", "root", "text").mapInArrow(lambda it: _sets(it, size, arrow), schema)
                  .dropDuplicates(["node"]), "crowded-sets")
    items = sets.select("node", "root", F.size("shingles").alias("n"), F.explode("shingles").alias("s"))
    counts = stored(items.groupBy("s").agg(F.count("*").alias("c"), F.min("root").alias("low"), F.max("root").alias("high"))
                    .filter(F.col("c") > 1).select("s", "c", (F.col("low") != F.col("high")).alias("across")), "shingle-counts")
    if counts.filter("across").isEmpty():
        return None
    ranked = items.join(counts, "s").groupBy("node", "root", "n").agg(
        F.sort_array(F.collect_list(F.struct("c", "s", "across"))).alias("l"))
    ranked = ranked.select("node", "root", "n", F.size("l").alias("common"), F.posexplode("l").alias("place", "e"))
    # ``rest``: shingles from this one on; those of one set alone come first.
    prefix = ranked.select("node", "root", "n", F.col("e.s").alias("s"), (F.col("common") - F.col("place")).alias("rest"),
                           F.col("e.across").alias("across"))
    prefix = stored(prefix.filter(F.col("across") & (100 * F.col("rest") >= similarity * F.col("n"))).drop("across"), "prefixes")
    one = prefix.select("s", F.col("node").alias("a"), F.col("root").alias("a_root"), F.col("n").alias("a_n"), F.col("rest").alias("a_rest"))
    two = prefix.select("s", F.col("node").alias("b"), F.col("root").alias("b_root"), F.col("n").alias("b_n"), F.col("rest").alias("b_rest"))
    met = one.join(two, (one["s"] == two["s"]) & (F.col("a") < F.col("b")) & (F.col("a_root") != F.col("b_root")) & (
        (100 + similarity) * F.least("a_rest", "b_rest") >= similarity * (F.col("a_n") + F.col("b_n"))))
    pairs = stored(met.select("a", "b").distinct(), "prefix-pairs")
    full = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a")
    full = full.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b")
    shared = F.size(F.array_intersect("x", "y"))
    return stored(full.filter(100 * shared >= similarity * (F.size("x") + F.size("y") - shared)).select("a", "b"), "prefix-links")


def _closest(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Of each part (rows: part, region, n, node, sketch) the HUBS nodes that agree most with its usual bytes."""
    width = len(MULTIPLIERS)
    places = np.arange(width) * 256
    for table, cuts in groups(batches, "part"):
        sketches = np.frombuffer(b"".join(flat_array(table["sketch"]).to_pylist()), np.uint8).reshape(-1, width)
        rows, like = [], []
        for start, stop in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            own = sketches[start:stop]
            usual = np.bincount((own + places).ravel(), minlength=256 * width).reshape(width, 256).argmax(axis=1)
            agree = (own == usual).sum(axis=1)
            best = np.argsort(-agree, kind="stable")[:HUBS]
            rows.append(start + best)
            like.append(agree[best])
        at = pa.array(np.concatenate(rows))
        yield pa.RecordBatch.from_arrays([
            flat_array(table["region"]).take(at), flat_array(table["n"]).take(at), flat_array(table["node"]).take(at),
            pa.array(np.concatenate(like).astype(np.int64))], schema=schema)


def _hubs(crowd: DataFrame, nodes: DataFrame) -> DataFrame:
    """(region, n, node): up to HUBS nodes of each region (rows: part, region, n, node) that stand closest to the others.

    Every part names its closest ones; of these the best in each of HUBS slots
    stay, so neither step looks at more than a part or a slot's maximum.
    """
    schema = StructType.fromDDL("region long, n long, node binary, like long")
    arrow = to_arrow_schema(schema)
    width = int(crowd.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = crowd.join(nodes.select("node", "sketch"), "node").select("part", "region", "n", "node", "sketch")
    named = rows.repartition(width, "part").sortWithinPartitions("part").mapInArrow(lambda it: _closest(it, arrow), schema)
    best = named.groupBy("region", "n", F.pmod(F.xxhash64("node"), F.lit(HUBS)).alias("slot")).agg(
        F.max_by("node", "like").alias("node"))
    return best.select("region", "n", "node")


def near_duplicates(docs: DataFrame, shingle: int = 5, similarity: int = 80,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``text_hash``, ``n_shingles``, ``component_id`` and ``kept`` of every row.

    Documents are linked from ``similarity`` per cent Jaccard on; a component
    is named by its least id, and that row is kept.
    """
    spark = ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.withColumn("text_hash", F.xxhash64("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = StructType.fromDDL(
        f"doc_id {kind}, text_hash long, n_shingles long, node binary, sketch binary, signature array<int>")
    arrow = to_arrow_schema(schema)
    signed = stored(rows.mapInArrow(lambda it: _sign(it, shingle, arrow), schema), "signed")

    # One node a distinct set, with one row of it whose text stands for all.
    nodes = stored(signed.filter(F.col("node").isNotNull()).groupBy("node").agg(
        F.min("doc_id").alias("least_id"), F.min(F.struct("doc_id", "text_hash")).alias("row"),
        F.first("n_shingles").alias("weight"),
        F.first("sketch").alias("sketch"), F.first("signature").alias("signature")), "nodes")
    regions, crowded = _regions(nodes)
    regions = stored(regions, "forest")
    sketch = nodes.select("node", "sketch")
    pair = StructType.fromDDL("a binary, b binary")
    pair_arrow = to_arrow_schema(pair)
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    near = regions.join(sketch, "node").repartition(width, "region").sortWithinPartitions("region")
    near = stored(near.select("region", "node", "sketch").mapInArrow(
        lambda it: _estimated(it, similarity / 100 - 0.2, pair_arrow), pair), "near")
    candidates = stored(connected_components(near), "candidates")

    weighed = stored(nodes.select("node", "weight").join(small(candidates), "node"), "weighed")
    ids = nodes.select("node", "row").join(small(stored(units(weighed, regions, COMPONENT), "units")), "node").select(
        "unit", "node", F.col("row.doc_id").alias("id_r"), F.col("row.text_hash").alias("hash_r"))
    texts = rows.join(small(stored(ids, "wanted")),
                      F.col("doc_id").eqNullSafe(F.col("id_r")) & (F.col("text_hash") == F.col("hash_r")))
    texts = texts.select("unit", "node", "text").repartition(width, "unit").sortWithinPartitions("unit", "node")
    links = stored(texts.mapInArrow(
        lambda it: _confirmed(it, shingle, similarity, pair_arrow), pair), "links")
    if crowded is not None and (more := _prefix_links(rows, nodes, crowded, links, shingle, similarity)) is not None:
        links = links.unionByName(more)
    roots = connected_components(links)

    named = nodes.select("node", "least_id").join(small(roots), "node", "left").withColumn("root", F.coalesce("root", "node"))
    names = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = stored(named.join(names, "root").select(F.col("node").alias("node_r"), "component_id"), "components")
    out = signed.select("doc_id", "text_hash", "n_shingles", "node").join(named, F.col("node") == F.col("node_r"), "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "text_hash", "n_shingles", component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"))


def drop_near_duplicates(docs: DataFrame, shingle: int = 5, similarity: int = 80,
                         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that are kept: one of each component.

    Of rows equal in id and text one is kept, rows without a word excepted.
    """
    found = stored(near_duplicates(docs, shingle, similarity, id_col, text_col), "near-duplicates")
    mine = [F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash_r")]
    gone = found.filter(~F.col("kept")).select(*mine).distinct()
    rows = docs.withColumn("__hash", F.xxhash64(F.col(text_col).cast("string")))
    same = F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__hash") == F.col("__hash_r"))
    out = rows.join(small(stored(gone, "gone")), same, "left_anti")
    twice = found.filter(F.col("kept") & (F.col("n_shingles") > 0)).groupBy("doc_id", "text_hash").count()
    twice = stored(twice.filter(F.col("count") > 1).select(*mine), "twice")
    if not twice.isEmpty():
        single = out.join(small(twice), same, "left_anti")
        out = single.unionByName(out.join(small(twice), same, "left_semi").dropDuplicates([id_col, "__hash"]))
    return out.select(*docs.columns)
