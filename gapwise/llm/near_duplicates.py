"""Near-duplicate documents by circulant MinHash, confirmed on whole shingle sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapwise.llm.components import components
from gapwise.llm.shingles import shingle_set, words_of
from gapwise.llm.spans import U64, mix
from gapwise.llm.staging import staged

U32 = np.uint32
_FIRST, _SECOND = U32(0x9E3779B1), U32(0x85EBCA77)  # odd, so that multiplying permutes 32-bit integers
ODD_BITS = 2048
#: Shingles times coordinates that are worked on at once stay within a core's cache.
_AT_ONCE = 1024


def circulant_signatures(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """One row of MinHash coordinates per set (none of them empty).

    The first permutation places a shingle in a ring of 2^32 places. Coordinate k
    is the least value that the second permutation gives to the places of the set,
    all shifted by k around the ring.
    """
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *(len(s) for s in sets)])
    places = (mix(flat ^ U64(0xC2B2AE3D27D4EB4F)) >> U64(32)).astype(U32) * _FIRST
    shifts = np.arange(coordinates, dtype=U32)[:, None] * _FIRST
    out = np.full((len(sets), coordinates), 0xFFFFFFFF, U32)
    for at in range(0, len(flat), _AT_ONCE):
        values = places[at : at + _AT_ONCE] + shifts
        values ^= values >> U32(15)
        values *= _SECOND
        first, last = np.searchsorted(starts, [at, at + values.shape[1]], "right") - 1
        last += starts[last] < at + values.shape[1]
        own = np.maximum(starts[first:last] - at, 0)
        np.minimum(out[first:last], np.minimum.reduceat(values, own, axis=1).T, out=out[first:last])
    return out


def band_keys(signatures: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit key per band of a signature; keys of different bands never mean the same."""
    parts = signatures.reshape(len(signatures), bands, -1).astype(np.uint64)
    keys = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), parts.shape[:2])
    for row in range(parts.shape[2]):
        keys = mix(keys * U64(0x9FB21C651E98DF25) + parts[:, :, row])
    return keys.view(np.int64)


def set_id(shingles: np.ndarray) -> bytes:
    """128 bits that name a set."""
    a, b = mix(shingles ^ U64(0x9E3779B97F4A7C15)).sum(), mix(shingles + U64(0xD6E8FEB86659FD93)).sum()
    return np.array([a, b], np.uint64).tobytes()


def odd_sketch(shingles: np.ndarray) -> np.ndarray:
    """Bits that tell of each of `ODD_BITS` parts of the hash space whether its shingles are odd in number.

    Two sets differ in at least as many shingles as their sketches in bits.
    """
    places = (mix(shingles ^ U64(0x94D049BB133111EB)) & U64(ODD_BITS - 1)).astype(np.int64)
    odd = (np.bincount(places, minlength=ODD_BITS) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)


def _sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    return (shingle_set(words, width) for words in words_of(texts))


def sketches(docs: DataFrame, width: int, bands: int, rows: int) -> DataFrame:
    """doc_id, text_key, n_shingles, set_id and the band keys of each document; the last are null and none without words."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "text_key", "n_shingles", "set_id", "keys"]
        for got in batches:
            start, held, total = 0, [], 0

            def batch(stop: int) -> pa.RecordBatch:
                full = [s for s in held if len(s)]
                keys = band_keys(circulant_signatures(full, bands * rows), bands) if full else np.zeros((0, bands), np.int64)
                ends = np.cumsum([0, *(bands * bool(len(s)) for s in held)]).astype(np.int32)
                columns = [
                    *(got.column(c).slice(start, stop - start) for c in ("doc_id", "text_key")),
                    pa.array([len(s) for s in held], pa.int64()),
                    pa.array([set_id(s) if len(s) else None for s in held], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.ravel())),
                ]
                return pa.RecordBatch.from_arrays(columns, names=names)

            for i, own in enumerate(_sets(got.column("text"), width)):
                held.append(own)
                total += len(own)
                if total > 1 << 18:
                    yield batch(i + 1)
                    start, held, total = i + 1, [], 0
            if held:
                yield batch(got.num_rows)

    text = F.col("text").cast("string")
    rows_ = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), text_key(text).alias("text_key"))
    return rows_.mapInArrow(sketch, "doc_id long, text_key binary, n_shingles long, set_id binary, keys array<long>")


def text_key(text: Column) -> Column:
    """128 bits that name a text; a null one has a name too."""
    return F.unhex(F.md5(F.concat(F.when(text.isNull(), "-").otherwise("+"), F.coalesce(text, F.lit("")))))


def whole_sets(docs: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """set_id, odd sketch and shingles of each node (set_id, first_id), from the text of a document that has the set.

    The document is found by its id; for sets that only documents without one have,
    the sets of all such documents are made again.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for got in batches:
            ids, found, total = [], [], 0

            def batch() -> pa.RecordBatch:
                ends = pa.array(np.cumsum([0, *map(len, found)]).astype(np.int32))
                shingles = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(found).view(np.int64)))
                bits = pa.array([odd_sketch(own) for own in found], pa.list_(pa.int64()))
                return pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), bits, shingles], names=["set_id", "odd", "shingles"])

            for wanted, own in zip(got.column(0).to_pylist(), _sets(got.column(1), width)):
                name = set_id(own) if len(own) else None
                if name and wanted in (None, name):  # an id may stand for several texts
                    ids.append(name)
                    found.append(own)
                    total += len(own)
                    if total > 1 << 20:
                        yield batch()
                        ids, found, total = [], [], 0
            if ids:
                yield batch()

    texts = docs.select(F.col("doc_id").cast("long").alias("first_id"), F.col("text").cast("string").alias("text"))
    named = texts.join(nodes.select("set_id", "first_id"), "first_id").select("set_id", "text")
    unnamed = texts.where("first_id is null").select(F.lit(None).cast("binary").alias("set_id"), "text")
    by_name, others = (t.mapInArrow(find, "set_id binary, odd array<long>, shingles array<long>") for t in (named, unnamed))
    others = others.join(nodes.where("first_id is null").select("set_id"), "set_id", "left_semi")
    return by_name.union(others).dropDuplicates(["set_id"])


def near_duplicates(
    docs: DataFrame, width: int = 5, at_least: int = 80, of: int = 100, bands: int = 40, rows: int = 8
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, group_id, text_key for each row of `docs`.

    Two documents are linked if `of` times their shared shingles are at least
    `at_least` times all their shingles. Components of linked documents have the
    smallest doc_id among them as `component_id`, and that one is `kept`. Candidates
    share a band of `rows` out of `bands * rows` MinHash coordinates: of pairs at a
    similarity of 0.85, 40 bands of 8 miss 3 in a million, of 0.8, 6 in ten thousand.

    A null or blank text has no shingles and is linked with nothing. Rows that repeat
    a set of shingles are one node however many they are. Rows that share a doc_id but
    not a text stand where their texts stand. Other columns are not read. Null ids
    are no component's smallest unless there is no other; then component_id is null
    and all its rows are `kept`. `group_id` (null without shingles) tells such
    components apart, and `text_key` (see there) their texts. No rows give no rows.

    A bucket of candidates isn't expanded into pairs. Each node is compared with the
    most central node of its buckets, then, where that leaves a bucket with nodes of
    more than one component, with the central nodes of its other buckets, and last the
    nodes outside a bucket's main component with all its nodes of other components,
    of which those pairs go on whose odd sketches don't rule out a link.
    Pairs within a component need no comparison, so no link between components is lost.
    """
    sketch = staged(sketches(docs, width, bands, rows), "sketches")
    classes = staged(
        sketch.where("set_id is not null")
        .groupBy("set_id")
        .agg(F.min("doc_id").alias("first_id"), F.first("n_shingles").alias("n"), F.first("keys").alias("keys")),
        "classes",
    )
    placed = classes.select("set_id", "n", F.explode("keys").alias("key"))
    shared = placed.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    buckets = staged(placed.join(shared, "key"), "buckets")
    # a node that differs little from many stands in their largest buckets
    central = buckets.groupBy("set_id").agg(F.sum("size").alias("weight"))
    best = F.max(F.struct("weight", "set_id", "n"))
    members = staged(buckets.drop("size").join(central, "set_id"), "members")
    hubs = staged(members.groupBy("key").agg(best.alias("hub")).select("key", "hub.*"), "hubs")
    hubs = hubs.select("key", F.col("weight").alias("w"), F.col("set_id").alias("b"), F.col("n").alias("m"))
    fits = F.least("n", "m") * of >= F.greatest("n", "m") * at_least
    pairs = staged(members.join(hubs, "key").where(fits & (F.col("set_id") != F.col("b"))).groupBy("set_id", "b").agg(F.max("w").alias("w")), "pairs")
    nodes = central.join(classes, "set_id").select("set_id", "first_id")
    sets = staged(whole_sets(docs, nodes, width), "sets")

    def confirmed(candidates: DataFrame) -> DataFrame:
        """Those pairs (a, b) whose whole sets are similar enough."""
        ends = staged(candidates.select("a").union(candidates.select("b")).distinct(), "ends")
        own = sets.join(ends.withColumnRenamed("a", "set_id"), "set_id", "left_semi")
        with_a = candidates.join(own.select(F.col("set_id").alias("a"), F.col("shingles").alias("x")), "a")
        both = with_a.join(own.select(F.col("set_id").alias("b"), F.col("shingles").alias("y")), "b")
        common = F.size(F.array_intersect("x", "y")).cast("long")
        similar = of * common >= at_least * (F.size("x") + F.size("y") - common)
        return staged(both.where(similar).select("a", "b"), "links")

    first = pairs.groupBy("set_id").agg(F.max_by("b", F.struct("w", "b")).alias("b"))
    links = confirmed(first.select(F.col("set_id").alias("a"), "b"))
    labels = components(links)
    # the other central nodes
    rest = _across(pairs.select(F.col("set_id").alias("a"), "b"), labels).select("a", "b").distinct()
    rest = staged(rest, "rest")
    if not rest.isEmpty():
        links = links.union(confirmed(rest))
        labels = components(links)
    # what stands in a bucket outside its main component
    named = members.join(labels.withColumnRenamed("node", "set_id"), "set_id", "left").select(
        "key", "set_id", "n", F.coalesce("label", "set_id").alias("label")
    )
    named = staged(named, "named")
    per_label = named.groupBy("key", "label").agg(F.count("*").alias("size"))
    main = per_label.groupBy("key").agg(F.max_by("label", F.struct("size", "label")).alias("main"), F.count("*").alias("labels"))
    main = staged(main.where("labels > 1").select("key", "main"), "main")
    open_ = staged(named.join(main, "key").join(sets.select("set_id", "odd"), "set_id"), "open")
    outside = open_.where("label != main").select("key", F.col("set_id").alias("a"), "n", F.col("odd").alias("x"), F.col("label").alias("l"))
    inside = open_.select("key", F.col("set_id").alias("b"), F.col("n").alias("m"), F.col("odd").alias("y"), "label")
    bits = sum((F.bit_count(F.get("x", i).bitwiseXOR(F.get("y", i))) for i in range(1, ODD_BITS // 64)), F.bit_count(F.get("x", 0).bitwiseXOR(F.get("y", 0))))
    near = bits * (of + at_least) <= (F.col("n") + F.col("m")) * (of - at_least)
    ends = outside.join(inside, "key").where((F.col("l") != F.col("label")) & fits & near)
    last = staged(ends.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "last")
    if not last.isEmpty():
        links = links.union(confirmed(last))
        labels = components(links)

    linked = staged(classes.select("set_id", "first_id").join(labels.withColumnRenamed("node", "set_id"), "set_id"), "linked")
    least = staged(linked.groupBy("label").agg(F.min("first_id").alias("component_id")), "least")
    found = linked.join(least, "label").select("set_id", "component_id", "label")
    alone = classes.join(found, "set_id", "left").select(
        "set_id", F.coalesce("component_id", "first_id").alias("component_id"), F.coalesce("label", "set_id").alias("group_id")
    )
    component = F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return (
        sketch.select("doc_id", "text_key", "n_shingles", "set_id")
        .join(staged(alone, "components"), "set_id", "left")
        .select("doc_id", "n_shingles", component.alias("component_id"), "group_id", "text_key")
        .select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "group_id", "text_key")
    )


def _across(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs (a, b) whose ends have different labels; a node without one is its own."""
    for end in ("a", "b"):
        own = labels.select(F.col("node").alias(end), F.col("label").alias(f"label_{end}"))
        pairs = pairs.join(own, end, "left")
    differ = F.coalesce("label_a", "a") != F.coalesce("label_b", "b")
    return pairs.where(differ)
