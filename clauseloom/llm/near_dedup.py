"""Near-duplicate groups: MinHash signatures, a multi-index Hamming join, and a check on the full shingle sets.

**Signatures.** A document's distinct word shingles give ``CHUNKS`` x ``SYMBOLS`` minimum hashes of ``BITS`` bits, four to a number.
**Multi-index join.** Two signatures that differ in at most ``ALLOWED`` = 2 x CHUNKS - 1 symbols have a chunk with at most one
differing symbol (pigeonhole), so each chunk enters an index once for every symbol left out: the join on these keys
finds all pairs within ``ALLOWED``.  A pair of similarity 0.8 differs in 8 of 40 symbols on average, and in more than 19 with a
probability of about 2 in 100,000.
**Exact check.** Every pair found is confirmed on the full sets, of which only candidates' are built.

Documents with equal sets are one class from the start, found by grouping 128-bit set fingerprints, and copies are never
paired.  Inside an index entry not all pairs are formed either.  First every class meets the leader, chosen by a hash of its own, of its
largest entry; then, in entries that hold several components of confirmed links, those in another component than the leader meet
it.  Entries that still hold several components meet their hub, the member with
most links so far.  A member x that is not linked with its hub h can be linked with another member y only where both differ from h
alike, in a number of elements that follows from the sizes (``may_share_enough``).  So the members meet on what they differ in: each
enters the rarest of its elements, as many as suffice that a pair with the number to share has one in common, and a bitmap ends pairs
inside the join that cannot share enough.  Every pair that could still join two components is checked on its full sets; pairs
inside a component, which cannot change the result, are left out.

Null or empty texts, and those without words: no shingles, linked with nothing.  Texts shorter than a shingle: the whole
sequence is one.  Rows that repeat an id count as one document for links.  Extra columns are ignored; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clauseloom.session import written

from .registry import discard
from .words import by_bytes, distinct, hash_words, mix, shingles, text_bytes

CHUNKS, SYMBOLS, BITS = 10, 4, 15
ALLOWED = 2 * CHUNKS - 1
SIGNATURE = [f"s{i}" for i in range(CHUNKS)]
MAX_BROADCAST = 1_000_000  # ids of 8 bytes
DIFFERENCE = 1024  # bits of the map of what a set does not share with its leader's
DIFFERING = [f"d{i}" for i in range(DIFFERENCE // 64)]
_LANE = (1 << BITS) - 1
_MULTIPLY = mix(np.arange(1, CHUNKS * SYMBOLS + 1, dtype=np.uint64)) | np.uint64(1)
_ADD = mix(np.arange(1001, 1001 + CHUNKS * SYMBOLS, dtype=np.uint64))


def shingle_sets(column: pa.Array, size: int):
    return distinct(shingles(hash_words(*text_bytes(column), fold=True), size))


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, n_shingles, f1, f2 (fingerprint of the set) and the chunks of the signature."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in by_bytes(whole, "text"):
                sets = shingle_sets(batch.column("text"), size)
                counts, full = sets.counts, np.flatnonzero(sets.counts)
                starts = sets.bounds[:-1][full]
                chunks = np.zeros((CHUNKS, len(counts)), np.int64)
                prints = np.zeros((2, len(counts)), np.uint64)
                if len(full):
                    for k in range(CHUNKS * SYMBOLS):
                        least = np.minimum.reduceat(sets.hashes * _MULTIPLY[k] + _ADD[k], starts)
                        symbol = (mix(least) >> np.uint64(64 - BITS)).astype(np.int64)
                        chunks[k // SYMBOLS, full] |= symbol << (BITS * (k % SYMBOLS))
                    for k in range(2):
                        prints[k, full] = np.add.reduceat(mix(sets.hashes ^ _ADD[k]), starts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(counts, pa.int64()), *(pa.array(p.view(np.int64)) for p in prints), *map(pa.array, chunks)],
                    names=["doc_id", "n_shingles", "f1", "f2", *SIGNATURE])

    kind = "doc_id long, n_shingles long, f1 long, f2 long, " + ", ".join(f"{s} long" for s in SIGNATURE)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(sign, kind)


def full_sets(docs: DataFrame, size: int) -> DataFrame:
    """doc_id and the whole set of shingle hashes."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in by_bytes(whole, "text"):
                sets = shingle_sets(batch.column("text"), size)
                lists = pa.ListArray.from_arrays(pa.array(sets.bounds, pa.int32()), pa.array(sets.hashes.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], names=["doc_id", "shingles"])

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(build, "doc_id long, shingles array<long>")


def index_keys() -> Column:
    """The index entries of a signature: every chunk with each of its symbols left out."""
    keys = [F.xxhash64(F.lit(c * SYMBOLS + k), F.col(SIGNATURE[c]).bitwiseAND(F.lit(~(_LANE << (BITS * k)))))
            for c in range(CHUNKS) for k in range(SYMBOLS)]
    return F.explode(F.array(*keys))


def differing_symbols(a: str, b: str) -> Column:
    """In how many symbols the signatures of two aliases differ."""
    low = sum(((1 << (BITS - 1)) - 1) << (BITS * k) for k in range(SYMBOLS))
    high = sum(1 << (BITS * k + BITS - 1) for k in range(SYMBOLS))
    total = F.lit(0)
    for s in SIGNATURE:
        x = F.col(f"{a}.{s}").bitwiseXOR(F.col(f"{b}.{s}"))
        total = total + F.bit_count((x.bitwiseAND(F.lit(low)) + F.lit(low)).bitwiseOR(x).bitwiseAND(F.lit(high)))
    return total


def within_size(a: str, b: str, threshold: int) -> Column:
    """Whether the set sizes allow the similarity at all."""
    m, n = F.col(f"{a}.n_shingles"), F.col(f"{b}.n_shingles")
    return (100 * m >= threshold * n) & (100 * n >= threshold * m)


def compared(pairs: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """The pairs (a, b) with common, only_a, only_b (set sizes), what only one of them has (``apart``) and a bitmap of it."""
    ids = written(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "compared-ids")
    # spares moving all texts; beyond the bound they are shuffled
    wanted = F.broadcast(ids) if ids.count() <= MAX_BROADCAST else ids
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(wanted, "doc_id", "left_semi")
    sets = written(full_sets(texts, size), "shingle-sets")
    discard(ids)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = []
            for name in ("left", "right"):
                lists = batch.column(name)
                sides.append((lists.values.to_numpy().view(np.uint64), lists.offsets.to_numpy()))
            counts = np.zeros((3, len(batch)), np.int64)
            maps = np.zeros((len(batch), DIFFERENCE), bool)
            apart = []
            for i in range(len(batch)):
                x, y = (values[ends[i]:ends[i + 1]] for values, ends in sides)
                differ = np.setxor1d(x, y, assume_unique=True)
                common = (len(x) + len(y) - len(differ)) // 2
                counts[:, i] = common, len(x) - common, len(y) - common
                maps[i, differ & np.uint64(DIFFERENCE - 1)] = True
                apart.append(differ.view(np.int64))
            longs = np.packbits(maps, axis=1, bitorder="little").view("<i8")
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), *map(pa.array, counts), *map(pa.array, longs.T), pa.array(apart, pa.list_(pa.int64()))],
                names=["a", "b", "common", "only_a", "only_b", *DIFFERING, "apart"])

    kind = "a long, b long, common long, only_a long, only_b long, " + ", ".join(f"{d} long" for d in DIFFERING) + ", apart array<long>"
    joined = pairs.join(sets.toDF("a", "left"), "a").join(sets.toDF("b", "right"), "b")
    found = written(joined.select("a", "b", "left", "right").mapInArrow(compare, kind), "compared")
    discard(sets)
    return found


def linked(pairs: DataFrame, threshold: int) -> DataFrame:
    common, union = F.col("common"), F.col("common") + F.col("only_a") + F.col("only_b")
    return pairs.where(100 * common >= threshold * union).select("a", "b")


def may_share_enough(x: str, y: str, threshold: int) -> Column:
    """Whether two sets can be linked, by how both differ from the set of their leader; true where that is not known.

    Of h elements of the leader, x lacks m_x and adds p_x.  What x and y share is what they would share if they differed from it
    at different places, and what they differ alike in, d: a link needs (1 + t) d >= m_x + m_y + t (p_x + p_y) - (1 - t) h.  The
    bitmaps of the differences bound d from above: bits in common, and elements that fell on a taken bit.
    """
    of = lambda c: (F.col(f"{x}.{c}"), F.col(f"{y}.{c}"))
    alike = F.lit(0)
    for d in DIFFERING:
        u, v = of(d)
        alike = alike + F.bit_count(u.bitwiseAND(v))
    (hidden_x, hidden_y), (lacks_x, lacks_y), (adds_x, adds_y) = of("hidden"), of("lacks"), of("adds")
    needed = 100 * (lacks_x + lacks_y) + threshold * (adds_x + adds_y) - (100 - threshold) * F.col(f"{x}.leader_size")
    return F.coalesce((100 + threshold) * (alike + F.least(hidden_x, hidden_y)) >= needed, F.lit(True))


def components(edges: DataFrame) -> DataFrame:
    """node, component: the smallest node that each node of ``edges`` (a, b) reaches.

    Labels move along the edges and then to the label of the label, until none changes; each round is written, and replaces the last.
    """
    both = written(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = written(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("component")), "labels")
    total = F.sum(F.col("component").cast("decimal(38,0)"))
    before = labels.agg(total).first()[0]
    while before is not None:
        met = both.join(labels.select(F.col("node").alias("b"), "component"), "b").groupBy("a").agg(F.min("component").alias("met"))
        step = labels.join(met.withColumnRenamed("a", "node"), "node").select("node", F.least("component", "met").alias("via"))
        jump = labels.select(F.col("node").alias("via"), "component")
        last, labels = labels, written(step.join(jump, "via").select("node", F.least("via", "component").alias("component")), "labels")
        discard(last)
        now = labels.agg(total).first()[0]
        if now == before:
            break
        before = now
    discard(both)
    return labels


def _from_hubs(spokes: DataFrame, members: DataFrame, threshold: int) -> DataFrame:
    """Members (node, hub, ...) with leader_size, lacks, adds, hidden, the bitmap and apart, and an own number ``uid``.

    Members that are linked with their hub are in its component.  An id that stands for several texts gives a row for each.
    """
    ways = []
    for node, hub in ("ab", "ba"):
        lacks, adds = F.col(f"only_{hub}"), F.col(f"only_{node}")
        bits = sum((F.bit_count(d) for d in DIFFERING), F.lit(0))
        ways.append(spokes.select(F.col(node).alias("node"), F.col(hub).alias("hub"), (F.col("common") + lacks).alias("leader_size"),
                                  lacks.alias("lacks"), adds.alias("adds"), (lacks + adds - bits).alias("hidden"), *DIFFERING, "apart"))
    joined = members.join(ways[0].unionByName(ways[1]), ["node", "hub"])
    near_hub = 100 * (F.col("leader_size") - F.col("lacks")) >= threshold * (F.col("leader_size") + F.col("adds"))
    joined = joined.withColumn("component", F.when(near_hub, F.col("hub_component")).otherwise(F.col("component")))
    return written(joined.withColumn("uid", F.monotonically_increasing_id()), "members")


def _late_pairs(members: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) of members of a hub that could be linked across components; ``members`` is a written table.

    A member must share one of the rarest elements of its ``apart`` with another, so as to share as many as a link needs.  The order by
    frequency among all members of a hub, then by value, is the same for all.  What meets nothing goes before the bitmaps are
    joined to the elements: hubs with no member outside, elements of a single member, those of a single component.
    """
    # of a link, shared differences >= (m_x + t p_x + m_y + t p_y - (1 - t) h) / (1 + t); the hub is no link of x: m_x + t p_x > (1 - t) h
    weight, spare = 100 * F.col("lacks") + threshold * F.col("adds"), (100 - threshold) * F.col("leader_size")
    upwards = lambda number, by: F.floor((number + (by - 1)) / by)  # noqa: E731  a quotient of whole numbers, never rounded too high
    outside = F.col("component") != F.col("hub_component")
    open_ = members.join(members.where(outside).select("hub").distinct(), "hub", "left_semi")
    spread = open_.select("hub", "uid", F.explode("apart").alias("element"))
    often = spread.groupBy("hub", "element").agg(F.count("*").alias("n")).where("n > 1")
    shared = written(spread.join(often, ["hub", "element"]), "shared-elements")
    # counted from the commonest, the rarest that are needed are those from the number to share on; elements of one member are rarer still
    turn = F.row_number().over(Window.partitionBy("uid").orderBy(F.desc("n"), F.desc("element")))
    needs = members.select("uid", "component", outside.alias("outside"), upwards(weight - spare, 100).alias("x"), upwards(weight, 100 + threshold).alias("y"))
    ranked = shared.select("hub", "uid", "element", turn.alias("turn")).join(needs, "uid")
    ranked = ranked.select("hub", "uid", "element", "component", (F.col("outside") & (F.col("turn") >= F.col("x"))).alias("as_x"), (F.col("turn") >= F.col("y")).alias("as_y"))
    rarest = written(ranked.where("as_x or as_y"), "rarest-elements")
    discard(shared)
    meeting = rarest.groupBy("hub", "element").agg(F.max("as_x").alias("as_x"), F.max("as_y").alias("as_y"), F.min("component").alias("low"), F.max("component").alias("high"))
    meeting = meeting.where("as_x and as_y and low <> high").select("hub", "element")
    meets = written(rarest.join(meeting, ["hub", "element"], "left_semi").drop("component"), "meeting-elements")
    discard(rarest)
    attributes = ("node", "component", "leader_size", "lacks", "adds", "hidden", *DIFFERING)
    full = meets.join(members.select("uid", "hub_component", *attributes), "uid")
    x = full.where("as_x").select("hub", "element", *attributes).alias("x")
    y = full.where("as_y").select("hub", "element", "hub_component", *attributes).drop("leader_size").alias("y")
    late = x.join(y, (F.col("x.hub") == F.col("y.hub")) & (F.col("x.element") == F.col("y.element")) & (F.col("x.component") != F.col("y.component"))
                  & ((F.col("y.component") == F.col("y.hub_component")) | (F.col("x.node") < F.col("y.node"))) & may_share_enough("x", "y", threshold))
    pairs = written(late.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct(), "late-pairs")
    discard(meets)
    return pairs


def _between(links: DataFrame, found: DataFrame) -> DataFrame:
    """The links as pairs of components, where they join two."""
    a, b = found.toDF("a", "component_a"), found.toDF("b", "component_b")
    joined = links.join(a, "a", "left").join(b, "b", "left")
    return joined.select(F.coalesce("component_a", "a").alias("a"), F.coalesce("component_b", "b").alias("b")).where("a <> b").distinct()


def _near(pairs: DataFrame, classes: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) of classes that are near by their sizes and signatures."""
    a, b = classes.alias("a"), classes.alias("b")
    near = pairs.alias("p").join(a, F.col("p.a") == F.col("a.node")).join(b, F.col("p.b") == F.col("b.node"))
    return near.where(within_size("a", "b", threshold) & (differing_symbols("a", "b") <= ALLOWED)).select("p.a", "p.b")


def near_duplicates(docs: DataFrame, size: int = 5, threshold: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per row of ``docs`` (doc_id, text).

    Documents are linked whose sets of ``size``-word shingles have at least ``threshold`` percent of their union in common.
    ``component_id`` is the smallest id reachable over links; the document of that id is kept.
    """
    signed = written(signatures(docs, size), "signatures")
    print_ = ["f1", "f2", "n_shingles"]
    classes = signed.where("n_shingles > 0").groupBy(*print_).agg(F.min("doc_id").alias("node"), *[F.first(s).alias(s) for s in SIGNATURE])
    classes = written(classes, "classes")
    keys = classes.select(index_keys().alias("key"), "node")
    leaders = keys.groupBy("key").agg(F.min_by("node", F.xxhash64("node", "key")).alias("leader"), F.count("*").alias("size")).where("size > 1")
    entries = written(keys.join(leaders, "key"), "index-entries")

    def checked(pairs: DataFrame) -> DataFrame:
        stored = written(pairs, "pairs")
        found = compared(stored, docs, size)
        discard(stored)
        return found

    # a round with one leader for each class, then one with the leaders of all entries that it leaves open
    largest = entries.where("node <> leader").groupBy("node").agg(F.max_by("leader", F.struct("size", F.xxhash64("key"))).alias("leader"))
    begun = _near(largest.select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct(), classes, threshold)
    stars = checked(begun)
    begun = written(linked(stars, threshold), "links")
    discard(stars)
    started = components(begun)
    of = started.select(F.col("node").alias("leader"), F.col("component").alias("leads"))
    placed = entries.join(started, "node", "left").join(of, "leader", "left")
    apart = F.coalesce("component", "node") != F.coalesce("leads", "leader")
    met = placed.where(apart).select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct()
    stars = checked(_near(met, classes, threshold))
    first = written(linked(stars, threshold).unionByName(begun).distinct(), "links")
    for used in (stars, begun, started):
        discard(used)
    found = components(first)

    # entries that still hold several components meet their hub, the node with most links so far
    placed = entries.join(found, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component"))
    links = first.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("links"))
    several = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("key")
    left = written(placed.join(several, "key").join(links, "node", "left"), "open-entries")
    for used in (entries, first):
        discard(used)
    hubs = left.groupBy("key").agg(F.max_by(F.struct("node", "component"), F.struct(F.coalesce("links", F.lit(0)), "node")).alias("hub"))
    open_ = left.join(hubs, "key").select("key", "node", "component", F.col("hub.node").alias("hub"), F.col("hub.component").alias("hub_component"))
    met = open_.where("node <> hub").select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()
    spokes = checked(met)
    second = written(linked(spokes, threshold), "links")

    # then the members that are not in their hub's component meet all members of that hub, where it does not rule a link out
    members = _from_hubs(spokes, open_.select("node", "hub", "component", "hub_component").distinct(), threshold)
    for used in (left, spokes):
        discard(used)
    late = _late_pairs(members, threshold)
    discard(members)
    spokes = compared(late, docs, size)
    groups = components(found.toDF("a", "b").union(_between(second.union(linked(spokes, threshold)), found)))
    for used in (late, spokes, second, found):
        discard(used)

    grouped = classes.select(*print_, "node").join(groups, "node", "left").select(*print_, F.coalesce("component", "node").alias("component_id"))
    rows = signed.select("doc_id", *print_).join(grouped, print_, "left")
    component = F.coalesce("component_id", "doc_id")
    return rows.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))
