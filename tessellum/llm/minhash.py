"""MinHash near-duplicate detection by a signature-coordinate inverted join.

Every different shingle set is posted under its (coordinate, value) pairs.  Two
sets that agree in `threshold` of the `coordinates` must share one of the first
``coordinates - threshold + 1`` pairs of any common order of all pairs, so only
that prefix is posted; pairs that are frequent stand last in the order and are
seldom in a prefix.  Collisions in the posted lists give candidates, the rest of
the merge skips the lists and counts equal coordinates of the two signatures.
Pairs above the threshold are confirmed on their full shingle sets.

Lists of thousands of near copies are not expanded into pairs.  The least
document of a list is its centre, and each document first goes with the centre
that it collides with most.  The links that are confirmed are contracted into
components, and only members of lists that still hold several components are
compared again, in blocks of bounded size, one component with another.  Exact copies are one set from the start.
Keys with a large share of the rows, a class of copies, a list or a centre, are dealt to several tasks in joins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessellum.llm import arrowtext as at
from tessellum.llm.components import connected_components
from tessellum.llm.skew import join_counted
from tessellum.llm.storage import materialise

U64 = np.uint64


@dataclass(frozen=True)
class NearDuplicates:
    """Parameters.

    similarity: least Jaccard similarity of a link, in hundredths.
    coordinates, threshold: length of a signature and how many of its
        coordinates must agree.  At 0.85 a pair agrees in fewer than 38 of 64
        with a probability of about 1e-7.
    order_sample: different sets, taken by hash, whose frequent pairs set the
        order of all pairs.  The order changes the amount of work, never the
        result.
    block, block_bytes: about how many members of a list, and bytes of their
        sets, are compared with others at once; a longer set stands alone.
    beside: chunks of a list that one task compares with those outside its main component.
    long: members of lists longer than this bring their full sets along.
    broadcast_ids: most ids that are broadcast to pick texts; above it, a join.
    """

    width: int = 5
    similarity: int = 85
    coordinates: int = 64
    threshold: int = 38
    order_sample: int = 8192
    block: int = 512
    block_bytes: int = 8 << 20
    beside: int = 8
    long: int = 64
    broadcast_ids: int = 1_000_000

    @property
    def prefix(self) -> int:
        return self.coordinates - self.threshold + 1


def shingle_hashes(block: at.TextBlock, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets) of each text's shingles; a text of fewer words is one shingle."""
    w = at.words(block, at.SPACE_SEPARATED)
    n = w.counts()
    made = np.where(n >= width, n - width + 1, np.minimum(n, 1))
    first = at.ragged(w.offsets[:-1], made)
    own = np.repeat(np.minimum(n, width), made)
    total = np.zeros(len(first), U64)
    for j in range(width):
        there = own > j
        factor = U64((0xA0761D6478BD642F * (2 * j + 3)) & (2**64 - 1) | 1)
        if there.all():
            total += w.hashes[first + j] * factor
        else:
            total[there] += w.hashes[first[there] + j] * factor
    return at.mix(total + own.astype(U64)), np.concatenate(([0], np.cumsum(made)))


def shingle_sets(block: at.TextBlock, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets) of each text's distinct shingles, sorted."""
    every, offsets = shingle_hashes(block, width)
    parts = []
    for i in range(len(block)):
        x = np.sort(every[offsets[i] : offsets[i + 1]])
        if len(x) > 1:
            keep = np.ones(len(x), bool)
            np.not_equal(x[1:], x[:-1], out=keep[1:])
            x = x[keep]
        parts.append(x)
    sizes = np.array([len(x) for x in parts], np.int64)
    return (np.concatenate(parts) if parts else every[:0]), np.concatenate(([0], np.cumsum(sizes)))


def _coefficients(k: int) -> tuple[np.ndarray, np.ndarray]:
    seed = at.mix(np.arange(1, 2 * k + 1, dtype=U64) * U64(0x9E3779B97F4A7C15))
    return seed[:k] | U64(1), seed[k:]


#: Rows that can be linked.
USABLE = "doc_id IS NOT NULL AND n_shingles > 0"
SIGNED = "doc_id bigint, n_shingles bigint, fp1 bigint, fp2 bigint, signature binary"


def _sign(batches: Iterator[pa.RecordBatch], p: NearDuplicates) -> Iterator[pa.RecordBatch]:
    a, b = _coefficients(p.coordinates)
    for batch in at.released(batches):
        ids = batch.column("doc_id")
        for block in at.blocks(batch.column("text")):
            sets, offsets = shingle_sets(block, p.width)
            size = np.diff(offsets)
            full = np.flatnonzero(size)
            signature = np.zeros((len(full), p.coordinates), np.uint32)
            fp = np.zeros((2, len(block)), np.int64)
            if len(full):
                cut = offsets[:-1][full]
                for row, salt in enumerate((0x2545F4914F6CDD1D, 0x5851F42D4C957F2D)):
                    fp[row, full] = np.add.reduceat(at.mix(sets ^ U64(salt)), cut).view(np.int64)
                for k in range(p.coordinates):
                    signature[:, k] = np.minimum.reduceat(((sets * a[k] + b[k]) >> U64(32)).astype(np.uint32), cut)
            signed: list[bytes | None] = [None] * len(block)
            for row, i in enumerate(full):
                signed[i] = signature[row].tobytes()
            yield pa.RecordBatch.from_arrays(
                [ids.slice(block.first, len(block)), pa.array(size), pa.array(fp[0]), pa.array(fp[1]), pa.array(signed, pa.binary())],
                names=["doc_id", "n_shingles", "fp1", "fp2", "signature"],
            )


def signatures(docs: DataFrame, p: NearDuplicates) -> DataFrame:
    """(doc_id, n_shingles, fp1, fp2, signature): set size, 128-bit set fingerprint and MinHash signature."""
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(partial(_sign, p=p), SIGNED)


def _pairs_of(signature: np.ndarray) -> np.ndarray:
    """64-bit (coordinate, value) pairs of signatures: coordinate above, value below."""
    return signature.astype(U64) | (np.arange(signature.shape[1], dtype=U64) << U64(32))


def _matrix(column: pa.Array, k: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, k)


def _ordered(pairs: np.ndarray, common: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The coordinates of each signature in the common order: rare pairs first, by a hash; then the frequent ones, rarest first."""
    place = np.zeros(pairs.shape, np.int64)
    if len(common):
        at_ = np.minimum(np.searchsorted(common, pairs), len(common) - 1)
        place = np.where(common[at_] == pairs, rank[at_], 0)
    return np.lexsort((at.mix(pairs), place), axis=1)


def _post(batches: Iterator[pa.RecordBatch], p: NearDuplicates, common: np.ndarray, rank: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in at.released(batches):
        if not batch.num_rows:
            continue
        pairs = _pairs_of(_matrix(batch.column("signature"), p.coordinates))
        chosen = np.take_along_axis(pairs, _ordered(pairs, common, rank)[:, : p.prefix], axis=1)
        ids = np.repeat(batch.column("rep").to_numpy(zero_copy_only=False), p.prefix)
        yield pa.RecordBatch.from_arrays([pa.array(chosen.ravel().view(np.int64)), pa.array(ids)], names=["pair", "rep"])


def _frequent_pairs(reps: DataFrame, p: NearDuplicates) -> tuple[np.ndarray, np.ndarray]:
    """Pairs held twice or more in a bounded sample of signatures, and their rank by frequency."""
    sample = reps.orderBy(F.xxhash64("fp1", "fp2"), "rep").select("signature").limit(p.order_sample).collect()
    if not sample:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    pairs = _pairs_of(np.frombuffer(b"".join(bytes(r[0]) for r in sample), np.uint32).reshape(-1, p.coordinates))
    value, count = np.unique(pairs, return_counts=True)
    value, count = value[count > 1], count[count > 1]
    return value, count.astype(np.int64)


def _agree(batches: Iterator[pa.RecordBatch], p: NearDuplicates) -> Iterator[pa.RecordBatch]:
    """Keeps the pairs whose signatures agree in enough coordinates."""
    for batch in at.released(batches):
        if batch.num_rows:
            same = (_matrix(batch.column("sa"), p.coordinates) == _matrix(batch.column("sb"), p.coordinates)).sum(axis=1)
            yield batch.filter(pa.array(same >= p.threshold)).select(["a", "b"])


def _both_sides(pairs: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """Pairs with what is known of a and of b; an a may be the centre of a large share of all pairs."""
    return join_counted(pairs, left, ["a"], pairs.count(), ["b"]).join(right, "b")


def _above_threshold(pairs: DataFrame, reps: DataFrame, p: NearDuplicates) -> DataFrame:
    left = reps.select(F.col("rep").alias("a"), F.col("signature").alias("sa"))
    right = reps.select(F.col("rep").alias("b"), F.col("signature").alias("sb"))
    return _both_sides(pairs, left, right).select("a", "b", "sa", "sb").mapInArrow(partial(_agree, p=p), "a bigint, b bigint")


def _sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in at.released(batches):
        for block in at.blocks(batch.column("text")):
            sets, offsets = shingle_sets(block, width)
            held = [sets[offsets[i] : offsets[i + 1]].tobytes() for i in range(len(block))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(block.first, len(block)), pa.array(held, pa.binary())], names=["rep", "held"])


def _confirm(batches: Iterator[pa.RecordBatch], similarity: int) -> Iterator[pa.RecordBatch]:
    for batch in at.released(batches):
        keep = []
        for x, y in zip(batch.column("ha").to_pylist(), batch.column("hb").to_pylist(), strict=True):
            a, b = np.frombuffer(x, U64), np.frombuffer(y, U64)
            both = np.sort(np.concatenate((a, b)))
            common = int(np.count_nonzero(both[1:] == both[:-1]))
            keep.append(100 * common >= similarity * (len(a) + len(b) - common))
        if keep:
            yield batch.filter(pa.array(keep)).select(["a", "b"])


def _held(ids: DataFrame, docs: DataFrame, p: NearDuplicates) -> DataFrame:
    """(rep, held): the shingle sets of the documents of ids(doc_id), written out."""
    ids = materialise(ids.distinct(), "ids")
    wanted = F.broadcast(ids) if ids.count() <= p.broadcast_ids else ids
    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).join(wanted, "doc_id", "left_semi")
    return materialise(texts.mapInArrow(partial(_sets, width=p.width), "rep bigint, held binary"), "sets")


def confirmed(pairs: DataFrame, docs: DataFrame, p: NearDuplicates) -> DataFrame:
    """The pairs (a, b) of doc_ids whose full shingle sets are similar enough."""
    pairs = materialise(pairs, "pairs")
    held = _held(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")), docs, p)
    left = held.select(F.col("rep").alias("a"), F.col("held").alias("ha"))
    right = held.select(F.col("rep").alias("b"), F.col("held").alias("hb"))
    return _both_sides(pairs, left, right).select("a", "b", "ha", "hb").mapInArrow(partial(_confirm, similarity=p.similarity), "a bigint, b bigint")


def _common(one: list[np.ndarray], two: list[np.ndarray], cells: int = 1 << 22) -> np.ndarray:
    """The sizes of the intersections of all sets of one with all of two.

    A product of incidence matrices over the elements that both sides hold, so
    many at a time that a matrix has about `cells` cells.
    """
    flat1, flat2 = np.concatenate(one), np.concatenate(two)
    vocabulary = np.intersect1d(flat1, flat2)
    total = np.zeros((len(one), len(two)), np.float32)
    if not len(vocabulary):
        return total.astype(np.int64)
    sides = []
    for sets, flat in ((one, flat1), (two, flat2)):
        at_ = np.minimum(np.searchsorted(vocabulary, flat), len(vocabulary) - 1)
        there = vocabulary[at_] == flat
        row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])[there]
        order = np.argsort(at_[there], kind="stable")
        sides.append((at_[there][order], row[order]))
    step = max(1, cells // max(len(one), len(two)))
    for low in range(0, len(vocabulary), step):
        made = []
        for (word, row), sets in zip(sides, (one, two), strict=True):
            own = slice(*np.searchsorted(word, (low, low + step)))
            matrix = np.zeros((len(sets), min(step, len(vocabulary) - low)), np.float32)
            matrix[row[own], word[own] - low] = 1
            made.append(matrix)
        total += made[0] @ made[1].T
    return np.rint(total).astype(np.int64)


def _met(pair: int, one: list[dict], two: list[dict], p: NearDuplicates, common: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Of two chunks of a list, which members of different components agree in enough coordinates.

    A pair meets in every list that it shares and is given out by the first of
    them in the common order.
    """
    s1, s2 = (np.frombuffer(b"".join(m["signature"] for m in x), np.uint32).reshape(-1, p.coordinates) for x in (one, two))
    c1, c2 = (np.array([m["component"] for m in x], np.int64) for x in (one, two))
    place = np.argsort(_ordered(_pairs_of(s1), common, rank), axis=1)
    early = place < place[:, pair >> 32][:, None]
    agree, seen = np.zeros((len(s1), len(s2)), np.uint8), c1[:, None] == c2
    for k in range(p.coordinates):
        same = s1[:, k][:, None] == s2[:, k]
        agree += same
        seen |= same & early[:, k][:, None]
    return (agree >= p.threshold) & ~seen


def _compare(batches: Iterator[pa.RecordBatch], p: NearDuplicates, common: np.ndarray, rank: np.ndarray, full: bool) -> Iterator[pa.RecordBatch]:
    """Of each task's two chunks of a list, the pairs of different components whose signatures agree enough.

    full: the members bring their shingle sets; a pair is given out only if it is
    linked and joins two components that nothing in the two chunks has joined yet.
    """
    for batch in at.released(batches):
        out_a, out_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for row in range(batch.num_rows):
            pair, one, two = (batch.column(c)[row].as_py() for c in ("pair", "one", "two"))
            r1, r2 = (np.array([m["rep"] for m in x], np.int64) for x in (one, two))
            good = _met(pair, one, two, p, common, rank)
            if full and good.any():
                left, right = np.flatnonzero(good.any(axis=1)), np.flatnonzero(good.any(axis=0))
                h1, h2 = ([np.frombuffer(x[k]["held"], U64) for k in which.tolist()] for x, which in ((one, left), (two, right)))
                both = _common(h1, h2)
                sizes = np.array([len(x) for x in h1])[:, None] + np.array([len(x) for x in h2])
                linked = good[np.ix_(left, right)] & (100 * both >= p.similarity * (sizes - both))
                c1, c2 = (np.array([x[k]["component"] for k in which.tolist()], np.int64) for x, which in ((one, left), (two, right)))
                r1, r2, good = r1[left], r2[right], np.zeros_like(linked)
                for i in np.flatnonzero(linked.any(axis=1)):
                    other = np.flatnonzero(linked[i] & (c2 != c1[i]))
                    other = other[np.unique(c2[other], return_index=True)[1]]
                    good[i, other] = True
                    for joined in c2[other]:
                        c2[c2 == joined], c1[c1 == joined] = c1[i], c1[i]
            i, k = np.nonzero(good)
            out_a.append(np.minimum(r1[i], r2[k]))
            out_b.append(np.maximum(r1[i], r2[k]))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_a)), pa.array(np.concatenate(out_b))], names=["a", "b"])


def _remaining(postings: DataFrame, reps: DataFrame, labels: DataFrame, docs: DataFrame, p: NearDuplicates, common: np.ndarray, rank: np.ndarray) -> DataFrame:
    """Links (a, b) found in lists that hold several components.

    The members of a list outside its largest component meet all of its members,
    chunk by chunk.  Members of the largest component don't meet each other.
    Short lists give candidate pairs that are confirmed afterwards; members of
    long ones bring their sets, so that a list of many similar texts that aren't
    linked gives nothing out.
    """
    known = materialise(postings.join(labels, "rep", "left").select("pair", "rep", F.coalesce("component", "rep").alias("component")), "known")
    sizes = known.groupBy("pair", "component").agg(F.count(F.lit(1)).alias("n"))
    lists = (
        sizes.groupBy("pair")
        .agg(F.count(F.lit(1)).alias("parts"), F.sum("n").alias("total"), F.max_by("component", F.struct("n", "component")).alias("main"))
        .filter("parts > 1")
        .select("pair", "main", "total")
    )
    lists = materialise(lists, "lists")
    # sizes first: signatures and sets are brought along only when each member knows its chunk
    met_again = join_counted(known, lists, ["pair"], known.count(), ["rep"], lists.select("pair", F.col("total").alias("n")))
    light = materialise(met_again.join(reps.select("rep", "n_shingles"), "rep"), "light")
    weight = light.groupBy("pair").agg(F.count(F.lit(1)).alias("n"), (8 * F.sum("n_shingles")).alias("bytes"))
    chunks = F.greatest(F.ceil(F.col("n") / p.block), F.ceil(F.col("bytes") / p.block_bytes))
    weight = materialise(weight.select("pair", "n", chunks.alias("chunks"), (F.col("n") > p.long).alias("long")), "weights")
    dealt = join_counted(light.drop("total", "n_shingles"), weight.drop("n"), ["pair"], light.count(), ["rep"], weight)
    dealt = dealt.withColumn("chunk", F.pmod(F.xxhash64("rep"), F.col("chunks")))
    member = materialise(dealt.join(reps.select("rep", "signature"), "rep"), "members")

    def met(member: DataFrame, item: Column, full: bool) -> DataFrame:
        # chunks of a list are dealt to tasks some at a time, and the chunks outside its main component go to each of these
        groups = F.ceil(F.col("chunks") / p.beside)
        every = member.groupBy("pair", "chunk", F.pmod("chunk", groups).alias("group")).agg(F.collect_list(item).alias("two"))
        outside = member.filter("component != main").groupBy("pair", F.col("chunk").alias("own"), groups.alias("groups")).agg(F.collect_list(item).alias("one"))
        outside = outside.withColumn("group", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("groups") - 1)))
        compare = partial(_compare, p=p, common=common, rank=rank, full=full)
        return outside.join(every, ["pair", "group"]).select("pair", "one", "two").mapInArrow(compare, "a bigint, b bigint").distinct()

    short = confirmed(met(member.filter("NOT long"), F.struct("rep", "component", "signature"), False), docs, p)
    crowded = member.filter("long")
    held = _held(crowded.select(F.col("rep").alias("doc_id")), docs, p)
    return short.unionByName(met(crowded.join(held, "rep"), F.struct("rep", "component", "signature", "held"), True))


def _classes(usable: DataFrame) -> DataFrame:
    """(fp1, fp2, n_shingles, n, rep, signature): the classes of equal sets, their sizes and least documents."""
    return usable.groupBy("fp1", "fp2", "n_shingles").agg(
        F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("rep"), F.min_by("signature", "doc_id").alias("signature")
    )


def similar_links(docs: DataFrame, p: NearDuplicates = NearDuplicates()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(signed, classes, links): signatures of all documents, the classes of equal sets, and a set of
    confirmed links between their least documents whose components are those of all links."""
    signed = materialise(signatures(docs, p), "signed")
    reps = materialise(_classes(signed.filter(USABLE)), "reps")
    common, rank = _frequent_pairs(reps, p)
    posted = materialise(reps.select("rep", "signature").mapInArrow(partial(_post, p=p, common=common, rank=rank), "pair bigint, rep bigint"), "posted")
    shared = materialise(posted.groupBy("pair").agg(F.count(F.lit(1)).alias("n"), F.min("rep").alias("centre")).filter("n > 1"), "shared")
    postings = materialise(join_counted(posted, shared.drop("n"), ["pair"], posted.count(), ["rep"], shared), "postings")
    # each document goes with the centre it collides with most
    collisions = postings.filter("rep != centre").groupBy("rep", "centre").agg(F.count(F.lit(1)).alias("n"))
    stars = collisions.groupBy("rep").agg(F.max_by("centre", F.struct("n", -F.col("centre"))).alias("a")).select("a", F.col("rep").alias("b"))
    links = materialise(confirmed(_above_threshold(materialise(stars, "stars"), reps, p), docs, p), "confirmed")
    labels = materialise(connected_components(links).withColumnRenamed("node", "rep"), "labels")
    more = materialise(_remaining(postings, reps, labels, docs, p, common, rank), "confirmed")
    return signed, reps, links.unionByName(more)


def near_duplicates(docs: DataFrame, p: NearDuplicates = NearDuplicates()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of docs(doc_id, text, ...).

    Texts are lower-cased in A-Z and split at ASCII white space; a document's set
    is that of its `width`-word shingles, or its whole sequence if it is shorter.
    component_id is the least doc_id reachable over links of at least
    `similarity`; kept is true for that document.  Empty and null texts have
    n_shingles 0, are linked with nothing and kept.  A null doc_id is linked with
    nothing and kept, with a null component_id.  Rows that repeat a doc_id are
    one document for linking.  Other columns are ignored; an empty table gives
    an empty one.
    """
    signed, reps, links = similar_links(docs, p)
    components = materialise(connected_components(links), "components")
    same = ["fp1", "fp2", "n_shingles"]
    found = F.coalesce("component", "rep").alias("component_id")
    classes = materialise(reps.join(components.withColumnRenamed("node", "rep"), "rep", "left").select(*same, "n", found), "classes")
    rows = signed.select("doc_id", *same)
    linked = join_counted(rows.filter(USABLE), classes.drop("n"), same, rows.count(), ["doc_id", F.spark_partition_id()], classes).select("doc_id", "n_shingles", "component_id")
    alone = rows.filter(f"NOT ({USABLE})").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    return linked.unionByName(alone).select("doc_id", "n_shingles", "component_id", kept.alias("kept"))
