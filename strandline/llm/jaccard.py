"""N-gram Jaccard join by PartEnum signatures (operator 9).

After Arasu, Ganti and Kaushik, "Efficient Exact Set-Similarity Joins" (2006). Sets are taken in bands of
near-equal size; within a band a Jaccard bound is a bound k on the Hamming distance. The feature domain
is hashed into n1 parts of n2 = 2 sub-parts. Of two sets within distance k, some part differs by one
feature at most, so leaving out one of its sub-parts makes both agree on the rest: that rest is a
signature, and two sets that are similar enough share one.

What makes the guarantee hold with signatures of real features only: say that z parts of a pair agree and
o parts differ by one feature. The rest differ by two and more, so z + o / 2 >= n1 - k / 2, which is over
``slack`` when n1 has ``slack`` parts more than the bound asks for. The pair is missed only if those z
parts are empty and those o parts have an empty rest, so that both sets have 2 z + o > 2 ``slack`` empty
sub-parts. A set with that many repeats its signatures under another hashing, and the last one keeps
its empty rests too.

The same count says how many signatures similar sets share: 2 z + o, less those of empty rests, and 2 z + o is at least
2 n1 - k. So a set with e signatures under a hashing shares e - k of them at least with any set that it links with. One with
fewer that others have is left out, and so is, later, one with fewer in groups of several components: texts that have
a few passages in common seldom have so many.

Sets are known by a 64-bit hash (a node), so copies are one node, however many there are. A group that
shares a signature is sorted by minima of its sets' features, which puts like sets side by side, and every
node is first compared with its neighbour; the signature picks one of a few such orders. What that links
makes components, and only pairs across components are then tested, by size and by parity sketches where they meet,
and by the sets themselves if these let them pass. So no link between components goes unseen, and a group of near
copies costs its size.

Groups in several components, as texts round one boilerplate make, are split further: their sets' members are
ordered by how few sets have them, and two sets that link share one of the first members of both (the prefixes of
Chaudhuri, Ganti and Kaushik, "A Primitive Operator for Similarity Joins in Data Cleaning", 2006, and the shorter ones
of the smaller set of Xiao et al., "Efficient Similarity Joins for Near Duplicate Detection", 2008). What such texts have
in common comes last, so those that are not alike do not meet.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions.staging import staged, unstage
from strandline.llm.textbytes import chunks, free_name, lower_ascii, mix64, small_batches, space_words, word_hashes
from strandline.operators.graph import connected_components

BAND = 1.4
SUBPARTS = 2
HASHINGS = 6
#: Orders that a group is sorted by, one for each signature; each goes by as many minima.
ORDERS = 4
#: Longs of a set's parity sketch, and of the wide one that sets of at least LARGE members have besides.
SKETCH_LONGS = 16
WIDE_LONGS = 64
LARGE = 1200
#: Bits of the map of nodes that share a signature: 4 MB, whatever the input.
MAP_BITS = 1 << 25


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each row of a chunk, one after another, and their offsets."""
    n = len(offsets) - 1
    data = lower_ascii(data)
    start, end, row = space_words(data, offsets)
    h = word_hashes(data, start, end)
    words = np.bincount(row, minlength=n)
    at = np.concatenate([[0], np.cumsum(words)])
    seed = mix64(np.arange(11, 11 + width, dtype=np.uint64))
    if len(h) >= width:
        m = len(h) - width + 1
        s = np.zeros(m, np.uint64)
        for i in range(width):
            s += mix64(h[i : i + m] ^ seed[i])
        s = mix64(s)
    else:
        s = np.zeros(0, np.uint64)
    out, sizes = [], np.zeros(n, np.int64)
    for i in np.flatnonzero(words):
        a, b = at[i], at[i + 1]
        if b - a >= width:
            x = np.sort(s[a : b - width + 1])
            x = x[np.concatenate([[True], x[1:] != x[:-1]])]
        else:
            x = mix64(np.array([(h[a:b] * seed[: b - a]).sum() + np.uint64(b - a)], np.uint64))
        out.append(x)
        sizes[i] = len(x)
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), np.concatenate([[0], np.cumsum(sizes)])


def _node_ids(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A hash of each set, in any order of its members."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(x ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64)])
    return mix64(total[at[1:]] - total[at[:-1]] + np.diff(at).astype(np.uint64)).view(np.int64)


def _sketches(x: np.ndarray, at: np.ndarray, longs: int) -> np.ndarray:
    """Parity of the number of members in each of 64 * longs hash slots: two sketches differ in no more bits
    than the sets' Hamming distance."""
    n, bits = len(at) - 1, 64 * longs
    row = np.repeat(np.arange(n), np.diff(at))
    slot = (mix64(x ^ np.uint64(77)) & np.uint64(bits - 1)).astype(np.int64)
    odd = (np.bincount(row * bits + slot, minlength=n * bits) & 1).astype(np.uint8)
    return np.packbits(odd.reshape(n, bits), axis=1).view(np.int64)


def _orders(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """ORDERS longs of each set: each has the least member (its 16 upper bits) of ORDERS of 16 hash slots.

    Two sets have the same minimum of a slot with the odds of their similarity, so like sets are close in order.
    """
    n, slots = len(at) - 1, ORDERS * ORDERS
    low = np.full(n * slots, 0xFFFF, np.uint64)
    np.minimum.at(low, np.repeat(np.arange(n), np.diff(at)) * slots + (x % np.uint64(slots)).astype(np.int64), x >> np.uint64(48))
    low = low.reshape(n, ORDERS, ORDERS)
    return sum(low[:, :, k] << np.uint64(16 * (ORDERS - 1 - k)) for k in range(ORDERS)).view(np.int64)


def _next_band(low: int, percent: int) -> int:
    """No set under ``low`` members links with one of as many as this, so linked sets are one band apart at most."""
    return max(low + 1, int(low * BAND), -(-low * 100 // percent))


def bands(percent: int, largest: int) -> list[int]:
    """Lower ends of the size bands, the last one above ``largest``."""
    out = [1]
    while out[-1] <= largest:
        out.append(_next_band(out[-1], percent))
    return out


def _hamming(total: int, percent: int) -> int:
    """The largest Hamming distance of two sets with ``total`` members together that still link."""
    return total * (100 - percent) // (100 + percent)


def signatures(x: np.ndarray, at: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, signature) for each signature of each set of a chunk; those of odd bands are negative."""
    return _signatures(x, at, percent)[:2]


def needs(x: np.ndarray, at: np.ndarray, percent: int) -> np.ndarray:
    """For each set of a chunk, so many of its signatures of even bands at least, or of odd ones, any set shares that links with it."""
    return _signatures(x, at, percent)[2]


def _signatures(x: np.ndarray, at: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.diff(at)
    need = np.full((len(sizes), 2), np.iinfo(np.int32).max, np.int32)
    low = bands(percent, int(sizes.max(initial=1)))
    low.append(_next_band(low[-1], percent))
    low_a = np.array(low)
    own = np.searchsorted(low_a, sizes, "right") - 1
    rows = np.flatnonzero(sizes)
    # a set also stands in the next band if the least set there can link with it
    up = rows[100 * sizes[rows] >= percent * low_a[own[rows] + 1]]
    found = []
    for some, band in ((rows, own[rows]), (up, own[up] + 1)):
        top = np.array([*low[1:], low[-1]])[band] - 1
        k = 2 * top * (100 - percent) // (100 + percent)
        base = (k + 2) // 2
        slack = 1 + base // 5
        todo = np.flatnonzero(k > 0)
        for hashing in range(HASHINGS):
            if not len(todo):
                break
            (row, sig), again = _one_hashing(x, at, some[todo], band[todo], (base + slack)[todo], slack[todo], hashing, hashing == HASHINGS - 1)
            own_rows, odd = some[todo], band[todo] & 1
            # at most k signatures of a set are not those of one that links with it
            least = np.maximum(1, np.bincount(row, minlength=len(sizes))[own_rows] - k[todo])
            need[own_rows, odd] = np.minimum(need[own_rows, odd], least)
            parity = np.zeros(len(sizes), np.uint64)
            parity[own_rows] = odd
            found.append((row, (sig >> np.uint64(1) | parity[row] << np.uint64(63)).view(np.int64)))
            todo = todo[again]
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), need
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]), need


def _one_hashing(x, at, rows, band, parts, slack, hashing: int, last: bool):
    sizes = at[rows + 1] - at[rows]
    head = np.concatenate([[0], np.cumsum(sizes)])
    pick = np.repeat(at[rows] - head[:-1], sizes) + np.arange(head[-1])
    own = np.repeat(np.arange(len(rows)), sizes)
    v = x[pick]
    if hashing:
        v = mix64(v ^ np.uint64(hashing * 0x632BE59BD9B4E019 & (1 << 64) - 1))
        v = v[np.lexsort((v, own))]
    first = np.concatenate([[0], np.cumsum(parts)])
    # members are sorted, so a part is a stretch of them
    part = ((v >> np.uint64(32)) * parts.astype(np.uint64)[own] >> np.uint64(32)).astype(np.int64) + first[own]
    n = int(first[-1])
    end = np.cumsum(np.bincount(part, minlength=n))
    start = np.concatenate([[0], end[:-1]])
    sub = (v & np.uint64(0xFFFF)) % np.uint64(SUBPARTS)
    mixed = mix64(v ^ np.uint64(0xA0761D6478BD642F))
    sums, counts = [], []
    for j in range(SUBPARTS):
        in_j = sub == j
        c = np.concatenate([np.zeros(1, np.uint64), np.cumsum(np.where(in_j, mixed, np.uint64(0)), dtype=np.uint64)])
        sums.append(c[end] - c[start])
        c = np.concatenate([[0], np.cumsum(in_j)])
        counts.append(c[end] - c[start])
    total, number = sum(sums[1:], sums[0]), sum(counts[1:], counts[0])
    row = np.repeat(np.arange(len(rows)), parts)
    tag = (np.arange(n) - first[row]).astype(np.uint64) + (band[row].astype(np.uint64) << np.uint64(40)) + np.uint64(hashing << 56)
    bare = np.zeros(len(rows), np.int64)
    out_row, out_sig = [], []
    for j in range(SUBPARTS):
        rest = number - counts[j]
        bare += np.bincount(row, rest == 0, minlength=len(rows)).astype(np.int64)
        keep = np.ones(n, bool) if last else rest > 0
        out_row.append(rows[row[keep]])
        out_sig.append(mix64(mix64(tag[keep] * np.uint64(SUBPARTS) + np.uint64(j)) + total[keep] - sums[j][keep]))
    return (np.concatenate(out_row), np.concatenate(out_sig)), np.flatnonzero(bare > 2 * slack)


def row_key() -> Column:
    return F.xxhash64("doc_id", "text").alias("key")


def _lists(sizes: np.ndarray, values: np.ndarray, mask: np.ndarray | None = None) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(values.ravel()), mask=None if mask is None else pa.array(mask))


def _summaries(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """doc_id, key, n, node (null for an empty set), orders, sketch, wide (of large sets, else empty), needs; key is a
    hash of doc_id and text. The last four are null where the task has met the node before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for i, j, data, offsets in chunks(batch.column(2)):
                x, at = shingle_hashes(data, offsets, width)
                sizes = np.diff(at)
                nodes = _node_ids(x, at)
                rows = _fresh(seen, nodes, sizes)
                own = np.zeros(j - i, np.int64)
                own[rows] = 1
                y, y_at = _take(x, at, rows)
                large = rows[sizes[rows] >= LARGE]
                wide = np.zeros(j - i, np.int64)
                wide[large] = WIDE_LONGS
                lists = [_lists(own * ORDERS, _orders(y, y_at), own == 0), _lists(own * SKETCH_LONGS, _sketches(y, y_at, SKETCH_LONGS), own == 0), _lists(wide, _sketches(*_take(x, at, large), WIDE_LONGS), own == 0), _lists(own * 2, needs(y, y_at, percent), own == 0)]
                columns = [batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), pa.array(sizes), pa.array(nodes, mask=sizes == 0), *lists]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "key", "n", "node", "orders", "sketch", "wide", "needs"])

    return small_batches(docs).select("doc_id", row_key(), "text").mapInArrow(run, "doc_id long, key long, n long, node long, orders array<long>, sketch array<long>, wide array<long>, needs array<int>")


def _fresh(seen: set, nodes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Rows whose node this task has not met yet; a set's copies then count once a task."""
    out = []
    for i in np.flatnonzero(sizes):
        if (v := int(nodes[i])) not in seen:
            seen.add(v)
            out.append(i)
    return np.array(out, np.int64)


def _take(x: np.ndarray, at: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    parts = [x[at[r] : at[r + 1]] for r in rows]
    return (np.concatenate(parts) if parts else x[:0]), np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)


def _signature_rows(docs: DataFrame, width: int, percent: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for _, _, data, offsets in chunks(batch.column(0)):
                x, at = shingle_hashes(data, offsets, width)
                nodes = _node_ids(x, at)
                rows = _fresh(seen, nodes, np.diff(at))
                row, sig = signatures(*_take(x, at, rows), percent)
                yield pa.RecordBatch.from_arrays([pa.array(sig), pa.array(nodes[rows[row]] if len(row) else np.zeros(0, np.int64))], names=["sig", "node"])

    return small_batches(docs).select("text").mapInArrow(run, "sig long, node long")


def _set_rows(docs: DataFrame, width: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for _, _, data, offsets in chunks(batch.column(0)):
                x, at = shingle_hashes(data, offsets, width)
                nodes = _node_ids(x, at)
                rows = _fresh(seen, nodes, np.diff(at))
                y, own = _take(x, at, rows)
                yield pa.RecordBatch.from_arrays([pa.array(nodes[rows]), pa.ListArray.from_arrays(pa.array(own, pa.int32()), pa.array(y.view(np.int64)))], names=["node", "shingles"])

    return small_batches(docs).select("text").mapInArrow(run, "node long, shingles array<long>")


def _among(rows: DataFrame, nodes: DataFrame, on: str = "node") -> DataFrame:
    """Rows whose node (or other ``on``) is marked in a bitmap of ``nodes``: all that belong, and a few that do not.

    The bitmap has a fixed size of 4 MB, which bounds the broadcast; a full one lets everything pass.
    """
    place = F.pmod(F.xxhash64(on), F.lit(MAP_BITS)) + 1
    marks = nodes.select(place.alias("p")).groupBy(F.bitmap_bucket_number("p").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits"))
    bit = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring(F.col("bits"), F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.expr("pmod(_bit, 8)")
    rows = rows.withColumn("bucket", F.bitmap_bucket_number(place)).withColumn("_bit", bit)
    joined = rows.join(F.broadcast(marks), "bucket").withColumn("_byte", byte)
    return joined.where(F.getbit("_byte", hit) == 1).drop("bucket", "bits", "_bit", "_byte")


def _near_sketches(a: str, b: str, percent: int) -> Column:
    """False where sizes or narrow parities rule out a link of the nodes with columns ``{a}_n`` and so on."""
    n, m = F.col(f"{a}_n"), F.col(f"{b}_n")
    odd: Column = sum((F.bit_count(F.col(f"{a}_sketch")[i].bitwiseXOR(F.col(f"{b}_sketch")[i])) for i in range(SKETCH_LONGS)), F.lit(0))
    return (F.least(n, m) * 100 >= F.greatest(n, m) * percent) & (odd * (100 + percent) <= (n + m) * (100 - percent))


def _may_link(a: str, b: str, percent: int) -> Column:
    """The same by the wide parities too, of nodes that both have them."""
    n, m, u, v = F.col(f"{a}_n"), F.col(f"{b}_n"), F.col(f"{a}_wide"), F.col(f"{b}_wide")
    more = F.aggregate(F.zip_with(u, v, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda t, k: t + k)
    wide = F.when((F.size(u) > 0) & (F.size(v) > 0), more * (100 + percent) <= (n + m) * (100 - percent)).otherwise(F.lit(True))
    return _near_sketches(a, b, percent) & wide


def _sets_of(nodes: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """node, shingles of the given nodes (and a few more), read from the texts."""
    return staged(_among(_set_rows(docs, width), nodes).dropDuplicates(["node"]))


def _verified(pairs: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Those of pairs (a, b, na, nb) that link by their sets, which are read from the texts."""
    near = staged(pairs)
    if near.isEmpty():
        return near.select("a", "b")
    sets = _sets_of(near.select(F.col("a").alias("node")).union(near.select("b")), docs, width)
    both = near.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("xb")), "b")
    both = both.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("xa")), "a")
    same = F.size(F.array_intersect("xa", "xb"))
    links = staged(both.withColumn("i", same).where((100 + percent) * F.col("i") >= percent * (F.col("na") + F.col("nb"))).select("a", "b"))
    unstage(near, sets)
    return links


def _shared(rows: DataFrame) -> DataFrame:
    """Signatures (sig, node), each pair once, that two nodes have at least."""
    by_sig = Window.partitionBy("sig").orderBy("node")
    rows = rows.select("sig", "node", F.first("node").over(by_sig).alias("least"), F.lead("node").over(by_sig).alias("next"))
    return rows.where("next <> node or (next is null and node <> least)").select("sig", "node")


def _enough(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """node of ``rows`` (sig, node; each pair once) for the nodes with as many signatures there as a link asks for."""
    odd = (F.col("sig") < 0).cast("int")
    number = rows.groupBy("node", odd.alias("_odd")).agg(F.count(F.lit(1)).alias("_k"))
    return number.join(nodes.select("node", "needs"), "node").where(F.col("_k") >= F.col("needs")[F.col("_odd")]).select("node").distinct()


def _neighbours(shared: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) that are next to each other in their group's order."""
    order = Window.partitionBy("sig").orderBy("o", "node")
    own = F.element_at("orders", (F.pmod("sig", F.lit(ORDERS)) + 1).cast("int"))
    rows = shared.join(nodes.select("node", "orders"), "node").select("sig", "node", own.alias("o"))
    rows = rows.select("node", F.lag("node").over(order).alias("p")).where("p is not null")
    return rows.select(F.least("node", "p").alias("a"), F.greatest("node", "p").alias("b")).distinct()


def jaccard_groups(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id for each row of ``docs`` (doc_id, text).

    A document's set holds its distinct word shingles of ``width`` words (A-Z in lower case, words between
    ASCII white space); one with fewer words has its whole sequence as the only member; a null or wordless
    text has an empty set, links with nothing and is its own component. Two documents link when
    ``100 * |A & B| >= percent * |A | B|``. component_id is the smallest doc_id reachable by links.
    Repeated rows and ids are taken as they come. Other columns are not read.
    """
    return _grouped(docs, width, percent).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component the row of the smallest doc_id stays.

    Rows of that doc_id that are alike in their texts count as one, whichever it is; a component's further
    rows of that doc_id with other texts go. What goes is known by (doc_id, text) and taken out by an
    anti-join, so texts that stay are moved only if what goes is too much to broadcast. Rows with a null,
    empty or wordless text all stay. Other columns, whatever their names, stay as they are.
    """
    rows = staged(_grouped(docs, width, percent).select("key", "doc_id", "component_id", F.col("n") > 0))
    rows = rows.toDF("key", "doc_id", "component_id", "has")
    same = F.col("doc_id").eqNullSafe(F.col("component_id"))
    first = Window.partitionBy("component_id").orderBy("key")
    heads = rows.where(same & F.col("has")).groupBy("component_id", "key").count()
    heads = heads.withColumn("_r", F.row_number().over(first))
    gone = rows.where(~same).select("key").union(heads.where("_r > 1").select("key")).distinct()
    again = heads.where("_r = 1 and count > 1").select("key")
    name = free_name(docs, "key")
    keyed, named = docs.select("*", row_key().alias(name)), lambda df: df.withColumnRenamed("key", name)
    kept = keyed.join(named(gone.union(again)), name, "left_anti").select(*docs.columns)
    return kept.union(keyed.join(named(again), name, "left_semi").dropDuplicates([name]).select(*docs.columns))


def _open(shared: DataFrame, found: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, c (component so far) of the nodes with enough signatures in groups of three and more nodes that are in several components."""
    known = shared.join(found, "node", "left").select("sig", "node", F.coalesce("component", "node").alias("c"))
    some = known.groupBy("sig").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count(F.lit(1)).alias("k")).where("lo < hi and k > 2")
    node = _enough(known.join(some.select("sig"), "sig", "left_semi"), nodes)
    return node.join(found, "node", "left").select("node", F.coalesce("component", "node").alias("c"))


def _prefix_pairs(crowd: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs (a, b, na, nb) across components among the nodes of ``crowd`` (node, n, c, sketch, wide) that may link.

    Members in one set alone come first in the order and meet nothing, so they are counted and not moved on; nor are
    those that only sets of one component have.
    """
    sets = _sets_of(crowd.select("node"), docs, width)
    members = sets.join(crowd.select("node"), "node", "left_semi").select("node", F.explode("shingles").alias("s"))
    spread = staged(members.groupBy("s").agg(F.count(F.lit(1)).alias("f")).where("f > 1"))
    own = Window.partitionBy("node")
    some = _among(members, spread.select("s"), "s").join(spread, "s").join(crowd.select("node", "n"), "node")
    some = some.withColumn("_k", F.count(F.lit(1)).over(own)).withColumn("_r", F.row_number().over(own.orderBy("f", "s")))
    some = some.withColumn("_at", F.col("n") - F.col("_k") + F.col("_r"))
    least = lambda share, whole: F.ceil(F.lit(share) * F.col("n") / F.lit(whole))
    some = some.where(F.col("_at") <= F.col("n") - least(percent, 100) + 1).join(crowd.select("node", "c", "sketch"), "node")
    first = F.col("_at") <= F.col("n") - least(2 * percent, 100 + percent) + 1
    rows = staged(some.select("s", "node", "c", "n", "sketch", "_at", first.alias("first")))
    unstage(sets, spread)
    two = rows.groupBy("s").agg((F.min("c") < F.max("c")).alias("_two")).where("_two").select("s")
    every, rows = rows, rows.join(two, "s", "left_semi")
    side = lambda df, k: df.select("s", *[F.col(c).alias(k if c == "node" else f"{k}_{c}") for c in ("node", "c", "n", "sketch", "_at")])
    a, b = side(rows.where("first"), "a"), side(rows, "b")
    ahead = (F.col("a_n") < F.col("b_n")) | ((F.col("a_n") == F.col("b_n")) & (F.col("a") < F.col("b")))
    # what both can have in common from their first common member on
    rest = 1 + F.least(F.col("a_n") - F.col("a__at"), F.col("b_n") - F.col("b__at"))
    enough = rest * (100 + percent) >= (F.col("a_n") + F.col("b_n")) * percent
    pairs = a.join(b, (a["s"] == b["s"]) & (F.col("a_c") != F.col("b_c")) & ahead & enough & _near_sketches("a", "b", percent)).select("a", "b").distinct()
    for k in ("a", "b"):
        pairs = pairs.join(crowd.select(*[F.col(c).alias(k if c == "node" else f"{k}_{c}") for c in ("node", "n", "sketch", "wide")]), k)
    found = pairs.where(_may_link("a", "b", percent))
    out = staged(found.select("a", "b", F.col("a_n").alias("na"), F.col("b_n").alias("nb")))
    unstage(every)
    return out


def _grouped(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """doc_id, key, n, component_id for each row."""
    members = staged(_summaries(docs, width, percent))
    every = staged(_shared(_signature_rows(docs, width, percent)))
    once = members.where("sketch is not null").drop("doc_id", "key")
    some = staged(_enough(every, once))
    shared = staged(every.join(some, "node", "left_semi"))
    nodes = staged(_among(once, some).dropDuplicates(["node"]))
    unstage(every, some)
    known = nodes.select("node", "n", "sketch", "wide")
    side = lambda df, k: df.select(*[F.col(c).alias(c if c == k else f"{k}_{c}") for c in df.columns])
    pairs = _neighbours(shared, nodes)
    for k in ("a", "b"):
        pairs = pairs.join(side(known.withColumnRenamed("node", k), k), k)
    ends = [F.col("a_n").alias("na"), F.col("b_n").alias("nb")]
    links = _verified(pairs.where(_may_link("a", "b", percent)).select("a", "b", *ends), docs, width, percent)
    found = staged(connected_components(links))
    # what is left: pairs across components, among the sets of the groups that are in several
    crowd = staged(_open(shared, found, nodes).join(known, "node"))
    more = crowd.select(F.col("node").alias("a"), F.col("node").alias("b"), *[F.col("n").alias(c) for c in ("na", "nb")]).limit(0) if crowd.isEmpty() else _prefix_pairs(crowd, docs, width, percent)
    extra = _verified(more, docs, width, percent)
    if not extra.isEmpty():
        found = staged(connected_components(links.union(extra)))
    unstage(shared, nodes, links, extra, crowd)
    reps = members.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("rep"))
    ids = reps.join(found, "node")
    least = ids.groupBy("component").agg(F.min("rep").alias("least"))
    linked = ids.join(least, "component").select("node", "least")
    named = reps.join(linked, "node", "left").select("node", F.coalesce("least", "rep").alias("component_id"))
    out = members.where("node is not null").join(named, "node").select("doc_id", "key", "n", "component_id")
    return out.union(members.where("node is null").select("doc_id", "key", "n", F.col("doc_id")))
