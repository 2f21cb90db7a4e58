"""Similarity join of documents on word shingles, by token-combination prefixes.

Two documents link when the Jaccard similarity of their sets of ``width``-word shingles is at
least ``num / den``. Shingles ("tokens" below) are put in one global order, by ascending estimated
document frequency, which falls into a rare and a frequent class. With n tokens, a set may lack at
most D = n - ceil(n * num / den) tokens of a partner, and the two differ in at most
E = floor(n * (den - num) / num) tokens. So for a similar pair,

* if they share a rare token, the first shared one is among the first D + 1 tokens of both:
  **single rare tokens of the D + 1 prefix** are indexed;
* otherwise their r rare tokens are all unshared, and of the first E - r + 2 shared frequent tokens
  some two neighbours have no unshared token of either set between them. The prefix is extended
  until it must hold that many, (D - r) + (E - r) + 2 frequent tokens, and **combinations of two
  neighbouring frequent tokens** are indexed. Their number grows with the set, not with its square.

Frequencies are estimated by counting hash slots over all documents. The table has a fixed size, so
it may be broadcast; the estimate decides cost only, never the result.

Equal sets are one node. Each index bucket compares its members with one of them, the pivot: the one
whose tokens are the most common, since copies mostly link to the text they come from. That gives
each member's difference from its pivot P, and the difference of two members follows exactly from
theirs: it has |Dx| + |Dy| - 2 |Dx and Dy| tokens. Verified links are contracted into components.
Where a pivot has members outside its own component, these are held against all its members, from
the stored differences and in blocks, so that no link between components is lost and no task holds
a whole group. A group of n near copies costs n comparisons of texts.

Before texts are compared, sketches of a few bits a token give a number of tokens by which two sets differ at
least, and drop the pairs that this alone puts too far apart.

Members with a similarity to the pivot under one half are far. Their differences are not stored; they
meet the others of their bucket in pairs of texts, as far as sizes, components and the triangle
inequality of the Jaccard distance let two members link: never with one nearer than 0.5 - (1 - num / den).

Two bitmaps of fixed size drop signatures that no two documents share, and documents in no bucket,
before they are shuffled. They may let others pass, which costs time only.

Defined cases: a null or empty text has no shingles and links with nothing; a document that occurs
twice is one node and is returned twice; rows with one id and different texts are different documents; a
null id is returned and names a component only if all its ids are null; an empty table gives no rows.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.llm.textbytes import NOT_SPACE, STEP, flat, fresh, map_texts, mix, shingle_sets, sliced, text_of, words
from tidegauge.session import shared_dir

#: Slots of the frequency table: 2**23 counters of two bytes, 16 MB whatever the corpus.
SLOT_BITS = 23
#: Bits of the bitmaps: 4 MB each whatever the corpus.
BITMAP_BITS = 25
#: Bytes of text that a task makes sets of at once: what it holds besides is a multiple of this.
SET_BYTES = 256 << 10
#: Members that share one copy of their pivot's text.
SHARE = 64
#: Distance from the pivot beyond which a member is far.
FAR = 0.5
#: Members of a block, on the side outside the pivot's component and on the other.
BLOCK_OUT, BLOCK_ALL = 512, 2048


def own_columns(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col)
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("key"), text.alias("text"))


def slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def slot_counts(docs: DataFrame, width: int) -> np.ndarray:
    """Document frequencies by hash slot, up to 65,535; partial tables are added up on executors."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << SLOT_BITS, np.uint16)
        for batch in sliced(batches, "text", SET_BYTES):
            sets = shingle_sets(words(text_of(batch, "text"), NOT_SPACE), width)
            slot, n = np.unique(slots(np.concatenate(sets)), return_counts=True)
            table[slot] = np.minimum(table[slot] + n, np.iinfo(np.uint16).max)
        yield pa.RecordBatch.from_pydict({"counts": [zlib.compress(table, 1)]})

    partial = map_texts(docs.select("text"), work, "counts binary")
    empty = np.zeros(1 << SLOT_BITS, np.uint16)
    return np.frombuffer(combined_tables(partial, saturated, empty), np.uint16)


def saturated(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sum, or the largest value where that does not fit."""
    both = a + b
    both[both < a] = np.iinfo(both.dtype).max
    return both


def combined_tables(partial: DataFrame, combine: Callable, empty: np.ndarray) -> bytes:
    """Adds up compressed tables of one size, on executors, in a tree."""

    def merge(a: bytes, b: bytes) -> bytes:
        both = (np.frombuffer(zlib.decompress(x), empty.dtype) for x in (a, b))
        return zlib.compress(combine(*both), 1)

    start = zlib.compress(empty, 1)
    tables = partial.rdd.map(lambda r: bytes(r[0]))
    return zlib.decompress(tables.treeAggregate(start, merge, merge, depth=3))


def bitmap_slots(values: np.ndarray) -> np.ndarray:
    return ((values.view(np.uint64) * STEP) >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)


def bitmap(values: DataFrame) -> np.ndarray:
    """Which slots the values of the first column fall into."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << (BITMAP_BITS - 3), np.uint8)
        for batch in batches:
            slot = bitmap_slots(batch.column(0).to_numpy())
            np.bitwise_or.at(table, slot >> 3, (0x80 >> (slot & 7)).astype(np.uint8))
        if table.any():
            yield pa.RecordBatch.from_pydict({"bits": [zlib.compress(table, 1)]})

    empty = np.zeros(1 << (BITMAP_BITS - 3), np.uint8)
    return np.frombuffer(combined_tables(map_texts(values, work, "bits binary"), np.bitwise_or, empty), np.uint8)


def in_bitmap(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    slot = bitmap_slots(values)
    return (bits[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1 == 1


def shared_signatures(sets: DataFrame) -> tuple[DataFrame, Broadcast]:
    """``(node, weight, s)`` for signatures that may occur twice, and the bitmap that they are read by."""
    every = sets.select(F.explode("signatures").alias("s")).groupBy("s").agg(F.count(F.lit(1)).alias("c"))
    bits = sets.sparkSession.sparkContext.broadcast(bitmap(every.where("c > 1").select("s")))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            s = lists.flatten().to_numpy()
            owner = np.repeat(np.arange(len(batch)), pc.list_value_length(lists).to_numpy())
            kept = in_bitmap(bits.value, s)
            row = pa.array(owner[kept])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(row), batch.column(1).take(row), pa.array(s[kept])],
                names=["node", "weight", "s"],
            )

    return map_texts(sets.select("node", "weight", "signatures"), work, "node long, weight long, s long"), bits


def frequent_from(counts: np.ndarray) -> int:
    """Slot count from which a token is frequent: well above what chance puts into a slot."""
    mean = counts.mean()
    return int(mean + 6 * np.sqrt(mean)) + 32


def signatures(tokens: np.ndarray, counts: np.ndarray, limit: int, num: int, den: int) -> np.ndarray:
    n = len(tokens)
    if not n:
        return tokens
    count = counts[slots(tokens)]
    order = np.lexsort((tokens, count))
    ranked = tokens[order]
    rare = int((count < limit).sum())
    lacking = n - -(-n * num // den)
    singles = ranked[: min(rare, lacking + 1)]
    if rare > lacking:
        return mix(singles)
    differing = n * (den - num) // num
    frequent = ranked[rare : rare + lacking - rare + max(0, differing - rare) + 2]
    pairs = mix(frequent[:-1] * STEP + frequent[1:])
    return np.concatenate((mix(singles), pairs))


def set_table(docs: DataFrame, width: int, num: int, den: int) -> tuple[DataFrame, Broadcast]:
    """Per document: its id, the hash that names its set, the set's size, its signatures and its sketch; and
    the frequency table that the signatures are made by."""
    counts = slot_counts(docs, width)
    shared = docs.sparkSession.sparkContext.broadcast(counts)
    limit = frequent_from(counts)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", SET_BYTES):
            sets = shingle_sets(words(text_of(batch, "text"), NOT_SPACE), width)
            names = np.array([set_name(x) for x in sets], np.uint64).view(np.int64)
            signed = [signatures(x, shared.value, limit, num, den) for x in sets]
            at = np.cumsum([0, *map(len, signed)], dtype=np.int32)
            flat = np.concatenate(signed).view(np.int64) if signed else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(names),
                    pa.array([len(x) for x in sets], pa.int64()),
                    pa.array([commonness(x, shared.value) for x in sets], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(at), pa.array(flat)),
                    pa.array([sketch(x) for x in sets], pa.binary()),
                ],
                names=["id", "key", "node", "n", "weight", "signatures", "sketch"],
            )

    fields = [T.StructField(c, T.LongType()) for c in ("node", "n", "weight")]
    fields.append(T.StructField("signatures", T.ArrayType(T.LongType())))
    fields.append(T.StructField("sketch", T.BinaryType()))
    return map_texts(docs, work, T.StructType([docs.schema["id"], docs.schema["key"], *fields])), shared


def commonness(tokens: np.ndarray, counts: np.ndarray) -> int:
    """The mean frequency of a set's tokens; the text that copies come from has the highest."""
    return int(16 * counts[slots(tokens)].mean()) if len(tokens) else 0


def set_name(tokens: np.ndarray) -> np.uint64:
    """One value for equal sets: an order-free sum of remixed tokens."""
    total = mix(tokens + np.uint64(0x632BE59BD9B4E019)).sum(dtype=np.uint64)
    return mix(np.array([total ^ np.uint64(len(tokens))], np.uint64))[0]


def written(spark: SparkSession, df: DataFrame, purpose: str, *read_by: Broadcast) -> DataFrame:
    """Cuts the lineage by a table in the shared folder, and gives up the broadcasts that only it was read by."""
    path = shared_dir(spark, purpose)
    df.write.parquet(path)
    for table in read_by:
        table.destroy()
    return spark.read.schema(df.schema).parquet(path)


def beside_pivots(pairs: DataFrame) -> DataFrame:
    """``(a, share, role, node)``: the members (role 1) of each pivot, dealt into groups of about ``SHARE``, and the
    pivot (role 0) in each of its groups."""
    share = F.pmod(F.xxhash64("b"), F.col("shares")).cast("int")
    spread = pairs.join(blocks_of(pairs, SHARE, "shares"), "a").select("a", share.alias("share"), "b")
    return spread.select("a", "share", F.col("b").alias("node"), F.lit(1).alias("role")).unionByName(
        spread.select("a", "share", F.col("a").alias("node"), F.lit(0).alias("role")).distinct()
    )


def grouped_by_pivot(rows: DataFrame) -> DataFrame:
    return rows.repartition("a", "share").sortWithinPartitions("a", "share", "role", "node")


def sketch(tokens: np.ndarray) -> bytes:
    """For each of 2 to 4 bins a token (64 at least), whether the number of tokens in it is odd. Two sets differ in at least
    as many tokens as their sketches differ in bins."""
    bins = max(64, 1 << (2 * len(tokens)).bit_length())
    odd = np.bincount((tokens & np.uint64(bins - 1)).astype(np.int64), minlength=bins) & 1
    return np.packbits(odd.astype(bool)).tobytes()


def least_apart(a: np.ndarray, b: np.ndarray) -> int:
    """A number of tokens by which two sets differ at least, from their sketches; the longer one is folded."""
    while len(a) != len(b):
        a, b = (a, b) if len(a) > len(b) else (b, a)
        a = a[: len(a) // 2] ^ a[len(a) // 2 :]
    return int(np.bitwise_count(a ^ b).sum())


def promising(pairs: DataFrame, sets: DataFrame, reach: float) -> DataFrame:
    """The pairs but those whose sketches alone put them further apart than ``reach``. A stored table.

    A sketch is at most half a byte a token, so that most pairs are decided without shuffling their texts.
    """
    sketches = sets.where("n > 0").groupBy("node").agg(F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    grouped = beside_pivots(pairs).join(sketches, "node").select("a", "share", "role", "node", "n", "sketch")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivot, held, size = None, None, 0
        for batch in batches:
            out = []
            for a, share, role, node, n, bins in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                own = np.frombuffer(bins, np.uint8)
                if role == 0:
                    pivot, held, size = (a, share), own, n
                    continue
                assert pivot == (a, share)
                if least_apart(held, own) * (2 - reach) <= (size + n) * reach:
                    out.append((a, node))
            if out:
                columns = [pa.array(x, pa.int64()) for x in zip(*out, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["a", "b"])

    found = map_texts(grouped_by_pivot(grouped), work, "a long, b long")
    return written(pairs.sparkSession, found, "pairs")


def compared(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """For pairs of a pivot ``a`` and a member ``b``, from their texts: the member's size, whether they
    link, their distance, and the tokens in only one of the sets, unless they are far apart. A stored table.

    A group of a pivot's members streams past the pivot's set.
    """
    spark = docs.sparkSession
    wanted = beside_pivots(pairs).join(nodes.select("node", "named.id", "named.key"), "node")
    bits = spark.sparkContext.broadcast(bitmap(wanted.select("key")))

    def needed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()  # equal rows of a task are one
        for batch in batches:
            batch = batch.filter(pa.array(in_bitmap(bits.value, batch.column(1).to_numpy())))
            names = list(zip(*(batch.column(k).to_pylist() for k in range(2)), strict=True))
            new = [not (x in seen or seen.add(x)) for x in names]
            yield batch.filter(pa.array(new, pa.bool_()))

    docs = map_texts(docs, needed, docs.schema)
    # Equal rows of different tasks follow each other, and all but the first are passed over.
    same = wanted["id"].eqNullSafe(docs["id"]) & (wanted["key"] == docs["key"])
    grouped = grouped_by_pivot(wanted.join(docs, same).select("a", "share", "role", "node", "text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivot, held, last = None, None, None
        for batch in sliced(batches, "text", SET_BYTES):
            sets = shingle_sets(words(text_of(batch, "text"), NOT_SPACE), width)
            rows = batch.select(["a", "share", "role", "node"]).to_pydict()
            out = []
            for a, share, role, node, own in zip(*rows.values(), sets, strict=True):
                if (a, share, role, node) == last:
                    continue
                last = a, share, role, node
                if role == 0:
                    pivot, held = (a, share), own
                    continue
                assert pivot == (a, share)
                apart = np.setxor1d(held, own, assume_unique=True)
                size = len(held) + len(own)
                link = len(apart) * (den + num) <= size * (den - num)
                distance = 2 * len(apart) / (size + len(apart))
                out.append((a, node, len(own), link, distance, apart.tobytes() if distance <= FAR else None))
            if out:
                columns = [pa.array(x, kind) for x, kind in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "n", "link", "d", "apart"])

    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.float64(), pa.binary())
    found = map_texts(grouped, work, "a long, b long, n long, link boolean, d double, apart binary")
    return written(spark, found, "compared", bits)


def blocks_of(rows: DataFrame, size: int, name: str) -> DataFrame:
    """``(a, name)``: in how many blocks the rows of each pivot are dealt out.

    Grouped by a struct, so that a join by ``a`` shuffles both sides for itself and AQE may split a pivot with
    very many members there.
    """
    many = rows.groupBy(F.struct("a").alias("of")).agg(F.ceil(F.count(F.lit(1)) / size).alias(name))
    return many.select(F.col("of.a").alias("a"), name)


def blocked(outside: DataFrame, members: DataFrame) -> DataFrame:
    """Rows of both sides under ``(a, i, j)``: the i-th block outside meets the j-th of all."""
    sizes = blocks_of(members, BLOCK_ALL, "alls").join(blocks_of(outside, BLOCK_OUT, "outs"), "a")
    sides = []
    for rows, role, own, other, (mine, theirs) in (
        (outside, 0, "outs", "alls", "ij"),
        (members, 1, "alls", "outs", "ji"),
    ):
        rows = rows.join(sizes, "a").withColumn(mine, F.pmod(F.xxhash64("b"), F.col(own)))
        rows = rows.withColumn(theirs, F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1)))
        sides.append(rows.select("a", "i", "j", F.lit(role).alias("role"), "b", "label", "n", "apart"))
    return sides[0].unionByName(sides[1])


def further_links(checked: DataFrame, labels: DataFrame, num: int, den: int) -> DataFrame:
    """Links between members of one pivot that are in different components so far."""
    near = checked.where("apart is not null")
    members = near.join(labels.withColumnRenamed("node", "b"), "b", "left")
    members = members.withColumn("label", F.coalesce("label", "b"))
    home = labels.select(F.col("node").alias("a"), F.col("label").alias("home"))
    members = members.join(home, "a", "left").withColumn("home", F.coalesce("home", "a"))
    outside = members.where("label != home")
    grouped = blocked(outside, members.join(outside.select("a").distinct(), "a"))
    grouped = grouped.repartition("a", "i", "j").sortWithinPartitions("a", "i", "j", "role")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, left = None, None
        for batch in sliced(batches, "apart", 8 << 20):
            group = np.column_stack([batch.column(k).to_numpy() for k in range(3)])
            edges = np.flatnonzero(np.any(group[1:] != group[:-1], axis=1)) + 1
            for start, stop in itertools.pairwise([0, *edges.tolist(), len(group)]):
                part = Block.of(batch.slice(start, stop - start))
                if tuple(group[start]) != at:
                    at, left = tuple(group[start]), []
                out, every = part.side(0), part.side(1)
                if len(out.node):
                    left.append(out)
                if left and len(every.node):
                    left = [Block.joined(left)]
                    yield left[0].links(every, num, den)

    return map_texts(grouped, work, "a long, b long")


def far_pairs(buckets: DataFrame, checked: DataFrame, labels: DataFrame, sizes: DataFrame, num: int, den: int):
    """Pairs of bucket members that may still link, at least one of them far from the pivot."""
    reach = 1 - num / den + 1e-9
    known = checked.select("a", F.col("b").alias("node"), "d").distinct()
    # A member that was not compared is far: by its size, or by its sketch.
    member = buckets.where("a != node").join(known, ["a", "node"], "left")
    member = member.where(F.coalesce(F.col("d") >= FAR - reach, F.lit(True))).join(sizes, "node")
    member = member.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    far = member.where(F.coalesce(F.col("d") > FAR, F.lit(True)))
    left = far.select("s", *(F.col(c).alias(f"{c}_a") for c in ("node", "label", "n", "d")))
    right = member.select("s", *(F.col(c).alias(f"{c}_b") for c in ("node", "label", "n", "d")))
    close = F.coalesce(F.abs(F.col("d_a") - F.col("d_b")) <= reach, F.lit(True))
    fits = F.least("n_a", "n_b") * den >= F.greatest("n_a", "n_b") * num
    pair = F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")
    met = left.join(right, "s").where((F.col("label_a") != F.col("label_b")) & fits & close)
    return met.select(*pair).distinct()


class Block:
    """Members of one pivot: their nodes, labels, sizes and differences from the pivot."""

    def __init__(self, role, node, label, n, size, tokens) -> None:
        self.role, self.node, self.label, self.n, self.size, self.tokens = role, node, label, n, size, tokens

    @classmethod
    def of(cls, batch: pa.RecordBatch) -> Block:
        role, node, label, n = (batch.column(k).to_numpy() for k in range(3, 7))
        data, offsets = flat(batch.column(7))
        return cls(role, node, label, n, np.diff(offsets) // 8, np.frombuffer(data.tobytes(), np.uint64))

    def side(self, role: int) -> Block:
        own = self.role == role
        fields = (x[own] for x in (self.role, self.node, self.label, self.n, self.size))
        return Block(*fields, self.tokens[np.repeat(own, self.size)])

    @classmethod
    def joined(cls, blocks: list[Block]) -> Block:
        names = ("role", "node", "label", "n", "size", "tokens")
        return blocks[0] if len(blocks) == 1 else cls(*(np.concatenate([getattr(b, x) for b in blocks]) for x in names))

    def links(self, other: Block, num: int, den: int) -> pa.RecordBatch:
        """Linked pairs of this block's and the other's members with different labels."""
        order = np.argsort(self.tokens, kind="stable")
        tokens, owner = self.tokens[order], np.repeat(np.arange(len(self.node)), self.size)[order]
        low, high = (np.searchsorted(tokens, other.tokens, side) for side in ("left", "right"))
        of = np.repeat(np.arange(len(other.node)), other.size)
        pairs = []
        begin = np.concatenate(([0], np.cumsum(other.size)))
        for a in range(0, len(other.node), 256):
            b = min(a + 256, len(other.node))
            span = slice(begin[a], begin[b])
            times = (high - low)[span]
            rank = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            mine = owner[np.repeat(low[span], times) + rank]
            key = mine * (b - a) + np.repeat(of[span] - a, times)
            both = np.bincount(key, minlength=len(self.node) * (b - a)).reshape(len(self.node), b - a)
            apart = self.size[:, None] + other.size[None, a:b] - 2 * both
            near = apart * (den + num) <= (self.n[:, None] + other.n[None, a:b]) * (den - num)
            x, y = np.nonzero(near & (self.label[:, None] != other.label[None, a:b]))
            pairs.append((self.node[x], other.node[a:b][y]))
        x, y = (np.concatenate(side) for side in zip(*pairs, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], names=["a", "b"])


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """``(node, label)`` of every node on an edge: the smallest node of its component.

    Alternates the large-star and small-star steps, whose work per round is one pass over the
    edges, until a round changes nothing. Each round is a written table.
    """
    edges = edges.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).where("u < v")
    edges = written(spark, edges.distinct(), "links")
    before = None
    for _ in itertools.count():
        both = edges.union(edges.select(F.col("u"), F.col("v"))).toDF("x", "y")
        least = both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m"))
        large = both.join(least, "x").where("y > x").select(F.col("y").alias("v"), F.col("m").alias("u"))
        large = large.where("u < v").distinct()
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(least, "v")
        small = small.select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
        small = small.select("e.v", F.col("e.m").alias("u")).where("u < v").distinct()
        edges = written(spark, small, "links")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = edges.select(F.col("u").alias("node"), F.col("u").alias("label")).distinct()
    return edges.select(F.col("v").alias("node"), F.col("u").alias("label")).union(roots)


def labelled_nodes(docs: DataFrame, width: int, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """The table of sets, and ``(node, named, label)``: each set's first document and component."""
    spark = docs.sparkSession
    table, counts = set_table(docs, width, num, den)
    sets = written(spark, table, "sets", counts)
    some = F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "key")).alias("named")
    nodes = sets.where("n > 0").groupBy("node").agg(some, F.first("n").alias("n"))
    sizes = nodes.select("node", "n")
    index, bits = shared_signatures(sets)
    most = F.max(F.struct("weight", "node"))["node"].alias("a")
    pivots = index.groupBy("s").agg(most, F.min("node").alias("first"), F.max("node").alias("last"))
    pivots = pivots.where("first < last").select("s", "a")
    buckets = written(spark, index.join(pivots, "s").select("s", "a", "node").distinct(), "buckets", bits)
    pairs = buckets.where("a != node").select("a", F.col("node").alias("b")).distinct()
    for side in ("a", "b"):
        pairs = pairs.join(sizes.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}")), side)
    alike = F.least("n_a", "n_b") >= F.greatest("n_a", "n_b") * (1 - FAR)
    pairs = written(spark, pairs.where(alike).select("a", "b"), "pairs")
    pairs = promising(pairs, sets, FAR)
    checked = compared(pairs, nodes, docs, width, num, den)
    links = checked.where("link").select("a", "b")
    labels = components(spark, links)
    more = written(spark, further_links(checked, labels, num, den), "links")
    rest = written(spark, far_pairs(buckets, checked, labels, sizes, num, den), "pairs")
    if not rest.isEmpty():
        rest = promising(rest, sets, 1 - num / den + 1e-9)
    if not rest.isEmpty():
        late = compared(rest, nodes, docs, width, num, den).where("link").select("a", "b")
        more = more.union(written(spark, late, "links"))
    if not more.isEmpty():
        labels = components(spark, links.union(more))
    return sets, nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def similarity_components(
    docs: DataFrame,
    width: int = 5,
    num: int = 80,
    den: int = 100,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per document: its id, the size of its set and the smallest id of its component."""
    name = docs.select(id_col).columns[0]
    sets, named = labelled_nodes(own_columns(docs, id_col, text_col), width, num, den)
    least = named.groupBy("label").agg(F.min("named.id").alias("component_id"))
    named = named.join(least, "label").select("node", "component_id")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    return sets.join(named, "node", "left").select(
        F.col("id").alias(name), F.col("n").alias("n_shingles"), component.alias("component_id")
    )


def keep_one(
    docs: DataFrame,
    width: int = 5,
    num: int = 80,
    den: int = 100,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One document of each component, with all columns: that of the smallest id (null last, then by
    the hash of its text). Of rows with that id and text, any one. Texts without words all stay."""
    _, named = labelled_nodes(own_columns(docs, id_col, text_col), width, num, den)
    first = named.groupBy("label").agg(F.min("named").alias("named"))
    first = first.select(F.col("named.id").alias("__id"), F.col("named.key").alias("__first"))
    worded = F.coalesce(F.col(text_col), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    key = fresh(docs, "key")
    marked = docs.withColumn(key, F.xxhash64(text_col))
    same = marked[id_col].eqNullSafe(first["__id"]) & (marked[key] == first["__first"])
    kept = marked.where(worded).join(first, same, "left_semi").dropDuplicates([id_col, key])
    return kept.unionByName(marked.where(~worded)).select(*docs.columns)
