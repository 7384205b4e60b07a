"""Similarity join of texts by the Jaccard overlap of their word n-grams.

Exact, in these steps. Texts of equal sets are one class. A class is indexed under the first n-grams of its set in one
global order, rare ones first: two sets that are similar enough share one of them. The classes that meet under n-grams of
one smallest class, sorted by set size, are cut into blocks; a tile is a pair of blocks whose sizes may still match. In a tile, bitmaps of hashed n-grams
bound the overlap from above, and only pairs that the bound admits reach the exact intersection of sorted arrays.

A group of many copies with small changes shares most of its index entries, so before any tile its members are
compared with a few of them: first every member with one, then with the others those that are not connected yet. Tiles look
only at pairs whose classes are still unconnected.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyline.llm import worker
from tallyline.llm.components import components
from tallyline.llm.text import WordHasher, byte_slices, list_array, mix, shingles, utf8
from tallyline.session import materialize, numbered, recorded_dirs
from tallyline.sources import files

SLICE_BYTES = 1 << 20
#: Counters of the frequency table that orders n-grams. It is broadcast as one byte each, whatever the input.
COUNTERS = 1 << 18
COUNTER_BLOCK = 1 << 12
#: 64-bit words of a bitmap: at least four bits per member, a power of two between these.
LEAST_WORDS, MOST_WORDS = 8, 256
BLOCK = 1024
#: Bits of the hashed table that says which texts' sets are wanted; others may pass by chance and do no harm.
WANTED_BITS = 1 << 23
STARS = 3


def overlap_needed(a: np.ndarray | int, b: np.ndarray | int, percent: int) -> np.ndarray:
    """Least intersection of sets of these sizes with 100 * intersection >= percent * union."""
    return -(-percent * (np.asarray(a) + b) // (100 + percent))


def prefix_length(size: np.ndarray, percent: int) -> np.ndarray:
    """How many of its n-grams a set is indexed under: it misses at most size - ceil(percent% of size) of a partner's."""
    return size - -(-percent * size // 100) + 1


def _sets(hasher: WordHasher, part: pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray]:
    offsets, data = utf8(part.column("text"))
    words, _, rows = hasher.words(offsets, data)
    return shingles(words, rows, width)


def _class_rows(width: int):
    """Set size, bitmap and a 128-bit digest of the set for each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker.release()
        hasher = WordHasher()
        for batch in batches:
            for part in byte_slices(batch, "text", SLICE_BYTES):
                values, bounds = _sets(hasher, part, width)
                sums = []
                with np.errstate(over="ignore"):
                    for salt in (0x51, 0xA7):
                        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(values + np.uint64(salt)))])
                        sums.append((total[bounds[1:]] - total[bounds[:-1]]).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), part.column("doc"), pa.array(np.diff(bounds), pa.int32()),
                     pa.array(sums[0]), pa.array(sums[1]),
                     pa.array([bitmap(values[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary())],
                    names=["row", "doc", "size", "c1", "c2", "bits"])

    return run


def _counts(width: int, counters: int):
    """A partition's counts of hashed n-grams, in blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker.release()
        hasher, total = WordHasher(), np.zeros(counters, np.int64)
        for batch in batches:
            for part in byte_slices(batch, "text", SLICE_BYTES):
                values, _ = _sets(hasher, part, width)
                total += np.bincount((values % np.uint64(counters)).astype(np.int64), minlength=counters)
        blocks = total.reshape(-1, COUNTER_BLOCK)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(blocks)), pa.int32()), pa.array([b.astype(np.int64).tobytes() for b in blocks], pa.binary())],
            names=["block", "counts"])

    return run


def _sum_blocks(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(COUNTER_BLOCK, np.int64)
    for batch in batches:
        for counts in batch.column("counts"):
            total += np.frombuffer(counts.as_py(), np.int64)
    yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())],
                                     names=["block", "counts"])


def frequency_classes(texts: DataFrame, width: int, counters: int) -> np.ndarray:
    """For each counter, a byte that grows with the logarithm of its count over all texts."""
    counted = texts.select("text").mapInArrow(_counts(width, counters), "block int, counts binary")
    salted = counted.withColumn("salt", F.spark_partition_id() % 64)
    partial = salted.groupBy("block", "salt").applyInArrow(_sum_blocks, "block int, counts binary")
    blocks = partial.groupBy("block").applyInArrow(_sum_blocks, "block int, counts binary").toPandas()
    total = np.zeros(counters, np.int64)
    for block, counts in zip(blocks["block"], blocks["counts"], strict=True):
        total[block * COUNTER_BLOCK:(block + 1) * COUNTER_BLOCK] = np.frombuffer(counts, np.int64)
    return np.minimum(16 * np.log2(total + 1), 255).astype(np.uint8)


def _index_rows(width: int, percent: int, classes):
    """The index entries of each text: the first of its n-grams in the global order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker.release()
        hasher, frequency = WordHasher(), classes.value
        for batch in batches:
            for part in byte_slices(batch, "text", SLICE_BYTES):
                values, bounds = _sets(hasher, part, width)
                rank = frequency[(values % np.uint64(len(frequency))).astype(np.int64)].astype(np.uint64)
                # Order by frequency class, then by 56 bits of the hash; n-grams of equal order share their entries.
                order = (rank << np.uint64(56)) | (mix(values) >> np.uint64(8))
                first = [order[:0]]
                for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                    n, own = int(prefix_length(b - a, percent)), order[a:b]
                    first.append(np.unique(np.partition(own, n - 1)[:n] if n < len(own) else own))
                ends = np.cumsum([len(f) for f in first])
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), list_array(np.concatenate(first).view(np.int64), ends, pa.int64())],
                    names=["row", "grams"])

    return run


def _place(doc: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix(doc.astype(np.uint64) + np.uint64(11)) % np.uint64(WANTED_BITS)).astype(np.int64)


def _wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A partition's table of wanted texts, one bit per hashed key, in blocks that are not empty."""
    table = np.zeros(WANTED_BITS, bool)
    for batch in batches:
        table[_place(batch.column("doc").to_numpy())] = True
    blocks = np.packbits(table, bitorder="little").reshape(-1, COUNTER_BLOCK)
    full = np.flatnonzero(blocks.any(axis=1))
    yield pa.RecordBatch.from_arrays(
        [pa.array(full, pa.int32()), pa.array([blocks[i].tobytes() for i in full], pa.binary())], names=["block", "bits"])


def _or_blocks(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(COUNTER_BLOCK, np.uint8)
    for batch in batches:
        for bits in batch.column("bits"):
            total |= np.frombuffer(bits.as_py(), np.uint8)
    yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())],
                                     names=["block", "bits"])


def wanted_table(docs: DataFrame) -> np.ndarray:
    """Which hashed keys `docs` (doc) has: a table of WANTED_BITS, however many there are."""
    blocks = docs.mapInArrow(_wanted, "block int, bits binary").withColumn("salt", F.spark_partition_id() % 64)
    for keys in (["block", "salt"], ["block"]):
        blocks = blocks.groupBy(*keys).applyInArrow(_or_blocks, "block int, bits binary")
        if len(keys) == 2:
            blocks = blocks.select("block", "bits")
    table = np.zeros((WANTED_BITS // 8 // COUNTER_BLOCK, COUNTER_BLOCK), np.uint8)
    found = blocks.toPandas()
    for block, bits in zip(found["block"], found["bits"], strict=True):
        table[block] = np.frombuffer(bits, np.uint8)
    return table.ravel()


def _set_rows(width: int, wanted):
    """The sorted set of each wanted text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker.release()
        hasher, table = WordHasher(), np.unpackbits(wanted.value, bitorder="little").astype(bool)
        for batch in batches:
            batch = batch.filter(pa.array(table[_place(batch.column("doc").to_numpy())]))
            for part in byte_slices(batch, "text", SLICE_BYTES):
                values, bounds = _sets(hasher, part, width)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc"), list_array(values.view(np.int64), bounds, pa.int64())], names=["doc", "grams"])

    return run


def bitmap(values: np.ndarray) -> bytes:
    words = min(max(LEAST_WORDS, 1 << max(len(values) // 16 - 1, 0).bit_length()), MOST_WORDS)
    bits = np.zeros(words * 64, bool)
    with np.errstate(over="ignore"):
        bits[(mix(values + np.uint64(1)) % np.uint64(words * 64)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def fold(bitmaps: list[bytes]) -> np.ndarray:
    """Bitmaps of several lengths as one matrix: longer ones are folded onto the shortest length."""
    lengths = np.array([len(b) for b in bitmaps])
    words = int(lengths.min()) // 8
    out = np.empty((len(bitmaps), words), np.uint64)
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        block = np.frombuffer(b"".join(bitmaps[i] for i in at), np.uint64).reshape(len(at), -1, words)
        out[at] = np.bitwise_or.reduce(block, axis=1)
    return out


def bound_overlap(size_a: np.ndarray, bits_a: np.ndarray, size_b: np.ndarray, bits_b: np.ndarray) -> np.ndarray:
    """Upper bound of the intersection: a bit that only one bitmap has stands for a member the other set lacks."""
    both = np.bitwise_count(bits_a & bits_b).sum(-1, dtype=np.int64)
    own_a = np.bitwise_count(bits_a).sum(-1, dtype=np.int64)
    own_b = np.bitwise_count(bits_b).sum(-1, dtype=np.int64)
    return np.minimum(size_a - (own_a - both), size_b - (own_b - both))


def _tile(percent: int):
    """Pairs of a tile that are not connected yet and that the bitmaps admit."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        side, doc, size = (table.column(c).to_numpy() for c in ("side", "doc", "size"))
        group, bits = table.column("component").to_numpy(), table.column("bits").to_pylist()
        length = np.array([len(b) for b in bits])
        # A pair is compared at the length of its shorter bitmap: one length for the whole tile would fill up the large sets' bits.
        levels, place = {}, {}
        for short in np.unique(length).tolist():
            at = np.flatnonzero(length >= short)
            levels[short] = fold([bits[i] for i in at])
            place[short] = np.full(len(bits), -1)
            place[short][at] = np.arange(len(at))
        left = np.flatnonzero(side == 0)
        alone = key[1].as_py() == key[2].as_py()
        right = left if alone else np.flatnonzero(side == 1)
        us, vs = [], []
        for i in left:
            fits = 100 * np.minimum(size[right], size[i]).astype(np.int64) >= percent * np.maximum(size[right], size[i]).astype(np.int64)
            near = right[fits & (group[right] != group[i]) & ((right > i) | (not alone))]
            shorter = np.minimum(length[near], length[i])
            for short in np.unique(shorter).tolist():
                at, matrix, where = near[shorter == short], levels[short], place[short]
                most = bound_overlap(size[i], matrix[where[i]], size[at], matrix[where[at]])
                at = at[most >= overlap_needed(size[i], size[at], percent)]
                us.append(np.full(len(at), doc[i]))
                vs.append(doc[at])
        u, v = (np.concatenate([np.empty(0, np.int64), *x]) for x in (us, vs))
        return pa.table({"u": pa.array(np.minimum(u, v), pa.int64()), "v": pa.array(np.maximum(u, v), pa.int64())})

    return run


def _admit(percent: int):
    """The pairs that the bitmaps admit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sizes = [batch.column(f"size_{c}").to_numpy().astype(np.int64) for c in "uv"]
            bits = [batch.column(f"bits_{c}").to_pylist() for c in "uv"]
            shortest = np.array([min(len(a), len(b)) for a, b in zip(*bits, strict=True)])
            keep = np.zeros(batch.num_rows, bool)
            for length in np.unique(shortest):
                at = np.flatnonzero(shortest == length)
                both = fold([bits[0][i] for i in at] + [bits[1][i] for i in at])
                most = bound_overlap(sizes[0][at], both[:len(at)], sizes[1][at], both[len(at):])
                keep[at] = most >= overlap_needed(sizes[0][at], sizes[1][at], percent)
            yield batch.select(["u", "v"]).filter(pa.array(keep))

    return run


def _verify(percent: int):
    """The pairs whose sets are similar enough, by merging their sorted arrays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column("grams_u"), batch.column("grams_v")
            keep = []
            for i in range(batch.num_rows):
                x, y = a[i].values.to_numpy(), b[i].values.to_numpy()
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return run


def _shared(entries: DataFrame) -> DataFrame:
    """The entries whose gram another one has, with n: how many have it."""
    return entries.withColumn("n", F.count("*").over(Window.partitionBy("gram"))).where("n > 1")


def _with(pairs: DataFrame, table: DataFrame, columns: list[str]) -> DataFrame:
    """`columns` of both ends of each pair."""
    for end in "vu":
        side = table.select(F.col("doc").alias(end), *[F.col(c).alias(f"{c}_{end}") for c in columns])
        pairs = pairs.join(side, end)
    return pairs


def one_partner(pairs: DataFrame) -> DataFrame:
    """For each end of `pairs` (u, v) one pair, with the partner of the smallest hash: copies of one text mostly have one such
    partner, so as many sets are compared as there are texts, and not as there are pairs."""
    both = pairs.union(pairs.select("v", "u")).toDF("doc", "other")
    best = both.groupBy("doc").agg(F.min(F.struct(F.xxhash64("other").alias("h"), "other"))["other"].alias("other"))
    return best.select(F.least("doc", "other").alias("u"), F.greatest("doc", "other").alias("v")).distinct()


def unconnected(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """The pairs whose ends are in different components; a node that `known` (node, component) lacks is its own."""
    for end in ("u", "v"):
        side = known.select(F.col("node").alias(end), F.col("component").alias(f"of_{end}"))
        pairs = pairs.join(side, end, "left")
    return pairs.where(F.coalesce("of_u", "u") != F.coalesce("of_v", "v")).select("u", "v")


class NgramJoin:
    """The join over one `numbered` table of texts. Only narrow rows are shuffled: the texts are read once more for each
    step, always from that table, so that a row has one number and one text in all of them."""

    def __init__(self, documents: DataFrame, key: str, text: str, width: int, percent: int, counters: int):
        self.width, self.percent, self.counters = width, percent, counters
        self.spark = documents.sparkSession
        self.texts = documents.select(F.col("_row").alias("row"), F.col(key).cast("long").alias("doc"),
                                      F.coalesce(F.col(text), F.lit("")).alias("text"))
        self.rows = materialize(self.texts.mapInArrow(
            _class_rows(width), "row long, doc long, size int, c1 long, c2 long, bits binary"), "ngram-rows")
        first = F.min(F.struct("doc", "row"))
        self.classes = materialize(
            self.rows.where("size > 0 and doc is not null").groupBy("c1", "c2").agg(first.alias("first"))
            .select("c1", "c2", F.col("first.doc").alias("rep"), F.col("first.row").alias("row")), "ngram-classes")

    def entries(self) -> DataFrame:
        """(gram, doc, n) for index entries that at least two classes share; n: how many share it."""
        order = self.spark.sparkContext.broadcast(frequency_classes(self.texts, self.width, self.counters))
        texts = self.texts.where("doc is not null").select("row", "text")
        index = texts.mapInArrow(_index_rows(self.width, self.percent, order), "row long, grams array<long>")
        # Most n-grams stand in one text: only what texts share is looked up in the classes, then counted by class.
        shared = _shared(index.select(F.explode("grams").alias("gram"), "row")).drop("n")
        classes = self.classes.select("row", F.col("rep").alias("doc"))
        return materialize(_shared(shared.join(classes, "row").select("gram", "doc")), "ngram-entries")

    def signatures(self, *keys: str) -> DataFrame:
        """(doc, size, bits) of the texts, one row for each set of a doc, dealt by `keys` for a join on them: the bitmaps are
        shuffled once."""
        return (self.rows.where("size > 0 and doc is not null").select("doc", "size", "bits", "c1", "c2").repartition(*keys)
                .dropDuplicates([*dict.fromkeys([*keys, "doc", "c1", "c2"])]).select("doc", "size", "bits"))

    def verified(self, pairs: DataFrame) -> DataFrame:
        """The pairs that are similar enough. Sets are made of those texts only that a pair asks for, and removed once the
        links are written."""
        spark = self.spark
        with recorded_dirs() as made:
            pairs = materialize(pairs, "ngram-pairs")
            sets = self.sets(pairs)
        joined = _with(pairs, sets, ["grams"]).select("u", "v", "grams_u", "grams_v")
        links = materialize(joined.mapInArrow(_verify(self.percent), "u long, v long").distinct(), "ngram-links")
        for path in made:
            files.remove(spark, path)
        return links

    def sets(self, pairs: DataFrame) -> DataFrame:
        """(doc, grams): the sorted sets of the texts in `pairs`, and of a few others."""
        ends = pairs.select(F.col("u").alias("doc")).union(pairs.select("v"))
        wanted = self.spark.sparkContext.broadcast(wanted_table(ends))
        texts = self.texts.where("doc is not null").select("doc", "text")
        return materialize(texts.mapInArrow(_set_rows(self.width, wanted), "doc long, grams array<long>"), "ngram-sets")

    def stars(self, entries: DataFrame) -> DataFrame:
        """Admitted pairs of each member of an entry with a few of them, picked by hash. The hashes may pick one member more
        than once, so an entry of at most STARS + 1 members has all but one of them as centres, which gives every pair."""
        orders = [F.struct(F.xxhash64(F.lit(i), "doc"), F.col("doc")) for i in range(STARS)]
        few = F.col("n") <= STARS + 1
        large = (entries.where(~few).groupBy("gram").agg(*[F.min(o).alias(f"c{i}") for i, o in enumerate(orders)])
                 .select("gram", F.array_distinct(F.array(*[f"c{i}.doc" for i in range(STARS)])).alias("centres")))
        small = (entries.where(few).groupBy("gram").agg(F.sort_array(F.collect_list("doc")).alias("docs"))
                 .select("gram", F.slice("docs", 1, STARS).alias("centres")))
        centres = large.union(small).select("gram", F.explode("centres").alias("centre"))
        pairs = (entries.join(centres, "gram").where("doc != centre")
                 .select(F.least("doc", "centre").alias("u"), F.greatest("doc", "centre").alias("v")).distinct())
        fits = F.least("size_u", "size_v") * 100 >= F.greatest("size_u", "size_v") * self.percent
        signatures = self.signatures("doc")
        sized = _with(_with(pairs, signatures, ["size"]).where(fits), signatures, ["bits"])
        return sized.select("u", "v", "size_u", "size_v", "bits_u", "bits_v").mapInArrow(
            _admit(self.percent), "u long, v long").distinct()

    def still_open(self, entries: DataFrame, links: DataFrame) -> DataFrame:
        """(hub, doc, component): the members of entries that `links` do not connect. In an entry of few members the stars
        have compared every pair.

        Similar sets share many entries, mostly with the same smallest member: entries of one smallest member, their
        hub, become one, so that a pair meets in a few tiles and not under every n-gram that it shares.
        """
        named = (entries.where(F.col("n") > STARS + 1).join(components(links).withColumnRenamed("node", "doc"), "doc", "left")
                 .select("gram", "doc", F.coalesce("component", "doc").alias("component")))
        split = named.groupBy("gram").agg(
            F.min("component").alias("a"), F.max("component").alias("b"), F.min("doc").alias("hub")).where("a != b")
        return materialize(named.join(split.select("gram", "hub"), "gram").select("hub", "doc", "component").distinct(),
                           "ngram-open")

    def tiles(self, entries: DataFrame) -> DataFrame:
        """Pairs from all tiles. A member goes to the tiles of its block with every block whose sizes may match; it gets its
        bitmap once its tiles are known."""
        rows = entries.join(self.signatures("doc").select("doc", "size"), "doc")
        place = F.row_number().over(Window.partitionBy("hub").orderBy("size", "doc"))
        placed = materialize(rows.withColumn("block", F.floor((place - 1) / BLOCK).cast("int")), "ngram-placed")
        spans = placed.groupBy("hub", "block").agg(F.min("size").alias("low"), F.max("size").alias("high"))
        a, b = spans.alias("a"), spans.alias("b")
        near = (F.col("a.hub") == F.col("b.hub")) & (F.col("a.block") <= F.col("b.block")) & (
            F.col("b.low") * self.percent <= F.col("a.high") * 100)
        pairs = a.join(b, near).select(F.col("a.hub").alias("hub"), F.col("a.block").alias("i"), F.col("b.block").alias("j"))
        ends = pairs.select("hub", "i", "j", F.col("i").alias("block"), F.lit(0).alias("side")).union(
            pairs.where("i != j").select("hub", "i", "j", F.col("j").alias("block"), F.lit(1).alias("side")))
        dealt = (placed.join(ends, ["hub", "block"]).join(self.signatures("doc", "size"), ["doc", "size"])
                 .select("hub", "i", "j", "side", "doc", "size", "component", "bits"))
        return dealt.groupBy("hub", "i", "j").applyInArrow(_tile(self.percent), "u long, v long").distinct()

    def links(self) -> DataFrame:
        """Links that connect what all links connect. The tables they come from are removed once they are written."""
        with recorded_dirs() as made:
            entries = self.entries()
            pairs = materialize(self.stars(entries), "ngram-stars")
            near = self.verified(one_partner(pairs))
            links = near.union(self.verified(unconnected(pairs, components(near))))
            left = self.still_open(entries, links)
            whole = materialize(links.union(self.verified(self.tiles(left))).distinct(), "ngram-all-links")
        for path in made[:-1]:
            files.remove(self.spark, path)
        return whole

    def members(self) -> DataFrame:
        """(row, doc, size, component_id) of every row; its own key without a set, null without a key."""
        merged = (self.classes.join(components(self.links()), F.col("rep") == F.col("node"), "left")
                  .select("c1", "c2", F.coalesce("component", "rep").alias("component")))
        linked = F.when(F.col("size") > 0, F.col("component")).otherwise(F.col("doc"))
        return self.rows.join(merged, ["c1", "c2"], "left").select(
            "row", "doc", "size", F.when(F.col("doc").isNotNull(), linked).alias("component_id"))


def ngram_components(documents: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80,
                     counters: int = COUNTERS) -> DataFrame:
    """(`key`, n_shingles, component_id) of every row; component_id: the smallest key that links reach.

    Words are runs of bytes other than white space (tab to carriage return, space), A-Z lower-cased; a text's set has its
    distinct `width`-word shingles as 64-bit hashes, with fewer words the whole sequence as one. Two rows link when
    100 * intersection >= `percent` * union. A null, empty or wordless text has an empty set and is linked with nothing.
    Rows of equal sets are linked whatever their keys; rows with one key share its component. A row with a null key
    has a null component and links nothing. Other columns are left out.
    """
    own = numbered(documents.select(key, text), "ngram-texts")
    rows = NgramJoin(own, key, text, width, percent, counters).members()
    return rows.select(F.col("doc").alias(key), F.col("size").cast("long").alias("n_shingles"), "component_id")


def one_of_each_group(documents: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80,
                      counters: int = COUNTERS) -> DataFrame:
    """`documents` without the rows of a component of `ngram_components` other than one of its smallest key.

    Rows with an empty set or a null key all stay. Columns are kept as they are.
    """
    own = numbered(documents, "ngram-texts")
    rows = NgramJoin(own, key, text, width, percent, counters).members()
    grouped = rows.where("size > 0 and doc is not null")
    first = grouped.groupBy("component_id").agg(F.min(F.struct("doc", "row"))["row"].alias("first"))
    gone = grouped.join(first, "component_id").where("row != first").select(F.col("row").alias("_row"))
    return own.join(gone, "_row", "left_anti").select(*documents.columns)
