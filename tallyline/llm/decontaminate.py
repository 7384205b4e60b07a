"""Benchmark items in documents, also paraphrased, by latent semantic retrieval.

Passages of all documents are tf-idf rows over hashed words. A randomised decomposition of their matrix, summed up over
all passages in one distributed pass, gives a space of few dimensions. Windows of documents near a window of an item
there, and near it also in the plain random projection that the decomposition starts from, are candidates; the longest
common subsequence with the item, and for weaker ones the item's answer, decide. Places that share a run of words with an
item are judged whatever their vectors are, so that whole items, and those with a fifth of their words replaced, are not missed.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.text import NOT_LETTERS, WordHasher, byte_slices, utf8
from tallyline.session import materialize

SLICE_BYTES = 1 << 20
#: Hashed word dimensions and dimensions of the latent space: the size of what is broadcast, whatever the input.
DIMS, RANK, SKETCH = 1 << 15, 32, 64
DIM_BLOCK = 1 << 9
#: Rows counted at a time.
COUNTED_ROWS = 32
#: Words of a passage in the decomposition; words of a search window and its step; step of an item's windows.
PASSAGE, WINDOW, STEP, ITEM_STEP = 48, 24, 12, 4
#: Least cosine in the latent space, and in the random projection.
COSINE, PLAIN_COSINE = 0.3, 0.5
#: Items of one block: each block is broadcast, and searched against all documents, on its own.
BLOCK_ITEMS, BLOCK_BYTES = 2048, 4 << 20
#: Words of a run that documents are looked up by; an item of fewer words is one run. Bits of the table that is asked first.
RUN, RUN_BITS = 3, 20
#: Distances between the words of a looked-up run in a document: next to each other, or a foreign word after each.
GAPS = (1, 2)
#: Times an item's length within which its words must stand.
STRETCH = 2


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of each text as 32-bit hashes, in order."""
    hasher = WordHasher(NOT_LETTERS)
    for batch in batches:
        for part in byte_slices(batch, "text", SLICE_BYTES):
            words, rows = hash_words(hasher, part.column("text"))
            cut = [words[a:b].tobytes() for a, b in zip(rows[:-1], rows[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(cut, pa.binary())], names=["key", "words"])


def hash_words(hasher: WordHasher, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    words, _, rows = hasher.words(*utf8(pc.utf8_lower(column)))
    return (words >> np.uint64(32)).astype(np.uint32), rows


def _flat(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """All words of a batch and where each row's begin."""
    offsets, data = utf8(part.column("words"))
    return np.frombuffer(data.tobytes(), np.uint32), offsets // 4


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many rows of a partition each dimension occurs; dimension -1 counts the rows with words."""
    total, rows_seen = np.zeros(DIMS, np.int64), 0
    last = np.zeros(COUNTED_ROWS * DIMS, np.int32)
    for batch in batches:
        words, rows = _flat(batch)
        dims = (words % DIMS).astype(np.int64)
        rows_seen += int((np.diff(rows) > 0).sum())
        for low in range(0, batch.num_rows, COUNTED_ROWS):
            own = rows[low:low + COUNTED_ROWS + 1]
            part = dims[own[0]:own[-1]]
            at = np.arange(len(part), dtype=np.int32)
            place = np.repeat(np.arange(len(own) - 1) * DIMS, np.diff(own)) + part
            # Of equal places the last one written stays, so each row counts a dimension once.
            last[place] = at
            total += np.bincount(part[last[place] == at], minlength=DIMS)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(total[at], rows_seen), pa.int64())],
        names=["dim", "n"])


def cut_rows(rows: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of consecutive blocks of `width` words in every row (the last one shorter), and the row of each."""
    blocks = -(-np.diff(rows) // width)
    owner = np.repeat(np.arange(len(blocks)), blocks)
    first = np.concatenate([[0], np.cumsum(blocks)])[owner]
    return rows[owner] + width * (np.arange(len(owner)) - first), owner


def block_sums(table: np.ndarray, dims: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of table rows (dimension by component, stored by component) over blocks of words."""
    out = np.empty((len(starts), len(table)), np.float32)
    for c, column in enumerate(table):
        out[:, c] = np.add.reduceat(column[dims], starts) if len(starts) else 0
    return out


def _sketch(idf, seed: int):
    """A partition's part of A'A times a random matrix, A having a unit row for each passage."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = idf.value
        table = (random_matrix(seed) * weight).astype(np.float32)
        total = np.zeros((RANK, DIMS))
        for batch in batches:
            for part in byte_slices(batch, "words", 4 * SLICE_BYTES):
                words, rows = _flat(part)
                if not len(words):
                    continue
                dims = (words % DIMS).astype(np.int64)
                starts, _ = cut_rows(rows, PASSAGE)
                length = np.add.reduceat(weight[dims] ** 2, starts) + 1e-9
                y = block_sums(table, dims, starts) / length[:, None]
                of = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(words))))
                for c in range(RANK):
                    total[c] += np.bincount(dims, y[of, c], DIMS)
        blocks = (total * weight).astype(np.float32).reshape(RANK, -1, DIM_BLOCK).swapaxes(0, 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(blocks)), pa.int32()), pa.array([b.tobytes() for b in blocks], pa.binary())],
            names=["block", "part"])

    return run


def _sum_parts(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(RANK * DIM_BLOCK)
    for batch in batches:
        for part in batch.column("part"):
            total += np.frombuffer(part.as_py(), np.float32)
    yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()),
                                      pa.array([total.astype(np.float32).tobytes()], pa.binary())], names=["block", "part"])


def random_matrix(seed: int, rank: int = RANK) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((rank, DIMS))


def latent_table(words: DataFrame, seed: int = 5) -> np.ndarray:
    """(component, dimension): maps tf to the coordinates of a passage in the space of the leading singular vectors, and
    after RANK components to SKETCH more, a random projection of its tf-idf row.

    The range of A'A is sketched in one pass; from the sketch G = A'A O and O'G come the right singular vectors and the
    singular values. Coordinates are divided by these, so that the many passages of one language or style, which make the
    first directions, do not look alike because of them.
    """
    spark = words.sparkSession
    counts = (words.select("words").mapInArrow(_document_counts, "dim int, n long")
              .groupBy("dim").agg(F.sum("n").alias("n")).toPandas())
    n = np.zeros(DIMS)
    known = counts["dim"].to_numpy() >= 0
    n[counts["dim"].to_numpy()[known]] = counts["n"].to_numpy()[known]
    idf = np.log((counts["n"].to_numpy()[~known].sum() + 2) / (n + 1)).clip(0.05)
    parts = (words.select("words").mapInArrow(_sketch(spark.sparkContext.broadcast(idf), seed), "block int, part binary")
             .withColumn("salt", F.spark_partition_id() % 64))
    once = parts.groupBy("block", "salt").applyInArrow(_sum_parts, "block int, part binary")
    summed = once.groupBy("block").applyInArrow(_sum_parts, "block int, part binary").toPandas()
    g = np.zeros((DIMS, RANK))
    for block, part in zip(summed["block"], summed["part"], strict=True):
        g[block * DIM_BLOCK:(block + 1) * DIM_BLOCK] = np.frombuffer(part, np.float32).reshape(RANK, -1).T
    core = random_matrix(seed) @ g
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    scale = np.where(values > max(values.max(initial=0) * 1e-7, 1e-12), 1 / np.sqrt(np.maximum(values, 1e-12)), 0)
    right, singular, _ = np.linalg.svd(g @ (vectors * scale), full_matrices=False)
    inverse = np.where(singular > singular[0] * 1e-4, 1 / np.maximum(singular, 1e-12), 0)
    latent, plain = (right * inverse).T, random_matrix(seed + 1, SKETCH)
    return (np.concatenate([latent, plain]) * idf).astype(np.float32)


def unit(x: np.ndarray) -> np.ndarray:
    """Both parts of each row, latent and plain, with length 1; a part without length stays zero."""
    parts = [p / np.maximum(np.linalg.norm(p, axis=1, keepdims=True), 1e-12) for p in (x[:, :RANK], x[:, RANK:])]
    return np.concatenate(parts, axis=1)


@dataclass(frozen=True)
class Items:
    """A block of items: ids, word hashes, answers, the latent vectors of their windows with the item of each, and by length
    the hashes of their runs of words, in order, with the item and place of each."""

    ids: list
    words: list[np.ndarray]
    answers: list[np.ndarray]
    vectors: np.ndarray
    owner: np.ndarray
    runs: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]


def run_hashes(words: np.ndarray, length: int, gap: int = 1) -> np.ndarray:
    """A hash for each run of `length` words that stand `gap` places apart."""
    n = max(len(words) - gap * (length - 1), 0)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(0, gap * length, gap):
            out = (out + words[k:k + n] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
    return out


def runs_of(words: list[np.ndarray]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    found: dict[int, list[tuple]] = {}
    for i, w in enumerate(words):
        if len(w):
            length = min(len(w), RUN)
            hashes = run_hashes(w, length)
            found.setdefault(length, []).append((hashes, np.full(len(hashes), i), np.arange(len(hashes))))
    out = {}
    for length, parts in found.items():
        hashes, item, place = (np.concatenate(c) for c in zip(*parts, strict=True))
        order = np.argsort(hashes, kind="stable")
        out[length] = hashes[order], item[order], place[order]
    return out


def make_items(rows: list[tuple], table: np.ndarray) -> Items:
    hasher = WordHasher(NOT_LETTERS)
    texts = [r[1] or "" for r in rows]
    flat, bounds = hash_words(hasher, pa.array(texts, pa.large_string()))
    words = [flat[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    flat, bounds = hash_words(hasher, pa.array([answer(t) for t in texts], pa.large_string()))
    answers = [flat[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    vectors, owner = [np.zeros((0, len(table)), np.float32)], []
    for i, w in enumerate(words):
        starts = range(0, max(len(w) - WINDOW, 0) + 1, ITEM_STEP) if len(w) else ()
        for s in starts:
            vectors.append(table[:, w[s:s + WINDOW] % DIMS].sum(axis=1)[None, :])
            owner.append(i)
    return Items([r[0] for r in rows], words, answers, unit(np.concatenate(vectors)), np.array(owner, np.int64),
                 runs_of(words))


def answer(text: str) -> str:
    """What follows the last question mark, else the last sentence."""
    if "?" in text[:-1] and text.rsplit("?", 1)[1].strip():
        return text.rsplit("?", 1)[1]
    sentences = [s for s in text.replace("\n", " ").split(". ") if s.strip(" .")]
    return sentences[-1] if sentences else ""


def marked(item: np.ndarray, region: np.ndarray) -> np.ndarray:
    """Which words of a region may be an item's: all that are, and a few others."""
    table = np.zeros(1 << 12, bool)
    table[item & 0xFFF] = True
    return table[region & 0xFFF]


def common_subsequence(item: np.ndarray, region: np.ndarray) -> int:
    """Length of the longest common subsequence, with the item's places as bits of one number."""
    masks: dict[int, int] = {}
    for i, w in enumerate(item.tolist()):
        masks[w] = masks.get(w, 0) | 1 << i
    full = (1 << len(item)) - 1
    state = full
    for w in region[marked(item, region)].tolist():
        hit = state & masks.get(w, 0)
        state = ((state + hit) | (state - hit)) & full
    return len(item) - state.bit_count()


def contains(region: np.ndarray, part: np.ndarray) -> bool:
    """Whether `part` occurs in `region` without gaps."""
    if not len(part) or len(part) > len(region):
        return False
    starts = np.flatnonzero(region[:len(region) - len(part) + 1] == part[0])
    return any(np.array_equal(region[s:s + len(part)], part) for s in starts)


def judge(item: np.ndarray, answer_: np.ndarray, region: np.ndarray, strong: float, weak: float) -> tuple[float, bool, bool]:
    """Share of the item found in order, whether its answer is there, and whether this is contamination.

    An item under 8 words counts only where it occurs without gaps.
    """
    share = common_subsequence(item, region) / len(item)
    if len(item) < 8:
        whole = contains(region, item)
        return share, whole, whole
    found = share >= weak and contains(region, answer_)
    return share, found, share >= strong or found


def _search(items, table, cosine: float, strong: float, weak: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, latent = items.value, table.value
        for batch in batches:
            for part in byte_slices(batch, "words", SLICE_BYTES):
                words, rows = _flat(part)
                out = list(_matches(words, rows, block, latent, cosine, strong, weak)) if len(words) else []
                keys = part.column("key").take(pa.array([o[0] for o in out], pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [keys, pa.array([block.ids[o[1]] for o in out], pa.int64()),
                     pa.array([o[2] for o in out], pa.int32()), pa.array([o[3] for o in out], pa.int32()),
                     pa.array([o[4] for o in out], pa.float64()), pa.array([o[5] for o in out], pa.float64()),
                     pa.array([o[6] for o in out], pa.bool_())],
                    names=["key", "item_id", "first_word", "last_word", "cosine", "share", "answer"])

    return run


def _alike(words: np.ndarray, rows: np.ndarray, block: Items, strong: float, weak: float) -> Iterator[tuple[int, int, int]]:
    """(row, item, place of its first word) where a document has a run of an item's words, and the item around it."""
    places = []
    for length, (hashes, item, place) in block.runs.items():
        table = np.zeros(1 << RUN_BITS, bool)
        table[hashes >> np.uint64(64 - RUN_BITS)] = True
        for gap in GAPS if length == RUN else (1,):
            here = run_hashes(words, length, gap)
            at = np.flatnonzero(table[here >> np.uint64(64 - RUN_BITS)])
            low, high = (np.searchsorted(hashes, here[at], side) for side in ("left", "right"))
            at, low, n = at[high > low], low[high > low], (high - low)[high > low]
            entry = np.repeat(low - np.concatenate([[0], np.cumsum(n)])[:-1], n) + np.arange(n.sum())
            at = np.repeat(at, n)
            row = np.searchsorted(rows, at, "right") - 1
            inside = at + gap * (length - 1) < rows[row + 1]
            start = at - gap * place[entry]
            places.append(np.stack([row, item[entry], start, np.full(len(at), gap)], axis=1)[inside])
    # Runs of one copy begin their item at nearly one place; they are judged once.
    found = np.concatenate([np.zeros((0, 4), np.int64), *places])
    step = np.maximum(np.array([len(w) for w in block.words], np.int64) // 8, 1)[found[:, 1]]
    found[:, 2] = found[:, 2] // step * step
    for row, item, start, gap in np.unique(found, axis=0).tolist():
        wanted = block.words[item]
        slack = max(len(wanted) // 4, 2)
        stop = start + gap * len(wanted) + len(wanted) // 8 + slack
        a, b = max(int(rows[row]), start - slack), min(int(rows[row + 1]), stop)
        region = words[a:b]
        if marked(wanted, region).sum() >= weak * len(wanted) and judge(wanted, block.answers[item], region, strong, weak)[2]:
            yield row, item, max(start, int(rows[row]))


def _matches(words: np.ndarray, rows: np.ndarray, block: Items, latent: np.ndarray, cosine: float, strong: float,
             weak: float) -> Iterator[tuple]:
    starts, owner = cut_rows(rows, STEP)
    sums = block_sums(latent, (words % DIMS).astype(np.int64), starts)
    follows = np.append(owner[1:] == owner[:-1], False)
    windows = sums.copy()
    windows[:-1][follows[:-1]] += sums[1:][follows[:-1]]
    windows = unit(windows)
    by_item: dict[tuple[int, int], list[tuple[int, float]]] = {}
    for low in range(0, len(windows), 4096):
        part = windows[low:low + 4096]
        i, j = np.nonzero(part[:, RANK:] @ block.vectors[:, RANK:].T >= PLAIN_COSINE)
        near = np.einsum("ij,ij->i", part[i, :RANK], block.vectors[j, :RANK])
        for a, b, c in zip(low + i[near >= cosine], j[near >= cosine], near[near >= cosine], strict=True):
            by_item.setdefault((int(owner[a]), int(block.owner[b])), []).append((int(starts[a]), float(c)))
    for row, item, at in _alike(words, rows, block, strong, weak):
        window = windows[np.searchsorted(starts, at, "right") - 1, :RANK]
        near = float((block.vectors[block.owner == item, :RANK] @ window).max())
        by_item.setdefault((row, item), []).append((at, near))
    for (row, item), found in by_item.items():
        wanted, begin, end = block.words[item], int(rows[row]), int(rows[row + 1])
        # Windows whose surroundings meet are looked through together.
        group: list[tuple[int, float]] = []
        for at in [*sorted(found), None]:
            if group and (at is None or at[0] - group[-1][0] > WINDOW + 2 * len(wanted)):
                a = max(begin, group[0][0] - len(wanted))
                b = min(end, group[-1][0] + WINDOW + len(wanted))
                near = max(c for _, c in group)
                for first, last, share, answered in spans(wanted, block.answers[item], words[a:b], strong, weak):
                    yield row, item, a - begin + first, a - begin + last, near, share, answered
                group = []
            if at is not None:
                group.append(at)


def spans(item: np.ndarray, answer_: np.ndarray, region: np.ndarray, strong: float,
          weak: float) -> Iterator[tuple[int, int, float, bool]]:
    """(first, last, share, answer) of the places of a region that hold the item.

    The words of an item must stand within STRETCH times its length, so that a long text which only uses the same words
    over and over holds none of it. Places a part of the item apart are judged; of overlapping ones the best counts.
    """
    width, need = max(STRETCH * len(item), len(item) + 2), weak * len(item)
    may = marked(item, region)
    if may.sum() < need:
        return
    if len(region) <= width:
        share, answered, bad = judge(item, answer_, region, strong, weak)
        if bad:
            yield 0, len(region), share, answered
        return
    step = max(len(item) // 8, 1)
    starts = np.unique(np.append(np.arange(0, len(region) - width, step), len(region) - width))
    known = np.concatenate([[0], np.cumsum(may)])
    starts = starts[known[starts + width] - known[starts] >= need]
    # The whole region bounds every place of it from above.
    if not len(starts) or common_subsequence(item, region) < need:
        return
    best: tuple[int, int, float, bool] | None = None
    for start in starts.tolist():
        share, answered, bad = judge(item, answer_, region[start:start + width], strong, weak)
        if not bad:
            continue
        if best and start >= best[1]:
            yield best
            best = None
        if best is None or share > best[2]:
            best = start, start + width, share, answered
    if best:
        yield best


def _blocks(benchmark: DataFrame, item: str, text: str) -> Iterator[list[tuple]]:
    """The items in blocks of bounded number and size; they pass through the driver block by block."""
    rows, size = [], 0
    for r in benchmark.select(F.col(item).cast("long"), F.col(text)).toLocalIterator():
        rows.append((r[0], r[1]))
        size += len(r[1] or "")
        if len(rows) >= BLOCK_ITEMS or size >= BLOCK_BYTES:
            yield rows
            rows, size = [], 0
    if rows:
        yield rows


def contaminated_passages(documents: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
                          item: str = "item_id", cosine: float = COSINE, strong: float = 0.8,
                          weak: float = 0.6) -> DataFrame:
    """A row for each place of a document that holds a benchmark item: `key`, item_id, first_word, last_word (exclusive),
    cosine (the nearest window's), share (of the item's words found in order) and answer (whether its answer was found).

    Words are runs of letters, digits and non-ASCII characters in lower case. A place is at most STRETCH times as long as
    the item, or the text around a single copy, and counts with a share of at least
    `strong`, or of at least `weak` if the item's answer (what follows its last question mark, else its last sentence) is there
    without gaps; items under 8 words count only without gaps. Null or empty texts and items match nothing. Repeated
    rows, null keys and null item ids are carried through row by row. Other columns are left out. Statistics and search
    cover whole texts of all documents.
    """
    spark = documents.sparkSession
    kind = documents.schema[key].dataType.simpleString()
    words = materialize(documents.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(
        _word_rows, f"key {kind}, words binary"), "decontaminate-words")
    table = latent_table(words)
    shared = spark.sparkContext.broadcast(table)
    out = f"key {kind}, item_id long, first_word int, last_word int, cosine double, share double, answer boolean"
    found = spark.createDataFrame([], out)
    for rows in _blocks(benchmark, item, text):
        items = spark.sparkContext.broadcast(make_items(rows, table))
        found = found.union(words.mapInArrow(_search(items, shared, cosine, strong, weak), out))
    return found.withColumnRenamed("key", key)
