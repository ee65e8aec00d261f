"""Near-duplicate documents by DartMinHash signatures, banded joins and exact verification.

A text is a weighted set: its five-word shingles with their counts. For each shingle and each unit of its
weight, darts arrive along the rank axis as a Poisson process that depends on nothing but the shingle, the
unit and the dart's number. A text keeps the darts whose rank is under t / weight, about k ln k + 2 k of them
whatever its length; each dart falls into one of k coordinates, and the one of lowest rank in a coordinate is
the signature there. Two texts agree in a coordinate with the probability of their weighted Jaccard similarity.

Equal texts (as words) are first gathered under a hash of their words, so copies cost one row each. The
representatives meet in bands of a few coordinates. In each bucket every text is compared with the smallest,
exactly, by its shingles; what is alike is linked. Texts of one bucket that are still in different classes after
that are compared with each other in blocks of bounded size by their parity bitmaps: the bits in which two differ
bound the similarity from above, and texts that have a pair which may be alike are compared exactly, the likeliest
pairs first. No link between classes that the bands show is lost, no pairs of a group become rows and no task
holds a bucket. Classes are the connected components of the
links, found by alternating star contractions with joins.

Defined cases: words are as in `tokens.PLAIN`, with A-Z lower-cased; texts of any length are read whole. Texts of fewer
than five words, but not none, are one shingle. Of equally old texts of a class the one of the smaller hash of its
words stays. Only doc_id and text are read; `filtered` returns all other columns as they are, and its own are named
__q_. Null texts and texts without words are alike to nothing, each its own class. Different
texts that share a doc_id are compared each for itself; doc_id only ranks which one stays, and equal rows stay or
go together. Null doc_ids count as one largest id. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.llm import tokens
from quillspark.llm.shared import holds, ordered_id, staged, unstaged, words_of_filter

SHINGLE, SIMILARITY = 5, 0.8
#: 24 bands of 5: a pair at the similarity 0.8 is missed with the probability 0.00007.
BANDS, BAND = 24, 5
#: Bits of a parity bitmap for each element, about.
BITS = 4
#: Texts and elements of a block, about; rows that numpy compares with a block at a time; pairs of one text that are joined in one group.
BLOCK, BLOCK_ELEMENTS, ROWS, PART = 1024, 1 << 22, 256, 256
#: Parts of a bucket when its texts are joined with its smallest.
SPREAD = 8
_U = np.uint64
_STEP = 1 << 19


def weighted(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each text's shingles with a number for each repeat: text, element and its weight (1), sorted by text."""
    runs, at = tokens.shingles(words, first, SHINGLE, short=True)
    text = tokens.owners(first)[at]
    order = np.lexsort((runs, text))
    runs, text = runs[order], text[order]
    new = np.ones(len(runs), bool)
    new[1:] = (runs[1:] != runs[:-1]) | (text[1:] != text[:-1])
    start = np.maximum.accumulate(np.where(new, np.arange(len(runs)), 0)) if len(runs) else np.zeros(0, np.int64)
    repeat = (np.arange(len(runs)) - start).astype(_U)
    return text, tokens.mix(runs + repeat * _U(0xC2B2AE3D27D4EB4F)), np.bincount(text, minlength=len(first) - 1)


def signatures(text: np.ndarray, elements: np.ndarray, weight: np.ndarray, k: int) -> np.ndarray:
    """The DartMinHash signature of each text: k dart hashes, 0 where a text has no elements."""
    n = len(weight)
    out = np.zeros((n, k), _U)
    done = weight == 0
    darts = k * np.log(k) + 2 * k
    while not done.all():
        open_ = ~done[text]
        limit = (darts / np.maximum(weight, 1))[text[open_]]
        who, what = text[open_], elements[open_]
        rank, cells, ranks, marks = np.zeros(len(what)), [], [], []
        number = 0
        while len(what):  # arrival by arrival, until every element's next dart is beyond its text's limit
            number += 1
            u = tokens.mix(what + _U((2 * number + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
            rank = rank - np.log(((u >> _U(11)).astype(float) + 0.5) * 2.0**-53)
            keep = rank < limit
            what, who, rank, limit, u = what[keep], who[keep], rank[keep], limit[keep], u[keep]
            mark = tokens.mix(u ^ _U(0x27D4EB2F165667C5))
            cells.append(who * k + (mark % _U(k)).astype(np.int64))
            ranks.append(rank)
            marks.append(mark | _U(1))
        cell, rank, mark = np.concatenate(cells), np.concatenate(ranks), np.concatenate(marks)
        order = np.argsort(rank)[::-1]  # the lowest rank is written last
        flat = np.zeros(n * k, _U)
        flat[cell[order]] = mark[order]
        flat = flat.reshape(n, k)
        full = (flat != 0).all(1) & ~done
        out[full] = flat[full]
        done |= full
        darts *= 2  # rarely some coordinate stays empty: throw more darts for those texts
    return out


def bands_of(column: pa.Array, bands: int = BANDS, band: int = BAND) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each text two hashes of its words, the number of its elements, and its bands' hashes."""
    keys, sizes, found = [], [], []
    for _, b in tokens.batches(column, _STEP):
        starts, ends, first = b.words(tokens.PLAIN)
        words = b.hashes(starts, ends, fold=True)
        text, elements, weight = weighted(words, first)
        signature = signatures(text, elements, weight, bands * band)
        total = np.zeros((b.n, bands), _U)
        for j in range(band):
            total = tokens.mix(total * _U(31) + signature[:, j::band][:, :bands])
        keys.append(_text_keys(words, first))
        sizes.append(weight)
        found.append(total)
    return np.concatenate(keys) if keys else np.zeros((0, 2), _U), np.concatenate(sizes) if sizes else np.zeros(0, np.int64), np.concatenate(found) if found else np.zeros((0, bands), _U)


def _text_keys(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Two independent hashes of each text's words in their order."""
    place = (np.arange(len(words)) - np.repeat(first[:-1], np.diff(first))).astype(_U)
    out = np.zeros((len(first) - 1, 2), _U)
    for k in range(2):
        each = tokens.mix(words + tokens.mix(place * _U(2) + _U(k + 1)))
        total = np.concatenate((np.zeros(1, _U), np.cumsum(each, dtype=_U)))
        out[:, k] = tokens.mix(total[first[1:]] - total[first[:-1]] + np.diff(first).astype(_U))
    return out


def signed_texts(documents: DataFrame, bands: int = BANDS, band: int = BAND) -> DataFrame:
    """id, key_a, key_b, size and bands of each row; size is 0 where a text has no words."""

    def step(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            keys, sizes, found = bands_of(batch.column("text"), bands, band)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(sizes) + 1) * bands, pa.int32()), pa.array(tokens.signed(found.reshape(-1))))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(tokens.signed(np.ascontiguousarray(keys[:, 0]))), pa.array(tokens.signed(np.ascontiguousarray(keys[:, 1]))), pa.array(sizes.astype(np.int64)), lists], ["id", "key_a", "key_b", "size", "bands"])

    rows = documents.select(ordered_id().alias("id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(step, "id long, key_a long, key_b long, size long, bands array<long>")


def parities(elements: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each text a bitmap: bit i tells whether an odd number of its elements fall to i. Words, flat, and how many each.

    The width follows the number of elements, and is a power of two, so that a wider bitmap folds to a narrower one.
    """
    words = (1 << np.ceil(np.log2(np.maximum(1, weight * BITS / 64))).astype(np.int64)) * (weight > 0)
    start = np.cumsum(words) - words
    at = np.repeat(start * 64, weight) + (elements & np.repeat((words * 64 - 1).astype(_U), weight)).astype(np.int64)
    odd = (np.bincount(at, minlength=int(words.sum()) * 64) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(_U), words


def elements_of(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """id (a hash of the words), elements (weighted shingles as a set of longs) and parity bitmap of the texts wanted (id, low).

    low is the doc_id of a row that holds the text. Texts don't move: a Bloom filter of these doc_ids, of bounded
    size, keeps most others from being read again, and what it lets through too much is dropped by a join of ids.
    """
    held = documents.sparkSession.sparkContext.broadcast(words_of_filter(wanted.select(F.xxhash64("low").alias("h"))))

    def step(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            here = pa.array(holds(held.value, batch.column("h").to_numpy()))
            for _, b in tokens.batches(batch.column("text").filter(here), _STEP):
                starts, ends, first = b.words(tokens.PLAIN)
                words = b.hashes(starts, ends, fold=True)
                text, elements, weight = weighted(words, first)
                elements = elements[np.lexsort((elements, text))]
                marks, width = parities(elements, weight)
                lists = [pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(n))), pa.int32()), pa.array(tokens.signed(x))) for n, x in ((weight, elements), (width, marks))]
                keys = [pa.array(tokens.signed(np.ascontiguousarray(k))) for k in _text_keys(words, first).T]
                yield pa.RecordBatch.from_arrays([*keys, *lists], ["key_a", "key_b", "elements", "marks"])

    rows = documents.select(F.xxhash64(ordered_id()).alias("h"), F.col("text").cast("string").alias("text"))
    found = rows.mapInArrow(step, "key_a long, key_b long, elements array<long>, marks array<long>")
    found = found.select(F.xxhash64("key_a", "key_b").alias("id"), "elements", "marks").join(wanted.select("id"), "id", "left_semi")
    return found.groupBy("id").agg(F.first("elements").alias("elements"), F.first("marks").alias("marks"))


def similarity(a: Column, b: Column) -> Column:
    """Weighted Jaccard similarity of two arrays of elements."""
    both = F.size(F.array_intersect(a, b))
    return both / (F.size(a) + F.size(b) - both)


def _folded(marks: Column, words: Column) -> Column:
    part = lambda k: F.slice(marks, (k * words + 1).cast("int"), words)
    xor = lambda x, y: x.bitwiseXOR(y)
    more = F.sequence(F.lit(1), (F.size(marks) / words).cast("int") - 1)
    return F.when(F.size(marks) == words, marks).otherwise(F.aggregate(more, part(F.lit(0)), lambda done, k: F.zip_with(done, part(k), xor)))


def may_be(x: str, y: str, least: float) -> Column:
    """False where two texts (columns or structs with size and marks) are surely less similar.

    Bits in which two parity bitmaps differ are at most as many as the elements that only one of the sets has.
    """
    a, b = F.col(f"{x}size"), F.col(f"{y}size")
    words = F.least(F.size(f"{x}marks"), F.size(f"{y}marks"))
    bits = F.zip_with(_folded(F.col(f"{x}marks"), words), _folded(F.col(f"{y}marks"), words), lambda p, q: F.bit_count(p.bitwiseXOR(q)))
    apart = F.aggregate(bits, F.lit(0), lambda total, n: total + n)
    alike = F.least(a, b) >= F.lit(least) * F.greatest(a, b)
    return F.when(alike, (a + b - apart) / (a + b + apart) >= least).otherwise(False)


def verified(pairs: DataFrame, elements: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose texts are at least so similar. A text a that is in many pairs is dealt out in parts."""
    left, right = (elements.select(F.col("id").alias(x), F.col("elements").alias(f"{x}_elements")) for x in "ab")
    degree = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PART).alias("parts"))
    dealt = pairs.join(degree, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("parts")).alias("part"))
    parts = left.join(degree, "a").select("a", "a_elements", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    both = dealt.join(right, "b").join(parts, ["a", "part"])
    return both.where(similarity(F.col("a_elements"), F.col("b_elements")) >= least).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """id and class_id (the smallest id it is connected to) of all ids in links (a, b), by alternating star contractions.

    Each round moves links with two joins and two partial aggregations; no vertex's neighbours are gathered.
    """
    edges = staged(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links")
    state = None
    while True:
        # large star: every larger neighbour of u goes to the smallest of u and its neighbours
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: u and its smaller neighbours go to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        last, edges = edges, staged(small.where("u <> v").distinct(), "links")
        unstaged(last)
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.hash("u", "v").cast("long")), F.sum(F.col("v") % 1000003)).first())
        if now == state:
            break
        state = now
    return edges.select(F.col("u").alias("id"), F.col("v").alias("class_id"))


def _pair(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def labels_of(texts: DataFrame, links: DataFrame) -> DataFrame:
    """id and class_id of all texts (id): the smallest text that links lead to."""
    return texts.select("id").join(components(links), "id", "left").select("id", F.coalesce("class_id", "id").alias("class_id"))


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """In how many bits each row of a differs from each row of b."""
    out = np.zeros((len(a), len(b)), np.int32)
    for k in range(a.shape[1]):
        out += np.bitwise_count(a[:, k][:, None] ^ b[:, k][None, :])
    return out


def _may_be(group: dict[str, np.ndarray], least: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs of one group, of different labels and sides, that may be alike, some at a time, with the bound of their similarity."""
    size, label, side, width, start, flat = (group[n] for n in ("size", "class_id", "side", "width", "start", "marks"))
    two = side.max() > side.min()
    widths = [(w, np.flatnonzero(width == w)) for w in np.unique(width)]
    for i, (w, own) in enumerate(widths):
        a = flat[start[own][:, None] + np.arange(w)]
        for v, other in widths[i:]:
            if size[own].max() < least * size[other].min() or size[other].max() < least * size[own].min():
                continue
            b = np.bitwise_xor.reduce(flat[start[other][:, None] + np.arange(v)].reshape(len(other), v // w, w), axis=1)
            for k in range(0, len(own), ROWS):
                x = own[k : k + ROWS]
                total = size[x][:, None] + size[other][None, :]
                ok = (label[x][:, None] != label[other][None, :]) & (np.minimum(size[x][:, None], size[other][None, :]) >= least * np.maximum(size[x][:, None], size[other][None, :]))
                if two:
                    ok &= side[x][:, None] != side[other][None, :]
                if v == w:
                    ok &= x[:, None] < other[None, :]
                if not ok.any():
                    continue
                apart = _apart(a[k : k + ROWS], b)
                bound = (total - apart) / (total + apart)
                p, q = np.nonzero(ok & (bound >= least))
                yield x[p], other[q], bound[p, q]


def _doubtful(group: dict[str, np.ndarray], least: float) -> np.ndarray:
    """The rows of one group that have a pair which may be alike."""
    out = np.zeros(len(group["id"]), bool)
    for x, y, _ in _may_be(group, least):
        out[x] = out[y] = True
    return np.flatnonzero(out)


def _forest(group: dict[str, np.ndarray], least: float) -> tuple[np.ndarray, np.ndarray]:
    """Links of one group (with elements) that connect all that its alike pairs connect: the likeliest are tested first,
    and of two texts that are connected already the pair isn't needed."""
    group["marks"], group["width"] = parities(group["elements"], group["size"])
    group["start"] = np.cumsum(group["width"]) - group["width"]
    found = list(_may_be(group, least))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    left, right, bound = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((right, left, -bound))
    owner = np.unique(group["class_id"], return_inverse=True)[1]
    root, at, flat = np.arange(owner.max() + 1), np.concatenate(([0], np.cumsum(group["size"]))), group["elements"]
    a, b = [], []
    for i in range(0, len(order), ROWS):
        p, q = left[order[i : i + ROWS]], right[order[i : i + ROWS]]
        apart = root[owner[p]] != root[owner[q]]
        for x, y in zip(p[apart].tolist(), q[apart].tolist(), strict=True):
            r, s = root[owner[x]], root[owner[y]]
            if r == s:
                continue
            m, n = flat[at[x] : at[x + 1]], flat[at[y] : at[y + 1]]
            place = np.minimum(np.searchsorted(n, m), len(n) - 1)
            both = int((n[place] == m).sum())
            if both / (len(m) + len(n) - both) >= least:
                root[root == s] = r
                a.append(group["id"][x])
                b.append(group["id"][y])
    return np.array(a, np.int64), np.array(b, np.int64)


_GROUP = ("band", "hash", "one", "two")


def _new(table: pa.Table) -> np.ndarray:
    out = np.zeros(table.num_rows, bool)
    out[0] = True
    for n in _GROUP:
        x = table.column(n).to_numpy()
        out[1:] |= x[1:] != x[:-1]
    return out


def _by_group(lists: str, use):
    """Calls use on each group of rows that are sorted by group; a batch's last group waits for the next batch.

    use gets a table of whole groups, and for each of them its first row, the row after its last and its columns as arrays.
    """

    def step(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def groups(table: pa.Table):
            table = table.combine_chunks()
            columns = {n: table.column(n).to_numpy() for n in ("id", "size", "class_id", "side")}
            array = table.column(lists).combine_chunks()
            off, flat = array.offsets.to_numpy().astype(np.int64), array.values.to_numpy().view(_U)
            cuts = np.append(np.flatnonzero(_new(table)), table.num_rows)
            parts = []
            for i, j in zip(cuts[:-1], cuts[1:], strict=True):
                own = {n: v[i:j] for n, v in columns.items()} | {lists: flat[off[i] : off[j]], "width": np.diff(off[i : j + 1]), "start": off[i:j] - off[i]}
                parts.append((i, own))
            return use(table, parts)

        for batch in it:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            if not held.num_rows:
                continue
            last = int(np.flatnonzero(_new(held))[-1])
            if last:
                yield from groups(held.slice(0, last))
                held = held.slice(last)
        if held is not None and held.num_rows:
            yield from groups(held)

    return step


def grouped_rows(held: DataFrame) -> DataFrame:
    """band, hash, one, two (the blocks of a group), id, size, class_id, side and marks: each text of a bucket of several
    labels in every group where its block meets another. The largest label's blocks come after those of the others."""
    many = lambda n, elements: F.greatest(F.ceil(n / BLOCK), F.ceil(elements / BLOCK_ELEMENTS))
    labels = held.groupBy("band", "hash", "class_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("size").cast("long")).alias("elements"))
    several = labels.groupBy("band", "hash").agg(F.count(F.lit(1)).alias("labels"), F.max(F.struct("n", "elements", "class_id")).alias("top"), F.sum("n").alias("n"), F.sum("elements").alias("elements")).where("labels > 1")
    several = several.select("band", "hash", F.col("top.class_id").alias("largest"), many(F.col("n") - F.col("top.n"), F.col("elements") - F.col("top.elements")).alias("few"), many(F.col("top.n"), F.col("top.elements")).alias("most"))
    several = several.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1)))).repartition("band", "hash", "part")
    rows = held.withColumn("part", F.pmod("id", F.lit(SPREAD)).cast("int")).join(several, ["band", "hash", "part"]).drop("part")
    large = F.col("class_id") == F.col("largest")
    own = F.pmod(F.xxhash64("id", F.lit("block")), F.when(large, F.col("most")).otherwise(F.col("few")))
    rows = rows.withColumn("own", own + F.when(large, F.col("few")).otherwise(0))
    last = F.when(large, F.col("few")).otherwise(F.col("few") + F.col("most")) - 1
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    return rows.select("band", "hash", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"), "id", "size", "class_id", F.col("own").alias("side"), "marks")


def candidate_links(held: DataFrame, elements: DataFrame, least: float) -> DataFrame:
    """Links (a, b) among texts of different labels in one bucket (band, hash, id, size, marks, class_id).

    A bucket's texts fall by hash into blocks of a bounded number of texts and elements. Texts of its largest class
    aren't compared with each other: their blocks meet only those of the other texts, so the rows are as many as the
    largest class's texts by the blocks of the others, and the others by all blocks. Two blocks meet in a group of
    their own, so no task holds a bucket. The groups are formed twice: with bitmaps, where texts without any pair that
    may be alike drop out, and then with the elements of the others. A group gives no more rows than it has texts.
    """
    grouped = lambda df: df.repartition(*_GROUP).sortWithinPartitions(*_GROUP)
    rows = grouped_rows(held)

    def doubtful(table: pa.Table, groups: list) -> Iterator[pa.RecordBatch]:
        keep = np.concatenate([i + _doubtful(g, least) for i, g in groups])
        yield from table.drop_columns("marks").take(pa.array(keep)).to_batches()

    def forest(table: pa.Table, groups: list) -> Iterator[pa.RecordBatch]:
        a, b = (np.concatenate(x) for x in zip(*(_forest(g, least) for _, g in groups), strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    some = grouped(rows).mapInArrow(_by_group("marks", doubtful), "band int, hash long, one long, two long, id long, size int, class_id long, side long")
    whole = staged(some, "doubtful").join(elements.select("id", "elements"), "id")
    return grouped(whole).mapInArrow(_by_group("elements", forest), "a long, b long").distinct()


def links_in(buckets: DataFrame, elements: DataFrame, least: float) -> DataFrame:
    """Links (a, b) that connect whatever the buckets (band, hash, id, lead) connect.

    First every text is compared with the smallest of its bucket. Texts of one bucket that are then in different
    classes are compared with each other, block by block.
    """
    sets = staged(elements.select("id", F.size("elements").alias("size"), "marks"), "marks")
    first, second = (sets.select(F.col("id").alias(n), F.struct("size", "marks").alias(x)) for n, x in ("ax", "by"))
    pairs = buckets.where("id <> lead").select(*_pair("id", "lead")).distinct().join(second, "b").join(first, "a")
    pairs = staged(pairs.where(may_be("x.", "y.", least)).select("a", "b"), "pairs")
    found = staged(verified(pairs, elements, least), "near")
    held = staged(buckets.select("band", "hash", "id").join(labels_of(sets, found), "id").join(sets, "id"), "labelled")
    links = staged(found.unionByName(candidate_links(held, elements, least)), "near")
    unstaged(sets, pairs, found, held)
    return links


def _classed(documents: DataFrame, least: float, bands: int, band: int) -> DataFrame:
    """id, class_id, stays, key_a and key_b of every row."""
    signed = staged(signed_texts(documents, bands, band), "signed")
    texts = signed.where("size > 0").groupBy("key_a", "key_b").agg(F.min("id").alias("low"), F.first("bands").alias("bands"))
    texts = staged(texts.withColumn("id", F.xxhash64("key_a", "key_b")), "texts")
    rows = texts.select("id", "low", F.posexplode("bands").alias("band", "hash"))
    met = rows.groupBy("band", "hash").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("lead")).where("n > 1").select("band", "hash", "lead")
    # a bucket's rows are dealt over several parts, so that a hot one isn't joined in one task
    # (the repartitioning is explicit, else Spark would reuse that of the aggregation, by bucket)
    spread = met.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1)))).repartition("band", "hash", "part")
    rows = rows.withColumn("part", F.pmod("id", F.lit(SPREAD)).cast("int"))
    buckets = staged(rows.join(spread, ["band", "hash", "part"]).select("band", "hash", "id", "low", "lead"), "buckets")
    wanted = staged(buckets.select("id", "low").distinct(), "wanted")
    elements = staged(elements_of(documents, wanted), "elements")
    class_of = components(links_in(buckets, elements, least))
    unstaged(buckets, wanted, elements)
    linked = texts.select("key_a", "key_b", "id", "low").join(class_of, "id", "left").withColumn("class", F.coalesce("class_id", "id")).drop("class_id")
    best = linked.groupBy("class").agg(F.min(F.struct("low", "id")).alias("best"))
    classed = linked.join(best, "class").select("key_a", "key_b", F.col("best.low").alias("class_id"), (F.col("id") == F.col("best.id")).alias("first"))
    out = signed.select("id", "key_a", "key_b", "size").join(classed, ["key_a", "key_b"], "left")
    own = (F.col("size") == 0) | F.col("class_id").isNull()
    class_id = F.when(own, F.col("id")).otherwise(F.col("class_id"))
    return out.select("id", class_id.alias("class_id"), (own | (F.col("first") & (F.col("id") == F.col("class_id")))).alias("stays"), "key_a", "key_b")


def classes(documents: DataFrame, least: float = SIMILARITY, bands: int = BANDS, band: int = BAND) -> DataFrame:
    """id, class_id and stays of every row; class_id is the smallest doc_id among the documents it is linked to."""
    return _classed(documents, least, bands, band).select("id", "class_id", "stays")


@F.arrow_udf(T.ArrayType(T.LongType()))
def _keys(text: pa.Array) -> pa.Array:
    found = [np.zeros((0, 2), _U)]
    for _, b in tokens.batches(text, _STEP):
        starts, ends, first = b.words(tokens.PLAIN)
        found.append(_text_keys(b.hashes(starts, ends, fold=True), first))
    return pa.array(tokens.signed(np.concatenate(found)).tolist(), pa.list_(pa.int64()))


def filtered(documents: DataFrame, least: float = SIMILARITY, bands: int = BANDS, band: int = BAND) -> DataFrame:
    """documents, all columns, with one document of each class: the one of the smallest id."""
    rows = staged(_classed(documents, least, bands, band), "classed")
    ids = rows.groupBy(F.col("id").alias("__q_id")).agg(F.bool_and("stays").alias("all"), F.bool_or("stays").alias("some"))
    named = documents.withColumn("__q_id", ordered_id())
    out = named.join(ids.where("all").select("__q_id"), "__q_id", "left_semi").drop("__q_id")
    mixed = staged(ids.where("some and not all").select("__q_id"), "mixed")
    if mixed.isEmpty():
        return out
    kept = rows.where("stays").select(F.col("id").alias("__q_id"), F.array("key_a", "key_b").alias("__q_keys")).distinct()
    some = named.join(mixed, "__q_id", "left_semi").withColumn("__q_keys", _keys(F.col("text").cast("string")))
    return out.unionByName(some.join(kept, ["__q_id", "__q_keys"], "left_semi").drop("__q_id", "__q_keys"))
