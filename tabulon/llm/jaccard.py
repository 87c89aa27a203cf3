"""Exact n-gram Jaccard join by rare-first prefix filtering.

A document's set holds the hashes of its distinct ``n``-word shingles. Equal
sets collapse to their smallest doc_id first. Tokens are ordered rare first:
a counter table of fixed size over all words of all documents gives each shingle
its expected frequency (any order shared by all documents is exact; the counters
only make the prefixes selective). Two sets
with Jaccard >= t share a token of their prefixes, so the prefixes are joined
on tokens. In each token's list the length filter and the positional filter
drop pairs that cannot overlap enough, a suffix filter drops more, and each pair
that is left is verified once on the whole sets. The suffix filter compares
parity bitmaps, one bit for the number of tokens in each of at least as many
hash cells as the set has tokens: two sets differ in at least as many tokens as
their bitmaps differ in bits.

Links are found in rounds so that a large group of near copies does not produce
all its pairs: first each list is joined to its hub (the set that holds the token
earliest, which is the least edited copy), then, ``nearest`` times, each set of a list to its
nearest set (by bitmap) of another component, and last every pair of sets that
are still in different components is verified. A pair inside one component
cannot change the components, so no link that matters is lost.

Words are lower-cased (A-Z) runs of non-white-space. A text with fewer than
``n`` words has its whole word sequence as its one shingle; a null, empty or
blank text has an empty set and links with nothing. Rows with a null doc_id are
returned with a null component. Rows that repeat a doc_id are compared one
by one and share one component. An empty table gives
no rows; texts are never cut; other columns are ignored."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .buckets import ids_of, in_sorted, one
from .common import components, cut, frugal, release, shuffle_parts, table, with_running_total
from .words import Words, chunks, mix, split

COUNTERS = 1 << 20
BROADCAST_IDS = 1 << 20        # ids that may be broadcast (16 MB); beyond, a shuffle join
MIN_BITS = 64
_SETS = "doc_id bigint, n_shingles bigint, set_hi bigint, set_lo bigint, bitmap binary"
_PACKED = "part int, postings binary"
_PAIRS = "a bigint, b bigint"
LIST_ROWS = 1024               # postings of a list, or of each side of a pair of its blocks
PART_ROWS = 200_000            # postings packed into one task
_POSTING = np.dtype([("token", "<u8"), ("doc_id", "<i8"), ("size", "<i4"), ("pos", "<i4")])


def shingles(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text number), sorted and distinct within each text."""
    h, whole = w.grams(n)
    counts = w.counts()
    for k in range(1, n):                              # short texts: the whole sequence of k words
        of = np.flatnonzero(counts == k)
        if len(of):
            at = w.first[of]
            h[at] = w.grams(k)[0][at] + np.uint64(k)
            whole[at] = True
    text = w.text_of()[whole]
    h = h[whole]
    first = np.searchsorted(text, np.arange(len(counts) + 1))
    for s, e in zip(first[:-1].tolist(), first[1:].tolist()):
        h[s:e].sort()
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
    return h[new], text[new]


def _counters(docs: DataFrame) -> np.ndarray:
    """Word counts of all documents by the low bits of their hash: a table of
    fixed size, summed block by block in a shuffle."""
    cells = 1 << 14

    def count(batches):
        total = np.zeros(COUNTERS, np.uint32)
        for b in batches:
            for s, e in chunks(b.column(0)):
                h = split(b.column(0).slice(s, e - s), lower=True).hash
                total += np.bincount((h & np.uint64(COUNTERS - 1)).astype(np.int64), minlength=COUNTERS).astype(np.uint32)
        blocks = total.reshape(-1, cells)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(blocks)), pa.int32()),
                                          pa.array([zlib.compress(x.astype("<u8").tobytes(), 1) for x in blocks], pa.binary())],
                                         ["block", "counts"])

    def add(key, rows):
        total = sum(np.frombuffer(zlib.decompress(x), "<u8") for x in rows.column("counts").to_pylist())
        return pa.table({"block": pa.array([key[0].as_py()], pa.int32()),
                         "counts": pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())})

    schema = "block int, counts binary"
    rows = docs.select("text").mapInArrow(frugal(count), schema).groupBy("block").applyInArrow(frugal(add), schema).collect()
    out = np.zeros((COUNTERS // cells, cells), np.uint64)
    for r in rows:
        out[r["block"]] = np.frombuffer(zlib.decompress(r["counts"]), "<u8")
    return np.log2(out.reshape(-1) + 1.0).astype(np.float32)


def _tokens(w: Words, n: int, rarity: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each text's shingles, sorted and distinct: 24 bits of expected
    frequency (rare first), then 40 bits of the shingle's hash."""
    h, whole = w.grams(n)
    counts = w.counts()
    word = rarity[(w.hash & np.uint64(COUNTERS - 1)).astype(np.int64)]
    rank = np.zeros(len(h), np.float32)
    for j in range(min(n, len(h))):
        rank[:len(h) - j] += word[j:]
    for k in range(1, n):
        of = np.flatnonzero(counts == k)
        if len(of):
            at = w.first[of]
            h[at] = w.grams(k)[0][at] + np.uint64(k)
            rank[at] = word[at]
            whole[at] = True
    token = (np.minimum(rank * 4096, (1 << 24) - 1).astype(np.uint64) << np.uint64(40)) | (h >> np.uint64(24))
    text, token = w.text_of()[whole], token[whole]
    first = np.searchsorted(text, np.arange(len(counts) + 1))
    for s, e in zip(first[:-1].tolist(), first[1:].tolist()):
        token[s:e].sort()
    new = np.ones(len(token), bool)
    new[1:] = (token[1:] != token[:-1]) | (text[1:] != text[:-1])
    return token[new], text[new]


def _fold(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 128-bit digest of each set (0 for an empty one)."""
    full = np.flatnonzero(np.diff(first))
    out = []
    with np.errstate(over="ignore"):
        for x in (mix(h ^ np.uint64(0x9E3779B97F4A7C15)), mix(h + np.uint64(0xD6E8FEB86659FD93))):
            d = np.zeros(len(first) - 1, np.uint64)
            if len(full):
                d[full] = np.add.reduceat(x, first[full])
            out.append(d)
    return out[0], out[1]


def prefix_length(size, percent: int):
    """Tokens of a set that can hold the first common one: size - ceil(t size) + 1."""
    return size - -(-size * percent // 100) + 1


def min_overlap(a, b, percent: int):
    """Least common tokens of sets of sizes a and b with 100 |x & y| >= percent |x | y|."""
    return -(-(a + b) * percent // (100 + percent))


def _bits(size: np.ndarray) -> np.ndarray:
    """Bits of a set's bitmap: the power of two from its size on."""
    return np.maximum(MIN_BITS, 1 << np.ceil(np.log2(np.maximum(size, 1))).astype(np.int64))


def _bitmaps(h: np.ndarray, text: np.ndarray, size: np.ndarray) -> list[bytes]:
    """Parity of the number of hashes by their low bits, for each text."""
    bits = _bits(size)
    first = np.concatenate([[0], np.cumsum(bits)])
    parity = np.bincount(first[text] + (h & (bits[text] - 1).astype(np.uint64)).astype(np.int64), minlength=first[-1]) & 1
    raw = np.packbits(parity.astype(np.uint8), bitorder="little").tobytes()
    return [raw[s:e] for s, e in zip((first[:-1] // 8).tolist(), (first[1:] // 8).tolist())]


def _sets(n: int):
    """One row per document: set size, digest and bitmap."""
    def run(batches):
        for b in batches:
            column = one(pa.chunked_array([b.column(1)]))
            for s, e in chunks(column):
                h, text = shingles(split(column.slice(s, e - s), lower=True), n)
                m = e - s
                size = np.bincount(text, minlength=m)
                hi, lo = _fold(h, np.concatenate([[0], np.cumsum(size)]))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(s, m), pa.array(size, pa.int64()), pa.array(hi.astype(np.int64)), pa.array(lo.astype(np.int64)),
                     pa.array(_bitmaps(h, text, size), pa.binary())], ["doc_id", "n_shingles", "set_hi", "set_lo", "bitmap"])
    return run


def _postings(rarity, n: int, percent: int, parts: int):
    """Prefix postings of the texts with a doc_id, packed by shuffle part."""
    def run(batches):
        for b in batches:
            b = b.filter(b.column(0).is_valid())
            column = one(pa.chunked_array([b.column(1)]))
            for s, e in chunks(column):
                token, text = _tokens(split(column.slice(s, e - s), lower=True), n, rarity.value)
                size = np.bincount(text, minlength=e - s)
                pos = np.arange(len(token)) - (np.cumsum(size) - size)[text]
                take = pos < prefix_length(size, percent)[text]
                text = text[take]
                post = np.empty(len(text), _POSTING)
                post["token"], post["size"], post["pos"] = token[take], size[text], pos[take]
                post["doc_id"] = ids_of(b.column(0).slice(s, e - s))[text]
                yield _packed_postings(post, parts)
    return run


def _packed_postings(post: np.ndarray, parts: int) -> pa.RecordBatch:
    part = (post["token"] % np.uint64(parts)).astype(np.int32)
    order = np.argsort(part, kind="stable")
    part, post = part[order], post[order]
    at = np.flatnonzero(np.diff(part, prepend=-1))
    ends = np.append(at[1:], len(post))
    return pa.RecordBatch.from_arrays([pa.array(part[at], pa.int32()), pa.array([post[s:e].tobytes() for s, e in zip(at, ends)], pa.binary())],
                                      ["part", "postings"])


def _candidates(percent: int):
    """Postings that some other posting of their token can match by length and
    position."""
    def run(key, rows):
        post = np.concatenate([np.frombuffer(x, _POSTING) for x in rows.column("postings").to_pylist()])
        post = post[np.lexsort((post["doc_id"], post["size"], post["token"]))]
        new = np.ones(len(post), bool)                 # a repeated document posts once
        new[1:] = (post["token"][1:] != post["token"][:-1]) | (post["doc_id"][1:] != post["doc_id"][:-1])
        post = post[new]
        token, size, pos = post["token"], post["size"].astype(np.int64), post["pos"].astype(np.int64)
        mark, left, d = np.zeros(len(post), bool), np.arange(len(post)), 0
        while True:
            d += 1
            left = left[left + d < len(post)]
            left = left[(token[left + d] == token[left]) & (100 * size[left] >= percent * size[left + d])]
            if not len(left):
                break
            i, j = left, left + d
            ok = np.minimum(size[i] - pos[i], size[j] - pos[j]) >= min_overlap(size[i], size[j], percent)
            mark[i[ok]] = mark[j[ok]] = True
        post = post[mark]
        return pa.table({"token": pa.array(post["token"].astype(np.int64)), "doc_id": pa.array(post["doc_id"]),
                         "size": pa.array(post["size"]), "pos": pa.array(post["pos"])})
    return run


class _Lists:
    """Postings of some lists as arrays, with the filters of a pair of rows.

    postings: (list, doc_id, size, pos, component, side); bitmaps: (owner, bits),
    one row for each document of the postings."""

    def __init__(self, postings: pa.Table, bitmaps: pa.Table, percent: int):
        cols = [postings.column(c).to_numpy().astype(np.int64) for c in ("list", "doc_id", "size", "pos", "component", "side")]
        order = np.lexsort((cols[1], cols[2], cols[0]))
        self.list, self.ids, self.size, self.pos, self.comp, self.side = (c[order] for c in cols)
        docs = bitmaps.column("owner").to_numpy().astype(np.int64)
        by_id = np.argsort(docs, kind="stable")
        self.bitmap = one(bitmaps.column("bits"))
        self.doc = by_id[np.searchsorted(docs[by_id], self.ids)]        # row of the bitmap of each posting
        self.bits = _bits(self.size)
        self.doc_bits = np.zeros(len(docs), np.int64)
        self.doc_bits[self.doc] = self.bits
        self.folded: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.percent = percent

    def _matrix(self, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Bitmaps of the documents with ``bits`` bits or more, folded to
        ``bits``, and each document's place in the matrix."""
        if bits not in self.folded:
            docs = np.flatnonzero(self.doc_bits >= bits)
            out = np.zeros((len(docs), bits // 64), np.uint64)
            for k, i in enumerate(docs):
                out[k] = _narrowed(self.bitmap[i].as_buffer(), bits)
            place = np.full(len(self.doc_bits), -1, np.int64)
            place[docs] = np.arange(len(docs))
            self.folded[bits] = out, place
        return self.folded[bits]

    def passing(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The pairs of rows that may reach the threshold (length filter,
        positional filter, suffix filter), and the bits in which they differ."""
        si, sj = self.size[i], self.size[j]
        need = min_overlap(si, sj, self.percent)
        ok = 100 * np.minimum(si, sj) >= self.percent * np.maximum(si, sj)
        ok &= np.minimum(si - self.pos[i], sj - self.pos[j]) >= need
        ok &= self.ids[i] != self.ids[j]
        i, j, need = i[ok], j[ok], need[ok]
        width = np.minimum(self.bits[i], self.bits[j])
        differ = np.zeros(len(i), np.int64)
        for bits in np.unique(width):
            of = np.flatnonzero(width == bits)
            table_, place = self._matrix(int(bits))
            step = max(1, (1 << 22) // int(bits // 8))
            for s in range(0, len(of), step):
                k = of[s:s + step]
                differ[k] = np.bitwise_count(table_[place[self.doc[i[k]]]] ^ table_[place[self.doc[j[k]]]]).sum(axis=1, dtype=np.int64)
        keep = self.size[i] + self.size[j] - differ >= 2 * need
        return i[keep], j[keep], differ[keep]


def _narrowed(bitmap: pa.Buffer, bits: int) -> np.ndarray:
    """A bitmap folded to ``bits`` bits: parities of parities."""
    return np.bitwise_xor.reduce(np.frombuffer(bitmap, "<u8").reshape(-1, bits // 64), axis=0)


def _pair_table(pairs: list[tuple[np.ndarray, np.ndarray]]) -> pa.Table:
    """Rows (a, b), a < b, of pairs held in pieces; the pieces are not copied together."""
    none = np.zeros(0, np.int64)
    low = [pa.array(np.minimum(a, b)) for a, b in pairs or [(none, none)]]
    high = [pa.array(np.maximum(a, b)) for a, b in pairs or [(none, none)]]
    return pa.table({"a": pa.chunked_array(low), "b": pa.chunked_array(high)})


def _hub_pairs(live: DataFrame, bitmaps: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of each list's first set (least position) with the others
    that pass the filters. The hub is an aggregate over the list and is joined
    back to it, so no list is ever one group; bitmaps are looked up once for
    each distinct pair that the length and positional filters leave."""
    hubs = live.groupBy("token").agg(F.min(F.struct("pos", "size", "doc_id")).alias("hub"))
    size, other = F.col("size"), F.col("hub.size")
    need = F.expr(f"((size + hub.size) * {percent} + {99 + percent}) div {100 + percent}")      # min_overlap, in integers
    near = (live.join(hubs, "token").filter(F.col("doc_id") != F.col("hub.doc_id"))
            .filter(100 * F.least(size, other) >= percent * F.greatest(size, other))
            .filter(F.least(size - F.col("pos"), other - F.col("hub.pos")) >= need)
            .select("doc_id", F.col("hub.doc_id").alias("_hub"), "size", other.alias("_size")).distinct())
    with_bits = (near.join(bitmaps, "doc_id").withColumnRenamed("bitmap", "_bits")
                 .join(bitmaps.select(F.col("doc_id").alias("_hub"), "bitmap"), "_hub")
                 .select("doc_id", "_hub", "size", "_size", "_bits", "bitmap"))

    def run(batches):
        for b in batches:
            size, other = (b.column(i).to_numpy().astype(np.int64) for i in (2, 3))
            bits = np.minimum(_bits(size), _bits(other))
            differ = np.fromiter((np.bitwise_count(_narrowed(x.as_buffer(), k) ^ _narrowed(y.as_buffer(), k)).sum()
                                  for x, y, k in zip(b.column(4), b.column(5), bits.tolist())), np.int64, b.num_rows)
            keep = size + other - differ >= 2 * min_overlap(size, other, percent)
            x, y = (b.column(i).to_numpy()[keep] for i in (0, 1))
            yield pa.RecordBatch.from_pydict({"a": np.minimum(x, y), "b": np.maximum(x, y)})
    return with_bits.mapInArrow(frugal(run), _PAIRS).distinct()


def _in_blocks(rows: DataFrame) -> DataFrame:
    """Postings with their ``list`` and ``side``. A token with more than
    ``LIST_ROWS`` postings is dealt to blocks by document and becomes a list for
    every block and for every two blocks (sides 1 and 2, compared with each
    other only), so that no list is long and every two postings meet once."""
    many = (rows.groupBy("token").agg(F.ceil(F.count("*") / LIST_ROWS).cast("int").alias("_n")).filter("_n > 1"))
    mine = F.pmod(F.xxhash64("doc_id"), F.col("_n")).cast("int")
    other = F.explode(F.when(F.col("_n").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("_n") - 1)))
    dealt = rows.join(_small(cut(many)), "token", "left").withColumn("_other", other)
    key = F.xxhash64("token", F.least(mine, "_other"), F.greatest(mine, "_other"))
    side = F.when(F.col("_n").isNull() | (mine == F.col("_other")), 0).when(mine < F.col("_other"), 1).otherwise(2)
    return (dealt.withColumn("list", F.when(F.col("_n").isNull(), F.col("token")).otherwise(key))
            .withColumn("side", side).drop("_n", "_other"))


def _cross_pairs(rows: DataFrame, bitmaps: DataFrame, percent: int, nearest: bool, spark: SparkSession) -> DataFrame:
    """Pairs of each list that lie in different components and pass the
    filters: all of them, or only each set's nearest. Lists are sorted by size
    and compared at growing distance, so only pairs within the length filter
    are looked at and pairs of one component are never kept.

    Lists are packed into parts, as many as the counted postings need; a part
    holds each document's bitmap once."""
    rows = cut(_in_blocks(rows))
    parts = max(shuffle_parts(spark), -(-rows.count() // PART_ROWS))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("list"), F.lit(parts)).cast("int"))
    owners = rows.select("part", "doc_id").distinct().join(bitmaps, "doc_id").toDF("owner", "owner_part", "bits")

    def run(key, postings, bits):
        x = _Lists(postings, bits, percent)
        left, out, d = np.arange(len(x.list)), [], 0
        mate, least = np.full(len(left), -1), np.full(len(left), np.iinfo(np.int64).max)
        while True:
            d += 1
            left = left[left + d < len(x.list)]
            left = left[(x.list[left + d] == x.list[left]) & (100 * x.size[left] >= percent * x.size[left + d])]
            if not len(left):
                break
            apart = left[(x.comp[left] != x.comp[left + d]) & ((x.side[left] == 0) | (x.side[left] != x.side[left + d]))]
            i, j, differ = x.passing(apart, apart + d)
            if not nearest:
                if len(i):
                    out.append((x.ids[i], x.ids[j]))
                continue
            for a, b in ((i, j), (j, i)):
                closer = differ < least[a]
                mate[a[closer]], least[a[closer]] = b[closer], differ[closer]
        if nearest:
            at = np.flatnonzero(mate >= 0)
            at = at[np.lexsort((x.ids[mate[at]], least[at], x.ids[at]))]
            at = at[np.diff(x.ids[at], prepend=x.ids[at[:1]] - 1) != 0]    # one for each document here
            out.append((x.ids[at], x.ids[mate[at]]))
        return _pair_table(out)

    return (rows.select("part", "list", "doc_id", "size", "pos", "component", "side").groupBy("part")
            .cogroup(owners.groupBy("owner_part")).applyInArrow(frugal(run), _PAIRS).distinct())


def _small(rows: DataFrame, most: int = BROADCAST_IDS) -> DataFrame:
    """Rows of a few numbers hinted for broadcast if there are at most ``most``."""
    return F.broadcast(rows) if rows.limit(most + 1).count() <= most else rows


def _whole_sets(docs: DataFrame, ids: DataFrame, n: int) -> DataFrame:
    """(doc_id, shingles binary) of the given documents, sorted hashes."""
    def run(batches):
        for b in batches:
            column = one(pa.chunked_array([b.column(1)]))
            for s, e in chunks(column):
                h, text = shingles(split(column.slice(s, e - s), lower=True), n)
                ends = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=e - s))])
                yield pa.RecordBatch.from_arrays([b.column(0).slice(s, e - s), pa.array(
                    [h[x:y].tobytes() for x, y in zip(ends[:-1], ends[1:])], pa.binary())], ["doc_id", "shingles"])
    chosen = docs.select("doc_id", "text").join(_small(cut(ids)), "doc_id", "left_semi")
    return chosen.mapInArrow(frugal(run), "doc_id bigint, shingles binary").dropDuplicates(["doc_id"])


def _verified(pairs: DataFrame, whole: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sets reach the threshold, each compared once."""
    both = (pairs.join(whole.toDF("a", "set_a"), "a").join(whole.toDF("b", "set_b"), "b").select("a", "b", "set_a", "set_b"))

    def run(batches):
        for b in batches:
            keep = np.zeros(b.num_rows, bool)
            for i, (x, y) in enumerate(zip(b.column(2), b.column(3))):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                common = int(in_sorted(x, y).sum())
                keep[i] = 100 * common >= percent * (len(x) + len(y) - common)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["a", "b"]).filter(pa.array(keep))
    return both.mapInArrow(frugal(run), "a bigint, b bigint")


def jaccard_components(docs: DataFrame, n: int = 5, percent: int = 80, nearest: int = 2) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of documents. The number
    of ``nearest`` rounds changes the work, never the result."""
    if n < 1 or not 0 < percent <= 100:
        raise ValueError("n is at least 1 and percent from 1 to 100")
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    sets, links = _links(docs, n, percent, nearest, by_row=False)
    if links is None:                                  # one id, different texts: join rows, not ids
        row = F.when(F.col("doc_id").isNotNull(), F.col("_key")).alias("_key")
        keyed = cut(with_running_total(docs, [F.asc_nulls_last("doc_id"), F.asc("text")], F.lit(1).cast("bigint"), "_key")
                    .select("doc_id", "text", row))
        sets, links = _links(keyed.select(F.col("_key").alias("doc_id"), "text"), n, percent, nearest, by_row=True)
        ids = keyed.filter("_key is not null").select(F.col("_key").alias("doc_id"), F.col("doc_id").alias("_id"))
        one_id = ids.groupBy("_id").agg(F.min("doc_id").alias("a"))
        same = ids.join(one_id, "_id").filter("doc_id <> a").select("a", F.col("doc_id").alias("b"))
        groups = components(links.unionByName(same)).withColumnRenamed("id", "doc_id")
        rows = (sets.join(ids, "doc_id", "left").join(groups, "doc_id", "left")
                .withColumn("component", F.coalesce("component", "doc_id")))
        low = rows.groupBy("component").agg(F.min("_id").alias("component_id"))
        return (rows.join(low, "component", "left")
                .select(F.col("_id").alias("doc_id"), "n_shingles", "component_id"))
    groups = components(links)
    return (sets.join(groups.withColumnRenamed("id", "doc_id"), "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")))


def _links(docs: DataFrame, n: int, percent: int, nearest: int, by_row: bool) -> tuple[DataFrame, DataFrame | None]:
    """The sets table, and links whose components are those of the whole join
    (None if a doc_id has several different sets and ``by_row`` is False)."""
    spark = docs.sparkSession
    sets = cut(docs.mapInArrow(frugal(_sets(n)), _SETS))
    known = sets.filter("n_shingles > 0 and doc_id is not null")
    if not by_row and not (sets.filter("doc_id is not null").groupBy("doc_id")
                           .agg(F.min("set_lo").alias("x"), F.max("set_lo").alias("y")).filter("x <> y").isEmpty()):
        return sets, None
    key = ["set_hi", "set_lo", "n_shingles"]
    lead = known.groupBy(*key).agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("_far"))
    # one row per group of copies; beyond the bound a skewed join splits hot groups
    copies = _small(cut(lead.filter("rep <> _far").select(*key, "rep")), BROADCAST_IDS // 4)
    equal = cut(known.join(copies, key).filter("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).distinct())
    rarity = spark.sparkContext.broadcast(_counters(docs))          # fixed size: 4 MB
    posted = known.agg(F.sum(F.expr(f"n_shingles - (n_shingles * {percent} + 99) div 100 + 1"))).first()[0] or 0
    parts = max(shuffle_parts(spark), -(-posted // PART_ROWS))
    # only the smallest document of equal sets is posted
    leads = docs.join(_small(equal.select(F.col("a").alias("doc_id"))), "doc_id", "left_anti").select("doc_id", "text")
    live = cut(leads.mapInArrow(frugal(_postings(rarity, n, percent, parts)), _PACKED).groupBy("part")
               .applyInArrow(frugal(_candidates(percent)), "token bigint, doc_id bigint, size int, pos int"))
    bitmaps = known.select("doc_id", "bitmap").dropDuplicates(["doc_id"])

    def verified(found: DataFrame) -> DataFrame:
        ids = found.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
        return cut(_verified(found, _whole_sets(docs, ids, n), percent))

    hub = cut(_hub_pairs(live, bitmaps, percent))
    near, tested = verified(hub), hub
    for only_nearest in [True] * nearest + [False]:
        found = components(near).withColumnRenamed("id", "doc_id")
        here = live.join(found, "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
        apart = here.groupBy("token").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x <> y").select("token")
        cross = _cross_pairs(here.join(apart, "token", "left_semi"), bitmaps, percent, only_nearest, spark)
        cross = cut(cross.join(tested, ["a", "b"], "left_anti"))
        del found, here, apart
        release(spark)
        near, tested = near.unionByName(verified(cross)), tested.unionByName(cross)
    return sets, near.unionByName(equal)


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), n=3, percent=90, nearest=0)


OP8_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 3 THEN list_transform(range(1, len(ws) - 1), lambda i: array_to_string(list_slice(ws, i, i + 2), ' '))
      WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
l AS (SELECT x.doc_id AS a, y.doc_id AS b FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id
      JOIN n na ON na.doc_id = x.doc_id JOIN n nb ON nb.doc_id = y.doc_id
      GROUP BY x.doc_id, y.doc_id, na.n, nb.n HAVING 100 * count(*) >= 90 * (na.n + nb.n - count(*))),
r(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(w.doc_id, coalesce(m.b, w.doc_id))::BIGINT AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a, min(b) AS b FROM r GROUP BY a) m ON m.a = w.doc_id
"""
