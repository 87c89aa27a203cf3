"""Near duplicates by SimHash: fingerprints of word shingles, linked where they
differ in few bits, and the connected groups of these links.

Links are found by meeting in the middle. Two fingerprints at distance 2r or
less have a word at distance r or less from both, so every fingerprint emits
all variants with up to r flipped bits, and equal variants meet. Members of one
variant are within 2r of each other, so each is linked to the first of them
only; every link is verified by its distance, and a task keeps a spanning
forest of its links, so a group of near copies never becomes all its pairs.

Variants are not shipped one by one. A variant belongs to the part that is
named by the parities of ``p`` interleaved groups of its bits; flipping up to r
bits changes up to r parities, so a fingerprint goes once to each of
1 + p + p(p-1)/2 parts (r = 2) and its variants of that part are made there. All bits count
in the parities, so a cluster of near copies spreads over the parts as other
fingerprints do. ``p`` grows with the counted number of distinct fingerprints,
and a part is gone through in blocks of variants of a bounded number.

Copies collapse to one fingerprint before anything is emitted.

Defined results: null, empty and white-space texts have fingerprint 0 and are
linked like any other; a text of fewer words than a shingle is one shingle;
texts of any length are read in pieces; rows that repeat a doc_id are rows of
their own; rows with a null doc_id take part in links, but a group is named by
its smallest id that is not null (null if it has none); an empty table gives no
rows. Of the input only doc_id and text are read, so that extra columns cannot
clash."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, cut, shuffle_parts, table
from .words import mix

BITS, WORDS, MOST_DIFFERENT, SEED = 64, 4, 4, 42
PART_VARIANTS = 1 << 22       # variants that a part holds on average, while there are at most MAX_PARITIES
BLOCK_VARIANTS = 1 << 22      # variants sorted together in a task
MIN_PARITIES, MAX_PARITIES = 8, 20
PIECE_BYTES = 1 << 20         # of a text, hashed together
BROADCAST_ROWS = 1 << 16      # of (fingerprint, group); beyond that a shuffle join
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def _pieces(text: memoryview) -> Iterator[list[bytes]]:
    """The words of a text, some at a time; words are never cut."""
    at, n = 0, len(text)
    while at < n:
        to = min(at + PIECE_BYTES, n)
        piece = bytes(text[at:to])
        while to < n and not piece[-1:].isspace():      # up to the end of the word
            more = bytes(text[to:to + 4096])
            rest = more.split(None, 1)[0] if not more[:1].isspace() else b""
            piece += rest or more[:1]
            to += len(rest) or 1
        at = to
        yield piece.translate(_LOWER).split()


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    return np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)


def fingerprint(text: memoryview | bytes | None, k: int = WORDS) -> int:
    """SimHash of a UTF-8 text: a bit is 1 if it is set in over half the XXH64
    hashes of its k-word shingles, repeats included."""
    digest = xxhash.xxh64_intdigest
    ones, n, carry = np.zeros(BITS, np.int64), 0, []
    for words in _pieces(memoryview(text or b"")):
        words = carry + words
        if len(words) >= k:
            joined = b" ".join(words)
            ends = np.cumsum([len(w) + 1 for w in words])
            starts = np.r_[0, ends[:-1]].tolist()
            h = [digest(joined[s:e], SEED) for s, e in zip(starts, (ends[k - 1:] - 1).tolist())]
            ones += _bit_counts(np.array(h, np.uint64))
            n += len(h)
            words = words[len(words) - k + 1:]
        carry = words
    if not n and carry:
        ones, n = _bit_counts(np.array([digest(b" ".join(carry), SEED)], np.uint64)), 1
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def _fingerprints(batches):
    for b in batches:
        out = np.fromiter((fingerprint(t.as_buffer() if t.is_valid else None) for t in b.column(1)), np.uint64, b.num_rows)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out.view(np.int64))], ["doc_id", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text) -> (doc_id, fp): fp is the fingerprint's bits as a bigint."""
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(_fingerprints, "doc_id bigint, fp bigint")


def _masks(radius: int) -> np.ndarray:
    """All words with up to ``radius`` bits set."""
    out = [sum(1 << i for i in c) for r in range(radius + 1) for c in combinations(range(BITS), r)]
    return np.array(out, np.uint64)


def _parities(x: np.ndarray, p: int) -> np.ndarray:
    """The parities of bits i, i + p, i + 2p, ... for i below p, as a number."""
    out = np.zeros(x.shape, np.uint64)
    for s in range(0, BITS, p):
        out ^= x >> np.uint64(s)
    return (out & np.uint64((1 << p) - 1)).astype(np.int64)


def _masks_by_part(radius: int, p: int) -> dict[int, np.ndarray]:
    masks = _masks(radius)
    part = _parities(masks, p)
    order = np.argsort(part, kind="stable")
    values, first = np.unique(part[order], return_index=True)
    return dict(zip(values.tolist(), np.split(masks[order], first[1:])))


def _scrambled(x: np.ndarray) -> np.ndarray:
    """A random map of 64 bits that is linear in XOR, so that the image of a
    variant is the image of its fingerprint XOR that of the flipped bits."""
    out = np.zeros(x.shape, np.uint64)
    for i in range(8):
        out ^= _TABLES[i][((x >> np.uint64(8 * i)) & np.uint64(255)).astype(np.int64)]
    return out


def _tables() -> np.ndarray:
    columns = mix(np.arange(1, BITS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).reshape(8, 8)
    out = np.zeros((8, 256), np.uint64)
    for bit in range(8):
        out ^= np.where(np.arange(256) >> bit & 1, columns[:, bit:bit + 1], np.uint64(0))
    return out


with np.errstate(over="ignore"):
    _TABLES = _tables()


def _spanning(links: np.ndarray) -> np.ndarray:
    """Links (n, 2) replaced by (node, smallest node that it reaches)."""
    nodes, at = np.unique(links, return_inverse=True)
    at = at.reshape(links.shape)
    low = np.arange(len(nodes))
    while True:
        least = low[at].min(1)
        new = low.copy()
        np.minimum.at(new, low[at[:, 0]], least)
        np.minimum.at(new, low[at[:, 1]], least)
        new = np.minimum(new, new[new])
        new = new[new]
        if (new == low).all():
            break
        low = new
    moved = np.flatnonzero(low != np.arange(len(nodes)))
    return np.stack([nodes[moved], nodes[low[moved]]], 1)


def variant_links(fps: np.ndarray, part: int, p: int, most: int, block: int = BLOCK_VARIANTS, owner_bits: int = 0) -> np.ndarray:
    """Links (n, 2) that connect the distinct fingerprints which share a variant
    of this part and differ in at most ``most`` bits.

    Variants are sorted about ``block`` at a time, as their scrambled value
    with the number of the fingerprint in place of the lowest bits (at least
    ``owner_bits``), so that one sort brings equal variants together. Each
    member of a variant is linked to its first one. Different variants that
    agree in all other bits meet by chance; some link is then too long, and
    all pairs of that meeting are compared."""
    masks = _masks_by_part(-(-most // 2), p)
    away = _parities(fps, p) ^ part
    width = max(owner_bits, int(len(fps)).bit_length())
    owner = np.uint64((1 << width) - 1)
    base = (_scrambled(fps) & ~owner) | np.arange(len(fps), dtype=np.uint64)
    rows = [(base[away == d], _scrambled(masks[d]) & ~owner) for d in np.unique(away).tolist()]
    total = sum(len(x) * len(m) for x, m in rows)
    cuts = 1 << max(0, int(np.ceil(np.log2(max(total, 1) / block))))
    found = np.zeros((0, 2), np.uint64)
    for low in range(cuts):
        variants = []
        for x, m in rows:
            step = max(1, block // len(m))
            for c in range(0, len(x), step):
                v = (x[c:c + step, None] ^ m[None, :]).ravel()
                variants.append(v if cuts == 1 else v[(v >> np.uint64(40)) & np.uint64(cuts - 1) == low])
        key = np.concatenate(variants) if variants else np.zeros(0, np.uint64)
        del variants
        key.sort()
        same = (key[1:] ^ key[:-1]) <= owner              # equal but for the owner
        at = np.flatnonzero(same)
        if not len(at):
            continue
        first = np.flatnonzero(np.diff(at, prepend=-2) > 1)
        least = np.repeat(at[first], np.diff(np.r_[first, len(at)]))
        a = fps[(key[at + 1] & owner).astype(np.int64)]
        b = fps[(key[least] & owner).astype(np.int64)]
        near = np.bitwise_count(a ^ b) <= most
        links = [found, np.stack([a[near], b[near]], 1)]
        for f in np.unique(least[~near]).tolist():
            m = np.unique(np.r_[b[least == f][:1], a[least == f]])
            for i in range(1, len(m)):
                close = m[:i][np.bitwise_count(m[:i] ^ m[i]) <= most]
                links.append(np.stack([np.full(len(close), m[i]), close], 1))
        found = _spanning(np.concatenate(links))
    return found


def fingerprint_links(fps: DataFrame, n: int, most: int = MOST_DIFFERENT) -> DataFrame:
    """Links (a, b) that connect all fingerprints (distinct fp bigint, n of
    them) which differ in ``most`` bits or fewer."""
    radius = -(-most // 2)
    parts = n * len(_masks(radius)) / PART_VARIANTS
    p = min(MAX_PARITIES, max(MIN_PARITIES, int(np.ceil(np.log2(max(parts, 1))))))
    deltas = np.array(sorted(_masks_by_part(radius, p)), np.int64)

    def emit(batches):
        for b in batches:
            x = b.column(0).to_numpy().view(np.uint64)
            part = (_parities(x, p)[:, None] ^ deltas[None, :]).ravel()
            x = np.repeat(x, len(deltas))
            order = np.argsort(part, kind="stable")
            values, first = np.unique(part[order], return_index=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(values, pa.int64()), pa.array([k.tobytes() for k in np.split(x[order], first[1:])], pa.binary())],
                ["part", "fps"])

    def meet(key, rows):
        x = np.concatenate([np.frombuffer(k, np.uint64) for k in rows.column("fps").to_pylist()])
        links = variant_links(np.unique(x), key[0].as_py(), p, most).view(np.int64)
        return pa.table({"a": pa.array(links[:, 0]), "b": pa.array(links[:, 1])})

    return (fps.select("fp").mapInArrow(emit, "part bigint, fps binary")
            .repartition(min(1 << p, 8 * shuffle_parts(fps.sparkSession)), "part")
            .groupBy("part").applyInArrow(meet, "a bigint, b bigint"))


def simhash_components(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text) -> (doc_id, fp, component_id), a row for each row."""
    each = cut(fingerprints(docs))
    classes = cut(each.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    linked = components(fingerprint_links(classes, classes.count()))
    named = (classes.join(linked, F.col("fp") == F.col("id"), "left")
             .select("fp", "first_id", F.coalesce("component", "fp").alias("component")))
    smallest = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = cut(named.join(smallest, "component").select("fp", "component_id"))
    named = F.broadcast(named) if named.count() <= BROADCAST_ROWS else named
    return each.join(named, "fp").select("doc_id", "fp", "component_id")


def op11_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents: fingerprints of 4-word shingles
    that differ in 4 bits or fewer."""
    found = simhash_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
