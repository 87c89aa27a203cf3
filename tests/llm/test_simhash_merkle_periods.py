import hashlib
import random
import zlib

import numpy as np
import pytest
import xxhash
from brute import words
from pyspark.sql import functions as F

from tabulon.llm import merkle, simhash
from tabulon.llm.merkle import folded, leaf_hash, merkle_manifest, op12_merkle_manifest, proof_hash
from tabulon.llm.periods import find_runs, op13_periodic_runs, periodic_runs, planted, segments
from tabulon.llm.simhash import fingerprint, op11_simhash_groups, simhash_components, variant_links

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, fp string, row string, runs string, tree string"


def docs_frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z", "t") for r in rows], DOCS)


def some_docs(n=60, seed=3):
    rng = random.Random(seed)
    vocabulary = ["Aa", "bb", "é", "日本", "x\xa0y", "z"] + [f"w{i}" for i in range(30)]
    rows = []
    for i in range(n):
        text = rng.choice([" ", "\n", " \t\x0b"]).join(rng.choice(vocabulary) for _ in range(rng.randint(0, 60)))
        if i % 5 == 0 and rows:
            text = (rows[rng.randrange(len(rows))][1] or "") + rng.choice(["", " tail"])
        rows.append((i * 7 % 1009, text, rng.choice(["en", "de", "é", None]), rng.choice(["web", None]), rng.choice([len(text), None])))
    rows += [(2000, None, "en", "web", None), (2001, "", "lone", "", 0), (2002, " \n", "en", "web", 2), (None, "a b", "en", "web", 3),
             (2003, "one", "de", "web", 3), (2003, "one", "de", "web", 3), (2003, "another text", "de", "web", 12),
             (2004, "long  Words\n" * 30000, "de", "web", 360000), (-5, "A B c d", "en", "web", 7)]
    return rows


# --- SimHash -----------------------------------------------------------------

def plain_fingerprint(text, k=4):
    w = words(text, lower=True)
    grams = [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(fps):
    """Group number (smallest index) of each fingerprint, by all pairs."""
    low = list(range(len(fps)))
    for _ in fps:
        before = list(low)
        for i in range(len(fps)):
            for j in range(i):
                if (fps[i] ^ fps[j]).bit_count() <= 4:
                    low[i] = low[j] = min(low[i], low[j])
        if before == low:
            break
    return low


def test_fingerprint_is_the_majority_of_shingle_hashes(monkeypatch):
    rows = some_docs()
    assert [fingerprint(t.encode() if t is not None else None) for _, t, *_ in rows[:66]] == [plain_fingerprint(t) for _, t, *_ in rows[:66]]
    text = " ".join(f"W{i % 50}" for i in range(3000)) + " " + "v" * 9000 + " end"
    want = plain_fingerprint(text)
    for size in (7, 100, 1 << 20):                  # a text read in pieces has the same fingerprint
        monkeypatch.setattr(simhash, "PIECE_BYTES", size)
        assert fingerprint(text.encode()) == want


def test_fingerprint_hash_is_sparks_own(spark):
    row = spark.createDataFrame([("a b",)], "t string").select(F.xxhash64("t")).first()
    assert row[0] % (1 << 64) == plain_fingerprint("A  b")


def linked_fingerprints(seed, n=400):
    rng = random.Random(seed)
    out = [0, 1, 3, (1 << 64) - 1]
    while len(out) < n:
        x = rng.choice(out) if rng.random() < 0.7 else rng.getrandbits(64)
        for _ in range(rng.randint(0, 6)):
            x ^= 1 << rng.randrange(64)
        out.append(x)
    return sorted(set(out))


@pytest.mark.parametrize("owner_bits, block", [(0, 1 << 22), (0, 5000), (60, 1 << 22)])
def test_variant_links_connect_what_all_pairs_connect(owner_bits, block):
    """Also with variants sorted in many blocks, and with so few bits of the
    variants kept that different ones meet."""
    fps = linked_fingerprints(4, 250)
    x, p = np.array(fps, np.uint64), 8
    low = {f: f for f in fps}

    def root(f):
        while low[f] != f:
            f = low[f]
        return f

    for part in range(1 << p):
        near = np.array([f for f in fps if int(simhash._parities(np.array([f], np.uint64), p)[0] ^ part).bit_count() <= 2], np.uint64)
        links = variant_links(near, part, p, 4, block, owner_bits)
        assert len(links) < max(1, len(near))
        for a, b in links.tolist():
            ra, rb = root(a), root(b)
            low[max(ra, rb)] = min(ra, rb)
    assert [root(f) for f in fps] == [fps[i] for i in plain_components(fps)]
    assert len(x) == len(fps)


def test_simhash_groups_equal_brute_force(spark):
    rows = some_docs()
    text = rows[63][1]
    rows += [(3000 + i, text.replace("Words", f"w{i}", 3), "en", "", 1) for i in range(30)]      # near copies
    fps = [plain_fingerprint(t) for _, t, *_ in rows]
    low = plain_components(fps)
    smallest = {}
    for (d, *_), c in zip(rows, low):
        if d is not None:
            smallest[c] = min(d, smallest.get(c, d))
    want = sorted(((d, f) for d, f in zip([r[0] for r in rows], fps)), key=str)
    got = simhash_components(docs_frame(spark, rows)).collect()
    assert sorted(((r["doc_id"], r["fp"] % (1 << 64)) for r in got), key=str) == want
    of = {(r[0], f): smallest.get(c) for r, f, c in zip(rows, fps, low)}
    assert all(r["component_id"] == of[r["doc_id"], r["fp"] % (1 << 64)] for r in got)
    assert len({r["component_id"] for r in got if (r["doc_id"] or 0) >= 3000}) < 30


def test_simhash_empty_table(spark):
    assert simhash_components(docs_frame(spark, some_docs()).limit(0)).count() == 0


def test_more_parities_give_the_same_groups(spark, monkeypatch):
    rows = [(r[0], r[1], "", "", 0) for r in some_docs(40, 8)]
    frame = docs_frame(spark, rows)
    want = sorted(map(str, simhash_components(frame).collect()))
    monkeypatch.setattr(simhash, "MIN_PARITIES", 10)
    assert sorted(map(str, simhash_components(frame).collect())) == want


# --- Merkle manifest ---------------------------------------------------------

def H(x):
    return hashlib.sha256(x.encode()).hexdigest()


def plain_tree(nodes):
    """(root, path of each node) with runs of eight."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for leaf, i in enumerate(at):
            run = nodes[i // 8 * 8:i // 8 * 8 + 8]
            paths[leaf].append(("".join(run[:i % 8]), "".join(run[i % 8 + 1:])))
        at = [i // 8 for i in at]
        nodes = [H("".join(nodes[i:i + 8])) for i in range(0, len(nodes), 8)]
    return nodes[0], paths


def plain_manifest(rows):
    def leaf(doc_id, text, lang, source, n_chars):
        return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))

    trees = {}
    for r in rows:
        trees.setdefault(r[2], []).append(r)
    names = sorted(trees, key=lambda x: b"0" if x is None else b"1" + x.encode())
    done = []
    for name in names:
        mine = sorted(((r[0] is not None, r[0] or 0, leaf(*r), r) for r in trees[name]), key=lambda x: x[:3])
        done.append((mine, plain_tree([x[2] for x in mine])))
    root, tops = plain_tree([t[0] for _, t in done])
    out = []
    for (mine, (subroot, paths)), top in zip(done, tops):
        for (_, _, h, r), path in zip(mine, paths):
            doc_id, text, *rest = r
            bad = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0 and text is not None
            node = leaf(doc_id, "".join(c.lower() if "A" <= c <= "Z" else c for c in text) if bad else text, *rest)
            for left, right in path + top:
                node = H(left + node + right)
            out.append((doc_id, h, subroot, root, H("".join(a + b for a, b in path + top)), node, node == root))
    return sorted(out, key=str)


@pytest.mark.parametrize("levels", [1, 3])
def test_manifest_equals_plain_trees(spark, monkeypatch, tmp_path, levels):
    """With one level to a block, trees of 20 and more leaves take several storeys."""
    monkeypatch.setattr(merkle, "LEVELS", levels)
    monkeypatch.setattr(merkle, "BLOCK", 8 ** levels)
    rows = some_docs(700 if levels == 1 else 90)
    docs_frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = op12_merkle_manifest(spark, str(tmp_path))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, got.collect()), key=str) == plain_manifest(rows)


def test_manifest_of_one_row_and_of_none(spark, tmp_path):
    frame = docs_frame(spark, [(7, "Text", "en", None, 4)])
    out = merkle_manifest(frame, leaf_hash(F.col("doc_id"), F.col("text")), F.col("lang"), F.col("doc_id"), [F.col("doc_id"), F.col("row")])
    r = out.withColumn("proof", proof_hash(F.col("path"))).withColumn("back", folded(F.col("leaf"), F.col("path"))).first()
    assert r["leaf"] == r["subroot"] == r["root"] == r["back"] == H("1:74:Text") and r["path"] == [] and r["proof"] == H("")
    assert r["row"]["row"] == "y"
    frame.limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert op12_merkle_manifest(spark, str(tmp_path)).count() == 0


# --- periodic runs -----------------------------------------------------------

def plain_runs(ids):
    out = []
    for q in range(1, len(ids) // 4 + 1):
        i = 0
        while i < len(ids) - q:
            j = i
            while j < len(ids) - q and ids[j] == ids[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q) and not any(s <= i and s + n >= j + q for s, n, _ in out):
                out.append((i, j - i + q, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_equal_all_lags():
    rng = random.Random(1)
    for trial in range(1500):
        k, ids = rng.choice([1, 2, 3, 5, 30]), []
        for _ in range(rng.randint(1, 5)):
            ids += [rng.randrange(k) for _ in range(rng.randint(1, 12))] * rng.randint(1, 9)
            if rng.random() < 0.5:
                ids = ids[:rng.randint(0, len(ids))]
        if trial % 50 == 0:
            ids = [rng.randrange(2) for _ in range(400)]
        assert find_runs(np.array(ids, np.int64)) == plain_runs(ids), ids


def test_segments_hold_all_runs_and_no_rare_word():
    rng = random.Random(2)
    for _ in range(200):
        ids = [rng.randrange(12) for _ in range(rng.randint(0, 80))]
        ids += ids[-5:] * 5 + [rng.randrange(99) for _ in range(20)]
        parts = segments(np.array(ids, np.int64))
        for s, e in parts:
            assert e - s >= 6 and all(ids[s:e].count(x) >= 4 for x in ids[s:e])
        assert all(any(s <= a and a + n <= e for s, e in parts) for a, n, _ in plain_runs(ids))


def plain_op13(doc_id, text):
    w = words(text)
    n, h = len(w), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i if i < a else a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    top = sorted(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]))[:1]
    best = (*top[0], 1000 * top[0][1] // top[0][2]) if top else (None,) * 4
    return (doc_id, len(runs), *best, hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest())


def test_periodic_runs_query_equals_plain_version(spark, tmp_path):
    rows = [r for r in some_docs(150, 6) if r[0] != 2004]
    rng = random.Random(4)
    rows += [(4000 + i, " ".join([f"v{rng.randrange(4)}" for _ in range(rng.randint(1, 9))] * rng.randint(1, 8)), "en", "", 0) for i in range(150)]
    docs_frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = op13_periodic_runs(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted((plain_op13(r[0], r[1]) for r in rows), key=str)


def test_periodic_runs_keeps_columns_and_long_texts(spark):
    rows = [*some_docs(5), (1, "a " * 6, "en", "", 0), (1, "a " * 6, "en", "", 0)]
    out = periodic_runs(docs_frame(spark, rows))
    assert out.columns == [*[c for c in docs_frame(spark, rows).columns if c != "runs"], "n_words", "runs", "collapsed_text"]
    by = {}
    for r in out.collect():
        by.setdefault(r["doc_id"], []).append(r)
    assert by[2004][0]["n_words"] == 60000 and [tuple(x) for x in by[2004][0]["runs"]] == [(0, 60000, 2)]
    assert by[2004][0]["collapsed_text"] == "long Words" and by[2000][0]["collapsed_text"] == "" and by[2000][0]["runs"] == []
    assert len(by[1]) == 2 and by[1][0]["collapsed_text"] == "a" and by[None][0]["collapsed_text"] == "a b"
    assert periodic_runs(docs_frame(spark, rows).limit(0)).count() == 0


def test_planting_leaves_other_texts_alone(spark):
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0][:3]
    frame = spark.createDataFrame([(i, t) for i in [*ids, 1, None] for t in ("a  b", "", None)], "doc_id bigint, text string")
    got = frame.withColumn("p", planted(F.col("doc_id"), F.col("text"))).collect()
    assert all(r["p"] == r["text"] for r in got if r["doc_id"] not in ids or not r["text"])
    assert {len(words(r["p"])) for r in got if r["text"] == "a  b"} == {2}


def test_sf_tables(spark):
    """On a given table: fingerprints and groups against all pairs of distinct fingerprints."""
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    fps = {r["doc_id"]: plain_fingerprint(r["text"]) for r in rows}
    distinct = sorted(set(fps.values()))
    low = dict(zip(distinct, plain_components(distinct)))
    smallest = {}
    for d, f in fps.items():
        smallest[low[f]] = min(d, smallest.get(low[f], d))
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in op11_simhash_groups(spark, sf).collect()}
    assert got == {d: (f"{f:016x}", smallest[low[f]]) for d, f in fps.items()}
