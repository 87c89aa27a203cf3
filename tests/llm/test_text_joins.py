import random
import re
from pathlib import Path

from brute import alignment, jaccard_components as brute_components, substrings as brute_substrings, words
import numpy as np
from pyspark.sql import functions as F

from tabulon.llm.common import components, frugal
from tabulon.llm.decontaminate import contaminated, local_alignment
from tabulon.llm.jaccard import jaccard_components
from tabulon.llm.substrings import dedup_substrings

SCHEMA = "doc_id bigint, text string, component string, n_words string, part int, a int"
VOCAB = [f"w{i}" for i in range(40)] + ["The", "the", "é", "a\xa0b"]


def corpus(seed=5, n=70):
    rng = random.Random(seed)
    base = [[rng.choice(VOCAB) for _ in range(rng.randint(0, 90))] for _ in range(12)]
    shared = [rng.choice(VOCAB) for _ in range(30)]
    rows = []
    for i in range(n):
        w = list(rng.choice(base))
        for _ in range(rng.randint(0, 3)):
            if w:
                w[rng.randrange(len(w))] = rng.choice(VOCAB)
        if rng.random() < 0.3:
            at = rng.randint(0, len(w))
            w = w[:at] + shared + w[at:]
        rows.append((i * 3 % 101, rng.choice([" ", "\n", " \t "]).join(w)))
    rows += [(200, None), (201, ""), (202, " \n"), (203, "one"), (204, "ONE"), (205, "one two"), (None, rows[0][1]), (206, rows[0][1]),
             (207, "long " * 30000)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "c", "n", 1, 2) for d, t in rows], SCHEMA)


def got_components(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def test_jaccard_equals_brute_force(spark):
    rows = corpus()
    assert got_components(jaccard_components(frame(spark, rows), 3, 90)) == brute_components(rows, 3, 90)
    assert got_components(jaccard_components(frame(spark, rows), 5, 80)) == brute_components(rows, 5, 80)


def test_jaccard_many_near_copies(spark):
    rng = random.Random(9)
    base = [f"x{rng.randrange(500)}" for _ in range(120)]
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(rng.randint(0, 6)):
            w[rng.randrange(len(w))] = f"y{rng.randrange(10 ** 6)}"
        rows.append((i, " ".join(w)))
    for nearest in (0, 2):
        assert got_components(jaccard_components(frame(spark, rows), 3, 90, nearest)) == brute_components(rows, 3, 90)


def test_jaccard_repeated_ids_and_empty_table(spark):
    rows = [*corpus(2, 30), (0, "another text under the same id"), (0, "another text under the same id"), (9, "one two three four")]
    assert got_components(jaccard_components(frame(spark, rows), 3, 90)) == brute_components(rows, 3, 90)
    assert jaccard_components(frame(spark, rows).limit(0), 3, 90).count() == 0


def test_substrings_equal_brute_force(spark):
    rows = corpus(7)
    got = dedup_substrings(frame(spark, rows), threshold=13)
    assert got.columns[:2] == ["doc_id", "text"] and "a" in got.columns
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[3])
    want = sorted(brute_substrings(rows, 13), key=key)
    have = sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"], [tuple(x) for x in r["repeats"]]) for r in got.collect()), key=key)
    assert [(d, n, sum(g), t) for d, n, g, t in want] == [h[:4] for h in have]
    for (_, n, gone, _), h in zip(want, have):
        flags = [False] * n
        for s, k in h[4]:
            assert k >= 13 and (s == 0 or not gone[s - 1]) and (s + k == n or not gone[s + k])
            flags[s:s + k] = [True] * k
        assert flags == gone
    assert dedup_substrings(frame(spark, rows).limit(0)).count() == 0


def test_substrings_repeated_ids_do_not_remove_each_other(spark):
    text = " ".join(f"t{i}" for i in range(20))
    rows = [(1, text), (1, text), (2, "x " + text)]
    got = sorted((r["doc_id"], r["n_removed"]) for r in dedup_substrings(frame(spark, rows)).collect())
    assert got == [(1, 0), (1, 0), (2, 20)]


def test_local_alignment_equals_brute_force():
    rng = np.random.default_rng(3)
    item = rng.integers(0, 6, 15).astype(np.uint64)
    sizes = rng.integers(0, 30, 40)
    grid = rng.integers(0, 6, (40, 30)).astype(np.uint64)
    score, end = local_alignment(item, grid, sizes)
    for i in range(40):
        assert score[i] == alignment(item.tolist(), grid[i, :sizes[i]].tolist()) and end[i] <= sizes[i]


def test_decontamination(spark):
    rng = random.Random(4)
    text = lambda n: " ".join(rng.choice(VOCAB[:40]) + rng.choice("abcdefgh") for _ in range(n))
    tests = [(i, text(30)) for i in range(12)] + [(50, "Tiny"), (51, None), (52, ""), (None, text(25))]
    edited = words(tests[1][1])
    for i in (4, 9, 15, 22):
        edited[i] = "changed"
    del edited[12]
    docs = [(0, f"{text(40)}\n{tests[0][1].upper()} {text(200)}"), (1, f"{text(60)} {' '.join(edited)}"), (2, text(500)), (3, None), (4, ""),
            (5, "tiny"), (6, " ".join(words(tests[2][1])[:8]) + text(50)), (None, tests[3][1]), (7, tests[4][1] + " " + tests[5][1]),
            (8, text(20000) + " " + tests[-1][1]), (9, tests[0][1]), (9, tests[0][1])]
    bench = spark.createDataFrame([(i, t, 1) for i, t in tests], "item_id bigint, text string, doc_id int")
    got = {(r["doc_id"], r["item_id"]): r for r in contaminated(frame(spark, docs), bench).collect()}
    want = set()
    for d, t in docs:
        for i, u in tests:
            item = words(u, lower=True)
            if item and alignment(item, words(t, lower=True)) >= len(item):
                want.add((d, i))
    assert set(got) == want and (2, 0) not in want and (1, 1) in want
    assert got[0, 0]["score"] == 1.0 and (got[0, 0]["start"], got[0, 0]["end"]) == (40, 70)
    blocks = contaminated(frame(spark, docs), bench, item_bytes=600)
    assert {(r["doc_id"], r["item_id"]) for r in blocks.collect()} == want
    assert contaminated(frame(spark, docs).limit(0), bench).count() == 0
    assert contaminated(frame(spark, docs), bench.limit(0)).count() == 0


def test_decontamination_of_dense_edits_and_short_items(spark):
    rng = random.Random(9)
    text = lambda n: [rng.choice(VOCAB[:40]) + rng.choice("abcdefgh") for _ in range(n)]
    tests = [text(30) for _ in range(6)] + [text(n) for n in (1, 2, 3, 4, 5, 7, 12)]
    docs = [text(150) for _ in range(10)]
    for item in tests:
        for every in (2, 3, 4):
            more = [x for i, w in enumerate(item) for x in ([w, f"extra{i}"] if (i + 1) % every == 0 else [w])]
            other = [f"other{i}" if (i + 1) % every == 0 else w for i, w in enumerate(item)]
            less = [w for i, w in enumerate(item) if (i + 1) % every]
            docs += [text(40) + x + text(40) for x in (more, other, less)]
        docs += [text(20) + item + text(20), item]                # verbatim copies beside the edited ones
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(tests)], "item_id bigint, text string")
    got = contaminated(frame(spark, [(i, " ".join(t)) for i, t in enumerate(docs)]), bench).collect()
    want = {}
    for d, t in enumerate(docs):
        for i, item in enumerate(tests):
            score = alignment(item, t)
            if score >= len(item):
                want[d, i] = score / (2 * len(item))
    assert {(r["doc_id"], r["item_id"]): r["score"] for r in got} == want and len(want) > 100


def test_components_long_chain(spark):
    links = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).union(
        spark.createDataFrame([(1000, 1001), (1001, 1001), (None, 4)], "a bigint, b bigint"))
    got = {r["id"]: r["component"] for r in components(links.repartition(16)).collect()}
    assert got == {**dict.fromkeys(range(301), 0), 1000: 1000, 1001: 1000}
    assert components(links.limit(0)).count() == 0


def test_jaccard_long_lists_are_compared_in_blocks(spark, monkeypatch):
    from tabulon.llm import jaccard
    monkeypatch.setattr(jaccard, "LIST_ROWS", 5)
    monkeypatch.setattr(jaccard, "PART_ROWS", 20)
    rows = corpus(11, 60)
    for nearest in (0, 1):
        assert got_components(jaccard_components(frame(spark, rows), 3, 60, nearest)) == brute_components(rows, 3, 60)


def test_decontamination_counts_words_over_all_documents(spark, monkeypatch):
    """Which words are rare is counted over every document, however many bytes they have."""
    from tabulon.llm import decontaminate
    monkeypatch.setattr(decontaminate, "SAMPLE_BYTES", 200, raising=False)
    seen, init = [], decontaminate.Items.__init__
    monkeypatch.setattr(decontaminate.Items, "__init__", lambda self, w, threshold, seed, df: (seen.append(df.tolist()), init(self, w, threshold, seed, df))[1])
    bench = spark.createDataFrame([(1, "alpha beta gamma delta")], "item_id bigint, text string")
    docs = frame(spark, [(i, "alpha beta " + "other words here " * 3) for i in range(100)] + [(100, None)])
    assert decontaminate.contaminated(docs, bench).count() == 100
    assert sorted(seen[0]) == [0, 0, 100, 100]


def test_workers_give_back_the_memory_of_a_task():
    held = lambda: int(re.search(r"RssAnon:\s+(\d+)", Path("/proc/self/status").read_text())[1]) / 1024

    def task(batches):
        for b in batches:
            parts = [np.ones(12_000) for _ in range(1000)]       # 96 MB, each below what malloc maps on its own
            keep.append(parts[-1])                               # lies above what is freed
            yield b

    keep, before = [], held()
    assert list(frugal(task)([1])) == [1] and held() < before + 40
    assert frugal(lambda key, group: key + group)(1, 2) == 3 and frugal(lambda key, a, b: key + a + b)(1, 2, 3) == 6
