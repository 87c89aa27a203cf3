import random
from collections import defaultdict

import numpy as np
from brute import alignment, jaccard_components, substrings, words

import corpus_pipeline as P
from tabulon.llm.packing import CAPACITY
from tabulon.llm.tokens import default_vocabulary, encoder

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def corpus():
    rng = random.Random(11)
    vocab = ["".join(rng.choice("abcdefgimnorstu") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    prose = lambda n: " ".join(rng.choice(vocab) for _ in range(n)) + "."
    tests = [(i, prose(30)) for i in range(6)]
    passage = prose(60)
    texts = [prose(rng.randint(60, 200)) for _ in range(30)]
    texts += [texts[0], texts[0] + " end", texts[1].replace(" ", "\n", 3)]                  # copies and near copies
    texts += [prose(80) + " " + passage + " " + prose(20), passage + " " + prose(90), passage]  # a repeated passage
    texts += [prose(70) + " " + tests[0][1] + " " + prose(40), tests[1][1].upper() + " " + prose(80)]
    texts += ["BUY!! NOW!! CHEAP!! " * 20, "spam spam spam " * 40, "a*** b$$$ c### d&&& " * 30]   # junk
    texts += [None, "", prose(3000)]
    rows = [(3 * i + 1, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    return [*rows, rows[2], (None, prose(90), "en", "s", 9)], tests


def test_stages_equal_brute_force(spark, tmp_path):
    rows, tests = corpus()
    spark.createDataFrame(tests, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame(rows, SCHEMA)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    got = []
    for name, stage in P.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        if name != P.STAGES[-1][0]:
            assert docs.columns == P.COLUMNS
        got.append([tuple(r) for r in docs.collect()])
    good, single, cut_, clean, packed = got
    assert sorted(good, key=key) == sorted((r for r in rows if not any(x in (r[1] or "") for x in ("!!", "spam", "***"))), key=key)
    of = {}
    for d, _, c in jaccard_components([r[:2] for r in good], 5, 80):
        of[d] = c
    want = sorted({r for r in good if r[0] is None or of[r[0]] == r[0]}, key=key)
    assert sorted(single, key=key) == want and len(want) < len(good) - 3
    left = []
    for r, (d, n, gone, text) in zip(single, substrings([r[:2] for r in single], P.PASSAGE_WORDS)):
        if any(gone) and all(gone):
            continue
        text = text if any(gone) else r[1]
        left.append((d, text, *r[2:4], None if text is None else len(text)))
    assert sorted(cut_, key=key) == sorted(left, key=key) and len(left) == len(single) - 1
    leaked = {r[0] for r in cut_ for _, t in tests if alignment(words(t, True), words(r[1], True)) >= len(words(t))}
    assert sorted(clean, key=key) == sorted((r for r in cut_ if r[0] not in leaked), key=key) and len(leaked) == 2
    tokens = {(r[0], r[1]): len(encoder(default_vocabulary()).tokenizer.encode(r[1] or "", add_special_tokens=False).ids) + 1 for r in clean}
    length, fill = defaultdict(int), defaultdict(list)
    for doc_id, piece, start, n, crc, seq, off in packed:
        length[doc_id] += n
        fill[seq].append((off, n))
    assert sorted(length.values()) == sorted(tokens.values())
    for parts in fill.values():
        parts.sort()
        assert [o for o, _ in parts] == list(np.cumsum([0] + [n for _, n in parts])[:-1]) and sum(n for _, n in parts) <= CAPACITY


def test_decontaminated_rows_without_an_id(spark, tmp_path):
    rows, tests = corpus()
    spark.createDataFrame(tests, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    clean = (None, rows[0][1], "en", "s", 9)
    docs = spark.createDataFrame([clean, (None, tests[0][1], "en", "s", 9), (None, None, "en", "s", 0), rows[1]], SCHEMA)
    left = P.decontaminated(spark, docs, str(tmp_path)).collect()
    assert sorted(map(str, left)) == sorted(str(r) for r in spark.createDataFrame([clean, (None, None, "en", "s", 0), rows[1]], SCHEMA).collect())


def test_run_equals_its_stages_and_takes_an_empty_table(spark, tmp_path):
    rows, tests = corpus()
    spark.createDataFrame(tests, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame(rows, SCHEMA).limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0
    assert len(P.STAGES) == 5 and P.ORACLE_SQL is None
