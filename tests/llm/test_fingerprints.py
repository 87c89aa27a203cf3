import hashlib
import random

import numpy as np

from tabulon.llm import fingerprints as fp

SCHEMA = "doc_id bigint, text string, fingerprint string, _bucket int"


def one_by_one(text):
    letters, steps = fp.letters(text), set(fp.STEPS.tolist())
    i = j = 0
    out = []
    while i < len(letters):
        if j in steps:
            out.append(fp._digits(letters[i:i + 1], np.array([j])).tobytes())
        i += int(fp.COINS[j % 65536][letters[i]])
        j += 1
    return b"".join(out).decode()


def texts():
    rng = random.Random(3)
    out = [None, "", "a", "ab"] + ["".join(rng.choice("abcdé €xyz ") for _ in range(rng.randint(0, 500))) for _ in range(40)]
    return out + [out[10], out[10], out[12][:-1] + "!", "long text. " * 4000]


def test_every_row_equals_a_plain_walk(spark):
    rows = [(7 * i % 53, t, "x", 1) for i, t in enumerate(texts())] + [(3, "again", "x", 1), (None, "no id", "x", 1)]
    got = fp.edited_fingerprints(spark.createDataFrame(rows, SCHEMA)).collect()
    order = sorted(((d, t or "") for d, t, *_ in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    want = []
    for k, (d, t) in enumerate(order):
        n, u = len(t) // 2, order[k - 1][1]
        e = t[:len(t) - n] + u[:n]
        a, b, c = one_by_one(t), one_by_one(e), one_by_one(u)
        want.append((d, len(t), hashlib.sha256(e.encode()).hexdigest(), a, b, fp.likeness(a.encode(), b.encode()), fp.likeness(a.encode(), c.encode())))
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    assert sorted((tuple(r) for r in got), key=key) == sorted(want, key=key)


def test_one_document_and_empty_table(spark):
    one = spark.createDataFrame([(1, "abcdef", "x", 1)], SCHEMA)
    r = fp.edited_fingerprints(one).first()
    assert r["edited_sha256"] == hashlib.sha256(b"abcabc").hexdigest() and r["near_next"] == 1.0
    assert fp.edited_fingerprints(one.limit(0)).count() == 0 and fp.near_classes(one.limit(0)).count() == 0


def test_near_classes(spark):
    rng = random.Random(8)
    base = ["".join(rng.choice("abcdefgh ijkl") for _ in range(900)) for _ in range(5)]
    rows = [(10 * k + i, b if i < 2 else b[:300 + i] + "#" + b[301 + i:], "x", 1) for k, b in enumerate(base) for i in range(4)]
    rows += [(100, None, "x", 1), (101, "", "x", 1), (None, base[0], "x", 1)]
    got = {r["doc_id"]: r["class_id"] for r in fp.near_classes(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(got[10 * k + i] == 10 * k for k in range(5) for i in range(4)) and got[101] == 100 and got[None] == 0


def test_likeness_follows_edits():
    rng = random.Random(1)
    t = "".join(rng.choice("abcdefghijklmnop qrst") for _ in range(3000))
    other = "".join(rng.choice("abcdefghijklmnop qrst") for _ in range(3000))
    few = t[:1000] + "X" + t[1000:2000] + t[2001:]
    half = t[:1500] + other[1500:]
    a, b, c, d = (one_by_one(x).encode() for x in (t, few, half, other))
    assert fp.likeness(a, a) == 1 and fp.likeness(a, b) > 0.9 > 0.7 > fp.likeness(a, c) > 0.4 > 0.2 > fp.likeness(a, d)
