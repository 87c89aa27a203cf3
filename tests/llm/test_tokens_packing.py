import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabulon.llm.orc_tokens import read_tokens, token_output, write_tokens
from tabulon.llm.common import shared_folder
from tabulon.llm.packing import best_fit, pack_documents, piece_starts, plan_rounds
from tabulon.llm.tokens import default_vocabulary, encoder

SCHEMA = "doc_id bigint, text string, start string, ids string, length int"
ROWS = [(5, "the cat sat on the mat", "x", "y", 1), (1, None, "x", "y", 1), (3, "", None, None, None), (2, "word " * 3000, "x", "y", 1),
        (4, "naïve 日本 <|endoftext|> café", "x", "y", 1), (5, "the cat sat on the mat", "x", "y", 1), (None, "no id", "x", "y", 1)]


def library(text):
    return encoder(default_vocabulary()).tokenizer.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(max_codepoint=255), st.sampled_from(" \n'st ré日")), max_size=40))
def test_pieces_equal_the_library(text):
    assert encoder(default_vocabulary()).bytes_of(text) == np.array(library(text), "<u4").tobytes()


def test_orc_round_trip_with_odd_rows(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    got = sorted(((r["doc_id"] is not None, r["doc_id"] or 0), r["start"], r["n_tokens"], r["ids_crc32"]) for r in token_output(spark, docs).collect())
    want, at = [], 0
    for d, t, *_ in sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*library(t), 2]
        want.append(((d is not None, d or 0), at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert got == want


def test_orc_empty_table_and_lookup(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    assert token_output(spark, docs.limit(0)).count() == 0
    path = shared_folder(spark, "t")
    write_tokens(docs, path, default_vocabulary())
    found = read_tokens(spark, path, [4, 99])
    assert [r["doc_id"] for r in found.collect()] == [4]
    assert "PushedFilters: [In(doc_id" in found._jdf.queryExecution().executedPlan().toString() or "In(doc_id" in found._jdf.queryExecution().toString()


@given(st.integers(1, 5000), st.integers(1, 64))
def test_pieces_cover_a_document(n, capacity):
    p = piece_starts(n, capacity)
    assert [s for s, _ in p] == list(np.cumsum([0] + [k for _, k in p])[:-1]) and sum(k for _, k in p) == n
    assert all(k == capacity for _, k in p[1:]) and 0 < p[0][1] <= capacity


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 32), max_size=200))
def test_rounds_pack_without_overlap(lengths):
    counts = defaultdict(int)
    for n in lengths:
        counts[n] += 1
    fill, places = defaultdict(int), defaultdict(list)
    for n, first, k, seq, off in plan_rounds(dict(counts), 32):
        places[n] += range(first, first + k)
        for s in range(seq, seq + k):
            assert fill[s] == off and off + n <= 32
            fill[s] += n
    assert {n: sorted(p) for n, p in places.items()} == {n: list(range(c)) for n, c in counts.items()}
    # best fit never needs more than 1.7 times the least number and one more
    assert len(fill) <= 1.7 * -(-sum(lengths) // 32) + 1


def check_packing(rows, capacity):
    by = defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for off, n in sorted(parts):
            assert off == at
            at += n
        assert at <= capacity
    return len(by)


def test_pack_documents(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    rows = pack_documents(docs, capacity=64).collect()
    assert check_packing(rows, 64) <= -(-sum(r["length"] for r in rows) // 64) + 1
    of = defaultdict(list)
    for r in rows:
        of[r["doc_id"]].append(r)
    ids = [*library("word " * 3000), 2]
    parts = sorted(of[2], key=lambda r: r["piece"])
    assert [(r["start"], r["length"]) for r in parts] == piece_starts(len(ids), 64)
    assert all(r["ids_crc32"] == zlib.crc32(np.array(ids[r["start"]:r["start"] + r["length"]], "<u4").tobytes()) for r in parts)
    assert len(of[5]) == 2 and len(of[None]) == 1 and of[1][0]["length"] == 1
    assert pack_documents(docs.limit(0)).count() == 0


def test_many_equal_pieces_and_bad_lengths(spark):
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit(0).alias("piece"), F.lit(7).cast("bigint").alias("ids_crc32"),
                                    F.when(F.col("id") % 3 == 0, 40).otherwise(20).cast("bigint").alias("length"))
    assert check_packing(best_fit(rows, 100).collect(), 100) == 800
    with pytest.raises(ValueError):
        best_fit(rows.withColumn("length", F.lit(101)), 100)


def test_orc_start_follows_the_files_for_repeated_ids(spark):
    """Different texts under one id, also spread over several files."""
    rows = [(1, t) for t in ("a", "mid word here", "zz and a much longer text than the others", "a", None)] + [(2, "b c"), (None, "n"), (0, "zero")]
    rows += [(3, f"text number {i} " * (i % 7)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    path = shared_folder(spark, "t")
    got = token_output(spark, docs, path=path).collect()
    files = read_tokens(spark, path).orderBy("place").collect()
    at, want = 0, []
    for r in files:
        want.append((r["doc_id"], at, len(r["ids"]), zlib.crc32(np.array(r["ids"], "<u4").tobytes())))
        at += len(r["ids"])
    assert sorted(map(str, want)) == sorted(str((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"])) for r in got)
    order = [(r["doc_id"] is not None, r["doc_id"] or 0) for r in files]
    assert order == sorted(order) and len({r["place"] for r in files}) == len(rows)
    assert sorted((d is not None, d or 0, zlib.crc32(np.array([*library(t), 2], "<u4").tobytes())) for d, t in rows) == sorted(
        (r[0] is not None, r[0] or 0, r[3]) for r in want)
