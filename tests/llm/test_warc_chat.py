import hashlib
import io
import struct
import zipfile

import duckdb
import pandas as pd
import pytest

from tabulon.llm import chat, warc
from tabulon.llm.common import shared_folder


def pages():
    a, b = "<p>" + "x" * 1200, "é" * 600
    rows = [(1, "http://a", a), (2, "http://b", a), (9, "http://c", a), (3, "http://d", "short"), (4, "http://e", "short"), (5, None, None),
            (6, "http://f\r\nX: y", b), (7, "http://g", b), (8, "http://h", "\r\n\r\n" + "z" * 500_000), (None, "http://i", a), (9, "http://c", a)]
    return rows, "page_id bigint, url string, html string"


def expected(rows):
    top = {}
    for i, _, h in rows:
        n = len((h or "").encode())
        if n >= 1000:
            top[h] = max(top.get(h, -1), -1 if i is None else i)
    out = []
    for i, _, h in rows:
        raw = (h or "").encode()
        to = top[h] if len(raw) >= 1000 and top[h] > (-1 if i is None else i) else None
        out.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "response" if to is None else "revisit", to))
    return sorted(out, key=str)


def test_records_round_trip(spark):
    rows, schema = pages()
    df = spark.createDataFrame(rows, schema).repartition(3)
    manifest = warc.write_archives(df, shared_folder(spark, "w"))
    back = warc.read_archives(manifest).collect()
    assert sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in back), key=str) == expected(rows)
    html = {i: (h or "").encode() for i, _, h in rows}
    assert all(bytes(r["payload"]) == html[r["page_id"]] for r in back if r["record_type"] == "response")
    assert all(r["payload"] is None for r in back if r["record_type"] == "revisit")
    some = warc.read_archives(manifest, [8, 5]).collect()
    assert sorted(r["page_id"] for r in some) == [5, 8]
    assert warc.read_archives(warc.write_archives(df.limit(0), shared_folder(spark, "w"))).count() == 0


@pytest.mark.parametrize("members", [3, 70_000])
def test_directory_and_zip64(members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        for i in range(members):
            z.writestr(f"m{i}", b"data%d" % i)
        z.writestr(zipfile.ZipInfo("packed"), b"x" * 100, compress_type=zipfile.ZIP_DEFLATED)
        z.comment = b"PK\x05\x06 in a comment"
    f = io.BytesIO(out.getvalue())
    found = warc.directory(f, len(out.getvalue()))
    assert len(found) == members + 1
    at, n = warc.stored_range(f, found["m2"])
    f.seek(at)
    assert f.read(n) == b"data2"
    with pytest.raises(ValueError):
        warc.stored_range(f, found["packed"])


def test_zip64_fields_of_a_member():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        z.writestr("a", b"hello")
    raw = out.getvalue()
    at = raw.rfind(b"PK\x01\x02")
    local = struct.unpack_from("<I", raw, at + 42)[0]
    entry = bytearray(raw[at:raw.rfind(b"PK\x05\x06")])
    struct.pack_into("<II", entry, 20, 0xFFFFFFFF, 0xFFFFFFFF)
    struct.pack_into("<I", entry, 42, 0xFFFFFFFF)
    extra = struct.pack("<HHQQQ", 1, 24, 5, 5, local)
    struct.pack_into("<H", entry, 30, len(extra))
    central = bytes(entry) + extra
    end64 = struct.pack("<4sQHHIIQQQQ", b"PK\x06\x06", 44, 45, 45, 0, 0, 1, 1, len(central), at)
    locator = struct.pack("<4sIQI", b"PK\x06\x07", 0, at + len(central), 1)
    end = struct.pack("<4sHHHHIIH", b"PK\x05\x06", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    whole = raw[:at] + central + end64 + locator + end
    f = io.BytesIO(whole)
    entry = warc.directory(f, len(whole))["a"]
    start, n = warc.stored_range(f, entry)
    assert whole[start:start + n] == b"hello"
    with pytest.raises(ValueError):
        warc.directory(io.BytesIO(b"not a zip"), 9)


TALKS = [(1, 0, "system", "be kind"), (1, 1, "user", "a\\b <|im_end|>\n <\\|x"), (1, 2, "assistant", chat.FORGED + "\\"),
         (2, 0, "assistant", "first"), (3, 1, "assistant", "b"), (3, 0, "user", "a"), (3, 1, "assistant", "a"), (4, 0, "user", None),
         (4, 1, None, "x"), (5, 0, "user", ""), (5, 1, "assistant", ""), (6, 0, "weird<|im_sep|>\n", "y"), (None, None, "user", "z"),
         (7, None, "user", "q"), (7, 5, "assistant", "long " * 50_000)]
TALK_SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def test_chat_equals_sql_and_round_trips(spark):
    df = spark.createDataFrame(TALKS, TALK_SCHEMA)
    talks = chat.format_conversations(df)
    back = {r["conv_id"]: [(t["role"], t["text"]) for t in r["turns"]] for r in talks.select("conv_id", chat.parse(talks["formatted"]).alias("turns")).collect()}
    for c in back:
        rows = sorted(((t is not None, t or 0, r or "", x or "") for k, t, r, x in TALKS if k == c))
        assert back[c] == [(r, x) for _, _, r, x in rows]
    con = duckdb.connect()
    con.register("talks", pd.DataFrame([t for t in TALKS if t[1] is not None], columns=["conv_id", "turn", "role", "text"]))
    con.execute("create view conversations as select conv_id::bigint conv_id, turn::bigint turn, role, text from talks")
    sql = con.execute("select * from (" + chat.OP2_SQL + ") where conv_id >= 0").fetchall()
    have = [tuple(r) for r in chat.read_back(chat.format_conversations(df.filter("turn is not null"))).filter("conv_id is not null").collect()]
    assert sorted(have) == sorted(sql)
    valid = {r["conv_id"]: r["valid"] for r in talks.collect()}
    assert [valid[c] for c in (1, 2, 3, 4, 5, 6, 7, None)] == [True, False, False, False, True, False, True, False]
    assert chat.read_back(chat.format_conversations(df.limit(0))).count() == 0


def test_chat_runs_without_python(spark):
    plan = chat.read_back(chat.format_conversations(spark.createDataFrame(TALKS, TALK_SCHEMA)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan.replace("ExistingRDD", "") and "Arrow" not in plan


def test_template_and_machine_are_parameters(spark):
    template = {"*": [(("[", chat.ROLE, "]"), False), ((chat.TEXT,), True)]}
    df = spark.createDataFrame([(1, 0, "a", "x"), (1, 1, "b", "y")], TALK_SCHEMA)
    r = chat.format_conversations(df, template, {"start": {"a": "s1"}, "s1": {"b": "done"}}, ("done",)).first()
    assert r["formatted"] == "[a]x[b]y" and r["valid"] and [s["loss"] for s in r["segments"]] == [False, True, False, True]
