"""Whole-text tokenisation inside Arrow batches with a public vocabulary file."""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

END_ID = 2
_CACHE_PIECES = 1 << 19
_ONCE_PIECES = 1 << 17

# Letters, digits and white space of Latin-1, for the published
# splitting pattern of byte-level vocabularies.
_L = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff"
_N = "0-9\xb2\xb3\xb9\xbc-\xbe"
_S = "\t-\r \x85\xa0"
_SPLIT = re.compile(rf"'(?:[stmd]|re|ve|ll)| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_letters() -> dict[int, str]:
    """The printable letter that byte-level vocabularies use for each byte:
    printable Latin-1 bytes are themselves, the others follow from U+0100."""
    out, n = {}, 0
    for b in range(256):
        if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b:
            out[b] = chr(b)
        else:
            out[b], n = chr(256 + n), n + 1
    return out


class _Pieces(dict):
    """Piece of text -> its ids as little-endian unsigned 32-bit bytes. A piece
    stays once it was seen twice; pieces seen once are kept for a while only."""

    def __init__(self, tokenizer):
        super().__init__()
        self.merge = tokenizer.model.tokenize
        self.letters = _byte_letters()
        self.once: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        known = self.once.pop(piece, None)
        if known is not None:
            if len(self) >= _CACHE_PIECES:
                self.clear()
            self[piece] = known
            return known
        ids = [t.id for t in self.merge(piece.encode().decode("latin-1").translate(self.letters))]
        packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(self.once) >= _ONCE_PIECES:
            self.once.clear()
        self.once[piece] = packed
        return packed


class Encoder:
    """``bytes_of(text)``: ids of the tokenizers library, no special tokens added.

    A byte-level vocabulary encodes each piece of the published splitting
    pattern alone, so Latin-1 texts are split here and the library's model
    merges each distinct piece once. Any other text, and texts that hold the
    string of an added token, go to the library whole."""

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer
        import json
        self.tokenizer = Tokenizer.from_file(vocabulary)
        with open(vocabulary, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        self.by_piece = (pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
                         and spec.get("normalizer") is None and spec["model"].get("type", "BPE") == "BPE")
        added = [re.escape(t["content"]) for t in spec.get("added_tokens", [])]
        self.added = re.compile("|".join(added)) if added else None
        self.pieces = _Pieces(self.tokenizer)

    def bytes_of(self, text: str) -> bytes:
        if self.by_piece and not (self.added and self.added.search(text)):
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                pass
            else:
                return b"".join(map(self.pieces.__getitem__, _SPLIT.findall(text)))
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


_ENCODERS: dict[str, Encoder] = {}


def encoder(vocabulary: str) -> Encoder:
    """One encoder per Python worker and vocabulary."""
    if vocabulary not in _ENCODERS:
        _ENCODERS[vocabulary] = Encoder(vocabulary)
    return _ENCODERS[vocabulary]


def document_ids(texts: pa.Array, vocabulary: str, end_id: int = END_ID) -> Iterator[bytes]:
    """Ids of each text (null: empty) with the end id, as unsigned 32-bit bytes."""
    enc, end = encoder(vocabulary), np.array([end_id], "<u4").tobytes()
    for text in texts:
        yield enc.bytes_of(text.as_py() or "") + end


def token_rows(docs: DataFrame, vocabulary: str, end_id: int = END_ID) -> DataFrame:
    """(doc_id, place, ids array<int>) for each row of documents (doc_id, text,
    place), partitioning kept."""
    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                ids = list(document_ids(part.column(1), vocabulary, end_id))
                ends = np.cumsum([0] + [len(x) // 4 for x in ids]).astype("int32")
                values = pa.array(np.frombuffer(b"".join(ids), "<u4").astype("int32"))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.ListArray.from_arrays(pa.array(ends), values)],
                                                 ["doc_id", "place", "ids"])
    return docs.select("doc_id", "text", "place").mapInArrow(run, "doc_id bigint, place bigint, ids array<int>")


def crc32(ids: bytes) -> int:
    return zlib.crc32(ids) & 0xFFFFFFFF
