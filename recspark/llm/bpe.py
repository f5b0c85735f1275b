"""Byte-level BPE encoding by overlapping chunks, and decoding.

A text is split by a pattern into pre-tokens and each is encoded by the ranks
of a vocabulary on its own.  Texts of more than ``CHUNK`` bytes are worked on in
parallel:

1. *Chunks.*  A text is cut into chunks that overlap by ``OVERLAP`` bytes.
2. *Pre-tokens.*  Every chunk is split by the pattern from its first byte on,
   which may lie inside a pre-token.
3. *Stitches.*  The pattern looks only ahead, so two readings that share one
   boundary agree from there on.  Each chunk is joined with the next one and
   their first common boundary in the overlap is where the one's pieces end and
   the other's begin.  Boundaries within ``LOOK`` bytes of a chunk's end are left
   out: the text behind could still change them.  Chunks that share none (one
   word longer than the overlap) are put together and read again, until every
   two neighbours share one; so no text is ever encoded differently.
4. *Pieces.*  Each chunk's pieces between its two stitches are encoded.

Decoding looks up the bytes of each id and concatenates them.

A shorter text is one chunk and needs no stitch.  A part is a chunk's ids; a
text's parts in order of ``at`` are its ids.  Memory of a task follows ``CHUNK``,
or the longest stretch without a common boundary.

Edge cases: a null or empty text has no ids; special tokens in a text are
ordinary text; repeated rows stay apart; other columns are ignored; an empty
table gives no rows.  Unicode versions differ in letters and digits added lately:
characters that Python doesn't know are classified by asking tiktoken.
"""

from __future__ import annotations

import base64
import hashlib
import unicodedata

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from recspark.llm.common import small_batches, texts, written
from recspark.llm.tokens import _PIECES, _PLAIN

RANKS = "byte_bpe_50k.tiktoken"
CHUNK = 16 << 10
OVERLAP = 256
LOOK = 16  # the pattern looks at most 3 characters past a boundary, of up to 4 bytes
CACHE = 500_000
_CHUNKS = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("at", pa.int64()), ("next", pa.int64()), ("text", pa.string())])
_EDGES = pa.schema([("row", pa.int64()), ("at", pa.int64()), ("next", pa.int64()),
                    ("head", pa.list_(pa.int64())), ("tail", pa.list_(pa.int64()))])
# the pattern with white space as Unicode has it
_PATTERN = regex.compile(public_tokenizers.PATTERN.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
_STAND_INS = {"letter": "ª", "digit": "²", "space": " ", "other": "¡"}
_LOADED: dict[str, "Vocabulary"] = {}


class _Kinds(dict):
    """Stand-ins of known class for characters that Python doesn't know."""

    def __missing__(self, code: int) -> str | int:
        c = chr(code)
        self[code] = code if unicodedata.category(c) != "Cn" else _STAND_INS[_kind(c)]
        return self[code]


def _kind(c: str) -> str:
    """A character's class in tiktoken: the one with which it forms a pre-token."""
    for kind, beside in (("letter", "a"), ("digit", "1"), ("other", "!")):
        pair, ranks = (beside + c).encode(), {bytes([i]): i for i in range(256)}
        for end in range(2, len(pair) + 1):
            ranks.setdefault(pair[:end], len(ranks))
        probe = tiktoken.Encoding("probe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        if len(probe.encode_ordinary(beside + c)) == 1:
            return kind
    return "space"


_KINDS = _Kinds()


def pre_tokens(text: str) -> list[str]:
    """The matches of the pattern; together they are the text."""
    if not _PLAIN.search(text):
        return _PIECES.findall(text)
    shadow = text if all(unicodedata.category(c) != "Cn" for c in set(text)) else text.translate(_KINDS)
    found = _PATTERN.findall(shadow)
    if shadow is text:
        return found
    ends = np.cumsum([0, *map(len, found)]).tolist()
    return [text[a:b] for a, b in zip(ends, ends[1:])]


class Vocabulary(dict):
    """Ranks of byte strings; as a dict, the ids of pre-tokens seen so far as
    little-endian 32-bit integers."""

    def __init__(self, path: str):
        super().__init__()
        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.library = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.bytes = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes[rank] = token
        self.decimal = [str(i) for i in range(len(self.bytes))]

    def __missing__(self, piece: str) -> bytes:
        ids = np.array(self.library.encode_ordinary(piece), "<u4").tobytes()
        if len(self) < CACHE:
            self[piece] = ids
        return ids

    def encode(self, pieces: list[str]) -> bytes:
        return b"".join(map(self.__getitem__, pieces))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))


def vocabulary(path: str | None) -> Vocabulary:
    """This worker's vocabulary of a rank file."""
    path = path or public_tokenizers.path(RANKS)
    if path not in _LOADED:
        _LOADED[path] = Vocabulary(path)
    return _LOADED[path]


def _column(batch: pa.RecordBatch, name: str):
    return batch.column(batch.schema.get_field_index(name))


def _lists(parts: list[bytes]) -> pa.Array:
    """Byte strings of 32-bit integers as one array of lists."""
    ends = np.cumsum([0, *(len(p) // 4 for p in parts)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(parts), "<i4")))


def _encode_whole(path: str | None):
    def run(batches):
        known = vocabulary(path)
        for b in small_batches(batches):
            ids = _lists([known.encode(pre_tokens(t)) for t in texts(b)])
            none = pa.nulls(b.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays([_column(b, "doc_id"), none, none, ids], names=["doc_id", "row", "at", "ids"])
    return run


def _cut(chunk: int, overlap: int):
    """Overlapping chunks of texts, cut at characters."""
    def start(data: memoryview, at: int) -> int:
        while at < len(data) and data[at] & 0xC0 == 0x80:
            at -= 1
        return at

    def run(batches):
        for b in small_batches(batches):
            column, ids, rows = _column(b, "text"), _column(b, "doc_id").to_pylist(), _column(b, "row").to_pylist()
            for i in range(b.num_rows):
                data, at, out = memoryview(column[i].as_buffer()), 0, []
                while at is not None:
                    stop = start(data, at + chunk) if at + chunk < len(data) else len(data)
                    following = start(data, stop - overlap) if stop < len(data) else None
                    out.append((ids[i], rows[i], at, following, str(data[at:stop], "utf-8")))
                    if len(out) == 256 or following is None:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _CHUNKS)], schema=_CHUNKS)
                        out = []
                    at = following
    return run


def _edges(overlap: int):
    """Boundaries of a chunk's pre-tokens where it overlaps its neighbours."""
    def run(batches):
        for b in small_batches(batches):
            out = []
            for row, at, following, text in zip(*(_column(b, c).to_pylist() for c in ("row", "at", "next", "text"))):
                ends = at + np.cumsum([0, *(len(p.encode()) for p in pre_tokens(text))])
                sure = ends if following is None else ends[ends <= ends[-1] - LOOK]
                tail = None if following is None else sure[sure >= following].tolist()
                out.append((row, at, following, sure[sure <= at + 2 * overlap].tolist(), tail))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _EDGES)], schema=_EDGES)
    return run


def _joined(pdf):
    """One chunk of several that follow each other."""
    pdf = pdf.sort_values("at")
    data, parts = [t.encode() for t in pdf["text"]], []
    for text, at, following in zip(data, pdf["at"], [*pdf["at"].iloc[1:], None]):
        parts.append(text if following is None else text[:int(following - at)])
    out = pdf.iloc[:1].copy()
    out["next"], out["text"] = pdf["next"].iloc[-1], b"".join(parts).decode()
    return out[["doc_id", "row", "at", "next", "text"]]


def _encode_span(path: str | None):
    def run(batches):
        known = vocabulary(path)
        for b in small_batches(batches):
            out = []
            for at, begin, end, text in zip(*(_column(b, c).to_pylist() for c in ("at", "begin", "end", "text"))):
                pieces = pre_tokens(text.encode()[(begin or 0) - at:].decode())
                if end is not None:
                    size = np.cumsum([len(p.encode()) for p in pieces])
                    pieces = pieces[:int(np.searchsorted(size, end - (begin or 0))) + 1] if end > (begin or 0) else []
                out.append(known.encode(pieces))
            yield pa.RecordBatch.from_arrays([_column(b, "doc_id"), _column(b, "row"), _column(b, "at"), _lists(out)],
                                             names=["doc_id", "row", "at", "ids"])
    return run


def stitched(chunks: DataFrame, overlap: int) -> tuple[DataFrame, DataFrame]:
    """The chunks, put together where two neighbours share no boundary, and
    (row, at, next, end): where each one's pieces end (null: with the text)."""
    while True:
        edges = written(chunks.mapInArrow(_edges(overlap), "row long, at long, next long, head array<long>, tail array<long>"),
                        "edges")
        heads = edges.select("row", F.col("at").alias("next"), "head")
        ends = written(edges.select("row", "at", "next", "tail").join(heads, ["row", "next"], "left").select(
            "row", "at", "next", F.array_min(F.array_intersect("tail", "head")).alias("end")), "stitches")
        apart = F.col("next").isNotNull() & F.col("end").isNull()
        if not ends.where(apart).limit(1).count():
            return chunks, ends
        order = W.partitionBy("row").orderBy("at")
        groups = (ends.withColumn("new", F.coalesce(F.lag(~apart).over(order), F.lit(True)).cast("int"))
                  .withColumn("part", F.sum("new").over(order))
                  .withColumn("many", F.count("*").over(W.partitionBy("row", "part")) > 1).select("row", "at", "part", "many"))
        marked = chunks.join(groups, ["row", "at"])
        several = marked.where("many").groupBy("row", "part").applyInPandas(_joined, chunks.schema)
        chunks = written(marked.where("NOT many").select(*chunks.columns).union(several), "joined")


def encode(docs: DataFrame, path: str | None = None, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id, row, at, ids: the ids of every text by a rank file.  A text of
    several parts has one row for each, with its number and the part's first
    byte; for one of a single part both are null."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    fields = "doc_id long, row long, at long, ids array<int>"
    short = docs.where(F.octet_length("text") <= chunk).mapInArrow(_encode_whole(path), fields)
    long = docs.where(F.octet_length("text") > chunk).withColumn("row", F.monotonically_increasing_id())
    chunks = written(long.mapInArrow(_cut(chunk, overlap), "doc_id long, row long, at long, next long, text string")
                     .repartition("row", "at"), "chunks")
    chunks, ends = stitched(chunks, overlap)
    begins = ends.where("next IS NOT NULL").select("row", F.col("next").alias("at"), F.col("end").alias("begin"))
    spans = (chunks.drop("next").join(ends.select("row", "at", "end"), ["row", "at"]).join(begins, ["row", "at"], "left"))
    return short.union(spans.mapInArrow(_encode_span(path), fields))


def _ids(batch: pa.RecordBatch):
    """The ids of each row, one list at a time."""
    column = _column(batch, "ids")
    values, ends = column.values.to_numpy(), column.offsets.to_numpy()
    for i, j in zip(ends[:-1].tolist(), ends[1:].tolist()):
        yield values[i:j].tolist()


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``encoded`` rows with ``bytes``, what their ids stand for."""
    def run(batches):
        known = vocabulary(path)
        for b in batches:
            out = pa.array([known.decode(ids) for ids in _ids(b)], pa.binary())
            yield pa.RecordBatch.from_arrays([*b.columns, out], names=[*b.schema.names, "bytes"])
    schema = encoded.schema.simpleString()[len("struct<"):-1]
    return encoded.mapInArrow(run, f"{schema},bytes:binary")


def digests(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each document of
    ``encode``; the parts of one are read in order, one at a time."""
    def run(batches):
        known, out, last, n, text, raw = vocabulary(path), [], None, 0, None, None
        for b in batches:
            for doc_id, row, ids in zip(_column(b, "doc_id").to_pylist(), _column(b, "row").to_pylist(), _ids(b)):
                if text is not None and (row is None or (doc_id, row) != last):
                    out.append((last[0], n, text.hexdigest(), raw.hexdigest()))
                    text = None
                    if len(out) == 4096:
                        yield _digest_batch(out)
                        out = []
                if text is None:
                    last, n, text, raw = (doc_id, row), 0, hashlib.sha256(), hashlib.sha256()
                elif n and ids:
                    text.update(b" ")
                n += len(ids)
                text.update(" ".join(map(known.decimal.__getitem__, ids)).encode())
                raw.update(known.decode(ids))
        if text is not None:
            out.append((last[0], n, text.hexdigest(), raw.hexdigest()))
        if out:
            yield _digest_batch(out)

    fields = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    several = encoded.where("row IS NOT NULL").repartition("row").sortWithinPartitions("row", "at")
    return encoded.where("row IS NULL").mapInArrow(run, fields).union(several.mapInArrow(run, fields))


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.string(), pa.string()))],
        names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
