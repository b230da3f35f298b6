"""Token ids as files of length-delimited binary records.

A shard is a sequence of frames, each

    u32 length of the payload | u32 masked checksum of these four bytes |
    payload | u32 masked checksum of the payload | one line feed

and a payload is ``u8 has an id | i64 doc_id | u8 bytes per token | ids``, all
little-endian. Checksums are CRC-32, rotated and shifted, so that data which
holds checksums itself does not verify by chance. Shards are written by Spark's
text sink, whose line end is the last byte of a frame: any store Spark can write
to will do, and its commit protocol deals with lost executors and second
attempts. A separate index, a Parquet table, has shard, offset and length of
every record, so that records can be fetched in any order.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loadgrain.session import settle

#: Appended to every document.
END_ID = 2
#: Text bytes per shard; a byte yields at most one token, so shards stay within
#: twice that (but for single longer documents).
SHARD_TEXT_BYTES = 32 << 20
#: Encoded pieces a Python worker remembers, in each of two generations.
REMEMBERED = 300_000
#: Longer pieces are not remembered, so memory has a bound in bytes.
LONGEST = 64
_HEAD = struct.Struct("<II")
_OWNER = struct.Struct("<BqB")


def masked(checksum: int) -> int:
    """The checksum, rotated right by 15 bits, plus a constant."""
    return (((checksum >> 15) | (checksum << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    """A record as written, without its final line feed (the sink adds it)."""
    length = len(payload).to_bytes(4, "little")
    head = _HEAD.pack(len(payload), masked(zlib.crc32(length)))
    return head + payload + masked(zlib.crc32(payload)).to_bytes(4, "little")


def frames(shard: bytes | memoryview) -> Iterator[tuple[int, memoryview]]:
    """Offset and payload of each record; raises ValueError where a shard is damaged."""
    view, at = memoryview(shard), 0
    while at < len(view):
        payload, end = payload_at(view, at)
        yield at, payload
        at = end


def payload_at(view: memoryview, at: int) -> tuple[memoryview, int]:
    if at + 8 > len(view):
        raise ValueError(f"record at {at}: cut off")
    length, check = _HEAD.unpack_from(view, at)
    if masked(zlib.crc32(view[at : at + 4])) != check:
        raise ValueError(f"record at {at}: damaged length")
    payload = view[at + 8 : at + 8 + length]
    end = at + 8 + length + 5
    if end > len(view) or view[end - 1] != 10:
        raise ValueError(f"record at {at}: cut off")
    if masked(zlib.crc32(payload)) != int.from_bytes(view[end - 5 : end - 1], "little"):
        raise ValueError(f"record at {at}: damaged payload")
    return payload, end


def pack(doc_id: int | None, width: int, ids: bytes) -> bytes:
    return _OWNER.pack(doc_id is not None, doc_id or 0, width) + ids


def unpack(payload: memoryview) -> tuple[int | None, np.ndarray]:
    has_id, doc_id, width = _OWNER.unpack_from(payload)
    ids = np.frombuffer(payload[_OWNER.size :], dtype="<u2" if width == 2 else "<u4")
    return doc_id if has_id else None, ids


class Encoder:
    """A byte-level BPE tokenizer that remembers the pieces it has encoded.

    Pieces (a word with its space, a run of digits or marks) are encoded apart
    from each other, so each need be encoded once. Texts are cut into pieces
    here only if they hold nothing but Latin letters, digits and ASCII marks,
    where the pattern's classes are the same in any Unicode version; all others,
    and texts that spell a special token, go to the library whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.tokenize = self.library.model.tokenize
        self.width = 2 if self.library.get_vocab_size() <= 1 << 16 else 4
        self.kind = "<u2" if self.width == 2 else "<u4"
        # The byte-level pattern, its classes spelt out for the
        # characters below, and the printable stand-ins of bytes.
        letters = "À-ÖØ-öø-ɏ"
        self.pieces = re.compile(
            rf"'(?:s|t|re|ve|m|ll|d)| ?[A-Za-z{letters}]+| ?[0-9]+"
            rf"| ?[^\sA-Za-z0-9{letters}]+|\s+(?!\S)|\s+"
        ).findall
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        self.stand_ins = {b: 256 + i for i, b in enumerate(hidden)}
        special = [re.escape(t.content) for t in self.library.get_added_tokens_decoder().values()]
        self.other = re.compile("|".join([rf"[^\t\n\r\x20-\x7e{letters}]", *special])).search
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        ids = self.library.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype=self.kind).tobytes()

    def _piece(self, piece: str) -> bytes:
        known = self.old.get(piece)
        if known is None:
            shown = piece.encode().decode("latin-1").translate(self.stand_ins)
            known = np.array([t.id for t in self.tokenize(shown)], dtype=self.kind).tobytes()
        return known

    def encode(self, text: str) -> bytes:
        """Little-endian ids of a text."""
        if self.other(text):
            return self._whole(text)
        pieces, young = self.pieces(text), self.young
        new = [p for p in pieces if p not in young]
        for piece in new:
            young[piece] = self._piece(piece)
        found = b"".join([young[p] for p in pieces])
        for piece in new:
            if len(piece) > LONGEST:
                young.pop(piece, None)
        if len(young) > REMEMBERED:
            self.young, self.old = {}, young
        return found


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def write_records(docs: DataFrame, tokenizer: str, folder: str) -> None:
    """Encode ``docs`` (``doc_id``, ``text``) into shards under ``folder``.

    Records are in ascending order of ``doc_id`` inside a shard and from shard
    to shard; NULL ids come first. A NULL text counts as empty, and every record
    ends with ``END_ID``. Rows that repeat an id are records of their own.
    """
    rows = docs.select(
        F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text")
    )
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-total // SHARD_TEXT_BYTES))

    def run(batches):
        own = encoder(tokenizer)
        end = np.array([END_ID], dtype=own.kind).tobytes()
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for at in range(0, len(ids), 256):
                part = zip(ids[at : at + 256], texts[at : at + 256], strict=True)
                framed = [
                    frame(pack(i, own.width, own.encode(t) + end))
                    for i, t in part
                ]
                yield pa.RecordBatch.from_arrays([pa.array(framed, pa.binary())], ["frame"])

    (
        rows.repartitionByRange(shards, F.asc_nulls_first("doc_id"))
        .sortWithinPartitions(F.asc_nulls_first("doc_id"), "text")
        .mapInArrow(run, "frame binary")
        .select(F.col("frame").cast("string").alias("value"))
        .write.mode("overwrite")
        .text(folder)
    )


def _shards(spark: SparkSession, folder: str) -> DataFrame:
    """``shard`` (number in the order of the records), ``file`` and ``content``."""
    path = F.col("path")
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "part-*")
        .load(folder)
        .select(
            F.regexp_extract(path, r"part-(\d+)-", 1).cast("int").alias("shard"),
            path.alias("file"),
            "content",
        )
    )


def build_index(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record, from the shards themselves, each checksum verified.

    ``doc_id``, ``shard``, ``file``, ``offset``, ``length`` (of the payload),
    ``n_tokens``, ``start`` (tokens of all records before it) and ``ids_crc32``
    (of the ids as unsigned 32-bit integers).
    """

    def run(batches):
        for batch in batches:
            for shard, file, content in zip(*(batch.column(i) for i in range(3)), strict=True):
                rows, before = [], 0
                for offset, payload in frames(content.as_buffer()):
                    doc_id, ids = unpack(payload)
                    crc = zlib.crc32(ids.astype("<u4"))
                    rows.append((doc_id, offset, len(payload), len(ids), before, crc))
                    before += len(ids)
                columns = [pa.array(x, pa.int64()) for x in zip(*rows, strict=True)]
                same = [pa.array([x.as_py()] * len(rows), x.type) for x in (shard, file)]
                yield pa.RecordBatch.from_arrays(
                    [*same, *columns],
                    ["shard", "file", "doc_id", "offset", "length", "n_tokens", "before", "ids_crc32"],
                )

    schema = (
        "shard int, file string, doc_id bigint, offset bigint, length bigint, n_tokens bigint, "
        "before bigint, ids_crc32 bigint"
    )
    records = settle(_shards(spark, folder).mapInArrow(run, schema), "record-index")
    sizes = records.groupBy("shard").agg(F.sum("n_tokens").alias("tokens"))
    in_order = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # row per shard
    sizes = sizes.select("shard", F.coalesce(F.sum("tokens").over(in_order), F.lit(0)).alias("base"))
    return records.join(sizes, "shard").select(
        "doc_id",
        "shard",
        "file",
        "offset",
        "length",
        "n_tokens",
        (F.col("base") + F.col("before")).alias("start"),
        "ids_crc32",
    )


def read_records(spark: SparkSession, folder: str, index: DataFrame) -> DataFrame:
    """``doc_id`` and ``ids`` of the records that ``index`` names, fetched by offset.

    The index may be any part of :func:`build_index`. The records come out in a
    pseudo-random order of shards, as they are; sort by a hash of the offset for more.
    """
    wanted = index.groupBy("shard").agg(F.collect_list("offset").alias("offsets"))

    def run(batches):
        for batch in batches:
            for content, offsets in zip(batch.column(0), batch.column(1), strict=True):
                view = memoryview(content.as_buffer())
                found = [unpack(payload_at(view, at)[0]) for at in offsets.as_py()]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([d for d, _ in found], pa.int64()),
                        pa.array([x.astype(np.int32) for _, x in found], pa.list_(pa.int32())),
                    ],
                    ["doc_id", "ids"],
                )

    picked = _shards(spark, folder).join(wanted, "shard").select("content", "offsets")
    return picked.mapInArrow(run, "doc_id bigint, ids array<int>")
