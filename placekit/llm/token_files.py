"""Token-id files of independent zstandard frames with a trailing seek table.

Layout of a file (integers little-endian)::

    frame separator frame separator ... seek-table separator

* A *frame* is one ordinary zstandard frame: the token ids of consecutive
  documents, as unsigned 16-bit integers if the vocabulary fits, else 32-bit.
  It holds whole documents, ``FRAME_IDS`` ids or one longer document.
* The *separator* is an empty skippable frame (8 bytes, all ASCII), so standard
  tools decompress the file as it is.
* The *seek table* is a skippable frame: number of frames and documents, rank
  of the file, width of an id; for each frame offset, compressed and
  plain size and CRC-32 of the plain bytes; for each document its id, whether
  the id is null, its frame and its number of ids; CRC-32 of all that, its
  length, and ``MAGIC``.

A reader takes the seek table from the file's end, seeks to the frames of the
documents it wants and checks their sums (``TokenFile``).

Files are written by Spark's own committer, one for each range partition of the ids, so
a lost executor's files are written again: the frames are rows of a text
sink whose line separator is the skippable frame.
"""

from __future__ import annotations

import io
import struct
import sys
import uuid
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from placekit.llm.bpe import read_spec, tokenizer
from placekit.session import checkpoint_dir, materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed values of the format.
SEPARATOR = b"P*M\x18\x00\x00\x00\x00"  # skippable frame 0x184D2A50 of no bytes
TABLE_FRAME = 0x184D2A5E
MAGIC = 0x544B5A53
HEAD = "<IIIB"
TAIL = "<IQI"
FRAME = np.dtype([("offset", "<u8"), ("size", "<u8"), ("plain", "<u8"), ("crc", "<u4")])
DOC = np.dtype([("id", "<i8"), ("null", "u1"), ("frame", "<u4"), ("ids", "<u8")])

FRAME_IDS = 1 << 16
LEVEL = 3


class FrameWriter:
    """Turns documents into the frames of one file; ``close`` gives the seek table."""

    def __init__(self, rank: int, width: int, frame_ids: int = FRAME_IDS, level: int = LEVEL):
        self.rank, self.width, self.frame_ids = rank, width, frame_ids
        self.zstd = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True)
        self.frames: list[tuple] = []
        self.docs: list[tuple] = []
        self.held: list[bytes] = []
        self.n_held, self.offset = 0, 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> list[bytes]:
        """Take a document; the frames that are full now."""
        out = self._flush() if self.n_held and self.n_held + len(ids) > self.frame_ids else []
        self.held.append(ids.astype(f"<u{self.width}").tobytes())
        self.docs.append((doc_id or 0, doc_id is None, len(self.frames), len(ids)))
        self.n_held += len(ids)
        return out

    def _flush(self) -> list[bytes]:
        plain = b"".join(self.held)
        frame = self.zstd.compress(plain)
        self.frames.append((self.offset, len(frame), len(plain), zlib.crc32(plain)))
        self.offset += len(frame) + len(SEPARATOR)
        self.held, self.n_held = [], 0
        return [frame]

    def close(self) -> list[bytes]:
        out = self._flush() if self.docs else []
        body = (struct.pack(HEAD, len(self.frames), len(self.docs), self.rank, self.width)
                + np.array(self.frames, FRAME).tobytes() + np.array(self.docs, DOC).tobytes())
        body += struct.pack(TAIL, zlib.crc32(body), len(body), MAGIC)
        return [*out, struct.pack("<II", TABLE_FRAME, len(body)) + body]


class TokenFile:
    """Reads a token file from a seekable binary file object."""

    def __init__(self, f):
        self.f = f
        end = f.seek(0, io.SEEK_END) - len(SEPARATOR)
        f.seek(end - struct.calcsize(TAIL))
        crc, size, magic = struct.unpack(TAIL, f.read(struct.calcsize(TAIL)))
        if magic != MAGIC:
            raise ValueError("not a token file: it has no seek table at its end")
        f.seek(end - struct.calcsize(TAIL) - size)
        body = f.read(size)
        if zlib.crc32(body) != crc:
            raise ValueError("the seek table's checksum doesn't hold")
        frames, docs, self.rank, self.width = struct.unpack_from(HEAD, body)
        self.frames = np.frombuffer(body, FRAME, frames, struct.calcsize(HEAD))
        self.docs = np.frombuffer(body, DOC, docs, struct.calcsize(HEAD) + frames * FRAME.itemsize)
        self.zstd = zstandard.ZstdDecompressor()

    def frame(self, k: int) -> np.ndarray:
        """The ids of frame ``k``; its checksum is held against the table."""
        offset, size, plain, crc = self.frames[k].tolist()
        self.f.seek(offset)
        raw = self.zstd.decompress(self.f.read(size), max_output_size=plain)
        if len(raw) != plain or zlib.crc32(raw) != crc:
            raise ValueError(f"the checksum of frame {k} doesn't hold")
        return np.frombuffer(raw, f"<u{self.width}")

    def read(self, numbers=None):
        """(id or None, ids) of the documents with these numbers in the file (all), in the
        file's order; decompresses their frames alone."""
        at, held = -1, None
        wanted = range(len(self.docs)) if numbers is None else sorted(numbers)
        first = np.concatenate(([0], np.cumsum(self.docs["ids"].astype(np.int64))))
        for k in wanted:
            doc_id, null, frame, n = self.docs[k].tolist()
            if frame != at:
                at, held = frame, self.frame(frame)
                base = first[np.searchsorted(self.docs["frame"], frame)]
            lo = int(first[k] - base)
            yield (None if null else doc_id), held[lo:lo + n]

    def find(self, doc_ids) -> list[tuple]:
        """(id, ids) of the documents with these ids."""
        return list(self.read(np.flatnonzero(np.isin(self.docs["id"], list(doc_ids)) & (self.docs["null"] == 0)).tolist()))


def write_tokens(docs: DataFrame, path: str, tokenizer_file: str, end_id: int = 0,
                 files: int | None = None) -> None:
    """Encode every whole text, append ``end_id`` to each document, and write
    the ids in ascending order of ``doc_id`` to ``files`` files (the session's
    shuffle partitions) under ``path``, any folder that Spark can write to.

    Null ids come first; rows of one id follow each other by the hash of
    their texts. Null and empty texts have the end id alone. An empty table
    gives no file with documents. Other columns are ignored.
    """
    spark = docs.sparkSession
    spec = spark.sparkContext.broadcast(read_spec(tokenizer_file))
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text",
                       F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"))
    dealt = (rows.repartitionByRange(files, F.col("doc_id"), F.col("th"))
                 .sortWithinPartitions("doc_id", "th").select("doc_id", "text"))

    def run(batches):
        from pyspark import TaskContext
        bpe = tokenizer(spec.value)
        width = 2 if max(*bpe.vocab.values(), *bpe.id_bytes, end_id) < 1 << 16 else 4
        end = np.array([end_id], "<u4")
        w = FrameWriter(TaskContext.get().partitionId(), width)
        some = False
        for whole in batches:
            for at in range(0, len(whole), 256):
                batch = whole.slice(at, 256)
                some = True
                out = []
                for d, ids in zip(batch.column("doc_id").to_pylist(), bpe.encode(batch.column("text").to_pylist())):
                    out += w.add(d, np.concatenate((np.frombuffer(ids, "<u4"), end)))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["frame"])
        if some:
            yield pa.RecordBatch.from_arrays([pa.array(w.close(), pa.binary())], names=["frame"])

    (dealt.mapInArrow(run, "frame binary").select(F.col("frame").cast("string").alias("value"))
          .write.option("lineSep", SEPARATOR.decode("ascii")).text(path))


def read_tokens(spark, path: str, with_ids: bool = True) -> DataFrame:
    """One row for each document in the files under ``path``: ``rank`` of the
    file, ``number`` in the file, ``doc_id``, ``first`` (ids before it in the
    file), ``n_tokens``, ``crc32`` of its ids as unsigned 32-bit integers and,
    if asked for, ``ids``.  All checksums are held against the tables."""
    content = spark.read.format("binaryFile").load(path).filter("length > 0").select("content")

    def run(batches):
        for batch in batches:
            for raw in batch.column("content"):
                f = TokenFile(io.BytesIO(raw.as_buffer()))
                out, n = [], 0
                for k, (d, ids) in enumerate(f.read()):
                    data = ids.astype("<u4").tobytes()
                    out.append((f.rank, k, d, n, len(ids), zlib.crc32(data), data if with_ids else None))
                    n += len(ids)
                    if len(out) == 4096:
                        yield _documents(out)
                        out = []
                if out:
                    yield _documents(out)

    def _documents(out):
        kinds = [pa.int64()] * 6 + [pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)],
                                          names=["rank", "number", "doc_id", "first", "n_tokens", "crc32", "ids"])

    rows = content.mapInArrow(run, "rank bigint, number bigint, doc_id bigint, first bigint, n_tokens bigint, "
                                   "crc32 bigint, ids binary")
    return rows if with_ids else rows.drop("ids")


def op9_token_files(spark, sf_dir: str, tokenizer_file: str | None = None) -> DataFrame:
    from placekit.sources.tables import table
    if tokenizer_file is None:
        import public_tokenizers
        tokenizer_file = public_tokenizers.path("byte_bpe_50k.json")
    path = f"{checkpoint_dir(spark).rstrip('/')}/tokens/{uuid.uuid4().hex}"
    write_tokens(table(spark, sf_dir, "documents"), path, tokenizer_file)
    rows = materialize(read_tokens(spark, path, with_ids=False))
    # one row for each file
    before = (rows.groupBy("rank").agg(F.sum("n_tokens").alias("n"))
                  .withColumn("before", F.coalesce(F.sum("n").over(
                      Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))))
    return rows.join(before, "rank").select(
        "doc_id", (F.col("before") + F.col("first")).alias("start"), "n_tokens", F.col("crc32").alias("ids_crc32"))
