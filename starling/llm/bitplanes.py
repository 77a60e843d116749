"""Token-ID output: bit-plane shuffled, zstandard-compressed id files with a chunk index.

Documents are range-partitioned by id, so that files in name order hold them in
ascending order.  A task turns its documents into ids with the tokenizers library
and streams them into one file:

    magic | chunk 0 | chunk 1 | ... | footer | footer length (8 bytes) | magic

A chunk holds a fixed number of ids (the last one of a file fewer) as 32-bit
integers, transposed into 4 byte planes (or 32 bit planes), each plane compressed
by itself: the high planes of small ids are all zero and vanish, and like bytes lie
together.  The footer is compressed JSON with the chunk index (offset, number of ids,
plane lengths) and two compressed arrays: document ids and their token counts.

A file is written under a name of its own attempt and then renamed, so a task that
runs again (lost executor, speculation) replaces it by the same content.  File
totals go through a staged table; starts are running sums over files.

Defined results: a null or empty text gives the end id alone; a null document id
comes first; documents with one id are ordered by their text's hash; an empty
table gives no files and no rows; extra columns are not read.
"""

from __future__ import annotations

import functools
import json
import os
import re
import struct
import uuid
import zlib
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window
from tokenizers import Tokenizer, normalizers

from starling.llm.common import TOKENIZER, cut_tail, gathered, scratch, slices, stage

MAGIC = b"STRLBPL1"
BLOCK = 1 << 16        # ids per chunk
CACHE = 600_000        # chunks of text per cache generation and worker
LONGEST_CACHED = 64
GROUP = 256            # new chunks per call of the tokenizer
SLICE = 8 << 20        # bytes of text that are split and laid out at a time
TAIL = ".,;:!?%&*#$"   # ASCII punctuation that is cut off a chunk's end
# letters and digits that it is cut off after
ENDS = "".join(c for c in map(chr, range(0x30, 0x530)) if cut_tail(f"{c}.".encode())[1])
MARK = "\x01"
JOIN = f" {MARK} ".encode()
PLAIN = "".join(c for c in map(chr, range(0x21, 0x7F)) if c == c.lower())
GAP = re.compile(r"[\t-\r ]")
NO_DOC = -(1 << 63)    # stands for a null document id in files


# ---- planes ------------------------------------------------------------
def to_planes(ids: np.ndarray, planes: str = "byte") -> list[bytes]:
    """Transpose 32-bit ids into 4 byte planes or 32 bit planes, low ones first."""
    raw = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4)
    if planes == "byte":
        return [np.ascontiguousarray(raw[:, k]).tobytes() for k in range(4)]
    bits = np.unpackbits(raw, axis=1, bitorder="little")
    return [np.packbits(bits[:, k], bitorder="little").tobytes() for k in range(32)]


def from_planes(data: list[bytes], n: int) -> np.ndarray:
    """The inverse of ``to_planes`` (4 planes: bytes, 32: bits)."""
    if len(data) == 4:
        raw = np.empty((n, 4), np.uint8)
        for k, plane in enumerate(data):
            raw[:, k] = np.frombuffer(plane, np.uint8)
    else:
        bits = np.empty((n, 32), np.uint8)
        for k, plane in enumerate(data):
            bits[:, k] = np.unpackbits(np.frombuffer(plane, np.uint8), count=n, bitorder="little")
        raw = np.packbits(bits, axis=1, bitorder="little")
    return raw.reshape(-1).view("<u4")


class Writer:
    """Streams documents' ids into one file; holds one block of ids and the document arrays."""

    def __init__(self, out, planes: str, block: int):
        self.out, self.planes, self.block = out, planes, block
        self.pending: list[np.ndarray] = []
        self.held = 0
        self.chunks: list[list] = []
        self.docs: list[int] = []
        self.counts: list[int] = []
        self.zstd = zstandard.ZstdCompressor(level=1)
        self.at = len(MAGIC)
        out.write(MAGIC)

    def add(self, docs: list[int], counts: list[int], ids: np.ndarray) -> None:
        """Documents in a row: their ids, how many of them each has, and all of these in one array."""
        self.docs += docs
        self.counts += counts
        self.pending.append(ids)
        self.held += len(ids)
        if self.held >= self.block:
            self.flush(False)

    def flush(self, last: bool) -> None:
        if not self.pending:
            return
        ids = np.concatenate(self.pending)
        whole = len(ids) if last else len(ids) - len(ids) % self.block
        for i in range(0, whole, self.block):
            part = ids[i:min(i + self.block, whole)]
            packed = [self.zstd.compress(p) for p in to_planes(part, self.planes)]
            self.chunks.append([self.at, len(part), [len(p) for p in packed]])
            for p in packed:
                self.out.write(p)
                self.at += len(p)
        self.pending, self.held = [ids[whole:]], len(ids) - whole

    def close(self) -> None:
        self.flush(True)
        arrays = [self.zstd.compress(np.array(x, "<i8").tobytes()) for x in (self.docs, self.counts)]
        index = self.zstd.compress(json.dumps({"chunks": self.chunks}).encode())
        footer = b"".join(struct.pack("<Q", len(p)) + p for p in (index, *arrays))
        self.out.write(footer + struct.pack("<Q", len(footer)) + MAGIC)


def read_footer(f, size: int) -> tuple[list, np.ndarray, np.ndarray]:
    """Chunk index, document ids and token counts of an open file."""
    f.seek(size - 16)
    tail = f.read(16)
    if tail[8:] != MAGIC:
        raise ValueError("not a complete bit-plane file")
    n = struct.unpack("<Q", tail[:8])[0]
    f.seek(size - 16 - n)
    data, parts, at = f.read(n), [], 0
    while at < n:
        m = struct.unpack_from("<Q", data, at)[0]
        parts.append(zstandard.ZstdDecompressor().decompress(data[at + 8:at + 8 + m]))
        at += 8 + m
    return json.loads(parts[0])["chunks"], np.frombuffer(parts[1], "<i8"), np.frombuffer(parts[2], "<i8")


def read_documents(f, size: int):
    """Yield (document id, number of ids, ids) in file order, holding a few chunks at a time."""
    chunks, docs, counts = read_footer(f, size)
    zstd, rest, k = zstandard.ZstdDecompressor(), np.empty(0, "<u4"), 0
    for doc, count in zip(docs.tolist(), counts.tolist()):
        if len(rest) < count:
            more, have = [rest], len(rest)
            while have < count:
                offset, n, lengths = chunks[k]
                k += 1
                f.seek(offset)
                data, planes, at = f.read(sum(lengths)), [], 0
                for m in lengths:
                    planes.append(zstd.decompress(data[at:at + m]))
                    at += m
                more.append(from_planes(planes, n))
                have += n
            rest = np.concatenate(more)
        yield doc, count, rest[:count]
        rest = rest[count:]


# ---- encoding ------------------------------------------------------------
def as_strings(texts: pa.Array) -> pa.Array:
    """Texts as strings, null ones empty, broken UTF-8 replaced."""
    texts = pc.fill_null(texts, b"" if pa.types.is_binary(texts.type) else "")
    try:
        return texts.cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([t.decode("utf-8", "replace") for t in texts.cast(pa.binary()).to_pylist()], pa.string())


def as_written(texts: pa.Array) -> pa.Array:
    """Texts whose A-Z must not be lowered before they are cut (see ``common.chunks_of``)."""
    return pc.or_(pc.match_substring(texts, "<|"), pc.match_substring(texts.cast(pa.binary()), b"\xcc"))


def cut_tails(chunks: pa.Array) -> list[pa.Array]:
    """Bodies and tails of chunks: punctuation after a letter or digit is a piece of its own.

    The letters are those of ``common.cut_tail``; the tail is empty where nothing can be cut safely.
    """
    body = pc.ascii_rtrim(chunks, TAIL)
    safe = pc.match_substring_regex(body, f"[{ENDS}]$")
    tail = pc.replace_substring_regex(chunks, f"(?s)^.*[^{TAIL}]", "")
    return [pc.if_else(safe, body, chunks), pc.if_else(safe, tail, "")]


def starts_of(lengths: np.ndarray) -> np.ndarray:
    return np.cumsum(lengths) - lengths


def gather(pool: np.ndarray, begin: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The stretches of ``pool`` that begin at ``begin`` and have the given lengths, one after another."""
    return pool[np.repeat(begin - starts_of(lengths), lengths) + np.arange(lengths.sum())]


def cuts_of(text: str, size: int) -> list[str]:
    """A text in pieces of about ``size`` characters, cut at white space only."""
    pieces, at = [], 0
    while len(text) - at > size:
        found = GAP.search(text, at + size)
        if not found:
            break
        pieces.append(text[at:found.start()])
        at = found.start()
    return [*pieces, text[at:]]


class LibraryEncoder:
    """Ids by the tokenizers library, which sees each distinct chunk between white space once.

    White space only separates words for this vocabulary, so the ids of a text are
    those of its chunks in a row.  A slice of texts is split, and its distinct chunks are
    found, by Arrow; Python looks each distinct piece up once, and numpy lays out the ids.
    """

    def __init__(self, spec: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer, self.plain = [Tokenizer.from_str(spec.decode()) for _ in range(2)]
        for t in (self.tokenizer, self.plain):
            t.no_truncation()
            t.no_padding()
        # printable lower-case ASCII chunks need no normalizer where it leaves such letters alone
        normal = self.plain.normalizer
        if normal is not None and normal.normalize_str(PLAIN) == PLAIN:
            self.plain.normalizer = normalizers.Sequence([])
        mark = self.tokenizer.encode(MARK, add_special_tokens=False).ids
        self.mark_id = mark[0] if len(mark) == 1 else None
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def encode_all(self, texts: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, each followed by ``end_id``, and how many each text has."""
        texts = as_strings(texts)
        if len(texts) == 1 and len(whole := texts[0].as_py()) > SLICE:
            written = as_written(texts)[0].as_py()
            parts = [self.encode_slice(pa.array([p], pa.string()), pa.array([written]))[0] for p in cuts_of(whole, SLICE)]
            ids = np.concatenate(parts)
            counts = np.array([len(ids)])
        else:
            ids, counts = self.encode_slice(texts, as_written(texts))
        if end_id is not None:
            ids, counts = np.insert(ids, np.cumsum(counts), end_id), counts + 1
        return ids, counts

    def encode_slice(self, texts: pa.Array, written: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        chunks = pc.ascii_split_whitespace(pc.if_else(written, texts, pc.ascii_lower(texts)))
        coded = chunks.flatten().dictionary_encode()
        pieces = pa.concat_arrays(cut_tails(coded.dictionary)).dictionary_encode()
        ids_of = self.look_up(pieces.dictionary.cast(pa.binary()).to_pylist())
        pool = np.frombuffer(b"".join(ids_of), "<u4")
        lengths = np.fromiter(map(len, ids_of), np.int64, len(ids_of)) // 4
        # first the ids of each distinct chunk, from its two pieces, then those of all chunks
        pairs = pieces.indices.to_numpy().reshape(2, -1).T
        pool = gather(pool, starts_of(lengths)[pairs].ravel(), lengths[pairs].ravel())
        lengths = lengths[pairs].sum(axis=1)
        index = coded.indices.to_numpy()
        n = lengths[index]
        ids = gather(pool, starts_of(lengths)[index], n)
        offsets = chunks.offsets.to_numpy()
        edges = np.concatenate([[0], np.cumsum(n)])
        return ids, np.diff(edges[offsets - offsets[0]])

    def look_up(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of distinct pieces, as little-endian unsigned 32-bit integers; all but long ones are cached."""
        if len(self.young) > CACHE:
            self.old, self.young = self.young, {}
        found = list(map(self.young.get, pieces))
        absent = [i for i, ids in enumerate(found) if ids is None]
        new = []
        for i in absent:
            ids = found[i] = self.old.get(pieces[i])
            if ids is None:
                new.append(i)
        for i, ids in zip(new, self.encode_chunks([pieces[i] for i in new])):
            found[i] = ids
        self.young.update([(pieces[i], found[i]) for i in absent if len(pieces[i]) <= LONGEST_CACHED])
        return found

    def encode_chunks(self, chunks: list[bytes]) -> list[bytes]:
        """Ids of each chunk, many chunks to a call: a mark of one id stands between them."""
        if self.mark_id is None:
            return [self.encode_one(c) for c in chunks]
        simple = [c.isascii() and c == c.lower() and c.decode().isprintable() for c in chunks]
        plain = iter(self.encode_joined([c for c, is_plain in zip(chunks, simple) if is_plain], self.plain))
        others = iter(self.encode_joined([c for c, is_plain in zip(chunks, simple) if not is_plain], self.tokenizer))
        return [next(plain if is_plain else others) for is_plain in simple]

    def encode_joined(self, chunks: list[bytes], tokenizer: Tokenizer) -> list[bytes]:
        out: list[bytes] = []
        groups = [chunks[i:i + GROUP] for i in range(0, len(chunks), GROUP)]
        for group in groups:
            e = tokenizer.encode_batch_fast([JOIN.join(group).decode("utf-8", "replace")], add_special_tokens=False)[0]
            ids = np.array(e.ids, "<u4")
            marks = np.flatnonzero(ids == self.mark_id)
            if len(marks) != len(group) - 1:      # a chunk holds the mark itself
                out.extend(self.encode_one(c) for c in group)
                continue
            raw, at = ids.tobytes(), 0
            for m in (marks * 4).tolist():
                out.append(raw[at:m])
                at = m + 4
            out.append(raw[at:])
        return out

    def encode_one(self, chunk: bytes) -> bytes:
        e = self.tokenizer.encode(chunk.decode("utf-8", "replace"), add_special_tokens=False)
        return array("I", e.ids).tobytes()


@functools.lru_cache(maxsize=2)
def library_encoder(spec: bytes) -> LibraryEncoder:
    return LibraryEncoder(spec)


# ---- the operator ----------------------------------------------------------
INDEX = T.StructType([T.StructField("file", T.StringType()), T.StructField("part", T.IntegerType()),
                      T.StructField("bytes", T.LongType()), T.StructField("n_docs", T.LongType()),
                      T.StructField("n_ids", T.LongType()), T.StructField("n_chunks", T.IntegerType())])


def write_ids(df: DataFrame, folder: str, key: str = "doc_id", text: str = "text", tokenizer: str = TOKENIZER,
              end_id: int | None = 1, planes: str = "byte", block: int = BLOCK) -> DataFrame:
    """Write the ids of all documents, in ascending key order, as bit-plane files into ``folder``.

    Returns the table of files (staged, so reading it does not write again).  The folder
    must be on shared storage that pyarrow can open (file, hdfs, s3, gs).
    """
    if planes not in ("byte", "bit"):
        raise ValueError("planes: 'byte' or 'bit'")
    with open(tokenizer, "rb") as f:
        spec = df.sparkSession.sparkContext.broadcast(f.read())
    docs = df.select(F.col(f"`{key}`").cast("long").alias("k"), F.col(f"`{text}`").cast("binary").alias("t"))
    docs = docs.withColumn("h", F.xxhash64("t"))
    order = [F.col("k").asc_nulls_first(), F.col("h").asc()]
    docs = docs.repartitionByRange(*order).sortWithinPartitions(*order).select("k", "t")

    def work(batches):
        context = TaskContext.get()
        part, attempt = context.partitionId(), context.taskAttemptId()
        fs, root = pafs.FileSystem.from_uri(folder)
        coder, writer, out = library_encoder(spec.value), None, None
        final, own = f"{root}/part-{part:07d}.bpl", f"{root}/.part-{part:07d}-{attempt}-{uuid.uuid4().hex[:8]}"
        for batch in gathered(batches, "t", SLICE):
            for piece in slices(batch, "t", SLICE):
                if writer is None:
                    fs.create_dir(root, recursive=True)
                    out = fs.open_output_stream(own)
                    writer = Writer(out, planes, block)
                ids, counts = coder.encode_all(piece.column("t"), end_id)
                writer.add(pc.fill_null(piece.column("k"), NO_DOC).to_pylist(), counts.tolist(), ids)
        if writer is None:
            return
        writer.close()
        out.close()
        size = fs.get_file_info(own).size
        fs.move(own, final)
        yield pa.RecordBatch.from_pylist([{
            "file": f"part-{part:07d}.bpl", "part": part, "bytes": size, "n_docs": len(writer.docs),
            "n_ids": sum(writer.counts), "n_chunks": len(writer.chunks)}],
            schema=pa.schema([("file", pa.string()), ("part", pa.int32()), ("bytes", pa.int64()),
                              ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("n_chunks", pa.int32())]))

    return stage(docs.mapInArrow(work, INDEX), "bitplane-index")


def read_ids(files: DataFrame, folder: str, with_ids: bool = False) -> DataFrame:
    """Read the files back: doc_id, start, n_tokens, ids_crc32, and the ids if asked.

    ``start`` adds up the totals of the files before (a window over one row per file).
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    n_files = max(files.count(), 1)
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()),
                           T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType())])
    if with_ids:
        schema = schema.add("token_ids", T.ArrayType(T.LongType()))

    def work(batches):
        fs, root = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                start, rows = row["base"], []
                with fs.open_input_file(f"{root}/{row['file']}") as f:
                    for doc, count, ids in read_documents(f, row["bytes"]):
                        one = {"doc_id": None if doc == NO_DOC else doc, "start": start, "n_tokens": count,
                               "ids_crc32": zlib.crc32(np.ascontiguousarray(ids).tobytes())}
                        if with_ids:
                            one["token_ids"] = ids.tolist()
                        rows.append(one)
                        start += count
                        if len(rows) >= 1024:
                            yield to_batch(rows)
                            rows = []
                if rows:
                    yield to_batch(rows)

    def to_batch(rows):
        fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
        if with_ids:
            fields.append(("token_ids", pa.list_(pa.int64())))
        return pa.RecordBatch.from_pylist(rows, schema=pa.schema(fields))

    return placed.repartition(n_files).mapInArrow(work, schema)


def new_folder(spark: SparkSession) -> str:
    return scratch(spark, "bitplanes")
