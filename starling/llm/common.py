"""Shared helpers: table scans, shared scratch tables, Arrow batch utilities."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterable, Iterator

import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starling.session import configure, ensure_checkpoint_dir

# white space that separates words everywhere in this subpackage: space and 0x09-0x0D
WORD = r"[^\x20\x09-\x0D]+"
# where the installed public tokenizers live; the path is a parameter of every operator that reads one
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of the LLM queries: the engine's, and small Arrow batches for long texts."""
    configure(spark)
    # Python workers import this package too, wherever the driver was started; a cluster whose
    # executors do not see this folder gets the package with --py-files
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    workers = spark.sparkContext.environment
    known = [p for p in workers.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        workers["PYTHONPATH"] = os.pathsep.join([*known, root])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1024")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "16m")
    return spark


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder under the cluster's shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark)
    return f"{root}/llm-{name}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to shared storage and read it back: cuts lineage, survives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def words_expr(text) -> "F.Column":
    """Array of words of a text column (null text: no words)."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """A column that later expressions read and the optimizer never copies into them."""
    return df.withColumn(name, F.when(F.monotonically_increasing_id() >= 0, value))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), 0)


LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower_ascii(text: Column) -> Column:
    """A text with A-Z in lower case and all other letters as they are."""
    return (F.when(F.octet_length(text) == F.char_length(text), F.lower(text))
            .otherwise(F.translate(text, LETTERS, LETTERS.lower())))


TAIL = b".,;:!?"
LATER_SCRIPTS = chr(0x530)   # scripts after Cyrillic


def cut_tail(chunk: bytes) -> tuple[bytes, bytes]:
    """A chunk's letters or digits and the punctuation after them, which tokenizers cut apart.

    The second part is empty where nothing can be cut safely.  Beyond ASCII that means a
    Latin, Greek or Cyrillic letter that still ends in a letter once lowered (U+0130 ends
    in a mark); other scripts' tables differ between Unicode versions.
    """
    body = chunk.rstrip(TAIL)
    if not body or len(body) == len(chunk):
        return chunk, b""
    if body[-1] < 128:
        safe = chr(body[-1]).isalnum()
    else:
        letter = body.decode("utf-8", "replace")[-1]
        safe = letter < LATER_SCRIPTS and letter.isalpha() and letter.lower()[-1].isalpha()
    return (body, chunk[len(body):]) if safe else (chunk, b"")


def chunks_of(text: bytes) -> list[bytes]:
    """Chunks between white space for a tokenizer that lowers all letters.

    A-Z are lowered first, so that fewer chunks differ, unless the text may hold marks
    of special tokens, which count as written, or combining marks from U+0300 to U+033F
    (lead byte 0xCC): tokenizers compose before they lower, and J, H, T, W and Y form
    composed letters with some of these in lower case only.
    """
    return text.split() if b"<|" in text or b"\xcc" in text else text.lower().split()


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that one piece holds at most ``max_bytes`` of a text/binary column (or one row)."""
    start = size = 0
    lengths = pc.binary_length(batch.column(column)).to_pylist()
    for i, n in enumerate(lengths):
        n = n or 0
        if size and size + n > max_bytes:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n
    if start < batch.num_rows:
        yield batch.slice(start)


def gathered(batches: Iterable[pa.RecordBatch], column: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Join small batches until a text/binary column holds about ``max_bytes``."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += pc.sum(pc.binary_length(batch.column(column))).as_py() or 0
        if size >= max_bytes:
            yield joined(held)
            held, size = [], 0
    if held:
        yield joined(held)


def joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0] if len(batches) > 1 else batches[0]


def replace_column(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    """The batch with one column replaced, its field kept in place."""
    i = batch.schema.get_field_index(name)
    arrays: Iterable[pa.Array] = [values if j == i else c for j, c in enumerate(batch.columns)]
    schema = batch.schema.set(i, pa.field(name, values.type))
    return pa.RecordBatch.from_arrays(list(arrays), schema=schema)
