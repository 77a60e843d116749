"""BPE encoding and decoding with a contiguous rank array per word.

A text is cut at white space into chunks; a chunk is normalised (NFC, lower
case) and cut into pieces by the tokenizer's pattern; a piece is a row of parts.
For a short piece one array holds the part boundaries and a second one the merge
rank of every adjacent pair; the smallest rank is found by scanning, its right
boundary deleted, and the two neighbouring ranks refreshed, until no pair has a
rank.  Pieces above ``SHORT`` symbols use a heap over linked parts (same merges in
the same order, n log n instead of n squared).

Chunks repeat, so each Python worker keeps a bounded two-generation cache from
chunk to ids.  Memory: one slice of at most 8 MB of text at a time, plus the cache.

Defined results: a null or empty text has no ids and decodes to the empty text;
ids outside the vocabulary decode to nothing; repeated rows give equal
results; an empty table gives an empty table.  All other columns pass through;
an input column named like an output column is replaced.
"""

from __future__ import annotations

import functools
import heapq
import json
import unicodedata
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from starling.llm.common import TOKENIZER, chunks_of, cut_tail, slices

SHORT = 64
NO_RANK = 1 << 62
ID_MASK = (1 << 20) - 1
LATIN = chr(0x250)     # texts below this code point need no library normaliser
CACHE = 400_000        # chunks per cache generation and worker
LONGEST_CACHED = 64    # bytes; longer chunks are encoded each time


def byte_symbols() -> list[str]:
    """The printable character standing for each byte in byte-level vocabularies.

    Printable Latin-1 bytes stand for themselves; the others take the code points
    from 256 upwards, in byte order.
    """
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


class RankArrayBPE:
    """Encoder and decoder for a tokenizers-JSON BPE vocabulary with word-end marks."""

    def __init__(self, spec: bytes):
        doc = json.loads(spec)
        model = doc["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        vocab = dict(model["vocab"])
        self.tokens = {i: t for t, i in vocab.items()}
        self.special = {}
        for t in doc["added_tokens"]:
            self.special[t["content"]] = t["id"]
            self.tokens[t["id"]] = t["content"]
        symbols = byte_symbols()
        self.library = Tokenizer.from_str(spec.decode())
        self.byte_of = {c: b for b, c in enumerate(symbols)}
        self.inner = [vocab[s] for s in symbols]
        self.last = [vocab[s + self.suffix] for s in symbols]
        # (left id, right id) as one integer -> rank and merged id as one integer, ordered by rank
        self.merges = {}
        for rank, (a, b) in enumerate(model["merges"]):
            self.merges.setdefault(vocab[a] << 20 | vocab[b], rank << 20 | vocab[a + b])
        split = next(p for p in doc["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pieces = regex.compile(split["pattern"]["Regex"])
        self.marks = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        size = max(self.tokens) + 1
        self.token_array = pa.array([self.tokens.get(i) for i in range(size)], pa.string())

    # ---- merging -------------------------------------------------------
    def merge_short(self, ids: list[int]) -> list[int]:
        """Scan for the smallest rank, delete a boundary, refresh the neighbours."""
        get = self.merges.get
        ranks = [get(a << 20 | b, NO_RANK) for a, b in zip(ids, ids[1:])]
        bounds = list(range(len(ids) + 1))
        while ranks and (least := min(ranks)) < NO_RANK:
            i = ranks.index(least)
            ids[i] = least & ID_MASK
            del ids[i + 1], bounds[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = get(ids[i] << 20 | ids[i + 1], NO_RANK)
            if i:
                ranks[i - 1] = get(ids[i - 1] << 20 | ids[i], NO_RANK)
        return ids

    def merge_long(self, ids: list[int]) -> list[int]:
        """The same merges, by (rank, position), from a heap over linked parts."""
        get, n = self.merges.get, len(ids)
        after, before, gone = list(range(1, n + 1)), list(range(-1, n - 1)), [False] * n
        heap = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n and (m := get(ids[i] << 20 | ids[j])):
                heapq.heappush(heap, (m, i, ids[i], ids[j]))

        for i in range(n - 1):
            offer(i)
        while heap:
            m, i, a, b = heapq.heappop(heap)
            j = after[i]
            if gone[i] or j >= n or ids[i] != a or ids[j] != b:
                continue
            ids[i], gone[j], after[i] = m & ID_MASK, True, after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [x for x, dead in zip(ids, gone) if not dead]

    def piece_ids(self, raw: bytes) -> list[int]:
        ids = [self.inner[b] for b in raw]
        ids[-1] = self.last[raw[-1]]
        return self.merge_short(ids) if len(ids) <= SHORT else self.merge_long(ids)

    def pieces_of(self, text: str) -> list[bytes]:
        """Normalised pieces; beyond Latin letters by the tokenizer's own normaliser and
        pattern, whose Unicode tables differ between versions for newer code points."""
        if text.isascii():
            return [p.encode() for p in self.pieces.findall(text.lower())]
        if max(text) < LATIN:
            return [p.encode() for p in self.pieces.findall(unicodedata.normalize("NFC", text).lower())]
        plain = self.library.normalizer.normalize_str(text)
        return [bytes(map(self.byte_of.__getitem__, p))
                for p, _ in self.library.pre_tokenizer.pre_tokenize_str(plain)]

    def chunk_ids(self, chunk: str) -> list[int]:
        """Ids of a text without cutting it at white space first."""
        out: list[int] = []
        for part in self.marks.split(chunk) if self.marks and self.marks.search(chunk) else (chunk,):
            if part in self.special:
                out.append(self.special[part])
            elif part:
                for piece in self.pieces_of(part):
                    out += self.piece_ids(piece)
        return out

    # ---- texts ---------------------------------------------------------
    def _miss(self, chunk: bytes) -> bytes:
        found = self.old.get(chunk)
        if found is None:
            body, tail = cut_tail(chunk)
            if tail:
                found = (self.young.get(body) or self._miss(body)) + (self.young.get(tail) or self._miss(tail))
            else:
                found = array("i", self.chunk_ids(chunk.decode("utf-8", "replace"))).tobytes()
        if len(chunk) <= LONGEST_CACHED:
            if len(self.young) >= CACHE:
                self.old, self.young = self.young, {}
            self.young[chunk] = found
        return found

    def encode_bytes(self, text: bytes) -> bytes:
        """Ids of a whole text as little-endian 32-bit integers."""
        get, miss = self.young.get, self._miss
        out = []
        for chunk in chunks_of(text):
            found = get(chunk)
            if found is None:
                found = miss(chunk)
                get = self.young.get
            out.append(found)
        return b"".join(out)

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_bytes(text.encode("utf-8", "replace")), dtype=np.int32).tolist()

    def decode(self, ids: list[int]) -> str:
        return " ".join(t for t in (self.tokens.get(i) for i in ids) if t is not None)

    def decode_lists(self, ids: pa.Array) -> pa.Array:
        """Decoded text of every list of ids."""
        ids = ids.cast(pa.list_(pa.int32()))
        flat = ids.flatten()
        size = len(self.token_array)
        known = pc.and_(pc.greater_equal(flat, 0), pc.less(flat, size))
        tokens = self.token_array.take(pc.if_else(known, flat, pa.scalar(None, pa.int32())))
        lengths = pc.fill_null(pc.list_value_length(ids), 0)
        offsets = np.concatenate([[0], np.cumsum(lengths.to_numpy(zero_copy_only=False))]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), tokens)
        if tokens.null_count:   # an unknown id decodes to nothing, not to an empty token
            return pa.array([" ".join(x for x in row if x is not None) for row in lists.to_pylist()],
                            pa.string())
        return pc.binary_join(lists, " ")


@functools.lru_cache(maxsize=2)
def encoder(spec: bytes) -> RankArrayBPE:
    return RankArrayBPE(spec)


def _spec(df: DataFrame, tokenizer: str):
    """The vocabulary file's bytes (2 MB), read by the driver and broadcast: executors need no such file."""
    with open(tokenizer, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def _map(df: DataFrame, column: str, new: list[tuple[str, T.DataType]], work, cast: str | None) -> DataFrame:
    """Add columns made from one column, batch by batch; the others pass through."""
    names = {n.lower() for n, _ in new}
    keep = [c for c in df.columns if c.lower() not in names]
    source = F.col(f"`{column}`")
    given = df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)],
                      (source.cast(cast) if cast else source).alias("src"))
    schema = T.StructType([T.StructField(f"c{i}", df.schema[c].dataType, True) for i, c in enumerate(keep)]
                          + [T.StructField(n, t, True) for n, t in new])
    out = given.mapInArrow(work, schema)
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(keep)], *[n for n, _ in new])


IDS = ("token_ids", T.ArrayType(T.IntegerType()))
DECODED = ("decoded", T.StringType())


def encode(df: DataFrame, text: str = "text", tokenizer: str = TOKENIZER, with_decoded: bool = False) -> DataFrame:
    """Add ``token_ids`` (array of int), and ``decoded`` (their text) if asked, in one pass."""
    spec = _spec(df, tokenizer)

    def work(batches):
        bpe = encoder(spec.value)
        for batch in batches:
            for piece in slices(batch, "src"):
                coded = [bpe.encode_bytes(t) if t else b"" for t in piece.column("src").to_pylist()]
                flat = pa.array(np.frombuffer(b"".join(coded), dtype=np.int32))
                offsets = np.concatenate([[0], np.cumsum([len(c) // 4 for c in coded])]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), flat)
                columns = [*piece.columns[:-1], ids]
                names = [*piece.schema.names[:-1], IDS[0]]
                if with_decoded:
                    columns.append(bpe.decode_lists(ids))
                    names.append(DECODED[0])
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return _map(df, text, [IDS, DECODED] if with_decoded else [IDS], work, "binary")


def decode(df: DataFrame, ids: str = "token_ids", tokenizer: str = TOKENIZER) -> DataFrame:
    """Add ``decoded``: the text of an array of ids."""
    spec = _spec(df, tokenizer)

    def work(batches):
        bpe = encoder(spec.value)
        for batch in batches:
            text = bpe.decode_lists(batch.column("src"))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], text],
                                             names=[*batch.schema.names[:-1], DECODED[0]])

    return _map(df, ids, [DECODED], work, None)
