"""Token ids in files of fixed-width bits.

A file holds the ids of consecutive documents, each id in the fewest bits that the vocabulary
needs.  Blocks of 1,024 ids are packed on their own and an offset table says where each begins, so
any document can be read without the ones before it.  Layout, little-endian:

    blocks        packed ids, least significant bit first; the last block is filled up with zeros
    doc_ids       int64 each; nulls flagged by one byte each after them
    doc_starts    uint64 each, and the end of the last
    offsets       uint64 each, the byte at which a block begins
    trailer       n_docs, n_blocks, n_ids as uint64; width, block size as uint32; magic
"""

from __future__ import annotations

import os
import posixpath
import struct
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillwork.llm.common import query, stored, table
from tillwork.session import work_path

MAGIC = b"TILLTOK1"
BLOCK = 1024
#: blocks that are packed or unpacked at a time
RUN = 128
_TRAILER = struct.Struct("<QQQII8s")
#: words whose ids one Python worker keeps; others are encoded again, with the same result
REMEMBERED = 900_000


def bit_width(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def packed(ids: np.ndarray, width: int) -> bytes:
    """Eight ids make ``width`` bytes; the length is a multiple of eight."""
    groups = ids.reshape(-1, 8).astype(np.uint64)
    out = np.zeros((len(groups), width), np.uint8)
    for j in range(8):
        byte, shift = divmod(j * width, 8)
        value = groups[:, j] << np.uint64(shift)
        for k in range((width + shift + 7) // 8):
            out[:, byte + k] |= (value >> np.uint64(8 * k)).astype(np.uint8)
    return out.tobytes()


def unpacked(data: bytes, width: int) -> np.ndarray:
    rows = np.frombuffer(data, np.uint8).reshape(-1, width)
    out = np.empty((len(rows), 8), np.uint32)
    mask = np.uint64((1 << width) - 1)
    for j in range(8):
        byte, shift = divmod(j * width, 8)
        value = np.zeros(len(rows), np.uint64)
        for k in range((width + shift + 7) // 8):
            value |= rows[:, byte + k].astype(np.uint64) << np.uint64(8 * k)
        out[:, j] = (value >> np.uint64(shift)) & mask
    return out.reshape(-1)


class TokenFileWriter:
    """Takes documents one after another; keeps a run of blocks and the tables in memory."""

    def __init__(self, out, width: int):
        self.out, self.width = out, width
        self.buffer: list[np.ndarray] = []
        self.waiting = self.n_ids = self.at = 0
        self.doc_ids: list[int | None] = []
        self.starts, self.offsets = [0], []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_id)
        self.n_ids += len(ids)
        self.starts.append(self.n_ids)
        self.buffer.append(ids)
        self.waiting += len(ids)
        if self.waiting >= BLOCK * RUN:
            self._flush(self.waiting // BLOCK * BLOCK)

    def _flush(self, n: int) -> None:
        ids = np.concatenate(self.buffer) if self.buffer else np.zeros(0, np.uint32)
        now = ids[:n]
        now = np.pad(now, (0, -len(now) % BLOCK))
        step = BLOCK // 8 * self.width
        self.offsets += range(self.at, self.at + len(now) // BLOCK * step, step)
        data = packed(now, self.width)
        self.out.write(data)
        self.at += len(data)
        self.buffer, self.waiting = [ids[n:]], max(0, len(ids) - n)

    def close(self) -> None:
        if self.waiting:
            self._flush(self.waiting)
        self.out.write(np.array([i or 0 for i in self.doc_ids], "<i8").tobytes())
        self.out.write(np.array([i is None for i in self.doc_ids], np.uint8).tobytes())
        self.out.write(np.array(self.starts, "<u8").tobytes())
        self.out.write(np.array(self.offsets, "<u8").tobytes())
        sizes = (len(self.doc_ids), len(self.offsets), self.n_ids, self.width, BLOCK)
        self.out.write(_TRAILER.pack(*sizes, MAGIC))


class TokenFile:
    """Reads a file; ``source`` is a random-access Arrow file."""

    def __init__(self, source):
        self.source = source
        end = source.size() - _TRAILER.size
        self.n_docs, n_blocks, self.n_ids, self.width, self.block, magic = _TRAILER.unpack(
            source.read_at(_TRAILER.size, end)
        )
        if magic != MAGIC:
            raise ValueError("not a token file")
        tables = 9 * self.n_docs + 8 * (self.n_docs + 1) + 8 * n_blocks
        raw = source.read_at(tables, end - tables)
        ids = np.frombuffer(raw, "<i8", self.n_docs)
        missing = np.frombuffer(raw, np.uint8, self.n_docs, 8 * self.n_docs)
        self.doc_ids = [None if m else i for i, m in zip(ids.tolist(), missing, strict=True)]
        self.starts = np.frombuffer(raw, "<u8", self.n_docs + 1, 9 * self.n_docs).tolist()
        self.offsets = np.frombuffer(raw, "<u8", n_blocks, tables - 8 * n_blocks).tolist()

    def _blocks(self, first: int, last: int) -> np.ndarray:
        """The ids of blocks first .. last - 1."""
        if first >= last:
            return np.zeros(0, np.uint32)
        size = self.offsets[last - 1] + self.block // 8 * self.width - self.offsets[first]
        return unpacked(self.source.read_at(size, self.offsets[first]), self.width)

    def document(self, i: int) -> np.ndarray:
        """The ids of the i-th document, from the blocks that hold it alone."""
        start, stop = self.starts[i], self.starts[i + 1]
        first = start // self.block
        ids = self._blocks(first, -(-stop // self.block))
        return ids[start - first * self.block : stop - first * self.block]

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, start, ids) of all documents, a run of blocks in memory at a time."""
        base, held = 0, np.zeros(0, np.uint32)
        for doc_id, (start, stop) in zip(self.doc_ids, pairwise(self.starts), strict=True):
            if stop > base + len(held):
                base = start // self.block * self.block
                last = min(len(self.offsets), max(-(-stop // self.block), base // self.block + RUN))
                held = self._blocks(base // self.block, last)
            yield doc_id, start, held[start - base : stop - base]


class Encoder:
    """A tokenizer of the ``tokenizers`` library, remembering the ids of words.

    ``by_word``: the tokenizer drops white space and lower-cases, so a text's ids are those of its
    words in A-Z lower case, one after the other.  A text that may spell a special token is always
    encoded whole.
    """

    def __init__(self, definition: str, by_word: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.by_word = Tokenizer.from_str(definition), by_word
        self.known: dict[bytes, bytes] = {}
        specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special_marks = [s.lower().encode() for s in specials]

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [
            np.array(e.ids, "<u4").tobytes()
            for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        ]

    def encode(self, texts: list[str]) -> list[bytes]:
        """For each text its ids as little-endian unsigned 32-bit integers."""
        if not self.by_word:
            return self._ids(texts)
        out: list[bytes] = []
        for text in texts:
            raw = text.encode().lower()
            if any(mark in raw for mark in self.special_marks):
                out += self._ids([text])
                continue
            words = raw.split()
            new = list({w for w in words if w not in self.known})
            more = dict(zip(new, self._ids([w.decode() for w in new]), strict=True)) if new else {}
            if len(self.known) + len(new) <= REMEMBERED:
                self.known.update((w, i) for w, i in more.items() if len(w) < 64)
            known = self.known
            out.append(b"".join([known[w] if w in known else more[w] for w in words]))
        return out


@lru_cache(maxsize=1)
def _encoder(definition: str, by_word: bool) -> Encoder:
    return Encoder(definition, by_word)


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder)


def write_token_files(docs: DataFrame, definition: str, end_id: int, folder: str, by_word: bool = False) -> DataFrame:
    """Encode every text and write the ids to files in ``folder``, in ascending order of doc_id.

    ``docs`` needs doc_id and text; other columns are left behind.  A null text is empty; each
    document ends with ``end_id``.  Null ids come first; rows that share an id follow each other in
    an order fixed by their text.  Returns one row a file in that order: file, n_docs, n_ids and
    base, the number of ids in all files before it.  A task writes under a name of its own and only
    tasks that succeed report theirs, so a lost or repeated task leaves at most a file that no row
    names.  ``folder`` is one that all executors share, as a path or URI.
    """
    from tokenizers import Tokenizer

    width = bit_width(max(Tokenizer.from_str(definition).get_vocab_size(), end_id + 1))
    end = np.array([end_id], "<u4").tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = None
        for batch in batches:
            if writer is None and batch.num_rows:
                store, at = _open(folder)
                store.create_dir(at)
                name = posixpath.join(at, f"{os.urandom(12).hex()}.tok")
                first = batch.slice(0, 1)
                out = store.open_output_stream(name)
                writer = TokenFileWriter(out, width)
            encoder = _encoder(definition, by_word)
            for small in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                texts = [t or "" for t in small.column("text").to_pylist()]
                for doc_id, ids in zip(small.column("doc_id").to_pylist(), encoder.encode(texts), strict=True):
                    writer.add(doc_id, np.frombuffer(ids + end, "<u4"))
        if writer is not None:
            writer.close()
            out.close()
            yield pa.RecordBatch.from_pydict(
                {
                    "file": [posixpath.basename(name)],
                    "n_docs": [len(writer.doc_ids)],
                    "n_ids": [writer.n_ids],
                    "first_id": first.column("doc_id"),
                    "first_tie": first.column("tie"),
                }
            )

    ordered = (
        docs.select(F.col("doc_id").cast("long"), "text")
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange(F.col("doc_id").asc_nulls_first(), F.col("tie"))
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "tie", "text")
    )
    files = stored(
        ordered.mapInArrow(write, "file string, n_docs long, n_ids long, first_id long, first_tie long"), "token-files"
    )
    # one row a file
    before = Window.orderBy(F.col("first_id").asc_nulls_first(), "first_tie").rowsBetween(Window.unboundedPreceding, -1)
    return files.select("file", "n_docs", "n_ids", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))


def read_token_files(files: DataFrame, folder: str, row: Callable[[np.ndarray], dict], schema: str) -> DataFrame:
    """(doc_id, start, n_tokens) of every document of the files, and what ``row`` makes of its ids.

    ``files`` as ``write_token_files`` returns it; ``start`` counts the ids of all documents before.
    ``row`` maps ids to a dict of the columns that ``schema`` names.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, at = _open(folder)
        for batch in batches:
            for file in batch.to_pylist():
                with store.open_input_file(posixpath.join(at, file["file"])) as source:
                    rows = []
                    for doc_id, start, ids in TokenFile(source).documents():
                        rows.append({"doc_id": doc_id, "start": file["base"] + start, "n_tokens": len(ids), **row(ids)})
                        if len(rows) == 10_000:
                            yield pa.RecordBatch.from_pylist(rows, schema=arrow)
                            rows = []
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    whole = StructType.fromDDL(f"doc_id long, start long, n_tokens long, {schema}")
    arrow = to_arrow_schema(whole)
    # a task for each file; a small table would otherwise be read in one
    spread = files.repartition(max(1, files.count()), "file")
    return spread.mapInArrow(read, whole)


def checksum(ids: np.ndarray) -> dict:
    return {"ids_crc32": zlib.crc32(ids.astype("<u4").tobytes())}


@query("op10_token_files")
def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document written to packed files and read back."""
    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        definition = f.read()
    folder = work_path(spark, "tokens")
    files = write_token_files(table(spark, sf_dir, "documents"), definition, 2, folder, by_word=True)
    return read_token_files(files, folder, checksum, "ids_crc32 long")
