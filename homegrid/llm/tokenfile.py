"""Token ids in binary files of independent zstandard frames with a trailing seek table.

A file holds the ids of its documents, one after another, as little-endian unsigned 32-bit
integers. They are cut into frames of ``FRAME`` ids; each is a whole zstandard frame with its
own checksum. Two skippable frames end the file: the directory of documents (an Arrow stream of
their ids and lengths) and the seek table of the seekable format: compressed size, plain size
and the low half of the XXH64 of every frame, then their number, a descriptor and a magic
number. A reader fetches the tail, and then only the frames that hold the documents it wants;
plain zstandard tools read the same file as one stream of ids.

Documents are sorted by id over all files: range partitions, one file each. A task writes under a
name of its own, and the manifest, which Spark commits, names the files of the attempts
that count. Files left by lost attempts are in no manifest and are never read.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Iterator, Sequence
from functools import reduce
from struct import pack, unpack

import numpy as np
import pyarrow as pa
import regex
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from homegrid.llm.arrow import SPACES, byte_set, chunks, column_of
from homegrid.llm.bpe import byte_letters

#: Ids in a frame: 128 KiB before compression.
FRAME = 1 << 15
#: Bytes of text for each file.
SHARD = 64 << 20
DIRECTORY, SEEK_TABLE, SEEKABLE = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
CHECKSUMS = 0x80
WORD = np.dtype("<u4")


def low_hash(data: bytes) -> int:
    return xxhash.xxh64_intdigest(data) & 0xFFFFFFFF


class FrameWriter:
    """Appends documents to an open binary sink; ``close`` writes directory and seek table."""

    def __init__(self, sink, id_type: pa.DataType, frame: int = FRAME, level: int = 3):
        self.sink, self.id_type, self.frame = sink, id_type, frame
        self.zstd = zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.held: list[np.ndarray] = []
        self.n_held = 0
        self.table: list[tuple[int, int, int]] = []
        self.ids: list = []
        self.lengths: list[int] = []

    def add(self, doc_id, ids: np.ndarray) -> None:
        self.ids.append(doc_id)
        self.lengths.append(len(ids))
        self.held.append(ids.astype(WORD, copy=False))
        self.n_held += len(ids)
        if self.n_held >= self.frame:
            row = np.concatenate(self.held)
            whole = len(row) - len(row) % self.frame
            for at in range(0, whole, self.frame):
                self.put(row[at : at + self.frame].tobytes())
            self.held, self.n_held = [row[whole:].copy()], len(row) - whole

    def put(self, plain: bytes) -> None:
        packed = self.zstd.compress(plain)
        self.sink.write(packed)
        self.table.append((len(packed), len(plain), low_hash(plain)))

    def skippable(self, magic: int, body: bytes) -> None:
        self.sink.write(pack("<II", magic, len(body)) + body)

    def close(self) -> None:
        if self.n_held:
            self.put(np.concatenate(self.held).tobytes())
        rows = pa.record_batch([pa.array(self.ids, self.id_type), pa.array(self.lengths, pa.int64())], ["doc_id", "n_tokens"])
        out = pa.BufferOutputStream()
        with pa.ipc.new_stream(out, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
            stream.write_batch(rows)
        body = out.getvalue().to_pybytes()
        body = pack("<Q", xxhash.xxh64_intdigest(body)) + body
        self.skippable(DIRECTORY, body)
        self.table.append((len(body) + 8, 0, low_hash(b"")))
        entries = b"".join(pack("<III", *entry) for entry in self.table)
        self.skippable(SEEK_TABLE, entries + pack("<IBI", len(self.table), CHECKSUMS, SEEKABLE))


class FrameReader:
    """Reads the tail of a seekable file at once and its frames one by one, each checked."""

    def __init__(self, source):
        self.source = source
        source.seek(0, os.SEEK_END)
        size = source.tell()
        n, descriptor, magic = unpack("<IBI", self.read(size - 9, 9))
        if magic != SEEKABLE or descriptor != CHECKSUMS:
            raise ValueError("the file has no seek table with checksums")
        tail = size - 9 - 12 * n
        if unpack("<II", self.read(tail - 8, 8)) != (SEEK_TABLE, 12 * n + 9):
            raise ValueError("the seek table is damaged")
        table = np.frombuffer(self.read(tail, 12 * n), WORD).reshape(n, 3).astype(np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(table[:, 0])])
        self.plain, self.hashes = table[:-1, 1], table[:-1, 2]
        self.starts = np.concatenate([[0], np.cumsum(self.plain // WORD.itemsize)])
        body = self.read(int(self.offsets[-2]) + 8, int(table[-1, 0]) - 8)
        if unpack("<Q", body[:8])[0] != xxhash.xxh64_intdigest(body[8:]):
            raise ValueError("the directory is damaged")
        with pa.ipc.open_stream(body[8:]) as stream:
            rows = stream.read_all()
        self.ids = rows.column("doc_id").combine_chunks()
        lengths = rows.column("n_tokens").to_numpy()
        self.at = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
        self.zstd = zstandard.ZstdDecompressor()
        self.frames_read = 0
        self.last: tuple[int, np.ndarray] = (-1, np.zeros(0, WORD))

    def read(self, at: int, n: int) -> bytes:
        self.source.seek(at)
        data = self.source.read(n)
        if len(data) != n:
            raise ValueError("the file is cut short")
        return data

    def frame(self, i: int) -> np.ndarray:
        if self.last[0] != i:
            packed = self.read(int(self.offsets[i]), int(self.offsets[i + 1] - self.offsets[i]))
            plain = self.zstd.decompress(packed, max_output_size=int(self.plain[i]))
            if len(plain) != self.plain[i] or low_hash(plain) != self.hashes[i]:
                raise ValueError(f"frame {i} is damaged")
            self.frames_read += 1
            self.last = i, np.frombuffer(plain, WORD)
        return self.last[1]

    def document(self, k: int) -> bytes:
        """The ids of the k-th document; opens only the frames that hold them."""
        first, end = int(self.at[k]), int(self.at[k + 1])
        out, i = [], int(np.searchsorted(self.starts, first, side="right")) - 1
        while first < end:
            row, base = self.frame(i), int(self.starts[i])
            out.append(row[first - base : end - base].tobytes())
            first, i = int(self.starts[i + 1]), i + 1
        return b"".join(out)


# -- encoding ----------------------------------------------------------------------------

#: The words of byte-level pre-tokenizers (fixed by the format).
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Entries of the cache of a worker, and the longest string that is kept in it.
CACHE, LONGEST = 800_000, 100
#: Bytes of text whose distinct parts are looked up together.
BLOCK = 4 << 20
BLANK = byte_set(SPACES)
# In UTF-8: white space outside ASCII, and signs which not every library takes for white space.
_ODD = re.compile(
    rb"[\x1c-\x1f]|\xc2[\x85\xa0]|\xe1(?:\x9a\x80|\xa0\x8e)|\xe2(?:\x80[\x80-\x8b\xa8\xa9\xaf]|\x81\x9f)|\xe3\x80\x80|\xef\xbb\xbf"
)


class Encoder:
    """Texts to ids with the tokenizers library, on one thread, without truncation or padding.

    Texts are cut before white space that follows another sign, which no word of a byte-level
    pre-tokenizer crosses. Of each block of text the distinct parts are encoded once, and what the
    library's model says of a part or a word is kept in a cache of bounded size. Texts with added
    tokens or odd white space, and parts with letters on which versions of Unicode may differ,
    go through the whole library, as do all texts of vocabularies of another kind.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        cut = spec["pre_tokenizer"] or {}
        plain = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
        self.by_word = bool(plain and spec["normalizer"] is None and spec["model"]["type"] == "BPE")
        self.added = [x["content"].encode() for x in spec["added_tokens"]]
        self.model = self.library.model
        self.letters = dict(enumerate(byte_letters()))
        self.cut_words = regex.compile(WORDS)
        self.known: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, WORD).tobytes()

    def word(self, word: str) -> bytes:
        found = self.model.tokenize(word.encode().decode("latin-1").translate(self.letters))
        return pack(f"<{len(found)}I", *[token.id for token in found])

    def part(self, part: str) -> bytes:
        """The ids, as bytes, of a run of white space and the other signs behind it."""
        if max(part) >= "\u0250":
            got = self.whole(part)
        elif part[0] == " " and part[1:].isalpha():  # one word, most of the time
            got = self.word(part)
        else:
            rows, known = [], self.known
            for word in self.cut_words.findall(part):
                if (ids := known.get(word)) is None:
                    ids = self.word(word)
                    if len(word) <= LONGEST:
                        known[word] = ids
                rows.append(ids)
            got = b"".join(rows)
        if len(part) <= LONGEST:
            self.known[part] = got
        return got

    def block(self, data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the parts between ``edges``, and how many each has."""
        if len(self.known) >= CACHE:
            self.known.clear()
        buffers = [None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(data)]
        coded = pa.Array.from_buffers(pa.large_string(), len(edges) - 1, buffers).dictionary_encode()
        known, part = self.known.get, self.part
        rows = [known(p) or part(p) for p in coded.dictionary.to_pylist()]
        lengths = np.fromiter(map(len, rows), np.int64, len(rows)) // WORD.itemsize
        starts = np.cumsum(lengths) - lengths
        which = coded.indices.to_numpy()
        sizes = lengths[which]
        before = np.cumsum(sizes) - sizes
        place = np.repeat(starts[which] - before, sizes) + np.arange(int(sizes.sum()))
        return np.frombuffer(b"".join(rows), WORD)[place], sizes

    def plain_rows(self, data: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
        """The ids of each row of a run of rows without odd signs."""
        if len(data) == 0:
            return [np.zeros(0, WORD)] * (len(at) - 1)
        blank = BLANK[data]
        cut = blank.copy()
        cut[1:] &= ~blank[:-1]
        cut[at[:-1][at[:-1] < len(data)]] = True
        edges = np.append(np.flatnonzero(cut), len(data))
        ids, sizes, k = [], [], 0
        while k < len(edges) - 1:
            end = max(int(np.searchsorted(edges, edges[k] + BLOCK, side="right")) - 1, k + 1)
            found, count = self.block(data[edges[k] : edges[end]], edges[k : end + 1] - edges[k])
            ids.append(found)
            sizes.append(count)
            k = end
        whole = np.concatenate(ids)
        total = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
        token_at = total[np.searchsorted(edges, at)]
        return [whole[a:b] for a, b in zip(token_at[:-1].tolist(), token_at[1:].tolist(), strict=True)]

    def encode(self, data: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
        """The ids of each text; texts lie in the bytes ``data`` between the offsets ``at``."""
        text = data.tobytes()
        odd = [m.start() for m in _ODD.finditer(text)]
        for added in self.added:
            odd += [m.start() for m in re.finditer(re.escape(added), text)]
        rows = sorted(set((np.searchsorted(at, odd, side="right") - 1).tolist())) if self.by_word else range(len(at) - 1)
        out, done = [], 0
        for k in [*rows, len(at) - 1]:
            out += self.plain_rows(data[at[done] : at[k]], at[done : k + 1] - at[done])
            if k < len(at) - 1:
                out.append(np.frombuffer(self.whole(text[at[k] : at[k + 1]].decode()), WORD))
            done = k + 1
        return out


_loaded: dict[str, Encoder] = {}


def loaded(path: str) -> Encoder:
    """One vocabulary for each Python worker."""
    if path not in _loaded:
        _loaded[path] = Encoder(path)
    return _loaded[path]


# -- files -------------------------------------------------------------------------------


def write_tokens(docs: DataFrame, folder: str, path: str, end: int = 0, shard: int = SHARD, frame: int = FRAME) -> DataFrame:
    """Writes the ids of every text, closed by ``end``, below ``folder``; returns the manifest.

    Files follow one another in ascending ``doc_id``, nulls first; rows of one id are in the order
    of a hash of their text. A null text is empty and has the closing id only. Repeated rows are
    documents of their own, an empty table gives a manifest without rows, and further columns of
    ``docs`` are left out. ``doc_id`` may be of any type that Spark sorts. A task holds a batch of
    texts, one piece of a long text, the ids of one document and one frame. ``path`` must exist on
    every executor; ``folder`` is one that all share.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    n_bytes = rows.agg(F.sum(F.octet_length("text").cast("long") + 8)).first()[0] or 0
    keys = ["doc_id", "hash", "tie"]
    ordered = (
        rows.withColumns({"hash": F.xxhash64("text"), "tie": F.monotonically_increasing_id()})
        .repartitionByRange(int(n_bytes // shard) + 1, *keys).sortWithinPartitions(*keys).drop("hash", "tie")
    )
    id_name = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, closing, writer, sink = loaded(path).encode, np.array([end], WORD), None, None
        number, n_tokens = TaskContext.get().partitionId(), 0
        for part, data, at in chunks(batches, most=BLOCK):
            ids = column_of(part, "doc_id")
            if writer is None:
                store, base = fs.FileSystem.from_uri(f"{folder}/files")
                store.create_dir(base, recursive=True)
                name = f"{number:06d}-{uuid.uuid4().hex}.zst"
                sink = store.open_output_stream(f"{base}/{name}", compression=None)
                writer = FrameWriter(sink, ids.type, frame)
            for doc_id, row in zip(ids.to_pylist(), encode(data, at), strict=True):
                writer.add(doc_id, np.concatenate([row, closing]))
                n_tokens += len(row) + 1
        if writer is not None:
            writer.close()
            sink.close()
            kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64(), writer.id_type, writer.id_type]
            values = [number, name, len(writer.ids), n_tokens, writer.ids[0], writer.ids[-1]]
            names = ["shard", "file", "n_docs", "n_tokens", "first_id", "last_id"]
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names)

    shape = f"shard int, file string, n_docs long, n_tokens long, first_id {id_name}, last_id {id_name}"
    ordered.mapInArrow(run, shape).write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def _read(files: DataFrame, folder: str, id_name: str, tasks: int, wanted: Sequence | None) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(f"{folder}/files")
        wish = None if wanted is None else set(wanted)
        for batch in batches:
            for name, before in zip(column_of(batch, "file").to_pylist(), column_of(batch, "before").to_pylist(), strict=True):
                with store.open_input_file(f"{base}/{name}") as source:
                    reader = FrameReader(source)
                    known = reader.ids
                    chosen = range(len(known)) if wish is None else [k for k, i in enumerate(known.to_pylist()) if i in wish]
                    for at in range(0, len(chosen), 500):
                        part = list(chosen[at : at + 500])
                        yield pa.RecordBatch.from_arrays(
                            [
                                known.take(pa.array(part, pa.int64())),
                                pa.array([before + int(reader.at[k]) for k in part], pa.int64()),
                                pa.array([int(reader.at[k + 1] - reader.at[k]) for k in part], pa.int64()),
                                pa.array([reader.document(k) for k in part], pa.binary()),
                            ],
                            ["doc_id", "start", "n_tokens", "ids"],
                        )

    spread = files.repartitionByRange(tasks, "shard") if tasks > 1 else files
    return spread.select("file", "before").mapInArrow(run, f"doc_id {id_name}, start long, n_tokens long, ids binary")


def read_tokens(spark: SparkSession, folder: str, wanted: Sequence | None = None) -> DataFrame:
    """doc_id, start, n_tokens and ids of all documents, or of those whose id is in ``wanted``.

    ``start`` counts the ids of all documents before this one, over all files. With ``wanted``, a
    short list without nulls, only files whose range has one of them are opened, and of those only
    the tail and the frames of wanted documents are read. Every frame is checked against its sum.
    The running sum over files is a window over one row per file.
    """
    manifest = spark.read.parquet(f"{folder}/manifest")
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.withColumn("before", F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0)))
    if wanted is not None:
        near = [F.lit(x).between(F.col("first_id"), F.col("last_id")) | F.col("first_id").isNull() for x in wanted]
        files = files.where(reduce(lambda a, b: a | b, near, F.lit(False)))
    return _read(files, folder, manifest.schema["first_id"].dataType.simpleString(), max(manifest.count(), 1), wanted)


def token_digests(read: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the CRC-32 of the ids as they were read back."""
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
