"""Byte-pair encoding and decoding with a public vocabulary.

Each word is a contiguous array of symbols beside an array with the merge rank of every
adjacent pair. The encoder scans for the smallest rank, deletes that boundary and refreshes
the two neighbouring ranks, until no pair has a rank. Words of ``LONG`` symbols or more, for
which repeated scans would be quadratic, keep the same pairs in a heap.

Texts are cut at white space first, which no token crosses, and what has been encoded is kept
in a cache of bounded size: a task scans arrays only for strings it has not seen lately.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from homegrid.llm.arrow import column_of

LONG = 400
NONE = (1 << 60, -1)
CACHE = 300_000


def public_vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if printable, else the next free one from U+0100."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    free = iter(range(256, 512))
    return [chr(b) if b in set(shown) else chr(next(free)) for b in range(256)]


class Bpe:
    """A vocabulary with word ends, read from a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end = model.get("end_of_word_suffix") or ""
        self.ranks: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            made = a + b
            self.ranks[self.vocab[a], self.vocab[b]] = (rank, self.vocab[made])
        added = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.tokens = [""] * (1 + max([*self.vocab.values(), *added.values()]))
        for token, i in [*self.vocab.items(), *added.items()]:
            self.tokens[i] = token
        self.special = added
        self.cut = regex.compile("|".join(map(regex.escape, sorted(added, key=len, reverse=True)))) if added else None
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.split = regex.compile(split["pattern"]["Regex"])
        self.cutter = Tokenizer.from_file(path)  # normal form and split of scripts outside Latin
        letters = byte_letters()
        self.bytes = {x: b for b, x in enumerate(letters)}
        self.inner = [self.vocab.get(x) for x in letters]
        self.last = [self.vocab.get(x + self.end) for x in letters]
        self.cache: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def symbols(self, word: str) -> list[int]:
        data, inner = word.encode("utf-8"), self.inner
        out = [inner[b] for b in data]
        out[-1] = self.last[data[-1]]
        return out

    def merge(self, parts: list[int]) -> list[int]:
        """Scan for the smallest rank, delete the boundary, refresh the neighbours."""
        known = self.ranks.get
        if len(parts) >= LONG:
            return self.merge_long(parts)
        ranks = [known(p, NONE) for p in zip(parts, parts[1:])]  # noqa: B905
        while ranks and (least := min(ranks)) is not NONE:
            i = ranks.index(least)
            parts[i] = made = least[1]
            del parts[i + 1], ranks[i]
            if i:
                ranks[i - 1] = known((parts[i - 1], made), NONE)
            if i < len(ranks):
                ranks[i] = known((made, parts[i + 1]), NONE)
        return parts

    def merge_long(self, parts: list[int]) -> list[int]:
        """The same merges in the same order, smallest rank and then leftmost, from a heap."""
        n, known = len(parts), self.ranks.get
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = []

        def offer(i: int) -> None:
            j = after[i]
            if j >= 0 and (p := known((parts[i], parts[j]))):
                heapq.heappush(heap, (p[0], i, j, p[1]))

        for i in range(n):
            offer(i)
        while heap:
            rank, i, j, made = heapq.heappop(heap)
            if parts[i] < 0 or after[i] != j or parts[j] < 0:
                continue
            if (p := known((parts[i], parts[j]))) is None or p[0] != rank:
                continue
            parts[i], parts[j] = made, -1
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
                offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [x for x in parts if x >= 0]

    def words(self, text: str) -> list[str]:
        """Normal form (NFC, lower case letter by letter) and split of a text without white space."""
        if text.isascii():
            text = text.lower()
            return [text] if text.isalpha() else self.split.findall(text)
        if max(text) < "\u0250":  # Latin, where all versions of Unicode agree
            return self.split.findall(unicodedata.normalize("NFC", text).lower())
        pieces = self.cutter.pre_tokenizer.pre_tokenize_str(self.cutter.normalizer.normalize_str(text))
        return [bytes(map(self.bytes.__getitem__, p)).decode("utf-8") for p, _ in pieces]

    def word(self, word: str) -> bytes:
        if (got := self.cache.get(word)) is None:
            ids = self.merge(self.symbols(word))
            got = pack(f"<{len(ids)}I", *ids)
            if len(word) < LONG:
                self.cache[word] = got
        return got

    def piece(self, text: str) -> bytes:
        """The ids, as little-endian 32-bit integers, of a text without white space."""
        if len(self.cache) >= CACHE:
            self.cache.clear()
        got = b"".join([self.word(w) for w in self.words(text)])
        if len(text) < LONG:
            self.pieces[text] = got
        return got

    def plain(self, text: str) -> bytes:
        known, piece = self.pieces.get, self.piece
        if len(self.pieces) >= CACHE:
            self.pieces.clear()
        # str.split also cuts at the four separators U+001C to U+001F, which are no white space here
        odd = any(c in text for c in "\x1c\x1d\x1e\x1f")
        parts = regex.split(r"\s+", text) if odd else text.split()
        return b"".join([known(p) or piece(p) for p in parts])

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers; added tokens are found in the raw text."""
        if self.cut is None or not any(x in text for x in self.special):
            return self.plain(text)
        out, at = [], 0
        for m in self.cut.finditer(text):
            out += [self.plain(text[at : m.start()]), np.asarray([self.special[m[0]]], "<u4").tobytes()]
            at = m.end()
        return b"".join([*out, self.plain(text[at:])])

    def decode(self, ids: bytes) -> str:
        """The tokens with a space between them: the file names no decoder."""
        return " ".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_loaded: dict[str, Bpe] = {}


def loaded(path: str) -> Bpe:
    """One vocabulary, and one cache, for each Python worker."""
    if path not in _loaded:
        _loaded[path] = Bpe(path)
    return _loaded[path]


def encode(docs: DataFrame, path: str, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``docs``' id with ``ids`` (little-endian 32-bit integers), ``n_tokens`` and ``decoded``.

    A null text counts as empty, an empty one has no token. Repeated rows and null ids give a
    row each; other columns of ``docs`` are left out. ``path`` must exist on every executor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                ids = [bpe.encode(t or "") for t in column_of(part, "text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        column_of(part, id_col),
                        pa.array([len(x) // 4 for x in ids], pa.int64()),
                        pa.array(ids, pa.binary()),
                        pa.array([bpe.decode(x) for x in ids], pa.string()),
                    ],
                    [id_col, "n_tokens", "ids", "decoded"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(id_col, F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, f"{id_col} {kind}, n_tokens long, ids binary, decoded string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Per document the number of tokens and the SHA-256 of the ids and of the decoded text.

    The hashes are taken where the texts are encoded, so that no ids leave the task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path)
        for batch in batches:
            texts = column_of(batch, "text")
            n, first, second = [], [], []
            for i in range(batch.num_rows):
                ids = bpe.encode(texts[i].as_py() or "")
                n.append(len(ids) // 4)
                first.append(hashlib.sha256(ids).hexdigest())
                second.append(hashlib.sha256(bpe.decode(ids).encode("utf-8")).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [column_of(batch, "doc_id"), pa.array(n, pa.int64()), pa.array(first, pa.string()), pa.array(second, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
