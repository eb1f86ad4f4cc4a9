"""Token ids as wavelet matrices: one file per shard, read for access, counting and occurrence lookup."""

from __future__ import annotations

import io
import os
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import Query, file_store, settled, table, text_hash
from tidemark.session import work_dir

TOKENIZER, END = "word_bpe_49k.json", 1
SHARD_TOKENS = 8_000_000  # a task closes a file when it holds this many ids
_MAGIC, _BLOCK = b"WVMX\x02\x00\x00\x00", 512  # bits between two counts of the rank directory
_PART = 50_000  # occurrences looked up at once
_CACHED = 500_000  # remembered pieces of a worker; beyond that it forgets them all
_LONGEST = 64  # longer pieces are not remembered, so that memory stays bounded

# Texts of these characters alone split alike in the tokenizer and here; words with others go through it whole.
_SIMPLE = re.compile(r"[\x09-\x0d\x20-\x7e\xc0-\xd6\xd8-\xf6\xf8-\xff]*").fullmatch
_PIECES = re.compile(
    r"[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|'s|'t|'re|'ve|'m|'ll|'d|[^\x09-\x0d\x20a-z\xdf-\xf6\xf8-\xff0-9]+"
).findall
# The characters that stand for bytes in a byte-level vocabulary: visible ones for themselves, others from 256 on.
_VISIBLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_SPELLED = dict(zip((b for b in range(256) if b not in _VISIBLE), range(256, 512)))


class _Pieces(dict):
    """Ids of pieces, asked of the tokenizer's model when they are first met."""

    def __init__(self, model):
        super().__init__()
        self.tokenize = model.tokenize

    def __missing__(self, piece: str) -> bytes:
        spelled = piece if piece.isascii() else piece.encode("utf-8").decode("latin-1").translate(_SPELLED)
        ids = array("H", [t.id for t in self.tokenize(spelled)]).tobytes()
        if len(piece) <= _LONGEST:
            self[piece] = ids
        return ids


class _Words(dict):
    """Ids of lower-cased words of simple characters, joined from their pieces when they are first met."""

    def __init__(self, pieces: _Pieces):
        super().__init__()
        self.piece = pieces.__getitem__

    def __missing__(self, word: str) -> bytes:
        ids = b"".join(map(self.piece, _PIECES(word)))
        if len(word) <= _LONGEST:
            self[word] = ids
        return ids


class Encoder:
    """Ids of whole texts by the public tokenizer, each piece and each word encoded once and remembered.

    The tokenizer never merges across white space, and it splits words into letters, single digits and signs
    before it merges; so the ids of a text are those of its pieces in order. A test holds this against whole texts.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.special = tuple(t.content for t in self.whole.get_added_tokens_decoder().values())
        self.pieces = _Pieces(self.whole.model)
        self.simple = _Words(self.pieces)
        self.words: dict[str, bytes] = {}

    def _plain(self, text: str) -> bool:
        return bool(_SIMPLE(text)) and not any(s in text for s in self.special)

    def _word(self, word: str) -> bytes:
        """A word that may have any characters."""
        if self._plain(word):
            return self.simple[word.lower()]
        known = self.words.get(word)
        if known is None:
            known = np.array(self.whole.encode(word, add_special_tokens=False).ids, np.uint16).tobytes()
            if len(word) <= _LONGEST:
                self.words[word] = known
        return known

    def encode(self, text: str | None) -> bytes:
        """The ids of a text as little-endian 16-bit numbers; none for null and empty texts."""
        if not text:
            return b""
        for known in (self.pieces, self.simple, self.words):
            if len(known) > _CACHED:
                known.clear()
        if self._plain(text):  # of white space, simple characters are those alone that end a word
            return b"".join(map(self.simple.__getitem__, text.lower().split()))
        return b"".join([self._word(w) for w in _WORDS(text)])


_WORDS = re.compile(r"[^\x20\x09-\x0D]+").findall


@lru_cache(maxsize=1)
def _encoder(path: str) -> Encoder:
    """One for each worker process, so what it remembers serves all its tasks."""
    return Encoder(path)


def directory(plane: np.ndarray) -> np.ndarray:
    """Ones of a plane before each of its blocks, and of all blocks."""
    per_block = np.bitwise_count(_blocks(plane)[:-1]).sum(axis=1, dtype=np.int64)
    return np.concatenate(([0], np.cumsum(per_block))).astype("<u4")


def _blocks(plane: np.ndarray) -> np.ndarray:
    """The words of a plane, a row for each block and an empty one behind them."""
    octets = np.zeros((-(-len(plane) // (_BLOCK // 8)) + 1) * (_BLOCK // 8), np.uint8)
    octets[: len(plane)] = plane
    return octets.view("<u8").reshape(-1, _BLOCK // 64)


class WaveletMatrix:
    """Bit-planes of a sequence of symbols with rank directories.

    Symbols are first ranked by frequency, so high planes are mostly zero. Plane by plane, from the highest bit, the
    sequence is parted stably into zeros, then ones.
    """

    def __init__(self, symbols: np.ndarray, size: int, planes: list[np.ndarray], zeros: list[int], counts: list[np.ndarray] | None = None):
        self.symbols, self.size, self.planes, self.zeros = symbols, size, planes, zeros
        self.number = {int(s): i for i, s in enumerate(symbols)}
        self.counts = [directory(p) for p in planes] if counts is None else counts
        self._words: dict[int, np.ndarray] = {}

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        counts = np.bincount(ids, minlength=1)
        symbols = np.argsort(-counts, kind="stable")[: np.count_nonzero(counts)].astype(np.uint32)
        rank = np.zeros(len(counts), np.uint16)
        rank[symbols] = np.arange(len(symbols))
        now, planes, zeros = rank[ids], [], []
        for bit in range(max(len(symbols) - 1, 0).bit_length() - 1, -1, -1):
            ones = (now & np.uint16(1 << bit)) != 0
            planes.append(np.packbits(ones, bitorder="little"))
            low, high = now[~ones], now[ones]
            zeros.append(len(low))
            now = np.concatenate((low, high))
        return cls(symbols, len(ids), planes, zeros)

    def _ones(self, level: int, end: int) -> int:
        """Ones of a plane before position `end`."""
        block = end // _BLOCK
        rest = np.unpackbits(self.planes[level][block * _BLOCK // 8 : -(-end // 8)], bitorder="little")[: end - block * _BLOCK]
        return int(self.counts[level][block]) + int(rest.sum())

    def _bit(self, level: int, at: int) -> int:
        return int(self.planes[level][at >> 3]) >> (at & 7) & 1

    def access(self, at: int) -> int:
        """The symbol at a position."""
        value = 0
        for level in range(len(self.planes)):
            bit, ones = self._bit(level, at), self._ones(level, at)
            value = value << 1 | bit
            at = self.zeros[level] + ones if bit else at - ones
        return int(self.symbols[value])

    def _range(self, number: int, end: int) -> tuple[int, int]:
        """Where the occurrences of a symbol before `end` stand below the last plane."""
        start = 0
        for level in range(len(self.planes)):
            a, b = self._ones(level, start), self._ones(level, end)
            if number >> (len(self.planes) - 1 - level) & 1:
                start, end = self.zeros[level] + a, self.zeros[level] + b
            else:
                start, end = start - a, end - b
        return start, end

    def rank(self, symbol: int, end: int | None = None) -> int:
        """Occurrences of a symbol before position `end`, of all by default."""
        number = self.number.get(symbol)
        if number is None:
            return 0
        start, stop = self._range(number, self.size if end is None else end)
        return stop - start

    def _place(self, level: int, bit: int, nth: int) -> int:
        """Position of the `nth` (from 0) one or zero of a plane, by bisection over the ranks."""
        low, high = 0, self.size
        while low < high:
            middle = (low + high) // 2
            ones = self._ones(level, middle + 1)
            if (ones if bit else middle + 1 - ones) > nth:
                high = middle
            else:
                low = middle + 1
        return low

    def select(self, symbol: int, nth: int) -> int:
        """Position of the `nth` occurrence, from 0, of a symbol; -1 if there are fewer."""
        number = self.number.get(symbol)
        if number is None or not 0 <= nth < self.rank(symbol):
            return -1
        at = self._range(number, self.size)[0] + nth
        for level in range(len(self.planes) - 1, -1, -1):
            bit = number >> (len(self.planes) - 1 - level) & 1
            at = self._place(level, bit, at - self.zeros[level] if bit else at)
        return at

    def _block_words(self, level: int, block: np.ndarray) -> np.ndarray:
        if level not in self._words:
            self._words[level] = _blocks(self.planes[level])
        return self._words[level][block]

    def _ones_before(self, level: int, ends: np.ndarray) -> np.ndarray:
        """Ones of a plane before each of many positions."""
        block = ends // _BLOCK
        taken = np.clip((ends - block * _BLOCK)[:, None] - np.arange(0, _BLOCK, 64), 0, 64)
        part = (np.uint64(1) << np.minimum(taken, 63).astype(np.uint64)) - np.uint64(1)
        masks = np.where(taken == 64, ~np.uint64(0), part)
        inside = np.bitwise_count(self._block_words(level, block) & masks).sum(axis=1, dtype=np.int64)
        return self.counts[level][block].astype(np.int64) + inside

    def ranks(self, symbol: int, ends: np.ndarray) -> np.ndarray:
        """Occurrences of a symbol before each of many positions."""
        number, now = self.number.get(symbol), np.asarray(ends, np.int64)
        if number is None:
            return np.zeros(len(now), np.int64)
        start = 0
        for level in range(len(self.planes)):
            a, b = self._ones(level, start), self._ones_before(level, now)
            if number >> (len(self.planes) - 1 - level) & 1:
                start, now = self.zeros[level] + a, self.zeros[level] + b
            else:
                start, now = start - a, now - b
        return now - start

    def _places(self, level: int, bit: int, nth: np.ndarray) -> np.ndarray:
        """Positions of many ones or zeros of a plane: their block by the directory, then their word, then their bit."""
        before = self.counts[level].astype(np.int64)
        if not bit:
            before = np.arange(len(before)) * _BLOCK - before
        block = np.searchsorted(before, nth, side="right") - 1
        words, left, row = self._block_words(level, block), nth - before[block], np.arange(len(nth))
        words = words if bit else ~words
        running = np.cumsum(np.bitwise_count(words), axis=1, dtype=np.int64)
        word = (running <= left[:, None]).sum(axis=1)
        left = left - np.where(word > 0, running[row, word - 1], 0)
        bits = np.unpackbits(np.ascontiguousarray(words[row, word]).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        inside = (np.cumsum(bits, axis=1, dtype=np.int16) <= left[:, None]).sum(axis=1)
        return block * _BLOCK + word * 64 + inside

    def positions(self, symbol: int) -> Iterator[np.ndarray]:
        """All occurrences of a symbol in ascending order, by select, some ten thousands at a time."""
        number = self.number.get(symbol)
        start, stop = (0, 0) if number is None else self._range(number, self.size)
        for low in range(start, stop, _PART):
            at = np.arange(low, min(low + _PART, stop))
            for level in range(len(self.planes) - 1, -1, -1):
                bit = number >> (len(self.planes) - 1 - level) & 1
                at = self._places(level, bit, at - self.zeros[level] if bit else at)
            yield at

    def decode(self) -> np.ndarray:
        """The whole sequence: from the last plane up, each parting is undone."""
        values = np.zeros(self.size, np.uint16)
        for level in range(len(self.planes) - 1, -1, -1):
            ones = np.unpackbits(self.planes[level], count=self.size, bitorder="little").view(bool)
            back = np.empty(self.size, np.uint16)
            back[~ones] = values[: self.zeros[level]]
            back[ones] = values[self.zeros[level] :] | np.uint16(1 << (len(self.planes) - 1 - level))
            values = back
        return self.symbols[values] if len(self.symbols) else values.astype(np.uint32)


def packed(matrix: WaveletMatrix, doc_ids: np.ndarray, known: np.ndarray, ends: np.ndarray) -> bytes:
    """A file: head, then Zstandard blocks: document ids, whether known, ends, symbols, planes, rank directories; all with checksums."""
    squeeze = zstandard.ZstdCompressor(level=1).compress
    out = io.BytesIO()
    head = _MAGIC + struct.pack(f"<QII{len(matrix.zeros)}Q", matrix.size, len(doc_ids), len(matrix.planes), *matrix.zeros)
    out.write(head + struct.pack("<I", zlib.crc32(head)))
    for part in (doc_ids.astype("<i8"), known.astype(np.uint8), ends.astype("<i8"), matrix.symbols.astype("<u4"), *matrix.planes, *matrix.counts):
        block = squeeze(part.tobytes())
        out.write(struct.pack("<QI", len(block), zlib.crc32(block)) + block)
    return out.getvalue()


def unpacked(data: bytes) -> tuple[WaveletMatrix, np.ndarray, np.ndarray, np.ndarray]:
    """Matrix, document ids, whether known, and ends of a file; raises ValueError if it is damaged."""
    if data[:8] != _MAGIC or len(data) < 24:
        raise ValueError("not a wavelet matrix file")
    size, docs, levels = struct.unpack_from("<QII", data, 8)
    at, parts = 24 + 8 * levels, []
    if levels > 16 or len(data) < at + 4 or struct.unpack_from("<I", data, at)[0] != zlib.crc32(data[:at]):
        raise ValueError("damaged head")
    zeros = list(struct.unpack_from(f"<{levels}Q", data, 24))
    at += 4
    for _ in range(4 + 2 * levels):
        length, check = struct.unpack_from("<QI", data, at)
        block = data[at + 12 : at + 12 + length]
        if len(block) != length or zlib.crc32(block) != check:
            raise ValueError("damaged wavelet matrix file")
        parts.append(zstandard.ZstdDecompressor().decompress(block))
        at += 12 + length
    if at != len(data):
        raise ValueError("bytes after the last block")
    ids, known, ends = np.frombuffer(parts[0], "<i8"), np.frombuffer(parts[1], np.uint8), np.frombuffer(parts[2], "<i8")
    planes = [np.frombuffer(p, np.uint8) for p in parts[4 : 4 + levels]]
    counts = [np.frombuffer(p, "<u4") for p in parts[4 + levels :]]
    if any(len(c) != -(-len(p) // (_BLOCK // 8)) + 1 for p, c in zip(planes, counts)):
        raise ValueError("a rank directory does not fit its plane")
    if len(ids) != docs or len(ends) != docs or (docs and ends[-1] != size):
        raise ValueError("counts differ from the head")
    return WaveletMatrix(np.frombuffer(parts[3], "<u4"), size, planes, zeros, counts), ids, known, ends


_MANIFEST = "path string, first_part int, file int, n_docs long, n_tokens long"


def write(docs: DataFrame, folder: str, tokenizer: str, doc_id: str = "doc_id", text: str = "text",
          shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Writes the ids of all documents to files in `folder`; gives their manifest, in order of `(first_part, file)`.

    Documents stand in ascending doc_id order (null ids first; equal ids by a hash of their texts) over all
    files: rows are dealt out by ranges of doc_id, each task writes its range. Each document ends with id 1; a null
    text is empty. A file is named anew in each attempt and only those of finished tasks are listed, so a lost
    executor or a repeated task leaves no wrong rows.
    """
    folder = folder.rstrip("/")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        encoder, (store, base) = _encoder(tokenizer), file_store(folder)
        store.create_dir(base, recursive=True)
        part, made, held = TaskContext.get().partitionId(), [], []

        def flush() -> None:
            ids = np.frombuffer(b"".join(codes for _, _, codes in held), np.uint16)
            ends = np.cumsum([len(codes) // 2 for _, _, codes in held])
            numbers, known = np.array([n for n, _, _ in held], np.int64), np.array([k for _, k, _ in held], np.uint8)
            name = f"{part:08d}-{len(made):04d}-{uuid.uuid4().hex}.wvm"
            with store.open_output_stream(f"{base}/{name}") as out:
                out.write(packed(WaveletMatrix.build(ids), numbers, known, ends))
            made.append((f"{folder}/{name}", part, len(made), len(held), len(ids)))
            held.clear()

        tail, tokens = np.array([END], np.uint16).tobytes(), 0
        for batch in batches:
            for number, k, text in zip(batch["_id"].tolist(), batch["_known"].tolist(), batch["_text"]):
                codes = encoder.encode(text)
                held.append((number, k, codes + tail))
                tokens += len(codes) // 2 + 1
                if tokens >= shard_tokens:
                    flush()
                    tokens = 0
        if held:
            flush()
        yield pd.DataFrame(made, columns=["path", "first_part", "file", "n_docs", "n_tokens"])

    number = F.col(doc_id).cast("long")
    rows = docs.select(
        number.isNotNull().alias("_known"), F.coalesce(number, F.lit(0)).alias("_id"), F.col(text).alias("_text"), text_hash(text).alias("_hash")
    )
    place = ("_known", "_id", "_hash")
    ordered = rows.repartitionByRange(*place).sortWithinPartitions(*place).drop("_hash")
    return settled(ordered.mapInPandas(run, _MANIFEST), "wavelet-manifest")


def _files(manifest: DataFrame) -> DataFrame:
    """`(path, before)`, a task for each file: `before` counts the ids of all files before it."""
    running = W.orderBy("first_part", "file").rowsBetween(W.unboundedPreceding, -1)
    # One row for each file: a few for each task of the writer.
    placed = manifest.select("path", F.coalesce(F.sum("n_tokens").over(running), F.lit(0)).alias("before"))
    return placed.repartition(max(manifest.count(), 1))


def _opened(path: str) -> tuple[WaveletMatrix, pd.Series, np.ndarray, np.ndarray]:
    """Matrix of a file, and ids, starts and ends of its documents."""
    store, at = file_store(path)
    with store.open_input_stream(at) as source:
        matrix, numbers, known, ends = unpacked(source.read())
    return matrix, pd.Series(numbers).astype("Int64").where(known.astype(bool)), np.concatenate(([0], ends[:-1])).astype(np.int64), ends


def read(manifest: DataFrame, mark: int = END) -> DataFrame:
    """`(doc_id, start, n_tokens, ids_crc32, n_marks)` of every document in the files of a manifest.

    `start` counts the ids of all documents before it, `ids_crc32` is the unsigned checksum of its ids, end id included,
    as little-endian 32-bit numbers. `n_marks` counts the ids equal to `mark`, by rank at the document's ends. Each task reads one
    file. Damaged files raise an error. No files give no rows.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, before in zip(batch["path"], batch["before"].tolist()):
                matrix, ids, starts, ends = _opened(path)
                octets = memoryview(matrix.decode().astype("<u4")).cast("B")
                crcs = [zlib.crc32(octets[4 * s : 4 * e]) for s, e in zip(starts.tolist(), ends.tolist())]
                for i in range(0, len(ids), 20_000):
                    first, last = starts[i : i + 20_000], ends[i : i + 20_000]
                    yield pd.DataFrame({
                        "doc_id": ids[i : i + 20_000], "start": before + first, "n_tokens": last - first, "ids_crc32": crcs[i : i + 20_000],
                        "n_marks": np.diff(matrix.ranks(mark, np.append(first, last[-1]))),
                    })

    return _files(manifest).mapInPandas(run, "doc_id long, start long, n_tokens long, ids_crc32 long, n_marks long")


def counts(manifest: DataFrame, tokens: Iterable[int]) -> DataFrame:
    """`(token, n)`: how often each of the tokens stands in all documents, 0 included, one row a token.

    One rank a file and token; the sequences are not decoded. Null and repeated tokens are left out. The tokens are a list
    of the caller's, which goes to every task.
    """
    wanted = sorted({t for t in tokens if t is not None})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["path"]:
                matrix = _opened(path)[0]
                yield pd.DataFrame({"token": wanted, "n": [matrix.rank(t) for t in wanted]})

    found = _files(manifest).mapInPandas(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    asked = manifest.sparkSession.createDataFrame([(t,) for t in wanted], "token long")
    return asked.join(found, "token", "left").select("token", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def occurrences(manifest: DataFrame, tokens: Iterable[int]) -> DataFrame:
    """`(token, doc_id, start, position)`: each place of each of the tokens, `position` from 0 inside the document that begins at `start`.

    Places come from select, part by part, so a frequent token is never held whole. Documents of one id, or without
    one, are told apart by `start`. Null and repeated tokens are left out; a token that stands nowhere has no rows.
    """
    wanted = sorted({t for t in tokens if t is not None})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, before in zip(batch["path"], batch["before"].tolist()):
                matrix, ids, starts, ends = _opened(path)
                for token in wanted:
                    for at in matrix.positions(token):
                        nth = np.searchsorted(ends, at, side="right")
                        yield pd.DataFrame({
                            "token": token, "doc_id": ids.take(nth).reset_index(drop=True), "start": before + starts[nth], "position": at - starts[nth],
                        })

    return _files(manifest).mapInPandas(run, "token long, doc_id long, start long, position long")


def op4_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded, written as wavelet matrices and read back."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return read(write(docs, work_dir(spark, "wavelet"), public_tokenizers.path(TOKENIZER)))


QUERIES: dict[str, Query] = {"op4_wavelet_tokens": op4_wavelet_tokens}
SQL: dict[str, str] = {}
