"""Token ids of whole texts, from the tokenizers library, each distinct piece of text encoded once per process.

Both vocabularies cut texts at white space and between letters and punctuation before they merge, and nothing they match
reaches back over a space that follows a character other than white space. So the ids of a text are those of its pieces
between such places, put together.
Pieces are found and named (64-bit hash) for a whole batch of texts at once; new ones are encoded by the library,
known ones looked up. Pieces of plain letters go to the vocabulary's merge model directly, since cutting leaves them whole.
"""

from __future__ import annotations

import ctypes
import gc
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from .tables import written
from .textbytes import U, mixed, pieces, run_hashes

CACHED_PIECES = 700_000
PIECES_AT_ONCE = 4096
FREQUENT_IDS = 1000
#: Texts are best given in batches of this many bytes.
BATCH_BYTES = 7 << 19
BYTE_LEVEL, WORD_LEVEL = "byte_bpe_50k.json", "word_bpe_49k.json"
IS_MARK, IS_LETTER = np.zeros(256, bool), np.zeros(256, bool)
IS_MARK[[10, 32, 44, 46]] = True
IS_MARK[list(b"#$%&*")] = True
IS_STOP = IS_MARK & (np.arange(256) > 32)
IS_LETTER[[*range(65, 91), *range(97, 123)]] = True


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_characters() -> dict[int, int]:
    """The characters that byte-level vocabularies write bytes with: printable ones as they are, others from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in plain]
    return {b: b for b in plain} | {b: 256 + i for i, b in enumerate(others)}


class _Names:
    """Numbers 0, 1, ... of 64-bit names in the order they are added: a table with open addressing, asked for whole batches at once."""

    def __init__(self) -> None:
        self.n, self.name, self.number = 0, np.zeros(1 << 16, U), np.full(1 << 16, -1, np.int32)

    def find(self, names: np.ndarray) -> np.ndarray:
        """The number of each name, -1 if it has none."""
        mask = len(self.name) - 1
        slot = (names & U(mask)).view(np.int64)
        out = self.number[slot]
        todo = np.flatnonzero((self.name[slot] != names) & (out >= 0))
        while len(todo):  # the place is another's: look at the next one
            at = (slot[todo] + 1) & mask
            slot[todo], out[todo] = at, self.number[at]
            todo = todo[(self.name[at] != names[todo]) & (out[todo] >= 0)]
        return out

    def add(self, names: np.ndarray) -> None:
        """Number names that differ and have none yet."""
        if 2 * (self.n + len(names)) > len(self.name):
            taken = np.flatnonzero(self.number >= 0)
            old = np.empty(self.n, U)
            old[self.number[taken]] = self.name[taken]
            size = 1 << (2 * (self.n + len(names))).bit_length()
            self.n, self.name, self.number = 0, np.zeros(size, U), np.full(size, -1, np.int32)
            names = np.concatenate([old, names])
        mask = len(self.name) - 1
        slot = (names & U(mask)).view(np.int64)
        number = np.arange(self.n, self.n + len(names), dtype=np.int32)
        self.n += len(names)
        todo = np.arange(len(names))
        while len(todo):
            at = slot[todo]
            free = self.number[at] < 0
            self.number[at[free]] = number[todo[free]]
            got = self.number[at] == number[todo]  # of several that asked for one place, one has it
            self.name[at[got]] = names[todo[got]]
            todo = todo[~got]
            slot[todo] = (slot[todo] + 1) & mask


class PieceEncoder:
    """encode(bytes, bounds) -> (all ids, bounds of rows), as the library gives them with add_special_tokens=False."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merges = self.tokenizer.model
        one, two = (self.tokenizer.encode(x, add_special_tokens=False).ids for x in ("a", " A"))
        self.folds = one == two  # lower case, white space dropped
        self.characters = np.array([n for _, n in sorted(_byte_characters().items())], "<u4")
        self.known = _Names()
        self.begin, self.size, self.uses = (np.zeros(1 << 10, np.int64) for _ in range(3))
        self.ids, self.used = np.zeros(1 << 12, np.uint32), 0

    def _as_written(self, lines: np.ndarray) -> list[str]:
        """Pieces of letters, each ended by a line feed, in the characters of the vocabulary."""
        if self.folds:
            text = "\n" + lines.tobytes().decode().lower()
            lines = np.frombuffer(text.replace("\n ", "\n")[1:].encode(), np.uint8)
        feed = lines == 10
        written = self.characters[lines]
        written[feed] = 10
        return written.tobytes().decode("utf-32-le").split("\n")[:-1]

    def _library(self, buf: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids of the pieces, how many each has, and the order they are in: plain letters come first."""
        plain = _plain_letters(buf, begin, end)
        order = np.argsort(~plain, kind="stable")
        size = (end - begin)[plain] + 1
        lines = _runs(np.append(buf, np.uint8(10)), begin[plain], size)
        lines[np.cumsum(size) - 1] = 10
        given = self._as_written(lines)
        ids, sizes = [], []
        for at in range(0, len(given), PIECES_AT_ONCE):
            found = list(map(self.merges.tokenize, given[at : at + PIECES_AT_ONCE]))
            ids.append(np.fromiter((token.id for word in found for token in word), np.uint32))
            sizes.append(np.array(list(map(len, found)), np.int64))
        rest = [buf[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(begin[~plain].tolist(), end[~plain].tolist(), strict=True)]
        others = [e.ids for e in self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)]
        ids.append(np.fromiter(chain.from_iterable(others), np.uint32))
        sizes.append(np.array(list(map(len, others)), np.int64))
        return np.concatenate(ids), np.concatenate(sizes), order

    def _learn(self, names: np.ndarray, buf: np.ndarray, begin: np.ndarray, end: np.ndarray) -> None:
        found, size, order = self._library(buf, begin, end)
        total, n = len(found), self.known.n
        while self.used + total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while n + len(names) > len(self.begin):
            self.begin, self.size, self.uses = (np.concatenate([x, np.zeros_like(x)]) for x in (self.begin, self.size, self.uses))
        self.ids[self.used : self.used + total] = found
        self.begin[n + order] = self.used + np.cumsum(size) - size
        self.size[n + order] = size
        self.uses[n : n + len(names)] = 0
        self.used += total
        self.known.add(names)

    def _forget(self) -> None:
        """Keep pieces met again since the last time, if they are few enough."""
        n = self.known.n
        keep = np.flatnonzero(self.uses[:n] > 1)
        if len(keep) > CACHED_PIECES // 2:
            keep = keep[:0]
        taken = np.flatnonzero(self.known.number >= 0)
        names = np.empty(n, U)
        names[self.known.number[taken]] = self.known.name[taken]
        self.known = _Names()
        self.known.add(names[keep])
        size = self.size[keep]
        begin = np.cumsum(size) - size
        self.ids = np.concatenate([_runs(self.ids, self.begin[keep], size), np.zeros(1 << 12, np.uint32)])
        self.used = int(size.sum())
        self.begin, self.size = (np.concatenate([x, np.zeros(1 << 10, np.int64)]) for x in (begin, size))
        self.uses = np.zeros(len(self.begin), np.int64)

    def encode(self, buf: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cut = np.zeros(len(buf) + 1, bool)
        cut[_boundaries(buf)] = True
        cut[bounds] = True
        cut[-1] = False
        start = np.flatnonzero(cut)
        if not len(start):
            return np.zeros(0, np.uint32), np.zeros(len(bounds), np.int64)
        end = np.append(start[1:], len(buf))
        name = run_hashes(buf, start, end)
        if self.known.n > CACHED_PIECES:
            self._forget()
        number = self.known.find(name)
        new = np.flatnonzero(number < 0)
        if len(new):
            distinct, first, back = np.unique(name[new], return_index=True, return_inverse=True)
            number[new] = self.known.n + back
            at = new[first]
            self._learn(distinct, buf, start[at], end[at])
        self.uses[: self.known.n] += np.bincount(number, minlength=self.known.n)
        size = self.size[number]
        after = np.concatenate([[0], np.cumsum(size)])
        return _runs(self.ids, self.begin[number], size), after[np.searchsorted(start, bounds)]


def _plain_letters(buf: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Whether each piece is letters of ASCII and Latin-1 alone, maybe after one space."""
    size = end - begin
    at = np.cumsum(size) - size
    data = _runs(buf, begin, size)
    before = np.append(np.uint8(0), data[:-1])
    before[at] = 0
    follows = (before == 0xC3) & (data >= 128) & (data < 0xC0) & (data != 0x97) & (data != 0xB7)
    good = IS_LETTER[data] | (data == 0xC3) | follows
    good[at] |= (data[at] == 32) & (size > 1)
    return np.logical_and.reduceat(good, at)


def _boundaries(buf: np.ndarray) -> np.ndarray:
    """Places where both vocabularies start anew, judged by the bytes around them; not all such places."""
    mark = np.flatnonzero(IS_MARK[buf])
    mark = mark[(mark > 2) & (mark < len(buf) - 1)]
    here, one, two, three, after = buf[mark], buf[mark - 1], buf[mark - 2], buf[mark - 3], buf[mark + 1]
    # a space, but not after white space: ASCII up to 0x20, or characters of two or three bytes that may be some
    space = (here == 32) & (one > 32) & (one != 127) & (two != 0xC2) & ~((three >= 0xE1) & (three <= 0xE3) & (one >= 128))
    # a comma, full stop or sign after a letter: ASCII or Latin-1
    letter = IS_LETTER[one] | (two == 0xC3) & (one >= 128) & (one != 0x97) & (one != 0xB7)
    stop = IS_STOP[here] & letter
    # what follows a single line feed
    feed = (here == 10) & (one > 32) & (one < 127) & (IS_LETTER[after] | (after == 0xC3))
    return np.concatenate([mark[space | stop], mark[feed] + 1])


def _runs(values: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The runs [begin, begin + size) of the values, one after another."""
    after = np.cumsum(size)
    total = int(after[-1]) if len(after) else 0
    return values[np.repeat(begin - (after - size), size) + np.arange(total)]


_encoders: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """One for each process and vocabulary."""
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]


def release() -> None:
    """Give back the memory of encoders and of earlier tasks, before a stage that encodes nothing."""
    if _encoders:
        _encoders.clear()
        gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # what the C library keeps of freed memory
    if trim is not None:
        trim(0)


def _documents_with(ids: np.ndarray, lengths: np.ndarray, size: int) -> np.ndarray:
    """For each of `size` ids, how many of the rows have it."""
    rows = len(lengths)
    kind = np.uint32 if rows * size < 1 << 32 else np.uint64
    keys = np.sort(np.repeat(np.arange(rows, dtype=kind) * kind(size), lengths) + ids.astype(kind))
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    return np.bincount((keys[first] % kind(size)).astype(np.int64), minlength=size)


def token_table(docs: DataFrame, vocabulary: str, end_id: int, name: str, by_document: bool = False) -> DataFrame:
    """(doc_id, n, ids, sketch, counts), written to the shared folder.

    A row for each row of `docs` (doc_id, text): the ids of the whole text (null: none) and the end id as little-endian
    numbers, first all low bytes, then the second bytes and so on, compressed; n is how many. sketch is the
    lowest hash of the ids that are not frequent (0 if none): likely equal for texts with rare tokens in common. Rows
    with `counts` hold the vocabulary counts of one task instead: how often each id occurs, or `by_document` in how many rows.
    """
    path = vocabulary_path(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]):
        encode, pack = encoder(path), zstandard.ZstdCompressor(level=1).compress
        width = 2 if encode.tokenizer.get_vocab_size() <= 1 << 16 else 4
        total = np.zeros(max(encode.tokenizer.get_vocab_size(), end_id + 1), np.int64)
        for rows, buf, bounds in pieces(batches, "text", BATCH_BYTES):
            ids, at = encode.encode(buf, bounds)
            ids = np.insert(ids, at[1:], end_id)
            at = at + np.arange(len(at))
            total += _documents_with(ids, np.diff(at), len(total)) if by_document else np.bincount(ids, minlength=len(total))
            hashed = np.where(ids >= FREQUENT_IDS, mixed(ids.astype(U)) >> U(1), U((1 << 63) - 1))
            sketch = np.minimum.reduceat(hashed, at[:-1]).astype(np.int64) if len(ids) else np.zeros(0, np.int64)
            data = ids.astype(f"<u{width}").view(np.uint8).reshape(-1, width)
            planes = [pack(data[a:b].T.tobytes()) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(np.diff(at)), pa.array(planes, pa.binary()), pa.array(sketch), pa.nulls(rows.num_rows, pa.binary())],
                names=["doc_id", "n", "ids", "sketch", "counts"],
            )
        yield pa.RecordBatch.from_arrays(
            [pa.array([None], pa.int64()), pa.array([0], pa.int64()), pa.array([None], pa.binary()), pa.array([0], pa.int64()), pa.array([total.tobytes()], pa.binary())],
            names=["doc_id", "n", "ids", "sketch", "counts"],
        )

    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return written(given.mapInArrow(run, "doc_id long, n long, ids binary, sketch long, counts binary"), name, "none")


_unpacked = zstandard.ZstdDecompressor().decompress


def from_planes(data: bytes, n: int) -> np.ndarray:
    """The ids in a row of the table."""
    planes = np.frombuffer(_unpacked(data), np.uint8).reshape(-1, n)
    out = planes[0].astype(np.uint32)
    for k in range(1, len(planes)):
        out |= planes[k].astype(np.uint32) << np.uint32(8 * k)
    return out
