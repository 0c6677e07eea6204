"""Encoding of texts with a byte-level BPE, by vectorised pre-tokenisation and cached pair merging.

The texts of a batch become one array of code points. Each code point has a class; each class is a function from the state
before it to the state after it. Functions compose associatively, so the states of all places are found by a scan in blocks:
every block composes its functions for all entry states at once, the blocks' functions are composed, and a second pass fills
in the states. Token boundaries follow from state and class, without a regular expression.
"""

from __future__ import annotations

import base64
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

DEFAULT_PATH = "/opt/tokenizers/byte_bpe_50k.tiktoken"
CACHE_SIZE = 400_000

# classes of code points
L, N, O, SP, WS, AP1, AP2, END = range(8)
# states: what stands before a place
FRESH, IN_L, IN_N, IN_O, AFTER_SP, AFTER_WS, TWO_MORE, ONE_MORE = range(8)
# Code points with the White_Space property.
SPACES = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


def code_classes() -> np.ndarray:
    """The class of every code point."""
    table = np.full(sys.maxunicode + 1, O, np.uint8)
    for c in range(sys.maxunicode + 1):
        kind = unicodedata.category(chr(c))[0]
        if kind == "L":
            table[c] = L
        elif kind == "N":
            table[c] = N
    table[SPACES] = WS
    table[32] = SP
    return table


def transitions() -> np.ndarray:
    """``table[class, state]``: the state after a code point of the class."""
    table = np.zeros((8, 8), np.uint8)
    table[L], table[N], table[O], table[SP], table[WS], table[END] = IN_L, IN_N, IN_O, AFTER_SP, AFTER_WS, FRESH
    table[L, TWO_MORE], table[L, ONE_MORE] = ONE_MORE, FRESH
    for kind, state in ((AP1, ONE_MORE), (AP2, TWO_MORE)):  # a contraction begins only where a token begins
        table[kind] = state
        table[kind, [IN_O, AFTER_SP]] = IN_O
    return table


def starts() -> np.ndarray:
    """``table[class, state]``: whether a token begins at a code point of the class (white space is settled apart)."""
    table = np.ones((8, 8), bool)
    table[L, [IN_L, AFTER_SP, TWO_MORE, ONE_MORE]] = False
    table[N, [IN_N, AFTER_SP]] = False
    table[[O, AP1, AP2], IN_O] = False
    table[[O, AP1, AP2], AFTER_SP] = False
    table[np.ix_([SP, WS], [AFTER_SP, AFTER_WS])] = False
    return table


def scan_states(classes: np.ndarray, table: np.ndarray, block: int = 512) -> np.ndarray:
    """The state before each place, from composing the transition functions of blocks."""
    n = len(classes)
    rows = -(-n // block)
    grid = np.full(rows * block, END, np.uint8)
    grid[:n] = classes
    grid = np.ascontiguousarray(grid.reshape(rows, block).T)
    whole = np.tile(np.arange(8, dtype=np.uint8), (rows, 1))
    flat = table.ravel()
    for column in grid:
        whole = flat[column[:, None].astype(np.intp) * 8 + whole]
    entry, state = np.empty(rows, np.uint8), FRESH
    for i in range(rows):
        entry[i] = state
        state = whole[i, state]
    before = np.empty((block, rows), np.uint8)
    for j, column in enumerate(grid):
        before[j] = entry
        entry = flat[column.astype(np.intp) * 8 + entry]
    return before.T.ravel()[:n]


class Encoder:
    """Byte-level BPE from a file of ranks; ids, and the texts' offsets, of whole batches."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.cache: dict[str, tuple[int, ...]] = {}
        self.classes = self.widths = None

    @classmethod
    def load(cls, path: str = DEFAULT_PATH) -> Encoder:
        with open(path, "rb") as f:
            return cls({base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())})

    def pieces(self, texts: list[str]) -> tuple[str, np.ndarray, np.ndarray]:
        """All texts in one string (each ended by a NUL), the places where tokens begin, and the end of each text in it."""
        if self.classes is None:
            self.classes, self.table, self.begins = code_classes(), transitions(), starts()
        whole = "\0".join(texts) + "\0"
        codes = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
        ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1) - 1
        kind = self.classes[codes]
        kind[ends] = END
        apostrophe = np.flatnonzero((codes == 39) & (kind == O))
        ahead = np.append(codes, [0, 0])
        one, two = ahead[apostrophe + 1], ahead[apostrophe + 2]
        kind[apostrophe[np.isin(one, [ord(c) for c in "sdmt"])]] = AP1
        is_two = ((one == ord("l")) & (two == ord("l"))) | (((one == ord("v")) | (one == ord("r"))) & (two == ord("e")))
        kind[apostrophe[is_two]] = AP2
        before = scan_states(kind, self.table)
        begin = self.begins[kind, before]
        blank = (kind == SP) | (kind == WS)
        after = np.append(kind[1:], END)
        # the last blank of a run stands apart from the rest if something follows
        begin |= blank & ((before == AFTER_SP) | (before == AFTER_WS)) & (after != SP) & (after != WS) & (after != END)
        return whole, np.flatnonzero(begin), ends

    def merge(self, piece: str) -> tuple[int, ...]:
        """Ids of one piece, by merging the pair of lowest rank until none is left."""
        raw = piece.encode("utf-8", "replace")
        if (known := self.ranks.get(raw)) is not None:
            return (known,)
        ranks = self.ranks
        # a linked list with a heap, so that very long pieces stay fast
        import heapq

        n = len(raw)
        begin, end, left, right = list(range(n)), list(range(1, n + 1)), list(range(-1, n - 1)), [*range(1, n), -1]
        alive, heap = [True] * n, []

        def push(i: int) -> None:
            j = right[i]
            if j != -1 and (r := ranks.get(raw[begin[i] : end[j]])) is not None:
                heapq.heappush(heap, (r, begin[i], i, end[i], end[j]))

        for i in range(n - 1):
            push(i)
        while heap:
            _, _, i, mid, stop = heapq.heappop(heap)
            j = right[i] if alive[i] else -1
            if j == -1 or end[i] != mid or end[j] != stop:
                continue
            end[i], alive[j], right[i] = stop, False, right[j]
            if right[i] != -1:
                left[right[i]] = i
            push(i)
            if left[i] != -1:
                push(left[i])
        return tuple(ranks[raw[begin[i] : end[i]]] for i in range(n) if alive[i])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, one after another, and the number of ids of each text."""
        if not texts:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        whole, begin, ends = self.pieces(texts)
        stop = np.append(begin[1:], len(whole)).tolist()
        cache, ids, sizes = self.cache, [], []
        if len(cache) > CACHE_SIZE:
            cache.clear()
        closing = np.zeros(len(begin), bool)
        closing[np.searchsorted(begin, ends)] = True  # the NULs between the texts are pieces of their own
        for a, b, last in zip(begin.tolist(), stop, closing.tolist()):
            if last:
                sizes.append(len(ids))
                continue
            piece = whole[a:b]
            got = cache.get(piece)
            if got is None:
                got = self.merge(piece)
                if len(piece) < 64:
                    cache[piece] = got
            ids.extend(got)
        return np.array(ids, np.int32), np.diff(np.append(0, np.array(sizes, np.int64)))

    def decoder(self) -> dict[int, bytes]:
        return {i: b for b, i in self.ranks.items()}

    def offsets(self, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Where each token of ``encode``'s result begins in the UTF-8 bytes of its own text."""
        if self.widths is None:
            self.widths = np.zeros(max(self.ranks.values(), default=0) + 1, np.int64)
            self.widths[list(self.ranks.values())] = [len(b) for b in self.ranks]
        width = self.widths[ids]
        begin = np.cumsum(width) - width
        first = np.cumsum(sizes) - sizes
        return (begin - np.repeat(begin[first[sizes > 0]], sizes[sizes > 0])).astype(np.int32)

    def decode(self, ids: list[int]) -> str:
        table = self.decoder()
        return b"".join(table[i] for i in ids).decode("utf-8", "replace")


def _batches(df: DataFrame, path: str, text: str, keep: list[str], out: str, schema, counts_only: bool, offsets: str | None = None) -> DataFrame:
    kept = df.sparkSession.sparkContext.broadcast({"ranks": Encoder.load(path).ranks})  # a vocabulary: fixed size, under 2 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = kept.value  # one per worker process, so the cache outlives the task
        encoder = state.setdefault("encoder", Encoder(state["ranks"]))
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            texts = [t or "" for t in column.to_pylist()]
            cols = [batch.column(batch.schema.get_field_index(c)) for c in keep]
            lo = 0
            while lo < len(texts):  # pieces of about 2 million characters bound the memory
                hi, size = lo, 0
                while hi < len(texts) and (hi == lo or size + len(texts[hi]) < 2_000_000):
                    size += len(texts[hi])
                    hi += 1
                ids, sizes = encoder.encode(texts[lo:hi])
                more = []
                if counts_only:
                    value = pa.array(sizes, pa.int64())
                else:
                    value = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32)), pa.array(ids, pa.int32()))
                    more = [pa.ListArray.from_arrays(value.offsets, pa.array(encoder.offsets(ids, sizes), pa.int32()))] if offsets else []
                yield pa.RecordBatch.from_arrays([*[c.slice(lo, hi - lo) for c in cols], value, *more], names=[*keep, out, *([offsets] if offsets else [])])
                lo = hi

    return df.select(*keep, text).mapInArrow(run, schema)


def encode(df: DataFrame, path: str = DEFAULT_PATH, text: str = "text", keep: list[str] | None = None, out: str = "ids", offsets: str | None = None) -> DataFrame:
    """``keep`` columns and ``out``, the ids of ``text``, and if asked ``offsets``, where each token begins in the text's UTF-8 bytes; null and empty texts have an empty list. No shuffle.

    By default all other columns are kept, but for one named ``out``, which is replaced; repeated rows stay. Strings that look
    like special tokens are ordinary text. ``path`` is the file of ranks, read on the driver only.
    """
    keep = keep or [c for c in df.columns if c not in (text, out, offsets)]
    return _batches(df, path, text, keep, out, df.select(*keep, *[F.array().cast("array<int>").alias(c) for c in (out, offsets) if c]).schema, False, offsets)


def count_tokens(df: DataFrame, path: str = DEFAULT_PATH, text: str = "text", keep: list[str] | None = None, out: str = "n_tokens") -> DataFrame:
    """``keep`` columns and the number of ids of ``text`` (0 for null and empty texts)."""
    keep = keep or [c for c in df.columns if c not in (text, out)]
    return _batches(df, path, text, keep, out, df.select(*keep, F.lit(0).cast("bigint").alias(out)).schema, True)
