"""Byte-level BPE: encoding by a published table of ranks, and decoding.

Texts are split by a scan over classes of code points: each code point is a transition function
of a small automaton, functions are composed by an associative scan, and the automaton's
outputs are the boundaries. No pattern is matched against a text. The slices between
boundaries are merged by rank, each different slice once; where every token starts is kept.
"""

from __future__ import annotations

import base64
import functools
import heapq
import itertools
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType

from debutrank.llm import kernels as K

CACHE_SLICES = 1 << 18  # different slices that a task remembers, and the longest of them
CACHE_BYTES = 64
STEP = 1 << 19  # bytes that one step encodes, and tokens that four steps decode, unless one row has more
BLOCK = 256  # code points that one lane of the scan composes

# The classes that the splitting pattern tells apart, and its contractions.
# Letters of contractions are classes of their own: 's 't 'm 'd end at once, 're 've 'll after one more.
SYMBOLS = ("letter", "stmd", "r", "v", "l", "e", "number", "apostrophe", "other", "space", "blank")
CONTRACTED = {"s": "stmd", "t": "stmd", "m": "stmd", "d": "stmd", "r": "r", "v": "v", "l": "l", "e": "e"}
STATES = ("letter", "number", "other", "space", "blank", "quote", "quote_r", "quote_v", "quote_l", "contracted")

_LETTERS = ("letter", "stmd", "r", "v", "l", "e")
_SECOND = {"quote_r": "e", "quote_v": "e", "quote_l": "l"}


def _fresh(symbol: str) -> str:
    """State after the first code point of a slice."""
    if symbol in _LETTERS:
        return "letter"
    return "quote" if symbol == "apostrophe" else symbol


def _step(state: str, symbol: str) -> tuple[str, bool, bool]:
    """Next state, whether a slice starts at this code point, and whether one starts at the last one."""
    if state in _SECOND:
        if symbol == _SECOND[state]:
            return "contracted", False, False
        if symbol in _LETTERS:
            return "letter", False, True
        return _fresh(symbol), True, True
    if state == "quote":
        if symbol == "stmd":
            return "contracted", False, False
        if symbol in ("r", "v", "l"):
            return f"quote_{symbol}", False, False
        if symbol in ("apostrophe", "other"):
            return "other", False, False
        return _fresh(symbol), True, False
    if state in ("space", "blank"):
        if symbol in ("space", "blank"):
            return symbol, False, False
        if state == "blank":
            return _fresh(symbol), True, True
        return ("other" if symbol == "apostrophe" else _fresh(symbol)), False, True
    run = {"letter": _LETTERS, "number": ("number",), "other": ("apostrophe", "other")}.get(state, ())
    if symbol in run:
        return state, False, False
    return _fresh(symbol), True, False


class Automaton(NamedTuple):
    """Tables of the automaton; symbols from ``len(SYMBOLS)`` on are those that begin a text."""

    element: np.ndarray  # symbol -> its function
    product: np.ndarray  # function, next function -> their composition
    apply: np.ndarray  # function, state -> state
    starts: np.ndarray  # state before, symbol -> a slice starts here
    back: np.ndarray  # state before, symbol -> a slice starts one code point earlier
    unfinished: np.ndarray  # state at the end of a text -> a slice starts at the last code point


@functools.cache
def automaton() -> Automaton:
    """The functions of all symbols, closed under composition."""
    number = {s: i for i, s in enumerate(STATES)}
    columns, starts, back = [], [], []
    for symbol in SYMBOLS:
        steps = [_step(state, symbol) for state in STATES]
        columns.append(tuple(number[s] for s, _, _ in steps))
        starts.append([here for _, here, _ in steps])
        back.append([before for _, _, before in steps])
    for symbol in SYMBOLS:  # the first of a text: whatever the state was, which ends there
        columns.append((number[_fresh(symbol)],) * len(STATES))
        starts.append([True] * len(STATES))
        back.append([state in _SECOND for state in STATES])
    identity = tuple(range(len(STATES)))
    known = {identity: 0}
    for f in columns:
        known.setdefault(f, len(known))
    queue = list(known)
    for f in queue:
        for g in columns:
            h = tuple(g[s] for s in f)
            if h not in known:
                known[h] = len(known)
                queue.append(h)
    functions = np.array(list(known), np.uint16)
    product = [[known[tuple(g[s] for s in f)] for g in known] for f in known]
    return Automaton(
        np.array([known[f] for f in columns], np.uint16),
        np.array(product, np.uint16),
        functions,
        np.array(starts).T.copy(),
        np.array(back).T.copy(),
        np.array([s in _SECOND for s in STATES]),
    )


def composed(elements: np.ndarray, product: np.ndarray) -> np.ndarray:
    """Compositions of all prefixes of ``elements``: an associative scan over blocks."""
    n = len(elements)
    if n <= BLOCK:
        out = np.empty(n, product.dtype)
        last = 0
        for i, e in enumerate(elements.tolist()):
            out[i] = last = product[last, e]
        return out
    lanes = -(-n // BLOCK)
    padded = np.zeros(lanes * BLOCK, product.dtype)  # function 0 is the identity
    padded[:n] = elements
    inside = np.ascontiguousarray(padded.reshape(lanes, BLOCK).T)
    for i in range(1, BLOCK):
        inside[i] = product[inside[i - 1], inside[i]]
    before = np.zeros(lanes, product.dtype)
    before[1:] = composed(inside[-1], product)[:-1]
    return product[before, inside].T.ravel()[:n]


def class_runs() -> tuple[np.ndarray, np.ndarray]:
    """First code point and symbol of every run of code points of one class.

    Which code points are letters, numbers and blanks is asked of the library whose results
    are to be met, one code point at a time, because it fixes the version of the tables.
    """
    every = "".join(chr(c) for c in itertools.chain(range(0xD800), range(0xE000, 0x110000)))
    singles = {bytes([i]): i for i in range(256)}
    table = np.full(0x110000, SYMBOLS.index("other"), np.uint8)
    for pattern, symbol in ((r"\p{L}", "letter"), (r"\p{N}", "number"), (r"\s", "blank")):
        asked = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks=singles, special_tokens={})
        found = bytes(asked.encode_ordinary(every)).decode()
        table[np.frombuffer(found.encode("utf-32-le"), np.uint32)] = SYMBOLS.index(symbol)
    for letter, symbol in CONTRACTED.items():
        table[ord(letter)] = SYMBOLS.index(symbol)
    table[ord(" ")] = SYMBOLS.index("space")
    table[ord("'")] = SYMBOLS.index("apostrophe")
    first = np.flatnonzero(np.concatenate([[True], table[1:] != table[:-1]]))
    return first, table[first]


def class_table(runs: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    first, symbol = runs
    return np.repeat(symbol, np.diff(np.append(first, 0x110000)))


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of the first byte, and number, of every code point of UTF-8 bytes."""
    at = np.flatnonzero((data & 0xC0) != 0x80)
    lead = data[at].astype(np.uint32)
    wide = np.flatnonzero(lead >= 0xC0)
    if len(wide):
        padded = np.concatenate([data, np.zeros(3, np.uint8)])
        place, b = at[wide], lead[wide]
        one, two, three = (padded[place + i].astype(np.uint32) & 0x3F for i in (1, 2, 3))
        lead[wide] = np.where(
            b < 0xE0,
            (b & 0x1F) << 6 | one,
            np.where(b < 0xF0, (b & 0x0F) << 12 | one << 6 | two, (b & 0x07) << 18 | one << 12 | two << 6 | three),
        )
    return at, lead


def slice_starts(data: np.ndarray, offsets: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Byte places at which the slices of all texts start."""
    if not len(data):
        return np.zeros(0, np.int64)
    machine = automaton()
    at, points = code_points(data)
    symbols = classes[points]
    first = np.searchsorted(at, offsets[:-1][np.diff(offsets) > 0])
    symbols[first] += len(SYMBOLS)
    after = machine.apply[composed(machine.element[symbols], machine.product), 0]
    before = np.concatenate([after[:1], after[:-1]])
    before[0] = 0
    starts = machine.starts[before, symbols]
    starts[:-1] |= machine.back[before, symbols][1:]
    starts[-1] |= machine.unfinished[after[-1]]
    return at[starts]


def merged(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one slice: the pair of the lowest rank, the leftmost of equals, is joined again and again."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    end = list(range(1, n + 1))  # of the part that starts here, 0 once it is inside another
    previous = list(range(-1, n - 1))
    heap = [(ranks[piece[i : i + 2]], i, i + 2) for i in range(n - 1) if piece[i : i + 2] in ranks]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        middle = end[i]
        if not middle or middle >= stop or end[middle] != stop:
            continue  # one of the two has been joined with something else
        end[i], end[middle] = stop, 0
        if stop < n:
            previous[stop] = i
            rank = ranks.get(piece[i : end[stop]])
            if rank is not None:
                heapq.heappush(heap, (rank, i, end[stop]))
        if previous[i] >= 0:
            rank = ranks.get(piece[previous[i] : stop])
            if rank is not None:
                heapq.heappush(heap, (rank, previous[i], stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return out


def joinable(tokens: dict[int, bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of tokens that make up a third one, as sorted ``left << 32 | right``, and that one's id."""
    ranks = {token: i for i, token in tokens.items()}
    found = [
        (ranks[token[:cut]] << 32 | ranks[token[cut:]], i)
        for token, i in ranks.items()
        for cut in range(1, len(token))
        if token[:cut] in ranks and token[cut:] in ranks
    ]
    keys, ids = np.array(sorted(found), np.int64).reshape(-1, 2).T
    return keys.copy(), ids.copy()


_NONE = np.int64(1 << 30)  # more than any rank


def merged_all(ids: np.ndarray, first: np.ndarray, pairs: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """``merged`` for many slices at once: ids of all, and how many each has.

    ``ids`` are those of the single bytes, ``first`` the index of the first of every slice, none of them empty.
    In a round every slice joins one pair; slices without a pair are put aside.
    """
    keys, joined = pairs
    of = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(ids))))

    def rank(at: np.ndarray) -> np.ndarray:
        """Rank of the pair at each place, where it lies inside a slice."""
        after = np.minimum(at + 1, len(ids) - 1)
        key = ids[at] << 32 | ids[after]
        place = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        good = (keys[place] == key) & (of[at] == of[after]) & (after > at)
        return np.where(good, joined[place], _NONE)

    ranks = rank(np.arange(len(ids)))
    out_ids, out_of = [], []
    while len(ids):
        starts = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
        best = np.minimum.reduceat(ranks << 32 | np.arange(len(ids)), starts)
        going = best >> 32 < _NONE
        at = best[going] & 0xFFFFFFFF
        ids[at] = ranks[at]
        stays = np.repeat(going, np.diff(np.append(starts, len(ids))))
        out_ids.append(ids[~stays])
        out_of.append(of[~stays])
        stays[at + 1] = False
        at = np.cumsum(stays)[at] - 1
        ids, of, ranks = ids[stays], of[stays], ranks[stays]
        if len(at):
            changed = np.concatenate([at, at[at > 0] - 1])
            ranks[changed] = rank(changed)
    ids, of = np.concatenate(out_ids), np.concatenate(out_of)
    return ids[np.argsort(of, kind="stable")], np.bincount(of, minlength=len(first))


class Encoder:
    """Encodes batches of texts; remembers the ids of slices it has met."""

    def __init__(self, tokens: dict[int, bytes], pairs: tuple[np.ndarray, np.ndarray], runs: tuple[np.ndarray, np.ndarray]):
        self.ranks = {token: i for i, token in tokens.items()}
        self.bytes = np.array([self.ranks[bytes([i])] for i in range(256)], np.int64)
        self.pairs = pairs
        self.lengths = np.zeros(max(tokens) + 1, np.int64)
        self.lengths[list(tokens)] = [len(t) for t in tokens.values()]
        self.classes = class_table(runs)
        self.cache: dict[bytes, list[int]] = {}

    def ids(self, slices: list[bytes]) -> list[list[int]]:
        """Ids of every slice: of a whole token, from the cache, or merged and put there."""
        if len(self.cache) >= CACHE_SLICES:
            self.cache.clear()
        out, new = [], []
        for i, piece in enumerate(slices):
            got = self.cache.get(piece)
            if got is None:
                whole = self.ranks.get(piece)
                if whole is not None:
                    got = self.cache[piece] = [whole]
                elif len(piece) > CACHE_BYTES:
                    got = merged(piece, self.ranks)
                else:
                    new.append(i)
            out.append(got)
        if new:
            size = np.fromiter((len(slices[i]) for i in new), np.int64, len(new))
            data = np.frombuffer(b"".join(slices[i] for i in new), np.uint8)
            flat, counts = merged_all(self.bytes[data], np.cumsum(size) - size, self.pairs)
            flat, stops = flat.tolist(), np.cumsum(counts).tolist()
            for i, low, high in zip(new, [0, *stops], stops):
                out[i] = self.cache[slices[i]] = flat[low:high]
        return out

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts, where each token starts in its text, and the index of every text's first token."""
        start = slice_starts(data, offsets, self.classes)
        if not len(start):
            return np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        end = np.append(start[1:], len(data))
        size = end - start
        hashes = K.between(K.running(K.byte_codes()[data]), start, end)
        _, shown, which = np.unique(hashes, return_index=True, return_inverse=True)
        # Slices of one hash have to be one text; should two ever differ, they are encoded one by one.
        moved = np.arange(len(data)) + np.repeat(start[shown][which] - start, size)
        same = np.logical_and.reduceat(data[np.minimum(moved, len(data) - 1)] == data, start)
        odd = np.flatnonzero(~same | (size[shown][which] != size))
        if len(odd):
            which = which.copy()
            which[odd] = len(shown) + np.arange(len(odd))
            shown = np.concatenate([shown, odd])
        raw = data.tobytes()
        distinct = self.ids([raw[a:b] for a, b in zip(start[shown].tolist(), end[shown].tolist())])
        counts = np.fromiter(map(len, distinct), np.int64, len(distinct))
        flat = np.fromiter(itertools.chain.from_iterable(distinct), np.int32, int(counts.sum()))
        first = np.cumsum(counts) - counts
        each = counts[which]
        stops = np.cumsum(each)
        ids = flat[np.arange(stops[-1]) + np.repeat(first[which] - (stops - each), each)]
        widths = self.lengths[ids]
        places = np.cumsum(widths) - widths  # tokens tile the bytes of the batch
        of_text = np.searchsorted(places, offsets)
        return ids, (places - np.repeat(offsets[:-1], np.diff(of_text))).astype(np.int32), of_text


def read_ranks(path: str) -> dict[int, bytes]:
    """Tokens by id from a rank file: a token in base 64 and its id on every line."""
    with open(path, "rb") as file:
        pairs = (line.split() for line in file if line.strip())
        return {int(number): base64.b64decode(token) for token, number in pairs}


def _lists(first: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(values, pa.int32()))


def _slices(first: np.ndarray, data: np.ndarray) -> pa.Array:
    """Binary values between consecutive offsets."""
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(first) - 1, [None, pa.py_buffer(first.astype(np.int64)), pa.py_buffer(data)]
    ).cast(pa.binary())


_INTS = ArrayType(IntegerType())
ENCODED = (("n_tokens", "long"), ("ids", _INTS), ("starts", _INTS), ("packed", "binary"))


def encode(docs: DataFrame, ranks: str, text: str = "text") -> DataFrame:
    """Add the tokens of every whole text, in one pass without a shuffle.

    ``ids`` are those of the rank file at ``ranks``, without special tokens; ``starts`` is the byte at
    which each token starts in the UTF-8 text; ``packed`` holds the ids as little-endian unsigned
    32-bit integers, as token files do; ``n_tokens`` counts them. The driver reads the file and broadcasts
    the table, whose size does not depend on the data.

    A null or empty text has no tokens. Equal rows give equal results and all rows stay.
    Input columns with one of the names added are replaced. Slices without a limit on their length
    (a text that is one word) are merged in n log n steps. Memory is bounded by
    ``STEP`` or the longest text.
    """
    added = {name for name, _ in ENCODED}
    docs = docs.select(*[f"`{c}`" for c in docs.columns if c not in added])
    schema = K.wider(docs.schema, *ENCODED)
    tokens = read_ranks(ranks)
    table = docs.sparkSession.sparkContext.broadcast((tokens, joinable(tokens)))
    runs = class_runs()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(*table.value, runs)
        for batch in batches:
            for part in K.pieces(batch, text, STEP):
                data, offsets = K.joined(part.column(text))
                ids, starts, first = encoder.encode(data, offsets)
                packed = _slices(4 * first, ids.astype("<u4").view(np.uint8))
                arrays = [pa.array(np.diff(first)), _lists(first, ids), _lists(first, starts), packed]
                yield pa.RecordBatch.from_arrays([*part.columns, *arrays], schema.names)

    return docs.mapInArrow(run, schema)


def decoded(ids: np.ndarray, places: np.ndarray, size: int, vocabulary: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """``size`` bytes with the bytes of every token at its place."""
    data, offsets = vocabulary
    start, width = offsets[ids], offsets[ids + 1] - offsets[ids]
    before = np.cumsum(width) - width
    step = np.arange(int(width.sum()))
    out = np.zeros(size, np.uint8)
    out[step + np.repeat(places - before, width)] = data[step + np.repeat(start - before, width)]
    return out


def _parts(batch: pa.RecordBatch, ids: str) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``STEP // 4`` ids, one row at least."""
    counts = pa.compute.fill_null(pa.compute.list_value_length(batch.column(ids)), 0)
    ends = np.cumsum(counts.to_numpy(zero_copy_only=False).astype(np.int64))
    low = 0
    while low < batch.num_rows:
        before = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, before + STEP // 4, "right")))
        yield batch.slice(low, high - low)
        low = high


def decode(tokens: DataFrame, ranks: str, ids: str = "ids", starts: str | None = "starts") -> DataFrame:
    """Add ``decoded``, the bytes that the ids stand for.

    With ``starts``, as ``encode`` gives them, every token goes to its own place, whatever the order
    of the list, so that lists can be cut or shuffled as long as both are; without, tokens follow one
    another. A null or empty list gives no bytes; ids that are not in the rank file, starts that are not one
    for each id, and starts that leave gaps or overlap end the job. An input column ``decoded`` is replaced.
    """
    tokens = tokens.select(*[f"`{c}`" for c in tokens.columns if c != "decoded"])
    schema = K.wider(tokens.schema, ("decoded", "binary"))
    table = tokens.sparkSession.sparkContext.broadcast(read_ranks(ranks))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = [table.value.get(i, b"") for i in range(max(table.value) + 1)]
        lengths = np.fromiter(map(len, entries), np.int64, len(entries))
        vocabulary = (
            np.frombuffer(b"".join(entries), np.uint8),
            np.concatenate([[0], np.cumsum(lengths)]),
        )
        for batch in itertools.chain.from_iterable(_parts(b, ids) for b in batches):
            count = pa.compute.fill_null(pa.compute.list_value_length(batch.column(ids)), 0)
            first = np.concatenate([[0], np.cumsum(count.to_numpy(zero_copy_only=False).astype(np.int64))])
            numbers = batch.column(ids).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            if len(numbers) and not (0 <= numbers.min() and numbers.max() < len(lengths) and lengths[numbers].all()):
                raise ValueError("an id is not in the rank file")
            total = np.concatenate([[0], np.cumsum(lengths[numbers])])
            size = np.diff(total[first])
            places = total[:-1]
            if starts:
                given = batch.column(starts).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                if len(given) != len(numbers):
                    raise ValueError("ids and starts differ in length")
                places = given + np.repeat(total[first[:-1]], np.diff(first))
                order = np.argsort(places, kind="stable")
                if (np.cumsum(lengths[numbers[order]]) - lengths[numbers[order]] != places[order]).any():
                    raise ValueError("tokens leave gaps or overlap")
            out = decoded(numbers, places, int(size.sum()), vocabulary)
            bounds = np.concatenate([[0], np.cumsum(size)])
            yield pa.RecordBatch.from_arrays([*batch.columns, _slices(bounds, out)], schema.names)

    return tokens.mapInArrow(run, schema)
