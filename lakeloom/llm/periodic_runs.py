"""Maximal periodic runs of words, found by recompression.

Texts of a task are laid behind one another as symbols, with separators that occur once. Two
kinds of rounds alternate: *block* compression gives every stretch of one repeated symbol a name
of its own (symbol and count), *pair* compression splits the alphabet in two by a hash and names
every neighbour pair that goes from the one half to the other. Equal stretches are cut alike
but for their ends, so the longest common extension of two places climbs from round to round
while the symbols agree and comes down again where they differ: two steps a round at most.

A run of period q and at least 2q words holds two neighbouring multiples of q. Those of all q,
the harmonic grid, are the candidates; where both words agree, the extensions to the left and
to the right give the run exactly. A stretch found under several periods has the smallest.

Defined results: NULL and empty texts have no words and no runs; NULL identifiers and repeated
rows are rows like others; ties between runs are ordered by start, then period; a very long text
is worked on as a whole by the task that holds its row, in memory in proportion to its words;
an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

#: Words (of six bytes) that are compressed together, and candidates that are extended together.
FLUSH_WORDS = 150_000
FLUSH_CANDIDATES = 500_000
#: A run has at least this many words, and twice its period.
LEAST_WORDS = 12


def _names(keys: np.ndarray, first: int) -> tuple[np.ndarray, int]:
    """A number from ``first`` for every different key."""
    codes, different = pd.factorize(keys)
    return codes + first, first + len(different)


def _half(symbols: np.ndarray, salt: int) -> np.ndarray:
    """One hashed bit for each symbol."""
    mixed = (symbols.astype(np.uint64) + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    return (mixed >> np.uint64(63)).astype(bool)


class _Round:
    """The symbols after one round, and where each has its children in the round before."""

    def __init__(self, symbols: np.ndarray, blocks: bool = False, head: np.ndarray | None = None, tail: np.ndarray | None = None):
        self.symbols, self.blocks, self.head, self.tail = symbols, blocks, head, tail
        self.up: np.ndarray | None = None


class Grammar:
    """Recompression of a sequence whose first and last symbol, and no others but separators, are unique.

    Symbols from ``n_letters`` on are separators and are never compressed.
    """

    def __init__(self, symbols: np.ndarray, n_letters: int):
        fresh = int(symbols.max()) + 1
        fence = (n_letters, fresh)  # names of separators
        self.rounds = [_Round(symbols.astype(np.int64))]
        salt = 0
        while True:
            fresh = self._compress_blocks(fresh)
            now = self.rounds[-1].symbols
            plain = (now < fence[0]) | (now >= fence[1])
            if not (plain[1:] & plain[:-1]).any():
                return
            salt += 1
            low = ~_half(now, salt)
            begins = np.zeros(len(now), bool)
            begins[:-1] = low[:-1] & ~low[1:] & plain[:-1] & plain[1:]
            if begins.any():
                fresh = self._compress_pairs(begins, fresh)

    def _push(self, symbols: np.ndarray, heads: np.ndarray, inner: np.ndarray, blocks: bool) -> None:
        below = self.rounds[-1]
        below.up = np.cumsum(~inner) - 1
        tail = np.append(heads[1:], len(below.symbols)) - 1
        self.rounds.append(_Round(symbols, blocks, heads, tail))

    def _compress_blocks(self, fresh: int) -> int:
        now = self.rounds[-1].symbols
        inner = np.zeros(len(now), bool)
        inner[1:] = now[1:] == now[:-1]
        if not inner.any():
            return fresh
        heads = np.flatnonzero(~inner)
        counts = np.diff(np.append(heads, len(now)))
        symbols = now[heads].copy()
        many = counts > 1
        symbols[many], fresh = _names(symbols[many] * (len(now) + 1) + counts[many], fresh)
        self._push(symbols, heads, inner, True)
        return fresh

    def _compress_pairs(self, begins: np.ndarray, fresh: int) -> int:
        now = self.rounds[-1].symbols
        inner = np.zeros(len(now), bool)
        inner[1:] = begins[:-1]
        heads = np.flatnonzero(~inner)
        symbols = now[heads].copy()
        paired = begins[heads]
        symbols[paired], fresh = _names(symbols[paired] * fresh + now[heads[paired] + 1], fresh)
        self._push(symbols, heads, inner, False)
        return fresh

    def extension(self, p: np.ndarray, q: np.ndarray, way: int) -> np.ndarray:
        """How many symbols from places ``p`` and ``q`` on agree, to the right (1) or left (-1).

        The separators around end every comparison of two different places.
        """
        start, rounds = p, self.rounds
        stopped: list[list[tuple]] = [[] for _ in rounds]
        query = np.arange(len(p))
        for t, at in enumerate(rounds):
            same = at.symbols[p] == at.symbols[q]
            if not same.all():
                stopped[t].append((query[~same], p[~same], q[~same]))
                query, p, q = query[same], p[same], q[same]
            if not len(query):
                break
            if at.up is None:
                while len(query):
                    p, q = p + way, q + way
                    same = at.symbols[p] == at.symbols[q]
                    stopped[t].append((query[~same], p[~same], q[~same]))
                    query, p, q = query[same], p[same], q[same]
                break
            # Up to where both begin a symbol of the next round, seen in this direction.
            above = rounds[t + 1]
            near, far = (above.head, above.tail) if way > 0 else (above.tail, above.head)
            up_p, up_q = at.up[p], at.up[q]
            inside = (near[up_p] != p) | (near[up_q] != q)
            left_p, left_q = np.abs(far[up_p] - p) + 1, np.abs(far[up_q] - q) + 1
            step = np.where(inside, np.minimum(left_p, left_q), 0) * way
            p, q = p + step, q + step
            uneven = inside & (left_p != left_q)
            if uneven.any():
                stopped[t].append((query[uneven], p[uneven], q[uneven]))
                even = ~uneven
                query, p, q = query[even], p[even], q[even]
            p, q = at.up[p], at.up[q]
        query, p, q = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
        for t in range(len(rounds) - 1, -1, -1):
            if stopped[t]:
                query, p, q = (np.concatenate(x) for x in zip((query, p, q), *stopped[t]))
            if t and len(query):
                at, below = rounds[t], rounds[t - 1]
                near, far = (at.head, at.tail) if way > 0 else (at.tail, at.head)
                left = np.minimum(np.abs(far[p] - near[p]), np.abs(far[q] - near[q])) + 1 if at.blocks else 1
                p, q = near[p], near[q]
                step = np.where(below.symbols[p] == below.symbols[q], left, 0) * way
                p, q = p + step, q + step
        found = np.empty(len(start), np.int64)
        found[query] = np.abs(p - start[query])
        return found


def _candidates(symbols: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Grid places ``i`` and periods ``q`` with equal words at ``i`` and ``i + q`` of one document.

    Documents lie in falling order of size, so those that can hold period q come first.
    """
    places, periods, held = [], [], 0
    enough = len(sizes)
    for q in range(1, int(sizes[0]) // 2 + 1 if len(sizes) else 0):
        while enough and sizes[enough - 1] < 2 * q:
            enough -= 1
        end = int(starts[enough - 1] + sizes[enough - 1])
        at = np.flatnonzero(symbols[0 : end - q : q] == symbols[q:end:q]) * q
        if len(at):
            places.append(at)
            periods.append(np.full(len(at), q))
            held += len(at)
            if held >= FLUSH_CANDIDATES:
                yield np.concatenate(places), np.concatenate(periods)
                places, periods, held = [], [], 0
    if held:
        yield np.concatenate(places), np.concatenate(periods)


def find_runs(symbols: np.ndarray, starts: np.ndarray, sizes: np.ndarray, n_letters: int, least: int = LEAST_WORDS) -> np.ndarray:
    """Rows ``start, end, period`` of all runs, by start and period, over sequences laid side by side."""
    grammar = Grammar(symbols, n_letters)
    found = [np.empty((0, 3), np.int64)]
    for places, periods in _candidates(symbols, starts, sizes):
        other = places + periods
        one = np.searchsorted(starts, places, "right") == np.searchsorted(starts, other, "right")
        places, periods, other = places[one], periods[one], other[one]
        end = other + grammar.extension(places, other, 1)
        start = places - grammar.extension(places - 1, other - 1, -1)
        long = end - start >= np.maximum(least, 2 * periods)
        found.append(np.unique(np.stack([start[long], end[long], periods[long]], 1), axis=0))
    runs = np.unique(np.concatenate(found), axis=0)
    first = np.ones(len(runs), bool)
    first[1:] = (runs[1:, :2] != runs[:-1, :2]).any(1)  # of one stretch the smallest period
    runs = runs[first]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _work(texts: list[bytes], least: int) -> list[tuple[int, list[dict], bytes]]:
    """For every text its number of words, its runs and the text without repetitions."""
    split = [t.split() for t in texts]  # bytes split at the ASCII white space that words end at
    order = sorted(range(len(texts)), key=lambda k: -len(split[k]))
    order = [k for k in order if split[k]]
    out: list[tuple[int, list[dict], bytes]] = [(0, [], b"")] * len(texts)
    if not order:
        return out
    words = pa.array([w for k in order for w in split[k]], pa.large_binary()).dictionary_encode()
    sizes = np.array([len(split[k]) for k in order])
    starts = np.cumsum(sizes + 1) - sizes  # a separator before each
    n_letters = len(words.dictionary)
    symbols = np.arange(n_letters, n_letters + len(words) + len(order) + 1, dtype=np.int64)
    inside = np.ones(len(symbols), bool)
    inside[starts - 1] = inside[-1] = False
    symbols[inside] = words.indices.to_numpy()
    symbols[~inside] = n_letters + np.arange(len(order) + 1)
    runs = find_runs(symbols, starts, sizes, n_letters, least)
    change = np.zeros(len(symbols) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 1], -1)
    dropped = np.cumsum(change) > 0
    owner = np.searchsorted(starts, runs[:, 0], "right") - 1
    cuts = np.searchsorted(owner, np.arange(len(order) + 1))
    for i, k in enumerate(order):
        mine, kept = runs[cuts[i] : cuts[i + 1]], split[k]
        if len(mine):
            kept = [kept[j] for j in np.flatnonzero(~dropped[starts[i] : starts[i] + sizes[i]])]
        spans = [{"start": s - int(starts[i]), "length": e - s, "period": q} for s, e, q in mine.tolist()]
        out[k] = (len(split[k]), spans, b" ".join(kept))
    return out


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
_SCHEMA = "doc_id bigint, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"


def _find(least: int, flush_words: int):
    def emit(ids: list, texts: list[bytes]) -> pa.RecordBatch:
        sizes, runs, collapsed = zip(*_work(texts, least)) if texts else ((), (), ())
        arrays = [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(runs, _RUNS), pa.array(collapsed, pa.string())]
        return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_words", "runs", "collapsed"])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, held = [], [], 0
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                body = text.as_buffer().to_pybytes() if text.is_valid else b""
                ids.append(doc_id.as_py())
                texts.append(body)
                held += len(body)
                if held >= 6 * flush_words:
                    yield emit(ids, texts)
                    ids, texts, held = [], [], 0
            yield emit(ids, texts)

    return find


def periodic_runs(docs: DataFrame, least: int = LEAST_WORDS, flush_words: int = FLUSH_WORDS) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` for every row.

    ``runs`` has ``start`` (word number), ``length`` and ``period`` of all maximal runs of at
    least ``least`` words and two periods, by start, then period. ``collapsed`` is the text
    without the words that a run holds after its first period, joined by single spaces.
    """
    return docs.select(docs["doc_id"].cast("bigint"), "text").mapInArrow(_find(least, flush_words), _SCHEMA)
