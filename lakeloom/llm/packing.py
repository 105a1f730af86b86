"""Packing documents into sequences by the configuration linear program.

The program has a row for each length and a column for each way to fill a sequence
(a configuration); it asks for the least number of sequences that hold every piece. It sees
the length histogram only, at most ``capacity`` counts whatever the number of documents, so
the driver solves it: multiplicative weights set a price for each length, a knapsack dynamic
program finds configurations of the highest price, and their amounts are rounded to whole
numbers. Pieces then find their sequence by their rank among the pieces of their
length, which Spark counts in blocks.

Defined results: NULL text is the empty text, which encodes to the closing id alone; equal
rows are packed each for itself; an empty table gives an empty result; other columns are not
looked at.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm.common import block_of, ordered_blocks, rows_per_block
from lakeloom.llm.memory import claim, remembered
from lakeloom.session import stage

CAPACITY = 2048
CLOSING_ID = 0
#: Rounds of the program, the gap between amounts and bound at which they end, the columns a
#: round adds, how near the dearest their value is, and the rate at which covered lengths get cheaper.
ROUNDS = 200
GAP = 0.002
COLUMNS = 64
NEAR = 0.01
RATE = 0.5
#: Share of the lengths that may run out before the remainder's dynamic program is solved anew.
STALE = 0.01
LONGER_FIRST = 0.05
#: Parts of words whose ids a Python worker remembers, and bytes of text it encodes at a time.
REMEMBER_WORDS = 250_000
ENCODE_BYTES = 2_000_000

_PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
_NAMES = ["doc_id", "piece", "start", "length", "ids_crc32"]
_encoders: dict[str, tuple] = {}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _encoder(path: str):
    """The tokenizer of this worker, one for lines of plain words, and what it has already encoded."""
    if path not in _encoders:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path) as file:
            whole = file.read()
        # The same vocabulary for words on which the other steps do nothing, one word a line.
        lines = {"type": "Split", "pattern": {"String": "\n"}, "behavior": "Isolated", "invert": False}
        as_bytes = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
        bare = json.loads(whole) | {"normalizer": None, "pre_tokenizer": {"type": "Sequence", "pretokenizers": [lines, as_bytes]}}
        tokenizer, plain = Tokenizer.from_str(whole), Tokenizer.from_str(json.dumps(bare))
        tokenizer.encode_special_tokens = plain.encode_special_tokens = True
        _encoders[path] = (tokenizer, plain, remembered({}))
    return _encoders[path]


def _is_plain(word: str) -> bool:
    """One run of small Latin letters in composed form: neither changed nor cut before encoding."""
    return word.isalpha() and word == word.lower() and (word.isascii() or (max(word) < "\u0250" and is_normalized("NFC", word)))


def _stems(words: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Each word without full stops and commas at its end, in lower case if it is ASCII; and what was cut.

    The vocabulary lowers all letters and cuts between letters and other signs, so the word's
    ids are its stem's ids and those of the signs.
    """
    trimmed = pc.utf8_rtrim(words, characters=".,")
    stems = pc.if_else(pc.ascii_is_alpha(pc.utf8_slice_codeunits(trimmed, -1)), trimmed, words)
    lower = pc.if_else(pc.string_is_ascii(stems), pc.ascii_lower(stems), stems)
    cut = pc.subtract(pc.binary_length(words), pc.binary_length(stems)).to_numpy(zero_copy_only=False)
    tails = np.full(len(words), "", dtype=object)
    at = np.flatnonzero(cut)
    tails[at] = [w[-n:] for w, n in zip(words.take(pa.array(at)).to_pylist(), cut[at].tolist())]
    return lower, pa.array(tails, pa.string())


def _ids_of_parts(path: str, parts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the ids of each of these different strings start, how many there are, and all ids known."""
    tokenizer, plain, memory = _encoder(path)
    if len(memory.get("parts", ())) > REMEMBER_WORDS:
        memory.clear()
    if not memory:
        memory |= {"parts": pa.array([""]), "counts": np.zeros(1, np.int64), "ids": np.zeros(0, np.uint32)}
    at = pc.index_in(parts, value_set=memory["parts"])
    missing = np.flatnonzero(at.is_null().to_numpy(zero_copy_only=False))
    at = at.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    if len(missing):
        new = parts.take(pa.array(missing))
        is_plain = pc.match_substring_regex(new, "^[a-z]+$").to_numpy(zero_copy_only=False)
        wide = np.flatnonzero(~pc.string_is_ascii(new).to_numpy(zero_copy_only=False))
        is_plain[wide] = [_is_plain(w) for w in new.take(pa.array(wide)).to_pylist()]
        simple, other = np.flatnonzero(is_plain), np.flatnonzero(~is_plain)
        of_lines = plain.encode_batch_fast(["\n".join(["", *new.take(pa.array(simple)).to_pylist(), ""])], add_special_tokens=False)
        ids = np.array(of_lines[0].ids, np.uint32)
        ends = np.flatnonzero(ids == ids[0])  # the line end's own id
        found = [e.ids for e in tokenizer.encode_batch_fast(new.take(pa.array(other)).to_pylist(), add_special_tokens=False)]
        counts = [np.diff(ends) - 1 if len(simple) else np.zeros(0, np.int64), np.array([len(i) for i in found], np.int64)]
        rest = np.array([i for own in found for i in own], np.uint32)
        order = np.concatenate([simple, other])
        at[missing[order]] = len(memory["parts"]) + np.arange(len(order))
        memory["parts"] = pa.concat_arrays([memory["parts"], new.take(pa.array(order))])
        memory["counts"] = np.concatenate([memory["counts"], *counts])
        memory["ids"] = np.concatenate([memory["ids"], ids[ids != ids[0]], rest])
    counts = memory["counts"]
    return (np.cumsum(counts) - counts)[at], counts[at], memory["ids"]


def _taken(starts: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The stretches of ``ids`` that begin at ``starts``, in a row."""
    before = np.cumsum(counts) - counts
    return ids[np.repeat(starts - before, counts) + np.arange(int(counts.sum()))]


def _encoded_group(texts: pa.Array, path: str) -> Iterator[bytes]:
    split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    every = split.flatten().dictionary_encode()
    stems, tails = _stems(every.dictionary)
    parts = pa.concat_arrays([stems, tails]).dictionary_encode()
    starts, counts, ids = _ids_of_parts(path, parts.dictionary)
    # A word is its stem and its tail: their ids are put side by side once for each different word.
    both = parts.indices.to_numpy().reshape(2, -1).T.ravel()
    word_ids = _taken(starts[both], counts[both], ids)
    word_counts = counts[both].reshape(-1, 2).sum(axis=1)
    word_starts = np.cumsum(word_counts) - word_counts
    used = every.indices.to_numpy()
    of_texts = _taken(word_starts[used], word_counts[used], word_ids)
    ends = np.concatenate([[0], np.cumsum(word_counts[used])])[split.offsets.to_numpy() - split.offsets[0].as_py()]
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
        yield of_texts[a:b].astype("<u4", copy=False).tobytes()


def encoded(texts: list[str | None] | pa.Array, path: str) -> Iterator[bytes]:
    """Ids of each text as little-endian unsigned 32-bit numbers.

    This vocabulary drops white space and never joins across it, so a text's ids are its
    words' ids in a row. Texts are encoded in groups of some megabytes: each different word
    of a group once, and its stem only if it is not remembered from an earlier group.
    """
    claim(_encoder(path)[2])
    texts = pa.array(texts, pa.string()) if isinstance(texts, list) else texts.cast(pa.string())
    sizes = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False).cumsum()
    done = 0
    while done < len(texts):
        before = sizes[done - 1] if done else 0
        upto = max(done + 1, int(np.searchsorted(sizes, before + ENCODE_BYTES, side="right")))
        yield from _encoded_group(texts.slice(done, upto - done), path)
        done = upto


def _pieces(path: str, capacity: int):
    closing = int(CLOSING_ID).to_bytes(4, "little")
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = 0
        for batch in batches:
            ids = batch.column(0).to_pylist()
            rows: list[list] = [[], [], [], [], [], []]
            for doc_id, code in zip(ids, encoded(batch.column(1), path)):
                code += closing
                total = len(code) // 4
                for piece, start in enumerate(range(0, total, capacity)):
                    end = min(total, start + capacity)
                    crc = zlib.crc32(memoryview(code)[4 * start : 4 * end])
                    for column, value in zip(rows, (doc_id, piece, start, end - start, crc, made)):
                        column.append(value)
                    made += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, kinds)], names=[*_NAMES, "spread"])

    return cut


def knapsack(lengths: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Highest price that fits into each capacity, and the index of the item taken last (-1: none).

    ``lengths`` ascend. Every item may be taken any number of times.
    """
    best = np.zeros(capacity + 1)
    last = np.full(capacity + 1, -1)
    fits = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for room in range(1, capacity + 1):
        best[room], last[room] = best[room - 1], -2
        if k := fits[room]:
            value = best[room - lengths[:k]] + prices[:k]
            if value[i := int(value.argmax())] > best[room]:
                best[room], last[room] = value[i], i
    return best, last


def _configuration(lengths: np.ndarray, last: np.ndarray, room: int) -> dict[int, int]:
    """Item index -> times taken in the best filling of ``room``."""
    taken: dict[int, int] = {}
    while room > 0 and last[room] != -1:
        if last[room] == -2:
            room -= 1
            continue
        taken[int(last[room])] = taken.get(int(last[room]), 0) + 1
        room -= int(lengths[last[room]])
    return taken


def _columns(lengths: np.ndarray, last: np.ndarray, capacity: int, held: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The best filling that holds each of the items ``held``, as (column, item, times), sorted."""
    settled = np.maximum.accumulate(np.where(last != -2, np.arange(capacity + 1), 0))
    column, item, room = np.arange(len(held)), held, capacity - lengths[held]
    cells = []
    while len(column):
        cells.append(column * len(lengths) + item)
        room = settled[room]
        more = last[room] >= 0
        column, item, room = column[more], last[room][more], room[more]
        room = room - lengths[item]
    cell, times = np.unique(np.concatenate(cells), return_counts=True)
    return cell // len(lengths), cell % len(lengths), times


def fractional_program(
    lengths: np.ndarray, counts: np.ndarray, capacity: int
) -> tuple[dict[tuple, float], np.ndarray, float]:
    """Solves the configuration program: amounts of configurations, a price for each length, a lower bound.

    A configuration is ``((item index, times), ...)``. Each round the dynamic program, over the
    real lengths, finds the dearest filling of a sequence at the present prices; prices divided
    by its value are feasible for the dual program, so the pieces' total price is a lower
    bound. Of the fillings within ``NEAR`` of the dearest, those that hold the least covered
    lengths are used as often as the scarcest of their pieces allows, and each length gets
    cheaper by a factor for the share that they cover. Rounds end when the amounts, scaled until
    they cover everything, come within ``GAP`` of the bound.
    """
    amounts: dict[tuple, float] = {}
    covered = np.zeros(len(lengths))
    base = lengths / capacity
    price, chosen, bound = base, base, 0.0
    for _ in range(ROUNDS):
        best, last = knapsack(lengths, price, capacity)
        value = float(counts @ price) / best[capacity]
        if value > bound:
            bound, chosen = value, price / best[capacity]
        near = np.flatnonzero(price + best[capacity - lengths] >= (1 - NEAR) * best[capacity])
        near = near[np.argsort(covered[near], kind="stable")[:COLUMNS]]
        column, item, times = _columns(lengths, last, capacity, near)
        first = np.flatnonzero(np.diff(column, prepend=-1))
        used = np.minimum.reduceat(counts[item] / times, first)
        share = np.bincount(item, times * used[column] / counts[item], len(lengths))
        used, share = used / share.max(), share / share.max()
        for own, amount in zip(np.split(np.stack([item, times], 1), first[1:]), used.tolist()):
            key = tuple(map(tuple, own.tolist()))
            amounts[key] = amounts.get(key, 0.0) + amount
        covered += share
        price = base * np.exp(-RATE * (covered - covered.min()))
        if covered.min() > 0 and sum(amounts.values()) / covered.min() <= (1 + GAP) * bound:
            break
    # Lengths that no round has covered are left to the rounding.
    scale = 1 / covered.min() if covered.min() > 0 else bound / sum(amounts.values())
    return {k: x * scale for k, x in amounts.items()}, chosen, bound


def _packed_remainder(lengths: np.ndarray, counts: np.ndarray, prices: np.ndarray, capacity: int) -> list[tuple[int, dict[int, int]]]:
    """Packs what rounding has left: the longest piece, beside it the dearest filling of the room.

    The dynamic program is solved anew when a ``STALE`` share of the lengths has run out.
    Pieces that the filling asks for in vain are replaced by the longest that fit.
    """
    result = []
    solved_for, last = 0, None
    while len(lengths):
        if last is None or len(lengths) < (1 - STALE) * solved_for:
            _, last = knapsack(lengths, prices, capacity)
            solved_for, of_program, index = len(lengths), lengths, np.arange(len(lengths))
        longest = len(lengths) - 1
        room = capacity - int(lengths[longest])
        taken = {longest: 1}
        for i, n in _configuration(of_program, last, room).items():
            now = int(index[i])
            if now >= 0 and (n := min(n, int(counts[now]) - taken.get(now, 0))) > 0:
                taken[now] = taken.get(now, 0) + n
        slack = capacity - sum(int(lengths[i]) * n for i, n in taken.items())
        i = int(np.searchsorted(lengths, slack, side="right")) - 1
        while i >= 0:
            if (more := min(slack // int(lengths[i]), int(counts[i]) - taken.get(i, 0))) > 0:
                taken[i] = taken.get(i, 0) + more
                slack -= more * int(lengths[i])
            i = min(i, int(np.searchsorted(lengths, slack, side="right"))) - 1
        times = min(int(counts[i]) // n for i, n in taken.items())
        result.append((times, {int(lengths[i]): n for i, n in taken.items()}))
        for i, n in taken.items():
            counts[i] -= times * n
        if not all(counts[i] for i in taken):
            alive = counts > 0
            moved = np.append(np.where(alive, np.cumsum(alive) - 1, -1), -1)
            index = moved[index]
            lengths, counts, prices = lengths[alive], counts[alive], prices[alive]
    return result


def configurations(histogram: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """Whole-number configurations ``(times, {length: pieces})`` that hold every piece.

    The fractional amounts are rounded down, the largest first and never beyond the pieces
    that are left; the remainder, less than one sequence for each configuration of the
    program and what it covers too often, is packed by the program's prices.
    """
    left = {n: c for n, c in histogram.items() if c > 0 and n < capacity}
    result = [(histogram[capacity], {capacity: 1})] if histogram.get(capacity) else []
    if not left:
        return result
    lengths = np.array(sorted(left))
    counts = np.array([left[n] for n in lengths])
    amounts, prices, _ = fractional_program(lengths, counts, capacity)
    for taken, amount in sorted(amounts.items(), key=lambda kept: (-kept[1], kept[0])):
        times = min(int(amount + 1e-6), *(int(counts[i]) // n for i, n in taken))
        if times > 0:
            result.append((times, {int(lengths[i]): n for i, n in taken}))
            for i, n in taken:
                counts[i] -= times * n
    alive = counts > 0
    # Of equally dear fillings the one with longer pieces is used: short ones fit anywhere later.
    prices = prices + LONGER_FIRST * (lengths / capacity) ** 2
    return result + _packed_remainder(lengths[alive], counts[alive], prices[alive], capacity)


def _places(configs: list[tuple[int, dict[int, int]]]) -> dict[str, np.ndarray]:
    """For each length, which ranks belong to which configuration, sorted by (length, first rank)."""
    rows, first, sequence = [], {}, 0
    for times, taken in configs:
        offset = 0
        for length, n in sorted(taken.items(), reverse=True):
            rows.append((length, first.get(length, 0), n, sequence, offset))
            first[length] = first.get(length, 0) + times * n
            offset += length * n
        sequence += times
    rows.sort()
    table = np.array(rows, dtype=np.int64).reshape(-1, 5)
    return {"key": (table[:, 0] << 44) | table[:, 1], "first": table[:, 1], "each": table[:, 2], "sequence": table[:, 3], "offset": table[:, 4]}


def _assign(places: dict[str, np.ndarray]):
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            length = batch.column("length").to_numpy(zero_copy_only=False)
            at = np.searchsorted(places["key"], (length << 44) | rank, side="right") - 1
            inside = rank - places["first"][at]
            copy, slot = np.divmod(inside, places["each"][at])
            columns = [batch.column(c) for c in _NAMES]
            columns += [pa.array(places["sequence"][at] + copy), pa.array(places["offset"][at] + slot * length)]
            yield pa.RecordBatch.from_arrays(
                columns, names=[*_NAMES, "sequence_id", "offset"]
            )

    return assign


def pack(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``."""
    path = tokenizer or default_tokenizer()
    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text"))
    # ``spread`` numbers the pieces of a task: repeated rows are told apart by nothing else.
    pieces = stage(slim.mapInArrow(_pieces(path, capacity), _PIECES + ", spread bigint"), "pieces")
    by_length = pieces.groupBy("length").agg(F.count("*").alias("of_length"))
    histogram = {r.length: r.of_length for r in by_length.collect()}  # at most `capacity` rows
    places = _places(configurations(histogram, capacity))

    # Rank among the pieces of a length: blocks cut the frequent lengths.
    size = rows_per_block(pieces, sum(histogram.values()))
    counted = pieces.join(F.broadcast(by_length.withColumnRenamed("length", "of")), F.col("length") == F.col("of"))
    counted = counted.withColumn("block", block_of(F.col("of_length"), size, "doc_id", "piece", "start", "spread"))
    sums = ordered_blocks(counted.groupBy("length", "block").agg(F.count("*").alias("n")), "length", "block", "n")
    sums = sums.select(F.col("length").alias("l"), F.col("block").alias("b"), "before")
    inside = Window.partitionBy("length", "block").orderBy("doc_id", "piece", "ids_crc32", "spread")
    ranked = counted.withColumn("within", F.row_number().over(inside) - 1).join(
        sums, (F.col("length") == F.col("l")) & (F.col("block") == F.col("b"))
    )
    ranked = ranked.select(
        *_NAMES, (F.col("before") + F.col("within")).cast("bigint").alias("rank")
    )
    return ranked.mapInArrow(_assign(places), _PIECES + ", sequence_id bigint, offset bigint")
