"""Spelling variants by composing the vocabulary's acceptor with a one-edit transducer and itself.

Two words are near if one inserted, deleted or replaced code point makes them equal. Halving
deals the vocabulary over initial states: of two near words at least one half agrees, so the
pairs of shorter length L are those behind a common first half, and, where that differs, those
before a common second half. The words of one such state become minimised acceptors, one for
each length, built from their sorted remainders. Acceptor, transducer and acceptor are composed:
both walk the same arcs while nothing is edited, one arc is replaced or inserted, and from there
on the common language of the two states reached is accepted. Every pair has one path: an
insertion is read as late as it can be.

States with more than ``STATE_WORDS`` words are halved again, until one free code point is left,
which bounds a state by the alphabet. Pairs never leave their task: a word takes along how many
near words it has and the best one.

Defined results: NULL and empty texts have no words; a NULL identifier hashes as the empty
text; repeated rows count again; ties between forms go to the smaller word in code-point order;
very long texts are counted piece by piece, very long words are words like others; an empty
table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import join_bounded
from lakeloom.session import stage

LEAST_CHARS = 5
LEAST_COUNT = 3
#: One in so many occurrences loses a code point.
TYPO_EVERY = 97
#: Words that a worker counts before it hands them on.
HELD_WORDS = 200_000
LONG_TEXT = 1_000_000
#: Words of an initial state beyond which it is halved again; more than two free code points
#: of this alphabet can spell.
STATE_WORDS = 20_000
EMIT_ROWS = 20_000
BROADCAST_STATES = 100_000


def _count_words(least: int, typo_every: int | None, held_words: int):
    run = re.compile("[a-zÀ-ÿ]{%d,}" % least)  # a shorter run is no word, with a typo or without

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"]
            )
            held.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not text:
                    continue
                lowered = text.encode().lower().decode()  # bytes know A-Z only
                runs = run.findall(lowered) if len(lowered) < LONG_TEXT else (m.group() for m in run.finditer(lowered))
                seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for word, n in Counter(runs).items():
                    if typo_every:
                        h = zlib.crc32(word.encode(), seed)
                        if h % typo_every == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                            if len(word) < least:
                                continue
                    held[word] = held.get(word, 0) + n
                if len(held) >= held_words:
                    yield flush()
        yield flush()

    return count


def vocabulary(
    docs: DataFrame, least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT, typo_every: int | None = TYPO_EVERY,
    held_words: int = HELD_WORDS,
) -> DataFrame:
    """``word, n``: lower-cased words of at least so many code points that occur often enough.

    ``typo_every`` plants typing errors by a fixed rule (None: none): where the crc32 of
    ``<doc_id>:<word>`` is divisible by it, the code point at that value modulo the length is lost.
    """
    counted = docs.select("doc_id", "text").mapInArrow(_count_words(least_chars, typo_every, held_words), "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


class Acceptor:
    """The smallest acceptor of sorted different words; state 0 is the end of the longest ones."""

    def __init__(self, words: list[str]):
        self.arcs: list[dict[str, int]] = [{}]
        self.final = {0}
        self._register: dict[tuple, int] = {((), True): 0}
        path: list[dict[str, int]] = [{}]  # arcs of the states along the last word
        ends = [False]
        last = ""
        for word in words:
            same = 0
            for a, b in zip(last, word):
                if a != b:
                    break
                same += 1
            self._close(path, ends, last, same)
            for _ in word[same:]:
                path.append({})
                ends.append(False)
            ends[-1] = True
            last = word
        self._close(path, ends, last, 0)
        self.start = self._state(path[0], ends[0])

    def _state(self, arcs: dict[str, int], end: bool) -> int:
        key = (tuple(arcs.items()), end)
        state = self._register.get(key)
        if state is None:
            state = self._register[key] = len(self.arcs)
            self.arcs.append(arcs)
            if end:
                self.final.add(state)
        return state

    def _close(self, path: list, ends: list, last: str, depth: int) -> None:
        """States deeper than ``depth`` get no further arcs and find their equals."""
        for at in range(len(last), depth, -1):
            state = self._state(path.pop(), ends.pop())
            path[-1][last[at - 1]] = state

    def language(self) -> list[str]:
        return _common(self, self.start, self, self.start)


def _common(one: Acceptor, q: int, two: Acceptor, r: int) -> list[str]:
    """The words that are accepted from both states."""
    found, todo = [], [(q, r, "")]
    while todo:
        q, r, word = todo.pop()
        if q in one.final and r in two.final:
            found.append(word)
        there = two.arcs[r]
        for c, to in one.arcs[q].items():
            other = there.get(c)
            if other is not None:
                todo.append((to, other, word + c))
    return found


def near_pairs(short: Acceptor, long: Acceptor | None = None) -> Iterator[tuple[str, str]]:
    """Accepted pairs of the composition: words of ``short`` that differ by a replaced code
    point, or, with ``long``, a word of ``short`` and one of ``long`` that has one more."""
    other = short if long is None else long
    known: dict[tuple[int, int], list[str]] = {}

    def common(q: int, r: int) -> list[str]:
        if (q, r) not in known:
            known[q, r] = _common(short, q, other, r)
        return known[q, r]

    todo = [(short.start, other.start, "")]
    while todo:
        q, r, word = todo.pop()
        here, there = short.arcs[q], other.arcs[r]
        if long is None:
            arcs = list(here.items())
            for i, (a, x) in enumerate(arcs):
                for b, y in arcs[i + 1 :]:
                    for rest in common(x, y):
                        yield word + a + rest, word + b + rest
        else:
            for a, y in there.items():
                for rest in common(q, y):
                    if not rest.startswith(a):
                        yield word + rest, word + a + rest
        for c, x in here.items():
            y = there.get(c)
            if y is not None:
                todo.append((x, y, word + c))


def belongs(one: str, two: str, length: int, path: str) -> bool:
    """Whether a pair's own path is ``path``: at each halving the first half if it agrees."""
    for side in path:
        k = length // 2
        if side == "L":
            one, two, length = one[k:], two[k:], length - k
        else:
            if one[:k] == two[:k]:
                return False
            cut = length - k
            one, two, length = one[: len(one) - cut], two[: len(two) - cut], k
    return True


def _halved(rows: DataFrame) -> DataFrame:
    """Each word behind its first half and before its second half; ``free`` is what is left."""
    k = F.expr("free_length div 2")
    size = F.length("free")
    first = F.struct(
        F.concat("path", F.lit("L")).alias("path"),
        F.concat("before", F.col("free").substr(F.lit(1), k)).alias("before"),
        F.col("behind"),
        F.col("free").substr(k + 1, size).alias("free"),
        (F.col("free_length") - k).alias("free_length"),
    )
    keep = size - F.col("free_length") + k
    second = F.struct(
        F.concat("path", F.lit("R")).alias("path"),
        F.col("before"),
        F.concat(F.col("free").substr(keep + 1, size), F.col("behind")).alias("behind"),
        F.col("free").substr(F.lit(1), keep).alias("free"),
        k.alias("free_length"),
    )
    return rows.select("band", "n", F.explode(F.array(first, second)).alias("h")).select("band", "n", "h.*")


_STATE = ["band", "path", "before", "behind"]


def initial_states(words: DataFrame, least_chars: int = LEAST_CHARS, state_words: int = STATE_WORDS) -> DataFrame:
    """``band, path, before, behind, free, n``: every word in the states its pairs are found in.

    ``band`` is the length of the shorter word of a pair, so a word is in two bands.
    """
    size = F.length("word")
    bands = F.array_remove(F.array(size, F.when(size > least_chars, size - 1).otherwise(-1)), F.lit(-1))
    rows = words.select("word", "n", F.explode(bands).alias("band")).select(
        "band", "n", F.lit("").alias("path"), F.lit("").alias("before"), F.lit("").alias("behind"),
        F.col("word").alias("free"), F.col("band").alias("free_length"),
    )
    rows, done = _halved(rows), None
    while True:
        large = rows.where("free_length > 1").groupBy(*_STATE).count().where(F.col("count") > state_words)
        large = stage(large.select(*[F.col(c).alias("of_" + c) for c in _STATE]), "large-states")
        if large.isEmpty():
            return rows if done is None else done.unionByName(rows)
        rows = stage(rows, "states")
        same = F.lit(True)
        for c in _STATE:
            same = same & (F.col(c) == F.col("of_" + c))
        fine = join_bounded(rows, large, same, BROADCAST_STATES, "left_anti")
        done = fine if done is None else done.unionByName(fine)
        rows = _halved(join_bounded(rows, large, same, BROADCAST_STATES, "left_semi"))


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted states to ``word, n_near, best_n, best`` for every word with a near one in the state."""
    out: list[list] = [[], [], [], []]
    now, members = None, []

    def close() -> None:
        if len(members) < 2:
            return
        band, path, before, behind = now
        counts = dict(members)
        inner = band - len(before) - len(behind)
        short = Acceptor([w for w, _ in members if len(w) == inner])
        near: dict[str, list] = {}

        def meet(word: str, other: str) -> None:
            whole, n = before + other + behind, counts[other]
            at = near.get(word)
            if at is None:
                near[word] = [1, n, whole]
            else:
                at[0] += 1
                if n > at[1] or (n == at[1] and whole < at[2]):
                    at[1:] = n, whole

        longer = [w for w, _ in members if len(w) > inner]
        composed = [near_pairs(short), near_pairs(short, Acceptor(longer))] if longer else [near_pairs(short)]
        for pairs in composed:
            for one, two in pairs:
                if "R" not in path or belongs(before + one + behind, before + two + behind, band, path):
                    meet(one, two)
                    meet(two, one)
        for word, (n_near, n, whole) in near.items():
            for column, value in zip(out, (before + word + behind, n_near, n, whole)):
                column.append(value)

    def flush() -> pa.RecordBatch:
        types = (pa.string(), pa.int64(), pa.int64(), pa.string())
        batch = pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(out, types)], names=["word", "n_near", "best_n", "best"]
        )
        for column in out:
            column.clear()
        return batch

    for batch in batches:
        for *state, free, n in zip(*(c.to_pylist() for c in batch.columns)):
            if state != now:
                close()
                now, members = state, []
                if len(out[0]) >= EMIT_ROWS:
                    yield flush()
            members.append((free, n))
    close()
    yield flush()


def near_words(words: DataFrame, least_chars: int = LEAST_CHARS, state_words: int = STATE_WORDS) -> DataFrame:
    """``word, n_near, best_n, best``: how many near words, and the most frequent one."""
    states = initial_states(words, least_chars, state_words)
    dealt = states.repartition(*_STATE).sortWithinPartitions(*_STATE, "free").select(*_STATE, "free", "n")
    found = dealt.mapInArrow(_near, "word string, n_near bigint, best_n bigint, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select(
        "word", "n_near", (-F.col("best.n")).alias("best_n"), F.col("best.word").alias("best")
    )


def with_roots(forms: DataFrame) -> DataFrame:
    """Adds ``root``, the last form reached from ``word``; each round doubles the steps taken.

    A form is at least twice as frequent as its word, so chains are short and have no cycle.
    """
    links = stage(forms.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "forms")
    while True:
        of = links.select(F.col("word").alias("via"), F.col("root").alias("further"))
        met = links.join(of, F.col("root") == F.col("via"), "left")
        links = stage(
            met.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "forms"
        )
        if links.where("moved").isEmpty():
            break
        links = links.drop("moved")
    roots = links.select(F.col("word").alias("via"), "root")
    return forms.join(roots, F.col("word") == F.col("via"), "left").drop("via").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(words: DataFrame, least_chars: int = LEAST_CHARS, state_words: int = STATE_WORDS) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for a vocabulary ``word, n``.

    A word's form is its most frequent near word, if that is at least twice as frequent.
    """
    words = stage(words.select("word", "n"), "vocabulary")
    near = near_words(words, least_chars, state_words).withColumnRenamed("word", "near_of")
    joined = words.join(near, F.col("word") == F.col("near_of"), "left")
    is_form = F.col("best_n") >= 2 * F.col("n")
    forms = joined.select(
        "word",
        F.when(is_form, F.col("best")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(is_form, F.col("best_n")).alias("form_n"),
    )
    return with_roots(stage(forms, "variants")).select("word", "form", "root", "n", "n_near", "form_n")
