"""Language identification by cross-parsing entropy.

Each language is a bounded sample of its labelled text, held as a suffix automaton. A text is
parsed against every sample: from each place the longest match in the sample is one phrase.
The closer the text is to a language, the longer its phrases; phrases times the logarithm of
the sample's length, for each character, estimate the cross entropy, and the smallest wins.

Texts are lower-cased, and all that is no letter becomes one space. Pieces of ``PIECE`` characters
are parsed side by side with numpy, as if a phrase began with each; then the state in which the
piece before ended is carried over the border, and a piece is parsed again up to the character
where both parses stand in the same state. So the parse is that of the whole text, however long.

An automaton has the alphabet of its own sample. Up to ``DENSE_SYMBOLS`` characters its moves are
a table, beyond that a sorted list of edges, so that its size follows the sample alone. At most
``LANGUAGES`` languages are learnt, those with the most text.

Defined results: NULL texts and texts without a letter are ``und`` with score 0, and so is
everything if no row can be learnt from; NULL identifiers are predicted but never learnt
from and not held out; ties go to the first language in order; repeated rows are predicted
alike; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import functools
import re
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The sample: letters and spaces of text for each language, and of one document at most.
SAMPLE_CHARS = 40_000
DOCUMENT_CHARS = 2_000
LANGUAGES = 500
#: Characters of a sample up to which its automaton is a table.
DENSE_SYMBOLS = 128
PIECE = 256
#: Characters that are parsed at a time.
BATCH_CHARS = 1_500_000

UNKNOWN = "und"
_SPACE, _UNSEEN = 0, 1


@functools.cache
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def _code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def normalised(text: str) -> str:
    points = _code_points(text.lower()).copy()
    points[~_letters()[points]] = 32
    return re.sub(" +", " ", points.tobytes().decode("utf-32-le", "surrogatepass")).strip()


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the smallest automaton that reads every substring, from state 0."""
    moves: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for c in symbols:
        state = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in moves[p]:
            moves[p][c] = state
            p = link[p]
        if p >= 0:
            q = moves[p][c]
            if length[q] == length[p] + 1:
                link[state] = q
            else:
                copy = len(moves)
                moves.append(dict(moves[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and moves[p].get(c) == q:
                    moves[p][c] = copy
                    p = link[p]
                link[q] = link[state] = copy
        last = state
    return moves


class Automaton:
    """A sample's suffix automaton; a step gives ``next state * 2 + a phrase begins``.

    The last state stands between phrases: before the text, and after a character that the sample
    does not have. Without a match a new phrase begins, with this character where the sample has it.
    """

    def __init__(self, sample: str, symbol: np.ndarray, symbols: int):
        points = _code_points(sample)
        own = np.unique(np.append(symbol[points], (_SPACE, _UNSEEN, symbols)))
        #: From the symbols of all languages to this one's; what the sample lacks is unseen.
        self.local = np.full(symbols + 1, _UNSEEN, np.int32)
        self.local[own] = np.arange(len(own))
        self.fill, self.width = len(own) - 1, len(own)
        moves = suffix_automaton(self.local[symbol[points]].tolist())
        self.between = len(moves)
        self.log = np.log2(max(len(sample), 2))
        self.start = np.full(self.width, self.between * 2 + 1, np.int32)
        for c, to in moves[0].items():
            self.start[c] = to * 2 + 1
        edges = [(state * self.width + c, to * 2) for state, out in enumerate(moves) for c, to in out.items()]
        self.edges = self.to = self.table = None
        if self.width <= DENSE_SYMBOLS:
            table = np.tile(self.start, (self.between + 1, 1))
            for at, to in edges:
                table[divmod(at, self.width)] = to
            table[:, self.fill] = np.arange(self.between + 1) * 2
            self.table = table.astype(np.int32).ravel()
        else:
            known = np.array(sorted(edges), np.int64).reshape(-1, 2)
            self.edges, self.to = np.ascontiguousarray(known[:, 0]), known[:, 1].astype(np.int32)

    def step(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """``symbol`` is this automaton's own; one more symbol fills up short pieces and moves nothing."""
        if self.table is not None:
            return self.table[state * self.width + symbol]
        wanted = state.astype(np.int64) * self.width + symbol
        at = np.searchsorted(self.edges, wanted)
        at[at == len(self.edges)] = 0
        found = np.where(self.edges[at] == wanted, self.to[at], self.start[symbol]) if len(self.edges) else self.start[symbol]
        return np.where(symbol == self.fill, state * 2, found).astype(np.int32)

    def parse(self, grid: np.ndarray, follows: np.ndarray, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Phrases that begin in each column of ``grid``, and the state at its end.

        A column that ``follows`` goes on with the text of the one before it; the others start
        in ``entry``.
        """
        cells = self.local[grid]
        steps = np.empty_like(cells)
        state = np.where(follows, self.between, entry).astype(np.int32)
        for k, column in enumerate(cells):
            steps[k] = self.step(state, column)
            state = steps[k] >> 1
        entered = np.where(follows, self.between, entry)
        while True:
            before = np.where(follows, np.append(entry[:1], steps[-1, :-1] >> 1), entered)
            open_ = np.flatnonzero(before != entered)
            if not len(open_):
                return (steps & 1).sum(axis=0), steps[-1] >> 1
            entered = before
            state = before[open_].astype(np.int32)
            for k in range(len(cells)):
                new = self.step(state, cells[k, open_])
                differs = (new >> 1) != (steps[k, open_] >> 1)
                steps[k, open_] = new
                open_, state = open_[differs], (new >> 1)[differs]
                if not len(open_):
                    break


class CrossParser:
    """The automata of all languages."""

    def __init__(self, samples: dict[str, str]):
        self.languages = sorted(samples)
        alphabet = sorted({c for s in samples.values() for c in s} - {" "})
        self.symbol = np.where(_letters(), _UNSEEN, _SPACE).astype(np.int32)
        for i, c in enumerate(alphabet):
            self.symbol[ord(c)] = i + 2
        self.fill = len(alphabet) + 2
        self.automata = [Automaton(samples[name], self.symbol, self.fill) for name in self.languages]
        self.logs = np.array([a.log for a in self.automata])

    def _pieces(self, text: str) -> Iterator[np.ndarray]:
        """Symbols of the normalised text, in long stretches."""
        spaced = True
        for at in range(0, len(text), BATCH_CHARS):
            symbols = self.symbol[_code_points(text[at : at + BATCH_CHARS].lower())]
            space = symbols == _SPACE
            keep = ~space
            keep |= space & ~np.append(spaced, space[:-1])
            spaced = bool(space[-1])
            yield symbols[keep]

    def parse(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """For each text: phrases by language, and characters (0: no letter)."""
        phrases = np.zeros((len(texts), len(self.languages)))
        characters = np.zeros(len(texts), np.int64)
        held, owners, size = [], [], 0
        last, ends = -1, [a.between for a in self.automata]  # the text parsed last, and its states

        def flush() -> None:
            nonlocal held, owners, size, last, ends
            if held:
                ends = self._parse_pieces(held, np.array(owners), phrases, last, ends)
                last = owners[-1]
            held, owners, size = [], [], 0

        for i, text in enumerate(texts):
            for symbols in self._pieces(text or ""):
                if not (symbols != _SPACE).any():
                    continue
                characters[i] += len(symbols)
                held.append(symbols)
                owners.append(i)
                size += len(symbols)
                if size >= BATCH_CHARS:
                    flush()
        flush()
        return phrases, characters

    def _parse_pieces(self, held: list[np.ndarray], owners: np.ndarray, phrases: np.ndarray, last: int, ends: list[int]) -> list[int]:
        """Adds the phrases of ``held``; the first goes on with text ``last``, if it is its owner, in the states ``ends``."""
        first = np.append(0, np.flatnonzero(np.diff(owners)) + 1)  # a text's stretches stand together
        whole = [np.concatenate(held[a:b]) for a, b in zip(first, np.append(first[1:], len(held)))]
        owners = owners[first]
        counts = np.array([-(-len(s) // PIECE) for s in whole])
        grid = np.full((int(counts.sum()), PIECE), self.fill, np.int32)
        row = 0
        for symbols, n in zip(whole, counts):
            grid[row : row + n].reshape(-1)[: len(symbols)] = symbols
            row += n
        grid = np.ascontiguousarray(grid.T)
        follows = np.ones(grid.shape[1], bool)
        follows[np.cumsum(counts) - counts] = False
        owner = np.repeat(owners, counts)
        result = []
        for language, automaton in enumerate(self.automata):
            entry = np.full(grid.shape[1], automaton.between, np.int32)
            if owners[0] == last:
                entry[0] = ends[language]
            found, state = automaton.parse(grid, follows, entry)
            np.add.at(phrases[:, language], owner, found)
            result.append(int(state[-1]))
        return result

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        phrases, characters = self.parse(texts)
        entropy = phrases * self.logs / np.maximum(characters, 1)[:, None]
        best = entropy.argmin(axis=1)
        low = entropy[np.arange(len(texts)), best]
        rivals = entropy.copy()
        rivals[np.arange(len(texts)), best] = np.inf
        second = rivals.min(axis=1) if len(self.languages) > 1 else np.full(len(texts), np.inf)
        some = characters > 0
        score = np.where(some, 1 - low / np.maximum(second, 1e-12), 0.0)
        return [self.languages[b] if s else UNKNOWN for b, s in zip(best, some)], score.clip(0, 1)


def samples(rows: DataFrame, sample_chars: int = SAMPLE_CHARS, document_chars: int = DOCUMENT_CHARS) -> dict[str, str]:
    """Labelled text of each language of ``rows (doc_id, text, lang)``, at most ``sample_chars`` each.

    Which rows come to the driver follows from a hash of the identifier and from the amount of
    text in the language, so that about twice the sample is read whatever the table's size.
    """
    rows = rows.where("lang IS NOT NULL AND text IS NOT NULL")
    amount = rows.groupBy(F.col("lang").alias("l")).agg(F.sum(F.least(F.length("text"), F.lit(document_chars))).alias("chars"))
    # At most LANGUAGES rows, of a name and a number each.
    amount = amount.orderBy(F.desc("chars"), "l").limit(LANGUAGES)
    share = amount.select("l", (F.lit(2.5 * sample_chars) / F.greatest("chars", F.lit(1))).alias("share"))
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000_007)) / F.lit(1_000_000_007)
    chosen = rows.select("lang", F.substring("text", 1, document_chars).alias("text"), place.alias("place"))
    chosen = chosen.join(F.broadcast(share), F.col("lang") == F.col("l")).where(F.col("place") < F.col("share"))
    found: dict[str, str] = {}
    for row in sorted(set(map(tuple, chosen.select("lang", "place", "text").collect()))):
        have = found.setdefault(row[0], "")
        if len(have) < sample_chars:
            found[row[0]] = have + normalised(row[2])[: sample_chars - len(have)] + " "
    return {name: text for name, text in found.items() if text.strip()}


@functools.cache
def _parser(key: tuple) -> CrossParser:
    return CrossParser(dict(key))


def _predict(model):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = _parser(model.value)
        for batch in batches:
            languages, score = parser.predict(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(languages, pa.string()), pa.array(score, pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    return predict


def identify(docs: DataFrame, learn_from: DataFrame) -> DataFrame:
    """``doc_id, lang_pred, score`` for every document, learnt from ``learn_from (doc_id, text, lang)``."""
    model = docs.sparkSession.sparkContext.broadcast(tuple(sorted(samples(learn_from).items())))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return texts.mapInArrow(_predict(model), "doc_id bigint, lang_pred string, score double")
