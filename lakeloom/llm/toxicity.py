"""Toxic spans and document scores from a linear-chain conditional random field.

Documents carry labels, tokens do not, so token labels are derived first: a token of a toxic
document is labelled toxic when its word, or the beginning of its word, is found far more
often in toxic documents than in others. The field is trained on these tokens: unary weights
for hashed features of the token, one weight for each pair of neighbouring tags. At scoring,
forward-backward marginals give each token a probability; tokens above one half merge to
spans with offsets, and a logistic function of the marginals' sum and maximum, fitted on the
whole texts of the sampled labelled documents, gives the document's score.

The sample has documents of every length; the field learns from at most ``SAMPLE_CHAINS`` chains
of a document, chosen by a hash, of ``CHAIN`` consecutive tokens each. At scoring every text is one
chain from its first token to its last: its blocks of ``CHAIN`` tokens are computed side by side
with numpy, and the messages between neighbouring blocks are carried over as two-by-two products.

Defined results: NULL and empty texts get the score of a text without toxic tokens; very long
texts are one chain as well; labels that are NULL, contradict each other (the larger counts) or
have no document are handled in the fit, which takes one text of a repeated identifier, the same
at every run; without labels of both kinds every score is 0; NULL identifiers are scored, never
learnt from; repeated rows are scored alike; an empty table gives an empty result; other
columns are not looked at.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.memory import claim, remembered
from lakeloom.session import stage

#: Labelled documents that the fit reads for each label, and the chains it takes of one.
SAMPLE_DOCUMENTS = 2000
SAMPLE_CHAINS = 16
#: Documents of each label whose chains train the field.
CHAIN_DOCUMENTS = 800
CHAIN = 64
HASH_BITS = 18
PREFIXES = (4, 6)
#: A feature marks toxic tokens if so many toxic documents have it, with such log odds.
LEAST_DOCUMENTS = 4
LEAST_LOG_ODDS = 3.0
STEPS = 40
REMEMBER_WORDS = 200_000
BATCH_CHARS = 2_000_000

_TOKEN = re.compile(r"[^\W_]+")
_MASK = (1 << HASH_BITS) - 1


def tokens(text: str | None) -> list[str]:
    """Runs of letters and digits, in lower case."""
    found = _TOKEN.findall(text or "")
    return "\n".join(found).lower().split("\n") if found else []


def features(word: str) -> list[str]:
    """The word, its beginnings and end, and one that all tokens share: how rare toxic ones are."""
    return ["w" + word, *(f"{n}{word[:n]}" for n in PREFIXES), "s" + word[-4:], "every"]


def _slots(word: str) -> list[int]:
    return [zlib.crc32(f.encode()) & _MASK for f in features(word)]


@dataclass
class Model:
    weights: np.ndarray  # by feature slot, toxic minus clean
    pairs: np.ndarray  # 2 x 2, by (tag, next tag)
    document: np.ndarray  # intercept, sum of marginals, largest marginal


def _chains(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For texts of so many tokens in a row: first token and length of each chain."""
    starts, sizes = [], []
    at = 0
    for n in lengths.tolist():
        for k in range(0, n, CHAIN):
            starts.append(at + k)
            sizes.append(min(CHAIN, n - k))
        at += n
    return np.array(starts, np.int64), np.array(sizes, np.int64)


def _block_products(u: np.ndarray, starts: np.ndarray, sizes: np.ndarray, lead: np.ndarray, t: np.ndarray) -> np.ndarray:
    """What each block, longest first, does to the forward message that enters it: 2 x 2 up to a factor."""
    product = np.zeros((2, 2, len(starts)))
    product[0, 0] = product[1, 1] = 1
    for k in range(int(sizes[0])):
        n = int(np.searchsorted(-sizes, -k, side="left"))
        odds, held = u[starts[:n] + k], product[:, :, :n]
        toxic = odds * (t[1, 1] * held[0] + t[0, 1] * held[1])
        clean = t[1, 0] * held[0] + t[0, 0] * held[1]
        if not k:  # a text's first token has no token before it
            toxic, clean = np.where(lead[:n], odds, toxic), np.where(lead[:n], 1.0, clean)
        total = toxic.sum(axis=0) + clean.sum(axis=0)
        held[0], held[1] = toxic / total, clean / total
    return product


def _carried(product: np.ndarray, first: np.ndarray, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ratios of the messages that enter each block from the left and from the right.

    ``first`` is each text's first block and ``blocks`` how many it has; block by block, all texts at once.
    """
    left, right = np.ones(product.shape[2]), np.ones(product.shape[2])
    order = np.argsort(-blocks, kind="stable")
    first, blocks = first[order], blocks[order]
    steps = range(1, int(blocks.max(initial=0)))
    for k in steps:
        at = first[: int(np.searchsorted(-blocks, -k, side="left"))] + k
        (a, b), (c, d) = product[:, :, at - 1]
        left[at] = (a * left[at - 1] + b) / (c * left[at - 1] + d)
    for k in reversed(steps):
        at = first[: int(np.searchsorted(-blocks, -k, side="left"))] + k
        (a, b), (c, d) = product[:, :, at]
        right[at - 1] = (a * right[at] + c) / (b * right[at] + d)
    return left, right


def marginals(unary: np.ndarray, lengths: np.ndarray, pairs: np.ndarray, counts: bool = False, whole: bool = False):
    """P(toxic) of every token by forward-backward; with ``counts`` also expected tag pairs.

    Chains are cut at ``CHAIN`` tokens, or with ``whole`` are texts.
    """
    starts, sizes = _chains(lengths)
    result = np.empty(len(unary))
    if not len(starts):
        return (result, np.zeros((2, 2))) if counts else result
    order = np.argsort(-sizes, kind="stable")
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    starts, sizes = starts[order], sizes[order]
    longest = int(sizes[0])
    alive = np.searchsorted(-sizes, -np.arange(longest), side="left")
    # Messages as toxic-to-clean ratios; unary scores are bounded, so they cannot overflow.
    t = np.exp(pairs)
    u = np.exp(np.clip(unary, -25, 25))
    enter, leave = np.ones(len(starts)), np.ones(len(starts))
    if whole and (lengths > CHAIN).any():
        blocks = -(-lengths // CHAIN)
        blocks = blocks[blocks > 0]
        first = np.cumsum(blocks) - blocks
        lead = np.zeros(len(starts), bool)
        lead[place[first]] = True
        left, right = _carried(_block_products(u, starts, sizes, lead, t)[:, :, place], first, blocks)
        left, leave = left[order], right[order]
        enter = np.where(lead, 1.0, (t[0, 1] + left * t[1, 1]) / (t[0, 0] + left * t[1, 0]))
    ahead = np.ones((longest, len(starts)))
    behind = np.ones((longest, len(starts)))
    odds = np.ones((longest, len(starts)))
    for k in range(longest):
        n = alive[k]
        odds[k, :n] = u[starts[:n] + k]
        if k:
            r = ahead[k - 1, :n]
            ahead[k, :n] = odds[k, :n] * (t[0, 1] + r * t[1, 1]) / (t[0, 0] + r * t[1, 0])
        else:
            ahead[0] = odds[0] * enter
    behind[sizes - 1, np.arange(len(sizes))] = leave
    for k in range(longest - 2, -1, -1):
        n = alive[k + 1]
        r = odds[k + 1, :n] * behind[k + 1, :n]
        behind[k, :n] = (t[1, 0] + r * t[1, 1]) / (t[0, 0] + r * t[0, 1])
    expected = np.zeros((2, 2))
    for k in range(longest):
        n = alive[k]
        ratio = ahead[k, :n] * behind[k, :n]
        result[starts[:n] + k] = ratio / (1 + ratio)
        if counts and k + 1 < longest:
            m = alive[k + 1]
            a, b = ahead[k, :m], odds[k + 1, :m] * behind[k + 1, :m]
            joint = np.array([[np.full(m, t[0, 0]), t[0, 1] * b], [t[1, 0] * a, t[1, 1] * a * b]])
            expected += (joint / joint.sum(axis=(0, 1))).sum(axis=2)
    return (result, expected) if counts else result


def marking_features(toxic: list[list[str]], clean: list[list[str]]) -> set[str]:
    """Words and beginnings of words that mark toxic documents."""
    held = [Counter(f for doc in docs for f in {f for w in set(doc) for f in features(w)[:-2]}) for docs in (toxic, clean)]
    marks = set()
    for f, n in held[0].items():
        odds = np.log((n + 0.5) / (len(toxic) + 1)) - np.log((held[1][f] + 0.5) / (len(clean) + 1))
        if n >= LEAST_DOCUMENTS and odds >= LEAST_LOG_ODDS:
            marks.add(f)
    return marks


def train_field(docs: list[list[str]], tags: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Unary weights and pair weights by full-gradient steps scaled to each weight's history."""
    lengths = np.array([len(d) for d in docs])
    known = {w: np.array(_slots(w), np.int32) for d in docs for w in d}
    slots = np.array([known[w] for d in docs for w in d], np.int32).reshape(-1, 3 + len(PREFIXES))
    y = np.concatenate(tags) if tags else np.empty(0)
    starts, sizes = _chains(lengths)
    observed = np.zeros((2, 2))
    inner = np.ones(max(len(y) - 1, 0), bool)
    inner[(starts[1:] - 1)] = False
    np.add.at(observed, (y[:-1][inner].astype(int), y[1:][inner].astype(int)), 1)
    weights, pairs = np.full(_MASK + 1, 0.0), np.zeros((2, 2))
    seen_w, seen_p = np.full(_MASK + 1, 1e-8), np.full((2, 2), 1e-8)
    for _ in range(STEPS):
        p, expected = marginals(weights[slots].sum(axis=1), lengths, pairs, counts=True)
        slope = np.bincount(slots.ravel(), np.repeat(y - p, slots.shape[1]), minlength=_MASK + 1) - 0.05 * weights
        seen_w += slope**2
        weights += 0.7 * slope / np.sqrt(seen_w)
        slope = observed - expected - 0.05 * pairs
        seen_p += slope**2
        pairs += 0.3 * slope / np.sqrt(seen_p)
        pairs = np.clip(pairs, -6, 6)
    return weights, pairs


def _summary(p: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """For each text: 1, a damped sum of its marginals, its largest marginal."""
    out = np.zeros((len(lengths), 3))
    out[:, 0] = 1
    full = lengths > 0
    at = (np.cumsum(lengths) - lengths)[full]
    if full.any():
        out[full, 1] = np.log1p(np.add.reduceat(np.where(p > 0.2, p, 0.0), at))
        out[full, 2] = np.maximum.reduceat(p, at)
    return out


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted logistic regression by Newton steps."""
    beta = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(x.shape[1])
        beta += np.linalg.solve(h, x.T @ (weight * (y - p)) - 0.01 * beta)
    return beta


def fit_field(rows: list[tuple[list[str], int]]) -> tuple[np.ndarray, np.ndarray] | None:
    """Unary and pair weights from labelled documents' words."""
    toxic, clean = [d for d, l in rows if l], [d for d, l in rows if not l]
    if not toxic or not clean:
        return None
    marks = marking_features(toxic, clean)

    def tag(doc: list[str], label: int) -> np.ndarray:
        if not label:
            return np.zeros(len(doc))
        return np.array([any(f in marks for f in features(w)) for w in doc], float)

    chosen = [(d, 1) for d in toxic[:CHAIN_DOCUMENTS]] + [(d, 0) for d in clean[:CHAIN_DOCUMENTS]]
    return train_field([d for d, _ in chosen], [tag(d, l) for d, l in chosen])


def fit_document(rows: list[tuple[int, float, float]], prior: dict[int, int]) -> np.ndarray:
    """The document's score from ``(label, sum, maximum)``; ``prior`` counts the labels of the whole table."""
    x = np.array([(1, total, largest) for _, total, largest in rows], float)
    y = np.array([l for l, _, _ in rows], float)
    weight = np.where(y == 1, prior[1] / max((y == 1).sum(), 1), prior[0] / max((y == 0).sum(), 1))
    return _logistic(x, y, weight / weight.mean())


def sampled_words(text: str | None, doc_id: int) -> list[str]:
    """The words of at most ``SAMPLE_CHAINS`` chains of a text, chosen by a hash, in their order."""
    found = tokens(text)
    chains = range(0, len(found), CHAIN)
    if len(chains) <= SAMPLE_CHAINS:
        return found
    chosen = sorted(sorted(chains, key=lambda k: zlib.crc32(f"{doc_id}:{k}".encode()))[:SAMPLE_CHAINS])
    return [w for k in chosen for w in found[k : k + CHAIN]]


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0).to_pylist()
        words = ["\n".join(sampled_words(t, i)) for i, t in zip(ids, batch.column(1).to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.string()), batch.column(2)], names=["doc_id", "words", "label"])


def sample_labelled(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame | None, dict[int, int]]:
    """About ``SAMPLE_DOCUMENTS`` texts at most for each label, of any length, chosen by a hash of the identifier."""
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label"))
    prior = {r.label: r.n for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not (prior.get(0) and prior.get(1)):
        return None, prior
    share = F.when(F.col("label") == 1, SAMPLE_DOCUMENTS / prior[1]).otherwise(SAMPLE_DOCUMENTS / prior[0])
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) / F.lit(1_000_003)
    # About SAMPLE_DOCUMENTS rows of 12 bytes for each label, whatever the tables' sizes.
    chosen = known.where(place < share).select(F.col("doc_id").alias("of"), "label")
    texts = docs.join(F.broadcast(chosen), F.col("doc_id") == F.col("of"))
    # Of texts with one identifier always the same one is taken, whatever the order of rows.
    one = texts.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        F.min(F.struct(F.xxhash64("text").alias("place"), "text")).alias("one"), F.max("label").alias("label")
    )
    return stage(one.select("doc_id", "one.text", "label"), "toxicity-sample"), prior


class _Unary(dict):
    """Unary scores of words under the model of the current task."""

    key, weights = "", np.empty(0)

    def use(self, key: str, weights: np.ndarray) -> None:
        if key != self.key:
            self.clear()
            self.key, self.weights = key, weights
        claim(self)

    def __missing__(self, word: str) -> float:
        value = float(self.weights[_slots(word)].sum())
        if len(self) < REMEMBER_WORDS:
            self[word] = value
        return value


_unary = remembered(_Unary())


def _spans(text: str, p: np.ndarray) -> list[dict[str, int]]:
    """Neighbouring tokens above one half as spans of code points, end exclusive."""
    spans: list[dict[str, int]] = []
    previous = -2
    for i, m in enumerate(_TOKEN.finditer(text)):
        if p[i] > 0.5:
            if previous == i - 1:
                spans[-1]["end"] = m.end()
            else:
                spans.append({"start": m.start(), "end": m.end()})
            previous = i
    return spans


_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _summaries(field, key: str):
    """For each sampled text its label and what the document's score is made of, over the whole text."""

    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, pairs = field.value
        for batch in batches:
            _unary.use(key, weights)
            out = []
            for text in batch.column(1).to_pylist():
                found = tokens(text)
                p = marginals(np.array([_unary[w] for w in found], float), np.array([len(found)]), pairs, whole=True)
                out.append(_summary(p, np.array([len(found)]))[0])
            x = np.array(out).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([batch.column(2), pa.array(x[:, 1]), pa.array(x[:, 2])], names=["label", "total", "largest"])

    return summaries


def _scored(texts: list[str | None], field: Model | None, key: str) -> tuple[np.ndarray, list[list]]:
    """Score and toxic spans of each text."""
    scores = np.zeros(len(texts))
    spans: list[list] = [[] for _ in texts]
    if field is None:
        return scores, spans
    _unary.use(key, field.weights)
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and size < BATCH_CHARS:
            size += len(texts[end] or "") + 1
            end += 1
        found = [tokens(t) for t in texts[at:end]]
        lengths = np.array([len(f) for f in found])
        values = np.fromiter((_unary[w] for f in found for w in f), float, int(lengths.sum()))
        p = marginals(values, lengths, field.pairs, whole=True)
        scores[at:end] = 1 / (1 + np.exp(-_summary(p, lengths) @ field.document))
        first = np.cumsum(lengths) - lengths
        owners = np.repeat(np.arange(len(found)), lengths)
        for i in np.unique(owners[p > 0.5]):
            spans[at + i] = _spans(texts[at + i], p[first[i] : first[i] + lengths[i]])
        at = end
    return scores, spans


def _score(model, key: str):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, spans = _scored(batch.column(1).to_pylist(), model.value, key)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores), pa.array(spans, _SPAN)], names=["doc_id", "score", "spans"]
            )

    return score


def _keep(model, key: str, threshold: float):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, _ = _scored(batch.column("text").to_pylist(), model.value, key)
            yield batch.filter(pa.array(scores < threshold))

    return keep


def _fit(learn_from: DataFrame, labels: DataFrame) -> Model | None:
    texts, prior = sample_labelled(learn_from, labels)
    if texts is None:
        return None
    rows = texts.mapInArrow(_sampled, "doc_id bigint, words string, label int").collect()
    one: dict[str, str] = {}  # a word is held once, however many documents have it
    rows = sorted(rows, key=lambda r: zlib.crc32(str(r.doc_id).encode()))
    field = fit_field([([one.setdefault(w, w) for w in r.words.split("\n")] if r.words else [], r.label) for r in rows])
    if field is None:
        return None
    shared = learn_from.sparkSession.sparkContext.broadcast(field)
    whole = texts.mapInArrow(_summaries(shared, uuid.uuid4().hex), "label int, total double, largest double").collect()
    # In order, so that sums of floating numbers do not depend on partitions.
    return Model(*field, fit_document(sorted(tuple(r) for r in whole), prior))


def _model(docs: DataFrame, learn_from: DataFrame, labels: DataFrame):
    model = _fit(learn_from.select("doc_id", "text"), labels)
    return docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex


def score_toxicity(docs: DataFrame, learn_from: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, score, spans`` of every document, learnt from ``labels`` of ``learn_from``'s rows."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return texts.mapInArrow(
        _score(*_model(docs, learn_from, labels)),
        "doc_id bigint, score double, spans array<struct<start: bigint, end: bigint>>",
    )


def without_toxic(docs: DataFrame, learn_from: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is below ``threshold``. Moves no row."""
    return docs.mapInArrow(_keep(*_model(docs, learn_from, labels), threshold), docs.schema)
