"""Personal data by weak supervision.

Base patterns find e-mail and network addresses, payment cards and telephone numbers. Beside
them, candidates are every other word with a digit, the word that follows a key word or holds
one and its value (``password: ...``, ``pwd=...``), telephone numbers without a sign, and names
and places of a gazetteer, a given name together with the capitalised words after it. Patterns,
gazetteers and the words around it vote on each candidate, for, against or not at all.
Expectation-maximisation estimates from the agreement of the votes alone how reliable each
labeler is and how likely each combination of votes is personal data; a logistic classifier on
the candidate's votes and shape is trained on these probabilities and decides. All candidates of
the corpus count: they are aggregated to combinations of votes and shapes, whose number does
not grow with the data. Names that the gazetteer lacks are found after a title or key word only.

Defined results: NULL text is the empty text; repeated rows are treated alike; without
candidates nothing is added; an empty table gives an empty result; other columns are not
looked at. Every pattern is matched in time linear in the text.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.gazetteer import GIVEN_NAMES, PLACES
from lakeloom.session import stage

KINDS = ("email", "ip", "card", "phone")
ADDED_KIND = "secret"
#: Words before a candidate that labelers look at.
CONTEXT_CHARS = 40
THRESHOLD = 0.5

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_NUMBERS = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]+")
_SPACE = frozenset(" \t\n\x0b\x0c\r")

Span = tuple[int, int]


def emails(text: str) -> list[Span]:
    found, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            found.append((start, done))
        at = text.find("@", max(at + 1, done))
    return found


def ips(text: str) -> list[Span]:
    found = []
    for chain in _NUMBERS.finditer(text):
        parts = chain.group().split(".")
        at = chain.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in four):
                found.append((at, end))
            at = end + 1
    return found


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else (2 * n - 9 if n > 4 else 2 * n)
    return total % 10 == 0


def cards(text: str) -> list[Span]:
    found = []
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = "".join(c for c in m.group() if c not in " -")
            if 13 <= len(digits) <= 19 and luhn(digits):
                found.append(m.span())
    return found


def phones(text: str) -> list[Span]:
    return [m.span() for m in _PHONE.finditer(text) if 9 <= sum("0" <= c <= "9" for c in m.group()) <= 15]


# Labelers. Each sees the candidate and the text before it: 1 for, 0 against, None no vote.
_KEY_WORDS = re.compile(
    r"(?i)pass(?:word|wd|wort|port|phrase)?|pwd|kennwort|mot de passe|contraseña|token|secret|api|key|bearer|auth|ssn|iban|account|pin\b"
)
# Key words whose next word is a candidate whatever it is made of.
_ANNOUNCES = re.compile(
    r"(?i)(?<![^\W_])(?:password|passwd|passwort|passphrase|passcode|pwd|kennwort|mot de passe|contraseña|token|secret"
    r"|(?:api|access|private)[ _-]?key|bearer|ssn|iban|pin|login|(?:user|full|first|last)[ _-]?name)(?![^\W_])"
)
_TITLE_WORDS = frozenset("Mr Mrs Ms Mme Dr Doña Herr Frau Señor Señora".split())
# One of them is in every text in which the pattern above finds something.
_SIGNS = ("pass", "pwd", "kennwort", "contraseña", "token", "secret", "key", "bearer", "ssn", "iban", "pin", "login", "name")
_TITLES = re.compile(r"(?<![^\W_])(?:M(?:rs?|s|me)|D(?:r|oña)|Herr|Frau|Señora?)(?![^\W_])")
_BETWEEN = re.compile(r"[\"']?\.?[ \t]{0,8}(?:(?:[:=]|is\b|ist\b|est\b|es\b)[ \t]{0,8})?")
_ASSIGNED = re.compile(r"[=:]\s{0,8}[\"']?$")
_TITLE = re.compile(r"(?i)(?<![^\W_])(?:mr|mrs|ms|dr|herr|frau|señora?|mme|doña|name)\b\.?(?: is| ist| est| es)?[ \t:=]{1,8}$")
_CAPITALISED = re.compile(r"(?<![^\W_])[^\W\d_a-zß-öø-ÿ][^\W\d_]+(?:[ \t][^\W\d_a-zß-öø-ÿ][^\W\d_]+){0,2}")
_RESIDENCE = re.compile(
    r"(?i)(?:\b(?:lives?|living|born|resid\w{1,5}) (?:in|at)|\baddress:?|\b[0-9]{5},?|\bwohnt in|\bgeboren in|\bhabite à|\bvive en)\s{1,8}$"
)
_PHONE_LIKE = re.compile(r"(?<![0-9])(?:\([0-9]{3}\) ?[0-9]{3}[.-][0-9]{4}|[0-9]{3}([.-])[0-9]{3}\1[0-9]{4})(?![0-9])")
_DATE = re.compile(
    r"[(\[\"']*(?:1[5-9]|20)[0-9]{2}(?:[/-](?:1[5-9]|20)[0-9]{2}|(?:[./-][0-9]{1,2}){1,2}|s)?[)\].,;:!?\"']*"
)
_PUBLIC_WORDS = re.compile(r"(?i)licen[sc]e|version|apache|gnu|mit\b|cc\b|copyright|chapter|section|page|figure|table|vol")
_VERSION = re.compile(r"[(\[\"']*v?[0-9]{1,3}(?:[.,:/-][0-9]{1,4}){0,3}[)\].,;:!?\"'%]*")
_ACCESS_KEY = re.compile(r"(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{20,}|sk-[0-9A-Za-z]{16,}")
_HEX = re.compile(r"[0-9a-f]{16,}|[0-9A-F]{16,}")


def _long_hex(word: str) -> bool:
    """Sixteen hexadecimal digits in a row, with a letter among them: a plain number is none."""
    return any(not m.group().isdigit() for m in _HEX.finditer(word))


_SSN = re.compile(r"(?<![0-9])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9])")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}[0-9A-Z]{11,30}")


def _mixture(word: str) -> int | None:
    """Letters and digits in many turns look drawn at random."""
    kinds = [c.isdigit() for c in word if c.isalnum()]
    if not any(kinds):
        return None
    turns = sum(a != b for a, b in zip(kinds, kinds[1:]))
    return 1 if turns >= 5 and len(kinds) >= 12 else 0 if turns <= 1 and len(kinds) < 8 else None


def _known(word: str) -> bool:
    return bool(_ACCESS_KEY.search(word) or _SSN.search(word) or _IBAN.search(word) or _PHONE_LIKE.search(word))


def _count(word: str) -> bool:
    return bool(_DATE.fullmatch(word) or _VERSION.fullmatch(word) and not _known(word))


#: The listed words, also in capitals, and what can be one.
_LISTED = frozenset(w for names in (GIVEN_NAMES, PLACES) for n in names for w in (n, n.upper()))
_CAPITALS = re.compile(r"[A-ZÀ-ÖØ-Þ][^\W\d_]+")


def _listed(word: str, names: frozenset[str]) -> bool:
    first = _LETTERS.search(word)
    return first is not None and (first.group() in names or first.group().isupper() and first.group().title() in names)


_LETTERS = re.compile(r"[^\W\d_]+")


def _person(word: str, before: str) -> int | None:
    return 1 if _listed(word, GIVEN_NAMES) or word[:1].isupper() and word.isalpha() and _TITLE.search(before) else None


def _place(word: str, before: str) -> int | None:
    """A place alone is public; where somebody lives is not."""
    return None if not _listed(word, PLACES) else 1 if _RESIDENCE.search(before) else 0


def _plain(word: str, before: str) -> int | None:
    """An ordinary word behind a key word: nothing is assigned and it is no name."""
    bare = word.strip("\"'().,;:!?")
    return 0 if (not bare or bare.isalpha()) and not _ASSIGNED.search(before) and _person(bare, before) is None else None


def _key_words(word: str, before: str) -> int | None:
    if _plain(word, before) == 0:
        return None
    return 1 if _KEY_WORDS.search(word) or _KEY_WORDS.search(before[-24:]) else None


LABELERS = (
    ("known pattern", lambda word, before: 1 if _known(word) else None),
    ("long hexadecimal", lambda word, before: 1 if _long_hex(word) else None),
    ("version, count or date", lambda word, before: 0 if _count(word) else None),
    ("key words", _key_words),
    ("public words", lambda word, before: 0 if _PUBLIC_WORDS.search(before) else None),
    ("random mixture", lambda word, before: _mixture(word)),
    ("assignment", lambda word, before: 1 if _ASSIGNED.search(before) or "=" in word else None),
    ("given names", _person),
    ("places", _place),
    ("plain word", _plain),
)


def votes_code(word: str, before: str) -> int:
    """All votes as one number in base 3 (0: none, 1: against, 2: for)."""
    code = 0
    for _, labeler in reversed(LABELERS):
        vote = labeler(word, before)
        code = code * 3 + (0 if vote is None else vote + 1)
    return code


def shape_bits(word: str) -> int:
    """What the final classifier sees, as bits."""
    letters, digits = sum(c.isalpha() for c in word), sum(c.isdigit() for c in word)
    n = len(word)
    bits = (
        n >= 8, n >= 14, n >= 20, digits * 2 > n, letters * 2 > n, 0 < letters and word.upper() == word,
        "=" in word, "@" in word, "." in word[:-1], word[:1] in "\"'", _long_hex(word), 0 < letters and digits >= 3,
    )
    return sum(1 << i for i, b in enumerate(bits) if b)


SHAPE_BITS = 12


def _seeds(text: str) -> list[Span]:
    """Where candidates begin and end, before they are widened to whole words."""
    found = [m.span() for m in _DIGITS.finditer(text)]
    if found:
        found += [m.span() for m in _PHONE_LIKE.finditer(text)]
    lower = text.lower()
    announced = list(_ANNOUNCES.finditer(text)) if any(s in lower for s in _SIGNS) else []
    capitals = set(_CAPITALS.findall(text))
    titles = () if _TITLE_WORDS.isdisjoint(capitals) else _TITLES.finditer(text)
    for m in itertools.chain(announced, titles):
        at = _BETWEEN.match(text, m.end()).end()
        if at < len(text) and text[at] not in _SPACE:
            # A value within the key word's own word takes that word whole.
            found.append((m.start() if at == m.end() or not any(c in _SPACE for c in text[m.end() : at]) else at, at + 1))
    for m in () if _LISTED.isdisjoint(capitals) else _CAPITALISED.finditer(text):
        # The given name or place may be any of the words that stand together.
        for w in _LETTERS.finditer(m.group()):
            if _listed(w.group(), GIVEN_NAMES):
                found.append((m.start() + w.start(), m.end()))
                break
            if _listed(w.group(), PLACES):
                found.append((m.start() + w.start(), m.start() + w.end()))
    return sorted(found, key=lambda s: (s[0], -s[1]))


def _candidates(text: str, taken: list[Span]) -> list[dict[str, int]]:
    """Candidates that touch no base span, each of whole words."""
    found, done = [], 0
    taken = sorted(taken)
    k = 0
    for start, end in _seeds(text):
        if start < done:
            continue
        while start > done and text[start - 1] not in _SPACE:
            start -= 1
        while end < len(text) and text[end] not in _SPACE:
            end += 1
        done = end
        while k < len(taken) and taken[k][1] <= start:
            k += 1
        if k < len(taken) and taken[k][0] < end:
            continue
        word, before = text[start:end], text[max(0, start - CONTEXT_CHARS) : start]
        found.append({"start": start, "end": end, "votes": votes_code(word, before), "shape": shape_bits(word)})
    return found


_FOUND = (
    "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, base string, "
    "candidates array<struct<start: bigint, end: bigint, votes: int, shape: int>>"
)
_CANDIDATES = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("votes", pa.int32()), ("shape", pa.int32())]))


def base_spans(text: str) -> list[list[Span]]:
    """Spans of each base kind; the searches are skipped where a sign they need is missing."""
    digit = _DIGITS.search(text) is not None
    return [
        emails(text) if "@" in text else [],
        ips(text) if digit else [],
        cards(text) if digit else [],
        phones(text) if "+" in text else [],
    ]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: list[list[int]] = [[] for _ in KINDS]
        listed, digests, candidates = [], [], []
        for text in batch.column(1).to_pylist():
            spans = base_spans(text or "")
            for column, own in zip(counts, spans):
                column.append(len(own))
            listed.append(",".join(f"{kind}:{a}:{b}" for kind, own in zip(KINDS, spans) for a, b in own))
            digests.append(hashlib.sha256(listed[-1].encode()).hexdigest())
            candidates.append(_candidates(text, [s for own in spans for s in own]) if text else [])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *[pa.array(c, pa.int64()) for c in counts], pa.array(digests), pa.array(listed), pa.array(candidates, _CANDIDATES)],
            names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "base", "candidates"],
        )


def vote_probabilities(votes: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """P(personal) of each combination of votes, and each labeler's P(vote | truth).

    ``votes`` has a row for each combination with 0 (none), 1 (against) or 2 (for). The first
    guess is the majority; labelers are taken as independent given the truth.
    """
    p = np.clip(0.5 + ((votes == 2).sum(axis=1) - (votes == 1).sum(axis=1)) * 0.2, 0.05, 0.95)
    rates = np.zeros((votes.shape[1], 2, 3))
    for _ in range(rounds):
        prior = np.clip((counts @ p) / counts.sum(), 1e-4, 1 - 1e-4)
        for truth, share in ((0, 1 - p), (1, p)):
            for vote in range(3):
                # Labelers are better than chance to begin with: a weak prior for the right vote.
                rates[:, truth, vote] = (counts * share) @ (votes == vote) + (2.0 if vote == truth + 1 else 0.5)
        rates /= rates.sum(axis=2, keepdims=True)
        # No labeler is worse than chance, also where the weak prior weighs more than few candidates.
        rates[:, 1, 1], rates[:, 0, 2] = np.minimum(rates[:, 1, 1], rates[:, 0, 1]), np.minimum(rates[:, 0, 2], rates[:, 1, 2])
        rates[:, :, 0] = 1 - rates[:, :, 1] - rates[:, :, 2]
        like = np.stack([np.log(rates[np.arange(votes.shape[1]), t, votes]).sum(axis=1) for t in (0, 1)])
        odds = np.log(prior) - np.log1p(-prior) + like[1] - like[0]
        p = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return p, rates


def _inputs(votes: np.ndarray, shapes: np.ndarray) -> np.ndarray:
    """What the classifier sees: 1, each labeler's vote against and for, the shape bits."""
    return np.c_[np.ones(len(shapes)), votes == 1, votes == 2, shapes[:, None] >> np.arange(SHAPE_BITS) & 1]


def vote_classifier(x: np.ndarray, p: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Weights of the logistic classifier on ``_inputs``.

    A combination weighs at least as much as one of 10,000 candidates, so the regularisation
    does not silence what is rare.
    """
    weight = np.maximum(counts / counts.sum() * min(counts.sum(), 10_000), 1)
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        h = (x * (weight * q * (1 - q))[:, None]).T @ x + 0.1 * np.eye(x.shape[1])
        beta += np.linalg.solve(h, x.T @ (weight * (p - q)) - 0.1 * beta)
    return beta


def accepted(table: list[tuple[int, int, int]], threshold: float = THRESHOLD) -> list[tuple[int, int]]:
    """``(votes, shape)`` that count as personal data, from ``(votes, shape, candidates)`` of the corpus."""
    if not table:
        return []
    codes, shapes, counts = np.array(table, np.int64).T
    votes = codes[:, None] // 3 ** np.arange(len(LABELERS)) % 3
    p, _ = vote_probabilities(votes, counts.astype(float))
    x = _inputs(votes, shapes)
    score = 1 / (1 + np.exp(-np.clip(x @ vote_classifier(x, p, counts.astype(float)), -30, 30)))
    return [(int(c), int(s)) for c, s, v in zip(codes, shapes, score) if v >= threshold]


def find_personal_data(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, counts of the base kinds and of added spans, ``base_sha256`` and all ``spans``."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    found = stage(texts.mapInArrow(_scan, _FOUND), "personal-data")
    each = found.select(F.explode("candidates").alias("c")).groupBy("c.votes", "c.shape").agg(F.count("*").alias("n"))
    # At most 3^labelers * 2^bits rows; in practice some hundreds.
    table = sorted((r.votes, r.shape, r.n) for r in each.collect())
    keys = [(v << SHAPE_BITS) + s for v, s in accepted(table, threshold)]
    added = F.filter("candidates", lambda c: (F.shiftleft(c["votes"].cast("bigint"), SHAPE_BITS) + c["shape"]).isin(keys))
    names = F.transform(added, lambda c: F.concat_ws(":", F.lit(ADDED_KIND), c["start"], c["end"]))
    every = F.filter(F.array_prepend(names, F.col("base")), lambda s: s != "")
    n_added = F.size(added).cast("bigint").alias(f"n_{ADDED_KIND}")
    return found.select("doc_id", *[f"n_{k}" for k in KINDS], n_added, "base_sha256", F.array_join(every, ",").alias("spans"))
