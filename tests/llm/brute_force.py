"""Slow, plain versions of operators that SQL cannot express."""

from __future__ import annotations

import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower_ascii(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def shingles(text: str | None) -> set[tuple[str, ...]]:
    words = WORD.findall(lower_ascii(text or ""))
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def jaccard_components(rows: list[tuple]) -> list[tuple]:
    """(doc_id, n_shingles, component_id) by comparing every pair that shares a shingle."""
    sets = [shingles(text) for _, text in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    seen = set()
    for i, s in enumerate(sets):
        for j in {j for x in s for j in holders[x] if j < i}:
            if (i, j) not in seen:
                seen.add((i, j))
                both = len(s & sets[j])
                if 100 * both >= 75 * (len(s) + len(sets[j]) - both):
                    parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    return sorted((rows[i][0], len(sets[i]), least[root(i)]) for i in range(len(rows)))


def base_counts(text: str | None) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    words = WORD.findall(text)
    windows = defaultdict(list)
    for i in range(len(words) - 2):
        windows[tuple(words[i : i + 3])].append(i)
    repeated = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(repeated),
        len(words) < 50 or 100 * len(repeated) > 50 * len(words),
    )


def base_spans(text: str | None) -> list[list[tuple[int, int]]]:
    """E-mail, ip, card and phone spans by the plain patterns."""

    def luhn(digits: str) -> bool:
        doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        return sum(d // 10 + d % 10 for d in doubled) % 10 == 0

    text = text or ""
    find = lambda pattern: [m for m in re.finditer(pattern, text)]
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    email = find(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    ip = [m for m in find(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)") if all(int(p) <= 255 for p in m.group().split("."))]
    card = [m for m in find(r"[0-9]([\x20-]?[0-9])+") if 13 <= len(digits(m)) <= 19 and luhn(digits(m))]
    phone = [m for m in find(r"\+[0-9][\x20().0-9-]+[0-9]") if 9 <= len(digits(m)) <= 15]
    return [[m.span() for m in kind] for kind in (email, ip, card, phone)]
