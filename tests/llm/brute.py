"""Plain versions of some operators, on all pairs or with dictionaries."""

import collections
import re

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def shingle_set(text):
    words = WORD.findall((text or "").encode().lower())
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)])


def classes(rows):
    """(doc_id, n_shingles, component_id, kept) by comparing every pair."""
    sets = [(i, shingle_set(t)) for i, t in rows]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for k, (i, s) in enumerate(sets):
        for j, u in sets[:k]:
            if i is not None and j is not None and s and u and 4 * len(s & u) >= 3 * len(s | u):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return [(i, len(s), None if i is None else find(i), i is None or find(i) == i) for i, s in sets]


def components(edges):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    return {n: find(n) for n in list(parent)}


def measures(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    at = collections.defaultdict(list)
    for i in range(len(words) - 7):
        at[tuple(words[i : i + 8])].append(i)
    covered = {i + k for starts in at.values() if len(starts) > 1 for i in starts for k in range(8)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)
