"""Plain versions of the operators, one row at a time, to hold their results against."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def shingle_set(text: str | None, words: int) -> set[tuple[str, ...]]:
    found = WORD.findall(lower(text or ""))
    if not found:
        return set()
    width = min(words, len(found))
    return {tuple(found[i : i + width]) for i in range(len(found) - width + 1)}


def components(nodes, links) -> dict[int, int]:
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def near_rows(rows, words: int, percent: int) -> list[tuple]:
    """(doc_id, size of the set, component) of every row, rows of one id being one document."""
    sets = [shingle_set(t, words) for _, t in rows]
    links = [(a, b) for a in range(len(rows)) for b in range(a) if None not in (rows[a][0], rows[b][0]) and (
        rows[a][0] == rows[b][0] or sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]))]
    found = components(range(len(rows)), links)
    least = {}
    for (i, _), c in zip(rows, (found[k] for k in range(len(rows)))):
        least[c] = i if i is None else min(i, least.get(c, i))
    return [(i, len(s), least[found[k]]) for k, ((i, _), s) in enumerate(zip(rows, sets))]


def near_duplicates(rows, words: int, percent: int) -> dict[int, tuple[int, int]]:
    """doc_id -> (size of the set, component) by comparing all pairs that share a shingle."""
    sets = {i: shingle_set(t, words) for i, t in rows}
    holders: dict[tuple, list[int]] = {}
    for i, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(i)
    links, tried = [], set()
    for held in holders.values():
        for k, a in enumerate(held):
            for b in held[:k]:
                if (a, b) not in tried:
                    tried.add((a, b))
                    both = len(sets[a] & sets[b])
                    if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                        links.append((a, b))
    found = components(sets, links)
    return {i: (len(s), found[i]) for i, s in sets.items()}


def remove_repeats(rows, length: int = 200) -> list[tuple]:
    """(id, bytes, removed, runs, rest) of each row, from counts of all strings of that length."""
    counts: dict[bytes, int] = {}
    raws = [(i, (t or "").encode()) for i, t in rows]
    for _, raw in raws:
        for at in range(len(raw) - length + 1):
            piece = hash(raw[at : at + length])
            counts[piece] = counts.get(piece, 0) + 1
    out = []
    for i, raw in raws:
        gone = bytearray(len(raw))
        for at in range(len(raw) - length + 1):
            if counts[hash(raw[at : at + length])] > 1:
                gone[at : at + length] = b"\x01" * length
        rest = bytes(b for b, g in zip(raw, gone) if not g)
        runs = sum(g and not before for g, before in zip(gone, b"\x00" + gone))
        out.append((i, len(raw), sum(gone), runs, rest))
    return out


RUN = re.compile(r"[A-Za-zÀ-ÿ]+")


def spelling(rows) -> dict[str, tuple]:
    """word -> (n, near words, form, its n, root): near words by deleting each code point."""
    counts: Counter[str] = Counter()
    for i, text in rows:
        for run in map(lower, RUN.findall(text or "")):
            mark = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            at = mark % len(run)
            counts[run[:at] + run[at + 1 :] if mark % 199 == 0 else run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    gaps, near = defaultdict(set), defaultdict(set)
    for w in words:
        for k in range(len(w)):
            shorter = w[:k] + w[k + 1 :]
            gaps[k, shorter].add(w)
            if shorter in words:
                near[w].add(shorter)
                near[shorter].add(w)
    for held in gaps.values():
        for w in held:
            near[w] |= held - {w}
    best = {w: min(v, key=lambda x: (-words[x], x)) for w, v in near.items() if v}
    form = {w: b for w, b in best.items() if words[b] >= 5 * words[w]}
    out = {}
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out[w] = (n, len(near[w]), form.get(w), words.get(form.get(w)), root)
    return out


def prefix_trie(rows) -> dict[tuple, tuple]:
    """(smallest member, depth) -> the other columns, from the set of all prefixes."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v, key=lambda t: t[:2])] for c, v in turns.items()}
    rebuilt = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = tuple(own.get(c - c % 20, [])[:h] + v[h:])
    members, below = defaultdict(list), defaultdict(list)
    for c, s in rebuilt.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    for s in members:
        if s:
            below[s[:-1]].append(s)
    out, leaves, saved = {}, {}, {}
    for s in sorted(members, key=len, reverse=True):
        leaves[s] = sum(leaves[k] for k in below[s]) if below[s] else 1
        words = len(WORD.findall(s[-1][1])) if s else 0
        saved[s] = sum(saved[k] for k in below[s]) + (len(members[s]) - 1) * words
        ends = ",".join(str(c) for c in sorted(members[s]) if len(rebuilt[c]) == len(s))
        out[min(members[s]), len(s)] = (
            min(members[s[:-1]]) if s else None, len(members[s]), len(below[s]), leaves[s], saved[s], hashlib.sha256(ends.encode()).hexdigest()
        )
    return out


def repetition(words: list, least: int) -> tuple[int, int, int, int]:
    """Words in repeated windows of five, maximal repeats, words under them, words of the longest, by definition."""
    n, found, longest = len(words), 0, 0

    def places(width: int) -> list[list[int]]:
        held = defaultdict(list)
        for at in range(n - width + 1):
            held[tuple(words[at : at + width])].append(at)
        return [v for v in held.values() if len(v) > 1]

    def under(width: int) -> int:
        return len({at + k for v in places(width) for at in v for k in range(width)})

    for width in range(least, n):
        for held in places(width):
            left = {words[at - 1] if at else None for at in held}
            right = {words[at + width] if at + width < n else None for at in held}
            if len(left) > 1 and len(right) > 1:
                found, longest = found + 1, width
    return under(5), found, under(least), longest
