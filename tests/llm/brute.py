"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter
from itertools import combinations

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text: str | None) -> dict[str, int]:
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    inside = {i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(inside),
    }


def lower(text: str | None) -> list[str]:
    return [w.translate({c: c + 32 for c in range(65, 91)}) for w in WORD.findall(text or "")]


def shingles(text: str | None, size: int) -> set[tuple[str, ...]]:
    words = lower(text)
    if not words:
        return set()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}


def near_components(docs: list[tuple[int, str | None]], size: int, percent: int = 80) -> dict[int, int]:
    sets = [(d, shingles(t, size)) for d, t in docs]
    root = {d: d for d, _ in docs}

    def find(x: int) -> int:
        while root[x] != x:
            x = root[x]
        return x

    for (a, x), (b, y) in combinations(sets, 2):
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            p, q = find(a), find(b)
            root[max(p, q)] = min(p, q)
    return {d: find(d) for d, _ in docs}


def cut_bytes(docs: list[tuple[int, str | None]], length: int = 50) -> dict[int, tuple[int, int, int, str]]:
    data = {d: (t or "").encode() for d, t in docs}
    first: dict[bytes, int] = {}
    for d in sorted(data):
        for p in range(len(data[d]) - length + 1):
            first.setdefault(data[d][p : p + length], d)
    out = {}
    for d, x in data.items():
        gone = {p + k for p in range(len(x) - length + 1) if first[x[p : p + length]] < d for k in range(length)}
        spans = sum(b - 1 not in gone for b in gone)
        kept = bytes(c for i, c in enumerate(x) if i not in gone)
        out[d] = (len(x), len(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def edits(a: list[str], b: list[str]) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def clean_lines(docs: list[tuple[int, str | None]], least: int = 5) -> dict[int, list[int]]:
    """Numbers of the removed lines by document."""
    lines = [
        (d, n, WORD.findall(x)) for d, t in sorted(docs, key=lambda r: r[0]) for n, x in enumerate((t or "").split("\n"))
    ]
    lines = [x for x in lines if x[2]]
    out: dict[int, list[int]] = {d: [] for d, _ in docs}
    for i, (d, n, words) in enumerate(lines):
        for _, _, w in lines[:i]:
            both = min(len(w), len(words)) >= least
            if w == words or both and abs(len(w) - len(words)) <= 1 and edits(w, words) <= 1:
                out[d].append(n)
                break
    return out


def overlaps(text: str | None, item: str, span: int, replaced: int, tolerance) -> bool:
    a, b = (WORD.findall((t or "").lower()) for t in (text, item))
    for diagonal in range(-len(b), len(a)):
        ahead, behind = max(diagonal, 0), max(-diagonal, 0)
        n = min(len(a) - ahead, len(b) - behind)
        same = [a[ahead + k] == b[behind + k] for k in range(max(n, 0))]
        if n < span and n >= 8 and n in (len(a), len(b)) and sum(same) >= n - tolerance(n):
            return True
        if n < span <= len(b) and sum(same) >= span - replaced:
            return True
        if any(sum(same[k : k + span]) >= span - replaced for k in range(n - span + 1)):
            return True
    return False


def terms(text: str | None) -> list[str]:
    found = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")
    return [t.translate({c: c + 32 for c in range(65, 91)}) for t in found]


def search(docs: list[tuple[int, str | None]], items: list[tuple[int, str | None]], top: int = 10) -> list[tuple]:
    """Rows of (item, rank, document, score), every document scored against every item."""
    counted = [(d, Counter(terms(t))) for d, t in docs]
    counted = [(d, c) for d, c in counted if c]
    n, total = len(counted), sum(sum(c.values()) for _, c in counted)
    held = Counter(t for _, c in counted for t in c)
    wanted: dict[int, set[str]] = {}
    for item, text in items:
        if item is not None and text is not None:
            wanted.setdefault(item, set()).update(terms(text))
    rows = []
    for item, words in wanted.items():
        scores = []
        for d, c in counted:
            m = 10 + (90 * sum(c.values()) * n) // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * held[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                for t in words
                if c[t]
            )
            if score > 0 and d is not None:
                scores.append((-score, d))
        rows += [(item, k + 1, d, -s) for k, (s, d) in enumerate(sorted(scores)[:top])]
    return sorted(rows)


def damaged(rows: list[tuple]) -> list[tuple]:
    """Rows of (conv, turn, role, text) after the planted damage."""
    out = []
    for conv, turn, role, text in rows:
        shown = [" " if v is None else str(v) for v in (conv, turn)]
        kind = zlib.crc32(":".join(shown).encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def repaired(rows: list[tuple]) -> dict:
    """Report of one conversation's rows of (turn, role, text), by trying every state with its whole audit."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
    seen, faults = set(), []
    for _, role, text in rows:
        words = re.sub(r"[\x20\x09-\x0D]", "", text)
        late = (role, text) in seen
        seen.add((role, text))
        faults.append("blank" if not words else "duplicate" if late else "" if words[-1] in ".!?" else "truncated")
    turns = {t for t, _, _ in rows if t is not None}
    initials = [role[:1] for _, role, _ in rows]
    report = {
        "gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")},
    }

    def inserted(best: dict) -> dict:
        for _ in range(3):
            for seq, (cost, audit, text) in list(best.items()):
                for letter, role in (("u", "user"), ("a", "assistant")):
                    if letter == "u" and seq in ("", "s", "a") or letter == "a" and seq == "u":
                        found = (cost + 3, audit + "I", [*text, f"{role}:"])
                        if letter not in best or found[:2] < best[letter][:2]:
                            best[letter] = found
        return best

    best = {"": (0, "", [])}
    for (_, role, text), fault in zip(rows, faults):
        best, following = inserted(best), {}

        def offer(seq: str, cost: int, audit: str, lines: list[str]) -> None:
            if seq not in following or (cost, audit) < following[seq][:2]:
                following[seq] = (cost, audit, lines)

        for seq, (cost, audit, lines) in best.items():
            offer(seq, cost + 4, audit + "D", lines)
            if fault in ("blank", "duplicate"):
                continue
            more = cost + 3 * (fault == "truncated")
            fits = {"s": seq == "", "u": seq in ("", "s", "a"), "a": seq == "u"}
            if fits.get(role[:1], False):
                offer(role[:1], more, audit + "K", [*lines, f"{role}:{text}"])
            for letter, name in (("u", "user"), ("a", "assistant")):
                if fits[letter]:
                    offer(letter, more + 3, audit + "R", [*lines, f"{name}:{text}"])
        best = following
    best = inserted(best)
    cost, audit, lines = min(v for k, v in best.items() if k in ("", "a"))
    return report | {"cost": cost, "audit": audit, "lines": lines, "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest()}


def mix_targets(sizes: dict, weights: tuple = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> dict:
    """Targets by source, the excess dealt out again and again."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full: set = set()
    while True:
        left = share * sum(sizes.values()) - sum(most * sizes[s] for s in full)
        free = sum(weight[s] for s in names if s not in full)
        target = {s: most * sizes[s] if s in full else left / free * weight[s] for s in names}
        above = {s for s in names if target[s] > most * sizes[s]} | full
        if above == full:
            return target
        full = above
