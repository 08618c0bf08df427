"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


def repeats(docs: list[tuple], length: int = 400) -> list[tuple]:
    raw = [(i, (t or "").encode()) for i, t in docs]
    seen = Counter(t[p : p + length] for _, t in raw for p in range(len(t) - length + 1))
    out = []
    for i, t in raw:
        gone = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if seen[t[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(1 for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def shingles(text: str | None) -> frozenset:
    w = WORD.findall(lower(text or ""))
    return frozenset(zip(w, w[1:])) if len(w) > 1 else frozenset([tuple(w)] if w else [])


def near(docs: list[tuple]) -> dict:
    """doc_id -> (n_shingles, component_id)."""
    sets = [(i, shingles(t)) for i, t in docs]
    of = {i: i for i, _ in sets}

    def root(i):
        while of[i] != i:
            i = of[i]
        return i

    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            if s and t and 100 * len(s & t) >= 80 * len(s | t):
                x, y = root(i), root(j)
                of[max(x, y)] = min(x, y)
    return {i: (len(s), root(i)) for i, s in sets}

KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(digits: str) -> bool:
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def base_spans(text: str | None) -> list[tuple]:
    """(start, kind's number, end) of the base spans."""
    out = []
    for k, (kind, pattern) in enumerate(KINDS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and _luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), k, m.end()))
    return sorted(out)

WORD7 = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def contamination(docs: list[tuple], items: list[tuple], window: int = 13) -> list[tuple]:
    """(doc_id, n_words, n_hit, item ids)."""
    grams: dict = {}
    for item, text in items:
        w = WORD7.findall(lower(text or ""))
        k = min(window, len(w))
        for s in range(len(w) - k + 1 if k else 0):
            grams.setdefault((k, tuple(w[s : s + k])), set()).add(str(item))
    out = []
    for i, text in docs:
        w = WORD7.findall(lower(text or ""))
        hit, found = set(), set()
        for k in {k for k, _ in grams}:
            for s in range(len(w) - k + 1):
                if own := grams.get((k, tuple(w[s : s + k]))):
                    hit |= set(range(s, s + k))
                    found |= own
        out.append((i, len(w), len(hit), sorted(found)))
    return out


def quality(text: str | None) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = Counter(zip(w, w[1:], w[2:]))
    covered = {j for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def url_rule(url: str | None, rules: list[tuple]) -> tuple:
    """(host, path, rule, verdict) by the given rules."""
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match("[^/?#]*", rest).group()
        path = re.match("[^?#]*", rest[len(host) :]).group()
        host = lower(host)
    best = (None, None)
    for verdict, rule in rules:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and len(rule) > len(best[0] or ""):
            best = (rule, verdict)
    return host, path, *best


def allocate(leaves: dict, mixture, budget: int) -> dict:
    """Tokens for each leaf, from the tokens that leaves (paths of one length) hold."""
    room: dict = {}
    for path, tokens in leaves.items():
        for k in range(len(path) + 1):
            room[path[:k]] = room.get(path[:k], 0) + tokens * mixture.max_epochs
    children: dict = {}
    for path in room:
        if path:
            children.setdefault(path[:-1], []).append(path)
    out: dict = {}

    def give(node: tuple, amount: int) -> None:
        if node not in children:
            out[node] = amount
            return
        open_, share = sorted(children[node]), {}
        while open_:
            total = sum(mixture.weights.get(c, 1) for c in open_)
            full = [c for c in open_ if room[c] * total <= amount * mixture.weights.get(c, 1)] if total else []
            if not full:
                share |= {c: amount * mixture.weights.get(c, 1) // total if total else 0 for c in open_}
                break
            for c in full:
                share[c] = room[c]
                amount -= room[c]
            open_ = [c for c in open_ if c not in full]
        for c, own in share.items():
            give(c, own)

    if () in room:
        give((), min(budget, room[()]))
    return out
