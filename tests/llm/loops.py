"""The rules of the operators as plain loops."""

from __future__ import annotations

import re
import zlib
from collections import Counter

UPPER = {k: k + 32 for k in range(65, 91)}


def lowered(text):
    return (text or "").translate(UPPER)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text, size):
    own = words(lowered(text))
    return {tuple(own[k : k + size]) for k in range(max(1, len(own) - size + 1))} if own else set()


def components(texts, size, percent):
    """doc_id -> smallest doc_id reachable; texts: doc_id -> text."""
    sets = {d: shingles(t, size) for d, t in texts.items()}
    root = {d: d for d in sets}
    ids = sorted(sets)

    def of(d):
        while root[d] != d:
            d = root[d]
        return d

    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = of(a), of(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), of(d)) for d in ids}


def link_counts(rows, size, percent):
    """(doc_id, links) of every row; rows: (doc_id, text). Rows without identifier or words have none."""
    sets = [(d, shingles(t, size)) for d, t in rows]
    linked = lambda a, b: 100 * len(a & b) >= percent * len(a | b)
    found = []
    for i, (d, own) in enumerate(sets):
        others = [s for k, (e, s) in enumerate(sets) if k != i and e is not None and s]
        found.append((d, sum(linked(own, s) for s in others) if own and d is not None else 0))
    return found


def quality_counts(text):
    own = words(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    windows = [tuple(own[k : k + 8]) for k in range(len(own) - 7)]
    times = Counter(windows)
    covered = set()
    for k, window in enumerate(windows):
        if times[window] > 1:
            covered.update(range(k, k + 8))
    return len(own), sum(map(len, own)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def personal_spans(text):
    only = lambda m: re.sub("[^0-9]", "", m)
    kinds = (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(only(m)) <= 19 and luhn(only(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(only(m)) <= 15),
    )
    found = []
    for k, (kind, pattern, check) in enumerate(kinds):
        found += [(m.start(), k, m.end(), kind) for m in re.finditer(pattern, text or "") if check(m.group())]
    return [f"{kind}:{start}:{end}" for start, _, end, kind in sorted(found)]


def without_repeats(texts, least_sentences, least_words):
    """doc_id -> text without the sentences of repeated spans; texts: doc_id -> text."""
    cut = {d: re.findall(r"(?s).+?(?:[.!?](?=\s)|\n|\Z)\s*|\s+", t or "") for d, t in texts.items()}
    first, spans = {}, []
    for d in sorted(cut):
        plain = [" ".join(words(lowered(s))) for s in cut[d]]
        worded = [k for k, s in enumerate(plain) if s]
        for i in range(len(worded)):
            for j in range(i + least_sentences, len(worded) + 1):
                if sum(len(plain[k].split(" ")) for k in worded[i:j]) >= least_words:
                    key = tuple(plain[k] for k in worded[i:j])
                    spans.append((d, worded[i], worded[j - 1], first.setdefault(key, (d, worded[i]))))
                    break
    gone = {(d, k) for d, low, high, where in spans if where != (d, low) for k in range(low, high + 1)}
    return {d: "".join(s for k, s in enumerate(own) if (d, k) not in gone) for d, own in cut.items()}


def is_training(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 10 != 0
