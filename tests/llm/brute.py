"""Plain versions of the operators over dicts of texts."""

import hashlib
import re
from collections import Counter

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACE = " \t\n\x0b\x0c\r"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def statistics(text):
    own, text = words(text), text or ""
    triples = Counter(zip(own, own[1:], own[2:]))
    covered = {j for i in range(len(own) - 2) if triples[tuple(own[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [line for line in text.split("\n") if words(line)]
    return len(own), sum(map(len, own)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def line_dedup(texts):
    def key(line):
        return line.strip(SPACE).translate(LOWER)

    holders = {}
    for doc_id, text in texts.items():
        for line in (text or "").split("\n"):
            holders.setdefault(key(line), set()).add(doc_id)
    result = {}
    for doc_id, text in texts.items():
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 10 or len(holders[key(x)]) < 2 or min(holders[key(x)]) == doc_id]
        result[doc_id] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return result


def shingles(text):
    own = words((text or "").translate(LOWER))
    if len(own) < 5:
        return frozenset([tuple(own)]) if own else frozenset()
    return frozenset(tuple(own[i : i + 5]) for i in range(len(own) - 4))


def near_duplicates(texts, percent=85):
    sets = {doc_id: shingles(text) for doc_id, text in texts.items()}
    root = {doc_id: doc_id for doc_id in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {doc_id: (len(sets[doc_id]), find(doc_id)) for doc_id in sets}


def substring_dedup(texts, window=50):
    first, result = {}, {}
    for doc_id in sorted(texts):
        own = words(texts[doc_id])
        keys = [tuple(own[i : i + window]) for i in range(len(own) - window + 1)]
        gone = {j for i, key in enumerate(keys) if first.get(key, doc_id) < doc_id for j in range(i, i + window)}
        for key in keys:
            first.setdefault(key, doc_id)
        result[doc_id] = (len(own), len(gone), " ".join(w for i, w in enumerate(own) if i not in gone))
    return result


def base_spans(text):
    found = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(part) <= 255 for part in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        checksum = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(digits[::-1]))
        if 14 <= len(digits) <= 19 and checksum % 10 == 0:
            found.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)
