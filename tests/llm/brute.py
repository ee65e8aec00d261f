"""Plain restatements of the operators, one text at a time."""

import hashlib
import re
from collections import Counter

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
PLAIN = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PII = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}

#: Nulls, empties, blanks, long texts, ties and repeats, used by many tests.
ODD = [
    (1, None), (2, ""), (3, " \t\n\n "), (4, "one"), (5, "One two\nthree  four\n"), (6, "Te " * 60), (7, "é" * 300 + " ünï " * 80),
    (8, "# | $ & <> " * 30), (9, "same line here\nsame line here\nSAME line here "), (10, "same line here"), (11, "x" * 70_000), (12, "a b c d e f g h i j " * 400),
]


def words(text, pattern=PLAIN, fold=False):
    text = text or ""
    return pattern.findall(text.translate(FOLD) if fold else text)


def rules(text):
    text = text or ""
    w = words(text)
    places = {}
    for i in range(len(w) - 2):
        places.setdefault(tuple(w[i : i + 3]), []).append(i)
    cover = {j for v in places.values() if len(v) > 1 for i in v for j in (i, i + 1, i + 2)}
    seen, repeats = set(), 0
    for line in text.split("\n"):
        if words(line):
            repeats += line in seen
            seen.add(line)
    failed = len(w) < 50 or 100 * len(cover) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), repeats, len(cover), failed


def lines(rows):
    """doc_id: (n_lines, n_dropped, kept text) of the line dedup."""
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(FOLD)
    holders = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 10:
                holders.setdefault(key(line), set()).add(i)
    out = {}
    for i, text in rows:
        all_ = (text or "").split("\n")
        stay = [x for x in all_ if len(holders.get(key(x), ())) < 2 or min(holders[key(x)]) == i]
        out[i] = len(all_), len(all_) - len(stay), "\n".join(stay)
    return out


def contamination(text, items):
    w = words(text, ALNUM, True)
    hit, found = set(), set()
    for item, t in items:
        v = words(t, ALNUM, True)
        size = min(10, len(v))
        wins = {tuple(v[i : i + size]) for i in range(len(v) - size + 1)} if size else set()
        for i in range(len(w) - size + 1 if size else 0):
            if tuple(w[i : i + size]) in wins:
                hit |= set(range(i, i + size))
                found.add(item)
    ids = ",".join(sorted(str(i) for i in found if i is not None))
    return len(w), len(hit), len({i for i in found if i is not None}), hashlib.sha256(ids.encode()).hexdigest()


def near_classes(rows, least=0.8):
    """doc_id: the smallest doc_id that links of alike texts lead to."""
    parent = {i: i for i, _ in rows}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    bags = []
    for i, text in rows:
        w = words(text, PLAIN, True)
        if w:
            bags.append((i, Counter(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4)))))
    for n, (i, a) in enumerate(bags):
        for j, b in bags[n + 1 :]:
            both = sum((a & b).values())
            if both >= least * (sum(a.values()) + sum(b.values()) - both):
                x, y = top(i), top(j)
                parent[max(x, y)] = min(x, y)
    return {i: top(i) for i, _ in rows}


def luhn(digits):
    d = [int(c) for c in digits][::-1]
    return (sum(d[0::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0


def pii(text):
    out = []
    for kind, pattern in PII.items():
        for m in pattern.finditer(text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": kind != "ip" or max(map(int, m[0].split("."))) <= 255, "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if good:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out
