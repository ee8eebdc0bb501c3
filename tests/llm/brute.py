"""Plain versions of the operators, for small tables: (id, text) pairs in, dicts by id out."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def links(docs):
    """doc_id: (smallest id of its component, links)."""
    sets, having = {}, defaultdict(list)
    for i, text in docs:
        w = SPACED.findall(lower(text))
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
        for s in sets[i]:
            having[s].append(i)
    root, count = {i: i for i in sets}, Counter()

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, s in sets.items():
        for j, n in Counter(j for x in s for j in having[x] if j < i).items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                count[i] += 1
                count[j] += 1
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (find(i), count[i]) for i in sets}


def removed(docs, window=50):
    words = {i: SPACED.findall(t or "") for i, t in docs}
    first = {}
    for i in sorted(words):
        for k in range(len(words[i]) - window + 1):
            first.setdefault(tuple(words[i][k : k + window]), i)
    out = {}
    for i, w in words.items():
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < i:
                gone.update(range(k, k + window))
        out[i] = (len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def hits(docs, items, n=10):
    """doc_id: (words, hit places, items)."""
    grams = defaultdict(set)
    for item, text in items:
        w = PLAIN.findall(lower(text))
        for k in range(max(1, len(w) - n + 1)) if w else ():
            grams[tuple(w[k : k + n])].add(str(item))
    out = {}
    for i, text in docs:
        w, places, found = PLAIN.findall(lower(text)), set(), set()
        for size in {len(g) for g in grams}:
            for k in range(len(w) - size + 1):
                if ids := grams.get(tuple(w[k : k + size])):
                    places.update(range(k, k + size))
                    found |= ids
        out[i] = (len(w), places, found)
    return out


def quality(text):
    """(words, characters, symbols, repeated lines, repeated words, failed)."""
    text = text or ""
    w = SPACED.findall(text)
    windows = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
    repeated = {k + j for k in range(len(w) - 2) if windows[tuple(w[k : k + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if SPACED.search(x)]
    failed = len(w) < 50 or 100 * len(repeated) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated), failed


def phrases(text, known):
    """(words, [(place, label)]) of exact phrases."""
    w = PLAIN.findall(lower(text))
    found = []
    for phrase, label in known.items():
        p = phrase.split()
        found += [(k, label) for k in range(len(w) - len(p) + 1) if w[k : k + len(p)] == p]
    return len(w), sorted(found)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def near_spans(joined, notice, most, exact):
    """(start, end, edits) of all spans of whole words within ``most`` edits of the notice that
    hold its words of ``exact``."""
    text = np.frombuffer(f"{joined} ".encode("utf-32-le"), dtype="<u4")
    starts = np.flatnonzero(np.concatenate(([True], text[:-1] == 32)))
    # edits up to each place: free to start where a word starts, and nowhere else
    places = np.arange(len(text) + 1)
    row = np.minimum.accumulate(np.where(np.isin(places, starts), 0, 1 << 20) - places) + places
    for c in notice:
        step = np.concatenate(([row[0] + 1], np.minimum(row[1:] + 1, row[:-1] + (text != ord(c)))))
        row = np.minimum.accumulate(step - places) + places
    needed, out = exact & set(notice.split()), []
    for end in np.flatnonzero((row[:-1] <= most) & (text == 32)):
        for start in starts[(starts >= end - len(notice) - most) & (starts < end)]:
            span = joined[start:end]
            if needed <= set(span.split()) and (d := distance(span, notice)) <= most:
                out.append((int(start), int(end), d))
    return out


def notices(joined, known, edits, exact):
    """(notice, start, end, edits): all matches, those with the fewest edits first, then of the
    longest notice, each that overlaps none before it."""
    found = [(n, *m) for n, (notice, _) in enumerate(known) for m in near_spans(joined, notice, edits(notice), exact)]
    kept = []
    for m in sorted(found, key=lambda m: (m[3], -len(known[m[0]][0]), m[1])):
        if all(m[2] <= k[1] or k[2] <= m[1] for k in kept):
            kept.append(m)
    return kept
