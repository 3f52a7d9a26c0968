"""Plain Python versions of operators, for small inputs."""

import re
from collections import Counter, defaultdict

BLANKS = " \t\n\r\x0b\x0c"


def deduped_lines(texts):
    """Texts by id without later windows, and how many lines went."""
    seen, out, removed = set(), {}, {}
    for i in sorted(texts):
        lines = texts[i].split("\n")
        full = [(k, line.strip(BLANKS)) for k, line in enumerate(lines) if line.strip(BLANKS)]
        gone = set()
        for at in range(max(1, len(full) - 2) if full else 0):
            window = tuple(t for _, t in full[at:at + 3])
            if window in seen:
                gone.update(k for k, _ in full[at:at + 3])
            seen.add(window)
        removed[i] = len(gone)
        out[i] = "" if gone and len(gone) == len(full) else "\n".join(x for k, x in enumerate(lines) if k not in gone)
    return out, removed


def shingle_counts(text):
    ws = text.lower().split()
    size = min(5, len(ws))
    return Counter(tuple(ws[i:i + size]) for i in range(len(ws) - size + 1)) if ws else Counter()


def weighted_similarity(a, b):
    x, y = shingle_counts(a), shingle_counts(b)
    least = sum(min(n, y[k]) for k, n in x.items())
    greatest = sum(x.values()) + sum(y.values()) - least
    return least / greatest if greatest else 0.0


def near_classes(texts, least=0.8):
    """Least id of each text's class, by comparing all texts that share a run of words."""
    counts = {i: shingle_counts(t) for i, t in texts.items()}
    holders, parent = defaultdict(list), {i: i for i in texts}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in sorted(texts):
        shared = Counter()
        for run, n in counts[i].items():
            for j in holders[run]:
                shared[j] += min(n, counts[j][run])
            holders[run].append(i)
        for j, n in shared.items():
            if n >= least * (sum(counts[i].values()) + sum(counts[j].values()) - n) - 1e-9:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: root(i) for i in texts}


def plain_words(text):
    return [(m[0].lower() if m[0].isascii() else re.sub("[A-Z]", lambda c: c[0].lower(), m[0]), m.start(), m.end())
            for m in re.finditer(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)]


def hit_places(words, items, window=10):
    """Places of hit words, and the numbers of the items that are hit."""
    runs = defaultdict(set)
    for k, item in enumerate(items):
        ws = [w for w, _, _ in plain_words(item or "")]
        size = min(len(ws), window)
        for at in range(len(ws) - size + 1 if ws else 0):
            runs[tuple(ws[at:at + size])].add(k)
    places, hit = set(), set()
    for size in {len(r) for r in runs}:
        for at in range(len(words) - size + 1):
            found = runs.get(tuple(words[at:at + size]))
            if found:
                places.update(range(at, at + size))
                hit |= found
    return places, hit


def decontaminated(texts, items, most=0.5):
    out = {}
    for i, text in texts.items():
        words = plain_words(text)
        places, _ = hit_places([w for w, _, _ in words], items)
        if len(places) > most * len(words):
            continue
        kept, at, k = [], 0, 0
        while k < len(words):
            if k in places:
                kept.append(text[at:words[k][1]])
                while k + 1 in places:
                    k += 1
                at = words[k][2]
            k += 1
        out[i] = "".join([*kept, text[at:]])
    return out
