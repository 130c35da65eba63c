"""Plain Python versions of the contracts, for small inputs."""

import hashlib
import re
from collections import Counter

BLANK = "[^\x20\x09-\x0D]+"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def base_secrets(text):
    text = text or ""
    assign = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
    found = [
        [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 6],
        [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20],
        [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24],
    ]
    listed = ",".join(f"{['assign', 'access', 'hex'][k]}:{a}:{b}" for a, k, b in sorted(sum(found, [])))
    return (*map(len, found), sha(listed), listed)


def surface(text):
    text = text or ""
    words = re.findall(BLANK, text)
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    times = Counter(windows)
    hit = {k + j for k, w in enumerate(windows) if times[w] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if re.search(BLANK, x)]
    failed = len(words) < 50 or 100 * len(hit) > 50 * len(words)
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return (len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(hit), failed)


def contaminated(text, items):
    split = lambda x: re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (x or "").translate(LOWER))
    words, hit, ids = split(text), set(), set()
    at = {}
    for k in range(len(words)):
        for n in range(1, 11):
            if k + n <= len(words):
                at.setdefault(tuple(words[k : k + n]), []).append(k)
    for item, content in items:
        w = split(content)
        for k in range(max(1, len(w) - 9) if w else 0):
            window = tuple(w[k : k + 10])
            for start in at.get(window, []):
                hit.update(range(start, start + len(window)))
                ids.add(str(item))
    return (len(words), len(hit), len(ids), sha(",".join(sorted(ids))), bool(hit))


def shingles(text):
    words = re.findall(BLANK, (text or "").translate(LOWER))
    return {tuple(words[k : k + 3]) for k in range(max(1, len(words) - 2))} if words else set()


def near_components(rows):
    """{doc_id: (set size, component)} of (doc_id, text) rows."""
    sets = [(i, shingles(t)) for i, t in rows]
    up = {i: i for i, _ in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            if x and y and 100 * len(x & y) >= 90 * len(x | y):
                up[max(root(i), root(j))] = min(root(i), root(j))
    return {i: (len(x), root(i)) for i, x in sets}


def repeats(rows, length=100):
    """{doc_id: (n_bytes, n_removed, n_spans, kept_sha256)} of (doc_id, text) rows."""
    seen, result = set(), {}
    for doc, text in sorted(rows):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for k in range(len(data) - length + 1):
            if data[k : k + length] in seen:
                gone[k : k + length] = b"\1" * length
            seen.add(data[k : k + length])
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        result[doc] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return result
