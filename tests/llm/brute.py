"""Plain versions of the contracts, for small inputs."""

from __future__ import annotations

import base64
import hashlib
import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BENCH_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = {i: i + 32 for i in range(65, 91)}


def sha(x: str | bytes) -> str:
    return hashlib.sha256(x.encode() if isinstance(x, str) else x).hexdigest()


def repeats(docs, length=50):
    """[(doc_id, n_bytes, n_removed, n_spans, sha)]"""
    first = {}
    raw = [(d, (t or "").encode()) for d, t in docs]
    for d, x in raw:
        if d is None:
            continue
        for i in range(len(x) - length + 1):
            w = x[i : i + length]
            if w not in first or d < first[w]:
                first[w] = d
    out = []
    for d, x in raw:
        gone = bytearray(len(x))
        if d is not None:
            for i in range(len(x) - length + 1):
                if first[x[i : i + length]] < d:
                    gone[i : i + length] = b"\1" * length
        spans = sum(1 for i in range(len(x)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((d, len(x), sum(gone), spans, sha(bytes(c for c, g in zip(x, gone, strict=True) if not g))))
    return out


def secrets(text):
    """(counts of assign, access, hex; base spans as text)"""
    text = text or ""
    letters = lambda w: "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w)
    words = "|".join([*map(letters, ("password", "passwd", "secret", "token")), letters("api") + "_?" + letters("key")])
    assign = [m.span() for m in re.finditer(rf"""({words})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[2]) >= 12]
    access = [m.span() for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    hexes = [m.span() for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    spans = sorted((a, k, b) for k, own in enumerate((assign, access, hexes)) for a, b in own)
    return len(assign), len(access), len(hexes), ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in spans)


def url(u, rules):
    if u is None or "://" not in u:
        return "", "", None
    rest = u.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = host.translate(LOW)
    fit = [r for r, _ in rules if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/") :])]
    return host, path, max(fit, key=len) if fit else None


def quality(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    seen = defaultdict(list)
    for i in range(len(words) - 2):
        seen[tuple(words[i : i + 3])].append(i)
    hit = {p + j for at in seen.values() if len(at) > 1 for p in at for j in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit)


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def shingles(text, k):
    words = (text or "").translate(LOW)
    words = WORD.findall(words)
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} or ({tuple(words)} if words else set())


def near(docs, k, percent=80):
    """{index: (n, component doc_id)} by comparing all pairs."""
    sets = [shingles(t, k) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[find(i)].append(d)
    return [(d, len(sets[i]), min(least[find(i)], default=None)) for i, (d, _) in enumerate(docs)]


def decontaminate(docs, items):
    """[(doc_id, n_words, n_hit, n_items, sha, contaminated)]"""
    windows = defaultdict(set)
    for i, t in items:
        w = BENCH_WORD.findall((t or "").translate(LOW))
        m = min(10, len(w))
        for a in range(len(w) - m + 1 if m else 0):
            windows[tuple(w[a : a + m])].add(i)
    sizes = sorted({len(w) for w in windows})
    out = []
    for d, t in docs:
        w = BENCH_WORD.findall((t or "").translate(LOW))
        hit, ids = set(), set()
        for m in sizes:
            for a in range(len(w) - m + 1):
                if tuple(w[a : a + m]) in windows:
                    hit |= set(range(a, a + m))
                    ids |= windows[tuple(w[a : a + m])]
        out.append((d, len(w), len(hit), len(ids), sha(",".join(sorted(str(i) for i in ids if i is not None))), bool(hit)))
    return out
