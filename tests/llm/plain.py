"""Plain forms of the operators, one row after the other."""

import hashlib
import re
from collections import defaultdict

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def blank_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def repeats(rows, n=13):
    """(id, words, removed, kept text) of rows (id, text)."""
    least = {}
    for i, text in rows:
        words = blank_words(text)
        for k in range(len(words) - n + 1):
            key = tuple(words[k : k + n])
            if i is not None:
                least[key] = min(i, least.get(key, i))
    out = []
    for i, text in rows:
        words = blank_words(text)
        gone = [False] * len(words)
        for k in range(len(words) - n + 1):
            if i is not None and least[tuple(words[k : k + n])] < i:
                gone[k : k + n] = [True] * n
        out.append((i, len(words), sum(gone), " ".join(w for w, g in zip(words, gone, strict=True) if not g)))
    return out


def contamination(rows, items, n=13):
    """(id, words, hit words, items, contaminated)."""
    windows = defaultdict(set)
    for i, text in items:
        words = plain_words(text)
        size = min(n, len(words))
        for k in range(len(words) - size + 1 if size else 0):
            windows[tuple(words[k : k + size])].add("null" if i is None else str(i))
    sizes = {len(k) for k in windows}
    out = []
    for i, text in rows:
        words = plain_words(text)
        hit, found = [False] * len(words), set()
        for size in sizes:
            for k in range(len(words) - size + 1):
                ids = windows.get(tuple(words[k : k + size]))
                if ids:
                    hit[k : k + size] = [True] * size
                    found |= ids
        n_hit = sum(hit)
        out.append((i, len(words), n_hit, tuple(sorted(found)), n_hit > 0 and 20 * n_hit >= len(words)))
    return out


def groups(rows, k=5, percent=80):
    """(id, shingles, least linked id); rows of one id are one image."""
    sets, parent = [], {}
    for i, text in rows:
        words = blank_words((text or "").translate(LOW))
        own = {tuple(words[x : x + k]) for x in range(len(words) - k + 1)} if len(words) >= k else {tuple(words)} if words else set()
        sets.append((i, own))
        if i is not None:
            parent[i] = i

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            (i, one), (j, two) = sets[a], sets[b]
            both = len(one & two)
            if i is not None and j is not None and both and 100 * both >= percent * len(one | two):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return [(i, len(own), None if i is None else find(i)) for i, own in sets]


def secrets(text):
    """Base spans as kind:start:end."""
    text = text or ""
    names = ["password", "passwd", "secret", "token", "api_?key"]
    either = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in name) for name in names)
    assign = re.compile(rf"""({either})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    out = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in sorted(out)]


def verdict(url, rules, default="allow"):
    at = (url or "").find("://")
    rest = url[at + 3 :] if at >= 0 else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = host.translate(LOW)
    rules = [(h and h.translate(LOW), p, v) for h, p, v in rules]
    fits = [
        (len(h) + len(p), len(h), v, h + p)
        for h, p, v in rules
        if h is not None and p is not None and (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=(0, 0, default, None))
    return host, path, best[3], best[2]
