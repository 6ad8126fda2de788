"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import xxhash

MASK = (1 << 64) - 1


def fingerprint(text, size=4):
    folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", folded)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(rows, distance=4):
    """{position: smallest id} for (id, fingerprint) rows."""
    label = list(range(len(rows)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= distance:
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    least = {}
    for i, (row_id, _) in enumerate(rows):
        if row_id is not None:
            least[find(i)] = min(row_id, least.get(find(i), row_id))
    return [least.get(find(i)) for i in range(len(rows))]


def contamination(docs, items, size=10):
    def words(text):
        folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded)

    windows = defaultdict(set)
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            windows[tuple(w[i : i + size])].add(str(item))
    lengths = {len(w) for w in windows}
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for i in range(len(w)):
            for n in lengths:
                own = windows.get(tuple(w[i : i + n])) if i + n <= len(w) else None
                if own:
                    hit |= set(range(i, i + n))
                    found |= own
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


def repeats(docs, length=200):
    raw = [(doc_id, (text or "").encode()) for doc_id, text in docs]
    seen = Counter(t[i : i + length] for _, t in raw for i in range(len(t) - length + 1))
    out = []
    for doc_id, t in raw:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((doc_id, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def water_fill(sizes, weights=(1, 2, 3), epochs=3):
    """{source: target} by sharing again what is above the caps."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, target = float(sum(sizes.values())), set(order), {}
    while open_:
        share = left / sum(weight[s] for s in open_)
        above = [s for s in open_ if share * weight[s] > epochs * sizes[s]]
        if not above:
            return target | {s: share * weight[s] for s in open_}
        for s in above:
            target[s] = float(epochs * sizes[s])
            left -= target[s]
            open_.discard(s)
    return target


def edited(texts):
    """(text, edited text, next text) for texts in order."""
    for text, following in zip(texts, texts[1:] + texts[:1], strict=True):
        half = len(text) // 2
        yield text, text[: len(text) - half] + following[:half], following


def url_verdict(url, rules):
    host, path = "", ""
    if url and "://" in url:
        m = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.DOTALL)
        host, path = "".join(c.lower() if "A" <= c <= "Z" else c for c in m[1]), m[2]
    fits = [(len(h) + len(p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else "allow"
