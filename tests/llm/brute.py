"""Plain renderings of the contracts, to hold the operators against."""

import hashlib
import re

PII = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (2 if i % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def pii(text: str | None) -> tuple[list[int], str]:
    counts, spans = [], []
    for k, (kind, pattern) in enumerate(PII.items()):
        n = 0
        for m in pattern.finditer(text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            n += 1
            spans.append((m.start(), k, m.end(), kind))
        counts.append(n)
    joined = ",".join(f"{kind}:{s}:{e}" for s, _, e, kind in sorted(spans))
    return counts, hashlib.sha256(joined.encode()).hexdigest()


LICENSES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def licenses(text: str | None) -> tuple:
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places, labels = [], set()
    for phrase, label in LICENSES.items():
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i : i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def components(edges: list[tuple[int, int]]) -> dict[int, int]:
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {x: find(x) for x in parent}


def simhash_components(prints: dict[int, int]) -> dict[int, int]:
    ids = sorted(prints)
    found = components([(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if (prints[a] ^ prints[b]).bit_count() <= 3])
    return {i: found.get(i, i) for i in ids}


def lcs(a: list, b: list) -> int:
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def _xxh(values: list[int], seed: int = 42) -> int:
    """Spark's xxhash64 over longs: each one's hash seeds the next."""
    import struct

    import xxhash

    for v in values:
        seed = xxhash.xxh64_intdigest(struct.pack("<q", v - (1 << 64) if v >> 63 else v), seed)
    return seed


def order_minhash(text: str, k: int = 3, bins: int = 64, depth: int = 2, place: int = 26) -> str:
    import xxhash

    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    hashes = [xxhash.xxh64_intdigest(w.encode(), 42) for w in words]
    kmers = [_xxh(hashes[i : i + k]) for i in range(len(hashes) - k + 1)] if len(hashes) >= k else [_xxh(hashes)] if hashes else []
    bits = 63 - place
    seen: dict[int, int] = {}
    values = []
    for i, x in enumerate(kmers):
        x >>= 64 - bits
        n = seen.get(x, 0)
        seen[x] = n + 1
        # the occurrence number is an int in Spark, which hashes it as one
        value = xxhash.xxh64_intdigest(n.to_bytes(4, "little"), _xxh([x]))
        values.append(((value >> (64 - bits)) << place) | i)
    values.sort()
    out = []
    for b in range(bins):
        mine = [v for v in values if v >> (63 - (bins - 1).bit_length()) == b][:depth]
        mine.sort(key=lambda v: v & ((1 << place) - 1))
        out.append(f"{_xxh([v >> place for v in mine]) & 65535:04x}" if mine else "....")
    return "".join(out)


def tree_marginals(page, feats, w, kinds) -> list[float]:
    """By summing over all labellings."""
    import itertools
    import math

    n = len(page.parent)
    total, share = 0.0, [0.0] * n
    for y in itertools.product((0, 1), repeat=n):
        s = sum(w.get(x, 0.0) for i in range(n) if y[i] for x in feats[i])
        for i in range(1, n):
            kind = kinds.get(page.group[i], "block")
            s += w.get(f"e{y[page.parent[i]]}{y[i]}_{kind}", 0.0)
        total += math.exp(s)
        for i in range(n):
            share[i] += math.exp(s) * y[i]
    return [x / total for x in share]
