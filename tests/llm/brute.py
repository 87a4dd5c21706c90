"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def hash_text(text, seed=42):
    return xxhash.xxh64_intdigest(text.encode(), seed)


def hash_long(value, seed):
    return xxhash.xxh64_intdigest((value & (1 << 64) - 1).to_bytes(8, "little"), seed)


# ---- 1
def ngrams(text, buckets):
    tokens = [t for t in re.split(r"[ \t\n\x0B\f\r]+|(?=[#*$%&|<>{}=])", text or "") if t]
    h = [hash_text(t) for t in tokens]
    pairs = [hash_long(b, hash_long(a, 42)) for a, b in zip(h, h[1:])]
    return [signed(x) % buckets for x in h + pairs]


def base_counts(text):
    w = words(text)
    at = defaultdict(list)
    for i in range(len(w) - 7):
        at[tuple(w[i : i + 8])].append(i)
    hit = {j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    failed = len(w) < 20 or 100 * len(hit) > 30 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit), failed


def quality(docs, labels, threshold, buckets, smoothing):
    """(doc_id, text) and {doc_id: (quality, toxic)} -> rows of the base counts, the score and the verdict."""
    trusted = {i for i, (q, t) in labels.items() if q == 1 and not t}
    raw, target = Counter(), Counter()
    for i, text in docs:
        f = ngrams(text, buckets)
        raw.update(f)
        if i in trusted:
            target.update(f)
    n_r, n_t = sum(raw.values()), sum(target.values())
    mass = smoothing * buckets

    def weight(b):
        if not n_t:
            return 0.0
        return math.log((target[b] + smoothing) / (n_t + mass)) - math.log((raw[b] + smoothing) / (n_r + mass))

    out = []
    for i, text in docs:
        f = ngrams(text, buckets)
        score = sum(map(weight, f)) / len(f) if f else 0.0
        base = base_counts(text)
        out.append((i, *base, score, not base[-1] and score >= threshold))
    return out


# ---- 2
def targets(size_of):
    """{source: size} -> {source: target}: share by weight, cut at twice the size, share the excess again."""
    order = sorted((s for s in size_of if s is not None), key=lambda s: s.encode()) + [None] * (None in size_of)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    total = 1.5 * sum(size_of.values())
    capped = set()
    while True:
        free = [s for s in order if s not in capped]
        left = total - sum(2 * size_of[s] for s in capped)
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 2 * size_of[s]}
        if not over:
            return {s: 2.0 * size_of[s] if s in capped else share[s] for s in order}
        capped |= over


# ---- 4
def suffix_dedup(docs, length=50):
    out, seen = {}, set()
    for i, text in sorted(docs):
        b = (text or "").encode()
        at = [b[k : k + length] for k in range(len(b) - length + 1)]
        mask = bytearray(len(b))
        for k, x in enumerate(at):
            if x in seen:
                mask[k : k + length] = b"\1" * length
        seen.update(at)
        spans = sum(m and not (k and mask[k - 1]) for k, m in enumerate(mask))
        out[i] = len(b), sum(mask), spans, sha(bytes(c for c, m in zip(b, mask) if not m))
    return out


# ---- 7
def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def near_classes(docs, similarity=0.8):
    """{doc_id: text} -> {doc_id: smallest id of its class}."""
    sets = {i: shingles(t) for i, t in docs.items()}
    parent = {i: i for i in docs}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(i for i in docs if sets[i])
    for n, i in enumerate(ids):
        for j in ids[:n]:
            a, b = sets[i], sets[j]
            if min(len(a), len(b)) >= similarity * max(len(a), len(b)):
                common = len(a & b)
                if common >= similarity * (len(a) + len(b) - common):
                    x, y = sorted((top(i), top(j)))
                    parent[y] = x
    return {i: top(i) for i in docs}


# ---- 10
def plain(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", low) if w]


def contamination(text, items):
    """text, {item_id: text} -> n_words, n_hit, items, contaminated."""
    w, hit, found = plain(text), set(), set()
    at = defaultdict(list)
    for n in {min(13, len(plain(t))) for t in items.values()} - {0}:
        for i in range(len(w) - n + 1):
            at[tuple(w[i : i + n])].append(i)
    for item, t in items.items():
        v = plain(t)
        n = min(13, len(v))
        for i in range(len(v) - n + 1 if n else 0):
            for p in at.get(tuple(v[i : i + n]), ()):
                hit.update(range(p, p + n))
                found.add(str(item))
    return len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)


# ---- 6
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(d):
    return sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(d))) % 10 == 0


def base_spans(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = [("email", m.start(), m.end()) for m in EMAIL.finditer(text)]
    out += [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", m.start(), m.end()) for m in CARD.finditer(text) if 14 <= len(digits(m)) <= 19 and luhn(digits(m))]
    out += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 10 <= len(digits(m)) <= 15]
    return sorted(out, key=lambda s: (s[1], ("email", "ip", "card", "phone").index(s[0])))
