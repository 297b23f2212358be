"""The operators' results by plain loops."""

import collections
import hashlib
import math
import re
import zlib

import xxhash

LOW = {c: c + 32 for c in range(65, 91)}
PLAIN, SOLID = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+"), re.compile("[^\x20\x09-\x0d]+")


def plain(text):
    return PLAIN.findall((text or "").translate(LOW))


def windows(words, n=10):
    n = min(n, len(words))
    return [(k, tuple(words[k : k + n])) for k in range(len(words) - n + 1)] if n else []


def contamination(docs, items):
    of = collections.defaultdict(set)
    for item, text in items:
        for _, window in windows(plain(text)):
            of[window].add(item)
    out = []
    for key, text in docs:
        words, hit, found = plain(text), set(), set()
        for n in {len(w) for w in of}:
            for k in range(len(words) - n + 1):
                if (w := tuple(words[k : k + n])) in of:
                    hit.update(range(k, k + n))
                    found |= of[w]
        digest = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        out.append((key, len(words), len(hit), len(found), digest, bool(hit)))
    return out


def counts(text):
    text = text or ""
    words = SOLID.findall(text)
    triples = collections.Counter(zip(words, words[1:], words[2:], strict=False))
    repeated = {k + j for k, t in enumerate(zip(words, words[1:], words[2:], strict=False)) if triples[t] > 1 for j in range(3)}
    seen, twice = set(), 0
    for line in text.split("\n"):
        if SOLID.search(line):
            twice += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), twice, len(repeated)


def fingerprint(text):
    words = SOLID.findall((text or "").translate(LOW))
    shingles = [" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(prints, distance=4):
    """The least key that each (key, bits) reaches; None is greatest."""
    nodes = sorted({b for _, b in prints})
    parent = {b: b for b in nodes}

    def root(b):
        while parent[b] != b:
            b = parent[b]
        return b

    for k, a in enumerate(nodes):
        for b in nodes[k + 1 :]:
            if (a ^ b).bit_count() <= distance:
                parent[root(a)] = root(b)
    least = {}
    for key, b in prints:
        r = root(b)
        if key is not None:
            least[r] = min(least.get(r, key), key)
    return [least.get(root(b)) for _, b in prints]


def base_scores(docs):
    tokens = [[*SOLID.findall((t or "").translate(LOW)), None] for _, t in docs]
    out = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in docs]
    c = collections.Counter(t for ts, held in zip(tokens, out, strict=True) if not held for t in ts)
    n, v = sum(c.values()), len(c)
    return [(i, held, len(ts), sum(c[t] > 0 for t in ts), n, sum(math.log10((c[t] + 1) / (n + v + 1)) for t in ts)) for (i, _), held, ts in zip(docs, out, tokens, strict=True)]


def _kt(a, b):
    return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1)


def tree_scores(train, texts, depth):
    """log10 probabilities by context-tree weighting, node by node."""
    count, kids, memo = collections.defaultdict(lambda: [0, 0]), collections.defaultdict(set), {}

    def bits(text):
        raw = [255] * depth + list((text or "").encode()) + [255]
        for p in range(depth, len(raw)):
            for k in range(8):
                yield tuple(raw[p - d] for d in range(1, depth + 1)), 1 << k | raw[p] >> 8 - k, raw[p] >> 7 - k & 1

    for text in train:
        for context, place, bit in bits(text):
            for d in range(depth + 1):
                count[context[:d], place][bit] += 1
                if d < depth:
                    kids[context[:d], place].add(context[: d + 1])

    def weighted(context, place):
        if (context, place) not in memo:
            own = _kt(*count.get((context, place), (0, 0)))
            below = sum(weighted(c, place) for c in kids.get((context, place), ()))
            memo[context, place] = own if len(context) == depth else math.log(0.5) + max(own, below) + math.log1p(math.exp(-abs(own - below)))
        return memo[context, place]

    out = []
    for text in texts:
        total = 0.0
        for context, place, bit in bits(text):
            p = None
            for d in range(depth, -1, -1):
                n = count.get((context[:d], place), (0, 0))
                own = (n[1] + 0.5) / (sum(n) + 1)
                w = math.exp(math.log(0.5) + _kt(*n) - weighted(context[:d], place))
                p = own if p is None else w * own + (1 - w) * p
            total += math.log10(p if bit else 1 - p)
        out.append(total)
    return out


def kneser_ney(train, texts, order):
    """Bits per byte under interpolated modified Kneser-Ney, by dictionaries."""
    raw = lambda t: bytes([255] * (order - 1)) + (t or "").encode() + b"\xff"
    grams = lambda t: [raw(t)[k : k + order] for k in range(len(raw(t)) - order + 1)]
    levels = {order: collections.Counter(g for t in train for g in grams(t))}
    for k in range(order - 1, 0, -1):
        levels[k] = collections.Counter(g[1:] for g in levels[k + 1])
    cut = {}
    for k, level in levels.items():
        n = [sum(v == c for v in level.values()) for c in range(1, 5)]
        y = n[0] / (n[0] + 2 * n[1]) if n[0] and n[1] else 0.5
        d = [(i + 1) - (i + 2) * y * n[i + 1] / n[i] if n[i] and n[i + 1] else 0.5 for i in range(3)]
        cut[k] = [min(max(x, 0.05), i + 0.95) for i, x in enumerate(d)]
    after = {k: collections.defaultdict(list) for k in levels}
    for k, level in levels.items():
        for g, c in level.items():
            after[k][g[:-1]].append(c)

    def p(g):
        if not g:
            return 1 / 256
        k, lower = len(g), p(g[1:])
        seen = after[k].get(g[:-1])
        if not seen:
            return lower
        d = lambda c: 0 if c == 0 else cut[k][min(c, 3) - 1]
        c = levels[k].get(g, 0)
        return (c - d(c) + sum(map(d, seen)) * lower) / sum(seen)

    return [-sum(math.log2(p(g)) for g in grams(t)) / len(grams(t)) for t in texts]


def phrases(text):
    words, at, labels = plain(text), [], set()
    for phrase, label in {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}.items():
        p = phrase.split()
        for k in range(len(words) - len(p) + 1):
            if words[k : k + len(p)] == p:
                at.append(k)
                labels.add(label)
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))
