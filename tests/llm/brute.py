"""Plain Python answers that the corpus queries are held against."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def words(text) -> list[str]:
    return WORD.findall(text or "")


ASSIGN = re.compile(
    r"""((?:p|P)(?:a|A)(?:s|S)(?:s|S)(?:w|W)(?:o|O)(?:r|R)(?:d|D)|(?i:passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")


def secrets(text):
    t = text or ""
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 8]
    found += [(m.start(), 1, "access", m.end()) for m in ACCESS.finditer(t) if len(m[0]) >= 16]
    found += [(m.start(), 2, "hex", m.end()) for m in HEX.finditer(t) if len(m[0]) >= 32]
    found.sort()
    n = Counter(f[2] for f in found)
    digest = sha(",".join(f"{kind}:{a}:{b}" for a, _, kind, b in found))
    return n["assign"], n["access"], n["hex"], digest


def quality(text):
    t = text or ""
    w = words(t)
    grams = Counter(zip(w, w[1:], w[2:], strict=False))
    hit = set()
    for i, gram in enumerate(zip(w, w[1:], w[2:], strict=False)):
        if grams[gram] > 1:
            hit |= {i, i + 1, i + 2}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    n, rep = len(w), len(hit)
    failed = n < 50 or 100 * rep > 50 * n
    return n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), rep, failed


def lower(text) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def fingerprint(text) -> int:
    import xxhash

    w = words(lower(text))
    if not w:
        return 0
    shingles = [w] if len(w) < 3 else [w[i : i + 3] for i in range(len(w) - 2)]
    hashes = [xxhash.xxh64_intdigest(" ".join(s).encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(ids, links):
    """The least id that can be reached from each."""
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def near_copies(docs):
    """docs: (doc_id, text). doc_id -> (fingerprint in hexadecimal, least doc_id reached)."""
    prints = {i: fingerprint(t) for i, t in docs}
    ids = sorted(prints)
    links = [(a, b) for n, a in enumerate(ids) for b in ids[:n] if (prints[a] ^ prints[b]).bit_count() <= 3]
    found = groups(ids, links)
    return {i: (f"{prints[i]:016x}", found[i]) for i in ids}


BENCH_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def leak_words(text):
    return BENCH_WORD.findall(lower(text))


def leaks(docs, items, window=10):
    """docs, items: (id, text). doc_id -> (n_words, n_hit, item ids)."""
    windows = {}
    for item, text in items:
        w = leak_words(text)
        if w:
            n = min(window, len(w))
            for i in range(len(w) - n + 1):
                windows.setdefault(tuple(w[i : i + n]), set()).add(str(item))
    lengths = {len(k) for k in windows}
    out = {}
    for doc, text in docs:
        w = leak_words(text)
        hit, found = set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if (names := windows.get(tuple(w[i : i + n]))) is not None:
                    hit.update(range(i, i + n))
                    found |= names
        out[doc] = (len(w), len(hit), sorted(found))
    return out


def targets(sizes):
    """sizes: source -> words; None is the last source. source -> target."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, open_, out = 1.5 * sum(sizes.values()), set(order), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > 2 * sizes[s]}
        if not over:
            out |= {s: level * weight[s] for s in open_}
            break
        out |= {s: 2.0 * sizes[s] for s in over}
        left -= sum(2.0 * sizes[s] for s in over)
        open_ -= over
    return out


def mixed(docs):
    """docs: (doc_id, text, source), ids all different. doc_id -> copies in the mix."""
    size = {d: len(words(t)) for d, t, _ in docs}
    of, total = {}, {}
    for d, _, s in docs:
        of.setdefault(s, []).append(d)
        total[s] = total.get(s, 0) + size[d]
    goal, out = targets(total), {}
    weight = {d: max(1, n.bit_length()) for d, n in size.items()}
    for s, ids in of.items():
        low, high = 0.0, 3.0
        for _ in range(200):
            level = (low + high) / 2
            enough = sum(size[d] * min(2, level * weight[d]) for d in ids) >= goal[s]
            low, high = (low, level) if enough else (level, high)
        times = {d: min(2, high * weight[d]) for d in ids}
        times = {d: round(n) if abs(n - round(n)) < 1e-9 else n for d, n in times.items()}
        out |= {d: int(n) for d, n in times.items()}
        rest = goal[s] - sum(out[d] * size[d] for d in ids)
        if rest <= 1e-9 * goal[s]:
            continue

        def rank(d, times=times):
            u = (int(hashlib.md5(f"mix-1:{d}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
            p = times[d] % 1
            return u / (1 - u) / (p / (1 - p))

        upto, cut = 0, None
        for d in sorted((d for d in ids if times[d] % 1 and size[d]), key=rank):
            if cut is None and upto + size[d] > rest:
                cut = rank(d)
                if upto + size[d] - rest <= rest - upto:
                    out[d] += 1
            elif cut is None:
                out[d] += 1
            upto += size[d]
        for d in ids:
            if times[d] % 1 and not size[d] and (cut is None or rank(d) < cut):
                out[d] += 1
    return out


def repeats(docs, window=13):
    """docs: (doc_id, text). doc_id -> (n_words, n_removed, hash of what is left)."""
    first = {}
    for doc, text in docs:
        w = words(text)
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            first[key] = min(first.get(key, doc), doc)
    out = {}
    for doc, text in docs:
        w = words(text)
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < doc:
                gone.update(range(i, i + window))
        out[doc] = (len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def licences(text, templates):
    w = re.findall("[a-z0-9]+", (text or "").lower())
    have = set(zip(w, w[1:], w[2:], w[3:], w[4:], strict=False))
    found = set()
    for name, notices in templates.items():
        for notice in notices:
            t = re.findall("[a-z0-9]+", notice.lower())
            wanted = set(zip(t, t[1:], t[2:], t[3:], t[4:], strict=False))
            if len(wanted & have) >= 0.8 * len(wanted):
                found.add(name)
    return ",".join(sorted(found))


def trigrams(text):
    """Hashed trigrams of bytes around every letter, with their counts."""
    letters = [c if 97 <= c <= 122 or c >= 128 else 32 for c in text.lower().encode()]
    padded = [32, *letters, 32]
    codes = (padded[i - 1] << 16 | padded[i] << 8 | padded[i + 1] for i in range(1, len(padded) - 1) if padded[i] != 32)
    return Counter((code * 2654435761 & 0xFFFFFFFF) >> 16 for code in codes)


def language_model(docs):
    """Likelihood of each bucket by language, from (text, lang), and that of a bucket never seen."""
    counts = {}
    for text, lang in docs:
        counts.setdefault(lang, Counter()).update(trigrams(text))
    sums = {lang: sum(c.values()) + 0.5 * 65536 for lang, c in counts.items()}
    return {lang: (lambda b, c=counts[lang], total=sums[lang]: (c[b] + 0.5) / total) for lang in sorted(counts)}


def language_mixture(text, model, steps=25, penalty=6.0):
    """Language to proportion: forward selection by the steepest rise, each set fitted by expectation-maximisation."""
    grams = trigrams(text)
    n = sum(grams.values())
    p = {lang: {b: of(b) for b in grams} for lang, of in model.items()}
    likelihood = lambda mixed: sum(c * math.log(mixed[b]) for b, c in grams.items())
    first = max(model, key=lambda lang: likelihood(p[lang]))  # the first of several best ones
    shares, best = {first: 1.0}, likelihood(p[first])
    while len(shares) < len(model):
        mixed = {b: sum(s * p[lang][b] for lang, s in shares.items()) for b in grams}
        slope = {lang: sum(c * p[lang][b] / mixed[b] for b, c in grams.items()) - n for lang in model if lang not in shares}
        new = max(slope, key=slope.get)
        if slope[new] <= 0:
            break
        tried = dict.fromkeys([*shares, new], 1 / (len(shares) + 1))
        for _ in range(steps):
            mixed = {b: sum(s * p[lang][b] for lang, s in tried.items()) for b in grams}
            tried = {lang: s * sum(c * p[lang][b] / mixed[b] for b, c in grams.items()) / n for lang, s in tried.items()}
        likely = likelihood({b: sum(s * p[lang][b] for lang, s in tried.items()) for b in grams})
        if likely - best <= penalty / 2 * math.log(n):
            break
        shares, best = tried, likely
    return shares
