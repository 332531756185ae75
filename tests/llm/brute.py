"""Plain-Python versions of the operators: rows are (doc_id, text, lang, source) tuples."""

import collections
import hashlib
import math
import re
import struct
import zlib

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def _id_order(i):
    return (i is None, i or 0)


def removed_lines(rows):
    """{(row number, line)}: some line before it, by id and line number, has a Jaccard similarity of 0.8."""
    lines = [(i, k, frozenset(words(line)), r) for r, (i, t, *_) in enumerate(rows) for k, line in enumerate((t if t is not None else "").split("\n"))]
    lines = [x for x in lines if x[2]]
    gone = set()
    for i, k, w, r in lines:
        for j, m, v, _ in lines:
            both = len(w & v)
            if (_id_order(j), m) < (_id_order(i), k) and 5 * both >= 4 * (len(w) + len(v) - both):
                gone.add((r, k))
                break
    return gone


def line_dedup(rows):
    gone = removed_lines(rows)
    out = []
    for r, (i, t, *_) in enumerate(rows):
        lines = t.split("\n") if t is not None else []
        kept = [line for k, line in enumerate(lines) if (r, k) not in gone]
        out.append((i, sum(1 for line in lines if words(line)), len(lines) - len(kept), "\n".join(kept) if t is not None else None))
    return out


def fingerprint(text):
    w = words((text or "").translate({c: c + 32 for c in range(65, 91)}))
    if not w:
        return 0
    shingles = [" ".join(w[k : k + 3]) for k in range(len(w) - 2)] if len(w) > 3 else [" ".join(w)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def near_duplicates(rows, one_of_each=False):
    fps = [fingerprint(t) for _, t, *_ in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if bin(fps[a] ^ fps[b]).count("1") <= 3:
                parent[root(a)] = root(b)
    least = collections.defaultdict(list)
    for r, (i, *_) in enumerate(rows):
        if i is not None:
            least[root(r)].append(i)
    if one_of_each:
        return [min(least[g], default=None) for g in {root(r) for r in range(len(rows))}]
    return [(i, f"{fps[r]:016x}", min(least[root(r)], default=None)) for r, (i, *_) in enumerate(rows)]


def counts(text):
    t = text or ""
    w = words(t)
    lines = [line for line in t.split("\n") if words(line)]
    dup = sum(line in lines[:k] for k, line in enumerate(lines))
    seen = collections.Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
    repeated = {k + j for k in range(len(w) - 2) if seen[tuple(w[k : k + 3])] > 1 for j in range(3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(repeated), len(lines), len(re.findall("[A-Z]", t))


def quality(rows, rates, fence, min_rows):
    """(id, five counts, base_failed, kept) of each row."""
    per = [dict(zip(("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals"), counts(t))) for _, t, *_ in rows]

    def rate(c, name):
        part, whole, _, _ = rates[name]
        return c[part] * 1000 // max(c[whole], 1)

    def bucket(v):
        shift = max(0, len(bin(v)) - 2 - 8)
        return v >> shift << shift

    out = []
    for (i, _, lang, source), c in zip(rows, per):
        failed = c["n_words"] < 50 or 100 * c["n_repeat_words"] > 50 * c["n_words"]
        kept = not failed
        for name, (_, _, slack, both) in rates.items() if kept else ():
            for keys in (lambda r: (r[2], r[3]), lambda r: r[2], lambda r: 0):
                values = sorted(bucket(rate(d, name)) for r, d in zip(rows, per) if d["n_words"] and keys(r) == keys((i, None, lang, source)))
                if len(values) >= min_rows:
                    break
            low, high = values[-(-len(values) // 4) - 1], values[-(-3 * len(values) // 4) - 1]
            spread = fence * max(high - low, slack)
            kept &= rate(c, name) <= high + spread and (not both or rate(c, name) >= low - spread)
        out.append((i, *list(c.values())[:5], failed, kept))
    return out


def leaks(rows, items, similarity=0.8):
    """{(doc_id, item_id): similarity} over all windows of an item's length."""
    token = re.compile(r"[^\W_]+")
    out = {}
    for i, t, *_ in rows:
        w = token.findall((t or "").lower())
        for item, text in items:
            v = token.findall((text or "").lower())
            if not v or not w:
                continue
            width = min(5, len(v))
            own = collections.Counter(tuple(v[k : k + width]) for k in range(len(v) - width + 1))
            best = 0.0
            for start in range(max(1, len(w) - len(v) + 1)):
                part = w[start : start + len(v)]
                mine = collections.Counter(tuple(part[k : k + width]) for k in range(len(part) - width + 1))
                both = sum((own & mine).values())
                best = max(best, both / (own.total() + mine.total() - both))
            if best >= similarity:
                out[i, item] = max(round(best, 9), out.get((i, item), 0))
    return out


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def personal(text):
    t = text or ""
    found = [(0, *m.span()) for m in EMAIL.finditer(t)]
    found += [(1, *m.span()) for m in IP.finditer(t) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(t):
        d = re.sub("[^0-9]", "", m[0])
        if 13 <= len(d) <= 19 and sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(d))) % 10 == 0:
            found.append((2, *m.span()))
    return found + [(3, *m.span()) for m in PHONE.finditer(t) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]


def suffix_dedup(rows, length=200):
    data = [(t or "").encode() for _, t, *_ in rows]
    seen = collections.Counter(b[k : k + length] for b in data for k in range(len(b) - length + 1))
    out = []
    for (i, *_), b in zip(rows, data):
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return out


def secrets(text, allowed, classes, window, scale):
    t = text or ""
    base = []
    for m in re.finditer(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", t, re.A):
        if len(m[2]) >= 6:
            base.append((m.start(), 0, m.end(), "assign"))
    base += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    base += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
    more = []
    for m in re.finditer(r"[A-Za-z0-9+/_=-]{20,}", t):
        s = m[0]
        if not re.search("[A-Za-z]", s) or any(a.startswith("^") and re.search(a, s) for a in allowed):
            continue
        name, _, limit = next(c for c in classes if re.search(c[1], s))
        left_out = set()
        for run in re.finditer("[A-Za-z0-9]+", s):
            if any(not a.startswith("^") and re.search(a, run[0]) for a in allowed):
                left_out |= set(range(*run.span()))
        if name == "letters":
            left_out |= {k for k, c in enumerate(s) if not c.isalpha()}
            for part in re.finditer("[A-Za-z]+", s):
                if 100 * sum(c.isupper() for c in part[0]) <= 30 * len(part[0]):
                    left_out |= set(range(*part.span()))
        high = []
        for p in range(window - 1, len(s)):
            if left_out & set(range(p - window + 1, p + 1)):
                continue
            n = collections.Counter(s[p - window + 1 : p + 1]).values()
            if math.log2(window) - sum(round(v * math.log2(v) * scale) for v in n) / (window * scale) >= limit:
                high.append(p)
        stretches = []
        for p in high:
            if stretches and p - stretches[-1][1] <= window:
                stretches[-1][1] = p
            else:
                stretches.append([p, p])
        more += [(m.start() + a - window + 1, 3, m.start() + b + 1, "entropy") for a, b in stretches]
    more = [s for s in more if not any(b[0] <= s[0] and s[2] <= b[2] for b in base)]

    def joined(spans):
        return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(spans))

    return (*(sum(s[3] == k for s in base) for k in ("assign", "access", "hex")), hashlib.sha256(joined(base).encode()).hexdigest(), len(more), joined(base + more))


def languages(rows, buckets, smoothing):
    """Plain naive Bayes over hashed 1-3-grams, text by text: [(id, language, probability)]; learns from the rows that are not held out."""

    def grams(text):
        t = "".join(c if c.isalpha() else " " for c in (text or "").lower()).lstrip(" ")
        t = re.sub(" +", " ", t)
        for n in (1, 2, 3):
            for k in range(len(t) - n + 1):
                if t[k : k + n] != " ":
                    h = n
                    for c in t[k : k + n]:
                        h = (h * 0x100000001B3 + ord(c)) % 2**64
                    h = (h ^ (h >> 30)) * 0xBF58476D1CE4E5B9 % 2**64
                    h = (h ^ (h >> 27)) * 0x94D049BB133111EB % 2**64
                    yield ((h ^ (h >> 31)) >> 40) % buckets

    counts, docs = collections.defaultdict(collections.Counter), collections.Counter()
    for i, text, lang, *_ in rows:
        if lang is not None and (i is None or zlib.crc32(str(i).encode()) % 3 != 1):
            own = collections.Counter(grams(text))
            counts[lang] += own
            docs[lang] += bool(own)
    known = sorted(k for k in docs if docs[k])
    out = []
    for i, text, *_ in rows:
        own = collections.Counter(grams(text))
        if not own or not known:
            out.append((i, "und", 0.0))
            continue
        score = []
        for lang in known:
            all_ = sum(counts[lang].values()) + smoothing * buckets
            score.append(math.log(docs[lang] / sum(docs.values())) + sum(n * math.log((counts[lang][b] + smoothing) / all_) for b, n in own.items()))
        p = [math.exp(x - max(score)) for x in score]
        out.append((i, known[p.index(max(p))], max(p) / sum(p)))
    return out


def substring_dedup(rows, window=13):
    data = [words(t) for _, t, *_ in rows]
    owners = collections.defaultdict(set)
    for (i, *_), w in zip(rows, data):
        for k in range(len(w) - window + 1):
            owners[tuple(w[k : k + window])].add(i)
    out = []
    for (i, *_), w in zip(rows, data):
        gone = set()
        for k in range(len(w) - window + 1):
            if any(_id_order(j) < _id_order(i) for j in owners[tuple(w[k : k + window])]):
                gone.update(range(k, k + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def pieces(rows, tokenizer, capacity=2048):
    """(id, piece, start, length, ids_crc32) of every piece."""
    out = []
    for i, t, *_ in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), capacity):
            part = ids[k : k + capacity]
            out.append((i, k // capacity, k, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part))))
    return out
