"""The digest columns of the operators, by brute force over a list of (key, text)."""

from __future__ import annotations

import bisect
import collections
import fractions
import hashlib
import math
import re
import string
import zlib

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
LAST = 1 << 63  # a null key is later than all others


def order(key):
    return LAST if key is None else key


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def base_scores(docs):
    tokens = [[*WORD.findall((t or "").translate(LOW)), None] for _, t in docs]
    held = [zlib.crc32(b"" if k is None else str(k).encode()) % 10 == 0 for k, _ in docs]
    count = collections.Counter(x for t, h in zip(tokens, held) if not h for x in t)
    n, v = sum(count.values()), len(count)
    return [
        (k, h, len(t), sum(count[x] > 0 for x in t), n,
         sum(math.log10((count[x] + 0.1) / (n + 0.1 * (v + 1))) for x in t))
        for (k, _), t, h in zip(docs, tokens, held)
    ]


def word_windows(docs, width=13):
    words = [WORD.findall(t or "") for _, t in docs]
    first = {}
    for (k, _), w in zip(docs, words):
        for i in range(len(w) - width + 1):
            g = tuple(w[i : i + width])
            first[g] = min(first.get(g, LAST), order(k))
    out = []
    for (k, _), w in zip(docs, words):
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            if first[tuple(w[i : i + width])] < order(k):
                gone[i : i + width] = [True] * width
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((k, len(w), sum(gone), sha(kept.encode())))
    return out


def byte_windows(docs, width=100):
    """Equal (key, text) rows are one document; other ties are not settled here."""
    data = {(order(k), t or ""): (t or "").encode() for k, t in docs}
    first = {}
    for (k, t), b in sorted(data.items()):
        for i in range(len(b) - width + 1):
            first.setdefault(b[i : i + width], (k, t, i))
    out = []
    for k, t in docs:
        b = data[order(k), t or ""]
        gone = bytearray(len(b))
        for i in range(len(b) - width + 1):
            if first[b[i : i + width]] != (order(k), t or "", i):
                gone[i : i + width] = b"\1" * width
        runs = len(re.findall(rb"\x01+", bytes(gone)))
        out.append((k, len(b), sum(gone), runs, sha(bytes(x for x, g in zip(b, gone) if not g))))
    return out


def shingles(text, width=5):
    w = WORD.findall((text or "").translate(LOW))
    if len(w) < width:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}


def groups(docs):
    sets = [shingles(t) for _, t in docs]
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= 75 * len(a | sets[j]):
                parent[root(i)] = root(j)
    low = {}
    for i, (k, _) in enumerate(docs):
        if k is not None:
            low[root(i)] = min(low.get(root(i), LAST), k)
    return [
        (k, len(s), (low.get(root(i)) if s else k), (low.get(root(i)) if s else k) in (None, k))
        for i, ((k, _), s) in enumerate(zip(docs, sets))
    ]


def counts(text):
    words = WORD.findall(text or "")
    grams = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    many = collections.Counter(grams)
    repeat = {j for i, g in enumerate(grams) if many[g] > 1 for j in range(i, i + 8)}
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    failed = len(words) < 20 or 100 * len(repeat) > 30 * len(words)
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), again, len(repeat), failed
    )


def bench_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def hits(docs, items, width=10):
    windows = collections.defaultdict(set)
    for item, text in items:
        w = bench_words(text)
        for i in range(max(len(w) - width, 0) + 1):
            if w:
                windows[tuple(w[i : i + width])].add(item)
    out = []
    for k, text in docs:
        w = bench_words(text)
        hit, found = set(), set()
        for n in {len(g) for g in windows}:
            for i in range(len(w) - n + 1):
                if owners := windows.get(tuple(w[i : i + n])):
                    hit |= set(range(i, i + n))
                    found |= owners
        names = sorted(str(x) for x in found if x is not None)
        out.append((k, len(w), len(hit), len(names), names))
    return out


def with_period(key, words):
    """The words of op 13's texts: in a tenth of the documents they are made periodic from one word on."""
    h = 1 if key is None else zlib.crc32(str(key).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def runs(words):
    """(start, length, smallest period) of all runs, by trying every period."""
    n, out = len(words), set()
    for q in range(1, n // 4 + 1):
        same = [words[i] == words[i + q] for i in range(n - q)]
        i = 0
        while i < n - q:
            s = i
            while i < n - q and same[i]:
                i += 1
            length = i - s + q
            if i - s >= 3 * q and length >= 6:
                part = words[s : s + length]
                if not any(q % r == 0 and part[r:] == part[:-r] for r in range(1, q)):
                    out.add((s, length, q))
            i += 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def periods(docs, plant=True):
    out = []
    for k, t in docs:
        words = WORD.findall(t or "")
        words = with_period(k, words) if plant else words
        found = runs(words)
        best = min(found, key=lambda r: (-fractions.Fraction(r[1], r[2]), r[0], r[2]), default=None)
        gone = {i for s, n, q in found for i in range(s + q, s + n)}
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
        first = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        out.append((k, len(found), *first, sha(lines.encode()), sha(kept.encode())))
    return out


RUN = re.compile("[A-Za-zÀ-ÿ]+")


def typo(key, run):
    run = run.translate(LOW)
    h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
    if h % 199:
        return run
    k = h % len(run)
    return run[:k] + run[k + 1 :]


def one_edit(a, b):
    """Whether one inserted, deleted or replaced character makes a into b."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def variants(docs, least_length=6, least_count=5):
    count = collections.Counter(typo(k, r) for k, t in docs for r in RUN.findall(t or ""))
    count = {w: n for w, n in count.items() if len(w) >= least_length and n >= least_count}
    holes = collections.defaultdict(list)  # words by what is left without one character
    for w in count:
        for v in {w} | {w[:i] + w[i + 1 :] for i in range(len(w))}:
            holes[v].append(w)
    near = collections.defaultdict(set)
    for group in holes.values():
        for a in group:
            near[a].update(b for b in group if one_edit(a, b))
    form = {}
    for w, n in count.items():
        best = min(near[w], key=lambda b: (-count[b], b), default=None)
        if best is not None and count[best] >= 5 * n:
            form[w] = best
    out = []
    for w, n in count.items():
        root = w
        while root in form:
            root = form[root]
        f = form.get(w)
        out.append((w, f, root, n, len(near[w]), None if f is None else count[f]))
    return out


def interpolated(texts, levels, weights, bins=48):
    """log10 probability of each (doc_id, n_tokens) under pair and word counts, as op 1 describes it."""
    rows = []
    for doc_id, text in texts:
        folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        name = "" if doc_id is None else str(doc_id)
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", folded) if w]
        rows.append((doc_id, zlib.crc32(name.encode()) % 10 == 0, [*words, None]))
    word, pair = collections.Counter(), collections.Counter()
    for _, held_out, tokens in rows:
        if not held_out:
            word.update(tokens)
            pair.update(zip([None, *tokens], tokens))
    space = word.total() + 0.1 * (len(word) + 1)

    def rounded(n):
        return levels[bisect.bisect_right(levels, n) - 1] if n else 0

    def counts(h, t):
        ch, ct = (word[w] if w is None else rounded(word[w]) for w in (h, t))
        return ch, ct, min(rounded(pair[h, t]), ch, ct)

    def bin_of(ch):
        return min(int(math.log2(max(ch, 1))), bins - 1)

    gain = collections.defaultdict(lambda: [0.0] * len(weights))
    for (h, t), n in pair.items():
        ch, ct, cp = counts(h, t)
        low, high = (max(ct - 1, 0) + 0.1) / space, max(cp - 1, 0) / max(ch - 1, 1)
        for i, w in enumerate(weights):
            gain[bin_of(ch)][i] += n * math.log(w * high + (1 - w) * low)
    best = {b: weights[max(range(len(weights)), key=lambda i: (round(g[i], 3), -i))] for b, g in gain.items()}
    out = {}
    for doc_id, _, tokens in rows:
        total = 0.0
        for h, t in zip([None, *tokens], tokens):
            ch, ct, cp = counts(h, t)
            w = best.get(bin_of(ch), 0.0) if ch else 0.0
            total += math.log10(w * cp / max(ch, 1) + (1 - w) * (ct + 0.1) / space)
        out[doc_id, len(tokens)] = total
    return out
