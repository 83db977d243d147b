"""Plain Python versions of the corpus operators, written from their contracts."""

import hashlib
import re
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text, lower=False):
    found = WORD.findall(text or "")
    return [w.translate(LOWER) for w in found] if lower else found


def shingles(w, k=5):
    if not w:
        return set()
    return {" ".join(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {" ".join(w)}


def near(rows, percent=75):
    """rows: (id, text). One (id, set size, component id) per row; every pair is compared."""
    sets = [shingles(words(t, True)) for _, t in rows]
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                up[top(i)] = top(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[top(i)] = min(doc, least.get(top(i), doc))
    return [(doc, len(s), least.get(top(i)) if s else doc) for i, ((doc, _), s) in enumerate(zip(rows, sets))]


def repeats(rows, window=35):
    seen = Counter()
    for _, t in rows:
        w = words(t)
        seen.update(tuple(w[i:i + window]) for i in range(len(w) - window + 1))
    out = []
    for doc, t in rows:
        w = words(t)
        gone = {p for i in range(len(w) - window + 1) if seen[tuple(w[i:i + window])] > 1 for p in range(i, i + window)}
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((doc, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def simhash(grams):
    votes = [0] * 64
    for g in grams:
        h = xxhash.xxh64_intdigest(g.encode(), seed=42)
        for b in range(64):
            votes[b] += len(g) if h >> b & 1 else -len(g)
    return sum(1 << b for b in range(64) if votes[b] > 0)


def leaks(rows, items, k=5, percent=75, radius=19):
    """(id, item id) pairs: every aligned window against every item of its size."""
    marks = defaultdict(list)
    for item, text in items:
        w = words(text, True)
        if w:
            marks[len(w)].append((item, w, shingles(w, k)))
    out = set()
    for doc, text in rows:
        w = words(text, True)
        for n, group in marks.items():
            m = min(n, k)
            place = defaultdict(set)
            for _, iw, _ in group:
                for o in range(n - m + 1):
                    place[" ".join(iw[o:o + m])].add(o)
            starts = {max(0, min(p - o, len(w) - n)) for p in range(len(w) - m + 1) for o in place.get(" ".join(w[p:p + m]), ())}
            for s in starts:
                a = shingles(w[s:s + n], k)
                for item, _, b in group:
                    both, either = sum(map(len, a & b)), sum(map(len, a | b))
                    if 100 * both >= percent * either and (simhash(a) ^ simhash(b)).bit_count() <= radius:
                        out.add((doc, item))
    return out


def every_leak(rows, items, k=5, percent=75, radius=64):
    """(id, item id) pairs: every window of every document against every item, by weighted similarity and
    fingerprints that differ by ``radius`` bits at most (64: by the similarity alone)."""
    marks = [(item, len(w), shingles(w, k)) for item, w in ((i, words(t, True)) for i, t in items) if w]
    out = set()
    for doc, text in rows:
        w = words(text, True)
        whole = {m: shingles(w, m) if len(w) >= m else shingles(w, k) for m in range(1, k + 1)}
        for item, n, b in marks:
            # a window's part of the item is no more than the whole text's
            least = percent * sum(map(len, b))
            if 100 * sum(map(len, whole[min(n, k)] & b)) < least:
                continue
            for s in range(max(0, len(w) - n) + 1):
                a = shingles(w[s:s + n], k)
                both = sum(map(len, a & b))
                if both and 100 * both >= percent * sum(map(len, a | b)) and (radius == 64 or (simhash(a) ^ simhash(b)).bit_count() <= radius):
                    out.add((doc, item))
                    break
    return out


def passes(text, rules, base, stop_words, symbols):
    """Whether no rule (name, signal, base, percent, above, min_words) rejects a text."""
    t = text or ""
    w = words(t)
    lines = [x for x in t.split("\n") if words(x)]
    windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    seen = Counter(windows)
    v = {"one": 1, "n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(t.count(c) for c in symbols), "n_exclaims": t.count("!"),
         "n_stop_words": sum(x.translate(LOWER) in stop_words for x in w), "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)),
         "n_bullets": sum(x.lstrip(" ")[:1] in ("-", "*", "•") for x in lines), "n_ellipses": sum(x.rstrip(" ").endswith(("...", "…")) for x in lines),
         "n_repeat_words": len({p for i, g in enumerate(windows) if seen[g] > 1 for p in range(i, i + 5)})}
    for r in (*base, *rules):
        a, b = 100 * v[r.signal], r.percent * v[r.base]
        if len(w) >= r.min_words and (a > b if r.above else a < b):
            return False
    return True


SECRETS = ((re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 8),
           (re.compile("AKIA[A-Z0-9]+"), 0, 16), (re.compile("[0-9a-f]+"), 0, 32))


def live(rows, owners=3, repos=6, distinct=8):
    """Numbers of the rows (text, source, lang) that hold a live-looking value of few owners and repositories."""
    held = defaultdict(set)
    found = []
    for n, (text, source, lang) in enumerate(rows):
        for pattern, group, least in SECRETS:
            for m in pattern.finditer(text or ""):
                if len(m[group]) >= least:
                    held[m[group]].add((source, f"{source or ''}/{lang or ''}"))
                    found.append((n, m[group]))
    out = set()
    for n, value in found:
        many = len({s or "" for s, _ in held[value]}) >= owners or len(held[value]) >= repos
        if not many and re.search("[0-9]", value) and re.search("[A-Za-z]", value) and len(set(value)) >= distinct:
            out.add(n)
    return out
