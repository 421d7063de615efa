"""Plain, slow versions of what the operators compute, for small tables."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def space_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def near_components(docs, k=5, percent=75):
    """{(doc_id, text): (set size, component)} by comparing every pair."""
    sets = {}
    for doc_id, text in docs:
        words = space_words((text or "").translate(LOWER))
        if len(words) >= k:
            sets[doc_id] = {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}
        else:
            sets[doc_id] = {tuple(words)} if words else set()
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = list(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), root(d)) for d in ids}


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+".replace(r"\x20-", " -"))
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def personal(text):
    """(counts by kind, base spans as text) straight from the patterns."""
    text = text or ""
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    found = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    found += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    found += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 14 <= len(digits(m)) <= 19 and luhn(digits(m))]
    found += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(digits(m)) <= 15]
    kinds = ("email", "ip", "card", "phone")
    count = Counter(k for _, k, _ in found)
    spans = ",".join(f"{kinds[k]}:{s}:{e}" for s, k, e in sorted(found))
    return tuple(count[i] for i in range(4)), hashlib.sha256(spans.encode()).hexdigest(), spans


def repeated_lines(docs, run=3):
    """{doc_id: (filled lines, deleted numbers, text after)} in the order of doc_id."""
    seen, out = set(), {}
    for doc_id, text in sorted(docs):
        lines = (text or "").split("\n")
        filled = [x for x in lines if space_words(x)]
        norm = [x.strip(" \t\n\x0b\x0c\r").translate(LOWER) for x in filled]
        gone = set()
        for i in range(len(norm) - run + 1):
            window = tuple(norm[i : i + run])
            if window in seen:
                gone |= set(range(i, i + run))
            seen.add(window)
        kept, n = [], 0
        for line in lines:
            if space_words(line):
                if n not in gone:
                    kept.append(line)
                n += 1
            else:
                kept.append(line)
        out[doc_id] = (len(filled), gone, "\n".join(kept))
    return out


def contamination(docs, items, width=10):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    windows = defaultdict(set)
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - width + 1) if w else 0):
            windows[tuple(w[i : i + width])].add(item)
    out = {}
    for doc_id, text in docs:
        w, hit, named = words(text), set(), set()
        for window, ids in windows.items():
            for i in range(len(w) - len(window) + 1):
                if tuple(w[i : i + len(window)]) == window:
                    hit |= set(range(i, i + len(window)))
                    named |= ids
        names = ",".join(sorted(map(str, named)))
        out[doc_id] = (len(w), len(hit), len(named), hashlib.sha256(names.encode()).hexdigest(), bool(hit))
    return out


def url_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    return host.translate(LOWER), re.match(r"[^?#]*", rest[len(host) :]).group()


def url_rule(host, path, rules):
    best = (None, None)
    for name, verdict in rules:
        own, start = name.split("/", 1)
        if (host == own or host.endswith("." + own)) and path.startswith("/" + start):
            if best[0] is None or len(name) > len(best[0]):
                best = (name, verdict)
    return best


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2
