"""The contracts of the corpus queries in plain Python, over lists of rows."""

import hashlib
import re
from collections import Counter

import xxhash

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def windows_of(items, size=13):
    found = {}
    for item_id, text in items:
        words = WORDS.findall(lower(text))
        length = min(size, len(words))
        for at in range(len(words) - length + 1 if words else 0):
            found.setdefault(tuple(words[at : at + length]), set()).add(item_id)
    return found


def contamination(text, windows):
    words = WORDS.findall(lower(text))
    hit, items = set(), set()
    for length in {len(window) for window in windows}:
        for at in range(len(words) - length + 1):
            held = windows.get(tuple(words[at : at + length]))
            if held is not None:
                hit.update(range(at, at + length))
                items |= held
    ids = ",".join(sorted(str(item) for item in items if item is not None))
    bad = bool(hit) and 20 * len(hit) >= len(words)
    return len(words), len(hit), sha(ids), bad


def fingerprint(text):
    words = SPACED.findall(lower(text))
    if not words:
        return 0
    width = min(4, len(words))
    hashes = [
        xxhash.xxh64_intdigest(" ".join(words[at : at + width]).encode(), 42)
        for at in range(len(words) - width + 1)
    ]
    bits = 0
    for bit in range(64):
        if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes):
            bits |= 1 << bit
    return bits


def components(prints):
    """Of each fingerprint the set that links reach."""
    distinct = sorted(set(prints))
    parent = {fp: fp for fp in distinct}

    def root(fp):
        while parent[fp] != fp:
            fp = parent[fp]
        return fp

    for at, a in enumerate(distinct):
        for b in distinct[at + 1 :]:
            if (a ^ b).bit_count() <= 4:
                parent[root(a)] = root(b)
    return {fp: root(fp) for fp in distinct}


ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
SECRETS = [
    ("assign", ASSIGN, lambda m: len(m[2]) >= 8),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16),
    ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 32),
]


def secrets(text):
    spans, counts = [], Counter()
    for rank, (kind, pattern, keep) in enumerate(SECRETS):
        for m in pattern.finditer(text or ""):
            if keep(m):
                spans.append((m.start(), rank, kind, m.end()))
                counts[kind] += 1
    digest = ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in sorted(spans))
    return counts["assign"], counts["access"], counts["hex"], digest


def quality(text):
    text = text or ""
    words = SPACED.findall(text)
    windows = [tuple(words[at : at + 3]) for at in range(len(words) - 2)]
    counts = Counter(windows)
    covered = {at + k for at, window in enumerate(windows) if counts[window] > 1 for k in range(3)}
    seen, repeats = set(), 0
    for line in text.split("\n"):
        if SPACED.search(line):
            repeats += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, repeats, len(covered), failed


RULES = [
    ("block", "net", "/"), ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"), ("allow", "org", "/fr/"),
]


def url(text):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", text or "")
    host, path = (lower(m[1]), m[2]) if m else ("", "")
    fits = [
        (len(h + p), h + p, verdict)
        for verdict, h, p in RULES
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return host, path, *(max(fits)[1:] if fits else (None, None))
