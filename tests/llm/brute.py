"""Plain-Python answers to compare with; quadratic where that is simplest."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict
from zlib import crc32

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(text or "")


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def line_dedup(docs, min_words):
    """docs: (id, text) with distinct ids -> {id: (text, removed lines)}."""
    seqs = {}
    for i, text in docs:
        lines = (text or "").split("\n")
        seqs[i] = [(k, line, len(words(line))) for k, line in enumerate(lines) if words(line)]
    first = {}
    runs = []
    for i in sorted(seqs):
        seq = seqs[i]
        for a in range(len(seq)):
            total = 0
            for b in range(a, len(seq)):
                total += seq[b][2]
                if total >= min_words:
                    content = tuple(x[1] for x in seq[a : b + 1])
                    where = (i, seq[a][0])
                    if first.setdefault(content, where) != where:
                        runs.append((i, seq[a][0], seq[b][0]))
    gone = defaultdict(set)
    for i, a, b in runs:
        gone[i].update(range(a, b + 1))
    out = {}
    for i, text in docs:
        if i not in gone:
            out[i] = (text, 0)
        else:
            kept = [x for k, x in enumerate(text.split("\n")) if k not in gone[i]]
            out[i] = ("\n".join(kept), len(gone[i]))
    return out


def targets(sizes, weights=(5, 2, 1), most=3):
    """{source: size} -> {source: target}, by repeated resharing."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    target, open_, left = {}, set(order), float(sum(sizes.values()))
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > most * sizes[s]}
        if not over:
            target.update({s: left * weight[s] / total for s in open_})
            break
        for s in over:
            target[s] = float(most * sizes[s])
            left -= most * sizes[s]
        open_ -= over
    return target


def simhash(text):
    found = WORD.findall(ascii_lower(text))
    if not found:
        return 0
    grams = [" ".join(found[i : i + 3]) for i in range(max(1, len(found) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(prints):
    """{id: fingerprint} -> {id: least id reachable}, all pairs."""
    ids = sorted(prints)
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: root(i) for i in ids}


def quality(text):
    w = words(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    grams = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    count = Counter(grams)
    hit = {j for i, g in enumerate(grams) if count[g] > 1 for j in range(i, i + 8)}
    out = {
        "n_words": len(w), "word_chars": sum(map(len, w)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(hit),
    }
    out["base_failed"] = len(w) < 20 or 100 * len(hit) > 30 * len(w)
    return out


def contamination(docs, items, size=13):
    """(id, text) pairs -> {id: (n_words, n_hit, n_items, sha, contaminated)}."""
    where = defaultdict(set)
    for item, text in items:
        w = ALNUM.findall(ascii_lower(text))
        m = min(size, len(w))
        for i in range(len(w) - m + 1 if w else 0):
            where[tuple(w[i : i + m])].add(None if item is None else str(item))
    lengths = sorted({len(x) for x in where})
    out = {}
    for i, text in docs:
        w = ALNUM.findall(ascii_lower(text))
        hit, found = set(), set()
        for m in lengths:
            for k in range(len(w) - m + 1):
                if names := where.get(tuple(w[k : k + m])):
                    hit.update(range(k, k + m))
                    found |= names - {None}
        out[i] = (len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit) and 20 * len(hit) >= len(w))
    return out


def held_out(doc_id):
    return crc32(str(doc_id).encode()) % 4 == 2


def _spans(kind, pattern, text, good):
    return [(m.start(), kind, m.end()) for m in re.finditer(pattern, text) if good(m)]


def _digest(found, kinds):
    found.sort(key=lambda s: (s[0], kinds.index(s[1])))
    counts = tuple(sum(k == kind for _, k, _ in found) for kind in kinds)
    return *counts, sha(",".join(f"{k}:{s}:{e}" for s, k, e in found))


def secrets(text):
    text = text or ""
    assign = (
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    )
    found = _spans("assign", re.compile(assign, re.ASCII), text, lambda m: len(m[2]) >= 8)
    found += _spans("access", "AKIA[A-Z0-9]+", text, lambda m: len(m[0]) >= 16)
    found += _spans("hex", "[0-9a-f]+", text, lambda m: len(m[0]) >= 32)
    return _digest(found, ("assign", "access", "hex"))


def _luhn(number):
    digits = [int(c) for c in number if c.isdigit()]
    doubled = [sum(divmod(2 * d, 10)) if i % 2 else d for i, d in enumerate(reversed(digits))]
    return 14 <= len(digits) <= 19 and sum(doubled) % 10 == 0


def personal(text):
    text = text or ""
    found = _spans("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text, bool)
    ip = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
    found += _spans("ip", ip, text, lambda m: all(int(p) <= 255 for p in m[0].split(".")))
    found += _spans("card", r"[0-9]([\x20-]?[0-9])+", text, lambda m: _luhn(m[0]))
    phone = r"\+[0-9][\x20().0-9-]+[0-9]"
    found += _spans("phone", phone, text, lambda m: 10 <= sum(c.isdigit() for c in m[0]) <= 15)
    return _digest(found, ("email", "ip", "card", "phone"))


RULES = {"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block", "net/fr/": "block"}


def url_rule(url):
    """(host, path, rule)"""
    if not url or "://" not in url:
        return "", "", None
    rest = re.split("[?#]", url.split("://", 1)[1])[0]
    host, slash, tail = rest.partition("/")
    host, path = ascii_lower(host), slash + tail
    fits = []
    for rule in RULES:
        of, _, under = rule.partition("/")
        if (host == of or host.endswith("." + of)) and path.startswith("/" + under):
            fits.append(rule)
    return host, path, max(fits, key=len, default=None)
