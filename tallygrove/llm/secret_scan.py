"""Secrets in text: fixed patterns, and windows of high Shannon entropy."""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections.abc import Iterator

from pyspark.sql import DataFrame

from tallygrove.llm.shared import Span, merged, scan

KINDS = ("assign", "access", "hex", "entropy")

# Fixed by the contract.
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 8, 16, 32

# Characters of a window, and the bits per character from which it counts, by the candidate's class.
WINDOW = 20
THRESHOLDS = {"hexadecimal": 3.0, "lower": 3.4, "mixed": 3.6}

_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
_DIGIT = re.compile(r"[0-9]")
_LETTER = re.compile(r"[A-Za-z]")
_HEX_RUN = b"h" * LEAST_HEX
_TO_HEX = bytes(ord("h") if chr(b) in "0123456789abcdef" else 32 for b in range(256))
# Candidates that look random but are no secrets.
ALLOWED = (
    re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"),  # UUID
    re.compile(r"(?:[A-Za-z]{2,}|[0-9]{1,8})(?:[-_/](?:[A-Za-z]{2,}|[0-9]{1,8}))+[-_/=]*"),  # slug, path, date
    re.compile(r"[A-Za-z]+[0-9]{1,6}"),  # word with a number
    re.compile(r"[0-9+/_=-]+"),  # numbers and rulers
)
_PLACEHOLDER = re.compile(r"EXAMPLE|example|0123456789|abcdefgh|ABCDEFGH|xxxx|XXXX")
# A run between separators that holds a placeholder.
_PIECE = re.compile(r"[^/=]+")
# Where host and path of an address begin and end; what follows a user's name or key; a digest's name.
_MARK = re.compile(r"https?://|[\s?#@]")
_USER = re.compile(r"(?::[^\s/?#@:]*)?@")
_DIGEST = re.compile(r"sha(?:1|256|512)[-: ]\s{0,9}\Z")


def _base(text: str) -> list[Span]:
    found = []
    if ":" in text or "=" in text:
        for m in _ASSIGN.finditer(text):
            if len(m[2]) >= LEAST_ASSIGN:
                found.append(("assign", m.start(), m.end(), True))
    if "AKIA" in text:
        for m in _ACCESS.finditer(text):
            if m.end() - m.start() >= LEAST_ACCESS:
                found.append(("access", m.start(), m.end(), True))
    # A byte map and a substring search rule out most texts before the pattern runs.
    if _HEX_RUN in text.encode("utf-8", "surrogatepass").translate(_TO_HEX):
        for m in _HEX.finditer(text):
            if m.end() - m.start() >= LEAST_HEX:
                found.append(("hex", m.start(), m.end(), True))
    return found


def character_class(candidate: str) -> str:
    if re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", candidate):
        return "hexadecimal"
    if re.fullmatch(r"[0-9a-z_-]+|[0-9A-Z_-]+", candidate):
        return "lower"
    return "mixed"


def entropy_spans(candidate: str, window: int = WINDOW) -> list[tuple[int, int]]:
    """Merged windows whose Shannon entropy reaches the threshold of the candidate's class.

    The window slides by one; counts change by one in and one out, and with
    them the sum of count times log count.
    """
    least = THRESHOLDS[character_class(candidate)]
    plogp = [0.0] + [k * math.log2(k) for k in range(1, window + 1)]
    counts: dict[str, int] = {}
    total, out = 0.0, []
    for i, c in enumerate(candidate):
        k = counts.get(c, 0)
        counts[c] = k + 1
        total += plogp[k + 1] - plogp[k]
        if i >= window:
            old = candidate[i - window]
            k = counts[old]
            counts[old] = k - 1
            total += plogp[k - 1] - plogp[k]
        if i >= window - 1 and math.log2(window) - total / window >= least:
            start = i - window + 1
            if out and start <= out[-1][1]:
                out[-1] = (out[-1][0], i + 1)
            else:
                out.append((start, i + 1))
    return out


def _stretches(word: str) -> list[tuple[int, int]]:
    """The parts of a run without the pieces that hold a placeholder."""
    out, start = [], 0
    for piece in _PIECE.finditer(word):
        if _PLACEHOLDER.search(piece[0]):
            out.append((start, piece.start()))
            start = piece.end()
    out.append((start, len(word)))
    return [(a, b) for a, b in out if b - a >= WINDOW]


def _without(start: int, end: int, taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """What the ordered spans ``taken`` leave of a span, as far as it fills a window."""
    out = []
    for a, b in taken[max(bisect_left(taken, (start,)) - 1, 0) : bisect_left(taken, (end,))]:
        if b > start:
            out.append((start, a))
            start = max(start, b)
    out.append((start, end))
    return [(a, b) for a, b in out if b - a >= WINDOW]


def _entropy(text: str, taken: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Windows of high entropy beside the base spans ``taken``, merged."""
    plain = False  # whether the place ``seen`` is in the host or path of an address
    seen = 0
    for m in _CANDIDATE.finditer(text):
        word, at = m[0], m.start()
        # A run that begins with the slashes of an address is inside it.
        inner = at + len(word) - len(word.lstrip("/"))
        for mark in _MARK.finditer(text, seen, inner):
            plain = mark[0].endswith("://")
        seen = inner
        if not _DIGIT.search(word) or not _LETTER.search(word) or any(p.fullmatch(word) for p in ALLOWED):
            continue
        if (plain and not _USER.match(text, m.end())) or _DIGEST.search(text, max(at - 20, 0), at):
            continue
        for first, last in _stretches(word):
            for a, b in entropy_spans(word[first:last]):
                yield from _without(a + first + at, b + first + at, taken)


def secret_spans(text: str | None) -> list[Span]:
    """Spans by start, then kind in the order of ``KINDS``.

    Entropy spans are added where a run of 20 or more key characters holds
    letters and digits and is not on the allow list.  Host and plain path of an
    address are on it, what stands for a user, a query or a fragment is not; a
    placeholder hides its own piece of a run.  Base spans are cut out.
    """
    text = text or ""
    found = _base(text)
    if _DIGIT.search(text):
        taken = merged((s, e) for _, s, e, _ in found)
        found += [("entropy", a, b, False) for a, b in _entropy(text, taken)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id and ``spans`` (kind, start, end, base).

    Whole texts are scanned; null counts as empty; rows equal to others are
    scanned like any other.  No shuffle, no state.
    """
    return scan(docs, lambda texts: [secret_spans(t) for t in texts], id_col, text_col)
