"""Personal data: fixed patterns, and a linear-chain conditional random field.

The field tags tokens of lines that hold a digit, an at sign or both spelt-out
"at" and "dot"; no kind of personal data here comes without one.  Features are the shapes
of a token and its neighbours, so the model is small and learns from a small
labelled table in four languages.  It is trained on the driver by gradient
ascent and decoded by Viterbi in numpy, many lines at once; a very long line
is read in blocks that hand on the Viterbi state.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import islice
from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrove.llm.shared import Span, merged, scan, touches

KINDS = ("email", "ip", "card", "phone", "crf_email", "crf_ip", "crf_card", "crf_phone")
TAGS = ("O",) + tuple(f"{p}-{k}" for k in ("email", "ip", "card", "phone") for p in "BI")
_BEGINS = np.array([t[0] == "B" for t in TAGS])
WEIGHTS = 1 << 14

# Fixed by the contract.
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# A match cannot begin inside a run of digits whose first digit gave none.
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _emails(text: str) -> Iterable[tuple[int, int]]:
    """Leftmost matches of local part, at sign, dotted domain; each character is read once."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and _LOCAL.match(text[start - 1]):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
        done = domain.end() if domain else at + 1
        at = text.find("@", done)


def base_spans(text: str) -> list[Span]:
    found = [("email", s, e, True) for s, e in _emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return found
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            found.append(("ip", m.start(), m.end(), True))
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", m.start(), m.end(), True))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                found.append(("phone", m.start(), m.end(), True))
    return found


_TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|[^\w\s]|_|\w")
_LINE = re.compile(r"[^\n]+")
_MARK = re.compile(r"[0-9@]")
_AT = re.compile(r"\b(?:at|arobase|arroba)\b", re.IGNORECASE)
_DOT = re.compile(r"\b(?:dot|punkt|point|punto)\b", re.IGNORECASE)
_CUES = frozenset(
    "phone tel mobile call fax email mail contact at dot com org net ip address server host from card visa number pay "
    "telefon tél téléphone teléfono móvil handy mobil rufen anrufen appelez llame llámenos nummer numéro número courriel correo "
    "karte kreditkarte carte tarjeta adresse serveur servidor rechner de fr es punkt point punto arobase arroba".split()
)


def _worth(text: str) -> bool:
    return bool(_MARK.search(text)) or bool(_AT.search(text) and _DOT.search(text))


def _shape(token: str) -> str:
    if token[0].isdigit():
        n = len(token)
        return f"d{n if n <= 5 else '6-8' if n <= 8 else '9+'}"
    if token[0].isalpha():
        return "X" if token.isupper() else "Xx" if token[0].isupper() else "x"
    return token


def _value(token: str) -> str:
    return "b" if token.isdigit() and len(token) <= 3 and int(token) <= 255 else "-"


def encode(tokens: list[tuple[str, int, int]]) -> np.ndarray:
    """Hashed features of each token: (tokens, features)."""
    shapes = ["<", "<"] + [_shape(t) for t, _, _ in tokens] + [">", ">"]
    words = ["<"] + [w if (w := t.lower()) in _CUES else "" for t, _, _ in tokens] + [">"]
    glued = [True] + [a[2] == b[1] for a, b in zip(tokens, tokens[1:])] + [True]
    rows = []
    for i, (token, _, _) in enumerate(tokens):
        s, near = shapes[i : i + 5], "g" if glued[i] else "s"
        after = "g" if glued[i + 1] else "s"
        names = (
            f"0{s[2]}", f"1{s[1]}|{s[2]}{near}", f"2{s[2]}|{s[3]}{after}", f"3{s[1]}|{s[2]}|{s[3]}{near}{after}",
            f"4{s[0]}|{s[1]}|{s[2]}", f"5{s[2]}|{s[3]}|{s[4]}", f"6{words[i]}|{s[2]}", f"7{words[i + 1]}",
            f"8{words[i + 2]}|{s[2]}", f"9{_value(token)}{s[1]}{s[3]}",
        )
        rows.append([crc32(n.encode("utf-8", "surrogatepass")) % WEIGHTS for n in names])
    return np.array(rows, dtype=np.int32).reshape(len(tokens), -1)


def _padded(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(s) for s in sequences])
    out = np.zeros((len(sequences), sizes.max(), sequences[0].shape[1]), dtype=np.int32)
    for row, s in zip(out, sequences, strict=True):
        row[: len(s)] = s
    return out, sizes


@dataclass(frozen=True)
class Field:
    """``emit``: weight of each feature for each tag; ``move``: of each tag after another."""

    emit: np.ndarray
    move: np.ndarray

    def decode(self, sequences: list[np.ndarray]) -> list[np.ndarray]:
        """Most likely tags of every sequence; all sequences advance together."""
        feats, sizes = _padded(sequences)
        scores = sum(self.emit[feats[:, :, j]] for j in range(feats.shape[2]))
        n, longest, _ = scores.shape
        back = np.zeros((n, longest, len(TAGS)), dtype=np.int8)
        best = scores[:, 0] + self.move[-1]
        for t in range(1, longest):
            paths = best[:, :, None] + self.move[None, :-1]
            back[:, t] = paths.argmax(axis=1)
            step = paths.max(axis=1) + scores[:, t]
            best = np.where((t < sizes)[:, None], step, best)
        tags = best.argmax(axis=1)
        out = np.zeros((n, longest), dtype=np.int8)
        for t in range(longest - 1, -1, -1):
            live = t < sizes
            out[live, t] = tags[live]
            tags = np.where(live, back[np.arange(n), t, tags], tags)
        return [row[:size] for row, size in zip(out, sizes, strict=True)]


    def decode_blocks(self, blocks: Iterable[np.ndarray]) -> np.ndarray:
        """Most likely tags of one sequence that comes in blocks; a byte per token and tag is kept."""
        emit, move = self.emit.astype(np.float64), self.move.astype(np.float64)
        columns, best, back = np.arange(len(TAGS)), None, []
        for feats in blocks:
            scores = sum(emit[feats[:, j]] for j in range(feats.shape[1]))
            steps = np.zeros(scores.shape, dtype=np.int8)
            for t, row in enumerate(scores):
                paths = move[-1:] if best is None else best[:, None] + move[:-1]
                steps[t] = paths.argmax(axis=0)
                best = paths[steps[t], columns] + row
            back.append(steps)
        if best is None:
            return np.zeros(0, dtype=np.int8)
        tag, out = int(best.argmax()), []
        for steps in reversed(back):
            tags = np.zeros(len(steps), dtype=np.int8)
            for t in range(len(steps) - 1, -1, -1):
                tags[t] = tag
                tag = steps[t, tag]
            out.append(tags)
        return np.concatenate(out[::-1])


def _start() -> np.ndarray:
    """Transitions that no tagging may take are minus infinity in effect."""
    move = np.zeros((len(TAGS) + 1, len(TAGS)))
    for i, a in enumerate((*TAGS, "O")):
        for j, b in enumerate(TAGS):
            if b[0] == "I" and a[2:] != b[2:]:
                move[i, j] = -1e4
    return move


def fit(sentences: list[tuple[np.ndarray, np.ndarray]], epochs: int = 150, rate: float = 0.2, ridge: float = 1e-3) -> Field:
    """Maximum conditional likelihood by Adam; forward and backward in log space."""
    feats, sizes = _padded([f for f, _ in sentences])
    n, longest, _ = feats.shape
    gold = np.zeros((n, longest), dtype=np.int64)
    for row, (_, y) in zip(gold, sentences, strict=True):
        row[: len(y)] = y
    live = np.arange(longest)[None, :] < sizes[:, None]
    k, base = len(TAGS), _start()
    emit, move = np.zeros((WEIGHTS, k)), np.zeros((k + 1, k))
    state = [np.zeros_like(x) for x in (emit, emit, move, move)]
    hot = np.eye(k)[gold] * live[:, :, None]

    def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
        top = x.max(axis=axis, keepdims=True)
        return (np.log(np.exp(x - top).sum(axis=axis, keepdims=True)) + top).squeeze(axis)

    for epoch in range(1, epochs + 1):
        scores, trans = emit[feats].sum(axis=2), move + base
        alpha = np.zeros((n, longest, k))
        beta = np.zeros((n, longest, k))
        alpha[:, 0] = scores[:, 0] + trans[-1]
        for t in range(1, longest):
            step = log_sum(alpha[:, t - 1, :, None] + trans[None, :-1], 1) + scores[:, t]
            alpha[:, t] = np.where(live[:, t, None], step, alpha[:, t - 1])
        for t in range(longest - 2, -1, -1):
            step = log_sum(trans[None, :-1] + (scores[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
            beta[:, t] = np.where(live[:, t + 1, None], step, 0.0)
        norm = log_sum(alpha[:, -1], 1)
        single = np.exp(alpha + beta - norm[:, None, None]) * live[:, :, None]
        wrong = hot - single
        g_emit = np.zeros_like(emit)
        np.add.at(g_emit, feats, wrong[:, :, None, :])
        g_move = np.zeros_like(move)
        g_move[-1] = wrong[:, 0].sum(axis=0)
        pair = alpha[:, :-1, :, None] + trans[None, None, :-1] + (scores[:, 1:] + beta[:, 1:])[:, :, None, :]
        pair = np.exp(pair - norm[:, None, None, None]) * live[:, 1:, None, None]
        g_move[:-1] = np.einsum("nti,ntj->ij", hot[:, :-1] * live[:, 1:, None], hot[:, 1:]) - pair.sum(axis=(0, 1))
        for x, g, m, v in ((emit, g_emit - ridge * emit * n, *state[:2]), (move, g_move - ridge * move * n, *state[2:])):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            x += rate * (m / (1 - 0.9**epoch)) / (np.sqrt(v / (1 - 0.99**epoch)) + 1e-8)
    return Field(emit.astype(np.float32), (move + base).astype(np.float32))


def tokens_of(line: str, offset: int = 0) -> list[tuple[str, int, int]]:
    return [(m[0], m.start() + offset, m.end() + offset) for m in _TOKEN.finditer(line)]


def encoded_blocks(text: str, start: int, end: int, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Features of ``size`` tokens at a time, and where these begin and end; neighbours count across blocks."""
    tokens = ((m[0], m.start(), m.end()) for m in _TOKEN.finditer(text, start, end))
    before: list[tuple[str, int, int]] = []
    held = list(islice(tokens, size + 2))
    while held:
        body, ahead = held[:size], held[size:]
        rows = encode(before + held)[len(before) : len(before) + len(body)]
        yield rows, np.array([t[1:] for t in body], dtype=np.int64)
        before = (before + body)[-2:]
        held = ahead + list(islice(tokens, size + 2 - len(ahead)))


_MARKUP = re.compile(r"\[(email|ip|card|phone):([^\]]+)\]")

# A small labelled table: personal data in brackets, after its kind; the rest is none.
LABELLED = (
    "Write to [email:anna.lee@mail.example.org] for more.",
    "Contact [email:j_smith at post dot example dot com] today",
    "mail [email:bob (at) example (dot) net] or come by.",
    "Send it to [email:info@example] before noon.",
    "[email:kweber at example dot de] answers.",
    "or ask [email:tom at mail dot org] first",
    "contact [email:Maria at example dot net]",
    "Reach me: [email:maria[at]uni.example.es] thanks",
    "email [email:x9 @ example.com], please",
    "Call [phone:(555) 123-4567] after six.",
    "phone [phone:555-123-4567] or ask",
    "Tel. [phone:030 1234 5678] in the office",
    "Our fax is [phone:0049 30 123456].",
    "mobile: [phone:0171 2345678], evenings",
    "call [phone:1-800-555-0199] now",
    "Ring [phone:+1 555 010 0199] at home.",
    "His number is [phone:(020) 7946 0018] there",
    "Contact tel [phone:555.010.2233] for it",
    "Server at [ip:10.0.0.12] is down.",
    "from [ip:192.168.1.254] port 22",
    "Log in to host [ip:172.16.254.1:8080] again",
    "ip address [ip:85.100.119.253] seen",
    "Traffic of [ip:203 . 0 . 113 . 7] was cut",
    "Pay by card [card:4111 1111 1111 1111] here.",
    "visa [card:4012-8888-8888-1881] accepted",
    "card number [card:5500.0000.0000.0004], exp 09/27",
    "my card is [card:378282246310005] ok",
    "Card: [card:6011 0009 9013 9424] stolen",
    "In 2023 there were 12 people at the 3 gates.",
    "The price is 19.99 and 5 percent off 1200.",
    "Chapter 4.2.1 tells of 1815 and 1914.",
    "It was 10:45 on 2024-05-17 in room 12.",
    "We met at the sea at 7 and left at 9.",
    "Version 2.4.1 came at the end of 2019.",
    "He ran 42 km in 3:58:10, place 117 of 2300.",
    "See page 12-15 and table 3, row 4.",
    "token = 24be64439e3e49cf46b2d7c90f3602a3d0b907ff",
    "Order 4785380592391139 and 99812345678 were sent.",
    "On 05/06/2023 some 1,250,000 came at once",
    "The score at half time was 21-14 in 1998.",
    "key 8f14e45fceea167a5a36dedd4bea2543 is old",
    "@ 12 # 34 $ 56 at 78 % 9 & 10",
    "Be at ease; look at them at home.",
    "ISBN 978-3-16-148410-0 and DOI 10.1000/182 are listed",
    "Serial 0012-3345-11 of lot 20230605",
    "write me at [email:paul dot roth at post dot de] soon",
    "reach us at [email:info dot desk at firm dot com] or call 12",
    "find me at [email:mia at mail dot org] today",
    "We were at the dot on page 12 at noon.",
    "mail [email:rosa arroba correo punto es] gracias",
    "contacto [email:luis arroba empresa punto com]",
    "mail [email:zoe arobase courrier point fr] svp",
    "my number: [phone:98765 43210] any time",
    "call [phone:0151/23456789] or write",
    "Rufen Sie [phone:0171/2345678] an, danke",
    "Telefon: [phone:030 / 123 45 67], Büro",
    "Tel.: [phone:044 668 18 00] ab acht Uhr",
    "Meine Nummer ist [phone:0160 9876543], bis bald",
    "Handy [phone:0049 151 23456789] geht immer",
    "Schreiben Sie an [email:karl.maier at beispiel punkt de] bitte",
    "Mail an [email:eva (at) beispiel.de] oder kommen",
    "Der Server [ip:192 . 168 . 0 . 7] ist aus.",
    "Karte [card:4111.1111.1111.1111] gesperrt",
    "Im Jahr 1987 kamen 230 Leute in 14 Orte.",
    "Rechnung 2023/10-4477 vom 05.06.2023 über 1.299,00 Euro",
    "Die Strecke ist 12,5 km lang und 300 m hoch.",
    "Appelez le [phone:01 23 45 67 89] demain",
    "Tél. [phone:06.12.34.56.78] le soir",
    "mon numéro : [phone:06 98 76 54 32], merci",
    "Téléphone [phone:(02) 41 55 66 77] au bureau",
    "Courriel : [email:luc point martin arobase exemple point fr] merci",
    "écrivez à [email:anne at exemple dot fr] vite",
    "Le serveur [ip:10 . 1 . 2 . 3] ne répond pas.",
    "carte [card:5500.0000.0000.0004] refusée",
    "En 1789, 27 villes et 3 000 personnes",
    "Facture 2022-118 du 14/07/2022, total 85,40",
    "Page 12, ligne 7, colonne 3 du tome 2.",
    "Llame al [phone:91 123 45 67] por la tarde",
    "Teléfono: [phone:612 345 678], gracias",
    "mi número es [phone:655 12 34 56] y nada más",
    "Móvil [phone:0034 612 345 678] siempre",
    "Correo: [email:jose at ejemplo dot es] o venga",
    "escriba a [email:ana punto ruiz arroba ejemplo punto es] hoy",
    "El servidor [ip:172 . 16 . 4 . 9] está caído.",
    "tarjeta [card:4012.8888.8888.1881] robada",
    "En 1936 había 25 casas y 140 vecinos.",
    "Factura 2021/77 de 03-02-2021 por 1.050,75",
    "Capítulo 3, página 45, versos 12 a 18.",
)


def labelled_table(spark: SparkSession) -> DataFrame:
    """The small labelled table as rows of marked-up lines."""
    return spark.createDataFrame([(line,) for line in LABELLED], "line string")


def train(lines: Iterable[str]) -> Field:
    """A field learnt from lines with personal data in brackets."""
    sentences = []
    for line in lines:
        plain, spans, at = "", [], 0
        for m in _MARKUP.finditer(line):
            plain += line[at : m.start()]
            spans.append((m[1], len(plain), len(plain) + len(m[2])))
            plain, at = plain + m[2], m.end()
        plain += line[at:]
        tokens = tokens_of(plain)
        tags = np.zeros(len(tokens), dtype=np.int64)
        for kind, start, end in spans:
            inside = [i for i, (_, s, e) in enumerate(tokens) if start <= s and e <= end]
            tags[inside] = TAGS.index(f"I-{kind}")
            tags[inside[:1]] = TAGS.index(f"B-{kind}")
        if tokens:
            sentences.append((encode(tokens), tags))
    return fit(sentences)


_SPELT = re.compile(r"\b(?:at|arobase|arroba)\b.*(?:\b(?:dot|punkt|point|punto)\b|\.[a-z])", re.IGNORECASE | re.DOTALL)


def plausible(kind: str, text: str) -> bool:
    """Whether a decoded span can be of its kind at all."""
    digits = len(_NOT_DIGIT.sub("", text))
    if kind == "email":
        return "@" in text or bool(_SPELT.search(text))
    if kind == "ip":
        return 4 <= digits <= 17 and len(re.findall("[0-9]+", text)) >= 4
    if kind == "card":
        return 13 <= digits <= 19 and luhn(_NOT_DIGIT.sub("", text))
    return 7 <= digits <= 15


# Tokens decoded at once.
_BATCH = 4096
# Characters of a line that is decoded beside others; a longer one goes block by block, with equal results.
_TOGETHER = 1 << 14


def find_all(texts: list[str], field: Field) -> list[list[Span]]:
    """Base spans, and decoded spans that touch none of them, for each text."""
    found = [base_spans(t) for t in texts]
    taken = [merged((s, e) for _, s, e, _ in f) for f in found]
    waiting: list[tuple[int, np.ndarray, np.ndarray]] = []

    def add(i: int, places: np.ndarray, tags: np.ndarray) -> None:
        for at in np.flatnonzero(_BEGINS[tags]):
            kind, stop = TAGS[tags[at]][2:], at + 1
            while stop < len(tags) and TAGS[tags[stop]] == f"I-{kind}":
                stop += 1
            start, end = int(places[at, 0]), int(places[stop - 1, 1])
            if plausible(kind, texts[i][start:end]) and not touches(taken[i], start, end):
                found[i].append((f"crf_{kind}", start, end, False))

    def flush() -> None:
        for (i, places, _), tags in zip(waiting, field.decode([w[2] for w in waiting]), strict=True):
            add(i, places, tags)
        waiting.clear()

    held = 0
    for i, text in enumerate(texts):
        if not _worth(text):
            continue
        for line in _LINE.finditer(text):
            if not _worth(line[0]):
                continue
            if line.end() - line.start() > _TOGETHER:
                parts: list[np.ndarray] = []
                blocks = encoded_blocks(text, line.start(), line.end(), _BATCH)
                tags = field.decode_blocks(parts.append(p) or rows for rows, p in blocks)
                add(i, np.concatenate(parts), tags)
            elif tokens := tokens_of(line[0], line.start()):
                # Padding is to the longest, so unlike lengths do not share a batch.
                if waiting and (held + len(tokens) > _BATCH or len(tokens) > 4 * len(waiting[0][1])):
                    flush()
                    held = 0
                waiting.append((i, np.array([t[1:] for t in tokens], dtype=np.int64), encode(tokens)))
                held += len(tokens)
    if waiting:
        flush()
    return [sorted(f, key=lambda s: (s[1], KINDS.index(s[0]))) for f in found]


def find_personal_data(
    docs: DataFrame,
    labelled: DataFrame | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    most_labelled: int = 10_000,
) -> DataFrame:
    """One row per document: id and ``spans`` (kind, start, end, base).

    Spans of the fixed patterns stay as they are; those of the field have
    kinds that begin with ``crf_`` and touch none of them.  ``labelled`` is a
    small table of marked-up lines in a column ``line`` (the built-in table by
    default).  The field learns on the driver from its first ``most_labelled``
    lines by code point.  Whole texts are read; null counts as empty; rows
    equal to others are read like any other.
    """
    table = labelled if labelled is not None else labelled_table(docs.sparkSession)
    lines = table.select(F.col("line").cast("string").alias("line")).filter("line != ''").orderBy("line")
    field = train([r.line for r in lines.limit(most_labelled).collect()])
    return scan(docs, lambda texts: find_all(texts, field), id_col, text_col)
