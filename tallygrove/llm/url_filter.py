"""URL filter: host and path rules, and two character models for what no rule decides.

Accepted and rejected URLs teach one variable-order Markov model each.  Spark
counts all four-grams of an alphabet of 39 symbols, so the counts that reach
the driver have a fixed bound however many URLs there are; shorter contexts
follow from them.  A URL is judged by the difference of the log-likelihoods
per character, against a threshold calibrated on URLs that taught nothing.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrove.llm.shared import host_of, path_of, staged, type_of


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


# Fixed by the contract.
RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)

# Letters, a digit for all digits, marks, other, and the start.
_MARKS = "/.-_?=&#:%"
SYMBOLS = 26 + 1 + len(_MARKS) + 2
START, OTHER = SYMBOLS - 1, SYMBOLS - 2
GRAM = 4
_CODE = np.full(256, OTHER, dtype=np.int64)
_CODE[[ord(c) for c in "abcdefghijklmnopqrstuvwxyz"]] = np.arange(26)
_CODE[[ord(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"]] = np.arange(26)
_CODE[[ord(c) for c in "0123456789"]] = 26
_CODE[[ord(c) for c in _MARKS]] = 27 + np.arange(len(_MARKS))


def matched_rule(host: Column, path: Column, rules: Sequence[Rule] = RULES) -> Column:
    """Struct of text and verdict of the longest rule that fits, or null."""
    longest = sorted(rules, key=lambda r: len(r.text), reverse=True)

    def case(chain: Column | None, r: Rule) -> Column:
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        value = F.struct(F.lit(r.text).alias("text"), F.lit(r.verdict).alias("verdict"))
        return F.when(fits, value) if chain is None else chain.when(fits, value)

    return reduce(case, longest, None)


def gram_codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code of the four-gram that ends at each character, and the text it is in."""
    data = [t.encode("utf-8", "surrogatepass") for t in texts]
    sizes = np.array([len(d) for d in data], dtype=np.int64)
    lead = GRAM - 1
    padded = np.full(int((sizes + lead).sum()), START, dtype=np.int64)
    owner = np.repeat(np.arange(len(data)), sizes)
    places = np.arange(len(owner)) + (owner + 1) * lead
    padded[places] = _CODE[np.frombuffer(b"".join(data), dtype=np.uint8)]
    codes = np.zeros(len(owner), dtype=np.int64)
    for j in range(lead, -1, -1):
        codes = codes * SYMBOLS + padded[places - j]
    return codes, owner


def log_probabilities(counts: np.ndarray) -> np.ndarray:
    """Log probability of the last symbol of every four-gram.

    Each context leaves as much weight to the next shorter one as it has seen
    different symbols, so contexts reach as far as they were seen.
    """
    shaped = counts.reshape((SYMBOLS,) * GRAM).astype(np.float64)
    prob = np.full(SYMBOLS, 1.0 / SYMBOLS)
    for order in range(GRAM):
        seen = shaped.sum(axis=tuple(range(GRAM - 1 - order)))
        total = seen.sum(axis=-1, keepdims=True)
        kinds = (seen > 0).sum(axis=-1, keepdims=True)
        with np.errstate(invalid="ignore", divide="ignore"):
            prob = np.where(total > 0, (seen + kinds * prob) / (total + kinds), prob)
    return np.log(prob).ravel()


class Model(NamedTuple):
    """``ratio``: log accepted over rejected of each four-gram; blocked below ``threshold``."""

    ratio: np.ndarray
    threshold: float

    def scores(self, texts: list[str]) -> np.ndarray:
        codes, owner = gram_codes(texts)
        sums = np.bincount(owner, weights=self.ratio[codes], minlength=len(texts))
        return sums / np.maximum(1, np.bincount(owner, minlength=len(texts)))


def _counts(taught: DataFrame) -> dict[str, np.ndarray]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, owner = gram_codes(batch.column(1).to_pylist())
            blocked = np.array([v == "block" for v in batch.column(0).to_pylist()], dtype=np.int64)
            found, n = np.unique(codes * 2 + blocked[owner], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n)], ["code", "n"])

    parts = taught.select("verdict", "text").mapInArrow(run, "code bigint, n bigint")
    # At most two counts for each four-gram of the alphabet.
    table = parts.groupBy("code").agg(F.sum("n").alias("n")).toArrow()
    codes, n = (table.column(c).to_numpy() for c in ("code", "n"))
    out = {}
    for side, verdict in enumerate(("allow", "block")):
        out[verdict] = np.zeros(SYMBOLS**GRAM)
        own = codes % 2 == side
        out[verdict][codes[own] // 2] = n[own]
    return out


def _threshold(ratio: np.ndarray, kept: DataFrame) -> float:
    """The score that separates held-out verdicts best, by thousandths.

    Both verdicts weigh the same; the lowest of equally good cuts is taken, in
    the middle of the gap between the scores on its sides.
    """
    model = Model(ratio, 0.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = np.floor(model.scores(batch.column(1).to_pylist()) * 1000).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bins)], ["verdict", "bin"])

    counted = kept.select("verdict", "text").mapInArrow(run, "verdict string, bin bigint")
    rows = counted.groupBy("bin").agg(
        F.count_if(F.col("verdict") == "allow").alias("allow"), F.count_if(F.col("verdict") == "block").alias("block")
    ).collect()  # scores are bounded, and so are their thousandths
    rows.sort(key=lambda r: r.bin)
    allow, block = (np.array([r[v] for r in rows], dtype=float) for v in ("allow", "block"))
    if not len(rows) or not allow.sum() or not block.sum():
        return 0.0
    below_allow = np.concatenate([[0], np.cumsum(allow)]) / allow.sum()
    below_block = np.concatenate([[0], np.cumsum(block)]) / block.sum()
    cut = int(np.argmax(below_block - below_allow))
    above = rows[cut].bin if cut < len(rows) else rows[-1].bin + 1
    below = rows[cut - 1].bin + 1 if cut else above
    return (above + below) / 2000


def train(judged: DataFrame) -> Model | None:
    """The model of rows with ``verdict`` and ``text``; null without both verdicts.

    A quarter of the URLs, by checksum, only calibrates.
    """
    fold = F.crc32(F.col("text").cast("binary")) % 4
    counts = _counts(judged.filter(fold != 0))
    if not all(c.any() for c in counts.values()):
        return None
    ratio = log_probabilities(counts["allow"]) - log_probabilities(counts["block"])
    ratio = ratio.astype(np.float32)
    return Model(ratio, _threshold(ratio, judged.filter(fold == 0)))


def judge(
    pages: DataFrame, rules: Sequence[Rule] = RULES, id_col: str = "page_id", url_col: str = "url"
) -> DataFrame:
    """One row per page: id, host, path, rule, score, verdict.

    The longest fitting rule decides; else the models do, and with verdicts of
    one kind only, or without host and path, the URL is allowed.  A null URL,
    or one without ``://``, has empty host and path.  Equal URLs get equal
    verdicts.
    """
    url = pages[url_col].cast("string")
    rows = pages.select(pages[id_col].alias("id"), host_of(url).alias("host"), path_of(url).alias("path"))
    hit = matched_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("hit", hit).withColumn("text", F.concat("host", "path"))
    rows = staged(rows.select("id", "host", "path", F.col("hit.text").alias("rule"), F.col("hit.verdict").alias("given"), "text"), "urls")
    judged = rows.filter("given is not null").select(F.col("given").alias("verdict"), "text")
    model = train(judged)
    if model is None:
        scored, blocks = rows.withColumn("score", F.lit(None).cast("double")), F.lit(False)
    else:

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                scores = pa.array(model.scores(batch.column(5).to_pylist()))
                yield pa.RecordBatch.from_arrays([*batch.columns, scores], [*batch.schema.names, "score"])

        schema = f"id {type_of(rows, 'id')}, host string, path string, rule string, given string, text string, score double"
        scored = rows.select("id", "host", "path", "rule", "given", "text").mapInArrow(run, schema)
        blocks = (F.col("score") < model.threshold) & (F.col("text") != "")
    own = F.when(blocks, "block").otherwise("allow")
    return scored.select("id", "host", "path", "rule", "score", F.coalesce("given", own).alias("verdict"))
