"""The discriminant's scores against the same sums taken whole in numpy."""

from zlib import crc32

import numpy as np

from tallygrove.llm import quality_classifier as qc
from tallygrove.llm.queries import QUERIES
from tests.conftest import SMALL


def test_scores_of_every_document(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    marked = spark.read.parquet(f"{SMALL}/labels.parquet").filter("quality in (0, 1)").collect()
    x = {i: np.array(qc.statistics(t)) for i, t in docs.items()}
    taught = [(r.quality, x[r.doc_id]) for r in marked if r.doc_id in x and crc32(str(r.doc_id).encode()) % 4 != 2]
    classes = [np.array([v for c, v in taught if c == k]) for k in (0, 1)]
    width = len(qc.FEATURES)
    covers = [np.cov(c.T, bias=True) for c in classes]
    pooled = sum(len(c) * s for c, s in zip(classes, covers, strict=True)) / len(taught)
    scale = np.sqrt(np.maximum(np.diag(pooled), 1e-6))

    def log_density(v, mean, cover):
        """By inverse and determinant, not by factors."""
        unit = ((1 - qc.TO_POOLED) * cover + qc.TO_POOLED * pooled) / np.outer(scale, scale)
        level = max(np.trace(unit) / width, 1e-3)
        whole = ((1 - qc.TO_UNIT) * unit + qc.TO_UNIT * level * np.eye(width)) * np.outer(scale, scale)
        away = v - mean
        return -0.5 * (np.einsum("ij,jk,ik->i", away, np.linalg.inv(whole), away) + np.linalg.slogdet(whole)[1])

    def difference(v):
        rejected, accepted = (log_density(v, c.mean(0), s) for c, s in zip(classes, covers, strict=True))
        return accepted - rejected

    values = np.arcsinh(difference(np.array([v for _, v in taught])))
    label = np.array([float(c) for c, _ in taught])
    slope, offset = qc.calibrated(np.round(values * 100) / 100, label, np.ones(len(taught)))
    ids = sorted(docs)
    wanted = 1 / (1 + np.exp(-(slope * np.arcsinh(difference(np.array([x[i] for i in ids]))) + offset)))
    got = {r.doc_id: r for r in QUERIES["op5_quality_classifier"](spark, SMALL).collect()}
    assert np.allclose([got[i].score for i in ids], wanted, atol=1e-6)
    assert [got[i].predicted for i in ids] == [int(got[i].score >= 0.7) for i in ids]
