"""Quality by compression: which of two zstandard dictionaries helps a text more.

One dictionary is trained on good and one on bad labelled documents.  A text is cut into
chunks of ``CHUNK`` bytes, so that the dictionary and not the text's own past decides;
each chunk is compressed with both.  The size difference over all chunks, divided by the
text's bytes, is the one feature; a logistic curve fitted on other labelled documents
turns it into the probability of label 1.

The fit uses a bounded sample of the labelled rows: about ``SAMPLE_DOCS`` of each label,
picked by a hash of their id; of a text beyond ``SAMPLE_CHARS`` characters so many in
``SAMPLE_PARTS`` parts spread over it; half train the dictionaries, half the curve.  Scoring covers every whole text and sees nothing else of a row.

Defined results: null text counts as empty; an empty text has difference 0 and so the
curve's value there; an id with two different labels, a null id or a null label teaches
nothing; with labels of one value only (or none) every score is that value (or 0.5).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK = 1024
LEVEL = 3
DICT_BYTES = 110 * 1024
SAMPLE_DOCS = 2_000
SAMPLE_CHARS = 16_000
SAMPLE_PARTS = 16
RATE_STEPS = 1_000_000


# A text, or the parts of a long one.
_SAMPLE = f"""
  if(length(text) <= {SAMPLE_CHARS}, text, array_join(transform(sequence(0, {SAMPLE_PARTS - 1}), i -> substring(text,
    cast(1 + i * cast(length(text) - {SAMPLE_CHARS // SAMPLE_PARTS} as long) div {SAMPLE_PARTS - 1} as int),
    {SAMPLE_CHARS // SAMPLE_PARTS})), ''))
"""


@dataclass(frozen=True)
class QualityModel:
    good: bytes
    bad: bytes
    slope: float
    intercept: float

    def scorer(self):
        """Difference and score of texts, with compressors made once."""
        import zstandard

        if not self.good or not self.bad:
            def flat(texts):
                return [0.0] * len(texts), [_sigmoid(self.intercept)] * len(texts)
            return flat
        make = []
        for content in (self.good, self.bad):
            shared = zstandard.ZstdCompressionDict(content)
            shared.precompute_compress(level=LEVEL)
            make.append(zstandard.ZstdCompressor(dict_data=shared, write_checksum=False, write_content_size=False,
                                                 write_dict_id=False).compress)

        def score(texts):
            diffs = []
            for text in texts:
                raw = memoryview((text or "").encode("utf-8", "replace"))
                good = bad = 0
                for at in range(0, len(raw), CHUNK):
                    chunk = raw[at:at + CHUNK]
                    good += len(make[0](chunk))
                    bad += len(make[1](chunk))
                diffs.append((bad - good) / len(raw) if len(raw) else 0.0)
            return diffs, [_sigmoid(self.slope * d + self.intercept) for d in diffs]
        return score


def _sigmoid(x: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(x, -30, 30))))


def fit_curve(diffs, labels, weights) -> tuple[float, float]:
    """Weighted logistic fit of one feature (Newton steps, a small ridge for separable labels)."""
    x = np.column_stack([np.asarray(diffs), np.ones(len(diffs))])
    scale = max(float(np.std(x[:, 0])), 1e-9)
    x[:, 0] /= scale
    y, w, beta = np.asarray(labels, float), np.asarray(weights, float), np.zeros(2)
    w = w / w.sum() * len(w)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (w * (y - p)) - 0.05 * beta
        hess = (x * (w * p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        beta += np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0] / scale), float(beta[1])


def fit_quality(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                label_col: str = "quality", learn: Column | None = None,
                sample_docs: int = SAMPLE_DOCS) -> QualityModel:
    """Fit on the labelled documents for which ``learn`` (a condition on the id) holds."""
    import zstandard

    key = F.col(f"`{id_col}`")
    known = labels.select(key.alias("id"), F.col(f"`{label_col}`").cast("int").alias("y")) \
        .where(F.col("id").isNotNull() & F.col("y").isin(0, 1))
    known = known.groupBy("id").agg(F.min("y").alias("y"), F.max("y").alias("top")).where("y = top").select("id", "y")
    texts = docs.select(key.alias("id"), F.col(f"`{text_col}`").alias("text"))
    if learn is not None:
        texts, known = texts.where(learn), known.where(learn)
    texts = texts.where(F.length("text") > 0)
    # Only labels that may be learned from, of documents that can be.
    known = known.join(texts.select("id"), "id", "left_semi")
    texts = texts.withColumnRenamed("id", "doc")
    counts = {r.y: r.n for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return QualityModel(b"", b"", 0.0, 0.0)
    # About ``sample_docs`` of each label: a share of the ids by hash, known from the counts.
    steps = {y: min(RATE_STEPS, max(1, round(RATE_STEPS * sample_docs / n))) for y, n in counts.items()}
    rate = F.when(F.col("y") == 1, steps.get(1, 0)).otherwise(steps.get(0, 0))
    picked = known.where(F.pmod(F.xxhash64("id", F.lit(29)), F.lit(RATE_STEPS)) < rate)
    rows = texts.join(F.broadcast(picked), texts.doc == picked.id).select("doc", "text", "y").dropDuplicates(["doc"]) \
        .select(F.expr(_SAMPLE).alias("text"), "y", F.pmod(F.xxhash64("doc", F.lit(31)), F.lit(2)).alias("half")).collect()
    parts = {(y, h): sorted(r.text for r in rows if r.y == y and r.half == h) for y in (0, 1) for h in (0, 1)}
    n1, n0 = (len(parts[y, 0]) + len(parts[y, 1]) for y in (1, 0))
    if not n1 or not n0:
        return QualityModel(b"", b"", 0.0, 30.0 if n1 else -30.0 if n0 else 0.0)

    def dictionary(texts: list[str]) -> bytes:
        raw = [t.encode("utf-8", "replace") for t in texts]
        try:
            return zstandard.train_dictionary(min(DICT_BYTES, max(1024, sum(map(len, raw)) // 10)), raw).as_bytes()
        except zstandard.ZstdError:                 # too little text to train on: use it as it is
            return b"\n".join(raw)[:DICT_BYTES] or b"\n"

    good, bad = dictionary(parts[1, 0] or parts[1, 1]), dictionary(parts[0, 0] or parts[0, 1])
    held = [(t, y) for y in (0, 1) for t in (parts[y, 1] or parts[y, 0])]
    diffs, _ = QualityModel(good, bad, 1.0, 0.0).scorer()([t for t, _ in held])
    # Weights give the labels the shares that they have among all documents to learn from.
    size = {y: sum(1 for _, l in held if l == y) for y in (0, 1)}
    slope, intercept = fit_curve(diffs, [y for _, y in held], [counts[y] / size[y] for _, y in held])
    return QualityModel(good, bad, slope, intercept)


def score_quality(docs: DataFrame, model: QualityModel, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size_difference, score) of every row; ``score`` is the probability of label 1."""
    src = docs.select(F.col(f"`{id_col}`").alias("doc"), F.col(f"`{text_col}`").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)    # two dictionaries of DICT_BYTES

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        score = shared.value.scorer()
        for batch in batches:
            diffs, scores = score(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(diffs, pa.float64()),
                                              pa.array(scores, pa.float64())], names=["doc", "size_difference", "score"])

    kind = src.schema["doc"].dataType.simpleString()
    return src.mapInArrow(run, f"doc {kind}, size_difference double, score double").withColumnRenamed("doc", id_col)
