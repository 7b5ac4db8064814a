"""Language identification with error-correcting output codes.

Every language gets a codeword of -1 and +1. For each position of the codewords a binary classifier over hashed
byte 3-grams (logistic regression) predicts the bit of a text. Decoding adds up, for each language, the logistic losses
of the predicted bits against its codeword, each weighted by how well that classifier did on that language in training,
and takes the language with the smallest loss. A text is ambiguous when the runner-up is nearly as probable.

Few languages get the exhaustive code (every way to split them in two), more than six get random codewords chosen for
their mutual distance. Learning uses a bounded sample (``per_language`` texts per language, about, picked by hash).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topicflow.llm.words import text_blocks

GRAMS = 1 << 12  # hashed 3-grams
STEPS = 200
RIDGE = 1e-4
ROWS = 256  # texts turned into features at a time
SHARPNESS = 1.0
UNKNOWN = "und"


def _letters() -> np.ndarray:
    """Lower-cased ASCII letters and all other non-ASCII bytes; everything else is a blank."""
    table = np.full(256, 32, np.uint8)
    table[0x80:] = np.arange(0x80, 0x100)
    for letter in range(ord("a"), ord("z") + 1):
        table[letter] = table[letter - 32] = letter
    return table


_LETTERS = _letters()


def features(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(index of the first text, rows x GRAMS): square roots of 3-gram shares, so every row has length 1 or is zero."""
    for first, data, offsets in text_blocks(column):
        codes = _LETTERS[data].astype(np.uint32)
        for begin in range(0, len(offsets) - 1, ROWS):
            bounds = offsets[begin : begin + ROWS + 1]
            count = len(bounds) - 1
            piece = codes[bounds[0] : bounds[-1]]
            table = np.zeros((count, GRAMS), np.float32)
            if len(piece) >= 3:
                grams = (piece[:-2] << np.uint32(16)) | (piece[1:-1] << np.uint32(8)) | piece[2:]
                cells = (grams * np.uint32(0x9E3779B1)) >> np.uint32(20)
                text = np.repeat(np.arange(count), np.diff(bounds))
                whole = text[:-2] == text[2:]  # a 3-gram lies within one text
                places = text[:-2][whole] * GRAMS + cells[whole]
                table = np.bincount(places, minlength=count * GRAMS).reshape(count, GRAMS).astype(np.float32)
            table /= np.maximum(table.sum(axis=1, keepdims=True), 1)
            yield first + begin, np.sqrt(table)


def codewords(languages: int) -> np.ndarray:
    """languages x bits, each -1 or 1; no bit is the same for all languages."""
    if languages < 2:
        return np.ones((languages, 0), np.int8)
    if languages <= 6:
        bits = np.arange(1, 2 ** (languages - 1))
        return np.stack([np.where(bits >> k & 1, 1, -1) for k in range(languages)]).astype(np.int8)
    length, best = int(np.ceil(10 * np.log2(languages))), None
    for seed in range(200):
        code = np.random.default_rng(seed).choice(np.array([-1, 1], np.int8), (languages, length))
        distance = (length - code.astype(np.int32) @ code.T) // 2 + length * np.eye(languages, dtype=np.int64)
        if (np.abs(code.sum(axis=0)) < languages).all() and (best is None or distance.min() > best[0]):
            best = distance.min(), code
    return best[1]


class Model:
    """The bit classifiers and the code. ``languages`` may be empty: then every text is ``und``."""

    def __init__(self, languages: list[str], rows: np.ndarray, labels: np.ndarray):
        """rows: training features; labels: index into ``languages`` of each row."""
        self.languages = languages
        self.code = codewords(len(languages))
        bits = self.code.shape[1]
        self.weights = np.zeros((GRAMS, bits), np.float32)
        self.bias = np.zeros(bits, np.float32)
        self.trust = np.full(self.code.shape, 1 / max(bits, 1))
        if bits:
            self._learn(rows, self.code[labels].astype(np.float32), labels)

    def _learn(self, rows: np.ndarray, targets: np.ndarray, labels: np.ndarray) -> None:
        """All bits at once, by gradient steps with momentum. Languages weigh the same however often they occur."""
        share = 1 / np.maximum(np.bincount(labels, minlength=len(self.languages)), 1)[labels]
        share = (share / share.sum()).astype(np.float32)[:, None]
        speed, drift = np.zeros_like(self.weights), np.zeros_like(self.bias)
        for _ in range(STEPS):
            pull = -targets / (1 + np.exp(np.clip(targets * self.bits(rows), -30, 30))) * share
            speed = 0.9 * speed - 8.0 * (rows.T @ pull + RIDGE * self.weights)
            drift = 0.9 * drift - 0.5 * pull.sum(axis=0)
            self.weights += speed
            self.bias += drift
        right = (np.sign(self.bits(rows)) == targets).astype(np.float64)
        for k in range(len(self.languages)):
            accuracy = right[labels == k].mean(axis=0) if (labels == k).any() else np.ones(right.shape[1])
            self.trust[k] = (accuracy + 1e-6) / (accuracy + 1e-6).sum()

    def bits(self, rows: np.ndarray) -> np.ndarray:
        return rows @ self.weights + self.bias

    def probabilities(self, rows: np.ndarray) -> np.ndarray:
        """rows x languages, from the loss-weighted distances to the codewords."""
        outputs = self.bits(rows).astype(np.float64)
        losses = np.stack(
            [
                (np.logaddexp(0, -outputs * word) * trust).sum(axis=1) * len(word)
                for word, trust in zip(self.code, self.trust, strict=True)
            ],
            axis=1,
        )
        odds = np.exp(SHARPNESS * (losses.min(axis=1, keepdims=True) - losses))
        return odds / odds.sum(axis=1, keepdims=True)


def _sampled_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, table in features(batch.column("text")):
            rows = pa.array([row.tobytes() for row in table.astype(np.float16)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("lang").slice(first, len(table)), rows], ["lang", "row"])


def train(docs: DataFrame, per_language: int = 400) -> Model:
    """Learn from the rows of ``docs`` (text, lang) that have both and a letter in the text.

    Counts cover all different texts; the sample is by hash of the text, about ``per_language`` texts of each language
    and never more than twice that number of any. Copies count once.
    """
    usable = docs.where("lang is not null and text is not null").select(
        F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")
    )
    different = usable.select("lang", F.xxhash64("text").alias("hash")).distinct()
    counts = {row.lang: row.n for row in different.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(counts)
    if not languages:
        return Model([], np.empty((0, GRAMS), np.float32), np.empty(0, np.int64))
    rates = usable.sparkSession.createDataFrame(
        [(lang, min(1.0, per_language / counts[lang])) for lang in languages], "lang string, rate double"
    )
    by_hash = Window.partitionBy("lang").orderBy(F.expr("pmod(xxhash64(text), 1000003)"), "text")
    sample = (
        usable.join(F.broadcast(rates), "lang")  # one row per language
        .where(r"pmod(xxhash64(text), 1000003) / 1000003 <= rate and text rlike '\\p{L}'")
        .select("lang", "text")
        .distinct()
        .withColumn("rank", F.row_number().over(by_hash))
        .where(F.col("rank") <= 2 * per_language)
        .select("lang", "text")
        .mapInArrow(_sampled_features, "lang string, row binary")
        .toLocalIterator()
    )
    numbers = {lang: i for i, lang in enumerate(languages)}
    pairs = [(numbers[row.lang], bytes(row.row)) for row in sample]
    rows = np.frombuffer(b"".join(row for _, row in pairs), np.float16).astype(np.float32).reshape(-1, GRAMS)
    return Model(languages, rows, np.array([k for k, _ in pairs], np.int64))


def _predicted(batches: Iterator[pa.RecordBatch], model: Model, margin: float) -> Iterator[pa.RecordBatch]:
    letter = regex.compile(r"\p{L}")
    for batch in batches:
        texts = batch.column("text").to_pylist()
        names, scores, unsure = [], [], []
        for first, table in features(batch.column("text")):
            chances = model.probabilities(table) if model.languages else np.zeros((len(table), 1))
            ranked = np.sort(chances, axis=1)
            best, gap = chances.argmax(axis=1), ranked[:, -1] - (ranked[:, -2] if chances.shape[1] > 1 else 0)
            for i in range(len(table)):
                known = bool(model.languages) and bool(texts[first + i]) and letter.search(texts[first + i]) is not None
                names.append(model.languages[best[i]] if known else UNKNOWN)
                scores.append(float(chances[i, best[i]]) if known else 0.0)
                unsure.append(bool(not known or (len(model.languages) > 1 and gap[i] < margin)))
        added = [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(unsure, pa.bool_())]
        rest = [batch.column(name) for name in batch.schema.names if name != "text"]
        rest_names = [name for name in batch.schema.names if name != "text"]
        yield pa.RecordBatch.from_arrays(rest + added, [*rest_names, "lang_pred", "score", "ambiguous"])


def predict(docs: DataFrame, model: Model, margin: float = 0.05) -> DataFrame:
    """(doc_id, lang_pred, score, ambiguous) for every row of ``docs`` (doc_id, text).

    Null, empty and letterless texts are ``und`` with score 0 and ambiguous. ``ambiguous`` is also set where the two
    nearest languages are within ``margin`` of each other in probability. Ties go to the smaller language name. Null
    and repeated ids are predicted row by row. An empty table gives no rows.
    """
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).mapInArrow(
        lambda batches: _predicted(batches, model, margin),
        "doc_id bigint, lang_pred string, score double, ambiguous boolean",
    )


def _accepted(batches: Iterator[pa.RecordBatch], model: Model, margin: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        judged = next(iter(_predicted(iter([batch.select(["text"])]), model, margin)))
        rejected = judged.column("ambiguous").to_numpy(zero_copy_only=False)
        yield batch.filter(pa.array(~rejected))


def accepted(docs: DataFrame, model: Model, margin: float = 0.05) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose language is neither unknown nor ambiguous.

    Null, empty and letterless texts go. Repeated rows and rows without id are judged row by row. An empty table stays empty.
    """
    return docs.mapInArrow(lambda batches: _accepted(batches, model, margin), docs.schema)
