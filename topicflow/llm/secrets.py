"""Secret scans: a random forest over candidates removes the false positives of a broad pattern.

Candidates are long runs of token characters, shorter values that are directly assigned to a name that speaks of a secret,
and the bodies of private keys. Each is described by its length, its character transitions, how far the
letter groups of the corpus (its dictionary) cover it, the path of its document and the words around it. The forest is
trained by Spark on labelled findings; its trees, a table of bounded size, then judge candidates where they lie, so
neither findings nor texts are shuffled.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicflow.llm.words import text_blocks
from topicflow.storage import fresh_folder

# '=' only ends a token (padding), so that in KEY=value the name stays in front of the value; the body of a PEM key is one
CANDIDATE = (
    r"(?<![A-Za-z0-9+/_-])(?:(?=[A-Za-z+/_-]*[0-9])[A-Za-z0-9+/_-]{16,}+|[A-Za-z0-9+/_-]{20,}+)"
    r"(?:={1,2}(?![A-Za-z0-9+/=_-]))?"
    r"|(?<=PRIVATE KEY-----)(?:[A-Za-z0-9+/=\s]|\\[nr]){16,}+"
)
BEFORE, AFTER = 48, 24  # characters around a candidate that count as its neighbourhood
SECRET_WORDS = re.compile(r"(?i)secret|token|passw|pwd|api.?key|access.?key|private.?key|credential|bearer|auth")
MOCK_WORDS = re.compile(r"(?i)example|sample|dummy|placeholder|changeme|test|xxxx")
# what stands before a secret: a name and a mark of assignment (an author is no such name), or 'Bearer'; BEFORE at most
CONTEXT = (
    r"(?:(?:secret|token|passw|pwd|(?:api|access|private)[ _-]?key|credential|auth(?!or(?!i[sz])))\w{0,20}[\"']?\s{0,4}"
    r"(?::=|=>|[:=])\s{0,4}(?:[\"']?(?:bearer|basic|token)\s{1,4})?|(?<![A-Za-z])bearer\s{1,4}|PRIVATE KEY-----)[\"']?"
)
ASSIGNED = re.compile(rf"(?i){CONTEXT}$")
# a directly assigned value may be shorter than other candidates: anything in quotes, or a token with a digit
DIRECT = re.compile(
    rf"(?i){CONTEXT}(?:(?<=[\"'])(?P<quoted>[!#-&(-~]{{6,}}+)(?=[\"'])|(?P<bare>(?=[A-Za-z+/_-]*+[0-9])"
    r"[A-Za-z0-9+/_-]{6,}+(?:\.[A-Za-z0-9_-]{8,}+){0,2}(?:={1,2}(?![A-Za-z0-9+/=_-]))?))",
    re.ASCII,
)
LETTERS = 27  # a to z and everything else
WORD_BUCKETS, PATH_BUCKETS = 8, 4
MASK = "[SECRET]"

FEATURES = [
    "length", "digits", "capitals", "class_changes", "transition_odds", "dictionary_cover", "entropy", "hex",
    "distinct", "quoted", "assigned", "secret_word", "mock_word",
    *(f"word_{i}" for i in range(WORD_BUCKETS)), *(f"path_{i}" for i in range(PATH_BUCKETS)),
]


def _letter_table() -> np.ndarray:
    table = np.full(256, LETTERS - 1, np.int64)
    for i in range(26):
        table[ord("a") + i] = table[ord("A") + i] = i
    return table


_LETTER = _letter_table()


def _triples(codes: np.ndarray) -> np.ndarray:
    return (codes[:-2] * LETTERS + codes[1:-1]) * LETTERS + codes[2:]


def _counted_triples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(LETTERS**3, np.int64)
    for batch in batches:
        for _, data, offsets in text_blocks(batch.column("text")):
            triples = _triples(_LETTER[data])
            ends = offsets[1:-1]
            keep = np.ones(len(triples), bool)
            for shift in (1, 2):  # a triple lies within one text
                cut = ends - shift
                keep[cut[(cut >= 0) & (cut < len(keep))]] = False
            total += np.bincount(triples[keep], minlength=LETTERS**3)
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["triple", "n"])


class Dictionary:
    """Letter statistics of the whole corpus: a fixed table of 27 ** 3 counts."""

    def __init__(self, counts: np.ndarray, common: float = 2e-5):
        cube = counts.reshape(LETTERS, LETTERS, LETTERS).astype(np.float64)
        pairs = cube.sum(axis=2) + 0.5
        self.odds = np.log(pairs / pairs.sum(axis=1, keepdims=True)).astype(np.float32)
        letters = cube[:26, :26, :26]
        self.common = np.zeros_like(cube, bool)
        self.common[:26, :26, :26] = letters > common * max(letters.sum(), 1)
        self.common = self.common.reshape(-1)


def dictionary(docs: DataFrame) -> Dictionary:
    counted = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(
        _counted_triples, "triple bigint, n bigint"
    )
    counts = np.zeros(LETTERS**3, np.int64)
    for row in counted.groupBy("triple").agg(F.sum("n").alias("n")).collect():  # at most 27 ** 3 rows
        counts[row.triple] = row.n
    return Dictionary(counts)


def describe(value: str, before: str, after: str, path: str, known: Dictionary) -> list[float]:
    """The features of one candidate, in the order of ``FEATURES``."""
    raw = np.frombuffer(value.encode("ascii"), np.uint8)
    digit = (raw >= 48) & (raw <= 57)
    upper = (raw >= 65) & (raw <= 90)
    lower = (raw >= 97) & (raw <= 122)
    kind = digit + 2 * upper + 3 * lower
    letters = _LETTER[raw]
    pairs = (letters[:-1] < 26) & (letters[1:] < 26)
    odds = known.odds[letters[:-1], letters[1:]][pairs]
    share = np.bincount(raw)
    share = share[share > 0] / len(raw)
    words = re.findall(r"[A-Za-z]{2,}", f"{before} {after}".lower())
    buckets = [0.0] * (WORD_BUCKETS + PATH_BUCKETS)
    for word in words:
        buckets[zlib.crc32(word.encode()) % WORD_BUCKETS] += 1.0
    for part in re.findall(r"[A-Za-z]{2,}", path.lower()):
        buckets[WORD_BUCKETS + zlib.crc32(part.encode()) % PATH_BUCKETS] += 1.0
    near = before[-BEFORE:]
    hexes = digit | ((raw >= 97) & (raw <= 102)) | ((raw >= 65) & (raw <= 70))
    return [
        float(len(raw)),
        float(digit.mean()),
        float(upper.mean()),
        float((kind[1:] != kind[:-1]).mean()),
        float(odds.mean()) if len(odds) else -6.0,
        float(known.common[_triples(letters)].mean()),
        float(-(share * np.log2(share)).sum()),
        float(hexes.mean()),
        len(share) / len(raw),
        float(near[-1:] in "\"'" and near != ""),
        float(re.search(r"[:=]\s*[\"']?$", near) is not None or ASSIGNED.search(near) is not None),
        float(SECRET_WORDS.search(near) is not None),
        float(MOCK_WORDS.search(near) is not None or MOCK_WORDS.search(value) is not None),
        *buckets,
    ]


def candidates(text: str) -> Iterator[tuple[int, int, str, str, str]]:
    """(start, end, value, text before, text after) of every candidate in a text; places count characters."""
    spans = [found.span(found.lastgroup) for found in DIRECT.finditer(text)]
    at, last = 0, len(spans)
    for found in re.finditer(CANDIDATE, text, re.ASCII):
        while at < last and spans[at][1] <= found.start():
            at += 1
        if at == last or found.end() <= spans[at][0]:  # else it is, or is within, a directly assigned value
            spans.append(found.span())
    for start, end in sorted(spans):
        yield start, end, text[start:end], text[max(0, start - BEFORE) : start], text[end : end + AFTER]


def rule_label(value: str, before: str, after: str) -> int:
    """A finding's label by rule, where no labelled ones are given: assigned to a name that speaks of a secret, or
    behind 'Bearer' or the head of a private key."""
    return int(ASSIGNED.search(before) is not None and MOCK_WORDS.search(before + value) is None)


def _labelled(batches: Iterator[pa.RecordBatch], known: Dictionary, label) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, labels = [], []
        for text, path in zip(batch.column("text").to_pylist(), batch.column("path").to_pylist(), strict=True):
            for _, _, value, before, after in candidates(text or ""):
                rows.append(describe(value, before, after, path or "", known))
                labels.append(float(label(value, before, after)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows, pa.list_(pa.float64())), pa.array(labels, pa.float64())], ["described", "label"]
        )


class Forest:
    """A trained forest as arrays: per tree the feature, threshold, children and probability of every node."""

    def __init__(self, trees: list[tuple[np.ndarray, ...]]):
        self.trees = trees

    def probability(self, rows: np.ndarray) -> np.ndarray:
        """Of being a secret; 0 where there is no tree."""
        total = np.zeros(len(rows))
        for feature, threshold, left, right, chance in self.trees:
            at = np.zeros(len(rows), np.int64)
            while True:
                inner = left[at] >= 0
                if not inner.any():
                    break
                low = rows[np.arange(len(rows)), np.maximum(feature[at], 0)] <= threshold[at]
                at = np.where(inner, np.where(low, left[at], right[at]), at)
            total += chance[at]
        return total / max(len(self.trees), 1)


def train(
    docs: DataFrame, known: Dictionary, per_label: int = 4000, label=rule_label, trees: int = 20, depth: int = 6
) -> Forest:
    """Fit the forest to the findings in ``docs`` (text, path), labelled by ``label(value, before, after)``.

    Of each label about ``per_label`` different findings are used, picked by hash, and never more than twice that;
    findings with equal features count once. Without findings of both labels the forest is
    empty and calls nothing a secret.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("text").cast("string").alias("text"), F.col("path").cast("string").alias("path"))
    found = texts.mapInArrow(lambda rows: _labelled(rows, known, label), "described array<double>, label double")
    found = found.distinct().withColumn("pick", F.pmod(F.xxhash64("described"), F.lit(1_000_003)) / 1_000_003)
    folder = fresh_folder(spark, "findings")
    found.write.parquet(folder)
    found = spark.read.parquet(folder)
    counts = {row.label: row.n for row in found.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        return Forest([])
    sample = found.limit(0)
    for value, n in sorted(counts.items()):
        chosen = found.where((F.col("label") == value) & (F.col("pick") <= per_label / n))
        sample = sample.union(chosen.orderBy("pick", "described").limit(2 * per_label))
    rarer = min(counts.values())
    weights = F.lit(1.0)
    for value, n in counts.items():
        weights = F.when(F.col("label") == value, rarer / min(n, max(per_label, rarer))).otherwise(weights)
    sample = sample.select("label", array_to_vector("described").alias("features"), weights.alias("weight"))
    learner = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=7, weightCol="weight", maxBins=64)
    folder = fresh_folder(spark, "forest")
    learner.fit(sample).write().overwrite().save(folder)
    return _read_forest(spark.read.parquet(f"{folder}/data"))


def _read_forest(saved: DataFrame) -> Forest:
    """The trees of a saved forest: at most trees * 2 ** (depth + 1) rows."""
    fields = {name: name for name in saved.columns}
    node = "nodeData." if "nodeData" in fields else ""
    rows = saved.selectExpr(
        "treeID as tree", f"{node}id as id", f"{node}leftChild as l", f"{node}rightChild as r",
        f"{node}split.featureIndex as feature", f"{node}split.leftCategoriesOrThreshold as cut",
        f"{node}impurityStats as stats",
    ).collect()
    trees = []
    for tree in sorted({row.tree for row in rows}):
        nodes = sorted((row for row in rows if row.tree == tree), key=lambda row: row.id)
        trees.append(
            (
                np.array([row.feature for row in nodes], np.int64),
                np.array([row.cut[0] if row.cut else 0.0 for row in nodes]),
                np.array([row.l for row in nodes], np.int64),
                np.array([row.r for row in nodes], np.int64),
                np.array([row.stats[1] / max(sum(row.stats), 1e-12) for row in nodes]),
            )
        )
    return Forest(trees)


def _judged(text: str | None, path: str | None, known: Dictionary, forest: Forest):
    found = list(candidates(text or ""))
    if not found:
        return [], np.empty(0)
    rows = np.array([describe(value, before, after, path or "", known) for _, _, value, before, after in found])
    return found, forest.probability(rows)


def _scanned(batches: Iterator[pa.RecordBatch], known: Dictionary, forest: Forest) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.float64()]
    for batch in batches:
        rows = []
        for doc_id, text, path in zip(*(batch.column(n).to_pylist() for n in ("doc_id", "text", "path")), strict=True):
            found, chances = _judged(text, path, known, forest)
            for (start, end, value, _, _), chance in zip(found, chances.tolist(), strict=True):
                rows.append((doc_id, start, end, hashlib.sha256(value.encode()).hexdigest(), chance))
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)],
            ["doc_id", "start", "end", "value_sha256", "score"],
        )


def scan(docs: DataFrame, known: Dictionary, forest: Forest, threshold: float = 0.5) -> DataFrame:
    """(doc_id, start, end, value_sha256, score, is_secret) for every candidate in ``docs`` (doc_id, text, path).

    Places count characters. ``is_secret`` is false for the false positives that the forest removes. Null and empty
    texts have no candidates, a null path is an empty one; repeated rows and null ids are reported row by row.
    Other columns are ignored. An empty table gives no rows.
    """
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.col("path").cast("string").alias("path"),
    ).mapInArrow(
        lambda batches: _scanned(batches, known, forest),
        "doc_id bigint, start bigint, end bigint, value_sha256 string, score double",
    )
    return rows.withColumn("is_secret", F.col("score") >= threshold)


def masked(text: str | None, path: str | None, known: Dictionary, forest: Forest, threshold: float) -> str | None:
    found, chances = _judged(text, path, known, forest)
    for (start, end, *_), chance in reversed(list(zip(found, chances.tolist(), strict=True))):
        if chance >= threshold:
            text = text[:start] + MASK + text[end:]
    return text


def _redacted(batches, path_column, known, forest, threshold) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").to_pylist()
        paths = batch.column(path_column).to_pylist() if path_column else [None] * len(texts)
        new = [masked(t, None if p is None else str(p), known, forest, threshold) for t, p in zip(texts, paths, strict=True)]
        at = batch.schema.get_field_index("text")
        batch = batch.set_column(at, batch.schema.field(at), pa.array(new, batch.schema.field(at).type))
        if "n_chars" in batch.schema.names:
            at = batch.schema.get_field_index("n_chars")
            old = batch.column(at).to_pylist()
            sizes = [o if a == b else len(b) for o, a, b in zip(old, texts, new, strict=True)]
            batch = batch.set_column(at, batch.schema.field(at), pa.array(sizes, batch.schema.field(at).type))
        yield batch


def redacted(
    docs: DataFrame, known: Dictionary, forest: Forest, path_column: str | None = None, threshold: float = 0.5
) -> DataFrame:
    """``docs`` with each secret in ``text`` replaced by ``[SECRET]``; ``n_chars``, where it is a column, follows.

    Null and empty texts and texts without secrets stay as they are. Repeated rows and rows without id are treated row by row, other columns
    are kept whatever their names; an empty table stays empty.
    """
    return docs.mapInArrow(lambda batches: _redacted(batches, path_column, known, forest, threshold), docs.schema)
