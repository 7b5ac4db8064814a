"""Toxicity by a string-kernel support vector machine with Nystroem landmarks.

The kernel of two words counts the letter subsequences they share, ``ORDER`` letters that may have gaps between them as
long as they span at most ``SPAN`` letters; each occurrence weighs ``DECAY`` to the power of its span. So an insult still
matches when letters or marks are put between its letters. The blanks around a word count as its first and last letter.
A sentence's kernel is the sum over its words.

Landmarks are letter groups that tell toxic from other training texts, and frequent words of the others. Kernel values to the
landmarks, whitened by the landmarks' own kernel matrix, are the features of a linear support vector machine trained on
sentences: of each labelled text the sentence that scores highest, chosen anew in each round. As the machine is linear
in the kernel values, it folds into one weight for each hashed subsequence; a text is then scored by looking up its
subsequences. A text's score is that of its most toxic sentence, made a probability by a fitted logistic curve.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicflow.storage import fresh_folder, stored

from topicflow.llm.words import mixed

ORDER, SPAN, DECAY = 4, 7, 0.6
BITS = 18
LANDMARKS, PLAIN_WORDS = 128, 32
SAME = 0.7  # a landmark with a larger cosine to one already chosen is left out
GRAM_BITS = 20
BLOCK_CHARS = 1 << 19
ROUNDS = 4
COMBOS = [(0, *rest) for rest in combinations(range(1, SPAN), ORDER - 1)]


def _break_codes() -> tuple[np.ndarray, np.ndarray]:
    """For the first 256 code points: is it white space, and does it end a sentence."""
    space, stop = np.zeros(256, bool), np.zeros(256, bool)
    space[[*range(0x21), 0x85, 0xA0]] = True
    stop[[ord(c) for c in ".!?\n"]] = True
    return space, stop


_SPACE, _STOP = _break_codes()
_TABLES = (mixed(np.arange(1, ORDER * 256 + 1, dtype=np.uint64)) >> np.uint64(64 - BITS)).astype(np.uint32).reshape(ORDER, 256)


class Letters:
    """Texts joined into one array of letter codes, with the starts of texts and of sentences.

    A text begins at the blank before it, so that its first word has one as every other word.
    """

    def __init__(self, texts: list[str]):
        joined = "\n" + "\n".join(texts) + "\n" * (SPAN + 1)
        # lower-casing letter by letter keeps the places
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        lowered = joined.lower()
        if len(lowered) == len(joined):
            low = np.frombuffer(lowered.encode("utf-32-le", "surrogatepass"), np.uint32)
        else:
            low = np.array([ord(c.lower()[0]) for c in joined], np.uint32)
        sizes = np.array([len(t) + 1 for t in texts], np.int64)
        self.text_starts = np.cumsum(sizes) - sizes
        narrow = np.minimum(points, 255).astype(np.int64)
        self.space = _SPACE[narrow] & (points < 256)
        self.codes = ((low ^ (low >> 8) * 31) & 0xFF).astype(np.uint8)
        self.points = np.where(self.space, np.uint32(32), low)
        count = len(self.codes)
        self.codes[self.space] = 32
        stops = np.where(self.space, np.arange(count), count)
        following = np.append(np.minimum.accumulate(stops[::-1])[::-1][1:], count)  # the next blank after each place
        self.room = (following + 1 - np.arange(count))[: count - SPAN]
        ends = _STOP[narrow] & (points < 256)
        # a stop ends a sentence when white space follows, so that marks inside a word don't
        ends[:-1] &= self.space[1:] | (points[:-1] == 10)
        starts = np.zeros(count, bool)
        starts[1:] = ends[:-1]
        starts[self.text_starts] = True
        self.sentence_starts = np.flatnonzero(starts[: count - SPAN])

    def subsequences(self) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
        """(places of the first letter, hashed subsequence, weight) for every shape of gaps."""
        parts = [table[self.codes] for table in _TABLES]
        fits = {last: np.flatnonzero(self.room > last) for last in range(ORDER - 1, SPAN)}
        for combo in COMBOS:
            at = fits[combo[-1]]
            value = parts[0][at]
            for part, shift in zip(parts[1:], combo[1:], strict=True):
                value = value ^ part[at + shift]
            yield at, value, DECAY ** (combo[-1] + 1)

    def sums(self, weights: np.ndarray) -> np.ndarray:
        """The sum of subsequence weights that begin in each sentence."""
        per_letter = np.zeros(len(self.room), np.float64)
        for at, value, decay in self.subsequences():
            per_letter[at] += weights[value] * decay
        return np.add.reduceat(per_letter, self.sentence_starts) if len(self.room) else np.empty(0)

    def best_sentences(self, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each text its highest sentence sum and that sentence's number."""
        sums = self.sums(weights)
        first = np.searchsorted(self.sentence_starts, self.text_starts)
        best = np.maximum.reduceat(sums, first)
        owner = np.searchsorted(first, np.arange(len(sums)), "right") - 1
        order = np.lexsort((np.arange(len(sums)), -sums, owner))
        return best, order[np.searchsorted(owner[order], np.arange(len(first)))]


def text_groups(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    begin, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > BLOCK_CHARS:
            yield begin, texts[begin:i]
            begin, size = i, 0
        size += len(text) + 1
    if begin < len(texts):
        yield begin, texts[begin:]


def _profile(group: str) -> dict[int, float]:
    """The weighted subsequences of a group of letters, which may begin and end with a blank."""
    found: Counter[int] = Counter()
    for at, value, decay in Letters([group]).subsequences():
        last = round(np.log(decay) / np.log(DECAY)) - 1
        for one in value[(at > 0) & (at + last <= len(group))].tolist():
            found[one] += decay
    return dict(found)


def _letter_groups(groups: list[tuple[Letters, np.ndarray]]) -> list[tuple[float, str]]:
    """Groups of 4 to 7 letters of a word and its blanks, by how much more often toxic texts have them; best first."""
    spots: dict[int, tuple[int, int, int]] = {}
    scored = []
    for size in (4, 5, 6, 7):
        counts = np.zeros((2, 1 << GRAM_BITS), np.int64)
        cells = []
        for letters, labels in groups:
            at = np.flatnonzero(letters.room > size - 1)
            value = np.zeros(len(at), np.uint64)
            for shift in range(size):
                value = mixed(value * np.uint64(31) + letters.points[at + shift].astype(np.uint64))
            cell = (value >> np.uint64(64 - GRAM_BITS)).astype(np.int64)
            text = np.searchsorted(letters.text_starts, at, "right") - 1
            once = np.unique(text << GRAM_BITS | cell)
            for label in (0, 1):
                mine = labels[once >> GRAM_BITS] == label
                counts[label] += np.bincount(once[mine] & ((1 << GRAM_BITS) - 1), minlength=1 << GRAM_BITS)
            cells.append((at, cell))
        totals = [max(1, sum(int((labels == k).sum()) for _, labels in groups)) for k in (0, 1)]
        odds = np.log((counts[1] + 0.5) / totals[1]) - np.log((counts[0] + 0.5) / totals[0])
        gain = counts[1] / totals[1] * odds
        gain[(counts[1] < 5) | (odds < 1)] = 0
        top = np.argsort(-gain, kind="stable")[: 8 * LANDMARKS]
        wanted = {int(c) for c in top if gain[c] > 0}
        for number, (at, cell) in enumerate(cells):
            if wanted:
                hits = np.flatnonzero(np.isin(cell, list(wanted)))
                for i in hits.tolist():
                    c = int(cell[i])
                    if c in wanted:
                        wanted.discard(c)
                        spots[c] = (number, int(at[i]), size)
                        letters = groups[number][0]
                        word = "".join(map(chr, letters.points[at[i] : at[i] + size].tolist()))
                        scored.append((float(gain[c]), word))
    return sorted(scored, key=lambda pair: (-pair[0], pair[1]))


class Model:
    """Weights of hashed subsequences, and the logistic curve over a text's highest sentence sum."""

    def __init__(self, weights: np.ndarray, slope: float, shift: float):
        self.weights, self.slope, self.shift = weights, slope, shift

    def scores(self, texts: list[str]) -> np.ndarray:
        out = np.empty(len(texts))
        for begin, group in text_groups(texts):
            best, _ = Letters(group).best_sentences(self.weights)
            out[begin : begin + len(group)] = best
        return 1 / (1 + np.exp(-np.clip(self.slope * out + self.shift, -40, 40)))


def _hinge(rows: np.ndarray, targets: np.ndarray, weights: np.ndarray, cost: float = 30.0) -> tuple[np.ndarray, float]:
    """A linear machine with squared hinge loss, by Newton steps."""
    extended = np.hstack([rows, np.ones((len(rows), 1))])
    w = np.zeros(extended.shape[1])
    ridge = np.eye(len(w))
    ridge[-1, -1] = 1e-6
    for _ in range(30):
        active = targets * (extended @ w) < 1
        some = extended[active] * weights[active, None]
        step = np.linalg.solve(ridge + cost * some.T @ extended[active], cost * some.T @ targets[active])
        if np.allclose(step, w, atol=1e-8):
            break
        w = step
    return w[:-1], float(w[-1])


def _curve(values: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve, by Newton steps."""
    w = np.zeros(2)
    rows = np.stack([values, np.ones(len(values))], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(rows @ w, -30, 30)))
        push = rows.T @ (labels - p) - 1e-3 * w
        curve = (rows * (p * (1 - p))[:, None]).T @ rows + 1e-3 * np.eye(2)
        w = w + np.linalg.solve(curve, push)
    return float(w[0]), float(w[1])


def fit(texts: list[str], labels: np.ndarray) -> Model:
    """Train on labelled texts (0 or 1). With one label only, everything gets that label's share as its score."""
    none = np.zeros(1 << BITS, np.float32)
    if not len(texts) or labels.min() == labels.max():
        return Model(none, 0.0, 10.0 if len(texts) and labels.max() == 1 else -10.0)
    groups = [(Letters(group), labels[begin : begin + len(group)]) for begin, group in text_groups(texts)]
    landmarks: list[dict[int, float]] = []
    first = none.copy()
    for gain, word in _letter_groups(groups):
        profile = _profile(word)
        size = sum(v * v for v in profile.values()) ** 0.5
        if not size or any(_cosine(profile, other) > SAME for other in landmarks):
            continue
        landmarks.append(profile)
        for cell, value in profile.items():
            first[cell] = max(first[cell], gain * value / size)
        if len(landmarks) == LANDMARKS:
            break
    common = Counter(w for t, k in zip(texts, labels.tolist(), strict=True) if not k for w in set(t.lower().split()))
    for word, _ in sorted(common.items(), key=lambda pair: (-pair[1], pair[0])):
        profile = _profile(f" {word} ")
        if len(landmarks) >= LANDMARKS + PLAIN_WORDS:
            break
        if profile and not any(_cosine(profile, other) > SAME for other in landmarks):
            landmarks.append(profile)
    cells = np.array(sorted({cell for profile in landmarks for cell in profile}), np.int64)
    matrix = np.zeros((len(cells) + 1, len(landmarks)))
    for k, profile in enumerate(landmarks):
        for cell, value in profile.items():
            matrix[np.searchsorted(cells, cell), k] = value
    matrix /= np.maximum(np.linalg.norm(matrix, axis=0), 1e-12)
    values, vectors = np.linalg.eigh(matrix.T @ matrix)
    whiten = vectors @ np.diag(np.maximum(values, 1e-3) ** -0.5) @ vectors.T
    place = np.full(1 << BITS, len(cells), np.int64)
    place[cells] = np.arange(len(cells))

    weights = first
    share = np.array([1.0, 1.0])
    for label in (0, 1):
        share[label] = len(labels) / (2 * max(1, int((labels == label).sum())))
    for _ in range(ROUNDS):
        rows, targets = [], []
        for letters, marks in groups:
            _, chosen = letters.best_sentences(weights)
            rows.append(_sentence_features(letters, chosen, place, matrix) @ whiten)
            targets.append(np.where(marks == 1, 1.0, -1.0))
        goal = np.concatenate(targets)
        machine, bias = _hinge(np.concatenate(rows), goal, np.where(goal > 0, share[1], share[0]))
        folded = matrix @ (whiten @ machine)
        weights = np.zeros(1 << BITS, np.float32)
        weights[cells] = folded[:-1]
    best = np.concatenate([letters.best_sentences(weights)[0] for letters, _ in groups])
    return Model(weights, *_curve(best, labels.astype(np.float64)))


def _cosine(one: dict[int, float], two: dict[int, float]) -> float:
    inner = sum(v * two.get(c, 0.0) for c, v in one.items())
    return inner / max(1e-12, (sum(v * v for v in one.values()) * sum(v * v for v in two.values())) ** 0.5)


def _sentence_features(letters: Letters, chosen: np.ndarray, place: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """Kernel values of the chosen sentences to all landmarks."""
    rank = np.full(len(letters.sentence_starts), -1, np.int64)
    rank[chosen] = np.arange(len(chosen))
    out = np.zeros((len(chosen), matrix.shape[1]))
    for at, value, decay in letters.subsequences():
        row = rank[np.searchsorted(letters.sentence_starts, at, "right") - 1]
        cell = place[value]
        used = (row >= 0) & (cell < len(matrix) - 1)
        np.add.at(out, row[used], matrix[cell[used]] * decay)
    return out


PICK = "pmod({}, 1000003) / 1000003"  # a place in [0, 1) by hash of the text


def train(labelled: DataFrame, per_label: int = 1500) -> Model:
    """Learn from ``labelled`` (text, toxic): about ``per_label`` different texts of each label, picked by hash of the
    text, and never more than twice that; copies count once. Rows with null text or label, or another label than 0 or 1,
    are left out."""
    usable = labelled.where("text is not null").select(F.monotonically_increasing_id().alias("doc_id"), "text", "toxic")
    kept = stored(usable, fresh_folder(labelled.sparkSession, "labelled"))
    return train_by_id(kept, kept.select("doc_id", "toxic"), per_label)


def train_by_id(docs: DataFrame, labels: DataFrame, per_label: int = 1500) -> Model:
    """Learn from ``docs`` (doc_id, text) whose ``labels`` (doc_id, toxic) say 0 or 1, as :func:`train` does.

    Only ids and hashes of texts are joined with the labels. The picked texts, ``4 * per_label`` at most, are fetched afterwards by
    id and hash. Rows without id have no label; a text with both labels is learned under both.
    """
    texts = docs.where("doc_id is not null and text is not null").select("doc_id", F.col("text").cast("string").alias("text"))
    texts = texts.withColumn("hash", F.xxhash64("text"))
    marks = labels.where("toxic in (0, 1)").select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    met = texts.select("doc_id", "hash").join(marks, "doc_id").groupBy("toxic", "hash").agg(F.min("doc_id").alias("doc_id"))
    different = stored(met, fresh_folder(docs.sparkSession, "labelled-hashes"))
    counts = {row.toxic: row.n for row in different.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    place, picked = F.expr(PICK.format("hash")), []
    for label, n in sorted(counts.items()):
        chosen = different.where((F.col("toxic") == label) & (place <= per_label / n))
        picked += chosen.orderBy(place, "hash").limit(2 * per_label).collect()
    if not picked:
        return fit([], np.empty(0, np.int64))
    wanted = F.broadcast(docs.sparkSession.createDataFrame(picked, different.schema))  # 4 * per_label rows at most
    rows = texts.join(wanted, ["doc_id", "hash"]).select("text", "toxic").distinct().collect()
    rows.sort(key=lambda row: (row.text, row.toxic))
    return fit([row.text for row in rows], np.array([row.toxic for row in rows], np.int64))


def _scored(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        scores = model.scores([text or "" for text in batch.column("text").to_pylist()])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(scores, pa.float64()), pa.array((scores >= 0.5).astype(np.int32))],
            ["doc_id", "score", "predicted"],
        )


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, predicted) for every row of ``docs`` (doc_id, text).

    ``score`` is a probability, ``predicted`` is 1 from 0.5 on. Null and empty texts score like a text without any
    landmark's letters. Repeated rows and null ids are scored row by row. An empty table gives no rows.
    """
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).mapInArrow(lambda batches: _scored(batches, model), "doc_id bigint, score double, predicted int")
