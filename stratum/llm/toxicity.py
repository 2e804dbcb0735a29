"""Toxicity by a subsequence string-kernel SVM with Nystroem landmarks (operator 5).

Words are compared by the gap-weighted subsequences of three characters they share, so
``id-iot``, ``i d i o t``, ``id iot`` and ``idxiot`` stay close to the insult they hide. The kernel against
a few hundred landmark words gives each word Nystroem features, a linear SVM on
them is trained on labelled sentences as bags of words, and a text is as toxic as
its worst sentence – that is, its worst word, where neighbouring words that no clean text knows are also read as
one word. The kernel's unit is the word: a phrase of harmless words has no kernel value of its own.

Nystroem features and the SVM are linear in the subsequence counts, so the fitted
model folds into one table of weights by subsequence: scoring costs a fixed number
of lookups a character, whatever the number of landmarks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from stratum.llm import arrow_text as at
from stratum.operators.joins import join_small
from stratum.session import checkpoint_root

ALPHABET = 64
FEATURES = ALPHABET ** 3
SPAN = 6
DECAY = 0.7
#: (first gap, second gap, weight) of the subsequences within ``SPAN`` characters.
GAPS = tuple((a, b, DECAY ** (a + b + 1)) for a in range(1, SPAN - 1) for b in range(1, SPAN - a))
#: Bounds of the training sample: documents of each class, words of each class, landmarks of each class.
MAX_DOCS, MAX_WORDS, LANDMARKS = 3000, 4000, 96
THRESHOLD = 0.3
ROUNDS = 3
NOT_ALNUM = r"[^\p{L}\p{N}]+"
#: Cells of the table of words seen in clean training texts, and the longest joined neighbours.
KNOWN_CELLS = 1 << 20
MAX_JOINED = 16
_START, _END = "\x02", "\x03"


def encode(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(codes, word of each code): letters and digits of the lower-cased words as 1..61 between
    a start and an end mark; everything else is left out."""
    cps = np.frombuffer("".join([f"\x00{_START}{w}{_END}" for w in words]).lower().encode("utf-32-le"), np.uint32)
    word = np.cumsum(cps == 0) - 1
    code = np.zeros(len(cps), np.int64)
    a = (cps >= 97) & (cps <= 122)
    code[a] = cps[a] - 96
    d = (cps >= 48) & (cps <= 57)
    code[d] = cps[d] - 48 + 27
    other = (cps >= 0xC0) & ~((cps >= 0x2000) & (cps <= 0x206F)) & ~((cps >= 0x3000) & (cps <= 0x303F))
    code[other] = 37 + cps[other] % 25
    code[cps == 2], code[cps == 3] = 62, 63
    keep = code > 0
    return code[keep], word[keep]


def subsequences(code: np.ndarray, word: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """(feature, word, weight) of every gapped triple, one gap pattern at a time."""
    for a, b, weight in GAPS:
        n = len(code) - a - b
        if n <= 0:
            continue
        same = word[:n] == word[a + b:]
        feature = code[:n] * (ALPHABET * ALPHABET) + code[a:n + a] * ALPHABET + code[a + b:]
        yield feature[same], word[:n][same], weight


@dataclass(frozen=True)
class Model:
    """Weights by subsequence, bias, the logistic calibration of the worst word's margin, and the words of clean texts."""

    weights: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0
    known: np.ndarray | None = None

    def knows(self, words: pa.Array) -> np.ndarray:
        """Whether each word was seen in a clean training text (or shares its cell with one that was)."""
        return np.ones(len(words), bool) if self.known is None else self.known[known_cells(words)]

    def margins(self, words: list[str]) -> np.ndarray:
        if not words:
            return np.zeros(0)
        code, word = encode(words)
        total, square = np.zeros(len(words)), np.zeros(len(words))
        for feature, w, weight in subsequences(code, word):
            total += np.bincount(w, weight * self.weights[feature], len(words))
            square += weight * weight * np.bincount(w, minlength=len(words))
        return total / np.sqrt(np.maximum(square, 1e-9)) + self.bias

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * margin + self.shift, -30, 30)))


def known_cells(words: pa.Array) -> np.ndarray:
    low = pc.replace_substring_regex(pc.utf8_lower(words), NOT_ALNUM, "")
    return (at.mix(at.word_hashes(low, at.KEYS[:1])[0]) % np.uint64(KNOWN_CELLS)).astype(np.int64)


def kernel_rows(words: list[str], columns: dict[int, int]) -> np.ndarray:
    """Normalised subsequence counts of the words over the listed features (dense)."""
    code, word = encode(words)
    table = np.full(FEATURES, -1, np.int64)
    table[list(columns)] = list(columns.values())
    out, square = np.zeros((len(words), len(columns)), np.float32), np.zeros(len(words))
    for feature, w, weight in subsequences(code, word):
        at_ = table[feature]
        hit = at_ >= 0
        np.add.at(out, (w[hit], at_[hit]), np.float32(weight))
        square += weight * weight * np.bincount(w, minlength=len(words))
    return out / np.sqrt(np.maximum(square, 1e-9))[:, None].astype(np.float32)


def features_of(words: list[str]) -> dict[int, int]:
    code, word = encode(words)
    found = [f for f, _, _ in subsequences(code, word)]
    return {int(f): i for i, f in enumerate(np.unique(np.concatenate(found)))} if found else {}


def fit_svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 1e-3, steps: int = 40) -> np.ndarray:
    """Squared-hinge linear SVM with bias by Newton steps with halving; returns weights and bias."""
    x = np.hstack([x, np.ones((len(x), 1))])
    reg = penalty * np.eye(x.shape[1])
    reg[-1, -1] = 1e-8
    w = np.zeros(x.shape[1])

    def loss(w):
        slack = np.maximum(0, 1 - y * (x @ w))
        return 0.5 * w @ reg @ w + 0.5 * (weight * slack * slack).sum()

    value = loss(w)
    for _ in range(steps):
        slack = 1 - y * (x @ w)
        on = slack > 0
        grad = reg @ w - x[on].T @ (weight[on] * y[on] * slack[on])
        step = np.linalg.solve(reg + (x[on] * weight[on, None]).T @ x[on], grad)
        size = 1.0
        while size > 1e-4 and (new := loss(w - size * step)) > value:
            size /= 2
        if size <= 1e-4 or value - new < 1e-9 * (1 + value):
            break
        w, value = w - size * step, new
    return w


def fit_words(positive: list[str], negative: list[str], times: np.ndarray) -> Model:
    """Nystroem features against landmarks of both classes, then the SVM, folded into weights by
    subsequence. ``times`` weighs the positive words."""
    marks = list(dict.fromkeys(positive[:LANDMARKS] + negative[:LANDMARKS]))
    columns = features_of(marks)
    rows = kernel_rows(marks, columns).astype(np.float64)
    values, vectors = np.linalg.eigh(rows @ rows.T)
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    basis = rows.T @ root  # from subsequences to Nystroem features
    x = np.vstack([kernel_rows(words[i:i + 2000], columns).astype(np.float64) @ basis
                   for words in (positive, negative) for i in range(0, len(words), 2000)])
    y = np.r_[np.ones(len(positive)), -np.ones(len(negative))]
    weight = np.r_[times / times.sum(), np.full(len(negative), 1 / len(negative))]
    w = fit_svm(x, y, weight)
    weights = np.zeros(FEATURES)
    weights[list(columns)] = basis @ w[:-1]
    return Model(weights, float(w[-1]))


def calibrate(model: Model, margin: np.ndarray, label: np.ndarray, prior: float) -> Model:
    """Logistic fit of the labels on the margins with smoothed targets; ``prior`` is the
    share of toxic ones among all labelled rows, which the sample need not keep."""
    n1, n0 = label.sum(), (1 - label).sum()
    target = np.where(label > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([margin, np.ones(len(margin))], 1)
    weight = np.where(label > 0, prior / max(n1, 1), (1 - prior) / max(n0, 1))
    b = np.array([1.0, 0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        grad = x.T @ (weight * (p - target)) + np.array([1e-4 * b[0], 0.0])
        hess = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + 1e-4 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        b = b - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return replace(model, slope=float(max(b[0], 1e-3)), shift=float(b[1]))


def spelled_out(offsets: np.ndarray, words: pa.Array) -> list[tuple[int, str]]:
    """(row, joined word) of every run of three or more one-character words of a row."""
    one = pc.equal(pc.utf8_length(words), 1).to_numpy(zero_copy_only=False)
    if not one.any():
        return []
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    key = np.where(one, row, -1)
    return [(int(row[a]), "".join(words[a:b].to_pylist())) for a, b in at.groups(key) if key[a] >= 0 and b - a >= 3]


def joined_neighbours(model: Model, offsets: np.ndarray, values: pa.Array, codes: np.ndarray) -> list[tuple[np.ndarray, str]]:
    """(rows, joined word) of two neighbouring words of which one at least is unknown: an insult broken by a blank
    leaves such pieces, while known words next to each other are prose."""
    known = model.knows(values)
    size = pc.utf8_length(values).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    a, b = codes[:-1], codes[1:]
    pick = np.flatnonzero((row[:-1] == row[1:]) & ~(known[a] & known[b]) & (size[a] + size[b] <= MAX_JOINED))
    if len(pick) == 0:
        return []
    pair = a[pick].astype(np.int64) * len(values) + b[pick]
    order = np.argsort(pair, kind="stable")
    out = []
    for lo, hi in at.groups(pair[order]):
        x, y = divmod(int(pair[order[lo]]), len(values))
        out.append((row[pick[order[lo:hi]]], values[x].as_py() + values[y].as_py()))
    return out


def worst_words(model: Model | None, text: pa.Array) -> tuple[np.ndarray, list[str | None]]:
    """(margin, word) of each text's worst word; -1 and none without words (and without a model)."""
    n = len(text)
    best, which = np.full(n, -1.0), [None] * n
    if model is None:
        return best, which
    offsets, words = at.split_words(text)
    if len(words) == 0:
        return best, which
    coded = words.dictionary_encode()
    values = coded.dictionary.to_pylist()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    margin = model.margins(values)[codes]
    for i in range(n):
        lo, hi = offsets[i], offsets[i + 1]
        if hi > lo:
            k = lo + int(np.argmax(margin[lo:hi]))
            best[i], which[i] = margin[k], values[codes[k]]
    joined = [(np.array([i]), w) for i, w in spelled_out(offsets, words)]
    joined += joined_neighbours(model, offsets, coded.dictionary, codes)
    for (rows, word), m in zip(joined, model.margins([w for _, w in joined]), strict=True):
        for i in rows.tolist():
            if m > best[i]:
                best[i], which[i] = m, word
    return best, which


def held_out(id_col):
    return F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(4)) == 2


def training_sample(docs: DataFrame, labels: DataFrame, max_docs: int, id_col: str, text_col: str) -> tuple[DataFrame, float]:
    """(text, toxic) and the share of toxic labels: at most about ``max_docs`` labelled documents of each class, by a hash of
    the id; no row whose id's remainder is held out. A document labelled twice counts as toxic when either says so."""
    y = labels.where(F.col(id_col).isNotNull() & F.col("toxic").isNotNull()).where(~held_out(F.col(id_col))).groupBy(id_col).agg(F.max("toxic").alias("toxic"))
    counts = {r["toxic"]: r["n"] for r in y.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.lit(0.0)
    for label, n in counts.items():
        share = F.when(F.col("toxic") == label, F.lit(min(1.0, max_docs / n))).otherwise(share)
    part = F.pmod(F.xxhash64(F.col(id_col), F.lit(17)), F.lit(1_000_000)) < share * 1_000_000
    chosen = y.where(part).withColumnRenamed(id_col, "_id")
    own = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("text")).where(F.col("text").isNotNull())
    return join_small(own, chosen.select(F.col("_id").cast("long").alias("_id"), F.col("toxic").cast("int").alias("toxic")),
                      "_id", "inner").dropDuplicates(["_id"]), counts.get(1, 0) / max(1, sum(counts.values()))


def word_evidence(sample: DataFrame) -> DataFrame:
    """(word, pos, neg): labelled texts of each class with the word, lower-cased, letters and digits only.

    A text's sentences carry its label; as a text counts a word once, so do its sentences."""
    def run(batches):
        for batch in batches:
            for part in at.slices(batch, 0):
                offsets, words = at.split_words(part.column(0))
                low = pc.replace_substring_regex(pc.utf8_lower(words), NOT_ALNUM, "")
                row = np.repeat(np.arange(part.num_rows), np.diff(offsets))
                coded = low.dictionary_encode()
                pairs = np.unique(row * (len(coded.dictionary) + 1) + coded.indices.to_numpy(zero_copy_only=False)) if len(low) else np.zeros(0, np.int64)
                r, c = np.divmod(pairs, len(coded.dictionary) + 1)
                label = part.column(1).to_numpy(zero_copy_only=False)[r]
                yield pa.RecordBatch.from_arrays([coded.dictionary.cast(pa.string()).take(pa.array(c)), pa.array(label.astype(np.int64))],
                                                 names=["word", "toxic"])

    pairs = sample.select("text", "toxic").mapInArrow(run, "word string, toxic long")
    return pairs.where(F.length("word") >= 3).groupBy("word").agg(
        F.sum("toxic").alias("pos"), F.sum(1 - F.col("toxic")).alias("neg"))


def train(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS, max_words: int = MAX_WORDS,
          id_col: str = "doc_id", text_col: str = "text") -> Model | None:
    """Fits on a bounded sample of labelled rows (``max_docs`` of each class, ``max_words`` words of each class).

    The first round sets the words whose evidence for toxic texts is strongest (log-likelihood
    ratio) against words of clean texts. Later rounds are those of a multiple-instance SVM: words of toxic texts that
    the model finds on the toxic side are witnesses and turn positive, the words of clean texts that
    come closest join the negatives. The evidence counts whatever there is of it: a handful of labelled rows is fitted like
    many. None when no toxic or no clean text with a word is labelled, or no word is more frequent in toxic texts: nothing
    tells the classes apart then, and every text scores 0.
    """
    checkpoint_root(docs.sparkSession)
    sample, prior = training_sample(docs, labels, max_docs, id_col, text_col)
    sample = sample.select("text", "toxic").checkpoint()
    n = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = n.get(1, 0), n.get(0, 0)
    if not n1 or not n0:
        return None
    a, b = F.col("pos"), F.col("neg")
    rate = (a + b) / F.lit(n1 + n0)
    llr = 2 * (a * F.log(F.greatest(a, F.lit(1e-9)) / (rate * n1)) + b * F.log(F.greatest(b, F.lit(1e-9)) / (rate * n0)))
    skewed = a / F.lit(n1) > 8 * (b / F.lit(n0))
    words = word_evidence(sample).withColumn("llr", llr).withColumn("skewed", skewed).checkpoint()
    frequent = [r.word for r in words.where(b > 0).orderBy(F.desc("neg"), "word").limit(LANDMARKS // 2).collect()]
    spread = [r.word for r in words.where((b > 0) & ~F.col("skewed")).orderBy(F.xxhash64("word"), "word").limit(max_words).collect()]
    first = words.where(F.col("skewed")).orderBy(F.desc("llr"), "word").limit(max_words).collect()
    if not first or not spread:
        return None
    positive = witnesses(sample.where(F.col("toxic") == 1), {r.word: r.llr for r in first})
    hard: list[str] = []
    for _ in range(ROUNDS):
        order = sorted(positive, key=lambda w: (-positive[w], w))
        negative = [w for w in dict.fromkeys(hard[:LANDMARKS // 2] + frequent + hard + spread) if w not in positive]
        model = fit_words(order, negative, np.array([positive[w] for w in order], float))
        margins = word_margins(words, model)
        hard = [x.word for x in margins.where(~F.col("skewed") & (b > 0)).orderBy(F.desc("margin"), "word").limit(max_words).collect()]
        # words only toxic texts hold that come as close as the witnesses do
        more = margins.where(F.col("skewed") & (F.col("margin") > 0.5)).orderBy(F.desc("margin"), "word").limit(max_words).collect()
        positive = {x.word: 1 for x in more} | positive
    model = replace(model, known=known_words(sample))
    rows = worst_of(sample, model).collect()
    return calibrate(model, np.array([x["margin"] for x in rows]), np.array([x["toxic"] for x in rows]), prior)


def known_words(sample: DataFrame) -> np.ndarray:
    """Table of the cells of all words of the sampled clean texts: ``KNOWN_CELLS`` cells, whatever the texts hold."""
    def run(batches):
        seen = np.zeros(KNOWN_CELLS, bool)
        for batch in batches:
            for part in at.slices(batch, 0):
                seen[known_cells(at.split_words(part.column(0))[1])] = True
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(seen))], names=["cell"])

    table = np.zeros(KNOWN_CELLS, bool)
    cells = sample.where(F.col("toxic") == 0).select("text").mapInArrow(run, "cell long").distinct()
    table[[r.cell for r in cells.collect()]] = True
    return table


def witnesses(toxic: DataFrame, evidence: dict[str, float], share: float = 0.5) -> dict[str, int]:
    """How many of the sampled toxic texts each word stands for: a text's strongest word, and those with
    ``share`` of its evidence. Words that only copies of one text share are weaker than the real ones, so they rarely stand."""
    shared = toxic.sparkSession.sparkContext.broadcast(evidence)

    def run(batches):
        table = shared.value
        for batch in batches:
            found = []
            for part in at.slices(batch, 0):
                offsets, words = at.split_words(part.column(0))
                low = pc.replace_substring_regex(pc.utf8_lower(words), NOT_ALNUM, "")
                for i in range(part.num_rows):
                    own = {w: table[w] for w in low[offsets[i]:offsets[i + 1]].to_pylist() if w in table}
                    best = max(own.values(), default=0)
                    found += [w for w, x in own.items() if x >= share * best]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], names=["word"])

    return {r.word: r["n"] for r in toxic.select("text").mapInArrow(run, "word string").groupBy("word").agg(
        F.count(F.lit(1)).alias("n")).collect()}


def word_margins(words: DataFrame, model: Model) -> DataFrame:
    shared = words.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            margin = shared.value.margins(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(margin)], names=[*batch.schema.names, "margin"])

    return words.mapInArrow(run, StructType([*words.schema.fields, StructField("margin", DoubleType())]))


def worst_of(sample: DataFrame, model: Model) -> DataFrame:
    shared = sample.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for part in at.slices(batch, 0):
                margin, word = worst_words(shared.value, part.column(0))
                yield pa.RecordBatch.from_arrays([part.column(1).cast(pa.int32()), pa.array(margin), pa.array(word, pa.string())],
                                                 names=["toxic", "margin", "word"])

    return sample.select("text", "toxic").mapInArrow(run, "toxic int, margin double, word string")


def score(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 at ``THRESHOLD`` or more) for every row.

    Map-only; whole texts. Null, empty and blank texts have no words and get the score of
    the margin -1, that of a plainly clean word. Without a model every score is 0. Input columns named score or predicted
    are replaced; other columns pass through."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop("score", "predicted")
    place = docs.columns.index(text_col)
    names = [*docs.columns, "score", "predicted"]

    def run(batches):
        m = shared.value
        for batch in batches:
            for part in at.slices(batch, place):
                margin, _ = worst_words(m, part.column(place))
                p = m.probability(margin) if m is not None else np.zeros(len(margin))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(p), pa.array((p >= THRESHOLD).astype(np.int32))], names=names)

    schema = StructType([*docs.schema.fields, StructField("score", DoubleType()), StructField("predicted", IntegerType())])
    return docs.mapInArrow(run, schema)
