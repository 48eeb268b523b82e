"""Language identification with error-correcting output codes.

Each language has a codeword of bits; for each bit a binary classifier over hashed byte
n-grams tells the languages with a 1 from those with a 0. A text's margins are decoded to
the codeword with the least summed loss.

The n-gram counts cover every training text. Defined cases: a null text or one without a
letter gets `und` and score 0; without any training text every text does; with one learned
language every other text gets that; rows are predicted one by one, so repeated rows agree;
an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "und"
FEATURES = 1 << 14
ORDERS = (2, 3)
FOLDS = 5
# Evidence of so many n-grams at most makes a margin.
MOST_EVIDENCE = 50
# Below this score two codewords are too near each other.
AMBIGUOUS = 0.6
EXHAUSTIVE_UP_TO = 7


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's text modulo ``folds``; a null id counts as the empty text."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.pmod(F.crc32(text), F.lit(folds))


def features(text: str, dims: int = FEATURES) -> np.ndarray:
    """Hashed n-grams of the lower-cased UTF-8 bytes; other ASCII than letters is a space."""
    data = np.frombuffer(text.lower().encode("utf-8", "replace"), np.uint8)
    letter = (data >= 128) | ((data >= 97) & (data <= 122))
    data = np.where(letter, data, 32).astype(np.uint32)
    found = []
    for order in ORDERS:
        if len(data) >= order:
            code = np.full(len(data) - order + 1, order, np.uint32)
            for i in range(order):
                code = code * np.uint32(0x01000193) ^ data[i : len(data) - order + 1 + i]
            found.append((code ^ (code >> np.uint32(15))) % np.uint32(dims))
    return np.concatenate(found).astype(np.int64) if found else np.zeros(0, np.int64)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def codewords(languages: int) -> np.ndarray:
    """A row of +1 and -1 for each language: all splits of few, hashed dense codes of many."""
    if languages <= EXHAUSTIVE_UP_TO:
        columns = [
            [1, *split] for split in itertools.product((1, -1), repeat=languages - 1) if -1 in split
        ]
        return np.array(columns, np.float64).reshape(-1, languages).T
    # The language's number in binary keeps the rows apart, hashed bits keep them far.
    width = max(1, (languages - 1).bit_length())
    rows = []
    for i in range(languages):
        hashed = xxhash.xxh3_128_intdigest(str(i).encode()) | xxhash.xxh3_128_intdigest(b"+%d" % i) << 128
        bits = [i >> b & 1 for b in range(width)] + [hashed >> b & 1 for b in range(9 * width)]
        rows.append([1 if b else -1 for b in bits])
    code = np.array(rows, np.float64)
    return code[:, np.abs(code.sum(axis=0)) < languages]


def ngram_counts(labelled: DataFrame) -> dict[str, np.ndarray]:
    """n-gram counts of each language, over all texts with one.

    Each task sums its texts; the driver holds FEATURES numbers for each language.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                if lang not in sums:
                    sums[lang] = np.zeros(FEATURES, np.int64)
                sums[lang] += np.bincount(features(text.as_py()), minlength=FEATURES)
        for lang, counts in sums.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(counts[at])],
                names=["lang", "feature", "n"],
            )

    rows = labelled.select("lang", "text").mapInArrow(count, "lang string, feature long, n long")
    sums = rows.groupBy("lang", "feature").agg(F.sum("n").alias("n"))
    packed = sums.groupBy("lang").agg(F.collect_list(F.struct("feature", "n")).alias("counts"))
    found = {}
    for row in packed.select("lang", "counts.feature", "counts.n").toLocalIterator():
        counts = np.zeros(FEATURES, np.float64)
        counts[row["feature"]] = row["n"]
        found[row["lang"]] = counts
    return found


def classifiers(counts: np.ndarray, code: np.ndarray) -> np.ndarray:
    """For each bit the smoothed log odds of each n-gram, (FEATURES, bits).

    Languages weigh the same however much text they have.
    """
    smooth = counts + 0.5
    share = smooth / smooth.sum(axis=1, keepdims=True)
    ones, zeros = (code > 0).astype(np.float64), (code < 0).astype(np.float64)
    high = share.T @ (ones / ones.sum(axis=0))
    low = share.T @ (zeros / zeros.sum(axis=0))
    return np.log(high / low).astype(np.float32)


def decode(margins: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Shares of belief in each language, from the logistic losses of its codeword."""
    losses = np.logaddexp(0, -code * margins).sum(axis=1)
    belief = np.exp(losses.min() - losses)
    return belief / belief.sum()


def predict(docs: DataFrame, folds: int = FOLDS) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, ambiguous) of every row.

    Rows whose fold is 0 are held out from training.
    """
    rows = docs.select("doc_id", (fold_of(F.col("doc_id"), folds) == 0).alias("held_out"), "text", "lang")
    counts = ngram_counts(rows.filter("NOT held_out AND lang IS NOT NULL AND text IS NOT NULL"))
    names = sorted(lang for lang, n in counts.items() if n.any())
    code = weights = None
    if len(names) > 1:
        code = codewords(len(names))
        weights = classifiers(np.array([counts[n] for n in names]), code)
    model = docs.sparkSession.sparkContext.broadcast((names, code, weights))

    def guess(text: str | None) -> tuple[str, float]:
        names, code, weights = model.value
        if not names or not has_letter(text):
            return UNKNOWN, 0.0
        if len(names) == 1:
            return names[0], 1.0
        at = features(text)
        total = np.zeros(code.shape[1])
        for i in range(0, len(at), 1 << 17):
            total += weights[at[i : i + (1 << 17)]].sum(axis=0, dtype=np.float64)
        belief = decode(total / max(1, len(at)) * min(len(at), MOST_EVIDENCE), code)
        best = int(belief.argmax())
        return names[best], float(belief[best])

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            guesses = [guess(text.as_py()) for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array([g[0] for g in guesses], pa.string()),
                    pa.array([g[1] for g in guesses], pa.float64()),
                ],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, held_out boolean, lang_pred string, score double"
    labelled = rows.select("doc_id", "held_out", "text").mapInArrow(label, schema)
    return labelled.withColumn("ambiguous", F.col("score") < AMBIGUOUS)
