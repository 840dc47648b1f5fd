"""Quality classifier by co-training of a text view and a metadata view.

Each view is a logistic regression on its own features: of the text its shape, its repetition and hashed
words, of the metadata language, source and size. After a first fit to labelled rows, every round lets
each view label the unlabelled rows it is surest about, and these labels train the *other* view together
with the true ones. Surest is a rank: the ``SHARE`` of all unlabelled rows with the highest scores and
the same with the lowest, so both views teach whatever the number of labels. What a label weighs follows
from labelled rows kept for calibration: how much more often than chance, and than not, the view is right
beyond its threshold; one that knows no more than that weighs nothing. In the end each view is calibrated on
those rows, and the calibrated views are combined.

All rows take part in every step. A step is one pass in which tasks sum gradients and curvatures (some
ten thousand numbers each) over the table of features; only the sums reach the driver, whatever the number
of rows, and nothing is sampled.

Defined results: null and empty texts are scored by the features of an empty text; null metadata is a
value of its own; repeated rows are scored alike; several labels of one id count as their mean; rows
without an id are unlabelled and held out; without labels of both kinds every score is the share of good
labels, or 0.5; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmart.llm.common import crc_bucket, landed, words_of

ROUNDS, STEPS = 3, 4
#: What a pseudo-label weighs at most next to a label, and the share of unlabelled rows a view labels per side.
PSEUDO, SHARE = 0.2, 0.1
RIDGE = 1.0
BINS = 100

LANGS, SOURCES, SIZES = 16, 64, 12
META = 1 + LANGS + SOURCES + SIZES
#: A language, two slots of a source (few sources share both), and a size.
PLACES = 4
SHAPE, WORDS = 18, 64
TEXT = SHAPE + WORDS


# --- features ---------------------------------------------------------------------------------------


def text_features(text: str | None) -> list[float]:
    """Shape and repetition of a text, 1 first, then the share of its words in each of ``WORDS`` slots."""
    text = text or ""
    raw, words = text.encode("utf-8", "surrogatepass"), words_of(text)
    n, size = max(len(words), 1), max(len(raw), 1)

    def share(chars: bytes) -> float:
        return (len(raw) - len(raw.translate(None, chars))) / size

    upper, lower = share(bytes(range(65, 91))), share(bytes(range(97, 123)))
    triples = list(zip(words, words[1:], words[2:]))
    repeated = 1 - len(set(triples)) / len(triples) if triples else 0.0
    lines = [line for line in raw.split(b"\n") if line.strip()]
    dup = 1 - len(set(lines)) / len(lines) if lines else 0.0
    count = Counter(words)
    often = max(count.values(), default=0) / n
    slots = [0.0] * WORDS
    for word, times in count.items():
        slots[zlib.crc32(word.lower()) % WORDS] += times
    symbols, bangs = share(b"#*$%&|<>~^_=+\\{}[]@"), share(b"!?")
    shout = upper / max(upper + lower, 1e-9)
    length = np.log1p(len(words))
    return [
        1.0, length / 5, (length / 5) ** 2, float(len(words) < 20), min(len(raw) / n, 40) / 10, min(symbols, 0.3) * 5, float(symbols > 0.05),
        min(bangs, 0.3) * 5, float(bangs > 0.05), shout, float(shout > 0.5), repeated, float(repeated > 0.3), dup, often,
        len(count) / n, min(share(b"0123456789"), 0.3) * 3, share(b".,;:") * 5,
        *(4 * x / n for x in slots),
    ]


def _feature_column(text: Column) -> Column:
    @F.pandas_udf("array<float>")
    def run(column: pd.Series) -> pd.Series:
        return column.map(lambda t: np.array(text_features(t), np.float32))

    return run(F.coalesce(text, F.lit("")))


def _meta_column(lang: Column, source: Column, n_chars: Column) -> Column:
    """Places of the ones in the metadata vector, besides the constant."""

    def slot(value: Column, salt: str, n: int) -> Column:
        return F.crc32(F.concat(F.lit(f"{salt}:"), F.coalesce(value.cast("string"), F.lit("")), F.when(value.isNull(), "-").otherwise("+"))) % n

    n = F.coalesce(n_chars.cast("long"), F.lit(-1))
    size = F.when(n >= 0, F.least(F.floor(F.log2(F.greatest(n, F.lit(0)) + 1) * 0.75), F.lit(SIZES - 1))).otherwise(0)
    first = 1 + LANGS
    places = [1 + slot(lang, "l", LANGS), first + slot(source, "s", SOURCES), first + slot(source, "t", SOURCES), first + SOURCES + size]
    return F.array(*[p.cast("int") for p in places])


def prepared(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, lang_col: str, source_col: str, size_col: str) -> DataFrame:
    """(id, text_x, meta_x, y, fold): y null if unlabelled or held out; fold 1 is for calibration."""
    known = (
        labels.filter(F.col("quality").isNotNull() & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("known_id"))
        .agg((F.avg("quality") >= 0.5).cast("int").alias("quality"))
        .filter(crc_bucket(F.col("known_id"), 4) != 2)
    )
    found = docs.select(
        F.col(id_col).alias("id"),
        _feature_column(F.col(text_col)).alias("text_x"),
        _meta_column(F.col(lang_col), F.col(source_col), F.col(size_col)).alias("meta_x"),
    )
    joined = found.join(known, found["id"] == known["known_id"], "left")
    fold = F.when(crc_bucket(F.col("id"), 8) == 1, 1).otherwise(0)
    return landed(joined.select("id", "text_x", "meta_x", F.col("quality").alias("y"), fold.alias("fold")), "quality-features")


def _matrices(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    n = batch.num_rows
    x = batch.column("text_x").flatten().to_numpy(zero_copy_only=False).reshape(n, TEXT).astype(float)
    places = batch.column("meta_x").flatten().to_numpy(zero_copy_only=False).reshape(n, PLACES)
    z = np.zeros((n, META))
    z[:, 0] = 1
    z[np.arange(n)[:, None], places] = 1
    return x, z


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


# --- passes over all rows ---------------------------------------------------------------------------


def _sum(rows: DataFrame, run, size: int) -> np.ndarray:
    """The sum over tasks of the vectors that ``run`` makes of batches."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += run(batch)
        k = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"k": pa.array(k, pa.int64()), "v": pa.array(total[k], pa.float64())})

    out = np.zeros(size)
    for r in rows.mapInArrow(partial, "k long, v double").groupBy("k").agg(F.sum("v").alias("v")).collect():
        out[r["k"]] = r["v"]
    return out


def _labels(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    y = batch.column("y").to_pandas().to_numpy(float, na_value=np.nan)
    return y, batch.column("fold").to_numpy(zero_copy_only=False)


Sure = tuple[float, float, float, float]


def _taught(p: np.ndarray, sure: Sure) -> tuple[np.ndarray, np.ndarray]:
    """(label, weight) a view gives the other for rows of these probabilities."""
    yes, no = p >= sure[1], p <= sure[0]
    return yes.astype(float), np.where(yes, sure[3], 0.0) + np.where(no, sure[2], 0.0)


def fitted(rows: DataFrame, views: tuple[np.ndarray, np.ndarray], teachers: tuple | None) -> tuple[np.ndarray, np.ndarray]:
    """Newton steps for both views at once, from ``views``. ``teachers``: the views of the round before
    and their thresholds."""
    a, b = TEXT, META
    cuts = np.cumsum([a, a * a, b, b * b])
    for _ in range(STEPS):
        now = views

        def run(batch: pa.RecordBatch, now=now) -> np.ndarray:
            x, z = _matrices(batch)
            y, fold = _labels(batch)
            labelled = ~np.isnan(y) & (fold == 0)
            parts = []
            for k, (m, w) in enumerate(((x, now[0]), (z, now[1]))):
                target, weight = np.where(labelled, np.nan_to_num(y), 0.0), labelled.astype(float)
                if teachers is not None:
                    (old, sure) = teachers
                    said, by = _taught(sigmoid((z, x)[k] @ old[1 - k]), sure[1 - k])
                    free = np.isnan(y)
                    target, weight = np.where(free, said, target), np.where(free, by, weight)
                p = sigmoid(m @ w)
                parts += [m.T @ (weight * (target - p)), ((m * (weight * p * (1 - p))[:, None]).T @ m).ravel()]
            return np.concatenate(parts)

        total = _sum(rows, run, int(cuts[-1]))
        g, h, g2, h2 = np.split(total, cuts[:-1])
        views = tuple(
            w + np.clip(np.linalg.solve(curve.reshape(len(w), len(w)) + RIDGE * np.eye(len(w)), slope - RIDGE * w), -4, 4)
            for w, slope, curve in ((views[0], g, h), (views[1], g2, h2))
        )
    return views


def _bins(p: np.ndarray) -> np.ndarray:
    """Bins of equal width in the log-odds from -8 to 8."""
    z = np.log(np.clip(p, 1e-9, 1 - 1e-9) / (1 - np.clip(p, 1e-9, 1 - 1e-9)))
    return np.clip((z + 8) * BINS / 16, 0, BINS - 1).astype(int)


def middle(k: np.ndarray) -> np.ndarray:
    return (np.asarray(k) + 0.5) * 16 / BINS - 8


def calibration_counts(rows: DataFrame, views: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Labelled rows kept for calibration by (text bin, metadata bin, label), and unlabelled rows by (view,
    bin)."""

    def run(batch: pa.RecordBatch) -> np.ndarray:
        x, z = _matrices(batch)
        y, fold = _labels(batch)
        use, free = ~np.isnan(y) & (fold == 1), np.isnan(y)
        by_text, by_meta = _bins(sigmoid(x @ views[0])), _bins(sigmoid(z @ views[1]))
        k = (by_text[use] * BINS + by_meta[use]) * 2 + y[use].astype(int)
        every = [np.bincount(k, minlength=BINS * BINS * 2)] + [np.bincount(b[free], minlength=BINS) for b in (by_text, by_meta)]
        return np.concatenate(every).astype(float)

    known, free = np.split(_sum(rows, run, BINS * BINS * 2 + 2 * BINS), [BINS * BINS * 2])
    return known.reshape(BINS, BINS, 2), free.reshape(2, BINS)


def thresholds(counts: np.ndarray, free: np.ndarray) -> Sure:
    """(bad up to, good from, weight of bad, weight of good) for one view, from calibration counts (bin,
    label) and unlabelled rows by bin: the bins at either end that hold ``SHARE`` of the unlabelled rows, or
    the first one that holds any, on the view's own side of one half."""
    edges = sigmoid(np.arange(BINS + 1) * 16 / BINS - 8)
    total = counts.sum(axis=0) + 1
    out = []
    for label, bins in ((0, np.arange(BINS // 2)), (1, np.arange(BINS - 1, BINS // 2 - 1, -1))):
        reached = np.cumsum(free[bins])
        inside = (reached <= SHARE * free.sum()) | (reached - free[bins] == 0)
        taken = bins[inside]
        chance = total[label] / total.sum()
        # few rows say little more than chance; and a label that is wrong more often than not teaches nothing
        right = (counts[taken, label].sum() + 2 * chance) / (counts[taken].sum() + 2)
        least = max(chance, 0.5)
        weight = PSEUDO * max(0.0, (right - least) / (1 - least))
        last = taken[-1]
        out.append((edges[last + 1] - 1e-12 if label == 0 else edges[last], weight))
    return float(out[0][0]), float(out[1][0]), float(out[0][1]), float(out[1][1])


def taught_rows(free: np.ndarray, sure: Sure) -> int:
    """How many unlabelled rows a view labels with some weight."""
    edges = sigmoid(np.arange(BINS + 1) * 16 / BINS - 8)
    no, yes = edges[1:] <= sure[0] + 1e-9, edges[:-1] >= sure[1] - 1e-9
    return int(free[no].sum() * (sure[2] > 0) + free[yes].sum() * (sure[3] > 0))


def logistic(x: np.ndarray, bad: np.ndarray, good: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights of a small logistic regression on counted rows."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p, n = sigmoid(x @ w), bad + good
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (good - n * p) - ridge * w)
        w += np.clip(step, -3, 3)
    return w


def combined(counts: np.ndarray) -> np.ndarray:
    """(text offset, text slope, meta offset, meta slope, offset, text weight, meta weight)."""
    centre, out, calibrated = middle(np.arange(BINS)), [], []
    for own in (counts.sum(axis=1), counts.sum(axis=0)):
        w = logistic(np.stack([np.ones(BINS), centre], axis=1), own[:, 0], own[:, 1])
        out += list(w)
        calibrated.append(w[0] + w[1] * centre)
    i, j = np.divmod(np.arange(BINS * BINS), BINS)
    flat = counts.reshape(-1, 2)
    x = np.stack([np.ones(len(flat)), calibrated[0][i], calibrated[1][j]], axis=1)
    used = flat.sum(axis=1) > 0
    return np.array([*out, *logistic(x[used], flat[used, 0], flat[used, 1])])


# --- all together -----------------------------------------------------------------------------------


def cotrained(rows: DataFrame, rounds: int = ROUNDS) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray, list[tuple[int, int]]]:
    """(views, calibration counts, per round how many rows the text view and the metadata view labelled)."""
    views = fitted(rows, (np.zeros(TEXT), np.zeros(META)), None)
    counts, free = calibration_counts(rows, views)
    taught = []
    for _ in range(rounds):
        sure = (thresholds(counts.sum(axis=1), free[0]), thresholds(counts.sum(axis=0), free[1]))
        taught.append((taught_rows(free[0], sure[0]), taught_rows(free[1], sure[1])))
        views = fitted(rows, views, (views, sure))
        counts, free = calibration_counts(rows, views)
    return views, counts, taught


def classify(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    size_col: str = "n_chars",
    rounds: int = ROUNDS,
) -> DataFrame:
    """Per row: held_out, text_score and meta_score (calibrated), score, kept (score of 0.5 or more).

    Labels whose id falls into crc fold 2 of 4 are never learnt from.
    """
    rows = prepared(docs, labels, id_col, text_col, lang_col, source_col, size_col)
    views, counts, _ = cotrained(rows, rounds)
    c = combined(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, z = _matrices(batch)
            a, b = c[0] + c[1] * np.clip(x @ views[0], -8, 8), c[2] + c[3] * np.clip(z @ views[1], -8, 8)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(sigmoid(a)), pa.array(sigmoid(b)), pa.array(sigmoid(c[4] + c[5] * a + c[6] * b))],
                ["id", "text_score", "meta_score", "score"],
            )

    kind = rows.schema["id"].dataType.simpleString()
    found = rows.select("id", "text_x", "meta_x").mapInArrow(run, f"id {kind}, text_score double, meta_score double, score double")
    held_out = F.coalesce(crc_bucket(F.col("id"), 4) == 2, F.lit(True)).alias("held_out")
    return found.select(F.col("id").alias(id_col), held_out, "text_score", "meta_score", "score", (F.col("score") >= 0.5).alias("kept"))
