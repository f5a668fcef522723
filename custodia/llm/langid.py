"""Language identification by interpolated Kneser-Ney models over characters, one per language.

``fit`` takes about ``sample_documents`` whole labelled documents of each
language, chosen by a hash of their content, so the models have a bounded size.
Spark counts their words; a model of order ``ORDER`` over the letters of a word
with its two ends is kept as sorted hash arrays: the discounted probability of
each n-gram and the weight that each context leaves to the next shorter one.

``predict`` scores whole texts: the cross-entropy per symbol under every model;
the lowest wins, ties go to the smaller name. A document is rejected if it has no
letters or if its cross-entropy lies ``LEAST_EXCESS`` bits and ``DEVIATIONS`` standard deviations above what
sampled documents of its language have that the model was not fitted on; the
deviation allows for the length of the document.

Text that is null or without letters: ``und``, score 0, rejected. Without any
labelled text all documents are ``und``. Letters of all scripts count; case does
not. Each distinct n-gram and word of a slice is scored once, texts are not cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from custodia.llm import kernels as K
from custodia.llm.common import annotate, pick

UNKNOWN = "und"
ORDER = 5
SAMPLE_DOCUMENTS = 600
DEVIATIONS = 8.0
LEAST_EXCESS = 1.0
#: A language with fewer sampled documents keeps none apart, so that it has a model; it rejects nothing by cross-entropy.
LEAST_KEPT_APART = 16
BEGIN, END = 1, 2
CACHE_GRAMS = 500_000


def letter_words(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased code points of all texts, starts and stops of their runs of letters, first run of each text (n + 1)."""
    points, at = K.code_points([t.lower() for t in texts])
    letter = np.zeros(len(points) + 2, bool)
    letter[1:-1] = K.classes()[points] == K.LETTER
    edge = np.zeros(len(points) + 1, bool)
    edge[at] = True
    start = np.flatnonzero(letter[1:-1] & (~letter[:-2] | edge[:-1]))
    stop = np.flatnonzero(letter[1:-1] & (~letter[2:] | edge[1:])) + 1
    return points, start, stop, np.searchsorted(start, at)


def padded(points: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words between BEGIN and END, behind one another, and the n + 1 offsets."""
    size = stop - start
    at = np.append(0, np.cumsum(size + 2))
    out = np.full(at[-1], END, np.uint32)
    out[at[:-1]] = BEGIN
    out[K.ragged(at[:-1] + 1, size)] = points[K.ragged(start, size)]
    return out, at


def grams(symbols: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and stop of the longest n-gram that ends at each symbol but BEGIN."""
    stop = np.flatnonzero(symbols != BEGIN) + 1
    first = np.repeat(at[:-1], np.diff(at) - 1)
    return np.maximum(first, stop - ORDER), stop


@dataclass
class Model:
    """Sorted hashes of n-grams and of contexts, with probability and weight."""

    gram: np.ndarray
    probability: np.ndarray
    context: np.ndarray
    weight: np.ndarray

    @staticmethod
    def of(words: list[str], counts: np.ndarray) -> Model:
        """Interpolated Kneser-Ney: orders below the highest count the different symbols in front of an n-gram."""
        points, at = K.code_points(words)
        symbols, at = padded(points, at[:-1], at[1:])
        first, stop = grams(symbols, at)
        each = np.repeat(counts, np.diff(at) - 1).astype(np.float64)
        gram, probability, context, weight = [], [], [], []
        longer = None
        for n in range(ORDER, 0, -1):
            # n-grams of this order; those that begin a word have nothing in front and count as they are
            some = stop - first >= n
            begin, end = stop[some] - n, stop[some]
            keys, seen, which = np.unique(K.span_hashes(symbols, begin, end), return_index=True, return_inverse=True)
            count = np.bincount(which, each[some], len(keys))
            heads = symbols[begin[seen]] == BEGIN
            if longer is not None:
                kinds = np.bincount(np.searchsorted(keys, longer), minlength=len(keys))
                count = np.where(heads, count, kinds)
            once, twice = (count == 1).sum(), (count == 2).sum()
            discount = np.clip(once / max(once + 2 * twice, 1), 0.1, 0.9)
            about, inside = np.unique(K.span_hashes(symbols, begin[seen], end[seen] - 1), return_inverse=True)
            total, kinds = np.bincount(inside, count), np.bincount(inside)
            gram.append(keys)
            probability.append((count - discount) / total[inside])
            context.append(about)
            weight.append(discount * kinds / total)
            longer = K.span_hashes(symbols, begin[seen] + 1, end[seen]) if n > 1 else None
        gram, context = np.concatenate(gram), np.concatenate(context)
        a, b = np.argsort(gram), np.argsort(context)
        return Model(gram[a], np.concatenate(probability)[a], context[b], np.concatenate(weight)[b])

    def logs(self, symbols: np.ndarray, first: np.ndarray, stop: np.ndarray, floor: float) -> np.ndarray:
        """log2 of the probability of each last symbol behind the symbols before it."""
        p = np.full(len(stop), floor)
        for n in range(1, ORDER + 1):
            some = np.flatnonzero(stop - first >= n)
            end = stop[some]
            p[some] = _values(self.gram, self.probability, K.span_hashes(symbols, end - n, end), 0.0) + p[some] * _values(
                self.context, self.weight, K.span_hashes(symbols, end - n, end - 1), 1.0
            )
        return np.log2(p)


def _values(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, missing: float) -> np.ndarray:
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], missing)


@dataclass
class Languages:
    """The models by name, and mean, deviation and variance per symbol of unseen documents of each language."""

    names: list[str]
    models: list[Model]
    floor: float
    usual: np.ndarray

    def __post_init__(self) -> None:
        self.known, self.scores = np.zeros(0, np.uint64), np.zeros((0, len(self.names)))

    def _gram_scores(self, symbols: np.ndarray, first: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys, seen, which = np.unique(K.span_hashes(symbols, first, stop), return_index=True, return_inverse=True)
        if len(self.known) + len(keys) > CACHE_GRAMS:
            self.__post_init__()
        new = np.flatnonzero(~np.isin(keys, self.known, assume_unique=True))
        if len(new):
            at = seen[new]
            fresh = np.stack([m.logs(symbols, first[at], stop[at], self.floor) for m in self.models], axis=1)
            both = np.concatenate([self.known, keys[new]])
            order = np.argsort(both)
            self.known, self.scores = both[order], np.concatenate([self.scores, fresh])[order]
        return self.scores[np.searchsorted(self.known, keys)], which

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bits of each text under each model, squared bits per symbol likewise, and its symbols."""
        points, start, stop, first = letter_words(texts)
        bits = np.zeros((2, len(texts), len(self.names)))
        symbols_of = np.zeros(len(texts), np.int64)
        if len(start) and self.names:
            _, seen, which = np.unique(K.span_hashes(points, start, stop), return_index=True, return_inverse=True)
            symbols, at = padded(points, start[seen], stop[seen])
            scores, gram = self._gram_scores(symbols, *grams(symbols, at))
            each = -scores[gram]
            heads = at[:-1] - np.arange(len(at) - 1)
            has = np.diff(first) > 0
            for k, values in enumerate((each, each**2)):
                bits[k, has] = np.add.reduceat(np.add.reduceat(values, heads)[which], first[:-1][has])
            symbols_of[has] = np.add.reduceat(stop - start + 1, first[:-1][has])
        return bits[0], bits[1], symbols_of

    def limits(self, best: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """The cross-entropy above which a document of so many symbols is no text of its language."""
        mean, deviation, variance = self.usual[best].T
        return mean + LEAST_EXCESS + DEVIATIONS * np.sqrt(deviation**2 + variance / np.maximum(symbols, 1))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_documents: int = SAMPLE_DOCUMENTS) -> Languages:
    """Models of all languages in ``lang_col``, from about ``sample_documents`` rows of each."""
    docs = pick(docs, doc_id=(id_col, "string"), text=(text_col, "string"), lang=(lang_col, "string"))
    docs = docs.where("lang IS NOT NULL AND text IS NOT NULL")
    rows = {r["lang"]: r["n"] for r in docs.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not rows:
        return Languages([], [], 1.0, np.zeros((0, 3)))
    parts = F.create_map(*[x for lang, n in rows.items() for x in (F.lit(lang), F.lit(min(1.0, sample_documents / n)))])
    draw = F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 11) / F.lit(float(1 << 53))
    # every fourth document of the sample is kept apart to learn what unseen documents look like
    few = F.col("lang").isin(*[lang for lang, n in rows.items() if min(n, sample_documents) < LEAST_KEPT_APART])
    sample = docs.withColumn("draw", draw / parts[F.col("lang")]).where("draw < 1").withColumn("apart", (F.col("draw") >= 0.75) & ~few)
    counted = sample.where("NOT apart").select("lang", "text").mapInArrow(_count_words, "lang string, word string, n long")
    words = counted.groupBy("lang", "word").agg(F.sum("n").alias("n")).toPandas()
    names = sorted(rows)
    by = {lang: part.sort_values("word") for lang, part in words.groupby("lang")}
    alphabet = len(set("".join(words["word"]))) + 2
    names = [name for name in names if name in by]
    models = [Model.of(by[name]["word"].tolist(), by[name]["n"].to_numpy()) for name in names]
    out = Languages(names, models, 1.0 / alphabet, np.zeros((len(names), 3)))
    if names:
        seen = _unseen(sample.where("apart").select("lang", "text"), out)
        for k, name in enumerate(names):
            own = seen[seen["lang"] == name]
            if len(own):
                n, mean = own["symbols"].sum(), own["bits"].sum() / own["symbols"].sum()
                variance = max(own["squares"].sum() / n - mean**2, 0.0)
                spread = np.maximum((own["bits"] / own["symbols"] - mean) ** 2 - variance / own["symbols"], 0.0)
                out.usual[k] = mean, np.sqrt(np.average(spread, weights=own["symbols"])), variance
            else:
                out.usual[k] = np.log2(alphabet), 1.0, 1.0
    return out


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in K.slices(batches, 1):
        langs = part.column(0).to_pylist()
        for lang in sorted(set(langs)):
            points, start, stop, _ = letter_words([t for t, x in zip(part.column(1).to_pylist(), langs, strict=True) if x == lang])
            if len(start):
                _, seen, n = np.unique(K.span_hashes(points, start, stop), return_index=True, return_counts=True)
                whole = points.tobytes().decode("utf-32-le", "surrogatepass")
                words = [whole[a:b] for a, b in zip(start[seen].tolist(), stop[seen].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n)), pa.array(words), pa.array(n)], ["lang", "word", "n"])


def _unseen(docs: DataFrame, languages: Languages):  # noqa: ANN202
    """Bits, squares and symbols of sampled documents under their own model."""
    shared = docs.sparkSession.sparkContext.broadcast(languages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in K.slices(batches, 1):
            bits, squares, symbols = shared.value.entropies(part.column(1).to_pylist())
            own = np.array([shared.value.names.index(x) if x in shared.value.names else 0 for x in part.column(0).to_pylist()])
            row = np.arange(len(own))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *map(pa.array, (bits[row, own], squares[row, own], symbols))], ["lang", "bits", "squares", "symbols"]
            )

    found = docs.mapInArrow(run, "lang string, bits double, squares double, symbols long").toPandas()
    return found[found["symbols"] > 0]


ADDED = T.StructType([
    T.StructField("lang_pred", T.StringType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("cross_entropy", T.DoubleType()),
    T.StructField("rejected", T.BooleanType()),
])


def predict(docs: DataFrame, languages: Languages, text_col: str = "text") -> DataFrame:
    """All columns and lang_pred, score (probability among the languages), cross_entropy in bits per symbol, rejected."""
    shared = docs.sparkSession.sparkContext.broadcast(languages)

    def compute(batches: Iterator[pa.RecordBatch], place: int) -> Iterator[tuple[pa.RecordBatch, list]]:
        known = shared.value
        names = np.array([*known.names, UNKNOWN], object)
        for part in K.slices(batches, place):
            bits, _, symbols = known.entropies(part.column(place).fill_null("").to_pylist())
            none = (symbols == 0) | (not known.names)
            if known.names:
                best = bits.argmin(axis=1)
                least = bits.min(axis=1)
                entropy = least / np.maximum(symbols, 1)
                score = 1 / np.exp2(np.maximum(least[:, None] - bits, -1000.0)).sum(axis=1)
                rejected = none | (entropy > known.limits(best, symbols))
            else:
                best, entropy, score, rejected = (np.zeros(part.num_rows, kind) for kind in (int, float, float, bool))
            yield (
                part,
                [
                    pa.array(names[np.where(none, len(names) - 1, best)], pa.string()),
                    pa.array(np.where(none, 0.0, score)),
                    pa.array(entropy, mask=none),
                    pa.array(rejected | none),
                ],
            )

    return annotate(docs, text_col, compute, ADDED)
