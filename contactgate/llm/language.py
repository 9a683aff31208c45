"""Language identification: multinomial naive Bayes over hashed character n-grams.

A text is lower-cased, every run of non-letters becomes one space, and its 1- to
3-grams of characters are hashed into ``buckets`` features.  Fitting counts the
features of each language in Spark; the model is a matrix of log probabilities
(buckets x languages, broadcast; ``max_languages`` bounds it).  Scoring multiplies
the sparse feature matrix of a batch of texts with it, in numpy, over Arrow batches.

The model is fitted on a bounded sample: of each language about
``docs_per_language`` documents, chosen by their hashed ids and texts.  Scoring
covers every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import HASH_RANGE, give_back, hash_part, ship

UNKNOWN = "und"
ORDERS = 3
BUCKETS = 1 << 16
DOCS_PER_LANGUAGE = 1000
ALPHA = 0.5                 # added to every count
MAX_LANGUAGES = 1000        # of one model: 256 MB of log probabilities
SLAB_CHARS = 500_000        # characters scored at a time
LETTER = regex.compile(r"\p{L}")
# per n-gram order an odd multiplier (fixed values)
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)

_letters: np.ndarray | None = None


def _is_letter() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letters


def code_points(text: str) -> np.ndarray:
    """Lower-cased code points with each run of non-letters as one space, a
    space at both ends."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _is_letter()[points]
    keep = letter.copy()
    keep[1:] |= letter[:-1]         # the first character after a letter stands for its run
    keep[0] = True
    return np.where(letter, points, 32)[keep].astype(np.uint64)


def sparse_rows(pieces: list[np.ndarray], buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pieces as rows of a sparse matrix of hashed features, one part per n-gram
    order: (column of every entry, row after row; entries of each row).  An n-gram that
    occurs twice is two entries of one."""
    shift = np.uint64(64 - int(buckets).bit_length() + 1)
    points = np.concatenate(pieces)
    sizes = np.array([len(p) for p in pieces])
    place = np.arange(len(points)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    rest = np.repeat(sizes, sizes) - place
    for n, m in zip(range(1, ORDERS + 1), MULTIPLIERS):
        starts = max(0, len(points) - n + 1)
        gram = points[:starts].copy()
        for k in range(1, n):
            gram = (gram << np.uint64(21)) ^ points[k: starts + k]
        own = (rest[:starts] >= n) & (place[:starts] < SLAB_CHARS)      # none across two pieces, none twice
        yield (((gram * np.uint64(m)) >> shift).astype(np.int64)[own],
               np.clip(sizes - n + 1, 0, SLAB_CHARS))


def features(points: np.ndarray, buckets: int) -> Iterator[np.ndarray]:
    """Hashed features of one piece, one array per n-gram order."""
    for columns, _ in sparse_rows([points], buckets):
        yield columns


def slabs(points: np.ndarray) -> Iterator[np.ndarray]:
    """Cuts of a long text; they overlap so that each n-gram starts in exactly
    one (``features`` makes none that start in the overlap)."""
    for at in range(0, len(points), SLAB_CHARS):
        yield points[at: at + SLAB_CHARS + ORDERS - 1]


@dataclass
class LanguageModel:
    languages: list[str]
    table: np.ndarray       # float32, buckets x languages
    prior: np.ndarray       # float64, log prior

    def predict_batch(self, texts: Sequence[str | None]) -> tuple[list[str], np.ndarray]:
        """Best language of each text and its posterior probability.

        The texts' features form a sparse matrix, ``SLAB_CHARS`` characters or one piece
        more at a time, which is multiplied with the dense table."""
        names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        known = [i for i, t in enumerate(texts) if t and LETTER.search(t)] if self.languages else []
        if not known:
            return names, scores
        total = np.tile(self.prior, (len(known), 1))

        def add(rows: list[int], pieces: list[np.ndarray]) -> None:
            for columns, entries in sparse_rows(pieces, len(self.table)):
                some = np.flatnonzero(entries)
                if len(some):
                    sums = np.add.reduceat(self.table[columns], (np.cumsum(entries) - entries)[some],
                                           axis=0, dtype=np.float64)
                    np.add.at(total, np.array(rows)[some], sums)

        rows, pieces, size = [], [], 0
        for row, i in enumerate(known):
            for piece in slabs(code_points(texts[i])):
                rows.append(row)
                pieces.append(piece)
                size += len(piece)
                if size >= SLAB_CHARS:
                    add(rows, pieces)
                    rows, pieces, size = [], [], 0
        if pieces:
            add(rows, pieces)
        best = total.argmax(axis=1)
        scores[known] = 1.0 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
        for i, k in zip(known, best.tolist()):
            names[i] = self.languages[k]
        return names, scores

    def predict(self, text: str | None) -> tuple[str, float]:
        """The one-text case of :meth:`predict_batch`."""
        names, scores = self.predict_batch([text])
        return names[0], float(scores[0])


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        buckets: int = BUCKETS, docs_per_language: int = DOCS_PER_LANGUAGE,
        max_languages: int = MAX_LANGUAGES) -> LanguageModel:
    """Fit on the rows whose language and text are not null.

    About ``docs_per_language`` documents of a language are read for counting: those whose
    hashed id and text lie in the lowest ``docs_per_language`` / (rows of the language) of
    the hash range, never more than twice that over all languages.  No such rows give a
    model that predicts ``und`` everywhere.  The driver receives one count per language and
    the feature counts: languages x buckets at most; a column with more than
    ``max_languages`` values is taken for something else and refused (``ValueError``)."""
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"),
                       hash_part(id_col, text_col).alias("h")).where("lang IS NOT NULL")
    counts_of = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
                 .limit(max_languages + 1).collect()}
    if len(counts_of) > max_languages:
        raise ValueError(f"{lang_col} has more than {max_languages} values")
    languages = sorted(counts_of)
    if not languages:
        return LanguageModel([], np.zeros((buckets, 0), np.float32), np.zeros(0))
    upto = {lang: min(HASH_RANGE, int(docs_per_language / n * HASH_RANGE)) for lang, n in counts_of.items()}
    bound = F.element_at(F.create_map(*[F.lit(x) for lang in languages for x in (lang, upto[lang])]), F.col("lang"))
    sample = (rows.where("text IS NOT NULL").where(F.col("h") < bound).select("text", "lang")
              .limit(2 * docs_per_language * len(languages)))
    place = {lang: i for i, lang in enumerate(languages)}

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros((len(place), buckets), np.int64)
        for batch in batches:
            for text, lang in zip(batch["text"], batch["lang"]):
                for slab in slabs(code_points(text)):
                    for ids in features(slab, buckets):
                        counts[place[lang]] += np.bincount(ids, minlength=buckets)
        lang, bucket = np.nonzero(counts)
        yield pd.DataFrame({"lang": lang, "bucket": bucket, "n": counts[lang, bucket]})

    found: pa.Table = (sample.mapInPandas(count, "lang int, bucket int, n long")
                       .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow())
    counts = np.zeros((buckets, len(languages)))
    counts[found["bucket"].to_numpy(), found["lang"].to_numpy()] = found["n"].to_numpy()
    table = np.log(counts + ALPHA) - np.log((counts + ALPHA).sum(axis=0))
    # equal priors: the sample is balanced on purpose
    return LanguageModel(languages, table.astype(np.float32), np.zeros(len(languages)))


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text",
             lang_out: str = "lang_pred", score_out: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its posterior probability.

    Null texts and texts without a letter are ``und`` with score 0; equal
    posteriors go to the language that sorts first; input columns with
    the output names are replaced, all others stay; empty tables stay empty."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang: string, score: double>")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            names, scores = shared.value.predict_batch(batch.to_pylist())
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                             names=["lang", "score"])
        give_back()

    other = [F.col(f"`{c}`") for c in docs.columns if c not in (lang_out, score_out)]
    made = docs.select(*other, predict(F.col(text_col)).alias("__language"))
    return (made.withColumn(lang_out, F.col("__language.lang"))
            .withColumn(score_out, F.col("__language.score")).drop("__language"))
