"""Language identification in two steps: the language family, then one-versus-one linear SVMs within it.

A text is described by the shares of its hashed byte trigrams; bytes that are neither ASCII letters
nor part of a longer UTF-8 character count as spaces.  All models are linear in those shares, so a
text of any length costs one pass and no per-text feature table.

Fitting reads a bounded sample of labelled rows (about `per_language` for each language, chosen by a
hash of the identifier); every text is predicted whole.  Each model is fitted by one task.

Defined cases: a null or empty text and one without a Unicode letter is `und` with score 0; repeated rows are predicted
alike; an empty table gives an empty result; without any labelled row every text is `und`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskbook.llm.text import lower, slices, text_bytes

BITS = 13
UNKNOWN = "und"
#: Languages of the larger European families; any other language is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "is"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl"),
    "slavic": ("ru", "uk", "pl", "cs", "sk", "bg", "sr", "hr", "sl"),
}
LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def family_of(lang: str) -> str:
    return next((name for name, members in FAMILIES.items() if lang in members), f"only {lang}")


@dataclass
class Model:
    """Linear decision between two names: positive means the first."""

    first: str
    second: str
    weights: np.ndarray
    bias: float


# -- features ------------------------------------------------------------------


def trigrams(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of the trigram at each byte, whether it counts, and each text's first byte.

    Each text gets a space at either end; a trigram counts if its middle byte is a letter.
    """
    raw, places = text_bytes(column)
    letter = LETTER[raw]
    clean = np.where(letter, lower(raw), np.uint8(32))
    padded = np.full(len(clean) + 2, 32, np.uint8)
    padded[1:-1] = clean
    before, after = padded[:-2].astype(np.uint32), padded[2:].astype(np.uint32)
    before[places[:-1][places[:-1] < len(raw)]] = 32
    after[places[1:][places[1:] > 0] - 1] = 32
    key = (before << np.uint32(16)) | (clean.astype(np.uint32) << np.uint32(8)) | after
    return (key * np.uint32(2654435761)) >> np.uint32(32 - BITS), letter, places


def lettered(column: pa.Array) -> np.ndarray:
    """Whether each text has a Unicode letter; the search stops at a text's first one."""
    return pc.match_substring_regex(column, r"\p{L}").fill_null(False).to_numpy(zero_copy_only=False)


def sums(values: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Sum of each text's values."""
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return total[places[1:]] - total[places[:-1]]


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shares of each text's trigram buckets as (bucket, share) lists; letterless texts give no row."""
    for batch in batches:
        for piece in slices(batch):
            buckets, counts, places = trigrams(piece.column("text"))
            letters, rows = lettered(piece.column("text")), []
            for i, lang in enumerate(piece.column("lang").to_pylist()):
                own = slice(places[i], places[i + 1])
                found = np.bincount(buckets[own][counts[own]], minlength=1 << BITS)
                if letters[i] and (total := found.sum()):
                    at = np.flatnonzero(found)
                    rows.append((lang, at.astype(np.int32), (found[at] / total).astype(np.float32)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.string()),
                    pa.array([r[1] for r in rows], pa.list_(pa.int32())),
                    pa.array([r[2] for r in rows], pa.list_(pa.float32())),
                ],
                names=["lang", "buckets", "shares"],
            )


# -- fitting -------------------------------------------------------------------


def linear_svm(x: np.ndarray, y: np.ndarray, cost: float = 4.0, rounds: int = 60) -> np.ndarray:
    """Weights of a soft-margin SVM by dual coordinate descent; classes weigh alike."""
    limit = cost * len(y) / (2.0 * np.where(y > 0, (y > 0).sum(), (y < 0).sum()))
    norms = (x * x).sum(1)
    alpha, w = np.zeros(len(y)), np.zeros(x.shape[1])
    order = np.random.default_rng(7)
    for _ in range(rounds):
        moved = 0.0
        for i in order.permutation(len(y)):
            slope = y[i] * (x[i] @ w) - 1
            new = min(max(alpha[i] - slope / norms[i], 0.0), limit[i])
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * x[i]
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-3:
            break
    return w


def _fit(rows: pd.DataFrame) -> pd.DataFrame:
    """One model from the rows of its two sides, sorted so that a rerun fits the same weights."""
    first, second = rows.loc[0, "first"], rows.loc[0, "second"]
    order = sorted(range(len(rows)), key=lambda i: (rows.side[i], rows.buckets[i].tobytes(), rows.shares[i].tobytes()))
    x = np.zeros((len(rows), (1 << BITS) + 1), np.float32)
    for n, i in enumerate(order):
        x[n, rows.buckets[i]] = rows.shares[i]
    y = np.array([1.0 if rows.side[i] == first else -1.0 for i in order])
    scale = 1.0 / np.sqrt(x.mean(0) + 1e-4)
    x *= scale.astype(np.float32)
    x[:, -1] = 0.3  # the bias, slightly held back
    w = linear_svm(x, y)
    return pd.DataFrame(
        {"first": [first], "second": [second], "weights": [(w[:-1] * scale[:-1]).tolist()], "bias": [float(w[-1] * 0.3)]}
    )


def fit(docs: DataFrame, key: Column, per_language: int = 400) -> list[Model]:
    """Models from the labelled rows of `docs` (text, lang), about `per_language` for each language.

    `key` picks the sample by its hash; the number of models is that of pairs of families and of
    pairs of languages within a family.
    """
    labelled = docs.where("lang IS NOT NULL AND text IS NOT NULL AND length(text) > 0")
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return []
    ceiling = 1_000_000
    share = F.lit(0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, min(ceiling, -(-per_language * ceiling // n))).otherwise(share)
    sample = (
        labelled.where(F.pmod(F.xxhash64(key.cast("string"), F.lit("language sample")), F.lit(ceiling)) < share)
        .select("text", "lang")
        .mapInArrow(_feature_rows, "lang string, buckets array<int>, shares array<float>")
    )
    sides = []
    families = {lang: family_of(lang) for lang in counts}
    for a, b in combinations(sorted(set(families.values())), 2):
        sides += [(lang, f, a, b) for lang, f in families.items() if f in (a, b)]
    for a, b in combinations(sorted(counts), 2):
        if families[a] == families[b]:
            sides += [(a, a, a, b), (b, b, a, b)]
    if not sides:  # one language only
        only = next(iter(counts))
        return [Model(only, only, np.zeros(1 << BITS), 0.0)]
    spark = docs.sparkSession
    plan = spark.createDataFrame(sides, "lang string, side string, first string, second string")
    fitted = (
        sample.join(F.broadcast(plan), "lang")  # one row for each language and model
        .select("first", "second", "side", "buckets", "shares")
        .groupBy("first", "second")
        .applyInPandas(_fit, "first string, second string, weights array<double>, bias double")
        .collect()
    )
    return [
        Model(r["first"], r["second"], np.array(r["weights"]), r["bias"])
        for r in sorted(fitted, key=lambda r: (r["first"], r["second"]))
    ]


# -- prediction ----------------------------------------------------------------


def decide(margins: dict[tuple[str, str], np.ndarray], names: list[str], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Winner of the pairwise decisions among names, by votes then margins, and its weakest chance."""
    votes, total = np.zeros((len(names), n)), np.zeros((len(names), n))
    chance = np.ones((len(names), n))
    for (a, b), margin in margins.items():
        i, j = names.index(a), names.index(b)
        votes[i] += margin >= 0
        votes[j] += margin < 0
        total[i] += margin
        total[j] -= margin
        p = 1 / (1 + np.exp(-np.clip(2.5 * margin, -30, 30)))
        chance[i], chance[j] = np.minimum(chance[i], p), np.minimum(chance[j], 1 - p)
    best = np.argmax(votes + 1e-3 * np.tanh(total), axis=0)
    return best, chance[best, np.arange(n)]


def predict_texts(column: pa.Array, models: list[Model]) -> tuple[list[str], np.ndarray]:
    """Language and score of each text."""
    buckets, counts, places = trigrams(column)
    n = len(column)
    number = sums(counts, places)
    if not models:
        return [UNKNOWN] * n, np.zeros(n)
    margins = {}
    for m in models:
        found = np.where(counts, m.weights.astype(np.float32)[buckets], np.float32(0))
        margins[m.first, m.second] = sums(found, places) / np.maximum(number, 1) + m.bias
    langs = sorted({x for m in models for x in (m.first, m.second) if not _is_family(x)})
    single = sorted({x for m in models for x in (m.first, m.second) if x.startswith("only ")})
    families: dict[str, list[str]] = {}
    for lang in {*langs, *(x.removeprefix("only ") for x in single)}:
        families.setdefault(family_of(lang), []).append(lang)
    for x in {x for m in models for x in (m.first, m.second) if x in FAMILIES}:
        families.setdefault(x, [])
    names = sorted(families)
    among = {k: v for k, v in margins.items() if k[0] in names and k[1] in names and k[0] != k[1]}
    family, score = decide(among, names, n)
    out = np.full(n, UNKNOWN, dtype=object)
    for i, name in enumerate(names):
        members = sorted(families[name])
        within = {k: v for k, v in margins.items() if k[0] in members and k[1] in members and k[0] != k[1]}
        best, chance = decide(within, members, n)
        here = family == i
        out[here] = np.array(members, dtype=object)[best[here]]
        score = np.where(here, score * chance, score)
    unknown = ~lettered(column)
    out[unknown] = UNKNOWN
    return out.tolist(), np.where(unknown, 0.0, np.clip(score, 0.0, 1.0))


def _is_family(name: str) -> bool:
    return name in FAMILIES or name.startswith("only ")


def predict(
    docs: DataFrame, models: list[Model], lang: str = "lang_pred", score: str = "score", keep_text: bool = False
) -> DataFrame:
    """The columns of `docs` (text only on demand) with each text's language and score.

    All columns travel to Python and back; select what is needed first.
    """
    rest = [c for c in docs.columns if keep_text or c != "text"]
    schema = docs.select(*rest).schema.add(lang, "string").add(score, "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch):
                names, scores = predict_texts(piece.column("text"), models)
                kept = [piece.column(c) for c in rest]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=[*rest, lang, score]
                )

    return docs.mapInArrow(run, schema)


def rejected(lang: Column, score: Column, least: float = 0.26) -> Column:
    """Texts whose language can't be told: no letters, or nearly tied decisions in both steps."""
    return (lang == UNKNOWN) | (score < least)


def identified(docs: DataFrame, per_language: int = 400) -> DataFrame:
    """The documents whose language can be told, by models of their own labelled rows.

    Where no row has a label, only texts without a letter go.
    """
    models = fit(docs, F.col("doc_id"), per_language)
    if not models:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    told = predict(docs, models, "__lang", "__score", keep_text=True)
    return told.where(~rejected(F.col("__lang"), F.col("__score"))).select(*docs.columns)
