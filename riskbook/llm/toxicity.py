"""Toxicity by compression distance: windows of words against an ordinary and a toxic Zstandard dictionary.

The ordinary dictionary is trained on windows of ordinary texts.  The toxic one is laid over it, so that
ordinary passages compress alike with both.  Two are tried, and the one is taken that tells texts apart better which it
did not see: the words of any length, and the pairs of neighbouring other words, that stand in far more contexts of
toxic than of ordinary texts, with what pieces of five characters that stand in far more toxic than ordinary texts cover of toxic texts' words; or a dictionary
trained on the words that hold such pieces, whole.  A window's gain is
the number of bytes that the toxic dictionary saves on it.  How much a gain speaks for a toxic text is
calibrated on labelled texts that the dictionaries did not see (FOLDS parts, each scored by the dictionaries of
the others), and so is the text's score: a logistic function of the mean weight of its windows, of its three
heaviest windows, of its heaviest stretch of windows, and of their number; the stretch lets a passage count in long texts.

Fitting reads a bounded sample of labelled rows, about `per_label` toxic and twice as many ordinary ones, chosen by a
hash of the identifier, in one task.  So that words of which few texts hold each are known too, Spark counts the words of
a sample WIDER times as large beforehand.  The sample has more toxic rows than the labels have, so the fitted scores are
moved back to the labels' odds.  Every text is scored whole, window by window.

Defined cases: a null text counts as empty, and an empty text is scored by the calibration of no window;
documents without a label are scored but not learned from; of several labels of a document the largest
counts; without a toxic or an ordinary labelled text every score is the share of toxic labels (0
without labels); repeated rows score alike; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import pickle
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskbook.llm.storage import store
from riskbook.llm.text import slices

WORDS = 6
PIECE = 5
TOXIC_BYTES = 6144
ORDINARY_BYTES = 16384
#: A piece is distinctive if so many texts hold it, and its share among toxic ones is so many deviations higher.
LEAST_TEXTS = 4
DEVIATIONS = 6.0
#: A word or pair of words is distinctive if toxic texts have so many times their share of its contexts, and chance deals its contexts so unevenly with a probability of at most exp(-NATS).  The most uneven
#: ones that fit in WORD_BYTES are kept.
LEAST_RATIO = 2.0
NATS = 16.0
WORD_BYTES = 32768
#: How many times the sample is as large on which words are counted.
WIDER = 10
GAINS = 12  # gains from -2 to 9, in bytes
#: Parts of the sample; each is scored by dictionaries of the others.
FOLDS = 5


@dataclass
class Pair:
    """The two dictionaries, and a passage that both hold: put before a window, it keeps the block compressible."""

    ordinary: bytes
    toxic: bytes
    lead: bytes


#: Ordinary and toxic contexts of each word or pair of words, and of all of them.
Wider = tuple[Counter, Counter, int, int]


@dataclass
class Model:
    pair: Pair | None
    weights: np.ndarray
    bias: np.ndarray
    prior: float


# -- windows -----------------------------------------------------------------------


def windows(text: str) -> list[bytes]:
    """The text's words in lower case, WORDS at a time."""
    words = text.lower().split()
    return [f" {' '.join(words[i : i + WORDS])} ".encode() for i in range(0, len(words), WORDS)]


class Gains:
    """Bytes that the toxic dictionary saves on each window of a text, as an index from 0 to GAINS - 1."""

    def __init__(self, pair: Pair):
        options = zstandard.ZstdCompressionParameters.from_level(
            3,
            strategy=zstandard.STRATEGY_BTOPT,
            min_match=3,
            format=zstandard.FORMAT_ZSTD1_MAGICLESS,
            write_content_size=0,
            write_checksum=0,
            write_dict_id=0,
        )
        self.lead = pair.lead
        self.sides = []
        for content in (pair.ordinary, pair.toxic):
            held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            held.precompute_compress(compression_params=options)
            self.sides.append(zstandard.ZstdCompressor(dict_data=held, compression_params=options).compress)

    def of(self, text: str) -> np.ndarray:
        ordinary, toxic = self.sides
        lead = self.lead
        saved = [len(ordinary(lead + w)) - len(toxic(lead + w)) for w in windows(text)]
        return np.clip(np.array(saved, np.int64) + 2, 0, GAINS - 1)


# -- fitting -----------------------------------------------------------------------


def pieces(text: str) -> set[str]:
    """All runs of PIECE characters within the text's words, each with a space before it."""
    return {f" {w}"[i : i + PIECE] for w in set(text.lower().split()) for i in range(len(w) - PIECE + 2)}


def trained(samples: list[bytes], size: int) -> bytes:
    """A dictionary of the samples; of too few for the trainer, the samples themselves."""
    try:
        return zstandard.train_dictionary(size, samples, k=32, d=6).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def contexts(text: str) -> set[tuple[str, str, str]]:
    """Each word with the words before and after it; a passage that is copied to other texts brings no new ones."""
    words = text.lower().split()
    return set(zip(["", *words], words, [*words[1:], ""], strict=False))


def held_pairs(text: str, known: set[str]) -> set[tuple[str, str, str]]:
    """Each known pair of neighbouring words with the words before and after it."""
    words = ["", *text.lower().split(), ""]
    found = ((a, f"{b} {c}", d) for a, b, c, d in zip(words, words[1:-2], words[2:-1], words[3:], strict=False))
    return {x for x in found if x[1] in known}


def nats(toxic: int, ordinary: int, share: float) -> float:
    """How unlikely it is, as a bound of its logarithm, that chance gives `toxic` or more of a word's contexts to toxic texts."""
    n = toxic + ordinary
    if toxic <= LEAST_RATIO * share * n:
        return 0.0
    return sum(k * math.log(k / n / p) for k, p in ((toxic, share), (ordinary, 1 - share)) if k)


def uneven(counts: Wider, least: float = NATS) -> dict[str, float]:
    """The distinctive words or pairs of words, with how unlikely their contexts are by chance."""
    ordinary, toxic, *n = counts
    share = n[1] / max(1, sum(n))
    return {w: x for w, a in toxic.items() if a >= LEAST_TEXTS and (x := nats(a, ordinary[w], share)) > least}


def laid(words: Wider, pairs: Wider) -> bytes:
    """The distinctive words, and the distinctive pairs of other words, the most uneven last, where they are cheapest to
    refer to."""
    found = uneven(words)
    found |= {p: x for p, x in uneven(pairs).items() if found.keys().isdisjoint(p.split())}
    out, room = [], WORD_BYTES
    for word in sorted(found, key=lambda w: (-found[w], w)):
        coded = f" {word} ".encode()
        if len(coded) <= room:
            out.append(coded)
            room -= len(coded)
    return b"".join(reversed(out))


def train(
    texts: list[str], toxic: list[int], counts: tuple[Counter, Counter], words: bytes = b""
) -> tuple[Pair, Pair] | None:
    """Dictionaries of labelled texts, with distinctive words and what pieces cover of others, and with words that hold
    pieces; counts: of ordinary and toxic texts that hold each piece; words: as `laid`."""
    n = Counter(toxic)
    rare, common = counts[1], counts[0]
    distinct = set()
    for piece, a in rare.items():
        if a >= LEAST_TEXTS:
            share = (a + common[piece]) / (n[0] + n[1])
            spread = math.sqrt(max(share * (1 - share), 1e-9) * (1 / n[1] + 1 / n[0]))
            if a / n[1] - common[piece] / n[0] > DEVIATIONS * spread:
                distinct.add(piece)
    if not distinct and not words:
        return None
    marked, plain = [], []
    covered: Counter = Counter()
    for text, label in zip(texts, toxic, strict=True):
        if not label:
            plain += windows(text)
            continue
        found = text.lower().split()
        for word in found:
            spaced = f" {word}"
            if any(spaced[i : i + PIECE] in distinct for i in range(len(word) - PIECE + 2)):
                marked.append(spaced.encode())
        for word in set(found):
            covered.update(spans(word, distinct))
    samples = [b"".join(marked[i : i + 8]) for i in range(0, len(marked), 8)]
    out, room = [], TOXIC_BYTES
    for span, _ in sorted(covered.items(), key=lambda m: (-m[1], m[0])):
        if len(span) <= room and span not in words:
            out.append(span)
            room -= len(span)
    ordinary = trained(plain, ORDINARY_BYTES)
    sides = [words + b"".join(reversed(out)), trained(samples, TOXIC_BYTES) if samples else b""]
    return tuple(Pair(ordinary, ordinary + side, ordinary[-64:-16]) for side in sides)


def spans(word: str, distinct: set[str]) -> set[bytes]:
    """What distinctive pieces cover of a word, run by run, with the space on either side that it reaches."""
    spaced, found, begin, end = f" {word}", set(), 0, 0
    for i in range(len(word) - PIECE + 2):
        if spaced[i : i + PIECE] in distinct:
            if i > end:
                found.add(spaced[begin:end])
                begin = i
            end = i + PIECE
    found.add(spaced[begin:end] + " " * (end == len(spaced)))
    return {x.encode() for x in found if x}


def features(gains: np.ndarray, weights: np.ndarray) -> list[float]:
    """What a text's windows say: their mean, the three heaviest, the heaviest stretch of windows, their number."""
    found = weights[gains]
    top = np.sort(np.maximum(found, 0))[-3:].sum() if len(found) else 0.0
    total = np.concatenate([[0.0], np.cumsum(found)])
    stretch = (total - np.minimum.accumulate(total)).max()
    return [float(found.mean()) if len(found) else 0.0, float(top), float(stretch), math.log1p(len(found)), 1.0]


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights of a logistic regression by Newton's method."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (y - p) - ridge * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def common_pairs(texts: list[str], toxic: list[int]) -> set[str]:
    """Pairs of neighbouring words that LEAST_TEXTS toxic texts hold."""
    held: Counter = Counter()
    for text, label in zip(texts, toxic, strict=True):
        if label:
            words = text.lower().split()
            held.update({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)})
    return {p for p, n in held.items() if n >= LEAST_TEXTS}


def counted(seen: list[tuple[set, set]]) -> Wider:
    """Counts of the different contexts of each word or pair, of parts as sets of ordinary and of toxic contexts."""
    every = tuple(set().union(*(s[label] for s in seen)) for label in (0, 1))
    return (*(Counter(w for _, w, _ in e) for e in every), *map(len, every))


def less(counts: Wider, own: Wider) -> Wider:
    """Counts without those of one part."""
    left = (Counter({w: n - gone[w] for w, n in c.items() if n > gone[w]}) for c, gone in zip(counts[:2], own[:2], strict=True))
    return (*left, *(n - gone for n, gone in zip(counts[2:], own[2:], strict=True)))


def fit_texts(texts: list[str], toxic: list[int], wider: Wider | None = None) -> Model:
    """Model of labelled texts; wider: ordinary and toxic contexts of each word and of all words, where they were counted on
    more texts, these among them."""
    prior = sum(toxic) / len(toxic) if toxic else 0.0
    nothing = Model(None, np.zeros(GAINS), np.zeros(5), prior)
    if not 0 < prior < 1:
        return nothing
    parts = [i % FOLDS for i in range(len(texts))]
    counts = [(Counter(), Counter()) for _ in range(FOLDS)]
    for text, label, part in zip(texts, toxic, parts, strict=True):
        counts[part][label].update(pieces(text))
    total = tuple(sum((c[label] for c in counts), Counter()) for label in (0, 1))
    seen = [(set(), set()) for _ in range(FOLDS)]
    for text, label, part in zip(texts, toxic, parts, strict=True):
        seen[part][label].update(contexts(text))
    wider = wider or counted(seen)
    known = common_pairs(texts, toxic)
    paired = [(set(), set()) for _ in range(FOLDS)]
    for text, label, part in zip(texts, toxic, parts, strict=True):
        paired[part][label].update(held_pairs(text, known))
    near = (*counted(paired)[:2], *(sum(len(s[label]) for s in seen) for label in (0, 1)))
    likely = uneven(near, NATS / 2)
    near = (*(Counter({p: n for p, n in c.items() if p in likely}) for c in near[:2]), *near[2:])

    def words_without(part: int | None) -> bytes:
        if part is None:
            return laid(wider, near)
        own = counted([seen[part]])
        return laid(less(wider, own), less(near, (*counted([paired[part]])[:2], *own[2:])))

    whole = train(texts, toxic, total, words_without(None))
    gains = [[np.zeros(0, np.int64)] * len(texts) for _ in range(2)]
    for part in range(FOLDS):
        others = [i for i, p in enumerate(parts) if p != part]
        labels = [toxic[i] for i in others]
        left = tuple(total[k] - counts[part][k] for k in (0, 1))
        both = 0 < sum(labels) < len(labels)
        pairs = train([texts[i] for i in others], labels, left, words_without(part)) if both else None
        for found, pair in zip(gains, pairs or (), strict=False):
            scorer = Gains(pair)
            for i, p in enumerate(parts):
                if p == part:
                    found[i] = scorer.of(texts[i])
    if not whole:
        return nothing
    models = [calibrated(pair, found, toxic) for pair, found in zip(whole, gains, strict=True) if any(len(g) for g in found)]
    return max(models, key=lambda m: m[0])[1] if models else nothing


def calibrated(pair: Pair, gains: list[np.ndarray], toxic: list[int]) -> tuple[float, Model]:
    """Model of the texts' gains by dictionaries that did not see them, and the logarithm of its labels' likelihood."""
    shares = np.zeros((2, GAINS))
    for found, label in zip(gains, toxic, strict=True):
        if len(found):
            shares[label] += np.bincount(found, minlength=GAINS) / len(found)
    shares = (shares + 0.01) / (shares + 0.01).sum(1, keepdims=True)
    weights = np.log(shares[1] / shares[0])
    x, y = np.array([features(g, weights) for g in gains]), np.array(toxic, float)
    bias = logistic(x, y)
    odds = np.clip(x @ bias, -30, 30)
    return float((y * odds - np.logaddexp(0, odds)).sum()), Model(pair, weights, bias, float(y.mean()))


def of_share(model: Model, share: float) -> Model:
    """A model fitted on a sample, for texts of which `share` are toxic: the odds of its scores are moved by as
    much as the sample's odds differ from theirs."""
    bias = model.bias.copy()
    if 0 < share < 1 and 0 < model.prior < 1:
        bias[-1] += math.log(share / (1 - share)) - math.log(model.prior / (1 - model.prior))
    return Model(model.pair, model.weights, bias, share)


def word_contexts(docs: DataFrame) -> Wider:
    """Ordinary and toxic contexts (as in `contexts`) of each word that may be distinctive, and of all words, of rows (text, toxic)."""
    words = "split(trim(lower(text)), '\\\\s+')"
    # side by side before they are spread: a lambda that looks a neighbour up would split the text again for each word
    before, after = f"concat(array(''), {words})", f"concat(slice({words}, 2, size({words})), array(''))"
    around = f"arrays_zip({words}, slice({before}, 1, size({words})), {after})"
    found = docs.select("toxic", F.explode(F.expr(around)).alias("at")).select("toxic", "at.*").toDF("toxic", "w", "x", "y")
    found = found.where("w <> ''").groupBy("toxic", "w", F.xxhash64("x", "w", "y")).agg(F.lit(1).alias("one"))
    counts = found.groupBy("w").agg(F.sum("toxic").cast("long").alias("a"), F.sum(1 - F.col("toxic")).cast("long").alias("b"))
    counts = store(counts, "contexts")
    a, b = counts.agg(F.sum("a"), F.sum("b")).first()
    if not a or not b:
        return Counter(), Counter(), b or 0, a or 0
    p = a / (a + b)
    uneven = f"a * ln(a / (a + b) / {p!r}D) + if(b = 0, 0D, b * ln(b / (a + b) / {1 - p!r}D)) > {NATS / 2}"
    rows = counts.where(f"a >= {LEAST_TEXTS} AND a > {p!r}D * (a + b)").where(uneven).collect()
    return Counter({r["w"]: r["b"] for r in rows}), Counter({r["w"]: r["a"] for r in rows}), b, a


def fit(docs: DataFrame, labels: DataFrame, key: Column, per_label: int = 1000) -> Model:
    """Model of the labelled rows of `docs` (doc_id, text) and `labels` (doc_id, toxic).

    The sample holds about `per_label` toxic and twice as many ordinary documents; it is chosen by a
    hash of `key`, is small enough to be broadcast, and is fitted by one task.
    """
    marked = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    n = {r["toxic"]: r["n"] for r in marked.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    ceiling = 1_000_000
    limit = {k: -(-per_label * (2 - k) * ceiling // max(1, n.get(k, 0))) for k in (0, 1)}
    draw = F.pmod(F.xxhash64(key.cast("string"), F.lit("toxicity sample")), F.lit(ceiling))
    chosen = marked.where(draw < F.when(F.col("toxic") == 1, limit[1]).otherwise(limit[0]))
    more = marked.where(draw < F.when(F.col("toxic") == 1, WIDER * limit[1]).otherwise(WIDER * limit[0]))
    # both bounded by per_label, whatever the size of the tables
    texts = docs.where("text IS NOT NULL").select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic")
    wider = word_contexts(docs.where("text IS NOT NULL").select("doc_id", "text").join(F.broadcast(more), "doc_id"))
    share = n.get(1, 0) / max(1, sum(n.values()))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates("text").sort_values("text")
        order = np.random.default_rng(4).permutation(len(rows))
        model = fit_texts([rows.text.iloc[i] for i in order], [int(rows.toxic.iloc[i]) for i in order], wider)
        model = of_share(model, share)
        return pd.DataFrame({"model": [pickle.dumps(_plain(model))]})

    fitted = texts.withColumn("all", F.lit("sample")).groupBy("all").applyInPandas(run, "model binary").collect()
    return _model(pickle.loads(fitted[0]["model"])) if fitted else Model(None, np.zeros(GAINS), np.zeros(5), 0.0)


def _plain(model: Model) -> tuple:
    """A model as built-in values, readable wherever this package is not."""
    pair = model.pair and (model.pair.ordinary, model.pair.toxic, model.pair.lead)
    return pair, model.weights.tolist(), model.bias.tolist(), model.prior


def _model(plain: tuple) -> Model:
    pair, weights, bias, prior = plain
    return Model(pair and Pair(*pair), np.array(weights), np.array(bias), prior)


# -- scoring -----------------------------------------------------------------------


def score(docs: DataFrame, model: Model, out: str = "score", threshold: float = 0.3) -> DataFrame:
    """The columns of `docs` but text, with each text's score and whether it reaches the threshold."""
    rest = [c for c in docs.columns if c != "text"]
    schema = docs.select(*rest).schema.add(out, "double").add("predicted", "integer")
    plain = _plain(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _model(plain)
        scorer = Gains(known.pair) if known.pair else None
        for batch in batches:
            for piece in slices(batch):
                if scorer:
                    texts = piece.column("text").to_pylist()
                    x = np.array([features(scorer.of(t or ""), known.weights) for t in texts])
                    chance = 1 / (1 + np.exp(-np.clip(x @ known.bias, -30, 30)))
                else:
                    chance = np.full(piece.num_rows, known.prior)
                columns = [piece.column(c) for c in rest]
                flags = pa.array((chance >= threshold).astype(np.int32))
                yield pa.RecordBatch.from_arrays([*columns, pa.array(chance), flags], names=[*rest, out, "predicted"])

    return docs.mapInArrow(run, schema)
