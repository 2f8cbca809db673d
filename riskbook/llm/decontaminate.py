"""Benchmark decontamination by templates: typed placeholders, window hash join, consistent slots.

A text becomes a row of tokens: white-space-separated words without punctuation, in lower case.
Numbers, numbers joined to letters (``5km``), units after a number, and names (capitalised words that do
not begin a sentence or line) become typed placeholders.  All texts are also read with their names as
words, for copies in capitals or in other places of a sentence, and word by word without placeholders, for exact
copies of items that are mostly numbers, units or names.  Windows of `size` tokens are hashed and
joined with the benchmark's windows.  Matches of one document and item on one diagonal (the same
shift between the two texts) should fill each benchmark value by one value of the document, so that a
question asked again with other numbers or names is caught, and a chance template is not.  Equal values
may stand in an item by chance, so a diagonal may fill equal numbers, or those of one name, differently.
If it does so for several values, a name among them, its windows with such a value count only where they are
the item's own words and values; its other windows always count.

A document leaks an item if matches on a diagonal with consistent slots number `run` or more (or all the
item has), or if consistent matches cover `share` of the item's windows; template windows are also counted
alone.  An item of `least_words` or more tokens, but fewer than `size`, is one window of its own length, found anywhere in a text.

Before the join, windows are held against a bitmap of the benchmark's window hashes: 8 MB whatever
the size of the benchmark, so it only saves work.  The join decides.

Defined cases: null, empty and wordless texts have no window and never leak; an item of fewer than
`least_words` tokens has one window, which only a text of the same tokens shares, since so few words
stand in any text; windows with fewer than `least_words` ordinary words are found by exact copies only;
repeated rows leak alike and a pair is reported once for each identifier and text; an empty
benchmark leaks nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskbook.llm.bitmap import BITS, bitmap, holds
from riskbook.llm.storage import store
from riskbook.llm.text import hash_spans, lower, scan, slices, windows

SIZE = 8
#: A window that more items share is looked at only beside others.
COMMON = 8
WORD, NUMBER, QUANTITY, UNIT, NAME = range(5)
#: Units that become placeholders after a number.
UNITS = (
    "mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers "
    "g kg mg lb lbs oz ton tons gram grams kilogram kilograms pound pounds ounce ounces "
    "l ml liter liters litre litres gallon gallons s ms sec second seconds min minute minutes h hour hours day days "
    "week weeks month months year years percent degrees dollar dollars cent cents euro euros"
).split()
#: Some slot of a window w holds another value than the item's.
CHANGED = "exists(w.pairs, p -> p.item <> p.doc)"
KEPT = np.zeros(256, bool)
KEPT[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
DIGIT = np.zeros(256, bool)
DIGIT[48:58] = True
STOP = np.zeros(256, bool)
STOP[[ord(c) for c in ".!?:;|"]] = True


def _spans(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = np.frombuffer("".join(words).encode(), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    return raw, np.concatenate([[0], ends[:-1]]), ends


UNIT_CODES = np.sort(hash_spans(*_spans(UNITS)))
#: Keeps the codes of exact windows apart from those of templates.
EXACT = np.uint64(0xD6E8FEB86659FD93)
PLACEHOLDERS = hash_spans(*_spans(["<word>", "<number>", "<quantity>", "<unit>", "<name>"]))


class Tokens:
    """Template tokens of a column of texts: codes, codes of the words themselves, kinds, their spans of bytes, each text's first token.

    Without `names`, names are ordinary words.
    """

    def __init__(self, column: pa.Array, names: bool = True):
        found = scan(column)
        raw, starts, ends = found.raw, found.starts, found.ends
        kept = KEPT[raw]
        place = np.concatenate([[0], np.cumsum(kept)])
        self.raw = lower(raw)[kept]
        original = raw[kept]
        first, last = place[starts], place[ends]
        real = last > first
        # a token begins a sentence after a stop, a line end, a word without letters, or nothing
        lines = np.concatenate([[0], np.cumsum(raw == 10)])
        begins = np.ones(len(starts), bool)
        if len(starts) > 1:
            closing = ends[:-1] - 1
            stopped = STOP[raw[closing]] | (STOP[raw[np.maximum(closing - 1, 0)]] & (closing > starts[:-1]))
            begins[1:] = stopped | ~real[:-1] | (lines[starts[1:]] > lines[ends[:-1]])
        begins[found.offsets[:-1][found.offsets[:-1] < len(starts)]] = True
        begins, self.starts, self.ends = begins[real], first[real], last[real]
        self.offsets = np.concatenate([[0], np.cumsum(real)])[found.offsets]
        n = len(self.starts)
        self.kinds = np.full(n, WORD, np.int8)
        self.codes = self.words = hash_spans(self.raw, self.starts, self.ends)
        if not n:
            return
        digits = np.concatenate([[0], np.cumsum(DIGIT[self.raw])])
        number = digits[self.ends] - digits[self.starts]
        length = self.ends - self.starts
        upper = (original >= 65) & (original <= 90)
        wide = (original[:-1] == 0xC3) & (original[1:] >= 0x80) & (original[1:] <= 0x9E)
        upper[:-1] |= wide
        small = np.append(~upper & ~DIGIT[original], True)
        step = 1 + (original[self.starts] == 0xC3)
        capital = upper[self.starts] & (length > step) & small[np.minimum(self.starts + step, len(original))]
        if names:
            self.kinds[capital & ~begins] = NAME
        self.kinds[(number > 0) & DIGIT[self.raw[self.starts]]] = QUANTITY
        self.kinds[number == length] = NUMBER
        at = np.searchsorted(UNIT_CODES, self.codes)
        unit = UNIT_CODES[np.minimum(at, len(UNIT_CODES) - 1)] == self.codes
        unit[1:] &= self.kinds[:-1] == NUMBER
        unit[self.offsets[:-1][self.offsets[:-1] < n]] = False
        self.kinds[unit] = UNIT
        self.codes = np.where(self.kinds == WORD, self.codes, PLACEHOLDERS[self.kinds])

    def slots(self, start: int, end: int) -> list[str]:
        """Values in the placeholders of some tokens, those of names after an @."""
        return [
            "@" * int(self.kinds[i] == NAME) + self.raw[self.starts[i] : self.ends[i]].tobytes().decode(errors="replace")
            for i in range(start, end)
            if self.kinds[i] != WORD
        ]


def _template_rows(keys: list[str], size: int, least_words: int, wanted: np.ndarray | None, short: list[int]):
    def held(piece: pa.RecordBatch, tokens: Tokens, exact: bool, long: int) -> pa.RecordBatch:
        """Windows of `long` tokens: templates, or the words and values themselves."""
        codes, first = windows(tokens.words * EXACT if exact else tokens.codes, tokens.offsets, long)
        owner = np.repeat(np.arange(piece.num_rows), np.diff(first))
        place = np.arange(len(codes)) - first[owner]
        begin = tokens.offsets[owner] + place
        end = np.minimum(begin + long, tokens.offsets[owner + 1])
        use = (end - begin == long) if long < size else np.ones(len(codes), bool)
        if not exact:
            plain = np.concatenate([[0], np.cumsum(tokens.kinds == WORD)])
            use &= plain[end] - plain[begin] >= np.minimum(least_words, end - begin)
        if wanted is not None:
            use &= holds(wanted, (codes >> np.uint64(64 - BITS)).view(np.int64))
        at = np.flatnonzero(use)
        rows = pa.array(owner[at])
        return pa.RecordBatch.from_arrays(
            [
                *(piece.column(k).take(rows) for k in keys),
                pa.array(codes[at].view(np.int64)),
                pa.array(place[at]),
                pa.array([[] if exact else tokens.slots(begin[i], end[i]) for i in at], pa.list_(pa.string())),
                pa.array(np.full(len(at), exact)),
                pa.array((end - begin)[at].astype(np.int32)),
            ],
            names=[*keys, "code", "place", "slots", "exact", "tokens"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch):
                for names in (True, False):
                    tokens = Tokens(piece.column("text"), names)
                    for long in (size, *short):
                        yield held(piece, tokens, False, long)
                        if names:
                            yield held(piece, tokens, True, long)

    return run


def templates(
    rows: DataFrame, keys: list[str], size: int, least_words: int, wanted: np.ndarray | None = None, short: list[int] | None = None
) -> DataFrame:
    """Windows of each text, with and without names: `keys`, code, place, the values in the window's slots, whether
    it is exact (the words and values themselves) and its number of tokens.

    Besides those of `size` tokens there are windows of each number in `short`.  The window of a text of
    fewer tokens has the code of a window of just those tokens.
    """
    types = ", ".join(f"{k} {t}" for k, t in rows.select(*keys).dtypes)
    return rows.select(*keys, "text").mapInArrow(
        _template_rows(keys, size, least_words, wanted, short or []),
        f"{types}, code long, place long, slots array<string>, exact boolean, tokens int",
    )


def leaks(
    docs: DataFrame, benchmark: DataFrame, size: int = SIZE, least_words: int = 4, run: int = 6, share: float = 0.5
) -> DataFrame:
    """Documents and the benchmark items they hold: one row per document (doc_id, key) and item_id.

    key is the text's digest.  matched counts the item's windows found, longest those on one diagonal;
    changed says that some slot holds another value than the item's.
    """
    items = benchmark.select("item_id", "text")
    questions = store(templates(items, ["item_id"], size, least_words).distinct(), "questions")
    totals = questions.groupBy("item_id").agg(
        F.countDistinct("place").alias("item_windows"), F.countDistinct(F.when(~F.col("exact"), F.col("place"))).alias("item_typed")
    )
    short = sorted(r["tokens"] for r in questions.where(F.col("tokens").between(least_words, size - 1)).select("tokens").distinct().collect())
    keyed = docs.select("doc_id", F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("key"), "text")
    wanted = bitmap(questions, F.shiftrightunsigned("code", 64 - BITS))
    found = templates(keyed, ["doc_id", "key"], size, least_words, wanted, short).drop("exact", "tokens")
    asked = questions.select("item_id", "code", F.col("place").alias("item_place"), F.col("slots").alias("item_slots"), "exact")
    pairs = F.transform(F.arrays_zip("item_slots", "slots"), lambda x: F.struct(x["item_slots"].alias("item"), x["slots"].alias("doc")))
    matches = matched_windows(found, asked, totals, run, share)
    diagonals = (
        matches
        .where("size(item_slots) = size(slots)")
        .withColumn("pairs", pairs)
        .groupBy("doc_id", "key", "item_id", (F.col("place") - F.col("item_place")).alias("shift"))
        .agg(F.collect_set(F.struct(F.col("item_place").alias("place"), "pairs", "exact")).alias("held"))
        .withColumn("pairs", F.expr("array_distinct(flatten(held.pairs))"))
        .withColumn("torn", F.expr("filter(array_distinct(pairs.item), v -> size(filter(pairs, p -> p.item = v)) > 1)"))
        .withColumn("tangled", F.expr("size(torn) > 1 AND exists(torn, v -> startswith(v, '@'))"))
        .withColumn("held", F.expr(f"filter(held, w -> NOT tangled OR NOT ({CHANGED}) OR NOT exists(w.pairs, p -> array_contains(torn, p.item)))"))
        .withColumn("places", F.expr("array_distinct(held.place)"))
        .withColumn("typed", F.expr("array_distinct(filter(held, w -> NOT w.exact).place)"))
        .withColumn("changed", F.expr(f"exists(held, w -> {CHANGED})"))
        .where("size(places) > 0")
    )
    return (
        diagonals.groupBy("doc_id", "key", "item_id")
        .agg(
            F.size(F.array_distinct(F.flatten(F.collect_set("places")))).cast("long").alias("matched"),
            F.max(F.size("places")).cast("long").alias("longest"),
            F.size(F.array_distinct(F.flatten(F.collect_set("typed")))).alias("typed"),
            F.max(F.size("typed")).alias("longest_typed"),
            F.max("changed").alias("changed"),
        )
        .join(totals, "item_id")
        .where(
            (F.col("longest") >= F.least(F.lit(run), "item_windows"))
            | (F.col("matched") >= share * F.col("item_windows"))
            | (F.col("item_typed") > 0) & (F.col("longest_typed") >= F.least(F.lit(run), "item_typed"))
            | (F.col("item_typed") > 0) & (F.col("typed") >= share * F.col("item_typed"))
        )
        .select("doc_id", "key", "item_id", "matched", "item_windows", "longest", "changed")
    )


def matched_windows(found: DataFrame, asked: DataFrame, totals: DataFrame, run: int, share: float) -> DataFrame:
    """Windows of documents beside equal windows of items, for all pairs that can be leaks.

    A window that more than `COMMON` items share would bring every document that holds it together with all of them.  So
    the other windows decide which pairs are looked at, and shared ones are added for those pairs alone.  An
    item with so many shared windows that these alone could make it a leak is looked at by all its windows.
    """
    held = asked.groupBy("code").agg(F.countDistinct("item_id").alias("items"))
    marked = asked.join(held, "code").withColumn("common", F.col("items") > COMMON)
    places = marked.where("common").groupBy("item_id").agg(
        F.countDistinct("item_place").alias("shared"), F.countDistinct(F.when(~F.col("exact"), F.col("item_place"))).alias("shared_typed")
    )

    def enough(found_: str, of: str) -> Column:
        return (F.col(of) > 0) & (F.col(found_) >= F.least(F.lit(run), F.col(of))) | (F.col(of) > 0) & (F.col(found_) >= share * F.col(of))

    alone = places.join(totals, "item_id").where(enough("shared", "item_windows") | enough("shared_typed", "item_typed"))
    marked = marked.join(alone.select("item_id", F.lit(True).alias("alone")), "item_id", "left")
    later = F.col("common") & ~F.coalesce("alone", F.lit(False))
    marked = store(marked.withColumn("later", later).drop("items", "common", "alone"), "asked")
    found = store(found, "found")
    who = F.concat_ws("/", F.hex("key"), F.col("doc_id").cast("string")).alias("who")  # null identifiers as well
    found = found.withColumn("who", who)
    sooner = store(found.join(marked.where("NOT later"), "code"), "sooner")
    some = sooner.select("who", "item_id").distinct()
    wanted = some.join(marked.where("later"), "item_id")
    return sooner.unionByName(found.join(wanted, ["who", "code"])).drop("who", "later")


def without_leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that leak no item, with all their columns."""
    bad = store(leaks(docs, benchmark, **options).select(F.col("key").alias("__bad")).distinct(), "leaks")
    return docs.join(bad, F.unhex(F.md5(F.coalesce("text", F.lit("")))) == F.col("__bad"), "left_anti")
