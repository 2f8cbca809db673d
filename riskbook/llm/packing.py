"""Best-fit packing of token sequences, planned over counts of lengths.

Documents are encoded and cut into pieces of at most `CAPACITY` ids (only longer documents are cut; the
first piece is the shorter one).  The plan is made from the number of pieces of each length alone: from
the longest length down, pieces go to the sequences with the least room that still holds them, a
whole class of equal sequences at a time.  The result is that of best fit on the pieces one by one in descending
order of length, and its size depends on the capacity, not on the number of documents.

The plan is a list of runs: for a length, pieces `first_rank`, `first_rank` + 1, ... lie `each` by `each` in the
sequences from `first_sequence` on, side by side from `offset`.  Every piece has a rank among
the pieces of its length (its number inside the task that cut it, plus the pieces of that length in the tasks
before), and by that rank it takes its slot.  Pieces meet by sequence only where they share one.

Defined cases: a null text is encoded as the empty one (its only id is the end id); rows with null or equal
identifiers are documents of their own; an empty table gives no sequence; clashing extra columns are
left out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskbook.llm.storage import store
from riskbook.llm.text import as_text

CAPACITY = 1024
END_ID = 2
#: Rows (task, length, pieces before) up to which that table is broadcast: about 40 bytes each.
BROADCAST_ROWS = 200_000


# -- encoding ----------------------------------------------------------------------

# Letters, numbers and white space up to U+024F, the same in every library and release.
LETTERS, NUMBERS, SPACES = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼½¾", "\t\n\x0b\x0c\r \x85\xa0"
BEYOND = "[^\x00-ɏ]"
#: Byte-level BPE splits a text like this before it merges anything.
WORDS = re.compile(
    f"'(?:s|t|re|ve|m|ll|d)| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^{SPACES}{LETTERS}{NUMBERS}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+"
)
#: What often stands at the end of a word and is a word of its own there.
MARKS = [".", ",", ";", ":", "!", "?"]
#: Words whose ids are Python objects at once.
CHUNK = 20_000
#: Bytes of text that are encoded at once.
SLICE_BYTES = 16_000_000


def byte_letters() -> dict[int, str]:
    """Byte-level BPE's character for each byte: printable Latin-1 as it is, the rest from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Rows:
    """Rows of ids, one after the other."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray):
        self.ids, self.lengths = ids, lengths
        self.starts = np.cumsum(lengths) - lengths

    @classmethod
    def of(cls, rows: list[list[int]]) -> Rows:
        lengths = np.fromiter(map(len, rows), np.int64, len(rows))
        return cls(np.fromiter((i for row in rows for i in row), np.uint32, int(lengths.sum())), lengths)

    @classmethod
    def joined(cls, parts: list[Rows]) -> Rows:
        return cls(np.concatenate([p.ids for p in parts]), np.concatenate([p.lengths for p in parts]))

    def take(self, which: np.ndarray) -> Rows:
        lengths = self.lengths[which]
        at = np.repeat(self.starts[which] - np.cumsum(lengths) + lengths, lengths)
        at += np.arange(len(at))
        return Rows(self.ids[at], lengths)


class Encoder:
    """Ids of texts by a byte-level BPE tokenizer; each different word of a slice goes through its model once.

    A space between two characters that are no white space always begins a word, so texts are cut at their
    spaces, and equal runs between two spaces are encoded once.  Texts with other white space
    next to a space, with characters beyond U+024F, or with one of the tokenizer's own tokens are
    encoded whole by the tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.own = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.letters = byte_letters()
        self.edges = frozenset(SPACES)

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def shown(self, text: str) -> str:
        return text.encode().decode("latin-1").translate(self.letters)

    def words(self, text: str) -> list[int]:
        """Ids of a short text, split into words."""
        return [t.id for word in WORDS.findall(text) for t in self.model.tokenize(self.shown(word))]

    def runs(self, runs: pa.Array) -> tuple[Rows, np.ndarray]:
        """Ids of different runs between spaces, each with the space before it, and which of them do not stand for
        themselves because other white space is next to a space.

        Most are a word of letters, or one with a mark after it; those are told from the rest, and the words' ids found,
        for all runs together.
        """
        stem, last = pc.utf8_slice_codeunits(runs, 0, -1), pc.utf8_slice_codeunits(runs, -1)
        alone = pc.utf8_is_alpha(runs)
        marked = pc.and_(pc.is_in(last, pa.array(MARKS, last.type)), pc.utf8_is_alpha(stem))
        core = pc.if_else(alone, runs, pc.if_else(marked, stem, pa.scalar(None, runs.type))).dictionary_encode()
        words = self.shown("\n".join(core.dictionary.to_pylist())).split(self.letters[10])
        words = words[: len(core.dictionary)]
        space, tokenize = self.letters[32], self.model.tokenize
        found = [Rows.of([[t.id for t in tokenize(space + w)] for w in words[i : i + CHUNK]]) for i in range(0, len(words), CHUNK)]
        table = Rows.joined([Rows.of([]), *found])
        first = pc.fill_null(core.indices, -1).to_numpy().astype(np.int64)

        alone, marked = (x.to_numpy(zero_copy_only=False) for x in (alone, marked))
        rest = np.flatnonzero(~alone & ~marked)
        texts = runs.take(pa.array(rest)).to_pylist()
        torn = [not t or t[0] in self.edges or t[-1] in self.edges for t in texts]
        marks = len(table.lengths)
        others, nothing = marks + len(MARKS), marks + len(MARKS) + len(rest)
        seconds = Rows.of([self.words(mark) for mark in MARKS])
        found = Rows.of([[] if bad else self.words(f" {t}") for t, bad in zip(texts, torn, strict=True)])
        table = Rows.joined([table, seconds, found, Rows.of([[]])])

        first[rest] = others + np.arange(len(rest))
        second = np.full(len(runs), nothing)
        second[marked] = marks + pc.index_in(last, pa.array(MARKS, last.type)).to_numpy(zero_copy_only=False)[marked].astype(np.int64)
        both = table.take(np.stack([first, second], 1).ravel())
        lost = np.zeros(len(runs), bool)
        lost[rest] = torn
        return Rows(both.ids, both.lengths.reshape(-1, 2).sum(1)), lost

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and each text's number of ids."""
        texts = as_text(column)
        odd = pc.match_substring_regex(texts, BEYOND)
        for token in self.own:
            odd = pc.or_(odd, pc.match_substring(texts, token))
        split = pc.split_pattern(pc.if_else(odd, "", texts), pattern=" ")
        cuts = split.offsets.to_numpy().astype(np.int64)
        cuts -= cuts[0]
        coded = split.flatten().dictionary_encode()
        heads = coded.dictionary.take(coded.indices.take(pa.array(cuts[:-1]))).to_pylist()  # no space before them
        table, lost = self.runs(coded.dictionary)
        code = coded.indices.to_numpy().astype(np.int64)
        bad = lost[code]
        bad[cuts[:-1]] = [bool(h) and h[-1] in self.edges for h in heads]
        code[cuts[:-1]] = len(table.lengths) + np.arange(len(heads))
        table = Rows.joined([table, Rows.of([self.words(h) for h in heads])])
        odd = odd.to_numpy(zero_copy_only=False).copy()
        odd[np.searchsorted(cuts, np.flatnonzero(bad), "right") - 1] = True
        out, lengths = [], np.zeros(len(texts), np.int64)
        for i, j in self.parts(cuts, odd):
            if odd[i]:
                out.append(np.array(self.whole(texts[i].as_py()), np.uint32))
                lengths[i] = len(out[-1])
            else:
                found = table.take(code[cuts[i] : cuts[j]])
                out.append(found.ids)
                lengths[i:j] = np.diff(np.concatenate([[0], np.cumsum(found.lengths)])[cuts[i : j + 1] - cuts[i]])
        return np.concatenate(out) if out else np.zeros(0, np.uint32), lengths

    @staticmethod
    def parts(cuts: np.ndarray, odd: np.ndarray) -> Iterator[tuple[int, int]]:
        """Spans of texts that are gathered together: odd ones alone, the others up to about 2 ** 19 runs."""
        change = odd[1:] | odd[:-1] | (np.diff(cuts[:-1] >> 19) > 0)
        edges = [0, *(np.flatnonzero(change) + 1).tolist(), len(odd)]
        yield from ((i, j) for i, j in zip(edges[:-1], edges[1:], strict=True) if j > i)


def sized_slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in pieces of about SLICE_BYTES of text; a longer text is a piece alone."""
    size = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
    cuts = np.flatnonzero(np.diff(np.cumsum(size) // SLICE_BYTES)) + 1
    for start, end in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
        if end > start:
            yield batch.slice(start, end - start)


# -- the plan ----------------------------------------------------------------------

RUN = np.dtype([(n, np.int64) for n in ("length", "first_rank", "each", "first_sequence", "offset")])


def plan(counts: np.ndarray) -> np.ndarray:
    """Runs (of dtype `RUN`, by length and rank) that place `counts[n]` pieces of each length n.

    The capacity is the longest length that `counts` has a place for.
    """
    capacity = len(counts) - 1
    room: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # by room left: (first sequence, sequences)
    runs, sequences = [], 0
    for length in range(capacity, 0, -1):
        left, rank = int(counts[length]), 0
        space = length
        while left:
            while space <= capacity and not room[space]:
                space += 1
            if space > capacity:  # no open sequence holds the piece
                space = capacity
                opened = -(-left // (capacity // length))
                room[space].append((sequences, opened))
                sequences += opened
            first, many = room[space].pop()
            each = space // length
            full = min(many, left // each)
            taken = full * each
            if full:
                runs.append((length, rank, each, first, capacity - space))
                room[space - each * length].append((first, full))
            rest = min(left - taken, each - 1) if full < many else 0
            if rest:  # the last pieces of this length fill one sequence in part
                runs.append((length, rank + taken, rest, first + full, capacity - space))
                room[space - rest * length].append((first + full, 1))
            if many - full - (rest > 0):
                room[space].append((first + full + (rest > 0), many - full - (rest > 0)))
            left, rank = left - taken - rest, rank + taken + rest
        room[0].clear()
    return np.sort(np.array(runs, RUN), order=["length", "first_rank"])


def slots(runs: np.ndarray, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of the pieces with the given lengths and ranks."""
    key = (runs["length"] << 48) + runs["first_rank"]
    run = runs[np.searchsorted(key, (length << 48) + rank, "right") - 1]
    place = rank - run["first_rank"]
    return run["first_sequence"] + place // run["each"], run["offset"] + place % run["each"] * length


# -- Spark -------------------------------------------------------------------------


class Blocks:
    """Ids as compressed blocks, and back."""

    def __init__(self):
        self.shrink, self.grow = zstandard.ZstdCompressor(level=1).compress, zstandard.ZstdDecompressor().decompress

    def of(self, ids: np.ndarray, cuts: np.ndarray) -> list[bytes]:
        """A block for each part of the ids between two cuts."""
        narrow = ids.astype("<u2") if not len(ids) or ids.max() < 1 << 16 else ids.astype("<u4")
        mark = bytes([narrow.itemsize])
        return [mark + self.shrink(narrow[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def ids(self, block: bytes) -> np.ndarray:
        return np.frombuffer(self.grow(memoryview(block)[1:]), f"<u{block[0]}").astype("<u4")


def _cut(tokenizer: str, capacity: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, blocks = Encoder(tokenizer), Blocks()
        task = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for rows in sized_slices(batch):
                ids, lengths = encoder.encode(rows.column("text"))
                ids = np.insert(ids, np.cumsum(lengths), end_id)
                lengths = lengths + 1
                many = -(-lengths // capacity)
                doc = np.repeat(np.arange(len(lengths)), many)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
                head = (lengths - 1) % capacity + 1  # the first piece is the shorter one
                start = np.where(piece > 0, head[doc] + (piece - 1) * capacity, 0)
                size = np.where(piece > 0, capacity, head[doc])
                order = np.argsort(size, kind="stable")
                firsts = np.searchsorted(size[order], size[order])
                nth = np.empty(len(size), np.int64)
                nth[order] = seen[size[order]] + np.arange(len(size)) - firsts
                seen += np.bincount(size, minlength=capacity + 1)
                cuts = np.concatenate([[0], np.cumsum(size)])
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": rows.column("doc_id").take(pa.array(doc)),
                        "piece": pa.array(piece, pa.int32()),
                        "start": pa.array(start),
                        "length": pa.array(size, pa.int32()),
                        "task": pa.array(np.full(len(size), task), pa.int32()),
                        "nth": pa.array(nth),
                        "ids": pa.array(blocks.of(ids, cuts), pa.binary()),
                    }
                )

    return run


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Stored pieces of `docs` (doc_id, text): doc_id, piece, start, length, ids, and the number among
    the pieces of one length (`nth`) within a `task`."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length int, task int, nth long, ids binary"
    return store(docs.select("doc_id", "text").mapInArrow(_cut(tokenizer, capacity, end_id), schema), "pieces")


def ranked(cut: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """Stored pieces with their rank among all pieces of their length, and the plan that gives each rank its slot."""
    counted = cut.groupBy("task", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    ahead = store(counted.withColumn("ahead", F.coalesce(F.sum("n").over(before), F.lit(0))), "ahead")
    found = ahead.groupBy("length").agg(F.sum("n").alias("n")).collect()  # at most one row for each length
    counts = np.zeros(max((row["length"] for row in found), default=0) + 1, np.int64)
    for row in found:
        counts[row["length"]] = row["n"]
    ahead = ahead.select("task", "length", "ahead")
    if ahead.count() <= BROADCAST_ROWS:
        ahead = F.broadcast(ahead)
    rows = cut.join(ahead, ["task", "length"])
    return rows.select("doc_id", "piece", "start", "length", "ids", (F.col("nth") + F.col("ahead")).alias("rank")), counts


def _slotted(runs: np.ndarray, whole: bool):
    """Pieces with their sequence and offset; `whole` ones as the sequences that they are."""
    columns = [runs[name] for name in RUN.names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planned, blocks = np.rec.fromarrays(columns, RUN), Blocks()
        for batch in batches:
            if not batch.num_rows:
                continue
            length, rank = (batch.column(c).to_numpy().astype(np.int64) for c in ("length", "rank"))
            sequence, offset = slots(planned, length, rank)
            names = ["doc_id", "piece", "start", "length", "ids"]
            arrays = [*(batch.column(c) for c in names), pa.array(sequence), pa.array(offset, pa.int32())]
            rows = pa.RecordBatch.from_arrays(arrays, names=[*names, "sequence_id", "offset"])
            yield _rows_of(rows, blocks) if whole else rows

    return run


def _assembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sequences from pieces in the order of sequence and offset."""
    held: pa.RecordBatch | None = None
    blocks = Blocks()
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.concat_batches([held, batch]) if held is not None else batch
        sequence = rows.column("sequence_id").to_numpy()
        last = int(np.searchsorted(sequence, sequence[-1]))  # the last sequence may go on in the next batch
        held = rows.slice(last)
        if last:
            yield _rows_of(rows.slice(0, last), blocks)
    if held is not None:
        yield _rows_of(held, blocks)


def _rows_of(rows: pa.RecordBatch, compressed: Blocks) -> pa.RecordBatch:
    sequence = rows.column("sequence_id").to_numpy()
    firsts = np.flatnonzero(np.concatenate([[True], sequence[1:] != sequence[:-1]]))
    ends = np.concatenate([firsts, [len(sequence)]])
    blocks = [compressed.ids(block) for block in rows.column("ids").to_pylist()]
    names = ["doc_id", "piece", "start", "length", "offset"]
    members = pa.StructArray.from_arrays([rows.column(n) for n in names], names)
    return pa.RecordBatch.from_pydict(
        {
            "sequence_id": pa.array(sequence[firsts]),
            "n_tokens": pa.array(np.add.reduceat(rows.column("length").to_numpy(), firsts), pa.int32()),
            "ids": pa.array([np.concatenate(blocks[a:b]).tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.binary()),
            "pieces": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), members),
        }
    )


def packed(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """The packed sequences: sequence_id, n_tokens, ids (little-endian unsigned 32-bit), and the pieces in them.

    `pieces` is an array of (doc_id, piece, start, length, offset) in the order of offset.  A piece that
    fills a sequence alone is not moved.
    """
    rows, counts = ranked(pieces(docs, tokenizer, capacity, end_id))
    runs = plan(np.concatenate([counts, np.zeros(capacity + 1 - len(counts), np.int64)]))
    kind = docs.schema["doc_id"].dataType
    member = T.StructType().add("doc_id", kind).add("piece", "integer").add("start", "long").add("length", "integer").add("offset", "integer")
    schema = T.StructType().add("sequence_id", "long").add("n_tokens", "integer").add("ids", "binary").add("pieces", T.ArrayType(member))
    slotted = f"doc_id {kind.simpleString()}, piece int, start long, length int, ids binary, sequence_id long, offset int"
    shared = rows.where(F.col("length") < capacity).mapInArrow(_slotted(runs, whole=False), slotted)
    shared = shared.repartition("sequence_id").sortWithinPartitions("sequence_id", "offset")
    alone = rows.where(F.col("length") == capacity).mapInArrow(_slotted(runs, whole=True), schema)
    return alone.unionByName(shared.mapInArrow(_assembled, schema))


def digests(sequences: DataFrame) -> DataFrame:
    """One row per piece, read from the sequences' ids: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""

    def digest(p):
        ids = F.substring(F.col("ids"), p["offset"] * 4 + 1, p["length"] * 4)
        return F.struct(p["doc_id"], p["piece"], p["start"], p["length"], F.crc32(ids).alias("ids_crc32"), p["offset"])

    found = sequences.select("sequence_id", F.inline(F.transform("pieces", digest)))
    return found.select(
        "doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "sequence_id",
        F.col("offset").cast("long").alias("offset"),
    )
