"""Token ids in binary shards, compressed by a Re-Pair grammar with expansion lengths.

Documents are encoded in ascending order of identifier and written in shards of about `SHARD_TOKENS` ids.
Within a shard, frequent pairs of neighbouring ids are replaced by nonterminals, again and again; a pair
never crosses the end of a document.  The file holds the rules, the number of ids that each
nonterminal stands for, where each document begins, and the remaining symbols, so that any range
of ids of any document is decoded from its own symbols alone.

Each round counts all pairs, takes the most frequent ones as rules, and replaces their occurrences,
a more frequent pair going before a less frequent one that it overlaps; rules that end up with fewer than
`LEAST` uses are dropped.

Tasks write files under passing names and rename them, and a shard's name follows from its place in
the order, so a task that runs again leaves the same files.

Defined cases: a null text is encoded as the empty one (its only id is the end id); null identifiers come
last; rows with the same identifier are kept, in the order of a hash of their text; an empty table
gives no file.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskbook.llm.packing import CHUNK, MARKS, Rows, byte_letters, sized_slices
from riskbook.llm.storage import get_file, put_file, scratch, store
from riskbook.llm.text import as_text

MAGIC = b"RPAIR01\n"
HEAD = "<8s6Q"
SHARD_TOKENS = 1 << 19
#: Symbols fit in 16 bits as long as rules do not use up what the vocabulary leaves of them.
SYMBOLS = 1 << 16
ROUNDS = 6
RULES_A_ROUND = 2048
LEAST = 8
SLOT_BITS = 19
END_ID = 1
#: Bytes of shards that a task reads back, about.
READ_BYTES = 8_000_000


# -- the grammar -------------------------------------------------------------------


def compress(ids: np.ndarray, lengths: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols, symbols of each document, and rules (pairs; rule i is symbol base + i)."""
    symbols = ids.astype(np.uint32)
    ends = np.cumsum(lengths)[lengths > 0]  # place after each document's last symbol
    rules: list[np.ndarray] = []
    room = SYMBOLS - base
    none = 1 << SLOT_BITS
    stands = np.zeros(none + 1, np.uint64)
    for _ in range(ROUNDS):
        if len(symbols) < 2 or room <= 0:
            break
        key = (symbols[:-1].astype(np.uint64) << np.uint64(32)) | symbols[1:]
        slot = ((key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SLOT_BITS)).view(np.int64)
        slot[ends[:-1] - 1] = none  # no pair crosses the end of a document
        # of pairs that share a slot, the one that stands last goes first; others wait for a later round
        stands[slot] = key
        slot[stands[slot] != key] = none
        times = np.bincount(slot, minlength=none + 1)[:none]
        best = np.flatnonzero(times >= LEAST)
        if not len(best):
            break
        # equally frequent pairs go in the order of their hash, so that neighbours seldom wait for each other
        best = best[np.argsort(-times[best], kind="stable")[: min(RULES_A_ROUND, room)]]
        rank = np.full(none + 1, len(best), np.int32)
        rank[best] = np.arange(len(best), dtype=np.int32)
        mine = rank[slot]
        chosen = mine < len(best)
        chosen[1:] &= mine[1:] < mine[:-1]
        chosen[:-1] &= mine[:-1] <= mine[1:]
        places = np.flatnonzero(chosen)
        uses = np.bincount(mine[places], minlength=len(best))
        used = uses >= LEAST
        if not used.any():
            break
        places = places[used[mine[places]]]
        number = (np.cumsum(used) - 1).astype(np.uint32)
        pairs = stands[best[used]]
        rules.append(np.stack([pairs >> np.uint64(32), pairs & np.uint64(0xFFFFFFFF)], axis=1).astype(np.int64))
        symbols[places] = np.uint32(base) + number[mine[places]]
        left = np.ones(len(symbols), bool)
        left[places + 1] = False
        symbols = symbols[left]
        ends = ends - np.searchsorted(places, ends - 1)
        base += int(used.sum())
        room -= int(used.sum())
    counts = np.zeros(len(lengths), np.int64)
    counts[lengths > 0] = np.diff(np.concatenate([[0], ends]))
    return symbols, counts, np.concatenate(rules) if rules else np.zeros((0, 2), np.int64)


def expansion_lengths(rules: np.ndarray, base: int) -> np.ndarray:
    """Number of ids that each symbol from `base` stands for."""
    out = np.ones(base + len(rules), np.int64)
    for i, (a, b) in enumerate(rules):
        out[base + i] = out[a] + out[b]
    return out[base:]


def expand(symbols: np.ndarray, rules: np.ndarray, base: int) -> np.ndarray:
    """The ids that symbols stand for."""
    while True:
        deep = symbols >= base
        if not deep.any():
            return symbols
        place = np.arange(len(symbols)) + np.concatenate([[0], np.cumsum(deep)[:-1]])
        out = np.empty(len(symbols) + int(deep.sum()), np.int64)
        pair = rules[symbols[deep] - base]
        out[place[~deep]] = symbols[~deep]
        out[place[deep]] = pair[:, 0]
        out[place[deep] + 1] = pair[:, 1]
        symbols = out


# -- the file ------------------------------------------------------------------------


def pack(doc_ids: list, lengths: np.ndarray, ids: np.ndarray, base: int) -> bytes:
    """A shard: head, identifiers, first symbols and first ids of documents, rules, lengths, symbols."""
    symbols, counts, rules = compress(ids, lengths, base)
    known = np.array([d is not None for d in doc_ids], np.uint8)
    parts = [
        np.array([d or 0 for d in doc_ids], "<i8"),
        known,
        np.concatenate([[0], np.cumsum(counts)]).astype("<i8"),
        np.concatenate([[0], np.cumsum(lengths)]).astype("<i8"),
        rules.astype("<u4"),
        expansion_lengths(rules, base).astype("<u4"),
        symbols.astype("<u2" if base + len(rules) <= SYMBOLS else "<u4"),
    ]
    width = parts[-1].dtype.itemsize
    head = struct.pack(HEAD, MAGIC, len(doc_ids), len(rules), len(symbols), len(ids), base, width)
    return b"".join([head, *(p.tobytes() for p in parts)])


class Shard:
    """A packed shard; documents are decoded one by one, or any range of their ids."""

    def __init__(self, data: bytes):
        magic, docs, rules, symbols, self.n_ids, self.base, width = struct.unpack_from(HEAD, data)
        if magic != MAGIC:
            raise ValueError("not a token shard")
        at = struct.calcsize(HEAD)

        def read(dtype: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, dtype, count, at)
            at += out.nbytes
            return out

        ids, known = read("<i8", docs), read("u1", docs)
        self.doc_ids = [int(d) if k else None for d, k in zip(ids, known, strict=True)]
        self.first_symbol, self.first_id = read("<i8", docs + 1), read("<i8", docs + 1)
        self.rules = read("<u4", 2 * rules).reshape(-1, 2).astype(np.int64)
        self.lengths = read("<u4", rules).astype(np.int64)
        self.symbols = read(f"<u{width}", symbols)

    def length(self, doc: int) -> int:
        return int(self.first_id[doc + 1] - self.first_id[doc])

    def decode(self, doc: int, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids of the document at a place of the shard, from `start` to `stop`.

        Expansion lengths tell which symbols cover the range; only those are expanded.
        """
        symbols = self.symbols[self.first_symbol[doc] : self.first_symbol[doc + 1]].astype(np.int64)
        stop = self.length(doc) if stop is None else min(stop, self.length(doc))
        if start > 0 or stop < self.length(doc):
            size = np.ones(len(symbols), np.int64)
            deep = symbols >= self.base
            size[deep] = self.lengths[symbols[deep] - self.base]
            ends = np.cumsum(size)
            a, b = np.searchsorted(ends, start, "right"), np.searchsorted(ends, stop, "left") + 1
            begin = int(ends[a - 1]) if a else 0
            symbols, start, stop = symbols[a:b], start - begin, stop - begin
        return expand(symbols, self.rules, self.base)[start:stop].astype("<u4")

    def every(self) -> np.ndarray:
        """Ids of all documents in a row, each rule expanded once."""
        rules = expand(np.arange(self.base, self.base + len(self.rules)), self.rules, self.base)
        table = np.concatenate([np.arange(self.base), rules]).astype("<u4")
        size = np.concatenate([np.ones(self.base, np.int64), self.lengths])
        start = np.concatenate([[0], np.cumsum(size)[:-1]])
        symbols = self.symbols.astype(np.int64)
        count = size[symbols]
        ends = np.cumsum(count)
        return table[np.repeat(start[symbols] - ends + count, count) + np.arange(self.n_ids)]


# -- encoding --------------------------------------------------------------------------

#: Letters that one byte or two hold and the tokenizer lowers as Arrow does.
WORD = "[A-Za-zªµºÀ-ÖØ-öø-ÿ]+"


class Encoder:
    """Ids of texts by the tokenizer, each different word of a slice encoded once.

    The tokenizer drops white space and never joins what white space parts, so a text's ids are its
    words' ids in a row.  Texts that hold one of `special` are encoded whole.  Texts are cut at their spaces, and
    equal runs between two spaces are encoded once: a word of Latin letters, or one with a mark after it, goes
    to the tokenizer's model, any other run to the tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        # besides special tokens, the four separators that Python takes for white space and the tokenizer doesn't
        self.special = [*(t.content for t in self.tokenizer.get_added_tokens_decoder().values()), *"\x1c\x1d\x1e\x1f"]
        self.size = self.tokenizer.get_vocab_size()
        self.letters = byte_letters()
        self.marks = {mark: self.whole(mark) for mark in MARKS}

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def word(self, word: str) -> list[int]:
        """Ids of a word; letters with at most one mark after them go to the model."""
        core = word[:-1] if word[-1] in MARKS else word
        if not core.isalpha() or not (core.isascii() or max(core) <= "ÿ"):
            return self.whole(word)
        shown = core.lower().encode().decode("latin-1").translate(self.letters)
        return [*(t.id for t in self.model.tokenize(shown)), *(self.marks[word[-1]] if core != word else ())]

    def runs(self, runs: pa.Array) -> Rows:
        """Ids of different runs between spaces."""
        alone = pc.match_substring_regex(runs, f"^{WORD}$")
        marked = pc.match_substring_regex(runs, f"^{WORD}[.,;:!?]$")
        stem, last = pc.utf8_slice_codeunits(runs, 0, -1), pc.utf8_slice_codeunits(runs, -1)
        none = pa.scalar(None, runs.type)
        core = pc.utf8_lower(pc.if_else(alone, runs, pc.if_else(marked, stem, none))).dictionary_encode()
        shown = "\n".join(core.dictionary.to_pylist()).encode().decode("latin-1").translate(self.letters)
        words, tokenize = shown.split(self.letters[10])[: len(core.dictionary)], self.model.tokenize
        parts = [Rows.of([])]
        for i in range(0, len(words), CHUNK):
            parts.append(Rows.of([[t.id for t in tokenize(w)] for w in words[i : i + CHUNK]]))
        alone, marked = (x.to_numpy(zero_copy_only=False) for x in (alone, marked))
        rest = np.flatnonzero(~alone & ~marked)
        texts = runs.take(pa.array(rest)).to_pylist()
        marks = len(words)
        others, nothing = marks + len(MARKS), marks + len(MARKS) + len(rest)
        parts.append(Rows.of([self.marks[m] for m in MARKS]))
        parts.append(Rows.of([[i for word in t.split() for i in self.word(word)] for t in texts]))
        table = Rows.joined([*parts, Rows.of([[]])])

        first = pc.fill_null(core.indices, -1).to_numpy().astype(np.int64)
        first[rest] = others + np.arange(len(rest))
        second = np.full(len(runs), nothing)
        second[marked] = marks + pc.index_in(last, pa.array(MARKS, last.type)).to_numpy(zero_copy_only=False)[marked].astype(np.int64)
        both = table.take(np.stack([first, second], 1).ravel())
        return Rows(both.ids, both.lengths.reshape(-1, 2).sum(1))

    def encode(self, column: pa.Array) -> list[np.ndarray]:
        """Ids of each text."""
        texts = as_text(column)
        odd = pa.array(np.zeros(len(texts), bool))
        for token in self.special:
            odd = pc.or_(odd, pc.match_substring(texts, token))
        split = pc.split_pattern(pc.if_else(odd, "", texts), pattern=" ")
        cuts = split.offsets.to_numpy().astype(np.int64)
        cuts -= cuts[0]
        coded = split.flatten().dictionary_encode()
        table, code = self.runs(coded.dictionary), coded.indices.to_numpy()
        odd = odd.to_numpy(zero_copy_only=False)
        out: list[np.ndarray] = []
        steps = np.flatnonzero(np.diff(cuts[:-1] >> 19, prepend=-1)) if len(texts) else []  # about 2 ** 19 runs at once
        for i, j in zip(steps, [*steps[1:], len(texts)], strict=True):
            found = table.take(code[cuts[i] : cuts[j]])
            ends = np.concatenate([[0], np.cumsum(found.lengths)])[cuts[i + 1 : j + 1] - cuts[i]]
            out += np.split(found.ids.astype(np.int64), ends[:-1])
        for i in np.flatnonzero(odd):
            out[i] = np.array(self.whole(texts[i].as_py()), np.int64)
        return out


# -- Spark ---------------------------------------------------------------------------------


def _written(folder: str, tokenizer: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer)
        part, number = TaskContext.get().partitionId(), 0
        base = max(encoder.size, end_id + 1)
        held: list[tuple] = []
        total = 0

        def flush() -> pa.RecordBatch:
            nonlocal held, total, number
            name = f"{part:07d}-{number:07d}.rpair"
            lengths = np.array([len(ids) for _, ids in held], np.int64)
            data = pack([d for d, _ in held], lengths, np.concatenate([ids for _, ids in held]), base)
            put_file(folder, name, [data])
            row = {"file": [name], "documents": [len(held)], "tokens": [int(lengths.sum())], "bytes": [len(data)]}
            held, total, number = [], 0, number + 1
            return pa.RecordBatch.from_pydict(row)

        for batch in batches:
            for piece in sized_slices(batch):
                for doc_id, ids in zip(piece.column("doc_id").to_pylist(), encoder.encode(piece.column("text")), strict=True):
                    held.append((doc_id, np.append(ids, end_id)))
                    total += len(ids) + 1
                    if total >= SHARD_TOKENS:
                        yield flush()
        if held:
            yield flush()

    return run


def write(docs: DataFrame, tokenizer: str, folder: str, end_id: int = END_ID) -> DataFrame:
    """Encode `docs` (doc_id, text) into a folder; returns the shards in order.

    Rows have file, documents, tokens, bytes, and start (ids in all shards before).
    """
    order = ["doc_id", "__tie", "text"]
    rows = docs.select("doc_id", "text").withColumn("__tie", F.xxhash64("text"))
    by = [F.asc_nulls_last("doc_id"), "__tie"]
    rows = rows.repartitionByRange(*by).sortWithinPartitions(F.asc_nulls_last(order[0]), *order[1:])
    made = rows.mapInArrow(_written(folder, tokenizer, end_id), "file string, documents long, tokens long, bytes long")
    made = store(made, "shards")
    # ids before: of the tasks before, one row each, and of the task's own shards before
    task = F.substring("file", 1, 7).alias("task")
    earlier = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = made.groupBy(task).agg(F.sum("tokens").alias("tokens"))
    tasks = tasks.select("task", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("ahead"))
    own = Window.partitionBy("task").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    placed = made.withColumn("task", task).join(tasks, "task")
    start = F.col("ahead") + F.coalesce(F.sum("tokens").over(own), F.lit(0))
    return placed.withColumn("start", start).drop("task", "ahead")


def _read(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist(), strict=True):
                shard = Shard(get_file(folder, file))
                ids = shard.every()
                first = shard.first_id
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": pa.array(shard.doc_ids, pa.int64()),
                        "start": pa.array(first[:-1] + start),
                        "n_tokens": pa.array(np.diff(first)),
                        "ids_crc32": pa.array(
                            [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(first[:-1], first[1:], strict=True)], pa.int64()
                        ),
                        "n_symbols": pa.array(np.diff(shard.first_symbol)),
                    }
                )

    return run


def read_digests(shards: DataFrame, folder: str) -> DataFrame:
    """One row per document, decoded from the files: doc_id, start, n_tokens, ids_crc32, n_symbols."""
    shards = store(shards.select("file", "start", "bytes"), "starts")
    size = shards.agg(F.sum("bytes")).first()[0] or 0
    spread = shards.repartition(max(1, -(-size // READ_BYTES)), "file")  # many shards a task, by their bytes
    return spread.mapInArrow(_read(folder), "doc_id long, start long, n_tokens long, ids_crc32 long, n_symbols long")


def read_ids(shards: DataFrame, folder: str) -> DataFrame:
    """Documents with all their ids, decoded from the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column("file").to_pylist():
                shard = Shard(get_file(folder, file))
                ids = pa.array(shard.every().astype(np.int64))
                lists = pa.LargeListArray.from_arrays(pa.array(shard.first_id), ids).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(shard.doc_ids, pa.int64()), lists], names=["doc_id", "ids"])

    return shards.select("file").mapInArrow(run, "doc_id long, ids array<bigint>")


def round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write shards into a new folder of the cluster's shared one, and read them back."""
    folder = f"{scratch(docs.sparkSession)}/tokens"
    return read_digests(write(docs, tokenizer, folder), folder)
