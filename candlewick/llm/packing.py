"""Best-fit packing of token sequences.

Best-fit decreasing looks at lengths only, and there are no more lengths than a sequence has places.  So the plan is made
from the number of pieces of each length: bins of equal remaining capacity are kept as ranges of bin numbers, a segment
tree over the capacities names the tightest open one in logarithmic time, and a whole range is filled at once.
What comes out is what best-fit decreasing gives piece by piece.

A length opens or cuts at most four ranges, and a bin holds few distinct lengths (they add up to its capacity), so the rules
number at most ``4 * capacity * sqrt(2 * capacity)`` however many documents there are; that bound allows the broadcast.
Every piece finds its rule by its length and its number among the pieces of that length, which is counted per task and
completed by running sums over the tasks' counts.  No group is gathered and the pieces are not sorted.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewick.sources.scratch import materialise

from .bpe import Encoder, byte_symbols
from .common import pieces as short_batches
from .common import text_or_empty

CAPACITY = 2048
SEPARATOR = 0
#: Words and parts of words that a worker remembers before it starts afresh.
MEMORY = 300_000
RULE = ("length", "start", "bins", "per_bin", "first_bin", "offset")
ADDED = ("piece", "start", "length", "tokens", "__part", "__rank")


def read_vocabulary(path: str) -> str:
    """Text of a vocabulary file for the tokenizers library (BPE with a word-end suffix, NFC and lower case)."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    spec = json.loads(text)
    steps = [n["type"] for n in spec["normalizer"]["normalizers"]]
    if steps != ["NFC", "Replace", "Lowercase"] or spec["model"]["ignore_merges"] or not spec["model"]["end_of_word_suffix"]:
        raise ValueError(f"not a vocabulary of the supported kind: {path}")
    if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
        raise ValueError(f"not plain special tokens: {path}")
    return text


class LibraryEncoder(Encoder):
    """Splits a text as the vocabulary says and has the tokenizers library encode each distinct part once."""

    def __init__(self, vocabulary: str) -> None:
        from tokenizers import Tokenizer

        spec = json.loads(vocabulary)
        self.model = Tokenizer.from_str(vocabulary).model
        self.symbols = byte_symbols()
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pieces = regex.compile(pattern.replace(r"\s", r"\p{White_Space}"))
        # The same pattern for text without other letters and digits than these.
        self.plain_pieces = re.compile(pattern.replace(r"\p{L}", "A-Za-z").replace(r"\p{N}", "0-9"), re.ASCII)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        escaped = "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))
        self.specials = regex.compile(f"({escaped})") if escaped else None
        self.known: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def part(self, part: str) -> bytes:
        ids = self.parts.get(part)
        if ids is None:
            if len(self.parts) > MEMORY:
                self.parts.clear()
            spelled = part if part.isalpha() and part.isascii() else "".join([self.symbols[b] for b in part.encode("utf-8")])
            ids = self.parts[part] = b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(spelled)])
        return ids

    def chunk(self, chunk: str) -> bytes:
        if chunk.isascii():
            folded = chunk.lower()
            return self.part(folded) if folded.isalpha() else b"".join(map(self.part, self.plain_pieces.findall(folded)))
        folded = unicodedata.normalize("NFC", chunk).replace("Σ", "σ").lower()
        return b"".join(map(self.part, self.pieces.findall(folded)))

    def plain(self, text: str) -> bytes:
        # White space always separates words; only the four separators below do so in Python alone.
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return self.chunk(text)
        chunks, known = text.split(), self.known
        new = {c: self.chunk(c) for c in set(chunks).difference(known)}
        if len(known) + len(new) > 2 * MEMORY:
            new = {c: known[c] if c in known else new[c] for c in chunks}
            known.clear()
        known.update(new)
        return b"".join(map(known.__getitem__, chunks))


def pieces(
    docs: DataFrame,
    path: str,
    capacity: int = CAPACITY,
    separator: int = SEPARATOR,
    text: str = "text",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Columns ``keep`` (all by default) and, for each piece of a document, ``piece`` (from 0), ``start``, ``length`` and ``tokens``.

    A document is the ids of its whole text and the separator; null counts as empty and is the separator alone.  A document
    longer than ``capacity`` is cut into pieces of that length, the last of which may be shorter.  Tokens are little-endian
    32-bit integers.  ``__part`` and ``__rank`` number the pieces of one length within a task; they hold once the result is
    written.  Columns named like the added ones are replaced; repeated rows stay repeated.
    """
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in ADDED]
    shared = docs.sparkSession.sparkContext.broadcast({"vocabulary": read_vocabulary(path)})
    rows = docs.select(*kept, text_or_empty(docs[text]).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A worker keeps its copy of the broadcast, and with it the words it knows, from task to task.
        held, end = shared.value, separator.to_bytes(4, "little")
        if "encoder" not in held:
            held["encoder"] = LibraryEncoder(held["vocabulary"])
        encoder = held["encoder"]
        part, seen = TaskContext.get().partitionId(), [0] * (capacity + 1)
        for batch in short_batches(batches):
            at, number, start, length, tokens, rank = [], [], [], [], [], []
            for i, value in enumerate(batch.column("__text")):
                ids = encoder.text(value.as_py()) + end
                for k, first in enumerate(range(0, len(ids), 4 * capacity)):
                    cut = ids[first : first + 4 * capacity]
                    n = len(cut) // 4
                    at.append(i)
                    number.append(k)
                    start.append(first // 4)
                    length.append(n)
                    tokens.append(cut)
                    rank.append(seen[n])
                    seen[n] += 1
            whose = pa.array(at, pa.int32())
            columns = [batch.column(c).take(whose) for c in kept]
            columns += [pa.array(number, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64())]
            columns += [pa.array(tokens, pa.binary()), pa.array([part] * len(at), pa.int32()), pa.array(rank, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, *ADDED])

    kinds = {"piece": F.lit(0), "tokens": F.lit(b""), "__part": F.lit(0)}
    added = [kinds.get(c, F.lit(0).cast("bigint")).alias(c) for c in ADDED]
    return rows.mapInArrow(run, rows.select(*kept, *added).schema)


class OpenBins:
    """Ranges of bin numbers by remaining capacity, with a segment tree that finds the tightest open capacity."""

    def __init__(self, capacity: int) -> None:
        self.size = 1 << capacity.bit_length()
        self.open = [False] * (2 * self.size)
        self.ranges: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]

    def _mark(self, room: int) -> None:
        i = self.size + room
        self.open[i] = bool(self.ranges[room])
        while i > 1:
            i //= 2
            self.open[i] = self.open[2 * i] or self.open[2 * i + 1]

    def put(self, room: int, first: int, n: int) -> None:
        if n:
            self.ranges[room].append((first, n))
            self._mark(room)

    def take(self, room: int) -> tuple[int, int]:
        found = self.ranges[room].pop()
        self._mark(room)
        return found

    def tightest(self, length: int) -> int | None:
        """Smallest remaining capacity of an open bin that ``length`` fits in."""
        i = self.size + length
        while not self.open[i]:
            # Up while this is a right child, then to the right neighbour.
            while i % 2:
                i //= 2
                if i <= 1:
                    return None
            i += 1
        while i < self.size:
            i = 2 * i if self.open[2 * i] else 2 * i + 1
        return i - self.size


def plan(counts: Mapping[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Rules (``RULE``) of best-fit decreasing for ``counts`` pieces of each length, sorted by length and start.

    Number i of a length, from ``start`` on, goes to bin ``first_bin + (i - start) // per_bin``, at
    ``offset + (i - start) % per_bin * length``.
    """
    bins, made, rules = OpenBins(capacity), 0, []
    for length in sorted(counts, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"no piece of {length} fits {capacity}")
        done, total = 0, counts[length]
        while done < total:
            room = bins.tightest(length)
            if room is None:
                room, n = capacity, -(-(total - done) // (capacity // length))
                bins.put(room, made, n)
                made += n
            first, n = bins.take(room)
            # The bin just filled stays the tightest while it takes another of the same length.
            fits, left = room // length, total - done
            used, each = (min(n, left // fits), fits) if left >= fits else (1, left)
            rules.append((length, done, used, each, first, capacity - room))
            bins.put(room, first + used, n - used)
            bins.put(room - each * length, first, used)
            done += used * each
    return np.array(sorted(rules), dtype=np.int64).reshape(-1, len(RULE))


def place(written: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Written ``pieces`` with ``sequence_id`` and ``offset``: where best-fit decreasing puts each piece.

    The driver sees one count per length, at most ``capacity`` of them.
    """
    spark = written.sparkSession
    counts = materialise(written.groupBy("__part", "length").agg(F.count(F.lit(1)).alias("__n")), "piece-counts")
    totals = counts.groupBy("length").agg(F.sum("__n").alias("n")).collect()
    rules = spark.sparkContext.broadcast(plan({r["length"]: r["n"] for r in totals}, capacity))
    before = F.sum("__n").over(Window.partitionBy("length").orderBy("__part")) - F.col("__n")
    starts = materialise(counts.select("__part", "length", before.alias("__before")), "piece-starts")
    kept = [c for c in written.columns if not c.startswith("__") and c.lower() not in ("sequence_id", "offset")]
    rows = written.join(starts, ["__part", "length"]).select(*kept, (F.col("__before") + F.col("__rank")).alias("__rank"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = rules.value
        keys = table[:, 0] << 48 | table[:, 1]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "__rank"))
            _, start, _, per_bin, first_bin, offset = table[np.searchsorted(keys, length << 48 | rank, side="right") - 1].T
            bins, turn = np.divmod(rank - start, per_bin)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], pa.array(first_bin + bins), pa.array(offset + turn * length)],
                names=[*kept, "sequence_id", "offset"],
            )

    added = [F.lit(0).cast("bigint").alias(c) for c in ("sequence_id", "offset")]
    return rows.mapInArrow(run, rows.select(*kept, *added).schema)


def sequences(placed: DataFrame) -> DataFrame:
    """``sequence_id``, ``n_tokens`` and ``tokens`` of each packed sequence; a sequence holds at most its capacity of pieces."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "tokens")))
    joined = placed.groupBy("sequence_id").agg(parts.alias("__parts"), F.sum("length").alias("n_tokens"))
    tokens = F.aggregate("__parts", F.lit(b""), lambda done, part: F.concat(done, part["tokens"]))
    return joined.select("sequence_id", "n_tokens", tokens.alias("tokens"))
