"""BPE encoding and decoding with a tokenization automaton.

The automaton reads token sequences: state [t] is reached by the arc labelled t, and the sequences it accepts are
exactly those that BPE produces.  It starts with one arc per base symbol and no restriction, and each
merge (u, v) -> uv adds one gadget, in order:

* wherever u and then v could be read, the arc uv is added; it ends in state [uv], a copy of state [v];
* the arc v leaves state [u], for u v is from now on spelled uv.

A state is stored copy-on-write: the merge that made it, the state it was copied from, and the arc that each later
gadget took away.  Looking an arc up walks these records back to base symbols, and the answer enters the
transition table, so each pair of tokens is resolved once.  As the automaton is deterministic, every prefix of a
word has one path; the state it ends in is looked up for each prefix in turn, and the path is the encoding.

Only the tables, whose size the vocabulary bounds, are broadcast.
"""

from __future__ import annotations

import json
import struct
import unicodedata
from collections.abc import Iterator, Sequence

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces, text_or_empty

#: Distinct words and transitions that a worker remembers before it starts afresh.
MEMORY = 200_000


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in vocabulary files.

    Bytes that print as themselves do so; the others take the characters from 256 on, in order.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return [chr(b) if b in plain else chr(256 + rest.index(b)) for b in range(256)]


def compile_automaton(path: str) -> dict:
    """Tables of the automaton for a vocabulary file (BPE with a word-end suffix, NFC and lower case)."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model = spec["model"]
    vocab, end = model["vocab"], model["end_of_word_suffix"]
    steps = [n["type"] for n in spec["normalizer"]["normalizers"]]
    if steps != ["NFC", "Replace", "Lowercase"] or spec["decoder"] is not None or model["ignore_merges"]:
        raise ValueError(f"not a vocabulary of the supported kind: {path}")
    size = 1 + max([*vocab.values(), *[t["id"] for t in spec["added_tokens"]]])
    born, left, right = [-1] * size, [0] * size, [0] * size
    removed: dict[int, int] = {}
    tables = {"born": born, "left": left, "right": right, "removed": removed}
    symbols = byte_symbols()
    inner = {bytes([b]): vocab[s] for b, s in enumerate(symbols)}
    final = {bytes([b]): vocab[s + end] for b, s in enumerate(symbols)}
    spelled = {vocab[s]: bytes([b]) for b, s in enumerate(symbols)}
    spelled |= {vocab[s + end]: bytes([b]) for b, s in enumerate(symbols)}
    for step, merge in enumerate(model["merges"]):
        first, second = merge.split(" ") if isinstance(merge, str) else merge
        u, v, made = vocab[first], vocab[second], vocab[first + second]
        # A merge whose parts can no longer meet adds no arc.
        if u in spelled and v in spelled and arc_exists(tables, u, v, step):
            born[made], left[made], right[made] = step, u, v
            spelled[made] = spelled[u] + spelled[v]
            (final if second.endswith(end) else inner)[spelled[made]] = made
        removed.setdefault(u << 20 | v, step)
    labels = [b""] * size
    for token, i in vocab.items():
        labels[i] = token.encode("utf-8")
    special = {}
    for t in spec["added_tokens"]:
        if t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"]:
            raise ValueError(f"not a plain special token: {t['content']}")
        special[t["content"]] = t["id"]
        labels[t["id"]] = t["content"].encode("utf-8")
    pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
    return tables | {
        "inner": inner,
        "final": final,
        "longest": max(map(len, [*inner, *final])),
        "labels": labels,
        "special": special,
        "pattern": pattern.replace(r"\s", r"\p{White_Space}"),
    }


def arc_exists(tables: dict, state: int, label: int, before: int) -> bool:
    """Whether state [``state``] had an arc ``label`` before gadget number ``before``."""
    born, left, right, removed = tables["born"], tables["left"], tables["right"], tables["removed"]
    while True:
        if removed.get(state << 20 | label, before) < before:
            return False
        made, added = born[state], born[label]
        if made < 0 and added < 0:
            return True
        if made > added:
            # The state was copied from that of its right part, before its gadget took an arc away.
            state, before = right[state], made
        elif added > made:
            # The arc was added where its left part could be read, after its gadget had taken an arc away.
            label, before = left[label], added + 1
        else:
            state, label, before = right[state], left[label], made


class Encoder:
    """Encodes texts with the tables of ``compile_automaton``."""

    def __init__(self, tables: dict) -> None:
        self.tables = tables
        self.transitions: dict[int, bool] = {}
        self.known: dict[str, bytes] = {}
        self.inner, self.final, self.longest = tables["inner"], tables["final"], tables["longest"]
        self.pieces = regex.compile(tables["pattern"])
        self.special = tables["special"]
        escaped = "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))
        self.specials = regex.compile(f"({escaped})") if escaped else None
        self.never = len(tables["born"]) + len(tables["removed"])

    def _may_follow(self, state: int, label: int) -> bool:
        if len(self.transitions) > 5 * MEMORY:
            self.transitions.clear()
        found = arc_exists(self.tables, state, label, self.never)
        self.transitions[state << 20 | label] = found
        return found

    def word(self, word: bytes) -> list[int]:
        """Labels of the one path that spells a pre-split word.

        Longer labels are tried first.  A prefix has one path only, so a place from which the word could not be
        finished is not entered again, and the work is linear in the length.
        """
        inner, final, known = self.inner, self.final, self.transitions.get
        label = final.get(word)
        if label is not None:
            return [label]
        n, i, state, path, back, dead = len(word), 0, -1, [], [], set()
        size = min(self.longest, n)
        while True:
            while size > 0:
                j = i + size
                label = final.get(word[i:]) if j == n else inner.get(word[i:j])
                if label is not None and j not in dead:
                    fits = True if state < 0 else known(state << 20 | label)
                    if fits is None:
                        fits = self._may_follow(state, label)
                    if fits:
                        path.append(label)
                        if j == n:
                            return path
                        back.append((i, state, size))
                        i, state, size = j, label, min(self.longest, n - j) + 1
                size -= 1
            dead.add(i)
            i, state, size = back.pop()
            path.pop()
            size -= 1

    def chunk(self, chunk: str) -> bytes:
        """Ids of text without special tokens, as little-endian unsigned 32-bit integers."""
        folded = unicodedata.normalize("NFC", chunk).replace("Σ", "σ").lower()
        if folded.isalpha():
            ids = self.word(folded.encode("utf-8"))
        else:
            ids = [i for piece in self.pieces.findall(folded) for i in self.word(piece.encode("utf-8"))]
        return struct.pack(f"<{len(ids)}I", *ids)

    def plain(self, text: str) -> bytes:
        # White space always separates words; only the four separators below do so in Python alone.
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return self.chunk(text)
        known, chunks = self.known, text.split()
        for c in set(chunks).difference(known):
            if len(known) > MEMORY:
                known.clear()
                return b"".join([known[c] if c in known else known.setdefault(c, self.chunk(c)) for c in chunks])
            known[c] = self.chunk(c)
        return b"".join(map(known.__getitem__, chunks))

    def text(self, text: str) -> bytes:
        if self.specials is None or not self.specials.search(text):
            return self.plain(text)
        parts = self.specials.split(text)
        return b"".join(
            self.special[p].to_bytes(4, "little") if p in self.special else self.plain(p) for p in parts if p
        )


def label_text(tokens: bytes, labels: Sequence[bytes]) -> bytes:
    """The labels of encoded ids joined by spaces, as the vocabulary's own library decodes without a decoder."""
    return b" ".join(map(labels.__getitem__, memoryview(tokens).cast("I")))


def encode(
    docs: DataFrame, path: str, text: str = "text", keep: Sequence[str] | None = None, decoded: bool = False
) -> DataFrame:
    """Columns ``keep`` (all by default), ``n_tokens`` and ``tokens``: ids as little-endian 32-bit integers.

    With ``decoded``, also the text that the ids decode to, as ``decode`` gives it, by the same worker.  The vocabulary file
    is read on the driver.  A null text counts as empty and has no tokens.  Columns named like the added ones are
    replaced.
    """
    added = ("n_tokens", "tokens", "decoded")[: 3 if decoded else 2]
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in added]
    tables = docs.sparkSession.sparkContext.broadcast(compile_automaton(path))
    rows = docs.select(*kept, text_or_empty(docs[text]).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tables.value)
        for part in pieces(batches):
            ids = [encoder.text(x.as_py()) for x in part.column("__text")]
            counts = pa.array([len(x) // 4 for x in ids], pa.int64())
            columns = [*[part.column(c) for c in kept], counts, pa.array(ids, pa.binary())]
            if decoded:
                texts = [label_text(x, tables.value["labels"]) for x in ids]
                columns.append(pa.array(texts, pa.binary()).cast(pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, *added])

    kinds = {"n_tokens": F.lit(0).cast("bigint"), "tokens": F.lit(b""), "decoded": F.lit("")}
    return rows.mapInArrow(run, rows.select(*kept, *[kinds[c].alias(c) for c in added]).schema)


def decode(encoded: DataFrame, path: str, keep: Sequence[str] | None = None) -> DataFrame:
    """Columns ``keep`` (all by default) and ``decoded``, the labels of ``tokens``; null tokens give an empty text."""
    kept = [c for c in (encoded.columns if keep is None else keep) if c.lower() != "decoded"]
    labels = encoded.sparkSession.sparkContext.broadcast(compile_automaton(path)["labels"])
    rows = encoded.select(*kept, F.coalesce("tokens", F.lit(b"")).alias("__tokens"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches):
            texts = [label_text(x.as_py(), labels.value) for x in part.column("__tokens")]
            column = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], column], names=[*kept, "decoded"])

    return rows.mapInArrow(run, rows.select(*kept, F.lit("").alias("decoded")).schema)
