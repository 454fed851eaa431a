"""Secrets in texts: patterns, and random strings told from identifiers by Markov models.

Patterns find the well-marked secrets.  Every other run of ``CANDIDATE`` characters is scored by two
first-order character models, one of random strings and one of ordinary identifiers, and is a secret if the log of
their likelihood ratio exceeds ``EVIDENCE``.  Both models are trained on labelled samples, and no run that is to be judged
is in them.  Random are the values that the patterns found and digests of the document ids in three alphabets.  Ordinary are
names, paths and numbers put together from ``WORDS`` and from the plain words and numbers of the texts: words of letters that are
too short for a candidate and stand alone, so that secrets, however many there are, do not teach the model that they are
ordinary.  Training counts pairs of characters over all documents, each word once for a batch of rows; the
counts, at most two tables of 70 x 70, are all that reaches the driver.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.sources.scratch import materialise

from .common import pieces, text_or_empty

ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
KEYWORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
MIN_VALUE = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
#: Order in which kinds are listed at equal starts.
KINDS = ("assign", "access", "hex", "random")
CANDIDATE = r"[A-Za-z0-9+/_=-]{16,}"
#: Nats by which a random origin has to be likelier: about one secret in twenty thousand candidates.
EVIDENCE = 10.0
#: Fewest different characters of a random string; runs of dashes or of one letter are none.
MIN_VARIETY = 6
#: Weight of a character's own frequency in what follows another one, in observed pairs.
SMOOTHING = 10.0
REDACTED = "[secret]"
#: Labelled sample of words that names are made of, for texts that have few plain words.
WORDS = """
about access account action active address after again agent alert alias align allow amount angle answer append apply archive
array assert async attach author backup balance banner batch before below between binary block board border bottom branch
bridge browser buffer build button bytes cache calendar camera cancel capture center chain change channel character check
child choice class clean client clock close cluster code collect color column command comment common compare complete
config confirm connect console content context control convert copy count create current cursor custom data date debug
default define delete depth description design detail device digest direct display document domain double download draft
driver during dynamic edge editor element empty enable encode energy engine entity entry error event every example
exchange execute expand expect export extend external factor failure feature field figure file filter final first folder
format forward frame function future general get global group handle header height hidden history image import
""".split()

_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-."
_SIZE = len(_ALPHABET) + 2  # a start symbol, and one for any other character
_CODE = np.full(256, _SIZE - 1, dtype=np.int64)
_CODE[np.frombuffer(_ALPHABET.encode(), dtype=np.uint8)] = np.arange(1, len(_ALPHABET) + 1)
_CODE[ord("\n")] = 0

_SPAN = "struct<kind:string,start:int,end:int>"

_word = re.compile(r"(?<![\w+/=.-])[A-Za-z][a-z]{2,14}(?![\w+/=-])")
_number = re.compile(r"(?<![\w+/=-])[0-9][0-9-]{3,}(?![\w+/=-])")
_JOINTS = ("_", "-", "/", "", "_", "/")

_assign = re.compile(ASSIGN, re.IGNORECASE | re.ASCII)
_access = re.compile(ACCESS)
_hex = re.compile(HEX)
_candidate = re.compile(CANDIDATE)


def base_spans(text: str) -> tuple[list[tuple[int, str, int]], list[str]]:
    """Pattern matches as (start, kind, end) in order, and their values."""
    found, values = [], []
    low = text.lower()
    if any(word in low for word in KEYWORDS):
        for m in _assign.finditer(text):
            if len(m[2]) >= MIN_VALUE:
                found.append((m.start(), "assign", m.end()))
                values.append(m[2])
    for kind, pattern in (("access", _access), ("hex", _hex)):
        for m in pattern.finditer(text):
            found.append((m.start(), kind, m.end()))
            values.append(m[0])
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[1]))), values


def candidate_spans(text: str, base: Sequence[tuple[int, str, int]]) -> list[tuple[int, int]]:
    """Candidate runs that share no character with a pattern match."""
    out, at = [], 0
    ends = sorted((s, e) for s, _, e in base)
    for m in _candidate.finditer(text):
        while at < len(ends) and ends[at][1] <= m.start():
            at += 1
        if at == len(ends) or ends[at][0] >= m.end():
            out.append(m.span())
    return out


def pair_counts(strings: Sequence[str]) -> np.ndarray:
    codes = _CODE[np.frombuffer(("\n" + "\n".join(strings)).encode("utf-8"), dtype=np.uint8)]
    counts = np.bincount(codes[:-1] * _SIZE + codes[1:], minlength=_SIZE * _SIZE) if len(strings) else np.zeros(_SIZE * _SIZE)
    counts = counts.reshape(_SIZE, _SIZE).astype(np.int64)
    counts[:, 0] = 0
    return counts


def digests(key: object) -> list[str]:
    """Random-looking strings in three alphabets, made from an id."""
    d = hashlib.sha256(str(key).encode()).digest()
    plain = base64.b64encode(d).decode().rstrip("=")
    letters = "".join(_ALPHABET[b % 62] for b in d)
    return [d.hex()[:40], plain, letters]


def ordinary_strings(words: Sequence[str], numbers: Sequence[str] = ()) -> list[str]:
    """Names and paths of three words each, and numbers; the words come in an order that has nothing to do with the text's."""
    mixed = sorted(set(words), key=lambda w: (zlib.crc32(w.encode()), w))
    out = list(numbers)
    for i in range(0, len(mixed), 3):
        k, trio = i // 3, mixed[i : i + 3]
        if k % 4 == 3:
            trio = [trio[0].lower(), *[w.capitalize() for w in trio[1:]]]
        name = _JOINTS[k % len(_JOINTS)].join(trio)
        out.append(f"{name}{k % 100}" if k % 7 == 6 else name.upper() if k % 11 == 10 else name)
    return out


def decimals(key: object) -> str:
    """Twenty digits made from an id: long numbers are ordinary."""
    return f"{zlib.crc32(str(key).encode()):010d}{zlib.adler32(str(key).encode()):010d}"


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id``, ``base`` (pattern spans), ``runs`` (candidate spans) and their strings, for every document."""
    rows = docs.select("doc_id", text_or_empty(docs[text]).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in pieces(batches):
            spans, values, runs, strings = [], [], [], []
            for x in batch.column("__text"):
                t = x.as_py()
                base, found = base_spans(t)
                free = candidate_spans(t, base)
                spans.append([{"kind": k, "start": s, "end": e} for s, k, e in base])
                values.append(found)
                runs.append([{"kind": "random", "start": s, "end": e} for s, e in free])
                strings.append([t[s:e] for s, e in free])
            texts = pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(spans, span), pa.array(values, texts), pa.array(runs, span), pa.array(strings, texts)],
                names=["doc_id", "base", "values", "runs", "strings"],
            )

    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(
        run, f"doc_id {kind}, base array<{_SPAN}>, values array<string>, runs array<{_SPAN}>, strings array<string>"
    )


def train(scanned: DataFrame, docs: DataFrame, text: str = "text") -> np.ndarray:
    """Log-likelihood ratios of pairs of characters, random against ordinary, from the rows of ``scan`` and the texts."""

    def counted(total: np.ndarray, label: int) -> pa.RecordBatch:
        pair = np.flatnonzero(total)
        columns = [pa.array(np.full(len(pair), label, dtype=np.int32)), pa.array(pair.astype(np.int32)), pa.array(total[pair])]
        return pa.RecordBatch.from_arrays(columns, names=["label", "pair", "n"])

    def count_random(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_SIZE * _SIZE, dtype=np.int64)
        for batch in batches:
            made = [d for x in batch.column("doc_id") for d in digests(x.as_py())]
            total += pair_counts(made + batch.column("values").flatten().to_pylist()).ravel()
        yield counted(total, 1)

    def count_ordinary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_SIZE * _SIZE, dtype=np.int64)
        for batch in pieces(batches):
            words, numbers = set(), set()
            for x in batch.column("__text"):
                words.update(_word.findall(x.as_py()))
                numbers.update(_number.findall(x.as_py()))
            total += pair_counts(ordinary_strings(words, sorted(numbers))).ravel()
        yield counted(total, 0)

    kind = "label int, pair int, n bigint"
    random = scanned.select("doc_id", "values").mapInArrow(count_random, kind)
    ordinary = docs.select(text_or_empty(docs[text]).alias("__text")).mapInArrow(count_ordinary, kind)
    counts = random.unionByName(ordinary)
    table = np.zeros((2, _SIZE * _SIZE))
    keys = range(len(WORDS))
    table[0] += pair_counts(ordinary_strings(WORDS, [decimals(k) for k in keys])).ravel()
    table[1] += pair_counts([d for k in keys for d in digests(k)]).ravel()
    for r in counts.groupBy("label", "pair").agg(F.sum("n").alias("n")).collect():
        table[r["label"], r["pair"]] += r["n"]
    table = table.reshape(2, _SIZE, _SIZE)[:, :, 1:]
    single = table.sum(axis=1, keepdims=True) + 1
    single /= single.sum(axis=2, keepdims=True)
    chance = np.log((table + SMOOTHING * single) / (table.sum(axis=2, keepdims=True) + SMOOTHING))
    ratio = np.zeros((_SIZE, _SIZE))
    ratio[:, 1:] = chance[1] - chance[0]
    return ratio


def evidence(string: str, ratio: np.ndarray) -> float:
    codes = _CODE[np.frombuffer(("\n" + string).encode("utf-8"), dtype=np.uint8)]
    return float(ratio[codes[:-1], codes[1:]].sum())


def is_random(string: str, ratio: np.ndarray) -> bool:
    return len(set(string)) >= MIN_VARIETY and evidence(string, ratio) > EVIDENCE


def find(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id``, ``base`` and ``spans``: pattern spans, and these with the spans that the models add.

    Spans are (kind, start, end) in code points, end exclusive, by start and then by kind.  A null or empty text has
    none.  Rows that repeat an id stay repeated.
    """
    scanned = materialise(scan(docs, text), "secret-candidates")
    ratio = train(scanned, docs, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = []
            for base, runs, strings in zip(*[batch.column(c).to_pylist() for c in ("base", "runs", "strings")]):
                more = [r for r, s in zip(runs, strings) if is_random(s, ratio)]
                spans.append(sorted(base + more, key=lambda s: (s["start"], KINDS.index(s["kind"]))))
            base = batch.column("base")
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), base, pa.array(spans, base.type)], names=["doc_id", "base", "spans"]
            )

    kind = dict(scanned.dtypes)["doc_id"]
    columns = scanned.select("doc_id", "base", "runs", "strings")
    return columns.mapInArrow(run, f"doc_id {kind}, base array<{_SPAN}>, spans array<{_SPAN}>")


def redact(docs: DataFrame, text: str = "text", length: str = "n_chars") -> DataFrame:
    """The documents with every secret replaced by ``REDACTED``; overlapping spans become one.

    ``length``, if there is such a column, is set to the new length where a text changed.  Other columns and
    texts without secrets stay as they are.
    """
    ratio = train(materialise(scan(docs, text), "secret-candidates"), docs, text)

    def clean(t: str | None) -> str | None:
        if not t:
            return t
        base, _ = base_spans(t)
        spans = [(s, e) for s, _, e in base]
        spans += [(s, e) for s, e in candidate_spans(t, base) if is_random(t[s:e], ratio)]
        out, at = [], 0
        for s, e in sorted(spans):
            if s >= at:
                out += [t[at:s], REDACTED]
            at = max(at, e)
        return "".join(out) + t[at:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            old = batch.column(text).to_pylist()
            new = [clean(t) for t in old]
            at = batch.schema.get_field_index(text)
            batch = batch.set_column(at, batch.schema.field(at), pa.array(new, batch.column(text).type))
            at = batch.schema.get_field_index(length)
            if at >= 0:
                sizes = [n if a == b else len(b) for a, b, n in zip(old, new, batch.column(at).to_pylist())]
                batch = batch.set_column(at, batch.schema.field(at), pa.array(sizes, batch.column(at).type))
            yield batch

    return docs.mapInArrow(run, docs.schema)
