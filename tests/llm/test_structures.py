"""Packing, Merkle manifest and prefix trie against plain versions."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from candlewick.llm import merkle, packing, prefix_trie
from candlewick.llm.queries import QUERIES, vocabulary_path
from candlewick.sources.scratch import materialise


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- packing --------------------------------------------------------------------------


def places(rules):
    return [
        (first + k, offset + i * length, length)
        for length, _, bins, each, first, offset in rules.tolist()
        for k in range(bins)
        for i in range(each)
    ]


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 40), st.data())
def test_the_plan_is_best_fit_decreasing(capacity, data):
    items = data.draw(st.lists(st.integers(1, capacity), max_size=120))
    counts = {n: items.count(n) for n in set(items)}
    room = []
    for n in sorted(items, reverse=True):
        fits = [(r, i) for i, r in enumerate(room) if r >= n]
        if fits:
            room[min(fits)[1]] -= n
        else:
            room.append(capacity - n)
    bins = {}
    for b, offset, length in places(packing.plan(counts, capacity)):
        bins.setdefault(b, []).append((offset, length))
    assert sorted(n for v in bins.values() for _, n in v) == sorted(items)
    for v in bins.values():
        assert [o for o, _ in sorted(v)] == [0, *np.cumsum([n for _, n in sorted(v)])[:-1].tolist()]
    assert sorted(capacity - sum(n for _, n in v) for v in bins.values()) == sorted(room)


def test_the_number_of_rules_does_not_grow_with_the_documents():
    rng = random.Random(3)
    few = {n: rng.randint(1, 50) for n in range(1, 2049)}
    assert len(packing.plan({n: 1_000_003 * c for n, c in few.items()})) < 4 * 2048 * 64
    with pytest.raises(ValueError, match="no piece"):
        packing.plan({9: 1}, 8)


@pytest.mark.parametrize("capacity", [7, 2048])
def test_packed_sequences_hold_every_document(spark, odd, capacity):
    from tokenizers import Tokenizer

    path = vocabulary_path()
    own = Tokenizer.from_file(path)
    extra = spark.createDataFrame([(i, f"Some <|endoftext|> wörds{i % 9} it's\x1cok 1.5" * (i % 40)) for i in range(20, 400)], "doc_id bigint, text string")
    docs = odd.unionByName(extra, allowMissingColumns=True).repartition(5)
    written = materialise(packing.pieces(docs, path, capacity, keep=["doc_id", "text", "size"]), "pieces")
    placed = materialise(packing.place(written, capacity), "placed")
    assert {"size", "sequence_id", "offset"} <= set(placed.columns) and placed.count() == written.count()
    rows = placed.collect()
    packed = {r["sequence_id"]: (r["n_tokens"], bytes(r["tokens"])) for r in packing.sequences(placed).collect()}
    assert all(n <= capacity and len(t) == 4 * n for n, t in packed.values())
    texts, whole = {}, {}
    for r in rows:
        ids = np.frombuffer(r["tokens"], "<u4").tolist()
        assert packed[r["sequence_id"]][1][4 * r["offset"] : 4 * (r["offset"] + r["length"])] == bytes(r["tokens"])
        assert r["length"] == len(ids) and r["start"] == r["piece"] * capacity
        whole.setdefault((r["doc_id"], r["text"]), {}).setdefault(r["piece"], []).append(ids)
        texts[r["doc_id"], r["text"]] = r["text"]
    for key, parts in whole.items():
        got = [i for k in sorted(parts) for i in parts[k][0]]
        assert got == [*own.encode(texts[key] or "", add_special_tokens=False).ids, 0], key
        assert all(len(set(map(tuple, parts[k]))) == 1 for k in parts)
    # No plan needs fewer sequences than the tokens fill.
    assert len(packed) <= 1 + 1.1 * sum(n for n, _ in packed.values()) / capacity


def test_packing_an_empty_table(spark, odd):
    written = materialise(packing.pieces(odd.limit(0), vocabulary_path()), "pieces")
    assert packing.place(written).count() == 0


def test_packing_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = QUERIES["op11_packing"](spark, folder).toPandas()
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(vocabulary_path())
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for i, group in rows.sort_values("piece").groupby("doc_id"):
        ids = np.array([*own.encode(texts[i] or "", add_special_tokens=False).ids, 0], "<u4")
        assert group["length"].sum() == len(ids)
        for r in group.itertuples():
            assert zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32
    for _, group in rows.sort_values("offset").groupby("sequence_id"):
        assert group["offset"].tolist() == [0, *group["length"].cumsum()[:-1]] and group["length"].sum() <= 2048


# --- manifest -------------------------------------------------------------------------


def plain_tree(leaves):
    """The last node, and for each leaf its siblings level by level."""
    paths, level = [[] for _ in leaves], [([i], x) for i, x in enumerate(leaves)]
    while len(level) > 1:
        above = []
        for at in range(0, len(level), merkle.FANOUT):
            run = level[at : at + merkle.FANOUT]
            for k, (whose, _) in enumerate(run):
                for i in whose:
                    paths[i].append(("".join(x for _, x in run[:k]), "".join(x for _, x in run[k + 1 :])))
            above.append((sum((w for w, _ in run), []), sha("".join(x for _, x in run))))
        level = above
    return level[0][1], paths


def plain_leaf(values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def check_manifest(docs):
    rows = docs.select("doc_id", "source", "lang", "n_chars", "text").collect()
    groups = {}
    for r in rows:
        groups.setdefault(r["source"], []).append((r["doc_id"], plain_leaf(r)))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    tops, want = [], []
    for s in order:
        leaves = sorted(groups[s], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        top, paths = plain_tree([x for _, x in leaves])
        tops.append(top)
        want.append([(i, x, p) for (i, x), p in zip(leaves, paths)])
    root, above = plain_tree(tops)
    want = [(i, x, top, root, p + above[k]) for k, top in enumerate(tops) for i, x, p in want[k]]
    got = [
        (r["doc_id"], r["leaf"], r["subroot"], r["root"], [tuple(s) for s in r["path"]])
        for r in merkle.Manifest(docs, keep=["doc_id"]).proofs().collect()
    ]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_manifest_equals_a_plain_one(spark, odd):
    check_manifest(odd)
    rows = [(i, None if i % 11 == 0 else f"s{'é' * (i % 3)}{i % 2 if i % 5 else 0}", "en", i, f"Text {i}") for i in range(700)]
    check_manifest(spark.createDataFrame(rows + [(1000, "lone", None, None, None)], odd.select("doc_id", "source", "lang", "n_chars", "text").schema))
    # One source that needs three levels, with repeated rows.
    rows = [(i // 2, "a", "en", 1, "x") for i in range(600)]
    check_manifest(spark.createDataFrame(rows, odd.select("doc_id", "source", "lang", "n_chars", "text").schema))


def test_some_proofs_and_an_empty_table(spark, odd):
    rows = [(i, "ab"[i % 2], "en", 1, f"x{i}") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string")
    manifest = merkle.Manifest(docs, keep=["doc_id"])
    every = {r["leaf"]: r for r in manifest.proofs().collect()}
    some = manifest.proofs(manifest.leaves.filter("doc_id % 300 = 7")).collect()
    assert len(some) == 3 and all(r == every[r["leaf"]] for r in some)
    wrong = manifest.proofs().select(merkle.fold(F.lit("00"), F.col("path")).alias("r"), "root").filter("r = root")
    assert wrong.count() == 0
    assert merkle.Manifest(odd.limit(0), keep=["doc_id", "leaf"]).proofs().count() == 0


# --- trie -----------------------------------------------------------------------------


def plain_trie(rows):
    talks = {}
    for c, turn, role, text in rows:
        if c is not None:
            talks.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    talks = {c: [t[2:] for t in sorted(v)] for c, v in talks.items()}
    built = {}
    for c, turns in talks.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = tuple(talks.get(c - c % 100, [])[:h]) + tuple(turns[h:])
    members, ends = {}, {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
        ends.setdefault(turns, []).append(c)
    kids, leaves, saved = ({n: 0 for n in members} for _ in range(3))
    for node in members:
        if node:
            kids[node[:-1]] += 1
    for node, who in members.items():
        gain = (len(who) - 1) * len(node[-1][1]) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += gain
            leaves[node[:d]] += kids[node] == 0
    return sorted(
        (min(w), len(n), min(members[n[:-1]]) if n else None, len(w), kids[n], leaves[n], saved[n], sha(",".join(map(str, sorted(ends.get(n, []))))))
        for n, w in members.items()
    )


SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth string, key string"


def check_trie(spark, rows, height=None):
    talks = spark.createDataFrame([(*r, "taken", "taken") for r in rows], SCHEMA).repartition(3)
    turns = materialise(prefix_trie.ordered_turns(talks), "turns")
    got = prefix_trie.trie(*prefix_trie.rebuilt(turns), height).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )
    assert sorted(map(tuple, got.collect()), key=lambda r: (r[0], r[1])) == sorted(plain_trie(rows), key=lambda r: (r[0], r[1]))


@pytest.mark.parametrize("height", [1, 3, None])
def test_trie_equals_a_plain_one(spark, height, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 7)
    rng = random.Random(5)
    rows = [(c, t, "ua"[t % 2], rng.choice(["x", "é中", "long text"])) for c in [*range(0, 30), *range(95, 160), 305] for t in range(rng.randint(1, 9))]
    rows += [(500 + c, t, "u", "same") for c in range(40) for t in range(3)]
    rows += [(c, None, None, None) for c in (3, 7, 250)] + [(7, 2, "u", "tie"), (7, 2, "a", "tie"), (7, 2, "a", "tie"), (None, 1, "u", "x")]
    rows += [(601, t, "u", f"deep {t}") for t in range(60)] + [(602, t, "u", f"deep {t}") for t in range(50)]
    check_trie(spark, rows, height)


def test_trie_of_one_row_and_of_none(spark):
    for rows in ([(4, 1, "u", "x" * 100_000)], []):
        check_trie(spark, rows)
