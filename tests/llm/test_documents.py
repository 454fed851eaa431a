"""Operators on documents, against plain versions and on odd rows."""

import math
import random
import re
import struct

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from candlewick.llm import bpe, license_scan, mixing, passage_dedup, quality, secret_scan, sharding, simhash
from candlewick.llm.queries import vocabulary_path

from .conftest import ODD, PROSE

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def documents(spark, texts, start=0):
    rows = [(i + start, t, "en", f"s{i % 4}", len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")


# --- quality ------------------------------------------------------------------------


def plain_measures(text):
    text = text or ""
    words = WORDS.findall(text)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)), len(covered), len(lines), len(re.findall("[A-Z]", text)),
    )


def test_measures(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab A#|\n\t é") for _ in range(rng.randint(0, 120))) for _ in range(150)]
    got = quality.measure(documents(spark, texts), keep=["doc_id"]).collect()
    assert {r["doc_id"]: tuple(r[m] for m in quality.MEASURES) for r in got} == {
        i: plain_measures(t) for i, t in enumerate(texts)
    }


def test_binomial_tail(spark):
    cases = [(20, 0), (100, 0), (100, 2), (5000, 20), (5000, 40), (5000, 49), (5000, 60), (0, 0), (200_000, 1900)]
    df = spark.createDataFrame(cases, "n bigint, k bigint")
    for r in df.select("n", "k", quality.binomial_tail(F.col("n"), F.col("k"), 0.01).alias("t")).collect():
        n, k = r["n"], r["k"]
        logs = [math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1) + j * math.log(0.01) + (n - j) * math.log(0.99) for j in range(k + 1)]
        want = 1.0 if k >= n * 0.01 else sum(map(math.exp, logs))
        assert r["t"] == pytest.approx(want, rel=1e-6), (n, k)


def test_cutoffs_are_certified_and_reject_the_bad(spark):
    good = [" ".join(f"w{i}x{j}" for j in range(60)) for i in range(3000)]
    bad = [t.replace(" ", " ### ") for t in good[:400]]
    docs = documents(spark, good + bad)
    labels = docs.select("doc_id", (F.col("doc_id") < 3000).cast("int").alias("quality"))
    measured = quality.measure(docs, keep=["doc_id", "lang"]).cache()
    cuts = quality.cutoffs(measured, labels).first()
    assert cuts["__cut_symbols"] > 0 and cuts["__cut_capitals"] is None
    kept = {r["doc_id"] for r in quality.judge(measured, labels).filter("kept").collect()}
    assert kept == set(range(3000))
    # With few labels nothing can be certified, so only the base rules reject.
    few = labels.filter("doc_id % 100 = 0")
    assert quality.judge(measured, few).filter("kept").count() == 3400


def test_quality_on_odd_rows(spark, odd, labels):
    out = quality.reject_low_quality(odd, labels)
    assert out.columns == odd.columns and sorted(r["doc_id"] for r in out.collect()) == [4, 4, 5]
    assert quality.reject_low_quality(odd.limit(0), labels.limit(0)).count() == 0


# --- simhash ------------------------------------------------------------------------


def test_fingerprints(spark, odd):
    def plain(text):
        words = (text or "").encode().lower().split()
        grams = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
        hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    got = simhash.fingerprints(odd, keep=["text"]).collect()
    assert all(r["fingerprint"] % 2**64 == plain(r["text"]) for r in got) and len(got) == len(ODD)


def plain_components(values):
    parent = list(range(len(values)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= 3:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return [root(i) for i in range(len(values))]


@pytest.mark.parametrize("crowd", [4096, 20])
def test_links_reach_every_close_pair(spark, monkeypatch, crowd):
    monkeypatch.setattr(simhash, "MAX_BUCKET", crowd)
    rng = random.Random(2)
    values = {0}
    for _ in range(60):
        at = rng.getrandbits(64)
        for _ in range(12):
            values.add(at)
            for _ in range(rng.randint(1, 4)):
                at ^= 1 << rng.randrange(64)
    values = sorted(values)
    signed = [(v - 2**64 if v >= 2**63 else v,) for v in values]
    edges = simhash.links(spark.createDataFrame(signed, "fp bigint")).collect()
    parent = {v: v for v in values}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in edges:
        assert ((a ^ b) % 2**64).bit_count() <= 3
        parent[root(b % 2**64)] = root(a % 2**64)
    want = plain_components(values)
    groups = {}
    for v, w in zip(values, want):
        groups.setdefault(w, set()).add(root(v))
    assert all(len(g) == 1 for g in groups.values()) and len({root(v) for v in values}) == len(groups)


def test_one_document_of_a_group_stays(spark, odd):
    out = simhash.drop_near_duplicates(odd)
    assert out.columns == odd.columns
    # Fingerprint 0 is shared by the texts without words; PROSE and its extension may be near.
    ids = [r["doc_id"] for r in out.collect()]
    assert ids.count(4) == 1 and 1 in ids and 2 not in ids and 6 not in ids and ids.count(None) == 1
    assert simhash.drop_near_duplicates(odd.limit(0)).count() == 0


# --- secrets ------------------------------------------------------------------------


def plain_base(text):
    text, out = text or "", []
    for m in re.finditer(secret_scan.ASSIGN, text, re.I | re.A):
        if len(m[2]) >= 6:
            out.append(("assign", m.start(), m.end()))
    out += [("access", m.start(), m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [("hex", m.start(), m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out, key=lambda s: (s[1], secret_scan.KINDS.index(s[0])))


def test_base_spans():
    rng = random.Random(3)
    parts = ["token", "Secret", "api_key", "apikey", "=", ":", " ", '"', "'", "abc", "AKIA", "ABCDEFGH12345678", "0123456789ab", "é", "\n", "PASSWORD"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))
        assert [(k, s, e) for s, k, e in secret_scan.base_spans(text)[0]] == plain_base(text), text


def test_models_tell_random_from_ordinary(spark):
    rng = random.Random(4)
    syllables = ["an", "ter", "on", "ing", "the", "re", "al", "con", "pro", "ment", "is", "ed"]
    names = ["_".join("".join(rng.choice(syllables) for _ in range(rng.randint(2, 4))) for _ in range(3)) for _ in range(900)]
    docs = documents(spark, [f"here is {n} and {m}" for n, m in zip(names, names[1:])])
    ratio = secret_scan.train(secret_scan.scan(docs), docs)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    held_random = ["".join(rng.choice(alphabet) for _ in range(24)) for _ in range(300)]
    held_names = ["_".join("".join(rng.choice(syllables) for _ in range(3)) for _ in range(3)) for _ in range(300)]
    assert np.mean([secret_scan.is_random(s, ratio) for s in held_random]) > 0.9
    assert not any(secret_scan.is_random(s, ratio) for s in [*held_names, "-" * 40, "a" * 30])
    secret = held_random[0]
    found = secret_scan.find(docs.unionByName(documents(spark, [f"x {secret} y"], 10_000))).filter("doc_id = 10000").first()
    assert [(s["kind"], s["start"], s["end"]) for s in found["spans"]] == [("random", 2, 26)]


@pytest.mark.parametrize(("secrets", "copies", "base64_rows"), [(1, 1, 0), (30, 1, 0), (300, 1, 0), (30, 9, 0), (30, 1, 400)])
def test_secrets_in_the_corpus_do_not_hide_themselves(spark, secrets, copies, base64_rows):
    rng = random.Random(secrets + copies + base64_rows)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    words = ["".join(rng.choice(["ka", "ter", "on", "lis", "mu", "re", "al", "vor"]) for _ in range(rng.randint(2, 4))) for _ in range(400)]
    prose = lambda: " ".join(rng.choice(words) for _ in range(60))
    hidden = ["".join(rng.choice(alphabet) for _ in range(24)) for _ in range(secrets)]
    names = ["_".join(rng.choice(words) for _ in range(4)) for _ in range(200)] + ["/".join(rng.choice(words) for _ in range(5)) for _ in range(50)]
    texts = [f"{prose()} {s} {prose()}" for s in hidden for _ in range(copies)]
    clean = [f"{prose()} {n} {prose()} 1202-3344-5566-7788-99 {rng.randrange(10**19, 10**20)}" for n in names]
    blobs = ["".join(rng.choice(alphabet + "+/") for _ in range(4000)) for _ in range(base64_rows)]
    docs = documents(spark, [*texts, *clean, *blobs])
    got = {r["doc_id"]: r["spans"] for r in secret_scan.find(docs).collect()}
    found = sum(any(texts[i][s["start"] : s["end"]] == hidden[i // copies] for s in got[i]) for i in range(len(texts)))
    assert found >= 0.9 * len(texts)
    assert not any(got[i] for i in range(len(texts), len(texts) + len(clean)))


def test_secrets_on_odd_rows(spark, odd):
    got = secret_scan.find(odd).collect()
    assert len(got) == len(ODD)
    for r in got:
        if r["doc_id"] == 8:
            assert [(s["kind"], s["start"], s["end"]) for s in r["base"]] == plain_base(ODD[-1][1]) and len(r["base"]) == 3
        elif r["doc_id"] is not None:
            assert not r["spans"]
    out = secret_scan.redact(odd)
    assert out.columns == odd.columns and out.dtypes == odd.dtypes
    row = out.filter("doc_id = 8").first()
    assert row["text"] == "[secret]" + '" ' + "[secret] [secret]" and row["n_chars"] == len(row["text"])
    assert out.filter("doc_id = 4").first()["text"] == PROSE
    assert secret_scan.find(odd.limit(0)).count() == secret_scan.redact(odd.limit(0)).count() == 0


# --- mixing -------------------------------------------------------------------------


def plain_targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    target, capped = {}, set()
    while True:
        open_w = sum(w[s] for s in names if s not in capped)
        left = sum(sizes.values()) - sum(most * sizes[s] for s in capped)
        target = {s: most * sizes[s] if s in capped else left * w[s] / open_w for s in names}
        more = {s for s in names if target[s] > most * sizes[s]} - capped
        if not more:
            return target
        capped |= more


@pytest.mark.parametrize("sizes", [{"a": 5, "b": 900, "c": 40, None: 55, "d": 1}, {"x": 10}, {"a": 0, "b": 8}, {"a": 1, "b": 1, "c": 98}])
def test_targets(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    got = {r["source"]: r["target"] for r in mixing.targets(rows).collect()}
    assert got == pytest.approx(plain_targets(sizes))


def test_mix_comes_near_its_targets(spark):
    docs = documents(spark, ["one two three four"] * 4000)
    planned = mixing.plan(docs)
    by = planned.groupBy("source").agg(F.max("target").alias("t"), F.sum(F.col("size") * F.col("copies")).alias("n")).collect()
    # Four deviations of a thousand draws at the least rate.
    assert all(abs(r["n"] - r["t"]) < 0.2 * r["t"] for r in by)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and mixed.count() * 4 == sum(r["n"] for r in by)
    assert mixed.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 3
    again = {tuple(r) for r in mixing.plan(docs).select("doc_id", "copies").collect()}
    assert again == {tuple(r) for r in planned.select("doc_id", "copies").collect()}


def test_rows_that_repeat_an_id_are_drawn_each_for_itself(spark):
    docs = documents(spark, ["one two three four"] * 6000).select("doc_id", "text", F.when(F.col("doc_id") < 2000, "a").otherwise("b").alias("source"))
    same = F.when(F.col("doc_id") < 2000, F.lit(7)).otherwise(F.col("doc_id")).cast("bigint")
    docs = docs.withColumn("doc_id", same)
    for rows in (docs, docs.withColumn("doc_id", F.nullif("doc_id", F.lit(7))), docs.repartition(3)):
        by = mixing.plan(rows).groupBy("source").agg(F.max("target").alias("t"), F.sum(F.col("size") * F.col("copies")).alias("n"))
        assert all(abs(r["n"] - r["t"]) < 0.05 * r["t"] for r in by.collect())
        assert mixing.mix(rows).columns == rows.columns

    def taken(rows):
        return sorted((str(r["doc_id"]), r["copies"]) for r in mixing.plan(rows).select("doc_id", "copies").collect())

    assert taken(docs) == taken(docs.repartition(3))


def test_mixing_on_odd_rows(spark, odd):
    out = mixing.mix(odd)
    assert out.columns == odd.columns
    planned = mixing.plan(odd.drop("size"))
    assert planned.count() == len(ODD) and planned.filter("copies > 3 OR copies < 0").count() == 0
    assert mixing.mix(odd.limit(0)).count() == 0


# --- tokens -------------------------------------------------------------------------


def test_encoding_equals_the_library(spark, odd):
    tokenizers = pytest.importorskip("tokenizers")
    path = vocabulary_path()
    library = tokenizers.Tokenizer.from_file(path)
    encoder = bpe.Encoder(bpe.compile_automaton(path))
    rng = random.Random(5)
    alphabet = "aaabbtheinr'sSTdmlve 0123\n\t\x1c\x85　éÉß́ΑΣσςİıKſ中日\U0001f600ก-_=+!?<|>\x00ﬁǅ½²"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(4000)]
    texts += [t[:5] + "<|endoftext|>" + t[5:] + "<|STARTOFTEXT|>" for t in texts[:200]]
    texts += [rng.choice(["a", "ab", "the", "ha"]) * rng.randint(1, 60) for _ in range(200)] + ["a" * 30000]
    for t in texts:
        raw = encoder.text(t)
        assert list(struct.unpack(f"<{len(raw) // 4}I", raw)) == library.encode(t, add_special_tokens=False).ids, t
    out = bpe.decode(bpe.encode(odd, path), path)
    assert "tokens" in out.columns and out.columns.count("decoded") == 1
    for r in out.select("text", "n_tokens", "tokens", "decoded").collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids) and bytes(r["tokens"]) == struct.pack(f"<{len(ids)}I", *ids)
        assert r["decoded"] == library.decode(ids, skip_special_tokens=False)
    assert bpe.encode(odd.limit(0), path, decoded=True).count() == 0


def test_repeated_pairs_merge_from_the_left():
    tables = {"born": [-1, 0], "left": [0, 0], "right": [0, 0], "removed": {0: 0}}
    arcs = {(s, t): bpe.arc_exists(tables, s, t, 9) for s in (0, 1) for t in (0, 1)}
    # 0 is a, 1 is aa: only aa may stand before a or another aa.
    assert arcs == {(0, 0): False, (0, 1): False, (1, 0): True, (1, 1): True}


# --- shards -------------------------------------------------------------------------


@pytest.mark.parametrize("limit", [500, 20_000, 10**9])
def test_shards_fit(spark, odd, limit):
    docs = documents(spark, [f"{i} " * (i % 50) for i in range(600)], 100).select("doc_id", "text")
    docs = docs.unionByName(odd.select("doc_id", "text")).unionByName(docs.filter("doc_id < 160").withColumn("doc_id", F.lit(100).cast("bigint")))
    got = sharding.assign(docs, limit).collect()
    assert len(got) == docs.count()
    sums = {}
    for r in got:
        sums.setdefault(r["shard"], []).append(r["n_bytes"])
    for shard, sizes in sums.items():
        assert sum(sizes) <= limit or len(sizes) == 1
        assert not any(other != shard and other.startswith(shard) for other in sums)
        # The parent had to split.
        if shard:
            assert sum(sum(v) for k, v in sums.items() if k.startswith(shard[:-1])) > limit
    assert all((r["shard_bytes"], r["shard_rows"]) == (sum(sums[r["shard"]]), len(sums[r["shard"]])) for r in got)


def test_shards_keep_clashing_columns(spark):
    clashing = ["d", "cell", "bytes", "n", "s", "depth", "Shard", "n_bytes"]
    docs = documents(spark, [f"{i} " * 40 for i in range(60)]).select("doc_id", "text", *[F.lit("taken").alias(c) for c in clashing])
    got = sharding.assign(docs, 2000)
    assert [c for c in got.columns if c in clashing[:5]] == clashing[:5]
    assert got.filter("d = 'taken' AND cell = 'taken' AND bytes = 'taken' AND n = 'taken' AND s = 'taken'").count() == 60
    assert sharding.assign(docs, 10**9).count() == 60


def test_equal_rows_split_too(spark):
    docs = spark.range(300).select(F.lit(None).cast("bigint").alias("doc_id"), F.lit("x" * 100).alias("text"))
    got = sharding.assign(docs, 3000).select("shard", "shard_bytes").distinct().collect()
    assert len(got) >= 10 and all(r["shard_bytes"] <= 3000 for r in got)
    assert sharding.assign(docs.limit(0)).count() == 0


# --- licences -----------------------------------------------------------------------


def test_licences(spark, odd):
    mit = license_scan.MIT_GRANT
    texts = [
        "intro\nReleased under the  MIT License!\nmore text here",
        "a b c\n\n" + mit[:120] + "\n" + mit[120:].replace("merge", "join") + "\n\nend",
        "the license of the software is free and so on",
        mit.upper(),
    ]
    got = {(r["doc_id"], r["unit"], r["unit_no"]): (r["license"], r["dice"]) for r in license_scan.find(documents(spark, texts)).collect()}
    assert got[0, "line", 1] == ("MIT", 1.0) and got[3, "line", 0] == ("MIT", 1.0)
    assert got[1, "paragraph", 1][0] == "MIT" and 0.8 <= got[1, "paragraph", 1][1] < 1
    assert not any(k[0] == 2 for k in got)
    assert license_scan.find(odd).count() == license_scan.find(odd.limit(0)).count() == 0


def test_licence_wordings(spark):
    full = f"{license_scan.MIT_GRANT} {license_scan.MIT_REST}"
    bsd = license_scan.TEMPLATES["BSD-3-Clause"][-1]
    filler = "ner wand os tilly " * 300
    cases = [
        ("Released under the MIT License.", {"MIT"}),
        ("MIT License Copyright 2020 X " + full, {"MIT"}),
        ("Licensed under the MIT License.", {"MIT"}),
        ("This project is licensed under the MIT License.", {"MIT"}),
        ("Copyright 2020 X. Released under the MIT License. All rights reserved.", {"MIT"}),
        ("// SPDX-License-Identifier: Apache-2.0", {"Apache-2.0"}),
        (filler + full + " " + filler, {"MIT"}),
        (filler + bsd.replace("copyright holder", "regents"), {"BSD-3-Clause"}),
        (f"{full} {bsd}", {"MIT", "BSD-3-Clause"}),
        ("you see it is distributed under the GNU General Public License v2.0 or so they say", {"GPL-2.0"}),
        ("Licensed under CC BY-NC-SA 4.0", {"CC-BY-NC-SA-4.0"}),
        ("the general public of the license office likes the software", set()),
        ("Released under the Foo License.", set()),
    ]
    got = {i: set() for i in range(len(cases))}
    for r in license_scan.find(documents(spark, [t for t, _ in cases])).collect():
        got[r["doc_id"]].add(r["license"])
    assert [got[i] for i in range(len(cases))] == [want for _, want in cases]


def test_anchors_are_in_every_match():
    """Whatever third of a template's bigrams is missing, an anchor is left."""
    known = license_scan.compiled(license_scan.TEMPLATES)
    places = license_scan.anchors(known)
    for number, t in enumerate(known):
        mine = {g for g in t.bigrams if any(n == number for n, _ in places.get(g, []))}
        needed = license_scan.THRESHOLD / (2 - license_scan.THRESHOLD) * len(t.bigrams)
        assert len(t.bigrams) - len(mine) < needed
        assert all(t.words[at : at + 2] == g.split() for g in mine for n, at in places[g] if n == number)


def test_licence_texts_of_a_folder(spark, tmp_path):
    words = [f"w{i}" for i in range(900)]
    (tmp_path / "House-1.0.txt").write_text(" ".join(words))
    own = license_scan.read_templates(spark, str(tmp_path))
    assert set(own) == {"House-1.0"}
    changed = " ".join(w if i % 20 else "other" for i, w in enumerate(words))
    [hit] = license_scan.find(documents(spark, ["a b c " + changed + " d e", "w1 w2 w3"]), own).filter("unit = 'window'").collect()
    assert hit["license"] == "House-1.0" and hit["doc_id"] == 0 and hit["unit_no"] == 3 and hit["dice"] > 0.89


# --- passages -----------------------------------------------------------------------


def test_passages(spark, odd):
    rng = random.Random(6)

    def prose(n):
        return [f"{rng.choice('bcdfgh')}{rng.randrange(5000)}" for _ in range(n)]

    shared, edited = prose(70), prose(90)
    changed = [w if i % 15 else "zz" for i, w in enumerate(edited)]
    texts = [
        prose(100) + shared + prose(50), prose(30) + shared, shared + prose(10), prose(200) + edited, changed + prose(120),
        prose(300), prose(20) + prose(40), ["of"] * 80, prose(9) + ["of"] * 60,
    ]
    got = passage_dedup.find(documents(spark, [" ".join(t) for t in texts])).collect()
    pairs = {(r["doc_id"], r["other_doc_id"]): r for r in got}
    assert {frozenset(p) for p in pairs} == {frozenset(p) for p in [(0, 1), (0, 2), (1, 2), (3, 4), (7, 8)]}
    r = pairs.get((1, 0)) or pairs[0, 1]
    spans = {r["doc_id"]: (r["start"], r["end"]), r["other_doc_id"]: (r["other_start"], r["other_end"])}
    assert spans == {0: (100, 170), 1: (30, 100)} and r["identity"] == 1
    r = pairs.get((4, 3)) or pairs[3, 4]
    assert 0.9 < r["identity"] < 1 and r["end"] - r["start"] >= 85
    same = passage_dedup.find(odd).collect()
    # Row 3 says one sentence over and over.
    assert {(r["doc_id"], r["other_doc_id"]) for r in same} - {(3, 3)} <= {(4, 4), (5, 4), (4, 5)} and len(same) > 1
    assert (3, 3) in {(r["doc_id"], r["other_doc_id"]) for r in same}
    assert passage_dedup.find(odd.limit(0)).count() == 0


def shared_runs(texts, least=passage_dedup.MIN_WORDS):
    """Documents that have a run of ``least`` words at two places or with another document, by every run of every text."""
    homes = {}
    for i, words in enumerate(texts):
        for at in range(len(words) - least + 1):
            homes.setdefault(tuple(words[at : at + least]), []).append((i, at))
    return {i for found in homes.values() if len(found) > 1 for i, _ in found}


@pytest.mark.parametrize("block", [20, 25, 35, 45])
def test_passages_of_frequent_blocks_are_found(spark, block):
    rng = random.Random(block)

    def prose(n):
        return [f"{rng.choice('klmnp')}{rng.randrange(20_000)}" for _ in range(n)]

    blocks = [prose(block) for _ in range(40)]
    texts = [prose(30) + rng.choice(blocks) + prose(20) + rng.choice(blocks) + prose(10) for _ in range(300)]
    for _ in range(40):
        passage = sum(rng.sample(blocks, 3), [])
        texts += [prose(40) + passage + prose(25), prose(15) + passage]
    rng.shuffle(texts)
    got = passage_dedup.find(documents(spark, [" ".join(t) for t in texts])).collect()
    wanted = shared_runs(texts)
    assert len(wanted) >= 80
    assert wanted <= {i for r in got for i in (r["doc_id"], r["other_doc_id"])}
    for r in got:
        assert min(r["end"] - r["start"], r["other_end"] - r["other_start"]) >= 50 and r["identity"] >= 0.8


def test_exact_passages_are_found_where_nearly_all_of_them_is_frequent(spark):
    rng = random.Random(21)

    def prose(n):
        return [f"{rng.choice('klmnp')}{rng.randrange(20_000)}" for _ in range(n)]

    heads, tails = [prose(45) for _ in range(12)], [prose(7) for _ in range(12)]
    texts = [prose(12) + rng.choice(heads) + prose(20) + rng.choice(tails) + prose(10) for _ in range(200)]
    for h, t in rng.sample([(h, t) for h in heads for t in tails], 100):
        texts += [prose(40) + h + t + prose(25), prose(15) + h + t]
    rng.shuffle(texts)
    rows = passage_dedup.find(documents(spark, [" ".join(t) for t in texts])).collect()
    assert len(shared_runs(texts)) == 200
    spans = {}
    for r in rows:
        spans.setdefault(r["doc_id"], []).append((r["start"], r["end"]))
    first = {}
    for i, words in enumerate(texts):
        for at in range(len(words) - 51):
            run = tuple(words[at : at + 52])
            assert run not in first or any(s <= at and at + 52 <= e for s, e in spans.get(i, [])), (i, first[run])
            first.setdefault(run, i)


def test_a_passage_is_not_lost_in_a_chain_that_goes_on_too_far(spark):
    rng = random.Random(22)

    def prose(n):
        return [f"{rng.choice('klmnp')}{rng.randrange(20_000)}" for _ in range(n)]

    passage, other = prose(55), prose(24)
    texts = [prose(30) + passage + prose(37) + other + prose(30) for _ in range(2)]
    texts += [prose(20) + other + prose(37) + passage + prose(20) for _ in range(2)]
    rows = passage_dedup.find(documents(spark, [" ".join(t) for t in texts])).collect()
    at = [30, 30, 81, 81]
    assert {r["doc_id"] for r in rows} == {1, 2, 3}
    assert all((r["start"], r["end"], r["identity"]) == (at[r["doc_id"]], at[r["doc_id"]] + 55, 1) for r in rows)


def test_steps_of_the_passages_leave_no_shuffle_and_no_sketch(spark):
    rng = random.Random(23)

    def files():
        found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {name for i in range(found.size()) if (name := found.apply(i).getName()).startswith("shuffle_")}

    texts = [" ".join(f"w{rng.randrange(60_000)}" for _ in range(400)) for _ in range(20)]
    docs = documents(spark, [*texts, *texts])
    sketches = passage_dedup.sketch(docs)
    assert sketches.columns == ["node", "key", "letters", "short", "long"]
    before = files()
    found = passage_dedup.find(docs)
    assert not files() - before
    assert found.count() == 20
    assert not [f for f in found.inputFiles() if "sketches" in f]


def test_passages_that_a_document_repeats(spark):
    rng = random.Random(11)

    def prose(n):
        return [f"{rng.choice('rstvw')}{rng.randrange(20_000)}" for _ in range(n)]

    own, both = prose(80), prose(60)
    texts = [
        prose(20) + own + prose(30) + own + prose(5),
        prose(60) + both + prose(80) + both + prose(40),
        prose(10) + both + prose(10),
        "lorem ipsum dolor sit".split() * 3000,
        prose(200),
    ]
    rows = passage_dedup.find(documents(spark, [" ".join(t) for t in texts])).collect()
    spans = {}
    for r in rows:
        spans.setdefault((r["doc_id"], r["other_doc_id"]), set()).add((r["start"], r["end"]))
        if r["doc_id"] == r["other_doc_id"]:
            assert r["other_end"] <= r["start"]
    assert spans[0, 0] == {(130, 210)}
    places = spans.get((1, 1), set()) | {(r["other_start"], r["other_end"]) for r in rows if r["other_doc_id"] == 1} | spans.get((1, 2), set())
    assert {(60, 120), (200, 260)} <= places
    assert (3, 3) in spans and not any(4 in k for k in spans)
    assert {i for k in spans for i in k} == shared_runs(texts)


def test_chains_are_collinear():
    rng = random.Random(7)
    for _ in range(50):
        f = np.array([(rng.randrange(200), rng.randrange(200), rng.randint(5, 20)) for _ in range(25)])
        found = passage_dedup.chains(f)
        assert sorted(i for c in found for i in c) == list(range(25))
        for c in found:
            for i, j in zip(c, c[1:]):
                assert f[i][0] + f[i][2] - 4 <= f[j][0] and f[i][1] + f[i][2] - 4 <= f[j][1]


def test_best_chain_equals_a_quadratic_search():
    rng = random.Random(8)
    for _ in range(30):
        f = np.array([(rng.randrange(120), rng.randrange(120), rng.randint(5, 15)) for _ in range(18)])
        order = sorted(range(18), key=lambda i: f[i][1])
        best = {}
        for i in order:
            ends = [best[j] - 0.25 * (f[i][0] - f[j][0] - f[j][2] + 4 + f[i][1] - f[j][1] - f[j][2] + 4) for j in best if f[j][0] + f[j][2] - 4 <= f[i][0] and f[j][1] + f[j][2] - 4 <= f[i][1]]
            best[i] = f[i][2] + max([0.0, *ends])
        chain = passage_dedup.chains(f)[0]
        value = float(f[chain[0]][2])
        for i, j in zip(chain, chain[1:]):
            value += f[j][2] - 0.25 * (f[j][0] - f[i][0] - f[i][2] + 4 + f[j][1] - f[i][1] - f[i][2] + 4)
        assert value == pytest.approx(max(best.values()))



# --- texts that are alike -------------------------------------------------------------


def test_alike_pairs_are_joined_as_a_forest():
    rng = np.random.default_rng(9)
    rows = []
    for group, size in enumerate((400, 60, 1, 2)):
        centre = rng.integers(0, 2**63, simhash.WORDS, dtype=np.uint64)
        for _ in range(size):
            words = centre.copy()
            for bit in rng.integers(0, 256, rng.integers(0, 30)):
                words[bit // 64] ^= np.uint64(1) << np.uint64(bit % 64)
            rows.append((group, words))
    words = np.array([w for _, w in rows])
    table = pa.table(
        {"key": pa.array([g for g, _ in rows], pa.int64()), "node": pa.array(np.arange(len(rows)))}
        | {c: pa.array(words[:, i].view(np.int64)) for i, c in enumerate(simhash.WIDE)}
    )
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in zip(*simhash._alike(table, 44)):
        assert np.bitwise_count(words[a] ^ words[b]).sum() <= 44 and root(a) != root(b)
        parent[root(a)] = root(b)
    for i in range(len(rows)):
        near = [j for j in range(i) if rows[i][0] == rows[j][0] and np.bitwise_count(words[i] ^ words[j]).sum() <= 44]
        assert all(root(i) == root(j) for j in near)


def test_pivots_bound_the_distance_and_refuse_most_pairs():
    rng = np.random.default_rng(15)
    words = rng.integers(0, 2**64, (3000, simhash.WORDS), dtype=np.uint64)
    near = words.copy()
    for row in near:
        for bit in rng.choice(256, 50, replace=False):
            row[bit // 64] ^= np.uint64(1) << np.uint64(bit % 64)
    pivots, close, allowed = *(simhash.wide_distances(w, simhash.wide_blocks()) for w in (words, near)), simhash.differing_bits(0.8)
    assert pivots.shape == (3000, simhash.WORDS * simhash.WIDE_CUTS, simhash.REFERENCES)
    assert (simhash.least_distance(pivots, close) <= 50).all()
    others = simhash.least_distance(pivots[1:], pivots[:-1])
    assert (others <= np.bitwise_count(words[1:] ^ words[:-1]).sum(axis=1)).all()
    assert (others <= allowed).mean() < 0.1


def test_sampled_keys_are_distances_to_the_references(spark):
    rng = np.random.default_rng(16)
    words = rng.integers(0, 2**63, (50, simhash.WORDS), dtype=np.uint64)
    rows = [(0, i, *map(int, w)) for i, w in enumerate(words.view(np.int64))]
    nodes = spark.createDataFrame(rows, f"key bigint, node bigint, {', '.join(f'{c} bigint' for c in simhash.WIDE)}")
    got = {}
    for r in simhash._sampled(nodes, 9, 3).collect():
        got.setdefault(r["node"], []).append(r["key"])
    picks, draw = [], np.random.default_rng((simhash.REFERENCE_SEED, 0))
    for _ in range(3):
        picks.append(draw.choice(256, size=9, replace=False))
    bits = np.unpackbits(words.view(np.uint8).reshape(50, -1), axis=1, bitorder="little")
    refs = np.stack([np.roll(simhash.references(), w) for w in range(simhash.WORDS)], axis=1)
    marks = np.unpackbits(np.ascontiguousarray(refs).view(np.uint8).reshape(simhash.REFERENCES, -1), axis=1, bitorder="little")
    for i, pick in enumerate(picks):
        apart = (bits[:, None, pick] != marks[None, :, pick]).sum(axis=2)
        keys = simhash._fold(apart, np.full(50, i + 1, dtype=np.uint64))
        assert {n: k[i] for n, k in got.items()} == dict(enumerate(keys.tolist()))


def test_similar_texts_and_clean_ones(spark, odd):
    rng = random.Random(10)
    base = [[f"w{rng.randrange(4000)}" for _ in range(250)] for _ in range(60)]
    near = [[w if k % 60 != i % 60 else "new" for k, w in enumerate(t)] for i, t in enumerate(base[:40])]
    texts = [" ".join(t) for t in [*base, *near, base[3]]]
    out = simhash.drop_near_duplicates(documents(spark, texts), similarity=0.8)
    kept = {r["doc_id"] for r in out.collect()}
    # A near copy keeps about 0.85 of its shingles.
    assert set(range(60)) <= kept and 100 not in kept and len(kept) <= 62
    out = simhash.drop_near_duplicates(odd, similarity=0.8)
    ids = [r["doc_id"] for r in out.collect()]
    assert out.columns == odd.columns and ids.count(4) == 1 and 1 in ids and 2 not in ids and ids.count(None) == 1
    assert simhash.drop_near_duplicates(odd.limit(0), similarity=0.8).count() == 0


def test_no_pair_of_a_crowded_bucket_is_lost(spark, monkeypatch):
    # Every key is crowded, and each fingerprint has one partner only.
    monkeypatch.setattr(simhash, "MAX_BUCKET", 100)
    monkeypatch.setattr(simhash, "sampled_bits", lambda n, similarity: (1, 1))
    rng = np.random.default_rng(12)
    words = rng.integers(0, 2**63, (300, simhash.WORDS), dtype=np.uint64)
    partner = words.copy()
    bit = np.random.default_rng((simhash.REFERENCE_SEED, 0)).choice(256, size=1, replace=False)[0]
    # Partners share the one sampled bit and differ in 42 others.
    partner[:, [w for w in range(simhash.WORDS) if w != bit // 64]] ^= np.uint64(0b101010101010101010101010101)
    rows = [(i, *map(int, w)) for i, w in enumerate(np.concatenate([words, partner]).view(np.int64))]
    nodes = spark.createDataFrame(rows, f"node bigint, {', '.join(f'{c} bigint' for c in simhash.WIDE)}")
    got = {tuple(sorted((r["a"], r["b"]))) for r in simhash.alike_links(nodes).collect()}
    lost = {(i, i + 300) for i in range(300)} - got
    assert not lost, len(lost)


def test_similar_texts_are_verified_by_their_shingles(spark):
    rng = random.Random(13)
    base = [[f"v{rng.randrange(4000)}" for _ in range(250)] for _ in range(80)]

    def edited(t, changes):
        at = {(k + 1) * len(t) // (changes + 1) for k in range(changes)}
        return [w if k not in at else "new" for k, w in enumerate(t)]

    # Five changed words leave 221 of 271 shingles (0.815), seven leave 211 of 281 (0.75).
    texts = [" ".join(t) for t in [*base, *(edited(t, 5) for t in base[:40]), *(edited(t, 7) for t in base[40:])]]
    kept = {r["doc_id"] for r in simhash.drop_near_duplicates(documents(spark, texts), similarity=0.8).collect()}
    assert set(range(80)) <= kept and set(range(120, 160)) <= kept, len(kept & set(range(120, 160)))
    assert len(kept & set(range(80, 120))) <= 2


def test_groups_are_settled_by_every_pair():
    sets = [np.arange(k, k + 100, dtype=np.uint64) for k in (0, 30, 5, 33)]
    n = len(sets)
    table = pa.table(
        {"node": pa.array(range(n), pa.int64()), "label": pa.array(range(n), pa.int64()), "block": pa.array([0] * n, pa.int64())}
        | {"lone": pa.array([True] * n), "grams": pa.array([s.tobytes() for s in sets], pa.binary())}
        | {c: pa.array([0] * n, pa.int64()) for c in simhash.WIDE}
    )
    assert simhash._settled(table, 55, 0.8) == [(0, 2), (1, 3)]
