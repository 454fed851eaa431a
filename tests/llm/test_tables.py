"""Archives, vectors, components, the pipeline, and registered queries against their SQL."""

import base64
import gzip
import hashlib
import os
import random

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from candlewick.llm import embedding_dedup, warc
from candlewick.llm.components import components
from candlewick.llm.oracle import ORACLE
from candlewick.llm.queries import QUERIES
from candlewick.llm.ranking import ranked
from candlewick.sources.scratch import materialise, scratch_path

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


# --- archives -----------------------------------------------------------------------


def test_archives_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 2000)
    rng = random.Random(1)
    payloads = ["", None, "<p>é\r\n\r\n中</p>", "x" * 3_000_000, "WARC/1.1\r\n\r\n"] + ["".join(rng.choice("ab<>\n") for _ in range(200)) for _ in range(40)]
    rows = [(i, f"http://h/{i}\n", p) for i, p in enumerate(payloads)] + [(100 + i, None, payloads[5 + i % 3]) for i in range(30)]
    rows += [(None, "u", "only null"), (None, "u", payloads[6]), (7, "again", payloads[7]), (1, "other", payloads[9]), (8, "other", payloads[1])]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, payload string").repartition(3)
    files = materialise(warc.write(warc.mark_revisits(pages), scratch_path(spark, "warc")), "files")
    names = [r["file"] for r in files.collect()]
    assert len(names) > 3
    index = materialise(warc.index(files), "index")
    # The index tiles each file, and any gzip reader finds the same records.
    for name in names:
        parts = sorted((r["offset"], r["length"]) for r in index.filter(index["file"] == name).collect())
        assert [o for o, _ in parts] == [0, *np.cumsum([n for _, n in parts])[:-1].tolist()]
        with gzip.open(name) as f:
            assert f.read().count(b"WARC-Record-ID: ") == len(parts)
    seen = {}
    for r in warc.resolved(warc.measured(warc.read(index))).select(warc.page_id("record_id").alias("i"), "*", warc.page_id("refers_to").alias("of")).collect():
        seen.setdefault(r["i"], []).append((r["payload_bytes"], r["payload_digest"], r["record_type"], r["of"]))
    first = {}
    for i, _, p in rows:
        if i is not None:
            first[p or ""] = min(i, first.get(p or "", i))
    want = {}
    for i, _, p in rows:
        raw = (p or "").encode()
        of = first.get(p or "")
        same = of == i
        sha = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        want.setdefault(i, []).append((len(raw), sha, "response" if same else "revisit", None if same else of))
    assert {k: sorted(v, key=str) for k, v in seen.items()} == {k: sorted(v, key=str) for k, v in want.items()}
    # A few records come by a few reads.
    some = warc.read(index.filter("payload_digest LIKE 'A%'"))
    assert all(warc.digest(bytes(r["payload"])) == r["payload_digest"] for r in some.filter("record_type = 'response'").collect())
    none = materialise(warc.write(warc.mark_revisits(pages.limit(0)), scratch_path(spark, "warc")), "files")
    assert none.count() == 0 and warc.read(warc.index(none)).count() == 0


def test_ranges_are_coalesced():
    rows = [{"file": f, "offset": o, "length": 10} for f, o in [("a", 0), ("a", 10), ("a", 100), ("b", 110), ("b", 500)]]
    groups = [[(r["file"], r["offset"]) for r in g] for g in warc.coalesce(rows, gap=80, most=1000)]
    assert groups == [[("a", 0), ("a", 10), ("a", 100)], [("b", 110)], [("b", 500)]]
    assert len(list(warc.coalesce(rows, gap=80, most=15))) == 5


def test_a_cut_file_is_an_error(tmp_path):
    whole = gzip.compress(b"WARC/1.1\r\nWARC-Type: response\r\n\r\nabc\r\n\r\n")
    (tmp_path / "x.warc.gz").write_bytes(whole + whole[:-9])
    with pytest.raises(ValueError, match="ends within the record"):
        list(warc.scan(str(tmp_path / "x.warc.gz")))


# --- graphs and orders ----------------------------------------------------------------


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(1000, 1000 + i) for i in range(1, 200)]
    edges += [(2000 + i, 2001 + i) for i in range(60)] + [(5, 5), (1000, 1001)]
    parent = {v: v for e in edges for v in e}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    got = components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert {r["node"]: r["component"] for r in got} == {v: root(v) for e in edges if e[0] != e[1] for v in e}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_ranks(spark):
    df = spark.createDataFrame([(None,), ("b",), ("a",), ("c",), ("B",)], "s string")
    assert [r["s"] for r in sorted(ranked(df, "s").collect(), key=lambda r: r["__rank"])] == ["B", "a", "b", "c", None]


# --- vectors ------------------------------------------------------------------------


@pytest.mark.parametrize(("block", "overlap"), [(1536, 512), (120, 40)])
def test_vectors_against_every_pair(spark, monkeypatch, block, overlap):
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    monkeypatch.setattr(embedding_dedup, "OVERLAP", overlap)
    rng = np.random.default_rng(3)
    rows = [rng.standard_normal(16) for _ in range(300)]
    rows += [rows[i % 40] + rng.standard_normal(16) * 0.08 for i in range(400)]
    rows += [rows[0]] * 90
    vectors = [(i, [float(x) for x in v]) for i, v in enumerate(rows)]
    odd = [(9001, None), (9002, [0.0] * 16), (9003, [float("nan")] * 16), (9004, [1.0, 2.0]), (9005, [2.0, 4.0]), (9006, []), (9007, [None, 1.0]), (None, [3.0, 6.0]), (None, None), (5, vectors[5][1])]
    df = spark.createDataFrame(vectors + odd, "vec_id bigint, embedding array<double>")
    got = embedding_dedup.near_duplicates(df).collect()
    assert len(got) == len(vectors) + len(odd)
    m = np.array([v for _, v in vectors])
    m /= np.linalg.norm(m, axis=1)[:, None]
    link = m @ m.T >= 0.95
    degree = link.sum(axis=1) - 1 + link[:, 5]
    by_id = {}
    for r in got:
        by_id.setdefault(r["vec_id"], []).append((r["n_links"], r["component_id"], r["kept"]))
    found = sum(by_id[i][0][0] for i in range(len(rows)))
    assert found >= 0.99 * degree.sum() and all(by_id[i][0][0] <= degree[i] for i in range(len(rows)))
    for i in (9001, 9002, 9003, 9006, 9007):
        assert by_id[i] == [(0, i, True)]
    assert by_id[9005] == [(2, 9004, False)] and sorted(by_id[None], key=str) == [(0, None, True), (2, 9004, False)]
    assert len(by_id[5]) == 2 and all(c == by_id[5][0][1] for _, c, _ in by_id[5])
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("spread", [0.02, 1e-9])
def test_vectors_in_a_crowd_many_blocks_wide(spark, monkeypatch, spread):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 64)
    monkeypatch.setattr(embedding_dedup, "OVERLAP", 16)
    rng = np.random.default_rng(8)
    crowd = rng.standard_normal(16) + rng.standard_normal((1000, 16)) * spread
    m = np.concatenate([crowd, rng.standard_normal((2000, 16))])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "vec_id bigint, embedding array<double>")
    got = {r["vec_id"]: r for r in embedding_dedup.near_duplicates(df).collect()}
    m /= np.linalg.norm(m, axis=1)[:, None]
    degree = (m @ m.T >= 0.95).sum(axis=1) - 1
    assert degree[:1000].min() >= 999
    assert all(got[i]["n_links"] <= degree[i] for i in got)
    assert sum(r["n_links"] for r in got.values()) >= 0.999 * degree.sum()
    assert {got[i]["component_id"] for i in range(1000)} == {0}


# --- queries ------------------------------------------------------------------------


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("documents", "pages", "labels", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", list(ORACLE))
def test_same_result_as_sql(spark, duck, name):
    ours, theirs = QUERIES[name](spark, FOLDER).toArrow(), duck.execute(ORACLE[name]).to_arrow_table()
    columns = sorted(ours.column_names)
    assert columns == sorted(theirs.column_names)
    a, b = (sorted(zip(*[t.column(c).to_pylist() for c in columns]), key=str) for t in (ours, theirs))
    assert a == b


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLE and n not in ("op7_passages", "op11_packing")])
def test_one_row_per_document(spark, name):
    assert QUERIES[name](spark, FOLDER).count() == spark.read.parquet(f"{FOLDER}/documents.parquet").count()


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, before = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialise(stage(spark, docs, FOLDER), name)
        assert docs.columns == columns and docs.dtypes == before.dtypes, name
        if name != "mixture":
            assert docs.count() == docs.select("doc_id").distinct().count() <= before.count(), name
        before = docs
    last = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert last.count() == docs.count() == corpus_pipeline.run(spark, FOLDER).count()


def test_pipeline_on_odd_rows(spark, odd):
    docs = odd
    for name, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, FOLDER), name)
    assert docs.select("doc_id").distinct().count() >= 1
    docs = odd.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, FOLDER), name)
    assert docs.count() == 0
