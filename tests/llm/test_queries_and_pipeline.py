"""The registered queries on the smallest tables, and the pipeline stage by stage."""

import glob
import os
from collections import Counter

import duckdb
import pytest

import corpus_pipeline
from genoweave.llm import registry, toxicity
from tests.llm.test_near_duplicates import brute_kept


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for p in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    ours = registry.queries()[name](spark, sf_dir)
    theirs = con.execute(f"SELECT {', '.join(ours.columns)} FROM ({registry.oracle_sql()[name]})").fetchall()
    assert sorted(map(repr, (tuple(r) for r in ours.collect()))) == sorted(map(repr, theirs))


def test_thirteen_queries_and_the_pipeline_are_registered():
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert {n.split("_")[0] for n in registry.queries()} == {f"op{i}" for i in range(1, 14)}
    assert set(registry.queries()) | {"pipeline"} <= names


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql()) - {"op13_structure_repair"}))
def test_query_returns_a_row_for_each_row(spark, sf_dir, name):
    n = registry.queries()[name](spark, sf_dir).count()
    table = "pages" if name.startswith("op4") else "documents"
    rows = spark.read.parquet(f"{sf_dir}/{table}.parquet").count()
    assert n == rows if not name.startswith("op10") else n >= rows


def test_native_queries_have_no_python(spark, sf_dir):
    for name, f in registry.queries().items():
        if name.split("_")[0] in ("op3", "op7", "op8", "op9"):
            plan = f(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
            assert not any(x in plan for x in ("Python", "Pandas", "Arrow")), name


def test_stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf_dir)
        assert name == "packing" or out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        out.write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        kept[name] = docs.collect()
    source = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(*toxicity.sample(spark.read.parquet(f"{sf_dir}/documents.parquet"), labels))
    rejected = {r["doc_id"] for r in toxicity.score(spark.read.parquet(f"{sf_dir}/documents.parquet"), model).collect() if r["predicted"]}
    assert {r["doc_id"] for r in kept["toxicity"]} == set(source) - rejected
    # near-duplicates: the smallest id of each component of links of similarity 0.8 or more of five-word shingles
    assert {r["doc_id"] for r in kept["simhash_dedup"]} == brute_kept([(r["doc_id"], r["text"]) for r in kept["toxicity"]])
    # substrings: no window of 20 words twice; documents without repeats stay as they are
    seen = set()
    before = {r["doc_id"]: r["text"] for r in kept["simhash_dedup"]}
    cut = {}
    for i in sorted(before):
        ws = (before[i] or "").encode().split()
        drop = [False] * len(ws)
        for s in range(len(ws) - 19):
            w = tuple(ws[s : s + 20])
            if w in seen:
                drop[s : s + 20] = [True] * 20
            seen.add(w)
        if not all(drop) or not ws:
            cut[i] = [w for w, d in zip(ws, drop) if not d]
    after = {r["doc_id"]: (r["text"] or "") for r in kept["substring_dedup"]}
    assert {i: t.encode().split() for i, t in after.items()} == cut
    assert all(after[i] == before[i] for i in after if len((before[i] or "").encode().split()) == len(cut[i]))
    assert all(r["n_chars"] == len(r["text"]) for r in kept["substring_dedup"])
    # the mix: words of documents, each at most three times; packing: every piece has its place
    uses = Counter()
    for r in kept["mixing"]:
        uses[r["doc_id"]] += len(r["text"].encode().split())
    assert all(n <= 3 * len(cut[i]) for i, n in uses.items())
    total = sum(map(len, cut.values()))
    assert abs(sum(uses.values()) - total) <= 0.05 * total + 256 * 20
    assert {r["doc_id"] for r in kept["packing"]} == set(uses)
    assert len(kept["packing"]) >= len(kept["mixing"])


def test_run(spark, sf_dir, tmp_path, monkeypatch):
    monkeypatch.setattr(corpus_pipeline, "shared_folder", lambda spark: str(tmp_path))
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and out.count() > 0
    (folder,) = os.listdir(tmp_path)
    assert os.listdir(tmp_path / folder) == ["packing"]


def test_a_named_run_is_resumed(spark, sf_dir, tmp_path, monkeypatch):
    monkeypatch.setattr(corpus_pipeline, "shared_folder", lambda spark: str(tmp_path))
    ran = []

    def stage(name, f):
        def run(spark, docs, sf_dir):
            ran.append(name)
            if name == "b" and ran.count("b") == 1:
                raise RuntimeError("lost")
            return f(docs)

        return name, run

    monkeypatch.setattr(corpus_pipeline, "STAGES", [stage("a", lambda d: d.limit(20)), stage("b", lambda d: d.select("doc_id"))])
    with pytest.raises(RuntimeError):
        corpus_pipeline.run(spark, sf_dir, "trial")
    assert corpus_pipeline.run(spark, sf_dir, "trial").count() == 20 and ran == ["a", "b", "b"]
    corpus_pipeline.forget(spark, "trial")
    assert os.listdir(tmp_path) == []


def test_stages_on_odd_rows(spark, odd_docs, no_docs, sf_dir):
    """Nulls, repeated rows and ids, empty tables, columns with clashing names: whole outputs."""
    plain = odd_docs.select("doc_id", "text", "lang", "source", "n_chars", "bucket", "fp", "node", "size")
    rows = [r.asDict() for r in plain.collect()]
    brute = lambda rs: {i for i in brute_kept([(k, r["text"]) for k, r in enumerate(rs)])}
    order = sorted(range(len(rows)), key=lambda k: (rows[k]["doc_id"] is None, rows[k]["doc_id"] or 0))
    near = [tuple(r) for r in corpus_pipeline.near_duplicates(spark, plain, sf_dir).collect()]
    ranked = [rows[k] for k in order]
    want = [ranked[k] for k in brute(ranked)]
    assert sorted(x[0] is None for x in near) == sorted(w["doc_id"] is None for w in want) and len(near) == len(want)
    assert sorted(str(x[0]) for x in near) == sorted(str(w["doc_id"]) for w in want)
    for name, f in corpus_pipeline.STAGES:
        out, none = f(spark, plain, sf_dir), f(spark, no_docs.select(*plain.columns), sf_dir)
        assert none.count() == 0
        if name != "packing":
            assert out.columns == none.columns == plain.columns
            assert {(r["doc_id"], r["lang"], r["source"]) for r in out.collect()} <= {(r["doc_id"], r["lang"], r["source"]) for r in rows}
