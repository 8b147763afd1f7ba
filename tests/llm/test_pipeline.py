"""The pipeline's stages, each on its own input, and the registered names."""

import pytest

import corpus_pipeline
from tests.llm.test_operators import brute_components, brute_hits, brute_lines, chain
from tidemark.llm import jaccard_join


def test_stages_take_effect_and_keep_clean_documents(spark, tmp_path):
    plain = " ".join(f"w{k}" for k in range(40))
    leak = "this passage of the benchmark must never be part of any training text at all"
    notice = "All rights reserved by the owners of this site"
    rows = [(i, f"{plain} own{i} " + " ".join(f"x{i}y{k}" for k in range(40)), "en", "s", 0) for i in range(30)]
    rows += [(40, rows[0][1], "en", "s", 0), (41, f"{rows[1][1]} end", "en", "s", 0), (42, f"before {leak} after", "en", "s", 0), (43, None, "en", "s", None), (44, "", "en", "s", 0)]
    rows += [(50 + k, f"{notice}\nfree text number {k} " + " ".join(f"z{k}q{j}" for j in range(9)), "en", "s", 0) for k in range(4)]
    rows += [(100 + k, f"you are scum r{k}a r{k}b", "en", "s", 0) for k in range(40)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, int(i >= 100)) for i, *_ in rows], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs, kept = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for name, stage in corpus_pipeline.STAGES:
        before = [tuple(r)[:2] for r in docs.collect()]
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        kept[name] = {r.doc_id for r in out.collect()}
        if name == "toxicity":
            assert kept[name] == {i for i, *_ in rows if i < 100}
        elif name == "line_dedup":
            assert kept[name] == {i for i, _ in before}
            import hashlib

            want = {i: h for i, _, _, h in brute_lines(before)}
            assert all(hashlib.sha256((r.text or "").encode()).hexdigest() == want[r.doc_id] for r in out.collect())
        elif name == "near_duplicates":
            assert kept[name] == {c for _, _, c in brute_components(before)}
        elif name == "decontamination":
            assert kept[name] == {i for i, _, hit, *_ in brute_hits(before, [(1, leak)]) if not hit}
        if name != "byte_bpe":
            assert out.columns == docs.columns
        docs = out
    assert docs.count() == len(kept["decontamination"]) and sorted(r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) == sorted(kept["byte_bpe"])


@pytest.mark.parametrize("most", [0, 1000])
def test_decontamination_goes_by_rows(spark, tmp_path, monkeypatch, most):
    """One hit row with a null or repeated id takes no other row along; a short item counts whole."""
    monkeypatch.setattr(corpus_pipeline, "BROADCAST_KEYS", most)
    leak = "this passage of the benchmark must never be part of any training text at all"
    rows = [(None, f"x {leak}"), (None, "clean one"), (None, None), (7, leak), (7, "clean two"), (7, leak), (8, "it is short words here"), (9, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(1, leak), (2, "Short, words"), (3, None), (None, "no such thing in any text of these")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    out = corpus_pipeline.decontamination(spark, docs, str(tmp_path))
    assert out.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == sorted([(None, "clean one"), (None, None), (7, "clean two"), (9, "")], key=str)


@pytest.mark.parametrize("most", [0, 1000])
def test_near_duplicates_by_ids(spark, monkeypatch, most):
    """The smallest id of a group stays, with all rows of that id; null ids are an id; texts without words stay."""
    monkeypatch.setattr(corpus_pipeline, "BROADCAST_KEYS", most)
    text = " ".join(f"w{k}" for k in range(30))
    rows = [(5, text), (3, text), (3, "other words altogether here now"), (9, text + " end"), (7, None), (8, ""), (None, "a text of its own words here"), (None, "a text of its own words here")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.near_duplicates(spark, docs, "")
    assert out.columns == docs.columns
    assert sorted(((str(r.doc_id), r.text) for r in out.collect() if r.doc_id is not None), key=lambda x: (x[0], x[1] or "")) == [("3", rows[2][1]), ("3", text), ("7", None), ("8", "")]


def test_near_duplicates_of_a_large_group_in_blocks(spark, monkeypatch):
    """A group of near copies whose search is too much work for one task is cut; the same documents stay."""
    monkeypatch.setattr(jaccard_join, "WORK", 10_000)
    rows = chain() + [(900, None), (901, "a text of its own words here")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.near_duplicates(spark, docs, "")
    assert sorted(r.doc_id for r in out.collect()) == sorted({c for _, _, c in brute_components(rows)})


def test_registered():
    import __spark_entry__ as entry

    names = [n for n in entry.queries() if n.startswith("op")]
    assert len({n.split("_")[0] for n in names}) == 13 and "pipeline" in entry.queries()
