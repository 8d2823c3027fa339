"""The pipeline's stages one after the other, and the registration of all queries."""

from __future__ import annotations

import __spark_entry__
import corpus_pipeline
from vigora.llm.common import table


def test_stages_keep_columns_and_take_effect(spark, small):
    docs = table(spark, small, "documents")
    sizes, names = [docs.count()], docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        docs = stage(spark, docs, small).cache()
        sizes.append(docs.count())
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == names
            assert docs.select("doc_id").subtract(before.select("doc_id")).count() == 0
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality", "neardup", "mixing", "pieces"]
    assert sizes[1] < sizes[0] and sizes[2] < sizes[1] and sizes[3] < sizes[2] and sizes[5] == sizes[4] > 0
    assert docs.where("NOT round_trip").count() == 0


def test_stages_are_those_of_brute_force(spark, small):
    """Each stage, on its own input, against a plain version."""
    import public_tokenizers

    from tests.llm.test_operators import brute_components
    from vigora.llm import pieces, quality, toxicity

    docs = table(spark, small, "documents").cache()
    rows = lambda df: sorted(df.select("doc_id", "text").collect())
    run = dict(corpus_pipeline.STAGES)
    score = toxicity.fit(docs, table(spark, small, "labels")).scorer()
    clean = run["toxicity"](spark, docs, small).cache()
    assert rows(clean) == [r for r in rows(docs) if score(r.text)[0] < toxicity.THRESHOLD]
    good = run["quality"](spark, clean, small).cache()
    compress = quality._compressor()
    assert rows(good) == [r for r in rows(clean) if quality.judge(r.text, compress)["kept"]]
    single = run["neardup"](spark, good, small).cache()
    of = brute_components([(r.doc_id, r.text) for r in rows(good)], corpus_pipeline.SHINGLE)
    assert rows(single) == [r for r in rows(good) if of[r.doc_id][1] == r.doc_id]
    mixed = run["mixing"](spark, single, small).cache()
    known, copies = set(rows(single)), {}
    for r in rows(mixed):
        assert r in known
        copies[r] = copies.get(r, 0) + 1
    assert max(copies.values()) <= 2
    lattice = pieces.Lattice(public_tokenizers.path("piece_bpe_32k.model"))
    made = {(r.doc_id, tuple(r.ids)) for r in run["pieces"](spark, mixed, small).collect()}
    assert made == {(r.doc_id, tuple(lattice.encode(r.text)[0][1])) for r in rows(mixed)}


def test_the_pipeline_on_odd_tables(spark, tmp_path):
    """Nulls, empty and long texts, repeated rows and ids, clashing names; and no rows at all."""
    from tests.llm.test_operators import LONG, docs

    prose = [" ".join(f"{a}{b}{k % 7}" for k, (a, b) in enumerate(zip("bdfgklmnprst" * 9, "aeiouaeiou" * 12))) + f" end{j}" for j in range(3)]
    odd = [(1, prose[0], "s1"), (1, prose[0], "s1"), (2, None, None), (3, "", "s1"), (4, LONG, "s2"), (None, prose[1], "s2"), (5, "You idiot said it", "s3"), (6, prose[2], None)]
    for name, rows in (("odd", odd), ("none", [])):
        docs(spark, rows).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame([(1, 1, 0), (None, None, None)][: len(rows)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/{name}/labels.parquet")
        made = corpus_pipeline.run(spark, f"{tmp_path}/{name}").collect()
        assert {r.doc_id for r in made} <= {r[0] for r in rows} and all(r.round_trip for r in made)


def test_each_stage_begins_with_memory_given_back(spark, small, monkeypatch):
    """Else a stage's Python workers grow beside the heap that the stage before has left."""
    from vigora.llm import common

    beans = spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans
    collections = lambda: sum(b.getCollectionCount() for b in beans())
    before = collections()
    common.collect_garbage(spark)
    assert collections() > before
    docs, asked = table(spark, small, "documents"), []
    monkeypatch.setattr(corpus_pipeline, "give_back", lambda s: asked.append(s))
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs.limit(20), small)
        assert asked == [spark] * (k + 1)


def test_every_operator_is_registered():
    names = set(__spark_entry__.queries())
    assert {f"op{n}" for n in range(1, 11)} == {n.partition("_")[0] for n in names if n.startswith("op")} and "pipeline" in names
    assert set(__spark_entry__.oracle_sql()) <= names


def test_near_duplicates_have_the_sql_s_rows(spark, small):
    from parity import connect, difference

    import vigora.llm.queries as q

    assert difference(q.QUERIES["op8_neardup"](spark, small), connect(small), q.ORACLES["op8_neardup"]) is None
