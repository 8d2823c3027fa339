"""Readers, writers and streams."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from vigora.sources import readers, schemas, sinks
from vigora.streaming import streams

XML = """<akomaNtoso><meta><property name="canonical_id" value="/in/union/acts/a"/><property name="title" value="An Act"/><property name="document_type" value="act"/></meta>
<section eId="s1" refersTo="/in/union/acts/a/section/1"><num>1</num><heading>Short title</heading><p>See <ref href="/in/union/acts/b" showAs="B"/>.</p></section>
<section eId="s1b" refersTo="/in/union/acts/a/section/1"><p>Later copy, inserted.</p></section></akomaNtoso>"""


def test_corpus_from_xml(spark, tmp_path):
    (tmp_path / "a.xml").write_text(XML)
    (tmp_path / "none.xml").write_text("<akomaNtoso/>")
    made = {(r.role, r.canonical_id): r for r in readers.corpus(spark, str(tmp_path)).collect()}
    assert set(made) == {("document", "/in/union/acts/a"), ("provision", "/in/union/acts/a/section/1")}
    s = made["provision", "/in/union/acts/a/section/1"]
    assert (s.title, s.number, s.refs[0].target) == ("Short title", "1", "/in/union/acts/b")
    assert made["document", "/in/union/acts/a"].children == ["/in/union/acts/a/section/1"]


def test_jsonl_modes(spark, tmp_path):
    p = tmp_path / "g.jsonl"
    p.write_text('{"event_id": "e1", "date": "2020-01-01"}\n\n{bad\n')
    assert readers.jsonl(spark, str(p), schemas.GAP, "DROPMALFORMED").count() == 1
    with pytest.raises(Exception):
        readers.jsonl(spark, str(p), schemas.GAP).collect()


def test_sinks_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "key string, value int")
    sinks.parquet(df, f"{tmp_path}/p", "key")
    assert spark.read.parquet(f"{tmp_path}/p").count() == 2
    sinks.jsonl(df, f"{tmp_path}/j", "key")
    assert spark.read.json(f"{tmp_path}/j").count() == 2
    sinks.flat_yaml(df.withColumn("value", F.col("value").cast("string")), f"{tmp_path}/y")
    assert {(r.key, r.value) for r in readers.flat_yaml(spark, f"{tmp_path}/y").collect()} == {("a", "1"), ("b", "2")}
    a, b = (readers.files(spark, f"{tmp_path}/j").agg(readers.snapshot_id()).first()[0] for _ in range(2))
    assert a == b


def test_pages_and_parts(spark):
    rows = spark.createDataFrame([("d", 1, "abc"), ("d", 2, "de")], "k string, n int, t string")
    assert [(r.start, r.end) for r in readers.pages(rows, "k", "t", "n").orderBy("n").collect()] == [(0, 3), (5, 7)]
    parts = readers.numbered_parts(spark.createDataFrame([("d", "Head\n1. One.\n2A. Two\nmore")], "k string, t string"), "k", "t")
    assert [(r.label, r.body) for r in parts.orderBy("pos").collect()] == [("1", "One."), ("2A", "Two\nmore")]


def test_streams(spark, tmp_path):
    t = lambda m: dt.datetime(2024, 1, 1, 0, m)
    rows = spark.createDataFrame([(1, "a", t(0), 1.0), (2, "a", t(3), 1.0), (3, "b", t(1), 1.0), (1, "a", t(0), 1.0)], "id long, k string, ts timestamp, value double")
    rows.write.parquet(f"{tmp_path}/in")
    live = lambda: spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in")

    def run(df, name, mode="append"):
        q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", f"{tmp_path}/{name}").trigger(availableNow=True).start()
        q.awaitTermination(120)
        return spark.table(name).collect()

    assert len(run(streams.once(live(), "id", "ts", "1 hour"), "once")) == 3
    made = sorted((r.key, r.seq) for r in run(streams.versions(live(), "k", "ts", "1 hour"), "versions"))
    assert made == [("a", 1), ("a", 2), ("a", 3), ("b", 1)]
    counts = {r.k: r.n for r in run(streams.tumbling(live(), "ts", "1 hour", "k"), "tumbling", "complete")}
    assert counts == {"a": 3, "b": 1}
    early, late = streams.late_split(rows.withColumn("seen", F.lit(t(2))), "ts", "seen")
    assert (early.count(), late.count()) == (1, 3)
