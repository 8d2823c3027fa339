"""Readers: tables, line-delimited JSON, CSV, flat YAML, files, and document XML."""

from __future__ import annotations

import xml.etree.ElementTree as ET

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigora.functions.text import first_given
from vigora.sources import schemas


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def jsonl(spark: SparkSession, path: str, schema: str, bad: str = "FAILFAST") -> DataFrame:
    """One object a line. bad: FAILFAST ends the query, DROPMALFORMED skips such lines, PERMISSIVE keeps them in _corrupt_record."""
    if bad == "PERMISSIVE":
        schema += ", _corrupt_record string"
    return spark.read.schema(schema).option("mode", bad).json(path)


def json_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).json(path)


def csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("encoding", "UTF-8").csv(path)


def flat_yaml(spark: SparkSession, path: str) -> DataFrame:
    """path, key, value of 'key: value' lines."""
    rows = spark.read.text(path).withColumn("path", F.input_file_name()).where(F.col("value").rlike(r"^\s*[^#\s][^:]*:"))
    return rows.select("path", F.trim(F.regexp_extract("value", r"^([^:]*):", 1)).alias("key"), F.trim(F.trim(F.regexp_extract("value", r"^[^:]*:(.*)$", 1)), F.lit("\"'")).alias("value"))


def files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path, length, sha256 of files; for archives and for comparing folders."""
    rows = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)
    return rows.select("path", "length", F.sha2("content", 256).alias("sha256"))


def snapshot_id() -> Column:
    """A handle for a state of files: the same files give the same handle."""
    return F.sha2(F.array_join(F.array_sort(F.collect_list(F.concat_ws("|", "path", "length", "sha256"))), "\n"), 256)


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def parse_document(path: str, content: bytes) -> list[dict]:
    """One record for the document and one for each provision; none if the document has no canonical id."""
    root = ET.fromstring(content)
    properties = {e.get("name"): e.get("value") for e in root.iter() if _local(e.tag) == "property"}
    own = properties.get("canonical_id")
    if not own:
        return []

    def text_of(e) -> str:
        parts = [" ".join("".join(x.itertext()).split()) for x in e.iter() if _local(x.tag) in ("num", "heading", "p")]
        return "\n".join(p for k, p in enumerate(parts) if p and (not k or p != parts[k - 1]))

    def refs_of(e) -> list[dict]:
        found = {}
        for x in e.iter():
            if _local(x.tag) in ("ref", "textualMod") and (target := x.get("href")):
                found.setdefault((target, x.get("type") or _local(x.tag), x.get("eId")), {"target": target, "type": x.get("type") or _local(x.tag), "label": x.get("showAs"), "eid": x.get("eId")})
        return list(found.values())

    def record(e, id_, role, tag) -> dict:
        children = dict.fromkeys(x.get("refersTo") for x in e.iter() if x.get("refersTo") and x.get("refersTo") != id_)
        get = lambda name: next((" ".join("".join(x.itertext()).split()) for x in e if _local(x.tag) == name), None)
        return {"canonical_id": id_, "document_id": own, "role": role, "document_type": properties.get("document_type"), "element_tag": tag, "eid": e.get("eId"), "number": get("num"), "title": properties.get("title") if role == "document" else get("heading"), "text": text_of(e), "path": path, "children": list(children), "refs": refs_of(e)}

    return [record(root, own, "document", _local(root.tag))] + [record(e, e.get("refersTo"), "provision", _local(e.tag)) for e in root.iter() if e.get("refersTo")]


def corpus(spark: SparkSession, path: str, work: str | None = None) -> DataFrame:
    """Documents and provisions of a folder of XML; of several provisions with one id the one with a heading, then the longest, then the first path. work: only files of paths that hold it, filtered before they are read."""
    rows = spark.read.format("binaryFile").option("pathGlobFilter", "*.xml").option("recursiveFileLookup", True).load(path)
    if work:
        rows = rows.where(F.contains("path", F.lit(work)))

    def parse(batches):
        for pdf in batches:
            found = [r for p, c in zip(pdf["path"], pdf["content"]) for r in parse_document(p, c)]
            if found:
                yield pd.DataFrame(found)

    parsed = rows.select("path", "content").mapInPandas(parse, schemas.PROVISION)
    score = F.when(F.length(F.trim(F.coalesce("title", F.lit("")))) > 0, 2).when(F.col("text").rlike(r"(?i)\b(substituted|inserted|omitted)\b"), 0).otherwise(1)
    w = Window.partitionBy("canonical_id", "role").orderBy(F.desc(score), F.desc(F.length("text")), "path")
    return parsed.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def source_records(raw: DataFrame) -> DataFrame:
    """Text and date of a source, with where each came from."""
    text = first_given("content_text", "archive_text", "pdf_text", "name", "number")
    basis = F.when(F.nullif("content_text", F.lit("")).isNotNull(), "content").when(F.nullif("archive_text", F.lit("")).isNotNull(), "archive").when(F.nullif("pdf_text", F.lit("")).isNotNull(), "pdf").otherwise("name")
    date = first_given("commencement_date", "publication_date")
    return raw.withColumns({"text": text, "text_source": basis, "effective_date": F.try_to_date(date, "yyyy-MM-dd"), "date_basis": F.when(F.nullif("commencement_date", F.lit("")).isNotNull(), "commencement").otherwise("publication")}).withColumn("source_text_sha256", F.sha2("text", 256))


def pages(archive: DataFrame, key: str, page: str, number: str) -> DataFrame:
    """Pages joined by an empty line, with each page's place in the whole."""
    w = Window.partitionBy(key).orderBy(number).rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length(page) + 2).over(w), F.lit(0))
    return archive.withColumn("start", start).withColumn("end", F.col("start") + F.length(page))


def numbered_parts(docs: DataFrame, key: str, text: str, mark: str = r"(?m)^\s*(\d+[A-Z]*)\.\s") -> DataFrame:
    """key, pos, label, body: a text split at its numbered starts."""
    made = docs.withColumn("_parts", F.split(F.regexp_replace(text, mark, "\u0001$1\u0002"), "\u0001"))
    rows = made.select(key, F.posexplode("_parts").alias("pos", "p")).where(F.contains("p", F.lit("\u0002")))
    return rows.select(key, "pos", F.substring_index("p", "\u0002", 1).alias("label"), F.regexp_replace(F.expr("substring(p, instr(p, '\u0002') + 1)"), r"^\s+|\s+$", "").alias("body"))
