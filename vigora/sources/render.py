"""Rendering structured rows as XML text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigora.functions.ids import file_slug, safe_eid


def escaped(x: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        x = F.replace(x, F.lit(a), F.lit(b))
    return x


def element(tag: str, body: Column, **attributes: Column) -> Column:
    """An element as text; attributes without a value are left out."""
    given = [F.when(v.isNotNull(), F.concat(F.lit(f' {k}="'), escaped(v.cast("string")), F.lit('"'))).otherwise("") for k, v in attributes.items()]
    return F.concat(F.lit(f"<{tag}"), *given, F.lit(">"), body, F.lit(f"</{tag}>"))


def documents(nodes: DataFrame, key: str, pos: str) -> DataFrame:
    """key, path, xml: a document's nodes (node_type, text, start, end, text_hash) in order, with their source spans."""
    node = element("section", element("p", escaped(F.col("text"))), eId=safe_eid(F.concat_ws("_", F.col(key).cast("string"), F.col(pos).cast("string"))), sourceStart=F.col("start"), sourceEnd=F.col("end"), sourceHash=F.col("text_hash"), sourceNodeType=F.col("node_type"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(pos).alias("p"), node.alias("x")))), lambda n: n.x), "")
    return nodes.groupBy(key).agg(body.alias("body")).select(key, F.concat(file_slug(F.col(key).cast("string")), F.lit(".xml")).alias("path"), element("akomaNtoso", F.col("body")).alias("xml"))
