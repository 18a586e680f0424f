"""Small helpers to parse literal feed text with the library code."""

from pyspark.sql import functions as F

from tenderlake.operators.entries import to_entries
from tenderlake.sources.xml_feed import cut_documents, parse_entries


def entries_of(spark, feed_text: str, keep_raw_xml: bool = False):
    """Cut a whole feed document into entries, parse and project."""
    texts = cut_documents(spark.createDataFrame([(feed_text.encode(),)], "content binary"))
    parsed = parse_entries(texts, keep_raw_xml=keep_raw_xml)
    return to_entries(parsed, raw_xml_col="raw_block" if keep_raw_xml else None)


def one(spark, feed_text: str, **kw):
    rows = entries_of(spark, feed_text, **kw).collect()
    assert len(rows) == 1, rows
    return rows[0]


def col_values(df, expr):
    return [r[0] for r in df.select(F.expr(expr)).collect()]
