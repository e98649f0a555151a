"""An identity for each row of a table of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.operators.ranking import with_row_index


def numbered(docs: DataFrame) -> tuple[DataFrame, bool]:
    """(id, row) of each document, and whether the ids are the documents' own.

    ``id`` is a long of the row alone that follows the order of doc_id; ``row``
    holds all columns, so their names may clash with nothing. Where every row
    has a doc_id of its own, that is the id. Otherwise the rows are numbered and
    stored: by doc_id, missing ones last, then by text; rows equal in both come
    in any order. The order includes a hash of the text, so a third of all rows
    without an id is no single range of the sort. The rows' ids alone are
    shuffled to find out.
    """
    own = F.col("doc_id").cast("bigint")
    unclear = docs.groupBy(own.alias("id")).agg(F.count(F.lit(1)).alias("n")).where("n > 1 OR id IS NULL")
    rows = docs.select(own.alias("id"), F.struct("*").alias("row"))
    if unclear.isEmpty():
        return rows, True
    order = [F.col("given").asc_nulls_last(), F.xxhash64("row.text"), F.col("row.text")]
    return with_row_index(rows.withColumnRenamed("id", "given"), order, "id").select("id", "row"), False
