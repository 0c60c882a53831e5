"""Export of tables as JSON documents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Version written in the envelope; fixed value.
FORMAT_VERSION = "2.0"


def documents(
    tables: dict[str, DataFrame], batch: str, envelope: bool = True, order: list[str] | None = None
) -> DataFrame:
    """One JSON document per value of the column ``batch``: ``(batch, text)``, tables in the given order.

    Records are sorted by ``order`` (by their text without one). All records of a document end up in
    one row, so the caller's batches must be of bounded size.
    """
    parts = []
    for name, df in tables.items():
        payload = F.to_json(F.struct(*[c for c in df.columns if c != batch]), {"ignoreNullFields": "false"})
        place = F.struct(*[F.col(c) for c in order]) if order else F.struct(F.lit(0).alias("none"))
        parts.append(
            df.select(
                F.col(batch).alias("batch"), F.lit(name).alias("table"),
                F.struct(place.alias("place"), payload.alias("record")).alias("row"),
            )
        )
    rows = reduce(DataFrame.unionByName, parts)
    lists = rows.groupBy("batch", "table").agg(
        F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list("row"))["record"].alias("records")
    )
    order = F.array_position(F.array(*[F.lit(t) for t in tables]), F.col("table"))
    named = lists.withColumn("entry", F.concat(_quoted(F.col("table")), F.lit(":["), F.array_join("records", ","), F.lit("]")))
    docs = named.groupBy("batch").agg(
        F.array_sort(F.collect_list(F.struct(order.alias("o"), "entry", "table", "n"))).alias("t")
    )
    data = F.concat(F.lit("{"), F.array_join(F.col("t")["entry"], ","), F.lit("}"))
    if not envelope:
        return docs.select("batch", data.alias("text"))
    counts = F.to_json(F.map_from_entries(F.transform("t", lambda e: F.struct(e["table"], e["n"]))))
    return docs.select("batch", _enveloped(data, counts).alias("text"))


def _quoted(text: Column) -> Column:
    """JSON string literal of a text."""
    listed = F.to_json(F.array(text))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def _enveloped(data: Column, counts: Column) -> Column:
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.concat(
        F.lit('{"metadata":{"generation_timestamp":"'), now, F.lit(f'","generator_version":"{FORMAT_VERSION}","entity_counts":'),
        counts, F.lit('},"data":'), data, F.lit("}"),
    )


def write_lines(docs: DataFrame, path: str) -> None:
    """One document per line: files that Spark can split."""
    docs.select("text").write.mode("errorifexists").text(path)


def write_files(docs: DataFrame, path: str) -> None:
    """One document per file, in a folder per batch."""
    docs.repartition("batch").write.mode("errorifexists").option("lineSep", "\n").partitionBy("batch").text(path)
