"""Documents as units of work: how their rows are dealt out, and Python over one document at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from docketry.session import ship_package

#: Rows of a batch that goes back to Spark, unless one document has more.
OUT_ROWS = 5000


def spread(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt by their keys over all tasks of a shuffle.

    A small file is read in one task, and adaptive execution joins partitions of few
    bytes; keys that stand for much work each would so be worked on one after another.
    """
    spark = rows.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return rows.repartition(tasks, *keys)


def over_documents(docs: DataFrame, run: Callable[..., Iterable[tuple]], schema: str) -> DataFrame:
    """What ``run`` makes of every row of ``docs``, which holds a whole document in array columns.

    ``run`` gets the row's values and gives tuples in the order of ``schema``.  Documents cross
    to Python many in a batch, and are unpacked one at a time.
    """
    ship_package(docs.sparkSession)
    fields = list(to_arrow_schema(StructType.fromDDL(schema)))

    def packed(made: list[tuple]) -> pa.RecordBatch:
        columns = zip(*made, strict=True) if made else [()] * len(fields)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, fields, strict=True)], names=[f.name for f in fields])

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            made: list[tuple] = []
            for i in range(part.num_rows):
                made.extend(run(*[c[i].as_py() for c in part.columns]))
                if len(made) >= OUT_ROWS:
                    yield packed(made)
                    made = []
            yield packed(made)

    return docs.mapInArrow(batches, schema)


def judged(
    rows: DataFrame, flag: str, judge: Callable[..., list], *needs: str, kind: str = "boolean", keys: tuple[str, ...] = ("doc",), by: str | None = "position"
) -> DataFrame:
    """Rows with a column ``flag`` that depends on the other rows of the document.

    ``judge`` gets a document's values of the needed columns, each as a list in the order of
    ``by``, and gives as many verdicts.  The other columns do not leave the JVM.
    """
    ship_package(rows.sparkSession)
    out_type = pa.list_(to_arrow_schema(StructType.fromDDL(f"v {kind}")).field(0).type)

    def decided(*values: list) -> list:
        place, own = (values[0], values[1:]) if by else (None, values)
        order = sorted(range(len(values[0])), key=lambda i: (place[i] is None, place[i] or 0)) if place else range(len(values[0]))
        out = [None] * len(values[0])
        for i, verdict in zip(order, judge(*[[v[i] for i in order] for v in own]), strict=True):
            out[i] = verdict
        return out

    @F.arrow_udf(f"array<{kind}>")
    def flags(*arrays: pa.Array) -> pa.Array:
        return pa.array([decided(*[v.as_py() for v in values]) for values in zip(*arrays, strict=True)], out_type)

    held = rows.groupBy(*keys).agg(F.collect_list(F.struct(*rows.columns)).alias("__rows"))
    marked = held.select("__rows", flags(*[F.col("__rows")[c] for c in ((by,) if by else ()) + needs]).alias("__flags"))
    each = marked.select(F.explode(F.arrays_zip("__rows", "__flags")).alias("__row"))
    return each.select(*[F.col("__row")["__rows"][c].alias(c) for c in rows.columns], F.col("__row")["__flags"].alias(flag))
