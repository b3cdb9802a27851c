"""A batch data source over id ranges, one partition a range.

``fetch(start, end)`` is any function that returns the response text of the records
with start <= id < end; it runs on the executors and is retried there.  A response
that is full may have been cut off, so a full range is halved, left part first, until
its parts are not full or hold one id.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

Fetch = Callable[[int, int], str]
SCHEMA = "range_start bigint, range_end bigint, value string"


def fetched(fetch: Fetch, start: int, end: int, tries: int = 4, pause: float = 5.0, sleep: Callable[[float], None] = time.sleep) -> str:
    """The response of a range; an empty one is an error and errors are retried, waiting twice as long each time."""
    for n in range(tries):
        try:
            text = fetch(start, end)
            if text.strip():
                return text
            raise ValueError(f"empty response for {start}-{end}")
        except Exception:
            if n + 1 == tries:
                raise
            sleep(pause * 2**n)
    raise AssertionError


def subdivided(fetch: Fetch, start: int, end: int, cap: int = 200, **how) -> Iterator[tuple[int, int, str]]:
    """(start, end, response) of the parts of a range that are not full."""
    text = fetched(fetch, start, end, **how)
    if end - start > 1 and len(re.findall(r"<(?:\w+:)?record[\s>]", text)) >= cap:
        middle = (start + end) // 2
        yield from subdivided(fetch, start, middle, cap, **how)
        yield from subdivided(fetch, middle, end, cap, **how)
    else:
        yield start, end, text


class Range(InputPartition):
    def __init__(self, start: int, end: int):
        self.start, self.end = start, end


def range_source(fetch: Fetch, name: str = "id_ranges", cap: int = 200, pause: float = 5.0) -> type[DataSource]:
    """A data source class to register: options start, end and width (of a partition)."""

    class Reader(DataSourceReader):
        def __init__(self, start: int, end: int, width: int):
            self.start, self.end, self.width = start, end, width

        def partitions(self) -> list[InputPartition]:
            return [Range(a, min(a + self.width, self.end)) for a in range(self.start, self.end, self.width)]

        def read(self, partition: Range) -> Iterator[tuple]:
            yield from subdivided(fetch, partition.start, partition.end, cap, pause=pause)

    class Ranges(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return SCHEMA

        def reader(self, schema: StructType) -> DataSourceReader:
            o = self.options
            return Reader(int(o["start"]), int(o["end"]), int(o.get("width", "200")))

    return Ranges


def read_ranges(spark: SparkSession, fetch: Fetch, start: int, end: int, width: int = 200, cap: int = 200, pause: float = 5.0):
    source = range_source(fetch, cap=cap, pause=pause)
    spark.dataSource.register(source)
    return spark.read.format(source.name()).option("start", start).option("end", end).option("width", width).load()


def frontier(known_max: int, behind: int = 200, ahead: int = 5000) -> tuple[int, int]:
    """The range of an incremental harvest: some ids again, then new ones."""
    return max(1, known_max - behind), known_max + ahead


def extended(last_found: int | None, end: int, near: int = 200, step: int = 5000) -> int:
    """The new end if rows turned up close to it, else the old."""
    return end + step if last_found is not None and end - last_found <= near else end
