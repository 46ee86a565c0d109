"""Row-wise Arrow mapping: the key column passes through, one text column becomes several result columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

#: (name, Spark type, Arrow type) of a result column.
Field = tuple[str, str, pa.DataType]


#: Characters of text that are worked on at a time.
CHUNK = 1 << 20
#: Rows of text that Spark hands to Python at a time; its default of 10,000 takes much memory where texts are long.
ROWS = 1000
ROWS_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def map_batches(rows: DataFrame, run: Callable, schema) -> DataFrame:
    """``mapInArrow`` with batches of at most ``ROWS`` rows; the session's setting is lowered if it is higher."""
    conf = rows.sparkSession.conf
    if int(conf.get(ROWS_SETTING)) > ROWS:
        conf.set(ROWS_SETTING, str(ROWS))
    return rows.mapInArrow(run, schema)


def chunks(column: pa.Array, size: int = CHUNK) -> Iterator[list[str]]:
    """The texts of a batch as Python strings (null as empty), about ``size`` characters at a time."""
    held, chars = [], 0
    for x in column:
        held.append(x.as_py() or "")
        chars += len(held[-1])
        if chars >= size:
            yield held
            held, chars = [], 0
    if held:
        yield held


def map_text(docs: DataFrame, key: str, text: str, fields: list[Field], make: Callable[[], Callable[[str], tuple]]) -> DataFrame:
    """``make()`` is called once a task and gives the function from a text (null as empty) to a tuple of results."""
    def many():
        work = make()
        return lambda texts: [work(t) for t in texts]

    return map_texts(docs, key, text, fields, many)


def map_texts(docs: DataFrame, key: str, text: str, fields: list[Field], make: Callable[[], Callable[[list[str]], list[tuple]]]) -> DataFrame:
    """The same for functions that take some texts at once. Only the key and the text are read."""
    rows = docs.select(key, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            found = [row for texts in chunks(batch.column(1)) for row in work(texts)]
            columns = [pa.array([f[i] for f in found], kind) for i, (_, _, kind) in enumerate(fields)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=[key, *(n for n, _, _ in fields)])

    kind = rows.schema[key].dataType.simpleString()
    return map_batches(rows, run, ", ".join([f"`{key}` {kind}", *(f"`{n}` {t}" for n, t, _ in fields)]))
