"""User map-reduce on DataFrames (the reference's programming model).

``mapper(key, value) -> iterable[(k, v)]`` runs over Arrow batches; with
``batch_size`` it gets lists of up to so many values, as one call of the reference's
mapper does, whatever the Arrow batches are.  An optional ``combiner(k, values) ->
iterable[(k, v)]`` runs before the shuffle on what a batch has mapped, so a hot key
ships at most one value per batch.

One shuffle brings a key's values together, sorted, so ``reducer(k, values) ->
iterable[row]`` gets an iterator over a run of rows: a key's values never become one
list, however many there are, and a reducer may stop early.  With ``sort_values``
they come in ascending order (nulls first).  Where the combiner may also reduce
partial results (it is associative), ``salts`` deals every key to so many tasks
first, and only their results meet in one.

Keys must be string, long or double: this is checked when the plan is built, not at
run time.  A null key is a key; NaN is one key.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tessera.sources.parallel import spread

_KEY_TYPES = (T.StringType, T.LongType, T.DoubleType)
#: rows that are Python objects at a time, and rows of an output batch
ROWS = 1_024


def check_key_type(dt: T.DataType) -> None:
    if not isinstance(dt, _KEY_TYPES):
        raise TypeError(f"map-reduce keys must be string, long or double, got {dt.simpleString()}")


def _objects(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows of batches as Python values, a few at a time."""
    for b in batches:
        for s in range(0, b.num_rows, ROWS):
            yield from zip(*(c.to_pylist() for c in b.slice(s, ROWS).columns))


def _batches(rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    rows = iter(rows)
    while part := list(itertools.islice(rows, ROWS)):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part), schema)], schema=schema)


def _nan(k):
    return math.nan if isinstance(k, float) and math.isnan(k) else k


def _runs(rows: Iterable[tuple]) -> Iterator[tuple[object, Iterator]]:
    """(key, iterator over its values) of rows ``k, v`` in which equal keys are neighbours."""
    for k, run in itertools.groupby(rows, key=lambda r: _nan(r[0])):
        yield k, (v for _, v in run)


def _combined(pairs: Iterable[tuple], combiner: Callable) -> Iterator[tuple]:
    by: dict = {}
    for k, v in pairs:
        by.setdefault(_nan(k), []).append(v)
    for k, vs in by.items():
        yield from combiner(k, iter(vs))


def map_reduce(df: DataFrame, mapper: Callable, reducer: Callable, key_type: T.DataType,
               value_type: T.DataType, out_schema: T.StructType | str,
               combiner: Callable | None = None, value_col: str = "value", batch_size: int | None = None,
               sort_values: bool = False, salts: int = 0) -> DataFrame:
    """The rows that ``reducer`` gives for the pairs that ``mapper`` makes of ``value_col``."""
    check_key_type(key_type)
    if salts and combiner is None:
        raise ValueError("salted keys need a combiner that reduces partial results")
    pair = T.StructType([T.StructField("k", key_type), T.StructField("v", value_type)])
    out = out_schema if isinstance(out_schema, T.StructType) else T._parse_datatype_string(out_schema)
    pairs, result = to_arrow_schema(pair), to_arrow_schema(out)

    def _map(batches):
        if batch_size is None:
            for b in batches:
                for s in range(0, b.num_rows, ROWS):
                    made = itertools.chain.from_iterable(mapper(None, v) for v in b.column(0).slice(s, ROWS).to_pylist())
                    yield from _batches(_combined(made, combiner) if combiner else made, pairs)
            return
        values = (v for v, in _objects(batches))
        while part := list(itertools.islice(values, batch_size)):
            made = mapper(None, part)
            yield from _batches(_combined(made, combiner) if combiner else made, pairs)

    def _combine(batches):
        yield from _batches(itertools.chain.from_iterable(combiner(k, vs) for k, vs in _runs(_objects(batches))), pairs)

    def _reduce(batches):
        yield from _batches(itertools.chain.from_iterable(reducer(k, vs) for k, vs in _runs(_objects(batches))), result)

    order = ["k", F.col("v").asc_nulls_first()] if sort_values else ["k"]
    mapped = spread(df.select(value_col)).mapInArrow(_map, pair)
    if salts:
        # a task's pairs of one key stay together, so the same input is dealt the same way
        dealt = mapped.withColumn("salt", F.spark_partition_id() % salts)
        mapped = dealt.repartition("k", "salt").sortWithinPartitions(*order).select("k", "v").mapInArrow(_combine, pair)
    return mapped.repartition("k").sortWithinPartitions(*order).mapInArrow(_reduce, out)
