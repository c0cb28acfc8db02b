"""Functions of the user over rows, columns and batches.

``*_columns`` hand whole Arrow arrays to a function, in one call for some thousand rows; ``*_rows`` call it for each row with
a dict. Nothing is shuffled for either. ``map_batches`` hands over whole batches, in their shuffled order.

Rows with a null in a column that is read are not given to the function, and get null results (a filter drops them), unless
``nulls="give"``. An error of the function names the row: its key and value. Names, types and numbers of results are checked
against the schema. An empty table calls nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import and_

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type

from corpusloom.functions.ordering import as_keys
from corpusloom.operators.ranking import with_rank
from corpusloom.operators.sequences import BATCH_SIZE
from corpusloom.operators.splits import SEED

ColumnFunction = Callable[..., "pa.Array | Mapping[str, pa.Array]"]
RowFunction = Callable[[dict], "Mapping[str, object] | bool"]
BatchFunction = Callable[[pa.Table], pa.Table]

SKIP, GIVE = "skip", "give"


def _schema(schema: str | T.StructType) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def _named(function: Callable) -> str:
    return getattr(function, "__name__", type(function).__name__)


def _typed(values: object, kind: pa.DataType, rows: int, what: str) -> pa.Array:
    """Results as the declared type; a value that would not stay the same is an error."""
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if not isinstance(values, pa.Array):
        raise TypeError(f"{what} is no Arrow array")
    if len(values) != rows:
        raise ValueError(f"{what} has {len(values)} values for {rows} rows")
    try:
        return values.cast(kind)
    except pa.ArrowInvalid as error:
        raise TypeError(f"{what} is {values.type}, not {kind}: {error}") from error
    except pa.ArrowNotImplementedError as error:
        raise TypeError(f"{what} is {values.type}, not {kind}") from error


def _checked_names(found: Sequence[str], schema: T.StructType, what: str) -> None:
    if sorted(found) != sorted(schema.names):
        raise ValueError(f"{what} gave {sorted(found)}, not {sorted(schema.names)}")


def _filled(function: Callable[[list[pa.Array]], list[pa.Array]], given: pa.Array, arrays: Sequence[pa.Array]) -> list[pa.Array]:
    """The function's results in the place of the rows it was given, null in others."""
    if pc.all(given).as_py():
        return function(list(arrays))
    places = pc.subtract(pc.cumulative_sum(pc.cast(given, "int64")), 1)
    some = function([pc.filter(a, given) for a in arrays])
    return [pc.take(a, pc.if_else(given, places, pa.scalar(None, "int64"))) for a in some]


def _results(function: Callable[[list[pa.Array]], list[pa.Array]], columns: Sequence[str], keys: Sequence[str], schema: T.StructType, nulls: str) -> Column:
    """A struct column of the function's results; it gets the named columns and then the key, which may be null."""
    _check_nulls(nulls)
    if not columns:
        raise ValueError("name the columns that the function reads")
    kinds = [to_arrow_type(f.dataType) for f in schema.fields]

    def run(*arrays):
        if not len(arrays[0]):
            return pa.StructArray.from_arrays([pa.array([], k) for k in kinds], schema.names)
        return pa.StructArray.from_arrays(_filled(function, arrays[0], arrays[1:]), schema.names)

    # Where annotations are strings, as here, Spark would not know what they mean.
    run.__annotations__ = {"arrays": pa.Array, "return": pa.Array}
    given = reduce(and_, [F.col(f"`{c}`").isNotNull() for c in columns]) if nulls == SKIP else F.lit(True)
    return F.arrow_udf(run, schema)(given, *[F.col(f"`{c}`") for c in [*columns, *keys]])


def _check_nulls(nulls: str) -> None:
    if nulls not in (SKIP, GIVE):
        raise ValueError("nulls is 'skip' or 'give'")


def _by_column(function: ColumnFunction, schema: T.StructType) -> Callable[[list[pa.Array]], list[pa.Array]]:
    name, kinds = _named(function), [to_arrow_type(f.dataType) for f in schema.fields]

    def run(arrays: list[pa.Array]) -> list[pa.Array]:
        found = function(*arrays)
        if not isinstance(found, Mapping):
            found = {schema.names[0]: found}
        _checked_names(list(found), schema, name)
        return [_typed(found[n], k, len(arrays[0]), f"{n} of {name}") for n, k in zip(schema.names, kinds, strict=True)]

    return run


def _by_row(function: RowFunction, columns: Sequence[str], keys: Sequence[str], schema: T.StructType, single: bool) -> Callable:
    """Calls for each row; the last arrays hold the key, which only errors read."""
    name, kinds = _named(function), [to_arrow_type(f.dataType) for f in schema.fields]

    def run(arrays: list[pa.Array]) -> list[pa.Array]:
        read = [a.to_pylist() for a in arrays[: len(columns)]]
        out: list[list[object]] = [[] for _ in kinds]
        for i, values in enumerate(zip(*read, strict=True)):
            try:
                found = function(dict(zip(columns, values, strict=True)))
                if single:
                    found = {schema.names[0]: found}
                _checked_names(list(found), schema, name)
                for column, n, kind in zip(out, schema.names, kinds, strict=True):
                    column.append(pa.scalar(found[n], kind).as_py())
            except Exception as error:
                at = ", ".join(f"{k}={a[i].as_py()!r}" for k, a in zip(keys, arrays[len(columns) :], strict=True))
                raise RuntimeError(f"{name} failed for {at}: {type(error).__name__}: {error}") from error
        return [pa.array(column, kind) for column, kind in zip(out, kinds, strict=True)]

    return run


def _with_results(df: DataFrame, results: Column, schema: T.StructType) -> DataFrame:
    """All columns, those of the schema new or replaced."""
    kept = [F.col(f"`{c}`") for c in df.columns if c not in schema.names]
    made = df.select(*[F.col(f"`{c}`") for c in df.columns], results.alias("_results"))
    return made.select(*kept, *[F.col("_results")[n].alias(n) for n in schema.names])


def map_columns(df: DataFrame, function: ColumnFunction, columns: Sequence[str], schema: str | T.StructType, nulls: str = SKIP) -> DataFrame:
    """All columns, and those that ``function(*arrays)`` gives: an array, or a mapping of names to arrays of as many values."""
    schema = _schema(schema)
    return _with_results(df, _results(_by_column(function, schema), columns, [], schema, nulls), schema)


def filter_columns(df: DataFrame, function: ColumnFunction, columns: Sequence[str], nulls: str = SKIP) -> DataFrame:
    """Rows for which ``function(*arrays)`` gives true; null and false go."""
    schema = _schema("keep boolean")
    return df.where(_results(_by_column(function, schema), columns, [], schema, nulls)["keep"])


def map_rows(
    df: DataFrame, function: RowFunction, columns: Sequence[str], schema: str | T.StructType, key: str | Sequence[str], nulls: str = SKIP
) -> DataFrame:
    """All columns, and those of the dict that ``function(row)`` gives for each row, of which it sees ``columns``."""
    schema = _schema(schema)
    keys = as_keys(key)
    return _with_results(df, _results(_by_row(function, columns, keys, schema, single=False), columns, keys, schema, nulls), schema)


def filter_rows(df: DataFrame, function: RowFunction, columns: Sequence[str], key: str | Sequence[str], nulls: str = SKIP) -> DataFrame:
    """Rows for which ``function(row)`` is true; null and false go."""
    schema = _schema("keep boolean")
    keys = as_keys(key)
    return df.where(_results(_by_row(function, columns, keys, schema, single=True), columns, keys, schema, nulls)["keep"])


def map_batches(
    df: DataFrame,
    function: BatchFunction,
    key: str | Sequence[str],
    schema: str | T.StructType,
    batch_size: int = BATCH_SIZE,
    epoch: int = 0,
    seed: object = SEED,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Rows ``(split, batch_id, ...)`` that ``function`` makes of each whole batch, a table in shuffled order.

    Batches are those of :func:`corpusloom.operators.sequences.padded_batches`: one of them is never dealt to two tasks, and a
    task holds one at a time. ``columns`` names those the function sees, by default all but ``split``. It may give any number
    of rows, with the columns of ``schema``; an error names split and batch. A null split is a split like any other.
    """
    schema, keys = _schema(schema), as_keys(key)
    seen = [c for c in df.columns if c != "split"] if columns is None else list(columns)
    rows = df.select("split", *dict.fromkeys([*keys, *seen]))
    ranked = with_rank(rows, key, [seed, epoch], by=["split"])
    ranked = ranked.select("split", F.floor((F.col("rank") - 1) / batch_size).alias("batch_id"), "rank", *seen)
    whole = T.StructType([ranked.schema["split"], T.StructField("batch_id", T.LongType()), *schema.fields])
    arrow = to_arrow_schema(whole)
    name = _named(function)

    def run(group: tuple, table: pa.Table) -> pa.Table:
        split, batch_id = (g.as_py() for g in group)
        table = table.sort_by("rank").select(seen)
        try:
            found = function(table)
            _checked_names(found.column_names, schema, name)
            made = [_typed(found.column(f.name), f.type, found.num_rows, f"{f.name} of {name}") for f in list(arrow)[2:]]
        except Exception as error:
            raise RuntimeError(f"{name} failed for batch {batch_id} of split {split!r}: {type(error).__name__}: {error}") from error
        fixed = [pa.repeat(pa.scalar(v, f.type), found.num_rows) for v, f in zip((split, batch_id), list(arrow)[:2], strict=True)]
        return pa.Table.from_arrays([*fixed, *made], schema=arrow)

    return ranked.groupBy("split", "batch_id").applyInArrow(run, whole)
