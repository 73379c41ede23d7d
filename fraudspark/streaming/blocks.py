"""Rows in blocks through keyed state of a stream.

Spark hands each row to a stateful Python processor by itself, cell by cell, and takes it back the
same way. Here rows are cut into blocks first. The wide columns of a block stay together as one Arrow
value that nothing looks into. The few columns that the state needs go to its groups, all rows of a
block and group as one Arrow value; the answers come back likewise and are put beside the wide columns.
So a group with very many rows costs a processor little more than a sort of its narrow columns.
Where several processors follow each other, the wide columns stay packed from the first to the last.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StatefulProcessor

GROUP, BLOCK, KIND, BODY, AT = "_key", "_block", "_kind", "_body", "_at"
_WIDE, _NARROW, _ANSWERS = 0, 1, 2
_BLOCK_ROWS, _BLOCK_BYTES = 65_536, 8 << 20
_ANSWERED = T.StructType().add(BLOCK, "string").add(KIND, "integer").add(BODY, "binary")
_PACKED = f"{GROUP} string, {BLOCK} string, {KIND} int, {BODY} binary"


def written(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def read(body: bytes) -> pa.Table:
    return pa.ipc.open_stream(body).read_all()


class BlockProcessor(StatefulProcessor):
    """Answers a group's rows of one micro-batch at once.

    ``narrow`` are the columns it is given, ``made`` those that it answers, in the same order of rows.
    """

    def __init__(self, narrow: T.StructType, made: T.StructType):
        at = T.StructField(AT, T.IntegerType())
        self.narrow, self.made = T.StructType([*narrow.fields, at]), T.StructType([at, *made.fields])

    def answers(self, rows: pa.Table, keyed: bool, timer_values) -> dict[str, pa.Array]:
        raise NotImplementedError

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        keyed, schema = key[0][:1] == "=", to_arrow_schema(self.narrow)
        names, parts = [], []
        for row in rows:
            if row[KIND] == _WIDE:
                yield Row(**{BLOCK: row[BLOCK], KIND: _WIDE, BODY: row[BODY]})
            else:
                names.append(row[BLOCK])
                parts.append(pa.ipc.read_record_batch(pa.py_buffer(bytes(row[BODY])), schema))
        if not parts:
            return
        table = pa.Table.from_batches(parts).combine_chunks()
        made = self.answers(table, keyed, timerValues)
        columns = [table[AT].combine_chunks(), *[made[f.name] for f in self.made.fields[1:]]]
        arrow = to_arrow_schema(self.made)
        done = pa.RecordBatch.from_arrays([_flat(c).cast(f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)
        start = 0
        for name, part in zip(names, parts, strict=True):
            own = done.slice(start, part.num_rows)
            yield Row(**{BLOCK: name, KIND: _ANSWERS, BODY: own.serialize().to_pybytes()})
            start += part.num_rows

    def close(self) -> None:
        pass


def _flat(column) -> pa.Array:
    if not isinstance(column, pa.ChunkedArray):
        return column
    return column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)


def runs(column: pa.Array) -> tuple[np.ndarray, np.ndarray, list]:
    """A stable order that brings equal values together, where their runs begin, and the values."""
    encoded = _flat(column).dictionary_encode(null_encoding="encode")
    codes = encoded.indices.to_numpy(zero_copy_only=False)
    order = np.argsort(codes, kind="stable")
    sorted_codes = codes[order]
    starts = np.flatnonzero(np.append(True, sorted_codes[1:] != sorted_codes[:-1])) if len(codes) else np.array([], int)
    return order, starts, [encoded.dictionary[int(c)].as_py() for c in sorted_codes[starts]]


@dataclass(frozen=True)
class Pass:
    """Rows of one ``group``, which begins with ``=``, meet the state of ``processor``; those without are answered without any.

    Each narrow column is a column of the rows, or of what earlier passes made, or is made of a block of them.
    """

    processor: BlockProcessor
    group: str
    narrow: dict[str, str | Callable[[pa.Table], pa.Array]]

    def columns(self) -> set[str]:
        return {self.group, *[c for c in self.narrow.values() if isinstance(c, str)]}


def through_blocks(rows: DataFrame, processor: BlockProcessor, time_mode: str) -> DataFrame:
    """``rows`` without its narrow columns and ``_key``, with what ``processor`` makes of them.

    Rows of one ``_key``, which begins with ``=``, meet its state; those whose key is null are answered without any.
    """
    names = processor.narrow.fieldNames()[:-1]
    return through_passes(rows, [Pass(processor, GROUP, {n: n for n in names})], time_mode, {GROUP, *names})


def through_passes(rows: DataFrame, passes: list[Pass], time_mode: str, without: set[str]) -> DataFrame:
    """``rows`` but the columns ``without``, with what the processors make of them, one after the other."""
    made = [T.StructType(p.processor.made.fields[1:]) for p in passes]
    # The wide columns of each pass: what comes out in the end or is needed later.
    fields, wide = list(rows.schema.fields), []
    for k, of_pass in enumerate(made):
        needed = set().union(*[p.columns() for p in passes[k + 1 :]])
        wide.append([f.name for f in fields if f.name not in without or f.name in needed])
        fields += of_pass.fields
    out = T.StructType([f for f in fields if f.name not in without])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition, number, held, n, size = TaskContext.get().partitionId(), 0, [], 0, 0
        for batch in batches:
            for start in range(0, batch.num_rows, _BLOCK_ROWS):
                part = batch.slice(start, _BLOCK_ROWS)
                held.append(part)
                n, size = n + part.num_rows, size + part.nbytes
                if n >= _BLOCK_ROWS or size >= _BLOCK_BYTES:
                    yield from cut(pa.Table.from_batches(held), 0, f"{partition}-{number}")
                    number, held, n, size = number + 1, [], 0, 0
        if n:
            yield from cut(pa.Table.from_batches(held), 0, f"{partition}-{number}")

    def cut(table: pa.Table, k: int, name: str) -> Iterator[pa.RecordBatch]:
        body, of_pass = written(table.select(wide[k])), passes[k]
        # Blocks have the same names and contents if a task runs again over the same rows.
        block = name if k else f"{name}-{hashlib.sha256(body).hexdigest()[:16]}"
        own = f"-{block}"
        columns = [_flat(table[c] if isinstance(c, str) else c(table)) for c in of_pass.narrow.values()]
        columns.append(pa.array(np.arange(table.num_rows, dtype=np.int32)))
        schema = to_arrow_schema(of_pass.processor.narrow)
        few = pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
        order, starts, groups = runs(table[of_pass.group])
        few = few.take(pa.array(order))
        ends = [*starts[1:].tolist(), table.num_rows]
        bodies = [few.slice(a, b - a).serialize().to_pybytes() for a, b in zip(starts.tolist(), ends, strict=True)]
        yield packed([own], block, _WIDE, [body])
        yield packed([own if g is None else g for g in groups], block, _NARROW, bodies)

    def packed(groups: list[str], block: str, kind: int, bodies: list[bytes]) -> pa.RecordBatch:
        n = len(groups)
        return pa.RecordBatch.from_pydict(
            {GROUP: groups, BLOCK: [block] * n, KIND: pa.array([kind] * n, pa.int32()), BODY: pa.array(bodies, pa.binary())}
        )

    def whole(table: pa.Table, k: int) -> pa.Table:
        """The wide columns of a block with the answers of a pass."""
        kinds, bodies = table[KIND].to_pylist(), table[BODY]
        rows = read(bodies[kinds.index(_WIDE)].as_py())
        arrow = to_arrow_schema(passes[k].processor.made)
        parts = [
            pa.ipc.read_record_batch(pa.py_buffer(b.as_py()), arrow) for b, kind in zip(bodies, kinds, strict=True) if kind == _ANSWERS
        ]
        answers = pa.Table.from_batches(parts, arrow).combine_chunks()
        answers = answers.take(pa.array(np.argsort(answers[AT].to_numpy(), kind="stable")))
        if answers.num_rows != rows.num_rows:
            raise RuntimeError(f"a block of {rows.num_rows} rows has {answers.num_rows} answers")
        for f in made[k].fields:
            rows = rows.append_column(f.name, answers[f.name])
        return rows

    def again(k: int) -> Callable[[pa.Table], pa.Table]:
        return lambda table: pa.Table.from_batches(cut(whole(table, k), k + 1, table[BLOCK][0].as_py()))

    def unpack(table: pa.Table) -> pa.Table:
        return whole(table, len(passes) - 1).select(out.fieldNames())

    cuts = rows.mapInArrow(pack, _PACKED)
    for k, of_pass in enumerate(passes):
        blocks = cuts.groupBy(GROUP).transformWithState(
            statefulProcessor=of_pass.processor,
            outputStructType=_ANSWERED,
            outputMode="Append",
            timeMode=time_mode,
        ).groupBy(BLOCK)
        cuts = blocks.applyInArrow(unpack, out) if of_pass is passes[-1] else blocks.applyInArrow(again(k), _PACKED)
    return cuts
