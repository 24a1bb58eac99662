"""Counting a document's tokens inside the task that holds it, so no shuffle is needed."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tablelens.plans.runtime import ship_package


class TokenGroups:
    """The distinct kept tokens of every list in a batch, with their counts and, if asked, positions."""

    def __init__(
        self, lists: pa.Array, rename: Callable[[list[str]], pa.Array] | None = None, with_positions: bool = False
    ):
        sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
        codes = lists.flatten().dictionary_encode()
        code = codes.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        kept = pc.not_equal(codes.dictionary, "").to_numpy(zero_copy_only=False)[code]
        self.terms = codes.dictionary
        if rename is not None:
            # Several tokens may share a new name; they are counted together.
            renamed = rename(codes.dictionary.to_pylist()).dictionary_encode()
            self.terms = renamed.dictionary
            code = renamed.indices.to_numpy(zero_copy_only=False).astype(np.int64)[code]
        row = np.repeat(np.arange(len(sizes)), sizes)
        self.lengths = np.bincount(row[kept], minlength=len(sizes))
        # One sortable number per token: its row, then its term.
        width = max(len(self.terms), 1)
        key = row[kept] * width + code[kept]
        if with_positions:
            order = np.argsort(key, kind="stable")
            starts_of_rows = np.repeat(np.cumsum(sizes) - sizes, sizes)
            self.positions = (np.arange(len(row)) - starts_of_rows)[kept][order]
            key = key[order]
        else:
            key = np.sort(key)
        self.starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, dtype=np.int64)
        self.counts = np.diff(np.r_[self.starts, len(key)])
        self.rows, self.codes = np.divmod(key[self.starts], width)

    def position_lists(self) -> pa.Array:
        offsets = np.r_[self.starts, len(self.positions)].astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(self.positions.astype(np.int32)))


def term_counts(
    tokens: DataFrame,
    row_id: str,
    rename: Callable[[list[str]], pa.Array] | None = None,
    term: str = "term string",
    marker=None,
) -> DataFrame:
    """``(id, length, term, tf)`` from a frame of ``(id, tokens)``, in one pass and without a shuffle.

    With a ``marker``, each non-empty document also yields one row with that term and ``tf`` 0, so
    collection statistics can be read from the same rows.  A document is never split over batches.
    """
    ship_package()
    name, kind = term.split()
    rows = tokens.select(row_id, "tokens")
    id_type = rows.schema[row_id].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # a filter in the plan would have all texts analyzed twice, and before any join
            batch = batch.filter(batch.column("tokens").is_valid())
            groups = TokenGroups(batch.column("tokens"), rename)
            which = pa.array(groups.rows)
            lengths = groups.lengths.astype(np.int32)
            terms = groups.terms.take(pa.array(groups.codes))
            out = [batch.column(row_id).take(which), pa.array(lengths[groups.rows]), terms, pa.array(groups.counts)]
            yield pa.record_batch(out, names=[row_id, "length", name, "tf"])
            if marker is not None:
                present = np.flatnonzero(lengths)
                marks = [
                    batch.column(row_id).take(pa.array(present)),
                    pa.array(lengths[present]),
                    pa.array([marker] * len(present), terms.type),
                    pa.array(np.zeros(len(present), dtype=np.int64)),
                ]
                yield pa.record_batch(marks, names=[row_id, "length", name, "tf"])

    return rows.mapInArrow(count, f"{row_id} {id_type}, length int, {name} {kind}, tf long")
