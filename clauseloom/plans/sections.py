"""References to sections, followed to the section they mean.

A text nests: exhibits hold articles, and those hold sections, each begun by a header line.  Numbers start anew in every exhibit, so a
reference is looked up in its own exhibit, and there in the nearest section of that number.
"""

from __future__ import annotations

from bisect import bisect
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship
from .planned import SECTION_REFERENCE

SLICE_BYTES = 1_000_000  # of marks that are Python objects at a time, one document at least
OUTER = ("exhibit", "schedule", "appendix")
HEADER = r"^(?i:(section|article|schedule|exhibit|appendix)) +([0-9A-Z]+(?:\.[0-9]+)*)"


def _documents(contracts: DataFrame, header: str, reference: str) -> DataFrame:
    """contract_id and the ``marks`` of each contract: line, at, kind, number of its header lines and references."""
    def of_line(line: Column, i: Column) -> Column:
        kind = F.lower(F.regexp_extract(line, header, 1))
        head = F.struct(i.alias("line"), F.lit(0).alias("at"), kind.alias("kind"), F.regexp_extract(line, header, 2).alias("number"))
        refs = F.transform(F.regexp_extract_all(line, F.lit(reference), F.lit(1)), lambda n, j: F.struct(
            i.alias("line"), (j + 1).alias("at"), F.lit("reference").alias("kind"), n.alias("number")))
        return F.concat(F.filter(F.array(head), lambda h: h["kind"] != ""), refs)

    lines = contracts.select("contract_id", F.flatten(F.transform(F.split("clean_text", "\n"), of_line)).alias("marks"))
    return lines.groupBy("contract_id").agg(F.flatten(F.collect_list("marks")).alias("marks"))


def _placed(batches) -> Iterator[tuple]:
    """Documents a bounded slice at a time: their ids, and of each its marks in order as (line, at, kind, number, exhibit, article)."""
    for batch in batches:
        step = max(1, batch.num_rows * SLICE_BYTES // max(batch.nbytes, 1))
        for start in range(0, batch.num_rows, step):
            part = batch.slice(start, step)
            columns = [c.to_pylist() for c in part.column("marks").flatten().flatten()]
            ends = np.cumsum(pc.list_value_length(part.column("marks")).to_numpy(zero_copy_only=False)).tolist()
            documents = []
            for a, b in zip([0, *ends], ends):
                exhibit, article, placed = 0, None, []
                for line, at, kind, number in sorted(zip(*(c[a:b] for c in columns)), key=lambda m: m[:2]):
                    if kind in OUTER:
                        exhibit, article = exhibit + 1, None
                    elif kind == "article":
                        article = number
                    placed.append((line, at, kind, number, exhibit, article))
                documents.append(placed)
            yield part.column("contract_id"), documents


def _rows(ids, places: list[int], rows: list[tuple], columns: list[tuple]) -> pa.RecordBatch:
    values = [pa.array([r[i] for r in rows], kind) for i, (_, kind) in enumerate(columns)]
    return pa.RecordBatch.from_arrays([ids.take(pa.array(places, pa.int64())), *values], names=["contract_id", *[name for name, _ in columns]])


def marks(contracts: DataFrame, header: str = HEADER, reference: str = SECTION_REFERENCE) -> DataFrame:
    """contract_id, line, at, kind, number of each header line and each reference, and the ``exhibit`` and ``article`` it stands in.

    Exhibits are counted from 1; what precedes the first is 0.  An article ends with its exhibit.  Null texts hold nothing.
    """
    columns = [("line", pa.int32()), ("at", pa.int32()), ("kind", pa.string()), ("number", pa.string()), ("exhibit", pa.int64()), ("article", pa.string())]

    def place(batches):
        for ids, documents in _placed(batches):
            yield _rows(ids, [d for d, placed in enumerate(documents) for _ in placed], [m for placed in documents for m in placed], columns)

    ship(contracts.sparkSession)
    kind = f"contract_id {dict(contracts.dtypes)['contract_id']}, line int, at int, kind string, number string, exhibit long, article string"
    return _documents(contracts, header, reference).mapInArrow(place, kind)


def _resolved(placed: list[tuple]) -> Iterator[tuple]:
    """ref_no, target, exhibit, section_line, article of the references among the marks of one document."""
    sections = defaultdict(list)
    for i, (line, _, kind, number, exhibit, article) in enumerate(placed):
        if kind == "section":
            sections[exhibit, number].append((i, line, article))
    ref_no = 0
    for i, (line, _, kind, number, exhibit, _) in enumerate(placed):
        if kind == "reference":
            same = sections.get((exhibit, number), [])
            k = bisect(same, i, key=lambda s: s[0])
            before, behind = (same[k - 1] if k else None), (same[k] if k < len(same) else None)
            closer = behind and (not before or behind[1] - line < line - before[1])
            meant = behind if closer else before or (None, None, None)
            yield ref_no, number, exhibit, meant[1], meant[2]
            ref_no += 1


def resolved_refs(contracts: DataFrame, header: str = HEADER, reference: str = SECTION_REFERENCE) -> DataFrame:
    """One row per reference: contract_id, ref_no, target, exhibit, and the header line and article of the section it leads to.

    Of several sections of that number in the exhibit it is the nearest by lines, the earlier of two; without one it is null.  Sections
    and references of one text never multiply: each reference looks up the nearest before and behind.  A text is resolved by itself, so a
    task holds a bounded slice of its texts.
    """
    columns = [("ref_no", pa.int32()), ("target", pa.string()), ("exhibit", pa.int64()), ("section_line", pa.int32()), ("article", pa.string())]

    def resolve(batches):
        for ids, documents in _placed(batches):
            found = [list(_resolved(placed)) for placed in documents]
            yield _rows(ids, [d for d, refs in enumerate(found) for _ in refs], [r for refs in found for r in refs], columns)

    ship(contracts.sparkSession)
    kind = f"contract_id {dict(contracts.dtypes)['contract_id']}, ref_no int, target string, exhibit long, section_line int, article string"
    return _documents(contracts, header, reference).mapInArrow(resolve, kind)
