"""Token-aware chunks: consecutive items packed up to a limit, long ones split, neighbours merged.

Where a chunk ends depends on where the last one began, so this is a fold in order: one
pass over each document's items, in Arrow batches a document. Packing never crosses
heading paths.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_tokens(text: Column) -> Column:
    """Words between white space: the tokenizer where no other is given."""
    return F.regexp_count(text, F.lit(r"\S+"))


def packed(items: DataFrame, most_tokens: int, merge_peers: bool = True) -> DataFrame:
    """doc_id, seq, path, text, tokens: chunks of at most ``most_tokens`` words, headings included.

    items: doc_id, pos, path, text. A chunk's headings count; where they leave no room they
    are dropped. With ``merge_peers`` small neighbours with the same headings share a chunk.
    Documents come one after the other in Arrow batches; what is held is a batch's chunks.
    """
    kind = items.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "seq", "path", "text", "tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc, seq, last, out = None, 0, None, []  # the document in progress, its next number, its open chunk: path, pieces, tokens

        def close() -> None:
            nonlocal seq, last
            if last is not None:
                out.append((doc, seq, last[0], "\n".join(last[1]), last[2]))
                seq, last = seq + 1, None

        def made(key: pa.DataType) -> pa.RecordBatch:
            columns = zip(*out, strict=True)
            kinds = (key, pa.int64(), pa.string(), pa.string(), pa.int64())
            batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)
            out.clear()
            return batch

        key = None
        for batch in batches:
            key = batch.column(0).type
            for of, path, text in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                if of != doc:
                    close()
                    doc, seq = of, 0
                path = path or ""
                head = len(path.split()) if path else 0
                shown = head if head < most_tokens else 0
                words = (text or "").split()
                for at in range(0, len(words), most_tokens - shown):
                    piece = words[at : at + most_tokens - shown]
                    if merge_peers and last is not None and last[0] == path and last[2] + len(piece) <= most_tokens:
                        last[1].append(" ".join(piece))
                        last[2] += len(piece)
                    else:
                        close()
                        last = [path, [" ".join(piece)], len(piece) + shown]
            if out:
                yield made(key)
        close()
        if out:
            yield made(key)

    rows = items.select("doc_id", "pos", "path", "text").repartition("doc_id").sortWithinPartitions("doc_id", F.asc_nulls_last("pos"))
    return rows.select("doc_id", "path", "text").mapInArrow(run, f"doc_id {kind}, seq long, path string, text string, tokens long")


def deduplicated_boxes(boxes: DataFrame, most_iou: float = 0.9) -> DataFrame:
    """Boxes (table_id, ord, l, t, r, b) without those that nearly repeat an earlier kept one."""

    def fold(rows: pd.DataFrame) -> pd.DataFrame:
        kept: list[int] = []
        values = rows.sort_values("ord").reset_index(drop=True)
        box = values[["l", "t", "r", "b"]].to_numpy()
        for i, (left, top, right, bottom) in enumerate(box):
            again = False
            for k in kept:
                wide = min(right, box[k][2]) - max(left, box[k][0])
                tall = min(bottom, box[k][3]) - max(top, box[k][1])
                both = max(wide, 0.0) * max(tall, 0.0)
                whole = (right - left) * (bottom - top) + (box[k][2] - box[k][0]) * (box[k][3] - box[k][1]) - both
                again = again or both / (whole + 1e-6) >= most_iou
            if not again:
                kept.append(i)
        return values.iloc[kept]

    return boxes.groupBy("table_id").applyInPandas(fold, boxes.schema)
