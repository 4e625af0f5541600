"""What the corpus operators share: Arrow batches in and out, words, chosen columns."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Words are what stands between these: ASCII characters that are no letter and no digit.
# A-Z become a-z; everything beyond ASCII belongs to words.
_LOWER = bytes(32 if b < 48 or 57 < b < 65 or 90 < b < 97 or 122 < b < 128 else b + 32 if 65 <= b <= 90 else b
               for b in range(256))


def words(text: str | None) -> list[bytes]:
    """Lower-cased words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` as UTF-8; null has none."""
    return text.encode().translate(_LOWER).split() if text else []


def take(df: DataFrame, **columns: str | Column) -> DataFrame:
    """Only the columns an operator needs, under its own names, so that no other column can clash."""
    return df.select(*[(df[c] if isinstance(c, str) else c).alias(name) for name, c in columns.items()])


def map_batches(df: DataFrame, work: Callable[[pa.RecordBatch], dict | Iterable[dict]], schema: T.StructType | str) -> DataFrame:
    """`work` turns one Arrow batch into one dict of columns, or into several."""
    kind = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(kind)
        for batch in batches:
            made = work(batch)
            for part in [made] if isinstance(made, dict) else made:
                yield pa.RecordBatch.from_arrays(
                    [c.cast(f.type) if isinstance(c := part[f.name], pa.Array) else pa.array(c, f.type) for f in arrow],
                    schema=arrow)

    return df.mapInArrow(run, kind)
