"""Tables whose columns may become wider with time: int, long, double, text.

Parquet files keep the types that they were written with, and no reader turns whole numbers into text. So the rows of
each set of types lie in a folder of their own, a generation. A writer whose columns are wider, or new, begins
the next one; a reader casts each generation to the widest types and unites them. There are as many
generations as there were changes, whatever the number of writes.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from gaugeline import storage
from gaugeline.sinks.tables import BATCH, Table

#: Types from narrow to wide. Whole numbers beyond 53 bits lose digits as doubles, as the order says they may.
WIDTHS = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType())


def widest(name: str, a: T.DataType, b: T.DataType) -> T.DataType:
    """The wider of two types of a column; raises if neither holds the other."""
    if a == b:
        return a
    if a not in WIDTHS or b not in WIDTHS:
        raise ValueError(f"column {name}: {a.simpleString()} and {b.simpleString()} do not widen to one type")
    return max(a, b, key=WIDTHS.index)


def merged(schemas: Sequence[T.StructType]) -> T.StructType:
    """All columns of the schemas in order of appearance, each with its widest type."""
    types: dict[str, T.DataType] = {}
    for schema in schemas:
        for column in schema.fields:
            types[column.name] = widest(column.name, types.get(column.name, column.dataType), column.dataType)
    return T.StructType([T.StructField(name, kind) for name, kind in types.items()])


@dataclass(frozen=True)
class WideningTable:
    """A parquet table below ``path`` that follows its writers' types as long as they widen."""

    path: str
    partition_by: Sequence[str] = ()
    options: Mapping[str, str] = field(default_factory=dict)

    def _generations(self, spark: SparkSession) -> list[tuple[int, T.StructType]]:
        """Number and types of each generation that has rows. A generation is one folder with a footer to look at."""
        numbers = sorted(int(name.split("=", 1)[1]) for name in storage.folders(spark, self.path) if name.startswith("generation="))
        found = []
        for number in numbers:
            parts = {*self.partition_by, BATCH}
            stored = spark.read.parquet(self._folder(number)).schema if storage.folders(spark, self._folder(number)) else T.StructType()
            found.append((number, T.StructType([f for f in stored.fields if f.name not in parts])))
        return [(number, schema) for number, schema in found if schema.fields]

    def _folder(self, number: int) -> str:
        return f"{self.path}/generation={number}"

    def schema(self, spark: SparkSession) -> T.StructType:
        """The columns of the table with their widest types, without those it is partitioned by."""
        return merged([schema for _, schema in self._generations(spark)])

    def generation_for(self, df: DataFrame) -> int:
        """The generation that takes the rows of ``df``: the last if the types are its own, else a new one. A column
        that is narrower than the table has it is refused, as is one of a type that does not widen to it."""
        spark, own = df.sparkSession, {f.name: f.dataType for f in df.schema.fields}
        generations = self._generations(spark)
        stored = merged([schema for _, schema in generations])
        merged([stored, T.StructType([f for f in df.schema.fields if f.name not in self.partition_by])])
        narrower = [f"{f.name}: {own[f.name].simpleString()} below {f.dataType.simpleString()}"
                    for f in stored.fields if f.name in own and widest(f.name, own[f.name], f.dataType) != own[f.name]]
        if narrower:
            raise ValueError(f"columns narrower than the table has them: {narrower}")
        columns = {n: t for n, t in own.items() if n not in self.partition_by}
        if generations and columns == {f.name: f.dataType for f in generations[-1][1].fields}:
            return generations[-1][0]
        return generations[-1][0] + 1 if generations else 0

    def write_stream(self, df: DataFrame, checkpoint: str, trigger: Mapping | None = None, name: str | None = None) -> StreamingQuery:
        """Append each batch. Types are compared before the query starts; it is started again to change them, with
        the same checkpoint."""
        number = self.generation_for(df)
        return Table(self._folder(number), partition_by=self.partition_by, options=self.options).write_stream_balanced(df, checkpoint, trigger, name)

    def write_batch(self, df: DataFrame, number_of_batch: int) -> None:
        """Write a batch under a number of the caller's; written again it replaces itself."""
        number = self.generation_for(df)
        Table(self._folder(number), partition_by=self.partition_by, options=self.options).write_numbered(df, number_of_batch, self.path)

    def read(self, spark: SparkSession) -> DataFrame:
        """All rows with the widest types. A column that a generation lacks is NULL in its rows."""
        generations = self._generations(spark)
        if not generations:
            raise FileNotFoundError(f"no rows below {self.path}")
        target = merged([schema for _, schema in generations])
        result = None
        for number, schema in generations:
            rows, names = spark.read.parquet(self._folder(number)), set(schema.fieldNames())
            columns = [(F.col(f"`{f.name}`") if f.name in names else F.lit(None)).cast(f.dataType).alias(f.name) for f in target.fields]
            rows = rows.select(*columns, *self.partition_by)
            result = rows if result is None else result.unionByName(rows)
        return result
