"""Contracted sources (§2.1 S1-S3, S8).

A contract is an explicit ``StructType``: the schema is declared, never
inferred, so a scan over terabytes of CSV costs no inference pass.
Validation works on column names only (metadata, no job).
"""

from __future__ import annotations

import csv
import io
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DateType, DoubleType, IntegerType, LongType, StringType,
                               StructField, StructType)

from starlift import functions as SF


@dataclass(frozen=True)
class Contract:
    name: str
    schema: StructType

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.schema.fields]


def validate_columns(columns: list[str], contract: Contract) -> None:
    """Raise if expected columns are missing (listed sorted); extra columns are allowed."""
    missing = sorted(set(contract.columns) - set(columns))
    if missing:
        raise ValueError(f"{contract.name}: missing expected columns: {missing}")


def project_to_contract(df: DataFrame, contract: Contract) -> DataFrame:
    """S2 + S3: validate, then keep the contracted columns in contract order.

    The projection is pushed into the scan by Catalyst (ReadSchema lists only these columns).
    """
    validate_columns(df.columns, contract)
    return df.select(*[F.col(f"`{c}`") for c in contract.columns])


def _numbered_lines(batches):
    """Lines of whole file splits, in order, with what depends on their split alone.

    ``line``: place in the split; ``before``: quotes before the line in its split, modulo 2; ``even`` / ``odd``: how many lines up to and with
    this one start a record if the split itself starts outside / inside quotes; ``own``: the line's own quotes, modulo 2.
    """
    now, line, quotes, starts = None, 0, 0, [0, 0]
    for b in batches:
        if not b.num_rows:
            continue
        file, block = b.column("file").to_pylist(), b.column("block").to_pylist()
        own = pc.count_substring(b.column("value"), '"').to_numpy(zero_copy_only=False).astype(np.int64)
        cuts = [0] + [i for i in range(1, len(file)) if block[i] != block[i - 1] or file[i] != file[i - 1]] + [len(file)]
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            if (file[lo], block[lo]) != now:
                now, line, quotes, starts = (file[lo], block[lo]), 0, 0, [0, 0]
            before = (quotes + np.concatenate([[0], np.cumsum(own[lo:hi])[:-1]])) % 2
            even, odd = starts[0] + np.cumsum(before == 0), starts[1] + np.cumsum(before == 1)
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c).slice(lo, hi - lo) for c in ("file", "block", "value")], pa.array(line + np.arange(hi - lo)), pa.array(before), pa.array(even), pa.array(odd),
                 pa.array(own[lo:hi] % 2)], names=["file", "block", "value", "line", "before", "even", "odd", "own"])
            line, quotes, starts = line + hi - lo, quotes + int(own[lo:hi].sum()), [int(even[-1]), int(odd[-1])]


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(position, header, record): the records of quoted CSV files, read by all task slots; ``header`` marks a file's first one.

    ``position`` (file, block, pos) orders the records as the files hold them.

    A line break belongs to a record when the number of quotes before it in the file is odd. Every split of the text scan
    counts its quotes; the running sum of the splits' counts (one row per split) says whether a split starts inside
    quotes, and so where its records start. A record of one line stays where it is; only the lines of records that span
    lines are grouped, by file, split and number of the record they belong to. Breaks inside quotes become ``\\n``.
    """
    text = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    lines = text.mapInArrow(_numbered_lines, "file string, block long, value string, line long, before long, even long, odd long, own long")
    splits = lines.groupBy("file", "block").agg(F.sum("own").alias("quotes"), F.max("even").alias("even"), F.max("odd").alias("odd"))
    order = Window.partitionBy("file").orderBy("block")   # one row per split
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("file", "block", "even", "odd", F.pmod(F.coalesce(F.sum("quotes").over(before), F.lit(0)), F.lit(2)).alias("inside"))
    splits = splits.withColumn("starts", F.when(F.col("inside") == 0, F.col("even")).otherwise(F.col("odd")))
    last = F.last(F.when(F.col("starts") > 0, F.struct("block", "starts")), ignorenulls=True).over(before)
    splits = splits.select("file", F.col("block").alias("at"), "inside", last.alias("open"))
    met = lines.join(splits.withColumnRenamed("file", "f"), (F.col("file") == F.col("f")) & (F.col("block") == F.col("at")))
    number = F.when(F.col("inside") == 0, F.col("even")).otherwise(F.col("odd"))
    begins = F.col("before") == F.col("inside")
    # lines before the first start of a split belong to the record that is open
    met = met.select("file", "block", "line", "value", (begins & (F.col("own") == 0)).alias("whole"), F.when(number > 0, F.col("block")).otherwise(F.col("open.block")).alias("split"),
                     F.when(number > 0, number).otherwise(F.col("open.starts")).alias("number"))
    first = ((F.col("split") == 0) & (F.col("number") == 1)).alias("header")
    position = F.struct("file", F.col("split").alias("block"), F.col("number").alias("pos")).alias("position")
    one = met.where("whole").select(position, first, F.col("value").alias("record"))
    cell = F.struct("block", "line", "value")
    many = met.where("not whole").groupBy("file", "split", "number").agg(F.array_join(F.sort_array(F.collect_list(cell)).getField("value"), "\n").alias("record"))
    return one.unionByName(many.select(position, first, "record"))


_QUOTED = {"quote": '"', "escape": '"', "mode": "PERMISSIVE"}


def read_csv(spark: SparkSession, path: str, contract: Contract, position: str | None = None) -> DataFrame:
    """Header CSV with quoted fields and embedded newlines, read with the contract's types by all task slots.

    The header of every file is validated against the contract; files may have the columns in different orders. Data is parsed with
    typed columns through ``try_cast`` so one bad value becomes NULL instead of
    failing the whole job, and the pandas null tokens become NULL (§7.3 X1).
    ``position`` names a column for the records' place: (file, block, pos).
    """
    records = csv_records(spark, path)
    # one row per distinct header line
    heads = [r["record"] for r in records.where("header").select(F.regexp_replace("record", "^\\uFEFF", "").alias("record")).distinct().collect()]
    if not heads:
        validate_columns([], contract)
    out = None
    for head in heads:
        names = next(csv.reader(io.StringIO(head)))
        validate_columns(names, contract)
        own = records.where(~F.col("header") & (F.trim("record") != ""))
        if len(heads) > 1:
            files = records.where(F.col("header") & (F.regexp_replace("record", "^\\uFEFF", "") == head)).select(F.col("position.file").alias("__file"))
            own = own.join(files, F.col("position.file") == F.col("__file"), "left_semi")
        row = own.select(F.from_csv("record", ", ".join(f"c{i} string" for i in range(len(names))), _QUOTED).alias("r"), "position")
        cols = [] if position is None else [F.col("position").alias(position)]
        for f in contract.schema.fields:
            s = SF.null_tokens_to_null(F.col(f"r.c{names.index(f.name)}"))
            cols.append((s if f.dataType.typeName() == "string" else s.try_cast(f.dataType)).alias(f.name))
        part = row.select(*cols[1:], cols[0]) if position else row.select(*cols)
        out = part if out is None else out.unionByName(part)
    return out


def read_optional(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet") -> DataFrame:
    """A missing optional table reads as an empty table with the right columns."""
    try:
        return spark.read.format(fmt).schema(schema).load(path)
    except Exception as exc:  # AnalysisException: path does not exist
        if "PATH_NOT_FOUND" in str(exc) or "does not exist" in str(exc):
            return spark.createDataFrame([], schema)
        raise


_TYPES = {"string": StringType(), "bigint": LongType(), "int": IntegerType(), "double": DoubleType(),
          "date": DateType(), "boolean": BooleanType()}


def schema_of(spec: str) -> StructType:
    """``"a bigint, b string"`` -> StructType, without a running JVM (contracts are module constants)."""
    fields = []
    for part in spec.split(","):
        name, typ = part.strip().rsplit(" ", 1)
        fields.append(StructField(name.strip(), _TYPES[typ.strip()], True))
    return StructType(fields)


CUSTOMER_CONTRACT = Contract("customer", schema_of(
    "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"))

__all__ = ["Contract", "validate_columns", "project_to_contract", "read_csv", "read_optional",
           "schema_of", "CUSTOMER_CONTRACT"]
