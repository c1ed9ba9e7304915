"""Files with declared schemas: CSV as strings, JSON envelopes of positional rows, and their sinks."""

from __future__ import annotations

import gzip
import json
import os
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import positional


def read_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """All columns as text, so codes keep their zeros; broken bytes are replaced, columns that the file lacks are null."""
    df = spark.read.option("header", True).option("inferSchema", False).option("encoding", "UTF-8").option("mode", "PERMISSIVE").csv(path)
    return df.select(*[F.col(f"`{c}`") if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns])


def read_envelope(spark: SparkSession, path: str, header: str, rows: str, schema: str) -> DataFrame:
    """One JSON object with a header array and an array of positional rows (.gz too), as a typed table."""
    raw = spark.read.schema(f"`{header}` array<string>, `{rows}` array<array<string>>").json(path, multiLine=True)
    names = raw.select(header).first()
    names = (names[0] if names else None) or []
    return positional(raw.select(F.explode(rows).alias("r")), "r", names, schema)


def _positional_row(df: DataFrame) -> Column:
    """The row as a JSON array."""
    cells = F.array(*[F.to_json(F.struct(F.col(c).alias("v")), {"ignoreNullFields": "false"}) for c in df.columns])
    return F.concat(F.lit("["), F.array_join(F.transform(cells, lambda x: F.substring(x, F.lit(6), F.length(x) - 6)), ","), F.lit("]"))


def write_envelope(df: DataFrame, path: str, header: str, rows: str, order: list, extra: dict | None = None) -> None:
    """The table as one JSON file of a header and positional rows, in order. Ranges of the order are sorted and written
    as parts, each by its own task; the file is the parts' bytes one after the other, copied as a stream, and takes its
    place by a rename. So no task and no memory holds the table. path may be in any store that Spark writes to."""
    spark = df.sparkSession
    ordered = [o if isinstance(o, Column) else F.col(o) for o in order]
    parts, unfinished = f"{path}._parts", f"{path}._unfinished"
    # Each line begins with the comma that parts it from the one before; the first one's is left out.
    lined = df.repartitionByRange(*ordered).sortWithinPartitions(*ordered).select(F.concat(F.lit(","), _positional_row(df)).alias("value"))
    lined.write.mode("overwrite").text(parts)
    jvm, configuration = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    place = lambda p: jvm.org.apache.hadoop.fs.Path(p)
    fs = place(path).getFileSystem(configuration)
    head = json.dumps({**(extra or {}), header: df.columns}, ensure_ascii=False, separators=(",", ":"))[:-1]
    out = fs.create(place(unfinished), True)
    try:
        out.write(bytearray(f'{head},"{rows}":['.encode()))
        names = sorted((s.getPath() for s in fs.listStatus(place(parts)) if s.getPath().getName().startswith("part-") and s.getLen()), key=lambda p: p.getName())
        for i, name in enumerate(names):
            part = fs.open(name)
            try:
                if not i:
                    part.read()
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(part, out, 1 << 20, False)
            finally:
                part.close()
        out.write(bytearray(b"]}\n"))
    finally:
        out.close()
    fs.delete(place(path), False)
    if not fs.rename(place(unfinished), place(path)):
        raise OSError(f"{path} could not be put in place")
    fs.delete(place(parts), True)


def envelope(df: DataFrame, header: str, rows: str, order: list, extra: dict | None = None) -> DataFrame:
    """One row: the table as a JSON object of a header and positional rows, for tables of publishing size; others go
    through write_envelope."""
    line = _positional_row(df)
    keyed = df.select(F.struct(*order).alias("o"), line.alias("row"))
    body = keyed.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o", "row"))), lambda x: x["row"]), ",").alias("b"))
    head = json.dumps({**(extra or {}), header: df.columns}, ensure_ascii=False, separators=(",", ":"))[:-1]
    return body.select(F.concat(F.lit(head + f',"{rows}":['), "b", F.lit("]}")).alias("value"))


def write_json_atomically(path: str, value: object) -> None:
    """Driver side: written beside its place, read back, forced to disk, then moved; .gz by suffix."""
    text = json.dumps(value, ensure_ascii=False, separators=(",", ":"))
    opened = gzip.open if path.endswith(".gz") else open
    handle, name = tempfile.mkstemp(dir=os.path.dirname(os.path.abspath(path)), suffix=".gz" if path.endswith(".gz") else ".tmp")
    os.close(handle)
    try:
        with opened(name, "wt", encoding="utf-8") as f:
            f.write(text)
        with opened(name, "rt", encoding="utf-8") as f:
            if json.load(f) != json.loads(text):
                raise OSError(f"{name} does not hold what was written")
        with open(name, "rb") as f:
            os.fsync(f.fileno())
        os.replace(name, path)
    finally:
        if os.path.exists(name):
            os.unlink(name)


def read_json(path: str, default: object = None) -> object:
    """Driver side: plain or .gz; a copy of the default where there is no file."""
    if not os.path.exists(path):
        return json.loads(json.dumps(default))
    with (gzip.open if path.endswith(".gz") else open)(path, "rt", encoding="utf-8") as f:
        return json.load(f)


def write_flags(path: str, flags: dict[str, object]) -> None:
    """Driver side: key=value lines, appended."""
    with open(path, "a", encoding="utf-8") as f:
        f.writelines(f"{k}={str(v).lower() if isinstance(v, bool) else v}\n" for k, v in flags.items())
