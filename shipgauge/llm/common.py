"""Helpers that the operators of this package share.

Rules that hold for every operator: a null text counts as an empty one unless
the operator's docstring says otherwise, texts are read whole, repeated rows
are treated one by one, an empty table gives an empty result, and an output
column replaces an input column of the same name.
"""

from __future__ import annotations

import sys
import tempfile
import types
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

SLICE_ROWS = 512
REMEMBERED = 96 << 20  # bytes that one memory of words in a worker may take
LONGEST = 64           # characters of a word that is remembered
_SLOT = 120            # bytes of an entry besides its key and value


def split_remainder(key: str, modulus: int) -> Column:
    """crc32 of the key's text modulo ``modulus``; a null key counts as the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % modulus


def add_columns(df: DataFrame, inputs: list[str], fields: list[T.StructField],
                make: Callable[[], Callable[..., list]], keep: list[str] | None = None,
                rows: int = SLICE_ROWS) -> DataFrame:
    """Append columns computed row by row from ``inputs``.

    ``make`` runs once per task and returns a function from lists of input
    values to one list (or Arrow array) per field. It gets slices of ``rows``
    rows, so a task holds a slice of texts at a time. ``keep`` names the
    input columns to return (default: all); output names win over clashes.
    """
    names = {f.name for f in fields}
    keep = [c for c in (df.columns if keep is None else keep) if c not in names]
    read = list(dict.fromkeys(keep + inputs))
    schema = T.StructType([df.schema[c] for c in keep] + fields)
    types = [f.type for f in to_arrow_schema(T.StructType(fields))]

    def run(batches):
        work = make()
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                new = work(*(part.column(c).to_pylist() for c in inputs))
                new = [x if isinstance(x, pa.Array) else pa.array(x, t) for x, t in zip(new, types, strict=True)]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), *new],
                                                 names=[*keep, *(f.name for f in fields)])

    return df.select(*read).mapInArrow(run, schema)


def summarise(df: DataFrame, inputs: list[str], fields: list[T.StructField],
              make: Callable[[], tuple[Callable, Callable]]) -> DataFrame:
    """One partial summary per task: ``make`` returns (add, finish).

    ``add`` takes lists of input values, ``finish`` yields tuples of columns
    for the task's summary rows. The caller aggregates these with Spark.
    """
    schema = T.StructType(fields)
    arrow = to_arrow_schema(schema)

    def run(batches):
        add, finish = make()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                add(*(part.column(c).to_pylist() for c in inputs))
        for columns in finish():
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(columns, arrow, strict=True)],
                                             schema=arrow)

    return df.select(*inputs).mapInArrow(run, schema)


def unused(name: str, *frames: DataFrame) -> str:
    """``name``, lengthened until none of the frames has such a column (in any case)."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


class Remembered(dict):
    """``make(word)`` by word, remembered until about ``budget`` bytes are taken.

    Words longer than ``LONGEST`` are worked out each time, so a 'word' of a
    megabyte takes no room.
    """

    def __init__(self, make: Callable, budget: int | None = None):
        super().__init__()
        self.make, self.left = make, REMEMBERED if budget is None else budget

    def __missing__(self, word):
        found = self.make(word)
        if self.left > 0 and len(word) <= LONGEST:
            self.left -= sys.getsizeof(word) + sys.getsizeof(found) + _SLOT
            self[word] = found
        return found


def kept_in_worker(name: str, make: Callable):
    """``make()``, kept under ``name`` in the worker process, which Spark reuses for later tasks."""
    kept = sys.modules.setdefault("shipgauge_worker", types.ModuleType("shipgauge_worker"))
    if name not in vars(kept):
        vars(kept)[name] = make()
    return vars(kept)[name]


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``.

    Only a local master may do without the setting; it gets a temporary folder.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    context = spark.sparkContext
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not context.getCheckpointDir():
        context.setCheckpointDir(tempfile.mkdtemp(prefix="shipgauge-"))
    return context.getCheckpointDir()


def discard(df: DataFrame) -> None:
    """Delete the table that ``written`` returned as ``df``; nothing may read it any more."""
    folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    jvm, conf = df.sparkSession.sparkContext._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    for folder in folders:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a table in the shared folder and read it back.

    Cuts the lineage; a lost executor costs a task, not the work so far.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
