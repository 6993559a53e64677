"""What the operators on texts share: tables, words, and steps over Arrow batches."""

import uuid

import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

MAX_CACHED = 200_000


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark):
    """The folder that the driver and all executors share.

    ``spark.checkpoint.dir`` names it. Where that is unset, the warehouse is
    used, which Spark itself needs every executor to reach.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/barograph-llm"


def stored(df, label):
    """Write a table to the shared folder and read it back.

    This cuts the lineage: whatever is lost with an executor is read again from
    files, and a table that several steps use is worked out once.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def words_of(text):
    """Words as bytes: runs without space, tab, newline, VT, FF or CR; A-Z in lower case."""
    return text.encode("utf-8", "replace").lower().split()


def word_ids(words, cache):
    """64-bit ids of words; ``cache`` is bounded and holds what was seen lately."""
    if len(cache) > MAX_CACHED:
        cache.clear()
    known = cache.get
    out = []
    for word in words:
        found = known(word)
        if found is None:
            found = cache[word] = xxhash.xxh3_64_intdigest(word)
        out.append(found)
    return out


def over_batches(df, schema, make, columns=None):
    """Apply ``make()(rows) -> columns`` to every Arrow batch of a table.

    ``make`` is called once a task and returns a function from a dictionary of
    Python lists to a dictionary of lists or arrays. A batch of long texts is
    worked off in slices, so that memory does not follow the batch size.
    """
    names = columns or df.columns
    wanted = to_arrow(schema)

    def run(batches):
        step = make()
        for batch in batches:
            for rows in slices(batch):
                out = step({n: rows.column(i).to_pylist() for i, n in enumerate(names)})
                if out is not None:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(out[f.name], type=f.type) for f in wanted], schema=wanted
                    )

    return df.select(*names).mapInArrow(run, schema)


def map_rows(df, function):
    """``mapInArrow`` over all columns, whatever characters their names hold; the schema stays.

    ``function`` sees the columns under numbers, in their order.
    """
    numbered = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return numbered.mapInArrow(function, numbered.schema).toDF(*df.columns)


def slices(batch, most_bytes=4_000_000):
    """Slices of a batch of about so many bytes each, of one row at least."""
    size = max(1, batch.nbytes // max(1, batch.num_rows))
    step = max(1, min(2048, most_bytes // size))
    for start in range(0, batch.num_rows, step):
        yield batch.slice(start, step)


ARROW = {
    "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
    "boolean": pa.bool_(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64()),
    "array<int>": pa.list_(pa.int32()), "array<double>": pa.list_(pa.float64()),
    "array<string>": pa.list_(pa.string()),
}


def to_arrow(schema):
    fields = [part.strip().split(" ") for part in schema.split(",")]
    return pa.schema([pa.field(name, ARROW[kind]) for name, kind in fields])


def remainder(column, divisor):
    """The remainder of the CRC-32 of an id's text; null for a null id."""
    return F.crc32(column.cast("string").cast("binary")) % F.lit(divisor)


def rows_of(df):
    """A small table as Python rows, through Arrow."""
    return df.toArrow().to_pylist()
