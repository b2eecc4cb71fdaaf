"""Small frames as local relations, which need no Python workers to scan."""

import pyarrow as pa

TYPES = {
    "bigint": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "string": pa.string(),
    "timestamp_ntz": pa.timestamp("us"),
}


def frame(spark, rows, ddl):
    fields = [field.split() for field in ddl.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    arrays = [pa.array(c, TYPES[t]) for c, (_, t) in zip(columns, fields)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, names=[n for n, _ in fields]))
