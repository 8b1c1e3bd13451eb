import pyarrow as pa
import pytest


@pytest.fixture
def make(spark):
    """A frame of the given columns; lists per column, types by name."""
    kinds = {"long": pa.int64(), "string": pa.string(), "vector": pa.list_(pa.float32()), "int": pa.int32()}

    def frame(layout, rows):
        names, types = zip(*(x.split(":") for x in layout.split()))
        columns = list(zip(*rows)) or [[]] * len(names)
        return spark.createDataFrame(pa.table({n: pa.array(list(c), kinds[t]) for n, t, c in zip(names, types, columns)}))

    return frame
