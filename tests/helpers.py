"""Small fixtures shared by the tests."""

import zstandard
from pyspark.sql import functions as F

from recordsieve.operators.membership import word_list


def lists(spark):
    return word_list(spark, ["Robotics"]), word_list(spark, ["HelperBot_"])


def lines_df(spark, lines):
    rows = [(i, line) for i, line in enumerate(lines)]
    return spark.createDataFrame(rows, "i int, line string")


def pack(path, text, window_log=None, finish=True):
    """Write text (or bytes) as one zstd frame; unfinished frames are cut short."""
    path.parent.mkdir(parents=True, exist_ok=True)
    data = text if isinstance(text, bytes) else text.encode()
    params = {}
    if window_log:
        params["compression_params"] = zstandard.ZstdCompressionParameters(window_log=window_log, enable_ldm=True)
    packer = zstandard.ZstdCompressor(**params).compressobj()
    out = packer.compress(data)
    out += packer.flush(
        zstandard.COMPRESSOBJ_FLUSH_FINISH if finish else zstandard.COMPRESSOBJ_FLUSH_BLOCK
    )
    with open(path, "ab") as f:
        f.write(out)
    return str(path), path.stat().st_size


def physical_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def optimized_plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def sorted_rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


__all__ = ["F", "lines_df", "lists", "optimized_plan", "pack", "physical_plan", "sorted_rows"]
