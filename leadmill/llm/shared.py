"""Small helpers that several of these operators use."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadmill.plans.session import shared_folder

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: For ``str.translate``: lowers A-Z and nothing else.
LOWER_ASCII = {ord(letter): letter.lower() for letter in UPPER}


#: Text a Python worker is given at a time; one longer text is a batch of its own.
BATCH_BYTES = 8 << 20


def mapped(frame: DataFrame, function, schema) -> DataFrame:
    """``mapInArrow`` with batches of bounded size, however long the texts are."""
    conf = frame.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return frame.mapInArrow(function, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_name(frame: DataFrame, name: str) -> str:
    """A column name that the frame does not have."""
    taken = {column.lower() for column in frame.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def crc_of_id(id_column: str) -> Column:
    """crc32 of the id written as text; null for a null id."""
    return F.crc32(F.col(id_column).cast("string").cast("binary"))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def scratch(spark: SparkSession) -> str:
    """A new path in the folder all executors share, removed when the session ends."""
    path = f"{shared_folder(spark)}/leadmill-llm-{uuid.uuid4().hex}"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(place)
    files.deleteOnExit(place)
    return path


def stored(frame: DataFrame) -> DataFrame:
    """The frame, written to the shared folder and read again.

    It cuts the lineage: later steps read the files, also after executors are lost.
    """
    path = f"{scratch(frame.sparkSession)}/rows"
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def frequent(counts: DataFrame, column: str, limit: int) -> DataFrame:
    """The rows with the largest counts, at most ``limit`` of them.

    Rows are ranked in bands of about equal counts, a thousand bands at most, so nothing
    is sorted and rows of equal count stay or go together.
    """
    band = F.floor(F.log2(F.col(column)) * 16)
    sizes = counts.groupBy(band.alias("band")).count().collect()
    least, held = None, 0
    for row in sorted(sizes, key=lambda row: -row["band"]):
        held += row["count"]
        if held > limit:
            break
        least = row["band"]
    return counts.where(band >= least if least is not None else F.lit(False))


def word_runs(texts: pa.Array, most: int = 500_000) -> Iterator[tuple]:
    """``coded_runs`` with the different words as a list of Python strings."""
    for words, places, counts in coded_runs(texts, most):
        yield words.to_pylist(), places, counts


def coded_runs(texts: pa.Array, most: int) -> Iterator[tuple]:
    """Texts cut at ASCII white space, a run of texts with about ``most`` words at a time.

    Yields ``words, places, counts``: the different words of the run, for each word of the
    texts its place among these, and how many words each text has. The work on every word
    is done by Arrow. Null texts have no words.
    """
    whole = pc.fill_null(texts, "")
    # A word takes two bytes at least; texts are put together by what they may hold.
    bounds = np.cumsum(pc.binary_length(whole).to_numpy(zero_copy_only=False) // 6 + 1)
    start = 0
    while start < len(whole):
        base = bounds[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(bounds, base + most, "right")))
        lists = pc.ascii_split_whitespace(whole.slice(start, stop - start))
        offsets = lists.offsets.to_numpy().astype(np.int64)
        flat = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
        real = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
        kept = np.concatenate([[0], np.cumsum(real)])
        coded = (flat if real.all() else flat.filter(pa.array(real))).dictionary_encode()
        counts = np.diff(kept[offsets - offsets[0]])
        yield coded.dictionary, coded.indices.to_numpy(), counts
        start = stop
