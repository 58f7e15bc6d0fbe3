"""md5 of large files by many tasks: a file's blocks are hashed in turns, and the state of the hash goes from task to task.

An md5 is one chain over the bytes, so the blocks of one file follow each other; those of different files are hashed at the
same time. A task takes one block and the state after the block before it, 92 bytes, and gives the state after its own.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from itertools import groupby
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievemark.session import scratch_path
from sievemark.sources.csv_records import lines_of

try:
    import _hashlib
except ModuleNotFoundError:  # a Python without OpenSSL
    _hashlib = None

_BOM = b"\xef\xbb\xbf"
_STATE_BYTES = 92  # MD5_CTX: four words, the bits so far in two, a buffer of 64 bytes and its fill
_PIECE_BYTES = 4 * 2**20
_PIECES = "no int, block long, place long, size long, data binary, turn long"
_SMALL_BUFFERS = {  # Parquet looks at the size of what it holds after 100 rows, here after each
    "parquet.block.size": 16 * 2**20, "parquet.page.size.row.check.min": 1, "parquet.page.size.row.check.max": 1,
    "parquet.block.size.row.check.min": 1, "parquet.block.size.row.check.max": 1, "parquet.enable.dictionary": "false",
}
_STATES = "no int, state binary, fed long"


def _openssl() -> ctypes.CDLL:
    """The library behind ``hashlib``, whose own objects can neither be written down nor sent."""
    return ctypes.CDLL(getattr(_hashlib, "__file__", None))


def can_chain() -> bool:
    """Whether this Python's OpenSSL can be called; the executors' is taken to be the same."""
    return hasattr(_openssl(), "MD5_Init")


class Chain:
    """An md5 that goes on from the state of another."""

    def __init__(self, state: bytes | None = None):
        self._lib = _openssl()
        self._context = ctypes.create_string_buffer(state or b"", _STATE_BYTES)
        if state is None:
            self._lib.MD5_Init(self._context)

    def update(self, data: bytes) -> None:
        self._lib.MD5_Update(self._context, data, ctypes.c_size_t(len(data)))

    def state(self) -> bytes:
        return self._context.raw

    def hexdigest(self) -> str:
        out = ctypes.create_string_buffer(16)
        self._lib.MD5_Final(out, ctypes.create_string_buffer(self.state(), _STATE_BYTES))
        return out.raw.hex()


class LargeFile(NamedTuple):
    path: str
    length: int
    name: str  # as Spark's readers tell it in _metadata


def is_unpacked(spark: SparkSession, path: str) -> bool:
    """Whether Spark's line reader gives other bytes than the file's, as it does for names like ``a.gz``."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    return jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(jvm.org.apache.hadoop.fs.Path(path)) is not None


def _pieces(lines: DataFrame, numbers: dict[str, int], turn_bytes: int) -> DataFrame:
    """Runs of lines as pieces of bytes by their place in the reader's block; each line gets its end back, the last one too."""
    schema = pa.schema([("no", pa.int32()), ("block", pa.int64()), ("place", pa.int64()), ("size", pa.int64()),
                        ("data", pa.binary()), ("turn", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, place = None, 0
        for batch in batches:
            values, file, block = batch.columns
            n = len(values)
            key_at = lambda i: (file[i].as_py(), block[i].as_py())
            # a block comes in one go, so equal ends leave no other between them
            runs = [(key_at(0), range(n))] if n and key_at(0) == key_at(n - 1) else groupby(range(n), key_at)
            for key, span in runs:
                first, *rest = span
                data = b"\n".join(values.slice(first, 1 + len(rest)).to_pylist()) + b"\n"
                here, place = key, place if key == here else 0
                turn = (key[1] + place) // turn_bytes  # lines begin no later than the next block, so turns never go back
                for at in range(0, len(data), _PIECE_BYTES):
                    part = data[at : at + _PIECE_BYTES]
                    row = (numbers[key[0]], key[1], place + at, len(part), part, turn)
                    yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema)], schema=schema)
                place += len(data)

    return lines.select(F.col("value").cast("binary"), "file", "block").mapInArrow(run, _PIECES)


def _advanced(pieces: DataFrame, before: dict[int, tuple[bytes | None, int]], lengths: list[int]) -> DataFrame:
    """The states after these pieces, which come in the order of their file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chains: dict[int, list] = {}
        for batch in batches:
            for no, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                if no not in chains:
                    state, fed = before[no]
                    chains[no] = [Chain(state), fed]
                part = data.as_py()[: lengths[no] - chains[no][1]]  # the last line may have had no end
                chains[no][0].update(part)
                chains[no][1] += len(part)
        rows = [(no, chain.state(), fed) for no, (chain, fed) in chains.items()]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.binary(), pa.int64()))], names=["no", "state", "fed"])

    return pieces.select("no", "data").mapInArrow(run, _STATES)


def chained_md5(spark: SparkSession, path: str, files: list[LargeFile], block: int) -> list[tuple[str, int, str]]:
    """(path, length, md5) of ``files`` below ``path``; no task takes more than about ``block`` bytes, or one line.

    The bytes are read as lines by many tasks and written to scratch once, by turns. The driver keeps a state per file.
    """
    files = sorted(files, key=lambda f: -f.length)  # those that take part in a turn come first
    lengths = [f.length for f in files]
    lines = lines_of(spark, path, recursive=True).filter(F.col("file").isin([f.name for f in files]))
    pieces = _pieces(lines, {f.name: no for no, f in enumerate(files)}, block)
    written = scratch_path(spark, "file-pieces")
    pieces.write.partitionBy("turn").options(**_SMALL_BUFFERS).parquet(written)
    stored = spark.read.schema(_PIECES).parquet(written)

    states: dict[int, tuple[bytes | None, int]] = {}
    for no, size in stored.groupBy("no").agg(F.sum("size")).collect():
        if size - lengths[no] not in (-3, -2, 0, 1):
            raise ValueError(f"{files[no].path}: {size} bytes came as lines of {lengths[no]}")
        states[no] = None, 0
        if size < lengths[no]:  # the line reader leaves out a byte order mark
            start = Chain()
            start.update(_BOM)
            states[no] = start.state(), len(_BOM)
    for turn in range(-(-lengths[0] // block)):
        here = sum(length > turn * block for length in lengths)
        one_each = stored.filter(F.col("turn") == turn).repartitionById(here, "no").sortWithinPartitions("no", "block", "place")
        states.update({no: (bytes(state), fed) for no, state, fed in _advanced(one_each, states, lengths).collect()})
    for no, f in enumerate(files):
        if states[no][1] != f.length:
            raise ValueError(f"{f.path}: {states[no][1]} of {f.length} bytes hashed")
    return [(f.path, f.length, Chain(states[no][0]).hexdigest()) for no, f in enumerate(files)]
