"""Recordings in the BrainVision format: a text header beside a file of binary samples."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow.fs import FileSystem, LocalFileSystem
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavequarry.session import arrow_batches

#: Sample formats of the header and what a unit is in volts.
FORMATS = {"INT_16": "<i2", "INT_32": "<i4", "IEEE_FLOAT_32": "<f4"}
UNITS = {"v": 1.0, "mv": 1e-3, "µv": 1e-6, "uv": 1e-6, "nv": 1e-9, "": 1e-6}
#: Most tasks that recordings are spread over.
TASKS = 100_000
SCHEMA = "rec string, ch int, name string, rate double, samples array<double>, error string"


def parse_header(text: str) -> dict:
    """The header's sections as dictionaries, keys in lower case."""
    sections: dict[str, dict[str, str]] = {}
    current: dict[str, str] = {}
    for line in text.splitlines():
        line = line.strip()
        if line.startswith("[") and line.endswith("]"):
            current = sections.setdefault(line[1:-1].lower(), {})
        elif "=" in line and not line.startswith(";"):
            key, _, value = line.partition("=")
            current[key.strip().lower()] = value.strip()
    return sections


def decode(header: str, data: bytes) -> tuple[list[str], float, np.ndarray]:
    """Channel names, rate in Hz and the signal in volts (channels by samples)."""
    sections = parse_header(header)
    common = sections["common infos"]
    if common.get("dataformat", "BINARY").upper() != "BINARY":
        raise ValueError(f"data format {common['dataformat']} is not supported")
    kind = sections.get("binary infos", {}).get("binaryformat", "INT_16").upper()
    if kind not in FORMATS:
        raise ValueError(f"binary format {kind} is not supported")
    n = int(common["numberofchannels"])
    names, scale = [], []
    for k in range(1, n + 1):
        parts = sections["channel infos"][f"ch{k}"].split(",")
        names.append(parts[0].replace("\\1", ","))
        resolution = float(parts[2]) if len(parts) > 2 and parts[2] else 1.0
        scale.append(resolution * UNITS[parts[3].strip().lower() if len(parts) > 3 else ""])
    values = np.frombuffer(data, dtype=FORMATS[kind])
    values = values[: len(values) // n * n].astype(np.float64)
    multiplexed = common.get("dataorientation", "MULTIPLEXED").upper() == "MULTIPLEXED"
    signal = values.reshape(-1, n).T if multiplexed else values.reshape(n, -1)
    return names, 1e6 / float(common["samplinginterval"]), signal * np.array(scale)[:, None]


def _content(path: str) -> bytes:
    """A whole file, read inside a task."""
    system, name = FileSystem.from_uri(path) if "://" in path else (LocalFileSystem(), path)
    with system.open_input_stream(name) as stream:
        return stream.read()


def data_file(header_path: str, header: str) -> str:
    """The path of the samples that a header names; ``$b`` stands for the header's own name."""
    folder, _, name = header_path.rpartition("/")
    named = parse_header(header)["common infos"]["datafile"].replace("$b", name.rsplit(".", 1)[0])
    return f"{folder}/{named}"


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = {"rec": pa.string(), "ch": pa.int32(), "name": pa.string(), "rate": pa.float64(), "samples": pa.list_(pa.float64()), "error": pa.string()}
    row = lambda *values: pa.RecordBatch.from_arrays([pa.array([v], type=k) for v, k in zip(values, kinds.values(), strict=True)], names=list(kinds))
    for batch in batches:
        for rec, path in zip(batch.column("rec").to_pylist(), batch.column("path").to_pylist(), strict=True):
            try:
                header = _content(path).decode("utf-8", errors="replace")
                try:
                    data = _content(data_file(path, header))
                except FileNotFoundError as e:
                    raise ValueError("data file is missing") from e
                names, rate, x = decode(header, data)
            except Exception as e:  # noqa: BLE001 - a broken file is a row with its error
                yield row(rec, None, None, None, None, f"{type(e).__name__}: {e}")
                continue
            for ch, name in enumerate(names):
                yield row(rec, ch, name, rate, x[ch], None)


def read_brainvision(recordings: DataFrame) -> DataFrame:
    """(rec, ch, name, rate, samples, error), one row per channel, of the header files among ``recordings`` (rec, path); a broken one is a row with its error.

    Only paths are planned and shuffled: a task opens the header and the samples of its recordings.
    """
    spark = recordings.sparkSession
    arrow_batches(spark, rows=1)
    headers = recordings.where(F.endswith("path", F.lit(".vhdr"))).select("rec", "path")
    tasks = max(spark.sparkContext.defaultParallelism, min(headers.count(), TASKS))
    return headers.repartition(tasks, "path").mapInArrow(_decode, SCHEMA)


def unsupported(recordings: DataFrame) -> DataFrame:
    """The recordings of other formats as failed rows."""
    rest = recordings.where(~F.endswith("path", F.lit(".vhdr")))
    empty = [F.lit(None).cast(k).alias(c) for c, k in (("ch", "int"), ("name", "string"), ("rate", "double"), ("samples", "array<double>"))]
    return rest.select("rec", *empty, F.concat(F.lit("unsupported format: "), F.regexp_extract("path", r"\.([^./]*)$", 1)).alias("error"))


def read_recordings(recordings: DataFrame) -> DataFrame:
    """All ``recordings`` (rec, path): decoded, or failed with an error."""
    return read_brainvision(recordings).unionByName(unsupported(recordings))
