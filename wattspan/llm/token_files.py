"""Token ids in flat binary files with 64-bit document offsets.

A data set is a folder of parts in the order of ``doc_id``. A part is three flat files:
``.bin`` unsigned little-endian ids of 16 or 32 bits, ``.idx`` one 64-bit offset per
document and one for the end, in ids of this part, and ``.doc`` one record per document of
its 64-bit id and whether it has one. The manifest names the files of each part; its
prefix sums turn the offsets of a part into those of the whole.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattspan.llm.common import stage, table
from wattspan.llm.tokens import encoder
from wattspan.session import work_path

END_ID = 1
OFFSETS = np.dtype("<u8")
DOCUMENT = np.dtype([("id", "<i8"), ("known", "u1")])
MANIFEST = "part long, name string, docs long, tokens long"
DOCS_AT_ONCE = 256


def _filesystem(uri: str):
    """A file system and the path in it; paths without a scheme are local."""
    from pyarrow import fs

    if ":" not in uri.split("/")[0]:
        return fs.LocalFileSystem(), uri
    scheme, _, path = uri.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + path.lstrip("/")
    return fs.FileSystem.from_uri(uri)


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    spaces: str = "dropped",
    end_id: int = END_ID,
    id_bytes: int = 2,
) -> DataFrame:
    """Write ``docs`` below ``folder``; returns the stored manifest with each part's base.

    ``docs`` needs ``doc_id`` and ``text``. A null or empty text is the end id alone.
    Rows without an id come first; rows of the same id are ordered by their text. A task
    writes under names of its own and the manifest, written by Spark, names those of the
    attempt that counts, so tasks may fail or run twice.
    """
    ids_type = np.dtype(f"<u{id_bytes}")
    end = np.array([end_id], "<u4").tobytes()

    def write(batch_iter: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, spaces)
        store, root = _filesystem(folder)
        part = TaskContext.get().partitionId()
        name = f"part-{part:08d}-{uuid.uuid4().hex}"
        docs, total, offset = 0, 0, np.zeros(1, OFFSETS)
        store.create_dir(root, recursive=True)
        with (
            store.open_output_stream(f"{root}/{name}.bin") as ids_file,
            store.open_output_stream(f"{root}/{name}.idx") as offsets_file,
            store.open_output_stream(f"{root}/{name}.doc") as docs_file,
        ):
            offsets_file.write(offset.tobytes())
            for batch in batch_iter:
                for low in range(0, batch.num_rows, DOCS_AT_ONCE):
                    chunk = batch.slice(low, DOCS_AT_ONCE)
                    raw = [ids + end for ids in encode(chunk.column(1).to_pylist())]
                    ids = np.frombuffer(b"".join(raw), "<u4")
                    if len(ids) and int(ids.max()) > np.iinfo(ids_type).max:
                        raise ValueError(f"an id does not fit {id_bytes} bytes")
                    ids_file.write(ids.astype(ids_type).tobytes())
                    ends = total + np.cumsum([len(r) // 4 for r in raw], dtype=OFFSETS)
                    offsets_file.write(ends.astype(OFFSETS).tobytes())
                    keys = chunk.column(0)
                    record = np.empty(len(raw), DOCUMENT)
                    record["id"] = keys.fill_null(0).to_numpy(zero_copy_only=False)
                    record["known"] = keys.is_valid().to_numpy(zero_copy_only=False)
                    docs_file.write(record.tobytes())
                    docs, total = docs + len(raw), int(ends[-1])
        if docs:
            columns = [[part], [name], [docs], [total]]
            names = ["part", "name", "docs", "tokens"]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    tie = F.xxhash64("text")
    ordered = (
        docs.select(F.col("doc_id").cast("long"), "text")
        .repartitionByRange("doc_id", tie)
        .sortWithinPartitions("doc_id", tie, "text")
    )
    manifest = stage(ordered.mapInArrow(write, MANIFEST), "token-manifest")
    # One row per part: this window and the sum in it are small.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def _mapped(store, path: str, kind: np.dtype, local: bool):
    """A file as an array: memory-mapped where it is local, else read when sliced."""
    size = store.get_file_info(path).size
    if local:
        return np.memmap(path, kind, "r") if size else np.empty(0, kind)
    opened = store.open_input_file(path)

    class Remote:
        def __getitem__(self, at: slice) -> np.ndarray:
            low, high = at.start or 0, size // kind.itemsize if at.stop is None else at.stop
            return np.frombuffer(
                opened.read_at((high - low) * kind.itemsize, low * kind.itemsize), kind
            )

    return Remote()


def read_token_files(manifest: DataFrame, folder: str, id_bytes: int = 2) -> DataFrame:
    """The documents in the files: ``doc_id``, ``start``, ``n_tokens`` and ``ids``.

    ``start`` counts the ids of all documents before; ``ids`` holds little-endian
    unsigned 32-bit ids. Files are mapped and read a run of documents at a time.
    """
    ids_type = np.dtype(f"<u{id_bytes}")

    def read(batch_iter: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, root = _filesystem(folder)
        local = isinstance(store, fs.LocalFileSystem)
        for batch in batch_iter:
            for row in batch.to_pylist():
                path = f"{root}/{row['name']}"
                ids = _mapped(store, f"{path}.bin", ids_type, local)
                offsets = _mapped(store, f"{path}.idx", OFFSETS, local)
                documents = _mapped(store, f"{path}.doc", DOCUMENT, local)
                for low in range(0, row["docs"], DOCS_AT_ONCE):
                    high = min(low + DOCS_AT_ONCE, row["docs"])
                    at = np.array(offsets[low : high + 1]).astype(np.int64)
                    raw = np.asarray(ids[at[0] : at[-1]]).astype("<u4").tobytes()
                    cuts = 4 * (at - at[0])
                    record = np.array(documents[low:high])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(record["id"], pa.int64(), mask=record["known"] == 0),
                            pa.array(row["base"] + at[:-1]),
                            pa.array(np.diff(at)),
                            pa.array([raw[a:b] for a, b in zip(cuts, cuts[1:])], pa.binary()),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids"],
                    )

    parts = max(1, manifest.count())
    return (
        manifest.select("part", "name", "docs", "base")
        .repartitionByRange(parts, "part")
        .mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")
    )


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` written as token files and read back."""
    import public_tokenizers

    folder = work_path(spark, "token-files")
    manifest = write_token_files(
        table(spark, sf_dir, "documents"), folder, public_tokenizers.path("word_bpe_49k.json")
    )
    return read_token_files(manifest, folder).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )
