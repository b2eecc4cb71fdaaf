"""Token ids in flat binary files.

Layout of a folder: for each partition ``NAME.bin`` holds the ids of its documents one
after another as little-endian unsigned integers (16 bits if the vocabulary allows,
else 32), ``NAME.idx`` the 64-bit offsets of the documents in it (one more than there
are documents) and ``NAME.ids`` their 64-bit doc_ids.  ``manifest.json`` lists the
partitions in order with the numbers of documents and tokens before each: prefix sums of
the partitions' counts, so that no file is written twice to learn its place.

Documents are dealt out by ranges of doc_id (ties by the text's hash, so that no id has
to fit one task) and sorted within.  A task writes files with names of its own and
reports them when they are complete; only reported files enter the manifest, so a
task that is lost or run twice leaves files that nobody reads.  Files are read through
memory maps where the folder is a local or mounted one, by ranges elsewhere.

Words between ASCII white space are tokenised apart and remembered up to a bound; the
tokenizer must drop white space and keep no token across it (``words_apart=False``
hands it whole texts instead).

Defined results: a null or empty text has the end id alone; null doc_ids come last;
rows that repeat are documents of their own; an empty table has a manifest without
files; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import json
import os
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lapsewise.llm.common import on_workers, slices, text_bytes, texts

#: A word of its own in any text that holds it; parts the words of a batch.
SEPARATOR = "|"
#: Hadoop's names of stores that Arrow calls otherwise.
ARROW_SCHEMES = {"s3a": "s3", "s3n": "s3"}


class WordEncoder:
    """Ids of texts as bytes of one integer type, by way of their distinct words."""

    def __init__(self, content: str, end_id: int, words_apart: bool = True, max_words: int = 700_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks are the parallelism
        self.tokenizer = Tokenizer.from_str(content)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.dtype = np.dtype("<u2" if max(self.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4")
        self.end = np.array([end_id], self.dtype).tobytes()
        self.words_apart, self.max_words = words_apart, max_words
        mark = self.tokenizer.encode(SEPARATOR, add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 else None
        # Words met lately and those met before; the former take over when full.
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _ids(self, parts: list[str]) -> list[bytes]:
        made = self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)
        return [np.array(e.ids, self.dtype).tobytes() for e in made]

    def _learn(self, words: list[bytes]) -> None:
        if self.mark is None:
            self.known.update(zip(words, self._ids([w.decode() for w in words])))
            return
        mark = SEPARATOR.encode()
        alone = [w for w in words if mark in w]
        self.known.update(zip(alone, self._ids([w.decode() for w in alone])))
        words = [w for w in words if mark not in w]
        between = f" {SEPARATOR} "
        for at in range(0, len(words), 1000):
            part = words[at : at + 1000]
            data = self._ids([between.join(w.decode() for w in part)])[0]
            ids, width = np.frombuffer(data, self.dtype), self.dtype.itemsize
            cuts = np.flatnonzero(ids == self.mark)
            starts, ends = [0, *(cuts + 1).tolist()], [*cuts.tolist(), len(ids)]
            for word, a, b in zip(part, starts, ends, strict=True):
                self.known[word] = data[width * a : width * b]

    def encode(self, data: list[bytes]) -> list[bytes]:
        """Ids of each text with the end id."""
        if not self.words_apart:
            return [ids + self.end for ids in self._ids([t.decode() for t in data])]
        words = [t.split() for t in data]
        flat = list(chain.from_iterable(words))
        parts = list(map(self.known.get, flat))
        unknown = [i for i, ids in enumerate(parts) if ids is None]
        if unknown:
            new = {flat[i] for i in unknown}
            if len(self.known) + len(new) > self.max_words:
                self.older, self.known = self.known, {}
            back = {w: ids for w in new if (ids := self.older.get(w)) is not None}
            self.known.update(back)
            self._learn([w for w in new if w not in back])
            for i in unknown:
                parts[i] = self.known[flat[i]]
        ends = np.cumsum([0, *map(len, words)]).tolist()
        return [b"".join(parts[a:b]) + self.end for a, b in zip(ends, ends[1:])]


@lru_cache(maxsize=2)
def _encoder(content: str, end_id: int, words_apart: bool) -> WordEncoder:
    return WordEncoder(content, end_id, words_apart)


def arrow_uri(path: str) -> str:
    """The path by the scheme that Arrow knows, where Hadoop has a name of its own for a store."""
    scheme, mark, rest = path.partition("://")
    return f"{ARROW_SCHEMES.get(scheme, scheme)}{mark}{rest}" if mark else path


def _located(path: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(arrow_uri(path))


def _write(path: str, name: str, encoder: WordEncoder, batches: Iterator[pa.RecordBatch]) -> dict | None:
    """Writes one partition; its counts, or None when it has no documents."""
    files, folder = _located(path)
    batch = next(batches, None)
    while batch is not None and not batch.num_rows:
        batch = next(batches, None)
    if batch is None:
        return None
    files.create_dir(folder, recursive=True)
    offsets, ids, total, nulls = [np.zeros(1, np.int64)], [], 0, 0
    with files.open_output_stream(f"{folder}/{name}.bin") as out:
        for part in slices(chain([batch], batches), 4 << 20):
            made = encoder.encode(texts(part))
            out.write(b"".join(made))
            lengths = np.fromiter(map(len, made), np.int64, len(made)) // encoder.dtype.itemsize
            offsets.append(total + np.cumsum(lengths))
            total += int(lengths.sum())
            column = part.column("doc_id")
            nulls += column.null_count
            ids.append(column.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8"))
    for kind, data in (("idx", np.concatenate(offsets)), ("ids", np.concatenate(ids))):
        with files.open_output_stream(f"{folder}/{name}.{kind}") as out:
            out.write(data.astype("<i8").tobytes())
    return {"name": name, "documents": sum(map(len, ids)), "tokens": total, "nulls": nulls}


def write_tokens(
    documents: DataFrame, path: str, tokenizer: str | None = None, end_id: int = 2, words_apart: bool = True
) -> dict:
    """Writes the ids of all documents below ``path`` in ascending order of doc_id; the manifest."""
    spark = documents.sparkSession
    with open(tokenizer or public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        content = spark.sparkContext.broadcast(file.read())  # one to two megabytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        name = f"part-{number:06d}-{uuid.uuid4().hex}"
        done = _write(path, name, _encoder(content.value, end_id, words_apart), batches)
        if done:
            yield pa.RecordBatch.from_pylist([{"partition": number, **done}])

    order = [F.col("doc_id").asc_nulls_last(), F.col("_hash")]
    ranged = (
        documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes(), F.xxhash64("text").alias("_hash"))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("doc_id", "text")
    )
    schema = "partition long, name string, documents long, tokens long, nulls long"
    parts = sorted(on_workers(ranged).mapInArrow(run, schema).collect(), key=lambda r: r["partition"])
    before, rows = np.zeros(2, np.int64), []
    for part in parts:
        kept = {k: part[k] for k in ("name", "documents", "tokens", "nulls")}
        rows.append({**kept, "documents_before": int(before[0]), "tokens_before": int(before[1])})
        before += (part["documents"], part["tokens"])
    encoder = WordEncoder(content.value, end_id)
    manifest = {"dtype": encoder.dtype.str, "end_id": end_id, "partitions": rows}
    files, folder = _located(path)
    files.create_dir(folder, recursive=True)
    with files.open_output_stream(f"{folder}/manifest.json") as out:
        out.write(json.dumps(manifest).encode())
    return manifest


def read_manifest(path: str) -> dict:
    files, folder = _located(path)
    with files.open_input_stream(f"{folder}/manifest.json") as file:
        return json.loads(file.read())


def _open(files: pa.fs.FileSystem, path: str):
    """A memory map where there can be one; else a file read by ranges."""
    return pa.memory_map(path) if isinstance(files, pa.fs.LocalFileSystem) else files.open_input_file(path)


def _numbers(file, dtype: str, start: int, stop: int) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    file.seek(start * width)
    return np.frombuffer(file.read_buffer((stop - start) * width), dtype)


def _blocks(path: str, dtype: str, part: dict, documents: int = 8192, tokens: int = 1 << 21):
    """Runs of a partition's documents: doc_ids with nulls, local offsets, ids."""
    files, folder = _located(path)
    base = f"{folder}/{part['name']}"
    with _open(files, f"{base}.bin") as data, _open(files, f"{base}.idx") as idx, _open(files, f"{base}.ids") as ids:
        at, named = 0, part["documents"] - part["nulls"]
        while at < part["documents"]:
            ends = _numbers(idx, "<i8", at, min(part["documents"], at + documents) + 1)
            n = max(1, int(np.searchsorted(ends, ends[0] + tokens, side="right")) - 1)
            ends = ends[: n + 1]
            doc_ids = _numbers(ids, "<i8", at, at + n)
            mask = np.arange(at, at + n) >= named
            yield pa.array(doc_ids, pa.int64(), mask=mask), ends, _numbers(data, dtype, ends[0], ends[-1])
            at += n


def _parts(spark: SparkSession, manifest: dict) -> DataFrame:
    """One row and task a partition; each knows what lies before it."""
    rows = manifest["partitions"]
    names = ("name", "documents", "tokens", "nulls", "documents_before", "tokens_before")
    kinds = {n: pa.string() if n == "name" else pa.int64() for n in names}
    table = pa.table({n: pa.array([r[n] for r in rows], kinds[n]) for n in names})
    return spark.createDataFrame(table).repartition(max(1, len(rows)))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (tokens of all documents before) and ids of every document, from the files."""
    manifest = read_manifest(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chain.from_iterable(b.to_pylist() for b in batches):
            for doc_ids, ends, ids in _blocks(path, manifest["dtype"], part):
                lists = pa.ListArray.from_arrays(
                    pa.array((ends - ends[0]).astype(np.int32)), pa.array(ids.astype(np.int64))
                )
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": doc_ids, "start": pa.array(part["tokens_before"] + ends[:-1]), "ids": lists}
                )

    return on_workers(_parts(spark, manifest)).mapInArrow(run, "doc_id long, start long, ids array<long>")


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and the crc32 of the ids as little-endian 32-bit integers."""
    manifest = read_manifest(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chain.from_iterable(b.to_pylist() for b in batches):
            for doc_ids, ends, ids in _blocks(path, manifest["dtype"], part):
                wide, local = ids.astype("<u4"), (ends - ends[0]).tolist()
                sums = [zlib.crc32(wide[a:b].tobytes()) for a, b in zip(local, local[1:])]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": doc_ids,
                        "start": pa.array(part["tokens_before"] + ends[:-1]),
                        "n_tokens": pa.array(np.diff(ends)),
                        "ids_crc32": pa.array(sums, pa.int64()),
                    }
                )

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    return on_workers(_parts(spark, manifest)).mapInArrow(run, schema)
