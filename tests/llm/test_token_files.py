import json
import random
import zlib
from pathlib import Path

import corpus
import numpy as np
import public_tokenizers
import pytest
from local import frame
from tokenizers import Tokenizer

from lapsewise.llm import token_files

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


def ids_of(text, end=2):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, end]


def expected(rows):
    at, out = 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        ids = ids_of(text)
        out.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def check(spark, df, path):
    manifest = token_files.write_tokens(df, path)
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    got = sorted((tuple(r) for r in token_files.read_digests(spark, path).collect()), key=lambda r: r[1])
    want = expected(rows)
    assert len({r[0] for r in rows}) < len(rows) or got == want
    assert [g[0] for g in got] == [w[0] for w in want]
    assert sorted(g[2:] for g in got) == sorted(w[2:] for w in want)
    whole = sorted((r["start"], r["ids"]) for r in token_files.read_tokens(spark, path).collect())
    assert [s for s, _ in whole] == np.cumsum([0, *(len(i) for _, i in whole)])[:-1].tolist()
    assert sorted(i for _, i in whole) == sorted(ids_of(t) for _, t in rows)
    return manifest


def test_given_documents(spark, tmp_path):
    df = spark.read.parquet(f"{corpus.SMALL}/documents.parquet").repartition(6)
    manifest = check(spark, df, str(tmp_path / "t"))
    assert manifest == json.loads((tmp_path / "t/manifest.json").read_text()) == token_files.read_manifest(f"file://{tmp_path}/t")
    assert manifest["dtype"] == "<u2"
    for part in manifest["partitions"]:
        base = Path(tmp_path / "t" / part["name"])
        offsets = np.fromfile(f"{base}.idx", "<i8")
        assert offsets[0] == 0 and offsets[-1] == part["tokens"] and len(offsets) == part["documents"] + 1
        assert np.memmap(f"{base}.bin", "<u2", "r").shape == (part["tokens"],)


def test_awkward_rows(spark, tmp_path):
    check(spark, corpus.awkward(spark), str(tmp_path / "t"))


def test_one_id_in_many_rows(spark, tmp_path):
    rows = [(5, t, "en", "a", 1, 0.5, "r", 7, 3) for t in corpus.shaken(1, ["a", "bb", "c."], 80)]
    check(spark, frame(spark, rows, corpus.DDL), str(tmp_path / "t"))


def test_empty_table(spark, tmp_path):
    manifest = check(spark, corpus.empty(spark), f"file://{tmp_path}/t")
    assert manifest["partitions"] == []


def test_files_of_lost_tasks_are_not_read(spark, tmp_path):
    path = str(tmp_path / "t")
    token_files.write_tokens(corpus.awkward(spark), path)
    before = sorted(map(tuple, token_files.read_digests(spark, path).collect()), key=str)
    (tmp_path / "t/part-000000-lost.bin").write_bytes(b"\x01\x00" * 9)
    assert sorted(map(tuple, token_files.read_digests(spark, path).collect()), key=str) == before


def test_blocks(tmp_path):
    """Reading in small blocks gives the same documents."""
    encoder = token_files.WordEncoder(Path(PATH).read_text(encoding="utf-8"), 2)
    import pyarrow as pa

    texts = [t.encode() for t in corpus.shaken(2, ["word", "ing", "12"], 50)]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array([*range(48), None, None], pa.int64()), "text": pa.array(texts)})
    part = token_files._write(str(tmp_path), "p", encoder, iter([batch.slice(0, 0), batch]))
    for documents, tokens in ((1, 1 << 20), (7, 1 << 20), (50, 10), (8192, 1)):
        blocks = list(token_files._blocks(str(tmp_path), "<u2", part, documents, tokens))
        assert sum((b[0].to_pylist() for b in blocks), []) == [*range(48), None, None]
        assert np.concatenate([b[2] for b in blocks]).tolist() == sum((ids_of(t.decode()) for t in texts), [])
        assert sum((np.diff(b[1]).tolist() for b in blocks), []) == [len(ids_of(t.decode())) for t in texts]


PARTS = ["a", "B", "the", "ing", " ", "\n", "é", "é", " ́", "|", "||", "\x1c", " ", "\x85", "<|endoftext|>", "Σ", "İ", "中", "😀", "'s", "12"]


@pytest.mark.parametrize("words", [5, 250_000])
def test_words_apart_as_whole_texts(words):
    encoder = token_files.WordEncoder(Path(PATH).read_text(encoding="utf-8"), 2, max_words=words)
    draw = random.Random(words)
    texts = ["".join(draw.choices(PARTS, k=draw.randint(0, 20))) for _ in range(1500)]
    for at in range(0, len(texts), 100):
        part = texts[at : at + 100]
        made = encoder.encode([t.encode() for t in part])
        assert [np.frombuffer(m, "<u2").tolist() for m in made] == [ids_of(t) for t in part]


def test_whole_texts(spark, tmp_path):
    df = frame(spark, corpus.rows(["some words", None, "more"]), corpus.DDL)
    path = str(tmp_path / "t")
    token_files.write_tokens(df, path, public_tokenizers.path("byte_bpe_50k.json"), end_id=50256, words_apart=False)
    other = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = [r["ids"] for r in token_files.read_tokens(spark, path).orderBy("start").collect()]
    assert got == [[*other.encode(t, add_special_tokens=False).ids, 50256] for t in ("some words", "", "more")]


def test_paths_of_stores():
    """Stores by the names that Hadoop and Arrow give them; a store's own path stays."""
    assert token_files.arrow_uri("s3a://bucket/a/b") == "s3://bucket/a/b"
    assert token_files.arrow_uri("s3n://bucket/a") == "s3://bucket/a"
    for path in ("gs://bucket/a", "hdfs://host:8020/a", "file:///tmp/a", "/tmp/a://b", "/tmp/a"):
        assert token_files.arrow_uri(path) == path
    files, folder = token_files._located("s3a://bucket/a/b?region=none&scheme=http&endpoint_override=localhost:1")
    assert (files.type_name, folder) == ("s3", "bucket/a/b")
