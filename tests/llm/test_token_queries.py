"""Token files and packing: the encoder and the registered queries against the unmodified library."""

import random
import struct
import zlib
from collections import defaultdict

import pyarrow as pa
import public_tokenizers
from tokenizers import Tokenizer

from airlend.llm import queries, tokens

PATH = public_tokenizers.path(queries.LIBRARY_FILE)
PIECES = list("abcDE 12.,'_-!\n\n  \t\r\x0b\0\xa0　éßñ×÷ɏɐ日本😀`{}[]^$st") + ["'s", "'ll", " '", "\n\n", "x\ny", "\x85"]


def odd_texts(seed: int, n: int) -> list[str | None]:
    rng = random.Random(seed)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 40))) for _ in range(n)]
    for k in range(0, n, 50):
        texts[k] += rng.choice(["<|endoftext|>", " <|endoftext|> b", "<|endoftext", "<|endoftext|><|endoftext|>\n"]) + texts[k]
    return [*texts, None, "", " ", "a <|endoftext|> b", "x" * 300_000, "word, " * 40_000, "\n" * 5000, "é" * 2000]


def by_library(texts: list[str | None]) -> list[list[int]]:
    found = Tokenizer.from_file(PATH).encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [one.ids for one in found]


def test_encoder_gives_the_librarys_ids(monkeypatch):
    texts = odd_texts(1, 6000)
    want = by_library(texts)
    assert want[texts.index("a <|endoftext|> b")] == [64, 220, 50256, 275]
    for kept, size in ((500_000, 4_000_000), (300, 5_000)):
        monkeypatch.setattr(tokens, "KEPT_DISTINCT", kept)
        monkeypatch.setattr(tokens, "SLICE_BYTES", size)
        encoder, got = tokens.LibraryEncoder(PATH), []
        for values, bounds in encoder.encode(pa.array(texts)):
            got += [values[a:b].tolist() for a, b in zip(bounds, bounds[1:])]
        assert got == want
        assert len(encoder.parts) == len(encoder.ids) <= kept + 4000
        assert max(map(len, encoder.parts.to_pylist())) <= tokens.KEPT_BYTES


def crc(ids: list[int]) -> int:
    return zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))


def documents(spark, folder) -> tuple[str, list]:
    rows = [(3 * k - 9, text, "s") for k, text in enumerate(odd_texts(2, 400))]
    spark.createDataFrame(rows, "doc_id long, text string, start string").repartition(5).write.parquet(f"{folder}/documents.parquet")
    return str(folder), rows


def test_token_files_query(spark, tmp_path):
    folder, rows = documents(spark, tmp_path)
    want, start = [], 0
    for (doc_id, *_), ids in zip(rows, by_library([text for _, text, _ in rows])):
        ids = [*ids, 0]
        want.append((doc_id, start, len(ids), crc(ids)))
        start += len(ids)
    found = [tuple(r) for r in queries.op2_token_files(spark, folder).select("doc_id", "start", "n_tokens", "ids_crc32").collect()]
    assert sorted(found) == want


def test_packing_query(spark, tmp_path):
    folder, rows = documents(spark, tmp_path)
    want = {}
    for (doc_id, *_), ids in zip(rows, by_library([text for _, text, _ in rows])):
        ids = [*ids, 2]
        first = len(ids) % 1024 or 1024 if len(ids) > 1024 else len(ids)
        cuts = [0, *range(first, len(ids), 1024), len(ids)]
        want |= {(doc_id, k): (a, b - a, crc(ids[a:b])) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))}
    found = queries.op10_best_fit_packing(spark, folder).collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in found} == want and len(found) == len(want)
    sequences, gaps = defaultdict(list), []
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 1024
    for length in sorted((length for _, length, _ in want.values()), reverse=True):
        fit = min((g for g in gaps if g >= length), default=None)
        gaps.append((1024 if fit is None else gaps.pop(gaps.index(fit))) - length)
    assert len(sequences) == len(gaps)
