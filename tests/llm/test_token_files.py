"""Token files: wavelet matrices against plain arrays, round trips against the tokenizer, ties, nulls, rewrites."""

import random
import zlib
from glob import glob

import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from curbflow.llm import tokens as parts
from curbflow.llm.queries import QUERIES
from curbflow.llm.token_files import count_tokens, find_token, read_token_files, tokens_at, write_token_files
from curbflow.llm.tokens import PartEncoder, byte_bpe, piece_bpe
from curbflow.llm.wavelet import WaveletFile, wavelet_bytes

FILE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def stored(tokens, **arrays):
    data = b"".join(wavelet_bytes(tokens, arrays))
    return WaveletFile(lambda at, size: data[at : at + size], len(data))


@pytest.mark.parametrize("n,bits", [(0, 16), (1, 1), (65_536, 5), (65_537, 16), (200_000, 16), (131_072, 17)])
def test_questions_equal_a_plain_array(n, bits):
    rng = np.random.default_rng(n)
    tokens = (rng.zipf(1.2, n) % (1 << bits)).astype(np.uint32)
    file = stored(tokens, extra=np.arange(3))
    assert (file.tokens() == tokens).all() and list(file.arrays["extra"]) == [0, 1, 2]
    assert file.count(1 << bits) == 0 and list(file.occurrences(1 << bits)) == []
    if not n:
        return
    at = rng.integers(0, n, 300)
    assert (file.access(at) == tokens[at]).all()
    for token in {*tokens[:9].tolist(), 0, (1 << bits) - 1}:
        places = np.flatnonzero(tokens == token)
        bounds = np.sort(rng.integers(0, n + 1, 40))
        assert (file.rank(token, bounds) == np.searchsorted(places, bounds)).all()
        assert file.count(token) == len(places) and (file.occurrences(token, n // 3, n // 2) == places[(places >= n // 3) & (places < n // 2)]).all()
        if len(places):
            which = rng.integers(0, len(places), 20)
            assert (file.select(token, which) == places[which]).all()
    with pytest.raises(IndexError):
        file.access([n])
    with pytest.raises(IndexError):
        file.select(int(tokens[0]), [n])


def test_a_few_questions_read_a_few_blocks():
    tokens = np.random.default_rng(1).integers(0, 50_000, 1_000_000).astype(np.uint32)
    data = b"".join(wavelet_bytes(tokens, {}))
    read = []
    file = WaveletFile(lambda at, size: (read.append(size), data[at : at + size])[1], len(data))
    file.access([777_777])
    assert sum(read) < len(data) / 4
    with pytest.raises(ValueError):
        WaveletFile(lambda at, size: b"x" * size, 100)


AWKWARD = [
    "", " ", "  ", "a", " a", "a ", "a  b", "a b  c d", "a\n b c", "\tx y", "don't can't 've 'll x 's", "x  y z", "p  q", "1 2 3a 4",
    "é ü 日本 語 🎉 🎉🎉", "a\x1c b", "a \x1c b", "<|endoftext|> b <|endoftext|>", "a<|endoftext|> b", "x᠎ y", "a ▁ b▁c", "…  … ", "\r\n a\r\n b ",
    "word " * 5000, "w" * 3000, " ".join(str(i) for i in range(4000)),
]


def _random_texts(n):
    draw = random.Random(5)
    signs = ["a", "B", "é", "日", "1", "'s", ".", " ", " ", "  ", "\n", "\t", " ", "🎉", "-", "\x85", "​", "▁"]
    return ["".join(draw.choice(signs) for _ in range(draw.randrange(1, 40))) for _ in range(n)]


def test_parts_give_the_ids_of_whole_texts(monkeypatch):
    texts = AWKWARD + _random_texts(3000)
    whole = Tokenizer.from_file(FILE)
    monkeypatch.setattr(parts, "PIECE", 2000)
    for most in (50, 10**6):
        [(ids, sizes)] = PartEncoder(byte_bpe(FILE, special_as_text=False), lead=False, most=most)(texts)
        for text, own in zip(texts, np.split(ids, np.cumsum(sizes)[:-1])):
            assert own.tolist() == whole.encode(text, add_special_tokens=False).ids, repr(text)
    whole.encode_special_tokens = True
    from sentencepiece import SentencePieceProcessor

    processor = SentencePieceProcessor(model_file=PIECES)
    a, b = PartEncoder(byte_bpe(FILE), piece_bpe(PIECES))(texts)
    for text, own_a, own_b in zip(texts, *(np.split(ids, np.cumsum(sizes)[:-1]) for ids, sizes in (a, b))):
        assert own_a.tolist() == whole.encode(f" {text}", add_special_tokens=False).ids, repr(text)
        assert not text or "▁" in text or own_b.tolist() == processor.encode(text), repr(text)


def brute(rows):
    """(doc_id, start, n_tokens, crc) with a plain tokenizer, in the order the files have."""
    tokenizer = Tokenizer.from_file(FILE)
    at, out = 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, np.uint64(xxhash.xxh64_intdigest((r[1] or "").encode(), 42)).astype(np.int64))):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


ROWS = [(i, t) for i, t in enumerate(AWKWARD)] + [(-5, "before # all ##"), (3, None), (3, "again"), (3, "again"), (None, "no id"), (None, "no id"), (None, None)]


def test_round_trip_and_questions(spark, tmp_path):
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in ROWS], "doc_id long, text string, digest string, row string").repartition(5)
    path = f"file://{tmp_path}/t"
    want = brute(ROWS)
    for shard, tokens in ((10**9, 10**9), (2000, 3000), (1, 1)):
        manifest = write_token_files(docs, path, FILE, shard_bytes=shard, file_tokens=tokens)
        got = read_token_files(spark, path, ids=True).collect()
        assert sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == sorted((s, d, n, c) for d, s, n, c in want)
        assert len(glob(f"{tmp_path}/t/run-*")) == 1 and glob(f"{tmp_path}/t/run-*/_temporary") == []
        assert manifest.count() == len(glob(f"{tmp_path}/t/run-*/*.wm"))
    flat = np.concatenate([r.ids for r in sorted(got, key=lambda r: r.start)])
    hash_sign = 2
    assert {r.token: r.n for r in count_tokens(spark, path, [hash_sign, 11, 50_000]).collect()} == {t: int((flat == t).sum()) for t in (hash_sign, 11, 50_000)}
    found = find_token(spark, path, hash_sign).collect()
    assert sorted(r.corpus_place for r in found) == np.flatnonzero(flat == hash_sign).tolist()
    starts = {(r.doc_id, r.start) for r in got}
    assert all((r.doc_id, r.corpus_place - r.place) in starts for r in found)
    places = [0, 17, 1000, len(flat) - 1]
    assert {r.corpus_place: r.token for r in tokens_at(spark, path, places).collect()} == {p: int(flat[p]) for p in places}


def test_empty_tables_and_damaged_files(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    write_token_files(spark.createDataFrame([], "doc_id long, text string"), path, FILE)
    assert read_token_files(spark, path).collect() == [] and find_token(spark, path, 2).collect() == []
    write_token_files(spark.createDataFrame([(1, "b" * 50)], "doc_id long, text string"), path, FILE)
    write_token_files(spark.createDataFrame([(1, "c" * 50)], "doc_id long, text string"), path, FILE)
    assert [r.ids_crc32 for r in read_token_files(spark, path).collect()] == [brute([(1, "c" * 50)])[0][3]]
    (file,) = glob(f"{tmp_path}/t/run-*/*.wm")
    data = bytearray(open(file, "rb").read())
    data[12] ^= 1
    open(file, "wb").write(data)
    with pytest.raises(Exception, match="differs from the manifest"):
        read_token_files(spark, path).collect()
    with pytest.raises(ValueError, match="no token files"):
        read_token_files(spark, f"{path}-absent")


def test_the_query_equals_the_tokenizer(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(tuple(r) for r in QUERIES["op11_token_files"](spark, sf_dir).collect()) == brute(rows)
