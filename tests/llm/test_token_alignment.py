"""Alignment of two tokenizers against a plain walk over whole texts."""

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from test_token_files import AWKWARD, _random_texts
from tokenizers import Tokenizer

from curbflow.llm.queries import QUERIES
from curbflow.llm.token_alignment import align_tokens, byte_bpe_bytes, piece_bpe_bytes

A_FILE, B_FILE = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


def brute(texts):
    """(n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of each text, and the pairs."""
    a_bytes, b_bytes = byte_bpe_bytes(A_FILE), piece_bpe_bytes(B_FILE)
    first, second = Tokenizer.from_file(A_FILE), SentencePieceProcessor(model_file=B_FILE)
    first.encode_special_tokens = True
    found = []
    for text in texts:
        spaced = f" {text}".encode() if text else b""
        a = first.encode(f" {text}", add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        if not text or b"".join(a_bytes[i] for i in a) != spaced or b"".join(b_bytes[i] for i in b) != spaced:
            found.append(([], [], [], []))
            continue
        ends = []
        for ids, sizes in ((a, a_bytes), (b, b_bytes)):
            at, own = 0, []
            for i in ids:
                at += len(sizes[i])
                own.append(at)
            ends.append(own)
        common = set(ends[0]) & set(ends[1])
        groups, links, ia, ib = [], [], 0, 0
        for end in sorted(common):
            ja, jb = ends[0].index(end, ia) + 1, ends[1].index(end, ib) + 1
            groups.append(",".join(map(str, a[ia:ja])) + "|" + ",".join(map(str, b[ib:jb])))
            links.append((a[ja - 1], b[jb - 1]))
            ia, ib = ja, jb
        found.append((a, b, groups, links))
    counts = Counter(link for *_, links in found for link in links)
    most = defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    rows = [
        (len(a), len(b), len(groups), len(links), sum(counts[k] == most[k[1]] for k in links), sum(counts[k] for k in links),
         hashlib.sha256(";".join(groups).encode()).hexdigest() if a else "")
        for a, b, groups, links in found
    ]
    return rows, {(a, b, n, n == most[b]) for (a, b), n in counts.items()}


TEXTS = AWKWARD + _random_texts(400) + [None, None, "the same words", "the same words", "\x00 nul", "<s> </s> <unk>", "tab\tand ﬁ ligature"]


@pytest.mark.parametrize("broadcast_pairs,piece,unit", [(10**6, 1 << 21, 3 << 20), (0, 1 << 21, 3 << 20), (10**6, 300, 700)])
def test_equals_a_plain_walk(spark, broadcast_pairs, piece, unit):
    ids = [None if i % 50 == 7 else i // 2 for i in range(len(TEXTS))]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in zip(ids, TEXTS)], "doc_id long, text string, row int, pairs string").repartition(4)
    documents, pairs = align_tokens(docs, A_FILE, B_FILE, broadcast_pairs=broadcast_pairs, stretch=piece, unit_bytes=unit)
    columns = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    got = sorted(((r.doc_id is None, r.doc_id or 0), *(r[c] for c in columns)) for r in documents.collect())
    rows, table = brute(TEXTS)
    assert got == sorted(((i is None, i or 0), *row) for i, row in zip(ids, rows))
    assert {tuple(r) for r in pairs.collect()} == table


def test_empty_tables(spark):
    for rows in ([], [(1, None), (2, "")]):
        documents, pairs = align_tokens(spark.createDataFrame(rows, "doc_id long, text string"), A_FILE, B_FILE)
        assert sorted(tuple(r) for r in documents.collect()) == [(i, 0, 0, 0, 0, 0, 0, "") for i, _ in rows]
        assert pairs.collect() == []


def test_vocabularies_spell_every_byte():
    a, b = byte_bpe_bytes(A_FILE), piece_bpe_bytes(B_FILE)
    assert {bytes([i]) for i in range(256)} <= set(a) and {bytes([i]) for i in range(256)} <= set(b)
    assert a[50_256] == b"<|endoftext|>" and b[1] == b"" and len(b) == 32_000


def test_the_query_equals_a_plain_walk(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    rows, _ = brute([t for _, t in docs])
    assert sorted(tuple(r) for r in QUERIES["op12_token_alignment"](spark, sf_dir).collect()) == sorted((i, *row) for (i, _), row in zip(docs, rows))
