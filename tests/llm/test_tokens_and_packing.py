import functools
import zlib

import numpy as np
import odd_docs
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from meterwise.llm import packing, queries, token_files, tokens
from meterwise.llm.tokens import PieceIds

WORD, BYTE = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))


@functools.cache
def whole(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


def plain_ids(path: str, text: str | None) -> list[int]:
    return whole(path).encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path, spaced", [(WORD, False), (BYTE, True)])
def test_cached_pieces_give_the_ids_of_whole_texts(path, spaced):
    import random

    rng = random.Random(3)
    parts = [" ", "  ", "\n", " \n", "\t", "\x85", "\xa0", "\x1c", "\x1f", "a", "The", "don't", "'s",
             "'S", "é", "é", "İ", "ΑΣ", "ß", "1", "23", ",", ".", "..", "?!", "<|endoftext|>", "<|",
             "—", "½", "²", "​", "　", "中文", "ﬁ", "́", "Ⅷ", "A.", "é,", "_", "a_b", "\0"]
    texts = ["".join(rng.choices(parts, k=rng.randint(1, 12))) for _ in range(3000)]
    tokenizer = whole(path)
    want = [np.asarray(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    pieces = PieceIds(path, spaced)
    assert pieces.of(texts) == want
    pieces.LIMIT = 50  # forget and learn again
    assert pieces.of(texts) == want


@pytest.mark.parametrize("path, spaced", [(WORD, False), (BYTE, True)])
def test_words_with_marks_are_encoded_together_and_few_times(path, spaced):
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFéßñÀ"
    import random

    rng = random.Random(5)
    words = ["".join(rng.choices(letters, k=rng.randint(3, 9))) for _ in range(2000)]
    ends = ["", ".", ",", "&&&", "$", "...", "'s", "-x", "\x01", "0", "%)", "’", "?!,", "<|", "́", "\n", "\nx", "\n\n"]
    texts = [" ".join(w + e for w in words[i : i + 100] for e in ends) for i in range(0, 2000, 100)]
    pieces = PieceIds(path, spaced)
    calls, whole_texts = [], pieces.tokenizer

    class Counting:
        def __getattr__(self, name):
            return getattr(whole_texts, name)

        def encode_batch_fast(self, batch, **options):
            calls.append(len(batch))
            return whole_texts.encode_batch_fast(batch, **options)

    pieces.tokenizer = Counting()
    assert pieces.of(texts) == [np.asarray(plain_ids(path, t), "<u4").tobytes() for t in texts]
    # Each word once, each kind of end once, and most of them together.
    assert sum(calls) < 4000


@pytest.mark.parametrize("path, spaced", [(WORD, False), (BYTE, True)])
def test_frequent_pieces_outlive_rare_ones(path, spaced):
    pieces = PieceIds(path, spaced)
    pieces.LIMIT = 40
    learned = []
    learn = pieces.encoded
    pieces.encoded = lambda new: learned.extend(new) or learn(new)
    for i in range(200):
        text = f"always here {chr(97 + i % 26) * (i // 26 + 2)} w{i}"
        assert pieces.of([text]) == [np.asarray(plain_ids(path, text), "<u4").tobytes()]
    assert sum(x.strip() == "here" for x in learned) == 1
    assert len(pieces.young) + len(pieces.old) < 60


def crc(ids) -> int:
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())


def test_odd_white_space_is_found():
    plain = ["", "a", "a b\nc", " a", "\na", "a ", "é ü\n中 x", "\x1c", "\x00"[1:]]
    odd = ["a  b", "a\n\nb", "a \nb", "a\n b", "a\n", "\n", "a\tb", "a\rb", "\0", "a\x0bb", "a\x0cb"]
    odd += [f"é{x}b" for x in "\x85\xa0\u1680\u2000\u200a\u2028\u2029\u202f\u205f\u3000"]
    assert [t for t in plain if tokens.odd_space(t)] == []
    assert [t for t in odd if not tokens.odd_space(t)] == []


def test_a_worker_keeps_as_many_words_as_asked_for():
    ids = {}
    texts = [f"w{i} v{i % 7}" for i in range(300)]
    for limit in (10, None):
        encode = tokens.encoder(BYTE, True, limit)
        ids[limit] = [b for t in texts for b in encode([t])]
        held = encode.__self__
        assert (len(held.young) + len(held.old) < 40) == (limit == 10)
    assert ids[10] == ids[None] == tokens.PieceIds(BYTE, True).whole(texts)


def test_token_files_round_trip(spark, tmp_path):
    data = odd_docs.rows()
    path = f"file:{tmp_path}/tokens"
    manifest = token_files.write_token_files(odd_docs.docs(spark, data), path, WORD, length=64)
    got = sorted(map(tuple, token_files.read_token_files(spark, path).collect()))
    at = 0
    for (doc, start, n, ids), (want_doc, text) in zip(got, data, strict=True):
        want = plain_ids(WORD, text) + [1]
        assert (doc, start, n) == (want_doc, at, len(want))
        assert list(np.frombuffer(ids, "<u4")) == want
        at += n
    assert manifest.agg({"tokens": "sum"}).head()[0] == at


def test_random_access_copies_nothing(spark, tmp_path):
    data = [(i, "some words " * (i * 40)) for i in range(30)]
    path = f"{tmp_path}/tokens"
    manifest = token_files.write_token_files(
        odd_docs.docs(spark, data).coalesce(1), f"file:{path}", WORD, length=16
    ).orderBy("part").collect()
    stream = [i for _, t in data for i in plain_ids(WORD, t) + [1]]
    at = 0
    for row in manifest:
        file = token_files.TokenFile(f"{path}/{row['file']}")
        for i in range(row["sequences"]):
            ids, valid, ends = file[i]
            assert len(ids) == len(valid) == len(ends) == 16 and not ids.flags.owndata
            n = sum(valid.to_pylist())
            assert list(ids[:n]) == stream[at : at + n]
            at += n
    assert at == len(stream)


def test_unnamed_files_are_not_read(spark, tmp_path):
    path = f"file:{tmp_path}/tokens"
    token_files.write_token_files(odd_docs.docs(spark, [(1, "a b")]), path, WORD)
    (tmp_path / "tokens" / "tokens-000009-left.arrow").write_bytes(b"half a file")
    assert token_files.read_token_files(spark, path).count() == 1


def test_empty_table_and_null_ids(spark, tmp_path):
    empty = odd_docs.docs(spark, []).limit(0)
    token_files.write_token_files(empty, f"file:{tmp_path}/none", WORD)
    assert token_files.read_token_files(spark, f"file:{tmp_path}/none").count() == 0
    assert packing.best_fit_pack(empty, BYTE).count() == 0
    twice = odd_docs.docs(spark, [(None, "b"), (5, "a"), (5, "a"), (None, None)])
    token_files.write_token_files(twice, f"file:{tmp_path}/twice", WORD)
    got = token_files.read_token_files(spark, f"file:{tmp_path}/twice").collect()
    assert sorted((r["start"], r["doc_id"]) for r in got)[2:] == [(3, 5), (5, 5)]
    assert packing.best_fit_pack(twice, BYTE).count() == 4


def check_packing(pieces: list[tuple], texts: dict[int, str | None], size: int) -> None:
    """`pieces`: (doc_id, piece, start, length, crc, sequence, offset)."""
    by_doc: dict[int, list] = {}
    by_sequence: dict[int, list] = {}
    for row in sorted(pieces):
        by_doc.setdefault(row[0], []).append(row)
        by_sequence.setdefault(row[5], []).append((row[6], row[3]))
    assert by_doc.keys() == texts.keys()
    for doc, rows in by_doc.items():
        ids = plain_ids(BYTE, texts[doc]) + [2]
        assert [r[1] for r in rows] == list(range(len(rows)))
        assert all(r[3] == size for r in rows[1:]) and 0 < rows[0][3] <= size
        at = 0
        for _, _, start, n, check, _, _ in rows:
            assert start == at and check == crc(ids[at : at + n])
            at += n
        assert at == len(ids)
    for places in by_sequence.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= size


@pytest.mark.parametrize("limit", [1, 3, 1024])
def test_packing_places_every_token_once(spark, limit):
    data = odd_docs.rows()
    packed = packing.best_fit_pack(odd_docs.docs(spark, data), BYTE, size=256, open_bins=limit)
    rows = [(r[0], r[1], r[2], r[3], zlib.crc32(r[4]), r[5], r[6]) for r in packed.collect()]
    check_packing(rows, dict(data), 256)


def test_open_bins_close_the_fullest_first():
    bins = packing.OpenBins(10, 2)
    assert bins.place(7) == (0, 0) and bins.place(5) == (1, 0)
    assert bins.place(8) == (2, 0)  # bin 0, with 3 free, closes
    assert bins.place(3) == (1, 5)
    assert bins.place(2) == (1, 8)  # the fuller of two that fit, which ends full
    assert bins.place(2) == (2, 8) and bins.open == 0
    assert bins.place(10) == (3, 0) and bins.open == 0


def test_packing_is_tight(spark, sf_dir):
    rows = [tuple(r) for r in queries.registered()["op2_best_fit_packing"](spark, sf_dir).collect()]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    check_packing(rows, {r[0]: r[1] for r in docs}, 1024)
    least = sum(r[3] for r in rows) / 1024
    assert len({r[5] for r in rows}) <= 1.08 * least + 1


def test_sequences_hold_their_pieces(spark):
    data = odd_docs.rows()[:20]
    packed = packing.best_fit_pack(odd_docs.docs(spark, data), BYTE, size=128)
    whole = {r["sequence_id"]: bytes(r["ids"]) for r in packing.sequences(packed).collect()}
    for row in packed.collect():
        at = 4 * row["offset"]
        assert whole[row["sequence_id"]][at : at + 4 * row["length"]] == row["ids"]


def test_query_of_token_files_against_plain_encoding(spark, sf_dir):
    got = queries.registered()["op1_token_files"](spark, sf_dir).orderBy("doc_id").collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()
    at = 0
    for row, doc in zip(got, docs, strict=True):
        ids = plain_ids(WORD, doc["text"]) + [1]
        assert tuple(row) == (doc["doc_id"], at, len(ids), crc(ids))
        at += len(ids)
