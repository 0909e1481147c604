"""Archives, token files, packing and byte-level encoding: round trips and libraries."""

from __future__ import annotations

import base64
import hashlib
import os
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tillwright.llm import byte_bpe, packing, pretoken, token_files, warc
from tillwright.llm.library_ids import WordIds
from tillwright.session import shared_folder

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
BYTE_FILE = public_tokenizers.path("byte_bpe_50k.json")
WORD_FILE = public_tokenizers.path("word_bpe_49k.json")
ALPHABET = "a b'sletrvmdSTR \n\t\r .,!12²é中' Àßz'll'RÉΣς\x1c\x00\x85　́"
TEXTS = [
    "", None, " ", "\n", "word", "two words.", "It's we'll I'd they've 's  's", "a" * 3000, " " * 2000,
    "line one\nline two\n\n  three", "naïve Straße ÑANDÚ", "<|endoftext|> and <|startoftext|>x", "9" * 50, "x " * 4000,
]
SCHEMA = "doc_id long, text string, ids string, length int"


def random_texts(seed: int, count: int) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(40))) for _ in range(count)]


def frame(spark):
    texts = [*TEXTS, *random_texts(1, 60)]
    rows = [(3 * i, text, "clash", i) for i, text in enumerate(texts)]
    return spark.createDataFrame([*rows, rows[4], (None, "no id", None, None)], SCHEMA).repartition(3), [*rows, rows[4]]


def tiktoken_encoding():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=40) | st.text(ALPHABET, max_size=40), max_size=5))
def test_pieces_are_those_of_the_pattern(texts):
    import regex

    cut, starts, first = pretoken.pieces(texts)
    for i, text in enumerate(texts):
        own = slice(first[i], first[i + 1])
        assert "".join(cut[own]) == text
        if all(len(regex.findall(r"\p{Cn}", c)) == 0 for c in text) and not set(text) & set("\x1c\x1d\x1e\x1f"):
            want = [(m.start(), m.group()) for m in regex.finditer(public_tokenizers.PATTERN, text)]
            assert list(zip(starts[own].tolist(), cut[own], strict=True)) == want


def test_encoding_equals_the_library_and_decodes(spark):
    df, rows = frame(spark)
    library = tiktoken_encoding()
    encoded = byte_bpe.encode_documents(df, RANKS)
    got = {row.doc_id: row for row in encoded.collect()}
    decoded = {row.doc_id: bytes(row.decoded) for row in byte_bpe.decode_documents(encoded, RANKS).collect()}
    assert encoded.count() == len(rows) + 1
    for doc_id, text, *_ in rows:
        row = got[doc_id]
        assert row.ids == library.encode_ordinary(text or "")
        assert decoded[doc_id] == (text or "").encode()
        assert sum(row.piece_tokens) == len(row.ids)
        # Every piece decodes alone, from its offsets.
        at = 0
        for i, (start, n) in enumerate(zip(row.piece_starts, row.piece_tokens, strict=True)):
            end = row.piece_starts[i + 1] if i + 1 < len(row.piece_starts) else len(text)
            assert library.decode(row.ids[at : at + n]) == text[start:end]
            at += n


def test_every_codepoint_is_cut_as_by_tiktoken():
    library = tiktoken_encoding()
    for around in ("a{}b", "1{}2", " {}'s", "\n{} x", "!{}{}"):
        texts = [
            "".join(around.format(chr(code), chr(code)) for code in range(block, block + 0x400) if not 0xD800 <= code < 0xE000)
            for block in range(0, 0x110000, 0x400)
        ]
        cut, _, first = pretoken.pieces(texts)
        for i, text in enumerate(texts):
            own = cut[first[i] : first[i + 1]]
            assert "".join(own) == text
            # Ids of each piece alone, merged without cutting it again.
            assert [x for piece in own for x in library._encode_single_piece(piece)] == library.encode_ordinary(text)


def test_digests(spark):
    df, rows = frame(spark)
    columns = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    got = {r.doc_id: r for r in byte_bpe.map_encoded(df, RANKS, byte_bpe.digests, columns).collect()}
    library = tiktoken_encoding()
    for doc_id, text, *_ in rows:
        ids = library.encode_ordinary(text or "")
        want = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert (got[doc_id].n_tokens, got[doc_id].ids_sha256) == (len(ids), want)
        assert got[doc_id].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


@pytest.mark.parametrize(("path", "leading"), [(BYTE_FILE, True), (WORD_FILE, False)])
def test_word_ids_equal_the_library(path, leading, monkeypatch):
    library = Tokenizer.from_file(path)
    texts = [t or "" for t in TEXTS] + random_texts(2, 3000)
    # Added tokens have their own ids, next to words, in words and in odd cases.
    for token in ("<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "<|endoftext"):
        texts += [token, f"a {token} b", f"a{token}b\n{token}{token} ", f"Ünd  {token}'s"]
    words = WordIds(path, leading, "<u2")
    for cached in (800_000, 50):
        monkeypatch.setattr("tillwright.llm.library_ids.CACHED_WORDS", cached)
        for _ in range(2):
            got = [np.frombuffer(ids, "<u2").tolist() for ids in words.of(texts)]
            assert got == [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("vocabulary", [1 << 16, 1 << 17])
def test_token_files(spark, vocabulary):
    df, rows = frame(spark)
    folder = shared_folder(spark, "token-files")
    shards = token_files.write_token_files(df, folder, BYTE_FILE, 0, vocabulary)
    read = token_files.read_token_files(shards, folder, token_files.crc32_of_ids).collect()
    library = Tokenizer.from_file(BYTE_FILE)
    base, want = 0, []
    for doc_id, text in [(None, "no id"), *sorted((r[0], r[1] or "") for r in rows)]:
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 0], "<u4")
        want.append((doc_id, base, len(ids), zlib.crc32(ids.tobytes())))
        base += len(ids)
    assert sorted(map(tuple, read), key=lambda r: r[1]) == want
    # The bases are prefix sums, and the files hold nothing else.
    places = sorted(map(tuple, shards.collect()))
    assert [p[1] for p in places] == [sum(q[3] for q in places[:i]) for i in range(len(places))]
    width = 2 if vocabulary == 1 << 16 else 4
    for _, _, _, tokens, name in places:
        assert os.path.getsize(os.path.join(token_files.local_path(folder), f"{name}.ids")) == width * tokens


def test_token_files_of_nothing(spark):
    assert token_files.token_file_report(frame(spark)[0].limit(0), BYTE_FILE).collect() == []
    with pytest.raises(ValueError, match="mounted"):
        token_files.local_path("s3://bucket/folder")


def check_sequences(rows, limits):
    sequences = defaultdict(list)
    for row in rows:
        sequences[row.sequence_id].append(row)
    padding = 0
    for own in sequences.values():
        at = 0
        for row in sorted(own, key=lambda r: r.offset):
            assert row.offset == at and row.length > 0
            at += row.length
        assert at <= limits.tokens and len(own) <= limits.segments
        padding += 0 if at & (at - 1) == 0 else limits.tokens - at
    return padding


@pytest.mark.parametrize("limits", [packing.Limits(), packing.Limits(64, 3, 64), packing.Limits(16, 2, 9)])
@pytest.mark.parametrize("window", [4, 1024])
def test_packed_documents(spark, limits, window):
    df, rows = frame(spark)
    got = packing.pack_documents(df, WORD_FILE, 2, limits, window=window).collect()
    library = Tokenizer.from_file(WORD_FILE)
    assert check_sequences(got, limits) == 0
    pieces = defaultdict(list)
    for row in got:
        pieces[row.doc_id].append(row)
    for doc_id, text, *_ in rows[:-1]:
        if doc_id == rows[-1][0]:
            continue
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        at = 0
        for row in sorted(pieces[doc_id], key=lambda r: r.start):
            assert (row.start, row.doc_tokens) == (at, len(ids))
            assert row.ids_crc32 == zlib.crc32(ids[at : at + row.length].tobytes())
            at += row.length
        assert at == len(ids)
    assert sum(r.length for r in pieces[rows[-1][0]]) == 2 * pieces[rows[-1][0]][0].doc_tokens
    assert pieces[None]
    assert packing.pack_documents(df.limit(0), WORD_FILE).collect() == []


def test_packed_examples_keep_every_limit(spark):
    rng = random.Random(3)
    limits = packing.Limits(100, 6, 40)
    rows = [(i, rng.randrange(1, 60), rng.randrange(0, 30), "x") for i in range(500)]
    rows += [(900, 150, 10, "x"), (901, 10, 50, "x"), (None, 5, None, "x"), (902, None, -3, "x"), (5, 7, 7, "x")]
    df = spark.createDataFrame(rows, "id long, tokens long, loss long, offset string")
    got = packing.pack_examples(df, "id", "tokens", "loss", limits, window=64).collect()
    assert len(got) == len(rows)
    sequences = defaultdict(list)
    for row in got:
        sequences[row.sequence_id].append(row)
    for own in sequences.values():
        total, loss = sum(r.tokens for r in own), sum(r.loss_tokens for r in own)
        assert len(own) == 1 or (total <= 100 and loss <= 40 and len(own) <= 6)
    floor = max(sum(max(r[1] or 0, 0) for r in rows) / 100, sum(max(r[2] or 0, 0) for r in rows) / 40, len(rows) / 6)
    assert len(sequences) <= 1.15 * floor + 8


PAGES = "page_id long, url string, html string, digest string, file int"


def page_rows():
    big, small = "x" * 1000, "y" * 999
    rows = [(1, "http://a/ b\r\n", big), (9, None, big), (4, "u", big), (2, "u", small), (3, "u", small)]
    rows += [(5, "u", None), (6, "u", ""), (7, "u", "é" * 500), (8, "u", "é" * 500), (None, "u", big)]
    rows += [(10, "u", "WARC/1.1\r\n\r\n" + "z" * 70_000), (9, None, big), (11, "u", os.urandom(60_000).hex())]
    return [(*row, "clash", 1) for row in rows]


def test_archives(spark):
    rows = page_rows()
    df = spark.createDataFrame(rows, PAGES).repartition(3)
    got = sorted(map(tuple, warc.archive_report(spark, df).collect()), key=repr)
    largest = {}
    for page_id, _, html, *_ in rows:
        largest[html] = max(largest.get(html, -1), -1 if page_id is None else page_id)
    want = []
    for page_id, _, html, *_ in rows:
        raw = (html or "").encode()
        other = page_id is not None and len(raw) >= 1000 and largest[html] != page_id
        digest = hashlib.sha1(raw).hexdigest()
        want.append((page_id, len(raw), digest, "revisit" if other else "response", largest[html] if other else None))
    assert got == sorted(want, key=repr)
    assert warc.archive_report(spark, df.limit(0)).collect() == []


def archive(zipped: bool) -> tuple[bytes, list[int]]:
    raw, starts = b"", []
    for i in range(8):
        payload = f"<p>{i}</p>".encode() * (200 + 9000 * (i == 3))
        one = warc.record(i, "http://h/", payload, len(payload), hashlib.sha1(payload).digest(), None)
        starts.append(len(raw))
        zipper = zlib.compressobj(4, zlib.DEFLATED, 31)
        raw += zipper.compress(one) + zipper.flush() if zipped else one
    return raw, starts


@pytest.mark.parametrize("zipped", [True, False])
def test_whole_archives_have_no_gaps(zipped):
    raw, starts = archive(zipped)
    found = list(warc.entries(raw))
    assert [e["page_id"] for _, _, e in found] == list(range(8))
    assert [a for a, _, _ in found] == starts and found[-1][1] == len(raw)
    assert list(warc.entries(b"")) == []


@pytest.mark.parametrize("zipped", [True, False])
@pytest.mark.parametrize("harm", ["flip", "cut", "insert", "head", "tail", "all"])
def test_salvage(zipped, harm):
    raw, starts = archive(zipped)
    lost = {2}
    middle = (starts[2] + starts[3]) // 2
    if harm == "flip":
        raw = raw[:middle] + bytes([raw[middle] ^ 0x55]) + raw[middle + 1 :]
    elif harm == "cut":
        raw = raw[:middle] + raw[starts[3] :]
    elif harm == "insert":
        raw, lost = raw[: starts[2]] + b"junk\x1f\x8b\x08WARC/1.1\r\nmore" + raw[starts[2] :], set()
    elif harm == "head":
        raw, lost = raw[5:], {0}
    elif harm == "tail":
        raw, lost = raw[:-3], {7}
    else:
        raw, lost = b"\x1f\x8b\x08" * 50, set(range(8))
    found = list(warc.entries(raw))
    records = [e["page_id"] for _, _, e in found if e["kind"] != "gap"]
    gaps = [(a, b) for a, b, e in found if e["kind"] == "gap"]
    assert records == [i for i in range(8) if i not in lost]
    assert len(gaps) == 1 and all(e["reason"] for _, _, e in found if e["kind"] == "gap")
    # Records and gaps cover every byte once.
    assert [a for a, _, _ in found] == [0, *(b for _, b, _ in found[:-1])] and found[-1][1] == len(raw)


def test_gaps_are_logged_by_the_reader(spark):
    folder = shared_folder(spark, "warc-test")
    raw, starts = archive(True)
    os.makedirs(token_files.local_path(folder))
    with open(os.path.join(token_files.local_path(folder), "one.warc.gz"), "wb") as out:
        out.write(raw[: starts[4]] + b"\0" * 100 + raw[starts[5] :])
    files = spark.createDataFrame([("one.warc.gz",)], "file string")
    rows = warc.read_archives(files, folder).collect()
    assert sorted(r.page_id for r in rows if r.kind == "response") == [0, 1, 2, 3, 5, 6, 7]
    assert [(r.offset, r.size, r.reason) for r in rows if r.kind == "gap"] == [(starts[4], 100, "no member")]
