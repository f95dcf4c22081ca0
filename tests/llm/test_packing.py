import zlib
from collections import defaultdict
from functools import cache

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from inputs import FOLDER, ODD, docs
from tokenizers import Tokenizer

from shelfmark.llm import best_two_fit, packed_ids, placing, tokens
from shelfmark.llm.queries import QUERIES, tokenizer_path

LENGTHS = st.lists(st.integers(1, 40), max_size=60)


def bins(runs, limit):
    filled = defaultdict(list)
    for r in runs:
        for i in range(r.number):
            filled[r.sequence + i].append((r.offset, r.length, r.first + i))
    for pieces in filled.values():
        at = 0
        for offset, length, _ in sorted(pieces):
            assert offset == at
            at += length
        assert at <= limit
    return filled


def counted(lengths):
    return {n: lengths.count(n) for n in set(lengths)}


def check_all_placed(filled, lengths):
    got = sorted((length, i) for pieces in filled.values() for _, length, i in pieces)
    assert got == sorted((n, i) for n, k in counted(lengths).items() for i in range(k))


@settings(max_examples=400, deadline=None)
@given(LENGTHS)
def test_best_fit_decreasing_is_that_of_single_pieces(lengths):
    filled = bins(packed_ids.best_fit_decreasing(counted(lengths), 40), 40)
    check_all_placed(filled, lengths)
    rooms = []
    for n in sorted(lengths, reverse=True):
        fit = min((r for r in rooms if r >= n), default=None)
        if fit is None:
            rooms.append(40 - n)
        else:
            rooms[rooms.index(fit)] -= n
    assert sorted(40 - sum(x[1] for x in p) for p in filled.values()) == sorted(rooms)


@settings(max_examples=400, deadline=None)
@given(LENGTHS)
def test_best_two_fit_places_everything(lengths):
    filled = bins(best_two_fit.best_two_fit(counted(lengths), 40), 40)
    check_all_placed(filled, lengths)
    least = -(-sum(lengths) // 40)
    assert least <= len(filled) <= max(least, len(lengths))


def test_two_documents_replace_the_smallest():
    # Greedy fills 6 + 3 and leaves 1; 2 + 2 fill the gap of 4 in place of the 3.
    filled = bins(best_two_fit.best_two_fit({6: 1, 3: 1, 2: 2}, 10), 10)
    assert sorted(sorted(x[1] for x in p) for p in filled.values()) == [[2, 2, 6], [3]]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 64)), st.integers(0, 64))
def test_capacity_tree(rooms, wanted):
    tree = packed_ids.CapacityTree(64)
    for r in rooms:
        tree.add(r, 1)
    assert tree.least(wanted) == min((r for r in rooms if r >= wanted), default=None)


WORDS = st.text(alphabet=st.sampled_from("abcÀéßİſ ŉ'sdlt.,*-_\n\t\x1c ́한1²中"), max_size=40)


@settings(max_examples=300, deadline=None)
@given(WORDS)
def test_word_encoder_gives_the_tokenizers_ids(text):
    if not hasattr(test_word_encoder_gives_the_tokenizers_ids, "known"):
        path = tokenizer_path()
        test_word_encoder_gives_the_tokenizers_ids.known = tokens.WordEncoder(path), Tokenizer.from_file(path)
    encoder, tokenizer = test_word_encoder_gives_the_tokenizers_ids.known
    for t in (text, text + "<|endoftext|>" + text):
        expected = tokenizer.encode(t, add_special_tokens=False).ids if t else []
        assert encoder(t.encode()).tolist() == [*expected, 0]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.none() | WORDS | st.sampled_from(["a<|endoftext|>b", "<|ENDOFTEXT|>", "É<|EndOfText|>"]), max_size=8), st.data())
def test_texts_encoded_together_are_as_each_alone(texts, data):
    encoder = tokens.kept_encoder(tokenizer_path())
    a = data.draw(st.integers(0, len(texts)))
    column = pa.array([*texts, "beyond"], data.draw(st.sampled_from([pa.string(), pa.large_string()])))[a : len(texts)]
    assert [ids.tolist() for ids in encoder.all(column)] == [encoded(t) for t in texts[a:]]


def test_long_texts_are_cut_at_white_space(monkeypatch):
    monkeypatch.setattr(tokens, "LOT_BYTES", 5)
    texts = ["a b", "  some é longer \n text, without end", "x" * 40, None, "tail  ", "y <|endoftext|> z of it", "", " " * 12]
    for end in (0, None):
        encoder = tokens.WordEncoder(tokenizer_path(), end)
        wanted = [encoded(t)[: None if end == 0 else -1] for t in texts]
        assert [ids.tolist() for ids in encoder.all(pa.array(texts))] == wanted


def test_texts_that_are_no_utf8_are_encoded():
    encoder = tokens.kept_encoder(tokenizer_path())
    column = pa.array([b"a\xc3", b"\xa9b, \xc3,", b"\xc3\xa9 ok"], pa.binary())
    wanted = [encoded(t.decode(errors="replace")) for t in column.to_pylist()]
    assert [ids.tolist() for ids in encoder.all(column)] == wanted


def test_words_with_marks_are_encoded_once(monkeypatch):
    monkeypatch.setattr(tokens, "LOT_BYTES", 8)
    encoder = tokens.WordEncoder(tokenizer_path())
    column = pa.array(["Wörter, wörter. wörter!", None, "wörter", "more,wörter ,", "more"])
    assert [ids.tolist() for ids in encoder.all(column)] == [encoded(t) for t in column.to_pylist()]
    assert sorted(encoder.code) == sorted(t.encode() for t in ("wörter", "more", ",", ".", "!"))
    monkeypatch.setattr(tokens, "REMEMBERED", 2)
    assert [ids.tolist() for ids in encoder.all(column)] == [encoded(t) for t in column.to_pylist()]


@cache
def whole_tokenizer():
    return Tokenizer.from_file(tokenizer_path())


def encoded(text):
    return [*(whole_tokenizer().encode(text, add_special_tokens=False).ids if text else []), 0]


def digest(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def check_pieces(rows, documents, limit):
    """Every document's ids in its pieces; every sequence gapless and within the limit."""
    wanted = sorted(
        (str(i), k, s, len(ids[s : s + limit]), digest(ids[s : s + limit]))
        for i, ids in ((i, encoded(t)) for i, t in documents)
        for k, s in enumerate(range(0, len(ids), limit))
    )
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in rows) == wanted
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for pieces in by.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= limit
    return len(by)


@pytest.mark.parametrize("limit", [7, 2048])
def test_pack_odd_documents(spark, limit):
    rows = best_two_fit.pack_documents(docs(spark, ODD), tokenizer_path(), limit=limit).collect()
    check_pieces(rows, ODD, limit)


def test_pack_query(spark):
    documents = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    rows = QUERIES["op4_best_two_fit"](spark, FOLDER).collect()
    total = sum(r.length for r in rows)
    assert check_pieces(rows, documents, 2048) <= -(-total // 2048) + 1


def test_pack_nothing(spark):
    empty = docs(spark, [])
    assert best_two_fit.pack_documents(empty, tokenizer_path()).count() == 0
    assert packed_ids.pack_ids(empty, tokenizer_path()).count() == 0


def unpacked(rows, limit):
    got = defaultdict(list)
    for r in rows:
        ids, positions = np.frombuffer(r.input_ids, "<u4"), np.frombuffer(r.position_ids, "<u2")
        assert len(ids) == len(positions) == limit and r.cu_seqlens[-1] == r.n_tokens <= limit
        assert not ids[r.n_tokens :].any() and not positions[r.n_tokens :].any()
        for a, b, doc, piece, start in zip(r.cu_seqlens, r.cu_seqlens[1:], r.doc_ids, r.pieces, r.starts):
            assert positions[a:b].tolist() == list(range(b - a)) and start == piece * limit
            got[str(doc)].append((piece, ids[a:b].tolist()))
    return got


@pytest.mark.parametrize("limit, block", [(16, 100), (2048, 4_000_000)])
def test_matrix_round_trip(spark, tmp_path, limit, block):
    packed = packed_ids.pack_ids(docs(spark, ODD), tokenizer_path(), limit=limit, block_tokens=block)
    packed_ids.write_matrices(packed, str(tmp_path / "m"))
    rows = spark.read.parquet(str(tmp_path / "m")).collect()
    assert len({r.sequence_id for r in rows}) == len(rows)
    wanted = defaultdict(list)
    for i, t in ODD:
        ids = encoded(t)
        wanted[str(i)] += [(k, ids[s : s + limit]) for k, s in enumerate(range(0, len(ids), limit))]
    got = unpacked(rows, limit)
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in wanted.items()}


def test_matrix_query(spark):
    rows = QUERIES["op1_packed_ids"](spark, FOLDER).collect()
    got = unpacked(rows, 2048)
    for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect():
        assert [x for _, ids in sorted(got[str(r.doc_id)]) for x in ids] == encoded(r.text)


def test_lengths_of_one_kind_are_ranked_apart(spark):
    cut = spark.createDataFrame([(i, 0, 0, 5, i) for i in range(500)], "doc_id long, piece int, start long, length long, ids_crc32 long")
    rows = placing.placed(cut, lambda c: best_two_fit.best_two_fit(c, 20), cells=4).collect()
    assert len({(r.sequence_id, r.offset) for r in rows}) == 500 and len({r.sequence_id for r in rows}) == 125


def test_tasks_of_a_worker_share_an_encoder():
    path = tokenizer_path()
    encode = tokens.kept_encoder(path)
    assert tokens.kept_encoder(path) is encode and tokens.kept_encoder(path, None) is not encode
    words = [t.encode() for t in ("some words twice, some", "other words; É", "")]
    once = [encode(t).tolist() for t in words]
    encode.forget()
    assert [encode(t).tolist() for t in words[::-1]] == once[::-1]
