from __future__ import annotations

import struct
import zlib
from collections import defaultdict

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from creditloom.llm import common, packing

PATH = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(PATH)
ENCODER = packing.Encoder(PATH)


def plain_ids(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([*"aAbzZ09'std vell\t\n\r\x0b\x1c\x1f\x85\xa0.,-_<|>!éÉßİıΣσ²½",
    "<|endoftext|>", "'s", "\u0301", "\u200b", "漢", "😀", "Ā", "ſ", "Ⱥ"]), max_size=40).map("".join))
def test_words_give_the_tokenizers_ids(text):
    ids = plain_ids(text)
    assert ENCODER.encode([text]) == [struct.pack(f"<{len(ids)}I", *ids)]


def test_cache_is_bounded(monkeypatch):
    monkeypatch.setattr(packing, "WORD_CACHE", 50)
    encoder = packing.Encoder(PATH)
    texts = [" ".join(f"w{i * 7 + j}" for j in range(20)) for i in range(30)]
    for text in texts:
        ids = plain_ids(text)
        assert encoder.encode([text]) == [struct.pack(f"<{len(ids)}I", *ids)]
        for cache in (encoder.chunks, encoder.known):
            assert len(cache.now) <= 50 and len(cache.before) <= 70


def test_what_is_met_again_is_remembered(monkeypatch):
    monkeypatch.setattr(packing, "WORD_CACHE", 50)
    encoder = packing.Encoder(PATH)
    learned = []
    learn = encoder._know
    monkeypatch.setattr(encoder, "_know", lambda new: (learned.extend(new), learn(new)))
    for i in range(40):
        encoder.encode(["often met " + " ".join(f"x{i * 20 + j}" for j in range(20))])
    assert learned.count("often") == 1


TEXTS = [None, "", "one", "twice", "twice", "w " * 2047, "w " * 2048, "w " * 9000, *[
    f"text {i} " * (i % 90) for i in range(400)]]


class Unwalked(dict):
    """A mapping that may be asked and not walked through."""

    def __iter__(self):
        raise AssertionError("walked through all that is remembered")


def test_words_are_cut_and_asked_for_once(monkeypatch):
    """A text costs what it holds: its words are not cut by chunk, nor the memory walked."""
    encoder = packing.Encoder(PATH)
    cut, words = [], packing._words
    monkeypatch.setattr(packing, "_words", lambda text: cut.append(text) or words(text))
    text = ", ".join(f"Word{i}'s \u00e9t\u00e9" for i in range(300))
    encoder.encode(["other words of before"])
    encoder.known.before, encoder.known.now = Unwalked(encoder.known.now), {}
    encoder.chunks.before = Unwalked(encoder.chunks.now)
    ids = plain_ids(text)
    assert encoder.encode([text]) == [struct.pack(f"<{len(ids)}I", *ids)]
    assert cut[1:] == [text] and not encoder.chunks.now


def test_latin_words_in_other_texts():
    for text in ("It\u2019s DON'T \u201cquoted\u201d\xa0Stra\u00dfe \u2014 x", "\u0130x A'S <|endoftext|> B"):
        ids = plain_ids(text)
        assert packing.Encoder(PATH).encode([text]) == [struct.pack(f"<{len(ids)}I", *ids)]


def test_pieces_and_places(documents, clashing):
    docs = clashing(documents(TEXTS))
    rows = packing.pack_documents(docs, PATH).collect()
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
    assert set(by_doc) == set(range(len(TEXTS)))
    for doc, text in enumerate(TEXTS):
        ids = [*plain_ids(text), 0]
        parts = sorted(by_doc[doc], key=lambda r: r.piece)
        assert [r.piece for r in parts] == list(range(-(-len(ids) // 2048)))
        for r in parts:
            own = ids[r.start : r.start + 2048]
            assert (r.start, r.length) == (2048 * r.piece, len(own))
            assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(own)}I", *own))
    filled = check_places(rows)
    assert len(filled) <= 1.02 * sum(filled.values()) / 2048 + 1


def check_places(rows):
    at = defaultdict(list)
    for r in rows:
        at[r.sequence_id].append((r.offset, r.length))
    filled = {}
    for sequence, spans in at.items():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= 2048
        filled[sequence] = end
    return filled


def test_many_shards_and_few_bins(documents):
    parts = packing.pieces(documents(TEXTS), PATH)
    rows = packing.pack(parts, bins=2, per_shard=40).collect()
    check_places(rows)
    assert len({r.sequence_id >> 40 for r in rows}) > 5


def test_sequences_hold_the_ids(documents):
    packed = packing.pack(packing.pieces(documents(TEXTS[:20]), PATH))
    wanted = defaultdict(dict)
    for r in packed.collect():
        wanted[r.sequence_id][r.offset] = bytes(r.ids)
    got = {r.sequence_id: (bytes(r.ids), r.length) for r in packing.sequences(packed).collect()}
    for sequence, parts in wanted.items():
        ids = b"".join(parts[o] for o in sorted(parts))
        assert got[sequence] == (ids, len(ids) // 4)


def test_no_documents(documents):
    assert packing.pack_documents(documents([]), PATH).collect() == []


@given(st.lists(st.integers(1, 50), max_size=200), st.integers(1, 8))
@settings(deadline=None)
def test_bins_take_the_tightest(sizes, limit):
    bins, fresh, free = packing.Bins(50, limit), 0, {}
    for size in sizes:
        found, offset = bins.put(size, fresh)
        fits = [f for f in free.values() if f >= size]
        if found == fresh:
            assert not fits and offset == 0
            free[found], fresh = 50, fresh + 1
        else:
            assert free[found] == min(fits) and offset == 50 - free[found]
        free[found] -= size
        if not free[found]:
            del free[found]
        if len(free) > limit:  # the fullest closed, one of those
            least = min(free.values())
            open_ = {b for queue in bins.at for b in queue}
            (closed,) = set(free) - open_
            assert free.pop(closed) == least


@pytest.mark.parametrize("size", [1, 2048])
def test_bin_edges(size):
    bins = packing.Bins(2048, 4)
    assert bins.put(size, 9) == (9, 0)
    assert bins.open == (size < 2048)


def test_python_gets_few_texts_at_a_time(spark, documents, monkeypatch):
    whole = packing.slices

    def counted(batches, column):
        for batch in batches:
            assert batch.num_rows <= common.BATCH_ROWS
            yield from whole([batch], column)

    monkeypatch.setattr(packing, "slices", counted)
    docs = documents([f"w{n}" for n in range(2 * common.BATCH_ROWS + 1)]).coalesce(1)
    assert packing.pack_documents(docs, PATH).count() == docs.count()


def test_tasks_end_by_giving_memory_back(spark, documents, monkeypatch, tmp_path):
    monkeypatch.setattr(packing, "give_back", lambda: (tmp_path / "given").touch())
    packing.pack_documents(documents(["a b", None]).coalesce(1), PATH)
    assert (tmp_path / "given").exists()


def test_the_tokenizer_is_asked_for_few_words_at_a_time(monkeypatch):
    """What it answers with takes hundreds of bytes a word."""
    words = [f"w{chr(97 + n % 26)}{chr(97 + n // 26 % 26)}{chr(97 + n // 676)}" for n in range(17_000)]
    encoder, asked = packing.Encoder(PATH), []

    class Counted:
        def encode_batch_fast(self, texts, **options):
            asked.append(sum(len(text.split(" ")) for text in texts))
            return TOKENIZER.encode_batch_fast(texts, **options)

    monkeypatch.setattr(encoder, "tokenizer", Counted())
    text = " ".join(words)
    ids = plain_ids(text)
    assert encoder.encode([text]) == [struct.pack(f"<{len(ids)}I", *ids)]
    assert sum(asked) == len(set(words)) and max(asked) <= 10_000
