import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tallycast.llm import bpe, packing
from tallycast.llm.text import column_bytes, words
from tests.llm.helpers import documents, empty_documents, odd_documents, sha

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def texts():
    rng = random.Random(5)
    letters = [chr(x) for x in range(0x250)] + list("''''   streveml'd<|endoftext|>　\xa0ßİΣς́ͅ漢\U0001f600\x1c\x85 ")
    made = ["".join(rng.choices(letters, k=rng.randint(0, 60))) for _ in range(1500)]
    made += ["", "<|endoftext|>a<|startoftext|> <|endoftext", "ΑΣ ΑΣ.", "a" * 900, "ab" * 700, "don't I'LL we'Re '''s", "aaaa " * 30]
    return made


def test_ids_and_decoded_text_equal_the_librarys(library):
    made = texts()
    coder = bpe.Encoder(PATH)
    for _ in range(2):  # the second time everything is known
        ids, offsets = coder.encode(*column_bytes(pa.array(made)))
        for i, want in enumerate(library.encode_batch(made, add_special_tokens=False)):
            got = ids[offsets[i] : offsets[i + 1]]
            assert got.tolist() == want.ids, made[i]
            assert coder.decode(got).decode() == library.decode(want.ids, skip_special_tokens=False)


def test_forgetting_known_words_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_CHUNKS", 64)
    coder = bpe.Encoder(PATH)
    for text in texts()[:200]:
        ids, _ = coder.encode(*column_bytes(pa.array([text])))
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids


def test_codec_over_odd_rows(spark, library):
    docs = odd_documents(spark)
    got = sorted((r.doc_id or -1, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.encode_decode(docs).collect())
    want = []
    for r in docs.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        raw = np.array(ids, "<u4").tobytes()
        want.append((r.doc_id or -1, len(ids), sha(raw), sha(library.decode(ids, skip_special_tokens=False))))
    assert got == sorted(want)
    assert bpe.encode_decode(empty_documents(spark)).count() == 0


def brute_best_fit(lengths, capacity):
    room = []
    for size in sorted(lengths, reverse=True):
        fitting = [r for r in room if r >= size]
        if fitting:
            room[room.index(min(fitting))] -= size
        else:
            room.append(capacity - size)
    return sorted(room)


@pytest.mark.parametrize("seed", range(6))
def test_plan_is_best_fit_decreasing(seed):
    rng = random.Random(seed)
    lengths = [rng.choice([rng.randint(1, 40), rng.randint(1, 6), 33]) for _ in range(300)]
    counts = {x: lengths.count(x) for x in set(lengths)}
    room, ranks = {}, {}
    for length, rank, number, first, offset in packing.plan(counts, 40).tolist():
        assert ranks.get(length, 0) == rank
        ranks[length] = rank + number
        for sequence in range(first, first + number):
            assert room.get(sequence, 0) == offset
            room[sequence] = offset + length
    assert ranks == counts
    assert sorted(40 - used for used in room.values()) == brute_best_fit(lengths, 40)


def test_tree_finds_the_tightest():
    tree = packing.TightestTree(40)
    open_ = set()
    rng = random.Random(3)
    for _ in range(400):
        capacity = rng.randint(1, 40)
        open_ ^= {capacity}
        tree.mark(capacity, capacity in open_)
        for size in range(1, 41):
            assert tree.tightest(size) == min((x for x in open_ if x >= size), default=None)


def check_packing(rows, docs, library, capacity):
    want = []
    for r in docs.collect():
        ids = [*library.encode(r.text or "", add_special_tokens=False).ids, 1]
        for start in range(0, len(ids), capacity):
            part = ids[start : start + capacity]
            want.append((r.doc_id or -1, start // capacity, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert sorted((r.doc_id or -1, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)
    filled = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert filled.get(r.sequence_id, 0) == r.offset
        filled[r.sequence_id] = r.offset + r.length
        assert filled[r.sequence_id] <= capacity
    assert len(filled) == len(brute_best_fit([x[3] for x in want], capacity))


def test_packing_over_odd_rows(spark, library):
    docs = odd_documents(spark)
    check_packing(packing.pack(docs).collect(), docs, library, 4096)
    assert packing.pack(empty_documents(spark)).count() == 0


def test_packing_over_many_tasks(spark, library):
    rng = random.Random(2)
    docs = documents(spark, [" ".join(rng.choices(["the", "cat", "sat"], k=rng.choice([3, 3, rng.randint(0, 200)]))) for _ in range(300)])
    docs = docs.repartition(5)
    check_packing(packing.pack(docs, capacity=64).collect(), docs, library, 64)


def test_one_text_may_bring_more_words_than_are_kept(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_CHUNKS", 64)
    coder = bpe.Encoder(PATH)
    # Enough slots for the words held and those of one more short text, far too few for the long one.
    assert len(coder.codes.keys) < 1000
    for text in ["a few words before", " ".join(f"w{i}" for i in range(1000)), "and a few after w7"]:
        ids, _ = coder.encode(*column_bytes(pa.array([text])))
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids


def complement_pair():
    """Two words that any hash by powers of an odd base modulo 2**64 takes for one."""
    word = "a"
    while len(word) < 1024:
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


def test_structured_words_are_told_apart(library):
    pair = complement_pair()
    found = words(*column_bytes(pa.array([" ".join(pair)])))
    assert len(set(found.hashes.tolist())) == 2
    coder = bpe.Encoder(PATH)
    for text in [*pair, " ".join(pair)]:
        ids, _ = coder.encode(*column_bytes(pa.array([text])))
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids


def test_words_of_one_hash_are_told_apart(library, monkeypatch):
    def colliding(data, offsets, kind):
        found = words(data, offsets, kind)
        found.hashes &= np.uint64(7)
        return found

    monkeypatch.setattr(bpe, "words", colliding)
    coder = bpe.Encoder(PATH)
    for _ in range(2):
        for made in (texts()[:150], ["ab ba ab cd " * 3, "<|endoftext|> ab", ""]):
            ids, offsets = coder.encode(*column_bytes(pa.array(made)))
            for i, want in enumerate(library.encode_batch(made, add_special_tokens=False)):
                assert ids[offsets[i] : offsets[i + 1]].tolist() == want.ids, made[i]
