"""Exact byte-pair encoding of whole texts in linear time, and decoding through an offset table.

An Aho-Corasick automaton finds the longest token at every place of a word. The encoder walks
the word from left to right with these longest tokens; a token is kept if it is compatible with
the one before it, else the next shorter prefix token is tried, and if none is left the walk steps
back. Two neighbours are compatible if no merge over their border would have come before the merges that
made them, which is read from the table of pairs. The result equals merging by rank.

The new words of a batch take these steps together, as arrays: the automaton's goto table is walked from
all places at once. A word of more than LONG bytes takes them alone. Stretches without white space that were met
before are looked up by a 64-bit hash and compared byte by byte; one that shares its hash with another is kept apart.

Defined cases: a null or empty text has no tokens; the two added tokens are recognised in the text, as the
vocabulary's library does; any other character reaches the byte level, so no text fails.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycast.llm.table import Table
from tallycast.llm.text import byte_class, column_bytes, pieces, spread, words

VOCABULARY = "word_bpe_49k.json"
# The word pattern of the vocabulary file, and the white space it drops.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SPACE_PATTERN = r"[\t-\r \x85\xa0  -     　]+"
CACHED_CHUNKS = 1 << 19
LONG = 200  # bytes
LAST = 0x100000  # added to the code of a word's last character, which carries the end of the word
CHUNK = byte_class([b for b in range(256) if b not in b" \t\n\x0b\x0c\r"], lower=False)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class Encoder:
    """A vocabulary file's merges as automaton, pair table and offset table."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab, suffix = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"]
        added = {token["content"]: token["id"] for token in spec["added_tokens"]}
        letters = byte_letters()
        byte_of = {letter: b for b, letter in enumerate(letters)}

        def form(token: str) -> str:
            """One character for each byte; the last byte of a word counts LAST more."""
            ends = token.endswith(suffix) and token != suffix
            codes = [byte_of[x] for x in (token[: -len(suffix)] if ends else token)]
            if ends:
                codes[-1] += LAST
            return "".join(map(chr, codes))

        size = max([*vocab.values(), *added.values()]) + 1
        self.rank = np.full(size, -1, np.int64)
        self.left, self.right = np.zeros(size, np.int64), np.zeros(size, np.int64)
        self.shorter, self.size = np.full(size, -1, np.int64), np.zeros(size, np.int64)
        pairs = []
        for order, (a, b) in enumerate(spec["model"]["merges"]):
            first, second, whole = vocab[a], vocab[b], vocab[a + b]
            self.rank[whole], self.left[whole], self.right[whole] = order, first, second
            pairs.append(first << 20 | second)
        self.joined = Table.of(pairs, range(len(pairs)))
        forms = {form(token): number for token, number in vocab.items()}
        self.automaton = ahocorasick.Automaton()
        steps: dict[tuple[int, int], int] = {}
        token_at = [-1]
        for text, number in sorted(forms.items()):
            self.automaton.add_word(text, number)
            self.size[number] = len(text)
            state = 0
            for at, letter in enumerate(text):
                symbol = ord(letter) % LAST + 256 * (ord(letter) >= LAST)
                if (state, symbol) not in steps:
                    steps[state, symbol] = len(token_at)
                    token_at.append(-1)
                state = steps[state, symbol]
                if at < len(text) - 1 and token_at[state] >= 0:
                    self.shorter[number] = token_at[state]
            token_at[state] = number
        self.automaton.make_automaton()
        self.goto = Table.of([state << 9 | symbol for state, symbol in steps], steps.values())
        self.token_at = np.array(token_at)
        self.words = regex.compile(WORD_PATTERN.replace(r"\s", SPACE_PATTERN[1:-2]) + "| ")
        self.marks = regex.compile("(" + "|".join(map(regex.escape, added)) + ")")
        self.added = added
        spelled = [""] * size
        for token, number in [*vocab.items(), *added.items()]:
            spelled[number] = token
        raw = [(token + " ").encode() for token in spelled]
        self.spelling = np.frombuffer(b"".join(raw), np.uint8)
        self.spelling_size = np.array([len(x) for x in raw], np.int64)
        self.spelling_start = np.cumsum(self.spelling_size) - self.spelling_size
        self.forget()

    def forget(self) -> None:
        self.codes = Table(2 * CACHED_CHUNKS)
        self.flat = np.zeros(0, np.uint32)
        self.starts, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.spelt = np.zeros(0, np.uint8)  # the known stretches' bytes
        self.spelt_start, self.spelt_size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.apart: dict[bytes, int] = {}  # stretches whose hash is another one's

    def fits(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether each ``right`` may follow its ``left``: goes back over the merges on both sides of the border."""
        answer = np.ones(len(left), bool)
        at = np.arange(len(left))
        left_until = np.full(len(left), len(self.rank))
        right_until = left_until.copy()
        while len(at):
            across = self.joined.get(left.astype(np.uint64) << np.uint64(20) | right.astype(np.uint64))
            no = (across >= 0) & (across < left_until) & (across <= right_until)
            answer[at[no]] = False
            rank_left, rank_right = self.rank[left], self.rank[right]
            undo_left = rank_left > rank_right
            undo_right = ~undo_left & (rank_right >= 0)
            left_until = np.where(undo_left, rank_left, left_until)
            right_until = np.where(undo_right, rank_right, right_until)
            left, right = np.where(undo_left, self.right[left], left), np.where(undo_right, self.left[right], right)
            go = ~no & (undo_left | undo_right)
            at, left, right, left_until, right_until = at[go], left[go], right[go], left_until[go], right_until[go]
        return answer

    def longest(self, symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The longest token that begins at each place; ``ends`` holds the end of the place's word."""
        found = np.full(len(symbols), -1)
        at = np.arange(len(symbols))
        state, depth = np.zeros(len(symbols), np.int64), 0
        while len(at):
            state = self.goto.get(state.astype(np.uint64) << np.uint64(9) | symbols[at + depth].astype(np.uint64))
            go = state >= 0
            at, state = at[go], state[go]
            token = self.token_at[state]
            found[at[token >= 0]] = token[token >= 0]
            depth += 1
            go = at + depth < ends[at]
            at, state = at[go], state[go]
        return found

    def together(self, data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of words that lie one after the other in ``data``, and the token count of each."""
        stop = np.cumsum(lengths)
        start = stop - lengths
        symbols = data.astype(np.int64)
        symbols[stop - 1] += 256
        longest = self.longest(symbols, np.repeat(stop, lengths))
        chosen, before = np.full(len(data), -1), np.full(len(data) + 1, -1)
        dead = np.zeros(len(data) + 1, bool)
        first, last, at, token, last_token = start, stop, start.copy(), longest[start], np.full(len(start), -1)
        while len(at):
            stuck = token < 0
            if stuck.any():
                dead[at[stuck]] = True
                back = before[at[stuck]]
                popped = chosen[back]
                earlier = before[back]
                at[stuck], token[stuck] = back, self.shorter[popped]
                last_token[stuck] = np.where(back > first[stuck], chosen[earlier], -1)
            trying = np.flatnonzero(token >= 0)
            end = at[trying] + self.size[token[trying]]
            good = ~dead[end]
            check = np.flatnonzero(good & (last_token[trying] >= 0))
            good[check] = self.fits(last_token[trying[check]], token[trying[check]])
            took, not_took = trying[good], trying[~good]
            chosen[at[took]], before[end[good]] = token[took], at[took]
            last_token[took], at[took] = token[took], end[good]
            token[not_took] = self.shorter[token[not_took]]
            going = at < last
            moved = took[going[took]]
            token[moved] = longest[at[moved]]
            first, last, at, token, last_token = first[going], last[going], at[going], token[going], last_token[going]
        on_path = np.zeros(len(data), bool)
        at, last = start, stop
        while len(at):
            on_path[at] = True
            at = at + self.size[chosen[at]]
            at, last = at[at < last], last[at < last]
        return chosen[on_path], np.add.reduceat(on_path, start, dtype=np.int64)

    def alone(self, raw: bytes) -> list[int]:
        """The same for one word, with the automaton's own search."""
        text = raw[:-1].decode("latin-1") + chr(raw[-1] + LAST)
        longest = np.full(len(text), -1)
        for end, token in self.automaton.iter(text):
            longest[end + 1 - self.size[token]] = token
        out: list[int] = []
        compatible: dict[tuple[int, int], bool] = {}
        dead = set()
        at, token = 0, int(longest[0])
        while True:
            if token < 0:
                dead.add(at)
                popped = out.pop()
                at, token = at - int(self.size[popped]), int(self.shorter[popped])
                continue
            end = at + int(self.size[token])
            if end not in dead and out:
                pair = (out[-1], token)
                if pair not in compatible:
                    compatible[pair] = bool(self.fits(np.array([out[-1]]), np.array([token]))[0])
                good = compatible[pair]
            else:
                good = end not in dead
            if not good:
                token = int(self.shorter[token])
                continue
            out.append(token)
            at = end
            if at == len(text):
                return out
            token = int(longest[at])

    def plain(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of stretches of text, in a row, and the token count of each."""
        text = " ".join(chunks)
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
        text = "".join(map(str.lower, text)) if "\u03a3" in text else text.lower()
        raw = np.frombuffer(("\n".join(self.words.findall(text)) + "\n").encode("utf-8", "surrogatepass"), np.uint8)
        ends = np.flatnonzero(raw == 10)
        begins = np.concatenate([[0], ends[:-1] + 1])
        border = (ends - begins == 1) & (raw[begins] == 32)
        chunk = np.cumsum(border)[~border]
        begins, lengths = begins[~border], (ends - begins)[~border]
        counts = np.zeros(len(chunks), np.int64)
        if not len(begins) or not lengths[0]:
            return np.zeros(0, np.int64), counts
        long = np.flatnonzero(lengths > LONG)
        short = np.flatnonzero(lengths <= LONG)
        each = np.zeros(len(lengths), np.int64)
        tokens = np.zeros(0, np.int64)
        if len(short):
            tokens, each[short] = self.together(raw[spread(begins[short], lengths[short])], lengths[short])
        if len(long):
            apart = [self.alone(raw[begins[i] : begins[i] + lengths[i]].tobytes()) for i in long]
            each[long] = [len(x) for x in apart]
            place = np.cumsum(each) - each
            merged = np.zeros(int(each.sum()), np.int64)
            merged[spread(place[short], each[short])] = tokens
            merged[spread(place[long], each[long])] = np.concatenate(apart)
            tokens = merged
        np.add.at(counts, chunk, each)
        return tokens, counts

    def marked(self, chunk: str) -> list[int]:
        """Tokens of a stretch that holds added tokens."""
        out: list[int] = []
        for part in self.marks.split(chunk):
            out.extend([self.added[part]] if part in self.added else self.plain([part])[0].tolist())
        return out

    def learn(self, pieces: list[bytes]) -> np.ndarray:
        """Encode stretches that are not known yet, keep their bytes and tokens, and return their numbers."""
        chunks = [piece.decode("utf-8", "surrogatepass") for piece in pieces]
        odd = [i for i, chunk in enumerate(chunks) if "<|" in chunk and self.marks.search(chunk)]
        apart = {i: self.marked(chunks[i]) for i in odd}
        for i in odd:
            chunks[i] = ""
        tokens, counts = self.plain(chunks)
        begins = np.cumsum(counts) - counts + len(self.flat)
        rest = [tokens.astype(np.uint32)]
        used = len(self.flat) + len(tokens)
        for i, ids in apart.items():
            begins[i], counts[i] = used, len(ids)
            rest.append(np.array(ids, np.uint32))
            used += len(ids)
        sizes = np.array([len(piece) for piece in pieces], np.int64)
        self.spelt_start = np.concatenate([self.spelt_start, np.cumsum(sizes) - sizes + len(self.spelt)])
        self.spelt_size = np.concatenate([self.spelt_size, sizes])
        self.spelt = np.concatenate([self.spelt, np.frombuffer(b"".join(pieces), np.uint8)])
        numbers = np.arange(len(pieces)) + len(self.starts)
        self.flat = np.concatenate([self.flat, *rest])
        self.starts, self.counts = np.concatenate([self.starts, begins]), np.concatenate([self.counts, counts])
        return numbers

    def other_than_known(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The places of stretches whose bytes aren't those kept under their hash."""
        differ = lengths != self.spelt_size[codes]
        at = np.flatnonzero(~differ)
        if len(at):
            sizes = lengths[at]
            same = data[spread(starts[at], sizes)] == self.spelt[spread(self.spelt_start[codes[at]], sizes)]
            differ[at] = ~np.logical_and.reduceat(same, np.cumsum(sizes) - sizes)
        return np.flatnonzero(differ)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of the texts that ``offsets`` cuts ``data`` into, in a row, and the offsets of each text's ids."""
        found = words(data, offsets, CHUNK)
        codes = self.codes.get(found.hashes)
        if (codes < 0).any():
            if len(self.starts) > CACHED_CHUNKS:
                self.forget()
                codes[:] = -1
            new, at = np.unique(found.hashes[codes < 0], return_index=True)
            at = np.flatnonzero(codes < 0)[at]
            raw = data.tobytes()
            begins, ends = found.starts[at], found.starts[at] + found.lengths[at]
            self.codes.put(new, self.learn([raw[a:b] for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]))
            codes[codes < 0] = self.codes.get(found.hashes[codes < 0])
        for i in self.other_than_known(data, found.starts, found.lengths, codes).tolist():
            piece = data[found.starts[i] : found.starts[i] + found.lengths[i]].tobytes()
            if piece not in self.apart:
                self.apart[piece] = int(self.learn([piece])[0])
            codes[i] = self.apart[piece]
        counts = self.counts[codes]
        ids = self.flat[spread(self.starts[codes], counts)]
        return ids, np.concatenate([[0], np.cumsum(counts)])[found.first]

    def decode(self, ids: np.ndarray) -> bytes:
        """The tokens' spellings with a blank between them, as UTF-8."""
        counts = self.spelling_size[ids]
        return self.spelling[spread(self.spelling_start[ids], counts)].tobytes()[:-1]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker process and file."""
    return Encoder(path)


def encode_decode(docs: DataFrame, path: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode every text and decode the ids again: key, token count, and digests of ids and decoded text.

    One pass over the texts without a shuffle. Rows of equal or null keys are each returned; other columns are not read.
    """
    path = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for batch in pieces(batches, "text", 1 << 20):
            ids, offsets = coder.encode(*column_bytes(batch.column("text")))
            rows = [ids[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    pa.array(np.diff(offsets), pa.int64()),
                    pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in rows], pa.string()),
                    pa.array([hashlib.sha256(coder.decode(x)).hexdigest() for x in rows], pa.string()),
                ],
                names=["key", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = docs.schema[key].dataType.simpleString()
    return (
        docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
        .mapInArrow(run, f"key {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
        .withColumnRenamed("key", key)
    )
