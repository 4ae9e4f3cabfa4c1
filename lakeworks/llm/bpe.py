"""Byte-level BPE encoding and decoding with a minimal acyclic transducer as lexicon.

A first pass counts words over all documents. The frequent ones are encoded once and
compiled into a minimal acyclic automaton: words share prefixes and suffixes, arcs
carry numbers whose sum along a path is the word's rank, and the rank leads to the
word's ids. The automaton is one file in the shared scratch folder that Spark hands to
every executor, where the Python workers map it into memory. Pre-tokens that it does
not accept are merged exactly by the rules of the vocabulary, all those of a slice of texts at
once, so which words are in the lexicon changes the time taken and never the ids. Ids are decoded by
one gather over the bytes of the vocabulary.

Defined cases: a null or empty text has no tokens and decodes to the empty text; equal
rows get equal results; a special token's string in a text is that token.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import mmap
import re
import struct
import uuid
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from ..session import scratch_root
from .frames import unused, without
from .text import row_slices

# Fixed value: how byte-level vocabularies of this family cut texts.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# A lexicon word makes up at least this share of the words of some task; the words with
# the highest counts are taken, up to the bound.
SHARE = 2.0 ** -17
LEXICON_WORDS = 1 << 16
# Segments a worker remembers before it starts afresh, and words a task counts at once.
REMEMBERED = 1 << 17
# Words up to so many bytes are merged side by side, so many at once; ids that are gathered at once.
LONGEST, MERGED, GATHERED = 40, 1 << 14, 1 << 18
# Bytes of text that are handled at once: the more, the fewer segments are looked up again.
SLICE = 2 << 20
NO_PAIR = 1 << 62
# A multiplicative hash of pairs of ids.
HASH, HASH_SHIFT, HASH_MASK = 0x9E3779B97F4A7C15 - (1 << 64), 40, (1 << 20) - 1


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in vocabulary files."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}


def gathered(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray, codes: np.ndarray) -> bytes:
    """The runs ``values[starts[c]:starts[c] + sizes[c]]`` of all codes, one after the other."""
    parts = []
    for at in range(0, len(codes), GATHERED):
        some = codes[at:at + GATHERED]
        size = sizes[some]
        ends = np.cumsum(size)
        parts.append(values[np.repeat(starts[some] - ends + size, size) + np.arange(int(size.sum()))].tobytes())
    return b"".join(parts)


def blocks(words: list[bytes]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """Words up to ``LONGEST`` bytes, those of like length together: their numbers, their bytes as columns, their lengths."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(sizes, kind="stable")
    order = order[(sizes[order] > 0) & (sizes[order] <= LONGEST)]
    for at in range(0, len(order), MERGED):
        some = order[at:at + MERGED]
        width, numbers = int(sizes[some[-1]]), some.tolist()
        letters = np.frombuffer(b"".join([words[i].ljust(width, b"\0") for i in numbers]), np.uint8).reshape(len(some), width)
        yield numbers, np.ascontiguousarray(letters.T), sizes[some]


class Merges:
    """The vocabulary: ids of bytes, ranked merges of id pairs, special tokens, bytes of ids."""

    def __init__(self, file: bytes):
        data = json.loads(file)
        vocab = data["model"]["vocab"]
        of_letter = {c: b for b, c in byte_letters().items()}
        self.byte_ids = [vocab[byte_letters()[b]] for b in range(256)]
        self.pairs = {}  # two ids in one number, to the merge's rank and the new id in one number
        for rank, merge in enumerate(data["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self.pairs.setdefault(vocab[left] << 20 | vocab[right], rank << 20 | vocab[left + right])
        self.bytes_of = {i: bytes(of_letter[c] for c in token) for token, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.bytes_of |= {i: t.encode() for t, i in self.special.items()}
        self.letter_ids = np.array(self.byte_ids, np.int64)
        self.pair_keys = np.array(sorted(self.pairs) or [-2], np.int64)
        values = np.array([self.pairs.get(k, NO_PAIR) for k in self.pair_keys.tolist()], np.int64)
        # The place of a pair goes between its rank and its new id: so the least of a word is the leftmost of the lowest rank.
        self.pair_values = np.where(values == NO_PAIR, NO_PAIR, values >> 20 << 26 | values & 0xFFFFF)
        self.marks = np.zeros(HASH_MASK + 1, bool)  # pairs whose mark is missing are none
        self.marks[self.pair_keys * HASH >> HASH_SHIFT & HASH_MASK] = True
        self.letter_pairs = self._looked_up(np.repeat(self.letter_ids, 256), np.tile(self.letter_ids, 256), np.zeros(1 << 16, np.int64)).reshape(256, 256)
        # The bytes of all ids in one block.
        self.lengths, self.starts = (np.zeros(max(self.bytes_of) + 1, np.int64) for _ in range(2))
        for i, b in self.bytes_of.items():
            self.lengths[i] = len(b)
        self.starts[1:] = np.cumsum(self.lengths)[:-1]
        self.letters = np.frombuffer(b"".join(self.bytes_of[i] for i in sorted(self.bytes_of)), np.uint8)
        self.cut = regex.compile(PRE_TOKEN).findall
        longest_first = sorted(self.special, key=len, reverse=True)
        self.split = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")").split if longest_first else None

    def merge(self, word: bytes) -> list[int]:
        """Ids of one pre-token: the lowest-ranked pair first, the leftmost of equal ones."""
        ids = [self.byte_ids[b] for b in word]
        if len(ids) > LONGEST:
            return self._merge_long(ids)
        get, none = self.pairs.get, NO_PAIR
        found = [get(a << 20 | b, none) for a, b in zip(ids, ids[1:])]
        while found:
            best = min(found)
            if best == none:
                break
            i = found.index(best)
            ids[i:i + 2] = [best & 0xFFFFF]
            del found[i]
            if i:
                found[i - 1] = get(ids[i - 1] << 20 | ids[i], none)
            if i < len(found):
                found[i] = get(ids[i] << 20 | ids[i + 1], none)
        return ids

    def merge_many(self, words: list[bytes]) -> list[bytes]:
        """``merge`` of many words, packed (little-endian, 32 bits an id): a step merges one pair of every word that has one.

        A word is a column. Merged letters stay where they are and are passed over, so a step touches only what it changes.
        """
        out: list[bytes] = [b""] * len(words)
        for i in (i for i, w in enumerate(words) if len(w) > LONGEST):
            out[i] = np.array(self.merge(words[i]), "<u4").tobytes()
        for some, letters, sizes in blocks(words):
            width, n = letters.shape
            # One place more than letters, which stands for what is before the first and after the last one.
            places = np.arange(width + 1)[:, None]
            inside = places < sizes
            ids, found = np.full((width + 1, n), -1), np.full((width + 1, n), NO_PAIR)
            ids[:width][inside[:width]] = self.letter_ids[letters[inside[:width]]]
            values = self.letter_pairs[letters[:-1], letters[1:]]
            found[:width - 1] = np.where(inside[1:width] & (values != NO_PAIR), values | places[:width - 1] << 20, NO_PAIR)
            after = np.where(places + 1 < sizes, places + 1, width)
            before = np.repeat((places - 1) % (width + 1), n, axis=1)
            ids, after, before, flat = ids.ravel(), after.ravel(), before.ravel(), found.ravel()
            while True:
                best = found[:width].min(axis=0)
                rows = np.flatnonzero(best != NO_PAIR)
                if not len(rows):
                    break
                best = best[rows]
                new, at = best & 0xFFFFF, best >> 20 & 63
                left = at * n + rows
                right = after[left] * n + rows
                following, previous = after[right], before[left]
                next_, last = following * n + rows, previous * n + rows
                ids[left], ids[right], flat[right] = new, -1, NO_PAIR
                after[left], before[next_] = following, at
                flat[last] = self._looked_up(ids[last], new, previous)
                flat[left] = self._looked_up(new, ids[next_], at)
            ids = ids.reshape(width + 1, n).T
            left_over = ids >= 0
            data, cuts = ids[left_over].astype("<u4").tobytes(), np.cumsum(np.append(0, 4 * left_over.sum(axis=1))).tolist()
            for i, a, b in zip(some, cuts, cuts[1:]):
                out[i] = data[a:b]
        return out

    def _looked_up(self, left: np.ndarray, right: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Rank, place and new id of pairs, in one number; NO_PAIR where there is none."""
        out, asked = np.full(len(left), NO_PAIR), left << 20 | right
        maybe = np.flatnonzero(self.marks[asked * HASH >> HASH_SHIFT & HASH_MASK] & (left >= 0) & (right >= 0))
        asked = asked[maybe]
        at = np.minimum(np.searchsorted(self.pair_keys, asked), len(self.pair_keys) - 1)
        out[maybe] = np.where(self.pair_keys[at] == asked, self.pair_values[at] | place[maybe] << 20, NO_PAIR)
        return out

    def decode_many(self, packed: list[bytes]) -> list[str]:
        """Texts of packed ids; bytes that are no text become replacement characters."""
        ids = np.frombuffer(b"".join(packed), "<u4")
        ends = np.concatenate([[0], np.cumsum(self.lengths[ids])])
        data, cuts = gathered(self.letters, self.starts, self.lengths, ids), ends[np.cumsum([0] + [len(p) // 4 for p in packed])].tolist()
        return [data[a:b].decode("utf-8", "replace") for a, b in zip(cuts, cuts[1:])]

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap of pairs, for words of any length."""
        pairs, n = self.pairs, len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(pairs[a << 20 | b], i, a, b) for i, (a, b) in enumerate(zip(ids, ids[1:])) if a << 20 | b in pairs]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue  # one of the two was merged meanwhile
            ids[i], ids[j] = pairs[a << 20 | b] & 0xFFFFF, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n and ids[x] << 20 | ids[y] in pairs:
                    heapq.heappush(heap, (pairs[ids[x] << 20 | ids[y]], x, ids[x], ids[y]))
        return [i for i in ids if i >= 0]

    def pieces(self, text: str) -> Iterator[tuple[str, bool]]:
        """The text cut at special tokens, and whether each piece is one."""
        parts = self.split(text) if self.split and any(s in text for s in self.special) else [text]
        return ((p, i % 2 == 1) for i, p in enumerate(parts))


# --- the automaton ---

def compile_lexicon(words: dict[bytes, list[int]]) -> bytes:
    """A minimal acyclic automaton over the words, as one block of bytes.

    Words are added in order; the part of the last word that the next one does not share
    is frozen, and a frozen state equal to an earlier one is replaced by it.
    """
    ordered = sorted(words)
    known: dict[tuple, int] = {}
    arcs_of: list[tuple] = []  # frozen states: (final, ((label, target), ...))
    path: list[tuple[list, list]] = [([False], [])]  # open states of the last word

    def freeze(depth: int) -> None:
        while len(path) > depth + 1:
            final, arcs = path.pop()
            key = (final[0], tuple(arcs))
            if key not in known:
                known[key] = len(arcs_of)
                arcs_of.append(key)
            label = path[-1][1][-1][0]
            path[-1][1][-1] = (label, known[key])

    last = b""
    for word in ordered:
        shared = 0
        while shared < min(len(last), len(word)) and last[shared] == word[shared]:
            shared += 1
        freeze(shared)
        for label in word[shared:]:
            path[-1][1].append((label, -1))
            path.append(([False], []))
        path[-1][0][0] = True
        last = word
    freeze(0)
    arcs_of.append((path[0][0][0], tuple(path[0][1])))  # the start state comes last

    below = np.zeros(len(arcs_of), np.int64)  # words accepted from a state; targets come before their sources
    first, labels, targets, skips = [0], [], [], []
    for s, (final, arcs) in enumerate(arcs_of):
        passed = int(final)
        for label, target in arcs:
            labels.append(label)
            targets.append(target)
            skips.append(passed)
            passed += int(below[target])
        below[s] = passed
        first.append(len(labels))
    ids = [words[w] for w in ordered]
    offsets = np.cumsum([0] + [len(i) for i in ids])
    blocks = [np.array(first), np.array(targets), np.array(skips), np.array([f for f, _ in arcs_of], int), offsets,
              np.array([i for word in ids for i in word], int)]
    head = np.array([len(b) for b in blocks] + [len(labels)], np.uint32)
    return b"".join([head.tobytes(), *(b.astype(np.uint32).tobytes() for b in blocks), bytes(labels)])


class Lexicon:
    """A compiled lexicon mapped from a file."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        sizes = np.frombuffer(self.map, np.uint32, 7).tolist()
        numbers, at = memoryview(self.map)[:28 + 4 * sum(sizes[:6])].cast("I"), 7
        blocks = []
        for size in sizes[:6]:
            blocks.append(numbers[at:at + size])
            at += size
        self.first, self.targets, self.skips, self.final, self.offsets, self.ids = blocks
        self.labels_at = at * 4
        self.start = len(self.final) - 1
        # Arcs by source and label, which is the order they are kept in.
        sources = np.repeat(np.arange(len(self.final)), np.diff(np.asarray(self.first, np.int64)))
        self.arcs = np.append(sources << 8 | np.frombuffer(self.map, np.uint8, len(sources), self.labels_at), -1)
        self.arc_targets, self.arc_skips = (np.append(np.asarray(b, np.int64), 0) for b in (self.targets, self.skips))
        self.accepts = np.asarray(self.final, bool)

    def find(self, word: bytes) -> list[int] | None:
        """Ids of the word, or None if it is not in the lexicon."""
        state, rank = self.start, 0
        for i in range(len(word)):
            arc = self.map.find(word[i:i + 1], self.labels_at + self.first[state], self.labels_at + self.first[state + 1])
            if arc < 0:
                return None
            arc -= self.labels_at
            rank += self.skips[arc]
            state = self.targets[arc]
        return self.ids[self.offsets[rank]:self.offsets[rank + 1]].tolist() if self.final[state] else None

    def find_many(self, words: list[bytes]) -> list[bytes | None]:
        """``find`` of many words, packed: a step follows one arc of every word that is still on a path."""
        out: list[bytes | None] = [None] * len(words)
        for i in (i for i, w in enumerate(words) if not 0 < len(w) <= LONGEST):
            ids = self.find(words[i])
            out[i] = None if ids is None else np.array(ids, "<u4").tobytes()
        for some, letters, sizes in blocks(words):
            state, rank, on = np.full(len(some), self.start), np.zeros(len(some), np.int64), np.arange(len(some))
            ended = []
            for depth, row in enumerate(letters):
                short = sizes[on] <= depth
                if short.any():
                    ended.append(on[short])
                    on = on[~short]
                asked = state[on] << 8 | row[on]
                at = np.searchsorted(self.arcs[:-1], asked)
                fits = self.arcs[at] == asked
                on, at = on[fits], at[fits]
                state[on] = self.arc_targets[at]
                rank[on] += self.arc_skips[at]
            for i in np.concatenate([*ended, on]).tolist():
                if self.accepts[state[i]]:
                    out[some[i]] = self.ids[self.offsets[rank[i]]:self.offsets[rank[i] + 1]].tobytes()
        return out


# Fixed value: the characters with the Unicode property White_Space.
_WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SEGMENT = re.compile(f"[{_WHITE}]*[^{_WHITE}]+|[{_WHITE}]+").findall
UNEVEN = re.compile(r"(?:\A|\s) ").search
# The same for Arrow, whose white space is ASCII's.
UNEVEN_RE2 = r"(?:\A|[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]) "


# Latin letters: a segment of these alone, or with one closing mark, needs no pattern to be cut.
_LATIN = "[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+"
PLAIN = re.compile(f"(?: ?{_LATIN})([.,]?)").fullmatch
LETTERS = re.compile(_LATIN).match


class _Memory(dict):
    """Bounded memory of a worker: text to the packed ids that ``make`` finds for it.

    When it is full it becomes the older half, which is asked before anything is made
    again; so what is used all the time is never forgotten.
    """

    def __init__(self, make):
        self.make, self.older = make, {}

    def __missing__(self, text: str) -> bytes:
        packed = self.older.get(text)
        if packed is None:
            packed = self.make(text)
        if len(text) <= 64:
            self.keep(text, packed)
        return packed

    def keep(self, text: str, packed: bytes) -> None:
        if len(self) >= REMEMBERED // 2:
            self.older = dict(self)
            self.clear()
        self[text] = packed

    def keep_many(self, found: dict[str, bytes]) -> None:
        """``keep`` of short texts, as many as fit."""
        if len(self) + len(found) > REMEMBERED // 2:
            self.older = dict(self)
            self.clear()
        self.update(islice(found.items(), REMEMBERED // 2))

    def known(self, text: str) -> bytes | None:
        """What is remembered for the text."""
        packed = self.get(text)
        return self.older.get(text) if packed is None else packed


class _Encoder:
    """Texts to ids as bytes (little-endian, 32 bits each)."""

    def __init__(self, merges: Merges, lexicon: Lexicon | None):
        self.merges, self.lexicon = merges, lexicon
        self.words = _Memory(self._word)
        self.whole = _Memory(self._segment)
        self.spaced = _Memory(lambda s: self._segment(" " + s))

    def _word(self, word: str) -> bytes:
        packed = self._listed(word)
        if packed is None:
            ids = self.merges.merge(word.encode())
            packed = struct.pack(f"<{len(ids)}I", *ids)
        return packed

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """``encode`` of many texts: segments are told apart once for all of them, and ids are put together by one gather."""
        column = pa.array(texts, pa.string())
        odd = pc.match_substring_regex(column, UNEVEN_RE2).to_numpy(zero_copy_only=False)
        for special in self.merges.special:
            odd = odd | pc.match_substring(column, special).to_numpy(zero_copy_only=False)
        out = [self.encode(t) if o else b"" for t, o in zip(texts, odd)]
        rows = np.flatnonzero(~odd)
        if not len(rows):
            return out
        parts = pc.split_pattern(column.take(pa.array(rows)), " ")
        cuts, segments = parts.offsets.to_numpy(), parts.values.dictionary_encode()
        codes = segments.indices.to_numpy().astype(np.int64)
        firsts = parts.values.take(pa.array(cuts[:-1])).to_pylist()
        table = self._spaced(segments.dictionary.to_numpy(zero_copy_only=False).tolist())
        codes[cuts[:-1]] = np.arange(len(table), len(table) + len(rows))
        table += map(self.whole.__getitem__, firsts)
        sizes = np.array([len(p) >> 2 for p in table])
        starts, ids = np.cumsum(sizes) - sizes, np.frombuffer(b"".join(table), "<u4")
        ends = np.concatenate([[0], np.cumsum(sizes[codes])])
        packed = gathered(ids, starts, sizes, codes)
        for r, s, e in zip(rows.tolist(), (ends[cuts[:-1]] * 4).tolist(), (ends[cuts[1:]] * 4).tolist()):
            out[r] = packed[s:e]
        return out

    def _spaced(self, segments: list[str]) -> list[bytes]:
        """Packed ids of segments after a space; the unseen words of all of them are looked up and merged at once.

        A word after a space is remembered as the segment that it is.
        """
        spaced, words, cut = self.spaced, self.words, self.merges.cut
        out = list(map(spaced.get, segments))
        older, kept = spaced.older, {}
        unseen: dict[str, bytes | None] = {}
        alone, joined = [], []
        for i in [i for i, packed in enumerate(out) if packed is None]:
            segment = segments[i]
            packed = older.get(segment)
            if packed is not None:
                out[i] = kept[segment] = packed
                continue
            if not 0 < len(segment) < 64:
                out[i] = spaced[segment]
                continue
            end = letters.end() if (letters := LETTERS(segment)) else 0
            if end == len(segment):
                alone.append(i)
                unseen[" " + segment] = None
                continue
            # What follows Latin letters and is no letter starts a pre-token.
            own = [" " + segment[:end], *cut(segment[end:])] if end and segment[end].isascii() else cut(" " + segment)
            joined.append((i, own))
            for word in own:
                if word not in unseen:
                    packed = spaced.known(word[1:]) if word[0] == " " else words.known(word)
                    unseen[word] = packed
        left = [word for word, packed in unseen.items() if packed is None]
        unseen |= zip(left, self._made([word.encode() for word in left]))
        for i in alone:
            segment = segments[i]
            out[i] = kept[segment] = unseen[" " + segment]
        for i, own in joined:
            out[i] = kept[segments[i]] = b"".join([unseen[word] for word in own])
        spaced.keep_many(kept)
        words.keep_many({word: unseen[word] for _, own in joined for word in own if word[0] != " " and len(word) <= 64})
        return out

    def _made(self, words: list[bytes]) -> list[bytes]:
        """Packed ids of words: those of the lexicon are found there, the others are merged."""
        out = self.lexicon.find_many(words) if self.lexicon else [None] * len(words)
        left = [i for i, packed in enumerate(out) if packed is None]
        for i, packed in zip(left, self.merges.merge_many([words[i] for i in left])):
            out[i] = packed
        return out

    def _listed(self, word: str) -> bytes | None:
        """Packed ids of a word of the lexicon."""
        ids = self.lexicon.find(word.encode()) if self.lexicon else None
        return None if ids is None else struct.pack(f"<{len(ids)}I", *ids)

    def _segment(self, segment: str) -> bytes:
        plain = PLAIN(segment)
        if plain is None:
            return b"".join(map(self.words.__getitem__, self.merges.cut(segment)))
        if plain[1]:
            return self.words[segment[:-1]] + self.words[plain[1]]
        return self.words[segment]

    def encode(self, text: str) -> bytes:
        """A pre-token never runs on from other characters into white space, and what
        follows does not look back, so a text can be cut before white space. Where no
        space stands at the start or after white space, it is cut before every space;
        the segments are remembered without it."""
        out = []
        for piece, special in self.merges.pieces(text):
            if special:
                out.append(np.array([self.merges.special[piece]], "<u4").tobytes())
            elif UNEVEN(piece):
                out.extend(map(self.whole.__getitem__, SEGMENT(piece)))
            else:
                first, *rest = piece.split(" ")
                out.append(self.whole[first])
                out.extend(map(self.spaced.__getitem__, rest))
        return b"".join(out)


_encoders: dict[str, _Encoder] = {}


# --- Spark ---

def _texts(column: pa.Array) -> list[str]:
    return pc.fill_null(column, "").to_pylist()


def frequent_words(docs: DataFrame, text: str, merges: Merges) -> list[bytes]:
    """Pre-tokens of the frequent words of all documents, as they stand after a space.

    Words are split at white space here, which is much cheaper than the full cut. A task
    reports only words that are frequent in it, so the shuffle is bounded.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _encoders.clear()  # what a reused worker remembers of an earlier lexicon
        counts, total = Counter(), 0
        for batch in batches:
            for value in _texts(batch.column(0)):
                found = value.split()
                total += len(found)
                counts.update(found)
                if len(counts) > 2 * REMEMBERED:
                    counts = Counter(dict(counts.most_common(REMEMBERED // 2)))
        top = [(w, n) for w, n in counts.most_common(LEXICON_WORDS) if n >= total * SHARE and len(w) <= 64]
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], ["word", "n"])

    counted = docs.select(text).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    words = [r["word"] for r in counted.orderBy(F.desc("n"), "word").limit(LEXICON_WORDS).collect()]
    return sorted({t.encode() for w in words for t in merges.cut(" " + w)})


def ship_lexicon(spark: SparkSession, words: list[bytes], merges: Merges) -> str:
    """Write the lexicon beside the other intermediate tables and have Spark copy it to every executor; its file name."""
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{scratch_root(spark)}/{name}")
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    stream.write(bytearray(compile_lexicon({w: merges.merge(w) for w in words})))
    stream.close()
    spark.sparkContext.addFile(path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString())
    return name


def add_tokens(docs: DataFrame, text: str, tokenizer: str, ids: str | None = None, decoded: str | None = None,
               digest: bool = False) -> DataFrame:
    """``docs`` with its texts encoded and decoded; new columns replace those of the same name.

    ``ids``: name of a column for the ids (binary, little-endian, 32 bits each);
    ``decoded``: name of a column for the decoded text; ``digest`` adds ``n_tokens``,
    ``ids_sha256`` and ``decoded_sha256``. ``tokenizer`` is the path of a byte-level BPE
    vocabulary file, read by the driver and sent to the tasks (a file of fixed size).
    """
    spark = docs.sparkSession
    with open(tokenizer, "rb") as f:
        vocabulary = f.read()
    own = Merges(vocabulary)
    name = ship_lexicon(spark, frequent_words(docs, text, own), own)
    shared = spark.sparkContext.broadcast(vocabulary)
    fields = [StructField("n_tokens", LongType()), StructField("ids_sha256", StringType()),
              StructField("decoded_sha256", StringType())] if digest else []
    fields += [StructField(ids, BinaryType())] if ids else []
    fields += [StructField(decoded, StringType())] if decoded else []
    kept = without(docs, *(f.name for f in fields))
    schema = StructType([docs.schema[c] for c in kept] + fields)
    kinds = {f.name: pa.int64() if f.name == "n_tokens" else pa.binary() if f.name == ids else pa.string() for f in fields}
    at = kept.index(text) if text in kept else len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _encoders:  # a worker keeps its memory from task to task
            _encoders.clear()
            _encoders[name] = _Encoder(Merges(shared.value), Lexicon(SparkFiles.get(name)))
        encoder, merges = _encoders[name], _encoders[name].merges
        for batch in batches:
            # A slice is handed on before the next one is made, so a task holds one slice of ids and texts.
            for first, held in row_slices(batch.column(at), SLICE):
                made: dict[str, list] = {f.name: [] for f in fields}
                texts = [t.decode() for t in held]
                coded = encoder.encode_many(texts)
                for packed, back in zip(coded, merges.decode_many(coded)):
                    for key, x in (("n_tokens", len(packed) // 4), (ids, packed), (decoded, back)):
                        if key in made:
                            made[key].append(x)
                    if digest:
                        made["ids_sha256"].append(hashlib.sha256(packed).hexdigest())
                        made["decoded_sha256"].append(hashlib.sha256(back.encode()).hexdigest())
                some = batch.slice(first, len(held))
                yield pa.RecordBatch.from_arrays([*some.columns[:len(kept)], *(pa.array(made[f.name], kinds[f.name]) for f in fields)], schema.names)
        pa.default_memory_pool().release_unused()

    return docs.select(*kept, *([] if text in kept else [F.col(text).alias(unused(docs, "_text"))])).mapInArrow(run, schema)
