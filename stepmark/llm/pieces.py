"""Pieces of texts, aligned between a byte-level and a sentencepiece tokenizer; see `alignment`.

A module of its own, so that workers load the tokenizers and nothing else.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np

#: Before each space that follows something other than white space, and between a Latin letter or
#: digit and a mark that ends a word.
MARKS = ",.;:!?"
PIECE = re.compile(rf"(?<=\S)(?= )|(?<=[0-9A-Za-zÀ-ÖØ-öø-ɏ])(?=[{MARKS}](?: |\Z))")
JOINING = re.compile(rf"[^▁]▁|[0-9A-Za-zÀ-ÖØ-öø-ɏ][{MARKS}]")
#: Pieces, and their characters, that a worker keeps, twice: those used lately and those before.
MOST_CACHED, MOST_CHARS = 220_000, 16_000_000
#: Pieces that are encoded as one text.
JOINED = 512


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable bytes stand for
    themselves, the others for the characters from 256 on, in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _decoded_a(tokenizer) -> list[bytes]:
    letters = byte_letters()
    out = [b""] * tokenizer.get_vocab_size(with_added_tokens=True)
    for token, i in tokenizer.get_vocab(with_added_tokens=True).items():
        known = all(c in letters for c in token)
        out[i] = bytes(letters[c] for c in token) if known else token.encode()
    return out


def _decoded_b(processor) -> list[bytes]:
    def decoded(i: int) -> bytes:
        piece = processor.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if processor.is_byte(i) else piece.replace("▁", " ").encode()

    return [decoded(i) for i in range(processor.get_piece_size())]


def ends(stops: np.ndarray, sizes: np.ndarray, first: np.ndarray, base: np.ndarray) -> np.ndarray:
    """Byte ends of tokens from the coarse ends of their spans, refined by the bytes they stand for.

    `first` marks the first token of each text, `base` is where its text begins. A span that is as
    long, from the one before, as its token is a sure cut. Others end as many bytes after the last
    sure cut (or the beginning of the text) as the tokens since stand for.
    """
    n = len(sizes)
    if n == 0:
        return np.zeros(0, dtype=np.int64)
    decoded = np.cumsum(sizes)
    starts = np.where(first, base, np.append(0, stops[:-1]))
    sure = stops - starts == sizes
    at = np.arange(n)
    last = np.maximum.accumulate(np.where(sure, at, -1))
    begin = np.maximum.accumulate(np.where(first, at, 0))
    from_cut = last >= begin
    cut = np.where(from_cut, last, 0)
    after_cut = stops[cut] + decoded - decoded[cut]
    after_begin = base + decoded - (decoded[begin] - sizes[begin])
    return np.where(from_cut, after_cut, after_begin)


class _Pieces:
    """What is known of pieces, by place: token counts, groups as text, links, and whether both
    tokenizers spell the piece."""

    def __init__(self) -> None:
        self.places: dict[str, int] = {}
        self.held = 0
        self.groups: list[str] = []
        self.counts = np.zeros((1 << 12, 2), dtype=np.int64)
        self.good = np.zeros(1 << 12, dtype=bool)
        self.link_ends = np.zeros(1 + (1 << 12), dtype=np.int64)
        self.links = np.zeros(1 << 14, dtype=np.int64)

    def add(self, pieces: list[str], groups: list[str], counts: np.ndarray, good: np.ndarray, n_links: np.ndarray, links: np.ndarray) -> None:
        first, last = len(self.groups), len(self.groups) + len(pieces)
        if last > len(self.good):
            room = max(last, 2 * len(self.good))
            self.counts, self.good = np.resize(self.counts, (room, 2)), np.resize(self.good, room)
            self.link_ends = np.resize(self.link_ends, room + 1)
        used = self.link_ends[first]
        if used + len(links) > len(self.links):
            self.links = np.resize(self.links, 2 * (used + len(links)))
        self.places.update(zip(pieces, range(first, last), strict=True))
        self.held += sum(map(len, pieces))
        self.groups += groups
        self.counts[first:last], self.good[first:last] = counts, good
        self.link_ends[first + 1 : last + 1] = used + np.cumsum(n_links)
        self.links[used : used + len(links)] = links

    def links_at(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many links each place has, and all of them in order."""
        starts = self.link_ends[at]
        n = self.link_ends[at + 1] - starts
        shift = np.repeat(starts - (np.cumsum(n) - n), n)
        return n, self.links[shift + np.arange(len(shift))]

    @property
    def full(self) -> bool:
        return len(self.groups) > MOST_CACHED or self.held > MOST_CHARS


class Aligner:
    """Aligned pieces, each distinct one done once: token counts, groups as text, links as pairs."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True  # names of special tokens in a text are plain text
        self.a.pre_tokenizer = ByteLevel(add_prefix_space=False, trim_offsets=False, use_regex=True)
        self.b = SentencePieceProcessor(model_file=path_b)
        self.bytes_a, self.bytes_b = _decoded_a(self.a), _decoded_b(self.b)
        self.sizes_a = np.array([len(x) for x in self.bytes_a], dtype=np.int64)
        self.sizes_b = np.array([len(x) for x in self.bytes_b], dtype=np.int64)
        self.n_b = len(self.bytes_b)
        # Each id with the mark after it: next token, other tokenizer, next group, next piece.
        self.marked = [f"{i}{m}" for i in range(max(len(self.bytes_a), self.n_b)) for m in ",|;\n"]
        # Spans of the proto count characters or bytes, as the release has it.
        self.proto = _proto(self.b)
        self.in_bytes = self.b.encode("é", **self.proto).pieces[-1].end == 2
        self.space = [self.b.piece_to_id("▁")]
        vocabulary = (self.b.id_to_piece(i) for i in range(self.n_b))
        if any(JOINING.search(piece) for piece in vocabulary):
            raise ValueError("the piece vocabulary joins words, or words and marks")
        self.clear()

    def clear(self) -> None:
        self.known, self.before = _Pieces(), _Pieces()
        self._add_marks()

    def _add_marks(self) -> None:
        """The pieces that do not begin with a space: each mark is one token of both."""
        ids = [(self.a.encode(m, add_special_tokens=False).ids, self.b.encode(f"a{m}")[-1:]) for m in MARKS]
        one = np.ones(len(MARKS), dtype=np.int64)
        links = np.array([a * self.n_b + b for (a,), (b,) in ids])
        self.known.add([*MARKS], [f"{a}|{b}" for (a,), (b,) in ids], np.stack([one, one], axis=1), one == 1, one, links)

    def _spans_a(self, texts: list[str]):
        ids, stops, counts = [], [], []
        for e in self.a.encode_batch(texts, add_special_tokens=False):
            ids += e.ids
            stops += [stop for _, stop in e.offsets]
            counts.append(len(e))
        return ids, stops, counts

    def _spans_b(self, texts: list[str]):
        ids, stops, counts = [], [], []
        kind = self.proto
        for text in texts:
            # The processor adds the space that every text begins with.
            if text == " ":
                ids += self.space
                stops.append(1)
                counts.append(1)
                continue
            found = self.b.encode(text[1:], **kind).pieces
            ids += [p.id for p in found]
            stops += [p.end + 1 for p in found]
            counts.append(len(found))
        return ids, stops, counts

    def _side(self, blocks: list[str], coded: list[bytes], bases: np.ndarray, chars: np.ndarray, of_a: bool):
        """Ids, block and byte end of all tokens of one tokenizer, and which blocks they spell."""
        table, lengths = (self.bytes_a, self.sizes_a) if of_a else (self.bytes_b, self.sizes_b)
        ids, stops, counts = (self._spans_a if of_a else self._spans_b)(blocks)
        ids, stops, counts = (np.array(x, dtype=np.int64) for x in (ids, stops, counts))
        block = np.repeat(np.arange(len(blocks)), counts)
        if of_a or not self.in_bytes:
            first_char = np.cumsum([0, *map(len, blocks)])[:-1]
            stops = chars[first_char[block] + stops]
        else:
            stops = bases[block] + stops
        last = np.cumsum(counts)
        first = np.zeros(len(ids), dtype=bool)
        first[(last - counts)[counts > 0]] = True
        spelt = [table[i] for i in ids.tolist()]
        good = np.array([b"".join(spelt[e - n : e]) == c for e, n, c in zip(last.tolist(), counts.tolist(), coded, strict=True)], dtype=bool)
        return ids, block, ends(stops, lengths[ids], first, bases[block]), good

    def _joined(self, pieces: list[str]) -> list[list[str]]:
        """The pieces in lists, each a text that is cut into them. What ends in white space is alone."""
        plain = [p for p in pieces if not p[-1].isspace()]
        return [*(plain[i : i + JOINED] for i in range(0, len(plain), JOINED)), *([p] for p in pieces if p[-1].isspace())]

    def _add(self, texts: list[list[str]]) -> None:
        """Align new pieces, given in texts that begin with a space and are cut into pieces."""
        pieces = list(chain.from_iterable(texts))
        cuts = np.cumsum([0, *map(len, texts)])
        blocks = ["".join(t) for t in texts]
        of_piece = np.repeat(np.arange(len(blocks)), np.diff(cuts))
        coded = [b.encode() for b in blocks]
        sizes = np.array([len(c) for c in coded], dtype=np.int64)
        bases = np.cumsum(sizes) - sizes
        # byte place of each character of all blocks, and the end
        chars = np.append(np.flatnonzero((np.frombuffer(b"".join(coded), np.uint8) & 0xC0) != 0x80), sizes.sum())
        piece_ends = chars[np.cumsum([len(p) for p in pieces])]
        ids_a, block_a, ends_a, good_a = self._side(blocks, coded, bases, chars, True)
        ids_b, block_b, ends_b, good_b = self._side(blocks, coded, bases, chars, False)
        good = good_a & good_b
        keep_a, keep_b = good[block_a], good[block_b]
        ids_a, ends_a, ids_b, ends_b = ids_a[keep_a], ends_a[keep_a], ids_b[keep_b], ends_b[keep_b]
        common, in_a, in_b = np.intersect1d(ends_a, ends_b, assume_unique=True, return_indices=True)
        good_piece = good[of_piece] & np.isin(piece_ends, common)
        if not good_piece.all():  # a tokenizer changes a text: find out which piece it is
            changed = np.bincount(of_piece, weights=~good_piece, minlength=len(texts)) > 0
            if any(x and len(t) > 1 for t, x in zip(texts, changed.tolist(), strict=True)):
                for t, x in zip(texts, changed.tolist(), strict=True):
                    self._add([t[: len(t) // 2], t[len(t) // 2 :]] if x and len(t) > 1 else [t])
                return
        owner = np.searchsorted(piece_ends, common)
        counts = [np.bincount(np.searchsorted(piece_ends, token_ends), minlength=len(pieces)) for token_ends in (ends_a, ends_b)]
        n_links = np.bincount(owner, minlength=len(pieces))
        groups = self._texts(ids_a, ids_b, in_a, in_b, owner, len(pieces))
        self.known.add(pieces, groups, np.stack(counts, axis=1), good_piece, n_links, ids_a[in_a] * self.n_b + ids_b[in_b])

    def _texts(self, ids_a, ids_b, in_a, in_b, owner, n: int) -> list[str]:
        """The groups of each of `n` pieces as text: all tokens in order, each with the mark after it."""
        group_a = np.searchsorted(in_a, np.arange(len(ids_a)))
        group_b = np.searchsorted(in_b, np.arange(len(ids_b)))
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        mark = np.zeros(len(ids_a) + len(ids_b), dtype=np.int64)
        mark[in_a] = 1
        last_of_piece = np.append(owner[1:] != owner[:-1], True) if len(owner) else np.zeros(0, bool)
        mark[len(ids_a) + in_b] = 2 + last_of_piece
        codes = (np.concatenate([ids_a, ids_b]) * 4 + mark)[order]
        marked = self.marked
        lines = "".join([marked[c] for c in codes.tolist()]).split("\n")
        out = [""] * n
        for piece, line in zip(owner[last_of_piece].tolist(), lines, strict=False):
            out[piece] = line
        return out

    def align(self, texts: list[str | None]) -> Iterator[Aligned]:
        """The alignment of each text; NULL, empty and changed texts have no tokens."""
        if self.known.full:
            self.known, self.before = _Pieces(), self.known
            self._add_marks()
        cut = [PIECE.split(" " + t) if t else [] for t in texts]
        places, old = self.known.places, self.before.places
        found = [[*map(places.get, pieces)] for pieces in cut]
        if missing := [*dict.fromkeys(p for pieces, at in zip(cut, found, strict=True) for p, i in zip(pieces, at, strict=True) if i is None)]:
            if again := [p for p in missing if p in old]:
                at = np.array([old[p] for p in again])
                n_links, links = self.before.links_at(at)
                self.known.add(again, [self.before.groups[i] for i in at.tolist()], self.before.counts[at], self.before.good[at], n_links, links)
            if new := [p for p in missing if p not in old]:
                self._add(self._joined(new))
        known = self.known
        for pieces, codes in zip(cut, found, strict=True):
            if None in codes:
                codes = [places[p] if i is None else i for p, i in zip(pieces, codes, strict=True)]
            at = np.array(codes, dtype=np.int64)
            if not codes or not known.good[at].all():
                yield NOTHING
                continue
            n_a, n_b = known.counts[at].sum(axis=0).tolist()
            yield Aligned(n_a, n_b, ";".join([known.groups[i] for i in codes]), known.links_at(at)[1])


@dataclass(frozen=True)
class Aligned:
    """Token counts, groups `a1,a2|b1;...`, and one link a * n_b + b for each common end."""

    n_a: int
    n_b: int
    groups: str
    links: np.ndarray


NOTHING = Aligned(0, 0, "", np.zeros(0, dtype=np.int64))


def _proto(processor) -> dict:
    """How this release of the library is asked for its read-only proto."""
    try:
        processor.encode("", out_type="immutable_proto")
    except ValueError:
        return {"return_type": "proto"}
    return {"out_type": "immutable_proto"}


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """One aligner per Python worker."""
    if (path_a, path_b) not in _ALIGNERS:
        _ALIGNERS[path_a, path_b] = Aligner(path_a, path_b)
    return _ALIGNERS[path_a, path_b]
