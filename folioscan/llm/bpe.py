"""Exact byte-level BPE without a merge loop.

A vocabulary whose ids follow its merge order is compiled into

* a trie automaton over bytes, which reads off the longest token at each place,
* for every token, the two tokens it was merged from (`left`, `right`) and its longest proper prefix token,
* a test of two neighbouring tokens: they may stand side by side in an encoding exactly if no merge
  would have crossed their boundary before both were complete.

A token sequence in which every neighbouring pair passes is the encoding. Longest matches pass for most
pieces, and are checked for all pieces of a batch at once; only pieces with a failing pair are walked by
the backtracking encoder. Both are linear in the text.
"""

from __future__ import annotations

import base64
from bisect import bisect_left
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain, islice

import ahocorasick
import numpy as np
import regex

#: Bytes that never occur in UTF-8; one of them parts the pieces that are matched together.
_SEPARATOR = "\xff"
_UNUSED = (0xFE, 0xFF)
_SLOTS = 1 << 20
_PIECE_BYTES = 1 << 20
#: Encodings of so many pieces are kept, about 50 MB, besides those of the batch at hand.
_KNOWN_PIECES = 200_000


class Bpe:
    """The compiled vocabulary of a rank file (base64 token, id per line; single bytes first, then merges)."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as file:
            pairs = [line.split() for line in file if line.strip()]
        self.ids = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.split = regex.compile(pattern).findall
        size = max(self.ids.values()) + 1
        self.tokens: list[bytes] = [b""] * size
        for token, rank in self.ids.items():
            self.tokens[rank] = token
        self.size = size
        self.length = np.array([len(t) for t in self.tokens], dtype=np.int64)
        self.left = np.full(size, -1, dtype=np.int64)
        self.right = np.full(size, -1, dtype=np.int64)
        for rank, token in enumerate(self.tokens):
            if len(token) > 1:
                self.left[rank], self.right[rank] = self._halves(token, rank)
        merged = np.flatnonzero(self.left >= 0)
        keys = self.left[merged] * size + self.right[merged]
        order = np.argsort(keys)
        self.merge_keys, self.merge_ids = keys[order], merged[order]
        self.merge = dict(zip(keys.tolist(), merged.tolist()))
        #: The moment a token comes to be: bytes are there from the start.
        self.born = np.where(self.left >= 0, np.arange(size), -1)
        self.born_list, self.left_list, self.right_list = self.born.tolist(), self.left.tolist(), self.right.tolist()
        self.size_list = self.length.tolist()
        self.shorter = [next((self.ids[t[:k]] for k in range(len(t) - 1, 0, -1) if t[:k] in self.ids), -1) for t in self.tokens]
        self.reach: dict[bytes, int] = {}
        for token in self.ids:
            self.reach[token[:2]] = max(self.reach.get(token[:2], 1), len(token))
        self.automaton = ahocorasick.Automaton()
        for token, rank in self.ids.items():
            if not (len(token) == 1 and token[0] in _UNUSED):
                self.automaton.add_word(token.decode("latin-1"), rank)
        self.automaton.make_automaton()
        self.slot_key = np.full(_SLOTS, -1, dtype=np.int64)
        self.slot_ok = np.zeros(_SLOTS, dtype=bool)
        self.pair_memo: dict[int, bool] = {}
        self._forget()
        self._forget_counted()

    def _halves(self, token: bytes, rank: int) -> tuple[int, int]:
        """The last two parts of a token under the merges that come before it."""
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            best, at = rank, -1
            for i in range(len(parts) - 1):
                found = self.ids.get(parts[i] + parts[i + 1], rank)
                if found < best:
                    best, at = found, i
            if at < 0:
                raise ValueError(f"token {rank} of the vocabulary cannot be reached by merges")
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return self.ids[parts[0]], self.ids[parts[1]]

    # --- compatibility of neighbours -------------------------------------------------------------

    def _compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For arrays of token ids: may b follow a.

        Walks back in time along the right edge of a and the left edge of b. Wherever two edge tokens
        exist together and a merge of them comes before either is used up, the boundary would have gone.
        Of equal merges the left one goes first, hence the strict test on the left and not on the right.
        """
        never = self.size
        ok = np.ones(len(a), dtype=bool)
        at = np.arange(len(a))
        x, y = a.astype(np.int64), b.astype(np.int64)
        ends_x, ends_y = np.full(len(a), never), np.full(len(a), never)
        while len(at):
            keys = x * self.size + y
            where = np.minimum(np.searchsorted(self.merge_keys, keys), len(self.merge_keys) - 1)
            z = np.where(self.merge_keys[where] == keys, self.merge_ids[where], never + 1)
            crossed = (z < ends_x) & (z <= ends_y)
            ok[at[crossed]] = False
            bx, by = self.born[x], self.born[y]
            go = ~crossed & ((bx >= 0) | (by >= 0))
            at, x, y, ends_x, ends_y, bx, by = (v[go] for v in (at, x, y, ends_x, ends_y, bx, by))
            on_x = bx > by
            ends_x, ends_y = np.where(on_x, x, ends_x), np.where(on_x, ends_y, y)
            x, y = np.where(on_x, self.right[x], x), np.where(on_x, y, self.left[y])
        return ok

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """As _compatible, through a table of fixed size that remembers pairs."""
        keys = a.astype(np.int64) * self.size + b
        slots = ((keys * np.int64(0x9E3779B97F4A7C15 - (1 << 64))) >> np.int64(44)) & (_SLOTS - 1)
        new = self.slot_key[slots] != keys
        ok = self.slot_ok[slots]
        if new.any():
            unknown, back = np.unique(keys[new], return_inverse=True)
            verdict = self._compatible(unknown // self.size, unknown % self.size)
            ok[new] = verdict[back]
            # sequential writes: both arrays keep the last of those that share a slot
            place = ((unknown * np.int64(0x9E3779B97F4A7C15 - (1 << 64))) >> np.int64(44)) & (_SLOTS - 1)
            self.slot_key[place], self.slot_ok[place] = unknown, verdict
        return ok

    def _fits(self, a: int, b: int) -> bool:
        """As _compatible, for one pair in plain Python."""
        key = a * self.size + b
        known = self.pair_memo.get(key)
        if known is not None:
            return known
        if len(self.pair_memo) > _SLOTS:
            self.pair_memo.clear()
        merge, born, never = self.merge, self.born_list, self.size
        x, y, ends_x, ends_y, ok = a, b, never, never, True
        while True:
            z = merge.get(x * never + y, never + 1)
            if z < ends_x and z <= ends_y:
                ok = False
                break
            if born[x] < 0 and born[y] < 0:
                break
            if born[x] > born[y]:
                ends_x, x = x, self.right_list[x]
            else:
                ends_y, y = y, self.left_list[y]
        self.pair_memo[key] = ok
        return ok

    # --- encoders ---------------------------------------------------------------------------------

    def _longest(self, piece: bytes, at: int) -> int:
        for k in range(self.reach.get(piece[at : at + 2], 1), 0, -1):
            found = self.ids.get(piece[at : at + k])
            if found is not None and at + k <= len(piece):
                return found
        raise ValueError("the vocabulary lacks a byte")

    def backtrack(self, piece: bytes, longest: list[int] | None = None, breaks: list[int] | None = None) -> list[int]:
        """The exact encoding of one piece.

        longest: its longest matches from the left, if known, and breaks: the places i in them at which
        tokens i and i+1 do not fit. Stretches of matches between breaks are then taken over as they are.
        """
        size, shorter, end = self.size_list, self.shorter, len(piece)
        done: list[int] = []
        dead: set[int] = set()
        at, token = 0, self._longest(piece, 0) if end else -1
        starts: dict[int, int] = {}
        if longest:
            p = 0
            for i, t in enumerate(longest):
                starts[p] = i
                p += size[t]
        stretch = -1
        while at < end:
            after = at + size[token]
            if after not in dead and (not done or self._fits(done[-1], token)):
                done.append(token)
                at = after
                i = starts.get(at, -1)
                if i > stretch and breaks is not None and self._fits(token, longest[i]):
                    k = bisect_left(breaks, i)
                    stop = breaks[k] if k < len(breaks) else len(longest) - 1
                    taken = longest[i : stop + 1]
                    done += taken
                    at += sum([size[t] for t in taken])
                    stretch = stop
                if at < end:
                    token = self._longest(piece, at)
                continue
            token = shorter[token]
            while token < 0:  # nothing fits here: take the last token back and try a shorter one
                dead.add(at)
                last = done.pop()
                at -= size[last]
                token = shorter[last]
        return done

    def _matched(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, dict[int, list[int]]]:
        """Longest matches of all pieces, the piece of each, their number by piece, and the encodings of pieces that they are not."""
        flat = np.fromiter(chain.from_iterable(self.automaton.iter_long(_SEPARATOR.join([p.decode("latin-1") for p in pieces]))), dtype=np.int64)
        last, ids = flat[0::2], flat[1::2]
        sizes = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        owner = np.searchsorted(np.cumsum(sizes + 1), last, side="right")
        counts = np.bincount(owner, minlength=len(pieces))
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        failed = inner[~self.compatible(ids[inner], ids[inner + 1])] if len(inner) else inner
        fixed: dict[int, list[int]] = {}
        if len(failed):
            first = np.cumsum(counts) - counts
            bad, where = np.unique(owner[failed], return_index=True)
            where = [*where.tolist(), len(failed)]
            for k, piece in enumerate(bad.tolist()):
                begin = int(first[piece])
                matches = ids[begin : begin + int(counts[piece])].tolist()
                fixed[piece] = self.backtrack(pieces[piece], matches, (failed[where[k] : where[k + 1]] - begin).tolist())
        return ids, owner, counts, fixed

    def _count_group(self, pieces: list[bytes]) -> np.ndarray:
        _, _, counts, fixed = self._matched(pieces)
        for piece, tokens in fixed.items():
            counts[piece] = len(tokens)
        return counts

    def _encode_group(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        ids, owner, counts, fixed = self._matched(pieces)
        if not fixed:
            return ids.astype(np.int32), counts
        first = np.cumsum(counts) - counts
        bad = np.array(list(fixed), dtype=np.int64)
        new_counts = counts.copy()
        new_counts[bad] = [len(fixed[p]) for p in bad.tolist()]
        new_first = np.cumsum(new_counts) - new_counts
        out = np.empty(int(new_counts.sum()), dtype=np.int32)
        is_bad = np.zeros(len(pieces), dtype=bool)
        is_bad[bad] = True
        good = ~is_bad[owner]
        out[(new_first[owner] + np.arange(len(ids)) - first[owner])[good]] = ids[good]
        for piece, tokens in fixed.items():
            out[new_first[piece] : new_first[piece] + len(tokens)] = tokens
        return out, new_counts

    @staticmethod
    def _groups(pieces: list[bytes]) -> Iterator[list[bytes]]:
        """The pieces in groups of about _PIECE_BYTES."""
        group, size = [], 0
        for piece in pieces:
            group.append(piece)
            size += len(piece)
            if size >= _PIECE_BYTES:
                yield group
                group, size = [], 0
        if group:
            yield group

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces in a row, and how many each has."""
        made = [self._encode_group(group) for group in self._groups(pieces)]
        if not made:
            return np.empty(0, np.int32), np.empty(0, np.int64)
        return np.concatenate([a for a, _ in made]), np.concatenate([b for _, b in made])

    def count_pieces(self, pieces: list[bytes]) -> np.ndarray:
        """How many tokens each piece has; its ids are not put together, and the matches of a group are dropped with it."""
        return np.concatenate([np.empty(0, np.int64), *map(self._count_group, self._groups(pieces))])

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.known_ids: list[np.ndarray] = []
        self.known_counts = np.empty(0, np.int64)

    def _forget_counted(self) -> None:
        self.counted: dict[str, int] = {}
        self.counted_sizes = np.empty(0, np.int64)

    @staticmethod
    def _pieces(split: Callable[[str], list[str]], place: dict[str, int], texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """The number of each text's pieces, the pieces of all texts as places in the known ones, and the new ones."""
        before = len(place)
        codes: list[int] = []
        sizes = np.zeros(len(texts), dtype=np.int64)
        for i, text in enumerate(texts):
            if text:
                found = split(text)
                sizes[i] = len(found)
                codes += [place.setdefault(p, len(place)) for p in found]
        new = [p.encode("utf-8") for p in islice(reversed(place), len(place) - before)]
        return sizes, np.array(codes, dtype=np.int64), new[::-1]

    def count(self, texts: list[str | None]) -> np.ndarray:
        """Number of tokens of each text, 0 for null and empty texts.

        Of pieces met before only this number is kept; what is kept is dropped whenever it exceeds a fixed size.
        """
        if len(self.counted) > _KNOWN_PIECES:
            self._forget_counted()
        sizes, codes, new = self._pieces(self.split, self.counted, texts)
        if new:
            self.counted_sizes = np.concatenate([self.counted_sizes, self.count_pieces(new)])
        total = np.concatenate([[0], np.cumsum(self.counted_sizes[codes])])
        ends = np.cumsum(sizes)
        return total[ends] - total[ends - sizes]

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the offset where each text's ids begin (one more at the end).

        Pieces met before keep their encoding; what is kept is dropped whenever it exceeds a fixed size.
        """
        if len(self.place) > _KNOWN_PIECES:
            self._forget()
        sizes, codes, new = self._pieces(self.split, self.place, texts)
        if new:
            ids, found = self.encode_pieces(new)
            self.known_ids.append(ids)
            self.known_counts = np.concatenate([self.known_counts, found])
        if len(self.known_ids) > 1:
            self.known_ids = [np.concatenate(self.known_ids)]
        counts = self.known_counts
        first, per = np.cumsum(counts) - counts, counts[codes]
        upto = np.concatenate([[0], np.cumsum(per)]).astype(np.int64)
        out = self.known_ids[0][np.repeat(first[codes] - upto[:-1], per) + np.arange(upto[-1])] if upto[-1] else np.empty(0, np.int32)
        return out, np.concatenate([[0], upto[np.cumsum(sizes)]])

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """Texts of rows of ids, cut from one table of all tokens' bytes by an offset table."""
        table = np.frombuffer(b"".join(self.tokens), dtype=np.uint8)
        starts = np.cumsum(self.length) - self.length
        sizes = self.length[ids]
        upto = np.concatenate([[0], np.cumsum(sizes)])
        data = table[np.repeat(starts[ids] - upto[:-1], sizes) + np.arange(upto[-1])].tobytes()
        at = upto[offsets]
        return [data[a:b].decode("utf-8", errors="replace") for a, b in zip(at[:-1].tolist(), at[1:].tolist())]


def tokenizer_file(name: str) -> str:
    """Path of a rank file of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(f"{name}.tiktoken")


@lru_cache(maxsize=2)
def load(path: str) -> Bpe:
    """The compiled vocabulary, kept for the life of a Python worker."""
    import public_tokenizers

    return Bpe(path, public_tokenizers.PATTERN)
