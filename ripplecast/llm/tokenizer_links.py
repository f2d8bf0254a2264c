"""Token groups of single words under two tokenizers, encoded once per distinct word.

A *unit* is a run of white space and the run of other characters behind it. Neither
tokenizer has a token across the start of a unit: A's pattern starts a new piece at
white space behind anything else, and B's vocabulary has no piece with white space behind
another character, but for the few characters read off that vocabulary, which do
not start a unit. So tokens, groups and links of a text are those of its units.

A is a byte-level BPE. Its file lists the vocabulary in merge order, so the ranks
of a faster encoder are the ids themselves (checked when it is loaded); units with characters
whose class may differ between Unicode versions go to the file's own tokenizer.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

import numpy as np

#: White space of Unicode, as A's pattern sees it.
_WHITE = (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
WHITE = "".join(map(chr, _WHITE))
#: Characters below this point are classed alike by every Unicode version in use.
STABLE = re.compile(f"[{chr(0)}-{chr(0x24F)}]*\\Z")
#: Stands for a space in pieces.
META = chr(0x2581)
#: Distinct units that a worker process keeps, and the longest unit of the fast encoder.
CACHE_UNITS, LONG_UNIT = 200_000, 500


def _byte_alphabet() -> dict[str, int]:
    """The printable stand-in of every byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteTokenizer:
    """Tokenizer A: ids and bytes of byte-level BPE tokens."""

    def __init__(self, path: str):
        import tiktoken
        from public_tokenizers import PATTERN

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.path, self._slow = path, None
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        alphabet, vocab = _byte_alphabet(), model["vocab"]
        self.bytes = [b""] * (max(vocab.values()) + 1)
        for entry, i in vocab.items():
            self.bytes[i] = bytes(alphabet[c] for c in entry) if all(c in alphabet for c in entry) else entry.encode()
        merges = [x.split(" ") if isinstance(x, str) else x for x in model["merges"]]
        self.ranked = all(vocab[a + b] == 256 + i for i, (a, b) in enumerate(merges))
        ranks = {self.bytes[i]: i for i in range(256 + len(merges))}
        self._fast = tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str, short: bool) -> list[int]:
        """Ids of a text, which holds no unit longer than LONG_UNIT where `short`."""
        if self.ranked and short and STABLE.match(text):
            return self._fast.encode_ordinary(text)
        if self._slow is None:
            from tokenizers import Tokenizer

            self._slow = Tokenizer.from_file(self.path)
            self._slow.encode_special_tokens = True
        return self._slow.encode(text, add_special_tokens=False).ids


class PieceTokenizer:
    """Tokenizer B: ids and bytes of sentence pieces; it puts a space before a text."""

    def __init__(self, path: str):
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self._model.id_to_piece(i) for i in range(self._model.get_piece_size())]
        self.bytes, self.raw = [], np.zeros(len(pieces), bool)
        for i, piece in enumerate(pieces):
            self.raw[i] = self._model.is_byte(i)
            self.bytes.append(bytes([int(piece[3:5], 16)]) if self.raw[i] else piece.replace(META, " ").encode())
        texts = [p.replace(META, " ") for i, p in enumerate(pieces) if not self.raw[i]]
        #: White space that a piece may hold behind another character.
        self.glue = {c for p in texts for b, c in zip(p, p[1:], strict=False) if c in WHITE and b not in WHITE}
        # A character that no piece holds: put before a text, its tokens are cut off again.
        self._guard = next(c for c in "\n\t\v\f\x00" if not any(c in p for p in texts))
        self._cut = len(self._model.encode(self._guard))

    def encode(self, text: str) -> list[int]:
        """Tokens of space + text; none for an empty text."""
        return self._model.encode(text, num_threads=1)

    def encode_bare(self, text: str) -> list[int]:
        """Tokens of `text` as it stands, inside a longer text."""
        return self._model.encode(self._guard + text, num_threads=1)[self._cut :]


def identity_map(a: ByteTokenizer, b: PieceTokenizer) -> np.ndarray:
    """A id -> id of the B piece with the same bytes, -1 if there is none; a proper piece before a raw byte."""
    ids = {x: i for i, x in reversed(list(enumerate(b.bytes))) if b.raw[i]}
    ids |= {x: i for i, x in reversed(list(enumerate(b.bytes))) if not b.raw[i]}
    return np.array([ids.get(x, -1) if x else -1 for x in a.bytes], np.int64)


class UnitLinks:
    """Cached units: tokens, groups and links of each. Ids of units hold until `clear`."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = ByteTokenizer(a_path), PieceTokenizer(b_path)
        self.identity = identity_map(self.a, self.b)
        self._size_a = np.array([len(x) for x in self.a.bytes], np.int64)
        self._size_b = np.array([len(x) for x in self.b.bytes], np.int64)
        names = [str(i).encode() for i in range(max(len(self.a.bytes), len(self.b.bytes)))]
        self._inner = [n + b"," for n in names]
        self._last_a, self._last_b = [n + b"|" for n in names], [n + b";" for n in names]
        white, glue = f"[{WHITE}]", "".join(re.escape(c) for c in sorted(self.b.glue))
        more = f"(?:[{glue}]{white}*[^{WHITE}]*)*" if glue else ""
        self._units = re.compile(f"{white}*[^{WHITE}]+{more}|{white}+")
        #: A space beside other white space: the plain cut at every space does not hold.
        self._uneven = re.compile(f"{white} | {white}")
        self._clean = re.compile(f"[^{WHITE}{META}]+\\Z")
        self.clear()

    def clear(self) -> None:
        self.spaced: dict[str, int] = {}
        self.bare: dict[str, int] = {}
        self.text: list[bytes] = []
        self._done = np.zeros((4, 0), np.int64), np.zeros(1, np.int64), np.zeros(0, np.uint64)
        self._sizes: list[tuple[int, int, int, int]] = []  # of units since `_done`
        self._links: list[int] = []

    def __len__(self) -> int:
        return len(self.text)

    def cut(self, texts: list[str]) -> list[list[int]]:
        """The units of space + text, as ids, for each text."""
        found, spaced, bare = [], set(), set()
        for text in texts:
            if self._uneven.search(" " + text) is None:
                parts, plain = text.split(" "), True
                spaced.update(parts)
            else:
                parts, plain = self._units.findall(" " + text), False
                spaced.update(u[1:] for u in parts if u[0] == " ")
                bare.update(u for u in parts if u[0] != " ")
            found.append((plain, parts))
        self._learn(spaced.difference(self.spaced), bare.difference(self.bare))
        known, other = self.spaced, self.bare
        return [
            list(map(known.__getitem__, parts)) if plain else [known[u[1:]] if u[0] == " " else other[u] for u in parts]
            for plain, parts in found
        ]

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per unit (A tokens, B tokens, groups, sound), where its links start, and all links (A id << 32 | B id)."""
        if self._sizes:
            sizes, _, links = self._done
            sizes = np.concatenate([sizes, np.array(self._sizes, np.int64).T], axis=1)
            links = np.concatenate([links, np.array(self._links, np.uint64)])
            self._done = sizes, np.append(0, np.cumsum(sizes[2])), links
            self._sizes, self._links = [], []
        return self._done

    def _learn(self, spaced: set[str], bare: set[str]) -> None:
        clean = [u for u in spaced if len(u) <= LONG_UNIT and self._clean.match(u)]
        for at in range(0, len(clean), 2000):
            some = clean[at : at + 2000]
            joined = " ".join(some)
            ends = np.cumsum([len(u.encode()) + 1 for u in some])
            if self._enter(" " + joined, self.a.encode(" " + joined, True), self.b.encode(joined), ends):
                first = len(self.text) - len(some)
                self.spaced.update(zip(some, range(first, first + len(some)), strict=True))
        for units, where, before in ((spaced, self.spaced, " "), (bare, self.bare, "")):
            for u in units:
                if u not in where:
                    self._enter_one(before + u)
                    where[u] = len(self.text) - 1

    def _enter_one(self, unit: str) -> None:
        """One unit by itself: its two token lists are walked side by side."""
        a, b = self.a.encode(unit, len(unit) <= LONG_UNIT), self.b.encode_bare(unit)
        bytes_a, bytes_b, body = self.a.bytes, self.b.bytes, unit.encode()
        if b"".join([bytes_a[i] for i in a]) != body or b"".join([bytes_b[i] for i in b]) != body:
            self._sizes.append((0, 0, 0, 0))
            self.text.append(b"")
            return
        parts, group, links = [], [], 0
        ends, at, end, other = iter(b), 0, 0, 0
        for i in a:
            at += len(bytes_a[i])
            while end < at:
                other = next(ends)
                end += len(bytes_b[other])
                group.append(other)
            # B's tokens of the group so far end at or behind A's token.
            if end == at:
                parts.append(self._last_a[i])
                parts += [self._inner[x] for x in group[:-1]]
                parts.append(self._last_b[other])
                self._links.append(i << 32 | other)
                group, links = [], links + 1
            else:
                parts.append(self._inner[i])
        self._sizes.append((len(a), len(b), links, 1))
        self.text.append(b"".join(parts)[:-1])

    def _enter(self, whole: str, a: list[int], b: list[int], ends: np.ndarray) -> bool:
        """The units of `whole`, which end at byte offsets `ends`; False where the tokens' bytes differ."""
        body = whole.encode()
        if b"".join([self.a.bytes[i] for i in a]) != body or b"".join([self.b.bytes[i] for i in b]) != body:
            return False
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        end_a, end_b = np.cumsum(self._size_a[a]), np.cumsum(self._size_b[b])
        cuts = np.intersect1d(end_a, end_b)
        if not np.isin(ends, cuts).all():
            return False
        last_a, last_b = np.isin(end_a, cuts, assume_unique=True), np.isin(end_b, cuts, assume_unique=True)
        group_a, group_b = np.searchsorted(cuts, end_a), np.searchsorted(cuts, end_b)
        unit_a, unit_b, unit = (np.searchsorted(ends, x) for x in (end_a, end_b, cuts))
        n = len(ends)
        sizes = [np.bincount(x, minlength=n) for x in (unit_a, unit_b, unit)]
        self._sizes += np.stack([*sizes, np.ones(n, np.int64)], axis=1).tolist()
        self._links += (a[last_a] << 32 | b[last_b]).tolist()
        # A group's A tokens, then its B tokens.
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        tokens = [(self._last_a if x else self._inner)[i] for i, x in zip(a.tolist(), last_a.tolist(), strict=True)]
        tokens += [(self._last_b if x else self._inner)[i] for i, x in zip(b.tolist(), last_b.tolist(), strict=True)]
        tokens = [tokens[i] for i in order.tolist()]
        at = 0
        for size in (sizes[0] + sizes[1]).tolist():
            self.text.append(b"".join(tokens[at : at + size])[:-1])
            at += size
        return True


@lru_cache(maxsize=2)
def unit_links(a_path: str, b_path: str) -> UnitLinks:
    """One cache per worker process and pair of files: later tasks find it warm."""
    return UnitLinks(a_path, b_path)
