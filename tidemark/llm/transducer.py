"""Byte-pair encoding as a finite-state transducer, and streaming decoding.

The merges of a byte-level vocabulary are compiled into a transducer over bytes whose states are made
when first reached. It rests on two facts about byte-pair encoding. First, a token sequence is the
encoding of its bytes exactly if every two neighbours are the encoding of theirs. Second, so every
prefix of a text has one encoding, and its last token follows from the encodings of shorter prefixes.
A state therefore holds the last token written and the bytes read since. A token can be written as soon as all
prefixes at which a longer token might still begin agree on it, which needs no more lookahead than the
longest token.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator

import regex

# Fixed value: the splitting pattern that belongs to the vocabulary; merges never cross its pieces.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: States and pieces kept; beyond, the memory starts afresh, which costs time but changes nothing.
MOST_STATES, MOST_PIECES, LONGEST_PIECE_KEPT = 200_000, 200_000, 64
#: Largest vocabulary file that is sent to the executors.
MOST_VOCABULARY_BYTES = 64 * 1024 * 1024


def read_ranks(content: bytes) -> dict[bytes, int]:
    """Tokens and their ids from the lines of a rank file: base64 token, id."""
    pairs = (line.split() for line in content.splitlines() if line.strip())
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """Byte-pair encoding by its definition: join the neighbours of lowest rank until none can be joined."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        rank, at = min((ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
        if rank == 1 << 60:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


class Transducer:
    """Encodes pieces of text; states and transitions are made on demand."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.longest = max(map(len, ranks))
        self.beginnings = {token[:i] for token in ranks for i in range(1, len(token))}
        self.fits: dict[tuple[bytes | None, bytes], bool] = {}
        self.split = regex.compile(PATTERN)
        self.pieces: dict[str, tuple[int, ...]] = {}
        self._reset()

    def _reset(self) -> None:
        self.numbers: dict[tuple[bytes | None, bytes], int] = {(None, b""): 0}
        self.pending: list[tuple[bytes | None, bytes]] = [(None, b"")]
        # per state the last token and its start, for every length of the bytes pending
        self.chains: list[list[tuple[bytes | None, int]]] = [[(None, 0)]]
        self.moves: dict[int, tuple[int, tuple[int, ...]]] = {}
        self.ends: dict[int, tuple[int, ...]] = {}

    def _follows(self, first: bytes | None, second: bytes) -> bool:
        """Whether two tokens may stand side by side."""
        known = self.fits.get((first, second))
        if known is None:
            whole = second if first is None else first + second
            wanted = [second] if first is None else [first, second]
            if len(self.fits) > 4 * MOST_STATES:
                self.fits.clear()
            known = self.fits[first, second] = merge(whole, self.ranks) == wanted
        return known

    def _last(self, text: bytes, chain: list[tuple[bytes | None, int]]) -> tuple[bytes, int]:
        """The last token of the encoding of ``text`` and its start, given those of all shorter prefixes."""
        end = len(text)
        for start in range(max(0, end - self.longest), end):
            token = text[start:]
            if token in self.ranks and self._follows(chain[start][0], token):
                return token, start
        raise ValueError("the vocabulary lacks a byte")

    def _path(self, chain: list[tuple[bytes | None, int]], end: int) -> list[int]:
        """The token ends up to ``end``, the last first."""
        out = []
        while end > 0:
            out.append(end)
            end = chain[end][1]
        return out

    def _move(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        last, text = self.pending[state]
        text += bytes((byte,))
        chain = [*self.chains[state]]
        chain.append(self._last(text, chain))
        end = len(text)
        agreed: set[int] | None = None
        for start in range(max(0, end - self.longest), end + 1):
            if start == end or text[start:] in self.beginnings:
                path = set(self._path(chain, start))
                agreed = path if agreed is None else agreed & path
                if not agreed:
                    break
        written: tuple[int, ...] = ()
        if agreed:
            keep = max(agreed)
            tokens = [chain[at][0] for at in reversed(self._path(chain, keep))]
            written = tuple(self.ranks[t] for t in tokens)
            last, text = tokens[-1], text[keep:]
            chain = [(last, 0), *((token, start - keep) for token, start in chain[keep + 1 :])]
        number = self.numbers.get((last, text))
        if number is None:
            number = self.numbers[last, text] = len(self.pending)
            self.pending.append((last, text))
            self.chains.append(chain)
        move = self.moves[state << 8 | byte] = (number, written)
        return move

    def _end(self, state: int) -> tuple[int, ...]:
        chain = self.chains[state]
        out = tuple(self.ranks[chain[at][0]] for at in reversed(self._path(chain, len(self.pending[state][1]))))
        self.ends[state] = out
        return out

    def encode_piece(self, piece: bytes) -> list[int]:
        state, out = 0, []
        for byte in piece:
            move = self.moves.get(state << 8 | byte)
            if move is None:
                if len(self.pending) > MOST_STATES:
                    here = self.pending[state], self.chains[state]
                    self._reset()
                    if here[0] in self.numbers:
                        state = self.numbers[here[0]]
                    else:
                        state = self.numbers[here[0]] = len(self.pending)
                        self.pending.append(here[0])
                        self.chains.append(here[1])
                move = self._move(state, byte)
            state, written = move
            if written:
                out.extend(written)
        out.extend(self.ends[state] if state in self.ends else self._end(state))
        return out

    def encode(self, text: str | None) -> list[int]:
        """Token ids of a text; none for null and for the empty text. Special tokens are ordinary text."""
        out: list[int] = []
        if not text:
            return out
        known = self.pieces
        for match in self.split.finditer(text):
            piece = match.group()
            ids = known.get(piece)
            if ids is None:
                ids = self.encode_piece(piece.encode("utf-8", "replace"))
                if len(piece) <= LONGEST_PIECE_KEPT:
                    if len(known) >= MOST_PIECES:
                        known.clear()
                    known[piece] = tuple(ids)
            out.extend(ids)
        return out


class Utf8Machine:
    """Incremental decoding: characters come out as soon as their last byte is in.

    State: how many bytes are missing, what the next one may be, and the code so far. A byte that can't
    continue ends the character with U+FFFD and is looked at again as a first byte.
    """

    # Lead bytes by range, with the bytes that follow and the range of the first of them.
    LEADS = (
        (0xC2, 0xDF, 1, 0x80, 0xBF), (0xE0, 0xE0, 2, 0xA0, 0xBF), (0xE1, 0xEC, 2, 0x80, 0xBF), (0xED, 0xED, 2, 0x80, 0x9F),
        (0xEE, 0xEF, 2, 0x80, 0xBF), (0xF0, 0xF0, 3, 0x90, 0xBF), (0xF1, 0xF3, 3, 0x80, 0xBF), (0xF4, 0xF4, 3, 0x80, 0x8F),
    )

    def __init__(self) -> None:
        self.missing = self.code = 0
        self.low, self.high = 0x80, 0xBF

    def feed(self, data: bytes) -> str:
        if not self.missing and data.isascii():
            return data.decode("ascii")
        out = []
        for byte in data:
            if self.missing:
                if self.low <= byte <= self.high:
                    self.code = self.code << 6 | byte & 0x3F
                    self.missing -= 1
                    self.low, self.high = 0x80, 0xBF
                    if not self.missing:
                        out.append(chr(self.code))
                    continue
                out.append("�")
                self.missing, self.low, self.high = 0, 0x80, 0xBF
            if byte < 0x80:
                out.append(chr(byte))
                continue
            lead = next((x for x in self.LEADS if x[0] <= byte <= x[1]), None)
            if lead is None:
                out.append("�")
            else:
                _, _, self.missing, self.low, self.high = lead
                self.code = byte & (0x3F >> self.missing)
        return "".join(out)

    def close(self) -> str:
        """What is left when no more bytes come."""
        left = "�" if self.missing else ""
        self.missing, self.low, self.high = 0, 0x80, 0xBF
        return left


def decode(ids: Iterable[int], tokens: dict[int, bytes]) -> Iterator[str]:
    """The text of token ids, in pieces as they become complete. An unknown id raises KeyError."""
    machine = Utf8Machine()
    for i in ids:
        text = machine.feed(tokens[i])
        if text:
            yield text
    if left := machine.close():
        yield left
