"""Token ids of whole texts by a byte-level BPE of the ``tokenizers`` library.

The vocabulary's own splitting pattern cuts a text into pieces that are merged one by one. Pieces
repeat a lot, so the library's model merges each distinct one once per worker, in a memory of
bounded size, and a text's ids are looked up. Ids equal those of ``Tokenizer.encode``.

No piece reaches from a character that is no white space over white space. Many texts together are
therefore cut into chunks first, words with the blank before them and other white space; the chunks
of a lot are numbered, and the ids of each different one are looked up once and gathered by the
numbers. New chunks that begin with a blank are cut by the pattern many at a time, as one text in
which the pieces with a blank at their head show where a chunk begins. A text longer than a lot is cut between two chunks, whatever its length.
"""

from __future__ import annotations

import os
import struct
from collections.abc import Generator, Iterable, Iterator

import regex

# The splitting pattern of the byte-level vocabulary (fixed value).
PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
CHUNK = regex.compile(r" ?\S+|\s+(?!\S)|\s")
# One blank or line end between other characters: a chunk begins there.
SEAM = regex.compile(r"(?<=\S)[ \n](?=\S)")
KEPT_PIECES = 100_000
KEPT_CHUNKS = 250_000
NEW_AT_ONCE = 20_000
LONGEST_KEPT = 64
LOT = 1 << 21
# A text with none of these, nor white space at an end, has single blanks and line ends between words only.
MIXED = ["  ", " \n", "\n ", "\n\n", *[c for c in map(chr, range(1 << 14)) if c.isspace() and c not in " \n"]]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Recent(dict):
    """A bounded memory: when full, what is not asked for again goes with the generation before."""

    def __init__(self, make, kept: int):
        super().__init__()
        self.make, self.kept, self.old = make, kept, {}

    def __missing__(self, key: str):
        value = self.old[key] if key in self.old else self.make(key)
        if len(key) <= LONGEST_KEPT:
            if len(self) >= self.kept:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


def byte_letters() -> dict[int, str]:
    """The letter by which byte-level vocabularies write each byte: itself if printable, else from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


def packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def marked(text: str) -> str:
    """The text with a zero between its chunks; it must hold none of its own."""
    if not text or text[0] in " \n" or text[-1] in " \n" or any(m in text for m in MIXED):
        return "\0".join(CHUNK.findall(text))
    return text.replace("\n", "\0\n\0").replace(" ", "\0 ")


class IdEncoder:
    """``encode(text)`` gives the ids of a text as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str, kept_chunks: int = KEPT_CHUNKS):
        self.kept_chunks = kept_chunks
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merge = self.tokenizer.model.tokenize
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.letters = byte_letters()
        self.ids_of = Recent(self._piece, KEPT_PIECES).__getitem__
        self.known: dict[str, bytes] = {}
        self.known_before: dict[str, bytes] = {}
        self.ending = Recent(self._ids, KEPT_PIECES).__getitem__

    def _piece(self, piece: str) -> bytes:
        return packed(self._ids(piece))

    def _ids(self, piece: str) -> list[int]:
        if piece.isascii() and piece.isprintable():
            letters = piece.replace(" ", self.letters[32])  # the others stand for themselves
        else:
            letters = piece.encode().decode("latin-1").translate(self.letters)
        return [t.id for t in self.merge(letters)]

    def _chunk(self, chunk: str) -> bytes:
        return b"".join(map(self.ids_of, PIECE.findall(chunk)))

    def _is_special(self, text: str) -> bool:
        return any(s in text for s in self.special)

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self._is_special(text):  # the library decides what they are
            return packed(self.tokenizer.encode(text, add_special_tokens=False).ids)
        return self._chunk(text)

    def encode_all(self, texts: Iterable[str | None], lot: int = LOT) -> Iterator[bytes]:
        """``encode`` of each text, in order, by lots of about ``lot`` characters."""
        parts: list[str] = []
        lasts: list[bool] = []
        size, begun = 0, b""
        for text in texts:
            for part, last in self._parts(text or "", lot):
                parts.append(part)
                lasts.append(last)
                size += len(part) + 1
                if size >= lot:
                    begun = yield from _joined(self._lot(parts), lasts, begun)
                    parts, lasts, size = [], [], 0
        yield from _joined(self._lot(parts), lasts, begun)

    def _parts(self, text: str, lot: int) -> Iterator[tuple[str, bool]]:
        """The text in parts that begin with a chunk, and whether each is the last."""
        at = 0
        if len(text) > lot and not self._is_special(text):
            while seam := SEAM.search(text, at + lot):
                yield text[at : seam.start()], False
                at = seam.start()
        yield text[at:], True

    def _chunk_ids(self, chunks: list[str]) -> list[bytes]:
        """The ids of different chunks; like ``Recent``, two generations of a bounded size remember them."""
        found = list(map(self.known.get, chunks))
        unknown = [i for i, ids in enumerate(found) if ids is None]
        led = []
        for i in unknown:
            chunk = chunks[i]
            ids = self.known_before.get(chunk)
            if ids is None:
                if chunk[:1] == " " != chunk:
                    led.append(i)
                    continue
                ids = self._chunk(chunk)
            found[i] = ids
        for at in range(0, len(led), NEW_AT_ONCE):
            some = led[at : at + NEW_AT_ONCE]
            for i, ids in zip(some, self._led([chunks[i] for i in some])):
                found[i] = ids
        if len(self.known) + len(unknown) > self.kept_chunks:
            self.known_before, self.known = self.known, {}
        self.known.update((chunks[i], found[i]) for i in unknown if len(chunks[i]) <= LONGEST_KEPT)
        return found

    def _led(self, chunks: list[str]) -> list[bytes]:
        """The ids of chunks of a blank, their only white space, and what follows it."""
        import numpy as np

        ids: list[int] = []
        starts: list[int] = []
        for piece in PIECE.findall("".join(chunks)):
            if piece[0] == " ":
                starts.append(4 * len(ids))
                ids += self._ids(piece)
            else:
                ids += self.ending(piece)
        data = np.array(ids, "<u4").tobytes()
        return [data[a:b] for a, b in zip(starts, [*starts[1:], len(data)])]

    def _lot(self, parts: list[str]) -> list[bytes]:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        alone = [i for i, p in enumerate(parts) if "\0" in p or self._is_special(p)]
        texts = [marked(p) for p in parts]
        for i in alone:
            texts[i] = ""
        cut = pc.split_pattern(pa.array(texts, pa.large_string()), "\0")
        numbers = cut.flatten().dictionary_encode()
        found = self._chunk_ids(numbers.dictionary.to_numpy(zero_copy_only=False).tolist())
        sizes = np.fromiter(map(len, found), np.int32, len(found)) // 4
        starts = np.cumsum(sizes, dtype=np.int32) - sizes
        which = numbers.indices.to_numpy()
        sizes = sizes[which]
        ends = np.zeros(len(sizes) + 1, np.int32)  # a text of Spark has fewer than 2 ** 31 bytes
        np.cumsum(sizes, out=ends[1:])
        places = np.repeat(starts[which] - ends[:-1], sizes) + np.arange(ends[-1], dtype=np.int32)
        ids = np.frombuffer(b"".join(found), "<u4")[places].tobytes()
        bounds = (4 * ends[cut.offsets.to_numpy()].astype(np.int64)).tolist()
        out = [ids[a:b] for a, b in zip(bounds, bounds[1:])]
        for i in alone:
            out[i] = self.encode(parts[i])
        return out


def _joined(found: list[bytes], lasts: list[bool], begun: bytes) -> Generator[bytes, None, bytes]:
    """The ids of each text whose last part is here; gives back those of a text that goes on."""
    held = [begun]
    for ids, last in zip(found, lasts):
        held.append(ids)
        if last:
            yield b"".join(held)
            held = []
    return b"".join(held)


_ENCODERS: dict[tuple[str, int], IdEncoder] = {}


def encoder(path: str, kept_chunks: int = KEPT_CHUNKS) -> IdEncoder:
    """One encoder per worker process, vocabulary file and number of chunks it remembers."""
    if (path, kept_chunks) not in _ENCODERS:
        _ENCODERS[path, kept_chunks] = IdEncoder(path, kept_chunks)
    return _ENCODERS[path, kept_chunks]


def forget_encoders() -> None:
    """Lets go of this worker's encoders: a worker outlives its stage, and what they remember is of no use to another one."""
    _ENCODERS.clear()
