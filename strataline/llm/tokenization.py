"""Token ids of whole texts, through the tokenizers library with a bounded cache of text chunks.

Byte-pair merges never cross the boundaries that a vocabulary's pre-tokenizer sets, so a
text may be cut at such boundaries and each distinct chunk encoded once. Ids travel as bytes:
little-endian unsigned 32-bit integers.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from strataline.llm.caches import remembers

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Distinct chunks in one generation of a worker's cache, by style; the one before it is kept too.
CACHE_ENTRIES = {"spaces_dropped": 600_000, "space_leads": 400_000}
#: Chunks longer than this are encoded whenever they occur and are not kept.
CACHED_CHARS = 64
#: Texts are encoded in groups of about so many characters; what a group repeats is looked up once.
GROUP_CHARS = 4_000_000

#: ASCII marks other than the apostrophe of contractions. Behind a letter they start a new piece.
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: Latin-1 letters that are a piece of their own: only lower-case ones where a vocabulary may lower
#: them, and perhaps behind a line break where that is part of a chunk.
_LETTERS = {
    "spaces_dropped": re.compile(r"[a-zß-öø-ÿ]+").fullmatch,
    "space_leads": re.compile(r"\n?[A-Za-zÀ-ÖØ-öø-ÿ]+").fullmatch,
}
#: Distinct runs of marks that are remembered.
MARK_ENTRIES = 10_000
_AFTER_SPACE = re.compile(r" (?=\S)")


#: What the cache answers for chunks that it does not have; None is an answer.
_UNKNOWN = object()


class ChunkEncoder:
    """Encodes texts to bytes of ids, the same ids as one `encode` of the whole text.

    `style` says where the vocabulary's pre-tokenizer always cuts:
    "spaces_dropped": white space separates and vanishes, any space is a boundary;
    "space_leads": a space followed by a non-space always starts a new piece and stays
    part of it. A null text is treated as empty. `path` is a tokenizer file, or the bare name of
    one of the public tokenizers, whose place each machine finds for itself.
    """

    def __init__(self, path: str, style: str) -> None:
        import public_tokenizers
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        if style not in ("spaces_dropped", "space_leads"):
            raise ValueError(f"unknown style: {style}")
        self.tokenizer = Tokenizer.from_file(path if "/" in path else public_tokenizers.path(path))
        self.style = style
        # Where the vocabulary lower-cases, doing it first makes fewer distinct chunks. In Latin-1
        # every letter has one lower-case form, whatever stands around it.
        self.lowers = self.tokenizer.encode("ABC", add_special_tokens=False).ids == self.tokenizer.encode("abc", add_special_tokens=False).ids
        self.known: dict[str, bytes | None] = {}
        self.older: dict[str, bytes | None] = {}
        self.marks: dict[str, bytes] = {}
        self.line_break = self.tokenizer.encode("\n", add_special_tokens=False).ids[-1:]
        self.line_break = self.line_break[0] if self.line_break else None
        # A run of letters is one piece, which the model takes without the steps before it, as
        # long as those do no more than spell letters and the space as the byte alphabet does.
        self.model = self.tokenizer.model
        bytes_of = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        letters = [c for c in map(chr, range(0x41, 0x100)) if _LETTERS[style](c)]
        self.spelled = {ord(c): bytes_of(c)[0][0] for c in letters}
        self.lead = bytes_of(" ")[0][0] if style == "space_leads" else ""
        tried = [*letters, "".join(letters), "".join(letters[::-1])]
        tried += [f"\n{t}" for t in tried if style == "space_leads"]
        as_cut = [t if t[0] == "\n" or not self.lead else f" {t}" for t in tried]
        self.direct = [self._letters(t) for t in tried] == self._bytes(as_cut)
        self.direct &= not any(t.content.isalpha() for t in self.tokenizer.get_added_tokens_decoder().values())

    def _bytes(self, chunks: list[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in encoded]

    def _bytes_joined(self, chunks: list[str]) -> list[bytes]:
        """As `_bytes`, for chunks that start with a space and hold no line break.

        A line break between such chunks is a piece of its own, so many chunks are encoded
        in one call and the ids cut at it.
        """
        out: list[bytes] = []
        for k in range(0, len(chunks), 300):
            some = chunks[k : k + 300]
            ids = np.array(self.tokenizer.encode_batch_fast(["\n".join(some)], add_special_tokens=False)[0].ids, "<u4")
            cuts = (4 * np.flatnonzero(ids == self.line_break)).tolist()
            if len(cuts) != len(some) - 1:
                raise ValueError("a chunk holds a line break")
            joined = ids.tobytes()
            out += [joined[a:b] for a, b in zip([0, *(c + 4 for c in cuts)], [*cuts, len(joined)], strict=True)]
        return out

    def _letters(self, chunk: str) -> bytes:
        """Ids of a chunk of letters, with its space or line break if it has one before it."""
        before = self.lead
        if chunk[0] == "\n":
            before, chunk = "", chunk[1:]
        spelled = before + (chunk if chunk.isascii() else chunk.translate(self.spelled))
        ids = [t.id for t in self.model.tokenize(spelled)]
        if self.lead and not before:
            ids.insert(0, self.line_break)
        return array("I", ids).tobytes()

    def _of_marks(self, marks: str) -> bytes:
        if marks not in self.marks:
            if len(self.marks) >= MARK_ENTRIES:
                self.marks.clear()
            self.marks[marks] = self._bytes([marks])[0]
        return self.marks[marks]

    def _learn(self, chunks: list[str]) -> list[bytes | None]:
        """Ids of distinct chunks; new ones are encoded. None marks one that is no valid cut."""
        found = list(map(self.known.get, chunks, repeat(_UNKNOWN)))
        places = [k for k, ids in enumerate(found) if ids is _UNKNOWN]
        if len(self.known) + len(places) > CACHE_ENTRIES[self.style]:
            # The others were found in what is now the older generation, and are taken over.
            self.known, self.older, places = {}, self.known, range(len(chunks))
        known, older = self.known, self.older
        if older:
            for k in places:
                found[k] = older.get(chunks[k], _UNKNOWN)
                if found[k] is not _UNKNOWN:
                    known[chunks[k]] = found[k]
            places = [k for k in places if found[k] is _UNKNOWN]
        if self.direct:
            places = self._learn_letters(chunks, places, found)
        new = [chunks[k] for k in places]
        if self.style == "spaces_dropped":
            known.update(zip(new, self._bytes(new), strict=True))
        else:
            self._learn_after_space(new)
        for k in places:
            found[k] = known[chunks[k]]
        return found

    def _learn_letters(self, chunks: list[str], places: Iterable[int], found: list) -> list[int]:
        """Learn chunks of letters, and of letters and marks behind them; the other places are returned."""
        known, is_letters, others = self.known, _LETTERS[self.style], []
        for k in places:
            chunk = chunks[k]
            word = chunk.rstrip(_MARKS)
            if not is_letters(word):
                others.append(k)
                continue
            ids = known.get(word)
            if ids is None:
                known[word] = ids = self._letters(word)
            if len(word) < len(chunk):
                known[chunk] = ids = ids + self._of_marks(chunk[len(word) :])
            found[k] = ids
        return others

    def _learn_after_space(self, new: list[str]) -> None:
        # A chunk that was cut off after a space gets it back; one that starts with a line
        # break was cut off before it. Any other start with white space, or none at all, means
        # that the cut was inside a run of white space.
        self.known.update(dict.fromkeys(new))
        lines = [c for c in new if c[:1] == "\n" and c[1:2].strip()]
        self.known.update(zip(lines, self._bytes(lines), strict=True))
        words = [c for c in new if c and not c[0].isspace()]
        plain = [c for c in words if "\n" not in c]
        self.known.update(zip(plain, self._bytes_joined([f" {c}" for c in plain]), strict=True))

    def _spaced(self, text: str) -> str:
        """The text with a space before every boundary that is used."""
        if self.style == "spaces_dropped":
            return (text.lower() if self.lowers and _is_latin_1(text) else text).replace("\n", " ")
        return text.replace("\n", " \n")

    def _slowly(self, text: str) -> bytes:
        """For texts with runs of white space: cut only before a space that a non-space follows."""
        chunks = _AFTER_SPACE.split(text)
        return b"".join(self._bytes([chunks[0], *(f" {c}" for c in chunks[1:])]))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as bytes. Works through groups of bounded size."""
        out: list[bytes] = []
        for group in _groups(texts):
            out += self._encode_group(group)
        return out

    def _encode_group(self, texts: list[str]) -> list[bytes]:
        spaced = list(map(self._spaced, texts))
        edges = np.cumsum([0, *(t.count(" ") + 1 for t in spaced)])
        cut = pc.split_pattern(pa.array([" ".join(spaced).encode()], pa.large_binary()).view(pa.large_string()), " ")
        coded = cut.values.dictionary_encode()
        place = coded.indices.to_numpy()
        chunks = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = self._learn(chunks)
        if self.style == "space_leads":
            # The first chunk has no space before it, so it is encoded as it stands.
            heads = self._bytes([chunks[k] for k in place[edges[:-1]].tolist()])
            place = place.copy()
            place[edges[:-1]] = np.arange(len(ids), len(ids) + len(heads))
            ids += heads

        slow = set()
        if None in ids:
            irregular = np.flatnonzero(np.array([i is None for i in ids])[place])
            slow = set((np.searchsorted(edges, irregular, "right") - 1).tolist())
            ids = [i or b"" for i in ids]
        every = np.frombuffer(b"".join(ids), "<u4")
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        start = np.cumsum(size) - size
        # Where each id of the group lies among the ids of the distinct chunks.
        sizes = size[place]
        ends = np.cumsum(sizes)
        joined = every[np.repeat(start[place] - ends + sizes, sizes) + np.arange(ends[-1])].tobytes()
        at = (4 * np.concatenate([[0], ends])[edges]).tolist()
        out = [self._slowly(t) if k in slow else joined[at[k] : at[k + 1]] for k, t in enumerate(texts)]
        for chunk in [c for c in chunks if len(c) > CACHED_CHARS]:
            self.known.pop(chunk, None)
            self.known.pop(chunk.rstrip(_MARKS), None)
        return out


def _is_latin_1(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def _groups(texts: Iterable[str | None]) -> Iterator[list[str]]:
    group, size = [], 0
    for text in texts:
        group.append(text or "")
        size += len(group[-1])
        if size >= GROUP_CHARS:
            yield group
            group, size = [], 0
    if group:
        yield group


def in_groups(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows in order, as tables of about as many bytes as a group has characters."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= GROUP_CHARS:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


@lru_cache(maxsize=1)
def encoder(path: str, style: str) -> ChunkEncoder:
    """The encoder that a Python worker keeps from task to task."""
    return ChunkEncoder(path, style)


def _forget() -> int:
    kept = encoder.cache_info().currsize
    encoder.cache_clear()
    return kept


remembers("tokens", _forget)
