"""Token ids by the tokenizers library, each distinct part of a text encoded once.

A text is cut into pieces at single spaces, and its distinct pieces into parts between
a letter and a punctuation mark and at single line feeds before a letter: there both
kinds of tokenizer used here begin a new word whatever stands before.  Ids of a part are
kept by the worker for the next texts.  Texts in which a cut could matter go through the
tokenizer whole.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tallyhouse.llm.wordhash import slices

#: Parts kept by a worker; beyond that it starts anew.
CACHED_PARTS = 1_000_000
#: Bytes of text encoded at once.
SLICE_CHARS = 4_000_000
#: Parts encoded as one text.
_JOINED = 2000
#: Letters for all versions of Unicode, of which none has another form after a mark below.
_LETTER = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f\u0400-\u0481"
#: Where a piece is cut.  An apostrophe may be in one token with a letter.
_BEFORE_MARK = f"([{_LETTER}])([.,;:!?])"
_AROUND_LINE_FEED = f"([!-~{_LETTER}])\n([{_LETTER}])"
#: One that no piece at hand has stands for the cuts.
_CUTS = ("\0", "\1", "\2", "\3", "\4", "\5")


def _parts(pieces: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Parts of all pieces in a row, and the index of each piece's first part (with the end)."""
    for cut in _CUTS:
        if not pc.any(pc.match_substring(pieces, cut)).as_py():
            marked = pc.replace_substring_regex(pieces, _BEFORE_MARK, f"\\1{cut}\\2")
            marked = pc.replace_substring_regex(marked, _AROUND_LINE_FEED, f"\\1{cut}\n{cut}\\2")
            parts = pc.split_pattern(marked, cut)
            return parts.flatten(), parts.offsets.to_numpy() - parts.offsets[0].as_py()
    return pieces, np.arange(len(pieces) + 1)


def _rows_taken(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places ``starts[i], starts[i] + 1, ...``, ``sizes[i]`` of them, for one i after the other."""
    ends = np.cumsum(sizes)
    place = np.repeat(starts - (ends - sizes), sizes)
    place += np.arange(len(place))
    return place


def public_tokenizer(name: str) -> str:
    """Path of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


class PieceEncoder:
    """``keeps_space``: the space before a word belongs to the word's token.

    For such tokenizers white space in a row is one token or several depending
    on what follows, so a text in which a piece other than the last is empty or ends
    in white space is encoded whole; so is one with a special token's text.
    """

    def __init__(self, path: str, keeps_space: bool):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.keeps_space = keeps_space
        # Both are one token wherever they stand between pieces.
        self.separator, self.mark = ("\n", "\n") if keeps_space else (" ^ ", "^")
        (self.separator_id,) = self._encoded([self.separator])[0]
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.bare = self._bare(path)
        self._clear()

    def _bare(self, path: str):
        """The tokenizer for words of ASCII letters, which it need not look for; None if it differs."""
        from tokenizers import Tokenizer

        bare = Tokenizer.from_file(path)
        bare.normalizer = bare.pre_tokenizer = None
        words = ["a", "The", "Words", "tokenIZERS", "zzXq", "of"]
        words += [f" {w}" for w in words] if self.keeps_space else []
        flat, sizes = self._one_by_one(words)
        own, own_sizes = self._words_encoded(words, bare)
        return bare if np.array_equal(flat, own) and np.array_equal(sizes, own_sizes) else None

    def _is_word(self, part: str) -> bool:
        core = part[1:] if self.keeps_space and part[:1] == " " else part
        return core.isascii() and core.isalpha()

    def _words_encoded(self, words: list[str], bare=None) -> tuple[np.ndarray, np.ndarray]:
        """As :meth:`_pieces_encoded`, for words of ASCII letters, in the form that the model meets."""
        if self.keeps_space:
            formed = [w.replace(" ", "\u0120") for w in words]
        else:
            formed = [w.lower() for w in words]
        mark = "\u010a" if self.keeps_space else self.mark
        groups = [
            [x for word in formed[i : i + _JOINED] for x in (word, mark)]
            for i in range(0, len(formed), _JOINED)
        ]
        done = (bare or self.bare).encode_batch_fast(
            groups, is_pretokenized=True, add_special_tokens=False
        )
        row = np.concatenate([np.array(e.ids, np.uint32) for e in done])
        at = np.flatnonzero(row == self.separator_id)
        return row[row != self.separator_id], np.diff(at, prepend=-1) - 1

    def _clear(self) -> None:
        self.numbers: dict[str, int] = {}
        self.ids = np.empty(0, np.uint32)
        self.sizes = np.empty(0, np.int64)
        self.starts = np.empty(0, np.int64)

    def _encoded(self, texts: list[str]) -> list[list[int]]:
        done = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [e.ids for e in done]

    def _one_by_one(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        lists = self._encoded(pieces)
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        return np.fromiter(chain.from_iterable(lists), np.uint32, int(sizes.sum())), sizes

    def _pieces_encoded(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces in a row, and how many each has.

        Pieces are encoded as one text with a separator that is always one token of
        its own between them.  Should the separators not come out as they went in, the
        pieces are encoded one by one.
        """
        groups = [pieces[i : i + _JOINED] for i in range(0, len(pieces), _JOINED)]
        ids, sizes = [], []
        for group, found in zip(groups, self._encoded([self.separator.join(g) for g in groups])):
            row = np.array(found, np.uint32)
            at = np.flatnonzero(row == self.separator_id)
            if len(at) == len(group) - 1:
                ids.append(row[row != self.separator_id])
                sizes.append(np.diff(np.concatenate([[-1], at, [len(row)]])) - 1)
            else:
                flat, lengths = self._one_by_one(group)
                ids.append(flat)
                sizes.append(lengths)
        return np.concatenate(ids), np.concatenate(sizes)

    def _can_join(self, piece: str) -> bool:
        """No white space but one space in front, and nothing of the separator."""
        core = piece[1:] if self.keeps_space and piece[:1] == " " else piece
        return core.split() == [core] and self.mark not in core

    def _numbered(self, parts: list[str]) -> np.ndarray:
        """Number of each part in the kept ids; new parts are encoded."""
        numbers = self.numbers
        fresh = [p for p in parts if p not in numbers]
        words = [p for p in fresh if self._is_word(p)] if self.bare else []
        others = [p for p in fresh if not self._is_word(p)] if words else fresh
        plain = [p for p in others if self._can_join(p)]
        odd = [p for p in others if not self._can_join(p)] if len(plain) < len(others) else []
        ways = (self._words_encoded, self._pieces_encoded, self._one_by_one)
        for some, encode in zip((words, plain, odd), ways):
            if some:
                flat, sizes = encode(some)
                numbers.update(zip(some, range(len(numbers), len(numbers) + len(some))))
                self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(sizes) - sizes])
                self.sizes = np.concatenate([self.sizes, sizes])
                self.ids = np.concatenate([self.ids, flat])
        return np.fromiter(map(numbers.__getitem__, parts), np.int64, len(parts))

    def _of_pieces(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all pieces in a row, where each begins, and how many it has."""
        parts, offsets = _parts(pieces)
        coded = parts.dictionary_encode()
        numbers = self._numbered(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
        sizes = self.sizes[numbers]
        ids = self.ids[_rows_taken(self.starts[numbers], sizes)]
        edges = np.concatenate([[0], np.cumsum(sizes)])[offsets]
        return ids, edges[:-1], np.diff(edges)

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text (large_string without NULL)."""
        result: list[np.ndarray] = []
        for start, end in slices(texts, SLICE_CHARS):
            result += self._encode_slice(texts.slice(start, end - start))
        return result

    def _encode_slice(self, texts: pa.Array) -> list[np.ndarray]:
        if len(self.numbers) > CACHED_PARTS:
            self._clear()
        whole = np.zeros(len(texts), bool)
        for special in self.special:
            whole |= pc.match_substring(texts, special).to_numpy(zero_copy_only=False)
        parts = pc.split_pattern(texts, " ")
        offsets = parts.offsets.to_numpy() - parts.offsets[0].as_py()
        coded = parts.flatten().dictionary_encode()
        at = coded.indices.to_numpy()
        pieces = coded.dictionary
        if self.keeps_space:
            # Last white space of a piece, or none of anything, before another piece.
            trimmed = pc.utf8_rtrim_whitespace(coded.dictionary)
            empty = pc.equal(pc.binary_length(coded.dictionary), 0).to_numpy(zero_copy_only=False)
            odd = empty | pc.not_equal(trimmed, coded.dictionary).to_numpy(zero_copy_only=False)
            inner = odd[at]
            inner[offsets[1:] - 1] = False
            inner[offsets[:-1][empty[at[offsets[:-1]]]]] = False
            owner = np.repeat(np.arange(len(texts)), np.diff(offsets))
            whole[owner[inner]] = True
            heads = pieces.take(pa.array(at[offsets[:-1]])).dictionary_encode()
            space = pa.scalar(" ", pieces.type)
            spaced = pc.binary_join_element_wise(space, pieces, pa.scalar("", pieces.type))
            at = at.astype(np.int64)
            at[offsets[:-1]] = len(pieces) + heads.indices.to_numpy()
            pieces = pa.concat_arrays([spaced, heads.dictionary])
        known, starts, sizes = self._of_pieces(pieces)
        sizes = sizes[at]
        ids = known[_rows_taken(starts[at], sizes)]
        edges = np.concatenate([[0], np.cumsum(sizes)])[offsets]
        found = [ids[i:j] for i, j in zip(edges[:-1].tolist(), edges[1:].tolist())]
        odd_texts = np.flatnonzero(whole)
        for i, x in zip(odd_texts, self._encoded([texts[int(i)].as_py() for i in odd_texts])):
            found[i] = np.array(x, np.uint32)
        return found


_ENCODERS: dict[tuple[str, bool], PieceEncoder] = {}


def encoder(path: str, keeps_space: bool) -> PieceEncoder:
    """The worker's encoder for a file; workers outlive tasks, and so do its pieces."""
    key = (path, keeps_space)
    if key not in _ENCODERS:
        _ENCODERS[key] = PieceEncoder(path, keeps_space)
    return _ENCODERS[key]


def encoded_batches(
    batches: Iterator[pa.RecordBatch], path: str, keeps_space: bool, end_id: int
) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Batches of moderate size with the ids of column ``text``, ``end_id`` at the end of each."""
    # What earlier tasks of this worker no longer need goes back to the system first.
    pa.default_memory_pool().release_unused()
    tokenizer = encoder(path, keeps_space)
    last = np.array([end_id], np.uint32)
    for batch in batches:
        texts = pc.fill_null(batch["text"].cast(pa.large_string()), "")
        for start, end in slices(texts, SLICE_CHARS):
            ids = tokenizer.encode(texts.slice(start, end - start))
            yield batch.slice(start, end - start), [np.concatenate([x, last]) for x in ids]
