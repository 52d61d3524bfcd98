"""Token ids of whole texts with the tokenizers library.

``Encoder.encode(texts)`` gives, for each text, the ids that the library gives for it. The
tokenizer files cut a text at a single space or line break, and between letters and a sign such
as a comma, before anything else; so it is enough to have the library encode the distinct pieces
of a slice of texts (all plain words in one text, cut again where a word begins or ends) and to put
the texts together from them. Arrow cuts the texts and finds the distinct pieces, numpy puts the
ids together; there is no Python step per word. Texts where white space meets white space, where
the cut would depend on both sides, go to the library whole, and so do texts that hold the literal of
an added token such as ``<|endoftext|>``, which the library by default gives that token's id.
"""

from __future__ import annotations

import functools
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Characters of text that are encoded at once: the more, the more often a piece recurs; the fewer, the
#: more of the work stays in the cache.
SLICE_CHARS = 4_000_000
#: Words in one call of the library, which takes some hundred bytes for each.
WORDS_AT_ONCE = 20_000
#: Plain words that are kept from slice to slice with their ids; later ones are encoded each time.
MAX_WORDS = 400_000
#: Tails (a sign and what follows it) that are kept from slice to slice.
MAX_TAILS = 50_000
#: Letters, then a tail from the first of these signs on: both files cut between the two.
_STEM = "(?s)^(?P<stem>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<tail>[.,!?;:*$%&#].*)$"
_BLANK = r"^(?:$|[\s\pZ\x{85}\x{1c}-\x{1f}])"


@functools.lru_cache(maxsize=2)
def encoder_of(path: str) -> Encoder:
    """The encoder of a Python worker, kept from task to task; the library's defaults hold."""
    return Encoder(path, split_added=False)


def _gather(ids: np.ndarray, size: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries ``which`` of a list of entries (``size`` ids each, one after the other)."""
    begin, each = (np.cumsum(size) - size)[which], size[which]
    end = np.cumsum(each)
    total = int(end[-1]) if len(end) else 0
    kind = np.int32 if max(total, len(ids)) < 1 << 31 else np.int64
    at = np.repeat((begin - (end - each)).astype(kind), each)
    at += np.arange(total, dtype=kind)
    return ids[at], each


class Encoder:
    """Ids for columns of texts. ``split_added`` has literals of special tokens encoded like other text
    (the library's ``encode_special_tokens``); the operators leave it off, see ``encoder_of``."""

    def __init__(self, path: str, split_added: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = split_added
        self.added = sorted({t.content for t in self.tok.get_added_tokens_decoder().values()
                             if t.content and not (split_added and t.special)})
        # Ids that begin a word with its space, or that end a word: where a text of words is cut.
        names = {i: t for t, i in self.tok.get_vocab().items()}
        flags = [names.get(i, "") for i in range(max(names, default=0) + 1)]
        self.ends_word = np.array([t.endswith("</w>") for t in flags])
        self.begins = {" ": np.array([t.startswith("\u0120") for t in flags]), "\n": np.zeros(len(flags), bool)}
        line = self._ids(["\n"])[0]
        if len(line) == 1:
            self.begins["\n"][line] = True
        self.tails: dict[str, np.ndarray] = {}
        self.words = {gap: (pa.array([], pa.large_string()), np.empty(0, "<u4"), np.empty(0, np.int64)) for gap in self.begins}

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _arrays(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, "<u4") for ids in self._ids(texts)]

    def _words(self, gap: str, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain, distinct words that each follow ``gap``, and how many each has."""
        known, known_ids, known_sizes = self.words[gap]
        at = pc.index_in(words, value_set=known)
        unseen = words.filter(at.is_null())
        new_ids, new_sizes = self._new_words(gap, unseen)
        place = np.asarray(at.fill_null(-1)).astype(np.int64)
        place[place < 0] = len(known) + np.arange(len(unseen))
        ids, sizes = np.concatenate((known_ids, new_ids)), np.concatenate((known_sizes, new_sizes))
        room = min(MAX_WORDS, len(known) + len(unseen))
        if room > len(known):
            kept = pa.concat_arrays([known, unseen.cast(known.type).slice(0, room - len(known))])
            self.words[gap] = kept, ids[: int(sizes[:room].sum())].copy(), sizes[:room].copy()
        return _gather(ids, sizes, place)

    def _new_words(self, gap: str, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        ids, sizes = [np.empty(0, "<u4")], [np.empty(0, np.int64)]
        for lo in range(0, len(words), WORDS_AT_ONCE):
            new_ids, new_sizes = self._some_words(gap, words.slice(lo, WORDS_AT_ONCE).to_pylist())
            ids.append(new_ids)
            sizes.append(new_sizes)
        return np.concatenate(ids), np.concatenate(sizes)

    def _some_words(self, gap: str, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        n = len(words)
        ids = np.array(self._ids([gap + gap.join(words)])[0], "<u4")
        begin = np.flatnonzero(self.begins[gap][ids])
        if len(begin) != n:
            begin = np.append(0, np.flatnonzero(self.ends_word[ids])[:-1] + 1)
        if len(begin) == n and begin[0] == 0:
            return ids, np.diff(np.append(begin, len(ids)))
        each = self._arrays([gap + w for w in words])
        return np.concatenate(each), np.fromiter(map(len, each), np.int64, n)

    def _tail_ids(self, tails: list[str]) -> list[np.ndarray]:
        new = [t for t in tails if t not in self.tails]
        if len(self.tails) + len(new) > MAX_TAILS:
            self.tails.clear()
            new = tails
        self.tails.update(zip(new, self._arrays(new)))
        return [self.tails[t] for t in tails]

    def _pieces(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct pieces that follow a space, or begin with a line break, and their sizes."""
        line = pc.starts_with(words, "\n")
        bare = pc.if_else(line, pc.utf8_slice_codeunits(words, 1), words)
        parts = pc.extract_regex(bare, _STEM)
        cut = parts.is_valid()
        stem = pc.if_else(cut, parts.field("stem"), bare)
        plain = pc.match_substring_regex(stem, r"^\pL+$")
        ids, sizes = [], []
        place, total = np.zeros(len(words), np.int64), 0

        def put(rows: np.ndarray, index: np.ndarray, new_ids: np.ndarray, new_size: np.ndarray) -> None:
            nonlocal total
            place[rows] = total + index
            total += len(new_size)
            ids.append(new_ids)
            sizes.append(new_size)

        for gap, group in ((" ", pc.invert(line)), ("\n", line)):
            chosen = pc.and_(plain, group)
            distinct = stem.filter(chosen).dictionary_encode()
            put(np.flatnonzero(chosen), np.asarray(distinct.indices, dtype=np.int64), *self._words(gap, distinct.dictionary))
            chosen = pc.and_(pc.invert(plain), group)
            distinct = stem.filter(chosen).dictionary_encode()
            each = self._arrays([gap + w for w in distinct.dictionary.to_pylist()])
            put(np.flatnonzero(chosen), np.asarray(distinct.indices, dtype=np.int64),
                np.concatenate([np.empty(0, "<u4"), *each]), np.fromiter(map(len, each), np.int64, len(each)))
        tails = parts.field("tail").filter(cut).dictionary_encode()
        each = self._tail_ids(tails.dictionary.to_pylist())
        tail_place = np.zeros(len(words), np.int64)     # entry 0 below is empty
        tail_place[np.flatnonzero(cut)] = 1 + np.asarray(tails.indices, dtype=np.int64)
        size = np.concatenate([*sizes, [0], np.fromiter(map(len, each), np.int64, len(each))]).astype(np.int64)
        both = np.stack((place, total + tail_place), axis=1).reshape(-1)
        out, each_size = _gather(np.concatenate([*ids, *each]), size, both)
        return out, each_size.reshape(-1, 2).sum(1)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and how many each text has (null: none)."""
        n = len(texts)
        if n == 0:
            return np.empty(0, "<u4"), np.empty(0, np.int64)
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        split = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        pieces = split.flatten().dictionary_encode()
        first = np.asarray(split.offsets)[:-1].astype(np.int64) - split.offsets[0].as_py()
        words, which = pieces.dictionary, np.array(pieces.indices, dtype=np.int64)
        heads = words.take(pa.array(which[first])).to_pylist()
        unsafe = np.asarray(pc.match_substring_regex(pc.if_else(
            pc.starts_with(words, "\n"), pc.utf8_slice_codeunits(words, 1), words), _BLANK))
        owner = np.repeat(np.arange(n), np.diff(np.append(first, len(which))))
        doubtful = unsafe[which]
        doubtful[first] = False
        holds = np.zeros(n, bool)
        for literal in self.added:
            holds |= np.asarray(pc.match_substring(texts, literal))
        whole = np.union1d(owner[doubtful], np.flatnonzero(holds))
        ids, size = self._pieces(words)
        # Behind the pieces' entries: an empty one, the first pieces (no space before), whole texts.
        extra = [np.empty(0, "<u4"), *self._arrays(heads)]
        if len(whole):
            which[np.isin(owner, whole)] = len(words)
            kept = np.setdiff1d(np.arange(n), whole)
            which[first[kept]] = len(words) + 1 + kept
            which[first[whole]] = len(words) + len(extra) + np.arange(len(whole))
            extra += self._arrays(texts.take(pa.array(whole)).to_pylist())
        else:
            which[first] = len(words) + 1 + np.arange(n)
        size = np.concatenate((size, np.fromiter(map(len, extra), np.int64, len(extra))))
        out, each = _gather(np.concatenate((ids, *extra)), size, which)
        return out, np.add.reduceat(each, first)

    def encode_ended(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Like ``encode``, with ``end_id`` behind each text's ids."""
        ids, size = self.encode(texts)
        return np.insert(ids, np.cumsum(size), end_id).astype("<u4", copy=False), size + 1
