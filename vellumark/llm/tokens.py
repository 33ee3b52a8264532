"""Token ids of whole texts as the tokenizers library gives them, with every distinct word encoded once per task."""

from __future__ import annotations

import json
import os
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc

from vellumark.llm.scan import _SPACE, span_hashes, string_array, text_bytes

TOKENIZER = "word_bpe_49k.json"
CACHED_WORDS = 500_000  # words a worker remembers; further ones are encoded again in each batch
_JOINED_WORDS = 2000
# What the tokenizer files that are taken here say of words.
WORD_END = "</w>"
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def tokenizer_path(name: str = TOKENIZER) -> str:
    return public_tokenizers.path(name)


class WordEncoder:
    """Ids of texts, put together from the ids of their words.

    For tokenizers that drop white space, fold case, and take runs of letters,
    single digits and runs of signs for words: no token reaches over these, so
    the ids of a text are those of its units in order. The library encodes each
    distinct unit once. Runs between white space with other characters go to
    the library whole and as they are: it composes letters before it folds
    them. A file that works otherwise is refused.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        special = {i: t.content for i, t in self.library.get_added_tokens_decoder().items()}
        self.special = [t for t in special.values()]
        self.mark, self.mark_text = next(iter(special.items()))
        self.size = self.library.get_vocab_size()
        self.ends_word = np.array([t.endswith(WORD_END) for t in self.strings], bool)
        self._refuse_others(path)
        self.words = pa.array([], pa.string())  # remembered, with hashes ascending and the place of each
        self.hashes, self.places = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.starts = np.zeros(1, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def _refuse_others(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        kinds = [n["type"] for n in (parts["normalizer"] or {}).get("normalizers", [])]
        ends = parts["model"].get("end_of_word_suffix")
        split = [p.get("pattern", {}).get("Regex") for p in (parts["pre_tokenizer"] or {}).get("pretokenizers", [])]
        if kinds != ["NFC", "Replace", "Lowercase"] or ends != WORD_END or SPLIT not in split or not self.special:
            raise ValueError(f"{path}: not a tokenizer of words that drops white space and folds case")

    @property
    def strings(self) -> list[str]:
        """Text of each id; decoding joins these with a space, as the file names no decoder."""
        return [self.library.id_to_token(i) or "" for i in range(self.size)]

    def _library_ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each word: words joined by a special token, which the library cuts out first."""
        odd = [i for i, w in enumerate(words) if "<|" in w]
        out: list[np.ndarray] = []
        for at in range(0, len(words), _JOINED_WORDS):
            part = words[at : at + _JOINED_WORDS]
            text = self.mark_text.join("" if "<|" in w else w for w in part) + self.mark_text
            out.append(np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32))
        ids = np.concatenate(out) if out else np.zeros(0, np.uint32)
        ends = np.flatnonzero(ids == self.mark)
        counts = np.diff(np.concatenate([[-1], ends])) - 1
        ids = np.delete(ids, ends)
        if odd:
            starts = np.concatenate([[0], np.cumsum(counts)])
            parts = [ids[starts[i] : starts[i + 1]] for i in range(len(words))]
            for i in odd:
                parts[i] = np.array(self.library.encode(words[i], add_special_tokens=False).ids, np.uint32)
            counts = np.array([len(p) for p in parts], np.int64)
            ids = np.concatenate(parts)
        return ids, counts.astype(np.int64)

    def _unit_ids(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each unit that is a single word to the tokenizer: joined by spaces, told apart by tokens that end words."""
        out: list[np.ndarray] = []
        for at in range(0, len(units), _JOINED_WORDS):
            text = " ".join(units[at : at + _JOINED_WORDS])
            out.append(np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32))
        ids = np.concatenate(out) if out else np.zeros(0, np.uint32)
        ends = np.flatnonzero(self.ends_word[ids])
        if len(ends) != len(units):
            raise ValueError("the tokenizer does not end words as its file says")
        return ids, np.diff(np.concatenate([[-1], ends])).astype(np.int64)

    def _new_ids(self, words: list[str], hard: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each word; those that are `hard` may be several words to the tokenizer."""
        easy = np.flatnonzero(~hard)
        hard = np.flatnonzero(hard)
        ids, counts = self._unit_ids([words[i] for i in easy])
        more, many = self._library_ids([words[i] for i in hard])
        order = np.concatenate([easy, hard]).argsort(kind="stable")
        both, flat = np.concatenate([counts, many]), np.concatenate([ids, more])
        begins = np.concatenate([[0], np.cumsum(both)])[:-1][order]
        counts = both[order]
        return gather(flat, begins, counts, np.concatenate([[0], np.cumsum(counts)])), counts

    def _words(self, texts: pa.StringArray) -> tuple[pa.StringArray, np.ndarray, np.ndarray]:
        """Words of all texts without white space, which of them are hard, and where each text's words begin."""
        body, bounds = text_bytes(texts)
        low = pc.ascii_lower(texts)
        if any(pc.any(pc.match_substring(low, t)).as_py() for t in self.special):  # cut out before all else, whatever is around
            lists = pc.ascii_split_whitespace(texts)
            words = lists.flatten()
            return words, np.ones(len(words), bool), lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py()
        body, starts, hard, bounds = units(body, bounds)
        offsets = np.append(starts, len(body)).astype(np.int32)
        return pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(body)), hard, bounds

    def _known(self, words: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """Hash of each word, and its place among the words remembered, -1 if it is none of them."""
        body, bounds = text_bytes(words)
        hashes = span_hashes(body, bounds[:-1], bounds[1:])
        place = np.full(len(words), -1, np.int64)
        if len(self.words) and len(words):
            at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
            hit = np.flatnonzero(self.hashes[at] == hashes)
            found = self.places[at[hit]]
            same = pc.equal(self.words.take(pa.array(found)), words.take(pa.array(hit))).to_numpy(zero_copy_only=False)
            place[hit[same]] = found[same]  # two words of one hash are told apart
        return hashes, place

    def _remember(self, words: pa.StringArray, hashes: np.ndarray) -> None:
        order = np.argsort(hashes, kind="stable")
        at = np.searchsorted(self.hashes, hashes[order])
        self.hashes = np.insert(self.hashes, at, hashes[order])
        self.places = np.insert(self.places, at, len(self.words) + order)
        self.words = pa.concat_arrays([self.words, words])

    def encode(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and where each text's begin."""
        words, hard, bounds = self._words(string_array(texts))
        coded = words.dictionary_encode()
        if isinstance(coded, pa.ChunkedArray):
            coded = coded.combine_chunks()
        distinct, codes = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
        hashes, place = self._known(distinct)
        fresh = np.flatnonzero(place < 0)
        starts, flat = self.starts, self.flat
        if len(fresh):
            tough = np.zeros(len(distinct), bool)
            tough[codes[hard]] = True
            new = distinct.take(pa.array(fresh))
            ids, counts = self._new_ids(new.to_pylist(), tough[fresh])
            place[fresh] = len(starts) - 1 + np.arange(len(fresh))
            starts = np.concatenate([starts, starts[-1] + np.cumsum(counts)])
            flat = np.concatenate([flat, ids])
            room = min(CACHED_WORDS - len(self.words), len(fresh))
            if room > 0:
                self._remember(new.slice(0, room), hashes[fresh[:room]])
                self.starts = starts[: len(self.starts) + room]
                self.flat = flat[: self.starts[-1]]
        at = place[codes]
        begins, counts = starts[at], starts[at + 1] - starts[at]
        ends = np.concatenate([[0], np.cumsum(counts)])
        return gather(flat, begins, counts, ends), ends[bounds]


# Bytes of easy words: letters, digits, signs. What is hard stays with its word: apostrophes (which make words of
# their own with what follows), control characters, and everything beyond U+00FF, that may be composed with others.
_BLANK, _LETTER, _DIGIT, _SIGN, _HARD = range(5)
_CLASS = np.full(256, _HARD, np.uint8)
_CLASS[0x21:0x7F] = _SIGN
_CLASS[ord("'")] = _HARD
_CLASS[ord("0") : ord("9") + 1] = _DIGIT
_CLASS[ord("A") : ord("Z") + 1] = _LETTER
_CLASS[ord("a") : ord("z") + 1] = _LETTER
_CLASS[_SPACE] = _BLANK
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 0x20
_LATIN, _CROSSES = 0xC3, (0x97, 0xB7)  # U+00C0 to U+00FF: letters but for the signs of multiplication and division


def units(body: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes without white space and with A-Z folded in easy words, where each unit begins, which are hard, and
    where each text's units begin.

    A unit is what the tokenizer takes for one word: a run of letters, a digit,
    a run of signs. A run between white space that holds anything else is one
    hard unit, as it is; so is one with `<|`, which may begin a special token.
    """
    if not len(body):
        return body, np.zeros(0, np.int32), np.zeros(0, bool), np.zeros(len(bounds), np.int64)
    kind = _CLASS[body]
    lead = np.flatnonzero(body[:-1] == _LATIN)
    lead = lead[~np.isin(body[lead + 1], _CROSSES)]
    kind[lead] = kind[lead + 1] = _LETTER
    marks = np.flatnonzero((body[:-1] == ord("<")) & (body[1:] == ord("|")))
    kind[marks] = _HARD
    solid = kind != _BLANK
    new = np.zeros(len(body), bool)  # begins a run between white space
    new[bounds[:-1][bounds[:-1] < len(body)]] = True
    new[0] = True
    new[1:] |= ~solid[:-1]
    new &= solid
    inner = np.zeros(len(body), bool)
    inner[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
    inner &= solid
    folded = _FOLD[body]
    runs, hard = np.flatnonzero(new), np.flatnonzero(kind == _HARD)
    hard_runs = np.zeros(len(runs), bool)
    if len(hard):
        hard_runs[np.searchsorted(runs, hard, "right") - 1] = True
        at = np.flatnonzero(inner)
        inner[at[hard_runs[np.searchsorted(runs, at, "right") - 1]]] = False
        ends = np.append(runs[1:], len(body))  # white space between does no harm
        for begin, end in zip(runs[hard_runs].tolist(), ends[hard_runs].tolist(), strict=True):
            folded[begin:end] = body[begin:end]
    begins = np.flatnonzero(inner | new)
    before = np.zeros(len(body) + 1, np.int32)  # bytes without white space before each byte
    np.cumsum(solid, dtype=np.int32, out=before[1:])
    tough = hard_runs[np.searchsorted(runs, begins, "right") - 1] if len(hard) else np.zeros(len(begins), bool)
    return folded[solid], before[begins], tough, np.searchsorted(begins, bounds)


def gather(flat: np.ndarray, begins: np.ndarray, counts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Runs of `flat` put one after another."""
    if not len(begins):
        return flat[:0]
    return flat[np.repeat(begins - ends[:-1], counts) + np.arange(ends[-1])]


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """The worker's encoder, kept from task to task."""
    return WordEncoder(path)
