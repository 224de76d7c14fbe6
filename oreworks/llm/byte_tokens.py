"""Token ids of byte-level vocabularies for whole Arrow arrays of texts.

A blank followed by anything but white space starts a piece of its own, so what stands between two such blanks is encoded
without its surroundings. Each distinct run between blanks is therefore encoded once per array; rows are gathered from those.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from tokenizers import Tokenizer

from oreworks.llm.token_counts import PIECES, byte_letters

# Bytes of text that are encoded at once; a longer text is an array of its own.
SLICE_BYTES = 16 << 20
# A blank that does not simply start a word: before white space, control characters or the end.
ODD_BLANK = r" (?:[\s\p{Z}\p{C}]|\z)"
# Characters of which all versions of Unicode tell letters, numbers and blanks alike.
EASY = r"\A[!-~\t\n\x{a1}-\x{24f}]+\z"


class ByteEncoder:
    """Ids as the tokenizers library gives them without added special tokens; special strings in a text are special tokens, as is its default."""

    def __init__(self, tokenizer_file: str):
        self.library = Tokenizer.from_file(tokenizer_file)
        self.specials = [t.content for t in self.library.get_added_tokens_decoder().values()]
        vocabulary = {t: i for t, i in self.library.get_vocab(with_added_tokens=False).items() if t not in self.specials}
        letter_of = byte_letters()
        byte_of = {letter: b for b, letter in letter_of.items()}
        ranks = {bytes(map(byte_of.__getitem__, token)): i for token, i in vocabulary.items()}
        self.fast = tiktoken.Encoding("byte_level", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})
        self.n_ids = 1 + max(*vocabulary.values(), *self.library.get_added_tokens_decoder())
        self.opens = np.zeros(self.n_ids, bool)
        self.opens[[i for token, i in vocabulary.items() if token.startswith(letter_of[32])]] = True

    def _library_ids(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def _runs(self, runs: pa.StringArray, encode) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all runs, each after a blank, and their numbers."""
        if not len(runs):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        joined = pc.binary_join(pa.ListArray.from_arrays([0, len(runs)], runs), " ")[0].as_py()
        ids = np.array(encode(" " + joined), np.int64)
        starts = np.flatnonzero(self.opens[ids])
        if len(starts) != len(runs) or starts[0]:
            each = [np.array(encode(" " + run), np.int64) for run in runs.to_pylist()]
            return np.concatenate(each), np.array([len(e) for e in each], np.int64)
        return ids, np.diff(starts, append=len(ids))

    def _distinct(self, runs: pa.StringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct runs, where each run's begin, and their numbers."""
        easy = pc.match_substring_regex(runs, EASY)
        other = pc.and_not(pc.not_equal(runs, ""), easy)
        starts, counts = np.zeros(len(runs), np.int64), np.zeros(len(runs), np.int64)
        found, before = [], 0
        for chosen, encode in ((easy, self.fast.encode_ordinary), (other, self._library_ids)):
            ids, n = self._runs(runs.filter(chosen), encode)
            where = chosen.to_numpy(zero_copy_only=False)
            starts[where], counts[where] = before + np.cumsum(n) - n, n
            found.append(ids)
            before += len(ids)
        return np.concatenate(found), starts, counts

    def encode(self, texts: pa.StringArray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each followed by ``end_id``, and the number of ids up to the end of each. NULL is as empty."""
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(texts, ODD_BLANK)
        for special in self.specials:
            odd = pc.or_(odd, pc.match_substring(texts, special))
        split = pc.split_pattern(pc.if_else(odd, "", texts), " ")
        row_ends = split.offsets.to_numpy()[1:] - split.offsets.to_numpy()[0]
        coded = split.flatten().dictionary_encode()
        ids, starts, counts = self._distinct(coded.dictionary)
        at = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        # A row's first run has no blank before it; a row with odd blanks is one run as a whole.
        first_at = np.concatenate([[0], row_ends[:-1]]).astype(np.int64)
        firsts = coded.dictionary.take(pa.array(at[first_at]))
        easy = pc.match_substring_regex(firsts, EASY).to_pylist()
        own = []
        for text, first, plain, whole in zip(texts, firsts.to_pylist(), easy, odd.to_pylist(), strict=True):
            if whole:
                own.append(self._library_ids(text.as_py()))
            else:
                own.append(self.fast.encode_ordinary(first) if plain else self._library_ids(first) if first else [])
        own.append([end_id])
        n = np.array([len(x) for x in own], np.int64)
        starts = np.concatenate([starts, len(ids) + np.cumsum(n) - n])
        ids = np.concatenate([ids, *[np.array(x, np.int64) for x in own if x]])
        counts = np.concatenate([counts, n])
        at[first_at] = len(coded.dictionary) + np.arange(len(first_at))
        at = np.insert(at, row_ends, len(counts) - 1)
        n = counts[at]
        until = np.cumsum(n)
        out = ids[np.repeat(starts[at] - (until - n), n) + np.arange(until[-1])]
        return out, until[row_ends + np.arange(len(row_ends))]


@cache
def byte_encoder(tokenizer_file: str) -> ByteEncoder:
    return ByteEncoder(tokenizer_file)


def text_slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about SLICE_BYTES of that text column, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    upto = np.cumsum(sizes, dtype=np.int64)
    first = 0
    while first < batch.num_rows:
        before = upto[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(upto, before + SLICE_BYTES, "right")))
        yield batch.slice(first, last - first)
        first = last
